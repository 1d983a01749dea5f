from pyspark.sql import functions as F

from quarry.streaming import incremental as I


def test_incremental_runs_are_idempotent(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = "k long, v string, at long"
    spark.createDataFrame([(1, "a", 1), (2, "b", 1), (1, "z", 2)], schema).coalesce(1).write.parquet(src)

    def run():
        I.process_available(spark.readStream.schema(schema).parquet(src), lambda d: d.withColumn("v", F.upper("v")), out, mark, ["k"], ["at"])
        return [tuple(r)[:2] for r in I.current(spark, out).orderBy("k").collect()]

    assert run() == [(1, "Z"), (2, "B")]
    assert run() == [(1, "Z"), (2, "B")]
    spark.createDataFrame([(2, "new", 3), (3, "c", 3)], schema).coalesce(1).write.mode("append").parquet(src)
    assert run() == [(1, "Z"), (2, "NEW"), (3, "C")]


def test_windows_run_as_streams(spark, tiny):
    schema = spark.read.parquet(f"{tiny}/events.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{tiny}/events.parq*")
    q = I.tumbling(stream, "1 day", "2 days").writeStream.format("memory").queryName("days").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("days").agg(F.sum("n")).first()[0] == spark.read.parquet(f"{tiny}/events.parquet").count()
