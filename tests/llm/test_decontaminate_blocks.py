from quarry.llm import decontaminate as D
from tests.llm.test_text_operators import by_row


def test_blocks_of_items_do_not_change_the_result(spark):
    items = [(i, " ".join(f"i{i}w{j}" for j in range(30))) for i in range(12)]
    items.append((50, " ".join(["left"] * 5 + ["over"] * 5)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    own = lambda k, n: " ".join(f"d{k}o{j}" for j in range(n))
    rows = [(k, f"{items[k % 12][1]} {own(k, 40)} {items[(k + 1 + k // 12) % 12][1]}") for k in range(48)]
    rows += [(100 + k, f"{own(100 + k, 80)} left left left left left {items[k][1]} over over over over over {own(200 + k, 80)}") for k in range(12)]
    rows += [(300, items[0][1]), (301, own(301, 20)), (302, None), (303, ""), (301, own(301, 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = by_row(D.decontaminate(docs, bench), "doc_id", "text")
    assert len(want) == 15 and sum(want.values()) == 16
    assert by_row(D.decontaminate(docs, bench, max_windows=150), "doc_id", "text") == want
