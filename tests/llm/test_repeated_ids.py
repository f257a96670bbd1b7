"""Operators whose results could depend on the order of rows with one id."""

from energy_series.llm import op5_toxicity


def test_toxicity_learns_the_same_from_rows_in_any_order(spark):
    texts = [(i, f"plain words number {i} about rivers and hills") for i in range(60)]
    texts += [(i, f"you utter scumbag {i}, go away") for i in range(60, 90)]
    texts += [(i, f"another text of id {i}, quiet and long") for i in range(55, 65)]
    labels = spark.createDataFrame([(i, int(60 <= i < 90)) for i in range(90)], "doc_id long, toxic int")
    found = []
    for order in (texts, texts[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        model = op5_toxicity.trained(docs, labels)
        found.append(sorted((r.doc_id, r.score, r.predicted) for r in op5_toxicity.scores(docs, model).collect()))
    assert found[0] == found[1] and len(found[0]) == len(texts)
