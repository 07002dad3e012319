"""The classifier's sample when one identifier repeats."""

from pyspark.sql import functions as F

from spanlight.llm import quality


def test_one_row_of_a_repeated_id_reaches_the_driver(spark, documents, monkeypatch):
    rows = [(i, f"text number {i} of many") for i in range(60)] + [(7, f"copy {i % 5}") for i in range(300)]
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, quality int")
    docs = documents(rows)
    order = {r.doc_id: r.o for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(23)).alias("o")).collect()}
    hot = min(order, key=lambda i: order[i])
    docs = docs.unionByName(documents([(hot, "the first id again")] * 200))
    collected = []
    plain = type(docs).toPandas
    monkeypatch.setattr(type(docs), "toPandas", lambda d: collected.append(plain(d)) or collected[-1])
    got = quality.training_sample(docs, labels, sample_docs=10)
    assert [len(d) for d in collected] == [len(got)] and got["id"].is_unique
    assert {7, 8} <= set(got["id"]) and (got["label"] == -1).sum() >= 18
