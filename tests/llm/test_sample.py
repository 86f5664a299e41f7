"""The labelled sample is bounded by ids, however often they come and whatever texts they have."""

from tidewell.llm import toxicity


def test_sample_is_bounded(spark):
    docs = spark.range(20_000).selectExpr("id % 6 AS d", "concat('text ', id % 50) AS t")
    labels = spark.range(40).selectExpr("id AS doc_id", "cast(id % 2 as int) AS toxic")
    got = toxicity._sample(docs, labels.unionByName(labels), 20).collect()
    assert 0 < len(got) <= 6 and len({r["r"] for r in got}) == len(got)
    named = docs.selectExpr("d AS doc_id", "t AS text")
    model = toxicity.train(named, labels, sample_rows=20)
    assert toxicity.score(named.limit(10), model).count() == 10
