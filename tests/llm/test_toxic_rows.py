"""pipeline: what its toxicity stage sends to Python."""

from freightmill.llm.toxicity import drop_toxic, train


def test_toxic_rows_do_not_travel(spark):
    docs = spark.createDataFrame(
        [(1, "you are a stupid idiot and a moron", "x"), (2, "a quiet day", "y"), (3, None, None)],
        "doc_id long, text string, other string",
    )
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    model = train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
    kept = drop_toxic(docs, model)
    assert kept.schema == docs.schema
    assert "MapInArrow" not in kept._jdf.queryExecution().executedPlan().toString()
    scores = {t: model.score(t) < 0.7 for _, t, _ in docs.collect()}
    assert sorted(r.doc_id for r in kept.collect()) == [
        r.doc_id for r in docs.orderBy("doc_id").collect() if scores[r.text]
    ]
