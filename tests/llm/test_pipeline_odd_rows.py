"""The pipeline over nulls, empty and long texts, repeated rows and an empty table."""

import corpus_pipeline as pipeline

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [
    (1, WORDS, "en", "a", 3), (1, WORDS, "en", "a", 3), (2, f"{WORDS}  ", None, "a", None),
    (3, None, None, None, None), (4, "", "en", "b", 0), (None, "without id at all", "en", None, 5),
    (None, None, None, None, None), (5, "long text " * 30_000, "en", "b", 9), (6, "long text " * 30_000, "en", "a", 9),
]


def _run(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0), (None, 1, 1), (9, None, None)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    return pipeline.run(spark, str(folder))


def test_odd_rows_run_to_the_end(spark, tmp_path):
    found = _run(spark, tmp_path, ROWS)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    ids = {r["doc_id"] for r in found.collect()}
    # Of equal texts the smallest id is left; the long text is in the mix once or twice.
    assert {1, 5} <= ids and not {2, 6} & ids


def test_stages_keep_columns_and_rows_without_id(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    found = pipeline.without_copies(spark, docs, None)
    assert found.columns == docs.columns
    kept = sorted(str(r["doc_id"]) for r in found.collect())
    # The second text ends in a blank, so it is a near copy only.
    assert kept == ["1", "2", "3", "5", "None"]
    near = pipeline.without_similar(spark, docs, None)
    assert near.columns == docs.columns and near.where("doc_id is null").count() == 2


def test_an_empty_table_runs_to_the_end(spark, tmp_path):
    assert _run(spark, tmp_path, []).collect() == []
