"""Normalisation with a lemma table."""

from checks import fixtures as fx
from conftest import rows
from reviewlens.operators.normalize import TextNormalizer, normalize_text

LEMMAS = [("ran", "run"), ("Cars", "car"), ("was", "be"), ("ran", "rung"), (None, "x"), ("y", None)]


def texts(spark):
    data = [
        (1, "He ran, ran!  Cars cars"),
        (2, "was it"),
        (3, ""),
        (4, None),
        (5, " , "),
        (6, "run ran " * 300),
    ]
    return spark.createDataFrame(data, "k int, t string").repartition(3)


def lemmas(spark):
    return spark.createDataFrame(LEMMAS, "surface string, lemma string")


EXPECTED = {1: "run run car cars", 2: "", 3: "", 4: None, 5: "", 6: ("run run " * 300).strip()}


def test_lemmas(spark):
    got = normalize_text(texts(spark), "t", "n", lemmas(spark))
    assert {r["k"]: r["n"] for r in got.collect()} == EXPECTED
    assert got.columns == ["k", "t", "n"]


def test_rows_with_the_same_id_or_none_stay_apart(spark):
    data = [(1, "Cars ran"), (1, "was there"), (None, "ran"), (None, None), (1, "Cars ran")]
    df = spark.createDataFrame(data, "k int, t string").repartition(2)
    got = normalize_text(df, "t", "n", lemmas(spark)).select("k", "n")
    assert rows(got) == rows(
        spark.createDataFrame(
            [(1, "car run"), (1, "there"), (None, "run"), (None, None), (1, "car run")],
            "k int, n string",
        )
    )


def test_result_does_not_depend_on_other_lemmas(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", "text")
    table = fx.lemma_table(spark, sf)
    more = table.unionByName(
        spark.range(250_000).selectExpr("concat('zz', id, 'zz') as surface", "'y' as lemma")
    )
    few, many = (normalize_text(docs, "text", lemmas=t) for t in (table, more))
    assert rows(few) == rows(many)


def test_empty_lemma_table_changes_nothing(spark):
    empty = lemmas(spark).where("false")
    plain = normalize_text(texts(spark), "t", "n")
    assert rows(normalize_text(texts(spark), "t", "n", empty)) == rows(plain)


def test_stage_is_saved_with_its_stop_words(spark, tmp_path):
    stage = TextNormalizer(inputCol="t", outputCol="n", stop=["run"])
    stage.write().overwrite().save(str(tmp_path / "s"))
    loaded = TextNormalizer.load(str(tmp_path / "s"))
    df = texts(spark)
    assert rows(loaded.transform(df)) == rows(normalize_text(df, "t", "n", stop=["run"]))


def test_replaced_tokens_stand_at_their_places(spark):
    """First, last, repeated and neighbouring tokens, in rows longer than a few tokens."""
    text = "Cars " + "Cars ran word " * 40 + "ran"
    df = spark.createDataFrame([(1, text), (2, "word " * 50), (3, "Cars")], "k int, t string")
    got = {r["k"]: r["n"] for r in normalize_text(df, "t", "n", lemmas(spark)).collect()}
    assert got == {1: "car " + "car run word " * 40 + "run", 2: ("word " * 50).strip(), 3: "car"}


def test_tokens_without_lemma_are_not_grouped(spark):
    """Of 20,000 tokens one has a lemma, so one entry is put together to rows."""
    df = spark.createDataFrame([(i, "word other " * 10 + ("ran" if i == 7 else "")) for i in range(1000)], "k int, t string")
    done = normalize_text(df, "t", "n", lemmas(spark))
    assert done.where("n like '% run'").count() == 1
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    grouped = plan[plan.index("collect_list"):]
    assert "isnotnull(_token" in grouped or "isnotnull(lemma" in grouped
