"""CSV reviews, line corpora and the completeness gate."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx, queries
from conftest import rows
from reviewlens.schema import REVIEW_SCHEMA
from reviewlens.sources.corpus import (
    class_files,
    corpus_completeness,
    read_line_corpus,
    union_corpora,
)
from reviewlens.sources.reviews import (
    bad_records,
    null_report,
    read_labeled_reviews,
    write_labeled_reviews,
)
from reviewlens.sources.staging import shared_folder, stage

TEXTS = [
    "plain",
    ' "quoted", with blanks ',
    "two\nlines",
    'back\\slash "and" quote\\',
    "",
    None,
    "é, ß\r\nend",
]


def test_csv_round_trip(spark, tmp_path):
    data = [
        (i, "p", 1, 2, 5.0, text, None, "u", None, "s", 1356998400, 1.0)
        for i, text in enumerate(TEXTS)
    ]
    df = spark.createDataFrame(data, REVIEW_SCHEMA)
    write_labeled_reviews(df, str(tmp_path), "music")
    back = read_labeled_reviews(spark, str(tmp_path), "music", multi_line=True)
    assert back.schema == REVIEW_SCHEMA
    assert rows(back) == rows(df)


def test_missing_columns_are_written_empty(spark, tmp_path):
    write_labeled_reviews(spark.range(2).select(F.col("id").alias("reviewID")), str(tmp_path), "x")
    back = read_labeled_reviews(spark, str(tmp_path), "x")
    assert back.columns == REVIEW_SCHEMA.names
    assert rows(back.select("reviewID", "asin")) == [(0, None), (1, None)]


HEADER = ",".join(REVIEW_SCHEMA.names)
GOOD = "3000000000,p,1,2,5.0,text,,u,,s,1356998400,1.0"


def write_csv(tmp_path, *lines):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.csv").write_text("\n".join(lines) + "\n")


def test_ids_of_64_bits(spark, tmp_path):
    write_csv(tmp_path, HEADER, GOOD)
    assert read_labeled_reviews(spark, str(tmp_path), "x").first()["reviewID"] == 3_000_000_000


def test_bad_records_are_kept_and_counted(spark, tmp_path):
    few, word = "1,p,1,2", GOOD.replace("5.0", "five")
    write_csv(tmp_path, HEADER, GOOD, few, word)
    rows_ = read_labeled_reviews(spark, str(tmp_path), "x", keep_bad_record=True)
    assert {r["_bad_record"] for r in rows_.collect()} == {None, few, word}
    assert tuple(bad_records(spark, str(tmp_path), "x").first()) == (3, 2, 23)


def test_header_is_checked(spark, tmp_path):
    names = REVIEW_SCHEMA.names
    write_csv(tmp_path, ",".join([names[1], names[0], *names[2:]]), GOOD)
    with pytest.raises(Exception, match="header"):
        read_labeled_reviews(spark, str(tmp_path), "x").collect()
    assert read_labeled_reviews(spark, str(tmp_path), "x", check_header=False).count() == 1


def test_null_report(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "k string, t string")
    assert rows(null_report(df, ["k", "t"])) == [("k", 1), ("t", 2)]


def make_corpus(root):
    for name, files in {"d": ["one\n\ntwo\n", "", "three"], "t": ["x\ny\n"]}.items():
        (root / name).mkdir()
        for i, text in enumerate(files):
            (root / name / f"{i}.txt").write_text(text)


def test_lines_are_numbered_by_file_and_line(spark, tmp_path):
    make_corpus(tmp_path)
    d = read_line_corpus(spark, str(tmp_path / "d"), "D", 0)
    assert rows(d) == [("D0", "one", 0), ("D1", "", 0), ("D2", "two", 0), ("D3", "three", 0)]
    t = read_line_corpus(spark, str(tmp_path / "t"), "T", 1)
    assert union_corpora(d, t).count() == 6


def test_whole_files(spark, tmp_path):
    make_corpus(tmp_path)
    d = read_line_corpus(spark, str(tmp_path / "d"), "D", 0, whole_text=True)
    assert [r[1] for r in sorted(rows(d))][:1] == ["one\n\ntwo\n"]
    assert sorted(r[0] for r in rows(d)) == [f"D{i}" for i in range(d.count())]


def test_lines_of_files_read_in_pieces(spark, tmp_path):
    """Large files are cut into several pieces; the numbers still follow the lines."""
    lines = [f"line {i} " + "x" * (i % 50) for i in range(4000)]
    (tmp_path / "a.txt").write_text("\n".join(lines[:3000]) + "\n")
    (tmp_path / "b.txt").write_text("\n".join(lines[3000:]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        got = read_line_corpus(spark, str(tmp_path), "L", 1).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    ordered = sorted(got, key=lambda r: int(r["id"][1:]))
    assert [r["id"] for r in ordered] == [f"L{i}" for i in range(4000)]
    assert [r["value"] for r in ordered] == lines


def test_completeness_counts_every_file(spark, tmp_path):
    """An empty file is a file; marks of a finished write are none."""
    make_corpus(tmp_path)
    (tmp_path / "d" / "_SUCCESS").write_text("")
    files = class_files(spark, str(tmp_path))
    assert files.where("file like '%/d/1.txt'").count() == 1
    assert rows(corpus_completeness(files, {"d": 3, "t": 2, "other": 1})) == [
        ("d", 3, 3, True),
        ("other", 0, 1, False),
        ("t", 1, 2, False),
    ]


def test_stage_returns_the_written_rows(spark):
    df = spark.range(10).withColumn("a", F.array("id"))
    assert rows(stage(df)) == rows(df)


def test_shared_folder_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    if root:
        assert folder.startswith(root)
    assert spark.sparkContext.applicationId in folder


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default):
            return None

    class Context:
        master = "yarn"

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_bad_records_query_writes_and_reads_whole_texts(spark, sf, monkeypatch):
    whole = fx.reviews(spark, sf).withColumn("reviewText", F.concat("reviewText", F.lit('\n"a", b\n')))
    seen = []
    monkeypatch.setattr(queries.fx, "reviews", lambda *_: whole)
    monkeypatch.setattr(queries.review_files, "bad_records", lambda s, *a, **k: seen.append((a, k)) or bad_records(s, *a, **k))
    records, bad, fields = queries.bad_records(spark, sf).first()
    (args, options), = seen
    read = read_labeled_reviews(spark, *args, **options).select("reviewID", "reviewText")
    assert rows(read) == rows(whole.select("reviewID", "reviewText"))
    assert records == whole.count() and bad == whole.where("overall > 2").count()
    assert fields == 12 * records - bad


def test_class_files_are_written_by_several_tasks(spark, sf, tmp_path, monkeypatch):
    docs = fx.labeled_documents(spark, sf).withColumn("lang", F.lit("en")).repartition(4)
    monkeypatch.setattr(queries.fx, "labeled_documents", lambda *_: docs)
    monkeypatch.setattr(queries, "new_path", lambda *_: str(tmp_path))
    assert rows(queries.class_files_completeness(spark, sf)) == [("d", 2), ("t", 2)]
    for name in "dt":
        assert len(list((tmp_path / name / "lang=en").glob("part-*"))) > 1
