"""Rating profiles, posting rates and their attachment."""

from functools import reduce

import pytest
from pyspark.sql import Window, functions as F

from checks import fixtures as fx
from conftest import plan_of, rows
from reviewlens.functions.dates import active_days, epoch_date
from reviewlens.operators import profiles
from reviewlens.schema import STAR_WEIGHTS


def rated(spark, pairs):
    return spark.createDataFrame(pairs, "asin string, overall double")


@pytest.mark.parametrize(
    "ratings, stars",
    [
        ([5, 5, 5], (0, 0, 0, 0, 300)),
        ([5, 5, 1], (20 / 3, 0, 0, 0, 400 / 3)),
        ([4.5, 4], (0, 0, 0, 40, 0)),
    ],
)
def test_star_goldens(spark, ratings, stars):
    df = rated(spark, [("p", float(r)) for r in ratings])
    got = profiles.product_star_profile(df).first()
    assert got["pid"] == "p"
    assert tuple(got)[1:] == pytest.approx(stars)


def test_null_key_is_dropped_and_missing_rating_counts_in_total(spark):
    df = rated(spark, [(None, 5.0), ("p", None), ("p", 5.0)])
    assert rows(profiles.product_star_profile(df)) == [("p", 0.0, 0.0, 0.0, 0.0, 50.0)]


def test_one_pass_profile_equals_full_outer_chain(spark, sf):
    lines = fx.rated_lines(spark, sf)
    counts = [
        lines.where(F.col("rating") == k).groupBy("l_partkey").agg(F.count("*").alias(f"n{k}"))
        for k in STAR_WEIGHTS
    ]
    total = lines.groupBy("l_partkey").agg(F.count("*").alias("total"))
    joined = reduce(lambda a, b: a.join(b, "l_partkey", "fullouter"), [*counts, total]).na.fill(0)
    merged = profiles.full_outer_merge([*counts, total], "l_partkey")
    assert rows(merged) == rows(joined)
    assert "Join" not in plan_of(merged)
    chain = joined.select(
        "l_partkey",
        *[F.pow(f"n{k}", 2) / F.col("total") * w for k, w in STAR_WEIGHTS.items()],
    )
    one_pass = profiles.product_star_profile(lines, "l_partkey", "rating")
    assert rows(one_pass) == rows(chain)
    assert plan_of(one_pass).count("Exchange hashpartitioning") == 0
    assert "Join" not in plan_of(one_pass)


def test_full_outer_merge_fills_absent_numbers(spark):
    a = spark.createDataFrame([("x", 1)], "k string, a int")
    b = spark.createDataFrame([("y", 2)], "k string, b int")
    c = spark.createDataFrame([("z", 3)], "k string, c int")
    got = rows(profiles.full_outer_merge([a, b, c], "k"))
    assert got == [("x", 1, 0, 0), ("y", 0, 2, 0), ("z", 0, 0, 3)]


def test_full_outer_merge_refuses_a_repeated_key(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), (None, 3)], "k string, a int")
    with pytest.raises(Exception, match="holds a key twice"):
        profiles.full_outer_merge([a], "k").collect()


@pytest.mark.parametrize(
    "seconds, days, rate",
    [
        ([0], 1, 1.0),
        ([0, 86399], 1, 2.0),
        ([86399, 86400], 2, 1.0),
        ([0, 172800], 3, 2 / 3),
        ([-1, 0], 2, 1.0),
    ],
)
def test_rate_goldens_in_any_time_zone(spark, seconds, days, rate):
    df = spark.createDataFrame([("u", s) for s in seconds], "reviewerID string, unixReviewTime long")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            span = df.agg(active_days(F.min("unixReviewTime"), F.max("unixReviewTime")))
            assert span.first()[0] == days
            assert profiles.user_review_rate(df).first()["reviewRate"] == pytest.approx(rate)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_epoch_date(spark):
    got = spark.range(1).select(epoch_date(F.lit(1356998400)).cast("string")).first()[0]
    assert got == "2013-01-01"


def test_top_reviewers_order_ties_by_key(spark):
    rates = spark.createDataFrame(
        [("b", 2.0), ("a", 2.0), ("c", 1.0), ("d", 3.0)], "reviewerID string, reviewRate double"
    )
    got = profiles.top_reviewers_by_rate(rates, 3)
    assert [r[0] for r in got.collect()] == ["d", "a", "b"]
    assert "TakeOrderedAndProject" in plan_of(got)


def review_rows(spark):
    return spark.createDataFrame(
        [
            (1, "p1", "u1", 5.0, 0),
            (2, "p1", "u2", 4.0, 86400),
            (3, None, "u1", 1.0, 864000),
            (4, "p2", None, 2.0, 0),
            (5, "p2", "u1", 5.0, 86400),
        ],
        "reviewID int, asin string, reviewerID string, overall double, unixReviewTime long",
    )


def test_attach_drops_rows_without_a_key_but_counts_them_for_the_other(spark):
    got = {r["reviewID"]: r for r in profiles.attach_profiles(review_rows(spark)).collect()}
    assert sorted(got) == [1, 2, 5]
    # p2 has two rows though one of them has no reviewer.
    assert got[5]["p5star"] == pytest.approx(1 / 2 * 100)
    # u1 has three rows though one of them has no product.
    assert got[1]["u5star"] == pytest.approx(4 / 3 * 100)


def test_profile_and_rate_in_one_aggregation(spark):
    df = review_rows(spark)
    both = profiles.user_profile_and_rate(df, "reviewerID", "overall", "unixReviewTime", "asin")
    rate = {r["reviewerID"]: r["reviewRate"] for r in both.collect()}
    # The row without product is day 10 of u1; it does not extend the span.
    assert rate["u1"] == pytest.approx(2 / 2)
    assert rows(both.select("reviewerID", "reviewRate")) == rows(
        profiles.user_review_rate(df, product="asin")
    )


def test_attach_equals_window_form(spark, sf):
    df = fx.reviews(spark, sf)
    stars = []
    for prefix, key in (("p", "asin"), ("u", "reviewerID")):
        w = Window.partitionBy(key)
        for k, weight in STAR_WEIGHTS.items():
            n = F.count_if(F.col("overall") == k).over(w)
            stars.append(
                (F.pow(n, 2) / F.count("*").over(w) * weight).alias(f"{prefix}{k}star")
            )
    names = ["reviewID"] + [f"{p}{k}star" for p in "pu" for k in STAR_WEIGHTS]
    expected = df.select("reviewID", *stars).select(*names)
    assert rows(profiles.attach_profiles(df).select(*names)) == rows(expected)
