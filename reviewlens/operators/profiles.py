"""Rating profiles, posting rates and their attachment to reviews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions.dates import active_days
from reviewlens.operators.lookup import lookup_join
from reviewlens.schema import (
    JOINED_REVIEW_COLUMNS,
    PRODUCT_STARS,
    STAR_WEIGHTS,
    USER_STARS,
)
from reviewlens.sources.staging import stage

_TOTAL = "_total"


def star_counts(rating: str) -> list[Column]:
    """One count per rating level; other ratings match no level."""
    return [
        F.count_if(F.col(rating) == level).alias(f"_n{level}")
        for level in STAR_WEIGHTS
    ]


def star_weights(names: Sequence[str]) -> list[Column]:
    """``n_level ^ 2 / total * weight`` for each level, from `star_counts`."""
    return [
        (F.pow(F.col(f"_n{level}"), 2) / F.col(_TOTAL) * weight).alias(name)
        for name, (level, weight) in zip(names, STAR_WEIGHTS.items())
    ]


def star_profile(
    df: DataFrame, key: str, rating: str, key_name: str, names: Sequence[str]
) -> DataFrame:
    """Weighted share of each rating level per key, in one aggregation."""
    return _star_profile(df, key, rating, key_name, names).drop(_TOTAL)


def _star_profile(df, key, rating, key_name, names):
    counts = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(key_name))
        .agg(*star_counts(rating), F.count("*").alias(_TOTAL))
    )
    return counts.select(key_name, *star_weights(names), _TOTAL)


def product_star_profile(
    df: DataFrame, key: str = "asin", rating: str = "overall"
) -> DataFrame:
    """(pid, p1star..p5star): one row per product."""
    return star_profile(df, key, rating, "pid", PRODUCT_STARS)


def user_star_profile(
    df: DataFrame, key: str = "reviewerID", rating: str = "overall"
) -> DataFrame:
    """(uid, u1star..u5star): one row per reviewer."""
    return star_profile(df, key, rating, "uid", USER_STARS)


def full_outer_merge(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer merge of frames with one row per ``key``; absent numbers become 0.

    With one row per key, stacking the frames and grouping by key gives what a
    chain of full outer joins gives, in one exchange instead of two per join.
    Rows without key drop out. A frame that holds a key twice is an error.
    """
    columns = [(i, c) for i, f in enumerate(frames) for c in f.columns if c != key]
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            f.where(F.col(key).isNotNull()).withColumn(f"_row{i}", F.lit(1))
            for i, f in enumerate(frames)
        ],
    )
    merged = stacked.groupBy(key).agg(
        *[F.any_value(c, True).alias(c) for _, c in columns],
        F.greatest(*[F.count(f"_row{i}") for i in range(len(frames))], F.lit(0)).alias("_most"),
    )
    twice = F.assert_true(F.col("_most") <= 1, F.lit("a frame holds a key twice"))
    return merged.where(twice.isNull()).drop("_most").na.fill(0)


def user_review_rate(
    df: DataFrame,
    user: str = "reviewerID",
    seconds: str = "unixReviewTime",
    product: str | None = None,
) -> DataFrame:
    """(user, reviewRate): rows per calendar day between first and last row.

    ``product`` names a second key that must be present, as it is for reviews
    that went through the profile joins.
    """
    known = F.col(user).isNotNull()
    if product is not None:
        known &= F.col(product).isNotNull()
    rate = F.count("*") / active_days(F.min(seconds), F.max(seconds))
    return df.where(known).groupBy(user).agg(rate.alias("reviewRate"))


def top_reviewers_by_rate(
    rates: DataFrame, n: int, user: str = "reviewerID"
) -> DataFrame:
    """The ``n`` reviewers with the highest rate; ties are ordered by key."""
    return rates.orderBy(F.desc("reviewRate"), user).limit(n)


def user_profile_and_rate(
    df: DataFrame,
    user: str,
    rating: str,
    seconds: str,
    product: str,
) -> DataFrame:
    """`user_star_profile` and `user_review_rate` from one aggregation.

    Reviews without a product count for the profile but not for the rate.
    """
    rated = F.col(product).isNotNull()
    when = F.when(rated, F.col(seconds))
    counts = (
        df.where(F.col(user).isNotNull())
        .groupBy(user)
        .agg(
            *star_counts(rating),
            F.count("*").alias(_TOTAL),
            F.count_if(rated).alias("_rated"),
            F.min(when).alias("_first"),
            F.max(when).alias("_last"),
        )
    )
    rate = F.col("_rated") / active_days(F.col("_first"), F.col("_last"))
    return counts.select(
        user, *star_weights(USER_STARS), rate.alias("reviewRate"), _TOTAL
    )


def attach_profiles(
    df: DataFrame,
    product: str = "asin",
    user: str = "reviewerID",
    rating: str = "overall",
    row_id: str = "reviewID",
) -> DataFrame:
    """Reviews with both profiles; rows without product or reviewer drop out.

    Profiles meet (id, product, reviewer) alone; the whole row joins them once, by its
    id. An id that is missing or repeated is an error when the plan runs.
    """
    products = _star_profile(df, product, rating, product, PRODUCT_STARS)
    users = _star_profile(df, user, rating, user, USER_STARS)
    stars = [*PRODUCT_STARS, *USER_STARS]
    narrow = df.select(row_id, product, user)
    found = _with_lookups(narrow, products, product, users, user)
    once = found.groupBy(row_id).agg(
        *[F.any_value(c).alias(c) for c in stars], F.count("*").alias("_rows")
    )
    one = F.assert_true(
        (F.col("_rows") == 1) & F.col(row_id).isNotNull(), F.lit(f"{row_id} must be unique")
    )
    joined = df.join(once.where(one.isNull()).drop("_rows"), row_id)
    if set(JOINED_REVIEW_COLUMNS + ["label"]) <= set(df.columns):
        return joined.select(*JOINED_REVIEW_COLUMNS, *stars, "label")
    return joined.select(*df.columns, *stars)


def attach_for_features(
    df: DataFrame,
    narrow: DataFrame,
    product: str,
    user: str,
    rating: str,
    seconds: str,
) -> DataFrame:
    """``narrow`` rows of ``df`` with both profiles and the reviewer's rate."""
    products = _star_profile(df, product, rating, product, PRODUCT_STARS)
    users = user_profile_and_rate(df, user, rating, seconds, product)
    return _with_lookups(narrow, products, product, users, user)


def _with_lookups(rows, products, product, users, user):
    """``rows`` joined to the products and to the users.

    The rows are narrow and each lookup reads them twice, so they are written to the
    shared folder first, when this is called.
    """
    rows = stage(rows, "narrow")
    keyed = rows.agg(F.count(product).alias("products"), F.count(user).alias("users"))
    with_products = lookup_join(
        rows, products, product, _TOTAL, total=keyed.select("products").scalar()
    )
    return lookup_join(
        with_products, users, user, _TOTAL, total=keyed.select("users").scalar()
    )
