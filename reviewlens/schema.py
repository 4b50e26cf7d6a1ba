"""Fixed schemas, column names and constants."""

from __future__ import annotations

from pyspark.sql import types as T

# The labelled-review file has these twelve columns in this order.
REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("reviewID", T.LongType()),
        T.StructField("asin", T.StringType()),
        T.StructField("helpfulPos", T.IntegerType()),
        T.StructField("helpfulNeg", T.IntegerType()),
        T.StructField("overall", T.DoubleType()),
        T.StructField("reviewText", T.StringType()),
        T.StructField("reviewTime", T.StringType()),
        T.StructField("reviewerID", T.StringType()),
        T.StructField("reviewerName", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("unixReviewTime", T.LongType()),
        T.StructField("label", T.DoubleType()),
    ]
)

# Rating levels and the weight of each level in a star profile.
STAR_WEIGHTS = {1: 20, 2: 40, 3: 60, 4: 80, 5: 100}

# Profile column names.
PRODUCT_STARS = ["p1star", "p2star", "p3star", "p4star", "p5star"]
USER_STARS = ["u1star", "u2star", "u3star", "u4star", "u5star"]

# The review columns kept beside the two profiles, in order.
JOINED_REVIEW_COLUMNS = [
    "reviewID", "asin", "helpfulPos", "helpfulNeg", "overall", "reviewText",
    "unixReviewTime", "reviewerID",
]

# The feature table, in order.
FEATURE_COLUMNS = [
    "reviewID", "helpfulness", "rating", "capitalLetterRatio", "reviewWordCount",
    "pstar1", "pstar2", "pstar3", "pstar4", "pstar5",
    "ustar1", "ustar2", "ustar3", "ustar4", "ustar5",
    "userReviewRate", "label",
]

# The order in which feature values are written in front of the
# text. `pstar1` stands there twice; `userReviewRate` does not occur.
TEXT_FEATURE_ORDER = [
    "helpfulness", "rating", "capitalLetterRatio", "reviewWordCount",
    "pstar1", "pstar2", "pstar3", "pstar4", "pstar5",
    "ustar1", "ustar2", "ustar3", "ustar4", "ustar5",
    "pstar1",
]

# Normalisation.
PUNCTUATION = ",.!?:;"
STOP_WORDS = ("stopWord",)
MIN_TOKEN_LENGTH = 3

# Hashed feature width, split weights, class labels.
HASH_FEATURES = 5000
SPLIT_WEIGHTS = (0.6, 0.4)
DECEPTIVE, TRUTHFUL = 0.0, 1.0
CLASSES = (DECEPTIVE, TRUTHFUL)

# Files expected per class directory of the line corpus.
EXPECTED_FILES = {"t": 800, "d": 1098}
