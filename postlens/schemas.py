"""Schemas of the tables a post moves through."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Column names and types of the input tables.
RAW_COMMENTS = _struct(
    ("author", T.StringType()),
    ("body", T.StringType()),
    ("created_utc", T.TimestampType()),
    ("distinguished", T.StringType()),
    ("id", T.StringType()),
    ("is_submitter", T.BooleanType()),
    ("link_id", T.StringType()),
    ("score", T.IntegerType()),
    ("stickied", T.BooleanType()),
    ("submission", T.StringType()),
    ("subreddit", T.StringType()),
    ("subreddit_id", T.StringType()),
    ("sub_author", T.StringType()),
    ("sub_created_utc", T.TimestampType()),
    ("sub_id", T.StringType()),
    ("sub_link_flair_text", T.StringType()),
    ("sub_num_comments", T.IntegerType()),
    ("sub_score", T.IntegerType()),
    ("sub_title", T.StringType()),
    ("sub_upvote_ratio", T.DoubleType()),
    ("sub_url", T.StringType()),
)
RAW_PARTITIONS = _struct(("sr", T.StringType()), ("sm", T.StringType()), ("dt", T.DateType()))

POSTS = _struct(
    ("submission_id", T.StringType()),
    ("comment_id", T.StringType()),
    ("timestamp", T.TimestampType()),
    ("author", T.StringType()),
    ("body", T.StringType()),
    ("submission", T.StringType()),
    ("sub_reddit", T.StringType()),
    ("upvotes", T.IntegerType()),
    ("upvote_ratio", T.DoubleType()),
    ("date", T.DateType()),
)
POSTS_FOR_INFERENCE = T.StructType([f for f in POSTS.fields if f.name != "sub_reddit"])
LABELLED_POSTS = T.StructType(POSTS.fields + _struct(("label", T.StringType())).fields)
REVIEWED_POSTS = T.StructType(LABELLED_POSTS.fields + _struct(("ground_truth_label", T.StringType())).fields)
CLEAN_POSTS = T.StructType(
    POSTS.fields + _struct(("body_cleaned", T.StringType()), ("submission_cleaned", T.StringType())).fields
)
SCORED_POSTS = T.StructType(CLEAN_POSTS.fields + _struct(("prediction", T.DoubleType())).fields)
SUBMISSIONS = _struct(
    ("submission_id", T.StringType()), ("submission_title", T.StringType()), ("submission_url", T.StringType())
)
# Dates of simulated posts arrive as text and are parsed with a given format.
SIMULATED_POSTS = _struct(
    ("submission_id", T.StringType()),
    ("comment_id", T.StringType()),
    ("timestamp", T.StringType()),
    ("author", T.StringType()),
    ("body", T.StringType()),
    ("submission", T.StringType()),
    ("upvotes", T.StringType()),
    ("upvote_ratio", T.StringType()),
    ("date", T.StringType()),
)
COMMENT_STREAM = _struct(
    ("id", T.StringType()), ("dt", T.TimestampType()), ("author", T.StringType()), ("body", T.StringType())
)
LISTING_POST = _struct(
    ("created_utc", T.DoubleType()),
    ("subreddit", T.StringType()),
    ("title", T.StringType()),
    ("author", T.StringType()),
    ("selftext", T.StringType()),
    ("upvote_ratio", T.DoubleType()),
    ("ups", T.IntegerType()),
    ("downs", T.IntegerType()),
    ("score", T.IntegerType()),
)
LISTING = _struct(("data", _struct(("children", T.ArrayType(_struct(("data", LISTING_POST)))))))
# Columns the models add and that scoring drops again.
HELPER_COLUMNS = ("words", "filtered", "rawFeatures", "features", "rawPrediction", "probability")
