"""Table layouts: the bronze envelope and the typed column lists of silver and gold."""

from pyspark.sql import types as T

# Every bronze table is the same envelope: one row per loaded feed file.
BRONZE_SCHEMA = T.StructType([
    T.StructField("_loaded_at", T.TimestampType(), True),
    T.StructField("_source_file", T.StringType(), True),
    T.StructField("data", T.StringType(), True),
])

BRONZE_TABLES = (
    "rt_details", "rt_score", "rt_reviews", "rt_critic_reviews", "rt_crosswalk",
    "mc_general", "mc_critic_reviews", "mc_user_reviews",
)

REJECT_SCHEMA = T.StructType([
    T.StructField("_loaded_at", T.TimestampType(), True),
    T.StructField("_source_file", T.StringType(), True),
    T.StructField("reason", T.StringType(), True),
    T.StructField("raw", T.StringType(), True),
])

PLATFORMS = ("metacritic", "rottentomatoes")
