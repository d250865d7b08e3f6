"""Column layouts of the tables the jobs read and write."""

from pyspark.sql import types as T

PARTS = T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))

EVENTS = T.StructType(
    [
        T.StructField("app_name", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("session_id", T.StringType()),
        T.StructField("seq", T.LongType(), False),
        T.StructField("event_id", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("parts", PARTS),
    ]
)

DIRECT_MEMORIES = T.StructType(
    [
        T.StructField("app_name", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("author", T.StringType()),
        T.StructField("parts", PARTS),
        T.StructField("custom_metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

MEMORIES = T.StructType(
    [
        T.StructField("memory_id", T.StringType(), False),
        T.StructField("app_name", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("session_id", T.StringType()),
        T.StructField("transcript", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("signature", T.ArrayType(T.LongType())),
        T.StructField("event_ids", T.ArrayType(T.StringType())),
        T.StructField("author", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("custom_metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("secure_metadata", T.MapType(T.StringType(), T.BinaryType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

QUERIES = T.StructType(
    [
        T.StructField("query_id", T.StringType(), False),
        T.StructField("app_name", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("query", T.StringType()),
    ]
)

RESULTS = T.StructType(
    [
        T.StructField("app_name", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("query_id", T.StringType(), False),
        T.StructField("rank", T.LongType(), False),
        T.StructField("memory_id", T.StringType(), False),
        T.StructField("text", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("custom_metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)
