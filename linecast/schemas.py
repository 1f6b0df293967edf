"""Explicit schemas of the relations the jobs read and write."""

from pyspark.sql import types as T

# Offered lines, one JSON object per line (NDJSON). ``line`` is always double,
# also when a file holds only whole numbers (inference would give bigint).
PROPS = T.StructType([
    T.StructField("player_name", T.StringType()),
    T.StructField("stat", T.StringType()),
    T.StructField("line", T.DoubleType()),
    T.StructField("game_date", T.StringType()),
    T.StructField("team", T.StringType()),
])

# Trigger record carried in the message value.
TRIGGER = T.StructType([
    T.StructField("job_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

# Box-score measures used by the stat lookup.
MEASURES = ["points", "assists", "reboundstotal", "steals", "blocks", "threepointersmade"]

# Target table of the recommendations (the declared columns, the five
# scenario columns and the two timing columns).
PREDICTIONS = T.StructType([
    T.StructField("personid", T.LongType(), False),
    T.StructField("player_name", T.StringType()),
    T.StructField("stat_type", T.StringType(), False),
    T.StructField("line", T.DoubleType(), False),
    T.StructField("game_date", T.DateType(), False),
    T.StructField("team", T.StringType()),
    T.StructField("predicted_value", T.DoubleType()),
    T.StructField("bet_outcome", T.StringType()),
    T.StructField("deviation_percentage", T.DoubleType()),
    T.StructField("probability_over", T.DecimalType(5, 4)),
    T.StructField("confidence_low", T.DecimalType(8, 2)),
    T.StructField("confidence_high", T.DecimalType(8, 2)),
    T.StructField("confidence_score", T.StringType()),
    T.StructField("risk_assessment", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("processing_time_seconds", T.DoubleType()),
    T.StructField("total_processing_time_seconds", T.DoubleType()),
])

# Key of a stored prediction, used for idempotent appends.
PREDICTION_KEY = ["personid", "stat_type", "line", "game_date"]

# Group key of a line: one prediction per row of this key.
LINE_KEY = ["personid", "player_name", "stat", "line", "team"]
