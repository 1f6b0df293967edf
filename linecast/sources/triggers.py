"""Trigger messages: parse, route and publish (SRC5, SRC6, PRJ3, FLT4, SNK4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linecast.functions.fmt import ISO_UTC_FORMAT
from linecast.schemas import TRIGGER

# Fixed value that must equal the reference's: the job type that runs the analysis.
ANALYSIS_JOB = "prop_bet_analysis"
TOPIC = "spark-jobs"
#: Marks of consumed triggers: text that sorts by time.
MARK_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def parse_triggers(messages: DataFrame) -> DataFrame:
    """PRJ3: (kafka_timestamp, job_type, timestamp) from message records with
    a binary ``value``; bad JSON or a missing field gives nulls."""
    return messages.select(
        F.col("timestamp").alias("kafka_timestamp"),
        F.from_json(F.col("value").cast("string"), TRIGGER).alias("message"),
    ).select("kafka_timestamp", "message.*")


def route_triggers(parsed: DataFrame, job_type: str = ANALYSIS_JOB) -> DataFrame:
    """FLT4: the triggers that start the analysis."""
    return parsed.filter(F.col("job_type") == job_type)


def count_triggers(parsed: DataFrame, job_type: str = ANALYSIS_JOB) -> dict:
    """One pass over a batch of parsed triggers: how many start the analysis,
    how many are rejected (unknown, missing or broken job type), and the time
    of the newest accepted one (its own timestamp, else the message's)."""
    accepted = F.coalesce(F.col("job_type") == job_type, F.lit(False))
    row = parsed.agg(
        F.count_if(accepted).alias("accepted"), F.count_if(~accepted).alias("rejected"),
        F.date_format(F.to_utc_timestamp(F.max(F.when(accepted, _trigger_time())), F.current_timezone()), "yyyy-MM-dd HH:mm:ss").alias("newest"),
    ).first()
    return row.asDict()


def _mark() -> F.Column:
    return F.date_format(F.to_utc_timestamp(_trigger_time(), F.current_timezone()), MARK_FORMAT)


def newest_mark(parsed: DataFrame, job_type: str = ANALYSIS_JOB) -> str | None:
    """The mark of the newest trigger that starts the analysis: how far a run
    that takes all of them has consumed."""
    return route_triggers(parsed, job_type).agg(F.max(_mark())).first()[0]


def _trigger_time() -> F.Column:
    """A trigger's own timestamp, else its message's."""
    return F.coalesce(F.try_to_timestamp("timestamp"), F.col("kafka_timestamp"))


def after_mark(parsed: DataFrame, mark: str) -> DataFrame:
    """The triggers after a mark; one that shares its microsecond counts as consumed."""
    return parsed.where(_mark() > mark)


def trigger_record(job_type, ts) -> F.Column:
    """SNK4: the published JSON record {"job_type", "timestamp" as UTC ISO text}
    (converted explicitly, whatever the session's time zone)."""
    return F.to_json(F.named_struct(
        F.lit("job_type"), job_type,
        F.lit("timestamp"), F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), ISO_UTC_FORMAT),
    ))


def publish_triggers(records: DataFrame, bootstrap: str | None = None, topic: str = TOPIC, path: str | None = None) -> None:
    """SNK4: append trigger records (column ``value``, JSON text) to the topic,
    or to a folder of NDJSON files that :func:`read_trigger_files` reads."""
    if (bootstrap is None) == (path is None):
        raise ValueError("give either a bootstrap server or a path")
    out = records.select(F.col("value").cast("string").alias("value"))
    if path is not None:
        out.write.mode("append").text(path)
    else:
        out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save()


def read_kafka(spark: SparkSession, bootstrap: str, topic: str = TOPIC, streaming: bool = True,
               starting_offsets: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """SRC5/SRC6: the trigger topic as a batch or streaming source (needs the
    spark-sql-kafka package on the classpath)."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting_offsets or ("latest" if streaming else "earliest"))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_trigger_files(spark: SparkSession, path: str, streaming: bool = True) -> DataFrame:
    """Trigger records kept as NDJSON files (one record per line), shaped like
    the message source: (timestamp, value)."""
    reader = spark.readStream if streaming else spark.read
    lines = reader.format("text").load(path)
    return lines.select(
        F.current_timestamp().alias("timestamp"), F.col("value").cast("binary").alias("value")
    )
