"""Weekly totals kept up to date from a stream of event files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tillwise.staging import remove

#: How far behind the newest event a week is still open.
LATE = "60 days"
#: Batches from one full copy of the totals to the next.
SNAPSHOT_EVERY = 20

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def weekly_totals(events: DataFrame, time: str, key: str, value: str, late: str = LATE) -> DataFrame:
    """Count and sum per Monday week and key; works on streams and on tables.

    Sums run over integer hundredths, so batches may arrive in any split. Weeks follow the
    wall clock of the events in any session time zone: the wall time is read as UTC, and
    the window offset of four days moves the weeks from the epoch's Thursday to Monday.
    """
    epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    wall = F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {epoch}, cast({time} AS timestamp_ntz)))")
    start = F.unix_seconds(F.col("_window.start"))
    return (
        events.withColumn(time, wall)
        .withWatermark(time, late)
        .groupBy(F.window(F.col(time), "7 days", "7 days", "4 days").alias("_window"), key)
        .agg(F.count("*").alias("n"), F.sum(F.rint(F.col(value) * 100).cast("decimal(28,0)")).alias("_sum"))
        .select(
            F.date_from_unix_date((start / 86_400).cast("int")).alias("week"), key, "n",
            (F.col("_sum").cast("double") / 100).alias("total"),
        )
    )


def resume_weekly_totals(
    spark: SparkSession, path: str, table: str, checkpoint: str, pattern: str = "*.parquet",
    files_per_batch: int = 100, late: str = LATE, snapshot_every: int = SNAPSHOT_EVERY,
) -> DataFrame:
    """Take in the event files that came since the last call and return the totals so far.

    ``checkpoint`` and ``table`` belong to the caller and outlive the session: a file is read
    once, by whichever call first finds it. The stream's state holds the running total of
    each week and key until the week is ``late`` behind the newest event; an event for a week that
    was given up is not counted. Each micro-batch merges the totals it changed into the table.
    """
    stream = (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )
    totals = weekly_totals(stream, "ts", "event_type", "value", late)
    keys = ["week", "event_type"]
    query = (
        totals.writeStream.outputMode("update").trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, number: merge_batch(batch, number, table, keys, snapshot_every))
        .start()
    )
    query.awaitTermination()
    return current_rows(spark, table, totals.schema, keys)


def merge_batch(batch: DataFrame, number: int, table: str, keys: Sequence[str], snapshot_every: int = SNAPSHOT_EVERY) -> None:
    """Bring a micro-batch's new values of some keys into the table.

    The table keeps one folder per batch, so a repeated batch replaces what it wrote before and
    changes nothing. Every ``snapshot_every`` batches the folder holds all keys as they then are; a
    reader begins at the last of these, and folders before the one before it are removed.
    """
    spark = batch.sparkSession
    whole = number % snapshot_every == snapshot_every - 1
    if whole:
        earlier = current_rows(spark, table, batch.schema, keys, number)
        batch = batch.unionByName(earlier.join(batch.select(*keys), keys, "left_anti"))
    batch.withColumn("snapshot", F.lit(whole)).write.mode("overwrite").parquet(f"{table}/batch={number}")
    if whole:
        for old in range(max(number - 3 * snapshot_every, -1) + 1, number - snapshot_every):
            remove(spark, f"{table}/batch={old}")


def current_rows(
    spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str], before: int | None = None
) -> DataFrame:
    """The newest row of each key, of all batches or those ``before`` one."""
    columns = [c for c in schema.names if c not in keys]
    try:
        log = spark.read.parquet(table)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
    log = log if before is None else log.where(F.col("batch") < before)
    last = log.where("snapshot").agg(F.max("batch")).first()[0]
    recent = log.where(F.col("batch") >= (0 if last is None else last))
    newest = recent.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch").alias("_row"))
    return newest.select(*keys, "_row.*").select(*[F.col(f.name).cast(f.dataType) for f in schema])
