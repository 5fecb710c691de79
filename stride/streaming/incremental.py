"""Incremental variants on Structured Streaming (STR-1, STR-2).

STR-1  Raw activity documents land as JSON-lines files; a file-source stream
       flattens them (PRJ-9/10) into Spark's Parquet file sink.  The sink's own log
       (``_spark_metadata``) commits each micro-batch once, also when a batch is
       replayed after a failure, and readers see committed files only.  A document
       may be delivered again, changed, and on another day: every row carries its
       delivery (file time, file name, a digest), and the staging view keeps the
       latest delivery of each key, whatever the batch boundaries.  ``snapshot``
       publishes that view as a day-partitioned table.

STR-2  Idempotent delivery: a streaming ``dropDuplicates`` on the activity id keeps
       the delivered ids in Spark's state store, keyed and partitioned by id, and the
       file sink commits the outbox.  No batch reads what earlier batches wrote;
       the checkpoint is the record of what was delivered.  With ``horizon`` an
       id is forgotten once event time has passed it by so much
       (``dropDuplicatesWithinWatermark``), which bounds the state; an activity that
       arrives later than that is then too late to be delivered.  Without it every id
       is remembered; name the RocksDB provider
       (``spark.sql.streaming.stateStore.providerClass``) to keep that state on disk.

Both streams keep their progress in a checkpoint folder under the shared work
folder, so a restarted driver or lost executors resume from the last committed batch.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators import notify as N
from ..operators import staging as ST
from ..sources.store import TableStore

STAGING = "staging.activities"
KEY = "source_activity_id"
#: The order of deliveries: a later file wins, then the file name, then the digest of the document.
DELIVERY = ("delivered_at", "delivered_file", "delivered_digest")


def raw_document_stream(spark: SparkSession, landing: str, max_files: int = 64) -> DataFrame:
    """File-source stream of raw documents (``activity_id, athlete_id, payload, source``) with their delivery."""
    return (spark.readStream.schema(S.RAW_ACTIVITIES_SCHEMA)
            .option("maxFilesPerTrigger", max_files).json(landing)
            .select("*", F.col("_metadata.file_modification_time").alias("delivered_at"),
                    F.col("_metadata.file_name").alias("delivered_file"),
                    F.xxhash64("payload").alias("delivered_digest")))


def latest(rows: DataFrame, key: str = KEY) -> DataFrame:
    """The latest delivery of each key (a partial aggregate on the key)."""
    last = rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(*DELIVERY)).alias("_r"))
    return last.select(*[F.col(key) if c == key else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def to_files(rows: DataFrame, folder: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append the stream's rows to Spark's Parquet file sink."""
    q = rows.writeStream.format("parquet").outputMode("append").option("path", folder).option("checkpointLocation", checkpoint)
    return (q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")).start()


def incremental_flatten(spark: SparkSession, landing: str, folder: str, checkpoint: str,
                        available_now: bool = True, max_files: int = 64) -> StreamingQuery:
    """STR-1: flatten arriving documents into ``folder``."""
    return to_files(ST.flatten_payloads(raw_document_stream(spark, landing, max_files), keep=DELIVERY),
                    folder, checkpoint, available_now)


def staging_activities(spark: SparkSession, folder: str) -> DataFrame:
    """The staging view of STR-1: one row for each activity, as last delivered."""
    return latest(spark.read.parquet(folder)).drop(*DELIVERY)


def snapshot(spark: SparkSession, folder: str, store: TableStore) -> int:
    """The staging view published as a table in day partitions."""
    rows = staging_activities(spark, folder).withColumn("start_day", F.to_date("start_dt"))
    return store.write(rows.repartitionByRange("start_day", KEY), STAGING, partition_by=["start_day"])


def once_each(activities: DataFrame, horizon: str | None = None, key: str = "id_activity") -> DataFrame:
    """The first arrival of each id, by keyed state; ``horizon`` (an interval) bounds the state."""
    if horizon is None:
        return activities.dropDuplicates([key])
    timed = activities.withColumn("_event_time", F.col("start_dt").cast("timestamp")).withWatermark("_event_time", horizon)
    return timed.dropDuplicatesWithinWatermark([key]).drop("_event_time")


def idempotent_delivery(spark: SparkSession, activities: DataFrame, employees: DataFrame, outbox: str, checkpoint: str,
                        channel: str = "#sport", error: str = "no webhook configured", horizon: str | None = None) -> StreamingQuery:
    """STR-2: render each pending activity once, however often it arrives.

    ``activities`` is a streaming DataFrame of staging activities (with
    ``id_activity``); ``employees`` a static frame of staged employees.  An activity
    whose employee is unknown is not delivered and may be when it arrives again."""
    messages = once_each(N.render_messages(activities, employees), horizon)
    return to_files(N.outbox_records(messages, channel, error), outbox, checkpoint)


def write_landing(raw_documents: DataFrame, landing: str) -> None:
    """Land raw documents as JSON-lines files (the stream's input), one for each input partition."""
    raw_documents.write.mode("append").json(landing)
