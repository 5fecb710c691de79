"""Activity notifications: pending selection, rendering, delivery state
(JON-2, PRJ-20..23, PRJ-28, MRG-4, SNK-5)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def pending(activities: DataFrame) -> DataFrame:
    """PRJ-23: activities not yet posted."""
    return activities.filter(F.col("posted_to_slack") == F.lit(False))


def render_messages(activities: DataFrame, employees: DataFrame) -> DataFrame:
    """JON-2 + PRJ-20/21/22: one message per pending activity.

    The join is on the employee key; the employee side is a two-column
    projection, which adaptive execution broadcasts only when its measured
    size is under the broadcast threshold and otherwise sort-merge joins.
    The template is chosen by the activity key, so a re-run renders the
    same text.
    """
    people = employees.select("id_employee", "nom", "prenom")
    rows = pending(activities).join(people, "id_employee")
    text = C.activity_message("id_activity", "prenom", "nom", "sport_type", "distance_m",
                              C.elapsed_seconds("start_dt", "end_dt"), "comment")
    return rows.select("id_activity", "id_employee", "start_dt", text.alias("text"))


def posted_rows(messages: DataFrame, run_id: str, posted_at: dt.datetime) -> DataFrame:
    """The delivery state that a run adds: one row for each message it posted."""
    return messages.select("id_activity", F.lit(run_id).alias("run_id"),
                           F.lit(posted_at).cast("timestamp_ntz").alias("posted_at"))


def mark_posted(activities: DataFrame, delivered: DataFrame, key: str = "id_activity") -> DataFrame:
    """MRG-4 + PRJ-28: the activities with ``posted_to_slack`` set for the keys in ``delivered``.

    Merge on read: ``delivered`` is the append-only table of posted ids
    (``posted_rows``), joined whenever activities are read, so a run writes as many
    rows as it posts and not the activity table.  The next refresh of the activities
    empties it, or writes this view to fold it in.  The key set is a DataFrame
    (left join with a marker), so it can be as large as the activity table.
    """
    hits = delivered.select(key).distinct().withColumn("_hit", F.lit(True))
    return (activities.join(hits, key, "left")
            .withColumn("posted_to_slack",
                        F.when(F.col("_hit"), F.lit(True)).otherwise(F.col("posted_to_slack")))
            .drop("_hit"))


def outbox_records(messages: DataFrame, channel: str, error: str) -> DataFrame:
    """SNK-5: undelivered messages as ``{payload: {text, channel}, error}`` rows."""
    return messages.select(
        F.struct(F.col("text"), F.lit(channel).alias("channel")).alias("payload"),
        F.lit(error).alias("error"),
        F.col("id_activity"),
    )


def append_outbox(records: DataFrame, path: str) -> None:
    """SNK-5: JSON-lines append."""
    records.write.mode("append").json(path)
