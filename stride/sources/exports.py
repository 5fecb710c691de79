"""The files a monthly run starts from, in the form their systems export them.

``InputFiles`` names them; ``export_files`` writes them from the driver tables (the
stand-in for the HR and sport systems; it does none of the run's work).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from . import bindings as BD

CSV_OPTS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


@dataclass(frozen=True)
class InputFiles:
    hr: str             # CSV, ordered header (SRC-1)
    sport: str          # CSV, header in any order (SRC-2)
    answers: str        # Parquet (adresse_domicile, answer_m): what the distance service answers
    activities: str     # Parquet of flat activity fields, the feed that becomes raw documents


def hr_csv(hr: DataFrame, path: str) -> None:
    """The HR rows as the HR system exports them: its headers, in order."""
    header = {v: k for k, v in S.HR_COLUMN_MAP.items()}
    hr.select(*[(F.col(c).cast("string") if c.startswith("date_") else F.col(c)).alias(header[c])
                for c in S.HR_COLUMN_MAP.values()]).write.options(header=True, **CSV_OPTS).csv(path)


def sport_csv(rows: DataFrame, path: str) -> None:
    """The sport rows with their two columns in another order than the contract names them."""
    header = {v: k for k, v in S.SPORT_COLUMN_MAP.items()}
    rows.select(F.col("sport_pratique").alias(header["sport_pratique"]), F.col("id_salarie").alias(header["id_salarie"])) \
        .write.options(header=True, **CSV_OPTS).csv(path)


def export_files(spark: SparkSession, sf_dir: str, folder: str) -> InputFiles:
    files = InputFiles(f"{folder}/hr", f"{folder}/sport", f"{folder}/answers", f"{folder}/activities")
    hr = BD.hr_file(BD.table(spark, sf_dir, "customer"))
    events = BD.table(spark, sf_dir, "events")
    hr_csv(hr, files.hr)
    sport_csv(BD.sport_file(events), files.sport)
    hr.select("adresse_domicile", F.col("distance_resolved_m").alias("answer_m")).distinct().write.parquet(files.answers)
    BD.event_activity_fields(events).write.parquet(files.activities)
    return files
