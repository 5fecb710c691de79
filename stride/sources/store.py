"""Layered Parquet tables under names of Spark's catalog (SNK-1, SNK-2, SNK-7,
and the write step of every MRG-*).

A refresh is one plain Parquet write into a fresh folder; the table's name is a
view over the folder that was published last (``CREATE OR REPLACE VIEW``), so the
old rows stay readable while the new ones are written, a job may read the table it
is about to replace, and rows that fail their constraints are never published.  An
append is a plain Parquet append to the published folder (which the view's comment
names).  A table has one writer at a time.

The names live in the session's catalog: a metastore on a cluster, the in-memory
catalog in tests.  The folders lie under ``root`` (default: ``tables`` in the shared
work folder); earlier folders of a table are left to the storage's retention rules.
"""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from ..operators import quality as Q
from ..session import work_path

# Reloading a parent table empties these dependents (TRUNCATE ... CASCADE).
DEFAULT_CASCADE: Mapping[str, Sequence[str]] = {
    "staging.employees": ("staging.sports_practice", "staging.activities", "staging.posted_activities",
                          "marts.eligibility_prime", "marts.eligibility_wellbeing"),
    "raw.activities": ("staging.activities", "staging.posted_activities"),
}


class TableStore:
    def __init__(self, spark: SparkSession, root: str | None = None,
                 cascade: Mapping[str, Sequence[str]] = DEFAULT_CASCADE):
        self.spark = spark
        self.root = (root or work_path(spark, "tables")).rstrip("/")
        self.cascade = cascade
        #: databases of this root; the same root finds the same names again
        self.prefix = "stride_" + hashlib.sha1(self.root.encode()).hexdigest()[:10]

    def name(self, qualified: str) -> str:
        """The catalog name of ``layer.table``."""
        layer, table = qualified.split(".", 1)
        return f"{self.prefix}_{layer}.{table}"

    def folder(self, qualified: str, part: str) -> str:
        return f"{self.root}/{qualified.replace('.', '/', 1)}/{part}"

    def exists(self, qualified: str) -> bool:
        database = self.name(qualified).split(".")[0]
        return self.spark.catalog.databaseExists(database) and self.spark.catalog.tableExists(self.name(qualified))

    def read(self, qualified: str) -> DataFrame:
        if not self.exists(qualified):
            raise FileNotFoundError(f"table {qualified} was never published under {self.root}")
        return self.spark.table(self.name(qualified))

    def publish(self, qualified: str, folder: str) -> None:
        """From now on ``qualified`` is what lies in ``folder``."""
        name = self.name(qualified)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{folder}' AS SELECT * FROM parquet.`{folder}`")

    def write(self, df: DataFrame, qualified: str, partition_by: Sequence[str] = (),
              rules: Sequence[Q.Rule] = ()) -> int:
        """SNK-1 and QLT-13..17 on write: a full refresh; returns the rows written.

        Row rules are counted in the pass that writes the rows; keys are checked on the
        written key columns.  A table that breaks a rule is left unpublished."""
        folder = self.folder(qualified, uuid.uuid4().hex)
        seen = Observation()
        out = df.observe(seen, *Q.row_measures(rules)).write
        if partition_by:
            out = out.partitionBy(*partition_by)
        out.parquet(folder)
        broken = Q.broken_rows(seen.get, rules)
        keys = [r for r in rules if r.kind in Q.KEY_KINDS]
        if keys:
            report = Q.evaluate(self.spark.read.parquet(folder), keys, qualified)
            broken += [(r.rule, r.column_name, r.unexpected_count) for r in report.where("not success").collect()]  # a row per rule
        if broken:
            raise Q.ConstraintError(qualified, broken)
        self.publish(qualified, folder)
        return int(seen.get["n"])

    def append(self, df: DataFrame, qualified: str, rules: Sequence[Q.Rule] = ()) -> int:
        """SNK-7: rows added to the table; a row that breaks a rule fails the job
        before its committer makes any of its rows visible."""
        there = self.exists(qualified)
        folder = self.spark.catalog.getTable(self.name(qualified)).description if there else self.folder(qualified, uuid.uuid4().hex)
        seen = Observation()
        Q.enforced(df, rules, qualified).observe(seen, *Q.row_measures(())).write.mode("append").parquet(folder)
        if not there:
            self.publish(qualified, folder)
        return int(seen.get["n"])

    def empty(self, qualified: str, schema: T.StructType) -> None:
        self.write(self.spark.createDataFrame([], schema), qualified)

    def refresh(self, df: DataFrame, qualified: str, rules: Sequence[Q.Rule] = ()) -> int:
        """SNK-1 + SNK-2: reload a table; its dependents are emptied (the reload's
        TRUNCATE ... CASCADE) before the new rows are published, so no reader joins
        them to rows of the old load."""
        for dep in self.cascade.get(qualified, ()):
            if self.exists(dep):
                self.empty(dep, self.read(dep).schema)
        return self.write(df, qualified, rules=rules)
