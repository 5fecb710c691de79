"""E1 — the full benefit run as one Spark driver function.

``run_files(spark, files, params)`` chains the steps of the monthly run: HR and sport
files (header contracts, provenance) -> raw tables -> staging (typed, normalised,
pseudonymised, geo checked) -> raw JSON documents -> flattened activities ->
quality suites -> benefit marts (upsert + change log) -> notifications.  Every step is
a ``monitor.step`` that appends its run-log row, with the four named checks between
them.  Each table is written once, together with a check of its constraints, and
published under its name only when it keeps them (``sources.store``), so a mart
is read while its successor is written, and lineage is cut at every table.
``run(spark, sf_dir, ...)`` exports the driver tables as files first.
"""
from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..operators import benefits as B
from ..operators import constraints as K
from ..operators import merge as M
from ..operators import notify as N
from ..operators import quality as Q
from ..operators import staging as ST
from ..params import BenefitParams
from ..session import configure, work_path
from ..sources import readers as R
from ..sources.exports import CSV_OPTS, InputFiles, export_files
from ..sources.store import TableStore
from .catalog import activity_rules, employee_rules
from .inputs import EVENTS_AS_OF
from .monitor import step

CACHE = "staging.distance_cache"
POSTED = "staging.posted_activities"


@dataclass
class RunResult:
    run_id: str
    store: TableStore
    counts: dict


def current_activities(store: TableStore) -> DataFrame:
    """MRG-4 on read: the staged activities with the delivery state of the posted ids."""
    activities = store.read("staging.activities")
    return N.mark_posted(activities, store.read(POSTED)) if store.exists(POSTED) else activities


class Run:
    """One run over its files; ``counts`` are the rows each table got."""

    def __init__(self, spark: SparkSession, files: InputFiles, params: BenefitParams, store: TableStore):
        self.spark, self.files, self.params, self.store = spark, files, params, store
        self.counts: dict[str, int] = {}
        digest = hashlib.sha1(f"{params.run_id}/{uuid.uuid4().hex}".encode()).hexdigest()[:16]
        self.scratch = f"stride_run_{digest}"  # managed tables of this run, dropped at its end

    def step(self, name: str):
        return step(self.spark, name, self.params.run_id,
                    lambda row: self.store.append(row, "audit.run_log", K.rules("audit.run_log", self.store.read)))

    def write(self, df: DataFrame, table: str, how: str = "write", **kw) -> int:
        self.counts[table] = getattr(self.store, how)(df, table, rules=K.rules(table, self.store.read), **kw)
        return self.counts[table]

    def check(self, name: str) -> None:
        """A named check on the written tables; its outcomes go to the run log."""
        with self.step(f"check_{name}") as ctx:
            outcomes = Q.run_check(name, self.store.read, self.params.as_of, raise_on_failure=False).collect()  # a row per gate
            ctx.message = "; ".join(f"{r.check_name}: observed {r.observed}, expected {r.expected}" for r in outcomes)
            if not all(r.success for r in outcomes):
                raise Q.QualityError(f"check {name} failed: {ctx.message}")

    def extract_hr(self) -> None:
        with self.step("extract_rh_read"):
            hr = R.scan_hr_file(self.spark, self.files.hr, "csv", loaded_at=self.params.as_of, options=CSV_OPTS)
        with self.step("extract_rh_load_raw") as ctx:
            ctx.rows_out = self.write(hr, "raw.employees", "refresh")
        with self.step("extract_rh_to_staging") as ctx:
            ctx.rows_in = self.counts["raw.employees"]
            unchecked = {"distance_domicile_m": F.lit(None).cast("int"), "is_declaration_suspect": F.lit(False)}
            staged = ST.stage_employees(self.store.read("raw.employees"), self.params)
            ctx.rows_out = self.write(staged.withColumns(unchecked), "staging.employees", "refresh")

    def validate_geo(self) -> None:
        """JON-8 -> MRG-2 -> JON-9 -> PRJ-19: commute distances from the cache; misses are
        answered, upserted into the cache, and the employees updated by key.
        Unresolved ones stay NULL, and their declaration is suspect."""
        keys = ["address_hash", "mode"]
        staged = self.store.read("staging.employees")
        mode = F.try_element_at(C.literal_map(S.ACTIVE_MODE_ROUTING), F.col("moyen_deplacement"))
        with self.step("validate_geo_load") as ctx:
            requests = staged.filter(C.is_active_commute("moyen_deplacement")).select(
                "id_employee", "adresse_domicile", C.address_hash("adresse_domicile").alias("address_hash"), mode.alias("mode"))
            cache = self.store.read(CACHE) if self.store.exists(CACHE) else self.spark.createDataFrame([], S.DISTANCE_CACHE_SCHEMA)
            looked = ST.written(M.cache_lookup(requests, cache, keys), self.scratch)
            ctx.rows_in, ctx.rows_out = self.counts["staging.employees"], looked.count()
        with self.step("validate_geo_resolve") as ctx:
            answers = self.spark.read.parquet(self.files.answers).groupBy("adresse_domicile").agg(F.min("answer_m").alias("answer_m"))
            answered = ST.written(looked.join(answers, "adresse_domicile", "left"), self.scratch)
            resolved = (answered.filter(~F.col("cache_hit") & F.col("answer_m").isNotNull())
                        .select(*keys, F.col("answer_m").alias("distance_m"),
                                F.floor(F.col("answer_m") * 3 / 10).cast("int").alias("duration_s"),
                                F.lit(self.params.as_of).cast("timestamp_ntz").alias("resolved_at"))
                        .dropDuplicates(keys))
            ctx.rows_in = answered.filter(~F.col("cache_hit")).count()
            ctx.rows_out = self.write(M.upsert(cache, resolved, keys), CACHE)
        with self.step("validate_geo_persist") as ctx:
            found = answered.select("id_employee", F.when(F.col("cache_hit"), F.col("distance_m"))
                                    .otherwise(F.col("answer_m")).alias("distance_domicile_m"))
            updated = M.update_by_key(staged, found, ["id_employee"], ["distance_domicile_m"])
            checked = ST.apply_geo(updated, self.params, distance_col="distance_domicile_m").select(*staged.columns)
            ctx.rows_in = self.counts["staging.employees"]
            ctx.rows_out = self.write(checked, "staging.employees")

    def extract_sport(self) -> None:
        with self.step("extract_sport_read"):
            sport = R.scan_sport_file(self.spark, self.files.sport, "csv", loaded_at=self.params.as_of, options=CSV_OPTS)
        with self.step("extract_sport_load_raw") as ctx:
            ctx.rows_out = self.write(sport, "raw.sports", "refresh")
        with self.step("extract_sport_to_staging") as ctx:
            ctx.rows_in = self.counts["raw.sports"]
            sports = ST.stage_sports(self.store.read("raw.sports"), self.store.read("staging.employees"))
            if self.store.exists("staging.sports_practice"):
                sports = M.insert_if_absent(self.store.read("staging.sports_practice"), sports, ["id_employee", "sport_pratique"])
            ctx.rows_out = self.write(sports, "staging.sports_practice")

    def load_activities(self) -> None:
        with self.step("load_raw_activities") as ctx:
            docs = ST.build_payloads(self.spark.read.parquet(self.files.activities))
            ctx.rows_out = self.write(docs, "raw.activities", "refresh")
        with self.step("transform_activities") as ctx:
            if self.counts["raw.activities"] == 0:  # SNK-3, on the count observed at load
                raise ST.EmptyInputError("raw.activities is empty — load it first")
            ctx.rows_in = self.counts["raw.activities"]
            flat = ST.flatten_payloads(self.store.read("raw.activities"), with_id=True, scratch=self.scratch)
            ctx.rows_out = self.write(flat.withColumn("start_day", F.to_date("start_dt")), "staging.activities",
                                      partition_by=["start_day"])

    def quality(self, report_dir: str, report_copy: str | None, stop: bool) -> None:
        """Each suite is a step; its report is written before a failure raises (SNK-6)."""
        employees = self.store.read("staging.employees")
        acts = self.store.read("staging.activities").withColumn(
            "elapsed_s", F.timestamp_diff("SECOND", F.col("start_dt"), F.col("end_dt")).cast("int"))
        suites = {
            "employees": (employees, employee_rules()),
            "activities": (acts, [*activity_rules(self.params.as_of), Q.in_set("sport_type", S.SPORTS)]),
        }
        for name, suite in suites.items():
            with self.step(f"quality_{name}") as ctx:
                try:
                    Q.run_suites({name: suite}, f"{report_dir}/{name}", f"{report_copy}/{name}" if report_copy else None)
                except Q.QualityError as e:
                    ctx.fail(str(e))  # the row says FAIL; the run stops only when asked to
                    if stop:
                        raise

    def mart(self, name: str, new: DataFrame) -> None:
        """Upsert a mart and log its changes; the new rows are computed once.  A mart that
        does not exist yet is an empty one: its rows are logged as inserts."""
        table = f"marts.eligibility_{name}"
        with self.step(f"compute_{name}") as ctx:
            new = ST.written(new, self.scratch)
            before = self.store.read(table) if self.store.exists(table) else self.spark.createDataFrame([], new.schema)
            ctx.rows_in = self.counts["staging.employees"]
            ctx.rows_out = self.write(M.upsert(before, new, ["id_employee"]), table)
            changes = M.change_log_from_merge(before, new, "id_employee", table, self.params.as_of, "stride")
            changes = changes.select("changed_at", "changed_by", "table_name", "operation", "id_employee",
                                     F.to_json("old_data").alias("old_data"), F.to_json("new_data").alias("new_data"))
            self.write(changes, "audit.eligibility_changes", "append")

    def notify(self, limit: int, mark: bool) -> None:
        with self.step("notify_fetch_pending") as ctx:
            messages = N.render_messages(current_activities(self.store), self.store.read("staging.employees"))
            batch = ST.written(messages.orderBy(F.desc("start_dt"), "id_activity").limit(limit), self.scratch)  # a top-k report
            ctx.rows_out = batch.count()
        with self.step("notify_post") as ctx:
            records = N.outbox_records(batch, "#sport", "no webhook configured")
            ctx.rows_out = self.counts["posted"] = self.store.append(records, "audit.outbox")
            # undelivered messages also go to the JSON-lines outbox (SNK-5)
            N.append_outbox(records.select("payload", "error"), f"{self.store.root}/outbox_jsonl")
        with self.step("notify_mark_posted") as ctx:
            if mark:
                ctx.rows_out = self.write(N.posted_rows(batch, self.params.run_id, self.params.as_of), POSTED, "append")


def run_files(spark: SparkSession, files: InputFiles, params: BenefitParams, store: TableStore | None = None,
              post_limit: int = 50, report_dir: str | None = None, report_copy: str | None = None,
              fail_on_quality: bool = True, mark_undelivered: bool = True) -> RunResult:
    """One monthly run.  No message is actually sent (there is no chat
    service here): every rendered message goes to the outbox as undelivered
    and, as in the source system, is still marked posted unless
    ``mark_undelivered`` is False."""
    configure(spark)  # UTC session zone: wall-clock UTC timestamps throughout
    run = Run(spark, files, params, store or TableStore(spark))
    spark.sql(f"CREATE DATABASE {run.scratch} LOCATION '{work_path(spark, 'tmp', run.scratch)}'")
    try:
        run.extract_hr()
        run.validate_geo()
        run.check("employees_loaded")
        run.extract_sport()
        run.check("sports_practice_loaded")
        run.load_activities()
        run.check("activities_generated")
        run.quality(report_dir or work_path(spark, "reports", params.run_id, "quality"), report_copy, fail_on_quality)
        read = run.store.read
        run.mart("prime", B.compute_prime(read("staging.employees"), params))
        run.mart("wellbeing", B.compute_wellbeing(read("staging.employees"), read("staging.activities"), params))
        run.check("advantages_computed")
        run.notify(post_limit, mark_undelivered)
    finally:
        spark.sql(f"DROP DATABASE {run.scratch} CASCADE")
    c = run.counts
    c.update(employees=c["staging.employees"], sports=c["staging.sports_practice"], raw_activities=c["raw.activities"],
             activities=c["staging.activities"], prime=c["marts.eligibility_prime"])
    return RunResult(params.run_id, run.store, c)


def run(spark: SparkSession, sf_dir: str, params: BenefitParams, store: TableStore | None = None, **options) -> RunResult:
    """A monthly run over the driver tables, exported as files first."""
    files = export_files(spark, sf_dir, work_path(spark, "exports", uuid.uuid4().hex))
    return run_files(spark, files, params, store, **options)


__all__ = ["run", "run_files", "RunResult", "EVENTS_AS_OF"]
