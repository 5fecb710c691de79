"""Run monitoring: run id, step wrapper, run-log rows (MON-1, MON-2, SNK-7).

A step measures its duration, carries rows in/out set by the caller (counts
that the step's own actions produced, e.g. through ``Observation``), sets a
status OK / WARN / FAIL and an error text, appends ONE run-log row, and
re-raises any error.  The run log is a tiny append-only table; its row is
a row of literals, which is the only driver-side data here.
"""
from __future__ import annotations

import datetime as dt
import os
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

RUN_ID_ENV = "STRIDE_RUN_ID"


def new_run_id() -> str:
    """MON-2: run id from the environment, else generated (once per run)."""
    return os.environ.get(RUN_ID_ENV) or f"local-{uuid.uuid4().hex[:12]}"


@dataclass
class StepContext:
    name: str
    run_id: str
    rows_in: int | None = None
    rows_out: int | None = None
    status: str = "OK"
    message: str | None = None

    def warn(self, message: str) -> None:
        self.status, self.message = "WARN", message

    def fail(self, message: str) -> None:
        """FAIL without an exception: the row says FAIL, the caller raises later."""
        self.status, self.message = "FAIL", message


def run_log_row(ctx: StepContext, started: dt.datetime, duration_ms: int) -> tuple:
    return (ctx.run_id, ctx.name, ctx.status, ctx.rows_in, ctx.rows_out, int(duration_ms),
            ctx.message, started)


@contextmanager
def step(spark: SparkSession, name: str, run_id: str, sink=None):
    """MON-1: ``with step(spark, "flatten", run_id, store_append) as ctx: ...``.

    ``sink(df)`` receives the one-row run-log DataFrame (e.g. a
    ``TableStore.append`` bound to ``audit.run_log``); without a sink the row
    is only kept on ``ctx.row``.
    """
    ctx = StepContext(name, run_id)
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    t0 = time.perf_counter()
    error: BaseException | None = None
    try:
        yield ctx
    except BaseException as e:  # noqa: BLE001 - recorded, then re-raised
        error = e
        ctx.status = "FAIL"
        ctx.message = f"{type(e).__name__}: {e}"
    finally:
        row = run_log_row(ctx, started, (time.perf_counter() - t0) * 1000)
        ctx.row = row  # type: ignore[attr-defined]
        if sink is not None:
            literals = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, S.RUN_LOG_SCHEMA_NTZ.fields)]
            sink(spark.range(0, 1, 1, 1).select(*literals))
    if error is not None:
        raise error
