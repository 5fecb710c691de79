"""Command line: one monthly run over a folder of input tables.

    python -m stride --sf-dir /root/testdata/sf0.01 --rate 0.05 --threshold 15 \
        --as-of 2024-01-31 --post-limit 50 --salt ...

Uses the submitted settings as they are (on a cluster ``spark.checkpoint.dir``
must name a shared folder); only unset ones get a default.
"""
from __future__ import annotations

import argparse
import datetime as dt
import json
import os
from decimal import Decimal

from pyspark.sql import SparkSession

from .params import BenefitParams
from .plans.monitor import new_run_id
from .plans.monthly_run import run
from .session import submitted_session


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="stride", description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", required=True, help="folder holding the input parquet tables")
    ap.add_argument("--rate", default="0.05", help="bonus rate, 0..1")
    ap.add_argument("--threshold", type=int, default=15, help="activities needed for wellbeing days")
    ap.add_argument("--as-of", default=None, help="run date (YYYY-MM-DD); default today (UTC)")
    ap.add_argument("--post-limit", type=int, default=50)
    ap.add_argument("--salt", default=os.environ.get("STRIDE_SALT"), help="salt of the pseudonyms (or STRIDE_SALT)")
    ap.add_argument("--keep-going", action="store_true", help="do not stop on failed quality suites")
    a = ap.parse_args(argv)
    if not a.salt:
        ap.error("name a salt: --salt or STRIDE_SALT")
    as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else \
        dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, hour=0, minute=0, second=0, microsecond=0)
    params = BenefitParams(prime_rate=Decimal(a.rate), wellbeing_threshold=a.threshold,
                           as_of=as_of, pii_salt=a.salt, run_id=new_run_id())
    spark = SparkSession.getActiveSession() or submitted_session()
    res = run(spark, a.sf_dir, params, post_limit=a.post_limit, fail_on_quality=not a.keep_going)
    out = {"run_id": res.run_id, "tables": res.store.root, **res.counts}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
