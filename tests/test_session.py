"""The work folder comes from spark.checkpoint.dir when the session names one."""
from stride.session import ensure_work_dir, work_path
from stride.sources.store import TableStore


def test_work_folder_from_checkpoint_dir(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured and ensure_work_dir(spark) == configured.rstrip("/")
    assert work_path(spark, "tables", "x").startswith(configured.rstrip("/") + "/tables")
    assert TableStore(spark).root.startswith(configured.rstrip("/"))


def test_submitted_settings_are_kept(tmp_path):
    """Master, work folder and shuffle partitions as submitted; only unset ones get defaults."""
    import os
    import subprocess
    import sys

    code = ("from stride.session import submitted_session, work_path\n"
            "s = submitted_session()\n"
            "print('GOT', s.sparkContext.master, work_path(s, 'x'), s.conf.get('spark.sql.shuffle.partitions'),"
            " s.conf.get('spark.sql.session.timeZone'))")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": f"--master local[2] --conf spark.checkpoint.dir={tmp_path}/work "
                                               "--conf spark.sql.shuffle.partitions=7 pyspark-shell",
                        "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120).stdout
    assert f"GOT local[2] {tmp_path}/work/x 7 UTC" in out, out
