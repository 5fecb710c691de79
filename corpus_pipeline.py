"""Corpus pipeline: toxicity, line dedup, MinHash near-dedup, benchmark
decontamination, BPE encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame.  ``run`` writes each stage's rows as Parquet to the shared
work folder and reads them back as the next one's ``docs``, so a lost executor
costs no more than its stage.  All stages but the last return the columns of
``documents``; each works on every row that its predecessor kept.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stride.llm.bpe import bpe_stage
from stride.llm.common import read_table, stored
from stride.llm.decontaminate import decontaminate_stage
from stride.llm.line_dedup import line_dedup_stage
from stride.llm.near_dedup import near_dedup_stage
from stride.llm.toxicity import toxicity_stage

STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontaminate_stage),
    ("bpe", bpe_stage),
]

#: Fitted weights and sketches have no SQL form; the tests compare with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
