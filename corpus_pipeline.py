"""From raw documents to encoded training text, in stages.

Each stage works on all its predecessor kept, is written as Parquet and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hotrank.llm.bpe import encoded
from hotrank.llm.mixing import mixed
from hotrank.llm.near_dedup import without_near_copies
from hotrank.llm.substring_dedup import without_repeats
from hotrank.llm.toxicity import drop_toxic
from hotrank.session import as_table, fresh_folder

STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", without_near_copies),
    ("substring_dedup", without_repeats),
    ("mixing", mixed),
    ("bpe", encoded),
]

#: Training and hashing are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = as_table(stage(spark, docs, sf_dir), fresh_folder(spark, f"stage-{name}"))
    return docs
