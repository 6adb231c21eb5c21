"""From raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratakit.llm.common import staged
from stratakit.llm.mixing import mixing_stage
from stratakit.llm.near_dedup import dedup_stage
from stratakit.llm.packing import packing_stage
from stratakit.llm.pii import pii_stage
from stratakit.llm.quality import quality_stage

STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_near_dedup", dedup_stage),
    ("pii_surrogates", pii_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]

#: No SQL: the model, the sketches and the tokenizer can't be expressed in it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again.

    Rows: null or blank text goes in the first stage; rows that repeat in text
    are near duplicates, of which one stays; rows that repeat an id, or have
    none, are else rows like others; null sources are a source; no rows give no
    pieces.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
