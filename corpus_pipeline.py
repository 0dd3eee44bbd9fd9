"""Corpus pipeline over ``documents``.

Each stage works on all rows that its predecessor kept.  ``run`` writes every
stage's result as Parquet below the shared checkpoint folder and reads it
again, so a lost executor re-reads files instead of recomputing stages.

1. toxicity: documents that the classifier rejects go.
2. line_dedup: repeated passages are cut out of the texts; every row stays.
3. ngram_jaccard: one document of each near-duplicate group stays.
4. decontaminate: documents that hold a benchmark item go.
5. byte_bpe: token ids and digests of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.bpe import stage_byte_bpe
from ledgerlake.llm.common import scratch, table
from ledgerlake.llm.decontaminate import stage_decontaminate
from ledgerlake.llm.line_dedup import stage_line_dedup
from ledgerlake.llm.ngram_join import stage_ngram_jaccard
from ledgerlake.llm.toxicity import stage_toxicity

STAGES = [
    ("toxicity", stage_toxicity),
    ("line_dedup", stage_line_dedup),
    ("ngram_jaccard", stage_ngram_jaccard),
    ("decontaminate", stage_decontaminate),
    ("byte_bpe", stage_byte_bpe),
]

#: The stages run trained models and byte-level work that SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
