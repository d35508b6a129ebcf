"""The corpus pipeline: toxic documents go, one document of each group of near copies stays, personal data is replaced, the rest is packed.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the columns of documents.

Edge cases: null and empty texts and rows without a doc_id pass all stages (they are never near copies; a null text is packed as an empty one);
repeated rows are one document after the second stage; an empty table gives an empty result; extra columns of documents pass the first three
stages under their names, whatever they are; texts of any length are worked on whole. Each operator's module states the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import neardup, packing, pii, toxicity
from quern.llm.storage import settled, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("near_duplicates", neardup.stage),
    ("pii_surrogates", pii.stage),
    ("best_fit_packing", packing.stage),
]

#: Trained trees, MinHash and tokenizers aren't SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents; what a stage keeps is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(lambda made=stage, given=docs: made(spark, given, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
