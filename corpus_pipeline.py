"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before
kept and returns a DataFrame, which is written and read again as the next one's
docs.  All but the last return the columns of documents.

* ``quality``: documents that the classifier rejects go.
* ``line_dedup``: cross-site boilerplate lines go but for their first place, and so
  do documents of which nothing is left.
* ``near_duplicates``: one row, of those with the smallest id, stays of each class
  of documents that links of similarity 0.8 or more connect.
* ``mixing``: documents as often as the mix of the sources takes them (0 to 2 times).
* ``packing``: one row per piece of a document, with its sequence and offset.

Empty tables, NULLs, repeated rows and other columns are treated as the operators
of ``saleslens.llm`` say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saleslens.llm.chosen_path import dedup_stage
from saleslens.llm.common import Scratch, read
from saleslens.llm.line_spread import line_stage
from saleslens.llm.mixing import mixing_stage
from saleslens.llm.packing import packing_stage
from saleslens.llm.quality_mil import quality_stage

STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: No SQL: the classifier is trained and the tokeniser is a library; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; a stage's table is deleted when the next one is written."""
    scratch, docs, before = Scratch(spark), read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
