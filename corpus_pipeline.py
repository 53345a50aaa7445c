"""Corpus pipeline: documents -> quality rules -> line dedup -> near-dedup -> decontamination -> packed sequences.

Each stage is one operator of ``critica.llm`` applied to everything its predecessor kept; stage outputs are Parquet
tables in the shared checkpoint folder. The first four stages return the columns of ``documents``; the last returns the
token pieces with their sequences. Empty inputs give empty outputs of the same schema in every stage; null texts fail the
quality stage; extra columns pass through the first four stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from critica.llm.common import read, stored
from critica.llm.decontaminate import drop_contaminated
from critica.llm.line_dedup import drop_recurring_lines
from critica.llm.packing import best_fit_packing
from critica.llm.quality import keep_quality
from critica.llm.simhash_dedup import drop_near_duplicates
from critica.session import clean_scratch, scratch_mark


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the base rules or their group's fences reject go."""
    return keep_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: lines of recurring templates go, but for their first occurrence; n_chars follows the new text."""
    return drop_recurring_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each SimHash component stays."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a benchmark item go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: token pieces of the remaining documents with their sequences."""
    import public_tokenizers

    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("rid")


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("simhash_near_dedup", near_dedup),
          ("benchmark_decontamination", decontaminate), ("best_fit_packing", packing)]

ORACLE_SQL = None  # template trees, XXH64 fingerprints and tokenisation are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole ``documents`` table. A stage's intermediate tables go when its result is
    written, and its input goes with them."""
    docs = read(spark, sf_dir, "documents")
    mark = scratch_mark()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        clean_scratch(spark, mark, (f"stage-{name}",))
    return docs
