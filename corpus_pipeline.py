"""A corpus from documents: quality rules, line dedup, near copies, mixing, piece ids.

Each stage gets all rows that the one before kept, as a table in the shared folder. A stage's own tables go when the next one starts, for by
then its result has been written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillon.llm import common, line_dedup, mixing, ngram_join, pieces, quality_rules

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_MADE: list[str] = []


def _after_the_last(stage: Stage) -> Stage:
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.delete(spark, _MADE)
        with common.listing() as made:
            out = stage(spark, docs, sf_dir)
        _MADE[:] = made
        return out

    return run


STAGES = [
    ("quality_rules", _after_the_last(quality_rules.quality_stage)),
    ("line_dedup", _after_the_last(line_dedup.line_stage)),
    ("ngram_join", _after_the_last(ngram_join.near_copy_stage)),
    ("mixing", _after_the_last(mixing.mixing_stage)),
    ("pieces", _after_the_last(pieces.pieces_stage)),
]

#: Piece ids can't be had in SQL; tests/llm holds run()'s rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.cut(stage(spark, docs, sf_dir), name)
    return docs
