"""A corpus pipeline of five stages, each of which works on all that its predecessor kept.

Stages take (spark, docs, sf_dir) and give the columns of documents; the last gives what the mix takes of each document.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from terrasift.llm import decontaminate, line_dedup, minhash, mixing, quality_model
from terrasift.llm.common import cut, cut_mark, cut_release, small, table


class _Mark(threading.local):
    """From where on this thread's tables are those of the stage that runs."""

    at = 0


_mark = _Mark()


def _begin(spark: SparkSession) -> None:
    """Forget the tables that the stage before has written for itself; its result is written by now."""
    end = cut_mark()
    cut_release(spark, _mark.at, end)
    _mark.at = end


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, doesn't reject."""
    _begin(spark)
    return quality_model.accepted(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has, equal or nearly so."""
    _begin(spark)
    return line_dedup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    _begin(spark)
    return minhash.one_of_each(docs, k=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth stand in benchmark passages."""
    _begin(spark)
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    gone = small(cut(found.where("contaminated").select("doc_id").distinct(), "contaminated"))
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and first_slot of each document."""
    _begin(spark)
    return mixing.mix(docs)


STAGES = [("quality", quality), ("lines", lines), ("near duplicates", near_duplicates), ("benchmark", benchmark), ("mixture", mixture)]

#: Trained, hashed and iterative stages can't be told in SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    _mark.at = cut_mark()
    kept = None
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        if name == STAGES[-1][0]:
            return made
        written = cut(made, "stage-" + name.replace(" ", "-"))
        at = cut_mark()
        cut_release(spark, _mark.at, at - 1)
        if kept is not None:
            cut_release(spark, kept, kept + 1)
        docs, kept, _mark.at = written, at - 1, at
