"""A corpus pipeline of five training-data stages, each over all rows that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gneiss.llm import mixing, ngram, packing, suffix
from gneiss.llm import toxicity as tox
from gneiss.llm.common import forget, intermediates, unused, written
from gneiss.llm.queries import table

THRESHOLD = 0.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below THRESHOLD; the model is fitted on labelled ones of them that are not held out.

    Null, empty and wordless texts say nothing and stay; repeated rows and null keys are scored like any others; columns of
    whatever names stay as they are; an empty table stays empty.
    """
    model = tox.fit(docs, table(spark, sf_dir, "labels"))
    score = unused("toxicity", docs)
    kept = tox.scored(docs, model, score=score)
    return kept.where(kept[score] < THRESHOLD).drop(score)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates.

    Null or blank texts and rows without a key all stay; of rows that repeat a key and a text one stays, rows that share a
    key but not the text are told apart (`ngram.keep_one`); an empty table stays empty.
    """
    return ngram.keep_one(docs, ngram.jaccard_join(docs))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occurred before are cut out; documents that hold nothing else go.

    Null, empty and short texts and rows without a key stay as they are; rows of one key count as one document, the earlier
    of which keeps the passage; an empty table stays empty.
    """
    return suffix.without_passages(docs, suffix.repeated_passages(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources again up to the repetition limit, in the order of the mix's blocks.

    Null sources are one source; null texts weigh one token; repeated rows are passed over alike; an empty table stays
    empty. What is written from the result keeps its order, so that packing fills its sequences from the mix.
    """
    return mixing.in_mix_order(docs, mixing.mixing_plan(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and where they lie; null and empty texts are the end id alone, repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [("toxicity", toxicity), ("ngram_jaccard", ngram_jaccard), ("suffix_dedup", suffix_dedup), ("mixing", mix_sources), ("packing", pack)]

#: SQL can express neither the trained model nor the sort of suffixes; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each over what the one before wrote; a stage's intermediate tables go when it is done."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with intermediates() as kept:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
            kept.append(docs)
        if before is not None:
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
