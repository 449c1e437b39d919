"""The corpus pipeline: from documents to a mix of clean, distinct, uncontaminated ones.

Each stage is a function of (spark, docs, sf_dir); what it returns is written as a table and read back as the next one's
docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstruct.llm import decontaminate, langid, mixing, quality, simhash
from docstruct.llm.common import fresh, materialize, table

#: Documents that a language model of the corpus finds less likely than this, or that cost more bits per byte, go.
LANGUAGE_SCORE, LANGUAGE_BITS = 0.3, 7.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, thinks good. Without labels all stay."""
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    (score,) = fresh(docs, "_score")
    return quality.score(docs, weights, out=score).where(F.col(score) >= 0.5).drop(score)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that docs name: those without letters, and those that no language explains, go.

    If docs name no language there is nothing to tell by, and all stay.
    """
    model = langid.train(docs)
    if not model.langs:
        return docs
    (out,) = fresh(docs, "_found")
    found = langid.predict(docs, model, out=out)
    said = F.col(out)
    return found.where((said["lang_pred"] != langid.UNKNOWN) & (said["score"] >= LANGUAGE_SCORE) & (said["bits_per_byte"] <= LANGUAGE_BITS)).drop(out)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    (out,) = fresh(docs, "_held")
    return decontaminate.held(docs, table(spark, sf_dir, "benchmark"), out=out).where(F.col(out) == 0).drop(out)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes something, with their words, their source's target and the words taken, repeats counted.

    These three replace columns of docs that are called so.
    """
    found = mixing.plan(docs, carry=True).where("taken > 0")
    own = {"n_words": F.col("size"), "source_target": F.col("target"), "taken": F.col("taken")}
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in own]
    return found.select(*kept, *[x.alias(c) for c, x in own.items()])


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("SimHash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing to target weights", mixing_stage),
]

#: Trained models and hashes aren't within SQL's reach; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
