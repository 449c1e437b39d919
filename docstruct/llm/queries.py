"""Driver queries of this subpackage: name -> function of (spark, sf_dir), and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, fingerprint, langid, licenses, lm, mixing, quality, simhash, warc
from .common import crc_mod, materialize, table


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.plan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "source", "size", "source_size", "target", "taken")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.coalesce(crc_mod(F.col("doc_id"), 5), F.lit(-1))
    model = langid.train(docs.where(fold != 0))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold == 0).alias("held_out"), "_lang.lang_pred", "_lang.score", "_lang.bits_per_byte")


def op3_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = materialize(lm.counted(docs))
    named, counts = lm.vocabulary(docs, tokens=tokens)
    share = lm.shares(tokens, named)
    encoded = materialize(lm.encode(docs, named, share=share).drop("text"))
    found = lm.score(encoded, lm.train(encoded, counts), share=share)
    mean = F.when(F.col("_lm.n_tokens") > 0, F.col("_lm.log_prob") / F.col("_lm.n_tokens"))
    return found.select("doc_id", "_lm.n_tokens", "_lm.log_prob", mean.alias("mean_log_prob"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fingerprint.colliding(docs)
    clashes = None if found.isEmpty() else found
    rows = fingerprint.beside(docs).withColumn("_edited", fingerprint.edited(F.col("_text"), F.col("_next")))
    for c in ("_text", "_edited", "_next"):
        rows = fingerprint.resolve(rows.withColumn(f"_canon{c}", fingerprint.canonical(F.col(c))), clashes, f"_canon{c}", f"_print{c}")

    def like(other: str):
        same = F.when(F.col("_print_text") == F.col(f"_print{other}"), F.col("_canon_text") == F.col(f"_canon{other}")).otherwise(False)
        return same.cast("double")

    return rows.select(
        F.col("_id").alias("doc_id"), F.char_length("_text").cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"),
        F.col("_print_text").alias("fingerprint"), F.col("_print_edited").alias("edited_fingerprint"),
        like("_edited").alias("near_edited"), like("_next").alias("near_next"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")), "_key", out="page_id")
    return found.withColumn("block_bytes", F.octet_length("block").cast("long"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.coalesce(crc_mod(F.col("doc_id"), 3), F.lit(-1))
    weights = quality.train(docs, table(spark, sf_dir, "labels").where(fold != 1))
    found = quality.score(docs, weights)
    return found.select("doc_id", (fold == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("_fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))
    size = F.coalesce(F.octet_length("text").cast("long"), F.lit(0))
    return found.select("doc_id", size.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > bpe.LIMIT).alias("over_limit"))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_language": op2_language,
    "op3_pseudo_likelihood": op3_pseudo_likelihood,
    "op4_fingerprint": op4_fingerprint,
    "op5_warc": op5_warc,
    "op6_quality": op6_quality,
    "op7_decontaminate": op7_decontaminate,
    "op8_simhash": op8_simhash,
    "op9_licences": op9_licences,
    "op10_tokens": op10_tokens,
}
SQL: dict[str, str] = {"op1_mix": mixing.duckdb_sql(), "op9_licences": licenses.duckdb_sql()}
