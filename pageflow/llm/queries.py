"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.functions.running import scratch_path
from pageflow.llm import bpe, decontaminate, exactdedup, filteraudit, mixing, nearcopies, periodicruns, pitmanyor, pseudonyms, quality, sharding, tokencounts, warc
from pageflow.llm.common import table

TOKENIZER = "word_bpe_49k.json"
BPE_TOKENIZER = "byte_bpe_50k.json"
PSEUDONYM_KEY = b"a key for tests; production passes its own"
MIX_WEIGHTS = {"clean": 0.9, "low": 0.06, "toxic": 0.04}


def op1_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms for their personal data."""
    done = pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    kinds = F.array_join(F.array_sort(F.array_distinct(F.col("spans")["kind"])), ",")
    return done.select("doc_id", "text", F.size("spans").alias("n_values"), kinds.alias("kinds"), (F.size("spans") > 0).alias("changed"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, through a cache of this run's own."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return tokencounts.token_counts(docs, public_tokenizers.path(TOKENIZER), scratch_path(spark, "token-cache"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates among all documents; the largest id stays."""
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in all documents."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("_id", "doc_id")


def op5_mixing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents for target weights of the labelled domains."""
    rates = mixing.mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), MIX_WEIGHTS)
    return rates.select(F.col("_id").alias("doc_id"), "words", *[f"p_{c}" for c in MIX_WEIGHTS], "rate", "copies")


def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies among all documents, at a similarity of 0.85."""
    near = nearcopies.near_copies(table(spark, sf_dir, "documents"), percent=85)
    return near.select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("n_shingles"),
        "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    folder = scratch_path(spark, "warc")
    records = warc.typed_records(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    manifest = warc.write_archives(records, folder)
    return warc.digests(warc.read_archives(spark, manifest, folder))


def op8_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row counts, equal texts together."""
    return sharding.balanced_shards(table(spark, sf_dir, "documents"), shards=24)


def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents from their words, hosts (sources) and paths (source and language)."""
    scored = quality.site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumnRenamed("_id", "doc_id").drop("_digest")


def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under a bigram model of those whose crc32(doc_id) mod 7 is not 2."""
    return pitmanyor.scores(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents at each step of all 120 orders, per language."""
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all documents, a tenth of which is made periodic by the rule on their ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", periodicruns.planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodicruns.periodic_runs(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(
        F.col("_id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-longest["s"]).alias("start"),
        longest["length"].alias("length"),
        (-longest["p"]).alias("period"),
        F.floor(1000 * longest["length"] / -longest["p"]).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the distinct-word table, and decoded again."""
    import public_tokenizers

    done = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_TOKENIZER), decode=True)
    return done.select(
        F.col("_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    name: query for name, query in globals().items() if name.startswith("op") and name[2].isdigit() and callable(query)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
