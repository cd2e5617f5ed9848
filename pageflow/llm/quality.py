"""Document quality by hierarchical empirical Bayes.

A classifier fitted on labelled rows gives each document a probability of being clean. Documents belong
to a path, and paths to a host. Summed probabilities are aggregated per path and per host; the mean of a
host is shrunk towards the global mean, that of a path towards its host's. How strongly is estimated from
the spread between groups (an analysis of variance), so a site with few documents stays near the prior.
A document's own probability is taken out of its site's sums. The posterior odds are the document's odds
times the odds of its path over the global odds.

Results: a NULL or empty text has the classifier's prior as evidence; NULL hosts or paths form a group
of their own; repeated rows and NULL ids each give a row; with no labels every document has the same
evidence, and is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.llm import classifier
from pageflow.llm.common import digest_of, stored, text_of

CLASSES = ("clean", "low", "toxic")
LEAST, MOST = 1.0, 1e6


def label_classes(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Classes from the labels table: toxic before low quality; NULL labels count as not set."""
    kind = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    return labels.select(id_col, kind.alias("class"))


def concentration(groups: DataFrame, n: str, total: str, squares: str) -> float:
    """Strength of the prior over group means: m(1-m) over the variance between groups, less one."""
    mean = F.col(total) / F.col(n)
    row = groups.agg(
        F.count("*").alias("g"),
        F.sum(n).alias("n"),
        F.sum(total).alias("s"),
        F.sum(squares).alias("q"),
        F.sum(F.col(n) * F.col(n)).alias("nn"),
        F.sum(F.col(n) * mean * mean).alias("between"),
    ).first()
    if not row["n"] or row["n"] <= row["g"] or row["g"] < 2:
        return MOST
    m = row["s"] / row["n"]
    within = max(row["q"] - row["between"], 0.0) / (row["n"] - row["g"])
    spread = (row["between"] - row["n"] * m * m - (row["g"] - 1) * within) / (row["n"] - row["nn"] / row["n"])
    return min(MOST, max(LEAST, m * (1 - m) / spread - 1)) if spread > 0 else MOST


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.ln(q / (1 - q))


def site_quality(
    docs: DataFrame,
    labels: DataFrame,
    host_col: str = "source",
    path_cols: Sequence[str] = ("source", "lang"),
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.5,
    sample_rows: int = classifier.SAMPLE_ROWS,
) -> DataFrame:
    """One row per document: ``_id``, ``_digest``, class probabilities, host and path means, posterior, kept."""
    model = classifier.fit(docs, label_classes(labels, id_col), CLASSES, id_col, text_col, sample_rows=sample_rows)
    path = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in path_cols])
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        digest_of(text_col).alias("_digest"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("\x1e")).alias("_host"),
        path.alias("_path"),
        text_of(text_col).alias("_text"),
    )
    keep = {"_id": "long", "_digest": "binary", "_host": "string", "_path": "string"}
    scored = stored(classifier.predict(rows, model, "_text", keep), "quality-scores")

    p = F.col("p_clean")
    sums = [F.count("*").alias("n"), F.sum(p).alias("s"), F.sum(p * p).alias("q")]
    paths = scored.groupBy("_host", "_path").agg(*sums)
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("q").alias("hq"))
    paths, hosts = stored(paths, "quality-paths"), stored(hosts, "quality-hosts")
    whole = hosts.agg(F.sum("hs").alias("s"), F.sum("hn").alias("n")).first()
    mean = whole["s"] / whole["n"] if whole["n"] else 0.5
    by_host = concentration(hosts, "hn", "hs", "hq")
    by_path = concentration(paths, "n", "s", "q")

    sites = paths.join(hosts, "_host").select("_host", "_path", "n", "s", "hn", "hs")
    host = (F.lit(by_host * mean) + F.col("hs") - p) / (F.lit(by_host) + F.col("hn") - 1)
    site = (F.lit(by_path) * F.col("host_mean") + F.col("s") - p) / (F.lit(by_path) + F.col("n") - 1)
    logit = _logit(p) + _logit(F.col("path_mean")) - _logit(F.lit(float(mean)))
    return (
        scored.join(sites, ["_host", "_path"])
        .withColumn("host_mean", host)
        .withColumn("path_mean", site)
        .withColumn("posterior", 1 / (1 + F.exp(-logit)))
        .select("_id", "_digest", "words", *[f"p_{c}" for c in CLASSES], "host_mean", "path_mean", "posterior")
        .withColumn("kept", F.col("posterior") >= threshold)
    )
