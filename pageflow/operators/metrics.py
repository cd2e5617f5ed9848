"""Metrics of a scored set, as DataFrames of one or a few rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.functions import expressions as E
from pageflow.functions.running import running_totals


def score_steps(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: positives and negatives with it, and running counts up to it.

    Scores may be as many as rows, so the running counts go over range partitions.
    """
    counts = df.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return running_totals(counts, ["score"], {"pos_upto": "pos", "neg_upto": "neg"}, by)


def ranking_metrics(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC and average precision on the score, exact with ties, from one set of steps.

    AUC is the chance that a positive outscores a negative, ties counting one half. Average
    precision adds up, from the highest score down, precision times the gain in recall. Both are
    NULL where a class is missing.
    """
    steps = score_steps(df, label, score, by)
    sizes = steps.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    auc_part = F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2)
    if by:
        joined = steps.join(sizes, list(by))
        positives, negatives = F.col("_p"), F.col("_n")
    else:
        joined = steps
        positives = sizes.select("_p").scalar()
        negatives = sizes.select("_n").scalar()
    tp = positives - F.col("pos_upto") + F.col("pos")
    fp = negatives - F.col("neg_upto") + F.col("neg")
    parts = joined.select(
        *by,
        "pos",
        "neg",
        auc_part.alias("_auc"),
        (F.col("pos") * E.ratio(tp, tp + fp)).alias("_ap"),
    )
    summed = parts.groupBy(*by).agg(
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"), F.sum("_auc").alias("_auc"), F.sum("_ap").alias("_ap")
    )
    return summed.select(
        *by,
        E.ratio(F.col("_auc"), F.col("_p") * F.col("_n")).alias("roc_auc"),
        E.ratio(F.col("_ap"), F.col("_p")).alias("average_precision"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, label, score, by).select(*by, "roc_auc")


def average_precision(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """On the score; give the hard prediction as ``score`` for the value on labels."""
    return ranking_metrics(df, label, score, by).select(*by, "average_precision")


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count("*").alias("n")
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means.

    Only the confusion counts, a few rows, are worked on after one aggregation of the set. A class
    that is never predicted (or never occurs) has precision (or recall) 0.
    """
    counts, n = confusion_counts(df, label, prediction), F.col("n")
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("class"), n.alias("support"), zero.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), zero.alias("support"), n.alias("predicted"), zero.alias("hits")),
    )
    per_class = counts.select(F.inline(sides)).groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    hits = F.col("hits")
    precision = F.coalesce(E.ratio(hits, F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(E.ratio(hits, F.col("support")), F.lit(0.0))
    f1 = F.coalesce(E.ratio(2 * hits, F.col("predicted") + F.col("support")), F.lit(0.0))
    scored = per_class.select(
        F.col("class").cast("string").alias("class"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        "support",
        "hits",
    )
    measures = ["precision", "recall", "f1"]
    total = F.sum("support")
    accuracy = E.ratio(F.sum("hits"), total)
    means = {
        "accuracy": [accuracy] * 3,
        "macro avg": [F.avg(m) for m in measures],
        "weighted avg": [E.ratio(F.sum(F.col(m) * F.col("support")), total) for m in measures],
    }
    summary = scored.agg(
        F.array(
            *[
                F.struct(F.lit(name).alias("class"), *[v.alias(m) for m, v in zip(measures, values)], total.alias("support"))
                for name, values in means.items()
            ]
        ).alias("rows")
    ).select(F.inline("rows"))
    return scored.drop("hits").unionByName(summary)
