"""Rates per document that bring expected token totals per domain to target weights.

A classifier of the labelled table gives every document probabilities over domains. With t tokens, domain
probabilities p and rate r, a document adds r * t * p to the domain totals. Rates start at 1 and follow
projected gradient steps on the squared distance between totals and targets, measured in the inverse of
M = sum(t p p'); in this scaling the step length is 1. ``damping`` (a share of all tokens, added to the
diagonal of M) and ``ridge`` (a pull towards rate 1) keep rates near 1 where documents hardly differ in
their domains; ``most`` bounds the rates from above. All that a step needs from the rows is one total per
domain, and a row's rate is a fold over the vectors of the steps so far, so no rates are stored or joined.
The rate's whole part is the number of copies, and its fraction the chance of one more, by a row hash.
With ``keep`` the budget is raised, all targets alike, until a document surely of that domain has a rate of
at least 1.

Results: a NULL or empty text has no tokens and moves no total; repeated rows and NULL ids each give a
row; if a target can't be met (say a domain without tokens) the nearest totals are taken; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.llm import classifier
from pageflow.llm.common import digest_of, release, stored, text_of
from pageflow.llm.quality import CLASSES, label_classes

RAISES = 8
# Steps of the fit, a job each, between two collections of the driver's garbage.
COLLECTED = 8


def _fold(steps: list[np.ndarray], domains: list[str], ridge: float, most: float | None) -> Column:
    """The rate after the given steps; each takes sum_k p_k u_k off and cuts at the bounds.

    One fold over an array of the steps, so that the expression stays small however many there are.
    """
    if not steps:
        return F.lit(1.0)
    moves = F.array(*[F.array(*[F.lit(float(x)) for x in u]) for u in steps])
    p = [F.col(f"p_{d}") for d in domains]

    def step(rate: Column, u: Column) -> Column:
        move = sum((u[k] * q for k, q in enumerate(p)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), (rate + F.lit(ridge) - move) / F.lit(1 + ridge))
        return rate if most is None else F.least(F.lit(float(most)), rate)

    return F.aggregate(moves, F.lit(1.0), step)


def fit_rates(
    rows: DataFrame,
    targets: np.ndarray,
    domains: list[str],
    rounds: int = 40,
    tolerance: float = 1e-4,
    damping: float = 1e-9,
    ridge: float = 0.0,
    most: float | None = None,
) -> Column:
    """The rate of a row with ``words`` and ``p_<domain>`` columns, as an expression over them."""
    return _fold(fit_steps(rows, targets, domains, rounds, tolerance, damping, ridge, most), domains, ridge, most)


def fit_steps(
    rows: DataFrame,
    targets: np.ndarray,
    domains: list[str],
    rounds: int = 40,
    tolerance: float = 1e-4,
    damping: float = 1e-9,
    ridge: float = 0.0,
    most: float | None = None,
) -> list[np.ndarray]:
    """The gradient steps whose fold is the rate."""
    n = len(domains)
    p = [F.col(f"p_{d}") for d in domains]
    cells = rows.agg(*[F.sum(F.col("words") * p[i] * p[j]).alias(f"m{i}_{j}") for i in range(n) for j in range(i, n)]).first()
    m = np.array([[cells[f"m{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(n)] for i in range(n)])
    inverse = np.linalg.pinv(m + damping * m.sum() * np.eye(n), rcond=1e-12, hermitian=True)
    steps: list[np.ndarray] = []
    for turn in range(rounds):
        if turn % COLLECTED == COLLECTED - 1:
            release(rows.sparkSession)
        rate = _fold(steps, domains, ridge, most)
        sums = rows.select("words", *p, rate.alias("_r")).agg(*[F.sum(F.col("words") * F.col("_r") * q).alias(d) for q, d in zip(p, domains)])
        totals = np.array([sums.first()[d] or 0.0 for d in domains])
        step = inverse @ (totals - targets)
        settled = bool(steps) and np.abs(step - steps[-1]).max() <= tolerance * max(np.abs(step).max(), 1e-12) and ridge > 0
        if settled or np.abs(totals - targets).max() <= tolerance * max(targets.sum(), 1e-9):
            break
        steps.append(step)
    return steps


def sure_rate(steps: list[np.ndarray], at: int, ridge: float = 0.0, most: float | None = None) -> float:
    """The rate of a document that is of domain number ``at`` with probability 1."""
    rate = 1.0
    for u in steps:
        rate = max(0.0, (rate + ridge - u[at]) / (1 + ridge))
        rate = rate if most is None else min(most, rate)
    return rate


def mixing_rates(
    docs: DataFrame,
    labels: DataFrame,
    weights: Mapping[str, float],
    budget: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 40,
    seed: int = 17,
    sample_rows: int = classifier.SAMPLE_ROWS,
    keep: str | None = None,
    **bounds,
) -> DataFrame:
    """One row per document: ``_id``, ``_digest``, words, domain probabilities, rate, copies.

    ``weights`` are the targets' shares per domain; ``budget`` is the expected number of tokens, by
    default as many as there are, and more where the sure documents of ``keep`` would have rates below 1.
    """
    domains = [c for c in CLASSES if c in weights]
    model = classifier.fit(docs, label_classes(labels, id_col), domains, id_col, text_col, sample_rows=sample_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), digest_of(text_col).alias("_digest"), text_of(text_col).alias("_text"))
    scored = stored(classifier.predict(rows, model, "_text", {"_id": "long", "_digest": "binary"}), "mixing-posteriors")
    total = scored.agg(F.sum("words").alias("n")).first()["n"] or 0
    share = np.array([float(weights[d]) for d in domains])
    targets = share / share.sum() * (float(total) if budget is None else float(budget))
    steps = fit_steps(scored, targets, domains, rounds, **bounds)
    raised = 1.0
    if keep is not None:
        ridge, most, at = bounds.get("ridge", 0.0), bounds.get("most"), domains.index(keep)
        least = sure_rate(steps, at, ridge, most)
        if 0 < least < 1 and not ridge and most is None:
            # Totals are linear in the rates, so raised rates meet raised targets as closely as before.
            raised = (1 + 1e-4) / least
        elif 0 < least < 1:
            for _ in range(RAISES):
                # Rates grow with the targets; a little more, so that the tolerance of the fit is covered.
                targets = targets * (1 + 1e-4) / least
                steps = fit_steps(scored, targets, domains, rounds, **bounds)
                least = sure_rate(steps, at, ridge, most)
                if not 0 < least < 1:
                    break
    rate = F.lit(raised) * _fold(steps, domains, bounds.get("ridge", 0.0), bounds.get("most"))
    drawn = F.pmod(F.xxhash64("_id", "_digest", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor("rate") + (drawn < F.col("rate") - F.floor("rate")).cast("int")
    return scored.withColumn("rate", rate).withColumn("copies", copies.cast("int"))
