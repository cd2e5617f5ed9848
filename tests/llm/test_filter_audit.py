"""The audit of filters against plain Python over every order."""

from __future__ import annotations

import random
from collections import Counter
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from pageflow.llm import filteraudit


def fails(text):
    words = (text or "").encode().split()
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text or "") > 3 * len(text or ""),
        "D": any(c in "#$%&*|" for c in text or ""),
    }


def brute(rows, labels):
    """rows: (doc_id, text, lang)."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    facts = []
    for d, t, lang in rows:
        failed = {x for x, bad in fails(t).items() if bad}
        if d is not None and d > least[t or ""]:
            failed.add("E")
        facts.append((lang or "", failed, d in good, d in toxic))
    out = []
    for part in {x[0] for x in facts}:
        own = [x for x in facts if x[0] == part]
        shapley = Counter()
        lines = []
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                hit = [x for x in own if letter in x[1]]
                removed = [x for x in hit if not x[1] & before]
                kept = sum(not x[1] & (before | {letter}) for x in own)
                unique = sum(x[1] == {letter} for x in hit)
                lines.append((part, "".join(order), step, kept, len(removed), len(hit) - len(removed), unique, sum(x[2] for x in removed), sum(x[3] for x in removed)))
                shapley[letter] += len(removed)
        out += [(*x, shapley[x[1][x[2] - 1]]) for x in lines]
    return Counter(out)


def test_audit_equals_every_order_by_hand(spark, odd):
    rng = random.Random(5)
    rows = []
    for k in range(300):
        words = [rng.choice("abcdefghijklmnop") * rng.randint(1, 3 + k % 40) for _ in range(rng.choice([5, 150, 230, 400]))]
        text = " ".join(words) + rng.choice(["", "", " #", " X" * 40, " É東😀 \x0b|"])
        rows.append((k, text, rng.choice(["en", "de", None, ""])))
        if rng.random() < 0.2:
            rows.append((rng.choice([k, 1_000 + k]), text, rng.choice(["en", "fr"])))
    rows += [(5_000 + k, "one text of a third of all rows " * 50, "en") for k in range(150)]
    rows += [(d, t, "odd") for d, t in odd]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 1_300, 2)] + [(2, 1, 0), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.withColumns({x: F.lit("x") for x in ("_id", "mask", "part", "good", "toxic", "_digest", "n")})
    got = filteraudit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert Counter(map(tuple, got.collect())) == brute(rows, labels)


def test_empty_table_and_other_filters(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(docs, labels).count() == 0
    docs = spark.createDataFrame([(k, "x" * k, "en") for k in range(10)], "doc_id long, text string, lang string")
    size = F.length("text")
    got = filteraudit.audit(docs, labels, {"s": size < 3, "l": size > 7, "e": size % 2 == 0}, duplicates=False).collect()
    assert len(got) == 3 * factorial(3)
    assert {(r.filter_order, r.step): r.removed for r in got}["sle", 3] == 2
    with pytest.raises(ValueError):
        filteraudit.audit(docs, labels, {x: size > 1 for x in "abcdefg"})
