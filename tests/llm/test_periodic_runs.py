"""Periodic runs against comparing every word with every other, and the structures they are found by."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from pageflow.llm import periodicruns, queries


def brute(words, least=6, exponent=4):
    """(start, length, period) of all runs, by start and period."""
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(words[i + x] == words[i + x + r] for x in range(length - r)) for r in range(1, q))
            if length >= max(least, exponent * q) and not smaller:
                out.add((i, q, length))
            i = j + 1
    return [(s, length, q) for s, q, length in sorted(out)]


def without_repeats(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def text_with_runs(rng):
    kinds = rng.choice([1, 2, 3, 10, 100])
    words = [str(rng.randrange(kinds)) for _ in range(rng.randrange(120))]
    for _ in range(rng.randrange(4)):
        base = [str(rng.randrange(kinds)) for _ in range(rng.randrange(1, 20))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = [base[x % len(base)] for x in range(rng.randrange(len(base), 9 * len(base) + 1))]
    return words


def test_runs_equal_brute_force(spark, documents, odd):
    rng = random.Random(3)
    texts = [rng.choice([" ", "\n", " \t"]).join(text_with_runs(rng)) for _ in range(600)]
    texts += ["ab " * 5, "ab " * 6, "a b " * 3 + "a", "a b " * 4, "É東 x " * 50, "Ab ab " * 9, "x" * 50_000 + " y" * 7, "p q r " * 8_000]
    rows = list(enumerate(texts, 100)) + [(100, texts[0])] + list(odd)
    got = periodicruns.periodic_runs(documents(rows, extra=True)).collect()
    want = []
    for d, text in rows:
        words = (text or "").encode().split()
        runs = brute(words) if len(words) < 2_000 else [(0, len(words), len(set(words)))]
        want.append((d, tuple(runs), b" ".join(without_repeats(words, runs)).decode()))
    key = lambda x: (x[0] is None, *map(str, x))
    assert sorted(((r._id, tuple(map(tuple, r.runs)), r.collapsed) for r in got), key=key) == sorted(want, key=key)
    assert periodicruns.periodic_runs(documents([])).count() == 0
    with pytest.raises(ValueError):
        periodicruns.periodic_runs(documents([]), exponent=2)


def test_other_lengths_and_exponents():
    rng = random.Random(4)
    for _ in range(150):
        words = text_with_runs(rng)
        numbers = np.array([int(w) for w in words], np.int64)
        for least, exponent in ((1, 3), (10, 3), (2, 5), (30, 6)):
            found = periodicruns.runs_of(numbers, np.array([0, len(words)]), least, exponent)
            assert list(zip(*(x.tolist() for x in found))) == brute(words, least, exponent)


def test_suffix_array_names_and_range_successors():
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 3, n) for n in (0, 1, 50, 7, 200)]
    words = np.concatenate([t + 3 * k for k, t in enumerate(texts)])
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ends = np.repeat(starts[1:], np.diff(starts))
    made = periodicruns.Suffixes(words, ends)
    suffix = lambda i: tuple(words[i : ends[i]])
    assert made.array.tolist() == sorted(range(len(words)), key=suffix)
    a, b = rng.integers(0, len(words), 500), rng.integers(0, len(words), 500)
    a, b = np.minimum(a, b), np.maximum(a, b)
    a, b = a[a < b], b[a < b]
    for i, j, n in zip(a, b, made.alike(a, b)):
        x, y = suffix(i), suffix(j)
        assert n == next((k for k, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
    values = rng.permutation(300)
    tree = periodicruns.WaveletTree(values)
    for _ in range(300):
        low, high = sorted(rng.integers(0, 301, 2))
        if low == high:
            continue
        value = rng.choice(values[low:high])
        above = values[low:high][values[low:high] > value]
        assert tree.successor(np.array([low]), np.array([high]), np.array([value]))[0] == (above.min() if len(above) else -1)


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = [(k, " \n".join(text_with_runs(rng))) for k in range(-20, 380)] + [(400, None), (401, ""), (402, "a a a a a a a a")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for d, text in rows:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(d).encode())
        if h % 10 == 0 and n:
            g, planted = h // 10, planted + 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = b" ".join(without_repeats(words, runs))
        assert got[d] == (d, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
    assert planted > 20 and len(got) == len(rows)
