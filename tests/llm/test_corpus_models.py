"""Quality, mixing, benchmark leaks and the Pitman-Yor model against brute force and planted cases."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pageflow.llm import decontaminate, mixing, pitmanyor, quality

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=240, seed=1):
    """Clean, shouting and insulting texts, in equal parts over four sources."""
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        kind = ("clean", "clean", "low", "toxic")[k % 4]
        w = [f"w{rng.randrange(400)}" for _ in range(rng.randint(20, 120))]
        if kind == "low":
            w = [x.upper() + "!!" for x in w]
        if kind == "toxic":
            for _ in range(3):
                w[rng.randrange(len(w))] = f"scum{rng.randrange(5)}"
        rows.append((k, " ".join(w), "en", f"src{k % 7}", 1))
        labels.append((k, int(kind != "low"), int(kind == "toxic")))
    return rows, labels


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels[:160] + [(None, 1, 0), (3, None, None), (9_999, 1, 0)], LABELS), labels


def test_quality_keeps_clean_documents(spark, labelled):
    docs, labels, truth = labelled
    got = {r._id: r for r in quality.site_quality(docs, labels).collect()}
    held = truth[160:]
    assert np.mean([got[d].kept == (q == 1 and t == 0) for d, q, t in held]) > 0.95
    assert all(0 <= r.posterior <= 1 and abs(r.p_clean + r.p_low + r.p_toxic - 1) < 1e-6 for r in got.values())


def test_quality_of_odd_rows(documents, odd, labelled):
    docs = documents(odd, extra=True)
    assert quality.site_quality(docs, labelled[1]).count() == len(odd)
    assert quality.site_quality(documents([]), labelled[1]).count() == 0
    none = quality.site_quality(docs, labelled[1].limit(0)).collect()
    assert len(none) == len(odd) and len({round(r.p_clean, 9) for r in none}) == 1


def test_sparse_sites_stay_near_the_prior(spark):
    rows = [(k, f"a{k % 2}") for k in range(400)] + [(999, "tiny")]
    groups = spark.createDataFrame([("a", 200, 190.0, 182.0), ("b", 200, 40.0, 12.0), ("tiny", 1, 0.0, 0.0)], "h string, n long, s double, q double")
    del rows
    strength = quality.concentration(groups, "n", "s", "q")
    assert 0.5 < strength < 20  # sites differ much, so the prior is weak, but not nothing
    same = spark.createDataFrame([("a", 200, 100.0, 60.0), ("b", 200, 100.0, 60.0)], "h string, n long, s double, q double")
    assert quality.concentration(same, "n", "s", "q") == quality.MOST


def test_rates_meet_the_targets(labelled, documents, odd):
    docs, labels, _ = labelled
    weights = {"clean": 0.8, "low": 0.15, "toxic": 0.05}
    got = mixing.mixing_rates(docs, labels, weights).collect()
    total = sum(r.words for r in got)
    for name, share in weights.items():
        assert abs(sum(r.words * r.rate * r[f"p_{name}"] for r in got) / total - share) < 2e-3
    assert all(r.rate >= 0 and math.floor(r.rate) <= r.copies <= math.floor(r.rate) + 1 for r in got)
    assert mixing.mixing_rates(documents(odd, extra=True), labels, weights).count() == len(odd)
    assert mixing.mixing_rates(documents([]), labels, weights).count() == 0


def test_rates_equal_plain_projected_gradient(spark):
    rng = np.random.default_rng(3)
    p, t = rng.dirichlet([0.3, 0.3, 0.3], 200), rng.integers(0, 50, 200)
    rows = spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(t, p)], "words long, p_clean double, p_low double, p_toxic double")
    targets = np.array([0.9, 0.1, 0.0]) * t.sum()
    rate = mixing.fit_rates(rows, targets, list(quality.CLASSES), rounds=25, tolerance=0)
    m = (p * t[:, None]).T @ p
    r = np.ones(200)
    for _ in range(25):
        r = np.maximum(0, r - p @ np.linalg.solve(m + 1e-9 * m.sum() * np.eye(3), p.T @ (t * r) - targets))
    got = np.array([x[0] for x in rows.select(rate.alias("r")).collect()])
    assert np.abs(got - r).max() < 1e-4 and (r == 0).any()


def test_the_mixing_stage_reaches_its_targets(spark, monkeypatch):
    """Expected totals per domain after the stage, from few tokens of the bad domains; sure clean documents stay."""
    rng = np.random.default_rng(8)
    p = np.array([[0.9999, 0.00005, 0.00005], *rng.dirichlet([60, 0.08, 0.08], 1_999)])
    p[1:21] = [0.6, 0.35, 0.05]
    p[21:41] = [0.55, 0.05, 0.4]
    rows = [(k, b"d", int(rng.integers(20, 400)), *map(float, v)) for k, v in enumerate(p)]
    kinds = "_id long, _digest binary, words long, p_clean double, p_low double, p_toxic double"
    monkeypatch.setattr(mixing.classifier, "fit", lambda *a, **k: None)
    monkeypatch.setattr(mixing.classifier, "predict", lambda *a, **k: spark.createDataFrame(rows, kinds))
    held = []
    plain = mixing.mixing_rates
    monkeypatch.setattr(corpus_pipeline.mixing, "mixing_rates", lambda *a, **k: held.append(plain(*a, **k)) or held[-1])
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: spark.createDataFrame([(1, 1, 0)], LABELS))
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    corpus_pipeline.mix(spark, docs, "")
    got = held[0].collect()
    totals = np.array([sum(r.words * r.rate * r[f"p_{c}"] for r in got) for c in corpus_pipeline.MIX_WEIGHTS])
    assert np.abs(totals / totals.sum() - list(corpus_pipeline.MIX_WEIGHTS.values())).max() < 5e-4
    assert next(r.rate for r in got if r._id == 0) >= 1 - 1e-3


def test_leaks(spark, documents, odd):
    rng = random.Random(7)
    vocabulary = [f"v{k}" for k in range(3_000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [" ".join(text(n)) + "." for n in (16, 25, 36, 48, 60)] * 4
    items = [" ".join(text(len(i.split()))) for i in items]
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, "too short"), (None, "null id " * 10)], "item_id long, text string")
    rows, want = [], {}
    for k in range(300):
        words = text(rng.randint(5, 900))
        if k % 10 == 0:
            item = rng.randrange(len(items))
            inside = items[item].split()
            if k % 20 == 0:  # a paraphrase: some words of its first part replaced or left out
                for _ in range(len(inside) // 10):
                    inside[rng.randrange(len(inside) * 3 // 4)] = "other"
            at = rng.randrange(len(words) + 1)
            words[at:at] = inside
            want[k] = {item}
        rows.append((k, " ".join(words)))
    odd_rows = [(None if d is None else d + 10_000, t) for d, t in odd]
    got = decontaminate.contamination(documents(rows + odd_rows, extra=True), bench).collect()
    assert len(got) == len(rows) + len(odd_rows)
    found = {r._id: set(r.item_ids) for r in got if r.contaminated}
    assert set(found) <= set(want)
    assert sum(found.get(k) == v for k, v in want.items()) >= 0.96 * len(want)
    assert decontaminate.contamination(documents([]), bench).count() == 0
    assert {r.contaminated for r in decontaminate.contamination(documents(rows[:5]), bench.limit(0)).collect()} == {False}


@pytest.mark.parametrize("edits", [0, 12])
def test_leaks_in_a_large_group_of_copies(spark, documents, edits):
    """An item in a document that a third of all rows copy, with or without edits, is found there and elsewhere."""
    rng = random.Random(11)
    text = lambda n: [f"v{rng.randrange(3_000)}" for _ in range(n)]
    item = text(30)
    base = text(200)
    rows, want = [], set()
    for k in range(300):
        words = text(rng.randint(50, 400))
        if k % 3 == 0:
            words = list(base)
            for _ in range(edits):
                words[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
            words = text(rng.randrange(edits + 1)) + words[:90] + item + words[90:]
        elif k % 10 == 1:
            words[20:20] = item
        if k % 3 == 0 or k % 10 == 1:
            want.add(k)
        rows.append((k, " ".join(words)))
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(text(40)))], "item_id long, text string")
    got = decontaminate.contamination(documents(rows), bench).collect()
    assert {r._id: r.item_ids for r in got if r.contaminated} == {k: [1] for k in want}


def test_leaks_of_long_and_short_items(spark, documents):
    """Items far longer than a passage, also with words replaced; items of a few words; an item without id."""
    rng = random.Random(12)
    text = lambda n: [f"v{rng.randrange(3_000)}" for _ in range(n)]
    items = {1: text(400), 2: text(700), 3: text(1_200), 4: text(1_200), 5: ["Who", "wrote", "v7", "v8?"], 6: ["v1"] * 7, None: text(20)}
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    rows, want = [], {}
    for k in range(120):
        words = text(rng.randint(20, 600))
        if k % 4 == 0:
            i = list(items)[k // 4 % len(items)]
            inside = list(items[i])
            if i == 4:  # every fifth word another one
                inside[4::5] = [f"x{rng.randrange(10**6)}" for _ in inside[4::5]]
            at = rng.randrange(len(words) + 1)
            words[at:at] = inside
            want[k] = [i]
        rows.append((k, " ".join(words)))
    rows.append((900, "who wrote v8 v7 who wrote v7"))
    got = decontaminate.contamination(documents(rows), bench).collect()
    assert {r._id: r.item_ids for r in got if r.contaminated} == want
    alone = decontaminate.Items.of([(4, " ".join(items[4]))], np.ones(decontaminate.SLOTS), np.eye(decontaminate.SLOTS, 8))
    assert len(alone.directions) == 20 and set(alone.owners) == {0}  # the item and 19 pieces


def test_sketch_gives_singular_vectors():
    rng = np.random.default_rng(1)
    old, decontaminate.SLOTS = decontaminate.SLOTS, 64
    try:
        a = rng.standard_normal((500, 6)) @ np.diag([9, 7, 5, 3, 2, 1]) @ rng.standard_normal((6, 64))
        omega = np.random.default_rng(decontaminate.SEED).standard_normal((64, 12)).astype(np.float32)
        vectors, sizes = decontaminate.latent(a.T @ (a @ omega.astype(np.float64)), 4)
        _, want, v = np.linalg.svd(a)
        assert np.allclose(sizes, want[:4], rtol=1e-3)
        assert np.allclose(np.abs((vectors * v[:4].T).sum(axis=0)), 1, atol=1e-3)
    finally:
        decontaminate.SLOTS = old


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(1, 40))] for _ in range(2))
        assert decontaminate.longest_common(decontaminate.masks(a), len(a), b) == lcs(a, b)


def test_pitman_yor_counts_and_base(documents, odd):
    rng = random.Random(9)
    vocabulary = [f"v{k}" for k in range(50)]
    rows = [(k, " ".join(rng.choice(vocabulary[: 5 + k % 45]) for _ in range(rng.randint(0, 200)))) for k in range(300)] + list(odd)
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    c = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    want = Counter()
    for (d, _), ws, h in zip(rows, tokens, held):
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        want[(d, h, len(ws), sum(c[w] > 0 for w in ws), n, round(base, 5))] += 1
    for size in (4_000_000, 1_500):
        got = pitmanyor.scores(documents(rows, extra=True), bucket_tokens=size).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
        assert all(r.score < 0 for r in got)
    assert pitmanyor.scores(documents([])).count() == 0


def test_pitman_yor_predictions_add_up_and_learn(documents):
    """Over all next words and the unknown place, the probabilities after a context add up to one."""
    rng = random.Random(4)
    rows = [(k, " ".join(x for _ in range(rng.randint(1, 30)) for x in rng.choice([("a", "b"), ("c", "d"), ("e", "f", "g")]))) for k in range(150)]
    probes = ["a", "b", "c", "d", "e", "f", "g", "neverseen"]
    base = 10_000
    held = [k for k in range(base, base + 2_000) if zlib.crc32(str(k).encode()) % 7 == 2]
    texts = [f"{u} {w}" for u in probes for w in probes]
    rows += list(zip(held, texts))
    rows += list(zip(held[len(texts):], probes)) + [(held[len(texts) + len(probes)], "")]
    got = {r.doc_id: r.score for r in pitmanyor.scores(documents(rows), bucket_tokens=900).collect()}
    score = {t: got[d] for d, t in rows if d >= base}
    # p(u w end) / p(u end) * p(end | u) / p(end | w) = p(w | u); p(end | x) follows from sums over a closed set
    # Here: sum over w of p(w | u) + p(end | u) = 1 for every u, with all x = p(end | x) unknown but shared.
    p1 = {x: 10 ** score[x] for x in probes}  # p(x | start) * p(end | x)
    p2 = {(u, w): 10 ** score[f"{u} {w}"] for u in probes for w in probes}
    # Unknowns e_x = p(end | x); p(w | u) = p2 / p1[u] * e_u / e_w. Solve sum_w p2[u, w] / p1[u] * e_u / e_w + e_u = 1.
    e = {x: 0.2 for x in probes}
    for _ in range(3_000):
        e = {u: 1 / (1 + sum(p2[u, w] / p1[u] / e[w] for w in probes)) for u in probes}
    start = sum(p1[x] / e[x] for x in probes) + 10 ** score[""]
    assert abs(start - 1) < 1e-3
    assert p2["a", "b"] / p1["a"] * e["a"] / e["b"] > 0.9


def test_tables_are_drawn_from_their_conditional():
    """Means against generalised Stirling numbers by their recurrence, below and above the table's end."""
    rng = np.random.default_rng(2)
    for d, weight, n in ((0.8, 1.0, 20), (0.8, 1.0, 200), (0.5, 5.0, 200), (0.6, 40.0, 600), (0.9, 0.01, 500)):
        logs = np.array([0.0])  # log S(m, 1..m)
        for m in range(1, n):
            t = np.arange(1, m + 1)
            logs = np.logaddexp(np.append(logs + np.log(m - d * t), -np.inf), np.append(-np.inf, logs))
        t = np.arange(1, n + 1)
        p = np.exp(logs + t * np.log(weight) - (logs + t * np.log(weight)).max())
        mean = (p * t).sum() / p.sum()
        spread = np.sqrt((p * t * t).sum() / p.sum() - mean**2)
        got = pitmanyor.tables_drawn(np.full(1_500, n), np.full(1_500, weight), d, rng)
        assert abs(got.mean() - mean) < 0.03 + 0.15 * spread, (d, weight, n, got.mean(), mean)
        near = t[(t == n) | (np.abs(t - mean) < 5 * spread + 2)].astype(float)
        exact = logs[near.astype(int) - 1] - math.lgamma(n + 1)
        assert np.abs(pitmanyor.stirling_log(np.full(len(near), float(n)), near, d) - exact).max() < 1e-4
    # Far above any table: one more than a Poisson number of tables.
    got = pitmanyor.tables_drawn(np.full(1_500, 10**9), np.full(1_500, 2.0), 0.8, rng)
    assert abs(got.mean() - 3.5) < 0.25


def test_pipeline_stages(spark, labelled, documents, odd):
    """Every stage takes odd rows and empty tables, keeps the columns, and its decisions take effect."""
    import uuid

    from pageflow.functions.running import scratch_path

    rows, labels = corpus(seed=2)
    item = " ".join(f"q{k}" for k in range(40))
    # Ids of their own for the odd rows: those of the corpus start at 0 too.
    odd = [(None if d is None else d + 2_000, t) for d, t in odd]
    extra = [(1_000, rows[0][1]), (1_001, "before " + item + " after that"), (1_002, rows[1][1] + " one more"), *odd, (1_000, rows[0][1])]
    sf_dir = scratch_path(spark, f"sf-{uuid.uuid4().hex}")
    whole = documents([(r[0], r[1]) for r in rows] + extra, extra=True).withColumns({x: F.lit("x") for x in ("_copies", "_copy", "_print", "_size")})
    spark.createDataFrame(labels, LABELS).write.parquet(f"{sf_dir}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    docs, seen = whole, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        path = scratch_path(spark, "test-stage")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = [(r.doc_id, r.text) for r in docs.collect()]
        assert set(before.columns) <= set(docs.columns)
    names = [n for n, _ in corpus_pipeline.STAGES]
    good = {d for d, q, t in labels if q and not t}
    kept = {d for d, _ in seen[names[0]] if d is not None and d < 1_000}
    assert len(kept & good) >= 0.95 * len(good) and len(kept - good) <= 6
    after = Counter(d for d, _ in seen[names[1]])
    assert 1_000 not in after and (after[1_002] == 0 or after[1] == 0) and after[2_005] + after[2_004] <= 1
    assert all(n == 1 for d, n in after.items() if d is not None)
    assert 1_001 in after and 1_001 not in {d for d, _ in seen[names[2]]}
    assert {d for d, _ in seen[names[3]]} <= {d for d, _ in seen[names[2]]}
    assert Counter(seen[names[4]]) == Counter(seen[names[3]]) and {"shard", "slot"} <= set(docs.columns)
    empty = documents([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_one_row_of_each_labelled_id_is_fitted(spark, documents):
    from pageflow.llm import classifier

    labels = spark.createDataFrame([(k, "xy"[k % 2]) for k in range(40)], "doc_id long, class string")
    rows = [(k, ("good words here " if k % 2 else "bad terms there ") * 5 + str(k)) for k in range(40)]
    more = rows + [(3, f"other text {k}") for k in range(300)]
    models = [classifier.fit(documents(x).repartition(n, "text"), labels, ["x", "y"]) for x, n in ((more, 3), (more[::-1], 7))]
    assert np.array_equal(models[0].weights, models[1].weights)
