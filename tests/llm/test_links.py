"""Near copies and components against brute force; the pipeline's helpers."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from pageflow.llm import classifier, common, nearcopies, words
from pageflow.llm import components as components_module
from pageflow.llm.common import bytes_of
from pageflow.llm.components import components


def brute(rows, percent):
    """Set sizes and smallest reachable ids by comparing all pairs that share an element."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            having[x].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in having[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root(i)].append(d)
    return Counter((d, len(sets[i]), min(ids[root(i)], default=None) if sets[i] else d) for i, (d, _) in enumerate(rows))


def group(rng, size, edits, base=None):
    base = base or [f"w{rng.randrange(10**6)}" for _ in range(150)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_near_copies_equal_brute_force(documents, odd, percent):
    rng = random.Random(percent)
    texts = group(rng, 300, 5) + [t for _ in range(20) for t in group(rng, 6, 4)] + ["Same TEXT as   ever " * 3, "same text as ever " * 3]
    shared = " ".join(f"s{k}" for k in range(60))
    texts += [shared + " " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(rng.randint(5, 80))) for _ in range(150)]
    texts += ["one two three four five six seven"] * 120
    rng.shuffle(texts)
    rows = list(enumerate(texts, 100)) + list(odd)
    got = nearcopies.near_copies(documents(rows, extra=True), percent=percent).collect()
    assert Counter((r._id, r._size, r.component_id) for r in got) == brute(rows, percent)
    kept = Counter(r.component_id for r in got if r.stays and r._size and r._id != 5 and r._id is not None)
    assert set(kept.values()) == {1}
    assert nearcopies.near_copies(documents([])).count() == 0
    assert nearcopies.near_copies(documents([(1, None), (2, "")])).count() == 2


def loose_group(rng, size):
    """Texts of which each is similar to a few others only, at about the threshold."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    out = []
    for _ in range(size):
        at = rng.randrange(120)
        w = list(base)
        for k in range(rng.randint(3, 14)):
            w[(at + 9 * k) % 120] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [16, 256])
def test_forests_lose_no_link(documents, monkeypatch, block):
    monkeypatch.setattr(nearcopies, "BLOCK", block)
    rng = random.Random(block)
    rows = list(enumerate([t for n in (200, 40, 40) for t in loose_group(rng, n)]))
    got = nearcopies.near_copies(documents(rows), percent=80).collect()
    want = brute(rows, 80)
    assert len({x[2] for x in want}) > 10
    assert Counter((r._id, r._size, r.component_id) for r in got) == want


def test_pairs_handed_on_grow_with_the_group(spark, documents, monkeypatch):
    handed = {}
    plain = nearcopies.open_pairs

    def counted(*args):
        out = plain(*args)
        handed[size] = handed.get(size, 0) + out.count()
        return out

    monkeypatch.setattr(nearcopies, "open_pairs", counted)
    for size in (300, 600, 1_200):
        rng = random.Random(1)
        nearcopies.near_copies(documents(list(enumerate(group(rng, size, 14)))), percent=80).count()
    assert all(handed[size] <= 2 * size for size in handed)


def test_pairs_within_the_distance_share_a_key():
    rng = np.random.default_rng(1)
    for distance in (0, 1, 5, 23):
        a = rng.integers(0, 1 << 16, (300, 64)).astype(np.uint16)
        b = a.copy()
        for row in b:
            at = rng.choice(64, distance, replace=False)
            row[at] = rng.integers(0, 1 << 16, distance)
        x, y = nearcopies.chunk_keys(a, distance), nearcopies.chunk_keys(b, distance)
        assert (x == y).any(axis=1).all()
    unlike = nearcopies.chunk_keys(rng.integers(0, 1 << 16, (300, 64)).astype(np.uint16), 23)
    assert not (x == unlike).any()


def test_cells_never_drop_a_similar_pair():
    rng = np.random.default_rng(2)
    for _ in range(200):
        common, own = int(rng.integers(1, 3_000)), int(rng.integers(0, 600))
        base = rng.integers(0, 1 << 63, common + 2 * own).astype(np.uint64) * np.uint64(2)
        x, y = base[: common + own], np.concatenate([base[:common], base[common + own :]])
        cells = nearcopies.cell_counts(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)])).astype(np.int16)
        similar = 100 * common >= 85 * (common + 2 * own)
        assert nearcopies.possible(cells[0], cells[1], np.int64(len(x)), np.int64(len(y)), 85)[0] or not similar


def test_components(spark):
    rng = random.Random(4)
    chains = [(k, k + 1) for k in range(0, 60)]
    star = [(1_000, 1_001 + k) for k in range(500)]
    loose = [(rng.randrange(2_000, 2_300), rng.randrange(2_000, 2_300)) for _ in range(150)]
    links = chains + star + loose + [(5, 5), (None, 7), (0, 1)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {x: x for a, b in links if a is not None and a != b for x in (a, b)}
    for _ in range(len(label)):
        changed = False
        for a, b in links:
            if a is not None and a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
        if not changed:
            break
    assert got == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("part", [16, 20_000])
def test_few_links_need_no_rounds(spark, monkeypatch, part):
    tables = []
    monkeypatch.setattr(components_module, "PART", part)
    monkeypatch.setattr(components_module, "stored", lambda df, name, f=components_module.stored: tables.append(f(df, name)) or tables[-1])
    rng = random.Random(3)
    chain = [(k, k + 1) for k in range(500)]
    rng.shuffle(chain)
    got = components_module.components_by_parts(spark.createDataFrame([*chain, (900, 901), (901, 900), (5, 5), (None, 7)], "a long, b long").repartition(8)).collect()
    assert components_module.components_by_parts(spark.createDataFrame([], "a long, b long")).count() == 0
    assert sorted(map(tuple, got)) == [(k, 0) for k in range(501)] + [(900, 900), (901, 900)]
    assert part == 16 or len(tables) == 4 and len(tables[1].inputFiles()) == 1


def test_near_copies_store_few_files(spark, documents, monkeypatch):
    files = {}

    def watched(df, name, f=nearcopies.stored):
        out = f(df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(nearcopies, "stored", watched)
    rows = list(enumerate(group(random.Random(8), 60, 6)))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = nearcopies.near_copies(documents(rows).coalesce(1), percent=80).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert Counter((r._id, r._size, r.component_id) for r in got) == brute(rows, 80)
    assert len(files) > 8 and set(files.values()) == {1}


def test_words_are_those_of_the_rule():
    texts = ["Ab\x0bc  d\n", "", None, "É é  x\x85y\x1cz", "longerthaneight longerthaneighu", "ab c D", "\t"]
    hashes, before = words.word_hashes(*bytes_of(pa.array(texts)))
    want = [(t or "").encode().lower().split() for t in texts]
    # 0x1C is white space to Python's split of text, but not of bytes
    assert np.diff(before).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    for (i, a), (j, b) in combinations(enumerate(flat), 2):
        assert (hashes[i] == hashes[j]) == (a == b)
    runs, offsets = words.windows(hashes, before, 3)
    assert np.diff(offsets).tolist() == [max(1, len(w) - 2) if w else 0 for w in want]
    assert runs[0] == runs[offsets[5]]


def test_rounds_and_fit_leave_the_driver_little(spark, documents, monkeypatch):
    """Each round of components lets the driver collect its garbage; the labelled sample comes as Arrow, not as row objects."""
    turns = []
    monkeypatch.setattr(components_module, "release", turns.append, raising=False)
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    assert {tuple(r) for r in components_module.components(chain).collect()} == {(k, 0) for k in range(41)}
    assert len(turns) >= 3
    rows = [(k, f"word{k % 2} text {k}") for k in range(80)]
    labels = spark.createDataFrame([(k, "ab"[k % 2]) for k in range(80)], "doc_id long, class string")
    docs, collected = documents(rows), []
    kind = type(docs)
    plain = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: collected.append(self.columns) or plain(self))
    model = classifier.fit(docs, labels, ["a", "b"])
    assert not [c for c in collected if "slots" in c]
    assert model.weights.any() and np.isfinite(model.weights).all()


def test_release_trims_the_drivers_native_memory(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(common, "trimmed", lambda s, f=common.trimmed: asked.append(f(s)))
    common.release(spark)
    # there from 17.0.9 and 21 on
    version = [int(x) for x in spark._jvm.System.getProperty("java.version").split("-")[0].split(".")]
    assert asked == [True] or asked == [False] and version < [21] and not [17, 0, 9] <= version < [18]


def test_stages_return_few_files(spark, documents, monkeypatch):
    wide = corpus_pipeline.in_few_files(lambda s, docs, sf_dir: docs.repartition(32))
    assert wide(spark, documents([(k, "a") for k in range(40)]), "").rdd.getNumPartitions() == 1
    monkeypatch.setattr(common, "TASK_ROWS", 10)
    assert wide(spark, documents([(k, "a") for k in range(40)]), "").rdd.getNumPartitions() == 4
    monkeypatch.setattr(common, "TASK_ROWS", 1)
    assert wide(spark, documents([(k, "a") for k in range(40)]), "").rdd.getNumPartitions() == 32
