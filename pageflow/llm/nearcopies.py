"""Near copies by a multi-index Hamming join over b-bit MinHash signatures.

A text's set is its distinct runs of five lower-cased words. Equal sets form one class, and everything
below works on classes. A signature has ``symbols`` symbols of 16 bits; two sets with Jaccard similarity s
differ in a symbol with chance 1 - s, so all but a share ``miss`` of the pairs at the threshold differ in at
most ``distance`` symbols (computed from the binomial distribution). Signatures are cut into chunks, one
more than half the distance: by the pigeonhole principle two signatures within the distance differ in at
most one symbol of some chunk. For each chunk and each of its places a key leaves that place out, which
enumerates the allowed error; so every pair within the distance shares a key.

No bucket of equal keys is expanded into all its pairs. First each member is compared with the smallest
member of its buckets and linked with the closest of these; confirmed links give components. Up to ``PIVOTS``
times, as long as large groups would be copied to many blocks, buckets that still hold several components draw another
member, and those of other components are compared with it: a pass over the rows of these buckets each time, which leaves
few members outside the largest component of a large group. Then nothing is left to chance: the other smallest members follow, and in buckets that hold several components
the members outside the largest one are compared with all members, in blocks of bounded size that are spread over tasks, and a pair counts in the
first key it shares only. A pair passes if its signatures are within the distance and if the counts
of elements in ``CELLS`` cells of the hash range allow the similarity (their absolute differences add up
to at most the symmetric difference, so this drops no link). Of the pairs that pass, a block hands on a spanning
forest over components, so no more than one pair for each member. Every pair handed on is confirmed on full
sets (100 * intersection >= percent * union). Where all hold, the pairs held back join nothing new; buckets where some
do not are compared again over the new components and hand on 64 times as many forests, until
nothing is held back. So a link is lost only if its signatures are too far apart.

Results: NULL, empty and white-space texts have an empty set and no links; a text with fewer than five
words has its whole sequence as the one element; repeated rows are copies of each other; NULL ids get
rows and lend a component their name only if no other id is in it; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import bytes_of, passing, release, slices, stored, tasks_for, text_of
from pageflow.llm.components import components_by_parts
from pageflow.llm.words import keys, mix, windows, word_hashes

RUN = 5
SYMBOLS = 64
MISS = 1e-5
PIVOTS = 4
BLOCK = 1_024
CELL_BITS = 9
CELLS = 1 << CELL_BITS


def distance_for(similarity: float, symbols: int, miss: float) -> int:
    """Smallest distance that pairs of this similarity exceed with a chance of at most ``miss``."""
    p, tail = 1 - similarity, 1.0
    for d in range(symbols + 1):
        tail -= comb(symbols, d) * p**d * (1 - p) ** (symbols - d)
        if tail <= miss:
            return d
    return symbols


def signatures(values: np.ndarray, offsets: np.ndarray, symbols: int) -> np.ndarray:
    """MinHash symbols (uint16), one row per set; sets end at ``offsets`` and are not empty."""
    low = (values >> np.uint64(32)).astype(np.uint32)
    factor, shift = keys(symbols, 41), keys(symbols, 43)
    out = np.empty((len(offsets) - 1, symbols), np.uint16)
    for k in range(symbols):
        hashed = low * np.uint32(factor[k] & np.uint64(0xFFFFFFFF))
        hashed += np.uint32(shift[k] & np.uint64(0xFFFFFFFF))
        least = np.minimum.reduceat(hashed, offsets[:-1]).astype(np.uint64)
        out[:, k] = mix(least) & np.uint64(0xFFFF)
    return out


def chunk_keys(signs: np.ndarray, distance: int) -> np.ndarray:
    """Keys per signature: one for each chunk and place left out; pairs within the distance share one."""
    n, symbols = signs.shape
    chunks = min(distance // 2 + 1, symbols)
    bounds = np.linspace(0, symbols, chunks + 1).astype(int)
    weights, salts = keys(symbols, 51), keys(symbols, 53)
    parts = signs.astype(np.uint64) + np.uint64(1)
    parts *= weights
    out = np.empty((n, symbols), np.uint64)
    for start, stop in zip(bounds, bounds[1:]):
        total = parts[:, start:stop].sum(axis=1)
        for k in range(start, stop):
            out[:, k] = mix(total - parts[:, k] + salts[k])
    return out


def _sets(part: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct run hashes of each text."""
    hashes, before = word_hashes(*bytes_of(part))
    runs, offsets = windows(hashes, before, RUN)
    for a, b in zip(offsets, offsets[1:]):
        own = np.sort(runs[a:b])
        yield own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def signed(docs: DataFrame, symbols: int) -> DataFrame:
    """Per row of (_id, _print, _text): set size, digest of the set, signature."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                sets = list(_sets(part.column("_text")))
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                signs: list[bytes | None] = [None] * len(sets)
                cells: list[bytes | None] = [None] * len(sets)
                if len(full):
                    offsets = np.concatenate([[0], np.cumsum(sizes[full])])
                    values = np.concatenate([sets[k] for k in full])
                    for k, sign, counts in zip(full, signatures(values, offsets, symbols), cell_counts(values, offsets)):
                        signs[k], cells[k] = sign.tobytes(), counts.tobytes()
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_print"), pa.array(sizes), *[pa.array(x, pa.binary()) for x in (digests, signs, cells)]],
                    ["_id", "_print", "_size", "_digest", "_sign", "_cells"],
                )

    return docs.mapInArrow(run, "_id long, _print long, _size long, _digest binary, _sign binary, _cells binary")


def cell_counts(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Elements of each set in each cell of the hash range, up to 255."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    cell = (values >> np.uint64(64 - CELL_BITS)).astype(np.int64)
    return np.minimum(np.bincount(owner * CELLS + cell, minlength=n * CELLS).reshape(n, CELLS), 255).astype(np.uint8)


def possible(x: np.ndarray, y: np.ndarray, x_size: np.ndarray, y_size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether cell counts (int16) allow the similarity; also returns the differences.

    With union u, common part i and symmetric difference d: 100 i >= percent u means
    (100 + percent) d <= (100 - percent) (|x| + |y|).
    """
    apart = np.abs(x - y).sum(axis=-1, dtype=np.int64)
    apart = np.maximum(apart, np.abs(x_size - y_size))
    return (100 + percent) * apart <= (100 - percent) * (x_size + y_size), apart


def _cells(column: pa.Array) -> np.ndarray:
    data, ends = bytes_of(column)
    return data.reshape(len(ends) - 1, CELLS).astype(np.int16)


def _signs(column: pa.Array) -> np.ndarray:
    data, ends = bytes_of(column)
    return data.view(np.uint16).reshape(len(ends) - 1, -1) if len(ends) > 1 else np.zeros((0, 1), np.uint16)


def keyed(classes: DataFrame, distance: int) -> DataFrame:
    """All keys of all classes: ``key``, ``c``."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                found = chunk_keys(_signs(part.column("_sign")), distance)
                owners = np.repeat(part.column("c").to_numpy(), found.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(found.ravel().view(np.int64)), pa.array(owners)], ["key", "c"])

    return classes.select("c", "_sign").mapInArrow(run, "key long, c long")


SKETCH = ("_size", "_sign", "_cells")


def within(pairs: DataFrame, classes: DataFrame, distance: int, percent: int) -> DataFrame:
    """The pairs (a, b) that signatures and cells allow, with the differences of their cells as ``apart``."""
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("c").alias(side), *[F.col(x).alias(f"{x}_{side}") for x in SKETCH]), side)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                batch = whole.slice(at, 2_000)
                near = (_signs(batch.column("_sign_a")) != _signs(batch.column("_sign_b"))).sum(axis=1) <= distance
                sizes = [batch.column(f"_size_{side}").to_numpy() for side in ("a", "b")]
                allowed, apart = possible(_cells(batch.column("_cells_a")), _cells(batch.column("_cells_b")), *sizes, percent)
                left = pa.array(near & allowed)
                arrays = [batch.column("a"), batch.column("b"), pa.array(apart)]
                yield pa.RecordBatch.from_arrays([x.filter(left) for x in arrays], ["a", "b", "apart"])

    columns = [f"{x}_{side}" for x in SKETCH for side in ("a", "b")]
    return pairs.select("a", "b", *columns).mapInArrow(run, "a long, b long, apart long")


def confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, percent: int, tasks: int) -> DataFrame:
    """The pairs (a, b), stored and distinct, whose full sets are similar enough. ``texts`` has _id, _print, _text.

    The sets are written by so many tasks at most.
    """
    needed = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    rows = classes.join(needed, "c", "left_semi").select("c", F.col("_first._id").alias("_i"), F.col("_first._print").alias("_p"))
    same = texts["_id"].eqNullSafe(rows["_i"]) & (texts["_print"] == rows["_p"])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                sets = [s.tobytes() for s in _sets(part.column("_text"))]
                yield pa.RecordBatch.from_arrays([part.column("c"), pa.array(sets, pa.binary())], ["c", "_set"])

    sets = texts.join(rows, same).select("c", "_text").mapInArrow(run, "c long, _set binary").dropDuplicates(["c"])
    sets = stored(sets.coalesce(tasks), "near-sets")
    both = pairs.join(sets.select(F.col("c").alias("a"), F.col("_set").alias("_set_a")), "a")
    both = both.join(sets.select(F.col("c").alias("b"), F.col("_set").alias("_set_b")), "b")

    def compare(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                linked = []
                for x, y in zip(part.column("_set_a"), part.column("_set_b")):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    merged = np.sort(np.concatenate([x, y]), kind="stable")
                    common = int((merged[1:] == merged[:-1]).sum())
                    linked.append(100 * common >= percent * (len(x) + len(y) - common))
                near = part.filter(pa.array(linked, pa.bool_()))
                yield pa.RecordBatch.from_arrays([near.column("a"), near.column("b")], ["a", "b"])

    return both.select("a", "b", "_set_a", "_set_b").mapInArrow(compare, "a long, b long")


def _named(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Adds ``comp``, the component of ``c`` (itself where it has no links)."""
    names = found.select(F.col("node").alias("c"), F.col("component").alias("comp"))
    return rows.join(names, "c", "left").withColumn("comp", F.coalesce("comp", "c"))


def open_sizes(rows: DataFrame) -> DataFrame:
    """Of buckets of several components: members ``n``, the largest component ``main``, and members outside it ``q``.

    Counted in two steps, so that no task holds the components of a bucket.
    """
    main = F.max(F.struct(F.col("_m"), F.col("comp")))["comp"].alias("main")
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("_m")).groupBy("key").agg(
        F.sum("_m").alias("n"), (F.sum("_m") - F.max("_m")).alias("q"), main
    )
    return sizes.where("q > 0 and n > 2")


def copied_much(buckets: DataFrame, found: DataFrame) -> bool:
    """Whether blocks would get over twice the rows that the open buckets hold, as those of large groups do."""
    sizes = open_sizes(_named(buckets.select("key", "c"), found))
    copies = F.expr(f"n * ceil(q / {BLOCK}) + q * ceil(n / {BLOCK})")
    sums = sizes.agg(F.sum(copies).alias("copies"), F.sum(F.col("n") + F.col("q")).alias("rows")).first()
    return (sums["copies"] or 0) > 2 * (sums["rows"] or 0)


def open_pairs(buckets: DataFrame, classes: DataFrame, found: DataFrame, distance: int, percent: int, forests: int = 1) -> DataFrame:
    """Close pairs in buckets that hold several components: ``forests`` spanning forests over components for each block.

    ``held`` marks pairs of blocks that hand on less than all their pairs.

    ``buckets`` has key, c. Members of a bucket's largest component are targets; the others are targets and
    queries. Both are dealt to blocks by hash, and each (target block, query block) is compared in a task.
    """
    rows = stored(_named(buckets.select("key", "c"), found), "near-named")
    sizes = open_sizes(rows)
    rows = rows.join(sizes, "key").withColumn("out", F.col("comp") != F.col("main")).join(classes.select("c", *SKETCH), "c")
    t_blocks, q_blocks = F.ceil(F.col("n") / BLOCK).cast("int"), F.ceil(F.col("q") / BLOCK).cast("int")
    own = F.xxhash64("c", "key")
    targets = rows.select(
        "key", F.pmod(own, t_blocks).cast("int").alias("tb"), F.explode(F.sequence(F.lit(0), q_blocks - 1)).alias("qb"),
        "c", "comp", *SKETCH, F.lit(False).alias("query"),
    )
    queries = rows.where("out").select(
        "key", F.explode(F.sequence(F.lit(0), t_blocks - 1)).alias("tb"), F.pmod(own, q_blocks).cast("int").alias("qb"),
        "c", "comp", *SKETCH, F.lit(True).alias("query"),
    )
    dealt = targets.unionByName(queries).withColumn("_place", F.xxhash64("key", "tb", "qb"))
    dealt = dealt.repartition("_place").sortWithinPartitions("_place").select("_place", "key", "c", "comp", *SKETCH, "query")

    def compare(batches):
        kept: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            places = rows.column("_place").to_numpy()
            last = int(np.searchsorted(places, places[-1]))
            kept = rows.slice(last)
            if last:
                yield from _compared(rows.slice(0, last), distance, percent, forests)
        if kept is not None:
            yield from _compared(kept, distance, percent, forests)

    return dealt.mapInArrow(compare, "a long, b long, held boolean, key long")


def _compared(rows: pa.Table, distance: int, percent: int, forests: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a query and a target at one place that sketches allow, in different components, at their first key.

    Of each place, those in the first ``forests`` spanning forests over components are handed on.
    """
    rows = rows.combine_chunks()
    places = rows.column("_place").to_numpy()
    key, c, comp, size, query = (rows.column(n).to_numpy() for n in ("key", "c", "comp", "_size", "query"))
    cuts = np.concatenate([[0], np.flatnonzero(places[1:] != places[:-1]) + 1, [len(places)]])
    for start, stop in zip(cuts, cuts[1:]):
        signs = _signs(rows.column("_sign").slice(start, stop - start).combine_chunks())
        cells = _cells(rows.column("_cells").slice(start, stop - start).combine_chunks())
        own = chunk_keys(signs, distance).view(np.int64)
        asks, has = np.flatnonzero(query[start:stop]), np.flatnonzero(~query[start:stop])
        names, sets = np.unique(comp[start:stop], return_inverse=True)[1], size[start:stop]
        woods = [np.arange(len(names)) for _ in range(forests)]  # the tree of each component, forest by forest
        left, right, held = [], [], False
        for q in asks:
            # What every forest joins already is looked at no more; with one forest, that is most of a group.
            apart_yet = names[has] != names[q]
            if forests == 1:
                apart_yet = woods[0][names[has]] != woods[0][names[q]]
            other = has[apart_yet]
            other = other[(signs[other] != signs[q]).sum(axis=1) <= distance]
            if len(other):
                first = (own[other] == own[q]).argmax(axis=1)
                other = other[own[q][first] == key[start + q]]
            if not len(other):
                continue
            allowed, apart = possible(cells[other], cells[q], sets[other], sets[q], percent)
            for t in other[allowed][np.argsort(apart[allowed], kind="stable")].tolist():
                x, y = names[q], names[t]
                wood = next((w for w in woods if w[x] != w[y]), None)
                if wood is None:
                    held = True
                    continue
                wood[wood == wood[x]] = wood[y]
                left.append(min(c[start + t], c[start + q]))
                right.append(max(c[start + t], c[start + q]))
        if left:
            flag = held or forests == 1  # one forest does not look at what it joins already
            ends = [pa.array(x, pa.int64()) for x in (left, right, [key[start]] * len(left))]
            yield pa.RecordBatch.from_arrays([*ends[:2], pa.array([flag] * len(left)), ends[2]], ["a", "b", "held", "key"])


def pivot_pairs(buckets: DataFrame, found: DataFrame, turn: int) -> DataFrame:
    """In every bucket of several components, one member drawn by hash (a) with each member of another component (b)."""
    rows = stored(_named(buckets.select("key", "c"), found), "near-named")
    drawn = F.min(F.struct(F.xxhash64("c", F.lit(turn)).alias("h"), "c", "comp"))
    pivots = rows.groupBy("key").agg(drawn.alias("_p"), F.min("comp").alias("_x"), F.max("comp").alias("_y")).where("_x <> _y")
    pivots = pivots.select("key", F.col("_p.c").alias("a"), F.col("_p.comp").alias("_comp"))
    return rows.join(pivots, "key").where("comp <> _comp").select("a", F.col("c").alias("b")).distinct()


def _closest(near: DataFrame) -> DataFrame:
    """Of pairs with their differences, that with the smallest one for each b; the smaller end first."""
    least = near.groupBy("b").agg(F.min(F.struct("apart", "a")).alias("_m")).select(F.col("_m.a").alias("a"), "b")
    return least.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _across(pairs: DataFrame, found: DataFrame, *keep: str) -> DataFrame:
    """The distinct pairs (a, b), with the kept columns, whose ends are in different components."""
    names = found.select("node", "component")
    return (
        pairs.select("a", "b", *keep)
        .distinct()
        .join(names.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
        .join(names.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
        .where(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
        .select("a", "b", *keep)
    )


@passing("near-members", "near-empty")
def near_copies(
    docs: DataFrame,
    percent: int = 85,
    id_col: str = "doc_id",
    text_col: str = "text",
    symbols: int = SYMBOLS,
    miss: float = MISS,
) -> DataFrame:
    """One row per document: ``_id``, ``_print`` (hash of its text), set size, component (its smallest id).

    ``stays`` marks the one document of a component that is kept; rows that repeat it whole are marked too.
    """
    distance = distance_for(percent / 100, symbols, miss)
    text = text_of(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_print"), text.alias("_text"))
    rows = stored(signed(texts, symbols), "near-signatures")
    tasks = tasks_for(rows.count())

    def kept(df: DataFrame, name: str) -> DataFrame:
        return stored(df.coalesce(tasks), f"near-{name}")

    first = F.min(F.struct(F.col("_id").isNull().alias("_null"), "_id", "_print")).alias("_first")
    classes = rows.where("_size > 0").groupBy("_digest", *SKETCH).agg(first)
    classes = kept(classes.withColumn("c", F.monotonically_increasing_id()), "classes")

    found = keyed(classes, distance)
    heads = found.groupBy("key").agg(F.min("c").alias("head"), F.count("*").alias("n")).where("n > 1").select("key", "head")
    buckets = kept(found.join(heads, "key"), "buckets")
    stars = buckets.where("c <> head").select(F.col("head").alias("a"), F.col("c").alias("b")).distinct()
    stars = kept(within(stars, classes, distance, percent), "stars")

    closest = kept(_closest(stars), "closest")
    release(docs.sparkSession)
    links = kept(confirmed(closest, classes, texts, percent, tasks), "links")
    joined = components_by_parts(links)
    failed = kept(closest.join(links, ["a", "b"], "left_anti"), "refused")
    for turn in range(PIVOTS):
        if not copied_much(buckets, joined):
            break
        release(docs.sparkSession)
        near = within(pivot_pairs(buckets, joined, turn), classes, distance, percent)
        closest = kept(_closest(near).join(failed, ["a", "b"], "left_anti"), "closest")
        more = kept(confirmed(closest, classes, texts, percent, tasks), "links") if closest.head(1) else None
        if more is None or not more.head(1):
            break
        links, failed = links.unionByName(more), failed.unionByName(closest.join(more, ["a", "b"], "left_anti"))
        joined = components_by_parts(links)
    todo, forests = stars.select("a", "b"), 1
    while True:
        release(docs.sparkSession)
        opened = kept(open_pairs(buckets, classes, joined, distance, percent, forests), "open-pairs")
        todo = _across(todo.unionByName(opened.select("a", "b")), joined).join(failed, ["a", "b"], "left_anti")
        todo = kept(todo, "candidates")
        release(docs.sparkSession)
        more = kept(confirmed(todo, classes, texts, percent, tasks), "links")
        if more.head(1):
            links = links.unionByName(more)
            joined = components_by_parts(links)
        # A bucket whose handed-on pairs all hold has nothing left to join.
        keys_left = kept(_across(opened.where("held"), joined, "key").select("key").distinct(), "keys")
        if not keys_left.head(1):
            break
        refused = kept(todo.join(more, ["a", "b"], "left_anti"), "refused")
        failed, buckets = failed.unionByName(refused), buckets.join(keys_left, "key", "left_semi")
        todo, forests = refused.limit(0), 64 * forests

    release(docs.sparkSession)
    named = _named(classes.select("c", "_digest"), joined)
    full = rows.where("_size > 0").join(named.select("_digest", "comp"), "_digest").select("_id", "_print", "_size", "comp")
    full = kept(full, "members")
    smallest = full.groupBy("comp").agg(first).select("comp", F.col("_first._id").alias("component_id"), F.col("_first._print").alias("_p"))
    stays = F.col("_id").eqNullSafe(F.col("component_id")) & (F.col("_print") == F.col("_p"))
    full = full.join(smallest, "comp").select("_id", "_print", "_size", "component_id", stays.alias("stays"))
    empty = rows.where("_size = 0").select("_id", "_print", "_size", F.col("_id").alias("component_id"), F.lit(True).alias("stays"))
    return full.unionByName(kept(empty, "empty"))
