"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into blocks of sixteen words; two or four blocks in a row form a passage. Terms are words
hashed to a fixed number of slots. The distinct blocks are stored once, so that copies do not count. Three
scans: (1) frequencies of the slots in distinct blocks; (2) a sketch Z = A'(A W) of the TF-IDF matrix A of
these blocks with a random matrix W, summed over tasks, from which the leading singular vectors follow on the
driver (Nystrom's form of the randomised SVD; Z has a fixed size, slots times rank); (3) every passage is
projected and compared with the benchmark's items by cosine, and each candidate is checked on the words
themselves. Items longer than a passage are compared piece by piece too, and checked whole. A second path gives more candidates, whatever the weights: texts that share a run of ``RUN_WORDS``
words with an item. Words of items that would have few weighted words keep a weight. An item counts as leaked where the longest common subsequence
with the text around the passage covers ``share`` of its words, or ``loose`` of them together with the item's
answer (its last sentence, or else its last quarter). Items are compared in blocks of bounded size.

Results: NULL and empty texts and items match nothing; items with fewer than ``LEAST_WORDS`` words are found
where their words stand in a row, all of them; repeated rows each give a row, NULL ids too (also of items); an empty benchmark leaves all documents clean; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import CHUNK_BYTES, bytes_of, digest_of, passing, release, slices, stored, tasks_for, text_of
from pageflow.llm.words import LETTERS, windows, word_hashes

SLOTS = 1 << 14
RANK = 96
OVERSAMPLE = 8
BLOCK_WORDS = 16
# Passages: blocks in a row, and at which blocks of a text one starts.
PASSAGES = ((2, 1), (4, 2))
COMMON, LEAST_COMMON = 0.01, 8
# Items with a smaller share of weighted words have weights of at least FLOOR for all their words.
LEAST_WEIGHTED, FLOOR = 0.25, 0.1
RUN_WORDS = 5
RUN_BITS = 20
COSINE = 0.45
SHARE, LOOSE = 0.8, 0.6
LEAST_WORDS = 8
ITEM_BLOCK = 2_000
OFTEN = 96
SEED = 5


def blocks_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, words before each text, first word of each block, and the text of each block."""
    hashes, before = word_hashes(data, ends, LETTERS)
    counts = np.diff(before)
    blocks = -(-counts // BLOCK_WORDS)
    owner = np.repeat(np.arange(len(counts)), blocks)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return hashes, before, before[owner] + place * BLOCK_WORDS, owner


def slots_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def block_ids(starts: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))


def distinct_blocks(rows: DataFrame) -> DataFrame:
    """The slots of every block (two bytes each, in word order), equal blocks once."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                hashes, _, starts, _ = blocks_of(*bytes_of(part.column("_text")))
                ends = pa.py_buffer(np.append(starts, len(hashes)).astype(np.int32) * 2)
                data = pa.py_buffer(slots_of(hashes).astype("<u2"))
                found = pa.Array.from_buffers(pa.binary(), len(starts), [None, ends, data])
                yield pa.RecordBatch.from_arrays([found.unique()], ["slots"])

    found = rows.mapInArrow(run, "slots binary").distinct()
    return stored(found.coalesce(tasks_for(rows.count())), "leak-blocks")


def slots_in(batch: pa.RecordBatch):
    """Slots and first slot of each block, for parts of a batch of blocks."""
    for part in slices(batch, "slots", CHUNK_BYTES // 4):
        data, ends = bytes_of(part.column("slots"))
        yield np.frombuffer(data.tobytes(), "<u2").astype(np.int64), ends[:-1] // 2


def passage_frequencies(blocks: DataFrame) -> tuple[np.ndarray, int]:
    """Distinct blocks that have each slot, and the number of distinct blocks."""

    def run(batches):
        seen, total = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for slots, starts in slots_in(batch):
                kind = np.int32 if len(starts) * SLOTS < 1 << 31 else np.int64
                pairs = np.sort((block_ids(starts, len(slots)) * SLOTS + slots).astype(kind))
                pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
                seen += np.bincount(pairs % SLOTS, minlength=SLOTS)
                total += len(starts)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(seen[used], total))], ["slot", "n"])

    found = blocks.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(SLOTS, np.int64)
    total = 0
    for r in found:
        if r["slot"] < 0:
            total = r["n"]
        else:
            seen[r["slot"]] = r["n"]
    return seen, total


def term_weights(seen: np.ndarray, total: int) -> np.ndarray:
    """Inverse passage frequencies; terms in more than a share ``COMMON`` of the blocks tell nothing and get 0."""
    idf = np.log((1 + total) / (1 + seen))
    return np.where(seen <= max(COMMON * total, LEAST_COMMON), idf, 0.0).astype(np.float32)


def floored(weights: np.ndarray, seen: np.ndarray, total: int, items: DataFrame) -> np.ndarray:
    """The weights, with one for every word of items (column ``text``) that have few weighted words."""
    sent = items.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        kept = np.zeros(SLOTS, bool)
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, before = word_hashes(*bytes_of(part.column("text")), LETTERS)
                slots = slots_of(hashes)
                counts = np.diff(before)
                owner = np.repeat(np.arange(len(counts)), counts)
                weighted = np.bincount(owner, weights=sent.value[slots] > 0, minlength=len(counts))
                kept[slots[(weighted < LEAST_WEIGHTED * counts)[owner]]] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(kept), pa.int64())], ["slot"])

    kept = np.array([r["slot"] for r in items.select("text").mapInArrow(run, "slot long").distinct().collect()], np.int64)
    out = weights.copy()
    out[kept] = np.maximum(np.log((1 + total) / (1 + seen[kept])), FLOOR)
    return out


def weighted_blocks(slots: np.ndarray, starts: np.ndarray, weights: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Per block the weighted sum of the table's rows at its slots."""
    scaled = np.zeros((SLOTS + 1, table.shape[1]), np.float32)
    scaled[:-1] = table * weights[:, None]
    ids = block_ids(starts, len(slots))
    used = np.flatnonzero(weights[slots])
    slots, ids = slots[used], ids[used]
    heads = np.searchsorted(ids, np.arange(len(starts)))
    laid = np.full((len(starts), BLOCK_WORDS), SLOTS, np.int64)
    laid[ids, np.arange(len(ids)) - heads[ids]] = slots
    longest = np.diff(np.append(heads, len(ids)))
    out = np.zeros((len(starts), table.shape[1]), np.float32)
    for at in range(0, len(starts), 2_048):
        part, sums = laid[at : at + 2_048], out[at : at + 2_048]
        for k in range(int(longest[at : at + 2_048].max(initial=0))):
            sums += scaled[part[:, k]]
    return out


def add_rows(total: np.ndarray, slots: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
    """Adds rows[ids] to total[slots], slots repeating."""
    order = np.argsort(slots.astype(np.uint16), kind="stable")
    slots, ids = slots[order], ids[order]
    heads = np.append(0, np.flatnonzero(slots[1:] != slots[:-1]) + 1)
    counts = np.diff(np.append(heads, len(slots)))
    often = counts >= OFTEN
    for head, n in zip(heads[often], counts[often]):
        for at in range(head, head + n, 4_096):
            total[slots[head]] += rows[ids[at : min(at + 4_096, head + n)]].sum(axis=0)
    heads, counts = heads[~often], counts[~often]
    for k in range(int(counts.max(initial=0))):
        heads = heads[counts > k]
        counts = counts[counts > k]
        total[slots[heads + k]] += rows[ids[heads + k]]


def sketch(blocks: DataFrame, weights: np.ndarray, width: int) -> np.ndarray:
    """A'(A W) over the distinct blocks, W being random normal."""
    sent = blocks.sparkSession.sparkContext.broadcast(weights)
    columns = [f"z{k}" for k in range(width)]

    def run(batches):
        own = sent.value
        random = np.random.default_rng(SEED).standard_normal((SLOTS, width)).astype(np.float32)
        total = np.zeros((SLOTS, width), np.float64)
        for batch in batches:
            for slots, starts in slots_in(batch):
                seen = weighted_blocks(slots, starts, own, random)
                used = np.flatnonzero(own[slots])
                if len(used):
                    add_rows(total, slots[used], block_ids(starts, len(slots))[used], seen)
        total *= own[:, None]
        filled = np.flatnonzero(np.abs(total).sum(axis=1))
        arrays = [pa.array(filled), *[pa.array(total[filled, k]) for k in range(width)]]
        yield pa.RecordBatch.from_arrays(arrays, ["slot", *columns])

    summed = blocks.mapInArrow(run, "slot long, " + ", ".join(f"{c} double" for c in columns))
    # At most SLOTS rows, whatever the size of the corpus, fetched by one job: an iterator would run one per partition.
    rows = summed.groupBy("slot").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    z = np.zeros((SLOTS, width))
    at = rows.column("slot").to_numpy()
    for k, c in enumerate(columns):
        z[at, k] = rows.column(c).to_numpy()
    return z


def latent(z: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors (columns) and singular values of A, from the sketch of A'A."""
    random = np.random.default_rng(SEED).standard_normal(z.shape).astype(np.float32).astype(np.float64)
    shift = 1e-9 * np.linalg.norm(z)
    z = z + shift * random
    inner = random.T @ z
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    good = values > max(values[-1], 0) * 1e-10
    half = z @ (vectors[:, good] / np.sqrt(values[good]))
    left, sizes, _ = np.linalg.svd(half, full_matrices=False)
    keep = min(rank, len(sizes))
    return left[:, :keep], np.sqrt(np.maximum(sizes[:keep] ** 2 - shift, 0))


def projection(vectors: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Latent coordinates with all concepts on one scale, so that those all texts share do not rule the cosine."""
    if not len(sizes) or sizes[0] <= 0:
        return np.zeros((SLOTS, 1), np.float32)
    return (vectors / np.maximum(sizes, 1e-3 * sizes[0])).astype(np.float32)


def longest_common(item: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence of an item (bit masks of the places of its words) and words."""
    full = (1 << size) - 1
    row = full
    for w in words:
        mask = item.get(w)
        if mask is not None:
            part = row & mask
            row = ((row + part) | (row - part)) & full
    return size - row.bit_count()


def masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | (1 << k)
    return out


@dataclass
class Items:
    """Benchmark items of one block: ids, words, answers and latent directions."""

    ids: list
    words: list[list[int]]
    answers: list[list[int]]
    directions: np.ndarray  # of each item, and then of the pieces of long ones
    owners: np.ndarray  # the item of each direction
    telling: np.ndarray  # (slots, items): slots of an item's words that have a weight
    needed: np.ndarray  # fewest of these words in a text around a leak
    runs: np.ndarray  # ascending hashes of runs of words, and the item of each
    run_items: np.ndarray
    run_bits: np.ndarray  # which leading bits these hashes have
    short: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # the same for whole items of so many words, below LEAST_WORDS

    @staticmethod
    def of(rows: list[tuple[int, str]], weights: np.ndarray, table: np.ndarray) -> Items:
        ids, words, answers, directions, pieces, owners = [], [], [], [], [], []
        longest = max(width for width, _ in PASSAGES) * BLOCK_WORDS
        for item_id, text in rows:
            own = _words(text)
            if not own:
                continue
            parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if p]
            last = _words(parts[-1]) if len(parts) > 1 else []
            ids.append(item_id)
            words.append(own)
            answers.append(last if last else own[-max(1, len(own) // 4) :])
            slots = slots_of(np.array(own, np.uint64))
            weighted = table[slots] * weights[slots][:, None]
            directions.append(weighted.sum(axis=0))
            if len(own) > longest:
                heads = [*range(0, len(own) - longest, longest), len(own) - longest]
                pieces += [weighted[head : head + longest].sum(axis=0) for head in heads]
                owners += [len(ids) - 1] * len(heads)
        vectors = np.array(directions + pieces, np.float32).reshape(len(ids) + len(pieces), table.shape[1])
        if len(ids):
            vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        telling, needed = np.zeros((SLOTS, len(ids)), bool), np.zeros(len(ids), np.int64)
        for i, own in enumerate(words):
            slots = slots_of(np.array(own, np.uint64))
            slots = slots[weights[slots] > 0]
            telling[slots, i] = True
            # A share LOOSE of all words must be there, so at most the rest of the telling ones may be missing.
            needed[i] = max(0, len(slots) - int((1 - LOOSE) * len(own) + 1e-9))
        sizes = np.array([len(w) for w in words], np.int64)
        long = np.flatnonzero(sizes >= LEAST_WORDS)
        short = {n: _runs(words, np.flatnonzero(sizes == n), n) for n in np.unique(sizes[sizes < LEAST_WORDS]).tolist()}
        owners = np.append(np.arange(len(ids)), np.array(owners, np.int64))
        return Items(ids, words, answers, vectors, owners, telling, needed, *_runs(words, long, RUN_WORDS), short)


def _runs(words: list[list[int]], chosen: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of the chosen items in ascending order, their items, and their leading bits."""
    before = np.cumsum([0, *(len(words[i]) for i in chosen)])
    hashes, offsets = windows(np.array([w for i in chosen for w in words[i]], np.uint64), before, size)
    items = np.repeat(chosen, np.diff(offsets))
    order = np.lexsort((items, hashes))
    hashes, items = hashes[order], items[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (items[1:] != items[:-1]))[: len(hashes)]
    bits = np.zeros(1 << RUN_BITS, bool)
    bits[hashes >> np.uint64(64 - RUN_BITS)] = True
    return hashes[new], items[new], bits


def _words(text: str) -> list[int]:
    raw = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]), LETTERS)[0].tolist()


def search(rows: DataFrame, items: Items, weights: np.ndarray, table: np.ndarray, cosine: float) -> DataFrame:
    """Per text with leaks: _id, _digest, and (item, cosine, share of its words found)."""
    sent = rows.sparkSession.sparkContext.broadcast((items, weights, table))
    leak = pa.list_(pa.struct([("item", pa.int64()), ("cosine", pa.float64()), ("share", pa.float64())]))

    def run(batches):
        own, weight, basis = sent.value
        lookups = [masks(w) for w in own.words]
        for batch in batches:
            for part in slices(batch, "_text"):
                found = _leaks(part, own, lookups, weight, basis, cosine)
                if found:
                    at = pa.array(sorted(found))
                    leaks = [[{"item": own.ids[i], "cosine": c, "share": s} for i, (c, s) in sorted(found[k].items())] for k in sorted(found)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("_id").take(at), part.column("_digest").take(at), pa.array(leaks, leak)], ["_id", "_digest", "leaks"]
                    )

    schema = "_id long, _digest binary, leaks array<struct<item: long, cosine: double, share: double>>"
    return rows.mapInArrow(run, schema)


def _leaks(part, own: Items, lookups, weights, basis, cosine: float) -> dict[int, dict[int, tuple[float, float]]]:
    """Per text of the part, its leaked items with cosine and share."""
    hashes, before, starts, owner = blocks_of(*bytes_of(part.column("_text")))
    found: dict[int, dict[int, tuple[float, float]]] = {}
    if not len(starts) or not own.ids:
        return found
    slots = slots_of(hashes)
    vectors = weighted_blocks(slots, starts, weights, basis)
    sums = np.concatenate([np.zeros((1, vectors.shape[1])), np.cumsum(vectors, axis=0, dtype=np.float64)])
    first = np.searchsorted(owner, owner)
    last = np.searchsorted(owner, owner, side="right")
    telling = np.flatnonzero(weights[slots])
    for width, every in PASSAGES:
        rows = np.arange(len(starts))
        rows = rows[(rows - first) % every == 0]
        for at in range(0, len(rows), 2_048):
            some = rows[at : at + 2_048]
            stop = np.minimum(some + width, last[some])
            passage = (sums[stop] - sums[some]).astype(np.float32)
            passage /= np.maximum(np.linalg.norm(passage, axis=1, keepdims=True), 1e-12)
            near = passage @ own.directions.T
            block, item = np.nonzero(near >= cosine)
            values = near[block, item]
            item = own.owners[item]
            whole = np.array([len(w) for w in own.words])[item] >= LEAST_WORDS
            block, item, values = block[whole], item[whole], values[whole]
            if len(block):
                _checked(found, own, lookups, hashes, slots, telling, before, starts, owner, some[block], stop[block], item, values)

    def cosines(block, item):
        values = np.full(len(block), -1.0)
        for width, _ in PASSAGES:
            passage = sums[np.minimum(block + width, last[block])] - sums[block]
            size = np.maximum(np.linalg.norm(passage, axis=1), 1e-12)
            values = np.maximum(values, (passage * own.directions[item]).sum(axis=1) / size)
        return values

    for block, item in _sharing(own, (own.runs, own.run_items, own.run_bits), RUN_WORDS, hashes, before, starts):
        _checked(found, own, lookups, hashes, slots, telling, before, starts, owner, block, block + 1, item, cosines(block, item))
    for size, known in own.short.items():
        for block, item in _sharing(own, known, size, hashes, before, starts):
            for t, i, c in zip(owner[block].tolist(), item.tolist(), cosines(block, item).tolist()):
                found.setdefault(t, {}).setdefault(i, (c, 1.0))
    return found


def _sharing(own: Items, known, size: int, hashes, before, starts):
    """Blocks in which a known run of words starts, with the item that has it; no pair twice in a part."""
    known_runs, known_items, known_bits = known
    if not len(known_runs):
        return
    runs, offsets = windows(hashes, before, size)
    at = np.flatnonzero(known_bits[runs >> np.uint64(64 - RUN_BITS)])
    low, high = np.searchsorted(known_runs, runs[at]), np.searchsorted(known_runs, runs[at], side="right")
    at, low, counts = at[high > low], low[high > low], (high - low)[high > low]
    text = np.searchsorted(offsets, at, side="right") - 1
    block = np.searchsorted(starts, at - offsets[text] + before[text], side="right") - 1
    ends = np.cumsum(counts)
    head = 0
    while head < len(at):
        stop = max(head + 1, int(np.searchsorted(ends, ends[head] - counts[head] + (1 << 16), side="right")))
        part = slice(head, stop)
        n = counts[part]
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[part], n)
        pairs = np.unique(np.repeat(block[part], n) * len(own.ids) + known_items[place])
        yield pairs // len(own.ids), pairs % len(own.ids)
        head = stop


def _checked(found, own: Items, lookups, hashes, slots, telling, before, starts, owner, block, stop, item, values) -> None:
    """Adds the candidates (passages from ``block`` to ``stop``, items) that hold on the words themselves."""
    sizes = np.array([len(w) for w in own.words])[item]
    text = owner[block]
    start = np.maximum(before[text], starts[block] - sizes)
    end = np.minimum(before[text + 1], starts[block] + (stop - block) * BLOCK_WORDS + sizes)
    low, high = np.searchsorted(telling, start), np.searchsorted(telling, end)
    held = np.cumsum(high - low)
    at = stop_at = 0
    while stop_at < len(block):
        # Parts of a bounded number of words, the texts around long items being long.
        at, limit = stop_at, (held[stop_at - 1] if stop_at else 0) + (1 << 20)
        stop_at = min(at + (1 << 13), max(at + 1, int(np.searchsorted(held, limit, side="right"))))
        part = slice(at, stop_at)
        counts = (high - low)[part]
        offsets = np.cumsum(counts) - counts
        place = np.arange(int(counts.sum())) - np.repeat(offsets, counts) + np.repeat(low[part], counts)
        hits = own.telling[slots[telling[place]], np.repeat(item[part], counts)]
        total = np.concatenate([[0], np.cumsum(hits)])
        hits = total[offsets + counts] - total[offsets]
        for k in at + np.flatnonzero(hits >= own.needed[item[part]]):
            i, t = int(item[k]), int(text[k])
            if i in found.get(t, ()):
                continue
            words = hashes[start[k] : end[k]].tolist()
            share = longest_common(lookups[i], int(sizes[k]), words) / int(sizes[k])
            answer = own.answers[i]
            if share >= SHARE or (share >= LOOSE and longest_common(masks(answer), len(answer), words) >= SHARE * len(answer)):
                found.setdefault(t, {})[i] = (float(values[k]), share)


@passing()
def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    cosine: float = COSINE,
) -> DataFrame:
    """Documents with leaked items, one row for each: ``_id``, ``_digest``, ``leaks``."""
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), digest_of(text_col).alias("_digest"), text_of(text_col).alias("_text"))
    known = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).where(
        "text is not null"
    )
    blocks = distinct_blocks(rows.select("_text"))
    seen, total = passage_frequencies(blocks)
    weights = floored(term_weights(seen, total), seen, total, known)
    release(docs.sparkSession)  # the sketch and its decomposition are what the driver holds most of here
    table = projection(*latent(sketch(blocks, weights, RANK + OVERSAMPLE), RANK))
    release(docs.sparkSession)
    found = None
    held: list[tuple[int, str]] = []

    def searched(found):
        part = search(rows, Items.of(held, weights, table), weights, table, cosine)
        return part if found is None else found.unionByName(part)

    # Items are compared one by one, so it does not matter which of them share a block.
    for r in known.toLocalIterator():
        held.append((r["item"], r["text"]))
        if len(held) == ITEM_BLOCK:
            found, held = searched(found), []
    if held or found is None:
        found = searched(found)
    return found.groupBy("_id", "_digest").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("leaks")))).alias("leaks"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """One row per document: ``_id``, whether it holds a benchmark item, the items, best cosine and share."""
    found = leaks(docs, benchmark, id_col, text_col, **names)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), digest_of(text_col).alias("_digest"))
    named = found.select(F.col("_id").alias("_i"), F.col("_digest").alias("_d"), "leaks")
    joined = rows.join(named, rows["_id"].eqNullSafe(named["_i"]) & (rows["_digest"] == named["_d"]), "left")
    return joined.select(
        "_id",
        F.col("leaks").isNotNull().alias("contaminated"),
        F.coalesce(F.array_distinct(F.col("leaks")["item"]), F.array().cast("array<long>")).alias("item_ids"),
        F.array_max(F.col("leaks")["cosine"]).alias("cosine"),
        F.array_max(F.col("leaks")["share"]).alias("share"),
    )
