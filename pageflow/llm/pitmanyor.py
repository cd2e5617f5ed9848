"""Scores of texts under a hierarchical Pitman-Yor bigram model.

Every word is drawn in the restaurant of the word before it. All these restaurants share one parent, the
restaurant of single words, whose base is uniform over the vocabulary and one place for unknown words.
Tokens are lower-cased words and one end per text. With c customers and t tables of a dish, discount d and
strength s, a restaurant predicts (c - d t + (s + d T) parent) / (s + C). A table in a context is a customer
of the parent.

Seating is sampled by Gibbs sweeps: each sweep draws the number of tables of every dish of every context
from its conditional given the parent's predictions and the tables of the sweep before, and then those of the
parent. With weight w of a new table, t tables of c customers have a probability in proportion to w^t S(c, t), S
being generalised Stirling numbers: a table of them up to ``EXACT`` customers, and above that Metropolis steps
that keep this distribution, with S by a contour integral whatever the count. All dishes are drawn at once, given
the totals of the sweep before. Text scores use predictive probabilities averaged over the sweeps after
``BURN_IN``. Discounts follow from the numbers of dishes with one and two customers, strengths are constants.

How it runs: one scan finds the contexts with over a thousandth of all tokens (at most a thousand; only
they are spread over buckets by context and word, all others go to a bucket by context). A second scan sends
each bucket its tokens, packed; each bucket merges them into pairs with counts, stored as a bucketed table so
that sweeps do not shuffle it. Buckets and the parent's word buckets exchange packed arrays in word order.
The number of buckets follows the tokens. At last buckets send sums per document.

Results: a NULL or empty text has one token, the end; a NULL id counts as an empty text for the split;
repeated rows count as often as they occur; without training rows all tokens are unknown and have
probability 1; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import math
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.functions.running import scratch_path
from pageflow.llm.common import bytes_of, slices, stored, text_of
from pageflow.llm.words import mix, word_hashes

END, START = np.uint64(1), np.uint64(2)
BUCKET_TOKENS = 2_000_000
UNIT_TOKENS = 600_000
ROWS = 64  # packed rows of one batch
SWEEPS, BURN_IN = 6, 2
EXACT = 1_024
POINTS = 200
STRENGTH, PARENT_STRENGTH = 1.0, 10.0
HEAVY = 1_000
SEED = 29


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as one compressed value, their lower and higher bytes apart; sorted ones should be given as differences."""
    head = np.array([len(arrays), *[len(a) for a in arrays]], "<i8").tobytes()
    kinds = "".join(f"{a.dtype.str:4}" for a in arrays).encode()
    return zstandard.ZstdCompressor(level=1).compress(head + kinds + b"".join(_planes(a).tobytes() for a in arrays))


def _planes(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T if len(a) else a


def unpack(value: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes = np.frombuffer(raw, "<i8", n, 8)
    at, out = 8 + 8 * n + 4 * n, []
    for k in range(n):
        kind = np.dtype(raw[8 + 8 * n + 4 * k : 12 + 8 * n + 4 * k].decode().strip())
        planes = np.frombuffer(raw, np.uint8, int(sizes[k]) * kind.itemsize, at).reshape(kind.itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += int(sizes[k]) * kind.itemsize
    return out


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of an ascending array, from 0."""
    return np.diff(values, prepend=values.dtype.type(0))


def tokens_of(part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts with an end after each, and the offsets of the texts."""
    hashes, before = word_hashes(*bytes_of(part))
    hashes[hashes <= START] += np.uint64(3)
    n = len(before) - 1
    out = np.full(len(hashes) + n, END, np.uint64)
    out[np.arange(len(hashes)) + np.repeat(np.arange(n), np.diff(before))] = hashes
    return out, before + np.arange(n + 1)


def buckets_of(u: np.ndarray, w: np.ndarray, heavy: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by context, or by context and word for heavy contexts."""
    at = np.searchsorted(heavy, u)
    spread = (heavy[np.minimum(at, len(heavy) - 1)] == u) if len(heavy) else np.zeros(len(u), bool)
    return (mix(np.where(spread, u ^ mix(w), u) + np.uint64(SEED)) % np.uint64(buckets)).astype(np.int32)


def heavy_contexts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Words with over a share 1/HEAVY of all tokens, and the number of tokens."""

    def run(batches):
        total, counts = 0, {}
        for batch in batches:
            for part in slices(batch, "_text"):
                words, n = np.unique(tokens_of(part.column("_text"))[0], return_counts=True)
                total += int(n.sum())
                often = n * 2 * HEAVY >= n.sum()
                for x, k in zip(words[often].tolist(), n[often].tolist()):
                    counts[x] = counts.get(x, 0) + k
        found = np.array([k for k, v in counts.items() if v * 2 * HEAVY >= total], np.uint64)
        values = [*[counts[int(k)] for k in found], total]
        yield pa.RecordBatch.from_arrays([pa.array([*found.view(np.int64).tolist(), 0]), pa.array(values, pa.int64())], ["word", "n"])

    sums = docs.select("_text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    whole = sums.where("word = 0").first()
    total = int(whole["n"]) if whole else 0
    rows = sums.where(f"word <> 0 and n * {HEAVY} >= {total}").collect()  # at most HEAVY
    return np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64)), total


def sent_tokens(docs: DataFrame, heavy: np.ndarray, buckets: int) -> DataFrame:
    """Packed tokens by bucket. Negative buckets have the documents of units: ids, held out or not, tokens."""
    schema = pa.schema([("bucket", pa.int32()), ("unit", pa.int64()), ("data", pa.binary())])

    def flush(unit, ids, nulls, held, lengths, tokens):
        words, local = np.unique(tokens, return_inverse=True)
        doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        heads = np.cumsum(lengths) - lengths
        context = np.empty(len(tokens), np.uint64)
        context[1:] = tokens[:-1]
        context[heads] = START
        before = np.empty(len(tokens), np.int64)
        before[1:] = local[:-1]
        before[heads] = len(words)
        bucket = buckets_of(context, tokens, heavy, buckets)
        order = np.argsort(before * (len(words) + 1) + local, kind="stable")
        order = order[np.argsort(bucket[order].astype(np.uint16 if buckets < 1 << 16 else np.int32), kind="stable")]
        bucket, before, local, doc = bucket[order], before[order], local[order], doc[order]
        names = np.append(words, START)
        rows = [(-1 - int(mix(np.array([unit], np.uint64))[0] % np.uint64(buckets)), pack(ids, nulls, held, lengths))]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
            u, w, d = before[a:b], local[a:b], doc[a:b]
            new = np.append(True, (u[1:] != u[:-1]) | (w[1:] != w[:-1]) | (d[1:] != d[:-1]))
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(u))).astype(np.uint32)
            u, w, d = u[at], w[at], d[at]
            used = np.unique(np.concatenate([u, w]))
            rows.append((int(bucket[a]), pack(
                names[used], steps(np.searchsorted(used, u).astype(np.int32)), np.searchsorted(used, w).astype(np.int32),
                d.astype(np.int32), n, held,
            )))
        for at in range(0, len(rows), ROWS):
            own = rows[at : at + ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in own], pa.int32()), pa.array([unit] * len(own), pa.int64()), pa.array([r[1] for r in own], pa.binary())],
                schema=schema,
            )

    def run(batches):
        unit = TaskContext.get().partitionId() << 24
        gathered, size = [], 0
        for batch in batches:
            for part in slices(batch, "_text"):
                tokens, ends = tokens_of(part.column("_text"))
                ids = part.column("_id")
                gathered.append((
                    ids.fill_null(0).to_numpy().astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                    part.column("_held").to_numpy(zero_copy_only=False).astype(np.uint8), np.diff(ends), tokens,
                ))
                size += len(tokens)
                if size >= UNIT_TOKENS:
                    yield from flush(unit, *map(np.concatenate, zip(*gathered)))
                    gathered, size, unit = [], 0, unit + 1
        if gathered:
            yield from flush(unit, *map(np.concatenate, zip(*gathered)))

    return docs.mapInArrow(run, "bucket int, unit long, data binary")


def merged(sent: DataFrame) -> DataFrame:
    """Per bucket: contexts, words, pairs with training counts, and which document has which pair how often.

    Negative buckets keep a row for each unit, its documents being in ``state``.
    """
    names_ = ["bucket", "unit", "state", "docs", "uses", "n1", "n2"]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def merge(batch: pa.Table) -> pa.Table:
        if batch.column("bucket")[0].as_py() < 0:
            n = batch.num_rows
            nothing, zeros = pa.nulls(n, pa.binary()), pa.array(np.zeros(n, np.int64))
            return pa.table([batch.column("bucket"), batch.column("unit"), batch.column("data"), nothing, nothing, zeros, zeros], names=names_)
        units = batch.column("unit").to_pylist()
        blocks = [unpack(x) for x in batch.column("data").to_pylist()]
        names = np.unique(np.concatenate([b[0] for b in blocks]))
        u_all, w_all = [], []
        for words, u, w, *_ in blocks:
            place = np.searchsorted(names, words)
            u_all.append(place[np.cumsum(u)])
            w_all.append(place[w])
        keys = np.concatenate(u_all) * len(names) + np.concatenate(w_all)
        pairs, which = np.unique(keys, return_inverse=True)
        n = np.concatenate([b[4] for b in blocks])
        trains = np.concatenate([b[5][b[3]] == 0 for b in blocks])
        c = np.bincount(which, weights=n * trains, minlength=len(pairs)).astype(np.uint32)
        contexts, u = np.unique(pairs // len(names), return_inverse=True)
        used, w = np.unique(pairs % len(names), return_inverse=True)
        docs = pack(np.array([len(b[3]) for b in blocks], np.int64), np.array([len(b[5]) for b in blocks], np.int64), np.array(units, np.int64))
        uses = pack(which.astype(np.int32), np.concatenate([b[3] for b in blocks]), n)
        state = pack(steps(names[contexts]), steps(names[used]), steps(u.astype(np.int32)), w.astype(np.int32), c)
        values = [batch.column("bucket")[0].as_py(), -1, state, docs, uses, int((c == 1).sum()), int((c == 2).sum())]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds)], names=names_)

    schema = "bucket int, unit long, state binary, docs binary, uses binary, n1 long, n2 long"
    return sent.groupBy("bucket").applyInArrow(merge, schema)


def discount(n1: float, n2: float) -> float:
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


@functools.lru_cache(maxsize=4)
def stirling_logs(d: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(n, t) for n and t up to EXACT."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(EXACT + 1)
    for n in range(1, EXACT):
        stay = out[n, : n + 1] + np.log(np.maximum(n - d * t[: n + 1], 1e-300))
        out[n + 1, 1 : n + 1] = np.logaddexp(out[n, :n], stay[1:])
        out[n + 1, n + 1] = 0.0
    return out


def _bisected(above, size: int) -> np.ndarray:
    """Where functions of u > 0 that fall with u change from ``above`` zero."""
    low, high = np.full(size, -80.0), np.full(size, 6.0)
    for _ in range(60):
        middle = (low + high) / 2
        more = above(np.exp(middle))
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    return np.exp((low + high) / 2)


def stirling_log(n: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """log(S(n, t) / n!) for any counts n >= t: the n-th coefficient of g^t / t!, g = (1 - (1 - x)^d) / d.

    With x = exp(-u) it is an integral over a parabola through the saddle point, around the cut at u < 0.
    """

    def slope(u):
        y = -np.expm1(-u)
        return np.exp(-u) * y ** (d - 1) * d / -np.expm1(d * np.log(y))

    alone, whole = t >= n, t
    t = np.minimum(t, n - 1)
    u = np.maximum(_bisected(lambda u: t * slope(u) > n, len(n)), 3 / n)
    bend = np.maximum(t * (slope(u * 0.999) - slope(u * 1.001)) / 0.002 * u * 2, 0)
    reach = np.minimum(1.5 * np.sqrt(40 / np.clip(bend, 3, n * u + 3)), np.pi / (2 * u))
    y = (np.arange(POINTS) + 0.5) / POINTS * reach[:, None]
    path = u[:, None] * (1 + 1j * y) ** 2

    def log_g(u):
        return np.log((1 - (-np.expm1(-u)) ** d) / d)

    top = n * u + t * log_g(u)
    values = (1 + 1j * y) * np.exp(n[:, None] * path + t[:, None] * log_g(path) - top[:, None])
    area = values.real.sum(axis=1) * reach / POINTS * 2 * u / np.pi
    found = top + np.log(np.maximum(area, 1e-300))
    return np.where(alone, 0.0, found) - np.array([math.lgamma(x + 1) for x in whole.tolist()])


def tables_drawn(c: np.ndarray, weight: np.ndarray, d: float, draw: np.random.Generator, before: np.ndarray | None = None) -> np.ndarray:
    """Tables of each dish from their conditional w^t S(c, t), given the weight of a new table."""
    t = (c > 0).astype(np.float64)
    logs, log_weight = stirling_logs(d), np.log(np.maximum(weight, 1e-300))
    order = np.argsort(c, kind="stable")
    sizes = c[order].astype(np.int64)
    low = int(np.searchsorted(sizes, 2))
    while low < len(sizes) and sizes[low] <= EXACT:
        n = int(sizes[low])
        high = int(np.searchsorted(sizes, n, side="right"))
        for at in range(low, high, max(1, (1 << 20) // n)):
            own = order[at : min(high, at + max(1, (1 << 20) // n))]
            chance = log_weight[own, None] * np.arange(1, n + 1) + logs[n, 1 : n + 1]
            total = np.cumsum(np.exp(chance - chance.max(axis=1, keepdims=True)), axis=1)
            t[own] = 1 + (total < draw.random(len(own))[:, None] * total[:, -1:]).sum(axis=1)
        low = high
    for at in range(low, len(sizes), 2_048):
        own = order[at : at + 2_048]
        t[own] = _stepped(c[own].astype(np.float64), weight[own], log_weight[own], d, draw, None if before is None else before[own])
    return t


def _stepped(n, weight, log_weight, d: float, draw: np.random.Generator, now: np.ndarray | None) -> np.ndarray:
    """Metropolis steps from the tables of the sweep before, or else from about the most likely number."""
    u = _bisected(lambda u: weight * np.exp(-u) * (-np.expm1(-u)) ** (d - 1) > n, len(n))
    likely = np.clip(np.round(weight * -np.expm1(d * np.log(-np.expm1(-u))) / d), 1, n)
    t = likely.copy() if now is None else np.clip(now, 1, n)
    value = stirling_log(n, t, d) + t * log_weight
    for k in range(24 if now is None else 8):
        width = 1 + np.sqrt(likely) * (0.3, 1.0, 2.0)[k % 3]
        new = t + np.where(draw.random(len(n)) < 0.5, -1, 1) * (1 + np.floor(draw.exponential(1, len(n)) * width))
        inside = (new >= 1) & (new <= n)
        new = np.where(inside, new, t)
        worth = stirling_log(n, new, d) + new * log_weight
        taken = inside & (np.log(draw.random(len(n))) < worth - value)
        t, value = np.where(taken, new, t), np.where(taken, worth, value)
    return t


def _state(row: dict) -> tuple[np.ndarray, ...]:
    contexts, words, u, w, c = unpack(row["state"])
    return np.cumsum(contexts), np.cumsum(words), np.cumsum(u), w.astype(np.int64), c.astype(np.float64)


def word_buckets(words: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(words + np.uint64(77)) % np.uint64(buckets)).astype(np.int32)


MESSAGE = "kind string, to int, bucket int, sweep int, data binary, x double, y double, z double, v double"
MESSAGE_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), *[pa.float64()] * 4]
MESSAGE_NAMES = ["kind", "to", "bucket", "sweep", "data", "x", "y", "z", "v"]


def _messages(rows: list[tuple]) -> pa.Table:
    padded = [(*r, *[0.0] * (9 - len(r))) for r in rows]
    return pa.table([pa.array([r[k] for r in padded], t) for k, t in enumerate(MESSAGE_TYPES)], names=MESSAGE_NAMES)


def _reports(bucket: int, sweep: int, words, w, c, t, u, contexts, heavy, buckets: int) -> list[tuple]:
    """What a bucket reports: its tables, sums for the parent by word bucket, sums of heavy contexts."""
    rows = [("tables", -1 - bucket, bucket, sweep, pack(t.astype(np.uint32)))]
    order = np.argsort(word_buckets(words, buckets), kind="stable")
    to = word_buckets(words, buckets)[order]
    tables = np.bincount(w, weights=t, minlength=len(words))[order].astype(np.uint32)
    customers = np.bincount(w, weights=c, minlength=len(words))[order].astype(np.uint32)
    cuts = np.flatnonzero(np.diff(to, prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(to))):
        parts = [steps(words[order[a:b]]), tables[a:b], *([customers[a:b]] if sweep == 0 else [])]
        rows.append(("words", int(to[a]), bucket, sweep, pack(*parts)))
    c_u = np.bincount(u, weights=c, minlength=len(contexts))
    t_u = np.bincount(u, weights=t, minlength=len(contexts))
    for k in np.flatnonzero(np.isin(contexts, heavy)):
        rows.append(("heavy", -1 - bucket, bucket, sweep, contexts[k].tobytes(), float(c_u[k]), float(t_u[k])))
    return rows


def _answered(d1: float, base: float, seed: int):
    """Seats the parent's customers of one word bucket and answers every bucket in its own word order."""

    def answer(key: tuple[pa.Scalar, ...], batch: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return batch
        rows = batch.select(["kind", "bucket", "sweep", "data"]).to_pylist()
        earlier = [unpack(r["data"])[0].astype(np.float64) for r in rows if r["kind"] == "parent"]
        rows = [r for r in rows if r["kind"] != "parent"]
        blocks = [unpack(r["data"]) for r in rows]
        lists = [np.cumsum(b[0]) for b in blocks]
        words, place = np.unique(np.concatenate(lists), return_inverse=True)
        sweep = rows[0]["sweep"]
        c = np.bincount(place, weights=np.concatenate([b[1] for b in blocks]), minlength=len(words))
        draw = np.random.default_rng([SEED, seed, sweep, key[0].as_py()])
        t = tables_drawn(c, np.full(len(c), base), d1, draw, earlier[0] if earlier else None)
        mass = (c - d1 * t).astype(np.float32)
        out, at = [("parent", key[0].as_py(), -1, sweep, pack(t.astype(np.uint32)))], 0
        known = None
        if sweep == 0:
            known = np.bincount(place, weights=np.concatenate([b[2] for b in blocks]), minlength=len(words)).astype(np.uint32)
            out.append(("counts", -1, -1, 0, b"", float((known > 0).sum()), float(known.sum()), float((c == 1).sum()), float((c == 2).sum())))
        out.append(("sums", -1, -1, sweep, b"", float(c.sum()), float(t.sum())))
        for r, own in zip(rows, lists):
            mine = place[at : at + len(own)]
            at += len(own)
            parts = [mass[mine], *([known[mine]] if known is not None else [])]
            out.append(("mass", key[0].as_py(), r["bucket"], sweep, pack(*parts)))
        return _messages(out)

    return answer


def _seating(sweep: int, before: dict | None, vocabulary: int, d: float, d1: float, buckets: int, heavy: np.ndarray, seed: int):
    """Seats the customers of all contexts of a bucket, given the parent and the tables of the sweep before."""

    def seat(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _messages([])
        row = left.select(["bucket", "state"]).to_pylist()[0]
        contexts, words, u, w, c = _state(row)
        if before is None:
            t = np.minimum(c, 1.0)
        else:
            told = Answers(right)
            parent = _parent(told.by_word(sweep - 1, words, buckets, 0), before, vocabulary, d1)
            held = told.tables(sweep - 1)
            _, t_u = _context_sums(contexts, u, c, held, before["heavy"])
            weight = (STRENGTH + d * t_u[u]) * parent[w]
            draw = np.random.default_rng([SEED, seed, sweep, row["bucket"], 1])
            t = tables_drawn(c, weight, d, draw, held if sweep > 1 else None)
        return _messages(_reports(row["bucket"], sweep, words, w, c, t, u, contexts, heavy, buckets))

    return seat


class Answers:
    """Messages to one bucket, by kind and sweep."""

    def __init__(self, messages: pa.Table):
        self.rows = {}
        for r in messages.select(["kind", "to", "sweep", "data"]).to_pylist():
            self.rows.setdefault((r["kind"], r["sweep"]), []).append((r["to"], r["data"]))

    def tables(self, sweep: int) -> np.ndarray:
        return unpack(self.rows["tables", sweep][0][1])[0].astype(np.float64)

    def by_word(self, sweep: int, words: np.ndarray, buckets: int, part: int) -> np.ndarray:
        out = np.zeros(len(words))
        order = np.argsort(word_buckets(words, buckets), kind="stable")
        out[order] = np.concatenate([unpack(x)[part] for _, x in sorted(self.rows["mass", sweep], key=lambda r: r[0])])
        return out


def scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 7,
    held: int = 2,
    sweeps: int = SWEEPS,
    burn_in: int = BURN_IN,
    seed: int = 0,
    bucket_tokens: int = BUCKET_TOKENS,
) -> DataFrame:
    """One row per document: id, held out, tokens, known tokens, training tokens, base score, score."""
    spark = docs.sparkSession
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), (fold == held).alias("_held"), text_of(text_col).alias("_text"))
    heavy, total = heavy_contexts(rows)
    buckets = max(4, math.ceil(total / bucket_tokens))

    sent = sent_tokens(rows, heavy, buckets)
    name = f"pageflow_pitman_yor_{uuid.uuid4().hex}"
    merged(sent).write.bucketBy(buckets, "bucket").option("path", scratch_path(spark, "pitman-yor-buckets")).saveAsTable(name)
    whole = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalog forgets it, the plan and the files stay
    state = whole.where("bucket >= 0")
    small = state.agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2")).first()
    d = discount(small["n1"] or 0, small["n2"] or 0)

    totals: list[dict] = []  # per sweep: customers and tables of the parent, and of heavy contexts
    held_messages: list[DataFrame] = []
    vocabulary = tokens = 0
    d1 = 0.5
    for sweep in range(sweeps + 1):
        before = totals[-1] if totals else None

        seat = _seating(sweep, before, vocabulary, d, d1, buckets, heavy, seed)
        own = state.select("bucket", "state")
        if before is None:
            reports = own.groupBy("bucket").applyInArrow(lambda batch: seat(batch, batch), MESSAGE)
        else:
            told = held_messages[-1].where("kind in ('mass', 'tables')")
            reports = own.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(seat, MESSAGE)
            reports = reports.unionByName(held_messages[-1].where("kind = 'parent'"))
        base = PARENT_STRENGTH / 1e6 if before is None else (PARENT_STRENGTH + d1 * before["t"]) / (vocabulary + 1)
        messages = stored(reports.groupBy("to").applyInArrow(_answered(d1, base, seed), MESSAGE), f"pitman-yor-{sweep}")
        held_messages.append(messages)
        sums = messages.where("kind = 'sums'").agg(F.sum("x").alias("c"), F.sum("y").alias("t")).first()
        if sweep == 0:
            n = messages.where("kind = 'counts'").agg(*[F.sum(k).alias(k) for k in ("x", "y", "z", "v")]).first()
            vocabulary, tokens, d1 = int(n["x"] or 0), int(n["y"] or 0), discount(n["z"] or 0, n["v"] or 0)
        spread = messages.where("kind = 'heavy'").groupBy("data").agg(F.sum("x").alias("c"), F.sum("y").alias("t")).collect()
        totals.append({"c": sums["c"] or 0.0, "t": sums["t"] or 0.0, "heavy": {bytes(r["data"]): (r["c"], r["t"]) for r in spread}})

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["unit", "bucket", "data"]
        if not left.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.binary())], names=names)
        row = left.select(["bucket", "state", "docs", "uses"]).to_pylist()[0]
        contexts, words, u, w, c = _state(row)
        told = Answers(right)
        p = np.zeros(len(c))
        for sweep in range(burn_in + 1, sweeps + 1):
            t = told.tables(sweep)
            parent = _parent(told.by_word(sweep, words, buckets, 0), totals[sweep], vocabulary, d1)
            c_u, t_u = _context_sums(contexts, u, c, t, totals[sweep]["heavy"])
            own = np.maximum(c - d * t, 0) + (STRENGTH + d * t_u[u]) * parent[w]
            p += np.where(c_u[u] > 0, own / (STRENGTH + c_u[u]), parent[w]) / (sweeps - burn_in)
        counts = told.by_word(0, words, buckets, 1)[w]
        worth = np.log10(p)
        basic = np.log10((counts + 1) / (tokens + vocabulary + 1))
        which, doc, n = unpack(row["uses"])
        lengths, documents, units = unpack(row["docs"])
        out, at = [], 0
        for length, size, unit in zip(lengths.tolist(), documents.tolist(), units.tolist()):
            part, own = which[at : at + length], doc[at : at + length]
            k = n[at : at + length].astype(np.float64)
            at += length
            sums = [np.bincount(own, weights=k * v[part], minlength=size) for v in (worth, basic)]
            known = np.bincount(own, weights=k * (counts[part] > 0), minlength=size).astype(np.uint32)
            out.append((unit, row["bucket"], pack(*sums, known)))
        types = [pa.int64(), pa.int32(), pa.binary()]
        return pa.table([pa.array([r[j] for r in out], kind) for j, kind in enumerate(types)], names=names)

    told = None
    for messages in [held_messages[0], *held_messages[burn_in + 1 :]]:
        part = messages.where("kind in ('mass', 'tables')")
        told = part if told is None else told.unionByName(part)
    parts = state.select("bucket", "state", "docs", "uses").groupBy("bucket").cogroup(told.groupBy("bucket"))
    sums = parts.applyInArrow(score, "unit long, bucket int, data binary")
    units = whole.where("bucket < 0").select("unit", "bucket", F.col("state").alias("data"))

    def gather(batch: pa.Table) -> pa.Table:
        found = batch.select(["bucket", "data"]).to_pylist()
        ids, nulls, held_out, lengths = unpack(next(r["data"] for r in found if r["bucket"] < 0))
        total = [np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)]
        for r in sorted((r for r in found if r["bucket"] >= 0), key=lambda r: r["bucket"]):
            for k, v in enumerate(unpack(r["data"])):
                total[k] = total[k] + v
        arrays = [pa.array(ids, mask=nulls.astype(bool)), pa.array(held_out.astype(bool)), pa.array(lengths, pa.int64())]
        arrays += [pa.array(total[2], pa.int64()), pa.array(np.full(len(ids), tokens), pa.int64()), pa.array(total[1]), pa.array(total[0])]
        return pa.table(arrays, names=["_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return units.unionByName(sums).groupBy("unit").applyInArrow(gather, schema).withColumnRenamed("_id", id_col)


def _parent(mass: np.ndarray, totals: dict, vocabulary: int, d1: float) -> np.ndarray:
    """The parent's predictions: seated mass, and the base's share of the rest."""
    return (mass + (PARENT_STRENGTH + d1 * totals["t"]) / (vocabulary + 1)) / (PARENT_STRENGTH + totals["c"])


def _context_sums(contexts, u, c, t, heavy: dict) -> tuple[np.ndarray, np.ndarray]:
    """Customers and tables of each context, those of heavy ones over all buckets."""
    c_u = np.bincount(u, weights=c, minlength=len(contexts))
    t_u = np.bincount(u, weights=t, minlength=len(contexts))
    if heavy:
        keys = np.array([np.frombuffer(k, np.uint64)[0] for k in heavy], np.uint64)
        order = np.argsort(keys)
        keys, values = keys[order], np.array(list(heavy.values()))[order]
        at = np.minimum(np.searchsorted(keys, contexts), len(keys) - 1)
        same = keys[at] == contexts
        c_u[same], t_u[same] = values[at[same], 0], values[at[same], 1]
    return c_u, t_u
