"""Periodic runs of words in each text, by internal pattern matching.

Every text has a suffix array over its words, made by prefix doubling; the texts of a chunk are doubled
together. The doubling also names every stretch of 1, 2, 4, ... words, and its groups are the suffix
array's ranges of equal stretches. A wavelet tree over the suffix array answers range successors: the
next occurrence of a dyadic block behind its own place, which is looked for in the window of one block length
next to it. If a block of B words comes back after d of them, B/2 < d <= B, the block and its copy are the
beginning of an arithmetic progression of occurrences and d is the smallest period there (a shorter
one would bring the block back earlier). The run is then the longest stretch that keeps this period;
it is found from both ends by the names, the largest stretches first.

Nothing is missed: a run of period q and length at least ``exponent`` * q holds, for the power of two B with
q <= B < 2q, every block that starts in its first length - q - B + 1 places together with that block's copy q
words later; blocks start at multiples of a step no larger than that (``step_of``).

Words are compared whole, not by hash. Results: a NULL or empty text, or one of white space, has no runs
and an empty collapsed text; runs may overlap; repeated rows and NULL ids give a row each; an empty table
gives no rows; other columns are not read. A text is handled whole in one task, which takes memory for
about 4 * log2(longest repeat) + 100 bytes a word; texts share a chunk up to ``CHUNK_BYTES``.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import bytes_of, slices, text_of

WORDS = r"[^\x20\x09-\x0D]+"
LEAST = 6
EXPONENT = 4
SCHEMA = "_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def step_of(block: int, least: int, exponent: int) -> int:
    """The largest power of two that is no larger than the number of places where a block may start in any run."""
    periods = np.arange(block // 2 + 1, block + 1)
    places = int((np.maximum(least, exponent * periods) - periods - block + 1).min())
    return 1 << (places.bit_length() - 1)


class Suffixes:
    """Suffix array of several texts, one behind the other, with the names of all dyadic stretches.

    ``words`` numbers the words so that texts share no number, in ascending order of texts; ``ends`` has the end of its text for every place.
    ``levels`` has for each length 2**k the places whose stretch occurs again in their text, with
    the range of the suffix array that holds these occurrences.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        n = len(words)
        order = np.argsort(words, kind="stable").astype(np.int32)
        rank = np.zeros(n + 1, np.int32)
        rank[n] = -1  # behind the last text
        self.array, self.names, self.levels = order.copy(), [], []
        active, slots, key, length = order, np.arange(n, dtype=np.int32), words[order], 1
        while len(active):
            fresh = np.empty(len(key), bool)
            fresh[0] = True
            np.not_equal(key[1:], key[:-1], out=fresh[1:])
            heads = np.flatnonzero(fresh)
            sizes = np.diff(heads, append=len(key))
            self.array[slots] = active
            rank[active] = np.repeat(slots[heads], sizes)
            again = np.repeat(sizes > 1, sizes)
            active, slots = active[again], slots[again]
            self.names.append(rank.copy())
            self.levels.append((active, rank[active], np.repeat(sizes[sizes > 1], sizes[sizes > 1])))
            follow = active.astype(np.int64) + length
            inside = follow < ends[active]
            behind = np.where(inside, rank[np.minimum(follow, n)] + 1, 0)
            key = rank[active].astype(np.int64) * (n + 2) + behind
            sort = np.argsort(key, kind="stable")
            active, key, length = active[sort], key[sort], 2 * length

    def alike(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree from a and from b on."""
        done = np.zeros(len(a), np.int64)
        last = len(self.names[0]) - 1
        for k in range(len(self.names) - 1, -1, -1):
            name = self.names[k]
            done += (name[np.minimum(a + done, last)] == name[np.minimum(b + done, last)]).astype(np.int64) << k
        return done

    def alike_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree before a and before b (a < b)."""
        done = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, left = self.names[k], a - done - (1 << k)
            same = (left >= 0) & (name[np.maximum(left, 0)] == name[np.maximum(b - done - (1 << k), 0)])
            done += same.astype(np.int64) << k
        return done


class WaveletTree:
    """Counts and order statistics of values in ranges of an array, by one bit of the values after the other."""

    def __init__(self, values: np.ndarray):
        self.zeros = []
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit) & 1 == 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~ones, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[~ones], values[ones]])

    def _levels(self):
        return zip(range(self.bits - 1, -1, -1), self.zeros)

    def smaller(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values in each range are below its bound; bounds have no more bits than the values."""
        count = np.zeros(len(low), np.int64)
        for bit, zeros in self._levels():
            one = (bound >> bit) & 1 == 1
            a, b = zeros[low], zeros[high]
            count += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return count

    def ranked(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of the given rank, from 0, in each range."""
        found = np.zeros(len(low), np.int64)
        for bit, zeros in self._levels():
            a, b = zeros[low], zeros[high]
            one = rank >= b - a
            rank = rank - np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
            found |= one.astype(np.int64) << bit
        return found

    def successor(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The smallest value above the given one in each range, -1 where there is none. The given values are in their ranges."""
        upto = self.smaller(low, high, value) + 1
        out = np.full(len(low), -1, np.int64)
        has = np.flatnonzero(upto < high - low)
        out[has] = self.ranked(low[has], high[has], upto[has])
        return out


def runs_of(words: np.ndarray, starts: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (over all texts), length and period of all runs, by start and period. Texts begin at ``starts``, whose last element is the end."""
    empty = np.zeros(0, np.int64)
    if not len(words):
        return empty, empty, empty
    sizes = np.diff(starts)
    ends, begins = np.repeat(starts[1:], sizes), np.repeat(starts[:-1], sizes)
    suffixes = Suffixes(words, ends)
    asked = []
    for k, (places, low, size) in enumerate(suffixes.levels):
        block = 1 << k
        long_enough = ends[places] - begins[places] >= max(least, exponent * (block // 2 + 1))
        chosen = np.flatnonzero(long_enough & (places % step_of(block, least, exponent) == 0))
        if len(chosen):
            asked.append((places[chosen].astype(np.int64), low[chosen].astype(np.int64), size[chosen], np.full(len(chosen), block)))
    if not asked:
        return empty, empty, empty
    place, low, size, block = (np.concatenate(x) for x in zip(*asked))
    origin = begins[place]
    tree = WaveletTree(suffixes.array - begins[suffixes.array])
    period = tree.successor(low, low + size, place - origin) + origin - place
    near = (period > 0) & (period <= block) & (2 * period > block)
    place, period = place[near], period[near]
    first = place - suffixes.alike_before(place, place + period)
    length = place + period + suffixes.alike(place, place + period) - first
    enough = length >= np.maximum(least, exponent * period)
    if not enough.any():
        return empty, empty, empty
    found = np.unique(np.stack([first, period, length], axis=1)[enough], axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """A row per document: ``_id``, its ``runs`` (first word, length, smallest period) by start and period, and ``collapsed``, its words without repeats.

    A run is a stretch of at least ``least`` words and ``exponent`` periods that no neighbouring word extends. All
    its words behind the first period are left out of ``collapsed``, where words stand one space apart.
    """
    if exponent < 3:
        raise ValueError("runs of fewer than three periods may hold no block with its copy")
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("_text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                yield _part(part, least, exponent)

    return rows.mapInArrow(run, SCHEMA)


def _part(part: pa.RecordBatch, least: int, exponent: int) -> pa.RecordBatch:
    data, ends = bytes_of(part.column("_text"))
    data = data.tobytes()
    texts = [data[a:b].split() for a, b in zip(ends, ends[1:])]  # bytes split at space and 0x09 to 0x0D
    numbers, shift = [], 0
    for words in texts:
        known: dict[bytes, int] = {}
        numbers.append(np.array([known.setdefault(w, len(known)) for w in words], np.int64) + shift)
        shift += len(known)
    starts = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
    first, length, period = runs_of(np.concatenate(numbers) if numbers else np.zeros(0, np.int64), starts, least, exponent)

    cut = np.bincount(first + period, minlength=starts[-1] + 1) - np.bincount(first + length, minlength=starts[-1] + 1)
    kept = np.cumsum(cut) == 0
    owner = np.searchsorted(starts, first, side="right") - 1
    repeating = set(owner.tolist())
    collapsed = [b" ".join(compress(w, kept[starts[k] :].tolist()) if k in repeating else w) for k, w in enumerate(texts)]
    upto = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(first - starts[owner]), pa.array(length), pa.array(period)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(upto), spans)
    return pa.RecordBatch.from_arrays([part.column("_id"), lists, pa.array(collapsed, pa.binary()).cast(pa.string())], ["_id", "runs", "collapsed"])


def planted(doc_id: Column, text: Column) -> Column:
    """Texts of which a tenth, by a rule on the id, repeats one stretch of its words to its end.

    With h the CRC32 of the decimal id and g = h div 10: where h mod 10 is 0, the n words from number a = g mod n
    on become repetitions of the first 1 + (n - a) div (3 + g mod 8) of them. A NULL id changes nothing.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text_of(text), F.lit(WORDS), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    cycle = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    changed = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), F.flatten(cycle)), F.lit(1), n), " ")
    return F.when((h % 10 == 0) & (n > 0), changed).otherwise(text)
