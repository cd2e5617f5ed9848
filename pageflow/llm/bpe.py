"""Byte-level BPE encoding and decoding through a table of distinct words.

Spark splits texts into words by the tokenizer's own pattern. The texts of a task are put into blocks of
bounded size; a block keeps its documents' words as numbers and the distinct words behind them. The
distinct words of all blocks meet by word, each is encoded once by the tokenizers library, and its ids go back to
all blocks that hold it, where they are put in by position. Ids become bytes by a join with the table of
ids and pieces. A frequent word stands once in a block, so no join key is hot, and the words of documents
move once, as compressed numbers.

Only tokenizers of this kind are taken: byte-level, with the usual pattern, no normaliser, no prefix space, no
dropout, added tokens without options. This is read from the file; others raise ValueError. Added tokens
inside texts get their id, as the library does by default. A letter that Java's Unicode tables do not know
yet may be split otherwise than by the library.

Results: a NULL or empty text has no ids and decodes to nothing; repeated rows and NULL ids give a row each;
an empty table gives no rows; other columns are not read. A text is one row of a block, so the longest text bounds
what a task holds beyond ``CHUNK_BYTES``.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.llm.common import bytes_of, slices, text_of

# The pattern of byte-level tokenizers, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_BYTES = 24 << 20
PACKED_WORDS = 1_000_000
MOST_PIECE_BYTES = 64 << 20


class ByteLevel:
    """What the operators need of a tokenizer file: its added tokens and its pieces as bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.json = file.read()
        spec = json.loads(self.json)
        split, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = (
            spec.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space")
            and split.get("use_regex")
            and (spec.get("decoder") or {}).get("type") == "ByteLevel"
            and model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
            and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not plain:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        own = {i: bytes(letters[c] for c in piece) for piece, i in model["vocab"].items()}
        self.pieces = own | {i: piece.encode() for piece, i in self.added.items()}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves; the others, in order, for the characters from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def words_of(text: Column, added: list[str]) -> Column:
    """The words of a text in order; together they are the text. Added tokens are words of their own."""
    split = lambda t: F.regexp_extract_all(t, F.lit("(?U)" + PATTERN), F.lit(0))
    if not added:
        return split(text)
    # Java and Python quote alike for these; longer tokens go first where one begins another.
    special = "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))
    between, found = F.split(text, special, -1), F.regexp_extract_all(text, F.lit(special), F.lit(0))
    parts = F.transform(between, lambda t, k: F.when(F.get(found, k).isNotNull(), F.concat(split(t), F.array(F.get(found, k)))).otherwise(split(t)))
    holds = F.lit(False)
    for token in added:
        holds = holds | F.contains(text, F.lit(token))
    return F.when(holds, F.flatten(parts)).otherwise(split(text))


BLOCKS = "block long, doc_ids array<long>, starts array<int>, numbers binary, words binary, lengths binary, n_words int"


def blocks(docs: DataFrame, id_col: str, text_col: str, added: list[str]) -> DataFrame:
    """Documents in blocks: ids, where each one's words start, all words as numbers, the distinct words by falling count.

    A block is named by a digest of what it holds.
    """
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), words_of(text, added).alias("_words"), text.alias("_text"))

    def run(batches):
        for part in _gathered(batches):
            column = part.column("_words")
            coded = column.flatten().dictionary_encode()
            numbers, n = coded.indices.to_numpy(), len(coded.dictionary)
            order = np.argsort(-np.bincount(numbers, minlength=n), kind="stable")
            place = np.empty(n, np.int32)
            place[order] = np.arange(n, dtype=np.int32)
            words, ends = bytes_of(coded.dictionary.take(pa.array(order)))
            own = [packed_numbers(place[numbers]), _pressed(words), packed_numbers(np.diff(ends))]
            doc_ids = part.column("_id").combine_chunks() if isinstance(part, pa.Table) else part.column("_id")
            starts = np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy())])
            name = hashlib.blake2b(b"".join([*own, str(doc_ids.to_pylist()).encode()]), digest_size=8).digest()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int.from_bytes(name, "little", signed=True)]),
                    pa.array([doc_ids.to_pylist()], pa.list_(pa.int64())),
                    pa.array([starts], pa.list_(pa.int32())),
                    *[pa.array([x], pa.binary()) for x in own],
                    pa.array([n], pa.int32()),
                ],
                ["block", "doc_ids", "starts", "numbers", "words", "lengths", "n_words"],
            )

    return rows.mapInArrow(run, BLOCKS)


def _gathered(batches):
    """Rows of several batches together, up to ``BLOCK_BYTES`` of text or one longer text."""
    waiting, size = [], 0
    for batch in batches:
        for part in slices(batch, "_text"):
            own = part.column("_text").nbytes
            if waiting and size + own > BLOCK_BYTES:
                yield _one(waiting)
                waiting, size = [], 0
            waiting.append(part.drop_columns("_text"))
            size += own
    if waiting:
        yield _one(waiting)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _pressed(data: np.ndarray) -> bytes:
    return pa.compress(data.tobytes(), codec="zstd", asbytes=True)


def packed_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, their lower and higher bytes apart, compressed."""
    return _pressed(np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T)


def unpacked_numbers(data: pa.Buffer | bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def placed_words(packed: DataFrame) -> DataFrame:
    """The distinct words of each block, with their place in it: ``block``, ``at``, ``word``."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                n = batch.column("n_words")[k].as_py()
                ends = np.concatenate([[0], np.cumsum(unpacked_numbers(batch.column("lengths")[k].as_buffer(), n))])
                data = pa.decompress(batch.column("words")[k].as_buffer(), int(ends[-1]), codec="zstd") if n else pa.py_buffer(b"")
                words = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(ends.tobytes()), data]).cast(pa.string())
                block = pa.array(np.full(n, batch.column("block")[k].as_py()))
                whole = pa.RecordBatch.from_arrays([block, pa.array(np.arange(n, dtype=np.int32)), words], ["block", "at", "word"])
                yield from (whole.slice(at, 10_000) for at in range(0, n, 10_000))

    return packed.mapInArrow(run, "block long, at int, word string")


def encoded_words(words: DataFrame, tokenizer: ByteLevel) -> DataFrame:
    """The ids of every placed word; each distinct word is encoded once.

    Rows with the same word meet in one task, in order, so that a word's ids are made at its first row and joined
    to all. Returned are packed parts of blocks: ``block``, number of words ``n``, their places ``at``, numbers of ids ``lengths``, and ``ids``.
    """
    sent = words.sparkSession.sparkContext.broadcast((tokenizer.json, tokenizer.added))

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_str(sent.value[0])
        encoder.no_truncation()
        encoder.no_padding()
        waiting, n, last, last_ids = [], 0, None, []
        for batch in batches:
            coded = batch.column("word").dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            if not distinct:
                continue
            new = distinct[1:] if distinct[0] == last else distinct
            ids = [last_ids] * (len(distinct) - len(new)) + [e.ids for e in encoder.encode_batch_fast(new, add_special_tokens=False)]
            last, last_ids = distinct[-1], ids[-1]
            lists = pa.array(ids, pa.list_(pa.int32())).take(coded.indices)
            waiting.append(pa.RecordBatch.from_arrays([batch.column("block"), batch.column("at"), lists], ["block", "at", "ids"]))
            n += batch.num_rows
            if n >= PACKED_WORDS:
                yield from _by_block(waiting)
                waiting, n = [], 0
        yield from _by_block(waiting)

    meeting = words.repartition("word").sortWithinPartitions("word")
    return meeting.mapInArrow(run, "block long, n int, at binary, lengths binary, n_ids int, ids binary")


def _by_block(parts: list[pa.RecordBatch]):
    """Placed words with ids, one packed row per block."""
    if not parts:
        return
    rows = pa.Table.from_batches(parts).combine_chunks().sort_by([("block", "ascending"), ("at", "ascending")])
    blocks, at = rows.column("block").to_numpy(), rows.column("at").to_numpy()
    lists = rows.column("ids").combine_chunks()
    lengths = pc.list_value_length(lists).to_numpy()
    ids, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])
    cuts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1], [True]]))
    for a, b in zip(cuts, cuts[1:]):
        own = [packed_numbers(x) for x in (np.diff(at[a:b], prepend=0), lengths[a:b], ids[ends[a] : ends[b]])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([blocks[a]]), pa.array([b - a], pa.int32()), *[pa.array([x], pa.binary()) for x in own[:2]], pa.array([ends[b] - ends[a]], pa.int32()), pa.array([own[2]], pa.binary())],
            ["block", "n", "at", "lengths", "n_ids", "ids"],
        )


def piece_table(spark: SparkSession, tokenizer: ByteLevel) -> DataFrame:
    """``id`` and ``piece`` (bytes) of every token; as many rows as the file's vocabulary has."""
    rows = pa.table({"id": pa.array(list(tokenizer.pieces), pa.int32()), "piece": pa.array(list(tokenizer.pieces.values()), pa.binary())})
    return spark.createDataFrame(rows)


def encode(
    docs: DataFrame, tokenizer_path: str, decode: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per document: ``_id``, ``ids`` (array of int) and, if asked for, ``decoded`` (bytes, by the ids alone).

    For decoding, the table of ids and pieces goes to all tasks and is joined there; it is as large as the
    tokenizer's vocabulary, and files with more than ``MOST_PIECE_BYTES`` are refused (``decode`` takes any).
    """
    tokenizer = ByteLevel(tokenizer_path)
    # Both uses read this one exchange; a name by content keeps them together should a block be made again.
    packed = blocks(docs, id_col, text_col, list(tokenizer.added)).repartition("block")
    parts = encoded_words(placed_words(packed), tokenizer)
    coded = parts.groupBy("block").agg(F.collect_list(F.struct("n", "at", "lengths", "n_ids", "ids")).alias("coded"))
    pieces = None
    if decode:
        if sum(map(len, tokenizer.pieces.values())) + 4 * len(tokenizer.pieces) > MOST_PIECE_BYTES:
            raise ValueError("the vocabulary is too large to send to all tasks")
        known = sorted(tokenizer.pieces)
        pieces = docs.sparkSession.sparkContext.broadcast((np.array(known, np.int32), [tokenizer.pieces[i] for i in known]))

    def run(batches):
        table = (pieces.value[0], pa.array(pieces.value[1], pa.large_binary())) if decode else None
        for batch in batches:
            for at in range(batch.num_rows):
                yield from _unpacked(batch.slice(at, 1), table)

    schema = "_id long, ids array<int>" + ", decoded binary" * decode
    return packed.join(coded.hint("merge"), "block", "left").mapInArrow(run, schema)


def _unpacked(block: pa.RecordBatch, pieces: tuple[np.ndarray, pa.Array] | None):
    """The documents of one block, ids (and bytes) put together by position."""
    doc_ids, starts = block.column("doc_ids").flatten(), block.column("starts").flatten().to_numpy()
    numbers = unpacked_numbers(block.column("numbers")[0].as_buffer(), int(starts[-1]))
    by_word, lengths = _in_order(block.column("coded")[0].values, block.column("n_words")[0].as_py())
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    # Documents are put together in parts of bounded size, the words of a long one being one part.
    first = 0
    while first < len(doc_ids):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + 500_000, side="right")) - 1)
        own = numbers[starts[first] : starts[last]]
        n = lengths[own]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = by_word[np.arange(ends[-1]) - np.repeat(ends[:-1] - offsets[own], n)]
        upto = ends[starts[first : last + 1] - starts[first]]
        arrays = [doc_ids.slice(first, last - first), pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids))]
        if pieces is not None:
            arrays.append(_joined(pieces, ids, upto))
        yield pa.RecordBatch.from_arrays(arrays, ["_id", "ids", "decoded"][: len(arrays)])
        first = last


def _in_order(parts: pa.StructArray | None, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block's words in the order of their places, end to end, and the number of each one's ids."""
    places, lengths, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for part in parts if parts is not None else []:
        n = part["n"].as_py()
        places.append(np.cumsum(unpacked_numbers(part["at"].as_buffer(), n)))
        lengths.append(unpacked_numbers(part["lengths"].as_buffer(), n))
        ids.append(unpacked_numbers(part["ids"].as_buffer(), part["n_ids"].as_py()))
    place, length, flat = (np.concatenate(x) for x in (places, lengths, ids))
    found, order = np.unique(place, return_index=True)  # equal blocks have one name, and their words come several times
    if len(found) != n_words:
        raise RuntimeError("words of a block have no ids: its documents were read in another order the second time")
    begin, sized = (np.cumsum(length) - length)[order], length[order]
    ends = np.cumsum(sized)
    return flat[np.arange(sized.sum()) - np.repeat(ends - sized - begin, sized)].astype(np.int32), sized


def _joined(pieces: tuple[np.ndarray, pa.Array], ids: np.ndarray, upto: np.ndarray) -> pa.Array:
    """Bytes of the pieces of each document, end to end. Every id has a piece."""
    known, values = pieces
    taken = values.take(pa.array(np.searchsorted(known, ids)))
    ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
    data = taken.buffers()[2] if len(taken) else pa.py_buffer(b"")
    return pa.Array.from_buffers(pa.large_binary(), len(upto) - 1, [None, pa.py_buffer(ends[upto].tobytes()), data]).cast(pa.binary())


def decode(rows: DataFrame, tokenizer_path: str, key_cols: list[str], ids: str = "ids") -> DataFrame:
    """``decoded`` bytes of arrays of ids from anywhere, a row per key, by an id-to-piece join.

    Keys must be distinct. Ids without a piece, and NULL, count for nothing; an empty or NULL array decodes to no bytes.
    """
    pieces = piece_table(rows.sparkSession, ByteLevel(tokenizer_path))
    taken = rows.select(*key_cols, F.posexplode_outer(ids).alias("_at", "id")).join(pieces, "id", "left")
    placed = F.array_sort(F.collect_list(F.struct("_at", F.coalesce("piece", F.lit(b"")).alias("piece"))))
    joined = F.aggregate(placed["piece"], F.lit(b""), lambda done, piece: F.concat(done, piece))
    return taken.groupBy(*key_cols).agg(joined.alias("decoded"))
