"""Encoding and decoding through the distinct-word table against the tokenizers library."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pageflow.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "B", "1", "'", "s", " ", "  ", "\n", "\t", "é", "東", "́", "!", "?", "<|endoftext|>", "<|endo", "'ll", "😀", "ß", "\x85", "\x1c", "x", "٣", "\x00", "​", "\xa0", "²"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for _ in range(1_500)]
    return made + ["one two " * 60_000, "x" * 100_000, " " * 5_000, "<|endoftext|>", "<|endoftext|>" * 3 + " a", "a <|endoftext|>  b"]


def test_round_trip_equals_the_library(documents, odd, texts, library):
    rows = list(enumerate(texts, 100)) + list(odd)
    got = bpe.encode(documents(rows, extra=True), PATH, decode=True)
    want = Counter()
    for d, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[d, tuple(ids), library.decode(ids, skip_special_tokens=False).encode()] += 1
    assert Counter((r._id, tuple(r.ids), bytes(r.decoded)) for r in got.collect()) == want
    assert bpe.encode(documents([]), PATH, decode=True).count() == 0
    assert bpe.encode(documents([(1, None), (2, "")]), PATH, decode=True).where("size(ids) = 0").count() == 2


def test_each_distinct_word_stands_once_in_a_block_and_meets_in_one_task(spark, documents):
    rows = [(k, "the same words again the same") for k in range(500)]
    packed = bpe.blocks(documents(rows).repartition(4), "doc_id", "text", [])
    placed = bpe.placed_words(packed)
    words = ["the", " same", " words", " again", " the"]
    assert Counter(r.word for r in placed.collect()) == Counter(words * packed.count())
    parts = bpe.encoded_words(placed, bpe.ByteLevel(PATH)).collect()
    assert sum(r.n for r in parts) == len(words) * packed.count()


def test_equal_blocks(spark, library):
    rows = spark.createDataFrame([(1, "x"), (2, "y y z")], "doc_id long, text string").coalesce(1)
    got = bpe.encode(rows.union(rows).union(rows), PATH, decode=True).collect()
    assert Counter((r._id, bytes(r.decoded)) for r in got) == {(1, b"x"): 3, (2, b"y y z"): 3}


def test_numbers_come_back():
    for numbers in ([], [0], [1, 2**32 - 1, 70_000] * 50):
        assert bpe.unpacked_numbers(bpe.packed_numbers(np.array(numbers, np.int64)), len(numbers)).tolist() == numbers


def test_decode_of_ids_from_elsewhere(spark, texts, library):
    some = texts[:80]
    rows = [(k, library.encode(t, add_special_tokens=False).ids) for k, t in enumerate(some)] + [(900, []), (901, None), (902, [17, 99_999, None])]
    got = bpe.decode(spark.createDataFrame(rows, "k long, ids array<int>"), PATH, ["k"]).collect()
    want = {k: t.encode() for k, t in enumerate(some)} | {900: b"", 901: b"", 902: library.decode([17]).encode()}
    assert {r.k: bytes(r.decoded) for r in got} == want


def test_other_kinds_of_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        bpe.ByteLevel(public_tokenizers.path("word_bpe_49k.json"))
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.ByteLevel(str(tmp_path / "t.json"))


def test_query_equals_the_library(spark, tmp_path, texts, library):
    rows = list(enumerate(texts[:300])) + [(900, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for d, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.add((d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert set(map(tuple, queries.op13_bpe_round_trip(spark, str(tmp_path)).collect())) == want
