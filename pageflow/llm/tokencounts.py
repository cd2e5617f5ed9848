"""Token counts through a cache keyed by content and tokenizer digests.

Texts are digested after runs of ASCII white space became one space and the ends were trimmed; the
tokenizers accepted here drop white space between words, so this changes no count. A left anti join
with the cache finds the digests that were never counted under this tokenizer file; one text of each
is encoded and its count appended to the cache, and every document gets its count by a join.

Results: a NULL or empty text has 0 bytes and 0 tokens; repeated rows and NULL ids each give a row;
an empty table gives no rows; other columns are not read. Counts are added up over words, each
distinct word of a task being encoded once, so a text of any length costs memory for its words only.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import exists, text_of

REMEMBERED_WORDS = 300_000
CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"


def normalised(text: str | Column) -> Column:
    return F.trim(F.regexp_replace(text_of(text), "[ \t\n\x0b\f\r]+", " "))


def content_digest(text: str | Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


class WordCounter:
    """Counts tokens per text by the tokenizers library, word by word; remembers a bounded number of words."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        split = [t.split(" ") for t in texts]
        new = list({w for words in split for w in words if w and w not in self.known})
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            encoded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.known.update(zip(part, (len(e.ids) for e in encoded)))
        self.known[""] = 0
        counts = [sum(map(self.known.__getitem__, words)) for words in split]
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
        return counts


def splits_at_spaces(tokenizer_json: str) -> bool:
    """Whether the file's pieces never reach over white space, so that counts add up over words."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    probes = ["a b", "a  b", "don't go", "x́ y", "1 2", "... !", "<|endoftext|> a", "ab c d"]
    size = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    return all(size(p) == sum(size(w) for w in p.split(" ") if w) for p in probes)


def token_counts(
    docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """One row per document: id, bytes, tokens, over the limit or not, content digest, and whether the cache had it.

    ``cache_path`` is a table in a file system that all executors share; it is created when missing
    and may be used again by any later call, also under another tokenizer. Appends are committed by
    Spark; a digest appended twice by two callers counts once.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    if not splits_at_spaces(tokenizer_json):
        raise ValueError("the tokenizer keeps white space, so counts do not add up over words")
    version = hashlib.sha256(tokenizer_json.encode()).hexdigest()

    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    slim = rows.select("_id", F.octet_length("_text").cast("long").alias("n_bytes"), content_digest("_text").alias("digest"))
    wanted = slim.groupBy("digest").agg(F.min("_id").alias("_first"))
    if exists(spark, cache_path):
        known = _cached(spark, cache_path, version)
        wanted = wanted.join(known, "digest", "left_anti")
        found = known.select("digest", F.lit(True).alias("cached"))
    else:
        found = None
    texts = rows.select("_id", content_digest("_text").alias("digest"), normalised("_text").alias("_text"))
    same = (texts["digest"] == wanted["digest"]) & texts["_id"].eqNullSafe(wanted["_first"])
    misses = texts.join(wanted, same, "left_semi")

    sent = spark.sparkContext.broadcast(tokenizer_json)

    def encode(batches):
        counter = WordCounter(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts = counter.count(part.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(np.array(counts, np.int64))], ["digest", "n_tokens"])

    counted = misses.mapInArrow(encode, "digest binary, n_tokens long").withColumn("tokenizer", F.lit(version))
    if found is not None:
        slim = slim.join(found, "digest", "left")
    else:
        slim = slim.withColumn("cached", F.lit(False))
    counted.write.mode("append").parquet(cache_path)
    counts = _cached(spark, cache_path, version)
    return slim.join(counts, "digest").select(
        F.col("_id").alias(id_col),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
        F.lower(F.hex("digest")).alias("digest"),
        F.coalesce("cached", F.lit(False)).alias("cached"),
    )


def _cached(spark, cache_path: str, version: str) -> DataFrame:
    cache = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == version)
    return cache.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
