"""Token counts, exact duplicates, archives, shards and pseudonyms against plain Python."""

from __future__ import annotations

import gzip
import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pageflow.functions.running import scratch_path
from pageflow.llm import exactdedup, pseudonyms, sharding, tokencounts, warc


def _tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_token_counts_equal_the_library(spark, documents, odd):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(_tokenizer())
    rows = [*odd, (20, "a <|endoftext|>b don't 12 34 Ça İ ǅ"), (21, "x́ y z　q ''s"), (22, "A  A\nA")]
    cache = scratch_path(spark, "test-cache")
    for turn in range(2):
        got = tokencounts.token_counts(documents(rows, extra=True), _tokenizer(), cache).collect()
        assert len(got) == len(rows)
        want = Counter((d, len((t or "").encode()), len(own.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 2048) and r.cached == bool(turn) for r in got)
    # the second call appended nothing, and equal content under other white space was stored once
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() < len(rows)
    assert tokencounts.token_counts(documents([]), _tokenizer(), cache).count() == 0
    more = tokencounts.token_counts(documents([(1, "one two"), (2, "fresh words")]), _tokenizer(), cache).collect()
    assert {r.doc_id: r.cached for r in more} == {1: True, 2: False}


@pytest.mark.parametrize("hashed", [exactdedup.hash128, lambda text: F.substring(F.encode(text, "UTF-8"), 1, 1)])
def test_exact_duplicates(documents, odd, hashed):
    """Also with a hash that collides all the time: bytes decide."""
    rows = [*odd, *[(100 + k, "hot") for k in range(200)], (300, "house"), (301, "Hot")]
    got = exactdedup.exact_duplicates(documents(rows, extra=True), keep="largest", hashed=hashed).collect()
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    want = Counter()
    for d, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        want[(d, keep, len(groups[t or ""]), d == keep, hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in got) == want
    assert exactdedup.exact_duplicates(documents([])).count() == 0
    assert {r.keep_id for r in exactdedup.exact_duplicates(documents([(3, "a"), (2, "a")])).collect()} == {2}


def test_archives_round_trip(spark):
    rng = random.Random(3)
    long = "".join(chr(rng.randrange(32, 0x2000)) for _ in range(50_000))
    same = "<p>equal page</p>" * 20
    rows = [(k, f"http://a.example/é?{k}", f"<html>{k} {rng.random()}</html>" * (1 + k % 7)) for k in range(120)]
    rows += [(200 + k, None, same) for k in range(60)] + [(300, "u", None), (301, "u", ""), (302, "u", "x" * 99), (303, "u", "x" * 99)]
    rows += [(304, "u", long), (None, "u", same), (200, None, same), (None, "u", "alone" * 30), (None, "u", "alone" * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(5)
    folder = scratch_path(spark, "test-warc")
    manifest = warc.write_archives(warc.typed_records(pages, "page_id", "url", "html"), folder, file_bytes=4_000)
    files = manifest.collect()
    assert len(files) > 1 and sum(f.records for f in files) == len(rows)
    text = gzip.open(files[0].file).read()
    assert text.startswith(b"WARC/1.1\r\n") and text.count(b"WARC-Record-ID") == files[0].records
    payload = {r[0]: r[2] or "" for r in rows}
    for split in (64, 1_000, 1 << 26):
        records = warc.read_archives(spark, manifest, folder, split_bytes=split)
        got = Counter(tuple(r) for r in warc.digests(records).collect())
        want = Counter()
        for d, _, html in rows:
            raw = (html or "").encode()
            ids = [x for x, _, h in rows if (h or "") == (html or "") and x is not None]
            first = min(ids) if ids and len(raw) >= 100 else None
            again = first is not None and d != first
            want[(d, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None)] += 1
        assert got == want
    assert {r.url for r in records.where("id = 5").collect()} == {"http://a.example/é?5"}
    assert bytes(records.where("id = 304").first().payload).decode() == payload[304]
    none = warc.write_archives(warc.typed_records(pages.limit(0), "page_id", "url", "html"), scratch_path(spark, "test-warc"))
    assert warc.read_archives(spark, none, folder).count() == 0


def test_a_magic_inside_a_member_is_no_record():
    row = {"id": 1, "url": "u", "digest": "d", "length": 3, "record_type": "response", "refers_to": None}
    inner = warc._member({**row, "id": 9, "payload": b"in"}, 0)
    data = b"".join(warc._member({**row, "id": k, "payload": inner + warc.MAGIC * 5}, 0) for k in range(4))
    for split in (7, 50, 333, len(data)):
        found = []
        for start in range(0, len(data), split):
            part = warc.Range(io.BytesIO(data), len(data), start, min(len(data), start + split))
            found += [warc._parsed(content)["id"] for _, content in part.members()]
        assert found == [0, 1, 2, 3]


def test_shards_are_even_and_keep_groups(documents, odd):
    rng = random.Random(5)
    rows = [(k, f"text {k}") for k in range(700)] + [(1_000 + k, f"copy {k % 40}") for k in range(400)]
    rows += [(2_000 + k, "hot") for k in range(600)] + list(odd)
    rng.shuffle(rows)
    got = sharding.balanced_shards(documents(rows, extra=True), shards=24).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows
    )
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    text = {d: t for d, t in rows}
    spread = defaultdict(set)
    for r in got:
        if r.doc_id is not None and r.doc_id >= 1_000:
            spread[text[r.doc_id]].add(r.shard)
    # forty groups of ten, most of them whole; 600 of 1,711 rows need nine shards at least
    assert sum(len(s) == 1 for k, s in spread.items() if k != "hot") >= 24
    assert len(spread["hot"]) <= 18
    assert sharding.balanced_shards(documents([])).count() == 0
    whole = sharding.balanced_shards(documents(rows[:50], extra=True), shards=4, carry=True)
    assert whole.count() == 50 and {"text", "shard", "slot", "_row"} - set(whole.columns) == {"_row"}


def test_shards_store_few_files(spark, documents, monkeypatch):
    files = []
    monkeypatch.setattr(sharding, "stored", lambda df, name, f=sharding.stored: files.append(f(df, name)) or files[-1])
    rows = [(k, f"text {k % 60}" if k % 3 else f"own {k}") for k in range(300)]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sharding.balanced_shards(documents(rows).coalesce(1), shards=4, rounds=2)
        assert got.rdd.getNumPartitions() == 1 and sorted(Counter(r.shard for r in got.collect()).values()) == [75] * 4
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(files) > 3 and {len(x.inputFiles()) for x in files} == {1}


def test_permutations_are_bijections():
    for size in (1, 2, 7, 100, 1_000):
        p = pseudonyms.Permutation(b"k", "t", size)
        assert sorted(map(p.forth, range(size))) == list(range(size))
        assert all(p.back(p.forth(x)) == x for x in range(size))
    assert pseudonyms.Permutation(b"k", "t", 10**6).forth(5) != pseudonyms.Permutation(b"j", "t", 10**6).forth(5)


def test_pseudonyms(documents, odd):
    text = (
        "Mail a.b-c9@mail.example.org, card 4111 1111 1111 1111 or 4111-1111-1111-1111, not 4111 1111 1111 1112; "
        "call +1 (586) 555-0245 or 586-555-0245 or +44 20 7946 0958; ip 10.1.2.3, not 300.1.2.3; on 2024-02-29, 31/12/1999, 12/31/1999, "
        "not 2023-02-29; ssn 123-45-6789, not 000-12-3456; DE89 3704 0044 0532 0130 00, not DE88 3704 0044 0532 0130 00; "
        "password=e3b3ed3cc8548923d6 4451718024887799 27.65.93.188."
    )
    key = b"secret"
    rows = [(100, text), (101, "again 4111111111111111 and 5865550245 a.b-c9@mail.example.org"), (102, "nothing 12 here, 3.5 of 7"), *odd]
    got = pseudonyms.pseudonymise(documents(rows, extra=True), key).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    kinds = Counter(s.kind for s in by[100].spans)
    assert kinds == {"email": 1, "card": 3, "phone": 3, "ip": 2, "date": 3, "ssn": 1, "iban": 1, "hex": 1}
    assert by[102].text == "nothing 12 here, 3.5 of 7" and by[1].text is None and not by[1].spans
    new = by[100].text
    assert len(new) - len(text) == len(new.split("ip ")[1].split(",")[0]) - 8 + len(new.rsplit(" ", 1)[1]) - len("27.65.93.188.")
    for part in ("4111 1111 1111 1111", "a.b-c9@", "555-0245", "10.1.2.3", "2024-02-29", "123-45-6789", "e3b3ed"):
        assert part not in new
    for part in ("4111 1111 1111 1112", "300.1.2.3", "2023-02-29", "000-12-3456", "DE88 3704 0044 0532 0130 00"):
        assert part in new
    card = new.split("card ")[1][:19].replace(" ", "")
    assert pseudonyms.luhn_digit(card[:-1]) == int(card[-1])
    assert card in by[101].text and new.split("Mail ")[1].split(",")[0] in by[101].text
    back = pseudonyms.pseudonymise(documents([(1, new), (2, by[101].text)]), key, undo=True).collect()
    assert {r.text for r in back} == {text, rows[1][1]}
    assert pseudonyms.pseudonymise(documents([]), key).count() == 0


def test_values_next_to_other_words_are_found():
    """An IBAN with an upper-case word behind it, values inside a failed match, and dates with a time."""
    worker, back = pseudonyms.Pseudonyms(b"k"), pseudonyms.Pseudonyms(b"k", back=True)
    plain = worker.apply("BE68 5390 0754 7034")[0]
    day = worker.apply("2024-01-05")[0]
    for text, want, kinds in (
        ("BE68 5390 0754 7034 BIC", plain + " BIC", ["iban"]),
        ("BE68539007547034 EUR", plain.replace(" ", "") + " EUR", ["iban"]),
        ("to BE68 5390 0754 7034 2024 EUR", f"to {plain} 2024 EUR", ["iban"]),
        ("at 2024-01-05T10:11:12Z", f"at {day}T10:11:12Z", ["date"]),
        ("2024-01-05 and 2024-01-05Tx", f"{day} and 2024-01-05Tx", ["date"]),
        ("ZZ00 3456 BE68 5390 0754 7034", f"ZZ00 3456 {plain}", ["iban"]),
    ):
        new, spans = worker.apply(text)
        assert new == want and [k for _, _, k in spans] == kinds, text
        assert back.apply(new)[0] == text


def test_very_long_values_of_all_kinds(documents):
    n = 100_000
    texts = [
        "x " + "0123456789abcdef" * (n // 16) + " y",
        "7" * n + "@example.org",
        "Ab" * n + "@example.org",
        "a1." * n + "z@example.org z",
        "@".join(["a"] * n),
        "DE" + "1" * n,
        " ".join(["DE89 3704 0044 0532 0130 00"] * (n // 20)),
        "4111 1111 1111 1111 " * (n // 20),
        "1" * n,
        "1.2." * n,
        "2024-01-05 " * (n // 10),
        "123-45-" * n,
        "+49 " + "1 " * n,
    ]
    key = b"secret"
    done = {r.doc_id: r for r in pseudonyms.pseudonymise(documents(list(enumerate(texts))), key).collect()}
    assert all(len(done[k].text) == len(t) for k, t in enumerate(texts))
    assert all(done[k].text != texts[k] for k in (0, 1, 2, 3, 6, 7, 10))
    back = pseudonyms.pseudonymise(documents([(k, r.text) for k, r in done.items()]), key, undo=True).collect()
    assert all(r.text == texts[r.doc_id] for r in back)
    twice = pseudonyms.Pseudonyms(key)
    assert twice.apply("AB" * 3_000 + "@x.org")[0].lower() == twice.apply("ab" * 3_000 + "@x.org")[0]
