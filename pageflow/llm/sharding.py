"""Shards of even size that keep linked documents together, by balanced label propagation.

Documents are linked through hubs (here: equal texts). Every document starts in a shard drawn from its
hash. In each round the members of a hub count, per shard, how many they are; members outside the shards
with most of them ask for one of these that has room, and as many requests are granted as there is room
for, by hash. A hub no larger than a shard asks as a whole for the shard with most of its members among
those that have room for the rest. Counts are grouped by (hub, shard), so a hub with a third of all rows costs a few
dozen rows. At last rows without links fill the shards up, and all rows are put in the order of shard
and hub, those without links at the end of their shard, and cut into equal parts. This evens out what is
left, and where a shard is too full it is mostly rows without links that move on.

The law is ``rows``: counts differ by one at most. Results: a NULL text has no bytes; repeated rows and
NULL ids each take a slot; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.functions.running import running_totals
from pageflow.llm.common import passing, plain_files, release, stored, tasks_for, text_of, unused

OVERHEAD = 8


def propagate(members: DataFrame, total: int, shards: int, rounds: int) -> DataFrame:
    """Shard for each member (``_row``, ``_hub``): moves towards its hub's shards under quotas of total / shards."""
    quota, tasks = total / shards, tasks_for(total)
    labels = members.withColumn("_shard", F.pmod(F.xxhash64("_row", F.lit(1)), F.lit(shards)).cast("int"))
    labels = stored(labels.coalesce(tasks), "shard-labels")
    for turn in range(rounds):
        tally = labels.groupBy("_hub", "_shard").agg(F.count("*").alias("_votes"))
        tally = stored(tally.coalesce(tasks), "shard-tally")
        release(members.sparkSession)
        held = {r["_shard"]: r["n"] for r in tally.groupBy("_shard").agg(F.sum("_votes").alias("n")).coalesce(1).collect()}
        room = {s: max(0.0, quota - held.get(s, 0)) for s in range(shards)}
        rooms = F.create_map(*[F.lit(x) for s in room for x in (s, room[s])])
        # A hub's homes are as many of its fullest shards as its members fill; where these have no room left,
        # its next ones. Equal votes are ordered by hash, so that small hubs do not all turn to one shard.
        tie = F.xxhash64("_hub", "_shard")
        order = F.array_sort(F.collect_list(F.struct((-F.col("_votes")).alias("v"), tie.alias("h"), F.col("_shard").alias("s"))))
        ranked = tally.groupBy("_hub").agg(order.alias("_order"), F.sum("_votes").alias("_members"))
        needed = F.ceil(F.col("_members") / quota).cast("int")
        shards_of = F.transform("_order", lambda x: x["s"])
        # A hub no larger than a shard goes whole to the fullest of its shards that has room for the others.
        fits = F.filter("_order", lambda x: F.element_at(rooms, x["s"]) - x["v"] >= F.col("_members"))
        home = F.slice(F.transform(fits, lambda x: x["s"]), 1, 1)
        whole = (needed == 1) & (F.size(fits) > 0)
        ranked = ranked.select(
            "_hub",
            F.when(whole, home).otherwise(F.slice(shards_of, F.lit(1), needed)).alias("_main"),
            F.when(whole, home)
            .otherwise(F.slice(F.filter(shards_of, lambda x: F.element_at(rooms, x) >= 1), F.lit(1), needed))
            .alias("_open"),
        )
        away = (F.size("_open") > 0) & ~F.array_contains(F.concat("_main", "_open"), F.col("_shard"))
        asking = tally.join(ranked, "_hub").where(away)
        shares_of = asking.select((F.col("_votes") / F.size("_open")).alias("_n"), F.explode("_open").alias("_to"))
        demand = {r["_to"]: r["n"] for r in shares_of.groupBy("_to").agg(F.sum("_n").alias("n")).coalesce(1).collect()}
        if not demand:
            break
        share = F.create_map(*[F.lit(x) for s in demand for x in (s, min(1.0, max(0.0, room[s] - room[s] ** 0.5) / demand[s]))])
        wish = F.get("_open", F.pmod(F.xxhash64("_row", F.lit(turn + 101)), F.size("_open")).cast("int"))
        drawn = F.pmod(F.xxhash64("_row", F.lit(turn + 7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        asked = labels.join(ranked, "_hub").withColumn("_wish", F.when(away, wish))
        granted = F.col("_wish").isNotNull() & (drawn < F.element_at(share, F.col("_wish")))
        moved = asked.select("_row", "_hub", F.when(granted, F.col("_wish")).otherwise(F.col("_shard")).alias("_shard"))
        labels = stored(moved.coalesce(tasks), "shard-labels")
    return labels


@passing("shard-rows", "shard-documents")
def balanced_shards(
    docs: DataFrame,
    shards: int = 24,
    rounds: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """One row per document: id, size, CRC-32 of its text, law, shard, slot, and no shard under growth.

    With ``carry`` the documents are returned whole, with ``shard`` and ``slot`` added (and replacing
    columns of these names). Documents that come from Parquet files as they are get no copy: their rows are found
    again by file and place. Others are stored with a number first.
    """
    text = text_of(text_col)
    number, file, at = (unused(docs.columns, x) for x in ("_row", "_file", "_at"))
    placed_rows = carry and plain_files(docs)
    if placed_rows:
        place = docs.metadataColumn("_metadata")
        docs = docs.select("*", place["file_path"].alias(file), place["row_index"].alias(at))
    elif carry:
        docs = stored(docs.withColumn(number, F.monotonically_increasing_id()), "shard-documents")
    rows = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.unhex(F.md5(text)).alias("_hub"),
        (F.col(number) if carry and not placed_rows else F.monotonically_increasing_id()).alias("_row"),
        *([F.col(at).alias("_at"), F.col(file).alias("_file")] if placed_rows else []),
    )
    rows = stored(rows, "shard-rows")
    places = rows.select("_row", "_at", "_file") if placed_rows else None
    rows = rows.drop("_at", "_file")
    total = rows.count()
    tasks = tasks_for(total)
    hubs = rows.groupBy("_hub").agg(F.count("*").alias("_n")).where("_n > 1").select("_hub")
    labels = propagate(rows.select("_row", "_hub").join(hubs, "_hub", "left_semi"), total, shards, rounds)
    held = {r["_shard"]: r["n"] for r in labels.groupBy("_shard").agg(F.count("*").alias("n")).coalesce(1).collect()}
    # Unlinked rows fill what is left of each shard, in order of their numbers.
    filled, ends = 0, []
    for s in range(shards):
        size = -(-total * (s + 1) // shards) + (-total * s // shards)
        filled += max(0, size - held.get(s, 0))
        ends.append(filled)
    single = running_totals(rows.join(hubs, "_hub", "left_anti"), ["_row"], {"_place": F.lit(1).cast("long")}, tasks=tasks)
    free = F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e < F.col("_place"))
    single = single.withColumn("_shard", F.least(F.size(free), F.lit(shards - 1))).drop("_place")
    linked = rows.join(labels.select("_row", "_shard"), "_row").withColumn("_alone", F.lit(False))
    placed = linked.unionByName(single.withColumn("_alone", F.lit(True)))
    ranked = running_totals(placed, ["_shard", "_alone", "_hub", "_row"], {"_rank": F.lit(1).cast("long")}, tasks=tasks)
    rank = F.col("_rank") - 1
    # Integer arithmetic: shard s holds the places from ceil(s * total / shards) on.
    cut = F.expr(f"(_rank - 1) * {shards}L div {max(total, 1)}L")
    start = F.expr(f"(((_rank - 1) * {shards}L div {max(total, 1)}L) * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    if carry:
        slots = ranked.select(F.col("_row").alias(number), cut.cast("int").alias("shard"), (rank - start).cast("long").alias("slot"))
        if places is None:
            return docs.drop("shard", "slot").join(slots, number).drop(number)
        places = places.select(F.col("_row").alias(number), F.col("_at").alias(at), F.col("_file").alias(file))
        return docs.drop("shard", "slot").join(slots.join(places, number).drop(number), [file, at]).drop(file, at)
    return ranked.coalesce(tasks).select(
        F.col("_id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        cut.cast("int").alias("shard"),
        (rank - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
