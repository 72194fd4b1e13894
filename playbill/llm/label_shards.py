"""Shards by balanced label propagation, with rows dealt evenly.

Documents with equal texts are linked. Every document begins in a shard by its id's hash. In each
round the documents of a group vote for the shard that most of them are in, and those elsewhere
ask to move there. A shard admits as many as its quota has room for, besides those it swaps with
another shard; each asking document moves with that probability, decided by a hash. At the end the
documents beyond a shard's quota (unlinked ones first, then those of very large groups) fill the
shards below theirs, so counts differ by one at most.

The law is ``rows``. Null and empty texts are one group of size 1 byte each. Rows with a null id
and repeated rows are placed like any other. Only Spark's own functions are used; the driver sees
figures of shards and pairs of shards alone.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.llm.support import cells_for, stored, with_positions

SHARDS = 16
ROUNDS = 3
LARGE_GROUP = 256  # a group with more than one in so many rows


def nodes(df: DataFrame, shards: int, id: str, text: str) -> DataFrame:
    """(id, key, size, crc, shard): what sharding needs of each document."""
    whole = F.coalesce(F.col(text), F.lit(""))
    start = F.pmod(F.xxhash64(F.col(id), F.lit("start")), F.lit(shards)).cast("int")
    return df.select(
        F.col(id).alias("id"),
        F.md5(whole.cast("binary")).alias("key"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("crc"),
        start.alias("shard"),
    )


def _chance(*parts) -> Column:
    """A number from 0 to 1 by hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


def propagate(linked: DataFrame, room: int, rounds: int) -> DataFrame:
    """Move linked documents (id, key, ..., shard) towards their group's shard."""
    for turn in range(rounds):
        votes = linked.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("votes"))
        # Ties go by a hash of group and shard, so that wishes are spread over the shards.
        best = F.max(F.struct("votes", F.xxhash64("key", "shard"), "shard"))
        wanted = votes.groupBy("key").agg(best.getField("shard").alias("target"))
        asking = stored(linked.join(wanted, "key"), "asking")
        wishes = asking.groupBy("shard", "target").agg(F.count(F.lit(1)).alias("wish"))
        wishes = stored(wishes, "wishes")  # a row for each pair of shards
        moves = wishes.filter("shard <> target")
        held = wishes.groupBy(F.col("shard").alias("target")).agg(F.sum("wish").alias("held"))
        into = moves.groupBy("target").agg(F.sum("wish").alias("into"))
        back = moves.select(
            F.col("target").alias("shard"), F.col("shard").alias("target"),
            F.col("wish").alias("back"),
        )
        quota = moves.join(into, "target").join(held, "target", "left")
        quota = quota.join(back, ["shard", "target"], "left").fillna(0, ["held", "back"])
        swapped = F.least("wish", "back")
        free = F.greatest(F.lit(room) - F.col("held"), F.lit(0)) * F.col("wish") / F.col("into")
        quota = quota.select(
            "shard", "target", F.least(F.lit(1.0), (swapped + free) / F.col("wish")).alias("share")
        )
        moved = asking.join(F.broadcast(quota), ["shard", "target"], "left")
        goes = _chance("id", "key", F.lit(turn)) < F.coalesce("share", F.lit(0.0))
        moved = moved.withColumn("shard", F.when(goes, F.col("target")).otherwise(F.col("shard")))
        linked = stored(moved.select(linked.columns), "linked")
    return linked


def _numbers(values) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def balanced(placed: DataFrame, total: int, shards: int) -> DataFrame:
    """Give every row its final shard and slot; ``part`` says who leaves a full shard last."""
    cells = cells_for(total // shards, least=16)
    spread = F.when(F.col("part") == 0, F.xxhash64("key")).otherwise(F.xxhash64("id", "key"))
    cell = F.col("part") * cells + F.pmod(spread, F.lit(cells))
    ranked = with_positions(placed, ["shard"], cell, ["key", "id"], "rank")
    counts = dict(placed.groupBy("shard").count().collect())  # one row for each shard
    have = [counts.get(s, 0) for s in range(shards)]
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    before, gaps = [0], [0]
    for h, q in zip(have, quota):
        before.append(before[-1] + max(0, h - q))
        gaps.append(gaps[-1] + max(0, q - h))
    own = lambda values: F.get(_numbers(values), F.col("shard"))
    over = F.col("rank") - own(quota)
    ranked = ranked.withColumn("over", F.when(over >= 0, over + own(before)))
    # Surplus rows fill the gaps in the order of shards.
    taken = F.filter(_numbers(gaps), lambda g: g <= F.col("over"))
    ranked = ranked.withColumn("to", F.when(F.col("over").isNotNull(), F.size(taken) - 1))
    slot = F.get(_numbers(have), F.col("to")) + F.col("over") - F.get(_numbers(gaps), F.col("to"))
    return ranked.select(
        "id", "key", "size", "crc",
        F.coalesce(F.col("to"), F.col("shard")).cast("int").alias("shard"),
        F.coalesce(slot, F.col("rank")).cast("long").alias("slot"),
    )


def shard_documents(
    df: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every document."""
    rows = stored(nodes(df, shards, id, text), "nodes")
    total = rows.count()
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    marked = stored(rows.join(groups, "key", "left"), "marked")
    linked = marked.filter("members > 1")
    linked = propagate(linked, total // shards, rounds)
    large = F.col("members") * LARGE_GROUP > total
    part = F.when(F.col("members").isNull(), 2).when(large, 1).otherwise(0)
    placed = marked.filter("members is null").unionByName(linked).withColumn("part", part)
    placed = stored(placed, "placed")
    found = balanced(placed, total, shards)
    return found.select(
        F.col("id").alias(id), "size", F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def cut_links(sharded: DataFrame, key: str) -> DataFrame:
    """(linked, cut): rows of groups, and those outside the shard that holds most of theirs."""
    votes = sharded.groupBy(key, "shard").count()
    whole = votes.groupBy(key).agg(F.sum("count").alias("rows"), F.max("count").alias("most"))
    return whole.filter("rows > 1").agg(
        F.sum("rows").alias("linked"), F.sum(F.col("rows") - F.col("most")).alias("cut")
    )
