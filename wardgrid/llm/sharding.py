"""Sharding by balanced label propagation.

Documents with equal texts are linked (a link group). Documents start in shards dealt by hash,
counts at most one apart. In each round a group's documents move towards the group's shard: the
one that already holds most of them, ties by a hash that changes with the round. Capacity quotas keep
the sizes: a shard takes as many movers as it holds loose documents, those with no link and those that
are away from their own group's shard. As many loose documents, waiting ones included, go to the shards
that lost rows. So after every round the counts are those of the start, and the links cut (documents
away from their group's shard) never get more: a loose document is no worse off anywhere. Rounds end when
no link is cut, when PATIENCE rounds in a row cut no fewer, or after `rounds`.

A group larger than a shard gets as many home shards as its documents fill; each of its documents
outside them moves to one of them, chosen by hash.

Only ids, sizes and digests move; texts are read once. All ranks are gapless prefix sums over
blocks, so no task holds a whole shard or group.

Edge cases: null text has size 16, crc32 0 and no link, while equal empty texts are a group; a null doc_id is a
row like any other; repeated rows are separate, linked rows; fewer rows than shards leave shards
empty; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardgrid.llm.shared import running_total, stored

SHARDS = 40
#: Rounds at most, and rounds without fewer cut links that end the moves before.
ROUNDS = 20
PATIENCE = 3


def _part(leading: str, spread: str) -> Column:
    """Blocks that keep equal `leading` values near one another and still split a hot one in 16."""
    return (F.pmod(F.xxhash64(leading), F.lit(32)) * 16 + F.pmod(F.xxhash64(spread), F.lit(16))).cast("int")


def _numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Gapless numbers from 0 within keys, in blocks by the first and last column of `order`."""
    with_block = df.withColumn("_one", F.lit(1)).withColumn("_part", _part(order[0], order[-1]))
    return running_total(with_block, "_one", keys, "_part", [F.col(c) for c in order], name).drop("_one", "_part")


def _goals(spark: SparkSession, state: DataFrame, capacity: int, number: int) -> DataFrame:
    """state (row, link, shard) with the shard that a row wants to move to, null if none."""
    held = state.filter("link IS NOT NULL").groupBy("link", "shard").agg(F.count("*").alias("n"))
    # A group's homes: its best shards, as many as its rows fill; ties by a hash of group, shard and round.
    best = Window.partitionBy("link").orderBy(F.desc("n"), F.xxhash64("link", "shard", F.lit(number)))
    ranked = held.select(
        "link",
        "shard",
        F.row_number().over(best).alias("rank"),
        F.sum("n").over(Window.partitionBy("link")).alias("size"),
        F.count("*").over(Window.partitionBy("link")).alias("places"),
    )
    homes = (
        ranked.filter((F.col("places") > 1) & (F.col("rank") <= F.ceil(F.col("size") / capacity)))
        .groupBy("link")
        .agg(F.collect_list("shard").alias("homes"))
    )
    choice = F.element_at("homes", (F.pmod(F.xxhash64("row"), F.size("homes")) + 1).cast("int"))
    # Unlinked rows stay out of the join: their null key would gather them in one task.
    linked = state.filter("link IS NOT NULL").join(homes, "link", "left")
    wants = F.col("homes").isNotNull() & ~F.array_contains("homes", F.col("shard"))
    goals = linked.select("row", "link", "shard", F.when(wants, choice).alias("goal"))
    free = state.filter("link IS NULL").select("row", "link", "shard", F.lit(None).cast("int").alias("goal"))
    return stored(spark, goals.unionByName(free), f"shards-{number}-goals")


def _round(spark: SparkSession, placed: DataFrame, number: int) -> DataFrame:
    """One round of moves. placed: as `_goals` gives it; rows per shard stay as they are."""
    loose = placed.filter("link IS NULL OR goal IS NOT NULL")
    quotas = loose.groupBy(F.col("shard").alias("goal")).agg(F.count("*").alias("quota"))
    movers = _numbered(placed.filter("goal IS NOT NULL"), ["goal"], ["link", "row"], "at")
    fits = F.col("at") < F.coalesce(F.col("quota"), F.lit(0))
    movers = stored(
        spark,
        movers.join(F.broadcast(quotas), "goal", "left").select("row", "shard", "goal", fits.alias("fits")),
        f"shards-{number}-movers",
    )
    moved = movers.filter("fits")
    change = (
        moved.select(F.col("goal").alias("shard"), F.lit(1).alias("d"))
        .unionAll(moved.select("shard", F.lit(-1).alias("d")))
        .groupBy("shard")
        .agg(F.sum("d").alias("d"))
    )
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # Loose rows of shards that gained, and places in shards that lost, meet by rank.
    gained = change.filter("d > 0").withColumn("start", F.coalesce(F.sum("d").over(ahead), F.lit(0)))
    lost = change.filter("d < 0").select("shard", (-F.col("d")).alias("need"))
    lost = lost.withColumn("start", F.coalesce(F.sum("need").over(ahead), F.lit(0)))
    staying = placed.filter("link IS NULL").select("row", "shard").unionAll(movers.filter("NOT fits").select("row", "shard"))
    leaving = (
        _numbered(staying, ["shard"], ["row"], "at")
        .join(F.broadcast(gained), "shard")
        .filter("at < d")
        .select("row", (F.col("start") + F.col("at")).alias("rank"))
    )
    places = lost.select(F.col("shard").alias("goal"), "start", (F.col("start") + F.col("need")).alias("end"))
    refilled = leaving.join(F.broadcast(places), (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("end"))).select("row", "goal")
    new_home = moved.select("row", "goal").unionAll(refilled)
    out = placed.drop("goal").join(new_home, "row", "left")
    return stored(spark, out.select("row", "link", F.coalesce("goal", "shard").alias("shard")), f"shards-{number}")


def shard(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.md5(F.col("text").cast("binary")).alias("_text"),
    )
    facts = stored(spark, facts.withColumn("_salt", F.xxhash64("doc_id", "_text")), "shards-facts")
    rows = stored(spark, _numbered(facts, [], ["_salt", "doc_id", "_text"], "row").drop("_salt"), "shards-rows")
    several = rows.filter("_text IS NOT NULL").groupBy("_text").agg(F.count("*").alias("n")).filter("n > 1")
    links = several.select(F.col("_text").alias("_t"), F.xxhash64("_text").alias("link"))
    state = rows.join(links, F.col("_text") == F.col("_t"), "left").select(
        "row", "link", (F.col("row") % shards).cast("int").alias("shard")
    )
    state = stored(spark, state, "shards-start")
    capacity = max(1, rows.count() // shards)
    least, idle = None, 0
    for number in range(rounds):
        placed = _goals(spark, state, capacity, number)
        cut = placed.filter("goal IS NOT NULL").count()
        least, idle = (cut, 0) if least is None or cut < least else (least, idle + 1)
        if cut == 0 or idle >= PATIENCE:
            break
        state = _round(spark, placed, number)
    placed = rows.select("row", "doc_id", "size", "text_crc32").join(state, "row")
    return _numbered(placed, ["shard"], ["row"], "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "link",
    )


def cut_links(sharded: DataFrame) -> DataFrame:
    """Per link group with documents in several shards: rows, and rows away from its largest part."""
    parts = sharded.filter("link IS NOT NULL").groupBy("link", "shard").agg(F.count("*").alias("n"))
    return (
        parts.groupBy("link")
        .agg(F.sum("n").alias("rows"), (F.sum("n") - F.max("n")).alias("cut"), F.count("*").alias("shards"))
        .filter("shards > 1")
    )
