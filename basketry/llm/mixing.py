"""Mixing sources to target weights, with DataFrame operations only.

Sources are cut into blocks of documents. How many blocks the mix draws from
each source follows from its target. Which output shard gets them is drawn by a
splitting tree: its root holds the quotas of all sources, and each node deals
half of its blocks, by a multivariate hypergeometric draw, to either child, so
that every shard is as large as the next and a fair sample of the whole. The
shards then draw disjoint runs of each source's permuted blocks and are
shuffled each on its own.

All randomness is a hash of keys and a seed, so reruns agree.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.llm.common import SEED
from basketry.session import materialize

#: Documents in a block on average, blocks in a group, words in a shard.
BLOCK_DOCS, GROUP_BLOCKS, SHARD_WORDS = 256, 1024, 1 << 22

_WHITE = " \t\n\x0b\x0c\r"


def count_words(text: Column) -> Column:
    """Runs of bytes other than space and tab to carriage return; null: 0."""
    spaced = F.translate(F.coalesce(text, F.lit("")), _WHITE[1:], " " * 5)
    parts = F.split(F.trim(spaced), " +")
    return F.when(F.trim(spaced) == "", 0).otherwise(F.size(parts)).cast("long")


def _uniform(*parts: Column | str) -> Column:
    """A number in (0, 1) by the hash of these."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def targets(
    sizes: DataFrame, weights: tuple[float, ...], share: float, most: float
) -> DataFrame:
    """Per source: its target by weight, at most ``most`` times its size.

    ``sizes`` has source_key (sorted as the weights repeat), words. The excess
    over a stopped target goes to the others by weight until none is above.
    So the targets are min(most * words, level * weight) at the level where
    they add up; it is found from the sources in the order in which they stop.
    One row per source meets in one task.
    """
    in_order = Window.orderBy("source_key")
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)),
        (F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    stop = (F.col("words") * F.lit(float(most))).alias("stop")
    ranked = sizes.select("source_key", "words", stop, weight.alias("weight"))
    rising = Window.orderBy(F.col("stop") / F.col("weight"), "source_key")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onwards = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.least(F.sum("words").over(everything) * F.lit(float(share)), F.sum("stop").over(everything))
    level = (total - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(onwards)
    # the first level that does not pass its own source's stop is the level
    fits = F.when(level * F.col("weight") <= F.col("stop"), level)
    leveled = ranked.withColumn("fits", fits).withColumn("level", F.max("fits").over(everything))
    found = F.coalesce(F.least(F.col("level") * F.col("weight"), "stop"), F.col("stop"))
    return leveled.select("source_key", "words", found.alias("target"))


def _hypergeometric(u: Column, good: Column, bad: Column, draws: Column) -> Column:
    """How many of ``draws`` from good + bad are good, by inversion.

    Sums the probabilities within 12 deviations of the mean, where all but
    1e-30 of them lies; their ratios need no factorials.
    """
    total = good + bad
    mean = draws * good / F.greatest(total, F.lit(1.0))
    spread = 12 * F.sqrt(F.greatest(mean * (bad / F.greatest(total, F.lit(1.0))), F.lit(0.0))) + 12
    low = F.ceil(F.greatest(F.lit(0.0), draws - bad, mean - spread)).cast("double")
    high = F.floor(F.least(good, draws, mean + spread)).cast("double")
    steps = F.sequence(low.cast("long"), F.greatest(low, high).cast("long"))
    step = lambda k: F.log((good - k) * (draws - k) / ((k + 1) * (bad - draws + k + 1)))
    # logarithm of the largest term relative to the first, then the sum
    start = F.struct(F.lit(0.0).alias("at"), F.lit(0.0).alias("top"), F.lit(0.0).alias("sum"))

    def add(acc: Column, k: Column) -> Column:
        k = k.cast("double")
        after = F.when(k < high, acc["at"] + step(k)).otherwise(acc["at"])
        top = F.greatest(acc["top"], acc["at"])
        mass = acc["sum"] * F.exp(acc["top"] - top) + F.exp(acc["at"] - top)
        return F.struct(after.alias("at"), top.alias("top"), mass.alias("sum"))

    whole = F.aggregate(steps, start, add)
    seek = F.struct(
        F.lit(0.0).alias("at"), F.lit(0.0).alias("sum"), low.cast("long").alias("found"), F.lit(False).alias("over")
    )

    def find(acc: Column, k: Column) -> Column:
        x = k.cast("double")
        mass = acc["sum"] + F.exp(acc["at"] - whole["top"])
        after = F.when(x < high, acc["at"] + step(x)).otherwise(acc["at"])
        return F.struct(
            after.alias("at"),
            mass.alias("sum"),
            F.when(acc["over"], acc["found"]).otherwise(k).alias("found"),
            (acc["over"] | (mass >= u * whole["sum"])).alias("over"),
        )

    return F.aggregate(steps, seek, find)["found"]


def _split(nodes: DataFrame) -> DataFrame:
    """The next level of the tree: two children for each node."""
    total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q["draws"])
    held = nodes.withColumn("total", total).withColumn("half", F.expr("total div 2"))
    start = F.struct(
        F.col("half").alias("want"),
        F.col("total").alias("rest"),
        F.array().cast("array<struct<source_key:string,draws:bigint>>").alias("left"),
    )

    def deal(acc: Column, q: Column) -> Column:
        n = q["draws"].cast("double")
        got = _hypergeometric(
            _uniform("node", q["source_key"]), n, acc["rest"].cast("double") - n, acc["want"].cast("double")
        )
        one = F.struct(q["source_key"].alias("source_key"), got.alias("draws"))
        return F.struct(
            (acc["want"] - got).alias("want"),
            (acc["rest"] - q["draws"]).alias("rest"),
            F.concat(acc["left"], F.array(one)).alias("left"),
        )

    dealt = held.withColumn("left", F.aggregate("quotas", start, deal)["left"])
    right = F.zip_with(
        "quotas",
        "left",
        lambda q, one: F.struct(
            q["source_key"].alias("source_key"), (q["draws"] - one["draws"]).alias("draws")
        ),
    )
    children = F.array(
        F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas")),
        F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("quotas")),
    )
    return dealt.select(F.inline(children))


def shard_quotas(draws: DataFrame, levels: int) -> DataFrame:
    """Blocks of every source for each of 2 ** levels shards.

    ``draws`` has source_key and draws, a row per source, which meet in one
    row. Returns source_key and ``ends``: for each shard, the draws of the
    source that it and the shards before it get.
    """
    quota = F.struct("source_key", "draws")
    nodes = draws.agg(F.array_sort(F.collect_list(quota)).alias("quotas"))
    nodes = nodes.select(F.lit(1).cast("long").alias("node"), "quotas")
    for _ in range(levels):
        nodes = materialize(_split(nodes))
    flat = nodes.select("node", F.inline("quotas"))
    by_shard = F.array_sort(F.collect_list(F.struct("node", "draws")))
    start = F.struct(
        F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("ends")
    )
    ends = F.aggregate(
        "by_shard",
        start,
        lambda acc, x: F.struct(
            (acc["sum"] + x["draws"]).alias("sum"),
            F.concat(acc["ends"], F.array(acc["sum"] + x["draws"])).alias("ends"),
        ),
    )
    return flat.groupBy("source_key").agg(by_shard.alias("by_shard")).select(
        "source_key", ends["ends"].alias("ends")
    )


def _ahead(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``end``, the words of a source through it, and ``rank``.

    Sums over groups of blocks first, then within each group, so no window
    holds all blocks of a source. Takes mix_source, group, order, block, words.
    """
    groups = blocks.groupBy("mix_source", "group").agg(
        F.sum("words").alias("w"), F.count("*").alias("n")
    )
    ahead = Window.partitionBy("mix_source").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        "mix_source", "group",
        F.coalesce(F.sum("w").over(ahead), F.lit(0)).alias("group_words"),
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("group_blocks"),
    )
    within = Window.partitionBy("mix_source", "group").orderBy("order", "block")
    through = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        blocks.withColumn("through", F.sum("words").over(through))
        .withColumn("number", F.row_number().over(within) - 1)
        .join(materialize(groups), ["mix_source", "group"])
        .withColumn("end", F.col("through") + F.col("group_words"))
        .withColumn("rank", F.col("number") + F.col("group_blocks"))
        .drop("through", "number", "group_words", "group_blocks")
    )


def _fill(rows: DataFrame, border: DataFrame) -> DataFrame:
    """Of each border block, the keys of rows that fit its ``left`` in hashed order.

    Rows that repeat go together. Returns mix_source, block, some and over,
    what then is left.
    """
    taken = F.aggregate(
        "rows",
        F.struct(F.col("left").alias("left"), F.array().cast("array<bigint>").alias("keys")),
        lambda acc, r: F.when(
            (r["n"] * r["mix_size"] <= acc["left"]) & (r["mix_size"] > 0),
            F.struct(
                (acc["left"] - r["n"] * r["mix_size"]).alias("left"),
                F.concat(acc["keys"], F.array(r["mix_key"])).alias("keys"),
            ),
        ).otherwise(acc),
    )
    return (
        rows.join(border.select("mix_source", "block", "left"), ["mix_source", "block"])
        .groupBy("mix_source", "block", "left", "mix_key", "mix_size")
        .agg(F.count("*").alias("n"))
        .groupBy("mix_source", "block", "left")
        .agg(F.array_sort(F.collect_list(F.struct("mix_key", "mix_size", "n"))).alias("rows"))
        .withColumn("taken", taken)
        .select("mix_source", "block", F.col("taken.keys").alias("some"), F.col("taken.left").alias("over"))
    )


def plan_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: int = 2,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The rows of ``docs`` with what the mix does with them.

    Adds mix_size (words of the text), mix_source_size (of its source),
    mix_target (its source's), mix_shards (the output shard of each time the
    row is taken) and mix_key (orders a shard). Sources are weighed in code
    point order, null last; their targets share ``share`` times all words and
    stop at ``most`` times their size. A row is taken whole, ``most`` times at
    the most. Whole rounds of a source take all its rows; the rest of the
    target takes whole blocks in permuted order while they fit, and from the
    next block its rows in hashed order, each one that still fits; what these
    leave goes to the blocks behind it in the same way, until no row fits.

    A null text has no words; a source without words has target 0. Rows that
    repeat are rows of their own, in one block. An empty table stays empty.
    Columns of these names in ``docs`` are replaced; no others matter.
    """
    docs = docs.drop("mix_size", "mix_source_size", "mix_target", "mix_shards", "mix_key")
    key = F.coalesce(F.concat(F.lit("v"), F.col("source").cast("string")), F.lit("w"))
    identity = F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text"))
    sized = docs.withColumns(
        {"mix_source": key, "mix_size": count_words(F.col("text").cast("string")), "mix_key": identity}
    )
    narrow = materialize(sized.select("mix_source", "mix_size", "mix_key"))
    sizes = narrow.groupBy(F.col("mix_source").alias("source_key")).agg(
        F.sum("mix_size").alias("words"), F.count("*").alias("docs")
    )
    aims = targets(sizes, weights, share, most).join(sizes.drop("words"), "source_key")
    rounds = F.when(F.col("words") > 0, F.least(F.floor(F.col("target") / F.col("words")), F.lit(most)))
    aims = materialize(
        aims.withColumn("rounds", F.coalesce(rounds, F.lit(0)).cast("long"))
        .withColumn("rest", F.floor(F.col("target") - F.col("rounds") * F.col("words") + 1e-6).cast("long"))
        .withColumn("n_blocks", F.ceil(F.col("docs") / BLOCK_DOCS))
        .withColumn("n_groups", F.ceil(F.col("n_blocks") / GROUP_BLOCKS))
    )
    few = aims.select(
        F.col("source_key").alias("mix_source"), "rounds", "rest", "n_blocks", "n_groups"
    )
    block = F.pmod(F.xxhash64(F.col("mix_key"), F.lit("block")), F.col("n_blocks"))
    rows = narrow.join(few.select("mix_source", "n_blocks", "n_groups"), "mix_source")
    rows = rows.withColumn("block", block)
    of_key = rows.groupBy("mix_source", "block", "n_groups", "mix_key", "mix_size").agg(F.count("*").alias("n"))
    together = F.col("n") * F.col("mix_size")
    blocks = (
        of_key.groupBy("mix_source", "block", "n_groups")
        .agg(F.sum(together).alias("words"), F.min(F.when(together > 0, together)).alias("least"))
        .withColumn("order", F.xxhash64(F.lit(SEED), "mix_source", "block"))
        .withColumn("group", F.pmod("order", "n_groups"))
    )
    blocks = materialize(
        _ahead(materialize(blocks.drop("n_groups")))
        .join(few.drop("n_groups"), "mix_source")
        .withColumnRenamed("rank", "place")
        .withColumn("draw", F.col("place"))
    )
    # Whole blocks while they fit, rows of the block at each source's border, then
    # the same of the blocks behind it with what that leaves, until no row fits.
    level = blocks.withColumn("over", F.col("rest"))
    taken, filled = [], []
    while True:
        left = F.col("over") - (F.col("end") - F.col("words"))
        level = materialize(
            level.withColumn("whole", F.col("end") <= F.col("over"))
            .withColumn("left", left)
            .withColumn("partly", ~F.col("whole") & (F.col("left") > 0))
            .where("whole OR partly")
            .select("mix_source", "block", "place", "draw", "whole", "partly", "left")
        )
        some = materialize(_fill(rows, level.where("partly")))
        taken.append(level.select("mix_source", "block", "draw", "whole", "partly"))
        filled.append(some.select("mix_source", "block", "some"))
        border = level.where("partly").join(some, ["mix_source", "block"]).select(
            "mix_source", F.col("place").alias("border"), F.col("draw").alias("drawn"), "over"
        )
        behind = materialize(
            blocks.select("mix_source", "block", "group", "order", "words", "least", "place")
            .join(border, "mix_source")
            .where("place > border AND least <= over")
        )
        if behind.isEmpty():
            break
        level = _ahead(behind).withColumn("draw", F.col("drawn") + 1 + F.col("rank"))
    taken, filled = (reduce(DataFrame.union, parts) for parts in (taken, filled))
    placed = materialize(
        blocks.select("mix_source", "block", F.col("place").alias("rank"), "rounds", "n_blocks")
        .join(taken, ["mix_source", "block"], "left")
        .fillna(False, ["whole", "partly"])
    )
    extra = F.count_if(F.col("whole") | F.col("partly"))
    draws = placed.groupBy(F.col("mix_source").alias("source_key")).agg(
        (F.first("rounds") * F.first("n_blocks") + extra).alias("draws")
    )
    total = aims.agg(F.sum("target")).first()[0] or 0.0
    levels = max(1, math.ceil(math.log2(max(1.0, total / shard_words))))
    quotas = shard_quotas(draws, levels).withColumnRenamed("source_key", "mix_source")
    shard = lambda at: F.size(F.filter("ends", lambda e: e <= at))
    number = F.col("rounds") + (F.col("whole") | F.col("partly")).cast("long")
    plan = materialize(
        placed.join(filled, ["mix_source", "block"], "left")
        .join(materialize(quotas), "mix_source")
        .withColumn(
            "shards",
            F.when(number > 0, F.transform(
                F.sequence(F.lit(0).cast("long"), number - 1),
                lambda r: shard(
                    r * F.col("n_blocks") + F.when(r < F.col("rounds"), F.col("rank")).otherwise(F.col("draw"))
                ),
            )).otherwise(F.array().cast("array<int>")),
        )
        .select("mix_source", "block", "rounds", "partly", "some", "shards")
    )
    facts = aims.select(
        F.col("source_key").alias("mix_source"),
        F.col("words").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        "n_blocks",
    )
    chosen = ~F.col("partly") | F.array_contains("some", F.col("mix_key"))
    shards = F.when(F.coalesce(chosen, F.lit(False)), F.col("shards")).otherwise(
        F.slice("shards", F.lit(1), F.col("rounds").cast("int"))
    )
    return (
        sized.join(facts, "mix_source")
        .withColumn("mix_block", block)
        .join(plan.withColumnRenamed("block", "mix_block"), ["mix_source", "mix_block"])
        .withColumn("mix_shards", shards)
        .select(*docs.columns, "mix_size", "mix_source_size", "mix_target", "mix_shards", "mix_key")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows of ``docs``, each as often as it is taken, in shards.

    Adds mix_shard and mix_order; each shard lies in one partition, sorted by
    mix_order, which is its shuffle. A shard holds about ``shard_words`` words.
    Options and edge cases are those of ``plan_mix``.
    """
    planned = plan_mix(docs, **options)
    drawn = planned.select(
        *docs.columns, "mix_key", F.posexplode("mix_shards").alias("mix_round", "mix_shard")
    )
    order = F.xxhash64(F.lit(SEED), "mix_key", "mix_round")
    return (
        drawn.select(*docs.columns, "mix_shard", order.alias("mix_order"))
        .repartition("mix_shard")
        .sortWithinPartitions("mix_shard", "mix_order")
    )
