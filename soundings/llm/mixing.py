"""Mixing sources to target weights with a hypergeometric splitting tree, in DataFrame operations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from soundings.llm.common import staged, whole_text

_WORD = r"[^\x20\x09-\x0D]+"
_SOURCE = ["source_text", "source_none"]
#: Above this many numbers the table of blocks is no longer broadcast but joined by key.
_BROADCAST_BLOCKS = 1_000_000
#: About as many rows of a shard are shuffled together.
_ROWS_PER_SLICE = 8192


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most_repeats: int) -> DataFrame:
    """The words each source shall give: shares by weight, never over `most_repeats` its size.

    Sources are numbered by code point, null last, and take the weights in turn. What exceeds
    the limit of a source is shared among the others by weight: every target is the smaller of
    its limit and a common level times its weight.
    """
    sources = sizes.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))
    in_order = W.orderBy("source_none", "source_text")
    number = F.row_number().over(in_order) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int")
    )
    limit = (F.col("source_size") * most_repeats).cast("double")
    by_ratio = W.orderBy("ratio", "number")
    before = F.coalesce(
        F.sum("limit").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)
    )
    weight_left = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    everything = W.partitionBy(F.lit(1))
    level = F.min(F.when(F.col("level") <= F.col("ratio") * (1 + 1e-12), F.struct("place", "level")))
    return (
        sources.select("*", number.alias("number"), weight.alias("weight"), limit.alias("limit"))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("place", F.row_number().over(by_ratio))
        .withColumn("level", (F.col("total") - before) / weight_left)
        .withColumn("common", level.over(everything)["level"])
        .withColumn("target", F.least("limit", F.col("common") * F.col("weight")))
        .select(*_SOURCE, "number", "source_size", "target")
    )


def block_quotas(targets: DataFrame, blocks: int, most_repeats: int) -> DataFrame:
    """The number of blocks of each source and how many draws of them the mix takes."""
    n = F.least("source_size", F.lit(blocks)).cast("long")
    ratio = F.coalesce(F.col("target") * n / F.nullif("source_size", F.lit(0)), F.lit(0.0))
    quota = F.least(F.round(ratio).cast("long"), n * most_repeats)
    return targets.select("*", n.alias("blocks"), quota.alias("quota"))


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(number, shard, from_draw, to_draw): which draws of each source a shard gets.

    A node of the tree holds a count of draws per source, one row each. Half of the node's draws,
    chosen without replacement from all of them, go to one child, which makes the counts of a child
    multivariate hypergeometric and its total exact.
    """
    node = quotas.select("number", F.lit(0).cast("long").alias("shard"), "quota")
    for _ in range(_levels(shards)):
        node = staged(_halved(node, seed), "mix-node")
    upto = F.sum("quota").over(W.partitionBy("number").orderBy("shard"))
    return node.select(
        "number", "shard", (upto - F.col("quota")).alias("from_draw"), upto.alias("to_draw")
    )


def _levels(shards: int) -> int:
    """The levels of a tree with at least `shards` leaves."""
    return max(0, math.ceil(math.log2(shards)))


def _halved(node: DataFrame, seed: int) -> DataFrame:
    """(number, shard, quota) of the two children of every node.

    The draws of a node are put in random order and its first half chosen. Places are counted in
    two steps, within 4,096 ranges of the random number and over these, so no task orders a node.
    """
    one_by_one = node.filter("quota > 0").select(
        "number", "shard", F.explode(F.sequence(F.lit(1).cast("long"), "quota")).alias("draw")
    )
    dice = F.xxhash64(F.lit(seed), "shard", "number", "draw")
    thrown = one_by_one.withColumn("dice", dice).withColumn("range", F.shiftright("dice", 52))
    ranges = thrown.groupBy("shard", "range").agg(F.count("*").alias("here"))
    of_node = W.partitionBy("shard")
    before = F.sum("here").over(of_node.orderBy("range")) - F.col("here")
    ranges = ranges.select(
        "shard", "range", before.alias("before"), F.sum("here").over(of_node).alias("total")
    )
    within = W.partitionBy("shard", "range").orderBy("dice", "number", "draw")
    place = F.col("before") + F.row_number().over(within)
    first = thrown.join(ranges, ["shard", "range"]).select(
        "number", "shard", (place <= F.expr("total div 2")).cast("long").alias("first")
    )
    chosen = first.groupBy("number", "shard").agg(F.sum("first").alias("chosen"))
    children = node.join(chosen, ["number", "shard"], "left").select(
        "number", "shard", "quota", F.coalesce("chosen", F.lit(0)).cast("long").alias("chosen")
    )
    child = F.explode(
        F.array(
            F.struct((F.col("shard") * 2).alias("shard"), F.col("chosen").alias("quota")),
            F.struct(
                (F.col("shard") * 2 + 1).alias("shard"),
                (F.col("quota") - F.col("chosen")).alias("quota"),
            ),
        )
    )
    return children.select("number", child.alias("child")).select("number", "child.*")


def draws(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(number, block, epoch, shard): every draw of the mix.

    The blocks of a source are permuted anew in each epoch; draw t is the block at place
    t mod blocks of epoch t div blocks, so that a shard's blocks are disjoint from the others'.
    """
    split = split_quotas(quotas, shards, seed)
    some = quotas.filter("quota > 0")
    epochs = some.select(
        "number", "blocks", "quota",
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(quota - 1) div blocks"))).alias("epoch"),
    )
    blocks = epochs.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    )
    order = W.partitionBy("number", "epoch").orderBy(
        F.xxhash64(F.lit(seed), "number", "epoch", "block"), "block"
    )
    draw = F.col("epoch") * F.col("blocks") + F.row_number().over(order) - 1
    drawn = blocks.withColumn("draw", draw).filter("draw < quota")
    return (
        drawn.join(split, "number")
        .filter("draw >= from_draw and draw < to_draw")
        .select("number", "block", "epoch", "shard")
    )


def _on_tape(rows: DataFrame, quotas: DataFrame, total_rows: int) -> DataFrame:
    """Adds where a document starts on its source's tape, all its documents in permuted order.

    Prefix sums in two steps of about the square root of the rows each: within buckets of the
    permutation, then over the buckets.
    """
    rows = rows.withColumn("bucket", F.pmod("order", F.lit(max(1, math.isqrt(total_rows)))))
    keys = [*_SOURCE, "bucket"]
    inside = W.partitionBy(*keys).orderBy("order", "size").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(inside))
    buckets = rows.groupBy(*keys).agg(F.sum("size").alias("bucket_size"))
    over = W.partitionBy(*_SOURCE).orderBy("bucket")
    offsets = buckets.join(quotas, _SOURCE).select(
        *keys, "number", "blocks", "source_size", "target",
        (F.sum("bucket_size").over(over) - F.col("bucket_size")).alias("base"),
    )
    start = F.col("base") + F.col("upto") - F.col("size")
    return rows.join(staged(offsets, "mix-offsets"), keys).withColumn("start", start)


def _block_at(word: str) -> str:
    """The block holding a word of the tape: block b starts at word floor(b * size / blocks)."""
    return f"least(((({word}) + 1) * blocks - 1) div nullif(source_size, 0), blocks - 1)"


def _rows(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    text = whole_text()
    return docs.select(
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source_text"),
        F.col("source").isNull().alias("source_none"),
        word_count(text).alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", text).alias("order"),
        *more,
    )


def _checked(blocks: DataFrame, width: int = 1) -> DataFrame:
    """For the smaller side of a join: broadcast if its counted rows, of `width` numbers, are few."""
    return F.broadcast(blocks) if blocks.count() * width <= _BROADCAST_BLOCKS else blocks


def _tape(quotas: DataFrame, drawn: DataFrame, shards: int) -> DataFrame:
    """(number, block, first, times, before): each block's first word, and in arrays by shard how often
    the shard drew it and how many words of the blocks before it the shard takes."""
    every = quotas.filter("blocks > 0").select(
        "number", "blocks", "source_size",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
    )
    first = F.expr("(block * source_size) div blocks")
    words = F.expr("((block + 1) * source_size) div blocks") - first
    every = every.select("number", "block", first.alias("first"), words.alias("words"))
    in_shard = drawn.groupBy("number", "block", "shard").agg(F.count("*").alias("times"))
    every = every.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1))))
    every = every.join(in_shard, ["number", "block", "shard"], "left").fillna(0, ["times"])
    taken = F.col("times") * F.col("words")
    upto = F.sum(taken).over(W.partitionBy("number", "shard").orderBy("block")) - taken
    return (
        every.withColumn("before", upto)
        .groupBy("number", "block")
        .agg(
            F.first("first").alias("first"),
            F.array_sort(F.collect_list(F.struct("shard", "times", "before"))).alias("shards"),
        )
        .select("number", "block", "first", "shards.times", "shards.before")
    )


def mix_words(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    most_repeats: int = 3,
    blocks: int = 1024,
    shards: int = 16,
    seed: int = 17,
) -> DataFrame:
    """How many words of each document the mix takes, repeats counted.

    Every source's words, its documents in a permuted order, are cut into `blocks` equal blocks
    (one word each at least), so a block may begin or end inside a document. Quotas are whole
    numbers of blocks, off the target by half a block at most. The tree deals them to the shards, and
    each shard takes the words of the blocks it draws.

    Returns doc_id, size, source_size, target, taken and shard_taken: the words each shard takes, of
    which taken is the sum (no entries where the source has no words). Null texts have no words, null sources are
    one source, the last; null and repeated doc_ids and repeated rows are documents of their own.
    Where all texts are empty nothing is taken. An empty table gives no rows.
    """
    rows = staged(_rows(docs, seed, F.col("doc_id")), "mix-rows")
    quotas = staged(
        block_quotas(source_targets(rows, weights, most_repeats), blocks, most_repeats), "quotas"
    )
    shards = 2 ** _levels(shards)
    tape = staged(_tape(quotas, staged(draws(quotas, shards, seed), "draws"), shards), "tape")
    placed = _on_tape(rows, quotas, rows.count())
    for edge, word in (("left", "start"), ("right", "start + size")):
        at = tape.select(
            "number",
            F.col("block").alias(f"{edge}_block"),
            F.struct("first", "times", "before").alias(edge),
        )
        placed = placed.withColumn(f"{edge}_block", F.expr(_block_at(word))).join(
            _checked(at, shards), ["number", f"{edge}_block"], "left"
        )

    def upto(edge: str, word: str) -> str:
        return f"{edge}.before[i] + {edge}.times[i] * ({word} - {edge}.first)"

    of_shard = f"{upto('right', 'start + size')} - ({upto('left', 'start')})"
    in_shards = F.expr(f"transform(sequence(0, size(left.times) - 1), i -> {of_shard})")
    return placed.select(
        "doc_id", "size", "source_size", "target",
        F.coalesce(in_shards, F.array().cast("array<bigint>")).alias("shard_taken"),
    ).select(
        "doc_id", "size", "source_size", "target",
        F.aggregate("shard_taken", F.lit(0).cast("long"), lambda a, b: a + b).alias("taken"),
        "shard_taken",
    )


def mix_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    most_repeats: int = 3,
    blocks: int = 256,
    shards: int = 16,
    seed: int = 17,
) -> DataFrame:
    """The mix as rows: whole documents, one row for each time one is taken.

    As `mix_words`, but a document belongs to the block that holds its middle word, and is taken
    whole whenever its block is drawn. All columns of `docs` stay as they are; added are `mix_shard` and
    `mix_place`, with underscores in front where `docs` has such a name. The rows of a shard are brought
    together, in slices of its random places where it has many, and each slice is sorted by place. A source misses its target by about the size of the
    documents at block edges, which is much where it has few or very long ones. Null texts and
    sources count as in `mix_words`, repeated rows are documents of their own, and an empty table
    gives no rows.
    """
    sizes = docs.select(
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source_text"),
        F.col("source").isNull().alias("source_none"),
        word_count(whole_text()).alias("size"),
    )
    quotas = staged(
        block_quotas(source_targets(sizes, weights, most_repeats), blocks, most_repeats), "quotas"
    )
    plan = staged(draws(quotas, shards, seed), "draws")
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    total = docs.count()
    placed = _on_tape(_rows(docs, seed, row), quotas, total)
    placed = placed.withColumn("block", F.expr(_block_at("start + size div 2")))
    slices = max(1, math.ceil(total / (_ROWS_PER_SLICE * 2 ** _levels(shards))))
    place = F.xxhash64(F.lit(seed), "shard", "epoch", "order")
    shard, at = (_free_name(n, docs.columns) for n in ("mix_shard", "mix_place"))
    return (
        placed.join(_checked(plan), ["number", "block"])
        .withColumn("place", place)
        .repartition("shard", F.pmod("place", F.lit(slices)))
        .sortWithinPartitions("shard", F.pmod("place", F.lit(slices)), "place")
        .select(
            *[f"row.`{c}`" for c in docs.columns],
            F.col("shard").alias(shard),
            F.col("place").alias(at),
        )
    )


def _free_name(name: str, taken: list[str]) -> str:
    while name.lower() in {c.lower() for c in taken}:
        name = f"_{name}"
    return name
