"""Exact duplicates by deterministic block naming, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundings.llm.common import keep_rows, staged, whole_text


def exact_groups(
    docs: DataFrame, block_bytes: int = 2048, handle_bits: int = 128
) -> DataFrame:
    """Every row of `docs` with the group of texts it is identical to.

    Texts are cut into blocks of `block_bytes`. The distinct blocks are sorted and numbered;
    adjacent numbers are then named pairwise, level by level, until a text has one name. Two
    texts have the same level and name exactly if they are byte for byte the same.

    Blocks travel with their content once, to be told apart and numbered. Elsewhere a handle of
    `handle_bits` stands for a block; that no two blocks share one is checked, and otherwise
    another seed is taken.

    Returns doc_id, keep_id (largest doc_id of the group), group_size, kept, text_sha256 and
    row_key. A null text counts as empty. Null doc_ids sort below all others. Of rows with the
    same doc_id and text one is kept. An empty table gives no rows.
    """
    for seed in range(64):
        rows = staged(_with_handles(docs, block_bytes, handle_bits, seed), "exact-rows")
        names = staged(_block_names(docs, block_bytes, handle_bits, seed), "block-names")
        shared = names.groupBy("h1", "h2").count().filter("count > 1")
        if shared.isEmpty():
            break
    else:
        raise ValueError("handle_bits is too small to tell the blocks apart")
    named = _identities(rows, names)
    rows = rows.select("row", "doc_id", "text_sha256").join(named, "row")
    best = F.max(F.struct("doc_id", "row")).alias("best")
    groups = rows.groupBy("level", "name").agg(best, F.count("*").alias("group_size"))
    return rows.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group of identical texts, the one with the largest doc_id."""
    groups = staged(exact_groups(docs), "exact-groups")
    key = F.substring(F.unhex("text_sha256"), 1, 16).alias("key")
    chosen = groups.groupBy("doc_id", key).agg(
        F.max("kept").alias("kept"), F.count("*").alias("copies")
    )
    return keep_rows(docs, staged(chosen.filter("kept").drop("kept"), "exact-kept"))


def _blocks(text: Column, block_bytes: int) -> Column:
    """The bytes of `text` in blocks; an empty text is one empty block."""
    starts = lambda whole: F.sequence(
        F.lit(1), F.greatest(F.octet_length(whole), F.lit(1)), F.lit(block_bytes)
    )
    cut = lambda whole: F.transform(
        starts(whole), lambda at: F.substring(whole, at, F.lit(block_bytes))
    )
    return F.flatten(F.transform(F.array(text.cast("binary")), cut))


def _handle(block: Column, bits: int, seed: int) -> list[Column]:
    low, high = (F.xxhash64(F.lit(seed * 2 + i), block) for i in range(2))
    if bits < 128:
        low, high = F.pmod(low, F.lit(1 << min(bits, 62))), F.lit(0).cast("long")
    return [low.alias("h1"), high.alias("h2")]


def _with_handles(docs: DataFrame, block_bytes: int, bits: int, seed: int) -> DataFrame:
    text = whole_text()
    handles = F.transform(
        _blocks(text, block_bytes), lambda b: F.struct(*_handle(b, bits, seed))
    )
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2(text, 256).alias("text_sha256"),
        handles.alias("handles"),
    )


def _block_names(docs: DataFrame, block_bytes: int, bits: int, seed: int) -> DataFrame:
    blocks = docs.select(F.explode(_blocks(whole_text(), block_bytes)).alias("block"))
    handle = _handle(F.col("block"), bits, seed)
    return _numbered(blocks.select(*handle, "block"), ["h1", "h2", "block"]).drop("block")


def _numbered(keys: DataFrame, by: list[str]) -> DataFrame:
    """Distinct keys, sorted within their partitions, with a number each."""
    distinct = keys.groupBy(*by).agg(F.lit(1).alias("one")).drop("one")
    return distinct.sortWithinPartitions(*by).withColumn(
        "name", F.monotonically_increasing_id()
    )


def _identities(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(row, level, name) of every row."""
    blocks = rows.select(
        "row", F.size("handles").alias("blocks"), F.posexplode("handles").alias("at", "h")
    ).select("row", "blocks", "at", "h.h1", "h.h2")
    longest = rows.agg(F.max(F.size("handles"))).first()[0] or 1
    current = blocks.join(names, ["h1", "h2"]).select("row", "blocks", "at", "name")
    found, level = None, 0
    while True:
        current = staged(current, "named")
        ended = current.filter(F.col("blocks") <= (1 << level)).select(
            "row", F.lit(level).alias("level"), "name"
        )
        found = ended if found is None else found.union(ended)
        if longest <= 1 << level:
            return found
        pairs = (
            current.filter(F.col("blocks") > (1 << level))
            .groupBy("row", "blocks", F.floor(F.col("at") / 2).alias("at"))
            .agg(
                F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(
                    F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1)
                ).alias("right"),
            )
        )
        names = staged(_numbered(pairs.select("left", "right"), ["left", "right"]), "names")
        current = pairs.join(names, ["left", "right"]).select("row", "blocks", "at", "name")
        level += 1
