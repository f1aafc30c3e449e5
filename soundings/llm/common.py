"""What the corpus operators share: staged tables, row selection, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundings.sources.workspace import shared_dir

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: fixed values, short lineage."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    before = spark.conf.get(_CLEAN_UP, "false")
    # What was shuffled for the table is of no use once the table is there.
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(text: Column) -> Column:
    """The first 128 bits of the SHA-256 of a text, as 16 bytes."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def keep_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of `docs` whose (doc_id, text) is in `chosen` (doc_id, key, copies), one row each.

    `copies` counts the rows of `docs` equal in doc_id and text. Where it is over one, one of
    those rows is kept. All columns of `docs` stay as they are, whatever they are called.
    """
    rows = docs.select(
        F.col("doc_id").alias("_id"),
        text_key(whole_text()).alias("_key"),
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
    )
    picks = chosen.select(
        F.col("doc_id").alias("_pick"), F.col("key").alias("_pick_key"), "copies"
    )
    same = F.col("_id").eqNullSafe(F.col("_pick")) & (F.col("_key") == F.col("_pick_key"))
    found = rows.join(picks, same)
    once = found.filter("copies = 1").select("_row.*")
    if chosen.filter("copies > 1").isEmpty():
        return once
    repeated = found.filter("copies > 1").dropDuplicates(["_id", "_key"])
    return once.unionByName(repeated.select("_row.*"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected `edges` (a, b): root is its smallest node.

    Large-star and small-star steps in turn until nothing changes. A step takes a minimum per
    node, which Spark aggregates partially, and a join whose skewed keys adaptive execution
    splits; no neighbourhood is ever collected.
    """
    edges = staged(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    while True:
        print_ = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if before == tuple(print_):
            break
        before = tuple(print_)
        both = edges.select("a", "b").union(edges.select("b", "a"))
        edges = staged(_star(_star(both, large=True), large=False), "edges")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.union(edges.select("b", "b").distinct())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (or smaller) neighbours are tied to the smallest node it knows."""
    if not large:
        edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    joined = edges.join(least, "a")
    if large:
        tied = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        tied = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        tied = tied.union(least.select("a", F.col("m").alias("b")))
    return tied.filter("a <> b").distinct()
