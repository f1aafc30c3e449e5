"""Near duplicates by Jaccard similarity of word n-grams, with MinHash bands for candidates."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundings.llm.common import components, keep_rows, staged, text_key, whole_text

_BLOCK = 512
_WORDS_REMEMBERED = 500_000


def bands_and_rows(threshold: float, recall: float, most: int = 160) -> tuple[int, int]:
    """The banding with the most rows a band that finds a pair at `threshold` with `recall`.

    A pair at the threshold shares a band of r rows with probability threshold ** r, so b bands
    find it with 1 - (1 - threshold ** r) ** b. More rows mean fewer chance candidates; at most
    `most` hashes are computed.
    """
    best = (most, 1)
    for rows in range(1, most + 1):
        if threshold**rows < 1e-9:
            break
        miss = math.log(1 - threshold**rows) if threshold < 1 else -math.inf
        bands = max(1, math.ceil(math.log(1 - recall) / miss))
        if bands * rows <= most:
            best = (bands, rows)
    return best


class _WordHashes(dict):
    """Stable 64-bit hashes of words, remembered up to a fixed number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _WORDS_REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def shingles(text: str, n: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit values of the n-grams of words; a shorter text is one n-gram."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = _mixed(total + values[k : k + len(total)])
    return np.unique(total)


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, key of the text, and its band values; texts without words have none."""
    rng = np.random.default_rng(20240229)
    odd = rng.integers(0, 2**63, (bands * rows, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 2**63, (bands * rows, 1), dtype=np.uint64)
    salt = rng.integers(0, 2**63, bands, dtype=np.uint64)

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            found = []
            for text in batch["text"]:
                grams = shingles(text, n, hashes)
                if not len(grams):
                    found.append(np.zeros(0, np.int64))
                    continue
                least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(grams), 2048):
                    part = grams[at : at + 2048]
                    np.minimum(least, (part * odd + plus).min(axis=1), out=least)
                value = salt.copy()
                for row in least.reshape(bands, rows).T:
                    value = _mixed(value + row)
                found.append(value.view(np.int64))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "key": batch["key"], "bands": found})

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key(whole_text()).alias("key"),
        whole_text().alias("text"),
    )
    return texts.mapInPandas(signed, "doc_id long, key binary, bands array<long>")


def ngram_links(
    docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.9999
) -> DataFrame:
    """Every row of `docs` with its class of identical texts, its links and its group.

    Two texts are linked if the Jaccard similarity of their sets of word n-grams is at least
    `threshold`. Candidates share one of the bands chosen by `bands_and_rows`; each band names
    one leader, so no list of pairs is made. Candidates reach each other through leaders, and
    all pairs of texts that do are compared on their whole sets, in blocks of bounded size that
    return counts and a spanning forest.

    Returns doc_id, class_id (smallest doc_id with the same text), n_links (other rows linked,
    copies included), component_id (smallest doc_id reachable by links), kept (one row of each
    component, with that id), text_key and row. A null text is empty; a text without words links
    with nothing, its copies included. Null doc_ids count as larger than all others. Repeated
    rows are copies of each other. An empty table gives no rows.
    """
    bands, rows = bands_and_rows(threshold, recall)
    signed = signatures(docs, n, bands, rows).withColumn(
        "row", F.monotonically_increasing_id()
    )
    signed = staged(signed, "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    classes = staged(
        signed.groupBy("key").agg(
            first.alias("first"),
            F.count("*").alias("copies"),
            F.max(F.size("bands") > 0).alias("worded"),
        ),
        "classes",
    )
    groups = staged(_candidate_groups(signed), "candidates")
    links = staged(_verified(docs, classes, groups, threshold, n), "links")
    roots = components(
        links.select(F.explode("tied").alias("a"), F.col("key").alias("b"))
    )
    counted = links.groupBy("key").agg(F.sum("links").alias("links"))
    classes = (
        classes.join(counted, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .select(
            "key",
            "first",
            F.coalesce("root", "key").alias("root"),
            (
                F.coalesce("links", F.lit(0))
                + F.when(F.col("worded"), F.col("copies") - 1).otherwise(0)
            ).alias("n_links"),
            "worded",
        )
    )
    classes = staged(classes, "linked-classes")
    least = classes.groupBy("root").agg(F.min("first").alias("least"))
    classes = classes.join(least, "root")
    found = signed.select("doc_id", "key", "row").join(classes, "key")
    alone = ~F.col("worded")
    own = F.col("doc_id")
    return found.select(
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "n_links",
        F.when(alone, own).otherwise(F.col("least.doc_id")).alias("component_id"),
        (alone | (F.col("row") == F.col("least.row"))).alias("kept"),
        F.col("key").alias("text_key"),
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group of near duplicates, the one with the smallest doc_id."""
    links = staged(ngram_links(docs), "near-links")
    chosen = links.groupBy("doc_id", F.col("text_key").alias("key")).agg(
        F.sum(F.col("kept").cast("long")).alias("copies_kept"), F.count("*").alias("copies")
    )
    chosen = chosen.filter("copies_kept > 0").select(
        "doc_id",
        "key",
        F.when(F.col("copies_kept") == F.col("copies"), 1)
        .otherwise(F.col("copies"))
        .alias("copies"),
    )
    return keep_rows(docs, staged(chosen, "near-kept"))


def _candidate_groups(signed: DataFrame) -> DataFrame:
    """(key, root, size): texts that share bands, directly or through others."""
    banded = signed.select(F.explode("bands").alias("band"), "key")
    leaders = (
        banded.groupBy("band")
        .agg(F.min("key").alias("leader"), F.max("key").alias("last"))
        .filter("leader <> last")
        .drop("last")
    )
    edges = (
        banded.join(leaders, "band")
        .filter("key <> leader")
        .select(F.col("key").alias("a"), F.col("leader").alias("b"))
    )
    roots = components(edges)
    roots = roots.withColumnRenamed("node", "key")
    return roots.join(roots.groupBy("root").agg(F.count("*").alias("size")), "root")


def _verified(
    docs: DataFrame, classes: DataFrame, groups: DataFrame, threshold: float, n: int
) -> DataFrame:
    """(key, links, tied): links of a text found in one task, and a text it is tied to."""
    wanted = groups.join(classes.select("key", "copies"), "key")
    texts = (
        docs.select(text_key(whole_text()).alias("key"), whole_text().alias("text"))
        .join(wanted, "key")
        .dropDuplicates(["key"])
    )
    small = F.col("size") <= _BLOCK
    held = groups.filter(small).count()
    bins = max(1, math.ceil(held / _BLOCK))
    blocks = F.ceil(F.col("size") / _BLOCK)
    block = F.pmod(F.xxhash64(F.lit(1), "key"), blocks)
    dealt = texts.withColumn("block", block).withColumn(
        "pair",
        F.explode(
            F.when(small, F.array(F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))))
            .otherwise(
                F.transform(
                    F.sequence(F.lit(0).cast("long"), blocks - 1),
                    lambda other: F.struct(
                        F.least("block", other).alias("x"),
                        F.greatest("block", other).alias("y"),
                    ),
                )
            )
        ),
    )
    task = F.when(
        small, F.concat(F.lit("s"), F.pmod(F.xxhash64("root"), F.lit(bins)).cast("string"))
    ).otherwise(F.concat_ws(".", F.hex("root"), "pair.x", "pair.y"))
    dealt = dealt.select(
        task.alias("task"), "root", "key", "text", "copies", "block",
        F.when(small, 0).otherwise(F.col("pair.x")).alias("x"),
        F.when(small, 0).otherwise(F.col("pair.y")).alias("y"),
    )

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        hashes = _WordHashes()
        out: list[tuple[bytes, int, list[bytes]]] = []
        for _, group in rows.groupby("root", sort=False):
            group = group.sort_values("key", kind="stable").reset_index(drop=True)
            out += _links_of(group, [shingles(t, n, hashes) for t in group["text"]], threshold)
        return pd.DataFrame(out, columns=["key", "links", "tied"])

    return dealt.groupBy("task").applyInPandas(
        compared, "key binary, links long, tied array<binary>"
    )


def _links_of(
    group: pd.DataFrame, sets: list[np.ndarray], threshold: float
) -> list[tuple[bytes, int, list[bytes]]]:
    """Compares the texts of two blocks with each other, or of one block among themselves."""
    size = np.array([len(s) for s in sets])
    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    marked = np.zeros(codes.max() + 1 if len(codes) else 1, np.int64)
    copies = group["copies"].to_numpy()
    block = group["block"].to_numpy()
    across = group["x"].iloc[0] != group["y"].iloc[0]
    links = np.zeros(len(sets), np.int64)
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(sets) - 1):
        mine = codes[starts[i] : starts[i] + size[i]]
        marked[mine] = 1
        common = np.add.reduceat(marked[codes[starts[i + 1] :]], starts[i + 1 :] - starts[i + 1])
        marked[mine] = 0
        similar = common / (size[i] + size[i + 1 :] - common) >= threshold - 1e-12
        if across:
            similar &= block[i + 1 :] != block[i]
        for j in np.flatnonzero(similar) + i + 1:
            links[i] += copies[j]
            links[j] += copies[i]
            x, y = sorted((root(i), root(j)))
            parent[y] = x
    keys = list(group["key"])
    return [
        (keys[i], int(links[i]), [keys[root(i)]] if root(i) != i else [])
        for i in range(len(sets))
        if links[i]
    ]
