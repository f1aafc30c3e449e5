"""Runs of repeated words found by longest common extensions in suffix trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundings.llm.common import whole_text

_FOUND = (
    "doc_id long, n_words long,"
    " runs array<struct<start: long, length: long, period: long>>, collapsed binary"
)


def suffix_tree(symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Ukkonen's tree of `symbols`, numbers over 0, with an end symbol 0 added.

    Its edges sorted by parent and symbol, as arrays (parent, symbol, child), and the depth of each
    node in symbols. Node 0 is the root; a leaf is the number -1 - i of the suffix that starts at i.
    """
    text = [*symbols, 0]
    n, base = len(text), max(text) + 1
    # An edge is known by its parent and first symbol; a node by where its edge starts and ends.
    edges: dict[int, int] = {}
    starts, ends, links = [0], [0], [0]
    leaf_starts: list[int] = []
    node, at, length = 0, 0, 0
    for i, symbol in enumerate(text):
        behind = 0
        suffix = len(leaf_starts)
        while suffix <= i:
            if not length:
                at = i
            key = node * base + text[at]
            child = edges.get(key)
            if child is None:
                edges[key] = -1 - suffix
                leaf_starts.append(i)
                suffix += 1
                if behind:
                    links[behind] = node
                    behind = 0
            else:
                if child >= 0 and length >= (size := ends[child] - starts[child]):
                    node, at, length = child, at + size, length - size
                    continue
                start = starts[child] if child >= 0 else leaf_starts[-1 - child]
                if text[start + length] == symbol:
                    length += 1
                    if behind:
                        links[behind] = node
                    break
                split = len(starts)
                starts.append(start)
                ends.append(start + length)
                links.append(0)
                edges[key] = split
                if child >= 0:
                    starts[child] = start + length
                else:
                    leaf_starts[-1 - child] = start + length
                edges[split * base + text[start + length]] = child
                edges[split * base + symbol] = -1 - suffix
                leaf_starts.append(i)
                suffix += 1
                if behind:
                    links[behind] = split
                behind = split
            if node:
                node = links[node]
            elif length:
                length -= 1
                at = suffix
    keys = np.fromiter(edges.keys(), np.int64, len(edges))
    children = np.fromiter(edges.values(), np.int64, len(edges))
    order = np.argsort(keys)
    parents, firsts, children = keys[order] // base, keys[order] % base, children[order]
    depth = [0] * len(starts)
    inner = children >= 0
    above = dict(zip(children[inner].tolist(), parents[inner].tolist(), strict=True))
    for child in range(1, len(starts)):
        path, top = [], child
        while top and not depth[top]:
            path.append(top)
            top = above[top]
        total = depth[top]
        for top in reversed(path):
            total += ends[top] - starts[top]
            depth[top] = total
    return parents, firsts, children, depth


def _tour(
    tree: tuple[np.ndarray, np.ndarray, np.ndarray, list[int]], downwards: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Leaves in the order of an Euler tour, and the depth of the shallowest node between two.

    Children are visited by symbol, or with `downwards` by falling symbol; the end comes first.
    """
    parents, firsts, children, depth = tree
    rank = np.where(firsts, -firsts, -firsts.max() - 1) if downwards else firsts
    order = np.lexsort((-rank, parents))  # the last pushed is visited first
    parents, children = parents[order], children[order].tolist()
    bounds = np.searchsorted(parents, np.arange(len(depth) + 1)).tolist()
    leaves, shallow = [], []
    stack = children[bounds[0] : bounds[1]]
    above = [0] * len(stack)
    low = 0
    while stack:
        child = stack.pop()
        low = min(low, above.pop())
        if child < 0:
            leaves.append(-1 - child)
            shallow.append(low)
            low = len(depth) + len(children)
            continue
        own = children[bounds[child] : bounds[child + 1]]
        stack += own
        above += repeat(depth[child], len(own))
    return np.array(leaves), np.array(shallow)


class Extensions:
    """How far the suffixes at two places agree: the depth of their leaves' lowest common ancestor.

    A sparse table of minima over the Euler tour answers any number of pairs, each in constant time.
    """

    def __init__(self, symbols: list[int]) -> None:
        self.tree = suffix_tree(symbols)
        leaves, shallow = _tour(self.tree)
        self.place = np.empty(len(leaves), np.int64)
        self.place[leaves] = np.arange(len(leaves))
        self._minima = [shallow.astype(np.int32)]
        step = 1
        while 2 * step <= len(leaves):
            last = self._minima[-1]
            self._minima.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def __call__(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        a, b = self.place[first], self.place[second]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp(high - low + 1)[1] - 1
        found = np.empty(len(low), np.int64)
        for at in np.unique(level):
            own = level == at
            table = self._minima[at]
            found[own] = np.minimum(table[low[own]], table[high[own] - (1 << int(at)) + 1])
        return found


def _next_smaller(place: np.ndarray) -> np.ndarray:
    """For each suffix the next one that sorts before it; up to there reaches its Lyndon word."""
    found, open_ = [0] * len(place), []
    for i, p in enumerate(place.tolist()):
        while open_ and open_[-1][1] > p:
            found[open_.pop()[0]] = i
        open_.append((i, p))
    return np.array(found[:-1])  # the end sorts before all and has none


def runs_of(symbols: list[int], least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least `least` symbols and `times` periods.

    The longest Lyndon word at each place, by either order of the symbols, is a candidate for the
    root of a run. It is extended to the right as far as the suffixes a period apart agree, and to
    the left as far as those of the reversed text do.
    """
    n = len(symbols)
    if n < least:
        return []
    right, left = Extensions(symbols), Extensions(symbols[::-1])
    downwards = np.empty(n + 1, np.int64)
    downwards[_tour(right.tree, downwards=True)[0]] = np.arange(n + 1)
    starts = np.tile(np.arange(n), 2)
    ends = np.concatenate([_next_smaller(right.place), _next_smaller(downwards)])
    # The end symbol stands after the last word of either text.
    after = right(starts, ends)
    before = left(n - starts, n - ends)
    period = ends - starts
    length = before + period + after
    enough = length >= np.maximum(least, times * period)
    found = zip((starts - before)[enough], length[enough], period[enough], strict=True)
    return sorted({(int(s), int(m), int(p)) for s, m, p in found})


def _repeating(symbols: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Stretches outside of which no run can reach, most often none at all.

    A run holds each of its words `times` times, so a word that a stretch has less often splits it.
    """
    found, open_ = [], [(0, len(symbols))]
    while open_:
        start, end = open_.pop()
        if end - start < least:
            continue
        _, inverse, counts = np.unique(symbols[start:end], return_inverse=True, return_counts=True)
        rare = np.flatnonzero(counts[inverse] < times)
        if not len(rare):
            found.append((start, end))
            continue
        cuts = np.concatenate([[-1], rare, [end - start]])
        for i in np.flatnonzero(np.diff(cuts) > least):
            open_.append((start + int(cuts[i]) + 1, start + int(cuts[i + 1])))
    return sorted(found)


def word_runs(words: list[bytes], least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """The runs of a list of words by start, then period."""
    if len(words) < least:
        return []
    # Two words with one hash make a stretch longer at worst; trees are built from true names.
    hashes = np.fromiter(map(hash, words), np.int64, len(words))
    found = []
    for start, end in _repeating(hashes, least, times):
        names: dict[bytes, int] = {}
        own = [names.setdefault(w, len(names) + 1) for w in words[start:end]]
        found += [(start + s, m, p) for s, m, p in runs_of(own, least, times)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those a run has after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return b" ".join([w for w, k in zip(words, kept.tolist(), strict=True) if k])


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row: its runs of words and the text without them.

    A word is a longest stretch without ASCII white space. A run is a longest stretch of words in
    which each equals the one `period`, the smallest such number, before it; listed are those of
    at least `least` words and `times` periods, by start, then period. `collapsed` has the words
    joined by one space, without those a run holds after its first period.

    Rows do not depend on each other: a task holds one batch, and of a text its words and the trees
    of one stretch whose words all occur `times` times. A null or empty text has no words, no runs
    and an empty text. Repeated rows and null doc_ids give a row each, an empty table none, and
    other columns are not read.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, texts = [], [], []
            for text in batch.column("text"):
                words = text.as_py().split()
                found = word_runs(words, least, times)
                counts.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                texts.append(collapsed(words, found))
            triple = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(runs, pa.list_(triple)),
                    pa.array(texts, pa.binary()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text")
    )
    found = texts.mapInArrow(find, _FOUND)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where a tenth of the rows, by a hash of doc_id, end in one repeated passage.

    With h the CRC-32 of doc_id as decimal text (null: empty), g = h // 10 and n words, rows with
    h % 10 = 0 have from word a = g % n on the words a to a + p - 1 over and over, where
    p = 1 + (n - a) // (3 + g % 8). Their words are joined by one space.
    """
    doc_id = F.col("doc_id").cast("long")
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(whole_text(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = (
        docs.select(doc_id.alias("doc_id"), whole_text().alias("text"), h.alias("h"))
        .withColumn("words", F.when(F.col("h") % 10 == 0, words))
        .withColumn("n", F.size("words"))
        .selectExpr("*", "h DIV 10 AS g", "IF(n > 0, (h DIV 10) % n, 0) AS a")
        .selectExpr("*", "1 + (n - a) DIV (3 + g % 8) AS p")
    )
    repeated = F.expr(
        "array_join(transform(words, (w, i) -> IF(i < a, w, get(words, int(a + (i - a) % p)))), ' ')"
    )
    return chosen.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """One row per row of :func:`periodic_runs`: its longest run, and hashes of all runs and of the text.

    Of runs of one length the one with the smallest start, then period, counts.
    """
    longest: Column = F.expr(
        "array_min(transform(runs, r -> struct(-r.length AS m, r.start AS s, r.period AS p)))"
    )
    lines = F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))")
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.m")).alias("length"),
        F.col("best.p").alias("period"),
        F.expr("(-1000 * best.m) DIV best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
