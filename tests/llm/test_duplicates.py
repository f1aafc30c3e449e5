"""Duplicate operators against brute force."""

from __future__ import annotations

import hashlib
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from soundings.llm import graph_dedup, line_dedup
from soundings.llm.common import components
from soundings.llm.exact_dedup import drop_exact_copies, exact_groups
from soundings.llm.graph_dedup import SmallWorld, _audited, _unit, embedding_links
from soundings.llm.line_dedup import drop_similar_lines, similar_lines
from soundings.llm.ngram_join import bands_and_rows, drop_near_copies, ngram_links
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def _key(value):
    return (value is None, value or 0)


def _roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def _grams(text):
    words = (text or "").split()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def test_components(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(50, 60), (60, 70), (90, 80), (5, 5)]
    found = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    expected = _roots({n for p in pairs if p[0] != p[1] for n in p}, pairs)
    assert {r.node: r.root for r in found} == expected
    assert len(found) == len(expected)


@pytest.mark.parametrize("block", [7, 2048])
def test_exact_groups(odd_docs, block):
    found = exact_groups(odd_docs, block_bytes=block).collect()
    groups = defaultdict(list)
    for doc_id, text, _ in ODD:
        groups[text or ""].append(doc_id)
    assert len(found) == len(ODD)
    expected = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            expected[i, max(known, default=None), len(ids), sha] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == expected
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_blocks_that_share_a_handle_get_another_seed(odd_docs):
    few = odd_docs.select("doc_id", "text").limit(9)
    assert exact_groups(few, 64, handle_bits=10).filter("kept").count() == 4
    with pytest.raises(ValueError, match="handle_bits"):
        exact_groups(few, 4, handle_bits=1)


def test_dropping_copies_keeps_columns(odd_docs, no_docs):
    for drop, groups in ((drop_exact_copies, 7), (drop_near_copies, 8)):
        kept = drop(odd_docs)
        assert kept.schema == odd_docs.schema
        assert kept.count() == groups
        assert drop(no_docs).collect() == []


def test_banding_reaches_its_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = bands_and_rows(threshold, 0.9999)
        assert 1 - (1 - threshold**rows) ** bands >= 0.9999
        assert bands * rows <= 160


def test_ngram_links(docs):
    rows = docs.select("doc_id", "text").collect()
    grams = {r.doc_id: _grams(r.text) for r in rows}
    pairs = [
        (a, b)
        for a in grams
        for b in grams
        if a < b and grams[a] and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])
    ]
    count, root = Counter(n for p in pairs for n in p), _roots(grams, pairs)
    found = {r.doc_id: r for r in ngram_links(docs).collect()}
    assert len(pairs) > 3
    for i in grams:
        assert (found[i].n_links, found[i].component_id) == (count[i], root[i])
        assert found[i].kept == (root[i] == i)


def test_ngram_links_of_odd_rows(odd_docs):
    found = ngram_links(odd_docs).collect()
    assert len(found) == len(ODD)
    near = [r for r in found if r.n_links]
    assert sorted((_key(r.doc_id), r.n_links, r.class_id, r.component_id) for r in near) == sorted(
        (_key(i), 4, 3 if i == 3 else 1, 1) for i in (1, 2, 2, 3, None)
    )
    assert sum(r.kept for r in near) == 1
    assert all(r.kept for r in found if not r.n_links)


def test_similar_lines(docs, odd_docs, no_docs):
    sets, expected = [], {}
    rows = docs.select("doc_id", "text").collect()
    for doc_id, text in sorted(map(tuple, rows)):
        expected[doc_id] = []
        for at, line in enumerate((text or "").split("\n")):
            own = frozenset(w for w in line.split(" ") if w)
            if own and any(len(own & s) >= 0.8 * len(own | s) for s in sets):
                expected[doc_id].append(at)
            if own:
                sets.append(own)
    assert {r.doc_id: r.removed for r in similar_lines(docs).collect()} == expected
    told = similar_lines(odd_docs).collect()
    assert [r.removed for r in sorted(told, key=lambda r: r["rank"])[:3]] == [[], [0], [0]]
    cleaned = drop_similar_lines(odd_docs)
    assert cleaned.columns == odd_docs.columns
    assert cleaned.count() == len(ODD)
    assert sorted(r.text for r in cleaned.filter("doc_id = 2").collect()) == ["", ""]
    assert cleaned.filter("doc_id = 9 and source = 'c'").first().text == "idiot\n\n"
    assert drop_similar_lines(no_docs).collect() == []


def test_lines_meet_once_however_much_they_share(spark):
    shared = " ".join(f"w{k}" for k in range(30))
    rows = [(i, f"{shared} own{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = line_dedup._in_order(docs).localCheckpoint()
    classes = line_dedup._classes(docs, lines, 0.8, line_dedup._rarity(docs))
    classes = classes.withColumn("open", F.lit(True)).localCheckpoint()
    rounds = range(line_dedup._ROUNDS)
    met = [r for k in rounds for r in line_dedup._with_all(classes, k, 0.8).collect()]
    assert len({tuple(r) for r in met}) == 40 * 39 // 2
    # A row per shared word of the prefix would be six times as many.
    assert len(met) == 40 * 39 // 2


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_lines_of_other_lengths(spark, monkeypatch, few):
    """Shorter and longer lines, earlier and later, on both sides of 64 words; with and without broadcasts."""
    monkeypatch.setattr(line_dedup, "_BROADCAST_LINES", few)
    words = [f"w{k}" for k in range(90)]
    cut = [words[:n] for n in (1, 2, 4, 5, 6, 9, 50, 62, 64, 65, 66, 79, 81, 90)]
    cut += [words[:k] + words[k + 4 :] for k in (0, 30, 60)]
    for order in (cut, cut[::-1]):
        expected = [
            any(len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b)) for b in order[:i])
            for i, a in enumerate(order)
        ]
        rows = [(i, " ".join(line)) for i, line in enumerate(order)]
        told = similar_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r.doc_id: bool(r.removed) for r in told} == dict(enumerate(expected))


def test_embedding_links(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    vectors = np.repeat(centres, 20, axis=0) + rng.normal(0, 0.12, (800, 16))
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None], [float("inf")] * 16, [1.0, 2.0]]
    rows += [(1000 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(2000, rows[5][1], 0), (None, rows[5][1], 0), (2000, rows[5][1], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = embedding_links(table, shards=3, block=200)
    assert found.count() == len(rows)
    got = {r.vec_id: r for r in found.filter("vec_id < 800").collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    pairs = np.argwhere(np.triu(near, 1))
    root = _roots(range(800), pairs.tolist())
    count = near.sum(1) - 1 + 3 * near[:, 5]
    reached = sum(min(got[i].n_links, count[i]) for i in range(800)) / count.sum()
    assert reached >= 0.99
    assert all(got[i].n_links <= count[i] for i in range(800))
    assert np.mean([got[i].component_id == root[i] for i in range(800)]) >= 0.99
    lone = found.filter("vec_id between 1000 and 1999").collect()
    assert all(r.n_links == 0 and r.kept and r.component_id == r.vec_id for r in lone)
    assert embedding_links(table.limit(0)).collect() == []


def test_links_of_large_and_small_numbers(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i, size in enumerate((1e200, 1e-200, 1e308, 5e-300, 1.0)):
        vector = rng.uniform(0.5, 1, 16) * rng.choice([-1, 1], 16)
        rows += [(2 * i, (vector * size).tolist()), (2 * i + 1, (vector * size / 3).tolist())]
    found = embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {r.vec_id: (r.n_links, r.component_id) for r in found.collect()} == {
        i: (1, i - i % 2) for i in range(10)
    }


def test_audit_counts_links_to_others_only():
    """A search that finds nothing but the query itself has to widen its beam."""
    rng = np.random.default_rng(9)
    points = _unit(np.repeat(rng.normal(size=(60, 16)), 5, axis=0) + rng.normal(0, 0.1, (300, 16)))
    graph, own = SmallWorld(points), np.arange(300)
    asked, reached = _audited(graph, points, own, 0.9, 2, 64, 0.99)
    assert not (asked == reached).any()
    true = points @ points.T >= 0.9
    assert len(asked) >= 0.98 * (true.sum() - 300) > 0


def test_ids_forgotten_by_a_search_are_not_found_twice(monkeypatch):
    points = _unit(np.random.default_rng(2).normal(size=(900, 12)))
    graph = SmallWorld(points)
    wide, _ = graph.search(points[:50], 48)
    monkeypatch.setattr(graph_dedup, "_SLOTS", 7)
    ids, _ = graph.search(points[:50], 48)
    assert [sorted(r) for r in ids.tolist()] == [sorted(r) for r in wide.tolist()]
    assert all(len(set(r)) == 48 for r in ids.tolist())


def test_graph_recall():
    points = _unit(np.random.default_rng(2).normal(size=(1500, 24)))
    graph = SmallWorld(points)
    ids, _ = graph.search(points[:200], 64)
    true = np.argsort(-(points[:200] @ points.T), axis=1)[:, :10]
    assert np.mean([len(set(i) & set(t)) for i, t in zip(ids, true, strict=True)]) >= 9


def test_a_search_remembers_in_short_numbers_and_graphs_are_restored_whole():
    vectors = np.random.default_rng(1).normal(size=(6000, 8))
    rows = pd.DataFrame({"width": 8, "shard": 0, "node": range(6000), "copies": 1, "vector": list(vectors)})
    points = graph_dedup._unit(vectors)
    built = graph_dedup._built(rows)
    graph = graph_dedup._restored(built, points)
    whole = graph_dedup.SmallWorld(points)
    assert len(graph.layers) == len(whole.layers) > 1
    assert all((a == b).all() for a, b in zip(graph.layers, whole.layers, strict=True))
    queries = points[:512]
    tracemalloc.start()
    ids, _ = graph.search(queries, 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (ids == np.arange(512)[:, None]).any(1).mean() > 0.99
    assert peak < 4 * 512 * 6000  # a number of 32 bits for each query and point would take that alone
