from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from soundings.llm import queries
from soundings.llm.periodic_runs import (
    periodic_runs,
    run_digest,
    runs_of,
    suffix_tree,
    with_repeated_tails,
    word_runs,
)

_WORD = re.compile("[^\x20\x09-\x0d]+")


def _brute(words, least=6, times=4):
    names = np.unique(np.array(words, object).astype(str), return_inverse=True)[1] if words else np.array([])
    found = []
    for q in range(1, len(words) // times + 1):
        same = np.concatenate([[False], names[:-q] == names[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            length, own = j - i + q, names[i : j + q]
            if length >= max(least, times * q):
                shorter = any((own[r:] == own[:-r]).all() for r in range(1, q))
                found += [] if shorter else [(i, length, q)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def _words(rng):
    n, letters = rng.randrange(70), "abcdefgh"[: rng.choice([1, 2, 3, 5])]
    words = [rng.choice(letters).encode() for _ in range(n)]
    if n and rng.random() < 0.5:
        a, p = rng.randrange(n), rng.randrange(1, 9)
        words[a:] = [words[a + (i - a) % p] if a + p <= n else words[i] for i in range(a, n)]
    return words


def test_runs_by_brute_force():
    rng = random.Random(1)
    for _ in range(2500):
        words = _words(rng)
        assert word_runs(words) == _brute(words)
        names = {w: i for i, w in enumerate(sorted(set(words)), 1)}
        # Every run of two periods, without the stretches that cannot hold four.
        assert runs_of([names[w] for w in words], 2, 2) == sorted(_brute(words, 2, 2))


def test_tree_holds_every_suffix_once():
    rng = random.Random(2)
    for _ in range(200):
        text = [rng.randrange(1, 4) for _ in range(rng.randrange(1, 40))]
        parents, firsts, children, depth = suffix_tree(text)
        assert sorted(-1 - c for c in children if c < 0) == list(range(len(text) + 1))
        assert len(set(zip(parents, firsts, strict=True))) == len(children)
        below = {}
        for parent in parents:
            below[parent] = below.get(parent, 0) + 1
        assert all(n >= 2 for n in below.values())
        assert all(depth[c] > depth[p] for p, c in zip(parents, children, strict=True) if c >= 0)


def test_long_periodic_text():
    assert runs_of([1 + i % 700 for i in range(30_000)]) == [(0, 30_000, 700)]
    assert word_runs([b"x"] * 30_000) == [(0, 30_000, 1)]


def _expected(doc_id, text, damaged=True):
    words = _WORD.findall(text or "")
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    g = h // 10
    if damaged and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = _brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    text = " ".join(w for i, w in enumerate(words) if i not in gone)
    shas = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, text)]
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *numbers, *shas, n)


def _sorted(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query_by_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = queries.op13_periodic_runs(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    expected = [_expected(r.doc_id, r.text) for r in docs]
    assert _sorted(found.collect()) == _sorted(expected)
    assert any(r[1] for r in expected)


def test_odd_rows(spark, odd_docs, no_docs):
    planted = spark.createDataFrame(
        [(20, "a b a b a b a b c c c c c c c a"), (20, "é é é é é é \n\t x"), (None, "y " * 9)],
        "doc_id long, text string",
    )
    docs = odd_docs.select("doc_id", "text").union(planted)
    for damaged in (True, False):
        rows = with_repeated_tails(docs) if damaged else docs
        found = run_digest(periodic_runs(rows)).collect()
        assert _sorted(found) == _sorted([_expected(*r, damaged) for r in docs.collect()])
    assert periodic_runs(no_docs).collect() == []
    assert run_digest(periodic_runs(with_repeated_tails(no_docs))).collect() == []
    (row,) = periodic_runs(planted.limit(1)).collect()
    assert [tuple(r) for r in row.runs] == [(0, 8, 2), (8, 7, 1)] and row.collapsed == "a b c a"


@pytest.mark.parametrize("least", [6, 9])
def test_thresholds(spark, least):
    docs = spark.createDataFrame([(1, "z " * 8)], "doc_id long, text string")
    assert len(periodic_runs(docs, least).first().runs) == (least <= 8)
