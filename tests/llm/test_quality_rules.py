from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from soundings.llm import queries
from soundings.llm.quality_rules import COUNTS, RULES, estimate, judge_quality, text_counts

_WORD = re.compile("[^\x20\x09-\x0d]+")


def _expected(doc_id, text):
    text = text or ""
    words = _WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return (
        doc_id,
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(repeated),
    )


def _base(df):
    return sorted(map(tuple, df.select("doc_id", *COUNTS[:5]).collect()), key=repr)


def _all(docs):
    return sorted((_expected(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=repr)


def test_query_counts_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = queries.op12_quality_rules(spark, "/root/testdata/sf0.01")
    assert _base(found) == _all(docs)
    failed = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    assert found.filter(F.col("base_failed") != failed).count() == 0
    assert found.filter("base_failed AND kept").count() == 0


def test_odd_rows(spark, odd_docs, no_docs):
    planted = spark.createDataFrame(
        [
            (20, "a b c d e a b c d e f\x0bg\x0ch é\x1fü # * $ % & | < >"),
            (21, "x y\nx y\n x y\n\n \nx y"),
            (22, "w " * 4000),
            (22, "w " * 4000),
            (23, "ä" * 70 + " " + "b" * 40),
        ],
        "doc_id long, text string",
    )
    docs = odd_docs.select("doc_id", "text").union(planted)
    assert _base(text_counts(docs)) == _all(docs)
    (long,) = text_counts(planted).filter("doc_id = 23").collect()
    assert long.longest_word == 70 and long.n_letters == 110
    judged = judge_quality(odd_docs)
    assert judged.count() == odd_docs.count()
    assert judged.filter("quality IS NULL OR kept IS NULL").count() == 0
    assert judge_quality(no_docs).collect() == []


def test_estimates_of_known_rules():
    """Votes drawn from known rates give these rates back."""
    rng = np.random.default_rng(3)
    n, share = 200_000, 0.7
    good = rng.random(n) < share
    rates = {0: (0.02, 0.3, 0.8, 0.1), 1: (0.01, 0.4, 0.7, 0.3), 2: (0.005, 0.25, 0.0, 0.0), 3: (0.1, 0.6, 0.6, 0.2)}
    votes = np.zeros((n, 4), int)
    for rule, (down_good, down_bad, up_good, up_bad) in rates.items():
        draw = rng.random(n)
        down, up = np.where(good, down_good, down_bad), np.where(good, up_good, up_bad)
        votes[:, rule] = np.where(draw < down, -1, np.where(draw < down + up, 1, 0))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    found = estimate(patterns, counts.astype(float), weight=1e-4)
    assert found.share_good == pytest.approx(share, abs=0.03)
    for rule, (down_good, down_bad, up_good, up_bad) in rates.items():
        assert found.rates[rule, 0] == pytest.approx((down_good, down_bad), abs=0.03)
        assert found.rates[rule, 2] == pytest.approx((up_good, up_bad), abs=0.03)


def test_posteriors_are_those_of_the_votes(spark):
    """Brute force: each row's probability from its votes and the estimates of all rows."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = judge_quality(docs).collect()
    value = {"-": -1, "0": 0, "+": 1}
    patterns = Counter(r.votes for r in rows)
    table = np.array([[value[c] for c in p] for p in patterns])
    found = estimate(table, np.array(list(patterns.values()), float))
    for r in rows:
        good, bad = found.share_good, 1 - found.share_good
        for rule, sign in enumerate(r.votes):
            good *= found.rates[rule, value[sign] + 1, 0]
            bad *= found.rates[rule, value[sign] + 1, 1]
        assert r.quality == pytest.approx(good / (good + bad), abs=1e-9)
        assert len(r.votes) == len(RULES)


def test_verdicts_against_labels(spark):
    """Labels are never read by the operator; texts too short for the base rule stay out."""
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id", "quality AS label")
    found = queries.op12_quality_rules(spark, sf_dir).join(labels, "doc_id").filter("NOT base_failed")
    by = {(r.label, r.kept): r["count"] for r in found.groupBy("label", "kept").count().collect()}
    assert by[1, True] >= 0.98 * (by[1, True] + by.get((1, False), 0))
    assert by[0, False] >= 0.9 * (by[0, False] + by.get((0, True), 0))
