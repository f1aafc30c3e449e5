"""Scans, classifiers, mixing, packing and the pipeline."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from soundings.llm import mixing, queries
from soundings.llm.credentials import base_spans, scan_secrets
from soundings.llm.labelled import labelled_sample
from soundings.llm.licenses import (
    TEMPLATES,
    TemplateIndex,
    _WordHashes,
    banded_alignment,
    matches_of,
    scan_licenses,
)
from soundings.llm.mixing import block_quotas, draws, mix_documents, mix_words, source_targets
from soundings.llm.packing import _WordIds, pack, squares_pack
from soundings.llm.quality import isotonic, score_quality
from soundings.llm.toxicity import drop_toxic, folded, score_toxicity
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.01"
TOKENIZERS = [public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")]


def _table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_base_spans():
    text = "é token: token: abcdefghijk AKIAABCDEFGHIJKLMN AKIA12 " + "a1" * 16 + " SECRET='12345678'"
    told = [(text[s:e], k) for s, k, e in base_spans(text)]
    assert told == [
        ("AKIAABCDEFGHIJKLMN", 1), ("a1" * 16, 2), ("SECRET='12345678", 0)
    ]
    assert base_spans("") == []


def test_weak_candidates_need_company(spark):
    weak = "Zx9Kq2Lm8Vb4Nc7Tr1Wp0Sd"
    rows = [
        (1, f"user=alice {weak} https://host/x"),
        (2, f"alone {weak}"),
        (3, "https://host/x user=alice"),
        (4, f"user=alice {'word ' * 100} {weak}"),
        (5, "https://host/x password=abcdefgh"),
    ]
    found = scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.n_linked for r in found.collect()} == {1: 3, 2: 0, 3: 0, 4: 0, 5: 0}
    spans = found.filter("doc_id = 1").first().spans
    assert spans == "identifier:5:10,secret:11:34,endpoint:35:49"


def test_scans_of_odd_rows(odd_docs, no_docs):
    for scan, column in ((scan_secrets, "spans"), (scan_licenses, "spans")):
        rows = scan(odd_docs).collect()
        assert len(rows) == len(ODD)
        assert all(r[column] == "" for r in rows if r.doc_id in (None, 1, 7, 8))
        assert scan(no_docs).collect() == []
    assert scan_secrets(odd_docs).filter("doc_id = 10").first().n_access == 1
    assert scan_licenses(odd_docs).filter("doc_id = 11").first().licenses == "MIT"


def test_licenses_survive_changes(spark):
    mit = TEMPLATES["MIT"]
    words = mit.split()
    changed = " ".join(w if i % 17 else "changed" for i, w in enumerate(words))
    rows = [(1, f"x\n{mit}\ny"), (2, changed), (3, " ".join(words[: len(words) // 2])), (4, "the license")]
    found = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].spans == f"MIT:2:{1 + len(mit)}" and found[1].coverage == 1
    assert found[2].licenses == "MIT" and 0.9 < found[2].coverage < 1
    assert found[3].n_matches == found[4].n_matches == 0


def test_licenses_are_found_wherever_they_stand():
    """Every template, cut off from its surroundings by other words, gives its own span."""
    index = TemplateIndex(TEMPLATES, 3)
    rng = random.Random(4)
    other = [f"w{i}" for i in range(50)] + ["İstanbul", "İzmir", "ǅ", "the", "license", "of"]
    for name, template in TEMPLATES.items():
        for before in range(12):
            words = [" ".join(rng.choices(other, k=n)) for n in (before, 9)]
            text = f"{words[0]} w0 {template} w1 {words[1]}"
            start, end = (m.span() for m in (re.search(r"\w", template), re.search(r"\w\W*$", template)))
            at = len(words[0]) + 4
            found = matches_of(text, index, 3, 2, 8, 0.8, _WordHashes())
            assert [(n, s, e) for n, s, e, _ in found] == [(name, at + start[0], at + end[0] + 1)], name


def test_alignment_is_the_best_there_is():
    """Against all pairs of places, for strings short enough to lie within the band."""
    rng = random.Random(7)
    for _ in range(200):
        a, b = (rng.choices("abc", k=rng.randint(1, 9)) for _ in range(2))
        best = 0
        score = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                near = score[i - 1][j - 1] + (1 if x == y else -1)
                score[i][j] = max(0, near, score[i - 1][j] - 1, score[i][j - 1] - 1)
                best = max(best, score[i][j])
        matched, first, last = banded_alignment(a, b, 0, 20)
        assert matched >= best
        assert (last - first >= matched) and (best > 0) == (matched > 0)


def test_folding():
    assert folded("Yоu 1D10T!") == " you idioti "
    assert folded("") == "  "


@pytest.mark.parametrize(
    ("score", "label", "least"), [(score_toxicity, "toxic", 0.9), (score_quality, "quality", 0.95)]
)
def test_held_out_accuracy(spark, odd_docs, no_docs, labels, score, label, least):
    docs, known = _table(spark, "documents"), _table(spark, "labels")
    found = score(docs, known).join(known, "doc_id").filter("held_out").toPandas()
    assert (found["predicted"] == found[label]).mean() >= least
    rows = score(odd_docs, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    for empty in (labels.limit(0), labels):
        assert score(no_docs, empty).collect() == []
    assert len(score(odd_docs, labels.limit(0)).collect()) == len(ODD)


def test_labelled_rows_are_bounded(spark):
    """As many rows as labels, however often a doc_id is there."""
    docs = spark.range(3000).selectExpr("1 AS doc_id", "concat('text ', id) AS text")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1)], "doc_id long, toxic int")
    (row,) = labelled_sample(docs, labels, "toxic", F.lit(True), 10).collect()
    assert (row.doc_id, row.text, row.y) == (1, "text 0", 1)
    many = spark.range(500).selectExpr("id AS doc_id", "'x' AS text", "0 AS toxic")
    assert labelled_sample(many, many, "toxic", F.lit(True), 10).count() == 10


def test_drop_toxic(spark):
    docs, known = (_table(spark, n, "/root/testdata/sf0.1") for n in ("documents", "labels"))
    kept = drop_toxic(docs, known)
    assert kept.schema == docs.schema
    before, after = docs.join(known, "doc_id"), kept.join(known, "doc_id")
    assert after.filter("toxic = 0").count() >= 0.99 * before.filter("toxic = 0").count()
    assert after.filter("toxic = 1").count() <= 0.1 * before.filter("toxic = 1").count()


def test_isotonic():
    found = isotonic(np.array([0.1, 0.5, 0.3, 0.9]), np.array([1.0, 1, 3, 1]))
    assert np.allclose(found, [0.1, 0.35, 0.35, 0.9])


def _targets(sizes):
    """The same by repeated sharing."""
    weights = {s: 1 + i % 3 for i, s in enumerate(sizes)}
    full, left = {}, sum(sizes.values())
    while True:
        open_ = [s for s in sizes if s not in full]
        level = left / max(1, sum(weights[s] for s in open_))
        over = [s for s in open_ if level * weights[s] > 3 * sizes[s]]
        if not over:
            return full | {s: level * weights[s] for s in open_}
        for s in over:
            full[s] = 3 * sizes[s]
            left -= full[s]


def test_mix_words(spark):
    sizes = {"a": 900, "b": 10, "c": 40, "é": 0, None: 5}
    rows = [(i, s, " ".join(["x"] * (n // 5))) for s, n in sizes.items() for i in range(5)]
    found = mix_words(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    rows, targets = found.collect(), _targets(sizes)
    by = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        by[r.target] += r.taken
    assert sorted(by) == pytest.approx(sorted(set(targets.values())))
    for target, taken in by.items():
        assert abs(taken - target) <= 2
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, found.collect()), key=repr)


def test_mix_words_is_what_the_shards_of_the_tree_draw(spark):
    rows = [(i, "ab"[i % 2], " ".join(["w"] * (i % 7 * 3))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    weights, blocks, shards, seed = (1, 5), 16, 4, 5
    found = {r.doc_id: r for r in mix_words(docs, weights, 3, blocks, shards, seed).collect()}
    tape = mixing._rows(docs, seed, docs.doc_id)
    quotas = block_quotas(source_targets(tape, weights, 3), blocks, 3)
    sizes = {r.number: (r.source_text, r.source_size, r.blocks) for r in quotas.collect()}
    drawn = defaultdict(lambda: [0] * shards)
    for r in draws(quotas, shards, seed).collect():
        drawn[r.number, r.block][r.shard] += 1
    in_order = sorted(tape.collect(), key=lambda r: (r.order % math.isqrt(60), r.order, r.size))
    for number, (source, size, n) in sizes.items():
        words = [r.doc_id for r in in_order if r.source_text == source for _ in range(r["size"])]
        taken = defaultdict(lambda: [0] * shards)
        for block in range(n):
            for doc in words[block * size // n : (block + 1) * size // n]:
                taken[doc] = [a + b for a, b in zip(taken[doc], drawn[number, block], strict=True)]
        for doc in range(number, 60, 2):
            assert found[doc].shard_taken == taken[doc]
            assert found[doc].taken == sum(taken[doc])
    per_shard = np.sum([r.shard_taken for r in found.values()], axis=0)
    assert (np.abs(per_shard - per_shard.mean()) <= 0.35 * per_shard.mean()).all()


def test_children_of_a_node_share_its_draws(spark):
    node = spark.createDataFrame([(0, 0, 401), (1, 0, 0), (2, 0, 100), (0, 1, 7)], "number long, shard long, quota long")
    halves = [{(r.number, r.shard): r.quota for r in mixing._halved(node, seed).collect()} for seed in range(8)]
    for half in halves:
        assert half[0, 0] + half[2, 0] == 250 and half[0, 1] + half[2, 1] == 251
        assert half[1, 0] == half[1, 1] == 0
        assert half[0, 0] + half[0, 1] == 401 and (half[0, 2], half[0, 3]) == (3, 4)
    assert len({half[0, 0] for half in halves}) > 1
    assert all(160 <= half[0, 0] <= 241 for half in halves)


def test_mix_documents_keeps_a_shard_together(spark):
    rows = [(i, "ab"[i % 3 == 0], "w " * (i % 5 + 1), f"s{i}", f"p{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, shard string, place string")
    mixed = mix_documents(docs, shards=4).withColumn("part", F.spark_partition_id())
    rows = mixed.collect()
    assert all((r.shard, r.place) == (f"s{r.doc_id}", f"p{r.doc_id}") for r in rows)
    parts = defaultdict(set)
    for r in rows:
        parts[r.mix_shard].add(r.part)
    assert len(parts) == 4 and all(len(p) == 1 for p in parts.values())
    for shard in parts:
        places = [r.mix_place for r in rows if r.mix_shard == shard]
        assert places == sorted(places)
        ids = [r.doc_id for r in rows if r.mix_shard == shard]
        assert ids != sorted(ids)


def test_splitting_tree_is_exact(spark):
    rows = [("a", False, 5000), ("b", False, 300), ("c", False, 7)]
    sizes = spark.createDataFrame(rows, "source_text string, source_none boolean, size long")
    quotas = block_quotas(source_targets(sizes, (1, 2, 3), 3), 100, 3)
    drawn = draws(quotas, 8, seed=1).toPandas()
    wanted = {r.number: r.quota for r in quotas.collect()}
    assert drawn.groupby("number").size().to_dict() == {n: q for n, q in wanted.items() if q}
    shards = drawn.groupby("shard").size()
    assert len(shards) == 8 and shards.max() - shards.min() <= 1 + math.log2(8)
    assert not drawn.duplicated(["number", "block", "epoch"]).any()


def test_mixing_odd_rows(odd_docs, no_docs):
    assert mix_words(odd_docs).count() == len(ODD)
    mixed = mix_documents(odd_docs)
    assert mixed.columns == [*odd_docs.columns, "mix_shard", "mix_place"]
    assert mixed.select(*odd_docs.columns).subtract(odd_docs).isEmpty()
    again = mix_documents(mixed)
    assert again.columns[-2:] == ["_mix_shard", "_mix_place"]
    assert again.select(*mixed.columns).subtract(mixed).isEmpty()
    assert mix_words(no_docs).collect() == mix_documents(no_docs).collect() == []


def test_squares_pack_fills():
    sizes = np.sort(np.random.default_rng(0).integers(1, 30, 3000))[::-1]
    sequence, offset = squares_pack(sizes, 64)
    used = defaultdict(list)
    for s, o, n in zip(sequence, offset, sizes, strict=True):
        used[s].append((o, o + n))
    for spans in used.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 64
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert len(used) <= math.ceil(sizes.sum() / 64) + 2


@pytest.mark.parametrize("seed", range(4))
def test_squares_pack_places_by_the_sum_of_squares(seed):
    sizes = np.random.default_rng(seed).integers(1, 21, 200)
    sequence, offset = squares_pack(sizes, 20)
    gaps: dict[int, int] = {}

    def squares(after: dict[int, int]) -> int:
        open_ = [g for g in after.values() if 0 < g < 20]
        return sum(open_.count(g) ** 2 for g in set(open_))

    for size, chosen, at in zip(sizes.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        room = [k for k, gap in gaps.items() if gap >= size]
        assert (chosen in room) == bool(room)
        assert at == 20 - gaps.get(chosen, 20)
        sums = {k: squares(gaps | {k: gaps[k] - size}) for k in room}
        assert not room or sums[chosen] == min(sums.values())
        gaps[chosen] = gaps.get(chosen, 20) - size


@pytest.mark.parametrize("path", TOKENIZERS)
def test_pack_round_trip(spark, odd_docs, no_docs, path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    docs = odd_docs.select("doc_id", "text").union(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
        .selectExpr("doc_id + 1000", "text")
    )
    expected = defaultdict(int)
    for doc_id, text in docs.collect():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = np.array(ids[start : start + 2048], "<u4")
            expected[doc_id, piece, start, len(own), zlib.crc32(own.tobytes())] += 1
    found = pack(docs, path).collect()
    got, used = defaultdict(int), defaultdict(list)
    for r in found:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        used[r.sequence_id].append((r.offset, r.offset + r.length))
    assert got == expected
    for spans in used.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 2048
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert len(used) <= math.ceil(sum(k[3] * n for k, n in got.items()) / 2048) + 2
    assert pack(no_docs, path).collect() == []


def test_pipeline_stages_take_odd_rows(spark, odd_docs, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, name
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.count() >= docs.count()


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_words_ending_in_marks_are_not_encoded_alone():
    words = _WordIds(TOKENIZERS[0])
    tokenizer, alone = words._tokenizer, []

    class Counted:
        def encode_batch_fast(self, texts, **more):
            alone.extend(x for x in texts if " " not in x)
            return tokenizer.encode_batch_fast(texts, **more)

    words._tokenizer = Counted()
    texts = [f"{a}{m} {b}{m}{m}\n{a}'s {m}{b} {a}{m}'{m}" for a, b in (("innt", "éoué"), ("By", "x"))
             for m in ("!!", ",&&&", ".", "***", "-", "\\", "~|", "]")]
    assert words._by_word
    found = words.encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert not {"innt!!", "by,&&&", "x***"} & set(alone)
