"""Near-duplicate lines by an exact set-similarity join, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from soundings.llm.common import staged, text_key, whole_text

_BUCKETS = 65_536
#: Up to this many lines to verify or already told, their keys are broadcast; beyond it they are joined.
_BROADCAST_LINES = 1_000_000
#: Sketches of lines with more words have two parts, as 64 bits tell them little.
_SHORT_LINE = 64
#: The words by which all lines meet are dealt to so many rounds.
_ROUNDS = 2
_KEY = ["h1", "h2"]
_SKETCH = ["odd_0", "odd_1"]
_MET = ["id", "n", "pos", *_SKETCH]


def similar_lines(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Which lines of each document repeat an earlier line, exactly or nearly.

    A line is removed if a line before it, in the same document or one with a smaller doc_id, has
    a set of words (split at spaces) whose Jaccard similarity to its own is `threshold` or more.
    Lines without words stay. Null texts have one empty line; null doc_ids come last; documents
    with one doc_id are ordered by content. An empty table gives no rows.

    Words are ordered by rarity, told from counts in a fixed number of hash buckets; similar lines
    share one of the first words in that order, for the shorter line one of about half as many.
    Each line is first compared with the earliest line of each word in that half, and only lines
    that match none of these with all others, so that groups of copies make no list of pairs.
    Pairs pass a length, a positional and a parity filter, with more bits for longer lines, before
    their word sets are compared. Lines are told apart by 128 bits of hashes.

    Returns rank (order of documents), doc_id, text_key, n_lines and removed (line numbers).
    """
    lines = staged(_in_order(docs), "line-docs")
    documents = lines.filter("at = 0")
    classes = staged(_classes(docs, lines, threshold, _rarity(docs)), "line-classes")
    led = staged(_with_leaders(classes, threshold), "line-met")
    resolved = staged(_verified(docs, classes, led, threshold), "line-led")
    flags = resolved.withColumn("led", F.lit(True))
    if resolved.count() <= _BROADCAST_LINES:
        flags = F.broadcast(flags)
    open_ = classes.join(flags, "id", "left").withColumn("open", F.col("led").isNull())
    met = reduce(
        DataFrame.union,
        [staged(_with_all(open_, k, threshold).distinct(), "line-met") for k in range(_ROUNDS)],
    )
    more = staged(_verified(docs, classes, met, threshold), "line-more")
    similar = resolved.union(more).withColumn("similar", F.lit(True))
    told = classes.join(similar, "id", "left").select(
        *_KEY, F.col("id").alias("first"), F.coalesce("similar", F.lit(False)).alias("similar")
    )
    removed = (
        lines.join(told, _KEY)
        .filter(F.col("similar") | (F.col("id") != F.col("first")))
        .groupBy((F.col("id") - F.col("at")).alias("id"))
        .agg(F.array_sort(F.collect_list("at")).alias("removed"))
    )
    return documents.join(removed, "id", "left").select(
        F.col("id").alias("rank"),
        "doc_id",
        "text_key",
        "n_lines",
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def drop_similar_lines(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """`docs` with the lines told by `similar_lines` taken out of `text`; no row is dropped."""
    by = W.partitionBy("_id", "_key").orderBy("_one")
    rows = docs.select(
        F.col("doc_id").alias("_id"),
        text_key(whole_text()).alias("_key"),
        F.lit(1).alias("_one"),
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
    ).withColumn("_nth", F.row_number().over(by))
    told = staged(similar_lines(docs, threshold), "line-told")
    by = W.partitionBy("doc_id", "text_key").orderBy("rank")
    told = told.select(
        F.col("doc_id").alias("_told"), F.col("text_key").alias("_told_key"), "removed",
        F.row_number().over(by).alias("_told_nth"),
    )
    same = (
        F.col("_id").eqNullSafe(F.col("_told"))
        & (F.col("_key") == F.col("_told_key"))
        & (F.col("_nth") == F.col("_told_nth"))
    )
    kept = F.filter(
        F.split("_row.text", "\n"), lambda line, at: ~F.array_contains("removed", at)
    )
    text = F.when(F.size("removed") == 0, F.col("_row.text")).otherwise(F.array_join(kept, "\n"))
    columns = [
        text.alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns
    ]
    return rows.join(told, same).select(*columns)


def _hashes(line: Column) -> Column:
    return F.struct(
        F.xxhash64(F.lit(1), line).alias("h1"), F.xxhash64(F.lit(2), line).alias("h2")
    )


def _in_order(docs: DataFrame) -> DataFrame:
    """A row per line, numbered by `id` in order; those of a document follow each other."""
    text = whole_text()
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("doc_id").isNull().alias("none"),
        text_key(text).alias("text_key"),
        F.transform(F.split(text, "\n"), _hashes).alias("lines"),
    )
    # Ranges are told from a first look at the rows, which should not hash all texts again.
    ordered = staged(keyed, "line-keys").repartitionByRange("none", "doc_id").sortWithinPartitions(
        "none", "doc_id", "lines"
    )
    lines = ordered.select(
        "doc_id",
        "text_key",
        F.size("lines").cast("long").alias("n_lines"),
        F.posexplode("lines").alias("at", "line"),
    )
    return lines.select(
        F.monotonically_increasing_id().alias("id"), "at", "line.*", "doc_id", "text_key", "n_lines"
    )


def _by_word(classes: DataFrame, prefix: Column, *more: Column | str) -> DataFrame:
    """A row per line and word of `prefix`; words are met by 40 bits, which can only add pairs."""
    return classes.select(
        "id", "n", *_SKETCH, *more, F.posexplode(prefix).alias("pos", "ranked")
    ).withColumn("word", F.col("ranked").bitwiseAND(F.lit((1 << 40) - 1)))


def _front(threshold: float) -> Column:
    """The part of the prefix in which a line meets similar ones that are no shorter."""
    reach = F.col("n") - _needed(2 * F.col("n"), threshold) + 1
    return F.slice("prefix", F.lit(1), reach.cast("int"))


def _with_leaders(classes: DataFrame, threshold: float) -> DataFrame:
    """(id, other_id) of lines and the earliest line of a front word, if they may match."""
    by = W.partitionBy("word").orderBy("id")
    postings = _by_word(classes, _front(threshold)).select("word", *_MET)
    led = postings.select(*_MET, *[F.first(c).over(by).alias(f"other_{c}") for c in _MET])
    found = led.filter((F.col("other_id") < F.col("id")) & _may_match(threshold))
    return found.select("id", "other_id").distinct()


def _with_all(classes: DataFrame, round_: int, threshold: float) -> DataFrame:
    """(id, other_id) of lines met at a word of this round that may match, the later `open`.

    The longer line of a pair brings its prefix, the shorter one its front. Pairs that also share
    the word before are left to that word, so most pairs are met once however much they share. A
    fixed share of the words is shuffled at a time and its pairs are stored, so that scratch disks
    never hold all postings.
    """
    columns = ["word", *_MET, "open", "before"]

    def postings(prefix: Column) -> DataFrame:
        # Positions of posexplode count from 0, so `pos` is the place of the word before.
        before = F.when(F.col("pos") > 0, F.element_at("prefix", F.col("pos")))
        rows = _by_word(classes, prefix, "open", "prefix").withColumn("before", before)
        return rows.filter(F.pmod("word", F.lit(_ROUNDS)) == round_).select(columns)

    first = postings(F.col("prefix"))
    others = postings(_front(threshold))
    others = others.select("word", *[F.col(c).alias(f"other_{c}") for c in columns[1:]])
    earlier = F.col("other_id") < F.col("id")
    longer = (F.col("n") > F.col("other_n")) | ((F.col("n") == F.col("other_n")) & earlier)
    anew = F.coalesce(F.col("before") != F.col("other_before"), F.lit(True))
    wanted = F.when(earlier, F.col("open")).otherwise(F.col("other_open"))
    found = first.join(others, "word").filter(longer & _may_match(threshold) & anew & wanted)
    ids = F.greatest("id", "other_id").alias("id"), F.least("id", "other_id").alias("other_id")
    return found.select(*ids)


def _rarity(docs: DataFrame) -> Column:
    """For each bucket of words, how often its words occur, as 64 times the binary logarithm.

    The figure stands in the upper bits of a long, above 50 bits for the word.
    """
    lines = docs.select(F.explode(F.split(whole_text(), "\n")).alias("line"))
    words = lines.select(F.explode(F.split("line", " ")).alias("word"))
    counts = words.groupBy(_bucket(F.xxhash64("word")).alias("bucket")).count().collect()
    table = [0] * _BUCKETS
    for bucket, count in counts:
        log = int(count).bit_length() * 64 + (64 * count >> int(count).bit_length())
        table[bucket] = min(4095, log) << 50
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def _bucket(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(_BUCKETS - 1))


def _classes(docs: DataFrame, lines: DataFrame, threshold: float, rarity: Column) -> DataFrame:
    """Distinct lines with words: first place, number of words, prefix in order of rarity, sketches.

    A line of n words can only match one that has a word in common with its first
    n - ceil(threshold * n) + 1. The parity sketch has bit b set if an odd number of its words
    fall on b, so two sketches differ in no more bits than the sets in words. Longer lines have
    twice the bits, in two parts that make up the sketch of 64 bits; the others' second part is 0.
    """
    texts = docs.select(F.explode(F.split(whole_text(), "\n")).alias("text"))
    texts = texts.filter(F.trim("text") != "")
    texts = texts.select(F.inline(F.array(_hashes(F.col("text")))), "text")
    firsts = lines.groupBy(*_KEY).agg(F.min("id").alias("id"))
    rank = lambda hashed: rarity[_bucket(hashed)].bitwiseOR(
        F.shiftrightunsigned(hashed, 14)
    )
    hashes = F.transform(_words("text"), lambda word: F.xxhash64(word))
    words = F.sort_array(F.transform(F.array_distinct(hashes), rank))
    n = F.size("words")
    reach = n - F.ceil(n * threshold - 1e-9) + 1
    long_ = n > _SHORT_LINE
    # Sketches and prefixes are shuffled, not texts: they are smaller.
    told = texts.select(*_KEY, words.alias("words")).select(
        *_KEY,
        n.alias("n"),
        F.when(long_, _parity(part=0)).otherwise(_parity()).alias("odd_0"),
        F.when(long_, _parity(part=1)).otherwise(F.lit(0)).cast("long").alias("odd_1"),
        F.slice("words", F.lit(1), reach.cast("int")).alias("prefix"),
    )
    return told.dropDuplicates(_KEY).join(firsts, _KEY).select(
        *_KEY, "id", "n", *_SKETCH, "prefix"
    )


def _parity(part: int | None = None) -> Column:
    """64 bits: whether an odd number of words fall on each; of one of the two parts of the words."""
    parts = 1 if part is None else 2
    # What a word flips is looked up: lambdas are interpreted, so each step less tells.
    bits = [(1 << k % 64) - (k % 64 == 63) * (1 << 64) for k in range(64 * parts)]
    flips = F.lit([b if part in (None, k // 64) else 0 for k, b in enumerate(bits)])
    flip = lambda odd, word: odd.bitwiseXOR(
        flips[word.bitwiseAND(F.lit(64 * parts - 1))]
    )
    return F.aggregate("words", F.lit(0).cast("long"), flip)


def _words(text: str) -> Column:
    return F.array_remove(F.split(text, " "), "")


def _needed(both: Column, threshold: float) -> Column:
    """How many common words two sets with `both` words in sum must have."""
    return F.ceil(both * (threshold / (1 + threshold)) - 1e-9)


def _may_match(threshold: float) -> Column:
    """Parity, length and positional filter for a pair met at a common word."""
    both = F.col("n") + F.col("other_n")
    needed = _needed(both, threshold)
    before = F.least("pos", "other_pos")
    after = F.least(F.col("n") - F.col("pos"), F.col("other_n") - F.col("other_pos"))
    differ = [F.col(c).bitwiseXOR(F.col(f"other_{c}")) for c in _SKETCH]
    most = both - 2 * needed
    alike = (F.col("n") > _SHORT_LINE) == (F.col("other_n") > _SHORT_LINE)
    return (
        (F.bit_count(differ[0].bitwiseXOR(differ[1])) <= most)
        # Of a short and a longer line only the whole sketches can be compared.
        & (~alike | (F.bit_count(differ[0]) + F.bit_count(differ[1]) <= most))
        & (before + after >= needed)
        & (F.least("n", "other_n") >= F.greatest("n", "other_n") * threshold - 1e-9)
    )


def _verified(
    docs: DataFrame, classes: DataFrame, pairs: DataFrame, threshold: float
) -> DataFrame:
    """`id` of the lines in `pairs` whose word sets really are similar to the other's."""
    pairs = staged(pairs.distinct(), "line-pairs")
    wanted = pairs.select("id").union(pairs.select("other_id")).distinct()
    few = pairs.count() <= _BROADCAST_LINES // 2
    hint = F.broadcast if few else lambda df: df
    keys = staged(classes.select("id", *_KEY).join(hint(wanted), "id"), "line-wanted")
    texts = docs.select(F.explode(F.split(whole_text(), "\n")).alias("text"))
    texts = texts.select(F.inline(F.array(_hashes(F.col("text")))), "text").join(hint(keys), _KEY)
    words = texts.dropDuplicates(["id"]).select(
        "id", F.array_distinct(_words("text")).alias("words")
    )
    others = words.select(F.col("id").alias("other_id"), F.col("words").alias("others"))
    common = F.size(F.array_intersect("words", "others"))
    return (
        pairs.join(words, "id")
        .join(others, "other_id")
        .filter(common >= _needed(F.size("words") + F.size("others"), threshold))
        .select("id")
        .distinct()
    )
