"""Quality rules that vote or abstain, weighed by accuracies that expectation-maximisation finds."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundings.llm.common import staged, whole_text

_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_DIGITS = b"0123456789"
_LETTERS = bytes(b for b in range(256) if b >= 0x80 or chr(b).isalpha())
_CLOSING = (b".", b"!", b"?", b":", b";", b'"', b"'", b")")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_closed_lines",
    "n_distinct_words",
    "n_letters",
    "n_digits",
    "longest_word",
)

#: When a rule votes against a document and when for it, as SQL; it abstains where neither holds.
#: Most rules know one kind of fault and have nothing to say for a document.
RULES = {
    "length": ("n_words < 10", "n_words >= 30"),
    "letters": ("10 * n_letters < 8 * word_chars", "50 * n_letters >= 47 * word_chars"),
    "many_words": (
        "n_words BETWEEN 20 AND 399 AND 5 * n_distinct_words < n_words",
        "n_words >= 20 AND 5 * n_distinct_words >= 2 * n_words",
    ),
    "word_length": ("word_chars NOT BETWEEN 3 * n_words AND 12 * n_words", None),
    "giant_words": ("longest_word > 60", None),
    "symbols": ("20 * n_symbols > n_words", None),
    "digits": ("5 * n_digits > word_chars", None),
    "repeated_lines": ("10 * n_dup_lines > 3 * n_lines", None),
    "repeated_windows": ("10 * n_repeat_words > n_words", None),
    "open_lines": ("n_lines >= 3 AND 10 * n_closed_lines < n_lines", None),
}


def _repeated(words: list[bytes], hashes: np.ndarray, width: int) -> int:
    """Words that stand in a window of `width` words found twice or more."""
    count = len(words) - width + 1
    if count < 2:
        return 0
    rolled = np.zeros(count, np.uint64)
    for i in range(width):
        rolled = rolled * _FACTOR + hashes[i : i + count]
    order = np.sort(rolled)
    same = order[1:] == order[:-1]
    if not same.any():
        return 0
    # Equal windows have equal hashes; the windows themselves decide.
    maybe = np.flatnonzero(np.isin(rolled, order[1:][same])).tolist()
    windows = [tuple(words[i : i + width]) for i in maybe]
    times = Counter(windows)
    change = np.zeros(len(words) + 1, np.int64)
    at = np.array([i for i, w in zip(maybe, windows, strict=True) if times[w] > 1], np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + width, -1)
    return int((np.cumsum(change) > 0).sum())


def _counts(text: bytes) -> tuple[int, ...]:
    words = text.split()
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    signs = text.translate(None, _SPACE)
    points = np.frombuffer(signs, np.uint8)
    word_chars = int(((points & 0xC0) != 0x80).sum())
    ascii_letters_gone = signs.translate(None, _LETTERS)
    # A longest word by bytes is at most four times the longest by code points.
    longest = max(map(len, words), default=0)
    if longest > 30:
        longest = max(len(w.decode("utf-8", "replace")) for w in words if 4 * len(w) >= longest)
    return (
        len(words),
        word_chars,
        sum(map(signs.count, _SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words, hashes, 5),
        len(lines),
        sum(x.rstrip(_SPACE).endswith(_CLOSING) for x in lines),
        len(set(words)),
        word_chars - len(ascii_letters_gone),
        len(signs) - len(signs.translate(None, _DIGITS)),
        longest,
    )


def text_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, then the columns of `COUNTS`) of each row, from its whole text; null counts as empty.

    Words are longest stretches without ASCII white space. `n_dup_lines` are lines with a word that
    equal an earlier line, `n_repeat_words` words in a window of five found twice or more.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_counts(text.as_py()) for text in batch.column("text")]
            table = np.array(rows, np.int64).reshape(-1, len(COUNTS))
            columns = [pa.array(table[:, i]) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", *COUNTS]
            )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text")
    )
    return texts.mapInArrow(count, ", ".join(f"{c} long" for c in ("doc_id", *COUNTS)))


def vote(bad: str, good: str | None) -> Column:
    """-1 against, 1 for, 0 where the rule abstains."""
    return F.expr(f"CASE WHEN {bad} THEN -1 WHEN {good or 'false'} THEN 1 ELSE 0 END")


#: Where the estimates start: the share of good documents, and how often a rule votes against, and
#: for, a good and a bad document.
START_SHARE, START_AGAINST, START_FOR = 0.8, (0.005, 0.15), (0.9, 0.7)


@dataclass(frozen=True)
class Accuracies:
    """`rates[rule][vote + 1]` is how often a rule so votes on a good and on a bad document."""

    share_good: float
    rates: np.ndarray

    def weights(self) -> np.ndarray:
        """What each vote of each rule adds to the log odds of a good document."""
        good, bad = np.maximum(self.rates, 1e-300).transpose(2, 0, 1)
        return np.log(good / bad)

    def log_odds(self, votes: Sequence[Column]) -> Column:
        total = F.lit(math.log(self.share_good / (1 - self.share_good)))
        for v, (down, none, up) in zip(votes, self.weights().tolist(), strict=True):
            total = total + F.when(v == -1, down).when(v == 1, up).otherwise(none)
        return total

    def right(self) -> list[tuple[float, float]]:
        """By rule, the probability that a document it votes against is bad, and one it is for good."""
        good, bad = (self.rates * [self.share_good, 1 - self.share_good]).transpose(2, 0, 1)
        sums = np.maximum(good + bad, 1e-300)
        return list(zip((bad / sums)[:, 0].tolist(), (good / sums)[:, 2].tolist(), strict=True))


def estimate(
    votes: np.ndarray, counts: np.ndarray, weight: float = 0.02, steps: int = 500
) -> Accuracies:
    """Accuracies of the rules by expectation-maximisation over patterns of votes and their counts.

    Rules count as independent given the unknown quality. The estimates begin at `START_SHARE`,
    `START_AGAINST` and `START_FOR`, and go on counting as if `weight` times all documents, and one, had
    been seen like that: a rule that never speaks stays close to its beginning, no rate that began
    over 0 gets there, and good does not change places with bad. A rule never seen to vote for a
    document begins with no such votes.
    """
    total = max(float(counts.sum()), 1.0)
    pseudo = weight * total + 1
    cast = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)  # pattern, rule, vote
    speaks = cast[:, :, 2].any(axis=0)
    start = np.zeros((votes.shape[1], 3, 2))
    start[:, 0] = START_AGAINST
    start[speaks, 2] = START_FOR
    start[:, 1] = 1 - start[:, 0] - start[:, 2]
    found = Accuracies(START_SHARE, start)
    for _ in range(steps):
        odds = math.log(found.share_good / (1 - found.share_good))
        odds = odds + (cast * found.weights()).sum(axis=(1, 2))
        good = counts / (1 + np.exp(-np.clip(odds, -500, 500)))
        sums = np.stack([good, counts - good], axis=1)
        rates = np.einsum("prv,pq->rvq", cast, sums) + pseudo * start
        before, found = found, Accuracies(
            float((good.sum() + pseudo * START_SHARE) / (total + pseudo)),
            rates / (sums.sum(axis=0) + pseudo),
        )
        if np.abs(before.rates - found.rates).max() < 1e-10:
            break
    return found


def judge_quality(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """(doc_id, the columns of `COUNTS`, votes, base_failed, quality, kept) of each row of `docs`.

    `votes` has a string of +, - and 0 in the order of `RULES`. Accuracies come from the patterns of
    votes of all rows, at most 3 to the power of the number of rules with a count each, which is what
    reaches the driver; every row then gets its posterior probability `quality` from them. `base_failed`
    are texts of under 10 words or with over a fifth of their words in repeated windows; they are not
    kept, and others are where `quality` is `least` or more.

    A null or empty text has counts of 0 and fails. Repeated rows and null doc_ids give a row each
    and count each, an empty table gives no rows. Other columns are not read.
    """
    counted = staged(text_counts(docs), "counts")
    votes = [vote(*conditions) for conditions in RULES.values()]
    signs = F.concat(*[F.when(v == 1, "+").when(v == -1, "-").otherwise("0") for v in votes])
    voted = counted.withColumn("votes", signs)
    patterns = voted.groupBy("votes").count().collect()
    value = {"+": 1, "-": -1, "0": 0}
    table = np.array([[value[c] for c in p.votes] for p in patterns]).reshape(-1, len(RULES))
    found = estimate(table, np.array([p["count"] for p in patterns], float))
    quality = 1 / (1 + F.exp(-found.log_odds(votes)))
    failed = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    return (
        voted.withColumn("base_failed", failed)
        .withColumn("quality", quality)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    )
