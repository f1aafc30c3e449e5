"""Credentials in texts, with weak candidates linked to complementary parts nearby."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundings.llm.common import staged, whole_text

#: Kinds in the order of reports. The first three are reported always, the others if linked.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")

# The forms that are always reported.
_ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

_NAMED_IDENTIFIER = re.compile(
    r"(?ai:(client_?id|access_?key_?id|account|user(?:name)?|login))[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9_.@-]{4,})"
)
_BARE_IDENTIFIER = re.compile(r"(?<![A-Za-z0-9])[A-Z0-9]{16,32}(?![A-Za-z0-9])")
_BARE_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_ENDPOINT = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:https?|ftp|jdbc|redis|mongodb|postgres(?:ql)?)://[^\s\"'<>]+"
    r"|[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:[0-9]{2,5}(?![0-9]))"
)
_SPAN = "array<struct<start:int,kind:int,end:int>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what is reported always, per kind leftmost and non-overlapping."""
    found = []
    lower = text.lower()
    if any(word in lower for word in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16
        ]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that alone mean little, clear of the base spans and of each other."""
    found = [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)] if ":" in text else []
    found += [(m.start(2), 3, m.end(2)) for m in _NAMED_IDENTIFIER.finditer(text)] if (
        ":" in text or "=" in text
    ) else []
    found += [
        (m.start(), 3, m.end())
        for m in _BARE_IDENTIFIER.finditer(text)
        if any(map(str.isdigit, m[0])) and any(map(str.isupper, m[0]))
    ]
    found += [(m.start(), 4, m.end()) for m in _BARE_SECRET.finditer(text) if _looks_random(m[0])]
    free, taken = [], sorted((start, end) for start, _, end in base)
    for span in sorted(found, key=lambda s: (s[0], -s[2], s[1])):
        if free and span[0] < free[-1][2]:
            continue
        while taken and taken[0][1] <= span[0]:
            taken.pop(0)
        if not taken or taken[0][0] >= span[2]:
            free.append(span)
    return free


def _looks_random(text: str) -> bool:
    kinds = (str.islower, str.isupper, str.isdigit)
    if not all(any(map(kind, text)) for kind in kinds):
        return False
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) >= 3.5


def scan_parts(docs: DataFrame) -> DataFrame:
    """doc_id, base and weak spans of every whole text."""

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, weak = [], []
            for text in batch["text"]:
                base.append(base_spans(text))
                weak.append(weak_spans(text, base[-1]))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "base": base, "weak": weak})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInPandas(scanned, f"doc_id long, base {_SPAN}, weak {_SPAN}")


def linked_spans(parts: DataFrame, scope: int) -> DataFrame:
    """(row, linked): weak spans with complementary parts within `scope` characters.

    An interval join: parts are laid into bins of `scope` characters of their document, and a
    weak span looks into the bins its scope touches. An identifier needs a secret nearby, a
    secret an identifier, an endpoint both.
    """
    part = lambda spans: F.explode(spans).alias("span")
    binned = lambda low, high: F.explode(
        F.sequence(F.floor(low / scope), F.floor(high / scope))
    ).alias("bin")
    near = parts.filter("size(weak) > 0")
    weak = near.select("row", part("weak")).select(
        "row", "span", binned(F.col("span.start") - scope, F.col("span.end") + scope)
    )
    others = near.select("row", part(F.concat("base", "weak"))).select(
        "row", F.col("span").alias("other"), binned(F.col("span.start"), F.col("span.end") - 1)
    )
    close = (F.col("other.end") > F.col("span.start") - scope) & (
        F.col("other.start") < F.col("span.end") + scope
    )
    kind = F.col("other.kind")
    met = (
        weak.join(others, ["row", "bin"])
        .filter(close & (F.col("other") != F.col("span")))
        .groupBy("row", "span")
        .agg(
            F.max(kind.isin(1, 3)).alias("identifier"),
            F.max(kind.isin(0, 2, 4)).alias("secret"),
        )
    )
    told = (
        F.when(F.col("span.kind") == 3, F.col("secret"))
        .when(F.col("span.kind") == 4, F.col("identifier"))
        .otherwise(F.col("secret") & F.col("identifier"))
    )
    return met.filter(told).groupBy("row").agg(F.collect_list("span").alias("linked"))


def scan_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """The secrets of every document.

    Returns doc_id, n_assign, n_access, n_hex, n_linked, base_sha256 and spans: `kind:start:end`
    in code points, end exclusive, by start and kind. Null and empty texts have no spans; repeated
    rows are reported each; an empty table gives no rows.
    """
    parts = scan_parts(docs).withColumn("row", F.monotonically_increasing_id())
    parts = staged(parts, "secret-parts")
    linked = linked_spans(parts, scope)
    found = parts.join(linked, "row", "left")
    none = F.array().cast(_SPAN)
    linked_or_none = F.coalesce("linked", none)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.size(linked_or_none).cast("long").alias("n_linked"),
        F.sha2(_report(F.col("base")), 256).alias("base_sha256"),
        _report(F.concat("base", linked_or_none)).alias("spans"),
    )


def _report(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    told = lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
    )
    return F.array_join(F.transform(F.array_sort(spans), told), ",")
