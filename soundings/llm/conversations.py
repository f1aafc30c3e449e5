"""Repair of conversations as a lightest derivation, found by Knuth's agenda."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundings.llm.common import staged, text_key

_SPACE = " \t\n\r\x0b\x0c"
_MARKS = ".!?"
_ROLES = {"u": "user", "a": "assistant"}

# The automaton of (s?(ua)+)?: nothing yet, after s, after u, after a.
_NONE, _AFTER_S, _AFTER_U, _AFTER_A = range(4)
_STEP = {
    "s": {_NONE: _AFTER_S},
    "u": {_NONE: _AFTER_U, _AFTER_S: _AFTER_U, _AFTER_A: _AFTER_U},
    "a": {_AFTER_U: _AFTER_A},
}
#: What a state lets follow by Rerole and Insert, which make no s: always one of the two.
_NEXT = {_NONE: "u", _AFTER_S: "u", _AFTER_U: "a", _AFTER_A: "u"}
_BACK = {c: {to: [f for f in steps if steps[f] == to] for to in range(4)} for c, steps in _STEP.items()}
_BY_NEXT = {to: [f for f in range(4) if _STEP[_NEXT[f]][f] == to] for to in range(4)}

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3

# A code says what an edit needs to know of a row: role initial, to be deleted, truncated.
_GONE, _CUT = 8, 16
_INITIALS = "sua"
_BLOCK = 4096


def _code(initial: str, gone: bool, truncated: bool) -> int:
    return (_INITIALS.find(initial) + 1 if initial else 0) | gone * _GONE | truncated * _CUT


def derive(
    codes: bytes, after: tuple[int | None, ...], goal: bool
) -> tuple[list[int | None], list[bytearray]]:
    """Lightest derivations of the items (i, q): rows i and on, repaired from state q.

    `codes` are the rows of a block and `after` the costs of the four items behind it. An item is
    deduced from (i + 1, p) by an edit of row i, or from (i, p) by an insertion, p being the state
    that follows. Its weight is the cost, and among equals the least string of edits, the new one in
    front. Items leave the agenda by cost, then by the rows they cover: in this order every
    deduction weighs more than what it is made from, so an item that leaves is final. Two deductions
    of an item start with different letters, so these alone decide between equal costs.

    Returned are the costs at the start of the block and by state the first letter of every item.
    The agenda stops when all four, or with `goal` the item (0, nothing yet), are final.
    """
    n = len(codes)
    weight: dict[tuple[int, int], tuple[int, str]] = {}
    letters = [bytearray(n + 1) for _ in range(4)]
    agenda: list[tuple[int, int, int]] = []

    def deduce(i: int, q: int, cost: int, letter: str) -> None:
        known = weight.get((i, q))
        if known is None or (cost, letter) < known:
            if known is None or cost < known[0]:
                heappush(agenda, (cost, n - i, q))
            weight[i, q] = (cost, letter)

    for q, cost in enumerate(after):
        if cost is not None:
            deduce(n, q, cost, "")
    final: set[tuple[int, int]] = set()
    starts: list[int | None] = [None] * 4
    while agenda:
        cost, covered, p = heappop(agenda)
        i = n - covered
        if (i, p) in final:
            continue
        final.add((i, p))
        if letter := weight[i, p][1]:
            letters[p][i] = ord(letter)
        if not i:
            starts[p] = cost
            if p == _NONE if goal else None not in starts:
                break
        for q in _BY_NEXT[p]:
            deduce(i, q, cost + INSERT, "I")
        if i:
            code = codes[i - 1]
            deduce(i - 1, p, cost + DELETE, "D")
            if not code & _GONE:
                more = UNFINISHED if code & _CUT else 0
                for q in _BY_NEXT[p]:
                    deduce(i - 1, q, cost + REROLE + more, "R")
                if initial := code & 7:
                    for q in _BACK[_INITIALS[initial - 1]][p]:
                        deduce(i - 1, q, cost + KEEP + more, "K")
    return starts, letters


class Repair:
    """The cheapest edits of one conversation, whose rows are told from the last to the first.

    Rows are derived in blocks; of finished blocks it holds a code and four letters a row.
    """

    def __init__(self) -> None:
        self._open = bytearray()
        self._blocks: list[tuple[bytes, list[bytearray]]] = []
        self._after: tuple[int | None, ...] = (0, None, None, 0)

    def before(self, code: int) -> None:
        self._open.append(code)
        if len(self._open) == _BLOCK:
            self._close(goal=False)

    def _close(self, goal: bool) -> None:
        codes = bytes(reversed(self._open))
        starts, letters = derive(codes, self._after, goal)
        self._blocks.append((codes, letters))
        self._after, self._open = tuple(starts), bytearray()

    def result(self) -> tuple[int, str]:
        """Cost and edits."""
        self._close(goal=True)
        edits, state = [], _NONE
        for codes, letters in reversed(self._blocks):
            i = 0
            while True:
                letter = chr(letters[state][i])
                if i == len(codes) and letter != "I":
                    break  # the item is the next block's first
                edits.append(letter)
                if letter == "K":
                    state = _STEP[_INITIALS[(codes[i] & 7) - 1]][state]
                elif letter in "RI":
                    state = _STEP[_NEXT[state]][state]
                i += letter != "I"
        return self._after[_NONE], "".join(edits)


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, with one space for a null role or text, and a hash of the text."""
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    ).withColumn("key", text_key(F.col("text")))


def _seen(turns: DataFrame) -> DataFrame:
    """Distinct rows with the number of their copies and whether role and text were seen earlier.

    Copies are counted before the shuffle. First turns are looked up by conversation, role and text
    with a join, which adaptive execution splits where one text is much repeated.
    """
    signs = F.rtrim(F.col("text"), F.lit(_SPACE))
    last = F.substring(signs, -1, 1)
    marked = turns.select(
        "conv_id",
        "turn",
        "role",
        "key",
        (signs == "").alias("blank"),
        (~last.isin(*_MARKS)).alias("cut"),
    )
    rows = marked.groupBy(*marked.columns).agg(F.count("*").alias("copies"))
    # A null turn comes first.
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    firsts = rows.groupBy(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k")
    ).agg(F.min(place).alias("first"))
    same = F.expr("conv_id <=> c AND role = r AND key = k")
    earlier = ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return rows.join(firsts, same).select(*rows.columns, earlier.alias("earlier"))


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_LEGAL = ("su", "ua", "au")


def _one_report(rows: Iterable[dict]) -> dict:
    """The report of one conversation, from its rows from the last to the first."""
    blank = duplicate = truncated = illegal = turns = 0
    newest = oldest = following = None
    repair = Repair()
    for row in rows:
        copies, initial = row["copies"], row["role"][:1]
        if row["turn"] is not None and row["turn"] != oldest:
            turns, oldest = turns + 1, row["turn"]
            newest = oldest if newest is None else newest
        repeated = copies - (not row["earlier"])
        if row["blank"]:
            blank += copies
            repeated = copies
        else:
            duplicate += repeated
        for _ in range(repeated):
            repair.before(_code(initial, True, False))
        if repeated < copies:
            truncated += row["cut"]
            repair.before(_code(initial, False, row["cut"]))
        illegal += copies - 1  # no role may follow itself
        if following is not None:
            illegal += initial + following not in _LEGAL
        following = initial
    cost, audit = repair.result()
    return {
        "gaps": newest - oldest + 1 - turns if turns else 0,
        "blank": blank,
        "duplicate": duplicate,
        "truncated": truncated,
        "illegal": illegal,
        "cost": cost,
        "audit": audit,
    }


def _by_conversation(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[object, Iterator[dict]]]:
    """Each conversation of a sorted partition with its rows, which come one by one."""
    rows = (row for batch in batches for row in batch.to_pylist())
    row = next(rows, None)
    while row is not None:
        key = row["conv_id"]

        def own() -> Iterator[dict]:
            nonlocal row
            while row is not None and row["conv_id"] == key:
                yield row
                row = next(rows, None)

        mine = own()
        yield key, mine
        for _ in mine:
            pass


def _batched(rows: Iterable[dict], schema: pa.Schema, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row.values() if isinstance(v, str))
        if size >= most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(df: DataFrame, more: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType([df.schema["conv_id"], *StructType.fromDDL(more)])
    return schema, to_arrow_schema(schema)


def repair_report(conversations: DataFrame) -> DataFrame:
    """Faults and cheapest repair of each conversation in `conversations` (conv_id, turn, role, text).

    Rows count in the order of turns, null first; of one turn by role, then by a hash of the text.
    The first fault of a row counts: blank (only ASCII white space), duplicate (role and text seen
    earlier), truncated (the last character that is no white space is none of . ! ?). `gaps` are
    missing turn numbers, `illegal` neighbours whose role initials may not follow each other.

    `audit` has the initials of the cheapest edits in order that make the role initials read
    (s?(ua)+)?, least by ASCII where several are: Keep costs 0, Rerole to user or assistant 3, Delete 4
    (which blanks and duplicates need), Insert an empty user or assistant row 3, and a truncated
    row that is not deleted 3 more.

    A null role or text counts as one space, null conv_ids are one conversation, null turns add no
    gap, equal rows are counted before they are shuffled, other columns are not read, and an empty
    table gives no rows. A conversation is read by one task as a sorted stream, since its edits make one
    value; that task holds five bytes or so of each of its rows, and no text.
    """
    rows = _seen(_turns(conversations))
    schema, arrow = _arrow(conversations, _REPORT)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ({"conv_id": key} | _one_report(rows) for key, rows in _by_conversation(batches))
        return _batched(found, arrow)

    down = [F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("key").desc()]
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", *down)
    return ordered.mapInArrow(report, schema)


_TURN = "at long, edit string, role string, text string"


def _apply(audit: str, rows: Iterable[dict]) -> Iterator[dict]:
    """The rows left by the edits, in order, with the edit that made each."""
    state, at = _NONE, 0
    edits = iter(audit)

    def made(edit: str, role: str, text: str) -> dict:
        nonlocal state, at
        state = _STEP[role[:1]][state]
        at += 1
        return {"at": at - 1, "edit": edit, "role": role, "text": text}

    for row in rows:
        while (edit := next(edits)) == "I":
            yield made("I", _ROLES[_NEXT[state]], "")
        if edit != "D":
            role = row["role"] if edit == "K" else _ROLES[_NEXT[state]]
            yield made(edit, role, row["text"])
    for _ in edits:
        yield made("I", _ROLES[_NEXT[state]], "")


def repaired_turns(conversations: DataFrame, reports: DataFrame) -> DataFrame:
    """(conv_id, at, edit, role, text): the rows of each conversation after the edits of its report.

    `reports` comes from :func:`repair_report` of the same rows, best stored. Rows of a conversation
    follow each other in order, numbered by `at`, within one partition. A conversation of which nothing
    is left has none.
    """
    turns = _turns(conversations)
    orders = reports.select("conv_id", F.lit(False).alias("is_turn"), "audit")
    rows = turns.withColumn("is_turn", F.lit(True))
    both = orders.unionByName(rows, allowMissingColumns=True)
    schema, arrow = _arrow(conversations, _TURN)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def left() -> Iterator[dict]:
            for key, rows in _by_conversation(batches):
                audit = next(rows)["audit"]  # sorts before the turns
                for row in _apply(audit, rows):
                    yield {"conv_id": key} | row

        return _batched(left(), arrow)

    up = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")]
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "is_turn", *up)
    return ordered.mapInArrow(repair, schema)


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of the `role:text` of :func:`repaired_turns`, joined by
    newlines. It reads the rows as that function leaves them, in order, without another shuffle."""
    schema, arrow = _arrow(turns, "repaired_sha256 string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for key, rows in _by_conversation(batches):
                sha = hashlib.sha256()
                for row in rows:
                    line = f"{row['role']}:{row['text']}"
                    sha.update((f"\n{line}" if row["at"] else line).encode())
                yield {"conv_id": key, "repaired_sha256": sha.hexdigest()}

        return _batched(found(), arrow)

    return turns.select("conv_id", "at", "role", "text").mapInArrow(digest, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of `conversations` (conv_id, turn, role, text) with faults put in by a hash.

    Nulls count as one space where text is needed. By the CRC-32 of `conv_id:turn` modulo 20, 0 drops
    a row, 1 empties its text, 2 takes its . ! ? out, 3 repeats it and 4 makes its role user.
    """
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    )
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")
    ).filter("kind <> 0")
    without = F.translate("text", _MARKS, "")
    damaged = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, without)
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    )
    return damaged.drop("copy")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of `conversations`: the report of its rows after :func:`damage`, and the
    hash of the repaired ones. A conversation of which damage leaves no row has zeros, an empty
    audit and the hash of an empty text."""
    damaged = damage(conversations)
    reports = staged(repair_report(damaged), "reports")
    digests = turn_digests(repaired_turns(damaged, reports))
    found = conversations.select("conv_id").distinct()
    for part in (reports, digests):
        part = part.withColumnRenamed("conv_id", "_conv")
        same = F.col("conv_id").eqNullSafe(F.col("_conv"))
        found = found.join(part, same, "left").drop("_conv")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
