from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from soundings.llm import conversations as c

_SPACE = " \t\n\r\x0b\x0c"
_ROLE = {"u": "user", "a": "assistant"}


def _faults(rows):
    """The first fault of each (role, text)."""
    found, seen = [], set()
    for role, text in rows:
        signs = text.rstrip(_SPACE)
        if not signs:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if signs[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def _all_repairs(rows):
    """Every repair with at most two insertions at a place: (cost, audit, rows)."""
    inserts = [
        [(3 * n, "I" * n, [(_ROLE[r], "") for r in roles])]
        for n in range(3)
        for roles in itertools.product("ua", repeat=n)
    ]
    inserts = [x for group in inserts for x in group]
    edits = []
    for (role, text), fault in zip(rows, _faults(rows), strict=True):
        own = [(4, "D", [])]
        if fault in ("", "truncated"):
            more = 3 * (fault == "truncated")
            own.append((more, "K", [(role, text)]))
            own += [(3 + more, "R", [(r, text)]) for r in _ROLE.values()]
        edits += [inserts, own]
    for parts in itertools.product(*edits, inserts):
        left = [r for p in parts for r in p[2]]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in left)):
            yield sum(p[0] for p in parts), "".join(p[1] for p in parts), left


def _by_states(rows):
    """The same by a table over (row, state), for longer conversations."""
    steps = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    best = {0: (0, "", ()), 3: (0, "", ())}
    faults = _faults(rows)

    def inserted(items):
        for _ in range(3):
            for letter, moves in (("u", steps["u"]), ("a", steps["a"])):
                for q, to in moves.items():
                    if to in items:
                        cost, audit, left = items[to]
                        new = (cost + 3, "I" + audit, ((_ROLE[letter], ""), *left))
                        items[q] = min(items.get(q, new), new)
        return items

    best = inserted(best)
    for (role, text), fault in zip(reversed(rows), reversed(faults), strict=True):
        items = {}
        for q in range(4):
            made = []
            if q in best:
                cost, audit, left = best[q]
                made.append((cost + 4, "D" + audit, left))
            if fault in ("", "truncated"):
                more = 3 * (fault == "truncated")
                kinds = [("K", 0, role)] + [("R", 3, r) for r in _ROLE.values()]
                for letter, price, new in kinds:
                    to = steps.get(new[:1], {}).get(q)
                    if to in best:
                        cost, audit, left = best[to]
                        made.append((cost + price + more, letter + audit, ((new, text), *left)))
            items[q] = min(made)
        best = inserted(items)
    return best[0]


def _conversation(rng, n, roles):
    texts = ["Yes.", "No", " ", "Why?", "", "ok \n", "Fine! \t", "a.b", ".."]
    return [(rng.choice(roles), rng.choice(texts) + rng.choice(["", "", str(rng.random()) + "."])) for _ in range(n)]


def _repair(rows):
    repair = c.Repair()
    for (role, _), fault in zip(reversed(rows), reversed(_faults(rows)), strict=True):
        repair.before(c._code(role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = repair.result()
    made = c._apply(audit, [{"role": r, "text": t} for r, t in rows])
    return cost, audit, [(x["role"], x["text"]) for x in made]


def test_cheapest_of_all_repairs():
    rng = random.Random(1)
    for n in range(4):
        for _ in range(25):
            rows = _conversation(rng, n, ["user", "assistant", "system", "tool", " "])
            assert _repair(rows)[:2] == min(_all_repairs(rows))[:2]
            assert _repair(rows) == min(_all_repairs(rows))


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_long_conversations_in_blocks(monkeypatch, block):
    monkeypatch.setattr(c, "_BLOCK", block)
    rng = random.Random(block)
    for _ in range(150):
        rows = _conversation(rng, rng.randrange(60), ["user", "assistant"] * 4 + ["system", "x", ""])
        cost, audit, left = _by_states(rows)
        assert _repair(rows) == (cost, audit, list(left))


def _expected(rows):
    """The contract, row by row: `rows` are (conv_id, turn, role, text)."""
    by = {}
    for conv, turn, role, text in rows:
        own = by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        own += [(turn, role, text)] * ((kind > 0) + (kind == 3))
    found = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        pairs = [r[1:] for r in own]
        faults, turns = _faults(pairs), {r[0] for r in own if r[0] is not None}
        initials = [r[0][:1] for r in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, left = _by_states(pairs)
        text = "\n".join(f"{r}:{t}" for r, t in left)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        kinds = (faults.count("blank"), faults.count("duplicate"), faults.count("truncated"))
        sha = hashlib.sha256(text.encode()).hexdigest()
        found[conv] = (gaps, *kinds, illegal, cost, audit, sha)
    return found


_KIND = "turn long, extra string, role string, conv_id long, text string, at long, key string"


def _frame(spark, rows):
    return spark.createDataFrame([(t, "x", r, i, x, 7, None) for i, t, r, x in rows], _KIND)


def test_against_the_contract(spark):
    rng = random.Random(5)
    rows = []
    for conv in (*range(120), None):
        for turn in range(rng.randrange(1, 12)):
            role, text = _conversation(rng, 1, ["user", "assistant", "system", None])[0]
            rows.append((conv, rng.choice([turn, turn, turn, None, 3 * turn]), role, rng.choice([text, text, None])))
    rows += rows[:40] + [(500, 0, "user", "Same.")] * 300
    rows += [(501, t, "user", "Same. ") for t in range(6000)]
    found = {r.conv_id: tuple(r)[1:] for r in c.repair_damaged(_frame(spark, rows)).collect()}
    assert found == _expected(rows)
    assert {len(found[x][6]) for x in (500, 501)} != {0}


def test_real_outputs(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "user", "Hello?"), (2, 0, "user", "")]
    frame = _frame(spark, rows)
    reports = c.repair_report(frame)
    assert reports.schema.names[0] == "conv_id" and reports.count() == 2
    turns = c.repaired_turns(frame, reports).collect()
    assert [(t.conv_id, t.at, t.edit, t.role) for t in turns] == [
        (1, 0, "K", "system"),
        (1, 1, "K", "user"),
        (1, 2, "R", "assistant"),
    ]


def test_empty_and_dropped(spark):
    assert c.repair_damaged(_frame(spark, []).limit(0)).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (row,) = c.repair_damaged(_frame(spark, [(gone, 0, "user", "Hi.")])).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
