"""Conversation repair against a plain dynamic program over whole strings."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from shiftline.llm import conversations as C

TURNS = "conv_id long, turn long, role string, text string, piece string, _position long"
BLANKS = " \t\n\x0b\x0c\r"


def plain(rows):
    """What ``repair_report`` says about one conversation's rows (turn, role, text)."""
    rows = sorted(
        ((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
        key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()),
    )
    counts, seen, faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), []
    for _, role, text in rows:
        last = text.rstrip(BLANKS)[-1:]
        fault = (
            "blank" if not last
            else "duplicate" if (role, text) in seen
            else "truncated" if last not in ".!?"
            else None
        )
        seen.add((role, text))
        faults.append(fault)
        if fault:
            counts[fault] += 1
    turns = {t for t, _, _ in rows if t is not None}
    best = {"": (0, "", ())}  # by the end of the roles so far: "", "s", "u", "a"

    def follow(end):
        return ("a", "assistant") if end == "u" else ("u", "user")

    def inserted(ends):
        ends = dict(ends)
        for _ in range(4):
            for end, (cost, audit, lines) in list(ends.items()):
                then, role = follow(end)
                offer = (cost + 3, audit + "I", (*lines, f"{role}:"))
                ends[then] = min(ends.get(then, offer), offer)
        return ends

    for (_, role, text), fault in zip(rows, faults, strict=True):
        made = defaultdict(list)
        for end, (cost, audit, lines) in inserted(best).items():
            made[end].append((cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault else 0
            then, name = follow(end)
            made[then].append((cost + 3 + more, audit + "R", (*lines, f"{name}:{text}")))
            if role[:1] == then or (role[:1] == "s" and end == ""):
                made[role[0]].append((cost + more, audit + "K", (*lines, f"{role}:{text}")))
        best = {end: min(offers) for end, offers in made.items()}
    ends = inserted(best)
    cost, audit, lines = min(ends[e] for e in ("", "a") if e in ends)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **counts,
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }, lines


def some_rows(rng):
    rows = []
    roles = ["user", "assistant", "system", "tool", "", None, "User", "ub", "é"]
    texts = ["Yes.", "No", "Why?", "", " \n", "Yes. ", None, "a. ", "x" * 5000 + "!", "\x85"]
    for conv in range(60):
        turn = 0
        for _ in range(rng.randint(0, 9)):
            turn += rng.choice([0, 1, 1, 1, 3])
            known = rng.random() < 0.7
            role = ("user", "assistant")[turn % 2] if known else rng.choice(roles)
            text = f"t{turn}." if known else rng.choice(texts)
            rows.append((conv, turn if rng.random() < 0.95 else None, role, text))
    rows += [(None, 3, "user", "a."), (None, None, "assistant", "b."), (None, -2, None, None)]
    # One conversation with most rows: long runs of one symbol, and rows that all repeat.
    rows += [(70, i, "user", f"q{i}.") for i in range(700)]
    rows += [(70, 700 + i, ("user", "assistant")[i % 2], f"r{i}." if i % 5 else f"r{i}") for i in range(600)]
    rows += [(70, 2000, "tool", "again!")] * 500
    rows += [(71, i, "system", f"s{i}!") for i in range(40)]
    return rows + rows[5:9]


@pytest.mark.parametrize("coalesced", ["false"])
def test_repair(spark, coalesced):
    """Without coalescing the long conversation lies in several ranges."""
    rows = some_rows(random.Random(3))
    by_id = defaultdict(list)
    for conv, *row in rows:
        by_id[conv].append(row)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, coalesced)
    try:
        df = spark.createDataFrame([(*r, "x", 5) for r in rows], TURNS).repartition(5)
        found = {r["conv_id"]: r.asDict() for r in C.repair_report(df).collect()}
        lines = defaultdict(list)
        for r in C.repaired_turns(df).collect():
            lines[r["conv_id"]].append((r["place"], f"{r['role']}:{r['text']}"))
    finally:
        spark.conf.unset(name)
    assert found.keys() == by_id.keys()
    for conv, own in by_id.items():
        wanted, repaired = plain(own)
        assert found[conv] == {"conv_id": conv, **wanted}, conv
        assert sorted(lines[conv]) == list(enumerate(repaired))


def test_conversations_without_rows(spark):
    rows = [(1, 0, "user", "a.", "", 0), (2, 0, "user", "b.", "", 0), (None, None, "user", "", "", 0)]
    all_rows = spark.createDataFrame(rows, TURNS)
    found = {r["conv_id"]: r for r in C.repair_report(all_rows.where("conv_id = 1"), all_rows).collect()}
    assert set(found) == {1, 2, None}
    assert (found[2]["audit"], found[2]["cost"], found[2]["gaps"]) == ("", 0, 0)
    assert found[2]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert found[1]["audit"] == "KI"
    nothing = all_rows.limit(0)
    assert C.repair_report(nothing).count() == 0
    assert C.repaired_turns(nothing).count() == 0
    assert C.repaired_turns(all_rows.where("text = ''")).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", "Is it? Yes. No!") for c in range(30) for t in range(4)]
    rows += [(None, None, None, None), (5, None, "system", "")]
    wanted = []
    for conv, turn, role, text in rows:
        said = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(said.encode()) % 20
        role, text = role or " ", " " if text is None else text
        text = "" if code == 1 else text.translate({ord(c): None for c in ".!?"}) if code == 2 else text
        role = "user" if code == 4 else role
        wanted += [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = [tuple(r) for r in C.damaged(df).collect()]
    assert sorted(map(str, found)) == sorted(map(str, wanted))


def test_powers_give_what_single_steps_give():
    for symbol in range(C.SYMBOLS):
        ahead = C.END
        for count in range(1, 40):
            ahead = C._before(symbol, ahead)
            assert C._ahead_of_runs([(symbol, count)], C.END)[0] == ahead
            assert C.applied(C.matrix_of([(symbol, count)]), C.END) == ahead
