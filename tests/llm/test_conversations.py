"""Conversation repair: search against exhaustive enumeration, digests, edge rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest

from paystrata.llm import conversations as C

COST = {"D": C.DELETE, "K": 0, "R": C.RETYPE}


def brute(initials: str, faults: str) -> tuple[int, str]:
    """All sequences with at most two insertions before each row and at the end."""
    best = (10 ** 9, "")
    n = len(initials)
    for edits in itertools.product(*["D" if f in "bd" else "DKR" for f in faults]):
        fixed = [i if e == "K" else "?" if e == "R" else "" for i, e in zip(initials, edits)]
        paid = sum(COST[e] + (5 if f == "t" and e != "D" else 0) for e, f in zip(edits, faults))
        for ins in itertools.product(range(3), repeat=n + 1):
            total = paid + 5 * sum(ins)
            audit = "".join("I" * k + e for k, e in zip(ins, edits)) + "I" * ins[n]
            if (total, audit) >= best:
                continue
            roles = "".join("?" * k + r for k, r in zip(ins, fixed)) + "?" * ins[n]
            if any(re.fullmatch("(s?(ua)+)?", w) for w in fills(roles)):
                best = (total, audit)
    return best


def fills(roles: str):
    """The two ways a wild card can alternate."""
    body = roles[1:] if roles.startswith("s") else roles
    out = "".join("ua"[i % 2] if c == "?" else c for i, c in enumerate(body))
    return [roles[: len(roles) - len(body)] + out]


@pytest.mark.parametrize("seed", range(60))
def test_search_finds_what_enumeration_finds(seed):
    rng = random.Random(seed)
    n = rng.randint(0, 4)
    initials = "".join(rng.choice("suax") for _ in range(n))
    faults = "".join(rng.choice("...tbd") for _ in range(n))
    assert C.cheapest(initials, faults) == brute(initials, faults)


def test_long_conversations_end():
    rng = random.Random(1)
    for kinds in ("ssssua", "ua", "aaau", "s"):
        initials = "".join(rng.choice(kinds) for _ in range(20_000))
        faults = "".join(rng.choice("....tbd") for _ in range(20_000))
        cost, audit = C.cheapest(initials, faults)
        assert sum(c != "I" for c in audit) == 20_000 and cost <= 40_000


def test_bound_never_exceeds_the_rest():
    rng = random.Random(2)
    for _ in range(40):
        n = rng.randint(0, 3)
        initials, faults = "".join(rng.choice("suax") for _ in range(n)), "".join(rng.choice("..tb") for _ in range(n))
        assert C.suffix_bounds(initials, faults)[C.NONE][0] <= brute(initials, faults)[0]


def rows(spark, data):
    return spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string, gone boolean, seq int, edit string, audit string")


def repaired(spark, data):
    frame = rows(spark, [(*r, 7, "x", "y") for r in data])
    return {r.conv_id: r for r in C.report(C.repair(frame)).collect()}


def test_rows_edits_and_digest(spark):
    got = repaired(spark, [
        (1, 0, "system", "Be kind.", False), (1, 1, "user", "Why?", False), (1, 1, "user", "Why?", False), (1, 4, "assistant", "So.", False),
        (2, 0, "user", "a", True),
        (3, None, None, None, False), (3, 5, "user", "Hello.\x0b", False), (3, 9, "user", "open", False),
        (None, 1, "tool", "x!", False), (None, 2, "assistant", "y!", False),
        (4, 1, "", "x.", False), (4, 2, "assistant", "y.", False)])
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].audit == "KKDK" and got[1].duplicate == 1 and got[1].gaps == 2 and got[1].illegal == 1 and got[1].cost == 2
    assert got[1].repaired_sha256 == sha("system:Be kind.\nuser:Why?\nassistant:So.")
    assert (got[2].audit, got[2].cost, got[2].repaired_sha256) == ("", 0, sha(""))
    # A blank row, one that ends, one that does not: delete the last two, or answer the first (5) and delete the last.
    assert got[3].audit == "DDD" and (got[3].blank, got[3].truncated, got[3].gaps, got[3].cost) == (1, 1, 3, 6)
    assert got[None].audit == "RK" and got[None].repaired_sha256 == sha("user:x!\nassistant:y!")
    assert got[4].audit == "RK" and got[4].illegal == 1


def test_empty_table_and_repeated_rows(spark):
    assert not repaired(spark, [])
    same = [(1, 0, "user", "a.", False)] * 3 + [(1, 1, "assistant", "b.", False)] * 2
    assert repaired(spark, same)[1].audit == "KDDKD"


def test_long_texts_leave_memory(spark, monkeypatch):
    monkeypatch.setattr(C, "_MEMORY", 1000)
    text = "wörd " * 50_000 + "."
    got = repaired(spark, [(1, 0, "user", text, False), (1, 1, "assistant", text, False)])
    assert got[1].audit == "KK" and got[1].repaired_sha256 == hashlib.sha256(f"user:{text}\nassistant:{text}".encode()).hexdigest()


def test_damage_cases(spark):
    import zlib
    data = [(i, t, "assistant", "One. Two!") for i in range(60) for t in range(3)]
    frame = spark.createDataFrame([(*r, 0) for r in data], "conv_id bigint, turn bigint, role string, text string, copy int")
    got = [tuple(r) for r in C.damaged(frame).collect()]
    want = []
    for i, t, role, text in data:
        case = zlib.crc32(f"{i}:{t}".encode()) % 20
        row = (i, t, "user" if case == 4 else role, "" if case == 1 else "One Two" if case == 2 else text, case == 0)
        want += [row] * (2 if case == 3 else 1)
    assert sorted(got) == sorted(want)
