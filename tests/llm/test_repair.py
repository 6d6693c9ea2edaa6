"""Conversation repair against an exhaustive search, and awkward tables."""

import hashlib
import heapq
import random

from quire.llm import repair
from quire.llm.repair import CUT, INITIALS, LETTERS

SCHEMA = "conv_id long, turn long, role string, text string, phase string, letter string, digest string, copies string"


def search(letters):
    """Cheapest (cost, audit) by uniform-cost search over (place, state)."""
    heap, seen = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if at == len(letters) and state in repair.FINAL:
            return cost, audit
        if (at, state) in seen:
            continue
        seen.add((at, state))
        for (p, to), q in repair.NEXT.items():
            if p == state and to != "s":
                heapq.heappush(heap, (cost + 2, audit + "I", at, q))
        if at < len(letters):
            role, fault = divmod(LETTERS.index(letters[at]), 4)
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state))
            if fault <= CUT:
                for (p, to), q in repair.NEXT.items():
                    if p == state and role < 3 and INITIALS[role] == to:
                        heapq.heappush(heap, (cost + fault, audit + "K", at + 1, q))
                    if p == state and to != "s":
                        heapq.heappush(heap, (cost + 2 + fault, audit + "R", at + 1, q))


def test_parse_is_the_cheapest_and_least():
    r = random.Random(7)
    for n in [*range(12)] * 60 + [30, 77, 400]:
        letters = "".join(r.choice(LETTERS) for _ in range(n))
        assert repair.parse(letters) == search(letters)


def test_long_conversations_are_parsed_in_chunks(monkeypatch):
    letters = "".join(random.Random(1).choice(LETTERS) for _ in range(300))
    whole = repair.parse(letters)
    monkeypatch.setattr(repair, "CHUNK", 7)
    assert repair.parse(letters) == whole


def talk(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


def undamaged(df):
    from pyspark.sql import functions as F
    return df.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_defined_cases(spark):
    rows = [
        (1, 0, "system", "s."), (1, 1, "user", "q?"), (1, 2, "assistant", "a!"),
        (2, 0, "assistant", "a."), (2, 3, "user", "cut"),
        (3, 0, "user", " \t\n"), (3, 1, None, None), (3, None, "user", ""),
        (4, 0, "user", "same."), (4, 0, "user", "same."), (4, 1, "assistant", "é ."), (4, 5, "user", "same."),
        (None, None, "tool", "t."), (5, None, "user", "x." * 50_000), (5, None, "assistant", "b.\n")]
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair_report(undamaged(talk(spark, rows))).collect()}
    assert got[1] == (0, 0, 0, 0, 0, 0, "KKK", sha("system:s.\nuser:q?\nassistant:a!"))
    assert got[2] == (2, 0, 0, 1, 0, 5, "IKD", sha("user:\nassistant:a."))
    assert got[3] == (0, 3, 0, 0, 2, 9, "DDD", sha(""))
    assert got[4] == (3, 0, 2, 0, 1, 6, "KDKD", sha("user:same.\nassistant:é ."))
    assert got[None] == (0, 0, 0, 0, 0, 3, "D", sha(""))
    # a null turn comes first, ties go by role: assistant before user
    assert got[5] == (0, 0, 0, 0, 0, 4, "IKKI", sha("user:\nassistant:b.\n\nuser:" + "x." * 50_000 + "\nassistant:"))
    turns = repair.repaired_turns(undamaged(talk(spark, rows))).where("conv_id = 2").orderBy("place").collect()
    assert [(t.edit, t.turn, t.role, t.text) for t in turns] == [
        ("insert", None, "user", ""), ("keep", 0, "assistant", "a.")]


def test_damage_and_empty_tables(spark):
    import zlib
    rows = [(i, t, "assistant", f"One. Two{t}!") for i in range(30) for t in range(4)]
    got = {(r.conv_id, r.turn): (r.role, r.text, r.copies) for r in repair.damaged(talk(spark, rows)).collect()}
    for i, t, role, text in rows:
        k = zlib.crc32(f"{i}:{t}".encode()) % 20
        assert got[i, t] == ("user" if k == 4 else role, {1: "", 2: f"One Two{t}"}.get(k, text), {0: 0, 3: 2}.get(k, 1))
    nulls = repair.damaged(talk(spark, [(None, None, None, None)])).collect()
    assert len(nulls) == 1 and zlib.crc32(b" : ") % 20 not in (0, 3, 4) and nulls[0].role == " "
    assert repair.repair_report(repair.damaged(talk(spark, []))).collect() == []
    gone = repair.damaged(talk(spark, rows)).where("copies = 0")
    assert gone.count() > 0
    for r in repair.repair_report(gone).collect():
        assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", sha(""))
