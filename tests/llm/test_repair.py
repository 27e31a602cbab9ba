"""Repair of conversations against an exhaustive search."""

import hashlib
import heapq
import itertools
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import repair

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
LEGAL = {"su", "ua", "au"}


def fault_of(role, text, seen):
    core = re.sub(r"[\x20\x09-\x0d]+$", "", text)
    if not core:
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return None if core[-1] in ".!?" else "truncated"


def cheapest(rows):
    """The least (cost, edits) over all sequences of edits, by a search over (row, roles so far)."""
    last = {"": "", "s": "s", "u": "u", "a": "a"}
    heap, done = [(0, "", 0, "", ())], {}
    while heap:
        cost, edits, at, state, out = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done[at, state] = True
        if at == len(rows) and state in ("", "a"):
            return cost, edits, out

        def go(more, letter, at, role, text, initial):
            ok = initial == "s" and state == "" or initial == "u" and state in ("", "s", "a") or initial == "a" and state == "u"
            if ok:
                heapq.heappush(heap, (cost + more, edits + letter, at, last[initial], (*out, f"{role}:{text}")))

        for role in ("user", "assistant"):
            go(3, "I", at, role, "", role[0])
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 4, edits + "D", at + 1, state, out))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                go(more, "K", at + 1, role, text, role[:1])
                for given in ("user", "assistant"):
                    go(3 + more, "R", at + 1, given, text, given[0])


def expected(rows):
    """What the query must give; ties of turns go by role and digest of the text."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv]
        role, text = role if role is not None else " ", text if text is not None else " "
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        groups[conv] += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = Counter()
    for conv, held in groups.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, marked = set(), []
        for _, role, text in held:
            marked.append((role, text, fault_of(role, text, seen)))
            seen.add((role, text))
        turns = [r[0] for r in held if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        kinds = Counter(m[2] for m in marked)
        illegal = sum(a[0][:1] + b[0][:1] not in LEGAL for a, b in itertools.pairwise(marked))
        cost, audit, kept = cheapest(marked)
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out[conv, gaps, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, audit, sha] += 1
    return out


def drawn(seed, n_conv, length):
    import random

    draw = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \t", "Go!  ", "wait \n", "é.", " ", "a.b", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "agent"]
    rows = []
    for conv in range(n_conv):
        for k in range(draw.randrange(1, length)):
            turn = draw.choice([k, k, k, k + draw.randrange(3), None, -k])
            rows.append((conv or None, turn, draw.choice(roles), draw.choice(texts)))
    return rows


def found(spark, rows, tmp_path):
    spark.createDataFrame(rows, ROWS).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return Counter(tuple(r) for r in repair.op13_conversation_repair(spark, str(tmp_path)).collect())


def test_the_table_is_small_enough_for_a_byte():
    assert len(repair.CODES) <= 256


@pytest.mark.parametrize("length", range(5))
def test_all_short_conversations(length):
    """Every sequence of initials and faults, against the search."""
    kinds = [(i, f) for i in "sua?" for f in (None, "duplicate", "truncated")]
    names = {None: repair.FINE, "duplicate": repair.REPEATED, "truncated": repair.CUT}
    for rows in itertools.product(kinds, repeat=length) if length < 4 else itertools.islice(itertools.product(kinds, repeat=4), 0, None, 7):
        walk = repair.Walk()
        for initial, fault in reversed(rows):
            walk.add(None, 4 * "sua?".index(initial) + names[fault])
        cost, audit, _ = cheapest([(i, "t", f) for i, f in rows])
        assert walk.result()[-2:] == (cost, audit), rows


def test_pointers_beyond_memory(monkeypatch):
    monkeypatch.setattr(repair, "SPILL", 7)
    pointers = repair.Pointers()
    for k in range(100):
        pointers.add(k)
    assert pointers.file is not None and list(pointers.backwards()) == list(reversed(range(100)))


def test_equals_the_search(spark, tmp_path):
    rows = drawn(1, 60, 9) + [(70, 0, "user", "x" * 200000 + "."), (70, 1, "assistant", "y.")] * 2
    assert found(spark, rows, tmp_path) == expected(rows)


def test_state_goes_on_over_batches(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rows = drawn(2, 12, 30)
        assert found(spark, rows, tmp_path) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_conversations_without_rows(spark, tmp_path):
    drops = [n for n in range(400) if zlib.crc32(f"{n}:0".encode()) % 20 == 0]
    rows = [(n, 0, "user", "Hi.") for n in drops]
    got = found(spark, rows, tmp_path / "a")
    assert got == Counter({(n, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()): 1 for n in drops})
    assert repair.repair(spark.createDataFrame([], ROWS)).count() == 0
    assert found(spark, [], tmp_path / "b") == Counter()


def test_repaired_rows(spark):
    rows = [(1, 5, "user", "Hi."), (1, 6, "user", "And?"), (1, 7, "tool", "Ok."), (2, None, "assistant", "Well."), (None, 0, "user", None)]
    clash = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("own") for c in ("place", "kind", "edit", "conv", "digest", "cost", "fault")})
    out = repair.repair(clash)
    assert out.columns == ["conv_id", "place", "turn", "role", "text", "edit"]
    got = {}
    for r in out.orderBy("conv_id", "place").collect():
        got.setdefault(r["conv_id"], []).append((r["place"], r["turn"], r["role"], r["text"], r["edit"]))
    assert got == {
        1: [(0, 5, "user", "Hi.", "K"), (1, None, "assistant", "", "I"), (2, 6, "user", "And?", "K"), (3, 7, "assistant", "Ok.", "R")],
        2: [(0, None, "user", "", "I"), (1, None, "assistant", "Well.", "K")],
    }


def test_a_long_conversation(spark):
    rows = spark.range(200000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"))
    done = repair.digests(rows).collect()
    assert len(done) == 1 and done[0]["audit"] == "K" * 200000 and done[0]["cost"] == 0
