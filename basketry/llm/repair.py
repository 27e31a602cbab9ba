"""Repair of the structure of conversations: a stream sorted by conversation and turn that carries the state of a dynamic program.

A conversation should be nothing, or user and assistant in turns, a system message before them if there is one. Edits of least cost
bring it there: keep a row (0), give it the role that is due (3), delete it (4; a must for blank and repeated rows), insert an empty
row of the role that is due (3); a truncated row that stays costs 3 more. Of equal costs the edits whose initials are
smallest as text are taken.

* Faults need no order but for repeats: a window over (conversation, role, digest of the text) finds them, so only digests travel.
* First pass: rows without texts are dealt by conversation and sorted from last to first. Four states tell what is due, and a
  row changes the costs from here to the end. Only differences of the four costs matter, and these are finitely many, so
  the program is a table: (costs, row) gives new costs, what is added to all, and a code of one byte which holds the best edit in
  each state. A conversation may go on over any number of Arrow batches; what is kept of its rows is that byte, in memory up
  to ``SPILL`` bytes and beyond that in an unnamed file of the task, which ends with it. Read backwards, the bytes give the
  edits in the order of the rows.
* Second pass: the edits of a conversation, then its rows with texts, dealt and sorted from first to last; edits are applied as
  rows pass by, so no conversation is held.

A conversation is in one task, as its state goes from row to row; a giant one costs that task one byte and one table look-up a row, and
a text at a time. Lost tasks start anew from the shuffled rows.

Defined results: a null role or text is one space, a null turn comes first, null conversation ids are one conversation. Rows of one turn go
by role and then by the digest of the text; repeated rows are alike, the first is kept. No rows give no conversations. Columns other
than ``conv_id, turn, role, text`` play no part.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPILL = 16 << 20  # bytes of backpointers held in memory

# Faults, and initials of roles; other roles are OTHER.
FINE, BLANK, REPEATED, CUT = range(4)
INITIALS, OTHER = "sua", 3
FOLLOWS = {("s", "u"), ("u", "a"), ("a", "u")}

# States: nothing yet, system before, user before, assistant before. NEXT is where a role of each initial leads, DUE the role to be
# given or inserted, TO where that leads.
NEXT = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
DUE = ("user", "user", "assistant", "user")
TO = (2, 2, 3, 2)
AT_END = (0, INSERT + INSERT, INSERT, 0)
LETTERS = "DIKR"  # in ascending order


def _step(costs: tuple, initial: int, fault: int) -> tuple[tuple, tuple]:
    """The costs before a row of the costs after it, and the smallest letter of a best edit in each state."""
    more = TRUNCATED if fault == CUT else 0
    options = []
    for state in range(4):
        found = {"D": DELETE + costs[state]}
        if fault not in (BLANK, REPEATED):
            found["R"] = REROLE + more + costs[TO[state]]
            if initial in NEXT[state]:
                found["K"] = KEEP + more + costs[NEXT[state][initial]]
        options.append(found)
    least = [min(o.values()) for o in options]
    for state in (2, 3, 0, 1):  # insertions lead to 2 or 3 alone; going around costs more than it saves
        options[state]["I"] = INSERT + least[TO[state]]
    new = [min(least[s], options[s]["I"]) for s in range(4)]
    for state in (0, 1):
        options[state]["I"] = INSERT + new[TO[state]]
        new[state] = min(least[state], options[state]["I"])
    return tuple(new), tuple(min(c for c, v in options[s].items() if v == new[s]) for s in range(4))


def _table() -> tuple[list[list[tuple]], list[tuple]]:
    """``rows[costs][4 * initial + fault]`` is (next costs, added, code); a code is the letters of each state and the initial."""
    known, todo, rows, codes = {AT_END: 0}, [AT_END], [], {}
    while todo:
        costs = todo.pop(0)
        line = []
        for kind in range(16):
            new, letters = _step(costs, *divmod(kind, 4))
            base = min(new)
            new = tuple(c - base for c in new)
            if new not in known:
                known[new] = len(known)
                todo.append(new)
            line.append((known[new], base, codes.setdefault((letters, kind // 4), len(codes))))
        rows.append(line)
    return rows, list(codes)


TABLE, CODES = _table()
# What is said in a state by a code: the letter and the state after it.
SAID = [[(c, s if c == "D" else TO[s] if c in "IR" else NEXT[s][initial]) for s, c in enumerate(letters)] for letters, initial in CODES]
COSTS = {0: AT_END}
for _from, _line in enumerate(TABLE):
    for _kind, (_to, _base, _) in enumerate(_line):
        COSTS.setdefault(_to, tuple(c - _base for c in _step(COSTS[_from], *divmod(_kind, 4))[0]))


class Pointers:
    """Bytes that are added at the end and read from the end; beyond ``SPILL`` they go to an unnamed file."""

    def __init__(self):
        self.held, self.file = bytearray(), None

    def add(self, code: int) -> None:
        self.held.append(code)
        if len(self.held) >= SPILL:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.held)
            self.held.clear()

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.held)
        if self.file:
            at = self.file.tell()
            while at > 0:
                size = min(at, SPILL)
                at -= size
                self.file.seek(at)
                yield from reversed(self.file.read(size))
            self.file.close()


class Walk:
    """One conversation from its last row to its first."""

    def __init__(self):
        self.costs = self.total = self.blank = self.repeated = self.cut = self.illegal = 0
        self.before, self.pointers = None, Pointers()
        self.turns, self.low, self.high = 0, None, None

    def add(self, turn: int | None, kind: int) -> None:
        initial, fault = divmod(kind, 4)
        self.costs, added, code = TABLE[self.costs][kind]
        self.total += added
        self.pointers.add(code)
        self.blank += fault == BLANK
        self.repeated += fault == REPEATED
        self.cut += fault == CUT
        letter = (INITIALS + "?")[initial]
        self.illegal += self.before is not None and (letter, self.before) not in FOLLOWS
        self.before = letter
        if turn is not None and turn != self.low:
            self.turns += 1
            self.low = turn
            self.high = turn if self.high is None else self.high

    def result(self) -> tuple:
        state, said = 0, bytearray()
        for code in self.pointers.backwards():
            letter, state = SAID[code][state]
            said += letter.encode()
            while letter == "I":
                letter, state = SAID[code][state]
                said += letter.encode()
        while state in (1, 2):
            state = TO[state]
            said += b"I"
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return gaps, self.blank, self.repeated, self.cut, self.illegal, self.total + COSTS[self.costs][0], said.decode()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def no_nulls(rows: DataFrame, *others: str) -> DataFrame:
    """``conv, has_conv, turn, has_turn`` and the other columns: pandas would make floats of longs with nulls."""
    known = [F.coalesce(c, F.lit(0)).alias(new) for c, new in (("conv_id", "conv"), ("turn", "turn"))]
    given = [F.col(c).isNotNull().alias(new) for c, new in (("conv_id", "has_conv"), ("turn", "has_turn"))]
    return rows.select(*known, *given, *others)


def messages(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, digest)`` without null roles and texts."""
    known = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    return known.withColumn("digest", F.unhex(F.sha2("text", 256)))


def faults(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, digest, fault)`` of each row of ``messages``: the first fault it has."""
    core = F.rtrim(F.col("text"), F.lit(BLANKS))
    light = rows.select("conv_id", "turn", "role", "digest", (core == "").alias("blank"), F.right(core, F.lit(1)).isin(*ENDS).alias("ended"))
    alike = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    light = light.withColumn("nth", F.row_number().over(alike))
    fault = F.when(F.col("blank"), BLANK).when(F.col("nth") > 1, REPEATED).when(~F.col("ended"), CUT).otherwise(FINE)
    return light.select("conv_id", "turn", "role", "digest", fault.alias("fault"))


def audits(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of each conversation; ``audit`` are the initials of the cheapest
    edits in the order of the rows. ``rows`` are ``messages``."""
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    initial = F.when((initial > 0) & (F.length("role") > 0), initial - 1).otherwise(OTHER)
    light = faults(rows).select("*", (initial * 4 + F.col("fault")).alias("kind"))
    # Repeats of one turn stand behind the row that they repeat.
    last_first = [F.col("conv_id"), F.col("turn").desc_nulls_last(), *[F.col(c).desc() for c in ("role", "digest")], (F.col("fault") == REPEATED).desc()]
    dealt = light.repartition("conv_id").sortWithinPartitions(*last_first)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, walk, done = None, None, []
        for batch in batches:
            for conv, has_conv, turn, has_turn, kind in zip(*[batch[c].tolist() for c in ("conv", "has_conv", "turn", "has_turn", "kind")], strict=True):
                if walk is None or now != (conv, has_conv):
                    if walk:
                        done.append((*now, *walk.result()))
                    now, walk = (conv, has_conv), Walk()
                walk.add(turn if has_turn else None, kind)
            if done:
                yield pd.DataFrame(done, columns=["conv", "has_conv", *COUNTS, "audit"])
                done = []
        if walk:
            yield pd.DataFrame([(*now, *walk.result())], columns=["conv", "has_conv", *COUNTS, "audit"])

    found = no_nulls(dealt, "kind").mapInPandas(run, f"conv long, has_conv boolean, {', '.join(c + ' long' for c in COUNTS)}, audit string")
    return found.select(F.when(F.col("has_conv"), F.col("conv")).alias("conv_id"), *COUNTS, "audit")


class Edited:
    """Applies the edits of one conversation to its rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role = DUE[self.state]
            self.state, self.at = TO[self.state], self.at + 1
            yield role, "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = NEXT[self.state][INITIALS.index(role[0])]
            yield role, text, letter
        elif letter == "R":
            due, self.state = DUE[self.state], TO[self.state]
            yield due, text, letter


def _with_audits(rows: DataFrame, checked: DataFrame) -> DataFrame:
    """Each conversation's audit and then its rows, sorted."""
    body = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "digest", *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    head = checked.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(b"").alias("digest"), *COUNTS)
    first_last = ["conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "digest"]
    dealt = head.unionByName(body).repartition("conv_id").sortWithinPartitions(*first_last)
    return no_nulls(dealt, "kind", "role", "text", *COUNTS)


def repair(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, turn, role, text, edit)`` of the repaired conversations: ``place`` counts from 0, ``edit`` is K, R or I; inserted
    rows have no turn."""
    rows = messages(conversations)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, edited, place, out = None, None, 0, []

        def put(turn: int | None, new: Iterator[tuple]) -> None:
            nonlocal place
            for role, text, letter in new:
                known = turn is not None and letter != "I"
                out.append((*now, place, turn if known else 0, known, role, text, letter))
                place += 1

        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.kind == 0:
                    if edited:
                        put(None, edited.inserted())
                    now, edited, place = (r.conv, r.has_conv), Edited(r.text), 0
                else:
                    put(r.turn if r.has_turn else None, edited.row(r.role, r.text))
            yield pd.DataFrame(out, columns=columns)
            out.clear()
        if edited:
            put(None, edited.inserted())
            yield pd.DataFrame(out, columns=columns)

    columns = ["conv", "has_conv", "place", "turn", "has_turn", "role", "text", "edit"]
    schema = "conv long, has_conv boolean, place long, turn long, has_turn boolean, role string, text string, edit string"
    found = _with_audits(rows, audits(rows)).mapInPandas(run, schema)
    return found.select(F.when(F.col("has_conv"), F.col("conv")).alias("conv_id"), "place", F.when(F.col("has_turn"), F.col("turn")).alias("turn"), "role", "text", "edit")


def digests(conversations: DataFrame) -> DataFrame:
    """The columns of ``audits`` and ``repaired_sha256``: the hash of the repaired rows as ``role:text``, joined by line feeds."""
    rows = messages(conversations)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, edited, sha, empty, done = None, None, None, True, []

        def put(new: Iterator[tuple]) -> None:
            nonlocal empty
            for role, text, _ in new:
                sha.update((("" if empty else "\n") + role + ":" + text).encode())
                empty = False

        def end() -> None:
            put(edited.inserted())
            done.append((*head, edited.audit, sha.hexdigest()))

        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.kind == 0:
                    if edited:
                        end()
                    head, edited = (r.conv, r.has_conv, *[getattr(r, c) for c in COUNTS]), Edited(r.text)
                    sha, empty = hashlib.sha256(), True
                else:
                    put(edited.row(r.role, r.text))
            if done:
                yield pd.DataFrame(done, columns=columns)
                done.clear()
        if edited:
            end()
            yield pd.DataFrame(done, columns=columns)

    columns = ["conv", "has_conv", *COUNTS, "audit", "repaired_sha256"]
    found = _with_audits(rows, audits(rows)).mapInPandas(run, f"conv long, has_conv boolean, {', '.join(c + ' long' for c in COUNTS)}, audit string, repaired_sha256 string")
    return found.select(F.when(F.col("has_conv"), F.col("conv")).alias("conv_id"), *COUNTS, "audit", "repaired_sha256")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by ``crc32(conv_id:turn) % 20``: 0 drops a row, 1 empties it, 2 takes its sentence ends, 3 repeats it, 4 makes it
    a user's. Nulls are read as one space."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")), F.lit(20)).cast("int")
    rows = conversations.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    times = F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1)
    rows = rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)))
    return rows.drop("col")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = digests(damaged(rows)).withColumnRenamed("conv_id", "_id")
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
