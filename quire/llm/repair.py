"""Repair of conversations by weighted interval parsing (CYK).

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``:
nothing at all, or an optional system row and then user and assistant in
turn. Rows may be kept, given another role or deleted, and empty rows may be
inserted; the parse finds the cheapest edits.

The repair grammar is in Chomsky normal form. Its non-terminal ``X[p, q]``
derives a span of rows whose edits lead from state p to state q (nothing
written yet, after a system, a user, an assistant row); the rules are
``X[p, q] -> X[p, r] X[r, q]`` and, for one row, the edits of that row closed
under insertions before and after it. A cell holds for every non-terminal the
smallest ``(cost, audit)``, audit being the initials of the edits in order.
Cells are combined bottom-up by span length: 1, 2, 4 and so on. As every
derivation of ``X[p, q]`` passes some state r between any two rows, one split
of a span sees them all, so a conversation of n rows takes n - 1 combinations
however long it is. Two audits of one span and non-terminal with equal costs
hold the same number of row edits, hence neither begins the other, and the
least audit of a whole is made of least audits of its parts.

The rows of a conversation pass a task as a stream, first their faults (one
letter a row) and then their texts, sorted by the shuffle. A task holds the
letters and the audit of one conversation and one batch of rows, never a
conversation's texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.tables import read

DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1   # fixed values: costs; keeping costs nothing
DAMAGE = 20                                      # fixed value: kinds of rows, by crc32
WHITE = " \t\n\x0b\x0c\r"                        # fixed value: [\x20\x09-\x0D]
ENDS = ".!?"                                     # fixed value: characters that end a sentence

# States: nothing written, after a system, a user, an assistant row.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
FINAL = (0, 3)
ROLE = {"u": "user", "a": "assistant"}
NEVER = 1 << 60
PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
RULES = [(p, q, [r for r in range(4) if (p, r) in PAIRS and (r, q) in PAIRS]) for p, q in PAIRS]

#: A row as one letter: initial of its role (s, u, a, other) x fault.
CLEAN, CUT, BLANK, REPEAT = range(4)
LETTERS = "abcdefghijklmnop"
INITIALS = "sua"
CHUNK = 4096     # letters of a conversation that are parsed at a time


def _empty() -> list:
    """The cell of no rows: insertions only."""
    cell = [(NEVER, "")] * 16
    for p in range(4):
        cell[5 * p] = (0, "")
    while True:  # closure: one more insertion on the right
        new = list(cell)
        for p in range(4):
            for (r, role), q in NEXT.items():
                cost, audit = cell[4 * p + r]
                if role != "s" and cost < NEVER:
                    new[4 * p + q] = min(new[4 * p + q], (cost + INSERT, audit + "I"))
        if new == cell:
            return cell
        cell = new


def joined(x: list, y: list) -> list:
    """The cell of two neighbouring spans."""
    out = [(NEVER, "")] * 16
    for p, q, mids in RULES:
        best, audit = NEVER, ""
        for r in mids:
            a, b = x[4 * p + r], y[4 * r + q]
            cost = a[0] + b[0]
            if cost < best:
                best, audit = cost, a[1] + b[1]
            elif cost == best and cost < NEVER:
                audit = min(audit, a[1] + b[1])
        out[4 * p + q] = (best, audit)
    return out


@lru_cache(maxsize=None)
def leaf(letter: str) -> list:
    """The cell of one row, closed under insertions around it."""
    role, fault = divmod(LETTERS.index(letter), 4)
    cell = [(NEVER, "")] * 16
    for p in range(4):
        cell[5 * p] = (DELETE, "D")
    if fault in (CLEAN, CUT):
        late = TRUNCATED if fault == CUT else 0
        for (p, to), q in NEXT.items():
            if role < 3 and INITIALS[role] == to:
                cell[4 * p + q] = min(cell[4 * p + q], (late, "K"))
            if to != "s":
                cell[4 * p + q] = min(cell[4 * p + q], (REROLE + late, "R"))
    return joined(joined(_empty(), cell), _empty())


def _combined(cells: list) -> list:
    while len(cells) > 1:
        cells = [joined(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def _best(cell: list) -> tuple[int, str]:
    return min(cell[q] for q in FINAL)


@lru_cache(maxsize=1 << 14)
def _short(letters: str) -> tuple[int, str]:
    return _best(_combined([leaf(c) for c in letters]))


def parse(letters: str) -> tuple[int, str]:
    """Cheapest ``(cost, audit)`` of a conversation given as letters."""
    if not letters:
        return 0, ""
    if len(letters) <= 16:
        return _short(letters)
    spans = [_combined([leaf(c) for c in letters[i:i + CHUNK]]) for i in range(0, len(letters), CHUNK)]
    return _best(_combined(spans))


class _Talk:
    """One conversation on its way through a task."""

    def __init__(self, conv):
        self.conv, self.letters, self.audit = conv, [], None
        self.low = self.high = self.last_turn = None
        self.turns = self.at = self.state = 0

    def fault(self, turn, letter: str, copies: int) -> None:
        """The next rows: one and its repetitions."""
        i, kind = divmod(LETTERS.index(letter), 4)
        self.letters.append(letter + LETTERS[4 * i + (kind if kind == BLANK else REPEAT)] * (copies - 1))
        if turn is not None and turn != self.last_turn:
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
            self.turns += 1

    def parsed(self) -> None:
        if self.audit is None:
            self.letters = "".join(self.letters)
            self.cost, self.audit = parse(self.letters)

    def inserted(self):
        """Rows inserted at this place."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            to = "a" if self.state == 2 else "u"
            self.at, self.state = self.at + 1, NEXT[self.state, to]
            yield "insert", None, ROLE[to], ""

    def edited(self, turn, role: str, text: str):
        """What becomes of the next row: ``(edit, turn, role, text)`` of the
        rows written, in order."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = NEXT[self.state, role[0]]
            yield "keep", turn, role, text
        elif edit == "R":
            to = "a" if self.state == 2 else "u"
            self.state = NEXT[self.state, to]
            yield "rerole", turn, ROLE[to], text

    def counts(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit."""
        kinds = [LETTERS.index(c) for c in self.letters]
        faults = [sum(k % 4 == f for k in kinds) for f in (BLANK, REPEAT, CUT)]
        pairs = zip(kinds, kinds[1:])
        illegal = sum((a // 4, b // 4) not in ((0, 1), (1, 2), (2, 1)) for a, b in pairs)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return gaps, *faults, illegal, self.cost, self.audit


COLUMNS = ["conv_id", "phase", "turn", "role", "text", "letter", "copies"]


def _talks(batches: Iterator[pa.RecordBatch], write, done) -> Iterator[pa.RecordBatch]:
    """Run the stream of sorted rows; ``write(talk, row)`` gets every row
    written, ``done(talk)`` every finished conversation. Both may return a
    tuple, a row of the result."""
    talk = None
    out: list = []

    def end():
        talk.parsed()
        for row in talk.inserted():
            out.append(write(talk, row))
        out.append(done(talk))

    for batch in batches:
        for conv, phase, turn, role, text, letter, copies in zip(*(batch.column(c).to_pylist() for c in COLUMNS)):
            if talk is None or conv != talk.conv:
                if talk is not None:
                    end()
                talk = _Talk(conv)
            if phase == 0:
                talk.fault(turn, letter, copies)
                continue
            talk.parsed()
            for _ in range(copies):
                for row in talk.edited(turn, role, text):
                    out.append(write(talk, row))
        yield [r for r in out if r is not None]
        out.clear()
    if talk is not None:
        end()
        yield [r for r in out if r is not None]


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
TURNS = "conv_id long, place long, edit string, turn long, role string, text string"


def _batch(rows: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(cols, fields)], names=[f for f, _ in fields])


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def write(talk, row):
        if not hasattr(talk, "sha"):
            talk.sha = hashlib.sha256()
        else:
            talk.sha.update(b"\n")
        talk.sha.update(row[2].encode())
        talk.sha.update(b":")
        talk.sha.update(row[3].encode())

    def done(talk):
        sha = talk.sha if hasattr(talk, "sha") else hashlib.sha256()
        return talk.conv, *talk.counts(), sha.hexdigest()

    for rows in _talks(batches, write, done):
        yield _batch(rows, REPORT)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def write(talk, row):
        talk.place = getattr(talk, "place", -1) + 1
        return talk.conv, talk.place, *row

    for rows in _talks(batches, write, lambda talk: None):
        yield _batch(rows, TURNS)


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: the rows of ``conversations``
    after the damage that crc32 of ``conv_id:turn`` chooses. Nulls count as
    one space in that key, in roles and in texts; a dropped row stays with 0
    copies, so that its conversation is still known."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % DAMAGE
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ENDS, "")).otherwise(text)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _stream(rows: DataFrame) -> DataFrame:
    """Faults and texts of every conversation, together and in order."""
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    solid = F.rtrim("text", F.lit(WHITE))
    fault = F.when(solid == "", BLANK).when(~F.right(solid, F.lit(1)).isin(*ENDS), CUT).otherwise(CLEAN)
    initial = F.coalesce(*[F.when(F.startswith("role", F.lit(c)), i) for i, c in enumerate(INITIALS)], F.lit(3))
    known = rows.where("copies > 0").select("conv_id", "turn", "role", "digest", "copies", fault.alias("fault"), initial.alias("initial"))
    # rows that are the same in every respect are one row with a count
    known = known.groupBy("conv_id", "turn", "role", "digest", "fault", "initial").agg(F.sum("copies").cast("int").alias("copies"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())) > 1
    known = known.withColumn("fault", F.when(seen & (F.col("fault") != BLANK), REPEAT).otherwise(F.col("fault")))
    letter = F.substring(F.lit(LETTERS), F.col("initial") * 4 + F.col("fault") + 1, F.lit(1))
    none = F.lit(None).cast("string")
    first = known.select("conv_id", F.lit(0).alias("phase"), "turn", "role", "digest", none.alias("text"), letter.alias("letter"), "copies")
    then = rows.select("conv_id", F.lit(1).alias("phase"), "turn", "role", "digest", F.when(F.col("copies") > 0, F.col("text")).alias("text"),
                       none.alias("letter"), "copies")
    both = first.unionByName(then).repartition("conv_id")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "phase", "turn", "role", "digest")]
    return both.sortWithinPartitions(*order).select(*COLUMNS)


def repair_report(rows: DataFrame) -> DataFrame:
    """One row for every conversation of ``rows(conv_id, turn, role, text,
    copies)`` with its faults, the cost and audit of the cheapest repair, and
    the hash of the repaired ``role:text`` lines.

    Rows are taken by turn (nulls first), then role and SHA-256 of the text.
    Faults: blank before duplicate before truncated; a row that is repeated as
    a whole counts as often as it occurs. A conversation whose rows all have 0
    copies has zeros, an empty audit and the hash of nothing; null ids are one
    conversation; an empty table gives no rows; other columns are ignored. Very
    long texts pass once, a batch of rows at a time.
    """
    return _stream(rows).mapInArrow(_reports, REPORT)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: ``(conv_id, place, edit, turn,
    role, text)``, ``edit`` being keep, rerole or insert (an inserted row has
    no turn). Cases as in ``repair_report``."""
    return _stream(rows).mapInArrow(_turns, TURNS)


def op11_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of all damaged ``conversations``."""
    return repair_report(damaged(read(spark, sf_dir, "conversations")))
