"""Conversation structure repair: the cheapest edits to turns that alternate.

The roles of a repaired conversation begin with ``s?(ua)+`` (first letters), or
it is empty. A turn is kept, given the role user or assistant, or deleted; an
empty turn of either role may be inserted anywhere. The edits are a path
through a graph with a node for each turn and state (nothing yet, after the
system, user or assistant turn). Its weight is one integer: the high digits are
the cost; below them stands a letter an edit, a digit of three bits at the
place of its position, with zeros at the end. The least integer is therefore
the cheapest path and, of equal ones, that with the ASCII-least letters;
nothing but integer minima decides.

Every ``BLOCK`` turns the letters so far are moved out of the weights and their
order among the four states, a digit, takes their place. Letters of two states
differ at a place that both have (each ends in a turn's letter), so that the
order of all further sums stays the same. Weights thus have a fixed width, and
a conversation takes linear time.

A first pass moves only what the weights need (ids, first letters, marks and
hashes), a second one moves the texts, sorted, with the letters in front of
them. Neither holds the turns of a conversation: the first keeps its letters
(they are a value of its result), the second streams. The digest of a whole
repaired conversation is one chain of bytes, so that one task must read it;
everything else of a hot conversation (marks, equal turns) is dealt out.

Turns stand in the order of ``turn`` (null first), those of one turn in that of
a hash of role and text; repeated rows thus follow each other. Null roles and
texts count as one space, a null ``conv_id`` is a conversation like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import arrow_of, split_batch

DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4  # digits, in the order of the letters
LETTERS = " DIKR"
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
CUT_COST = 3  # of a truncated turn that stays
START, SYSTEM, USER, ASSISTANT = range(4)
BITS, BLOCK = 3, 64
WIDTH = 3 * BLOCK + 4  # letters: two inserts and an edit a turn, two inserts at the end
HIGH = BITS * (WIDTH + 1)  # the place of the cost, above the digit of what came before
MASK = (1 << BITS) - 1
WHITE = " \t\n\x0b\f\r"


class Repair:
    """Takes turns one by one; ``finish`` gives (cost, letters)."""

    def __init__(self):
        self.weight: list[int | None] = [0, None, None, None]
        self.count = [0, 0, 0, 0]  # letters of the block on the path to each state
        self.paths: list[tuple | None] = [None]  # letters before the block, by the digit that stands for them
        self.turns = 0

    def _edges(self, steps) -> tuple[list, list]:
        """Least weight into each state over (from, to, letter, cost)."""
        weight, count = [None] * 4, [0] * 4
        for a, b, letter, cost in steps:
            w = self.weight[a]
            if w is not None:
                w += (cost << HIGH) + (letter << BITS * (WIDTH - 1 - self.count[a]))
                if weight[b] is None or w < weight[b]:
                    weight[b], count[b] = w, self.count[a] + 1
        return weight, count

    def _insert(self) -> None:
        for steps in (((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), ((USER, ASSISTANT),)):
            weight, count = self._edges((a, b, INSERT, COST[INSERT]) for a, b in steps)
            for s, w in enumerate(weight):
                if w is not None and (self.weight[s] is None or w < self.weight[s]):
                    self.weight[s], self.count[s] = w, count[s]

    def turn(self, initial: str, drop: bool, cut: bool) -> None:
        """``drop``: has to be deleted; ``cut``: costs more if it stays."""
        if self.turns == BLOCK:
            self._rebase()
        self.turns += 1
        self._insert()
        steps = [(s, s, DELETE, COST[DELETE]) for s in range(4)]
        if not drop:
            more = CUT_COST if cut else 0
            for a, b, name in ((START, SYSTEM, "s"), (START, USER, "u"), (SYSTEM, USER, "u"), (ASSISTANT, USER, "u"), (USER, ASSISTANT, "a")):
                if initial == name:
                    steps.append((a, b, KEEP, COST[KEEP] + more))
                if b != SYSTEM:
                    steps.append((a, b, REROLE, COST[REROLE] + more))
        self.weight, self.count = self._edges(steps)

    def _letters(self, s: int) -> tuple:
        """(letters before the block, letters of the block) of a state's path."""
        w = self.weight[s]
        text = "".join(LETTERS[w >> BITS * (WIDTH - 1 - i) & MASK] for i in range(self.count[s]))
        return self.paths[w >> BITS * WIDTH & MASK], text

    def _rebase(self) -> None:
        low = (1 << HIGH) - 1
        live = sorted((w & low, s) for s, w in enumerate(self.weight) if w is not None)
        self.paths = [self._letters(s) for _, s in live]
        for rank, (_, s) in enumerate(live):
            self.weight[s] = self.weight[s] >> HIGH << HIGH | rank << BITS * WIDTH
        self.count, self.turns = [0] * 4, 0

    def finish(self) -> tuple[int, str]:
        self._insert()
        s = min((s for s in (START, ASSISTANT) if self.weight[s] is not None), key=lambda s: self.weight[s])
        path, parts = self._letters(s), []
        while path is not None:
            path, text = path
            parts.append(text)
        return self.weight[s] >> HIGH, "".join(reversed(parts))


class Apply:
    """Follows the letters: the role of each turn that stays."""

    def __init__(self, letters: str):
        self.letters, self.at, self.last = letters or "", 0, ""

    def _next(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        """(letter, role, text) of the turns to insert here."""
        while self.letters[self.at: self.at + 1] == "I":
            self.at += 1
            role = self._next()
            self.last = role[0]
            yield "I", role, ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """What stands up to and with the next turn."""
        yield from self.inserts()
        letter = self.letters[self.at]
        self.at += 1
        if letter != "D":
            role = role if letter == "K" else self._next()
            self.last = role[0]
            yield letter, role, text


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): by crc32(``conv_id:turn``) % 20 a row is
    dropped (0; it stays as a row that is ``gone``), emptied (1), loses its
    ``[.!?]`` (2), is repeated (3) or gets the role user (4). Nulls, also in the
    hashed text, are one space."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    k = F.crc32(F.concat_ws(":", plain("conv_id"), plain("turn")).cast("binary")) % 20
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        plain("role").alias("role"), plain("text").alias("text"), k.alias("k"))
    text = F.when(F.col("k") <= 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("k") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def _plain(turns: DataFrame) -> DataFrame:
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in turns.columns else F.lit(False)
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                        text.alias("text"), gone.alias("gone"), F.unhex(F.sha2(F.concat(role, F.lit("\0"), text).cast("binary"), 256)).alias("hash"))


REPORT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
REPORT_ARROW = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in REPORT.split(", ")])
PAIRS = {"su", "ua", "au"}


def reports(turns: DataFrame) -> DataFrame:
    """A row for each ``conv_id`` of ``turns`` (conv_id, turn, role, text and
    perhaps ``gone``): its gaps, faults, illegal pairs, the cost of its repair
    and the letters of the edits. A turn's first fault counts: blank, duplicate
    of an earlier turn, truncated. A conversation whose rows are all ``gone``
    has zeros and no letters. Other columns are ignored; no row, no report.
    """
    rows = _plain(turns)
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    rows = rows.select("conv_id", "turn", "gone", "hash", F.substring("role", 1, 1).alias("initial"), bare.alias("bare"))
    rows = rows.select("conv_id", "turn", "gone", "hash", "initial", (F.col("bare") == "").alias("blank"),
                       (~F.substring(F.col("bare"), -1, 1).isin(".", "!", "?")).alias("cut"))
    known = rows.where(~F.col("gone") & ~F.col("blank")).groupBy("conv_id", "hash").agg(
        F.count("*").alias("n"), F.min("turn").alias("least"), F.bool_or(F.col("turn").isNull()).alias("nulls")).where("n > 1")
    known = known.select(F.col("conv_id").alias("c"), F.col("hash").alias("h"), "least", "nulls")
    seen = F.coalesce((F.col("nulls") & F.col("turn").isNotNull()) | (F.col("turn") > F.col("least")), F.lit(False))
    rows = rows.join(known, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("hash") == F.col("h")), "left")
    rows = rows.select("conv_id", "turn", "gone", "hash", "initial", "blank", "cut", seen.alias("seen"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "gone", F.col("turn").asc_nulls_first(), "hash")
    return rows.mapInArrow(_report, REPORT)


class _Report:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.repair, self.before = conv_id, Repair(), None
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, key, initial, blank, cut, seen) -> None:
        seen = not blank and (seen or (self.before is not None and self.before[:2] == (turn, key)))
        cut = cut and not blank and not seen
        self.blank += blank
        self.duplicate += seen
        self.truncated += cut
        if self.before is not None and self.before[2] + initial not in PAIRS:
            self.illegal += 1
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        self.before = (turn, key, initial)
        self.repair.turn(initial, blank or seen, cut)

    def row(self) -> tuple:
        cost, audit = self.repair.finish()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        done = []
        for conv_id, turn, gone, key, initial, blank, cut, seen in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Report(conv_id)
            if not gone:
                now.add(turn, key, initial, blank, cut, seen)
        if done:
            yield _batch(done, REPORT_ARROW)
    if now is not None:
        yield _batch([now.row()], REPORT_ARROW)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _marked(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The turns of each conversation in order, its report before them."""
    rows = _plain(turns).where(~F.col("gone")).select("conv_id", F.lit(1).alias("kind"), "turn", "hash", "role", "text")
    told = F.struct(*[F.col(c) for c in found.columns])
    marks = found.select("conv_id", F.lit(0).alias("kind"), told.alias("report"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "hash")
    return both.select("kind", "role", "text", "report")


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text) of every turn that stands in the
    repaired conversations; ``found`` are the reports of ``turns``."""
    schema = "conv_id bigint, position bigint, edit string, role string, text string"
    arrow = arrow_of(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, conv_id, at = 0, None, 0
        for report, piece in _walk(batches):
            if piece is None:
                conv_id, at = report["conv_id"], 0
                continue
            rows.append((conv_id, at, *piece))
            at, size = at + 1, size + len(piece[2])
            if len(rows) == 10_000 or size > 8 << 20:
                yield _batch(rows, arrow)
                rows, size = [], 0
        if rows:
            yield _batch(rows, arrow)

    return _marked(turns, found).mapInArrow(run, schema)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(report, None) when a conversation begins, then (None, (letter, role,
    text)) for each turn that stands."""
    now = None
    for batch in batches:
        for part in split_batch(batch, "text", 8 << 20):
            for kind, role, text, report in zip(*(c.to_pylist() for c in part.columns)):
                if kind == 0:
                    if now is not None:
                        yield from ((None, p) for p in now.inserts())
                    now = Apply(report["audit"])
                    yield report, None
                else:
                    yield from ((None, p) for p in now.turn(role, text))
    if now is not None:
        yield from ((None, p) for p in now.inserts())


def digests(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The reports with ``repaired_sha256``: of the ``role:text`` of all turns that
    stand in the repaired conversation, joined by newlines."""
    arrow = REPORT_ARROW.append(pa.field("repaired_sha256", pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        now, chain, first = None, None, True
        for report, piece in _walk(batches):
            if piece is None:
                if now is not None:
                    rows.append((*now.values(), chain.hexdigest()))
                    if len(rows) == 10_000:
                        yield _batch(rows, arrow)
                        rows = []
                now, chain, first = report, hashlib.sha256(), True
                continue
            chain.update(f"{'' if first else chr(10)}{piece[1]}:{piece[2]}".encode("utf-8", "surrogatepass"))
            first = False
        if now is not None:
            rows.append((*now.values(), chain.hexdigest()))
            yield _batch(rows, arrow)

    return _marked(turns, found).mapInArrow(run, REPORT + ", repaired_sha256 string")
