"""Conversation structure repair over a suffix-shared automaton.

A conversation's rows, in order, become a signature: one letter for each row
(``s u a`` and ``o`` for other roles, capital if the text is truncated, ``x``
if the row is blank or a duplicate and has to go).  The repaired roles must
read ``(s?(ua)+)?``; an edit keeps, re-roles or deletes a row or inserts one.
What the rest of a conversation costs depends on the rest of its signature
alone, so signatures are sorted from the end and chained into an automaton
whose nodes are suffixes, each built once however many conversations share
it.  A node holds, for each of the four grammar states, the cost to go and
the first edit of the least audit; an audit is read off by following the
first edits.

Order: by turn, nulls first; rows of one turn by role, then by the md5 of
role and text, copies adjacent.  A row's first fault counts: blank, duplicate
(its role and text seen earlier), truncated.

Scale: nothing holds a conversation whole.  Rows without their texts are
range-partitioned by (conversation, order), so a hot conversation is split
over tasks, and each task emits signatures of at most ``BLOCK`` rows.  First
occurrences come from one pre-aggregated minimum and are joined by row number,
which no key can skew.  Where a conversation has several blocks, each block's
4 x 4 table of costs gives the costs to go at its end, from the last block to
the first: one small row for each ``BLOCK`` rows.  Blocks are sorted by (end
costs, reversed signature) for the automaton; a signature that a third of all
conversations share is split over tasks and built once in each.  Only the
digest of a repaired conversation reads it in one pass, as a stream: sha256
is sequential by its nature.

Edge cases: a null role or text counts as one space, a null turn sorts first
and is written as one space in the damage key, null conv_ids form one
conversation; repeated rows are duplicates; a conversation without rows gives
zeros, an empty audit and the digest of an empty string; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm.common import cut
from spindle.llm.registry import query
from spindle.session import read_table

#: Rows of a conversation that one signature covers.
BLOCK = 4096

# --- fixed values: costs of the edits ----------------------------------------
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# grammar states: nothing yet, after s, after u, after a
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 40
#: State after the role that the grammar asks for next (u, u, a, u).
NEXT = (USER, USER, ASSISTANT, USER)
#: States that a row's own role leads to when it is kept.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
#: Costs to go at the end of a conversation.
END = (0, 2 * INSERT, INSERT, 0)


@lru_cache(maxsize=1 << 16)
def step(letter: str, after: tuple) -> tuple[int, tuple, tuple]:
    """Costs to go before a row, from those after it: (least cost, costs
    above it by state, first edit by state).  An edit is (initial, next state,
    whether the row is used up).  Of equal costs the least initial counts."""
    best = []
    for state in range(4):
        edits = [(DELETE + after[state], "D", state, True)]
        if letter != "x":
            extra = TRUNCATED if letter.isupper() else 0
            target = KEPT[letter.lower()].get(state)
            if target is not None:
                edits.append((KEEP + extra + after[target], "K", target, True))
            edits.append((REROLE + extra + after[NEXT[state]], "R", NEXT[state], True))
        best.append(min(edits))
    # an inserted row leads to the next state before the same row: shortest paths over four states
    changed = True
    while changed:
        changed = False
        for state in range(4):
            inserted = (INSERT + best[NEXT[state]][0], "I", NEXT[state], False)
            if inserted[:2] < best[state][:2]:
                best[state], changed = inserted, True
    low = min(b[0] for b in best)
    return low, tuple(min(b[0] - low, NEVER) for b in best), tuple(b[1:] for b in best)


class SuffixAutomaton:
    """Nodes of the current signature, from its end.  Signatures come in the
    order of their reversed letters, so the nodes of a shared suffix stay and
    only the rest is built anew; at most one signature's nodes are held."""

    def __init__(self, end: tuple):
        self.letters: list[str] = []
        self.nodes = [(0, end, ())]  # (cost, costs above it, first edits)
        self.built = 0

    def read(self, signature: str) -> None:
        backwards = signature[::-1]
        shared = 0
        for a, b in zip(self.letters, backwards, strict=False):
            if a != b:
                break
            shared += 1
        del self.letters[shared:], self.nodes[shared + 1:]
        for letter in backwards[shared:]:
            cost, after, _ = self.nodes[-1]
            low, above, edits = step(letter, after)
            self.nodes.append((cost + low, above, edits))
            self.letters.append(letter)
            self.built += 1

    def cost(self, state: int) -> int:
        low, above, _ = self.nodes[-1]
        return low + above[state]

    def audit(self, state: int) -> str:
        """Least audit from ``state`` to the end of the signature."""
        out, at = [], len(self.nodes) - 1
        while at:
            initial, state, used = self.nodes[at][2][state]
            out.append(initial)
            at -= used
        return "".join(out)


# --- rows and their signatures -----------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """The damaged rows: conv_id, turn, role, text, copy.  A dropped row stays
    with copy -1, so that its conversation is not lost."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", filled("conv_id"), filled("turn")).cast("binary")) % 20
    text = (F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .when(F.col("_kind") > 0, F.col("text")))
    copies = (F.when(F.col("_kind") == 0, F.array(F.lit(-1))).when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1)))
              .otherwise(F.array(F.lit(0))))
    return (rows.select("conv_id", F.col("turn").cast("long").alias("turn"), filled("role").alias("role"), filled("text").alias("text"), kind.alias("_kind"))
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(copies).alias("copy")))


def whole(rows: DataFrame) -> DataFrame:
    """Rows as they are, in the form that ``repair`` takes."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), filled("role").alias("role"),
                       filled("text").alias("text"), F.lit(0).alias("copy"))


ORDER = ("turn", "role", "digest", "copy")
BLANKS = " \t\n\v\f\r"


def _keyed(rows: DataFrame) -> DataFrame:
    digest = F.md5(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"))
    return rows.withColumn("digest", digest)


def _by(columns) -> list:
    return [F.col(c).asc_nulls_first() for c in columns]


def signatures(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of the conversations: conv_id, the order columns of the first
    row, part and number (the blocks' order), signature."""
    shown = F.rtrim("text", F.lit(BLANKS))
    blank = F.length(shown) == 0
    letter = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    lean = _keyed(rows.filter("copy >= 0")).select(
        "conv_id", *ORDER, blank.alias("blank"),
        F.when(F.substring(shown, -1, 1).isin(".", "!", "?"), letter).otherwise(F.upper(letter)).alias("letter"),
        F.monotonically_increasing_id().alias("row"))
    lean = cut(lean, "turns")
    first = (lean.filter("NOT blank").groupBy("conv_id", "digest")
             .agg(F.min(F.struct("turn", "copy", "row"))["row"].alias("row")).select("row", F.lit(True).alias("first")))
    flagged = lean.join(first, "row", "left").select(
        "conv_id", *ORDER, "row", F.when(F.col("first"), F.col("letter")).otherwise("x").alias("letter"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (flagged.repartitionByRange(parts, *_by(("conv_id", *ORDER, "row"))).withColumn("part", F.spark_partition_id())
               .sortWithinPartitions(*_by(("conv_id", *ORDER, "row"))))
    fields = [rows.schema["conv_id"], *[lean.schema[c] for c in ORDER]]
    schema = T.StructType([*fields, T.StructField("part", T.IntegerType()), T.StructField("number", T.LongType()), T.StructField("signature", T.StringType())])
    head = len(fields)

    def chain(batches):
        number, held, letters = 0, None, []
        for b in batches:
            done = []
            for row in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv_id", *ORDER, "part", "letter")], strict=True):
                if held is not None and (row[0] != held[0] or len(letters) == block):
                    done.append((*held, number, "".join(letters)))
                    held, letters, number = None, [], number + 1
                if held is None:
                    held = row[:head + 1]
                letters.append(row[-1])
            if done:
                yield _batch(done, schema)
        if held is not None:
            yield _batch([(*held, number, "".join(letters))], schema)

    return ordered.mapInArrow(chain, schema)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)


def with_end_costs(blocks: DataFrame) -> DataFrame:
    """``blocks`` with seq (from 0 in each conversation) and the costs to go
    at their ends, by state, the least of them 0."""
    w = Window.partitionBy("conv_id").orderBy("part", "number")
    numbered = blocks.withColumns({"seq": F.row_number().over(w).cast("long") - 1, "later": F.lead(F.lit(1)).over(w)})
    numbered = cut(numbered, "blocks")
    pairs = T.StructType([blocks.schema["conv_id"], T.StructField("seq", T.LongType()), T.StructField("table", T.ArrayType(T.LongType()))])

    def tables(batches):
        units = [SuffixAutomaton(tuple(0 if j == end else NEVER for j in range(4))) for end in range(4)]
        for b in batches:
            rows = []
            for conv, seq, signature in zip(*[b.column(k).to_pylist() for k in range(3)], strict=True):
                for u in units:
                    u.read(signature)
                rows.append((conv, seq, [min(u.cost(s), NEVER) for u in units for s in range(4)]))
            if rows:
                yield _batch(rows, pairs)

    several = numbered.filter("seq > 0 OR later IS NOT NULL")
    costs = several.select("conv_id", "seq", "signature").mapInArrow(tables, pairs)
    ends = T.StructType([*pairs.fields[:2], T.StructField("end", T.ArrayType(T.LongType()))])

    def backwards(batches):
        """From a conversation's last block to its first."""
        held, goal = object(), END
        for b in batches:
            rows = []
            for conv, seq, table in zip(*[b.column(k).to_pylist() for k in range(3)], strict=True):
                if conv != held:
                    held, goal = conv, END
                rows.append((conv, seq, list(goal)))
                costs = [min(min(table[4 * e + s] + goal[e] for e in range(4)), NEVER) for s in range(4)]
                goal = tuple(min(c - min(costs), NEVER) for c in costs)
            if rows:
                yield _batch(rows, ends)

    solved = costs.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("seq").desc()).mapInArrow(backwards, ends)
    left, right = numbered.alias("l"), solved.alias("r")
    joined = left.join(right, F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("l.seq") == F.col("r.seq")), "left")
    return joined.select("l.*", F.coalesce("r.end", F.array(*[F.lit(c).cast("long") for c in END])).alias("end"))


def audits(blocks: DataFrame) -> DataFrame:
    """Blocks with the least audit for each state that they may begin in (the
    first block of a conversation begins in one)."""
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("end"), F.reverse("signature"), F.col("conv_id").asc_nulls_first(), F.col("seq")]
    ordered = blocks.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    kept = ["conv_id", *ORDER, "seq", "signature"]
    schema = T.StructType([*[blocks.schema[c] for c in kept], T.StructField("audits", T.ArrayType(T.StringType()))])

    def walk(batches):
        shared = end = last = None
        for b in batches:
            rows = []
            for *row, goal in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in (*kept, "end")], strict=True):
                if goal != end:
                    shared, end, last = SuffixAutomaton(tuple(goal)), goal, None
                states = range(4) if row[-2] else (START,)
                if last is None or last[0] != row[-1] or len(last[1]) < len(states):
                    shared.read(row[-1])
                    last = (row[-1], [shared.audit(s) for s in states])
                rows.append((*row, last[1]))
            if rows:
                yield _batch(rows, schema)

    return ordered.mapInArrow(walk, schema)


# --- the repaired conversations ------------------------------------------------

class Repair:
    """One conversation, row by row in order, with the audits of its blocks."""

    def __init__(self, emit=None):
        self.emit = emit
        self.first_turn = self.last_turn = None
        self.distinct = 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.initial = None
        self.state = START
        self.audit: list[str] = []
        self.sha, self.any = hashlib.sha256(), False
        self.blocks: list = []
        self.edits, self.letters, self.at, self.row = "", "", 0, 0

    def add_block(self, signature: str, found: list) -> None:
        self.blocks.append((signature, found))

    def _write(self, role: str, text: str) -> None:
        if self.any:
            self.sha.update(b"\n")
        self.sha.update(f"{role}:{text}".encode())
        self.any = True
        if self.emit:
            self.emit(role, text)

    def _open(self) -> None:
        self.letters, found = self.blocks.pop(0)
        self.edits, self.at, self.row = found[self.state if len(found) > 1 else 0], 0, 0
        self.audit.append(self.edits)

    def _inserts(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self._put("", "I")

    def _put(self, text: str, edit: str) -> None:
        self.state = NEXT[self.state]
        self.cost += INSERT if edit == "I" else REROLE
        self._write("user" if self.state == USER else "assistant", text)
        self.at += 1

    def add_row(self, turn, role: str, text: str) -> None:
        if turn is not None:
            self.distinct += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if self.row == len(self.letters):
            self._open()
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        letter = self.letters[self.row]
        self.row += 1
        if letter == "x":
            shown = text.strip(BLANKS)
            self.blank += not shown
            self.duplicate += bool(shown)
        self.truncated += letter.isupper()
        self._inserts()
        edit = self.edits[self.at]
        if edit == "D":
            self.cost += DELETE
            self.at += 1
            return
        self.cost += TRUNCATED * letter.isupper()
        if edit == "R":
            self._put(text, "R")
        else:
            self.state = KEPT[letter.lower()][self.state]
            self._write(role, text)
            self.at += 1

    def finish(self) -> tuple:
        # what is missing at the end of a conversation
        while self.state in (SYSTEM, USER):
            self.audit.append("I")
            self._put("", "I")
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.distinct
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def _streams(batches, columns) -> Iterator[tuple]:
    rows = (r for b in batches for r in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in columns], strict=True))
    yield from groupby(rows, key=itemgetter(0))


def _merged(rows: DataFrame, block: int) -> DataFrame:
    """Rows and blocks in one table, each block before its first row."""
    found = audits(with_end_costs(signatures(rows, block)))
    nothing = lambda kind: F.lit(None).cast(kind)
    texts = _keyed(rows).select("conv_id", *ORDER, F.lit(1).alias("kind"), F.lit(0).cast("long").alias("seq"), "text",
                                nothing("string").alias("signature"), nothing("array<string>").alias("audits"))
    plans = found.select("conv_id", *ORDER, F.lit(0).alias("kind"), "seq", nothing("string").alias("text"), "signature", "audits")
    keys = _by(("conv_id", *ORDER, "kind", "seq"))
    return texts.unionByName(plans).repartition("conv_id").sortWithinPartitions(*keys)


_STREAM = ("conv_id", "turn", "role", "copy", "kind", "text", "signature", "audits")


def _feed(repair: Repair, rows) -> None:
    for _, turn, role, copy, kind, text, signature, found in rows:
        if kind == 0:
            repair.add_block(signature, found)
        elif copy >= 0:
            repair.add_row(turn, role, text)


def audit_conversations(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text,
    copy; see ``damage`` and ``whole``): its faults, the cost of its cheapest
    repair, the audit and the digest of the repaired rows."""
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType([rows.schema["conv_id"], *[T.StructField(n, T.LongType()) for n in names],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def judge(batches):
        done = []
        for conv, group in _streams(batches, _STREAM):
            repair = Repair()
            _feed(repair, group)
            done.append((conv, *repair.finish()))
            if len(done) == 4096:
                yield _batch(done, schema)
                done = []
        if done:
            yield _batch(done, schema)

    return _merged(rows, block).mapInArrow(judge, schema)


def repair_conversations(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired rows: conv_id, position (from 0), role, text."""
    schema = T.StructType([rows.schema["conv_id"], T.StructField("position", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def rebuild(batches):
        out: list[tuple] = []
        for conv, group in _streams(batches, _STREAM):
            count = 0

            def emit(role, text, conv=conv):
                nonlocal count
                out.append((conv, count, role, text))
                count += 1

            repair = Repair(emit)
            for row in group:
                _feed(repair, [row])
                if len(out) >= 4096:
                    yield _batch(out, schema)
                    out.clear()
            repair.finish()
        if out:
            yield _batch(out, schema)

    return _merged(rows, block).mapInArrow(rebuild, schema)


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by the stated rule, audited and repaired."""
    return audit_conversations(damage(read_table(spark, sf_dir, "conversations")))
