"""Repairing the structure of conversations at least cost, by iterative-deepening A*.

A conversation's rows, by turn, should have the roles (system?, (user, assistant)+)? or be none.
Rows are kept (K, free), given the role user or assistant (R, 3), or deleted (D, 4); empty rows of
a user or assistant are inserted (I, 3). Blank rows and rows that repeat an earlier one must go; a
row whose text breaks off costs 3 more unless it goes.

The search runs depth first through a conversation, in the order D, I, K, R, within a bound on
the whole cost, and raises the bound to the least cost that it cut off. What a state (row, role
before) is known to need at least is kept in a table, begins with what its rows need one by one,
and grows whenever a visit fails; a state that needs more than is left is not visited again. The
first path that reaches the end is the cheapest, and of the cheapest the least in that order.

Conversations may be of any length: rows are dealt by ranges of their order and cut into spans of
at most SPAN. What a span costs from each role to each is found by the same search; sums of these
from a conversation's end back to its start, four numbers at a time, are the cost beyond each
span, to which it is then searched, and one pass forward picks each span's path. No task holds
more than a span, but for these two passes, which read one narrow row a span in order.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, column

SPAN = 64
BLANKS = " \t\n\x0b\x0c\r"
CLEAN, BLANK, DUPLICATE, TRUNCATED = range(4)
# The role before a row, as far as the grammar sees it.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NONE, SYSTEM, USER, ASSISTANT)
INITIALS = "?sua"
KEEPS = {(NONE, SYSTEM): SYSTEM, (NONE, USER): USER, (SYSTEM, USER): USER, (USER, ASSISTANT): ASSISTANT, (ASSISTANT, USER): USER}
NEXT = (USER, USER, ASSISTANT, USER)  # what may be inserted, or made of a row, behind each
ROLES = (None, None, "user", "assistant")
REROLE, DELETE, INSERT, BREAK = 3, 4, 3, 3
ENDING = (0, 2 * INSERT, INSERT, 0)  # what has to be inserted behind the last row
FAR = 1 << 40


def search(rows: list[int], state: int, beyond: tuple[int, ...]) -> tuple[int, str, int] | None:
    """(cost, edits, state behind) of the best path over rows, with what is needed beyond them; None if there is none.

    A row is 4 * role + fault.
    """
    n = len(rows)
    # What a row needs whatever stands around it, from each row to the end.
    alone = [min(beyond)] * (n + 1)
    for i in range(n - 1, -1, -1):
        role, fault = divmod(rows[i], 4)
        kept = FAR if fault in (BLANK, DUPLICATE) else (REROLE if role == NONE else 0) + (BREAK if fault == TRUNCATED else 0)
        alone[i] = alone[i + 1] + min(DELETE, kept)
    least = [[a] * 4 for a in alone[:n]] + [list(beyond)]
    most = DELETE * n + 2 * INSERT + max(b for b in beyond if b < FAR)
    path: list[str] = []

    def moves(i, q):
        role, fault = divmod(rows[i], 4)
        breaks = BREAK if fault == TRUNCATED else 0
        yield "D", DELETE, i + 1, q
        yield "I", INSERT, i, NEXT[q]
        if fault not in (BLANK, DUPLICATE):
            if (q, role) in KEEPS:
                yield "K", breaks, i + 1, KEEPS[q, role]
            yield "R", REROLE + breaks, i + 1, NEXT[q]

    def visit(i, q, left):
        if least[i][q] > left:
            return None
        if i == n:
            return q
        needed = FAR
        for edit, cost, j, r in moves(i, q):
            path.append(edit)
            end = visit(j, r, left - cost)
            if end is not None:
                return end
            path.pop()
            needed = min(needed, cost + least[j][r])
        least[i][q] = max(least[i][q], needed)
        return None

    while (bound := least[0][state]) <= most:
        end = visit(0, state, bound)
        if end is not None:
            return bound - beyond[end], "".join(path), end
    return None


def faults(rows: DataFrame, scratch: Scratch, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, kind, seq, span): rows in order, with role and first fault as `kind`, seq in the order.

    Ties of a turn come by role, then by the text's first 100 characters, then by its digest.
    """
    blank = F.lit(" ")
    own = rows.select(column(conv_col).alias("conv"), column(turn_col).cast("long").alias("turn"), F.coalesce(column(role_col).cast("string"), blank).alias("role"),
                      F.coalesce(column(text_col).cast("string"), blank).alias("text"))
    own = own.withColumns({"said": F.md5(F.concat("role", F.lit("\x00"), "text").cast("binary")), "number": F.monotonically_increasing_id()})
    own, own_at = scratch.save(own, "rows")
    first = own.groupBy("conv", "said").agg(F.min(F.struct("turn", "number"))["number"].alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select(F.col("conv").alias("first_conv"), F.col("said").alias("first_said"), "first")
    flagged = own.join(first, F.col("conv").eqNullSafe(F.col("first_conv")) & (F.col("said") == F.col("first_said")), "left")
    said = F.rtrim("text", F.lit(BLANKS))
    fault = (F.when(said == "", BLANK).when(F.col("first") != F.col("number"), DUPLICATE)
             .when(~F.right(said, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(CLEAN))
    first_letter = F.left("role", F.lit(1))
    initial = F.lit(NONE)
    for role in (SYSTEM, USER, ASSISTANT):
        initial = F.when(first_letter == INITIALS[role], role).otherwise(initial)
    flagged = flagged.withColumn("kind", (initial * 4 + fault).cast("int")).withColumn("begins", F.left("text", F.lit(100)))
    by = ["conv", "turn", "role", "begins", "said", "number"]
    dealt = flagged.repartitionByRange(*by).sortWithinPartitions(*by).select("conv", "turn", "role", "text", "kind")

    def run(batches):
        at = span = TaskContext.get().partitionId() << 40
        last, held = object(), 0
        for batch in batches:
            spans = []
            for conv in batch.column(0).to_pylist():
                if conv != last or held == SPAN:
                    span, last, held = span + 1, conv, 0
                held += 1
                spans.append(span)
            seq = pa.array(range(at, at + len(spans)), pa.int64())
            at += len(spans)
            yield pa.RecordBatch.from_arrays([*batch.columns, seq, pa.array(spans, pa.int64())], [*batch.schema.names, "seq", "span"])

    out, _ = scratch.save(dealt.mapInArrow(run, f"conv {dealt.schema['conv'].dataType.simpleString()}, turn long, role string, text string, kind int, seq long, span long"), "ordered")
    scratch.drop(own_at)
    return out


def _roles(rows: list[int], state: int, edits: str) -> str:
    """The new role that each edit gives, NONE where it gives none."""
    out, i = [], 0
    for edit in edits:
        given = NEXT[state] if edit in "IR" else NONE
        state = given or (KEEPS[state, rows[i] // 4] if edit == "K" else state)
        i += edit != "I"
        out.append(str(given))
    return "".join(out)


def _by_span(spans: DataFrame, schema: str, work) -> DataFrame:
    """work(row) gives the rows for each of the spans, whose columns but conv are numbers or lists."""

    def run(batches):
        for batch in batches:
            found = [(i, *out) for i, row in enumerate(batch.select(names).to_pylist()) for out in work(row)]
            if found:
                take, *columns = zip(*found, strict=True)
                convs = batch.column("conv").take(pa.array(take, pa.int64()))
                yield pa.RecordBatch.from_arrays([convs, *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], fields)

    names = [c for c in spans.columns if c != "conv"]
    fields = ["conv", *(x.strip().split()[0] for x in schema.split(","))]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    types = [kinds[x.strip().split()[1]] for x in schema.split(",")]
    return spans.mapInArrow(run, f"conv {spans.schema['conv'].dataType.simpleString()}, {schema}")


def _in_order(df: DataFrame, order: list[Column]):
    return df.repartition("conv").sortWithinPartitions("conv", *order)


def _beyond(spans: DataFrame, scratch: Scratch) -> DataFrame:
    """(span, beyond): what is needed behind each span of conversations that have more than one."""
    long = spans.groupBy("conv").count().where("count > 1").select(F.col("conv").alias("long_conv"))
    own = spans.join(long, F.col("conv").eqNullSafe(F.col("long_conv")), "left_semi")

    def costs(row):
        out = []
        for state in STATES:
            for end in STATES:
                may = end in (state, USER, ASSISTANT) or (state, end) == (NONE, SYSTEM)
                goal = tuple(0 if q == end else FAR for q in STATES)
                found = search(row["kinds"], state, goal) if may else None
                out.append(found[0] if found else FAR)
        yield row["span"], out

    dealt = _in_order(_by_span(own.repartition("span"), "span long, costs array<long>", costs), [F.desc("span")])

    def run(batches):
        last, beyond = object(), ENDING
        for batch in batches:
            rows = []
            for conv, span, cost in zip(*(batch.column(c).to_pylist() for c in ("conv", "span", "costs")), strict=True):
                if conv != last:
                    last, beyond = conv, ENDING
                rows.append((span, list(beyond)))
                beyond = tuple(min(FAR, *(cost[4 * q + r] + beyond[r] for r in STATES)) for q in STATES)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.list_(pa.int64())), strict=True)], ["span", "beyond"])

    return scratch.save(dealt.mapInArrow(run, "span long, beyond array<long>"), "beyond")[0]


def _steps(spans: DataFrame, scratch: Scratch) -> DataFrame:
    """(seq, nth, edit, as_role): the edits at each row, inserted ones before it, or after the last row."""
    wide = spans.join(_beyond(spans, scratch), "span", "left")

    def paths(row):
        beyond = row["beyond"]
        for state in STATES if beyond else (NONE,):
            found = search(row["kinds"], state, tuple(beyond or ENDING))
            if found:
                yield row["span"], state, found[1], _roles(row["kinds"], state, found[1]), found[2], row["seqs"]

    found = _by_span(wide, "span long, state int, edits string, roles string, end int, seqs array<long>", paths)
    dealt = _in_order(found, [F.col("span"), F.col("state")])

    def run(batches):
        last, state, span, seq = object(), NONE, None, 0
        for batch in batches:
            rows = []
            for conv, number, begin, edits, roles, end, seqs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != last:
                    rows += _ending(state, seq)
                    last, state, span = conv, NONE, None
                if begin != state or number == span:
                    continue
                span, i, nth = number, 0, 0
                for edit, role in zip(edits, roles, strict=True):
                    rows.append((seqs[i], nth, edit, ROLES[int(role)]))
                    i, nth = (i, nth + 1) if edit == "I" else (i + 1, 0)
                state, seq = end, seqs[-1]
            if rows:
                yield _step_batch(rows)
        if rows := _ending(state, seq):
            yield _step_batch(rows)

    return dealt.mapInArrow(run, "seq long, nth int, edit string, as_role string")


def _ending(state: int, seq: int) -> list[tuple]:
    return [(seq, 1_000_000 + k, "I", ROLES[r]) for k, r in enumerate({SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,)}.get(state, ()))]


def _step_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.string(), pa.string()), strict=True)],
                                      ["seq", "nth", "edit", "as_role"])


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The edits that repair each conversation: (conv, seq, nth, edit, role, text, turn, kind), in the order of seq and nth.

    role and text are those after the edit: of deleted rows those they had, of inserted ones the
    new role and an empty text. kind is 4 times the role's place in `?sua`, plus 1 if the row is
    blank, 2 if it repeats an earlier role and text, 3 if its text breaks off. Inserted rows have
    turn and kind of a neighbour. A null role or text counts as one space, null turns come first,
    rows of a null conversation are one conversation. Turns are whole numbers. Rows that share a
    turn come by role, then by text (its first 100 characters, then its digest). An empty table
    gives no rows. Other columns are not returned.
    """
    scratch = Scratch(rows.sparkSession, "repair")
    ordered = faults(rows, scratch, conv_col, turn_col, role_col, text_col)
    own = F.array_sort(F.collect_list(F.struct("seq", "kind")))
    spans = ordered.groupBy("conv", "span").agg(own.alias("own")).select("conv", "span", F.col("own.seq").alias("seqs"), F.col("own.kind").alias("kinds"))
    spans, _ = scratch.save(spans, "spans")
    steps, _ = scratch.save(_steps(spans, scratch), "steps")
    inserted = F.col("edit") == "I"
    return ordered.join(steps, "seq").select(
        "conv", "seq", "nth", "edit", F.coalesce("as_role", "role").alias("role"), F.when(inserted, "").otherwise(F.col("text")).alias("text"), "turn", "kind")


AUDIT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def audits(edits: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row per conversation of repair()'s edits.

    Each conversation is read in order by one task, as its digest needs; the task holds its edits' letters.
    """
    dealt = _in_order(edits.select("conv", "seq", "nth", "edit", F.left("role", F.lit(1)).alias("initial"), "role", "text", "turn", "kind"), [F.col("seq"), F.col("nth")])

    def run(batches):
        last, state = object(), None
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("conv", "edit", "role", "text", "turn", "kind")]
            for conv, group in groupby(zip(*columns, strict=True), key=lambda r: r[0]):
                if conv != last:
                    if state:
                        out.append((last, *state.done()))
                    last, state = conv, _Audit()
                for row in group:
                    state.add(*row[1:])
            if out:
                yield _audit_batch(out, batch.schema.field("conv").type)
            conv_type = batch.schema.field("conv").type
        if state:
            yield _audit_batch([(last, *state.done())], conv_type)

    schema = f"conv {edits.schema['conv'].dataType.simpleString()}, " + ", ".join(f"{c} {'long' if c in AUDIT[:6] else 'string'}" for c in AUDIT)
    return dealt.mapInArrow(run, schema)


def _audit_batch(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], ["conv", *AUDIT])


class _Audit:
    """What is known of a conversation whose edits come in order."""

    def __init__(self):
        self.low = self.turn = None
        self.turns = self.cost = self.illegal = self.lines = 0
        self.faults = [0] * 4
        self.before = None
        self.letters: list[str] = []
        self.sha = hashlib.sha256()

    def add(self, edit: str, role: str, text: str, turn: int | None, kind: int) -> None:
        self.letters.append(edit)
        initial, fault = divmod(kind, 4)
        if edit != "I":
            self.faults[fault] += 1
            if turn is not None and turn != self.turn:
                self.low = turn if self.low is None else self.low
                self.turn, self.turns = turn, self.turns + 1
            pair = (self.before, initial)
            if self.before is not None and pair not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)):
                self.illegal += 1
            self.before = initial
        self.cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[edit] + (BREAK if edit in "KR" and fault == TRUNCATED else 0)
        if edit != "D":
            self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

    def done(self) -> tuple:
        gaps = self.turn - self.low + 1 - self.turns if self.turns else 0
        return (gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.letters), self.sha.hexdigest())


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by crc32(`conv_id:turn`) % 20; a null there, in role or text is one space.

    0 drops a row, 1 empties its text, 2 takes its full stops, 3 repeats it, 4 makes it the user's.
    """
    blank = F.lit(" ")
    conv, turn, role, text = (F.coalesce(column(c).cast("string"), blank) for c in (conv_col, turn_col, role_col, text_col))
    h = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    out = rows.select(
        column(conv_col).alias("conv_id"), column(turn_col).alias("turn"), F.when(h == 4, "user").otherwise(role).alias("role"),
        F.when(h == 1, "").when(h == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), h.alias("h")).where("h <> 0")
    return out.withColumn("copy", F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("h", "copy")
