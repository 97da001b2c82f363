"""Quotation linking: reply-ordered conversations without the quotes.

A line's quote level is the number of > signs it begins with. Lines of one level in a row are
a passage, at level 0 the message's own. Passages are normalised (lower case, white space
collapsed) and hashed, whole, by paragraph and line by line. A quoted hash is joined to the
latest earlier message of its conversation whose own text has it; one of LEAST_CHARS that its
conversation doesn't have, to the first message, by conversation and turn, that has it, if
that is in a conversation with a smaller id. At each level the message that explains the most
quoted characters is the one quoted, at ties one of the own conversation, then of the smallest,
then the latest; the one quoted at the lowest level is the parent. Parents come earlier, by
conversation and turn, so threads are trees.

Originals and quotes of a conversation are one row per hash and turn before they meet, over a
range partition that may split a hash; one original per hash serves other conversations.
Threads are ranked by a range partition over all rows, so neither a conversation nor a thread
has to fit a task.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, column, free_name

MARK = re.compile(r"(?:[ \t]{0,3}>)+")
HEADER = re.compile(r"^[^\n>]{0,300}\b(?:wrote|writes)\s*:$")
LEAST_CHARS = 20  # of a passage that is looked for in other conversations


def parse(text: str) -> tuple[str, list[tuple[int, list[str]]]]:
    """The message's own text, and its quoted passages with their levels, in order.

    A line that announces a quotation ("... wrote:") right before a deeper level is no one's
    text. Own text loses the blank lines around what was quoted.
    """
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    before = 0
    for line in text.split("\n"):
        line = line.removesuffix("\r")
        mark = MARK.match(line)
        level = mark[0].count(">") if mark else 0
        content = line[mark.end() :].removeprefix(" ") if mark else line
        lines = own if level == 0 else passages[-1][1] if level == before and passages else None
        if level > before:
            above = own if before == 0 else passages[-1][1]
            while above and not above[-1].strip():
                above.pop()
            if above and HEADER.match(above[-1]):
                above.pop()
        if lines is None:
            passages.append((level, []))
            lines = passages[-1][1]
        lines.append(content)
        before = level
    return "\n".join(own).strip("\n"), [(n, x) for n, x in passages if any(s.strip() for s in x)]


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def key_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def units(lines: list[str]) -> list[tuple[int, int, bool]]:
    """(hash, characters, whole passage?) of a passage, of its paragraphs and of its lines; each hash once."""
    whole = normalised("\n".join(lines))
    found = {key_of(whole): (len(whole), True)} if whole else {}
    paragraphs = [" ".join(x) for blank, x in groupby(lines, key=lambda line: not line.strip()) if not blank]
    for text in (*paragraphs, *lines):
        if part := normalised(text):
            found.setdefault(key_of(part), (len(part), False))
    return [(h, n, all_) for h, (n, all_) in found.items()]


UNIT = "array<struct<hash:bigint,chars:int,whole:boolean>>"
PARSED = f"own string, own_units {UNIT}, quoted array<struct<level:int,hash:bigint,chars:int,whole:boolean>>, levels int, passages int"


def parsed(messages: DataFrame, text_col: str, names: dict[str, str]) -> DataFrame:
    """messages with the parts of their texts; a null text is empty."""
    schema = T.StructType([*messages.schema, *(T.StructField(names[f.name], f.dataType) for f in T.StructType.fromDDL(PARSED))])
    at = messages.columns.index(text_col)
    unit = pa.struct([("hash", pa.int64()), ("chars", pa.int32()), ("whole", pa.bool_())])
    quote = pa.struct([("level", pa.int32()), *unit])

    def run(batches):
        for batch in batches:
            own, own_units, quoted, levels, counts = [], [], [], [], []
            for text in batch.column(at).to_pylist():
                body, passages = parse(text or "")
                own.append(body)
                own_units.append([dict(hash=h, chars=n, whole=w) for h, n, w in units(body.split("\n"))])
                quoted.append([dict(level=level, hash=h, chars=n, whole=w) for level, x in passages for h, n, w in units(x)])
                levels.append(max((level for level, _ in passages), default=0))
                counts.append(len(passages))
            new = [pa.array(own, pa.string()), pa.array(own_units, pa.list_(unit)), pa.array(quoted, pa.list_(quote)),
                   pa.array(np.array(levels, np.int32)), pa.array(np.array(counts, np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema.names)

    return messages.mapInArrow(run, schema)


def _latest(own: DataFrame, quoted: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, hash, turn, said): the latest turn before a quoting one whose own text has the hash."""
    key = ["conv", "hash"]
    asked = quoted.select(*key, "turn").distinct()
    told = own.join(asked.select(*key).distinct(), key, "left_semi").select(*key, "turn").distinct()
    # A turn does not quote itself: its quotes come before its own text.
    both = asked.withColumn("said", F.lit(None).cast("long")).union(told.select(*key, "turn", F.col("turn").alias("said")))
    both = both.repartitionByRange(*key, "turn", F.col("said").isNotNull()).withColumn("pid", F.spark_partition_id())
    both, _ = scratch.save(both, "turns")
    earlier = Window.partitionBy(*key).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    ahead = both.groupBy(*key, "pid").agg(F.max("said").alias("ahead")).withColumn("ahead", F.max("ahead").over(earlier))
    here = Window.partitionBy("pid", *key).orderBy("turn", F.col("said").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("last", F.max("said").over(here)).where("said is null").join(ahead, [*key, "pid"])
    return found.select(*key, "turn", F.coalesce("last", "ahead").alias("said")).where("said is not null")


def _links(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, turn, mark, level, to): the message that each level of a message quotes."""
    rows = rows.where("conv is not null and turn is not null")
    own = rows.select("conv", "turn", F.explode("own_units").alias("u")).select("conv", "turn", "u.hash", "u.chars")
    quoted = rows.select("conv", "turn", "mark", F.explode("quoted").alias("q"))
    quoted = quoted.select("conv", "turn", "mark", "q.level", "q.hash", "q.chars")
    anywhere = own.where(f"chars >= {LEAST_CHARS}").groupBy("hash").agg(F.min(F.struct("conv", "turn")).alias("origin"))
    anywhere, _ = scratch.save(anywhere, "anywhere")
    inside, _ = scratch.save(_latest(own, quoted, scratch), "inside")

    quoted = quoted.join(inside, ["conv", "hash", "turn"], "left")
    known = quoted.where("said is not null").withColumn("to", F.struct("conv", F.col("said").alias("turn")))
    rest = quoted.where(f"said is null and chars >= {LEAST_CHARS}").join(anywhere, "hash")
    rest = rest.where("origin.conv < conv").withColumnRenamed("origin", "to")
    votes = known.unionByName(rest, allowMissingColumns=True).groupBy("conv", "turn", "mark", "level", "to").agg(F.sum("chars").alias("chars"))
    best = F.max_by("to", F.struct("chars", F.col("to.conv") == F.col("conv"), F.bitwise_not("to.conv"), "to.turn"))
    return votes.groupBy("conv", "turn", "mark", "level").agg(best.alias("to"))


def _threads(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, turn, root, depth): a message's first ancestor and how far it is, by pointer doubling.

    A message whose pointer has reached a root takes no part in later rounds.
    """
    active = parents.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth"))
    active, _ = scratch.save(active, "pointers")
    done = []
    while True:
        known = reduce(DataFrame.union, [*done, active])
        up = known.select(F.struct("conv", "turn").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"))
        moved = active.join(up, "root", "left").select(
            "conv", "turn", F.coalesce("above", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("above").isNotNull().alias("moved"))
        moved, _ = scratch.save(moved, "pointers")
        done.append(moved.where("not moved").drop("moved"))
        active = moved.where("moved").drop("moved")
        if active.isEmpty():
            return reduce(DataFrame.union, done)


def ranked(rows: DataFrame, group: list[str], order: list[str], out: str, scratch: Scratch) -> DataFrame:
    """rows with a number from 0 within each group, in order; a group may span partitions."""
    pid, ahead = free_name(rows, "pid"), free_name(rows, "ahead")
    dealt = rows.repartitionByRange(*group, *order).withColumn(pid, F.spark_partition_id())
    dealt, _ = scratch.save(dealt, "ranges")
    sizes = dealt.groupBy(*group, pid).agg(F.count("*").alias(ahead))
    earlier = Window.partitionBy(*group).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn(ahead, F.coalesce(F.sum(ahead).over(earlier), F.lit(0)))
    number = F.row_number().over(Window.partitionBy(pid, *group).orderBy(*order)) - 1
    return dealt.withColumn(out, number).join(sizes, [*group, pid]).withColumn(out, F.col(out) + F.col(ahead)).drop(pid, ahead)


def conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """messages without quotes, with their parents, threads and places in them.

    Returns the columns of messages, text_col without quotes, and parent_conv, parent_turn,
    quote_levels, quoted_passages, linked_levels, thread_conv, thread_turn, depth and
    reply_order (from 0, by depth, conversation and turn). Columns of such names are replaced.
    A message without a quote that is found begins a thread. Ids and turns are whole numbers;
    a row without one of them has no parent, is quoted by none and has no place. Rows that
    share both are one message to those that quote it, and equal rows may come in any order.
    Null and empty texts have nothing to quote. An empty table gives no rows.
    """
    scratch = Scratch(messages.sparkSession, "quotes")
    new = ["parent_conv", "parent_turn", "quote_levels", "quoted_passages", "linked_levels", "thread_conv", "thread_turn", "depth", "reply_order"]
    messages = messages.select(*[column(c) for c in messages.columns if c.lower() not in new])
    names = {f.name: free_name(messages, f.name) for f in T.StructType.fromDDL(PARSED)}
    rows = parsed(messages.withColumn(text_col, column(text_col).cast("string")), text_col, names)
    rows, _ = scratch.save(rows, "parsed")
    mark = F.xxhash64(column(text_col))  # tells apart rows that share conversation and turn
    keyed = rows.select(column(conv_col).cast("long").alias("conv"), column(turn_col).cast("long").alias("turn"), mark.alias("mark"),
                        *[F.col(names[c]).alias(c) for c in ("own_units", "quoted")])
    links, _ = scratch.save(_links(keyed, scratch), "links")
    replies = links.groupBy("conv", "turn", "mark").agg(F.min_by("to", "level").alias("parent"), F.count("*").alias("linked"))
    replies, _ = scratch.save(replies, "replies")

    # Rows that share conversation and turn share the thread of the one with the earliest parent.
    parents = replies.groupBy("conv", "turn").agg(F.min("parent").alias("parent"))
    threads = _threads(parents, scratch)
    keys = keyed.select("conv", "turn", "mark").where("conv is not null and turn is not null")
    placed = keys.join(threads, ["conv", "turn"], "left").select(
        "conv", "turn", "mark", F.coalesce(F.col("root"), F.struct("conv", "turn")).alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"))
    flat = placed.select("conv", "turn", "mark", F.col("thread.conv").alias("tc"), F.col("thread.turn").alias("tt"), "depth")
    flat = ranked(flat, ["tc", "tt"], ["depth", "conv", "turn", "mark"], "place", scratch)
    # Repeated rows have places of their own, dealt out by number.
    nth = Window.partitionBy("conv", "turn", "mark")
    flat = flat.withColumn("nth", F.row_number().over(nth.orderBy("place")))
    n = free_name(rows, "nth")
    keys = [column(conv_col).cast("long"), column(turn_col).cast("long"), mark]
    rows = rows.withColumn(n, F.row_number().over(Window.partitionBy(*keys).orderBy(mark)))

    def beside(table: DataFrame, named: list[str], and_nth: bool) -> DataFrame:
        """rows with a table's row as one column, joined on conversation, turn and text."""
        packed = table.select(F.struct(*table.columns).alias(free_name(rows, "packed")))
        own = F.col(packed.columns[0])
        same = [key == own[c] for key, c in zip(keys, ("conv", "turn", "mark"), strict=True)]
        out = rows.join(packed, [*same, F.col(n) == own["nth"]] if and_nth else same, "left")
        named.append(packed.columns[0])
        return out

    named: list[str] = []
    rows = beside(flat, named, True)
    rows = beside(replies, named, False)
    place, reply = (F.col(c) for c in named)
    kept = [F.col(names["own"]).alias(x) if x == text_col else column(x) for x in messages.columns]
    return rows.select(
        *kept, reply["parent"]["conv"].alias("parent_conv"), reply["parent"]["turn"].alias("parent_turn"),
        F.col(names["levels"]).alias("quote_levels"), F.col(names["passages"]).alias("quoted_passages"),
        F.coalesce(reply["linked"], F.lit(0)).alias("linked_levels"), place["tc"].alias("thread_conv"), place["tt"].alias("thread_turn"),
        place["depth"].alias("depth"), place["place"].cast("long").alias("reply_order"))


def with_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """messages as mail programs send them: each below a quotation of the turn before, which in
    turn quotes the one before that. Columns stay as they are."""
    key = [free_name(messages, c) for c in ("conv_", "turn_", "said_")]
    said = messages.select(column(conv_col).alias("conv"), column(turn_col).alias("turn"), column(text_col).alias("said")).where("said is not null")
    said = said.groupBy("conv", "turn").agg(F.min("said").alias("said"))
    one, two = (said.toDF(*[f"{c}{i}" for c in key]) for i in (1, 2))
    rows = messages.join(one, (column(conv_col) == F.col(f"{key[0]}1")) & (column(turn_col) - 1 == F.col(f"{key[1]}1")), "left")
    rows = rows.join(two, (column(conv_col) == F.col(f"{key[0]}2")) & (column(turn_col) - 2 == F.col(f"{key[1]}2")), "left")
    before = [F.col(f"{key[2]}{i}") for i in (1, 2)]
    quote = lambda text, mark: F.concat(F.lit(mark), F.regexp_replace(text, "\n", f"\n{mark}"))
    parts = [F.when(before[0].isNotNull(), F.concat_ws("\n", F.lit("On an earlier day someone wrote:"), quote(before[1], "> > "), quote(before[0], "> ")))]
    text = F.concat_ws("\n\n", *parts, column(text_col))
    return rows.select(*[F.when(column(c).isNotNull(), text).alias(c) if c == text_col else column(c) for c in messages.columns])
