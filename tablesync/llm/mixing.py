"""Mixing sources to target weights by Pfair scheduling.

Documents of a source come in the order of a hash of their ids and are cut into blocks. With
weight w = share / sum of shares, block b of a source may not come before slot floor(b / w),
its release, and must come before slot ceil((b + 1) / w), its deadline. Each slot goes to the
released block with the earliest deadline. Such a schedule exists for any weights and this
rule finds it, so at every slot each source has had its weight's worth of blocks, give or take
less than one block.

Shares are whole numbers, so the schedule repeats after as many slots as their sum. Only one
cycle is scheduled, in SQL; it has at most MOST_SLOTS slots whatever the data. The place of a
document follows from its rank in its source by arithmetic.

Sources without a share of their own, a null source included, are pooled into one more source
with the share `rest`. When a source runs out its slots are left out and the others go on, so
every row is placed: the deviation then counts in slots, those left out included. The
documents of a block are adjacent. Weights count documents.
"""

from __future__ import annotations

from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, free_name

BLOCK = 16
MOST_SLOTS = 10_000
ROWS_PER_PIECE = 2048


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def cycle(spark: SparkSession, shares: list[int]) -> DataFrame:
    """One cycle of the schedule: (slot, i, k, before), the k-th block of source i at each slot
    and how many blocks of every source came before it."""
    total = sum(shares)
    sources = F.sequence(F.lit(0), F.lit(len(shares) - 1))
    share = _longs(shares)

    def step(state: Column, slot: Column) -> Column:
        done = state["done"]

        def bid(i: Column) -> Column:
            had, c = done[i], share[i]
            released = (had < c) & (F.floor(had * total / c) <= slot)
            deadline = F.ceil((had + 1) * total / c)
            return F.when(released, F.struct(deadline.alias("deadline"), i.alias("i")))

        chosen = F.array_min(F.transform(sources, bid))["i"]
        now = F.struct(chosen.alias("i"), done.alias("before"))
        return F.struct(
            F.transform(done, lambda n, i: F.when(i == chosen, n + 1).otherwise(n)).alias("done"),
            F.concat(state["slots"], F.array(now)).alias("slots"),
        )

    start = F.struct(
        _longs([0] * len(shares)).alias("done"),
        F.array().cast("array<struct<i:int,before:array<bigint>>>").alias("slots"),
    )
    slots = F.aggregate(F.sequence(F.lit(0), F.lit(total - 1)), start, step, lambda state: state["slots"])
    rows = spark.range(1).select(F.posexplode(slots).alias("slot", "made"))
    return rows.select(
        F.col("slot").cast("long"), F.col("made.i").alias("i"), F.element_at("made.before", F.col("made.i") + 1).alias("k"),
        F.col("made.before").alias("before"),
    )


def _shares(weights: dict[str | None, int], rest: int) -> list[int]:
    shares = [*weights.values(), rest]
    if any(not isinstance(c, int) or c < 1 for c in shares):
        raise ValueError("shares are whole numbers of 1 or more")
    common = reduce(gcd, shares)
    shares = [c // common for c in shares]
    if sum(shares) > MOST_SLOTS:
        raise ValueError(f"shares add up to more than {MOST_SLOTS}: use coarser ones")
    return shares


def mix(docs: DataFrame, weights: dict[str | None, int], rest: int = 1, block: int = BLOCK,
        id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """docs with the columns mix_block, mix_release, mix_deadline, mix_slot and mix_position.

    mix_position numbers all rows from 0 without gaps. If docs has a column of such a name,
    the new one gets underscores. Null ids come first in their source's order; rows that share an id are ordered
    by a hash of the whole row, and equal rows in any order. An empty table gives no rows.
    """
    spark = docs.sparkSession
    shares = _shares(weights, rest)
    total, n_sources = sum(shares), len(shares)
    names = {c: free_name(docs, c) for c in (
        "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_position", "mix_source", "mix_key", "mix_piece", "mix_rank",
        "mix_of", "mix_in", "mix_ahead", "mix_i", "mix_k", "mix_at", "mix_before")}
    source, key, piece, rank = (names[c] for c in ("mix_source", "mix_key", "mix_piece", "mix_rank"))

    index = F.lit(n_sources - 1)
    for i, name in enumerate(weights):
        index = F.when(column(source_col).eqNullSafe(F.lit(name)), i).otherwise(index)
    text = F.md5(F.coalesce(column(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = docs.withColumn(source, index.cast("int")).withColumn(key, text)

    # One count per source: as many as there are shares.
    counts = dict(rows.groupBy(source).count().collect())
    n_rows = [counts.get(i, 0) for i in range(n_sources)]
    n_pieces = _longs([-(-max(n, 1) // ROWS_PER_PIECE) for n in n_rows])
    spread = F.conv(F.substring(key, 1, 12), 16, 10).cast("double") / float(1 << 48)
    rows = rows.withColumn(piece, F.floor(spread * n_pieces[F.col(source)]))

    # A source of any size is ranked in pieces: ranges of the hash, with the counts before each.
    sizes = rows.groupBy(source, piece).count()
    earlier = Window.partitionBy(source).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col(source).alias(names["mix_of"]), F.col(piece).alias(names["mix_in"]),
        F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias(names["mix_ahead"]))
    plain = [column(f.name) for f in docs.schema if f.dataType.typeName() not in ("map", "variant", "struct", "array")]
    order = Window.partitionBy(source, piece).orderBy(key, column(id_col), F.xxhash64(*plain) if plain else F.lit(0))
    rows = rows.withColumn(rank, F.row_number().over(order) - 1)
    rows = rows.join(sizes.hint("merge"), (F.col(source) == F.col(names["mix_of"])) & (F.col(piece) == F.col(names["mix_in"])))
    rows = rows.withColumn(rank, F.col(rank) + F.col(names["mix_ahead"]))

    table = cycle(spark, shares).select(
        *[F.col(c).alias(names[x]) for c, x in (("i", "mix_i"), ("k", "mix_k"), ("slot", "mix_at"), ("before", "mix_before"))])
    c = _longs(shares)[F.col(source)]
    number = F.floor(F.col(rank) / block)
    rounds = F.floor(number / c)
    # At most MOST_SLOTS rows, whatever the data.
    rows = rows.withColumn(names["mix_block"], number).join(
        F.broadcast(table), (F.col(source) == F.col(names["mix_i"])) & (F.col(names["mix_block"]) % c == F.col(names["mix_k"])))
    ahead = F.zip_with(
        F.zip_with(names["mix_before"], _longs(shares), lambda b, s: (b + rounds * s) * block), _longs(n_rows), lambda x, n: F.least(x, n))
    position = F.aggregate(ahead, F.lit(0).cast("long"), lambda a, x: a + x) + F.col(rank) % block
    b = F.col(names["mix_block"])
    return rows.select(
        *[column(x) for x in docs.columns], b.cast("long").alias(names["mix_block"]),
        F.floor(b * total / c).alias(names["mix_release"]), F.ceil((b + 1) * total / c).alias(names["mix_deadline"]),
        (rounds * total + F.col(names["mix_at"])).cast("long").alias(names["mix_slot"]), position.cast("long").alias(names["mix_position"]))


def in_mixed_order(docs: DataFrame, weights: dict[str | None, int], **options) -> DataFrame:
    """docs in the mix's order: written, its files and their rows follow each other in it."""
    mixed = mix(docs, weights, **options)
    position = column(mixed.columns[-1])
    return mixed.repartitionByRange(position).sortWithinPartitions(position).select(*[column(c) for c in docs.columns])


def sql(weights: dict[str, int], rest: int, block: int = BLOCK) -> str:
    """The same over documents (doc_id, source) as one DuckDB statement."""
    shares = _shares(weights, rest)
    g, total = len(shares), sum(shares)
    cases = " ".join(f"WHEN source = '{name}' THEN {i}" for i, name in enumerate(weights))
    return f"""
WITH RECURSIVE params AS (SELECT {shares} AS c, {[0] * g} AS zero),
run(t, done) AS (
  SELECT 0, zero FROM params
  UNION ALL
  SELECT t + 1, list_transform(range(0, {g}), lambda i: done[i + 1] + CASE WHEN i = pick THEN 1 ELSE 0 END)
  FROM (SELECT t, done, list_min(list_filter(list_transform(range(0, {g}), lambda i:
          CASE WHEN done[i + 1] < c[i + 1] AND (done[i + 1] * {total}) // c[i + 1] <= t
               THEN (((done[i + 1] + 1) * {total} + c[i + 1] - 1) // c[i + 1]) * {g} + i END), lambda x: x IS NOT NULL)) % {g} AS pick
        FROM run, params WHERE t < {total})
),
slots AS (
  SELECT a.t, a.done, list_position(list_transform(range(1, {g + 1}), lambda i: b.done[i] - a.done[i]), 1) - 1 AS i
  FROM run a JOIN run b ON b.t = a.t + 1
),
ranked AS (
  SELECT doc_id, source, CASE {cases} ELSE {g - 1} END AS i,
         row_number() OVER (PARTITION BY CASE {cases} ELSE {g - 1} END ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS r
  FROM documents
),
sizes AS (
  SELECT list(coalesce(n, 0) ORDER BY j) AS n
  FROM range(0, {g}) t(j) LEFT JOIN (SELECT i, count(*) AS n FROM ranked GROUP BY i) ON i = j
)
SELECT doc_id, source, r // {block} AS mix_block,
       ((r // {block}) * {total}) // c[x.i + 1] AS mix_release,
       ((r // {block} + 1) * {total} + c[x.i + 1] - 1) // c[x.i + 1] AS mix_deadline,
       ((r // {block}) // c[x.i + 1]) * {total} + s.t AS mix_slot,
       CAST(list_sum(list_transform(range(1, {g + 1}), lambda j:
         least(n[j], {block} * (((r // {block}) // c[x.i + 1]) * c[j] + s.done[j])))) + r % {block} AS BIGINT) AS mix_position
FROM ranked x CROSS JOIN params CROSS JOIN sizes
JOIN slots s ON s.i = x.i AND s.done[x.i + 1] = (x.r // {block}) % c[x.i + 1]
"""
