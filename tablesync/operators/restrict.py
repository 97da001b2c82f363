"""Keep restricted ids out of an extract.

A restricted list reduces to one column of distinct, non-null keys. How it meets
the source depends on its measured size, never on an estimate:

1. it fits in memory: broadcast it; the source is not shuffled, so a hot id or a
   third of null ids costs nothing extra;
2. it does not, but its whole-number ids do as bitmaps of one bit an id: broadcast those;
3. it does not, but the caller says that the source is frozen, and the listed ids that
   occur in it fit: broadcast those;
4. else shuffle both sides whole. Counts of the source's ids, a shuffle of one narrow row
   per id and task, say which are hot. Rows of a hot id spread over as many salts as it
   takes to make them ordinary, and only its list entry repeats. With prefilter=True a
   Bloom filter of the list, of bounded size, is broadcast first: rows that it rules out skip
   the shuffle, the rest meet the whole list.

Collated keys have no hash that a broadcast could use: they are merged, salted.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import normalise_key
from ..session import written

KEY = "__restricted_key"
SALT = "__restricted_salt"
ROWS = "__restricted_rows"
HOT = "__restricted_hot"
PIECES = "__restricted_pieces"

BROADCAST_LIMIT = 128 * 1024 * 1024  # bytes of keys, row overhead included
HASH_LIMIT = 32 * 1024 * 1024  # bytes of keys in one partition of a shuffled hash join
ROW_OVERHEAD = 48  # bytes a hashed row needs beyond its key
BITMAP = "__restricted_bits"
BUCKET = "__restricted_bucket"
BITMAP_BITS = 32 * 1024  # of Spark's bitmaps
BITMAP_BYTES = BITMAP_BITS // 8 + ROW_OVERHEAD
PREFILTER_LIMIT = 64 * 1024 * 1024  # bytes of a Bloom filter
BITS_PER_KEY = 12  # of a Bloom filter, below its limit: about one row in 100 passes wrongly
PROBES = 4
COLLATED_SALTS = 16
SHARES = 4  # an id is hot when it holds more than this fraction of a partition's rows


@dataclass(frozen=True)
class RestrictionList:
    """Distinct non-null keys of a list, written down, with their form and measured size.

    bitmaps holds whole-number keys once more, a row per 32,768 numbers.
    """

    keys: DataFrame
    kind: str
    n_bytes: int
    source_schema: T.StructType
    n_keys: int = 0
    bitmaps: DataFrame | None = None
    bitmap_bytes: int = 0

    def fits(self, limit: int) -> bool:
        return self.n_bytes <= limit


def _distinct_keys(df: DataFrame, key: Column) -> DataFrame:
    keys = df.select(key.alias(KEY))
    return keys.where(F.col(KEY).isNotNull()).distinct()


def _size_metric() -> Column:
    """Bytes the keys take in a hash table."""
    return F.coalesce(F.sum(F.octet_length(F.col(KEY).cast("string")) + ROW_OVERHEAD), F.lit(0)).alias("n_bytes")


def _size(keys: DataFrame) -> int:
    return keys.agg(_size_metric()).first()[0]


def prepare_list(restricted: DataFrame, right_key: str, normalise: str = "plain", bitmaps: bool = False) -> RestrictionList:
    """Reduce a list to its keys, write them to the shared folder and measure what was written.

    So what is broadcast is what was measured, even if the list grows meanwhile, and tables
    that meet the same list read it once. With bitmaps, whole-number keys ("integer") are kept as
    bits as well, of which a join takes whichever is smaller.
    """
    if bitmaps and normalise != "integer":
        raise ValueError("bitmaps hold keys normalised as 'integer'")
    keys = _distinct_keys(restricted, normalise_key(right_key, normalise, "list"))
    seen = Observation()
    keys = written(keys.observe(seen, _size_metric(), F.count(F.lit(1)).alias("n_keys")), "restricted")
    size, n = seen.get["n_bytes"], seen.get["n_keys"]
    if not bitmaps:
        return RestrictionList(keys, normalise, size, restricted.schema, n)
    rows = Observation()
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(KEY))).alias(BITMAP)
    sets = keys.groupBy(F.bitmap_bucket_number(F.col(KEY)).alias(BUCKET)).agg(bits)
    sets = written(sets.observe(rows, F.count(F.lit(1)).alias("n")), "bitmaps")
    return RestrictionList(keys, normalise, size, restricted.schema, n, sets, rows.get["n"] * BITMAP_BYTES)


def _bit(position: Column) -> Column:
    """Is the bit at a position of the joined bitmap set? Null without a bitmap."""
    byte = F.substring(F.col(BITMAP), F.shiftright(position.cast("int"), 3) + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (position % 8).cast("int")) == 1


def _bitmap_join(df: DataFrame, source_key: Column, listed: RestrictionList, how: str) -> DataFrame:
    """Each id looks up its bit in the one bitmap that could hold it."""
    joined = df.join(F.broadcast(listed.bitmaps), F.bitmap_bucket_number(source_key) == F.col(BUCKET), "left")
    on_list = F.coalesce(_bit(F.bitmap_bit_position(source_key)), F.lit(False))
    if how == "left":
        return joined.withColumn(KEY, F.when(on_list, source_key))
    return joined.where(~on_list if how == "left_anti" else on_list)


def _common_type(df: DataFrame, source_key: Column, keys: DataFrame) -> T.DataType | None:
    """The type in which Spark compares both keys, if equal values of it have equal hashes."""
    dtype = df.select(F.coalesce(source_key, F.lit(None).cast(keys.schema[KEY].dataType)).alias("k")).schema[0].dataType
    exact = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)
    return dtype if isinstance(dtype, exact) else None


def bloom_filter(keys: DataFrame, key: Column, n_keys: int) -> tuple[DataFrame, int] | None:
    """A Bloom filter as rows of (bucket, bits), and the number of buckets; None if the keys would fill it.

    A key's bits lie in one bucket, so that one join finds them all. Filters of as many buckets merge by
    `bitmap_or_agg`.
    """
    buckets = max(1, min(-(-n_keys * BITS_PER_KEY // BITMAP_BITS), PREFILTER_LIMIT // BITMAP_BYTES))
    if n_keys * PROBES > buckets * BITMAP_BITS:
        return None
    bucket, positions = _probes(key, buckets)
    rows = keys.select(bucket.alias(BUCKET), F.explode(F.array(*positions)).alias("position"))
    return rows.groupBy(BUCKET).agg(F.bitmap_construct_agg("position").alias(BITMAP)), buckets


def _probes(key: Column, buckets: int) -> tuple[Column, list[Column]]:
    """A key's bucket and its places in it."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)), [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BITMAP_BITS)) for i in range(PROBES)]


def _prefiltered_join(df: DataFrame, source_key: Column, listed: RestrictionList, how: str) -> DataFrame | None:
    """The rows that a Bloom filter of the list can't rule out are joined with it; None where no filter helps.

    The source is read once for either part. A row that one of the reads sees and the other does
    not is right all the same, as each part decides on its own rows.
    """
    dtype = _common_type(df, source_key, listed.keys)
    made = dtype and bloom_filter(listed.keys, F.col(KEY).cast(dtype), listed.n_keys)
    if not made:
        return None
    bloom, buckets = written(made[0], "bloom"), made[1]
    bucket, positions = _probes(source_key.cast(dtype), buckets)
    marked = df.join(F.broadcast(bloom), bucket == F.col(BUCKET), "left")
    may = _bit(positions[0])
    for position in positions[1:]:
        may = may & _bit(position)
    may = F.coalesce(may, F.lit(False)) & source_key.isNotNull()
    inside = marked.where(may).select(*_columns(df))
    met = _salted_join(inside, source_key, _counted(inside, source_key, listed.keys), listed.n_bytes, how)
    if how == "left_semi":
        return met.select(*_columns(df))
    outside = marked.where(~may).select(*_columns(df))
    if how == "left_anti":
        return outside.union(met.select(*_columns(df)))
    return outside.withColumn(KEY, F.lit(None).cast(listed.keys.schema[KEY].dataType)).union(met.select(*_columns(df), KEY))


def _collated_join(df: DataFrame, source_key: Column, listed: RestrictionList, how: str, limit: int) -> DataFrame:
    """A list that fits is repeated for each salt, so that a hot id, null included, is many tasks."""
    salts = COLLATED_SALTS if listed.n_bytes * COLLATED_SALTS <= limit else 1
    source = df.withColumn(SALT, F.pmod(_row_hash(df), F.lit(salts)).cast("int"))
    keys = listed.keys.select(KEY, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(f"{SALT}_listed"))
    return source.join(keys.hint("merge"), (source_key == F.col(KEY)) & (F.col(SALT) == F.col(f"{SALT}_listed")), how)


def _as_list(restricted, right_key, normalise) -> RestrictionList:
    if isinstance(restricted, RestrictionList):
        return restricted
    if right_key is None:
        raise ValueError("right_key is needed unless the list was prepared")
    return prepare_list(restricted, right_key, normalise)


def _row_hash(df: DataFrame) -> Column:
    """A hash of the row alone, so that a retried task gives each row the same salt."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if _hashable(f.dataType)])


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle before Spark merges small ones."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


class Counted(NamedTuple):
    """The source's hot ids with the number of pieces each is dealt in, and all keys of the list."""

    hot: DataFrame
    keys: DataFrame


def _counted(df: DataFrame, source_key: Column, keys: DataFrame) -> Counted:
    """An id is hot with more than 1/SHARES of an average partition's rows.

    Each hot id holds more than one share: there are at most SHARES times the partitions of them.
    """
    counts = df.groupBy(source_key.alias(HOT)).agg(F.count("*").alias(ROWS))
    share = max(df.count() // (SHARES * _partitions(df.sparkSession)), 1)
    pieces = F.ceil(F.col(ROWS) / share).cast("int")
    return Counted(written(counts.where(F.col(ROWS) > share).select(HOT, pieces.alias(PIECES)), "hot"), keys)


def _salted_join(df: DataFrame, source_key: Column, counted: Counted, n_bytes: int, how: str) -> DataFrame:
    """The whole list against the whole source. An id that is not known as hot has salt 0 on both sides."""
    hot = counted.hot
    salt = F.when(F.col(PIECES).isNull(), F.lit(0)).otherwise(F.pmod(_row_hash(df), F.col(PIECES))).cast("int")
    source = df.join(F.broadcast(hot), source_key.eqNullSafe(F.col(HOT)), "left").withColumn(SALT, salt)
    keys = counted.keys.join(F.broadcast(hot), F.col(KEY) == F.col(HOT), "left")
    salts = F.sequence(F.lit(0), F.coalesce(F.col(PIECES), F.lit(1)) - 1)
    keys = keys.select(KEY, F.explode(salts).alias(f"{SALT}_listed"))
    matches = (source_key == F.col(KEY)) & (F.col(SALT) == F.col(f"{SALT}_listed"))
    # A hash join spares the source a sort; the list's share of a partition must fit.
    strategy = "shuffle_hash" if n_bytes / _partitions(df.sparkSession) <= HASH_LIMIT else "merge"
    return source.join(keys.hint(strategy), matches, how)


def _join(
    df: DataFrame,
    left_key: str,
    listed: RestrictionList,
    how: str,
    limit: int = BROADCAST_LIMIT,
    frozen: bool = False,
    changing: bool = False,
    prefilter: bool = False,
) -> DataFrame:
    """df joined with the list's keys; columns beside df's own are for the caller to drop.

    A list beyond the limit meets the source whole, so rows that arrive after the hot ids
    were counted are compared too. Only if the caller says that the source is frozen may
    the part of the list that occurs in it be broadcast instead. With changing the rows
    are written first, for a caller who wants those of one moment. prefilter spares the shuffle
    most rows whose id is not listed, and reads the source once more.
    """
    source_key = normalise_key(left_key, listed.kind, "source")
    if listed.kind.endswith("collated"):
        return _collated_join(df, source_key, listed, how, limit)
    if listed.bitmaps is not None and listed.bitmap_bytes <= min(limit, listed.n_bytes):
        return _bitmap_join(df, source_key, listed, how)
    if listed.fits(limit):
        return df.join(F.broadcast(listed.keys), source_key == F.col(KEY), how)
    if changing:
        df = written(df, "source")
    if frozen:
        ids = df.select(source_key.alias(KEY)).distinct()
        present = written(listed.keys.join(ids, KEY, "left_semi"), "present")
        if _size(present) <= limit:
            return df.join(F.broadcast(present), source_key == F.col(KEY), how)
    if prefilter:
        joined = _prefiltered_join(df, source_key, listed, how)
        if joined is not None:
            return joined
    return _salted_join(df, source_key, _counted(df, source_key, listed.keys), listed.n_bytes, how)


def _columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def anti_join(
    df: DataFrame,
    restricted: DataFrame | RestrictionList,
    left_key: str,
    right_key: str | None = None,
    normalise: str = "plain",
    keep_right: bool = False,
    **sizing,
) -> DataFrame:
    """Rows of df whose id is not on the list. A null id is never on it.

    The list is measured now, by a job of its own; the join itself stays lazy. A list
    that is costly to read, or met by several tables, is better prepared once. Rows that
    df's source gets meanwhile are compared with the list too; frozen=True says there are none.
    keep_right adds the list's columns, prefixed r_. They are null throughout, as in
    `select *` over the outer join that this replaces.
    """
    listed = _as_list(restricted, right_key, normalise)
    kept = _join(df, left_key, listed, "left_anti", **sizing).select(*_columns(df))
    if not keep_right:
        return kept
    nulls = [F.lit(None).cast(f.dataType).alias(f"r_{f.name}") for f in listed.source_schema]
    return kept.select("*", *nulls)


def anti_join_bucketed(source: DataFrame, listed: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of source whose id is not listed, where both are tables in as many buckets of these columns.

    The list may repeat ids and hold nulls. Neither side is shuffled; both keys are of one type.
    """
    keys = listed.select(F.col(f"`{right_key}`").alias(KEY))
    return source.join(keys.hint("merge"), F.col(f"`{left_key}`") == F.col(KEY), "left_anti")


def only_restricted(
    df: DataFrame,
    restricted: DataFrame | RestrictionList,
    left_key: str,
    right_key: str | None = None,
    normalise: str = "integer",
    **sizing,
) -> DataFrame:
    """Rows of df whose id is on the list."""
    listed = _as_list(restricted, right_key, normalise)
    return _join(df, left_key, listed, "left_semi", **sizing).select(*_columns(df))


def flag_restricted(
    df: DataFrame,
    restricted: DataFrame | RestrictionList,
    left_key: str,
    right_key: str | None = None,
    out: str = "is_restricted",
    normalise: str = "integer",
    **sizing,
) -> DataFrame:
    """df with a boolean: is the id on the list? Unreadable and null ids are not."""
    listed = _as_list(restricted, right_key, normalise)
    joined = _join(df, left_key, listed, "left", **sizing)
    return joined.select(*_columns(df), F.col(KEY).isNotNull().alias(out))


def restriction_keys(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Distinct whole-number ids of several id columns, as (list_name, id) rows.

    One scan and one shuffle for all columns; repeats collapse before the shuffle.
    """
    pairs = [
        F.struct(F.lit(c).alias("list_name"), normalise_key(c, "integer").alias("id")) for c in cols
    ]
    return df.select(F.inline(F.array(*pairs))).where("id is not null").distinct()
