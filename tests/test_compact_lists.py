"""Lists as bitmaps, behind a Bloom filter, with collated keys, and as they were measured."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tablesync import anti_join, flag_restricted, only_restricted, prepare_list
from tablesync.operators import restrict


def kept(df, key="k"):
    return Counter(r[key] for r in df.collect())


def test_bitmaps_agree_for_any_whole_number(spark):
    listed = [0, 1, -1, 32768, 32769, -32768, -32767, 65536, 2**62, -(2**62), 2**63 - 1, -(2**63)]
    given = sorted({x + d for x in listed for d in (-1, 0, 1) if -(2**63) <= x + d < 2**63}) + [None]
    source = spark.createDataFrame([(x,) for x in given], "k long")
    bits = prepare_list(spark.createDataFrame([(x,) for x in listed], "r long"), "r", "integer", bitmaps=True)
    bits = replace(bits, n_bytes=1 << 40)  # as if its keys were more than its bits
    assert kept(only_restricted(source, bits, "k")) == Counter(listed)
    assert kept(anti_join(source, bits, "k")) == Counter(x for x in given if x not in listed)
    flags = {r["k"]: r["is_restricted"] for r in flag_restricted(source, bits, "k").collect()}
    assert flags == {x: x in listed for x in given}
    plan = anti_join(source, bits, "k")._jdf.queryExecution().toString()
    assert "bitmap_bucket_number" in plan


def test_a_hundred_million_ids_stay_below_the_limit(spark):
    bits = prepare_list(spark.range(0, 3_000_000, 1, 4).toDF("r"), "r", "integer", bitmaps=True)
    assert bits.n_keys == 3_000_000 and bits.bitmap_bytes * 100 / 3 < 128 << 20 < bits.n_bytes * 100 / 3
    with pytest.raises(ValueError):
        prepare_list(spark.range(3).toDF("r"), "r", "plain", bitmaps=True)


@pytest.mark.parametrize("kind", ["int", "string", "decimal(20,2)", "date"])
def test_prefiltered_joins_agree(spark, kind):
    value = "date_add(date'2024-01-01', cast(id as int))" if kind == "date" else f"cast(id as {kind})"
    source = spark.range(3000).selectExpr(f"CASE WHEN id % 3 = 0 THEN {value.replace('id ', '7 ').replace('(id', '(7')} WHEN id % 50 > 0 THEN {value} END AS k", "id")
    listed = spark.range(5000).where("id % 9 = 7").selectExpr(f"{value} AS r")
    for join in (anti_join, only_restricted, flag_restricted):
        plain = join(source, listed, "k", "r", normalise="plain")
        sifted = join(source, listed, "k", "r", normalise="plain", limit=0, prefilter=True)
        assert sorted(map(str, sifted.collect())) == sorted(map(str, plain.collect()))


def test_a_filter_that_keys_would_fill_is_not_used(spark, monkeypatch):
    monkeypatch.setattr(restrict, "PREFILTER_LIMIT", restrict.BITMAP_BYTES)
    listed = spark.range(0, 40_000, 2).toDF("r")
    assert restrict.bloom_filter(listed, F.col("r"), 20_000) is None
    assert kept(anti_join(spark.range(100).toDF("k"), listed, "k", "r", limit=0, prefilter=True)) == Counter(range(1, 100, 2))


def test_prefiltered_join_compares_rows_that_arrive_late(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.range(100).toDF("k").write.parquet(path)
    joined = anti_join(spark.read.parquet(path), spark.range(90, 300).toDF("r"), "k", "r", limit=0, prefilter=True)
    spark.range(95, 120).toDF("k").write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    assert kept(joined) == Counter(range(90))


def test_a_prefilter_spares_the_shuffle(spark):
    """Rows that cross exchanges, by the plan's own figures."""

    def rows(execution):
        total, todo = 0, [execution.executedPlan()]
        while todo:
            node = todo.pop()
            name = node.nodeName()
            if name == "AdaptiveSparkPlan":
                todo.append(node.executedPlan())
                continue
            if name.endswith("QueryStage"):
                todo.append(node.plan())
                continue
            if name == "Exchange":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
        return total

    def moved(**how):
        source, listed = spark.range(0, 200_000, 1, 4).toDF("k"), spark.range(0, 200_000, 20).toDF("r")
        execution = anti_join(source, listed, "k", "r", limit=0, **how)._jdf.queryExecution()
        execution.toRdd().count()
        return rows(execution)

    assert moved(prefilter=True) < moved() / 5


def test_a_list_that_grows_is_broadcast_as_it_was_measured(spark, tmp_path):
    path = str(tmp_path / "list")
    spark.range(10).toDF("r").write.parquet(path)
    joined = anti_join(spark.range(100).toDF("k"), spark.read.parquet(path), "k", "r")
    spark.range(10, 90).toDF("r").write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    assert kept(joined) == Counter(range(10, 100))


def test_collated_keys(spark):
    composed, apart = "café", "café"
    source = spark.createDataFrame([(composed,), (apart,), (apart.upper() + "  ",), ("cafe",), ("Å",), (None,), (None,)], "k string")
    listed = spark.createDataFrame([(composed.upper(),), ("Å",), (None,)], "r string")
    assert kept(anti_join(source, listed, "k", "r", "collated")) == Counter(["cafe", None, None])
    assert kept(only_restricted(source, listed, "k", "r", "collated", limit=0)) == Counter([composed, apart, apart.upper() + "  ", "Å"])
    hot = spark.range(40_000).selectExpr(f"CASE WHEN id % 3 = 0 THEN '{apart}' WHEN id % 3 = 1 THEN cast(id as string) END AS k")
    assert anti_join(hot, listed, "k", "r", "collated").count() == 40_000 - 13_334
    padded = spark.createDataFrame([("000000café",)], "k string")
    assert anti_join(padded, listed, "k", "r", "pad10_collated").count() == 0
