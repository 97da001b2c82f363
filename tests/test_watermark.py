import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablesync import Watermark, count_new, newer_than, read_watermark, resolve_watermark
from tablesync.operators.watermark import EPOCH


def times(spark, values, kind="timestamp_ntz"):
    return spark.createDataFrame([(v,) for v in values], "ts string").select(F.col("ts").cast(kind).alias("ts"))


MICROS = ["2024-03-01 10:00:00.123455", "2024-03-01 10:00:00.123456", None]


@pytest.mark.parametrize(
    ("precision", "text"),
    [
        ("micro", "2024-03-01 10:00:00.123456"),
        ("milli", "2024-03-01 10:00:00.123"),
        ("second", "2024-03-01 10:00:00"),
    ],
)
def test_precisions(spark, precision, text):
    assert read_watermark(times(spark, MICROS), "ts", precision).text == text


def test_rows_equal_to_the_mark_are_not_loaded_again(spark):
    source = times(spark, [*MICROS, "2024-03-01 10:00:00.123457"])
    exact = read_watermark(times(spark, MICROS), "ts")
    assert count_new(source, "ts", exact).first()[0] == 1
    assert count_new(source, "ts", read_watermark(times(spark, MICROS), "ts", "milli")).first()[0] == 3


@pytest.mark.parametrize("zone", ["UTC", "America/Toronto"])
def test_instants_keep_their_mark_in_any_zone(spark, zone):
    """01:30 happens twice on the night clocks go back."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seconds = [1_730_611_800, 1_730_615_400]  # 01:30 summer time, 01:30 standard time
        source = spark.createDataFrame([(s,) for s in seconds], "s bigint").select(F.timestamp_seconds("s").alias("ts"))
        for loaded, newer in ((1, 1), (2, 0)):
            mark = read_watermark(source.where(F.col("ts") <= F.timestamp_seconds(F.lit(seconds[loaded - 1]))), "ts")
            assert newer_than(source, "ts", mark).count() == newer
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_empty_and_missing_targets_start_at_the_epoch(spark):
    assert resolve_watermark(times(spark, [None]), "ts").first()[0] == EPOCH
    assert read_watermark(None, "ts") == Watermark(EPOCH)
    numbers = spark.createDataFrame([(202401,), (202402,)], "ccyymm int")
    assert newer_than(numbers, "ccyymm", Watermark(EPOCH)).count() == 2


@pytest.mark.parametrize("kind", ["int", "bigint", "decimal(8,0)"])
def test_whole_number_marks(spark, kind):
    source = spark.createDataFrame([(202312,), (202401,), (202402,)], "n int").select(F.col("n").cast(kind).alias("n"))
    mark = read_watermark(source.where("n <= 202401"), "n", "int")
    assert mark.text == "202401"
    assert [int(r[0]) for r in newer_than(source, "n", mark).collect()] == [202402]


def test_dates_and_texts(spark):
    days = times(spark, ["2024-01-01", "2024-01-02"], "date")
    assert read_watermark(days, "ts").text == "2024-01-02"
    assert newer_than(days, "ts", "2024-01-01").count() == 1
    texts = times(spark, ["2024-01-01 00:00:00", "2024-01-02 00:00:00"], "string")
    assert newer_than(texts, "ts", read_watermark(texts.limit(1), "ts")).count() == 1


def test_epoch_milliseconds_keep_seconds(spark):
    ms = int(dt.datetime(2022, 11, 6, 3, 9, 3, 900_000, dt.timezone.utc).timestamp() * 1000)
    target = spark.createDataFrame([(ms,), (ms - 5000,), (None,)], "ms bigint")
    assert read_watermark(target, "ms", "epoch_ms").text == "2022-11-06 03:09:03"
    assert read_watermark(target.where("ms < 0"), "ms", "epoch_ms").text == EPOCH


def test_column_names_differ_in_case(spark):
    df = times(spark, ["2024-01-01 00:00:00"]).withColumnRenamed("ts", "CHANGED_AT")
    assert newer_than(df, "changed_at", read_watermark(df, "changed_at")).count() == 0


def test_no_date_column_takes_all(spark):
    df = times(spark, MICROS)
    assert newer_than(df, None, None).count() == 3


def test_an_earlier_mark_narrows_the_scan(spark):
    df = times(spark, ["2024-01-01 00:00:00", "2024-01-05 00:00:00"])
    assert read_watermark(df, "ts", at_least=Watermark("2024-01-03 00:00:00")).text == "2024-01-05 00:00:00"
    # the target was replaced since: its mark went back
    assert read_watermark(df, "ts", at_least=Watermark("2025-01-01 00:00:00")).text == "2024-01-05 00:00:00"


def test_mark_reaches_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    mark = read_watermark(orders.where("o_orderdate <= timestamp_ntz'2000-01-01 00:00:00'"), "o_orderdate")
    plan = count_new(orders, "o_orderdate", mark)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan


def test_unknown_precision_is_refused(spark):
    with pytest.raises(ValueError):
        resolve_watermark(times(spark, MICROS), "ts", "nano")
