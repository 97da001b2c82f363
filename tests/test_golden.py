"""Known numbers at SF 0.01."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.registry import loaded_orders, orders, restricted, table
from tablesync import anti_join, count_new, newer_than, read_watermark, scrub_delims

SF = "/root/testdata/sf0.01"


def test_flagship(spark):
    mark = read_watermark(loaded_orders(spark, SF), "o_orderdate")
    assert mark.text == "2000-01-01 00:00:00"
    newer = newer_than(orders(spark, SF), "o_orderdate", mark)
    assert newer.count() == 3660
    assert orders(spark, SF).where("o_orderdate = timestamp_ntz'2000-01-01 00:00:00'").count() == 14
    out = anti_join(newer, restricted(spark, SF), "o_custkey", "c_custkey")
    rows, total, last = out.agg(F.count("*"), F.round(F.sum("o_totalprice"), 2), F.max("o_orderdate")).first()
    assert (rows, total, last) == (2940, 738729564.74, dt.datetime(2001, 8, 1))


def test_anti_joins(spark):
    listed = restricted(spark, SF)
    assert anti_join(orders(spark, SF), listed, "o_custkey", "c_custkey").count() == 12042
    padded = orders(spark, SF).withColumn("id", F.lpad(F.col("o_custkey").cast("string"), 10, "0"))
    assert anti_join(padded, listed, "id", "c_custkey", "pad10").count() == 12042
    names = listed.select(F.upper("c_name").alias("id"))
    assert anti_join(table(spark, SF, "customer"), names, "c_name", "id", "ci").count() == 1198
    holes = orders(spark, SF).withColumn("id", F.expr("nullif(o_custkey % 10, 0)"))
    three = spark.createDataFrame([(3,), (None,)], "id bigint")
    assert anti_join(holes, three, "id", "id").count() == 13456


@pytest.mark.parametrize(("precision", "rows"), [("micro", 5000), ("milli", 5001), ("second", 5001)])
def test_sub_second_marks(spark, precision, rows):
    events = table(spark, SF, "events")
    mark = read_watermark(events.where("event_id < 5000"), "ts", precision)
    assert count_new(events, "ts", mark).first()[0] == rows


def test_whole_number_mark_and_scrubbing(spark):
    ccyymm = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("ccyymm")
    source = orders(spark, SF).select(ccyymm)
    mark = read_watermark(loaded_orders(spark, SF).select(ccyymm), "ccyymm", "int")
    assert mark.text == "200001" and count_new(source, "ccyymm", mark).first()[0] == 3480
    documents = table(spark, SF, "documents").select("doc_id", "text")
    clean = scrub_delims(documents).withColumnRenamed("text", "clean")
    assert documents.join(clean, "doc_id").where("text <> clean").count() == 931
