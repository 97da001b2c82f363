from __future__ import annotations

from pyspark.sql import functions as F

from tablesync import (
    anti_join, flag_restricted, newer_than, only_restricted, prepare_list, read_watermark, restriction_keys,
)

from .registry import R_SQL, W_SQL, as_text, loaded_orders, orders, query, restricted, table


@query(f"SELECT o.* FROM orders o LEFT JOIN {R_SQL} r ON o.o_custkey = r.c_custkey WHERE r.c_custkey IS NULL")
def anti_join_plain(spark, sf_dir):
    return anti_join(orders(spark, sf_dir), restricted(spark, sf_dir), "o_custkey", "c_custkey")


@query(
    "SELECT o.* FROM (SELECT *, lpad(cast(o_custkey AS varchar), 10, '0') AS cust_id FROM orders) o "
    f"LEFT JOIN {R_SQL} r ON o.cust_id = right('0000000000' || cast(r.c_custkey AS varchar), 10) WHERE r.c_custkey IS NULL"
)
def anti_join_padded(spark, sf_dir):
    source = orders(spark, sf_dir).withColumn("cust_id", F.lpad(F.col("o_custkey").cast("string"), 10, "0"))
    return anti_join(source, restricted(spark, sf_dir), "cust_id", "c_custkey", "pad10")


@query(
    "SELECT o.* FROM (SELECT *, lpad('CU' || cast(o_custkey AS varchar), 10, '0') || '  ' AS cust_id FROM orders) o "
    f"LEFT JOIN {R_SQL} r ON lower(rtrim(o.cust_id)) = lower(right('0000000000' || 'cu' || cast(r.c_custkey AS varchar), 10)) "
    "WHERE r.c_custkey IS NULL"
)
def anti_join_padded_ci(spark, sf_dir):
    """Upper case and trailing blanks in the source, lower case and no padding on the list."""
    cust_id = F.lpad(F.concat(F.lit("CU"), F.col("o_custkey").cast("string")), 10, "0")
    source = orders(spark, sf_dir).withColumn("cust_id", F.concat(cust_id, F.lit("  ")))
    listed = restricted(spark, sf_dir).select(F.concat(F.lit("cu"), F.col("c_custkey").cast("string")).alias("id"))
    return anti_join(source, listed, "cust_id", "id", "pad10_ci")


@query(
    f"SELECT c.* FROM customer c LEFT JOIN (SELECT upper(c_name) AS id FROM {R_SQL}) r ON lower(c.c_name) = lower(r.id) "
    "WHERE r.id IS NULL"
)
def anti_join_ci(spark, sf_dir):
    listed = restricted(spark, sf_dir).select(F.upper("c_name").alias("id"))
    return anti_join(table(spark, sf_dir, "customer"), listed, "c_name", "id", "ci")


@query(
    "SELECT o.* FROM (SELECT *, lpad(cast(o_custkey AS varchar), 12, '0') AS cust_id FROM orders) o "
    f"LEFT JOIN {R_SQL} r ON cast(o.cust_id AS bigint) = r.c_custkey WHERE r.c_custkey IS NULL"
)
def anti_join_numeric(spark, sf_dir):
    """Text with leading zeros in the source, numbers on the list."""
    source = orders(spark, sf_dir).withColumn("cust_id", F.lpad(F.col("o_custkey").cast("string"), 12, "0"))
    return anti_join(source, restricted(spark, sf_dir), "cust_id", "c_custkey", "numeric")


@query(
    "SELECT o.*, cast(r.c_custkey AS varchar) AS r_c_custkey, r.c_name AS r_c_name, cast(r.c_nationkey AS varchar) AS r_c_nationkey, r.c_acctbal AS r_c_acctbal, "
    f"r.c_mktsegment AS r_c_mktsegment FROM orders o LEFT JOIN {R_SQL} r ON o.o_custkey = r.c_custkey WHERE r.c_custkey IS NULL"
)
def anti_join_star(spark, sf_dir):
    kept = anti_join(orders(spark, sf_dir), restricted(spark, sf_dir), "o_custkey", "c_custkey", keep_right=True)
    return as_text(kept, "r_c_custkey", "r_c_nationkey")


@query(
    "SELECT o.* REPLACE (cast(cust_id AS varchar) AS cust_id) "
    "FROM (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS cust_id FROM orders) o "
    f"LEFT JOIN {R_SQL} r ON o.cust_id = r.c_custkey WHERE r.c_custkey IS NULL"
)
def anti_join_null_keys(spark, sf_dir):
    """A null id is never restricted."""
    cust_id = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    source = orders(spark, sf_dir).withColumn("cust_id", cust_id)
    return as_text(anti_join(source, restricted(spark, sf_dir), "cust_id", "c_custkey"), "cust_id")


@query(
    "SELECT l.* FROM lineitem l LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'F') r "
    "ON l.l_orderkey = r.o_orderkey WHERE r.o_orderkey IS NULL"
)
def anti_join_large_list(spark, sf_dir):
    """A list that grows with the source and may not be broadcast: salted shuffle join."""
    listed = orders(spark, sf_dir).where("o_orderstatus = 'F'")
    return anti_join(table(spark, sf_dir, "lineitem"), listed, "l_orderkey", "o_orderkey", limit=0)


@query(
    "SELECT DISTINCT list_name, id FROM (SELECT 'c_custkey' AS list_name, c_custkey AS id FROM customer "
    "UNION ALL SELECT 'c_nationkey', cast(c_nationkey AS bigint) FROM customer)",
    name="restriction_keys",
)
def restriction_key_lists(spark, sf_dir):
    listed = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), F.col("c_nationkey").cast("string").alias("c_nationkey")
    )
    return restriction_keys(listed, ["c_custkey", "c_nationkey"])


@query(f"SELECT o.*, o.o_custkey IN (SELECT c_custkey FROM {R_SQL}) AS is_restricted FROM orders o")
def restriction_flag(spark, sf_dir):
    return flag_restricted(orders(spark, sf_dir), restricted(spark, sf_dir), "o_custkey", "c_custkey")


@query(
    "SELECT l.*, l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AS is_restricted FROM lineitem l"
)
def restriction_flag_large_list(spark, sf_dir):
    listed = orders(spark, sf_dir).where("o_orderstatus = 'F'")
    return flag_restricted(table(spark, sf_dir, "lineitem"), listed, "l_orderkey", "o_orderkey", limit=0)


@query(f"SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM {R_SQL})")
def restriction_semi(spark, sf_dir):
    return only_restricted(orders(spark, sf_dir), restricted(spark, sf_dir), "o_custkey", "c_custkey")


@query(
    f"SELECT o.* FROM orders o LEFT JOIN {R_SQL} r ON o.o_custkey = r.c_custkey "
    f"WHERE r.c_custkey IS NULL AND o.o_orderdate > {W_SQL}"
)
def incremental_restricted(spark, sf_dir):
    """The flagship: rows past the target's mark whose ids are not restricted."""
    mark = read_watermark(loaded_orders(spark, sf_dir), "o_orderdate")
    newer = newer_than(orders(spark, sf_dir), "o_orderdate", mark)
    return anti_join(newer, restricted(spark, sf_dir), "o_custkey", "c_custkey")


@query(
    f"SELECT 'orders' AS source, count(*) AS kept FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM {R_SQL}) "
    f"UNION ALL SELECT 'customer', count(*) FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM {R_SQL})"
)
def prepared_list_shared(spark, sf_dir):
    """One list, reduced and written once, against several tables."""
    listed = prepare_list(restricted(spark, sf_dir), "c_custkey")

    def kept(name, key):
        rows = anti_join(table(spark, sf_dir, name), listed, key)
        return rows.agg(F.lit(name).alias("source"), F.count("*").alias("kept"))

    return kept("orders", "o_custkey").unionByName(kept("customer", "c_custkey"))


@query(
    "SELECT l.* FROM lineitem l LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') r "
    "ON l.l_orderkey = r.o_orderkey WHERE r.o_orderkey IS NULL"
)
def anti_join_prefiltered(spark, sf_dir):
    """A list that may not be broadcast: rows that its Bloom filter rules out are not shuffled."""
    listed = orders(spark, sf_dir).where("o_orderpriority = '1-URGENT'")
    return anti_join(table(spark, sf_dir, "lineitem"), listed, "l_orderkey", "o_orderkey", limit=0, prefilter=True)


@query(
    "SELECT l.*, l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AS is_restricted FROM lineitem l"
)
def restriction_flag_bitmap(spark, sf_dir):
    """Listed whole numbers as one bit each."""
    listed = prepare_list(orders(spark, sf_dir).where("o_orderstatus = 'F'"), "o_orderkey", "integer", bitmaps=True)
    return flag_restricted(table(spark, sf_dir, "lineitem"), listed, "l_orderkey")


@query(
    "SELECT c.* FROM (SELECT *, 'Cafe' || chr(769) || ' ' || c_name AS cust_id FROM customer) c "
    f"LEFT JOIN (SELECT 'CAF' || chr(201) || ' ' || upper(c_name) || '  ' AS id FROM {R_SQL}) r "
    "ON nfc_normalize(lower(rtrim(c.cust_id))) = nfc_normalize(lower(rtrim(r.id))) WHERE r.id IS NULL"
)
def anti_join_collated(spark, sf_dir):
    """An accent as a character of its own in the source, within the letter on the list."""
    source = table(spark, sf_dir, "customer").withColumn("cust_id", F.concat(F.lit("Cafe\u0301 "), F.col("c_name")))
    listed = restricted(spark, sf_dir).select(F.concat(F.lit("CAF\u00c9 "), F.upper("c_name"), F.lit("  ")).alias("id"))
    return anti_join(source, listed, "cust_id", "id", "collated")
