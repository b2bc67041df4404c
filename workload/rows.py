"""Duplicates, foreign keys and stacking."""

from __future__ import annotations

from pyspark.sql import functions as F

from limpid.operators import (
    duplicate_count,
    duplicate_groups,
    keep_first,
    missing_keys,
    split_by_reference,
    tagged_union,
)
from workload.registry import query, table

EVENTS = "event_id, ts, user_id, event_type, value, props"
ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
STATUS_RANK = {"F": 1, "O": 2, "P": 3}


@query(f"""
SELECT {EVENTS} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth
  FROM events) WHERE nth = 1
""")
def dedup_keep_first(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return keep_first(events, ["user_id", "event_type"], ["ts", "event_id"])[0]


@query(f"""
SELECT {EVENTS} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth
  FROM events) WHERE nth > 1
""")
def dedup_first_removed(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return keep_first(events, ["user_id", "event_type"], ["ts", "event_id"])[1]


def by_priority(spark, sf_dir):
    ranks = F.create_map(*[F.lit(x) for pair in STATUS_RANK.items() for x in pair])
    orders = table(spark, sf_dir, "orders")
    return keep_first(orders, ["o_custkey"], ["o_orderkey"], ranks[F.col("o_orderstatus")])


RANKED = f"""
SELECT {ORDERS} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY o_custkey
    ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_orderkey) AS nth
  FROM orders)
"""


@query(RANKED + "WHERE nth = 1")
def dedup_priority(spark, sf_dir):
    return by_priority(spark, sf_dir)[0]


@query(RANKED + "WHERE nth > 1")
def dedup_removed(spark, sf_dir):
    return by_priority(spark, sf_dir)[1]


@query(f"""
SELECT {ORDERS} FROM (
  SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS n FROM orders) WHERE n > 1
""")
def dup_groups(spark, sf_dir):
    return duplicate_groups(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


@query("""
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate)
""")
def dup_count(spark, sf_dir):
    return duplicate_count(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


@query("""
SELECT c_custkey AS code, c_name AS nom, c_acctbal AS solde, c_mktsegment AS segment,
       'client' AS statut FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, NULL, 'fournisseur' FROM supplier
""")
def tagged_union_of_tabs(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("code"),
        F.col("c_name").alias("nom"),
        F.col("c_acctbal").alias("solde"),
        F.col("c_mktsegment").alias("segment"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("nom"),
        F.col("s_suppkey").alias("code"),
        F.col("s_acctbal").alias("solde"),
    )
    return tagged_union({"client": customer, "fournisseur": supplier}, "statut")


def solvent(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    return customer.select(F.col("c_custkey").alias("o_custkey"))


@query(f"""
SELECT {ORDERS} FROM orders
WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)
""")
def fk_keep(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return split_by_reference(orders, solvent(spark, sf_dir), "o_custkey")[0]


@query(f"""
SELECT {ORDERS} FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)
""")
def fk_orphans(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return split_by_reference(orders, solvent(spark, sf_dir), "o_custkey")[1]


@query(f"SELECT {ORDERS} FROM orders")
def fk_without_dimension(spark, sf_dir):
    """Without a reference table every row stays and none is an orphan."""
    kept, orphans = split_by_reference(table(spark, sf_dir, "orders"), None, "o_custkey")
    return kept if orphans is None else kept.limit(0)


@query("""
SELECT DISTINCT o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
""")
def key_difference(spark, sf_dir):
    return missing_keys(table(spark, sf_dir, "orders"), solvent(spark, sf_dir), "o_custkey")
