"""Profiles, data-quality checks and contract drift."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.operators import distinct_profile, null_profile
from limpid.operators import quality as Q
from limpid.plans.medallion import quality_of
from limpid.sources import file_footers, scratch_folder, table_exists, write_table
from workload.gaps import FEW_GAPS, readings
from workload.marts import FACTS, SYNTHESIS, enrolment, order_lines, schools, synthese_regionale
from workload.registry import query, table


@query(FEW_GAPS + """
SELECT 'event_id' AS column_name, count(*) AS n_rows,
       count(*) FILTER (event_id IS NULL) AS n_null,
       CAST(count(*) FILTER (event_id IS NULL) AS DOUBLE) / count(*) AS null_rate FROM readings
UNION ALL
SELECT 'value', count(*), count(*) FILTER (value IS NULL),
       CAST(count(*) FILTER (value IS NULL) AS DOUBLE) / count(*) FROM readings
""")
def null_counts(spark, sf_dir):
    return null_profile(readings(spark, sf_dir), ["event_id", "value"])


@query("""
SELECT 'o_custkey' AS column_name, count(DISTINCT o_custkey) AS n_distinct FROM orders
UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate) FROM orders
""")
def distinct_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return distinct_profile(orders, ["o_custkey", "o_orderstatus", "o_orderdate"])


@query("""
SELECT entity, "check", column_name, n_bad, n_bad = 0 AS passed FROM (
  SELECT 'orders' AS entity, 'unique' AS "check", 'o_orderkey' AS column_name,
         count(*) - count(DISTINCT o_orderkey) AS n_bad FROM orders
  UNION ALL SELECT 'orders', 'unique', 'o_custkey,o_orderdate',
         (SELECT CAST(sum(n - 1) AS BIGINT)
          FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate))
  UNION ALL SELECT 'orders', 'reference', 'o_custkey',
         (SELECT count(*) FROM orders WHERE NOT EXISTS
           (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0))
  UNION ALL SELECT 'orders', 'not_null', 'o_totalprice',
         count(*) FILTER (o_totalprice IS NULL) FROM orders
  UNION ALL SELECT 'orders', 'in_range', 'o_totalprice',
         count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 400000) FROM orders
  UNION ALL SELECT 'orders', 'in_domain', 'o_orderstatus',
         count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders
  UNION ALL SELECT 'orders', 'covers_domain', 'o_orderstatus',
         (SELECT count(*) FROM (VALUES ('F'), ('O'), ('P'), ('X')) d(v)
          WHERE v NOT IN (SELECT o_orderstatus FROM orders))
  UNION ALL SELECT 'orders', 'column_present', 'o_orderkey', CAST(0 AS BIGINT)
  UNION ALL SELECT 'orders', 'column_present', 'o_clerk', CAST(1 AS BIGINT)
  UNION ALL SELECT 'orders', 'type_integer', 'o_orderkey', CAST(0 AS BIGINT)
  UNION ALL SELECT 'orders', 'type_string', 'o_totalprice', CAST(1 AS BIGINT)
  UNION ALL SELECT 'orders', 'exists', NULL, CAST(0 AS BIGINT)
  UNION ALL SELECT 'clerks', 'exists', NULL, CAST(1 AS BIGINT)
)
""")
def quality_of_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    known = customer.select(F.col("c_custkey").alias("o_custkey"))
    facts = Q.column_facts(orders, "orders", ["o_orderkey", "o_clerk"])
    facts += Q.type_facts(orders, "orders", {"o_orderkey": "integer", "o_totalprice": "string"})
    facts += Q.found_facts(
        {e: table_exists(spark, f"{sf_dir}/{e}.parquet") for e in ("orders", "clerks")}
    )
    rules = [
        Q.not_null("o_totalprice"),
        Q.in_range("o_totalprice", 1000, 400000),
        Q.in_domain("o_orderstatus", ["F", "O"]),
    ]
    return Q.quality_report(
        [
            Q.fact_rows(spark, facts),
            Q.check_unique(orders, "orders", ["o_orderkey"]),
            Q.check_unique(orders, "orders", ["o_custkey", "o_orderdate"]),
            Q.check_reference(orders, "orders", "o_custkey", known),
            Q.check_rows(orders, "orders", rules, {"o_orderstatus": ["F", "O", "P", "X"]}),
        ]
    )


@query("""
SELECT entity, "check", column_name, n_bad, n_bad = 0 AS passed FROM (
  SELECT 'etablissements' AS entity, 'exists' AS "check", NULL AS column_name, CAST(0 AS BIGINT) AS n_bad
  UNION ALL SELECT 'effectifs', 'exists', NULL, 0
  UNION ALL SELECT 'budgets', 'exists', NULL, 1
  UNION ALL SELECT 'etablissements', 'column_present', c, CAST(c NOT IN ('code_etablissement', 'region') AS INT)
    FROM (SELECT unnest(['code_etablissement', 'nom_etablissement', 'region', 'prefecture', 'type',
                         'statut', 'date_creation']) AS c)
  UNION ALL SELECT 'effectifs', 'column_present', c, 0
    FROM (SELECT unnest(['code_etablissement', 'annee_scolaire', 'nb_garcons', 'nb_filles']) AS c)
  UNION ALL SELECT 'etablissements', 'type_string', 'code_etablissement', 1
  UNION ALL SELECT 'etablissements', 'type_string', 'region', 0
  UNION ALL SELECT 'etablissements', 'type_date', 'date_creation', 1
  UNION ALL SELECT 'effectifs', 'type_integer', unnest(['nb_garcons', 'nb_filles']), 0
  UNION ALL SELECT 'etablissements', 'not_null', 'code_etablissement', 0
  UNION ALL SELECT 'etablissements', 'unique', 'code_etablissement', count(*) - count(DISTINCT c_custkey) FROM customer
  UNION ALL SELECT 'effectifs', 'not_null', 'nb_filles', count(*) FILTER (l_returnflag <> 'R') FROM lineitem
  UNION ALL SELECT 'effectifs', 'in_range', 'nb_filles', count(*) FILTER (l_returnflag = 'R' AND l_quantity < 0) FROM lineitem
  UNION ALL SELECT 'effectifs', 'reference', 'code_etablissement', count(*) FILTER (c_custkey IS NULL)
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
)
""")
def quality_without_a_table(spark, sf_dir):
    """Checks of the tables that are there, when another is missing."""
    tables = {
        "etablissements": schools(spark, sf_dir),
        "effectifs": enrolment(order_lines(spark, sf_dir)),
        "budgets": None,
    }
    return quality_of(spark, tables)


@query(FACTS + f""", s AS ({SYNTHESIS})
SELECT entity, "check", column_name, n_bad, n_bad = 0 AS passed FROM (
  SELECT 'synthese_regionale' AS entity, 'not_null' AS "check", 'budget_par_eleve' AS column_name,
         count(*) FILTER (budget_par_eleve IS NULL) AS n_bad FROM s
  UNION ALL SELECT 'synthese_regionale', 'in_range', 'taux_feminisation',
         count(*) FILTER (taux_feminisation < 0 OR taux_feminisation > 1) FROM s
  UNION ALL SELECT 'synthese_regionale', 'in_range', 'effectif_total',
         count(*) FILTER (effectif_total < 0) FROM s
  UNION ALL SELECT 'synthese_regionale', 'formula', 'budget_par_eleve',
         count(*) FILTER (abs(budget_par_eleve - budget_total / effectif_total) >= 0.01) FROM s
)
""")
def quality_of_marts(spark, sf_dir):
    formula = F.col("budget_total") / F.col("effectif_total")
    return Q.check_rows(
        synthese_regionale(spark, sf_dir),
        "synthese_regionale",
        [
            Q.not_null("budget_par_eleve"),
            Q.in_range("taux_feminisation", 0, 1),
            Q.in_range("effectif_total", low=0),
            Q.agrees_with("budget_par_eleve", formula),
        ],
    )


@query("""
SELECT 'orders' AS entity, 'iso_date' AS "check", 'jour' AS column_name,
       count(*) FILTER (o_orderstatus = 'P') AS n_bad,
       count(*) FILTER (o_orderstatus = 'P') = 0 AS passed
FROM orders
""")
def iso_date_check(spark, sf_dir):
    layout = F.when(
        F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd/MM/yyyy")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    dated = table(spark, sf_dir, "orders").select(layout.alias("jour"))
    return Q.check_rows(dated, "orders", [Q.iso_date("jour")])


ORDERS_CONTRACT = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DecimalType(15, 2)),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_clerk", T.StringType()),
    ]
)


@query("""
SELECT * FROM (
  SELECT 'o_totalprice' AS column_name, 'retyped' AS kind, 'decimal(15,2)' AS expected,
         'double' AS actual, count(o_totalprice) AS n_values FROM orders
  UNION ALL SELECT 'o_clerk', 'missing', 'string', NULL, count(*) FROM orders
  UNION ALL SELECT 'o_orderpriority', 'new', NULL, 'string', count(o_orderpriority) FROM orders
)
""")
def contract_drift(spark, sf_dir):
    return Q.schema_drift(table(spark, sf_dir, "orders"), ORDERS_CONTRACT)


@query("""
SELECT lot, column_name, kind, expected, actual, n_rows, n_values FROM (
  SELECT 'F' AS lot, 'o_clerk' AS column_name, 'missing' AS kind, 'string' AS expected,
         NULL AS actual, count(*) AS n_rows, count(*) AS n_values
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'F', 'o_totalprice', 'retyped', 'decimal(15,2)', 'double',
         count(*), count(o_totalprice) FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'O', 'o_orderpriority', 'new', NULL, 'string',
         count(*), count(nullif(o_orderpriority, '1-URGENT')) FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT 'P', 'o_orderkey', 'retyped', 'bigint', 'string',
         count(*), count(o_orderkey) FROM orders WHERE o_orderstatus = 'P'
) WHERE n_rows > 0
""")
def drift_per_file(spark, sf_dir):
    """Three lots of one table, written by three jobs that differ; each file is judged alone.

    A lot may be several files, so the findings of its files are added up.
    """
    root = scratch_folder(spark, "lots")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    price = F.col("o_totalprice").cast("decimal(15,2)")
    whole = orders.withColumn("o_totalprice", price).withColumn("o_clerk", F.lit("c"))
    not_urgent = F.expr("nullif(o_orderpriority, '1-URGENT')")
    lots = {
        "F": orders.drop("o_orderpriority"),
        "O": whole.withColumn("o_orderpriority", not_urgent),
        "P": whole.drop("o_orderpriority").withColumn("o_orderkey", F.col("o_orderkey").cast("string")),
    }
    for lot, rows in lots.items():
        write_table(rows.where(F.col("o_orderstatus") == lot), f"{root}/lot={lot}")
    found = Q.file_drift(file_footers(spark, root), ORDERS_CONTRACT).where("n_rows > 0")
    facts = ["column_name", "kind", "expected", "actual"]
    return found.groupBy(F.regexp_extract("file", "/lot=([^/]*)/", 1).alias("lot"), *facts).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values")
    )
