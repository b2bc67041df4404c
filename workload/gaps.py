"""Missing values. An event below half a unit, or an order below 200,000, counts as
not reported."""

from __future__ import annotations

from pyspark.sql import functions as F

from limpid import operators
from limpid.functions import to_count
from limpid.operators import (
    handle_missing,
    impute_group_median,
    stats_before_after,
    zero_fill,
)
from limpid.operators.rollup import (
    DISTINCT_ERROR,
    RANK_ERROR,
    bitmap_counts,
    distinct_bitmaps,
    distinct_sketches,
    key_numbers,
    median_sketches,
    sketch_counts,
    sketch_medians,
)
from workload.registry import STAMP, cents, query, table, through_scratch

FEW_GAPS = """
WITH readings AS (
  SELECT event_id, user_id, event_type, CASE WHEN value >= 0.5 THEN value END AS value FROM events
), rate AS (
  SELECT CAST(count(*) FILTER (value IS NULL) AS DOUBLE) / count(*) AS missing FROM readings
)
"""


def readings(spark, sf_dir):
    value = F.when(F.col("value") >= 0.5, F.col("value"))
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", value.alias("value")
    )


@query(FEW_GAPS + """
SELECT event_id, user_id, event_type, value FROM readings, rate
WHERE missing <= 0.05 AND value IS NOT NULL
""")
def missing_delete(spark, sf_dir):
    return handle_missing(readings(spark, sf_dir), "value", "user_id", run_ts=STAMP)[0]


@query(FEW_GAPS + f"""
SELECT event_id, user_id, event_type, value, '{STAMP}' AS date_suppression,
       'valeur_manquante_value' AS motif_suppression
FROM readings, rate WHERE missing <= 0.05 AND value IS NULL
""")
def missing_deleted_rows(spark, sf_dir):
    return handle_missing(readings(spark, sf_dir), "value", "user_id", run_ts=STAMP)[1]


MANY_GAPS = """
WITH amounts AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_totalprice >= 200000 THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS amount
  FROM orders
), by_group AS (
  SELECT o_custkey AS k, median(amount) AS m FROM amounts GROUP BY o_custkey
), overall AS (
  SELECT median(amount) AS g FROM amounts
), filled AS (
  SELECT o_orderkey, o_custkey, amount, m, g,
         COALESCE(CAST(amount AS DOUBLE), m, g) AS v
  FROM amounts JOIN by_group ON o_custkey = k, overall
)
"""


def amounts(spark, sf_dir):
    value = F.when(F.col("o_totalprice") >= 200000, cents("o_totalprice"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", value.alias("amount"))


@query(MANY_GAPS + """
SELECT o_orderkey, o_custkey, CAST(round_even(v, 0) AS BIGINT) AS amount FROM filled
""")
def missing_impute(spark, sf_dir):
    filled = handle_missing(amounts(spark, sf_dir), "amount", "o_custkey", run_ts=STAMP)[0]
    return filled.withColumn("amount", to_count(F.col("amount")))


@query(MANY_GAPS + f"""
SELECT o_orderkey, o_custkey, CAST(amount AS DOUBLE) AS amount, v AS valeur_imputee,
       v AS mediane_etablissement, g AS mediane_globale_fallback,
       m IS NULL AS etablissement_sans_median, '{STAMP}' AS date_imputation
FROM filled WHERE amount IS NULL
""")
def missing_impute_audit(spark, sf_dir):
    return handle_missing(amounts(spark, sf_dir), "amount", "o_custkey", run_ts=STAMP)[1]


@query(MANY_GAPS + "SELECT k AS o_custkey, m AS group_median FROM by_group WHERE m IS NOT NULL")
def group_median(spark, sf_dir):
    return operators.group_median(amounts(spark, sf_dir), "amount", "o_custkey")


@query("""
SELECT l_partkey, median(CAST(round(l_extendedprice * 100) AS BIGINT) + l_partkey * 100000000) AS group_median
FROM lineitem GROUP BY l_partkey
""")
def group_median_spread(spark, sf_dir):
    """Groups of disjoint ranges: prices of each part, shifted by the part."""
    price = cents("l_extendedprice") + F.col("l_partkey") * 100_000_000
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", price.alias("price"))
    return operators.group_median(lines, "price", "l_partkey")


@query("SELECT median(CAST(round(l_extendedprice * 100) AS BIGINT)) AS overall_median FROM lineitem")
def overall_median_spread(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(cents("l_extendedprice").alias("price"))
    return operators.overall_median(lines, "price")


@query(MANY_GAPS + "SELECT g AS overall_median FROM overall")
def overall_median(spark, sf_dir):
    return operators.overall_median(amounts(spark, sf_dir), "amount")


@query(MANY_GAPS + """
SELECT 'avant' AS stage,
       floor(CAST(sum(amount) AS DOUBLE) / count(amount) * 100 + 0.5) / 100 AS mean_value,
       floor(median(amount) * 100 + 0.5) / 100 AS median_value
FROM filled
UNION ALL
SELECT 'apres', floor(sum(v) / count(v) * 100 + 0.5) / 100, floor(median(v) * 100 + 0.5) / 100
FROM filled
""")
def stats_around_imputation(spark, sf_dir):
    before = amounts(spark, sf_dir)
    after, _ = impute_group_median(before, "amount", "o_custkey", STAMP)
    return stats_before_after(before, after, "amount")


@query("""
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 0.0
            ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) END AS budget_total,
       CASE WHEN o_orderstatus = 'F' THEN 0.0
            ELSE CAST(CAST(round(o_totalprice * 50) AS BIGINT) AS DOUBLE) END AS budget_investissement
FROM orders
""")
def zero_fill_budget(spark, sf_dir):
    plain = cents("o_totalprice").cast("string")
    priority = F.col("o_orderpriority")
    total = (
        F.when(priority == "1-URGENT", "N/A")
        .when(priority == "2-HIGH", "  en attente ")
        .when(priority == "3-MEDIUM", "non communiqué")
        .when(priority == "5-LOW", F.concat(F.lit("  "), plain, F.lit("\t")))
        .otherwise(plain)
    )
    half = F.round(F.col("o_totalprice") * 50).cast("bigint").cast("string")
    other = F.when(F.col("o_orderstatus") == "F", "12d").otherwise(half)
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey", total.alias("budget_total"), other.alias("budget_investissement")
    )
    return zero_fill(raw, ["budget_total", "budget_investissement"])


@query("""
SELECT o_orderpriority, count(*) AS nb, TRUE AS dans_la_marge FROM orders GROUP BY o_orderpriority
""")
def group_median_sketched(spark, sf_dir):
    """Sketches of each year, written, then merged: is the median's rank within the stated error?"""
    orders = table(spark, sf_dir, "orders").withColumn("annee", F.year("o_orderdate"))
    sketches = median_sketches(orders, "o_totalprice", ["o_orderpriority", "annee"])
    found = sketch_medians(through_scratch(sketches, "sketches"), ["o_orderpriority"], "mediane")
    rank = orders.join(found, "o_orderpriority").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("nb"),
        F.count_if(F.col("o_totalprice") < F.col("mediane")).alias("below"),
        F.count_if(F.col("o_totalprice") <= F.col("mediane")).alias("upto"),
    )
    near = (F.col("below") <= F.col("nb") * (0.5 + RANK_ERROR)) & (F.col("upto") >= F.col("nb") * (0.5 - RANK_ERROR))
    return rank.select("o_orderpriority", "nb", near.alias("dans_la_marge"))


@query("""
SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS annee, count(DISTINCT o_custkey) AS clients FROM orders
GROUP BY GROUPING SETS ((o_orderpriority, year(o_orderdate)), (o_orderpriority), ())
""")
def distinct_rollup(spark, sf_dir):
    """Distinct customers per priority and year, per priority and in all, from one set of bitmaps."""
    orders = table(spark, sf_dir, "orders").withColumn("annee", F.year("o_orderdate"))
    numbers = key_numbers(table(spark, sf_dir, "customer"), "c_custkey").withColumnRenamed("c_custkey", "o_custkey")
    fine = ["o_orderpriority", "annee"]
    bitmaps = through_scratch(distinct_bitmaps(orders, numbers, "o_custkey", fine), "bitmaps")
    parts = [bitmap_counts(bitmaps, fine[:n], "clients") for n in (2, 1, 0)]
    return parts[0].unionByName(parts[1], True).unionByName(parts[2], True)


@query("""
SELECT o_orderpriority, TRUE AS dans_la_marge FROM orders GROUP BY o_orderpriority
""")
def distinct_rollup_sketched(spark, sf_dir):
    """The same by sketches of each year: within four times the stated error?"""
    orders = table(spark, sf_dir, "orders").withColumn("annee", F.year("o_orderdate"))
    sketches = through_scratch(distinct_sketches(orders, "o_custkey", ["o_orderpriority", "annee"]), "hll")
    found = sketch_counts(sketches, ["o_orderpriority"], "environ")
    exact = orders.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("clients"))
    off = F.abs(F.col("environ") - F.col("clients")) <= F.greatest(F.lit(1.0), F.col("clients") * 4 * DISTINCT_ERROR)
    return found.join(exact, "o_orderpriority").select("o_orderpriority", off.alias("dans_la_marge"))
