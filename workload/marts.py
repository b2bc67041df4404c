"""Regional marts. School: customer. Enrolment: order lines by year, returned
quantity as girls and the rest as boys. Teacher: part, at the least customer who
ordered it. Budget: order cents per region and year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.plans import gold
from workload.registry import cents, query, school_year, table, through_scratch


def schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("code_etablissement"), F.col("r_name").alias("region")
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_partkey", "o_custkey", "o_orderdate", "l_quantity", "l_returnflag"
    )


def enrolment(lines: DataFrame) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    girls = F.col("l_returnflag") == "R"
    return lines.select(
        F.col("o_custkey").alias("code_etablissement"),
        school_year("o_orderdate").alias("annee_scolaire"),
        F.when(~girls, quantity).alias("nb_garcons"),
        F.when(girls, quantity).alias("nb_filles"),
    )


def teachers(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.col("l_partkey").alias("matricule")).agg(
        F.min("o_custkey").alias("code_etablissement")
    )


def budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.join(
        schools(spark, sf_dir), F.col("o_custkey") == F.col("code_etablissement")
    ).select(
        "region",
        F.year("o_orderdate").cast("bigint").alias("annee"),
        cents("o_totalprice").cast("double").alias("budget_total"),
    )


# From the description of the marts: totals of a school and year first, then regions.
FACTS = """
WITH place AS (
  SELECT c_custkey AS school, r_name AS region
  FROM customer, nation, region WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey
), taught AS (
  SELECT o_custkey AS school, year(o_orderdate) AS closing, sum(CAST(l_quantity AS BIGINT)) AS pupils,
         coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'R'), 0) AS girls
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY ALL
), enrolled AS (
  SELECT region, closing, count(*) AS schools, CAST(sum(pupils) AS BIGINT) AS pupils,
         CAST(sum(girls) AS BIGINT) AS girls
  FROM taught NATURAL JOIN place GROUP BY ALL
), post AS (
  SELECT l_partkey AS teacher, min(o_custkey) AS school
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL
), staffed AS (
  SELECT region, closing, count(*) AS teachers
  FROM post JOIN taught USING (school) JOIN place USING (school) GROUP BY ALL
), funded AS (
  SELECT region, year(o_orderdate) AS closing,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS money
  FROM orders JOIN place ON o_custkey = school GROUP BY ALL
)
"""
YEAR = "concat(closing - 1, '-', closing) AS annee"


SYNTHESIS = f"""
SELECT region, {YEAR}, schools AS nb_etablissements, pupils AS effectif_total,
       floor(girls / pupils * 10000 + 0.5) / 10000 AS taux_feminisation,
       teachers AS nb_enseignants,
       floor(pupils / teachers * 100 + 0.5) / 100 AS ratio_eleves_enseignant,
       money AS budget_total,
       floor(money / pupils * 100 + 0.5) / 100 AS budget_par_eleve
FROM enrolled JOIN staffed USING (region, closing) JOIN funded USING (region, closing)
"""


@query(FACTS + SYNTHESIS)
def synthese_regionale(spark, sf_dir):
    # Enrolment and teachers come from the same lines, and two branches use the years.
    lines = through_scratch(order_lines(spark, sf_dir), "lines")
    yearly = through_scratch(gold.school_years(enrolment(lines)), "annees")
    return gold.synthese_regionale(
        schools(spark, sf_dir),
        enrolment(lines),
        teachers(lines),
        budgets(spark, sf_dir),
        yearly=yearly,
    )


@query(FACTS + f"SELECT region, {YEAR}, schools AS nb_etablissements FROM enrolled")
def etablissements_par_region(spark, sf_dir):
    return gold.etablissements_par_region(
        schools(spark, sf_dir), enrolment(order_lines(spark, sf_dir))
    )


@query(FACTS + f"""
SELECT region, {YEAR}, pupils AS effectif_total, girls / pupils AS taux_feminisation FROM enrolled
""")
def effectifs_par_region(spark, sf_dir):
    return gold.effectifs_par_region(schools(spark, sf_dir), enrolment(order_lines(spark, sf_dir)))


@query(FACTS + f"SELECT region, {YEAR}, teachers AS nb_enseignants FROM staffed")
def enseignants_par_region(spark, sf_dir):
    lines = through_scratch(order_lines(spark, sf_dir), "lines")
    return gold.enseignants_par_region(schools(spark, sf_dir), enrolment(lines), teachers(lines))


@query(FACTS + """
SELECT region, CAST(closing AS BIGINT) AS annee, money AS budget_total FROM funded
""")
def budgets_par_region(spark, sf_dir):
    return gold.budgets_par_region(budgets(spark, sf_dir))


@query(
    """
WITH pupils AS (
  SELECT CASE o_orderstatus
           WHEN 'P' THEN CAST(year(o_orderdate) AS VARCHAR)
           WHEN 'O' THEN 'annee-inconnue'
           ELSE CAST(year(o_orderdate) - 1 AS VARCHAR) || '-' || CAST(year(o_orderdate) AS VARCHAR)
         END AS annee, count(*) AS n_orders
  FROM orders GROUP BY 1
), spent AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS end_year,
         CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
  FROM orders GROUP BY 1
)
SELECT annee, n_orders, end_year, total_cents
FROM pupils JOIN spent ON TRY_CAST(split_part(annee, '-', 2) AS BIGINT) = end_year
"""
)
def join_split_year(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    label = (
        F.when(F.col("o_orderstatus") == "P", F.year("o_orderdate").cast("string"))
        .when(F.col("o_orderstatus") == "O", "annee-inconnue")
        .otherwise(school_year("o_orderdate"))
    )
    pupils = orders.groupBy(label.alias("annee")).agg(F.count(F.lit(1)).alias("n_orders"))
    spent = orders.groupBy(F.year("o_orderdate").cast("bigint").alias("end_year")).agg(
        F.sum(cents("o_totalprice")).alias("total_cents")
    )
    return pupils.join(spent, gold.end_year(F.col("annee")) == F.col("end_year"))
