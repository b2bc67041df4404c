"""The four entities and the full run, on dirty raw tables made from the given ones.

Schools come from customers, with a second row where the balance is negative.
Enrolment, teachers and budgets come from orders: urgent orders point to unknown
schools, orders in state O appear on both teacher tabs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.functions import nullify_tokens
from limpid.functions.text import READER_NULLS
from limpid.plans.medallion import Raw, run
from limpid.plans.silver import (
    clean_budgets,
    clean_effectifs,
    clean_enseignants,
    clean_etablissements,
)
from limpid.operators.ordering import order_breaks
from limpid.sources import ROW_ORDER, read_delimited, read_table, scratch_folder, with_row_order
from workload.cells import NBSP, dirty_region
from workload.registry import STAMP, cents, query, school_year, table, through_scratch
from workload.xlsx import as_workbooks

ROWS_PER_WORKBOOK = 2000


def with_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = table(spark, sf_dir, "customer")
    return customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))


def ordered(df: DataFrame, file: str, row: str) -> DataFrame:
    """Row order columns, as a scan would add them."""
    values = (F.lit(file), F.lit(0).cast("bigint"), F.col(row))
    return df.withColumns(dict(zip(ROW_ORDER, values)))


def nullified(df: DataFrame) -> DataFrame:
    """What a text scan does to the cells that mean "no value"."""
    cells = [c for c in df.columns if c not in ROW_ORDER]
    return df.withColumns({c: nullify_tokens(F.col(c), READER_NULLS) for c in cells})


def school_code(key) -> Column:
    return F.concat(F.lit("ETB-"), F.col(key))


def raw_schools(spark, sf_dir) -> DataFrame:
    segment = F.col("c_mktsegment")
    day = F.date_add(F.lit("1990-01-01").cast("date"), F.floor("c_acctbal").cast("int"))
    first = with_regions(spark, sf_dir).select(
        school_code("c_custkey").alias("Code établissement"),
        F.col("c_name").alias("Nom établissement"),
        dirty_region(F.col("n_regionkey"), segment, F.col("r_name")).alias("Région"),
        F.concat(F.lit("  "), "n_name", F.lit(NBSP)).alias("Préfecture"),
        F.lower(segment).alias("Type"),
        F.when(F.col("c_acctbal") > 5000, "privé").otherwise("public").alias("Statut"),
        F.when(segment == "HOUSEHOLD", F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "d/M/yyyy"))
        .alias("Date création"),
        "c_acctbal",
    )
    copies = first.where(F.col("c_acctbal") < 0).withColumns(
        {"Nom établissement": F.lit("copie"), "Région": F.lit("NULL")}
    )
    return ordered(first, "1", "Code établissement").unionByName(
        ordered(copies, "2", "Code établissement")
    ).drop("c_acctbal")


def thousands(number: Column) -> Column:
    # The usual case needs no number format, which is slow.
    parts = F.concat(F.floor(number / 1000), F.lit(NBSP), F.lpad((number % 1000).cast("string"), 3, "0"))
    return (
        F.when(number.between(0, 999), number.cast("string"))
        .when(number.between(1000, 999_999), parts)
        .otherwise(F.translate(F.format_number(number, 0), ",", NBSP))
    )


def raw_enrolment(spark, sf_dir, gap_below: int) -> DataFrame:
    price = F.col("o_totalprice")
    unknown = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    return table(spark, sf_dir, "orders").select(
        F.when(unknown, "ETX-999").otherwise(school_code("o_custkey")).alias("code_etablissement"),
        school_year("o_orderdate").alias("annee_scolaire"),
        thousands(F.floor(price / 100)).alias("nb_garcons"),
        F.when(price >= gap_below, thousands(F.floor(price / 200))).alias("nb_filles"),
    )


def raw_teachers(spark, sf_dir) -> DataFrame:
    """Rows of both tabs, with the name of the tab."""
    origin = F.lit("1899-12-30").cast("date")
    start = F.date_diff(F.to_date("o_orderdate"), origin)
    orders = table(spark, sf_dir, "orders")
    permanent, contract = F.col("o_orderstatus") != "P", F.col("o_orderstatus") != "F"
    unknown = (F.col("o_orderpriority") == "1-URGENT") & (F.col("tab") == "Titulaires")
    tabs = F.array_compact(
        F.array(F.when(permanent, "Titulaires"), F.when(contract, "Contractuels"))
    )
    return orders.withColumn("tab", F.explode(tabs)).select(
        F.concat(F.lit("T"), "o_orderkey").alias("Matricule"),
        F.col("o_orderpriority").alias("Nom"),
        F.col("o_orderstatus").alias("Prénom"),
        F.when(unknown, "ETX-999").otherwise(school_code("o_custkey")).alias("Code établissement"),
        F.lit("HG").alias("Matière"),
        start.alias("Date prise de poste"),
        (start + 365).alias("Date fin contrat"),
        "tab",
        "o_orderkey",
    )


def raw_budgets(spark, sf_dir) -> DataFrame:
    region = dirty_region(F.col("n_regionkey"), F.col("c_mktsegment"), F.col("r_name"))
    spent = cents("o_totalprice").cast("string")
    priority = F.col("o_orderpriority")
    orders = table(spark, sf_dir, "orders")
    return orders.join(with_regions(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")).select(
        region.alias("Région"),
        F.year("o_orderdate").alias("Annee"),
        spent.alias("Budget fonctionnement"),
        F.when(F.col("o_orderstatus") == "F", "12d").otherwise(spent).alias("Budget investissement"),
        F.when(priority == "1-URGENT", "N/A")
        .when(priority == "2-HIGH", " en attente")
        .otherwise(spent)
        .alias("Budget total"),
        "o_orderkey",
    )


SILVER = """
WITH place AS (
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal, n_name, r_name,
         CASE n_regionkey WHEN 0 THEN 'Savanes' WHEN 1 THEN 'Kara' WHEN 2 THEN 'Centrale'
                          WHEN 3 THEN 'Plateaux' ELSE 'Maritime' END AS named
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), region_of AS (
  SELECT c_custkey AS k,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN
                'Saint-' || array_to_string(list_transform(string_split(lower(r_name), ' '),
                                            lambda w: upper(w[1]) || w[2:]), ' ')
              ELSE named END AS region
  FROM place
), etab AS (
  SELECT 'ETB-' || CAST(c_custkey AS VARCHAR) AS code_etablissement,
         c_name AS nom_etablissement,
         CASE c_mktsegment WHEN 'MACHINERY' THEN upper(named) WHEN 'AUTOMOBILE' THEN 'Région de ' || named
              WHEN 'BUILDING' THEN 'region ' || lower(named) WHEN 'FURNITURE' THEN named
              ELSE 'saint-' || lower(r_name) END AS region,
         n_name AS prefecture, lower(c_mktsegment) AS type,
         CASE WHEN c_acctbal > 5000 THEN 'privé' ELSE 'public' END AS statut,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD'
              THEN CAST(DATE '1990-01-01' + CAST(floor(c_acctbal) AS INTEGER) AS DATE) END AS date_creation
  FROM place
), eff AS (
  SELECT o_custkey AS k, 'ETB-' || CAST(o_custkey AS VARCHAR) AS code_etablissement,
         CAST(year(o_orderdate) - 1 AS VARCHAR) || '-' || CAST(year(o_orderdate) AS VARCHAR) AS annee_scolaire,
         CAST(floor(o_totalprice / 100) AS BIGINT) AS nb_garcons,
         o_totalprice AS price, CAST(floor(o_totalprice / 200) AS BIGINT) AS half
  FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')
), posts AS (
  SELECT *, o_orderstatus = 'P' OR (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') AS contract
  FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
), ens AS (
  SELECT o_custkey AS k, 'T' || CAST(o_orderkey AS VARCHAR) AS matricule, o_orderpriority AS nom,
         o_orderstatus AS prenom, 'ETB-' || CAST(o_custkey AS VARCHAR) AS code_etablissement,
         'HG' AS matiere, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date_prise_de_poste,
         CASE WHEN contract THEN strftime(CAST(o_orderdate AS DATE) + 365, '%Y-%m-%d')
         END AS date_fin_contrat,
         CASE WHEN contract THEN 'contractuel' ELSE 'titulaire' END AS statut
  FROM posts
), bud AS (
  SELECT region, CAST(year(o_orderdate) AS BIGINT) AS annee,
         CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) AS budget_fonctionnement,
         CASE WHEN o_orderstatus = 'F' THEN 0.0
              ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) END AS budget_investissement,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0.0
              ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) END AS budget_total
  FROM orders JOIN region_of ON o_custkey = k
)
"""
FEW, MANY = 10000, 50000


@query(SILVER + """
SELECT code_etablissement, nom_etablissement, region, prefecture, type, statut, date_creation FROM etab
""")
def schools_clean(spark, sf_dir):
    return clean_etablissements(nullified(raw_schools(spark, sf_dir))).clean


@query(SILVER + """
SELECT etab.code_etablissement AS code_etablissement, nom_etablissement, r.region AS region, prefecture,
       type, statut, date_creation
FROM etab JOIN region_of r ON etab.code_etablissement = 'ETB-' || CAST(r.k AS VARCHAR)
""")
def schools_clean_canonical(spark, sf_dir):
    raw = nullified(raw_schools(spark, sf_dir))
    return clean_etablissements(raw, canonical_region=True).clean


@query(SILVER + """
SELECT etab.code_etablissement AS code_etablissement, 'copie' AS nom_etablissement,
       CAST(NULL AS VARCHAR) AS region, '  ' || n_name || chr(160) AS prefecture, type, statut,
       CASE WHEN c_mktsegment = 'HOUSEHOLD'
            THEN strftime(DATE '1990-01-01' + CAST(floor(c_acctbal) AS INTEGER), '%Y-%m-%d')
            ELSE strftime(DATE '1990-01-01' + CAST(floor(c_acctbal) AS INTEGER), '%-d/%-m/%Y')
       END AS date_creation
FROM etab JOIN place ON etab.nom_etablissement = place.c_name
WHERE c_acctbal < 0
""")
def schools_removed(spark, sf_dir):
    return clean_etablissements(nullified(raw_schools(spark, sf_dir))).rejects["doublons"]


def known_codes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(school_code("c_custkey").alias("code_etablissement"))


def enrolment_result(spark, sf_dir, gap_below):
    raw = raw_enrolment(spark, sf_dir, gap_below)
    return clean_effectifs(raw, known_codes(spark, sf_dir), run_ts=STAMP, cut=through_scratch)


@query(SILVER + f"""
SELECT code_etablissement, annee_scolaire, nb_garcons, half AS nb_filles FROM eff WHERE price >= {FEW}
""")
def enrolment_clean(spark, sf_dir):
    return enrolment_result(spark, sf_dir, FEW).clean


@query(SILVER + f"""
SELECT code_etablissement, annee_scolaire, CAST(nb_garcons AS DOUBLE) AS nb_garcons,
       CAST(NULL AS DOUBLE) AS nb_filles, '{STAMP}' AS date_suppression,
       'valeur_manquante_nb_filles' AS motif_suppression
FROM eff WHERE price < {FEW}
""")
def enrolment_deleted(spark, sf_dir):
    return enrolment_result(spark, sf_dir, FEW).rejects["supprimes"]


@query(SILVER + f"""
, m AS (
  SELECT k AS g, median(half) FILTER (price >= {MANY}) AS middle FROM eff GROUP BY k
), o AS (SELECT median(half) AS overall FROM eff WHERE price >= {MANY})
SELECT code_etablissement, annee_scolaire, nb_garcons,
       CAST(round_even(CASE WHEN price >= {MANY} THEN half ELSE COALESCE(middle, overall) END, 0) AS BIGINT)
         AS nb_filles
FROM eff JOIN m ON k = g, o
""")
def enrolment_clean_imputed(spark, sf_dir):
    return enrolment_result(spark, sf_dir, MANY).clean


@query("""
SELECT 'ETX-999' AS code_etablissement,
       CAST(year(o_orderdate) - 1 AS VARCHAR) || '-' || CAST(year(o_orderdate) AS VARCHAR) AS annee_scolaire,
       floor(o_totalprice / 100) AS nb_garcons,
       CASE WHEN o_totalprice >= 10000 THEN floor(o_totalprice / 200) END AS nb_filles
FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
""")
def enrolment_orphans(spark, sf_dir):
    return enrolment_result(spark, sf_dir, FEW).rejects["sans_etablissement"]


def teacher_result(spark, sf_dir):
    raw = ordered(raw_teachers(spark, sf_dir), "1", "o_orderkey").drop("o_orderkey")
    permanent = raw.where(F.col("tab") == "Titulaires").drop("tab", "Date fin contrat")
    contract = raw.where(F.col("tab") == "Contractuels").drop("tab")
    tabs = {"titulaire": permanent, "contractuel": contract}
    return clean_enseignants(tabs, known_codes(spark, sf_dir), cut=through_scratch)


@query(SILVER + """
SELECT matricule, nom, prenom, code_etablissement, matiere, date_prise_de_poste, date_fin_contrat, statut
FROM ens
""")
def teachers_clean(spark, sf_dir):
    return teacher_result(spark, sf_dir).clean


@query("""
SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS matricule, o_orderpriority AS nom, o_orderstatus AS prenom,
       'ETB-' || CAST(o_custkey AS VARCHAR) AS code_etablissement, 'HG' AS matiere,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date_prise_de_poste,
       strftime(CAST(o_orderdate AS DATE) + 365, '%Y-%m-%d') AS date_fin_contrat, 'contractuel' AS statut
FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT'
""")
def teachers_removed(spark, sf_dir):
    return teacher_result(spark, sf_dir).rejects["doublons"]


@query("""
SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS matricule, o_orderpriority AS nom, o_orderstatus AS prenom,
       'ETX-999' AS code_etablissement, 'HG' AS matiere,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date_prise_de_poste,
       CAST(NULL AS VARCHAR) AS date_fin_contrat, 'titulaire' AS statut
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT'
""")
def teachers_orphans(spark, sf_dir):
    return teacher_result(spark, sf_dir).rejects["sans_etablissement"]


@query(SILVER + """
SELECT region, annee, budget_fonctionnement, budget_investissement, budget_total FROM bud
""")
def budgets_clean(spark, sf_dir):
    return clean_budgets(raw_budgets(spark, sf_dir).drop("o_orderkey")).clean


def full_run(spark, sf_dir):
    """Raw files in the shared folder, then the whole run over them."""
    root = scratch_folder(spark, "run")
    schools = raw_schools(spark, sf_dir)
    # The copies go to a file that sorts after the first rows' file.
    for part in ("1", "2"):
        rows = schools.where(F.col(ROW_ORDER[0]) == part).drop(*ROW_ORDER)
        path = f"{root}/raw/etablissements_scolaires_{part}.csv"
        rows.write.csv(path, header=True, sep=";", encoding="ISO-8859-1")
    enrolled = f"{root}/raw/effectifs_eleves.csv"
    raw_enrolment(spark, sf_dir, FEW).write.csv(enrolled, header=True)

    book = F.floor(F.col("o_orderkey") / ROWS_PER_WORKBOOK)
    teachers = raw_teachers(spark, sf_dir).withColumn("book", book)
    columns = teachers.columns[:7]
    tabs = {"Titulaires": columns[:6], "Contractuels": columns}
    budgets = raw_budgets(spark, sf_dir).withColumns({"book": book, "tab": F.lit("Budgets")})
    raw = Raw(
        read_delimited(
            spark, f"{root}/raw/etablissements_scolaires_*.csv", sep=";", encoding="ISO-8859-1"
        ),
        read_delimited(spark, enrolled),
        through_scratch(as_workbooks(teachers, "personnel", "book", "tab", tabs), "teachers"),
        through_scratch(
            as_workbooks(budgets, "budgets", "book", "tab", {"Budgets": budgets.columns[:5]}),
            "budgets",
        ),
    )
    return run(spark, raw, f"{root}/out", STAMP, canonical_region=True)


@query(SILVER + f"""
, enrolled AS (
  SELECT eff.k AS k, region, annee_scolaire AS annee, nb_garcons, half AS nb_filles
  FROM eff JOIN region_of r ON eff.k = r.k WHERE price >= {FEW}
), g12 AS (
  SELECT region, annee, COUNT(DISTINCT k) AS nb_etablissements,
         CAST(SUM(nb_garcons + nb_filles) AS BIGINT) AS effectif_total,
         CAST(SUM(nb_filles) AS DOUBLE) / CAST(SUM(nb_garcons + nb_filles) AS DOUBLE) AS taux
  FROM enrolled GROUP BY region, annee
), g3 AS (
  SELECT region, annee, COUNT(DISTINCT matricule) AS nb_enseignants
  FROM ens JOIN (SELECT DISTINCT k, region, annee FROM enrolled) y ON ens.k = y.k GROUP BY region, annee
), g4 AS (
  SELECT region, annee, SUM(budget_total) AS budget_total FROM bud GROUP BY region, annee
)
SELECT g12.region AS region, g12.annee AS annee, nb_etablissements, effectif_total,
       floor(taux * 10000 + 0.5) / 10000 AS taux_feminisation, nb_enseignants,
       floor(CAST(effectif_total AS DOUBLE) / nb_enseignants * 100 + 0.5) / 100 AS ratio_eleves_enseignant,
       budget_total, floor(budget_total / effectif_total * 100 + 0.5) / 100 AS budget_par_eleve
FROM g12 JOIN g3 ON g12.region = g3.region AND g12.annee = g3.annee
         JOIN g4 ON g12.region = g4.region
                AND TRY_CAST(split_part(g12.annee, '-', 2) AS BIGINT) = g4.annee
""")
def full_run_marts(spark, sf_dir):
    return read_table(spark, f"{full_run(spark, sf_dir).out}/gold/synthese_regionale")


@query(SILVER + f"""
SELECT step, metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'bronze_etablissements' AS step, 'lignes_lues' AS metric,
         count(*) + count(*) FILTER (c_acctbal < 0) AS value FROM customer
  UNION ALL SELECT 'clean_etablissements', 'lignes_ecrites', count(*) FROM customer
  UNION ALL SELECT 'clean_etablissements', 'doublons', count(*) FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'bronze_effectifs', 'lignes_lues', count(*) FROM orders
  UNION ALL SELECT 'clean_effectifs', 'lignes_ecrites', count(*) FROM eff WHERE price >= {FEW}
  UNION ALL SELECT 'clean_effectifs', 'supprimes', count(*) FROM eff WHERE price < {FEW}
  UNION ALL SELECT 'clean_effectifs', 'sans_etablissement', count(*) FROM orders
            WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
  UNION ALL SELECT 'clean_effectifs', 'strategie_delete', 1
  UNION ALL SELECT 'bronze_enseignants', 'lignes_lues',
            count(*) + count(*) FILTER (o_orderstatus = 'O') FROM orders
  UNION ALL SELECT 'clean_enseignants', 'lignes_ecrites', count(*) FROM ens
  UNION ALL SELECT 'clean_enseignants', 'sans_etablissement', count(*) FROM orders
            WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P'
  UNION ALL SELECT 'clean_enseignants', 'doublons', count(*) FROM orders
            WHERE o_orderpriority <> '1-URGENT' AND o_orderstatus = 'O'
  UNION ALL SELECT 'bronze_budgets', 'lignes_lues', count(*) FROM bud
  UNION ALL SELECT 'clean_budgets', 'lignes_ecrites', count(*) FROM bud
  UNION ALL SELECT 'clean_budgets', 'mises_a_zero_budget_fonctionnement', 0
  UNION ALL SELECT 'clean_budgets', 'mises_a_zero_budget_investissement', count(*) FROM orders
            WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'clean_budgets', 'mises_a_zero_budget_total', count(*) FROM orders
            WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  UNION ALL SELECT 'clean_budgets', 'regions_distinctes', count(DISTINCT region) FROM bud
  UNION ALL SELECT 'synthese_regionale', 'lignes_ecrites', count(*) FROM (
            SELECT DISTINCT region, annee_scolaire FROM eff JOIN region_of r ON eff.k = r.k WHERE price >= {FEW})
  UNION ALL SELECT 'synthese_regionale', 'vide', 0
)
""")
def run_metrics(spark, sf_dir):
    return read_table(spark, f"{full_run(spark, sf_dir).out}/metrics")


@query(SILVER + f"""
, gaps AS (
  SELECT count(*) AS n, count(*) FILTER (price < {FEW}) AS missing,
         CAST(sum(half) FILTER (price >= {FEW}) AS DOUBLE) / count(*) FILTER (price >= {FEW}) AS mean
  FROM eff
)
SELECT 'clean_effectifs' AS step, metric, value FROM (
  SELECT 'lignes_nb_filles_avant' AS metric, CAST(n AS DOUBLE) AS value FROM gaps
  UNION ALL SELECT 'manquantes_nb_filles_avant', missing FROM gaps
  UNION ALL SELECT 'taux_manquant_nb_filles_avant', CAST(missing AS DOUBLE) / n FROM gaps
  UNION ALL SELECT 'moyenne_nb_filles_avant', mean FROM gaps
  UNION ALL SELECT 'lignes_nb_filles_apres', n - missing FROM gaps
  UNION ALL SELECT 'manquantes_nb_filles_apres', 0
  UNION ALL SELECT 'taux_manquant_nb_filles_apres', 0
  UNION ALL SELECT 'moyenne_nb_filles_apres', mean FROM gaps
)
""")
def run_measures(spark, sf_dir):
    """Measures of enrolment, taken while it is written; the medians are estimates and left out here."""
    measures = read_table(spark, f"{full_run(spark, sf_dir).out}/mesures").where("step = 'clean_effectifs'")
    return measures.where(~F.col("metric").startswith("mediane"))


@query(SILVER + f"""
SELECT count(*) AS rows, 0 AS breaks FROM (
  SELECT DISTINCT region, annee_scolaire FROM eff JOIN region_of r ON eff.k = r.k WHERE price >= {FEW})
""")
def marts_in_order(spark, sf_dir):
    """The marts stand written by region and school year."""
    rows = with_row_order(read_table(spark, f"{full_run(spark, sf_dir).out}/gold/synthese_regionale"))
    return order_breaks(rows, ["region", "annee"])
