"""Cell cleaning: numbers, dates, names of places, headings."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import functions as F

from limpid.functions import (
    guarded_ratio,
    iso_text,
    nullify_tokens,
    region_name,
    round_half_up,
    snake_columns,
    squish,
    title_case,
    to_count,
    to_date_coerce,
    to_number,
    to_year,
)
from limpid.functions.dates import DAY_FIRST
from limpid.functions.text import READER_NULLS
from workload.registry import cents, query, table

NBSP = "\u00a0"
# The five regions by the number of the given region.
REGION_OF_KEY = {0: "Savanes", 1: "Kara", 2: "Centrale", 3: "Plateaux", 4: "Maritime"}


@query("SELECT o_orderkey, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) AS amount FROM orders")
def grouped_digits(spark, sf_dir):
    gap = F.when(F.col("o_orderstatus") == "F", NBSP).otherwise(" ")
    text = F.replace(F.format_number(cents("o_totalprice"), 0), F.lit(","), gap)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", to_number(text, grouped=True).alias("amount")
    )


@query("""
SELECT event_id,
       CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL
            WHEN 'click' THEN NULL WHEN 'signup' THEN event_id * 1000.0::DOUBLE
            ELSE CAST(event_id AS DOUBLE) END AS number
FROM events
""")
def guarded_numbers(spark, sf_dir):
    plain = F.col("event_id").cast("string")
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", "nan")
        .when(kind == "view", F.concat(plain, F.lit("d")))
        .when(kind == "click", "-inf")
        .when(kind == "signup", F.concat(plain, F.lit("e3")))
        .otherwise(F.concat(F.lit(" +"), plain, F.lit(".0 ")))
    )
    return table(spark, sf_dir, "events").select("event_id", to_number(text).alias("number"))


@query("""
SELECT event_id, CAST(round_even(floor(value * 2) / 2, 0) AS BIGINT) AS half_even,
       floor(value * 10 + 0.5) / 10 AS half_up
FROM events
""")
def rounding_rules(spark, sf_dir):
    halves = F.floor(F.col("value") * 2) / 2
    return table(spark, sf_dir, "events").select(
        "event_id",
        to_count(halves).alias("half_even"),
        round_half_up(F.col("value"), 1).alias("half_up"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN floor(l_discount * 100 + 0.5) > 0
            THEN CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS DOUBLE)
                 / CAST(floor(l_discount * 100 + 0.5) AS DOUBLE) END AS ratio
FROM lineitem
""")
def ratio_without_zero(spark, sf_dir):
    points = F.floor(F.col("l_discount") * 100 + 0.5)
    ratio = guarded_ratio(cents("l_extendedprice"), points)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", ratio.alias("ratio")
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day
FROM orders
""")
def parse_dayfirst_date(spark, sf_dir):
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "F", F.date_format("o_orderdate", "d/M/yyyy"))
        .when(status == "O", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", to_date_coerce(text, DAY_FIRST).alias("day")
    )


@query("""
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL
            ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS day
FROM orders
""")
def iso_date_text(spark, sf_dir):
    """Spreadsheet serial numbers, ISO days, ISO times and texts that are no date."""
    day = F.to_date("o_orderdate")
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", F.date_diff(day, F.lit("1899-12-30").cast("date")).cast("string"))
        .when(priority == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(priority == "5-LOW", "inconnue")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", iso_text(to_date_coerce(text)).alias("day")
    )


def dirty_region(key, segment, place):
    """Spellings of the five regions, and a place outside them, by customer segment."""
    names = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in REGION_OF_KEY.items()))
    name = names[key]
    return (
        F.when(segment == "MACHINERY", F.upper(name))
        .when(segment == "AUTOMOBILE", F.concat(F.lit("Région de "), name))
        .when(segment == "BUILDING", F.concat(F.lit("\tregion "), F.lower(name)))
        .when(segment == "FURNITURE", F.concat(F.lit("  "), name, F.lit(f" {NBSP}")))
        .otherwise(F.concat(F.lit("saint-"), F.lower(place)))
    )


@query("""
SELECT c_custkey,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN
         'Saint-' || array_to_string(list_transform(string_split(lower(r_name), ' '),
                                     lambda w: upper(w[1]) || w[2:]), ' ')
       ELSE CASE n_regionkey WHEN 0 THEN 'Savanes' WHEN 1 THEN 'Kara' WHEN 2 THEN 'Centrale'
                             WHEN 3 THEN 'Plateaux' ELSE 'Maritime' END END AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def normalize_region(spark, sf_dir):
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    raw = dirty_region(F.col("n_regionkey"), F.col("c_mktsegment"), F.col("r_name"))
    return (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", region_name(raw).alias("region"))
    )


@query("""
SELECT p_partkey,
       array_to_string(list_transform(
         regexp_extract_all(lower(p_name || '-' || p_type || ' l''' || p_brand || ' 3eme'),
                            '[a-z]+|[^a-z]+'),
         lambda w: upper(w[1]) || w[2:]), '') AS title
FROM part
""")
def title_case_names(spark, sf_dir):
    text = F.concat("p_name", F.lit("-"), "p_type", F.lit(" l'"), "p_brand", F.lit(" 3eme"))
    return table(spark, sf_dir, "part").select("p_partkey", title_case(text).alias("title"))


@query("""
SELECT c_custkey, c_name AS name,
       CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END
         AS segment
FROM customer
""")
def strip_and_nullify(spark, sf_dir):
    padded = F.concat(F.lit(f" \t{NBSP}"), "c_name", F.lit("  \n"))
    segment = F.col("c_mktsegment")
    token = F.when(segment == "BUILDING", "n/a").when(segment == "MACHINERY", "<NA>")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        squish(padded).alias("name"),
        nullify_tokens(F.coalesce(token, segment), READER_NULLS).alias("segment"),
    )


@query("""
SELECT doc_id, text, regexp_replace(text, '^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '', 'g') AS stripped
FROM documents
""")
def strip_whole_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text", squish(F.col("text")).alias("stripped")
    )


@query("""
SELECT o_orderkey AS code_etablissement, o_totalprice AS budget_alloue_prevu,
       o_orderdate AS "à_la_rentree"
FROM orders
""")
def french_headings(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Code établissement"),
        F.col("o_totalprice").alias("BUDGET alloué prèvu"),
        F.col("o_orderdate").alias("à la Rentrée"),
    )
    return snake_columns(raw)


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(year(o_orderdate) AS BIGINT) END AS year
FROM orders
""")
def whole_years(spark, sf_dir):
    year = F.year("o_orderdate").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.concat(year, F.lit(".0")))
        .when(F.col("o_orderstatus") == "P", F.concat(year, F.lit(".5")))
        .otherwise(year)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", to_year(text).alias("year"))
