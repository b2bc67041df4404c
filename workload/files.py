"""Round trips through every file format, from tables of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from limpid.functions import snake_columns
from limpid.operators import tagged_union
from limpid.operators.ordering import order_breaks
from limpid.sources import (
    decode_tabs,
    decode_workbooks,
    drop_row_order,
    read_delimited,
    read_table,
    scratch_folder,
    split_unreadable,
    tab_headings,
    typed_tab,
    with_row_order,
    workbook_tab,
    write_quarantine,
    write_table,
)
from limpid.sources.publish import mark_complete, publish, settle, staging
from workload.registry import query, table, through_scratch
from workload.xlsx import as_workbooks

ROWS_PER_WORKBOOK = 1000


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS code_etablissement, c_name AS nom,
       CASE c_mktsegment WHEN 'BUILDING' THEN NULL ELSE 'Région ' || lower(c_mktsegment) END AS region
FROM customer
""")
def csv_roundtrip_latin1(spark, sf_dir):
    segment = F.col("c_mktsegment")
    region = F.when(segment == "BUILDING", "N/A").otherwise(
        F.concat(F.lit("Région "), F.lower(segment))
    )
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Code établissement"), F.col("c_name").alias("Nom"), region.alias("Région")
    )
    path = scratch_folder(spark, "latin1")
    raw.write.csv(path, header=True, sep=";", encoding="ISO-8859-1")
    return drop_row_order(
        snake_columns(read_delimited(spark, path, sep=";", encoding="ISO-8859-1"))
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS code, CAST(o_custkey AS VARCHAR) AS client,
       o_orderpriority || ', "' || o_orderstatus || '"' AS note
FROM orders
""")
def csv_roundtrip_bom(spark, sf_dir):
    note = F.concat("o_orderpriority", F.lit(', "'), "o_orderstatus", F.lit('"'))
    raw = table(spark, sf_dir, "orders").select(
        # The mark in the first heading becomes the first bytes of each file.
        F.col("o_orderkey").alias("\ufeffcode"),
        F.col("o_custkey").alias("client"),
        note.alias("note"),
    )
    path = scratch_folder(spark, "bom")
    raw.write.csv(path, header=True, escape='"')
    return drop_row_order(read_delimited(spark, path))


def odd_lines(spark, sf_dir):
    """Orders as text: some with a line end in a cell, some lines too long, some too short."""
    orders = table(spark, sf_dir, "orders")
    key, client = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    path = scratch_folder(spark, "odd-lines")
    ended = F.concat("o_orderpriority", F.lit("\n"), "o_orderstatus")
    orders.where("o_orderstatus = 'P'").select(
        key.alias("code"), client.alias("client"), ended.alias("note")
    ).write.csv(f"{path}/ends", header=True, escape='"')
    line = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat_ws(",", key, client, "o_orderstatus", key))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat_ws(",", key, client))
        .otherwise(F.concat_ws(",", key, client, "o_orderstatus"))
    )
    # One cell that the writer leaves alone, so that lines come out as they are.
    orders.where("o_orderstatus <> 'P'").select(line.alias("code,client,note")).write.csv(
        f"{path}/lengths", header=True, quote="", sep="\x01"
    )
    return [f"{path}/ends", f"{path}/lengths"]


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS code, CAST(o_custkey AS VARCHAR) AS client,
       CASE WHEN o_orderstatus = 'P' THEN o_orderpriority || chr(10) || o_orderstatus
            WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderstatus END AS note
FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority <> '5-LOW'
""")
def csv_line_ends(spark, sf_dir):
    rows = read_delimited(spark, odd_lines(spark, sf_dir), multi_line=True, unreadable=True)
    return drop_row_order(split_unreadable(through_scratch(rows, "lines"))[0])


@query("""
SELECT concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderkey) AS ligne FROM orders
WHERE o_orderstatus <> 'P' AND o_orderpriority = '5-LOW'
""")
def csv_malformed_rows(spark, sf_dir):
    rows = read_delimited(spark, odd_lines(spark, sf_dir), multi_line=True, unreadable=True)
    return split_unreadable(through_scratch(rows, "lines"))[1].select(F.trim("ligne").alias("ligne"))


@query("""
SELECT 'ligne' AS part, CAST(o_orderkey AS VARCHAR) AS code, CAST(o_custkey AS VARCHAR) AS client,
       CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderstatus END AS note, NULL AS suite
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
UNION ALL
SELECT 'illisible', CASE WHEN o_orderstatus = 'P' THEN o_orderkey || ',' || o_custkey || ',"' || o_orderpriority
  ELSE concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderkey) END, NULL, NULL,
  CASE WHEN o_orderstatus = 'P' THEN o_orderstatus || '"' END
FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'
""")
def csv_broken_records(spark, sf_dir):
    """Line ends in cells are not asked for: whole records are set aside, no half line is a row."""
    scan = read_delimited(spark, odd_lines(spark, sf_dir), unreadable=True)
    good, bad = split_unreadable(through_scratch(scan, "lines"))
    none = F.lit(None).cast("string")
    return (
        good.select(F.lit("ligne").alias("part"), "code", "client", "note", none.alias("suite"))
        .unionByName(bad.select(
            F.lit("illisible").alias("part"), F.col("ligne").alias("code"), none.alias("client"),
            none.alias("note"), "suite",
        ))
    )


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS annee FROM orders
WHERE year(o_orderdate) IN (1996, 1997)
""")
def partitioned_table(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("annee")
    )
    path = scratch_folder(spark, "orders")
    write_table(raw, path, ["annee"])
    return read_table(spark, path).where(F.col("annee").isin(1996, 1997))


@query("""
SELECT o_orderkey, CAST(CASE WHEN year(o_orderdate) = 1996 THEN 0 ELSE o_custkey END AS BIGINT) AS o_custkey,
       CAST(year(o_orderdate) AS INTEGER) AS annee
FROM orders WHERE year(o_orderdate) <> 1996 OR o_orderstatus = 'F'
""")
def rewritten_partition(spark, sf_dir):
    """One year of a written table is replaced; the other years are not touched."""
    raw = table(spark, sf_dir, "orders")
    annee = F.year("o_orderdate").alias("annee")
    path = scratch_folder(spark, "rewritten")
    write_table(raw.select("o_orderkey", "o_custkey", annee), path, ["annee"])
    again = raw.where("year(o_orderdate) = 1996 and o_orderstatus = 'F'")
    again = again.select("o_orderkey", F.lit(0).cast("bigint").alias("o_custkey"), annee)
    write_table(again, path, ["annee"], keep_others=True)
    return read_table(spark, path)


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS code,
       CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '5-LOW' THEN CAST('2020-01-01' AS DATE)
         WHEN '3-MEDIUM' THEN CAST('1905-07-12' AS DATE) ELSE CAST(o_orderdate AS DATE) END AS jour,
       CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'inconnue' END AS jour_illisible
FROM orders WHERE o_orderkey % 4 = 0
""")
def workbook_typed_cells(spark, sf_dir):
    """Dates, ISO text, a year as text, the same digits as a number, and text that is no date."""
    kinds = {"1-URGENT": "jour", "2-HIGH": "iso", "3-MEDIUM": "nombre", "4-NOT SPECIFIED": "texte", "5-LOW": "annee"}
    day, priority = F.col("o_orderdate").cast("date"), F.col("o_orderpriority")
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0").select(
        F.col("o_orderkey").cast("string").alias("Code"),
        day.alias("jour"), day.cast("string").alias("iso"), F.lit(2020).alias("nombre"),
        F.lit("inconnue").alias("texte"), F.lit("2020").alias("annee"),
        F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[priority].alias("tab"),
        F.floor(F.col("o_orderkey") / ROWS_PER_WORKBOOK).alias("book"),
    )
    # One tab per kind of cell; its second heading names the kind.
    columns = {kind: ["Code", kind] for kind in kinds.values()}
    files = through_scratch(as_workbooks(orders, "jours", "book", "tab", columns), "typed-workbooks")
    rows = through_scratch(decode_tabs(files, list(columns), ["Code", *columns]), "typed-rows")
    tabs = [
        typed_tab(rows, kind, ["Code", kind], dates=[kind], with_order=False)
        .toDF("code", "jour", "jour_illisible")
        for kind in columns
    ]
    return reduce(lambda a, b: a.unionByName(b), tabs)


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus = 'P'
""")
def quarantine_csv(spark, sf_dir):
    rejected = (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "P")
        .select("o_orderkey", "o_orderstatus", "o_orderpriority")
    )
    root = scratch_folder(spark, "quarantine")
    write_quarantine(rejected, root, "orders", "en_cours", fmt="csv")
    return drop_row_order(read_delimited(spark, f"{root}/orders/en_cours"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS matricule, c_name AS nom,
       CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS motif,
       CASE WHEN c_acctbal < 0 THEN 'contractuel' ELSE 'titulaire' END AS statut
FROM customer
""")
def workbook_tabs(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Matricule"),
        F.col("c_name").alias("Nom"),
        F.col("c_mktsegment").alias("Motif"),
        F.when(F.col("c_acctbal") < 0, "Contractuels").otherwise("Titulaires").alias("tab"),
        F.floor(F.col("c_custkey") / ROWS_PER_WORKBOOK).alias("book"),
    )
    columns = {"Titulaires": ["Matricule", "Nom"], "Contractuels": ["Nom", "Matricule", "Motif"]}
    files = through_scratch(as_workbooks(customer, "personnel", "book", "tab", columns), "workbooks")
    headings = decode_workbooks(files, headings_only=True)
    rows = through_scratch(decode_workbooks(files), "workbook-rows")
    # One tab by name, the other by position.
    tabs = {
        "titulaire": workbook_tab(rows, 0, tab_headings(headings, 0), with_order=False),
        "contractuel": workbook_tab(
            rows, "Contractuels", tab_headings(headings, "Contractuels"), with_order=False
        ),
    }
    return snake_columns(tagged_union(tabs, "statut"))


@query("""
WITH steps AS (
  SELECT lag(o_custkey) OVER (ORDER BY o_orderkey) > o_custkey AS falls,
         lag(o_orderpriority) OVER (ORDER BY o_orderkey) > o_orderpriority AS drops FROM orders
)
SELECT 'o_orderkey' AS key, count(*) AS rows, 0 AS breaks FROM steps
UNION ALL SELECT 'o_custkey', count(*), count(*) FILTER (falls) FROM steps
UNION ALL SELECT 'o_orderpriority', count(*), count(*) FILTER (drops) FROM steps
""")
def order_of_written_rows(spark, sf_dir):
    """A table written in the order of one column, checked for that one and two others."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    path = scratch_folder(spark, "in-order")
    write_table(orders.orderBy("o_orderkey"), path)
    rows = with_row_order(read_table(spark, path))
    parts = [
        order_breaks(rows, [key]).select(F.lit(key).alias("key"), "rows", "breaks") for key in orders.columns
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("""
SELECT 'done' AS state, o_orderstatus AS part, o_orderkey AS code FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'dropped', o_orderstatus, o_orderkey FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'finished', o_orderstatus, o_orderkey FROM orders WHERE o_orderstatus <> 'F'
""")
def published_tables(spark, sf_dir):
    """Two tables published together; then a run that ends early, and one that ends in between."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("part"), F.col("o_orderkey").alias("code")
    )
    out = scratch_folder(spark, "published")

    def stage(rows, *names):
        for name in names:
            write_table(rows, f"{staging(out)}/{name}")

    def seen(state, name):
        return through_scratch(read_table(spark, f"{out}/{name}"), state).select(F.lit(state).alias("state"), "*")

    old, new = orders.where("part = 'F'"), orders.where("part <> 'F'")
    stage(old, "one", "two")
    publish(spark, out)
    done = seen("done", "one")
    stage(new, "one")  # ended before its second table: nothing changes
    settle(spark, out)
    dropped = seen("dropped", "one")
    stage(new, "one", "two")  # complete, ended before its moves: they are made up for
    mark_complete(spark, out)
    settle(spark, out)
    return done.unionByName(dropped).unionByName(seen("finished", "two"))
