"""Regional indicators per (region, school year) from the clean tables.

Enrolment is summed per (school, year) before it meets the schools, so a school
with a third of all rows joins with as many rows as it has years. Distinct
counts shuffle by the counted key as well as the group, so five regions spread
over the whole cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions.numbers import guarded_ratio, round_half_up

SCHOOL = "code_etablissement"
GROUP = ("region", "annee")


def _or_zero(name: str):
    return F.coalesce(F.col(name), F.lit(0))


def school_years(eff: DataFrame) -> DataFrame:
    """Enrolment per (school, school year)."""
    return (
        eff.where(F.col("annee_scolaire").isNotNull())
        .withColumnRenamed("annee_scolaire", "annee")
        .groupBy(SCHOOL, "annee")
        .agg(
            F.sum(_or_zero("nb_garcons") + _or_zero("nb_filles")).alias("eleves"),
            F.sum(_or_zero("nb_filles")).alias("filles"),
        )
    )


def _located(etab: DataFrame, yearly: DataFrame) -> DataFrame:
    """(school, year) rows with their region."""
    places = etab.where(F.col("region").isNotNull()).select(SCHOOL, "region")
    return yearly.join(places, SCHOOL)


def schools_and_pupils(etab: DataFrame, yearly: DataFrame) -> DataFrame:
    """Schools and enrolment together: both group the same join, so it runs once."""
    return (
        _located(etab, yearly)
        .groupBy(*GROUP)
        .agg(
            F.count_distinct(SCHOOL).alias("nb_etablissements"),
            F.sum("eleves").alias("effectif_total"),
            F.sum("filles").alias("_filles"),
        )
        .withColumn("taux_feminisation", guarded_ratio(F.col("_filles"), F.col("effectif_total"), 0.0))
        .drop("_filles")
    )


def etablissements_par_region(etab: DataFrame, eff: DataFrame) -> DataFrame:
    return schools_and_pupils(etab, school_years(eff)).select(*GROUP, "nb_etablissements")


def effectifs_par_region(etab: DataFrame, eff: DataFrame) -> DataFrame:
    both = schools_and_pupils(etab, school_years(eff))
    return both.select(*GROUP, "effectif_total", "taux_feminisation")


def _teachers(etab: DataFrame, yearly: DataFrame, ens: DataFrame) -> DataFrame:
    """Distinct teachers per (region, year).

    A teacher with one post is counted at its school, and the school's count is added up over its
    years; only teachers with several posts meet each year one by one.
    """
    active = _located(etab.select(SCHOOL, "region").distinct(), yearly).select(SCHOOL, *GROUP)
    posts = ens.select("matricule", SCHOOL)
    several = posts.dropna().groupBy("matricule").count().where("count > 1").select("matricule")
    # A post without a number counts for nobody, but its region and year are there.
    alone = posts.join(several, "matricule", "left_anti").groupBy(SCHOOL).agg(F.count("matricule").alias("count"))
    moving = posts.join(several, "matricule", "left_semi").distinct()
    parts = [
        alone.join(active, SCHOOL).groupBy(*GROUP).agg(F.sum("count").alias("_n")),
        moving.join(active, SCHOOL).groupBy(*GROUP).agg(F.count_distinct("matricule").alias("_n")),
    ]
    return parts[0].unionByName(parts[1]).groupBy(*GROUP).agg(F.sum("_n").alias("nb_enseignants"))


def enseignants_par_region(etab: DataFrame, eff: DataFrame, ens: DataFrame) -> DataFrame:
    """A teacher counts in every year the school has enrolment."""
    return _teachers(etab, school_years(eff), ens)


def budgets_par_region(bud: DataFrame) -> DataFrame:
    known = bud.where(F.col("region").isNotNull() & F.col("annee").isNotNull())
    return known.groupBy(*GROUP).agg(F.sum(_or_zero("budget_total")).alias("budget_total"))


def end_year(annee: Column) -> Column:
    """Calendar year closing a school year: ``2022-2023`` gives 2023, other text NULL."""
    return F.split_part(annee, F.lit("-"), F.lit(2)).try_cast("bigint")


def synthese_regionale(
    etab: DataFrame,
    eff: DataFrame,
    ens: DataFrame,
    bud: DataFrame,
    yearly: DataFrame | None = None,
) -> DataFrame:
    """One row per (region, school year) known to all four tables, with ratios.

    ``yearly`` is ``school_years(eff)`` when the caller has it as a table already;
    two branches use it.
    """
    yearly = school_years(eff) if yearly is None else yearly
    budgets = budgets_par_region(bud).withColumnsRenamed({"annee": "_end", "region": "_region"})
    pupils, teachers = F.col("effectif_total"), F.col("nb_enseignants")
    return (
        schools_and_pupils(etab, yearly)
        .join(_teachers(etab, yearly, ens), [*GROUP])
        .withColumn("_end_year", end_year(F.col("annee")))
        .join(budgets, (F.col("region") == F.col("_region")) & (F.col("_end_year") == F.col("_end")))
        .select(
            "region",
            "annee",
            "nb_etablissements",
            "effectif_total",
            round_half_up(F.col("taux_feminisation"), 4).alias("taux_feminisation"),
            "nb_enseignants",
            round_half_up(guarded_ratio(pupils, teachers), 2).alias("ratio_eleves_enseignant"),
            "budget_total",
            round_half_up(guarded_ratio(F.col("budget_total"), pupils), 2).alias("budget_par_eleve"),
        )
        .orderBy(*GROUP)
    )
