from __future__ import annotations

from limpid.plans import gold
from tests.conftest import rows


def tables(spark, eff=None, ens=None, bud=None):
    etab = [("A", "Kara"), ("B", "Kara"), ("C", "Savanes"), ("D", None), ("E", "Maritime")]
    eff = eff or [
        ("A", "2022-2023", 10, 20),
        ("A", "2022-2023", 5, None),
        ("B", "2022-2023", None, 5),
        ("B", "2021-2022", 1, 1),
        ("C", "2022-2023", 0, 0),
        ("C", "2022", 3, 3),
        ("D", "2022-2023", 9, 9),
        ("A", None, 9, 9),
        ("Z", "2022-2023", 9, 9),
    ]
    ens = ens or [("t1", "A"), ("t2", "A"), ("t2", "B"), ("t3", "C"), ("t4", "E"), (None, "A"), ("t5", "Z")]
    bud = bud or [
        ("Kara", 2023, 100.0),
        ("Kara", 2023, 60.0),
        ("Kara", 2022, None),
        ("Savanes", 2023, 5.0),
        ("Maritime", 2023, 5.0),
        (None, 2023, 1.0),
        ("Kara", None, 1.0),
    ]
    return (
        spark.createDataFrame(etab, "code_etablissement string, region string"),
        spark.createDataFrame(
            eff, "code_etablissement string, annee_scolaire string, nb_garcons bigint, nb_filles bigint"
        ),
        spark.createDataFrame(ens, "matricule string, code_etablissement string"),
        spark.createDataFrame(bud, "region string, annee bigint, budget_total double"),
    )


def test_each_indicator(spark):
    etab, eff, ens, bud = tables(spark)
    assert rows(gold.etablissements_par_region(etab, eff)) == [
        ("Kara", "2021-2022", 1),
        ("Kara", "2022-2023", 2),
        ("Savanes", "2022", 1),
        ("Savanes", "2022-2023", 1),
    ]
    assert rows(gold.effectifs_par_region(etab, eff)) == [
        ("Kara", "2021-2022", 2, 0.5),
        ("Kara", "2022-2023", 40, 0.625),
        ("Savanes", "2022", 6, 0.5),
        ("Savanes", "2022-2023", 0, 0.0),
    ]
    # t2 works at two schools of one region and counts once.
    assert rows(gold.enseignants_par_region(etab, eff, ens)) == [
        ("Kara", "2021-2022", 1),
        ("Kara", "2022-2023", 2),
        ("Savanes", "2022", 1),
        ("Savanes", "2022-2023", 1),
    ]
    assert rows(gold.budgets_par_region(bud)) == [
        ("Kara", 2022, 0.0),
        ("Kara", 2023, 160.0),
        ("Maritime", 2023, 5.0),
        ("Savanes", 2023, 5.0),
    ]


def test_synthesis(spark):
    result = gold.synthese_regionale(*tables(spark))
    assert result.columns == [
        "region",
        "annee",
        "nb_etablissements",
        "effectif_total",
        "taux_feminisation",
        "nb_enseignants",
        "ratio_eleves_enseignant",
        "budget_total",
        "budget_par_eleve",
    ]
    assert [tuple(r) for r in result.collect()] == [
        ("Kara", "2021-2022", 1, 2, 0.5, 1, 2.0, 0.0, 0.0),
        ("Kara", "2022-2023", 2, 40, 0.625, 2, 20.0, 160.0, 4.0),
        ("Savanes", "2022-2023", 1, 0, 0.0, 1, 0.0, 5.0, None),
    ]


def test_no_teacher_number_gives_no_ratio(spark):
    frames = tables(spark, ens=[(None, "A")])
    assert [tuple(r)[5:7] for r in gold.synthese_regionale(*frames).collect()] == [(0, None)]


def test_repeated_school_rows_count_as_the_join_says(spark):
    etab, eff, ens, bud = tables(spark)
    twice = etab.unionAll(etab)
    assert rows(gold.effectifs_par_region(twice, eff), "effectif_total") == [(0,), (12,), (4,), (80,)]
    assert rows(gold.etablissements_par_region(twice, eff)) == rows(
        gold.etablissements_par_region(etab, eff)
    )


def test_enrolment_is_summed_before_the_join(spark):
    etab, eff, _, _ = tables(spark)
    plan = gold.effectifs_par_region(etab, eff)._jdf.queryExecution().optimizedPlan().toString()
    join, first_sum = plan.index("Join"), plan.rindex("Aggregate")
    assert first_sum > join


def test_scans_read_only_the_needed_columns(spark, tmp_path):
    etab, eff, ens, bud = tables(spark)
    for name, df in {"etab": etab, "eff": eff, "ens": ens, "bud": bud}.items():
        df.withColumn("autre", df.columns and df[df.columns[0]]).write.parquet(f"{tmp_path}/{name}")
    frames = [spark.read.parquet(f"{tmp_path}/{n}") for n in ("etab", "eff", "ens", "bud")]
    plan = gold.synthese_regionale(*frames)._jdf.queryExecution().executedPlan().toString()
    assert "autre" not in plan
    assert "IsNotNull(region)" in plan and "IsNotNull(annee_scolaire)" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_an_empty_input_gives_an_empty_table(spark):
    etab, eff, ens, bud = tables(spark)
    assert gold.synthese_regionale(etab, eff, ens.where("false"), bud).count() == 0
