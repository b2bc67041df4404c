"""The full run on files of the documented shape: 37, 85, 511 and 15 raw rows."""

from __future__ import annotations

import pytest

from limpid.functions.text import REGIONS
from limpid.plans.medallion import run
from limpid.sources import read_table
from tests.conftest import rows
from workload.xlsx import workbook_bytes

YEARS = ["2021-2022", "2022-2023", "2023-2024"]


def write_raw(folder):
    places = [REGIONS[i % 5] for i in range(34)]
    head = "Code établissement;Nom établissement;Région;Préfecture;Type;Statut;Date création"
    lines = [
        f"ETB-{i + 1:03d};École {i};  {place} ; P{i % 7} ;lycée;public;{i % 28 + 1:02d}/03/199{i % 10}"
        for i, place in enumerate(places)
    ]
    lines += [line.replace("École", "Copie") for line in lines[:3]]
    (folder / "etablissements_scolaires.csv").write_bytes("\n".join([head, *lines]).encode("latin-1"))

    pairs = [(f"ETB-{i + 1:03d}", year) for i in range(34) for year in YEARS][:83]
    counts = [(code, year, 100 + i, 90 + i) for i, (code, year) in enumerate(pairs)]
    cells = [f"{c},{y},{b},{g}" for c, y, b, g in counts]
    cells[6] = cells[6].rsplit(",", 1)[0] + ","
    cells[9] = f"{counts[9][0]},{counts[9][1]},1 245,1 300"
    cells += ["ETB-999,2022-2023,120,110", "ETB-998,2023-2024,98,87"]
    text = "code_etablissement,annee_scolaire,nb_garcons,nb_filles\n" + "\n".join(cells)
    (folder / "effectifs_eleves.csv").write_bytes(text.encode("utf-8-sig"))

    columns = ["Matricule", "Nom", "Prénom", "Code établissement", "Matière", "Date prise de poste"]
    people = [
        [f"T{1000 + i:05d}", f"N{i}", f"P{i}", f"ETB-{i % 34 + 1:03d}", "HG", 40000 + i] for i in range(508)
    ]
    shared = [[*people[i][:5], 41000, 45000] for i in (0, 10, 20)]
    contracts = [[*p, 45500] for p in people[400:]] + shared
    book = {
        "Titulaires": (columns, people[:400]),
        "Contractuels": ([*columns, "Date fin contrat"], contracts),
        "Métadonnées": (["Code", "Libellé"], [["HG", "Histoire"]]),
    }
    (folder / "personnel_enseignant.xlsx").write_bytes(workbook_bytes(book))

    spelled = ["{}", "{}".upper(), "Région de {}"]
    budget = [
        [spelled[j].format(r) if j != 1 else r.upper(), y, 1e6 + i, 2e6, 3e6 + i]
        for i, r in enumerate(REGIONS)
        for j, y in enumerate((2022, 2023, 2024))
    ]
    budget[0][2], budget[4][3], budget[8][4] = "N/A", "en attente", "non communiqué"
    columns = ["Région", "Annee", "Budget fonctionnement", "Budget investissement", "Budget total"]
    (folder / "budgets_regionaux.xlsx").write_bytes(workbook_bytes({"Feuille 1": (columns, budget)}))


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    raw, out = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("out")
    write_raw(raw)
    return run(spark, str(raw), str(out), run_ts="2024-01-01 00:00:00")


def test_counters(spark, finished):
    metrics = {(r[0], r[1]): r[2] for r in read_table(spark, f"{finished.out}/metrics").collect()}
    assert metrics == {
        ("bronze_etablissements", "lignes_lues"): 37,
        ("bronze_etablissements", "illisibles"): 0,
        ("clean_etablissements", "lignes_ecrites"): 34,
        ("clean_etablissements", "doublons"): 3,
        ("bronze_effectifs", "lignes_lues"): 85,
        ("bronze_effectifs", "illisibles"): 0,
        ("clean_effectifs", "sans_etablissement"): 2,
        ("clean_effectifs", "supprimes"): 1,
        ("clean_effectifs", "strategie_delete"): 1,
        ("clean_effectifs", "lignes_ecrites"): 82,
        ("bronze_enseignants", "lignes_lues"): 512,
        ("clean_enseignants", "sans_etablissement"): 0,
        ("clean_enseignants", "doublons"): 3,
        ("clean_enseignants", "lignes_ecrites"): 508,
        ("bronze_budgets", "lignes_lues"): 15,
        ("clean_budgets", "lignes_ecrites"): 15,
        ("clean_budgets", "mises_a_zero_budget_fonctionnement"): 1,
        ("clean_budgets", "mises_a_zero_budget_investissement"): 1,
        ("clean_budgets", "mises_a_zero_budget_total"): 1,
        ("clean_budgets", "regions_distinctes"): 5,
        ("synthese_regionale", "lignes_ecrites"): 15,
        ("synthese_regionale", "vide"): 0,
    }


def test_first_rows_win_and_copies_are_kept_aside(spark, finished):
    schools = read_table(spark, f"{finished.out}/silver/etablissements")
    assert schools.where("nom_etablissement like 'Copie%'").count() == 0
    aside = read_table(spark, f"{finished.out}/quarantine/etablissements/doublons")
    assert rows(aside, "code_etablissement") == [("ETB-001",), ("ETB-002",), ("ETB-003",)]


def test_grouped_digits_and_the_deleted_row(spark, finished):
    clean = read_table(spark, f"{finished.out}/silver/effectifs")
    assert clean.where("nb_garcons = 1245 and nb_filles = 1300").count() == 1
    deleted = read_table(spark, f"{finished.out}/quarantine/effectifs/supprimes")
    assert rows(deleted, "code_etablissement", "date_suppression", "motif_suppression") == [
        ("ETB-003", "2024-01-01 00:00:00", "valeur_manquante_nb_filles")
    ]


def test_permanent_post_wins(spark, finished):
    people = read_table(spark, f"{finished.out}/silver/enseignants")
    shared = people.where("matricule in ('T01000', 'T01010', 'T01020')")
    assert rows(shared, "matricule", "statut", "date_fin_contrat") == [
        ("T01000", "titulaire", None),
        ("T01010", "titulaire", None),
        ("T01020", "titulaire", None),
    ]
    removed = read_table(spark, f"{finished.out}/quarantine/enseignants/doublons")
    assert rows(removed, "statut", "date_prise_de_poste") == [("contractuel", "2012-04-01")] * 3


def test_measures_of_deleted_gaps(spark, finished):
    found = {r["metric"]: r["value"] for r in read_table(spark, f"{finished.out}/mesures").collect()}
    girls = [90 + i for i in range(83) if i not in (6, 9)] + [1300]
    want = {"lignes": 83, "manquantes": 1, "taux_manquant": 1 / 83, "moyenne": sum(girls) / 82}
    for name, value in want.items():
        assert found[f"{name}_nb_filles_avant"] == pytest.approx(value, rel=1e-12)
    assert (found["lignes_nb_filles_apres"], found["manquantes_nb_filles_apres"]) == (82, 0)
    for stage in ("avant", "apres"):
        below = sum(g < found[f"mediane_environ_nb_filles_{stage}"] for g in girls)
        assert below in (40, 41)


def test_all_quality_checks_pass(spark, finished):
    report = read_table(spark, f"{finished.out}/quality")
    # Zero-filled budgets are not NULL, and all regions occur; nothing is bad.
    assert rows(report.where("not passed")) == []
    assert report.count() > 50


def test_marts(spark, finished):
    marts = read_table(spark, f"{finished.out}/gold/synthese_regionale")
    assert (marts.count(), len(marts.columns)) == (15, 9)
    one = marts.where("region = 'Kara' and annee = '2023-2024'").first()
    assert one["budget_par_eleve"] == round(one["budget_total"] / one["effectif_total"], 2)


def test_a_second_run_replaces_the_first(spark, finished, tmp_path):
    write_raw(tmp_path)
    again = run(spark, str(tmp_path), finished.out, run_ts="2024-01-01 00:00:00")
    assert again.counters == finished.counters
    assert read_table(spark, f"{again.out}/silver/enseignants").count() == 508


def scratch_folders(spark):
    from pathlib import Path

    from limpid.sources import scratch_folder

    return {p.name for p in Path(scratch_folder(spark, "x")).parent.glob("limpid-*")}


def test_a_run_with_another_strategy_leaves_no_stale_rows(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    write_raw(raw)
    run(spark, str(raw), str(out), run_ts="T1", audit_format="csv")
    assert not (out / "work").exists()
    lines = (raw / "effectifs_eleves.csv").read_text("utf-8-sig").split("\n")
    lines[20:40] = [line.rsplit(",", 1)[0] + "," for line in lines[20:40]]
    lines[50] += ",7"
    schools = (raw / "etablissements_scolaires.csv").read_bytes().decode("latin-1")
    schools = schools.replace("02/03/1991", "bientôt").replace("03/03/1992", "31/02/2000").replace("04/03/1993", "")
    (raw / "etablissements_scolaires.csv").write_bytes(schools.encode("latin-1"))
    (raw / "effectifs_eleves.csv").write_bytes("\n".join(lines).encode("utf-8-sig"))
    before = scratch_folders(spark)
    job = run(spark, str(raw), str(out), run_ts="T2")
    assert scratch_folders(spark) == before
    aside = f"{out}/quarantine/effectifs"
    assert read_table(spark, f"{aside}/supprimes").count() == 0
    assert {r["date_imputation"] for r in read_table(spark, f"{aside}/imputes").collect()} == {"T2"}
    assert read_table(spark, f"{aside}/illisibles").count() == 1
    measured = {r["metric"]: r["value"] for r in read_table(spark, f"{out}/mesures").collect()}
    unread = read_table(spark, f"{out}/mesures").where("metric = 'dates_illisibles'")
    assert rows(unread, "step", "value") == [("clean_enseignants", 0.0), ("clean_etablissements", 2.0)]
    assert read_table(spark, f"{out}/silver/etablissements").where("date_creation is null").count() == 3
    filled = read_table(spark, f"{aside}/imputes")
    assert measured["manquantes_nb_filles_avant"] == filled.count()
    assert measured["manquantes_nb_filles_apres"] == 0
    assert measured["mediane_globale"] == filled.first()["mediane_globale_fallback"]
    assert measured["lignes_sans_mediane"] == filled.where("etablissement_sans_median").count()
    assert ("bronze_effectifs", "illisibles", 1) in job.counters


def test_checks_of_the_tables_that_are_there(spark, finished):
    from limpid.plans.medallion import COLUMNS, quality_of

    tables = {e: None for e in COLUMNS}
    for entity in ("etablissements", "effectifs", "enseignants"):
        tables[entity] = read_table(spark, f"{finished.out}/silver/{entity}")
    report = quality_of(spark, tables).collect()
    assert {r["entity"] for r in report if r["check"] == "exists" and not r["passed"]} == {"budgets", "synthese_regionale"}
    assert len(report) > 25
    assert {r["check"] for r in report} >= {"reference", "unique", "iso_date", "in_domain", "column_present"}
