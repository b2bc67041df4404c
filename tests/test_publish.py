"""Tables that change together, whatever run fails in between."""

from __future__ import annotations

import pytest

from limpid.plans import medallion
from limpid.sources import read_table, write_table
from limpid.sources.publish import COMPLETE, mark_complete, publish, settle, staging
from tests.conftest import rows
from tests.test_medallion import write_raw


def stage(spark, out, **values):
    for name, value in values.items():
        write_table(spark.sql(f"SELECT {value} AS x"), f"{staging(out)}/{name}")


def value_of(spark, out, name):
    return rows(read_table(spark, f"{out}/{name}"), "x")[0][0]


def test_unfinished_tables_are_dropped_and_complete_ones_moved(spark, tmp_path):
    out = str(tmp_path / "out")
    assert not settle(spark, out)  # nothing there yet
    stage(spark, out, a=1, b=1)
    publish(spark, out)
    write_table(spark.sql("SELECT 9 AS x"), f"{out}/other")
    stage(spark, out, a=2)
    assert not settle(spark, out)
    assert [value_of(spark, out, n) for n in "ab"] == [1, 1]
    # Complete, and ended after the first of its moves.
    stage(spark, out, a=3, b=3, c=3)
    mark_complete(spark, out)
    target = tmp_path / "out" / "a"
    for part in target.iterdir():
        part.unlink()
    target.rmdir()
    (tmp_path / "out" / "_next" / "a").rename(target)
    assert settle(spark, out) and not settle(spark, out)
    assert [value_of(spark, out, n) for n in "abc"] == [3, 3, 3]
    assert value_of(spark, out, "other") == 9
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a", "b", "c", "other"]


def test_a_failed_run_changes_nothing(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    write_raw(raw)
    medallion.run(spark, str(raw), str(out), run_ts="T1")
    before = {p: p.stat().st_mtime_ns for p in out.rglob("*") if p.is_file()}
    # Fewer schools, and an end after the clean tables are written.
    schools = raw / "etablissements_scolaires.csv"
    schools.write_bytes(b"\n".join(schools.read_bytes().split(b"\n")[:20]))

    def broken(run):
        raise RuntimeError("ended")

    with monkeypatch.context() as patch:
        patch.setattr(medallion, "silver_to_gold", broken)
        with pytest.raises(RuntimeError, match="ended"):
            medallion.run(spark, str(raw), str(out), run_ts="T2")
    left = out / "_next"
    assert (left / "silver").exists() and not (left / COMPLETE).exists()
    after = {p: p.stat().st_mtime_ns for p in out.rglob("*") if p.is_file() and left not in p.parents}
    assert after == before
    job = medallion.run(spark, str(raw), str(out), run_ts="T3")
    assert job.out == str(out) and not left.exists()
    assert read_table(spark, f"{out}/silver/etablissements").count() == 19


def test_a_run_goes_on_from_the_stages_of_one_that_failed(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    write_raw(raw)
    clean_budgets = medallion.clean_budgets

    def broken(tab):
        raise RuntimeError("ended")

    with monkeypatch.context() as patch:
        patch.setattr(medallion, "clean_budgets", broken)
        with pytest.raises(RuntimeError, match="ended"):
            medallion.run(spark, str(raw), str(out), run_ts="T1")
    staged = out / "_next" / "silver"
    before = {p: p.stat().st_mtime_ns for p in (staged / "enseignants").iterdir()}
    # Another file of enrolment: that entity is read again, the others are not.
    text = (raw / "effectifs_eleves.csv").read_bytes()
    (raw / "effectifs_eleves.csv").write_bytes(text.rsplit(b"\n", 3)[0])
    cleaned = []

    def counted(tab):
        cleaned.append("budgets")
        return clean_budgets(tab)

    with monkeypatch.context() as patch:
        patch.setattr(medallion, "clean_budgets", counted)
        job = medallion.run(spark, str(raw), str(out))
    assert sorted(job.resumed) == ["enseignants", "etablissements"] and cleaned == ["budgets"]
    assert job.run_ts == "T1" and not (out / "_next").exists()
    kept = out / "silver" / "enseignants"
    assert {p.name: p.stat().st_mtime_ns for p in kept.iterdir()} == {p.name: t for p, t in before.items()}
    metrics = {(r[0], r[1]): r[2] for r in read_table(spark, f"{out}/metrics").collect()}
    assert metrics["bronze_etablissements", "lignes_lues"] == 37
    assert metrics["bronze_effectifs", "lignes_lues"] == 85 - 3
    assert metrics["bronze_enseignants", "lignes_lues"] == 512
    measured = {(r[0], r[1]) for r in read_table(spark, f"{out}/mesures").collect()}
    assert ("clean_enseignants", "dates_illisibles") in measured
    # A finished run leaves nothing to go on from.
    assert medallion.run(spark, str(raw), str(out)).resumed == []
