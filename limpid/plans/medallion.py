"""The full run: raw files to bronze, silver, quarantine, gold, quality and metrics.

Every stage hands over through a written table. That decodes each raw file once,
cuts the lineage where several jobs read the same rows, and lets a lost executor
repeat only its own stage. All is written below ``out/_next`` first and takes the place of
the tables of the run before at the end, so that a run that fails changes none of them.
The next run on the same files goes on from the stages that one had finished.

    out/bronze/<entity>           raw text cells in Parquet, with the row order
    out/silver/<entity>           clean tables
    out/quarantine/<entity>/<why> rejected and altered rows
    out/gold/synthese_regionale   regional marts
    out/quality, out/metrics      checks and counters of the run
    out/mesures                   rates, means and medians around a step
    out/_next/work/<name>         tables that cut a lineage, removed at the end
    out/_next/_notes/<stage>      what a finished stage was made from, and its counters
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from limpid.functions.text import REGIONS
from limpid.operators import quality as Q
from limpid.operators.missing import GapFacts, column_facts, run_stamp
from limpid.plans import gold
from limpid.plans.silver import (
    BUDGETS_CUT,
    SCHOOL_KEY,
    STATUS_OF_TAB,
    UNREAD,
    CleanResult,
    clean_budgets,
    clean_effectifs,
    clean_enseignants,
    clean_etablissements,
)
from limpid.sources.delimited import UNREADABLE, read_delimited, split_unreadable
from limpid.sources.publish import (
    drop_note,
    files_fingerprint,
    publish,
    read_note,
    settle,
    staging,
    write_note,
)
from limpid.sources.scratch import remove_folder, scratch_removed
from limpid.sources.tables import (
    read_table,
    read_table_if_any,
    through_table,
    write_quarantine,
    write_table,
)
from limpid.sources.workbook import (
    decode_workbooks,
    headings_of_tabs,
    plain_headings,
    read_workbook_files,
    workbook_tab,
)

# Names of the raw files; a part may follow the stem.
SCHOOLS_FILES = "etablissements_scolaires*.csv"
ENROLMENT_FILES = "effectifs_eleves*.csv"
TEACHERS_FILES = "personnel_enseignant*.xlsx"
BUDGETS_FILES = "budgets_regionaux*.xlsx"

METRICS = "step string, metric string, value bigint"
MEASURED = "step string, metric string, value double"
# Every reason for which a row of an entity can be set aside.
REASONS = {
    "etablissements": ("doublons",),
    "effectifs": ("sans_etablissement", "supprimes", "imputes"),
    "enseignants": ("sans_etablissement", "doublons"),
    "budgets": (),
}


def filled_facts() -> dict[str, Column]:
    """What the audit of filled rows tells in the pass that writes it."""
    return {
        "mediane_globale": F.max("mediane_globale_fallback").cast("double"),
        "lignes_sans_mediane": F.count_if("etablissement_sans_median").cast("double"),
    }


def observed(df: DataFrame, measures: dict[str, Column]) -> tuple[DataFrame, Observation | None]:
    """Aggregates taken while ``df`` is written; there is nothing to observe without any."""
    if not measures:
        return df, None
    seen = Observation()
    return df.observe(seen, *[x.alias(name) for name, x in measures.items()]), seen


class Run:
    """Paths, counters and measures of one run."""

    def __init__(
        self,
        spark: SparkSession,
        out_dir: str,
        run_ts: str | None = None,
        audit_format: str = "parquet",
    ):
        self.spark = spark
        self.out = out_dir.rstrip("/")
        self.run_ts = run_ts or run_stamp()
        self.audit_format = audit_format
        self.counters: list[tuple[str, str, int]] = []
        self.measures: list[tuple[str, str, float | None]] = []
        self.resumed: list[str] = []  # stages that an earlier run had finished

    def stage(self, name: str, made_from: str | None, work: Callable[[], object]) -> None:
        """Do ``work`` unless its tables are staged already, made from the same inputs.

        Without a fingerprint (``None``) it is always done. The note goes before the tables
        change and comes back after the last of them, so it never vouches for half of them.
        Steps of a stage end with its name; a skipped stage takes their counters from the note.
        """
        note = read_note(self.spark, self.out, name) if made_from else None
        if note and note["made_from"] == made_from:
            self.resumed.append(name)
            self.counters += [tuple(c) for c in note["counters"]]
            self.measures += [tuple(m) for m in note["measures"]]
            return
        drop_note(self.spark, self.out, name)
        work()
        if made_from:
            mine = {
                kind: [x for x in rows if x[0].endswith(name)]
                for kind, rows in (("counters", self.counters), ("measures", self.measures))
            }
            write_note(self.spark, self.out, name, {"made_from": made_from, **mine})

    def count(self, step: str, metric: str, value: int) -> None:
        self.counters.append((step, metric, value))

    def measure(self, step: str, stage: str, column: str, facts: GapFacts) -> None:
        """Facts of a column before or after a step; the medians are those of sketches."""
        values = {
            "lignes": facts.rows, "manquantes": facts.missing, "taux_manquant": facts.rate,
            "moyenne": facts.mean, "mediane_environ": facts.median,
        }
        for name, value in values.items():
            number = None if value is None else float(value)
            self.measures.append((step, f"{name}_{column}_{stage}", number))

    def bronze(self, df: DataFrame, entity: str) -> DataFrame:
        path = f"{self.out}/bronze/{entity}"
        self.count(f"bronze_{entity}", "lignes_lues", write_table(df, path))
        rows = self.spark.read.schema(df.schema).parquet(path)
        if UNREADABLE not in df.columns:
            return rows
        rows, bad = split_unreadable(rows)
        n_rows = write_quarantine(
            bad, f"{self.out}/quarantine", entity, "illisibles", self.audit_format
        )
        self.count(f"bronze_{entity}", "illisibles", n_rows)
        return rows

    def silver(self, entity: str, result: CleanResult) -> DataFrame:
        """Write a clean table and its quarantine, note the counters."""
        step = f"clean_{entity}"
        path = f"{self.out}/silver/{entity}"
        facts = column_facts(result.gap_column) if result.gaps else {}
        if result.checked is not None:
            facts["unread"] = F.coalesce(F.sum(UNREAD), F.lit(0))
        clean, seen = observed(result.clean if result.checked is None else result.checked, facts)
        self.count(step, "lignes_ecrites", write_table(clean.drop(UNREAD), path))
        found = dict(seen.get) if seen else {}
        if result.checked is not None:
            self.measures.append((step, "dates_illisibles", float(found.pop("unread"))))
        if result.gaps:
            self.measure(step, "avant", result.gap_column, result.gaps)
            self.measure(step, "apres", result.gap_column, GapFacts(**found))
        # Reasons of another run that this one does not have are emptied.
        unused = {r: result.clean.limit(0) for r in REASONS[entity] if r not in result.rejects}
        for reason, rows in {**result.rejects, **unused}.items():
            filled = reason == "imputes" and reason not in unused
            rows, seen = observed(rows, filled_facts() if filled else {})
            n_rows = write_quarantine(
                rows, f"{self.out}/quarantine", entity, reason, self.audit_format
            )
            if reason not in unused:
                self.count(step, reason, n_rows)
            if seen:
                self.measures += [(step, name, value) for name, value in seen.get.items()]
        if result.strategy in ("delete", "impute"):
            self.count(step, f"strategie_{result.strategy}", 1)
        if result.measures is not None:
            # A handful of aggregate values, one per budget column.
            for row in result.measures.collect():
                self.count(step, row["metric"], row["value"])
        return self.spark.read.schema(result.clean.schema).parquet(path)


@dataclass(frozen=True)
class Raw:
    """Raw inputs: two text tables, and workbooks as (path, content)."""

    schools: DataFrame
    enrolment: DataFrame
    teachers: DataFrame
    budgets: DataFrame


@dataclass(frozen=True)
class RawFolder:
    """The inputs of ``Raw`` in a folder, each opened when it is asked for."""

    spark: SparkSession
    folder: str
    multi_line: bool = False

    def _text(self, files: str, **options) -> DataFrame:
        return read_delimited(
            self.spark, f"{self.folder}/{files}", multi_line=self.multi_line, unreadable=True, **options
        )

    @property
    def schools(self) -> DataFrame:
        return self._text(SCHOOLS_FILES, sep=";", encoding="ISO-8859-1")

    @property
    def enrolment(self) -> DataFrame:
        return self._text(ENROLMENT_FILES)

    @property
    def teachers(self) -> DataFrame:
        return read_workbook_files(self.spark, f"{self.folder}/{TEACHERS_FILES}")

    @property
    def budgets(self) -> DataFrame:
        return read_workbook_files(self.spark, f"{self.folder}/{BUDGETS_FILES}")

    def fingerprint(self, files: str) -> str:
        return f"{files_fingerprint(self.spark, f'{self.folder}/{files}')}:{self.multi_line}"


def raw_files(spark: SparkSession, raw_dir: str, multi_line: bool = False) -> RawFolder:
    return RawFolder(spark, raw_dir.rstrip("/"), multi_line)


def bronze_tabs(
    run: Run, files: DataFrame, entity: str, sheets: Sequence[str | int]
) -> list[DataFrame]:
    """Decode the workbooks once; the headings come from a first-row decode."""
    names = headings_of_tabs(decode_workbooks(files, headings_only=True), sheets)
    columns = plain_headings(h for of_tab in names for h in of_tab)
    rows = run.bronze(decode_workbooks(files, columns=columns), entity)
    return [workbook_tab(rows, sheet, cols) for sheet, cols in zip(sheets, names)]


def bronze_to_silver(run: Run, raw: Raw | RawFolder, canonical_region: bool = False) -> None:
    """Schools first; the three others need at most the written schools.

    They are submitted together, so that one's small jobs fill the gaps of another.
    """

    def made_from(files: str, *others: object) -> str | None:
        """Raw files and options of a stage; unknown for inputs that came opened."""
        if isinstance(raw, Raw):
            return None
        return "|".join([raw.fingerprint(files), run.audit_format, *map(str, others)])

    of_schools = made_from(SCHOOLS_FILES, canonical_region)

    def clean_schools() -> None:
        rows = run.bronze(raw.schools, "etablissements")
        run.silver("etablissements", clean_etablissements(rows, canonical_region=canonical_region))

    run.stage("etablissements", of_schools, clean_schools)
    schools = read_table(run.spark, f"{run.out}/silver/etablissements")

    def cut(df: DataFrame, name: str) -> DataFrame:
        return through_table(df, f"{run.out}/work/{name}")

    def clean_enrolment() -> None:
        rows = run.bronze(raw.enrolment, "effectifs")
        run.silver("effectifs", clean_effectifs(rows, schools, run_ts=run.run_ts, cut=cut))

    def clean_teachers() -> None:
        tabs = bronze_tabs(run, raw.teachers, "enseignants", list(STATUS_OF_TAB))
        by_status = dict(zip(STATUS_OF_TAB.values(), tabs))
        run.silver("enseignants", clean_enseignants(by_status, schools, cut=cut))

    def clean_amounts() -> None:
        rows = bronze_tabs(run, raw.budgets, "budgets", [0])[0]
        BUDGETS_CUT.set(cut)
        run.silver("budgets", clean_budgets(rows))

    def enrolment() -> None:
        # The audit of filled rows carries the time text of its run.
        run.stage("effectifs", made_from(ENROLMENT_FILES, of_schools, run.run_ts), clean_enrolment)

    def teachers() -> None:
        run.stage("enseignants", made_from(TEACHERS_FILES, of_schools), clean_teachers)

    def budgets() -> None:
        run.stage("budgets", made_from(BUDGETS_FILES), clean_amounts)

    with ThreadPoolExecutor(3) as pool:
        parts = (enrolment, teachers, budgets)
        for done in [pool.submit(copy_context().run, part) for part in parts]:
            done.result()


def silver_to_gold(run: Run) -> DataFrame:
    tables = [
        read_table(run.spark, f"{run.out}/silver/{e}")
        for e in ("etablissements", "effectifs", "enseignants", "budgets")
    ]
    yearly = through_table(gold.school_years(tables[1]), f"{run.out}/work/annees_scolaires")
    path = f"{run.out}/gold/synthese_regionale"
    n_rows = write_table(gold.synthese_regionale(*tables, yearly=yearly), path)
    run.count("synthese_regionale", "lignes_ecrites", n_rows)
    run.count("synthese_regionale", "vide", int(n_rows == 0))
    return read_table(run.spark, path)


AMOUNTS = ("budget_fonctionnement", "budget_investissement", "budget_total")
MEASURES = (
    "nb_etablissements",
    "effectif_total",
    "taux_feminisation",
    "ratio_eleves_enseignant",
    "budget_total",
    "budget_par_eleve",
)
# The contract of each written table: columns, types, keys, reference to the schools.
COLUMNS = {
    "etablissements": (
        SCHOOL_KEY, "nom_etablissement", "region", "prefecture", "type", "statut", "date_creation",
    ),
    "effectifs": (SCHOOL_KEY, "annee_scolaire", "nb_garcons", "nb_filles"),
    "enseignants": (
        "matricule", "nom", "prenom", SCHOOL_KEY, "matiere", "date_prise_de_poste", "statut",
    ),
    "budgets": ("region", "annee", *AMOUNTS),
    "synthese_regionale": ("region", "annee", *MEASURES),
}
TYPES = {
    "etablissements": {SCHOOL_KEY: "string", "region": "string", "date_creation": "date"},
    "effectifs": {"nb_garcons": "integer", "nb_filles": "integer"},
    "enseignants": {"matricule": "string", "statut": "string"},
    "budgets": {"annee": "numeric", **dict.fromkeys(AMOUNTS, "float")},
    "synthese_regionale": {
        "nb_etablissements": "numeric",
        "taux_feminisation": "float",
        "ratio_eleves_enseignant": "float",
        "budget_par_eleve": "float",
    },
}
KEYS = {"etablissements": SCHOOL_KEY, "enseignants": "matricule"}
OF_A_SCHOOL = ("effectifs", "enseignants")


def row_rules(df: DataFrame, entity: str, regions: Sequence[str]) -> tuple[list[Q.Rule], dict]:
    """Rules for the rows of a table, and domains that must be covered."""
    if entity == "etablissements":
        return [Q.not_null(SCHOOL_KEY)], {}
    if entity == "effectifs":
        return [Q.not_null("nb_filles"), Q.in_range("nb_filles", low=0)], {}
    if entity == "enseignants":
        dates = [Q.iso_date(c) for c in df.columns if "date" in c]
        return [Q.in_domain("statut", list(STATUS_OF_TAB.values())), *dates], {}
    if entity == "budgets":
        rules = [Q.in_domain("region", regions), *[Q.not_null(c) for c in AMOUNTS]]
        return rules, {"region": regions}
    rules = [
        *[Q.not_null(c) for c in MEASURES],
        *[Q.in_range(c, low=0) for c in MEASURES],
        Q.in_range("taux_feminisation", low=0, high=1),
        Q.agrees_with("budget_par_eleve", F.col("budget_total") / F.col("effectif_total")),
    ]
    return rules, {"region": regions}


def table_checks(df: DataFrame, entity: str, regions: Sequence[str]) -> list[DataFrame]:
    """Checks that need the table's rows: one aggregate, and one for its key."""
    present = set(df.columns)
    rules, covers = row_rules(df, entity, regions)
    # A missing column is a finding of its own; its rules cannot be asked.
    rules = [r for r in rules if r.column in present]
    covers = {c: d for c, d in covers.items() if c in present}
    checks = [Q.check_rows(df, entity, rules, covers)] if rules or covers else []
    key = KEYS.get(entity)
    return checks + ([Q.check_unique(df, entity, [key])] if key in present else [])


def quality_of(
    spark: SparkSession, tables: dict[str, DataFrame | None], regions: Sequence[str] = REGIONS
) -> DataFrame:
    """All checks of the tables that are there; a missing table is itself a finding."""
    found = {entity: df for entity, df in tables.items() if df is not None}
    facts = Q.found_facts({entity: df is not None for entity, df in tables.items()})
    checks = []
    for entity, df in found.items():
        facts += Q.column_facts(df, entity, COLUMNS[entity]) + Q.type_facts(df, entity, TYPES[entity])
        checks += table_checks(df, entity, regions)
    schools = found.get("etablissements")
    for entity in OF_A_SCHOOL:
        df = found.get(entity)
        if schools is not None and df is not None and SCHOOL_KEY in df.columns:
            checks.append(Q.check_reference(df, entity, SCHOOL_KEY, schools))
    return Q.quality_report([Q.fact_rows(spark, facts), *checks])


def quality(run: Run, regions: Sequence[str] = REGIONS) -> DataFrame:
    paths = {e: f"{run.out}/silver/{e}" for e in COLUMNS if e != "synthese_regionale"}
    paths["synthese_regionale"] = f"{run.out}/gold/synthese_regionale"
    tables = {e: read_table_if_any(run.spark, p) for e, p in paths.items()}
    return through_table(quality_of(run.spark, tables, regions), f"{run.out}/quality")


def run(
    spark: SparkSession,
    raw: str | Raw,
    out_dir: str,
    run_ts: str | None = None,
    canonical_region: bool = False,
    regions: Sequence[str] = REGIONS,
    audit_format: str = "parquet",
    multi_line: bool = False,
) -> Run:
    """Raw files (a folder, or inputs already opened) to marts, in dependency order.

    ``multi_line`` allows line ends inside quoted cells of the text files; without it such
    records are set aside whole.

    ``audit_format`` is that of the quarantine: Parquet, or CSV with a byte-order mark.

    A run that ended while it put its tables in place is finished first. One that ended
    before is taken up: of a folder whose files and options are as they were, the entities
    that it had cleaned are not read again, and its time text goes on (unless ``run_ts`` is
    another). The marts and all checks are always made anew.
    """
    settle(spark, out_dir, keep_unfinished=isinstance(raw, str))
    begun = read_note(spark, staging(out_dir), "run") or {}
    job = Run(spark, staging(out_dir), run_ts or begun.get("run_ts"), audit_format)
    write_note(spark, job.out, "run", {"run_ts": job.run_ts})
    with scratch_removed(spark):
        opened = raw_files(spark, raw, multi_line) if isinstance(raw, str) else raw
        bronze_to_silver(job, opened, canonical_region)
        silver_to_gold(job)
        quality(job, regions)
        job.counters.sort()
        job.measures.sort(key=lambda m: m[:2])
        write_table(spark.createDataFrame(job.counters, METRICS), f"{job.out}/metrics")
        write_table(spark.createDataFrame(job.measures, MEASURED), f"{job.out}/mesures")
    remove_folder(spark, f"{job.out}/work")
    publish(spark, out_dir)
    job.out = out_dir.rstrip("/")
    return job
