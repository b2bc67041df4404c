"""Cleaning of the four entities: raw text columns in, typed tables out.

Each function is pure: it takes the raw table with its row order columns and
returns the clean table and the rejected or altered rows by reason. Reading and
writing stay outside. Steps run only for the columns that exist.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions.dates import DAY_FIRST, iso_text, to_date_coerce
from limpid.functions.names import columns_with, snake_columns
from limpid.functions.numbers import to_count, to_number, to_year
from limpid.functions.text import region_name, squish
from limpid.operators.dedup import keep_first
from limpid.operators.integrity import split_marked
from limpid.operators.missing import THRESHOLD, GapFacts, amount, gap_facts, handle_missing
from limpid.operators.profile import one_row_per
from limpid.operators.union import tagged_union
from limpid.sources.roworder import ROW_ORDER, drop_row_order

SCHOOL_KEY = "code_etablissement"
COUNTS = ("nb_garcons", "nb_filles")
# Status by worksheet; a permanent post wins over a contract.
STATUS_OF_TAB = {"Titulaires": "titulaire", "Contractuels": "contractuel"}
STATUS_RANK = {"titulaire": 1, "contractuel": 2}
UNREAD = "_dates_illisibles"

Cut = Callable[[DataFrame, str], DataFrame]


def _no_cut(df: DataFrame, name: str) -> DataFrame:
    return df


# How a run cuts the lineage of the budgets; entities are cleaned each in its own context.
BUDGETS_CUT: ContextVar[Cut] = ContextVar("budgets_cut", default=_no_cut)


@dataclass(frozen=True)
class CleanResult:
    """``rejects`` are rows by reason; ``measures`` is (metric, value), if any.

    ``gaps`` tells of the column ``gap_column`` before its gaps were handled. ``checked`` is
    ``clean`` with ``UNREAD``, the number of cells of a row that hold text but no date.
    """

    clean: DataFrame
    rejects: dict[str, DataFrame] = field(default_factory=dict)
    measures: DataFrame | None = None
    strategy: str | None = None
    gap_column: str | None = None
    gaps: GapFacts | None = None
    checked: DataFrame | None = None


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def _each(df: DataFrame, columns: Sequence[str], change: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({c: change(F.col(c)) for c in _present(df, columns)})


def _with_dates(df: DataFrame, columns: Sequence[str], change: Callable[[Column], Column]) -> DataFrame:
    """Dates in place of text, and ``UNREAD``."""
    # In a column of its own a cell is read once, for its date and for the count.
    read = {c: f"_read_{c}" for c in _present(df, columns)}
    tried = df.withColumns({name: change(F.col(c)) for c, name in read.items()})
    unread = [(F.col(c).isNotNull() & F.col(name).isNull()).cast("int") for c, name in read.items()]
    dates = {**{c: F.col(name) for c, name in read.items()}, UNREAD: sum(unread, F.lit(0))}
    return tried.withColumns(dates).drop(*read.values())


def _plain(frames: dict[str, DataFrame | None]) -> dict[str, DataFrame]:
    return {r: drop_row_order(df).drop(UNREAD) for r, df in frames.items() if df is not None}


def clean_etablissements(
    df: DataFrame, order_by: Sequence[str] = ROW_ORDER, canonical_region: bool = False
) -> CleanResult:
    """Schools: first row per code, stripped places, day-first dates.

    ``canonical_region`` also maps region spellings to the five names, so that
    they meet the budget table's.
    """
    named = snake_columns(df)
    kept, removed = named, None
    if SCHOOL_KEY in named.columns:
        kept, removed = keep_first(named, [SCHOOL_KEY], order_by)
    tidy = _each(kept, ["region", "prefecture"], squish)
    if canonical_region:
        tidy = _each(tidy, ["region"], region_name)
    dated = drop_row_order(
        _with_dates(tidy, ["date_creation"], lambda c: to_date_coerce(c, DAY_FIRST))
    )
    return CleanResult(dated.drop(UNREAD), _plain({"doublons": removed}), checked=dated)


def clean_effectifs(
    df: DataFrame,
    dim: DataFrame | None = None,
    threshold: float = THRESHOLD,
    strategy: str = "auto",
    run_ts: str | None = None,
    cut: Cut = _no_cut,
) -> CleanResult:
    """Enrolment: numbers from text, known schools only, gaps in ``nb_filles`` handled.

    One join marks the known schools; ``cut`` may write the marked rows to a table and read
    them back, as several jobs read them (rate, medians, output, orphans).
    """
    numbers = _each(
        drop_row_order(snake_columns(df, fold=False)), COUNTS, lambda c: to_number(c, grouped=True)
    )
    has_gaps = "nb_filles" in numbers.columns
    linked, orphans = split_marked(
        numbers, dim, SCHOOL_KEY, lambda df: cut(df, "effectifs") if has_gaps else df
    )
    rejects: dict[str, DataFrame | None] = {"sans_etablissement": orphans}
    facts = None
    if has_gaps:
        # A strategy that is given needs no rate, and no job while planning.
        facts = gap_facts(linked, "nb_filles") if strategy == "auto" else None
        linked, audit, strategy = handle_missing(
            linked, "nb_filles", SCHOOL_KEY, threshold, strategy, run_ts, facts
        )
        rejects["supprimes" if strategy == "delete" else "imputes"] = audit
    column = "nb_filles" if facts else None
    clean = _each(linked, COUNTS, to_count)
    return CleanResult(clean, _plain(rejects), strategy=strategy, gap_column=column, gaps=facts)


def clean_enseignants(
    tabs: dict[str, DataFrame],
    dim: DataFrame | None = None,
    order_by: Sequence[str] = ROW_ORDER,
    cut: Cut = _no_cut,
) -> CleanResult:
    """Teachers: both tabs stacked, ISO dates, known schools only, one row per person.

    ``tabs`` maps a status to its rows. Orphans go first, so a contract row stays
    when the permanent row points to an unknown school. One join marks the known schools;
    ``cut`` may write the marked rows, which kept, orphans and duplicates then share.
    """
    stacked = snake_columns(tagged_union(tabs, "statut"))
    dated = _with_dates(stacked, columns_with(stacked, "date"), lambda c: iso_text(to_date_coerce(c)))
    kept, orphans = split_marked(dated, dim, SCHOOL_KEY, lambda df: cut(df, "enseignants"))
    removed = None
    if "matricule" in kept.columns:
        ranks = F.create_map(*[F.lit(x) for pair in STATUS_RANK.items() for x in pair])
        kept, removed = keep_first(kept, ["matricule"], order_by, ranks[F.col("statut")])
    kept = drop_row_order(kept)
    rejects = _plain({"sans_etablissement": orphans, "doublons": removed})
    return CleanResult(kept.drop(UNREAD), rejects, checked=kept)


def clean_budgets(df: DataFrame, cut: Cut | None = None) -> CleanResult:
    """Budgets: canonical regions, whole years, unknown amounts counted and set to 0.

    ``cut`` (``BUDGETS_CUT`` if not given) may write the rows with their amounts read; output
    and counts then share them.
    """
    cut = cut or BUDGETS_CUT.get()
    named = drop_row_order(snake_columns(df))
    tidy = _each(_each(named, ["region"], region_name), ["annee"], to_year)
    amounts = columns_with(tidy, "budget")
    tidy = cut(_each(tidy, amounts, amount), "budgets")
    counted = {f"mises_a_zero_{c}": [F.count_if(F.col(c).isNull())] for c in amounts}
    if "region" in tidy.columns:
        counted["regions_distinctes"] = [F.count_distinct("region")]
    measures = one_row_per(counted, tidy, ["value"]) if counted else None
    return CleanResult(
        _each(tidy, amounts, lambda c: F.coalesce(c, F.lit(0.0))),
        measures=measures and measures.withColumnRenamed("label", "metric"),
    )
