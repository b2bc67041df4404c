from __future__ import annotations

from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from limpid.functions import (
    iso_text,
    nullify_tokens,
    region_name,
    round_half_up,
    snake,
    snake_columns,
    squish,
    title_case,
    to_count,
    to_date_coerce,
    to_number,
    to_year,
)
from limpid.functions.dates import DAY_FIRST
from limpid.functions.text import BUDGET_SENTINELS, READER_NULLS

NBSP = "\u00a0"


def test_snake_folds_two_accents_only():
    assert snake("Code Établissement été àè") == "code_etablissement_ete_àe"
    assert snake("Préfecture", fold=False) == "préfecture"


def test_snake_columns_is_a_rename(spark):
    df = spark.createDataFrame([(1, 2)], "`Date création` int, `Région` int")
    assert snake_columns(df).columns == ["date_creation", "region"]


def test_squish_strips_all_blanks(values):
    cells = [f"{NBSP}\t a b \n", "", "x", None, " y\x1c"]
    assert values(cells, squish) == ["a b", "", "x", None, "y"]


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet=" \t\n\u00a0\u2003abc'é-", max_size=12), min_size=1, max_size=60))
def test_squish_and_title_case_agree_with_python(values, cells):
    assert values(cells, squish) == [c.strip() for c in cells]
    assert values(cells, title_case) == [c.title() for c in cells]


def test_title_case_starts_words_after_any_non_letter(values):
    cells = ["saint-pierre", "l'est", "3eme RUE", "", None, "élan"]
    assert values(cells, title_case) == ["Saint-Pierre", "L'Est", "3Eme Rue", "", None, "Élan"]


def test_region_names(values):
    cells = [
        "KARA",
        "Région de Kara",
        "region kara",
        "Savane",
        "Centre",
        "  Plateau ",
        f"{NBSP}MARITIME",
        "saint-pierre",
        "Région  des lacs",
        None,
    ]
    assert values(cells, region_name) == [
        "Kara",
        "Kara",
        "Kara",
        "Savanes",
        "Centrale",
        "Plateaux",
        "Maritime",
        "Saint-Pierre",
        "Des Lacs",
        None,
    ]


def test_first_region_pattern_wins(values):
    assert values(["savanes et kara", "maritime centre"], region_name) == ["Kara", "Centrale"]


def test_nullify_tokens_exact_or_stripped(values):
    cells = ["NA", " NA ", "ok", None, "<NA>"]
    assert values(cells, lambda c: nullify_tokens(c, READER_NULLS)) == [None, " NA ", "ok", None, None]
    stripped = values(cells, lambda c: nullify_tokens(c, READER_NULLS, strip=True))
    assert stripped == [None, None, "ok", None, None]
    sentinels = ["en attente", " non communiqué", "12", " "]
    assert values(sentinels, lambda c: nullify_tokens(c, BUDGET_SENTINELS, strip=True)) == [
        None,
        None,
        "12",
        None,
    ]


def test_to_number(values):
    cells = ["12", " 12 ", "1e3", "-.5", "5.", "12d", "12f", "nan", "inf", "N/A", "", None, "1 245", "1e999"]
    assert values(cells, to_number) == [
        12.0, 12.0, 1000.0, -0.5, 5.0, None, None, None, None, None, None, None, None, None,
    ]


def test_to_number_with_grouped_digits(values):
    cells = ["1 245", f"1{NBSP}245", "12 345", "1 2x"]
    assert values(cells, lambda c: to_number(c, grouped=True)) == [1245.0, 1245.0, 12345.0, None]


def test_to_count_rounds_half_to_even(values):
    cells = [0.5, 1.5, 2.5, -0.5, 2.4999, None]
    assert values(cells, to_count, "double") == [0, 2, 2, 0, 2, None]


def test_round_half_up(values):
    cells = [0.125, 2.5, -2.5, 1.005, None]
    assert values(cells, lambda c: round_half_up(c, 2), "double") == [0.13, 2.5, -2.5, 1.0, None]


def test_to_year(values):
    assert values(["2023", "2023.0", "2023.5", "en cours", None], to_year) == [
        2023,
        2023,
        None,
        None,
        None,
    ]


def test_day_first_dates(values):
    cells = ["05/03/2020", "5/3/2020", "31/02/2020", "2020-01-01", "05/03/20", "", None]
    march = date(2020, 3, 5)
    assert values(cells, lambda c: to_date_coerce(c, DAY_FIRST)) == [march, march] + [None] * 5


def test_free_dates(values):
    cells = ["43895", "43895.75", "2020-03-05", "2020-03-05 10:00:00", "5 mars", "0", None]
    march = date(2020, 3, 5)
    assert values(cells, to_date_coerce) == [march] * 4 + [None] * 3


def test_iso_text(values):
    assert values(["43895", None], lambda c: iso_text(to_date_coerce(c))) == ["2020-03-05", None]


def test_years_and_day_first_text_among_free_dates(values):
    cells = ["2020", "1905", "5/3/2020", "31/02/2020", "2019.5", "36526"]
    assert values(cells, to_date_coerce) == [
        date(2020, 1, 1), date(1905, 1, 1), date(2020, 3, 5), None, date(1905, 7, 11), date(2000, 1, 1),
    ]
