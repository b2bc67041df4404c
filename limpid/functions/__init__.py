"""Column and name expressions: everything here stays inside the JVM."""

from limpid.functions.dates import cell_date, iso_text, to_date_coerce
from limpid.functions.names import columns_with, fold_accents, snake, snake_columns
from limpid.functions.numbers import (
    guarded_ratio,
    round_half_up,
    to_count,
    to_number,
    to_year,
)
from limpid.functions.text import (
    canonical,
    nullify_tokens,
    region_name,
    squish,
    title_case,
)

__all__ = [
    "cell_date",
    "canonical",
    "columns_with",
    "fold_accents",
    "guarded_ratio",
    "iso_text",
    "nullify_tokens",
    "region_name",
    "round_half_up",
    "snake",
    "snake_columns",
    "squish",
    "title_case",
    "to_count",
    "to_date_coerce",
    "to_number",
    "to_year",
]
