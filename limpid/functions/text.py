"""Text cleaning as native Spark expressions (no Python UDF)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# All Unicode blanks: tabs, line ends, NBSP, the wide and narrow spaces.
BLANKS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# Cell texts that a reader takes for "no value".
READER_NULLS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Texts standing for an unknown amount in budget cells.
BUDGET_SENTINELS = (
    "N/A",
    "n/a",
    "NA",
    "na",
    "en attente",
    "en_attente",
    "non communiqué",
    "non_communique",
    "non communique",
    "",
    " ",
)

# Spelling patterns of the five regions; the first that matches
# wins. The prefix is removed before matching.
REGION_PREFIX = r"^(r[ée]gion)\s+(de\s+)?"
REGION_PATTERNS = (
    (r"kara", "Kara"),
    (r"savanes?", "Savanes"),
    (r"centrale|centre", "Centrale"),
    (r"maritime", "Maritime"),
    (r"plateaux?", "Plateaux"),
)
REGIONS = ("Savanes", "Kara", "Centrale", "Plateaux", "Maritime")


def squish(col: Column) -> Column:
    """Strip blanks at both ends, Unicode blanks and tabs included."""
    return F.btrim(col, F.lit(BLANKS))


def nullify_tokens(col: Column, tokens: Sequence[str], strip: bool = False) -> Column:
    """NULL where the cell is one of ``tokens``; ``strip`` ignores outer blanks."""
    probe = squish(col) if strip else col
    return F.when(~probe.isin(*tokens), col)


def title_case(col: Column) -> Column:
    """Capital after every non-letter: ``saint-pierre`` gives ``Saint-Pierre``.

    ``initcap`` only starts words at blanks, hence the split at letter starts.
    """
    pieces = F.split(F.lower(col), r"(?<=[^\p{L}])(?=\p{L})")
    capital = F.transform(
        pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2**31 - 1))
    )
    return F.array_join(capital, "")


def canonical(
    col: Column, prefix: str, patterns: Sequence[tuple[str, str]], fallback=title_case
) -> Column:
    """Canonical spelling: first pattern found anywhere, else ``fallback``.

    NULL stays NULL: no pattern matches it and the fallback keeps it.
    """

    def spelled(bare: Column) -> Column:
        (first, name), *others = patterns
        branches = F.when(bare.rlike(first), F.lit(name))
        for pattern, name in others:
            branches = branches.when(bare.rlike(pattern), F.lit(name))
        return branches.otherwise(fallback(bare))

    # A list of one names the cleaned text, which is then made once and not per branch.
    cleaned = F.regexp_replace(squish(F.lower(col)), f"(?U){prefix}", "")
    return F.get(F.transform(F.array(cleaned), spelled), 0)


def region_name(col: Column) -> Column:
    return canonical(col, REGION_PREFIX, REGION_PATTERNS)
