"""Classification of free text and display formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnOrName, as_column

# Keyword -> label, first match wins.
PRIORITY_KEYWORDS = (
    ("critical", "alta"),
    ("urgent", "alta"),
    ("error", "media"),
    ("fail", "media"),
    ("issue", "media"),
)
PRIORITY_DEFAULT = "baja"

CONDITION_KEYWORDS = (
    ("rain", "lluvia"),
    ("cloud", "nublado"),
    ("sun", "soleado"),
    ("clear", "despejado"),
    ("fog", "niebla"),
    ("storm", "tormenta"),
    ("snow", "nieve"),
)
CONDITION_DEFAULT = "otro"


def classify_text(col: ColumnOrName, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first keyword found in the lower-cased text; ``default`` for no match or NULL."""
    lowered = F.lower(as_column(col))
    chain = F
    for keyword, label in rules:
        chain = chain.when(lowered.contains(keyword), F.lit(label))
    return chain.otherwise(F.lit(default))


def fmt_decimals(col: ColumnOrName, digits: int) -> Column:
    """Fixed number of decimals, half-up, no thousands separator; NULL stays NULL."""
    return F.round(as_column(col).cast("decimal(38,6)"), digits).cast("string")


def fmt_thousands(col: ColumnOrName) -> Column:
    """Whole number with ``,`` between thousands."""
    return F.format_number(F.round(as_column(col).cast("decimal(38,6)"), 0), 0)


def fmt_date(col: ColumnOrName, pattern: str = "dd/MM/yyyy") -> Column:
    return F.date_format(as_column(col), pattern)


def join_text(*cols: ColumnOrName) -> Column:
    """Concatenation in which NULL counts as empty text."""
    return F.concat_ws("", *[as_column(c).cast("string") for c in cols])
