"""Text expressions with Postgres semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a maximal run of letters/digits; everything else is a separator run.
_WORD_OR_GAP = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def pg_initcap(col: Column | str) -> Column:
    """Postgres ``initcap``: lower-case everything, then upper-case the first
    character after any non-alphanumeric character (``o'brien-smith`` ->
    ``O'Brien-Smith``).  Spark's own ``initcap`` only splits on spaces.

    Built from JVM-side array functions, no UDF: split into word / gap runs,
    capitalise each run's first character, join back.
    """
    c = F.col(col) if isinstance(col, str) else col
    runs = F.regexp_extract_all(F.lower(c), F.lit(_WORD_OR_GAP), 1)
    capped = F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)))
    return F.array_join(capped, "")


def clean_text(col: Column | str) -> Column:
    """``trim`` (spaces only, like Postgres)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(c)


def clean_title(col: Column | str) -> Column:
    """``initcap(trim(x))``."""
    return pg_initcap(clean_text(col))


def clean_lower(col: Column | str) -> Column:
    """``lower(trim(x))``."""
    return F.lower(clean_text(col))
