"""Column-expression helpers. All return built-in JVM expressions (codegen'd).

No Python UDF anywhere: each helper is a composition of ``pyspark.sql.functions``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Java regex for "only ASCII letters, whole string". \A and \z
# are used instead of ^ and $ because Java's $ also matches before a final
# line terminator (\r, \u0085,  ), which Python's re.search("^...$") would not.
ASCII_WORD_PATTERN = r"\A[a-zA-Z]+\z"
# Unicode white space at either end (Python str.strip() semantics).
EDGE_WHITESPACE_PATTERN = r"(?U)^\s+|\s+$"


def as_column(e: str | Column) -> Column:
    """Accept a SQL expression string or a Column (reference APIs accept both)."""
    return F.expr(e) if isinstance(e, str) else e


def is_true(pred: str | Column) -> Column:
    """Predicate that treats NULL as false (rows a DELETE/UPDATE must leave alone)."""
    return F.coalesce(as_column(pred), F.lit(False))


def strip_unicode(c: str | Column) -> Column:
    """Remove all Unicode white space at both ends; ``F.trim`` only strips blanks."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, EDGE_WHITESPACE_PATTERN, "")


def is_ascii_word(c: str | Column) -> Column:
    """True when the value is one or more ASCII letters and nothing else."""
    return (F.col(c) if isinstance(c, str) else c).rlike(ASCII_WORD_PATTERN)


def safe_cast(c: str | Column, to: str | DataType, via_double: bool = False) -> Column:
    """Cast that yields NULL on malformed input under ANSI mode.

    ``via_double=True`` keeps the pre-ANSI result for decimal text cast to an
    integral type ('12.7' -> 12) instead of NULL.
    """
    col = F.col(c) if isinstance(c, str) else c
    if via_double:
        col = col.try_cast("double")
    return col.try_cast(to)


def normalized_name(name: str) -> str:
    """Column-name rule: lower case, blanks become underscores (driver-side, schema only)."""
    return name.lower().replace(" ", "_")
