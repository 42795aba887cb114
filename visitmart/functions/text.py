"""Text rules of the source dialect, as Spark ``Column`` expressions.

Everything here is a built-in expression, so it stays inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Fixed value: the longest input the source's QUOTENAME accepts.
QUOTENAME_LIMIT = 128


def quote_name(x: ColumnOrName, quote: str = '"', max_len: int | None = None) -> Column:
    """F1 ``QUOTENAME(x, '"')``: wrap in quotes, double inner quotes. NULL stays NULL.

    Any length is quoted whole. With ``max_len`` (the source function's rule is
    ``QUOTENAME_LIMIT``) longer input gives NULL; that drops data, so it has to
    be asked for.
    """
    c = _c(x)
    quoted = F.concat(F.lit(quote), F.replace(c, F.lit(quote), F.lit(quote * 2)), F.lit(quote))
    return quoted if max_len is None else F.when(F.length(c) <= max_len, quoted)


def comma_to_space(x: ColumnOrName) -> Column:
    """F3 ``REPLACE(x, ',', ' ')``, used to keep CSV fields whole."""
    return F.replace(_c(x), F.lit(","), F.lit(" "))


def null_safe_concat(*parts: ColumnOrName | str) -> Column:
    """F7 ``CONCAT(a, '; ', b)``: a NULL part counts as the empty string."""
    cols = [F.coalesce(p, F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat(*cols)


def fold(x: ColumnOrName) -> Column:
    """F8/F9 comparison key: case-insensitive, trailing blanks ignored.

    Leading blanks stay significant, as in the source collation.
    """
    return F.lower(F.rtrim(_c(x)))


def fold_literal(value: str) -> str:
    return value.rstrip(" ").lower()


# Spark's string collation with the source's rules: any case, trailing blanks ignored.
COLLATION = "UTF8_LCASE_RTRIM"


def group_ci(df: DataFrame, keys: Iterable[str], *aggs: Column) -> DataFrame:
    """A8 ``GROUP BY`` under the source collation: text keys are grouped as collated
    strings, so spellings that differ in case or trailing blanks are one group.

    The source shows any spelling; here it is the group's least row of text keys
    by bytes, so a spelling always comes from one input row and reruns agree. NULL
    is a group of its own, apart from blank text.
    """
    keys = list(keys)
    texts = [k for k in keys if isinstance(df.schema[k].dataType, StringType)]
    by = [F.collate(F.col(f"`{k}`"), COLLATION).alias(f"_key{i}") if k in texts else F.col(f"`{k}`") for i, k in enumerate(keys)]
    shown = [F.min(F.struct(*(F.col(f"`{k}`") for k in texts))).alias("_shown")] if texts else []
    aggs = [*shown, *aggs]
    out = df.groupBy(*by).agg(*aggs) if aggs else df.select(*by).distinct()
    return out.select(*(F.col(f"_shown.`{k}`").alias(k) if k in texts else F.col(f"`{k}`") for k in keys),
                      *(F.col(f"`{c}`") for c in out.columns[len(keys) + len(shown):]))


def distinct_ci(df: DataFrame) -> DataFrame:
    """A9, O6 ``DISTINCT`` under the source collation; see ``group_ci``."""
    return group_ci(df, df.columns)


def eq_ci(x: ColumnOrName, value: str) -> Column:
    """Case-insensitive, trailing-blank-insensitive equality with a literal."""
    return fold(x) == F.lit(fold_literal(value))


def contains_ci(x: ColumnOrName, word: str) -> Column:
    """P10 ``x LIKE '%word%'`` under a case-insensitive collation.

    NULL input gives NULL, which filters and ``when`` treat as false.
    """
    return F.lower(_c(x)).contains(word.lower())


def startswith_ci(x: ColumnOrName, prefix: str) -> Column:
    """P11 ``x LIKE 'prefix%'`` (case-insensitive)."""
    return F.lower(_c(x)).startswith(prefix.lower())


def in_ci(x: ColumnOrName, values: Iterable[str]) -> Column:
    """P6 ``x IN (...)`` under the source collation (case and trailing blanks
    ignored, leading blanks kept)."""
    return fold(x).isin([fold_literal(v) for v in values])


def not_in_ci(x: ColumnOrName, values: Iterable[str]) -> Column:
    """P7 ``x NOT IN (...)``: NULL input is dropped, as in SQL.

    A list entry with a leading blank does not match the unblanked code,
    the same as the source (`' Flush'` never excludes `'Flush'`).
    """
    vals = [fold_literal(v) for v in values]
    c = fold(x)
    return ~c.isin(vals) if vals else c.isNotNull()


def non_blank(x: ColumnOrName) -> Column:
    """F9 ``x IS NOT NULL AND x <> ' '``: present and not only blanks."""
    c = _c(x)
    return c.isNotNull() & (F.rtrim(c) != F.lit(""))


def name_lfm(last: ColumnOrName, first: ColumnOrName, middle: ColumnOrName | None = None) -> Column:
    """U1 "LAST, FIRST M" display name built from name parts (upper case)."""
    base = F.concat(F.upper(F.trim(_c(last))), F.lit(", "), F.upper(F.trim(_c(first))))
    if middle is None:
        return base
    m = F.upper(F.trim(_c(middle)))
    return F.when(m.isNull() | (m == ""), base).otherwise(F.concat(base, F.lit(" "), m))
