"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F, types as T

MILLION = 1_000_000
SECONDS_PER_HOUR = 3600


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: Column | str, denominator: Column | str, scale: float = 1.0) -> Column:
    """``numerator / denominator * scale``; 0 where the denominator is null or not positive."""
    top, bottom = as_col(numerator), as_col(denominator)
    quotient = top / bottom
    if scale != 1.0:
        quotient = quotient * F.lit(float(scale))
    return F.when(bottom > 0, quotient).otherwise(F.lit(0.0))


def ratio_zero_as_one(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator`` with a zero denominator read as 1."""
    bottom = as_col(denominator)
    return as_col(numerator) / F.when(bottom == 0, F.lit(1)).otherwise(bottom)


def per_head(numerator: Column | str, population: Column | str, heads: int) -> Column:
    """Count per ``heads`` people; null where the population is 0."""
    return F.try_divide(as_col(numerator), as_col(population)) * F.lit(float(heads))


def growth(current: Column, previous: Column, on_zero: str = "null") -> Column:
    """``current / previous - 1``.

    ``on_zero='null'`` gives null for a zero base, ``'inf'`` the IEEE result
    (signed infinity, NaN for 0/0).
    """
    if on_zero == "null":
        return F.try_divide(current, previous) - F.lit(1.0)
    if on_zero != "inf":
        raise ValueError(f"on_zero must be 'null' or 'inf', not {on_zero!r}")
    at_zero = (
        F.when(current > 0, F.lit(float("inf")))
        .when(current < 0, F.lit(float("-inf")))
        .when(current == 0, F.lit(float("nan")))
    )
    return F.when(previous == 0, at_zero).otherwise(F.try_divide(current, previous) - F.lit(1.0))


def hours_between(later: Column, earlier: Column) -> Column:
    """Fractional hours from ``earlier`` to ``later``."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(SECONDS_PER_HOUR * MILLION)


def epoch_ms(column: Column | str) -> Column:
    """Epoch milliseconds (number or numeric text) to a timestamp; bad text gives null."""
    return F.timestamp_millis(as_col(column).try_cast("bigint"))


def is_blank(column: Column | str) -> Column:
    """Null or empty text."""
    c = as_col(column)
    return c.isNull() | (c == "")


def is_filled(column: Column | str) -> Column:
    """Neither null nor empty text."""
    c = as_col(column)
    return c.isNotNull() & (c != "")


def any_negative(*columns: str) -> Column:
    """True if one of the columns is below zero (SQL three-valued OR)."""
    test = as_col(columns[0]) < 0
    for name in columns[1:]:
        test = test | (as_col(name) < 0)
    return test


def off_by_more_than(actual: Column, expected: Column, tolerance: Column) -> Column:
    """Relative tolerance test ``|actual - expected| > tolerance``."""
    return F.abs(actual - expected) > tolerance


def status(failed: Column) -> Column:
    """PASS / FAIL text of a check; a null test passes, as in SQL CASE."""
    return F.when(failed, F.lit("FAIL")).otherwise(F.lit("PASS"))


def grade(value: Column, bands: list[tuple[str, Column]], otherwise: str) -> Column:
    """First band whose test on ``value`` holds."""
    out = None
    for name, test in bands:
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out.otherwise(F.lit(otherwise))


def strip(column: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    space = r"[\s\p{Z}\x1c-\x1f\x85]+"
    return F.regexp_replace(as_col(column), rf"^{space}|{space}$", "")


def title_case(column: Column | str) -> Column:
    """Trim all white space, then upper-case the first letter after any non-letter.

    ``initcap`` alone only looks at white space ("Guinea-bissau"), so the text is
    cut into runs of cased letters and other characters first.
    """
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    pieces = F.regexp_extract_all(
        F.lower(strip(column)), F.lit(f"([{cased}]+|[^{cased}]+)"), F.lit(1)
    )
    return F.array_join(F.transform(pieces, lambda piece: F.initcap(piece)), "")


def mapped(column: Column | str, mapping: dict) -> Column:
    """Replace exact matches by ``mapping``, keep everything else."""
    c = as_col(column)
    if not mapping:
        return c
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), c)


def numbers(values) -> Column:
    """Array literal, parsed at once: a call per number would cost more than the query."""
    texts = (f"{v!r}D" if math.isfinite(v) else f"CAST('{v!r}' AS DOUBLE)" for v in map(float, values))
    return F.expr(f"array({', '.join(texts)})")


def task_group(groups: int) -> Column:
    """One of ``groups`` numbers, the same for all rows of a task.

    Grouping by it first merges bulky partial results (sketches) in several tasks.
    """
    return F.pmod(F.spark_partition_id(), F.lit(groups))


def is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def has_word(name: str, words: tuple[str, ...]) -> bool:
    return any(word in name.lower() for word in words)


def numeric_columns(schema: T.StructType, words: tuple[str, ...] | None = None) -> list[str]:
    """Numeric columns, optionally only those whose name holds one of ``words``."""
    return [
        f.name for f in schema.fields
        if is_number(f.dataType) and (words is None or has_word(f.name, words))
    ]


def string_columns(schema: T.StructType, words: tuple[str, ...] | None = None) -> list[str]:
    return [
        f.name for f in schema.fields
        if isinstance(f.dataType, T.StringType) and (words is None or has_word(f.name, words))
    ]


def is_missing(column: Column | str, kind: T.DataType) -> Column:
    """Null, or NaN for floating point columns (both count as missing)."""
    c = as_col(column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()
