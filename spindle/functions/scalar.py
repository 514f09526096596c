"""Native column expressions for the scripts' small per-row rules.

Each rule is a Catalyst expression, so it stays in whole-stage codegen and
takes part in constant folding and null propagation; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default_if_null(c: str | Column, value) -> Column:
    """null -> constant, other values unchanged."""
    return F.coalesce(_col(c), F.lit(value))


def missing(c: str | Column, is_string: bool = True, is_float: bool = False) -> Column:
    """null, the empty string of strings and the NaN of floating-point
    columns count as missing (comparing a number with '' raises under ANSI
    mode, so the caller says which it is)."""
    c = _col(c)
    if is_float:
        return c.isNull() | F.isnan(c)
    return (c.isNull() | (c == F.lit(""))) if is_string else c.isNull()


def child_or_sex(sex: str | Column, age: str | Column, child_age: float = 15.0,
                 child_label: str = "Child") -> Column:
    """age < child_age -> 'Child', else sex; a null age gives null."""
    age = _col(age)
    return (F.when(age.isNull(), F.lit(None).cast("string"))
             .when(age < F.lit(child_age), F.lit(child_label))
             .otherwise(_col(sex)))


def sum_flag(a: str | Column, b: str | Column, above: float = 3) -> Column:
    """a + b > above -> 1.0 else 0.0; null in gives null out."""
    total = _col(a) + _col(b)
    return (F.when(total.isNull(), F.lit(None).cast("double"))
             .when(total > F.lit(above), F.lit(1.0))
             .otherwise(F.lit(0.0)))


def split_words(c: str | Column, sep: str = " ") -> Column:
    """Split on a literal separator and drop trailing empty strings, as a
    JVM ``String.split`` does (Spark's ``split`` keeps them)."""
    parts = F.split(_col(c), _regex_quote(sep))
    # position of the last non-empty element; slice keeps 1..that
    last = F.aggregate(
        F.transform(parts, lambda x, i: F.when(x != F.lit(""), i + 1).otherwise(0)),
        F.lit(0), lambda acc, x: F.greatest(acc, x))
    # "".split(sep) in the JVM gives [""]; every other all-empty split gives []
    return (F.when(_col(c) == F.lit(""), F.array(F.lit("")))
             .when(last == 0, F.array().cast("array<string>"))
             .otherwise(F.slice(parts, 1, last)))


def _regex_quote(s: str) -> str:
    special = set("\\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in s)


def relabel(c: str | Column, mapping: Mapping, name: str = "label") -> Column:
    """Strict value map (e.g. 2 -> 0.0, 4 -> 1.0).  A value outside the map,
    or null, fails the job with a message naming the value."""
    c = _col(c)
    expr = None
    for k, v in mapping.items():
        cond = c == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    msg = F.concat(F.lit(f"relabel {name}: unmapped value "),
                   F.coalesce(c.cast("string"), F.lit("NULL")))
    return expr.otherwise(F.raise_error(msg)).alias(name)
