"""Column expressions shared by ETL, SQL queries, jobs and marts.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category id -> label; any other id (or none) is "Other".
CATEGORY_LABELS = {1: "Trousers", 2: "Skirts", 3: "Blouses", 4: "Sale"}
OTHER_CATEGORY = "Other"

# A number as the reference's text-to-number coercion accepts it: optional sign,
# digits with optional fraction, or a bare fraction, optional exponent, or inf.
NUMERIC_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c) -> Column:
    """Two-decimal rounding as ``round(x * 100) / 100``.

    Spark's ``round(x, 2)`` rounds the shortest decimal text of a double, other
    engines round its binary value; scaling first gives one answer everywhere.
    """
    return F.round(_col(c) * F.lit(100)) / F.lit(100)


def to_double(c) -> Column:
    """Text or number -> double; anything that is not a number becomes null.

    ``try_cast`` alone would accept suffixes such as ``5d`` and the word ``nan``,
    so text is checked against ``NUMERIC_TEXT`` first.
    """
    c = _col(c)
    s = c.cast("string")
    return F.when(s.rlike(NUMERIC_TEXT), F.trim(s).try_cast("double"))


NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def as_double(df, name: str) -> Column:
    """Column ``name`` of ``df`` as double: a plain cast for numeric columns,
    the checked text conversion (``to_double``) otherwise."""
    t = dict(df.dtypes)[name]
    if t in NUMERIC_TYPES or t.startswith("decimal"):
        return F.col(name).cast("double")
    return to_double(name)


def category_label(category_id) -> Column:
    """Numeric category id -> label.  Looks up the *double* value, so 1.0 is a
    label and 1.5 is not (casting to int first would wrongly truncate).
    Text ids must be converted first (``to_double`` / ``as_double``)."""
    m = F.create_map(*chain.from_iterable(
        (F.lit(float(k)), F.lit(v)) for k, v in CATEGORY_LABELS.items()))
    return F.coalesce(F.try_element_at(m, _col(category_id).cast("double")), F.lit(OTHER_CATEGORY))


def category_label_sql(category_id: str) -> str:
    """``category_label`` as SQL text over the SQL expression ``category_id``."""
    pairs = ", ".join(f"CAST({k} AS DOUBLE), '{v}'" for k, v in CATEGORY_LABELS.items())
    return (f"coalesce(try_element_at(map({pairs}), CAST({category_id} AS DOUBLE)), "
            f"'{OTHER_CATEGORY}')")


def first_truthy(df, names, default: str) -> Column:
    """``str(a or b or default)`` over the columns of ``df`` that exist: null and
    empty text fall through, and so does zero in a numeric column."""
    types = dict(df.dtypes)
    parts = []
    for n in names:
        if n not in types:
            continue
        c = F.col(n)
        if types[n] in NUMERIC_TYPES or types[n].startswith("decimal"):
            parts.append(F.when(c != 0, c.cast("string")))
        else:
            s = c.cast("string")
            parts.append(F.when(s != "", s))
    return F.coalesce(*parts, F.lit(default))
