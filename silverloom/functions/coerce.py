"""The rules by which loosely typed JSON values become ids, splits and labels.

The inputs are VARIANT columns. A missing field is a SQL NULL; a JSON null is a variant of type VOID.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def text_of(v: Column, default: str = "") -> Column:
    """Text of a value; missing and null give ``default``. Booleans read True/False, 1.0 keeps its point."""
    kind = _kind(v)
    s = _get(v, "$", "string")
    return (
        F.when(v.isNull() | (kind == "VOID"), F.lit(default))
        .when(kind == "BOOLEAN", F.initcap(s))
        .when(kind.rlike(r"^DECIMAL\(1?\d,0\)$"), F.concat(s, F.lit(".0")))
        .otherwise(s)
    )


def long_text(v: Column) -> Column:
    """The same for a field that is nearly always a string, and a long one: other kinds take the longer way."""
    return F.when(_kind(v) == "STRING", _get(v, "$", "string")).otherwise(text_of(v))


def is_falsy(v: Column) -> Column:
    """Missing, null, false, zero, the empty string, the empty list and the empty object."""
    kind = _kind(v)
    return (
        F.when(v.isNull() | (kind == "VOID"), True)
        .when(kind == "BOOLEAN", ~_get(v, "$", "boolean"))
        .when(kind.rlike(_NUMBER), _get(v, "$", "double") == 0)
        .when(kind == "STRING", _get(v, "$", "string") == "")
        .when(kind.startswith("ARRAY"), _get(v, "$[0]", "variant").isNull())
        .otherwise(kind == "OBJECT<>")
    )


def text_or_null(v: Column) -> Column:
    """Text of a value, NULL where the value is falsy: for ``coalesce`` chains."""
    return F.when(~is_falsy(v), text_of(v))


def bronze_label(v: Column) -> Column:
    """Lenient integer: falsy is 0, numbers are truncated, text must be an integer. NULL means unusable."""
    kind = _kind(v)
    number = _get(v, "$", "double")
    return (
        F.when(is_falsy(v), 0)
        .when(kind == "BOOLEAN", 1)
        .when(kind.rlike(_NUMBER) & number.between(_INT_MIN, _INT_MAX), number.cast("bigint").cast("int"))
        .when(kind == "STRING", _get(v, "$", "string").try_cast("int"))
    )


def silver_label(v: Column) -> Column:
    """Strict binary label: missing is 0, a value equal to 0 or 1 is kept. NULL means rejected."""
    kind = _kind(v)
    number = _get(v, "$", "double")
    return (
        F.when(v.isNull(), 0)
        .when(kind == "BOOLEAN", _get(v, "$", "boolean").cast("int"))
        .when(kind.rlike(_NUMBER) & number.isin(0.0, 1.0), number.cast("int"))
    )
