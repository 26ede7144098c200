"""Text-to-type rules of a bulk load, as column expressions.

Raw JSON values are read as text and converted here, because Spark's JSON reader
turns a quoted integer or ``15.0`` read as an integer into NULL without a word,
and rounds decimals where a bulk load cuts them off. Every rule gives NULL for
an empty or unusable value; ``operators.audit.coercion_losses`` counts the latter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Digits of the largest bigint.
_BIGINT_DIGITS = 19
_MOST_MILLIS = (2**63 - 1) // 1000


def _exact(value: Column, integer_digits: int) -> Column:
    """A decimal with as many fractional digits as Spark has left: rounding is far away."""
    return _given(value).try_cast(T.DecimalType(38, 38 - integer_digits))


def _given(value: Column) -> Column:
    # A failing conversion costs an exception; empty text is too common for that.
    return F.nullif(value.cast("string"), F.lit(""))


def integer(value: Column) -> Column:
    """``"39"`` and ``39.0`` -> 39, ``""`` and what has a fraction -> NULL."""
    exact = _exact(value, _BIGINT_DIGITS)
    whole = F.when(exact == F.floor(exact), exact.try_cast("int"))
    return F.coalesce(_given(value).try_cast("int"), whole)


def bigint(value: Column) -> Column:
    """Integers that the source may write with a fraction: ``1540919166796.0``.

    Goes through a decimal, so that all 19 digits of a bigint stay exact.
    """
    return _exact(value, _BIGINT_DIGITS).try_cast("bigint")


def truncated_decimal(value: Column, precision: int, scale: int) -> Column:
    """Cut to ``scale`` digits toward zero, then fit into decimal(precision, scale)."""
    exact = _exact(value, precision - scale)
    cut = F.when(exact >= 0, F.floor(exact, scale)).otherwise(F.ceil(exact, scale))
    return cut.try_cast(T.DecimalType(precision, scale))


def epoch_millis(value: Column) -> Column:
    """Epoch milliseconds -> UTC wall clock, whatever the session time zone is."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    millis = bigint(value)
    # Further ones have more microseconds than a bigint.
    millis = F.when(millis.between(-_MOST_MILLIS, _MOST_MILLIS), millis)
    return F.timestamp_add("MILLISECOND", millis, epoch)


def coerce_to(value: Column, target: T.DataType) -> Column:
    """The rule for a declared column type."""
    if isinstance(target, T.IntegerType):
        return integer(value)
    if isinstance(target, T.LongType):
        return bigint(value)
    if isinstance(target, T.DecimalType):
        return truncated_decimal(value, target.precision, target.scale)
    if isinstance(target, T.TimestampNTZType):
        return epoch_millis(value)
    if isinstance(target, T.StringType):
        return value.cast("string")
    raise TypeError(f"no load rule for {target.simpleString()}")
