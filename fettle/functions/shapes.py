"""Shape tests and conversions between text and typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fettle.functions.nulls import strip

# The date layouts that are recognised (shape only, no calendar check).
DATE_LAYOUTS = (
    r"^\d{4}-\d{2}-\d{2}$",
    r"^\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}$",
    r"^\d{4}/\d{2}/\d{2}$",
    r"^\d{1,2}/\d{1,2}/\d{4}$",
)

# Characters ignored when testing for a number.
NUMBER_NOISE = ",$ "

# What counts as a number; narrower than a cast, which also takes forms such as 1d.
NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
INTEGER_PATTERN = r"^[+-]?\d+$"
BOOLEAN_WORDS = ("True", "TRUE", "true", "False", "FALSE", "false")


def date_shape(c: Column) -> Column:
    """True when trimmed text has one of the date layouts."""
    return strip(c).rlike("|".join(DATE_LAYOUTS))


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain number gives null."""
    text = strip(c)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def numeric_shape(c: Column) -> Column:
    """True when text is a number once thousands commas, dollar signs and blanks are dropped."""
    return to_number(F.translate(c, NUMBER_NOISE, "")).isNotNull()


def exact_sum(number: Column) -> Column:
    """Sum of doubles in one aggregate: in decimals where they hold the value, else as doubles.

    The decimal part does not depend on the order of addition; nothing is cut or left out.
    """
    exact = number.try_cast("decimal(38,6)")
    fits = F.coalesce(exact.cast("double") == number, F.lit(False))
    zero = F.lit(0.0)
    # Values of up to 28 digits before the point: a decimal sum holds ten thousand million of them.
    fits = fits & (F.abs(number) < 1e22)
    return F.coalesce(F.sum(F.when(fits, exact)).cast("double"), zero) + F.coalesce(F.sum(F.when(~fits, number)), zero)


def float_text(c: Column) -> Column:
    """Shortest decimal text of a double: plain from 1e-4 up to 1e16, else with an exponent.

    The digits are those of the JVM; before version 19 it prints a few numbers above 1e20
    with one digit more than needed.
    """
    raw = c.cast("string")
    size = F.abs(c)
    plain = F.rtrim(c.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(raw, "E", 1), r"\.0$", "")
    power = F.substring_index(raw, "E", -1).try_cast("int")
    sign = F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+"))
    digits = F.abs(power).cast("string")
    digits = F.when(F.char_length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
    # The largest plain value needs 17 integer digits, within the 18 this decimal holds.
    return (
        F.when(F.isnan(c), F.lit("nan"))
        .when(size == float("inf"), F.when(c > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(~raw.contains("E"), raw)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.concat(mantissa, sign, digits))
    )


def stable_text(c: Column, dtype: T.DataType) -> Column:
    """Any typed value as stable text; null gives the empty string."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        midnight = c == F.date_trunc("day", c)
        day = F.date_format(c, "yyyy-MM-dd")
        second = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        micro = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        text = (
            F.when(midnight, day)
            .when(c == F.date_trunc("second", c), second)
            .otherwise(micro)
        )
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = float_text(c.cast("double"))
    elif isinstance(dtype, T.BooleanType):
        text = F.initcap(c.cast("string"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))
