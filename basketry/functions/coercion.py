"""Null tokens and numeric coercion. Bad input becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that a CSV reader of the pandas family treats as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Fixed value: the embedded-number pattern.
EMBEDDED_NUMBER = r"([-+]?\d*\.?\d+)"

# What counts as a whole-text number. try_cast alone would also take '1d' and '2f'.
_PLAIN_NUMBER = r"(?i)^[-+]?((\d+\.?\d*|\.\d+)(e[-+]?\d+)?|inf|infinity)$"


def null_tokens_to_null(df: DataFrame) -> DataFrame:
    """Null out every missing-value token in the string columns."""
    return df.select(
        *(
            F.when(~F.col(f.name).isin(*NULL_TOKENS), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and null are one notion here; Spark keeps them apart and sorts NaN above all."""
    return df.select(
        *(
            F.nanvl(F.col(f.name), F.lit(None)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def to_number(text: Column) -> Column:
    """The whole text as a double, else null."""
    trimmed = F.trim(text.cast("string"))
    return F.when(trimmed.rlike(_PLAIN_NUMBER), trimmed.try_cast("double"))


def extract_number(text: Column) -> Column:
    """The first embedded number as a double, else null: '1e5' gives 1.0."""
    found = F.regexp_extract(text.cast("string"), EMBEDDED_NUMBER, 1)
    return F.nullif(found, F.lit("")).try_cast("double")


def to_number_or_embedded(text: Column) -> Column:
    """The whole text as a number, falling back to the first embedded one."""
    return F.coalesce(to_number(text), extract_number(text))


def numeric_column(df: DataFrame, column: str, embedded: bool = False) -> Column:
    """``column`` as a double: a plain cast when typed, a coercion when text."""
    if is_numeric(df, column):
        return F.nanvl(F.col(column).cast("double"), F.lit(None))
    return to_number_or_embedded(F.col(column)) if embedded else to_number(F.col(column))


def malformed(value: Column, number: Column) -> Column:
    """Present, yet not a number."""
    return value.isNotNull() & number.isNull()


def python_float_text(x: Column) -> Column:
    """A double as Python prints it; Spark switches to exponents at other magnitudes."""
    plain = x.cast("string")  # decimal for 1e-3 <= |x| < 1e7, else d.dddE[-]n
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    mantissa = F.regexp_extract(plain, r"^-?(\d\.\d+)E", 1)
    exponent = F.regexp_extract(plain, r"E(-?\d+)$", 1).try_cast("int")
    digits = F.regexp_replace(F.regexp_replace(mantissa, r"\.0$", ""), r"\.", "")
    size = F.length(digits)
    whole = F.rpad(digits, exponent + 1, "0")
    large = F.concat(
        sign,
        F.substring(whole, F.lit(1), exponent + 1),
        F.lit("."),
        F.when(size > exponent + 1, F.substring(digits, exponent + 2, size)).otherwise(F.lit("0")),
    )
    small = F.concat(sign, F.lit("0.000"), digits)
    scientific = F.concat(
        sign,
        F.regexp_replace(mantissa, r"\.0$", ""),
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(exponent).cast("string"),
    )
    return (
        F.when(x == float("inf"), F.lit("inf"))
        .when(x == float("-inf"), F.lit("-inf"))
        .when(mantissa == "", plain)
        .when((exponent >= 0) & (exponent < 16), large)
        .when(exponent == -4, small)
        .otherwise(scientific)
    )
