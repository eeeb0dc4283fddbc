"""Column expressions shared by batch and streaming plans. All stay inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt.config import Scope

# The texts a CSV reader takes for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Java would also read '1d' or '0x1p3' as a number, so the accepted spelling is stated here.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def null_if_token(c: Column) -> Column:
    """NULL where the text is one of the usual spellings of a missing value."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def to_number(c: Column) -> Column:
    """Text to double; whatever is not a number, NaN included, becomes NULL."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def holds(condition: Column) -> Column:
    """The condition with unknown read as false."""
    return F.coalesce(condition, F.lit(False))


def car_age(year: Column, reference_year: int) -> Column:
    return F.lit(float(reference_year)) - year


def mileage_per_year(mileage: Column, age: Column) -> Column:
    # greatest() skips NULL, so an unknown age has to be kept unknown by hand.
    return F.when(age.isNotNull(), mileage / F.greatest(age, F.lit(1.0)))


def price_segment(price: Column, threshold: Column) -> Column:
    """1 (HIGH) at or above the threshold, else 0 (LOW)."""
    return F.when(price >= threshold, F.lit(1)).otherwise(F.lit(0))


def outside_scope(price: Column, scope: Scope) -> Column:
    return (price < scope.price_min) | (price > scope.price_max)


def year_midpoint(first: Column, last: Column) -> Column:
    return F.floor((first + last) / F.lit(2)).cast("int")


def title_label(c: Column) -> Column:
    """Dashes to spaces, then a capital after every non-letter.

    initcap() only looks at blanks, so a marker and a blank are put behind each other non-letter and
    taken out again.
    """
    marked = F.regexp_replace(F.replace(c, F.lit("-"), F.lit(" ")), r"([^\p{L}])", "$1\u0001 ")
    return F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))


def whole(c: Column) -> Column:
    """Thousands separators, no decimals."""
    return F.format_number(c, 0)


def euro(c: Column) -> Column:
    return F.concat(F.lit("€"), whole(c))


def unit_hash(key: Column, purpose: str, seed: int) -> Column:
    """Hex digest that orders rows like a seeded shuffle, independently for each purpose."""
    return F.md5(F.concat(F.lit(f"{purpose}|{seed}|"), key))
