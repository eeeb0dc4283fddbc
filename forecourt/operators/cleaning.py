"""Ordered cleaning rules.

Every row is charged to the first rule it breaks, which is what removing rows rule by rule does, but
the whole list is decided by one expression in one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.config import LOW_VALUE_COLUMNS, Scope


@dataclass(frozen=True)
class Rule:
    """`removes` and `keeps` are SQL conditions; an unknown `removes` keeps the row."""

    label: str
    reason: str
    removes: str
    keeps: str | None = None

    def filter(self) -> str:
        """The rule as a filter in a shape that a Parquet scan can take over."""
        return self.keeps or f"(({self.removes}) IS NULL OR NOT ({self.removes}))"


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def missing_rule(label: str, reason: str, column: str) -> Rule:
    return Rule(label, reason, f"{column} IS NULL", f"{column} IS NOT NULL")


def missing_rules() -> list[Rule]:
    return [
        missing_rule("price missing", "nothing to learn from or to check against", "price_in_euro"),
        missing_rule("year missing", "the age cannot be derived", "year"),
        missing_rule("power missing", "a main driver of the price, not to be guessed", "power_ps"),
        missing_rule("mileage missing", "a main driver of the price, not to be guessed", "mileage_in_km"),
    ]


def fuel_rule(scope: Scope) -> Rule:
    # A missing fuel is not in the list either, so unknown counts as invalid here.
    valid = f"fuel_type IN ({', '.join(map(text, scope.fuels))})"
    return Rule("fuel not valid", "fields of the row are shifted or corrupt", f"NOT coalesce({valid}, false)", valid)


def transmission_rule(scope: Scope) -> Rule:
    return Rule("transmission unknown", "says nothing as a category",
                f"transmission_type = {text(scope.unknown_transmission)}")


def year_rule(scope: Scope) -> Rule:
    return Rule(f"year below {scope.year_min}", "classic cars follow another market", f"year < {scope.year_min}")


def price_rules(scope: Scope) -> list[Rule]:
    return [
        Rule(f"price below {scope.price_min:.0f}", "scrap value", f"price_in_euro < {scope.price_min}D"),
        Rule(f"price above {scope.price_max:.0f}", "luxury and collector market", f"price_in_euro > {scope.price_max}D"),
    ]


def power_rule(scope: Scope) -> Rule:
    return Rule(f"power outside {scope.power_min:.0f} to {scope.power_max:.0f}", "entry errors and exotics",
                f"power_ps < {scope.power_min}D OR power_ps > {scope.power_max}D",
                f"power_ps IS NULL OR (power_ps >= {scope.power_min}D AND power_ps <= {scope.power_max}D)")


def mileage_rules(scope: Scope) -> list[Rule]:
    return [
        Rule(f"mileage above {scope.mileage_max:.0f}", "odometer errors", f"mileage_in_km > {scope.mileage_max}D"),
        Rule(f"mileage equal to {scope.mileage_excluded:.0f}", "new cars are priced by list price",
             f"mileage_in_km = {scope.mileage_excluded}D"),
    ]


def default_rules(scope: Scope) -> list[Rule]:
    """The twelve rules in the order in which they are applied."""
    return [
        *missing_rules(),
        fuel_rule(scope),
        transmission_rule(scope),
        year_rule(scope),
        *price_rules(scope),
        power_rule(scope),
        *mileage_rules(scope),
    ]


def first_broken(rules: list[Rule]) -> Column:
    """Number of the first rule a row breaks, from 1; NULL for a clean row."""
    return F.expr("CASE " + " ".join(f"WHEN {r.removes} THEN {i}" for i, r in enumerate(rules, start=1)) + " END")


def bound(df: DataFrame, columns) -> DataFrame:
    """The table with some columns worked out once per row, for what follows to see as values.

    The optimiser copies the expression of a computed column into every rule, filter and join condition that names the
    column. Twelve rules over a few such columns make one generated method that is too large for the JVM to compile,
    and each row is interpreted. A generator of one row stops the copies. Columns that a scan reads as they are should
    not be bound: filters on them would no longer reach the files.
    """
    if not columns:
        return df
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in columns])))).select(df.columns)


def remove(df: DataFrame, *rules: Rule) -> DataFrame:
    """Rows that break none of the rules; a condition that is unknown removes nothing."""
    return df.filter(" AND ".join(f"({r.filter()})" for r in rules))


def cleaning_audit(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule with the rows it removed and the rows left after it.

    The counts of all rules are plain aggregates over one scan, so each task sends a single row to the
    shuffle however many rows a rule removes.
    """
    steps = range(1, len(rules) + 1)
    # A table without rows still aggregates to one row of zeros.
    counts = df.select(first_broken(rules).alias("broken")).agg(
        F.count(F.lit(1)).alias("raw_rows"), *[F.expr(f"count_if(broken = {i}) AS removed_{i}") for i in steps])
    left, lines = "raw_rows", []
    for i, rule in zip(steps, rules):
        left += f" - removed_{i}"
        lines.append(
            f"named_struct('step', {i}, 'label', {text(rule.label)}, 'reason', {text(rule.reason)}, "
            f"'removed', removed_{i}, 'remaining', {left}, "
            f"'kept_pct', try_divide(({left}) * 100.0D, raw_rows))")
    return counts.selectExpr(f"inline(array({', '.join(lines)}))")


def clean_step(df: DataFrame, rule: Rule) -> DataFrame:
    """Audit row of a single rule applied to all rows: what it removes and what remains."""
    return cleaning_audit(df, [rule]).drop("step")


def drop_columns(df: DataFrame, columns=LOW_VALUE_COLUMNS) -> DataFrame:
    """Without the named columns; names that are not there are ignored."""
    return df.drop(*columns)


def clean_listings(df: DataFrame, rules: list[Rule], drop=LOW_VALUE_COLUMNS) -> DataFrame:
    """The rows that survive all rules, without the low-value columns."""
    return drop_columns(remove(df, *rules), drop)
