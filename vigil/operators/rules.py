"""Row rules and their evaluation.

A `Rule` is a name plus a function from the input DataFrame to a boolean
Column. Rules are evaluated as plain column expressions in the scan stage:
the wide form adds one boolean per rule, the long form (one row per row and
rule) is a `stack` generator in the same stage, so evaluating N rows x R
rules never shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.nulls import guarded, present


@dataclass(frozen=True)
class Rule:
    name: str
    check: Callable[[DataFrame], Column]

    def column(self, df: DataFrame) -> Column:
        # A check result is never NULL.
        return F.coalesce(self.check(df), F.lit(False))


def non_negative(name: str, column: str) -> Rule:
    return Rule(name, lambda df: guarded(df, column, F.col(column) >= 0))


def at_most(name: str, column: str, limit: float) -> Rule:
    return Rule(name, lambda df: guarded(df, column, F.col(column) <= F.lit(limit)))


def positive(name: str, column: str) -> Rule:
    return Rule(name, lambda df: guarded(df, column, F.col(column) > 0))


def one_of(name: str, column: str, values) -> Rule:
    return Rule(name, lambda df: guarded(df, column, F.col(column).isin(list(values))))


def no_missing(name: str, columns: list[str] | None = None, exclude: tuple[str, ...] = ("transaction_id",)) -> Rule:
    """No null (and no NaN on float columns) in any of `columns` (default: all but `exclude`)."""

    def check(df: DataFrame) -> Column:
        cols = columns or [c for c in df.columns if c not in exclude]
        return reduce(lambda a, b: a & b, [present(df, c) for c in cols], F.lit(True))

    return Rule(name, check)


def not_blank(name: str, column: str) -> Rule:
    return Rule(name, lambda df: F.col(column).isNotNull() & (F.trim(F.col(column).cast("string")) != ""))


def parseable_date(name: str, column: str, fmt: str = "yyyy-MM-dd") -> Rule:
    return Rule(name, lambda df: F.try_to_timestamp(F.col(column), F.lit(fmt)).isNotNull())


# The five rule names and the amount limit of the checking system.
AMOUNT_LIMIT = 20000
DEFAULT_RULES = [
    non_negative("non_negative_amount", "amount"),
    non_negative("non_negative_time", "time_elapsed"),
    no_missing("no_null_values"),
    one_of("valid_class_label", "class", [0, 1]),
    at_most("reasonable_amount", "amount", AMOUNT_LIMIT),
]


def rule_names(rules=DEFAULT_RULES) -> list[str]:
    return [r.name for r in rules]


def evaluate_wide(df: DataFrame, rules=DEFAULT_RULES, keep: list[str] | None = None) -> DataFrame:
    """`keep` columns plus one non-null boolean column per rule (named after it)."""
    keep = keep if keep is not None else df.columns
    return df.select(*[F.col(c) for c in keep], *[r.column(df).alias(r.name) for r in rules])


def evaluate(df: DataFrame, rules=DEFAULT_RULES, id_col: str = "transaction_id",
             carry: list[str] | None = None) -> DataFrame:
    """Long form: (id, rule_name, rule_passed[, carry...]), one row per row x rule.

    Planned as a Generate inside the scan stage (no exchange). `carry` columns
    (e.g. the amount) ride along so failure reports need no join back.
    """
    carry = carry or []
    pairs = ", ".join(f"'{r.name}', `{r.name}`" for r in rules)
    wide = evaluate_wide(df, rules, keep=[id_col, *carry])
    return wide.select(
        F.col(id_col).alias("transaction_id"),
        *[F.col(c) for c in carry],
        F.expr(f"stack({len(rules)}, {pairs}) AS (rule_name, rule_passed)"),
    ).select("transaction_id", "rule_name", "rule_passed", *carry)


def failures(long_results: DataFrame) -> DataFrame:
    """Failed checks only."""
    return long_results.where(~F.col("rule_passed"))


def unique_key_rule(df: DataFrame, keys: str | list[str], name: str = "unique_id") -> DataFrame:
    """Adds boolean `name`: the key (of one or more columns) is whole and occurs exactly once.

    Only the keys that occur more than once are joined back, and rows with a
    NULL in the key don't join at all, so neither a hot key's count nor the
    NULL rows gather in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    repeated = (df.where(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("_key_n")).where(F.col("_key_n") > 1)
                  .select(*keys, F.lit(True).alias("_repeated")))
    checked = df.where(whole).join(repeated, keys, "left").select(*df.columns, F.col("_repeated").isNull().alias(name))
    return checked.unionByName(df.where(~whole).withColumn(name, F.lit(False)))


def results_table(df: DataFrame, rules=DEFAULT_RULES, id_col: str = "transaction_id") -> DataFrame:
    """Stored check results (id, transaction_id, rule_name, rule_passed).

    id = transaction_id * len(rules) + rule position: one unique key per
    (row, rule) without a numbering pass.
    """
    triples = ", ".join(f"'{r.name}', {i}, `{r.name}`" for i, r in enumerate(rules))
    wide = evaluate_wide(df, rules, keep=[id_col])
    return wide.select(
        F.col(id_col).cast("long").alias("transaction_id"),
        F.expr(f"stack({len(rules)}, {triples}) AS (rule_name, _pos, rule_passed)"),
    ).select((F.col("transaction_id") * len(rules) + F.col("_pos")).cast("long").alias("id"),
             "transaction_id", "rule_name", "rule_passed")
