"""Data-quality rules, suite run and gate (Q1-Q13).

Rule semantics: nulls are skipped by every rule except not-null; bounds are
inclusive; a rule passes when no row is unexpected (an empty table passes).
A whole suite evaluates the table once, in a two-level aggregation, never as a
pandas copy of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    kind: str            # not_null | unique | min | in_set | min_length
    column: str
    value: object = None

    @property
    def name(self) -> str:
        return {
            "not_null": "expect_column_values_to_not_be_null",
            "unique": "expect_column_values_to_be_unique",
            "min": "expect_column_values_to_be_between",
            "in_set": "expect_column_values_to_be_in_set",
            "min_length": "expect_column_value_lengths_to_be_between",
        }[self.kind]

    def unexpected(self) -> Column:
        """Predicate marking an unexpected row (row-level rules only)."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "min":
            return c.isNotNull() & ~(c >= F.lit(self.value))
        if self.kind == "in_set":
            return c.isNotNull() & ~c.isin(list(self.value))
        if self.kind == "min_length":
            return c.isNotNull() & (F.length(c) < F.lit(self.value))
        raise ValueError(f"{self.kind} is not a row-level rule")


# The two suites (7-rule notebook suite, 3-rule orchestrated suite).
SILVER_FULL = (
    Rule("not_null", "delivery_id"),
    Rule("not_null", "customer_id"),
    Rule("unique", "delivery_id"),
    Rule("min", "order_amount", 0.01),
    Rule("min", "delivery_minutes", 1),
    Rule("in_set", "city_zone", ("NORTH", "EAST", "WEST", "SOUTH")),
    Rule("in_set", "delivery_status", ("completed", "preparing", "out for delivery")),
)
SILVER_MIN = (
    Rule("not_null", "delivery_id"),
    Rule("min_length", "city_zone", 1),
    Rule("min", "order_amount", 0.0001),
)


class QualityGateFailed(Exception):
    """Raised when the data fails its quality suite; downstream stages must not run."""


def run_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Q8: all rules -> (rule_index, rule, column, element_count, unexpected_count, success), in one evaluation of ``df``.

    Uniqueness needs one group per key, so the rows are grouped by the keys of all
    unique columns and every group carries its counters of the row rules; a second
    aggregation sums them.  With several unique columns each row is repeated once per
    column (a slot number and that column's key); only slot 0 counts the row rules.
    Without unique columns the groups are left out.  Both steps combine before their
    shuffle, so a hot key (or many null keys) is one row per task.
    """
    keys = list(dict.fromkeys(r.column for r in rules if r.kind == "unique"))
    row_rules = [(i, r) for i, r in enumerate(rules) if r.kind != "unique"]
    narrow = df.select(*[r.unexpected().alias(f"_f{i}") for i, r in row_rules],
                       *[F.col(c).alias(f"_k{j}") for j, c in enumerate(keys)], F.lit(0).alias("_slot"))
    if len(keys) > 1:
        slots = F.explode(F.array(*[F.lit(j) for j in range(len(keys))]))
        narrow = narrow.withColumn("_slot", slots)
        narrow = narrow.withColumns({f"_k{j}": F.when(F.col("_slot") == j, F.col(f"_k{j}")) for j in range(len(keys))})
    first = F.col("_slot") == 0
    flags = {f"_u{i}": F.count_if(F.col(f"_f{i}") & first) for i, _ in row_rules}
    if keys:
        groups = narrow.groupBy("_slot", *[f"_k{j}" for j in range(len(keys))]) \
            .agg(F.count(F.lit(1)).alias("_n"), *[c.alias(name) for name, c in flags.items()])

        def total(n, cond=F.lit(True)):
            return F.coalesce(F.sum(F.when(cond, F.col(n))), F.lit(0).cast("bigint"))

        one = groups.agg(total("_n", first).alias("_n"), *[total(name).alias(name) for name in flags], *[
            total("_n", (F.col("_slot") == j) & F.col(f"_k{j}").isNotNull() & (F.col("_n") > 1)).alias(f"_d{j}") for j in range(len(keys))])
    else:
        one = narrow.agg(F.count(F.lit(1)).alias("_n"), *[c.alias(name) for name, c in flags.items()])
    found = [f"_d{keys.index(r.column)}" if r.kind == "unique" else f"_u{i}" for i, r in enumerate(rules)]
    rows = F.array(*[F.struct(F.lit(i).alias("rule_index"), F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
                              F.col("_n").alias("element_count"), F.col(found[i]).alias("unexpected_count")) for i, r in enumerate(rules)])
    return one.select(F.explode(rows).alias("r")).select("r.*").withColumn("success", F.col("unexpected_count") == 0)


def failed_rules(results: DataFrame) -> DataFrame:
    """Q9: one row: how many rules failed, their names in suite order, the detail text."""
    failed = results.where(~F.col("success"))
    names = F.transform(F.array_sort(F.collect_list(F.struct("rule_index", "rule"))),
                        lambda s: s["rule"])
    listed = F.concat(F.lit("["), F.array_join(F.transform(names, lambda x: F.concat(
        F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))
    return failed.agg(
        F.count(F.lit(1)).alias("n_failed"),
        names.alias("failed_rules"),
        F.concat(F.count(F.lit(1)).cast("string"), F.lit(" expectation(s) failed: "), listed)
        .alias("detail"))


def enforce(results: DataFrame) -> None:
    """Q10: raise ``QualityGateFailed`` unless every rule passed (one small action)."""
    row = failed_rules(results).collect()[0]
    if row["n_failed"]:
        raise QualityGateFailed(f"Quality Gate FAILED: {row['detail']}")


def corrupt_first_rows(df: DataFrame, key: str = "delivery_id") -> DataFrame:
    """Q12: the notebook's failing batch: in key order, row 1 loses its key,
    row 2 gets a negative amount, row 3 an unknown zone.

    The three keys are found with a distributed top-3 (``TakeOrderedAndProject``),
    so no window over a single partition is needed.
    """
    first = [r[0] for r in df.select(key).where(F.col(key).isNotNull())
             .orderBy(key).limit(3).collect()]
    first += [None] * (3 - len(first))
    k = F.col(key)
    return df.withColumns({
        "order_amount": F.when(k == F.lit(first[1]), F.lit(-10.0)).otherwise(F.col("order_amount")),
        "city_zone": F.when(k == F.lit(first[2]), F.lit("INVALID_ZONE")).otherwise(F.col("city_zone")),
    }).withColumn(key, F.when(k == F.lit(first[0]), F.lit(None).cast("string")).otherwise(k))
