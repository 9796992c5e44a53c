"""Silver clean-up, union, keyed upsert and schema enforcement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The Silver clean-up rules (column -> rule).
SILVER_RULES = {
    "restaurant_name": "trim",
    "city_zone": "trim_upper",
    "delivery_status": "trim_lower",
}

_RULES = {
    "trim": lambda c: F.trim(c),
    "trim_upper": lambda c: F.upper(F.trim(c)),
    "trim_lower": lambda c: F.lower(F.trim(c)),
}


class SchemaMismatch(ValueError):
    """An append carries columns or types the table does not declare."""


AMBIGUOUS_MERGE = "AMBIGUOUS_MERGE: several source rows match one target row"


class MergeConflict(ValueError):
    """Several source rows match one target row."""


def standardise(df: DataFrame, rules: Mapping[str, str] = SILVER_RULES) -> DataFrame:
    """One projection applying a column -> rule mapping (spaces-only trim)."""
    present = {c: _RULES[r](F.col(c)) for c, r in rules.items() if c in df.columns}
    return df.withColumns(present)


def union_by_name(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Union by column name; ``extra`` is taken as it is (not re-standardised)."""
    return base.unionByName(extra)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE ALL WHEN NOT MATCHED INSERT ALL.

    One full outer join on the key, so target and source are each read once: matched
    target rows take the source's values, other source rows are inserted, other target
    rows stay.  Null keys never match: such rows of the source are inserted, of the
    target kept.  Duplicates of an unmatched key are all inserted; several source rows
    for a key that the target has stop the query with ``AMBIGUOUS_MERGE`` (C6a), in
    the filter, so that no column pruning can lose the check.
    """
    keys, columns = list(keys), target.columns
    # rows with a null key are spread by their values, so that they do not meet in one task
    spread = F.when(_all_not_null(keys), F.lit(0)).otherwise(F.pmod(F.xxhash64(*columns), F.lit(1 << 20))).cast("int")
    keyed = source.select(*columns, spread.alias("_spread"))
    counted = keyed.select("*", F.count(F.lit(1)).over(Window.partitionBy(*keys, "_spread")).alias("_n"))
    new = counted.select(*[F.col(c).alias(f"_new_{c}") for c in columns], F.col("_spread").alias("_new_spread"), "_n", F.lit(True).alias("_new"))
    old = target.select("*", spread.alias("_spread"), F.lit(True).alias("_old"))
    joined = old.join(new, [*[old[k] == new[f"_new_{k}"] for k in keys], old["_spread"] == new["_new_spread"]], "full_outer")
    clash = F.col("_old") & F.col("_new") & (F.col("_n") > 1)
    single = F.when(clash, F.raise_error(F.lit(AMBIGUOUS_MERGE)).cast("boolean")).otherwise(F.lit(True))
    return joined.where(single).select(*[F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns])


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def merge_conflicts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one source row that also match a target row.

    Partial aggregation before the shuffle keeps a hot key to one row per map
    task; the semi-join then only carries the (small) duplicate key set.
    """
    dup = (source.where(_all_not_null(keys)).groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("n_source_rows"))
           .where(F.col("n_source_rows") > 1))
    return dup.join(target.select(*keys), list(keys), "left_semi")


def check_merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise ``MergeConflict`` when the MERGE cardinality rule is broken."""
    bad = merge_conflicts(target, source, keys).limit(5).collect()
    if bad:
        raise MergeConflict(f"{len(bad)}+ target rows are matched by several source rows: "
                            f"{[tuple(r) for r in bad]}")


def merge_actions(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows a MERGE would update, insert, and leave unchanged.

    Both sides are counted per key (partial aggregation first) and meet in one full
    outer join; null keys never match.
    """
    keys = list(keys)
    old = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_old"))
    new = source.groupBy(*[F.col(k).alias(f"_new_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("n_new"))
    met = old.join(new, [old[k] == new[f"_new_{k}"] for k in keys], "full_outer")
    total = lambda when, n: F.coalesce(F.sum(F.when(when, F.col(n))), F.lit(0))
    no_old, no_new = F.col("n_old").isNull(), F.col("n_new").isNull()
    sums = met.agg(total(~no_old & ~no_new, "n_new").alias("u"), total(no_old, "n_new").alias("i"), total(no_new, "n_old").alias("k"))
    rows = F.array(*[F.struct(F.lit(name).alias("action"), F.col(c).alias("n_rows")) for name, c in (("update", "u"), ("insert", "i"), ("unchanged", "k"))])
    return sums.select(F.explode(rows).alias("r")).select("r.*").where("n_rows > 0")


def schema_issues(df_schema: T.StructType, table_schema: T.StructType) -> list[tuple[str, str]]:
    """(column, issue) pairs that stop ``df`` from being appended to the table."""
    declared = {f.name.lower(): f for f in table_schema.fields}
    issues = []
    for f in df_schema.fields:
        want = declared.get(f.name.lower())
        if want is None:
            issues.append((f.name, "undeclared column"))
        elif want.dataType != f.dataType and not _widens(f.dataType, want.dataType):
            issues.append((f.name, f"type {f.dataType.simpleString()} is not "
                                   f"{want.dataType.simpleString()}"))
    have = {f.name.lower() for f in df_schema.fields}
    for f in table_schema.fields:
        if f.name.lower() not in have and not f.nullable:
            issues.append((f.name, "missing non-nullable column"))
    return issues


def _widens(src: T.DataType, dst: T.DataType) -> bool:
    order = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    if src in order and dst in order:
        return order.index(src) <= order.index(dst)
    return isinstance(dst, T.DoubleType) and isinstance(src, (T.FloatType, T.IntegerType,
                                                              T.ShortType, T.ByteType))


def conform_to_schema(df: DataFrame, table_schema: T.StructType) -> DataFrame:
    """Refuse undeclared/retyped columns; fill missing nullable ones with null."""
    issues = schema_issues(df.schema, table_schema)
    if issues:
        raise SchemaMismatch("A schema mismatch detected when writing to the table: "
                             + "; ".join(f"{c}: {i}" for c, i in issues))
    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in table_schema.fields:
        src = have.get(f.name.lower())
        cols.append((F.col(src) if src else F.lit(None)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def sort_by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Range-partitioned global sort."""
    return df.orderBy(*keys)
