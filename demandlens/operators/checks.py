"""Data checks as Spark jobs: not-null, uniqueness and references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.functions.util import as_list

_SCHEMA_COLS = ["table_name", "check_name", "columns", "failures"]


def check_not_null(df: DataFrame, cols, table: str) -> DataFrame:
    """One aggregate pass: NULL count per column."""
    cols = as_list(cols)
    counts = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.selectExpr(f"stack({len(cols)}, {stack}) as (columns, failures)").select(
        F.lit(table).alias("table_name"),
        F.lit("not_null").alias("check_name"),
        "columns",
        F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"),
    )


def check_unique(df: DataFrame, keys, table: str) -> DataFrame:
    """Rows beyond the first per key (0 when the key is unique)."""
    keys = as_list(keys)
    dup = df.groupBy(*keys).count().where(F.col("count") > 1)
    return dup.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit("unique").alias("check_name"),
        F.lit(",".join(keys)).alias("columns"),
        "failures",
    )


def check_table(df: DataFrame, table: str, not_null=(), unique=()) -> DataFrame:
    """Not-null counts per column and rows beyond the first per key, of one table in one scan.

    ``unique`` lists keys (a column or a list of columns each). The table is grouped by every
    key at once (grouping sets: one shuffle of narrow, map-side counted rows); NULL counts come
    from the first grouping set, or from a plain aggregate where there is no key."""
    not_null, unique = as_list(not_null), [as_list(k) for k in unique]
    if not unique:
        return check_not_null(df, not_null, table)
    keys = list(dict.fromkeys(c for k in unique for c in k))
    nulls = [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(f"_dl_null_{i}") for i, c in enumerate(not_null)]
    grouped = df.groupingSets([[F.col(c) for c in k] for k in unique], *[F.col(c) for c in keys]).agg(
        F.grouping_id().alias("_dl_set"), F.count(F.lit(1)).alias("_dl_n"), *nulls)
    number = {sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in k): j for j, k in enumerate(unique)}
    if len(number) < len(unique):
        raise ValueError("a key is given twice")
    sums = [F.sum(f"_dl_null_{i}").alias(f"_dl_null_{i}") for i in range(len(not_null))]
    totals = grouped.groupBy("_dl_set").agg(F.sum(F.col("_dl_n") - 1).alias("_dl_more"), *sums)  # one row a key
    of = {j: s for s, j in number.items()}

    def pick(column: str, j: int):
        return F.coalesce(F.max(F.when(F.col("_dl_set") == of[j], F.col(column))), F.lit(0)).cast("bigint")

    checks = [("not_null", c, pick(f"_dl_null_{i}", 0)) for i, c in enumerate(not_null)]
    checks += [("unique", ",".join(k), pick("_dl_more", j)) for j, k in enumerate(unique)]
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.lit(columns).alias("columns"), n.alias("failures")) for name, columns, n in checks])
    return totals.agg(rows.alias("_dl_rows")).select(F.lit(table).alias("table_name"), F.explode("_dl_rows").alias("_dl_row")).select(
        "table_name", "_dl_row.check_name", "_dl_row.columns", "_dl_row.failures")


def check_references(child: DataFrame, parent: DataFrame, key: str, table: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (anti-join)."""
    pk = parent.select(F.col(parent_key or key).alias(key)).distinct()
    orphans = child.where(F.col(key).isNotNull()).join(pk, key, "left_anti")
    return orphans.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit("references").alias("check_name"),
        F.lit(key).alias("columns"),
        "failures",
    )


def union_checks(results: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), results).select(*_SCHEMA_COLS)
