"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.session import ship_package

#: Sort value of a NULL doc_id: it stands after every real id.
NULL_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus; the executors get this package before the first job on one."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_id(col: str | Column) -> Column:
    """A doc_id that compares with every other one; NULL stands last."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("bigint"), F.lit(NULL_ID))


def original_id(col: str | Column) -> Column:
    """The doc_id that :func:`order_id` stands for."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c != F.lit(NULL_ID), c)


def labelled_sample(labels: DataFrame, label: str, per_class: int, where: Column | None = None) -> DataFrame:
    """At most ``per_class`` rows (doc_id, y) of each class 0 and 1: those with the
    smallest hashes of their id, so a rerun takes the same. Ids with two different
    labels, NULL ids and NULL labels take no part."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    if where is not None:
        rows = rows.where(where)
    one = rows.groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("_y2")).where("y = _y2").select("doc_id", "y")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return one.where("y = 1").orderBy(*order).limit(per_class).union(one.where("y = 0").orderBy(*order).limit(per_class))
