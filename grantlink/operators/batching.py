"""Ids to look up, in batches of 50 joined by a pipe."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import clean_doi, clean_name
from ..sources.tables import kept


def id_batches(ids: DataFrame, column: str, size: int = 50) -> DataFrame:
    """(batch, ids, n) of the distinct non-null ids in their order; only the last batch may be short. Ids are numbered
    inside ranges of about 100,000, and the counts of the ranges before are added, so no task numbers them all."""
    distinct = kept(ids.select(F.col(column).cast("string").alias("id")).where("id is not null and id <> ''").distinct())
    ranges = max(1, distinct.count() // 100_000)
    placed = kept(distinct.repartitionByRange(ranges, "id").select("id", F.spark_partition_id().alias("range")))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))  # a row per range
    sums = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("id")) - 1
    rows = placed.withColumn("inside", inside).join(F.broadcast(sums), "range")  # a row per range
    batch = F.floor((F.col("before") + F.col("inside")) / size).alias("batch")
    return rows.groupBy(batch).agg(F.array_join(F.array_sort(F.collect_list("id")), "|").alias("ids"), F.count(F.lit(1)).alias("n"))


def doi_batches(publications: DataFrame) -> DataFrame:
    return id_batches(publications.select(clean_doi(F.col("doi")).alias("doi")), "doi")


def orcid_batches(persons: DataFrame) -> DataFrame:
    return id_batches(persons, "orcid_id")


def name_batches(persons: DataFrame) -> DataFrame:
    return id_batches(persons.select(clean_name(F.concat_ws(" ", "first_name", "surname")).alias("name")), "name")


def institution_batches(authors: DataFrame) -> DataFrame:
    return id_batches(authors.select(F.explode("affiliations.id").alias("id")), "id")
