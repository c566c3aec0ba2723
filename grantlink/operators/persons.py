"""Grant persons with all that their projects say about them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, StructField, StructType

from ..functions.expressions import clean_doi


def counted_runs(kind: DataType) -> Callable[[Column], Column]:
    """Of sorted arrays of ``kind``: array<struct<author_id, n>>, each run of equal values with its length. A batch of rows
    is counted at once."""

    @F.arrow_udf(ArrayType(StructType([StructField("author_id", kind), StructField("n", LongType())])))
    def count(lists: pa.Array) -> pa.Array:
        row, flat = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0))), lists.flatten()
        code = np.asarray(flat.dictionary_encode(null_encoding="encode").indices)
        first = np.flatnonzero(np.r_[np.ones(min(1, len(flat)), bool), (code[1:] != code[:-1]) | (row[1:] != row[:-1])])
        runs = pa.StructArray.from_arrays([flat.take(pa.array(first)), pa.array(np.diff(np.r_[first, len(flat)]))], ["author_id", "n"])
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(row[first], minlength=len(lists)))].astype(np.int32)), runs)

    return count


def project_authors(outputs: DataFrame, works: DataFrame, distinct_papers: bool = False) -> DataFrame:
    """Per project the works that its outputs (project_id, doi) are, and its authors with their number of authorship
    rows (with ``distinct_papers``: of papers). A null DOI matches nothing. Works bring their authors as one array of ids,
    and a project's are counted in its row, so no row per project and author is shuffled."""
    unique = works.where("doi is not null").groupBy("doi").agg(F.min(F.struct("id", "authorships")).alias("w")).select("doi", "w.id", "w.authorships")
    kind = unique.select("authorships.author_id").schema[0].dataType
    unique = unique.select("doi", "id", F.coalesce("authorships.author_id", F.array().cast(kind)).alias("authors"))
    linked = outputs.select("project_id", clean_doi(F.col("doi")).alias("doi")).where("doi is not null").join(unique, "doi").select("project_id", "id", "authors")
    all_ = linked.groupBy("project_id").agg(F.array_sort(F.collect_list("id")).alias("project_oa_ids"), F.flatten(F.collect_list("authors")).alias("authors"))
    if distinct_papers:
        papers = linked.repartition("project_id").groupBy("project_id", "id").agg(F.array_distinct(F.flatten(F.collect_list("authors"))).alias("authors"), F.count(F.lit(1)).alias("n"))
        all_ = papers.groupBy("project_id").agg(F.array_sort(F.flatten(F.collect_list(F.array_repeat("id", F.col("n").cast("int"))))).alias("project_oa_ids"), F.flatten(F.collect_list("authors")).alias("authors"))
    counted = F.when(F.size("authors") > 0, counted_runs(kind.elementType)(F.sort_array("authors")))
    return all_.select("project_id", "project_oa_ids", counted.alias("project_authors"))


def aggregate_persons(persons: DataFrame, projects: DataFrame, topics: DataFrame, authors: DataFrame, organisations: DataFrame) -> DataFrame:
    """A row per person: scalars, project ids, union of publications, topics with repeats, summed author counts.

    persons (person_id, orcid_gtr, first_name, surname, project_id[], organisation), projects (project_id,
    project_publications[]), topics (project_id, topics[]), authors (project_id, project_authors[], project_oa_ids[]),
    organisations (id, name). A person without a known project stays, with empty lists.
    """
    each = persons.select("person_id", F.explode_outer("project_id").alias("project_id"))
    joined = each.join(projects.select("project_id", "project_publications"), "project_id", "left").join(topics, "project_id", "left").join(authors, "project_id", "left")
    lists = joined.groupBy("person_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("project_publications")))).alias("project_publications"), F.flatten(F.collect_list("topics")).alias("project_topics"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("project_oa_ids")))).alias("project_oa_ids"),
    )
    summed = joined.select("person_id", F.explode("project_authors").alias("a")).groupBy("person_id", "a.author_id").agg(F.sum("a.n").alias("n"))
    summed = summed.groupBy("person_id").agg(F.array_sort(F.collect_list(F.struct("author_id", "n"))).alias("project_authors"))
    names = organisations.select(F.col("id").alias("organisation"), F.col("name").alias("organisation_name"))
    return persons.join(lists, "person_id", "left").join(summed, "person_id", "left").join(names, "organisation", "left")
