"""One wide table per person and author, and what it promises: unique keys, and fixed columns in a fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .career import KEYS, basic_metrics, collaboration_country_years, counts_by_year, home_institution, publication_counts, unique_by
from ..sources.tables import kept
from .author_year import Collaborations

#: The columns of the metrics table, by theme, in their order.
COLUMNS = (
    "oa_id", "orcid", "display_name", "display_name_alternatives", "first_name", "surname", "gtr_person_id", "match_probability",
    "gtr_organisation", "gtr_organisation_name", "last_known_institutions", "last_known_institution_uk",
    "works_count", "cited_by_count", "citations_per_publication", "h_index", "i10_index", "first_work_year", "academic_age_at_first_grant", "topics", "affiliations", "counts_by_year", "counts_by_pubyear",
    "earliest_start_date", "latest_end_date", "has_active_project", "number_grants", "has_multiple_funders", "grant_categories", "lead_funders", "gtr_project_timeline",
    "gtr_project_id", "gtr_project_publications", "gtr_project_topics", "gtr_project_oa_authors", "gtr_project_oa_ids",
    "n_pubs_before", "n_pubs_after", "total_citations_pubyear_before", "total_citations_pubyear_after", "mean_citations_pubyear_before", "mean_citations_pubyear_after", "citations_pp_pubyear_before", "citations_pp_pubyear_after",
    "mean_citations_before", "mean_citations_after", "citations_pp_before", "citations_pp_after", "mean_fwci_before", "mean_fwci_after",
    "abroad_experience_before", "abroad_experience_after", "countries_before", "countries_after", "abroad_fraction_before", "abroad_fraction_after",
    "collab_countries_before", "collab_countries_after", "collab_countries_list_before", "collab_countries_list_after",
    "unique_collabs_before", "unique_collabs_after", "total_collabs_before", "total_collabs_after", "foreign_collab_fraction_before", "foreign_collab_fraction_after",
)
#: A person's columns under their names in that table.
NAMES = {
    "id": "oa_id", "person_id": "gtr_person_id", "organisation": "gtr_organisation", "organisation_name": "gtr_organisation_name", "project_timeline": "gtr_project_timeline", "project_id": "gtr_project_id",
    "project_publications": "gtr_project_publications", "project_topics": "gtr_project_topics", "project_authors": "gtr_project_oa_authors", "project_oa_ids": "gtr_project_oa_ids",
    "academic_age": "academic_age_at_first_grant", "last_institution_uk": "last_known_institution_uk",
}


def ordered(df: DataFrame, order: tuple[str, ...] = COLUMNS) -> DataFrame:
    """The columns of ``order`` that exist, in that order."""
    return df.select([c for c in order if c in df.columns])


def wide_table(basic: DataFrame, *parts: DataFrame, order: tuple[str, ...] | None = None, observation: Observation | None = None) -> DataFrame:
    """Left-joins ``parts`` on the keys that each shares with ``basic``; a part that repeats a key makes the job fail.

    With ``order`` the columns are those of it that exist. An ``observation`` gets the number of rows, and of rows that
    each part had something for, while the table is written: no job of its own.
    """
    out, marks = basic, []
    for n, p in enumerate(parts):
        keys = [k for k in KEYS if k in p.columns]
        own = unique_by(p.drop(*[c for c in p.columns if c in out.columns and c not in keys]), keys, f"part {n}")
        out, marks = out.join(own.withColumn(f"_part_{n}", F.lit(1)), keys, "left"), [*marks, f"_part_{n}"]
    if observation:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"), *[F.count(m).alias(f"rows{m}") for m in marks])
    out = out.drop(*marks)
    return ordered(out, order) if order else out


def metrics_table(authors: DataFrame, persons: DataFrame, years: DataFrame, collabs: Collaborations, home: str) -> DataFrame:
    """All basic metrics of matched authors, in the fixed columns: a row for each person and its author.

    ``authors``: profiles (id, gtr_id, last_known_institutions, counts_by_year[year, works_count, cited_by_count], ...);
    ``persons``: (person_id, earliest_start_date, ...); both are one to one, or the job fails. ``years`` and ``collabs``
    are of the authors' works. Columns that the inputs lack are left out; others of theirs pass through.
    """
    own = home_institution(authors.dropDuplicates(["id", "gtr_id"]), home).withColumnRenamed("gtr_id", "person_id")
    own = unique_by(own.withColumn("citations_per_publication", F.try_divide("cited_by_count", "works_count")), ["person_id"], "author")
    merged = own.join(unique_by(persons, ["person_id"], "person"), "person_id")
    refs = kept(merged.select("person_id", F.col("id").alias("author_id"), F.year("earliest_start_date").alias("ref_year")))
    out = basic_metrics(refs, years, collabs, home)
    series = authors.select(F.col("id").alias("author_id"), F.explode("counts_by_year").alias("c")).select("author_id", "c.year", F.col("c.works_count").alias("n_pubs"), F.col("c.cited_by_count").alias("cited_by"))
    counted = years.select("author_id", "year", "n_pubs", F.col("cited_by_count").alias("cited_by"))
    means = publication_counts(refs, counted, series.distinct()).select(*KEYS, "mean_citations_before", "mean_citations_after", "citations_pp_before", "citations_pp_after")
    places = collaboration_country_years(refs, collabs, home).groupBy(*KEYS)
    held = lambda side: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("period") == side, F.struct("country", "n_years"))))).alias(f"collab_countries_{side}")
    places = places.agg(held("before"), held("after"))
    by_year = counts_by_year(counted)
    out = out.join(means, [*KEYS], "left").join(places, [*KEYS], "left").join(by_year, "author_id", "left").drop("ref_year")
    return ordered(merged.withColumnRenamed("id", "author_id").join(out, [*KEYS]).withColumnRenamed("author_id", "id").withColumnsRenamed(NAMES))
