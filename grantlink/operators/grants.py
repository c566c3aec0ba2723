"""Grant facts of persons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_dates(projects: DataFrame) -> DataFrame:
    """Lenient dates; the extended end, where there is one, is the end."""
    date = lambda c: F.try_to_date(F.col(c).cast("string"))
    return projects.withColumn("end_date", F.coalesce(date("extended_end"), date("end_date"))).withColumn("start_date", date("start_date")).drop("extended_end")


def person_grants(grants: DataFrame) -> DataFrame:
    """Per person of rows (person_id, project_id, start_date, end_date, category, funder, status): first start, last end,
    timeline, counts of categories and funders (most frequent first, then by name), and whether any grant is active."""
    entry = F.when(F.col("start_date").isNotNull(), F.struct("start_date", "end_date", "project_id"))
    facts = grants.groupBy("person_id").agg(
        F.min("start_date").alias("earliest_start_date"), F.max("end_date").alias("latest_end_date"), F.array_sort(F.collect_list(entry)).alias("project_timeline"),
        F.bool_or(F.col("status") == "Active").alias("has_active_project"), F.count_distinct("project_id").alias("number_grants"),
    )

    def counted(column: str, name: str) -> DataFrame:
        each = grants.where(F.col(column).isNotNull()).groupBy("person_id", column).agg(F.count(F.lit(1)).alias("n"))
        ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(column).alias("v"), "n")))
        return each.groupBy("person_id").agg(F.transform(ordered, lambda x: F.struct(x["v"].alias("value"), x["n"].alias("n"))).alias(name))

    out = facts.join(counted("category", "grant_categories"), "person_id", "left").join(counted("funder", "lead_funders"), "person_id", "left")
    return out.withColumn("has_multiple_funders", F.coalesce(F.size("lead_funders") > 1, F.lit(False)))


#: Columns of a matched person, in their fixed order.
PERSON_COLUMNS = (
    "person_id", "first_name", "surname", "organisation", "organisation_name", "earliest_start_date", "latest_end_date", "has_active_project", "number_grants", "has_multiple_funders", "grant_categories",
    "lead_funders", "project_timeline", "project_id", "project_publications", "project_topics", "project_authors", "project_oa_ids",
)


def with_summaries(persons: DataFrame, summaries: DataFrame) -> DataFrame:
    """Persons with their grant facts, in PERSON_COLUMNS; columns that ``persons`` lacks are left out. Grants are counted
    by the person's own project ids; a person without summary stays and has one funder at most."""
    facts = summaries.drop("number_grants")
    out = persons.join(facts, "person_id", "left").withColumn("has_multiple_funders", F.coalesce("has_multiple_funders", F.lit(False)))
    out = out.withColumn("number_grants", F.when(F.exists("project_id", lambda x: x.isNotNull()), F.size("project_id")).otherwise(0))
    return out.select([c for c in PERSON_COLUMNS if c in out.columns])


def matched_person_grants(persons: DataFrame, projects: DataFrame, matched: DataFrame) -> DataFrame:
    """Grant facts of the persons (person_id, project_id[], ...) among the matches (gtr_id, ...). ``projects``: project_id,
    start_date, end_date, extended_end, category, funder, status; one row of each id counts, and unknown ids stay."""
    own = persons.join(matched.select(F.col("gtr_id").alias("person_id")).distinct(), "person_id", "left_semi")
    each = own.select("person_id", F.explode("project_id").alias("project_id"))
    joined = each.join(clean_dates(projects.dropDuplicates(["project_id"])), "project_id", "left")
    return with_summaries(own, person_grants(joined))
