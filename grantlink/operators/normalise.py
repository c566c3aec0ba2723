"""Nested landed records to typed tables. A missing field is null and takes the default that each job names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import clean_doi, compact_id, epoch_date, level_id, link_date, link_tails, link_value, tail, topic_levels

LINKS = "links.link"


def organisations(raw: DataFrame) -> DataFrame:
    """The first main address as address_* columns, null if there is none."""
    main = F.get(F.filter("addresses.address", lambda a: a["type"] == "MAIN_ADDRESS"), F.lit(0))
    fields = ("id", "postCode", "region", "type")
    return raw.withColumn("_m", main).select(*[c for c in raw.columns if c not in ("addresses", "links")], *[F.col(f"_m.{f}").alias(f"address_{f}") for f in fields])


def funds(raw: DataFrame) -> DataFrame:
    return raw.select(*[c for c in raw.columns if c not in ("valuePounds", "links")], F.col("valuePounds.amount").alias("value"))


def publications(raw: DataFrame) -> DataFrame:
    return raw.select(
        link_value(F.col(LINKS), "PROJECT").alias("project_id"), F.col("id").alias("outcome_id"), "pubMedId", "isbn", "issn", "doi", "title", "chapterTitle", "type",
        epoch_date(F.col("datePublished")).alias("publication_date"), F.col("journalTitle").alias("journal_title"), F.col("publicationUrl").alias("publication_url"), "author",
    )


def projects(raw: DataFrame) -> DataFrame:
    links = F.col(LINKS)
    persons = F.transform(F.filter(links, lambda x: x["href"].contains("apipersons") | x["href"].contains("/persons/")), lambda x: F.struct(tail(x["href"]).alias("id"), x["rel"].alias("role")))
    unwrap = lambda c, *fields: F.transform(c, lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return raw.select(
        F.col("id").alias("project_id"), unwrap("identifiers.identifier", "value", "type").alias("identifiers"), "title", F.col("abstractText").alias("abstract_text"), F.col("techAbstractText").alias("tech_abstract_text"),
        F.col("potentialImpact").alias("potential_impact"), "status", F.col("grantCategory").alias("grant_category"), F.col("leadFunder").alias("lead_funder"), F.col("leadOrganisationDepartment").alias("lead_org_department"),
        unwrap("researchTopics.researchTopic", "text", "percentage").alias("research_topics"), unwrap("researchSubjects.researchSubject", "text", "percentage").alias("research_subjects"),
        link_tails(links, "PUBLICATION").alias("publications"), persons.alias("persons"), link_date(links, "FUND", "start").alias("start_date"), link_date(links, "FUND", "end").alias("end_date"), link_date(links, "FURTHER_FUNDING", "end").alias("extended_end"),
    )


def persons(raw: DataFrame) -> DataFrame:
    """Links to projects and organisations become arrays of (id, role)."""
    links = F.col(LINKS)
    to = lambda kind: F.transform(F.filter(links, lambda x: x["href"].contains(f"/{kind}/")), lambda x: F.struct(tail(x["href"]).alias("id"), x["rel"].alias("role")))
    return raw.select(F.col("id").alias("person_id"), F.col("orcidId").alias("orcid_id"), F.col("firstName").alias("first_name"), "surname", F.col("otherNames").alias("other_names"), "email", to("projects").alias("projects"), to("organisations").alias("organisations"))


def linkable_persons(people: DataFrame) -> DataFrame:
    """Project ids, and the first organisation's id (null if there is none)."""
    return people.select("person_id", F.col("orcid_id").alias("orcid_gtr"), "first_name", "surname", F.transform("projects", lambda p: p["id"]).alias("project_id"), F.get("organisations", F.lit(0))["id"].alias("organisation"))


def project_info(rows: DataFrame) -> DataFrame:
    return rows.select("project_id", F.col("publications").alias("project_publications"), "start_date", F.coalesce("extended_end", "end_date").alias("end_date"))


def authors(raw: DataFrame) -> DataFrame:
    """Author profiles with bare ids and flat arrays; counts default to 0, arrays to empty."""
    inst = lambda i: [tail(i["id"]).alias("id"), i["display_name"].alias("name"), i["country_code"].alias("country"), i["type"].alias("type")]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    level = lambda t, k: [tail(t[k]["id"]).alias(f"{k}_id"), t[k]["display_name"].alias(f"{k}_name")]
    topics = F.transform("topics", lambda t: F.struct(tail(t["id"]).alias("topic_id"), t["display_name"].alias("topic_name"), t["count"].alias("count"), *level(t, "subfield"), *level(t, "field"), *level(t, "domain")))
    return raw.select(
        tail(F.col("id")).alias("id"), tail(F.col("orcid")).alias("orcid"), "display_name", F.coalesce("display_name_alternatives", F.array().cast("array<string>")).alias("display_name_alternatives"),
        zero("works_count").alias("works_count"), zero("cited_by_count").alias("cited_by_count"), zero("summary_stats.h_index").alias("h_index"), zero("summary_stats.i10_index").alias("i10_index"),
        F.transform("affiliations", lambda a: F.struct(*inst(a["institution"]), a["years"].alias("years"))).alias("affiliations"),
        F.transform("last_known_institutions", lambda i: F.struct(*inst(i))).alias("last_known_institutions"), topics.alias("topics"), "counts_by_year",
        *[c for c in ("gtr_author_name", "name_match_score") if c in raw.columns],
    )


def works(raw: DataFrame) -> DataFrame:
    """One authorship entry per author and institution; '' stands for a missing institution and its country. Empty arrays
    become null."""
    entry = lambda a, i, c: F.struct(tail(a["author"]["id"]).alias("author_id"), i.alias("institution_id"), c.alias("country"), a["author_position"].alias("position"))
    none = F.lit("")
    each = lambda a: F.when(F.coalesce(F.size(a["institutions"]), F.lit(0)) > 0, F.transform(a["institutions"], lambda i: entry(a, F.coalesce(tail(i["id"]), none), F.coalesce(i["country_code"], none)))).otherwise(F.array(entry(a, none, none)))
    some = lambda c: F.when(F.size(c) > 0, c)
    level = lambda t, k: [tail(t[k]["id"]).alias(f"{k}_id"), t[k]["display_name"].alias(f"{k}_name")]
    topics = F.transform("topics", lambda t: F.struct(tail(t["id"]).alias("topic_id"), t["display_name"].alias("topic_name"), *level(t, "subfield"), *level(t, "field"), *level(t, "domain")))
    return raw.select(
        tail(F.col("id")).alias("id"), clean_doi(F.col("doi")).alias("doi"), "title", F.try_to_date("publication_date").alias("publication_date"), "fwci", F.coalesce("cited_by_count", F.lit(0)).alias("cited_by_count"),
        some(F.flatten(F.transform("authorships", each))).alias("authorships"), some(topics).alias("topics"), some(F.transform("referenced_works", lambda x: tail(x))).alias("referenced_works"),
        some(F.col("counts_by_year")).alias("counts_by_year"), tail(F.col("ids.pmid")).alias("pmid"), F.col("ids.mag").alias("mag_id"),
    )


def slim_works(rows: DataFrame, since: str = "1980-01-01") -> DataFrame:
    """What the metrics need of ``works``: one row per id, from a date on, with numeric topic ids."""
    topics = F.transform(F.coalesce("topics", F.array()), lambda t: F.struct(*[level_id(t[f"{k}_id"]).alias(k) for k in ("topic", "subfield", "field", "domain")]))
    kept = rows.where(F.col("publication_date") >= F.lit(since).cast("date")).dropDuplicates(["id"])
    people = F.transform(F.coalesce("authorships", F.array()), lambda a: F.struct(a["author_id"].alias("author_id"), a["country"].alias("country")))
    return kept.select("id", "publication_date", "fwci", "cited_by_count", people.alias("authorships"), topics.alias("topics"), F.coalesce("referenced_works", F.array().cast("array<string>")).alias("referenced_works"))


def citing_works(rows: DataFrame) -> DataFrame:
    """Whole-number ids; one row per id over all landed batches."""
    return rows.select(compact_id(F.col("id")).alias("id"), F.filter(F.transform(F.coalesce("referenced_works", F.array().cast("array<string>")), compact_id), lambda x: x.isNotNull()).alias("referenced_works")).dropDuplicates(["id"])


def institutions(raw: DataFrame) -> DataFrame:
    associated = F.transform("associated_institutions", lambda i: F.struct(tail(i["id"]).alias("id"), i["display_name"].alias("name"), i["country_code"].alias("country"), i["relationship"].alias("relationship")))
    return raw.select(tail(F.col("id")).alias("id"), associated.alias("associated_institutions"))


def project_topics(topics: DataFrame, taxonomy: DataFrame, confident: tuple[str, ...] = ("medium", "high", "very high")) -> DataFrame:
    """Per project the topic records of its confident labels."""
    rows = topics.where(F.col("zeroshot_favouring_confidence").isin(*confident)).join(taxonomy.select("taxonomy_label", "id_path"), "taxonomy_label", "left")
    rows = rows.select("project_id", topic_levels(F.col("taxonomy_label"), F.col("id_path")).alias("t")).where("t is not null")
    return rows.groupBy("project_id").agg(F.array_sort(F.collect_list("t")).alias("topics"))
