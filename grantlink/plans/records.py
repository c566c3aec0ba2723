"""Registered queries of nested records: what landed grants, persons, profiles and works look like once they are typed.

The given tables are first nested as the records are landed: orders are grants and outputs, customers persons, suppliers
authors, nations institutions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import batching, diversity, model, normalise, pairs
from .queries import ROUND6, query
from .views import HOME, Views

DAY_MS = 86_400_000


def _ms(date: str) -> Column:
    return F.unix_date(F.to_date(date)).cast("bigint") * DAY_MS


def _href(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"https://registry/{kind}/"), F.col(key).cast("string"))


def _link(href: Column, rel: str | Column, start: Column | None = None, end: Column | None = None) -> Column:
    none = F.lit(None).cast("bigint")
    return F.struct(href.alias("href"), (F.lit(rel) if isinstance(rel, str) else rel).alias("rel"), (none if start is None else start).alias("start"), (none if end is None else end).alias("end"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS outcome_id, p.project_id, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS publication_date
FROM orders LEFT JOIN (SELECT l_orderkey, max(CAST(l_suppkey AS VARCHAR)) AS project_id FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey) p ON l_orderkey = o_orderkey""")
def grant_outputs(x: Views) -> DataFrame:
    """Outputs with the largest id among their project links, and dates from milliseconds; some have none."""
    links = x.read("lineitem", "l_orderkey", "l_suppkey", "l_returnflag").groupBy("l_orderkey").agg(F.collect_list(_link(_href("projects", "l_suppkey"), F.when(F.col("l_returnflag") == "R", "OTHER").otherwise("PROJECT"))).alias("link"))
    rows = x.read("orders", "o_orderkey", "o_orderdate").join(links, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    empty = [F.lit(None).cast("string").alias(c) for c in ("pubMedId", "isbn", "issn", "doi", "title", "chapterTitle", "type", "journalTitle", "publicationUrl", "author")]
    raw = rows.select(F.col("o_orderkey").cast("string").alias("id"), F.when(F.col("o_orderkey") % 7 != 0, _ms("o_orderdate")).alias("datePublished"), F.struct("link").alias("links"), *empty)
    return normalise.publications(raw).select("outcome_id", "project_id", "publication_date")


@query("""WITH l AS (SELECT l_orderkey, count(*) AS n_publications FROM lineitem GROUP BY l_orderkey)
SELECT CAST(o_orderkey AS VARCHAR) AS project_id, o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS leader, coalesce(n_publications, 0) AS n_publications, CAST(o_orderdate AS DATE) AS start_date,
  CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 4 = 0 THEN 730 ELSE 365 END AS end_date FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""")
def grant_projects(x: Views) -> DataFrame:
    """Projects with their leader, outputs and dates; every fourth has further funding, whose end counts."""
    lines = x.read("lineitem", "l_orderkey", "l_linenumber").groupBy("l_orderkey").agg(F.collect_list(_link(_href("outcomes", "l_linenumber"), "PUBLICATION")).alias("outputs"))
    rows = x.read("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    fund, start = _href("funds", "o_orderkey"), _ms("o_orderdate")
    own = F.array(_link(_href("persons", "o_custkey"), "PI_PER"), _link(fund, "FUND", start, start + 365 * DAY_MS))
    more = F.when(F.col("o_orderkey") % 4 == 0, F.array(_link(fund, "FURTHER_FUNDING", start, start + 730 * DAY_MS))).otherwise(F.array())
    nothing = F.array().cast("array<struct<id:string,text:string,percentage:double>>")
    text = [F.lit(None).cast("string").alias(c) for c in ("title", "abstractText", "techAbstractText", "potentialImpact", "grantCategory", "leadFunder", "leadOrganisationDepartment")]
    raw = rows.select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"), *text, F.struct(F.array(F.struct(F.col("o_orderkey").cast("string").alias("value"), F.lit("REF").alias("type"))).alias("identifier")).alias("identifiers"),
        F.struct(nothing.alias("researchTopic")).alias("researchTopics"), F.struct(nothing.alias("researchSubject")).alias("researchSubjects"), F.struct(F.concat(own, more, F.coalesce("outputs", F.array())).alias("link")).alias("links"),
    )
    typed = normalise.projects(raw)
    facts = typed.select("project_id", "status", F.get("persons", F.lit(0))["id"].alias("leader"))
    dated = normalise.project_info(typed).select("project_id", F.size("project_publications").cast("bigint").alias("n_publications"), "start_date", "end_date")
    return facts.join(dated, "project_id")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS person_id, CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR) END AS organisation, coalesce(n, 0) AS n_projects, first_id
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, min(CAST(o_orderkey AS VARCHAR)) AS first_id FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey""")
def grant_persons(x: Views) -> DataFrame:
    """Persons with their projects and first organisation; who is in debt has none."""
    led = x.read("orders", "o_orderkey", "o_custkey").groupBy("o_custkey").agg(F.collect_list(_link(_href("projects", "o_orderkey"), "PI_PER")).alias("led"))
    rows = x.read("customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal").join(led, F.col("o_custkey") == F.col("c_custkey"), "left")
    at = F.when(F.col("c_acctbal") >= 0, F.array(_link(_href("organisations", "c_nationkey"), "EMPLOYED"))).otherwise(F.array())
    none = [F.lit(None).cast("string").alias(c) for c in ("orcidId", "surname", "otherNames", "email")]
    raw = rows.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("firstName"), *none, F.struct(F.concat(at, F.coalesce("led", F.array())).alias("link")).alias("links"))
    typed = normalise.linkable_persons(normalise.persons(raw))
    return typed.select("person_id", "organisation", F.size("project_id").cast("bigint").alias("n_projects"), F.array_min("project_id").alias("first_id"))


def _institutions(x: Views) -> DataFrame:
    """Nations, associated with the others of their region."""
    nations = x.read("nation", "n_nationkey", "n_name", "n_regionkey")
    other = nations.toDF("key", "name", "region")
    entry = F.struct(_href("institutions", "key").alias("id"), F.col("name").alias("display_name"), F.col("name").alias("country_code"), F.lit("related").alias("relationship"))
    rows = nations.join(other, (F.col("n_regionkey") == F.col("region")) & (F.col("n_nationkey") != F.col("key")), "left")
    raw = rows.groupBy(_href("institutions", "n_nationkey").alias("id")).agg(F.collect_list(F.when(F.col("key").isNotNull(), entry)).alias("associated_institutions"))
    return normalise.institutions(raw)


def _authors(x: Views) -> DataFrame:
    """Suppliers at their nation, every second one at the next nation, too."""
    nations = x.read("nation", "n_nationkey", "n_name")
    own = x.read("supplier", "s_suppkey", "s_name", "s_nationkey")
    places = own.select("s_suppkey", F.explode(F.when(F.col("s_suppkey") % 2 == 0, F.array("s_nationkey", (F.col("s_nationkey") + 1) % 25)).otherwise(F.array("s_nationkey"))).alias("place")).join(nations, F.col("place") == F.col("n_nationkey"))
    institution = F.struct(_href("institutions", "place").alias("id"), F.col("n_name").alias("display_name"), F.col("n_name").alias("country_code"), F.lit("other").alias("type"))
    at = places.groupBy(F.col("s_suppkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct(institution.alias("institution"), F.array(F.lit(2000)).alias("years")))).alias("affiliations"))
    level = F.struct(F.lit("https://graph/1").alias("id"), F.lit("one").alias("display_name"))
    topics = F.array(F.struct(F.lit("https://graph/T1").alias("id"), F.lit("topic").alias("display_name"), F.lit(1).cast("bigint").alias("count"), *[level.alias(c) for c in ("subfield", "field", "domain")]))
    raw = own.join(at, F.col("k") == F.col("s_suppkey"), "left").select(
        _href("authors", "s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 3 == 0, _href("orcid", "s_suppkey")).alias("orcid"), F.col("s_name").alias("display_name"), F.lit(None).cast("array<string>").alias("display_name_alternatives"),
        F.when(F.col("s_suppkey") % 5 != 0, F.col("s_suppkey")).alias("works_count"), F.lit(None).cast("bigint").alias("cited_by_count"), F.struct(F.lit(1).alias("h_index"), F.lit(None).cast("int").alias("i10_index")).alias("summary_stats"),
        "affiliations", F.transform("affiliations", lambda a: a["institution"]).alias("last_known_institutions"), topics.alias("topics"), F.lit(None).cast("array<struct<year:int,works_count:bigint,cited_by_count:bigint>>").alias("counts_by_year"),
    )
    return normalise.authors(raw)


PLACED = "placed AS (SELECT s_suppkey, s_nationkey AS place FROM supplier UNION ALL SELECT s_suppkey, (s_nationkey + 1) % 25 FROM supplier WHERE s_suppkey % 2 = 0), located AS (SELECT s_suppkey, n_nationkey, n_name, n_regionkey FROM placed JOIN nation ON place = n_nationkey)"


@query(f"""WITH {PLACED},
own AS (SELECT s_suppkey, count(*) AS n_institutions, bool_or(n_name = '{HOME}') AS has_home_affiliation, round(avg(CASE WHEN n_name = '{HOME}' THEN 1.0 ELSE 0.0 END), 6) AS home_affiliation_proportion FROM located GROUP BY s_suppkey),
near AS (SELECT a.s_suppkey, count(*) AS n_associated, min(o.n_name) AS first_associated, bool_or(o.n_name = '{HOME}') AS has_home_associated FROM located a JOIN nation o ON o.n_regionkey = a.n_regionkey AND o.n_nationkey <> a.n_nationkey GROUP BY a.s_suppkey)
SELECT CAST(s.s_suppkey AS VARCHAR) AS id, CASE WHEN s.s_suppkey % 3 = 0 THEN CAST(s.s_suppkey AS VARCHAR) END AS orcid, CASE WHEN s.s_suppkey % 5 <> 0 THEN s.s_suppkey ELSE 0 END AS works_count, n_institutions, has_home_affiliation, home_affiliation_proportion,
  coalesce(n_associated, 0) AS n_associated, first_associated, coalesce(has_home_associated, false) AS has_home_associated FROM supplier s JOIN own USING (s_suppkey) LEFT JOIN near USING (s_suppkey)""")
def author_profiles(x: Views) -> DataFrame:
    """Profiles with defaults, their institutions, those associated with them, and how much of it is at home."""
    facts = pairs.affiliation_facts(_authors(x), _institutions(x), HOME)
    size = lambda c, n: F.size(c).cast("bigint").alias(n)
    return facts.select(
        "id", "orcid", "works_count", size("institution_names", "n_institutions"), "has_home_affiliation", ROUND6("home_affiliation_proportion"),
        size("associated_institution_names", "n_associated"), F.get("associated_institution_names", F.lit(0)).alias("first_associated"), "has_home_associated",
    )


@query(f"""WITH {PLACED}, ids AS (SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS id FROM located), r AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS k FROM ids)
SELECT CAST(k // 50 AS BIGINT) AS batch, string_agg(id, '|' ORDER BY id) AS ids, count(*) AS n FROM r GROUP BY 1""")
def institution_batches(x: Views) -> DataFrame:
    return batching.institution_batches(_authors(x))


@query("""WITH ids AS (SELECT DISTINCT translate(c_mktsegment || ', ' || c_name, ',.;:', '') AS id FROM customer), r AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS k FROM ids)
SELECT CAST(k // 50 AS BIGINT) AS batch, string_agg(id, '|' ORDER BY id) AS ids, count(*) AS n FROM r GROUP BY 1""")
def name_batches(x: Views) -> DataFrame:
    return batching.name_batches(x.read("customer", "c_mktsegment", "c_name").select(F.concat("c_mktsegment", F.lit(",")).alias("first_name"), F.col("c_name").alias("surname")))


@query("""SELECT l_orderkey AS id, count(*) FILTER (WHERE l_partkey % 10 <> 0) AS n_refs, coalesce(max(l_partkey) FILTER (WHERE l_partkey % 10 <> 0), 0) AS last_ref FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) l GROUP BY l_orderkey""")
def citing_ids(x: Views) -> DataFrame:
    """Citing works landed twice, once each with whole-number ids; references without a number are left out."""
    ref = F.when(F.col("l_partkey") % 10 == 0, "unknown").otherwise(F.concat(F.lit("W"), "l_partkey"))
    raw = x.read("lineitem", "l_orderkey", "l_partkey").distinct().groupBy(F.concat(F.lit("W"), "l_orderkey").alias("id")).agg(F.collect_list(ref).alias("referenced_works"))
    out = normalise.citing_works(raw.unionAll(raw))
    return out.select("id", F.size("referenced_works").cast("bigint").alias("n_refs"), F.coalesce(F.array_max("referenced_works"), F.lit(0)).cast("bigint").alias("last_ref"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS subfield_id, p_name AS label FROM part WHERE p_size % 4 = 2")
def taxonomy_subfields(x: Views) -> DataFrame:
    """Parts are entries of a taxonomy under brand and type, at a level by their size."""
    entries = x.read("part", "p_partkey", "p_name", "p_brand", "p_type", "p_size").select(F.col("p_name").alias("label"), F.concat_ws(" > ", "p_brand", "p_type", F.col("p_partkey").cast("string")).alias("id_path"), (F.col("p_size") % 4).alias("level"))
    return diversity.taxonomy_subfields(entries)


@query("""WITH m AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS is_match FROM lineitem), t AS (SELECT sum(is_match) AS p, sum(1 - is_match) AS q FROM m)
SELECT is_match, count(*) AS n, round(max(CASE WHEN is_match = 1 THEN q / greatest(p, 1) ELSE 1.0 END), 6) AS weight FROM m CROSS JOIN t GROUP BY is_match""")
def class_weights(x: Views) -> DataFrame:
    """The weight of each class: negatives for a positive."""
    rows = x.read("lineitem", "l_returnflag").select((F.col("l_returnflag") == "R").cast("int").alias("is_match"))
    return model.class_weighted(rows).groupBy("is_match").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("weight"), 6).alias("weight"))
