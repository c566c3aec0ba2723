"""Metrics before and after a person's first grant. Keys are (person_id, author_id), each with its own year.

``refs`` has person_id, author_id, ref_year. A year is before if it is less than ref_year. Null means missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .author_year import Collaborations

KEYS = ("person_id", "author_id")


def before(c: Column) -> Column:
    return F.when(F.col("year") < F.col("ref_year"), c)


def after(c: Column) -> Column:
    return F.when(F.col("year") >= F.col("ref_year"), c)


SIDES = {"before": before, "after": after}


def _by_author(refs: DataFrame, years: DataFrame, *aggs: Column) -> DataFrame:
    return refs.where("ref_year is not null").join(years, "author_id").groupBy(*KEYS).agg(*aggs)


def _collab_aggs(home: str) -> list[Column]:
    aggs = []
    for side, on in SIDES.items():
        uk, abroad = F.coalesce(F.sum(on(F.col("n_collab_uk"))), F.lit(0)), F.coalesce(F.sum(on(F.col("n_collab_abroad"))), F.lit(0))
        aggs += [(uk + abroad).alias(f"total_collabs_{side}"), F.bround(F.try_divide(abroad, uk + abroad), 3).alias(f"foreign_collab_fraction_{side}")]
    return aggs


def distinct_collaborators(refs: DataFrame, collabs: Collaborations, home: str) -> DataFrame:
    """Number of distinct collaborators, and their sorted countries abroad. The years' sets of people are united by
    bitwise or and counted by their bits, so a prolific author makes no large array."""
    given = refs.where("ref_year is not null")
    people = given.join(collabs.sets, "author_id").groupBy(*KEYS, "word").agg(*[F.bit_or(on(F.col("mask"))).alias(s) for s, on in SIDES.items()])
    people = people.groupBy(*KEYS).agg(*[F.coalesce(F.sum(F.bit_count(s)), F.lit(0)).alias(f"unique_collabs_{s}") for s in SIDES])
    abroad = collabs.countries.where((F.col("country") != home) & (F.col("country") != ""))
    places = given.join(abroad, "author_id").groupBy(*KEYS).agg(*[F.array_sort(F.collect_set(on(F.col("country")))).alias(f"collab_countries_list_{s}") for s, on in SIDES.items()])
    return people.join(places, [*KEYS], "left")


def _with_collaborators(out: DataFrame, ids: DataFrame) -> DataFrame:
    """Joins ``distinct_collaborators``: none where there are years but no collaborators, null without years."""
    none = F.array_remove(F.array(F.lit("")), "")
    out = out.join(ids, [*KEYS], "left")
    some = F.col("total_collabs_before").isNotNull()
    return out.withColumns({f"unique_collabs_{s}": F.when(some, F.coalesce(f"unique_collabs_{s}", F.lit(0))) for s in SIDES} | {f"collab_countries_list_{s}": F.when(some, F.coalesce(f"collab_countries_list_{s}", none)) for s in SIDES})


def collaborations(refs: DataFrame, years: DataFrame, collabs: Collaborations, home: str) -> DataFrame:
    """Collaborators and their countries. Sums are of years, not papers; unknown countries only count among the distinct
    collaborators."""
    out = refs.join(_by_author(refs, years, *_collab_aggs(home)), [*KEYS], "left")
    return _with_collaborators(out, distinct_collaborators(refs, collabs, home))


def collaboration_country_years(refs: DataFrame, collabs: Collaborations, home: str) -> DataFrame:
    """(person_id, author_id, period, country, n_years)."""
    each = collabs.countries.where((F.col("country") != home) & (F.col("country") != ""))
    period = F.when(F.col("year") < F.col("ref_year"), "before").otherwise("after")
    return refs.where("ref_year is not null").join(each, "author_id").groupBy(*KEYS, period.alias("period"), "country").agg(F.count(F.lit(1)).alias("n_years"))


def _affil_aggs(home: str) -> list[Column]:
    aggs = []
    for side, on in SIDES.items():
        uk, abroad = F.coalesce(F.sum(on(F.col("n_affils_uk"))), F.lit(0)), F.coalesce(F.sum(on(F.col("n_affils_abroad"))), F.lit(0))
        foreign = F.array_sort(F.array_distinct(F.flatten(F.collect_list(on(F.filter("affiliation_countries", lambda c: (c != home) & (c != "")))))))
        aggs += [foreign.alias(f"countries_{side}"), F.bround(F.try_divide(abroad, uk + abroad), 3).alias(f"abroad_fraction_{side}"), F.when(uk + abroad > 0, F.size(foreign) > 0).alias(f"abroad_experience_{side}")]
    return aggs


def affiliations(refs: DataFrame, years: DataFrame, home: str) -> DataFrame:
    return refs.join(_by_author(refs, years, *_affil_aggs(home)), [*KEYS], "left")


def _count_aggs() -> list[Column]:
    aggs = []
    for side, on in SIDES.items():
        n, c = F.sum(on(F.col("n_pubs"))), F.sum(on(F.col("cited_by")))
        aggs += [F.nullif(n, F.lit(0)).alias(f"n_pubs_{side}"), F.nullif(c, F.lit(0)).alias(f"total_citations_pubyear_{side}"), F.bround(F.avg(on(F.col("cited_by"))), 3).alias(f"mean_citations_pubyear_{side}"), F.bround(F.when(n > 0, c / n), 3).alias(f"citations_pp_pubyear_{side}")]
    return aggs


def publication_counts(refs: DataFrame, pub_years: DataFrame, cite_years: DataFrame | None = None) -> DataFrame:
    """From publication years (author_id, year, n_pubs, cited_by): sums that are 0 become null, their means do not. From
    citation years (author_id, year, n_pubs, cited_by): the means of the profile's own series."""
    out = refs.join(_by_author(refs, pub_years, *_count_aggs()), [*KEYS], "left")
    if cite_years is not None:
        more = []
        for side, on in SIDES.items():
            mean = F.bround(F.avg(on(F.col("cited_by"))), 3)
            more += [mean.alias(f"mean_citations_{side}"), F.bround(F.try_divide(mean, F.avg(on(F.col("n_pubs")))), 3).alias(f"citations_pp_{side}")]
        out = out.join(_by_author(refs, cite_years, *more), [*KEYS], "left")
    return out


def _impact_aggs() -> list[Column]:
    return [F.bround(F.avg(on(F.col("fwci"))), 3).alias(f"mean_fwci_{s}") for s, on in SIDES.items()]


def impact(refs: DataFrame, years: DataFrame) -> DataFrame:
    """Unweighted mean of the yearly mean fwci."""
    return refs.join(_by_author(refs, years, *_impact_aggs()), [*KEYS], "left")


def counts_by_year(years: DataFrame) -> DataFrame:
    """Per author the sorted series of (year, n_pubs, cited_by)."""
    return years.groupBy("author_id").agg(F.array_sort(F.collect_list(F.struct("year", "n_pubs", "cited_by"))).alias("counts_by_pubyear"))


def first_work_year(years: DataFrame) -> DataFrame:
    return years.groupBy("author_id").agg(F.min("year").alias("first_work_year"))


def academic_age(refs: DataFrame, years: DataFrame) -> DataFrame:
    """Years from the first work to the first grant."""
    return refs.join(first_work_year(years), "author_id", "left").withColumn("academic_age", F.col("ref_year") - F.col("first_work_year"))


def home_institution(profiles: DataFrame, home: str) -> DataFrame:
    """Whether the first last-known institution is at home; null if unknown."""
    return profiles.withColumn("last_institution_uk", F.get("last_known_institutions", F.lit(0))["country"] == home)


def author_metadata(profiles: DataFrame, matches: DataFrame) -> DataFrame:
    joined = profiles.join(matches.select(F.col("oa_id").alias("id"), "gtr_id"), "id")
    return joined.withColumn("citations_per_publication", F.try_divide("cited_by_count", "works_count"))


def unique_by(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df``, one row for each key; the job that uses it fails if a key is repeated, so no job of its own looks."""
    rest = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest) if rest else F.lit(1)).alias("_row"))
    said = F.concat(F.lit(f"{name}: repeated "), F.to_json(F.struct(*keys)))
    once = F.when(F.col("_n") == 1, True).otherwise(F.raise_error(said).cast("boolean"))
    return counted.where(once).select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def one_to_one(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Inner join that fails if a key is repeated on either side."""
    return unique_by(a, [key], "join is not one to one, left").join(unique_by(b, [key], "join is not one to one, right"), key)


def basic_metrics(refs: DataFrame, years: DataFrame, collabs: Collaborations, home: str) -> DataFrame:
    """All basic before/after metrics of author-years, one row per person and author: one aggregate of the years, and one
    of the collaborators. ``years`` and ``collabs`` are read several times, so they should be kept."""
    keys = [*KEYS, "ref_year"]
    counted = years.withColumn("cited_by", F.col("cited_by_count"))
    out = academic_age(refs, years).join(_by_author(refs, counted, *_count_aggs(), *_impact_aggs(), *_affil_aggs(home), *_collab_aggs(home)), [*KEYS], "left")
    out = _with_collaborators(out, distinct_collaborators(refs, collabs, home))
    return out.select(*keys, *[c for c in out.columns if c not in keys])
