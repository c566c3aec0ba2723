"""Publications to author-years: own affiliations, co-authors and their countries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import kept
from .skew import ROWS, TASKS


def _kinds(country: Column, home: str) -> dict[str, Column]:
    return {"uk": country == home, "abroad": (country != home) & (country != ""), "unknown": country == ""}


def with_people(works: DataFrame) -> DataFrame:
    """Adds people[author_id, pos, country]: the first entry of each author on a paper, by author_id. Entries are sorted
    in the row, so nothing is shuffled; they are searched for repeated authors only where there are some. Works that have
    their people stay as they are."""
    if "people" in works.columns:
        return works
    entries = F.transform("authorships", lambda a, i: F.struct(a["author_id"].alias("author_id"), i.alias("pos"), a["country"].alias("country")))
    known = F.sort_array(F.filter(entries, lambda a: a["author_id"].isNotNull()))
    # bound to a name, the sorted array is made once
    first = F.transform(F.array(known), lambda s: F.filter(s, lambda a, i: (i == 0) | (F.get(s, i - 1)["author_id"] != a["author_id"])))
    ids, size = F.col("authorships.author_id"), F.size("authorships")
    kind, kinds = (works.select(c).schema[0].dataType.simpleString() for c in (known, ids))
    # most works repeat no author and lack none; a lambda for each entry takes longer than all else
    plain = (size > 0) & (F.size(F.array_except(ids, F.array(F.lit(None)).cast(kinds))) == size)
    whole = F.sort_array(F.arrays_zip(ids, F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))), F.col("authorships.country")).cast(kind))
    return works.withColumn("people", F.when(plain, whole).otherwise(F.coalesce(F.get(first, F.lit(0)), F.array().cast(kind))))


def author_papers(works: DataFrame, matched: DataFrame, home: str) -> DataFrame:
    """A row per paper and matched author. ``works``: id, year, fwci, cited_by_count, authorships[author_id, country].

    Only the first entry of an author on a paper counts; one without country (null) neither counts nor appears, and ''
    is an unknown country. Linear in authorships: a paper's totals are made once in its row, and a matched author's own
    part is taken off, so no pair of co-authors is made; the only join is with the matched authors.
    """
    each = with_people(works)
    number = lambda k: F.size(F.filter("people", lambda a: _kinds(a["country"], home)[k])).cast("bigint")
    totals = [number(k).alias(f"all_{k}") for k in ("uk", "abroad", "unknown")]
    rows = each.select("id", "year", "fwci", "cited_by_count", *totals, F.explode("people").alias("a")).select("*", "a.author_id", "a.country")
    rows = rows.join(matched.select("author_id").distinct(), "author_id", "left_semi")
    mine = {k: F.coalesce(c, F.lit(False)).cast("bigint") for k, c in _kinds(F.col("country"), home).items()}
    return rows.select(
        "id", "author_id", "year", "fwci", "cited_by_count", F.when(F.col("country").isNotNull(), F.array("country")).otherwise(F.array().cast("array<string>")).alias("affiliation_countries"),
        *[mine[k].alias(f"n_affils_{k}") for k in mine], *[(F.col(f"all_{k}") - mine[k]).alias(f"n_collab_{k}") for k in mine],
    )


@dataclass(frozen=True)
class Collaborations:
    """Who else is on matched authors' papers of a year, and from where.

    People are numbers, and sets of people are rows of 64 bits: ``sets`` (author_id, year, word, mask) holds number
    64 * word + bit for each set bit. Such rows merge by bitwise or, and are counted by their bits. ``countries``
    (author_id, year, country) is distinct, with '' for unknown ones. ``numbers``: (author_id, number).
    """

    sets: DataFrame
    countries: DataFrame
    numbers: DataFrame

    def ids(self) -> DataFrame:
        """Distinct (author_id, year, collab_id)."""
        bits = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.getbit("mask", b) == 1)
        each = self.sets.select("author_id", "year", "word", F.explode(bits).alias("bit")).withColumn("number", F.col("word") * WORD + F.col("bit"))
        return each.join(self.numbers.withColumnRenamed("author_id", "collab_id"), "number").select("author_id", "year", "collab_id")


WORD = 64
#: Rows of one author and word or country that a task unites at once: some 100 MB where all differ.
PAIRS = 1_000_000


def _numbered(people: DataFrame, *order: str) -> DataFrame:
    """(author_id, number): gapless numbers from 0 in that order. Ranges of people are ranked by themselves; the sizes of
    the ranges before, one row for each, are added."""
    dealt = people.repartitionByRange(*order, "author_id").withColumn("part", F.spark_partition_id())
    local = kept(dealt.withColumn("local", F.row_number().over(Window.partitionBy("part").orderBy(*order, "author_id"))).select("author_id", "part", "local"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = local.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return local.join(F.broadcast(parts), "part").select("author_id", (F.col("local") - 1 + F.col("before")).alias("number"))


def _place(number: str = "number") -> tuple[Column, Column]:
    return F.expr(f"{number} div {WORD}"), F.expr(f"shiftleft(1L, cast({number} % {WORD} as int))")


def collaborators(works: DataFrame, matched: DataFrame) -> Collaborations:
    """The collaborators of matched authors. Entries count as in ``author_papers``; those without country do not.

    People are numbered by the paper with most authors that each is on, so that those of a large paper fill few words,
    and a paper of n authors sends each of them n / 64 rows or little more. Where people are strangers to each other
    each is a word by itself, as a pair would be. Papers meet their authors by id, so no list of people is held; their
    words and their countries meet them in one join, whose rows are united in one aggregate and kept. Tasks grow with the
    entries, and with the pairs that they could make. ``works`` is read three times, so it should be kept where it is dear.
    """
    works = with_people(works).select("id", "year", "people")
    size = works.select(F.size("people").cast("double").alias("n")).agg(F.sum("n"), F.sum(F.col("n") * F.col("n"))).first()
    least = works.sparkSession.sparkContext.defaultParallelism
    tasks, wide = (max(least, min(TASKS, int(n or 0) // rows + 1)) for n, rows in zip(size, (ROWS, PAIRS), strict=True))
    entries = works.select("id", "year", F.size("people").alias("n"), F.explode("people").alias("a")).select("id", "year", "n", "a.author_id", "a.country")
    homes = entries.groupBy("author_id").agg(F.max(F.struct("n", "id")).alias("home")).select("author_id", "home.n", "home.id")
    numbers = _numbered(homes, "n", "id")
    known = numbers.join(matched.select("author_id", F.lit(True).alias("matched")).distinct(), "author_id", "left")
    who = kept(entries.drop("n").join(known, "author_id"))
    word, mask = _place()
    none, no_place = F.lit(0).cast("bigint"), F.lit(None).cast("string")
    each = F.explode(F.array(F.struct(word.alias("word"), mask.alias("mask"), no_place.alias("country")), F.struct(F.lit(None).cast("bigint").alias("word"), none.alias("mask"), F.col("country").cast("string").alias("country"))))
    held = who.where("country is not null").select("id", each.alias("h")).select("id", "h.*").repartition(tasks, "id").groupBy("id", "word", "country").agg(F.bit_or("mask").alias("mask"), F.count(F.lit(1)).alias("n"))
    own = who.where("matched").select("id", "year", "author_id", F.col("country").alias("own"), word.alias("own_word"), mask.alias("own_mask")).repartition(tasks, "id")
    others = F.when(F.col("word") == F.col("own_word"), F.col("mask").bitwiseAND(F.bitwise_not("own_mask"))).otherwise(F.col("mask"))
    alone = F.coalesce(F.col("own") == F.col("country"), F.lit(False)) & (F.col("n") == 1)
    met = own.join(held, "id").select("author_id", "year", "word", others.alias("mask"), "country", alone.alias("alone")).where("mask <> 0 or country is not null and not alone").drop("alone")
    met = kept(met.repartition(wide, "author_id", "year").groupBy("author_id", "year", "word", "country").agg(F.bit_or("mask").alias("mask")))
    return Collaborations(met.where("word is not null").select("author_id", "year", "word", "mask"), met.where("country is not null").select("author_id", "year", "country"), numbers)


def collaborations_of(rows: DataFrame) -> Collaborations:
    """The same from rows (author_id, year, collab_id, country)."""
    numbers = _numbered(rows.select(F.col("collab_id").alias("author_id")).distinct())
    word, mask = _place()
    each = rows.join(numbers.withColumnRenamed("author_id", "collab_id"), "collab_id").select("author_id", "year", word.alias("word"), mask.alias("mask"))
    return Collaborations(each.groupBy("author_id", "year", "word").agg(F.bit_or("mask").alias("mask")), rows.select("author_id", "year", "country").distinct(), numbers)


def author_years(papers: DataFrame) -> DataFrame:
    """Author-years of ``author_papers``. Papers are summed by their countries first, so that sets are made of few rows."""
    keys = ["author_id", "year"]
    columns = [f"n_{w}_{k}" for w in ("affils", "collab") for k in ("uk", "abroad", "unknown")]
    sums = [F.sum(c).alias(c) for c in columns]
    each = papers.groupBy(*keys, "affiliation_countries").agg(*sums, F.sum("fwci").alias("fwci"), F.count("fwci").alias("n_fwci"), F.sum("cited_by_count").alias("cited_by_count"), F.count(F.lit(1)).alias("n_pubs"))
    countries = F.array_sort(F.array_distinct(F.flatten(F.collect_set("affiliation_countries"))))
    total = lambda c: F.sum(c).alias(c)
    return each.groupBy(*keys).agg(countries.alias("affiliation_countries"), *sums, F.try_divide(F.sum("fwci"), F.sum("n_fwci")).alias("fwci"), total("cited_by_count"), total("n_pubs"))


def with_collaborators(years: DataFrame, collabs: Collaborations) -> DataFrame:
    """Author-years with unique_collab_ids and unique_collab_countries (without unknown ones), sorted."""
    none = F.array_remove(F.array(F.lit("")), "")
    out, keys = years, ["author_id", "year"]
    for rows, c, name in ((collabs.ids(), "collab_id", "unique_collab_ids"), (collabs.countries, "country", "unique_collab_countries")):
        sets = rows.where(F.col(c).cast("string") != "").groupBy(*keys).agg(F.array_sort(F.collect_set(c)).alias(name))
        out = out.join(sets, keys, "left").withColumn(name, F.coalesce(name, none.cast(sets.schema[name].dataType)))
    return out


def with_collaborator_counts(years: DataFrame, collabs: Collaborations) -> DataFrame:
    """Author-years with n_collab_ids and n_collab_countries, the sizes of these lists, which are not made."""
    keys = ["author_id", "year"]
    ids = collabs.sets.groupBy(*keys).agg(F.sum(F.bit_count("mask")).alias("n_collab_ids"))
    places = collabs.countries.where("country <> ''").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_collab_countries"))
    return years.join(ids, keys, "left").join(places, keys, "left").fillna(0, ["n_collab_ids", "n_collab_countries"])
