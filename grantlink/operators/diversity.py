"""Topic diversity of author-years: decayed subfield frequencies, variety, evenness and disparity."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import decay
from ..sources.tables import kept
from .skew import tasks_for


def subfield_frequencies(rows: DataFrame) -> DataFrame:
    """(author_id, year, subfield, freq) of rows (author_id, id, year, subfield), each of which counts."""
    return rows.groupBy("author_id", "year", "subfield").agg(F.count(F.lit(1)).alias("freq"))


def author_topic_rows(works: DataFrame, matched: DataFrame, legacy_duplicates: bool = False) -> DataFrame:
    """(author_id, id, year, subfield): a row for each topic of each paper of a matched author. ``works``: id, year,
    authorships[author_id, ...], topics[subfield, ...]. An author with several entries on a paper counts once, or with
    ``legacy_duplicates`` once for each entry."""
    entries = works.select("id", "year", F.explode("authorships.author_id").alias("author_id")).where("author_id is not null")
    entries = entries.join(matched.select("author_id").distinct(), "author_id", "left_semi")
    entries = entries if legacy_duplicates else entries.distinct()
    return entries.join(works.select("id", F.explode("topics.subfield").alias("subfield")), "id").select("author_id", "id", "year", "subfield")


def author_subfield_years(works: DataFrame, matched: DataFrame, legacy_duplicates: bool = False) -> DataFrame:
    """Works to (author_id, year, subfield, freq, n_pubs, total_publications), subfields that are missing left out."""
    rows = author_topic_rows(works, matched, legacy_duplicates)
    return subfield_frequencies(rows.where("subfield is not null")).join(author_year_publications(rows), ["author_id", "year"])


def decayed_frequencies(freq: DataFrame, alpha: float = 1.0, past_only: bool = False) -> DataFrame:
    """For every year of an author the frequencies of all the author's years, weighted by distance in time.

    A convolution in the row: a subfield's yearly counts of an author are an array, and each of the author's years sums
    them with its weights. Rows are dealt by author once; both aggregates and their join stay there, and so does what
    groups the result by author and year. An array holds at most an author's years. ``freq`` is kept, so that it can be
    counted: tasks grow with it, as small bytes unfold into many rows.
    """
    freq = kept(freq.select("author_id", "year", "subfield", "freq"))
    dealt = freq.repartition(tasks_for(freq), "author_id")
    years = dealt.groupBy("author_id").agg(F.array_sort(F.collect_set("year")).alias("years"))
    series = dealt.groupBy("author_id", "subfield").agg(F.collect_list(F.struct("year", "freq")).alias("held"))
    held = lambda y: F.filter("held", lambda p: p["year"] <= y) if past_only else F.col("held")
    weighted = lambda y: F.aggregate(held(y), F.lit(0.0), lambda s, p: s + p["freq"] * decay(p["year"], y, alpha))
    each = F.transform("years", lambda y: F.struct(y.alias("year"), weighted(y).alias("freq")))
    out = series.join(years, "author_id").select("author_id", "subfield", F.explode(each).alias("p"))
    return out.select("author_id", "p.year", "subfield", "p.freq").where("freq > 0")


def diversity(decayed: DataFrame, distances: DataFrame, n_subfields: int, tolerance: float = 1e-6) -> DataFrame:
    """variety, evenness and disparity per author-year, of subfields with frequency 1 or more. ``distances``: (a, b,
    distance) for both orders. Author-years without such a subfield have zeros."""
    own = lambda c: F.when(F.col("freq") >= 1 - tolerance, c)
    sums = [F.count(own(F.lit(1))).alias("n"), F.sum(own(F.col("freq"))).alias("total"), F.sum(own(F.col("freq") * F.col("freq"))).alias("squares")]
    base = decayed.groupBy("author_id", "year").agg(*sums, F.array_sort(F.collect_list(own(F.col("subfield")))).alias("held"))
    # an author-year's subfields are of a fixed taxonomy, so their array is short, and its pairs are made in the row
    after = lambda a, i: F.transform(F.slice("held", i + 2, F.size("held")), lambda b: F.struct(a.alias("a"), b.alias("b")))
    pairs = base.select("author_id", "year", "n", "total", "squares", F.explode_outer(F.flatten(F.transform("held", after))).alias("p"))
    apart = pairs.select("author_id", "year", "n", "total", "squares", "p.a", "p.b").join(F.broadcast(distances), ["a", "b"], "left")  # pairs of the taxonomy: 252 subfields make 63,504
    out = apart.groupBy("author_id", "year", "n", "total", "squares").agg(F.avg("distance").alias("disparity"))
    evenness = F.when(F.col("n") > 1, (F.col("total") * F.col("total") / F.col("squares") - 1) / (F.col("n") - 1)).otherwise(0.0)
    return out.select("author_id", "year", (F.col("n") / n_subfields).alias("variety"), F.coalesce(evenness, F.lit(0.0)).alias("evenness"), F.coalesce("disparity", F.lit(0.0)).alias("disparity"))


#: Groups whose vectors are compared with as many others in one task.
TILE = 512


def group_distances(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Euclidean distances between the mean vectors of groups, as shares of the largest: (a, b, distance), both orders.

    Rows are averaged by a distributed aggregate first. The means are dealt into tiles of about TILE, and each pair of
    tiles meets in a task that takes the differences of whole vectors by numpy.
    """
    means = vectors.select(key, F.posexplode(vector).alias("i", "x")).groupBy(key, "i").agg(F.avg("x").alias("x"))
    means = kept(means.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("v")))
    tiles = 1 + means.count() // TILE
    dealt = means.withColumn("tile", F.pmod(F.xxhash64(key), F.lit(tiles)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    rows, columns = dealt.select(F.col("tile").alias("r"), every.alias("c"), key, "v"), dealt.select(every.alias("r2"), F.col("tile").alias("c2"), key, "v")

    def apart(x: pa.Table, y: pa.Table) -> pa.Table:
        out = []
        if len(x) and len(y):
            one, other = (np.array(t["v"].to_pylist(), float) for t in (x, y))
            out = [np.sqrt(((other - v) ** 2).sum(axis=1)) for v in one]
        a, b = np.repeat(np.arange(len(x)), len(y)), np.tile(np.arange(len(y)), len(x))
        return pa.table({"a": x[key].take(pa.array(a)), "b": y[key].take(pa.array(b)), "d": pa.array(np.concatenate(out) if out else np.zeros(0))})

    kind = dict(means.dtypes)[key]
    raw = rows.groupBy("r", "c").cogroup(columns.groupBy("r2", "c2")).applyInArrow(apart, f"a {kind}, b {kind}, d double")
    raw = kept(raw)
    largest = raw.agg(F.max("d").alias("m"))
    return raw.crossJoin(F.broadcast(largest)).select("a", "b", F.coalesce(F.try_divide("d", "m"), F.lit(0.0)).alias("distance"))  # one row


def batch_encoder(load: Callable[[], Callable[[list[str]], list]]) -> Callable[[Column], Column]:
    """An encoder of labels: ``load`` gives a function from labels to vectors, and is called once for each task's
    iterator of batches, not for each batch."""

    @F.pandas_udf("array<double>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vectors = load()
        for labels in batches:
            yield pd.Series([list(map(float, v)) for v in vectors(labels.tolist())])

    return encode


def hashed_words(label: Column, size: int = 256) -> Column:
    """A vector of the label's words, counted at the places that their hashes give: an encoder without a trained model."""
    places = F.transform(F.filter(F.split(F.lower(label), r"\W+"), lambda w: w != ""), lambda w: F.pmod(F.xxhash64(w), F.lit(size)))
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.size(F.filter(places, lambda p: p == i)).cast("double"))


def label_distances(labels: DataFrame, encode: Callable[[Column], Column] = hashed_words) -> DataFrame:
    """(a, b, distance) of taxonomy entries (subfield_id, label) by their labels. ``encode`` makes a label an
    array<double>; a sentence encoder can be given by ``batch_encoder``. Entries without a label are left out."""
    return group_distances(labels.where("label is not null").select("subfield_id", encode(F.col("label")).alias("vector")), "subfield_id", "vector")


def author_year_publications(rows: DataFrame) -> DataFrame:
    """(author_id, year, n_pubs, total_publications) of rows (author_id, id, year): distinct papers, and the author's total."""
    each = rows.select("author_id", "id", "year").distinct().groupBy("author_id", "year").agg(F.count(F.lit(1)).alias("n_pubs"))
    return each.withColumn("total_publications", F.sum("n_pubs").over(Window.partitionBy("author_id")))


def taxonomy_subfields(taxonomy: DataFrame) -> DataFrame:
    """(subfield_id, label) of the taxonomy's entries (label, id_path, level) of level 2."""
    return taxonomy.where("level = 2").select(F.element_at(F.split("id_path", " > "), -1).alias("subfield_id"), "label")


def half_even(c: Column, places: int) -> Column:
    """Ties go to the even side; what a sum's order leaves behind the ninth place does not break one."""
    return F.bround(F.round(c, 9), places)


def yearly_series(series: DataFrame, places: int, *columns: str) -> DataFrame:
    """(author_id, year, ...) with the yearly values as they are reported."""
    return series.select("author_id", "year", *[half_even(F.col(c), places).alias(c) for c in columns])


def collected_series(series: DataFrame, *columns: str) -> DataFrame:
    """Per author the sorted array of its yearly values."""
    return series.groupBy("author_id").agg(F.array_sort(F.collect_list(F.struct("year", *columns))).alias("series"))


def before_after(refs: DataFrame, series: DataFrame, *columns: str) -> DataFrame:
    """Mean of yearly values before and after; several reference years of an author count as the earliest."""
    ref = refs.groupBy("author_id").agg(F.min("ref_year").alias("ref_year"))
    side = {"before": F.col("year") < F.col("ref_year"), "after": F.col("year") >= F.col("ref_year")}
    aggs = [half_even(F.avg(F.when(on, F.col(c))), 3).alias(f"{c}_{s}") for c in columns for s, on in side.items()]
    return ref.join(ref.join(series, "author_id").groupBy("author_id").agg(*aggs), "author_id", "left")
