"""Language ID by Bayesian fusion of evidence.

The likelihood of the text (byte trigrams) is combined with the likelihood of the declared markup language, that of the
address suffix, and a prior of the host. The last three come from grouped aggregation over all pages: the languages that the text
alone suggests are counted by declaration, suffix, host and domain. A page's own guess is taken off every count that
judges it, so its text counts once. Host priors are smoothed towards their domain's, and those towards the whole corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, table, utf8, widened, with_row
from .urls import host_of

BINS = 1 << 15
#: The text model is fitted on about so many different labelled texts of each language, chosen by a hash of the text.
SAMPLE = 2000
#: Languages that the model may have.
MOST_LANGUAGES = 200
#: Weight of a trigram: each byte lies in three.
TEMPER = 1 / 3
STRENGTH = 5.0
MARKUP = re.compile(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
#: Bytes that are no letters become spaces, A-Z lower case.
LETTERS = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256))


def trigram_counts(text: bytes) -> np.ndarray:
    x = np.frombuffer(b" " + b" ".join(text.translate(LETTERS).split()) + b" ", np.uint8).astype(np.uint32)
    if len(x) < 3:
        return np.zeros(BINS)
    return np.bincount(((x[:-2] * 65599 + x[1:-1]) * 65599 + x[2:]) * np.uint32(2654435761) >> np.uint32(17), minlength=BINS)


def visible(html: bytes) -> bytes:
    return unescape(MARKUP.sub(b" ", html).decode("utf-8", "replace")).encode()


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            sums[lang] = sums.get(lang, 0) + trigram_counts(text.as_py())
    for lang, x in sums.items():
        some = np.flatnonzero(x)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array(some, pa.int32()), pa.array(x[some], pa.int64())], ["lang", "bin", "n"])


def fit(documents: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages, and log10 probabilities (language, bin), of labelled documents (lang, text). Equal texts of a language
    count once; a language with fewer than ``sample`` of them is fitted on all. More than MOST_LANGUAGES raise, as the model
    is a table of BINS numbers for each, which every worker holds."""
    labelled = documents.where("lang is not null and text is not null").select("lang", utf8("text").alias("_utf8"))
    hashed = F.xxhash64("_utf8")
    sizes = keep(labelled.select("lang", hashed.alias("h")).distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    if sizes.count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    chosen = labelled.join(F.broadcast(sizes), "lang").where(F.pmod(hashed, F.lit(1_000_003)) * F.col("n") < F.lit(sample * 1_000_003))  # a row per language
    chosen = chosen.groupBy("lang", hashed.alias("h")).agg(F.first("_utf8").alias("_utf8")).select("lang", "_utf8")
    counts = chosen.mapInArrow(_fit, "lang string, bin int, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()  # BINS rows a language
    langs = sorted(pc.unique(counts["lang"]).to_pylist())
    n = np.full((len(langs), BINS), 0.5)
    own = pc.index_in(counts["lang"], value_set=pa.array(langs, pa.string())).to_numpy()
    n[own, counts["bin"].to_numpy()] += counts["n"].to_numpy()
    return langs, np.log10(n / n.sum(axis=1, keepdims=True))


def _likelihoods(known, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = known.value
    for batch in batches:
        at = batch.schema.get_field_index("_utf8")
        out = [(TEMPER * (model @ trigram_counts(visible(x.as_py())))).tolist() for x in batch.column(at)]
        yield batch.drop_columns(["_utf8"]).append_column("text_score", pa.array(out, pa.list_(pa.float64())))


def _counts(df: DataFrame, langs: list[str], *keys: str) -> DataFrame:
    each = F.array(*[F.count_if(F.col("guess") == i).cast("double") for i in range(len(langs))])
    return df.groupBy(*keys).agg(each.alias("c"))


def _sum(c: str | Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)


def identify_languages(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per page: page_id, host, declared, lang, probability, text_lang (by the text alone).

    ``documents`` (lang, text) are the labelled ones. A null or empty page has a flat text likelihood and goes by its
    other evidence; null urls have host ''. Very long pages are read whole. Without labelled documents lang is null.
    Repeated rows stay and count; so do ties of the text, for the first language by name. Other columns play no part.
    """
    spark = pages.sparkSession
    langs, model = fit(documents)
    host = host_of(F.col("url"))
    declared = F.lower(F.regexp_extract("html", r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})\b""", 1))
    rows = pages.select("page_id", host.alias("host"), F.coalesce(declared, F.lit("")).alias("declared"), utf8("html").alias("_utf8"))
    if not langs:
        none = F.lit(None)
        return rows.select("page_id", "host", "declared", none.cast("string").alias("lang"), none.cast("double").alias("probability"), none.cast("string").alias("text_lang"))
    known = spark.sparkContext.broadcast(model)
    rows = rows.mapInArrow(lambda b: _likelihoods(known, b), widened(rows, "text_score array<double>"))
    rows = rows.withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)).withColumn("suffix", F.regexp_extract("host", r"([^.]+)$", 1))
    flat = F.size(F.array_distinct("text_score")) == 1
    rows = keep(with_row(rows.withColumn("guess", F.when(~flat | F.lit(len(langs) == 1), F.array_position("text_score", F.array_max("text_score")).cast("int") - 1))))
    names = F.array(*map(F.lit, langs))
    overall = _counts(rows, langs).select(F.col("c").alias("c_all"))  # one row
    by_suffix, by_declared, by_domain, by_host = (_counts(rows, langs, k).withColumnRenamed("c", f"c_{k}") for k in ("suffix", "declared", "domain", "host"))
    values = overall.join(by_suffix.agg(F.count(F.lit(1)).alias("n_suffix"))).join(by_declared.agg(F.count(F.lit(1)).alias("n_declared")))  # one row
    seen = rows.join(by_host, "host").join(by_domain, "domain").join(by_suffix, "suffix").join(by_declared, "declared").crossJoin(F.broadcast(values))
    own = F.array(*[F.when(F.col("guess") == i, 1.0).otherwise(0.0) for i in range(len(langs))])
    seen = seen.withColumn("own", own).withColumns({f"c_{k}": F.zip_with(f"c_{k}", "own", lambda x, y: x - y) for k in ("suffix", "declared", "domain", "host", "all")})
    seen = seen.withColumns({f"t_{k}": _sum(f"c_{k}") for k in ("domain", "host", "all")})
    seen = seen.withColumn("p", F.transform("c_all", lambda x: (x + 1) / (F.col("t_all") + len(langs))))
    for k in ("domain", "host"):
        seen = seen.withColumn("p", F.zip_with(f"c_{k}", "p", lambda x, p: (x + STRENGTH * p) / (F.col(f"t_{k}") + STRENGTH)))  # noqa: B023
    # P(suffix | language) and P(declaration | language), with one more count for each value
    likelihood = lambda k: F.zip_with(f"c_{k}", "c_all", lambda x, t: (x + 1) / (t + F.col(f"n_{k}") + 1))
    seen = seen.withColumns({f"like_{k}": likelihood(k) for k in ("suffix", "declared")})
    one = lambda i: F.when(flat, 0.0).otherwise(F.get("text_score", F.lit(i))) + F.log10(F.get("p", F.lit(i))) + sum(F.when(F.col(k) == "", 0.0).otherwise(F.log10(F.get(f"like_{k}", F.lit(i)))) for k in ("suffix", "declared"))
    seen = seen.withColumn("score", F.array(*[one(i) for i in range(len(langs))])).withColumn("best", F.array_max("score"))
    mass = F.aggregate("score", F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), x - F.col("best")))
    at = lambda i: F.get(names, i)
    return seen.select("page_id", "host", "declared", at(F.array_position("score", F.col("best")).cast("int") - 1).alias("lang"), (1 / mass).alias("probability"), at(F.col("guess")).alias("text_lang"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


QUERIES = {"op7_language_id": op7_language_id}
ORACLE_SQL: dict[str, str] = {}
