"""Quality rules with adaptive thresholds, in DataFrame functions only.

Word statistics of each text, then mergeable quantile sketches of four ratios per language and source: counts by
logarithmic bucket (DDSketch, Masson et al. 2019), whose quantiles are off by half of GROWTH - 1 at most, whatever the
order of the rows. A group's sketches are merged upwards, by adding counts: to the language and to the whole corpus,
whose quantiles stand in for groups with few documents. Outer fences of the quartiles replace fixed cutoffs, and a join applies them. Where the quartiles coincide, as
they do where most texts have none of a thing, the upper tail gives the spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACES, keep, table

#: Ratio: the quantile that ends its usual upper tail, and whether low values are odd, too. Sound texts repeat lines and
#: words now and then, so those tails are longer.
RATIOS = {"word_length": (0.9, True), "symbol_ratio": (0.9, False), "dup_line_ratio": (0.98, False), "repeat_ratio": (0.98, False)}
FENCE = 3.0
#: A spread of no more than this is a tie.
TIE = 0.01
#: Documents that a group needs for thresholds of its own.
GROUP_ROWS = 30
#: Ratio of a bucket's bounds. Values from 1e-9 to 1e9 fall into about 4,200 buckets.
GROWTH = 1.01
WORD_BREAK = r"[\x20\x09-\x0D]+"


def word_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` (packed as struct ``doc``) and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    at = docs.select(doc, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    trimmed = F.btrim("t", F.lit(SPACES))
    at = at.select("doc", "t", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAK)).alias("w"))
    at = at.select(
        "doc", "w", F.size("w").alias("n"),
        F.filter(F.split("t", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "").alias("lines"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
    )
    n = F.col("n")
    # hashes of the 3-word windows, and their places sorted by hash: equal windows become neighbours
    hashed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))
    at = at.select("doc", "n", "n_symbols", F.size("lines").alias("n_lines"), F.size(F.array_distinct("lines")).alias("lines_left"), F.char_length(F.array_join("w", "")).cast("bigint").alias("word_chars"), F.when(n >= 3, hashed).alias("h"))
    at = at.withColumn("m", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda k, d: F.coalesce(F.get("m", k)["h"] == F.get("m", k + d)["h"], F.lit(False))
    again = F.filter(F.sequence(F.lit(0), F.size("m") - 1), lambda k: same(k, -1) | same(k, 1))
    at = at.withColumn("k", F.when(F.col("m").isNotNull(), again))
    at = at.withColumn("p", F.sort_array(F.transform("k", lambda k: F.get("m", k)["i"])))
    steps = F.transform("p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("p", i + 1) - p, F.lit(3))))
    repeated = F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("bigint")
    return at.select("doc", n.cast("bigint").alias("n_words"), "word_chars", "n_symbols", F.col("n_lines").cast("bigint").alias("n_lines"), (F.col("n_lines") - F.col("lines_left")).cast("bigint").alias("n_dup_lines"), repeated.alias("n_repeat_words"))


def _ratio(name: str) -> Column:
    top, below = {"word_length": ("word_chars", "n_words"), "symbol_ratio": ("n_symbols", "n_words"), "dup_line_ratio": ("n_dup_lines", "n_lines"), "repeat_ratio": ("n_repeat_words", "n_words")}[name]
    return F.col(top) / F.col(below)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def sketches_of(good: DataFrame) -> DataFrame:
    """Rows (lang, source, ratio, value, count): a bucket of a group's sketch, by the value that stands for it."""
    bucket = lambda x: F.when(x > 0, F.ceil(F.log(x) / F.log(F.lit(GROWTH))))
    each = good.select("lang", "source", F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), bucket(_ratio(r)).alias("bucket")) for r in RATIOS])).alias("x"))
    value = F.when(F.col("bucket").isNull(), F.lit(0.0)).otherwise(2 * F.pow(F.lit(GROWTH), "bucket") / (GROWTH + 1))
    return each.groupBy("lang", "source", "x.ratio", "x.bucket").count().select("lang", "source", "ratio", value.alias("value"), "count")


def thresholds(stats: DataFrame) -> DataFrame:
    """Rows (lang, source, low_x, high_x): fences for each group of ``stats`` (lang, source, base_failed, statistics).

    Only documents that pass the base rules shape them. Sketches are aggregated with a map-side part, so a source with
    most of the rows makes no hot task; what follows sees buckets, not documents.
    """
    sketches = keep(sketches_of(stats.where(~F.col("base_failed"))))

    def level(name: str, *keys: str, always: bool = False) -> DataFrame:
        """Quartiles and spreads. A tail counts if as many documents lie beyond it as beyond a quartile of GROUP_ROWS."""
        merged = sketches.groupBy(*keys, "ratio", "value").agg(F.sum("count").alias("count"))
        group = Window.partitionBy(*keys, "ratio")
        merged = merged.withColumn("n", F.sum("count").over(group)).withColumn("upto", F.sum("count").over(group.orderBy("value")))
        at = lambda r, q: F.min(F.when((F.col("ratio") == r) & (F.col("upto") >= q * F.col("n")), F.col("value")))
        found = merged.groupBy(*keys).agg(F.max("n").alias("n"), *[at(r, q).alias(f"{x}_{r}") for r, (end, _) in RATIOS.items() for x, q in (("q1", 0.25), ("q3", 0.75), ("top", end))])
        out = []
        for r, (end, _) in RATIOS.items():
            q1, q3, top = (F.col(f"{x}_{r}") for x in ("q1", "q3", "top"))
            tail = top - q3 if always else F.when(F.col("n") * (1 - end) >= GROUP_ROWS / 4, top - q3)
            out += [q1.alias(f"q1_{r}"), q3.alias(f"q3_{r}"), (q3 - q1).alias(f"iqr_{r}"), tail.alias(f"tail_{r}")]
        return found.select(*keys, "n", F.struct(*out).alias(name))

    by_lang, overall, own = level("of_lang", "lang"), level("of_all", always=True).where("n > 0"), level("own", "lang", "source").alias("s")
    joined = own.join(by_lang.alias("l"), F.col("s.lang").eqNullSafe(F.col("l.lang")), "left").join(overall.alias("a"), F.lit(True), "left")  # the last is one row
    pick = F.when(F.col("s.n") >= GROUP_ROWS, F.col("own")).when(F.col("l.n") >= GROUP_ROWS, F.col("of_lang")).otherwise(F.col("of_all"))
    joined = joined.select(F.col("s.lang").alias("lang"), F.col("s.source").alias("source"), pick.alias("f"), "own", "of_lang", "of_all")
    out = []
    for r, (_, both) in RATIOS.items():
        tail = F.coalesce(*[F.col(f"{x}.tail_{r}") for x in ("own", "of_lang", "of_all")])
        spread = F.greatest(F.col(f"f.iqr_{r}"), tail)
        if both:  # nothing has a natural 0 here: a group without spread is one of copies, and the others' spread counts
            for x in ("of_lang", "of_all"):
                spread = F.when(spread > TIE, spread).otherwise(F.greatest(F.col(f"{x}.iqr_{r}"), F.col(f"{x}.tail_{r}")))
        spread = FENCE * F.greatest(spread, F.lit(TIE))
        out += [(F.col(f"f.q1_{r}") - spread if both else F.lit(None).cast("double")).alias(f"low_{r}"), (F.col(f"f.q3_{r}") + spread).alias(f"high_{r}")]
    return keep(joined.select("lang", "source", *out))


def _verdict(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds kept. ``limits`` have a row per group, and Spark broadcasts them if they are small."""
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = stats.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    fine = F.lit(True)
    for r, (_, both) in RATIOS.items():
        fine &= F.coalesce(_ratio(r) <= F.col(f"high_{r}"), F.lit(True))
        if both:
            fine &= F.coalesce(_ratio(r) >= F.col(f"low_{r}"), F.lit(True))
    return joined.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(fine))


def judge_quality(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    A null or empty text has no words and fails the base rules. Null languages and sources are groups like others.
    Repeated rows and ties are judged alike, and so is a table read in another order. Very long texts are read whole.
    """
    stats = word_statistics(docs.select("doc_id", "lang", "source", "text")).select("doc.doc_id", "doc.lang", "doc.source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    stats = keep(stats.withColumn("base_failed", base_failed()))
    judged = _verdict(stats, thresholds(stats))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected ones; columns pass through.

    The statistics are made twice, for the thresholds and for the verdict, so that no text is written or shuffled. Null
    and empty texts have no words and go; repeated rows get one verdict, and stay or go together; a null language or
    source is a group like others; very long texts are read whole. An empty table gives no rows.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    groups = [F.col("doc.lang").alias("lang"), F.col("doc.source").alias("source")]
    limits = thresholds(keep(word_statistics(docs).select(*groups, *names).withColumn("base_failed", base_failed())))
    # through explode, the conditions stay above the statistics and do not repeat their expressions
    stats = word_statistics(docs).select("doc", F.explode(F.array(F.struct(*names))).alias("x")).select("doc", *groups, "x.*")
    return _verdict(stats.withColumn("base_failed", base_failed()), limits).where("kept").select("doc.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))


QUERIES = {"op2_quality_rules": op2_quality_rules}
ORACLE_SQL: dict[str, str] = {}
