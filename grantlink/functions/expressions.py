"""Column expressions that several jobs share. Nothing here is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tail(x: Column, sep: str = "/") -> Column:
    """What follows the last separator, as of hrefs and id urls."""
    return F.substring_index(x, sep, -1)


def clean_doi(doi: Column) -> Column:
    """From the first ``10.`` on; null if there is none."""
    return F.regexp_substr(doi, F.lit(r"10\..+"))


def clean_name(name: Column) -> Column:
    return F.translate(name, ",.;:", "")


def compact_id(x: Column) -> Column:
    """W123 to 123."""
    return F.regexp_extract(x, r"(\d+)", 1).try_cast("bigint")


def epoch_date(ms: Column) -> Column:
    """The day in UTC, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(ms.cast("bigint") / 86_400_000).cast("int"))


def link_tails(links: Column, rel: str) -> Column:
    return F.transform(F.filter(links, lambda x: x["rel"] == rel), lambda x: tail(x["href"]))


def link_value(links: Column, rel: str, field: str = "href", cut: bool = True) -> Column:
    """The largest value among the links of a kind, null if there is none."""
    return F.array_max(F.transform(F.filter(links, lambda x: x["rel"] == rel), lambda x: tail(x[field]) if cut else x[field]))


def link_date(links: Column, rel: str, field: str) -> Column:
    return epoch_date(link_value(links, rel, field, cut=False))


def topic_levels(label: Column, path: Column) -> Column:
    """The topic record of a taxonomy entry; null if label and path differ in depth."""
    names, ids = F.split(label, " > "), F.split(path, " > ")
    level = lambda i: F.struct(F.when(F.lit(i == 3), F.concat(F.lit("T"), F.get(ids, F.lit(i)))).otherwise(F.get(ids, F.lit(i))).alias("id"), F.get(names, F.lit(i)).alias("name"))
    return F.when(F.size(names) == F.size(ids), F.struct(level(0).alias("domain"), level(1).alias("field"), level(2).alias("subfield"), level(3).alias("topic")))


def level_id(x: Column) -> Column:
    return F.regexp_substr(x, F.lit(r"\d+")).try_cast("int")


def levenshtein_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def name_words(name: Column) -> dict[str, Column]:
    """The last word, the first letter and the first word, in lower case, by the feature that tells if they are equal."""
    x = F.split(F.lower(F.trim(name)), r"\s+")
    return {"surname_match": F.try_element_at(x, F.lit(-1)), "first_initial_match": F.substring(F.get(x, F.lit(0)), 1, 1), "full_first_match": F.try_element_at(x, F.lit(1))}


def name_parts(a: Column, b: Column) -> dict[str, Column]:
    """Equality of last words, first letters and first words, without regard to case."""
    other = name_words(b)
    return {n: F.coalesce(x == other[n], F.lit(False)).cast("int") for n, x in name_words(a).items()}


def rounded(x: Column, places: int = 6) -> Column:
    """``round`` of a double, by arithmetic where the digits that go are not near a half, as ``round`` goes by way of decimals
    and takes most of the time where rows are many."""
    scaled = x * float(10**places)
    near = F.rint(scaled)
    plain = (F.abs(scaled) < float(2**40)) & (F.abs(F.abs(scaled - near) - 0.5) > 1e-3)
    return F.when(plain, near / float(10**places) + 0.0).otherwise(F.round(x, places))


def map_total(m: Column) -> Column:
    return F.aggregate(F.map_values(m), F.lit(0.0), lambda a, x: a + x)


def topic_sums(person: Column, candidate: Column) -> Column:
    """What the similarities of two map<id,count> need, as one struct made in one pass over the ids of either side; a null
    map counts as empty. Both totals are made once, outside the pass."""
    none = F.create_map().cast("map<string,bigint>")
    person, candidate = F.coalesce(person, none), F.coalesce(candidate, none)
    number = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    counts = F.map_zip_with(person, candidate, lambda _, a, b: F.struct(number(a).alias("a"), number(b).alias("b"), (a.isNotNull() & b.isNotNull()).cast("int").alias("both")))
    given = F.struct(F.map_values(counts).alias("each"), map_total(person).alias("pa"), map_total(candidate).alias("pb"))

    def part(own: Column, p: Column, m: Column) -> Column:  # p * ln(p / m), where m is the mean of both shares
        return F.when(own > 0, p * F.ln(p / m)).otherwise(0.0)

    def one_pass(g: Column) -> Column:
        def add(acc: Column, x: Column) -> Column:
            p, q = F.try_divide(x["a"], g["pa"]), F.try_divide(x["b"], g["pb"])
            half = (part(x["a"], p, (p + q) / 2) + part(x["b"], q, (p + q) / 2)) / 2
            terms = {"ab": x["a"] * x["b"], "aa": x["a"] * x["a"], "bb": x["b"] * x["b"], "js": half, "low": F.least(x["a"], x["b"]), "high": F.greatest(x["a"], x["b"])}
            return F.struct(*[(acc[n] + t).alias(n) for n, t in terms.items()], (acc["both"] + x["both"]).alias("both"))

        zero = F.struct(*[F.lit(0.0).alias(n) for n in ("ab", "aa", "bb", "js", "low", "high")], F.lit(0).alias("both"))
        sizes = lambda acc: F.struct(acc.alias("sums"), F.size(g["each"]).alias("ids"), F.size(person).alias("own"), F.size(candidate).alias("other"))
        return F.aggregate(g["each"], zero, add, sizes)

    return F.get(F.transform(F.array(given), one_pass), F.lit(0))


def similarities(sums: Column) -> dict[str, Column]:
    """Set and distribution similarities from ``topic_sums``; 0, 0, 1, 0 if either map is empty."""
    x, empty = sums["sums"], (sums["own"] == 0) | (sums["other"] == 0)
    pick = lambda c, default: F.when(empty, F.lit(default)).otherwise(c)
    return {
        "jaccard": pick(x["both"] / sums["ids"], 0.0),
        "cosine": pick(F.coalesce(F.try_divide(x["ab"], F.sqrt(x["aa"] * x["bb"])), F.lit(0.0)), 0.0),
        "js_div": pick(F.sqrt(F.greatest(F.lit(0.0), x["js"])), 1.0),
        "containment": pick(x["both"] / sums["own"], 0.0),
    }


def weighted_similarities(sums: Column) -> dict[str, Column]:
    """Optional similarities from ``topic_sums``: weighted Jaccard, cosine of shares, Jensen-Shannon distance in base 2 (null
    if either is empty), and the share of the person's topics that the candidate has; the others are 0 if empty."""
    x = sums["sums"]
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return {
        "weighted_jaccard": zero(F.try_divide(x["low"], x["high"])),
        "share_cosine": zero(F.try_divide(x["ab"], F.sqrt(x["aa"] * x["bb"]))),
        "js_base2": F.when((x["aa"] > 0) & (x["bb"] > 0), similarities(sums)["js_div"] / F.sqrt(F.ln(F.lit(2.0)))),
        "coverage": zero(F.try_divide(x["both"], sums["own"])),
    }


def topic_similarity(person: Column, candidate: Column) -> dict[str, Column]:
    """``similarities`` of two map<id,count>. Where several are wanted, make ``topic_sums`` a column first."""
    return similarities(topic_sums(person, candidate))


def weighted_topic_similarity(person: Column, candidate: Column) -> dict[str, Column]:
    """``weighted_similarities`` of two map<id,count>."""
    return weighted_similarities(topic_sums(person, candidate))


def decay(year: Column, target: Column, alpha: float = 1.0) -> Column:
    return 1 / (1 + alpha * F.abs(year - target))
