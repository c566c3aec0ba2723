"""Hand-worked cases of the operators."""

import json
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from grantlink.functions import expressions as ex
from grantlink.functions import similarity
from grantlink.functions.similarity import best_scores, jaro_winkler, jaro_winklers, name_scores, sequence_ratio, token_set_ratio, token_set_ratios
from grantlink.operators import assemble, author_year, batching, career, citation, coverage, diversity, features, grants, model, normalise, pairs, persons, skew
from grantlink.plans.views import Views
from grantlink.sources import tables
from grantlink.streaming import landing


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_expressions(spark):
    df = spark.createDataFrame([("https://doi.org/10.1/ab",), ("http://x",), (None,)], "x string")
    assert values(df, ex.clean_doi(F.col("x"))) == [("10.1/ab",), (None,), (None,)]
    one = spark.range(1)
    assert values(one, ex.clean_name(F.lit("A. L, Harris;"))) == [("A L Harris",)]
    assert values(one, ex.compact_id(F.lit("W123"))) == [(123,)]
    levels = ex.topic_levels(F.lit("D > F > S > T"), F.lit("1 > 11 > 1110 > 99"))
    assert values(one, levels["topic"]["id"], levels["subfield"]["id"], levels["domain"]["name"]) == [("T99", "1110", "D")]
    two = ex.topic_levels(F.lit("D > F"), F.lit("1 > 11"))
    assert values(one, two["field"]["id"], two["topic"]["id"]) == [("11", None)]
    assert values(one, ex.topic_levels(F.lit("D > F"), F.lit("1"))) == [(None,)]
    assert values(one, F.round(ex.levenshtein_similarity(F.lit("john smith"), F.lit("jon smith")), 6)) == [(0.9,)]
    parts = ex.name_parts(F.lit("Jane Doe"), F.lit("JANE M DOE"))
    assert values(one, *parts.values()) == [(1, 1, 1)]


def test_topic_similarity(spark):
    m = lambda *kv: F.create_map(*[F.lit(x) for x in kv]).cast("map<string,bigint>")
    got = ex.topic_similarity(m("t1", 1, "t2", 1), m("t2", 3, "t3", 1))
    row = spark.range(1).select(*[F.round(c, 6).alias(n) for n, c in got.items()]).first()
    assert row["jaccard"] == pytest.approx(1 / 3, abs=1e-6) and row["cosine"] == 0.67082 and row["js_div"] == 0.52203 and row["containment"] == 0.5
    empty = ex.topic_similarity(F.create_map().cast("map<string,bigint>"), m("t", 1))
    assert values(spark.range(1), *empty.values()) == [(0.0, 0.0, 1.0, 0.0)]


def test_string_scores():
    assert jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert sequence_ratio("John Smith", "Jon Smith") == pytest.approx(0.941176, abs=1e-6)
    assert token_set_ratio("a b c", "b a") == 1.0


@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_scores_are_symmetric_shares(a, b):
    for f in (jaro_winkler, token_set_ratio):
        assert 0 <= f(a, b) <= 1 and f(a, b) == pytest.approx(f(b, a))


def test_author_papers_and_years(spark):
    rows = [("p", 2005, 1.0, 4, [("A", "GB"), ("B", "US"), ("C", ""), ("A", "FR"), ("D", None)])]
    works = spark.createDataFrame(rows, "id string, year int, fwci double, cited_by_count long, authorships array<struct<author_id:string,country:string>>")
    papers = author_year.author_papers(works, spark.createDataFrame([("A",)], "author_id string"), "GB")
    r = papers.first()
    assert (r.n_affils_uk, r.n_affils_abroad, r.n_affils_unknown, r.n_collab_uk, r.n_collab_abroad, r.n_collab_unknown) == (1, 0, 0, 0, 1, 1)
    collabs = author_year.collaborators(works, spark.createDataFrame([("A",)], "author_id string"))
    assert sorted(values(collabs.ids(), "year", "collab_id")) == [(2005, "B"), (2005, "C")] and sorted(values(collabs.countries, "country")) == [("",), ("US",)]
    y = author_year.with_collaborators(author_year.author_years(papers.union(papers)), collabs).first()
    assert (y.n_pubs, y.n_collab_abroad, y.affiliation_countries, y.unique_collab_ids, y.unique_collab_countries) == (2, 2, ["GB"], ["B", "C"], ["US"])
    nobody = author_year.Collaborations(collabs.sets.limit(0), collabs.countries.limit(0), collabs.numbers)
    alone = author_year.with_collaborators(author_year.author_years(papers), nobody).first()
    assert (alone.unique_collab_ids, alone.unique_collab_countries) == ([], [])
    counts = author_year.with_collaborator_counts(author_year.author_years(papers), collabs).first()
    assert (counts.n_collab_ids, counts.n_collab_countries) == (2, 1)


def test_collaborators_against_sets(spark):
    g = random.Random(4)
    people = [f"a{n}" for n in range(150)]
    works = [(n, 2000 + n % 3, [(g.choice([*people, None]), g.choice(["GB", "US", "FR", "", None])) for _ in range(g.choice([0, 1, 3, 8, 140]))]) for n in range(60)]
    given = spark.createDataFrame([(i, y, 1.0, 1, a) for i, y, a in works], "id long, year int, fwci double, cited_by_count long, authorships array<struct<author_id: string, country: string>>").repartition(3)
    matched = people[:40]
    collabs = author_year.collaborators(given, spark.createDataFrame([(p,) for p in matched], "author_id string"))
    ids, places = set(), set()
    for _, year, authors in works:
        first = {}
        for who, where in authors:
            if who is not None:
                first.setdefault(who, where)
        for me in set(matched) & first.keys():
            others = {(w, c) for w, c in first.items() if w != me and c is not None}
            ids |= {(me, year, w) for w, _ in others}
            places |= {(me, year, c) for _, c in others}
    got = values(collabs.ids(), "author_id", "year", "collab_id")
    assert len(got) == len(ids) and set(got) == ids
    assert sorted(values(collabs.countries, "author_id", "year", "country")) == sorted(places)
    numbers = sorted(r.number for r in collabs.numbers.collect())
    assert numbers == list(range(len(numbers)))


def test_a_paper_of_five_thousand_makes_few_rows(spark):
    works = spark.createDataFrame([(1, 2000, [(n, "US") for n in range(5000)]), (2, 2001, [(n, "GB") for n in range(3)])], "id long, year int, authorships array<struct<author_id: long, country: string>>")
    collabs = author_year.collaborators(works, spark.createDataFrame([(n,) for n in range(5000)], "author_id long"))
    words = collabs.sets.where("year = 2000")
    assert words.count() == 5000 * -(-5000 // 64)
    assert words.groupBy("author_id").agg(F.sum(F.bit_count("mask")).alias("n")).select("n").distinct().collect() == [(4999,)]


def test_counts_before_after(spark):
    refs = spark.createDataFrame([("g1", "a", 2006), ("g2", "a", 2005), ("g3", "z", None)], "person_id string, author_id string, ref_year int")
    years = spark.createDataFrame([("a", 2004, 2, 10), ("a", 2005, 1, 5), ("a", 2006, 3, 0)], "author_id string, year int, n_pubs long, cited_by long")
    got = {r.person_id: r for r in career.publication_counts(refs, years, years).collect()}
    g = got["g1"]
    assert (g.n_pubs_before, g.total_citations_pubyear_before, g.mean_citations_pubyear_before, g.citations_pp_pubyear_before) == (3, 15, 7.5, 5.0)
    assert (g.n_pubs_after, g.total_citations_pubyear_after, g.mean_citations_pubyear_after, g.citations_pp_pubyear_after) == (3, None, 0.0, 0.0)
    assert got["g2"].n_pubs_before == 2 and got["g3"].n_pubs_before is None  # two persons share an author


def test_affiliations_and_collaborations(spark):
    refs = spark.createDataFrame([("g", "a", 2000)], "person_id string, author_id string, ref_year int")
    schema = "author_id string, year int, affiliation_countries array<string>, n_affils_uk long, n_affils_abroad long, n_collab_uk long, n_collab_abroad long, fwci double, n_pubs long, cited_by_count long"
    years = spark.createDataFrame([("a", 1998, ["FR", "GB", ""], 1, 2, 1, 1, 1.0, 2, 5), ("a", 1999, ["FR"], 0, 1, 0, 2, 2.0, 1, 0)], schema)
    collabs = author_year.collaborations_of(spark.createDataFrame([("a", 1998, "x", "US"), ("a", 1999, "x", "US"), ("a", 1999, "y", "GB"), ("a", 1999, "x", "")], "author_id string, year int, collab_id string, country string"))
    r = career.affiliations(refs, years, "GB").first()
    assert (r.abroad_fraction_before, r.abroad_experience_before, r.countries_before) == (0.75, True, ["FR"]) and (r.abroad_fraction_after, r.abroad_experience_after, r.countries_after) == (None, None, [])
    c = career.collaborations(refs, years, collabs, "GB").first()
    assert (c.total_collabs_before, c.foreign_collab_fraction_before, c.unique_collabs_before, c.unique_collabs_after) == (4, 0.75, 2, 0)
    assert (c.collab_countries_list_before, c.collab_countries_list_after) == (["US"], [])
    assert values(career.collaboration_country_years(refs, collabs, "GB"), "period", "country", "n_years") == [("before", "US", 2)]
    more = refs.union(spark.createDataFrame([("h", "a", None), ("i", "none", 2000)], refs.schema))
    b = {x.person_id: x for x in career.basic_metrics(more, years, collabs, "GB").collect()}
    assert (b["g"].n_pubs_before, b["g"].mean_fwci_before, b["g"].abroad_fraction_before, b["g"].unique_collabs_before, b["g"].academic_age) == (3, 1.5, 0.75, 2, 2)
    assert (b["h"].n_pubs_before, b["h"].unique_collabs_before, b["h"].collab_countries_list_after, b["h"].first_work_year, b["h"].academic_age) == (None, None, None, 1998, None) and b["i"].total_collabs_after is None


def test_one_to_one(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="not one to one, left: repeated"):
        career.one_to_one(a, spark.createDataFrame([(1,)], "k int"), "k").collect()
    assert values(career.one_to_one(a.limit(1), spark.createDataFrame([(1,), (2,)], "k int"), "k"), "k") == [(1,)]


def test_person_grants(spark):
    rows = [("p", "1", "2001-01-01", "2003-01-01", "Standard", "F", "Active"), ("p", "2", None, "2002-01-01", "Fellowship", "F", "Closed")]
    df = spark.createDataFrame(rows, "person_id string, project_id string, start_date string, end_date string, category string, funder string, status string")
    r = grants.person_grants(df.withColumn("start_date", F.to_date("start_date")).withColumn("end_date", F.to_date("end_date"))).first()
    assert str(r.earliest_start_date) == "2001-01-01" and str(r.latest_end_date) == "2003-01-01" and r.has_active_project and not r.has_multiple_funders and len(r.project_timeline) == 1 and r.number_grants == 2


def test_disruption(spark):
    focal = spark.createDataFrame([(1, [11, 12]), (2, [5])], "id long, referenced_works array<long>")
    citing = spark.createDataFrame([(101, [1, 11]), (102, [1]), (103, [1, 99]), (104, [11]), (102, [1]), (105, None)], "id long, referenced_works array<long>")
    got = {r.focal_id: r for r in citation.disruption(focal, citing).collect()}
    assert (got[1].n_f, got[1].n_b, round(got[1].disruption_index, 6), got[1].status) == (2, 1, 0.333333, "valid")
    assert (got[2].n_f, got[2].n_b, got[2].disruption_index, got[2].status) == (0, 0, None, "calculation_failed")
    di = spark.createDataFrame([("x", 0.5, "valid"), ("y", -0.5, "valid")], "focal_id string, disruption_index double, status string")
    papers = spark.createDataFrame([("x", "a", 2000, 2.0), ("y", "a", 2000, None)], "id string, author_id string, year int, fwci double")
    assert citation.disruption_author_years(papers, di).first().weighted_disruption == pytest.approx(0.495025, abs=1e-6)
    assert citation.disruption_author_years(papers.withColumn("fwci", F.lit(0.0)), di).first().weighted_disruption is None


def test_pruning_quintiles_and_sampling(spark):
    refs = [(i, [r]) for r, n in (("a", 1), ("b", 2), ("c", 3), ("d", 10)) for i in range(n)]
    assert sorted(values(citation.prune_frequent_references(spark.createDataFrame(refs, "id int, referenced_works array<string>")), "reference_id")) == [("a",), ("b",), ("c",)]
    assert {r.quintile for r in citation.impact_quintiles(spark.createDataFrame([(i, 1.0) for i in range(9)], "id int, fwci double")).collect()} == {1}
    rows = spark.createDataFrame([("a", i, 2000, 1) for i in range(60)] + [("b", i, 1900 + i, 2) for i in range(60)], "author_id string, id int, year int, quintile int")
    sample = citation.sample_author_works(rows)
    assert dict(values(sample.groupBy("author_id").count(), "author_id", "count")) == {"a": 50, "b": 50}
    assert sorted(values(sample, "author_id", "id")) == sorted(values(citation.sample_author_works(rows.repartition(7)), "author_id", "id"))


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000])
def test_percentiles_are_exact(spark, n):
    r = random.Random(n)
    values_ = [r.choice([7.5, 7.5, r.gauss(0, 5), float(r.randint(0, 9))]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in [*values_, None]], "v double").repartition(3)
    quantiles = [0.0, 0.2, 0.5, 0.8, 0.97, 1.0]
    got = citation.percentiles(df, "v", quantiles)
    assert got == ([None] * 6 if not n else pytest.approx([float(np.quantile(values_, q)) for q in quantiles]))


def test_percentiles_order_all_doubles(spark):
    odd = [float("nan"), float("inf"), -float("inf"), -0.0, 0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0, 1.0 + 2**-52]
    df = spark.createDataFrame([(v,) for v in odd], "v double")
    got = citation.percentiles(df, "v", [i / 10 for i in range(11)])
    assert list(map(repr, got)) == ["-inf", "-1.7e+308", "-5e-324", "-0.0", "0.0", "5e-324", "1.0", "1.0000000000000002", "1.7e+308", "inf", "nan"]
    assert citation.percentiles(spark.range(100_001).selectExpr("cast(id as double) v"), "v", [0.5, 0.97]) == [50_000, 97_000]


def test_disruption_against_sets(spark):
    g = random.Random(9)
    focal = {n: set(g.sample(range(1000), g.choice([1, 2, 5, 40]))) for n in range(30)}
    cited = {5000 + n: set(g.sample(range(1000), g.choice([0, 1, 3, 60]))) | {g.choice([0, 0, 0, *range(30)]) for _ in range(g.choice([1, 2]))} for n in range(900)}  # work 0 has most citations
    given_focal = spark.createDataFrame([(k, sorted(v)) for k, v in focal.items()], "id long, referenced_works array<long>")
    rows = [(k, sorted(v) * 2) for k, v in cited.items()]
    got = {r.focal_id: (r.n_f, r.n_b) for r in citation.disruption(given_focal, spark.createDataFrame([*rows, rows[0]], "id long, referenced_works array<long>")).collect()}
    for k, own in focal.items():
        fans = [v for v in cited.values() if k in v]
        assert got[k] == (sum(not own & v for v in fans), sum(bool(own & v) for v in fans))


def test_disruption_of_groups(spark):
    g = random.Random(11)
    groups = {(n, n % 7) for n in range(60)} | {(n, 7 + n % 5) for n in range(0, 60, 3)} | {(90, 50)}  # some works are in two groups, 90 is alone
    refs = {n: {m for k, c in groups if k == n for m, d in groups if c == d and m != n} for n, _ in groups}
    edges = [(500 + n, r) for n in range(300) for r in {*g.sample(range(95), g.choice([1, 2, 4])), g.choice([0, 90])}]
    cited = spark.createDataFrame([*edges, *edges[:50], (None, 3), (7, None)], "id long, ref long")
    known = spark.createDataFrame([*groups, (None, 1), (91, None)], "id long, group int")
    lists = spark.createDataFrame([(k, sorted(v)) for k, v in refs.items()], "id long, referenced_works array<long>")
    works = spark.createDataFrame(edges, "id long, ref long").groupBy("id").agg(F.collect_set("ref").alias("referenced_works"))
    columns = ("focal_id", "n_f", "n_b", "status")
    want = sorted(values(citation.disruption(lists, works), *columns))
    assert sorted(values(citation.group_disruption(known, cited), *columns)) == want
    assert sorted(values(citation.group_disruption(known, cited, spark.createDataFrame([(4,), (90,), (4,)], "id long")), *columns)) == [r for r in want if r[0] == 4]


def test_references_of_a_group_are_not_made(spark):
    """20,000 works of one group refer to 4 * 10^8 works: rows of that number are not made."""
    one = spark.range(20_000).select("id", F.lit(1).alias("group"))
    cited = spark.range(40_000).select(F.expr("id div 2").alias("id"), (F.col("id") % 20_000).alias("ref"))
    assert citation.group_disruption(one, cited).agg(F.count("*"), F.sum("n_f"), F.sum("n_b")).first() == (20_000, 0, 40_000)


def test_tiled_join(spark, monkeypatch):
    monkeypatch.setattr(skew, "PAIRS", 10_000)
    left = spark.range(700).select(F.col("id").alias("a"), F.when(F.col("id") < 600, 1).when(F.col("id") < 690, F.col("id") % 9).alias("k"))
    right = spark.range(600).select(F.col("id").alias("b"), F.when(F.col("id") < 500, 1).when(F.col("id") < 590, F.col("id") % 11).alias("k"))
    got = skew.tiled_join(left, right, "k", "a", "b")
    assert got.exceptAll(left.join(right, "k").select(got.columns)).count() == 0 and got.count() == left.join(right, "k").count()
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 20 and max(sizes) < 40_000  # one key has 300,000 pairs
    assert skew.tiled_join(left.where("a < 0"), right, "k", "a", "b").count() == 0


def test_pairs_are_not_shuffled(spark):
    """Only the sides travel: above the join that makes the pairs there is no exchange."""
    from grantlink.plans import linkage
    from grantlink.plans.views import Views

    for f in (linkage.name_features, linkage.institution_features, linkage.metadata_features, linkage.feature_matrix):
        plan = f(Views(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[: plan.index("SortMergeJoin")]


def test_labels_by_classes_of_candidates(spark):
    g = random.Random(4)
    people = spark.createDataFrame([(i, f"N{i % 3}", "X", i % 9 if i % 2 else None) for i in range(60)], "person_id long, first_name string, surname string, orcid_gtr long")
    rows = [(100 + i, g.choice(["a", "b", None]), f"N{i % 4}, X.", g.choice([None, *range(9)]), g.choice([None, 1, 2]), 1, g.choice([None, [], ["u"], ["v", "u"]])) for i in range(200)]
    candidates = spark.createDataFrame(rows, "id long, display_name string, gtr_author_name string, orcid long, works_count int, cited_by_count int, institution_names array<string>")
    want = pairs.label_pairs(pairs.blocking_pairs(people, candidates))
    got = pairs.labelled_pairs(people, candidates).select(want.columns)
    assert got.count() == want.count() > 100 and got.exceptAll(want).count() == 0 and got.where("is_match = 1").count() > 5
    few = candidates.where("gtr_author_name <> 'N1, X.' or orcid is null")  # a block without a positive
    want = pairs.labelled_blocks(pairs.label_pairs(pairs.blocking_pairs(people, few)))
    got = pairs.labelled_pairs(people, few, positive_blocks=True).select(want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() < pairs.labelled_pairs(people, few).count()


def test_best_names_compare_names_not_authors(spark):
    authors = spark.range(3000).select(F.col("id"), F.concat(F.lit("Ann "), F.col("id") % 3).alias("display_name"), (F.col("id") % 2).cast("int").alias("batch"))
    names = spark.createDataFrame([(0, "Ann 1"), (0, "Ann 2"), (1, "Bo")], "batch int, name string")
    out = pairs.best_names(authors, names)
    assert out.columns == ["id", "display_name", "batch", "gtr_author_name", "name_match_score"] and out.count() == 3000
    assert out.where("batch = 0 and display_name = 'Ann 2' and gtr_author_name = 'Ann 2' and name_match_score = 1").count() == 500
    assert out.where("batch = 0 and display_name = 'Ann 0'").select("gtr_author_name").distinct().collect()[0][0] == "Ann 1"


def test_project_authors_are_counted_in_the_row(spark):
    outputs = spark.createDataFrame([("p", "10.1/a"), ("p", "https://doi.org/10.1/a"), ("p", "10.1/b"), ("q", "10.1/c"), ("q", None), ("r", "10.1/d")], "project_id string, doi string")
    works = spark.createDataFrame([("A", "10.1/a", [("x",), ("y",), ("x",)]), ("B", "10.1/b", [("y",), (None,)]), ("C", "10.1/c", []), ("D", "10.1/d", None)], "id string, doi string, authorships array<struct<author_id string>>")
    got = lambda **k: {r[0]: (r[1], r[2] and [tuple(a) for a in r[2]]) for r in persons.project_authors(outputs, works, **k).collect()}
    assert got() == {"p": (["A", "A", "B"], [(None, 1), ("x", 4), ("y", 3)]), "q": (["C"], None), "r": (["D"], None)}
    assert got(distinct_papers=True) == {"p": (["A", "A", "B"], [(None, 1), ("x", 1), ("y", 2)]), "q": (["C"], None), "r": (["D"], None)}
    plan = persons.project_authors(outputs, works)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan


def test_topics_of_a_batch(spark, monkeypatch):
    g = random.Random(6)
    some = lambda: g.choice([None, {}, {g.choice("abcdefgh"): g.randint(0, 9) for _ in range(6)}])
    rows = [(i, *(some() for _ in range(8))) for i in range(300)]
    levels = features.LEVELS
    maps = spark.createDataFrame(rows, "person_id long, " + ", ".join(f"{s}_{x} map<string,bigint>" for x in levels for s in ("person", "candidate"))).withColumn("oa_id", F.col("person_id"))
    got = features.topic_features(maps)
    want = maps.select("person_id", "oa_id", *[c.alias(f"{x}_{n}") for x in levels for n, c in ex.topic_similarity(F.col(f"person_{x}"), F.col(f"candidate_{x}")).items()])
    for a, b in zip(got.orderBy("oa_id").collect(), want.orderBy("oa_id").collect(), strict=True):
        assert tuple(a) == pytest.approx(tuple(b), abs=1e-9)


def test_sides_are_compared_where_they_meet(spark, monkeypatch):
    """Tiles give the features of single pairs, also where maps and lists are null or empty and work comes in parts."""
    g = random.Random(8)
    some = lambda: g.choice([None, {}, {"a": 0}, {g.choice("abcdefgh"): g.randint(0, 9) for _ in range(6)}])
    authors = lambda: g.choice([None, [], [(g.randrange(60), g.randint(1, 5)) for _ in range(9)]])
    names = ["Ann Lee", "Bo", "", None, "Cy de la Mer"]
    people = [(i, g.choice([0, 0, 0, 1, 2, None]), g.choice(names), g.choice(["Uni A", None]), g.choice([None, [], [1, 2, 3]]), authors(), *(some() for _ in range(4))) for i in range(90)]
    people = spark.createDataFrame(people, "person_id long, k int, full_name string, organisation_name string, project_publications array<long>, project_authors array<struct<author_id long, n long>>, " + ", ".join(f"person_{x} map<string,bigint>" for x in features.LEVELS))
    candidates = [(i, g.choice([0, 0, 0, 1, 3, None]), g.choice(names), g.choice([None, [], ["Ann", "bo"]]), g.choice([None, ["Uni B"]]), ["Uni A"], True, 0.5, False, i, 2 * i, 3, 4, *(some() for _ in range(4))) for i in range(60)]
    kinds = "oa_id long, k int, display_name string, display_name_alternatives array<string>, institution_names array<string>, associated_institution_names array<string>, has_home_affiliation boolean, home_affiliation_proportion double, has_home_associated boolean, works_count long, cited_by_count long, h_index long, i10_index long, "
    candidates = spark.createDataFrame(candidates, kinds + ", ".join(f"candidate_{x} map<string,bigint>" for x in features.LEVELS))
    monkeypatch.setattr(skew, "PAIRS", 500)
    monkeypatch.setattr(similarity, "ENTRIES", 7)
    met = people.join(candidates, "k")
    label = F.coalesce(F.exists("project_authors", lambda a: a["author_id"] == F.col("oa_id")), F.lit(False)).cast("int")
    want = features.feature_matrix(met.withColumn("is_match", label)).orderBy("gtr_id", "oa_id").collect()
    got = features.feature_matrix(features.compared(people, candidates, "k").withColumn("is_match", F.col("_known")))
    got = got.orderBy("gtr_id", "oa_id").collect()
    assert len(got) == met.count() > 1000 and got[0].asDict().keys() == want[0].asDict().keys()
    assert sum(r.is_match for r in got) > 20 and any(r.publication_coverage for r in got) and any(r.topic_js_div not in (0, 1) for r in got)
    for a, b in zip(got, want, strict=True):
        assert tuple(a) == pytest.approx(tuple(b), abs=1e-9)
    assert features.compared(people.where("k = 1"), candidates.where("k = 3"), "k").count() == 0


def test_pairs_carry_no_maps(spark):
    """What a pair needs of maps and lists of works is found where the sides meet, and does not travel with it."""
    from grantlink.plans import linkage

    rows = linkage._full_pairs(Views(spark, "/root/testdata/sf0.001"))
    assert not [f.name for f in rows.schema if f.dataType.typeName() == "map" or f.name.startswith("project_")]


def test_pairs_carry_no_names(spark):
    """Names are compared where the sides meet, and do not travel with the pairs."""
    from grantlink.plans import linkage

    rows = linkage._full_pairs(Views(spark, "/root/testdata/sf0.001"))
    assert not {"full_name", "display_name", "display_name_alternatives"} & set(rows.columns)
    assert "name_scores" not in features.feature_matrix(rows)._jdf.queryExecution().executedPlan().toString()


def test_wide_sides_travel_less(spark):
    """Where sides are wide, tiles are large: 33 million pairs take 66,000 and 17,000 rows, not 198,000 and 187,000."""
    people = spark.range(33_000).select(F.col("id").alias("person_id"), F.lit(1).alias("k"))
    candidates = spark.range(1_000).select(F.col("id").alias("oa_id"), F.lit(1).alias("k"))
    rows, others, on = skew.tiles(people, candidates, "k", "person_id", "oa_id", wide=True)
    assert rows.count() <= 2 * 33_000 and others.count() <= 17 * 1_000
    assert rows.groupBy(*on).count().join(others.groupBy(*on).count().withColumnRenamed("count", "m"), on).agg(F.sum(F.col("count") * F.col("m"))).first()[0] == 33_000_000


def test_pairs_carry_features_only(spark):
    """Lists of institutions do not travel with the pairs, nor are pairs joined again."""
    from grantlink.plans import linkage

    rows = linkage._full_pairs(Views(spark, "/root/testdata/sf0.001"))
    assert not [f.name for f in rows.schema if f.dataType.typeName() in ("array", "struct", "string")] and len(rows.columns) == 46
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan[: plan.index("MapInArrow")]


def test_names_are_crossed(spark, monkeypatch):
    """Scores of two lists of names are those of their pairs, whatever their beginnings, lengths and words."""
    from grantlink.plans import linkage

    g = random.Random(5)
    texts = ["", " ", "a", " a", "b a", "a b", "aa b c", *("".join(g.choice("abcé\U0001f600") for _ in range(g.choice([1, 3, 8, 20, 63, 64, 65, 130]))) for _ in range(50)), *(f"Customer#{g.randrange(10**9):09}" for _ in range(30)), *(f"SUPPLIER#{g.randrange(10**6):09}" for _ in range(20))]
    monkeypatch.setattr(similarity, "ACROSS", 30)
    monkeypatch.setattr(similarity, "DOWN", 17)
    i, j = (x.ravel() for x in np.mgrid[: len(texts), : len(texts)])
    for kind, scored in similarity.NAMES.items():
        assert similarity.crossed_scores(kind, texts, texts).ravel().tolist() == scored(texts, texts, i, j).tolist()
    plan = linkage.name_features(Views(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "name_scores" not in plan and "levenshtein" not in plan


def test_rounded_as_round(spark):
    g = random.Random(7)
    values = [None, 0.0, -0.0, float("nan"), float("inf"), -float("inf"), 0.0078125, -0.0078125, 0.0000005, 1.0000005, 2.5, 1e12 + 0.5, 1e300, -1e-9, *(k / 128 for k in range(128)), *(g.random() for _ in range(500)), *(round(g.random(), 7) for _ in range(500))]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(ex.rounded(F.col("v")).alias("a"), F.round("v", 6).alias("b"))
    assert [str(r.a) for r in rows.collect()] == [str(r.b) for r in rows.collect()]
    known = [v for v in values if v is None or v == v]
    want = spark.createDataFrame([(v,) for v in known], "v double").select(F.round("v", 6).alias("b")).collect()
    assert [str(v) for v in similarity.rounded(pa.array(known, pa.float64()), 6).to_pylist()] == [str(r.b) for r in want]
    from grantlink.plans import linkage

    plan = linkage.pair_features(Views(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "rint" not in plan.lower() and "round(" not in plan.lower()


def test_names_and_topics_of_a_tile(monkeypatch):
    """Edit distances of texts of any length, and topics compared as tables and one by one."""
    g = random.Random(9)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, last = [i + 1], row
            for j, y in enumerate(b):
                row.append(min(row[j] + 1, last[j + 1] + 1, last[j] + (x != y)))
        return row[-1]

    texts = ["", "a", *("".join(g.choice("abcé\U0001f600") for _ in range(g.choice([1, 5, 63, 64, 65, 130, 200]))) for _ in range(40)), "ab" * 600]
    a, b = [g.choice(texts) for _ in range(150)], [g.choice(texts) for _ in range(150)]
    want = [1 - plain(x, y) / max(1, len(x), len(y)) for x, y in zip(a, b, strict=True)]
    assert similarity.levenshtein_similarities(a, b).tolist() == want and [similarity.edit_distance(x, y) for x, y in zip(a, b, strict=True)] == [plain(x, y) for x, y in zip(a, b, strict=True)]
    maps = lambda n: pa.array([[*{g.choice("abcdefgh"): g.randint(0, 9) for _ in range(g.randint(0, 9))}.items()] for _ in range(n)], pa.map_(pa.string(), pa.int64()))
    people, candidates = maps(40), maps(30)
    monkeypatch.setattr(similarity, "PART", 500)
    found = []
    for dense in (0, 1000):
        monkeypatch.setattr(similarity, "DENSE", dense)
        rows = similarity.crossed_overlaps(people, candidates).to_pylist()
        found.append([(*r.pop("sums").values(), *r.values()) for r in rows])
    for x, y in zip(*found, strict=True):
        assert x == pytest.approx(y, abs=1e-12)
    same = similarity.crossed_overlaps(people, people).field(0).field(3)
    assert all(same[i * 41].as_py() == 0 for i, m in enumerate(people.to_pylist()) if sum(n for _, n in m))


def test_institutions_are_scored_by_class(spark):
    places = ["Uni A", "Uni B", None]
    people = spark.createDataFrame([(i, i % 2, places[i % 3]) for i in range(40)], "person_id long, k int, organisation_name string")
    lists = [(["Uni A", "Lab"], None), (["Uni B"], ["Uni C"]), ([], ["Uni A"]), (None, [])]
    rows = [(i, i % 2, *lists[i % 4], True, 0.5, False) for i in range(40)]
    candidates = spark.createDataFrame(rows, "oa_id long, k int, institution_names array<string>, associated_institution_names array<string>, has_home_affiliation boolean, home_affiliation_proportion double, has_home_associated boolean")
    met = people.join(candidates, "k")
    want, got = features.institution_features(met), features.institution_features(features.with_institution_scores(met, people, candidates, "k"))
    assert got.count() == want.count() == 800 and got.exceptAll(want).count() == 0 and got.where("inst_jw_max > 0.9").count() > 0


def test_pairs_take_what_is_made_of_sides(spark):
    """Institutions' features are found by the number of both classes, and those of profiles are made before sides meet: no
    list is hashed and nothing is rounded for a pair."""
    from grantlink.plans import linkage

    places = ["Uni A", "Uni B", None]
    people = spark.createDataFrame([(i, i % 2, places[i % 3]) for i in range(40)], "person_id long, k int, organisation_name string")
    lists = [(["Uni A", "Lab"], None), (["Uni B"], ["Uni C"]), ([], ["Uni A"]), (None, [])]
    rows = [(i, i % 2, *lists[i % 4], i % 5 > 0, None if i % 7 else 0.5, False) for i in range(40)]
    candidates = spark.createDataFrame(rows, "oa_id long, k int, institution_names array<string>, associated_institution_names array<string>, has_home_affiliation boolean, home_affiliation_proportion double, has_home_associated boolean")
    want, got = features.institution_features(people.join(candidates, "k")), features.classed_institution_features(people, candidates, "k")
    assert got.columns == want.columns and got.count() == want.count() == 800 and got.exceptAll(want).count() == 0
    x = Views(spark, "/root/testdata/sf0.001")
    for f in (linkage.institution_features, linkage.metadata_features):
        plan = f(x)._jdf.queryExecution().executedPlan().toString()
        assert "round(" not in plan[: plan.index("SortMergeJoin")] and "institution_names" not in plan


def test_tasks_grow_with_rows(spark, monkeypatch):
    from grantlink.plans.views import Views

    few = skew.tasks_for(spark.range(10))
    monkeypatch.setattr(skew, "ROWS", 200)
    assert skew.tasks_for(spark.range(10_000)) == 51 > few
    plan = Views(spark, "/root/testdata/sf0.001").author_subfields()._jdf.queryExecution().optimizedPlan().toString()
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert "RepartitionByExpression [l_orderkey" in plan and str(lines // 200 + 1) in plan


def test_decay_in_the_row(spark):
    g = random.Random(2)
    rows = sorted({(a, y, s): g.randint(1, 9) for a in range(5) for y in g.sample(range(1990, 2010), 6) for s in g.sample("abcde", 3)}.items())
    freq = spark.createDataFrame([(*k, n) for k, n in rows], "author_id long, year int, subfield string, freq long").repartition(3)
    for past in (False, True):
        want = {}
        for (a, y, s), n in rows:
            for t in {k[1] for k, _ in rows if k[0] == a}:
                if not past or y <= t:
                    want[a, t, s] = want.get((a, t, s), 0) + n / (1 + abs(y - t))
        got = {(r.author_id, r.year, r.subfield): r.freq for r in diversity.decayed_frequencies(freq, past_only=past).collect()}
        assert got == pytest.approx(want)


def test_works_without_references_have_no_index(spark):
    focal = spark.createDataFrame([(1, [9]), (2, None), (3, []), (4, [8])], "id long, referenced_works array<long>")
    citing = spark.createDataFrame([(5, [1, 2, 3]), (6, [1, 9])], "id long, referenced_works array<long>")
    assert sorted(values(citation.disruption(focal, citing), "focal_id", "n_f", "n_b")) == [(1, 1, 1), (4, 0, 0)]
    assert values(citation.sampled_disruption(focal, citing, spark.createDataFrame([(1,), (1,), (2,)], "id long")), "focal_id", "n_f") == [(1, 1)]


def test_topic_rows_count_an_author_once(spark):
    works = spark.createDataFrame([(1, 2000, [("a",), ("a",), ("b",)], [("s",), ("s",), (None,)])], "id int, year int, authorships array<struct<author_id:string>>, topics array<struct<subfield:string>>")
    matched = spark.createDataFrame([("a",)], "author_id string")
    assert values(diversity.author_subfield_years(works, matched), "author_id", "subfield", "freq", "n_pubs", "total_publications") == [("a", "s", 2, 1, 1)]
    assert values(diversity.author_subfield_years(works, matched, legacy_duplicates=True), "freq", "n_pubs") == [(4, 1)]


def test_matched_person_grants(spark):
    persons_ = spark.createDataFrame([(1, "A", [10, 11, 12], "x"), (2, "B", [10], None), (3, "C", None, None)], "person_id int, surname string, project_id array<int>, orcid_gtr string")
    projects = spark.createDataFrame([(10, "2001-01-01", "2002-01-01", None, "c", "f", "Active"), (10, "2001-01-01", "2002-01-01", None, "c", "f", "Active"), (11, "bad", None, "2009-01-01", "c", "g", "Closed")], "project_id int, start_date string, end_date string, extended_end string, category string, funder string, status string")
    got = {r.person_id: r for r in grants.matched_person_grants(persons_, projects, spark.createDataFrame([(1,), (3,), (1,)], "gtr_id int")).collect()}
    assert set(got) == {1, 3} and "orcid_gtr" not in got[1].asDict()
    assert (got[1].number_grants, got[1].has_multiple_funders, str(got[1].latest_end_date), got[1].grant_categories[0].n) == (3, True, "2009-01-01", 2)
    assert (got[3].number_grants, got[3].has_multiple_funders, got[3].lead_funders) == (0, False, None)
    s = coverage.person_statistics(persons_.withColumn("project_publications", F.array(F.lit(1)))).first()
    assert (s.persons, round(s.mean_projects, 4), s.mean_publications, s.with_orcid) == (3, 1.3333, 1.0, 1)


def test_sinks_and_unions(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "v int, k string"), spark.createDataFrame([(3, "y")], "v int, k string")
    tables.write_table(a, str(tmp_path / "t"), "k")
    tables.write_table(b, str(tmp_path / "t"), "k")
    assert sorted(values(spark.read.parquet(str(tmp_path / "t")), "v", "k")) == [(1, "x"), (3, "y")]  # only the partition y is replaced
    tables.write_table(b, str(tmp_path / "u"))
    tables.write_table(a, str(tmp_path / "u"))
    assert spark.read.parquet(str(tmp_path / "u")).count() == 2
    lists = spark.createDataFrame([(0, "1|2", 2), (1, "3", 1)], "batch long, ids string, n long")
    tables.write_id_lists(lists, str(tmp_path / "ids"))
    assert sorted(values(tables.read_id_lists(spark, str(tmp_path / "ids")), "batch", "ids", "n")) == [(0, "1|2", 2), (1, "3", 1)]
    joined = tables.union_pages(a, b.drop("k"), b.withColumn("more", F.lit(True)))
    assert joined.columns == ["v", "k", "more"] and joined.count() == 4 and joined.where("k is null and more is null").count() == 1


def test_funds(spark):
    raw = spark.createDataFrame([("f", (5.0,), "x")], "id string, valuePounds struct<amount:double>, links string")
    assert values(normalise.funds(raw), "id", "value") == [("f", 5.0)]


def test_grid_is_searched_with_oversampling_inside_folds(spark):
    r = random.Random(2)
    rows = [(f"g{i}", f"o{i}", int(i % 9 == 0), r.gauss(2 * (i % 9 == 0), 1), r.random()) for i in range(180)]
    matrix = spark.createDataFrame(rows, "gtr_id string, oa_id string, is_match int, x double, y double")
    folds = model.with_folds(matrix, 2)
    assert folds.groupBy("fold", "is_match").count().count() == 4
    found = model.train(matrix, grid={"maxIter": [1, 2], "maxDepth": [2]}, folds=2, oversample=3)
    assert found.stages[-1].getMaxDepth() == 2 and found.stages[-1].getMaxIter() in (1, 2)
    weights = values(model.importances(found, matrix), "feature", "importance")
    assert [w[0] for w in weights][0] == "x" and sum(w[1] for w in weights) == pytest.approx(1)


def test_diversity(spark):
    freq = spark.createDataFrame([("a", 2000, 1, 2), ("a", 2002, 1, 1), ("a", 2002, 2, 3)], "author_id string, year int, subfield int, freq long")
    decayed = diversity.decayed_frequencies(freq)
    got = {(r.year, r.subfield): round(r.freq, 6) for r in decayed.collect()}
    assert got == {(2000, 1): 2.333333, (2000, 2): 1.0, (2002, 1): 1.666667, (2002, 2): 3.0}
    d = spark.createDataFrame([(1, 2, 0.4), (2, 1, 0.4)], "a int, b int, distance double")
    r = diversity.diversity(decayed, d, 4).where("year = 2002").first()
    assert (r.variety, round(r.evenness, 6), r.disparity) == (0.5, 0.849057, 0.4)
    none = diversity.diversity(decayed.withColumn("freq", F.lit(0.1)), d, 4).first()
    assert (none.variety, none.evenness, none.disparity) == (0, 0, 0)
    v = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, [6.0, 8.0])], "k int, v array<double>")
    assert {(r.a, r.b): r.distance for r in diversity.group_distances(v, "k", "v").where("a <= b").collect()} == {(1, 1): 0, (2, 2): 0, (3, 3): 0, (1, 2): 0.5, (2, 3): 0.5, (1, 3): 1}


def test_batches_and_matches(spark):
    ids = spark.createDataFrame([(f"{i:03}",) for i in range(120)] + [(None,), ("000",)], "id string")
    assert sorted(values(batching.id_batches(ids, "id"), "batch", "n")) == [(0, 50), (1, 50), (2, 20)]
    scored = spark.createDataFrame([("g1", "a", 0.9), ("g1", "b", 0.95), ("g2", "c", 0.79)], "gtr_id string, oa_id string, match_probability double")
    assert values(pairs.best_matches(scored), "gtr_id", "oa_id") == [("g1", "b")]
    c = coverage.confusion(spark.createDataFrame([(1, 0.9)] * 2 + [(0, 0.9)] + [(1, 0.1)] + [(0, 0.1)] * 6, "is_match int, match_probability double")).first()
    assert (c.tp, c.fp, c.fn, c.tn, c.accuracy) == (2, 1, 1, 6, 0.8) and c.npv == pytest.approx(6 / 7) and c["for"] == pytest.approx(1 / 7)
    blocks = spark.createDataFrame([("X", 0), ("X", 1), ("Y", 0)], "gtr_author_name string, is_match int")
    assert pairs.labelled_blocks(blocks).count() == 2
    authors = spark.createDataFrame([("1", "John Smith", 0), ("2", "Al", 1)], "id string, display_name string, batch int")
    best = {r.id: r for r in pairs.best_names(authors, spark.createDataFrame([(0, "Jon Smith"), (0, "J. Brown")], "batch int, name string")).collect()}
    assert best["1"].gtr_author_name == "Jon Smith" and best["2"].gtr_author_name == "" and best["2"].name_match_score == 0


def test_landed_json_and_normalising(spark, tmp_path):
    author = {"id": "https://x/A1", "orcid": None, "display_name": "J", "affiliations": [{"institution": {"id": "https://x/I1", "display_name": "U", "country_code": "GB", "type": "e"}, "years": [2000]}]}
    (tmp_path / "a.json").write_text(json.dumps([[author], [author]]))
    rows = normalise.authors(tables.landed_records(spark, str(tmp_path), "author", nested=True))
    assert values(rows, "id", "works_count", F.col("affiliations")[0]["id"]) == [("A1", 0, "I1")] * 2
    work = {"id": "https://x/W1", "doi": "https://doi.org/10.2/z", "publication_date": "1999-05-01", "authorships": [{"author": {"id": "https://x/A1"}, "institutions": [], "author_position": "first"}, {"author": {"id": "https://x/A2"}, "institutions": [{"id": "https://x/I1", "country_code": "GB"}, {"id": "https://x/I2", "country_code": "US"}], "author_position": "last"}], "topics": [], "referenced_works": ["https://x/W9"]}
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "w.json").write_text(json.dumps([work, work]))
    works = normalise.works(tables.landed_records(spark, str(tmp_path / "w"), "work"))
    r = works.first()
    assert r.doi == "10.2/z" and [(a.author_id, a.country) for a in r.authorships] == [("A1", ""), ("A2", "GB"), ("A2", "US")] and r.topics is None
    assert normalise.slim_works(works).count() == 1 and values(normalise.citing_works(works), "id", "referenced_works") == [(1, [9])]
    raw = spark.createDataFrame([("p", 86_400_000, [("x/projects/7", "PROJECT"), ("x/projects/9", "PROJECT")])], "id string, datePublished long, l array<struct<href:string,rel:string>>").select("*", *[F.lit(None).cast("string").alias(c) for c in ("doi", "title", "chapterTitle", "type", "journalTitle", "publicationUrl", "author", "pubMedId", "isbn", "issn")], F.struct(F.col("l").alias("link")).alias("links"))
    p = normalise.publications(raw).first()
    assert p.project_id == "9" and str(p.publication_date) == "1970-01-02"


def test_persons(spark):
    people = spark.createDataFrame([("p", ["1", "2"], "o"), ("q", [], None)], "person_id string, project_id array<string>, organisation string")
    projects = spark.createDataFrame([("1", ["x"]), ("2", ["x", "y"])], "project_id string, project_publications array<string>")
    outputs = spark.createDataFrame([("1", "10.1/a"), ("1", None)], "project_id string, doi string")
    works = spark.createDataFrame([("W1", "10.1/a", [("A", "GB"), ("A", "FR"), ("B", "")]), ("W2", None, [("C", "")])], "id string, doi string, authorships array<struct<author_id:string,country:string>>")
    linked = persons.project_authors(outputs, works)
    topics = spark.createDataFrame([("1", ["t"]), ("2", ["t"])], "project_id string, topics array<string>")
    got = {r.person_id: r for r in persons.aggregate_persons(people, projects, topics, linked, spark.createDataFrame([("o", "Org")], "id string, name string")).collect()}
    assert got["p"].project_publications == ["x", "y"] and got["p"].project_topics == ["t", "t"] and [(a.author_id, a.n) for a in got["p"].project_authors] == [("A", 2), ("B", 1)] and got["p"].organisation_name == "Org"
    assert got["q"].project_publications == []


def test_training_assembles_features_once(spark, monkeypatch):
    """The model is that of the whole pipeline's ``fit``, which assembles in every pass over the rows."""
    rows = [(i, i % 7, int(i % 10 == 0 or i % 11 == 3), float(i % 10) + (i % 7) / 20, float(i % 13)) for i in range(400)]
    m = spark.createDataFrame(rows, "gtr_id long, oa_id long, is_match int, a double, b double").repartition(2, "gtr_id").persist()
    steps = model.pipeline(["a", "b"], maxIter=20, maxDepth=5, stepSize=0.1)
    want = model.score(steps.fit(model.class_weighted(model.filled(m))), m)
    seen = []
    scaler = type(steps.getStages()[1])
    fit = scaler.fit
    monkeypatch.setattr(scaler, "fit", lambda self, df: seen.append(df.storageLevel.useMemory or df._jdf.queryExecution().withCachedData().toString().count("InMemoryRelation") > 0) or fit(self, df))
    got = model.train(m)
    assert values(model.score(got, m).orderBy("gtr_id"), "match_probability") == values(want.orderBy("gtr_id"), "match_probability")
    assert seen == [True] and got.stages[0].getInputCols() == ["a", "b"]


def test_many_training_rows_are_dealt_evenly(spark, monkeypatch):
    """Trees are grown on tasks of about equal sizes, in one order, whatever partitions the rows come in."""
    monkeypatch.setattr(model, "ROWS", 100)
    rows = [(i, i % 7, int(i % 10 == 0 or i % 11 == 3), float(i % 10) + (i % 7) / 20, float(i % 13)) for i in range(900)]
    m = spark.createDataFrame(rows, "gtr_id long, oa_id long, is_match int, a double, b double")
    scaler, sizes = type(model.pipeline(["a", "b"]).getStages()[1]), []
    fit = scaler.fit
    monkeypatch.setattr(scaler, "fit", lambda self, df: sizes.append(values(df.groupBy(F.spark_partition_id().alias("p")).count(), "count", "p")) or fit(self, df))
    scored = [[r.match_probability for r in model.score(model.train(x), m).orderBy("gtr_id").collect()] for x in (m.coalesce(1), m.repartition(5))]
    assert scored[0] == pytest.approx(scored[1], abs=1e-9)
    assert all(len(x) == 10 and max(n for n, _ in x) < 200 for x in sizes) and len(sizes) == 2


def test_model(spark):
    rows = [(f"g{i}", f"o{i}", int(i % 10 == 0), float(i % 10 == 0) + (i % 7) / 20, float(i % 3)) for i in range(300)]
    m = spark.createDataFrame(rows, "gtr_id string, oa_id string, is_match int, a double, b double")
    train, test = model.stratified_split(m, 0.2)
    assert train.count() + test.count() == 300
    scored = model.score(model.train(train, grid={"maxDepth": [2, 3], "maxIter": [3]}, folds=2), test)
    assert coverage.confusion(scored, 0.5).first().f1 == 1.0
    up = model.smote(model.filled(m), k=3)
    counts = dict(values(up.groupBy("is_match").count(), "is_match", "count"))
    assert abs(counts[1] - counts[0]) <= 30 and all(math.isfinite(r.a) for r in up.collect())


def test_oversampling_finds_the_nearest_of_many(spark, monkeypatch):
    r = random.Random(5)
    points = [(0.5 if i % 3 else r.random(), r.random(), r.random() / 4) for i in range(2200)] + [(9.0, 9.0, 9.0)] + [(0.25, 0.25, 0.25)] * 20
    rows = [(str(i), str(i), 1, *x) for i, x in enumerate(points)] + [(f"n{i}", "", 0, 0.0, 0.0, 0.0) for i in range(len(points) + 10)]
    m = spark.createDataFrame(rows, "gtr_id string, oa_id string, is_match int, a double, b double, c double")
    p = np.array(points)
    d = ((p[:, None] - p[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    vectors = m.where("is_match = 1").select(F.array("a", "b", "c").alias("v"))
    for k, block in ((1, 20_000), (9, 100), (9, 20_000)):
        monkeypatch.setattr(model, "BLOCK", block)
        got = {tuple(x.v): x.near for x in model.nearest(vectors, k).collect()}
        assert len(got) == len(set(points))
        for i, v in enumerate(points):
            assert [sum((p[i] - np.array(y)) ** 2) for y in got[v]] == pytest.approx(np.sort(d[i])[:k].tolist(), abs=1e-12)
    made = [x for x in model.smote(m, k=1).collect() if x.gtr_id.startswith("smote-")]
    assert len(made) == len(points)  # the one far from all others has its row, too
    again = {(x.gtr_id, x.a, x.b, x.c) for x in model.smote(m.repartition(7, "a"), k=1).collect() if x.gtr_id.startswith("smote-")}
    assert again == {(x.gtr_id, x.a, x.b, x.c) for x in made}  # partitions play no part
    to = p[d.argmin(1)] - p
    length = np.maximum((to**2).sum(1), 1e-300)
    for x in made:  # on the line from a positive to its nearest one
        y = np.array([x.a, x.b, x.c])
        u = np.clip(((y - p) * to).sum(1) / length, 0, 1)
        assert (((y - p - u[:, None] * to) ** 2).sum(1)).min() < 1e-18


def test_quotas_are_met_to_the_row(spark):
    rows = [(str(i), f"o{i % 7}", int(i % 11 == 0)) for i in range(1003)]
    m = spark.createDataFrame(rows, "gtr_id string, oa_id string, is_match int").repartition(5)
    size = {c: sum(r[2] == c for r in rows) for c in (0, 1)}
    for share in (0.0, 0.1, 0.37, 1.0):
        train_, test_ = model.stratified_split(m, share)
        got = dict(values(test_.groupBy("is_match").count(), "is_match", "count"))
        assert got == {c: n for c in size if (n := math.floor(size[c] * share + 0.5))} and train_.count() + test_.count() == 1003
    folds = model.with_folds(m, 5).groupBy("is_match", "fold").count().collect()
    cuts = {c: [math.floor(size[c] * i / 5 + 0.5) for i in range(6)] for c in size}
    assert sorted((r.is_match, r.fold, r["count"]) for r in folds) == [(c, f, cuts[c][f + 1] - cuts[c][f]) for c in (0, 1) for f in range(5)]
    assert {r.gtr_id for r in model.stratified_split(m)[1].collect()} == {r.gtr_id for r in model.stratified_split(m.coalesce(1))[1].collect()}
    assert model.stratified_split(m.limit(0))[0].count() == 0


def test_wide_table_keeps_its_promises(spark):
    basic = spark.createDataFrame([("p", "a", 1), ("q", "b", 2)], "person_id string, author_id string, n_pubs_before int")
    part = spark.createDataFrame([("a", 0.5)], "author_id string, mean_fwci_before double")
    seen = Observation()
    out = assemble.wide_table(basic, part, order=("mean_fwci_before", "missing", "n_pubs_before"), observation=seen)
    assert out.columns == ["mean_fwci_before", "n_pubs_before"] and sorted(out.collect(), key=repr) == [(0.5, 1), (None, 2)]
    assert seen.get == {"rows": 2, "rows_part_0": 1}
    with pytest.raises(Exception, match="part 0: repeated"):
        assemble.wide_table(basic, part.union(part)).collect()


def test_metrics_table_has_the_fixed_columns(spark):
    works = spark.createDataFrame([(1, 1998, 2.0, 4, [("a", "GB"), ("x", "US")]), (2, 2003, 1.0, 1, [("a", "FR"), ("y", "GB")])], "id long, year int, fwci double, cited_by_count long, authorships array<struct<author_id: string, country: string>>")
    who = spark.createDataFrame([("a",)], "author_id string")
    years, collabs = author_year.author_years(author_year.author_papers(works, who, "GB")), author_year.collaborators(works, who)
    authors = spark.createDataFrame([("a", "p", 10, 20, [("GB",)], [(1998, 2, 6), (2003, 1, 3)], "note")], "id string, gtr_id string, works_count int, cited_by_count int, last_known_institutions array<struct<country: string>>, counts_by_year array<struct<year: int, works_count: int, cited_by_count: int>>, extra string")
    people = spark.createDataFrame([("p", "2000-05-01", "Ada", ["t"])], "person_id string, earliest_start_date string, first_name string, project_topics array<string>")
    people = people.withColumn("earliest_start_date", F.to_date("earliest_start_date"))
    out = assemble.metrics_table(authors, people, years, collabs, "GB")
    assert out.columns == [c for c in assemble.COLUMNS if c in out.columns] and len(out.columns) > 40
    r = out.first()
    assert (r.oa_id, r.gtr_person_id, r.first_name, r.gtr_project_topics, r.last_known_institution_uk, r.citations_per_publication, r.academic_age_at_first_grant) == ("a", "p", "Ada", ["t"], True, 2.0, 2)
    assert (r.collab_countries_before, r.collab_countries_after, r.collab_countries_list_before, r.mean_citations_before, r.citations_pp_before, r.n_pubs_after) == ({"US": 1}, {}, ["US"], 6.0, 3.0, 1)
    with pytest.raises(Exception, match="author: repeated"):
        assemble.metrics_table(authors.union(authors.withColumn("id", F.lit("b"))), people, years, collabs, "GB").collect()


def test_disruption_series_of_works(spark):
    works = spark.createDataFrame([(1, 2000, 2.0, [("a",), ("a",), ("b",)]), (2, 2000, None, [("a",)]), (3, 2000, 1.0, [("a",)])], "id long, year int, fwci double, authorships array<struct<author_id: string>>")
    di = spark.createDataFrame([(1, 0.5, "valid"), (2, -0.5, "valid")], "focal_id long, disruption_index double, status string")
    got = values(citation.disruption_series(works, spark.createDataFrame([("a",)], "author_id string"), di), "author_id", "year", "mean_disruption", "weighted_disruption")
    assert got == [("a", 2000, 0.0, 0.5)]


def test_distances_in_tiles(spark, monkeypatch):
    g = np.random.default_rng(6)
    rows = [(f"k{n % 40}", g.normal(size=12).tolist()) for n in range(120)]
    v = spark.createDataFrame(rows, "k string, v array<double>").repartition(3)
    mean = {k: np.mean([x for n, x in rows if n == k], axis=0) for k, _ in rows}
    largest = max(np.linalg.norm(a - b) for a in mean.values() for b in mean.values())
    for tile in (512, 5):
        monkeypatch.setattr(diversity, "TILE", tile)
        got = {(r.a, r.b): r.distance for r in diversity.group_distances(v, "k", "v").collect()}
        assert len(got) == 1600 and got == pytest.approx({(a, b): np.linalg.norm(mean[a] - mean[b]) / largest for a in mean for b in mean})
    assert diversity.group_distances(v.limit(0), "k", "v").count() == 0


def test_batch_encoder_loads_for_batches(spark):
    def load():
        return lambda labels: [[len(x), x.count("a")] for x in labels]

    labels = spark.createDataFrame([("s1", "aa"), ("s2", "b"), ("s3", None)], "subfield_id string, label string")
    got = {(r.a, r.b): r.distance for r in diversity.label_distances(labels, diversity.batch_encoder(load)).collect()}
    assert got == {("s1", "s1"): 0, ("s2", "s2"): 0, ("s1", "s2"): 1, ("s2", "s1"): 1}


def test_stateless_landing_knows_old_ids(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for n, rows in enumerate([[("1", "a"), ("2", "b"), ("1", "c")], [("2", "d"), ("3", "e")], [("1", "f"), ("3", "g"), ("4", "h")]]):
        spark.createDataFrame(rows, "id string, v string").coalesce(1).write.mode("append").parquet(source)
        landing.land_stream(spark, source, "id string, v string", out, state, stateless=True).awaitTermination()
        assert sorted(values(spark.read.parquet(out), "id")) == [(str(i),) for i in range(1, (2, 3, 4)[n] + 1)]
    assert not (tmp_path / "state" / "state").exists()  # nothing grows but the table
    assert dict(values(spark.read.parquet(out), "id", "v"))["3"] == "e"


def test_streamed_landing(spark, tmp_path):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("1", "c")], "id string, v string")
    df.write.parquet(str(tmp_path / "in"))
    landing.land_stream(spark, str(tmp_path / "in"), "id string, v string", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(values(spark.read.parquet(str(tmp_path / "out")), "id")) == [("1",), ("2",)]
    assert values(landing.new_records(df, df.where("id = '1'")), "id") == [("2",)]


def test_saved_versions_are_evaluated(spark, tmp_path):
    rows = [(str(i), str(i), int(i % 4 == 0), float(i % 4 == 0) + (i % 7) / 20) for i in range(400)]
    matrix = spark.createDataFrame(rows, "gtr_id string, oa_id string, is_match int, x double")
    tables.save_model(model.train(model.stratified_split(matrix)[0]), str(tmp_path), "v1")
    got = model.evaluate_versions(spark, str(tmp_path), ["v1"], matrix).collect()
    assert [r.version for r in got] == ["v1"] and got[0].f1 == got[0].roc_auc == got[0].average_precision == 1
    assert got[0].tp + got[0].tn == model.stratified_split(matrix)[1].count()


def test_ranking_measures(spark):
    scored = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (1, 0.3), (0, 0.1)], "is_match int, match_probability double")
    r = coverage.ranking_measures(scored).first()
    # of the six pairs of a match and another row four are in order and one is a tie
    assert r.roc_auc == pytest.approx(4.5 / 6) and r.average_precision == pytest.approx((1 + 2 / 3 + 3 / 4) / 3)
    none = coverage.ranking_measures(scored.where("is_match = 1")).first()
    assert none.roc_auc is None and coverage.ranking_measures(scored.limit(0)).first().average_precision is None


def test_series_and_taxonomy(spark):
    years = spark.createDataFrame([(1, 2001, 0.125), (1, 2000, 0.335), (2, 2000, None)], "author_id int, year int, d double")
    series = diversity.yearly_series(years, 2, "d")
    assert {(r.author_id, tuple(map(tuple, r.series))) for r in diversity.collected_series(series, "d").collect()} == {(1, ((2000, 0.34), (2001, 0.12))), (2, ((2000, None),))}
    entries = spark.createDataFrame([("a", "1", 0), ("a > b", "1 > 11", 1), ("a > b > c", "1 > 11 > 1110", 2)], "label string, id_path string, level int")
    assert diversity.taxonomy_subfields(entries).collect() == [("1110", "a > b > c")]


def test_odd_transpositions():
    """Three letters out of place are one transposition."""
    assert jaro_winkler("abcxyz", "bcaxyz") == pytest.approx((1 + 1 + 5 / 6) / 3)


def plain_ratio(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


def plain_token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common, own, other = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    with_own, with_other = f"{common} {own}".strip(), f"{common} {other}".strip()
    sides = [plain_ratio(common, with_own), plain_ratio(common, with_other)] if common else []
    return max([plain_ratio(with_own, with_other), *sides])


@given(st.lists(st.tuples(st.text("abé \U0001f600", max_size=80), st.text("abé \U0001f600", max_size=80)), min_size=1, max_size=20))
def test_batched_scores_are_those_of_single_pairs(pairs):
    a, b = map(list, zip(*pairs, strict=True))
    assert list(jaro_winklers(a, b)) == pytest.approx([jaro_winkler(x, y) for x, y in pairs], abs=1e-12)
    assert list(token_set_ratios(a, b)) == pytest.approx([plain_token_set(x, y) for x, y in pairs], abs=1e-12)


@given(st.lists(st.text("ab é\U0001f600", max_size=80), min_size=1, max_size=6), st.lists(st.text("ab é\U0001f600", max_size=80), min_size=1, max_size=6))
def test_scores_of_a_table_of_names(a, b):
    """Few distinct strings with all pairs of them: each is laid out once."""
    i, j = (g.ravel() for g in np.indices((len(a), len(b))))
    assert list(jaro_winklers(a, b, i, j)) == pytest.approx([jaro_winkler(x, y) for x in a for y in b], abs=1e-12)
    assert list(token_set_ratios(a, b, i, j)) == pytest.approx([plain_token_set(x, y) for x in a for y in b], abs=1e-12)


def test_names_are_scored_in_their_row(spark):
    rows = [(1, "ann lee", ["lee ann", None, "x" * 70 + " lee"]), (2, None, ["a"]), (3, "b", None), (4, "", [])]
    df = spark.createDataFrame(rows, "id int, name string, others array<string>").repartition(1)
    got = {r.id: r.s for r in df.select("id", name_scores("name", "others").alias("s")).collect()}
    assert [None if x.token is None else round(x.token, 6) for x in got[1]] == [1.0, None, round(plain_token_set("ann lee", "x" * 70 + " lee"), 6)]
    assert got[1][0].jw == pytest.approx(jaro_winkler("ann lee", "lee ann")) and got[1][1].jw is None
    assert [tuple(x) for x in got[2]] == [(None, None)] and got[3] == [] and got[4] == []


def test_landed_batches_are_united(spark, tmp_path):
    author = {"id": "https://x/A1", "display_name": "J", "gtr_author_name": "J.", "name_match_score": 0.5}
    for n, page in enumerate(([[author], []], [[author | {"id": "https://x/A2"}]])):
        (tmp_path / f"a{n}").mkdir()
        (tmp_path / f"a{n}" / "page.json").write_text(json.dumps(page))
    paths = [str(tmp_path / f"a{n}") for n in range(2)]
    assert "gtr_author_name" not in tables.landed_authors(spark, *paths).columns
    rows = tables.landed_authors(spark, *paths, include_match_info=True)
    assert sorted(values(rows, "id", "gtr_author_name", "name_match_score")) == [("A1", "J.", 0.5), ("A2", "J.", 0.5)]
    (tmp_path / "i").mkdir()
    (tmp_path / "i" / "page.json").write_text(json.dumps([[{"id": "https://x/I1", "associated_institutions": [{"id": "https://x/I2", "display_name": "C", "country_code": "GB", "relationship": "child"}]}], []]))
    assert values(tables.landed_institutions(spark, str(tmp_path / "i")), "id", F.col("associated_institutions")[0]["id"]) == [("I1", "I2")]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "page.json").write_text(json.dumps([{"id": "https://x/W1", "referenced_works": []}]))
    assert values(tables.landed_works(spark, str(tmp_path / "w"), str(tmp_path / "w")), "id") == [("W1",)] * 2


def test_labels_have_distances(spark):
    labels = spark.createDataFrame([(1, "Organic chemistry"), (2, "organic Chemistry"), (3, "Law"), (4, None)], "subfield_id int, label string")
    got = {(r.a, r.b): r.distance for r in diversity.label_distances(labels).collect()}
    assert got[1, 2] == 0.0 and got[1, 3] == got[3, 1] == 1.0 and not any(4 in k for k in got)


def long_pairs(n):
    g = random.Random(n)
    word = lambda k: "".join(g.choice("abcd é") for _ in range(k))
    a = [word(g.choice([0, 1, 3, 10, 60, 64, 65, 130, 300, 1200])) for _ in range(n)]
    return a, [(x[: g.randint(0, len(x))] + word(g.choice([0, 2, 9, 70]))) if g.random() < 0.5 else word(g.choice([0, 1, 5, 64, 66, 200])) for x in a]


def test_strings_of_several_words_score_as_single_pairs():
    a, b = long_pairs(300)
    assert list(jaro_winklers(a, b)) == [jaro_winkler(x, y) for x, y in zip(a, b, strict=True)]
    assert list(similarity._batched(similarity._lcs_lengths, similarity.lcs_length, a, b, np.int64)) == [similarity.lcs_length(x, y) for x, y in zip(a, b, strict=True)]


def test_bounds_lose_no_best_score(monkeypatch):
    a, b = long_pairs(400)
    row, place = np.sort(np.array([random.Random(i).randint(0, 79) for i in range(400)])), np.arange(400)
    for kind in ("jw", "token"):
        score = similarity.SCORES[kind](a, b)
        assert (similarity.BOUNDS[kind](a, b) >= score).all()
        made = []
        monkeypatch.setitem(similarity.SCORES, kind, lambda x, y, f=similarity.SCORES[kind], made=made: made.append(len(x)) or f(x, y))
        got = similarity.best_of(row, 90, a, b, place, kind)
        want = [max((score[i] for i in np.flatnonzero(row == r)), default=math.nan) for r in range(90)]
        assert list(got) == pytest.approx(want, nan_ok=True) and sum(made) < 400


def test_best_scores_of_rows(spark):
    rows = [("x y", ["x", "y x", None]), ("abc", ["abd", "abd", "zzz"]), (None, ["a"]), ("a", None), ("a", []), ("", [""])]
    got = [r.s for r in spark.createDataFrame(rows, "n string, o array<string>").coalesce(1).select(best_scores("n", "o").alias("s")).collect()]
    assert (got[0].token, got[1].jw) == (1.0, jaro_winkler("abc", "abd")) and [(r.jw, r.token) for r in got[2:5]] == [(None, None)] * 3
    assert (got[5].jw, got[5].token) == (1.0, 0.0)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_collaborations_are_kept_and_people_are_made_once(spark):
    works = spark.createDataFrame([(1, 2000, [("a", "US"), ("b", "US"), ("c", None)]), (2, 2001, [("c", "GB"), ("a", "FR"), (None, "GB"), ("c", "US")]), (3, 2001, [])], "id long, year int, authorships array<struct<author_id: string, country: string>>")
    people = author_year.with_people(works)
    assert author_year.with_people(people) is people  # works that have their people are not searched again
    got = {r.id: [tuple(p) for p in r.people] for r in people.collect()}
    assert got == {1: [("a", 0, "US"), ("b", 1, "US"), ("c", 2, None)], 2: [("a", 1, "FR"), ("c", 0, "GB")], 3: []}
    collabs = author_year.collaborators(people.drop("authorships"), spark.createDataFrame([("a",)], "author_id string"))
    assert not any(word in _plan(df) for df in (collabs.sets, collabs.countries) for word in ("Exchange", "Join"))
    assert sorted(values(collabs.ids(), "year", "collab_id")) == [(2000, "b"), (2001, "c")] and sorted(values(collabs.countries, "year", "country")) == [(2000, "US"), (2001, "GB")]


def test_tables_that_several_steps_use_are_made_once(spark):
    x = Views(spark, "/root/testdata/sf0.001")
    assert x.matched() is x.matched() and "Join" not in _plan(x.refs())


def test_a_sample_deals_rows_by_author_once(spark):
    rows = spark.createDataFrame([("a", n, 2000 + n % 3 if n % 7 else None, 1 + n % 5) for n in range(60)] * 2, "author_id string, id long, year int, quintile int")
    out = citation.sample_author_works(rows, per_author=9)
    assert _plan(out).count("Exchange") == 1
    by_year = [r["count"] for r in out.groupBy("year").count().collect()]
    assert out.count() == 9 and max(by_year) <= 3


def test_tasks_of_decayed_frequencies_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS", 100)
    freq = spark.range(2000).select((F.col("id") % 200).alias("author_id"), (2000 + F.col("id") % 5).cast("int").alias("year"), F.col("id").alias("subfield"), F.lit(1).cast("bigint").alias("freq"))
    out = diversity.decayed_frequencies(freq)
    assert ", 21)" in _plan(out).replace("REPARTITION_BY_NUM", "") and out.count() == 2000
