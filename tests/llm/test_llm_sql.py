"""The corpus queries that have SQL give DuckDB's rows, on the smallest tables and on odd ones."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from grantlink.llm import queries

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "conversations")

PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
TEXTS = [
    None, "", " \n", PASSAGE, PASSAGE.upper() + "! " + "x " * 300, "a " + PASSAGE + " and " + PASSAGE + " b", "Short ITEM", "a short, item - short item", "short\x00item", "é" * 40 + " short item",
    'password = "hunter22x9" PASSWD:abcdefg9 Token=short api-key: zzzzzz99 apiKey=\'Q1w2E3r4T5\'', "AKIA" + "A1" * 10 + "AKIAAKIA" + "B" * 20, "deadbeef" * 3 + "g" + "0123456789abcdef" * 2,
    "éé secret:日本 secret:abc.def-9/+_= ghp_" + "a1B2" * 8 + " -----BEGIN RSA PRIVATE KEY----- Key toKen=abcdefgh paſſword=abcdefgh", "token=aaaaaa1", "token=aaaaaa1", "token=Ab3dEf7hIj",
]
LINK = '<html><head><LINK href="{0}" REL=canonical></head>'
PAGES = [
    (1, "http://www.Example.com/en/a", None), (2, "https://m.example.com/en/x?utm_source=q&k=1", ""), (3, "http://a.net/es/1", "<p>"), (4, None, "<p>"), (5, "no scheme", LINK.format("http://a.net/es/1")),
    (6, "http://b.org/x", LINK.format("http://a.net/es/1/")), (7, "http://c.org/y", '<meta http-equiv="Refresh" content="0; url=http://b.org/x">'), (8, "http://d.org/", LINK.format("/deep?a=1&amp;b=2")),
    (9, "http://d.org/deep?a=1&b=2&ref=z", LINK.format("//c.org/y")), (10, "http://e.org/p/q", LINK.format("r")), (11, "http://e.org/p/r", LINK.format("http://w.com/")), (12, "http://e.org/p/r", LINK.format("http://n.net/fr/")),
    (17, "http://g.org/two", LINK.format("http://h.org/1") + LINK.format("http://a.net/es/1") + '<meta content="1;URL=http://h.org/2" http-equiv=refresh>'), (18, "http://h.org/2", "<p>" * 60_000), (19, "http://i.org/", "<!-- " + LINK.format("http://a.net/es/1") + "\n--><script>'" + LINK.format("http://a.net/es/1") + "'</script>"),
    (20, "http://a.org/login", LINK.format("/go?x=http://example.com/en/x")), (21, "http://a.org/go?x=http://example.com/en/x", None), (22, "http://a.org/hyphen", '<link data-rel="canonical" rel="next" href="http://example.com/en/x">'),
    (23, "http://a.org/hyphen2", '<link data-href="q" rel=canonical href="http://a.net/es/1">'), (24, "http://a.org/z/y", '<link rel="canonical" href="../w">'), (25, "http://u@A.org:80/w", LINK.format("//N.net:80/./fr/x/..")),
    (26, "http://a.org/s/t", "<base href='http://n.net/fr/'>" + LINK.format("k")), (27, "http://n.net/fr/k", None), (28, "https://p.org:443/1", '<a title="' + LINK.format("x").replace('"', "") + '"><title>' + LINK.format("http://a.net/es/1") + "</title>" + LINK.format("mailto:a@b")),
    (29, "http://q.org/", '<link title="a > b" rel="alternate Canonical" href=http://a.net/es/1>'), (30, "http://r.org/", "<textarea>" + LINK.format("http://a.net/es/1")), (31, "http://s.org/", "<!-->" + LINK.format("?k") + "<!-- " + LINK.format("http://a.net/es/1")), (32, "http://s.org/?k", None),
    (13, "http://n.net/fr/", None), (14, "http://w.com", None), (None, "http://e.org/p/r", None), (16, "http://f.org?x", '<link rel="stylesheet" href="http://a.net/es/1"><link rel="canonical"><link rel=canonical href=/z>'),
]


def rows_of(names, rows):
    plain = lambda v: v if v is None or isinstance(v, (str, bool)) else int(v)
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    n = len(TEXTS)
    documents = {"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(TEXTS, pa.string()), "lang": pa.array([("en", None, "de")[i % 3] for i in range(n)]), "source": pa.array([(f"s{i % 4}", None)[i % 5 == 0] for i in range(n)]), "row": pa.array(range(n), pa.int64())}
    ids, addresses, html = zip(*(PAGES + PAGES[5:7]), strict=True)
    pages = {"page_id": pa.array(ids, pa.int64()), "url": pa.array(addresses, pa.string()), "html": pa.array(html, pa.string())}
    benchmark = {"item_id": pa.array([2, 10, 3, None, 5, 6, 7], pa.int64()), "text": pa.array([PASSAGE, "Short item", None, "and one", "", "x x x", PASSAGE + " and"], pa.string())}
    turns = [(7, None, None, None), (7, 0, "user", "a"), (7, 0, "system", "b"), (None, 1, "user", "x"), *((c, t, "user", f"t{t}") for c in (-3, 5, 6, 8, 9, 10) for t in range(c % 4 * 9))]
    conversations = {n: pa.array(v, k) for n, v, k in zip(("conv_id", "turn", "role", "text"), zip(*turns, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)}
    for name, columns in (("conversations", conversations), ("documents", documents), ("pages", pages), ("benchmark", benchmark)):
        pq.write_table(pa.table(columns), folder / f"{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("place", ["given", "odd", "empty"])
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, odd, tmp_path, name, place):
    folder = {"given": FOLDER, "odd": odd, "empty": str(tmp_path)}[place]
    duck = duckdb.connect()
    for t in TABLES:
        if place == "empty":
            pq.write_table(pq.read_table(f"{odd}/{t}.parquet").slice(0, 0), tmp_path / f"{t}.parquet")
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    result = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    df = queries.QUERIES[name](spark, folder)
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())
