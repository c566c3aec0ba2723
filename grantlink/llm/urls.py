"""URL filters with redirect equivalence.

Rules judge the urls that they fit; the longest rule wins. Other pages take the decision of their aliases: urls that
redirects and canonical links connect, directly or over others, found as connected components. Inside a component an
explicit allow has precedence over a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, keep, table, with_row

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to so many rules are tried as an expression; more are joined.
INLINE_RULES = 200
#: One piece of markup after the other: a comment, an element whose content is no markup, or a tag. Quotes only count
#: after an equals sign. What is never closed reaches to the end of the page, so every character is passed once.
_ATTRIBUTES = r"""(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>=]++|=){0,400}+"""
MARKUP = rf"""(?is)<!--(?:-?>|.*?(?:--!?>|\z))|<(script|style|textarea|title)(?=[\s/>]){_ATTRIBUTES}.*?(?:</\1(?=[\s/>])|\z)|<[a-z/]{_ATTRIBUTES}"""
#: A tag's attribute: its name, and its value in one of three groups.
ATTRIBUTE = r"""(?<=[\s"'/])([^\s"'>/=]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))"""
REFRESH = r"""(?is)^[\s\d.,;]*url\s*=\s*["']?([^"'\s]+)"""
SCHEME = r"(?i)^[a-z][a-z0-9+.-]*:"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def _inline(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (host, path), as text and verdict; of equally long ones an allow, then the greatest host."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[0] == "allow", r[1], r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def judged_by_rules(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Adds rule and rule_verdict to rows (row, host, path, ...). Many rules meet the suffixes of hosts in a join."""
    if len(rules) <= INLINE_RULES:
        rule, verdict = _inline(rules)
        return urls.withColumn("rule", rule).withColumn("rule_verdict", verdict)
    listed = urls.sparkSession.createDataFrame(rules, "rule_verdict string, rule_host string, rule_path string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = urls.select("row", "path", F.explode(suffixes).alias("rule_host")).join(listed, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    name = F.concat("rule_host", "rule_path")
    allow = (F.col("rule_verdict") == "allow").alias("allow")
    best = each.groupBy("row").agg(F.max(F.struct(F.length(name).alias("n"), allow, "rule_host", "rule_path", "rule_verdict")).alias("b"))  # ties as in _inline
    return urls.join(best.select("row", F.concat("b.rule_host", "b.rule_path").alias("rule"), "b.rule_verdict"), "row", "left")


def without_dots(path: Column) -> Column:
    """A path whose . and .. segments are resolved, as RFC 3986 does."""
    keep_or_pop = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), lambda done, x: F.when(x == ".", done).when(x == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)).otherwise(F.concat(done, F.array(x))))
    return F.when(path.contains("/."), F.array_join(keep_or_pop, "/")).otherwise(path)


def node_of(url: Column) -> Column:
    """A url's node: 128 bits (MD5) of host, path without dot segments and last slash, and query without the usual
    tracking parameters. The host is taken without a user and without its scheme's usual port."""
    query = F.regexp_replace(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), r"(^|&)(utm_\w+|ref|fbclid|gclid)=[^&]*", "")
    host, secure = F.regexp_replace(host_of(url), "^.*@", ""), F.lower(F.substring(url, 1, 6)) == "https:"
    host = F.when(secure, F.regexp_replace(host, ":443$", "")).otherwise(F.regexp_replace(host, ":80$", ""))
    return F.md5(F.concat_ws("\n", host, F.regexp_replace(without_dots(path_of(url)), "/$", ""), F.regexp_replace(query, "^&", "")))


def resolved(base: Column, target: Column) -> Column:
    """The url that a link on ``base`` leads to, as RFC 3986 resolves it; null for a link to the page itself and for
    schemes without ://, such as mailto:."""
    scheme, root = F.regexp_extract(base, r"(?s)^(.*?:)//", 1), F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(path_of(base), r"(?s)^/(.*/)?", 1))
    absolute = F.when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), target)
    return (
        F.when((target == "") | target.startswith("#"), None).when(target.rlike(SCHEME), absolute).when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("/"), F.concat(root, target)).when(target.startswith("?"), F.concat(root, path_of(base), target)).otherwise(F.concat(root, folder, target))
    )


def links_of(url: Column, html: Column) -> Column:
    """The distinct urls that a page's canonical links and refreshes lead to. A tag's first attribute of a name counts,
    and so does the page's first base. A tag of more than about 200 attributes ends there, as Java's patterns recurse."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(MARKUP), F.lit(0)), lambda t: t.rlike(r"(?i)^<(link|meta|base)[\s/]"))
    group = lambda t, n: F.regexp_extract_all(t, F.lit(ATTRIBUTE), F.lit(n))
    joined = lambda x, y: F.concat(x, y)
    parsed = F.transform(tags, lambda t: F.struct(F.lower(F.substring(t, 2, 4)).alias("tag"), F.transform(group(t, 1), F.lower).alias("names"), F.zip_with(group(t, 2), F.zip_with(group(t, 3), group(t, 4), joined), joined).alias("values")))
    # a place of 0 asks for the element past the end, which is null
    value = lambda p, name: F.get(p["values"], F.array_position(p["names"], name).cast("int") - 1)
    clean = lambda c: F.btrim(F.regexp_replace(c, "(?i)&amp;", "&"))
    canonical = F.filter(parsed, lambda p: (p["tag"] == "link") & F.array_contains(F.split(F.lower(value(p, "rel")), r"\s+"), "canonical"))
    refresh = F.filter(parsed, lambda p: (p["tag"] == "meta") & (F.btrim(F.lower(value(p, "http-equiv"))) == "refresh"))
    targets = F.concat(F.transform(canonical, lambda p: clean(value(p, "href"))), F.transform(refresh, lambda p: clean(F.nullif(F.regexp_extract(value(p, "content"), REFRESH, 1), F.lit("")))))
    bases = F.filter(F.transform(F.filter(parsed, lambda p: p["tag"] == "base"), lambda p: clean(value(p, "href"))), lambda b: b.isNotNull())
    base = F.coalesce(resolved(url, F.get(bases, F.lit(0))), url)
    return F.array_distinct(F.filter(F.transform(targets, lambda t: resolved(base, t)), lambda t: t.isNotNull()))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, alias_id (the smallest page_id among its aliases and itself).

    ``redirects``: further edges (url, target) as a crawler logs them. Without a rule of its own a page is allowed if an
    alias has an allow rule, else blocked if an alias has a block rule, else allowed. A null url, or one without ://, has
    an empty host and path, no rule, no aliases and a null alias_id, and is allowed. All canonical and refresh links of
    a page count, but those in comments, scripts, styles, titles and text areas (never closed, these reach to the end).
    Null html has no links; very long pages are read whole, in one pass.
    Repeated rows stay. A null page_id names no component that has another id. Other columns play no part.
    """
    url = F.col("url")
    known = url.contains("://")
    rows = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"), F.when(known, links_of(url, F.col("html"))).alias("targets"))
    rows = keep(with_row(rows.withColumn("node", F.when(known, node_of(url)))))
    edges = rows.where("node is not null and size(targets) > 0").select(F.col("node").alias("a"), F.explode("targets").alias("target")).select("a", node_of(F.col("target")).alias("b"))
    if redirects is not None:
        edges = edges.union(redirects.where("url is not null and target is not null").select(node_of(F.col("url")), node_of(F.col("target"))))
    judged = keep(judged_by_rules(rows.select("row", "page_id", "host", "path", "node"), list(rules)))
    roots = components(edges.distinct())
    linked = judged.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # a component's decision comes from its ruled pages (bool_or skips nulls) and is counted with a map-side part
    decided = linked.where("node is not null").groupBy("root").agg(F.bool_or(F.col("rule_verdict") == "allow").alias("allowed"), F.min("page_id").alias("alias_id"))
    decided = decided.select("root", "alias_id", F.when(F.col("allowed"), "allow").when(~F.col("allowed"), "block").alias("alias_verdict"))
    out = linked.join(decided, "root", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", "alias_verdict", F.lit("allow")).alias("verdict"), "alias_id")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def _sql_host(url: str) -> str:
    return f"translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"


def _sql_path(url: str) -> str:
    return f"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _sql_node(url: str) -> str:
    """The text that node_of() hashes."""
    host = f"regexp_replace(regexp_replace({_sql_host(url)}, '^.*@', ''), CASE WHEN lower(left({url}, 6)) = 'https:' THEN ':443$' ELSE ':80$' END, '')"
    segments = f"list_transform(string_split({_sql_path(url)}, '/'), lambda x: [x])"
    step = "CASE WHEN x[1] = '.' THEN d WHEN x[1] = '..' THEN CASE WHEN len(d) > 1 THEN d[1:len(d) - 1] ELSE d END ELSE list_concat(d, x) END"
    path = f"regexp_replace(array_to_string(list_reduce({segments}, lambda d, x: {step}), '/'), '/$', '')"
    query = f"regexp_replace(regexp_extract({url}, '(?s)^[^?#]*\\?([^#]*)', 1), '(^|&)(utm_\\w+|ref|fbclid|gclid)=[^&]*', '', 'g')"
    return f"{host} || chr(10) || {path} || chr(10) || regexp_replace({query}, '^&', '')"


def _sql_resolved(base: str, target: str) -> str:
    root, path = f"regexp_extract({base}, '(?s)^(.*?://[^/?#]*)', 1)", _sql_path(base)
    return f"""CASE WHEN {target} = '' OR starts_with({target}, '#') THEN NULL
      WHEN regexp_matches({target}, '(?i)^[a-z][a-z0-9+.-]*:') THEN CASE WHEN regexp_matches({target}, '(?i)^[a-z][a-z0-9+.-]*://') THEN {target} END
      WHEN starts_with({target}, '//') THEN regexp_extract({base}, '(?s)^(.*?:)//', 1) || {target}
      WHEN starts_with({target}, '/') THEN {root} || {target} WHEN starts_with({target}, '?') THEN {root} || {path} || {target}
      ELSE {root} || '/' || regexp_extract({path}, '(?s)^/(.*/)?', 1) || {target} END"""


_SQL_INSIDE = """(?:=\\s*"[^"]*"|=\\s*''[^'']*''|[^>=]|=)*"""
_SQL_MARKUP = "(?is)<!--(?:-?>|.*?(?:--!?>|\\z))|" + "|".join(f"<{t}(?:[\\s/]{_SQL_INSIDE})?>?.*?(?:</{t}[\\s/>]|\\z)" for t in ("script", "style", "textarea", "title")) + f"|<[a-z/]{_SQL_INSIDE}"


def _sql_value(name: str) -> str:
    """The first attribute of that name of a tag's attributes, without its quotes."""
    value = f"regexp_replace(list_filter(list, lambda x: lower(regexp_extract(x, '^[^\\s=]+')) = '{name}')[1], '(?s)^[^=]*=\\s*', '')"
    return f"CASE WHEN left({value}, 1) IN (chr(34), chr(39)) THEN substr({value}, 2, length({value}) - 2) ELSE {value} END"


#: Reachable nodes by a recursive query.
_SQL = f"""
WITH RECURSIVE rules(rule_verdict, h, p) AS (VALUES {", ".join(map(repr, RULES))}),
given AS (
  SELECT row_number() OVER () AS r, page_id, url, html, coalesce(contains(url, '://'), false) AS known,
         coalesce({_sql_host("url")}, '') AS host, coalesce({_sql_path("url")}, '') AS path
  FROM pages
), nodes AS (
  SELECT *, CASE WHEN known THEN {_sql_node("url")} END AS node FROM given
), marks AS (
  SELECT r, url, node, unnest(regexp_extract_all(html, '{_SQL_MARKUP}')) AS tag, generate_subscripts(regexp_extract_all(html, '{_SQL_MARKUP}'), 1) AS nth FROM nodes WHERE known
), tags AS (
  SELECT r, url, node, nth, lower(substr(tag, 2, 4)) AS kind, regexp_extract_all(tag, '([^\\s"''>/=]+)\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s>"'']+))') AS list
  FROM marks WHERE regexp_matches(tag, '(?i)^<(link|meta|base)[\\s/]')
), attributes AS (
  SELECT r, url, node, nth, kind, {_sql_value("rel")} AS rel, {_sql_value("http-equiv")} AS equiv, {_sql_value("href")} AS href, {_sql_value("content")} AS content FROM tags
), told AS (
  SELECT r, url, node, nth, kind, trim(regexp_replace(link, '(?i)&amp;', '&', 'g')) AS link FROM (
    SELECT *, CASE WHEN kind = 'base' THEN href WHEN kind = 'link' AND list_contains(regexp_split_to_array(lower(rel), '\\s+'), 'canonical') THEN href
                   WHEN kind = 'meta' AND trim(lower(equiv)) = 'refresh' THEN nullif(regexp_extract(content, '(?is)^[\\s\\d.,;]*url\\s*=\\s*["'']?([^"''\\s]+)', 1), '') END AS link
    FROM attributes)
  WHERE link IS NOT NULL
), bases AS (
  SELECT r, coalesce({_sql_resolved("url", "link")}, url) AS base FROM (SELECT r, url, arg_min(link, nth) AS link FROM told WHERE kind = 'base' GROUP BY r, url)
), absolute AS (
  SELECT node, {_sql_resolved("based", "link")} AS u FROM (SELECT t.node, t.link, coalesce(b.base, t.url) AS based FROM told t LEFT JOIN bases b USING (r) WHERE t.kind <> 'base')
), edges AS (
  SELECT DISTINCT node AS a, {_sql_node("u")} AS b FROM absolute WHERE u IS NOT NULL
), both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(node, other) AS (
  SELECT DISTINCT node, node FROM nodes WHERE node IS NOT NULL
  UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
), best AS (
  SELECT r, max_by(h || p, length(h || p)) AS rule, max_by(rule_verdict, length(h || p)) AS rule_verdict
  FROM nodes JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r
), judged AS (SELECT nodes.*, rule, rule_verdict FROM nodes LEFT JOIN best USING (r)),
decided AS (
  SELECT reach.node, min(page_id) AS alias_id, bool_or(rule_verdict = 'allow') AS allowed
  FROM reach JOIN judged ON judged.node = reach.other GROUP BY reach.node
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN allowed THEN 'allow' WHEN NOT allowed THEN 'block' END, 'allow') AS verdict, alias_id
FROM judged LEFT JOIN decided USING (node)
"""

QUERIES = {"op3_url_filters": op3_url_filters}
ORACLE_SQL = {"op3_url_filters": _SQL}
