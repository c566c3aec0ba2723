"""Secret scans with corpus-wide ownership frequency.

Each document is scanned once for candidates. Their hashes are then counted over the whole corpus by distinct
repositories and distinct owners: a value that many owners carry is a widely copied example, one that stays with a
single owner and looks random is a live-looking credential.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, table, utf8, widened, with_row

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is taken whole, so shorter runs are the ones that fail
#: Spans that the method adds: tokens that name their issuer, and private keys.
VENDOR = re.compile(r"\b(?:gh[opsur]_|github_pat_|glpat-|xox[abprs]-)[A-Za-z0-9_-]{20,}")
KEY = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
KINDS = ("assign", "access", "hex", "vendor", "key")
#: From so many distinct owners on a value counts as a copied example.
SHARED_OWNERS = 3


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value), by start, then kind; code points, end exclusive."""
    out = [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    out += [("vendor", *m.span(), m[0]) for m in VENDOR.finditer(text)]
    out += [("key", *m.span(), m[0]) for m in KEY.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def joined(found: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in found)


SCAN = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, found array<struct<kind:string,hash:bigint,live:boolean>>"


def looks_random(value: str) -> bool:
    """Digits and letters, and many different characters."""
    return len(set(value)) >= min(8, len(value)) and any(c.isdigit() for c in value) and any(c.isalpha() for c in value)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("hash", pa.int64()), ("live", pa.bool_())]))
    for batch in batches:
        rows = []
        for text in batch.column(batch.schema.get_field_index("_utf8")):
            found = candidates(text.as_py().decode("utf-8", "replace"))
            base = [x for x in found if x[0] in KINDS[:3]]
            count = lambda k: sum(x[0] == k for x in base)  # noqa: B023, E731
            values = [{"kind": k, "hash": int.from_bytes(hashlib.sha256(v.encode()).digest()[:8], "big", signed=True), "live": looks_random(v)} for k, _, _, v in found]
            rows.append((count("assign"), count("access"), count("hex"), hashlib.sha256(joined(base).encode()).hexdigest(), joined(found), values))
        rest = batch.drop_columns(["_utf8"])
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [kind]
        columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([*rest.columns, *columns], [*rest.schema.names, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"])


def scan_secrets(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "concat_ws('/', source, lang)") -> DataFrame:
    """One row per input row: doc_id, the counts and digests of the candidates, n_shared (copied examples: SHARED_OWNERS
    owners or more carry the value) and n_live (fewer owners, and it looks random).

    ``owner`` and ``repository`` are SQL expressions over ``docs``; a null one counts as an owner of its own name ''.
    Null and empty texts have no candidates; repeated rows stay, and add no owners. Very long texts are scanned whole.
    Columns other than doc_id, the text and those that the expressions name play no part; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.coalesce(F.expr(owner).cast("string"), F.lit("")).alias("owner"), F.coalesce(F.expr(repository).cast("string"), F.lit("")).alias("repository"), utf8(f"`{text}`").alias("_utf8"))
    scanned = keep(with_row(rows.mapInArrow(_scan, widened(rows, SCAN))))
    each = scanned.select("row", "owner", "repository", F.explode("found").alias("c")).select("row", "owner", "repository", "c.*")
    # distinct first, so that a value with very many copies is counted from few rows
    spread = each.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n")).groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    spread = spread.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))
    shared = F.col("owners") >= SHARED_OWNERS
    verdict = each.join(spread, "hash").groupBy("row").agg(F.count_if(shared).alias("n_shared"), F.count_if(~shared & F.col("live")).alias("n_live"), F.max("owners").alias("most_owners"), F.max("repositories").alias("most_repositories"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return scanned.join(verdict, "row", "left").select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", zero("n_shared"), zero("n_live"), zero("most_owners"), zero("most_repositories"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def _sql_kind(kind: str, pattern: str, value: str = "v", fits: str = "true") -> str:
    """Spans of a kind: matches and the gaps before them alternate, so their lengths add up to places."""
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
SELECT r, '{kind}' AS kind, {KINDS.index(kind)} AS kind_order, upto - length(v) AS start, upto AS stop, {value.replace("PATTERN", quoted)} AS value FROM (
  SELECT r, v, sum(length(gap) + length(v)) OVER (PARTITION BY r ORDER BY n) AS upto FROM (
    SELECT r, unnest(m) AS v, unnest(gaps[1 : len(m)]) AS gap, generate_subscripts(m, 1) AS n FROM (
      SELECT r, regexp_extract_all(text, {quoted}) AS m, string_split_regex(text, {quoted}) AS gaps FROM d WHERE regexp_matches(text, {quoted}))))
WHERE {fits.replace("PATTERN", quoted)}"""


_ASSIGN_WORDS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_SQL_SPANS = " UNION ALL ".join((
    _sql_kind("assign", ASSIGN.pattern.replace("password|passwd|secret|token|api_?key", _ASSIGN_WORDS), "regexp_extract(v, PATTERN, 2)", "length(regexp_extract(v, PATTERN, 2)) >= 6"),
    _sql_kind("access", ACCESS.pattern, fits="length(v) >= 20"),
    _sql_kind("hex", HEX.pattern),
    _sql_kind("vendor", VENDOR.pattern),
    _sql_kind("key", KEY.pattern),
))
_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner, concat_ws('/', source, lang) AS repository FROM documents
), found AS ({_SQL_SPANS}
), owned AS (
  SELECT found.*, owner, repository, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span,
         len(list_distinct(string_split(value, ''))) >= least(8, length(value)) AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AS live
  FROM found JOIN d USING (r)
), spread AS (
  SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repository)) AS repositories FROM owned GROUP BY value
), by_row AS (
  SELECT r, count_if(kind = 'assign') AS n_assign, count_if(kind = 'access') AS n_access, count_if(kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY start, kind_order) FILTER (kind_order < 3) AS base, string_agg(span, ',' ORDER BY start, kind_order) AS spans,
         count_if(owners >= {SHARED_OWNERS}) AS n_shared, count_if(owners < {SHARED_OWNERS} AND live) AS n_live, max(owners) AS most_owners, max(repositories) AS most_repositories
  FROM owned JOIN spread USING (value) GROUP BY r
)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, CAST(coalesce(n_shared, 0) AS BIGINT) AS n_shared, CAST(coalesce(n_live, 0) AS BIGINT) AS n_live,
       coalesce(most_owners, 0) AS most_owners, coalesce(most_repositories, 0) AS most_repositories
FROM d LEFT JOIN by_row USING (r)
"""

QUERIES = {"op10_secret_scan": op10_secret_scan}
ORACLE_SQL = {"op10_secret_scan": _SQL}
