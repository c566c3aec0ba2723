"""Stand-ins over the given tables: orders are publications, line items authorships, suppliers authors, customers persons
with grants, brands subfields. Each has the same definition in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.author_year import with_people
from ..operators.skew import tasks_for
from ..sources.tables import kept, shared_folder, table

HOME = "NATION_3"


class Views:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.works_, self.matched_ = spark, folder, None, None

    def read(self, name: str, *columns: str) -> DataFrame:
        return table(self.spark, self.folder, name, *columns)

    def shared(self) -> str:
        return shared_folder(self.spark)

    def kept(self, df: DataFrame) -> DataFrame:
        return kept(df)

    def authorships(self) -> DataFrame:
        """(id, author_id, country)."""
        lines = self.read("lineitem", "l_orderkey", "l_suppkey").repartition(tasks_for(self.read("lineitem")), "l_orderkey").distinct()
        places = self.read("supplier", "s_suppkey", "s_nationkey").join(self.read("nation", "n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
        return lines.join(places, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("author_id"), F.col("n_name").alias("country"))

    def works(self) -> DataFrame:
        """id, year, fwci, cited_by_count, authorships[]."""
        tasks = tasks_for(self.read("lineitem"))
        orders = self.read("orders", "o_orderkey", "o_orderdate", "o_totalprice").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"), (F.col("o_totalprice") / 100000).alias("fwci")).repartition(tasks, "id")
        cited = self.read("lineitem", F.col("l_orderkey").alias("id"), "l_quantity").repartition(tasks, "id").groupBy("id").agg(F.sum("l_quantity").cast("bigint").alias("cited_by_count"))
        people = self.authorships().repartition(tasks, "id").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("author_id", "country"))).alias("authorships"))
        return orders.join(cited, "id").join(people, "id")

    def kept_works(self) -> DataFrame:
        """``works`` with their people instead of authorships, made once for a query."""
        if self.works_ is None:
            self.works_ = kept(with_people(self.works()).drop("authorships"))
        return self.works_

    def matched(self) -> DataFrame:
        """Suppliers whose orders have customers, found once for a query."""
        if self.matched_ is None:
            tasks = tasks_for(self.read("lineitem"))
            lines, orders = self.read("lineitem", "l_orderkey", "l_suppkey").repartition(tasks, "l_orderkey"), self.read("orders", "o_orderkey", "o_custkey").where("o_custkey is not null").repartition(tasks, "o_orderkey")
            self.matched_ = kept(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select(F.col("l_suppkey").alias("author_id")).where("author_id is not null").distinct())
        return self.matched_

    def refs(self) -> DataFrame:
        """Each matched author's person, with the year of the first grant."""
        return self.matched().select((F.col("author_id") + 1_000_000).alias("person_id"), "author_id", (1996 + F.col("author_id") % 4).cast("int").alias("ref_year"))

    def grants(self) -> DataFrame:
        ends = self.read("lineitem", "l_orderkey", "l_shipdate").groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("end_date"))
        orders = self.read("orders").join(self.read("customer", "c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")).join(ends, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        return orders.select(F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("project_id"), F.col("o_orderdate").cast("date").alias("start_date"), "end_date", F.col("o_orderpriority").alias("category"), F.col("c_mktsegment").alias("funder"), F.when(F.col("o_orderstatus") == "O", "Active").otherwise("Closed").alias("status"))

    def author_subfields(self) -> DataFrame:
        """(author_id, id, year, subfield): one row per line item."""
        lines = self.read("lineitem", "l_orderkey", "l_partkey", "l_suppkey").join(self.read("part", "p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        years = self.read("orders", "o_orderkey", "o_orderdate").select("o_orderkey", F.year("o_orderdate").alias("year"))
        tasks = tasks_for(self.read("lineitem"))
        lines, years = lines.repartition(tasks, "l_orderkey"), years.repartition(tasks, "o_orderkey")
        return lines.join(years, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_suppkey").alias("author_id"), F.col("l_orderkey").alias("id"), "year", F.col("p_brand").alias("subfield"))

    def citing(self) -> DataFrame:
        """Orders cite their parts."""
        return self.read("lineitem", "l_orderkey", "l_partkey").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set("l_partkey").alias("referenced_works"))

    def citations(self) -> DataFrame:
        """Rows (id, ref) of ``citing``, which may repeat."""
        return self.read("lineitem", F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("ref"))

    def groups(self) -> DataFrame:
        """Parts refer to all other parts of their size and type: a class is a group (id, group)."""
        return self.read("part", "p_partkey", "p_size", "p_type").where("p_size is not null and p_type is not null").select(F.col("p_partkey").alias("id"), F.struct("p_size", "p_type").alias("group"))


AUTHORSHIPS = "auth AS (SELECT DISTINCT l_orderkey AS id, l_suppkey AS author_id, n_name AS country FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"
WORKS = "works AS (SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice / 100000 AS fwci, q.c AS cited_by_count FROM orders JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS c FROM lineitem GROUP BY l_orderkey) q ON q.l_orderkey = o_orderkey)"
REFS = "refs AS (SELECT s_suppkey + 1000000 AS person_id, s_suppkey AS author_id, CAST(1996 + s_suppkey % 4 AS INTEGER) AS ref_year FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey))"
#: Co-author rows per paper and matched author, and the totals of each paper.
PAPERS = (
    f"papers AS (SELECT a.id, a.author_id, a.country, w.year, w.fwci, w.cited_by_count, t.n_home, t.n_all FROM auth a JOIN works w ON a.id = w.id JOIN (SELECT id, count(*) AS n_all, sum(CASE WHEN country = '{HOME}' THEN 1 ELSE 0 END) AS n_home FROM auth GROUP BY id) t ON a.id = t.id)"
)
YEARS = (
    f"years AS (SELECT author_id, year, CAST(sum(CASE WHEN country = '{HOME}' THEN 1 ELSE 0 END) AS BIGINT) AS n_affils_uk, CAST(sum(CASE WHEN country <> '{HOME}' THEN 1 ELSE 0 END) AS BIGINT) AS n_affils_abroad, avg(fwci) AS fwci, CAST(sum(cited_by_count) AS BIGINT) AS cited_by_count, "
    f"CAST(sum(n_home - CASE WHEN country = '{HOME}' THEN 1 ELSE 0 END) AS BIGINT) AS n_collab_uk, CAST(sum(n_all - n_home - CASE WHEN country <> '{HOME}' THEN 1 ELSE 0 END) AS BIGINT) AS n_collab_abroad, count(*) AS n_pubs FROM papers GROUP BY author_id, year)"
)
CO = "co AS (SELECT DISTINCT p.author_id, p.year, b.author_id AS c, b.country FROM papers p JOIN auth b ON p.id = b.id AND b.author_id <> p.author_id)"
GRANTS = "grants AS (SELECT o_custkey AS person_id, o_orderkey AS project_id, CAST(o_orderdate AS DATE) AS start_date, e.end_date, o_orderpriority AS category, c_mktsegment AS funder, o_orderstatus = 'O' AS active FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS end_date FROM lineitem GROUP BY l_orderkey) e ON e.l_orderkey = o_orderkey)"
SUBFIELDS = "sub AS (SELECT l_suppkey AS author_id, l_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year, p_brand AS subfield FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)"
EDGES = "cites AS (SELECT DISTINCT l_orderkey AS id, l_partkey AS ref FROM lineitem), own AS (SELECT a.p_partkey AS focal_id, b.p_partkey AS ref FROM part a JOIN part b ON a.p_size = b.p_size AND a.p_type = b.p_type AND a.p_partkey <> b.p_partkey)"
DISRUPTION = f"{EDGES}, hits AS (SELECT DISTINCT c.id, c.ref AS focal_id FROM cites c JOIN part p ON c.ref = p.p_partkey), shared AS (SELECT DISTINCT h.id, h.focal_id FROM hits h JOIN own o ON h.focal_id = o.focal_id JOIN cites c ON c.id = h.id AND c.ref = o.ref), di AS (SELECT p.p_partkey AS focal_id, CAST(count(h.id) - count(s.id) AS BIGINT) AS n_f, CAST(count(s.id) AS BIGINT) AS n_b FROM part p LEFT JOIN hits h ON h.focal_id = p.p_partkey LEFT JOIN shared s ON s.id = h.id AND s.focal_id = h.focal_id WHERE p.p_partkey IN (SELECT focal_id FROM own) GROUP BY p.p_partkey)"


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "
