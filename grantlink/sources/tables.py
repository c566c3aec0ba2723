"""Sources and sinks: Parquet, landed JSON pages, id lists, models."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import normalise
from .schemas import SCHEMAS


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    """Dynamic overwrite: only the partitions that ``df`` has are replaced."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic") if partition_by else writer).parquet(path)


def landed_records(spark: SparkSession, path: str, kind: str, nested: bool = False) -> DataFrame:
    """Records of landed JSON pages: arrays of records, or with ``nested`` arrays of such arrays. Unreadable pages are
    skipped, missing fields are null."""
    record = f"struct<{_as_fields(spark, SCHEMAS[kind])}>"
    shape = f"array<array<{record}>>" if nested else f"array<{record}>"
    pages = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).text(path)
    rows = pages.select(F.from_json("value", shape).alias("page")).select(F.explode("page").alias("r"))
    rows = rows.select(F.explode("r").alias("r")) if nested else rows
    return rows.select("r.*")


def _as_fields(spark: SparkSession, ddl: str) -> str:
    from pyspark.sql.types import StructType

    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in StructType.fromDDL(ddl))


def union_pages(*pages: DataFrame) -> DataFrame:
    out = pages[0]
    for p in pages[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def landed_authors(spark: SparkSession, *paths: str, include_match_info: bool = False) -> DataFrame:
    """Normalised authors of all landed batches; with ``include_match_info`` also the name that found each, and its score."""
    kind = "matched_author" if include_match_info else "author"
    return normalise.authors(union_pages(*(landed_records(spark, p, kind, nested=True) for p in paths)))


def landed_works(spark: SparkSession, *paths: str) -> DataFrame:
    return normalise.works(union_pages(*(landed_records(spark, p, "work") for p in paths)))


def landed_institutions(spark: SparkSession, *paths: str) -> DataFrame:
    return normalise.institutions(union_pages(*(landed_records(spark, p, "institution", nested=True) for p in paths)))


def write_id_lists(batches: DataFrame, path: str) -> None:
    batches.write.mode("overwrite").json(path)


def read_id_lists(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("batch bigint, ids string, n bigint").json(path)


def save_model(model: PipelineModel, folder: str, version: str) -> None:
    model.write().overwrite().save(f"{folder}/{version}")


def load_model(folder: str, version: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/{version}")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a temporary one for a local session,
    as in tests; on a cluster that would lose rows, and raises."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: there is no folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def kept(df: DataFrame) -> DataFrame:
    """``df`` written into the shared folder and read again: several jobs use it, and it is made once."""
    path = f"{shared_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
