"""Incremental landing: each id is written once, whenever it arrives."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Folders that landed ids are dealt into, so that a batch is compared with those of its own ids only.
BUCKETS = 64


def new_records(batch: DataFrame, landed: DataFrame, key: str = "id") -> DataFrame:
    """The batch's records whose id is not landed yet, one per id."""
    return batch.dropDuplicates([key]).join(landed.select(key), key, "left_anti")


def land_stream(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: str = "id", stateless: bool = False) -> StreamingQuery:
    """Appends new Parquet files of ``source`` to ``target``, without repeated ids; ends when all files are read.

    The seen ids are the stream's state, kept in ``checkpoint``, and grow with all ids ever landed. A ``stateless`` stream
    holds none: each batch is compared with the landed table (dealt into folders ``batch`` and ``bucket``) before it is
    written, bucket by bucket, so late and old ids are known however long ago they came. A batch that is run again
    replaces what it had written.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    if not stateless:
        return stream.dropDuplicates([key]).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def write(batch: DataFrame, number: int) -> None:
        dealt = batch.dropDuplicates([key]).withColumns({"batch": F.lit(number), "bucket": F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")})
        try:
            landed = batch.sparkSession.read.parquet(target)
        except AnalysisException as missing:  # the first batch
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        else:
            dealt = dealt.join(landed.where(F.col("batch") != number).select("bucket", key), ["bucket", key], "left_anti").select(*dealt.columns)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "bucket").parquet(target)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
