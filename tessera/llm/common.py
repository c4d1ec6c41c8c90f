"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_folder, table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (null ids: fold of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: executors that are lost later cost a re-read, not a re-run.
    """
    spark, path = df.sparkSession, scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def labelled_sample(labels: DataFrame, column: str, parts: int, limit: int) -> DataFrame:
    """At most ``limit`` labelled training rows (doc_id, label), smallest id hash first.

    Rows of fold 0 are held out. Repeated ids count once (label 1 if any row
    says 1); rows without id or label are left out. The bound ``limit`` also
    bounds the broadcast of the result.
    """
    return (labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()
                         & (fold(F.col("doc_id"), parts) != 0))
            .groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
