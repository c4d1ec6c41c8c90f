"""File readers for the workload's inputs (S1-S5), with explicit schemas.

* Many text sources are read in **one scan**: files laid out as
  ``root/source=<name>/...`` (Hive style) give a ``source`` partition column,
  so a filter on it prunes folders. ``source_ord`` is the union order.
* Instruction files are JSON (one object per line, or one array per file
  with ``multi_line=True``), read with their own schemas: lower-case
  ``instruction/input/output`` and capitalised ``Input/Output`` stay in
  separate readers (Spark resolves names case-insensitively).
* Every row gets a stable key ``(source, file, row_id)``: a given key column,
  else the Parquet row index inside its file. JSON is landed once as Parquet
  in the shared folder and read from there, so its rows have an index too and are
  parsed once. Absent fields read as null; blank rows are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.constants import LITERATURE_SOURCES
from tessera.session import scratch_folder

TEXT_SCHEMA = "title string, text string"
DIALOGUE_SCHEMA = "instruction string, input string, output string"
TECHNICAL_SCHEMA = "Input string, Output string"
METRIC_SCHEMA = "run_id long, seq long, step long, kind string, loss_c long, loss double"
SOURCE_KEY = ["source", "file", "row_id"]


def _with_key(df: DataFrame, fmt: str, cols: list[str], key: str | None) -> DataFrame:
    if fmt != "parquet" and not key:
        spark, path = df.sparkSession, scratch_folder(df.sparkSession, "json")
        schema = df.select("source", *cols).schema
        df.select("source", *cols).write.parquet(path)
        df = spark.read.schema(schema).parquet(path)
    d = df.withColumn("file", F.col("_metadata.file_path"))
    if key:
        return d.withColumn("row_id", F.col(key).cast("bigint"))
    # the landed folder's name is new each time; the file's own name is the key
    return d.withColumn("file", F.regexp_extract("file", "[^/]+$", 0) if fmt != "parquet" else F.col("file")) \
        .withColumn("row_id", F.col("_metadata.row_index").cast("bigint"))


def read_text_sources(spark: SparkSession, root: str, fmt: str = "parquet", schema: str = TEXT_SCHEMA,
                      order: list[str] | None = None, key: str | None = None,
                      multi_line: bool = False) -> DataFrame:
    """All ``root/source=<name>`` folders in one scan.

    Returns ``source, source_ord, file, row_id`` and the schema's columns.
    """
    order = order or LITERATURE_SOURCES
    reader = spark.read.schema(f"{schema}, source string").option("basePath", root).format(fmt)
    if fmt == "json" and multi_line:
        reader = reader.option("multiLine", "true")
    df = reader.load(root)
    cols = [c.strip().split(" ")[0] for c in schema.split(",")]
    ordinal = F.coalesce(*[F.when(F.col("source") == s, F.lit(i)) for i, s in enumerate(order)],
                         F.lit(len(order)))
    df = _with_key(df, fmt, cols, key)
    return df.select("source", ordinal.alias("source_ord"), "file", "row_id", *cols)


def read_instructions(spark: SparkSession, path: str, source: str, schema: str = DIALOGUE_SCHEMA,
                      multi_line: bool = False, key: str | None = None) -> DataFrame:
    """One instruction JSON file (or folder) with its own schema."""
    reader = spark.read.schema(schema)
    if multi_line:
        reader = reader.option("multiLine", "true")
    df = reader.json(path).withColumn("source", F.lit(source))
    cols = [c.strip().split(" ")[0] for c in schema.split(",")]
    df = _with_key(df, "json", cols, key)
    return df.select("source", "file", "row_id", *cols)


def read_metric_log(spark: SparkSession, path: str, stream: bool = False,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """The metric log as a batch table or a stream (same schema)."""
    if not stream:
        return spark.read.schema(METRIC_SCHEMA).parquet(path)
    r = spark.readStream.schema(METRIC_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def read_trainer_state(spark: SparkSession, path: str) -> DataFrame:
    """S5 from the trainer's own files: ``<run>/trainer_state.json`` (``log_history``).

    Each file is one run; the run id is its folder name. The position in
    ``log_history`` is the total order ``seq`` (train logs come before the
    evaluation of the same step). ``loss`` is the logged double; ``loss_c`` the same
    as an exact decimal, null for NaN and infinity: pass ``scale=1`` to the run
    analytics. A file is one JSON document, so one task reads one run's file.
    """
    entry = "struct<step:bigint, loss:double, eval_loss:double>"
    raw = spark.read.schema(f"log_history array<{entry}>").option("multiLine", "true") \
        .option("allowNonNumericNumbers", "true").json(path)
    run = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    ex = raw.select(run.alias("run_id"), F.posexplode("log_history").alias("pos", "e"))
    ex = ex.where(F.col("e.loss").isNotNull() | F.col("e.eval_loss").isNotNull())
    value = F.coalesce(F.col("e.eval_loss"), F.col("e.loss"))
    finite = ~F.isnan(value) & (F.abs(value) < F.lit(1e18))
    return ex.select("run_id", (F.col("pos") + 1).cast("bigint").alias("seq"), F.col("e.step").alias("step"),
                     F.when(F.col("e.eval_loss").isNotNull(), "eval").otherwise("train").alias("kind"),
                     F.when(finite, value).cast("decimal(38,18)").alias("loss_c"), value.alias("loss"))
