"""Sources and sinks.

Reads declare their schema (no inference pass). Writes are plain
DataFrameWriter calls; a single output file is produced only on request
(``coalesce(1)`` funnels the data through one task, so it is for small
submission files only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import clean_name


def read_csv(spark: SparkSession, path: str, schema=None, header: bool = True, null_value: str | None = None,
             **options) -> DataFrame:
    """CSV with a header, quoted fields that contain commas and doubled
    quotes. Pass ``schema`` (StructType or DDL) to skip inference."""
    r = spark.read.option("header", header).option("quote", '"').option("escape", '"')
    if null_value is not None:
        r = r.option("nullValue", null_value)
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def normalise_names(df: DataFrame) -> DataFrame:
    """Column names with spaces -> underscores (``Heart Disease`` ->
    ``Heart_Disease``), so SQL and ``ml`` params need no quoting."""
    return df.toDF(*[c.strip().replace(" ", "_") for c in df.columns])


def repair_records(lines: DataFrame, schema, label_words=("Absence", "Presence"), header_prefix: str = "id,",
                   col: str = "value") -> DataFrame:
    """Records that ran together (``...,Presence12,58,...``) -> rows.

    Per input line (``spark.read.text``): insert a line break between a label
    word and the digits that follow it, split, trim, drop blank and header
    lines, parse each record with ``from_csv`` against ``schema``. Every
    step is a per-row expression, so any number of lines is processed in
    parallel."""
    words = "|".join(label_words)
    fixed = F.regexp_replace(F.col(col), f"({words})([0-9]+)", "$1\n$2")
    recs = lines.select(F.explode(F.split(fixed, "\n")).alias("_r")).select(F.trim("_r").alias("_r"))
    recs = recs.where((F.length("_r") > 0) & ~F.col("_r").startswith(header_prefix))
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = recs.select(F.from_csv("_r", ddl).alias("_p"))
    return parsed.select("_p.*")


def read_glued(spark: SparkSession, path: str, schema, label_words=("Absence", "Presence"),
               header_prefix: str = "id,") -> DataFrame:
    """S2 for whole files: records may have lost every line break.

    The last label word serves as the line separator, so Spark cuts the file
    at label words wherever a split starts, and a file without a single line
    break is still read by many tasks. The word is put back, the other label
    words and real line breaks cut the pieces further, and what holds no field
    separator (the rest behind the last record) is dropped."""
    cut = label_words[-1]
    pieces = spark.read.option("lineSep", cut).text(path).select(F.concat("value", F.lit(cut)).alias("value"))
    words = "|".join(label_words)
    broken = F.regexp_replace("value", f"({words})", "$1\n")
    lines = pieces.select(F.explode(F.split(broken, "\r?\n")).alias("value")).where(F.col("value").contains(","))
    return repair_records(lines, schema, label_words, header_prefix)


def write_submission(df: DataFrame, path: str, cols, single_file: bool = False, mode: str = "overwrite") -> None:
    """S3: ``(id, prediction)`` CSV with a header and no index column."""
    out = df.select(*cols)
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).option("header", True).csv(path)


def write_results(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Result records as JSON Lines (nested params kept as a map)."""
    df.write.mode(mode).json(path)


def append_results(df: DataFrame, path: str, model_col: str = "model") -> None:
    """Incremental result log: append-only, partitioned by a sanitised
    model name (space and '/' -> '_'), so a restart never rewrites earlier
    records and each model's records sit in their own folder."""
    df.withColumn("model_file", clean_name(model_col)).write.mode("append") \
        .partitionBy("model_file").json(path)


def read_results(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read the result log; a log that does not exist yet is an empty frame
    (any other failure is raised)."""
    from pyspark.errors import AnalysisException
    r = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return r.json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema or T.StructType([]))


def save_model(model, path: str) -> None:
    """Persist any fitted ``ml`` stage / pipeline (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load a saved PipelineModel (or any stage saved by ``save_model``)."""
    import importlib

    from pyspark import SparkContext
    from pyspark.ml import PipelineModel
    from pyspark.ml.util import DefaultParamsReader
    meta = DefaultParamsReader.loadMetadata(path, SparkContext.getOrCreate())
    cls = meta["class"]
    if cls.endswith("PipelineModel"):
        return PipelineModel.load(path)
    module, name = cls.rsplit(".", 1)
    module = module.replace("org.apache.spark", "pyspark")
    return getattr(importlib.import_module(module), name).load(path)


def summarise_run(results: DataFrame, metric: str, time_col: str = "time_min", name: str = "model",
                  descending: bool = True) -> DataFrame:
    """One summary row: total time, number of records, the best record
    (struct; ties -> smallest name) and all records in rank order (array of
    structs). Result tables hold one row per fitted candidate."""
    m = F.col(metric).desc_nulls_last() if descending else F.col(metric).asc_nulls_last()
    ordered = results.withColumn("_rk", F.row_number().over(Window.orderBy(m, F.col(name))))
    rec = F.struct(*[F.col(c) for c in results.columns])
    return ordered.agg(
        F.sum(time_col).alias("total_time"), F.count(F.lit(1)).alias("n_results"),
        F.min_by(rec, F.col("_rk")).alias("best"),
        F.sort_array(F.collect_list(F.struct(F.col("_rk"), rec.alias("r")))).alias("_all"),
    ).select("total_time", "n_results", "best", F.transform("_all", lambda x: x["r"]).alias("all_results"))
