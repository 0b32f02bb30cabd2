"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: rows of a narrow table that may be broadcast, after they were counted
SMALL_ROWS = 2_000_000
#: files whose names ``numbered`` may broadcast
MAX_FILES = 200_000


def materialise(df: DataFrame) -> DataFrame:
    """Write a table into the shared checkpoint folder and read it again.

    Cuts the lineage, survives lost executors, and lets later steps prune
    columns. A local scratch folder is used only by local sessions that name none.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def free(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote and nothing reads any more, and let Spark's cleaner drop spent shuffles.

    Frames that were not written here are left alone.
    """
    for t in tables:
        path = getattr(t, "_written_to", None)
        if path:
            sc = t.sparkSession.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
            t._written_to = None
    if tables:
        tidy(tables[0].sparkSession)


def tidy(spark) -> None:
    """Let Spark's cleaner drop shuffles of jobs that have ended and of frames nobody holds."""
    spark.sparkContext._jvm.System.gc()


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """The written narrow table with a broadcast hint if it has at most ``rows`` rows; beyond, a plain join follows."""
    return F.broadcast(df) if df.count() <= rows else df


def _as_read(docs: DataFrame) -> bool:
    """Is the frame the rows of files, at most filtered and with columns added or dropped?"""
    nodes = re.findall(r"(?m)^[\s:+|-]*(\w+)", docs._jdf.queryExecution().analyzed().toString())
    return set(nodes) <= {"Project", "Filter", "SubqueryAlias", "Relation"}


def numbered(docs: DataFrame, name: str = "_row") -> DataFrame:
    """The rows with a unique long, the same whenever they are read, for repeated use.

    Rows as read from Parquet files are numbered by file and place in it,
    without a copy. Other frames are written first.
    """
    files = []
    if _as_read(docs):
        at = docs.select("*", F.col("_metadata.file_path").alias("_file_of_row"), F.col("_metadata.row_index").alias("_place_in_file"))
        files = [r[0] for r in at.select("_file_of_row").distinct().limit(MAX_FILES + 1).collect()]
    if not files or len(files) > MAX_FILES:
        return materialise(docs.withColumn(name, F.monotonically_increasing_id()))
    names = docs.sparkSession.createDataFrame([(f, i) for i, f in enumerate(sorted(files))], "_file_of_row string, _nr_of_file long")
    at = at.join(F.broadcast(names), "_file_of_row")
    return at.select(*[F.col(f"`{c}`") for c in docs.columns],
                     (F.shiftleft("_nr_of_file", 40) + F.col("_place_in_file")).alias(name))


def row_schema(df: DataFrame, columns: list[str], extra: str) -> str:
    """DDL of the given columns of df followed by extra ones."""
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join([f"`{c}` {fields[c]}" for c in columns] + [extra])
