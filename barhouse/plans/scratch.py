"""Writing an intermediate result down once, in the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's checkpoint folder, or ``fallback`` where none is set."""
    shared = spark.conf.get(_SETTING, None) or fallback
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="barhouse-")


def new_folder(spark: SparkSession, fallback: str | None = None) -> str:
    return f"{scratch_root(spark, fallback)}/barhouse-{uuid.uuid4().hex}"


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, or not at all: False when there is one of that name."""
    files, target = _located(spark, path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    draft = hadoop.Path(f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    never = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, never)
    except Py4JJavaError:
        files.delete(draft, False)
        if files.exists(target):
            return False
        raise
    return True


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and read it back. Survives the loss of any executor."""
    path = path or new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder this library wrote."""
    files, target = _located(spark, path)
    files.delete(target, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names directly in a folder; none when the folder does not exist."""
    files, target = _located(spark, path)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target)]


def few_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A handful of rows as literals: one task, and no Python worker."""
    one = spark.range(0, 1 if rows else 0, 1, 1)
    fields = [(f.name, f.dataType) for f in schema]
    literals = [
        F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields)])
        for row in rows or [[None] * len(fields)]
    ]
    return one.select(F.inline(F.array(*literals)))
