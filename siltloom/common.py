"""What several operators need: sessions, durable cuts of the lineage, tables, Arrow row functions."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream of files, be it one file or a folder of them.

    The path is a pattern since a stream takes a plain path for a folder; a filter by name would see the names of the
    files inside a folder, not the folder's, and pass over all of them.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("basePath", sf_dir).parquet(f"{sf_dir}/{name}[.]parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in spark.checkpoint.dir.

    On one machine (a local master, as in tests) an unset folder is replaced by a temporary one, removed at the end; on a
    cluster, whose executors share no such folder, an unset one is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="siltloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        named = "file://" + folder
    spark.sparkContext.setCheckpointDir(named)
    return named


def durable(df: DataFrame) -> DataFrame:
    """The same rows, written to the checkpoint folder: a lost executor does not repeat what led to them."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; trouble in finding out is an error, never a no."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def spread(df: DataFrame, bytes_per_core: int = 8 << 20) -> DataFrame:
    """The same rows over all cores where the input is small and lies in fewer files than there are cores.

    One small file is one task, however costly the work per row.  Larger inputs are split by the scan itself and stay as
    they are, so nothing is shuffled at scale.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size < cores * bytes_per_core and 0 < len(df.inputFiles()) < cores:
        return df.repartition(cores)
    return df


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str | StructType, block: int = 4096) -> DataFrame:
    """Each partition's rows, as tuples in column order, through ``fn``; its tuples become rows of ``schema``.

    Rows come and go in Arrow batches (mapInArrow), never one by one.  ``fn`` gets one iterator over the whole
    partition, so it may keep state, and ``block`` result rows are sent at a time.
    """
    df = spread(df)
    struct = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    yield from zip(*(c.to_pylist() for c in part.columns))

        out: list[tuple] = []

        def pack() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[] for _ in arrow]
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for row in fn(rows()):
            out.append(row)
            if len(out) >= block:
                yield pack()
                out.clear()
        if out:
            yield pack()

    return df.mapInArrow(run, struct)


def local_session(name: str = "siltloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for one machine; on a cluster the submitter's own session is used instead."""
    os.environ.setdefault("TZ", "UTC")
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def strip_text(column):
    """Strips every Unicode blank (and the separators 0x1c to 0x1f), unlike trim, which only knows U+0020."""
    return F.regexp_replace(column, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")
