"""Helpers shared by the training-data operators.

Nothing outside ``sparkloom.llm`` imports this module.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the word-based contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: What Python workers keep from task to task, a dictionary for each kind; workers outlive stages.
CACHES: list[dict] = []


def release_caches() -> None:
    """Forget what other operators keep in this Python worker. Called first thing by tasks that need memory themselves."""
    for cache in CACHES:
        cache.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``; a folder of our own is
    made only where that is unset, as in tests on a single machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="sparkloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs nothing that was written, and
    what reads the table sees one fixed version of any order-dependent value.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sparkloom/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written`."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/sparkloom/" in path:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, n: int) -> list[str]:
    """Names that no column of ``df`` has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    return [next(x for x in (f"__{i}_{k}" for k in range(len(taken) + 1)) if x not in taken) for i in range(n)]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000):
    """Jobs that run within hand fewer rows at once to Python, for rows that are wide."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def values(column, rows: int = 256):
    """The values of an Arrow column one by one, a few at a time as Python objects."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()
