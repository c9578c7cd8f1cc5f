"""Shared plumbing: intermediate tables, null-safe inputs, Arrow batch limits."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every operator here: space and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

_written: list[str] = []
_own: dict[str, str] = {}
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where it is unset, a temporary one if all runs in this process, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if found:
        return found.rstrip("/")
    master, run = spark.sparkContext.master, spark.sparkContext.applicationId
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if run not in _own:
        _own[run] = tempfile.mkdtemp(prefix="leafmill-")
        atexit.register(shutil.rmtree, _own[run], True)
    return "file://" + _own[run]


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at a table that outlives its executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/leafmill/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._leafmill_path = path
    return out


def delete(spark: SparkSession, place: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame | None) -> None:
    """Delete tables of ``materialise`` that no later step reads; what wasn't made by it is left alone."""
    for df in tables:
        path = getattr(df, "_leafmill_path", None)
        if path in _written:
            _written.remove(path)
            delete(df.sparkSession, path)


def tables(since: int = 0) -> list[str]:
    """The folders of the tables that ``materialise`` holds, from the ``since``-th on."""
    return _written[since:]


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables of ``materialise``. Results that read them and aren't stored yet are lost."""
    for path in paths:
        if path in _written:
            _written.remove(path)
            delete(spark, path)


def sweep(spark: SparkSession) -> None:
    """Let the driver collect plans that are done with, so that executors delete these plans' shuffle files.

    The plan that ran last is only let go after a first collection, so there are two.
    """
    for pause in (0.3, 0):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each application."""
    if spark.sparkContext.applicationId in _shipped:
        return
    _shipped.add(spark.sparkContext.applicationId)
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="leafmill-code-")
    atexit.register(shutil.rmtree, folder, True)
    with zipfile.ZipFile(f"{folder}/leafmill.zip", "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(f"{folder}/leafmill.zip")


def arrow_limits(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Bound an Arrow batch by rows and bytes, so that very long texts don't pile up in a Python worker."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def text_of(column: str | Column = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def free(name: str, taken: list[str]) -> str:
    """``name``, with as many underscores after it as no other column needs."""
    while name in taken:
        name += "_"
    return name


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only. Where no byte lies outside ASCII, the cheaper ``lower`` gives the same."""
    return F.when(F.octet_length(column) == F.char_length(column), F.lower(column)).otherwise(F.translate(column, ASCII_UPPER, ASCII_LOWER))


def spread(key: Column | str, n: int | Column, salt: int = 0) -> Column:
    """A stable number from 0 to n-1 for each key."""
    return F.pmod(F.xxhash64(F.lit(salt), key), F.lit(n) if isinstance(n, int) else n)


def held_out(id_column: str = "doc_id", folds: int = 5) -> Column:
    """Rows whose CRC-32 of the id as text is divisible by ``folds``; a null id is held out, so never learnt from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == 0, F.lit(True))
