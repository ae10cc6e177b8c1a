"""Session, table and shared-storage helpers used by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import broadcast

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application.

    Arrow operators pickle their functions by reference, so executors that
    don't share the driver's file system need the sources.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="inkloom-")) / "inkloom_src.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(str(out))
    atexit.register(shutil.rmtree, out.parent, ignore_errors=True)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.gettempdir()}/inkloom-shared-{os.getpid()}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored_bytes(df: DataFrame) -> int:
    """What Spark takes the size of ``df`` for: of a table read from files, the size of the files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if(df: DataFrame, most: int = 100_000, most_bytes: int = 16 << 20) -> DataFrame:
    """``df`` marked for broadcast if it is small: at most ``most`` rows and ``most_bytes`` in compressed files; else to be shuffled.

    It is computed once: what isn't a bare table yet is written to the shared
    folder first, where both are known without reading it again.
    """
    own = df if df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation" else materialize(df, "small")
    return broadcast(own) if stored_bytes(own) <= most_bytes and own.limit(most + 1).count() <= most else own


def spread(df: DataFrame, read: DataFrame | None = None) -> DataFrame:
    """``df`` over all cores, for work that costs more than moving its rows, if it is read in fewer parts than there are cores.

    ``read`` is the scanned table that tells, where ``df`` comes out of a join.
    Larger inputs have parts enough and stay where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if (read if read is not None else df).rdd.getNumPartitions() < cores else df


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts lineage and survives lost executors, because the files live outside
    them. The files are removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/inkloom-{uuid.uuid4().hex}/{label}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path.rpartition("/")[0])
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:
        pass
