"""Session helpers: a tuned builder, the UTC rule and lineage cuts through the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(app: str = "snapgrid", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "16g",
        "spark.driver.host": "127.0.0.1",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All instants are UTC; local clocks come only from explicit conversion."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def instants(df: DataFrame) -> DataFrame:
    """Zone-less timestamps (how Parquet may store them) read as UTC instants."""
    naive = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
    if not naive:
        return df
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in naive else F.col(c) for c in df.columns])


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not is_local(spark):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    fallback = tempfile.mkdtemp(prefix="snapgrid-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a reused intermediate once to the shared folder and read it back.

    Unlike a cache it survives the loss of executors, and it cuts the lineage.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None


def ship_package(spark: SparkSession) -> SparkSession:
    """Let the Python workers of a local session import this package, wherever it was started.

    On a cluster the package is installed or shipped with the job, like any other library.
    """
    context = spark.sparkContext
    if is_local(spark) and context.applicationId not in _SHIPPED:
        here = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="snapgrid-code-")) / "snapgrid.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(here.rglob("*.py")):
                out.write(source, source.relative_to(here.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark
