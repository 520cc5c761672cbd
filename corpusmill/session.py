"""Session helpers: a local test session and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and single-node benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusmill")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship_package(spark)


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application.

    Not needed when the job is submitted with the package in ``--py-files``.
    """
    package = Path(__file__).parent
    name = f"{package.name}-{spark.sparkContext.applicationId}.zip"
    if any(str(f).endswith(name) for f in spark.sparkContext._python_includes):
        return spark
    archive = Path(tempfile.mkdtemp(prefix="run-package-")) / name
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    return spark


_written: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; every executor must reach it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that nobody else uses."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this process has put into the scratch folder; results read from it end here."""
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back.

    Used where several later stages need the same derived table: the text is then
    processed once, every later scan reads only the columns it needs, and losing
    an executor costs a re-read instead of a recomputation from the source.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a plan's size; for a plain scan, the file sizes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input too small to be split by the scan.

    A scan cannot split below one row group. Only inputs with less than a few
    megabytes per core (the cost Spark gives to opening a file) are redistributed;
    larger ones are returned as they are.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    small = cores * spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()
    return df.repartition(cores) if cores > 1 and scan_bytes(df) < small else df
