"""Session, table access and durable intermediate tables."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_written: list[tuple[SparkSession, str]] = []


def local_session(cores: str = "8", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lexweave")
    for key, value in {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver found it."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table (a file or a folder of files) of the data directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its scan has fewer partitions than there are cores, as a small file has; else as it is.

    For operators that compute much per row. A large input has partitions enough and isn't shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder for durable intermediates: spark.checkpoint.dir where the cluster names one.

    Only a purely local session gets a folder of its own; on a cluster without
    the setting this raises, since a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = getattr(sc, "_lexweave_folder", None)
        if named is None:
            named = sc._lexweave_folder = "file://" + tempfile.mkdtemp(prefix="lexweave-")
            sc.setCheckpointDir(named)
    return named.rstrip("/")


def durable(df: DataFrame, **options: str) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage ends, executors may be lost. Options are the writer's."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lexweave-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _sweep() -> None:
    for spark, path in _written:
        try:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001 - the session may be gone already
            pass
