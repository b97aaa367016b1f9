"""Session defaults and lineage cuts."""

import atexit
import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tallymart", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Shuffle partitions and file split size are left to the cluster: AQE merges
    small shuffle partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A private folder is chosen only for a local master; a cluster must name a
    shared one.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tallymart-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


_KEPT: dict[str, SparkSession] = {}


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; what is left there goes when Python ends."""
    if not _KEPT:
        atexit.register(drop_scratch)
    folder = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _KEPT[folder] = spark
    return folder


def drop_scratch(*folders: str) -> None:
    """Delete the named scratch folders, or all of this process."""
    for folder in folders or tuple(_KEPT):
        spark = _KEPT.pop(folder, None)
        if spark is None:
            continue
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception as problem:  # the session's JVM may be gone at exit
            if folders:
                raise
            print(f"scratch folder {folder} is left: {problem}", file=sys.stderr)


def pin(df: DataFrame, label: str = "pin") -> DataFrame:
    """Compute ``df`` once and cut its lineage with a Parquet table in the shared folder.

    Later readers prune columns and know its size, which a row checkpoint does not offer.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, label)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
