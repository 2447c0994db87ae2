"""Session construction and shared job settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "sluice", cpus: int | str = "*", shuffle_partitions: int = 8,
              extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench.

    On a cluster the session comes from the launcher; only the SQL settings
    below matter there (AQE with skew-join and partition coalescing on).
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, executor_cores: int, executors: int,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """SQL settings sized for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (at least two waves of the cluster's cores); AQE then coalesces
    small ones and splits skewed ones, so a partition stays well inside an
    executor core's memory share.  For 100 TB on 1000 executors x 8 cores:
    ~400k shuffle partitions, 256 MB splits.
    """
    cores = max(1, executor_cores * executors)
    shuffle = max(2 * cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it; only a local session without one (tests) gets a fresh
    scratch folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="sluice-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _tables_folder(spark: SparkSession) -> str:
    return checkpoint_dir(spark).rstrip("/") + f"/sluice-tables/{spark.sparkContext.applicationId}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared folder, below this application's tables."""
    import uuid

    return f"{_tables_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def release_tables(spark: SparkSession) -> None:
    """Delete what this application wrote below its tables' folder
    (``materialize``, ``scratch_folder``), once its results are stored elsewhere."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_tables_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str = "table"):
    """Cut the lineage of a result that several plan branches reuse: write it
    once as a parquet table in the shared ``spark.checkpoint.dir`` and read
    it back (computed once, survives executor loss; never a local
    checkpoint).  ``release_tables`` deletes them."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sluice`` importable in Python workers (state functions and
    pandas UDFs are pickled by reference): zip the package once per
    application into the shared checkpoint folder and ``addPyFile`` it."""
    import os
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    target_dir = checkpoint_dir(spark).rstrip("/").replace("file://", "").replace("file:", "")
    if "://" in target_dir:
        target_dir = tempfile.mkdtemp(prefix="sluice-pkg-")   # code only; Spark uploads it to executors
    os.makedirs(target_dir, exist_ok=True)
    zpath = os.path.join(target_dir, f"sluice-{app}.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(zpath)
    _SHIPPED.add(app)
