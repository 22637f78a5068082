"""Session helpers: a configured local session for tests/bench, and the
shared checkpoint folder that iterative jobs cut their lineage into."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "linemill", extra: dict | None = None) -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("LINEMILL_DRIVER_MEM", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a shared, fault-tolerant file
    system). Only a local-mode session without it (tests, laptop runs) gets a
    fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative jobs need a shared folder "
            "that survives executor loss")
    path = tempfile.mkdtemp(prefix="linemill-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh table path inside the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def session_with(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    """A session of the same application with the settings of ``spark`` but
    ``conf``; those of ``spark`` stay as they are."""
    own = spark.newSession()
    for k, v in {**spark.conf.getAll, **conf}.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def many_files_session(spark: SparkSession) -> SparkSession:
    """For reading very many small files: they are listed in a few tasks a core
    (by default in one task a file or folder, up to 10,000 a listing), and some
    hundred files go to a task."""
    return session_with(spark, {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
        "spark.sql.files.openCostInBytes": str(1 << 18)})


def stored(df, name: str):
    """``df`` written to the shared folder and read back: cuts the lineage so
    that a lost executor repeats nothing of what came before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_large_rows(df, name: str):
    """:func:`stored` for rows of about a megabyte: Parquet pages and row
    groups are closed by size after any row, and the table is read in a session
    of its own that takes one row at a time, from the file and to Python.
    Otherwise a task would hold as many rows as a batch has, thousands."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.option("parquet.page.size.row.check.min", "1").option("parquet.page.size.row.check.max", "1")
     .option("parquet.block.size.row.check.min", "1").option("parquet.block.size.row.check.max", "1").parquet(path))
    single = session_with(spark, {"spark.sql.parquet.columnarReaderBatchSize": "1",
                                  "spark.sql.execution.arrow.maxRecordsPerBatch": "1"})
    return single.read.schema(df.schema).parquet(path)


def spread(df, partitions: int | None = None):
    """Hash-spread a table that later CPU-bound passes read many times (the
    word tables of the vocabulary trainers) over at least two partitions per
    core. Runs once per training job: AQE may coalesce a small aggregate into
    a single partition at run time, which would leave every later pass on
    one core."""
    spark = df.sparkSession
    n = partitions or max(2 * spark.sparkContext.defaultParallelism,
                          int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return df.repartition(n)


_SHIPPED = "_linemill_shipped"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, so that functions run there find it
    whatever folder the driver was started in. Once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="linemill-zip-"), "linemill-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in sorted(os.walk(root)):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("linemill", os.path.relpath(full, root)))
    sc.addPyFile(path)
    setattr(sc, _SHIPPED, True)
