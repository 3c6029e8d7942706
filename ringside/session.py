"""Session settings and the one way this package cuts lineage."""

import math
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ringside", cpus: int | None = None, memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    cpus = cpus or min(8, os.cpu_count() or 1)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")  # what the JVM still compiles
        .config("spark.ui.enabled", "false")
        .config("spark.sql.debug.maxToStringFields", "50")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, as the cluster names it.

    Only a local master may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ringside-"))
    return context.getCheckpointDir()


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared folder and go on from the written files.

    Parquet rather than an RDD checkpoint: later steps read only the columns
    they need, and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_by(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """As ``cut``, laid out in sorted buckets of a key: later joins and groupings by it move no rows.

    The table is known to this session's catalogue under a name of its own; its files lie in the shared folder.
    """
    spark = df.sparkSession
    table = f"{name}-{uuid.uuid4().hex}".replace("-", "_")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(n, key).write.format("parquet").bucketBy(n, key).sortBy(key)
    dealt.option("path", f"{shared_dir(spark).rstrip('/')}/{table}").saveAsTable(table)
    return spark.table(table)


def spread(df: DataFrame) -> DataFrame:
    """Narrow rows over as many tasks as a shuffle has, for much work on each: a file may hold all of them in one piece."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once per application, so that functions in it can be found there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ringside-package-"), "ringside.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(here)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def setting(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(f"spark.ringside.{key}", str(default)))


def pieces_for(rows: int, rows_per_piece: int) -> int:
    return max(1, math.ceil(rows / rows_per_piece))
