"""Session set-up and the one place that cuts lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


_shipped: set[str] = set()


def ship_package(spark: SparkSession, root: str) -> None:
    """Send this package to the workers, once per application: tasks import it by name."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    folder = os.path.join(root, "tabforge")
    archive = os.path.join(tempfile.mkdtemp(prefix="tabforge-ship-"), "tabforge-code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for top, _, names in os.walk(folder):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    out.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-JVM session for tests and the benchmark; on a cluster spark-submit supplies all of this."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabforge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    Where it is unset, a folder under ``spark.sql.warehouse.dir``, which a cluster shares as well.
    """
    path = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if path:
        return path.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tabforge-scratch"


def scratch_path(spark: SparkSession, stem: str) -> str:
    return f"{scratch_dir(spark)}/{stem}-{uuid.uuid4().hex}"


#: Bytes of rows from which on a table of a known size gets another file.
FILE_BYTES = 8 << 20


def files_for(rows: int, row_bytes: int) -> int:
    """Files for at most so many rows of so many bytes."""
    return max(1, -(-rows * row_bytes // FILE_BYTES))


def materialize(df: DataFrame, stem: str = "stage", most_files: int | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Used where a result feeds several later steps or an iteration: the table survives the loss of
    executors, has no lineage to replay, and carries size statistics that join planning can use.
    ``most_files``: for tables whose size is known and whose last step is light. Each file costs its
    executor processes of its own where the folder is a local one (Hadoop sets permissions by ``chmod``).
    """
    spark = df.sparkSession
    path = scratch_path(spark, stem)
    (df if most_files is None else df.coalesce(most_files)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
