"""Session helpers: one place for the engine's Spark settings and for lineage cuts."""
from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on.  AQE re-plans joins at run time (a join side that turns out small is
# broadcast by measured size, skewed partitions are split); the window-group-limit threshold lets
# "row_number() <= n" per sample run a partial top-n before the shuffle for n up to 100 000.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "cytospark") -> SparkSession:
    """Return the active session, or build a local one (tests, bench) with the engine settings."""
    active = SparkSession.getActiveSession()
    if active is not None:
        configure(active)
        return active
    b = SparkSession.builder.appName(app).master(master or os.environ.get("CYTOSPARK_MASTER", "local[8]"))
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.driver.memory", "16g")
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (safe to call repeatedly)."""
    for k, v in ENGINE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: keep the cluster's value
            pass
    checkpoint_dir(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A folder of our own is set only where the session has none, and only on a local master; on a
    cluster a machine-local folder would be read by nobody else, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cytospark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def _tables_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/cytospark-tables/{spark.sparkContext.applicationId}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def drop_path(spark: SparkSession, path: str) -> None:
    fs, place = _file_system(spark, path)
    fs.delete(place, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, place = _file_system(spark, path)
    return fs.exists(place)


def write_marker(spark: SparkSession, path: str, text: str) -> None:
    """A small file written through the session's file system, put in place by a rename."""
    fs, place = _file_system(spark, path)
    _, draft = _file_system(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(place, False)
    fs.rename(draft, place)


def read_marker(spark: SparkSession, path: str) -> str:
    fs, place = _file_system(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


_SWEPT: set[str] = set()


def scratch_folder(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder, among this application's tables; it goes when the driver ends."""
    root = _tables_root(spark)
    if root not in _SWEPT:
        _SWEPT.add(root)
        atexit.register(_sweep, spark, root)
    return f"{root}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared checkpoint folder and read it back.

    Used by iterative operators: the plan restarts from files (no lineage, no inherited plan
    state), and the data survives executor loss, unlike a local checkpoint.  The tables of an
    application lie in one folder, which goes when the driver ends; ``drop_cut`` removes one
    earlier.
    """
    spark = df.sparkSession
    path = scratch_folder(spark)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cytospark_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete the table behind a frame that ``cut_lineage`` returned; nothing may read it later."""
    path = getattr(df, "_cytospark_path", None)
    if path:
        drop_path(df.sparkSession, path)


def _sweep(spark: SparkSession, root: str) -> None:
    if spark.sparkContext._jsc is not None:
        drop_path(spark, root)
