"""Session settings and the shared folder for intermediate tables."""

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Calendar fields are read in UTC; skewed joins are split and small partitions
# merged at run time.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """Operators with a state of their own need this store; streams started from here on use it."""
    spark.conf.set(STATE_STORE, ROCKSDB)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local master may go without the setting: a temporary folder of one
    machine is no use to the executors of a cluster.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None and context.getCheckpointDir() is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="editflow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return (root or context.getCheckpointDir()).rstrip("/")


_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, removed with its scope or when the JVM ends."""
    path = f"{checkpoint_root(spark)}/editflow-{label}-{uuid.uuid4().hex}"
    file_system, jvm_path = _file_system(spark, path)
    file_system.deleteOnExit(jvm_path)
    if _scope.get() is not None:
        _scope.get().append(path)
    return path


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern names, in order."""
    file_system, jvm_path = _file_system(spark, pattern)
    return sorted(str(found.getPath()) for found in file_system.globStatus(jvm_path) or [])


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    file_system, jvm_path = _file_system(spark, path)
    stream = file_system.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless the path exists; whether this call made it.

    The text is written beside the path and renamed without overwriting. On a file system
    that renames atomically, such as HDFS, exactly one of several writers succeeds.
    """
    draft = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    file_system, jvm_path = _file_system(spark, draft)
    stream = file_system.create(jvm_path, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(jvm_path.toUri(), spark._jsc.hadoopConfiguration())
    modes = getattr(hadoop, "Options$Rename")
    never = spark.sparkContext._gateway.new_array(modes, 1)
    never[0] = modes.NONE
    try:
        context.rename(context.makeQualified(jvm_path), context.makeQualified(hadoop.Path(path)), never)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        file_system.delete(jvm_path, False)
        return False
    return True


def remove_path(spark: SparkSession, path: str) -> None:
    file_system, jvm_path = _file_system(spark, path)
    file_system.delete(jvm_path, True)
    file_system.cancelDeleteOnExit(jvm_path)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the scratch tables made inside, so that a long-running stream leaves none behind."""
    token = _scope.set([])
    try:
        yield
    finally:
        for path in _scope.get():
            remove_path(spark, path)
        _scope.reset(token)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back.

    Cuts the lineage and freezes values that depend on the physical partitioning,
    so that a lost executor cannot change them. Unlike a checkpoint, later reads
    of the table prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
