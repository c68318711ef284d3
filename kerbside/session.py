"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "kerbside", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_timezone(spark: SparkSession) -> SparkSession:
    """Trip times are wall-clock values; a zone with DST would bend durations."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temp folder in local mode only."""
    configured = spark.conf.get(_CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="kerbside-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


class Workspace:
    """Owns the intermediate tables of one run: one folder below the shared folder.

    Frames read back from it are lazy, so ``close`` it once their results are
    written. What is still open when the interpreter ends is removed then.
    """

    def __init__(self, spark: SparkSession, name: str = "work") -> None:
        self.spark = spark
        self.root = scratch_path(spark, name)
        self._tables = 0
        self._paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
        _open_workspaces.add(self)

    def path(self, name: str) -> str:
        """A fresh path inside the folder."""
        self._tables += 1
        return f"{self.root}/{self._tables:03d}-{name}"

    def store(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write the frame and read it back.

        Ends recomputation for frames used more than once, survives executor
        loss, and later reads prune its columns. What the write shuffled is
        removed with its end: the table stands in for it.
        """
        path = self.path(name)
        before = self.spark.conf.get(_SHUFFLE_CLEANUP)
        self.spark.conf.set(_SHUFFLE_CLEANUP, "true")
        try:
            df.write.options(**options).parquet(path)
        finally:
            self.spark.conf.set(_SHUFFLE_CLEANUP, before)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self._paths[stored] = path
        return stored

    def drop(self, *tables: DataFrame) -> None:
        """Remove stored tables that nothing reads any more; each as ``store`` returned it."""
        for table in tables:
            remove_path(self.spark, self._paths.pop(table))

    def close(self) -> None:
        """Remove the folder and everything in it."""
        _open_workspaces.discard(self)
        remove_path(self.spark, self.root)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


_open_workspaces: set[Workspace] = set()


@atexit.register
def _close_workspaces() -> None:
    for workspace in list(_open_workspaces):
        with contextlib.suppress(Exception):  # the session may be gone
            workspace.close()


def _store(spark: SparkSession, path: str):
    """(Hadoop path, the file system that holds it)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store holds it."""
    target, store = _store(spark, path)
    store.delete(target, True)


def store_scheme(spark: SparkSession, path: str) -> str:
    """Scheme of the store that holds a path, the default one's where the path names none."""
    return _store(spark, path)[1].getUri().getScheme()


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Put a file or folder in the place of another one of the same store."""
    start, store = _store(spark, source)
    end, _ = _store(spark, target)
    store.delete(end, True)
    store.mkdirs(end.getParent())
    if not store.rename(start, end):
        raise OSError(f"could not move {source} to {target}")
