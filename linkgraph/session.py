"""Session helpers: shared scratch space and lineage cuts.

Scratch data always goes under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), read from the session.  Only a local session (unit
tests) without one gets a folder chosen here; on a cluster its absence is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (``spark.checkpoint.dir``)."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        sc = None
    root = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # unset in a local session (tests): choose a folder and register it
        root = tempfile.mkdtemp(prefix="linkgraph-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
        else:
            spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint root (never reused)."""
    return f"{checkpoint_root(spark)}/linkgraph/{name}-{uuid.uuid4().hex[:12]}"


class Scope:
    """Stored tables and cached steps of one job, given back together (see ``scratch_scope``)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[str] = []
        self.cached: list[DataFrame] = []
        self._stored: dict[int, list[tuple[DataFrame, DataFrame]]] = {}

    def find(self, df: DataFrame) -> DataFrame | None:
        """The stored table of an equal plan, if this scope has one."""
        return next((back for plan, back in self._stored.get(df.semanticHash(), []) if plan.sameSemantics(df)), None)

    def add(self, df: DataFrame, back: DataFrame, path: str) -> None:
        self.folders.append(path)
        self._stored.setdefault(df.semanticHash(), []).append((df, back))

    def keep(self, df: DataFrame, name: str = "result") -> DataFrame:
        """Store a result that outlives the scope."""
        return _store(df, scratch_path(self.spark, name))

    def close(self) -> None:
        """Unpersist and delete what the scope owns."""
        for df in self.cached:
            df.unpersist()
        for path in self.folders:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
        self.folders, self.cached, self._stored = [], [], {}


_SCOPES: ContextVar[tuple[Scope, ...]] = ContextVar("linkgraph_scopes", default=())


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scope]:
    """Own the tables that ``cut_lineage`` stores, and the steps that ``cache`` marks, inside the block.

    At the end, or after a failure, folders are deleted and caches unpersisted, so
    results must have been written by then (``scope.keep`` stores one that stays).
    Inside a scope, storing an equal plan again gives the table that is there.
    Scopes may be nested; the innermost one owns.
    """
    scope = Scope(spark)
    token = _SCOPES.set((*_SCOPES.get(), scope))
    try:
        yield scope
    finally:
        _SCOPES.reset(token)
        scope.close()


def _scope(spark: SparkSession) -> Scope | None:
    found = _SCOPES.get()
    return found[-1] if found and found[-1].spark is spark else None


def cache(df: DataFrame) -> DataFrame:
    """Mark a table for reuse by several actions (memory, spilling to disk).

    Lost blocks are recomputed from lineage; the scope, or without one the caller,
    unpersists.  For long lineages on a cluster prefer ``cut_lineage``.
    """
    scope = _scope(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if scope:
        scope.cached.append(df)
    return df


def _store(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def cut_lineage(df: DataFrame, name: str = "lineage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Survives the loss of executors (unlike a local checkpoint or a cache) and is
    cheaper than an RDD checkpoint: columnar, compressed, and the read-back gets
    column pruning and filter pushdown like any other table.  Without a
    ``scratch_scope`` around it the folder stays until the checkpoint folder is cleared.
    """
    scope = _scope(df.sparkSession)
    if scope is None:
        return _store(df, scratch_path(df.sparkSession, name))
    back = scope.find(df)
    if back is None:
        path = scratch_path(df.sparkSession, name)
        back = _store(df, path)
        scope.add(df, back, path)
    return back


def local_session(app: str = "linkgraph", cores: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the local bench (AQE on, UI off, UTC)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
