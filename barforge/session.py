"""Session helpers: the time zone and the shared scratch folder (taken from ``spark.checkpoint.dir``; only set when unset)."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


#: Bytecode from which the JVM no longer compiles a method (its -XX:HugeMethodLimit).
_JIT_LIMIT = "8000"


def ensure_utc(spark: SparkSession) -> None:
    """All time arithmetic in this package assumes a UTC session.

    Wide projections also need Spark not to fuse a stage into one method that the JVM then
    interprets for ever: beyond its limit the operators keep methods of their own, which it compiles."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > int(_JIT_LIMIT):
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", _JIT_LIMIT)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    Uses the cluster's checkpoint directory.  Only when the session has none
    (local tests) a private temporary folder is created and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get(_CKPT_KEY, None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="barforge-ckpt-")
        spark.conf.set(_CKPT_KEY, d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared scratch folder."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the session (a path
    without a scheme is on its default file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


# ---------------------------------------------------------------------------
# Materialised intermediates.  A persisted frame keeps the hash partitioning
# and ordering of its plan, so the operators that read it twice (summary and
# join-back of the EWM scan) share one exchange.  MEMORY_AND_DISK: a lost
# executor's blocks are recomputed from lineage.
_PERSISTED: list = []


MATERIALIZE = os.environ.get("BARFORGE_MATERIALIZE", "persist")


def persist(df):
    """Materialise an intermediate that is read more than once.

    ``persist`` (default): MEMORY_AND_DISK cache; keeps the hash
    partitioning and ordering of the plan, and lost blocks are recomputed
    from lineage.  ``checkpoint`` (``BARFORGE_MATERIALIZE=checkpoint``):
    reliable checkpoint into the shared checkpoint folder, which also cuts
    the lineage; it costs an extra computation and a serialized write.
    """
    if MATERIALIZE == "checkpoint":
        scratch_root(df.sparkSession)
        return df.checkpoint(eager=True)
    from pyspark import StorageLevel
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    _PERSISTED.append(out)
    return out


def stored(df):
    """``df`` written as Parquet files in the shared scratch folder, and read from there.

    For wide frames of which later passes read a few columns: a cached block on disk is read whole.
    The files stay, as those of round trips do; the lineage ends here."""
    path = scratch_path(df.sparkSession, "stored")
    # by place: files don't take all names that a frame can have
    places = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    # few doubles come twice: looking each up in a dictionary costs more than all else of the writing
    lookups = {f"parquet.enable.dictionary#{c}": "false" for c, t in places.dtypes if t == "double"}
    with shuffles_removed(df.sparkSession):
        places.write.options(compression="zstd", **lookups).parquet(path)
    return df.sparkSession.read.schema(places.schema).parquet(path).toDF(*df.columns)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Actions inside remove their shuffle files when they end, not when the driver's collector finds them unused
    (what is executed again makes them again)."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def release_cached(keep=()) -> None:
    """Unpersist the intermediates this package persisted, except ``keep``
    (call once a downstream frame that reads them is materialised)."""
    kept = [d for d in _PERSISTED if any(d is k for k in keep)]
    for d in _PERSISTED:
        if not any(d is k for k in keep):
            try:
                d.unpersist()
            except Exception:
                pass
    _PERSISTED[:] = kept
