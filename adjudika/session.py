"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
import zipfile
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import Observation, SparkSession

# Runtime settings the transforms count on. A value the session already sets explicitly is left alone.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot reference may hold a third of a table: let AQE split its join partition by map-output range even when
    # that costs one more exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method above 8 000 bytes of code; beyond it Spark's split-up projections are faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # HTML pages are wide rows: bound an Arrow batch by bytes and not only by its row count.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``RUNTIME_CONF`` to a running session, where it still has Spark's default, and ship the package.

    Every key is a runtime SQL setting. A value that the application or ``spark.conf.set`` gave before stays.
    """
    if spark.conf.get("adjudika.tuned", None) != "true":
        explicit = spark._jsparkSession.sessionState().conf().settings()
        for key, value in RUNTIME_CONF.items():
            if not explicit.containsKey(key):
                spark.conf.set(key, value)
        spark.conf.set("adjudika.tuned", "true")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, wherever they were started."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    folder = tempfile.mkdtemp(prefix="adjudika-package-")  # the driver serves it to the executors until it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "adjudika.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for at, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    out.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), root))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


@lru_cache(maxsize=1)
def _local_root() -> str:
    """One temporary folder of this process, removed when it ends."""
    root = tempfile.mkdtemp(prefix="adjudika-work-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def work_dir(spark: SparkSession, label: str, root: str | None = None) -> str:
    """A fresh folder for checkpoints and intermediate tables, under ``root`` if given.

    Without it, it lies under ``spark.checkpoint.dir`` or the folder given to ``setCheckpointDir``, which every executor can reach. Only a
    local-mode session with neither falls back to a temporary folder; a cluster session is refused.
    """
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    shared = root or spark.conf.get("spark.checkpoint.dir", None) or (given.get() if given.isDefined() else None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _local_root()
    return f"{shared.rstrip('/')}/adjudika-{label}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever storage the path names."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING: dict[str, list] = {}
_CLEANING_LOCK = threading.Lock()


@contextmanager
def _shuffle_cleanup(spark: SparkSession):
    """Shuffle files go with their query inside; with several threads in one session, until the last of them has left."""
    with _CLEANING_LOCK:
        held = _CLEANING.setdefault(spark.sparkContext.applicationId, [0, None])
        if not held[0]:
            held[1] = spark.conf.get(CLEANUP, "false")
            spark.conf.set(CLEANUP, "true")
        held[0] += 1
    try:
        yield
    finally:
        with _CLEANING_LOCK:
            held[0] -= 1
            if not held[0]:
                spark.conf.set(CLEANUP, held[1])


@contextmanager
def joined_where_they_lie(spark: SparkSession):
    """Joins planned inside take rows as both sides were dealt out by some of the join's keys, instead of moving them once more by all keys."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    held = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, held)


#: Compression of the tables of a store and of what its runs write aside: their rows are written several times and read few times.
PACKED = "zstd"


def cut_lineage(df, label: str, codec: str | None = None):
    """Write ``df`` to the shared folder and read it back, so that a lost executor costs a re-read, not a re-run. ``codec``: compression other
    than the session's.

    The shuffle files behind the table go when it is written. The setting holds for this write only: a query whose rows are fetched one by one
    (``toLocalIterator``) still needs its files after it has ended.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark, label)}/table"
    with _shuffle_cleanup(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def cut_counted(df, label: str, codec: str | None = None, **counts):
    """``cut_lineage`` of ``df``, and the given aggregates of its rows, measured while they are written: no further scan."""
    seen = Observation()
    return cut_lineage(df.observe(seen, *(c.alias(name) for name, c in counts.items())), label, codec), seen.get
