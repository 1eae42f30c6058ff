"""Session helpers for tests, the bench and local runs.

The library itself never creates a session: every operator takes DataFrames. These helpers only build a
local session with the settings the tests assume, and find the shared folder for materialised stages.
"""

from __future__ import annotations

import io
import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "trolley") -> SparkSession:
    """A local session: AQE on, UI off, UTC, ANSI left at the Spark 4 default (on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TROLLEY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is. Where it is unset, a folder under the
    system temp directory is made for a local master; on a cluster each executor would write its part to its own
    disk there, so that is an error.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = sc.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        path = tempfile.mkdtemp(prefix="trolley-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - some deployments reject runtime changes of core settings
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


PARTITION_BYTES = 4 << 20  # of source files for one shuffle partition; Spark joins small ones at run time
JIT_BYTES = 8000  # of a generated method: the JVM never compiles a longer one, and rows of many features make such
SPLIT_BYTES = 16 << 20  # of stored files for one scan task: rows of many features are far larger in memory


def session_beside(spark: SparkSession) -> SparkSession:
    """A session with the same catalog and a copy of the settings, so that the user's session is left as it is."""
    s = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            s.conf.set(k, v)
    return s


def sized_session(spark: SparkSession, source_bytes: int) -> SparkSession:
    """A session beside the given one whose tasks keep their size as the sources grow.

    The number of shuffle partitions is at least one for ``PARTITION_BYTES`` of the sources (a fixed one lets sorts spill
    more and more), and a scan task reads at most ``SPLIT_BYTES``. Shuffle partitions are joined up to that size: each is a
    stored file of one row group, which a scan does not split. Stages whose generated method is longer than ``JIT_BYTES``
    run operator by operator instead of interpreted.
    """
    s = session_beside(spark)
    wanted = -(-source_bytes // PARTITION_BYTES)
    if wanted > int(s.conf.get("spark.sql.shuffle.partitions")):
        s.conf.set("spark.sql.shuffle.partitions", str(wanted))
    split = s._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    s.conf.set("spark.sql.files.maxPartitionBytes", str(min(split, SPLIT_BYTES)))
    joined = s._jsparkSession.sessionState().conf().getConfString("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    bytes_of = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    s.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(bytes_of(joined), SPLIT_BYTES)))
    limit = int(s.conf.get("spark.sql.codegen.hugeMethodLimit"))
    s.conf.set("spark.sql.codegen.hugeMethodLimit", str(min(limit, JIT_BYTES)))
    return s


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings while a stage is built; put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stage_dir(spark: SparkSession, name: str) -> str:
    """A per-application folder below the checkpoint folder for written stage tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    app = spark.sparkContext.applicationId or uuid.uuid4().hex
    return f"{base}/trolley-stages/{app}/{name}"


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (as ``--py-files`` does), once per application, by way of the shared folder."""
    app = spark.sparkContext.applicationId
    with _SHIPPING:
        if app in _SHIPPED:
            return
        root = os.path.dirname(os.path.abspath(__file__))
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            for folder, _, names in os.walk(root):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.join("trolley", os.path.relpath(full, root)))
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{stage_dir(spark, 'package')}-{uuid.uuid4().hex}/trolley.zip")
        out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
        out.write(data.getvalue())
        out.close()
        spark.sparkContext.addPyFile(path.toString())
        _SHIPPED.add(app)
