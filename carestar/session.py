"""Session construction and shared-storage scratch paths.

On a cluster the session is created by the platform; ``configure`` only fills
the checkpoint folder when it is unset.  Scratch output (round trips, exports, streaming
checkpoints) always goes below ``spark.checkpoint.dir`` — the shared folder the
cluster names — never to a machine-local temporary directory.  Only when that
setting is unset (local tests) do we pick a folder ourselves.
"""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Settings for the sessions this package creates itself (tests, bench, CLI).
# A session handed to us (a cluster's, the driver's) is used as configured:
# Spark 4 already enables AQE, partition coalescing and skew-join splitting by
# default, and the cluster owns sizing and time zone.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # spark.sql.autoBroadcastJoinThreshold is left to the cluster (Spark's 10 MB
    # default): a data-derived dimension is broadcast only while its estimated
    # size is under it, otherwise the join shuffles, and AQE re-plans from the
    # real shuffle sizes.  Parquet estimates are compressed sizes, so the bound
    # is kept conservative rather than raised.
}


def build_session(master: str | None = None, app: str = "carestar", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session; used by tests, bench and the CLI only."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Prepare a session we did not create: only the shared checkpoint folder is
    filled in, and only when the session has none."""
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set to a local folder only when unset (tests)."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        d = tempfile.mkdtemp(prefix="carestar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint dir."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/carestar-scratch/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per context, through a zip in the shared folder."""
    sc = spark.sparkContext
    if _SHIPPED.get(sc) is not None:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), os.path.dirname(top)))
    uri = scratch_path(spark, "package") + ".zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(data.getvalue())
    out.close()
    sc.addPyFile(uri)
    _SHIPPED[sc] = uri


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few local-only helpers (tests)."""
    return path[len("file:"):] if path.startswith("file:") else path


def ensure_dir(path: str) -> None:
    p = local_path(path)
    if "://" not in p:
        os.makedirs(p, exist_ok=True)


# Frames over immutable files, per session: a relation keeps its resolved file
# listing and schema, so a repeated read skips the listing and footer jobs.
_SHIPPED: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_FRAMES: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def cached_frame(spark: SparkSession, key: tuple, load: Callable[[], DataFrame]) -> DataFrame:
    """``load()`` once per ``(spark, key)``; ``key`` must change whenever the
    files behind the frame may have changed."""
    frames = _FRAMES.setdefault(spark, {})
    df = frames.get(key)
    if df is None:
        df = frames.setdefault(key, load())
    return df


def local_signature(path: str) -> str | None:
    """Total size and latest modification time of a local file or folder, or
    None for a remote path (those are read afresh every time)."""
    p = local_path(path)
    if "://" in p or not os.path.exists(p):
        return None
    if not os.path.isdir(p):
        st = os.stat(p)
        return f"{st.st_size}:{st.st_mtime_ns}"
    stats = [os.stat(os.path.join(d, f)) for d, _, fs in os.walk(p) for f in fs]
    return f"{len(stats)}:{sum(s.st_size for s in stats)}:{max((s.st_mtime_ns for s in stats), default=0)}"
