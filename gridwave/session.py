"""Session construction and the shared working folder.

On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
system path the cluster names).  Only when it is unset -- tests, a laptop --
do we make a local one.
"""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


ARROW_RECORDS_PER_BATCH = 256


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "gridwave") -> SparkSession:
    """A session with the settings every job here assumes (UTC, AQE, no UI)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Rows of the Arrow hops are whole recording files (binary decode) or
        # whole waveforms (plug-in scorer): keep batches small so one batch
        # never holds thousands of files in a Python worker.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_RECORDS_PER_BATCH))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("GRIDWAVE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, once per application.

    Needed wherever the workers' path does not hold the repository; with
    ``spark-submit --py-files gridwave.zip`` the call only repeats that.  The
    archive goes through the shared folder, like everything that executors read.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/package-{app}/gridwave.zip")
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(held.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(target.toString())
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; make a local one only when none is named.

    ``spark.checkpoint.dir`` is a core setting that cannot be changed at run
    time, so a folder made here is remembered per application and registered
    with ``setCheckpointDir`` instead.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app in _LOCAL_DIRS:
        return _LOCAL_DIRS[app]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="gridwave-")
    _LOCAL_DIRS[app] = local
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(local + "/rdd")
    return local


def staging_path(spark: SparkSession, *parts: str) -> str:
    """A stable folder under the shared dir, keyed by the given parts."""
    key = hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]
    return f"{shared_dir(spark)}/{parts[0]}-{key}"


def table_stamp(spark: SparkSession, path: str) -> str:
    """Hash of the names, lengths and modification times of a table's files."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listing, seen = fs.listFiles(hpath, True), []
    while listing.hasNext():
        st = listing.next()
        seen.append(f"{st.getPath()} {st.getLen()} {st.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(seen)).encode()).hexdigest()[:16]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def _renamed(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename; False where the target is there already.

    ``FileContext.rename`` refuses an existing target instead of moving the
    folder into it.  It is as atomic as the store's own rename.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(s.getFileSystem(conf).getUri(), conf)
    try:
        context.rename(s, d, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError:
        if not path_exists(spark, dst):
            raise
        return False
    return True


def publish(spark: SparkSession, src: str, dst: str) -> str:
    """Give a finished folder its name; where another run was first, its folder stays."""
    _renamed(spark, src, dst)
    return dst


def put_if_absent(spark: SparkSession, path: str, content: bytes) -> bool:
    """Write a small file whole, unless there is one of that name: then False."""
    jvm = spark.sparkContext._jvm
    folder, name = path.rsplit("/", 1)
    hidden = jvm.org.apache.hadoop.fs.Path(f"{folder}/_{name}-{uuid.uuid4().hex}")
    fs = hidden.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(hidden, False)
    out.write(bytearray(content))
    out.close()
    done = _renamed(spark, hidden.toString(), path)
    if not done:
        fs.delete(hidden, False)
    return done


LISTING_PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def bounded_listing(spark: SparkSession):
    """Cap the file-listing job at the cluster's parallelism while in scope.

    A file stream hands each micro-batch an explicit list of new files; by
    default Spark lists them in a job with one task per file (up to 10,000),
    which costs more than reading small recording files.  One task per core
    keeps the listing parallel (needed on object stores) without that cost.
    """
    old = spark.conf.get(LISTING_PARALLELISM, None)
    spark.conf.set(LISTING_PARALLELISM, str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(LISTING_PARALLELISM)
        else:
            spark.conf.set(LISTING_PARALLELISM, old)
