"""Session settings, size checks and durable lineage cuts."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

TABLE = "table-"
# A group may hold at most this many rows in one task; larger groups are sliced.
ROWS_PER_TASK = "spark.kohorta.rowsPerTask"
ROWS_PER_TASK_DEFAULT = 5_000_000
# Inputs whose planned size is below this fit one task, so no group can be too large.
BYTES_PER_TASK = "spark.kohorta.bytesPerTask"
BYTES_PER_TASK_DEFAULT = 256 * 1024 * 1024
# Keys that a bucket of a wide merge is made for; a small merge has LEAST_BUCKETS.
KEYS_PER_BUCKET, LEAST_BUCKETS = 100_000, 4
# Independent steps that run at a time: more would only queue for the same executors.
STEPS_AT_A_TIME = 8


def build_session(app: str = "kohorta", cpus: int | str = "*", shuffle: int = 8) -> SparkSession:
    """Local session for tests and the bench; a cluster supplies its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="kohorta-code-")) / "kohorta_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def rows_per_task(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_PER_TASK, str(ROWS_PER_TASK_DEFAULT)))


def source_bytes(df: DataFrame) -> int | None:
    """Size of the tables that the frame reads, or None where it cannot be told.

    Sizes of join results are not used: the optimizer multiplies both sides.
    """
    try:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except AttributeError:
        return None


def makes_rows(df: DataFrame) -> bool:
    """Whether rows are exploded anywhere in the plan, so that sources say nothing of its size."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    except AttributeError:
        return True
    return any(line.lstrip(" :+-").startswith(("Generate ", "Expand ")) for line in plan.splitlines())


def fits_one_task(df: DataFrame) -> bool:
    """True when even the whole input would be a fair share of one task."""
    size = source_bytes(df)
    limit = int(df.sparkSession.conf.get(BYTES_PER_TASK, str(BYTES_PER_TASK_DEFAULT)))
    return size is not None and size <= limit and not makes_rows(df)


def fits_broadcast(df: DataFrame) -> bool:
    """True for a written table, as it was read, that Spark would send whole to every task."""
    try:
        plan = df._jdf.queryExecution().analyzed()
        limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    except AttributeError:
        return False
    size = source_bytes(df)
    return not plan.children().size() and size is not None and size <= limit


def planned_broadcast(df: DataFrame) -> bool:
    """True where Spark, by the size that it plans with, would send the frame whole to every task."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        return size <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    except AttributeError:
        return False


_FOLDER_LOCK = threading.Lock()


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors see: the one named in ``spark.checkpoint.dir``.

    Only a local master may go without; it gets a scratch folder that goes with
    the process.
    """
    with _FOLDER_LOCK:
        return _shared_folder(spark)


def _shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            master = context.master
            if not (master == "local" or master.startswith("local[")):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            named = tempfile.mkdtemp(prefix="kohorta-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
        current = context.getCheckpointDir()
    return current


def release(spark: SparkSession) -> None:
    """Deletes the tables that ``durable`` has written for this application.

    For the end of a run: results that were not written elsewhere go with them.
    """
    while _BUCKETED:
        spark.sql(f"DROP TABLE IF EXISTS {_BUCKETED.popitem()[0]}")
    folder = shared_folder(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        if status.getPath().getName().startswith(TABLE):
            files.delete(status.getPath(), True)
    _FOUND.clear()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Later steps read only the columns they need, know the table's size, and
    survive lost executors without computing ``df`` again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{TABLE}{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Names of the bucketed tables written for this application, with their number of buckets.
_BUCKETED: dict[str, int] = {}
# Bytes of source files that a bucket of event rows is made for.
BYTES_PER_BUCKET = 16 * 1024 * 1024
# Sources that are no files have a size beyond this in Spark; their rows are counted, at so many bytes each.
SIZE_UNKNOWN, BYTES_PER_ROW = 1 << 60, 64


def buckets_for(keys: int) -> int:
    """A power of two, so that tables of different size still fit each other's buckets."""
    return max(LEAST_BUCKETS, 1 << (math.ceil(keys / KEYS_PER_BUCKET) - 1).bit_length())


def row_buckets(df: DataFrame) -> int:
    """Buckets for a table of many rows per key, by the size of its sources.

    Not fewer than a shuffle has partitions: Spark would shuffle once more to get those.
    """
    size = source_bytes(df)
    if size is None or size >= SIZE_UNKNOWN:
        size = df.count() * BYTES_PER_ROW
    shares = math.ceil(size / BYTES_PER_BUCKET)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 << (max(shares, least, LEAST_BUCKETS) - 1).bit_length()


def buckets_of(df: DataFrame) -> int | None:
    """Number of buckets of the first bucketed table that the frame reads, if any."""
    try:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        names = " ".join(leaves.apply(i).toString() for i in range(leaves.size()))
    except AttributeError:
        return None
    return next((n for name, n in _BUCKETED.items() if name in names), None)


def durable_like(df: DataFrame, key: str, rows: DataFrame) -> DataFrame:
    """``durable``, in buckets where ``rows``, from which ``df`` comes, lie in buckets by ``key``."""
    buckets = buckets_of(rows)
    return durable(df) if buckets is None else bucketed(df, key, buckets)


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Like ``durable``, in a table bucketed and sorted by ``key``, one file a bucket.

    Tables with the same number of buckets are joined on that key without a
    shuffle. One task writes one bucket, so this is for tables with few rows per
    key. Columns have plain names in the table, as catalogs limit what a name may
    hold; missing keys stay.
    """
    spark = df.sparkSession
    # A bucket is one file, so what is read is known to be in the order of the key.
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    # Joins by the key and further columns keep the buckets too.
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    mark = uuid.uuid4().hex
    name = f"kohorta_{mark}"
    stored = [f"c{i}" for i in range(len(df.columns))]
    place = stored[df.columns.index(key)]
    rows = df.toDF(*stored).repartition(buckets, place)
    writer = rows.write.bucketBy(buckets, place).sortBy(place).format("parquet")
    _BUCKETED[name] = buckets
    writer.option("path", f"{shared_folder(spark)}/{TABLE}{mark}").saveAsTable(name)
    return spark.read.table(name).toDF(*df.columns)


def together(spark: SparkSession, *steps: Callable) -> list:
    """Results of steps that do not need each other, run side by side.

    A step waits for its own jobs only, so that the tasks of small steps fill the
    executors which a single one leaves idle. The first error is raised when all
    steps have ended.
    """
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(STEPS_AT_A_TIME) as pool:
        running = [pool.submit(inherit(step)) for step in steps]
    return [step.result() for step in running]


def settled(df: DataFrame) -> DataFrame:
    """For a small result of large tables that is read several times: write it once.

    Results of small tables are left as they are.
    """
    return df if fits_one_task(df) else durable(df)


# Large keys of the tables asked for last, so that steps on one table count it once.
# A list that has become old is still right to use: it only says which rows to slice.
_FOUND: dict[tuple, tuple[DataFrame, DataFrame | None]] = {}
MOST_FOUND = 64
_FOUND_LOCK = threading.Lock()


_ORDINARY = threading.local()


def _stays_small(df: DataFrame, times: int) -> bool:
    """Whether frames with ``times`` the rows of ``df`` fit one task too.

    Only of one source, as counting a join costs more than it may save.
    """
    if not fits_one_task(df):
        return False
    limit = int(df.sparkSession.conf.get(BYTES_PER_TASK, str(BYTES_PER_TASK_DEFAULT)))
    return source_bytes(df) * times <= limit or df._jdf.queryExecution().analyzed().collectLeaves().size() > 1


@contextmanager
def ordinary(df: DataFrame, key: str, times: int = 4) -> Iterator[None]:
    """One count of ``df`` by ``key`` stands for those of all frames made within the block.

    For steps whose frames hold a row of ``df`` at most ``times`` times. Where ``df``
    has a group that could become too large for a task, every frame is counted.
    """
    held = getattr(_ORDINARY, "keys", frozenset())
    if key not in held and not _stays_small(df, times):
        most = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most * times <= rows_per_task(df.sparkSession):
            _ORDINARY.keys = held | {key}
    try:
        yield
    finally:
        _ORDINARY.keys = held


def large_groups(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """Keys with more rows than one task should take, with their counts ``n``.

    None when there is none. The result has at most rows / ROWS_PER_TASK rows,
    and the count is combined map-side, so finding it is cheap at any skew.
    """
    if not getattr(_ORDINARY, "keys", frozenset()).isdisjoint(keys) or fits_one_task(df):
        return None
    limit = rows_per_task(df.sparkSession)
    name = (df.sparkSession.sparkContext.applicationId, tuple(keys), limit, df.semanticHash())
    known = _FOUND.get(name)
    if known is not None and known[0].sameSemantics(df):
        return known[1]
    counts = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > limit)
    )
    counts = durable(counts)
    found = None if counts.isEmpty() else counts
    with _FOUND_LOCK:
        while len(_FOUND) >= MOST_FOUND:
            _FOUND.pop(next(iter(_FOUND)))
        _FOUND[name] = (df, found)
    return found


def rows_in_buckets(df: DataFrame, key: str) -> DataFrame:
    """``df`` in buckets by ``key``, so that a task's share does not grow with the table.

    Tables of one bucket's size are left as they are, and tables with a key that
    has more rows than one task should take, which would fill a bucket.
    """
    size = source_bytes(df)
    if size is not None and size <= BYTES_PER_BUCKET or large_groups(df, [key]) is not None:
        return df
    return bucketed(df, key, row_buckets(df))
