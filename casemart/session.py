"""Session settings and the shared work folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings that matter on a large cluster; all of them are ordinary Spark options.
CLUSTER_SETTINGS = {
    # Adaptive execution picks partition counts, splits skewed joins and turns
    # joins into broadcasts only after it has seen the real size of a side.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def session(app_name: str = "casemart", settings: dict[str, str] | None = None) -> SparkSession:
    """A session with CLUSTER_SETTINGS, overridden by `settings`."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**CLUSTER_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    It is the one named in spark.checkpoint.dir, which every executor can reach.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


# Shuffles start with one partition per this many input bytes, and scans take no
# more into a task, up to a number of partitions that the driver can still track;
# beyond it partitions grow and sorts spill. Columns compress well: this many
# bytes of raw tickets are 700,000 rows, or 290 MB when a task sorts them.
# run_pipeline takes others as parameters.
BYTES_PER_PARTITION = 16 << 20
MOST_PARTITIONS = 40_000


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A session setting that lasts for a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffles_released(spark: SparkSession):
    """Queries planned in this block delete their shuffle files when they end, instead of when the driver next collects garbage."""
    return setting(spark, CLEANUP, "true")


def input_bytes(frame: DataFrame) -> int:
    """The size of the tables a frame reads, as Spark's statistics have it.

    Files count with their length; no file is opened and no job runs. Rows that a
    program made itself have no known size and count as nothing.
    """
    spark = frame.sparkSession
    unknown = spark._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.length())]
    return sum(size for size in sizes if size < unknown)


def _split_bytes(frame: DataFrame, bytes_per_partition: int, most_partitions: int) -> int:
    """What a task of a scan may read of the tables of `frame`: no more than the session allows."""
    allowed = frame.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return min(allowed, max(bytes_per_partition, -(-input_bytes(frame) // most_partitions)))


def lower_splits(
    frame: DataFrame,
    bytes_per_partition: int = BYTES_PER_PARTITION,
    most_partitions: int = MOST_PARTITIONS,
) -> None:
    """Let scans take no more into a task from now on, in the whole session, for frames that run later."""
    split = _split_bytes(frame, bytes_per_partition, most_partitions)
    frame.sparkSession.conf.set("spark.sql.files.maxPartitionBytes", str(split))


@contextmanager
def sized_shuffles(
    frame: DataFrame,
    bytes_per_partition: int = BYTES_PER_PARTITION,
    most_partitions: int = MOST_PARTITIONS,
) -> Iterator[int]:
    """Size the shuffles and the scans of a block by the tables that `frame` reads.

    Adaptive execution merges partitions that turn out small but never starts
    with more than its initial number, which by default does not know the input.
    The number is only raised, and left alone when the session sets it. What a
    task of a scan reads is only lowered: it is sorted there before the shuffle of
    a deduplication. The settings are the session's, so other queries of the
    session see them meanwhile.
    """
    spark = frame.sparkSession
    size = input_bytes(frame)
    split = _split_bytes(frame, bytes_per_partition, most_partitions)
    with setting(spark, "spark.sql.files.maxPartitionBytes", split):
        initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        chosen = spark.conf.get(initial, None)
        if chosen is not None:
            yield int(chosen)
            return
        wanted = min(-(-size // bytes_per_partition), most_partitions)
        number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
        with setting(spark, initial, number):
            yield number


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run independent Spark jobs at once, so that one's tail does not idle the rest."""
    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(in_session(job)) for job in jobs]
        return [job.result() for job in running]
