"""Session settings the engine relies on, and where it may put intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

SHUFFLE_BYTES = 64 * 1024 * 1024

_LOCAL_FOLDER: list[str] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("forgelake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results depend on; all sizing stays with whoever made the session."""
    # Event times are UTC instants: calendar days must not follow the machine's zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for one action; the former ones come back afterwards."""
    former = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in former.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def room_for(spark: SparkSession, input_bytes: int):
    """Settings for a job over that much input.

    Shuffles start with a partition per 64 MB, so that one fits into a task's memory, if the
    session does not give more already; adaptive execution merges those that turn out small.
    """
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    given = spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions")
    wanted = input_bytes // SHUFFLE_BYTES
    return settings(spark, {initial: str(wanted)} if wanted > int(given) else {})


def together(spark: SparkSession, *steps: Callable[[], object]) -> None:
    """Independent steps side by side, so that the last tasks of one do not leave the cores to wait.

    All are waited for; then the first error, if any, is raised.
    """
    if len(steps) < 2:
        for step in steps:
            step()
        return
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for one in running:
        one.result()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a single-machine
    session without that setting gets a local temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        if not _LOCAL_FOLDER:
            _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="forgelake-"))
        root = _LOCAL_FOLDER[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
