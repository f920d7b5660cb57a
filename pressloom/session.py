"""Session defaults and lineage cutting."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession

# Settings the jobs rely on.  Shuffle width and split size are left to the
# cluster: AQE coalesces or splits whatever it starts from.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the Python call site of every Column call costs more than the
    # call; the page expressions make thousands.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Tables written by this process and not yet removed.
_SAVED: list[str] = []


def build_session(app_name: str = "pressloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, since
    no other machine needs to reach it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="pressloom-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession) -> str:
    """A name for files of a job in the shared folder; ``drop_saved`` removes what is there."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    _SAVED.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back; the job runs here.

    What reads it does not compute it again, also after a lost executor, and
    the planner knows its size when it chooses a join.  ``drop_saved`` removes
    such tables when nothing reads them any more.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_count() -> int:
    """How many tables were saved so far and not removed."""
    return len(_SAVED)


def drop_saved(spark: SparkSession, since: int = 0, but_last: bool = False) -> int:
    """Remove the tables that ``cut_lineage`` wrote, from that one on, the last excepted if so asked; how many there were."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    end = len(_SAVED) - 1 if but_last else len(_SAVED)
    paths = _SAVED[since:end]
    del _SAVED[since:end]
    for path in paths:
        place = hadoop.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def built_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """Keep the Column a function builds, per application and arguments.

    The page expressions have thousands of nodes; putting them together takes
    longer than reading a few pages.
    """

    @functools.lru_cache(maxsize=256)
    def kept(application: str, *args) -> Column:
        return build(*args)

    @functools.wraps(build)
    def cached(*args) -> Column:
        return kept(SparkContext.getOrCreate().applicationId, *args)

    return cached
