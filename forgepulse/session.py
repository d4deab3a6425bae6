"""Session defaults and the shared folder that intermediate tables go to."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

PARTITION_BYTES = 128 * 1024 * 1024

# Skew splits, broadcasts and the merging of small partitions are left to adaptive execution,
# which decides from measured shuffle sizes. It merges partitions but never adds any, so their
# number must be high enough for the largest shuffle: see ``shuffle_conf``.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

MIN_PARTITIONS = 200

_local_folders: dict[str, str] = {}
_written: list[str] = []


def build_session(
    app: str = "forgepulse", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_conf(shuffle_bytes: int) -> dict[str, str]:
    """Partition count for a largest shuffle of ``shuffle_bytes``, to hand to ``build_session``.

    For the models that is roughly the size of the staging columns they use; for building the
    staging relation, its whole size.
    """
    count = max(MIN_PARTITIONS, -(-shuffle_bytes // PARTITION_BYTES))
    return {"spark.sql.shuffle.partitions": str(count)}


def shared_folder(spark: SparkSession) -> str:
    """Root for written intermediates: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be invisible to other executors, so that is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="forgepulse-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder (nothing is created yet); what is written
    there is deleted when the driver's process ends."""
    path = f"{shared_folder(spark)}/forgepulse/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def settle(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder, in folders of the values of ``by``, and return a scan of it.

    For relations read by two branches of one plan: the work above is done once, each branch
    reads only its columns, and a lost executor costs a re-read instead of a recomputation.
    """
    path = new_folder(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(path: str) -> str | None:
    """A path of this machine's file system without its scheme; None for any other store."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return path if path.startswith("/") else None


def file_system(path: str):
    """File system and path there of a folder that Spark names, for work that is not Spark's."""
    from pyarrow import fs

    local = local_path(path)
    return (fs.LocalFileSystem(), local) if local else fs.FileSystem.from_uri(path)


def remove(path: str) -> None:
    """Delete a folder of intermediates, if it is there."""
    from pyarrow import fs

    files, name = file_system(path)
    if files.get_file_info(name).type == fs.FileType.Directory:
        files.delete_dir(name)


@atexit.register
def remove_intermediates() -> None:
    """Delete what this process has written to the shared folder as intermediates."""
    for path in _written:
        try:
            remove(path)
        except OSError:  # a store that this process cannot reach any more
            break
    _written.clear()
