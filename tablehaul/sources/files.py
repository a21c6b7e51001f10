"""Folders on the shared file system: staging, sizes, moves."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Shared scratch folder: ``spark.checkpoint.dir`` of the session.

    A temporary folder of this machine stands in only where the setting is absent
    and the session is local; on a cluster executors could not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tablehaul-")
    return _LOCAL_DIRS[app]


def _own_dir(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/tablehaul/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Delete what this application staged; frames that read it are of no use afterwards."""
    remove_dir(spark, _own_dir(spark))


# Spark's setting by which the shuffle files of a query go when it ends.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str, codec: str | None = None, free: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back; later passes see one result.

    With ``free`` the shuffle files behind it, which nothing reads again, go as soon as it is written.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    writer = df.write.option("compression", codec) if codec else df.write
    before = spark.conf.get(_FREE, None)
    if free:
        spark.conf.set(_FREE, "true")
    try:
        writer.parquet(path)
    finally:
        if free and before is None:
            spark.conf.unset(_FREE)
        elif free:
            spark.conf.set(_FREE, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a ``staged`` frame that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if f"/tablehaul/{spark.sparkContext.applicationId}/" in folder:
            remove_dir(spark, folder)


def total_bytes(spark: SparkSession, path: str) -> int:
    """Size of a folder from file-system metadata."""
    fs, target = _file_system(spark, path)
    return fs.getContentSummary(target).getLength()


def source_bytes(df: DataFrame) -> int | None:
    """Bytes that the scans below a frame read, None where they are not known (JDBC).

    Not the planner's estimate of the result, which multiplies both sides of a join.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(sizes) if sizes and max(sizes) < 2**60 else None


# Plan nodes under which a scan's partitions reach the caller as they are.
_KEEPS_PARTITIONS = {"Project", "Filter", "SubqueryAlias", "View", "LogicalRelation", "RelationV2", "DataSourceV2ScanRelation"}


def is_plain_scan(df: DataFrame) -> bool:
    """Whether a frame is one scan with columns and rows taken away or computed, so that its partitions are the scan's."""
    nodes = [df._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        children = node.children()
        if node.nodeName().split(" ")[0] not in _KEEPS_PARTITIONS or children.size() > 1:
            return False
        nodes += [children.apply(i) for i in range(children.size())]
    return True


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    fs, target = _file_system(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)]


def move_parts(spark: SparkSession, source: str, target: str, first: int) -> int:
    """Move a folder's part files into another, their part numbers raised by ``first``; returns the next free number."""
    fs, folder = _file_system(spark, source)
    path, after = spark._jvm.org.apache.hadoop.fs.Path, first
    for name in sorted(children(spark, source)):
        if name.startswith("part-"):
            number, rest = int(name.split("-")[1]), name.split("-", 2)[2]
            after = max(after, first + number + 1)
            if not fs.rename(path(f"{source}/{name}"), path(f"{target}/part-{first + number:05d}-{rest}")):
                raise OSError(f"could not move {name} to {target}")
    fs.delete(folder, True)
    return after


def move_file(spark: SparkSession, source: str, target: str) -> None:
    fs, path = _file_system(spark, source)
    if not fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not move {source} to {target}")


def remove_dir(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def replace_dir(spark: SparkSession, new: str, final: str) -> None:
    """Move ``new`` to ``final``. An older ``final`` is removed only after the move."""
    fs, source = _file_system(spark, new)
    target = spark._jvm.org.apache.hadoop.fs.Path(final)
    old = None
    if fs.exists(target):
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{final}.old-{uuid.uuid4().hex}")
        if not fs.rename(target, old):
            raise OSError(f"could not move {final} aside")
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        if old is not None:
            fs.rename(old, target)
        raise OSError(f"could not move {new} to {final}")
    if old is not None:
        fs.delete(old, True)
