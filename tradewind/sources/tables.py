"""Parquet tables, views and JSON extracts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def replace_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
) -> DataFrame:
    """Write ``df`` over whatever is at ``path`` and return the written table.

    With ``partition_by`` the rows are rebalanced on those columns first:
    adaptive execution merges small partition values into few files and splits
    a value that holds much of the table, so no single task writes it.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    elif rebalance:
        df = df.hint("rebalance")
    # Static: a session's dynamic mode would leave the partitions that are not rewritten.
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return df.sparkSession.read.schema(_written_schema(df, partition_by)).parquet(path)


_MANIFESTS = "_published"


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path, path(folder).getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, folder: str) -> list[str]:
    path, files = _file_system(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(path(folder))] if files.exists(path(folder)) else []


def published_version(spark: SparkSession, folder: str) -> int:
    """The number of the last publication in a folder; 0 if there is none."""
    names = _children(spark, f"{folder}/{_MANIFESTS}")
    return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)


def published_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name and path of the tables that were last published together."""
    folder = folder.rstrip("/")
    version = published_version(spark, folder)
    if not version:
        return {}
    text = spark.read.text(f"{folder}/{_MANIFESTS}/{version:06d}.json", wholetext=True).first()["value"]
    return {name: f"{folder}/{place}" for name, place in json.loads(text).items()}


def publish_tables(
    spark: SparkSession,
    folder: str,
    staged: Mapping[str, str],
    before_step: Callable[[str], None] = lambda step: None,
) -> dict[str, str]:
    """Make written tables the folder's current ones, all at once, and return their paths.

    Every table moves to a folder of the new version, which nobody reads yet. The rename
    of one manifest that names them all is the publication: before it the old tables are
    current, after it the new ones, and a second writer's rename fails. The version before
    stays until the next publication, for readers that are under way; what an
    interrupted one left over goes first. ``before_step`` is told each step.
    """
    folder = folder.rstrip("/")
    path, files = _file_system(spark, folder)
    current = published_tables(spark, folder)
    version = published_version(spark, folder) + 1
    for name in staged:
        for old in _children(spark, f"{folder}/{name}"):
            if f"{folder}/{name}/{old}" != current.get(name):
                before_step(f"remove {name}/{old}")
                files.delete(path(f"{folder}/{name}/{old}"), True)
    placed = {name: f"{name}/{version:06d}" for name in staged}
    for name, source in staged.items():
        before_step(f"move {name}")
        files.mkdirs(path(f"{folder}/{name}"))
        if not files.rename(path(source), path(f"{folder}/{placed[name]}")):
            raise OSError(f"could not move {source} to {folder}/{placed[name]}")
    others = {name: place.removeprefix(f"{folder}/") for name, place in current.items() if name not in staged}
    draft = path(f"{folder}/{_MANIFESTS}/{version:06d}.{uuid.uuid4().hex}.draft")
    before_step("write the manifest")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps({**others, **placed}), "utf-8"))
    out.close()
    before_step("publish")
    if not files.rename(draft, path(f"{folder}/{_MANIFESTS}/{version:06d}.json")):
        raise OSError(f"version {version} of {folder} was published by another writer")
    before_step("done")
    return published_tables(spark, folder)


def _written_schema(df: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    data = [f for f in df.schema.fields if f.name not in partition_by]
    keys = [df.schema[name] for name in partition_by]
    return T.StructType(data + keys)


def bucketed_table(
    df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str]
) -> DataFrame:
    """Catalog table bucketed and sorted on ``keys``.

    Joins and aggregations on the bucket keys of two such tables need no
    shuffle; use it for facts that share ``order_id``.
    """
    (
        df.write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def register_views(views: Mapping[str, DataFrame], everywhere: bool = False) -> None:
    """Expose each lazy DataFrame under a name that SQL can query.

    ``everywhere`` makes it known to all sessions of the application as ``global_temp.<name>`` too.
    """
    for name, df in views.items():
        df.createOrReplaceTempView(name)
        if everywhere:
            df.createOrReplaceGlobalTempView(name)


def refresh_views(spark: SparkSession, names: Iterable[str]) -> None:
    """Let views see files that were written at their sources' paths since they were registered."""
    for name in names:
        spark.catalog.refreshTable(name)


def read_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder.rstrip('/')}/{name}") for name in names}


def to_extract_types(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as ISO text."""

    def plain(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.replace(col.cast("string"), F.lit(" "), F.lit("T"))
        return col.alias(field.name)

    return df.select(*[plain(field) for field in df.schema.fields])


def export_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write an extract as JSON lines, NULLs included.

    The executors write it; nothing passes through the driver. ``single_file``
    is for extracts of known small size (monthly series, top lists) that end
    in a sort or limit: the shuffle of that step keeps all work before it
    parallel, and only the final rows go through one task.
    """
    out = to_extract_types(df)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
