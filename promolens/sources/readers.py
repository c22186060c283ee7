"""Scans and sinks: JSON with a fixed schema, catalog tables, overwriting table writes."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

VERSION = "__v"


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Line-mode JSON scan; malformed records become NULL rows (PERMISSIVE), no inference job.

    A line that holds an array yields one row per element.
    """
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def shared_folder(checkpoints: str | None, warehouse: str, master: str) -> str:
    """Where driver and executors both read and write: the named checkpoint folder, else the
    warehouse, unless that is a folder of one machine while executors run on others."""
    if checkpoints:
        return checkpoints
    local = warehouse.startswith(("file:", "/"))
    if local and not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("on a cluster spark.checkpoint.dir has to name a shared folder")
    return warehouse


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share, removed when the application ends.

    It lies below `spark.checkpoint.dir`, or below the warehouse where the session names none; see
    `shared_folder`.
    """
    shared = shared_folder(
        spark.conf.get("spark.checkpoint.dir", None),
        spark.conf.get("spark.sql.warehouse.dir"),
        spark.conf.get("spark.master", "local"),
    )
    name = uuid.uuid4().hex
    folder = f"{shared.rstrip('/')}/promolens-{name}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/{name}"


@dataclass(frozen=True)
class Clustering:
    """Rows of equal `keys` in one bucket, each bucket sorted by `keys` and `order`.

    A scan of such a table gives its rows by key without a shuffle. A key whose rows no task can
    hold does not belong into it.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    buckets: int = 200


def write_tables(
    tables: Mapping[str, DataFrame],
    path: str | None = None,
    clustering: Mapping[str, Clustering] | None = None,
) -> None:
    """Replace each named catalog table, its schema included; see `replace_table`."""
    for name, df in tables.items():
        replace_table(name, df, path, (clustering or {}).get(name))


def replace_table(
    name: str, df: DataFrame, path: str | None = None, clustering: Clustering | None = None
) -> None:
    """Write `df` as a new version of `name`, then point `name` to it.

    `name` is a view of its newest version, and moving it is one step of the catalog: a reader
    sees all old rows or all new ones, and a write that fails leaves the old ones. The version
    before stays for readers that have begun with it; older ones are dropped. With `path`, versions
    are external tables below that folder; without, the catalog places them.
    """
    spark = df.sparkSession
    version = f"{name}{VERSION}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    if clustering:
        keys, order = clustering.keys, clustering.order
        # One task writes one bucket, as one sorted file.
        df = df.repartition(clustering.buckets, *keys).sortWithinPartitions(*keys, *order)
        writer = df.write.bucketBy(clustering.buckets, *keys).sortBy(*keys, *order)
    else:
        writer = df.write
    if path:
        writer = writer.option("path", f"{path}/{name}/{version}")
    writer.saveAsTable(version)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        # A table written by other means becomes the first version.
        spark.sql(f"ALTER TABLE `{name}` RENAME TO `{name}{VERSION}{0:020d}`")
    spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS SELECT * FROM `{version}`")
    for old in table_versions(spark, name)[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS `{old}`")


def table_versions(spark: SparkSession, name: str) -> list[str]:
    """Names of the stored versions of a table, oldest first."""
    # The catalog's pattern takes * alone as special; names are matched in lower case.
    found = spark.catalog.listTables(pattern=f"{name}{VERSION}*")
    return sorted(t.name for t in found)


def drop_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Drop tables with all their versions. Files of external ones stay."""
    for name in names:
        spark.sql(f"DROP VIEW IF EXISTS `{name}`")
        for version in table_versions(spark, name):
            spark.sql(f"DROP TABLE IF EXISTS `{version}`")
