"""Where intermediate tables go, and how index tables are laid out and reopened."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediates that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    without that setting gets a folder of its own; a cluster session without it is
    an error, because a machine-local folder would not be seen by the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="trawl-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else writes to."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows starts from there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """One spelling of a path: with scheme, absolute, without a trailing slash."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.makeQualified(place).toString()


def table_name(path: str, table: str) -> str:
    """Catalog name of an index table, fixed by the qualified index location."""
    return f"trawl_{hashlib.md5(path.encode()).hexdigest()[:12]}_{table}"


def write_bucketed(
    df: DataFrame, path: str, table: str, buckets: int, key: str, sort: str
) -> DataFrame:
    """Write ``df`` as an external Parquet table hash-bucketed by ``key``.

    Joins and groupings whose keys include ``key`` then need no exchange, and the
    order inside each file lets Parquet skip pages on ``sort``.
    """
    path = qualified(df.sparkSession, path)
    name = table_name(path, table)
    (
        df.write.mode("overwrite")
        .format("parquet")
        .option("path", f"{path}/{table}")
        .bucketBy(buckets, key)
        .sortBy(sort)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


@contextmanager
def bucket_by_bucket(spark: SparkSession) -> Iterator[None]:
    """Bucketed tables are read one task per bucket, also where no join or grouping asks
    for it. Else a copy of many buckets has a file per bucket from every task."""
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def open_bucketed(
    spark: SparkSession,
    path: str,
    table: str,
    schema: T.StructType,
    buckets: int,
    key: str,
    sort: str,
) -> DataFrame:
    """Declare an already written bucketed table in this session's catalog.

    Another session may have written it anew: an entry with other buckets is replaced,
    and the files are listed again.
    """
    path = qualified(spark, path)
    name = table_name(path, table)
    if spark.catalog.tableExists(name):
        described = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
        if described is None or int(described.data_type) != buckets:
            spark.sql(f"DROP TABLE {name}")
        else:
            spark.catalog.refreshTable(name)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({sort}) INTO {buckets} BUCKETS "
            f"LOCATION '{path}/{table}'"
        )
    return spark.table(name)


def drop_tables(spark: SparkSession, path: str, tables: tuple[str, ...]) -> None:
    """Forget the index tables; the files of an external table stay."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table_name(qualified(spark, path), table)}")
