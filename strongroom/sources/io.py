"""Sources and sinks (G9, M10, Q1.2) and lineage cuts.

Vault tables are Parquet directories.  Every load is one append; a rerun
after a failure adds only what is missing, because the loaders are
idempotent.  Lineage is cut with a reliable checkpoint or a table written
under the folder the cluster names in ``spark.checkpoint.dir``; that
setting is read from the session and only set here when it is unset
(local sessions, tests).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where nothing has been written yet; other errors are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


#: Hash keys are hex digits, half of whose length Zstandard saves and Snappy none.
CODEC = "zstd"


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


STORED_PLACE = "_BUCKET"


def append_placed(df: DataFrame, path: str, name: str, column: str) -> str:
    """Write a table in buckets by ``column``, by which its rows are dealt out
    already: one file per partition of a shuffle.  Returns the catalog's name of it; what
    ``read_placed`` reads by that name needs no shuffle by the column."""
    spark = df.sparkSession
    n, table = int(spark.conf.get("spark.sql.shuffle.partitions")), f"spark_catalog.default.{name}_{uuid.uuid4().hex}"
    w = df.withColumnRenamed(column, STORED_PLACE).write.format("parquet").option("compression", CODEC).option("path", path)
    w.bucketBy(n, STORED_PLACE).sortBy(STORED_PLACE).saveAsTable(table)
    return table


def read_placed(spark: SparkSession, name: str, column: str) -> DataFrame:
    """The table with its bucket column under the name ``column``: renamed it is no longer
    qualified by the table, and unions of what comes from several tables see that they lie alike."""
    return spark.table(name).withColumnRenamed(STORED_PLACE, column)


#: Joins on more columns than their rows are dealt out by take the rows where they lie (internal default: they are dealt out anew).
WHERE_THEY_LIE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def placing_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` that joins placed rows where they
    lie.  One of its own, as other joins, whose columns may be skewed, are better dealt out anew."""
    own = spark.newSession()
    for k, v in (spark.conf.getAll | WHERE_THEY_LIE).items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


#: Session setting: the files of a shuffle go when the action that made them ends, not when the driver collects garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession):
    """Actions inside leave no shuffle files on the executors' disks."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write ``df`` and return how many rows that were, counted by the writing job itself."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _folder(spark: SparkSession, path: str):
    """Hadoop path and its file system, whatever store it lies in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table folder was written to its end (Spark leaves ``_SUCCESS`` there)."""
    folder, fs = _folder(spark, f"{path}/_SUCCESS")
    return fs.exists(folder)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``, none where it does not exist."""
    folder, fs = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()) if fs.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table folder that nothing reads any more."""
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    On a cluster this is ``spark.checkpoint.dir``.  Where it is unset, a folder
    in the session's warehouse is set; on a cluster whose warehouse is a folder
    of the driver's machine, which executors don't share, that is an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not named and not sc.master.startswith("local") and re.match(r"(file:)?/", warehouse):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or f"{warehouse}/_checkpoints")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique table folder under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/strongroom/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared folder, survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def same_key(left: str, right: str, cols: Sequence[str]) -> Column:
    """Join condition of two aliased frames on ``cols``, where NULL equals NULL."""
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`"))
    return same


def materialise(df: DataFrame, path: str, mode: str = "overwrite", key: Sequence[str] | None = None, buckets: int = 64) -> DataFrame:
    """Write a view as a table and return the table.

    ``mode='overwrite'`` rebuilds it.  ``mode='incremental'`` appends only rows
    whose ``key`` is not in the table yet, for insert-only views.
    ``mode='refresh'`` also replaces the rows of keys that ``df`` holds, for
    Type 1 tables; rows of other keys stay (see ``refresh``).  NULL is a key
    value like others.
    """
    spark = df.sparkSession
    if mode == "overwrite":
        overwrite(df, path)
    elif mode in ("incremental", "refresh"):
        if not key:
            raise ValueError(f"{mode} materialisation needs key columns")
        if mode == "refresh":
            return refresh(df, path, list(key), buckets)
        stored = read_or_none(spark, path)
        new = df if stored is None else df.alias("n").join(stored.select(*key).alias("s"), same_key("n", "s", key), "left_anti")
        append(new, path)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return spark.read.parquet(path)


def refresh(df: DataFrame, path: str, key: Sequence[str], buckets: int = 64) -> DataFrame:
    """Replace the rows of the keys in ``df`` in a table stored in ``buckets``
    folders by the hash of the key, and return the table.

    A count and two order-free checksums of a key's rows tell whether the key
    changed; only buckets with a changed key are written (dynamic partition
    overwrite), the files of the others stay.  The new buckets are first written
    beside the table to their end; a run that fails before that has changed
    nothing, and one that fails later is brought to its end by the next
    (``finish_refresh``).  So no failure loses rows.
    """
    spark, column = df.sparkSession, f"_BUCKET_OF_{buckets}"
    finish_refresh(spark, path)
    view = df.withColumn(column, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    stored = read_or_none(spark, path)
    new = view
    if stored is not None:
        if column not in stored.columns:
            raise ValueError(f"{path} is not a table refreshed in {buckets} buckets")

        def prints(rows: DataFrame, name: str) -> DataFrame:
            hashes = [F.xxhash64(*df.columns), F.xxhash64(F.lit(1), *df.columns)]
            out = rows.groupBy(*key, column).agg(
                F.count(F.lit(1)).alias("_n"), F.bit_xor(hashes[0]).alias("_x"), F.sum(hashes[1].cast("decimal(38,0)")).alias("_s"))
            return out.alias(name)

        a, b = prints(view, "a"), prints(stored, "b")
        equal = same_key("a", "b", [*key, column, "_n", "_x", "_s"])
        # At most one row per bucket comes.
        touched = [r[0] for r in a.join(b, equal, "left_anti").select(column).distinct().collect()]
        if not touched:
            return stored.drop(column)
        new, old = view.filter(F.col(column).isin(touched)), stored.filter(F.col(column).isin(touched))
        new = new.unionByName(old.alias("s").join(new.select(*key).alias("n"), same_key("s", "n", key), "left_anti"))
    overwrite(new.hint("rebalance", column), _pending(path), [column])
    finish_refresh(spark, path)
    return spark.read.parquet(path).drop(column)


def _pending(path: str) -> str:
    return path.rstrip("/") + "__pending"


def finish_refresh(spark: SparkSession, path: str) -> None:
    """Put the buckets of a finished ``__pending`` folder into the table; the same again after a failure half way."""
    pending = _pending(path)
    if written(spark, pending):
        rows = spark.read.parquet(pending)
        w = rows.write.mode("overwrite").option("compression", CODEC).option("partitionOverwriteMode", "dynamic")
        w.partitionBy(next(c for c in rows.columns if c.startswith("_BUCKET_OF_"))).parquet(path)
        remove(spark, pending)


def row_count_meta(spark: SparkSession, path: str) -> DataFrame:
    """Row count from Parquet footers, without a data scan (Q1.2).

    Uses the V2 Parquet source with aggregate push-down, so the plan shows
    ``PushedAggregation: [COUNT(*)]``; the settings are those of a session of
    its own, so queries that run at the same time don't see them.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    # One aggregated row, answered from metadata.
    rows = own.read.parquet(path).agg(F.count(F.lit(1)).alias("approx_rows")).collect()
    return spark.createDataFrame(rows, "approx_rows bigint")
