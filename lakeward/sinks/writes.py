"""Table writes on plain Parquet: layout, staged partition swap, keyed upsert,
quarantine append, retention report, serving extract.

Overwriting a path while reading it destroys the table, and dynamic
partition overwrite leaves partitions that lost all their rows untouched.
So every in-place change here writes the new content of the touched
partitions to a staging folder next to the table, then swaps partition
folders with the Hadoop FileSystem API and removes the partitions that became
empty.  Old folders are moved aside first and deleted when everything is in
place; every move is checked, and staged data that found no place is an error.
The swap is per partition, not atomic across partitions; a failed job leaves
the table as it was (staging is separate).
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class UpsertError(ValueError):
    pass


class MoveError(OSError):
    """A folder or file could not be moved or removed; the staged data is still there."""


# -- file system helpers ---------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _move(fs, src, dst) -> None:
    """Rename that fails loudly: some file systems only return false."""
    if not fs.rename(src, dst):
        raise MoveError(f"cannot move {src} to {dst}")


def _remove(fs, path) -> None:
    if fs.exists(path) and not fs.delete(path, True):
        raise MoveError(f"cannot remove {path}")


def _data_files(fs, root) -> list:
    """Files below ``root`` that hold rows (metadata-sized: one entry per file)."""
    out, it = [], fs.listFiles(root, True)
    while it.hasNext():
        path = it.next().getPath()
        if not path.getName().startswith(("_", ".")):
            out.append(path)
    return out


def _partition_dir(spark: SparkSession, partition_by: list[str], values: tuple) -> str:
    """Folder of a partition, escaped as Spark's own writer does."""
    path = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(path.getPartitionPathString(c, _fmt(v)) for c, v in zip(partition_by, values))


def _fmt(v) -> str | None:
    """The text Spark casts a partition value to (None: the default partition)."""
    if v is None or v == "":
        return None
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S") + (f".{v.microsecond:06d}".rstrip("0") if v.microsecond else "")
    if isinstance(v, date):
        return v.isoformat()
    return str(v)


# -- layout --------------------------------------------------------------------------------

def layout(df: DataFrame, partition_by: list[str] | tuple = (), cluster_by: list[str] | tuple = ()) -> DataFrame:
    """Range-partition on (partition columns + clustering keys) and sort
    inside tasks.  Range partitioning samples the keys, so a partition value
    holding a third of the rows is split over many tasks (many files) instead
    of one, and the clustering keys end up sorted for min/max pruning."""
    keys = list(partition_by) + [c for c in cluster_by if c not in partition_by]
    if not keys:
        return df
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_table(df: DataFrame, path: str, partition_by: list[str] | tuple = (), fmt: str = "parquet",
                mode: str = "overwrite", cluster_by: list[str] | tuple = ()) -> str:
    """K2/K3/K9: write a tier table with its layout."""
    w = layout(df, partition_by, cluster_by).write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def _partitions_of(df: DataFrame, partition_by: list[str]) -> list[tuple]:
    """Distinct partition values of a frame: one row per partition folder,
    i.e. metadata-sized, so collecting them is bounded by the table layout.
    An empty text is stored as NULL."""
    return sorted({tuple(None if v == "" else v for v in r) for r in df.select(*partition_by).distinct().collect()}, key=str)


def swap_partitions(spark: SparkSession, staged: str, target: str, partition_by: list[str],
                    touched: list[tuple]) -> None:
    """Replace each touched partition folder of ``target`` by the staged one;
    a touched partition with no staged folder is removed (it became empty).
    Raises before anything old is deleted if staged rows are left over."""
    fs, _ = _fs(spark, target)
    aside = f"{target.rstrip('/')}/_replaced_{uuid.uuid4().hex[:8]}"
    for values in touched:
        rel = _partition_dir(spark, partition_by, values)
        src, dst, old = (_path(spark, f"{d}/{rel}") for d in (staged, target, aside))
        if fs.exists(dst):
            fs.mkdirs(old.getParent())
            _move(fs, dst, old)
        if fs.exists(src):
            fs.mkdirs(dst.getParent())
            _move(fs, src, dst)
    left = _data_files(fs, _path(spark, staged)) if fs.exists(_path(spark, staged)) else []
    if left:
        raise MoveError(f"{len(left)} staged files belong to no touched partition, e.g. {left[0]}; replaced folders are in {aside}")
    _remove(fs, _path(spark, aside))


def replace_table(spark: SparkSession, df: DataFrame, target: str, fmt: str = "parquet",
                  cluster_by: list[str] | tuple = ()) -> None:
    """Unpartitioned in-place replace: stage, then swap the folder."""
    staged = f"{target.rstrip('/')}__staging_{uuid.uuid4().hex[:8]}"
    write_table(df, staged, (), fmt, "overwrite", cluster_by)
    promote(spark, staged, target)


def promote(spark: SparkSession, staged: str, target: str) -> None:
    """Make a fully staged table the target: move the old folder aside, rename
    the staged one into place (a metadata operation; no data is rewritten),
    then delete the old one."""
    fs, t = _fs(spark, target)
    old = _path(spark, f"{target.rstrip('/')}__replaced_{uuid.uuid4().hex[:8]}")
    if fs.exists(t):
        _move(fs, t, old)
    fs.mkdirs(t.getParent())
    _move(fs, _path(spark, staged), t)
    _remove(fs, old)


def restore(spark: SparkSession, target: str) -> None:
    """Take back what a writer that was lost left around ``target``: folders it had set aside return to their place
    where nothing has taken it, then all that was set aside or staged goes.  Only for a table that nobody is writing."""
    target = target.rstrip("/")
    fs, place = _fs(spark, target)
    found = lambda pattern: [f.getPath() for f in fs.globStatus(_path(spark, pattern)) or []]
    for old in found(f"{target}__replaced_*"):
        if not fs.exists(place):
            _move(fs, old, place)
    for aside in found(f"{target}/_replaced_*"):
        top = fs.makeQualified(aside).toUri().getPath().rstrip("/")
        for folder in sorted({f.getParent().toUri().getPath() for f in _data_files(fs, aside)}):
            dst = _path(spark, f"{target}/{folder[len(top) + 1:]}")
            if not fs.exists(dst):
                fs.mkdirs(dst.getParent())
                _move(fs, _path(spark, folder), dst)
    for kind in ("__replaced_*", "__staging_*", "__updates_*", "/_replaced_*", "/_staging_*"):
        for left in found(target + kind):
            _remove(fs, left)


def replace_partitions(spark: SparkSession, new_rows: DataFrame, target: str, partition_by: list[str],
                       touched: list[tuple], fmt: str = "parquet", cluster_by: list[str] | tuple = ()) -> None:
    """Stage the new content of the touched partitions, then swap them in."""
    staged = f"{target.rstrip('/')}/_staging_{uuid.uuid4().hex[:8]}"
    write_table(new_rows, staged, partition_by, fmt, "overwrite", cluster_by)
    swap_partitions(spark, staged, target, partition_by, touched)
    _remove(*_fs(spark, staged))


def _in_partitions(df: DataFrame, partition_by: list[str], touched: list[tuple]) -> DataFrame:
    """Rows of the touched partitions: a filter per column, which prunes the
    listing however many partitions there are, then the exact combinations by
    a join with the list of partitions."""
    out = df
    for i, c in enumerate(partition_by):
        values = list({v[i] for v in touched if v[i] is not None})
        keep = F.col(c).isin(values) if values else F.lit(False)
        out = out.where(keep | F.col(c).isNull() if any(v[i] is None for v in touched) else keep)
    if len(partition_by) == 1:
        return out
    names = [f"__p{i}" for i in range(len(partition_by))]
    fields = [df.schema[c] for c in partition_by]
    listed = df.sparkSession.createDataFrame(touched, ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, fields)))
    same = F.lit(True)
    for c, n in zip(partition_by, names):
        same = same & F.col(c).eqNullSafe(F.col(n))
    return out.join(listed, same, "left_semi")


def _without_keys(df: DataFrame, gone: DataFrame, keys: list[str], how: str = "left_anti") -> DataFrame:
    """Anti (or semi) join on keys in which NULL equals NULL."""
    other = gone.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return df.join(other, same, how)


def append_by_rename(spark: SparkSession, staged: str, target: str, tag: str | None = None) -> int:
    """Append a staged (partitioned) table to ``target`` by moving its data
    files into the matching partition folders.  File names are unique per
    write, so nothing is overwritten; returns the number of files moved.
    With a ``tag`` the files bear its name, and those an earlier append of the same
    tag left in these folders are replaced: a repeated append is the same as one."""
    fs, src_root = _fs(spark, staged)
    prefix = f"{tag}--" if tag else ""
    cleared = set()
    root = fs.makeQualified(src_root).toUri().getPath().rstrip("/")     # listings are qualified, arguments need not be
    moved = 0
    for path in _data_files(fs, src_root):
        rel = fs.makeQualified(path).toUri().getPath()
        if not rel.startswith(root + "/"):
            raise MoveError(f"{path} is not below {root}")
        folder, _, name = rel[len(root) + 1:].rpartition("/")
        dst = _path(spark, "/".join(x for x in (target.rstrip("/"), folder, prefix + name) if x))
        fs.mkdirs(dst.getParent())
        if tag and folder not in cleared:
            cleared.add(folder)
            for old in fs.listStatus(dst.getParent()):
                if old.isFile() and old.getPath().getName().startswith(prefix):
                    _remove(fs, old.getPath())
        _move(fs, path, dst)
        moved += 1
    _remove(fs, src_root)
    return moved


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that is no longer needed."""
    _remove(*_fs(spark, path))


# -- upsert -------------------------------------------------------------------------------

def duplicate_keys(df: DataFrame, keys: list[str]) -> int:
    """Number of keys that occur more than once (0 = the batch is a valid upsert)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1).count()


def _stored_schema(spark: SparkSession, target: str, updates: DataFrame, partition_by: list[str], fmt: str) -> T.StructType:
    """Columns as stored; partition columns have the updates' type, since folder
    names alone would turn the text 007 into a number."""
    if not _data_files(*_fs(spark, target)):
        return updates.schema
    found = spark.read.format(fmt).load(target).schema
    return T.StructType([updates.schema[f.name] if f.name in partition_by and f.name in updates.columns else f for f in found])


def newest(updates: DataFrame, current: DataFrame, keys: list[str], latest_by: list[str]) -> DataFrame:
    """Updates that are not older than the stored row of their key, by the order of ``latest_by`` (NULL is oldest; equal: the update counts)."""
    stored = current.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.struct(*latest_by).alias("__version"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    older = (F.col("__version") > F.struct(*latest_by)) if latest_by else F.lit(False)
    return updates.join(stored.where(F.col("__version").isNotNull()), same & older, "left_anti")


def _of_values(df: DataFrame, updates: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose partition columns ``columns`` have values that the updates have: prunes the listing."""
    for c in columns:
        values = [v[0] for v in _partitions_of(updates, [c])]
        keep = F.col(c).isin([v for v in values if v is not None])
        df = df.where(keep | F.col(c).isNull() if None in values else keep)
    return df


def upsert(spark: SparkSession, target: str, updates: DataFrame, keys: list[str],
           partition_by: list[str] | tuple = (), schema: str | None = None, fmt: str = "parquet",
           cluster_by: list[str] | tuple = (), latest_by: list[str] | tuple = (), fixed: list[str] | tuple = (), log=None) -> None:
    """MERGE (update all, insert all) on Parquet.

    The updates are staged once and worked on from there.  Only the
    partitions they touch are rewritten: those of the updates and, unless the
    partition columns are part of the keys, those that hold the keys now (a key
    whose partition changes moves).  NULL equals NULL in keys.  Updates with
    duplicate keys are refused.  Applying the same batch twice gives the same
    table as applying it once.

    ``latest_by``: an update older than the stored row of its key is left out, so
    runs may come in any order.  ``fixed``: partition columns that a key never
    changes; only partitions of the updates' values are then searched for the
    keys.  ``log``: a ``ChangeLog`` that gets the images of changed rows; a commit it
    holds already is not written again."""
    from lakeward.sinks import changes

    partition_by, keys = list(partition_by), list(keys)
    if log is not None and log.done(spark):
        return
    held = f"{target.rstrip('/')}__updates_{uuid.uuid4().hex[:8]}"
    updates.write.parquet(held)
    updates = spark.read.schema(updates.schema).parquet(held)
    fresh = f"{held}_newest"
    try:
        if duplicate_keys(updates, keys):
            raise UpsertError(f"updates hold duplicate keys on {keys}")
        if not exists(spark, target):
            if log is not None:
                log.record(changes.images(updates.limit(0), updates, keys))
            write_table(updates, target, partition_by, fmt, "overwrite", cluster_by)
            return log.publish(spark) if log is not None else None
        current = spark.read.format(fmt).schema(schema or _stored_schema(spark, target, updates, partition_by, fmt)).load(target)
        updates = updates.select(*current.columns)
        known = _of_values(current, updates, [c for c in partition_by if c in fixed])
        if latest_by:
            newest(updates, known, keys, list(latest_by)).write.parquet(fresh)
            updates = spark.read.schema(updates.schema).parquet(fresh)
        touched = _partitions_of(updates, partition_by) if partition_by else []
        if partition_by and not set(partition_by) <= set(keys):
            before = _partitions_of(_without_keys(known, updates, keys, "left_semi"), partition_by)
            touched = sorted({*touched, *before}, key=str)
        scope = _in_partitions(current, partition_by, touched) if partition_by else current
        if log is not None:
            log.record(changes.images(_without_keys(scope, updates, keys, "left_semi"), updates, keys))
        merged = _without_keys(scope, updates, keys).unionByName(updates)
        if partition_by:
            replace_partitions(spark, merged, target, partition_by, touched, fmt, cluster_by)
        else:
            replace_table(spark, merged, target, fmt, cluster_by)
        if log is not None:
            log.publish(spark)
    finally:
        for path in (held, fresh):
            _remove(*_fs(spark, path))


def replace_keys(spark: SparkSession, target: str, fresh: DataFrame, touched_keys: DataFrame, keys: list[str],
                 partition_by: list[str], schema: str | None = None, fmt: str = "parquet", log=None) -> None:
    """Recompute a keyed table for a set of keys: every touched key is
    removed and ``fresh`` (the recomputed rows; a key without rows there
    disappears) is put in.  Only partitions holding a touched key are
    rewritten.  ``upsert`` is the case where the touched keys are the keys of
    ``fresh``.  ``log``: as for ``upsert``."""
    from lakeward.sinks import changes

    if log is not None and log.done(spark):
        return
    if duplicate_keys(fresh, keys):
        raise UpsertError(f"fresh rows hold duplicate keys on {keys}")
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    current = reader.load(target)
    touched = sorted({*_partitions_of(touched_keys, partition_by), *_partitions_of(fresh, partition_by)}, key=str)
    scope, fresh = _in_partitions(current, partition_by, touched), fresh.select(*current.columns)
    if log is not None:
        log.record(changes.images(_without_keys(scope, touched_keys, keys, "left_semi"), fresh, keys))
    replace_partitions(spark, _without_keys(scope, touched_keys, keys).unionByName(fresh), target, partition_by, touched, fmt)
    if log is not None:
        log.publish(spark)


# -- quarantine, retention, serving ---------------------------------------------------------

def append_quarantine(rejected: DataFrame, root: str, contract: str, step: str, run_id: str,
                      as_of: str) -> str:
    """K4: append rejected rows with reason, contract, step, run and as-of;
    one partition per (contract, step, run) so a run never clears another and
    a run tried again replaces its own rows."""
    at = F.col(as_of) if as_of in rejected.columns else F.lit(as_of).cast("timestamp")
    out = (rejected.withColumn("__quarantine_at", at)
                   .withColumn("contract", F.lit(contract)).withColumn("step", F.lit(step))
                   .withColumn("run_id", F.lit(run_id)))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("contract", "step", "run_id").parquet(root)
    return root


def expired_partitions(df: DataFrame, column: str, retention_days: int, as_of: str) -> DataFrame:
    """Partition values older than the retention window at ``as_of``."""
    limit = F.date_sub(F.lit(as_of).cast("date"), retention_days)
    return (df.select(column).distinct().where(F.col(column) < limit)
              .withColumn("retention_days", F.lit(retention_days)))


def serving_extract(gold: DataFrame, path: str, date_col: str = "metric_date",
                    sort_by: list[str] | tuple = ("partner_id",)) -> str:
    """K8 (re-aimed serving mirror): a compacted, sorted Parquet extract per
    day, rewritten per batch (``foreachBatch`` calls this with the batch)."""
    return write_table(gold, path, [date_col], "parquet", "overwrite", list(sort_by))
