"""K1-K6: Parquet table writes with partition layout, clustering and keyed merges.

Plain Parquet has no MERGE INTO, so a merge is expressed with joins and a
dynamic partition overwrite:

* the source is staged once to the scratch folder (its lineage is cut; the
  key check, the list of its partitions and the merge all read that copy);
* only partitions the merge touches are read from the target (partition
  pruning); the merged rows are written to a copy below the table first, then
  its partition folders are renamed in, so a crash in that commit loses nothing;
* partitions a merge empties (a key moved to another date) are deleted;
* unpartitioned tables get a complete new version beside them, swapped in by
  renames, so they are never missing or partial.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgelake.session import scratch_path
from forgelake.sources.tables import SOURCE_MONTH, read_table
from forgelake.specs import TableSpec

HIVE_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
UPDATE_ALL = "all"
UPDATE_LATEST = "latest"
INSERT_ONLY = ()
_HELD = "__held"


class SchemaDriftError(ValueError):
    """The files of a table don't hold the columns that its spec declares."""


#: Partition of a staged source that tells the rows set aside; their tags.
SET_ASIDE, TAGS = "set_aside", "violations"


@dataclass(frozen=True)
class Quarantine:
    """Rows with a tag (an array of strings, empty for a good row) go to ``folder`` instead of the table."""

    tags: Column
    folder: str


class DuplicateKeyError(ValueError):
    """The merge source repeats a key; a merge would be ambiguous."""


# --- filesystem helpers (Hadoop FileSystem through the session's JVM) --------

def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.mkdirs(p)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none when it does not exist."""
    fs, p = _fs_path(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs_path(spark, src)
    _, d = _fs_path(spark, dst)
    if not fs.rename(s, d):
        raise OSError(f"rename {src} -> {dst} failed")


def _versions(path: str) -> tuple[str, str]:
    """Hidden siblings (Spark's file listing skips names that start with a dot)."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.next", f"{parent}/.{name}.prev"


def recover(spark: SparkSession, path: str) -> None:
    """Finish or roll back a table swap that was interrupted (see :func:`replace_table`)."""
    nxt, prev = _versions(path)
    if not path_exists(spark, path):
        if path_exists(spark, f"{nxt}/_SUCCESS"):
            _rename(spark, nxt, path)  # the new version was complete: finish the swap
        elif path_exists(spark, prev):
            _rename(spark, prev, path)  # roll back to the old version
    if path_exists(spark, path):
        delete_path(spark, prev)
        delete_path(spark, nxt)


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace a whole folder without a window in which a re-run cannot restore it.

    ``write`` puts the new version completely next to the old one (so it may
    read the old one), then two directory renames swap it in.  A crash at any
    point leaves either the old or the new version, and the next
    :func:`recover` (run by every merge) tidies up.
    """
    recover(spark, path)
    nxt, prev = _versions(path)
    delete_path(spark, nxt)
    write(nxt)
    if path_exists(spark, path):
        _rename(spark, path, prev)
    _rename(spark, nxt, path)
    delete_path(spark, prev)


def replace_table(spark: SparkSession, df: DataFrame, path: str, spec: TableSpec) -> None:
    """:func:`replace_folder` with the table's own layout."""
    replace_folder(spark, path, lambda new: write_table(df, new, spec, "errorifexists"))


# --- layout ------------------------------------------------------------------

def laid_out(df: DataFrame, spec: TableSpec) -> DataFrame:
    """K4 + K5: rebalance on the partition columns, then sort by partition + cluster columns.

    REBALANCE lets AQE split a hot partition value over several tasks and
    merge small ones, so a busy day is not written by one task and a quiet
    day does not become many tiny files.  The in-task sort makes Parquet
    row-group min/max statistics selective for the cluster columns.
    """
    parts = list(spec.partition_by)
    balanced = df.hint("rebalance", *parts) if parts else df.hint("rebalance")
    return balanced.sortWithinPartitions(*parts, *spec.cluster_by)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Select the stored columns; a frame without ``ingested_at`` gets a typed NULL."""
    cols = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in spec.stored_schema.fields]
    return df.select(*cols)


def _writer(df: DataFrame, spec: TableSpec, mode: str):
    w = laid_out(conform(df, spec), spec).write.mode(mode)
    if spec.partition_by:
        w = w.partitionBy(*spec.partition_by)
    return w


def write_table(df: DataFrame, path: str, spec: TableSpec, mode: str = "overwrite") -> None:
    """Write the whole table (static overwrite by default)."""
    w = _writer(df, spec, mode)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "static")
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, spec: TableSpec) -> None:
    """K1: replace only the partitions present in ``df``; all others stay untouched."""
    if not spec.partition_by:
        raise ValueError(f"{spec.name} is not partitioned")
    _writer(df, spec, "overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def month_folder(path: str, month: int) -> str:
    return f"{path.rstrip('/')}/{SOURCE_MONTH}={month}"


def replace_month(spark: SparkSession, path: str, month: int, write: Callable[[str], None]) -> None:
    """Replace everything that one source month put into a staging table, and nothing else.

    Interrupted swaps of other months are settled first, so none stays missing.
    """
    fs, root = _fs_path(spark, path)
    if not fs.exists(root):
        fs.mkdirs(root)
    for st in fs.listStatus(root):
        swap = re.fullmatch(rf"\.({SOURCE_MONTH}=\d+)\.(?:next|prev)", st.getPath().getName())
        if swap:
            recover(spark, f"{path.rstrip('/')}/{swap[1]}")
    replace_folder(spark, month_folder(path, month), write)


def append(df: DataFrame, path: str, spec: TableSpec) -> None:
    """K2: add rows; a re-run appends duplicates, which bronze deduplication removes."""
    _writer(df, spec, "append").parquet(path)


def ensure_table(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """K6: create an empty typed table if none exists yet."""
    if not path_exists(spark, path):
        empty = spark.createDataFrame([], spec.stored_schema)
        w = empty.write.mode("errorifexists")
        if spec.partition_by:
            w = w.partitionBy(*spec.partition_by)
        w.parquet(path)


def _data_file(spark: SparkSession, path: str, spec: TableSpec) -> str | None:
    """A data file of the table, of its last partition that has one; None for an empty table."""
    fs, folder = _fs_path(spark, path)
    found = [st for st in fs.listStatus(folder) if not st.getPath().getName().startswith((".", "_"))]
    files = sorted(str(st.getPath()) for st in found if st.isFile())
    if files:
        if spec.partition_by:
            raise SchemaDriftError(f"{spec.name}: {path} is not laid out by {spec.partition_by}")
        return files[0]
    for st in sorted((st for st in found if st.isDirectory()), key=lambda st: st.getPath().getName(), reverse=True):
        if not spec.partition_by or not st.getPath().getName().startswith(f"{spec.partition_by[0]}="):
            raise SchemaDriftError(f"{spec.name}: {path} is laid out by {st.getPath().getName()}, not {spec.partition_by}")
        file = _data_file(spark, str(st.getPath()), replace(spec, partition_by=spec.partition_by[1:]))
        if file:
            return file
    return None


def check_schema(spark: SparkSession, path: str, spec: TableSpec, *, every_file: bool = False) -> None:
    """K6 for a table that exists: raise :class:`SchemaDriftError` if its files lack, add or retype columns.

    Reads one footer (every merge does, of the newest partition); ``every_file`` reads all, in a Spark job.
    """
    file = _data_file(spark, path, spec)
    if file is None:
        return
    try:
        read = spark.read.option("mergeSchema", "true").parquet(path) if every_file else spark.read.parquet(file)
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE_SCHEMA" not in str(e):
            raise
        raise SchemaDriftError(f"{spec.name}: files at {path} differ in a column's type") from e
    found = {f.name: f.dataType for f in read.schema.fields if f.name not in spec.partition_by}
    want = {f.name: f.dataType for f in spec.stored_schema.fields if f.name not in spec.partition_by}
    faults = [f"no {c}" for c in want if c not in found] + [f"unknown {c}" for c in found if c not in want]
    faults += [f"{c} is {found[c].simpleString()}, not {t.simpleString()}" for c, t in want.items() if c in found and found[c] != t]
    if faults:
        raise SchemaDriftError(f"{spec.name} at {path}: {'; '.join(faults)}")


# --- clustering ------------------------------------------------------------------

#: Bytes that a file of a clustered table should have.
FILE_BYTES = 128 << 20


def cluster(spark: SparkSession, path: str, spec: TableSpec, where: Column | None = None, file_bytes: int = FILE_BYTES) -> int:
    """K5 across files: rewrite the partitions that ``where`` (on partition columns) holds for, rows dealt to
    files by ranges of the cluster columns, so that few files' statistics admit a value.  Returns the number of ranges.

    The key ends the order, so a cluster value that holds a third of the rows spans several files.
    A merge rewrites the partitions that it touches in its own layout; run this on those that have come to rest.
    It commits like a merge, so a re-run finishes one that broke off.
    """
    parts, order = list(spec.partition_by), list(dict.fromkeys([*spec.partition_by, *spec.cluster_by, *spec.keys]))
    recover(spark, path)
    if parts:
        recover_merge(spark, path, spec)
    rows, size = read_table(spark, path, spec), _size(spark, path)
    if parts and where is not None:
        chosen = _in_scope(spark, partition_values(spark, path, spec), spec, where)
        rows = rows.filter(_partition_filter(parts, chosen))
        size = sum(_size(spark, f"{path.rstrip('/')}/{_partition_dir(parts, v)}") for v in chosen)
    ranges = max(1, -(-size // file_bytes))
    dealt = conform(rows, spec).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    if not parts:
        replace_folder(spark, path, lambda new: dealt.write.parquet(new))
    elif size:
        dealt.write.partitionBy(*parts).parquet(f"{path.rstrip('/')}/{_MERGE}/rows")
        _commit_merge(spark, path, spec)
    return ranges


def _size(spark: SparkSession, path: str) -> int:
    fs, p = _fs_path(spark, path)
    return fs.getContentSummary(p).getLength()


# --- keyed merge ---------------------------------------------------------------

def _stage(spark: SparkSession, df: DataFrame, spec: TableSpec, label: str) -> tuple[str, DataFrame]:
    path = scratch_path(spark, f"{spec.name}-{label}")
    conform(df, spec).write.parquet(path)  # read back whole, so not laid out by partition
    return path, read_table(spark, path, spec)


def _held_values(df: DataFrame, parts: Sequence[str]) -> set[tuple]:
    """Partition values in a frame, a list bounded by the calendar."""
    return {tuple(r) for r in df.select(*parts).distinct().collect()} if parts else set()


def _counted(df: DataFrame, parts: Sequence[str]) -> dict[tuple, int]:
    """Rows by partition value, a list bounded by the calendar."""
    return {tuple(r)[:-1]: r[-1] for r in df.groupBy(*parts).count().collect()}


def _within_keys(df: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key a staged source holds: a semi join within the source's key ranges.

    The ranges (one pass over the source's keys) reach the scan, where Parquet statistics skip row
    groups: archive ids grow with time, so an old date is passed over.  On the source's side they are
    what Spark asks for before it sends a Bloom filter of a small source into a large scan
    (``spark.sql.optimizer.runtime.bloomFilter.*``), which thins out random keys such as SHAs.
    """
    ends = staged.agg(*(f(k).alias(f"{n}_{k}") for k in keys for f, n in ((F.min, "low"), (F.max, "high")))).first()
    if any(v is None for v in ends):
        return df.filter(F.lit(False))  # no complete key to look for
    inside = reduce(lambda a, b: a & b, [F.col(k).between(F.lit(ends[f"low_{k}"]), F.lit(ends[f"high_{k}"])) for k in keys])
    return df.filter(inside).join(staged.select(*keys).filter(inside), list(keys), "left_semi")


def _set_aside(spark: SparkSession, df: DataFrame, spec: TableSpec, quarantine: Quarantine) -> tuple[str, DataFrame, int]:
    """Stage a source in one pass with its bad rows apart; those replace the quarantine folder.

    (folder of the good rows, the good rows, number of bad rows)
    """
    path = scratch_path(spark, f"{spec.name}-source")
    counted = Observation(f"{spec.name}_set_aside")
    rows = conform(df, spec).withColumn(TAGS, quarantine.tags).withColumn(SET_ASIDE, F.size(TAGS) > 0)
    rows = rows.observe(counted, F.count_if(F.col(SET_ASIDE)).alias("bad"))
    rows.write.partitionBy(SET_ASIDE).parquet(path)
    good, bad = f"{path}/{SET_ASIDE}=false", f"{path}/{SET_ASIDE}=true"
    make_folder(spark, good)
    if path_exists(spark, bad):
        rows = spark.read.schema(spec.stored_schema.add(TAGS, T.ArrayType(T.StringType()))).parquet(bad)
        replace_folder(spark, quarantine.folder, lambda new: rows.hint("rebalance").write.parquet(new))
        return good, read_table(spark, good, spec), counted.get["bad"]
    delete_path(spark, quarantine.folder)
    return good, read_table(spark, good, spec), 0


def assert_unique_keys(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise if a non-NULL key repeats (NULL keys never match, so they may repeat)."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    dup = df.filter(present).groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"{what}: key {tuple(keys)} repeats, e.g. {tuple(dup[0])[:-1]}")


def _partition_filter(parts: Sequence[str], values: Iterable[tuple]) -> Column:
    """``(p1, p2, ..) IN values`` with NULL-safe equality (the NULL partition is a real directory)."""
    values = list(values)
    if not values:
        return F.lit(False)
    if len(parts) == 1:
        c = F.col(parts[0])
        plain = [v[0] for v in values if v[0] is not None]
        cond = c.isin(plain) if plain else F.lit(False)
        return cond | c.isNull() if any(v[0] is None for v in values) else cond
    terms = [reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.lit(v)) for p, v in zip(parts, row)]) for row in values]
    return reduce(lambda a, b: a | b, terms)


def _partition_dir(parts: Sequence[str], row: tuple) -> str:
    def text(v):
        if v is None:
            return HIVE_NULL_PARTITION
        if isinstance(v, (dt.date, int)):
            return str(v)
        raise TypeError(f"partition value {v!r}: only date / integer partition columns are merged")

    return "/".join(f"{p}={text(v)}" for p, v in zip(parts, row))


def partition_values(spark: SparkSession, path: str, spec: TableSpec) -> list[tuple]:
    """Partition values of a table from its directory names (driver-side listing, no Spark job)."""
    types = {f.name: f.dataType.typeName() for f in spec.schema.fields}

    def parse(name: str, text: str):
        if text == HIVE_NULL_PARTITION:
            return None
        kind = types[name]
        if kind == "date":
            return dt.date.fromisoformat(text)
        if kind in ("integer", "long", "short"):
            return int(text)
        raise TypeError(f"{name}: only date / integer partition columns are merged")

    fs, root = _fs_path(spark, path)
    rows: list[tuple] = [()]
    for part in spec.partition_by:
        nxt = []
        for row in rows:
            base = root
            for p, v in zip(spec.partition_by, row):
                base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base, _partition_dir([p], (v,)))
            for st in fs.listStatus(base):
                name = st.getPath().getName()
                if st.isDirectory() and name.startswith(f"{part}="):
                    nxt.append(row + (parse(part, name.split("=", 1)[1]),))
        rows = nxt
    return rows


_MERGE = "_merge"  # below the table, skipped by Spark's file listing


#: Filesystems whose folder renames are single steps; elsewhere a rename copies file by file and may break off in between.
RENAMING = ("file", "hdfs", "viewfs")


def _commit_merge(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """Bring the finished copy of merged rows into the table; repeatable until the copy is deleted.

    Partition folders are renamed in one by one, each from the copy, so one that is missing
    from the table is still in the copy; where a rename is no single step, the rows are written again.
    """
    table = path.rstrip("/")
    base = f"{table}/{_MERGE}"
    fs, _ = _fs_path(spark, path)
    if fs.getScheme() in RENAMING:
        for row in partition_values(spark, f"{base}/rows", spec):
            folder = _partition_dir(spec.partition_by, row)
            delete_path(spark, f"{table}/{folder}")
            if len(row) > 1:
                make_folder(spark, f"{table}/{folder.rpartition('/')[0]}")
            _rename(spark, f"{base}/rows/{folder}", f"{table}/{folder}")
    else:
        rows = read_table(spark, f"{base}/rows", spec)
        (
            # the copy is laid out already: no second shuffle
            rows.sortWithinPartitions(*spec.partition_by, *spec.cluster_by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*spec.partition_by)
            .parquet(path)
        )
    if path_exists(spark, f"{base}/emptied"):
        for row in spark.read.text(f"{base}/emptied").collect():  # one line a date at most
            delete_path(spark, f"{table}/{row[0]}")
    delete_path(spark, base)


def recover_merge(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """Finish a merge whose copy was complete when its commit broke off; drop an incomplete copy."""
    base = f"{path.rstrip('/')}/{_MERGE}"
    if path_exists(spark, f"{base}/rows/_SUCCESS"):
        _commit_merge(spark, path, spec)
    else:
        delete_path(spark, base)


def merge_into(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    spec: TableSpec,
    update: str | Sequence[str] = UPDATE_ALL,
    *,
    check_source_keys: bool = True,
    keys_can_move: bool | None = None,
    observe: Callable[[DataFrame], DataFrame] | None = None,
    scope: Column | None = None,
    before_commit: Callable[[dict], None] | None = None,
    quarantine: Quarantine | None = None,
) -> dict:
    """K3: keyed merge of ``source`` into the table at ``path``.

    ``update="all"`` replaces matched rows (upsert); ``update=()`` only
    inserts new keys (matched rows keep their old values); ``update="latest"``
    replaces a matched row only by one that the table's declared version order
    (``latest_by``, then ``ties``) puts before it, so an older version never
    comes back and an equal one writes nothing.  Keys compare with
    plain ``=``: a NULL key never matches, so such rows are always inserted.
    ``check_source_keys`` rejects a source that repeats a key; callers whose
    source is unique by construction and who check the table afterwards
    (the pipeline) may skip it.  ``keys_can_move`` says whether a key may
    change partition between runs; by default only keys that do not contain
    the partition columns can.  Passing ``False`` for data whose partition
    value never changes per key (an archive event keeps its timestamp) skips
    the one full scan of the target's key column.  ``observe`` is applied to
    exactly the rows written into the target (all of a first load, the
    rewritten partitions of an upsert, the new rows of an insert), so metrics
    such as per-row quality checks ride along with the write.

    ``scope`` (an upsert's) says which target rows the source is a complete
    recomputation of: rows in it that the source does not bring back are
    deleted, those with a NULL key too.  On a partitioned table it is a
    condition on the partition columns alone, so whole partitions are replaced
    without a look at their keys.

    ``quarantine`` keeps rows with a tag out: the pass that stages the source writes them
    apart, and they replace the quarantine folder (one a batch, so a re-run does not add to it).

    ``before_commit`` gets the outcome below before the table is changed (not on a first load).

    Cost: a first load is one write.  Later merges stage the source once,
    read only the touched partitions of the target, write the merged rows to a
    copy below the table, and rename its partition folders into the table (a dynamic
    partition overwrite where renames are no single step).  The copy stays until that and the
    deletion of emptied partitions are done; a merge that broke off in between is finished by the
    next one.  Only when a key may move between partitions (partition columns
    not in the key) is the target's key column scanned as a whole (a semi
    join); emptied partitions are then looked for among its finds alone.

    Returns ``partitions`` (how many were written), ``touched`` (their values),
    ``seen`` (those and the partitions of matched rows that stayed), ``set_aside`` (rows
    quarantined) and, for ``update="latest"``, ``replaced`` (keys of the rows replaced; usable
    until the merge returns).
    """
    keys = list(spec.keys)
    parts = list(spec.partition_by)
    if not keys:
        raise ValueError(f"{spec.name} declares no key")
    written = observe or (lambda df: df)
    if update != INSERT_ONLY and update != [] and update not in (UPDATE_ALL, UPDATE_LATEST):
        raise ValueError("update must be 'all' (upsert), 'latest' (upsert of later versions) or () (insert only)")
    if update == UPDATE_LATEST and not spec.latest_by:
        raise ValueError(f"{spec.name} declares no version order")
    if scope is not None and update != UPDATE_ALL:
        raise ValueError("only an upsert replaces a scope")

    recover(spark, path)
    if parts and path_exists(spark, path):
        recover_merge(spark, path, spec)
    folders = []
    try:
        staged_path, bad = None, 0
        if quarantine is not None:
            staged_path, source, bad = _set_aside(spark, source, spec, quarantine)
            folders.append(staged_path.rpartition(f"/{spec.name}-source")[0])
        if path_exists(spark, path):
            check_schema(spark, path, spec)
        else:
            return _first_load(spark, source, path, spec, written, check_source_keys) | {"set_aside": bad}
        staged = source
        if staged_path is None:
            staged_path, staged = _stage(spark, source, spec, "merge-source")
            folders.append(staged_path.rpartition("/")[0])
        if check_source_keys:
            assert_unique_keys(staged, keys, f"{spec.name} merge source")
        if update == UPDATE_LATEST:
            done = _merge_latest(spark, staged, path, spec, keys_can_move, written, before_commit)
        else:
            done = _merge_staged(spark, staged, path, spec, update, keys_can_move, written, scope, before_commit)
        return done | {"set_aside": bad}
    finally:
        for folder in folders:
            delete_path(spark, folder)


def _first_load(spark, source, path, spec, written, check_source_keys) -> dict:
    """K6 + first load: the merge of anything into an empty table is the source itself."""
    write_table(written(source), path, spec, "errorifexists")
    if check_source_keys:
        try:
            assert_unique_keys(read_table(spark, path, spec), spec.keys, f"{spec.name} merge source")
        except DuplicateKeyError:
            delete_path(spark, path)
            raise
    first = set(partition_values(spark, path, spec)) if spec.partition_by else set()
    return {"partitions": len(first), "touched": first, "seen": first, "first_load": 1}


def _keys_stay(spec: TableSpec, keys_can_move: bool | None) -> bool:
    return set(spec.partition_by) <= set(spec.keys) if keys_can_move is None else not keys_can_move


def _merge_latest(spark, staged, path, spec, keys_can_move, written, before_commit) -> dict:
    """Upsert of the source rows that come before the target's row of their key in the version order."""
    folder = scratch_path(spark, f"{spec.name}-versions")
    try:
        return _merge_later(spark, folder, staged, path, spec, keys_can_move, written, before_commit)
    finally:
        delete_path(spark, folder.rpartition("/")[0])


def _merge_later(spark, folder, staged, path, spec, keys_can_move, written, before_commit) -> dict:
    keys, parts = list(spec.keys), list(spec.partition_by)
    target = read_table(spark, path, spec)
    if parts and _keys_stay(spec, keys_can_move):
        target = target.filter(_partition_filter(parts, _held_values(staged, parts)))
    narrow = list(dict.fromkeys([*keys, *spec.latest_by, *spec.ties, *parts]))
    # What the target holds of the source's keys: versions only, written once and read by all that follows.
    _within_keys(target.select(*narrow), staged, keys).write.parquet(f"{folder}/held")
    schema = T.StructType([f for c in narrow for f in spec.schema.fields if f.name == c])
    held = spark.read.schema(schema).parquet(f"{folder}/held")

    # One join decides: a row stays out where the target holds a version of its key that it does not come
    # before.  An equal version stays as it is, so a repeated merge rewrites nothing; NULL keys never match.
    theirs = held.select(*(F.col(c).alias(f"{_HELD}_{c}") for c in narrow))
    same_key = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"{_HELD}_{k}") for k in keys])
    staged.join(theirs, same_key & ~_comes_before(spec), "left_anti").write.parquet(f"{folder}/accepted")
    accepted = read_table(spark, f"{folder}/accepted", spec)

    # The target's rows that go, with their places: written once for the notes and the upsert.
    gone = list(dict.fromkeys([*keys, *parts]))
    held.select(*gone).join(accepted.select(*keys), keys, "left_semi").write.parquet(f"{folder}/replaced")
    replaced = spark.read.schema(T.StructType([f for f in schema.fields if f.name in gone])).parquet(f"{folder}/replaced")
    seen = _held_values(held, parts)

    def planned(outcome: dict) -> None:
        if before_commit:
            before_commit(outcome | {"replaced": replaced.select(*keys), "seen": outcome["touched"] | seen})

    # The keys' places are known, so the upsert need not look for them again.
    outcome = _merge_staged(spark, accepted, path, spec, UPDATE_ALL, keys_can_move, written, None, planned, replaced)
    return outcome | {"seen": outcome["touched"] | seen, "replaced": replaced.select(*keys)}


def _comes_before(spec: TableSpec) -> Column:
    """Whether a row comes before the held one (columns with ``_HELD`` before their names) in the version order; never NULL."""
    out = F.lit(False)
    for c in reversed([*spec.latest_by, *spec.ties]):
        mine, theirs = F.col(c), F.col(f"{_HELD}_{c}")
        ahead = mine > theirs if c in spec.latest_by else mine < theirs
        out = F.coalesce(ahead, mine.isNotNull() & theirs.isNull()) | (mine.eqNullSafe(theirs) & out)
    return out


def _merge_staged(
    spark, staged, path, spec, update, keys_can_move, written, scope=None, before_commit=None, known=None
) -> dict:
    """The merge of a staged source; ``known`` are the target's rows of its keys (keys and places), if they have been found."""
    keys, parts = list(spec.keys), list(spec.partition_by)
    insert_only = update == INSERT_ONLY or update == []
    target = read_table(spark, path, spec)
    source_keys = staged.select(*keys)

    def outcome(touched: set, **more) -> dict:
        found = {"partitions": len(touched), "touched": touched, "seen": touched, **more}
        if before_commit:
            before_commit(found)
        return found

    if scope is None and staged.isEmpty():
        return {"partitions": 0, "touched": set(), "seen": set(), "empty": 1}
    if not parts:
        if insert_only:
            append(written(staged.join(target.select(*keys), keys, "left_anti")), path, spec)
            return outcome(set())
        # An unpartitioned table is rewritten whole: write the new version beside it, then swap.
        kept = target if scope is None else target.filter(~F.coalesce(scope, F.lit(False)))
        done = outcome(set())
        replace_table(spark, written(kept.join(source_keys, keys, "left_anti").unionByName(staged)), path, spec)
        return done

    source_parts = _held_values(staged, parts)
    keys_stay = _keys_stay(spec, keys_can_move)
    if insert_only:
        # Only new keys are written; look them up in the source's partitions
        # when keys cannot move, else in the whole key column.
        lookup = target.filter(_partition_filter(parts, source_parts)) if keys_stay else target
        done = outcome(source_parts)
        append(written(staged.join(lookup.select(*keys), keys, "left_anti")), path, spec)
        return done

    replaced = _in_scope(spark, partition_values(spark, path, spec), spec, scope) if scope is not None else set()
    touched, emptied = source_parts | replaced, replaced - source_parts
    if not keys_stay:
        # Partitions holding older versions of source keys; one whose every row
        # is replaced from elsewhere ends up empty.
        found = _within_keys(target.select(*keys, *parts), staged, keys) if known is None else known
        counts = _counted(found, parts)
        others = set(counts) - touched
        if others:
            # as many rows as are replaced: none is left
            rows = _counted(target.filter(_partition_filter(parts, others)), parts)
            emptied |= {place for place in others if rows[place] == counts[place]}
        touched |= others
    if not touched:
        return {"partitions": 0, "touched": set(), "seen": set(), "empty": 1}

    done = outcome(touched, emptied=len(emptied))
    merged = staged
    if touched - replaced:
        outside = target.filter(_partition_filter(parts, touched - replaced))  # partition pruning
        merged = outside.join(source_keys if known is None else known.select(*keys), keys, "left_anti").unionByName(staged)
    copy = f"{path.rstrip('/')}/{_MERGE}"
    if emptied:
        dirs = [(_partition_dir(parts, row),) for row in sorted(emptied, key=str)]
        spark.createDataFrame(dirs, "value string").coalesce(1).write.text(f"{copy}/emptied")
    _writer(written(merged), spec, "errorifexists").parquet(f"{copy}/rows")
    _commit_merge(spark, path, spec)
    return done


def _in_scope(spark: SparkSession, values: list[tuple], spec: TableSpec, scope: Column) -> set:
    """The partitions (a list bounded by the calendar) that a condition on the partition columns holds for."""
    if not values:
        return set()
    types = {f.name: f.dataType for f in spec.schema.fields}
    rows = [F.struct(*(F.lit(v).cast(types[p]).alias(p) for p, v in zip(spec.partition_by, row))) for row in values]
    return {tuple(r) for r in spark.range(1).select(F.inline(F.array(*rows))).filter(scope).collect()}
