"""Writing tables: replace, append and keyed merge on Parquet paths.

A table is a folder of written batches ``_batch=<n>-<attempt>`` and of manifests ``_manifests/<n>``. A write puts its
rows into a batch of its own and then commits the next manifest, which names the folders of the batches that make up the
table now, and its columns. Readers take the newest manifest. Nothing they may read is changed in place, and no two
attempts share a folder, so a run that dies at any point leaves the table as it was, and is simply run again. A merge
into a partitioned table writes only the partitions its rows touch. Of two writers that started from one version, the
second to commit fails, and removes what it wrote.

A manifest remembers which numbered batches of each source it has taken, as ranges, so batches may come in any order and
more than once.

Columns keep their types: a write may add columns, and narrower numbers are widened, but any other change of a type
fails before a row is written. Empty text in a partition column reads back as NULL, as in any partitioned Parquet table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from adlake.operators.dedupe import assert_unique, latest
from adlake.operators.merge import with_keys, without_keys
from adlake.operators.project import additive_only
from adlake.spec import APPEND, MERGE, TableSpec

KEPT_VERSIONS = 2
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name for NULL
_WIDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a session of one machine may go without one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        import tempfile

        root = tempfile.mkdtemp(prefix="run-")
    return f"{root.rstrip('/')}/adlake-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise rows that several jobs read, on storage that outlives an executor."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


@dataclass(frozen=True)
class Manifest:
    """What a version of a table consists of.

    ``folders``: partition folder to the batches it has rows in; "" stands for a table without
    partitions. ``applied``: the batch numbers taken from each source, as (first, last) of ranges
    in order. ``notes``: the writer's own.
    """

    number: int
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    folders: Mapping[str, Sequence[str]] = field(default_factory=dict)
    applied: Mapping[str, Sequence[Sequence[int]]] = field(default_factory=dict)
    notes: Mapping[str, object] = field(default_factory=dict)

    def paths(self, path: str, only: set[str] | None = None) -> list[str]:
        return [
            f"{path}/_batch={batch}/{folder}".rstrip("/")
            for folder, batches in self.folders.items()
            if only is None or folder in only
            for batch in batches
        ]


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    fs, pattern = _fs(spark, f"{path}/*")
    return sorted(s.getPath().getName() for s in fs.globStatus(pattern) or [] if s.isDirectory())


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, old = _fs(spark, path)
    fs.delete(old, True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions of a table, oldest first."""
    fs, pattern = _fs(spark, f"{path}/_manifests/[0-9]*")
    return sorted(int(s.getPath().getName()) for s in fs.globStatus(pattern) or [])


def _manifest(spark: SparkSession, path: str, number: int) -> Manifest:
    stored = json.loads(spark.read.text(f"{path}/_manifests/{number}", wholetext=True).first()[0])
    schema = T.StructType.fromJson(stored.pop("schema"))
    return Manifest(number, schema, tuple(stored.pop("partition_by")), **stored)


def current(spark: SparkSession, path: str) -> Manifest | None:
    have = versions(spark, path)
    return _manifest(spark, path, have[-1]) if have else None


def _put_if_absent(spark: SparkSession, path: str, body: bytes) -> bool:
    """A whole file, unless one of that name is there; of several writers one succeeds.

    A local file system links a finished file to the name, a name node renames one, both in one
    step that fails on an existing name; stores whose objects appear when they are closed are asked
    to create the object only if there is none.
    """
    jvm = spark._jvm
    fs, final = _fs(spark, path)
    _, draft = _fs(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    scheme = fs.getScheme()
    if scheme not in ("file", "hdfs", "viewfs"):
        if fs.exists(final):
            return False
        builder = fs.createFile(final).overwrite(False).recursive().opt("fs.option.create.conditional.overwrite", True)
        return _tried(lambda: _filled(builder.build(), body), "FileAlreadyExists", "PreconditionFailed")
    _filled(fs.create(draft), body)
    try:
        if scheme == "file":
            at = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            return _tried(lambda: jvm.java.nio.file.Files.createLink(at(final), at(draft)), "FileAlreadyExists")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
        plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        plain[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        return _tried(lambda: context.rename(draft, final, plain), "FileAlreadyExists")
    finally:
        fs.delete(draft, False)


def _filled(out, body: bytes) -> None:
    out.write(body)
    out.close()


def _tried(step: Callable[[], object], *taken: str) -> bool:
    """Whether a step of the file system went through; it may only fail because the name is taken."""
    try:
        step()
    except Py4JJavaError as e:
        if any(t in e.java_exception.getClass().getName() for t in taken):
            return False
        raise
    return True


def _commit(spark: SparkSession, path: str, manifest: Manifest, batch: str) -> None:
    """Make the manifest the newest; fails, and removes the batch, if that number was committed meanwhile."""
    body = {
        "schema": manifest.schema.jsonValue(),
        "partition_by": list(manifest.partition_by),
        "folders": {f: list(b) for f, b in manifest.folders.items()},
        "applied": {s: [list(r) for r in ranges] for s, ranges in manifest.applied.items()},
        "notes": dict(manifest.notes),
    }
    if not _put_if_absent(spark, f"{path}/_manifests/{manifest.number}", json.dumps(body).encode()):
        drop_folder(spark, f"{path}/_batch={batch}")
        raise RuntimeError(f"{path} was written by another run at the same time")
    _drop_old(spark, path)


def _drop_old(spark: SparkSession, path: str) -> None:
    """Drop all but the newest versions, with the folders that only they have. Another writer may be at it, too."""
    have = versions(spark, path)
    kept = {p for n in have[-KEPT_VERSIONS:] for p in _manifest(spark, path, n).paths(path)}
    for n in have[:-KEPT_VERSIONS]:
        fs, old = _fs(spark, f"{path}/_manifests/{n}")
        if not fs.exists(old):
            continue
        for p in _manifest(spark, path, n).paths(path):
            if p not in kept:
                fs.delete(_fs(spark, p)[1], True)
        fs.delete(old, False)


def _rows(spark: SparkSession, path: str, manifest: Manifest, only: set[str] | None = None) -> DataFrame:
    paths = manifest.paths(path, only)
    if not paths:
        return spark.createDataFrame([], manifest.schema)
    # A file that lacks a later column reads it as NULL.
    found = spark.read.schema(manifest.schema).option("basePath", path).parquet(*paths)
    return found.select(*[F.col(f"`{c}`") for c in manifest.schema.names])


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of a table, or None when it has never been written."""
    manifest = current(spark, path)
    return None if manifest is None else _rows(spark, path, manifest)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _fits(new: T.DataType, stored: T.DataType) -> bool:
    """Whether every value of one type is a value of the other."""
    if new in _WIDER and stored in _WIDER:
        return _WIDER.index(new) <= _WIDER.index(stored)
    if isinstance(new, T.DecimalType) and isinstance(stored, T.DecimalType):
        return new.scale <= stored.scale and new.precision - new.scale <= stored.precision - stored.scale
    return (new, stored) == (T.FloatType(), T.DoubleType()) or new == T.NullType()


def _fitted(df: DataFrame, manifest: Manifest | None) -> tuple[DataFrame, T.StructType]:
    """Rows in the stored types, and the table's columns with them."""
    if manifest is None:
        return df, _nullable(df.schema)
    have = {f.name: f.dataType for f in manifest.schema.fields}
    cast = {
        f.name: F.col(f"`{f.name}`").cast(have[f.name])
        for f in df.schema.fields
        if f.name in have and f.dataType != have[f.name] and _fits(f.dataType, have[f.name])
    }
    rows = df.withColumns(cast) if cast else df
    fields = {f.name: f for f in manifest.schema.fields} | {f.name: f for f in _nullable(rows.schema).fields}
    schema = T.StructType(list(fields.values()))
    additive_only(manifest.schema, schema)
    return rows, schema


def _write_batch(df: DataFrame, path: str, number: int, partition_by: Sequence[str]) -> tuple[str, list[str]]:
    """(name of the batch, the folders that got rows); the name is this attempt's alone."""
    name = f"{number}-{uuid.uuid4().hex}"
    target = f"{path}/_batch={name}"
    # Bring a partition's rows together for few files; AQE splits one that is too large.
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    out.write.partitionBy(*partition_by).parquet(target)
    if not partition_by:
        return name, [""]
    fs, pattern = _fs(df.sparkSession, "/".join([target, *[f"{_escaped(df.sparkSession, p)}=*" for p in partition_by]]))
    depth = len(partition_by)
    return name, sorted("/".join(str(s.getPath()).split("/")[-depth:]) for s in fs.globStatus(pattern) or [])


def _escaped(spark: SparkSession, name: str) -> str:
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)


def _next(manifest: Manifest | None, schema: T.StructType, partition_by: Sequence[str]) -> Manifest:
    if manifest is None:
        return Manifest(1, schema, tuple(partition_by))
    return replace(manifest, number=manifest.number + 1, schema=schema)


def _seen(manifest: Manifest | None, source: str | None, batch: int | None) -> bool:
    if manifest is None or source is None:
        return False
    return any(first <= batch <= last for first, last in manifest.applied.get(source, ()))


def with_batch(ranges: Sequence[Sequence[int]], batch: int) -> list[list[int]]:
    """Ranges with one more number; those that then touch become one."""
    out: list[list[int]] = []
    for first, last in sorted([*map(list, ranges), [batch, batch]]):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def write_replace(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    notes: Mapping[str, object] | None = None,
    only_rows: bool = False,
) -> None:
    """The rows are the table. With ``only_rows`` a write that turns out to have put none into a folder is not committed."""
    spark = df.sparkSession
    old = current(spark, path)
    new = Manifest(
        old.number + 1 if old else 1,
        _nullable(df.schema),
        tuple(partition_by),
        applied=old.applied if old else {},
        notes=notes if notes is not None else old.notes if old else {},
    )
    batch, folders = _write_batch(df, path, new.number, partition_by)
    if only_rows and not folders:
        drop_folder(spark, f"{path}/_batch={batch}")
        return
    _commit(spark, path, replace(new, folders={f: [batch] for f in folders}), batch)


def write_append(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    source: str | None = None,
    batch: int | None = None,
    notes: Mapping[str, object] | None = None,
    base: Manifest | None = None,
) -> None:
    """Add rows. A ``batch`` of a ``source`` that the table has already taken is not added again; others come in any order."""
    spark = df.sparkSession
    old = base or current(spark, path)
    if _seen(old, source, batch):
        return
    rows, schema = _fitted(df, old)
    new = _next(old, schema, partition_by)
    folders = {f: list(b) for f, b in new.folders.items()}
    name, written = _write_batch(rows, path, new.number, new.partition_by)
    for f in written:
        folders.setdefault(f, []).append(name)
    applied = {**new.applied, source: with_batch(new.applied.get(source, ()), batch)} if source is not None else new.applied
    _commit(spark, path, replace(new, folders=folders, applied=applied, notes=new.notes if notes is None else notes), name)


def _folders_of(parts_rows: DataFrame, parts: Sequence[str]) -> set[str]:
    """Names of the folders of partition values; there are as many as the table's manifest lists."""
    spark = parts_rows.sparkSession
    rows = parts_rows.select(*[F.col(p).cast("string").alias(p) for p in parts]).distinct().collect()
    escaped = {p: _escaped(spark, p) for p in parts}
    return {"/".join(f"{escaped[p]}={_escaped(spark, r[p]) if r[p] else _NO_VALUE}" for p in parts) for r in rows}


def write_merge(df: DataFrame, spec: TableSpec, path: str, base: Manifest | None = None) -> None:
    """Merge rows into the table on ``spec.keys``: a new row replaces the stored one whole. NULL is a key value."""
    spark, keys = df.sparkSession, list(spec.keys)
    old = base or current(spark, path)
    new_rows, schema = _fitted(latest(df, keys, spec.order_by), old)
    if old is None:
        # Without rows a partitioned table has nothing to say about its partitions. The write finds that out: to ask first
        # would compute the rows twice.
        write_replace(new_rows, path, spec.partition_by, only_rows=bool(spec.partition_by))
        return
    new = _next(old, schema, spec.partition_by)
    parts = list(new.partition_by)
    if parts:
        new_rows = cut_lineage(new_rows)
        touched = _folders_of(new_rows.select(*parts), parts)
        if not set(parts) <= set(keys):
            lives = with_keys(_rows(spark, path, old).select(*{*parts, *keys}), new_rows, keys)
            touched |= _folders_of(lives, parts)
    else:
        touched = {""}
    kept = without_keys(_rows(spark, path, old, touched), new_rows, keys)
    merged = kept.unionByName(new_rows, allowMissingColumns=True)
    folders = {f: b for f, b in old.folders.items() if f not in touched}
    batch, written = _write_batch(merged, path, new.number, parts)
    folders |= {f: [batch] for f in written}
    _commit(spark, path, replace(new, folders=folders), batch)


def load(
    df: DataFrame, spec: TableSpec, path: str, source: str | None = None, batch: int | None = None, base: Manifest | None = None
) -> None:
    """Write by the table's disposition. ``base`` is the version that the rows were computed from, the newest by
    default: if another one was committed since, an append or a merge fails."""
    if spec.disposition == MERGE:
        write_merge(df, spec, path, base)
    elif spec.disposition == APPEND:
        write_append(df, path, spec.partition_by, source, batch, base=base)
    else:
        write_replace(df, path, spec.partition_by)


def stage_backfill(df: DataFrame, fields: Sequence[str], key: str, path: str) -> DataFrame:
    """Exactly the named fields into a table of their own; fails on a missing field or duplicate id."""
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"backfill source lacks fields: {', '.join(missing)}")
    staged = df.select(*fields)
    assert_unique(staged, [key])
    write_replace(staged, path)
    return read_table(df.sparkSession, path)
