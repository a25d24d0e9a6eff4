"""File scans: JSON envelopes, UTF-16 statistics files, delimited report segments."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from adlake.functions.text import dimension_type
from adlake.operators.project import union_rows
from adlake.operators.sinks import cut_lineage


#: Files whose headers are read at a time.
HEADERS_AT_ONCE = 16


def read_json_items(
    spark: SparkSession,
    path: str | Sequence[str],
    item: T.StructType,
    items: str = "items",
    multi_line: bool = False,
) -> DataFrame:
    """Rows of landed API pages, which sit in a list of the page (``items`` or ``data``).

    Pages are landed one per line, so that large files can be split; ``multi_line`` reads
    files that hold one printed page each.
    """
    page = T.StructType([T.StructField(items, T.ArrayType(item))])
    pages = spark.read.schema(page).option("multiLine", multi_line).json(path)
    return json_page_items(pages, items)


def json_page_items(pages: DataFrame, items: str = "items") -> DataFrame:
    return pages.select(F.explode(items).alias("r")).select("r.*")


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files a glob matches, sorted; works on any file system Spark can read."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in (fs.globStatus(hadoop_path) or []) if s.isFile())


def statistics_files(
    paths: Sequence[str], kind: str, package: str, months: Sequence[str]
) -> list[str]:
    """Statistics files of one package and the given months.

    The name is matched as a whole, so a package whose name merely starts the same is not.
    """
    name = re.compile(rf"(^|/){re.escape(kind)}_{re.escape(package)}_(\d{{6}})(_[a-z_]+)?\.csv$")
    wanted = set(months)
    return [p for p in paths if (m := name.search(p)) and m.group(2) in wanted]


def _header_groups(spark: SparkSession, paths: Sequence[str], encoding: str = "UTF-8") -> dict[str, list[str]]:
    """Files by their header line; empty files have none.

    A task for each file ends with its first record, so what is read of a file does not follow its size. Files are
    those of one report, some hundreds at most; their tasks run ``HEADERS_AT_ONCE`` at a time.
    """
    # A record is a whole line here: no separator and no quotes.
    reader = spark.read.schema("header string").option("sep", "\x01").option("quote", "").option("multiLine", True)
    reader = reader.option("encoding", encoding)
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        heads = list(pool.map(lambda path: reader.csv(path).head(), paths))
    groups: dict[str, list[str]] = defaultdict(list)
    for path, head in zip(paths, heads, strict=True):
        if head is not None and head["header"] is not None:
            groups[head["header"]].append(path)
    return groups


def read_play_csv(
    spark: SparkSession, root: str, kind: str, package: str, months: Sequence[str]
) -> DataFrame | None:
    """Rows of a package's statistics files as text, with ``dimension_type`` from the file name.

    Files are UTF-16 with a header, and headers differ between files: each header is read by
    itself, because a common read would bind all files to the first one's columns. A file
    that cannot be read fails the load.
    """
    found = statistics_files(
        list_files(spark, f"{root}/stats/{kind}/{kind}_{package}_*.csv"), kind, package, months
    )
    if not found:
        return None
    reader = spark.read.option("header", True).option("encoding", "UTF-16").option("multiLine", True)
    parts = []
    for group in _header_groups(spark, found, "UTF-16").values():
        rows = reader.option("escape", '"').option("mode", "FAILFAST").csv(group)
        parts.append(rows.withColumn("dimension_type", dimension_type(F.col("_metadata.file_path"))))
    return union_rows(parts) if parts else None


def _unzip(batches: Iterator) -> Iterator:
    """Every member of each archive as field lists, a member's header being its row 0."""
    import csv
    import io
    import zipfile
    from itertools import islice

    import pyarrow as pa

    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for name in (n for n in archive.namelist() if not n.endswith("/")):
                    with archive.open(name) as member:
                        text = io.TextIOWrapper(member, "utf-8", newline="")
                        first = text.readline()
                        sep = "\t" if "\t" in first else ","
                        header = next(csv.reader([first], delimiter=sep), [])
                        yield _rows_batch(pa, path, name, 0, [header])
                        rows, at = (r for r in csv.reader(text, delimiter=sep) if r), 1
                        while chunk := list(islice(rows, 10_000)):
                            odd = next((k for k, r in enumerate(chunk) if len(r) != len(header)), None)
                            if odd is not None:
                                raise ValueError(f"row {at + odd} of {name} in {path} has {len(chunk[odd])} fields, not {len(header)}")
                            yield _rows_batch(pa, path, name, at, chunk)
                            at += len(chunk)


def _rows_batch(pa, path: str, member: str, start: int, rows: list[list[str]]):
    return pa.RecordBatch.from_pydict(
        {
            "path": pa.array([path] * len(rows), pa.string()),
            "member": pa.array([member] * len(rows), pa.string()),
            "idx": pa.array(range(start, start + len(rows)), pa.int64()),
            "fields": pa.array(rows, pa.list_(pa.string())),
        }
    )


def _zip_parts(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    archives = spark.read.format("binaryFile").load(list(paths)).select("path", "content")
    rows = cut_lineage(archives.mapInArrow(_unzip, "path string, member string, idx bigint, fields array<string>"))
    heads = rows.filter("idx = 0").select("path", "member", F.col("fields").alias("header"))
    return [
        rows.filter("idx > 0")
        .join(heads.filter(F.col("header") == F.array(*[F.lit(c) for c in header])), ["path", "member"], "left_semi")
        .select(*[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(header)])
        for header in (r["header"] for r in heads.select("header").distinct().collect())
        if header
    ]


def read_segments(spark: SparkSession, paths: Sequence[str], multi_line: bool = True) -> DataFrame:
    """Report segments as text columns: comma or tab separated, plain, gzip or zip.

    The separator is a tab when the header line has one. Files with the same header are read
    together. Gzip is told by the ``.gz`` ending, zip by ``.zip``; all members of an archive
    count. A row with more or fewer fields than its header fails the load. Without
    ``multi_line`` no quoted field may hold a line break, and plain files can be split.
    """
    zipped = [p for p in paths if p.lower().endswith(".zip")]
    plain = [p for p in paths if p not in zipped]
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').option("mode", "FAILFAST")
    parts: list[DataFrame] = []
    if plain:
        for header, members in _header_groups(spark, plain).items():
            parts.append(reader.option("sep", "\t" if "\t" in header else ",").csv(members))
    if zipped:
        parts += _zip_parts(spark, zipped)
    if not parts:
        raise FileNotFoundError("no report segments to read")
    return union_rows(parts)
