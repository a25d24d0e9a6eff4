"""Web archives: WARC records written and read back, and an index merged from locally sorted capture runs.

Writing: of equal payloads of at least ``REVISIT_BYTES`` the smallest page id is stored, the others become revisit records
that name it. Digests are compared over slim rows. Records are lines of Spark's text writer with the record end as line
end, so its commit protocol decides which attempt of a lost task counts. Reading: the compressed archives aren't split; a
task gets the lines of its archives in order and cuts records by their content length, one record in memory at a time. The
digest of every stored payload is computed again and compared.

Index: each archive's captures are sorted by URL key, time and page where they are read, and written as a run. Runs are
dealt out by ranges of the whole key, so the captures of one URL may fill many ranges; in each range a loser tree merges
the pieces of the runs, which come in their order and are not sorted again. Numbers within a URL's history go on from
range to range by a carry of one row a range.

Cases: a null html is an empty payload; a null URL is kept as such and sorts first; rows of a null page_id are responses
that nobody refers to, and so are rows that repeat a page_id and its payload. Control signs in URLs are percent-encoded.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlake.llm.shared import if_few, shared_folder, written

REVISIT_BYTES = 100
RECORDS_PER_ARCHIVE = 50_000
CAPTURES_PER_RANGE = 100_000
CAPTURES = "page_id bigint, url string, captured bigint, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, archive string, payload binary"
MERGED = "bucket int, position bigint, rank bigint"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str) -> Column:
    """Host labels from the last on, then path and query; the fragment goes."""
    scheme = "^[A-Za-z][A-Za-z0-9+.-]*://"
    host = F.lower(F.regexp_extract(url, scheme + "([^/?#:]*)", 1))
    rest = F.regexp_replace(F.regexp_replace(url, scheme + "[^/?#]*", ""), "#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def _record_id(*parts: Column) -> Column:
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(text.cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def write_archives(pages: DataFrame, captured: Column, path: str) -> None:
    """A record for each page in gzip archives; ``captured`` is its time."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", captured.alias("captured"), html.alias("html"))
    rows = rows.withColumn("bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    slim = written(rows.where(f"bytes >= {REVISIT_BYTES} and page_id is not null").select("page_id", "digest"), "payloads")
    firsts = written(
        slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last").select("digest", "first"), "firsts"
    )
    revisits = written(slim.join(firsts, "digest").where("page_id > first").select("page_id", "digest", "first").distinct(), "revisits")
    rows = rows.join(revisits, ["page_id", "digest"], "left")
    revisit = F.col("first").isNotNull()

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n")), F.lit(""))

    web = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(web, F.when(revisit, "").otherwise(F.col("html")))
    safe = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), "[\\x00-\\x1f\\x7f]", "%20")
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        field("WARC-Date", F.date_format(F.to_utc_timestamp("captured", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        field("WARC-Target-URI", safe),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("WARC-Profile", F.when(revisit, _PROFILE)),
        field("WARC-Refers-To", F.when(revisit, _record_id(F.col("first"), F.col("digest")))),
        field("X-Refers-To-Page", F.col("first")),
        field("X-Page", F.col("page_id")),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )
    record_end = "\r\n\r\n"
    rows.select(record).write.option("lineSep", record_end).option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).option("compression", "gzip").text(path)


def _micros(date: str) -> int:
    from datetime import UTC, datetime, timedelta

    return (datetime.fromisoformat(date) - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


def _capture(archive: str, head: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    web, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(line.split(b":")[1] for line in web.split(b"\r\n") if line.lower().startswith(b"content-length:")))
    digest = head["warc-payload-digest"].removeprefix("sha256:")
    if head["warc-type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {head['warc-record-id']} in {archive} is damaged")
    number = lambda name: int(head[name]) if name in head else None
    time = _micros(head["warc-date"]) if "warc-date" in head else None
    kept = payload if with_payload and head["warc-type"] == "response" else None
    return number("x-page"), head.get("warc-target-uri"), time, head["warc-type"], size, digest, number("x-refers-to-page"), archive, kept


def parse(lines: Iterator[tuple[str, bytes]], with_payload: bool) -> Iterator[tuple]:
    """Captures of (archive, line) pairs; lines end with CR LF, which is not part of them."""
    for archive, own in groupby(lines, key=lambda x: x[0]):
        for _, line in own:
            if not line:
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record begins with {line[:40]!r} in {archive}")
            head = {}
            for _, line in own:
                if not line:
                    break
                name, _, value = line.decode().partition(":")
                head[name.lower()] = value.strip()
            left, parts = int(head["content-length"]), []
            while left >= 0:
                got = next(own, None)
                if got is None:
                    raise ValueError(f"record cut short in {archive}")
                parts.append(got[1])
                left -= len(got[1]) + 2
            if left != -2:
                raise ValueError(f"a record of {archive} isn't as long as it says")
            yield _capture(archive, head, b"\r\n".join(parts), with_payload)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The captures of all archives in a folder, those of one archive together and in order."""
    lines = spark.read.option("lineSep", "\r\n").text(path).select(F.col("_metadata.file_path").alias("archive"), F.col("value").cast("binary").alias("line"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1)), strict=True)

        yield from _batches(parse(pairs(), with_payload), CAPTURES)

    return lines.mapInArrow(read, CAPTURES)


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _batches(rows: Iterator[tuple], schema: str, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    out: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[k]) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], list(names))

    for row in rows:
        out.append(row)
        if len(out) == size:
            yield batch()
            out.clear()
    if out:
        yield batch()


def merge(runs: list[list[tuple]]) -> Iterator[tuple]:
    """Sorted runs as one, by a tree of losers: each inner node keeps the run that lost there, and a new head of the
    winning run plays only the nodes on its way up."""
    n = len(runs)
    heads = [iter(r) for r in runs]
    top = [next(h, None) for h in heads]
    tree = [-1] * n

    def loses(a: int, b: int) -> bool:
        """An exhausted run loses; equal heads go to the earlier run."""
        if top[a] is None or top[b] is None:
            return top[a] is None
        return (top[a], a) > (top[b], b)

    def play(run: int, node: int) -> int:
        while node:
            if tree[node] == -1:
                tree[node] = run
                return -1
            if loses(run, tree[node]):
                run, tree[node] = tree[node], run
            node //= 2
        return run

    winner = -1
    for run in range(n):
        winner = play(run, (run + n) // 2)
    while n and top[winner] is not None:
        yield top[winner]
        top[winner] = next(heads[winner], None)
        winner = play(winner, (winner + n) // 2)


def sorted_runs(rows: Iterator[tuple]) -> list[list[tuple]]:
    """(run, key, row number) as lists of (key, row number) that ascend. A run that comes in pieces, or out of order, is
    several."""
    out: list[list[tuple]] = []
    before = None
    for run, key, k in rows:
        if before is None or run != before[0] or key < before[1]:
            out.append([])
        out[-1].append((key, k))
        before = (run, key)
    return out


def merge_index(captures: DataFrame) -> DataFrame:
    """``captures`` with url_key, bucket, position and nth: the globally ordered index is that of (bucket, position), and
    nth numbers the captures of a URL key by time and page from 1 on."""
    spark = captures.sparkSession
    key = ["url_key", "captured", "page_id"]
    runs = written(captures.withColumn("url_key", url_key("url")).sortWithinPartitions("archive", *key), "runs")
    ranges = max(1, -(-runs.count() // CAPTURES_PER_RANGE))
    dealt = runs.repartitionByRange(ranges, *key)
    fields = [(f.name, f.dataType.simpleString()) for f in dealt.schema]
    schema = ", ".join(f"{n} {k}" for n, k in fields) + ", " + MERGED
    at = [n for n, _ in fields].index
    run, place = at("archive"), [at(k) for k in key]

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        order = lambda r: tuple((r[p] is not None, r[p]) if r[p] is not None else (False, 0) for p in place)
        pieces = sorted_runs((r[run], order(r), k) for k, r in enumerate(rows))
        bucket = TaskContext.get().partitionId()

        def out():
            rank, last = 0, None
            for position, (where, k) in enumerate(merge(pieces)):
                rank = rank + 1 if where[0] == last else 1
                last = where[0]
                yield (*rows[k], bucket, position, rank)

        yield from _batches(out(), schema)

    index = written(dealt.mapInArrow(merged, schema), "index")
    edges = index.groupBy("bucket").agg(F.min_by("url_key", "position").alias("first"), F.max_by("url_key", "position").alias("last"), F.max_by("rank", "position").alias("n"))
    carry, last, before = [], object(), 0
    for row in edges.orderBy("bucket").toLocalIterator():
        start = before if row["first"] == last else 0
        if start:
            carry.append((row["bucket"], row["first"], start))
        before = row["n"] + (start if row["first"] == row["last"] else 0)
        last = row["last"]
    carried = spark.createDataFrame(carry, "bucket int, url_key string, start bigint")
    of = if_few(carried.withColumnRenamed("bucket", "b").withColumnRenamed("url_key", "u"))
    joined = index.join(of, (F.col("bucket") == F.col("b")) & F.col("url_key").eqNullSafe(F.col("u")), "left")
    return joined.withColumn("nth", F.col("rank") + F.coalesce("start", F.lit(0))).drop("b", "u", "start", "rank")


def archive_round_trip(pages: DataFrame, captured: Column) -> DataFrame:
    """Archives of ``pages`` in the shared folder, read back and indexed."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    write_archives(pages, captured, path)
    return merge_index(read_archives(spark, path).drop("payload"))
