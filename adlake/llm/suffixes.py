"""Removal of repeated byte strings by longest-previous-factor arrays over suffix order.

A byte goes if a string of ``DEPTH`` bytes that covers it also starts in a document with a smaller id. For each such string,
its longest previous factor decides: the longest match with a place of an earlier document, which is found at the previous or
the next place of a smaller document in suffix order. It is asked for ``DEPTH`` bytes, so suffixes are sorted to that depth.

Sorting all suffixes of a corpus in one order would move many times its size. Equal strings of ``DEPTH`` bytes have equal
minimisers, the least hash among their grams of ``GRAM`` bytes, so the suffix order is partitioned by those: consecutive
places with one minimiser are a piece, and travel as one string.

1. Each ``SENDER`` bytes of documents tell which minimisers they have, a few bytes each; one that several documents of
   these have goes once, with its count. Those of more than one document come back to the documents.
2. Of these pieces each sender sends every distinct one once, with its smallest document; in its other documents it goes
   whole. A bucket gathers its pieces, keeps the smallest document's of equal ones, sorts the suffixes that begin
   within them, and takes their longest previous factors.
3. The places found are cut from the documents.

What buckets send back is a row for each group of documents, not for each document: a document has places in nearly as many
buckets as it has pieces, and buckets grow in number with the corpus. A group's rows are then parted by document.

A minimiser of very many places could overfill its bucket, if what is around it differs. Minimisers of more than
``HOT_PLACES`` places, or of 1 / 2**20 of all, of which there are a million at most, are known after the first step: there
every suffix travels by a hash of its own.

Pieces are told apart by 64-bit hashes; that a string repeats is decided on its bytes.

Cases: null texts are empty; texts shorter than ``DEPTH`` keep all bytes. A null doc_id is smaller than none and keeps all bytes. Rows that
repeat a doc_id don't remove each other's bytes. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adlake.llm.shared import written
from adlake.llm.words import Texts, lists, mix, pieces, texts

DEPTH, GRAM = 50, 16
#: Places of a piece: its first and last string then hold all of its bytes.
RUN = DEPTH + 1
#: A longer text is worked through in stretches of so many places.
STRETCH = 1 << 21
HOT_PLACES = 20_000
#: Bytes of text for each bucket of minimisers, of pieces, and for each group of documents.
MINIMISER_BUCKET, PIECE_BUCKET, GROUP = 48 << 20, 8 << 20, 32 << 20
#: Bytes of text that are sent together.
SENDER = 16 << 20
#: Places hashed at once: their arrays stay in a core's cache.
BLOCK = 1 << 14
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW32 = np.uint64((1 << 32) - 1)
_ASKED = pa.schema({"bucket": pa.int64(), "code": pa.binary(), "start": pa.binary(), "n": pa.binary(), "ids": pa.binary(), "keys": pa.binary(), "often": pa.binary(), "counts": pa.binary()})
_SHARED = pa.schema({"id": pa.int64(), "h": pa.int64(), "starts": pa.list_(pa.int32()), "hot": pa.int64()})
_SENT = pa.schema({"bucket": pa.int64(), "text": pa.large_binary(), "places": pa.binary(), "owner": pa.binary(), "piece": pa.binary(), "doc": pa.binary(), "start": pa.binary(), "stop": pa.binary(), "ids": pa.binary(), "keys": pa.binary()})
_SPANS = pa.schema({"id": pa.int64(), "h": pa.int64(), "low": pa.list_(pa.int32()), "high": pa.list_(pa.int32())})
_STARTS_DEALT = pa.schema({"group": pa.int64(), "ids": pa.binary(), "keys": pa.binary(), "n": pa.binary(), "starts": pa.binary(), "hot": pa.int64()})
_SPANS_DEALT = pa.schema({"group": pa.int64(), "ids": pa.binary(), "keys": pa.binary(), "n": pa.binary(), "low": pa.binary(), "high": pa.binary()})


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.binary(): "binary", pa.large_binary(): "binary", pa.list_(pa.int32()): "array<int>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.array([1, *[base] * (n - 1)], np.uint64))


#: Of the hashes' base and its inverse modulo 2**64.
_UP, _DOWN = _powers(int(_ODD), BLOCK + DEPTH), _powers(pow(int(_ODD), -1, 1 << 64), BLOCK + DEPTH)


def _sums(data: np.ndarray, at: int) -> np.ndarray:
    """Sums of a block's bytes, each times the power of its place: differences are those of strings, shifted."""
    part = data[at : at + BLOCK + DEPTH - 1]
    out = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part + np.uint64(1)) * _DOWN[: len(part)], out=out[1:])
    return out


def string_hashes(data: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """64 bits of the strings of each size, ``DEPTH`` at most, from each byte on that has so many after it."""
    out = [np.empty(max(len(data) - size + 1, 0), np.uint64) for size in sizes]
    for at in range(0, len(data), BLOCK):
        sums = _sums(data, at)
        for size, o in zip(sizes, out, strict=True):
            n = min(BLOCK, len(data) - at - size + 1)
            if n > 0:
                o[at : at + n] = mix((sums[size : size + n] - sums[:n]) * _UP[size - 1 : size - 1 + n])
    return out


def _hashes_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``string_hashes`` of ``DEPTH`` bytes at ascending places."""
    out = np.empty(len(at), np.uint64)
    blocks = range(0, len(data), BLOCK)
    ends = np.searchsorted(at, [*blocks, len(data)])
    for block, a, b in zip(blocks, ends[:-1], ends[1:], strict=True):
        if a < b:
            sums, place = _sums(data, block), at[a:b] - block
            out[a:b] = mix((sums[place + DEPTH] - sums[place]) * _UP[place + DEPTH - 1])
    return out


def _order(values: np.ndarray, bits: int = 64) -> np.ndarray:
    """The stable order of values of so many bits. Their high bits are sorted with the place in one number."""
    n = len(values).bit_length()
    order = _sorted_places(values << np.uint64(64 - bits), n)
    order &= np.uint64((1 << n) - 1)
    order = order.view(np.int64)
    if bits + n > 64:
        got = values[order]
        if (got[1:] < got[:-1]).any():
            return np.argsort(values, kind="stable")
    return order


def _sorted_places(values: np.ndarray, n: int) -> np.ndarray:
    """The sorted values, in their own memory, each with its place for its ``n`` low bits."""
    values >>= np.uint64(n)
    values <<= np.uint64(n)
    values |= np.arange(len(values), dtype=np.uint64)
    values.sort()
    return values


def _least(g: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        g = np.minimum(g[:-have], g[have:])
        have *= 2
    return np.minimum(g[: len(g) - width + have], g[width - have :]) if have < width else g


def _stretches(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, where each text ends, (row, place in its text of the first byte) of each); long texts in overlapping stretches."""
    for row, piece in pieces(texts(column)):
        n = len(piece.data)
        if len(piece.offsets) > 2 or n <= STRETCH:
            rows = np.arange(row, row + len(piece.offsets) - 1)
            yield piece.data, piece.offsets, np.stack([rows, np.zeros(len(rows), np.int64)], 1)
        else:
            for at in range(0, n, STRETCH):
                part = piece.data[at : at + STRETCH + DEPTH - 1]
                yield part, np.array([0, len(part)]), np.array([[row, at]])


def cut_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, place in the data, places, minimiser) of the pieces."""
    n = len(data) - DEPTH + 1
    width = DEPTH - GRAM + 1
    firsts, minis, before = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], None
    # Each text's first place begins a piece.
    begins = offsets[:-1][np.diff(offsets) >= DEPTH]
    for at in range(0, max(n, 0), BLOCK):
        sums, m = _sums(data, at), min(BLOCK, n - at)
        gram = mix((sums[GRAM : GRAM + m + width - 1] - sums[: m + width - 1]) * _UP[GRAM - 1 : GRAM + m + width - 2])
        mini = _least(gram, width)
        new = np.empty(m, bool)
        new[0] = before is None or mini[0] != before
        np.not_equal(mini[1:], mini[:-1], out=new[1:])
        new[begins[slice(*np.searchsorted(begins, [at, at + m]))] - at] = True
        first = np.flatnonzero(new)
        firsts.append(first + at)
        minis.append(mini[first])
        before = mini[-1]
    first, mini = np.concatenate(firsts), np.concatenate(minis)
    text = np.searchsorted(offsets, first, "right") - 1
    # Strings that would run into the next text are none.
    stop = offsets[text + 1] - DEPTH + 1
    inside = first < stop
    first, mini, text, stop = first[inside], mini[inside], text[inside], stop[inside]
    count = np.minimum(np.append(first[1:], n), stop) - first
    parts = -(-count // RUN)
    of = np.repeat(np.arange(len(parts)), parts)
    skip = RUN * (np.arange(len(of)) - (np.cumsum(parts) - parts)[of])
    return text[of], first[of] + skip, np.minimum(count[of] - skip, RUN), mini[of]


def _names(data: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """64 bits of each piece, from its first and last string; pieces stand in order and don't share places."""
    first, last = _hashes_at(data, np.stack([at, at + count - 1], 1).reshape(-1)).reshape(-1, 2).T
    return mix(first * _ODD ^ mix(last + count.astype(np.uint64)))


def _code(mini: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 more bits. Minimisers of one code only send more than they need to."""
    return ((mini >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (mini & _LOW32)


def _groups(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1])) if len(sorted_values) else np.zeros(0, np.int64)


def _packed(values: np.ndarray) -> bytes:
    """32-bit numbers that mostly ascend: their differences, compressed digit by digit."""
    values = values.view(np.uint32)
    steps = np.diff(values, prepend=np.uint32(0))
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _unpacked(rows: list[dict], name: str) -> np.ndarray:
    """The numbers of all rows, whose ``n`` tell how many there are."""
    out = []
    for r, n in zip(rows, _of(rows, "n", np.uint32), strict=True):
        if count := int(n.sum(dtype=np.int64)):
            digits = np.frombuffer(pa.decompress(r[name], 4 * count, "zstd", asbytes=True), np.uint8)
            out.append(np.cumsum(np.ascontiguousarray(digits.reshape(4, count).T).view(np.uint32).reshape(-1), dtype=np.uint32))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _row(schema: pa.Schema, bucket: int, **arrays: np.ndarray | bytes) -> tuple:
    plain = lambda x: x if isinstance(x, bytes) else x.tobytes()
    return (bucket, *(plain(arrays[f.name]) if f.name in arrays else b"" for f in list(schema)[1:]))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _senders(batches: Iterator[pa.RecordBatch], texts_at: int = 2) -> Iterator[pa.RecordBatch]:
    """Batches joined until they have ``SENDER`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(texts_at).nbytes
        if size >= SENDER:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _by_small(values: np.ndarray, below: int) -> np.ndarray:
    """The stable order of values under ``below``, by their digits if those are few."""
    return np.argsort(values.astype(np.uint16) if below <= 1 << 16 else values, kind="stable")


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of ranges, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _ask(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The minimisers of the batches of (id, h, text): to their buckets, but those that several documents here have to no
    bucket, with the places of theirs. The places stand by document, ``n`` of each."""
    for batch in _senders(batches):
        ids, keys = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        rows, starts, codes = [], [], []
        for data, offsets, where in _stretches(batch.column(2)):
            text, at, _, mini = cut_places(data, offsets)
            rows.append(where[text, 0].astype(np.int32))
            starts.append((at - offsets[text] + where[text, 1]).astype(np.uint32))
            codes.append(_code(mini, buckets))
        if not codes:
            continue
        row, start, code = np.concatenate(rows), np.concatenate(starts), np.concatenate(codes)
        del rows, starts, codes
        order = _order(code, 32 + buckets.bit_length())
        group = _groups(code[order])
        size = np.diff(np.append(group, len(code)))
        several = row[order[group]] != row[order[group + size - 1]]
        here = np.zeros(len(code), bool)
        here[order[np.repeat(several, size)]] = True
        often, counts = code[order[group[several]]], size[several].astype(np.uint32)
        out = []
        if here.any():
            used, n = np.unique(row[here], return_counts=True)
            out.append(_row(_ASKED, -1 - int(keys[used[0]]) % buckets, start=_packed(start[here]), n=n.astype(np.uint32), ids=ids[used], keys=keys[used]))
        row, start, code = row[~here], start[~here], code[~here]
        by = _by_small(code >> np.uint64(32), buckets)
        row, start, code = row[by], start[by], code[by]
        to, to_often = (code >> np.uint64(32)).astype(np.int64), (often >> np.uint64(32)).astype(np.int64)
        pair = _groups(to << 32 | row)
        n, whose, to_pair = np.diff(np.append(pair, len(row))).astype(np.uint32), row[pair], to[pair]
        code, often = code.astype(np.uint32), often.astype(np.uint32)
        numbers = np.union1d(to_pair, to_often)
        cuts = [[slice(*x) for x in np.searchsorted(t, [numbers, numbers + 1]).T] for t in (to, to_pair, to_often)]
        for b, mine, docs, its in zip(numbers, *cuts, strict=True):
            out.append(
                _row(
                    _ASKED, int(b), code=code[mine], start=_packed(start[mine]), n=n[docs], ids=ids[whose[docs]], keys=keys[whose[docs]],
                    often=often[its], counts=counts[its],
                )
            )
        yield _batch(out, _ASKED)


def _of(rows: list[dict], name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(r[name], kind) for r in rows]


def _documents(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document of each entry, ids, keys); documents of all rows are numbered through."""
    docs, ids, keys = _of(rows, "doc", np.uint32), _of(rows, "ids", np.int64), _of(rows, "keys", np.int64)
    base = np.cumsum([0, *map(len, ids)])
    return np.concatenate([d + b for d, b in zip(docs, base[:-1], strict=True)]), np.concatenate(ids), np.concatenate(keys)


def _buckets(batches: Iterator[pa.RecordBatch], by: str = "bucket") -> Iterator[tuple[int, Iterator[dict]]]:
    def rows() -> Iterator[dict]:
        for batch in batches:
            columns = [(f.name, batch.column(k), f.type == pa.int64()) for k, f in enumerate(batch.schema)]
            for at in range(len(batch)):
                yield {name: c[at].as_py() if number else c[at].as_buffer() for name, c, number in columns}

    yield from groupby(rows(), key=lambda r: r[by])


def _by_document(doc: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """(documents, lists of their values)."""
    order = np.argsort(doc, kind="stable")
    used, number = np.unique(doc[order], return_inverse=True)
    return used, [lists(number, pa.array(v[order].astype(np.int32)), len(used)) for v in values]


def _share(batches: Iterator[pa.RecordBatch], hot_places: int) -> Iterator[pa.RecordBatch]:
    """The places of each document whose minimisers another document has, too; and the hot minimisers."""
    for bucket, own in _buckets(batches):
        hot = np.zeros(0, np.uint64)
        rows = list(own)
        ids, keys = (np.concatenate(_of(rows, k, np.int64)) for k in ("ids", "keys"))
        n, start = np.concatenate(_of(rows, "n", np.uint32)), _unpacked(rows, "start")
        if bucket >= 0:
            every = np.concatenate(_of(rows, "code", np.uint32) + _of(rows, "often", np.uint32)).astype(np.uint64)
            counts = np.concatenate(_of(rows, "counts", np.uint32))
            own_places = len(start)
            number = np.concatenate([np.repeat(np.arange(len(n), dtype=np.int32), n), np.full(len(counts), -1, np.int32)])
            del rows
            order = _order(every, 32)
            group = _groups(every[order])
            size = np.diff(np.append(group, len(every)))
            # A sender's own mark of several documents sorts last; it is also told where no other sender has that minimiser.
            first, last = order[group], order[group + size - 1]
            shared = (number[last] < 0) | (number[first] != number[last])
            kept = np.zeros(len(every), bool)
            kept[order[np.repeat(shared, size)]] = True
            kept = kept[:own_places]
            marks = np.flatnonzero(order >= own_places)
            more = counts[order[marks] - own_places].astype(np.int64) - 1
            total = size + np.bincount(np.searchsorted(group, marks, "right") - 1, more, len(group)).astype(np.int64)
            hot = every[order[group[total > hot_places]]] | (np.uint64(bucket) << np.uint64(32))
            start, n = start[kept], np.bincount(number[:own_places][kept], minlength=len(n))
            del every, number, order, group, size, first, last, total
        used = np.flatnonzero(n)
        ends = np.append(0, np.cumsum(n[used], dtype=np.int64))
        if len(used):
            starts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(start.view(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[used]), pa.array(keys[used]), starts, pa.nulls(len(used), pa.int64())], schema=_SHARED)
        if len(hot):
            empty = pa.nulls(len(hot), pa.int64())
            yield pa.RecordBatch.from_arrays([empty, empty, pa.nulls(len(hot), pa.list_(pa.int32())), pa.array(hot.view(np.int64))], schema=_SHARED)


def _deal(batches: Iterator[pa.RecordBatch], groups: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(id, h, lists) of documents as a row for each group of documents; rows without an id as they are."""
    names = [f.name for f in list(schema)[4:] if f.type == pa.binary()]
    for batch in batches:
        if batch.column("id").null_count:
            plain = {f.name: pa.nulls(len(batch), f.type) for f in schema} | {"hot": batch.column("hot")}
            yield pa.RecordBatch.from_pydict(plain, schema=schema)
            continue
        ids, keys = batch.column("id").to_numpy(), batch.column("h").to_numpy()
        ends = batch.column(names[0]).offsets.to_numpy().astype(np.int64)
        group = (mix(keys.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
        by = _by_small(group, groups)
        ids, keys, group, n = ids[by], keys[by], group[by], np.diff(ends)[by]
        spot = _ranges(ends[:-1][by], n)
        values = [batch.column(name).values.to_numpy()[spot] for name in names]
        at, first = np.append(0, np.cumsum(n)), _groups(group)
        n = n.astype(np.uint32)
        rows = []
        for a, b in zip(first, np.append(first[1:], len(group)), strict=True):
            mine = slice(at[a], at[b])
            rows.append((int(group[a]), *(x.tobytes() for x in (ids[a:b], keys[a:b], n[a:b])), *(_packed(v[mine]) for v in values), *[None] * (len(schema) - 4 - len(names))))
        if rows:
            yield _batch(rows, schema)


def _gather(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(id, h, lists), a row for each document, of what ``_deal`` made; rows come by group, those without one stay as they are."""
    names = [f.name for f in schema if f.type == pa.list_(pa.int32())]
    for group, own in _buckets(batches, "group"):
        rows = list(own)
        if group is None:
            plain = {f.name: pa.nulls(len(rows), f.type) for f in schema} | {"hot": pa.array([r["hot"] for r in rows], pa.int64())}
            yield pa.RecordBatch.from_pydict(plain, schema=schema)
            continue
        ids, keys = (np.concatenate(_of(rows, k, np.int64)) for k in ("ids", "keys"))
        n = np.concatenate(_of(rows, "n", np.uint32)).astype(np.int64)
        order = np.lexsort((ids, keys))
        new = _groups(keys[order])
        if (ids[order[1:]] != ids[order[:-1]]).any():
            new = np.union1d(new, np.flatnonzero(ids[order[1:]] != ids[order[:-1]]) + 1)
        spot = _ranges((np.cumsum(n) - n)[order], n[order])
        ends = pa.array(np.append(0, np.cumsum(n[order]))[np.append(new, len(order))], pa.int32())
        values = [pa.ListArray.from_arrays(ends, pa.array(_unpacked(rows, name).view(np.int32)[spot])) for name in names]
        none = [pa.nulls(len(new), f.type) for f in list(schema)[2 + len(names) :]]
        yield pa.RecordBatch.from_arrays([pa.array(ids[order[new]]), pa.array(keys[order[new]]), *values, *none], schema=schema)


def _merged(group: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of one group that touch, as one; no span ends after a later one of its group."""
    order = np.lexsort((high, low, group))
    group, low, high = group[order], low[order], high[order]
    new = np.append(True, (group[1:] != group[:-1]) | (low[1:] > high[:-1])) if len(low) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return group[first], low[first], high[np.append(first[1:], len(low))[: len(first)] - 1]


def _send(batches: Iterator[pa.RecordBatch], asked: int, buckets: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The distinct pieces of the batches of (id, h, text, starts); documents that have one after a smaller one lose it here."""
    for batch in _senders(batches):
        ids, keys = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        ends = batch.column(3).offsets.to_numpy()
        wanted = np.repeat(np.arange(len(ids), dtype=np.int64) << 32, np.diff(ends)) | batch.column(3).values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
        wanted.sort()
        got: list[tuple[np.ndarray, ...]] = []
        strings: list[np.ndarray] = []
        before = 0
        for data, offsets, where in _stretches(batch.column(2)):
            text, at, count, mini = cut_places(data, offsets)
            start = at - offsets[text] + where[text, 1]
            place = (where[text, 0] << 32) | start
            found = np.searchsorted(wanted, place)
            mine = np.flatnonzero(wanted[np.minimum(found, len(wanted) - 1)] == place) if len(wanted) else np.zeros(0, np.int64)
            row, start, at, count, code = where[text[mine], 0], start[mine], at[mine], count[mine], _code(mini[mine], asked)
            name = _names(data, at, count)
            at_hot = np.searchsorted(hot, code)
            burst = hot[np.minimum(at_hot, len(hot) - 1)] == code if len(hot) else np.zeros(len(code), bool)
            if burst.any():
                each = np.repeat(np.flatnonzero(burst), count[burst])
                step = np.arange(len(each)) - np.repeat(np.cumsum(count[burst]) - count[burst], count[burst])
                own = string_hashes(data, DEPTH)[0][at[each] + step]
                keep = ~burst
                row, start, at = (np.concatenate([x[keep], x[each] + s]) for x, s in ((row, 0), (start, step), (at, step)))
                count, code, name = np.concatenate([count[keep], np.ones(len(each), np.int64)]), np.concatenate([code[keep], mix(own)]), np.concatenate([name[keep], own])
            got.append((row.astype(np.int32), start.astype(np.uint32), count.astype(np.uint8), code, name, at + before))
            strings.append(data)
            before += len(data)
        if not got:
            continue
        row, start, count, code, name, at = (np.concatenate(x) for x in zip(*got, strict=True))
        del got
        data = np.concatenate(strings)
        order = _order(name)
        group = _groups(name[order])
        size = np.diff(np.append(group, len(name)))
        first = order[group]
        owner = np.minimum.reduceat(ids[row[order]], group) if len(group) else ids[:0]
        later = ids[row[order]] > np.repeat(owner, size)
        out = []
        if later.any():
            gone = order[later]
            r, low, high = _merged(row[gone], start[gone].astype(np.int64), start[gone] + count[gone].astype(np.int64) + DEPTH - 1)
            used, number = np.unique(r, return_inverse=True)
            out.append(_row(_SENT, -1 - int(keys[r[0]]) % buckets, start=low.astype(np.uint32), stop=high.astype(np.uint32), doc=number.astype(np.uint32), ids=ids[used], keys=keys[used]))
        # Pieces by bucket, and the entries of those that keep them.
        bucket = (mix(code[first]) % np.uint64(buckets)).astype(np.int64)
        by = _by_small(bucket, buckets)
        numbers, begin = np.unique(bucket[by], return_index=True)
        stop = np.append(begin[1:], len(by))
        entry = order[~later]
        mine = np.add.reduceat(~later, group, dtype=np.int64) if len(group) else np.zeros(0, np.int64)
        entry = entry[_ranges((np.cumsum(mine) - mine)[by], mine[by])]
        ends = np.append(0, np.cumsum(mine[by]))
        piece = np.repeat(np.arange(len(by)), mine[by])
        pair, doc = np.unique(bucket[by][piece] << 32 | row[entry], return_inverse=True)
        pairs = np.searchsorted(pair, [numbers << 32, numbers + 1 << 32])
        whose = pair & (1 << 32) - 1
        first, owner, start = first[by], owner[by], start[entry]
        for b, p, q, x, y in zip(numbers, begin, stop, *pairs, strict=True):
            g = first[p:q]
            e = slice(ends[p], ends[q])
            spot = _ranges(at[g], count[g] + np.int64(DEPTH - 1))
            out.append(
                _row(
                    _SENT, int(b), text=pa.compress(data[spot].tobytes(), "zstd", asbytes=True), places=count[g], owner=owner[p:q],
                    piece=(piece[e] - p).astype(np.uint32), doc=(doc[e] - x).astype(np.uint32), start=start[e], ids=ids[whose[x:y]], keys=keys[whose[x:y]],
                )
            )
        yield _batch(out, _SENT)


def _smaller(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest one before and after it with a smaller value, -1 where there is none."""

    def before(v: np.ndarray) -> np.ndarray:
        near = np.arange(-1, len(v) - 1)
        live = np.arange(len(v))
        while len(live):
            live = live[near[live] >= 0]
            live = live[v[near[live]] >= v[live]]
            near[live] = near[near[live]]
        return near

    back = before(values[::-1])[::-1]
    return before(values), np.where(back >= 0, len(values) - 1 - back, -1)


def previous_factors(data: np.ndarray, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each place of the data, which ``DEPTH`` bytes follow, the longest match with a place of a smaller owner, to that depth."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    load = np.ndarray((len(data),), ">u8", padded, strides=(1,))
    steps = [*range(0, DEPTH - 8, 8), DEPTH - 8]
    words = [load[at + s].astype(np.uint64) for s in steps]
    order = np.lexsort((owner, *reversed(words)))
    words, owner = [w[order] for w in words], owner[order]
    longest = np.zeros(len(at), np.int64)
    for near in _smaller(owner):
        live = np.flatnonzero(near >= 0)
        for step, w in zip(steps, words, strict=True):
            differ = w[live] ^ w[near[live]]
            same = differ == 0
            bytes_ = np.zeros(len(live), np.int64)
            for k in range(7):
                bytes_ += (differ >> np.uint64(56 - 8 * k)) == 0
            longest[live] = np.maximum(longest[live], np.where(same, step + 8, step + bytes_))
            live = live[same]
    out = np.empty(len(at), np.int64)
    out[order] = longest
    return out


def repeated_spans(data: np.ndarray, places: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first byte, byte after the last) of what of the pieces also starts in one with a smaller owner.

    Pieces stand one after the other; ``places`` of each begin a string of ``DEPTH`` bytes.
    """
    begin = np.cumsum(places + DEPTH - 1) - (places + DEPTH - 1)
    name = _names(data, begin, places)
    order = _order(name)
    group = _groups(name[order])
    size = np.diff(np.append(group, len(order)))
    # Of equal pieces the first of the smallest owner's stands for all.
    smallest = np.flatnonzero(owner[order] == np.repeat(np.minimum.reduceat(owner[order], group), size)) if len(group) else group
    one = order[smallest[np.searchsorted(smallest, group)]]
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(one, size)
    later = np.flatnonzero(owner > owner[least])
    one = np.sort(one)
    piece = np.repeat(one.astype(np.int32), places[one])
    at = _ranges(begin[one], places[one])
    # Strings whose hashes have the same high bits are looked at together; their bytes decide.
    n = len(at).bit_length()
    value = _sorted_places(_hashes_at(data, at), n)
    same = value[1:] ^ value[:-1] < np.uint64(1 << n)
    one_of_two = np.zeros(len(value), bool)
    one_of_two[1:] |= same
    one_of_two[:-1] |= same
    twice = (value[one_of_two] & np.uint64((1 << n) - 1)).view(np.int64)
    del value
    twice = twice[previous_factors(data, at[twice], owner[piece[twice]]) >= DEPTH]
    p, low, high = _merged(piece[twice], at[twice] - begin[piece[twice]], at[twice] - begin[piece[twice]] + DEPTH)
    # Pieces that equal the smallest document's in this bucket, and are its own as well, lose the same.
    twins = np.flatnonzero((owner == owner[least]) & (least != np.arange(len(least))))
    first, last = np.searchsorted(p, least[twins]), np.searchsorted(p, least[twins], "right")
    more = np.repeat(twins, last - first)
    spot = _ranges(first, last - first)
    return (
        np.concatenate([later, p, more]),
        np.concatenate([np.zeros(len(later), np.int64), low, low[spot]]),
        np.concatenate([places[later] + DEPTH - 1, high, high[spot]]),
    )


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans that go, by document; rows come by bucket."""
    for bucket, own in _buckets(batches):
        if bucket < 0:
            found = [(_documents([r]), *(np.frombuffer(r[k], np.uint32).astype(np.int64) for k in ("start", "stop"))) for r in own]
        else:
            rows = list(own)
            doc, ids, keys = _documents(rows)
            places = [x.astype(np.int64) for x in _of(rows, "places", np.uint8)]
            base = np.cumsum([0, *map(len, places)])
            entry = np.concatenate([p + b for p, b in zip(_of(rows, "piece", np.uint32), base[:-1], strict=True)])
            start = np.concatenate(_of(rows, "start", np.uint32)).astype(np.int64)
            sizes = (int((p + DEPTH - 1).sum()) for p in places)
            data = np.frombuffer(b"".join(pa.decompress(r["text"], n, "zstd", asbytes=True) for r, n in zip(rows, sizes, strict=True)), np.uint8)
            piece, low, high = repeated_spans(data, np.concatenate(places), np.concatenate(_of(rows, "owner", np.int64)))
            order = np.lexsort((low, piece))
            piece, low, high = piece[order], low[order], high[order]
            first, last = np.searchsorted(piece, entry), np.searchsorted(piece, entry, "right")
            n = last - first
            of = np.repeat(np.arange(len(entry)), n)
            spot = np.arange(len(of)) + np.repeat(first - (np.cumsum(n) - n), n)
            d, low, high = _merged(doc[of], start[of] + low[spot], start[of] + high[spot])
            found = [((d, ids, keys), low, high)]
        for (doc, ids, keys), low, high in found:
            used, (lows, highs) = _by_document(doc, low, high)
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array(ids[used]), pa.array(keys[used]), lows, highs], schema=_SPANS)


def _cut(column: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    """(bytes, bytes removed, longest removed runs, the other bytes) of each text; ``low`` to ``high`` go."""
    data, offsets = texts(column)
    ends = low.offsets.to_numpy()
    low, high = low.values.to_numpy(zero_copy_only=False), high.values.to_numpy(zero_copy_only=False)
    total, gone, spans, kept = [], [], [], []
    for t in range(len(column)):
        text, a, b = data[offsets[t] : offsets[t + 1]], ends[t], ends[t + 1]
        total.append(len(text))
        if a == b:
            gone.append(0)
            spans.append(0)
            kept.append(text.tobytes())
            continue
        order = np.argsort(low[a:b], kind="stable")
        x, y = low[a:b][order], np.maximum.accumulate(high[a:b][order])
        first = np.flatnonzero(np.append(True, x[1:] > y[:-1]))
        x, y = x[first], y[np.append(first[1:], b - a) - 1]
        gone.append(int((y - x).sum()))
        spans.append(len(x))
        kept.append(b"".join(text[i:j].tobytes() for i, j in zip([0, *y], [*x, len(text)], strict=True)))
    columns = [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
    return pa.StructArray.from_arrays(columns, ["n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` is the bytes that stay."""
    spark = docs.sparkSession
    ids = F.col("doc_id").cast("long")
    source = docs.select(F.coalesce(ids, F.lit(0)).alias("id"), F.xxhash64("doc_id", "text").alias("h"), ids.alias("doc_id"), "text")
    size = source.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]
    asked, sent = max(24, size // MINIMISER_BUCKET), max(48, size // PIECE_BUCKET)
    hot_places = max(HOT_PLACES, size >> 24)
    at_bucket = lambda df: df.repartition("bucket").sortWithinPartitions("bucket")
    questions = source.where("doc_id is not null").select("id", "h", "text").mapInArrow(lambda b: _ask(b, asked), _ddl(_ASKED))
    groups = max(16, size // GROUP)
    at_group = lambda df, schema: df.repartition("group").sortWithinPartitions("group").mapInArrow(lambda b: _gather(b, schema), _ddl(schema))
    answers = at_bucket(questions).mapInArrow(lambda b: _deal(_share(b, hot_places), groups, _STARTS_DEALT), _ddl(_STARTS_DEALT))
    shared = written(at_group(answers, _SHARED), "shared")
    hot = np.sort(np.array([r["hot"] for r in shared.where("hot is not null").select("hot").toLocalIterator()], np.int64).view(np.uint64))
    held = spark.sparkContext.broadcast(hot)
    some = shared.where("id is not null").select("id", "h", "starts")
    inside = source.join(some, ["id", "h"]).select("doc_id", "h", "text", "starts")
    pieces_sent = at_bucket(inside.mapInArrow(lambda b: _send(b, asked, sent, held.value), _ddl(_SENT)))
    spans = at_group(pieces_sent.mapInArrow(lambda b: _deal(_find(b), groups, _SPANS_DEALT), _ddl(_SPANS_DEALT)), _SPANS)
    none = F.array().cast("array<int>")
    cut = F.arrow_udf(_cut, "struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept:binary>")(F.col("text"), *(F.coalesce(k, none) for k in ("low", "high")))
    return source.join(spans, ["id", "h"], "left").select("doc_id", cut.alias("cut")).select("doc_id", "cut.*")
