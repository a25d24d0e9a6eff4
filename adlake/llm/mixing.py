"""Language-model scores by logistic context mixing over the bits of a text.

A text is taken as its words, A-Z lowered, with one space between and an end sign. Each byte is a path of bits in a Huffman
tree of the corpus' bytes. For each of several numbers of bytes before (``ORDERS``), together with the place in the tree, a predictor
knows how often the next bit was 1. Their predictions are mixed in the logistic domain by weights that a gate selects
(the longest context seen, and how often); the mixture is refined by an adaptive table over the place in the tree and the
mixture itself. The product over all bits is the probability of the text, and over all texts it sums to one.

Learning takes passes over whole documents: bytes, then counts of the predictors, then, on the training documents set
aside, which the counts leave out so far, online gradient steps for the weights in each chunk, averaged, and the counts of
the refining table. With these fitted, the counts of the documents set aside are added, so the predictors that score know
all training documents.

Contexts of one to three bytes are hashed with the place in the tree into tables of ``SLOTS``, which every task gets. Those of four
and five bytes (``LONG``) grow with the corpus and stay distributed: a table holds each context itself with the counts of all
bytes after it, in buckets by the context's last four bytes, a bucket for each ``BUCKET_BYTES`` of text. Documents go to
chunks of ``CHUNK_BYTES`` by hash, and each chunk is sent the counts of its own distinct contexts, and of its own distinct
tokens for the base score.

Cases: a null or empty text is the end token alone. Without training documents counts are 0 and the model is uniform over
the bits. Without documents set aside, half of the training documents, by hash, stand for them. Rows that repeat a doc_id are scored one by one; a null doc_id is held out. Tokens are told apart by 64 bits of
hash. Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from adlake.llm.shared import written
from adlake.llm.words import LOWER, NOT_BLANK, Texts, distinct, hashes, mix, pieces, texts, words

#: Numbers of bytes before, and the bits of each one's table.
ORDERS = (1, 2, 3, 4, 5)
SLOTS = (16, 18, 20)
SHORT, LONG = ORDERS[: len(SLOTS)], ORDERS[len(SLOTS) :]
SPAN = max(ORDERS)
BASES = np.cumsum([0, *(1 << b for b in SLOTS)])
BLOCK = 1 << 14
CHUNK_BYTES = 16 << 20
BUCKET_BYTES = 4 << 20
#: Contexts with a next byte that a task gathers before it hands them over.
HELD = 2 << 20
#: Places within a piece stay below 2 ** 22.
MODEL_PIECE = 3 << 20
MIX_PIECE = 512 << 10
#: Weights begin at START and move by RATE over the root of the squared gradients so far.
START, RATE = 0.3, 0.15
#: Steps of the refining table, over -LIMIT to LIMIT of the mixture's logit.
STEPS, LIMIT = 33, 8.0
SCALE = 12.0
LEVELS = 4
GATES = len(ORDERS) * LEVELS + 1
END = 0x0A
#: The end token's place among the hashed tokens.
END_TOKEN = np.uint64(0x5BD1E995)


class Code(NamedTuple):
    """Paths of bytes: ``node[b, d]`` and ``bit[b, d]`` for d below ``depth[b]``; ``leaf[b]``, the byte's place among the
    leaves from left to right; ``right[n]``, the first leaf on the right of a node."""

    node: np.ndarray
    bit: np.ndarray
    depth: np.ndarray
    leaf: np.ndarray
    right: np.ndarray


class Followers(NamedTuple):
    """The bytes after contexts of one length: ``keys``, a context and a leaf behind it, in order; ``sums[i]``, how often those before i came."""

    keys: np.ndarray
    sums: np.ndarray


class Model(NamedTuple):
    code: Code
    logit: np.ndarray
    gate: np.ndarray
    weights: np.ndarray
    refined: np.ndarray
    #: The counts of the longer contexts, (bucket, keys, counts); tasks get the model without.
    contexts: DataFrame | None = None


def huffman(counts: np.ndarray) -> Code:
    """A code of all 256 bytes; unseen ones count as half a byte."""
    heap = [(max(float(c), 0.5), b, b) for b, c in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    for node in range(256, 511):
        (x, _, left), (y, _, right) = heapq.heappop(heap), heapq.heappop(heap)
        parent[left], parent[right] = (node, 0), (node, 1)
        heapq.heappush(heap, (x + y, node, node))
    paths = []
    for b in range(256):
        path, at = [], b
        while at in parent:
            at, bit = parent[at]
            path.append((at - 256, bit))
        paths.append(path[::-1])
    depth = np.array([len(p) for p in paths])
    node, bit = np.zeros((256, depth.max()), np.int64), np.zeros((256, depth.max()), np.int8)
    for b, path in enumerate(paths):
        for d, (n, v) in enumerate(path):
            node[b, d], bit[b, d] = n, v
    leaf, right = np.zeros(256, np.int64), np.full(255, 256)
    for place, b in enumerate(sorted(range(256), key=lambda b: [v for _, v in paths[b]])):
        leaf[b] = place
        for n, v in paths[b]:
            if v:
                right[n] = min(right[n], place)
    return Code(node, bit, depth, leaf, right)


def tokens(piece: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, where the words of each text begin); end tokens are not among them."""
    data = LOWER[piece.data]
    found = words(Texts(data, piece.offsets), NOT_BLANK)
    return hashes(data, found.start, found.end), found.first


def stream(piece: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, each after SPAN end signs; where each text's own begin; their numbers)."""
    data, offsets = piece
    n, gap = len(offsets) - 1, SPAN + 1
    start = offsets[:-1] + gap * np.arange(n)
    end = offsets[1:] + gap * np.arange(n)
    grown = np.full(len(data) + gap * n, 0x20, np.uint8)
    for a, b, x, y in zip(start, end, offsets[:-1], offsets[1:], strict=True):
        grown[a:b] = data[x:y]
    inside = NOT_BLANK[grown]
    kept = inside.copy()
    kept[1:] |= inside[:-1]  # a blank after each word
    empty = ~np.logical_or.reduceat(inside, start) if n else np.zeros(0, bool)
    kept[end[empty]] = True
    for k in range(SPAN):
        kept[end + 1 + k] = True
    grown = np.where(inside, LOWER[grown], 0x20)
    length = np.add.reduceat(kept, start, dtype=np.int64) - SPAN if n else start
    first = np.cumsum(length + SPAN) - length
    out = np.full(SPAN + int(length.sum()) + SPAN * n, END, np.uint8)
    out[SPAN:] = grown[kept]
    for k in range(SPAN + 1):
        out[first + length - 1 + k] = END
    return out, first, length


def _joined(wide: np.ndarray, bits: int) -> np.ndarray:
    """SPAN + 1 neighbours in one number, the last foremost."""
    have, out = 1, wide
    while have <= SPAN:
        more = min(have, SPAN + 1 - have)
        out = out[:-more] | (wide_from(wide, have, more, bits, len(out) - more) << np.uint64(bits * have))
        have += more
    return out


def wide_from(wide: np.ndarray, skip: int, n: int, bits: int, length: int) -> np.ndarray:
    """The n neighbours from ``skip`` on in one number."""
    out = wide[skip : skip + length]
    for k in range(1, n):
        out = out | (wide[skip + k : skip + k + length] << np.uint64(bits * k))
    return out


def _own(first: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Marks of the texts' own bytes."""
    own = np.ones(n, bool)
    for k in range(SPAN):
        own[first - 1 - k] = False
    own[(first + length)[-1:].sum() :] = False
    return own


def keys_of(out: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each byte of the texts foremost in a number with the SPAN bytes before it, the nearest next."""
    if not len(first):
        return np.zeros(0, np.uint64)
    return _joined(out.astype(np.uint64), 8)[_own(first, length, len(out))[SPAN:]]


def places(out: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, for each byte of the texts the number of its key)."""
    kinds = np.flatnonzero(np.bincount(out, minlength=256))
    n = int(length.sum())
    if (SPAN + 1) * (len(kinds) - 1).bit_length() + n.bit_length() > 64:
        keys = keys_of(out, first, length)
        turn = np.argsort(keys)
        keys = keys[turn]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        distinct_keys = keys[new]
    else:  # few kinds of bytes: key and place fit into one number
        bits, low = (len(kinds) - 1).bit_length(), n.bit_length()
        rank = np.zeros(256, np.uint64)
        rank[kinds] = np.arange(len(kinds))
        both = _joined(rank[out], bits)[_own(first, length, len(out))[SPAN:]] << np.uint64(low) | np.arange(n, dtype=np.uint64)
        both.sort()
        turn = (both & np.uint64((1 << low) - 1)).astype(np.int64)
        both >>= np.uint64(low)
        new = np.concatenate([[True], both[1:] != both[:-1]])
        distinct_keys = np.zeros(int(new.sum()), np.uint64)
        for k in range(SPAN + 1):
            part = both[new] >> np.uint64(bits * k) & np.uint64((1 << bits) - 1)
            distinct_keys |= kinds.astype(np.uint64)[part.astype(np.int64)] << np.uint64(8 * k)
    number = np.empty(n, np.int64)
    number[turn] = np.cumsum(new) - 1
    return distinct_keys, number


class Bit(NamedTuple):
    """One place in the tree for all keys of a byte: ``keys[at]``; of each order's distinct contexts ``slots`` (SHORT) or how often
    the place and a 1 there came (LONG), and how many keys have each."""

    at: slice
    node: int
    bit: int
    slots: list[np.ndarray]
    seen: list[np.ndarray]
    ones: list[np.ndarray]
    repeats: list[np.ndarray]


def _before(known: Followers, context: np.ndarray, leaf: int) -> np.ndarray:
    """How often anything up to the context and the leaf, itself left out, came."""
    return known.sums[np.searchsorted(known.keys, (context << np.uint64(8)) + np.uint64(leaf))]


def _bits(keys: np.ndarray, code: Code, followers: list[Followers]) -> Iterator[Bit]:
    """All bits of sorted distinct keys. Keys of a byte stand together, and in them those of each shorter context. The places below
    a node are neighbours among the leaves, so what came there is a difference of two sums."""
    byte = (keys >> np.uint64(8 * SPAN)).astype(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1], [True]])) if len(keys) else []
    for a, b in zip(edges[:-1], edges[1:], strict=False):
        own, value = keys[a:b], byte[a]
        contexts, repeats = [], []
        for order in ORDERS:
            context = (own >> np.uint64(8 * (SPAN - order))) & np.uint64((1 << (8 * order)) - 1)
            new = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            contexts.append(context[new])
            repeats.append(np.diff(np.append(new, b - a)))
        hashed = [c * np.uint64(0x9FB21C651E98DF25) + np.uint64(order) for c, order in zip(contexts, SHORT, strict=False)]
        long = list(zip(followers, contexts[len(SHORT) :], strict=False))
        low, high = [_before(f, c, 0) for f, c in long], [_before(f, c, 256) for f, c in long]
        for d in range(code.depth[value]):
            number, bit = int(code.node[value, d]), int(code.bit[value, d])
            node = np.uint64(number << 48)
            slots = [(mix(c + node) >> np.uint64(64 - bits)).astype(np.int64) for c, bits in zip(hashed, SLOTS, strict=True)]
            middle = [_before(f, c, code.right[number]) for f, c in long]
            seen, ones = [h - x for h, x in zip(high, low, strict=True)], [h - x for h, x in zip(high, middle, strict=True)]
            yield Bit(slice(a, b), number, bit, slots, seen, ones, repeats)
            low, high = (middle, high) if bit else (low, middle)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(np.append(at, len(keys)))


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, the sum of each one's numbers)."""
    turn = np.argsort(keys)
    keys, n = keys[turn], n[turn]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(n, at) if len(keys) else n


def _together(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return parts[0] if len(parts) == 1 else summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _level(seen: np.ndarray) -> np.ndarray:
    return np.select([seen < 3, seen < 16, seen < 256], [1, 2, 3], LEVELS)


def _logit(seen: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.clip(np.log((ones + 0.4) / (seen - ones + 0.4)), -127 / SCALE, 127 / SCALE)


def _bits_table(seen: np.ndarray, ones: np.ndarray, first_slot: int) -> tuple[np.ndarray, np.ndarray]:
    """(logit in steps of 1 / SCALE, gate) of the slots of a block; a block is in one order's table."""
    logit = np.rint(_logit(seen, ones) * SCALE).astype(np.int8)
    table = np.searchsorted(BASES, first_slot, "right") - 1
    return logit, np.where(seen > 0, table * LEVELS + _level(seen), 0).astype(np.uint8)


def _inputs(bit: Bit, model: Model) -> tuple[list[np.ndarray], np.ndarray]:
    """(predictions of the orders, gate) for each key: the longest context seen, and how often."""
    x, gate = [], None
    for slots, repeats, base in zip(bit.slots, bit.repeats, BASES, strict=False):
        slots = slots + base
        x.append(np.repeat(model.logit[slots].astype(np.float32) / np.float32(SCALE), repeats))
        of = np.repeat(model.gate[slots], repeats)
        gate = of if gate is None else np.maximum(gate, of)
    for k, (seen, ones) in enumerate(zip(bit.seen, bit.ones, strict=True), len(SHORT)):
        x.append(np.repeat(_logit(seen, ones).astype(np.float32), bit.repeats[k]))
        gate = np.maximum(gate, np.repeat(np.where(seen > 0, k * LEVELS + _level(seen), 0).astype(np.uint8), bit.repeats[k]))
    return x, gate


def _mixture(x: list[np.ndarray], gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return sum(weights[:, k][gate] * x[k] for k in range(len(x)))


def _squash(t: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(t, -30, 30)))


def _step(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower step of the refining table, share of the upper one)."""
    at = (np.clip(t, -LIMIT, LIMIT) + LIMIT) * ((STEPS - 1) / (2 * LIMIT))
    low = np.minimum(at.astype(np.int64), STEPS - 2)
    return low, at - low


NONE = [Followers(np.zeros(0, np.uint64), np.zeros(1, np.int64))] * len(LONG)


def log10_probability(keys: np.ndarray, model: Model, followers: list[Followers] = NONE) -> np.ndarray:
    """Of each key's byte after the bytes before it; keys are sorted and distinct."""
    total = np.zeros(len(keys))
    weights = model.weights.astype(np.float32)
    for bit in _bits(keys, model.code, followers):
        x, gate = _inputs(bit, model)
        t = _mixture(x, gate, weights)
        low, share = _step(t)
        table = model.refined[bit.node]
        p = np.clip((_squash(t) + table[low] + (table[low + 1] - table[low]) * share) / 2, 1e-6, 1 - 1e-6)
        total[bit.at] += np.log(p if bit.bit else 1 - p)
    return total / np.log(10)


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = {held: np.zeros(256, np.int64) for held in (False, True)}
    for batch in batches:
        for held, own in counts.items():
            some = batch.filter(pc.equal(batch.column("held_out"), held))
            for _, piece in pieces(texts(some.column("text"))):
                own += np.bincount(LOWER[piece.data], minlength=256)
    for held, own in counts.items():
        yield pa.RecordBatch.from_arrays([pa.array([held] * 256), pa.array(np.arange(256)), pa.array(own)], ["held_out", "byte", "n"])


#: How a longer context and the byte after it are kept: five bytes, the nearest foremost, and that byte; four are marked.
_FOUR = np.uint64(1 << 56)
_FIVE_BYTES = np.uint64((1 << 40) - 1)


def _deltas(keys: np.ndarray) -> bytes:
    """Ordered keys by their differences, which are small, deflated."""
    return zlib.compress(np.diff(keys, prepend=np.uint64(0)).tobytes(), 1)


def _keys(data: pa.Scalar) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data.as_buffer()), np.uint64), dtype=np.uint64)


def _deflated(n: np.ndarray) -> bytes:
    return zlib.compress(n.astype(np.int64).tobytes(), 1)


def _numbers(data: pa.Scalar) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data.as_buffer()), np.int64)


def _bucket(four: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(four) % np.uint64(buckets)).astype(np.int64)


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its places in order)."""
    turn = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(bucket[turn]) > 0, [True]])) if len(turn) else []
    for a, b in zip(edges[:-1], edges[1:], strict=False):
        yield int(bucket[turn[a]]), turn[a:b]


#: Counts of slots (``long`` false: a block of a table) and of longer contexts (a bucket).
SUMS, TABLES = "long boolean, block bigint, seen binary, ones binary", "block bigint, logit binary, gate binary"


def _row(*values) -> pa.RecordBatch:
    names = [f.split()[0] for f in SUMS.split(", ")]
    types = (pa.bool_(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)


def _count_bits(code: Code, buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, ones = np.zeros(BASES[-1], np.int32), np.zeros(BASES[-1], np.int32)

        def handed(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            slots = [([], []) for _ in SHORT]
            weights = [([], []) for _ in SHORT]
            for bit in _bits(keys, code, []):
                for k, own in enumerate(bit.slots):
                    slots[k][bit.bit].append(own)
                    weights[k][bit.bit].append(np.add.reduceat(n[bit.at], np.cumsum(bit.repeats[k]) - bit.repeats[k]))
            for k, base in enumerate(BASES[:-1]):
                for value in (0, 1):
                    if slots[k][value]:
                        new = np.bincount(np.concatenate(slots[k][value]), np.concatenate(weights[k][value]), 1 << SLOTS[k]).astype(np.int32)
                        seen[base : base + len(new)] += new
                        if value:
                            ones[base : base + len(new)] += new
            after, n = summed((keys & _FIVE_BYTES) << np.uint64(8) | keys >> np.uint64(8 * SPAN), n)
            for bucket, at in _dealt(_bucket(after >> np.uint64(16), buckets)):
                yield _row(True, bucket, _deltas(after[at]), _deflated(n[at]))

        parts, held = [], 0
        for batch in batches:
            for _, piece in pieces(texts(batch.column("text")), MODEL_PIECE):
                parts.append(counted(keys_of(*stream(piece))))
                held += len(parts[-1][0])
                if held > HELD:
                    parts = [_together(parts)]
                    held = len(parts[0][0])
                    if 2 * held > HELD:
                        yield from handed(*parts[0])
                        parts, held = [], 0
        if parts:
            yield from handed(*_together(parts))
        for k in np.flatnonzero(seen.reshape(-1, BLOCK).any(axis=1)):
            at = slice(k * BLOCK, (k + 1) * BLOCK)
            yield _row(False, k, seen[at].tobytes(), ones[at].tobytes())

    return count


#: Tasks that the sums of all blocks go to, a few megabytes each.
TABLE_PARTS = 64


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block, in sums of 64 bits, deflated, and for each bucket of contexts; rows come sorted by both."""
    at, parts, held = None, [], 0

    def done():
        first, second = _together(parts) if at[0] else parts[0]
        return _row(*at, _deltas(first) if at[0] else _deflated(first), _deflated(second))

    for batch in batches:
        for long, k, a, b in zip(*batch.columns, strict=True):
            if at != (long.as_py(), k.as_py()):
                if parts:
                    yield done()
                at, parts, held = (long.as_py(), k.as_py()), [], 0
            if at[0]:
                parts.append((_keys(a), _numbers(b)))
                held += len(parts[-1][0])
                if held > 2 * HELD:
                    parts = [_together(parts)]
                    held = len(parts[0][0]) // 2
            else:
                new = [np.frombuffer(x.as_buffer(), np.int32) for x in (a, b)]
                parts = [tuple(x + y for x, y in zip(parts[0], new, strict=True)) if parts else tuple(x.astype(np.int64) for x in new)]
    if parts:
        yield done()


def _tables_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the tables hold of sums; rows come sorted by block."""
    block, seen, ones = None, None, None

    def done():
        pair = [x.tobytes() for x in _bits_table(seen, ones, block * BLOCK)]
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *(pa.array([x]) for x in pair)], [f.split()[0] for f in TABLES.split(", ")])

    for batch in batches:
        for k, a, b in zip(*batch.columns, strict=True):
            k = k.as_py()
            if k != block:
                if block is not None:
                    yield done()
                block, seen, ones = k, np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)
            seen += _numbers(a)
            ones += _numbers(b)
    if block is not None:
        yield done()


def _counted_blocks(rows: DataFrame, code: Code, buckets: int) -> DataFrame:
    blocks = rows.select("text").mapInArrow(_count_bits(code, buckets), SUMS)
    return written(blocks.repartition("long", "block").sortWithinPartitions("long", "block").mapInArrow(_add_up, SUMS), "blocks")


def _tables(sums: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(logits, gates) of all slots."""
    logit, gate = np.zeros(BASES[-1], np.int8), np.zeros(BASES[-1], np.uint8)
    blocks = sums.where("not long").select("block", "seen", "ones")
    for row in blocks.repartition(TABLE_PARTS, "block").sortWithinPartitions("block").mapInArrow(_tables_of, TABLES).toLocalIterator():
        at = slice(row["block"] * BLOCK, (row["block"] + 1) * BLOCK)
        logit[at], gate[at] = np.frombuffer(row["logit"], np.int8), np.frombuffer(row["gate"], np.uint8)
    return logit, gate


def _contexts(sums: DataFrame) -> DataFrame:
    return sums.where("long").select(F.col("block").alias("bucket"), F.col("seen").alias("keys"), F.col("ones").alias("counts"))


def _wanted(buckets: int):
    """The distinct contexts of five bytes of a chunk, by bucket."""

    def wanted(table: pa.Table) -> pa.Table:
        parts = [distinct(keys_of(*stream(piece)) & _FIVE_BYTES) for _, piece in pieces(texts(table.column("text")), MODEL_PIECE)]
        five = distinct(np.concatenate([np.zeros(0, np.uint64), *parts]))
        rows = [(bucket, _deltas(five[at])) for bucket, at in _dealt(_bucket(five >> np.uint64(8), buckets))]
        chunk = table.column("chunk")[0].as_py()
        return pa.table(
            [pa.array([b for b, _ in rows], pa.int64()), pa.array([chunk] * len(rows), pa.int64()), pa.array([k for _, k in rows], pa.binary())],
            ["bucket", "chunk", "keys"],
        )

    return wanted


def _ranges(keys: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Places of all keys of the contexts."""
    low, high = (np.searchsorted(keys, (contexts << np.uint64(8)) + np.uint64(leaf)) for leaf in (0, 256))
    n = high - low
    return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk, the bytes after its contexts of five bytes and of four. Rows come sorted: a bucket's counts, then its chunks."""
    bucket, parts, five, four = None, [], None, None
    for batch in batches:
        for b, chunk, keys, counts in zip(*batch.columns, strict=True):
            if b.as_py() != bucket:
                bucket, parts, five = b.as_py(), [], None
            if not chunk.is_valid:
                parts.append((_keys(keys), _numbers(counts)))
                continue
            if not parts:
                continue
            if five is None:
                five = _together(parts)
                four = summed(five[0] >> np.uint64(16) << np.uint64(8) | five[0] & np.uint64(255), five[1])
            own = _keys(keys)
            a, z = _ranges(five[0], own), _ranges(four[0], distinct(own >> np.uint64(8)))
            found, n = np.concatenate([five[0][a], four[0][z] | _FOUR]), np.concatenate([five[1][a], four[1][z]])
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array([chunk.as_py()], pa.int64()), pa.array([_deltas(found)]), pa.array([_deflated(n)])], ["chunk", "keys", "counts"])


def _followers_of(dealt: DataFrame, contexts: DataFrame, buckets: int) -> DataFrame:
    """(chunk, keys, counts) of what follows the contexts of each chunk of ``dealt``."""
    wanted = dealt.groupBy("chunk").applyInArrow(_wanted(buckets), "bucket bigint, chunk bigint, keys binary")
    known = contexts.select("bucket", F.lit(None).cast("bigint").alias("chunk"), "keys", "counts")
    both = known.unionByName(wanted.withColumn("counts", F.lit(None).cast("binary")))
    return both.repartition("bucket").sortWithinPartitions("bucket", F.asc_nulls_first("chunk")).mapInArrow(_looked_up, "chunk bigint, keys binary, counts binary")


def _gathered(rows: pa.Table, code: Code) -> list[Followers]:
    """The followers of a chunk, by leaf, for each of LONG."""
    keys = np.concatenate([np.zeros(0, np.uint64), *(_keys(k) for k in rows.column("keys"))])
    n = np.concatenate([np.zeros(0, np.int64), *(_numbers(c) for c in rows.column("counts"))])
    keys = keys & ~np.uint64(255) | code.leaf.astype(np.uint64)[(keys & np.uint64(255)).astype(np.int64)]
    turn = np.argsort(keys)
    keys, n = keys[turn], n[turn]
    at = int(np.searchsorted(keys, _FOUR))
    return [Followers(k, np.concatenate([[0], np.cumsum(c)])) for k, c in ((keys[at:] ^ _FOUR, n[at:]), (keys[:at], n[:at]))]


def _learn_mixing(sent):
    def learn(docs: pa.Table, rows: pa.Table) -> pa.Table:
        model = sent.value
        followers = _gathered(rows, model.code)
        weights, scale, bits = model.weights.copy(), np.full(model.weights.shape, 1e-3), np.zeros(GATES)
        seen, ones = np.zeros((255, STEPS)), np.zeros((255, STEPS))
        for _, piece in pieces(texts(docs.column("text")), MIX_PIECE):
            keys, n = counted(keys_of(*stream(piece)))
            for bit in _bits(keys, model.code, followers):
                x, gate = _inputs(bit, model)
                t, own = _mixture(x, gate, weights), n[bit.at]
                low, share = _step(t)
                new = np.bincount(low, (1 - share) * own, STEPS) + np.bincount(low + 1, share * own, STEPS)
                seen[bit.node] += new
                if bit.bit:
                    ones[bit.node] += new
                error = (bit.bit - _squash(t)) * own
                gradient = np.stack([np.bincount(gate, error * v, GATES) for v in x], axis=1)
                scale += gradient**2
                weights += RATE * gradient / np.sqrt(scale)
                bits += np.bincount(gate, own, GATES)
        number = np.arange(weights.size + seen.size)
        own = np.concatenate([(weights * bits[:, None]).ravel(), ones.ravel()])
        of = np.concatenate([np.repeat(bits, len(ORDERS)), seen.ravel()])
        return pa.table([pa.array(number), pa.array(own), pa.array(of)], ["number", "own", "of"])

    return learn


def fit(train: DataFrame, aside: DataFrame, byte_counts: np.ndarray) -> Model:
    """Weights and refining table from ``aside`` and what ``train`` predicts there, then predictors from both; both have a column text."""
    spark = train.sparkSession
    code = huffman(byte_counts)
    buckets = buckets_of(byte_counts)
    own = _counted_blocks(train, code, buckets)
    middle = _squash(np.linspace(-LIMIT, LIMIT, STEPS))
    model = Model(code, *_tables(own), np.full((GATES, len(ORDERS)), START), np.tile(middle, (255, 1)))
    sent = spark.sparkContext.broadcast(model)
    chunks = max(1, -(-int(byte_counts.sum()) // CHUNK_BYTES))
    dealt = aside.select(F.pmod(F.xxhash64(*aside.columns), F.lit(chunks)).alias("chunk"), "text")
    followers = _followers_of(dealt, _contexts(own), buckets)
    learned = dealt.groupBy("chunk").cogroup(followers.groupBy("chunk")).applyInArrow(_learn_mixing(sent), "number bigint, own double, of double")
    w = model.weights.size
    share, of = np.zeros(w + 255 * STEPS), np.zeros(w + 255 * STEPS)
    for row in learned.groupBy("number").agg(F.sum("own").alias("own"), F.sum("of").alias("of")).collect():
        share[row["number"]], of[row["number"]] = row["own"], row["of"]
    sent.unpersist()
    weights = np.where(of[:w] > 0, share[:w] / np.maximum(of[:w], 1e-9), START).reshape(model.weights.shape)
    refined = (share[w:].reshape(255, STEPS) + 2 * middle) / (of[w:].reshape(255, STEPS) + 2)
    sums = own.unionByName(_counted_blocks(aside, code, buckets))
    logit, gate = _tables(sums)
    return Model(code, logit, gate, weights, refined, _contexts(sums))


def buckets_of(byte_counts: np.ndarray) -> int:
    return max(1, -(-int(byte_counts.sum()) // BUCKET_BYTES))


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts, ends = [], len(batch)
        for _, piece in pieces(texts(batch.column("text"))):
            parts.append(tokens(piece)[0])
        key, n = counted(np.concatenate([np.zeros(0, np.uint64), *parts]))
        key, n = np.append(key, END_TOKEN), np.append(n, ends)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["token", "n"])


def _needed(table: pa.Table) -> pa.Table:
    """The distinct tokens of a chunk."""
    parts = [distinct(tokens(piece)[0]) for _, piece in pieces(texts(table.column("text")))]
    key = distinct(np.concatenate([np.array([END_TOKEN]), *parts]))
    chunk = table.column("chunk")[0].as_py()
    return pa.table({"chunk": pa.array(np.full(len(key), chunk, np.int64)), "token": pa.array(key.view(np.int64))})


SCORED = "doc_id {}, held_out boolean, n_tokens bigint, n_known bigint, n_bytes bigint, logs double, score double"


def _score_chunk(sent):
    def score(docs: pa.Table, counts: pa.Table) -> pa.Table:
        model = sent.value
        of_token = pc.is_valid(counts.column("token"))
        followers = _gathered(counts.filter(pc.invert(of_token)), model.code)
        counts = counts.filter(of_token)
        key = counts.column("token").to_numpy().view(np.uint64)
        order = np.argsort(key)
        key, count = key[order], counts.column("n").to_numpy()[order]
        n = docs.num_rows
        n_tokens, n_known, n_bytes, logs, scores = *(np.zeros(n, np.int64) for _ in range(3)), np.zeros(n), np.zeros(n)
        end = count[np.searchsorted(key, END_TOKEN)] if n else 0
        known, value = np.zeros(0, np.uint64), np.zeros(0)
        for row, piece in pieces(texts(docs.column("text")), MODEL_PIECE):
            h, first = tokens(piece)
            c = count[np.searchsorted(key, h)]
            sums = lambda x, at: np.diff(np.concatenate([[0], np.cumsum(x)])[at])  # noqa: B023, E731
            m = len(first) - 1
            at = slice(row, row + m)
            n_tokens[at] = np.diff(first) + 1
            n_known[at] = sums(c > 0, first) + (end > 0)
            of_word = np.log10(c + 0.1)
            logs[at] = [of_word[a:b].sum() for a, b in zip(first[:-1], first[1:], strict=True)] + np.log10(end + 0.1)
            out, begin, length = stream(piece)
            keys, number = places(out, begin, length)
            n_bytes[at] = length
            # Most keys of a piece came in the pieces before.
            own = np.searchsorted(known, keys)
            new = np.append(known, ~np.uint64(0))[own] != keys
            p = np.append(value, 0.0)[own]
            p[new] = log10_probability(keys[new], model, followers)
            if len(known) + new.sum() > HELD:
                known, value = keys, p
            else:
                known, value = np.insert(known, own[new], keys[new]), np.insert(value, own[new], p[new])
            scores[at] = np.add.reduceat(p[number], np.cumsum(length) - length)
        names = [f.split()[0] for f in SCORED.split(", ")]
        return pa.table([docs.column("doc_id"), docs.column("held_out"), *map(pa.array, (n_tokens, n_known, n_bytes, logs, scores))], names)

    return score


def score(docs: DataFrame, held_out, aside) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) of every row; bytes with the end sign.

    ``held_out`` and ``aside`` are conditions on columns of ``docs``: rows that teach nothing, and those of the others
    that fit the mixture before the predictors learn them too. Counts of bytes and tokens are over both.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), F.coalesce(aside, F.lit(False)).alias("aside"), "text")
    train = rows.where("not held_out")
    if not train.where("aside").limit(1).count():
        train = train.withColumn("aside", F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)) == 0)
    byte_counts, n_bytes = np.zeros(256, np.int64), 0
    for row in rows.select("held_out", "text").mapInArrow(_bytes_of, "held_out boolean, byte bigint, n bigint").groupBy("held_out", "byte").agg(F.sum("n").alias("n")).collect():
        n_bytes += row["n"]
        if not row["held_out"]:
            byte_counts[row["byte"]] = row["n"]
    totals = written(train.select("text").mapInArrow(_token_counts, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")), "tokens")
    known = totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    model = fit(train.where("not aside"), train.where("aside"), byte_counts)
    sent = spark.sparkContext.broadcast(model._replace(contexts=None))
    chunks = max(1, -(-n_bytes // CHUNK_BYTES))
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))
    dealt = rows.select(chunk.alias("chunk"), "doc_id", "held_out", "text")
    needed = dealt.groupBy("chunk").applyInArrow(_needed, "chunk bigint, token bigint")
    counts = needed.join(totals, "token", "left").select("chunk", "token", F.coalesce("n", F.lit(0)).alias("n"))
    counts = counts.unionByName(_followers_of(dealt, model.contexts, buckets_of(byte_counts)), allowMissingColumns=True)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = dealt.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(_score_chunk(sent), SCORED.format(kind))
    base = float(np.log10(known["n"] + 0.1 * (known["v"] + 1)))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(known["n"]).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        "score",
        "n_bytes",
        (F.col("score") * F.lit(-float(np.log2(10))) / F.col("n_bytes")).alias("bits_per_byte"),
    )
