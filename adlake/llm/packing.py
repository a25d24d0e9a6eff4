"""Packing by power-of-two decomposition: a document is split into pieces of binary lengths, each a sequence of its own.

A document of n tokens gives full sequences first, then one piece for each bit that is set in the rest, the longest
first. Pieces of one length make one bucket, whose sequences need neither padding nor a mask, since none crosses a
document. All of it happens in the row, so there is no shuffle; the bucket is a column to write by.

Cases: a null or empty text is its end token alone, one piece of length 1. Rows are packed one by one, repeated doc_ids
included. Columns other than those asked for are not read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adlake.llm.tokens import PreTokens

MAX_LENGTH = 4096
END_ID = 2
PIECES = "array<struct<start:bigint,length:int,ids:binary,doc_tokens:bigint>>"


def cut(n: int, most: int) -> list[int]:
    """Lengths of the pieces of n tokens; ``most`` is a power of two."""
    full, rest = divmod(n, most)
    return [most] * full + [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]


def _split(column: pa.Array, path: str, most: int, end_id: int) -> pa.Array:
    tokens, tail = PreTokens.of(path), np.uint32(end_id).tobytes()
    ends, starts, lengths, ids, totals = [0], [], [], [], []
    for text in column:
        packed = tokens.encode(text.as_py() or "") + tail
        at = 0
        for length in cut(len(packed) // 4, most):
            starts.append(at)
            lengths.append(length)
            ids.append(packed[4 * at : 4 * (at + length)])
            at += length
        totals += [at] * (len(starts) - ends[-1])
        ends.append(len(starts))
    rows = pa.StructArray.from_arrays(
        [pa.array(starts, pa.int64()), pa.array(lengths, pa.int32()), pa.array(ids, pa.binary()), pa.array(totals, pa.int64())],
        ["start", "length", "ids", "doc_tokens"],
    )
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)


def pack(docs: DataFrame, tokenizer: str, max_length: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset); ids are little-endian 32-bit numbers.

    Each piece fills a sequence of its own length, so ``offset`` is 0. ``sequence_id`` is unique, not gapless.
    """
    if max_length & (max_length - 1) or max_length < 1:
        raise ValueError("max_length must be a power of two")
    split = F.arrow_udf(_typed(partial(_split, path=tokenizer, most=max_length, end_id=end_id)), PIECES)
    return docs.select("doc_id", F.explode(split(F.col("text"))).alias("piece")).select(
        "doc_id",
        "piece.start",
        F.col("piece.length").cast("long").alias("length"),
        "piece.ids",
        "piece.doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(sequences: DataFrame, path: str) -> None:
    """One folder for each sequence length."""
    sequences.write.mode("overwrite").partitionBy("length").parquet(path)


def _typed(fn: partial):
    def split(column: pa.Array) -> pa.Array:
        return fn(column)

    return split
