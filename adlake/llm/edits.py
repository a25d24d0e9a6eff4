"""Edit-aware token counts: a tree over the segments of a document, whose sums follow the edits.

Token ids never reach over white space, so a text is cut at white space into segments of about ``SEGMENT`` characters, and
each segment's length and token count is a leaf. Inner nodes hold the sums of their two children, in one array: the root
is place 1, the children of k are 2k and 2k + 1. An edit is found by descending the lengths. Only the segments that it
touches, with the neighbour wherever it reaches a segment's edge, are encoded again; if their number stays, only the sums
on their paths change, else the leaves behind them move and the sums are added up anew, without encoding anything.

Trees are rows beside their documents, so building and editing are passes over rows, with no shuffle.

Cases: a null text is an empty one. Edits are (at, cut, put): at character ``at`` remove ``cut`` characters and put in
``put``; one after the other, each on the outcome of those before. A place beyond the end is the end, below 0 the start;
nulls are 0, 0 and nothing. Rows that repeat a doc_id are edited one by one. The caller's columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from adlake.llm.tokens import PreTokens

SEGMENT = 400
#: White space of ASCII; a segment begins after one.
_BLANKS = " \t\n\r\x0b\x0c"
TREE = "struct<chars:array<int>,tokens:array<int>>"
EDITED = f"struct<text:string,tree:{TREE},n_tokens_before:bigint,n_tokens:bigint,n_segments:int,n_encoded:int>"


def cut(text: str, size: int = SEGMENT) -> list[str]:
    """Segments of about ``size`` characters, each but the first beginning after white space."""
    out, at = [], 0
    while len(text) - at > size:
        stop = next((i + 1 for i in range(at + size - 1, len(text)) if text[i] in _BLANKS), len(text))
        out.append(text[at:stop])
        at = stop
    if at < len(text) or not out:
        out.append(text[at:])
    return out


def _sums(leaves: np.ndarray) -> np.ndarray:
    """The tree over the leaves; the second half of the array holds them, filled up with zeros."""
    size = 1 << max(len(leaves) - 1, 0).bit_length()
    tree = np.zeros(2 * size, np.int64)
    tree[size : size + len(leaves)] = leaves
    while size > 1:
        half = size // 2
        tree[half:size] = tree[size : 2 * size : 2] + tree[size + 1 : 2 * size : 2]
        size = half
    return tree


class Tree(NamedTuple):
    chars: np.ndarray
    tokens: np.ndarray

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    def leaf(self, place: int) -> tuple[int, int]:
        """(number of the leaf that holds a character, where the leaf begins); the last one for the end of the text."""
        node, size, start = 1, len(self.chars) // 2, 0
        while node < size:
            node *= 2
            if place >= start + self.chars[node] and self.chars[node + 1]:
                start += int(self.chars[node])
                node += 1
        return node - size, start

    def leaves(self, of: np.ndarray) -> np.ndarray:
        size = len(self.chars) // 2
        return of[size : size + self.n_leaves]

    @property
    def n_leaves(self) -> int:
        """Empty leaves stand at the end, but an empty text has one."""
        size = len(self.chars) // 2
        return max(int(np.count_nonzero(self.chars[size:])), 1)


def build(text: str, tokens: PreTokens) -> Tree:
    parts = cut(text)
    return Tree(_sums(np.array([len(p) for p in parts])), _sums(np.array([tokens.count(p) for p in parts])))


def edit(text: str, tree: Tree, at: int, gone: int, put: str, tokens: PreTokens) -> tuple[str, Tree, int]:
    """(text, tree, how many segments were encoded) after one edit."""
    at = min(max(at, 0), len(text))
    end = min(at + max(gone, 0), len(text))
    if at == end and not put:
        return text, tree, 0
    size = len(tree.chars) // 2
    first, start = tree.leaf(at)
    if first and at == start:  # what is put in may go on the segment before
        first -= 1
        start -= int(tree.chars[size + first])
    last, from_ = tree.leaf(end)
    stop = from_ + int(tree.chars[size + last])
    new = text[:at] + put + text[end:]
    region = new[start : stop + len(put) - (end - at)]
    parts = cut(region)
    chars, counts = np.array([len(p) for p in parts]), np.array([tokens.count(p) for p in parts])
    if len(parts) == last - first + 1 and chars.all():
        for tree_, values in ((tree.chars, chars), (tree.tokens, counts)):
            tree_[size + first : size + last + 1] = values
            low, high = size + first, size + last
            while low > 1:
                low, high = low // 2, high // 2
                tree_[low : high + 1] = tree_[2 * low : 2 * high + 2 : 2] + tree_[2 * low + 1 : 2 * high + 2 : 2]
        return new, tree, len(parts)
    if not region:  # all of its segments are gone
        chars, counts = chars[:0], counts[:0]
    both = [np.concatenate([old[:first], values, old[last + 1 :]]) for old, values in ((tree.leaves(tree.chars), chars), (tree.leaves(tree.tokens), counts))]
    return new, Tree(*(_sums(x if len(x) else np.zeros(1, np.int64)) for x in both)), len(parts)


def _arrow(trees: list[Tree]) -> pa.Array:
    ends = pa.array(np.cumsum([0, *(len(t.chars) for t in trees)]).astype(np.int32))
    flat = lambda k: pa.array(np.concatenate([np.zeros(0, np.int64), *(t[k] for t in trees)]).astype(np.int32))
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, flat(0)), pa.ListArray.from_arrays(ends, flat(1))], ["chars", "tokens"])


def _ends(lists: pa.ListArray) -> np.ndarray:
    """Where the rows of a list column begin among its values, and where the last one ends; a null row holds none."""
    return lists.offsets.to_numpy()


def _trees(column: pa.StructArray) -> list[Tree]:
    both = [column.field(k) for k in ("chars", "tokens")]
    cuts = [_ends(x) for x in both]
    flat = [x.values.to_numpy().astype(np.int64) for x in both]
    return [Tree(*(f[c[row] : c[row + 1]] for f, c in zip(flat, cuts, strict=True))) for row in range(len(column))]


def trees(text: Column, tokenizer: str) -> Column:
    """The tree of each text: ``tokens[1]`` is its token count."""

    @F.arrow_udf(TREE)
    def built(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = PreTokens.of(tokenizer)
        for column in batches:
            yield _arrow([build(t.as_py() or "", tokens) for t in column])

    return built(text)


def edited(text: Column, tree: Column | None, edits: Column, tokenizer: str) -> Column:
    """Text, tree and counts after the edits, an array<struct<at:int,cut:int,put:string>>.

    Without a tree that was kept, the text's own is built first, in the same pass.
    """

    @F.arrow_udf(EDITED)
    def applied(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        tokens = PreTokens.of(tokenizer)
        for texts, *kept, lists in batches:
            old = _trees(kept[0]) if kept else [None] * len(texts)
            out_texts, out_trees, n_encoded, before = [], [], [], []
            ends, (at, gone, put) = _ends(lists), (lists.values.field(k).to_pylist() for k in ("at", "cut", "put"))
            for row, (t, o) in enumerate(zip(texts.to_pylist(), old, strict=True)):
                new, n = t or "", 0
                now = build(new, tokens) if o is None else o
                before.append(now.n_tokens)
                for e in range(ends[row], ends[row + 1]):
                    new, now, more = edit(new, now, at[e] or 0, gone[e] or 0, put[e] or "", tokens)
                    n += more
                out_texts.append(new)
                out_trees.append(now)
                n_encoded.append(n)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(out_texts, pa.string()),
                    _arrow(out_trees),
                    pa.array(before, pa.int64()),
                    pa.array([x.n_tokens for x in out_trees], pa.int64()),
                    pa.array([x.n_leaves for x in out_trees], pa.int32()),
                    pa.array(n_encoded, pa.int32()),
                ],
                ["text", "tree", "n_tokens_before", "n_tokens", "n_segments", "n_encoded"],
            )

    return applied(text, edits) if tree is None else applied(text, tree, edits)
