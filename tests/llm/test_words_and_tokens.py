import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adlake.llm import edits, queries, shared
from adlake.llm.packing import END_ID, cut, pack
from adlake.llm.tokens import PreTokens
from adlake.llm.words import LETTERS, LOWER, NOT_BLANK, Texts, hashes, pieces, texts, words

SIGNS = list("abcXYZ09 \t\n\r\x0b\x0c\x1c.,'\"-_`{|É日") + [" ", "the ", "supercalifragilistic"]


def random_texts(n=300, seed=1):
    rng = random.Random(seed)
    return [None if rng.random() < 0.05 else "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("limit", [1, 50, 1 << 20])
@pytest.mark.parametrize("kind", ["blank", "letters"])
def test_words_are_those_of_the_pattern(limit, kind):
    source = random_texts()
    pattern = "[^\x20\x09-\x0d]+" if kind == "blank" else "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got, seen = [], {}
    for _, piece in pieces(texts(pa.array(source)), limit):
        data = piece.data if kind == "blank" else LOWER[piece.data]
        found = words(Texts(data, piece.offsets), NOT_BLANK if kind == "blank" else LETTERS)
        of = [data[a:b].tobytes().decode() for a, b in zip(found.start, found.end, strict=True)]
        got += [of[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
        for word, h in zip(of, hashes(data, found.start, found.end), strict=True):
            assert seen.setdefault(word, h) == h
    want = [re.findall(pattern, (t or "") if kind == "blank" else (t or "").translate(fold)) for t in source]
    assert got == want
    assert len(set(seen.values())) == len(seen)


def test_sliced_and_empty_columns():
    column = pa.array(["a b", None, "c", "d e f"]).slice(1, 3)
    piece = texts(column)
    assert [piece.data[a:b].tobytes() for a, b in zip(piece.offsets[:-1], piece.offsets[1:], strict=True)] == [b"", b"c", b"d e f"]
    assert len(texts(pa.array([], pa.string())).offsets) == 1


def test_ids_are_those_of_the_tokenizer(tokenizer):
    whole = Tokenizer.from_file(tokenizer)
    whole.encode_special_tokens = True
    mine = PreTokens.of(tokenizer)
    rng = random.Random(2)
    signs = [chr(i) for i in range(0x300)] + list("'strevmld 'S'LL İΣς́") + ["'re", "<|endoftext|>", "日本"]
    for _ in range(4_000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 16)))
        assert mine.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_a_full_cache_keeps_giving_the_same_ids(tokenizer, monkeypatch):
    mine = PreTokens(tokenizer)
    want = [mine.encode(f"word{i} and more") for i in range(50)]
    monkeypatch.setattr("adlake.llm.tokens.KEPT", 4)
    assert [mine.encode(f"word{i} and more") for i in range(50)] == want


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 63, 64, 65, 1000])
def test_cut_is_the_binary_form(n):
    lengths = cut(n, 64)
    assert sum(lengths) == n and all(x & (x - 1) == 0 and x <= 64 for x in lengths)
    assert lengths == sorted(lengths, reverse=True) and sum(x < 64 for x in lengths) == bin(n % 64).count("1")


def test_packing_gives_every_id_once(messy, tokenizer):
    rows = pack(messy, tokenizer, max_length=16).orderBy("sequence_id").collect()
    whole = Tokenizer.from_file(tokenizer)
    whole.encode_special_tokens = True
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.offset == 0 for r in rows)
    got, at = [], None
    for r in rows:
        if r.start == 0:
            at = []
            got.append((r.doc_id, r.doc_tokens, at))
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and r.start == len(at)
        at += ids
    want = [whole.encode(r.text or "", add_special_tokens=False).ids + [END_ID] for r in messy.collect()]
    assert sorted((str(d), n, ids) for d, n, ids in got) == sorted((str(r.doc_id), len(ids), ids) for r, ids in zip(messy.collect(), want, strict=True))


def test_packing_needs_a_power_of_two_and_takes_nothing(nothing, tokenizer):
    assert pack(nothing, tokenizer).count() == 0
    with pytest.raises(ValueError):
        pack(nothing, tokenizer, max_length=100)


def test_edits_count_as_a_whole_count(tokenizer, monkeypatch):
    monkeypatch.setattr(edits.cut, "__defaults__", (20,))
    tokens, rng = PreTokens.of(tokenizer), random.Random(3)
    signs = ["the", "of", "don't", "x1y", "naïve", "日本", "A.B", "  ", "\n", "İx", "\xa0", " "]
    for _ in range(250):
        text = "".join(rng.choice(signs) + rng.choice([" ", ""]) for _ in range(rng.randint(0, 60)))
        tree = edits.build(text, tokens)
        for _ in range(6):
            at, gone = rng.randint(-2, len(text) + 3), rng.choice([0, 1, 5, 30, 200])
            put = rng.choice(["", " ", "foo", "a b c " * rng.randint(1, 15), "́"])
            stop = min(max(at, 0), len(text))
            want = text[:stop] + put + text[stop + gone :]
            text, tree, _ = edits.edit(text, tree, at, gone, put, tokens)
            assert text == want and tree.chars[1] == len(text)
            assert tree.n_tokens == len(tokens.whole.encode(text, add_special_tokens=False).ids)


def test_few_segments_are_encoded_again(tokenizer):
    tokens = PreTokens.of(tokenizer)
    text = "some words of a long text " * 2_000
    tree = edits.build(text, tokens)
    _, after, encoded = edits.edit(text, tree, 20_003, 4, "other", tokens)
    assert encoded <= 2 and len(tree.chars) > 128


def test_edits_of_messy_rows(spark, messy, nothing, tokenizer):
    from pyspark.sql import functions as F

    changes = F.array(F.struct(F.lit(2).alias("at"), F.lit(None).cast("int").alias("cut"), F.lit("X y").alias("put")))
    for docs in (messy, nothing):
        rows = docs.withColumn("tree", edits.trees(F.col("text"), tokenizer))
        out = rows.select("text", edits.edited(F.col("text"), F.col("tree"), changes, tokenizer).alias("e")).collect()
        assert len(out) == docs.count()
        for r in out:
            text = r.text or ""
            assert r.e.text == text[:2] + "X y" + text[2:]
            assert r.e.n_tokens == PreTokens.of(tokenizer).count(r.e.text)
        at_once = rows.select("text", edits.edited(F.col("text"), None, changes, tokenizer).alias("e")).collect()
        assert sorted(map(str, at_once)) == sorted(map(str, out))
    none = messy.withColumn("tree", edits.trees(F.col("text"), tokenizer))
    kind = F.lit(None).cast("array<struct<at:int,cut:int,put:string>>")
    assert all(r.e.n_encoded == 0 and r.e.text == (r.text or "") for r in none.select("text", edits.edited(F.col("text"), F.col("tree"), kind, tokenizer).alias("e")).collect())


def test_edits_of_a_query_grow_with_the_text(spark, messy, tokenizer, tmp_path, monkeypatch):
    """The query's result, through kept trees, is that of edits by hand and whole recounts."""
    text = F.coalesce("text", F.lit(""))
    docs = messy.select("doc_id", text.alias("text"), queries.sample_edits(text, F.col("doc_id"), F.char_length(text)).alias("todo")).collect()
    assert len({len(r.todo) for r in docs}) > 1 and max(len(r.todo) for r in docs) > 20
    whole, want = PreTokens(tokenizer), []
    for r in docs:
        now = r.text
        for e in r.todo:
            now = now[: e["at"]] + e["put"] + now[e["at"] + e["cut"] :]
        want.append((str(r.doc_id), whole.count(r.text), whole.count(now), hashlib.sha256(now.encode()).hexdigest()))
    messy.write.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    monkeypatch.setattr(queries, "written", lambda df, name: (kept.append(name), shared.written(df, name))[1])
    got = queries.op5_edit_counts(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.tokens_before, r.tokens_after, r.text_sha256) for r in got) == sorted(want) and kept == ["trees"]
