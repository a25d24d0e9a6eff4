import random

import public_tokenizers
import pytest

WORDS = [a + b for a in ("ba", "ko", "ri", "tu", "sel", "mon") for b in ("", "la", "nd", "ti", "ver", "o")]


@pytest.fixture(scope="session")
def tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture
def prose(rng):
    """A text of n made-up words."""

    def write(n):
        return " ".join(rng.choice(WORDS) for _ in range(n))

    return write


@pytest.fixture
def messy(spark):
    """Documents with nulls, empty texts, ties, repeated rows, a very long text and columns that operators use themselves."""
    rows = [
        (1, "Plain words here", 1),
        (2, None, 2),
        (3, "", 3),
        (4, " \t\n ", None),
        (None, "No id at all", 5),
        (5, "Plain words here", 6),
        (5, "Plain words here", 6),
        (6, "tail " * 30_000, 7),
        (7, "É日本 <|endoftext|> \x00 x", 8),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_words int").selectExpr(
        "doc_id", "text", "n_words", "'a' as hits", "'b' as kept", "1 as component_id", "'c' as spans", "0 as h", "1 as chunk", "2 as n"
    )


@pytest.fixture
def nothing(messy):
    return messy.limit(0)
