"""Chunk invariants, checked against a plain Python reading of the rule."""

import re

import pytest

from foliospark.operators import chunking

SIZE, OVERLAP, STEP = 1000, 200, 800


def words_of(n, length=7):
    return " ".join(("w%d" % i).ljust(length, "x") for i in range(n))


TEXTS = {
    "short": "x" * 100,
    "a little": "word " * 21,
    "one window": "y" * 1000,
    "two windows": words_of(126)[:1001],
    "edge 1800": words_of(300)[:1800],
    "edge 1801": words_of(300)[:1801],
    "long word": "a " + "z" * 2500 + " end of text",
    "long words": " ".join("q" * 450 for _ in range(12)),
    "blank": " " * 1500,
    "lines": "\n\n".join("line %d with some words" % i for i in range(400)),
    "accents": "é à ü ñ " * 700,
    "blocks": words_of(20000),
    "exact block": words_of(30000)[: chunking.WINDOWS_PER_BLOCK * STEP * 2],
    "leading": "   " + words_of(500),
}


def expected(text, mode):
    out = []
    last = max(0, -(-(len(text) - SIZE) // STEP))
    for i in range(last + 1):
        start, end = i * STEP, min(i * STEP + SIZE, len(text))
        if mode == "packed":
            if start and not (text[start - 1].isspace() and not text[start].isspace()):
                cut = re.match(r"\S*\s*", text[start:end]).end()
                start += cut if cut <= OVERLAP else 0
            if end < len(text) and not (not text[end].isspace() and text[end - 1].isspace()):
                cut = len(re.search(r"\S*\s*$", text[start:end]).group())
                end -= cut if cut <= OVERLAP else 0
        chunk = text[start:end]
        if len(chunk.strip(" ")) > 50:
            out.append((i, chunk))
    return out


@pytest.mark.parametrize("mode", ["stride", "packed"])
def test_chunks_match_the_rule(spark, mode):
    df = spark.createDataFrame(list(TEXTS.items()), "name string, content string")
    got = {}
    for r in chunking.chunk_texts(df, "content", mode).collect():
        got.setdefault(r["name"], []).append((r["chunk_index"], r["chunk_text"]))
    for name, text in TEXTS.items():
        assert sorted(got.get(name, [])) == expected(text, mode), name


def test_packed_chunks_cover_every_word(spark):
    df = spark.createDataFrame([(words_of(5000),)], "content string")
    chunks = [r["chunk_text"] for r in chunking.chunk_texts(df, "content").collect()]
    assert max(map(len, chunks)) <= SIZE
    whole = set(words_of(5000).split())
    seen = set(w for c in chunks for w in c.split())
    assert seen == whole


def test_unknown_mode(spark):
    df = spark.createDataFrame([("x",)], "content string")
    with pytest.raises(ValueError):
        chunking.chunk_texts(df, "content", "other")
