"""Small documents with all the odd cases, and brute-force versions."""

import random
import re

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, node string, text_key int, marks string"


def prose(seed: int, words: int, lang: str = "en") -> str:
    draw = random.Random(seed)
    parts = {"en": ["th", "er", "on", "an", "ing", "ed", "es", "ly"], "de": ["sch", "ung", "ein", "ver", "ö", "keit", "ß"], "fr": ["eau", "tion", "é", "ou", "elle", "ç"], "es": ["ción", "ado", "ñ", "os", "ll", "ue"]}[lang]
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) + draw.choice(["", "", "", ".", ","]) for _ in range(words))


def odd_texts() -> list[tuple]:
    """(doc_id, text) with nulls, empty and very long texts, ties, repeated rows and passages."""
    base, passage = prose(1, 120), prose(2, 40)
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (10, base), (11, " ".join(near)), (12, base), (12, base), (13, None), (14, ""), (15, "   \n\t "), (16, "one two"), (17, "One TWO"), (18, "one"),
        (None, base), (19, passage), (20, prose(3, 50) + " " + passage + " " + prose(4, 50)), (21, "é" * 70), (22, "éé" * 60), (23, "漢字 𝄞 \u0000 <s>"),
        (24, prose(5, 30_000)), (25, "x" * 50_000), (26, "x" * 49), (27, prose(6, 80, "de")), (28, prose(7, 80, "fr")), (29, "!!! ... 123"), (30, prose(8, 80, "es")),
    ]
    return rows


def frame(spark, rows):
    """Columns of documents, and others whose names operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", 1, 5, "n", 3, "m") for i, t in rows], SCHEMA)


def shingles(text: str | None, size: int = 5) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) >= size:
        return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def groups(rows: list[tuple]) -> dict[int, int]:
    """Smallest id of each component, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def repeats(rows: list[tuple], size: int = 50) -> list[tuple[bytes, int, int]]:
    """(kept, removed, spans) of each row; ``rows`` as (doc_id, text)."""
    first: dict[bytes, int] = {}
    number = lambda i: -(1 << 63) if i is None else i
    for i, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - size + 1):
            s = raw[p : p + size]
            first[s] = min(first.get(s, number(i)), number(i))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw) + 1)
        for p in range(len(raw) - size + 1):
            if first[raw[p : p + size]] < number(i):
                gone[p : p + size] = b"\1" * size
        spans = sum(1 for p in range(len(raw)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((bytes(b for b, g in zip(raw, gone) if not g), sum(gone), spans))
    return out


def words(text: str | None) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def hits(text: str | None, items: list[tuple], window: int = 10) -> tuple[set[int], set[str]]:
    """Hit words and items found, by looking at every place."""
    ws, places, found = words(text), set(), set()
    for item, t in items:
        its = words(t)
        size = min(window, len(its))
        grams = {tuple(its[k : k + size]) for k in range(len(its) - size + 1)} if its and item is not None else set()
        for p in range(len(ws) - size + 1):
            if grams and tuple(ws[p : p + size]) in grams:
                places |= set(range(p, p + size))
                found.add(str(item))
    return places, found
