"""License scan, tokenizer alignment and filter audit against brute force."""

import hashlib
import random
import re
import types
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from foliospark.llm import alignment, decontaminate, filter_audit, language_id, licenses, near_dups
from foliospark.llm.common import Scratch
from foliospark.llm.queries import QUERIES

from . import helpers

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def same(found, expected):
    assert Counter(map(tuple, found)) == Counter(expected)


def base_licenses(text):
    ws, places, labels = helpers.words(text), [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split(" ")
        at = [i for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_scan_base(spark):
    rows = helpers.odd_texts() + [
        (40, "MIT License, mit-license; the mit license. Apache  License"), (41, "cc by cc by cc by"), (42, "gnu general public"), (None, "CC BY-SA"), (40, "mit license"), (40, "mit license"),
        (43, helpers.prose(9, 20_000) + " mit license " + helpers.prose(10, 20_000) + " apache license"),
    ]
    found = licenses.scan(helpers.frame(spark, rows)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    same(found.collect(), [(i, *base_licenses(t)) for i, t in rows])


def test_license_scan_across_pieces(spark):
    """A phrase on the border between two pieces of a long text."""
    rows = [(i, " ".join(["w"] * (licenses.PIECE - i)) + " gnu general public license " + " ".join(["w"] * 10)) for i in range(6)]
    assert {tuple(r) for r in licenses.scan(helpers.frame(spark, rows)).select("doc_id", "n_base", "first_word").collect()} == {(i, 1, licenses.PIECE - i) for i in range(6)}


def test_license_notices(spark):
    """Words that are put in or left out stay within merged diagonals; the best of overlapping notices counts."""
    mit = next(t for t in licenses.NOTICES if t.startswith("permission is hereby granted free"))
    ws = mit.split(" ")
    rows = [
        (1, mit), (2, " ".join([*ws[:8], "really", *ws[8:]])), (3, " ".join([*ws[:9], *ws[11:]])), (4, " ".join(ws[:8])), (5, "licensed under the gnu general public license, version 3"),
        (6, " ".join(ws[:10]) + helpers.prose(1, 300) + " ".join(ws[10:])), (7, "Redistribution and use in source and binary forms are permitted, with or without modification"),
    ]
    found = {r["doc_id"]: r for r in licenses.scan(helpers.frame(spark, rows)).collect()}
    assert [found[i]["labels"] for i in (1, 2, 3, 4, 6)] == ["mit-notice", "mit-notice", "mit-notice", "", ""]
    assert found[5]["labels"] == "gpl,gpl-3.0" and found[5]["base_labels"] == "gpl"
    assert found[1]["score"] == 1.0 and 0.7 <= found[3]["score"] < 1.0 and found[4]["score"] == 0.0


def aligned(texts):
    """What ``align`` must give for each text, from whole texts and plain loops."""
    a_model, b_model = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_model.encode_special_tokens = True
    bytes_a, bytes_b = alignment._bytes_a(a_model), alignment._bytes_b(b_model)
    every, counts = [], Counter()
    for t in texts:
        a = a_model.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_model.encode(t) if t else []
        raw = (" " + t).encode() if t else b""
        if b"".join(bytes_a[i] for i in a) != raw or b"".join(bytes_b[i] for i in b) != raw:
            a = b = []
        ends_a, ends_b = set(), set()
        for ids, sizes, ends in ((a, bytes_a, ends_a), (b, bytes_b, ends_b)):
            at = 0
            for i in ids:
                at += len(sizes[i])
                ends.add(at)
        groups = {e: ([], []) for e in sorted(ends_a & ends_b)}
        for side, (ids, sizes) in enumerate(((a, bytes_a), (b, bytes_b))):
            at = 0
            for i in ids:
                at += len(sizes[i])
                groups[min(e for e in groups if e >= at)][side].append(i)
        links = [(x, y) for xs, ys in groups.values() for x in xs for y in ys]
        counts.update(set(links))
        every.append((len(a), len(b), groups, links))
    highest = Counter()
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    for n_a, n_b, groups, links in every:
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups.values())
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        yield n_a, n_b, len(groups), len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links), sha


def test_alignment(spark):
    rows = [(i, t if t is None else t[:4000]) for i, t in helpers.odd_texts()]
    rows += [(50, "a ▁ b"), (51, "<|endoftext|> <s> x</s>"), (52, "  two  blanks   and\ttabs \n"), (53, "it's it' s it 's"), (54, "x y"), (55, "x y"), (56, "ab12 34cd é œ Ω ω"), (None, None), (57, "\u0085 a b"), (58, "a" * 3000)]
    rows += [(100 + i, "one copy of many") for i in range(200)]
    found = alignment.align(helpers.frame(spark, rows), A, B).collect()
    same(found, [(i, *m) for (i, _), m in zip(rows, aligned([t for _, t in rows]))])


def test_alignment_of_blocks(spark):
    """The same with many small blocks, on the smallest table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    whole = QUERIES["op12_alignment"](spark, "/root/testdata/sf0.001").collect()
    same(whole, [(i, *m) for (i, _), m in zip(rows, aligned([t for _, t in rows]))])


def failed(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (len(ws) < 200, 100 * len(set(ws)) < 50 * len(ws), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text)))


def test_filter_audit(spark):
    rows = [(*r, "en" if n % 3 else None) for n, r in enumerate(helpers.odd_texts())]
    long = helpers.prose(1, 300)
    rows += [(100, long, "en"), (101, long, "de"), (102, long.upper(), ""), (103, long + " #", "en"), (104, "same word " * 150, "en"), (100, long, "de"), (None, long, "fr"), (None, long, "fr")]
    docs = spark.createDataFrame([(i, t, lang, 1, "n") for i, t, lang in rows], "doc_id long, text string, lang string, mask int, part string")
    labels = spark.createDataFrame([(100, 1, 0), (100, 0, 1), (10, 1, None), (103, None, 1), (None, 1, 1), (104, 0, 0)], "doc_id long, quality int, toxic int")
    good, toxic = {100, 10}, {100, 103}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    masks = [(i, lang or "", (*failed(t or ""), i is not None and first[t or ""] < i)) for i, t, lang in rows]
    expected, shapley = [], Counter()
    for part in {p for _, p, _ in masks}:
        for order in permutations(range(5)):
            left = [m for m in masks if m[1] == part]
            whole = left
            for step, f in enumerate(order, 1):
                gone = [m for m in left if m[2][f]]
                left = [m for m in left if not m[2][f]]
                fails = [m for m in whole if m[2][f]]
                unique = sum(sum(m[2]) == 1 for m in fails)
                count = lambda ids: sum(m[0] in ids for m in gone)  # noqa: E731, B023
                expected.append((part, "".join("ABCDE"[i] for i in order), step, len(left), len(gone), len(fails) - len(gone), unique, count(good), count(toxic)))
                shapley[part, "ABCDE"[f]] += len(gone)
    found = filter_audit.audit(filter_audit.flags(docs), labels).collect()
    same(found, [(*e, shapley[e[0], e[1][e[2] - 1]]) for e in expected])


def test_path_counts():
    forward, backward = filter_audit.path_counts(4)
    assert forward[0] == backward[15] == 1 and forward[15] == backward[0] == 24
    assert all(sum(forward[s] * backward[s] for s in range(16) if s.bit_count() == k) == 24 for k in range(5))


def test_empty_tables(spark):
    docs, labels = helpers.frame(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert licenses.scan(docs).collect() == alignment.align(docs, A, B).collect() == filter_audit.audit(filter_audit.flags(docs), labels).collect() == []


ANY = "doc_id long, text string, spans string, _set int, row string, key string"


def any_frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, "r", "k") for i, t in rows], ANY)


def test_one_of_each_with_repeated_ids_and_clashing_columns(spark):
    """No text goes but for a copy that stays, whatever its id; of repeated rows one stays."""
    a, b, c, d = (helpers.prose(700 + k, 60) for k in range(4))
    rows = [(1, a), (5, a), (5, b), (7, c), (7, c), (None, d), (None, d), (None, b), (9, None), (9, None), (8, "")]
    left = near_dups.one_of_each(any_frame(spark, rows)).collect()
    same([r[:2] for r in left], [(1, a), (5, b), (7, c), (None, d), (9, None), (9, None), (8, "")])
    found = near_dups.near_duplicates(any_frame(spark, rows)).select("doc_id", "component_id", "kept").collect()
    same(found, [(1, 1, True), (5, 1, False), (5, 5, True), (7, 7, True), (7, 7, True), (None, None, True), (None, None, True), (None, 5, False), (9, 9, True), (9, 9, True), (8, 8, True)])


def test_links_of_very_long_sets_at_the_limit(spark):
    """300,000 shingles lose some values when they are cut; a pair at the limit is linked, one below is not."""
    n = 300_000
    ws = [f"w{k}" for k in range(n + 4)]
    shared = 3 * n // 4
    near = " ".join([*ws[: shared + 4], *(f"x{k}" for k in range(shared, n))])
    assert len(helpers.shingles(near)) == n
    inside, outside = " ".join(ws[: shared + 4]), " ".join(ws[: shared + 3])
    rows = [(1, " ".join(ws)), (2, inside), (11, " ".join(w + "y" for w in ws)), (12, " ".join(w + "y" for w in outside.split(" ")))]
    found = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(helpers.frame(spark, rows)).collect()}
    assert found == {1: 1, 2: 1, 11: 11, 12: 12}


def test_hidden_pairs_of_long_sets(spark):
    """The block comparison allows for shingles that coincide when they are cut."""
    n = 200_000
    values = np.random.default_rng(1).integers(0, 1 << 62, n)
    a, b = values, values[: 3 * n // 4]
    sets = spark.createDataFrame([(1, a.tolist()), (2, b.tolist())], "node long, shingles array<long>")
    grouped = spark.createDataFrame([(0, 9, 1, 0.5, 1, True), (0, 9, 2, 0.5, 2, True)], "kind int, g long, x long, d double, x_in long, seeks boolean")
    with Scratch(spark) as scratch:
        assert {tuple(r) for r in near_dups._hidden(grouped, sets, 0.75, scratch).collect()} == {(1, 2)}


def test_decontamination_with_clashing_columns(spark):
    item = helpers.prose(5, 15)
    rows = [(1, helpers.prose(6, 50) + " " + item), (2, item), (3, helpers.prose(7, 50)), (None, None)]
    clean = decontaminate.remove(any_frame(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert clean.columns == ["doc_id", "text", "spans", "_set", "row", "key"]
    found = {r["doc_id"]: r for r in clean.collect()}
    assert found.keys() == {1, 3, None} and item not in found[1]["text"] and found[1]["spans"] == "s"


def test_parts_of_texts_are_found_without_a_search_in_each():
    """As by a pattern; each distinct part of a slice is looked up once, however often it occurs."""
    draw = random.Random(8)
    signs = [" ", " ", "a", "Z", "é", "Ö", "ß", "×", "÷", "ÿ", "À", "¿", "7", ".", "~", "!", "\x7f", "\n", "漢", "𝄞", "Ā", "\u00a0", "ă"]
    made = ["".join(draw.choice(signs) for _ in range(draw.randint(1, 12))) for _ in range(20_000)] + [" ", "  ", "a b", " a b ", "é é", "a " * 9]
    cut = re.compile(r"(?<=[!-~À-ÖØ-öø-ÿ]) (?=[A-Za-zÀ-ÖØ-öø-ÿ])")
    parts, counts = alignment.cut_texts(pa.array(made)[3:])
    expected = [cut.split(t) for t in made[3:]]
    assert counts.tolist() == [len(p) for p in expected] and parts.to_pylist() == [p for ps in expected for p in ps]
    asked = []

    class Counting(alignment.Aligner):
        def codes(self, parts):
            asked.append(len(parts))
            return super().codes(parts)

    class Rows:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    batch = pa.RecordBatch.from_arrays([pa.array(["one two three " * 500] * 4), pa.array([b"k"] * 4, pa.binary()), pa.array([1] * 4), pa.array([1] * 4)], ["text", "text_key", "rows", "salts"])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(alignment, "Aligner", Counting)
        patch.setattr(alignment.TaskContext, "get", staticmethod(lambda: types.SimpleNamespace(partitionId=lambda: 0)))
        out = list(alignment.blocks(Rows(), A, B)(iter([batch])))
    assert sum(asked) == 4 and out[0].column("n_a").to_pylist() == [out[0].column("n_a")[0].as_py()] * 4


def test_stored_tables_are_followed_by_a_collection(spark):
    """Broadcasts, shuffles and generated code of a step are not left to pile up in the driver until the block ends."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    with Scratch(spark) as scratch:
        before = full()
        for n in (1, 2):
            assert scratch.stored(spark.range(n), "collected").count() == n
        assert full() >= before + 2


def test_driver_gives_back_what_learning_took(spark):
    rows = [*enumerate([helpers.prose(i, 30, lang) for i in range(5) for lang in ("en", "de", "fr")])]
    docs = helpers.frame(spark, rows).withColumn("lang", F.element_at(F.array(*map(F.lit, ("en", "de", "fr"))), (F.col("doc_id") % 3 + 1).cast("int")))
    given = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(language_id, "give_back", lambda: given.append(True))
        model = language_id.fit(docs, F.lit(True))
    assert given == [True] and model.langs == ["de", "en", "fr"]
