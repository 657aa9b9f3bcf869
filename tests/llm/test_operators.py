"""Operators against brute force on small tables with nulls, ties, repeats and clashing names."""

import hashlib
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from foliospark.llm import chat, decontaminate, language_id, near_dups, neighbours, pieces, quality, repeats, sharding, token_files
from foliospark.session import work_folder

from . import helpers

WORDS = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = []
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def odd(spark):
    return helpers.frame(spark, helpers.odd_texts()).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return helpers.frame(spark, [])


def library_ids(text):
    from tokenizers import Tokenizer

    if not LIBRARY:
        LIBRARY.append(Tokenizer.from_file(WORDS))
    return LIBRARY[0].encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, odd, encoding):
    path = work_folder(spark, "test-tokens")
    token_files.write_tokens(odd, path, WORDS, encoding=encoding, row_group_bytes=1 << 16)
    rows = sorted(helpers.odd_texts(), key=lambda r: (r[0] is not None, r[0]))
    found = sorted(token_files.digests(spark, path).collect(), key=lambda r: r["start"])
    start = 0
    for (doc, text), r in zip(rows, found, strict=True):
        ids = library_ids(text)
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (doc, start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert token_files.metadata(spark, path).count() == len(rows)
    part = token_files.read_tokens(spark, path, 16, 18)
    assert sorted(r["doc_id"] for r in part.collect()) == [16, 17, 18]
    plan = part.select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,16)" in plan and "ReadSchema: struct<doc_id:bigint,n_tokens:int>" in plan


def test_token_files_empty(spark, empty):
    path = work_folder(spark, "test-tokens")
    token_files.write_tokens(empty, path, WORDS)
    assert token_files.digests(spark, path).count() == 0


def test_word_ids_are_the_library_s():
    draw = random.Random(3)
    alphabets = ["ab'sdtre.,! \n", "é́eßÄΣσς.,'x ", "0²½Ⅷ.a, ", "<|endoftext|> ab.", "中文。,a  \t"]
    batch = ["".join(draw.choice(a) for _ in range(draw.randint(0, 25))) for a in alphabets for _ in range(300)]
    whole = pa.array([None, "not a part", *batch, None, "", "last."], pa.string())
    for column in (whole, whole.slice(2), whole.slice(3, 700), whole.slice(0, 1), whole.slice(0, 0)):
        ids, lengths = token_files.encode_texts(WORDS, 2, column)
        expected = [library_ids(t) for t in column.to_pylist()]
        assert ids.tolist() == [i for e in expected for i in e] and lengths.tolist() == list(map(len, expected))


def test_tokenizers_that_white_space_changes_are_refused():
    with pytest.raises(ValueError, match="white space"):
        token_files.word_coder(public_tokenizers.path("byte_bpe_50k.json"))


def test_near_duplicates(odd, empty):
    rows = helpers.odd_texts()
    expected = helpers.groups(rows)
    found = near_dups.near_duplicates(odd).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in rows)
    texts = dict(rows)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] == 10 and not r["kept"]
        else:
            assert r["component_id"] == expected[r["doc_id"]] and r["kept"] == (r["doc_id"] == expected[r["doc_id"]])
            assert r["n_shingles"] == len(helpers.shingles(texts[r["doc_id"]]))
    assert near_dups.near_duplicates(empty).count() == 0


def test_near_duplicates_of_a_family(spark):
    """Members differ from each other by more or less than the limit, and share buckets with strangers."""
    draw = random.Random(4)
    base = helpers.prose(20, 150).split(" ")
    rows = []
    for i in range(150):
        ws = list(base)
        for _ in range(draw.randint(0, 9)):
            ws[draw.randrange(len(ws))] = f"w{draw.randrange(10_000)}"
        rows.append((i, " ".join(ws)))
    rows += [(200 + i, " ".join(base[:60]) + " " + helpers.prose(300 + i, 60)) for i in range(60)]
    found = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(helpers.frame(spark, rows)).collect()}
    assert found == helpers.groups(rows)


def one_bucket(monkeypatch):
    """All documents share all bands, so the smallest id is the centre of every bucket, finer ones too."""
    real = near_dups.sketches
    bands = F.array(*[F.lit(k).cast("long") for k in range(near_dups.BANDS)])
    monkeypatch.setattr(near_dups, "sketches", lambda docs, size: real(docs, size).withColumn("bands", bands))


def test_near_copies_that_are_both_far_from_their_centre(spark, monkeypatch):
    """Pairs of near copies share 0.3 to 0.5 with the document of smaller id that all their buckets have."""
    one_bucket(monkeypatch)
    hub = helpers.prose(400, 100).split(" ")
    rows = [(1, " ".join(hub))]
    for i in range(12):
        ws = hub[: 50 + i] + helpers.prose(410 + i, 36).split(" ")
        rows += [(10 + 2 * i, " ".join(ws)), (11 + 2 * i, " ".join([*ws[:-6], *helpers.prose(430 + i, 6).split(" ")]))]
    sets = {i: helpers.shingles(t) for i, t in rows}
    assert all(0.3 < len(s & sets[1]) / len(s | sets[1]) < 0.5 for i, s in sets.items() if i > 1)
    expected = helpers.groups(rows)
    assert len(set(expected.values())) == 13
    assert {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(helpers.frame(spark, rows)).collect()} == expected


def test_near_copies_whose_centre_is_a_stranger(spark, monkeypatch):
    """Near copies that share hardly anything, or nothing, with the centre of all their buckets."""
    one_bucket(monkeypatch)
    hub = helpers.prose(500, 100).split(" ")
    rows = [(1, " ".join(hub))]
    for i in range(12):
        ws = hub[: 3 * i] + helpers.prose(510 + i, 100 - 3 * i).split(" ")
        rows += [(10 + 2 * i, " ".join(ws)), (11 + 2 * i, " ".join([*ws[:-6], *helpers.prose(530 + i, 6).split(" ")]))]
    sets = {i: helpers.shingles(t) for i, t in rows}
    apart = {i: 1 - len(s & sets[1]) / len(s | sets[1]) for i, s in sets.items()}
    assert all(d > 0.75 for i, d in apart.items() if i > 1)
    # The nearer one of a pair may lie within the limit, and the other beyond it.
    rows.append((50, " ".join(hub[:48] + helpers.prose(550, 52).split(" "))))
    rows.append((51, " ".join(hub[:42] + helpers.prose(551, 6).split(" ") + helpers.prose(550, 52).split(" "))))
    sets = {i: helpers.shingles(t) for i, t in rows}
    assert [1 - len(sets[i] & sets[1]) / len(sets[i] | sets[1]) > 0.75 for i in (50, 51)] == [False, True]
    expected = helpers.groups(rows)
    assert expected[51] == 50 and len(set(expected.values())) == 14
    assert {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(helpers.frame(spark, rows)).collect()} == expected


def test_densified_bins_agree_as_often_as_sets():
    values = near_dups.mix(np.arange(400, dtype=np.uint64))
    a, b = np.sort(values[:300]), np.sort(values[60:360])
    few = np.sort(values[:6]), np.sort(values[1:7])
    s = near_dups.signatures([a, b, *few], near_dups._orders())
    assert abs((s[0] == s[1]).mean() - 240 / 360) < 0.15 and (s != near_dups._EMPTY).all()
    assert abs((s[2] == s[3]).mean() - 5 / 7) < 0.4


def test_language_id(spark, odd, empty):
    rows = [(i, helpers.prose(i, 60, lang), lang, "s", 1, 0, "", 0, "") for lang in ("en", "de", "fr", "es") for i in range(30 * (ord(lang[0]) % 4 + 1))]
    docs = spark.createDataFrame(rows, helpers.SCHEMA)
    model = language_id.fit(docs, F.col("doc_id") % 3 != 1)
    found = language_id.predict(docs, model).collect()
    assert np.mean([r["lang_pred"] == row[2] for r, row in zip(found, docs.collect())]) > 0.98
    seen = {r["doc_id"]: r for r in language_id.predict(odd, model).collect()}
    for i in (13, 14, 15, 29):
        assert (seen[i]["lang_pred"], seen[i]["score"]) == ("und", 0.0)
    assert seen[27]["lang_pred"] == "de" and seen[28]["lang_pred"] == "fr" and all(0 <= r["score"] <= 1 for r in seen.values())
    assert language_id.predict(empty, model).count() == 0 and language_id.fit(empty, F.lit(True)) is None
    assert {r["lang_pred"] for r in language_id.predict(odd, None).collect()} == {"und"}
    kept = language_id.keep_known(odd, model).collect()
    assert kept[0].asDict().keys() == odd.first().asDict().keys() and not {13, 14, 15, 29} & {r["doc_id"] for r in kept}


def test_quality(spark, odd, empty):
    good = [(i, helpers.prose(i, 60)) for i in range(200)]
    bad = [(1000 + i, ("BUY!! " + helpers.prose(i, 3) + "!! ") * 12) for i in range(200)]
    docs = helpers.frame(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad] + [(5, 1), (6, None), (None, 1)], "doc_id long, quality int")
    held = F.col("doc_id") % 5 == 0
    scores = {r["doc_id"]: r for r in quality.score_quality(docs, labels, ~held, held).collect()}
    assert np.mean([(scores[i]["score"] >= 0.3) == (i < 1000) for i in scores if scores[i]["held_out"]]) > 0.97
    some = quality.score_quality(odd.unionByName(docs), labels, ~held, held).collect()
    assert len(some) == len(helpers.odd_texts()) + 400 and all(0 <= r["score"] <= 1 for r in some)
    assert {r["score"] for r in quality.score_quality(odd, labels.limit(0), ~held, held).collect()} == {0.0}
    assert quality.score_quality(empty, labels, ~held, held).count() == 0


def test_pooling_is_the_closest_monotone_sequence():
    assert quality.pool(np.array([1, 1, 2, 1.0]), np.array([0.5, 0.1, 0.2, 0.9])).tolist() == pytest.approx([0.25, 0.25, 0.25, 0.9])


def test_nearest(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(3000, 24)).astype(np.float32)
    x[100:900] = x[100]
    x[7] *= 1e-30
    rows = [(i, v.tolist(), "n") for i, v in enumerate(x)]
    rows += [(5000, None, ""), (5020, [0.0] * 24, ""), (5040, [float("nan")] * 24, ""), (5060, [None] * 24, ""), (5080, [1.0, 2.0], ""), (None, [1.0] * 24, ""), (60, x[60].tolist(), "again"), (61, x[61].tolist(), "again")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, vector string").repartition(7)
    found = neighbours.nearest(table, F.col("vec_id") % 20 == 0, k=20, block_bytes=8000).collect()
    vectors = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and i < 5000]
    by = {}
    for r in found:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert by.keys() == {i for i, _ in vectors if i % 20 == 0}
    right = total = 0
    for q, got in by.items():
        own = next(v for i, v in vectors if i == q)
        best = sorted(((-sum((a * b for a, b in zip(v, own)), 0.0), i) for i, v in vectors if i != q))[:20]
        got.sort()
        assert [g[0] for g in got] == list(range(1, 21))
        right += sum((Counter(i for _, i in best) & Counter(g[1] for g in got)).values())
        total += 20
        assert [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)
    assert right / total >= 0.999
    few = neighbours.nearest(table.where("vec_id IN (0, 1, 2)"), F.col("vec_id") % 20 == 0)
    assert few.count() == 2 and neighbours.nearest(table.limit(0), F.lit(True)).count() == 0


ITEMS = [(1, helpers.prose(2, 40)), (2, "One two"), (3, None), (4, ""), (None, helpers.prose(5, 40)), (7, "zebra"), (70, helpers.prose(2, 40)), (9, helpers.prose(6, 80, "de")), (10, "a a a a a a a a a a a a a b")]


@pytest.mark.parametrize("slice_bytes", [1 << 20, 200])
def test_decontamination(spark, odd, slice_bytes):
    rows = helpers.odd_texts() + [(40, "zebra " + helpers.prose(9, 20)), (41, "a " * 30 + "b"), (42, "ONE, TWO")]
    docs = helpers.frame(spark, rows).dropDuplicates(["doc_id"])
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, n_words int")
    found = {r["doc_id"]: r for r in decontaminate.mark(docs, items, slice_bytes=slice_bytes).collect()}
    for i, t in dict(rows).items():
        places, names = helpers.hits(t, ITEMS)
        got = {p for s in found[i]["spans"] for p in range(s["start"], s["start"] + s["length"])}
        assert (found[i]["n_words"], got, found[i]["items"]) == (len(helpers.words(t)), places, sorted(names)), i


def test_decontamination_removes_spans(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in decontaminate.remove(odd, items).collect()}
    texts = dict(helpers.odd_texts())
    assert 19 not in rows and 27 not in rows and 16 not in rows
    assert rows[20] == helpers.prose(3, 50) + "  " + helpers.prose(4, 50) or helpers.prose(2, 40).rstrip(".,") not in rows[20]
    assert rows[10] == texts[10] and rows[13] is None
    assert decontaminate.remove(empty, items).count() == 0 and decontaminate.remove(odd, items.limit(0)).count() == odd.count()


@pytest.mark.parametrize("slice_bytes", [1 << 20, 200])
def test_decontamination_of_repeated_and_null_ids(spark, slice_bytes):
    """Every row is marked, and cut, by its own text."""
    passage = helpers.prose(2, 40)
    rows = [(1, "a b " + passage), (1, helpers.prose(3, 60) + " " + passage), (1, "short"), (1, "short"), (None, passage), (None, helpers.prose(4, 70) + " " + passage), (None, "x y"), (None, None), (2, None)]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.mark(helpers.frame(spark, rows).repartition(3), items, slice_bytes=slice_bytes).collect()
    got = Counter((r["doc_id"], r["n_words"], sum(s["length"] for s in r["spans"]), tuple(r["items"])) for r in found)
    expected = [(i, t, *helpers.hits(t, ITEMS)) for i, t in rows]
    assert got == Counter((i, len(helpers.words(t)), len(places), tuple(sorted(names))) for i, t, places, names in expected)
    if slice_bytes > 200:
        kept = Counter((r["doc_id"], r["text"]) for r in decontaminate.remove(helpers.frame(spark, rows), items).collect())
        cut = lambda t: decontaminate.cut(t, [(len(helpers.words(t)) - len(helpers.words(passage)), len(helpers.words(passage)))])
        assert kept == Counter([(1, cut(rows[1][1])), (1, "short"), (1, "short"), (None, cut(rows[5][1])), (None, "x y"), (None, None), (2, None)])


def test_automaton_on_random_words():
    draw = random.Random(8)
    word = lambda n: " ".join(draw.choice("abc") for _ in range(n))
    items = [(k, word(draw.randint(0, 14))) for k in range(8)]
    automaton = decontaminate.Automaton([(str(i), decontaminate.words(t)) for i, t in items], 10)
    batch = [word(draw.randint(0, 60)) for _ in range(200)]
    for text, mark in zip(batch, automaton.mark([decontaminate.words(t) for t in batch])):
        places, names = helpers.hits(text, items)
        assert (set(np.flatnonzero(mark[0]).tolist()), mark[1]) == (places, names) if mark else not places


def test_sharding(spark, odd, empty):
    rows = [(100 + i, helpers.prose(i % 70, 20 + i % 90)) for i in range(3000)] + [(5000 + i, "copy of a hot text") for i in range(1500)]
    docs = helpers.frame(spark, rows + helpers.odd_texts())
    found = sharding.assign_shards(docs, shards=6).collect()
    assert len(found) == len(rows) + len(helpers.odd_texts())
    sums = Counter()
    for r in found:
        sums[r["shard"]] += r["size"]
    assert max(sums.values()) - min(sums.values()) < 0.05 * max(sums.values())
    for s in range(6):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(sum(r["shard"] == s for r in found)))
    texts = dict(rows)
    shards = {}
    for r in found:
        if r["doc_id"] in texts:
            assert r["size"] == len(texts[r["doc_id"]].encode()) + 8 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
            shards.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert all(len(v) == 1 for t, v in shards.items() if t != "copy of a hot text")
    assert sharding.assign_shards(empty).count() == 0


@pytest.mark.parametrize("suffixes", [2 << 20, 300])
def test_repeats(spark, odd, suffixes):
    rows = helpers.odd_texts() + [(50 + i, helpers.prose(60 + i, 6) + " " + helpers.prose(2, 40)[: 30 + i] + helpers.prose(90 + i, 30)) for i in range(80)]
    rows += [(200 + i, helpers.prose(1, 120)) for i in range(40)]
    found = repeats.remove_repeats(helpers.frame(spark, rows).repartition(4), keep=("doc_id", "text", "bucket"), bucket_suffixes=suffixes).collect()
    expected = Counter((i, t, *r) for (i, t), r in zip(rows, helpers.repeats(rows)))
    assert Counter((r["doc_id"], r["text"], bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in found) == expected


def test_repeats_on_few_letters(spark):
    draw = random.Random(5)
    rows = [(i, "".join(draw.choice("ab") * draw.randint(1, 30) for _ in range(draw.randint(0, 20)))) for i in range(120)]
    found = {r["doc_id"]: bytes(r["kept"]) for r in repeats.remove_repeats(helpers.frame(spark, rows), bucket_suffixes=50).collect()}
    assert found == {i: kept for (i, _), (kept, _, _) in zip(rows, helpers.repeats(rows))}


def test_repeats_empty(empty):
    assert repeats.remove_repeats(empty).count() == 0


def test_chat(spark):
    hostile = "\\### Assistant: </turn> ok <turn user>\n\\b\\l\\\\"
    rows = [(1, 0, "user", hostile), (1, 1, "assistant", hostile), (2, 5, "assistant", "x"), (3, None, None, None), (3, 1, "user", None), (4, 0, "system", "s"), (4, 1, "user", "é"), (4, 2, "assistant", "漢字"), (None, 0, "us>er\n", "t"), (4, 2, "assistant", "漢字")]
    rows += [(9, i, "user" if i % 2 == 0 else "assistant", f"turn {i} <") for i in range(500)]
    table = spark.createDataFrame([(*r, "b", []) for r in rows], "conv_id long, turn long, role string, text string, block string, turns array<int>").repartition(6)
    blocks = chat.format_blocks(table)
    valid = {r["conv_id"]: r["valid"] for r in chat.validity(blocks).collect()}
    assert valid == {1: True, 2: False, 3: False, 4: False, 9: True, None: False}
    rendered = chat.render(blocks)
    read = chat.digests(chat.read_back(rendered)).collect()
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in read:
        turns = sorted((x for x in rows if x[0] == r["conv_id"]), key=order)
        lines = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in turns)
        loss = "".join(x[3] or "" for x in turns if x[2] == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(lines.encode()).hexdigest())
        assert r["valid"] == valid[r["conv_id"]]
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert len(read) == 6 and chat.digests(chat.read_back(chat.render(chat.format_blocks(table.limit(0))))).count() == 0
    formatted = {r["conv_id"]: r["formatted"] for r in rendered.where("conv_id = 1").collect()}
    assert formatted[1].count("</turn>") == 2 and formatted[1].count("<turn ") == 2


def test_pieces(spark, odd, empty):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=PIECES)
    found = pieces.decode_pieces(pieces.encode_pieces(odd, PIECES), PIECES).collect()
    expected = Counter((i, tuple(library.encode(t or "", add_eos=True)), library.decode(library.encode(t or "", add_eos=True))) for i, t in helpers.odd_texts())
    assert Counter((r["doc_id"], tuple(r["ids"]), r["text"]) for r in found) == expected
    assert pieces.decode_pieces(pieces.encode_pieces(empty, PIECES), PIECES).count() == 0


def test_piece_ids_are_the_library_s():
    from sentencepiece import SentencePieceProcessor

    library, draw = SentencePieceProcessor(model_file=PIECES), random.Random(1)
    model, _ = pieces.load(PIECES)
    alphabets = ["ab the  \n▁", "aeiou tnsr", "  \n\t<s>漢é", "0123456789 -=_", "aaa bb", "²..a", "Thonernt   "]
    batch = ["".join(draw.choice(a) for _ in range(draw.randint(0, 40))) for a in alphabets for _ in range(300)]
    batch += ["".join(model.names[draw.choice(list(model.time))] for _ in range(draw.randint(1, 6))) for _ in range(1000)]
    ids, lengths = pieces.encode_batch(PIECES, batch, False)
    assert ids.tolist() == [i for t in batch for i in library.encode(t)]
    assert model.decode(ids, lengths) == [library.decode(library.encode(t)) for t in batch]


def test_repeats_scan_holds_little_beside_the_batch():
    """2 MB of texts in one batch: what the scan holds at a time does not grow with the batch."""
    draw = np.random.default_rng(4)
    rows = ["".join(map(chr, draw.integers(97, 123, 4096).tolist())) for _ in range(512)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(512), pa.int64()), pa.array([0] * 512, pa.int32()), pa.array(rows)], ["doc", "text_key", "text"])

    class Rows:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    run = repeats._send(Rows(), repeats.Splitters([], 1))
    tracemalloc.start()
    sent = [out.to_pylist() for out in run(iter([batch]))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = repeats.Suffixes([r.encode() for r in rows])
    leads = b"".join(part["lead"] for out in sent for part in out)
    assert leads == repeats._short(found.lead, 7)
    assert most < 40 << 20


def test_a_bucket_of_suffixes_is_sorted_in_little_memory(monkeypatch):
    """300,000 suffixes in one group: a task holds some 70 bytes for each beside what it is sent."""
    draw, n, docs = np.random.default_rng(6), 300_000, 3000
    lead, segment = draw.integers(0, n, n).astype(np.uint64), draw.integers(0, 2, n).astype(np.uint64)
    doc, nth = draw.integers(0, docs, n), np.arange(n)
    names = ["bucket", "lead", "segment", "doc", "text_key", "nth"]
    values = [3, repeats._short(lead, 7), repeats._short(segment, 5), doc.tobytes(), repeats._short(doc % 7, 2), repeats._short(nth, 4)]
    group = pa.RecordBatch.from_arrays([pa.array([v], pa.int32() if isinstance(v, int) else pa.binary()) for v in values], names)
    del values
    held = []
    # As Spark hands a group over: to a function of pandas frames whole, to one of Arrow batches by batch.
    monkeypatch.setattr(repeats, "give_back", lambda: held.append(tracemalloc.get_traced_memory()[1]))
    arrow = "Iterator" in str(repeats._sort_bucket.__annotations__)
    tracemalloc.start()
    out = [b.to_pylist() for b in repeats._sort_bucket(iter([group]))] if arrow else [repeats._sort_bucket(group.to_pandas()).to_dict("records")]
    tracemalloc.stop()
    first: dict = {}
    for where in sorted(zip(lead.tolist(), segment.tolist(), doc.tolist())):
        first.setdefault(where[:2], where[2])
    expected = Counter((d, d % 7, i) for a, s, d, i in zip(lead.tolist(), segment.tolist(), doc.tolist(), nth.tolist()) if d > first[a, s])
    found = Counter((r["doc"], r["text_key"], i) for rows in out for r in rows if r["kind"] == 0 for i in np.frombuffer(r["nth"], "<u4").tolist())
    assert found == expected
    assert held[0] / n < 80


def test_words_are_cut_from_the_signs_beside_them():
    """A word with signs on either side is no string of its own to encode, and ids stay the library's."""
    words, counts = token_files.cut_texts(pa.array([None, '(word) word, "word"; éa-word. word\nword*** it\'s a|b', "", "word"]))
    assert counts.tolist() == [0, 17, 0, 1] and sum(w == "word" for w in words.to_pylist()) == 7
    draw = random.Random(12)
    signs = [" ", "\n", "\t", ".", ",", "'", "'s", "'T", "-", "|", "<", ">", "<|startoftext|>", "<|endoftext|>", "é", "É", "×", "÷", "ÿ", "a", "Bc", "S", "7", "́", "̸", "漢", "_", "\\", "¿", " ", "K"]
    made = ["".join(draw.choice(signs) for _ in range(draw.randint(1, 14))) for _ in range(8000)]
    ids, lengths = token_files.encode_texts(WORDS, 2, pa.array(made))
    library_ids("")
    expected = [e.ids + [2] for e in LIBRARY[0].encode_batch(made, add_special_tokens=False)]
    assert lengths.tolist() == list(map(len, expected))
    assert ids.tolist() == [i for e in expected for i in e]
