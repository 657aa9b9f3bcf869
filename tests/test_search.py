"""Search against brute force, and the way taken beyond the broadcast bounds."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.operators import search, search_index

CHUNKS = [
    ("c%02d" % i, " ".join(words), "d%d" % (i % 3), "f%d" % (i % 3), "p", "w2" if i % 2 else "other", i)
    for i, words in enumerate(
        [["tax", "wages"], ["tax", "tax", "form"], ["contract", "renewal", "terms"], ["renewal"], ["terms", "tax"], ["unrelated", "words"], ["tax"] * 9]
    )
]
COLUMNS = "chunk_id string, chunk_text string, document_id string, file_name string, file_path string, document_class string, chunk_index int"
QUESTIONS = [(1, "tax terms"), (2, "Renewal of contract"), (3, "nothing known")]


@pytest.fixture()
def chunks(spark):
    return spark.createDataFrame(CHUNKS, COLUMNS)


@pytest.fixture()
def questions(spark):
    return spark.createDataFrame(QUESTIONS, "query_id bigint, query_text string")


def brute(k):
    docs = {c[0]: c[1].split() for c in CHUNKS}
    avg = sum(map(len, docs.values())) / len(docs)
    out = {}
    for q, text in QUESTIONS:
        ranked = []
        for name, words in docs.items():
            score = 0.0
            for t in set(text.lower().split()):
                df = sum(t in w for w in docs.values())
                tf = words.count(t)
                idf = np.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / avg))
            if score > 0:
                ranked.append((-round(score, 4), name))
        out[q] = [(n, -s) for s, n in sorted(ranked)[:k]]
    return out


def collected(df):
    out = {q: [] for q, _ in QUESTIONS}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["chunk_id"], r["score"]))
    return out


def test_bm25_matches_brute_force(chunks, questions):
    assert collected(search_index.bm25_search(chunks, questions, 3)) == brute(3)


def test_bm25_class_filter(chunks, questions):
    rows = search_index.bm25_search(chunks, questions, 5, document_class="w2").collect()
    assert rows and all(r["document_class"] == "w2" for r in rows)


@pytest.fixture()
def many(spark):
    """Chunks of several blocks and tasks with frequent and rare words, ties and equal texts."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(draw.choices(words, [1 / (i + 1) for i in range(60)], k=draw.randint(1, 40))) for _ in range(1500)] + ["w3 w7 same"] * 40
    rows = [(f"c{i:05d}", t, f"d{i % 50}", "f", "p", "w2" if i % 3 else "other", i) for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, COLUMNS).repartition(3)


def plain(rows, questions, k, allowed=lambda r: True):
    """Scores of all chunks, one by one."""
    docs = [r[1].split() for r in rows]
    average, out = sum(map(len, docs)) / len(docs), {}
    df = Counter(t for ws in docs for t in set(ws))
    for q, text in questions:
        scored = []
        for row, ws in zip(rows, docs):
            parts = [math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * ws.count(t) * 2.2 / (ws.count(t) + 1.2 * (0.25 + 0.75 * len(ws) / average)) for t in set(text.split()) if t in ws]
            if parts and allowed(row):
                scored.append((-round(sum(parts), 4), row[0]))
        out[q] = [name for _, name in sorted(scored)[:k]]
    return out


ASKED = [(1, "w0 w1"), (2, "w55 w3 w0"), (3, "w7 same"), (4, "w58"), (5, "none of these"), (6, "")]


def ranked(df):
    out = {q: [] for q, _ in ASKED}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append(r["chunk_id"])
    return out


@pytest.mark.parametrize("k", [1, 5, 60, 3000])
def test_stored_index_finds_what_scoring_everything_finds(spark, many, tmp_path, k):
    rows, chunks = many
    questions = spark.createDataFrame(ASKED, "query_id bigint, query_text string")
    index = search_index.SearchIndex(spark, f"{tmp_path}/index", buckets=8)
    assert index.add_batch(chunks, 0)
    assert ranked(index.search(questions, k)) == plain(rows, ASKED, k)
    if k == 5:
        assert ranked(index.search(questions, k, where=F.col("document_class") == "other")) == plain(rows, ASKED, k, lambda r: r[5] == "other")


def test_refresh_replay_and_compaction(spark, many, tmp_path):
    """Segments by batch, a batch that comes again, and merged segments give what one index gives."""
    rows, chunks = many
    questions = spark.createDataFrame(ASKED, "query_id bigint, query_text string")
    index = search_index.SearchIndex(spark, f"{tmp_path}/index", buckets=4, fan=3)
    for batch in range(4):
        part = chunks.where(F.pmod("chunk_index", F.lit(4)) == batch)
        assert index.add_batch(part, batch) and not index.add_batch(part, batch)
    assert len(index.segments()) == 4 and index.version() == 4
    expected = plain(rows, ASKED, 7)
    assert ranked(index.search(questions, 7)) == expected
    before = index.version()
    assert index.compact() == 1 and len(index.segments()) == 1 and not index.add_batch(chunks, 2)
    assert ranked(index.search(questions, 7)) == expected
    assert {r["term"]: r["chunk_count"] for r in index.term_statistics().collect()} == Counter(t for r in rows for t in set(r[1].split()))
    # What readers of the older version see is still there, and a writer that started from it is refused.
    assert len(index.segments(before)) == 4
    with pytest.raises(search_index.Conflict):
        index._commit([], before)


def test_search_reads_the_buckets_of_its_terms_and_no_text(spark, many, tmp_path):
    index = search_index.SearchIndex(spark, f"{tmp_path}/index", buckets=16)
    index.add_batch(many[1], 0)
    question = spark.createDataFrame([(1, "w9 w31")], "query_id bigint, query_text string")
    found = index.rank(question, 3)
    text = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.split("\n") if "FileScan parquet" in line]
    assert scans and not any("chunk_text" in line.split("ReadSchema")[-1] for line in scans)
    folders = {line.split("/")[-2] for line in index.live("postings").inputFiles()}
    for line in (line for line in scans if "entries" in line or "max_tf" in line):
        assert "bucket#" in line.split("PartitionFilters")[1].split("PushedFilters")[0]
    read = index.live("postings").where(F.col("bucket").isin([r[0] for r in question.select(F.explode(F.split("query_text", " ")).alias("term")).select(index._bucket("term")).collect()]))
    assert 1 <= read.select("bucket").distinct().count() <= 2 < len(folders)


def test_empty_index(spark, tmp_path):
    index = search_index.SearchIndex(spark, f"{tmp_path}/index")
    question = spark.createDataFrame(ASKED, "query_id bigint, query_text string")
    assert index.search(question, 3).collect() == []
    assert index.add_batch(spark.createDataFrame([], COLUMNS), 0)
    assert index.search(question, 3).collect() == [] and index.statistics().first()["chunks"] == 0


def test_k_is_checked(chunks, questions):
    with pytest.raises(ValueError):
        search_index.bm25_search(chunks, questions, 0)


def test_vector_search_in_slices(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows, queries = rng.normal(size=(300, 8)), rng.normal(size=(25, 8))
    vectors = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id bigint, embedding array<float>").repartition(5)
    wanted = spark.createDataFrame([(i, q.tolist()) for i, q in enumerate(queries)], "query_id bigint, query_vector array<double>")
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit(queries) @ unit(rows.astype(np.float32).astype(float)).T, 6)
    best = {q: sorted(range(300), key=lambda i: (-scores[q, i], i))[:4] for q in range(25)}
    for bound in (4096, 7):
        monkeypatch.setattr(search, "MAX_QUERY_VECTORS", bound)
        got = {}
        for r in search.vector_search(vectors, wanted, 4).collect():
            got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
        assert {q: [v[i] for i in sorted(v)] for q, v in got.items()} == best


def test_prompt_without_hits(chunks, questions):
    rows = {r["query_id"]: r for r in search.build_prompts(questions, search_index.bm25_search(chunks, questions, 2)).collect()}
    assert rows[3]["prompt"] == search.NOTHING_FOUND and rows[3]["chunks_used"] == 0
    assert "Question: tax terms" in rows[1]["prompt"] and rows[1]["chunks_used"] == 2


def test_matched_documents(spark):
    hits = spark.createDataFrame([(1, f) for f in "dcbaa"] + [(2, "x")], "query_id bigint, file_name string")
    assert {r["query_id"]: r["document_names"] for r in search.matched_documents(hits).collect()} == {1: "a, b, c...", 2: "x"}


def test_lists_are_made_without_a_shuffle_of_words(spark, many, tmp_path):
    """Blocks go over batches; only the lists of asked terms, by block, and the best of a block are shuffled."""
    rows, chunks = many
    index = search_index.SearchIndex(spark, f"{tmp_path}/index", buckets=4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        index.add_batch(chunks, 0)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "Exchange" not in index._postings(index.live("chunks"), "x")._jdf.queryExecution().executedPlan().toString()
    lists = index.live("postings")
    assert lists.count() == lists.select("origin", "block", "bucket").distinct().count()
    counted = {r["term"]: (r["chunk_count"], r["occurrences"]) for r in index.term_statistics().collect()}
    words = [r[1].split() for r in rows]
    assert counted == {t: (n, sum(w.count(t) for w in words)) for t, n in Counter(t for w in words for t in set(w)).items()}


def test_questions_in_slices_and_of_one_id(spark, many, tmp_path, monkeypatch):
    rows, chunks = many
    index = search_index.SearchIndex(spark, f"{tmp_path}/index")
    index.add_batch(chunks, 0)
    monkeypatch.setattr(search_index, "QUESTIONS", 2)
    questions = spark.createDataFrame([*ASKED, (None, "w0")], "query_id bigint, query_text string")
    assert ranked(index.rank(questions, 5)) == plain(rows, ASKED, 5)
