"""The registered queries on the smallest tables, and the pipeline against brute force."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foliospark.llm.queries import QUERIES, SQL
from tests.parity import duck, norm

from . import helpers

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_query_against_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    rel = duck(SMALL).sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert Counter(tuple(norm(r[c]) for c in rel.columns) for r in df.collect()) == Counter(tuple(norm(v) for v in r) for r in rel.fetchall())


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def test_near_duplicates_query(spark):
    expected = helpers.groups(documents(spark))
    assert {r["doc_id"]: r["component_id"] for r in QUERIES["op2_near_dups"](spark, SMALL).collect()} == expected


def test_repeats_query(spark):
    rows = documents(spark)
    found = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in QUERIES["op8_repeats"](spark, SMALL).collect()}
    assert found == {i: (n, spans) for (i, _), (_, n, spans) in zip(rows, helpers.repeats(rows))}


def test_held_out_accuracy(spark):
    lang = QUERIES["op3_language_id"](spark, SMALL).where("held_out").join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert lang.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    quality = QUERIES["op4_quality"](spark, SMALL).where("held_out").join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id")
    assert quality.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] >= 0.85


def test_token_files_query(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected, start = [], 0
    for i, text in sorted(documents(spark)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = QUERIES["op1_token_files"](spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, found)) == expected


@pytest.mark.parametrize("name", ["op7_sharding", "op10_sentencepiece"])
def test_whole_table(spark, name):
    assert Counter(r["doc_id"] for r in QUERIES[name](spark, SMALL).select("doc_id").collect()) == Counter(i for i, _ in documents(spark))


def test_null_and_repeated_ids_in_stages(spark, tmp_path):
    """Copies with a null id go, and passages are cut from rows with null and repeated ids."""
    one, two, item = helpers.prose(600, 50), helpers.prose(601, 50), helpers.prose(602, 15)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)
    rows = [(1, one), (None, one), (None, two), (None, None), (4, None), (5, one), (6, helpers.prose(603, 50))]
    left = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, frame(rows), "").collect())
    assert left == Counter([rows[0], rows[2], rows[3], rows[4], rows[6]])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, one + " " + item), (None, item + " a"), (None, two), (7, two + " " + item), (7, "b " + item), (7, two)]
    clean = corpus_pipeline.without_benchmarks(spark, frame(rows), str(tmp_path)).collect()
    assert len(clean) == 4 and Counter(r["doc_id"] for r in clean) == Counter({None: 2, 7: 2})
    assert not any(helpers.hits(r["text"], [(1, item)])[0] for r in clean)


def test_pipeline(spark, tmp_path):
    from sentencepiece import SentencePieceProcessor

    passage = helpers.prose(2, 40)
    rows = [r for r in dict(helpers.odd_texts()).items() if r[0] is not None]
    rows += [(60 + i, helpers.prose(70 + i, 60, lang)) for i in range(12) for lang in ("en",)] + [(90, helpers.prose(200, 30) + " " + helpers.prose(99, 15) + " " + helpers.prose(201, 30))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, helpers.prose(99, 15)), (2, "quite another item of more than ten words for this very test")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    kept = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    group = helpers.groups(kept)
    kept = sorted((i, t) for i, t in kept if group[i] == i)
    kept = [(i, k.decode("utf-8", "replace")) for (i, _), (k, n, _) in zip(kept, helpers.repeats(kept)) if not n or k]
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    clean = {i: t for i, t in kept if not helpers.hits(t, items)[0]}
    assert found.keys() == {i for i, t in kept if 2 * len(helpers.hits(t, items)[0]) <= len(helpers.words(t))}
    for i, t in clean.items():
        assert found[i]["ids"] == library.encode(t, add_eos=True) and found[i]["text"] == library.decode(library.encode(t))
    assert 90 in found and not helpers.hits(found[90]["text"], items)[0]
    assert passage  # the passage of documents 19 and 20 goes from the later one
    assert passage not in found[20]["text"]
