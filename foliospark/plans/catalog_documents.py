"""Document-flow queries: parse, classify, extract, chunk, search, judge, split, sheets."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import jsontext
from ..operators import chunking, classify, extract, judge, routing, search, search_index, sheets, splitting
from ..operators.conversations import ConversationLog
from ..operators.provider import apply_provider
from ..schemas import empty, extraction_prompts
from ..seeds import ClassWord, ExtractRule
from ..sources import documents
from .catalog_relational import CLASS_KEY, PROMPTS
from .fixtures import Data
from .registry import query

AS_OF = datetime(2024, 3, 1)

# Words and rules that occur in the given texts.
WORDS = tuple(
    ClassWord(name, term, weight)
    for name, terms in {
        "w2": {"license": 30.0, "apache": 20.0},
        "vendor_contract": {"the": 1.0, "and": 1.0, "of": 1.0},
        "sales_report": {"der": 1.0, "und": 1.0, "nicht": 1.5},
        "hr_policy": {"le": 1.0, "des": 1.0, "une": 1.5},
        "case_study": {"el": 1.0, "los": 1.0, "que": 0.5},
        "strategy_document": {"con": 1.0, "las": 1.0},
    }.items()
    for term, weight in terms.items()
)
RULES = (
    ExtractRule("w2", "employee_name", r"([A-Za-z0-9._-]+@[A-Za-z0-9.-]+)"),
    ExtractRule("w2", "tax_year", r"([0-9]{4})"),
    ExtractRule("vendor_contract", "vendor_name", r"([Tt]he [a-z]+)"),
    ExtractRule("vendor_contract", "payment_terms", r"(and [a-z]+ing)"),
    ExtractRule("sales_report", "total_revenue", r"([Uu]nd [a-z]+)"),
    ExtractRule("hr_policy", "document_title", r"([Ll]e [a-z]+)"),
    ExtractRule("case_study", "customer_name", r"([A-Z][a-z]+ los)"),
    ExtractRule("other", "document_title", r"^([A-Za-z]{3,40})"),
)
WORD_ROWS = ", ".join(f"('{w.document_class}', '{w.term}', {w.weight}::DOUBLE)" for w in WORDS)
BEST_CLASS = rf"""
    tok AS (SELECT document_id, unnest(regexp_extract_all(lower(content_text), '[\p{{L}}\p{{N}}]+')) AS term FROM parsed),
    words(document_class, term, weight) AS (VALUES {WORD_ROWS}),
    per_class AS (SELECT t.document_id, w.document_class, sum(w.weight) AS score FROM tok t JOIN words w ON t.term = w.term GROUP BY 1, 2),
    best AS (SELECT document_id, arg_max(document_class, (score, -class_no)) AS document_class, max(score) AS score, sum(score) AS total
             FROM (SELECT *, dense_rank() OVER (ORDER BY document_class) AS class_no FROM per_class) r GROUP BY document_id)"""
CLASS_OF_ALL = f"""{BEST_CLASS},
    labelled AS (SELECT p.document_id, coalesce(b.document_class, 'other') AS document_class, coalesce(b.score, 0.0) AS class_score,
                   coalesce(round(b.score / b.total, 4), 0.0) AS confidence, p.content_text
                 FROM parsed p LEFT JOIN best b ON p.document_id = b.document_id)"""


def labelled(d: Data):
    d = d.spread()
    return classify.with_best_class(d.parsed.select("document_id", "file_name", "file_path", "content_text"), "content_text", WORDS)


# --- parse and ingest -------------------------------------------------------


@query(
    "d1_parse_result",
    """SELECT document_id, CASE WHEN error_information IS NULL THEN length(content_text) END AS content_length, error_information AS error FROM parsed""",
    "parsed",
)
def _(d: Data):
    content = F.when(F.col("error_information").isNull(), F.col("content_text"))
    stored = d.parsed.select("document_id", routing.parse_result(content, F.col("error_information")).alias("j"))
    return stored.select(
        "document_id",
        F.length(jsontext.path_value(F.col("j"), "$.content")).cast("bigint").alias("content_length"),
        jsontext.path_value(F.col("j"), "$.errorInformation").alias("error"),
    )


@query("d1_provider_hook", "SELECT doc_id, CASE WHEN n_chars % 2 = 0 THEN CAST(n_chars AS VARCHAR) END AS result, n_chars % 2 = 1 AS has_error FROM documents")
def _(d: Data):
    def measure(texts):
        sizes = texts.str.len()
        if (sizes % 2).any():
            raise ValueError("odd length")
        return sizes.astype(str)

    done = apply_provider(d.documents.select("doc_id", "text"), "text", measure)
    return done.select("doc_id", "result", F.col("error").isNotNull().alias("has_error"))


@query(
    "d2_ingest_documents",
    r"""SELECT concat('DOC_2024-03-01_000000_', md5(relative_path)) AS document_id, regexp_extract(relative_path, '[^/]+$') AS file_name, relative_path AS file_path,
          size AS file_size, file_url, CASE WHEN relative_path ILIKE '%.pdf' THEN 'pdf' WHEN relative_path LIKE '%.docx' THEN 'docx' WHEN relative_path LIKE '%.pptx' THEN 'pptx'
            WHEN relative_path LIKE '%.jp%g' THEN 'jpeg' WHEN relative_path LIKE '%.png' THEN 'png' WHEN relative_path LIKE '%.tif%' THEN 'tiff'
            WHEN relative_path LIKE '%.html' THEN 'html' ELSE 'txt' END AS document_type,
          length(text) AS text_length, relative_path LIKE '%_part_%_of_%.pdf' AS is_split_part, 'parsed' AS status
        FROM staged WHERE size <= 104857600 AND regexp_matches(upper(relative_path), '\.(PDF|DOCX|PPTX|JPE?G|PNG|TIFF?|HTML|TXT)$')
          AND doc_id NOT IN (SELECT doc_id FROM labels)""",
    "staged",
)
def _(d: Data):
    routed = routing.route_files(d.spread().staged.withColumnRenamed("text", "content"))
    known = d.staged.join(d.labels.select("doc_id"), "doc_id", "left_semi").select(F.col("relative_path").alias("file_path"))
    rows = routing.ingest_documents(
        routed.withColumn("error_information", F.lit(None).cast("string")), known, empty(d.spark, "large_document_registry"), AS_OF
    )
    return rows.select(
        "document_id", "file_name", "file_path", "file_size", "file_url", "document_type",
        F.length("content_text").alias("text_length"), "is_split_part", "status",
    )


# --- classify ---------------------------------------------------------------


@query(
    "d3_classify_words",
    ",".join(["", CLASS_OF_ALL.lstrip()]) + " SELECT document_id, document_class, class_score, confidence FROM labelled",
    "parsed",
)
def _(d: Data):
    return labelled(d).select("document_id", "document_class", "class_score", "confidence")


@query(
    "d3_classify_nearest",
    """, cells AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings),
       means AS (SELECT label, list(m ORDER BY dim) AS mean FROM (SELECT label, dim, avg(x) AS m FROM cells GROUP BY label, dim) c GROUP BY label),
       scored AS (SELECT e.vec_id, m.label, round(list_cosine_similarity(e.embedding::DOUBLE[], m.mean), 6) AS score FROM embeddings e CROSS JOIN means m)
       SELECT vec_id, arg_max(label, (score, -label)) AS nearest, max(score) AS score FROM scored GROUP BY vec_id""",
    "staged",
)
def _(d: Data):
    return classify.nearest_centroid(d.embeddings, "vec_id", "embedding", "label")


@query("d3_classify_trained")
def _(d: Data):
    rows = d.documents.join(d.labels, "doc_id").select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    model = classify.train_text_classifier(rows, "text", "label", features=1 << 12)
    return model.transform(d.documents.select("doc_id", "text")).select("doc_id", F.col("prediction").cast("int").alias("quality"))


# --- extract ----------------------------------------------------------------


def _rule_sql() -> str:
    rules = ", ".join("('{}', '{}', '{}')".format(*r) for r in RULES)
    return f"""{CLASS_OF_ALL},
    rules(document_class, attribute_name, pattern) AS (VALUES {rules}),
    asked AS (SELECT l.document_id, l.document_class, p.attribute_name, r.pattern, l.content_text
              FROM labelled l JOIN {PROMPTS} p ON p.document_class = l.document_class
              LEFT JOIN rules r ON r.document_class = p.document_class AND r.attribute_name = p.attribute_name),
    found AS (SELECT document_id, document_class, attribute_name, CASE WHEN pattern IS NULL THEN [] ELSE regexp_extract_all(content_text, pattern, 1) END AS f FROM asked)
    """


@query(
    "d4_extract_attributes",
    "," + _rule_sql() + """SELECT document_id, document_class, attribute_name, f[1] AS attribute_value,
       CASE WHEN len(f) = 0 THEN 0.0 ELSE round(1.0 / len(list_distinct(f)), 4) END AS confidence_score FROM found""",
    "parsed",
)
def _(d: Data):
    rows = extract.extract(labelled(d), extraction_prompts(d.spark), AS_OF, RULES)
    return rows.select("document_id", "document_class", "attribute_name", "attribute_value", "confidence_score")


@query(
    "d5_flatten_results",
    "," + _rule_sql() + """SELECT document_id, attribute_name, f[1] AS attribute_value,
       CASE WHEN len(f) = 0 THEN 0.0 ELSE round(1.0 / len(list_distinct(f)), 4) END AS confidence_score FROM found""",
    "parsed",
)
def _(d: Data):
    answered = extract.with_answers(extract.with_questions(labelled(d), extraction_prompts(d.spark)), RULES)
    stored = answered.select("document_id", extract.stored_result(F.col("_result")).alias("extraction_json"))
    return extract.flatten_result(stored).drop("extraction_json")


# --- chunk ------------------------------------------------------------------

WINDOWS = """, w AS (SELECT document_id, content_text AS t, i, substring(content_text, i * 800 + 1, 1000) AS win,
       CASE WHEN i = 0 THEN '' ELSE substring(content_text, i * 800, 1) END AS before, substring(content_text, i * 800 + 1001, 1) AS after
     FROM (SELECT document_id, content_text, unnest(generate_series(0, CAST(greatest(0, ceil((length(content_text) - 1000) / 800.0)) AS BIGINT))) AS i
           FROM parsed WHERE length(trim(content_text)) > 100 AND status <> 'parse_error') x)"""
PACKED = WINDOWS + r""", l AS (SELECT document_id, i, after, CASE WHEN i = 0 OR (regexp_matches(before, '\s') AND regexp_matches(win, '^\S')) OR length(regexp_extract(win, '^\S*\s*')) > 200
         THEN win ELSE substring(win, length(regexp_extract(win, '^\S*\s*')) + 1) END AS win FROM w),
     packed AS (SELECT document_id, i, CASE WHEN after = '' OR (regexp_matches(after, '\S') AND regexp_matches(win, '\s$')) OR length(regexp_extract(win, '\S*\s*$')) > 200
         THEN win ELSE left(win, length(win) - length(regexp_extract(win, '\S*\s*$'))) END AS chunk_text FROM l)"""
CHUNKS = PACKED + """, chunks AS (SELECT concat(document_id, '_CHUNK_', i) AS chunk_id, document_id, CAST(i AS INTEGER) AS chunk_index, chunk_text
     FROM packed WHERE length(trim(chunk_text)) > 50)"""


@query(
    "d6_chunk_stride",
    WINDOWS + " SELECT document_id, CAST(i AS INTEGER) AS chunk_index, win AS chunk_text FROM w WHERE length(trim(win)) > 50",
    "parsed",
)
def _(d: Data):
    texts = chunking.chunkable(d.spread().parsed).select("document_id", "content_text")
    return chunking.chunk_texts(texts, "content_text", mode="stride")


@query("d6_chunk_packed", CHUNKS + " SELECT document_id, chunk_index, chunk_text FROM chunks", "parsed")
def _(d: Data):
    texts = chunking.chunkable(d.spread().parsed).select("document_id", "content_text")
    return chunking.chunk_texts(texts, "content_text")


def chunk_table(d: Data):
    """The chunks of all documents as a stored table, the input of every search."""
    texts = d.spread().parsed
    return d.stored(chunking.chunk_documents(texts, d.classified, empty(d.spark, "document_chunks"), AS_OF), "chunks")


#: The class of a chunk's document, from a stored class ``k``.
CHUNK_CLASS = "coalesce(CASE WHEN json_valid(k.document_class) THEN json_extract_string(k.document_class, '$.labels[0]') ELSE k.document_class END, 'unclassified')"


#: Indexes of this session's tables.
_INDEXES: dict[tuple[str, str], search_index.SearchIndex] = {}


def stored_index(d: Data) -> search_index.SearchIndex:
    """The search index of all chunks: made by the first query that needs it, then read."""
    key = d.spark.sparkContext.applicationId, d.sf_dir
    if key not in _INDEXES:
        _INDEXES[key] = search_index.index_of(chunk_table(d))
    return _INDEXES[key]


# --- index and search -------------------------------------------------------


@query(
    "d7_index_source",
    CHUNKS + """ SELECT c.chunk_id, c.document_id, p.file_name, p.file_path, """ + CHUNK_CLASS + """ AS document_class, c.chunk_index, c.chunk_text
      FROM chunks c JOIN parsed p ON c.document_id = p.document_id LEFT JOIN classified k ON k.document_id = c.document_id""",
    "classified",
)
def _(d: Data):
    return search.index_source(chunk_table(d))


TOKENS = r""", tk AS (SELECT chunk_id, regexp_extract_all(lower(chunk_text), '[\p{L}\p{N}]+') AS t FROM chunks),
     post AS (SELECT chunk_id, len(t) AS chunk_len, term, count(*) AS tf FROM (SELECT chunk_id, t, unnest(t) AS term FROM tk) x GROUP BY ALL)"""


@query("d7_term_statistics", CHUNKS + TOKENS + " SELECT term, count(*) AS chunk_count, CAST(sum(tf) AS BIGINT) AS occurrences FROM post GROUP BY term", "parsed")
def _(d: Data):
    return stored_index(d).term_statistics()


BM25 = CHUNKS + TOKENS + r""", df AS (SELECT term, count(*) AS df FROM post GROUP BY term),
     st AS (SELECT count(*) AS n, avg(len(t)) AS al FROM tk),
     q AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM benchmark),
     sc AS (SELECT q.query_id, p.chunk_id, round(sum(ln(1 + (st.n - df.df + 0.5) / (df.df + 0.5)) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.chunk_len / st.al))), 4) AS score
            FROM q JOIN post p ON q.term = p.term JOIN df ON df.term = q.term CROSS JOIN st GROUP BY 1, 2),
     ranked AS (SELECT query_id, chunk_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM sc)"""


@query("d8_bm25_search", BM25 + " SELECT r.query_id, r.rank, r.score, r.chunk_id, c.chunk_text FROM ranked r JOIN chunks c ON r.chunk_id = c.chunk_id WHERE rank <= 5", "parsed")
def _(d: Data):
    return stored_index(d).search(d.questions, 5).select("query_id", "rank", "score", "chunk_id", "chunk_text")


@query("d8_bm25_postings", BM25 + " SELECT query_id, chunk_id, score, rank FROM ranked WHERE rank <= 5", "parsed")
def _(d: Data):
    return stored_index(d).rank(d.questions, 5).select("query_id", "chunk_id", "score", "rank")


MEANS = """, cells AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings),
     means AS (SELECT label AS query_id, list(m ORDER BY dim) AS mean FROM (SELECT label, dim, avg(x) AS m FROM cells GROUP BY label, dim) c GROUP BY label),
     sims AS (SELECT m.query_id, e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], m.mean), 6) AS score FROM embeddings e CROSS JOIN means m),
     near AS (SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM sims)"""


@query("d9_vector_search", MEANS + " SELECT * FROM near WHERE rank <= 5", "staged")
def _(d: Data):
    return vector_hits(d, 5)


def vector_hits(d: Data, k: int):
    queries = classify.class_means(d.embeddings, "embedding", "label").select(F.col("label").alias("query_id"), F.col("mean").alias("query_vector"))
    return search.vector_search(d.embeddings, queries, k)


LETTERS = "abcdefghijklmnopqrstuvwxyz"
_COUNTS = ", ".join(f"(length(l) - length(replace(l, '{c}', '')))::DOUBLE" for c in LETTERS)


def letter_counts(text: str):
    """Stand-in for an embedding that any engine computes alike: how often each letter occurs."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    return F.array(*[(F.length(lower) - F.length(F.replace(lower, F.lit(c), F.lit("")))).cast("double") for c in LETTERS])


@query(
    "d9_fused_ranking",
    BM25 + f""", cv AS (SELECT chunk_id, [{_COUNTS}] AS v FROM (SELECT chunk_id, lower(chunk_text) AS l FROM chunks)),
      qv AS (SELECT item_id AS query_id, [{_COUNTS}] AS v FROM (SELECT item_id, lower(coalesce(text, '')) AS l FROM benchmark)),
      sims AS (SELECT query_id, chunk_id, round(list_cosine_similarity(cv.v, qv.v), 6) AS score FROM cv, qv WHERE list_sum(cv.v) > 0 AND list_sum(qv.v) > 0),
      near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM sims),
      parts AS (SELECT query_id, chunk_id, 1.0 / (60 + rank) AS part FROM near WHERE rank <= 20 UNION ALL SELECT query_id, chunk_id, 1.0 / (60 + rank) FROM ranked WHERE rank <= 20),
      fused AS (SELECT query_id, chunk_id, round(sum(part), 6) AS score FROM parts GROUP BY 1, 2)
      SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM fused) r WHERE rank <= 5""",
    "parsed",
)
def _(d: Data):
    """BM25 and vector ranks over the same chunks."""
    index = stored_index(d)
    some = F.exists("v", lambda n: n > 0)
    vectors = index.live("chunks").select("chunk_id", letter_counts("chunk_text").alias("v")).where(some)
    asked = d.questions.select("query_id", letter_counts("query_text").alias("v")).where(some)
    near = search.vector_search(vectors, asked, 20, row_id="chunk_id", row_vector="v", query_vector="v")
    return search.fuse_rankings([index.rank(d.questions, 20), near], "query_id", "chunk_id", 5)


HITS = (
    BM25 + ", hits AS (SELECT r.query_id, r.rank, k.file_name, c.chunk_text, " + CHUNK_CLASS + """ AS document_class
      FROM ranked r JOIN chunks c ON r.chunk_id = c.chunk_id JOIN classified k ON k.document_id = c.document_id WHERE rank <= 5)"""
)


@query(
    "d10_matched_documents",
    HITS + """, names AS (SELECT query_id, list(DISTINCT file_name ORDER BY file_name) AS n FROM hits GROUP BY query_id)
      SELECT query_id, concat(array_to_string(n[1:3], ', '), CASE WHEN len(n) > 3 THEN '...' ELSE '' END) AS document_names FROM names""",
    "classified",
)
def _(d: Data):
    return search.matched_documents(stored_index(d).search(d.questions, 5))


def _prompt_sql() -> str:
    head, rest = search.PROMPT.split("{question}")
    middle, tail = rest.split("{context}")
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return HITS + f""", ctx AS (SELECT query_id, count(*) AS n, string_agg(concat('Document: ', file_name, ' (Class: ', document_class, ')', chr(10), 'Content: ', chunk_text), concat(chr(10), chr(10)) ORDER BY rank) AS c
          FROM hits GROUP BY query_id)
        SELECT item_id AS query_id, CAST(coalesce(n, 0) AS INTEGER) AS chunks_used,
          CASE WHEN c IS NULL THEN {quote(search.NOTHING_FOUND)} ELSE concat({quote(head)}, text, {quote(middle)}, c, {quote(tail)}) END AS prompt
        FROM benchmark LEFT JOIN ctx ON item_id = query_id"""


@query("d11_build_prompts", _prompt_sql(), "classified")
def _(d: Data):
    return search.build_prompts(d.questions, stored_index(d).search(d.questions, 5))


@query("l6_retrieval_top_k", BM25 + " SELECT query_id, chunk_id, score, rank FROM ranked WHERE rank <= 20", "parsed")
def _(d: Data):
    return stored_index(d).rank(d.questions, 20).select("query_id", "chunk_id", "score", "rank")


@query(
    "d8_bm25_by_class",
    BM25.replace("FROM packed WHERE", "FROM packed WHERE document_id IN (SELECT document_id FROM classified WHERE document_class = 'w2') AND")
    + " SELECT query_id, chunk_id, score, rank FROM ranked WHERE rank <= 3",
    "classified",
)
def _(d: Data):
    return search_index.bm25_search(chunk_table(d), d.questions, 3, document_class="w2").select("query_id", "chunk_id", "score", "rank")


@query(
    "d12_last_turns",
    "SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS b FROM conversations) c WHERE b <= 2",
)
def _(d: Data):
    return search.last_turns(d.conversations, 2).select("conv_id", "turn", "role", "text")


@query("d12_conversation_log", "SELECT conv_id, turn, min(role) AS role, arg_min(text, (role, text)) AS text FROM conversations GROUP BY conv_id, turn")
def _(d: Data):
    """All turns through a stream in several batches; then the last batch again, and all turns once more as a later batch."""
    source, path = d.folder("turns"), d.folder("log")
    d.conversations.select("conv_id", "turn", "role", "text").repartition(3).write.parquet(source)
    log = ConversationLog(d.spark, path, "conv_id bigint, turn bigint, role string, text string", buckets=16)
    turns = d.spark.readStream.schema("conv_id bigint, turn bigint, role string, text string").option("maxFilesPerTrigger", 1).parquet(source)
    log.start(turns, d.folder("log_checkpoint")).awaitTermination()
    every = d.spark.read.parquet(source)
    for batch in (3, 3, 4):
        log.append(every, batch)
    return log.read()


# --- judge ------------------------------------------------------------------

SCORES = r""", s AS (SELECT document_id, content_text, CASE WHEN length(content_text) = 0 THEN 0.0::DOUBLE
        ELSE round(1.0::DOUBLE - length(regexp_replace(content_text, '[\p{L}\p{N}\s.,;:!?''"()\-/]', '', 'g'))::DOUBLE / length(content_text), 4) END AS a,
      regexp_replace(content_text, '\s+$', '') AS e FROM parsed),
    s2 AS (SELECT *, CASE WHEN e = '' THEN 0.0::DOUBLE WHEN regexp_matches(e, '[.!?…]["''”’)\]]*$') THEN 1.0::DOUBLE WHEN regexp_matches(e, '[\p{L}\p{N}]$') THEN 0.98::DOUBLE ELSE 0.9::DOUBLE END AS c FROM s)"""


@query(
    "d13_judge_scores",
    SCORES + """ SELECT document_id, a AS ocr_accuracy_score, c AS ocr_completeness_score,
       CASE WHEN a >= 0.97 THEN 'text is readable' WHEN a >= 0.9 THEN 'some unreadable characters' WHEN a >= 0.7 THEN 'many unreadable characters' ELSE 'mostly unreadable' END AS ocr_accuracy_reasoning,
       CASE WHEN c >= 1.0 THEN 'ends with a sentence' WHEN c >= 0.98 THEN 'ends with a word' WHEN c > 0 THEN 'ends inside a clause' ELSE 'no text' END AS ocr_completeness_reasoning FROM s2""",
    "parsed",
)
def _(d: Data):
    source = documents.evaluation_source(d.spread().parsed)
    rows = judge.evaluate(source, "parsed_documents", as_of=AS_OF)
    return rows.select(
        "document_id", "ocr_accuracy_score", "ocr_completeness_score", "ocr_accuracy_reasoning", "ocr_completeness_reasoning"
    )


@query(
    "d13_judge_replies",
    """SELECT p.document_id, CASE r.doc_id % 8 WHEN 0 THEN CAST(concat('0.', d.n_chars % 100 + 100) AS DOUBLE) WHEN 1 THEN CAST(concat('0.', d.n_chars % 100 + 100) AS DOUBLE)
         WHEN 2 THEN 1.0 WHEN 3 THEN 0.0 WHEN 4 THEN 0.0 ELSE 0.5 END AS ocr_accuracy_score,
         CASE r.doc_id % 8 WHEN 0 THEN concat('clear ', d.lang) WHEN 1 THEN 'inner' WHEN 2 THEN 'too high' WHEN 3 THEN 'no score'
           WHEN 4 THEN 'No reasoning provided' ELSE 'No reasoning captured' END AS ocr_accuracy_reasoning, 'ocr_eval_v2_1709251200' AS run_name
       FROM parsed p JOIN judge_replies r ON p.doc_id = r.doc_id JOIN documents d ON d.doc_id = r.doc_id""",
    "parsed judge_replies",
)
def _(d: Data):
    replies = d.judge_replies.select("document_id", F.col("reply").alias("accuracy_reply"), F.col("reply").alias("completeness_reply"))
    rows = judge.evaluate(documents.evaluation_source(d.parsed), "parsed_documents", app_version="v2", as_of=AS_OF, replies=replies)
    return rows.select("document_id", "ocr_accuracy_score", "ocr_accuracy_reasoning", "run_name")


@query(
    "d14_evaluation_run",
    SCORES + """ SELECT 'ocr_eval_v1_1709251200' AS run_name, 'OCR_EVL' AS app_name, 'parsed_documents' AS source_table, count(*) AS records_evaluated, 'OCR_ACCURACY' AS results_table,
       'SELECT * FROM OCR_ACCURACY WHERE run_name = ''ocr_eval_v1_1709251200''' AS query_instructions,
       ((2 * sum(CAST(round(a * 1000000) AS HUGEINT)) + 1000 * count(a)) // (2000 * count(a)))::DOUBLE / 1000 AS mean_accuracy, round(median(a), 3) AS median_accuracy, min(a) AS min_accuracy, max(a) AS max_accuracy, round(stddev(a), 3) AS std_accuracy,
       ((2 * sum(CAST(round(c * 1000000) AS HUGEINT)) + 1000 * count(c)) // (2000 * count(c)))::DOUBLE / 1000 AS mean_completeness, round(median(c), 3) AS median_completeness, min(c) AS min_completeness, max(c) AS max_completeness, round(stddev(c), 3) AS std_completeness
       FROM s2""",
    "parsed",
)
def _(d: Data):
    rows = judge.evaluate(documents.evaluation_source(d.spread().parsed), "parsed_documents", as_of=AS_OF)
    numbers = "struct<mean: double, median: double, min: double, max: double, std: double>"
    shape = f"""run_name string, app_name string, source_table string, records_evaluated bigint, results_table string, query_instructions string,
        metrics struct<ocr_accuracy_score: {numbers}, ocr_completeness_score: {numbers}>"""
    parsed = judge.summary_json(rows).select(F.from_json("summary", shape).alias("s"))
    return parsed.select(
        "s.run_name", "s.app_name", "s.source_table", "s.records_evaluated", "s.results_table", "s.query_instructions",
        *[
            F.col(f"s.metrics.ocr_{metric}_score.{number}").alias(f"{number}_{metric}")
            for metric in ("accuracy", "completeness")
            for number in ("mean", "median", "min", "max", "std")
        ],
    )


# --- split ------------------------------------------------------------------


@query(
    "d15_split_plan",
    r"""SELECT concat(registry_id, '_PART_', i) AS part_id, i AS part_number, n AS total_parts, (i - 1) * 200 + 1 AS page_start, least(i * 200, page_count) AS page_end,
          concat('split_documents/', regexp_replace(original_file_name, '\.[^.]*$', ''), '_part_', i, '_of_', n, '.pdf') AS part_stage_path,
          CAST((original_file_size * (least(i * 200, page_count) - (i - 1) * 200)) // page_count AS BIGINT) AS part_size
        FROM (SELECT *, unnest(generate_series(1, n)) AS i FROM (SELECT *, CAST(ceil(page_count / 200.0) AS BIGINT) AS n FROM large_registry) a WHERE page_count > 200) b""",
    "large_registry",
)
def _(d: Data):
    rows = splitting.part_rows(splitting.plan_splits(d.large_registry), AS_OF)
    return rows.select("part_id", "part_number", "total_parts", "page_start", "page_end", "part_stage_path", "part_size")


@query(
    "d15_split_status",
    """SELECT registry_id, CASE WHEN page_count <= 200 AND original_file_size <= 94371840 THEN 'no_split_needed' WHEN page_count <= 200 THEN 'unsplittable' ELSE 'split_complete' END AS split_status,
         CASE WHEN page_count > 200 THEN CAST(ceil(page_count / 200.0) AS BIGINT) ELSE 0 END AS split_count FROM large_registry""",
    "large_registry",
)
def _(d: Data):
    return splitting.plan_splits(d.large_registry).select("registry_id", "split_status", "split_count")


def text_pages(d: Data, size: int = 40):
    """Pages of 40 characters of every document."""
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return d.documents.select("doc_id", F.posexplode(cut).alias("n", "page_text")).select(
        "doc_id", (F.col("n") + 1).cast("bigint").alias("page_number"), "page_text"
    )


@query(
    "d16_split_pages",
    """SELECT doc_id, i + 1 AS part_number, i * 200 + 1 AS page_start, least((i + 1) * 200, CAST(ceil(n_chars / 40.0) AS BIGINT)) AS page_end, substring(text, i * 8000 + 1, 8000) AS part_text
       FROM (SELECT doc_id, text, n_chars, unnest(generate_series(0, CAST(ceil(n_chars / 8000.0) AS BIGINT) - 1)) AS i FROM documents) d""",
)
def _(d: Data):
    return splitting.split_pages(text_pages(d.spread()), "doc_id")


# --- sheets -----------------------------------------------------------------


@query(
    "d17_sheet_metadata",
    """SELECT concat(s.registry_id, '_SHEET_', s.sheet_index) AS sheet_id, s.sheet_name, s.sheet_index, CAST(coalesce(max(c.row), 0) AS BIGINT) AS row_count,
         CAST(coalesce(max(c.col), 0) AS BIGINT) AS column_count, max(c.row) IS NOT NULL AS has_data FROM sheets s
       LEFT JOIN cells c ON s.registry_id = c.registry_id AND s.sheet_index = c.sheet_index GROUP BY s.registry_id, s.sheet_index, s.sheet_name""",
    "cells sheets",
)
def _(d: Data):
    rows = sheets.sheet_metadata(d.sheets, d.cells, AS_OF)
    return rows.select("sheet_id", "sheet_name", "sheet_index", "row_count", "column_count", "has_data")


@query(
    "d18_sheet_previews",
    """, m AS (SELECT s.registry_id, s.sheet_index, s.sheet_name, CAST(coalesce(max(c.row), 0) AS BIGINT) AS r, CAST(coalesce(max(c.col), 0) AS BIGINT) AS k
        FROM sheets s LEFT JOIN cells c ON s.registry_id = c.registry_id AND s.sheet_index = c.sheet_index GROUP BY ALL),
      lines AS (SELECT registry_id, sheet_index, row, string_agg(CASE WHEN value IS NULL THEN '' WHEN length(value) > 100 THEN concat(substring(value, 1, 97), '...') ELSE value END, ' | ' ORDER BY col) AS line
        FROM cells WHERE row <= 500 AND col <= 15 GROUP BY ALL),
      grid AS (SELECT registry_id, sheet_index, unnest(generate_series(1, least(r, 500))) AS row FROM m WHERE r > 0),
      body AS (SELECT g.registry_id, g.sheet_index, string_agg(concat(coalesce(l.line, repeat(' | ', 14)), chr(10)), '' ORDER BY g.row) AS b
        FROM grid g LEFT JOIN lines l ON g.registry_id = l.registry_id AND g.sheet_index = l.sheet_index AND g.row = l.row GROUP BY 1, 2)
      SELECT m.registry_id, m.sheet_index, concat('Sheet ', m.sheet_index, ': ', sheet_name, chr(10), 'Rows: ', r, ', Columns: ', k, chr(10),
        CASE WHEN r = 0 THEN concat('(Empty sheet)', chr(10)) ELSE concat(CASE WHEN r > 500 THEN concat('(Showing first 500 rows of ', r, ' total)', chr(10)) ELSE '' END,
          '(Showing first 15 of ', k, ' columns)', chr(10), b) END) AS preview
      FROM m LEFT JOIN body b ON m.registry_id = b.registry_id AND m.sheet_index = b.sheet_index""",
    "cells sheets",
)
def _(d: Data):
    metadata = sheets.sheet_metadata(d.sheets, d.cells, AS_OF)
    return sheets.sheet_previews(metadata, d.cells)


# --- callable surfaces ------------------------------------------------------


@query(
    "x3_evaluation_parameters",
    """SELECT 'reader' AS app_name, 'v7' AS app_version, 'ocr_eval_v7_1709251200' AS run_name, 'docs' AS source_table, count(*) AS records FROM parsed""",
    "parsed",
)
def _(d: Data):
    rows = judge.evaluate(documents.evaluation_source(d.parsed), "docs", "reader", "v7", as_of=AS_OF)
    return rows.groupBy("app_name", "app_version", "run_name", "source_table").agg(F.count("*").alias("records"))


@query(
    "x4_search_function",
    BM25.replace("SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM benchmark", "SELECT 0 AS query_id, unnest(['license', 'apache', 'the']) AS term")
    + " SELECT rank, score, chunk_id FROM ranked WHERE rank <= 7",
    "parsed",
)
def _(d: Data):
    return stored_index(d).search_text("The Apache license", 7).select("rank", "score", "chunk_id")


@query(
    "x5_custom_metrics",
    """SELECT doc_id, CAST(len(regexp_extract_all(text, '[^ \n]+')) AS BIGINT) AS words FROM documents""",
)
def _(d: Data):
    import json

    def measure(texts):
        return texts.map(lambda t: json.dumps({"words": len([w for line in t.split("\n") for w in line.split(" ") if w])}))

    scored = apply_provider(d.spread().documents.select("doc_id", "text"), "text", measure, "metrics")
    return scored.select("doc_id", jsontext.path_value(F.col("metrics"), "$.words", "bigint").alias("words"))
