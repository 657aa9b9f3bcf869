"""Search over chunks: question terms, vectors, fusion and prompts; see search_index for BM25."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import tokens
from .topk import BestRows

K1 = 1.2
B = 0.75
DEFAULT_K = 5
# Bound of what a vector search sends to every task at a time.
MAX_QUERY_VECTORS = 4_096
ROWS_PER_STEP = 256

# Columns of the search corpus.
INDEX_COLUMNS = ("chunk_id", "chunk_text", "document_id", "file_name", "file_path", "document_class", "chunk_index")


def index_source(chunks: DataFrame) -> DataFrame:
    return chunks.select(*INDEX_COLUMNS)


# --- BM25 -----------------------------------------------------------------


def query_terms(questions: DataFrame, query_id: str, query_text: str) -> DataFrame:
    return questions.select(
        F.col(query_id).alias("query_id"), F.explode(F.array_distinct(tokens(F.col(query_text)))).alias("term")
    )


def top_ranked(scored: DataFrame, query_id: str, row_id: str, k: int) -> DataFrame:
    """First k rows per query by score, ties by row id; limited before the shuffle."""
    order = Window.partitionBy(query_id).orderBy(F.desc("score"), row_id)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _arrow_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


# --- vectors --------------------------------------------------------------


def _unit_rows(vectors) -> np.ndarray:
    matrix = np.vstack(vectors).astype(np.float64)
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norm == 0, 1.0, norm)


def vector_search(
    vectors: DataFrame, queries: DataFrame, k: int = DEFAULT_K, row_id: str = "vec_id", row_vector: str = "embedding",
    query_id: str = "query_id", query_vector: str = "query_vector",
) -> DataFrame:
    """Best k vectors per query vector by cosine: ``query_id, <row_id>, score, rank``.

    Queries are sent to the tasks in slices below a checked bound; a task scores
    its own vectors with one matrix product per batch and emits k per query.
    """
    wanted = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("query_vector"))
    found = None
    for part in _bounded_slices(wanted, "query_id", MAX_QUERY_VECTORS):
        scored = _vector_scan(vectors, part, k, row_id, row_vector, wanted.schema["query_id"].dataType.simpleString())
        found = scored if found is None else found.unionAll(scored)
    if found is None:
        raise ValueError("no query vectors")
    return top_ranked(found, "query_id", row_id, k)


def _bounded_slices(wanted: DataFrame, key: str, bound: int, slices: int = 1, number: int = 0):
    """Lists of at most ``bound`` rows that together make up the frame."""
    part = wanted if slices == 1 else wanted.filter(F.pmod(F.xxhash64(key), F.lit(slices)) == number)
    rows = part.limit(bound + 1).collect()
    if len(rows) <= bound:
        if rows:
            yield rows
        return
    yield from _bounded_slices(wanted, key, bound, slices * 2, number)
    yield from _bounded_slices(wanted, key, bound, slices * 2, number + slices)


def _vector_scan(vectors, query_rows, k, row_id, row_vector, query_kind) -> DataFrame:
    names = [r["query_id"] for r in query_rows]
    matrix = _unit_rows([r["query_vector"] for r in query_rows])
    row_kind = vectors.schema[row_id].dataType.simpleString()
    row_type, query_type = _arrow_type(row_kind), _arrow_type(query_kind)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestRows(k, len(names))
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_PER_STEP):
                batch = whole.slice(start, ROWS_PER_STEP)
                column = batch.column("v")
                flat = column.flatten().to_numpy(zero_copy_only=False)
                rows = _unit_rows([flat.reshape(batch.num_rows, -1)])
                best.add(np.round(rows @ matrix.T, 6), np.asarray(batch.column("id").to_pylist(), dtype=object))
        rows = best.best
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([names[i] for i in rows["query"]], query_type),
                pa.array(rows["id"].tolist(), row_type),
                pa.array(rows["score"].to_numpy(), pa.float64()),
            ],
            names=["query_id", row_id, "score"],
        )

    narrow = vectors.select(F.col(row_id).alias("id"), F.col(row_vector).alias("v")).filter(F.col("v").isNotNull())
    return narrow.mapInArrow(scan, f"query_id {query_kind}, {row_id} {row_kind}, score double")


def nearest_row(
    vectors: DataFrame, centres: DataFrame, id_col: str, vector_col: str, centre_id: str, centre_vector: str
) -> DataFrame:
    """For every vector the closest of a bounded set of centres: ``id, nearest, score``."""
    rows = centres.select(centre_id, centre_vector).orderBy(centre_id).limit(MAX_QUERY_VECTORS + 1).collect()
    if len(rows) > MAX_QUERY_VECTORS:
        raise ValueError(f"more than {MAX_QUERY_VECTORS} centres")
    names = [r[0] for r in rows]
    matrix = _unit_rows([r[1] for r in rows])
    kind = vectors.schema[id_col].dataType.simpleString()
    name_kind = centres.schema[centre_id].dataType.simpleString()
    id_type, name_type = _arrow_type(kind), _arrow_type(name_kind)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            scores = np.round(_unit_rows([flat.reshape(batch.num_rows, -1)]) @ matrix.T, 6)
            top = scores.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").cast(id_type),
                    pa.array([names[i] for i in top], name_type),
                    pa.array(scores[np.arange(len(top)), top], pa.float64()),
                ],
                names=[id_col, "nearest", "score"],
            )

    narrow = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(F.col("v").isNotNull())
    return narrow.mapInArrow(scan, f"{id_col} {kind}, nearest {name_kind}, score double")


def fuse_rankings(rankings: list[DataFrame], query_id: str, row_id: str, k: int = DEFAULT_K, damping: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of several rankings (each at most k rows per query)."""
    merged = None
    for ranking in rankings:
        part = ranking.select(query_id, row_id, (1.0 / (damping + F.col("rank"))).alias("part"))
        merged = part if merged is None else merged.unionByName(part)
    fused = merged.groupBy(query_id, row_id).agg(F.round(F.sum("part"), 6).alias("score"))
    return top_ranked(fused, query_id, row_id, k)


# --- answers --------------------------------------------------------------

# The prompt layout and the answer when nothing is found.
PROMPT = """You are a helpful document analysis assistant. Answer the user's question based on the provided document context.
            
            Question: {question}
            
            Document Context:
            {context}
            
            Instructions:
            - Provide a clear, concise answer based on the document content
            - If the answer isn't in the documents, say so clearly
            - Reference specific documents when relevant
            - Be helpful and informative
            
            Answer:"""
NOTHING_FOUND = (
    "I couldn't find any relevant documents to answer your question. "
    "Please try rephrasing your query or check if documents have been processed."
)


def matched_documents(hits: DataFrame) -> DataFrame:
    """Per query the first three distinct file names, with dots if there are more."""
    names = F.array_sort(F.collect_set("file_name"))
    listed = hits.groupBy("query_id").agg(names.alias("_n"))
    text = F.concat(
        F.array_join(F.slice("_n", 1, 3), ", "), F.when(F.size("_n") > 3, F.lit("...")).otherwise(F.lit(""))
    )
    return listed.select("query_id", text.alias("document_names"))


def build_prompts(questions: DataFrame, hits: DataFrame, query_id: str = "query_id", query_text: str = "query_text") -> DataFrame:
    """One prompt per question from its ranked chunks (at most 20 each)."""
    block = F.concat(
        F.lit("Document: "), F.coalesce("file_name", F.lit("")),
        F.lit(" (Class: "), F.coalesce("document_class", F.lit("")),
        F.lit(")\nContent: "), "chunk_text",
    )
    context = hits.groupBy(F.col("query_id").alias(query_id)).agg(
        F.array_sort(F.collect_list(F.struct("rank", block.alias("block")))).alias("_blocks")
    )
    head, rest = PROMPT.split("{question}")
    middle, tail = rest.split("{context}")
    joined = F.array_join(F.transform("_blocks", lambda b: b["block"]), "\n\n")
    prompt = F.concat(F.lit(head), F.col(query_text), F.lit(middle), joined, F.lit(tail))
    return questions.join(context, query_id, "left").select(
        query_id,
        F.coalesce(F.size("_blocks"), F.lit(0)).alias("chunks_used"),
        F.when(F.col("_blocks").isNull(), F.lit(NOTHING_FOUND)).otherwise(prompt).alias("prompt"),
    )


def last_turns(conversation: DataFrame, n: int, session: str = "conv_id", order: str = "turn") -> DataFrame:
    """Last n turns of each conversation; each task keeps n before the shuffle."""
    recent = Window.partitionBy(session).orderBy(F.desc(order))
    return conversation.withColumn("_back", F.row_number().over(recent)).filter(F.col("_back") <= n).drop("_back")
