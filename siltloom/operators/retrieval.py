"""Lexical, set and vector retrieval with explicit ties, chunking, fusion.

Documents are dealt to shards, each with an inverted index of its own, and blocks of queries are sent to the shards: a
query meets only the documents that share one of its terms, and the k best are taken before anything is shuffled for
the ranking.  A query set is given as a table, never as a driver-side loop.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltloom.common import durable, map_rows
from siltloom.functions.text import code_tokens, import_features

#: Separators of the two chunkers.
INDEX_SEPARATORS = ("\n\n", "\n", "。", "；")
DOCUMENT_SEPARATORS = ("\n\n", "\n", " ", "")


def top_k(scored: DataFrame, k: int, query: str = "query_id", score: str = "score", tie: str = "doc_id") -> DataFrame:
    """The k best per query with their rank, ties by the tie key.  Spark drops worse rows before the shuffle (group limit)."""
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(F.desc(score), tie)))
    return ranked.where(F.col("rank") <= k)


def words(text: Column) -> Column:
    """Distinct lower-case ASCII words."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9_]+"), F.lit(0)))


def _meet(queries: DataFrame, docs: DataFrame, score: Callable[..., tuple[np.ndarray, np.ndarray]], k: int, rows: int = 4096, block: int = 1024) -> DataFrame:
    """(query_id, doc_id, score): of each shard of documents the k best of each query that share a term with it.

    ``docs`` has doc_id, ids (hashes of terms, sorted) and size, ``queries`` has query_id, ids, weights and size.  The documents
    are dealt to shards of about ``rows``, each shuffled once; the queries are packed into blocks of about ``block``, and
    each block goes to every shard.  A shard is an inverted index of its own, so only k rows per query and shard are
    shuffled for the ranking, whatever common terms they share.  ``score`` takes, for one query, the
    document and the query's term of each posting hit, the query and the documents' sizes, and gives documents and scores.
    """
    shards = max(1, -(-docs.count() // rows))
    blocks = max(1, -(-queries.count() // block))
    dealt = docs.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    packed = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).groupBy("block").agg(F.collect_list(F.struct("query_id", "ids", "weights", "size")).alias("qs"))
    sent = packed.select("qs", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    kinds = dict(queries.dtypes)["query_id"], dict(docs.dtypes)["doc_id"]

    def one(key, d: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        names, lists, sizes = d["doc_id"].to_numpy(), d["ids"].to_numpy(), d["size"].to_numpy()
        n = len(names)
        out_q, out_d, out_s = [], [], []
        if n and len(q):
            flat = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists])
            owner = np.repeat(np.arange(n), [len(x) for x in lists])
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            for qs in q["qs"]:
                for one_q in qs:
                    ids = np.asarray(one_q["ids"], dtype=np.int64)
                    begin, end = np.searchsorted(flat, ids, "left"), np.searchsorted(flat, ids, "right")
                    lengths = end - begin
                    if not lengths.sum():
                        continue
                    at = np.repeat(begin - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(lengths.sum())
                    found, total = score(owner[at], np.repeat(np.arange(len(ids)), lengths), one_q, sizes)
                    best = np.lexsort((names[found], -total))[:k]
                    out_q += [one_q["query_id"]] * len(best)
                    out_d += names[found[best]].tolist()
                    out_s += total[best].tolist()
        return pd.DataFrame({"query_id": pd.Series(out_q, dtype=object), "doc_id": pd.Series(out_d, dtype=object), "score": pd.Series(out_s, dtype="float64")})

    return dealt.groupBy("shard").cogroup(sent.groupBy("shard")).applyInPandas(one, f"query_id {kinds[0]}, doc_id {kinds[1]}, score double")


def _hashed(terms: str) -> Column:
    return F.array_sort(F.transform(terms, lambda t: F.xxhash64(t)))


def jaccard_topk(queries: DataFrame, docs: DataFrame, k: int, terms: str = "terms", pad: bool = False) -> DataFrame:
    """(query_id, doc_id, score, rank) by the Jaccard likeness of term sets.

    ``queries`` has query_id and the terms, ``docs`` doc_id and the terms.  Documents that share nothing score 0 and are
    given only with ``pad``: then the smallest doc_ids fill up to k, as a full scan would.
    """
    q = queries.select("query_id", _hashed(terms).alias("ids"), F.array().cast("array<double>").alias("weights"), F.size(terms).alias("size"))
    d = docs.select("doc_id", _hashed(terms).alias("ids"), F.size(terms).alias("size"))

    def likeness(owner: np.ndarray, term: np.ndarray, query: dict, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        common = np.bincount(owner, minlength=len(sizes))
        found = np.flatnonzero(common)
        return found, common[found] / (query["size"] + sizes[found] - common[found])

    scored = _meet(q, d, likeness, k)
    if pad:
        # the k smallest ids fill up what k hits leave open: of those k at most the hits themselves are passed over
        firsts = docs.select("doc_id").orderBy("doc_id").limit(2 * k).agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
        fill = queries.select("query_id").join(F.broadcast(firsts)).select("query_id", F.explode("ids").alias("doc_id"), F.lit(0.0).alias("score"))
        scored = scored.unionByName(fill).groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))
    return top_k(scored, k)


def import_examples(docs: DataFrame, text: str = "pre") -> DataFrame:
    """Adds the import features of each example as its terms."""
    return docs.withColumn("terms", import_features(F.col(text)))


def bm25_weights(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(t, idf): the weight of each term's hash over all documents.

    A term in more than half of the documents would weigh below zero; it gets a quarter of the mean weight instead.
    """
    df = docs.select(F.explode(F.array_distinct(_hashed(tokens))).alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    stats = docs.agg(F.count("*").alias("n"))
    raw = df.join(F.broadcast(stats)).withColumn("idf", F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    mean = raw.agg(F.avg("idf").alias("mean"))
    return raw.join(F.broadcast(mean)).select("t", F.when(F.col("idf") < 0, 0.25 * F.col("mean")).otherwise(F.col("idf")).alias("idf"))


def bm25_topk(queries: DataFrame, docs: DataFrame, k: int, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """(query_id, doc_id, score, rank); ``queries`` and ``docs`` have tokens, a repeated query token counts again."""
    asked = queries.select("query_id", F.explode(_hashed("tokens")).alias("t")).groupBy("query_id", "t").agg(F.count("*").alias("qf")).join(bm25_weights(docs), "t")
    mean = docs.agg(F.avg(F.size("tokens")).alias("m"))
    pairs = F.array_sort(F.collect_list(F.struct("t", (F.col("qf") * F.col("idf")).alias("w"))))
    whole = asked.groupBy("query_id").agg(pairs.alias("p")).join(F.broadcast(mean))
    q = whole.select("query_id", F.transform("p", lambda x: x["t"]).alias("ids"), F.transform("p", lambda x: x["w"]).alias("weights"), F.col("m").alias("size"))
    q = durable(q)  # counted and sent
    d = docs.select("doc_id", _hashed("tokens").alias("ids"), F.size("tokens").alias("size"))

    def bm25(owner: np.ndarray, term: np.ndarray, query: dict, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(sizes)
        code, tf = np.unique(term * n + owner, return_counts=True)
        term, owner = code // n, code % n
        value = np.asarray(query["weights"])[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * sizes[owner] / query["size"]))
        found = np.unique(owner)
        return found, np.bincount(owner, weights=value, minlength=n)[found]

    return top_k(_meet(q, d, bm25, k), k)


def vector_topk(queries: DataFrame, vectors: DataFrame, k: int, metric: str = "cosine", block: int = 1024, rows: int = 4096) -> DataFrame:
    """(query_id, vec_id, score, rank) by brute force in blocks.

    The vectors are dealt to chunks of about ``rows``, each shuffled once; the query vectors are packed into blocks of
    ``block``, which go to every chunk.  A chunk scores a block at a time with one matrix product, keeping k per query, so
    that only k rows per query and chunk are shuffled.  metric: cosine, or
    l2, whose score is 1 - squared distance and may be negative.
    """
    chunks = max(1, -(-vectors.count() // rows))
    pieces = max(1, -(-queries.count() // block))
    packed = queries.select("query_id", "embedding").withColumn("b", F.pmod(F.xxhash64("query_id"), F.lit(pieces)))
    blocks = packed.groupBy("b").agg(F.collect_list(F.struct("query_id", "embedding")).alias("qs"))
    data = vectors.select("vec_id", "embedding").groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk")).agg(F.collect_list(F.struct("vec_id", "embedding")).alias("vs"))
    both = data.join(blocks.select("qs", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")).hint("shuffle_hash"), "chunk")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for qs, vs in rows:
            qm = np.array([q["embedding"] for q in qs], dtype=np.float64)
            vm = np.array([v["embedding"] for v in vs], dtype=np.float64)
            ids = np.array([v["vec_id"] for v in vs])
            dot = qm @ vm.T
            if metric == "cosine":
                score = dot / (np.linalg.norm(qm, axis=1)[:, None] * np.linalg.norm(vm, axis=1)[None, :])
            else:
                score = 1 - ((qm**2).sum(1)[:, None] + (vm**2).sum(1)[None, :] - 2 * dot)
            for i, q in enumerate(qs):
                order = np.lexsort((ids, -score[i]))[:k]
                for j in order:
                    yield q["query_id"], int(ids[j]), float(score[i, j])

    return top_k(map_rows(both.select("qs", "vs"), run, "query_id long, vec_id long, score double"), k, tie="vec_id")


def regroup_chunks(hits: DataFrame, how: str = "max") -> DataFrame:
    """(query_id, doc_id, score, chunks): chunk hits gathered per document, by the best or the sum of scores."""
    score = F.max("score") if how == "max" else F.sum("score")
    return hits.groupBy("query_id", "doc_id").agg(score.alias("score"), F.array_sort(F.collect_list(F.struct(F.col("chunk_index"), F.col("score")))).alias("chunks"))


def chunk_search(hits: DataFrame, k: int, overfetch: int = 3) -> DataFrame:
    """The best k documents of the best ``overfetch`` k chunks of each query."""
    return top_k(regroup_chunks(top_k(hits, overfetch * k, tie="chunk_id").drop("rank")), k)


def fuse(first: DataFrame, second: DataFrame, w1: float = 0.6, w2: float = 0.4, cut: int | None = None) -> DataFrame:
    """Weighted sum of two result lists (query_id, doc_id, score, rank); a side that lacks a document scores 0.

    Ties: documents of the first list in its order, then those of the second.
    """
    a = first.select("query_id", "doc_id", F.col("score").alias("s1"), F.col("rank").alias("r1"))
    b = second.select("query_id", "doc_id", F.col("score").alias("s2"), F.col("rank").alias("r2"))
    both = a.join(b, ["query_id", "doc_id"], "full_outer")
    total = both.withColumn("score", F.coalesce("s1", F.lit(0.0)) * w1 + F.coalesce("s2", F.lit(0.0)) * w2)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("r1").asc_nulls_last(), F.col("r2").asc_nulls_last())
    ranked = total.withColumn("rank", F.row_number().over(order)).select("query_id", "doc_id", "score", "rank")
    return ranked.where(F.col("rank") <= cut) if cut else ranked


def blend(bm25: DataFrame, cosine: DataFrame, alpha: float = 0.6, cut: int | None = None) -> DataFrame:
    """alpha times the BM25 score scaled to 0..1 per query, plus the rest of the cosine."""
    span = Window.partitionBy("query_id")
    width = F.max("score").over(span) - F.min("score").over(span)
    scaled = bm25.withColumn("score", F.when(width > 0, (F.col("score") - F.min("score").over(span)) / width).otherwise(1.0))
    return fuse(scaled, cosine, alpha, 1 - alpha, cut)


def enrich(rows: DataFrame, fused: DataFrame, examples: DataFrame) -> DataFrame:
    """Adds similar_examples in rank order; import examples are left out only after the fusion.

    ``rows`` has query_id; rows without a hit get an empty list.
    """
    info = fused.join(examples.where("type <> 'Import'").select("doc_id", "code_snippet", "parent_text"), "doc_id")
    gathered = info.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("doc_id").alias("id"), "score", "code_snippet", "parent_text"))).alias("similar_examples"))
    empty = F.expr("cast(array() as array<struct<rank:int,id:bigint,score:double,code_snippet:string,parent_text:string>>)")
    return rows.join(gathered, "query_id", "left").withColumn("similar_examples", F.coalesce("similar_examples", empty))


def split_text(text: str, size: int, overlap: int, separators: tuple[str, ...]) -> list[str]:
    """Pieces of at most ``size`` signs, cut at the first separator that occurs and packed with ``overlap``.

    A separator stays at the start of the piece behind it; a piece too long is cut by the later separators, or kept
    when none is left.
    """
    sep, rest = next(((s, separators[i + 1 :]) for i, s in enumerate(separators) if s == "" or s in text), (None, ()))
    if sep is None:
        parts = [text]
    elif sep == "":
        parts = list(text)
    else:
        bits = text.split(sep)
        parts = [p for p in [bits[0], *(sep + b for b in bits[1:])] if p]
    out: list[str] = []
    window: list[str] = []
    total = 0

    def emit() -> None:
        joined = "".join(window).strip()
        if joined:
            out.append(joined)

    for part in parts:
        if len(part) >= size and (rest or len(part) > size):
            if window:
                emit()
                window, total = [], 0
            out += split_text(part, size, overlap, rest) if rest else [part.strip()] if part.strip() else []
            continue
        if total + len(part) > size and window:
            emit()
            while window and (total > overlap or total + len(part) > size):
                total -= len(window.pop(0))
        window.append(part)
        total += len(part)
    if window:
        emit()
    return out


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 256, overlap: int = 50, separators: tuple[str, ...] = INDEX_SEPARATORS) -> DataFrame:
    """(chunk_id, doc_id, chunk_index, total_chunks, document); null and blank texts have no chunk."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, body in rows:
            found = split_text(body, size, overlap, separators) if body else []
            for i, piece in enumerate(found):
                yield f"{doc}_chunk_{i}", doc, i, len(found), piece

    return map_rows(docs.select(F.col(key).alias("doc_id"), text), run, f"chunk_id string, doc_id {dict(docs.dtypes)[key]}, chunk_index int, total_chunks int, document string")


def code_query_tokens(text: Column) -> Column:
    return code_tokens(text)


def prompt(question: Column, contexts: Column, instruction: str = "Answer from the context.") -> Column:
    """The instruction, the contexts in order, then the question."""
    return F.concat_ws("\n\n", F.lit(instruction), F.array_join(contexts, "\n---\n"), F.concat(F.lit("Question: "), question))
