"""Ranked lexical search: summed accumulators of short lists beside document-at-a-time skipping.

Terms are runs of ASCII letters, digits and characters beyond ASCII; only A-Z
is folded. One pass over the documents keeps, per document, its length and the
(term, frequency) pairs of the queries' vocabulary: a document-partitioned
index, stored. Collection figures follow from it in grouped counts.

Each task then reads its documents in blocks, turns a block into posting lists
with integer impacts, and ranks every query over it in two steps:

* the *short* lists of a query (those under ``SHORT_SHARE`` of the block) are
  read term by term and summed into accumulators, sorted by document;
* the accumulators are one more list with a known largest sum. That list and
  the long lists are read together, a range of documents at a time in document
  order. A range whose largest impacts do not reach the query's threshold (its
  k-th best score so far) is skipped; in the others, lists that cannot lift a
  document to the threshold by themselves are only probed for the candidates
  of the other lists, the strongest first, and candidates fall out as soon as
  what is left cannot lift them. Bounds are compared strictly, so equal scores
  are never lost.

Scale: texts and postings are never shuffled; a task sends its k best per query.
They are merged in two steps, by (query, bucket of documents), then by query,
so no task meets all of a query's candidates. Queries are a stated set: they
are dealt into blocks of at most ``BLOCK_CHARS`` characters, each matched
against all documents with an index of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import slices, stored, text_or_empty, utf8_values

TOP = 50
BLOCK_CHARS = 8_000_000  # most characters of queries that go to the tasks at once
BLOCK_POSTINGS = 1 << 21  # postings that a task ranks at once
RANGE = 4096  # documents read together
SHORT_SHARE = 1 / 16  # of a block's documents
BUCKETS = 64  # of documents, in the first merge
NO_ID = (1 << 63) - 1  # stands for a null id, which comes last

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
FOLD = bytes(32 if c in _SEPARATORS else c + 32 if 65 <= c <= 90 else c for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, in order, with repeats."""
    return text.translate(FOLD).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_norms(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """100 - 50 + ((50 * n * N) div L) of every document, in exact integers."""
    sizes, which = np.unique(n, return_inverse=True)
    return np.array([50 + (50 * int(s) * documents) // length for s in sizes], np.int64)[which]


def index_documents(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs): length in terms, and the document's terms of ``vocabulary`` with their frequencies."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    given = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        wide = max(len(known), 1)
        for b in slices(batches):
            lengths, found = np.zeros(b.num_rows, np.int64), []
            for i, text in enumerate(utf8_values(b.column(1))):
                words = terms(text)
                lengths[i] = len(words)
                found.append(np.fromiter((k for w in words if (k := known.get(w)) is not None), np.int64) + i * wide)
            key, tf = np.unique(np.concatenate(found), return_counts=True)
            ends = np.searchsorted(key, np.arange(b.num_rows + 1) * wide).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in (key % wide, tf)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lengths), *lists], names=["id", "n", "terms", "tfs"])

    return given.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>")


class Best:
    """The ``k`` best (score, id) of one query: higher scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def threshold(self) -> int:
        """Scores below it cannot enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate((self.score, score)), np.concatenate((self.id, ids))
        order = np.lexsort((ids, -score))[: self.k]
        self.score, self.id = score[order], ids[order]


class PostingBlock:
    """Posting lists of a block of documents; places are document numbers inside the block, ascending."""

    def __init__(self, ids: np.ndarray, norms: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray):
        self.ids = ids
        order = np.argsort(term, kind="stable")
        term, self.doc, tf = term[order], doc[order], tf[order].astype(np.int64)
        self.impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * norms[self.doc]))
        self.ends = np.searchsorted(term, np.arange(len(weights) + 1))
        self.cuts = np.arange(0, len(ids) + RANGE, RANGE)  # ranges of documents

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.ends[term], self.ends[term + 1]
        return self.doc[a:b], self.impact[a:b]

    def rank(self, query: np.ndarray, best: Best) -> None:
        """Offer the block's documents for the distinct terms of ``query``."""
        lists = [x for t in query.tolist() if len((x := self.list_of(t))[0])]
        if not lists:
            return
        short = [x for x in lists if len(x[0]) <= SHORT_SHARE * len(self.ids)]
        cursors = [x for x in lists if len(x[0]) > SHORT_SHARE * len(self.ids)]
        if short:
            places, which = np.unique(np.concatenate([d for d, _ in short]), return_inverse=True)
            sums = np.zeros(len(places), np.int64)
            np.add.at(sums, which, np.concatenate([i for _, i in short]))
            cursors.append((places, sums))
        at = np.array([np.searchsorted(d, self.cuts) for d, _ in cursors])
        # the largest impact of every list in every range; empty ranges have none
        most = np.zeros((len(cursors), len(self.cuts) - 1), np.int64)
        for k, (_, impact) in enumerate(cursors):
            filled = np.flatnonzero(at[k, 1:] > at[k, :-1])
            most[k, filled] = np.maximum.reduceat(impact, at[k, filled])
        for r in np.flatnonzero(most.sum(axis=0) >= best.threshold).tolist():
            self._range(cursors, at[:, r], at[:, r + 1], most[:, r], int(self.cuts[r]), best)

    def _range(self, cursors: list, lo: np.ndarray, hi: np.ndarray, most: np.ndarray, first: int, best: Best) -> None:
        least = best.threshold
        order = np.argsort(most)
        lift = np.cumsum(most[order])  # what the weakest lists can give together
        if lift[-1] < least:
            return
        probed = int(np.searchsorted(lift, least))  # so many lists cannot reach the threshold together
        score = np.zeros(min(RANGE, len(self.ids) - first), np.int64)
        for k in order[probed:].tolist():
            d, impact = cursors[k]
            score[d[lo[k] : hi[k]] - first] += impact[lo[k] : hi[k]]
        # a document of none of these lists cannot reach the threshold
        some = np.flatnonzero(score)
        total = score[some]
        for j in range(probed - 1, -1, -1):
            stay = total + lift[j] >= least
            some, total = some[stay], total[stay]
            if not len(some):
                return
            k = int(order[j])
            d, impact = cursors[k]
            own = d[lo[k] : hi[k]]
            if len(own):
                place = np.minimum(np.searchsorted(own, some + first), len(own) - 1)
                total = total + np.where(own[place] == some + first, impact[lo[k] : hi[k]][place], 0)
        stay = total >= least
        if stay.any():
            best.add(total[stay], self.ids[some[stay] + first])


def rank_documents(index: DataFrame, queries: list[np.ndarray], weights: np.ndarray, documents: int, length: int, top: int) -> DataFrame:
    """(query, id, score): the ``top`` best documents of every query, per task."""
    shared = index.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, w = shared.value
        best = [Best(top) for _ in asked]
        held, size = [], 0

        def finish() -> None:
            ids, n, counts = (np.concatenate([h[k] for h in held]) for k in range(3))
            term, tf = (np.concatenate([h[k] for h in held]) for k in (3, 4))
            block = PostingBlock(ids, length_norms(n, documents, length), np.repeat(np.arange(len(ids)), counts), term, tf, w)
            for q, b in zip(asked, best):
                block.rank(q, b)
            held.clear()

        for batch in batches:
            for b in slices([batch]):
                lists, tfs = b.column(2), b.column(3)
                counts = lists.value_lengths().to_numpy(zero_copy_only=False)
                keep = counts > 0
                ids, n = b.column(0).to_numpy(), b.column(1).to_numpy()
                held.append((ids[keep], n[keep], counts[keep], lists.flatten().to_numpy(), tfs.flatten().to_numpy()))
                size += int(counts.sum())
                if size >= BLOCK_POSTINGS:
                    finish()
                    size = 0
        if size:
            finish()
        query = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        columns = [query, *(np.concatenate([getattr(b, c) for b in best] or [query]) for c in ("id", "score"))]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["query", "id", "score"])

    return index.mapInArrow(run, "query long, id long, score long")


def query_blocks(queries: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list]:
    """Rows (id, text) of the queries in blocks, in a fixed order."""
    own = queries.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    blocks = -(-(own.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars)
    for b in range(blocks):
        rows = own.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()
        yield sorted(rows, key=lambda r: (r.id is None, r.id or 0, r.text))


def search(
    docs: DataFrame,
    queries: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
    top: int = TOP,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(``query_id``, rank, ``id_col``, score): each query's ``top`` best documents with a score above 0.

    Equal scores go by ascending document id, null ids last. Document ids are
    integers. Null texts have no terms; a query without terms, or without a
    document, has no rows. Every row is a document, and every row of
    ``queries`` a query of its own, repeated ids and rows included; other
    columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    kind = queries.schema[query_id].dataType
    out = None
    for rows in query_blocks(queries, query_id, query_text, block_chars):
        asked = [sorted(set(terms(r.text.encode()))) for r in rows]
        vocabulary = {w: k for k, w in enumerate(sorted({w for q in asked for w in q}))}
        index = stored(index_documents(docs, vocabulary, id_col, text_col), "search-index")
        total = index.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
        if not total.documents or not vocabulary:
            continue
        # one number per term of the block's queries
        holding = {r.t: r.n for r in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}
        weights = np.array([weight(total.documents, holding.get(k, 0)) for k in range(len(vocabulary))], np.int64)
        numbers = [np.array([vocabulary[w] for w in q], np.int64) for q in asked]
        found = stored(rank_documents(index, numbers, weights, total.documents, total.length, top), "search-best")
        order = [F.col("score").desc(), F.col("id")]
        some = Window.partitionBy("query", F.pmod(F.xxhash64("id"), F.lit(BUCKETS))).orderBy(*order)
        every = Window.partitionBy("query").orderBy(*order)
        merged = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
        merged = merged.withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(k, r.id) for k, r in enumerate(rows)], "query long, name string" if kind.simpleString() == "string" else "query long, name long")
        result = merged.join(F.broadcast(names), "query").select(
            F.col("name").cast(kind).alias(query_id), "rank", F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), "score"
        )
        out = result if out is None else out.unionAll(result)
    if out is None:
        return queries.limit(0).select(
            F.col(f"`{query_id}`").alias(query_id), F.lit(0).alias("rank"), F.lit(None).cast("long").alias(id_col), F.lit(0).cast("long").alias("score")
        )
    return out
