"""Ranked lexical search by the Best Position Algorithm.

Every query term has an impact list: the documents that hold the term, by falling
contribution to a score. A query reads the lists of its terms in step, from the
top. A document met in one list is at once scored from all of them by direct
access, and its places in all lists count as seen. A list's best position is the
end of its unbroken run of seen places, which direct accesses push beyond the last
place read. A document not met yet stands at best right behind the best positions,
so the impacts there add up to the most it can score; a query stops when that is
strictly below the last score that it keeps.

The lists are cut by documents: a task holds those of a bounded piece of its rows,
and what its earlier pieces found already stops the later ones. Only the best few
documents of each query leave a task, and they are merged in two steps.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagweave.llm.common import documents, slim, to_batch
from tagweave.sources.tables import materialize

BEST = 10
# Bytes of distinct query terms that a task holds; more queries are answered block by block.
BLOCK_BYTES = 8_000_000
# (document, term) entries of the impact lists that a task holds at a time.
PIECE_ENTRIES = 2_000_000
# Places read from each list in the first round; every round reads twice as many.
FIRST_DEPTH = 16
MERGE_LANES = 64
# Stands for a missing id inside a task, behind all others.
ABSENT = np.iinfo(np.int64).max

# A-Z are lower-cased, other ASCII characters but digits and letters separate terms.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass(frozen=True)
class Block:
    """Queries that are answered together: ``starts[i]:starts[i + 1]`` are the terms of query i."""

    ids: list[int | None]
    numbers: list[int]
    starts: np.ndarray
    terms: np.ndarray
    known: dict[bytes, int]


def _blocks(queries: DataFrame, block_bytes: int) -> Iterator[Block]:
    """Queries in blocks of about ``block_bytes`` of distinct terms, one query at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(x))) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(pa.binary())), pa.array([sum(map(len, x)) + 8 * len(x) for x in found], pa.int64())],
                names=["id", "terms", "size"],
            )

    found = queries.mapInArrow(run, "id long, terms array<binary>, size long").where("size > 0")
    found = materialize(found.withColumn("number", F.monotonically_increasing_id()), "queries")
    total = found.agg(F.sum("size")).first()[0] or 0
    n = -(-total // block_bytes)
    for block in range(n):
        rows = found.where(F.pmod(F.xxhash64("number"), F.lit(n)) == block).collect()
        known: dict[bytes, int] = {}
        terms = [[known.setdefault(bytes(t), len(known)) for t in r["terms"]] for r in rows]
        starts = np.cumsum([0, *map(len, terms)])
        flat = np.fromiter((t for x in terms for t in x), np.int64, int(starts[-1]))
        if rows:
            yield Block([r["id"] for r in rows], [r["number"] for r in rows], starts, flat, known)


def _postings(docs: DataFrame, known) -> DataFrame:
    """``doc_id, n, terms, times``: each document with a term, its length, and how often it holds which query terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in batches:
            ids, n, terms, times = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = terms_of(text)
                if words:
                    held = [(t, c) for w, c in Counter(words).items() if (t := number(w)) is not None]
                    ids.append(doc_id)
                    n.append(len(words))
                    terms.append([t for t, _ in held])
                    times.append([c for _, c in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "times"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, times array<long>")


def term_weight(df: Column, n_docs: Column) -> Column:
    return F.floor(1000 * F.ln((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The ``k`` best documents so far: higher scores first, then smaller ids, none of score 0."""

    def __init__(self, k: int) -> None:
        self.k, self.score, self.id = k, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def last(self) -> int | None:
        """The last score kept, when there are ``k``."""
        return int(self.score[-1]) if len(self.score) == self.k else None

    def offer(self, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= max(1, self.last or 1)
        if good.any():
            score, ids = np.concatenate((self.score, score[good])), np.concatenate((self.id, ids[good]))
            top = np.lexsort((ids, -score))[: self.k]
            self.score, self.id = score[top], ids[top]


class ImpactLists:
    """The impact lists of a piece of documents, with direct access by document.

    ``entries`` are sorted by document; ``order`` sorts them by term, then by
    falling impact, and ``place`` says where each entry stands in that order.
    """

    def __init__(self, owner: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.term, self.impact = term, impact
        self.doc_start = np.searchsorted(owner, np.arange(n_docs + 1))
        order = np.lexsort((-impact, term))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.listed_doc, self.listed_impact = owner[order], impact[order]
        self.list_start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self._seen = np.zeros(len(order), bool)
        self._met = np.zeros(n_docs, bool)
        self._asked = np.zeros(n_terms, bool)

    def _entries_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All entries of some documents, and the index into ``docs`` of each."""
        first, count = self.doc_start[docs], self.doc_start[docs + 1] - self.doc_start[docs]
        owner = np.repeat(np.arange(len(docs)), count)
        ends = np.cumsum(count)
        return np.arange(len(owner)) + np.repeat(first - (ends - count), count), owner

    def search(self, terms: np.ndarray, best: Best, ids: np.ndarray) -> int:
        """Offer ``best`` all documents that can be among its best; returns how many were scored."""
        begin, end = self.list_start[terms], self.list_start[terms + 1]
        lists = end > begin
        begin, end, asked = begin[lists], end[lists], terms[lists]
        if not len(asked):
            return 0
        self._asked[asked] = True
        read, seen_to, depth, met = begin.copy(), begin.copy(), FIRST_DEPTH, []
        while True:
            stop = np.minimum(read + depth, end)
            count = stop - read
            ends = np.cumsum(count)
            places = np.arange(ends[-1]) + np.repeat(read - (ends - count), count)
            docs = self.listed_doc[places]
            docs = np.unique(docs[~self._met[docs]])
            if len(docs):
                self._met[docs] = True
                met.append(docs)
                entries, owner = self._entries_of(docs)
                held = self._asked[self.term[entries]]
                entries, owner = entries[held], owner[held]
                self._seen[self.place[entries]] = True
                score = np.zeros(len(docs), np.int64)
                np.add.at(score, owner, self.impact[entries])
                best.offer(score, ids[docs])
            read, depth = stop, 2 * depth
            for i in np.flatnonzero(seen_to < end):
                run = self._seen[seen_to[i] : end[i]]
                first = int(np.argmin(run))
                seen_to[i] = end[i] if run[first] else seen_to[i] + first
            open_ = seen_to < end
            bound = int(self.listed_impact[seen_to[open_]].sum())
            if not open_.any() or best.last is not None and bound < best.last or best.last is None and bound == 0:
                break
        for b, e in zip(begin, end, strict=True):
            self._seen[b:e] = False
        self._asked[asked] = False
        scored = np.concatenate(met)
        self._met[scored] = False
        return len(scored)


def _pieces(batches: Iterator[pa.RecordBatch], entries: int) -> Iterator[pa.Table]:
    """Rows in pieces of about so many entries."""
    held, size = [], 0
    for batch in batches:
        at = 0
        ends = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
        while at < len(batch):
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + entries - size, "right")))
            held.append(batch.slice(at, stop - at))
            size += int(ends[stop - 1]) - before
            at = stop
            if size >= entries or at < len(batch):
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _tops(postings: DataFrame, shared, n_docs: int, n_terms: int, k: int, entries: int) -> DataFrame:
    """Each task's best documents of each query of the block."""
    schema = "query long, id long, doc_id long, score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = shared.value
        best = [Best(k) for _ in block.ids]
        for piece in _pieces(batches, entries):
            ids = piece.column("doc_id").fill_null(ABSENT).to_numpy()
            m = np.array([10 + 90 * n * n_docs // n_terms for n in piece.column("n").to_pylist()], np.int64)
            listed, times = piece.column("terms").combine_chunks(), piece.column("times").combine_chunks()
            owner = np.repeat(np.arange(len(ids)), listed.value_lengths().to_numpy(zero_copy_only=False))
            term, tf = listed.flatten().to_numpy(), times.flatten().to_numpy()
            impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
            lists = ImpactLists(owner, term, impact, len(ids), len(weight))
            for q, b in enumerate(best):
                lists.search(block.terms[block.starts[q] : block.starts[q + 1]], b, ids)
        columns = {
            "query": np.repeat(block.numbers, [len(b.id) for b in best]).astype(np.int64),
            "id": [i for i, b in zip(block.ids, best, strict=True) for _ in b.id],
            "doc_id": [None if x == ABSENT else x for b in best for x in b.id.tolist()],
            "score": [x for b in best for x in b.score.tolist()],
        }
        yield to_batch(columns, schema)

    return postings.mapInArrow(run, schema)


def rank_documents(
    queries: DataFrame,
    docs: DataFrame,
    k: int = BEST,
    query_id: str = "item_id",
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    piece_entries: int = PIECE_ENTRIES,
) -> DataFrame:
    """``<query_id>, rank, <doc_id>, score``: the ``k`` best documents of each row of ``queries``.

    Equal scores are ordered by id. Null texts and texts without terms match
    nothing and, as documents, do not count in the statistics. Rows with the same
    id, or with none, are documents or queries of their own; a document without
    id comes last among equals. Empty tables give an empty table, and further
    columns are ignored. Documents are read once per block of queries; a block
    holds the terms of at least one query, so one query's distinct terms must fit
    into a task.
    """
    spark = docs.sparkSession
    docs = slim(docs, doc_id, text)
    found = []
    for block in _blocks(slim(queries, query_id, text), block_bytes):
        postings = materialize(_postings(docs, spark.sparkContext.broadcast(block.known)), "postings")
        n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        # As many rows as the block has terms, so bounded as it is.
        counted = postings.select(F.explode_outer("terms").alias("term")).where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("df"))
        weight = np.zeros(len(block.known), np.int64)
        for term, w in counted.select("term", term_weight(F.col("df"), F.lit(n_docs))).collect():
            weight[term] = w
        shared = spark.sparkContext.broadcast((block, weight))
        found.append(materialize(_tops(postings, shared, n_docs, n_terms, k, piece_entries), "tops"))
    if not found:
        return spark.createDataFrame([], f"{query_id} long, rank int, {doc_id} long, score long")
    tops = found[0]
    for more in found[1:]:
        tops = tops.unionByName(more)
    by = [F.desc("score"), F.asc_nulls_last("doc_id")]
    lane = F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_LANES))
    tops = tops.withColumn("place", F.row_number().over(Window.partitionBy("query", lane).orderBy(*by))).where(F.col("place") <= k)
    ranked = tops.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*by))).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias(query_id), "rank", F.col("doc_id").alias(doc_id), "score")


def op13_best_positions(spark: SparkSession, folder: str) -> DataFrame:
    return rank_documents(spark.read.parquet(f"{folder}/benchmark.parquet"), documents(spark, folder))


_SQL_TERMS = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')"

OP13_SQL = f"""
WITH counted AS (SELECT row, doc_id, term, count(*) AS tf FROM (
  SELECT d.row, d.doc_id, u.term FROM (SELECT row_number() OVER () AS row, doc_id, {_SQL_TERMS} AS terms FROM documents) d, unnest(d.terms) AS u(term)
) GROUP BY ALL),
lengths AS (SELECT row, sum(tf) AS n FROM counted GROUP BY row),
totals AS (SELECT count(*) AS docs, sum(n) AS terms FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), totals
),
impacts AS (
  SELECT c.row, c.doc_id, c.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))) AS impact
  FROM counted c JOIN lengths USING (row) JOIN weights USING (term), totals
),
asked AS (
  SELECT DISTINCT item, item_id, u.term FROM (SELECT row_number() OVER () AS item, item_id, {_SQL_TERMS} AS terms FROM benchmark) b, unnest(b.terms) AS u(term)
),
scored AS (SELECT item, item_id, row, doc_id, sum(impact) AS score FROM asked JOIN impacts USING (term) GROUP BY ALL HAVING sum(impact) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored) WHERE rank <= {BEST}
"""
