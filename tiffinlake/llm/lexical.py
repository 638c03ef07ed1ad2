"""Ranked lexical search with hashed max-sketches.

An index row keeps, besides the text, a small sketch: every term's impact in the document (its
weight times its saturated count) goes to the coordinate that its hash names, and a coordinate keeps the
largest. A query looks its terms up in the sketches of a whole batch; a term can't add more than its
coordinate holds, nor more than its own weight times the largest saturation of the document. The
sum of these limits bounds the document's score. Documents are scored exactly in descending order of their
bounds, until the next bound is below the k-th best score found.

Weights come from all documents. The most frequent terms are sent to the tasks with their weights, so
many at most whatever the corpus; for any other term a sketch takes the largest weight there is,
which keeps its bounds true.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tiffinlake.session import materialize

from .support import lean, small_batches

COORDINATES = 1024
# Terms whose weights every task knows.
FREQUENT = 50_000
# A sketch counts impacts in these units, rounded up.
UNIT = 1 << 20
QUERY_BLOCK = 512  # queries all tasks hold at once
DOCUMENT_BLOCK = 1024  # documents a task compares with them at once, fewer if the queries have many terms
CELLS = 8_000_000
CHUNK_BYTES = 1_000_000
MEMORY = 200_000
# Terms counted in a task before they are passed on.
COUNTED = 300_000

#: A-Z to lower case, all other ASCII characters but digits and a-z to a space; bytes above 127 stay.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(raw: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order and with repeats."""
    return raw.translate(FOLDED).split() if raw else []


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def dampers(sizes: np.ndarray, documents: int, length: int) -> np.ndarray:
    """How much a document's number of terms dampens its counts: 100 at the mean number."""
    return 50 + (50 * sizes * documents) // max(1, length)


def saturated(tf: np.ndarray, damper: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * damper)


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``term``, ``df`` of all terms, and one row of a null term with the number of documents with terms and of all terms."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, documents, length = Counter(), 0, 0
        names = ["term", "df", "documents", "length"]

        def rows() -> pa.RecordBatch:
            zeros = np.zeros(len(seen), dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64()), pa.array(zeros), pa.array(zeros)], names)

        for batch in batches:
            for value in batch.column(0):
                terms = terms_of(value.as_py())
                if terms:
                    documents += 1
                    length += len(terms)
                    seen.update(set(terms))
                    if len(seen) > COUNTED:
                        yield rows()
                        seen.clear()
        yield rows()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), *[pa.array([n], pa.int64()) for n in (0, documents, length)]], names)

    small_batches(docs.sparkSession)
    found = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "term binary, df long, documents long, length long")
    return found.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("df", "documents", "length")])


class Folder:
    """Sketches of documents, with the coordinates and greatest weights of terms already met."""

    def __init__(self, documents: int, length: int, frequent: dict[bytes, int]):
        self.documents, self.length, self.frequent = documents, length, frequent
        self.most = weight(documents, 1) if documents else 0
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.coordinate, self.weight = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _learn(self, terms: list[bytes]) -> None:
        self.index.update(zip(terms, range(len(self.index), len(self.index) + len(terms))))
        self.coordinate = np.r_[self.coordinate, np.array([xxhash.xxh64_intdigest(t) % COORDINATES for t in terms], dtype=np.int64)]
        known = [self.frequent.get(t) for t in terms]
        self.weight = np.r_[self.weight, np.array([self.most if df is None else weight(self.documents, df) for df in known], dtype=np.int64)]

    def fold(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Numbers of terms, largest saturations, and sketches as pairs of coordinate and impact, of a chunk of texts."""
        runs = [terms_of(t) for t in texts]
        sizes = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
        if len(self.index) > MEMORY:
            self._forget()
        new = list(set(chain.from_iterable(runs)).difference(self.index))
        if new:
            self._learn(new)
        flat = np.fromiter(map(self.index.__getitem__, chain.from_iterable(runs)), dtype=np.int64, count=int(sizes.sum()))
        both, tf = np.unique(np.repeat(np.arange(len(runs)), sizes) * max(1, len(self.index)) + flat, return_counts=True)
        doc, term = np.divmod(both, max(1, len(self.index)))
        sat = saturated(tf, dampers(sizes, self.documents, self.length)[doc])
        top = np.zeros(len(runs), dtype=np.int64)
        np.maximum.at(top, doc, sat)
        units = -(-(self.weight[term] * sat) // UNIT)
        place = doc * COORDINATES + self.coordinate[term]
        order = np.argsort(place, kind="stable")
        order = order[units[order] > 0]
        place, units = place[order], units[order]
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, dtype=np.int64)
        pairs = np.empty((len(first), 2), dtype="<u2")
        pairs[:, 0] = place[first] % COORDINATES
        pairs[:, 1] = np.maximum.reduceat(units, first) if len(first) else 0
        ends = np.searchsorted(place[first], np.arange(1, len(runs) + 1) * COORDINATES)
        starts = np.r_[0, ends[:-1]] if len(runs) else ends
        return sizes, top, [pairs[a:b].tobytes() for a, b in zip(starts, ends)]


def small_chunks(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive texts of a bounded size together; a longer text is a chunk of its own."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t or b"") > CHUNK_BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(t or b"")
    if begin < len(texts):
        yield begin, len(texts)


class Index:
    """What a search needs: stored sketches with the texts, the stored statistics, and the two totals."""

    def __init__(self, rows: DataFrame, terms: DataFrame, documents: int, length: int):
        self.rows, self.terms, self.documents, self.length = rows, terms, documents, length


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> Index:
    """Sketches of all whole texts, stored in the shared folder beside the texts.

    A null text has no terms. Rows without an id count in the statistics and are never found, as
    there is nothing to return for them.
    """
    spark = docs.sparkSession
    terms = materialize(statistics(docs, text_col), "terms")
    total = terms.where("term is null").first()
    documents, length = (total["documents"], total["length"]) if total else (0, 0)
    common = terms.where("term is not null").orderBy(F.desc("df"), "term").limit(frequent).select("term", "df")
    shared = spark.sparkContext.broadcast({bytes(r["term"]): r["df"] for r in common.collect()})  # at most ``frequent`` terms

    @lean
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Folder(documents, length, shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in small_chunks(texts):
                sizes, top, sketches = folder.fold(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(top, pa.int64()),
                     pa.array(sketches, pa.binary()), pa.array(texts[a:b], pa.binary())], ["doc_id", "n", "top", "sketch", "text"])

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    rows = rows.mapInArrow(fold, "doc_id long, n long, top long, sketch binary, text binary").where("n > 0")
    return Index(materialize(rows, "sketches"), terms, documents, length)


class Batch:
    """Queries, with the best documents each has met in a task."""

    def __init__(self, asked: list[list[tuple[bytes, int]]], documents: int, length: int, k: int):
        self.documents, self.length, self.k = documents, length, k
        names = sorted({t for terms in asked for t, _ in terms})
        self.vocabulary = {t: i for i, t in enumerate(names)}
        coordinate = np.array([xxhash.xxh64_intdigest(t) % COORDINATES for t in names], dtype=np.int64)
        self.term = [np.array([self.vocabulary[t] for t, _ in terms], dtype=np.int64) for terms in asked]
        self.weight = [np.array([weight(documents, df) for _, df in terms], dtype=np.int64) for terms in asked]
        self.coordinate = [coordinate[t] for t in self.term]
        self.score = np.zeros((len(asked), k), dtype=np.int64)
        self.row = np.full((len(asked), k), np.iinfo(np.int64).max)
        self.block = max(16, min(DOCUMENT_BLOCK, CELLS // max(1, len(names))))
        self.met = self.scored = 0

    def meet(self, ids: np.ndarray, sizes: np.ndarray, top: np.ndarray, sketches: list[bytes], texts: pa.Array) -> None:
        for a in range(0, len(ids), self.block):
            b = min(len(ids), a + self.block)
            self._meet(ids[a:b], sizes[a:b], top[a:b], sketches[a:b], texts.slice(a, b - a))

    def bounds(self, top: np.ndarray, sketches: list[bytes]) -> np.ndarray:
        """Upper bounds of the scores (query, document), in units."""
        counts = np.fromiter(map(len, sketches), dtype=np.int64, count=len(sketches)) // 4
        pairs = np.frombuffer(b"".join(sketches), dtype="<u2").reshape(-1, 2)
        table = np.zeros((COORDINATES, len(sketches)), dtype=np.float32)
        table[pairs[:, 0], np.repeat(np.arange(len(sketches)), counts)] = pairs[:, 1]
        most = (top / UNIT).astype(np.float32)
        out = np.zeros((len(self.term), len(sketches)), dtype=np.float32)
        for q, (where, w) in enumerate(zip(self.coordinate, self.weight)):
            if len(where):
                # Widened by far more than single precision can lose.
                out[q] = np.minimum(table[where], w[:, None].astype(np.float32) * most).sum(axis=0) * np.float32(1.0005)
        return out

    def _meet(self, ids: np.ndarray, sizes: np.ndarray, top: np.ndarray, sketches: list[bytes], texts: pa.Array) -> None:
        bound = self.bounds(top, sketches)
        self.met += bound.size
        alive = (bound > 0) & (bound + 1 >= (self.score[:, -1] // UNIT)[:, None])
        some = np.flatnonzero(alive.any(axis=0))
        if not len(some):
            return
        exact = self._saturations(texts, some, sizes)
        place = np.full(len(ids), -1)
        place[some] = np.arange(len(some))
        for q in np.flatnonzero(alive.any(axis=1)).tolist():
            rows = np.flatnonzero(alive[q])
            rows = rows[np.argsort(-bound[q, rows], kind="stable")]
            at, step = 0, self.k
            while at < len(rows):
                part = rows[at:at + step]
                part = part[bound[q, part] + 1 >= self.score[q, -1] // UNIT]
                if not len(part):
                    break  # bounds only fall from here
                self._keep(q, ids[part], (exact[self.term[q]][:, place[part]] * self.weight[q][:, None]).sum(axis=0))
                self.scored += len(part)
                at, step = at + step, step * 2

    def _saturations(self, texts: pa.Array, some: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Exact saturated counts of the queries' terms (term, document) in some of the documents."""
        out = np.zeros((len(self.vocabulary), len(some)), dtype=np.int64)
        damper = dampers(sizes, self.documents, self.length)
        for j, i in enumerate(some.tolist()):
            counted = Counter(v for v in map(self.vocabulary.get, terms_of(texts[i].as_py())) if v is not None)
            if counted:
                tf = np.fromiter(counted.values(), dtype=np.int64, count=len(counted))
                out[np.fromiter(counted, dtype=np.int64, count=len(counted)), j] = saturated(tf, damper[i])
        return out

    def _keep(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores > 0
        row, score = np.r_[self.row[q], ids[good]], np.r_[self.score[q], scores[good]]
        order = np.lexsort((row, -score))[:self.k]
        self.row[q], self.score[q] = row[order], score[order]

    def found(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        real = self.score[q] > 0
        return self.row[q][real], self.score[q][real]


def search(index: Index, queries: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text", query_block: int = QUERY_BLOCK) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the k best documents with a score above 0 of every query.

    Queries are met in blocks: a block is sent to all tasks, each task keeps k rows a query, and the
    k best of these are the result. Equal scores go to the smaller doc_id. A repeated query has its
    result as often, a query without known terms has none, a null item id stays null.
    """
    spark = queries.sparkSession
    small_batches(spark)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = list(set(terms_of(text.as_py())))
                yield pa.RecordBatch.from_arrays([pa.array([place] * len(terms), pa.int64()), pa.array(terms, pa.binary())], ["place", "term"])

    asked = queries.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("binary").alias("text"))
    asked = materialize(asked.withColumn("place", F.monotonically_increasing_id()), "queries")
    wanted = asked.select("place", "text").mapInArrow(cut, "place long, term binary")
    wanted = materialize(wanted.join(index.terms.select("term", "df"), "term")
                         .groupBy("place").agg(F.sort_array(F.collect_list(F.struct("term", "df"))).alias("terms")), "query-terms")
    blocks = max(1, math.ceil(wanted.count() / query_block))
    out = None
    for at in range(blocks):
        found = _pass(index, wanted.where(F.pmod(F.xxhash64("place"), F.lit(blocks)) == at), k)
        if blocks > 1:
            found = materialize(found, "found")
        out = found if out is None else out.unionByName(found)
    return out.join(asked.select("place", "item_id"), "place").select("item_id", "rank", "doc_id", "score")


def _pass(index: Index, part: DataFrame, k: int) -> DataFrame:
    """The result for one block of queries."""
    documents, length = index.documents, index.length
    block = index.rows.sparkSession.sparkContext.broadcast(
        [(r["place"], [(bytes(t["term"]), t["df"]) for t in r["terms"]]) for r in part.collect()])  # about QUERY_BLOCK texts

    @lean
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Batch([terms for _, terms in block.value], documents, length, k)
        for batch in batches:
            ids, sizes, top = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            mine.meet(ids, sizes, top, batch.column(3).to_pylist(), batch.column(4))
        for q, (place, _) in enumerate(block.value):
            row, score = mine.found(q)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), place)), pa.array(row), pa.array(score)], ["place", "doc_id", "score"])

    near = index.rows.select("doc_id", "n", "top", "sketch", "text").mapInArrow(compare, "place long, doc_id long, score long")
    best = Window.partitionBy("place").orderBy(F.desc("score"), "doc_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
