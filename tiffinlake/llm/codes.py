"""Token ids in directly addressable codes: files in which any token can be read without decoding a block.

An id is cut into chunks, lowest bits first. Level 0 holds the first chunk of every id, level 1 the second
chunk of those ids that have one, and so on; a bitmap beside each level but the last tells which ids continue.
The number of continued ids before a position, which is the position on the next level, comes from a
directory of counts and the few bits after the last count. So reading token i takes one look into each level it has.

A segment is one file: a header, the documents' ids and ends, and the levels. Segments hold whole documents
in ascending order of their ids. Files are written and read by Spark, on whatever file system the folder is on.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from tiffinlake.session import materialize

from .bpe import byte_letters
from .support import kept_by_worker, lean, parts_of, small_batches

MAGIC = b"DACIDS01"
HEAD = "<8s5q"  # magic, part, number within the part, documents, tokens, levels
ID_BITS = 32
# Widths of a chunk in bits that can be read without unpacking neighbours.
WIDTHS = (4, 8, 16, 32)
# Bits of a bitmap between two counts of its directory; a multiple of 8.
RANK_BITS = 512
# Tokens of a segment; a longer document is a segment of its own.
SEGMENT_TOKENS = 1 << 22
# Bytes of the source files for each part of the table.
PART_BYTES = 32 << 20
CHUNK_BYTES = 1_500_000
MEMORY = 400_000


# --- words of a byte-level vocabulary ---------------------------------------------------------------

LETTER, DIGIT, OTHER, SPACE = 1, 2, 3, 4
_CLASS = np.zeros(256, dtype=np.uint8)
for _b in range(128):
    _c = chr(_b)
    _CLASS[_b] = LETTER if _c.isalpha() else DIGIT if _c.isdigit() else SPACE if _c in " \t\n\v\f\r" else OTHER
#: Whether a word ends between two neighbouring classes. Class 0 is for characters not looked into: nothing is cut beside them.
_ENDS = np.zeros((5, 5), dtype=bool)
for _a in (LETTER, DIGIT, OTHER):
    for _b in (LETTER, DIGIT, OTHER, SPACE):
        _ENDS[_a, _b] = _a != _b
NEVER = 0xFF  # no byte of UTF-8
NEVER_BYTE = bytes([NEVER])
#: One word of the vocabulary's own cutting, for certain: a space at most, and letters, or digits, or other characters but the apostrophe.
WORD = re.compile(rb" ?(?:(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc9][\x80-\xbf])+|[0-9]+|[!-&(-/:-@\[-`{-~]+)")
GAP = re.compile(rb"[A-Za-z0-9] (?=[A-Za-z0-9])")


def piece_starts(joined: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin that are joined with a byte after each that never occurs; that byte is a piece of its own.

    Between pieces a byte-level vocabulary ends a word in any case; one piece may be several words.
    A piece begins with white space that follows other characters, and where letters, digits and
    other characters meet, but not after an apostrophe. Only ASCII and the Latin letters of two
    bytes are told apart.
    """
    kind = _CLASS[joined]
    # Lead bytes C3 to C9 begin Latin letters, but for the signs of multiplication and division.
    lead = np.flatnonzero((joined >= 0xC3) & (joined <= 0xC9))
    follow = joined[lead + 1]
    lead = lead[~((joined[lead] == 0xC3) & ((follow == 0x97) | (follow == 0xB7)))]
    kind[lead] = kind[lead + 1] = LETTER
    end = joined == NEVER
    begins = np.ones(len(joined), dtype=bool)
    begins[1:] = (_ENDS[kind[:-1], kind[1:]] & (joined[:-1] != ord("'"))) | end[1:] | end[:-1]
    return np.flatnonzero(begins)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of the entries of lists that begin at ``starts``, one list after the other."""
    if not len(counts):
        return np.zeros(0, dtype=np.int64)
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


class Coder:
    """Ids of texts by the tokenizers library; pieces already met are remembered.

    Pieces are told apart by a hash of their bytes and then compared byte by byte with the first of
    the same hash, so only different ones of a batch are looked up one by one.
    """

    BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.whole = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = dict(enumerate(byte_letters()))
        self.power = self.inverse = np.ones(1, dtype=np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.memory: dict[bytes, int] = {}
        self.ids, self.begin, self.count = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _learn(self, new: list[bytes]) -> None:
        """Words go straight to the library's model, in its letters for bytes; anything else through the whole library."""
        words = [p for p in new if WORD.fullmatch(p)]
        others = list(set(new).difference(words))
        tokenize, feed = self.tokenizer.model.tokenize, self.letters[ord("\n")]
        spelled = b"\n".join(words).decode("latin-1").translate(self.letters).split(feed) if words else []
        coded = [[t.id for t in tokenize(w)] for w in spelled]
        coded += [self.tokenizer.encode(p.decode("utf-8", "replace"), add_special_tokens=False).ids for p in others]
        self.memory.update(zip([*words, *others], range(len(self.memory), len(self.memory) + len(new))))
        count = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        self.begin = np.r_[self.begin, len(self.ids) + np.cumsum(count) - count]
        self.count = np.r_[self.count, count]
        self.ids = np.r_[self.ids, np.fromiter(chain.from_iterable(coded), dtype=np.uint32, count=int(count.sum()))]

    def _hashes(self, joined: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A polynomial of each piece's bytes, from one running sum over all bytes."""
        if len(self.power) < len(joined):
            with np.errstate(over="ignore"):
                self.power = np.cumprod(np.r_[np.uint64(1), np.full(len(joined), self.BASE, dtype=np.uint64)])
                self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(len(joined), pow(self.BASE, -1, 1 << 64), dtype=np.uint64)])
        with np.errstate(over="ignore"):
            sums = np.r_[np.uint64(0), np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * self.power[:len(joined)])]
            return (sums[starts + sizes] - sums[starts]) * self.inverse[starts] + sizes.astype(np.uint64)

    def _entries(self, joined: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The remembered entry of every piece."""
        _, first, same = np.unique(self._hashes(joined, starts, sizes), return_index=True, return_inverse=True)
        rep = first[same]
        alike = np.array_equal(sizes, sizes[rep]) and np.array_equal(joined[ragged(starts, sizes)], joined[ragged(starts[rep], sizes)])
        if not alike:  # two pieces of one hash: all are looked up one by one
            first = same = np.arange(len(starts))
        raw = joined.tobytes()
        shown = [raw[a:b] for a, b in zip(starts[first].tolist(), (starts + sizes)[first].tolist())]
        met = set(shown)
        new = list(met.difference(self.memory))
        if len(self.memory) + len(new) > MEMORY:
            # Keep what this batch has, the frequent pieces among it.
            held = [p for p in met if p in self.memory]
            rows = np.fromiter(map(self.memory.__getitem__, held), dtype=np.int64, count=len(held))
            ids, count = self.ids[ragged(self.begin[rows], self.count[rows])], self.count[rows]
            self.memory = dict(zip(held, range(len(held))))
            self.ids, self.begin, self.count = ids, np.cumsum(count) - count, count
        if new:
            self._learn(new)
        return np.fromiter(map(self.memory.__getitem__, shown), dtype=np.int64, count=len(shown))[same]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        # A text with the string of an added token goes to the library whole; a long one is cut where a word ends in any case.
        parts, owner, out = [], [], [np.zeros(0, dtype=np.uint32)] * len(texts)
        for i, text in enumerate(texts):
            if any(w in text for w in self.whole):
                out[i] = np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, dtype=np.uint32)
            else:
                for part in cut_long(text):
                    parts.append(part)
                    owner.append(i)
        made: dict[int, list[np.ndarray]] = {}
        for chunk in byte_chunks(zip(owner, parts)):
            for (i, _), ids in zip(chunk, self._encode([t for _, t in chunk])):
                made.setdefault(i, []).append(ids)
        for i, found in made.items():
            out[i] = found[0] if len(found) == 1 else np.concatenate(found)
        return out

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        joined = np.frombuffer(b"".join([x for t in texts for x in (t, NEVER_BYTE)]), dtype=np.uint8)
        starts = piece_starts(joined)
        sizes = np.diff(starts, append=len(joined))
        real = joined[starts] != NEVER
        text = np.cumsum(~real)[real]
        starts, sizes = starts[real], sizes[real]
        if not len(starts):
            return [np.zeros(0, dtype=np.uint32)] * len(texts)
        entry = self._entries(joined, starts, sizes)
        count = self.count[entry]
        ids = self.ids[ragged(self.begin[entry], count)]
        per_text = np.bincount(text, weights=count, minlength=len(texts)).astype(np.int64)
        return np.split(ids, np.cumsum(per_text)[:-1])


def cut_long(text: bytes) -> Iterator[bytes]:
    """A text in parts of about a chunk's bytes, cut before a space between two ASCII letters or digits; an unbroken run stays whole."""
    at = 0
    while len(text) - at > 2 * CHUNK_BYTES and (gap := GAP.search(text, at + CHUNK_BYTES)):
        yield text[at:gap.start() + 1]
        at = gap.start() + 1
    yield text[at:]


# --- chunks, bitmaps, ranks -------------------------------------------------------------------------

def best_widths(ids: np.ndarray) -> list[int]:
    """Chunk widths that need the fewest bits for these ids: the cheapest way up the bit lengths."""
    # The exponent of the number as a double is its bit length.
    length = np.bincount(np.maximum((ids.astype(np.float64).view(np.int64) >> 52) - 1022, 0), minlength=ID_BITS + 1)
    longer = np.r_[length[::-1].cumsum()[::-1], 0]  # longer[b]: ids of b bits or more
    most = max(1, int(np.flatnonzero(length).max(initial=1)))
    total = len(ids)
    best: dict[int, tuple[int, list[int]]] = {}
    for start in range(most - 1, -1, -1):  # the cheapest chunks for bits from ``start`` on
        here = total if start == 0 else int(longer[start + 1])
        options = []
        for width in WIDTHS:
            if start + width >= most:
                options.append((here * width, [width]))
            elif start + width in best:
                cost, rest = best[start + width]
                options.append((here * (width + 1) + cost, [width, *rest]))
        best[start] = min(options)
    return best[0][1]


def put(values: np.ndarray, width: int) -> bytes:
    if width == 4:
        low = np.append(values, 0)[:len(values) + len(values) % 2].astype(np.uint8)
        return (low[::2] | low[1::2] << 4).tobytes()
    return values.astype(f"<u{width // 8}").tobytes()


def packed_size(count: int, width: int) -> int:
    return (count * width + 7) // 8


class Level:
    """One level's chunks, and which of them continue on the next."""

    def __init__(self, chunks: np.ndarray, width: int, count: int, bitmap: np.ndarray | None, counts: np.ndarray | None):
        self.chunks, self.width, self.count, self.bitmap, self.counts = chunks, width, count, bitmap, counts

    def take(self, at: np.ndarray) -> np.ndarray:
        if self.width == 4:
            return (self.chunks[at >> 1] >> (4 * (at & 1)).astype(np.uint8) & 15).astype(np.uint32)
        return self.chunks[at].astype(np.uint32)

    def span(self, a: int, b: int) -> np.ndarray:
        if self.width == 4:
            both = self.chunks[a >> 1:(b + 1) >> 1]
            out = np.empty(2 * len(both), dtype=np.uint32)
            out[::2], out[1::2] = both & 15, both >> 4
            return out[a & 1:(a & 1) + b - a]
        return self.chunks[a:b].astype(np.uint32)

    def continues(self, at: np.ndarray) -> np.ndarray:
        return (self.bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def continues_span(self, a: int, b: int) -> np.ndarray:
        bits = np.unpackbits(self.bitmap[a >> 3:(b + 7) >> 3], bitorder="little")
        return bits[a & 7:(a & 7) + b - a].astype(bool)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many positions before these continue: the last count, and the bits from there on."""
        block = at // RANK_BITS
        out = self.counts[block].astype(np.int64)
        where = (block * (RANK_BITS // 8))[:, None] + np.arange(RANK_BITS // 8)
        bits = at[:, None] - where * 8  # bits of each byte that lie before the position
        some = np.minimum(where, max(0, len(self.bitmap) - 1))
        mask = ((1 << np.clip(bits, 0, 8)) - 1).astype(np.uint8)
        return out + np.bitwise_count(self.bitmap[some] & mask).sum(axis=1, dtype=np.int64)


def level_parts(ids: np.ndarray, widths: list[int]) -> Iterator[tuple[int, list[bytes]]]:
    """Number of chunks and the stored bytes of each level."""
    rest = ids.astype(np.uint32)
    for i, width in enumerate(widths):
        last = i == len(widths) - 1
        parts = [put(rest & np.uint32((1 << width) - 1), width)]
        more = rest >> np.uint32(min(width, ID_BITS - 1))
        if not last:
            on = more > 0
            bitmap = np.packbits(on, bitorder="little")
            counted = np.add.reduceat(on, np.arange(0, max(1, len(on)), RANK_BITS), dtype=np.int64) if len(on) else np.zeros(0, dtype=np.int64)
            parts += [bitmap.tobytes(), np.r_[0, np.cumsum(counted)].astype("<u4").tobytes()]
        yield len(rest), parts
        if not last:
            rest = more[on]


def padded(parts: list[bytes]) -> Iterator[bytes]:
    for part in parts:
        yield part + bytes(-len(part) % 8)


def build_segment(part: int, number: int, doc_ids: list[int | None], coded: list[np.ndarray]) -> bytes:
    ids = np.concatenate([np.zeros(0, dtype=np.uint32), *coded])
    widths = best_widths(ids)
    levels = list(level_parts(ids, widths))
    ends = np.cumsum(np.fromiter(map(len, coded), dtype="<i8", count=len(coded)))
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    parts = [struct.pack(HEAD, MAGIC, part, number, len(coded), len(ids), len(levels)), np.array(widths, dtype="<i8").tobytes(),
             np.array([n for n, _ in levels], dtype="<i8").tobytes(), np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
             known.tobytes(), ends.astype("<i8").tobytes()]
    return b"".join(padded([*parts, *[p for _, stored in levels for p in stored]]))


class Segment:
    """A stored segment; ``buffer`` may be bytes or a mapped file. Nothing is decoded before it is asked for."""

    def __init__(self, buffer):
        magic, self.part, self.number, self.documents, self.tokens, levels = struct.unpack_from(HEAD, buffer)
        if magic != MAGIC:
            raise ValueError("not a segment of token ids")
        self.buffer, self.at = buffer, struct.calcsize(HEAD)
        widths, counts = self._next("<i8", levels), self._next("<i8", levels)
        self.doc_ids, self.known, self.ends = self._next("<i8", self.documents), self._next("u1", self.documents), self._next("<i8", self.documents)
        self.levels = []
        for i, (width, count) in enumerate(zip(widths.tolist(), counts.tolist())):
            chunks = self._next("u1", packed_size(count, 4)) if width == 4 else self._next(f"<u{width // 8}", count)
            bitmap = rank = None
            if i < levels - 1:
                bitmap = self._next("u1", (count + 7) // 8)
                rank = self._next("<u4", -(-count // RANK_BITS) + 1)
            self.levels.append(Level(chunks, width, count, bitmap, rank))

    def _next(self, kind: str, count: int) -> np.ndarray:
        out = np.frombuffer(self.buffer, dtype=kind, count=count, offset=self.at)
        self.at += out.nbytes + -out.nbytes % 8
        return out

    def tokens_at(self, positions: np.ndarray) -> np.ndarray:
        """Tokens at any positions, each by one look into every level it has."""
        at = np.asarray(positions, dtype=np.int64)
        out, who, shift = np.zeros(len(at), dtype=np.uint32), np.arange(len(at)), 0
        for level in self.levels:
            out[who] |= level.take(at) << np.uint32(shift)
            if level.bitmap is None:
                break
            on = level.continues(at)
            who, at, shift = who[on], level.rank(at[on]), shift + level.width
        return out

    def span(self, a: int, b: int) -> np.ndarray:
        """Tokens ``a`` to ``b``; their chunks lie together on every level."""
        out, shift, where = np.zeros(b - a, dtype=np.uint32), 0, None
        for level in self.levels:
            chunk = level.span(a, b) << np.uint32(shift)
            if where is None:
                out |= chunk
                where = np.arange(len(out))
            else:
                out[where] |= chunk
            if level.bitmap is None or not len(where):
                break
            where, shift = where[level.continues_span(a, b)], shift + level.width
            a = int(level.rank(np.array([a]))[0])
            b = a + len(where)
        return out


# --- files ------------------------------------------------------------------------------------------

def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = None, id_col: str = "doc_id",
                 text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Token ids of all whole texts, in ascending order of the documents' ids, as segment files in ``folder``.

    Null texts are empty; null ids come first; rows of one id keep the order in which they are read.
    ``end_id`` is appended to every document. Texts are moved once, by ranges of ids, so many that a
    range stands for a bounded number of bytes; one id's rows may lie in several ranges. An empty table gives an empty folder.
    """
    spark = docs.sparkSession
    small_batches(spark)

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, number = kept_by_worker(f"coder of {tokenizer}", lambda: Coder(tokenizer)), TaskContext.get().partitionId(), 0
        tail = np.array([] if end_id is None else [end_id], dtype=np.uint32)
        ids, coded, size = [], [], 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([build_segment(part, number, ids, coded)], pa.binary())], ["content"])

        for batch in batches:
            for chunk in byte_chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                for (doc, _), found in zip(chunk, coder.encode([t for _, t in chunk])):
                    found = np.concatenate([found, tail])
                    if ids and size + len(found) > segment_tokens:
                        yield segment()
                        ids, coded, size, number = [], [], 0, number + 1
                    ids.append(doc)
                    coded.append(found)
                    size += len(found)
        if ids:
            yield segment()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange(parts_of(rows, PART_BYTES), "doc_id", "row").sortWithinPartitions("doc_id", "row")
    found = ordered.select("doc_id", "text").mapInArrow(work, "content binary")
    # The text writer stores the bytes as they are and a line feed after them; one row is one file.
    found.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(folder)


def byte_chunks(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    part, size = [], 0
    for row in rows:
        if part and size + len(row[1]) > CHUNK_BYTES:
            yield part
            part, size = [], 0
        part.append(row)
        size += len(row[1])
    if part:
        yield part


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder, one row each."""
    small_batches(spark)
    return spark.read.format("binaryFile").load(folder).select("content")


def documents(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """What the files hold of every document: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``, and its ``ids`` if wanted.

    ``start`` counts the tokens of all documents before it. It is the sum of what lies before in its segment, of earlier
    segments of its part and of earlier parts; only the parts' totals, one row for each, pass through the driver.
    """
    names = ["doc_id", "part", "number", "before", "n_tokens", "ids_crc32", "ids"]

    @lean
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held = Segment(content.as_buffer())
                starts = np.r_[0, held.ends[:-1]]
                for a, b in spans_of(held.ends):
                    first = int(starts[a])
                    ids = held.span(first, int(held.ends[b - 1])).astype("<u4")
                    cuts = [ids[x - first:y - first] for x, y in zip(starts[a:b].tolist(), held.ends[a:b].tolist())]
                    n = b - a
                    yield pa.RecordBatch.from_arrays([
                        pa.array(held.doc_ids[a:b], mask=held.known[a:b] == 0), pa.array(np.full(n, held.part)), pa.array(np.full(n, held.number)),
                        pa.array(starts[a:b]), pa.array(held.ends[a:b] - starts[a:b]), pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
                        pa.array([c.astype(np.int64) for c in cuts] if with_ids else [None] * n, pa.list_(pa.int64()))], names)

    kinds = "doc_id long, part long, number long, before long, n_tokens long, ids_crc32 long, ids array<long>"
    found = materialize(segments(spark, folder).mapInArrow(read, kinds), "token-documents")
    placed = found.join(_starts(found, "n_tokens"), ["part", "number"])
    out = placed.select("doc_id", (F.col("before") + F.col("segment_start")).alias("start"), "n_tokens", "ids_crc32", "ids")
    return out if with_ids else out.drop("ids")


def spans_of(ends: np.ndarray, tokens: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Bounds of runs of documents that have so many tokens together; a longer document is a run of its own."""
    a = 0
    while a < len(ends):
        before = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + tokens, side="right")))
        yield a, b
        a = b


def _starts(rows: DataFrame, size: str) -> DataFrame:
    """``segment_start`` of each segment by part and number."""
    held = rows.groupBy("part", "number").agg(F.sum(size).alias("size"))
    held = held.withColumn("inner", F.sum("size").over(Window.partitionBy("part").orderBy("number")) - F.col("size"))
    totals = sorted(tuple(r) for r in held.groupBy("part").agg(F.sum("size")).collect())
    starts = [(part, start) for (part, _), start in zip(totals, accumulate((n for _, n in totals), initial=0))]
    parts = rows.sparkSession.createDataFrame(starts, "part long, part_start long")
    return held.join(F.broadcast(parts), "part").select("part", "number", (F.col("inner") + F.col("part_start")).alias("segment_start"), "size")


def tokens_at(spark: SparkSession, folder: str, positions: DataFrame, position_col: str = "position") -> DataFrame:
    """The ``token`` at each global position, read in place; positions outside the stored tokens, and null ones, have none.

    Positions meet their segments by the cells of the token line that a segment touches. Each segment gets the distinct
    positions asked of it, at most as many as it has tokens, together with its bytes.
    """
    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [struct.unpack_from(HEAD, c.as_buffer()) for c in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in heads], pa.int64()) for i in (1, 2, 4)] + [batch.column(0)],
                                             ["part", "number", "n_tokens", "content"])

    held = segments(spark, folder).mapInArrow(head, "part long, number long, n_tokens long, content binary")
    starts = materialize(_starts(held.drop("content"), "n_tokens"), "segment-starts")
    cell = F.sequence(F.floor(F.col("segment_start") / SEGMENT_TOKENS), F.floor((F.col("segment_start") + F.col("size") - 1) / SEGMENT_TOKENS))
    spread = starts.withColumn("cell", F.explode(cell))
    asked = positions.select(F.col(position_col).cast("long").alias("at")).where("at >= 0").distinct()
    asked = asked.withColumn("cell", F.floor(F.col("at") / SEGMENT_TOKENS))
    inside = (F.col("at") >= F.col("segment_start")) & (F.col("at") < F.col("segment_start") + F.col("size"))
    wanted = asked.join(spread, "cell").where(inside).groupBy("part", "number").agg(
        F.collect_list(F.struct("at", (F.col("at") - F.col("segment_start")).alias("place"))).alias("asked"))

    @lean
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, asked in zip(batch.column(0), batch.column(1).to_pylist()):
                place = np.array([a["place"] for a in asked], dtype=np.int64)
                found = Segment(content.as_buffer()).tokens_at(place)
                yield pa.RecordBatch.from_arrays([pa.array([a["at"] for a in asked], pa.int64()), pa.array(found.astype(np.int64))], ["at", "token"])

    got = held.join(wanted, ["part", "number"]).select("content", "asked").mapInArrow(look, "at long, token long")
    return positions.join(got, positions[position_col].cast("long") == got["at"], "left").select(positions["*"], "token")
