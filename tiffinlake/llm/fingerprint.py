"""Document fingerprints by consistent weighted sampling: equal samples are as likely as the generalised Jaccard similarity.

Each term of a text weighs its number of occurrences. For every sample, a term draws two gamma
variables and an offset from its own hash; its weight is rounded down on the term's own grid of
logarithms, and the term with the least value is the sample, together with its grid step. Two texts
share a sample with probability  sum(min weights) / sum(max weights).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .support import lean, mix64, parts_of, small_batches

SAMPLES = 128
CHUNK_CHARS = 400_000
SIGMA = "\u03a3"
# Rows a task holds at once.
CHUNK_ROWS = 20_000
# Terms whose draws a worker keeps, and repeated terms whose grids it keeps besides.
MEMORY, GRIDS = 75_000, 8_000
# Bytes of the source files for each stretch of ids.
STRETCH_BYTES = 32 << 20
# Terms drawn side by side: few enough for a core's cache.
DRAWN_AT_ONCE = 96


class Sampler:
    """Samples of texts. What a single occurrence of a term is worth is remembered for many terms; its grid, which only
    repeated terms need, for few."""

    def __init__(self, samples: int = SAMPLES, seed: int = 5):
        self.samples = samples
        self.salt = np.arange(-(-5 * samples // 2), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.single, self.grid, self.shift = (np.zeros((0, self.samples), dtype=np.float32) for _ in range(3))
        self.names, self.uses = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self._forget_grids()

    def _forget_grids(self, space: int = 0) -> None:
        self.place, self.gridded = np.full(len(self.names), -1), 0
        if space > len(self.grid):
            self.grid, self.shift = (np.empty((space, self.samples), dtype=np.float32) for _ in range(2))

    def _keep_common(self) -> None:
        """Forget all terms but those in the most texts, half of the memory."""
        kept = np.sort(np.argpartition(-self.uses, MEMORY // 2)[:MEMORY // 2])
        terms = list(self.index)
        self.index = {terms[i]: at for at, i in enumerate(kept.tolist())}
        self.single = self.single[kept]
        # Halved, so that what is common now counts more than what was common once.
        self.names, self.uses = self.names[kept], self.uses[kept] // 2
        self._forget_grids()

    def _drawn(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Grid, shift and value of a single occurrence: five numbers between 0 and 1 for each term and sample, from the upper
        24 bits of the halves of hashes."""
        n = self.samples
        with np.errstate(over="ignore"):
            halves = mix64(names[:, None] + self.salt).view(np.uint32)
        unit = (halves >> np.uint32(8)).astype(np.float32)
        unit += np.float32(0.5)
        unit *= np.float32(2.0 ** -24 * (1 - 2.0 ** -22))
        # The negative logarithm of the product of two numbers is gamma distributed.
        gamma = unit[:, :2 * n] * unit[:, 2 * n:4 * n]
        np.negative(np.log(gamma, out=gamma), out=gamma)
        grid, shift = gamma[:, :n], unit[:, 4 * n:5 * n]
        return grid, shift, np.log(gamma[:, n:]) - grid * (1 - shift)

    def _draw(self, terms: list[str]) -> None:
        names = np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in terms], dtype=np.uint64)
        old = len(self.names)
        # Space for old and new terms at once, filled block by block.
        single = np.empty((old + len(terms), self.samples), dtype=np.float32)
        single[:old] = self.single
        for at in range(0, len(terms), DRAWN_AT_ONCE):
            block = names[at:at + DRAWN_AT_ONCE]
            single[old + at:old + at + len(block)] = self._drawn(block)[2]
        self.index.update(zip(terms, range(old, old + len(terms))))
        self.names, self.uses = np.r_[self.names, names], np.r_[self.uses, np.zeros(len(names), dtype=np.int64)]
        self.place = np.r_[self.place, np.full(len(names), -1)]
        self.single = single

    def _grids(self, ids: np.ndarray) -> np.ndarray:
        """Rows of the grid table for these terms."""
        rows = self.place[ids]
        new = ids[rows < 0]
        if len(new):
            if self.gridded + len(new) > len(self.grid):
                self._forget_grids(max(GRIDS, len(ids)))
                new = ids
            self.place[new] = np.arange(self.gridded, self.gridded + len(new))
            for at in range(0, len(new), DRAWN_AT_ONCE):
                block = new[at:at + DRAWN_AT_ONCE]
                put = slice(self.gridded, self.gridded + len(block))
                self.grid[put], self.shift[put] = self._drawn(self.names[block])[:2]
                self.gridded += len(block)
            rows = self.place[ids]
        return rows

    def look_up(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The terms' rows of each list of lower-case words; they hold until the memory is tidied."""
        new = list(set(chain.from_iterable(texts)).difference(self.index))
        if new:
            self._draw(new)
        return [np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words)) for words in texts]

    def tidy(self) -> None:
        """Keep the memory within its bound; rows looked up before do not hold any more."""
        if len(self.index) > MEMORY:
            self._keep_common()

    def sign(self, texts: list[str]) -> np.ndarray:
        """A row of samples for each text, 1 to 65535; all 0 for a text without terms."""
        self.tidy()
        return self.sign_rows(self.look_up([t.lower().split() for t in texts]))

    def sign_rows(self, texts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(texts), self.samples), dtype=np.uint16)
        column = np.arange(self.samples)
        names, steps = np.zeros((len(texts), self.samples), dtype=np.uint64), np.zeros((len(texts), self.samples), dtype=np.uint64)
        for i, ids in enumerate(texts):
            if not len(ids):
                continue
            ids, weight = np.unique(ids, return_counts=True)
            self.uses[ids] += 1
            # By name, so that ties of the value go to the smaller one whatever was in memory before.
            by_name = self.names[ids].argsort()
            ids, weight = ids[by_name], weight[by_name]
            value = self.single[ids]
            often = np.flatnonzero(weight > 1)
            if len(often):
                rows = self._grids(ids[often])
                grid = self.grid[rows]
                step = np.floor(np.log(weight[often]).astype(np.float32)[:, None] / grid + self.shift[rows])
                # A single occurrence has step 0; further steps lower the value by one grid width each.
                value[often] -= grid * step
            best = value.argmin(axis=0)
            if len(often):
                at = np.full(len(ids), -1)
                at[often] = np.arange(len(often))
                many = at[best] >= 0
                steps[i, many] = step[at[best[many]], column[many]].astype(np.uint64)
            names[i] = self.names[ids[best]]
        some = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) > 0
        with np.errstate(over="ignore"):
            out[some] = mix64(names[some] + steps[some] * np.uint64(0xD6E8FEB86659FD93)) % np.uint64(65535) + np.uint64(1)
        return out

    def sign_edited(self, texts: list[str], use: list[int], rows: list[np.ndarray]) -> np.ndarray:
        """Samples of the edited texts (see :func:`edited`) of the numbered texts, each with the text after it.

        All words of an edited text but those at its two cuts are words of the two texts, whose rows are known.
        """
        parts = []  # rows before the first cut, words there, rows up to the second cut, words there
        for i in use:
            text, following = texts[i], texts[i + 1]
            half = len(text) // 2
            head, tail = text[:len(text) - half], following[:half] if half else ""
            if SIGMA in text or SIGMA in following:  # its lower case depends on its neighbours
                parts.append((rows[i][:0], edited(text, following).lower().split(), rows[i][:0], []))
                continue
            first, last = head.split(), tail.split()
            joined = bool(first and last) and not head[-1].isspace() and not tail[0].isspace()
            here, there = [], []
            if first:
                here = [first[-1].lower()]
            if joined:
                here = [here[0] + last[0].lower()]
            elif last:
                here.append(last[0].lower())
            if len(last) > 1:
                there = [last[-1].lower()]
            parts.append((rows[i][:max(0, len(first) - 1)], here, rows[i + 1][1:max(1, len(last) - 1)], there))
        cut = iter(self.look_up([words for _, here, _, there in parts for words in (here, there)]))
        return self.sign_rows([np.concatenate([a, next(cut), b, next(cut)]) for a, _, b, _ in parts])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples of two signature tables, row by row."""
    return (a == b).mean(axis=1)


def hex_rows(signs: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in signs.astype(">u2")]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (hex) of every whole text; null texts count as empty, equal texts have equal fingerprints."""

    @lean
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hex_rows(sampler.sign(texts)), pa.string())], ["doc_id", "fingerprint"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(sign, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with the last half of its code points replaced by as many first ones of the next text, or all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half] if half else text


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Each text's fingerprint, its edited text's, and the likeness to that and to the next text's.

    The next document follows in descending order of ids, nulls last, equal ids by checksum; after
    the last comes the first. The table is cut into stretches of ids at quantiles, so many that each stands
    for a bounded number of bytes (rows without id: into ranges of checksums), and moved once. Each stretch also
    gets the first document of the next one, so that no window spans the table.
    A null text is empty; a single document is its own next. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = max(parts_of(docs, STRETCH_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 50 * parts)).first()[0] or []
    cuts = sorted(set(cuts))
    later = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c >= F.col("doc_id"))) if cuts else F.lit(0)
    nameless = len(cuts) + 1 + F.least(F.floor((F.col("crc").cast("double") / 2.0 ** 64 + 0.5) * parts), F.lit(parts - 1))
    rows = (rows.withColumn("crc", F.xxhash64("text"))
            .withColumn("stretch", F.when(F.col("doc_id").isNull(), nameless).otherwise(later).cast("int")))
    order = F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("id"), F.col("crc"))
    heads = rows.select("stretch", "doc_id", "crc", order.alias("o")).groupBy("stretch").agg(F.min("o").alias("o")).orderBy("stretch").collect()
    # One short row for each stretch.
    before = [(h["o"]["id"], h["o"]["crc"], heads[i - 1]["stretch"]) for i, h in enumerate(heads)]
    lead = spark.createDataFrame(before, "head_id long, head_crc long, earlier int")
    same = (-F.col("doc_id")).eqNullSafe(F.col("head_id")) & (F.col("crc") == F.col("head_crc"))
    here = F.struct(F.col("stretch"), F.lit(0).alias("extra"))
    there = F.struct(F.col("earlier").alias("stretch"), F.lit(1).alias("extra"))
    sent = rows.join(F.broadcast(lead), same, "left").withColumn(
        "to", F.explode(F.when(F.col("earlier").isNull(), F.array(here)).otherwise(F.array(here, there))))
    sent = (sent.select("to.stretch", "to.extra", "doc_id", "crc", "text").repartition("stretch")
            .sortWithinPartitions("stretch", "extra", F.col("doc_id").desc_nulls_last(), "crc"))

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def finish(held: list[tuple], sampler: Sampler) -> pa.RecordBatch | None:
        """Results for all rows but the last, which is there for its predecessor."""
        use = [i for i in range(len(held) - 1) if not held[i][1] and held[i][0] == held[i + 1][0]]
        if not use:
            return None
        texts = [r[3] for r in held]
        cut = [edited(texts[i], texts[i + 1]) for i in use]
        sampler.tidy()
        rows = sampler.look_up([t.lower().split() for t in texts])
        own, changed = sampler.sign_rows(rows), sampler.sign_edited(texts, use, rows)
        at = np.array(use)
        return pa.RecordBatch.from_arrays([
            pa.array([held[i][2] for i in use], pa.int64()), pa.array([len(texts[i]) for i in use], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in cut], pa.string()),
            pa.array(hex_rows(own[at]), pa.string()), pa.array(hex_rows(changed), pa.string()),
            pa.array(likeness(own[at], changed), pa.float64()), pa.array(likeness(own[at], own[at + 1]), pa.float64())], names)

    @lean
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, held, size = Sampler(samples), [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                held.append(row)
                size += len(row[3])
                if (size > CHUNK_CHARS or len(held) > CHUNK_ROWS) and len(held) > 1:
                    if (out := finish(held, sampler)) is not None:
                        yield out
                    held = held[-1:]
                    size = len(held[0][3])
        if (out := finish(held, sampler)) is not None:
            yield out

    kinds = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return sent.select("stretch", "extra", "doc_id", "text").mapInArrow(walk, kinds)
