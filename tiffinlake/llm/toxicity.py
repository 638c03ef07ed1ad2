"""Toxicity by a support vector machine over a subsequence string kernel, with Nyström landmarks.

Two words are alike as far as they share subsequences of four letters, each gap weighing less, so
letters put in between or left out cost a little and not everything. A sentence is the sum of its
distinct words. The kernel to a few landmark words, whitened, is the feature space of a linear machine that
is trained on labelled sentences (long ones are cut); a text's margin is its worst sentence's, and a
monotone fit on texts kept apart makes it a probability. Wrong labels at either end cannot tilt that
fit, as they would a logistic one.

A word that is plainly and often toxic speaks for itself, whatever the mild words around it: a text with one has at
least the probability that such texts have among those kept apart.

The decision is linear in the landmarks' kernel values and these are linear in a word's
subsequences. Landmarks, whitening and weights therefore fold into one weight per subsequence, and
scoring a word needs no pass over the landmarks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from tiffinlake.session import materialize

from .support import bounded_sample, chunks, lean, small_batches

# Letters a to z, a bucket of others, and the edge of a word.
LETTERS, OTHERS = 26, 13
BASE = 1 + LETTERS + OTHERS
DECAY, MOST_GAPS = 0.5, 2
# Steps from the first letter of a subsequence to the other three, with its weight.
STEPS = [((1 + a), (2 + a + b), (3 + a + b + c), DECAY ** (a + b + c))
         for a in range(MOST_GAPS + 1) for b in range(MOST_GAPS + 1 - a) for c in range(MOST_GAPS + 1 - a - b)]
SENTENCE_WORDS = 6
# Fitting: documents of either label, landmarks, and sentences of a document, at most.
SAMPLE_PER_LABEL = 3000
TELLING_LANDMARKS, COMMON_LANDMARKS = 256, 64
SENTENCES_PER_DOC = 2
RIDGE = 1e-3
MEMORY = 200_000
# Partitions of the taught sentences, each of which sends its sums in every step.
FIT_PARTS = 8
# Log odds that a surely toxic word has at least, two standard errors below its own; added to the margin of a text with one.
SURE_ODDS, SURE = 3.0, 1000.0
# Margin of a text without words: below any sentence's.
NOTHING = -30.0
LETTER = re.compile(r"[^\W\d_]+")
NEWLINE = "\x01"


class Words:
    """Words, sentences and texts of a chunk; the same cutting for training and scoring."""

    def __init__(self, texts: list[str]):
        runs = [t.lower().replace("\n", f" {NEWLINE} ").split() for t in texts]
        sizes = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
        index: dict[str, int] = {}
        flat = np.fromiter((index.setdefault(r, len(index)) for r in chain.from_iterable(runs)), dtype=np.int64, count=int(sizes.sum()))
        shown = list(index)
        words = [r if r.isalpha() else "".join(LETTER.findall(r)) for r in shown]
        ends = np.fromiter((r[-1] in ".!?" or r == NEWLINE for r in shown), dtype=bool, count=len(shown))
        single = np.fromiter((len(w) == 1 for w in words), dtype=bool, count=len(words))
        doc = np.repeat(np.arange(len(texts)), sizes)
        end, alone = (ends[flat], single[flat]) if len(shown) else (np.zeros(0, bool), np.zeros(0, bool))
        flat = self._spelled(flat, alone, doc, words)
        first = np.r_[0, np.cumsum(sizes)[:-1]]
        place = np.arange(len(flat))
        # A sentence begins with a text, after an end mark, and after so many words.
        start = np.zeros(len(flat), dtype=bool)
        start[first[sizes > 0]] = True
        start[1:] |= end[:-1]
        begun = np.maximum.accumulate(np.where(start, place, 0)) if len(flat) else place
        start |= (place - begun) % SENTENCE_WORDS == 0
        # A word counts once in a sentence, however often it is repeated there.
        both = np.unique((np.cumsum(start) - 1) * max(1, len(words)) + flat)
        self.word, self.words = both % max(1, len(words)), words
        self.sentence = both // max(1, len(words))
        self.sentence_doc = doc[start]
        self.docs = len(texts)

    @staticmethod
    def _spelled(flat: np.ndarray, alone: np.ndarray, doc: np.ndarray, words: list[str]) -> np.ndarray:
        """Three or more single letters in a row are one word, put at the first of them."""
        edge = np.flatnonzero(np.diff(np.r_[0, alone.astype(np.int8), 0]))
        out = flat
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            cuts = [a, *(a + 1 + np.flatnonzero(np.diff(doc[a:b]))).tolist(), b]
            for x, y in zip(cuts, cuts[1:]):
                if y - x >= 3:
                    if out is flat:
                        out = flat.copy()
                        words.append("")
                        blank = len(words) - 1
                    words.append("".join(words[i] for i in flat[x:y]))
                    out[x:y] = blank
                    out[x] = len(words) - 1
        return out


def subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each shape of subsequence: the words that have it, its codes, and its weights in unit-length words."""
    text = "".join([f" {w} " for w in words])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    code = np.where((points >= 97) & (points <= 122), points - 96, np.where(points == 32, 0, 1 + LETTERS + points % OTHERS)).astype(np.int32)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    owner = np.repeat(np.arange(len(words)), sizes)
    norm = np.sqrt(np.maximum(sum(w * w * np.maximum(0, sizes - z) for _, _, z, w in STEPS), 1e-9))
    for x, y, z, weight in STEPS:
        if len(code) <= z:
            continue
        at = np.flatnonzero(owner[:-z] == owner[z:])
        if len(at):
            yield owner[at], ((code[at] * BASE + code[at + x]) * BASE + code[at + y]) * BASE + code[at + z], weight / norm[owner[at]]


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel of each word with each landmark; a word with itself has about one."""
    parts = list(subsequences(landmarks))
    mark, code = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    weight = np.concatenate([p[2] for p in parts])
    known, row = np.unique(code, return_inverse=True)
    table = np.zeros((len(known) + 1, len(landmarks)), dtype=np.float32)
    np.add.at(table, (row, mark), weight)
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    for at in range(0, len(words), 4000):
        for owner, codes, w in subsequences(words[at:at + 4000]):
            place = np.minimum(np.searchsorted(known, codes), len(known) - 1)
            hit = known[place] == codes
            if hit.any():
                owner, rows = owner[hit], table[place[hit]] * w[hit, None].astype(np.float32)
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                out[at + owner[first]] += np.add.reduceat(rows, first, axis=0)
    return out


def separate(rows: DataFrame, size: int, counts: dict[int, int], ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear machine with squared hinge loss, both classes weighing the same (Newton steps).

    ``rows`` holds labels ``y`` and features ``x`` (bytes of ``size`` single-precision numbers). A step
    sums what the rows within the margin add to a (size + 1)-square matrix and a vector; only these
    sums, one for each of a few partitions, come to the driver.
    """
    cost = {y: 0.5 / max(1, counts.get(y, 0)) for y in (0, 1)}
    keep = np.full(size + 1, ridge)
    keep[-1] = 1e-9
    w = np.zeros(size + 1)
    loss = np.inf

    def sums(at: np.ndarray):
        @lean
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matrix, vector, total = np.zeros((size + 1, size + 1)), np.zeros(size + 1), 0.0
            for batch in batches:
                y = batch.column(0).to_numpy(zero_copy_only=False)
                x = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<f4").reshape(len(y), size).astype(np.float64)
                x = np.hstack([x, np.ones((len(y), 1))])
                sign, each = np.where(y > 0, 1.0, -1.0), np.where(y > 0, cost[1], cost[0])
                short = 1 - sign * (x @ at)
                on = short > 0
                some = x[on] * each[on, None]
                matrix += x[on].T @ some
                vector += some.T @ sign[on]
                total += float((each[on] * short[on] ** 2).sum())
            yield pa.RecordBatch.from_arrays([pa.array([matrix.tobytes()], pa.binary()), pa.array([vector.tobytes()], pa.binary()), pa.array([total])],
                                             ["matrix", "vector", "loss"])

        found = rows.select("y", "x").mapInArrow(work, "matrix binary, vector binary, loss double").collect()
        return (sum(np.frombuffer(r["matrix"]).reshape(size + 1, size + 1) for r in found),
                sum(np.frombuffer(r["vector"]) for r in found), sum(r["loss"] for r in found))

    for _ in range(50):
        matrix, vector, now = sums(w)
        now += float((keep * w * w).sum())
        if loss - now < 1e-9:
            break
        loss = now
        w = np.linalg.solve(matrix + np.diag(keep), vector)
    return w[:-1], float(w[-1])


def calibrate(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[list[float], list[float]]:
    """Knots of the best non-decreasing fit of the label on the margin (pooled adjacent violators), joined by lines."""
    order = np.argsort(margin, kind="stable")
    pools: list[list[float]] = []  # weight, weighted labels, weighted margins
    for m, label, w in zip(margin[order], y[order], weight[order]):
        pools.append([w, w * label, w * m])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return [p[2] / p[0] for p in pools], [p[1] / p[0] for p in pools]


def probability(margin: np.ndarray, knots: tuple[list[float], list[float]]) -> np.ndarray:
    """The fit at some margins; a small logistic share keeps unlike margins apart."""
    if not knots[0]:
        return np.zeros(len(margin))
    smooth = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
    return 0.98 * np.interp(margin, *knots) + 0.02 * smooth


def judge(margin: np.ndarray, model: dict) -> np.ndarray:
    """Probabilities from margins, among them those of texts with a surely toxic word."""
    sure = margin > SURE / 2
    plain = np.where(sure, margin - SURE, margin)
    out = probability(plain, model["knots"])
    least = 0.98 * model["share"] + 0.02 / (1 + np.exp(-np.clip(plain, -30, 30)))
    return np.where(sure, np.maximum(out, least), out)


class Scorer:
    """Margins of texts under folded weights, with the words already scored."""

    def __init__(self, weights: np.ndarray, offset: float, each: float, sure: frozenset[str] = frozenset()):
        self.weights, self.offset, self.each, self.sure = weights, offset, each, sure
        self.memory: dict[str, float] = {}

    def _learn(self, words: list[str]) -> None:
        value = np.full(len(words), self.each)
        for owner, codes, w in subsequences(words):
            value += np.bincount(owner, self.weights[codes] * w, minlength=len(words))
        self.memory.update(zip(words, value.tolist()))

    def margins(self, texts: list[str]) -> np.ndarray:
        cut = Words(texts)
        if len(self.memory) > MEMORY:
            self.memory.clear()
        new = list(set(cut.words).difference(self.memory))
        for at in range(0, len(new), 10_000):
            self._learn(new[at:at + 10_000])
        out = np.full(cut.docs, NOTHING)
        if len(cut.word):
            value = np.fromiter(map(self.memory.__getitem__, cut.words), dtype=float, count=len(cut.words))
            sums = np.bincount(cut.sentence, value[cut.word], minlength=len(cut.sentence_doc)) + self.offset
            first = np.flatnonzero(np.r_[True, cut.sentence_doc[1:] != cut.sentence_doc[:-1]])
            out[cut.sentence_doc[first]] = np.maximum.reduceat(sums, first)
            sure = np.fromiter((w in self.sure for w in cut.words), dtype=bool, count=len(cut.words))
            out[np.unique(cut.sentence_doc[cut.sentence[sure[cut.word]]])] += SURE
        return out


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", key_col: str = "doc_id", label_col: str = "toxic",
        per_label: int = SAMPLE_PER_LABEL, seed: int = 8) -> dict:
    """A model from at most ``per_label`` whole labelled texts of either label.

    Sentences get their labels from their texts: of a toxic text those with the most telling words
    are toxic, all of a clean text's are clean. A quarter of the sample is kept for calibration.
    Labels other than 0 and 1, null keys and null texts teach nothing; a key with both labels is
    toxic. Without both labels the model gives 0 to every text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    marked = (labels.select(F.col(key_col).alias("key"), F.col(label_col).cast("int").alias("y"))
              .where("key is not null and y in (0, 1)").groupBy("key").agg(F.max("y").alias("y")))
    marked = materialize(marked, "labels")
    known = dict(marked.groupBy("y").count().collect())
    nothing = {"weights": np.zeros(BASE ** 4, dtype=np.float32), "offset": 0.0, "each": 0.0, "sure": frozenset(), "share": 0.0, "knots": ([], [])}
    if len(known) < 2:
        return nothing
    chosen = bounded_sample(marked, "y", "key", per_label, seed)
    texts = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text")).where("text is not null")
    sample = materialize(texts.join(F.broadcast(chosen), "key")  # at most 2 x per_label keys
                         .withColumn("held", F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(4)) == 0)
                         .repartition(spark.sparkContext.defaultParallelism), "sample")
    learn = sample.where("not held")

    @lean
    def presence(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for y, same in frame.groupby("y")["text"]:
                seen = [w for part in chunks(same) for t in part for w in set(Words([t]).words) if len(w) > 1]
                counted = pd.Series(seen, dtype=object).value_counts()
                yield pd.DataFrame({"word": counted.index.astype(object), "y": y, "n": counted.to_numpy()})

    size = {r["y"]: r["count"] for r in learn.groupBy("y").count().collect()}
    if len(size) < 2:
        return nothing
    pos, neg = (F.coalesce(F.sum(F.when(F.col("y") == y, F.col("n"))), F.lit(0)).alias(name) for y, name in ((1, "pos"), (0, "neg")))
    counted = (learn.select("y", "text").mapInPandas(presence, "word string, y int, n long").groupBy("word").agg(pos, neg)
               .where("pos + neg >= 3")
               .withColumn("odds", F.log((F.col("pos") + 0.5) / (size[1] + 1)) - F.log((F.col("neg") + 0.5) / (size[0] + 1)))
               .withColumn("telling", F.col("odds") * F.sqrt("pos")))
    counted = materialize(counted, "landmarks")
    telling = counted.where("odds > 1").orderBy(F.desc("telling"), "word").limit(TELLING_LANDMARKS).collect()
    common = counted.where("odds <= 1").orderBy(F.desc("neg"), "word").limit(COMMON_LANDMARKS).collect()
    landmarks = [r["word"] for r in [*telling, *common]]
    if not landmarks:
        return nothing
    sure = frozenset(r["word"] for r in telling if r["odds"] - 2 * (1 / (r["pos"] + 0.5) + 1 / (r["neg"] + 0.5)) ** 0.5 >= SURE_ODDS)
    hint = spark.sparkContext.broadcast({r["word"]: r["telling"] for r in telling})  # bounded by the landmarks

    @lean
    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            labels_of = frame["y"].tolist()
            at = 0
            for part in chunks(frame["text"]):
                cut = Words(part)
                y = np.array(labels_of[at:at + len(part)])
                at += len(part)
                if not len(cut.word):
                    continue
                value = np.array([hint.value.get(w, 0.0) for w in cut.words])
                worst = np.zeros(len(cut.sentence_doc))
                np.maximum.at(worst, cut.sentence, value[cut.word])
                order = np.lexsort((np.arange(len(worst)), -worst, cut.sentence_doc))
                rank = np.empty_like(order)
                first = np.r_[True, np.diff(cut.sentence_doc[order]) != 0]
                rank[order] = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
                label = y[cut.sentence_doc]
                pick = np.where(label == 1, (rank == 0) | ((rank < SENTENCES_PER_DOC) & (worst > 0)), rank < SENTENCES_PER_DOC)
                use = pick[cut.sentence]
                ids, inverse = np.unique(cut.word[use], return_inverse=True)
                k = kernel([cut.words[i] for i in ids], landmarks)
                numbers = np.cumsum(pick) - 1
                sums = np.zeros((int(pick.sum()), len(landmarks)), dtype=np.float32)
                np.add.at(sums, numbers[cut.sentence[use]], k[inverse])
                length = np.bincount(numbers[cut.sentence[use]], minlength=len(sums))
                yield taught_rows(label[pick], sums, length)
                # The most telling word of a toxic sentence is also taught as a sentence of its own, as it is and with a letter put in.
                tells = pick[cut.sentence] & (label[cut.sentence] == 1) & (value[cut.word] > 0) & (value[cut.word] == worst[cut.sentence])
                if tells.any():
                    plain = [cut.words[i] for i in cut.word[tells]]
                    alone = kernel([*plain, *[w[:len(w) // 2] + "xqz"[i % 3] + w[len(w) // 2:] for i, w in enumerate(plain)]], landmarks)
                    yield taught_rows(np.ones(len(alone), dtype=int), alone, np.ones(len(alone)))

    among = kernel(landmarks, landmarks).astype(np.float64)
    value, vector = np.linalg.eigh((among + among.T) / 2)
    whiten = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T

    def taught_rows(labels_of: np.ndarray, sums: np.ndarray, length: np.ndarray) -> pd.DataFrame:
        # The number of words is a feature too, so that short sentences are no milder than long ones.
        x = np.hstack([sums @ whiten, length[:, None] / SENTENCE_WORDS]).astype("<f4")
        return pd.DataFrame({"y": labels_of, "x": [row.tobytes() for row in x]})

    taught = materialize(learn.select("y", "text").mapInPandas(features, "y int, x binary").coalesce(FIT_PARTS), "taught")
    weight, offset = separate(taught, len(landmarks) + 1, dict(taught.groupBy("y").count().collect()))
    weight, each = weight[:-1], float(weight[-1]) / SENTENCE_WORDS
    folded = np.zeros(BASE ** 4)
    for owner, codes, w in subsequences(landmarks):
        np.add.at(folded, codes, w * (whiten @ weight)[owner])
    model = {"weights": folded.astype(np.float32), "offset": offset, "each": each, "sure": sure, "share": 0.0, "knots": ([], [])}
    held = sample.where("held").select("y", _apply(spark, F.col("text"), model, lambda m: m).alias("m")).toPandas()
    if held["y"].nunique() == 2:
        y = held["y"].to_numpy(dtype=float)
        share = {v: known[v] / max(1, (y == v).sum()) for v in (0, 1)}
        w = np.where(y > 0, share[1], share[0])
        w, m = w / w.mean(), held["m"].to_numpy()
        spoken = m > SURE / 2
        model["knots"] = calibrate(np.where(spoken, m - SURE, m), y, w)
        model["share"] = float(((w * y)[spoken].sum() + 0.5) / (w[spoken].sum() + 1))
    return model


def _apply(spark: SparkSession, text: Column, model: dict, finish) -> Column:
    small_batches(spark)
    if "shared" not in model:
        # 10 MB whatever the corpus, sent once for calibration and scoring.
        model["shared"] = spark.sparkContext.broadcast((model.pop("weights"), model["offset"], model["each"], model["sure"]))
    shared = model["shared"]

    @pandas_udf("double")
    @lean
    def margin(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(*shared.value)
        for texts in batches:
            yield pd.Series(finish(np.concatenate([np.zeros(0), *(scorer.margins(part) for part in chunks(texts))])))

    return margin(text)


def score(spark: SparkSession, text: Column, model: dict) -> Column:
    """Probability that a text is toxic, from its worst sentence. A null or empty text, or one without words, scores lowest."""
    fitted = {"knots": model["knots"], "share": model["share"]}
    return _apply(spark, text, model, lambda m: judge(m, fitted))
