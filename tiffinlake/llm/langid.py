"""Language identification by unigrams over a fixed public vocabulary, summed over every segmentation of a word.

Each language has a probability for every piece of the vocabulary. A word's probability is the sum
over all ways to cut it into pieces, which a forward pass over its letters adds up; a text is its
words. The pieces' probabilities are fitted by expectation-maximisation over the same sums.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from tiffinlake.session import materialize

from .support import bounded_sample, chunks, lean, small_batches

UNKNOWN = "und"
# Longest run of letters scored as one word; a longer one counts as several.
WORD_LETTERS = 40
# Fitting: documents of each language, at most, and rounds of expectation-maximisation.
SAMPLE_PER_LANGUAGE = 600
ROUNDS = 3
# Probability of a letter that no piece covers, and added count of each piece.
STRANGE = 1e-7
PRIOR_COUNT = 0.02
# Words a worker remembers between chunks.
MEMORY = 200_000
# Words whose segmentations are summed side by side.
WORDS_AT_ONCE = 4_000
LETTERS = re.compile(r"[^\W\d_]+")
START = "▁"


def pieces_of(model_path: str) -> list[str]:
    """Pieces of a public vocabulary that consist of letters, perhaps after a word start; read on the driver."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    found = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_byte(i)}
    return sorted(p for p in found if p.strip(START) and LETTERS.fullmatch(p.lstrip(START)) and p.count(START) <= 1)


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters, long ones cut."""
    words = LETTERS.findall(text.lower())
    if max(map(len, words), default=0) <= WORD_LETTERS:
        return words
    return [w[i:i + WORD_LETTERS] for w in words for i in range(0, len(w), WORD_LETTERS)]


class Segmenter:
    """A trie of the pieces as sorted keys, walked for many words at once."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        letters = sorted({c for p in pieces for c in p})
        self.code = {c: i + 1 for i, c in enumerate(letters)}
        self.base = len(letters) + 1
        nodes, ends, step = {"": 0}, {}, []
        for at, piece in enumerate(pieces):
            node = 0
            for i, c in enumerate(piece):
                new = nodes.setdefault(piece[:i + 1], len(nodes))
                step.append((node * self.base + self.code[c], new))
                node = new
            ends[node] = at
        keys = np.array(sorted(set(step)), dtype=np.int64)
        self.keys, self.child = keys[:, 0].copy(), keys[:, 1].copy()
        self.piece_at = np.full(len(nodes), -1, dtype=np.int64)
        self.piece_at[list(ends)] = list(ends.values())

    def matrix(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), max(map(len, words)) + 1), dtype=np.int64)
        get = self.code.get
        first = self.code.get(START, 0)
        for i, w in enumerate(words):
            out[i, 0] = first
            out[i, 1:len(w) + 1] = [get(c, 0) for c in w]
        return out

    def matches(self, letters: np.ndarray, start: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For pieces that begin at ``start``: their end, the rows that have them, and the pieces."""
        rows, node = np.arange(len(letters)), np.zeros(len(letters), dtype=np.int64)
        for at in range(start, letters.shape[1]):
            c = letters[rows, at]
            key = node * self.base + c
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = (self.keys[place] == key) & (c > 0)
            rows, node = rows[ok], self.child[place[ok]]
            if not len(rows):
                return
            piece = self.piece_at[node]
            whole = piece >= 0
            yield at + 1, rows[whole], piece[whole]

    def forward(self, letters: np.ndarray, sizes: np.ndarray, prob: np.ndarray) -> np.ndarray:
        """Sum over the segmentations of every prefix: ``[word, prefix, language]``."""
        n, width = letters.shape
        alpha = np.zeros((n, width + 1, prob.shape[1]))
        alpha[:, 0] = 1.0
        for start in range(width):
            live = start < sizes + 1
            for end, rows, piece in self.matches(letters, start):
                alpha[rows, end] += alpha[rows, start] * prob[piece]
            # One letter may always stand alone, as a strange one.
            alpha[live, start + 1] += alpha[live, start] * STRANGE
        return alpha

    def log_words(self, words: list[str], prob: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.empty((len(words), prob.shape[1]))
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for low, top in ((0, 8), (8, 14), (14, 22), (22, WORD_LETTERS)):
            pick = np.flatnonzero((sizes > low) & (sizes <= top))
            for at in range(0, len(pick), WORDS_AT_ONCE):
                some = pick[at:at + WORDS_AT_ONCE]
                letters = self.matrix([words[i] for i in some])
                alpha = self.forward(letters, sizes[some], prob)
                out[some] = np.log(alpha[np.arange(len(some)), sizes[some] + 1])
        return out

    def expected(self, words: list[str], weight: np.ndarray, prob: np.ndarray) -> np.ndarray:
        """Expected count of each piece in each language over all segmentations of weighted words."""
        counts = np.zeros_like(prob)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        letters = self.matrix(words)
        alpha = self.forward(letters, sizes, prob)
        beta = np.zeros_like(alpha)
        beta[np.arange(len(words)), sizes + 1] = 1.0
        total = alpha[np.arange(len(words)), sizes + 1]
        scale = weight / total
        seen, gained = [], []
        for start in range(letters.shape[1] - 1, -1, -1):
            live = start < sizes + 1
            beta[live, start] += beta[live, start + 1] * STRANGE
            for end, rows, piece in self.matches(letters, start):
                on = prob[piece] * beta[rows, end]
                beta[rows, start] += on  # a row has one piece at most that ends here
                seen.append(piece)
                gained.append(alpha[rows, start] * on * scale[rows])
        if seen:
            piece, gain = np.concatenate(seen), np.concatenate(gained)
            for lang in range(prob.shape[1]):
                counts[:, lang] = np.bincount(piece, gain[:, lang], minlength=len(prob))
        return counts


def fit(docs: DataFrame, model_path: str, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
        per_language: int = SAMPLE_PER_LANGUAGE, rounds: int = ROUNDS, seed: int = 4) -> dict:
    """Piece probabilities of each language, from at most ``per_language`` whole texts of each.

    Rows with a null text, language or key teach nothing. The driver receives one number for each
    piece and language, so the languages must be few. With no rows to learn from there are no
    languages and every text is unknown.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pieces = pieces_of(model_path)
    rows = docs.select(F.col(key_col).alias("key"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sample = bounded_sample(rows.where(F.col("text").isNotNull()), "lang", "key", per_language, seed)

    @lean
    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, texts in frame.groupby("lang")["text"]:
                counted = pd.Series([w for part in chunks(texts) for t in part for w in words_of(t)], dtype=object).value_counts()
                yield pd.DataFrame({"lang": lang, "word": counted.index.astype(object), "n": counted.to_numpy()})

    words = materialize(sample.select("lang", "text").mapInPandas(split, "lang string, word string, n long")
                        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
                        .repartition(spark.sparkContext.defaultParallelism, "word"), "words")
    languages = sorted(r[0] for r in words.select("lang").distinct().collect())
    if not languages:
        return {"pieces": pieces, "languages": [], "prob": np.zeros((len(pieces), 0))}
    tool = spark.sparkContext.broadcast(pieces)
    # Short pieces are likelier than long ones before anything is seen.
    prob = np.repeat((40.0 ** -np.array([len(p) for p in pieces]))[:, None], len(languages), axis=1)
    prob /= prob.sum(axis=0)
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(prob)  # vocabulary x languages

        @lean
        def expect(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            segmenter, counts = Segmenter(tool.value), np.zeros_like(now.value)
            for frame in frames:
                for at in range(0, len(frame), WORDS_AT_ONCE):
                    some = frame.iloc[at:at + WORDS_AT_ONCE]
                    code = some["word"].str.len().clip(upper=WORD_LETTERS)
                    for _, same in some.groupby(pd.cut(code, [0, 8, 14, 22, WORD_LETTERS]), observed=True):
                        spread = same.pivot_table(index="word", columns="lang", values="n", aggfunc="sum", fill_value=0)
                        weight = spread.reindex(columns=languages, fill_value=0).to_numpy(dtype=float)
                        counts += segmenter.expected(list(spread.index), weight, now.value)
            piece, lang = np.nonzero(counts)
            yield pd.DataFrame({"piece": piece, "lang": lang, "n": counts[piece, lang]})

        found = (words.mapInPandas(expect, "piece long, lang long, n double")
                 .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas())
        counts = np.zeros_like(prob)
        counts[found["piece"], found["lang"]] = found["n"]
        prob = (counts + PRIOR_COUNT) / (counts + PRIOR_COUNT).sum(axis=0)
    return {"pieces": pieces, "languages": languages, "prob": prob}


class Scorer:
    """A fitted model with the words it has already scored."""

    def __init__(self, model: dict):
        self.languages, self.prob = model["languages"], model["prob"]
        self.segmenter = Segmenter(model["pieces"])
        self.memory: dict[str, int] = {}
        self.logs = np.zeros((0, len(self.languages)))

    def score(self, texts: list[str]) -> tuple[list[str], list[float]]:
        split = [words_of(t) for t in texts]
        if len(self.memory) > MEMORY:
            self.memory, self.logs = {}, self.logs[:0]
        new = list(set(chain.from_iterable(split)).difference(self.memory))
        if new:
            self.memory.update(zip(new, range(len(self.logs), len(self.logs) + len(new))))
            self.logs = np.concatenate([self.logs, self.segmenter.log_words(new, self.prob)])
        langs, scores = [], []
        for words in split:
            if not words or not self.languages:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            total = self.logs[list(map(self.memory.__getitem__, words))].sum(axis=0)
            best = int(total.argmax())
            langs.append(self.languages[best])
            scores.append(float(1.0 / np.exp(total - total[best]).sum()))
        return langs, scores


def predict(spark: SparkSession, text: Column, model: dict) -> Column:
    """``struct<lang_pred, score>`` of a text column: the likeliest language and its posterior under equal priors.

    A null or empty text, and one without letters, is ``und`` with score 0. Equal likelihoods go to
    the first language in alphabetical order. Texts are scored whole.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # vocabulary x languages

    @pandas_udf("lang_pred string, score double")
    @lean
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in batches:
            langs, scores = [], []
            for part in chunks(texts):
                a, b = scorer.score(part)
                langs += a
                scores += b
            yield pd.DataFrame({"lang_pred": pd.Series(langs, dtype=object), "score": pd.Series(scores, dtype=float)})

    return identify(text)
