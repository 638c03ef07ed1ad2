"""BPE encoding that guesses and checks: longest matches first, every neighbouring pair tested at once, merges only for failures.

The result equals the public tokenizer whose vocabulary file is given: Unicode composition, white
space, lower case, word pieces, bytes and merges as that file's own settings name them.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Regex
from tokenizers.normalizers import NFC, Lowercase, Sequence
from tokenizers.pre_tokenizers import Split

from .support import chunks, lean, small_batches

# The word pattern of the vocabulary, and the suffix of a word's last token.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{digit}|[^{letter}{digit}]+"
END = "</w>"
NOT_WHITE = regex.compile(r"[^\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

NEVER = np.iinfo(np.int64).max
# End of the planes that hold letters and digits.
LAST_LETTER = 0x40000
# Runs of text a worker remembers between chunks, and characters of a chunk.
MEMORY = 200_000
CHUNK_CHARS = 1_000_000
DECODE_TOKENS = 500_000
# Bytes of a word up to which words are handled side by side; longer ones one by one.
SIDE_BY_SIDE = (8, 12, 16, 24, 40)
STOP = 256  # code of a word's end, after the 256 bytes


def byte_letters() -> list[str]:
    """A visible character for each byte: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def _ranges(points: list[int]) -> str:
    """Code points as the inside of a pattern class."""
    cuts = [i for i, (a, b) in enumerate(zip(points, points[1:]), 1) if b != a + 1]
    runs = [points[i:j] for i, j in zip([0, *cuts], [*cuts, len(points)])] if points else []
    return "".join(rf"\U{r[0]:08x}-\U{r[-1]:08x}" for r in runs)


def letter_class(kind: str) -> str:
    """Pattern class of the characters that the public tokenizer takes for letters (L) or digits (N).

    Pattern libraries know different versions of Unicode, so the difference is looked up once.
    """
    every = "".join(chr(c) for c in range(LAST_LETTER) if not 0xD800 <= c < 0xE000)
    theirs = {ord(c) for part, _ in Split(Regex(rf"\p{{{kind}}}"), "removed", invert=True).pre_tokenize_str(every) for c in part}
    ours = {ord(c) for c in regex.findall(rf"\p{{{kind}}}", every)}
    more, less = _ranges(sorted(theirs - ours)), _ranges(sorted(ours - theirs))
    return rf"[[\p{{{kind}}}{more}]--[{less}]]" if less else rf"[\p{{{kind}}}{more}]"


def _read(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def load(path: str) -> dict:
    """Vocabulary, merges, added tokens and character classes for a tokenizer file, read on the driver."""
    spec = _read(path)
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    return {"vocab": spec["model"]["vocab"], "merges": merges, "letter": letter_class("L"), "digit": letter_class("N"),
            "added": {t["content"]: t["id"] for t in spec["added_tokens"]}}


def ragged(starts: np.ndarray, counts: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """Positions of the entries of the picked lists, one list after the other."""
    n = counts[pick]
    return np.repeat(starts[pick] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def side_by_side(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of byte codes, and their sizes."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    rows = np.zeros((len(words), int(sizes.max())), dtype=np.int64)
    rows[np.arange(rows.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(words), dtype=np.uint8)
    return rows, sizes


class Encoder:
    """Tables of one vocabulary, and the runs of text already encoded."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], added: dict[str, int], letter: str, digit: str):
        self.vocab, self.added = vocab, added
        size = max([*vocab.values(), *added.values()]) + 1
        self.size = size
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        self.pair_rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            x, y, made = vocab[a], vocab[b], vocab[a + b]
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = r, x, y
            self.pair_rank.setdefault((x, y), (r, made))
        keys = np.array([x * size + y for x, y in self.pair_rank], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_order = np.array([r for r, _ in self.pair_rank.values()], dtype=np.int64)[order]
        self.pair_made = np.array([made for _, made in self.pair_rank.values()], dtype=np.int64)[order]
        letters = byte_letters()
        self.byte_id = np.array([vocab.get(c, -1) for c in letters])
        self.last_byte_id = np.array([vocab.get(c + END, -1) for c in letters])
        self._grow_trie({c: b for b, c in enumerate(letters)})
        self.pattern = regex.compile(WORDS.format(letter=letter, digit=digit), regex.V1)
        self.normalizer = Sequence([NFC(), Lowercase()])
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self._forget()

    def _forget(self) -> None:
        self.memory: dict[str | int, int] = {}
        self.tokens = np.zeros(0, dtype=np.int32)
        self.counts = np.zeros(0, dtype=np.int64)

    def _grow_trie(self, byte_of: dict[str, int]) -> None:
        """A trie of the tokens that their own merges restore; others are never proposed."""
        made = np.flatnonzero(self.rank >= 0)
        made = made[np.argsort(self.rank[made])]
        restored = np.ones(self.size, dtype=bool)
        for token, kept in zip(made, self.compatible(self.left[made], self.right[made], self.rank[made])):
            restored[token] = kept and restored[self.left[token]] and restored[self.right[token]]
        nodes, keys, self.node_token = 1, {}, {0: -1}
        for text, token in self.vocab.items():
            if not restored[token]:
                continue
            codes = [byte_of[c] for c in text.removesuffix(END)] + [STOP] * text.endswith(END)
            node = 0
            for code in codes:
                key = node * (STOP + 1) + code
                if key not in keys:
                    keys[key] = nodes
                    nodes += 1
                node = keys[key]
            self.node_token[node] = token
        self.trie_keys = np.array(sorted(keys), dtype=np.int64)
        self.trie_next = np.array([keys[k] for k in self.trie_keys.tolist()], dtype=np.int64)
        token = np.full(nodes, -1, dtype=np.int64)
        token[list(self.node_token)] = list(self.node_token.values())
        self.node_token = token

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether merging the joined strings of tokens ``a`` and ``b`` keeps the border between them.

        Merges are undone backwards in time on both sides of the border, the later one first. Two
        pieces that meet at the border exist together until one of them is merged on; their own
        merge crosses the border if it comes before that. At equal times the left pair goes first.
        """
        a, b = a.copy(), b.copy()
        a_until = np.full(len(a), NEVER) if until is None else until.copy()
        b_until = np.full(len(b), NEVER) if until is None else until - 1
        good = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            r = np.where(self.pair_keys[at] == key, self.pair_order[at], NEVER)
            crossed = (r < a_until[live]) & (r <= b_until[live]) & (r != NEVER)
            good[live[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~crossed & ((rx >= 0) | (ry >= 0))
            live, rx, ry = live[go], rx[go], ry[go]
            on_left = rx > ry
            i, j = live[on_left], live[~on_left]
            a_until[i], b_until[j] = rx[on_left], ry[~on_left]
            a[i], b[j] = self.right[a[i]], self.left[b[j]]
        return good

    def _pair_ranks(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair and the token it makes; NEVER where there is no merge or no pair (negative ids)."""
        key = np.where((x < 0) | (y < 0), -1, x * self.size + y)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        known = self.pair_keys[at] == key
        return np.where(known, self.pair_order[at], NEVER), self.pair_made[at]

    def merged_together(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Exact merging of words given as rows of bytes, the best pair of each word at every step; ends are filled with -1."""
        n, width = rows.shape
        place = np.arange(width)
        parts = np.where(place == sizes[:, None] - 1, self.last_byte_id[rows], self.byte_id[rows])
        parts[place >= sizes[:, None]] = -1
        out = np.full((n, width), -1, dtype=np.int64)
        row_of = np.arange(n)
        ranks, made = self._pair_ranks(parts[:, :-1], parts[:, 1:])
        while len(row_of):
            width = parts.shape[1]
            best = ranks.argmin(axis=1) if width > 1 else np.zeros(len(row_of), dtype=np.int64)
            done = ranks[np.arange(len(row_of)), best] == NEVER if width > 1 else np.ones(len(row_of), dtype=bool)
            out[row_of[done], :width] = parts[done]
            keep = ~done
            row_of, parts, ranks, made, best = row_of[keep], parts[keep], ranks[keep], made[keep], best[keep]
            if not len(row_of):
                break
            n = len(row_of)
            i = np.arange(n)
            parts[i, best] = made[i, best]
            parts = parts[np.arange(width) != best[:, None] + 1].reshape(n, width - 1)
            stay = np.arange(width - 1) != best[:, None]
            ranks, made = ranks[stay].reshape(n, width - 2), made[stay].reshape(n, width - 2)
            for col, ok in ((best - 1, best >= 1), (best, best < width - 2)):
                r, c = i[ok], col[ok]
                ranks[r, c], made[r, c] = self._pair_ranks(parts[r, c], parts[r, c + 1])
        return out

    def merged(self, word: bytes) -> list[int]:
        """Exact merging of one word: the lowest-ranked pair first, the leftmost among equals."""
        codes = np.frombuffer(word, dtype=np.uint8)
        parts = [*self.byte_id[codes[:-1]].tolist(), int(self.last_byte_id[codes[-1]])]
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        queue = [(self.pair_rank[p][0], i, p) for i, p in enumerate(zip(parts, parts[1:])) if p in self.pair_rank]
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = self.pair_rank[pair][1], None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (p := (parts[x], parts[y])) in self.pair_rank:
                    heapq.heappush(queue, (self.pair_rank[p][0], x, p))
        return [p for p in parts if p is not None]

    def proposed(self, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest vocabulary entries from left to right for all words at once, ends filled with -1; and who has none somewhere."""
        out = np.full((len(rows), rows.shape[1]), -1, dtype=np.int64)
        stuck = np.zeros(len(rows), dtype=bool)
        live, at, nth = np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64), 0
        while len(live):
            size = sizes[live]
            token, to = np.full(len(live), -1, dtype=np.int64), np.zeros(len(live), dtype=np.int64)
            walk, node, ahead = np.arange(len(live)), np.zeros(len(live), dtype=np.int64), at[live]
            while len(walk):
                end = ahead == size[walk]
                code = np.where(end, STOP, rows[live[walk], np.minimum(ahead, rows.shape[1] - 1)])
                key = node * (STOP + 1) + code
                found = np.minimum(np.searchsorted(self.trie_keys, key), len(self.trie_keys) - 1)
                ok = self.trie_keys[found] == key
                walk, node, ahead, end = walk[ok], self.trie_next[found[ok]], ahead[ok] + 1, end[ok]
                hit = self.node_token[node]
                # A token may stop inside the word or after its end mark, not between the last byte and the mark.
                whole = (hit >= 0) & ((ahead != size[walk]) | end)
                token[walk[whole]], to[walk[whole]] = hit[whole], ahead[whole]
                walk, node, ahead = walk[~end], node[~end], ahead[~end]
            stuck[live[token < 0]] = True
            out[live, nth] = token
            at[live] = to
            nth += 1
            live = live[(token >= 0) & (to <= size)]
        return out, stuck

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """Tokens of distinct words, one word after the other, their numbers, and how many words were merged exactly."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        counts, place, found, failed, low = np.zeros(len(words), dtype=np.int64), [], [], 0, 0
        for top in SIDE_BY_SIDE:
            pick = np.flatnonzero((sizes > low) & (sizes <= top))
            low = top
            if not len(pick):
                continue
            rows, n = side_by_side([words[i] for i in pick])
            guess, wrong = self.proposed(rows, n)
            a, b = guess[:, :-1], guess[:, 1:]
            r, c = np.nonzero((a >= 0) & (b >= 0))
            keys, which = np.unique(a[r, c] * self.size + b[r, c], return_inverse=True)
            wrong[r[~self.compatible(keys // self.size, keys % self.size)[which]]] = True
            if wrong.any():
                failed += int(wrong.sum())
                guess[wrong] = self.merged_together(rows[wrong], n[wrong])
            real = guess >= 0
            counts[pick] = real.sum(axis=1)
            place.append(pick)
            found.append(guess[real])
        for i in np.flatnonzero(sizes > low):
            tokens = [t for t in self.merged(words[i]) if t >= 0]
            counts[i] = len(tokens)
            place.append(np.array([i]))
            found.append(np.array(tokens, dtype=np.int64))
        if not place:
            return np.zeros(0, dtype=np.int32), counts, 0
        order, flat = np.concatenate(place), np.concatenate(found)
        starts = np.zeros(len(words), dtype=np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return flat[ragged(starts, counts, np.arange(len(words)))].astype(np.int32), counts, failed

    def pieces(self, text: str) -> list[str | int]:
        """Runs without white space of the text as it is normalised, and ids of added tokens standing in it."""
        out, at = [], 0
        for found in (self.special.finditer(text) if self.special else ()):
            out += [*self._runs(text[at:found.start()]), self.added[found.group()]]
            at = found.end()
        return out + self._runs(text[at:]) if at else self._runs(text)

    def _runs(self, text: str) -> list[str]:
        if not text.isascii():
            if "Cn" in map(unicodedata.category, set(text)):  # unknown to this Python's Unicode tables
                text = self.normalizer.normalize_str(text)
            # Each letter is lowered by itself: a final sigma stays an ordinary one.
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        text = text.lower()
        # Python's split also takes the separators 1C to 1F, which are no white space to the vocabulary.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return NOT_WHITE.findall(text)
        return text.split()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and their numbers. New runs are cut into words and encoded together."""
        split = [self.pieces(t) for t in texts]
        if len(self.memory) > MEMORY:
            self._forget()
        known = self.memory
        new = list(set(chain.from_iterable(split)).difference(known))
        if new:
            index: dict[str, int] = {}
            cut = [self.pattern.findall(r) if isinstance(r, str) else [] for r in new]
            word = np.fromiter((index.setdefault(w, len(index)) for words in cut for w in words), dtype=np.int64)
            tokens, counts, _ = self.learn([w.encode() for w in index])
            starts = np.cumsum(counts) - counts
            ends = np.r_[0, np.cumsum(counts[word])]
            edge = np.r_[0, np.cumsum([len(w) for w in cut])]
            known.update(zip(new, range(len(self.counts), len(self.counts) + len(new))))
            self.counts = np.r_[self.counts, ends[edge[1:]] - ends[edge[:-1]]]
            self.tokens = np.r_[self.tokens, tokens[ragged(starts, counts, word)]]
            for token in [r for r in new if isinstance(r, int)]:  # an added token stands for itself
                known[token] = len(self.counts)
                self.counts, self.tokens = np.r_[self.counts, 1], np.r_[self.tokens, np.int32(token)]
        runs = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), dtype=np.int64)
        starts = np.cumsum(self.counts) - self.counts
        ends = np.r_[0, np.cumsum(self.counts[runs])]
        edge = np.r_[0, np.cumsum([len(r) for r in split])].astype(np.int64)
        return self.tokens[ragged(starts, self.counts, runs)], ends[edge[1:]] - ends[edge[:-1]]


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with its text column replaced by ``array<int>`` token ids, by the tokenizer file at ``path`` (read on the driver).

    A null or empty text gives an empty array. Texts are taken whole; a worker holds one chunk of
    texts and a bounded memory of runs. Other columns pass unchanged; one named like the ids is
    replaced. Repeated rows stay; an empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    spec = docs.sparkSession.sparkContext.broadcast(load(path))  # the size of the vocabulary file
    kept = [c for c in docs.columns if c not in (text_col, ids_col)]

    @lean
    def bpe_encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(**spec.value)
        for batch in batches:
            at = 0
            for part in chunks((t.as_py() for t in batch.column(len(kept))), CHUNK_CHARS):
                ids, counts = encoder.encode(part)
                lists = pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int64()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.slice(at, len(part)).columns[:len(kept)], lists.cast(pa.list_(pa.int32()))], [*kept, ids_col])
                at += len(part)

    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return docs.select(*[F.col(f"`{c}`") for c in [*kept, text_col]]).mapInArrow(bpe_encode, schema)


def decode(coded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``coded`` with a text column: the tokens of the ids joined by a space, as the file's missing decoder implies.

    Added tokens are kept, ids outside the vocabulary skipped; a null array gives an empty text.
    """
    small_batches(coded.sparkSession)
    spec = _read(path)
    size = max([*spec["model"]["vocab"].values(), *[t["id"] for t in spec["added_tokens"]]]) + 1
    names: list[str | None] = [None] * size
    for token, at in [*spec["model"]["vocab"].items(), *[(t["content"], t["id"]) for t in spec["added_tokens"]]]:
        names[at] = token
    shown = coded.sparkSession.sparkContext.broadcast(names)
    kept = [c for c in coded.columns if c != text_col]
    at = kept.index(ids_col)

    @lean
    def bpe_decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(shown.value, pa.string())
        named = np.array([name is not None for name in shown.value])
        for batch in batches:
            lists = batch.column(at)
            numbers = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
            for a, b in stretches(numbers, DECODE_TOKENS):
                flat = lists.slice(a, b - a).flatten()
                ids = flat.fill_null(-1).to_numpy(zero_copy_only=False)
                real = (ids >= 0) & (ids < len(tokens))
                real[real] &= named[ids[real]]
                text = tokens.take(pa.array(np.where(real, ids, 0))).filter(pa.array(real))
                ends = np.r_[0, np.cumsum(real)][np.r_[0, np.cumsum(numbers[a:b])]]
                parts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), text)
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pc.binary_join(parts, " ")], [*kept, text_col])

    schema = T.StructType([*[coded.schema[c] for c in kept], T.StructField(text_col, T.StringType())])
    return coded.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(bpe_decode, schema)


def stretches(numbers: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows with about ``limit`` entries together."""
    ends = np.cumsum(numbers)
    a = 0
    while a < len(numbers):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, side="right")))
        yield a, b
        a = b
