"""Ranked search against scores of all pairs, true bounds, pruning, and odd tables."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tiffinlake.llm import lexical, queries

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(bool(b) for _, b in bags)
    length = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = {}
    for place, (_, text) in enumerate(items):
        found = []
        for i, bag in bags:
            m = 100 - 50 + (50 * sum(bag.values()) * n) // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m))
                        for t in set(terms(text)) if t in bag)
            if score > 0 and i is not None:
                found.append((-score, i))
        out[place] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


def test_terms_of_bytes():
    for text in ["", "a-B_c 1é2\x00ÀÉ ΣΑΣ x\x7fy~z`q", "İ K 世界!!", None]:
        assert [t.decode() for t in lexical.terms_of(text.encode() if text is not None else None)] == terms(text)


def test_query_against_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = defaultdict(list)
    for r in queries.QUERIES["op13_lexical"](spark, SF).orderBy("item_id", "rank").collect():
        got[r["item_id"]].append((r["doc_id"], r["score"]))
        assert r["rank"] == len(got[r["item_id"]])
    assert got == {items[p][0]: found for p, found in brute(docs, items, 50).items() if found}


@pytest.mark.parametrize("frequent,block", [(50_000, 512), (3, 2), (0, 1)])
def test_odd_tables(spark, frequent, block):
    r = random.Random(5)
    words = ["the", "The", "cat", "ünï", "x1", "rare", "世界", "dog-house"]
    docs = [(i if i % 9 else None, " ".join(r.choices(words, weights=[9, 3, 3, 2, 2, .2, .5, 1], k=r.randrange(12))), 1, "s") for i in range(120)]
    docs += [(500, None, 1, "s"), (501, "", 1, "s"), (502, "rare " * 30_000, 1, "s"), (7, docs[7][1], 1, "s"), (7, docs[7][1], 1, "s")]
    items = [(1, "the rare cat"), (None, "DOG house"), (3, None), (4, "unknown words"), (1, "the rare cat"), (6, "...")]
    table = spark.createDataFrame(docs, "doc_id long, text string, n int, sketch string")
    asked = spark.createDataFrame(items, "item_id int, text string").withColumn("place", F.lit(0)).coalesce(1)
    index = lexical.build(table, frequent=frequent)
    got = Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical.search(index, asked, 5, query_block=block).collect())
    assert got == Counter((items[p][0], i, *pair) for p, found in brute([d[:2] for d in docs], items, 5).items() for i, pair in enumerate(found, 1))


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert lexical.search(lexical.build(docs), items).collect() == []
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lexical.search(lexical.build(some), items.limit(0)).collect() == []


def test_bounds_hold_and_prune():
    r = random.Random(2)
    topics = [[f"t{t}w{i}" for i in range(60)] for t in range(30)]
    common = [f"c{i}" for i in range(40)]
    docs = [(" ".join(r.choices(topics[i % 30], k=25) + r.choices(common, k=40))).encode() for i in range(6000)]
    bags = [Counter(lexical.terms_of(d)) for d in docs]
    df = Counter(t for b in bags for t in b)
    length = sum(map(len, map(lexical.terms_of, docs)))
    asked = [[(t, df[t]) for t in {w.encode() for w in topics[q][:12] + common[:5]}] for q in range(10)]
    batch = lexical.Batch(asked, len(docs), length, 10)
    folder = lexical.Folder(len(docs), length, dict(df.most_common(500)))
    sizes, top, sketches = folder.fold(docs)
    bound = batch.bounds(top, sketches).astype(np.float64) * lexical.UNIT
    for q in range(3):
        for i in range(0, 6000, 37):
            m = int(lexical.dampers(np.array([sizes[i]]), len(docs), length)[0])
            exact = sum(lexical.weight(len(docs), d) * ((10**9 * bags[i][t]) // (1000 * bags[i][t] + 20 * m)) for t, d in asked[q] if t in bags[i])
            assert bound[q, i] >= exact
    batch.meet(np.arange(6000), sizes, top, sketches, pa.array(docs, pa.binary()))
    # Only documents of a query's own topic, one in thirty, come near its best ones.
    assert batch.met == 60_000 and batch.scored < 0.1 * batch.met
    assert batch.found(3)[0].tolist() and all(i % 30 == 3 for i in batch.found(3)[0])
