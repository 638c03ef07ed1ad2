"""Directly addressable codes: ids against the tokenizers library, round trips, access at any position, odd tables."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tiffinlake.llm import codes, queries
from tiffinlake.llm.queries import BYTE_BPE

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  a  b ", "a\n\n b\t c d  e", "don't we'll 'S 'tis x''s", "<|endoftext|>x <|endoftext|>", "÷×é123ab!!'s", "ab12 34cd\r\n  ",
       "世界!!! ½ áb", "'", "x'", "\x1c y\x85z", "é'é", "a\x00b", "ªº µ", "᠎ a", "x" * 5000, "no end " * 700]


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(BYTE_BPE)


def lib(theirs, text):
    return theirs.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Z09.,'!\n\té÷世  <|>½'s"), max_size=40), max_size=6))
def test_any_text(texts):
    theirs, coder = Tokenizer.from_file(BYTE_BPE), codes.Coder(BYTE_BPE)
    assert [c.tolist() for c in coder.encode([t.encode() for t in texts])] == [lib(theirs, t) for t in texts]


def test_long_texts_and_memory(theirs, monkeypatch):
    monkeypatch.setattr(codes, "CHUNK_BYTES", 200)
    monkeypatch.setattr(codes, "MEMORY", 50)
    coder = codes.Coder(BYTE_BPE)
    texts = [" ".join(random.Random(i).choices(["the", "cat's", "12", "Ünï", "x!", "\n"], k=600)) for i in range(4)] + ODD
    assert [c.tolist() for c in coder.encode([t.encode() for t in texts])] == [lib(theirs, t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 20), st.integers(0, 70_000), st.integers(0, (1 << 32) - 1)), max_size=60), max_size=8))
def test_segment_round_trip(docs):
    stored = codes.Segment(codes.build_segment(3, 4, [None if i == 1 else i for i in range(len(docs))], [np.array(d, dtype=np.uint32) for d in docs]) + b"\n")
    flat = [x for d in docs for x in d]
    assert stored.span(0, len(flat)).tolist() == flat and (stored.part, stored.number) == (3, 4)
    assert stored.tokens_at(np.arange(len(flat))).tolist() == flat
    for a in range(0, len(flat), 7):
        assert stored.span(a, min(len(flat), a + 11)).tolist() == flat[a:a + 11]


def test_ranks_over_many_blocks():
    ids = np.random.default_rng(1).integers(0, 300, 20_000).astype(np.uint32)
    stored = codes.Segment(codes.build_segment(0, 0, [1], [ids]))
    at = np.random.default_rng(2).integers(0, len(ids), 5_000)
    assert len(stored.levels) > 1 and (stored.tokens_at(at) == ids[at]).all()


def test_query_against_the_library(spark, theirs):
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_codes"](spark, SF).collect()}
    start = 0
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert len(got) == len(docs)
    for doc, text in docs:
        ids = [*lib(theirs, text or ""), 2]
        assert got[doc].asDict() == {"doc_id": doc, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(ids, dtype="<u4").tobytes())}
        start += len(ids)


def test_odd_tables_and_access(spark, base, theirs):
    rows = [(i // 2, t, 9) for i, t in enumerate(ODD)] + [(None, "null id", 1), (None, None, 2), (50, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int").withColumn("row", F.lit("x")).repartition(3)
    codes.write_tokens(docs, BYTE_BPE, base, segment_tokens=64)
    got = codes.documents(spark, base, with_ids=True).orderBy("start").collect()
    ids = [r["doc_id"] for r in got]
    assert ids[:2] == [None, None] and ids[2:] == sorted(r[0] for r in rows if r[0] is not None)
    want = sorted((-1 if i is None else i, lib(theirs, t or "")) for i, t, _ in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["ids"]) for r in got) == want
    flat = [x for r in got for x in r["ids"]]
    asked = spark.createDataFrame([(p,) for p in [*range(len(flat)), 3, 3, -1, len(flat), None]], "position long")
    found = codes.tokens_at(spark, base, asked).collect()
    assert len(found) == len(flat) + 5
    assert all(r["token"] == (flat[r["position"]] if r["position"] is not None and 0 <= r["position"] < len(flat) else None) for r in found)


def test_empty_table(spark, base):
    codes.write_tokens(spark.createDataFrame([], "doc_id long, text string"), BYTE_BPE, base)
    assert codes.documents(spark, base).collect() == []
    assert codes.tokens_at(spark, base, spark.range(2).toDF("position")).where("token is null").count() == 2
