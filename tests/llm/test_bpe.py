"""Encoding and decoding against the tokenizers library, on whole documents and on odd texts."""

import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tiffinlake.llm import bpe
from tiffinlake.llm.queries import WORD_BPE

ODD = ["", " ", "a" * 3000, "ab" * 900, "the" * 300, "<|endoftext|>hi<|startoftext|> <|ENDOFTEXT|>", "don't we'll 'S", "ΟΔΟΣ İI é é",
       "x\x1cy\x85z 　w", "Ᲊ \U00011f02 ՘", "lolololohaha" * 9, "123²½ 世界!!!", None]


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(**bpe.load(WORD_BPE))


def ids_of(encoder, texts):
    flat, counts = encoder.encode(texts)
    ends = [0]
    for n in counts:
        ends.append(ends[-1] + int(n))
    return [flat[a:b].tolist() for a, b in zip(ends, ends[1:])]


def test_documents_and_odd_texts(spark, theirs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(ODD)], docs.schema))
    docs = docs.withColumnRenamed("doc_id", "decoded").withColumn("ids", docs.text)  # clashing names
    coded = bpe.decode(bpe.encode(docs, WORD_BPE).withColumnRenamed("decoded", "key"), WORD_BPE).collect()
    texts = {r["decoded"]: r["text"] or "" for r in docs.collect()}
    assert len(coded) == len(texts)
    for row in coded:
        want = theirs.encode(texts[row["key"]], add_special_tokens=False).ids
        assert row["ids"] == want
        assert row["decoded"] == theirs.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(encoder, theirs, text):
    assert ids_of(encoder, [text]) == [theirs.encode(text, add_special_tokens=False).ids]


def test_many_words_of_few_letters(encoder, theirs):
    random.seed(3)
    texts = ["".join(random.choice("lohaeint") for _ in range(random.randint(0, 70))) for _ in range(3000)]
    assert ids_of(encoder, texts) == [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]


def test_failing_words_are_merged_exactly(encoder):
    words = [w.encode() for w in ("thonly", "hation", "erhati", "the", "instead")]
    tokens, counts, failed = encoder.learn(words)
    assert 0 < failed < len(words) and counts.sum() == len(tokens)


def test_empty_table_and_unknown_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(empty, WORD_BPE), WORD_BPE).collect() == []
    schema = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
    rows = bpe.decode(spark.createDataFrame([([0, 999_999, -4, 49407],), (None,), ([],)], schema), WORD_BPE).collect()
    assert [r["decoded"] for r in rows] == ["! <|endoftext|>", "", ""]
