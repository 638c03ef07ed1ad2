"""The corpus pipeline: language, toxicity, near-duplicates, mixture, tokens.

Every stage takes the documents its predecessor kept and gives documents of the same columns, the
last one the tokens. ``run`` stores each stage in the shared folder and reads it again, so a lost
executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tiffinlake.llm import bpe, langid, simhash, toxicity
from tiffinlake.llm.queries import TOXIC_FROM, WORD_BPE, language_model, mixture, toxicity_model
from tiffinlake.llm.support import table
from tiffinlake.session import materialize, prepare

# Least posterior of a language; a text below it, and one without letters, is rejected.
LEAST_CERTAIN = 0.5


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the model is fitted on the given documents' learning folds.

    Null and empty texts and texts without letters are rejected, as is a text whose likeliest
    language is less likely than all others together.
    """
    guess = langid.predict(spark, F.col("text"), language_model(spark, sf_dir))
    known = docs.withColumn("__guess", guess).where(
        (F.col("__guess.lang_pred") != langid.UNKNOWN) & (F.col("__guess.score") >= LEAST_CERTAIN))
    return known.select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; a null text counts as empty and stays."""
    score = toxicity.score(spark, F.col("text"), toxicity_model(spark, sf_dir))
    return docs.withColumn("__toxic", score).where(F.col("__toxic") < TOXIC_FROM).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: the lowest id (a null id only if there is no other), then the lowest row checksum."""
    rows = docs.withColumn("__row", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    marked = simhash.classes(rows.select("doc_id", "text", "__row"), carry=["__row"])
    best = marked.groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("best")).select("best.doc_id", "best.__row")
    best = materialize(best, "kept")
    same = (F.col("d.__row") == F.col("b.__row")) & F.col("d.doc_id").eqNullSafe(F.col("b.doc_id"))
    kept = rows.alias("d").join(best.alias("b"), same, "left_semi")
    # Rows equal in every column share id and checksum; the copies of such a row are told apart by number.
    copies = materialize(marked.groupBy("doc_id", "__row").count().where("count > 1").select("doc_id", "__row"), "copies")
    unique = kept.alias("d").join(copies.alias("b"), same, "left_anti").select("d.*").drop("__row")
    if copies.isEmpty():
        return unique.select(docs.columns)
    repeated = kept.alias("d").join(copies.alias("b"), same, "left_semi").select("d.*").drop("__row")
    return unique.unionByName(repeated.distinct()).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of what is left: whole epochs and token prefixes of each leaf; a document read twice is two rows."""
    return mixture(docs).select(docs.columns)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and the text they decode to.

    The ids are stored in between, so that a task never runs two Python workers at once.
    """
    coded = materialize(bpe.encode(docs.select("doc_id", "source", "text"), WORD_BPE), "ids")
    return bpe.decode(coded, WORD_BPE).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", keep_known_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mixture", mix_sources),
    ("tokens", encode_and_decode),
]

# Fitted models, XXH64 and merges can't be said in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is stored and read again before the next."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
