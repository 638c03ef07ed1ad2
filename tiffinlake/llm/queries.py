"""The registered queries of the training-data operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tiffinlake.session import prepare, scratch

from . import audit, bpe, codes, fingerprint, langid, lexical, licenses, mixing, sharding, simhash, topk, toxicity, warc
from .support import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOXIC_FROM = 0.7


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def remainder(key: str, n: int):
    """Fold of a row: its key's checksum modulo ``n``."""
    return F.crc32(F.col(key).cast("string")) % n


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: three-word shingles, links at two differing bits or fewer."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def language_model(spark: SparkSession, sf_dir: str) -> dict:
    """Fitted on the texts and languages of the folds other than 0."""
    docs = table(spark, sf_dir, "documents")
    return langid.fit(docs.where(remainder("doc_id", 5) != 0), PIECES)


@query("op4_language")
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a model that never saw fold 0."""
    model = language_model(spark, sf_dir)
    return table(spark, sf_dir, "documents").select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"),
        langid.predict(spark, F.col("text"), model).alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")


def toxicity_model(spark: SparkSession, sf_dir: str) -> dict:
    """Fitted on the labelled texts of the folds other than 1."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.fit(docs, labels.where(remainder("doc_id", 3) != 1))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model that never saw the labels of fold 1."""
    model = toxicity_model(spark, sf_dir)
    score = toxicity.score(spark, F.col("text"), model)
    return (table(spark, sf_dir, "documents").select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int")))


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), WORD_BPE)
    return bpe.decode(coded, WORD_BPE).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


#: Weights of the mixture's tree by path; nodes not named weigh 1.
MIX_WEIGHTS = {("d0",): 3.0, ("d1",): 2.0, ("d0", "en"): 2.0, ("d1", "en"): 4.0, ("d0", "de", "src0"): 0.5, ("d2", "fr", "src5"): 0.0}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.8, 2.0, 10


def domain_of(source):
    """Domain of a source for the mixture's tree: the remainder of its number by three."""
    return F.concat(F.lit("d"), F.coalesce(F.regexp_extract(source, r"(\d+)$", 1).try_cast("int") % 3, F.lit(2)).cast("string"))


def mixture(docs: DataFrame, **settings) -> DataFrame:
    return mixing.mix(docs, [domain_of(F.col("source")), "lang", "source"], mixing.word_count(F.col("text")),
                      **{"weights": MIX_WEIGHTS, "share": MIX_SHARE, "epochs": MIX_EPOCHS, "seed": MIX_SEED, **settings})


def _mix_sql() -> str:
    def weight(depth: int) -> str:
        cases = "".join(" WHEN " + " AND ".join(f"n{i} = '{v}'" for i, v in enumerate(k)) + f" THEN {w}"
                        for k, w in MIX_WEIGHTS.items() if len(k) == depth)
        return f"CASE{cases} ELSE 1.0 END"

    steps, parent = [], "SELECT *, least(sum(tokens) OVER () * 0.8::DOUBLE, sum(usable) OVER () * 2.0::DOUBLE) AS given0 FROM leaf"
    for d in (1, 2, 3):
        path, family = ", ".join(f"n{i}" for i in range(d)), ", ".join(f"n{i}" for i in range(d - 1)) or "1"
        joined = " AND ".join(f"p.n{i} = k.n{i}" for i in range(d))
        steps.append(f"""
  up{d} AS ({parent}),
  kid{d} AS (SELECT {path}, any_value(given{d - 1}) AS purse, 2.0 * sum(usable) AS room, any_value({weight(d)}) AS w FROM up{d} GROUP BY {path}),
  test{d} AS (SELECT *, w > 0 AND coalesce(sum(room) OVER rise, 0) + room / w * (sum(w) OVER kin - coalesce(sum(w) OVER rise, 0)) <= purse * (1 + 1e-12) AS sated
    FROM kid{d} WINDOW kin AS (PARTITION BY {family}), rise AS (PARTITION BY {family} ORDER BY CASE WHEN w > 0 THEN room / w ELSE 'inf'::DOUBLE END, {path}
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  got{d} AS (SELECT {path}, CASE WHEN sated THEN room WHEN w > 0 THEN least(room, (purse - coalesce(sum(room) FILTER (sated) OVER kin, 0)) * w / sum(w) FILTER (NOT sated) OVER kin) ELSE 0 END AS given{d}
    FROM test{d} WINDOW kin AS (PARTITION BY {family}))""")
        parent = f"SELECT p.*, k.given{d} FROM up{d} p JOIN got{d} k ON {joined}"
    return f"""
WITH doc AS (
  SELECT doc_id, lang, source, 'd' || coalesce(try_cast(regexp_extract(source, '(\\d+)$', 1) AS INT) % 3, 2) AS n0,
    coalesce(lang, '') AS n1, coalesce(source, '') AS n2,
    coalesce(len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')), 0) AS size
  FROM documents),
  leaf AS (SELECT *, CASE WHEN {" OR ".join(f"{weight(d)} = 0" for d in (1, 2, 3))} THEN 0 ELSE tokens END AS usable
    FROM (SELECT n0, n1, n2, sum(size) AS tokens FROM doc GROUP BY ALL)),{",".join(steps)},
  plan AS (SELECT n0, n1, n2, tokens, floor(given3 / tokens + 1e-9)::BIGINT AS rounds, floor(given3 + 1e-6)::BIGINT AS whole FROM ({parent})),
  run AS (SELECT d.*, rounds, whole - rounds * tokens AS left_over,
      sum(size) OVER (PARTITION BY n0, n1, n2 ORDER BY md5('{MIX_SEED}:' || rounds || ':' || doc_id), size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
    FROM doc d JOIN plan USING (n0, n1, n2)),
  times AS (SELECT *, rounds + (left_over > 0 AND upto <= left_over)::BIGINT AS n FROM run)
SELECT doc_id, n0 AS domain, lang, source, e AS mix_epoch, size::BIGINT AS mix_tokens, CASE WHEN e = rounds THEN upto END AS mix_place
FROM (SELECT *, unnest(range(n)) AS e FROM times)
"""


@query("op10_mixing", _mix_sql())
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all documents: which are read, in which epochs, with their tokens and places."""
    docs = table(spark, sf_dir, "documents")
    return mixture(docs).select("doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source", "mix_epoch", "mix_tokens", "mix_place")


SHARDS, SHARD_SEED = 24, 1

#: CRC-32 of UTF-8 text: the table follows from the polynomial, the bytes from the hexadecimal form.
_CRC_SQL = """
  crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
  summed AS (SELECT documents.*, coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(
        regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295), 0) AS text_crc32
    FROM documents, crc_table)"""

_SHARD_SQL = f"""
WITH {_CRC_SQL.strip()},
  named AS (SELECT *, coalesce(octet_length(encode(text)), 0) + 8 AS size, coalesce('=' || source, '') AS s,
      md5('{SHARD_SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32) AS h FROM summed),
  spread AS (SELECT *, (row_number() OVER (PARTITION BY s ORDER BY h, doc_id, size) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY s) AS f FROM named),
  lined AS (SELECT *, row_number() OVER (ORDER BY f, s, h, doc_id, size) - 1 AS place, count(*) OVER () AS n FROM spread),
  cut AS (SELECT *, (place * {SHARDS} // n)::INT AS shard FROM lined)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, NULL::INT AS grown_shard
FROM cut
"""


@query("op1_sharding", _SHARD_SQL)
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by proportional interleaving; the law is equal numbers of rows."""
    out = sharding.interleave(table(spark, sf_dir, "documents"), SHARDS, seed=SHARD_SEED)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op2_topk", """
WITH vecs AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  parts AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM vecs),
  scored AS (SELECT q.vec_id AS query_id, p.vec_id, sum(q.x * p.x)::BIGINT AS score
    FROM parts q JOIN parts p ON q.i = p.i AND q.vec_id <> p.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
""")
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows for every vector whose id is divisible by 100, against all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors.where("vec_id % 100 = 0"), vectors, 10)


@query("op5_fingerprint")
def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted-sample fingerprints of every document, its edited text and the likeness to it and to the next document."""
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


@query("op6_licenses")
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families of every document."""
    docs = table(spark, sf_dir, "documents")
    found = licenses.scan(docs, licenses.fit(docs))
    return found.withColumn("families", F.array_join("families", ",")).withColumn("n_licence_paragraphs", F.col("n_licence_paragraphs").cast("int"))


def crawl(pages: DataFrame) -> DataFrame:
    """Two records of every page: its capture, and a later visit that the server answered with "not modified".

    The visit comes after a delay that depends on the page, by another form of the URL. Some servers
    have since changed the entity tag, some give a weak one, some only a time.
    """
    id, tag = F.col("page_id"), F.substring(F.md5("html"), 1, 12)
    since = F.concat(F.lit("t"), id.cast("string"))
    common = [F.col("url"), F.md5("html").alias("digest")]
    empty = F.lit(None).cast("string")
    first = pages.select(
        F.concat(F.lit("r"), id.cast("string")).alias("record_id"), *common, (id * 2).alias("date"), F.lit("response").alias("type"),
        F.when(id % 13 != 0, tag).alias("etag"), since.alias("last_modified"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("cache-control"), F.lit("max-age=60"), F.lit("server"), F.lit("s"),
                     F.lit("date"), (id * 2).cast("string")).alias("headers"))
    when = id * 2 + 1 + (id % 7) * 200
    again = pages.select(
        F.concat(F.lit("v"), id.cast("string")).alias("record_id"),
        F.concat(F.regexp_replace("url", "#.*$", ""), F.when(F.col("url").contains("?"), "&utm_source=x").otherwise(F.when(id % 2 == 0, "?ref=y").otherwise("#z"))).alias("url"),
        F.when(id % 17 != 0, F.md5("html")).alias("digest"), when.alias("date"), F.lit("revisit").alias("type"),
        F.when(id % 11 == 0, F.lit("other")).when(id % 5 == 0, F.concat(F.lit("W/"), tag)).when(id % 3 == 0, empty).otherwise(tag).alias("etag"),
        F.when(id % 19 != 0, since).alias("last_modified"),
        F.create_map(F.lit("content-type"), F.lit("text/plain"), F.lit("cache-control"), F.lit("max-age=5"), F.lit("set-cookie"), F.lit("c"),
                     F.lit("date"), when.cast("string")).alias("headers"))
    return first.unionByName(again)


@query("op7_revisits", r"""
WITH crawl AS (
  SELECT 'r' || page_id AS record_id, url, page_id * 2 AS date, TRUE AS whole, CASE WHEN page_id % 13 <> 0 THEN substr(md5(html), 1, 12) END AS etag,
    't' || page_id AS modified, md5(html) AS digest, NULL AS fresh FROM pages
  UNION ALL
  SELECT 'v' || page_id, regexp_replace(url, '#.*$', '') || CASE WHEN contains(url, '?') THEN '&utm_source=x' WHEN page_id % 2 = 0 THEN '?ref=y' ELSE '#z' END,
    page_id * 2 + 1 + (page_id % 7) * 200, FALSE,
    CASE WHEN page_id % 11 = 0 THEN 'other' WHEN page_id % 5 = 0 THEN substr(md5(html), 1, 12) WHEN page_id % 3 = 0 THEN NULL ELSE substr(md5(html), 1, 12) END,
    CASE WHEN page_id % 19 <> 0 THEN 't' || page_id END, CASE WHEN page_id % 17 <> 0 THEN md5(html) END, page_id * 2 + 1 + (page_id % 7) * 200 FROM pages),
  bare AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM crawl),
  parts AS (SELECT *, regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^(www|m)[.]|:(80|443)$', '', 'g') AS host,
    regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '(/index[.]html?|/+)$', '', 'g') AS path,
    list_filter(list_sort(string_split(regexp_extract(b, '[?](.*)$', 1), '&')),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(ref|utm_[a-z]+|gclid|fbclid|sessionid)(=|$)')) AS q FROM bare),
  keyed AS (SELECT *, host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS key FROM parts),
  best AS (SELECT v.record_id, v.key, v.fresh, v.etag AS e1, v.modified AS m1, v.digest AS d1,
      max({'date': r.date, 'id': r.record_id, 'etag': r.etag, 'modified': r.modified, 'digest': r.digest}) AS o
    FROM keyed v LEFT JOIN keyed r ON r.key = v.key AND r.whole AND r.date < v.date WHERE NOT v.whole GROUP BY ALL),
  judged AS (SELECT *, CASE WHEN o.id IS NULL THEN 'missing' WHEN e1 = o.etag THEN 'merged' WHEN e1 <> o.etag THEN 'mismatch' WHEN m1 = o.modified THEN 'merged'
    WHEN m1 <> o.modified THEN 'mismatch' WHEN d1 = o.digest THEN 'merged' WHEN d1 <> o.digest THEN 'mismatch' ELSE 'unverified' END AS outcome FROM best)
SELECT record_id, key, o.id AS refers_to, outcome,
  CASE WHEN outcome = 'merged' THEN 'cache-control: max-age=5' || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || fresh || chr(10) || 'server: s' END AS headers
FROM judged
""")
def op7_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every not-modified visit of the crawled pages with the capture it refers to and its merged headers."""
    found = warc.resolve_revisits(crawl(table(spark, sf_dir, "pages")))
    lines = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return found.withColumn("headers", lines)


@query("op11_codes")
def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written as directly addressable codes, and what is read back from the files."""
    folder = scratch(spark, "codes")
    codes.write_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, folder, end_id=2)
    return codes.documents(spark, folder)


@query("op12_audit", r"""
WITH words AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  tested AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, {
      'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w), 'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
      'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE)} AS fails
    FROM words LEFT JOIN (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id) USING (doc_id)),
  cells AS (SELECT part, (CASE WHEN fails.A THEN 'A' ELSE '' END) || (CASE WHEN fails.B THEN 'B' ELSE '' END) || (CASE WHEN fails.C THEN 'C' ELSE '' END)
      || (CASE WHEN fails.D THEN 'D' ELSE '' END) || (CASE WHEN fails.E THEN 'E' ELSE '' END) AS failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM tested GROUP BY ALL),
  letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
  orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letter a, letter b, letter c, letter d, letter e
    WHERE a.l NOT IN (b.l, c.l, d.l, e.l) AND b.l NOT IN (c.l, d.l, e.l) AND c.l NOT IN (d.l, e.l) AND d.l <> e.l),
  steps AS (SELECT *, substr(filter_order, step, 1) AS l, left(filter_order, step - 1) AS earlier FROM orders, range(1, 6) r(step)),
  judged AS (SELECT part, filter_order, step, l, n, good, toxic, contains(failed, l) AS fails, failed = l AS alone,
      translate(failed, earlier, '') <> failed AS gone FROM cells, steps),
  counted AS (SELECT part, filter_order, step::INT AS step, l, coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept,
      coalesce(sum(n) FILTER (NOT gone AND fails), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (gone AND fails), 0)::BIGINT AS redundant,
      coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (NOT gone AND fails), 0)::BIGINT AS good_lost,
      coalesce(sum(toxic) FILTER (NOT gone AND fails), 0)::BIGINT AS toxic_lost
    FROM judged GROUP BY ALL)
SELECT * EXCLUDE (l), (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley FROM counted
""")
def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents by language: what each removes at each step of all 120 orders."""
    return audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_lexical", r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
  item AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
  total AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS length FROM doc WHERE len(terms) > 0),
  posting AS (SELECT doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM doc),
  tf AS (SELECT doc_id, n, term, count(*) AS tf FROM posting GROUP BY ALL),
  weighed AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term),
  scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::BIGINT AS score
    FROM item JOIN tf USING (term) JOIN weighed USING (term), total GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
""")
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for every benchmark item, against all documents."""
    return lexical.search(lexical.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), 50)
