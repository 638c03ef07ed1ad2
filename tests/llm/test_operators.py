"""The other operators against brute force, and their edge cases: nulls, empty texts, ties, repeats, empty tables, clashing names."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tiffinlake.llm import fingerprint, langid, licenses, mixing, queries, sharding, simhash, topk, toxicity, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, None), (4, ""), (None, "x y z"), (5, "w " * 20_000), (6, "Ünïcode wörds hier"), (7, "...")]
    return spark.createDataFrame([(i, t, "en" if t else None, None if i == 4 else f"s{(i or 0) % 2}", 1, 0.5, 9) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def brute_print(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    every = list(root)
    for i, a in enumerate(every):
        for b in every[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {p: find(p) for p in every}


def test_simhash_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: brute_print(t) for i, t in docs.items()}
    classes = brute_classes(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[classes[p]] = min(i, least.get(classes[p], i))
    got = queries.QUERIES["op3_simhash"](spark, SF).collect()
    assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in got} == {i: (p, least[classes[p]]) for i, p in prints.items()}


def test_trie_join_with_hot_groups(spark):
    random.seed(5)
    core = [random.getrandbits(64) for _ in range(30)]
    prints = {0, *core}
    for c in core[:4]:
        prints |= {c ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) ^ (1 << random.randrange(40)) for _ in range(150)}
    prints = list(prints)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    links = simhash.near_links(df, limit=16).collect()
    root = brute_classes(prints)
    known = {p - (1 << 64) if p >> 63 else p: r for p, r in root.items()}
    assert all(known[r["a"]] == known[r["b"]] for r in links)
    found = simhash.components(simhash.near_links(df, limit=16)).collect()
    groups = defaultdict(set)
    for p, r in root.items():
        groups[r].add(p)
    assert len(found) == sum(len(g) - 1 for g in groups.values())


def test_simhash_odd(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 9
    zero = [r for r in rows if r["fp"] == 0]
    assert {r["doc_id"] for r in zero} == {3, 4} and {r["component_id"] for r in zero} == {3}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert simhash.near_duplicates(none).collect() == []


def test_sharding(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.interleave(docs, 24).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == docs.count() and max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) <= set(range(24))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    by_source, total = defaultdict(Counter), Counter(r["source"] for r in rows)
    for r in rows:
        by_source[r["source"]][r["shard"]] += 1
    assert all(abs(by_source[s][k] - total[s] / 24) <= 2 for s in total for k in range(24))
    few = sharding.interleave(odd, 4).collect()
    assert sorted(r["size"] for r in few)[:2] == [8, 8] and len(few) == 9
    assert sharding.interleave(none, 4).collect() == []


def test_top_k_against_brute_force(spark):
    random.seed(2)
    rows = [(i, [random.uniform(-1, 1) for _ in range(20)]) for i in range(600)]
    rows += [(600, None), (601, [None] * 20), (602, [float("nan")] * 20), (603, [float("inf")] * 20), (604, []), (605, rows[7][1]), (606, rows[7][1]), (None, rows[3][1]), (608, [1.0] * 3)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(5)
    ok = {r["vec_id"]: [math.floor(1024 * x) for x in r["embedding"]] for r in df.collect()
          if r["vec_id"] is not None and r["embedding"] and all(x is not None and math.isfinite(x) for x in r["embedding"])}
    want = {}
    for q in [i for i in ok if i % 100 == 0]:
        best = sorted(((-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q and len(v) == len(ok[q])))[:10]
        want[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    got = defaultdict(list)
    for r in topk.top_k(df.where("vec_id % 100 = 0"), df, 10, query_block=3).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert {q: sorted(v) for q, v in got.items()} == want
    assert topk.top_k(df.limit(0), df).collect() == []


def test_top_k_of_large_integers():
    asked = topk.Block(np.array([9]), np.array([[2.0 ** 30, 1.0]]), np.array([0]), 2)
    asked.meet(np.array([1, 2, 9]), np.array([[2.0 ** 30, 1.0], [2.0 ** 30, 2.0], [0.0, 0.0]]))
    _, rows, scores = next(asked.found())
    assert rows.tolist() == [2, 1] and scores.tolist() == [2 ** 60 + 2, 2 ** 60 + 1]
    with pytest.raises(OverflowError):
        asked.meet(np.array([3]), np.array([[2.0 ** 40, 1.0]]))
    negative = topk.Block(np.array([9]), np.array([[-(2.0 ** 30), 1.0]]), np.array([0]), 1)
    negative.meet(np.array([1, 2]), np.array([[2.0 ** 30, 1.0], [2.0 ** 30, 2.0]]))
    assert next(negative.found())[2].tolist() == [2 - 2 ** 60]


def test_language(spark, odd, none):
    rows = queries.QUERIES["op4_language"](spark, SF)
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in rows.collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95
    model = queries.language_model(spark, SF)
    got = {r["doc_id"]: r["p"] for r in odd.select("doc_id", langid.predict(spark, F.col("text"), model).alias("p")).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (3, 4, 7)) and 0 < got[6]["score"] <= 1
    untaught = langid.fit(none, queries.PIECES)
    assert {r["p"]["lang_pred"] for r in odd.select(langid.predict(spark, F.col("text"), untaught).alias("p")).collect()} == {"und"}


def test_forward_sums_every_segmentation():
    pieces = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba"]
    tool, prob = langid.Segmenter(pieces), np.linspace(0.05, 0.3, 14).reshape(7, 2)

    def total(word, lang):
        if not word:
            return 1.0
        return sum(prob[i, lang] * total(word[len(p):], lang) for i, p in enumerate(pieces) if word.startswith(p)) + langid.STRANGE * total(word[1:], lang)

    for word in ("ab", "abba", "aabab", "zb"):
        assert np.allclose(tool.log_words([word], prob)[0], [math.log(total("▁" + word, k)) for k in (0, 1)])


def test_fingerprints(spark, odd, none):
    a, b = "one two two three four", "one two three three five"
    wa, wb = Counter(a.split()), Counter(b.split())
    want = sum((wa & wb).values()) / sum((wa | wb).values())
    signs = fingerprint.Sampler(4096).sign([a, b, a, ""])
    assert abs(fingerprint.likeness(signs[:1], signs[1:2])[0] - want) < 0.03
    assert (signs[0] == signs[2]).all() and (signs[3] == 0).all()
    rows = fingerprint.compare_with_next(odd).collect()
    assert len(rows) == 9 and sum(r["n_chars"] == 0 for r in rows) == 2
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    order = sorted(texts, reverse=True)
    import hashlib
    following = dict(zip(order, [*order[1:], order[0]]))
    for r in fingerprint.compare_with_next(docs).collect():
        t, n = texts[r["doc_id"]], texts[following[r["doc_id"]]]
        half = len(t) // 2
        assert r["edited_sha256"] == hashlib.sha256((t[:len(t) - half] + n[:half]).encode()).hexdigest()
    assert fingerprint.compare_with_next(none).collect() == []
    assert [r["near_next"] for r in fingerprint.compare_with_next(odd.where("doc_id = 5")).collect()] == [1.0]


def test_fingerprints_do_not_depend_on_the_memory(monkeypatch):
    random.seed(3)
    texts = [" ".join(random.choice("abcdefgh") * random.randint(1, 9) for _ in range(60)) for _ in range(20)]
    alone = np.concatenate([fingerprint.Sampler().sign([t]) for t in texts])
    monkeypatch.setattr(fingerprint, "MEMORY", 16)
    few = fingerprint.Sampler()
    assert (np.concatenate([few.sign([t]) for t in texts[::-1]])[::-1] == alone).all() and len(few.index) < 72
    # All values tied: the smaller name, not the first in memory, is the sample.
    ways = []
    for first in ("p q r", "r q p"):
        sampler = fingerprint.Sampler()
        sampler.sign([first])
        sampler.single[:] = 0
        ways.append(sampler.sign(["q r p"]))
    assert (ways[0] == ways[1]).all()


def test_licences(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = licenses.fit(docs)
    notices = [(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts]
    df = spark.createDataFrame([(i, f"Er thndor\n{t}\nand he") for i, (_, t) in enumerate(notices)], "doc_id long, text string")
    got = {r["doc_id"]: r["families"] for r in licenses.scan(df, model).collect()}
    assert np.mean([got[i] == [f] for i, (f, _) in enumerate(notices)]) >= 0.9
    assert [r["families"] for r in licenses.scan(odd, model).collect()] == [[]] * 9


def test_wrapped_licences(spark):
    import textwrap

    model = licenses.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    long = [(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts if len(t) > 60]
    wrapped = [(f, p + f"\n{p}".join(textwrap.wrap(t, width - len(p)))) for f, t in long for width in (40, 60, 72, 80) for p in ("", "# ", " * ")]
    both = "\n".join(textwrap.wrap(long[1][1], 60) + textwrap.wrap(next(t for f, t in long if f == "mit"), 60))
    texts = [f"Er thndor\n{t}\nand he" for _, t in wrapped]
    texts += [both, f"{texts[0]}\n\n{texts[0]}", "Released under the MIT License.\nAll rights reserved.\nand he", "of the\nto the\nunder the\nfree of"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(df, model).collect()}
    n = len(wrapped)
    lost = [t for i, (f, t) in enumerate(wrapped) if f not in got[i]["families"] or len(got[i]["families"]) != 1 or got[i]["n_licence_paragraphs"] != 1]
    assert not lost, lost
    assert got[n]["families"] == sorted({long[1][0], "mit"})
    assert got[n + 1]["n_licence_paragraphs"] == 2
    assert (got[n + 2]["families"], got[n + 2]["n_licence_paragraphs"]) == (["mit", "rights-reserved"], 2)
    assert got[n + 3]["families"] == []


def test_revisits(spark):
    h = "map<string,string>"
    rows = [("r1", "http://www.A.com/x/", 1, "response", "e1", None, None, {"etag": "e1", "server": "s"}),
            ("r2", "https://a.com/x#f", 5, "response", "e2", None, "d", {"etag": "e2", "vary": "v"}),
            ("v1", "a.com:443/x?ref=1", 5, "revisit", "W/e1", None, None, {"vary": "n", "server": "other"}),
            ("v2", "http://a.com/x", 6, "revisit", "e1", None, "d", {}), ("v3", "http://a.com/x", 7, "revisit", None, None, "d", None),
            ("v4", "http://b.com", 7, "revisit", None, None, "d", None), ("v5", None, 7, "revisit", None, None, None, None),
            ("v6", "http://a.com/x", 9, "revisit", None, "m", None, None)]
    df = spark.createDataFrame(rows, f"record_id string, url string, date long, type string, etag string, last_modified string, digest string, headers {h}")
    got = {r["record_id"]: (r["refers_to"], r["outcome"], r["headers"]) for r in warc.resolve_revisits(df).collect()}
    assert got == {"v1": ("r1", "merged", {"etag": "e1", "server": "s", "vary": "n"}), "v2": ("r2", "mismatch", None),
                   "v3": ("r2", "merged", {"etag": "e2", "vary": "v"}), "v4": (None, "missing", None), "v5": (None, "missing", None),
                   "v6": ("r2", "unverified", None)}
    assert warc.resolve_revisits(df.limit(0)).collect() == []


def test_revisits_of_records_without_id(spark):
    rows = [(None, "a.com/x", 1, "response", "e1", {"etag": "e1", "server": "s"}, "k"), (None, "a.com/x", 1, "response", "e1", {"etag": "e1", "server": "s"}, "k"),
            (None, "a.com/x", 3, "revisit", "e1", {"vary": "n"}, "k"), (None, "a.com/x", 4, "revisit", "e1", {"vary": "m"}, "k"),
            ("r", "b.com", 1, "response", "e", {"server": "b"}, None), (None, "b.com", 2, "revisit", "e", {"date": "2"}, None),
            (None, "b.com", 2, None, "e", None, None), ("w", "b.com/" + "p" * 30_000, 2, "revisit", None, None, None)]
    df = spark.createDataFrame(rows, "record_id string, url string, date long, type string, etag string, headers map<string,string>, key string")
    df = df.withColumn("last_modified", F.lit(None).cast("string")).withColumn("digest", F.lit(None).cast("string"))
    got = sorted((r["refers_to"] or "", r["outcome"], sorted((r["headers"] or {}).items())) for r in warc.resolve_revisits(df).collect())
    assert got == [("", "merged", [("etag", "e1"), ("server", "s"), ("vary", "m")]), ("", "merged", [("etag", "e1"), ("server", "s"), ("vary", "n")]),
                   ("", "missing", []), ("r", "merged", [("date", "2"), ("server", "b")])]


def test_toxicity_tolerates_gaps(spark, none):
    random.seed(1)
    plain = "the and of to in a he is that er an on re ha st nd".split()
    rows = []
    for i in range(600):
        words = [random.choice(plain) + random.choice(plain) for _ in range(30)]
        if i % 2:
            words[random.randrange(30)] = random.choice(["idiot", "scumbag"])
        rows.append((i, " ".join(words) + ".", i % 2))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    probes = ["you idiot there", "you id.i-ot there", "you idxiot there", "you i d i o t there", "the and heof an.", "", None]
    asked = spark.createDataFrame([(i, t, 2.0) for i, t in enumerate(probes)], "doc_id long, text string, score double")
    got = [r[0] for r in asked.orderBy("doc_id").select(toxicity.score(spark, F.col("text"), model)).collect()]
    assert min(got[:4]) > 0.7 and max(got[4:]) < 0.3 and got[5] == got[6]
    untaught = toxicity.fit(none, df.select("doc_id", "toxic").limit(0))
    assert asked.select(toxicity.score(spark, F.col("text"), untaught).alias("s")).where("s > 0.1").count() == 0


def test_mixing(spark, odd, none):
    rows = [(i, "w " * (1 + i % 5), "en" if i % 3 else "de", "a" if i % 2 else "b") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    size = {r[0]: 1 + r[0] % 5 for r in rows}
    have = Counter()
    for i, _, lang, source in rows:
        have[lang, source] += size[i]
    out = mixing.mix(df, ["lang", "source"], mixing.word_count(F.col("text")), {("de",): 3.0, ("de", "a"): 3.0}, total=900, epochs=2.0).collect()
    got, times = Counter(), Counter()
    for r in out:
        got[r["lang"], r["source"]] += r["mix_tokens"]
        times[r["doc_id"]] += 1
    # Both languages: de wants 675 and has 2 x its tokens; what it lacks goes to en.
    de = 2 * (have["de", "a"] + have["de", "b"])
    assert abs(sum(v for k, v in got.items() if k[0] == "de") - min(675, de)) <= 10
    assert abs(sum(got.values()) - 900) <= 20 and max(times.values()) <= 2
    assert all(got[k] <= 2 * have[k] for k in got)
    taken = mixing.mix(odd, ["lang", "source"], mixing.word_count(F.col("text")), share=1.0)
    assert taken.count() == 9 and mixing.mix(none, ["lang", "source"], mixing.word_count(F.col("text"))).collect() == []


def test_toxicity_of_a_sure_word_among_mild_ones():
    scorer = toxicity.Scorer(np.zeros(toxicity.BASE ** 4, dtype=np.float32), 0.5, 0.0, frozenset(["bad"]))
    scorer.memory = {"bad": 3.0, **{f"mild{c}": -1.0 for c in "abcde"}}
    mild = " ".join(f"mild{c}" for c in "abcde")
    margins = scorer.margins([f"{mild} bad", "bad bad", mild, "", "bad milda. mildb"])
    assert margins.tolist() == [toxicity.SURE - 1.5, toxicity.SURE + 3.5, -4.5, toxicity.NOTHING, toxicity.SURE + 2.5]
    got = toxicity.judge(margins, {"knots": ([-1.0, 1.0], [0.0, 0.9]), "share": 0.95})
    assert min(got[[0, 1, 4]]) > 0.9 and max(got[2:4]) < 0.1 and got[1] > got[0]


def brute_budgets(leaves, weights, total, epochs):
    """Budgets of the leaves, shared out from the root down by raising one level for all siblings."""
    def takes(path):
        if any(weights.get(path[:d], 1.0) == 0 for d in range(1, len(path) + 1)):
            return 0.0
        below = {p[:len(path) + 1] for p in leaves if p[:len(path)] == path}
        return epochs * leaves[path] if path in leaves else sum(takes(p) for p in below)

    out = {}

    def share(path, purse):
        if path in leaves:
            out[path] = purse
            return
        kids = {p[:len(path) + 1] for p in leaves if p[:len(path)] == path}
        given, left = dict.fromkeys(kids, 0.0), min(purse, sum(takes(k) for k in kids))
        hungry = {k for k in kids if takes(k) > 0}
        while hungry and left > 1e-9:
            per = left / sum(weights.get(k, 1.0) for k in hungry)
            full = {k for k in hungry if takes(k) - given[k] <= per * weights.get(k, 1.0) + 1e-9}
            for k in full or hungry:
                more = takes(k) - given[k] if full else per * weights.get(k, 1.0)
                given[k], left = given[k] + more, left - more
            hungry = hungry - full if full else set()
        for k in kids:
            share(k, given[k])

    share((), total)
    return out


def test_mixing_gives_nothing_to_shut_leaves(spark):
    rng = random.Random(3)
    weights = {("d2", "fr", "hot"): 0.0, ("d0",): 3.0, ("d1", "en"): 4.0, ("d1", "de"): 0.0, ("d0", "fr"): 2.0, ("d0", "fr", "b"): 0.5}
    paths = [(d, lang, s) for d in ("d0", "d1", "d2") for lang in ("en", "fr", "de") for s in ("a", "b")]
    # A shut leaf that is hot among its siblings, one that has none, a shut inner node, and random trees.
    trees = [{p: 100 for p in paths} | {("d2", "fr", "hot"): 5000}, {("d2", "fr", "hot"): 900, ("d0", "en", "a"): 50, ("d1", "en", "a"): 300},
             {("d1", "de", "a"): 4000, ("d1", "en", "a"): 100, ("d0", "en", "a"): 2000}, {("d2", "fr", "hot"): 70}]
    trees += [{p: rng.choice([1, 40, 900]) for p in rng.sample(paths, 9)} | {("d2", "fr", "hot"): rng.choice([10, 5000])} for _ in range(2)]
    for tree in trees:
        total = 0.8 * sum(tree.values())
        leaves = spark.createDataFrame([(*(f"={x}" for x in p), n) for p, n in tree.items()], "a string, b string, c string, tokens long")
        got = {(r["a"][1:], r["b"][1:], r["c"][1:]): r["budget"] for r in mixing.budgets(leaves, ["a", "b", "c"], weights, F.lit(total), 2.0).collect()}
        want = brute_budgets(tree, weights, total, 2.0)
        assert all(abs(got[p] - want[p]) < 1e-3 for p in tree), tree
        # What the open leaves can take of the total is given away in full.
        able = 2.0 * sum(n for p, n in tree.items() if all(weights.get(p[:d], 1.0) for d in (1, 2, 3)))
        assert abs(sum(got.values()) - min(total, able)) < 1e-3


def test_pipeline_stages(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(2).unionByName(docs.limit(2)).withColumn("doc_id", F.col("doc_id"))
    docs = docs.unionByName(extra)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    prints = {}
    for r in docs.collect():
        prints.setdefault(brute_print(r["text"]), []).append(r["doc_id"])
    classes = brute_classes(list(prints))
    least = {}
    for p, ids in prints.items():
        least[classes[p]] = min([*ids, *([least[classes[p]]] if classes[p] in least else [])])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())
    assert kept.columns == docs.columns
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).collect() == [], name
        assert stage(spark, odd, SF).count() >= 0, name
    known = [r["doc_id"] for r in corpus_pipeline.keep_known_language(spark, odd, SF).collect()]
    assert not {3, 4, 7} & set(known)


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "ids", "n_tokens", "decoded"} <= set(out.columns)


def test_batches_are_bounded_by_bytes(spark):
    from tiffinlake.llm.support import BATCH_BYTES, lean, small_batches

    small_batches(spark)

    @lean
    def sizes(batches):
        for batch in batches:
            yield type(batch).from_pydict({"n": [batch.num_rows], "b": [batch.nbytes]})

    texts = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("0123456789"), 10_000).alias("text"))
    rows = texts.mapInArrow(sizes, "n long, b long").collect()
    assert sum(r["n"] for r in rows) == 400 and max(r["b"] for r in rows) < 2 * BATCH_BYTES
