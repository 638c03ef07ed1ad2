"""The filter audit against a plain simulation of every order, and its odd tables."""

import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiffinlake.llm import audit

DOCS = "doc_id long, text string, lang string, mask int, part string"
LABELS = "doc_id long, quality int, toxic int"
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {x for x, bad in (("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
                             ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)), ("D", re.search("[#$%&*|]", text))) if bad}


def simulate(docs, labels):
    good, toxic = ({i for i, *v in labels if i is not None and v[at] == 1} for at in (0, 1))
    seen = defaultdict(list)
    for i, text, *_ in docs:
        if i is not None:
            seen[text or ""].append(i)
    rows = [(i, lang or "", failed(text or "") | ({"E"} if i is not None and i > min(seen[text or ""]) else set())) for i, text, lang, *_ in docs]
    out = {}
    for part in {r[1] for r in rows}:
        mine, shapley = [r for r in rows if r[1] == part], defaultdict(int)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[2]]
                left = [r for r in left if x not in r[2]]
                shapley[x] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(x in r[2] for r in mine) - len(gone), sum(r[2] == {x} for r in mine),
                                          sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)]
        for (p, order, step), found in out.items():
            if p == part:
                found.append(shapley[order[step - 1]])
    return out


def test_every_order_of_a_noisy_table(spark):
    r = random.Random(12)
    texts = [None, "", " \t\n", "word " * 120, " ".join(f"w{i}" for i in range(110)), "ABC " * 30, "a # b", " ".join(f"w{i}" for i in range(99)),
             "É" * 90 + "A" * 10, "x\x1cy\x85z w", " ".join(f"W{i}" for i in range(150)), "long " * 30_000]
    docs = [(None if r.random() < .1 else r.randrange(60), r.choice(texts), r.choice([None, "", "en", "de"]), 7, "clash") for _ in range(150)]
    docs += docs[:10]  # repeated rows
    labels = [(r.choice([None, *range(70)]), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(60)]
    got = audit.audit_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert {(g["part"], g["filter_order"], g["step"]): [g[m] for m in MEASURES] for g in got} == simulate(docs, labels)
    assert len(got) == 3 * 600


def test_empty_table_and_other_filters(spark):
    none = audit.audit_documents(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS))
    assert none.collect() == [] and none.columns == ["part", "filter_order", "step", *MEASURES]
    rows = audit.failures(spark.range(10), {"x": F.col("id") < 4, "y": F.col("id") % 2 == 0, "z": F.lit(None).cast("boolean")}, ["id", F.lit("p").alias("part")])
    got = {(r["filter_order"], r["step"]): r["removed"] for r in audit.audit(rows, "xyz", orders=["xyz", "yxz"]).collect()}
    assert got == {("xyz", 1): 4, ("xyz", 2): 3, ("xyz", 3): 0, ("yxz", 1): 5, ("yxz", 2): 2, ("yxz", 3): 0}
    with pytest.raises(ValueError):
        audit.audit(rows, "xx")
    with pytest.raises(ValueError):
        audit.audit(rows, "xyz", orders=["xy"])


def test_contraction_equals_a_sum_over_cells():
    tensor = np.random.default_rng(1).integers(0, 50, (2, 1, 2, 2, 2))
    chosen = audit.selectors("abc", ["abc", "cab"])
    for i, order in enumerate(["abc", "cab"]):
        for step, x in enumerate(order):
            at = [1 if y == x else 0 if y in order[:step] else slice(None) for y in "abc"]
            want = tensor[(slice(None), 0, *at)].reshape(2, -1).sum(axis=1)
            assert (audit.contract(tensor, chosen["removed"])[:, 0, 3 * i + step] == want).all()
