"""The mixture query and its SQL where a shut leaf holds most of a family that is short of tokens."""

import duckdb

from tiffinlake.llm import queries


def test_hot_shut_leaf(spark, base):
    docs = [(i, "w " * (1 + i % 7), "fr", "src5") for i in range(400)]  # weight 0
    docs += [(1000 + i, "w " * (1 + i % 5), "fr", "src2") for i in range(6)] + [(2000 + i, "w w", "en", f"src{i % 4}") for i in range(60)]
    docs += [(3000 + i, "w w w", None, None) for i in range(5)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{base}/documents.parquet")
    got = sorted(map(tuple, queries.QUERIES["op10_mixing"](spark, base).collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{base}/documents.parquet/*.parquet')")
    want = con.execute(queries.SQL["op10_mixing"]).fetchall()
    assert got == sorted(want, key=repr)
    assert all(r[3] != "src5" for r in got)
    # The shut leaf is no room: everything else is taken twice, as the total is more than that.
    assert len(got) == 2 * 71
