import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from basketry.llm import oracles, queries, ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, top=50):
    """Every document scored for every item, in plain Python."""
    rows = [(i, Counter(TERM.findall((t or "").translate(FOLD)))) for i, t in docs]
    n_docs, total = sum(1 for _, c in rows if c), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in rows:
            n, score = sum(c.values()), 0
            for t in set(TERM.findall((text or "").translate(FOLD))):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * (50 + (50 * n * n_docs) // total)))
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(found)[:top])]
    return out


def key(rows):
    return sorted(map(str, rows))


def got(df):
    return key((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect())


def made(seed, n, words=400):
    r = random.Random(seed)
    pool = [f"w{i}" for i in range(words)] + ["É", "été", "ſ", "A1", "x_y", "😀"]
    weights = [1 / (1 + i) for i in range(len(pool))]
    return [(i * 3 % n, " ".join(r.choices(pool, weights, k=r.randint(0, 60)))) for i in range(n)]


def test_terms():
    for t in ["", "Ab_c-É É9\x85x\xa0y", "a\x00b\x7fc", "İKK", "1,234.5 😀z"]:
        assert [w.decode() for w in ranked_search.terms(t.encode())] == TERM.findall(t.translate(FOLD))


@pytest.mark.parametrize("block,rng", [(1 << 21, 4096), (200, 16)])
def test_equals_brute_force(spark, monkeypatch, block, rng):
    docs = made(1, 700) + [(None, "w1 w2"), (3, "w1 w2 w399"), (3, "w1 w2 w399"), (9001, None), (9002, "")]
    items = [(k, " ".join(t.split()[:30])) for k, t in made(2, 40)] + [(5, None), (6, ""), (None, "w1 w7"), (8, "nowhere"), (8, "W3 w3 w4"), (8, "W3 w3 w4")]
    a = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(ranked_search, "BLOCK_POSTINGS", block)
    monkeypatch.setattr(ranked_search, "RANGE", rng)
    assert got(ranked_search.search(a, b)) == key(brute(docs, items))
    # in blocks of queries
    assert got(ranked_search.search(a, b, block_chars=400)) == key(brute(docs, items))


def test_block_ranking_with_many_ranges():
    """The skipping itself, on one block, against sums over all documents."""
    r = np.random.default_rng(3)
    n, v = 9000, 60
    share = np.concatenate((np.linspace(0.9, 0.1, 20), np.full(40, 0.004)))
    doc, term = np.nonzero(r.random((n, v)) < share)
    tf = r.integers(1, 5, len(doc))
    weights = np.array([ranked_search.weight(n, int((term == t).sum())) for t in range(v)])
    norms = r.integers(50, 300, n)
    block = ranked_search.PostingBlock(r.permutation(n), norms, doc, term, tf, weights)
    impact = weights[term] * ((10**9 * tf) // (1000 * tf + 20 * norms[doc]))
    for q in range(12):
        asked = np.sort(r.choice(v, 12, replace=False))
        total = np.bincount(doc[np.isin(term, asked)], impact[np.isin(term, asked)], minlength=n).astype(np.int64)
        want = np.lexsort((block.ids, -total))[:50]
        best = ranked_search.Best(50)
        block.rank(asked, best)
        assert best.score.tolist() == total[want].tolist() and best.id.tolist() == block.ids[want].tolist()


def test_ties_go_by_id(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(200, 0, -1)] + [(900, "other")], "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(1, "same")], "item_id long, text string")
    rows = ranked_search.search(docs, items).orderBy("rank").collect()
    assert [r.doc_id for r in rows] == list(range(1, 51)) and [r.rank for r in rows] == list(range(1, 51))


def test_query_equals_sql(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    mine, sql = queries.op13_ranked_search(spark, sf).toPandas(), c.sql(oracles.SEARCH).df()
    assert len(mine) == len(sql) > 0
    columns = ["item_id", "rank", "doc_id", "score"]
    pd.testing.assert_frame_equal(
        mine[columns].astype("int64").sort_values(columns).reset_index(drop=True),
        sql[columns].astype("int64").sort_values(columns).reset_index(drop=True),
    )


def test_odd_rows_and_empty_tables(spark, odd_docs):
    items = spark.createDataFrame([(1, "th er 12"), (2, "été"), (3, None)], "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert got(ranked_search.search(odd_docs, items)) == key(brute(docs, [(1, "th er 12"), (2, "été"), (3, None)]))
    assert ranked_search.search(odd_docs.limit(0), items).count() == 0
    empty = ranked_search.search(odd_docs, items.limit(0))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]
