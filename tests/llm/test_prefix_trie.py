import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from basketry.llm import oracles, prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_order(r):
    turn, role, text = r
    digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
    return turn is not None, turn or 0, digest


def conversations(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append((turn, role or "", text or ""))
    return {c: [t[1:] for t in sorted(ts, key=turn_order)] for c, ts in out.items()}


def forked(convs):
    out = {}
    for c, own in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(c - 5 * int(c / 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for seq in members:
        if seq:
            kids[seq[:-1]] += 1
    for seq, who in members.items():
        for d in range(len(seq) + 1):
            leaves[seq[:d]] += kids[seq] == 0
            saved[seq[:d]] += (len(who) - 1) * len(seq[-1][1].encode()) if seq else 0
    return sorted(
        str((min(who), len(s), min(members[s[:-1]]) if s else None, len(who), kids[s], leaves[s], saved[s],
             hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest()))
        for s, who in members.items()
    )


def got(df):
    return sorted(str(tuple(r[c] for c in COLUMNS)) for r in df.collect())


def made(seed, n=120, longest=14):
    """Conversations that share beginnings of all lengths, copies, null and repeated turn numbers, empty texts."""
    r = random.Random(seed)
    rows, earlier = [], [[]]
    for c in range(n):
        start = r.choice(earlier)
        seq = start[: r.randint(0, len(start))] + [(r.choice(["user", "assistant", None]), r.choice(["a", "bé", "", None, "ccc"])) for _ in range(r.randint(0, longest - 8))]
        seq = seq or [("user", "hello")]
        earlier.append(seq)
        rows += [(c * 2 + r.randint(0, 1), k, role, text) for k, (role, text) in enumerate(seq)]
    rows += [(3, None, "user", "null turn"), (3, None, "user", "null turn"), (4, 1, "user", "same turn"), (4, 1, "user", "same turn")]
    return rows + [(None, 0, "user", "nobody"), (1001, 0, "system", "x" * 20_000), (-7, 0, "user", "negative")]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("sizes", [{}, {"limit": 40, "block": 16}, {"limit": 8, "block": 3, "fan": 2}])
def test_trie_equals_brute_force(spark, sizes):
    rows = made(len(sizes))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(prefix_trie.prefix_trie(df, **sizes)) == brute(conversations(rows))


def test_shared_beginnings_and_copies_burst_together(spark):
    """Long shared beginnings, many copies and one very long conversation."""
    shared = [("user", f"t{k}") for k in range(30)]
    convs = {c: shared + [("user", f"own {c % 7}")] * (c % 3) for c in range(60)}
    convs |= {100 + c: shared[:11] for c in range(25)}
    convs[500] = [("user", str(k % 5)) for k in range(700)]
    convs[501] = convs[500][:650] + [("assistant", "else")]
    rows = [(c, k, role, text) for c, ts in convs.items() for k, (role, text) in enumerate(ts)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(prefix_trie.prefix_trie(df, limit=60, block=8, fan=4)) == brute(convs)


def test_query_equals_brute_force_and_sql(spark, tmp_path):
    rows = made(9)
    spark.createDataFrame([(*r, -1) for r in rows], SCHEMA + ", n long").write.parquet(f"{tmp_path}/conversations.parquet")
    want = brute(forked(conversations(rows)))
    assert got(queries.op11_prefix_trie(spark, str(tmp_path))) == want
    c = duckdb.connect()
    c.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    sql = c.sql(f"SELECT {', '.join(COLUMNS)} FROM ({oracles.TRIE})").fetchall()
    assert sorted(map(str, sql)) == want


def test_odd_columns_and_empty_table(spark, odd_docs):
    df = odd_docs.withColumnsRenamed({"doc_id": "conv_id"}).withColumns({"turn": F.lit(None).cast("long"), "role": F.lit(None).cast("string")})
    rows = [(r.conv_id, None, None, r.text) for r in df.collect()]
    assert got(prefix_trie.prefix_trie(df)) == brute(conversations(rows))
    assert prefix_trie.prefix_trie(df.limit(0)).count() == 0
