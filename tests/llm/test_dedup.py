import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import components, decontaminate, line_dedup, queries, simhash

SF = "/root/testdata/sf0.001"


def edit(a, b):
    d = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        e = [i] + [0] * len(b)
        for j in range(1, len(b) + 1):
            e[j] = min(d[j] + 1, e[j - 1] + 1, d[j - 1] + (a[i - 1] != b[j - 1]))
        d = e
    return d[-1]


def changed(s, k, r, letters="abc"):
    s = list(s)
    for _ in range(k):
        kind, i = r.random(), r.randrange(len(s) + 1)
        if kind < 0.33 and i < len(s):
            s[i] = r.choice(letters)
        elif kind < 0.66:
            s.insert(i, r.choice(letters))
        elif i < len(s):
            del s[i]
    return "".join(s)


# ---------------------------------------------------------------- SimHash
def brute_fingerprint(text, n=3):
    import re

    import xxhash

    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    w = re.findall("[^\x20\x09-\x0d]+", t)
    if not w:
        return 0
    sh = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """rows: (id, fp) -> component id per row."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(d, best.get(find(i), d))
    return [best.get(find(i)) for i in range(len(rows))]


def test_fingerprint():
    r = random.Random(1)
    texts = ["", " \n", "One", "One Two", "a b c d", "É é É é É", "x " * 70_000, "a\u00a0b c\x1cd e"]
    texts += [" ".join(r.choice(["Ab", "c", "de", "f"]) for _ in range(r.randint(1, 30))) for _ in range(30)]
    for t in texts:
        assert simhash.fingerprint(t.encode()) == brute_fingerprint(t), t[:40]


def test_op9_against_brute_force(spark, docs):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    want = {d: (f"{f:016x}", c) for (d, f), c in zip(rows, brute_components(rows))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op9_simhash(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("leaf", [16, 100_000])
def test_links_are_exact_over_leaves_blocks_and_clusters(spark, leaf):
    r = np.random.default_rng(3)
    x = r.integers(0, 1 << 63, 1500, dtype=np.uint64)
    near = x[:400] ^ (np.uint64(1) << r.integers(0, 64, 400, dtype=np.uint64))
    # a tight cluster that no split takes apart, so that leaves fall into blocks
    tight = x[0] ^ r.integers(0, 256, 300, dtype=np.uint64)
    every = np.unique(np.concatenate((x, near, tight, [np.uint64(0)])))
    df = spark.createDataFrame([(int(v),) for v in every.view(np.int64)] * 2 + [(None,)], "fp long")
    got = {(a.src, a.dst) for a in simhash.hamming_links(df, leaf=leaf, sample=512).collect()}
    s = every.view(np.int64)
    want = set()
    for i in range(len(every)):
        for j in np.flatnonzero(np.bitwise_count(every[i + 1 :] ^ every[i]) <= 2) + i + 1:
            want.add((int(min(s[i], s[j])), int(max(s[i], s[j]))))
    assert got == want


def test_leaves_stay_bounded_with_a_tiny_sample(spark, monkeypatch):
    """The tree grows over its leaves: no leaf is left over-full, and no link is lost."""
    import numpy as np

    r = np.random.default_rng(8)
    base = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
    near = base[:800] ^ (np.uint64(1) << r.integers(0, 64, 800, dtype=np.uint64))
    fps = np.unique(np.concatenate((base, near, near[:200] ^ np.uint64(5))))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    counts, over_full = [], simhash.over_full

    def spy(placed, leaf):
        out = over_full(placed, leaf)
        counts.append(out.count())
        return out

    monkeypatch.setattr(simhash, "over_full", spy)
    got = {(a.src, a.dst) for a in simhash.hamming_links(df, leaf=100, sample=64).collect()}
    want = set()
    for i, x in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ x) <= 2) + i + 1:
            a, b = sorted((int(fps[i : i + 1].view(np.int64)[0]), int(fps[j : j + 1].view(np.int64)[0])))
            want.add((a, b))
    assert got == want and len(want) > 800
    assert counts[0] > 0 and counts[-1] == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (7, None)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert components.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_simhash_odd_rows(spark, odd_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    given = [(r.doc_id, brute_fingerprint(r.text or "")) for r in odd_docs.collect()]
    key = lambda t: (str(t[0]), t[1], str(t[2]))
    want = sorted(((d, f - ((f >> 63) << 64), c) for (d, f), c in zip(given, brute_components(given))), key=key)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in rows), key=key) == want
    assert simhash.near_duplicates(odd_docs.limit(0)).count() == 0
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({c for _, _, c in want})
    only_null = odd_docs.where("doc_id is null")
    assert simhash.keep_first(only_null).count() == 2
    assert simhash.keep_first(odd_docs.limit(0)).count() == 0


# ---------------------------------------------------------------- lines
def brute_lines(rows):
    """rows: (id, text) -> texts without exact and near copies of earlier lines."""
    seed = line_dedup.xxhash.xxh64_intdigest((1).to_bytes(4, "little"), 42)
    owner = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            if line_dedup.has_word(x):
                k = line_dedup.NO_ID if d is None else d
                owner[x] = min(k, owner.get(x, k))
    place = {x: (o, *line_dedup._keys(x, seed)) for x, o in owner.items()}
    lines = sorted(owner)
    near = set()
    for i, a in enumerate(lines):
        for b in lines[:i]:
            t = line_dedup.edits_allowed(min(len(a), len(b)))
            if t and abs(len(a) - len(b)) <= t and edit(a, b) <= t:
                near.add(max((a, b), key=place.get))
    out = []
    for d, t in rows:
        k = line_dedup.NO_ID if d is None else d
        kept, seen = [], set()
        for x in (t or "").split("\n"):
            if line_dedup.has_word(x):
                if x in seen or x in near or owner[x] != k:
                    continue
                seen.add(x)
            kept.append(x)
        out.append(None if t is None else "\n".join(kept))
    return out


def line_rows():
    r = random.Random(9)
    base = ["".join(r.choice("abcdefg ") for _ in range(n)) for n in (5, 18, 19, 20, 21, 60, 99, 100, 101, 140) for _ in range(3)]
    pool = base + [changed(s, k, r) for s in base for k in (1, 2, 3)] + ["é" * 30, "é" * 29 + "x", "", "  ", "All rights reserved."]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 8)))) for i in range(60)]
    return rows + [(None, "\n".join(pool[:4])), (3, rows[3][1]), (70, None), (71, "")]


@pytest.mark.parametrize("max_live,cell,refine", [(4_000_000, 2048, 16), (0, 2, 1), (4_000_000, 2, 10**6)])
def test_lines_against_brute_force(spark, max_live, cell, refine):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lines", F.lit(1)).withColumn("k1", F.lit(2))
    got = line_dedup.dedup_lines(df, max_live=max_live, cell=cell, refine=refine).collect()
    want = brute_lines(rows)
    assert Counter((r.doc_id, r.text) for r in got) == Counter((d, t) for (d, _), t in zip(rows, want))
    assert any(r.lines.n_near for r in got) and all(r.k1 == 2 for r in got)


def test_second_digest_is_sparks(spark):
    seed = line_dedup._seed_two(spark)
    x = "é line"
    r = spark.createDataFrame([(x,)], "s string").select(F.xxhash64("s").alias("a"), F.xxhash64(F.lit(1), F.col("s")).alias("b")).first()
    assert line_dedup._keys(x, seed) == (r.a, r.b)


def test_banded_distance():
    r = random.Random(5)
    for _ in range(3000):
        a = "".join(r.choice("abc") for _ in range(r.randint(0, 24)))
        b, t = changed(a, r.randint(0, 5), r), r.randint(0, 4)
        assert line_dedup.within(a, b, t) == (edit(a, b) <= t)


def test_segments_find_every_pair():
    r = random.Random(6)
    for _ in range(1500):
        a = "".join(r.choice("abcdefgh") for _ in range(r.choice([19, 20, 22, 40, 99, 100, 101, 150])))
        s, big = sorted((a, changed(a, r.randint(1, 2), r)), key=len)
        t = line_dedup.edits_allowed(len(s))
        if t and s != big and edit(s, big) <= t:
            (hs, ks), (hb, kb) = line_dedup.signatures(s), line_dedup.signatures(big)
            assert set(hs[:ks]) & set(hb) or len(s) == len(big) and set(hb[:kb]) & set(hs)


def test_remainders_find_every_pair():
    """Under a shared hash, near lines share a further one after each parting."""
    r = random.Random(16)

    def keys(line, sig):
        return {(h, own, left, g, e) for x, g, e, ix in line_dedup.remainders(line, sig) for h, own, left in line_dedup.parted(sig, x, g, e, ix)}

    met = 0
    for _ in range(600):
        a = "".join(r.choice("abcdefgh") for _ in range(r.choice([19, 20, 22, 40, 99, 100, 101, 150])))
        s, big = sorted((a, changed(a, r.randint(1, 2), r)), key=len)
        t = line_dedup.edits_allowed(len(s))
        if not t or s == big or edit(s, big) > t:
            continue
        shared = set(line_dedup.signatures(s)[0]) & set(line_dedup.signatures(big)[0])
        rows = [(keys(s, h), keys(big, h)) for h in shared]
        for _ in range(line_dedup.DEPTH):
            # one of the two is indexed where they meet
            both = [(x, y) for one, two in rows for x in one for y in two if x[0] == y[0] and (x[1] or y[1])]
            assert both
            rows = [tuple({(*q, z[3], z[4]) for q in line_dedup.parted(z[0], z[2], z[3], z[4], z[1])} for z in pair) for pair in both[:40]]
        met += 1
    assert met > 100


def test_template_is_parted(spark, monkeypatch):
    """Lines with a common opening: the hash of the opening is refined, so no line visits all cells, and pairs stay."""
    r = random.Random(8)
    fill = ["".join(r.choice("abcdefghij") for _ in range(70)) for _ in range(300)]
    rows = [(i, "The opening that every record of this feed has, " + f) for i, f in enumerate(fill)]
    rows += [(1000 + i, rows[i][1][:-1] + "#") for i in range(0, 300, 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    moved, dealt = [], line_dedup._dealt

    def spy(*given):
        out = dealt(*given)
        moved.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "_dealt", spy)
    want = Counter((d, "" if d >= 1000 else t) for d, t in rows)
    figures = []
    for refine in (3, 10**6):
        moved.clear()
        got = line_dedup.dedup_lines(df, cell=8, refine=refine).collect()
        assert Counter((x.doc_id, x.text) for x in got) == want
        figures.append(sum(moved))
    assert figures[0] < figures[1] / 4


def test_op6_rows(spark, docs):
    got = {r.doc_id: r for r in queries.op6_line_dedup(spark, SF).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # near copies are rare: check exact copies by brute force, and that no more than listed went
    seen = {}
    for d, t in sorted(rows):
        for x in t.split("\n"):
            seen.setdefault(x, d)
    for d, t in rows:
        xs = [x for x in t.split("\n") if line_dedup.has_word(x)]
        copies = sum(seen[x] != d or x in xs[:i] for i, x in enumerate(xs))
        assert got[d].n_lines == len(xs) and got[d].n_exact + got[d].n_near >= copies >= got[d].n_exact


def test_lines_odd_rows(spark, odd_docs):
    got = line_dedup.dedup_lines(odd_docs.drop("lines"))
    assert got.count() == odd_docs.count() and got.columns == [*odd_docs.drop("lines").columns, "lines"]
    again = line_dedup.dedup_lines(odd_docs)  # the clashing column is replaced
    assert dict(again.dtypes)["lines"].startswith("struct")
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((d, t) for (d, _), t in zip(rows, brute_lines(rows)))
    assert line_dedup.dedup_lines(odd_docs.limit(0)).count() == 0


# ---------------------------------------------------------------- benchmark
def test_rows_without_an_id_are_no_group(spark, monkeypatch):
    """Many rows under a null id: drops are gathered per text, and every row keeps its own lines."""
    rows = [(1, "the first line of all\nshared line between documents")]
    rows += [(None, f"shared line between documents\nsomething quite different in number {k} {k * 37}") for k in range(300)]
    rows += [(None, rows[5][1])] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gathered, stored = [], line_dedup.stored

    def spy(d, name):
        out = stored(d, name)
        if name == "lines-places":
            gathered.append(out.groupBy("id", "doc").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(line_dedup, "stored", spy)
    got = Counter(r.text for r in line_dedup.dedup_lines(df).collect())
    assert gathered[0] <= 2 * 4
    want = Counter([rows[0][1]] + [t.split("\n")[1] for i, t in rows if i is None])
    assert got == want


def test_myers_against_dynamic_programming():
    r = random.Random(2)

    def brute(p, t):
        d = [0] * (len(t) + 1)
        for i in range(1, len(p) + 1):
            e = [i] + [0] * len(t)
            for j in range(1, len(t) + 1):
                e[j] = min(d[j] + 1, e[j - 1] + 1, d[j - 1] + (p[i - 1] != t[j - 1]))
            d = e
        return min(d)

    for _ in range(300):
        p = "".join(r.choice("ab c") for _ in range(r.randint(1, 70)))
        t = "".join(r.choice("ab c") for _ in range(r.randint(0, 80)))
        k, d = r.randint(0, 40), brute(p, t)
        assert decontaminate.best_match(p, t, k) == (d if d <= k else None)


def test_matcher_finds_every_item_within_budget():
    r = random.Random(3)
    make = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    items = [(i, decontaminate.normalise(make(r.randint(20, 120)))) for i in range(20)]
    m = decontaminate.Matcher(items, 0.08)
    for _ in range(60):
        text = make(200)
        for i, t in r.sample(items, 2):
            text += changed(t, r.randint(0, 12), r, "xyz") + make(50)
        text = decontaminate.normalise(text)
        want = {}
        for i, t in items:
            k = decontaminate.budget(len(t), 0.08)
            d = decontaminate.best_match(t, text, k)
            if d is not None:
                want[i] = d
        assert m.find(text) == want


def test_op7_against_brute_force(spark, docs):
    items = [(r.item_id, decontaminate.normalise(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in queries.op7_decontamination(spark, SF).collect()}
    texts = {r.doc_id: decontaminate.normalise(r.text) for r in docs.collect()}
    assert set(got) == set(texts)
    hits = 0
    for d, t in texts.items():
        exact = {i for i, x in items if x in t}
        hits += bool(exact)
        assert exact <= set(got[d].item_ids) and got[d].contaminated == bool(got[d].item_ids)
    assert hits
    short = [d for d, t in texts.items() if len(t) < 1500][:60]
    for d in short:
        want = [i for i, x in items if decontaminate.best_match(x, texts[d], decontaminate.budget(len(x))) is not None]
        assert got[d].item_ids == want


def test_item_blocks_are_jobs_of_their_own(spark, docs):
    """Eight blocks of items: the plan of the result holds no chain of scans, and finds are those of one block."""
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    total = items.agg(F.sum(F.length("text"))).first()[0]
    some = docs.select("doc_id", "text")
    one, many = decontaminate.find_items(some, items), decontaminate.find_items(some, items, block_chars=total // 8)
    assert many._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1
    key = lambda df: sorted((r.doc_id, tuple((m.item, m.distance) for m in r.matches)) for r in df.collect())
    assert key(one) == key(many) and any(m for _, m in key(one))


def test_items_in_blocks_and_odd_rows(spark, odd_docs):
    words = odd_docs.where("doc_id = 7").first().text
    items = spark.createDataFrame(
        [(1, words[:90]), (1, words[100:190]), (2, None), (3, " "), (None, words[:90]), (4, words[20:140].upper()), (4, words[20:140])],
        "item_id long, text string",
    )
    one = decontaminate.find_items(odd_docs, items)
    many = decontaminate.find_items(odd_docs, items, block_chars=60)
    rows = lambda df: Counter((r.doc_id, tuple((m.item, m.distance) for m in r.matches)) for r in df.collect())
    assert rows(one) == rows(many)
    assert rows(one)[7, ((1, 0), (4, 0))] == 1 and rows(one)[2, ()] == 1
    assert one.count() == odd_docs.count()
    assert decontaminate.find_items(odd_docs.limit(0), items).count() == 0
    assert decontaminate.find_items(odd_docs, items.limit(0)).where(decontaminate.contaminated()).count() == 0


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, docs, tmp_out):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "sentencepiece"]
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_out}/{name}"
        stage(spark, now, SF).write.parquet(path)
        before, now = now, spark.read.parquet(path)
        seen[name] = (before, now)
        if name != "sentencepiece":
            assert now.dtypes == docs.dtypes
    kept = {r.doc_id for r in queries.op3_quality_rules(spark, SF).where("kept").collect()}
    assert {r.doc_id for r in seen["quality_rules"][1].collect()} == kept
    before, after = seen["line_dedup"]
    want = brute_exact_lines([(r.doc_id, r.text) for r in before.collect()])
    after_rows = {r.doc_id: r for r in after.collect()}
    assert set(after_rows) == set(want) and all(len(after_rows[d].text) <= len(t) for d, t in want.items())
    assert all(r.n_chars == len(r.text) for r in after_rows.values())
    before, after = seen["simhash_near_dedup"]
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in before.collect()]
    assert {r.doc_id for r in after.collect()} == set(brute_components(rows))
    before, after = seen["benchmark_decontamination"]
    items = [(r.item_id, decontaminate.normalise(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    m = decontaminate.Matcher(items, decontaminate.RATE)
    clean = {r.doc_id for r in before.collect() if not m.find(decontaminate.normalise(r.text))}
    assert {r.doc_id for r in after.collect()} == clean
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path())
    before, after = seen["sentencepiece"]
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.ids == sp.encode(texts[r.doc_id]) and r.decoded == sp.decode(r.ids)
    assert after.count() == len(texts)


def brute_exact_lines(rows):
    owner = {}
    for d, t in rows:
        for x in t.split("\n"):
            owner[x] = min(d, owner.get(x, d))
    out = {}
    for d, t in rows:
        seen, kept = set(), []
        for x in t.split("\n"):
            if line_dedup.has_word(x):
                if x in seen or owner[x] != d:
                    continue
                seen.add(x)
            kept.append(x)
        out[d] = "\n".join(kept)
    return out


def test_pipeline_stages_take_odd_and_empty_tables(spark, odd_docs):
    for name, stage in corpus_pipeline.STAGES:
        some = stage(spark, odd_docs, SF)
        if name != "sentencepiece":
            assert some.columns == odd_docs.columns
        some.collect()
        assert stage(spark, odd_docs.limit(0), SF).count() == 0


def test_pipeline_run_is_registered(spark):
    import __spark_entry__ as entry

    found = entry.queries()
    assert "pipeline" in found and sum(n.startswith("op") and n[2].isdigit() for n in found) == 13
    groups = defaultdict(list)
    for n in found:
        if n.startswith("op") and n[2].isdigit():
            groups[n.split("_")[0]].append(n)
    assert set(groups) == {f"op{i}" for i in range(1, 11)}
    assert found["pipeline"](spark, SF).count() > 0
