import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from basketry.llm import fertility, queries, rule_ensemble, textstats

SF = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


def brute(t):
    w = re.findall("[^\x20\x09-\x0d]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    marked = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), dup, len(marked)


def test_base_statistics(docs):
    texts = [r.text for r in docs.collect()]
    texts += ["", " ", "a b\n\na b\na b", "x " * 20, "\x1c a　b\u0085", "a b c d e f g h " * 2, "é é\né é\n \né é"]
    for t in texts:
        assert textstats.base_statistics(t.encode()) == brute(t), t


def test_op3_rows(spark, docs):
    got = queries.op3_quality_rules(spark, SF)
    rows = {r.doc_id: r for r in got.collect()}
    assert got.columns[:8] == ["doc_id", *fertility.BASE, "base_failed", "kept"]
    assert len(rows) == docs.count()
    for r in docs.collect():
        b, x = brute(r.text), rows[r.doc_id]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == b
        assert x.base_failed == (b[0] < 20 or 100 * b[4] > 30 * b[0])
        assert not (x.kept and x.base_failed)


def test_op3_keeps_clean_documents_and_rejects_junk(spark):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    rows = queries.op3_quality_rules(spark, SF001).where("not base_failed").join(labels, "doc_id").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.99 * len(clean)
    assert sum(junk) <= 0.6 * len(junk)


def brute_kept(rows, figures):
    """The verdicts as registered, from sorted lists: distinct texts, nearest classes, script where a language is too small."""
    import numpy as np

    once = rows.drop_duplicates(["lang", "script", "cls", "text"])
    pools = {("g", g): d for g, d in once.groupby("lang")} | {("s", g): d for g, d in once.groupby("script")} | {("s", "common"): once}

    def quartiles(pool, cls, c):
        near = sorted(set(abs(pool.cls - cls)))
        for reach in near:
            some = pool[abs(pool.cls - cls) <= reach]
            if len(some) >= fertility.MIN_GROUP:
                return True, np.quantile(some[c], [0.25, 0.75])
        return False, np.quantile(pool[c], [0.25, 0.75])

    kept = []
    for r in rows.itertuples():
        bad = False
        for c in figures:
            enough, (lo, hi) = quartiles(pools["g", r.lang], r.cls, c)
            if not enough:
                lo, hi = quartiles(pools["s", r.script], r.cls, c)[1]
            kind = c.removesuffix("_2")
            least, by, sides = {"chars_per_token": (20, 5.0, "lh"), "entropy": (50, 2.5, "l"), "byte_share": (5, 5.0, "h")}[kind]
            w, v = max(hi - lo, least), getattr(r, c)
            bad |= ("l" in sides and v < lo - by * w) or ("h" in sides and v > hi + by * w)
        kept.append(not r.base_failed and not bad)
    return kept


def test_registered_verdicts_against_brute_force(spark):
    import numpy as np

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = queries.op3_quality_rules(spark, SF).join(docs, "doc_id").toPandas()
    rows = rows[rows.n_tokens > 0].copy()
    rows["cls"] = np.floor(np.log2(rows.n_tokens)).astype(int)
    rows["script"] = rows.text.map(textstats.script)
    rows["lang"] = rows.lang.fillna(rows.script)
    figures = fertility.figure_names(2)
    assert set(figures) < set(rows.columns)
    assert rows.kept.tolist() == brute_kept(rows, figures)


def test_figures_of_the_second_vocabulary(spark, model):
    import numpy as np

    path = queries.quality_vocabularies()[1]
    encode, is_byte = fertility.vocabulary(path)
    texts = ["plain words here", "日本語と😀", "été", "", "<|endoftext|> x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.stats for r in fertility.add_statistics(df, [model, path]).collect()}
    for i, (t, ids) in enumerate(zip(texts, encode(texts))):
        share = np.unique(ids, return_counts=True)[1] / max(len(ids), 1)
        assert got[i].chars_per_token_2 == (round(1000 * len(t) / len(ids)) if ids else 0)
        assert got[i].byte_share_2 == (round(1000 * sum(map(bool, is_byte[ids])) / len(ids)) if ids else 0)
        assert got[i].entropy_2 == round(-1000 * float((share * np.log2(share)).sum()))


ODD = [" ", " ", "\n", "\t", "▁", "\u3000", "\x1c", "\x85", "\xa0", "\u2009", "'s", "'", "a", "the", "of", "1", "23", "é", "e\u0301", "日"]
ODD += ["。", "😀", "\0", "^", "<s>", "</s>", "<0x0A>", "\r\n", "\x0b", "#", "##", "ab", "\u200b", "ﬁ"]


def odd_texts(n, pieces, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(pieces, k=rnd.randint(0, 30))) for _ in range(n)]


def test_tokens_by_chunks_are_those_of_whole_texts(docs):
    """Also where the table of chunks starts anew, and for texts that begin or end with any kind of blank."""
    texts = [r.text for r in docs.collect()] + odd_texts(3000, ODD) + ["", " ", "  ", "\n", "^", "▁", " ▁", "x ", "x▁ y", "\n\n a  b\t c \n"]
    models = queries.quality_vocabularies()
    tokens = fertility.Tokens(models, table_bytes=5000)
    assert all(tokens.parts)
    got = [[] for _ in models]
    for at in range(0, len(texts), 97):
        for v, (ids, n) in enumerate(tokens.of(texts[at : at + 97])):
            got[v] += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    for v, path in enumerate(models):
        assert got[v] == fertility.vocabulary(path)[0](texts), path


def test_a_chunk_is_encoded_once():
    tokens = fertility.Tokens(queries.quality_vocabularies())
    given, parts = [], tokens.parts
    tokens.parts = [lambda chunks, f=f: given.append(len(chunks)) or f(chunks) for f in parts]
    for _ in range(3):
        found = tokens.of(["one two three two one"] * 50 + ["one  two\nthree"])
    assert given == [6, 6, 0, 0, 0, 0]  # ^one, one, two, three; two after two blanks; a line's three
    assert [n.tolist() for _, n in found] == [[len(fertility.vocabulary(m)[0]([t])[0]) for t in ["one two three two one"] * 50 + ["one  two\nthree"]] for m in queries.quality_vocabularies()]


def test_vocabulary_that_crosses_blanks_gets_whole_texts(monkeypatch, model):
    def refuse(path):
        raise ValueError

    texts = ["a b", "", " c"]
    monkeypatch.setattr(fertility, "check_model", refuse)
    tokens = fertility.Tokens([model])
    assert tokens.parts == [None]
    ((ids, n),) = tokens.of(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == fertility.vocabulary(model)[0](texts)


def test_statistics_of_many_texts_are_those_of_each():
    texts = odd_texts(2000, [" ", " ", "\n", "\t", "\x1c", "a", "b", "é", "#", "<", "日", "\xa0"]) + ["", "a b c d e f g h " * 2, "x " * 20]
    got = textstats.base_statistics_of([t.encode() for t in texts])
    assert list(map(tuple, got.tolist())) == [brute(t) for t in texts]
    assert textstats.base_statistics_of([]).shape == (0, 5)


def test_equal_window_hashes_are_told_apart(monkeypatch):
    """With a hash that gives every window the same number, the windows themselves are counted."""
    monkeypatch.setattr(textstats, "_MIX", np.zeros(8, np.uint64))
    texts = odd_texts(300, [" ", "\n", "a ", "b "]) + ["a b c d e f g h " * 2]
    got = textstats.base_statistics_of([t.encode() for t in texts])
    assert list(map(tuple, got.tolist())) == [brute(t) for t in texts]


def test_bands_joined_on_salted_groups(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = ({r.doc_id: r.kept for r in fertility.quality_rules(docs, model, min_group=3, max_bands=n).collect()} for n in (20_000, 0))
    assert a == b and len(a) == docs.count()


def test_copies_leave_other_verdicts_unchanged(spark, model):
    """A document copied until it holds a third of the rows does not narrow the band of its cell."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("lang = 'en'").groupBy("text", "lang").agg(F.min("doc_id").alias("doc_id"))
    labels = spark.read.parquet(f"{SF001}/labels.parquet").where("quality = 1")
    plain = fertility.quality_rules(docs, model).join(labels, "doc_id", "left")
    rows = [r for r in plain.collect() if r.kept and r.quality == 1 and 256 <= r.n_tokens < 512]
    hot = docs.where(F.col("doc_id") == max(rows, key=lambda r: r.chars_per_token).doc_id)
    copies = hot.withColumn("doc_id", F.explode(F.sequence(F.lit(-300).cast("long"), F.lit(-1).cast("long"))))
    both = docs.unionByName(copies.select(docs.columns))
    want = {r.doc_id: r.kept for r in plain.collect()}
    got = {r.doc_id: r.kept for r in fertility.quality_rules(both, model).collect()}
    assert {k: v for k, v in got.items() if k >= 0} == want
    assert all(got[k] for k in range(-300, 0))


def test_small_groups_are_judged(spark, model):
    """Every text with tokens has a band, from the nearest classes, and junk in small cells is rejected."""
    import numpy as np

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang")
    own = fertility.add_statistics(docs, model).cache()
    table = fertility.bands(own, F.col("lang")).collect()
    rows = own.where("stats.n_tokens > 0").select("lang", "text", "stats.*").toPandas().drop_duplicates(["lang", "text"])
    rows["cls"] = np.floor(np.log2(rows.n_tokens)).astype(int)
    assert {(r.group, r.script, r["class"]) for r in table} == set(zip(rows.lang, rows.script, rows.cls))
    for r in table:
        g = rows[rows.lang == r.group]
        reach = next(d for d in range(64) if (abs(g.cls - r["class"]) <= d).sum() >= fertility.MIN_GROUP)
        near = g[abs(g.cls - r["class"]) <= reach]
        for c in fertility.FIGURES:
            assert np.allclose(r[f"{c}_q"], np.quantile(near[c], [0.25, 0.5, 0.75]))
    junk = spark.read.parquet(f"{SF001}/labels.parquet").where("quality = 0")
    small = rows.groupby(["lang", "cls"]).size()
    found = fertility.quality_rules(docs, model).join(docs.select("doc_id", "lang"), "doc_id").join(junk, "doc_id")
    few = [r.kept for r in found.where("not base_failed and n_tokens > 0").collect() if small[r.lang, int(np.log2(r.n_tokens))] < fertility.MIN_GROUP]
    assert sum(few) < len(few)


def test_small_groups_few_texts(spark, model, odd_docs):
    """Few texts in all are judged too, by their script; a lone clean text of another script is not dropped for that."""
    clean = spark.read.parquet(f"{SF001}/documents.parquet").join(
        spark.read.parquet(f"{SF001}/labels.parquet").where("quality = 1"), "doc_id"
    )
    some = clean.where("lang = 'en' and length(text) between 800 and 1600").orderBy("doc_id").limit(12).select("doc_id", "text", "lang")
    greek = "Το πρωί ο ήλιος ανέβηκε πάνω από τη θάλασσα και τα παιδιά έτρεξαν στην παραλία για να παίξουν με την άμμο, "
    greek += "ενώ οι ψαράδες γύριζαν στο λιμάνι με τις βάρκες τους γεμάτες ψάρια και μιλούσαν για τον καιρό της νύχτας."
    more = spark.createDataFrame(
        [(-1, " ".join(f"{'#' * (i % 5 + 20)}" for i in range(60)), "en"), (-2, greek, "el")], some.schema
    )
    got = {r.doc_id: r for r in fertility.quality_rules(some.unionByName(more), model, max_repeat_pct=100).collect()}
    assert not got[-1].kept and not got[-1].base_failed and got[-2].kept
    a, b = (
        {r.doc_id: r.kept for r in fertility.quality_rules(clean.drop("quality"), model, max_bands=n).collect()}
        for n in (20_000, 0)
    )
    assert a == b
    assert fertility.quality_rules(odd_docs, model).count() == odd_docs.count()
    assert fertility.quality_rules(odd_docs.limit(0), model).count() == 0


def test_scripts():
    assert [textstats.script(t) for t in ("", "12", "abc", "привет a", "日本の日本", "éa")] == [
        "common", "common", "latin", "cyrillic", "han", "latin"
    ]


def test_op3_odd_rows(spark, odd_docs, model):
    rows = fertility.quality_rules(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.n_words == 0 and r.base_failed for r in rows if r.doc_id in (1, 2, 3))
    assert fertility.quality_rules(odd_docs.limit(0), model).count() == 0
    no_lang = odd_docs.drop("lang")
    assert fertility.quality_rules(no_lang, model).count() == odd_docs.count()


def test_op4_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    got = queries.op4_quality_classifier(spark, SF001)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id", "left").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.quality is not None]
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


def test_op4_never_learns_from_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    from basketry.llm.common import crc_bucket

    keep = crc_bucket("doc_id", 5) != 0
    spoilt = labels.withColumn("quality", F.when(keep, F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = (
        {r.doc_id: round(r.score, 9) for r in rule_ensemble.classify(docs, x, train_if=keep).collect()} for x in (labels, spoilt)
    )
    assert a == b


def test_rules_are_tree_paths():
    text = """RandomForestClassificationModel: numTrees=1
  Tree 0 (weight 1.0):
    If (feature 2 <= 0.5)
     If (feature 2 <= 0.25)
      Predict: 0.0
     Else (feature 2 > 0.25)
      Predict: 1.0
    Else (feature 2 > 0.5)
     Predict: 1.0
"""
    assert rule_ensemble.tree_paths(text) == [
        ((2, "<=", 0.5),), ((2, "<=", 0.25),), ((2, "<=", 0.5), (2, ">", 0.25)), ((2, ">", 0.5),)
    ]


def test_op4_odd_rows(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = rule_ensemble.classify(odd_docs, none).collect()
    assert len(rows) == odd_docs.count() and {r.score for r in rows} == {0.5}
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 0), (None, 1), (6, None), (7, 1), (8, 1)], "doc_id long, quality int")
    assert rule_ensemble.classify(odd_docs, labels).count() == odd_docs.count()
    assert rule_ensemble.classify(odd_docs.limit(0), labels).count() == 0
