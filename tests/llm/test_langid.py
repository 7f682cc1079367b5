import numpy as np
from pyspark.sql import functions as F

from basketry.llm import langid, queries
from basketry.llm.common import crc_bucket

SF001 = "/root/testdata/sf0.01"


def test_op5_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = queries.op5_language_id(spark, SF001)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_slots_are_sparks(spark):
    g = np.array([0, 1, 7, 2**40 + 5, 2**63 - 1, -3], np.int64)
    df = spark.createDataFrame([(int(x),) for x in g], "g long").select(F.xxhash64("g").alias("s"))
    assert [r.s for r in df.collect()] == langid.slot(g.view(np.uint64)).view(np.int64).tolist()


def test_words():
    assert langid.words_of("The x²y ½ 12 _a Éa") == ["the", "xy", "a", "éa"] and langid.words_of("½ ² 3") == []


def test_counts_against_brute_force(spark):
    rows = [("en", "The the, cat\nx9y"), ("en", "cat"), ("de", "ß Über")]
    got = {(r.lang, r.g): r.n for r in langid.count_sequences(spark.createDataFrame(rows, "lang string, text string")).collect()}
    want = {}
    for lang, text in rows:
        for w in langid.words_of(text):
            s = "\x02\x02\x02" + w + "\x03"
            for i in range(3, len(s)):
                key = sum(ord(s[i - b]) << (16 * b) for b in range(4))
                want[lang, key] = want.get((lang, key), 0) + 1
    assert got == want


def test_probabilities_sum_to_one(spark):
    """Of every context seen, over all symbols and one unseen, with the back-off of the definition."""
    rows = [("en", "the cat that then sat on the mat"), ("de", "der hat und die das")]
    counts = langid.count_sequences(spark.createDataFrame(rows, "lang string, text string"))
    m = langid.collect_models(langid.model_rows(counts))
    symbols = [ord(c) for c in "abcdefghijklmnopqrstuvwxyz"] + [3]
    symbols = [s for s in symbols if s == 3 or any(chr(s) in t for _, t in rows)]
    for j, context in ((m.langs.index("en"), "\x02th"), (m.langs.index("en"), "\x02\x02\x02"), (m.langs.index("de"), "\x02da")):
        total = 0.0
        for s in [*symbols, 0x1234]:
            full = context + chr(s)
            logp = m.floor[j]
            for order in range(1, 5):
                part = full[4 - order :]
                key = sum(ord(part[-1 - b]) << (16 * b) for b in range(order))
                own = m._look("p", order, np.array([key], np.uint64))[0, j]
                back = m._look("b", order, np.array([key >> 16], np.uint64))[0, j]
                logp = own if not np.isnan(own) else logp + (0 if np.isnan(back) else back)
            total += np.exp(logp)
        assert abs(total - 1) < 1e-3, (context, total)


def plain_model(rows):
    """Interpolated Kneser-Ney from the definition, in dictionaries: (language -> function of a padded string's end)."""
    from collections import Counter

    grams = {}
    for lang, text in rows:
        own = grams.setdefault(lang, Counter())
        for w in langid.words_of(text):
            s = "\x02\x02\x02" + w + "\x03"
            own.update(s[i - 3 : i + 1] for i in range(3, len(s)))
    levels = {}
    for lang, own in grams.items():
        levels[lang] = {4: own}
        for k in (3, 2, 1):
            levels[lang][k] = Counter(g[1:] for g in levels[lang][k + 1])
    symbols = len({g for own in levels.values() for g in own[1]})

    def probability(lang, g):
        if not g:
            return 1 / (symbols + 1)
        own = levels[lang][len(g)]
        ones, twos = (sum(v == i for v in own.values()) for i in (1, 2))
        d = min(max(ones / (ones + 2 * twos) if ones + 2 * twos else 0.5, 0.1), 0.9)
        after = [v for x, v in own.items() if x[:-1] == g[:-1]]
        low = probability(lang, g[1:])
        return max(own[g] - d, 0) / sum(after) + d * len(after) / sum(after) * low if after else low

    return sorted(levels), probability


def test_scores_against_the_plain_definition(spark):
    """Whole texts: language, score and cost of both forms of scoring."""
    import math

    rows = [("en", "the cat that then sat on the mat with the other hat"), ("de", "der hat und die das ist ein haus mit dem dach"), ("fr", "le chat est dans la maison et il dort")]
    texts = ["the dach", "die maison", "xyz ж", "then the that", "il est ein", "12", None, "das das das hat", "q"]
    langs, probability = plain_model(rows)
    counts = langid.count_sequences(spark.createDataFrame(rows, "lang string, text string"))
    model = langid.model_rows(counts.select("lang", "g", "n"))
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for limit in (langid.MAX_MODEL, 0):
        got = {r.id: r for r in langid.score(docs, model, ["id"], limit).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            words = langid.words_of(t or "")
            if not words:
                assert (got[i].lang_pred, got[i].score) == ("und", 0)
                continue
            padded = ["\x02\x02\x02" + w + "\x03" for w in words]
            size = sum(map(len, padded)) - 3 * len(padded)
            cost = {lang: -sum(math.log(probability(lang, s[k - 3 : k + 1])) for s in padded for k in range(3, len(s))) / size for lang in langs}
            best = min(langs, key=lambda x: (round(cost[x], 5), x))
            assert got[i].lang_pred == best, (t, cost)
            assert abs(got[i].cost_milli - 1000 * cost[best]) <= 1 and got[i].n_letters == size
            assert abs(got[i].score - 1 / sum(math.exp((cost[best] - c) * min(size, 32)) for c in cost.values())) < 1e-3


def test_both_forms_agree_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = ({r.doc_id: r for r in langid.identify(docs, max_model=n).collect()} for n in (langid.MAX_MODEL, 0))
    assert a.keys() == b.keys()
    for i, r in a.items():
        assert (r.lang_pred, r.rejected) == (b[i].lang_pred, b[i].rejected) and abs(r.score - b[i].score) < 1e-3 and abs(r.cost - b[i].cost) < 2e-3


def test_rejection_is_alike_on_texts_held_out(spark):
    """Limits come from texts that the model has not counted: held-out texts are not rejected more often."""
    rows = queries.op5_language_id(spark, SF001).collect()
    share = [sum(r.rejected for r in rows if r.held_out == h) / sum(r.held_out == h for r in rows) for h in (True, False)]
    assert max(share) < 0.02


def test_odd_rows(spark, odd_docs):
    rows = langid.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    pred = {r.doc_id: r.lang_pred for r in rows if r.doc_id}
    assert pred[1] == pred[2] == pred[3] == pred[10] == "und" and pred[4] == "en"
    assert {r.lang_pred for r in langid.identify(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(odd_docs.limit(0)).count() == 0


def test_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    keep = crc_bucket("doc_id", 4) != 2
    spoilt = docs.withColumn("lang", F.when(keep, F.col("lang")).otherwise(F.lit("xx")))
    a, b = ({r.doc_id: (r.lang_pred, round(r.score, 9)) for r in langid.identify(d, train_if=keep).collect()} for d in (docs, spoilt))
    assert a == b


def test_foreign_text_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "zqxj vkwq jjxz qqzx wvkj " * 30, None)], docs.schema)
    rows = {r.doc_id: r.rejected for r in langid.identify(docs.union(odd)).collect()}
    assert rows[-1] and sum(rows.values()) < 0.05 * len(rows)
