"""Language identification by interpolated Kneser-Ney character models.

A text is its lower-cased runs of letters. Every word is read by itself:
padded in front, closed by an end mark, and each character predicted from up
to three before it. Counts of four-character sequences come from all training
text; everything else (continuation counts, discounts, probabilities, back-off
weights) follows from them in grouped aggregations.

The finished model is, per order, one sorted array of 64-bit hashes with the
(language, log-probability) entries of each beside it; only entries that exist
are kept, so its size is that of the distinct sequences. The hash of a packed
sequence is one-to-one, so no two meet. A word's cost is the sum over its
characters; the language with the lowest cross-entropy per character wins, and a
text whose cross-entropy lies beyond what texts of that language show is marked
``rejected``. Those limits come from a tenth of the training texts, scored by a
model that has not counted them.

Scale: distinct words are counted per batch and only their sequences leave the
task, already summed; scoring looks each distinct word of a batch up once. A
model of at most ``MAX_MODEL`` entries goes to the tasks; a larger one stays a
table, and the sequences of the corpus's distinct words are joined to it.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import fresh_name, slices, stored, text_or_empty

ORDER = 4
PAD, STOP = 2, 3  # control characters that no word holds
BATCH_CHARS = 1 << 23
WORDS = re.compile(r"[^\W\d_]+").findall  # runs of letters
UNKNOWN = "und"
MAX_MODEL = 20_000_000  # most model entries sent to the tasks (about 20 bytes each)
FOLDS = 10  # one of so many parts of the training texts sets the rejection limits
MIN_CLASS = 40  # held-back texts that a limit is taken from
COST_CLASS = 8  # rejection limits are per power of two of the length, up to this one


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters (numbers such as one half count as word characters to ``re``, not as letters)."""
    found = WORDS(text.lower())
    if text.isascii():
        return found
    return [w for x in found if (w := x if x.isalpha() else "".join(filter(str.isalpha, x)))]


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(16-bit codes of all padded words in a row, number of predicted characters per word)."""
    joined = "".join([f"\x02\x02\x02{w}\x03" for w in words])
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    # characters beyond 16 bits share the private-use codes
    c = np.where(points > 0xFFFF, 0xE000 + points % 0x1900, points).astype(np.uint64)
    return c, np.fromiter(map(len, words), np.int64, len(words)) + 1


def grams(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys of the four codes that end at each predicted character, their positions)."""
    at = np.flatnonzero(c != PAD)
    key = np.zeros(len(at), np.uint64)
    for back in range(ORDER):
        key |= c[at - back] << np.uint64(16 * back)
    return key, at


def slot(keys: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of a long, unsigned; one-to-one on longs."""
    # The five primes of XXH64; 42 is the seed of the SQL function.
    p1, p2, p3, p4, p5 = (
        np.uint64(x)
        for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
    )
    turn = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    h = (np.uint64(42) + p5 + np.uint64(8)) ^ (turn(keys * p2, 31) * p1)
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list[list], list[str]]]:
    others, texts, size = [[] for _ in range(width)], [], 0
    for b in slices(batches):
        given = [b.column(i).to_pylist() for i in range(width)]
        for k, t in enumerate(b.column(width).to_pylist()):
            for o, g in zip(others, given):
                o.append(g[k])
            texts.append(t)
            size += len(t)
            if size >= BATCH_CHARS:
                yield others, texts
                others, texts, size = [[] for _ in range(width)], [], 0
    if texts:
        yield others, texts


def count_sequences(train: DataFrame) -> DataFrame:
    """(lang, g, n, held): how often each sequence of four occurs, and how often in the texts that set the limits.

    ``train`` has ``lang`` and ``text``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (langs, held), texts in _blocks(batches, 2):
            seen: dict[tuple, Counter] = defaultdict(Counter)
            for lang, h, t in zip(langs, held, texts):
                seen[lang, h].update(words_of(t))
            for (lang, h), found in seen.items():
                words = list(found)
                if not words:
                    continue
                c, sizes = codes(words)
                key, _ = grams(c)
                times = np.repeat(np.fromiter(found.values(), np.int64, len(found)), sizes)
                order = np.argsort(key, kind="stable")
                key, times = key[order], times[order]
                first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(first), pa.string()),
                        pa.array(key[first].view(np.int64)),
                        pa.array(np.add.reduceat(times, first)),
                        pa.array(np.add.reduceat(times, first) * h),
                    ],
                    names=["lang", "g", "n", "held"],
                )

    given = train.select("lang", sets_limits(F.col("text")).alias("h"), "text")
    counted = given.mapInArrow(run, "lang string, g long, n long, held long")
    return counted.groupBy("lang", "g").agg(F.sum("n").alias("n"), F.sum("held").alias("held"))


def sets_limits(text: Column) -> Column:
    """Is this training text one of those that set the limits? By its content, so copies go together."""
    return F.pmod(F.xxhash64(text, F.lit(5)), F.lit(FOLDS)) == 0


MODEL_ROW = "lang string, k int, g long, kind string, value double"
SMALL = 500_000  # most rows of a lookup table sent to the tasks (up to 40 bytes each); more are joined by key


def model_rows(counts: DataFrame) -> DataFrame:
    """Natural-log probabilities (``p``) and back-off weights (``b``) of every order, as ``MODEL_ROW``."""
    spark = counts.sparkSession
    levels = {ORDER: counts.select("lang", "g", "n")}
    for k in range(ORDER - 1, 0, -1):
        # continuation counts: how many different characters come before the sequence
        tail = F.col("g").bitwiseAND(F.lit((1 << 16 * k) - 1))
        levels[k] = stored(levels[k + 1].groupBy("lang", tail.alias("g")).agg(F.count("*").alias("n")), f"langid-{k}")
    every = None
    for k, level in levels.items():
        own = level.select(F.lit(k).alias("k"), "lang", "n")
        every = own if every is None else every.union(own)
    n1, n2 = (F.count_if(F.col("n") == i) for i in (1, 2))
    # the usual estimate of the discount, kept inside (0, 1) where counts of one or two are missing:
    # one number per language and order
    cut = F.least(F.greatest(F.coalesce(F.try_divide(n1, n1 + 2 * n2), F.lit(0.5)), F.lit(0.1)), F.lit(0.9))
    cuts = every.groupBy("k", "lang").agg(cut.alias("d")).collect()
    if not cuts:
        return spark.createDataFrame([], MODEL_ROW)
    symbols = levels[1].select("g").distinct().count()
    floor = [(lang, 0, 0, "p", float(-np.log(symbols + 1))) for lang in sorted({r.lang for r in cuts})]
    lower, out = None, spark.createDataFrame(floor, MODEL_ROW)
    for k in range(1, ORDER + 1):
        d = F.element_at(F.create_map(*[F.lit(x) for r in cuts if r.k == k for x in (r.lang, r.d)]), F.col("lang"))
        head = F.shiftrightunsigned("g", 16) if k > 1 else F.lit(0).cast("long")
        same = Window.partitionBy("lang", "h")  # the characters after one context: at most 65,536 rows
        c = levels[k].withColumn("h", head).withColumns(
            {
                "total": F.sum("n").over(same),
                "kinds": F.count("*").over(same),
                "first": F.row_number().over(same.orderBy("g")) == 1,
            }
        )
        if k == 1:
            c = c.withColumn("low", F.lit(1.0 / (symbols + 1)))
        else:
            tail = F.col("g").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1))
            c = c.withColumn("t", tail).join(F.broadcast(lower) if lower.count() <= SMALL else lower, ["lang", "t"])
        back = d * F.col("kinds") / F.col("total")
        p = F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("total") + back * F.col("low")
        probs = stored(c.select("lang", "g", "h", "first", p.alias("p"), back.alias("back")), f"langid-p{k}")
        lower = probs.select("lang", F.col("g").alias("t"), F.col("p").alias("low"))
        out = out.union(probs.select("lang", F.lit(k), "g", F.lit("p"), F.log("p")))
        out = out.union(probs.where("first").select("lang", F.lit(k), "h", F.lit("b"), F.log("back")))
    return out


class Entries:
    """Sorted distinct hashes; each has a run of (language, value) entries."""

    def __init__(self, hashes: np.ndarray, lang: np.ndarray, value: np.ndarray):
        order = np.lexsort((lang, hashes))
        hashes, self.lang, self.value = hashes[order], lang[order], value[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(hashes)), bool), hashes[1:] != hashes[:-1])))
        self.hashes, self.ends = hashes[first], np.append(first, len(hashes))

    def look(self, keys: np.ndarray, langs: int) -> np.ndarray:
        """(keys, languages) values; NaN where there is none."""
        out = np.full((len(keys), langs), np.nan, np.float32)
        if len(self.hashes):
            s = slot(keys)
            at = np.minimum(np.searchsorted(self.hashes, s), len(self.hashes) - 1)
            row = np.flatnonzero(self.hashes[at] == s)
            lo, n = self.ends[at[row]], self.ends[at[row] + 1] - self.ends[at[row]]
            place = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            out[np.repeat(row, n), self.lang[place]] = self.value[place]
        return out


@dataclass
class Models:
    """Per order, the log-probabilities ``p`` and back-off weights ``back``: (hashes, languages, values) each."""

    langs: list[str]
    p: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    back: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    floor: np.ndarray

    def __post_init__(self):
        self.tables = {(kind, k): Entries(*part) for kind, parts in (("p", self.p), ("b", self.back)) for k, part in parts.items()}

    def _look(self, kind: str, order: int, keys: np.ndarray) -> np.ndarray:
        return self.tables[kind, order].look(keys, len(self.langs))

    def word_costs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(negative log-probability of each word in each language, characters predicted)."""
        parts = [self._some_costs(words[at : at + 32_768]) for at in range(0, len(words), 32_768)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _some_costs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        c, sizes = codes(words)
        key, _ = grams(c)
        distinct, which = np.unique(key, return_inverse=True)
        lp = np.broadcast_to(self.floor, (len(distinct), len(self.langs)))
        for order in range(1, ORDER + 1):
            part = distinct & np.uint64((1 << 16 * order) - 1)
            own = self._look("p", order, part)
            # an unseen context leaves the lower order as it is
            weight = np.nan_to_num(self._look("b", order, part >> np.uint64(16)), nan=0.0)
            lp = np.where(np.isnan(own), lp + weight, own)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        return -np.add.reduceat(lp[which].astype(np.float64), starts, axis=0), sizes


def collect_models(rows: DataFrame) -> Models:
    """The model's entries as arrays; ``rows`` are at most ``MAX_MODEL``."""
    found = rows.select("lang", "k", "kind", F.xxhash64("g").alias("h"), F.col("value").cast("float").alias("value")).toArrow()
    lang = found.column("lang").combine_chunks().dictionary_encode() if found.num_rows else pa.array([], pa.string()).dictionary_encode()
    names = lang.dictionary.to_pylist()
    langs = sorted(names)
    place = np.array([langs.index(n) for n in names], np.uint16)[lang.indices.to_numpy()] if names else np.zeros(0, np.uint16)
    k, h, v = (found.column(c).to_numpy() for c in ("k", "h", "value"))
    h = h.view(np.uint64)
    is_p = pc.equal(found.column("kind"), "p").to_numpy()
    floor = np.zeros(len(langs), np.float32)
    floor[place[k == 0]] = v[k == 0]
    parts = [{o: (h[m], place[m], v[m]) for o in range(1, ORDER + 1) for m in [(k == o) & (is_p == kind)]} for kind in (True, False)]
    return Models(langs, *parts, floor)


def score_documents(docs: DataFrame, models: Models, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus ``lang_pred``, ``score``, ``cost_milli`` (per character) and ``n_chars``."""
    given = docs.select(*[F.col(f"`{c}`") for c in keep], text_or_empty(text_col).alias("_text"))
    fields = "lang_pred string, score double, cost_milli long, n_letters long"
    from pyspark.sql.types import StructType

    schema = StructType([*given.schema.fields[:-1], *StructType.fromDDL(fields).fields])
    # plain values: the workers need no copy of this package
    shared = docs.sparkSession.sparkContext.broadcast((models.langs, models.p, models.back, models.floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Models(*shared.value)
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in schema.fields]
        for others, texts in _blocks(batches, len(keep)):
            number = defaultdict(count().__next__)
            ids = [np.fromiter(map(number.__getitem__, words_of(t)), np.int64) for t in texts]
            n = np.array([len(i) for i in ids])
            pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            cost, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            if number and m.langs:
                costs, sizes = m.word_costs(list(number))
                with_words = np.flatnonzero(n)
                flat = np.concatenate([ids[i] for i in with_words])
                starts = np.concatenate(([0], np.cumsum(n[with_words])[:-1]))
                size = np.add.reduceat(sizes[flat], starts)
                entropy = np.column_stack([np.add.reduceat(costs[flat, j], starts) for j in range(len(m.langs))]) / size[:, None]
                best = entropy.argmin(axis=1)  # ties go to the first language by name
                # posterior over the languages from at most 32 characters' worth of evidence
                odds = np.exp((entropy.min(axis=1, keepdims=True) - entropy) * np.minimum(size, 32)[:, None])
                score[with_words] = 1 / odds.sum(axis=1)
                cost[with_words] = np.rint(1000 * entropy.min(axis=1))
                letters[with_words] = size
                for i, b in zip(with_words, best):
                    pred[i] = m.langs[b]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip([*others, pred, score, cost, letters], types)], names=schema.fieldNames()
            )

    return given.mapInArrow(run, schema)


def score_by_join(docs: DataFrame, rows: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """As :func:`score_documents`, with the model as a table that nothing holds in whole.

    The distinct words' sequences meet the table by key; costs of words then
    meet the documents. Joins on frequent words are split by adaptive execution.
    """
    spark = docs.sparkSession
    rows = rows.select("lang", "k", "kind", "g", F.col("value").cast("float").cast("double").alias("value"))
    langs = sorted(r.lang for r in rows.where("k = 0").select("lang").collect())  # one per language
    row = fresh_name(keep, "_row")
    given = stored(docs.select(*[F.col(f"`{c}`") for c in keep], text_or_empty(text_col).alias("_text")).withColumn(row, F.monotonically_increasing_id()), "langid-rows")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = [(i, w, n) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for w, n in Counter(words_of(t)).items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 3, (pa.int64(), pa.string(), pa.int64()))], names=["row", "word", "n"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            words = b.column(0).to_pylist()
            if not words:
                continue
            c, sizes = codes(words)
            key, _ = grams(c)
            place = np.arange(len(key)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            for k in range(1, ORDER + 1):
                part = key & np.uint64((1 << 16 * k) - 1)
                for kind, keys in (("p", part), ("b", part >> np.uint64(16))):
                    columns = [pa.array(np.repeat(np.array(words, object), sizes), pa.string()), pa.array(place), pa.array([k] * len(key), pa.int32()), pa.array([kind] * len(key)), pa.array(keys.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["word", "at", "k", "kind", "g"])

    held = stored(given.select(row, "_text").mapInArrow(split, "row long, word string, n long"), "langid-words")
    words = held.select("word").distinct()
    met = words.mapInArrow(cut, "word string, at long, k int, kind string, g long").join(rows.where("k > 0"), ["k", "kind", "g"])
    is_p = F.col("kind") == "p"
    back = [F.max(F.when(~is_p & (F.col("k") == k), F.col("value"))).alias(f"b{k}") for k in range(1, ORDER + 1)]
    chars = met.groupBy("word", "lang", "at").agg(
        F.coalesce(F.max(F.when(is_p, F.col("k"))), F.lit(0)).alias("top"),
        F.max_by(F.when(is_p, F.col("value")), F.when(is_p, F.col("k"))).alias("p"),
        *back,
    )
    floors = F.create_map(*[F.lit(x) for r in rows.where("k = 0").collect() for x in (r.lang, r.value)]) if langs else F.create_map()
    lost = [F.when(F.col("top") < k, F.coalesce(f"b{k}", F.lit(0.0))).otherwise(F.lit(0.0)) for k in range(1, ORDER + 1)]
    own = F.coalesce("p", floors[F.col("lang")])
    for x in lost:
        own = own + x
    known = chars.groupBy("word", "lang").agg(F.sum(own).alias("lp"), F.count("*").alias("seen"))
    every = words.withColumn("lang", F.explode(F.array(*[F.lit(x) for x in langs]).cast("array<string>")))
    costs = every.join(known, ["word", "lang"], "left").select(
        "word",
        "lang",
        # characters of which the table has nothing cost the floor
        (-F.coalesce("lp", F.lit(0.0)) - (F.length("word") + 1 - F.coalesce("seen", F.lit(0))) * floors[F.col("lang")]).alias("cost"),
    )
    per_word = stored(costs.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("lang", "cost"))).alias("costs")), "langid-costs")
    sums = held.join(per_word, "word").groupBy("row").agg(
        F.sum((F.length("word") + 1) * F.col("n")).alias("size"),
        *[F.sum(F.col("costs")[x] * F.col("n")).alias(f"c{i}") for i, x in enumerate(langs)],
    )
    each = [F.struct((F.col(f"c{i}") / F.col("size")).alias("e"), F.lit(x).alias("lang")) for i, x in enumerate(langs)]
    sums = sums.withColumn("all", F.array(*each)).withColumn("best", F.array_min("all")).withColumnRenamed("row", row)
    odds = F.aggregate("all", F.lit(0.0), lambda s, x: s + F.exp((F.col("best.e") - x["e"]) * F.least("size", F.lit(32))))
    joined = given.drop("_text").join(sums, row, "left") if langs else given.drop("_text").withColumns({"size": F.lit(None).cast("long")})
    if not langs:
        return joined.select(*[F.col(f"`{c}`") for c in keep], F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("cost_milli"), F.lit(0).cast("long").alias("n_letters"))
    return joined.select(
        *[F.col(f"`{c}`") for c in keep],
        F.coalesce("best.lang", F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce(1 / odds, F.lit(0.0)).alias("score"),
        F.coalesce(F.rint(1000 * F.col("best.e")), F.lit(0.0)).cast("long").alias("cost_milli"),
        F.coalesce("size", F.lit(0)).cast("long").alias("n_letters"),
    )


def score(docs: DataFrame, model: DataFrame, keep: list[str], max_model: int) -> DataFrame:
    """Scores by a model given as ``MODEL_ROW`` rows: sent to the tasks while small enough, joined otherwise."""
    model = stored(model, "langid-model")
    if model.count() <= max_model:
        return score_documents(docs, collect_models(model), keep)
    return score_by_join(docs, model, keep)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    train_if: Column | None = None,
    margin: float = 1.25,
    max_model: int = MAX_MODEL,
) -> DataFrame:
    """One row per row of ``docs``: id, ``lang_pred``, ``score``, ``cost`` (nats per character) and ``rejected``.

    Learns from all rows with a language and ``train_if`` (default: every
    row). ``lang_pred`` is a learnt language, or ``und`` for a null text or one
    without letters (score 0); ties go to the first language by name. A text is
    ``rejected`` when its cost passes ``margin`` times the 99.9th percentile of
    held-back training texts of the predicted language and its length class;
    a class with fewer than ``MIN_CLASS`` such texts takes in the nearest ones
    and their largest limit, and a language without any rejects nothing.
    ``und`` is always rejected. Null ids and
    repeated rows stay; other columns are ignored. Without training rows every
    text is ``und``; an empty table gives no rows.
    """
    known = F.col(f"`{lang_col}`").isNotNull()
    train = known if train_if is None else known & F.coalesce(train_if, F.lit(False))
    text = text_or_empty(text_col)
    taught = docs.where(train).select(F.col(f"`{lang_col}`").cast("string").alias("lang"), text.alias("text"))
    sequences = stored(count_sequences(taught), "langid-4")
    own = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    scored = stored(score(own, model_rows(sequences.select("lang", "g", "n")), ["id"], max_model), "langid-scores")
    # the limits: texts that the model below has not counted
    rest = sequences.select("lang", "g", (F.col("n") - F.col("held")).alias("n")).where("n > 0")
    apart = taught.where(sets_limits(F.col("text"))).withColumnRenamed("lang", "taught")
    size = F.least(F.floor(F.log2(F.greatest("n_letters", F.lit(1)).cast("double"))), F.lit(COST_CLASS)).cast("int").alias("size")
    held = score(apart, model_rows(stored(rest, "langid-rest")), ["taught"], max_model).where("taught = lang_pred")
    limits = held.select("lang_pred", size, "cost_milli").groupBy("lang_pred", "size").agg(
        (F.percentile("cost_milli", 0.999) * margin).alias("limit"), F.count("*").alias("texts")
    )
    # one row per language and length class, from the nearest classes that hold enough texts
    wanted = limits.select("lang_pred").distinct().withColumn("want", F.explode(F.sequence(F.lit(0), F.lit(COST_CLASS))))
    nearer = Window.partitionBy("lang_pred", "want").orderBy(F.abs(F.col("want") - F.col("size")), "size").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum("texts").over(nearer), F.lit(0)) < MIN_CLASS
    limits = wanted.join(limits, "lang_pred").withColumn("taken", taken).where("taken")
    limits = limits.groupBy("lang_pred", F.col("want").alias("size")).agg(F.max("limit").alias("limit"))
    limits = stored(limits, "langid-limits")
    if limits.count() <= SMALL:
        limits = F.broadcast(limits)
    return scored.withColumn("size", size).join(limits, ["lang_pred", "size"], "left").select(
        F.col("id").alias(id_col),
        "lang_pred",
        "score",
        (F.col("cost_milli") / 1000).alias("cost"),
        ((F.col("lang_pred") == UNKNOWN) | F.coalesce(F.col("cost_milli") > F.col("limit"), F.lit(False))).alias("rejected"),
    )
