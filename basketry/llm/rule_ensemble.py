"""Quality classifier: a sparse rule ensemble compiled into column expressions.

Statistics of the whole text are measured once. A random forest of shallow
trees is fitted on a bounded sample of the labelled rows (``max_train``, drawn
by a hash of the id); every path from a root to a node becomes a conjunctive
rule over the statistics; a lasso logistic regression over the rules leaves a
few with weights. The rules with weight are compiled into one Spark column, so
scoring is a projection without Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import fresh_name, slices, stored, text_or_empty, utf8_values
from basketry.llm.textstats import BLANKS, SYMBOLS, base_statistics

FEATURES = [
    "log_words", "mean_word", "symbol_share", "upper_share", "digit_share", "punct_share", "blank_share", "wide_share",
    "bang_share", "dup_line_share", "repeat_share", "distinct_share", "adjacent_share", "log_line", "byte_entropy",
]
MAX_TRAIN = 40_000  # most labelled rows that the trees and weights are fitted on

_CLASS = {
    "symbol_share": SYMBOLS,
    "upper_share": bytes(range(65, 91)),
    "digit_share": b"0123456789",
    "punct_share": b".,;:'\"()-",
    "blank_share": BLANKS,
    "wide_share": bytes(range(0x80, 0x100)),
    "bang_share": b"!?",
}
_MASK = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASS.items()}


def features(text: bytes) -> list[float]:
    """The statistics named in ``FEATURES``; all zero for a text without bytes."""
    if not text:
        return [0.0] * len(FEATURES)
    words = text.split()
    n_words, chars, _, dup, repeat = base_statistics(text)
    n = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    p = n[n > 0] / len(text)
    lines = text.count(b"\n") + 1
    pairs = sum(map(bytes.__eq__, words, words[1:]))
    share = {k: float(n[m].sum()) / len(text) for k, m in _MASK.items()}
    w = max(n_words, 1)
    own = {
        "log_words": float(np.log1p(n_words)),
        "mean_word": chars / w,
        **share,
        "dup_line_share": dup / lines,
        "repeat_share": repeat / w,
        "distinct_share": len(set(words)) / w,
        "adjacent_share": pairs / w,
        "log_line": float(np.log1p(len(text) / lines)),
        "byte_entropy": float(-(p * np.log2(p)).sum()),
    }
    return [own[f] for f in FEATURES]


def add_features(docs: DataFrame, keep: list[str], text_col: str = "text", out: str = "features") -> DataFrame:
    """``keep`` columns and ``out``: the statistics as an array of doubles."""
    text = fresh_name([*keep, out], "_text")
    given = docs.select(*[F.col(f"`{c}`") for c in keep], text_or_empty(text_col).alias(text))
    schema = given.select(*[F.col(f"`{c}`") for c in keep]).withColumn(out, F.lit(None).cast("array<double>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = [features(t) for t in utf8_values(b.column(len(keep)))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(keep)], pa.array(rows, pa.list_(pa.float64()))], names=[*keep, out]
            )

    return given.mapInArrow(run, schema)


Condition = tuple[int, str, float]  # feature, "<=" or ">", threshold


@dataclass(frozen=True)
class Ensemble:
    """intercept + sum of weights of the rules that hold, through the logistic function."""

    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def column(self, values: str = "features") -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, values), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        return [
            f"{weight:+.3f} if " + " and ".join(f"{FEATURES[f]} {op} {t:.4g}" for f, op, t in rule)
            for rule, weight in sorted(self.rules, key=lambda r: -abs(r[1]))
        ]


def holds(rule: tuple[Condition, ...], values: str = "features") -> Column:
    out = F.lit(True)
    for f, op, t in rule:
        c = F.col(values)[f]
        out = out & (c <= t if op == "<=" else c > t)
    return out


def tree_paths(debug: str) -> list[tuple[Condition, ...]]:
    """Every distinct path from a root to a node in a tree model's text form."""
    paths: dict[tuple[Condition, ...], None] = {}
    stack: list[Condition] = []
    for line in debug.splitlines():
        m = re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) ([-\d.eE]+)\)", line)
        if line.lstrip().startswith("Tree "):
            stack = []
        if not m:
            continue
        depth = len(line) - len(line.lstrip())
        stack = [s for s in stack if s[0] < depth] + [(depth, (int(m[1]), m[2], float(m[3])))]
        paths[tuple(sorted(_tightest([c for _, c in stack])))] = None
    return list(paths)


def _tightest(conditions: list[Condition]) -> list[Condition]:
    """One bound per feature and side."""
    out: dict[tuple[int, str], float] = {}
    for f, op, t in conditions:
        old = out.get((f, op))
        out[f, op] = t if old is None else (min(old, t) if op == "<=" else max(old, t))
    return [(f, op, t) for (f, op), t in out.items()]


def fit(train: DataFrame, trees: int = 16, depth: int = 3, penalty: float = 0.002, seed: int = 17) -> Ensemble:
    """Fit on rows of ``features`` and ``label`` (0 or 1). Without both labels the score is their share."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    found = train.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).first()
    if not found.n or found.ones in (0, found.n):
        share = 0.5 if not found.n else (found.ones + 1) / (found.n + 2)
        return Ensemble(float(np.log(share / (1 - share))), ())
    rows = train.select(array_to_vector("features").alias("x"), F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird",
        subsamplingRate=0.7, minInstancesPerNode=5, seed=seed,
    ).fit(rows)
    rules = tree_paths(forest.toDebugString)
    share = found.ones / found.n
    if not rules:
        return Ensemble(float(np.log(share / (1 - share))), ())
    marks = train.select(
        array_to_vector(F.array(*[holds(r).cast("double") for r in rules])).alias("x"), F.col("label").cast("double").alias("label")
    )
    weights = LogisticRegression(
        featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=60
    ).fit(marks)
    chosen = [(r, float(w)) for r, w in zip(rules, weights.coefficients.toArray()) if w]
    return Ensemble(float(weights.intercept), tuple(chosen))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_if: Column | None = None,
    threshold: float = 0.3,
    max_train: int = MAX_TRAIN,
) -> DataFrame:
    """One row per row of ``docs``: id, ``score`` and ``predicted`` (1 if score >= ``threshold``).

    ``labels`` has the id and a 0/1 label; null ids and null labels are not
    learnt from, nor are ids with two different labels. ``train_if`` (over the
    id column) limits the rows learnt from. At most about ``max_train``
    labelled rows are used, drawn by a hash of the id; the score uses the text
    alone. Null and empty texts get the score of all-zero statistics; null ids
    and repeated rows stay; other columns are ignored; an empty table gives no
    rows.
    """
    measured = stored(add_features(docs.select(id_col, text_col), [id_col], text_col), "rule-features")
    known = (
        labels.select(F.col(f"`{id_col}`").alias("_key"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where("_key is not null and label in (0, 1)")
        .groupBy("_key")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
    )
    rows = measured.where(F.lit(True) if train_if is None else train_if)
    rows = rows.join(known, F.col(id_col) == F.col("_key")).select(F.col("_key"), "features", "label")
    n = rows.count()
    million = 1_000_000
    share = million if n <= max_train else int(million * max_train / n)
    drawn = rows.where(F.pmod(F.xxhash64("_key", F.lit(5)), F.lit(million)) < share)
    # a bounded sample, so few partitions; sorted, so that the trees do not depend on the cluster
    drawn = stored(drawn.repartition(2, "_key").sortWithinPartitions("_key"), "rule-sample")
    model = fit(drawn)
    score = model.column()
    return measured.select(id_col, score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
