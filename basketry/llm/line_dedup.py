"""Line dedup with a segment-partition edit join.

A line goes when an equal line, or one within its edit budget, comes earlier:
lines are ordered by the smallest document id that holds them, then by their
digest; inside one document equal lines are ordered by position. The budget
depends on the shorter line: 0 edits below ``BUDGETS[0][0]`` characters, then as
listed there. Blank lines are never dropped. Exact copies are found by a
128-bit digest; near copies in three steps:

1. a line of length l and budget t is indexed by its t + 1 even segments; any
   line within t edits holds one of them unchanged, at one of the few places
   that the lengths and the segment's number allow. Each line emits the
   hashes of its own segments and of the substrings at those places for every
   length it may match. Lines that share a hash with a different line are
   *live*.
2. Live lines emit themselves under each of their hashes.
3. Under each hash the indexed lines are compared with the others: a bound
   from character counts first, then a banded bit-parallel edit distance. A
   line is done with its first earlier partner, so a group of n near copies
   gives n rows, not their pairs.

Scale: step 1 moves at most two line digests per hash and block of text, so a
frequent line or a template costs two rows per block; only live lines move as
text. Their digests go to the tasks when there are at most ``MAX_LIVE``, and
are joined otherwise. Lines under a hash beyond ``CELL`` are dealt into cells, each
line visiting the cells of the others, so no task holds an unbounded group. A
hash of more than ``REFINE`` cells (a template with many fillings) is refined
first: what remains of its lines without the shared segment is again within
the budget, so it is partitioned by the same rule, up to ``DEPTH`` times, and
only lines that share a further piece still meet.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import fresh_name, slices, stored, text_or_empty, utf8_values
from basketry.llm.textstats import BLANKS

BUDGETS = [(20, 1), (100, 2)]  # (least length, edits allowed)
BLOCK_CHARS = 1 << 22
MAX_LIVE = 4_000_000  # most digests of live lines sent to the tasks (8 bytes each)
CELL = 2048  # lines compared with each other in one cell
REFINE = 16  # a hash of more cells is parted by a further segment
DEPTH = 3  # times that a hash is parted so
NO_ID = (1 << 63) - 1  # a null id counts as later than every id


def edits_allowed(length: int) -> int:
    return max((t for least, t in BUDGETS if length >= least), default=0)


def segments(length: int, t: int) -> list[tuple[int, int]]:
    """(start, length) of ``t + 1`` even segments, the longer ones last."""
    n = t + 1
    short, longer = length // n, length % n
    sizes = [short] * (n - longer) + [short + 1] * longer
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).tolist()
    return list(zip(starts, sizes))


def places(length: int, other: int, t: int) -> Iterator[tuple[int, int, int, int]]:
    """(number, start, size, place) of the segments of a text of ``other`` characters in one of ``length``.

    If the two are within ``t`` edits, some segment stands unchanged at one of its places.
    """
    gap = length - other
    for i, (p, n) in enumerate(segments(other, t)):
        lo = max(0, p - i, p + gap - (t - i))
        hi = min(length - n, p + i, p + gap + (t - i))
        for s in range(lo, hi + 1):
            yield i, p, n, s


def signature_plan(length: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """((start, size, seed) of the index segments, the same of the probes) for a line of this length."""
    own = edits_allowed(length)
    index = [(p, n, length * 8 + i) for i, (p, n) in enumerate(segments(length, own))] if own else []
    probe = []
    for other in range(max(1, length - max(t for _, t in BUDGETS)), length + 1):
        t, gap = edits_allowed(other), length - other
        if not t or gap > t:
            continue
        probe += [(s, n, other * 8 + i) for i, p, n, s in places(length, other, t) if gap or s != p]
    return index, probe


_PLANS: dict[int, tuple] = {}


def signatures(line: str) -> tuple[list[int], int]:
    """(hashes, how many of them index the line; those come first)."""
    plan = _PLANS.get(len(line))
    if plan is None:
        if len(_PLANS) > 50_000:
            _PLANS.clear()
        index, probe = signature_plan(len(line))
        plan = _PLANS[len(line)] = [(4 * s, 4 * (s + n), seed) for s, n, seed in index + probe], len(index)
    raw, digest = line.encode("utf-32-le"), xxhash.xxh3_64_intdigest
    return [digest(raw[a:b], seed) for a, b, seed in plan[0]], plan[1]


def parted(sig: int, rest: str, gap: int, t: int, indexed: bool) -> Iterator[tuple[int, bool, str]]:
    """(hash, indexed, what remains) of ``rest``, which lines under ``sig`` have besides their shared segments.

    ``gap`` is how much longer the line is than those it probes for (0 for an
    indexed line, which probes for its own length).
    """
    seed = sig % (1 << 64)
    for i, p, n, s in places(len(rest), len(rest) - gap, t):
        piece = rest[s : s + n].encode("utf-32-le") + bytes([i])
        yield xxhash.xxh3_64_intdigest(piece, seed), indexed and s == p, rest[:s] + rest[s + n :]


def remainders(line: str, sig: int) -> Iterator[tuple[str, int, int, bool]]:
    """(what remains, gap, edits, indexed) for each place of ``line`` that gives the hash ``sig``."""
    index, probe = signature_plan(len(line))
    for k, (s, n, seed) in enumerate(index + probe):
        if xxhash.xxh3_64_intdigest(line[s : s + n].encode("utf-32-le"), seed) == sig % (1 << 64):
            other = seed // 8
            yield line[:s] + line[s + n :], len(line) - other, edits_allowed(other), k < len(index)


def within(a: str, b: str, t: int) -> bool:
    """Is the edit distance of two strings at most ``t``? Bit-parallel over a band of 2t + 1 rows."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > t:
        return False
    lo, most = 0, min(len(a), len(b))
    step = 64
    while lo < most and a[lo : lo + step] == b[lo : lo + step]:
        lo += step
    lo = min(lo, most)
    while lo < most and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < most - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    if not a or not b:
        return max(len(a), len(b)) <= t
    if len(a) > len(b):
        a, b = b, a
    # bit r of the vectors is row j - t + r of column j; rows up to 0 are equal, rows past the end match nothing
    width = 2 * t + 1
    full, middle, last = (1 << width) - 1, 1 << t, 1 << (width - 1)
    plus, minus = full & ~((1 << (t + 1)) - 1), 0
    diagonal = 0  # value at row j of column j
    for j, ch in enumerate(b, 1):
        first = j - t
        eq = 0
        for i in range(max(1, first), min(len(a), j + t) + 1):
            if a[i - 1] == ch:
                eq |= 1 << (i - first)
        plus, minus = (plus >> 1) | last, minus >> 1  # the window moves down one row
        same = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        up, down = minus | (full & ~(same | plus)), same & plus
        if not same & middle:
            diagonal += 1
            if diagonal > 2 * t:  # then every value of the band is over t
                return False
        up, down = ((up << 1) | 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(same | up)), up & same
    value = diagonal
    for row in range(len(b), len(a), -1):
        bit = 1 << (row - (len(b) - t))
        value += bool(minus & bit) - bool(plus & bit)
    return value <= t


def _seed_two(spark) -> int:
    """Seed of the second digest: Spark chains xxhash64 over its arguments."""
    return spark.range(1).select(F.xxhash64(F.lit(1)).alias("s")).first().s % (1 << 64)


def _keys(line: str, seed: int) -> tuple[int, int]:
    raw = line.encode()
    one, two = xxhash.xxh64_intdigest(raw, 42), xxhash.xxh64_intdigest(raw, seed)
    return one - ((one >> 63) << 64), two - ((two >> 63) << 64)


def has_word(line: str) -> bool:
    return bool(line.strip(" \t\n\x0b\x0c\r"))


def _line_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, int]]:
    """Line -> smallest id, for blocks of text; lines too short for an edit, and blank ones, are left out."""
    least = min(n for n, _ in BUDGETS) - max(t for _, t in BUDGETS)
    lines: dict[str, int] = {}
    size = 0
    for b in slices(batches):
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for line in text.split("\n"):
                if len(line) >= least and has_word(line) and lines.get(line, NO_ID + 1) > i:
                    lines[line] = i
            size += len(text)
            if size >= BLOCK_CHARS:
                yield lines
                lines, size = {}, 0
    if lines:
        yield lines


def _digest(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode(), 42)


def live_lines(texts: DataFrame) -> DataFrame:
    """(line): digests of the lines that share a hash with another line. ``texts`` has ``id`` and ``text``.

    Inside a block such lines are found at once; between blocks, from the
    smallest and the largest digest per hash that each block sends.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines in _line_blocks(batches):
            found = [signatures(line)[0] for line in lines]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            sig = np.fromiter((s for f in found for s in f), np.uint64, int(sizes.sum()))
            line = np.repeat(np.fromiter(map(_digest, lines), np.uint64, len(found)), sizes)
            if not len(sig):
                continue
            order = np.argsort(sig)
            sig, line = sig[order], line[order]
            first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
            lo, hi = np.minimum.reduceat(line, first), np.maximum.reduceat(line, first)
            met = lo != hi
            among = np.unique(line[np.repeat(met, np.diff(np.append(first, len(sig))))])
            # a line that met another in its own block needs no further proof: it goes on by itself
            keys = np.concatenate((sig[first], sig[first][met], among))
            values = np.concatenate((lo, hi[met], among))
            sure = np.zeros(len(keys), bool)
            sure[len(keys) - len(among) :] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(values.view(np.int64)), pa.array(sure)], names=["sig", "line", "sure"]
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by hash: the lines under a hash that more than one line has."""
        left = [np.zeros(0, np.int64)] * 3
        for b in batches:
            rows = [np.concatenate((o, b.column(i).to_numpy(zero_copy_only=False))) for i, o in enumerate(left)]
            # the last hash may go on in the next batch; its extremes say all about it
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            yield meeting([r[:cut] for r in rows])
            tail = [r[cut:] for r in rows]
            if len(tail[0]) > 4:
                yield meeting(tail)
                ends = [int(tail[1].argmin()), int(tail[1].argmax())]
                tail = [t[ends] for t in tail]
            left = tail
        yield meeting(left)

    def meeting(rows: list[np.ndarray]) -> pa.RecordBatch:
        sig, line, sure = rows
        if len(sig):
            first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
            met = np.minimum.reduceat(line, first) != np.maximum.reduceat(line, first)
            line = line[np.repeat(met, np.diff(np.append(first, len(sig)))) | sure.astype(bool)]
        return pa.RecordBatch.from_arrays([pa.array(np.unique(line))], names=["line"])

    rows = texts.mapInArrow(run, "sig long, line long, sure boolean").repartition("sig").sortWithinPartitions("sig")
    return rows.mapInArrow(meet, "line long").distinct()


def _candidates(texts: DataFrame, live: DataFrame, seed: int, max_live: int) -> DataFrame:
    """(sig, indexed, k1, k2, id, line) of every live line under each of its hashes."""
    spark = texts.sparkSession
    shared = None
    if live.count() <= max_live:
        shared = spark.sparkContext.broadcast(np.sort(live.toArrow().column(0).to_numpy()))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines in _line_blocks(batches):
            texts_here = list(lines)
            k1 = np.fromiter(map(_digest, texts_here), np.uint64, len(texts_here)).view(np.int64)
            if shared is not None:
                known = shared.value
                at = np.minimum(np.searchsorted(known, k1), max(len(known) - 1, 0))
                hit = np.flatnonzero(known[at] == k1).tolist() if len(known) else []
            else:
                hit = range(len(k1))
            for k in hit:
                line = texts_here[k]
                found, own = signatures(line)
                once: dict[int, bool] = {}
                for h, s in enumerate(found):  # index hashes come first
                    once.setdefault(s, h < own)
                yield line, lines[line], list(once), list(once.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for line, i, sigs, indexed in emit(batches):
            rows.append((np.array(sigs, np.uint64).view(np.int64).tolist(), indexed, *_keys(line, seed), i, line))
            size += len(line)
            if size > 1 << 20:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        names = ["sigs", "indexed", "k1", "k2", "id", "line"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    rows = texts.mapInArrow(run, "sigs array<long>, indexed array<boolean>, k1 long, k2 long, id long, line string")
    if shared is None:
        rows = rows.join(live.withColumnRenamed("line", "k1"), "k1", "left_semi")
    return rows


def _histograms(lines: list[str]) -> np.ndarray:
    """Character counts folded to 64 classes: an edit changes the sum of differences by at most 2."""
    out = np.zeros((len(lines), 64), np.int32)
    for i, line in enumerate(lines):
        out[i] = np.bincount(np.frombuffer(line.encode("utf-32-le"), np.uint32) & 63, minlength=64)
    return out


class _Cell:
    """The indexed lines of one cell in order; every line that has an earlier partner there is found once."""

    def __init__(self, cell: tuple[int, int]):
        self.cell = cell
        self.rows: list[tuple] = []  # (id, k1, k2, line), in order once closed
        self.closed = False
        self.last = None

    def add(self, row: tuple) -> None:
        if row[1:3] != self.last:  # rows of one line follow each other, its smallest id first
            self.last = row[1:3]
            self.rows.append(row)

    def close(self) -> list[tuple]:
        """Compare the indexed lines with each other."""
        if self.closed:
            return []
        self.closed, self.last, found = True, None, []
        self.rows.sort()
        self.keys = [r[:3] for r in self.rows]
        self.flagged = np.zeros(len(self.rows), bool)
        self.counts = _histograms([r[3] for r in self.rows]) if len(self.rows) > 2 else None
        for i in range(1, len(self.rows)):
            found += self._earlier(self.rows[i], i, i)
        return found

    def visit(self, row: tuple) -> list[tuple]:
        """A line that the cell does not own: its earlier partner here, and later lines whose partner it is."""
        if row[1:3] == self.last or not self.rows:
            return []
        self.last = row[1:3]
        at = bisect_left(self.keys, row[:3])
        if at < len(self.keys) and self.keys[at] == row[:3]:
            return []
        found = self._earlier(row, at, None)
        for i in self._possible(row[3], at, len(self.rows)):
            if not self.flagged[i] and self._near(row[3], self.rows[i][3]):
                self.flagged[i] = True
                found.append((*self.rows[i][1:3], *row[1:3]))
        return found

    def _earlier(self, row: tuple, upto: int, own: int | None) -> list[tuple]:
        for i in self._possible(row[3], 0, upto):
            if self._near(row[3], self.rows[i][3]):
                if own is not None:
                    self.flagged[own] = True
                return [(*row[1:3], *self.rows[i][1:3])]
        return []

    def _possible(self, line: str, lo: int, hi: int):
        if self.counts is None or hi - lo < 3:
            return range(lo, hi)
        gap = np.abs(self.counts[lo:hi] - _histograms([line])[0]).sum(axis=1)
        return (np.flatnonzero(gap <= 2 * max(t for _, t in BUDGETS)) + lo).tolist()

    @staticmethod
    def _near(a: str, b: str) -> bool:
        return a != b and within(a, b, edits_allowed(min(len(a), len(b))))


_PART = "sig long, indexed boolean, id long, k1 long, k2 long, line string, rest string, gap int, edits int"


def _refined(hot: DataFrame) -> DataFrame:
    """The rows of hot hashes under the hashes of a further segment; ``rest`` is null in rows that were never parted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in slices(batches):
            for sig, indexed, i, k1, k2, line, rest, gap, t in zip(*(c.to_pylist() for c in b.columns)):
                known = remainders(line, sig) if rest is None else [(rest, gap, t, indexed)]
                new = {(*part, g, e) for r, g, e, own in known for part in parted(sig, r, g, e, own)}
                for h, own, left, g, e in new:
                    rows.append((h - ((h >> 63) << 64), own, i, k1, k2, line, left, g, e))
                    size += len(line) + len(left)
                if size > 1 << 20:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 3, pa.string(), pa.string(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    names = [c.split()[0] for c in _PART.split(", ")]
    return hot.select(*names).mapInArrow(run, _PART)


def _dealt(rows: DataFrame, wide: DataFrame) -> DataFrame:
    """The rows of the hashes in ``wide``, once per cell of their hash."""
    return rows.join(wide, "sig").withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).select(
        "sig",
        "cell",
        (F.col("indexed") & (F.col("cell") == F.pmod("k1", "cells"))).alias("native"),
        "id",
        "k1",
        "k2",
        "line",
    )


def near_links(texts: DataFrame, max_live: int = MAX_LIVE, cell: int = CELL, refine: int = REFINE) -> DataFrame:
    """(k1, k2, keep1, keep2): digests of a line and of an earlier one within its edit budget.

    Every line that has an earlier line within its budget is listed, with at
    least one such line.
    """
    seed = _seed_two(texts.sparkSession)
    live = stored(live_lines(texts), "lines-live")
    lines = stored(_candidates(texts, live, seed, max_live), "lines-candidates")
    pairs = F.explode(F.arrays_zip(F.col("sigs").alias("sig"), F.col("indexed").alias("indexed")))
    rows = lines.select(pairs.alias("p"), "id", "k1", "k2", "line").select("p.*", "id", "k1", "k2", "line")
    parts = []
    for depth in range(DEPTH + 1):
        counts = rows.groupBy("sig").agg(F.count("*").alias("n"), F.bool_or("indexed").alias("indexed"))
        # hashes of a single row, or of probes alone, have no pair; large ones are dealt into cells
        wide = stored(
            counts.where("n > 1 and indexed").select("sig", F.ceil(F.col("n") / F.lit(cell)).cast("int").alias("cells")),
            "lines-hashes",
        )
        hot = F.col("cells") > refine
        if depth == DEPTH or wide.where(hot).isEmpty():
            parts.append(_dealt(rows, wide))
            break
        parts.append(_dealt(rows, wide.where(~hot)))
        found = rows.join(wide.where(hot).select("sig"), "sig")
        if depth == 0:
            found = found.select("*", *[F.lit(None).cast(k).alias(c) for c, k in (("rest", "string"), ("gap", "int"), ("edits", "int"))])
        rows = stored(_refined(found), "lines-parted")
    dealt = reduce(DataFrame.unionByName, parts)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by hash and cell, the cell's own lines first."""
        now, links = _Cell((0, -1)), set()

        def batch() -> pa.RecordBatch:
            columns = list(zip(*links)) if links else [[], [], [], []]
            links.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k1", "k2", "keep1", "keep2"])

        for b in batches:
            for sig, place, native, *row in zip(*(b.column(i).to_pylist() for i in range(7))):
                if (sig, place) != now.cell:
                    links.update(now.close())
                    now = _Cell((sig, place))
                if native:
                    now.add(tuple(row))
                else:
                    links.update(now.close())
                    links.update(now.visit(tuple(row)))
            yield batch()
        links.update(now.close())
        yield batch()

    ordered = dealt.repartition("sig", "cell").sortWithinPartitions("sig", "cell", F.col("native").desc(), "k1", "k2", "id")
    return ordered.mapInArrow(verify, "k1 long, k2 long, keep1 long, keep2 long").distinct()


def line_places(texts: DataFrame) -> DataFrame:
    """(id, doc, k1, k2): digests of the lines with a word, once per row of ``texts`` (id, text, doc)."""
    seed = _seed_two(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for b in slices(batches):
            ids, docs, one, two = [], [], [], []
            for i, text, d in zip(b.column(0).to_pylist(), utf8_values(b.column(1)), b.column(2).to_pylist()):
                lines = [x for x in dict.fromkeys(text.split(b"\n")) if x.strip(BLANKS)]
                ids += [i] * len(lines)
                docs += [d] * len(lines)
                one += [digest(x, 42) for x in lines]
                two += [digest(x, seed) for x in lines]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(docs, pa.int64()), *(pa.array(np.array(k, np.uint64).view(np.int64)) for k in (one, two))],
                names=["id", "doc", "k1", "k2"],
            )

    return texts.mapInArrow(run, "id long, doc long, k1 long, k2 long")


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    out: str = "lines",
    max_live: int = MAX_LIVE,
    cell: int = CELL,
    refine: int = REFINE,
) -> DataFrame:
    """``docs`` with the text rewritten, plus the struct ``out``: ``n_lines``, ``n_exact``, ``n_near`` dropped.

    ``n_lines`` counts lines with a word. Ids order the documents, so they
    must be integers; rows that share an id, or have none, count as one
    document (a null id as the last one) and keep the same lines. A null text
    stays null, blank lines and all other columns stay as they are; an
    existing column ``out`` is replaced; an empty table gives no rows. A
    document whose lines all go keeps its row, with an empty text.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    texts = docs.select(order.alias("id"), text_or_empty(text_col).alias("text"))
    near = stored(near_links(texts, max_live, cell, refine), "lines-near")
    # rows of one id and text have the same drops: a group holds one document, however many rows share an id
    doc = F.xxhash64(F.lit(9), text_or_empty(text_col))
    places = stored(line_places(texts.withColumn("doc", F.xxhash64(F.lit(9), F.col("text")))), "lines-places")
    exact = places.groupBy("k1", "k2").agg(F.min("id").alias("owner"), F.max("id").alias("last")).where("owner <> last")
    losers = near.select("k1", "k2", F.lit(True).alias("near")).distinct()
    gone = stored(exact.select("k1", "k2", "owner").join(losers, ["k1", "k2"], "full"), "lines-gone")
    hits = places.join(gone, ["k1", "k2"]).where("near or id <> owner")
    drops = hits.groupBy("id", "doc").agg(F.collect_set(F.struct("k1", "k2", F.coalesce("near", F.lit(False)).alias("near"))).alias("drops"))
    keep = [c for c in docs.columns if c.lower() != out.lower()]
    key, own, lost = (fresh_name([*keep, out], c) for c in ("_order", "_doc", "_drops"))
    drops = drops.withColumnsRenamed({"id": key, "doc": own, "drops": lost})
    joined = docs.select(*[F.col(f"`{c}`") for c in keep], order.alias(key), doc.alias(own)).join(drops, [key, own], "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in keep], lost)
    shape = "struct<n_lines:bigint,n_exact:bigint,n_near:bigint>"
    schema = joined.select(*[F.col(f"`{c}`") for c in keep]).withColumn(out, F.lit(None).cast(shape)).schema
    at = [c.lower() for c in keep].index(text_col.lower())
    seed = _seed_two(spark)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([(c, pa.int64()) for c in ("n_lines", "n_exact", "n_near")])
        for b in slices(batches):
            texts_out, counts = [], []
            for text, lost_here in zip(b.column(at).to_pylist(), b.column(len(keep)).to_pylist()):
                gone_here = {(d["k1"], d["k2"]): d["near"] for d in lost_here or ()}
                lines = (text or "").split("\n")
                if not gone_here and len(set(lines)) == len(lines):
                    texts_out.append(text)
                    counts.append({"n_lines": sum(map(has_word, lines)), "n_exact": 0, "n_near": 0})
                    continue
                kept, seen, n = [], set(), {"n_lines": 0, "n_exact": 0, "n_near": 0}
                for x in lines:
                    if has_word(x):
                        n["n_lines"] += 1
                        why = gone_here.get(_keys(x, seed)) if gone_here else None
                        if why is not None or x in seen:
                            n["n_near" if why else "n_exact"] += 1
                            continue
                        seen.add(x)
                    kept.append(x)
                texts_out.append(None if text is None else "\n".join(kept))
                counts.append(n)
            columns = list(b.columns[: len(keep)])
            columns[at] = pa.array(texts_out, b.column(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, kind)], names=[*keep, out])

    return joined.mapInArrow(rewrite, schema)
