"""SimHash near-duplicates with exact Hamming links through a vantage-point tree.

Fingerprints: words are runs of non-blank characters, shingles are windows of
``shingle`` words joined by one blank (repeats count), a bit is set when over
half of the shingles' XXH64 hashes have it. Links: distinct fingerprints at
most ``max_bits`` apart.

The tree is fitted on a bounded sample (``SAMPLE`` fingerprints, a parameter)
and only steers the work: every distinct fingerprint is *native* to the one
leaf it falls into, and is sent as a *visitor* into the other branch of a node
only where the triangle inequality allows a partner there. A pair split by a
node needs one visit, so only the inner side travels: an inner point x with
d(x, vp) <= radius - max_bits has no partner outside. Below that node the
visitor follows both branches that the bounds leave open. A leaf compares its
natives with each other and with its visitors. A leaf with more than ``leaf``
natives grows a subtree of its own, fitted in its task on the first natives in
hash order, and its natives and visitors go on into that: the tree's depth
follows the data, and the driver never sees more than the first sample. Points
that ``ROUNDS`` such steps do not separate are cut into blocks, each native
visiting the later blocks, so no task holds more than one block and a stream of
visitors; nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import fresh_name, slices, stored, text_or_empty, utf8_values
from basketry.llm.components import connected_components

LEAF = 4096  # natives compared in one block
MAX_SENT = 4_000_000  # most row numbers sent to the tasks (8 bytes each)
SHARE = 1 / 8  # most of the distinct fingerprints that the driver's sample takes
GROWN = 10  # levels that an over-full leaf grows at a time
ROUNDS = 4
SAMPLE = 1 << 17  # most fingerprints that the tree is fitted on (1 MB on the driver)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))  # A-Z lower-cased


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a UTF-8 text; 0 for a text without words."""
    words = text.translate(LOWER).split()  # bytes.split() parts at space and \t-\r only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    lo, hi = starts[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(joined[a:b], 42) for a, b in zip(lo, hi)], np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        bits = np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def add_fingerprints(
    docs: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "fp", keep: list[str] | None = None
) -> DataFrame:
    """``keep`` columns (default all) plus ``out``: the fingerprint as a signed long.

    A null text counts as empty (fingerprint 0). An existing column named
    ``out`` is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != out.lower()]
    text = fresh_name(keep, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in utf8_values(b.column(len(keep)))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(keep)], pa.array(fps.view(np.int64))], names=[*keep, out]
            )

    given = docs.select(*[F.col(f"`{c}`") for c in keep], text_or_empty(text_col).alias(text))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).withColumn(out, F.lit(0).cast("long")).schema
    return given.mapInArrow(run, schema)


class Tree:
    """Vantage points and radii in heap order: children of node i are 2i+1 (inside) and 2i+2."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int = 7):
        self.depth = depth
        size = (1 << depth) - 1
        self.vp = np.zeros(size, np.uint64)
        self.radius = np.zeros(size, np.int16)
        rng = np.random.default_rng(seed)
        cells = {0: np.sort(sample)}
        for i in range(size):
            pts = cells.pop(i)
            if len(pts):
                # the candidate with the widest spread of distances splits best
                tries = rng.choice(pts, min(8, len(pts)), replace=False)
                probe = rng.choice(pts, min(512, len(pts)), replace=False)
                far = np.bitwise_count(probe[:, None] ^ tries[None, :]).astype(np.int16)
                self.vp[i] = tries[int(np.argmax(far.var(axis=0)))]
                d = np.bitwise_count(pts ^ self.vp[i]).astype(np.int16)
                cuts = np.unique(d)
                share = np.abs(np.searchsorted(np.sort(d), cuts, side="right") - len(d) / 2)
                self.radius[i] = cuts[int(np.argmin(share))]
                inner = d <= self.radius[i]
                cells[2 * i + 1], cells[2 * i + 2] = pts[inner], pts[~inner]
            else:
                cells[2 * i + 1] = cells[2 * i + 2] = pts

    def leaves(self, fps: np.ndarray) -> np.ndarray:
        """The leaf that each fingerprint is native to."""
        node = np.zeros(len(fps), np.int64)
        for _ in range(self.depth):
            inner = np.bitwise_count(fps ^ self.vp[node]) <= self.radius[node]
            node = 2 * node + np.where(inner, 1, 2)
        return node - ((1 << self.depth) - 1)

    def visits(self, fps: np.ndarray, bits: int, visitors: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``fps``, leaf) of every leaf beside its own that a fingerprint must see.

        ``visitors`` have no leaf of their own here: every leaf that they must see is listed.
        """
        every = np.arange(len(fps))
        who = every if visitors else every[:0]
        node = np.zeros(len(who), np.int64)
        if visitors:
            fps_native, every = fps[:0], every[:0]
        else:
            fps_native = fps
        native = np.zeros(len(fps_native), np.int64)
        for _ in range(self.depth):
            d, r = np.bitwise_count(fps[who] ^ self.vp[node]).astype(np.int16), self.radius[node]
            go_in, go_out = d <= r + bits, d > r - bits
            d0, r0 = np.bitwise_count(fps_native ^ self.vp[native]).astype(np.int16), self.radius[native]
            over = (d0 <= r0) & (d0 > r0 - bits)
            who, node = (
                np.concatenate((who[go_in], who[go_out], every[over])),
                np.concatenate((2 * node[go_in] + 1, 2 * node[go_out] + 2, 2 * native[over] + 2)),
            )
            native = 2 * native + np.where(d0 <= r0, 1, 2)
        return who, node - ((1 << self.depth) - 1)


def _pairs(natives: np.ndarray, others: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All (native, other) pairs at most ``bits`` apart, pruned by the distance to one pivot."""
    found_a, found_b = [], []
    if len(natives) and len(others):
        pivot = natives[0]
        dn, do = np.bitwise_count(natives ^ pivot), np.bitwise_count(others ^ pivot)
        natives, dn = natives[np.argsort(dn, kind="stable")], np.sort(dn)
        for d in np.unique(do):
            lo = np.searchsorted(dn, max(int(d) - bits, 0), side="left")
            hi = np.searchsorted(dn, int(d) + bits, side="right")
            ring, near = others[do == d], natives[lo:hi]
            for at in range(0, len(ring), 256):
                i, j = np.nonzero(np.bitwise_count(ring[at : at + 256, None] ^ near[None, :]) <= bits)
                found_a.append(near[j])
                found_b.append(ring[at + i])
    if not found_a:
        return natives[:0], others[:0]
    return np.concatenate(found_a), np.concatenate(found_b)


PLACED = "leaf long, visitor boolean, fp long"


def placed_rows(leaf: np.ndarray, natives: int, fps: np.ndarray) -> pa.RecordBatch:
    """Rows of ``PLACED``: the natives come first."""
    visitor = np.arange(len(leaf)) >= natives
    return pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(visitor), pa.array(fps.view(np.int64))], names=["leaf", "visitor", "fp"])


def over_full(placed: DataFrame, leaf: int) -> DataFrame:
    """(leaf, n) of the leaves with more than ``leaf`` natives."""
    return placed.where("not visitor").groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > leaf)


def grow(leaf: int, bits: int):
    """A task function: rows come sorted by leaf, natives first in hash order; each leaf becomes a subtree,
    no deeper than its number of natives (``n``) needs: every level sends some visitors both ways."""
    wanted = max(leaf, 1 << 14)  # natives that a subtree is fitted on, and held until then

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree, held, count, size = None, None, [], 0, 0

        def routed(x: np.ndarray, visitors: bool) -> pa.RecordBatch:
            who, where = tree.visits(x, bits, visitors)
            own = np.zeros(0, np.int64) if visitors else tree.leaves(x)
            natives = x[:0] if visitors else x
            return placed_rows(now * (1 << GROWN) + np.concatenate((own, where)), len(natives), np.concatenate((natives, x[who])))

        def fit() -> Iterator[pa.RecordBatch]:
            nonlocal tree, held, count
            x = np.concatenate(held) if held else np.zeros(0, np.uint64)
            held, count = [], 0
            needed = int(np.ceil(np.log2(max(2.0, size / leaf))))
            tree = Tree(x, max(1, min(GROWN, needed, int(np.log2(max(2, len(x) / 16))))))
            yield routed(x, False)

        for b in batches:
            at, visitor, x, n = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            x = x.view(np.uint64)
            cuts = np.flatnonzero(np.diff(at)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(at)]):
                if lo == hi:
                    continue
                if at[lo] != now:
                    if held:
                        yield from fit()
                    now, tree, size = int(at[lo]), None, int(n[lo])
                own, seen = x[lo:hi][~visitor[lo:hi]], x[lo:hi][visitor[lo:hi]]
                if len(own):
                    if tree is None:
                        held.append(own)
                        count += len(own)
                        if count >= wanted:
                            yield from fit()
                    else:
                        yield routed(own, False)
                if len(seen):
                    if tree is None:
                        yield from fit()
                    yield routed(seen, True)
        if held:
            yield from fit()

    return run


def hamming_links(
    fps: DataFrame, col: str = "fp", max_bits: int = 2, leaf: int = LEAF, sample: int = SAMPLE
) -> DataFrame:
    """(src, dst) links between different fingerprints at most ``max_bits`` apart.

    ``fps`` holds signed longs; nulls are ignored and repeats count once. Every
    link appears once as src < dst. An empty table gives no rows.
    """
    spark = fps.sparkSession
    one = stored(fps.select(F.col(col).cast("long").alias("fp")).where("fp is not null").distinct(), "simhash-fps")
    total = one.count()
    if total <= 1:
        return spark.createDataFrame([], "src long, dst long")
    depth = max(0, min(int(np.ceil(np.log2(max(1.0, total / leaf)))), int(np.log2(sample / 16))))
    share = min(SHARE, sample / total)
    # a uniform sample by a hash of the value: the same rows on every run
    drawn = one.where(F.pmod(F.xxhash64(F.col("fp"), F.lit(11)), F.lit(1 << 20)) < int(np.ceil(share * (1 << 20))))
    pts = np.array([r.fp for r in drawn.limit(sample * 2).collect()] if depth else [], np.int64).view(np.uint64)
    tree = Tree(pts, depth)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            own = tree.leaves(x)
            who, where = tree.visits(x, max_bits)
            yield placed_rows(np.concatenate((own, where)), len(x), np.concatenate((x, x[who])))

    placed = stored(one.mapInArrow(place, PLACED), "simhash-placed")
    for _ in range(ROUNDS):
        full = stored(over_full(placed, leaf), "simhash-full")
        if full.isEmpty():
            break
        rest = placed.join(full, "leaf", "left_anti").select((F.col("leaf") * (1 << GROWN)).alias("leaf"), "visitor", "fp")
        grown = placed.join(full, "leaf").select("leaf", "visitor", "fp", "n")
        ordered = grown.repartition("leaf").sortWithinPartitions("leaf", "visitor", F.xxhash64("fp", F.lit(3)))
        placed = stored(rest.unionByName(ordered.mapInArrow(grow(leaf, max_bits), PLACED)), "simhash-placed")
    # blocks of the leaves that still hold more than ``leaf`` natives
    blocks = over_full(placed, leaf).select("leaf", F.ceil(F.col("n") / leaf).cast("long").alias("blocks"))
    blocks = stored(blocks, "simhash-blocks")
    big = not blocks.isEmpty()

    if big:
        joined = placed.join(blocks, "leaf", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        own = F.pmod(F.xxhash64("fp", F.lit(17)), F.col("blocks"))
        # visitors see every block, natives their own and, as visitors, the later ones
        first = F.when(F.col("visitor"), F.lit(0)).otherwise(own)
        each = joined.withColumn("block", F.explode(F.sequence(first, F.col("blocks") - 1)))
        visits = F.col("visitor") | (F.col("block") > own)
        cells = each.select(F.xxhash64("leaf", "block").alias("cell"), visits.alias("visitor"), "fp")
    else:
        cells = placed.withColumnRenamed("leaf", "cell")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell, natives first: keep the natives of one cell, stream its visitors."""
        cell, natives = None, np.zeros(0, np.uint64)
        for b in batches:
            at, visitor, x = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            x = x.view(np.uint64)
            out = []
            cuts = np.flatnonzero(np.diff(at)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(at)]):
                if lo == hi:
                    continue
                if at[lo] != cell:
                    cell, natives = at[lo], np.zeros(0, np.uint64)
                own, vis = x[lo:hi][~visitor[lo:hi]], x[lo:hi][visitor[lo:hi]]
                if len(own):
                    out += [_pairs(own, own, max_bits), _pairs(natives, own, max_bits)]
                    natives = np.concatenate((natives, own))
                out.append(_pairs(natives, vis, max_bits))
            a = np.concatenate([p[0] for p in out] or [natives[:0]]).view(np.int64)
            c = np.concatenate([p[1] for p in out] or [natives[:0]]).view(np.int64)
            keep = a != c
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, c)[keep]), pa.array(np.maximum(a, c)[keep])], names=["src", "dst"]
            )

    dealt = cells.repartition("cell").sortWithinPartitions("cell", "visitor")
    return dealt.mapInArrow(compare, "src long, dst long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    leaf: int = LEAF,
) -> DataFrame:
    """One row per row of ``docs``: id, ``fp`` (signed long) and ``component_id``.

    ``component_id`` is the smallest id among all rows whose fingerprints are
    connected by links. Rows with a null id belong to their component but do
    not name it (a component of such rows only has a null ``component_id``).
    Repeated rows stay; null and empty texts share fingerprint 0; an empty
    table gives an empty result.
    """
    ids = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    marked = stored(add_fingerprints(ids, "text", shingle, keep=["id"]), "simhash-docs")
    links = hamming_links(marked, "fp", max_bits, leaf)
    roots = connected_components(links)
    first = marked.groupBy("fp").agg(F.min("id").alias("first"))
    own = first.join(roots, first.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    own = stored(own, "simhash-roots")
    smallest = own.groupBy("root").agg(F.min("first").alias("component_id"))
    named = own.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    leaf: int = LEAF,
    max_sent: int = MAX_SENT,
) -> DataFrame:
    """One row of each component stays, with all its columns: that of the smallest id.

    A null id counts as later than all ids. Of rows that share the smallest id
    the one with the smallest digest of all columns stays; of equal rows, one.

    The rows are stored once with a row number; everything is decided on
    (fingerprint, id, digest, row). The numbers of the rows that go are sent to
    the tasks when there are at most ``max_sent``, and joined otherwise.
    """
    columns = docs.columns
    row = fresh_name(columns, "_row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    keys = rows.select(
        F.col(row).alias("row"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit((1 << 63) - 1)).alias("id"),
        F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("digest"),
        F.col(f"`{text_col}`").alias("text"),
    )
    keys = stored(add_fingerprints(keys, "text", shingle, keep=["row", "id", "digest"]), "simhash-keys")
    roots = connected_components(hamming_links(keys.select("fp"), "fp", max_bits, leaf))
    # a component is decided among one row per fingerprint, so a large group of copies is one row here
    first = keys.groupBy("fp").agg(F.min(F.struct("id", "digest", "row")).alias("first"))
    first = first.join(roots, first.fp == roots.node, "left").select("first", F.coalesce("root", "fp").alias("root"))
    picks = first.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    gone = stored(keys.select(F.col("row").alias(row)).join(picks, row, "left_anti"), "simhash-gone")
    if gone.count() <= max_sent:
        gone = F.broadcast(gone)
    return rows.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in columns])
