"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may be found with up to k = floor(m * rate) edits. Cut
into k + 1 pieces, at least one piece is in the text unchanged, so one
Aho-Corasick pass over a text finds every place where an item can be. Each
place is then verified: Myers' bit-parallel algorithm gives the smallest edit
distance of the whole item to any part of the text around the piece. Case and
the form of white space are not compared.

Scale: documents are scanned where they are read, without a shuffle. The items
are a stated query set: they are dealt into blocks of at most ``BLOCK_CHARS``
characters, and each block is matched against all documents in a job of its own
whose finds are stored, so what travels to the executors, and what a task holds,
is one block whatever the size of the benchmark.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import fresh_name, slices, stored, text_or_empty

RATE = 0.08  # edits allowed per character of an item
BLOCK_CHARS = 8_000_000  # most characters of items matched in one pass


def normalise(text: str) -> str:
    """Lower case, every run of white space one blank, none at the ends."""
    return " ".join(text.lower().split())


def budget(length: int, rate: float = RATE) -> int:
    return int(length * rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): ``k + 1`` pieces of nearly equal length that cover the item."""
    n, parts = len(item), k + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_match(pattern: str, text: str, k: int, masks: dict[str, int] | None = None) -> int | None:
    """Smallest edit distance of ``pattern`` to any part of ``text``, or None if it is over ``k`` (Myers 1999)."""
    m = len(pattern)
    if masks is None:
        masks = symbol_masks(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for ch in text:
        eq = masks.get(ch, 0)
        x = eq | minus
        diag = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(diag | plus))
        down = plus & diag
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best = score
        up = (up << 1) & full  # a match may start anywhere: the first row stays zero
        down = (down << 1) & full
        plus = down | (full & ~(x | up))
        minus = up & x
    return best if best <= k else None


def symbol_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, ch in enumerate(pattern):
        masks[ch] |= 1 << i
    return dict(masks)


class Matcher:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = {}
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            k = budget(len(text), rate)
            self.items[item_id] = (text, k, symbol_masks(text))
            for at, piece in pieces(text, k):
                owners[piece].append((item_id, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in owners.items():
            self.automaton.add_word(piece, (len(piece), places))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, int]:
        """Items in a normalised text: id -> smallest edit distance."""
        starts: dict[int, set[int]] = defaultdict(set)
        if self.items:
            for end, (length, places) in self.automaton.iter(text):
                for item_id, at in places:
                    starts[item_id].add(end + 1 - length - at)
        found = {}
        for item_id, places in starts.items():
            pattern, k, masks = self.items[item_id]
            # neighbouring places share one window
            lo = hi = None
            windows = []
            for s in sorted(places):
                a, b = max(0, s - k), s + len(pattern) + k
                if lo is not None and a <= hi:
                    hi = b
                else:
                    if lo is not None:
                        windows.append((lo, hi))
                    lo, hi = a, b
            windows.append((lo, hi))
            best = [d for a, b in windows if (d := best_match(pattern, text[a:b], k, masks)) is not None]
            if best:
                found[item_id] = min(best)
        return found


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks; items without text and null ids are left out, equal ids each count."""
    own = items.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")
    )
    total = own.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // block_chars)
    for b in range(blocks):
        mine = own.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        yield [(r.id, t) for r in mine if (t := normalise(r.text))]


def find_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
    out: str = "matches",
) -> DataFrame:
    """``docs`` plus ``out``: an array of (item, distance), by item id; empty where no item is found.

    Null and empty texts hold no item; items with null or blank text, or a
    null id, are ignored; an existing column ``out`` is replaced; an empty
    table gives no rows. An item id that occurs with several texts is found
    when any of them is.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c.lower() != out.lower()]
    kind = "array<struct<item:bigint,distance:int>>"
    blocks = item_blocks(items, item_id, item_text, block_chars)
    block = next(blocks, [])
    more = next(blocks, None)
    if more is None:  # one block: the finds come with the documents, in one pass
        return _match_block(docs.select(*[F.col(f"`{c}`") for c in keep]), spark.sparkContext.broadcast((block, rate)), keep, text_col, out, kind)
    row, text = fresh_name([*keep, out], "_row"), fresh_name([*keep, out], "_text")
    rows = stored(docs.select(*[F.col(f"`{c}`") for c in keep]).withColumn(row, F.monotonically_increasing_id()), "decontaminate-rows")
    texts = rows.select(row, F.col(f"`{text_col}`").alias(text))
    found = None
    while block is not None:
        shared = spark.sparkContext.broadcast((block, rate))
        hits = _match_block(texts, shared, [row, text], text, out, kind).where(F.size(out) > 0).select(row, F.explode(out).alias("m"))
        hits = stored(hits.select(row, "m.item", "m.distance"), "decontaminate-hits")
        found = hits if found is None else found.unionAll(hits)
        shared.unpersist()
        block, more = more, next(blocks, None)
    # an id in two blocks: the smaller distance stays; a document's finds are at most the items
    best = found.groupBy(row, "item").agg(F.min("distance").alias("distance"))
    best = best.groupBy(row).agg(F.sort_array(F.collect_list(F.struct("item", "distance"))).alias(out))
    joined = rows.join(best, row, "left")
    return joined.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{out}`"), F.array().cast(kind)).alias(out))


def _match_block(docs: DataFrame, shared, keep: list[str], text_col: str, out: str, kind: str) -> DataFrame:
    """``keep`` columns plus ``out``: finds of one block of items, by item id."""
    text = fresh_name([*keep, out], "_own_text")
    given = docs.select(*[F.col(f"`{c}`") for c in keep], text_or_empty(text_col).alias(text))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).withColumn(out, F.lit(None).cast(kind)).schema
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rate = shared.value
        # one matcher entry per text: several texts of an id are told apart by position
        matcher = Matcher(list(enumerate(t for _, t in block)), rate)
        arrow = pa.list_(pa.struct([("item", pa.int64()), ("distance", pa.int32())]))
        for b in slices(batches):
            rows = []
            for t in b.column(width).to_pylist():
                best: dict[int, int] = {}
                for k, d in matcher.find(normalise(t)).items():
                    best[block[k][0]] = min(d, best.get(block[k][0], d))
                rows.append([{"item": i, "distance": d} for i, d in sorted(best.items())])
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(rows, arrow)], names=[*keep, out])

    return given.mapInArrow(run, schema)


def contaminated(matches: str = "matches") -> Column:
    return F.size(matches) > 0
