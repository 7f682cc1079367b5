"""Conversation prefix trie as a burst trie: suffix containers under trie heads.

A turn is a 128-bit digest of role and text, made where the text is read;
nothing else of the text moves. A conversation is cut into blocks of ``BLOCK``
turns, so no row grows with it; a block starts at a *forced head*, named by a
digest of everything before it. Equal blocks after equal beginnings are one
row with a count, however many copies there are.

* Containers. All blocks with one beginning lie in one container under that
  trie head. A container with more than ``LIMIT`` turns is burst: the turns that
  all its sequences share become trie heads at once, then each sequence moves
  to the container of its next turn id. This repeats while a container is
  oversized; every round at least separates two sequences, so the rounds follow
  the branching of the data, not its depth.
* Sweep. The remaining containers are dealt to tasks, sorted, and swept into
  nodes: neighbours in sorted order share all nodes up to their common prefix.
* Sums. Counts, leaves and savings add up inside a container during the sweep,
  and over the heads by pointer doubling, in rounds that follow the logarithm of
  the number of heads above one another. Containers that hold the beginning of
  further blocks are swept a second time, with those sums.

Scale: turns are numbered by ranges of (conversation, turn), so a conversation
with a third of all rows is spread like any other; a task holds one container at
a time. The digest of a node's ends is one stream by nature: ids are sorted and
joined into texts range by range, and only those texts meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import number_rows, stored

BLOCK = 512  # turns in one row
LIMIT = 100_000  # turns in a container that is not burst (24 bytes each)
ENDS = 4096  # ids in one text of the ends digest
SALTS = 32  # pieces of a burst container when its heads are joined
MAX_SENT = 10_000  # most burst containers whose heads are sent to the tasks (up to 30 kB each, mostly under 100 bytes)
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = "conv long, depth long, pconv long, n long, children long, leaves long, saved long, ends string"
ITEM = ["c", "depth", "parent", "pconv", "last", "ids", "sizes", "n", "conv", "ends", "next", "forced"]


def short_digest(*parts: Column) -> Column:
    """The first 16 bytes of the SHA-256 of the parts together."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turn_digests(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, id, size): digest of role and text, and the text's UTF-8 bytes. Rows without a conversation id go."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    head = F.concat(F.octet_length(role).cast("string"), F.lit(":"))
    return turns.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        short_digest(head.cast("binary"), role.cast("binary"), text.cast("binary")).alias("id"),
        F.octet_length(text).cast("long").alias("size"),
    )


def number_turns(digests: DataFrame) -> DataFrame:
    """(conv, pos, id, size): turns by number (null first), equal numbers by digest, counted from 0."""
    return number_rows(digests, "conv", ["turn", "id"], "pos", "trie-turns").select("conv", "pos", "id", "size")


def fork(numbered: DataFrame, head: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt from another's beginning: (turns, conversations).

    ``head`` and ``base`` are columns over ``conv``: each conversation takes the
    first ``head`` turns of conversation ``base``, then its own turns after its
    first ``head``.
    """
    numbered = stored(numbered, "trie-numbered")
    convs = numbered.groupBy("conv").agg(F.count("*").alias("n")).select("conv", "n", head.alias("head"), base.alias("base"))
    convs = stored(convs, "trie-convs")
    most = convs.agg(F.max("head")).first()[0] or 0
    first = numbered.where(F.col("pos") < most).withColumnRenamed("conv", "base")
    taken = convs.select("conv", "head", "base").join(first, "base").where("pos < head").select("conv", "pos", "id", "size")
    lengths = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    shift = convs.join(lengths, "base", "left").select(
        "conv", "head", (F.least("head", F.coalesce("n_base", F.lit(0))) - F.col("head")).alias("shift")
    )
    own = numbered.join(shift, "conv").where("pos >= head").select("conv", (F.col("pos") + F.col("shift")).alias("pos"), "id", "size")
    return taken.unionByName(own), convs.select("conv")


def _beginnings(blocks: DataFrame, fan: int) -> DataFrame:
    """(conv, b, key): digest of all blocks before block ``b``; ``blocks`` has (conv, b, digest) for b from 0 on."""
    root = F.lit(b"").cast("binary")
    if (blocks.agg(F.max("b")).first()[0] or 0) == 0:
        return blocks.select("conv", "b", root.alias("key"))
    up = F.floor(F.col("b") / fan).cast("long")
    groups = blocks.groupBy("conv", up.alias("u")).agg(F.sort_array(F.collect_list(F.struct("b", "digest"))).alias("some"))
    groups = stored(groups.withColumn("digest", short_digest(F.reduce("some", root, lambda s, x: F.concat(s, x["digest"])))), "trie-groups")
    above = _beginnings(groups.select("conv", F.col("u").alias("b"), "digest"), fan).withColumnRenamed("b", "u")

    def chain(s: Column, x: Column) -> Column:
        return F.concat(s, F.array(short_digest(F.element_at(s, -1), x["digest"])))

    keys = F.reduce("some", F.array("key"), chain)
    each = F.explode(F.arrays_zip(F.col("some.b").alias("b"), F.slice(keys, 1, F.size("some")).alias("key")))
    joined = groups.join(above, ["conv", "u"])
    return joined.select("conv", each.alias("e")).select("conv", "e.b", "e.key")


def sequences(turns: DataFrame, convs: DataFrame, block: int, fan: int) -> DataFrame:
    """One row per distinct block: the items of the trie, in the containers of their beginnings."""
    b = F.floor(F.col("pos") / block).cast("long")
    some = turns.groupBy("conv", b.alias("b")).agg(F.sort_array(F.collect_list(F.struct("pos", "id", "size"))).alias("some"))
    some = some.select("conv", "b", F.col("some.id").alias("ids"), F.col("some.size").alias("sizes"))
    # the last block is never full: it may be empty, as is that of a conversation without turns
    last = some.groupBy("conv").agg(F.max_by("b", "b").alias("b"), F.max_by(F.size("ids"), "b").alias("size"))
    extra = convs.join(last, "conv", "left").where("b is null or size = " + str(block)).select(
        "conv",
        F.coalesce(F.col("b") + 1, F.lit(0)).alias("b"),
        F.array().cast("array<binary>").alias("ids"),
        F.array().cast("array<long>").alias("sizes"),
    )
    blocks = some.unionByName(extra).withColumn("digest", short_digest(F.reduce("ids", F.lit(b"").cast("binary"), lambda s, x: F.concat(s, x))))
    blocks = stored(blocks, "trie-blocks")
    keys = stored(_beginnings(blocks.select("conv", "b", "digest"), fan), "trie-keys")
    after = keys.select("conv", (F.col("b") - 1).alias("b"), F.col("key").alias("next"))
    rows = blocks.join(keys, ["conv", "b"]).join(after, ["conv", "b"], "left")
    rows = rows.withColumn("key", F.when(F.col("b") > 0, F.col("key")).otherwise(F.lit(b"").cast("binary")))
    rows = stored(rows.withColumn("item", short_digest("key", F.lit(b"|").cast("binary"), "digest")), "trie-rows")
    ends = ends_digests(rows.where("next is null").select("item", "conv"))
    items = rows.groupBy("item").agg(
        F.first("key").alias("c"),
        F.first("b").alias("b"),
        F.first("ids").alias("ids"),
        F.first("sizes").alias("sizes"),
        F.first("next").alias("next"),
        F.count("*").alias("n"),
        F.min("conv").alias("conv"),
    )
    none = F.lit(None)
    return items.join(ends, "item", "left").select(
        "c", (F.col("b") * block).alias("depth"), none.cast("binary").alias("parent"), none.cast("long").alias("pconv"),
        F.lit(0).cast("long").alias("last"), "ids", "sizes", "n", "conv", "ends", "next", (F.col("b") > 0).alias("forced"),
    )


def ends_digests(rows: DataFrame) -> DataFrame:
    """(item, ends): SHA-256 of the ascending decimal ids of each item, joined by commas. ``rows`` has (item, conv)."""

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows to texts of up to ``ENDS`` ids."""
        item, ids = None, []

        def text() -> pa.RecordBatch:
            columns = [pa.array([item], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])]
            return pa.RecordBatch.from_arrays(columns, names=["item", "first", "text"])

        for b in batches:
            for i, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (i != item or len(ids) == ENDS):
                    yield text()
                    ids = []
                item = i
                ids.append(conv)
        if ids:
            yield text()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, state = None, None
        for b in batches:
            done = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i == item:
                    state.update(b"," + text.encode())
                else:
                    if state:
                        done.append((item, state.hexdigest()))
                    item, state = i, hashlib.sha256(text.encode())
            yield _batch(done)
        yield _batch([(item, state.hexdigest())] if state else [])

    def _batch(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["item", "ends"])

    texts = rows.repartitionByRange("item", "conv").sortWithinPartitions("item", "conv").mapInArrow(join_ids, "item binary, first long, text string")
    ordered = texts.repartition("item").sortWithinPartitions("item", "first").select("item", "text")
    return ordered.mapInArrow(digest, "item binary, ends string")


def burst(items: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """(items in containers of at most ``limit`` turns, trie heads above them)."""
    settled, heads = [], []
    items = stored(items, "trie-items")
    load = F.sum(F.size("ids") + 1)
    while True:
        large = items.groupBy("c").agg(load.alias("load"), F.count("*").alias("rows")).where((F.col("load") > limit) & (F.col("rows") > 1))
        large = stored(large.select("c"), "trie-large")
        n_large = large.count()
        if not n_large:
            break
        inside = _with_heads(items, large, n_large)
        shared = F.reduce(
            F.zip_with("lo", "hi", lambda x, y: x.eqNullSafe(y)),
            F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
            lambda s, same: F.struct((s["n"] + (s["on"] & same).cast("int")).alias("n"), (s["on"] & same).alias("on")),
        )["n"]
        chain = lambda s, x: F.concat(s, F.array(short_digest(F.element_at(s, -1), x)))
        own = F.struct("parent", "pconv", "last", "depth", "forced")
        tops = (
            inside.groupBy("c")
            .agg(F.min("ids").alias("lo"), F.max("ids").alias("hi"), F.sum("n").alias("total"), F.min("conv").alias("least"), F.first(own).alias("own"))
            .withColumn("shared", shared)
            .withColumn("keys", F.reduce(F.slice("lo", 1, F.col("shared")), F.array("c"), chain))
            .select("c", "shared", "keys", "total", "least", "own")
        )
        tops = stored(tops, "trie-tops")
        joined = _with_heads(items, tops, n_large)
        at = F.col("shared") + 1
        ended = joined.where(F.size("ids") == F.col("shared")).select("c", F.col("ends").alias("own_ends"))
        moved = joined.where(F.size("ids") > F.col("shared")).select(
            short_digest(F.element_at("keys", -1), F.element_at("ids", at)).alias("c"),
            (F.col("depth") + at).alias("depth"),
            F.element_at("keys", -1).alias("parent"),
            F.col("least").alias("pconv"),
            F.element_at("sizes", at).alias("last"),
            F.slice("ids", at + 1, F.size("ids")).alias("ids"),
            F.slice("sizes", at + 1, F.size("sizes")).alias("sizes"),
            "n", "conv", "ends", "next", F.lit(False).alias("forced"), F.col("c").alias("from"),
        )
        moved = stored(moved, "trie-moved")
        kinds = moved.groupBy("from").agg(F.count_distinct("c").alias("kinds"))
        # sizes of the shared turns, from the one sequence that is sorted first
        spans = joined.groupBy("c").agg(F.min_by("sizes", "ids").alias("spans"))
        made = tops.join(ended, "c", "left").join(spans, "c").join(kinds.withColumnRenamed("from", "c"), "c", "left")
        each = made.select("*", F.posexplode("keys").alias("k", "key"))
        end = F.col("k") == F.col("shared")
        heads.append(
            stored(
                each.select(
                    "key",
                    F.when(F.col("k") > 0, F.get("keys", F.col("k") - 1)).otherwise(F.col("own.parent")).alias("parent"),
                    F.when(F.col("k") > 0, F.col("least")).otherwise(F.col("own.pconv")).alias("pconv"),
                    F.when(F.col("k") > 0, F.get("spans", F.col("k") - 1)).otherwise(F.col("own.last")).alias("last"),
                    (F.col("own.depth") + F.col("k")).alias("depth"),
                    F.col("least").alias("conv"),
                    F.col("total").alias("n"),
                    F.when(end, F.coalesce("kinds", F.lit(0))).otherwise(F.lit(1)).cast("long").alias("children"),
                    F.lit(0).cast("long").alias("leaves"),
                    F.lit(0).cast("long").alias("saved"),
                    F.when(end, F.col("own_ends")).alias("ends"),
                    (F.col("own.forced") & (F.col("k") == 0)).alias("forced"),
                ),
                "trie-heads",
            )
        )
        settled.append(items.join(large, "c", "left_anti"))
        items = moved.select(*ITEM)
    settled.append(items)
    return reduce(DataFrame.unionByName, settled), reduce(DataFrame.unionByName, heads) if heads else None


def _with_heads(items: DataFrame, few: DataFrame, n: int) -> DataFrame:
    """``items`` joined to one row per burst container: sent to the tasks while few, else joined by salted pieces."""
    if n <= MAX_SENT:
        return items.join(F.broadcast(few), "c")
    salt = F.pmod(F.xxhash64("ids", "conv"), F.lit(SALTS)).cast("int")
    copies = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return items.withColumn("salt", salt).join(copies, ["c", "salt"]).drop("salt")


SWEPT = f"kind int, key binary, parent binary, last long, forced boolean, {NODE}"


def sweep_container(key: bytes, top: tuple, items: list[tuple], known: dict[bytes, tuple[int, int]] | None) -> list[tuple]:
    """Rows (``SWEPT``) of one container; ``items`` are (ids, sizes, n, conv, ends, next), sorted by ids.

    kind 0: a node; 1: the container's head; 2: the place of a further block's
    head, whose sums are not in the rows unless ``known`` has them.
    """
    depth0, parent, pconv, last0, forced = top
    depth, up, last, count, least, ends, after = [depth0], [-1], [last0], [0], [None], [None], [None]
    path, before = [0], []
    for ids, sizes, n, conv, end, nxt in items:
        same = 0
        while same < len(before) and same < len(ids) and before[same] == ids[same]:
            same += 1
        del path[same + 1 :]
        for j in range(same, len(ids)):
            depth.append(depth0 + j + 1)
            up.append(path[-1])
            last.append(sizes[j])
            count.append(0)
            least.append(None)
            ends.append(None)
            after.append(None)
            path.append(len(depth) - 1)
        at = path[-1]
        count[at] += n
        least[at] = conv if least[at] is None else min(conv, least[at])
        ends[at], after[at] = end, nxt
        before = ids
    size = len(depth)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for i in range(size - 1, -1, -1):  # children come after their parents
        if after[i] is not None:
            leaves[i], saved[i] = (known or {}).get(after[i], (0, 0))
        else:
            leaves[i] += children[i] == 0
            saved[i] += (count[i] - 1) * last[i]
        if i:
            p = up[i]
            children[p] += 1
            leaves[p] += leaves[i]
            saved[p] += saved[i]
            count[p] += count[i]
            least[p] = least[i] if least[p] is None else min(least[i], least[p])
    rows = []
    for i in range(size):
        above = pconv if i == 0 else least[up[i]]
        if after[i] is not None:
            rows.append((2, after[i], parent if i == 0 else key, last[i], False, None, depth[i], above, None, None, None, None, None))
        else:
            rows.append((0 if i else 1, key, parent, last[i], forced and i == 0, least[i], depth[i], above, count[i], children[i], leaves[i], saved[i], ends[i]))
    return rows


def sweep(items: DataFrame, known: bool = False) -> DataFrame:
    """Rows ``SWEPT`` of all containers; with ``known`` the items carry ``next_leaves`` and ``next_saved``."""
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.bool_(), *[pa.int64()] * 7, pa.string()]
    names = [f.split()[0] for f in SWEPT.split(", ")]
    columns = ["c", "depth", "parent", "pconv", "last", "forced", "ids", "sizes", "n", "conv", "ends", "next"]
    columns += ["next_leaves", "next_saved"] if known else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, top, held, sums, out = None, None, [], {}, []

        def done() -> pa.RecordBatch:
            rows = list(zip(*out)) or [[]] * len(kinds)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=names)

        for b in batches:
            for c, depth, parent, pconv, last, forced, ids, sizes, n, conv, ends, nxt, *more in zip(*(x.to_pylist() for x in b.columns)):
                if c != now:
                    if now is not None:
                        out += sweep_container(now, top, held, sums)
                    now, top, held, sums = c, (depth, parent, pconv, last, forced), [], {}
                    if len(out) > 20_000:
                        yield done()
                held.append((ids, sizes, n, conv, ends, nxt))
                if more and more[0] is not None:
                    sums[nxt] = tuple(more)
        if now is not None:
            out += sweep_container(now, top, held, sums)
        yield done()

    ordered = items.select(*columns).repartition("c").sortWithinPartitions("c", "ids")
    return ordered.mapInArrow(run, SWEPT)


def subtree_sums(heads: DataFrame) -> DataFrame:
    """(key, leaves, saved) summed over all heads below each; ``heads`` has (key, parent, leaves, saved)."""
    sums = stored(heads.select("key", F.col("parent").alias("up"), "leaves", "saved"), "trie-sums")
    while not sums.where("up is not null").isEmpty():
        below = sums.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        far = sums.select(F.col("key").alias("up"), F.col("up").alias("far"))
        more = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
        step = sums.join(below, "key", "left").join(far, "up", "left")
        sums = stored(step.select("key", F.col("far").alias("up"), more("leaves", "l"), more("saved", "s")), "trie-sums")
    return sums.select("key", "leaves", "saved")


def build(turns: DataFrame, convs: DataFrame, block: int = BLOCK, limit: int = LIMIT, fan: int = BLOCK) -> DataFrame:
    """The trie's nodes: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``turns`` has (conv, pos, id, size) with positions from 0 on without gaps,
    ``convs`` the ids of all conversations, those without turns too. Nodes are
    named by their smallest member; the root's parent is null. No conversations
    give no nodes.
    """
    items, tops = burst(sequences(turns, convs, block, fan), limit)
    items = stored(items, "trie-settled")
    swept = stored(sweep(items), "trie-swept")
    places = swept.where("kind = 2").select("key", "parent", "pconv", "last")
    own = ["key", "parent", "pconv", "last", "depth", "conv", "n", "children", "leaves", "saved", "ends", "forced"]
    heads = swept.where("kind = 1").select(*own)
    if tops is not None:
        # a burst head has given its last turn's size, but not its own saving yet
        heads = heads.unionByName(tops.withColumn("saved", (F.col("n") - 1) * F.col("last")))
    nodes = swept.where("kind = 0")
    further = not places.isEmpty()
    if further:
        found = places.select("key", F.col("parent").alias("p"), F.col("pconv").alias("pc"), F.col("last").alias("l"))
        heads = heads.join(found, "key", "left").select(
            "key",
            F.coalesce("parent", "p").alias("parent"),
            F.coalesce("pconv", "pc").alias("pconv"),
            "depth", "conv", "n", "children", "leaves",
            (F.col("saved") + F.coalesce((F.col("n") - 1) * F.col("l"), F.lit(0))).alias("saved"),
            "ends",
        )
    heads = stored(heads, "trie-all-heads")
    sums = subtree_sums(heads)
    if further:
        # containers above further blocks are swept again with what lies below them
        open_ = stored(items.where("next is not null").select("c").distinct(), "trie-open")
        below = sums.select(F.col("key").alias("next"), F.col("leaves").alias("next_leaves"), F.col("saved").alias("next_saved"))
        again = sweep(items.join(open_, "c", "left_semi").join(below, "next", "left"), known=True)
        nodes = nodes.join(open_.withColumnRenamed("c", "key"), "key", "left_anti").unionByName(again.where("kind = 0"))
    top = heads.drop("leaves", "saved").join(sums, "key")
    out = [F.col(c.split()[0]) for c in NODE.split(", ")]
    return (
        nodes.select(*out)
        .unionByName(top.select(*out))
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("pconv").alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )


def prefix_trie(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", **sizes: int
) -> DataFrame:
    """The prefix trie of conversations as they are (see :func:`build`).

    Null roles and texts are empty, a null turn number comes first, equal
    numbers go by a digest of role and text, repeated rows are turns of their
    own, rows without a conversation id are left out, and other columns are
    ignored.
    """
    numbered = stored(number_turns(turn_digests(turns, conv_col, turn_col, role_col, text_col)), "trie-numbered")
    return build(numbered, numbered.select("conv").distinct(), **sizes)
