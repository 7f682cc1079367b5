"""Quality rules from tokeniser fertility, with rejection bands per language or script.

Every whole text is encoded with public vocabularies. Three figures of each
judge it: characters per token, the share of tokens that are bytes rather than
characters, and the entropy of its token distribution. Texts of one kind lie
close together in all of them, once their length is taken into account, so the
bands are set per group (the document's language, or its script where it has
none) and length class (the power of two below the first vocabulary's token
count): quartiles, widened by ``spread`` (entropy: ``entropy_spread``) times the
quartile distance. Junk (symbol noise, shouting, repeated words, keyword lists)
falls outside. The quartiles are over distinct texts: copies of a text, however
many, count once, so they do not narrow the band of the others.

A whole text's tokens are put together chunk by chunk: a text parts before every
blank or newline that follows another character (:func:`cuts`), which none of
the vocabulary's tokens crosses (:func:`by_chunks` verifies that), so a task
encodes each distinct chunk once and keeps it in a table of bounded size. Other
vocabularies get whole texts.

Scale: one narrow pass over the texts, stored; copies combine map-side by
(group, class, digest) and travel once per task; the quartiles are exact, from
counts of values rounded to thousandths, which combine map-side, so their
state is bounded whatever the input; the bands table has one row per group and
length class.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import fresh_name, slices, stored, text_or_empty
from basketry.llm.pieces import MARK, Model, check_model
from basketry.llm.textstats import base_statistics_of, script

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FIGURES = ["chars_per_token", "byte_share", "entropy"]  # in thousandths
BATCH_CHARS = 1 << 20
TABLE_BYTES = 1 << 21  # bytes of distinct chunks at which a task's table of chunks starts anew
FIRST = "^"  # marks the first chunk of a text; the others begin with a blank or a newline
MIN_GROUP = 40  # a group with fewer texts sets no band of its own
MAX_BANDS = 20_000  # most rows of the bands table that are sent to the tasks (about 2 MB)
SALTS = 64  # pieces that a group falls into when the bands are joined instead


def figure_names(vocabularies: int) -> list[str]:
    """Names of the figures: plain for the first vocabulary, numbered from 2 on for the others."""
    return [f"{c}_{v}" if v > 1 else c for v in range(1, vocabularies + 1) for c in FIGURES]


def figures_of(measured: DataFrame, stats: str) -> list[str]:
    return [c for c in measured.schema[stats].dataType.names if c.startswith(tuple(FIGURES))]


def vocabulary(path: str) -> tuple[Callable[[list[str]], list[list[int]]], np.ndarray]:
    """(encoder of texts, which ids stand for bytes that are no character) of a .model or .tiktoken file."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: sp.encode(texts, num_threads=1), np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])
    import public_tokenizers
    import tiktoken

    ranks = byte_pairs(path)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    is_byte = np.zeros(max(ranks.values()) + 1, bool)
    for token, rank in ranks.items():
        is_byte[rank] = not _is_text(token)
    return lambda texts: [coder.encode_ordinary(t) for t in texts], is_byte


def byte_pairs(path: str) -> dict[bytes, int]:
    """Tokens and their ids of a .tiktoken file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


def cuts(data: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes where a blank or newline follows another character that is no white space, nor SentencePiece's mark for it."""
    at = np.flatnonzero((data == 32) | (data == 10))
    at = at[at > 2]
    code = data[at - 1].astype(np.uint32)  # up to three bytes of the character before
    wide = np.flatnonzero(code > 127)
    code[wide] |= data[at[wide] - 2].astype(np.uint32) << 8
    longer = wide[code[wide] < 0xC000]
    code[longer] |= data[at[longer] - 3].astype(np.uint32) << 16
    code[wide[np.isin(code[wide], _WIDE_BLANKS)]] = 32
    return at[~_BLANK[np.minimum(code, 127)]]


_BLANK = np.array([chr(c).isspace() for c in range(128)])
_WIDE_BLANKS = [int.from_bytes(chr(c).encode()) for c in range(128, 0x10000) if chr(c).isspace() or chr(c) == MARK]


def by_chunks(path: str, encode: Callable[[list[str]], list[list[int]]]) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]] | None:
    """Function from chunks (of :class:`Tokens`) to their ids inside a text and the number of each; None where a token may cross :func:`cuts`.

    The pattern of byte pairs never holds a blank after another character. The
    pieces of a .model file are checked, and that it leaves characters as they are.
    """
    return _piece_chunks(path, encode) if path.endswith(".model") else _byte_pair_chunks(path, encode)


def _piece_chunks(path, encode):
    try:
        check_model(path)
    except ValueError:
        return None
    probe = "a b\nc  d\tﬁ ① Ａ e\u0301"
    if Model(path).sp.normalize(probe) != MARK + probe.replace(" ", MARK):
        return None
    skip = len(encode(["\n"])[0])

    def segment(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # the model puts a mark before a text: that of a first chunk, or of a chunk's own space; others stand after a newline
        marked = [c[0] == FIRST or (c[0] == " " and len(c) > 1) for c in chunks]
        ids = encode([c[1:] if m else "\n" + c for c, m in zip(chunks, marked)])
        return _flat([i if m else i[skip:] for i, m in zip(ids, marked)])

    return segment


def _byte_pair_chunks(path, encode):
    ranks = byte_pairs(path)
    size = np.zeros(max(ranks.values()) + 1, np.int64)  # bytes of each token
    for token, rank in ranks.items():
        size[rank] = len(token)

    def segment(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # one text of all chunks that can stand one after the other: cheaper than a call for each
        alone = [c[0] == FIRST or c[-1].isspace() for c in chunks]
        joined = [c for c, a in zip(chunks, alone) if not a]
        ids, _ = _flat(encode(["".join(joined)]))
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, joined)), np.int64, len(joined)))
        upto = np.searchsorted(np.cumsum(size[ids]), ends, side="right")
        single, sizes = _flat(encode([c.removeprefix(FIRST) for c, a in zip(chunks, alone) if a]))
        alone = np.array(alone, bool)
        n = np.zeros(len(chunks), np.int64)
        n[alone], n[~alone] = sizes, np.diff(upto, prepend=0)
        out = np.zeros(len(ids) + len(single), np.int32)
        own = np.repeat(alone, n)
        out[own], out[~own] = single, ids
        return out, n

    return segment


class Tokens:
    """Token ids of texts under several vocabularies, through a table of the distinct chunks met so far.

    The first chunk of a text begins with :data:`FIRST`, the others with the
    blank or newline of their cut.
    """

    def __init__(self, models: Sequence[str], table_bytes: int = TABLE_BYTES):
        found = [vocabulary(m) for m in models]
        self.whole = [encode for encode, _ in found]
        self.is_byte = [is_byte for _, is_byte in found]
        self.parts = [by_chunks(m, encode) for m, encode in zip(models, self.whole)]
        self.table_bytes = table_bytes
        self._empty()

    def _empty(self) -> None:
        self.chunks, self.bounds = b"", np.zeros(1, np.int64)  # one after the other, and where each begins and ends
        self.ids = [np.zeros(0, np.int32) for _ in self.parts]
        self.ends = [np.zeros(0, np.int64) for _ in self.parts]

    def of(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per vocabulary: (ids of all texts, one after the other; tokens of each text)."""
        if any(self.parts):
            at, last = self._numbers([t.encode() for t in texts])
        out = []
        for v, segment in enumerate(self.parts):
            if not segment:
                out.append(_flat(self.whole[v](texts)))
                continue
            sizes = np.diff(self.ends[v], prepend=0)[at]
            upto = np.cumsum(sizes)
            ids = self.ids[v][np.repeat(self.ends[v][at] - upto, sizes) + np.arange(sizes.sum())]
            out.append((ids, np.diff(upto[last], prepend=0)))
        return out

    def _numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all chunks in the table, place of each text's last chunk); new chunks are encoded."""
        if len(self.chunks) >= self.table_bytes:
            self._empty()
        mark = FIRST.encode()
        data = b"".join([mark + t for t in texts])
        starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)))
        inside = np.setdiff1d(cuts(np.frombuffer(data, np.uint8)), starts + 1, assume_unique=True)
        ends = np.sort(np.concatenate((starts, inside)))
        known = len(self.bounds) - 1
        # the table's chunks come first, so that they keep their numbers
        coded = _binary(self.chunks + data, np.concatenate((self.bounds, len(self.chunks) + ends[1:]))).dictionary_encode()
        new = coded.dictionary[known:].to_pylist()
        self.chunks += b"".join(new)
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(np.fromiter(map(len, new), np.int64, len(new)))))
        new = [c.decode() for c in new]
        for v, segment in enumerate(self.parts):
            if segment:
                ids, sizes = segment(new)
                self.ends[v] = np.concatenate((self.ends[v], len(self.ids[v]) + np.cumsum(sizes)))
                self.ids[v] = np.concatenate((self.ids[v], ids))
        return coded.indices.to_numpy()[known:], np.searchsorted(ends, starts[1:]) - 1


def _binary(data: bytes, bounds: np.ndarray) -> pa.Array:
    """The pieces of ``data`` between neighbouring ``bounds``."""
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers, one list after the other; length of each)."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes


def token_figures(chars: np.ndarray, ids: np.ndarray, tokens: np.ndarray, is_byte: np.ndarray) -> list[np.ndarray]:
    """Characters per token, byte share and entropy in bits of each text, in thousandths; 0 without tokens.

    ``ids`` are those of all texts, one after the other, ``tokens`` of them in each.
    """
    n = len(tokens)
    key = np.repeat(np.arange(n, dtype=np.int64) << 32, tokens) | ids
    key.sort()
    first = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.diff(first, append=len(key))
    text, token = key[first] >> 32, key[first] & 0xFFFFFFFF
    per = np.maximum(tokens, 1)
    share = times / per[text]
    in_bytes = np.bincount(text, times * is_byte[token], n)
    bits = -np.bincount(text, share * np.log2(share), n)
    return [np.rint(x).astype(np.int64) for x in (1000 * chars * (tokens > 0) / per, 1000 * in_bytes / per, 1000 * bits)]


def add_statistics(docs: DataFrame, models: str | Sequence[str], text_col: str = "text", out: str = "stats") -> DataFrame:
    """``docs`` plus the struct ``out``; an existing column of that name is replaced. Null text: empty.

    ``models`` are vocabulary files (.model or .tiktoken) that every executor can open.
    """
    models = [models] if isinstance(models, str) else list(models)
    figures = figure_names(len(models))
    numbers = [*BASE, "n_tokens", *figures]
    shape = "struct<" + ",".join(f"{c}:bigint" for c in numbers) + ",script:string,digest:binary>"
    keep = [c for c in docs.columns if c.lower() != out.lower()]
    text = fresh_name(keep, "_text")
    given = docs.select(*[F.col(f"`{c}`") for c in keep], text_or_empty(text_col).alias(text))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).withColumn(out, F.lit(None).cast(shape)).schema

    kind = [pa.field(c, pa.int64()) for c in numbers] + [pa.field("script", pa.string()), pa.field("digest", pa.binary())]

    def measured(texts: list[str], tokens: Tokens) -> pa.StructArray:
        raw = [t.encode() for t in texts]
        columns = list(base_statistics_of(raw).T)
        chars = np.fromiter(map(len, texts), np.int64, len(texts))
        for k, (ids, n) in enumerate(tokens.of(texts)):
            columns += [n][k:] + token_figures(chars, ids, n, tokens.is_byte[k])  # the token count of the first one only
        columns = [pa.array(np.ascontiguousarray(c)) for c in columns]
        columns += [pa.array([script(t) for t in texts], pa.string()), pa.array([xxhash.xxh3_128_digest(r) for r in raw], pa.binary())]
        return pa.StructArray.from_arrays(columns, fields=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(models)
        for b in slices(batches):
            found, some, size = [], [], 0
            for t in b.column(len(keep)).to_pylist():
                some.append(t)
                size += len(t)
                if size >= BATCH_CHARS:
                    found.append(measured(some, tokens))
                    some, size = [], 0
            found.append(measured(some, tokens))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.concat_arrays(found)], names=[*keep, out])

    return given.mapInArrow(run, schema)


def _class(tokens: Column) -> Column:
    return F.floor(F.log2(F.greatest(tokens, F.lit(1)).cast("double"))).cast("int")


def _nearest(values: DataFrame, key: str, min_group: int, figures: list[str]) -> DataFrame:
    """(key, class, enough, and per figure its quartiles) over the nearest classes of ``key`` that hold ``min_group`` texts.

    ``values`` has ``key``, ``class``, ``figure``, ``value`` and its count ``n``.
    A key with fewer texts pools all its classes, and is not ``enough``.
    """
    counts = values.groupBy(key, "class", "figure", "value").agg(F.sum("n").alias("n"))
    cells = counts.where(F.col("figure") == 0).groupBy(key, "class").agg(F.sum("n").alias("texts"))
    gap = F.abs(F.col("class") - F.col("other"))
    rings = (
        cells.select(key, "class")
        .join(cells.select(key, F.col("class").alias("other"), "texts"), key)
        .groupBy(key, "class", gap.alias("gap"))
        .agg(F.sum("texts").alias("texts"))
    )
    inside = F.sum("texts").over(Window.partitionBy(key, "class").orderBy("gap"))  # one row per class of the key
    full = F.min(F.when(F.col("inside") >= min_group, F.col("gap")))
    reach = (
        rings.withColumn("inside", inside)
        .groupBy(key, "class")
        .agg(F.coalesce(full, F.max("gap")).alias("reach"), full.isNotNull().alias("enough"))
    )
    near = reach.join(counts.withColumnRenamed("class", "other"), key).where(gap <= F.col("reach"))
    found = near.groupBy(key, "class", "enough", "figure").agg(F.percentile("value", [0.25, 0.5, 0.75], F.col("n")).alias("q"))
    quartiles = [F.max(F.when(F.col("figure") == i, F.col("q"))).alias(f"{c}_q") for i, c in enumerate(figures)]
    return found.groupBy(key, "class", "enough").agg(*quartiles)


def bands(measured: DataFrame, group: Column, stats: str = "stats", min_group: int = MIN_GROUP) -> DataFrame:
    """(group, script, class, and per figure its exact quartiles): a band for every text with tokens.

    A class with fewer than ``min_group`` texts of its group takes in the
    nearest length classes until there are as many; a group with fewer in all
    is judged by its script in the same way, and a script with fewer by all of
    its own texts, however few. Other scripts set no band for it: all three
    figures depend on how well the vocabulary covers the script. Texts without
    letters (script ``common``) are judged there by all texts.
    """
    s = lambda c: F.col(f"{stats}.{c}")
    figures = figures_of(measured, stats)
    rows = measured.where(s("n_tokens") > 0).select(
        group.alias("group"),
        s("script").alias("script"),
        _class(s("n_tokens")).alias("class"),
        s("digest").alias("digest"),
        *[s(c).alias(c) for c in figures],
    )
    # copies of a text have its figures too
    rows = rows.groupBy("group", "script", "class", "digest").agg(*[F.max(c).alias(c) for c in figures])
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("figure"), F.col(c).alias("value")) for i, c in enumerate(figures)]))
    values = rows.select("group", "script", "class", each.alias("v")).select("group", "script", "class", "v.*")
    values = stored(values.groupBy("group", "script", "class", "figure", "value").agg(F.count("*").alias("n")), "fertility-values")
    cells = values.select("group", "script", "class").distinct()
    pools = values.withColumn("script", F.explode(F.array_distinct(F.array("script", F.lit("common")))))
    named = [
        _nearest(t, key, min_group, figures).withColumnsRenamed({"enough": f"enough_{p}", **{f"{c}_q": f"{c}_{p}" for c in figures}})
        for t, key, p in ((values, "group", "g"), (pools, "script", "s"))
    ]
    joined = cells.join(named[0], ["group", "class"]).join(named[1], ["script", "class"])
    picked = [F.when(F.col("enough_g"), F.col(f"{c}_g")).otherwise(F.col(f"{c}_s")).alias(f"{c}_q") for c in figures]
    return joined.select("group", "script", "class", *picked)


def judge(
    measured: DataFrame,
    lang_col: str | None = "lang",
    stats: str = "stats",
    spread: float = 5.0,
    entropy_spread: float = 2.5,
    min_words: int = 20,
    max_repeat_pct: int = 30,
    min_group: int = MIN_GROUP,
    max_bands: int = MAX_BANDS,
    out: tuple[str, str] = ("base_failed", "kept"),
) -> DataFrame:
    """``measured`` plus ``base_failed`` and ``kept``, named by ``out`` (columns of these names are replaced).

    ``base_failed``: under ``min_words`` words, or more than
    ``max_repeat_pct`` percent of them in repeated windows. ``kept``: not
    ``base_failed``, and no figure outside its band (:func:`bands`); characters
    per token are held on both sides, entropy below, the byte share above. A
    text without tokens is judged by the base rules alone. The bands go to the
    tasks when they have at most ``max_bands`` rows, and are joined on salted
    groups otherwise. ``measured`` is read twice (bands, then verdicts): store
    it first.
    """
    figures = figures_of(measured, stats)
    has_lang = lang_col is not None and lang_col.lower() in [c.lower() for c in measured.columns]
    s = lambda c: F.col(f"{stats}.{c}")
    group = F.coalesce(F.col(f"`{lang_col}`").cast("string"), s("script")) if has_lang else s("script")
    limits = bands(measured, group, stats, min_group)
    keep = [c for c in measured.columns if c.lower() not in [o.lower() for o in out]]
    g, k, w = fresh_name(keep, "_group"), fresh_name(keep, "_class"), fresh_name(keep, "_script")
    on = [g, k, w]
    limits = limits.withColumnsRenamed({"group": g, "class": k, "script": w, **{f"{c}_q": fresh_name(keep, f"_{c}_q") for c in figures}})
    q = {c: fresh_name(keep, f"_{c}_q") for c in figures}

    def below(c: str, least: int, by: float) -> Column:
        lo, hi = F.col(q[c])[0], F.col(q[c])[2]
        return s(c) < lo - by * F.greatest(hi - lo, F.lit(least))

    def above(c: str, least: int, by: float) -> Column:
        lo, hi = F.col(q[c])[0], F.col(q[c])[2]
        return s(c) > hi + by * F.greatest(hi - lo, F.lit(least))

    # least widths, in thousandths: a group of copies has no spread of its own
    outside = F.lit(False)
    for c in figures:
        if c.startswith("chars_per_token"):
            outside = outside | below(c, 20, spread) | above(c, 20, spread)
        elif c.startswith("entropy"):
            outside = outside | below(c, 50, entropy_spread)
        else:
            outside = outside | above(c, 5, spread)
    base = (s("n_words") < min_words) | (100 * s("n_repeat_words") > max_repeat_pct * s("n_words"))
    rows = measured.select(*[F.col(f"`{c}`") for c in keep], group.alias(g), _class(s("n_tokens")).alias(k), s("script").alias(w))
    limits = stored(limits, "fertility-bands")
    if limits.count() <= max_bands:
        joined = rows.join(F.broadcast(limits), on, "left")
    else:  # a few groups hold most rows: each is dealt into pieces, and its band copied to them
        salt = fresh_name([*keep, g, k, w, *q.values()], "_salt")
        piece = F.pmod(F.xxhash64(*[s(c) for c in figures], s("n_words")), F.lit(SALTS)).cast("int")
        copies = limits.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn(salt, piece).join(copies, [*on, salt], "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in keep],
        base.alias(out[0]),
        (~base & ~F.coalesce(outside, F.lit(False))).alias(out[1]),
    )


def quality_rules(
    docs: DataFrame,
    models: str | Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    **rules,
) -> DataFrame:
    """One row per row of ``docs``: id, the base statistics, ``base_failed``, ``kept``, tokens and figures.

    Null texts have no words and fail the base rules; null ids, null languages
    (grouped by script) and repeated rows stay; other columns are ignored; an
    empty table gives no rows.
    """
    langs = [lang_col] if lang_col and lang_col.lower() in [c.lower() for c in docs.columns] else []
    own = docs.select(*dict.fromkeys([id_col, text_col, *langs]))
    measured = add_statistics(own, models, text_col).select(id_col, *langs, "stats")
    figures = figures_of(measured, "stats")
    judged = judge(stored(measured, "fertility"), lang_col, **rules)
    return judged.select(
        id_col, *[f"stats.{c}" for c in BASE], "base_failed", "kept", "stats.n_tokens", *[f"stats.{c}" for c in figures]
    )
