"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the vocabulary has a white-space mark after another character, so
no merge crosses from a character to the next mark and every marked word can
be segmented by itself (:func:`check_model` verifies this for the given model).
A newline that no longer piece contains parts chunks as well.

The steps, with blocks of documents of bounded size:

1. each block lists its distinct chunks and replaces every text by positions
   in that list;
2. the lists are dealt by chunk hash, each distinct chunk is segmented once
   per hash range and its ids travel back to the block;
3. each block joins the ids back by position.

So text itself is never shuffled, a frequent word moves once per block, and a
task holds one block and the chunks of one hash range. Of a block it holds the
distinct chunks or, when joining back, arrays of their ids and texts: few Python
objects, as a worker that lives on keeps most of what it once took. Rows are sorted within
their partition before blocks are cut, so a block that is computed again after
a lost executor is the same block.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import slices, text_or_empty

MARK = "▁"
BLOCK_CHARS = 1 << 23  # most characters of text in a block, but for a single longer text
STEP = 20_000  # chunks handed to the library at once
LONG = 32  # entries of more items on average are joined as slices


class Model:
    """One SentencePiece model and its segmentation of single chunks."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunks = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n").findall
        self.newline = self.sp.encode("\n")
        self.break_ids = self.newline[1:] if self.newline[:1] == self.sp.encode("") + [self.sp.piece_to_id(MARK)] else self.newline

    def segment(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk as it is segmented inside a longer text."""
        # the model puts a mark before a text; a chunk with a mark lends its own, others stand after a newline
        marked = [len(c) > 1 and c[0] == MARK for c in chunks]
        given = [c[1:] if m else "\n" + c for c, m in zip(chunks, marked)]
        skip = len(self.newline)
        return [ids if m else ids[skip:] for ids, m in zip(self.sp.encode(given, num_threads=1), marked)]

    def decode_inner(self, ids: list[list[int]]) -> list[str]:
        """Text of each chunk as it is decoded inside a longer text."""
        out: list[str] = []
        for at in range(0, len(ids), STEP):
            out += [t[1:] for t in self.sp.decode([self.break_ids + i for i in ids[at : at + STEP]])]
        return out


def check_model(path: str) -> None:
    """Raise ``ValueError`` when the model's pieces cannot be found chunk by chunk."""
    model = Model(path)
    pieces = [model.sp.id_to_piece(i) for i in range(model.sp.get_piece_size())]
    crossing = [p for p in pieces if re.search(f"[^{MARK}]{MARK}", p)]
    if crossing:
        raise ValueError(f"pieces cross a white-space mark: {crossing[:3]}")
    if any("\n" in p for p in pieces):
        raise ValueError("a piece holds a newline")
    probe = "a b\nc  d"
    got = [i for c in model.segment(model.chunks(model.sp.normalize(probe))) for i in c]
    if got != model.sp.encode(probe):
        raise ValueError("this model does not put a white-space mark before a text")


class Table(NamedTuple):
    """Entries of a block's distinct chunks, one after another; entry k is ``flat[ends[k]:ends[k + 1]]``."""

    flat: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, sizes: list[np.ndarray], flat: list[np.ndarray], kind: str) -> Table:
        return cls(np.concatenate([np.empty(0, kind), *flat]), np.cumsum(np.concatenate([np.zeros(1, np.int64), *sizes])))

    def lists(self) -> Iterator[list[list]]:
        """The entries as Python lists, at most ``STEP`` at a time."""
        for at in range(0, len(self.ends) - 1, STEP):
            ends = self.ends[at : at + STEP + 1]
            some, cuts = self.flat[ends[0] : ends[-1]].tolist(), (ends - ends[0]).tolist()
            yield [some[a:b] for a, b in zip(cuts, cuts[1:])]

    def join(self, at: np.ndarray) -> np.ndarray:
        """The entries at these positions, one after another."""
        parts = []
        for k in range(0, len(at), STEP):
            p = at[k : k + STEP]
            starts = self.ends[p]
            sizes = self.ends[p + 1] - starts
            to = np.cumsum(sizes)
            if to[-1] > LONG * len(p):  # an index of every item would take more than the entries themselves
                parts.append(np.concatenate([self.flat[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist())]))
            else:
                parts.append(self.flat[np.repeat(starts - to + sizes, sizes) + np.arange(to[-1])])
        return np.concatenate(parts) if parts else self.flat[:0]


def _lengths_and_bytes(parts: list[bytes]) -> bytes:
    """Lengths as uint32 (count first), then the concatenated parts."""
    n = np.fromiter(map(len, parts), np.uint32, len(parts))
    return np.uint32(len(parts)).tobytes() + n.tobytes() + b"".join(parts)


def _split(payload: bytes) -> list[bytes]:
    n = int(np.frombuffer(payload, np.uint32, 1)[0])
    ends = np.cumsum(np.frombuffer(payload, np.uint32, n, 4), dtype=np.int64) + 4 + 4 * n
    starts = np.concatenate(([4 + 4 * n], ends[:-1])) if n else ends
    return [payload[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def _split_ids(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each entry, and all ids one after another."""
    n = int(np.frombuffer(payload, np.uint32, 1)[0])
    return np.frombuffer(payload, np.uint32, n, 4) // 4, np.frombuffer(payload, "<i4", -1, 4 + 4 * n)


def _pack_positions(at: np.ndarray) -> bytes:
    """uint32 positions by byte planes, which compress well."""
    return np.ascontiguousarray(at.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpack_positions(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def encode_documents(
    docs: DataFrame,
    model: str,
    finish: Callable[[Model, Table, Iterator[np.ndarray]], list[pa.Array]],
    schema: str,
    id_cols: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    ranges: int | None = None,
) -> DataFrame:
    """Encode every text and apply ``finish`` to each block of results.

    ``finish(model, table, positions)`` gets the ids of the block's distinct
    chunks and, for each document, the positions of its chunks in that table;
    it returns one array for each column of ``schema``, with a value per
    document; see :func:`encode` and :func:`digests` for the two uses. The
    result has ``id_cols`` and the columns of ``schema``.
    """
    import zstandard

    check_model(model)
    ids = list(id_cols)
    spark = docs.sparkSession
    kept = docs.select(*[F.col(f"`{c}`") for c in ids], text_or_empty(text_col).alias("_text"))
    id_fields = [kept.schema[c] for c in ids]
    if ranges is None:
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # sorting makes the blocks of a partition the same on every run
    kept = kept.sortWithinPartitions(*ids, F.xxhash64("_text"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, squeeze = Model(model), zstandard.ZstdCompressor(level=1).compress

        def listed(rows: list[tuple], positions: list[np.ndarray], seen: dict[str, int], block) -> pa.RecordBatch:
            """The rows of a block: its documents and its chunk lists."""
            chunks = [c.encode() for c in seen]
            seen.clear()
            block.update(b"".join(chunks))
            name = -1 - (int.from_bytes(block.digest()[:8], "little") >> 1)  # negative: hash ranges count from 0
            part = np.fromiter((zlib.crc32(c) % ranges for c in chunks), np.uint32, len(chunks))
            order = np.argsort(part, kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            groups = np.split(order, cuts) if len(order) else []
            # documents go to their block; a chunk list goes to its hash range, with the block it belongs to
            out = [(name, len(groups), squeeze(_pack_positions(place[p]))) for p in positions]
            for group in groups:
                out.append((int(part[group[0]]), name, squeeze(_lengths_and_bytes([chunks[i] for i in group]))))
            columns = [pa.array([o[j] for o in out], kind) for j, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            fill = [None] * (len(out) - len(rows))
            given = [pa.array([r[j] for r in rows] + fill, t) for j, t in enumerate(id_types)]
            return pa.RecordBatch.from_arrays([*columns, *given], names=["place", "extra", "payload", *ids])

        rows, positions, size, seen, block = [], [], 0, {}, hashlib.sha256()
        for b in slices(batches):
            for *r, t in zip(*[c.to_pylist() for c in b.columns]):
                rows.append(tuple(r))
                positions.append(np.array([seen.setdefault(c, len(seen)) for c in m.chunks(m.sp.normalize(t))], np.uint32))
                block.update(repr((rows[-1], len(t))).encode())
                size += len(t)
                if size >= BLOCK_CHARS:
                    yield listed(rows, positions, seen, block)
                    rows, positions, size, seen, block = [], [], 0, {}, hashlib.sha256()
        if rows:
            yield listed(rows, positions, seen, block)

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    id_types = [to_arrow_type(f.dataType) for f in id_fields]
    fields = [StructField("place", LongType()), StructField("extra", LongType()), StructField("payload", BinaryType()), *id_fields]
    # one exchange for both kinds of rows: it is read by the segmentation and by the joining back
    dealt = kept.mapInArrow(index, StructType(fields)).repartition(ranges, "place")

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each distinct chunk of the hash range once; the answers in the order of each list."""
        m, known = Model(model), {}
        squeeze, spread = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
        for b in slices(batches):
            b = b.filter(pa.compute.greater_equal(b.column(0), 0))
            answers = []
            for payload in b.column(2).to_pylist():
                chunks = _split(spread(payload))
                new = [c for c in chunks if c not in known]
                for at in range(0, len(new), STEP):
                    some = new[at : at + STEP]
                    for c, found in zip(some, m.segment([c.decode() for c in some])):
                        known[c] = np.array(found, "<u4").tobytes()
                answers.append(squeeze(_lengths_and_bytes([known[c] for c in chunks])))
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(0), pa.array(answers, pa.binary())], names=["place", "part", "payload"]
            )

    answers = dealt.mapInArrow(segment, "place long, part long, payload binary")
    out_schema = StructType([*id_fields, *StructType.fromDDL(schema).fields])
    out_arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out_schema.fields])

    def join_back(documents: pa.Table, found: pa.Table) -> pa.Table:
        m, spread = Model(model), zstandard.ZstdDecompressor().decompress
        found = found.sort_by("part")
        lists = [_split_ids(spread(p)) for p in found.column("payload").to_pylist()]
        own = documents.filter(pa.compute.less(documents.column("place"), 0))
        if any(n != found.num_rows for n in own.column("extra").to_pylist()):
            raise RuntimeError("a block of documents and its chunk lists differ; the input changed while it was read")
        if not own.num_rows:
            return out_arrow.empty_table()
        positions = (_unpack_positions(spread(p)) for p in own.column("payload").to_pylist())
        table = Table.of([sizes for sizes, _ in lists], [flat for _, flat in lists], "<i4")
        given = [own.column(c) for c in ids]
        return pa.table([*given, *finish(m, table, positions)], names=out_arrow.names).cast(out_arrow)

    return dealt.groupBy("place").cogroup(answers.groupBy("place")).applyInArrow(join_back, out_schema)


def _decoded(m: Model, table: Table) -> Table:
    """UTF-8 of the text of each chunk."""
    sizes, flat = [], []
    for ids in table.lists():
        texts = [t.encode() for t in m.decode_inner(ids)]
        sizes.append(np.fromiter(map(len, texts), np.int64, len(texts)))
        flat.append(np.frombuffer(b"".join(texts), np.uint8))
    return Table.of(sizes, flat, "u1")


def _decimal(table: Table) -> Table:
    """The ids of each chunk in decimal, each with a comma behind it."""
    sizes, flat = [], []
    for ids in table.lists():
        texts = ["".join([f"{i}," for i in own]).encode() for own in ids]
        sizes.append(np.fromiter(map(len, texts), np.int64, len(texts)))
        flat.append(np.frombuffer(b"".join(texts), np.uint8))
    return Table.of(sizes, flat, "u1")


def _text(decoded: Table, at: np.ndarray) -> bytes:
    """Decoding drops the mark that encoding put before the text."""
    return decoded.join(at).tobytes().removeprefix(b" ")


def _ids_and_text(m: Model, table: Table, positions: Iterator[np.ndarray]) -> list[pa.Array]:
    decoded = _decoded(m, table)
    ids, texts = bytearray(), bytearray()  # all documents one after another
    id_ends, text_ends = [0], [0]
    for at in positions:
        ids += table.join(at).tobytes()
        texts += _text(decoded, at)
        id_ends.append(len(ids) // 4)
        text_ends.append(len(texts))
    return [
        pa.ListArray.from_arrays(pa.array(id_ends, pa.int32()), pa.array(np.frombuffer(ids, "<i4"))),
        pa.StringArray.from_buffers(len(text_ends) - 1, pa.py_buffer(np.array(text_ends, "<i4")), pa.py_buffer(texts)),
    ]


def _digest_rows(m: Model, table: Table, positions: Iterator[np.ndarray]) -> list[pa.Array]:
    decoded, decimal, sizes = _decoded(m, table), _decimal(table), np.diff(table.ends)
    out = []
    for at in positions:
        listed = decimal.join(at)[:-1]  # without the last comma
        out.append(
            (int(sizes[at].sum()), hashlib.sha256(listed).hexdigest(), hashlib.sha256(_text(decoded, at)).hexdigest())
        )
    return [pa.array(list(c)) for c in zip(*out)]


def encode(docs: DataFrame, model: str, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``id_cols``, ``ids`` (array of int) and ``decoded`` (string) of every row.

    Null texts are empty and have no ids; null ids and repeated rows stay;
    other columns are ignored unless named in ``id_cols``; an empty table
    gives no rows.
    """
    return encode_documents(docs, model, _ids_and_text, "ids array<int>, decoded string", id_cols, text_col)


def digests(docs: DataFrame, model: str, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``id_cols``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every row (see :func:`encode`)."""
    return encode_documents(
        docs, model, _digest_rows, "n_tokens long, ids_sha256 string, decoded_sha256 string", id_cols, text_col
    )
