"""Whole-text statistics on UTF-8 bytes, used by the quality operators."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"  # what bytes.split() parts at
WINDOW = 8
_IS_BLANK = np.isin(np.arange(256), list(BLANKS))
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_MIX = np.random.default_rng(8).integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)

# First code point of each script's main range, and the script's name.
SCRIPT_STARTS = [
    (0x0000, "common"), (0x0041, "latin"), (0x005B, "common"), (0x0061, "latin"), (0x007B, "common"),
    (0x00C0, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "indic"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "common"), (0x3040, "kana"), (0x3100, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
    (0x20000, "han"), (0x30000, "other"),
]
_STARTS = np.array([s for s, _ in SCRIPT_STARTS])
_NAMES = sorted({n for _, n in SCRIPT_STARTS})
_CODES = np.array([_NAMES.index(n) for _, n in SCRIPT_STARTS])


def script(text: str) -> str:
    """The script of most letters; ``common`` when there is none. Ties go to the first name."""
    if text.isascii():
        return "latin" if re.search("[A-Za-z]", text) else "common"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = np.bincount(_CODES[np.searchsorted(_STARTS, points, side="right") - 1], minlength=len(_NAMES))
    n[_NAMES.index("common")] = 0
    return _NAMES[int(n.argmax())] if n.any() else "common"


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[bytes] = set()
    n = 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return n


def repeated_words(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per text: words that lie in a window of eight words found twice or more in that text.

    ``ids`` are the numbers of all texts' words, one text after the other, ``sizes`` of them in each.
    """
    ends = np.cumsum(sizes)
    none = np.zeros(len(sizes), np.int64)
    if not len(sizes) or sizes.max() <= WINDOW:
        return none
    ids = ids.astype(np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # a hash of each window: of pairs of words, then of pairs of those, then of pairs of those
    h = (ids + np.uint64(1)) * _MIX[0]
    for k, step in enumerate((1, 2, 4), 1):
        h = (h[:-step] ^ (h[:-step] >> np.uint64(29))) * _MIX[2 * k] + h[step:] * _MIX[2 * k + 1]
    h = (h ^ (h >> np.uint64(32))) * _MIX[1] + owner[: len(h)].astype(np.uint64) * _MIX[2]
    h ^= h >> np.uint64(29)
    whole = owner[: len(h)] == owner[WINDOW - 1 :]
    ranked = np.sort(h[whole])
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return none
    # sort only windows whose last 16 bits are those of a repeated hash
    low = np.zeros(1 << 16, bool)
    low[twice & np.uint64(0xFFFF)] = True
    some = np.flatnonzero(low[h & np.uint64(0xFFFF)] & whole)
    order = some[np.argsort(h[some], kind="stable")]
    same = h[order[1:]] == h[order[:-1]]
    # equal hashes are checked word by word against the window before them in hash order
    a, b = order[1:][same], order[:-1][same]
    equal = owner[a] == owner[b]
    for j in range(WINDOW):
        equal &= ids[a + j] == ids[b + j]
    if not equal.all():  # a collision of the 64-bit hash: count the windows themselves
        windows = [(int(owner[i]), *ids[i : i + WINDOW].tolist()) for i in some]
        often = Counter(windows)
        hit = some[[often[w] > 1 for w in windows]]
    else:
        hit = np.union1d(a, b)
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[hit] += 1
    edges[hit + WINDOW] -= 1
    inside = np.concatenate(([0], np.cumsum(np.cumsum(edges[:-1]) > 0)))
    return inside[ends] - inside[ends - sizes]


def base_statistics_of(texts: list[bytes]) -> np.ndarray:
    """Per text a row of five: words, code points in words, symbols, duplicate lines, words in repeated windows."""
    if not texts:
        return np.zeros((0, 5), np.int64)
    joined = b"\n".join([*texts, b""])  # a newline ends each text
    starts = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    starts = np.concatenate(([0], starts[:-1]))
    data = np.frombuffer(joined, np.uint8)
    blank = _IS_BLANK[data]
    edges = np.flatnonzero(np.diff(blank, prepend=True))  # a word's first byte, the blank after it, and so on
    first, after = edges[::2], edges[1::2]
    words = np.diff(np.searchsorted(first, starts), append=len(first))
    points = np.add.reduceat(~blank & (data & 0xC0 != 0x80), starts, dtype=np.int64)
    symbols = np.add.reduceat(_IS_SYMBOL[data], starts, dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum(after - first)))
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(joined.translate(None, BLANKS))]
    ids = pa.Array.from_buffers(pa.large_binary(), len(first), buffers).dictionary_encode().indices.to_numpy()
    lines = np.fromiter(map(duplicate_lines, texts), np.int64, len(texts))
    return np.stack([words, points, symbols, lines, repeated_words(ids, words)], axis=1)


def base_statistics(text: bytes) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, duplicate lines, words in repeated windows)."""
    return tuple(base_statistics_of([text])[0].tolist())
