"""Secret scans: Aho-Corasick keyword prefilter, anchored regular expressions near hits, embedded checksums.

One automaton holds the keywords of all rules, so a text is read once whatever
the number of rules. A rule's expression is tried only where one of its
keywords starts, anchored there, and never inside the rule's previous match;
since every match of a rule starts with one of its keywords, that gives the
leftmost non-overlapping matches of a search through the whole text. Rules
without a keyword (long runs of hex digits) are anchored by a sparse probe: a
run of 24 covers four of the positions 0, 6, 12, ... in a row, so every sixth
byte says where a run can be. A match then has to reach its rule's length and,
where the secret carries a checksum, to satisfy it: an issuer's CRC-32 in the
last six characters of a token, or the Luhn digit of a card number.

Scale: documents are scanned where they are read; there is no shuffle, and a
task holds one batch of texts. Keywords, expressions and secrets are ASCII, so
bytes are searched and offsets turned into code points for hits alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import fresh_name, slices, text_or_empty, utf8_values

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdef", np.uint8))
HEX_LEAST, HEX_STEP = 24, 6
KIND = "array<struct<kind:string,start:int,stop:int>>"


def crc_token(token: bytes) -> bool:
    """Are the last six characters the base-62 CRC-32 of the 30 before them?"""
    value = 0
    for c in token[-6:]:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(token[-36:-6])


def luhn(number: bytes) -> bool:
    """Does the last digit of a number (blanks and hyphens aside) satisfy the Luhn sum?"""
    digits = [c - 48 for c in number if 48 <= c <= 57]
    doubled = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(doubled) + sum(digits[-1::-2])) % 10 == 0


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` that start at a keyword (lower-case ASCII; found in either case).

    ``group`` is the group that must have ``least`` characters and satisfy
    ``check``; ``span`` the group whose place is reported.
    """

    kind: str
    pattern: bytes
    keywords: tuple[str, ...] = ()
    group: int = 0
    least: int = 0
    check: Callable[[bytes], bool] | None = None
    span: int = 0


def any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The base kinds of the scan, then the formats that carry a checksum.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_?key")
CARD_WORDS = ("card", "visa", "mastercard", "amex")
ASSIGN = (
    "(" + "|".join(map(any_case, ASSIGN_WORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX_RUN = r"[0-9a-f]+"
CARD = "(?:" + "|".join(map(any_case, CARD_WORDS)) + r")[ -/:-~]{0,24}([0-9](?:[ -]?[0-9]){12,18})"
HOST_TOKEN = r"gh[opurs]_[0-9A-Za-z]{36}"
PACKAGE_TOKEN = r"npm_[0-9A-Za-z]{36}"
RULES = (
    Rule("assign", ASSIGN.encode(), ("password", "passwd", "secret", "token", "apikey", "api_key"), group=2, least=6),
    Rule("access", ACCESS.encode(), ("akia",), least=20),
    Rule("hex", HEX_RUN.encode(), least=HEX_LEAST),
    Rule("host_token", HOST_TOKEN.encode(), ("gho_", "ghp_", "ghu_", "ghr_", "ghs_"), check=crc_token),
    Rule("package_token", PACKAGE_TOKEN.encode(), ("npm_",), check=crc_token),
    Rule("card", CARD.encode(), CARD_WORDS, group=1, check=luhn, span=1),
)
BASE_KINDS = ("assign", "access", "hex")


def hex_anchors(raw: bytes) -> list[int]:
    """Starts of the runs of lower-case hex digits that can have ``HEX_LEAST`` of them."""
    if len(raw) < HEX_LEAST:
        return []
    a = np.frombuffer(raw, np.uint8)
    hit = HEX[a[::HEX_STEP]]
    near = HEX_LEAST // HEX_STEP
    n = len(hit) - near + 1
    if n < 1:
        return []
    every = hit[:n].copy()
    for j in range(1, near):
        every &= hit[j : j + n]
    starts, end = [], -1
    for at in (np.flatnonzero(every) * HEX_STEP).tolist():
        if at < end:
            continue
        start = end = at
        while start and HEX[raw[start - 1]]:
            start -= 1
        while end < len(raw) and HEX[raw[end]]:
            end += 1
        starts.append(start)
    return starts


class Scanner:
    """The rules, compiled once per task."""

    def __init__(self, rules: tuple[Rule, ...]):
        import ahocorasick

        self.rules = [(r, re.compile(r.pattern)) for r in rules]
        owners: dict[str, list[int]] = {}
        for k, r in enumerate(rules):
            for w in r.keywords:
                owners.setdefault(w, []).append(k)
        self.automaton = ahocorasick.Automaton()
        for w, ks in owners.items():
            self.automaton.add_word(w, (len(w) - 1, ks))
        self.has_keywords = bool(owners)
        if owners:
            self.automaton.make_automaton()

    def spans(self, raw: bytes) -> list[tuple[int, int, int]]:
        """(start, rule number, stop) in code points, in order."""
        starts: list[list[int]] = [[] if r.keywords else hex_anchors(raw) for r, _ in self.rules]
        if self.has_keywords:
            # one character per byte: places in the automaton are byte offsets
            for end, (back, ks) in self.automaton.iter(raw.translate(LOWER).decode("latin-1")):
                for k in ks:
                    starts[k].append(end - back)
        found = []
        for k, ((rule, pattern), places) in enumerate(zip(self.rules, starts)):
            free = 0
            for at in sorted(places):
                if at < free:
                    continue
                m = pattern.match(raw, at)
                if m is None:
                    continue
                free = m.end()
                value = m.group(rule.group)
                if len(value) >= rule.least and (rule.check is None or rule.check(value)):
                    found.append((m.start(rule.span), k, m.end(rule.span)))
        if found and not raw.isascii():
            # code points before a byte: bytes that do not continue another
            heads = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
            found = [(int(heads[a]), k, int(heads[b])) for a, k, b in found]
        return sorted(found)


def find_secrets(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "secrets") -> DataFrame:
    """``docs`` without the text, plus ``out``: an array of (kind, start, stop) in code points.

    The array is ordered by start, then by the order of ``rules``. Null and
    empty texts hold nothing; repeated rows, null ids and all other columns
    stay; an existing column ``out`` is replaced; an empty table gives no rows.
    Matches of one rule do not overlap, those of different rules may.
    """
    keep = [c for c in docs.columns if c.lower() not in (out.lower(), text_col.lower())]
    text = fresh_name([*keep, out], "_text")
    given = docs.select(*[F.col(f"`{c}`") for c in keep], text_or_empty(text_col).alias(text))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).withColumn(out, F.lit(None).cast(KIND)).schema
    kinds = [r.kind for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        for b in slices(batches):
            rows = [
                [{"kind": kinds[k], "start": at, "stop": stop} for at, k, stop in scanner.spans(t)]
                for t in utf8_values(b.column(len(keep)))
            ]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(rows, arrow)], names=[*keep, out])

    return given.mapInArrow(run, schema)


def spans_text(spans: Column) -> Column:
    """``kind:start:stop`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def mask_secrets(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; spans that overlap or touch share one mark. A null text stays null."""
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    schema = docs.withColumn(docs.columns[at], F.col(f"`{text_col}`").cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for b in slices(batches):
            texts = b.column(at).to_pylist()
            masked = [None if t is None else masked_text(t, scanner.spans(t.encode()), mark) for t in texts]
            columns = list(b.columns)
            columns[at] = pa.array(masked, b.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return docs.select(*[F.col(f"`{c}`").cast("string").alias(c) if i == at else F.col(f"`{c}`") for i, c in enumerate(docs.columns)]).mapInArrow(run, schema)


def masked_text(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, done, open_to = [], 0, -1
    for start, _, stop in spans:  # in order of start
        if start > open_to:
            out += [text[done:start], mark] if start >= done else [mark]
        open_to = max(open_to, stop)
        done = max(done, stop)
    return "".join([*out, text[done:]])
