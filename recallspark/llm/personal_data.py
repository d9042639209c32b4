"""Personal data: identifiers found as written, and through disguises undone with their offsets kept."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recallspark.llm.batches import pieces, texts

#: Kinds in the order of the result, digits of cards and phones.
KINDS = ["email", "ip", "card", "phone"]
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# addresses lie within runs of digits and dots and start at the first digit of a run of digits
_DOTTED = re.compile(r"[0-9][0-9.]{6,}")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")

#: Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "ο": "o", "α": "a", "ν": "v", "ι": "i", "κ": "k", "ρ": "p", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I",
    "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
}
#: Characters without width, and the names of the digits.
INVISIBLE = "​‌‍⁠﻿­"
DIGIT_NAMES = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and domain: from each @, back over the run of local characters before it."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at) if start < at else None
        free = found.end() if found else at + 1
        if found:
            yield start, free
        at = text.find("@", free)


def find_plain(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the identifiers as written, leftmost and not overlapping per kind.

    A match that fails its check (parts of an address over 255, digits and check sum of a card,
    digits of a phone number) is dropped and not tried again from a later place.
    """
    found = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    for run in _DOTTED.finditer(text):
        for m in _IP.finditer(run[0]):
            parts = (p.lstrip("0") for p in m[0].split("."))
            if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts):
                found.append((run.start() + m.start(), run.start() + m.end(), "ip"))
    for m in _CARD.finditer(text):
        if len(m[0]) >= CARD_DIGITS[0]:
            digits = _NO_DIGIT.sub("", m[0])
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_NO_DIGIT.sub("", m[0])) <= PHONE_DIGITS[1]:
                found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


@lru_cache(maxsize=1)
def _single() -> dict[str, str]:
    """One character -> its plain form: lookalikes, decimal digits of all scripts, compatibility forms."""
    plain = dict(LOOKALIKES) | {c: "" for c in INVISIBLE}
    for code in range(0x80, 0x20000):
        c = chr(code)
        if unicodedata.category(c) == "Nd":
            plain[c] = str(unicodedata.decimal(c))
        elif code >= 0x2000 and c not in plain:
            form = unicodedata.normalize("NFKC", c)
            if len(form) == 1 and "!" <= form <= "~":
                plain[c] = form
    return plain


_NAME = "|".join(DIGIT_NAMES)
_NAMES = frozenset(DIGIT_NAMES)
_BRACKETED = re.compile(r"[(\[{<]\s*at\s*[)\]}>]", re.I)
Change = tuple[int, int, str]


def _in_disguise(text: str) -> bool:
    """Whether any transducer could apply: cheap looks that let most texts pass by."""
    low = text.lower()
    return ("dot" in low or "(" in low and bool(_BRACKETED.search(low)) or any(c in low for c in "[{<") and bool(_BRACKETED.search(low))
            or not text.isascii() and not _single().keys().isdisjoint(set(text))
            or not _NAMES.isdisjoint(low.replace("-", " ").split()))


@lru_cache(maxsize=1)
def transducers() -> list[tuple[re.Pattern, Callable[[re.Match], list[Change]]]]:
    """Each a pattern and the changes ``(start, end, plain text)`` that a match of it stands for."""
    single = _single()
    dots = re.compile(r"\s*[(\[{<]\s*dot\s*[)\]}>]\s*|\s+dot\s+", re.I)
    label, dot = "[A-Za-z0-9-]+", r"(?:\s*[(\[{<]\s*dot\s*[)\]}>]\s*|\s+dot\s+|\.)"

    def digits(m: re.Match) -> list[Change]:
        names = list(re.finditer(_NAME, m[0], re.I))
        ends = [n.end() for n in names[:-1]] + [len(m[0])]
        begins = [0] + ends[:-1]  # a name takes what separates it from the name before
        return [(m.start() + a, m.start() + b, str(DIGIT_NAMES.index(n[0].lower()))) for a, b, n in zip(begins, ends, names)]

    def address(m: re.Match) -> list[Change]:
        at = m.start("domain")
        return [(*m.span("at"), "@")] + [(at + d.start(), at + d.end(), ".") for d in dots.finditer(m["domain"])]

    return [
        (re.compile("[" + re.escape("".join(single)) + "]"), lambda m: [(*m.span(), single[m[0]])]),
        # three or more digit names in a row
        (re.compile(rf"\b(?:{_NAME})(?:[\s-]+(?:{_NAME})){{2,}}\b", re.I), digits),
        # (at) and its like may go with plain dots, a bare word "at" only with a dot in disguise
        (re.compile(rf"(?P<at>(?<=[A-Za-z0-9._%+-])\s*[(\[{{<]\s*at\s*[)\]}}>]\s*)(?P<domain>{label}(?:{dot}{label})+)", re.I), address),
        (re.compile(rf"(?P<at>(?<=[A-Za-z0-9._%+-])(?:\s+at\s+|@))(?P<domain>{label}(?:\s*[(\[{{<]\s*dot\s*[)\]}}>]\s*|\s+dot\s+)"
                    rf"{label}(?:{dot}{label})*)", re.I), address),
        # dots in disguise between the digits of an address
        (re.compile(r"(?<=[0-9])(?:\s*[(\[{<]\s*dot\s*[)\]}>]\s*|\s+dot\s+)(?=[0-9])", re.I), lambda m: [(*m.span(), ".")]),
    ]


def deobfuscate(text: str) -> tuple[str, list[int], list[int]] | None:
    """``(plain, starts, ends)``: the text without disguises, and where each of its characters came from.

    None if nothing was changed. The transducers run one after the other, each on the output of
    the one before; the offsets always lead back to the text that came in.
    """
    if not _in_disguise(text):
        return None
    starts = ends = None
    for pattern, stands_for in transducers():
        changes = [c for m in pattern.finditer(text) for c in stands_for(m)]
        if not changes:
            continue
        if starts is None:
            starts, ends = list(range(len(text))), list(range(1, len(text) + 1))
        out, new_starts, new_ends, at = [], [], [], 0
        for a, b, plain in changes:
            out += [text[at:a], plain]
            new_starts += starts[at:a] + [starts[a]] * len(plain)
            new_ends += ends[at:a] + [ends[b - 1]] * len(plain)
            at = b
        text = "".join(out) + text[at:]
        starts, ends = new_starts + starts[at:], new_ends + ends[at:]
    return None if starts is None else (text, starts, ends)


def find(text: str) -> list[tuple[int, int, str, bool]]:
    """``(start, end, kind, plain)`` by start, then kind: all plain spans and the disguised ones they don't touch."""
    plain = find_plain(text)
    spans = [(*s, True) for s in plain]
    undone = deobfuscate(text)
    if undone:
        clean, starts, ends = undone
        taken = {k: [(a, b) for a, b, kind in plain if kind == k] for k in KINDS}
        for a, b, kind in find_plain(clean):
            begin, end = starts[a], ends[b - 1]
            own = taken[kind]
            i = bisect_right(own, (end, -1)) - 1  # the last plain span that starts before the end
            if i < 0 or own[i][1] <= begin:
                spans.append((begin, end, kind, False))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: for every row the array of ``kind, start, end, plain, found`` of its whole text.

    Offsets count code points of the text as it is, the end is exclusive; ``found`` is the source
    text of the span, ``plain`` is false for those that only show once disguises are undone. Null
    and empty texts have no spans. One row per input row, no shuffle; other columns are ignored.
    """
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_()), ("found", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            spans = [[{"kind": k, "start": a, "end": b, "plain": p, "found": text[a:b]} for a, b, k, p in find(text)] for text in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(spans, pa.list_(item))], names=["doc_id", "spans"])

    plain = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return plain.mapInArrow(run, "doc_id long, spans array<struct<kind string, start long, end long, plain boolean, found string>>")


def span_digest(spans: DataFrame) -> DataFrame:
    """Counts per kind of the plain spans, their hash, and all spans as text (kind:start:end, comma-joined)."""
    joined = lambda column: F.array_join(F.transform(column, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    plain = F.filter("spans", lambda s: s.plain)
    of_kind = lambda kind: F.filter("spans", lambda s: s.plain & (s.kind == F.lit(kind)))
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return spans.select("doc_id", *counts, F.sha2(joined(plain), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
