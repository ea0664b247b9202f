"""Personal data in texts, disguised or not, with spans in the source text.

Plain identifiers (e-mail, IPv4, card, phone) are found by pattern. Then a
chain of transducers rewrites the text: zero-width characters go, look-alike
characters become ASCII, spelled-out digits become digits, and "at"/"dot"
disguises become the signs. Every rewrite keeps, per output character, the
source range it came from, so that an identifier found in the rewritten text
maps back to code points of the source. Such spans are added when they do not
overlap a plain one.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can start only where a run of digits starts, so longer runs are not tried again from within.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the pattern, found from each @ so that long runs without one cost nothing."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[Span]:
    """Plain identifiers by kind, then start. Matches that fail their check are dropped and not retried."""
    out: list[Span] = [("email", a, b) for a, b in emails(text)]
    if not re.search(r"[0-9]", text):
        return out
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NON_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NON_DIGIT.sub("", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# Characters that look like ASCII ones.
_CYRILLIC = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТХІЈЅ", "aeopcyxijshdqwABEKMHOPCTXIJS", strict=True))
_GREEK = dict(zip("οαενρτυικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "oaevptuikABEZHIKMNOPTYX", strict=True))
_SIGNS = dict(zip("․。．·‐‑‒–—−﹣－＋﹢＠﹫（）　", "....------" + "--" + "++@@() ", strict=True))
_WIDE = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
_DIGITS = {chr(zero + d): str(d) for zero in (0x660, 0x6F0, 0x966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for d in range(10)}
LOOKALIKE = {**_WIDE, **_CYRILLIC, **_GREEK, **_SIGNS, **_DIGITS}
ZERO_WIDTH = "​‌‍⁠﻿­"

# Spelled digits.
SPELLED = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
_ONE = "|".join(sorted(SPELLED, key=len, reverse=True))
_SPELLED_RUN = re.compile(rf"(?<!\w)(?:{_ONE})(?:(?:[ ,.\-]{{1,2}})(?:{_ONE}|[0-9]))+(?!\w)", re.I)
_SPELLED_ONE = re.compile(rf"{_ONE}", re.I)
_HIDDEN = re.compile("[" + re.escape("".join(LOOKALIKE)) + ZERO_WIDTH + "]")

_AT = r"\s*(?:[\[({<]\s*(?:at|@|arroba|arobase|ät)\s*[\])}>]|&#0*64;|&#x40;|&commat;)\s*"
_DOT = r"\s*(?:[\[({<]\s*(?:dot|\.|punkt|point|punto)\s*[\])}>]|&#0*46;|&#x2e;|&period;)\s*"
_PLAIN_DOT = r"\s+(?:dot|punkt|punto)\s+"
#: Endings that a disguise in plain words ("x at y dot com") must have.
_ENDINGS = r"com|org|net|edu|gov|info|io|de|fr|es|it|nl|eu|uk|us|ca|ch|at"
_PART = r"[A-Za-z0-9-]+"
#: Words that are no host after a plain "at".
_NO_HOST = r"(?!(?:the|an?|this|that|my|our|your|his|her|their|its|all|any|some|every)\s)"
_MARKED = re.compile(rf"(?:(?<=[A-Za-z0-9_%+-])(?P<at>{_AT})(?=[A-Za-z0-9]))|(?:(?<=[A-Za-z0-9])(?P<dot>{_DOT})(?=[A-Za-z0-9]))", re.I)
_WORDS = re.compile(rf"(?<=[A-Za-z0-9_%+-])(?P<at>{_AT}|\s+at\s+{_NO_HOST}|@)(?P<host>{_PART}(?:(?:\.|{_DOT}|{_PLAIN_DOT}){_PART})*?(?:{_PLAIN_DOT})(?:{_ENDINGS}))(?![A-Za-z0-9])", re.I)
_ANY_DOT = re.compile(rf"{_DOT}|{_PLAIN_DOT}", re.I)
_MIXED_RUN = re.compile(r"(?<![A-Za-z0-9])\+?[0-9OoIlSB][0-9OoIlSB .()\-]{5,}[0-9OoIlSB](?![A-Za-z0-9])")
_MIXED = str.maketrans("OoIlSB", "001158")
_DIGIT = re.compile(r"[0-9]")

#: One edit: source start, end, replacement.
Edit = tuple[int, int, str]


class Offsets:
    """A text under rewriting; ``back[i]`` and ``ends[i]`` are the source range of its character i."""

    def __init__(self, text: str):
        self.text, self.back, self.ends = text, None, None

    def apply(self, edits: list[Edit]) -> None:
        if not edits:
            return
        back = self.back if self.back is not None else range(len(self.text))
        ends = self.ends if self.ends is not None else range(1, len(self.text) + 1)
        out, b, e, at = [], [], [], 0
        for start, end, new in edits:
            out += [self.text[at:start], new]
            b.extend(back[at:start])
            e.extend(ends[at:start])
            if end > start:
                b.extend([back[start]] * len(new))
                e.extend([ends[end - 1]] * len(new))
            at = end
        out.append(self.text[at:])
        b.extend(back[at:])
        e.extend(ends[at:])
        self.text, self.back, self.ends = "".join(out), b, e

    def source(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.back is None else (self.back[start], self.ends[end - 1])


def _look_alikes(text: str) -> list[Edit]:
    return [(m.start(), m.end(), LOOKALIKE.get(m[0], "")) for m in _HIDDEN.finditer(text)]


def _spelled(text: str) -> list[Edit]:
    """Each run of spelled digits becomes those digits; one edit per word keeps the offsets fine."""
    out = []
    for run in _SPELLED_RUN.finditer(text):
        last = run.start()
        for m in re.finditer(r"[^\W\d_]+|[0-9]", run[0]):
            start, end = run.start() + m.start(), run.start() + m.end()
            if start > last:
                out.append((last, start, ""))
            out.append((start, end, str(SPELLED[m[0].lower()]) if m[0].lower() in SPELLED else m[0]))
            last = end
    return out


def _disguises(text: str) -> list[Edit]:
    plain: list[Edit] = []
    for m in _WORDS.finditer(text):
        plain.append((m.start("at"), m.end("at"), "@"))
        plain += [(d.start(), d.end(), ".") for d in _ANY_DOT.finditer(text, m.start("host"), m.end("host"))]
    out, i = [], 0
    for m in _MARKED.finditer(text):  # both lists are in order, so one pass merges them
        while i < len(plain) and plain[i][1] <= m.start():
            out.append(plain[i])
            i += 1
        if i == len(plain) or plain[i][0] >= m.end():
            out.append((m.start(), m.end(), "@" if m["at"] else "."))
    return out + plain[i:]


def _mixed_digits(text: str) -> list[Edit]:
    """Letters that stand for digits, in runs that are digits for the most part."""
    out = []
    for m in _MIXED_RUN.finditer(text):
        if (new := m[0].translate(_MIXED)) != m[0] and 2 * len(_DIGIT.findall(m[0])) > len(_DIGIT.findall(new)):
            out += [(m.start() + i, m.start() + i + 1, y) for i, (x, y) in enumerate(zip(m[0], new, strict=True)) if x != y]
    return out


_TRANSDUCERS = (_look_alikes, _spelled, _disguises, _mixed_digits)


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Identifiers that show only after rewriting, mapped back; none overlaps a base span or another added one."""
    state = Offsets(text)
    for step in _TRANSDUCERS:
        state.apply(step(state.text))
    if state.back is None:
        return []
    out, taken = [], _merged([(a, b) for _, a, b in base])
    for kind, a, b in base_spans(state.text):
        start, end = state.source(a, b)
        i = bisect.bisect_left(taken, (end,))
        if not i or taken[i - 1][1] <= start:
            out.append((kind, start, end))
            taken.insert(i, (start, end))
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, base and added spans), each by kind as listed, then start."""
    base = base_spans(text)
    more = added_spans(text, base)
    return base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1])) if more else base


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, spans (array of kind, start, end, added).

    Needs doc_id and text; other columns are ignored. A null or empty text
    has no spans. Texts are read whole, whatever their length; repeated rows
    give repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                base, full = all_spans(text.as_py() or "")
                plain = set(base)
                rows.append([{"kind": s[0], "start": s[1], "end": s[2], "added": s not in plain} for s in full])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPANS)], names=["doc_id", "spans"])

    _SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))
    ids = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {ids}, spans array<struct<kind:string,start:bigint,end:bigint,added:boolean>>")


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find_pii``: counts of all spans per kind, base digest, all spans as text."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.concat_ws(",", F.transform(F.filter("spans", lambda s: ~s["added"]), one))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [of(k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), F.concat_ws(",", F.transform("spans", one)).alias("spans"))


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
            at = b
    return "".join(out) + text[at:]


def base_digest(text: str) -> str:
    return hashlib.sha256(_joined(base_spans(text)).encode()).hexdigest()
