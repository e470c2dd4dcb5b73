"""Personal data in whole texts, through disguises, with spans in the source text.

Base kinds are fixed patterns on the text itself. A text that can hold a
disguise is then rewritten by transducers: one character at a time
(homoglyphs, full-width forms, look-alike digits, zero-width characters, odd
dots, dashes and spaces), then word by word (spelled digits, "at" and "dot" in
their disguises). Every output character keeps the source span it came from,
so what the same detectors find in the rewritten text maps back to source
offsets. A span found so is added unless it overlaps a base span of any kind
or an added one; base spans always stay.

A word "at" or "dot" without brackets, and spelled digits, are everyday words,
so they count only inside a whole identifier: name AT host DOT suffix, each
written with a marker, or a run of digits that passes the checks of its kind.

Null and empty texts hold nothing; repeated rows are judged one by one.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_TAIL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping addresses: the run of name characters before each at sign, and the host behind it."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL_TAIL.match(text, start - 1):
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            found.append((start, host.end()))
        done = host.end() if host else at + 1
        at = text.find("@", done)
    return found


def ips(text: str) -> list[Span]:
    # a part may start inside a run of digits only behind an earlier match, which ends runs
    return [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m[0])) <= 15]


def base_spans(text: str) -> dict[str, list[Span]]:
    some = _DIGIT.search(text) is not None
    return {
        "email": emails(text) if "@" in text else [], "ip": ips(text) if some else [],
        "card": cards(text) if some else [], "phone": phones(text) if some and "+" in text else [],
    }


# Look-alikes of ASCII letters in Cyrillic and Greek.
_LOOK_ALIKE = dict(zip(
    "АВЕКМНОРСТХУІЈЅаеорсухіјѕһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαοντρυ",
    "ABEKMHOPCTXYIJSaeopcyxijshdqwABEZHIKMNOPTYXaovtpu",
))
_DROPPED = dict.fromkeys(map(chr, (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)), "")
_PUNCTUATION = {**dict.fromkeys("‐‑‒–—―−", "-"), **dict.fromkeys("․。．・", "."), **dict.fromkeys("＠﹫", "@"), **dict.fromkeys("＋﬩﹢", "+")}


def _one(char: str) -> str:
    """The ASCII form of a character, or itself."""
    for table in (_LOOK_ALIKE, _DROPPED, _PUNCTUATION):
        if char in table:
            return table[char]
    if (digit := unicodedata.digit(char, None)) is not None:
        return str(digit)
    if char.isspace():
        return " "
    plain = unicodedata.normalize("NFKC", char)
    return plain if len(plain) == 1 and plain.isascii() else char


_single: dict[str, str] = {}

# Spelled digits of the corpus languages.
_SPELLED = {
    word: str(d) for words in (
        "zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve",
    ) for d, word in enumerate(words.split())
} | {"oh": "0"}
_OPEN, _CLOSE = r"[\[({<]\s*", r"\s*[\])}>]"
_MARKS = "|".join((
    rf"(?P<at>\s*{_OPEN}(?:at|arroba|arobase|ät|@){_CLOSE}\s*|\s+(?:at|arroba|arobase)\s+)",
    rf"(?P<dot>\s*{_OPEN}(?:dot|punkt|point|punto|\.){_CLOSE}\s*|\s+(?:dot|punkt|point|punto)\s+)",
    rf"(?P<dash>\s*{_OPEN}(?:dash|hyphen|minus|-){_CLOSE}\s*|\s+(?:dash|hyphen)\s+)",
    rf"(?P<plus>\s*{_OPEN}plus{_CLOSE}\s*|\bplus\s+(?=[0-9]|(?:{'|'.join(_SPELLED)})\b))",
    rf"(?P<digits>(?<!\w)(?:{'|'.join(sorted(_SPELLED, key=len, reverse=True))})(?!\w))",
))
_MARK = re.compile(_MARKS, re.IGNORECASE)
_SIGN = {"at": "@", "dot": ".", "dash": "-", "plus": "+"}
# Letters written for digits between digits, as in 4l11 or 4O12.
_DIGIT_LIKE = re.compile(r"(?<=[0-9])[OoIl](?=[0-9OoIl\s-])|(?<=[0-9][ -])[OoIl](?=[0-9])")
_SPOKEN_RUN = re.compile(r"(?<=[0-9])[ ](?=[0-9])")


class Mapped:
    """A rewritten text and, for each of its characters, the source span."""

    def __init__(self, text: str, starts: list[int] | None = None, ends: list[int] | None = None):
        self.text = text
        self.starts = list(range(len(text))) if starts is None else starts
        self.ends = list(range(1, len(text) + 1)) if ends is None else ends

    def rewrite(self, edits: Iterator[tuple[int, int, str]]) -> Mapped:
        """Replace [start, end) by a string, for ascending disjoint edits; all its characters get the whole source span."""
        out, starts, ends, at = [], [], [], 0
        for s, e, new in edits:
            out.append(self.text[at:s])
            starts += self.starts[at:s]
            ends += self.ends[at:s]
            out.append(new)
            if new:
                starts += [self.starts[s]] * len(new)
                ends += [self.ends[e - 1]] * len(new)
            at = e
        out.append(self.text[at:])
        return Mapped("".join(out), starts + self.starts[at:], ends + self.ends[at:])

    def source(self, span: Span) -> Span:
        return self.starts[span[0]], self.ends[span[1] - 1]


def characters(source: Mapped) -> Mapped:
    """The character transducer."""
    changed = "".join(c for c in set(source.text) if _single[c] != c)
    if not changed:
        return source
    return source.rewrite((m.start(), m.end(), _single[m[0]]) for m in re.finditer(f"[{re.escape(changed)}]", source.text))


def words(source: Mapped) -> Mapped:
    """The word transducer: markers become signs, spelled digits become digits."""
    def edit(m):
        kind = m.lastgroup
        return m.start(), m.end(), _SIGN.get(kind) or _SPELLED[m[0].lower()]

    out = source.rewrite(map(edit, _MARK.finditer(source.text)))
    return out.rewrite((m.start(), m.end(), "0" if m[0] in "Oo" else "1") for m in _DIGIT_LIKE.finditer(out.text))


# What any marker or spelled digit needs around it before it can be part of an identifier.
_DOT = r"(?:dot|punkt|point|punto)\b"
_WORD = "|".join(sorted(_SPELLED, key=len, reverse=True))
_HINTS = [re.compile(p, re.IGNORECASE) for p in (
    rf"\b(?:at|arroba|arobase|ät)\b\s*[\])}}>]?\s*[\w-]+\s*(?:[\[({{<]?\s*{_DOT}|[\[({{<]\s*\.|\.\w)",
    rf"@\s*[\])}}>]?\s*[\w-]+\s*(?:{_DOT}|[\[({{<])",
    rf"[\[({{<]\s*@",
    rf"[0-9]\s*(?:[\[({{<]\s*(?:{_DOT}|\.|-|dash|hyphen|minus)|{_DOT}|(?:dash|hyphen)\b)",
    rf"\b(?:{_WORD})[\s.,-]+(?:{_WORD}|[0-9])",
    rf"[0-9][\s.,-]+(?:{_WORD})\b",
    r"\bplus\b\s*[\])}>]?\s*[0-9]",
    r"[0-9][ -]?[OoIl][0-9OoIl\s-]",
)]


_LETTER = re.compile(r"[A-Za-z]")


def _plausible(kind: str, mapped: Mapped, span: Span, source: str) -> bool:
    """A disguise of everyday words must be a whole identifier."""
    s, e = mapped.source(span)
    raw = source[s:e]
    if kind != "email":
        return True
    host = mapped.text[span[0]:span[1]].rpartition("@")[2]
    spoken = re.search(r"\s(?:at|arroba|arobase)\s", raw, re.IGNORECASE)
    # "seen at example.com" is prose: a spoken "at" counts only with a spoken or bracketed dot
    return bool(_LETTER.search(host.rpartition(".")[2])) and (not spoken or bool(re.search(r"\s(?:dot|punkt|point|punto)\s|[\[({<]", raw, re.IGNORECASE)))


def all_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(base spans, base and disguised spans) of a text, by kind."""
    base = base_spans(text)
    every = {kind: list(spans) for kind, spans in base.items()}
    chars = set(text)
    for char in chars - _single.keys():
        _single[char] = _one(char)
    changes = any(_single[c] != c for c in chars)
    if not changes and not any(h.search(text) for h in _HINTS):
        return base, every
    # spans found so far: of each kind, sorted and apart from each other
    taken = {kind: ([s for s, _ in sorted(spans)], [e for _, e in sorted(spans)]) for kind, spans in base.items()}
    plain = characters(Mapped(text))
    forms = [plain] if changes else []
    if any(h.search(plain.text) for h in _HINTS):
        spoken = words(plain)
        forms += spoken, spoken.rewrite((m.start(), m.end(), "") for m in _SPOKEN_RUN.finditer(spoken.text))
    for form in forms:
        for kind, spans in base_spans(form.text).items():
            for span in spans:
                s, e = form.source(span)
                met = {k: (bisect_right(ends, s), bisect_left(starts, e)) for k, (starts, ends) in taken.items()}
                own, (starts, ends) = slice(*met[kind]), taken[kind]
                apart = all(low >= high for k, (low, high) in met.items() if k != kind)
                free = own.start >= own.stop
                wider = kind == "email" and not free and s <= starts[own.start] and ends[own.stop - 1] <= e and (starts[own], ends[own]) != ([s], [e])
                if apart and (free or wider) and _plausible(kind, form, span, text):
                    # a wider span stands for those inside of it
                    own = slice(own.start, max(own.start, own.stop))
                    starts[own], ends[own] = [s], [e]
                    every[kind].append((s, e))
    return base, {kind: sorted(spans) for kind, spans in every.items()}


def _listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in spans[kind])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, base_sha256 of the base spans and all spans, of every row."""

    def run(batches):
        for batch in batches:
            counts, digests, spans = [[] for _ in KINDS], [], []
            for text in batch.column("text"):
                base, every = all_spans(text.as_py() or "")
                for kind, column in zip(KINDS, counts):
                    column.append(len(base[kind]))
                digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                spans.append(_listed(every))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                                             names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = "doc_id long, " + "".join(f"n_{k} long, " for k in KINDS) + "base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def redact(text: str) -> str:
    """The text with every span replaced by its kind; of overlapping spans the leftmost, then longest, names it."""
    _, every = all_spans(text)
    out, at = [], 0
    for s, e, kind in sorted((s, -e, kind) for kind, spans in every.items() for s, e in spans):
        e = -e
        if e <= at:
            continue
        if s >= at:
            out += text[at:s], f"[{kind.upper()}]"
        at = e
    return "".join(out) + text[at:] if out else text


def redact_documents(docs: DataFrame) -> DataFrame:
    """docs with personal data in ``text`` replaced and ``n_chars``, where there is one, counted anew; a null text stays null."""

    def run(batches):
        for batch in batches:
            text = [None if t is None else redact(t) for t in batch.column("text").to_pylist()]
            new = {"text": pa.array(text, batch.column("text").type)}
            if "n_chars" in batch.schema.names:
                old = batch.column("n_chars")
                new["n_chars"] = pa.array([n if t is None else len(t) for t, n in zip(text, old.to_pylist())], old.type)
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
