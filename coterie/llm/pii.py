"""Personal data in texts, plain and disguised, with spans in the source text.

Plain forms are found as the contract states them. For disguised ones a chain of transducers rewrites the text and
keeps, for every character it writes, the stretch of source characters that it came from: look-alike
letters and digits become their ASCII forms, spelled digits become digits, and written-out "at" and "dot" become
their signs. What is then found is mapped back, and added where no plain span of its kind overlaps.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns. Possessive repeats and look-behinds change no match, only the time on
# texts that almost match.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_NUMERALS = frozenset("0123456789")

# Cyrillic and Greek letters that look like Latin ones.
LOOK_ALIKES = dict(zip(
    "аеорсухіјѕԁԛԝһАВЕКМНОРСТУХІЈЅαορνυικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdqwhABEKMHOPCTYXIJSaopvuikABEZHIKMNOPTYX",
))
# English digit words.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
}
_WORDS = "|".join(sorted(SPELLED, key=len, reverse=True))
# One spelled digit or more in a row. Fewer than three are ordinary words, unless a number, a plus or a dot adjoins.
_SPELLED = re.compile(rf"(?<![A-Za-z])(?:{_WORDS})(?:[\x20,.-]{{1,2}}(?:{_WORDS}))*(?![A-Za-z])", re.I)
_SPELLED_ONE = re.compile(rf"(?:{_WORDS})", re.I)
_PLUS = re.compile(r"(?:\bplus|\+)\x20\Z", re.I)
_OPEN, _CLOSE = r"[\(\[\{<]", r"[\)\]\}>]"
_BRACKET_AT = rf"[\x20]?{_OPEN}[\x20]?(?:at|@)[\x20]?{_CLOSE}[\x20]?"
_BRACKET_DOT = rf"[\x20]?{_OPEN}[\x20]?(?:dot|\.)[\x20]?{_CLOSE}[\x20]?"
_DOT_SIGN = rf"{_BRACKET_DOT}|\x20dot\x20"
_BEFORE_NUMBER = re.compile(rf"(?:[0-9][\x20().-]{{0,3}}|\bplus\x20|\+\x20?|{_DOT_SIGN})\Z", re.I)
_AFTER_NUMBER = re.compile(rf"[\x20().-]{{0,3}}[0-9]|{_DOT_SIGN}", re.I)
_BETWEEN_NUMBERS = re.compile(r"[\x20().-]{0,3}")
_AT = re.compile(_BRACKET_AT, re.I)
_DOT = re.compile(_BRACKET_DOT, re.I)
# Bare words and signs set off by blanks count only together with another sign: name at host dot tld.
_ANY_AT = re.compile(rf"{_BRACKET_AT}|\x20at\x20|\x20?@\x20?", re.I)
_HOST = re.compile(rf"[A-Za-z0-9-]++(?:(?:{_DOT_SIGN}|\.)[A-Za-z0-9-]++)+", re.I)
_DISGUISED_DOT = re.compile(_DOT_SIGN, re.I)
_BEFORE_DOT = re.compile(rf"(?:{_DOT_SIGN})\Z", re.I)
_BARE_DOT = re.compile(r"\x20dot\x20", re.I)
_NUMBER_DOT = re.compile(r"(?<=[0-9])\x20dot\x20(?=[0-9])", re.I)
_AT_HINT = re.compile(r"[\(\[\{<]\x20?(?:at|@|dot|\.)\x20?[\)\]\}>]|\x20dot\x20", re.I)
# Characters that the first transducer rewrites, apart from those that NFKC turns into ASCII.
_ODD = re.compile("[" + "".join(LOOK_ALIKES) + "​-‍⁠﻿­²³¹⁰-₎‐-―․−①-⓿！-～\U0001d400-\U0001d7ff]")
_UNSEEN = frozenset("​‌‍⁠﻿­")
_DASHES = frozenset("‐‑‒–—―−")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @, as the local part cannot hold one and so every match has exactly one."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` of the plain forms; kinds are places in KINDS."""
    out = [(i, j, 0) for i, j in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                    out.append((*m.span(), 1))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((*m.span(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append((*m.span(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


class Mapped:
    """A rewritten text with, for chosen characters, the source stretch they stand for.

    Between two rewritten stretches the characters are copies, so only the rewrites are kept: where each begins
    and ends here and in the source.
    """

    def __init__(self, text: str):
        self.text = text
        self.edits: list[tuple[int, int, int, int]] = []  # here from, to; source from, to

    def rewrite(self, changes: list[tuple[int, int, str]]) -> "Mapped":
        """Apply ordered ``(start, end, new)`` to this text; the result maps to the source of this one."""
        if not changes:
            return self
        out, parts, at, length, old = Mapped(""), [], 0, 0, 0
        for i, j, new in changes:
            shift = length - at
            while old < len(self.edits) and self.edits[old][1] <= i:
                a, b, s, t = self.edits[old]
                if a >= at:
                    out.edits.append((a + shift, b + shift, s, t))
                old += 1
            parts += [self.text[at:i], new]
            length += i - at
            out.edits.append((length, length + len(new), self.source(i), self.source_end(j)))
            length += len(new)
            at = j
        shift = length - at
        out.edits += [(a + shift, b + shift, s, t) for a, b, s, t in self.edits[old:] if a >= at]
        parts.append(self.text[at:])
        out.text = "".join(parts)
        return out

    def _edit(self, at: int):
        k = bisect_right(self.edits, at, key=lambda e: e[0]) - 1
        return self.edits[k] if k >= 0 else (0, 0, 0, 0)

    def source(self, at: int) -> int:
        """The source place where the character ``at`` begins."""
        a, b, s, t = self._edit(at)
        return s if a <= at < b else t + at - b

    def source_end(self, end: int) -> int:
        """The source place where the character before ``end`` ends."""
        if end == 0:
            return 0
        a, b, s, t = self._edit(end - 1)
        return t if a <= end - 1 < b else t + end - b


def _plain_character(c: str) -> str:
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    if c in _UNSEEN:
        return ""
    if c in _DASHES:
        return "-"
    if c == "․":
        return "."
    simple = unicodedata.normalize("NFKC", c)
    return simple if simple.isascii() else c


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Changes of the spelled digits: three in a row or more, and fewer beside a number, a plus or a dot."""
    runs = list(_SPELLED.finditer(text))
    good = [len(_SPELLED_ONE.findall(m[0])) >= 3 for m in runs]
    for k, m in enumerate(runs):
        good[k] = good[k] or bool(_BEFORE_NUMBER.search(text, max(0, m.start() - 8), m.start()) or _AFTER_NUMBER.match(text, m.end()))
    # A run is a number to the runs beside it.
    for order in (range(1, len(runs)), range(len(runs) - 2, -1, -1)):
        for k in order:
            other = k - 1 if order.step > 0 else k + 1
            i, j = sorted((k, other))
            if good[other] and not good[k]:
                good[k] = bool(_BETWEEN_NUMBERS.fullmatch(text, runs[i].end(), runs[j].start()))
    changes = []
    for run, wanted in zip(runs, good):
        if not wanted:
            continue
        at = run.start()
        # A written-out or detached plus belongs to the number.
        if m := _PLUS.search(text, max(0, at - 5), at):
            changes.append((*m.span(), "+"))
        # Beside a number and its dot, dots part numbers.
        dotted = (at > 1 and text[at - 1] == "." and text[at - 2] in _NUMERALS) or (
            text[run.end() : run.end() + 1] == "." and text[run.end() + 1 : run.end() + 2] in _NUMERALS
        )
        for m in _SPELLED_ONE.finditer(text, run.start(), run.end()):
            if run.start() < at < m.start() and not (dotted and text[at : m.start()] == "."):
                changes.append((at, m.start(), ""))
            changes.append((m.start(), m.end(), SPELLED[m[0].lower()]))
            at = m.end()
    return changes


def _mixed_mails(text: str) -> list[tuple[int, int, str]]:
    """Changes of the bare words in mail addresses with any mix of signs; around each at, as in plain ones."""
    changes, done = [], 0
    at = _ANY_AT.search(text)
    while at:
        host = _HOST.match(text, at.end()) if at.start() > done and text[at.start() - 1] in _LOCAL else None
        # A plain or bracketed at settles what it is; other ones need a dot in disguise: "look at mail.org" is prose.
        sure = at[0] == "@" or any(c in "([{<" for c in at[0])
        disguised = host and _DISGUISED_DOT.search(text, *host.span())
        if host and (disguised or (sure and at[0] != "@")):
            start = at.start()
            while True:
                while start > done and text[start - 1] in _LOCAL:
                    start -= 1
                m = _BEFORE_DOT.search(text, max(done, start - 9), start)
                if not m or m.start() == done or text[m.start() - 1] not in _LOCAL:
                    break
                if _BARE_DOT.fullmatch(m[0]):
                    changes.append((*m.span(), "."))
                start = m.start()
            if not sure or at[0] == "@":
                changes.append((*at.span(), "@"))
            changes += [(*m.span(), ".") for m in _BARE_DOT.finditer(text, *host.span())]
            done = host.end()
            at = _ANY_AT.search(text, done)
        else:
            # The blank behind may stand before the next one.
            at = _ANY_AT.search(text, at.end() - (text[at.end() - 1] == " "))
    return changes


def deobfuscate(text: str) -> Mapped:
    """The text after the three transducers; the same object without edits if nothing applies."""
    out = Mapped(text)
    if not text.isascii():
        out = out.rewrite([(m.start(), m.end(), _plain_character(m[0])) for m in _ODD.finditer(text)])
    out = out.rewrite(_spelled(out.text))
    if _AT_HINT.search(out.text):
        changes = [(m.start(), m.end(), "@") for m in _AT.finditer(out.text)]
        changes += [(m.start(), m.end(), ".") for m in _DOT.finditer(out.text)]
        changes += [(m.start(), m.end(), ".") for m in _NUMBER_DOT.finditer(out.text)]
        changes += _mixed_mails(out.text)
        changes.sort()
        kept = []
        for c in changes:
            if not kept or c[0] >= kept[-1][1]:
                kept.append(c)
        out = out.rewrite(kept)
    return out


def find(text: str) -> tuple[list, list]:
    """The plain spans and all spans, each ``(start, end, kind)`` by start, then kind."""
    plain = plain_spans(text)
    clear = deobfuscate(text)
    if not clear.edits:
        return plain, plain
    taken = {k: sorted((s, e) for s, e, kind in plain if kind == k) for k in range(len(KINDS))}
    added = []
    starts = [a for a, *_ in clear.edits]
    for i, j, kind in plain_spans(clear.text):
        # Only what a rewrite has touched is new.
        k = bisect_right(starts, j - 1)
        if not any(e[1] > i or e[0] >= i for e in clear.edits[max(0, k - 1) : k]):
            continue
        s, e = clear.source(i), clear.source_end(j)
        at = bisect_right(taken[kind], (e,)) - 1
        if at >= 0 and taken[kind][at][1] > s:
            continue
        added.append((s, e, kind))
    return plain, sorted(plain + added, key=lambda s: (s[0], s[2]))


def as_text(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{i}:{j}" for i, j, k in spans)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [find(t.as_py() or "") for t in batch.column("text")]
        counts = {f"n_{n}": pa.array([sum(s[2] == k for s in r[1]) for r in rows], pa.int64()) for k, n in enumerate(KINDS)}
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), **counts,
            "base_sha256": pa.array([hashlib.sha256(as_text(r[0]).encode()).hexdigest() for r in rows], pa.string()),
            "spans": pa.array([as_text(r[1]) for r in rows], pa.string()),
        })


def personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``, one row for each row of ``docs (doc_id, text)``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start, then kind; counts are of all spans, plain
    and disguised. Null and empty texts have none. Other columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _found, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )
