"""Personal data: plain identifiers, and disguised ones found by offset-preserving deobfuscation.

Transducers rewrite a text into a normal form (homoglyphs and full-width signs to ASCII, zero-width signs dropped,
spelled digits to digits, ``(at)`` and ``dot`` to their signs) and keep, for each normal character, the stretch of the
source it came from. Identifiers found in the normal form are mapped back, so that every span is in code points of
the source. A transducer runs only on texts that hold something for it to rewrite.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import map_values

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_LONG_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9]){15}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]")

# fixed values: spelled digits, letters that look like ASCII ones, endings of domains, signs that are not seen
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9"}
LOOKALIKES = dict(zip(
    "АВЕКМНОРСТХаеорсухіјѕԁһԛԝӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρικոօսցհıɑɡ。",
    "ABEKMHOPCTXaeopcyxijsdhqwlABEZHIKMNOPTYXovpiknougbiag.", strict=True))
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "biz", "dev", "app", "xyz", "online", "[a-z]{2}")  # that bare words must lead to
HIDDEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
# compatibility forms that differ from an ASCII sign in style alone (superscripts and fractions mean something else)
STYLES = ("<font>", "<wide>", "<narrow>", "<small>", "<circle>")
LAST_STYLED = 0x1FBFF  # code points beyond have no such forms


def _styled() -> dict[str, str]:
    """Styled forms of ASCII signs, and the decimal digits of all scripts."""
    out = {}
    for sign in map(chr, range(128, LAST_STYLED + 1)):
        plain = unicodedata.normalize("NFKC", sign) if unicodedata.decomposition(sign).startswith(STYLES) else ""
        plain = str(unicodedata.decimal(sign, "")) or LOOKALIKES.get(plain, plain)
        if len(plain) == 1 and plain.isascii():
            out[sign] = plain
    return out


_ONE_SIGN = _styled() | LOOKALIKES | dict.fromkeys(HIDDEN, "")
# those of the basic plane one by one, and one range for all beyond, of which some stay as they are: quick to look up
_SIGNS = re.compile("[" + "".join(map(re.escape, sorted(s for s in _ONE_SIGN if s <= "\uffff"))) + f"\U00010000-{chr(LAST_STYLED)}]")
_DIGIT_WORD = "(?:" + "|".join(SPELLED) + ")"
_DOT_BETWEEN = r"\x20*[\[({<]\x20*(?:dot|\.)\x20*[\])}>]\x20*|\x20+dot\x20+|\."
_DIGIT_TOKEN = rf"(?:{_DIGIT_WORD}(?![A-Za-z])|[0-9]++)"
# digits as words, or as words and figures, with what parts them
_DIGIT_RUN = re.compile(
    rf"(?i)(?<![A-Za-z0-9@._%])(?:plus[\x20-]+)?{_DIGIT_TOKEN}(?:(?:{_DOT_BETWEEN}|,\x20*|[\x20-]+){_DIGIT_TOKEN})+(?![A-Za-z0-9@_%+])")
_DIGIT_PART = re.compile(
    rf"(?i)(?P<sign>plus)[\x20-]+|(?P<word>{_DIGIT_WORD})|(?P<figures>[0-9]+)|(?P<dot>{_DOT_BETWEEN})|(?P<gap>,\x20*|[\x20-]+)")
_HAS_DIGIT_WORD = re.compile(rf"(?i)(?<![A-Za-z]){_DIGIT_WORD}(?![A-Za-z])")
_LISTED_ENDING = rf"(?:{'|'.join(ENDINGS)})(?![A-Za-z0-9])"
_DISGUISED_AT = re.compile(
    r"(?i)(?<=[A-Za-z0-9])(?:\x20*[\[({<]\x20*at\x20*[\])}>]\x20*"
    rf"|\x20*[\[({{<]\x20*(?:a|@)\x20*[\])}}>]\x20*(?=(?:[A-Za-z0-9-]+\x20?(?:\.|dot)\x20?)+{_LISTED_ENDING})"
    rf"|\x20at\x20(?=(?:[A-Za-z0-9-]+\x20dot\x20)+{_LISTED_ENDING}))(?=[A-Za-z0-9])")
_BRACKETED_DOT = r"\x20*[\[({<]\x20*(?:dot|\.)\x20*[\])}>]\x20*"
_DISGUISED_DOT = re.compile(
    rf"(?i)(?<=[A-Za-z0-9])(?:{_BRACKETED_DOT}|\x20dot\x20|\x20\.\x20(?={_LISTED_ENDING}))(?=[A-Za-z0-9])")
_DOT_WITHOUT_AT = re.compile(rf"(?i)(?<=[A-Za-z0-9]){_BRACKETED_DOT}(?=[A-Za-z0-9])|(?<=[0-9])\x20dot\x20(?=[0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, looked for at the @ signs."""
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            past = domain.end()
            yield start, past
        at = text.find("@", max(at + 1, past))


def plain_spans(text: str) -> list[Span]:
    """The identifiers of each kind as written, leftmost and not overlapping within a kind; failing ones are dropped."""
    found = [("email", *span) for span in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(_at_most_255(p) for p in m[0].split("."))]
    if _LONG_DIGITS.search(text):
        for m in _CARD.finditer(text):
            digits = _NON_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NON_DIGIT.sub("", m[0])) <= 15]
    return found


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


class Mapped:
    """A text in normal form; character i came from source[starts[i]:ends[i]]."""

    def __init__(self, text: str, starts, ends):
        self.text, self.starts, self.ends = text, starts, ends

    @classmethod
    def of(cls, text: str) -> Mapped:
        return cls(text, range(len(text)), range(1, len(text) + 1))

    def rewrite(self, pattern: re.Pattern, replace) -> Mapped:
        """Each match becomes ``replace(match)``, (new text, start, end) of its parts in turn; every sign of a new text
        comes from its whole part."""
        pieces, starts, ends, past = [], [], [], 0
        for m in pattern.finditer(self.text):
            for new, a, b in replace(m):
                pieces += [self.text[past:a], new]
                starts += self.starts[past:a]
                ends += self.ends[past:a]
                starts += [self.starts[a]] * len(new)
                ends += [self.ends[b - 1]] * len(new)
                past = b
        if not pieces:
            return self
        pieces.append(self.text[past:])
        starts += self.starts[past:]
        ends += self.ends[past:]
        return Mapped("".join(pieces), starts, ends)

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]


def _whole(new):
    """A part for :meth:`Mapped.rewrite`: all of a match."""
    return lambda m: [(new(m[0]) if callable(new) else new, *m.span())]


def _digits(m: re.Match) -> Iterator[tuple[str, int, int]]:
    """Words to digits; what parts them from other digits goes, or becomes a dot. Runs of figures alone stay."""
    if not _HAS_DIGIT_WORD.search(m[0]):
        return
    at = m.start()
    parts = list(_DIGIT_PART.finditer(m[0]))
    for i, p in enumerate(parts):
        span = at + p.start(), at + p.end()
        if p["sign"]:
            yield "+", *span
        elif p["word"]:
            yield SPELLED[p["word"].lower()], *span
        elif p["dot"]:
            yield ".", *span
        elif p["gap"] and (parts[i - 1]["word"] or parts[i + 1]["word"]):
            yield "", *span


def normalise(text: str) -> Mapped:
    """``text`` with signs, digits, at and dot as an identifier has them; every sign knows its stretch of the source."""
    out = Mapped.of(text)
    if not text.isascii():
        out = out.rewrite(_SIGNS, _whole(lambda sign: _ONE_SIGN.get(sign, sign)))
    out = out.rewrite(_DIGIT_RUN, _digits)
    at = out.rewrite(_DISGUISED_AT, _whole("@"))
    dots = _DISGUISED_DOT if at is not out or "@" in out.text else _DOT_WITHOUT_AT
    return at.rewrite(dots, _whole("."))


_DIGIT_WORDS = re.compile(_DIGIT_WORD)
_OTHER_DISGUISES = re.compile(r"[\[({<]\x20*(?:at|dot|a|@|\.)\x20*[\])}>]|\x20dot\x20|\x20\.\x20")


def _needs_work(text: str) -> bool:
    """Whether :func:`normalise` may find something; quick, as most texts hold nothing for it."""
    low = text.lower()
    return bool(
        not text.isascii() and _SIGNS.search(text) or _OTHER_DISGUISES.search(low)
        or _DIGIT_WORDS.search(low) and _DIGIT_RUN.search(text))


class _Taken:
    """Spans by start, to find those that overlap a stretch."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted(spans, key=lambda s: s[1])
        self.starts = [s[1] for s in self.spans]
        self.reach = list(accumulate((s[2] for s in self.spans), max))

    def over(self, start: int, end: int) -> Iterator[Span]:
        at = bisect_left(self.starts, end) - 1
        while at >= 0 and self.reach[at] > start:
            if self.spans[at][2] > start:
                yield self.spans[at]
            at -= 1


def all_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Plain spans, and those only the normal form shows: none that overlaps a plain one, but for covering one of its kind.

    Time grows with the text's length, whatever it holds.
    """
    if not text:
        return [], []
    plain = plain_spans(text)
    added: list[Span] = []
    if _needs_work(text):
        normal = normalise(text)
        if normal.text != text:
            found = plain_spans(normal.text)
            for kind in KINDS:
                taken, past = _Taken(plain + added), 0
                for _, a, b in (f for f in found if f[0] == kind):
                    start, end = normal.source(a, b)
                    # a plain span may be what a disguise left visible of a longer identifier of its kind
                    if start >= past and text[start:end] != normal.text[a:b] and all(
                            s[0] == kind and start <= s[1] and s[2] <= end for s in taken.over(start, end)):
                        added.append((kind, start, end))
                        past = end
    return plain, added


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


SPAN_TYPE = "struct<kind:string,start:int,end:int,plain:boolean>"


def spans_column(text: Column) -> Column:
    """Identifiers of a text as an array of (kind, start, end, plain), by kind, then start; null and empty: none."""
    def find(value):
        plain, added = all_spans(value)
        known = {s: True for s in plain}
        return [
            {"kind": k, "start": a, "end": b, "plain": (k, a, b) in known} for k, a, b in _ordered(plain + added)]

    return map_values(find, f"array<{SPAN_TYPE}>", text)


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pii``, the array of :func:`spans_column` (a column of that name is replaced).

    Works on each row by itself: repeated rows get equal spans, nulls and empty texts none, and an empty table stays
    empty. Spans are in code points of the source, end exclusive; of equal stretches of two kinds both are reported.
    """
    return docs.withColumn("pii", spans_column(F.col(text_col)))


def mask_text(text: str | None) -> str | None:
    """``text`` with a placeholder such as ``<EMAIL>`` for every identifier; overlapping ones share the first's.

    A null text stays null, an empty one empty; whole texts are read, however long.
    """
    if not text:
        return text
    plain, added = all_spans(text)
    if not plain and not added:
        return text
    pieces, past = [], 0
    for kind, start, end in sorted(plain + added, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if start >= past:
            pieces += [text[past:start], f"<{kind.upper()}>"]
        past = max(past, end)
    return "".join([*pieces, text[past:]])


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with identifiers in ``text_col`` replaced by placeholders, all other columns as they are.

    Rows are taken one by one: a null text stays null, an empty one empty, repeated rows change alike, very long texts
    are read whole, and an empty table stays empty.
    """
    return docs.withColumn(text_col, map_values(mask_text, "string", F.col(text_col)))


def joined(spans: str) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined in its order."""
    return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")
