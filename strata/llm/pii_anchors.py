"""Personal data by anchor expansion.

One Aho-Corasick automaton walks each text once and reports anchors: at
signs, plus signs, digits, ``://`` and cue words. At an anchor a small local
parser expands to both sides and validates what it finds; the parsers of one
kind never look at the same characters twice, so the work is linear in the
text. Spans are code points, end exclusive.

Base kinds (leftmost, non-overlapping within a kind; a match that fails
validation is dropped and the search goes on behind it):

* ``email``  local part, at sign, dotted domain
* ``ip``     four dotted numbers, each at most 255
* ``card``   14 to 19 digits with single blanks or hyphens, passing Luhn
* ``phone``  plus sign, 10 to 15 digits with separators

Added kinds: ``url`` (scheme, host with a dot), ``iban`` (country letters,
check digits, as many characters as the country has, ISO 7064 mod 97; with or
without a cue word before it, in fours or unbroken, in any case; countries
without a known length only behind a cue) and ``account`` (a number of 6 to
17 digits behind a cue word such as *account* or *Konto* and words such as
*number is*, in any case).

Defined results: null and empty texts have no spans; whole texts are
searched, however long; spans are sorted by start, then kind; repeated rows give repeated results; an empty table gives
an empty table; ``find_pii`` leaves out columns not asked for with ``keep``
(one named ``spans`` cannot be kept), ``redact`` keeps all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common as C

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account")
SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"
CUES = ("account", "acct", "iban", "konto", "kontonummer", "cuenta", "compte")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]{1,5})?(?:[/?#][^\s<>\"']*)?")
_QUALIFIED = r"\.?(?:[ -]?(?:number|nummer|num\.?|no\.?|nr\.?|numero|número|numéro))?(?: (?:is|ist|est|es))?(?: ?[:#=])? ?"
_CUED = re.compile(_QUALIFIED + r"([0-9](?:[ -]?[0-9]){5,16})(?![0-9])", re.IGNORECASE)
_IBAN = re.compile(_QUALIFIED + r"(?=[A-Za-z]{2}[0-9]{2})", re.IGNORECASE)
_ALNUM = _LETTERS | _DIGITS
_FOLD = {c: c + 32 for c in range(65, 91)}
#: Characters of an IBAN by country (ISO 13616).
IBAN_SIZES = {
    x[:2]: int(x[2:])
    for x in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 "
        "IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 "
        "SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def iban_end(text: str, start: int, cued: bool) -> int | None:
    """End of the IBAN that starts here, if one does."""
    read, i, stops = "", start, {}
    while i < len(text) and len(read) < 34:
        if text[i] in _ALNUM:
            read += text[i]
            i += 1
            if i == len(text) or text[i] not in _ALNUM:
                stops[len(read)] = i
        elif text[i] in " -\u00a0" and read and len(read) % 4 == 0 and text[i - 1] in _ALNUM:
            i += 1
        else:
            break
    size = IBAN_SIZES.get(read[:2].upper())
    if size:
        sizes = [size, *([max(stops, default=0)] if cued else [])]
    else:
        sizes = sorted(stops, reverse=True) if cued else []
    return next((stops[n] for n in sizes if n in stops and iban_ok(read[:n])), None)


class Finder:
    """Built once a task; ``spans(text)`` gives (start, kind number, end)."""

    def __init__(self) -> None:
        a = ahocorasick.Automaton()
        for x in "@+0123456789":
            a.add_word(x, (1, x))
        a.add_word("://", (3, ":"))
        for cue in CUES:
            a.add_word(cue, (len(cue), "cue"))
        a.make_automaton()
        self.anchors = a

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        out: list[tuple[int, int, int]] = []
        ends = [0] * len(KINDS)  # where the search of each kind goes on
        size = len(text)
        folded = text.lower()
        if len(folded) != size:  # a letter became two
            folded = text.translate(_FOLD)
        for last, (width, what) in self.anchors.iter(folded):
            p = last - width + 1
            if what in _DIGITS:
                if p - 2 >= ends[5] and text[p - 1] in _LETTERS and text[p - 2] in _LETTERS and (p == 2 or text[p - 3] not in _ALNUM) and text[last + 1 : last + 2] in _DIGITS and (end := iban_end(text, p - 2, False)):
                    ends[5] = end
                    out.append((p - 2, 5, end))
                if p >= ends[2]:
                    if m := _CARD.match(text, p):
                        ends[2] = m.end()
                        digits = m.group().replace(" ", "").replace("-", "")
                        if 14 <= len(digits) <= 19 and luhn(digits):
                            out.append((p, 2, m.end()))
                if p >= ends[1] and (p == ends[1] or text[p - 1] not in _DIGITS) and (m := _IP.match(text, p)):
                    ends[1] = m.end()
                    if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m.groups()):
                        out.append((p, 1, m.end()))
            elif what == "@":
                start = p
                while start > ends[0] and text[start - 1] in _LOCAL:
                    start -= 1
                if start < p and (m := _DOMAIN.match(text, p + 1)):
                    ends[0] = m.end()
                    out.append((start, 0, m.end()))
            elif what == "+":
                if p >= ends[3] and (m := _PHONE.match(text, p)):
                    ends[3] = m.end()
                    if 10 <= sum(c in _DIGITS for c in m.group()) <= 15:
                        out.append((p, 3, m.end()))
            elif what == ":":
                start = p
                while start > ends[4] and text[start - 1] in _LETTERS:
                    start -= 1
                if start < p and (m := _URL.match(text, p + 3)):
                    ends[4] = m.end()
                    out.append((start, 4, m.end()))
            elif last + 1 < size:
                if last + 1 >= ends[5] and (m := _IBAN.match(text, last + 1)) and (end := iban_end(text, m.end(), True)):
                    ends[5] = end
                    out.append((m.end(), 5, end))
                elif last + 1 >= ends[6] and (m := _CUED.match(text, last + 1)):
                    ends[6] = m.end(1)
                    out.append((m.start(1), 6, m.end(1)))
        return sorted(out)


def find_pii(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``spans`` of every row; no shuffle."""
    src = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]] + [f"spans {SPAN_TYPE}"])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            for part in C.slices(batch, "__text"):
                found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in finder.spans(t or "")] for t in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(keep))], pa.array(found, kind)], names=[*keep, "spans"])

    return src.mapInArrow(run, schema)


def redact_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span, or run of overlapping spans, becomes one ``[KIND]`` (the
    kind that starts it)."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at, i = end, i + 1
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns with personal data replaced in ``text``."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            for part in C.slices(batch, text):
                at = part.schema.get_field_index(text)
                done = [t if t is None else redact_text(t, finder.spans(t)) for t in part.column(at).to_pylist()]
                cols = part.columns
                cols[at] = pa.array(done, pa.string())
                yield pa.RecordBatch.from_arrays(cols, names=part.schema.names)

    return docs.mapInArrow(run, schema)
