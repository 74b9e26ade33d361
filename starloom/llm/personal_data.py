"""Personal data by anchors: an Aho-Corasick automaton finds at-signs, schemes, plus signs and
identifier cues, digit runs anchor addresses and card numbers, and small parsers expand each anchor
to its borders and validate it.

Kinds, in this order: email, ip, card and phone, the base; address (scheme://host...) and account
(an identifier with a digit behind a cue word in any case, or behind ``iban`` a number in blocks with
the right check digits), which the method adds. Positions are code points,
ends are exclusive. Every parser is linear in the text, whole texts are read.

A null text counts as empty; an empty text has no spans. Each row gives one row, repeated ones
too; null ids stay null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import from_arrow_schema

from starloom.llm.common import by_batch, query, table, texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")
CUES = ("iban", "account", "acct", "passport", "ssn", "token", "api_key", "apikey", "secret",
        "password")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+")
_HOST = re.compile(
    r"(?:[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*|\[[0-9A-Fa-f:.]+\])"  # a name or a bracketed address
    r"(?::[0-9]{1,5})?[^\s\"'<>()\[\]{}|\\^`]*"  # a port and the rest
)
_IDENTIFIER = re.compile(
    r"[ \t]{0,2}(?:number|no\.?|id)?[ \t]{0,2}[:=#]?[ \t]{0,2}[\"']?"  # what stands behind a cue
    r"([A-Za-z0-9_-]{6,})",
    re.I,
)
#: A bank account of a country, in one run or in blocks.
_GROUPED = re.compile(
    r"[ \t]{0,2}(?:number|no\.?|id)?[ \t]{0,2}[:=#]?[ \t]{0,2}[\"']?"
    r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])",
    re.I,
)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

Span = tuple[int, int]


@cache
def _anchors():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for anchor in ("@", "+", "://"):
        automaton.add_word(anchor, anchor)
    for cue in CUES:
        automaton.add_word(cue, cue)
    automaton.make_automaton()
    return automaton


def _email(text: str, at: int, floor: int) -> Span | None:
    """The address around the at-sign at ``at``; it starts at ``floor`` at the earliest."""
    begin = at
    while begin > floor and text[begin - 1] in _LOCAL:
        begin -= 1
    domain = _DOMAIN.match(text, at + 1) if begin < at else None
    return (begin, domain.end()) if domain else None


def _phone(text: str, at: int) -> Span | None:
    found = _PHONE.match(text, at)
    if not found:
        return None
    end = found.end()
    while text[end - 1] not in "0123456789":
        end -= 1
    # A plus sign, a digit, something, and a digit.
    return (at, end) if end - at >= 4 else None


def _address(text: str, at: int) -> Span | None:
    begin = at
    while begin and text[begin - 1] in _SCHEME:
        begin -= 1
    while begin < at and not text[begin].isalpha():
        begin += 1
    rest = _HOST.match(text, at + 3) if begin < at else None
    if not rest:
        return None
    end = rest.end()
    while text[end - 1] in ".,;:!?":
        end -= 1
    return (begin, end) if end > at + 3 else None


def _iban(text: str) -> int:
    """The length of the longest bank account number at the start of ``text`` that ends with a block
    and has the right check digits, 0 if there is none."""
    size = len(text)
    while size:
        digits = "".join(str(int(c, 36)) for c in (text[4:size] + text[:4]).replace(" ", ""))
        if 15 <= len(text[:size].replace(" ", "")) <= 34 and int(digits) % 97 == 1:
            return size
        size = max(0, text.rfind(" ", 0, size))
    return 0


def _account(text: str, cue: str, cue_begin: int, cue_end: int) -> Span | None:
    """What stands behind a cue: behind ``iban`` a number with the right check digits, in one run or in
    blocks; else, behind any cue, one run of six characters or more with a digit."""
    if cue_begin and (text[cue_begin - 1].isalnum() or text[cue_begin - 1] == "_"):
        return None
    if cue == "iban" and (found := _GROUPED.match(text, cue_end)) and found.start(1) > cue_end:
        begin = found.start(1)
        if size := _iban(found[1].upper()):
            return begin, begin + size
    found = _IDENTIFIER.match(text, cue_end)
    if not found or found.start(1) == cue_end or not _DIGITS.search(found[1]):
        return None
    return found.span(1)


def luhn(digits: str) -> bool:
    values = list(map(int, reversed(digits)))
    return (sum(values[::2]) + sum(v * 2 - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def _at_most_255(digits: str) -> bool:
    """Whatever zeros it begins with."""
    return not digits[:-3].strip("0") and int(digits[-3:]) < 256


def _by_digits(text: str) -> tuple[list[Span], list[Span]]:
    """Network addresses and card numbers, both chains of digit runs."""
    ips, cards = [], []
    dotted: list[Span] = []  # the runs of an address so far
    carded: list[Span] = []  # the runs of a card number so far

    def close_card() -> None:
        if carded:
            begin, end = carded[0][0], carded[-1][1]
            size = sum(e - b for b, e in carded)
            if 13 <= size <= 19 and luhn(text[begin:end].replace(" ", "").replace("-", "")):
                cards.append((begin, end))
            carded.clear()

    for found in _DIGITS.finditer(text):
        run = found.span()
        if dotted and not (run[0] == dotted[-1][1] + 1 and text[run[0] - 1] == "."):
            dotted.clear()
        dotted.append(run)
        if len(dotted) == 4:
            if all(_at_most_255(text[b:e]) for b, e in dotted):
                ips.append((dotted[0][0], run[1]))
            dotted.clear()
        if carded and not (run[0] == carded[-1][1] + 1 and text[run[0] - 1] in " -"):
            close_card()
        carded.append(run)
    close_card()
    return ips, cards


def spans_of(text: str) -> dict[str, list[Span]]:
    """The spans of each kind, from left to right."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    lowered = text.lower()
    if len(lowered) != len(text):
        lowered = text.translate(_LOWER)
    for last, anchor in _anchors().iter(lowered):
        if anchor == "@":
            kind = "email"
            span = _email(text, last, found[kind][-1][1] if found[kind] else 0)
        elif anchor == "+":
            kind, span = "phone", _phone(text, last)
            if span and not 9 <= sum(c.isdigit() for c in text[span[0] : span[1]]) <= 15:
                span = None
        elif anchor == "://":
            kind, span = "address", _address(text, last - 2)
        else:
            kind, span = "account", _account(text, anchor, last - len(anchor) + 1, last + 1)
        if span and (not found[kind] or span[0] >= found[kind][-1][1]):
            found[kind].append(span)
    found["ip"], found["card"] = _by_digits(text)
    return found


def written(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{b}:{e}" for kind in kinds for b, e in found[kind])


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, the number of spans of each kind (n_email ...) and ``spans``,
    kind:start:end by kind and start, joined by commas; base_sha256 is the digest of the base ones
    written so."""
    schema = pa.schema(
        {
            "doc_id": pa.int64(),
            **{f"n_{kind}": pa.int64() for kind in KINDS},
            "base_sha256": pa.string(),
            "spans": pa.string(),
        }
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        all_found = [spans_of(text) for text in batch.column("text").to_pylist()]
        columns = [batch.column("doc_id")]
        columns += [pa.array([len(f[kind]) for f in all_found], pa.int64()) for kind in KINDS]
        base = [hashlib.sha256(written(f, BASE).encode()).hexdigest() for f in all_found]
        columns += [pa.array(base, pa.string())]
        columns += [pa.array([written(f, KINDS) for f in all_found], pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    return texts(docs).mapInArrow(by_batch(run), from_arrow_schema(schema))


@query("op10_personal_data")
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))
