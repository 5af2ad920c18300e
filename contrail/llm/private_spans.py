"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of all kinds in a single pass over
the whole text: at-signs, schemes, plus signs before a digit, digits, and words that announce
an account number.  A small deterministic parser then expands from the anchor to the
boundaries of the span and validates it; nothing else of the text is looked at.

Base kinds (spans of a kind never overlap; a span that fails its check is
dropped and its characters are not tried again):
``email`` from the at-sign, ``ip`` and ``card`` from the first digit of a
number, ``phone`` from the plus sign.
Added kinds: ``address`` (a mail address with letters beyond ASCII, whole),
``login`` (scheme, user, password and host of a URL), ``iban`` (two letters
before the digits, country form and check digits valid), ``account`` (6 to 18 digits announced
by a word for an account).  Added spans may overlap base ones, which stay.

Positions are code points, ends exclusive.  Cases: null text counts as empty and
has no span; null ids and repeated rows give a row each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import ship_code

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "login", "iban", "account")
CUES = ("account", "acct", "konto", "compte", "cuenta", "conto")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])*+")
_PHONE = re.compile(r"[\x20().0-9-]*+")
_SPLIT = re.compile(r"[\x20-]")
_HOST = re.compile(r"[\w-]++(?:\.[\w-]++)++")
_LOGIN = re.compile(r"[^\s/?#@:]+:[^\s/?#@]*@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?(?::[0-9]+)?")
_IBAN = re.compile(r"[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_ACCOUNT = re.compile(r"(?:\x20?(?:number|no|nr))?[\s.:#=-]{0,4}([0-9](?:[\x20-]?[0-9]){5,17})(?![0-9])", re.IGNORECASE)
LONGEST_LOCAL = 64  # of a mail address, by the standard


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def mod_97(code: str) -> int:
    """Remainder of an IBAN with its first four characters moved behind, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Span around the at-sign at ``at``, not before ``floor``."""
    end = _DOMAIN.match(text, at + 1)
    start = at
    while end and start > floor and text[start - 1] in _LOCAL:
        start -= 1
    return (start, end.end()) if end and start < at else None


def _wide_email(text: str, at: int) -> tuple[int, int] | None:
    """The same with letters of any script; only if it holds one beyond ASCII."""
    host = _HOST.match(text, at + 1)
    if not host:
        return None
    start = at
    while start and at - start <= LONGEST_LOCAL and (text[start - 1].isalnum() or text[start - 1] in _LOCAL):
        start -= 1
    span = text[start : host.end()]
    return (start, host.end()) if 0 < at - start <= LONGEST_LOCAL and not span.isascii() else None


def _ips(text: str, chain: re.Match) -> list[tuple[int, int]]:
    """Four parts each from the left of a chain of dotted numbers; those above 255 are dropped."""
    parts, at, out = chain.group().split("."), chain.start(), []
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        end = at + sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in four):
            out.append((at, end))
        at = end + 1
    return out


def _card(number: re.Match) -> bool:
    if number.end() - number.start() < 16:
        return False
    digits = _SPLIT.sub("", number.group())
    return 16 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, plus: int) -> tuple[int, int] | None:
    end = plus + 1 + len(text[plus + 1 : _PHONE.match(text, plus + 1).end()].rstrip(" ().-"))
    digits = sum(c.isdigit() for c in text[plus:end])
    return (plus, end) if end >= plus + 4 and 8 <= digits <= 15 else None


def _iban(text: str, digit: int) -> tuple[int, int] | None:
    """From the first check digit back over the country; the longest valid code that ends at a word's end."""
    start = digit - 2
    if start < 0 or not (text[start:digit].isascii() and text[start:digit].isalpha() and text[start:digit].isupper()):
        return None
    if start and text[start - 1].isalnum():
        return None
    m = _IBAN.match(text, digit)
    for end in range(m.end() if m else 0, digit + 12, -1):
        code = text[start:end].replace(" ", "")
        if len(code) < 15:
            break
        if text[end - 1] != " " and not text[end : end + 1].isalnum() and mod_97(code) == 1:
            return start, end
    return None


class Finder:
    """Spans of a text: (kind, start, end, base), by kind as listed, then start."""

    def __init__(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        a.add_word("@", "at")
        a.add_word("://", "scheme")
        for d in "0123456789":
            a.add_word(d, "digit")
            a.add_word("+" + d, "plus")
        for cue in CUES:
            for form in (cue, cue.capitalize(), cue.upper()):
                a.add_word(form, "cue")
        a.make_automaton()
        self.anchors = a

    def spans(self, text: str) -> list[tuple[str, int, int, bool]]:
        found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        mail = chain_end = number_end = 0
        for at, kind in self.anchors.iter(text):
            if kind == "digit":
                if at >= chain_end:  # the first digit of a chain of dotted numbers
                    chain = _CHAIN.match(text, at)
                    chain_end = chain.end()
                    found["ip"] += _ips(text, chain)
                if at >= number_end:
                    number = _NUMBER.match(text, at)
                    number_end = number.end()
                    if _card(number):
                        found["card"].append(number.span())
                    if span := _iban(text, at):
                        found["iban"].append(span)
            elif kind == "at":
                span, wide = _email(text, at, mail), _wide_email(text, at)
                if span:
                    mail = span[1]
                    found["email"].append(span)
                if wide:
                    found["address"].append(wide)
            elif kind == "plus":
                if span := _phone(text, at - 1):
                    found["phone"].append(span)
            elif kind == "scheme":
                start = at - 2
                while start and text[start - 1].isascii() and text[start - 1].isalnum():
                    start -= 1
                m = _LOGIN.match(text, at + 1)
                if m and start < at - 2:
                    found["login"].append((start, m.end()))
            else:
                m = _ACCOUNT.match(text, at + 1)
                if m:
                    found["account"].append(m.span(1))
        return [(k, a, b, k in BASE) for k in KINDS for a, b in sorted(set(found[k]))]


_SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def _spans_of(batches):
    finder = Finder()
    schema = pa.schema([("doc_id", pa.int64()), ("spans", _ARROW)])
    for batch in batches:
        offsets, kinds, starts, ends, base = [0], [], [], [], []
        for text in batch.column("t"):  # one text at a time as a Python string
            for k, a, b, own in finder.spans(text.as_py()):
                kinds.append(k)
                starts.append(a)
                ends.append(b)
                base.append(own)
            offsets.append(len(kinds))
        items = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(base, pa.bool_())],
                                           fields=list(_ARROW.value_type))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items).cast(_ARROW)], schema=schema)


def private_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and the spans (kind, start, end, base) of its whole text."""
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.mapInArrow(_spans_of, f"doc_id long, spans {_SPANS}")


def masked_text(text: str, spans) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans count as one, named by the first."""
    out, at = [], 0
    for start, end, kind in sorted((s[1], -s[2], s[0]) for s in spans):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, -end)
    return "".join([*out, text[at:]])


def without_private(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of their texts masked; null texts stay null, all other columns as they are."""
    ship_code(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches):
        finder = Finder()
        for batch in batches:
            texts = [None if (t := v.as_py()) is None else masked_text(t, finder.spans(t)) for v in batch.column(place)]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def places(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")
