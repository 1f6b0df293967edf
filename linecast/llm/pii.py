"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass: at-signs,
plus signs, digits, address schemes and identifier cues. A deterministic local
parser expands every anchor to its boundaries and validates it. All parsers
are linear (possessive patterns, no position is expanded twice per kind).

Kinds, in output order:

* ``email``, ``ip``, ``card``, ``phone``: leftmost non-overlapping matches of
  the fixed patterns; matches that fail validation (octets over 255, digit
  counts, Luhn) are consumed and dropped.
* ``url``: a scheme's address that holds credentials or a numeric host.
* ``account``: the value after an identifier cue (``password=...``,
  ``"token": "..."``, ``X-API-Key: ...``, ``Authorization: Bearer ...``,
  ``SSN 078-05-1120``, ``account 12345678``), a cloud key id, a private key
  block, or an IBAN. A value must be six characters or more and hold a digit, so
  prose after a cue is left alone; after a password cue three words joined by
  signs will do, and between quotes any sign that is no letter or blank (the
  value then goes on to the closing quote), and after ``Authorization`` capitals
  inside a word. Without ``:``, ``=`` or ``#`` only
  digits and hyphens follow account, SSN and passport cues. An IBAN goes on over
  single blanks, as far as its check digits hold; without a cue it must be in
  one piece or in groups of four, and hold as a whole.

Values and credentials have no greatest length.

Defined results: null or empty text has no spans; every input row gives one
output row (repeated rows and repeated ids included); a null id stays null;
extra columns are not read by ``find_pii`` and kept as they are by ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linecast.llm.common import slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"://(?:[^\s/?#@<>\"']++@[A-Za-z0-9.-]+|[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?::[0-9]+)?(?:/[^\s<>\"']*+)?")
_COLON = r"[\"']?[\x20]?(?:number|no\.?|id)?[\"']?[\x20]?[:=#][\x20]?"
_SEPARATOR = _COLON + r"[\"']?"
_VALUE = re.compile(_SEPARATOR + r"([A-Za-z0-9][A-Za-z0-9+/_.-]{5,}+)")
_IBAN = re.compile(_SEPARATOR + r"([A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30}|[a-z]{2}[0-9]{2}(?:[\x20]?[a-z0-9]){11,30})")
_QUOTED = re.compile(_COLON + r"""(?:"([^"\r\n]{6,}+)"|'([^'\r\n]{6,}+)')""")
_NUMBER = re.compile(r"\x20(?:number\x20|no\.?\x20|id\x20)?([0-9][0-9-]{5,}+)")
_BEARER = re.compile(r"\x20([A-Za-z0-9][A-Za-z0-9._~+/=-]{15,}+)")
_AUTHORIZATION = re.compile(r"[\"']?\x20?[:=]\x20?[\"']?(?:(?:Bearer|Basic|Token|bearer|basic|token)\x20)?([A-Za-z0-9][A-Za-z0-9._~+/=-]{5,}+)")
_MIXED = re.compile(r"[a-z][A-Z]|=")
_BARE_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){2,7}+(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_JOINED_WORDS = re.compile(r"[A-Za-z]+(?:[+/_.-][A-Za-z]+){2,}+")
#: A private key block: header, optional fields, lines of base64, optional end.
_KEY_BLOCK = re.compile(
    r"-----BEGIN [A-Z0-9 ]{0,40}?PRIVATE KEY(?: BLOCK)?-----(?:[\r\n]+[A-Za-z-]++: [^\r\n]*+)*+"
    r"(?:\s*+[A-Za-z0-9+/=]++(?=[ \t]*+(?:[\r\n]|\Z|-----END)))*+(?:\s*+-----END [A-Z0-9 ]{0,40}?PRIVATE KEY(?: BLOCK)?-----)?"
)
_CLOUD_KEY = re.compile(r"[A-Z0-9]{16}(?![A-Za-z0-9])")
_DIGITS = "0123456789"
#: Identifier cues, by what may follow: p passwords, n numbers, i IBANs, a the rest.
#: A blank stands for any of ``_`` ``-`` blank or nothing.
_CUES = {
    "password": "p", "passwd": "p", "pwd": "p", "passphrase": "p", "token": "a", "secret": "a", "api key": "a", "access key": "a", "secret key": "a", "secret access key": "a",
    "client secret": "a", "account": "n", "acct": "n", "iban": "i", "ssn": "n", "passport": "n", "authorization": "h", "bearer": "b",
}
_SCHEMES = ("http", "https", "ftp", "sftp", "ssh", "postgres", "mysql", "mongodb", "redis", "amqp")

SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_automaton = None


def _anchors():
    """The automaton, built once per Python worker."""
    global _automaton
    if _automaton is None:
        import ahocorasick

        a = ahocorasick.Automaton()
        for anchor in ("@", "+", "://", *_DIGITS):
            a.add_word(anchor, (anchor[0] if anchor not in _DIGITS else "0", len(anchor)))
        for cue, what in _CUES.items():
            for joint in "_- " + "\0":
                plain = cue.replace(" ", joint).replace("\0", "")
                for form in {plain, plain.capitalize(), plain.title(), plain.upper(), plain.title().replace("Api", "API")}:
                    a.add_word(form, (what, len(form)))
        a.add_word("-----BEGIN ", ("e", 11))
        a.add_word("AKIA", ("k", 4))
        a.make_automaton()
        _automaton = a
    return _automaton


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def octet(digits: str) -> bool:
    """Whether a number of any length is at most 255."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def iban_end(text: str, start: int, end: int) -> int:
    """End of the longest run of whole groups in ``text[start:end]`` whose IBAN
    check digits hold, or ``start``."""
    while end > start:
        # A group is whole if no letter or digit follows.
        if not text[end:end + 1].isalnum():
            plain = text[start:end].replace(" ", "")
            if len(plain) < 15:
                break
            if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                return end
        end = text.rfind(" ", start, end)
    return start


def _digit(value: str) -> bool:
    return any(c in _DIGITS for c in value)


def _value(text: str, what: str, cue: int, at: int) -> tuple[int, int] | None:
    """Bounds of the value of kind ``what`` whose cue is ``text[cue:at]``."""
    if what == "k":
        m = _CLOUD_KEY.match(text, at)
        return (cue, m.end()) if m else None
    if what == "e":
        m = _KEY_BLOCK.match(text, cue)
        return m.span() if m else None
    if what in "bh":
        m = (_BEARER if what == "b" else _AUTHORIZATION).match(text, at)
        return m.span(1) if m and (_digit(m[1]) or what == "h" and _MIXED.search(m[1])) else None
    if (m := _QUOTED.match(text, at)) and any(not (c.isalpha() or c.isspace()) for c in m[m.lastindex]):
        return m.span(m.lastindex)
    m = _VALUE.match(text, at)
    start, end = m.span(1) if m and (_digit(m[1]) or what == "p" and _JOINED_WORDS.fullmatch(m[1])) else (0, 0)
    if what == "i" and (m := _IBAN.match(text, at)):
        whole = iban_end(text, *m.span(1))
        if whole > max(end, m.start(1)):
            return m.start(1), whole
    if not end and what == "n" and (m := _NUMBER.match(text, at)):
        return m.span(1)
    return (start, end) if end else None


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), by kind, then start."""
    if not text:
        return []
    found: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)  # end of the last match of each kind, kept or dropped

    def take(kind: str, start: int, end: int, valid: bool = True) -> None:
        done[kind] = end
        if valid:
            found[kind].append((kind, start, end))

    for last, (what, size) in _anchors().iter(text):
        p = last + 1 - size
        if what == "0":
            # Two capitals before the first of two digits may begin an IBAN.
            q = p - 2
            if q >= done["account"] and text[q:p].isascii() and text[q:p].isalpha() and not (q and text[q - 1].isalnum()) and (m := _BARE_IBAN.match(text, q)) and iban_end(text, q, m.end()) == m.end():
                take("account", q, m.end())
            if p >= done["ip"] and (p == 0 or text[p - 1] not in _DIGITS) and (m := _IP.match(text, p)):
                take("ip", p, m.end(), all(map(octet, m[0].split("."))))
            if p >= done["card"] and (m := _CARD.match(text, p)):
                digits = m[0].replace(" ", "").replace("-", "")
                take("card", p, m.end(), 16 <= len(digits) <= 19 and luhn(digits))
        elif what == "@":
            start = p
            while start > done["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < p and (m := _DOMAIN.match(text, last + 1)):
                take("email", start, m.end())
        elif what == "+":
            if p >= done["phone"] and (m := _PHONE.match(text, p)):
                take("phone", p, m.end(), 8 <= sum(c in _DIGITS for c in m[0]) <= 15)
        elif what == ":":
            start = p
            while start > done["url"] and p - start < 10 and text[start - 1].isascii() and text[start - 1].isalpha():
                start -= 1
            if text[start:p].lower() in _SCHEMES and (m := _URL.match(text, p)):
                take("url", start, m.end())
        elif p >= done["account"] and not (p and text[p - 1].isalnum()):
            if span := _value(text, what, p, last + 1):
                take("account", *span)
    return [s for k in KINDS for s in found[k]]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``spans`` (kind, start, end in code points)."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t)] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(spans, _ARROW_SPANS)], ["id", "spans"])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, spans {SPAN_TYPE}").withColumnRenamed("id", id_col)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, the hash of the base spans and all spans as text."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(id_col, *(of(k) for k in BASE_KINDS), F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def redacted(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping
    spans are merged and named after the leftmost (then longest)."""
    spans = sorted(scan(text), key=lambda s: (s[1], -s[2]))
    if not spans:
        return text
    out, at = [], 0
    merged: list[list] = []
    for kind, s, e in spans:
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([kind, s, e])
    for kind, s, e in merged:
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The same rows and columns with personal data in ``text_col`` replaced.

    ``length_col``, if given, is set to the new length of changed texts.
    Texts without a span stay byte for byte as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            i = b.schema.get_field_index(text_col)
            old = b.column(i).to_pylist()
            new = [redacted(t) for t in old]
            cols = list(b.columns)
            cols[i] = pa.array(new, b.schema.field(i).type)
            if length_col is not None:
                j = b.schema.get_field_index(length_col)
                cols[j] = pa.array([n if x is y else len(y) for x, y, n in zip(old, new, b.column(j).to_pylist())], b.schema.field(j).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
