"""Secret scans with structural confirmation.

Three pattern kinds give the base spans. Beside them, runs of base64 or hex
characters are candidates: a candidate is decoded, and only what parses is
reported.

* ``jwt``: three dot-joined base64url parts whose first decodes to a JSON
  object with a text ``alg``, and whose second to a JSON object. The header may
  begin behind punctuation: at the part's first letter, or behind its last ``-`` or
  ``_`` (which base64 of such objects has only for ``>``, ``?`` and ``~``).
* ``der``: base64 or hex (with the line ends and blanks of a PEM body, escaped line
  ends too) that decodes to a private key in DER: a SEQUENCE whose nested lengths fill
  it exactly and whose first members are those of PKCS#1, PKCS#8 (encrypted too),
  SEC 1 or a traditional DSA key. It may begin anywhere in a run.
* ``openssh``: base64 of an OpenSSH private key block, whose length-prefixed
  fields are read to its end.

A candidate is decoded only where a length or a member is read, so each costs a
bounded number of small steps.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from acctflow.llm.common import with_columns_of_text

KINDS = ("assign", "access", "hex", "jwt", "der", "openssh")


def either_case(word: str) -> str:
    """The pattern of a word whose ASCII letters count in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Fixed by the contract: names, operators and value characters.
_NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]++){2,}+")
# A line end as such, or written as an escape as in JSON and source code.
_LINE_END = r"(?:\r?\n|\\r\\n|\\n)"
# Lines may be indented, end in blanks, or be joined by blanks.
_BREAK = rf"(?:[ \t]|{_LINE_END})++"
BREAK = re.compile(_BREAK)
ENCODED = re.compile(rf"(?<!\\)[A-Za-z0-9+/_-]{{24,}}+(?:{_BREAK}[A-Za-z0-9+/_-]++)*+={{0,2}}")
# The base64 forms of the byte 0x30 and of the OpenSSH magic begin like this.
DER_START = "M"
KEY_START = re.compile("M(?=[A-P])|b(?=3BlbnNzaC1rZXktdjE)")
HEX_RUN = re.compile(rf"[0-9a-fA-F]{{24,}}+(?:{_BREAK}[0-9a-fA-F]{{2,}}+)*+")
# The two bytes that a SEQUENCE with members begins with, in hex.
HEX_START = re.compile("30(?=8[1-4]|[1-7])")

MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
HEX = re.compile("[0-9a-f]{%d,}" % MIN_HEX)

INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30
MOST_MEMBERS = 10  # of PKCS#1; the other key structures have fewer
MIN_DSA_PRIME = 64  # bytes of the shortest prime in use
# Fixed by the standards: object identifiers of password-based encryption begin so.
PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def from_base64(text: str) -> bytes:
    """Either alphabet, padding optional, a lone last character left out; empty
    if it can't be decoded."""
    raw = re.sub(r"[\s=]", "", text).translate(str.maketrans("-_", "+/"))
    raw = raw[:-1] if len(raw) % 4 == 1 else raw
    try:
        return base64.b64decode(raw + "=" * (-len(raw) % 4), validate=True)
    except binascii.Error:
        return b""


class Encoded:
    """The bytes that base64 characters hold from a place on, decoded where they
    are read: so a key is followed through its stated lengths, and a candidate
    costs the fields looked at, whatever it says and whatever stands behind it."""

    def __init__(self, chars: str, place: int):
        self.chars, self.place = chars, place
        self.size = (len(chars) - place) * 6 // 8

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, part: slice) -> bytes:
        first = part.start // 3
        held = self.chars[self.place + 4 * first : self.place - part.stop // -3 * 4]
        return from_base64(held)[part.start - 3 * first : part.stop - 3 * first]


class EncodedHex(Encoded):
    """The same for hex digits."""

    def __init__(self, chars: str, place: int):
        super().__init__(chars, place)
        self.size = (len(chars) - place) // 2

    def __getitem__(self, part: slice) -> bytes:
        stop = min(part.stop, self.size)
        return bytes.fromhex(self.chars[self.place + 2 * part.start : self.place + 2 * stop])


def read_der(raw: bytes | Encoded, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, content start, content end) of the element at ``at``, or None if
    its length is malformed or leaves ``end``."""
    if at + 2 > end:
        return None
    tag, n = raw[at : at + 2]
    at += 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            return None
        n, at = int.from_bytes(raw[at : at + k], "big"), at + k
    return (tag, at, at + n) if at + n <= end else None


def members(raw: bytes | Encoded, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill raw[at:end] exactly; None if they don't, or are
    more than any key structure has."""
    out = []
    while at < end:
        element = read_der(raw, at, end)
        if element is None or len(out) == MOST_MEMBERS:
            return None
        out.append(element)
        at = element[2]
    return out


def private_key_length(raw: bytes | Encoded) -> int:
    """Bytes of the DER private key that ``raw`` begins with, or 0: nested
    lengths exact, members as the standards say."""
    top = read_der(raw, 0, len(raw))
    if top is None or top[0] != SEQUENCE:
        return 0
    inside = members(raw, top[1], top[2])
    if not inside or len(inside) < 2:
        return 0
    tags = [t for t, _, _ in inside]
    if tags == [SEQUENCE, OCTETS]:  # PKCS#8, encrypted
        scheme = members(raw, inside[0][1], inside[0][2])
        named = scheme and scheme[0][0] == OID and raw[scheme[0][1] : min(scheme[0][2], scheme[0][1] + 9)]
        return top[2] if named and named.startswith(PASSWORD_BASED) else 0
    if inside[0][0] != INTEGER or inside[0][2] - inside[0][1] != 1:
        return 0
    version = raw[inside[0][1] : inside[0][2]]
    if len(tags) >= 9 and set(tags[:9]) == {INTEGER} and version in (b"\x00", b"\x01"):
        return top[2]  # PKCS#1: version, modulus, exponents, primes
    if tags == [INTEGER] * 6 and version == b"\x00":  # DSA: version, p, q, g, y, x
        return top[2] if inside[1][2] - inside[1][1] >= MIN_DSA_PRIME else 0
    if tags[1] == SEQUENCE and len(tags) > 2 and tags[2] == OCTETS and version in (b"\x00", b"\x01"):
        algorithm = members(raw, inside[1][1], inside[1][2])  # PKCS#8
        return top[2] if algorithm and algorithm[0][0] == OID else 0
    sec1 = tags[1] == OCTETS and version == b"\x01" and all(t in (0xA0, 0xA1) for t in tags[2:])
    return top[2] if sec1 else 0


def openssh_key_length(raw: bytes | Encoded) -> int:
    """Bytes of the OpenSSH private key that ``raw`` begins with, or 0."""
    magic = b"openssh-key-v1\x00"
    at = len(magic)
    if raw[0:at] != magic:
        return 0

    def skip(fields: int) -> bool:
        nonlocal at
        for _ in range(fields):
            if at + 4 > len(raw):
                return False
            at += 4 + int.from_bytes(raw[at : at + 4], "big")
        return at <= len(raw)

    if not skip(3) or at + 4 > len(raw):  # cipher, derivation, its options
        return 0
    keys = int.from_bytes(raw[at : at + 4], "big")
    at += 4
    return at if 1 <= keys <= 64 and skip(keys + 1) else 0


def is_signed_token(header: str, claims: str) -> bool:
    try:
        head, body = json.loads(from_base64(header)), json.loads(from_base64(claims))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of kind, end) of the three pattern kinds, in code points."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans whose decoded bytes parse as a key or a signed token."""
    out = []
    if "ey" in text:
        for m in DOTTED.finditer(text):
            out += [(m.start() + s, 3, m.start() + e) for s, e in signed_tokens(m[0])]
    for m in ENCODED.finditer(text):
        if KEY_START.search(m[0]):
            out += [(m.start() + s, k, m.start() + e) for s, k, e in encoded_keys(m[0])]
    for m in HEX_RUN.finditer(text):
        if HEX_START.search(m[0]):
            out += [(m.start() + s, k, m.start() + e) for s, k, e in encoded_keys(m[0], True)]
    return sorted(set(out))


def signed_tokens(run: str) -> list[tuple[int, int]]:
    """(start, end) of the signed tokens in dot-joined parts, which share none."""
    parts = run.split(".")
    places = list(accumulate((len(p) + 1 for p in parts), initial=0))
    out, free = [], 0
    for k in range(len(parts) - 2):
        header = parts[k]
        if k < free or "ey" not in header or not parts[k + 1].startswith("e"):
            continue
        starts = {len(header) - len(header.lstrip("-_")), max(header.rfind("-"), header.rfind("_")) + 1}
        for start in sorted(starts):
            if header.startswith("ey", start) and is_signed_token(header[start:], parts[k + 1]):
                out.append((places[k] + start, places[k + 3] - 1))
                free = k + 3
                break
    return out


def encoded_keys(run: str, in_hex: bool = False) -> list[tuple[int, int, int]]:
    """(start, kind, end) of keys anywhere in a base64 (or hex) run, as a run may
    begin with what stands before a key. A key says how long it is, so what stands
    behind it doesn't matter."""
    ends = [m.span() for m in BREAK.finditer(run)]
    starts = [0, *(e for _, e in ends)]
    lines = [run[a:b] for a, b in zip(starts, [*(s for s, _ in ends), len(run)])]
    lines[-1] = lines[-1].rstrip("=")
    chars = "".join(lines)
    places = list(accumulate(map(len, lines), initial=0))  # of each line in chars
    out, until = [], 0
    for m in (HEX_START if in_hex else KEY_START).finditer(chars):
        place = m.start()
        if place < until:
            continue
        kind = 4 if in_hex or m[0] == DER_START else 5
        raw = EncodedHex(chars, place) if in_hex else Encoded(chars, place)
        n = private_key_length(raw) if kind == 4 else openssh_key_length(raw)
        if n:
            until = place + (2 * n if in_hex else -(n * 8 // -6))
            line, last = bisect_right(places, place) - 1, bisect_left(places, until) - 1
            end = starts[last] + until - places[last]
            while not in_hex and end < len(run) and run[end] == "=":
                end += 1
            out.append((starts[line] + place - places[line], kind, end))
    return out


def digest_form(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), redacted: bool = True) -> DataFrame:
    """Per row: the id (or the columns in ``keep``), ``n_assign``,
    ``n_access``, ``n_hex``, ``n_confirmed``, ``base_spans`` and ``spans``
    (kind:start:end by start, then kind; code points, end exclusive; joined by
    commas), and, if ``redacted``, a column of that name, the text with every span
    replaced by its kind in square brackets (overlapping spans are replaced as one).

    No shuffle; a null text counts as empty, an empty one has no spans,
    repeated rows give repeated results, null ids stay null.
    """

    kinds = [pa.int64()] * 4 + [pa.string()] * (3 if redacted else 2)

    def one(text: str) -> tuple:
        base = base_spans(text)
        spans = sorted(base + confirmed_spans(text))
        found = [k for _, k, _ in base]
        counts = [found.count(k) for k in range(3)]
        texts = (redact(text, spans),) if redacted else ()
        return *counts, len(spans) - len(base), digest_form(base), digest_form(spans), *texts

    def arrays(texts: list[str]) -> list[pa.Array]:
        rows = list(map(one, texts))
        return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]

    added = "n_assign long, n_access long, n_hex long, n_confirmed long, base_spans string, spans string"
    return with_columns_of_text(docs, text_col, keep or (id_col,), added + ", redacted string" * redacted, lambda: arrays)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    if not spans:
        return text
    out, at, until, name = [], 0, -1, ""
    for start, k, end in spans:
        if start < until:
            until = max(until, end)
            continue
        if until >= 0:
            out.append(f"[{name}]")
            at = until
        out.append(text[at:start])
        until, name = end, KINDS[k]
    return "".join([*out, f"[{name}]", text[until:]])
