"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value that passes its kind's check is mapped by a keyed Feistel permutation
of all values of the same format, so it stays valid, equal values stay equal
in every document, different ones stay different, and nothing is stored. The
permutation moves every value (it is a conjugate of "add one"), so no value
stands for itself.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, functions as F

ROUNDS = 8


def _round(key: bytes, tag: bytes, r: int, x: int) -> int:
    h = hashlib.blake2b(b"%b|%d|%d" % (tag, r, x), key=key, digest_size=64)
    return int.from_bytes(h.digest(), "little")


def _walk(key: bytes, tag: bytes, x: int, size: int, back: bool) -> int:
    """Feistel on a x b >= size, walking the cycle until inside the domain."""
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    while True:
        left, right = divmod(x, b)
        for r in (range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)):
            sign = -1 if back else 1
            if r % 2:
                right = (right + sign * _round(key, tag, r, left)) % b
            else:
                left = (left + sign * _round(key, tag, r, right)) % a
        x = left * b + right
        if x < size:
            return x


def permute(key: bytes, tag: bytes, x: int, size: int) -> int:
    """Keyed permutation of range(size) without a fixed point (size > 1)."""
    if size < 2:
        return x
    return _walk(key, tag, (_walk(key, tag, x, size, False) + 1) % size, size, True)


def _mixed(key: bytes, tag: bytes, digits: list[int], radices: list[int]) -> list[int]:
    """Permutation of mixed-radix numbers."""
    x = 0
    for d, r in zip(digits, radices, strict=True):
        x = x * r + d
    x = permute(key, tag, x, math.prod(radices))
    out = []
    for r in reversed(radices):
        x, d = divmod(x, r)
        out.append(d)
    return out[::-1]


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_HEX = "0123456789abcdef"


def _chars(key: bytes, tag: bytes, text: str, classes=_CLASSES) -> str:
    """Every character of a class becomes one of its class; others stay."""
    places = [(i, c, cls) for i, c in enumerate(text) for cls in classes if c in cls]
    form = "".join("%d" % classes.index(cls) for _, _, cls in places)
    got = _mixed(key, tag + b"/" + form.encode(), [cls.index(c) for _, c, cls in places], [len(cls) for _, _, cls in places])
    out = list(text)
    for (i, _, cls), d in zip(places, got, strict=True):
        out[i] = cls[d]
    return "".join(out)


def _fill(form: str, digits: str) -> str:
    """The digits put into the places of the digits of the form."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in form)


def luhn_sum(digits: str) -> int:
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(int(c) for c in reversed(digits)))


def card(key: bytes, text: str) -> str | None:
    """13 to 19 digits with a valid Luhn digit; the new number has one too."""
    d = re.sub(r"\D", "", text)
    if luhn_sum(d) % 10 or not d.strip("0"):
        return None
    new = "%0*d" % (len(d) - 1, permute(key, b"card%d" % len(d), int(d[:-1]), 10 ** (len(d) - 1)))
    return _fill(text, new + str(-luhn_sum(new + "0") % 10))


def phone(key: bytes, text: str) -> str | None:
    """Country code kept; the national digits are permuted. Numbers valid in
    the North American plan (area and exchange not below 200) stay so."""
    m = re.match(r"\+1(?=\D)|\+1(?=\d{10}$)|\+\d{1,3}(?=\D)|", text)
    head, rest = text[:m.end()], text[m.end():]
    d = re.sub(r"\D", "", rest)
    if not 7 <= len(d) <= 14:
        return None
    nanp = len(d) == 10 and d[0] >= "2" and d[3] >= "2" and head in ("", "+1")
    low = [2 if nanp and i in (0, 3) else 0 for i in range(len(d))]
    got = _mixed(key, b"phone%d%d" % (len(d), nanp), [int(c) - lo for c, lo in zip(d, low, strict=True)], [10 - lo for lo in low])
    return head + _fill(rest, "".join(str(g + lo) for g, lo in zip(got, low, strict=True)))


def ssn(key: bytes, text: str) -> str | None:
    a, b, c = (int(x) for x in re.split(r"\D", text))
    areas = [x for x in range(1, 900) if x != 666]
    if a not in areas or not b or not c:
        return None
    a, b, c = _mixed(key, b"ssn", [areas.index(a), b - 1, c - 1], [len(areas), 99, 9999])
    return _fill(text, "%03d%02d%04d" % (areas[a], b + 1, c + 1))


def ipv4(key: bytes, text: str) -> str | None:
    octets = [int(x) for x in text.split(".")]
    if max(octets) > 255 or any(str(o) != t for o, t in zip(octets, text.split("."), strict=True)):
        return None
    host = all(1 <= o <= 254 for o in octets)
    got = _mixed(key, b"ipv4%d" % host, [o - host for o in octets], [256 - 2 * host] * 4)
    return ".".join(str(g + host) for g in got)


def email(key: bytes, text: str) -> str | None:
    """Local part permuted letter for letter and digit for digit; the domain
    is kept, so that mail hosts can still be counted."""
    local, _, domain = text.rpartition("@")
    return f"{_chars(key, b'email', local)}@{domain}"


def iban(key: bytes, text: str) -> str | None:
    t = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(t) <= 34 or number(t[4:] + t[:4]) % 97 != 1:
        return None
    body = _chars(key, b"iban" + t[:2].encode(), t[4:])
    out = iter(t[:2] + "%02d" % (98 - number(body + t[:2] + "00") % 97) + body)
    return "".join(c if c == " " else next(out) for c in text)


_EPOCH, _DAYS = datetime.date(1900, 1, 1), 73049  # 1900-01-01 to 2099-12-31


def date(key: bytes, text: str) -> str | None:
    """Year first; otherwise month and day in the order usual for the
    separator (month first with slashes), or the other one where only that is
    a date. 1900 to 2099."""
    sep = "/" if "/" in text else "." if "." in text else "-"
    parts = text.split(sep)
    n = [int(p) for p in parts]
    orders = [(0, 1, 2)] if len(parts[0]) == 4 else [(2, 0, 1), (2, 1, 0)] if sep == "/" else [(2, 1, 0), (2, 0, 1)]
    for k, order in enumerate(orders):
        try:
            at = (datetime.date(*(n[i] for i in order)) - _EPOCH).days
        except ValueError:
            continue
        if not 0 <= at < _DAYS:
            return None
        while True:
            at = permute(key, b"date%s%d%d%d" % (sep.encode(), *order), at, _DAYS)
            new = _EPOCH + datetime.timedelta(days=at)
            if k == 0 or new.day > 12:  # a date in the unusual order must stay one
                break
        values = {order[0]: "%04d" % new.year, order[1]: "%02d" % new.month, order[2]: "%02d" % new.day}
        return sep.join(values[i] for i in range(3))
    return None


def access_key(key: bytes, text: str) -> str:
    return text[:4] + _chars(key, b"akia", text[4:], (_CLASSES[2] + _CLASSES[0],))


def secret(key: bytes, text: str) -> str | None:
    """``name=value``: a value of another kind gets the pseudonym that it has
    without a name; any other is permuted within its character classes."""
    head, value, tail = re.fullmatch(r"""([\w-]+["']?\s*[=:]\s*["']?)(.*?)(["']?)""", text).groups()
    for name, pattern, make in KINDS:
        if name != "secret" and re.fullmatch(pattern, value) and (new := make(key, value)) is not None:
            return head + new + tail
    hexes = all(c in _HEX for c in value)
    new = _chars(key, b"secret", value, (_HEX,) if hexes else _CLASSES)
    return head + new + tail if new != value else None


def hex_token(key: bytes, text: str) -> str | None:
    """Lower or upper case; one value has one pseudonym, in the case it is in."""
    if text.isdigit() or text.isalpha():
        return None
    new = _chars(key, b"hex", text.lower(), (_HEX,))
    return new if text == text.lower() else new.upper()


#: international numbers of a plan with one length (3-3-4 after +1; country codes
#: by national digits): they end there, whatever number follows
_FIXED = {8: "45|47|65|852", 9: "27|31|33|34|41|48|61|351|380|420|421", 10: "7|30|44|52|90|91"}
_FIXED_PHONE = r"(?<![\w.])\+(?:%s)(?!\d)" % "|".join([
    r"1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}",
    *(r"(?:%s)(?:[ .-]?\(0\))?(?:[ .-]?\(?\d\)?){%d}" % (codes, n) for n, codes in _FIXED.items())])

#: names of secrets in any case, also as the last part of a name and in quotes, with = or :
_NAME = r"""(?<![^\W_])(?i:password|passwd|pwd|secret|token|api[_-]?key)["']?\s*[=:]"""

#: kind, pattern, check and pseudonym; the first that matches and passes its check wins
KINDS: list[tuple[str, str, Callable[[bytes, str], str | None]]] = [
    ("email", r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}\b", email),
    ("secret", _NAME + r"""\s*(?:"[^"\s]{8,}"|'[^'\s]{8,}'|["']?[A-Za-z0-9+/_-]{8,})""", secret),
    ("access_key", r"\bAKIA[A-Z0-9]{16}\b", access_key),
    ("hex_token", r"(?<![\w-])(?:[0-9a-f]{40}|[0-9A-F]{40})(?![\w-])", hex_token),
    ("phone", _FIXED_PHONE, phone),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b", iban),
    ("ipv4", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", ipv4),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", ssn),
    ("date", r"(?<![\d./-])(?:\d{4}([-/.])\d{2}\1\d{2}|\d{2}([-/.])\d{2}\2\d{4})(?!\d|[./-]\d)", date),
    ("card", r"(?<![\d.+-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{5})(?![\d-])", card),
    ("phone", r"(?<![\w.])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)"
              r"|(?<![\w.])\(\d{3}\) ?\d{3}[.-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d.-])", phone),
]
_QUICK = re.compile(r"[0-9@]|" + _NAME)


def _patterns(kinds: tuple[str, ...] | None):
    own = [k for k in KINDS if kinds is None or k[0] in kinds]
    return [(name, re.compile(pattern), make) for name, pattern, make in own]


def _gaps(a: int, b: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What of a to b is left between the taken spans."""
    for start, end in sorted(taken):
        if a < start:
            yield a, start
        a = end
    if a < b:
        yield a, b


class Pseudonymiser:
    def __init__(self, key: bytes, kinds: tuple[str, ...] | None = None):
        self.key, self.patterns = key, _patterns(kinds)
        self._value = lru_cache(maxsize=100_000)(self._make)

    def _make(self, kind: int, value: str) -> str | None:
        return self.patterns[kind][2](self.key, value)

    def _values(self, kind: int, text: str, a: int, b: int) -> Iterator[tuple[int, int, str]]:
        """Values of the kind in text[a:b]. A match that fails its check is tried
        again without its last group: it may have run over a blank into the next number."""
        pattern = self.patterns[kind][1]
        while m := pattern.search(text, a, b):
            a = m.start() + 1
            while m:
                whole = m.end() < b or b == len(text) or not text[b - 1:b + 1].isalnum()
                new = self._value(kind, m[0]) if whole else None
                if new is not None:
                    a = m.end()
                    yield m.start(), a, new
                    break
                cut = text.rfind(" ", m.start(), m.end())
                m = pattern.match(text, m.start(), cut) if cut > 0 else None

    def spans(self, text: str) -> list[tuple[int, int, str, str]]:
        """Start, end (code points of the input), kind and pseudonym."""
        if not _QUICK.search(text):
            return []
        found = []
        for line in re.finditer(r"[^\n]+", text):
            if not _QUICK.search(line[0]):
                continue
            taken: list[tuple[int, int]] = []
            for k, (name, _, _) in enumerate(self.patterns):
                for a, b in _gaps(line.start(), line.end(), taken):
                    for start, end, new in self._values(k, text, a, b):
                        taken.append((start, end))
                        found.append((start, end, name, new))
        return sorted(found)

    def replace(self, text: str, spans: list[tuple[int, int, str, str]]) -> str:
        out, at = [], 0
        for a, b, _, new in spans:
            out += [text[at:a], new]
            at = b
        return "".join([*out, text[at:]])


def pseudonymise(docs: DataFrame, *, key: bytes, kinds: tuple[str, ...] | None = None,
                 column: str = "text") -> DataFrame:
    """All columns of ``docs``, with personal values of ``column`` replaced,
    and ``pii``: array of (kind, start, length, pseudonym), places of the new
    text. A null text stays null and has an empty array; so has an empty one.
    An existing column ``pii`` is replaced. Rows are treated alone: nothing is
    shuffled, and repeated rows come out repeated. The key is the caller's
    secret; whoever has it can turn pseudonyms back.
    """
    rows = docs.drop("pii")
    names = rows.columns
    at = names.index(column)
    schema = rows.withColumn("pii", F.lit(None).cast(
        "array<struct<kind:string,start:int,length:int,pseudonym:string>>")).schema

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        own = Pseudonymiser(key, kinds)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                   ("length", pa.int32()), ("pseudonym", pa.string())]))
        for batch in batches:
            texts, lists = [], []
            for text in batch.column(at).to_pylist():
                spans = own.spans(text) if text else []
                texts.append(own.replace(text, spans) if spans else text)
                moved, shift = [], 0
                for a, b, name, new in spans:
                    moved.append({"kind": name, "start": a + shift, "length": len(new), "pseudonym": new})
                    shift += len(new) - (b - a)
                lists.append(moved)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lists, kind)], [*names, "pii"])

    return rows.mapInArrow(run, schema)
