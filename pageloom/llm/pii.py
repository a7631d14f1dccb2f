"""Format-preserving pseudonyms for personal numbers, dates and addresses."""

from __future__ import annotations

import datetime
import hashlib
import math
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import rows_of, slices
from .stages import ship_package

KINDS = ("card", "iban", "ssn", "phone", "ip", "email", "key", "date")
_ROUNDS = 8
_LETTERS, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
# Every kind holds one of these.
_SUSPECT = r"@|[0-9]"
_PATTERN = re.compile(
    r"""
    (?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24})
  | (?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))
  | (?P<iban>\b[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b)
  | (?P<date>(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?!\w|[/.-]\d))
  | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?!\w|-\d))
  | (?P<card>(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w|[.-]\d))
  | (?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,5}
        |(?:\(\d{3}\)[ .-]?|\d{3}[.-])\d{3}[ .-]\d{4})(?!\w|[.-]\d))
  | (?P<key>(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z]))
    """,
    re.VERBOSE,
)


class Permutation:
    """Keyed permutations of ``0 … size-1`` by a Feistel network with cycle walking.

    A number is split into two digits of radix about the root of the size; each round adds
    a keyed hash of one to the other. Results outside the range are permuted again, which
    ends because the network permutes the slightly larger square.
    """

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, number: int, half: int, radix: int) -> int:
        data = struct.pack("<B", number) + tweak + b"\0" + half.to_bytes(48, "little")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=64).digest(), "little") % radix

    def __call__(self, value: int, size: int, tweak: bytes, inverse: bool = False) -> int:
        if size < 2:
            return value
        radix = math.isqrt(size - 1) + 1
        low = -(-size // radix)
        sizes = (low, radix)
        while True:
            parts = list(divmod(value, radix))
            for n in range(_ROUNDS)[:: -1 if inverse else 1]:
                side = n % 2
                step = self._round(tweak, n, parts[1 - side], sizes[side])
                parts[side] = (parts[side] + (-step if inverse else step)) % sizes[side]
            value = parts[0] * radix + parts[1]
            if value < size:
                return value


def luhn_digit(digits: str) -> str:
    """The check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _fill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in shape)


def _number(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


class Pseudonyms:
    """Replaces valid personal data in one text; equal values get equal pseudonyms."""

    def __init__(self, key: bytes, kinds: tuple[str, ...] = KINDS, inverse: bool = False):
        self.permute, self.kinds, self.inverse = Permutation(key), kinds, inverse

    def _digits(self, digits: str, kind: str) -> str:
        tweak = f"{kind}{len(digits)}".encode()
        new = self.permute(int(digits), 10 ** len(digits), tweak, self.inverse)
        return str(new).zfill(len(digits))

    def _symbols(self, text: str, alphabet: str, kind: str) -> str:
        """``text`` permuted among all texts of its length over ``alphabet``."""
        base, value = len(alphabet), 0
        for c in text:
            value = value * base + alphabet.index(c)
        value = self.permute(value, base ** len(text), f"{kind}{len(text)}".encode(), self.inverse)
        out = []
        for _ in text:
            value, digit = divmod(value, base)
            out.append(alphabet[digit])
        return "".join(reversed(out))

    def card(self, text: str) -> str | None:
        digits = _number(text)
        if luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
            return None
        body = self._digits(digits[:-1], "card")
        return _fill(text, body + luhn_digit(body))

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        turn = lambda s: int("".join(str(int(c, 36)) for c in s))
        if not 15 <= len(plain) <= 34 or turn(plain[4:] + plain[:4]) % 97 != 1:
            return None
        body = plain[4:]
        new = _fill(body, self._digits(_number(body), "iban" + plain[:2])) if _number(body) else body
        check = 98 - turn(new + plain[:2] + "00") % 97
        out = iter(plain[:2] + f"{check:02d}" + new)
        return "".join(c if c == " " else next(out) for c in text)

    def ssn(self, text: str) -> str | None:
        area, group, serial = int(text[:3]), int(text[4:6]), int(text[7:])
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = area - 1 - (area > 666)
        value = (areas * 99 + group - 1) * 9999 + serial - 1
        value = self.permute(value, 898 * 99 * 9999, b"ssn", self.inverse)
        value, serial = divmod(value, 9999)
        area, group = divmod(value, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def phone(self, text: str) -> str | None:
        match = re.match(r"\+(\d{1,3})(?=[ .(-])", text)
        code = match[1] if match else text[1] if text[0] == "+" else ""
        digits = _number(text)[len(code) :]
        if not 7 <= len(digits) <= 14:
            return None
        if len(digits) == 10 and code in ("", "1") and digits[0] > "1" and digits[3] > "1":
            # North American numbers stay such: area and exchange begin with 2 to 9.
            first, second, rest = int(digits[0]) - 2, int(digits[3]) - 2, digits[1:3] + digits[4:]
            value = (first * 8 + second) * 10**8 + int(rest)
            value = self.permute(value, 64 * 10**8, b"phone-na", self.inverse)
            head, value = divmod(value, 10**8)
            rest = f"{value:08d}"
            new = f"{head // 8 + 2}{rest[:2]}{head % 8 + 2}{rest[2:]}"
        else:
            new = self._digits(digits, "phone" + code)
        return _fill(text, code + new)

    def ip(self, text: str) -> str | None:
        octets = [int(x) for x in text.split(".")]
        if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
            return None
        value = int.from_bytes(bytes(octets), "big")
        value = self.permute(value, 2**32, b"ip", self.inverse)
        return ".".join(map(str, value.to_bytes(4, "big")))

    def email(self, text: str) -> str | None:
        """The letters and digits of the local part are permuted as one number."""
        local, _, domain = text.rpartition("@")
        value, size, shape = 0, 1, []
        for c in local:
            base = 10 if c in _DIGITS else 26 if c.lower() in _LETTERS else 1
            shape.append(base)
            size *= base
            value = value * base + (int(c, 36) - (10 if base == 26 else 0) if base > 1 else 0)
        tweak = b"email" + bytes(shape)
        value, new = self.permute(value, size, tweak, self.inverse), []
        for c, base in zip(reversed(local), reversed(shape)):
            value, digit = divmod(value, base)
            kept = c if base == 1 else _DIGITS[digit] if base == 10 else _LETTERS[digit]
            new.append(kept.upper() if c.isupper() else kept)
        return "".join(reversed(new)) + "@" + domain

    def key(self, text: str) -> str | None:
        if not (any(c.isdigit() for c in text) and any(c.isalpha() for c in text)):
            return None
        return self._symbols(text, "0123456789" + ("ABCDEF" if text.upper() == text else "abcdef"), "key")

    def date(self, text: str) -> str | None:
        first, last = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
        sep = next(c for c in text if not c.isdigit())
        a, b, c = (int(x) for x in text.split(sep))
        try:
            if sep == "-":
                day = datetime.date(a, b, c)
            elif sep == "." or a > 12:
                day = datetime.date(c, b, a)
            else:
                day = datetime.date(c, a, b)
        except ValueError:
            return None
        if not first <= day.toordinal() <= last:
            return None
        # Day-first and month-first writings are permuted within their own dates, so that
        # the result reads the same way.
        tweak = b"date"
        value, size = day.toordinal() - first, last - first + 1
        if sep == "/":
            swapped, tweak = a > 12, b"date-dm" if a > 12 else b"date-md"
            while True:
                value = self.permute(value, size, tweak, self.inverse)
                day = datetime.date.fromordinal(first + value)
                if not swapped or day.day > 12:
                    break
            a, b, c = (day.day, day.month, day.year) if swapped else (day.month, day.day, day.year)
        else:
            day = datetime.date.fromordinal(first + self.permute(value, size, tweak, self.inverse))
            a, b, c = (day.year, day.month, day.day) if sep == "-" else (day.day, day.month, day.year)
        parts = text.split(sep)
        wide = [len(p) for p in parts] if sep == "-" else [2, 2, 4]
        padded = [str(x).zfill(w) for x, w in zip((a, b, c), wide)]
        return sep.join(padded)

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int, str]]]:
        """The new text and the replaced spans ``(kind, start, end, pseudonym)``."""
        out, done, spans = [], 0, []
        at = 0
        while match := _PATTERN.search(text, at):
            kind = match.lastgroup
            new = getattr(self, kind)(match[0]) if kind in self.kinds else None
            if new is None:
                # Not valid: look again after its first run of digits or letters.
                run = re.compile(r"[0-9A-Za-z]+|.", re.DOTALL).match(text, match.start())
                at = run.end()
                continue
            out += [text[done : match.start()], new]
            spans.append((kind, match.start(), match.end(), new))
            done = at = match.end()
        return "".join(out) + text[done:], spans


def pseudonymize(
    docs: DataFrame,
    key: bytes,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    kinds: tuple[str, ...] = KINDS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Texts with personal numbers, dates and addresses replaced by keyed pseudonyms.

    A candidate counts only if it is valid: card numbers by their check digit, IBANs by
    mod 97, national numbers by their ranges, IP addresses by octets, dates by the
    calendar, phone numbers by length. It is then permuted by a keyed Feistel network
    within its own format, so the pseudonym is valid too, keeps its punctuation, and the
    same value has the same pseudonym in every document. Domains of e-mail addresses and
    country codes stay. Map-only: rows never meet.

    Returns ``doc_id``, ``text``, ``n_replaced`` and ``spans`` (kind, start and end in
    code points of the input, pseudonym), then the columns named by ``keep``. A null text
    stays null with no spans; empty texts, repeated rows and null ids pass through; other
    columns are not read.
    """
    ship_package(docs.sparkSession)
    keep = keep or []
    span_list = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("pseudonym", pa.string())])
    )

    def replace(batches):
        worker = Pseudonyms(key, kinds)
        for batch, texts in slices(batches, "text"):
            suspect = pc.match_substring_regex(texts, _SUSPECT).to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(suspect)
            found = [worker.replace(t) for t in texts.take(pa.array(rows)).to_pylist()]
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            for row, (_, own) in zip(rows.tolist(), found):
                spans[row] = [dict(zip(("kind", "start", "end", "pseudonym"), x)) for x in own]
            changed = pa.array([t for t, _ in found], texts.type)
            new = pc.replace_with_mask(texts, pa.array(suspect), changed)
            new = pc.if_else(batch.column(1).is_null(), pa.scalar(None, texts.type), new)
            columns = [
                batch.column(0),
                new.cast(pa.string()),
                pa.array([len(s) for s in spans], pa.int64()),
                pa.array(spans, span_list),
                *(batch.column(i) for i in range(2, batch.num_columns)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*names, *keep])

    names = ["doc_id", "text", "n_replaced", "spans"]
    plain = rows_of(docs, id_col, text_col, *keep).toDF("doc_id", "text", *keep)
    kinds_of = dict(plain.dtypes)
    schema = f"doc_id {kinds_of['doc_id']}, text string, n_replaced long, spans array<struct<kind:string,start:bigint,end:bigint,pseudonym:string>>"
    schema += "".join(f", `{c}` {kinds_of[c]}" for c in keep)
    return plain.withColumn("text", F.col("text").cast("string")).mapInArrow(replace, schema)
