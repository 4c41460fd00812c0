"""PII: format-preserving pseudonyms by keyed Feistel permutations.

A value that is found and validated (check digits, calendar, ranges) is turned into digits of the
set of all valid values of its format, permuted there with a key, and written back with the same
separators. The permutation has no table: equal values get equal pseudonyms in every document and
task, different ones different ones, and who holds the key can turn them back.

The key comes from the Spark option KEY_OPTION. Where that is not set, a key is drawn that only this
process knows: its pseudonyms are linked among each other, and nobody can turn them back later.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import math
import re
import secrets
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents_of, small_batches, table

#: The Spark option that holds the key.
KEY_OPTION = "spark.helixframe.pseudonyms.key"
ROUNDS = 8

DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"


_drawn = secrets.token_bytes(32)


def session_key(spark: SparkSession) -> bytes:
    named = spark.conf.get(KEY_OPTION, None)
    return named.encode() if named else _drawn


class Feistel:
    """Keyed permutations of the numbers below n, or of those among them that are valid."""

    def __init__(self, key: bytes):
        self.key = key

    def step(self, label: str, k: int, half: int, size: int) -> int:
        digest = hmac.new(self.key, f"{label}/{k}/{half}".encode(), hashlib.sha256).digest()
        return int.from_bytes(digest, "big") % size

    def once(self, label: str, x: int, n: int, back: bool = False) -> int:
        b = max(1, math.isqrt(n))
        a = -(-n // b)  # numbers below a * b; those from n on are walked past
        while True:
            high, low = divmod(x, b)
            for k in range(ROUNDS)[:: -1 if back else 1]:
                sign = -1 if back else 1
                if k % 2:
                    low = (low + sign * self.step(label, k, high, b)) % b
                else:
                    high = (high + sign * self.step(label, k, low, a)) % a
            x = high * b + low
            if x < n:
                return x

    def permuted(self, label: str, x: int, n: int, valid: Callable[[int], bool] = lambda _: True, back: bool = False) -> int:
        """The next valid number on the cycle of x, which is itself a permutation of the valid numbers."""
        while True:
            x = self.once(f"{label}/{n}", x, n, back)
            if valid(x):
                return x


def luhn(digits: str) -> bool:
    return sum(int(d) if i % 2 else (2 * int(d) - 9 * (int(d) > 4)) for i, d in enumerate(digits, len(digits) % 2)) % 10 == 0


def luhn_digit(payload: str) -> str:
    return next(d for d in DIGITS if luhn(payload + d))


def refill(pattern: str, characters: str, of: str) -> str:
    """The pattern with its characters of the class, in turn, replaced."""
    fresh = iter(characters)
    return "".join(next(fresh) if c in of else c for c in pattern)


def is_hex(text: str) -> bool:
    """Hex digits alone, letters among them: digits alone are a number."""
    return all(c in HEX for c in text) and not text.isdigit()


def letters(f: Feistel, label: str, text: str, back: bool) -> str:
    """Each digit, small and capital letter becomes one of its kind (hex digits, if the text is hex); the rest stays."""
    as_hex = is_hex(text)
    kinds = [HEX] * len(text) if as_hex else [next((k for k in (DIGITS, LOWER, UPPER) if c in k), c) for c in text]
    n, x = math.prod(map(len, kinds)), 0
    for c, k in zip(text, kinds, strict=True):
        x = x * len(k) + k.index(c)

    def written(x: int) -> str:
        out = []
        for k in reversed(kinds):
            x, at = divmod(x, len(k))
            out.append(k[at])
        return "".join(reversed(out))

    label += "/" + ",".join(k[0] + str(len(k)) for k in kinds)
    return written(f.permuted(label, x, n, lambda y: is_hex(written(y)) == as_hex, back))


#: Digits of the groups in which card numbers are written, within a longer run of numbers.
CARD_SHAPES = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3))


def is_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and digits[0] in "23456" and luhn(digits)


def card(f: Feistel, m: re.Match, back: bool) -> list[tuple[int, int, str]]:
    """The cards of a run of digit groups: all of it if it is one, else the groups that have the shape of one."""

    def changed(text: str) -> str:
        digits = re.sub(r"\D", "", text)
        n = len(digits) - 2
        payload = digits[0] + f"{f.permuted('card', int(digits[1:-1]), 10**n, back=back):0{n}d}"
        return refill(text, payload + luhn_digit(payload), DIGITS)

    run = m[0]
    if is_card(re.sub(r"\D", "", run)):
        return [(0, len(run), changed(run))]
    groups = [(g.start(), g.end()) for g in re.finditer("[0-9]+", run)]
    found, i = [], 0
    while i < len(groups):
        sizes = [e - s for s, e in groups[i : i + 5]]
        for shape in ((sizes[0],), *CARD_SHAPES):
            begin, end = groups[i][0], groups[min(i + len(shape), len(groups)) - 1][1]
            if tuple(sizes[: len(shape)]) == shape and is_card(re.sub(r"\D", "", run[begin:end])):
                found.append((begin, end, changed(run[begin:end])))
                i += len(shape) - 1
                break
        i += 1
    return found


def american(x: int) -> bool:
    return f"{x:010d}"[0] >= "2" and f"{x:010d}"[3] >= "2"


def phone(f: Feistel, m: re.Match, back: bool) -> str | None:
    digits = re.sub(r"\D", "", m["number"])
    if (m["country"] or "+1") == "+1":
        valid = american
        if len(digits) == 10 and m["country"] and not american(int(digits)):  # marked as a phone all the same: permuted among its like
            valid = lambda x: not american(x)
        if len(digits) != 10 or not valid(int(digits)):
            return None
        new = f"{f.permuted('phone1', int(digits), 10**10, valid, back):010d}"
    else:
        if not 6 <= len(digits) <= 13 or len(digits) + len(m["country"]) - 1 > 15:
            return None
        new = f"{f.permuted('phone', int(digits), 10 ** len(digits), back=back):0{len(digits)}d}"
    return m[0][: m.start("number") - m.start()] + refill(m["number"], new, DIGITS)


def valid_ssn(x: int) -> bool:
    area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def ssn(f: Feistel, m: re.Match, back: bool) -> str | None:
    x = int(m[0].replace("-", ""))
    return refill(m[0], f"{f.permuted('ssn', x, 10**9, valid_ssn, back):09d}", DIGITS) if valid_ssn(x) else None


def public_ip(x: int) -> bool:
    a, b = x >> 24, x >> 16 & 255
    return 0 < a < 224 and a not in (10, 127) and (a, b) not in ((192, 168), (169, 254)) and not (a == 172 and 16 <= b < 32) and not (a == 100 and 64 <= b < 128)


def ip(f: Feistel, m: re.Match, back: bool) -> str | None:
    parts = [int(p) for p in m[0].split(".")]
    x = int.from_bytes(bytes(parts), "big") if max(parts) < 256 else 0
    if not public_ip(x) or any(p != str(int(p)) for p in m[0].split(".")):
        return None
    return ".".join(map(str, f.permuted("ip", x, 2**32, public_ip, back).to_bytes(4, "big")))


#: Dates of these years are taken as such.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


#: Years of two digits are permuted among each other as years of this century, whose leap years they have.
FIRST_SHORT, LAST_SHORT = datetime.date(2000, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def short_day(order: str, parts: Sequence[str]) -> int | None:
    at = dict(zip(order, map(int, parts), strict=True))
    try:
        return datetime.date(2000 + at["y"], at["m"], at["d"]).toordinal()
    except ValueError:
        return None


def short_date(f: Feistel, parts: tuple[str, str, str], s: str, back: bool) -> str | None:
    """A date with a year of two digits; day and month have two as well, or it might be any number."""
    if any(len(p) != 2 for p in parts):
        return None
    orders = ["dmy", "mdy", "ymd"] if s != "/" else ["mdy", "dmy", "ymd"]

    def written(order: str, x: int) -> list[str]:
        day = datetime.date.fromordinal(FIRST_SHORT + x)
        return [f"{ {'y': day.year % 100, 'm': day.month, 'd': day.day}[c]:02d}" for c in order]

    for k, order in enumerate(orders):
        day = short_day(order, parts)
        if day is not None:
            # What only fits a later order stays so.
            fits = lambda x, k=k, order=order: all(short_day(o, written(order, x)) is None for o in orders[:k])
            return s.join(written(order, f.permuted(f"short date {order} {orders[0]}", day - FIRST_SHORT, LAST_SHORT - FIRST_SHORT + 1, fits, back)))
    return None


def date(f: Feistel, m: re.Match, back: bool) -> str | None:
    a, s, b, c = m["a"], m["s"], m["b"], m["c"]
    if len(a) != 4 and len(c) != 4:
        return short_date(f, (a, b, c), s, back)
    if len(a) == 4:
        orders = [("ymd", (a, b, c))]
    else:
        orders = [("dmy", (c, b, a)), ("mdy", (c, a, b))] if s != "/" else [("mdy", (c, a, b)), ("dmy", (c, b, a))]
    for k, (order, (y, mo, d)) in enumerate(orders):
        try:
            day = datetime.date(int(y), int(mo), int(d)).toordinal()
        except ValueError:
            continue
        if FIRST_DAY <= day <= LAST_DAY:
            # Where day and month may be either, what only fits the second order stays so: its day is beyond 12.
            fits = lambda x, k=k: not k or datetime.date.fromordinal(FIRST_DAY + x).day > 12
            new = datetime.date.fromordinal(FIRST_DAY + f.permuted(f"date{k}", day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, fits, back))
            year, month, dom = f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"
            return s.join({"ymd": (year, month, dom), "dmy": (dom, month, year), "mdy": (month, dom, year)}[order])
    return None


def iban_checked(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def iban(f: Feistel, m: re.Match, back: bool) -> list[tuple[int, int, str]]:
    """The number with as many of the groups that follow as its check digits allow."""
    ends = [g.end() for g in re.finditer(r"\S+", m[0])]
    for end in reversed(ends):
        plain = m[0][:end].replace(" ", "")
        country, check, rest = plain[:2], plain[2:4], plain[4:]
        if not 15 <= len(plain) <= 34 or iban_checked(country, rest) != check:
            continue
        new = letters(f, "iban", rest, back) if not all(c in HEX for c in rest) or rest.isdigit() else None
        if rest.isdigit():
            new = f"{f.permuted('iban', int(rest), 10 ** len(rest), back=back):0{len(rest)}d}"
        return [(0, end, refill(m[0][:end], country + iban_checked(country, new) + new, DIGITS + UPPER))] if new else []
    return []


def email(f: Feistel, m: re.Match, back: bool) -> str | None:
    return letters(f, "email", m["local"], back) + m[0][len(m["local"]) :]


#: A longer secret is permuted in pieces of so many characters: half of one is well within the 256 bits that a round can change.
SECRET_CHARS = 64


def like_a_token(value: str) -> bool:
    """Long, or with digits, or hex: not a word of prose. Its pseudonym is like a token too."""
    return len(value) >= 16 or any(c in DIGITS for c in value) or is_hex(value)


def secret(f: Feistel, m: re.Match, back: bool) -> str | None:
    """The value after a name; behind a colon or a scheme, where prose may follow, only what is quoted or like a token."""
    at = m.start("secret") - m.start()
    value = m["secret"]
    if len(value) < 8 or not (m["sure"] or like_a_token(value)):
        return None
    new = "".join(letters(f, "secret", value[i : i + SECRET_CHARS], back) for i in range(0, len(value), SECRET_CHARS))
    return m[0][:at] + new + m[0][at + len(value) :]


#: Names that stand before a secret, and the secret: the whole run of the characters that tokens have, up to a full stop that ends it.
_NAME = r"(?i:password|passwd|pwd|token|secret|api[_-]?key|(?:secret|access|private)[_-]?key)[\"']?"
_TOKEN = r"(?!=)[A-Za-z0-9_~+/=-]+(?:\.+[A-Za-z0-9_~+/=-]+)*"
#: In this order; what one has taken is out of reach of the next. The character must occur in the text.
KINDS: list[tuple[str, str, re.Pattern, Callable]] = [
    ("email", "@", re.compile(r"(?<![A-Za-z0-9._%+-])(?P<local>[A-Za-z0-9._%+-]{1,64})@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])"), email),
    ("secret", "=", re.compile(_NAME + r"\s{0,3}(?P<sure>=)\s{0,3}[\"']?(?P<secret>" + _TOKEN + ")"), secret),
    ("secret", ":", re.compile(_NAME + r"\s{0,3}:\s{0,3}(?P<sure>[\"'])(?P<secret>[^\"'\s]+)[\"']"), secret),
    ("secret", ":", re.compile(_NAME + r"\s{0,3}:(?P<sure>(?!))?\s{0,3}(?P<secret>" + _TOKEN + ")"), secret),
    ("secret", "earer ", re.compile(r"(?<![A-Za-z0-9])[Bb]earer(?P<sure>(?!))? {1,3}(?P<secret>" + _TOKEN + ")"), secret),
    ("secret", "AKIA", re.compile(r"(?<![A-Za-z0-9])(?P<sure>AKIA)(?P<secret>[0-9A-Z]{16})(?![A-Za-z0-9])"), secret),
    ("iban", "", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"), iban),
    ("ip", ".", re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w-]|\.[0-9])"), ip),
    ("phone", "+", re.compile(r"(?<![\w+])(?P<country>\+1)[ .-]?(?P<number>\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4})(?![\w-])"), phone),
    ("phone", "+", re.compile(r"(?<![\w+])(?P<country>\+[0-9]{1,3})[ .-]?(?P<number>(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){1,4})(?![\w-])"), phone),
    ("phone", "", re.compile(r"(?<![\w+.-])(?P<country>(?!))?(?P<number>(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})(?![\w-])"), phone),
    ("card", "", re.compile(r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,}(?![\w-])"), card),
    ("ssn", "-", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"), ssn),
    ("date", "", re.compile(r"(?<![\w./-])(?P<a>[0-9]{4}|[0-9]{1,2})(?P<s>[-/.])(?P<b>[0-9]{1,2})(?P=s)(?P<c>[0-9]{4}|[0-9]{1,2})(?:(?=[Tt][0-9]{2}:?[0-9]{2})|(?![\w/-]|\.[0-9]))"), date),
]
_ANY = re.compile(r"[0-9@=:]|AKIA|earer ")


def changes(change: Callable, m: re.Match, feistel: Feistel, back: bool) -> list[tuple[int, int, str]]:
    """Start, end and new text of the values within a match."""
    found = change(feistel, m, back)
    return found if isinstance(found, list) else [(0, len(m[0]), found)] if found is not None else []


def pseudonymised(text: str, feistel: Feistel, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and kind, start and end of each there, in order."""
    if not _ANY.search(text):
        return text, []
    pieces: list[tuple[str, str | None]] = [(text, None)]
    for kind, needs, pattern, change in KINDS:
        if needs and needs not in text:
            continue
        now: list[tuple[str, str | None]] = []
        for piece, taken in pieces:
            if taken or len(piece) < 4:
                now.append((piece, taken))
                continue
            at = 0
            for m in pattern.finditer(piece):
                for start, end, new in changes(change, m, feistel, back):
                    now += [(piece[at : m.start() + start], None), (new, kind)]
                    at = m.start() + end
            now.append((piece[at:], None))
        pieces = now
    spans, at = [], 0
    for piece, taken in pieces:
        if taken:
            spans.append((taken, at, at + len(piece)))
        at += len(piece)
    return "".join(p for p, _ in pieces), spans


def restored(text: str, spans: list[tuple[str, int, int]], feistel: Feistel) -> str:
    """The text before: each span, where a pseudonym of this kind is known to stand, turned back."""
    out, at = [], 0
    for kind, start, end in spans:
        value = text[start:end]
        for name, _, pattern, change in KINDS:
            m = pattern.fullmatch(value) if name == kind else None
            new = changes(change, m, feistel, True) if m else []
            if new and new[0][:2] == (0, len(value)):
                value = new[0][2]
                break
        out += [text[at:start], value]
        at = end
    return "".join([*out, text[at:]])


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
SPANS_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def pseudonyms(docs: DataFrame, *, key: bytes, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, text with pseudonyms, spans (kind, start, end in code points) of each document, and the columns to carry.

    Values that fail their check (Luhn, modulo 97, calendar, ranges) are no personal data and stay.
    Null and empty texts give an empty text; rows that repeat a doc_id are treated one by one and a
    null doc_id stays; other columns are ignored. An empty table gives an empty result.
    """
    docs = documents_of(docs, *carry)
    small_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField("spans", SPANS_TYPE)])

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for batch in batches:
            found = [pseudonymised(t, feistel) for t in batch.column(1).to_pylist()]
            spans = [[{"kind": k, "start": i, "end": j} for k, i, j in s] for _, s in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in found], pa.string()), *batch.columns[2:], pa.array(spans, SPANS)], [*batch.schema.names, "spans"])

    return docs.mapInArrow(change, schema)


def originals(docs: DataFrame, *, key: bytes, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id and text as it was, of documents with pseudonyms (doc_id, text, spans), and the columns to carry.

    The spans say where pseudonyms stand, so whatever stands around them cannot mislead. Null spans
    mean none.
    """
    docs = documents_of(docs, F.coalesce("spans", F.array().cast(SPANS_TYPE)).alias("spans"), *carry)
    small_batches(docs.sparkSession)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for batch in batches:
            found = [restored(t, [(s["kind"], s["start"], s["end"]) for s in spans], feistel) for t, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), *batch.columns[3:]], [n for n in batch.schema.names if n != "spans"])

    return docs.mapInArrow(change, T.StructType([f for f in docs.schema.fields if f.name != "spans"]))


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = pseudonyms(table(spark, sf_dir, "documents"), key=session_key(spark))
    return changed.select("doc_id", "text", F.size("spans").cast("long").alias("n_values"), "spans")
