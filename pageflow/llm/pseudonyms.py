"""Format-preserving pseudonyms for personal data in texts.

A value is found by a pattern, validated (check digits, calendar, number ranges), mapped to a number below
the count of valid values of its format, permuted by a keyed Feistel network over exactly that range, and
written back in the same format. Equal values become equal pseudonyms in all documents, whatever their
separators, and with the key the permutation can be undone. Values that fail validation are left alone; an
IBAN ends at its country's length where a space follows, and the search goes on inside what failed. A date may be followed
by T and a time.

Kinds: e-mail addresses (local part), payment cards (Luhn), IBANs (mod 97), telephone numbers, social
security numbers, IPv4 addresses, dates, and hexadecimal secrets.

Results: a NULL text stays NULL and has no values; repeated rows and NULL ids each give a row; texts are
handled whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Longer runs of letters and digits are permuted in pieces, so that numbers stay of moderate length.
PIECE = 1_000
ROUNDS = 10
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY

IBAN_LENGTHS = {
    country: int(n)
    for n, countries in (
        line.split(":")
        for line in (
            "15:NO", "16:BE", "18:DK FI FO GL NL SD FK", "19:MK SI", "20:AT BA EE KZ LT LU XK MN", "21:CH HR LI LV",
            "22:BG BH CR DE GB GE IE ME RS VA", "23:AE GI IL IQ TL OM SO", "24:AD CZ ES MD PK RO SA SE SK TN VG",
            "25:LY PT ST", "26:IS TR", "27:BI DJ FR GR IT MC MR SM", "28:AL AZ BY CY DO GT HU LB NI PL SV",
            "29:BR EG PS QA UA", "30:JO KW MU YE", "31:MT SC", "32:LC", "33:RU",
        )
    )
    for country in countries.split()
}


class Permutation:
    """A keyed bijection of [0, size): an alternating Feistel network over a * b >= size, walked until inside."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size = size
        self.a = isqrt(max(size - 1, 0)) + 1
        self.b = -(-size // self.a)
        self.state = hashlib.blake2b(f"{kind}/{size}".encode(), key=key[:64], digest_size=32)

    def _f(self, turn: int, x: int, modulus: int) -> int:
        h = self.state.copy()
        h.update(turn.to_bytes(1, "big") + x.to_bytes((x.bit_length() + 8) // 8, "big"))
        return int.from_bytes(h.digest(), "big") % modulus

    def _once(self, value: int, turns: range, sign: int) -> int:
        left, right = value % self.a, value // self.a
        for turn in turns:
            if turn % 2:
                right = (right + sign * self._f(turn, left, self.b)) % self.b
            else:
                left = (left + sign * self._f(turn, right, self.a)) % self.a
        return right * self.a + left

    def forth(self, value: int) -> int:
        value = self._once(value, range(ROUNDS), 1)
        while value >= self.size:
            value = self._once(value, range(ROUNDS), 1)
        return value

    def back(self, value: int) -> int:
        value = self._once(value, range(ROUNDS - 1, -1, -1), -1)
        while value >= self.size:
            value = self._once(value, range(ROUNDS - 1, -1, -1), -1)
        return value


def luhn_digit(payload: str) -> int:
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_check(country: str, account: str) -> int:
    digits = "".join(str(int(c, 36)) for c in account + country + "00")
    return 98 - int(digits) % 97


def iban_start(found: str) -> str:
    """The characters up to the length of the country's IBANs, if a space follows there; or else all."""
    left = IBAN_LENGTHS.get(found[:2], 0)
    for k, c in enumerate(found):
        if not left and c == " ":
            return found[:k] if k else found
        left -= c != " "
    return found


def refill(shape: str, characters: str, accept) -> str:
    """The shape with its accepted characters replaced in order."""
    new = iter(characters)
    return "".join(next(new) if accept(c) else c for c in shape)


def pieces_of(value: str) -> list[tuple[str, str]]:
    """A value in pieces of at most PIECE characters, each with a name of its turn; a short one is one piece without."""
    if len(value) <= PIECE:
        return [("", value)]
    return [(f".{at // PIECE}", value[at : at + PIECE]) for at in range(0, len(value), PIECE)]


class Pseudonyms:
    """Replaces validated values under one key; ``undo`` gives them back."""

    PATTERN = re.compile(
        r"(?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
        r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
        r"|(?P<hex>(?<![A-Za-z0-9])(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{16,}(?![A-Za-z0-9]))"
        r"|(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))"
        r"|(?P<date>(?<![\w-])(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4})(?=T\d\d(?::?\d\d)|(?![\w-])))"
        r"|(?P<ssn>(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-]))"
        r"|(?P<card>(?<![\w-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-]))"
        r"|(?P<phone>(?<![\w(+])(?:\+1[ .-]?)?(?:\([2-9]\d\d\) ?|[2-9]\d\d[ .-])[2-9]\d\d[ .-]\d{4}(?!\w)"
        r"|(?<![\w+])\+[2-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\w))",
        re.ASCII,
    )
    HINT = re.compile(r"[0-9@]")

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.backwards = key, back

    @functools.lru_cache(maxsize=256)  # noqa: B019
    def _range(self, kind: str, size: int) -> Permutation:
        return Permutation(self.key, kind, size)

    def _moved(self, kind: str, value: int, size: int) -> int:
        permutation = self._range(kind, size)
        return permutation.back(value) if self.backwards else permutation.forth(value)

    def _digits(self, kind: str, digits: str) -> str:
        n = len(digits)
        return str(self._moved(f"{kind}{n}", int(digits), 10**n)).zfill(n) if n else digits

    def email(self, found: str) -> str:
        local, _, domain = found.partition("@")
        return "".join(self._local(piece, turn) for turn, piece in pieces_of(local)) + "@" + domain

    def _local(self, local: str, turn: str) -> str:
        # Letters keep their case and digits stay digits; equal addresses in another case stay linked.
        letters = [c for c in local if c.isalpha()]
        digits = "".join(c for c in local if c.isdigit())
        number, size = 0, 1
        for c in letters:
            number, size = number * 26 + ord(c.lower()) - 97, size * 26
        number, size = number * 10 ** len(digits) + int(digits or 0), size * 10 ** len(digits)
        if size == 1:
            return local
        number = self._moved(f"email{len(letters)}{turn}", number, size)
        number, tail = divmod(number, 10 ** len(digits))
        drawn = []
        for c in reversed(letters):
            number, at = divmod(number, 26)
            drawn.append(chr(97 + at).upper() if c.isupper() else chr(97 + at))
        new = refill(local, "".join(reversed(drawn)), str.isalpha)
        return refill(new, str(tail).zfill(len(digits)) if digits else "", str.isdigit)

    def iban(self, found: str) -> str | None:
        plain = found.replace(" ", "")
        country, check, account = plain[:2], plain[2:4], plain[4:]
        if not check.isdigit() or iban_check(country, account) != int(check):
            return None
        digits = "".join(c for c in account if c.isdigit())
        account = refill(account, self._digits("iban", digits), str.isdigit)
        return refill(found, f"{country}{iban_check(country, account):02d}{account}", str.isalnum)

    def hex(self, found: str) -> str:
        out = []
        for turn, piece in pieces_of(found):
            n = len(piece)
            out.append(f"{self._moved(f'hex{n}{turn}', int(piece, 16), 16**n):0{n}x}")
        return "".join(out)

    def ip(self, found: str) -> str | None:
        parts = [int(x) for x in found.split(".")]
        if max(parts) > 255:
            return None
        value = self._moved("ip", int.from_bytes(bytes(parts), "big"), 1 << 32)
        return ".".join(map(str, value.to_bytes(4, "big")))

    def date(self, found: str) -> str | None:
        mark = next(c for c in found if not c.isdigit())
        parts = [int(x) for x in found.split(mark)]
        first = len(found.split(mark)[0]) == 4
        american = mark == "/" and not first and parts[1] > 12
        year, month, day = parts if first else (parts[2], parts[0], parts[1]) if american else reversed(parts)
        try:
            at = datetime.date(year, month, day).toordinal() - FIRST_DAY
        except ValueError:
            return None
        if not 0 <= at < DAYS:
            return None
        new = datetime.date.fromordinal(FIRST_DAY + self._moved("date", at, DAYS))
        if american and new.day <= 12:
            # Both orders could be read from it, and day first is what such a text would mean.
            return self._american(new, at)
        order = (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}")
        return mark.join(order if first else (order[1], order[2], order[0]) if american else tuple(reversed(order)))

    def _american(self, new: datetime.date, at: int) -> str:
        """Walks on until the day leaves no doubt that the month comes first."""
        while new.day <= 12:
            new = datetime.date.fromordinal(FIRST_DAY + self._moved("date", new.toordinal() - FIRST_DAY, DAYS))
        return f"{new.month:02d}/{new.day:02d}/{new.year:04d}"

    def ssn(self, found: str) -> str | None:
        area, group, serial = (int(x) for x in found.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        place = (area - 1 - (area > 666)) * 99 * 9999 + (group - 1) * 9999 + serial - 1
        place = self._moved("ssn", place, 898 * 99 * 9999)
        area, rest = divmod(place, 99 * 9999)
        return f"{area + 1 + (area >= 665):03d}-{rest // 9999 + 1:02d}-{rest % 9999 + 1:04d}"

    def card(self, found: str) -> str | None:
        digits = "".join(c for c in found if c.isdigit())
        if luhn_digit(digits[:-1]) != int(digits[-1]):
            return None
        payload = digits[0] + self._digits(f"card{digits[0]}", digits[1:-1])
        return refill(found, payload + str(luhn_digit(payload)), str.isdigit)

    def phone(self, found: str) -> str | None:
        digits = "".join(c for c in found if c.isdigit())
        abroad = found.startswith("+") and not found.startswith("+1")
        if abroad:
            if not 8 <= len(digits) <= 15:
                return None
            return refill(found, digits[:2] + self._digits(f"phone{digits[:2]}", digits[2:]), str.isdigit)
        head, own = digits[:-10], digits[-10:]
        value = (((int(own[0]) - 2) * 100 + int(own[1:3])) * 8 + int(own[3]) - 2) * 10**6 + int(own[4:])
        value = self._moved("phone1", value, 64 * 10**8)
        value, line = divmod(value, 10**6)
        value, office = divmod(value, 8)
        return refill(found, f"{head}{value // 100 + 2}{value % 100:02d}{office + 2}{line:06d}", str.isdigit)

    def apply(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with pseudonyms, and place, length and kind of each value replaced in the old text."""
        if not self.HINT.search(text):
            return text, []
        parts, spans, at = [], [], 0
        m = self.PATTERN.search(text)
        while m:
            whole, start = m[0], m.start()
            found = iban_start(whole) if m.lastgroup == "iban" else whole
            new = getattr(self, m.lastgroup)(found)
            if new is None and found != whole:
                found = whole
                new = getattr(self, m.lastgroup)(found)
            if new is not None:
                parts += [text[at:start], new]
                spans.append((start, len(found), m.lastgroup))
                at = start + len(found)
            m = self.PATTERN.search(text, at if new is not None else start + 1)
        return ("".join([*parts, text[at:]]) if spans else text), spans


def pseudonymise(
    docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", undo: bool = False
) -> DataFrame:
    """One row per document: id, its text with pseudonyms, and the spans replaced in the old text."""
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("kind", pa.string())]))

    def run(batches):
        worker = Pseudonyms(key, undo)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts, spans = [], []
                for text in part.column("_text").to_pylist():
                    new, found = worker.apply(text) if text is not None else (None, [])
                    texts.append(new)
                    spans.append([{"start": s, "length": n, "kind": k} for s, n, k in found])
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(texts, pa.string()), pa.array(spans, spans_type)], ["_id", "_text", "spans"])

    schema = "_id long, _text string, spans array<struct<start: long, length: long, kind: string>>"
    return rows.mapInArrow(run, schema).select(F.col("_id").alias(id_col), F.col("_text").alias(text_col), "spans")
