"""Format-preserving pseudonyms for private numbers, dates and addresses.

What a pattern finds is validated (check digits, octets, calendar) and then replaced by another value of the same
format: a keyed Feistel network permutes the format's values, walking on until it meets a valid one. Equal
values get equal pseudonyms in all documents, different values different ones, and the key gives them back.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm.chunks import slices
from spanlake.llm.scratch import unused

ROUNDS = 8
KINDS = ("email", "iban", "secret", "key", "ip", "ip6", "phone", "ssn", "date", "card")
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal() - datetime.date(1900, 1, 1).toordinal()
#: Characters of an IBAN by country (fixed values); those of other countries are tried whole.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21,
    "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "RS": 22,
    "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26, "UA": 29,
}
DIGITS, LOWER, UPPER, HEX, HEX_UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef", "0123456789ABCDEF"

#: Code points from which letters of addresses come: ASCII, Latin-1 and Latin Extended-A, Greek, Cyrillic (fixed values).
SCRIPTS = ((0x41, 0x7A), (0xC0, 0x17F), (0x391, 0x3C9), (0x400, 0x45F))
#: Small letters by script, each with one capital in the same script; other letters of a script stay as they are.
ALPHABETS = tuple("".join(x for x in map(chr, range(a, b + 1)) if x.isalpha() and x != x.upper() and x.upper().lower() == x and a <= ord(x.upper()[0]) and len(x.upper()) == 1) for a, b in SCRIPTS)
SMALL = {x.upper(): x for alphabet in ALPHABETS for x in alphabet}
LETTERS = "".join(x for a, b in SCRIPTS for x in map(chr, range(a, b + 1)) if x.isalpha())

FOUND = re.compile(
    rf"(?P<email>(?<![{LETTERS}0-9._%+-])[{LETTERS}0-9_%+-]+(?:\.[{LETTERS}0-9_%+-]+)*@[{LETTERS}0-9-]+(?:\.[{LETTERS}0-9-]+)*\.[A-Za-z]{{2,}}(?![{LETTERS}0-9-]))"
    r"|(?P<secret>(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z]))"
    r"|(?P<iban>(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z]))"
    r"|(?P<key>(?<![0-9A-Za-z])(?:sk-|pk-|AKIA|ASIA|gh[pousr]_|glpat-|xox[abp]-)(?=[A-Za-z_-]*[0-9])[0-9A-Za-z_-]{16,}(?![0-9A-Za-z]))"
    r"|(?P<ip6>(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7})(?![0-9A-Za-z:]))"
    r"|(?P<ip>(?<![0-9.vV])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    r"|(?P<date>(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/-]|\.[0-9]))"
    r"|(?P<card>(?<![0-9A-Za-z.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]|[.-][0-9]))"
    r"|(?P<phone>(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z]))"
)


MAY = re.compile("[0-9@]")


class Permuter:
    """A keyed permutation of range(size) for any size, a different one for each label."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def stream(self, told: bytes, n: int) -> bytes:
        return hashlib.shake_256(self.key + told).digest(n)

    def _step(self, label: str, size: int, turn: int, value: int) -> int:
        """A number wider than any half, so that every place of the half changes."""
        wide = size.bit_length() // 8 + 9
        return int.from_bytes(self.stream(f"{label}|{turn}|".encode() + size.to_bytes(wide, "big") + value.to_bytes(wide, "big"), wide), "big")

    def places(self, values: np.ndarray, sizes: np.ndarray, label: str, back: bool = False) -> np.ndarray:
        """A permutation of the rows of numbers, the i-th below sizes[i]: halves take turns, and each number of one half is
        moved by a number drawn from the other. Time and memory follow the length."""
        half, out = len(values) // 2, values.astype(np.int64)
        parts = [(slice(0, half), slice(half, None)), (slice(half, None), slice(0, half))]
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            moved, told = parts[turn % 2]
            n = len(out[moved])
            drawn = np.frombuffer(self.stream(f"{label}|{turn}|{len(out)}|".encode() + out[told].astype("<u2").tobytes(), 8 * n), "<u8")
            step = (drawn % sizes[moved].astype(np.uint64)).astype(np.int64)
            out[moved] = (out[moved] + (-step if back else step)) % sizes[moved]
        return out

    def __call__(self, value: int, size: int, label: str, back: bool = False) -> int:
        width = max(1, math.isqrt(max(0, size - 1)) + 1)
        height = -(-size // width)
        while True:
            a, b = divmod(value, width)
            for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
                sign = -1 if back else 1
                if turn % 2:
                    b = (b + sign * self._step(label, size, turn, a)) % width
                else:
                    a = (a + sign * self._step(label, size, turn, b)) % height
            value = a * width + b
            if value < size:
                return value


def to_number(digits: str) -> tuple[int, int]:
    return int(digits), 10 ** len(digits)


def luhn(digits: str) -> bool:
    double = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return sum(double[int(x)] if i % 2 else int(x) for i, x in enumerate(reversed(digits))) % 10 == 0


def iban_rest(text: str) -> int:
    return int("".join(str(int(x, 36)) for x in text[4:] + text[:4])) % 97


def parse_date(text: str) -> tuple[datetime.date, str] | None:
    """The day and its format; day and month stand in this order unless only the other one is a date."""
    mark = text[4] if text[4] in "-/" else text[2]
    for form in (["%Y-%m-%d"] if mark == "-" else ["%Y/%m/%d"] if text[4] == "/" else [f"%d{mark}%m{mark}%Y", f"%m{mark}%d{mark}%Y"]):
        try:
            return datetime.datetime.strptime(text, form).date(), form
        except ValueError:
            pass
    return None


class Pseudonyms:
    """One kind of value each; None where a value isn't valid and so is left alone."""

    def __init__(self, key: bytes):
        self.permute = Permuter(key)

    def _word(self, word: str, label: str, back: bool, classes: tuple[str, ...] = (DIGITS, LOWER, UPPER)) -> str:
        """Letters and digits permuted together, each within its class; all else stays in place."""
        known = {x: (i, alphabet.index(x)) for i, alphabet in enumerate(classes) for x in alphabet if x in word}
        at = [i for i, x in enumerate(word) if x in known]
        if not at:
            return word
        kind, value = np.array([known[word[i]] for i in at]).T
        shape = "".join(str(known[x][0]) if x in known else "." for x in word)
        new = self.permute.places(value, np.array([len(a) for a in classes])[kind], f"{label}|{shape}", back)
        out = list(word)
        for i, k, v in zip(at, kind.tolist(), new.tolist()):
            out[i] = classes[k][v]
        return "".join(out)

    def email(self, text: str, back: bool = False) -> str:
        """Name and host permuted as small letters; capitals stay where they are, so that addresses are linked whatever their case."""
        name, _, host = text.rpartition("@")
        rest, _, top = host.rpartition(".")
        word = f"{name}@{rest}"
        new = self._word("".join(SMALL.get(x, x) for x in word), f"email.{top.lower()}", back, (DIGITS, *ALPHABETS))
        return "".join(x.upper() if old in SMALL else x for x, old in zip(new, word)) + f".{top}"

    def secret(self, text: str, back: bool = False) -> str | None:
        upper = any(x in "ABCDEF" for x in text)
        if text.isdigit():
            return None
        return self._until(text, lambda x: self._word(x, "secret", back, (HEX_UPPER if upper else HEX,)), lambda x: not x.isdigit() and any(c.isalpha() for c in x))

    def _until(self, value, step, valid):
        """Walk on to the next value that is valid; as step permutes, this is a permutation of the valid ones."""
        value = step(value)
        while not valid(value):
            value = step(value)
        return value

    def key(self, text: str, back: bool = False) -> str | None:
        """A secret with a known beginning, which stays; it keeps a digit, by which it is found."""
        head = re.match(r"sk-|pk-|AKIA|ASIA|gh[pousr]_|glpat-|xox[abp]-", text).group()
        return head + self._until(text[len(head) :], lambda x: self._word(x, f"key{head}", back), lambda x: any(c.isdigit() for c in x))

    def iban(self, text: str, back: bool = False) -> tuple[str, int] | None:
        """The new text and how many characters of the old one it stands for: words after an IBAN may look like its end."""
        size = IBAN_LENGTHS.get(text[:2], sum(x != " " for x in text))
        end = next((i + 1 for i, x in enumerate(text) if x != " " and sum(y != " " for y in text[: i + 1]) == size), None)
        if end is None or (end < len(text) and text[end] != " "):
            return None
        bare = text[:end].replace(" ", "")
        if not 15 <= size <= 34 or iban_rest(bare) != 1:
            return None
        body = self._word(bare[4:], f"iban{bare[:2]}", back)
        new = iter(bare[:2] + f"{98 - iban_rest(bare[:2] + '00' + body):02d}" + body)
        return "".join(x if x == " " else next(new) for x in text[:end]), end

    def ip(self, text: str, back: bool = False) -> str | None:
        parts = text.split(".")
        if any(int(x) > 255 or x != str(int(x)) for x in parts):
            return None
        value = self.permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ip", back)
        return ".".join(map(str, value.to_bytes(4, "big")))

    def ip6(self, text: str, back: bool = False) -> str | None:
        """The address's 128 bits, written in the usual short form. One whose short form isn't found, such as ::1, stays in every form."""
        try:
            value = int(ipaddress.IPv6Address(text))
        except ValueError:
            return None
        shown = lambda x: str(ipaddress.IPv6Address(x))
        fits = lambda x: (m := FOUND.fullmatch(shown(x))) is not None and m.lastgroup == "ip6"
        return shown(self._until(value, lambda x: self.permute(x, 1 << 128, "ip6", back), fits)) if fits(value) else None

    def _digits(self, text: str, label: str, back: bool) -> str:
        """Digits permuted together, whatever stands between them; all else stays in place."""
        digits = "".join(x for x in text if x.isdigit())
        fill = iter(f"{self.permute(*to_number(digits), f'{label}{len(digits)}', back):0{len(digits)}d}")
        return "".join(next(fill) if x.isdigit() else x for x in text)

    def phone(self, text: str, back: bool = False) -> str | None:
        """The digits after the country's code, so that a number is linked with and without the code and in any format."""
        head = re.match(r"\+[0-9]{1,3}[ .-]?", text)
        head = head.group() if head else ""
        if not 9 <= sum(x.isdigit() for x in text[len(head) :]) <= 12:
            return None
        return head + self._digits(text[len(head) :], "phone", back)

    def ssn(self, text: str, back: bool = False) -> str | None:
        valid = lambda x: x[:3] not in ("000", "666") and x[0] != "9" and x[4:6] != "00" and x[7:] != "0000"
        return self._until(text, lambda x: self._digits(x, "ssn", back), valid) if valid(text) else None

    def date(self, text: str, back: bool = False) -> str | None:
        parsed = parse_date(text)
        if parsed is None or not 0 <= parsed[0].toordinal() - FIRST_DAY < DAYS:
            return None
        # Days after the 12th, which alone can stand behind a month, go to such days and others to others: a day has one pseudonym in all formats.
        day = lambda n: datetime.date.fromordinal(FIRST_DAY + n)
        late = parsed[0].day > 12
        new = self._until(parsed[0].toordinal() - FIRST_DAY, lambda n: self.permute(n, DAYS, "date", back), lambda n: (day(n).day > 12) == late)
        return day(new).strftime(parsed[1])

    def card(self, text: str, back: bool = False) -> str | None:
        digits = [x for x in text if x.isdigit()]
        if not luhn("".join(digits)) or len(set(digits)) == 1:
            return None
        step = lambda x: (y := self._digits(x, "card", back)) + next(d for d in DIGITS if luhn(y + d))
        new = step("".join(digits[:-1]))
        while len(set(new)) == 1:
            new = step(new[:-1])
        fill = iter(new)
        return "".join(next(fill) if x.isdigit() else x for x in text)

    def _line(self, line: str, found: Counter | None, back: bool) -> str:
        out, done, at = [], 0, 0
        while (match := FOUND.search(line, at)) is not None:
            kind, (start, at) = match.lastgroup, match.span()
            new = getattr(self, kind)(match.group(), back)
            if kind == "iban":  # what follows its end, or all after the country's letters if it is none, may hold other values
                new, at = (new[0], start + new[1]) if new else (None, start + 2)
            if new is not None:
                out += [line[done:start], new]
                done = at
                if found is not None:
                    found[kind] += 1
        return "".join([*out, line[done:]])

    def replace(self, text: str, found: Counter | None = None, back: bool = False) -> str:
        # No pattern crosses a line, and only lines with a digit or an @ can match.
        return "\n".join(self._line(line, found, back) if MAY.search(line) else line for line in text.split("\n"))


def _replaced(key: bytes, back: bool, names: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = Pseudonyms(key)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text")
                may = pc.fill_null(pc.match_substring_regex(texts, "[0-9@]"), False).to_numpy(zero_copy_only=False)
                new, counts = texts.to_pylist(), [[0] * part.num_rows for _ in KINDS]
                for i in may.nonzero()[0].tolist():
                    found: Counter = Counter()
                    new[i] = pseudonyms.replace(new[i], found, back)
                    for k, kind in enumerate(KINDS):
                        counts[k][i] = found[kind]
                out = part.set_column(part.schema.get_field_index("text"), "text", pa.array(new, pa.string()))
                for kind, n in zip(KINDS, counts):
                    out = out.append_column(names[kind], pa.array(n, pa.int32()))
                yield out

    return run


def pseudonymise(docs: DataFrame, key: bytes, counts: bool = True, back: bool = False) -> DataFrame:
    """`docs` with private values in `text` replaced; with `counts`, how many of each kind (n_email, ...).

    E-mail addresses, IBANs (mod 97), hex secrets, keys with a known beginning, IPv4 (octets) and IPv6 addresses, telephone numbers,
    social security numbers, dates (1900 to 2099, by the calendar; year, month, day or day, month, year, or month, day, year where only
    that is a date) and payment cards (Luhn) are found, however long they are. What looks like one but isn't valid stays. Telephone numbers,
    cards, dates and IPv6 addresses are linked across their formats, e-mail addresses whatever their case; an IPv6 address comes out in the short form, and
    whether a day is after the 12th stays as it is. Letters of addresses are Latin, Greek and Cyrillic ones (`SCRIPTS`); others end an address, and letters without one capital (ß), the
    top domain and all signs stay. Not found: IBANs in small letters, dates without leading zeros, IPv6 addresses that begin or end with ::, numbers
    with four parts after a v (versions). Null texts stay null and empty ones empty, with counts
    of 0; equal rows come out alike; every row and other column is kept; whole texts are searched; an empty table gives an empty one. A column of `docs`
    that has the name of a count is kept and the count gets underscores before its name. `back` undoes the replacement.
    """
    clash = unused(docs, *KINDS)
    names = {k: f"n_{k}" if f"n_{k}" not in {c.lower() for c in docs.columns} else clash[k] for k in KINDS}
    fields = T.StructType([*docs.schema.fields, *(T.StructField(names[k], T.IntegerType()) for k in KINDS)])
    out = docs.mapInArrow(_replaced(key, back, names), fields)
    return out if counts else out.select(*[F.col(f"`{c}`") for c in docs.columns])
