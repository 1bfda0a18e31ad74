"""Format-preserving Feistel pseudonyms for personal data.

Numbers, dates, addresses and secrets that pass their format's validation (Luhn
sum, mod-97 check, calendar, number ranges) are mapped to a whole number inside
their format's domain, permuted by a keyed Feistel network and written back in
the same format, check digits included.  The permutation depends on the key, the
kind and the shape alone, so equal values get equal pseudonyms in all documents
and different values different ones.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import small_batches

ROUNDS = 8
#: Longer values are permuted digit by digit instead of as one number.
LONG = 256
#: For tests and examples; production passes its own.
DEMO_KEY = b"linkgraph demonstration key"
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
#: Text without any of these holds nothing to replace.  Digits are ASCII digits, here and in FIND.
CANDIDATE_SQL = "[0-9@=:]|PRIVATE KEY-----|gh[pousr]_|eyJ|(?i:bearer)"
#: Where FIND's groups hold the value of a secret.
VALUES = ("quoted", "quoted1", "value", "short")
KEYS = ("secret", "pem", "github", "jwt", "bearer")
#: Words behind "secret:" or "token:" are prose when they hold neither digits nor signs nor capitals inside.
PROSE = re.compile(r"[A-Z]?[a-z]+(?:-[a-z]+)*")
GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{30,}")

_NOT_IN_WORD, _ENDS = r"(?<![\w.+-])", r"(?![\w])"
FIND = re.compile("|".join([
    r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}" + _ENDS + ")",
    r"(?P<pem>(?<=PRIVATE KEY-----)[A-Za-z0-9+/=\s]{16,}+(?=-----END ))",
    r"(?P<github>(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{30,}+)",
    r"(?P<jwt>(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]++)?)",
    r"(?P<bearer>(?<![A-Za-z])(?i:bearer)\s{1,2}(?P<given>(?=[A-Za-z_.~+/-]*[0-9])[A-Za-z0-9_.~+/-]{16,}+))",
    r"(?P<secret>(?<![A-Za-z])(?:(?P<pass>(?i:password|passwd|pwd))|(?i:secret|token|api[_-]?key|access[_-]?key))"
    r"(?i:[_-](?:hash|key|value))?[\"']?\s{0,2}(?P<colon>[=:])\s{0,2}"
    r"(?:\"(?P<quoted>[^\"\s]{6,}+)\"|'(?P<quoted1>[^'\s]{6,}+)'|[\"']?(?P<value>[A-Za-z0-9+/_-]{8,}+)"
    r"|(?P<short>(?=[A-Za-z]*[0-9])[A-Za-z0-9+/_-]{4,7}+(?![A-Za-z0-9+/_-]))))",
    r"(?P<aws>(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9]))",
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))",
    r"(?P<iso>" + _NOT_IN_WORD + r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-]))",
    r"(?P<date>" + _NOT_IN_WORD + r"[0-9]{1,2}(?P<sep>[/.-])[0-9]{1,2}(?P=sep)[0-9]{4}(?![0-9]|[/.-][0-9]))",
    r"(?P<ssn>" + _NOT_IN_WORD + r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))",
    r"(?P<ip>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9]|[A-Za-z_]))",
    r"(?P<phone>(?<![\w+])\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|(?<![\w+])\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?){2,6}(?![0-9])"
    r"|(?<![\w+-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-]))",
    r"(?P<card>(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9-]|[A-Za-z_]))",
]))


class Permuter:
    """Keyed permutations of [0, size) for any size, one for each tweak."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, j: int, tweak: bytes, half: int, mod: int) -> int:
        data = bytes([j]) + tweak + b"\0" + half.to_bytes((half.bit_length() + 7) // 8 or 1, "big")
        got = hashlib.blake2b(data, key=self.key).digest()
        if mod.bit_length() > 8 * len(got):  # a half of a long value: every digit of it has to change
            got = hashlib.shake_256(got).digest(mod.bit_length() // 8 + 9)
        return int.from_bytes(got, "big") % mod

    def once(self, x: int, a: int, b: int, tweak: bytes) -> int:
        """A Feistel network over [0, a * b) with halves of sizes a and b."""
        left, right = x % a, x // a
        for j in range(1, ROUNDS + 1):
            left, right = right, (left + self._round(j, tweak, right, a if j % 2 else b)) % (a if j % 2 else b)
        return a * right + left

    def chain(self, x: list[int], sizes: list[int], tweak: str) -> list[int]:
        """A Feistel network over the digits of a long number with bases ``sizes`` (256 at most), in linear time."""
        n, t = len(x) // 2, hashlib.blake2b(tweak.encode(), key=self.key).digest()
        halves, bases = [x[:n], x[n:]], [sizes[:n], sizes[n:]]
        for j in range(ROUNDS):
            own, other = j % 2, 1 - j % 2
            got = hashlib.shake_256(self.key + bytes([j]) + t + bytes(halves[other])).digest(2 * len(halves[own]))
            halves[own] = [(v + 256 * a + b) % m for v, a, b, m in zip(halves[own], got[::2], got[1::2], bases[own], strict=True)]
        return halves[0] + halves[1]

    def permute(self, x: int, size: int, tweak: str, valid=None) -> int:
        """Walks the network's cycle from ``x`` to the next number below ``size`` that is valid.

        Valid numbers permute among themselves, as long as ``x`` is one.
        """
        if size < 2:
            return x
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        t = tweak.encode()
        while True:
            x = self.once(x, a, b, t)
            if x < size and (valid is None or valid(x)):
                return x


def luhn_ok(digits: str) -> bool:
    return (sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def luhn_digit(body: str) -> str:
    return next(c for c in "0123456789" if luhn_ok(body + c))


def iban_number(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4]))


def _refill(pattern: str, digits: str) -> str:
    """``pattern`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in pattern)


class Pseudonymizer:
    """Replaces validated personal data in texts; remembers recent values."""

    def __init__(self, key: bytes):
        self.p = Permuter(key)
        self.memo: dict[tuple[str, str], str | None] = {}

    # every method returns the pseudonym, or None for a value that is not valid

    def mixed(self, s: str, kind: str) -> str:
        """Each digit, lower-case and upper-case letter by one of its own set; a hex number by a hex number."""
        hexed = kind == "secret" and re.fullmatch("[0-9]*[a-f][0-9a-f]*", s) is not None
        sets = ["0123456789abcdef"] if hexed else ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
        shape = [next((x for x in sets if c in x), None) for c in s]
        tweak = f"{kind}:{'x' if hexed else ''}" + "".join(c if own is None else str(sets.index(own))
                                                           for c, own in zip(s, shape, strict=True))
        if len(s) > LONG:
            digits = [own.index(c) for c, own in zip(s, shape, strict=True) if own]
            while True:
                digits = self.p.chain(digits, [len(own) for own in shape if own], tweak)
                it = iter(digits)
                out = "".join(own[next(it)] if own else c for c, own in zip(s, shape, strict=True))
                if not (hexed and out.isdecimal()):
                    return out

        def text_of(x: int) -> str:
            out = []
            for c, own in zip(reversed(s), reversed(shape), strict=True):
                if own:
                    x, r = divmod(x, len(own))
                    c = own[r]
                out.append(c)
            return "".join(reversed(out))

        x, size = 0, 1
        for c, own in zip(s, shape, strict=True):
            if own:
                x, size = x * len(own) + own.index(c), size * len(own)
        # hex numbers of digits alone count as decimal, so they are no valid result here
        valid = (lambda v: not text_of(v).isdecimal()) if hexed else None
        return text_of(self.p.permute(x, size, tweak, valid))

    def email(self, s: str) -> str | None:
        name, _, host = s.partition("@")
        return self.mixed(name, "email@" + host.lower()) + "@" + host

    def aws(self, s: str) -> str | None:
        sets = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
        x = 0
        for c in s[4:]:
            x = x * 36 + sets.index(c)
        x, out = self.p.permute(x, 36 ** 16, "aws"), ""
        for _ in range(16):
            x, r = divmod(x, 36)
            out = sets[r] + out
        return s[:4] + out

    def iban(self, s: str) -> str | None:
        t = s.replace(" ", "")
        if not 15 <= len(t) <= 34 or iban_number(t) % 97 != 1:
            return None
        body = self.mixed(t[4:], "iban" + t[:2])
        new = t[:2] + f"{98 - iban_number(t[:2] + '00' + body) % 97:02d}" + body
        it = iter(new)
        return "".join(c if c == " " else next(it) for c in s)

    def _day(self, y: int, m: int, d: int) -> datetime.date | None:
        try:
            day = datetime.date(y, m, d).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        return datetime.date.fromordinal(FIRST_DAY + self.p.permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date"))

    def iso(self, s: str) -> str | None:
        day = self._day(*map(int, s.split("-")))
        return day and day.isoformat()

    def date(self, s: str) -> str | None:
        """Slashes: month first unless that is no date; dots and hyphens: day first."""
        sep = next(c for c in s if not c.isdigit())
        one, two, year = s.split(sep)
        orders = [(two, one), (one, two)] if sep != "/" else [(one, two), (two, one)]  # (month, day)
        for month, _ in orders:
            first = month is one
            day = self._day(int(year), int(month), int(two if first else one))
            if day:
                wide = len(one) == 2 and len(two) == 2
                m, d = (f"{day.month:02d}", f"{day.day:02d}") if wide else (str(day.month), str(day.day))
                return sep.join([m, d, f"{day.year}"] if first else [d, m, f"{day.year}"])
        return None

    def ssn(self, s: str) -> str | None:
        area, group, serial = map(int, s.split("-"))
        if not 1 <= area <= 899 or area == 666 or not group or not serial:
            return None
        x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        x, serial = divmod(self.p.permute(x, 898 * 99 * 9999, "ssn"), 9999)
        area, group = divmod(x, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def ip(self, s: str) -> str | None:
        ranges = [(0, 10), (10, 90), (100, 156)]
        parts = s.split(".")
        if any(int(o) > 255 or o != str(int(o)) for o in parts) or int(parts[0]) in (0, 127, 255):
            return None
        own = [ranges[len(o) - 1] for o in parts]
        x = size = 0
        for o, (low, n) in zip(parts, own, strict=True):
            x, size = x * n + int(o) - low, (size or 1) * n
        weight = size // own[0][1]
        x = self.p.permute(x, size, "ip" + "".join(str(len(o)) for o in parts),
                           lambda v: v // weight + own[0][0] not in (0, 127, 255))
        out = []
        for low, n in reversed(own):
            x, r = divmod(x, n)
            out.append(str(low + r))
        return ".".join(reversed(out))

    def phone(self, s: str) -> str | None:
        digits = re.sub(r"\D", "", s)
        if s[0] != "+":
            country, body = "", digits
        else:
            code = re.match(r"\+(\d{1,3})", s)[1]
            country = "1" if code.startswith("1") else code
            body = digits[len(country):]
        if not 8 <= len(digits) <= 15 or len(body) < 6:
            return None
        plan = country in ("", "1") and len(body) == 10
        if plan and (body[0] in "01" or body[3] in "01"):
            return None
        lead = body[0] != "0"

        def valid(x: int) -> bool:
            t = f"{x:0{len(body)}d}"
            return (t[0] in "23456789" and t[3] in "23456789") if plan else (t[0] != "0") == lead

        x = self.p.permute(int(body), 10 ** len(body), f"phone{'1' if plan else country}:{len(body)}", valid)
        return _refill(s, country + f"{x:0{len(body)}d}")

    def card(self, s: str) -> str | None:
        digits = re.sub(r"\D", "", s)
        if not 13 <= len(digits) <= 19 or digits[0] not in "23456" or not luhn_ok(digits):
            return None
        n = len(digits) - 2
        body = digits[0] + f"{self.p.permute(int(digits[1:-1]), 10 ** n, f'card{digits[0]}:{n}'):0{n}d}"
        return _refill(s, body + luhn_digit(body))

    def secret(self, s: str) -> str:
        """A key keeps the prefix that tells its format."""
        keep = 4 if GITHUB.fullmatch(s) else 3 if s.startswith("eyJ") else 0
        return s[:keep] + self.mixed(s[keep:], "secret")

    def value(self, kind: str, s: str) -> str | None:
        if len(s) > LONG:  # not remembered
            return getattr(self, kind)(s)
        key = (kind, s)
        if key not in self.memo:
            if len(self.memo) >= 100_000:
                self.memo.clear()
            self.memo[key] = getattr(self, kind)(s)
        return self.memo[key]

    def text(self, text: str) -> tuple[str, int]:
        """The text with pseudonyms, and how many."""
        out, done, n, at = [], 0, 0, 0
        while m := FIND.search(text, at):
            kind, part = m.lastgroup, 0
            if kind == "secret":
                part = next(g for g in VALUES if m[g] is not None)
            elif kind == "bearer":
                part = "given"
            begin, end = m.span(part)
            if kind == "secret" and not m["pass"] and m["colon"] == ":" and part == "value" and PROSE.fullmatch(m[part]) \
                    or part == "short" and not m["pass"]:
                at = end
                continue
            new = self.value("secret" if kind in KEYS else kind, text[begin:end])
            while new is None and kind in ("card", "iban"):  # a group behind the number may belong to something else
                cut = max(text.rfind(c, begin, end) for c in " -")
                if cut <= begin:
                    break
                end = cut
                new = self.value(kind, text[begin:end]) if end - begin >= 13 else None
            if new is None:  # not valid: look again behind its first run of letters and digits
                at = begin + max(1, re.match(r"\w*", text[begin:end]).end())
                continue
            out += [text[done:begin], new]
            done = at = end
            n += 1
        return ("".join([*out, text[done:]]), n) if n else (text, 0)


def pseudonymize(docs: DataFrame, key: bytes = DEMO_KEY, text: str = "text", count: str | None = "n_replaced") -> DataFrame:
    """All rows and columns of ``docs`` with personal data in ``text`` replaced; ``count`` names a column for how many.

    * null text stays null, empty text empty; text without a valid value comes back unchanged.
    * what only looks like personal data (a card number with a wrong check digit, 31 February, octets over 255) stays.
    * only texts with a digit, ``@``, ``=`` or ``:`` are sent to Python.  ``key`` travels with the task and is not stored.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("text string, n int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = Pseudonymizer(key)
        for texts in batches:
            yield pd.DataFrame([(None, 0) if s is None else p.text(s) for s in texts], columns=["text", "n"])

    body = docs[f"`{text}`"].cast("string")
    out = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                      run(F.when(body.rlike(CANDIDATE_SQL), body)).alias("got"))
    cols = [F.coalesce("got.text", f"row.`{text}`").alias(c) if c == text else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns if c != count]
    return out.select(*cols, *([F.coalesce("got.n", F.lit(0)).alias(count)] if count else []))
