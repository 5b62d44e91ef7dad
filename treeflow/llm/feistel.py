"""Format-preserving pseudonyms for personal numbers and dates.

A value is found by its format and must pass its kind's own check (Luhn digit, ISO 7064
check digits, octet range, calendar, numbering plan).  It is read as a number below the size
of its format, permuted there by a keyed Feistel network and written in the same format, so
the pseudonym passes the same check and equal values, however they are punctuated, get
equal pseudonyms in every document.

The permutation of x is F^-1(F(x) + s) with a Feistel network F and a keyed shift s: it has
no fixed point, so no value survives.  Values outside a kind's valid set are walked past along
the permutation's own cycle.  Without the key a pseudonym tells its format only.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._spark import ship

ROUNDS = 8
KINDS = ("email", "iban", "ip", "ssn", "card", "date", "phone")


class Permutation:
    """Keyed permutations of range(n), one for each tweak, without fixed points if n > 1."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, i: int, half: int, modulus: int) -> int:
        size = modulus.bit_length() // 8 + 9
        out, block = b"", 0
        while len(out) < size:
            out += hashlib.blake2b(b"%d|%d|%d|%d|" % (i, block, half, modulus) + tweak, key=self.key, digest_size=64).digest()
            block += 1
        return int.from_bytes(out[:size], "big") % modulus

    def _feistel(self, x: int, a: int, b: int, tweak: bytes, back: bool) -> int:
        """A balanced network over range(a) x range(b)."""
        u, v = divmod(x, b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2 == 0:
                u = (u + sign * self._round(tweak, i, v, a)) % a
            else:
                v = (v + sign * self._round(tweak, i, u, b)) % b
        return u * b + v

    def _whole(self, x: int, n: int, tweak: bytes, back: bool) -> int:
        b = max(2, int(n**0.5)) if n < 1 << 50 else 1 << (n.bit_length() // 2)
        a = -(-n // b)
        while True:  # walks past the places of the last, partly used row
            x = self._feistel(x, a, b, tweak, back)
            if x < n:
                return x

    def __call__(self, x: int, n: int, tweak: str, valid: Callable[[int], bool] = lambda x: True) -> int:
        """Where x, which is valid, goes among the valid numbers below n."""
        if n < 2:
            return x
        t = tweak.encode()
        shift = 1 + self._round(t, ROUNDS, 0, n - 1)
        start = x
        while True:
            x = self._whole((self._whole(x, n, t, False) + shift) % n, n, t, True)
            if x == start or valid(x):
                return x


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _refill(form: str, chars: str) -> str:
    """The format with its digits replaced in order."""
    it = iter(chars)
    return "".join(next(it) if "0" <= c <= "9" else c for c in form)


def luhn(digits: str) -> int:
    """The digit sum that is 0 modulo 10 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def _card_valid(d: str) -> bool:
    return 13 <= len(d) <= 19 and not luhn(d) and d[0] != "0" and len(set(d)) > 1


def _card(s: str, p: Permutation) -> str | None:
    d = _digits(s)
    if not _card_valid(d):
        return None
    n = len(d) - 1
    body = f"{p(int(d[:n]), 10**n, f'card{n}', lambda x: x >= 10 ** (n - 1)):0{n}d}"
    return _refill(s, body + str(-luhn(body + "0") % 10))


def _ip(s: str, p: Permutation) -> str | None:
    octets = s.split(".")
    if any(int(o) > 255 or len(o) > 1 and o[0] == "0" for o in octets):
        return None
    x = p(int.from_bytes(bytes(map(int, octets)), "big"), 1 << 32, "ip")
    return ".".join(map(str, x.to_bytes(4, "big")))


def _ssn_valid(x: int) -> bool:
    area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(s: str, p: Permutation) -> str | None:
    x = int(_digits(s))
    return _refill(s, f"{p(x, 10**9, 'ssn', _ssn_valid):09d}") if _ssn_valid(x) else None


def _mod97(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def _mixed(chars: str) -> tuple[int, int, str]:
    """Digits and letters read as one mixed-radix number: it, its bound, and the format."""
    x, n, form = 0, 1, []
    for c in chars:
        radix, value, kind = (10, int(c), "0") if "0" <= c <= "9" else (26, ord(c) - 65, "A") if "A" <= c <= "Z" else (26, ord(c) - 97, "a") if "a" <= c <= "z" else (1, 0, c)
        x, n = x * radix + value, n * radix
        form.append(kind)
    return x, n, "".join(form)


def _unmixed(x: int, form: str) -> str:
    out = []
    for kind in reversed(form):
        if kind in "0Aa":
            x, r = divmod(x, 10 if kind == "0" else 26)
            out.append(str(r) if kind == "0" else chr(r + ord(kind)))
        else:
            out.append(kind)
    return "".join(reversed(out))


def _iban(s: str, p: Permutation) -> str | None:
    plain = s.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
        return None
    x, n, form = _mixed(plain[4:])
    body = _unmixed(p(x, n, f"iban{plain[:2]}{form}"), form)
    it = iter(plain[:2] + f"{98 - _mod97(plain[:2] + '00' + body):02d}" + body)
    return "".join(c if c == " " else next(it) for c in s)


def _email(s: str, p: Permutation) -> str | None:
    local, at, domain = s.partition("@")
    low = local.lower()
    x, n, form = _mixed(low)
    if n < 2:
        return None
    new = _unmixed(p(x, n, f"email{form}"), form)
    return "".join(c.upper() if "A" <= o <= "Z" else c for c, o in zip(new, local, strict=True)) + at + domain


_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY


def _day(y: int, m: int, d: int) -> int | None:
    try:
        x = datetime.date(y, m, d).toordinal() - _FIRST_DAY
    except ValueError:
        return None
    return x if 0 <= x < _DAYS else None


def _date(s: str, p: Permutation) -> str | None:
    """Year first, or else month first after slashes and day first otherwise; where only the
    other order is a date it is read so, and moves among such dates."""
    sep = re.search(r"\D", s)[0]
    parts = s.split(sep)
    a, b, c = map(int, parts)
    if len(parts[0]) == 4:
        orders = [(0, 1, 2)]
    else:
        orders = [(2, 0, 1), (2, 1, 0)] if sep == "/" else [(2, 1, 0), (2, 0, 1)]
    for k, (y, m, d) in enumerate(orders):
        x = _day(*((a, b, c)[i] for i in (y, m, d)))
        if x is None:
            continue
        of = lambda x: datetime.date.fromordinal(x + _FIRST_DAY)
        day = of(p(x, _DAYS, f"date{k}", lambda x: not k or of(x).day > 12))
        new = [""] * 3
        padded = any(len(q) == 2 and q[0] == "0" for q in parts) or len(parts[d]) == len(parts[m]) == 2
        new[y], new[m], new[d] = f"{day.year:04d}", *(f"{v:02d}" if padded else str(v) for v in (day.month, day.day))
        return sep.join(new)
    return None


def _phone(s: str, p: Permutation) -> str | None:
    head = re.match(r"\+\d{1,3}(?=\D)", s)
    code = head[0] if head else "+" if s[0] == "+" else ""
    d = _digits(s[len(code) :])
    if not (7 if code else 10) <= len(d) <= 15:
        return None
    n = len(d)
    plan = n == 10 and code in ("", "+1")
    ok = lambda x: x // 10**9 > 1 and x // 10**6 % 10 > 1
    if plan and not ok(int(d)):
        plan = False
    x = p(int(d), 10**n, f"phone{n}{'n' if plan else ''}", ok if plan else lambda x: True)
    return code + _refill(s[len(code) :], f"{x:0{n}d}")


_REPLACE = {"email": _email, "iban": _iban, "ip": _ip, "ssn": _ssn, "card": _card, "date": _date, "phone": _phone}
_FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?![0-9])(?![./-][0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{1,12}){1,5}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}([ .-])[0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])",
}


def _pattern(kinds) -> re.Pattern:
    out, groups = [], 0
    for k in kinds:
        body = re.sub(r"\\([12])", lambda m: f"\\{int(m[1]) + groups + 1}", _FORMATS[k])
        out.append(f"(?P<{k}>{body})")
        groups += 1 + len(re.findall(r"\((?!\?)", re.sub(r"\\.|\[[^]]*\]", "", body)))
    return re.compile("|".join(out))


_CARD_SHAPE = re.compile(r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}")
_NEXT_DIGIT, _PHONE = re.compile("[ -]?[0-9]"), re.compile(_FORMATS["phone"])
#: length of an IBAN by country
_IBAN_LENGTH = {
    c: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FO FI GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in countries.split()
}
#: digits after the country code in plans of one length
_PLAN_LENGTH = {"+1": 10, "+7": 10, "+31": 9, "+33": 9, "+34": 9, "+41": 9, "+44": 10, "+45": 8, "+47": 8, "+48": 9, "+61": 9, "+86": 11, "+91": 10, "+351": 9, "+420": 9}


def _ends(kind: str, text: str, start: int, end: int) -> list[int]:
    """Where the value that begins at start may end, the likeliest first: its format may run on
    into a next number, so that its groups up to end are not all its own."""
    seps = {"card": " -", "iban": " ", "phone": " .-"}.get(kind, "")
    cuts = [end, *(i for i in range(end - 1, start, -1) if text[i] in seps)]
    if kind not in ("card", "iban", "phone") or kind == "phone" and text[start] != "+":
        return [end]
    if kind == "card":
        own = [c for c in cuts if _CARD_SHAPE.fullmatch(text, start, c)]
        alone = not (start > 1 and text[start - 1] in seps and "0" <= text[start - 2] <= "9") and not _NEXT_DIGIT.match(text, end)
        # all groups in another shape are a card if no shaped one is among them
        if alone and end not in own and not any(_CARD_SHAPE.fullmatch(text, i + 1, j) and _card_valid(_digits(text[i + 1 : j])) for i in cuts[1:] for j in cuts if i < j):
            own.append(end)
        return own
    if kind == "iban":
        n = _IBAN_LENGTH.get(text[start : start + 2])
        fits = [c for c in cuts if c - start - text.count(" ", start, c) == n]
        return [*fits, *(cuts if n is None else [end])]
    cuts = [c for c in cuts if _PHONE.fullmatch(text, start, c)]
    code = re.compile(r"\+[0-9]{1,3}(?![0-9])").match(text, start, end)
    n = _PLAN_LENGTH.get(code[0]) if code else None
    return [*(c for c in cuts if code and len(_digits(text[code.end() : c])) == n), *cuts]


def _value(kind: str, text: str, start: int, end: int, p: Permutation) -> tuple[str, int] | None:
    """The pseudonym of the value of this kind that begins at start, and where the value ends."""
    for e in _ends(kind, text, start, end):
        if (new := _REPLACE[kind](text[start:e], p)) is not None:
            return new, e
    return None


def replace(text: str, p: Permutation, pattern: re.Pattern, counts: Counter) -> str:
    """The text with its valid values replaced, from left to right; a value that fails its
    check with each of its ends stays, and the search goes on behind its first character."""
    out, last, at = [], 0, 0
    while m := pattern.search(text, at):
        kind = m.lastgroup if m.lastgroup in _REPLACE else next(k for k, v in m.groupdict().items() if v is not None)
        new = _value(kind, text, m.start(), m.end(), p)
        if new is None:
            for other in list(_REPLACE)[list(_REPLACE).index(kind) + 1 :]:  # the same place as a later kind
                if other in m.re.groupindex and (o := re.compile(_FORMATS[other]).match(text, m.start())) and (new := _value(other, text, o.start(), o.end(), p)) is not None:
                    kind = other
                    break
        if new is None:
            at = m.start() + 1
            continue
        counts[kind] += 1
        out += [text[last : m.start()], new[0]]
        last = at = new[1]
    return "".join([*out, text[last:]])


_HINT = np.zeros(256, bool)
_HINT[48:58] = _HINT[64] = True


def pseudonymise(docs: DataFrame, key: bytes, id_col="doc_id", text_col="text", kinds=KINDS) -> DataFrame:
    """id_col, text_col with pseudonyms, n_replaced, and kinds (a map from kind to count).

    A null text stays null with n_replaced 0; texts without a digit or @ are passed on as
    they are.  Each row is treated by itself, so repeated rows give equal rows.  Other
    columns are ignored; no rows give no rows.  A text is searched whole: its task holds some
    20 bytes a character of it.
    """
    ship(docs.sparkSession)
    kinds = tuple(k for k in KINDS if k in kinds)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        p, pattern = Permutation(key), _pattern(kinds)
        for batch in batches:
            texts = T.column(batch, text_col)
            hinted = []
            for lo, _, data, offsets in T.blocks(texts):
                n = np.diff(T.starts_of(_HINT[data].astype(np.int64))[offsets])
                hinted += (lo + np.flatnonzero(n)).tolist()
            mask = np.zeros(len(texts), bool)
            new, found = [], [{}] * len(texts)
            for i in hinted:
                counts: Counter = Counter()
                changed = replace(old := texts[i].as_py(), p, pattern, counts)
                if changed != old:
                    mask[i], found[i] = True, dict(counts)
                    new.append(changed)
            if new:
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array(new, texts.type))
            total = pa.array([sum(c.values()) for c in found], pa.int64())
            each = pa.array([list(c.items()) for c in found], pa.map_(pa.string(), pa.int64()))
            yield pa.RecordBatch.from_arrays([T.column(batch, id_col), texts, total, each], [id_col, text_col, "n_replaced", "kinds"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, `{text_col}` string, n_replaced long, kinds map<string,long>")
