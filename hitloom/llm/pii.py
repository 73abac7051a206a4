"""Format-preserving pseudonyms for personal data.

Validated values are replaced in place by another value of the same format: a
keyed Feistel permutation over all values that the format allows (digits,
letters, days, ...), walked until it lands inside.  The same value gives the
same pseudonym in every document under one key, different values different
ones, and who holds the key can go back (in dates up to leading zeros of days
and months).  Check digits are worked out anew, so
pseudonyms stay valid.

Kinds, in this order where matches overlap: email, secret, iban, card, ssn,
phone, date, ip.  Documents are independent of each other: nothing is shuffled.

Numbers often stand beside one another.  IBANs, cards and phones are therefore
read up to every separator and from every later start: an IBAN first at its
country's length, a card first in one block or in regular groups, a +1 phone
first with ten digits, any phone only up to a date or IP address; the first
reading that passes its check counts.  Cards in irregular groups come last and
give way to whole SSNs, phones and dates.

Other scripts: decimal digits of any script are read by their value, so a number
has one pseudonym however it is written, and the pseudonym is written in the same
digits, place by place (in those of the first digit where its length changes).  Letters
beyond a-z and A-Z stay within their kind (Unicode category and script).  A value
that its permutation happens to leave as it is is not counted.

Defined results: a null text stays null; whole texts are searched; repeated
rows come back as often as they came; other columns pass through
(``pseudonymise``) or are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import sys
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "change-me"  # a parameter: production passes its own secret
ROUNDS = 8
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_HOSTS = ("0.0.0.0", "127.0.0.1", "255.255.255.255")
# Country codes of two digits (ITU E.164; 1 and 7 have one, all others three).
TWO_DIGIT_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 "
                            "60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
# Lengths of IBANs (ISO 13616 registry).
IBAN_SIZES = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 "
    "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 "
    "LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 "
    "SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
Found = tuple[int, int, str]  # start, end, pseudonym
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def permute(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """Keyed permutation of 0 .. size - 1: a Feistel network over a square at least as large, walked into range."""
    side = isqrt(size - 1) + 1 if size > 1 else 1
    label = f"{tweak}/{size}".encode()

    def f(i: int, half: int) -> int:
        h = hashlib.blake2b(b"%d/%d/" % (i, half) + label, key=key, digest_size=32)
        return int.from_bytes(h.digest())

    while True:
        left, right = divmod(value, side)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = (right - f(i, left)) % side, left
            else:
                left, right = right, (left + f(i, right)) % side
        value = left * side + right
        if value < size:
            return value


class Pseudonyms:
    """Finds and replaces values; ``back=True`` undoes it."""

    def __init__(self, key: str = KEY, back: bool = False):
        self.key, self.back = hashlib.blake2b(key.encode(), digest_size=32).digest(), back
        self.days: dict[bool, list[int]] = {}
        self.text = ""  # the text at hand as it is; the kinds read it with all digits as 0-9
        self.taken: list[Found] = []  # what earlier kinds have of a text: disjoint, in order
        self.kinds: list[tuple[str, re.Pattern, Callable[[re.Match], Iterator[Found]], Callable[[str], bool]]] = [
            ("email", re.compile(r"(?<![\w.%+\u0300-\u036f-])([\w.%+\u0300-\u036f-]++)@((?:[\w-]++\.)+[^\W\d_]{2,24})(?![^\W_]|-)"), self.whole(self.email), lambda t: "@" in t),
            ("secret", re.compile(r"\b(AKIA)([A-Z0-9]{16})\b|(?i:\b((?:password|passwd|pwd|secret|api[_-]?key|(?:access[_-]?)?token)"
                                  r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?))([A-Za-z0-9_\-+/]{6,})"), self.whole(self.secret), lambda t: "AKIA" in t or "=" in t or ":" in t),
            ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}\b"), self.ibans, has_digit),
            ("card", re.compile(r"(?<!\d)(?<!\d[ -])\d(?:[ -]?\d){12,}"), self.cards, has_digit),
            ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"), self.whole(self.ssn), has_digit),
            ("phone", re.compile(r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}(?!\d)"
                                 r"|(?<![\d+.-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\d-])"), self.phones, has_digit),
            ("date", re.compile(r"(?<![\d/.-])(?:(?:19|20)\d\d([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2(?:19|20)\d\d)(?![\d]|[/.-]\d)"), self.whole(self.date), has_digit),
            ("ip", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)"), self.whole(self.ip), lambda t: t.count(".") > 2),
        ]
        self.patterns = {kind: pattern for kind, pattern, _, _ in self.kinds}

    def permuted(self, value: int, size: int, tweak: str) -> int:
        return permute(value, size, self.key, tweak, self.back)

    def shaped(self, text: str, tweak: str, alphabets: list[str] | None = None, inside: Callable[[str], bool] | None = None) -> str:
        """Permute a text among all of the same shape: a digit stays a digit, a letter keeps its case, the rest stays.

        ``inside``, true of ``text``, narrows the domain: the walk goes on until it is true again.
        """
        sets = alphabets or [alphabet(c) for c in text]
        kinds = "|".join(s if len(s) <= 26 else f"{unicodedata.category(s[0])} {script(s[0])}" for s in sets)
        value, size = 0, 1
        for c, s in zip(text, sets):
            value, size = value * len(s) + s.index(c), size * len(s)
        while True:
            value = rest = self.permuted(value, size, f"{tweak}/{kinds}")
            out = []
            for s in reversed(sets):
                rest, i = divmod(rest, len(s))
                out.append(s[i])
            new = "".join(reversed(out))
            if inside is None or inside(new):
                return new

    @staticmethod
    def whole(change: Callable[[re.Match], str | None]) -> Callable[[re.Match], Iterator[Found]]:
        """The only reading of a match is all of it."""
        def found(m: re.Match) -> Iterator[Found]:
            other = change(m)
            if other is not None:
                yield m.start(), m.end(), other

        return found

    def email(self, m: re.Match) -> str:
        return f"{self.shaped(m[1], 'email@' + m[2].lower())}@{m[2]}"

    def secret(self, m: re.Match) -> str | None:
        if m[1]:
            return m[1] + self.shaped(m[2], "secret")
        if not any(c in DIGITS for c in m[4]):  # an ordinary word after "token:" is no secret
            return None
        if ODD_DIGIT.search(self.text, m.start(4), m.end()):  # places keep their digits' script, so digits stay digits
            return m[3] + self.shaped(m[4], "secret in other digits")
        if re.fullmatch("[0-9a-f]+", m[4]):
            return m[3] + self.shaped(m[4], "hex", ["0123456789abcdef"] * len(m[4]), lambda t: any(c in DIGITS for c in t))
        return m[3] + self.shaped(m[4], "secret", inside=lambda t: not re.fullmatch("[0-9a-f]+", t))

    def ibans(self, m: re.Match) -> Iterator[Found]:
        ends = [w.end() for w in re.finditer("[A-Z0-9]+", m[0])][::-1]
        size = IBAN_SIZES.get(m[0][:2])
        for end in sorted(ends, key=lambda e: len(m[0][:e].replace(" ", "")) != size):
            other = self.iban(m[0][:end])
            if other is not None:
                yield m.start(), m.start() + end, other

    def iban(self, shape: str) -> str | None:
        plain = shape.replace(" ", "")

        def left(country: str, account: str) -> int:
            return int("".join(str(int(c, 36)) for c in account + country + "00")) % 97

        if not 15 <= len(plain) <= 34 or 98 - left(plain[:2], plain[4:]) != int(plain[2:4]):
            return None
        account = self.shaped(plain[4:], f"iban{plain[:2]}")
        return spread(f"{plain[:2]}{98 - left(plain[:2], account):02d}{account}", shape)

    def cards(self, m: re.Match) -> Iterator[Found]:
        """Readings of a run of digit groups: blocks and regular groups, then, between these, any groups cut at blanks."""
        text, groups = m.string, [g.span() for g in re.finditer(r"\d+", m[0])]
        groups = [(m.start() + lo, m.start() + hi) for lo, hi in groups]

        def ends(i: int, most: int) -> list[tuple[int, int]]:
            """(group, digits) of the ends within reach of a start."""
            out, n = [], 0
            for j in range(i, most):
                n += groups[j][1] - groups[j][0]
                if n > 19:
                    break
                if n > 12:
                    out.append((j, n))
            return out

        def may_start(i: int) -> bool:
            return text[groups[i][0] - 1:groups[i][0]] not in (".", "-")

        def may_end(j: int) -> bool:
            return re.match(r"[.-]\d", text[groups[j][1]:groups[j][1] + 2]) is None

        def regular(i: int, j: int) -> bool:
            sizes = [hi - lo for lo, hi in groups[i:j + 1]]
            marks = {text[groups[k][1]] for k in range(i, j)}
            return i == j or len(marks) == 1 and sizes[0] == 4 and all(4 <= x <= 6 for x in sizes[:-1]) and sizes[-1] <= 6

        gaps, first, i = [], 0, 0
        while i < len(groups):
            for j, _ in ends(i, len(groups)):
                # A dash or point at the edge of the run belongs to something else; inside it separates.
                if (i or may_start(0)) and (j < len(groups) - 1 or may_end(j)) and regular(i, j):
                    other = self.card(text[groups[i][0]:groups[j][1]])
                    if other is not None and not overlaps(self.taken, groups[i][0], groups[j][1]):
                        yield groups[i][0], groups[j][1], other
                        gaps.append((first, i))
                        first, i = j + 1, j
                        break
            i += 1
        others = None
        for first, most in [*gaps, (first, len(groups))]:
            i = first
            while i < most:
                for j, _ in reversed(ends(i, most)) if may_start(i) else ():
                    if not may_end(j) or (other := self.card(text[groups[i][0]:groups[j][1]])) is None:
                        continue
                    if others is None:
                        others = self.others(text, m.start(), m.end())
                    if not overlaps(others, groups[i][0], groups[j][1]):
                        yield groups[i][0], groups[j][1], other
                        i = j
                        break
                i += 1

    def others(self, text: str, lo: int, hi: int) -> list[Found]:
        """SSNs, phones and dates that touch a run of digit groups, and what earlier kinds have."""
        out = self.taken[max(bisect_left(self.taken, (lo,)) - 1, 0):bisect_left(self.taken, (hi,))]
        for kind, read in (("ssn", self.whole(self.ssn)), ("phone", self.phones), ("date", self.whole(self.date))):
            at = max(lo - 12, 0)  # a phone may begin before the run: "+1 (555) "
            while (m := self.patterns[kind].search(text, at, min(hi + 12, len(text)))) and m.start() < hi:
                found = next(read(m), None)
                out += [found] if found else []
                at = found[1] if found else m.start() + 1
        apart: list[Found] = []
        for x in sorted(out):
            apart[-1:] = [*apart[-1:], x] if not apart or apart[-1][1] <= x[0] else [(apart[-1][0], max(apart[-1][1], x[1]), "")]
        return apart

    def card(self, shape: str) -> str | None:
        plain = re.sub(r"\D", "", shape)

        def sort(digits: str) -> tuple[bool, ...]:
            # A longer number whose first 16 digits are valid is read as these in groups.
            return len(set(digits)) == 1, luhn(digits[:15]) == digits[15:16]

        if luhn(plain[:-1]) != plain[-1] or len(set(plain)) == 1:
            return None
        own, first = sort(plain), "0" if plain[0] == "0" else "123456789"
        body = self.shaped(plain[:-1], "card", [first] + [DIGITS] * (len(plain) - 2), lambda b: sort(b + luhn(b)) == own)
        return spread(body + luhn(body), shape)

    def ssn(self, m: re.Match) -> str | None:
        area, group, serial = (int(x) for x in m[0].split("-"))
        if not 1 <= area <= 899 or area == 666 or not group or not serial:
            return None
        value = self.permuted((AREAS.index(area) * 99 + group - 1) * 9999 + serial - 1, len(AREAS) * 99 * 9999, "ssn")
        rest, serial = divmod(value, 9999)
        area, group = divmod(rest, 99)
        return f"{AREAS[area]:03d}-{group + 1:02d}-{serial + 1:04d}"

    def phones(self, m: re.Match) -> Iterator[Found]:
        ends = [m.end()]
        if m[0][0] == "+":
            ends = [m.start() + g.end() for g in re.finditer(r"\d+", m[0])][::-1]
        digits = {end: len(re.sub(r"\D", "", m.string[m.start():end])) for end in ends}
        if m[0][:2] == "+1":
            ends.sort(key=lambda e: digits[e] != 11)
        stop = None
        for end in ends:
            if not 8 <= digits[end] <= 15:
                continue
            if m[0][0] == "+" and not (m[0][1] == "1" and digits[end] == 11):
                if stop is None:
                    stop = self.stop(m, min(e for e in ends if digits[e] >= 8))
                if end > stop:
                    continue
            yield m.start(), end, self.phone(m.string[m.start():end])

    def stop(self, m: re.Match, least: int) -> int:
        """Where a date or IP address begins behind what is enough for a phone, else the end."""
        starts = [m.end()]
        for kind, change in (("date", self.date), ("ip", self.ip)):
            starts += [x.start() for x in self.patterns[kind].finditer(m.string, least, m.end() + 16) if change(x) is not None]
        return min(starts)

    def phone(self, shape: str) -> str:
        """The country code stays; national numbers in groups of 3, 3 and 4 are +1 numbers without it."""
        plain = re.sub(r"\D", "", shape)
        code = plain[:1 if plain[0] in "17" else 2 if plain[:2] in TWO_DIGIT_CODES else 3] if shape[0] == "+" else ""
        body, tweak = plain[len(code):], f"phone{code or 1}"
        if code not in ("", "1") or len(body) != 10:
            return spread(code + self.shaped(body, tweak), shape)
        if in_plan(body):
            return spread(code + self.shaped(body, tweak, ["23456789", DIGITS, DIGITS, "23456789"] + [DIGITS] * 6), shape)
        return spread(code + self.shaped(body, tweak, inside=lambda b: not in_plan(b)), shape)

    def date(self, m: re.Match) -> str | None:
        """Year first, or year last: then day first where dots separate or the month would be above 12, else month first."""
        mark = m[1] or m[2]
        parts = m[0].split(mark)
        if m[1]:
            order = [0, 1, 2]
        elif mark == "." or int(parts[0]) > 12:
            order = [2, 1, 0]
        else:
            order = [2, 0, 1]
        try:
            day = datetime.date(*(int(parts[i]) for i in order)).toordinal()
        except ValueError:
            return None
        # "04/13/2024" and "13/04/2024" read as they say; only days up to 12 could be
        # taken for the other order, so they are permuted among themselves.
        if m[1] or mark == ".":
            days = range(FIRST_DAY, LAST_DAY + 1)
        else:
            late = int(parts[order[2]]) > 12
            days = self.days[late] = self.days.get(late) or days_by(late)
        new = datetime.date.fromordinal(days[self.permuted(bisect_left(days, day), len(days), "date")])
        out = [""] * 3
        for i, v in zip(order, (new.year, new.month, new.day)):
            out[i] = f"{v:04d}" if i == order[0] else f"{v:02d}" if len(parts[0 if order[0] else 1]) == 2 or v > 9 else str(v)
        return mark.join(out)

    def ip(self, m: re.Match) -> str | None:
        parts = [int(x) for x in m[0].split(".")]
        if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in m[0].split(".")) or m[0] in NO_HOSTS:
            return None
        value = int.from_bytes(bytes(parts))
        while True:
            value = self.permuted(value, 2 ** 32, "ip")
            new = ".".join(map(str, value.to_bytes(4)))
            if new not in NO_HOSTS:
                return new

    def replaced(self, text: str | None) -> tuple[str | None, Counter]:
        """The text with pseudonyms, and how many of each kind; earlier kinds win overlaps."""
        found: Counter = Counter()
        self.text, plain = text or "", text
        if text and ODD_DIGIT.search(text):
            plain = ODD_DIGIT.sub(lambda c: str(unicodedata.decimal(c[0])), text)
        self.taken = spans = []
        for kind, pattern, readings, may in self.kinds if text else ():
            if not may(plain):
                continue
            new, at = [], 0
            while m := pattern.search(plain, at):
                at = m.end() if kind == "card" else m.start() + 1
                for lo, hi, other in readings(m):
                    if overlaps(spans, lo, hi):
                        continue
                    new.append((lo, hi, in_digits_of(text[lo:hi], other)))
                    if kind != "card":  # a run may hold several cards; other kinds have one value a match
                        at = hi
                        break
            found[kind] += sum(text[lo:hi] != other for lo, hi, other in new)
            self.taken = spans = sorted(spans + new)
        if not spans:
            return text, found
        out, at = [], 0
        for lo, hi, other in spans:
            out += [text[at:lo], other]
            at = hi
        return "".join(out) + text[at:], found


# A decimal digit other than 0-9.
ODD_DIGIT = re.compile("[^\\D0-9]")


def in_digits_of(old: str, new: str) -> str:
    """``new`` with its digits written as ``old`` writes its own."""
    zeros = [ord(c) - unicodedata.decimal(c) if c.isdecimal() else None for c in old]
    if all(z in (None, ord("0")) for z in zeros):
        return new
    if len(old) != len(new):
        zeros = [next(z for z in zeros if z is not None)] * len(new)
    return "".join(chr(z + int(c)) if c in DIGITS and z is not None else c for c, z in zip(new, zeros))


def script(c: str) -> str:
    """The first word of a character's name, which is its script for letters."""
    return unicodedata.name(c, "").partition(" ")[0]


@cache
def letters_by_kind() -> dict[tuple[str, str], str]:
    """All letters and numerals beyond ASCII that are no decimal digits, by category and script."""
    out: dict[tuple[str, str], list[str]] = {}
    for c in map(chr, range(128, sys.maxunicode + 1)):
        if c.isalnum() and not c.isdecimal():
            out.setdefault((unicodedata.category(c), script(c)), []).append(c)
    return {kind: "".join(all_) for kind, all_ in out.items()}


@cache
def alphabet(c: str) -> str:
    """The characters that may take this one's place; itself alone if it is no letter or digit."""
    for kind in (DIGITS, LOWER, UPPER):
        if c in kind:
            return kind
    return letters_by_kind()[unicodedata.category(c), script(c)] if c.isalnum() else c


def has_digit(text: str) -> bool:
    return re.search("[0-9]", text) is not None


def overlaps(spans: list[Found], lo: int, hi: int) -> bool:
    """Whether any of these disjoint spans, in order, shares a character with lo .. hi - 1."""
    i = bisect_left(spans, (hi,))
    return i > 0 and spans[i - 1][1] > lo


def in_plan(body: str) -> bool:
    """Area code and exchange of a +1 number begin with 2 to 9."""
    return body[0] in "23456789" and body[3] in "23456789"


def spread(plain: str, shape: str) -> str:
    """Put characters into the places that letters and digits have in ``shape``."""
    rest = iter(plain)
    return "".join(next(rest) if c.isalnum() else c for c in shape)


def luhn(digits: str) -> str:
    """The check digit that makes ``digits`` plus itself valid."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


AREAS = [a for a in range(1, 900) if a != 666]


def days_by(late: bool) -> list[int]:
    """Days whose day of the month is above 12, or not."""
    return [d for d in range(FIRST_DAY, LAST_DAY + 1) if (datetime.date.fromordinal(d).day > 12) == late]


def pseudonymise(docs: DataFrame, key: str = KEY, back: bool = False) -> DataFrame:
    """``docs`` with its text replaced, and two more columns, which take the place of
    any that ``docs`` has under their names: n_pii, pii_kinds ("email:2,ip:1")."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = Pseudonyms(key, back)
        for texts in batches:
            done = [names.replaced(t) for t in texts]
            yield pd.DataFrame({"text": [t for t, _ in done], "n_pii": [n.total() for _, n in done],
                                "pii_kinds": [",".join(f"{k}:{v}" for k, v in sorted(n.items()) if v) for _, n in done]})

    replace = F.pandas_udf(run, "text string, n_pii long, pii_kinds string")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), replace("text").alias("new"))
    return row.select(*[F.col("new.text").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c)
                        for c in docs.columns if c not in ("n_pii", "pii_kinds")], "new.n_pii", "new.pii_kinds")
