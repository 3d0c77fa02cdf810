"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds its anchors: at-signs, plus signs,
digits, schemes and identifier cues. Local parsers grow each anchor to the
span it belongs to and validate that. The parsers move in one direction. They
never look again at characters of a span, or of a digit run, that they are
through with, and the run of characters that values or targets may have is
walked once for all cues inside it (``Runs``), so the time is linear in the text.

Kinds, in this order:

- ``email``, ``ip``, ``card``, ``phone``: the leftmost non-overlapping matches
  of each kind's pattern, those that fail the check dropped without a retry;
- ``account``: the value after an identifier cue (``iban``, ``account no``,
  ``ssn``, ``passport``, ``password``, ``api_key``, ``token`` ...) and a
  separator, or an access-key id by its prefix. A value has six characters or
  more, two digits at least, and ends where its alphabet does;
- ``address``: who a scheme names: a ``mailto:``, ``tel:`` or ``sip:`` target,
  or ``user:password@host`` after ``://``.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from quarry.llm.common import map_texts

KINDS = ("email", "ip", "card", "phone", "account", "address")
BASE = KINDS[:4]

# Fixed values of the task: character classes of the base patterns.
DIGIT = frozenset("0123456789")
LETTER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOCAL = LETTER | DIGIT | frozenset("._%+-")
HOST = LETTER | DIGIT | frozenset("-")
PHONE = DIGIT | frozenset(" ().-")
MAX_PART, CARD_DIGITS, PHONE_DIGITS = 255, (16, 19), (8, 15)

CUES = ("iban", "account", "acct", "ssn", "social security", "passport", "password", "passwd", "pwd", "secret", "token",
        "api key", "api_key", "apikey", "api-key", "routing")
KEY_PREFIXES = ("akia", "asia")
SCHEMES = ("mailto:", "tel:", "sip:")
VALUE = LETTER | DIGIT | frozenset("-_/+=")
TARGET = LETTER | DIGIT | frozenset("._%+-@:!$&'*=~#?/")
MIN_VALUE, MIN_DIGITS = 6, 2


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for d in DIGIT:
        a.add_word(d, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("login", 3))
    for w in SCHEMES:
        a.add_word(w, ("scheme", len(w)))
    for w in CUES:
        a.add_word(w, ("cue", len(w)))
    for w in KEY_PREFIXES:
        a.add_word(w, ("key", len(w)))
    a.make_automaton()
    return a


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by kind, then start.
    A null text has none."""
    if not text:
        return []
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only: places stay
    found: dict[str, list] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)  # end of each kind's last match
    ip_run = 0  # end of the last digit run tried as an address
    values, targets = Runs(text, VALUE, "-_/+"), Runs(text, TARGET, ".:!?'")
    for last, (what, n) in anchors().iter(low):
        at = last - n + 1
        if what == "digit":
            if at >= done["card"] and (span := _card(text, at)):
                done["card"] = span[0]
                if span[1]:
                    found["card"].append((at, span[0]))
            if at >= max(ip_run, done["ip"]):
                ip_run, end, ok = _ip(text, at)
                if end:
                    done["ip"] = end
                    if ok:
                        found["ip"].append((at, end))
        elif what == "at":
            if span := _email(text, at, done["email"]):
                done["email"] = span[1]
                found["email"].append(span)
        elif what == "plus":
            if at >= done["phone"] and (span := _phone(text, at)):
                done["phone"] = span[0]
                if span[1]:
                    found["phone"].append((at, span[0]))
        elif what == "scheme":
            _add(found["address"], done, "address", _target(text, at, last + 1, targets))
        elif what == "login":
            _add(found["address"], done, "address", _login(text, last + 1))
        elif what == "key":
            _add(found["account"], done, "account", _access_key(text, at))
        else:
            _add(found["account"], done, "account", _value(text, at, last + 1, values))
    return [(k, a, b) for k in KINDS for a, b in found[k]]


def _add(out: list, done: dict, kind: str, span: tuple | None) -> None:
    if span and span[0] >= done[kind]:
        out.append(span)
        done[kind] = span[1]


def _run(text: str, at: int, chars: frozenset) -> int:
    """End of the run of ``chars`` from ``at``."""
    n = len(text)
    while at < n and text[at] in chars:
        at += 1
    return at


class Runs:
    """Runs of ``chars``; the last one walked is remembered, with its end before
    a tail of ``tail`` characters."""

    def __init__(self, text: str, chars: frozenset, tail: str):
        self.text, self.chars, self.tail = text, chars, tail
        self.start = self.stop = self.kept = 0

    def ends(self, at: int) -> tuple[int, int]:
        """End of the run from ``at``, and without its tail."""
        if not self.start <= at < self.stop:
            self.start, self.stop = at, _run(self.text, at, self.chars)
            self.kept = self.stop
            while self.kept > at and self.text[self.kept - 1] in self.tail:
                self.kept -= 1
        return self.stop, max(self.kept, at)


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = _run(text, at + 1, HOST)
    if start == at or end == at + 1:
        return None
    dots = 0
    while end < len(text) and text[end] == "." and (after := _run(text, end + 1, HOST)) > end + 1:
        end, dots = after, dots + 1
    return (start, end) if dots else None


def _ip(text: str, at: int) -> tuple[int, int, bool]:
    """End of the first digit run; end of four dotted runs, or 0; whether the parts are in range."""
    first = end = _run(text, at, DIGIT)
    parts = [text[at:end]]
    while len(parts) < 4:
        if end >= len(text) or text[end] != "." or (after := _run(text, end + 1, DIGIT)) == end + 1:
            return first, 0, False
        parts.append(text[end + 1: after])
        end = after
    return first, end, all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= MAX_PART for x in parts)


def _card(text: str, at: int) -> tuple[int, bool] | None:
    """End of the digits with single blanks or hyphens between them, and whether they are a card number."""
    end, n = at + 1, len(text)
    while end < n:
        if text[end] in DIGIT:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in DIGIT:
            end += 2
        else:
            break
    if end == at + 1:
        return None
    if end - at > 2 * CARD_DIGITS[1]:
        return end, False
    digits = [int(c) for c in text[at:end] if c in DIGIT]
    return end, CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits)


def luhn(digits: list[int]) -> bool:
    twice = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(twice)) % 10 == 0


def _phone(text: str, at: int) -> tuple[int, bool] | None:
    """End after the last digit of the run behind ``+d``, and whether it has 8 to 15 digits."""
    if at + 1 >= len(text) or text[at + 1] not in DIGIT:
        return None
    end = _run(text, at + 2, PHONE)
    while end > at + 3 and text[end - 1] not in DIGIT:
        end -= 1
    if end <= at + 3:
        return None
    n = sum(c in DIGIT for c in text[at:end])
    return end, PHONE_DIGITS[0] <= n <= PHONE_DIGITS[1]


def _word_starts(text: str, at: int) -> bool:
    return at == 0 or not (text[at - 1].isalnum() or text[at - 1] == "_")


def _value(text: str, at: int, end: int, runs: Runs) -> tuple[int, int] | None:
    """The value after a cue: a few filler words, a separator, then the value."""
    if at and text[at - 1].isalpha():
        return None
    here = end
    for filler in (" number", " no.", " no", " id", " key", " #"):
        if text[here: here + len(filler)].lower() == filler:
            here += len(filler)
            break
    start = here
    while start < min(len(text), here + 6) and text[start] in " :=#\"'":
        start += 1
    if not any(c in ":=#" for c in text[here:start]) and not (here > end and start > here):
        return None
    stop, kept = runs.ends(start)
    if stop - start < 42 and stop + 4 < len(text) and text[stop] == " " and text[start:stop].isalnum() and _run(text, stop + 1, DIGIT) == stop + 5:
        kept = stop + 5  # a group of four digits more, as account numbers are printed
    stop = kept
    digits = sum(c in DIGIT for c in text[start: min(stop, start + 64)])
    return (start, stop) if stop - start >= MIN_VALUE and digits >= MIN_DIGITS else None


def _access_key(text: str, at: int) -> tuple[int, int] | None:
    """Twenty upper-case letters and digits, standing alone."""
    word = text[at: at + 20]
    ok = len(word) == 20 and word.isascii() and word.isalnum() and word == word.upper() and _word_starts(text, at)
    return (at, at + 20) if ok and (at + 20 == len(text) or not text[at + 20].isalnum()) else None


def _target(text: str, at: int, end: int, runs: Runs) -> tuple[int, int] | None:
    if not _word_starts(text, at):
        return None
    _, stop = runs.ends(end)
    return (end, stop) if stop - end >= 5 else None


def _login(text: str, at: int) -> tuple[int, int] | None:
    """``user:password@host`` after ``://``."""
    user = _run(text, at, TARGET - frozenset("@:/?#"))
    if user == at or user >= len(text) or text[user] not in ":@":
        return None
    mark = user if text[user] == "@" else _run(text, user + 1, TARGET - frozenset("@/"))
    if mark >= len(text) or text[mark] != "@":
        return None
    stop = _run(text, mark + 1, HOST | frozenset("."))
    return (at, stop) if stop > mark + 1 else None


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets; spans
    that overlap become one, named after the first."""
    out, at = [], 0
    for a, b, k in sorted((a, b, KINDS.index(k)) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced by counts of the base kinds, the digest
    of the base spans and all spans. A null or empty text has none; other
    columns (but for those of the made names, which are replaced), null ids and
    repeated rows stay; an empty table gives no rows."""

    def make(texts: list) -> dict:
        found = [find(t) for t in texts]
        out = {f"n_{k}": [sum(s[0] == k for s in f) for f in found] for k in BASE}
        out["base_sha256"] = [hashlib.sha256(spans_text([s for s in f if s[0] in BASE]).encode()).hexdigest() for f in found]
        out["spans"] = [spans_text(f) for f in found]
        return out

    return map_texts(docs, make, "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string", text)


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all spans of ``text`` masked; a null text stays null, all
    other columns and their order stay."""

    def make(texts: list) -> dict:
        return {text: [None if t is None else mask(t, find(t)) for t in texts]}

    return map_texts(docs, make, f"`{text}` string", text).select(*[f"`{c}`" for c in docs.columns])
