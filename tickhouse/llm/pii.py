"""Personal data with offset-preserving deobfuscation.

Two passes over each whole text:

1. *Base*: the four identifier patterns on the text as it stands, leftmost
   and non-overlapping per kind; matches that fail their check (parts over
   255, Luhn, digit counts) are dropped.
2. *Deobfuscation*: transducers rewrite the text while keeping, for every
   character they write, the source range it came from:
   characters (full-width forms, look-alike letters, digits of other
   scripts, invisible characters) -> "at" and "dot" in brackets -> spelled
   numbers ("four one one 555", "192 dot 168 dot 1 dot 10", with
   double/triple, plus, dash), where an address, card or phone results ->
   "at" and "dot" as words.  The same patterns run on the normalised text, and each
   match is mapped back to source characters.  A match is added unless it
   touches a span already found, but for those of its own kind that it
   contains and continues.  Base spans always stay.

Each transducer runs only where its hint holds, a looser pattern that every
match of it contains, taken on the text the earlier transducers left; a text
without any is not rewritten.

Spans count code points, end exclusive.  Row-local: no shuffle.

Cases: a null or empty text has no spans; texts are scanned whole whatever
their length; repeated rows give repeated results; overlapping candidates
are settled by kind in the order email, ip, card, phone, then by start; an
empty table gives no rows; further columns are not read (``redact`` keeps
them untouched).
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.common import LONG, STRING, fields, map_texts, texts_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def _card(match: str) -> bool:
    digits = match.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and luhn(digits)


def _ip(match: str) -> bool:
    # parts may carry any number of leading zeros
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in match.split("."))


def _phone(match: str) -> bool:
    return 9 <= sum("0" <= c <= "9" for c in match) <= 15


PATTERNS: tuple[tuple[str, re.Pattern, Callable[[str], bool]], ...] = (
    ("email", EMAIL, lambda m: True),
    ("ip", IP, _ip),
    ("card", CARD, _card),
    ("phone", PHONE, _phone),
)
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}

# The same matches in time linear in the text, however long its runs are.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
TAIL = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A part ends where its digits end, so a match can only begin where digits begin.
WHOLE_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Where ``EMAIL`` matches: every "@" extended to both sides.

    What stands before an "@" lies behind the last one, so no run is read twice.
    """
    end, at = 0, text.find("@")
    while at >= 0:
        before = text[end:at]
        start = at - (len(before) - len(before.rstrip(LOCAL)))
        host = TAIL.match(text, at) if start < at else None
        if host:
            yield start, host.end()
        end = host.end() if host else at + 1
        at = text.find("@", end)


def matches(kind: str, pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    """The spans of ``pattern.finditer``."""
    if kind == "email":
        return emails(text)
    return (m.span() for m in (WHOLE_IP if kind == "ip" else pattern).finditer(text))


def find(text: str) -> list[Span]:
    """The base spans of a text, by kind, then start."""
    digits = DIGIT.search(text) is not None
    spans = []
    for kind, pattern, good in PATTERNS:
        if (kind == "email" or digits) and NEEDS[kind] in text:
            for start, end in matches(kind, pattern, text):
                if good(text[start:end]):
                    spans.append((kind, start, end))
    return spans


# --- transducers -----------------------------------------------------------

#: Look-alike letters of other scripts (public confusables), by the Latin
#: letter they stand for.
LOOKALIKES = {
    "a": "аα", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іιı", "j": "ј",
    "k": "κк", "l": "ӏ", "m": "м", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г",
    "s": "ѕſ", "t": "т", "u": "υս", "v": "ν", "w": "ԝ", "x": "хχ", "y": "уγ", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙİ", "J": "Ј", "K": "КΚK",
    "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ҮΥ",
    "Z": "Ζ", ".": "。．｡․‧", "-": "‐‑‒–—−", "@": "﹫", "+": "﹢",
}
INVISIBLE = "­​‌‍‎‏⁠﻿"


@lru_cache(maxsize=1)
def character_map() -> dict[str, str]:
    """Source character -> what stands for it in the normalised text."""
    table = {other: latin for latin, others in LOOKALIKES.items() for other in others}
    table |= {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}  # full-width forms
    table |= dict.fromkeys(INVISIBLE, "")
    for code in range(0x80, 0x20000):  # decimal digits of every script
        if unicodedata.category(chr(code)) == "Nd":
            table[chr(code)] = str(unicodedata.digit(chr(code)))
    return table


@lru_cache(maxsize=1)
def odd_characters() -> re.Pattern:
    return re.compile("[" + "".join(map(re.escape, sorted(character_map()))) + "]")


@lru_cache(maxsize=1)
def maybe_odd() -> re.Pattern:
    """A coarse and fast test that every odd character passes."""
    low = sorted(c for c in character_map() if c < "ɐ")
    return re.compile(f"[ɐ-\U0010ffff{''.join(map(re.escape, low))}]")


DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
_WORD = "|".join(DIGIT_WORDS)
_UNIT = rf"(?:(?:double|triple)[ -]+)?(?:{_WORD}|[0-9])"
_JOIN = r"(?:[ ]*[-,][ ]*|[ ]+(?:dash|hyphen)[ ]+|[ ]+(?:dot|point)[ ]+|[ ]+)"
#: at least seven spelled or written digits in a row, one of them spelled
SPELLED = re.compile(
    rf"(?<![A-Za-z0-9])(?:plus[ ]+)?{_UNIT}(?:{_JOIN}{_UNIT}){{6,}}(?![A-Za-z0-9])", re.IGNORECASE | re.ASCII
)
#: any run of spelled digits and written numbers
RUN = re.compile(
    rf"(?<![A-Za-z0-9])(?:plus[ ]+)?(?:{_UNIT}|[0-9]+)(?:{_JOIN}(?:{_UNIT}|[0-9]+))*(?![A-Za-z0-9])",
    re.IGNORECASE | re.ASCII,
)
TOKEN = re.compile(rf"plus[ ]+|double|triple|{_WORD}|[0-9]+|dot|point|dash|hyphen|-", re.IGNORECASE | re.ASCII)
#: in lower case, what every run with a letter holds: a digit word on its own,
#: or a written digit beside one of the other words of a run
SPELLED_HINT = re.compile(
    rf"(?<![a-z0-9])(?:(?:{_WORD})(?![a-z0-9])|plus[ ]+[0-9]|(?:double|triple)[ -]+[0-9])"
    r"|[0-9][ ]+(?:dash|hyphen|dot|point)[ ]+[0-9]"
)

_B, _E = r"[ ]*[\[({<][ ]*", r"[ ]*[\])}>][ ]*"
BRACKET_AT = re.compile(rf"(?<=[A-Za-z0-9]){_B}(?:at|@){_E}(?=[A-Za-z0-9])", re.IGNORECASE | re.ASCII)
BRACKET_DOT = re.compile(rf"(?<=[A-Za-z0-9]){_B}(?:dot|\.){_E}(?=[A-Za-z0-9])", re.IGNORECASE | re.ASCII)
#: "name at host dot tld" with plain words: the sign, the host after it, and
#: the name before it, read backwards
AT = re.compile(r"(?<! ) +at(?= )|@", re.IGNORECASE | re.ASCII)
HOST = re.compile(r"[ ]*([A-Za-z0-9-]+(?:(?:[.]|[ ]+dot[ ]+)[A-Za-z0-9-]+)+)", re.IGNORECASE | re.ASCII)
NAME_BACK = re.compile(
    r"[A-Za-z0-9_%+-]+(?:(?:[.]|[ ]+tod[ ]+)[A-Za-z0-9_%+-]+)*(?![A-Za-z0-9._%+-])",
    re.IGNORECASE | re.ASCII,
)
BEFORE_SIGN = re.compile(r"[A-Za-z0-9._%+-]*@[A-Za-z0-9-]+[.][A-Za-z0-9-]")
TOP_LEVEL_FORM = re.compile(r"[A-Za-z]{2,}|xn--[A-Za-z0-9-]+", re.IGNORECASE | re.ASCII)
#: a spelled "at" with plain dots only ("at example.com") is an address only
#: under these top-level names: well-known ones and those of countries
TOP_LEVEL = {"com", "org", "net", "edu", "gov", "info", "io", "co", "uk", "de", "fr", "es", "eu", "us"}
COUNTRIES = set(
    "ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw "
    "by bz ca cc cd cf cg ch ci ck cl cm cn cr cu cv cw cx cy cz dj dk dm do dz ec ee eg er et fi fj fk "
    "fm fo ga gd ge gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in iq ir "
    "is it je jm jo jp ke kg kh ki km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc md me mg "
    "mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na nc ne nf ng ni nl no np nr nu nz om pa pe pf "
    "pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si sk sl sm sn so sr ss st "
    "su sv sx sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uy uz va vc ve vg vi vn vu wf "
    "ws ye yt za zm zw".split()
)
#: nor is it one where the words after "at" are those of a sentence
SENTENCE = {"the", "a", "an", "this", "that", "our", "my", "your", "his", "her", "its", "their"}
WORDED_TOKEN = re.compile(r"(?<! )[ ]+(at|dot)[ ]+", re.IGNORECASE | re.ASCII)
BRACKET_HINT = re.compile(r"[\[({<][ ]*(?:at|@|dot|\.)[ ]*[\])}>]")
#: in lower case, a spelled "at" before a dotted name
WORDED_HINT = re.compile(r" at[ ]+[a-z0-9-]+(?:[.]|[ ]+dot[ ]+)[a-z0-9-]")


class Tape:
    """A text with the source range of each of its characters."""

    def __init__(self, text: str):
        self.text = text
        self.start: list[int] | range = range(len(text))
        self.end: list[int] | range = range(1, len(text) + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace ranges (ascending, disjoint); new characters stand for the whole range."""
        if not edits:
            return
        parts, start, end, at = [], [], [], 0
        for s, e, new in edits:
            parts += [self.text[at:s], new]
            start += [*self.start[at:s], *[self.start[s]] * len(new)]
            end += [*self.end[at:s], *[self.end[e - 1]] * len(new)]
            at = e
        parts.append(self.text[at:])
        start += self.start[at:]
        end += self.end[at:]
        self.text, self.start, self.end = "".join(parts), start, end


def _worded_host(host: str, sign: str) -> bool:
    """Whether a host after "at" or "@" makes an address."""
    labels = re.split("[ ]+dot[ ]+|[.]", host, flags=re.IGNORECASE)
    last = labels[-1].lower()
    if not TOP_LEVEL_FORM.fullmatch(last):
        return False
    if sign == "@":
        return True
    low = [label.lower() for label in labels]
    if not SENTENCE.isdisjoint(low[:-1]) or all(x.isdigit() or x in DIGIT_WORDS for x in low):
        return False
    # "noon.It" is the end of a sentence
    plain = last in TOP_LEVEL or (last in COUNTRIES and not labels[-1].istitle())
    return plain or " " in host


def worded_addresses(text: str) -> list[tuple[int, int]]:
    """Ranges of the addresses spelled with words; of two that meet, the later
    ("reach me at jane dot doe at example dot com")."""
    found: list[tuple[int, int]] = []
    back = ""
    for sign in reversed(list(AT.finditer(text))):
        host = HOST.match(text, sign.end())
        # a host follows "@" at once; what runs on to a plain address is its name
        if (
            host is None
            or (sign.group() == "@" and host.start(1) > sign.end())
            or (found and host.end() > found[-1][0])
            or BEFORE_SIGN.match(text, host.end())
            or not _worded_host(host.group(1), sign.group())
        ):
            continue
        back = back or text[::-1]
        name = NAME_BACK.match(back, len(text) - sign.start())
        if name is not None:
            start = len(text) - name.end()
            if WORDED_TOKEN.search(text, start, host.end()):
                found.append((start, host.end()))
    return found[::-1]


def _spelled(match: re.Match) -> list[tuple[int, int, str]]:
    """The edits of one run: each token keeps its own range.

    Blanks and commas go, but one blank stays beside a number of several digits.
    """
    edits: list[tuple[int, int, str]] = []
    at, begin, repeat, before = match.start(), None, 1, ""
    for token in TOKEN.finditer(match.string, match.start(), match.end()):
        word = token.group().strip().lower()
        begin = token.start() if begin is None else begin
        if word in ("double", "triple"):
            repeat = 2 if word == "double" else 3
            continue
        if word in ("dot", "point"):
            new = "."
        elif word in ("dash", "hyphen", "-"):
            new = "-"
        elif word == "plus":
            new = "+"
        else:
            new = DIGIT_WORDS.get(word, word) * repeat
        if begin > at:
            numbers = [w for w in (before, word) if w.isdigit() or w in DIGIT_WORDS]
            apart = len(numbers) == 2 and any(len(w) > 1 and w.isdigit() for w in numbers)
            edits.append((at, begin, " " if apart else ""))
        if new != match.string[begin : token.end()]:
            edits.append((begin, token.end(), new))
        at, begin, repeat, before = token.end(), None, 1, word
    return edits


def _spelled_edits(text: str) -> list[tuple[int, int, str]]:
    """Edits of the runs that make an address, card or phone when all runs are
    rewritten, and of those with seven spelled digits in a row."""
    runs = [(m, _spelled(m)) for m in RUN.finditer(text) if re.search("[A-Za-z]", m.group())]
    if not runs:
        return []
    trial = Tape(text)
    trial.rewrite([edit for _, edits in runs for edit in edits])
    used = bytearray(len(text))
    for kind, s, e in find(trial.text):
        if kind != "email":
            s, e = trial.start[s], trial.end[e - 1]
            used[s:e] = b"\1" * (e - s)
    return [
        edit
        for m, edits in runs
        if 1 in used[m.start() : m.end()] or SPELLED.search(text, m.start(), m.end())
        for edit in edits
    ]


def normalised(text: str, shortcut: bool = True) -> Tape | None:
    """The deobfuscated text with its source map; None if nothing can change.

    Without ``shortcut`` every transducer runs; the result is the same text.
    """
    tape = Tape(text)
    if not text.isascii() and (not shortcut or maybe_odd().search(text)):
        table = character_map()
        tape.rewrite([(m.start(), m.end(), table[m.group()]) for m in odd_characters().finditer(text)])
    if not shortcut or BRACKET_HINT.search(tape.text.lower()):
        for pattern, sign in ((BRACKET_AT, "@"), (BRACKET_DOT, ".")):
            tape.rewrite([(m.start(), m.end(), sign) for m in pattern.finditer(tape.text)])
    if not shortcut or SPELLED_HINT.search(tape.text.lower()):
        tape.rewrite(_spelled_edits(tape.text))
    low = tape.text.lower()
    if not shortcut or WORDED_HINT.search(low) or (" dot " in low and "@" in low):
        signs = {"at": "@", "dot": "."}
        tape.rewrite(
            [
                (w.start(), w.end(), signs[w.group(1).lower()])
                for s, e in worded_addresses(tape.text)
                for w in WORDED_TOKEN.finditer(tape.text, s, e)
            ]
        )
    return None if tape.text == text else tape


def find_all(text: str, base: list[Span] | None = None, shortcut: bool = True) -> list[Span]:
    """Base spans and those only the normalised text shows, by kind, then start."""
    spans = list(find(text) if base is None else base)
    tape = normalised(text, shortcut)
    if tape is not None:
        taken = list(spans)
        for kind, s, e in find(tape.text):
            s, e = tape.start[s], tape.end[e - 1]
            met = [t for t in taken if s < t[2] and t[1] < e]
            # what only continues found spans of its kind is added beside them
            if all(k == kind and s <= a and b <= e and (a, b) != (s, e) for k, a, b in met):
                spans.append((kind, s, e))
                taken.append((kind, s, e))
        spans.sort(key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
    return spans


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


RESULTS = fields(
    n_email=LONG,
    n_ip=LONG,
    n_card=LONG,
    n_phone=LONG,
    base_sha256=STRING,
    spans=STRING,
    n_spans=LONG,
    n_added=LONG,
)


def _work(column: pa.Array) -> dict[str, object]:
    rows = {f.name: [] for f in RESULTS.fields}
    for text in texts_of(column):
        base = find(text)
        spans = find_all(text, base)
        for kind in KINDS:
            rows[f"n_{kind}"].append(sum(s[0] == kind for s in base))
        rows["base_sha256"].append(hashlib.sha256(span_text(base).encode()).hexdigest())
        rows["spans"].append(span_text(spans))
        rows["n_spans"].append(len(spans))
        rows["n_added"].append(len(spans) - len(base))
    return rows


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base counts and digest, and all spans.

    ``n_email`` .. ``n_phone`` and ``base_sha256`` describe the base spans;
    ``spans`` lists base and deobfuscated spans together.
    """
    return map_texts(docs, _work, RESULTS, key, text)


def mask(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets.

    Where spans of two kinds overlap, the union is replaced once, under the
    kind that begins first.
    """
    out, at = [], 0
    for kind, s, e in sorted(find_all(text), key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{kind.upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]]) if out else text


def redacted(text: Column) -> Column:
    """The text column with personal data masked; null stays null."""

    @F.pandas_udf("string")
    def run(texts):  # noqa: ANN001, ANN202
        return texts.map(lambda t: None if t is None else mask(t))

    return run(text)
