"""Character classes for Java regular expressions.

The text rules are defined on Python's Unicode tables (15.1). The JVM may ship an older
version, so the classes below add the code points it leaves unassigned. Plain ``\\w`` and
``\\s`` are ASCII-only in Java and are never used.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

# Letters assigned after Unicode 13.
_NEW_LETTERS = (
    "870-887 889-88E 8B5 8C8-8C9 C5D CDD 170D 171F 1B4C 2C2F 2C5F 9FFD-9FFF A7C0-A7C1 "
    "A7D0-A7D1 A7D3 A7D5-A7D9 A7F2-A7F4 10570-1057A 1057C-1058A 1058C-10592 10594-10595 "
    "10597-105A1 105A3-105B1 105B3-105B9 105BB-105BC 10780-10785 10787-107B0 107B2-107BA "
    "10F70-10F81 11071-11072 11075 1123F-11240 11740-11746 11AB0-11ABF 11F02 11F04-11F10 "
    "11F12-11F33 12F90-12FF0 1342F 13441-13446 16A70-16ABE 1AFF0-1AFF3 1AFF5-1AFFB "
    "1AFFD-1AFFE 1B11F-1B122 1B132 1B155 1DF00-1DF1E 1DF25-1DF2A 1E030-1E06D 1E290-1E2AD "
    "1E4D0-1E4EB 1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE 1E7F0-1E7FE 2A6DE-2A6DF 2B735-2B739 "
    "2EBF0-2EE5D 31350-323AF"
)
# Numbers assigned after Unicode 13.
_NEW_NUMBERS = "11F50-11F59 16AC0-16AC9 1D2C0-1D2D3 1E4F0-1E4F9"
# Nonspacing marks assigned after Unicode 13.
_NEW_MARKS = (
    "898-89F 8CA-8D2 C3C ECE 180F 1AC1-1ACE 1DFA 10EFD-10EFF 10F82-10F85 11070 11073-11074 "
    "110C2 11241 11F00-11F01 11F36-11F3A 11F40 11F42 13440 13447-13455 1CF00-1CF2D "
    "1CF30-1CF46 1E08F 1E2AE 1E4EC-1E4EF"
)
# White space.
_SPACES = "9-D 1C-20 85 A0 1680 2000-200A 2028 2029 202F 205F 3000"


def _ranges(spec: str) -> list[tuple[int, int]]:
    out = []
    for part in spec.split():
        lo, _, hi = part.partition("-")
        out.append((int(lo, 16), int(hi or lo, 16)))
    return out


def _flat(ranges: list[tuple[int, int]]) -> str:
    return "".join(
        rf"\x{{{lo:x}}}" if lo == hi else rf"\x{{{lo:x}}}-\x{{{hi:x}}}" for lo, hi in ranges
    )


def class_body(ranges: list[tuple[int, int]], group: int = 4) -> str:
    """The inside of a Java character class for a list of code-point ranges.

    The regex engine tests every member of a class in turn, so long lists are cut into groups
    that are entered only for code points within the group's bounds, and these into larger ones
    until few are left: a character costs tests by the logarithm of the list.
    """
    parts = [(lo, hi, _flat([(lo, hi)])) for lo, hi in ranges]
    while len(parts) > group:
        parts = [_bounded(parts[i : i + group]) for i in range(0, len(parts), group)]
    return "".join(body for _, _, body in parts)


def _bounded(parts: list[tuple[int, int, str]]) -> tuple[int, int, str]:
    """Neighbouring members of a class as one, entered only within their bounds."""
    if len(parts) == 1:
        return parts[0]
    lo, hi = parts[0][0], parts[-1][1]
    return lo, hi, rf"[\x{{{lo:x}}}-\x{{{hi:x}}}&&[{''.join(body for _, _, body in parts)}]]"


def _runs(code_points: list[int], bridge: int = 1) -> list[tuple[int, int]]:
    """Sorted code points as ranges; gaps below ``bridge`` are swallowed."""
    runs: list[list[int]] = []
    for cp in code_points:
        if runs and cp - runs[-1][1] <= bridge:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return [(lo, hi) for lo, hi in runs]


def _above(start: int, body: str) -> str:
    """A class member entered only for code points from ``start`` on."""
    return rf"[\x{{{start:x}}}-\x{{10ffff}}&&[{body}]]"


def _latin1(member: Callable[[str], bool]) -> str:
    """The members below U+0100 one by one, as a class of their own: the engine keeps those in a single bit set, which
    it looks at last among the members of one class, but in its turn among classes."""
    return "[" + "".join(rf"\x{{{cp:x}}}" for cp in range(0x100) if member(chr(cp))) + "]"


# Class bodies, to be placed inside [...] or [^...]. Everything from U+0100 on is one nested
# member behind the bits, so that most of Latin text costs one bit test per character.
_WIDE_SPACES = _above(0x100, class_body([r for r in _ranges(_SPACES) if r[0] >= 0x100], 10))
SP = _latin1(str.isspace) + _WIDE_SPACES
SP_NOT_BLANK = _latin1(lambda c: c.isspace() and c != " ") + _WIDE_SPACES
_LETTERS = r"\p{L}" + _above(0x870, class_body(_ranges(_NEW_LETTERS)))
_NUMBERS = r"\p{N}" + _above(0x870, class_body(_ranges(_NEW_NUMBERS)))
LETTER = _latin1(str.isalpha) + _above(0x100, _LETTERS)
_WIDE_ALNUM = _above(0x100, f"{_LETTERS}[{_NUMBERS}]")
ALNUM = _latin1(str.isalnum) + _WIDE_ALNUM
WORD = _latin1(lambda c: c.isalnum() or c == "_") + _WIDE_ALNUM
WIDE_LETTER = _above(0x80, LETTER)
# Texts without code points from here on, which are most in Latin script, get classes of their own.
LOW = 0x300


def low_class(member: Callable[[str], bool]) -> str:
    """The members below ``LOW``, without properties or complements: the engine then compares plain chars."""
    wide = _flat(_runs([cp for cp in range(0x100, LOW) if member(chr(cp))]))
    return _latin1(member) + (rf"[\x{{100}}-\x{{{LOW - 1:x}}}&&[{wide}]]" if wide else "")


def kept_class(punctuation: str) -> str:
    """Words, white space and some punctuation below U+0100, the latter's bits with those of the former."""
    return _latin1(lambda c: c.isalnum() or c.isspace() or c in punctuation) + _WIDE_ALNUM + _WIDE_SPACES


# U+1734 is a spacing mark since Unicode 14.
MARK = _above(
    0x300, r"[^\x{1734}]&&[\p{Mn}" + _above(0x870, class_body(_ranges(_NEW_MARKS))) + "]"
)

# Script tokens that the supported languages can expect.
SCRIPT_TOKENS = [
    "LATIN",
    "DEVANAGARI",
    "BENGALI",
    "TELUGU",
    "TAMIL",
    "MALAYALAM",
    "KANNADA",
    "GUJARATI",
    "GURMUKHI",
    "ARABIC",
]


@lru_cache(maxsize=1)
def script_letters() -> dict[str, str]:
    """The letters whose Unicode name begins with the token, for each script token."""
    members: dict[str, list[str]] = {token: [] for token in SCRIPT_TOKENS}
    for cp in range(sys.maxunicode + 1):
        ch = chr(cp)
        if ch.isalpha():
            token = unicodedata.name(ch, "").partition(" ")[0]
            if token in members:
                members[token].append(ch)
    return {token: "".join(letters) for token, letters in members.items()}


def _composites() -> dict[int, set[int]]:
    """First code points by second, of the pairs that canonical composition joins."""
    pairs: dict[int, set[int]] = {}
    for cp in range(sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(cp)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            first, second = (int(p, 16) for p in parts)
            if unicodedata.normalize("NFC", chr(first) + chr(second)) == chr(cp):
                pairs.setdefault(second, set()).add(first)
    for second in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)):  # vowels, finals
        leads = range(0x1100, 0x1113) if second < 0x1176 else range(0xAC00, 0xD7A4, 28)
        pairs[second] = set(leads)
    return pairs


@lru_cache(maxsize=1)
def composition_needed() -> tuple[str, str, str]:
    """Three patterns; a text that differs from its NFC matches the first, and the second or the third.

    The first, a class body, is cheap: code points that change on their own, marks that reorder, and second halves
    of compositions. The others find the places: a code point that changes on its own, two adjacent marks, a second
    half right behind one of its first halves, or a mark behind a letter that holds a higher one. Vowel signs and viramas of composed text match the first at
    most. The second looks at such characters alone, and compares second halves only with the first halves of their
    neighbourhood. The third has the pairs with code points beyond U+FFFF, which few texts hold.
    """
    own, marks = [], []
    for cp in range(0x300, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if unicodedata.normalize("NFC", ch) != ch:
            own.append(cp)
        elif unicodedata.combining(ch):
            marks.append(cp)
    pairs = _composites()
    # A mark also moves before a higher mark that its letter holds already.
    top = {}
    for cp in range(0xC0, 0xAC00):
        last = unicodedata.combining(unicodedata.normalize("NFD", chr(cp))[-1])
        if last and not unicodedata.combining(chr(cp)):
            top[cp] = last
    higher = {m: {cp for cp, last in top.items() if last > unicodedata.combining(chr(m))} for m in marks}
    higher = {m: firsts for m, firsts in higher.items() if firsts}
    every = sorted({*own, *marks, *pairs})
    either, mark = _class(every), _class(marks)
    low = _runs(sorted(s for s in pairs if s <= 0xFFFF))
    near = [low[i : i + 2] for i in range(0, len(low), 2)]
    behind = [(r[0][0], r[-1][1], _behind(pairs, r[0][0], r[-1][1])) for r in near]
    while len(behind) > 4:
        behind = [_together(behind[i : i + 4]) for i in range(0, len(behind), 4)]
    found = "|".join(
        [
            f"[{_class(own)}]",
            f"[{mark}][{mark}]",
            f"(?<=[{_class(top)}])(?:{_behind(higher, 0x300, 0xFFFF)})",
            *[pattern for _, _, pattern in behind],
        ]
    )
    # The engine looks behind by UTF-16 units, so pairs beyond them are looked for ahead.
    beyond = []
    for firsts, seconds in [*_by_firsts(pairs).items(), *_by_firsts(higher).items()]:
        if max(*firsts, *seconds) > 0xFFFF:
            beyond.append(f"[{_class(firsts)}][{_class(seconds)}]")
    return _above(0x300, either), f"(?=[{_above(0x300, either)}])(?:{found})", "|".join(beyond)


def _class(code_points: Iterable[int]) -> str:
    return class_body(_runs(sorted(code_points)))


def _by_firsts(pairs: dict[int, set[int]]) -> dict[tuple[int, ...], list[int]]:
    """Second halves by their first halves."""
    together: dict[tuple[int, ...], list[int]] = {}
    for second, firsts in pairs.items():
        together.setdefault(tuple(sorted(firsts)), []).append(second)
    return together


def _behind(pairs: dict[int, set[int]], lo: int, hi: int) -> str:
    """A pattern of the second halves within the bounds that stand right behind one of their first halves."""
    alternatives = []
    for firsts, seconds in _by_firsts({s: f for s, f in pairs.items() if lo <= s <= hi}).items():
        second = _class(seconds)
        alternatives.append(f"[{second}](?<=[{_class(cp for cp in firsts if cp <= 0xFFFF)}][{second}])")
    return rf"(?=[\x{{{lo:x}}}-\x{{{hi:x}}}])(?:{'|'.join(alternatives)})"


def _together(parts: list[tuple[int, int, str]]) -> tuple[int, int, str]:
    """Patterns for neighbouring characters as one, entered only within their bounds."""
    if len(parts) == 1:
        return parts[0]
    lo, hi = parts[0][0], parts[-1][1]
    return lo, hi, rf"(?=[\x{{{lo:x}}}-\x{{{hi:x}}}])(?:{'|'.join(pattern for _, _, pattern in parts)})"
