"""Characters outside ASCII: garbled runs repaired, scripts and compatibility forms spelled in Latin.

Both walk a text's own characters once, which no chain of replacements can do in bounded time, so
they run in Arrow batches; callers pass null for rows that do not need them.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, functions as F

from pressroom import fixed_values as V

#: Common romanisation, small letters; capitals follow.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "ґ": "g", "д": "d", "е": "e", "ё": "e", "є": "ie", "ж": "zh", "з": "z",
    "и": "i", "і": "i", "ї": "i", "й": "i", "ј": "j", "к": "k", "л": "l", "љ": "lj", "м": "m", "н": "n", "њ": "nj",
    "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "ћ": "c", "у": "u", "ў": "u", "ф": "f", "х": "kh", "ц": "ts",
    "ч": "ch", "џ": "dz", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "iu", "я": "ia",
    "ђ": "d", "ѓ": "g", "ѕ": "z", "ќ": "k", "ѐ": "e", "ѝ": "i",
}
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l",
    "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph",
    "χ": "ch", "ψ": "ps", "ω": "o",
}
#: Names of letters that end in their sound.
_SOUNDED = re.compile(r"(?:HIRAGANA|KATAKANA|HANGUL) (?:LETTER|SYLLABLE) (?:SMALL )?([A-Z]+)\Z")
_CODE = re.compile(r"[^\x00-\x7f]+")
_LATIN_MARKS = re.compile(r"(?<=[A-Za-z])[̀-ͯ]+")


@cache
def _emoji_codes() -> frozenset[int]:
    ends = ((entry.split("-")[0], entry.split("-")[-1]) for entry in V.EMOJI_CODE_POINTS)
    return frozenset(code for first, last in ends for code in range(int(first, 16), int(last, 16) + 1))


def _spelled(char: str) -> str | None:
    """Latin spelling of one character; None if there is none."""
    for table in (CYRILLIC, GREEK):
        if char in table:
            return table[char]
        if char.lower() in table:
            return table[char.lower()].capitalize()
    sound = _SOUNDED.match(unicodedata.name(char, ""))
    return sound.group(1).lower() if sound else None


class Spelling(dict):
    """Spellings by code point, worked out when first asked for; characters without one stand for themselves."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        found = _spelled(char)
        if found is None:
            plain = unicodedata.normalize("NFKD", char)
            base = "".join(c for c in plain if not unicodedata.combining(c))
            if base != char and base:
                found = "".join(_spelled(c) or ("/" if c == "⁄" else V.PLAIN_SIGNS.get(c, c)) for c in base)
        self[code] = char if found is None or code in _emoji_codes() else found
        return self[code]


_SPELLING = Spelling()


def spell(text: str) -> str:
    """Compatibility forms and letters with a Latin spelling in Latin; everything else as it is."""
    composed = _LATIN_MARKS.sub("", unicodedata.normalize("NFC", text))
    return _CODE.sub(lambda run: run.group().translate(_SPELLING), composed)


@cache
def _bytes_shown() -> dict[str, int]:
    """The byte that each character stands for where UTF-8 was read as Windows-1252 or Latin-1."""
    shown = {chr(byte): byte for byte in range(0x80, 0x100)}
    for byte in range(0x80, 0xA0):
        try:
            shown[bytes([byte]).decode("cp1252")] = byte
        except UnicodeDecodeError:
            pass
    return shown


def _keeping(char: str) -> float:
    return 3.0 if "\x80" <= char <= "\x9f" else 0.5 if char.isalpha() and char >= "À" else 1.0


def _reading(char: str, n: int, long_run: bool) -> float:
    """Cost of taking ``n`` characters for ``char``: low for what European texts are full of."""
    code = ord(char)
    if 0xC0 <= code <= 0x17F or 0x2000 <= code <= 0x206F:
        return 0.5
    common = 0x391 <= code <= 0x3C9 or 0x410 <= code <= 0x44F or code in (0x401, 0x451)
    if code < 0xC0 or (long_run and (n > 2 or common)):
        return 1.0
    return float(n)


def _reread(run: str) -> str:
    """One reading of a run: each character kept, or several taken for one, at the least cost."""
    shown = _bytes_shown()
    data = [shown.get(c) for c in run]
    best: list[tuple[float, int]] = [(0.0, 0)]
    for i, char in enumerate(run):
        choice = best[i][0] + _keeping(char), 1
        for n in (2, 3, 4):
            part = data[max(0, i + 1 - n) : i + 1]
            if len(part) < n or None in part:
                break
            try:
                read = bytes(part).decode("utf-8")
            except UnicodeDecodeError:
                continue
            if len(read) == 1:
                choice = min(choice, (best[i + 1 - n][0] + _reading(read, n, len(run) > 3), n))
        best.append(choice)
    out, i = [], len(run)
    while i:
        n = best[i][1]
        out.append(run[i - 1] if n == 1 else bytes(data[i - n : i]).decode("utf-8"))
        i -= n
    return "".join(reversed(out))


def _repaired_run(found: re.Match) -> str:
    run = found.group()
    while True:  # each reading that changes a run makes it shorter
        again = _reread(run)
        if again == run:
            return run
        run = again


def repair(text: str) -> str:
    """Runs of characters that are UTF-8 read as Windows-1252 or Latin-1, once or several times, read rightly.

    Each run stands for itself, so right and garbled ones may be mixed, also side by side.
    """
    return _CODE.sub(_repaired_run, text)


def _mapped(function):
    def work(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else function(t) for t in texts.to_pylist()], pa.string())

    return work


def spelled(text: Column) -> Column:
    return F.arrow_udf(_mapped(spell), "string")(text)


def repaired(text: Column) -> Column:
    return F.arrow_udf(_mapped(repair), "string")(text)
