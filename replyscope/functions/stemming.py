"""English word stems: Porter's suffix rules with the usual later extensions."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

# The published rules, as (suffix, replacement); the first suffix that fits decides
PLURALS = [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")]
DOUBLE = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"),
    ("biliti", "ble"), ("fulli", "ful"), ("logi", "log"),
]
DERIVED = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
LONG = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()
# Words outside the rules
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news", "innings": "inning",
    "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning", "canning": "canning",
    "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


def sounds(word: str) -> str:
    """One letter for each of the word's: v for a vowel, c for a consonant. A y after a consonant is a vowel."""
    marks = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and marks.endswith("c"))
        marks += "v" if vowel else "c"
    return marks


def measure(word: str) -> int:
    """How often a vowel is followed by a consonant."""
    return sounds(word).count("vc")


def short_end(word: str) -> bool:
    """Consonant, vowel and a consonant other than w, x and y at the end; or just a vowel and a consonant."""
    marks = sounds(word)
    return marks == "vc" or (marks.endswith("cvc") and word[-1] not in "wxy")


def replaced(word: str, rules: list[tuple[str, str]], allowed: Callable[[str, str], bool]) -> str:
    """The word with its first fitting suffix replaced, if ``allowed(rest, suffix)``."""
    for suffix, other in rules:
        if word.endswith(suffix):
            rest = word[: len(word) - len(suffix)]
            return rest + other if allowed(rest, suffix) else word
    return word


def without_plural(word: str) -> str:
    if len(word) == 4 and word.endswith("ies"):
        return word[:-1]
    return replaced(word, PLURALS, lambda rest, suffix: True)


def without_tense(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if measure(word[:-3]) else word
    rest = next((word[: -len(end)] for end in ("ed", "ing") if word.endswith(end) and "v" in sounds(word[: -len(end)])), None)
    if rest is None:
        return word
    if rest.endswith(("at", "bl", "iz")):
        return rest + "e"
    if len(rest) > 1 and rest[-1] == rest[-2] and sounds(rest)[-1] == "c":
        return rest if rest[-1] in "lsz" else rest[:-1]
    return rest + "e" if measure(rest) == 1 and short_end(rest) else rest


def with_plain_y(word: str) -> str:
    return word[:-1] + "i" if word.endswith("y") and len(word) > 2 and sounds(word)[-2] == "c" else word


def without_double_suffix(word: str) -> str:
    if word.endswith("alli") and measure(word[:-4]):
        return without_double_suffix(word[:-2])
    # The l of logi counts as part of what is left
    return replaced(word, DOUBLE, lambda rest, suffix: measure(rest + "l" if suffix == "logi" else rest) > 0)


def without_long_suffix(word: str) -> str:
    fits = lambda rest, suffix: measure(rest) > 1 and (suffix != "ion" or rest[-1] in "st")
    return replaced(word, [(suffix, "") for suffix in LONG], fits)


def without_last_letter(word: str) -> str:
    if word.endswith("e") and (measure(word[:-1]) > 1 or (measure(word[:-1]) == 1 and not short_end(word[:-1]))):
        word = word[:-1]
    return word[:-1] if word.endswith("ll") and measure(word[:-1]) > 1 else word


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    """The stem of a lower-case word; words of one or two letters are their own."""
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = with_plain_y(without_tense(without_plural(word)))
    word = replaced(without_double_suffix(word), DERIVED, lambda rest, suffix: measure(rest) > 0)
    return without_last_letter(without_long_suffix(word))
