"""How many guesses a password takes: the cheapest way to put it together from guessable parts.

A part is a word (in any letter case, with the usual look-alike digits, forwards or backwards), a date or year, a repeat, a
keyboard walk or alphabet run, a separator, or characters tried one by one. Costs are decimal logarithms of guesses and add up; dynamic
programming over the end of the last part finds the least sum in time proportional to the length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from functools import cache
from types import MappingProxyType

# Words that passwords are made of, most usual first.
WORDS = """password pass admin welcome login letmein qwerty monkey dragon master shadow sunshine princess football
baseball superman batman iloveyou trustno secret hello freedom whatever computer internet server default changeme test
testing user root guest example sample dummy system database service access token private public key keys api auth client
session account demo temp temporary dev develop prod production staging local config value string here your my the this
that is not and for with from none null true false placeholder redacted hidden removed insert enter todo fixme please replace summer winter
spring autumn monday friday january june july august december london berlin paris madrid america company office home
house family mother father sister brother love lover angel baby money power magic star silver golden purple orange yellow
green blue black white red tiger lion eagle wolf horse chicken cookie coffee cheese banana apple cherry pepper ginger
michael jordan thomas charlie andrew daniel jessica ashley hannah robert george william secure security open sesame""".split()

# Rows of keyboards and alphabets; neighbours in a row are a step.
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "qaz", "wsx", "edc", "rfv",
         "tgb", "yhn", "ujm", "azertyuiop", "qwertzuiop")

# Digits and signs written for letters.
LOOK_ALIKES = str.maketrans("4@831!05$7", "aabeiiosst")

_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|"
                   r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|"
                   r"(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\3(?:19|20)\d\d|(?:19|20)\d\d", re.ASCII)
_YEARS, _DAYS = 130, 366
_SEPARATORS = "_-. "
_LONGEST_PART = 64  # a longer walk is several parts
_LONGEST_UNIT = 8
_SEPARATE = math.log10(2)  # an attacker must also guess that another part follows


@cache
def _ranks() -> dict[str, float]:
    ranks: dict[str, float] = {}
    for rank, word in enumerate(WORDS, 1):
        ranks.setdefault(word, math.log10(rank + 1))
    for word in list(ranks):
        ranks.setdefault(word[::-1], ranks[word] + math.log10(2))
    return ranks


@cache
def _steps() -> frozenset[str]:
    pairs = {row[i:i + 2] for row in WALKS for i in range(len(row) - 1)}
    return frozenset(pairs | {p[::-1] for p in pairs})


def _alphabet(value: str) -> int:
    """Characters to try one by one, going by the kinds that the value has."""
    if re.fullmatch("[0-9]*", value):
        return 10
    if re.fullmatch("[0-9a-f]*|[0-9A-F]*", value):
        return 16
    kinds = ((26, str.islower), (26, str.isupper), (10, str.isdigit))
    size = sum(n for n, kind in kinds if any(map(kind, value)))
    return size + (33 if any(not c.isalnum() for c in value) else 0) or 26


def _dates(value: str) -> dict[int, list[tuple[int, float]]]:
    """By end: (start, cost) of the dates and years."""
    found: dict[int, list[tuple[int, float]]] = {}
    for match in _DATE.finditer(value):
        cost = math.log10(_YEARS * (_DAYS if len(match[0]) > 4 else 1))
        found.setdefault(match.end(), []).append((match.start(), cost))
    return found


def cheapest_parts(value: str, learned: Mapping[str, float] = MappingProxyType({})) -> tuple[float, list[tuple[str, int, int]]]:
    """(decimal logarithm of the guesses, parts as (kind, start, end)). The empty value takes one guess. learned: the costs of more
    words, in small letters. Time and memory are in proportion to the length: of walks and repeats only where the run that reaches
    the present character began is kept. A repeat is tried from where it begins, or its last 64 characters."""
    size = len(value)
    lower = value.lower() if len(value.lower()) == size else value
    plain = lower.translate(LOOK_ALIKES)
    ranks, steps, single = _ranks(), _steps(), math.log10(_alphabet(value))
    longest_word = max(max(map(len, ranks)), max(map(len, learned), default=0))
    dates, walk, repeats = _dates(value), 0, [0] * (_LONGEST_UNIT + 1)  # where the walk, and the repeat of each unit, began

    # The least cost up to each end, whatever the last part is (best, with that part) and if characters tried one by one end there
    # (tried, with where these begin): the next such character belongs to the same part, so the two are not the same.
    best, last = [0.0] * (size + 1), [("", 0)] * (size + 1)
    tried, since = [math.inf] * (size + 1), [0] * (size + 1)
    for end in range(1, size + 1):
        here = end - 1
        fresh = best[here] + single + (_SEPARATE if here else 0)
        if tried[here] + single <= fresh:
            tried[end], since[end] = tried[here] + single, since[here]
        else:
            tried[end], since[end] = fresh, here
        choice = (tried[end], "brute", since[end])

        def offer(cost: float, kind: str, begin: int) -> None:
            nonlocal choice
            total = best[begin] + cost + (_SEPARATE if begin and kind != "separator" else 0)
            if total < choice[0]:
                choice = (total, kind, begin)

        for begin, cost in dates.get(end, ()):
            offer(cost, "date", begin)
        if here and lower[here - 1:end] not in steps:
            walk = here
        for begin in range(max(walk, end - _LONGEST_PART), end - 2):  # any cut of a walk is a walk
            offer(math.log10(len(WALKS) * 10 * (end - begin)), "walk", begin)
        for unit in range(1, _LONGEST_UNIT + 1):  # stretches in which each character equals the one a unit before
            if here - unit >= repeats[unit] and value[here] != value[here - unit]:
                repeats[unit] = here - unit + 1
            if end - repeats[unit] >= max(3, 2 * unit):
                for begin in {repeats[unit], max(repeats[unit], end - _LONGEST_PART)}:
                    offer(unit * single + math.log10(end - begin), "repeat", begin)
        if value[here] in _SEPARATORS:
            offer(math.log10(len(_SEPARATORS)), "separator", here)
        for begin in range(max(0, end - longest_word), end - 2):
            for text, more in ((lower, 0.0), (plain, math.log10(2))):
                part = text[begin:end]
                rank = ranks.get(part, learned.get(part))
                if rank is not None:
                    case = 0.0 if value[begin:end].islower() or not any(map(str.isalpha, value[begin:end])) else math.log10(2)
                    offer(rank + more + case, "word", begin)
        best[end], last[end] = choice[0], choice[1:]
    parts, end = [], size
    while end:
        kind, begin = last[end]
        parts.append((kind, begin, end))
        end = begin
    return best[size], parts[::-1]


def ranked(words: list[str]) -> dict[str, float]:
    """Costs of further words, most usual first, that come after the fixed ones."""
    return {word: math.log10(len(WORDS) + rank + 1) for rank, word in enumerate(words, 1)}
