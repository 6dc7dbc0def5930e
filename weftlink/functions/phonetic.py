"""Metaphone keys of single words."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VOWELS = "AEIOU"
#: Letters whose code does not depend on what stands around them.
_PLAIN = {"B": "B", "F": "F", "J": "J", "L": "L", "M": "M", "N": "N", "Q": "K", "R": "R", "V": "F", "Z": "S"}


def _hard(word: str, at: int) -> str:
    """Code of C, G, D, H, K, P, S, T, W, X or Y at a place."""
    here, before, after = word[at], word[at - 1 : at], word[at + 1 : at + 2]
    soft = after in ("E", "I", "Y") and after != ""
    if here == "C":
        if word.startswith("CIA", at):
            return "X"
        if after == "H":
            return "K" if before == "S" else "X"
        if soft:
            return "" if before == "S" else "S"
        return "K"
    if here == "D":
        return "J" if after == "G" and word[at + 2 : at + 3] in ("E", "I", "Y") and word[at + 2 : at + 3] else "T"
    if here == "G":
        if after == "H":
            return "" if at + 2 < len(word) and word[at + 2] not in _VOWELS or at + 2 == len(word) else "K"
        if after == "N" and (at + 2 == len(word) or word[at + 1 :] == "NED"):
            return ""
        if before == "D" and soft:
            return ""
        return "J" if soft and before != "G" else "K"
    if here == "H":
        silent = before in ("C", "S", "P", "T", "G") and before != ""
        return "H" if after and after in _VOWELS and not silent else ""
    if here == "K":
        return "" if before == "C" else "K"
    if here == "P":
        return "F" if after == "H" else "P"
    if here == "S":
        return "X" if after == "H" or word.startswith(("SIO", "SIA"), at) else "S"
    if here == "T":
        if word.startswith(("TIA", "TIO"), at):
            return "X"
        if after == "H":
            return "0"
        return "" if word.startswith("TCH", at) else "T"
    if here == "X":
        return "KS"
    return here if after and after in _VOWELS else ""


def metaphone(word: str | None) -> str:
    """Sound key of a word; letters other than A-Z are skipped."""
    letters = "".join(c for c in (word or "").upper() if "A" <= c <= "Z")
    if not letters:
        return ""
    if letters[:2] in ("AE", "GN", "KN", "PN", "WR"):
        letters = letters[1:]
    elif letters[0] == "X":
        letters = "S" + letters[1:]
    elif letters[:2] == "WH":
        letters = "W" + letters[2:]
    out = []
    for at, here in enumerate(letters):
        if at and here == letters[at - 1] and here != "C":
            continue
        if here in _VOWELS:
            out.append(here if at == 0 else "")
        elif here == "B" and at and letters[at - 1] == "M" and at == len(letters) - 1:
            continue
        else:
            out.append(_PLAIN.get(here) or _hard(letters, at))
    return "".join(out)


@F.pandas_udf(T.StringType())
def metaphone_udf(words: pd.Series) -> pd.Series:
    known = {w: metaphone(w) for w in words.unique()}
    return words.map(known)
