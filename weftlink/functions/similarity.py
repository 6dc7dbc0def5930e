"""String and set similarities.

Set and flag measures are column expressions. The edit measures run in one Arrow UDF over
both sides of a pair: indel ratio (from the longest common subsequence, bit-parallel),
Jaro-Winkler, and the token-set, token-sort and partial variants of the ratio.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KERNELS = ["ratio", "jaro_winkler", "token_set", "token_sort", "partial"]
#: Pairs that are scored in one go, so that their arrays stay in a core's cache.
AT_ONCE = 1 << 15
#: Texts up to which bounds cost more than they save.
LEAST_BOUNDED = 1000


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """2 LCS / (|a| + |b|); 1 for two empty strings."""
    return 2 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 1.0


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, raised for a common prefix of up to four where it is over 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free, mine = [True] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                mine.append(c)
                break
    if not mine:
        return 0.0
    theirs = [c for c, unused in zip(b, free, strict=True) if not unused]
    swapped = sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    n = len(mine)
    jaro = (n / len(a) + n / len(b) + (n - swapped) / n) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Best ratio among the common words and the common words with either side's rest."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = x & y, x - y, y - x
    if both and (not left or not right):
        return 1.0
    middle, ours, theirs = " ".join(sorted(both)), " ".join(sorted(left)), " ".join(sorted(right))
    joint = len(middle) + (1 if both else 0)
    whole = 2 * (joint + common_subsequence(ours, theirs)) / (2 * joint + len(ours) + len(theirs))
    if not both:
        return whole
    alone = (2 * len(middle) / (2 * len(middle) + 1 + len(rest)) for rest in (ours, theirs))
    return max(whole, *alone)


def subsequences(a: list[str], b: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """common_subsequence(a[i], b[j]) of pairs of numbers of texts."""
    out = np.zeros(len(i), np.int64)
    code = {c: n for n, c in enumerate(sorted({c for t in b for c in t}), 1)}
    size = np.array([len(t) for t in a], np.int64)
    masks = np.zeros((len(a), len(code) + 1), np.uint64)  # of every text and character the bits of its places; code 0 is the end
    for row, t in enumerate(a):
        if len(t) <= 64:
            for at, c in enumerate(t):
                if c in code:
                    masks[row, code[c]] |= np.uint64(1 << at)
    spelled = np.zeros((max((len(t) for t in b), default=0), len(b)), np.int64)
    for column, t in enumerate(b):
        spelled[: len(t), column] = [code[c] for c in t]
    flat, width = masks.ravel(), masks.shape[1]
    full = np.array([(1 << min(n, 64)) - 1 for n in size.tolist()], np.uint64)
    ends = np.array([len(t) for t in b], np.int64)
    for begin in range(0, len(i), AT_ONCE):
        x, y = i[begin : begin + AT_ONCE], j[begin : begin + AT_ONCE]
        row, base = full[x], x * width
        for chars in spelled[: ends[y].max(initial=0)]:
            hit = flat.take(chars.take(y) + base)
            hit &= row
            left = row - hit
            row += hit
            row |= left
        out[begin : begin + AT_ONCE] = size[x] - np.bitwise_count(row & full[x])
    for at in np.flatnonzero(size[i] > 64):
        out[at] = common_subsequence(a[i[at]], b[j[at]])
    return out


def _numbered(row: np.ndarray, mask: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (row, mask), and the number of each pair among them."""
    key = row << bits | mask
    if (int(row.max(initial=0)) + 1) << bits > 1 << 22:
        found, at = np.unique(key, return_inverse=True)
    else:
        used = np.zeros((int(row.max(initial=0)) + 1) << bits, bool)
        used[key] = True
        found, at = np.flatnonzero(used), (np.cumsum(used) - 1)[key]
    return found >> bits, found & ((1 << bits) - 1), at


def token_sets(a: list[str], b: list[str]) -> np.ndarray:
    """token_set() of every text of a with every text of b, all at once."""
    i, j = np.divmod(np.arange(len(a) * len(b)), max(1, len(b)))
    return token_set_pairs(a, b, i, j).reshape(len(a), len(b))


def token_set_pairs(a: list[str], b: list[str], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """token_set() of pairs of numbers of texts."""
    x, y = ([sorted(set(t.split())) for t in texts] for texts in (a, b))
    wide, high = max(map(len, x), default=0), max(map(len, y), default=0)
    if max(wide, high) > 40:  # the masks of words would not fit
        return np.array([token_set(a[i], b[j]) for i, j in zip(rows.tolist(), columns.tolist(), strict=True)])
    known = {w: n for n, w in enumerate(sorted({w for own in y for w in own}), 1)}
    bit = np.zeros((len(known) + 1, len(b)), np.int64)  # the bit of a word in each text of b; word 0 is in none
    for column, own in enumerate(y):
        for at, w in enumerate(own):
            bit[known[w], column] = 1 << at
    words = np.zeros((max(wide, 1), len(a)), np.int64)
    for row, own in enumerate(x):
        words[: len(own), row] = [known.get(w, 0) for w in own]
    ours, theirs = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    flat, width = bit.ravel(), len(b)
    for at, column in enumerate(words):
        hit = flat.take((column * width).take(rows) + columns)
        theirs |= hit
        ours |= (hit > 0).astype(np.int64) << at

    def rests(row, mask, texts):
        return [" ".join(w for at, w in enumerate(texts[r]) if not m >> at & 1) for r, m in zip(row.tolist(), mask.tolist(), strict=True)]

    row, mask, i = _numbered(rows, ours, wide)
    left = rests(row, mask, x)
    joined = np.array([sum(len(w) + 1 for at, w in enumerate(x[r]) if m >> at & 1) for r, m in zip(row.tolist(), mask.tolist(), strict=True)], np.int64)
    row, mask, j = _numbered(columns, theirs, high)
    right = rests(row, mask, y)
    long, short = (np.array([len(t) for t in texts], np.int64)[at] for texts, at in ((left, i), (right, j)))
    joint = joined[i]  # the common words and a space after each: none, or their text and one space
    out = np.zeros(len(i))
    both = (long > 0) & (short > 0)
    common = np.zeros(len(i), np.int64)
    common[both] = subsequences(left, right, i[both], j[both])
    some = np.array([len(own) > 0 for own in x], bool)[rows] & np.array([len(own) > 0 for own in y], bool)[columns]
    np.divide(2 * (joint + common), 2 * joint + long + short, out=out, where=some)
    shared = joint > 0
    for rest in (long, short):
        alone = np.divide(2 * (joint - 1), 2 * joint - 1 + rest, out=np.zeros(len(i)), where=shared)
        np.maximum(out, alone, out=out)
    out[shared & ~both] = 1.0
    return out


def _letters(texts: list[list[str]]) -> np.ndarray:
    """How often each text has the letters of each of 32 classes."""
    out = np.zeros((len(texts), 32), np.int64)
    for row, words in enumerate(texts):
        for c in "".join(words):
            out[row, ord(c) & 31] += 1
    return out


class Texts:
    """Texts b, prepared for best(): of each of some texts a those of b whose token_set() is among the k highest, with all ties.

    A common subsequence of two rests is no longer than the letters they share, whatever their order,
    which one product of matrices gives for all pairs. Only pairs whose bound reaches the k-th score are scored.
    """

    def __init__(self, texts: list[str]):
        self.texts, self.words = texts, [sorted(set(t.split())) for t in texts]
        self.letters = _letters(self.words)
        self.length, self.count = self._sizes(self.words)
        self.holds: dict[str, list[int]] = {}
        for n, own in enumerate(self.words):
            for w in own:
                self.holds.setdefault(w, []).append(n)
        self.holds = {w: np.array(n) for w, n in self.holds.items()}

    @staticmethod
    def _sizes(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        count = np.array([len(own) for own in words], np.float32)
        return np.array([sum(map(len, own)) for own in words], np.float32) + np.maximum(count - 1, 0), count

    def bounds(self, a: list[str]) -> np.ndarray:
        """No less than token_set() of every text of a with every text of b."""
        words = [sorted(set(t.split())) for t in a]
        own = _letters(words)
        most = np.minimum(own.max(axis=0, initial=0), self.letters.max(axis=0, initial=0))
        if most.sum() > 1024:
            return np.ones((len(a), len(self.texts)), np.float32)
        unary = lambda counts: np.concatenate([counts[:, c, None] > np.arange(n) for c, n in enumerate(most)], axis=1).astype(np.float32)
        length, count = self._sizes(words)
        out = unary(own) @ unary(self.letters).T  # letters that both have
        out += np.minimum(count[:, None], self.count)
        out *= 2
        out /= np.maximum(length[:, None] + self.length, 1)
        # With common words alone: the text of them, against the shorter text.
        for row, mine in enumerate(words):
            joint = np.zeros(len(self.texts), np.float32)
            for w in mine:
                if w in self.holds:
                    joint[self.holds[w]] += len(w) + 1
            at = np.flatnonzero(joint)
            middle = joint[at] - 1
            out[row, at] = np.maximum(out[row, at], 2 * middle / (middle + np.minimum(length[row], self.length[at])))
        return out + np.float32(1e-4)

    def best(self, a: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of texts of a, numbers of texts of b, and scores, by a and b."""
        n = len(self.texts)
        if n <= max(LEAST_BOUNDED, 4 * k):
            scores = token_sets(a, self.texts)
            floor = np.partition(scores, n - k, axis=1)[:, n - k, None] if k < n else 0.0
            q, t = np.divmod(np.flatnonzero(scores >= floor), n)
            return q, t, scores[q, t]
        bounds = self.bounds(a)
        first = np.argpartition(bounds, n - 2 * k, axis=1)[:, n - 2 * k :]
        scores = token_set_pairs(a, self.texts, np.repeat(np.arange(len(a)), 2 * k), first.ravel()).reshape(len(a), -1)
        floor = np.partition(scores, k, axis=1)[:, k]  # the k-th highest of 2 k
        q, t = np.divmod(np.flatnonzero(bounds >= floor[:, None].astype(np.float32)), n)
        score = token_set_pairs(a, self.texts, q, t)
        floor = score[np.lexsort((-score, q))][np.searchsorted(q, np.arange(len(a))) + k - 1]
        kept = score >= floor[q]
        return q[kept], t[kept], score[kept]


def partial(a: str, b: str) -> float:
    """Best ratio of the shorter string with any window of its length in the longer one."""
    if not a or not b:
        return float(a == b)
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if short in long:
        return 1.0
    n, where = len(short), {}
    for k, c in enumerate(short):
        where[c] = where.get(c, 0) | 1 << k
    full, shared = (1 << n) - 1, [0]
    for c in long:
        shared.append(shared[-1] + (c in where))
    # A window has no longer common subsequence than it has letters of the short string: most cannot beat the best so far.
    windows = []
    for i in range(1 - n, len(long)):
        begin, end = max(0, i), min(i + n, len(long))
        windows.append((2 * (shared[end] - shared[begin]) / (n + end - begin), begin, end))
    best = 0.0
    for bound, begin, end in sorted(windows, reverse=True):
        if bound <= best:
            break
        row = full
        for c in long[begin:end]:
            hit = row & where.get(c, 0)
            row = (row + hit | row - hit) & full
        best = max(best, 2 * (n - row.bit_count()) / (n + end - begin))
    return best


def kernels(a: str, b: str) -> tuple[float, float, float, float, float]:
    return ratio(a, b), jaro_winkler(a, b), token_set(a, b), token_sort(a, b), partial(a, b)


@F.pandas_udf(T.StructType([T.StructField(name, T.DoubleType()) for name in KERNELS]))
def kernels_udf(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    known: dict[tuple[str, str], tuple] = {}
    for pair in zip(left.fillna(""), right.fillna(""), strict=True):
        if pair not in known:
            known[pair] = kernels(*pair)
    return pd.DataFrame([known[p] for p in zip(left.fillna(""), right.fillna(""), strict=True)], columns=KERNELS)


@F.pandas_udf(T.StructType([T.StructField(name, T.DoubleType()) for name in ("ratio", "token_set")]))
def ratios_udf(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    """ratio() and token_set() without the kernels that cost most."""
    known: dict[tuple[str, str], tuple] = {}
    for pair in zip(left.fillna(""), right.fillna(""), strict=True):
        if pair not in known:
            known[pair] = ratio(*pair), token_set(*pair)
    return pd.DataFrame([known[p] for p in zip(left.fillna(""), right.fillna(""), strict=True)], columns=["ratio", "token_set"])


@F.pandas_udf(T.DoubleType())
def token_set_udf(left: pd.Series, right: pd.Series) -> pd.Series:
    """token_set() alone, a fraction of the cost of all kernels."""
    known: dict[tuple[str, str], float] = {}
    for pair in zip(left.fillna(""), right.fillna(""), strict=True):
        if pair not in known:
            known[pair] = token_set(*pair)
    return pd.Series([known[p] for p in zip(left.fillna(""), right.fillna(""), strict=True)], dtype="float64")


def words(text: Column | str) -> Column:
    """Distinct white-space words; none for empty text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_distinct(F.filter(F.split(F.coalesce(column, F.lit("")), r"\s+"), lambda t: t != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two arrays without repeats: 1 if both are empty, 0 if one is."""
    joint = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(joint / (F.size(a) + F.size(b) - joint))


def legal_flags(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """match, conflict, missing of two sorted arrays of legal forms."""
    missing = (F.size(a) == 0) | (F.size(b) == 0)
    return (~missing & (a == b)).cast("int"), (~missing & (a != b)).cast("int"), missing.cast("int")


def tri_state(a: Column, b: Column) -> Column:
    """-1 if either is empty, else 1 for equal and 0 for different."""
    return F.when((a == "") | (b == ""), -1).otherwise((a == b).cast("int"))


def length_ratio(a: Column, b: Column) -> Column:
    """Shorter over longer length; 0 if both are empty."""
    return F.coalesce(F.try_divide(F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))), F.lit(0.0))


def cosine(a: Column, b: Column) -> Column:
    """Inner product of two arrays of unit length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
