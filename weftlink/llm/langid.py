"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability in a language is the sum over all ways of cutting it into pieces, which the
forward algorithm adds up; the pieces' probabilities come from a few rounds of
expectation maximisation over the same lattice.

Contract of identify(): a text that is null or holds no letter is `und` with score 0, as
is every text when no language was learned. Words are runs of letters, lower-cased; one
longer than LONG_WORD characters is scored in stretches of that length, so its cost is
linear. Rows map one to one (repeated rows give repeated results, an empty table an empty
one); columns named like an output give way to it. Ties go to the first language by name.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftlink.llm.common import Workspace, append_columns, chunks, small_enough, worker_state

LONG_WORD = 32
#: Bounds of the training sample: documents per language and distinct words per language.
SAMPLE_DOCS = 1500
SAMPLE_WORDS = 30_000
#: Ranges of the documents' hash that are counted by language to find the sample.
HASH_RANGES = 1 << 16
#: Words whose scores one worker keeps; it starts anew beyond.
CACHE_WORDS = 200_000
#: Words after which a longer text gives no more certainty.
FULL_EVIDENCE = 24
UNKNOWN = 1e-7
UNDETERMINED = "und"
_BEGIN = "▁"
_words = re.compile(r"[^\W\d_]+").findall


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def load_pieces(path: str) -> dict[str, int]:
    """Pieces of a vocabulary file that lower-cased words can hold; ids 0 and 1 stay free."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    usable = [p for p in every if p == p.lower() and p.replace(_BEGIN, "", 1).isalpha() or p == _BEGIN]
    return {p: i for i, p in enumerate(usable, 2)}


@lru_cache(maxsize=2)
def longest_piece(path: str) -> int:
    return max(map(len, load_pieces(path)))


def stretches(word: str) -> list[str]:
    marked = _BEGIN + word
    return [marked[i : i + LONG_WORD] for i in range(0, len(marked), LONG_WORD)]


def lattice(parts: list[str], pieces: dict[str, int], longest: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Arcs of the segmentation lattice of parts of one length, and each part's piece on each arc.

    Piece 0 is impossible; piece 1 is a character outside the vocabulary.
    """
    n = len(parts[0])
    arcs = [(i, j) for i in range(n) for j in range(i + 1, min(i + longest, n) + 1)]
    get = pieces.get
    flat = [get(p[i:j], 1 if j - i == 1 else 0) for p in parts for i, j in arcs]
    return arcs, np.array(flat, dtype=np.int32).reshape(len(parts), len(arcs))


def forward(arcs: list[tuple[int, int]], ids: np.ndarray, prob: np.ndarray) -> list[np.ndarray]:
    """For each position, the summed probability of all segmentations of what precedes it."""
    n = arcs[-1][1]
    at = [np.zeros((len(ids), prob.shape[1])) for _ in range(n + 1)]
    at[0] += 1
    for k, (i, j) in enumerate(arcs):
        column = ids[:, k]
        if column.any():
            at[j] += at[i] * prob[column]
    return at


class LanguageModel:
    """Piece probabilities by language: a matrix with a row for each piece."""

    def __init__(self, languages: list[str], prob: np.ndarray, vocabulary: str):
        self.languages, self.prob, self.vocabulary = languages, prob, vocabulary
        self.key = (tuple(languages), vocabulary, hash(prob.tobytes()))

    @classmethod
    def train(cls, counts: dict[str, dict[str, int]], vocabulary: str, rounds: int = 4, smoothing: float = 0.02) -> LanguageModel:
        """Learn from each language's word counts."""
        pieces, longest, languages = load_pieces(vocabulary), longest_piece(vocabulary), sorted(counts)
        prob = np.zeros((len(pieces) + 2, len(languages)))
        for c, language in enumerate(languages):
            own = np.full((len(pieces) + 2, 1), 1.0 / len(pieces))
            by_length: dict[int, tuple[list[str], list[int]]] = {}
            for word, n in counts[language].items():
                for part in stretches(word):
                    names, weights = by_length.setdefault(len(part), ([], []))
                    names.append(part)
                    weights.append(n)
            grids = [(*lattice(names, pieces, longest), np.array(weights, float)) for names, weights in by_length.values()]
            for _ in range(rounds):
                own[0], own[1] = 0, UNKNOWN
                seen = np.zeros(len(own))
                for arcs, ids, weights in grids:
                    before = [x[:, 0] for x in forward(arcs, ids, own)]
                    after = [np.zeros(len(ids)) for _ in before]
                    after[-1] += 1
                    for k in range(len(arcs) - 1, -1, -1):
                        i, j = arcs[k]
                        after[i] += own[ids[:, k], 0] * after[j]
                    scale = weights / before[-1]
                    for k, (i, j) in enumerate(arcs):
                        seen += np.bincount(ids[:, k], before[i] * own[ids[:, k], 0] * after[j] * scale, len(own))
                seen[:2] = 0
                own[:, 0] = (seen + smoothing) / (seen.sum() + smoothing * len(pieces))
            own[0], own[1] = 0, UNKNOWN
            prob[:, c] = own[:, 0]
        return cls(languages, prob, vocabulary)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of every word in every language."""
        pieces, longest = load_pieces(self.vocabulary), longest_piece(self.vocabulary)
        by_length: dict[int, tuple[list[str], list[int]]] = {}
        for k, word in enumerate(words):
            for part in stretches(word):
                names, owners = by_length.setdefault(len(part), ([], []))
                names.append(part)
                owners.append(k)
        out = np.zeros((len(words), len(self.languages)))
        for names, owners in by_length.values():
            arcs, ids = lattice(names, pieces, longest)
            np.add.at(out, owners, np.log(forward(arcs, ids, self.prob)[-1]))
        return out


class Scorer:
    """Scores texts with one model; keeps the scores of words that it has met."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((CACHE_WORDS, len(model.languages)), np.float32)

    def _learn(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self.rows]
        if len(self.rows) + len(fresh) > CACHE_WORDS:
            self.rows.clear()
            fresh = list(words)
            if len(fresh) > len(self.scores):
                self.scores = np.zeros((len(fresh), self.scores.shape[1]), np.float32)
        first = len(self.rows)
        for begin in range(0, len(fresh), 4000):
            part = fresh[begin : begin + 4000]
            self.scores[first + begin : first + begin + len(part)] = self.model.word_scores(part)
        self.rows.update(zip(fresh, range(first, first + len(fresh)), strict=True))

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, certain = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not self.model.languages:
            return names, certain
        for begin, end in chunks(texts):
            found = [_words(t.lower()) if t else [] for t in texts[begin:end]]
            told = [k for k, (words, t) in enumerate(zip(found, texts[begin:end], strict=True)) if words and (words[0].isalpha() or any(map(str.isalpha, t)))]
            if not told:
                continue
            flat = [w for k in told for w in found[k]]
            self._learn(set(flat))
            sizes = np.array([len(found[k]) for k in told])
            sums = np.add.reduceat(self.scores[list(map(self.rows.__getitem__, flat))].astype(np.float64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            logits = sums / np.maximum(1, sizes / FULL_EVIDENCE)[:, None]
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            best = odds.argmax(axis=1)
            share = odds.max(axis=1) / odds.sum(axis=1)
            for k, b, s in zip(told, best, share, strict=True):
                names[begin + k], certain[begin + k] = self.model.languages[b], float(s)
        return names, certain


def _scorer(model: LanguageModel) -> Scorer:
    return worker_state(("langid", model.key), lambda: Scorer(model))


def _needed(counts: DataFrame, order: Column, wanted: int) -> DataFrame:
    """The rows of counts(lang, ..., _c) in this order until _c adds up to `wanted` for the language, without _c."""
    before = Window.partitionBy("lang").orderBy(order)
    found, _ = small_enough(counts.withColumn("_before", F.sum("_c").over(before) - F.col("_c")).where(F.col("_before") < wanted).drop("_c", "_before"))
    return found


def train(docs: DataFrame, learn: str = "true", vocabulary: str | None = None) -> LanguageModel:
    """Learn from rows of docs(doc_id, text, lang) for which `learn` holds and lang is not null.

    The sample is bounded: SAMPLE_DOCS documents of each language, by hash of doc_id, and of
    their whole texts the most frequent words, until there are SAMPLE_WORDS (words of equal
    count stay together). Both bounds are found from counts by range, so no task sorts a
    language: only the ranges that are needed are ranked.
    """
    marked = docs.where(F.expr(learn) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang", F.xxhash64("doc_id").alias("_h"))
    marked = marked.withColumn("_range", F.expr(f"pmod(_h, {HASH_RANGES})"))
    ranges = _needed(marked.groupBy("lang", "_range").agg(F.count("*").alias("_c")), F.col("_range"), SAMPLE_DOCS)
    order = Window.partitionBy("lang").orderBy("_range", "_h", "doc_id")
    chosen = marked.join(ranges, ["lang", "_range"]).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= SAMPLE_DOCS)
    chosen, _ = small_enough(chosen.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct())
    words = (
        docs.join(chosen, (docs["doc_id"] == F.col("_id")) & (docs["lang"] == F.col("_lang")))
        .select("lang", F.explode(F.expr(r"regexp_extract_all(lower(text), '\\p{L}+', 0)")).alias("word"))
        .groupBy("lang", "word").count()
    )
    words = Workspace(docs.sparkSession, "langid").save(words, "words")
    frequent = _needed(words.groupBy("lang", "count").agg(F.count("*").alias("_c")), F.desc("count"), SAMPLE_WORDS)
    ranked = words.join(frequent, ["lang", "count"])
    counts: dict[str, dict[str, int]] = {}
    for row in ranked.select("lang", "word", "count").toLocalIterator():
        counts.setdefault(row[0], {})[row[1]] = row[2]
    return LanguageModel.train(counts, vocabulary or default_vocabulary())


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with the language and its score, as columns of these names."""

    def compute(texts):
        import pyarrow as pa

        found, certain = _scorer(model)(texts.to_pylist())
        return pa.array(found, pa.string()), pa.array(certain, pa.float64())

    return append_columns(docs, [text], f"{names[0]} string, {names[1]} double", compute)
