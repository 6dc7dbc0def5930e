"""Toxicity by a weighted finite-state grammar over clauses.

A clause is a run of words up to sentence punctuation or a line break. Its words become
symbols, sets of what they may be: insult, threat, intent, target, negation, reporting
word. The insult transducer reads letters; its arcs are words and stems, with weights. The
others are tables from state and symbol to state and marks: threat marks what intent
precedes, target what a target is close to (one transducer reads forwards, one backwards),
negation and reported speech what they govern. compose() makes one table of the forward
ones and of the last, which reads all marks and writes what a word amounts to in its
clause. The clause as a whole then matches one pattern, the gravest that occurs in it:
threat, aimed insult, bare insult, reported or negated, with the weights of the arcs that
lead there. Clauses are scored, not words: whatever else occurs in a clause adds nothing.

Weights are log odds. The insult transducer starts from fixed word lists in four languages
and takes up words and stems that labelled clean and toxic documents tell apart; a logistic
regression over the patterns of a document's clauses then sets its odds.

Contract of score(): null and empty texts get the score of a text without any match; rows
map one to one; columns named like an output give way to it. Whole texts are read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.common import append_columns, small_enough, worker_state

#: Bounds of the labelled sample, by hash of doc_id.
SAMPLE_TOXIC = 3000
SAMPLE_CLEAN = 8000
#: Most terms the insult transducer may take up from labels.
LEARNED_TERMS = 2000
#: Different words that must precede a learned term in the sample.
CONTEXTS = 4

# Fixed word lists that the grammar starts from; a trailing + stands for any ending of one letter or more.
INSULTS = """idiot idiots moron morons stupid loser losers pathetic worthless scum trash clown disgusting imbecile dumb fool
filth vermin garbage jerk creep parasite bastard dimwit halfwit lowlife dummkopf trottel abschaum arschloch vollidiot
widerlich erbärmlich wertlos versager imbécile crétin abruti ordure salaud minable dégoûtant idiota imbécil estúpido
estúpida escoria basura asqueroso payaso miserable""".split()
THREATS = """kill hurt destroy beat crush stab shoot burn töten umbringen zerstören schlagen tuer détruire frapper matar
destruir golpear""".split()
INTENTS = "will going gonna shall must werde wirst wird vais va voy va vamos".split()
TARGETS = """you your yours yourself he she they them him her his their du dich dir dein deine ihr euch sie er tu te toi
ton ta vous votre vos il elle ils elles tú ti usted ustedes vosotros él ella ellos ellas""".split()
NEGATIONS = "not no never isn't aren't don't nobody nicht kein keine nie niemals ne pas jamais aucun nunca jamás ningún ninguna".split()
REPORTS = """said says saying told called calls reported reports quoted wrote claimed alleged according sagte sagt nannte laut schrieb dit
disait selon appelé écrit dijo dice según llamó escribió""".split()

FEATURES = ["bare", "aimed", "negated", "reported", "threat", "strongest", "share"]
_CLAUSE_END = re.compile(r"[.!?;:\n\r]+")
_word = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?").findall
_REACH = 4
#: Words that a worker remembers the symbol of.
_SYMBOLS = 100_000

# Bits of a symbol: what a word may be, then what transducers write.
INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT = (1 << i for i in range(6))
AHEAD, NEAR, MEANT, DENIED, TOLD = (1 << i for i in range(6, 11))
#: What a word amounts to, the gravest first, and its bit.
PATTERNS = {"threat": 1 << 11, "aimed": 1 << 12, "bare": 1 << 13, "reported": 1 << 14, "negated": 1 << 15}


@dataclass(frozen=True)
class Transducer:
    """Tables of a sequential transducer: from (state, the bits it reads) to (state, bits written); it starts in state 0."""

    reads: int
    writes: int
    steps: dict[tuple[int, int], tuple[int, int]]

    def run(self, symbols: list[int]) -> list[int]:
        """The symbols with what it writes to each."""
        state, out = 0, []
        for symbol in symbols:
            state, written = self.steps[state, symbol & self.reads]
            out.append(symbol | written)
        return out


def _subsets(bits: int):
    part = bits
    while True:
        yield part
        if not part:
            return
        part = (part - 1) & bits


def behind(trigger: int, mark: int, reach: int) -> Transducer:
    """Marks the `reach` symbols that follow a trigger."""
    steps = {(s, bit): (reach if bit else max(s - 1, 0), mark if s else 0) for s in range(reach + 1) for bit in (0, trigger)}
    return Transducer(trigger, mark, steps)


def from_then_on(trigger: int, mark: int) -> Transducer:
    """Marks all symbols that follow a trigger."""
    return Transducer(trigger, mark, {(s, bit): (int(s or bit > 0), mark if s else 0) for s in (0, 1) for bit in (0, trigger)})


def judgement() -> Transducer:
    """Writes what a word amounts to, from its marks."""
    reads, steps = INSULT | THREAT | AHEAD | NEAR | MEANT | DENIED | TOLD, {}
    for x in _subsets(reads):
        meant = x & THREAT and x & MEANT
        name = "negated" if x & DENIED else "reported" if x & TOLD else "threat" if meant else "aimed" if x & (NEAR | AHEAD) else "bare"
        steps[0, x] = (0, PATTERNS[name] if meant or x & INSULT else 0)
    return Transducer(reads, sum(PATTERNS.values()), steps)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that writes what `second` writes after `first`; only pairs of states that can be reached."""
    reads = first.reads | second.reads & ~first.writes
    number, steps, todo = {(0, 0): 0}, {}, [(0, 0)]
    while todo:
        pair = todo.pop()
        for symbol in _subsets(reads):
            one, written = first.steps[pair[0], symbol & first.reads]
            two, more = second.steps[pair[1], (symbol | written) & second.reads]
            if (one, two) not in number:
                number[one, two] = len(number)
                todo.append((one, two))
            steps[number[pair], symbol] = (number[one, two], written | more)
    return Transducer(reads, first.writes | second.writes, steps)


def forward_parts() -> list[Transducer]:
    """The transducers that read forwards, in the order in which they are composed."""
    return [behind(NEGATION, DENIED, _REACH - 1), from_then_on(REPORT, TOLD), behind(INTENT, MEANT, _REACH), behind(TARGET, NEAR, _REACH), judgement()]


#: The transducer that reads a clause backwards, so that an insult knows of a target ahead.
BACKWARD = behind(TARGET, AHEAD, _REACH)


@lru_cache(maxsize=1)
def composed() -> Transducer:
    return reduce(compose, forward_parts())


@dataclass
class Grammar:
    """Weights of the transducers and of the regression that reads the acceptor's registers."""

    terms: dict[str, float]
    coefficients: list[float] = field(default_factory=lambda: [1.6, 2.2, 0.5, 0.6, 1.8, 0.8, 0.5])
    intercept: float = -3.5
    key: int = 0

    def __post_init__(self):
        self.key = hash((tuple(sorted(self.terms.items())), tuple(self.coefficients), self.intercept))


class Acceptor:
    """The grammar's transducers: insult arcs over letters, the composed one and the backward one over symbols."""

    def __init__(self, grammar: Grammar):
        import ahocorasick

        self.grammar = grammar
        self.whole = {t: w for t, w in grammar.terms.items() if not t.endswith("+")}
        self.stems = {t[:-1]: w for t, w in grammar.terms.items() if t.endswith("+")}
        self.lexicon: dict[str, int] = {}
        for words, bit in ((THREATS, THREAT), (INTENTS, INTENT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)):
            for word in words:
                self.lexicon[word] = self.lexicon.get(word, 0) | bit
        self.machine, self.known = composed(), {}
        self.finder = ahocorasick.Automaton()
        for term in {*self.whole, *self.stems, *THREATS}:
            self.finder.add_word(term, len(term))
        self.finder.make_automaton()
        self.longest = max(map(len, self.stems), default=0)

    def insult(self, word: str) -> float:
        """Weight that the insult transducer writes for a word; 0 if it is none."""
        found = self.whole.get(word, 0.0)
        for n in range(3, min(self.longest, len(word) - 1) + 1):
            found = max(found, self.stems.get(word[:n], 0.0))
        return found

    def suspects(self, text: str) -> list[tuple[int, int]]:
        """Spans of the clauses where a word begins like a term of the grammar."""
        spans: list[tuple[int, int]] = []
        for end, size in self.finder.iter(text):
            begin = end - size + 1
            if begin and text[begin - 1].isalpha() or spans and begin < spans[-1][1]:
                continue
            left = max((text.rfind(c, spans[-1][1] if spans else 0, begin) for c in ".!?;:\n\r"), default=-1) + 1
            close = _CLAUSE_END.search(text, end + 1)
            spans.append((left, close.start() if close else len(text)))
        return spans

    def symbol(self, word: str) -> tuple[int, float]:
        """What a word may be, and the weight of the insult arc that reads it."""
        found = self.known.get(word)
        if found is None:
            weight = self.insult(word)
            found = (self.lexicon.get(word, 0) | (INSULT if weight else 0), weight)
            if len(self.known) >= _SYMBOLS:
                self.known.clear()
            self.known[word] = found
        return found

    def clause(self, words: list[str]) -> tuple[str, float] | None:
        """The pattern that a clause matches, and its weight; None if it matches none."""
        read = [self.symbol(w) for w in words]
        symbols = BACKWARD.run([s for s, _ in read][::-1])[::-1]
        sums = dict.fromkeys(PATTERNS, 0.0)
        for symbol, (_, weight) in zip(self.machine.run(symbols), read, strict=True):
            for name, bit in PATTERNS.items():
                if symbol & bit:
                    sums[name] += weight or 1.0
        return next(((name, weight) for name, weight in sums.items() if weight), None)

    def registers(self, text: str | None) -> list[float]:
        """What the clauses of a text add up to, in the order of FEATURES."""
        out = dict.fromkeys(FEATURES, 0.0)
        if text:
            text = text.lower()
            length = 0
            for begin, end in self.suspects(text):
                words = _word(text[begin:end])
                match = self.clause(words)
                if match:
                    kind, weight = match
                    length += len(words)
                    out[kind] += weight
                    if kind in ("bare", "aimed", "threat"):
                        out["strongest"] = max(out["strongest"], weight)
            out["share"] = float(np.log1p(length))
        return [float(np.log1p(out[k])) if k not in ("strongest", "share") else out[k] for k in FEATURES]

    def score(self, text: str | None) -> float:
        x = self.registers(text)
        logit = self.grammar.intercept + sum(c * v for c, v in zip(self.grammar.coefficients, x, strict=True))
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def machine(grammar: Grammar) -> Acceptor:
    return worker_state(("toxicity", grammar.key), lambda: Acceptor(grammar))


def word_terms(word: str) -> list[str]:
    return [word, *(word[:n] + "+" for n in range(4, min(8, len(word) - 1) + 1))]


def learn_terms(toxic: list[str], clean: list[str]) -> dict[str, float]:
    """Words and stems that mark toxic documents, with log odds; those that no clean one holds come first."""
    in_toxic: Counter[str] = Counter()
    for text in toxic:
        in_toxic.update({t for w in set(_word(text.lower())) if len(w) >= 3 for t in word_terms(w)})
    least = max(3, len(toxic) // 1000)
    open_terms = {t for t, n in in_toxic.items() if n >= least}
    in_toxic = Counter({t: in_toxic[t] for t in open_terms})
    in_clean: Counter[str] = Counter()
    for text in clean:
        in_clean.update(open_terms.intersection(t for w in set(_word(text.lower())) if len(w) >= 3 for t in word_terms(w)))
    scale = len(toxic) / max(1, len(clean))
    odds = {t: float(np.log((in_toxic[t] + 0.1) / (in_clean[t] * scale + 0.1))) for t in open_terms}
    strong = sorted((t for t in open_terms if in_clean[t] * scale * 12 <= in_toxic[t]), key=lambda t: (in_clean[t] > 0, -in_toxic[t], len(t), t))
    holders: dict[str, set[int]] = {t: set() for t in strong}
    before: dict[str, set[str]] = {t: set() for t in strong}
    for k, text in enumerate(toxic):
        words = _word(text.lower())
        for last, word in zip(["", *words], words, strict=False):
            if len(word) >= 3:
                for t in word_terms(word):
                    if t in before:
                        holders[t].add(k)
                        if len(before[t]) < 2 * CONTEXTS:
                            before[t].add(last)
    kept: dict[str, float] = {}
    covered: set[int] = set()
    for t in strong:
        if len(kept) == LEARNED_TERMS:
            break
        fresh = len(holders[t] - covered)
        # Words of a text that was copied often are always preceded by the same word.
        if len(before[t]) < CONTEXTS:
            continue
        # A term that explains few documents by itself is chance, unless nothing clean ever holds it.
        if fresh >= max(2, 0.1 * len(holders[t])) or in_clean[t] == 0 and len(holders[t]) >= max(5, len(toxic) // 50):
            kept[t] = odds[t]
            covered |= holders[t]
    return kept


def fit(toxic: list[str], clean: list[str], rounds: int = 30, ridge: float = 0.002) -> Grammar:
    """Learn terms on one half of the sample and the regression on the other, then all terms."""
    terms = {t: 2.0 for t in INSULTS}
    if not toxic or not clean:
        return Grammar(terms)
    half = Grammar({**terms, **learn_terms(toxic[::2], clean[::2])})
    reader = Acceptor(half)
    x = np.array([reader.registers(t) for t in [*toxic[1::2], *clean[1::2]]] or [[0.0] * len(FEATURES)])
    y = np.array([1.0] * len(toxic[1::2]) + [0.0] * len(clean[1::2]) or [0.0])
    prior = np.array([*half.coefficients, half.intercept])
    design, w = np.c_[x, np.ones(len(x))], prior.copy()

    def loss(at):
        z = design @ at
        return np.mean(np.logaddexp(0, z) - y * z) + ridge / 2 * np.sum((at - prior) ** 2)

    for _ in range(rounds):  # damped Newton steps towards the posterior mode around the prior
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        gradient = design.T @ (p - y) / len(y) + ridge * (w - prior)
        curve = (design * (p * (1 - p))[:, None]).T @ design / len(y) + ridge * np.eye(len(w))
        step, size = np.linalg.solve(curve, gradient), 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    w[: len(FEATURES)] = np.maximum(w[: len(FEATURES)], 0)
    return Grammar({**terms, **learn_terms(toxic, clean)}, [float(v) for v in w[:-1]], float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, learn: str = "true") -> Grammar:
    """Learn from docs(doc_id, text) that labels(doc_id, toxic) marks and for which `learn` holds.

    The sample is bounded: SAMPLE_TOXIC and SAMPLE_CLEAN documents by hash of doc_id.
    """
    marked = labels.where(F.expr(learn) & F.col("doc_id").isNotNull()).select("doc_id", "toxic").distinct()
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = marked.where("toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC).union(marked.where("toxic = 0").orderBy(*order).limit(SAMPLE_CLEAN))
    chosen, _ = small_enough(chosen.select(F.col("doc_id").alias("_id"), "toxic"))
    sample = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id")).select("doc_id", "toxic", "text")
    texts: dict[int, list[tuple[int, str]]] = {0: [], 1: []}
    for row in sample.toLocalIterator():
        texts[row["toxic"]].append((row["doc_id"], row["text"] or ""))
    return fit(*([t for _, t in sorted(texts[mark])] for mark in (1, 0)))


def score(docs: DataFrame, grammar: Grammar, text: str = "text", threshold: float = 0.3, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with the score (0 to 1) and the prediction (1 from the threshold on), as columns of these names."""

    def compute(texts):
        import pyarrow as pa

        reader = machine(grammar)
        found = [reader.score(t) for t in texts.to_pylist()]
        return pa.array(found, pa.float64()), pa.array([int(s >= threshold) for s in found], pa.int32())

    return append_columns(docs, [text], f"{names[0]} double, {names[1]} int", compute)
