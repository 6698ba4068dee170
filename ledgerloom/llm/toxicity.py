"""Toxicity by Levenshtein automata over a lexicon trie, with context windows.

**Lexicon.** Terms are learned from a bounded sample of labelled documents. A term is a word or a stem (a word
beginning) that occurs far more often in toxic documents than chance allows. What counts is the number of
different neighbourhoods (word before, word after) a term is met in, so the words of a text that was copied many
times count once.

**Matching.** The terms form a trie. The automaton that accepts everything within a few edits of a word is
intersected with it: a state is a set of (trie node, edits so far), a letter leads from state to state, and the
transitions are kept as they are met. So a word is tested against all terms and all their misspellings in one
walk over its letters, which mostly ends after two or three of them.

**Score.** Each match looks at the words around it. Between quotation marks, or next to words of reporting, it is
a quotation unless somebody is addressed. A match is as strong as the log-odds its word has for toxic documents in
the sample; less if it is quoted or misspelled. A logistic model of the sum over the different words matched, the
strongest of them and the length of the text gives the score. It is fitted on the same bounded sample.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import whole
from ledgerloom.sources.store import Store

SAMPLE = 12_000  # labelled documents the lexicon and the weights are learned from
THRESHOLD = 0.3
WINDOW = 6  # words looked at on either side of a match
_SHORTEST, _LONGEST = 3, 20  # letters of a stem
_EVIDENCE = 14.0  # log-likelihood ratio a term needs
_KNOWN = 200_000  # words a task remembers

_WORD = re.compile(r"[^\W_]+(?:[*@$!'’][^\W_]+)*")
_MARK = re.compile(r"[\"“”„«»]")
#: Words that report or discuss a word, and words that address somebody.
REPORTING = frozenset(
    "said says say wrote writes quote quoted quotes quoting called calls term word words slur insult means meaning "
    "definition sagte schrieb zitat zitiert wort begriff bedeutet dit écrit citation cité mot terme signifie dijo "
    "escribió cita citado palabra término significa".split()
)
ADDRESS = frozenset("you your you're u ur du dich dir dein deine ihr euch tu toi te vous ton tú ti usted ustedes".split())

PRIOR = (-4.5, 0.35, 0.9, -0.3)  # the logistic model before any document is seen
_TRUST = 3.0  # documents' worth of trust in it


@dataclass(frozen=True)
class Term:
    text: str
    is_stem: bool  # words that begin with it match too
    weight: float  # share of its neighbourhoods that are in toxic documents
    edits: int  # misspellings allowed


def allowed_edits(text: str, is_stem: bool) -> int:
    """Short terms are near too many other words."""
    length = len(text) - 2 * is_stem
    return 0 if length < 4 else 1 if length < 9 else 2


class Matcher:
    """The intersection of the Levenshtein automata of all words with the trie of the terms, made as needed."""

    def __init__(self, terms: Sequence[Term]):
        self.terms = terms
        self.next: list[dict[str, int]] = [{}]  # trie: letter -> node
        self.ends: list[list[int]] = [[]]  # terms that end in a node: a word, a stem, or both
        self.room: list[int] = [0]  # most edits that a term below a node allows
        for number, term in enumerate(terms):
            node = 0
            self.room[0] = max(self.room[0], term.edits)
            for letter in term.text:
                if letter not in self.next[node]:
                    self.next[node][letter] = len(self.next)
                    self.next.append({})
                    self.ends.append([])
                    self.room.append(0)
                node = self.next[node][letter]
                self.room[node] = max(self.room[node], term.edits)
            self.ends[node].append(number)
        self._forget()

    def _forget(self) -> None:
        self.steps: list[dict[str, int]] = []
        self.parts: list[tuple[tuple[int, int], ...]] = []
        self.word_end: list[tuple[int, int] | None] = []
        self.stem_end: list[tuple[int, int] | None] = []
        self.numbers: dict[tuple, int] = {}
        self.start = self._state({0: 0} if self.terms else {})

    def _state(self, edits: dict[int, int]) -> int:
        """The number of a state, after leaving out letters of terms wherever an edit is left."""
        todo = list(edits)
        while todo:
            node = todo.pop()
            for child in self.next[node].values():
                cost = edits[node] + 1
                if cost <= self.room[child] and cost < edits.get(child, 99):
                    edits[child] = cost
                    todo.append(child)
        parts = tuple(sorted(edits.items()))
        if parts not in self.numbers:
            self.numbers[parts] = len(self.parts)
            self.parts.append(parts)
            self.steps.append({})
            ends = [(e, t) for n, e in parts for t in self.ends[n] if e <= self.terms[t].edits]
            self.word_end.append(min(ends, key=lambda end: (end[0], self.terms[end[1]].is_stem, end[1]), default=None))
            self.stem_end.append(min((end for end in ends if self.terms[end[1]].is_stem), default=None))
        return self.numbers[parts]

    def _step(self, state: int, letter: str) -> int:
        edits: dict[int, int] = {}

        def reach(node: int, cost: int) -> None:
            if cost <= self.room[node] and cost < edits.get(node, 99):
                edits[node] = cost

        for node, cost in self.parts[state]:
            reach(node, cost + 1)  # a letter too many
            for other, child in self.next[node].items():
                reach(child, cost + (other != letter))
        target = self._state(edits)
        self.steps[state][letter] = target
        return target

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, number of the term) of the nearest term, a whole word before a stem, or None."""
        if len(self.parts) > _KNOWN:
            self._forget()
        state, best = self.start, None
        for letter in word:
            following = self.steps[state].get(letter)
            state = self._step(state, letter) if following is None else following
            if not self.parts[state]:
                return best
            stem = self.stem_end[state]
            if stem is not None and (best is None or stem[0] <= best[0]):  # the longest of equals
                best = stem
        end = self.word_end[state]
        return end if end is not None and (best is None or end[0] <= best[0]) else best


@dataclass(frozen=True)
class Model:
    terms: tuple[Term, ...] = ()
    share: float = 0.1  # of neighbourhoods that are in toxic documents, for any word
    quoted: float = 0.3  # strength of a match in a quotation,
    misspelled: float = 0.7  # of a misspelled one
    innocent: frozenset[str] = field(default_factory=frozenset)  # words near a term that clean documents use
    fit: tuple[float, ...] = PRIOR  # constant; weights of the sum, the strongest match, and the log of the length

    def strength(self, term: Term) -> float:
        weight = min(max(term.weight, 0.01), 0.995)
        return max(math.log(weight / (1 - weight)) - math.log(self.share / (1 - self.share)), 0.0)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Reader:
    """Finds and weighs the matches of texts; remembers words it has seen."""

    def __init__(self, model: Model):
        self.model, self.matcher = model, Matcher(model.terms)
        self.seen: set[str] = set()
        self.matched: dict[str, tuple[int, int]] = {}

    def hits(self, text: str) -> list[tuple[str, Term, bool, bool]]:
        """(word, term, misspelled, quoted) of every match."""
        lower = text.lower()
        words = set(_WORD.findall(lower))
        new = words - self.seen
        if len(self.seen) + len(new) > _KNOWN:
            self.seen, self.matched = set(), {}
            new = words
        for word in new:
            found = self.matcher.match(word)
            if found is not None and not (found[0] and word in self.model.innocent):
                self.matched[word] = found
        self.seen |= new
        if self.matched.keys().isdisjoint(words):
            return []
        return self._weigh(lower)

    def _weigh(self, lower: str) -> list[tuple[str, Term, bool, bool]]:
        spans = [(m.group(), m.start(), m.end()) for m in _WORD.finditer(lower)]
        out = []
        for i, (word, start, end) in enumerate(spans):
            found = self.matched.get(word)
            if found is None:
                continue
            around = spans[max(0, i - WINDOW) : i + WINDOW + 1]
            near = {w for w, _, _ in around}
            before, after = lower[around[0][1] : start], lower[end : around[-1][2] + 1]
            enclosed = len(_MARK.findall(before)) % 2 == 1 and _MARK.search(after) is not None
            quoted = (enclosed or not REPORTING.isdisjoint(near)) and ADDRESS.isdisjoint(near)
            out.append((word, self.model.terms[found[1]], found[0] > 0, quoted))
        return out

    def features(self, text: str) -> tuple[tuple[float, float, float, float], list[tuple[str, Term, bool, bool]]]:
        """What the logistic model looks at, and the matches. A word that is met again counts once."""
        found, strongest = self.hits(text), {}
        for word, term, misspelled, quoted in found:
            strength = self.model.strength(term)
            strength *= (self.model.quoted if quoted else 1.0) * (self.model.misspelled if misspelled else 1.0)
            strongest[word] = max(strongest.get(word, 0.0), strength)
        length = math.log1p(text.count(" ") + text.count("\n")) if found else 0.0
        return (1.0, sum(strongest.values()), max(strongest.values(), default=0.0), length), found

    def score(self, text: str) -> tuple[float, int, int, int]:
        """Score, and the numbers of matches, misspelled ones and quoted ones."""
        features, found = self.features(text)
        logit = sum(w * x for w, x in zip(self.model.fit, features, strict=True))
        score = 1.0 / (1.0 + math.exp(-min(max(logit, -30.0), 30.0)))
        return score, len(found), sum(m for _, _, m, _ in found), sum(q for _, _, _, q in found)


def _neighbourhoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, toxic and a hash of the words on both sides, once per batch."""
    for batch in batches:
        found = set()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = ["", *words_of(text), ""]
            for before, word, after in zip(words, words[1:], words[2:]):
                found.add((word, toxic, zlib.crc32(f"{before} {after}".encode())))
        columns = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.int64())],
            names=["word", "toxic", "around"],
        )


def is_held_out(doc_id: Column) -> Column:
    """A quarter of the documents, never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """text and toxic of at most ``limit`` labelled documents that are not held out, chosen by a hash of doc_id."""
    chosen = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    chosen = chosen.select(F.col("doc_id").alias("_labelled"), "toxic")
    # at most ``limit`` rows of two numbers
    rows = docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_labelled"))
    return rows.select("text", "toxic")


def word_table(sample: DataFrame) -> DataFrame:
    """word, bad, good: the number of neighbourhoods of a word in toxic and in other documents."""
    around = sample.mapInArrow(_neighbourhoods, "word string, toxic boolean, around long").distinct()
    return around.groupBy("word").agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good"))


def learned_terms(words: DataFrame) -> tuple[list[Term], float]:
    """The lexicon, and the share of neighbourhoods that are in toxic documents.

    Of each family of words with one beginning the longest that they share is a term.
    """
    total = words.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    if not total["bad"] or not total["good"]:
        return [], 0.0
    share = total["bad"] / (total["bad"] + total["good"])
    length = F.char_length("word")
    begun = words.filter(length >= _SHORTEST).select(
        "word", "bad", "good", F.explode(F.sequence(F.lit(_SHORTEST), F.least(length, F.lit(_LONGEST)))).alias("n")
    )
    both = F.col("bad") + F.col("good")
    ratio = F.col("bad") * F.log(F.col("bad") / (both * share))
    ratio += F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / (both * (1 - share)))).otherwise(0.0)
    # each needs its own few neighbourhoods in the sample, so there are far fewer than the sample has words
    found = (
        begun.groupBy(F.substring("word", F.lit(1), F.col("n")).alias("text"))
        .agg(
            F.sum("bad").alias("bad"),
            F.sum("good").alias("good"),
            F.sum(F.when(F.col("n") == length, F.col("bad")).otherwise(0)).alias("alone"),
        )
        .filter((F.col("bad") >= 2) & (F.col("bad") / both >= 0.8) & (ratio >= _EVIDENCE))
        .collect()
    )
    return _families({r["text"]: (r["bad"], r["good"], r["alone"]) for r in found}), share


def _families(found: dict[str, tuple[int, int, int]]) -> list[Term]:
    roots: set[str] = set()
    longest: dict[str, str] = {}
    for text in sorted(found, key=lambda t: (len(t), t)):
        root = next((text[:n] for n in range(_SHORTEST, len(text)) if text[:n] in roots), text)
        roots.add(root)
        if found[text][0] >= 0.9 * found[root][0]:
            longest[root] = text
    terms = []
    for text in sorted(longest.values()):
        bad, good, alone = found[text]
        is_stem = alone < 0.9 * bad
        terms.append(Term(text, is_stem, bad / (bad + good), allowed_edits(text, is_stem)))
    return terms


def _matching_words(terms: Sequence[Term]):
    """word, bad, good, term and edits of the words that match."""

    def matching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        for batch in batches:
            found = [matcher.match(w) for w in batch.column(0).to_pylist()]
            keep = pa.array([f is not None for f in found])
            columns = [batch.column(i).filter(keep) for i in range(3)]
            columns += [pa.array([f[1 - i] for f in found if f is not None], pa.int64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "bad", "good", "term", "edits"])

    return matching


def _sample_features(model: Model):
    """Of every document of the sample whether it is toxic, the kind of its matches, and its features."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            rows = []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values, hits = reader.features(text)
                kind = 0 if not hits else 1 if any(not m and not q for _, _, m, q in hits) else 2 if any(not q for *_, q in hits) else 3
                rows.append((toxic, kind, *values[1:]))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.bool_(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["toxic", "kind", "total", "top", "length"])

    return features


def _fitted(x: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps, with a pull towards the prior."""
    prior = np.array(PRIOR)
    w = prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (toxic - p) - _TRUST * (w - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + _TRUST * np.eye(len(w))
        step = np.clip(np.linalg.solve(curve, slope), -2, 2)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    w[1:3] = np.maximum(w[1:3], 0.0)  # a match never speaks for a text
    return tuple(w.tolist())


def learned_model(docs: DataFrame, labels: DataFrame, store: Store, limit: int = SAMPLE) -> Model:
    """Lexicon, misspellings to leave alone, and weights, from ``limit`` labelled documents at most."""
    sample = store.scratch(labelled_sample(docs, labels, limit), "labelled")
    words = store.scratch(word_table(sample), "words")
    terms, share = learned_terms(words)
    if not terms:
        return Model()

    kinds = "word string, bad long, good long, term long, edits long"
    matching = words.mapInArrow(_matching_words(terms), kinds).collect()  # words of the sample near a term
    # a word near a term that clean documents use is a word of its own, however many a term has
    near = [r for r in matching if r["edits"] and r["good"]]
    known = {t.text for t in terms if not t.is_stem}
    # a word that begins with a stem has its own share, near the stem's if it is rare
    own = [
        Term(r["word"], False, (r["bad"] + 2 * terms[r["term"]].weight) / (r["bad"] + r["good"] + 2), 0)
        for r in matching
        if not r["edits"] and terms[r["term"]].is_stem and r["word"] not in known
    ]
    prior = Model((*terms, *own), share, innocent=frozenset(r["word"] for r in near))

    def learned(kind: int, value: float, trust: float) -> float:
        toxic = [r["toxic"] for r in seen if r["kind"] == kind]
        return min((sum(toxic) + value * trust) / (len(toxic) + trust), 1.0)

    rows = "toxic boolean, kind long, total double, top double, length double"
    seen = sample.mapInArrow(_sample_features(prior), rows).collect()  # ``limit`` rows of numbers at most
    x = np.array([(1.0, r["total"], r["top"], r["length"]) for r in seen])
    return replace(
        prior,
        quoted=learned(3, prior.quoted, 10),
        misspelled=learned(2, prior.misspelled, 10),
        fit=_fitted(x, np.array([float(r["toxic"]) for r in seen])),
    )


def toxicity_of(text: Column, model: Model) -> Column:
    """Struct of score, matches, misspelled and quoted ones for a text, a null as empty."""

    @F.pandas_udf("score double, n_matches long, n_misspelled long, n_quoted long")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(model)
        for texts in parts:
            yield pd.DataFrame(
                [reader.score(t) for t in texts], columns=["score", "n_matches", "n_misspelled", "n_quoted"]
            )

    return scored(whole(text))


def scored_documents(docs: DataFrame, labels: DataFrame, store: Store, limit: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, n_matches, n_misspelled, n_quoted.

    Only the text is scored. A null or empty text has no match and the score of such a document. Labels with a null
    are not used; of several labels of a document the worst counts. Without labels of both kinds nothing is learned
    and no document is predicted toxic. Rows that repeat are scored each; other columns are not read.
    """
    model = learned_model(docs, labels, store, limit)
    result = docs.select("doc_id", toxicity_of(F.col("text"), model).alias("found"))
    return result.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "found.score",
        (F.col("found.score") >= THRESHOLD).cast("int").alias("predicted"),
        "found.n_matches",
        "found.n_misspelled",
        "found.n_quoted",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, store: Store, limit: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    model = learned_model(docs, labels, store, limit)
    return docs.filter(toxicity_of(docs["text"], model)["score"] < THRESHOLD)
