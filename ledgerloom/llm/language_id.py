"""Language identification by interpolated Kneser-Ney models of characters.

Each language has a model of the runs of up to ``ORDER`` characters of its training texts: counts of the longest
runs, continuation counts (distinct characters before a run) of the shorter ones, absolute discounts estimated from
those counts. A model is a few sorted arrays of run hashes beside arrays of numbers, looked up by binary search. A
text belongs to the language whose model needs the fewest bits a character. The best one is rejected if it needs more
bits than documents of that language do: the bound, and the sharpness of the score, are calibrated on documents of the
sample that no model has learned from.

Only letters count, in lower case; a run of other characters is one gap. Models come from a bounded sample of labelled
texts (``SAMPLE_CHARS``), whole ones; all documents are scored, whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import arrays
from ledgerloom.llm.words import whole
from ledgerloom.sources.store import Store

ORDER = 4  # characters of the longest runs
SAMPLE_CHARS = 2_000_000  # characters models learn from, over all languages: 7 arrays of 12 bytes each at most
CALIBRATION = 5  # one of so many documents of the sample calibrates
BROADCAST = 1 << 16  # languages whose sizes are broadcast
TAIL = 0.005  # share of a language's own documents beyond the bound of rejection
_DEVIATIONS = 4  # the bound is at least so many standard deviations above the mean
UNKNOWN = "und"
_PIECE = 1 << 20  # bytes of text that are scored together, about
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


# characters


@cache
def _characters() -> np.ndarray:
    """For each code point the lower-case letter it stands for, 0 if it is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts, with a gap (0) after each run of them, and the length of each text. Without letters it is 0."""
    data, offsets = arrays.text_bytes(texts)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    begins = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][offsets]  # in characters
    # a gap after each text
    letters = np.insert(_characters()[points], begins[1:], 0)
    begins = begins + np.arange(len(begins))
    gap = letters == 0
    kept = ~gap | ~np.r_[True, gap[:-1]]  # of gaps in a row the first; none at the very start
    lengths = np.diff(np.r_[0, np.cumsum(kept)][begins])
    letters = letters[kept]
    # texts of nothing but gaps: their gap went with the gap before, or opens the array
    ends = np.cumsum(lengths)
    empty = (lengths == 1) & (letters[ends - 1] == 0) if len(letters) else lengths == 1
    keep = np.ones(len(letters), dtype=bool)
    keep[ends[empty] - 1] = False
    return letters[keep], np.where(empty, 0, lengths)


def _places(lengths: np.ndarray) -> np.ndarray:
    """The place of each character in its text."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _runs(letters: np.ndarray, places: np.ndarray, order: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
    """Hashes of the ``order`` characters that end at each place in ``at``; what comes before a text are gaps."""
    ends = np.arange(len(letters))[at]
    places = places[at]
    total = np.zeros(len(ends), dtype=_U)
    for back in range(order - 1, -1, -1):
        c = letters[np.maximum(ends - back, 0)]
        if back:
            c = np.where(places >= back, c, 0)
        total = total * _STEP + (c.astype(_U) + _U(1))
    return total


# models


@dataclass(frozen=True)
class Level:
    """Runs of one length: the discounted share of the last character after those before, and the weight left to shorter runs."""

    runs: np.ndarray
    shares: np.ndarray
    contexts: np.ndarray
    rests: np.ndarray


@dataclass(frozen=True)
class Model:
    levels: tuple[Level, ...]  # runs of 1, 2, .. characters
    floor: float  # share of a character that was never met


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), otherwise)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], otherwise)


def learned(letters: np.ndarray, lengths: np.ndarray, order: int = ORDER, alphabet: int = 0) -> Model:
    """The Kneser-Ney model of some texts. ``alphabet`` is how many characters there are at least."""
    places = _places(lengths)
    of_length = {n: _runs(letters, places, n) for n in range(1, order + 1)}
    levels: list[Level] = []
    floor = 1.0
    for n in range(1, order + 1):
        if n == order:
            runs, first, counts = np.unique(of_length[n], return_index=True, return_counts=True)
        else:  # each distinct longer run counts once for the run at its end
            _, at = np.unique(of_length[n + 1], return_index=True)
            runs, place, counts = np.unique(of_length[n][at], return_index=True, return_counts=True)
            first = at[place]
        # what precedes the last character: the run less that character
        context = of_length[n][first] - (letters[first].astype(_U) + _U(1))
        contexts, of = np.unique(context, return_inverse=True)
        once, twice = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
        discount = once / (once + 2 * twice) if once else 0.5
        total = np.bincount(of, weights=counts, minlength=len(contexts))
        kinds = np.bincount(of, minlength=len(contexts))
        levels.append(
            Level(runs, ((counts - discount) / total[of]).astype(np.float32), contexts, (discount * kinds / total).astype(np.float32))
        )
        if n == 1:
            size = max(alphabet, len(runs) + 1)
            floor = float(discount * kinds[0] / total[0] / size) if len(runs) else 1.0 / size
    return Model(tuple(levels), max(floor, 1e-12))


def _bits(model: Model, runs: Sequence[np.ndarray], last: np.ndarray) -> np.ndarray:
    """Bits of the last character of each run of ORDER characters; ``runs`` are its ends of 1, 2, .. characters."""
    share = np.full(len(last), model.floor)
    for n, level in enumerate(model.levels, 1):
        own = _looked_up(level.runs, level.shares, runs[n - 1], 0.0)
        if n == 1:
            share = own + share  # the floor holds the weight that is left
        else:
            # a context that was never met leaves all to shorter runs
            share = own + _looked_up(level.contexts, level.rests, runs[n - 1] - (last + _U(1)), 1.0) * share
    return -np.log2(share)


def cross_entropies(models: Sequence[Model], letters: np.ndarray, lengths: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Bits a character of each text (rows) under each model; texts without letters have 0."""
    out = np.zeros((len(lengths), len(models)))
    if not len(letters):
        return out
    # equal runs cost the same: each distinct one is looked up once
    places = _places(lengths)
    runs = _runs(letters, places, order)
    distinct = np.unique(runs)
    again = np.searchsorted(distinct, runs)
    first = np.zeros(len(distinct), dtype=np.int64)
    first[again] = np.arange(len(runs))  # any place of each
    shorter = [_runs(letters, places, n, first) for n in range(1, order)] + [distinct]
    last = letters[first].astype(_U)
    edge = np.r_[0, np.cumsum(lengths)]
    for m, model in enumerate(models):
        sums = np.r_[0.0, np.cumsum(_bits(model, shorter, last)[again])]
        out[:, m] = (sums[edge[1:]] - sums[edge[:-1]]) / np.maximum(lengths, 1)
    return out


# the sample


def is_held_out(doc_id: Column) -> Column:
    """Rows a model may not learn from: crc32(doc_id as text) mod 4 is 2. A null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, store: Store, chars: int = SAMPLE_CHARS) -> DataFrame:
    """lang, text, calibrates: distinct labelled texts, about ``chars`` characters in all, as many of each language.

    Written. Texts are chosen by their hashes; a language has one text at least, if that is longer than its part.
    """
    told = docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(~is_held_out(F.col("doc_id")))
    told = told.select("lang", "text", F.length("text").cast("long").alias("n"), F.xxhash64("text").alias("h"))
    sizes = store.scratch(told.groupBy("lang").agg(F.sum("n").alias("all")), "sizes")
    n_languages = sizes.count()
    if n_languages <= BROADCAST:  # so that the texts need not be shuffled to meet them
        sizes = F.broadcast(sizes)
    part = chars / max(n_languages, 1)
    # about twice what is needed, by hash, before anything is shuffled; copies of a text share a hash and meet map-side
    near = told.join(sizes, "lang").filter(F.pmod("h", F.lit(1 << 20)) < F.lit(2 * part * (1 << 20)) / F.greatest("all", F.lit(1)) + 1)
    chosen = near.groupBy("lang", "h", "n").agg(F.first("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 20)), "h").rowsBetween(Window.unboundedPreceding, -1)
    chosen = chosen.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).filter(F.col("before") < part)
    calibrates = F.pmod(F.shiftright("h", 20), F.lit(CALIBRATION)) == 0
    return store.scratch(chosen.select("lang", "text", calibrates.alias("calibrates")), "labelled")


_MODEL_KINDS = "lang string, level int, runs binary, shares binary, contexts binary, rests binary, floor double"


def _learned_table(order: int):
    def learn(table: pa.Table) -> pa.Table:
        model = learned(*_letters(table.column("text").combine_chunks()), order)
        rows = [
            (table.column("lang")[0].as_py(), n, *(a.tobytes() for a in (v.runs, v.shares, v.contexts, v.rests)), model.floor)
            for n, v in enumerate(model.levels, 1)
        ]
        names = [k.split()[0] for k in _MODEL_KINDS.split(", ")]
        kinds = [pa.string(), pa.int32(), *[pa.binary()] * 4, pa.float64()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)

    return learn


@dataclass(frozen=True)
class Identifier:
    """Models of languages in the order of their names, the bits from which a language is rejected, and the sharpness."""

    languages: tuple[str, ...] = ()
    models: tuple[Model, ...] = ()
    bounds: tuple[float, ...] = ()
    sharpness: float = 1.0

    def best(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For rows of bits: the number of the best language, its share of the scores of all, and whether it is rejected."""
        if not self.languages:
            return np.zeros(len(bits), dtype=np.int64), np.zeros(len(bits)), np.ones(len(bits), dtype=bool)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(bits)), best]
        score = 1.0 / np.exp2(-self.sharpness * (bits - least[:, None])).sum(axis=1)
        return best, score, least > np.array(self.bounds)[best]


def _calibrated(bits: np.ndarray, own: np.ndarray, languages: int) -> tuple[tuple[float, ...], float]:
    """The bound of each language and the sharpness, from bits of documents whose language is known."""
    bounds = []
    for i in range(languages):
        mine = bits[own == i, i]
        # few documents say little about the tail, their mean and deviation more
        tail = (np.quantile(mine, 1 - TAIL), mine.mean() + _DEVIATIONS * mine.std()) if len(mine) else (np.inf,)
        bounds.append(float(max(tail)))
    if not len(bits):
        return tuple(bounds), 1.0
    excess = bits - bits[np.arange(len(bits)), own][:, None]
    tried = 2.0 ** np.arange(-2, 6.5, 0.5)
    # a document more in which each language is as likely keeps the sharpness finite
    loss = [np.log(np.exp2(np.clip(-s * excess, -60, 60)).sum(axis=1)).sum() + s * 0.01 * len(bits) for s in tried]
    return tuple(bounds), float(tried[int(np.argmin(loss))])


def learned_identifier(docs: DataFrame, store: Store, chars: int = SAMPLE_CHARS, order: int = ORDER) -> Identifier:
    """The identifier of the languages of the documents that are not held out."""
    sample = labelled_sample(docs, store, chars)
    used = Window.partitionBy("lang")
    # a language with few texts learns from all of them and calibrates with none
    few = F.count("*").over(used) < 2 * CALIBRATION
    sample = sample.withColumn("calibrates", F.col("calibrates") & ~few)
    table = sample.filter("NOT calibrates").groupBy("lang").applyInArrow(_learned_table(order), _MODEL_KINDS)
    found: dict[str, list] = {}
    for r in table.orderBy("lang", "level").collect():  # the sample bounds it
        level = Level(*(np.frombuffer(r[c], dtype=k) for c, k in (("runs", _U), ("shares", np.float32), ("contexts", _U), ("rests", np.float32))))
        found.setdefault(r["lang"], []).append((level, r["floor"]))
    names = tuple(found)
    models = tuple(Model(tuple(v for v, _ in found[n]), found[n][0][1]) for n in names)
    if not names:
        return Identifier()
    part = Identifier(names, models, (np.inf,) * len(names))
    tested = sample.filter("calibrates").select("lang", "text").mapInArrow(_sample_bits(part, order), "lang string, bits array<double>").collect()
    own = np.array([names.index(r["lang"]) for r in tested], dtype=np.int64)
    bits = np.array([r["bits"] for r in tested]).reshape(len(tested), len(names))
    return Identifier(names, models, *_calibrated(bits, own, len(names)))


def _sample_bits(identifier: Identifier, order: int):
    def sample_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, lengths = _letters(batch.column(1))
            bits = cross_entropies(identifier.models, letters, lengths, order)
            some = lengths > 0
            lists = pa.array([b.tolist() for b in bits[some]], pa.list_(pa.float64()))
            known = batch.column(0).filter(pa.array(some & np.isin(batch.column(0).to_pylist(), identifier.languages)))
            yield pa.RecordBatch.from_arrays([known, lists], names=["lang", "bits"])

    return sample_bits


# documents


def identified(docs: DataFrame, store: Store, chars: int = SAMPLE_CHARS, order: int = ORDER) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, bits, rejected.

    Only the text is looked at. ``score`` is the best language's share of 2^(-sharpness * bits) over all languages.
    ``rejected`` says that the text needs more bits a character than texts of its best language do; whoever wants
    rejected texts to have no language reads ``lang_pred`` only where it is false. A text that is null, empty or without
    letters is ``und`` with score 0, bits 0 and rejected; so is every text if there is nothing to learn from. Rows that
    repeat are scored each; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learned_identifier(docs, store, chars, order))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = shared.value
        names = pa.array([*identifier.languages, UNKNOWN], pa.string())
        for batch in batches:
            for part in arrays.pieces(batch, 2, _PIECE):
                letters, lengths = _letters(part.column(2))
                bits = cross_entropies(identifier.models, letters, lengths, order)
                best, score, rejected = identifier.best(bits)
                none = (lengths == 0) | (not identifier.languages)
                best = np.where(none, len(names) - 1, best)
                least = bits.min(axis=1, initial=np.inf) if bits.shape[1] else np.zeros(len(bits))
                columns = [*part.columns[:2], names.take(pa.array(best)), *(pa.array(c, pa.float64()) for c in (np.where(none, 0.0, score), np.where(none, 0.0, least))), pa.array(rejected | none)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score", "bits", "rejected"])

    rows = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), whole("text").alias("text"))
    return rows.mapInArrow(identify, f"doc_id {kind}, held_out boolean, lang_pred string, score double, bits double, rejected boolean")
