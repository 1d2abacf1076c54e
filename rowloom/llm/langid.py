"""Language of every word by a linear-chain conditional random field.

A word's features are its prefixes and suffixes, the n-grams of its letters and its place in a lexicon of the words met in
training; each has a learned weight for each language, and so has the step from one word's language to the next one's.
Forward-backward over a text's words gives each word its probabilities in its context, so a text that switches languages
is labelled word by word; a text's language is the one with the greatest mean probability.

A long text is cut into lanes. The product of a lane's steps is a small matrix, so the vectors that enter each lane
from before and behind follow from one short pass over lanes, and all lanes of all texts are then walked side by side.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.batches import sliced
from rowloom.llm.wordbpe import LETTERS, PLAIN

#: Fitting: languages at most (the most frequent ones), documents in all, words of a document (a run of them from a place
#: that its id settles). All else covers every document and whole texts.
LANGUAGES, SAMPLE, SAMPLE_WORDS = 256, 800, 100
#: Mean length of the pieces that training texts are spliced from, so that steps between languages are learned.
PIECE = 24
#: Hashed features.
FEATURES = 1 << 15
#: Code points of a word at most; a longer run of letters is several words.
LONGEST = 24
#: Words of a lane; numbers (words x languages) of a group of lanes; distinct words that a worker keeps weights of.
LANE, GROUP, KEPT = 128, 1 << 20, 150_000
#: Code points of a text that are split at once, and words that are looked up at once.
SECTION, LOOKED_UP = 1 << 20, 100_000

_PLAIN_WORD = re.compile(f"[{LETTERS}]{{1,{LONGEST}}}")
_WORD = regex.compile(rf"\p{{L}}[\p{{L}}\p{{M}}]{{0,{LONGEST - 1}}}")
_OPEN, _CLOSE = "\x02", "\x03"


def _sections(text: str) -> Iterator[tuple[int, int]]:
    """Bounds of parts of about SECTION code points that end before a blank, or with the text."""
    start = 0
    while start < len(text):
        end = start + SECTION
        while end < len(text) and not text[end].isspace():
            end += 1
        yield start, min(end, len(text))
        start = end


def words_of(text: str) -> Iterator[list[str]]:
    """The words of a text, runs of letters and of marks after them, in bounded parts."""
    for start, end in _sections(text):
        part = text if end - start == len(text) else text[start:end]
        yield _WORD.findall(part) if PLAIN.search(part) else _PLAIN_WORD.findall(part)


def word_spans(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) in code points of the words of words_of."""
    for start, end in _sections(text):
        pattern = _WORD if PLAIN.search(text, start, end) else _PLAIN_WORD
        for found in pattern.finditer(text, start, end):
            yield found.span()


def _hash(kind: int, *points: np.ndarray) -> np.ndarray:
    """A number below FEATURES for each row of code points."""
    h = np.full(len(points[0]), kind * 0x9E3779B1 + 1, np.uint64)
    for point in points:
        h = (h ^ point.astype(np.uint64)) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(40)).astype(np.int64) % FEATURES


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature, number of its word) of all affixes of up to four letters and all n-grams of up to three."""
    text = _OPEN + (_CLOSE + _OPEN).join(words).lower() + _CLOSE
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    begin, end = np.flatnonzero(points == ord(_OPEN)) + 1, np.flatnonzero(points == ord(_CLOSE))
    number = np.repeat(np.arange(len(begin)), end - begin)
    at = np.arange(len(number)) + np.repeat(begin - (np.cumsum(end - begin) - (end - begin)), end - begin)
    found, left = [], end[number] - at
    with np.errstate(over="ignore"):
        for n in (1, 2, 3):
            ok = left >= n
            found.append((_hash(n, *(points[at[ok] + i] for i in range(n))), number[ok]))
        for n in (1, 2, 3, 4):
            ok = np.flatnonzero(end - begin >= n)
            found.append((_hash(10 + n, *(points[begin[ok] + i] for i in range(n))), ok))
            found.append((_hash(20 + n, *(points[end[ok] - 1 - i] for i in range(n))), ok))
    return tuple(map(np.concatenate, zip(*found)))


def by_word(feature: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features in order of their words, where each word's begin); every word has some."""
    order = np.argsort(number, kind="stable")
    return feature[order], np.flatnonzero(np.diff(number[order], prepend=-1))


@dataclass
class Crf:
    """Weights of the hashed features (rows; one column a language), of the words of the lexicon, of the first word's
    language, and of the steps from one to the next."""

    languages: list[str]
    weights: np.ndarray
    lexicon: dict[str, int] = field(default_factory=dict)
    lexical: np.ndarray = None
    start: np.ndarray = None
    step: np.ndarray = None

    def emissions(self, words: list[str]) -> np.ndarray:
        """What each word's features add up to for each language."""
        out = np.zeros((len(words), len(self.languages)))
        for a in range(0, len(words), 10_000):
            feature, starts = by_word(*features(words[a : a + 10_000]))
            out[a : a + 10_000] = np.add.reduceat(self.weights[feature], starts, axis=0)
        known = [(i, self.lexicon[word]) for i, word in enumerate(map(str.lower, words)) if word in self.lexicon]
        if known:
            at, row = np.array(known).T
            out[at] += self.lexical[row]
        return out


def potentials(emissions: np.ndarray) -> np.ndarray:
    """exp of the emissions, the greatest of each word being one."""
    return np.exp(np.maximum(emissions - emissions.max(axis=1, keepdims=True), -60))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


class Lanes:
    """Texts of the given numbers of words as lanes of at most `lane` words."""

    def __init__(self, sizes: np.ndarray, lane: int = LANE):
        pieces = -(-sizes // lane)
        self.text = np.repeat(np.arange(len(sizes)), pieces)
        self.number = np.arange(len(self.text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.begin = np.repeat(np.cumsum(sizes) - sizes, pieces) + self.number * lane
        self.size = np.minimum(lane, sizes[self.text] - self.number * lane)
        self.last = self.number == pieces[self.text] - 1


def _walk(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lanes, longest first; how many of them have a word t, for each t)."""
    order = np.argsort(-size, kind="stable")
    return order, np.searchsorted(-size[order], -np.arange(int(size.max())), side="left")


def entries(ids: np.ndarray, potential: np.ndarray, lanes: Lanes, start: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each lane the vector that enters it from the lane before (of no use where it is the first) and the one from
    behind (ones where it is the last)."""
    n = len(start)
    entry, behind = np.full((len(lanes.size), n), 1.0 / n), np.full((len(lanes.size), n), 1.0 / n)
    long = np.flatnonzero(~(lanes.last & (lanes.number == 0)))
    product = np.empty((len(lanes.size), n, n)) if len(long) else None
    for a in range(0, len(long), max(1, GROUP // (n * n))):
        group = long[a : a + max(1, GROUP // (n * n))]
        order, active = _walk(lanes.size[group])
        group = group[order]
        x = np.broadcast_to(np.eye(n), (len(group), n, n)).copy()
        for t, m in enumerate(active.tolist()):
            e = potential[ids[lanes.begin[group[:m]] + t]]
            x[:m] = (x[:m] @ step) * e[:, None, :]
            if t == 0:
                first = lanes.number[group[:m]] == 0
                x[:m][first] = (start * e[first])[:, None, :]
            x[:m] /= x[:m].max(axis=(1, 2), keepdims=True)
        product[group] = x
    for number in range(1, int(lanes.number.max(initial=0)) + 1):
        here = np.flatnonzero(lanes.number == number) if number == 1 else here[~lanes.last[here]] + 1  # a text's lanes follow each other
        before = here - 1
        entry[here] = _unit(product[before, 0] if number == 1 else np.einsum("bi,bij->bj", entry[before], product[before]))
    here = np.flatnonzero(lanes.last & (lanes.number > 0)) - 1
    while len(here):
        behind[here] = _unit(np.einsum("bij,bj->bi", product[here + 1], behind[here + 1]))
        here = here[lanes.number[here] > 0] - 1
    return entry, behind


def sweep(ids: np.ndarray, potential: np.ndarray, begin: np.ndarray, size: np.ndarray, first: np.ndarray, entry: np.ndarray, behind: np.ndarray, start: np.ndarray, step: np.ndarray, pairs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(place of each word in ids, its probabilities) of some lanes, by forward and backward. pairs: gets the expected
    numbers of steps between languages added, within lanes."""
    order, active = _walk(size)
    begin, size, first, entry, b = begin[order], size[order], first[order], entry[order], behind[order].copy()
    offset = np.cumsum(size) - size
    probability = np.empty((int(size.sum()), len(start)))
    a = None
    for t, m in enumerate(active.tolist()):
        e = potential[ids[begin[:m] + t]]
        a = _unit(np.where(first[:, None], start, entry @ step) * e if t == 0 else (a[:m] @ step) * e)
        probability[offset[:m] + t] = a
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at = offset[:m] + t
        q = potential[ids[begin[:m] + t]] * b[:m]
        probability[at] = _unit(probability[at] * b[:m])
        if pairs is not None and t:
            before = probability[at - 1]
            pairs += step * (before.T @ (q / ((before @ step) * q).sum(axis=1, keepdims=True)))
        b[:m] = _unit(q @ step.T)
    place = np.arange(len(probability)) + np.repeat(begin - offset, size)
    return place, probability


def posteriors(ids: np.ndarray, potential: np.ndarray, sizes: np.ndarray, start: np.ndarray, step: np.ndarray, lane: int = LANE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place in ids, probabilities) of the words of texts, a group of lanes at a time. ids: a row of `potential`
    for each word, texts one after the other; sizes: their numbers of words."""
    lanes = Lanes(sizes, lane)
    if not len(lanes.size):
        return
    entry, behind = entries(ids, potential, lanes, start, step)
    most = max(1, GROUP // (lane * len(start)))
    for a in range(0, len(lanes.size), most):
        part = slice(a, a + most)
        place, probability = sweep(ids, potential, lanes.begin[part], lanes.size[part], lanes.number[part] == 0, entry[part], behind[part], start, step)
        yield np.searchsorted(np.cumsum(sizes), place, side="right"), place, probability


def fit(samples: list[tuple[str, list[str]]], rounds: int = 30, rate: float = 0.4, decay: float = 1e-3, seed: int = 0) -> Crf:
    """A field learned from (language, words) by AdaGrad on the likelihood of whole chains. Chains are spliced from pieces of
    samples in an order drawn from `seed`."""
    samples = [(language, words) for language, words in samples if words]
    languages = sorted({language for language, _ in samples})
    n, rng = len(languages), np.random.default_rng(seed)
    model = Crf(languages, np.zeros((FEATURES, n)), {}, np.zeros((0, n)), np.ones(n), np.ones((n, n)))
    if not samples:
        return model
    pieces = []
    for language, words in samples:
        at = 0
        while at < len(words):
            size = int(rng.geometric(1 / PIECE))
            pieces.append((languages.index(language), words[at : at + size]))
            at += size
    pieces = [pieces[i] for i in rng.permutation(len(pieces))]
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(word.lower(), len(number)) for _, words in pieces for word in words], np.int64)
    truth = np.repeat([label for label, _ in pieces], [len(words) for _, words in pieces])
    vocabulary, v = list(number), len(number)
    model.lexicon, model.lexical = number, np.zeros((v, n))
    feature, owner = features(vocabulary)
    of_words, starts = by_word(feature, owner)
    order = np.argsort(feature, kind="stable")
    feature, owner = feature[order], owner[order]
    used, firsts = np.unique(feature, return_index=True)
    chains = Lanes(np.array([len(ids)]), LANE)  # each lane is a chain of its own here
    size, begin = chains.size, chains.begin
    ones = np.full((len(size), n), 1.0 / n)
    observed = np.zeros((v, n))
    np.add.at(observed, (ids, truth), 1)
    seen_start = np.bincount(truth[begin], minlength=n)
    inner = np.ones(len(ids), bool)
    inner[begin] = False
    seen_step = np.zeros((n, n))
    np.add.at(seen_step, (truth[:-1][inner[1:]], truth[1:][inner[1:]]), 1)
    start, step = np.zeros(n), np.zeros((n, n))
    squares = [np.full(x.shape, 1e-12) for x in (model.weights[used], model.lexical, start, step)]
    for _ in range(rounds):
        potential = potentials(np.add.reduceat(model.weights[of_words], starts, axis=0) + model.lexical)
        pairs = np.zeros((n, n))
        place, p = sweep(ids, potential, begin, size, np.ones(len(size), bool), ones, ones, np.exp(start), np.exp(step), pairs)
        expected = np.stack([np.bincount(ids[place], p[:, i], v) for i in range(n)], axis=1)
        missed = (observed - expected) / len(ids)
        first = place[np.isin(place, begin)]
        expected_start = p[np.isin(place, begin)].sum(axis=0) if len(first) else 0
        slopes = [np.add.reduceat(missed[owner], firsts, axis=0) - decay * model.weights[used] / len(used), missed - decay * model.lexical / v,
                  (seen_start - expected_start) / len(ids), (seen_step - pairs) / len(ids)]
        moves = []
        for square, slope in zip(squares, slopes):
            square += slope**2
            moves.append(rate * slope / np.sqrt(square))
        model.weights[used] += moves[0]
        model.lexical += moves[1]
        start, step = start + moves[2], step + moves[3]
    model.start, model.step = np.exp(start - start.max()), np.exp(step - step.max())
    return model


def held_out(doc_id: str) -> Column:
    """Rows that are kept from fitting: crc32 of the id's decimal text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE, sample_words: int = SAMPLE_WORDS) -> Crf:
    """A field fitted on about `sample` documents, as many of each language, and `sample_words` words of each. Rows that
    are held out or lack language or id are never read."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return fit([])
    each = max(1, sample // len(counts))
    # a hash below its language's bound: some twice `each` rows, of which `each` are taken; a row a language is broadcast
    bounds = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, 2 * each / r["n"])) for r in counts], "lang string, _share double")
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    drawn = known.select("doc_id", F.col("lang").cast("string").alias("lang"), "text", spot.alias("_spot")).join(F.broadcast(bounds), "lang").where(F.col("_spot") < F.col("_share") * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            kept = []
            for spot, text in zip(batch.column("spot").to_pylist(), batch.column("text").to_pylist()):
                words = [word for part in words_of(text or "") for word in part]
                at = spot % max(1, len(words) - sample_words + 1)
                kept.append(words[at : at + sample_words])
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("spot"), pa.array(kept, pa.list_(pa.string()))], ["lang", "spot", "words"])

    rows = drawn.select("lang", F.col("_spot").alias("spot"), "text").mapInArrow(run, "lang string, spot long, words array<string>").where(F.size("words") > 0)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("spot", "words"))
    found = rows.withColumn("nth", nth).where(F.col("nth") <= each).orderBy("lang", "nth").collect()
    return fit([(row["lang"], list(row["words"])) for row in found])


class Labeller:
    """Labels texts by a field; keeps potentials of the words that it has met."""

    def __init__(self, model: Crf):
        self.model, self.known, self.potential = model, {}, np.zeros((0, len(model.languages)))

    def rows(self, words: list[str]) -> np.ndarray:
        """The row of `potential` of each word."""
        known = self.known
        new = list({word for word in words if word not in known})
        if new:
            if len(known) + len(new) > KEPT:
                raise OverflowError
            if len(known) + len(new) > len(self.potential):
                self.potential = np.concatenate([self.potential, np.zeros((max(len(new), len(self.potential), 4096), len(self.model.languages)))])
            self.potential[len(known) : len(known) + len(new)] = potentials(self.model.emissions(new))
            known.update(zip(new, range(len(known), len(known) + len(new))))
        return np.fromiter(map(known.__getitem__, words), np.int32, len(words))

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(a row for each word of the texts, their numbers of words)."""
        for _ in range(2):
            try:
                found, sizes, pending = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64), []
                for number, text in enumerate(texts):
                    for part in words_of(text):
                        pending += part
                        sizes[number] += len(part)
                        if len(pending) >= LOOKED_UP:
                            found.append(self.rows(pending))
                            pending = []
                return np.concatenate([*found, self.rows(pending)]), sizes
            except OverflowError:  # begin anew
                self.known, self.potential = {}, self.potential[:0]
        # more distinct words in these texts than are kept otherwise
        number: dict[str, int] = {}
        found = [np.fromiter((number.setdefault(word, len(number)) for part in words_of(text) for word in part), np.int32) for text in texts]
        self.potential = potentials(self.model.emissions(list(number)))
        return np.concatenate(found), np.array(list(map(len, found)), np.int64)

    def labels(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of words, best language's number, its mean probability) of each text; -1 and 0 without a word."""
        n = len(self.model.languages)
        if not n:
            return np.zeros(len(texts), np.int64), np.full(len(texts), -1), np.zeros(len(texts))
        ids, sizes = self.ids(texts)
        total = np.zeros((len(texts), n))
        for text, _, probability in posteriors(ids, self.potential, sizes, self.model.start, self.model.step):
            for i in range(n):
                total[:, i] += np.bincount(text, probability[:, i], len(texts))
        best = total.argmax(axis=1)
        score = total[np.arange(len(texts)), best] / np.maximum(sizes, 1)
        return sizes, np.where(sizes > 0, best, -1), np.minimum(score, 1.0)

    def runs(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, language, mean probability) of the runs of words of one language, in code points."""
        if not self.model.languages:
            return []
        ids, sizes = self.ids([text])
        best, sure = np.zeros(len(ids), np.int64), np.zeros(len(ids))
        for _, place, probability in posteriors(ids, self.potential, sizes, self.model.start, self.model.step):
            best[place], sure[place] = probability.argmax(axis=1), probability.max(axis=1)
        spans = np.array(list(word_spans(text)), np.int64).reshape(-1, 2)
        firsts = np.flatnonzero(np.diff(best, prepend=-1))
        return [(int(spans[a, 0]), int(spans[b - 1, 1]), self.model.languages[best[a]], float(sure[a:b].mean())) for a, b in zip(firsts, [*firsts[1:], len(best)])]


@lru_cache(maxsize=1)
def _labeller(shared) -> Labeller:
    """One in a worker, kept from task to task."""
    return Labeller(shared.value)


def languages(docs: DataFrame, model: Crf | None = None) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score (mean probability of that language over the words),
    n_words. Without a model one is fitted on docs (see `train`).

    `und` with score 0 where a text is null or has no letter, or where nothing could be learned. A null doc_id is not held
    out and not learned from; repeated rows stay repeated; ties go to the language that comes first in the alphabet. An
    empty table gives an empty result. Only the text goes into a prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _labeller(shared)
        names = np.array([*own.model.languages, "und"], object)
        for batch in sliced(batches, 256):
            n, best, score = own.labels([text or "" for text in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score), pa.array(n)], ["doc_id", "lang_pred", "score", "n_words"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, n_words long")
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "n_words")


def language_runs(docs: DataFrame, model: Crf | None = None) -> DataFrame:
    """One row per run of words of one language: doc_id, run (from 0), start, end (code points), lang, score. Texts
    without a letter have none. The field is as of `languages`."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _labeller(shared)
        for batch in sliced(batches, 64):
            found = [own.runs(text or "") for text in batch.column("text").to_pylist()]
            take = pa.array(np.repeat(np.arange(batch.num_rows), list(map(len, found))))
            start, end, lang, score = zip(*(x for runs in found for x in runs)) if any(found) else ((), (), (), ())
            number = [i for runs in found for i in range(len(runs))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "run", "start", "end", "lang", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, run int, start long, end long, lang string, score double")
