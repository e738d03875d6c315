"""Toxicity: a support vector machine on a gap-weighted subsequence kernel, with Nyström landmarks.

Two words are similar when they share subsequences of three characters; each occurrence weighs ``decay`` to the power
of its span, so letters may be dropped between or inserted into an insult. Landmark words give the Nyström features
``k(s, landmarks) K^-1/2`` on which a linear machine is trained. The kernel has a finite feature space (hashed
subsequences), so the machine folds into one weight per subsequence, and scoring a word costs its own subsequences, not
the number of landmarks.

Only documents carry labels, so the words that make one toxic are found first (multiple-instance learning): of the
words that toxic documents have and clean ones lack, a greedy cover takes those that explain most documents not yet
explained. They are the positive examples; a word that merely shares its documents with an insult, as in copies of one
text, explains nothing more and is neither positive nor negative. Words of clean documents are the negative examples, with
those that a first machine takes for insults added for a second. A document's score is a logistic function of its
largest word margins and of how many words lie above zero. Labels, language, source and id are never inputs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrade.llm.shared import share
from lexigrade.llm.words import SPACE, Hasher, mix, shingles
from lexigrade.session import write_stage

#: Characters that stand for letters.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
SPELT = re.compile(r"(?<!\w)\w(?:[^\w\s]*[\s._*-]\w(?!\w)){3,}")
NOT_WORD = re.compile(r"[\W_]+")
BITS = 20
#: About so much text is split into words at once.
PART_BYTES = 1 << 22
#: Characters of words that are scored at once, and places of subsequences within them.
BLOCK_CHARS, SLICE_CHARS = 1 << 20, 1 << 17
#: Longer words are scored like all others but teach nothing.
LEARNT_CHARS = 200


class ToxicParams(NamedTuple):
    sample: int = 20_000
    """Labelled documents that are used for learning at most; those of smallest id hash."""
    candidates: int = 2_000
    """Words of strongest evidence among which the cover chooses."""
    witnesses: int = 3
    """Chosen words that explain a toxic document."""
    support: int = 3
    """Unexplained documents that a chosen word must explain at least."""
    negatives: int = 6_000
    hard: int = 2_000
    """Negative words of largest margin that are added for the second machine."""
    landmarks: int = 256
    span: int = 6
    decay: float = 0.6
    c: float = 1.0
    evidence: float = 10.0
    share: float = 0.8
    folds: int = 3


def units(text: str | None) -> list[str]:
    """Lower-cased words without inner punctuation; letters spelt one by one are one word."""
    if not text:
        return []
    text = SPELT.sub(lambda m: NOT_WORD.sub("", m[0]), text.lower())
    out = []
    for word in text.split():
        if not word.isalpha():
            word = NOT_WORD.sub("", word)
            if not word.isalpha():
                word = "" if word.isdigit() else word.translate(LOOKALIKE)
        if len(word) > 2:
            out.append(word)
    return out


class Subsequences(NamedTuple):
    word: np.ndarray
    feature: np.ndarray
    weight: np.ndarray


def laid(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all words, edges marked; word and end of word of each."""
    flat = "".join(f"\x02{w}\x03" for w in words)
    codes = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    return codes, np.repeat(np.arange(len(words)), lengths), np.repeat(np.cumsum(lengths), lengths)


def hashed(codes: np.ndarray, at: np.ndarray, b: int, c: int) -> np.ndarray:
    """Features of the subsequences of the characters at, b and c places on."""
    key = (codes[at] << np.uint64(42)) ^ (codes[at + b] << np.uint64(21)) ^ codes[at + c]
    return (mix(key) >> np.uint64(64 - BITS)).astype(np.int64)


def subsequences(words: list[str], params: ToxicParams) -> Subsequences:
    """Hashed three-character subsequences of every word, scaled to norm one."""
    codes, owner, end = laid(words)
    at = np.arange(len(codes))
    parts = []
    for c in range(2, params.span):
        ok = np.flatnonzero(at + c < end)
        for b in range(1, c):
            parts.append((owner[ok], hashed(codes, ok, b, c), np.full(len(ok), params.decay ** (c + 1))))
    word, feature, weight = (np.concatenate(x) for x in zip(*parts))
    norm = np.sqrt(np.bincount(word, weight**2, len(words)))
    return Subsequences(word, feature.astype(np.int64), weight / np.maximum(norm, 1e-12)[word])


def kernel(a: Subsequences, n: int, landmarks: Subsequences, m: int) -> np.ndarray:
    """Kernel matrix between n words and m landmarks."""
    ids, columns = np.unique(landmarks.feature, return_inverse=True)
    table = np.zeros((len(ids), m))
    np.add.at(table, (columns, landmarks.word), landmarks.weight)
    at = np.minimum(np.searchsorted(ids, a.feature), len(ids) - 1)
    hit = ids[at] == a.feature
    out = np.zeros((n, m))
    order = np.argsort(a.word[hit], kind="stable")
    word, rows, weight = a.word[hit][order], at[hit][order], a.weight[hit][order]
    for low in range(0, n, 256):
        x, y = np.searchsorted(word, [low, low + 256])
        np.add.at(out, word[x:y], weight[x:y, None] * table[rows[x:y]])
    return out


def svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float, steps: int = 60) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton steps with halving; the bias is all but free."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w, ridge = np.zeros(x.shape[1]), np.ones(x.shape[1])
    ridge[-1] = 1e-4

    def loss(v: np.ndarray) -> float:
        return (ridge * v * v).sum() / 2 + c * (weight * np.maximum(0, 1 - y * (x @ v)) ** 2).sum()

    for _ in range(steps):
        short = 1 - y * (x @ w)
        at = short > 0
        gradient = ridge * w - 2 * c * x[at].T @ (weight[at] * y[at] * short[at])
        step = np.linalg.solve(np.diag(ridge) + 2 * c * (x[at] * weight[at][:, None]).T @ x[at], gradient)
        now, size = loss(w), 1.0
        while size > 1e-6 and loss(w - size * step) > now - 1e-4 * size * (gradient @ step):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return w[:-1], float(w[-1])


class WordModel(NamedTuple):
    weights: np.ndarray
    bias: float

    def margins(self, words: list[str], params: ToxicParams) -> np.ndarray:
        """Margin of every word, in blocks of bounded characters; a longer word is a block of its own."""
        out, low = np.empty(len(words)), 0
        ends = np.cumsum([len(w) + 2 for w in words]) if words else np.empty(0)
        while low < len(words):
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + BLOCK_CHARS, side="right")))
            out[low:high] = self._block(words[low:high], params)
            low = high
        return out

    def _block(self, words: list[str], params: ToxicParams) -> np.ndarray:
        """The folded sum over the norm of each word. Both add up over the places where a subsequence begins, so they are
        taken slice by slice, and a text without spaces takes no more memory than any other."""
        codes, owner, end = laid(words)
        total, squares = np.zeros(len(words)), np.zeros(len(words))
        for start in range(0, len(codes), SLICE_CHARS):
            at = np.arange(start, min(start + SLICE_CHARS, len(codes)))
            for c in range(2, params.span):
                ok = at[at + c < end[at]]
                weight = params.decay ** (c + 1)
                for b in range(1, c):
                    total += weight * np.bincount(owner[ok], self.weights[hashed(codes, ok, b, c)], len(words))
                squares += (c - 1) * weight**2 * np.bincount(owner[ok], minlength=len(words))
        return total / np.maximum(np.sqrt(squares), 1e-12) + self.bias


def spread(side: list[str], n: int) -> list[str]:
    """``n`` of the ranked words: the first half of them from the top, the others evenly from the rest."""
    top, rest = side[: n // 2], side[n // 2 :]
    more = min(len(rest), n - len(top))
    return top + [rest[i] for i in np.unique(np.linspace(0, len(rest) - 1, more).astype(int))] if more else top


def fit_words(positive: list[str], negative: list[str], params: ToxicParams) -> WordModel:
    words = positive + negative
    y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    if not positive or not negative:
        return WordModel(np.zeros(1 << BITS, np.float32), -1.0)
    # Half of the landmarks from each side.
    marks = spread(positive, params.landmarks // 2) + spread(negative, params.landmarks // 2)
    landmarks = subsequences(marks, params)
    inner = kernel(landmarks, len(marks), landmarks, len(marks))
    values, vectors = np.linalg.eigh(inner)
    root = vectors @ np.diag(np.where(values > 1e-6, values, np.inf) ** -0.5) @ vectors.T
    z = kernel(subsequences(words, params), len(words), landmarks, len(marks)) @ root
    balance = np.where(y > 0, len(y) / (2 * len(positive)), len(y) / (2 * len(negative)))
    w, bias = svm(z, y, balance, params.c)
    weights = np.zeros(1 << BITS)
    np.add.at(weights, landmarks.feature, landmarks.weight * (root @ w)[landmarks.word])
    return WordModel(weights.astype(np.float32), bias)


FEATURES = 6


def document_features(texts: list[str | None], model: WordModel, params: ToxicParams) -> np.ndarray:
    """Three largest margins, number and share of words above zero, per text; distinct words are scored once."""
    split = [units(t) for t in texts]
    counts = np.array([len(s) for s in split])
    codes, distinct = pd.factorize(np.array([w for s in split for w in s], object))
    out = np.zeros((len(texts), FEATURES))
    out[:, :3] = -2
    if not len(codes):
        return out
    margins = model.margins(list(distinct), params)[codes]
    row = np.repeat(np.arange(len(texts)), counts)
    hits = np.bincount(row, margins > 0, len(texts))
    strength = np.bincount(row, np.maximum(margins, 0), len(texts))
    some = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[some]
    left = margins.copy()
    for k in range(3):
        best = np.maximum.reduceat(left, starts)
        out[some, k] = np.clip(best, -2, 2)
        # The first word with this margin is taken out for the next round.
        full = np.full(len(texts), np.nan)
        full[some] = best
        at = np.flatnonzero(left == full[row])
        left[at[np.unique(row[at], return_index=True)[1]]] = -2
    out[:, 3], out[:, 4], out[:, 5] = np.log1p(hits), np.log1p(strength), hits / np.maximum(counts, 1) * 10
    return out


class Model(NamedTuple):
    words: WordModel
    mean: np.ndarray
    scale: np.ndarray
    coef: np.ndarray
    bias: float

    def scores(self, texts: list[str | None], params: ToxicParams) -> np.ndarray:
        x = (document_features(texts, self.words, params) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.coef + self.bias, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[np.ndarray, float]:
    """Newton steps on the mean log loss."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    share = np.full(len(y), 1 / max(1, len(y)))
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (share * (p - y)) + penalty @ w
        change = np.linalg.solve((a * (share * p * (1 - p))[:, None]).T @ a + penalty, gradient)
        w -= change
        if np.abs(change).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, params: ToxicParams = ToxicParams()) -> Model:
    """Model from labelled documents (labels: doc_id, label 0/1; null labels are left out).

    Without rows of both labels every text gets a score of 0 (no toxic row) or 1 (no clean row)."""
    rows = labels.filter("doc_id is not null and label is not null").select("doc_id", F.col("label").cast("int").alias("label"))
    chosen = rows.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("key", pa.array(smallest_shingles(batch.column(0)), pa.int64()))

    # Near copies mostly share their smallest shingle: they teach once, and never sit on both sides of a fold.
    keyed = texts.select("text", "label").mapInArrow(key, "text string, label int, key long")
    part = F.pmod(F.xxhash64("key"), F.lit(params.folds)).cast("int")
    once = keyed.groupBy("key", "label").agg(F.min("text").alias("text"))
    sample = write_stage(once.select("text", "label", part.alias("part")), "toxic-sample")
    n_toxic, n_clean = sample.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    empty = np.zeros(FEATURES)
    if not n_toxic or not n_clean:
        return Model(fit_words([], [], params), empty, empty + 1, empty, 30.0 if n_toxic else -30.0)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({w for w in units(t) if len(w) <= LEARNT_CHARS}) for t in batch.column(0).to_pylist()]
            at = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
            word = pa.array([w for f in found for w in f], pa.string())
            yield pa.RecordBatch.from_arrays([word, batch.column(1).take(at), batch.column(2).take(at)], ["word", "label", "part"])

    toxic = [F.count_if((F.col("label") == 1) & (F.col("part") == i)).alias(f"toxic_{i}") for i in range(params.folds)]
    clean = [F.count_if((F.col("label") == 0) & (F.col("part") == i)).alias(f"clean_{i}") for i in range(params.folds)]
    seen = write_stage(sample.mapInArrow(read, "word string, label int, part int").groupBy("word").agg(*toxic, *clean), "toxic-words")
    # The weights of the document features come from documents that the word model has not seen.
    tables = []
    for left_out in range(params.folds):
        words = learn_words(sample, seen, [i for i in range(params.folds) if i != left_out], n_toxic / (n_toxic + n_clean), params)
        tables.append(describe(sample.filter(F.col("part") == left_out), words, params))
    x, y = (np.concatenate(t) for t in zip(*tables))
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    coef, bias = logistic((x - mean) / scale, y)
    words = learn_words(sample, seen, list(range(params.folds)), n_toxic / (n_toxic + n_clean), params)
    return Model(words, mean, scale, coef, bias)


def smallest_shingles(texts: pa.Array) -> list[int]:
    """Smallest hash of five words in a row, per text; 0 for texts without words."""
    out = []
    for low, high, words in Hasher(SPACE).chunks(texts):
        hashes, bounds = shingles(words, 5)
        for i in range(high - low):
            own = hashes[bounds[i] : bounds[i + 1]]
            out.append(int(own.min() >> np.uint64(1)) if len(own) else 0)
    return out


def cover(held: np.ndarray, params: ToxicParams) -> list[int]:
    """Columns in the order of a greedy cover: each is the first of those that the most unexplained rows hold.

    A row is explained once it holds ``witnesses`` of them; the cover ends when no column has ``support`` unexplained rows."""
    need = np.full(len(held), params.witnesses)
    gain, out = held.sum(0), []
    while len(gain) and gain.max() >= params.support:
        best = int(gain.argmax())
        out.append(best)
        rows = held[:, best] & (need > 0)
        need[rows] -= 1
        gain -= held[rows & (need == 0)].sum(0)
        gain[best] = -1
    return out


def learn_words(sample: DataFrame, seen: DataFrame, parts: list[int], base: float, params: ToxicParams) -> WordModel:
    """Word model from some parts of the sample; ``seen`` holds the documents per word, label and part."""
    counted = seen.select("word", sum(F.col(f"toxic_{i}") for i in parts).alias("k"), sum(F.col(f"clean_{i}") for i in parts).alias("c"))
    n, k = F.col("k") + F.col("c"), F.col("k")
    # Log-likelihood ratio of the word's share of toxic documents against the overall share.
    term = lambda count, share: F.when(count > 0, count * F.log(count / (n * share))).otherwise(0.0)
    counted = counted.withColumn("evidence", 2 * (term(k, F.lit(base)) + term(n - k, F.lit(1 - base))))
    toxic = counted.filter((F.col("evidence") >= params.evidence) & (k >= params.share * n)).orderBy(F.desc("evidence"), "word").limit(params.candidates)
    clean = counted.filter((k <= base * n) & (n > 0))
    known = clean.orderBy(F.desc("c"), "word").limit(params.negatives // 3)
    other = clean.orderBy(F.xxhash64("word"), "word").limit(params.negatives - params.negatives // 3)
    positive = explaining(sample.filter((F.col("label") == 1) & F.col("part").isin(parts)), [r.word for r in toxic.collect()], params)
    negative = list(dict.fromkeys(r.word for part in (known, other) for r in part.select("word").collect()))
    model = fit_words(positive, negative, params)
    if not positive or not negative:
        return model
    held = share(sample.sparkSession, model)

    @F.arrow_udf("double")
    def margin(words: pa.Array) -> pa.Array:
        return pa.array(held().margins(words.to_pylist(), params), pa.float64())

    hard = clean.select("word", margin("word").alias("margin")).orderBy(F.desc("margin"), "word").limit(params.hard).collect()
    return fit_words(positive, list(dict.fromkeys(negative + [r.word for r in hard])), params)


def explaining(toxic: DataFrame, words: list[str], params: ToxicParams) -> list[str]:
    """Those of ``words`` that explain the toxic documents. The driver gets one bit per candidate and toxic row of the sample."""
    known = share(toxic.sparkSession, {w: i for i, w in enumerate(words)})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.zeros((batch.num_rows, len(words)), bool)
            for row, text in enumerate(batch.column(0).to_pylist()):
                bits[row, [known()[w] for w in set(units(text)) if w in known()]] = True
            yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in np.packbits(bits, axis=1)], pa.binary())], ["bits"])

    table = toxic.select("text").mapInArrow(read, "bits binary").toArrow()
    raw = np.frombuffer(b"".join(table["bits"].to_pylist()), np.uint8).reshape(table.num_rows, -(-len(words) // 8))
    return [words[i] for i in cover(np.unpackbits(raw, axis=1, count=len(words)).astype(bool), params)]


def describe(sample: DataFrame, words: WordModel, params: ToxicParams) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the sample's documents: at most ``params.sample`` short rows."""
    held = share(sample.sparkSession, words)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = document_features(batch.column(0).to_pylist(), held(), params)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.list_(pa.float64())), batch.column(1)], ["x", "label"])

    table = sample.select("text", "label").mapInArrow(read, "x array<double>, label int").toArrow()
    return np.array(table["x"].to_pylist()).reshape(-1, FEATURES), table["label"].to_numpy().astype(float)


def scorer(docs: DataFrame, model: Model, params: ToxicParams = ToxicParams()):
    """Column function: text -> score from 0 to 1. Null and empty texts are scored as texts without words."""
    held = share(docs.sparkSession, model)  # a fixed size: one number per hashed subsequence

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        part, out = np.cumsum(lengths) // PART_BYTES, []
        for low, high in pairwise(np.flatnonzero(np.diff(part, prepend=-1, append=-1)).tolist()):
            out.append(held().scores(texts.slice(low, high - low).to_pylist(), params))
        return pa.array(np.concatenate(out) if out else [], pa.float64())

    return score


def learnable(labels: DataFrame) -> DataFrame:
    """Labels of the learning fold: the id's CRC-32 modulo 5 is not 0."""
    return labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)


def drop_toxic(docs: DataFrame, labels: DataFrame, params: ToxicParams = ToxicParams()) -> DataFrame:
    """``docs`` without the documents that score 0.5 or more; all columns and repeated rows are kept."""
    return docs.filter(scorer(docs, fit(docs, labels, params), params)("text") < 0.5)
