"""Benchmark decontamination: a BM25 index of test items, queried with every passage of every document.

The index is small and sharded by a bound on its postings; each shard is broadcast in turn. A posting's impact is its
BM25 weight divided by the item's own score, so a passage's score is the share of the item that it holds, and one
threshold serves all items. Passages overlap by half and are at least as long as the longest item.

For all passages of a chunk of rows, the sums of the list maxima and then of the block maxima are computed at once;
passages that pass the threshold in some block go through block-max WAND, which returns every item above the
threshold. Each hit is verified by the share of the five-word shingles of the item's question, and of its answer,
that occur around the passage; parts of few words have shorter shingles, so that one changed word leaves half of them.
An item without an inner question mark has no certain boundary: it is verified as a whole if its last sentence is too
short for an answer, else by both parts or by nearly all of the whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrade.llm.shared import share
from lexigrade.llm.words import NOT_ALNUM, Hasher, Rows, shingles
from lexigrade.session import write_stage

CELLS = 1 << 21


class SearchParams(NamedTuple):
    k1: float = 1.2
    b: float = 0.75
    score: float = 0.35
    overlap: float = 0.5
    copied: float = 0.7
    words: int = 5
    step: int = 32
    block: int = 2
    shard_postings: int = 1_000_000


def question_and_answer(text: str) -> tuple[str, str]:
    """The answer is what follows the last question mark, else the last sentence; one sentence is both."""
    text = text.strip()
    cut = text.rfind("?", 0, -1) + 1
    if not cut:
        ends = [m.end() for m in re.finditer(r"[.!?]\s+", text)]
        cut = ends[-1] if ends else 0
    question, answer = text[:cut].strip(), text[cut:].strip()
    return (question, answer) if question and answer else (text, text)


def asks(text: str) -> bool:
    """Whether a question mark tells the question from the answer."""
    return "?" in text.strip()[:-1]


def shingle_size(n: int, params: SearchParams, least: int) -> int:
    """Words per shingle of a part of ``n`` words: one changed word leaves half of the shingles, where ``least`` allows it."""
    return max(1, min(n, params.words, max(least, (n + 1) // 3)))


def lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.fill_null(""))


def hashed(texts: list[str]) -> list[np.ndarray]:
    rows = Hasher(NOT_ALNUM).chunks(lower(pa.array(texts, pa.string())))
    return [w.hashes[a:b] for _, _, w in rows for a, b in zip(w.bounds[:-1], w.bounds[1:])]


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Shingles of one text, none for a text that is shorter."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    return shingles(Rows(words, np.array([0, len(words)])), size).hashes


def postings(items: DataFrame, params: SearchParams) -> DataFrame:
    """Rows (shard, item, item_id, question, answer, whole, terms, impacts), one per item with words. ``whole`` is empty
    where question and answer alone decide."""
    kind = "item_id long, question array<bigint>, answer array<bigint>, whole array<bigint>, n_words long, terms array<bigint>, tfs array<bigint>"
    names = [x.split()[0] for x in kind.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            words = hashed(texts)
            halves = [hashed(list(question_and_answer(t))) for t in texts]
            unsure = [not asks(t) for t in texts]
            # A last sentence of few words is no answer of its own.
            halves = [[w, w] if u and len(h[1]) < 2 * params.words else h for w, h, u in zip(words, halves, unsure)]
            whole = [w if u and h[0] is not w else w[:0] for w, h, u in zip(words, halves, unsure)]
            counted = [np.unique(w.view(np.int64), return_counts=True) for w in words]
            lists = [[h[0].view(np.int64) for h in halves], [h[1].view(np.int64) for h in halves], [w.view(np.int64) for w in whole], [c[0] for c in counted], [c[1] for c in counted]]
            q, a, w, t, f = (pa.array(x, pa.list_(pa.int64())) for x in lists)
            yield pa.RecordBatch.from_arrays([batch.column(0), q, a, w, pa.array([len(x) for x in words], pa.int64()), t, f], names)

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(read, kind).filter("n_words > 0")
    rows = write_stage(rows.withColumn("item", F.monotonically_increasing_id()), "bench-items")
    n, mean, cells = rows.agg(F.count("*"), F.avg("n_words"), F.sum(F.size("terms"))).first()
    each = rows.select("item", "n_words", F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
    each = each.select("item", "n_words", F.col("p.terms").alias("term"), F.col("p.tfs").alias("tf"))
    df = each.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    damp = params.k1 * (1 - params.b + params.b * F.col("n_words") / F.lit(mean or 1.0))
    weight = idf * F.col("tf") * (params.k1 + 1) / (F.col("tf") + damp)
    lists = each.join(df, "term").select("item", F.struct("term", weight.alias("w")).alias("tw")).groupBy("item").agg(
        F.sum("tw.w").alias("own"), F.collect_list("tw").alias("tws")
    )
    shards = max(1, -(-(cells or 0) // params.shard_postings))
    return rows.join(lists, "item").select(
        F.pmod(F.xxhash64("item"), F.lit(shards)).alias("shard"), "item", "item_id", "question", "answer", "whole", "n_words",
        F.col("tws.term").alias("terms"), F.transform("tws.w", lambda w: w / F.col("own")).alias("impacts"),
    )


class Shard:
    """Inverted index of one shard: terms ascending by hash, postings ascending by item, block maxima per term."""

    def __init__(self, table: pa.Table, params: SearchParams):
        self.ids = table["item_id"].to_pylist()
        self.parts = []  # shingle size and shingles of question, answer and, if there is one, the whole
        for parts in zip(table["question"].to_pylist(), table["answer"].to_pylist(), table["whole"].to_pylist()):
            hashes = [np.array(x, np.int64).view(np.uint64) for x in parts]
            # Single words tell something only of an answer, beside its question; a phrase of under five words is one shingle.
            least = 2 if len(hashes[0]) >= 5 else 4
            sizes = [shingle_size(len(x), params, n) for x, n in zip(hashes, (least, least if parts[0] == parts[1] else 1, 2))]
            self.parts.append([(n, frozenset(grams(x, n).tolist())) for n, x in zip(sizes, hashes)][: 3 if parts[2] else 2])
        self.n_words = table["n_words"].to_pylist()
        self.block = params.block
        self.blocks = -(-len(self.ids) // params.block)
        sizes = [len(x) for x in table["terms"].to_pylist()]
        item = np.repeat(np.arange(len(sizes)), sizes)
        term = table["terms"].combine_chunks().flatten().to_numpy().view(np.uint64)
        impact = table["impacts"].combine_chunks().flatten().to_numpy()
        order = np.lexsort((item, term))
        self.items, self.impacts = item[order], impact[order]
        self.terms, self.starts = np.unique(term[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))
        self.top = np.maximum.reduceat(self.impacts, self.starts) if len(order) else np.empty(0)
        # One row per (term, block) that has postings.
        cell = np.repeat(np.arange(len(self.terms)), self.ends - self.starts) * self.blocks + self.items // self.block
        cells, first = np.unique(cell, return_index=True)
        self.block_top = np.maximum.reduceat(self.impacts, first) if len(first) else np.empty(0)
        self.block_of = cells % max(1, self.blocks)
        self.block_starts = np.searchsorted(cells, np.arange(len(self.terms) + 1) * self.blocks)
        self.read: dict[int, tuple] = {}  # posting lists as Python lists, once used

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """Term numbers of word hashes, -1 for words that no item has."""
        if not len(self.terms):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[at] == words, at, -1)

    def block_bounds(self, window: np.ndarray, term: np.ndarray, windows: int) -> np.ndarray:
        """Largest sum of block maxima over the blocks, per window; ``window`` is ascending."""
        best = np.zeros(windows)
        step = max(1, CELLS // max(1, self.blocks))
        for low in range(0, windows, step):
            a, b = np.searchsorted(window, [low, low + step])
            lists = term[a:b]
            counts = self.block_starts[lists + 1] - self.block_starts[lists]
            at = np.repeat(self.block_starts[lists] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            cell = np.repeat(window[a:b] - low, counts) * self.blocks + self.block_of[at]
            rows = min(step, windows - low)
            sums = np.bincount(cell, self.block_top[at], rows * self.blocks).reshape(rows, -1)
            best[low : low + rows] = sums.max(1)
        return best

    def wand(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Items whose summed impacts over ``terms`` reach the threshold: block-max WAND."""
        end = len(self.ids)
        lists = []  # current item, place in the list, items, impacts, list maximum, block maxima
        for t in terms:
            if t not in self.read:
                a, b = self.starts[t], self.ends[t]
                c, d = self.block_starts[t], self.block_starts[t + 1]
                tops = dict(zip(self.block_of[c:d].tolist(), self.block_top[c:d].tolist()))
                self.read[t] = (self.items[a:b].tolist() + [end], self.impacts[a:b].tolist(), float(self.top[t]), tops)
            lists.append([self.read[t][0][0], 0, *self.read[t]])
        found = []

        def advance(ones: list[list], to: int) -> None:
            for one in ones:
                if one[0] < to:
                    one[1] = bisect_left(one[2], to, one[1])
                    one[0] = one[2][one[1]]

        current = itemgetter(0)
        while True:
            lists.sort(key=current)
            total, pivot = 0.0, -1
            for i, one in enumerate(lists):
                total += one[4]
                if total >= threshold:
                    pivot = i
                    break
            if pivot < 0 or lists[pivot][0] == end:
                return found
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            block, bound = item // self.block, 0.0
            for one in lists[: pivot + 1]:
                bound += one[5].get(block, 0.0)
            if bound < threshold:
                after = min(end, (block + 1) * self.block)
                if pivot + 1 < len(lists):
                    after = min(after, lists[pivot + 1][0])
                advance(lists[: pivot + 1], after)
            elif lists[0][0] == item:
                score = sum(one[3][one[1]] for one in lists[: pivot + 1])
                if score >= threshold:
                    found.append((item, score))
                advance(lists[: pivot + 1], item + 1)
            else:
                advance(lists[:pivot], item)


def search(shard: Shard, words: Rows, params: SearchParams, step: int) -> dict[int, dict[int, tuple]]:
    """Verified items of each row of a chunk: {row: {item: (score, question share, answer share, first word)}}."""
    counts = np.diff(words.bounds)
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words.hashes)) - np.repeat(words.bounds[:-1], counts)
    term = shard.lookup(words.hashes)
    seen = term >= 0
    row, half, term = row[seen], place[seen] // step, term[seen]
    # A window is two halves in a row; windows of a row are numbered by their first half.
    first = np.concatenate([[0], np.cumsum(counts // step + 1)])
    left = first[row] + half
    window = np.concatenate([left, left[half > 0] - 1])
    pairs = np.unique(window * len(shard.terms) + np.concatenate([term, term[half > 0]]))
    if not len(pairs):
        return {}
    ids, term = np.divmod(pairs, len(shard.terms))
    new = np.concatenate([[True], ids[1:] != ids[:-1]])
    at, window = np.flatnonzero(new), np.cumsum(new) - 1
    ids = ids[at]
    bound = np.add.reduceat(shard.top[term], at)
    kept = bound >= params.score
    new = np.cumsum(kept) - 1
    some = kept[window]
    ids, window, term = ids[kept], new[window[some]], term[some]
    good = shard.block_bounds(window, term, len(ids)) >= params.score
    out: dict[int, dict[int, tuple]] = {}
    grams_of: dict[tuple[int, int], np.ndarray] = {}
    for w in np.flatnonzero(good).tolist():
        a, b = np.searchsorted(window, [w, w + 1])
        hits = shard.wand(term[a:b].tolist(), params.score)
        if not hits:
            continue
        r = int(np.searchsorted(first, ids[w], side="right")) - 1
        own = words.hashes[words.bounds[r] : words.bounds[r + 1]]
        begin = int(ids[w] - first[r]) * step
        for item, score in hits:
            low, high = max(0, begin - shard.n_words[item]), begin + 2 * step + shard.n_words[item]
            shares = []
            for size, part in shard.parts[item]:
                if (r, size) not in grams_of:
                    grams_of[r, size] = grams(own, size)
                around = grams_of[r, size][low : max(low, high - size + 1)]
                shares.append(len(part.intersection(around.tolist())) / len(part) if part else 1.0)
            copied = shares[2:] and shares[2] >= params.copied
            shares = shares[:2]
            was = out.setdefault(r, {}).get(item)
            if (min(shares) >= params.overlap or copied) and (was is None or (min(shares), score) > (min(was[1:3]), was[0])):
                out[r][item] = (score, *shares, begin)
    return out


HITS = "array<struct<item_id:bigint,score:double,question:double,answer:double,word:bigint>>"


def _find_in(held: Callable[[], Shard], params: SearchParams, step: int):
    names = ("item_id", "score", "question", "answer", "word")
    types = (pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())

    @F.arrow_udf(HITS)
    def find(texts: pa.Array) -> pa.Array:
        shard, out = held(), []
        for low, high, words in Hasher(NOT_ALNUM).chunks(lower(texts)):
            hits = search(shard, words, params, step)
            for r in range(high - low):
                out.append([dict(zip(names, (shard.ids[i], *hit))) for i, hit in sorted(hits.get(r, {}).items())])
        return pa.array(out, pa.list_(pa.struct(list(zip(names, types)))))

    return find


def finder(docs: DataFrame, items: DataFrame, params: SearchParams):
    """Column function: text -> verified hits, one per item. ``items`` has item_id and text."""
    spark = docs.sparkSession
    index = write_stage(postings(items, params), "bench-index")
    shards = sorted(r.shard for r in index.select("shard").distinct().collect())
    longest = index.agg(F.max("n_words")).first()[0] or 0
    step = max(params.step, -(-longest // 2))
    functions = []
    for number in shards:
        # At most about `shard_postings` postings.
        shard = Shard(index.filter(F.col("shard") == number).orderBy("item").toArrow(), params)
        functions.append(_find_in(share(spark, shard), params, step))
    if not functions:
        return lambda text: F.array().cast(HITS)
    return lambda text: F.concat(*[f(text) for f in functions])


def contaminated_passages(docs: DataFrame, items: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """One row per document and test item found in it: doc_id, item_id, score, question, answer, word.

    Words are lower-cased runs of letters and digits. ``score`` is the item's share of BM25 in the best passage,
    ``question`` and ``answer`` the shares of their shingles (both of the whole item where its last sentence is no answer),
    ``word`` the first word of the passage. Null or empty
    texts on either side give nothing; repeated rows are reported each; other columns are ignored.
    """
    found = docs.select("doc_id", F.explode(finder(docs, items, params)("text")).alias("hit"))
    return found.select("doc_id", "hit.*")


def drop_contaminated(docs: DataFrame, items: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """``docs`` without the documents in which a test item is found; rows of null text stay."""
    return docs.filter(F.size(finder(docs, items, params)("text")) == 0)
