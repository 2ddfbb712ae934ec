"""Benchmark decontamination: rare word pairs as seeds, then Smith-Waterman alignment.

Seeds: where two matched words that follow each other in an alignment have STEPS or fewer places between their positions on
either side, the step gains 2 (neither side skips a word) or 1; every wider step costs what its second match brings. So a score
of T needs steps worth T - 2 within reach of one copy, and each word of the item begins one step at most. Of an item whose least
leaking score is T, the (T - 3) // 2 words whose pairs occur most often in the corpus are left out, and the pairs of all others
are seeds: no passage that scores T is without one, however it was edited. Pairs that occur nowhere take no place.

Seeds of documents and items meet, the meetings of a document and an item that one copy can span are joined into a passage with
all the words such a copy can reach, and each passage with enough of the item's words is aligned to it by words with
Smith-Waterman: it is a leak if it reaches enough of the score that the whole item has against itself, or of a run of SPAN
words. The result is the same as of aligning every document, whole, with every item.

The items are read in blocks of ITEM_BLOCK rows and ITEM_BYTES bytes at most, so that what a task holds of them is bounded;
every block meets all documents. A document's passages are found and aligned where its text is: no text is shuffled.

Cases: null text has no words and never leaks; items or documents that repeat give their rows again; an item shorter than GRAM
words leaks only as a whole, at its first place in a document; an `enough` below a score of 3 still needs a seed, two words; an empty table on either side leaves all documents clean;
extra columns are carried by `clean_documents`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, row_key, settled, slices, table
from .words import STEP, HashSet, Words, gram_hashes, mix

#: Items of fewer words leak only as a whole; the words of a seed stand at most STEPS apart.
GRAM, STEPS = 3, 2
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of the item's own score, and the words of a run that is a leak whatever the item's length.
ENOUGH, SPAN = 0.5, 50
ITEM_BLOCK, ITEM_BYTES = 20000, 32 << 20


def _aligned(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two arrays of word hashes with linear gaps, and the least end in b that has it; a row of b at a time."""
    if not len(a) or not len(b):
        return 0, 0
    n = len(b)
    steps = np.arange(n + 1, dtype=np.int32) * -GAP
    before = np.zeros(n + 1, dtype=np.int32)
    best, end = 0, 0
    for x in a:
        now = np.zeros(n + 1, dtype=np.int32)
        np.maximum(before[:-1] + np.where(b == x, MATCH, MISMATCH), before[1:] + GAP, out=now[1:])
        np.maximum(now, 0, out=now)
        # A gap along the row: the best of earlier cells less GAP a step, by a running maximum.
        now = np.maximum.accumulate(now + steps) - steps
        at = int(now.argmax())
        if (int(now[at]), -at) > (best, -end):
            best, end = int(now[at]), at
        before = now
    return best, end


def smith_waterman(a: np.ndarray, b: np.ndarray) -> int:
    return _aligned(a, b)[0]


def pairs(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of all pairs of words of one text that stand 1 to STEPS apart; the hash doesn't tell how far."""
    at, hashes = [], []
    for k in range(1, STEPS + 1):
        n = max(0, len(w.hash) - k)
        same = np.flatnonzero(w.doc[:n] == w.doc[k:])
        at.append(same)
        hashes.append(mix(w.hash[same] * STEP + w.hash[same + k]))
    return np.concatenate(at), np.concatenate(hashes)


class Items:
    """A block of test items: word hashes, and the pairs of those of GRAM words or more with their places."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids, self.texts = ids, texts
        w = Words(texts)
        self.first, self.hash = w.first, w.hash
        size = np.diff(self.first)
        # Items of fewer than GRAM words by their number of words: hash of all of them, item; several may be equal.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in range(1, GRAM):
            own = np.flatnonzero(size == k)
            if len(own):
                h = np.array([gram_hashes(texts[i], k)[0] for i in own], dtype=np.uint64)
                order = np.argsort(h, kind="stable")
                self.short[k] = h[order], own[order]
        at, h = pairs(w)
        long = size[w.doc[at]] >= GRAM
        at, h = at[long], h[long]
        self.gram, self.word, self.item = h, at, w.doc[at]
        self.place = at - self.first[self.item]

    def words(self, i: int) -> np.ndarray:
        return self.hash[self.first[i] : self.first[i + 1]]

    def least(self, enough: float, span: int) -> np.ndarray:
        """The least score with which each item leaks."""
        own = MATCH * np.diff(self.first)
        score = np.ceil(enough * own).astype(np.int64)
        score -= (score > 0) & ((score - 1) / np.maximum(own, 1) >= enough)
        score += score / np.maximum(own, 1) < enough
        return np.minimum(score, MATCH * span)

    def seeds(self, grams: np.ndarray, counts: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Which pairs are seeds, by the counts of the sorted grams that occur: all but those of the most frequent words that a leak can do without."""
        n = np.zeros(len(self.gram), dtype=np.int64)
        if len(grams):
            spot = np.minimum(np.searchsorted(grams, self.gram), len(grams) - 1)
            n = np.where(grams[spot] == self.gram, counts[spot], 0)
        often = np.bincount(self.word, weights=n, minlength=len(self.hash))
        doc = np.repeat(np.arange(len(self.texts)), np.diff(self.first))
        order = np.lexsort((-often, doc))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order)) - self.first[doc[order]]
        spare = np.maximum(0, (least - 3) // 2)
        return (n > 0) & (rank >= spare[doc])[self.word]


def _counted(grams: np.ndarray):
    """Per batch: how often each item pair occurs, partly aggregated."""

    def each(batches):
        known = HashSet(grams)
        total = np.zeros(len(known.sorted), dtype=np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in slices(texts):
                total += np.bincount(known.find(pairs(Words(texts[a:b]))[1])[1], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(known.sorted[some].astype(np.int64)), pa.array(total[some])], names=["gram", "n"])

    return each


def _leaks(ids: list, texts: list[str], seeds: np.ndarray, enough: float, span: int):
    items = Items(ids, texts)
    gram, item = items.gram[seeds], items.item[seeds]
    known = HashSet(gram)
    order = np.argsort(gram, kind="stable")
    gram, item = gram[order], item[order]
    low, high = np.searchsorted(gram, known.sorted, "left"), np.searchsorted(gram, known.sorted, "right")
    size = np.diff(items.first)
    least = items.least(enough, span)
    short_sets = {k: HashSet(h) for k, (h, _) in items.short.items()}
    # A copy of m <= size words that scores least has gaps of MATCH * m - least words at most.
    reach = np.maximum(size, (1 + MATCH) * size - least) + 1

    def passages(words: np.ndarray, i: int, at: np.ndarray):
        """(score, first, last) of the best alignment of each passage that leaks."""
        own = items.words(i)
        cuts = np.flatnonzero(np.diff(at) > 2 * reach[i]) + 1
        for x, y in zip([0, *cuts], [*cuts, len(at)]):
            a, b = max(0, int(at[x] - reach[i])), min(len(words), int(at[y - 1] + reach[i]) + 1)
            if MATCH * np.isin(own, words[a:b]).sum() < least[i]:
                continue
            score, end = _aligned(own, words[a:b])
            if score >= least[i]:
                back = _aligned(own[::-1], words[a : a + end][::-1])[1]
                yield score, a + end - back, a + end

    def scan(batch):
        names = batch.column(1).to_pylist()
        held = [t or "" for t in batch.column(2).to_pylist()]
        keys = batch.column(0).to_pylist()
        out = []
        for a, b in slices(held):
            w = Words(held[a:b])
            starts, h = pairs(w)
            spot, which = known.find(h)
            # Every occurrence meets all items that have the pair.
            many = high[which] - low[which]
            at = np.repeat(starts[spot], many)
            it = item[np.repeat(low[which], many) + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)]
            doc = w.doc[at]
            order = np.lexsort((at, it, doc))
            at, it, doc = at[order], it[order], doc[order]
            cuts = np.flatnonzero(np.diff(doc) | np.diff(it)) + 1
            for x, y in zip([0, *cuts], [*cuts, len(at)] if len(at) else []):
                d, i = int(doc[x]), int(it[x])
                first = w.first[d]
                best = max(passages(w.hash[first : w.first[d + 1]], i, at[x:y] - first), key=lambda p: (p[0], -p[1]), default=None)
                if best:
                    out.append((keys[a + d], names[a + d], ids[i], best[0] / int(MATCH * size[i]), best[1], best[2]))
            for length, (short, which) in items.short.items():
                starts, h = w.grams(length)
                spot, found = short_sets[length].find(h)
                # The first place of each in each document, and there all items that are equal.
                doc = w.doc[starts[spot]]
                order = np.lexsort((starts[spot], found, doc))
                fresh = np.concatenate([[True], (np.diff(doc[order]) | np.diff(found[order])) != 0])[: len(order)]
                for x in order[fresh]:
                    d, s = int(doc[x]), int(starts[spot[x]] - w.first[doc[x]])
                    gram = short_sets[length].sorted[found[x]]
                    for i in which[np.searchsorted(short, gram, "left") : np.searchsorted(short, gram, "right")]:
                        out.append((keys[a + d], names[a + d], ids[i], 1.0, s, s + length))
        if out:
            types = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["key", "doc_id", "item_id", "score", "first_word", "last_word"])

    return scan


def item_blocks(benchmark: DataFrame, rows: int = ITEM_BLOCK, size: int = ITEM_BYTES):
    """Lists of (item_id, text) within both bounds; only one block is on the driver at a time."""
    held, used = [], 0
    for r in benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).toLocalIterator():
        n = len(r["text"].encode("utf-8", "surrogatepass"))
        if held and (len(held) >= rows or used + n > size):
            yield held
            held, used = [], 0
        held.append((r["item_id"], r["text"]))
        used += n
    if held:
        yield held


LEAK = "key string, doc_id long, item_id long, score double, first_word long, last_word long"


def leaks(docs: DataFrame, benchmark: DataFrame, enough: float = ENOUGH, span: int = SPAN) -> DataFrame:
    """One row a leaked (document, item): key, doc_id, item_id, score (share of the item's own alignment score) and the words of the best alignment. key stands for (doc_id, text)."""
    rows = docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for block in item_blocks(benchmark):
        ids, texts = [x for x, _ in block], [t for _, t in block]
        items = Items(ids, texts)
        # One row a distinct pair of the block that occurs.
        counted = docs.select("text").mapInArrow(_counted(np.unique(items.gram)), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
        grams, counts = counted.column("gram").to_numpy().astype(np.uint64), counted.column("n").to_numpy()
        order = np.argsort(grams)
        seeds = items.seeds(grams[order], counts[order], items.least(enough, span))
        found = map_arrow(rows, _leaks(ids, texts, seeds, enough, span), LEAK)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], LEAK)


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without those that leak an item; all columns. The ids of leaks are few and written out first; Spark chooses the join by their size."""
    found = settled(leaks(docs, benchmark, **options).select(F.col("key").alias("__leak")).distinct())
    return docs.withColumn("__key", row_key()).join(found, F.col("__key") == F.col("__leak"), "left_anti").select(*docs.columns)


def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")
