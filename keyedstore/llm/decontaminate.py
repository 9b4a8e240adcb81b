"""Benchmark decontamination by size-partitioned MinHash containment search.

An item's sketch is the bottom-k of its shingle hashes, a uniform sample of its
set whatever the size of the documents it may hide in.  Items are partitioned by
set size; each partition has its own k and its own least number of sketch hits,
so that an item contained at the threshold is missed with a probability of `miss`
at most.  Items of at most k shingles are sketched whole and never missed.

Documents look every shingle up among all sketches (a bit table first), so long
documents cost no more than their length.  Candidates are verified by exact
containment of the item's full set in the document's.

The sketches and sets are sent to executors in slices of at most SLICE shingles;
a larger benchmark takes several passes over the documents.

Null, empty and blank texts, of items too, contain nothing and are contained in
nothing.  An item with fewer words than the shingle width is one shingle of all its
words and is found where a document holds these words in a row.  Repeated items
are found each; repeated documents are reported each, under a null id too.  Items with
a null id are passed over.  Extra columns are ignored (contaminated) or kept bit for bit
(clean); empty tables give no pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, kept_by_arrow, named, renamed, shingles, small_batches, word_hashes

WIDTH = 5
THRESHOLD = 0.8
MISS = 1e-6
#: Shingles of items sent to executors at a time.
SLICE = 1_000_000
#: (largest set, sketch size) of each partition; beyond the last, its sketch size.
PARTITIONS = ((24, 24), (64, 32), (256, 48), (1 << 62, 64))


def least_hits(k: int, n: int) -> int:
    """Fewest of k sketch values that a document holding THRESHOLD of n shingles has, but for MISS."""
    if n <= k:
        return math.ceil(THRESHOLD * n - 1e-9)
    total = 0.0
    for hits in range(k + 1):
        total += math.comb(k, hits) * THRESHOLD**hits * (1 - THRESHOLD) ** (k - hits)
        if total > MISS:
            return max(1, hits)
    return k


class Sketches:
    """Items of one slice: their sets by width, sketches and least hits."""

    def __init__(self, items: list[tuple[int, str]]):
        seen = WordHashes()
        self.ids, self.sets, self.widths, self.need = [], [], [], []
        values, owners = [], []
        for item, text in items:
            words = word_hashes(text, seen)
            if not len(words):
                continue
            s = np.unique(shingles(words, WIDTH))
            k = next(k for top, k in PARTITIONS if len(s) <= top)
            sketch = s[:k]  # hashes are uniform: the lowest are a sample
            values.append(sketch)
            owners.append(np.full(len(sketch), len(self.ids)))
            self.ids.append(item)
            self.sets.append(s)
            self.widths.append(min(WIDTH, len(words)))
            self.need.append(least_hits(k, len(s)))
        self.values = np.concatenate(values) if values else np.zeros(0, np.uint64)
        order = np.argsort(self.values, kind="stable")
        self.values = self.values[order]
        self.owners = np.concatenate(owners)[order] if owners else np.zeros(0, np.int64)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.values >> np.uint64(44)).astype(np.int64)] = True

    @classmethod
    def of(cls, held: dict) -> "Sketches":
        """From what is broadcast: executors have this class by value only."""
        out = cls.__new__(cls)
        vars(out).update(held)
        return out

    def find(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, its shingles, those shared) of the items that the words contain."""
        out = []
        sets: dict[int, np.ndarray] = {}
        hits: dict[int, int] = {}
        for width in sorted(set(self.widths)):
            if len(words) < width:
                continue
            s = shingles(words, width)
            some = s[self.bits[(s >> np.uint64(44)).astype(np.int64)]]
            if not len(some):
                continue
            some = np.unique(some)
            a, b = np.searchsorted(self.values, some, "left"), np.searchsorted(self.values, some, "right")
            got = [o for x, y in zip(a, b) if y > x for o in self.owners[x:y].tolist() if self.widths[o] == width]
            if got:
                sets[width] = s
                for o in got:
                    hits[o] = hits.get(o, 0) + 1
        full: dict[int, np.ndarray] = {}
        for o, n in sorted(hits.items()):
            if n >= self.need[o]:
                w = self.widths[o]
                if w not in full:
                    full[w] = np.unique(sets[w])
                own = self.sets[o]
                at = np.searchsorted(full[w], own)
                shared = int((full[w][np.minimum(at, len(full[w]) - 1)] == own).sum())
                if shared >= THRESHOLD * len(own) - 1e-9:
                    out.append((self.ids[o], len(own), shared))
        return out


def slices(benchmark: DataFrame) -> Iterator[Sketches]:
    """The items in slices; a slice ends before its words exceed SLICE."""
    held, words = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null").orderBy("item_id", "text").toLocalIterator():
        n = len(r["text"].split())
        if held and words + n > SLICE:
            yield Sketches(held)
            held, words = [], 0
        held.append((r["item_id"], r["text"]))
        words += n
    if held:
        yield Sketches(held)


PAIRS = "doc_id long, item_id long, item_shingles long, shared long, containment double"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, item_shingles, shared, containment: a row for each item in each document."""
    spark = docs.sparkSession
    small_batches(spark)
    out = None
    for sketches in slices(benchmark):
        shared = spark.sparkContext.broadcast(vars(sketches))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            seen, sketches = WordHashes(), Sketches.of(shared.value)
            for b in batches:
                rows = [(doc, lone, *hit, hit[2] / hit[1]) for doc, lone, text in zip(b["doc_id"].tolist(), b["nameless"].tolist(), b["text"].tolist()) if text for hit in sketches.find(word_hashes(text, seen))]
                yield pd.DataFrame(rows, columns=["doc_id", "nameless", "item_id", "item_shingles", "shared", "containment"])

        found = renamed(named(docs, "text").mapInPandas(run, PAIRS.replace(",", ", nameless boolean,", 1)))
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], PAIRS)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no item, with all their columns, in one pass for each slice."""
    small_batches(docs.sparkSession)
    for sketches in slices(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(vars(sketches))

        def keep(shared=shared) -> Callable[[list], list[bool]]:
            seen, sketches = WordHashes(), Sketches.of(shared.value)
            return lambda texts: [not (text and sketches.find(word_hashes(text, seen))) for text in texts]

        docs = kept_by_arrow(docs, "text", keep)
    return docs
