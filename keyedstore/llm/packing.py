"""Sequence packing by Karmarkar-Karp multiway differencing.

Each document's token ids (end id last) are cut into pieces.  Whole windows of
`capacity` ids go out at once.  What is left of each document is cut to pieces of
at most `piece` ids, and a bin of such pieces is dealt to m windows: partial
partitions with opposing imbalances are merged until one remains, which gives
near-equal windows.  m starts at the least that can hold the bin and rises
whenever a window would exceed the capacity.

Rows never leave the task that read them: there is no shuffle, and the state of
a task is one bin.  A sequence id is the task's partition number and a counter,
so a task that runs again gives the same ids.

Null or empty texts are documents of the end id alone.  Repeated rows are packed
as often as they stand; a null id stays null.  A very long text is cut like any other.
Pieces of equal size are dealt in the order in which they were read.  Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import named, renamed, small_batches

CAPACITY = 1024
PIECE = 256
#: Pieces that are dealt to windows together.
BIN = 100
#: Characters from which on the slower library encodes a text (the ids are the same): the faster one may exhaust its stack.
LONG = 1_000_000
# How the vocabulary splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"


def differencing(sizes: list[int], m: int) -> list[list[int]]:
    """Indexes dealt to m parts: the two partitions with the largest spread are merged, the fullest part of one with the emptiest of the other."""
    heap = []
    for i, size in enumerate(sizes):
        parts = [(0, ())] * (m - 1) + [(size, (i,))]
        heap.append((-size, i, parts))
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        merged = sorted(((x[0] + y[0], (x[1], y[1])) for x, y in zip(a, reversed(b))), key=lambda p: p[0])
        low = merged[0][0]
        heapq.heappush(heap, (low - merged[-1][0], count, merged))
        count += 1

    def flat(node) -> list[int]:
        out, todo = [], [node]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo.extend(x)
            else:
                out.append(x)
        return sorted(out)

    return [flat(p[1]) for p in heap[0][2]] if heap else []


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most `capacity`; the count rises until all fit."""
    if not sizes:
        return []
    m = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = [w for w in differencing(sizes, m) if w]
        if all(sum(sizes[i] for i in w) <= capacity for w in dealt):
            return dealt
        m += 1


def byte_bpe(path: str, ranks_path: str, end_id: int) -> Callable[[], Callable[[list[str]], list[bytes]]]:
    """Makes a worker's encoder: texts -> little-endian uint32 ids with the end id.

    `ranks_path` holds the same vocabulary as `path` for the faster library, whose
    ids are the same.  Texts beyond Latin-1, where two Unicode tables could differ,
    very long texts and texts with an added token go to the tokenizer of `path`.
    """

    def make() -> Callable[[list[str]], list[bytes]]:
        import base64
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            added = [x["content"] for x in json.load(f)["added_tokens"]]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        end = np.array([end_id], "<u4").tobytes()

        def encode(texts: list[str]) -> list[bytes]:
            out = []
            for text in texts:
                try:
                    text.encode("latin-1")
                    plain = len(text) < LONG and not any(a in text for a in added)
                except UnicodeEncodeError:
                    plain = False
                ids = fast.encode_to_numpy(text, disallowed_special=()) if plain else tokenizer.encode(text, add_special_tokens=False).ids
                out.append(np.asarray(ids, "<u4").tobytes() + end)
            return out

        return encode

    return make


def pack(docs: DataFrame, make_encoder: Callable, capacity: int = CAPACITY, piece: int = PIECE, bin_size: int = BIN) -> DataFrame:
    """One row per piece of each document: where it starts, and its sequence and offset there."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encode = make_encoder()
        sequence = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []
        waiting: list[tuple] = []
        pending = 0  # ids in waiting

        def place(members: list[tuple]) -> None:
            nonlocal sequence
            at = 0
            for doc, lone, start, length, crc, total in members:
                rows.append((doc, lone, start, length, crc, total, sequence, at))
                at += length
            sequence += 1

        def settle() -> None:
            nonlocal pending
            pending = 0
            for w in windows([x[3] for x in waiting], capacity):
                place([waiting[i] for i in w])
            waiting.clear()

        columns = ["doc_id", "nameless", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"].tolist()]
            for doc, lone, ids in zip(batch["doc_id"].tolist(), batch["nameless"].tolist(), encode(texts)):
                total, start = len(ids) // 4, 0
                while start < total:
                    length = min(capacity if total - start >= capacity else piece, total - start)
                    x = (doc, lone, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total)
                    start += length
                    if length == capacity:
                        place([x])
                    else:
                        waiting.append(x)
                        pending += length
                # a bin whose sum falls just short of whole windows wastes little
                if len(waiting) >= bin_size and (-pending % capacity <= 2 * pending // capacity or len(waiting) >= 2 * bin_size):
                    settle()
            if rows:
                yield pd.DataFrame(rows, columns=columns)
                rows.clear()
        settle()
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    return renamed(named(docs, "text").mapInPandas(run, SCHEMA.replace(",", ", nameless boolean,", 1)))
