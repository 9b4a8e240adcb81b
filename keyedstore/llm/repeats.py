"""Repeated byte strings across documents, by difference-cover suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts in a document
with a smaller id.

0. Copies.  Equal texts (by two 64-bit hashes) are one row, under the smallest id; the
   others go whole.
1. Deal.  Every string of LENGTH bytes has a minimizer: the 16 bytes in it with the
   least hash.  Equal strings have equal minimizers, so suffixes are dealt to buckets
   by the minimizer of their first LENGTH bytes.  A run of neighbouring strings with
   one minimizer travels as one piece.  A first pass sends hashes only; runs whose
   minimizer stands in one row alone cannot match and stay where they are.
2. Sort.  Each bucket builds the suffix array of its distinct pieces by a difference
   cover modulo 3: sort the sampled triples, recurse on their names, sort the rest by
   first symbol and rank, merge.
   Pieces that agree with no other on either side of their minimizer are left out.
3. Compare.  Neighbours in the suffix array with LENGTH equal bytes are one string;
   each holder but the smallest id loses it.  Equal pieces are compared as one.
4. The covered stretches of each document are merged and cut out.

Buckets grow in number with the corpus's bytes.  A batch of rows sends each minimizer
once and of equal pieces those of its smallest document only (the others go whole), so
what stands in a share of all documents comes to its bucket once a batch of BATCH_ROWS.  Very long texts are cut in
parts that overlap.  Null and empty texts have no bytes.  Rows with one id never remove
from each other; rows with a null id are left whole and remove nothing, and their id
stays null.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, named, renamed, small_batches, stored
from .near_dedup import whole_units

LENGTH = 50
GRAM = 16
#: Bytes of text for each bucket, and the least number of buckets.
PER_BUCKET, LEAST_BITS = 6_000_000, 8
#: Bytes of text worked on together.
CHUNK = 1_000_000
#: Bits of a minimizer's hash; beneath them stands its position in the chunk.
HASH_BITS, PLACE = 40, 24
#: Bytes of a minimizer on its way: rest of the hash, place of the row in its batch, and (not on the way back) the row.
SENT, BACK = 4 + 2 + 8, 4 + 2
#: The place of a minimizer that several rows of a batch have.
SEVERAL = 0xFFFF
META = np.dtype([("doc", "<i8"), ("row", "<i8"), ("start", "<u4"), ("size", "<u4"), ("gram", "<u4")])


def minimizers(text: np.ndarray, length: int) -> np.ndarray:
    """For each start of a `length`-byte string: hash << PLACE | position of its minimizer."""
    h = mix(np.arange(1, 257, dtype=np.uint64))[text]
    k = 1
    while k < GRAM:
        h = h[:-k] * np.uint64(0x9E3779B97F4A7C15 + 2 * k) + (h[k:] ^ (h[k:] >> np.uint64(29)))
        k *= 2
    low = (mix(h) >> np.uint64(64 - HASH_BITS) << np.uint64(PLACE)) | np.arange(len(h), dtype=np.uint64)
    span, want = 1, length - GRAM + 1
    while span < want:
        step = min(span, want - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    return low


def runs(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, first start, starts, hash, the minimizer's offset) of runs of strings with one minimizer."""
    at = 0
    while at < len(texts):
        upto, held = at, 0
        while upto < len(texts) and (upto == at or held + len(texts[upto]) <= CHUNK):
            held += len(texts[upto])
            upto += 1
        if held > 8 * CHUNK:  # one very long text: in parts that overlap
            whole, step = texts[at], 8 * CHUNK
            for s in range(0, len(whole) - length + 1, step):
                for own, start, *rest in runs_of([whole[s : s + step + length - 1]], length):
                    yield own + at, start + s, *rest
        else:
            for own, *rest in runs_of(texts[at:upto], length):
                yield own + at, *rest
        at = upto


def runs_of(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    joined = np.frombuffer(b"".join(texts), np.uint8)
    if len(joined) < length:
        return
    low = minimizers(joined, length)
    sizes = np.array([len(t) for t in texts])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(low)]
    inside = np.arange(len(low)) + length <= (begins + sizes)[owner]
    at = np.flatnonzero(inside)
    if not len(at):
        return
    first = np.ones(len(at), bool)
    first[1:] = (low[at[1:]] != low[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]]) | (at[1:] != at[:-1] + 1)
    heads = np.flatnonzero(first)
    starts = at[heads]
    yield owner[starts], starts - begins[owner[starts]], np.diff(np.append(heads, len(at))), low[starts] >> np.uint64(PLACE), (low[starts] & np.uint64((1 << PLACE) - 1)).astype(np.int64) - starts


def passed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of sorted a how many of sorted b are less, for each of b how many of a are not greater."""
    at = np.empty(len(a) + len(b), np.int64)
    at[np.argsort(np.concatenate([a, b]), kind="stable")] = np.arange(len(at))  # one merge of two runs
    return at[: len(a)] - np.arange(len(a)), at[len(a) :] - np.arange(len(b))


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Order of all suffixes of t (non-negative integers), by a difference cover modulo 3."""
    n = len(t)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: t[i:].tolist()), np.int64)
    top = int(t.max()) + 2
    s = np.concatenate([t.astype(np.int64) + 1, np.zeros(3, np.int64)])
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    if top < 1 << 20:
        triple = (s[sample] * top + s[sample + 1]) * top + s[sample + 2]
        order = np.argsort(triple)
        fresh = np.diff(triple[order]) != 0
    else:
        order = np.lexsort((s[sample + 2], s[sample + 1], s[sample]))
        o = sample[order]
        fresh = (s[o[1:]] != s[o[:-1]]) | (s[o[1:] + 1] != s[o[:-1] + 1]) | (s[o[1:] + 2] != s[o[:-1] + 2])
    names = np.empty(len(sample), np.int64)
    names[order] = np.concatenate([[0], np.cumsum(fresh)])
    if fresh.all():
        sorted_sample = sample[order]
    else:  # the names of the first residue end in an odd one out, so the two parts do not mix
        sorted_sample = sample[suffix_array(names)]
    rank = np.zeros(n + 4, np.int64)
    rank[sorted_sample] = np.arange(1, len(sample) + 1)
    zero = np.arange(0, n, 3)
    wide = len(sample) + 2
    key1 = lambda i: s[i] * wide + rank[i + 1]
    zero = zero[np.argsort(key1(zero))]
    # beside residue 1 the order is (symbol, rank); beside residue 2 (symbol, symbol, rank)
    z1 = key1(zero)
    code = np.concatenate([s[zero] * (top + 1) + s[zero + 1], s[two] * (top + 1) + s[two + 1]])
    if (top + 1) ** 2 * wide >= 1 << 63:  # too wide to stand above a rank
        code = np.unique(code, return_inverse=True)[1]
    z2 = code[: len(zero)] * wide + rank[zero + 2]
    second = code[len(zero) :] * wide + rank[two + 2]
    of_two = np.empty(n + 3, np.int64)
    of_two[two] = second
    first = sorted_sample[sorted_sample % 3 == 1]
    other = sorted_sample[sorted_sample % 3 == 2]
    place = np.empty(n + 3, np.int64)
    before = np.empty(n + 3, np.int64)
    less_one, before[first] = passed(z1, key1(first))
    less_two, before[other] = passed(z2, of_two[other])
    place[zero] = np.arange(len(zero)) + less_one + less_two
    place[sorted_sample] = np.arange(len(sample)) + before[sorted_sample]
    ends = first[first >= n]  # the odd one out is no suffix
    keep = np.concatenate([zero, sorted_sample[sorted_sample < n]])
    out = np.full(n + len(ends), -1, np.int64)
    out[place[keep]] = keep
    return out[out >= 0]


def smallest_holders(pieces: list[bytes], docs: np.ndarray, length: int) -> list[np.ndarray]:
    """For each piece and each start in it: the smallest doc whose piece holds the same string."""
    sizes = np.array([len(p) for p in pieces]) + 1
    text = np.full(sizes.sum(), 256, np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for b, p in zip(begins.tolist(), pieces):
        text[b : b + len(p)] = np.frombuffer(p, np.uint8)
    order = suffix_array(text)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    valid = np.arange(len(text)) + length <= (begins + sizes - 1)[owner]
    order = order[valid[order]]
    same = np.arange(len(order) - 1)
    step = min(length, 8)  # neighbours that still agree, eight bytes at a time
    words = np.lib.stride_tricks.sliding_window_view(text.astype(np.uint8), step)
    words = np.ascontiguousarray(words) if step < 8 else np.ascontiguousarray(words).view(np.uint64)
    for k in [*range(0, length - step, step), length - step]:
        same = same[(words[order[same] + k] == words[order[same + 1] + k]).all(axis=1)]
    new = np.ones(len(order), bool)
    new[same + 1] = False
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(docs[owner[order]], np.flatnonzero(new)) if len(order) else docs[:0]
    got = np.full(len(text), np.iinfo(np.int64).max)
    got[order] = least[group]
    return [got[b : b + n - length] for b, n in zip(begins.tolist(), sizes.tolist())]


def alike(pieces: list[bytes], grams: list[int], length: int) -> list[int]:
    """Numbers of the pieces that can share a string with another one.

    A shared string holds the minimizer and, on its left or on its right, at least half of
    the remaining bytes: one of these two sides, minimizer included, must stand in both pieces.
    """
    half = (length - GRAM + 1) // 2
    sides = [{p[g - half : g + GRAM] if g >= half else b"", p[g : g + GRAM + half] if len(p) >= g + GRAM + half else b""} - {b""} for p, g in zip(pieces, grams)]
    held = Counter(x for own in sides for x in own)
    return [i for i, own in enumerate(sides) if any(held[x] > 1 for x in own)]


def lost(meta: np.ndarray, text: bytes, length: int) -> pd.DataFrame:
    """row, start, end of bytes that go, from a bucket's pieces."""
    ends = np.cumsum(meta["size"].astype(np.int64))
    pieces: dict[bytes, list[int]] = {}
    for i, (e, n) in enumerate(zip(ends.tolist(), meta["size"].tolist())):
        pieces.setdefault(text[e - n : e], []).append(i)
    content, owners = list(pieces), list(pieces.values())
    doc, gram = meta["doc"].tolist(), meta["gram"].tolist()
    least = [min(map(doc.__getitem__, own)) for own in owners]
    # (piece, first byte, end) of what goes: whole pieces that a smaller id holds, parts of the others
    whole = np.array([i for own, d in zip(owners, least) for i in own if doc[i] > d], np.int64)
    parts: list[tuple[int, int, int]] = []
    several = alike(content, [gram[own[0]] for own in owners], length)
    if several:
        held = smallest_holders([content[i] for i in several], np.array([least[i] for i in several]), length)
        for i, got in zip(several, held):
            gone = np.flatnonzero(got < least[i])
            if len(gone):
                cut = np.flatnonzero(np.diff(gone) > 1)
                for a, b in zip(gone[np.append(0, cut + 1)].tolist(), gone[np.append(cut, len(gone) - 1)].tolist()):
                    parts.extend((j, a, b + length) for j in owners[i] if doc[j] == least[i])
    part = np.array(parts, np.int64).reshape(-1, 3)
    at = np.concatenate([whole, part[:, 0]])
    begin = meta["start"][at].astype(np.int64)
    size = meta["size"][whole].astype(np.int64)
    first, end = np.concatenate([0 * size, part[:, 1]]), np.concatenate([size, part[:, 2]])
    return pd.DataFrame({"row": meta["row"][at], "start": begin + first, "end": begin + end})


def settled(meta: np.ndarray, pieces: list[bytes]) -> np.ndarray:
    """Which pieces go on: of equal ones those of the smallest doc, as the others go whatever more is found."""
    least: dict[bytes, int] = {}
    docs = meta["doc"].tolist()
    for p, d in zip(pieces, docs):
        if least.setdefault(p, d) > d:
            least[p] = d
    return np.array([least[p] == d for p, d in zip(pieces, docs)], bool)


def planes(meta: np.ndarray) -> bytes:
    """The bytes of all records by their place in a record, which compresses better."""
    return meta.view(np.uint8).reshape(len(meta), META.itemsize).T.tobytes()


def records(data: bytes) -> np.ndarray:
    """What `planes` was given."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(META.itemsize, -1).T).view(META).ravel()


def as_bytes(values: list) -> list[bytes]:
    return [b"" if v is None else v.encode("utf-8", "surrogatepass") for v in values]


def suspects(docs: DataFrame, bits: int, length: int) -> DataFrame:
    """row, keys: minimizers of each row that other rows have too.

    A batch sends each minimizer once; one that several of its rows have is known to be
    shared, and is sent only so that other batches learn of it.  So a minimizer that stands
    in a share of all rows comes to its bucket once a batch.
    """
    small_mask = (1 << bits) - 1

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        batch = TaskContext.get().partitionId() << 32
        for b in batches:
            b = b.drop_duplicates("row")  # equal texts, equal numbers
            rows = b["row"].to_numpy().astype("<i8")
            parts = [(key, own) for own, _, _, key, _ in runs(as_bytes(b["text"].tolist()), length)]
            key, place = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            order = np.lexsort((place, key))
            key, place = key[order], place[order]
            once = np.ones(len(key), bool)
            once[1:] = (key[1:] != key[:-1]) | (place[1:] != place[:-1])
            key, place = key[once], place[once]
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
            several = np.diff(np.append(heads, len(key))) > 1
            local = np.repeat(several, np.diff(np.append(heads, len(key))))
            known = np.array([len(rows), local.sum()], "<i8").tobytes() + rows.tobytes() + key[local].astype("<u8").tobytes() + place[local].astype("<u2").tobytes()
            first, row = key[heads], rows[place[heads]]
            where = np.where(several, SEVERAL, place[heads]).astype("<u2")
            order = np.argsort(first & np.uint64(small_mask), kind="stable")
            bucket, rest, where, row = (first & np.uint64(small_mask))[order], (first >> np.uint64(bits)).astype("<u4")[order], where[order], row[order]
            cut = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)] if len(bucket) else [0]
            data = [rest[x:y].tobytes() + where[x:y].tobytes() + row[x:y].tobytes() for x, y in zip(cut, cut[1:])]
            yield pd.DataFrame({"key": [-1 - batch, *bucket[cut[:-1]].tolist()], "batch": batch, "data": [known, *data]})
            batch += 1

    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in whole_units(batches, ["key"], 1):
            if p["key"].iloc[-1] < 0:
                yield p
                continue
            for key, q in p.groupby("key"):
                if key < 0:
                    yield q
                    continue
                counts = [len(v) // SENT for v in q["data"]]
                rest = np.concatenate([np.frombuffer(v, "<u4", n) for v, n in zip(q["data"], counts)])
                place = np.concatenate([np.frombuffer(v, "<u2", n, 4 * n) for v, n in zip(q["data"], counts)])
                row = np.concatenate([np.frombuffer(v, "<i8", n, 6 * n) for v, n in zip(q["data"], counts)])
                if not len(rest):
                    continue
                whose = np.repeat(np.arange(len(q)), counts)
                order = np.argsort(rest, kind="stable")
                r, w = rest[order], row[order]
                heads = np.concatenate([[0], np.flatnonzero(np.diff(r)) + 1])
                many = (np.minimum.reduceat(w, heads) != np.maximum.reduceat(w, heads)) | (np.maximum.reduceat(place[order], heads) == SEVERAL)
                hit = order[np.repeat(many, np.diff(np.append(heads, len(r))))]
                hit = np.sort(hit[place[hit] != SEVERAL])
                if not len(hit):
                    continue
                groups = np.split(hit, np.flatnonzero(np.diff(whose[hit])) + 1)
                yield pd.DataFrame({"key": key, "batch": q["batch"].to_numpy()[[whose[g[0]] for g in groups]], "data": [rest[g].tobytes() + place[g].tobytes() for g in groups]})

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in whole_units(batches, ["batch"], 1):
            for _, q in p.groupby("batch"):
                is_ids = (q["key"] < 0).to_numpy()
                known = q["data"].to_numpy()[is_ids][0]
                n, m = np.frombuffer(known, "<i8", 2).tolist()
                rows = np.frombuffer(known, "<i8", n, 16)
                keys, own = [np.frombuffer(known, "<u8", m, 16 + 8 * n)], [np.frombuffer(known, "<u2", m, 16 + 8 * (n + m)).astype(np.int64)]
                q = q[~is_ids]
                for key, v in zip(q["key"].tolist(), q["data"]):
                    n = len(v) // BACK
                    keys.append(np.frombuffer(v, "<u4", n).astype(np.uint64) << np.uint64(bits) | np.uint64(key))
                    own.append(np.frombuffer(v, "<u2", n, 4 * n).astype(np.int64))
                keys, own = np.concatenate(keys), np.concatenate(own)
                if not len(keys):
                    continue
                order = np.lexsort((keys, own))
                keys, own = keys[order], own[order]
                cut = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1])
                yield pd.DataFrame({"row": rows[own[cut]], "keys": [np.unique(k).tobytes() for k in np.split(keys, cut[1:])]})

    schema = "key long, batch long, data binary"
    dealt = docs.mapInPandas(hashes, schema).repartition("key").sortWithinPartitions("key")
    again = dealt.mapInPandas(shared, schema).repartition("batch").sortWithinPartitions("batch")
    return again.mapInPandas(gather, "row long, keys binary")


def squeezed(docs: DataFrame) -> DataFrame:
    """The same rows with their texts as compressed bytes, for the way to another task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(1).compress
        for b in batches:
            yield b.assign(text=[pack(t) for t in as_bytes(b["text"].tolist())])

    # both joins on row see the same exchange: neither may add a filter of its own below it
    return docs.select("doc_id", "nameless", "row", "text").mapInPandas(run, "doc_id long, nameless boolean, row long, text binary").where("row is not null")


def stretches(docs: DataFrame, texts: DataFrame, firsts: DataFrame, bits: int, length: int) -> DataFrame:
    """row, start, end: byte stretches that go from the first of equal texts; they may overlap."""
    flagged = stored(suspects(docs, bits, length), "suspects").groupBy("row").agg(F.first("keys").alias("keys")).join(firsts, "row")
    mask = np.uint64((1 << bits) - 1)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pack, unpack = zstandard.ZstdCompressor(1).compress, zstandard.ZstdDecompressor().decompress
            texts = list(map(unpack, b["text"]))
            rows, ids = b["row"].to_numpy(), b["doc_id"].to_numpy().astype(np.int64)
            known = [np.frombuffer(k, np.uint64) for k in b["keys"]]  # ascending
            metas, buckets, slices = [np.empty(0, META)], [np.empty(0, np.int64)], []
            for own, start, n, key, gram in runs(texts, length):
                hits, at = [], 0
                for c in np.append(np.flatnonzero(np.diff(own)) + 1, len(own)).tolist():
                    k = known[own[at]]
                    hits.append(np.flatnonzero(k[np.minimum(np.searchsorted(k, key[at:c]), len(k) - 1)] == key[at:c]) + at)
                    at = c
                i = np.concatenate(hits)
                m = np.empty(len(i), META)
                m["doc"], m["row"], m["start"], m["size"], m["gram"] = ids[own[i]], rows[own[i]], start[i], n[i] + length - 1, gram[i]
                metas.append(m)
                buckets.append((key[i] & mask).astype(np.int64))
                slices += [texts[o][s:e] for o, s, e in zip(own[i].tolist(), start[i].tolist(), (start[i] + n[i] + length - 1).tolist())]
            meta, bucket = np.concatenate(metas), np.concatenate(buckets)
            stays = settled(meta, slices)
            if not stays.all():  # negative keys: what goes, known here
                gone = meta[~stays]
                begin = gone["start"].astype(np.int64)
                yield pd.DataFrame({"key": [-1 - int(rows[0] & 0xFFFF)], "meta": [np.array([gone["row"], begin, begin + gone["size"]], "<i8").tobytes()], "text": [b""]})
                meta, bucket, slices = meta[stays], bucket[stays], [slices[j] for j in np.flatnonzero(stays).tolist()]
            order = np.argsort(bucket, kind="stable")
            groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []
            yield pd.DataFrame(
                {
                    "key": np.array([bucket[g[0]] for g in groups], np.int64),
                    "meta": [pack(planes(meta[g])) for g in groups],
                    "text": [pack(b"".join(slices[j] for j in g.tolist())) for g in groups],
                }
            )

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for p in whole_units(batches, ["key"], 1):
            for key, q in p.groupby("key"):
                if key < 0:
                    gone = np.concatenate([np.frombuffer(m, "<i8").reshape(3, -1) for m in q["meta"]], axis=1)
                    yield pd.DataFrame({"row": gone[0], "start": gone[1], "end": gone[2]})
                    continue
                meta = np.concatenate([records(unpack(m)) for m in q["meta"]])
                yield lost(meta, b"".join(map(unpack, q["text"])), length)

    pieces = texts.join(flagged, "row").where("not nameless and doc_id = first").select("row", "doc_id", "text", "keys").mapInPandas(cut, "key long, meta binary, text binary")
    return pieces.repartition("key").sortWithinPartitions("key").mapInPandas(sort, "row long, start long, end long")


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for i in np.argsort(starts, kind="stable").tolist():
        s, e = int(starts[i]), int(ends[i])
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; one row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = named(docs, "text").withColumns({"row": F.xxhash64("text"), "proof": F.xxhash64(F.lit(length), "text")})
    usable = docs.where(~F.col("nameless") & (F.octet_length("text") >= length))
    firsts = stored(usable.groupBy("row").agg(F.min("doc_id").alias("first"), F.min("proof").alias("least"), F.max("proof").alias("most"), F.sum(F.octet_length("text")).alias("bytes")), "firsts")
    bits = max(LEAST_BITS, ((firsts.agg(F.sum("bytes")).first()[0] or 0) // PER_BUCKET).bit_length())
    clash = firsts.where("least <> most").select("row")
    if clash.take(1):  # unequal texts under one number (a few pairs in 2 ** 32 texts): they go by the other hash
        other = [r["row"] for r in clash.collect()]
        docs = docs.withColumn("row", F.when(F.col("row").isin(other), F.col("proof")).otherwise(F.col("row")))
        usable = docs.where(~F.col("nameless") & (F.octet_length("text") >= length))
        firsts = stored(usable.groupBy("row").agg(F.min("doc_id").alias("first")), "firsts")
    firsts = firsts.select("row", "first")
    texts = squeezed(docs)
    gone = stretches(usable, texts, firsts, bits, length).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("gone"))
    gone = firsts.join(gone, "row", "left").select("row", "first", F.col("gone.start").alias("starts"), F.col("gone.end").alias("ends"))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            copy, whole = b["copy"].tolist(), b["nameless"].tolist()
            for text, s, e, again, apart in zip(map(unpack, b["text"]), b["starts"], b["ends"], copy, whole):
                spans = [] if apart else [(0, len(text))] if again else merged(np.asarray(s), np.asarray(e)) if s is not None else []
                kept, at = hashlib.sha256(), 0
                for x, y in spans:
                    kept.update(text[at:x])
                    at = y
                kept.update(text[at:])
                out.append((len(text), sum(y - x for x, y in spans), len(spans), kept.hexdigest()))
            yield pd.concat([b[["doc_id", "nameless"]].reset_index(drop=True), pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])], axis=1)

    copy = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False)).alias("copy")
    return renamed(texts.join(gone, "row", "left").select("doc_id", "nameless", "text", copy, "starts", "ends").mapInPandas(finish, "doc_id long, nameless boolean, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
