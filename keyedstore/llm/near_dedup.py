"""MinHash near-duplicate detection with sequential Bayesian verification.

1. Every document becomes its set of distinct word shingles (64-bit hashes).
   Documents with equal sets are one class, stood for by its smallest id, so
   copies cost one aggregation however many there are.
2. Class representatives get a MinHash signature; equal bands make candidates.
3. A bucket is compared in blocks of at most BLOCK members.  Signature batches are
   compared, and a pair is dropped as soon as the posterior probability (uniform
   prior) that its similarity reaches the threshold falls under `miss`.  A unit of
   work hands on which members hang together by surviving pairs, not the pairs.
4. The components are families.  A family is compared in blocks too, now
   with the full sets: pairs that share a band and survive the sequential test are
   verified exactly.  Each unit hands on which documents hang together by links.
5. The links' components are the result.

Of a bucket or family of over FEW members every one is first compared with a few leaders
near its middle; only members that then do not hang together with most of it are compared with
the whole, and no pair that hangs together already is compared again.  So a group of
copies of one text takes work by its size; one whose members are like neither each other
nor the leaders takes work by its pairs.  No candidate pair is left out.

Null, empty or blank texts have no shingles and link with nothing.  A text with
fewer words than the shingle width is one shingle.  Rows of one doc_id with different
texts are documents of their own with one name: each has the component of its text.  Rows with a null doc_id link with nothing: their
component_id is null and they are kept.  Extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, discard, mix, named, renamed, shingles, signed, small_batches, stored, word_hashes
from .components import components

BANDS, ROWS = 24, 5
SEED = 0x51ED270B
#: Signature values compared before the next look at the posterior.
STEP = 15
#: Members of a bucket, and documents of a family, in a block.
BLOCK, SET_BLOCK = 512, 128
#: Leaders of a large group in a round, rows that its middle is taken from, and rounds, at most.
LEADERS, PROBES, ROUNDS = 16, 64, 3
#: No further round where the rest is less than this share.
SETTLED = 0.2
#: Members of a group whose pairs of blocks are all compared, at most.
FEW = 4096
#: Sides of a unit: all of its pairs, or those of left and right.
WHOLE, LEFT, RIGHT = 0, 1, 2
#: Most cells of a membership matrix; beyond, pairs are merged one by one.
CELLS = 16_000_000
#: Posterior probability of reaching the threshold below which a pair is dropped.
MISS = 1e-5


def permutations() -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) + np.uint64(SEED))
    k = BANDS * ROWS
    return (x[:k] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (x[k:] >> np.uint64(32)).astype(np.uint32)


def signature(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each permutation over a set of hashes."""
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    v = (values >> np.uint64(32)).astype(np.uint32) ^ values.astype(np.uint32)
    for i in range(0, len(v), 512):  # a block stays in the processor's cache
        np.minimum(low, (v[i : i + 512, None] * a + b).min(axis=0), out=low)
    return low


@cache
def least_matches(total: int, step: int, threshold: float, miss: float) -> tuple[int, ...]:
    """After step, 2 step, ... values: the fewest matches with P(s >= threshold | matches) >= miss."""
    grid = (np.arange(4000) + 0.5) / 4000
    out = []
    for n in range(step, total + 1, step):
        for m in range(n + 1):
            logs = m * np.log(grid) + (n - m) * np.log1p(-grid)
            w = np.exp(logs - logs.max())
            if w[grid >= threshold].sum() / w.sum() >= miss:
                break
        out.append(m)
    return tuple(out)


def key_of_set(s: np.ndarray) -> bytes:
    """Equal for equal sets: two 64-bit sums of the elements' hashes, and the size."""
    two = (np.bitwise_xor.reduce(mix(s)), mix(s * np.uint64(0x9E3779B97F4A7C15)).sum()) if len(s) else (0, 0)
    return np.array([*two, len(s)], np.uint64).tobytes()


def shingle_rows(docs: DataFrame, width: int, full: bool) -> DataFrame:
    """doc_id with the set's key and size and either its signature or (full) the set."""
    a, b = permutations()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = WordHashes()
        for batch in batches:
            keys, sizes, values = [], [], []
            for text in batch["text"].tolist():
                s = np.unique(shingles(word_hashes(text, seen), width))
                sizes.append(len(s))
                keys.append(key_of_set(s))
                values.append(s.tobytes() if full else signature(s, a, b).tobytes() if len(s) else b"")
            yield pd.DataFrame({"doc_id": batch["doc_id"], "nameless": batch["nameless"], "n_shingles": sizes, "value": values, "set_key": keys})

    return renamed(named(docs, "text").mapInPandas(run, "doc_id long, nameless boolean, n_shingles long, value binary, set_key binary"))


def explode_bands(classes: DataFrame) -> DataFrame:
    """(band, bucket, id) of every class."""
    size = 4 * ROWS
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(i.alias("band"), F.xxhash64(F.col("sig").substr(i * size + 1, F.lit(size))).alias("bucket")))
    return classes.select("id", F.explode(bands).alias("x")).select("x.band", "x.bucket", "id")


def survivors(sigs: np.ndarray, i: np.ndarray, j: np.ndarray, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the pair list (i, j) that pass the sequential test, and their matches."""
    alive, got = np.arange(len(i)), np.zeros(len(i), np.int64)
    for at, need in enumerate(least):
        span = slice(at * STEP, (at + 1) * STEP)
        got = got + (sigs[i[alive], span] == sigs[j[alive], span]).sum(axis=1)
        ok = got >= need
        alive, got = alive[ok], got[ok]
    return alive, got


class Forest:
    """Joins numbers; says whether a join was new."""

    def __init__(self, n: int):
        self.root = list(range(n))

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        self.root[max(a, b)] = min(a, b)
        return a != b

    def stars(self, names: np.ndarray) -> pd.DataFrame:
        """(a, b): each name with the first of its tree, where that is another."""
        roots = np.array([self.find(i) for i in range(len(names))], int)
        tied = roots != np.arange(len(names))
        return pd.DataFrame({"a": names[roots[tied]], "b": names[tied]}, dtype="int64")


def pairs_of(p: pd.DataFrame, s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the rows s to e, a unit: of its left and right sides, or all of a unit without sides."""
    side = p["side"].to_numpy()[s:e]
    if side[0] == WHOLE:
        i, j = np.triu_indices(e - s, 1)
        return i + s, j + s
    left, right = np.flatnonzero(side == LEFT) + s, np.flatnonzero(side == RIGHT) + s
    i, j = np.repeat(left, len(right)), np.tile(right, len(left))
    ids, tree, rest = p["id"].to_numpy(), p["tree"].to_numpy(), p["rest"].to_numpy()
    # pairs that hang together already are settled; two of the rest meet twice
    keep = (ids[i] != ids[j]) & (tree[i] != tree[j]) & (~rest[j] | (ids[i] < ids[j]))
    return i[keep], j[keep]


def numbered(p: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, those of left sides first and then ascending, and each row's number among them."""
    names, number = np.unique(p["id"].to_numpy(), return_inverse=True)
    later = np.ones(len(names), bool)
    later[number[p["side"].to_numpy() == LEFT]] = False
    order = np.lexsort((names, later))
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    return names[order], place[number]


def batches_of_pairs(p: pd.DataFrame, keys: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of all units, some 400,000 at a time."""
    held, n = [], 0
    for s, e in unit_bounds(p, keys):
        held.append(pairs_of(p, s, e))
        n += len(held[-1][0])
        if n > 400_000:
            yield tuple(map(np.concatenate, zip(*held)))
            held, n = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def whole_units(batches: Iterator[pd.DataFrame], keys: list[str], rows: int = 4000) -> Iterator[pd.DataFrame]:
    """Sorted rows regrouped so that no unit is cut; frames of some `rows` rows or one unit."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        k = b[keys].to_numpy()
        cut = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        if held and (held[-1][keys].to_numpy()[-1] != k[0]).any():
            cut = np.concatenate([[0], cut])
        if len(cut) and sum(map(len, held)) + cut[-1] >= rows or len(cut) and sum(map(len, held)) >= rows:
            held.append(b.iloc[: cut[-1]])
            yield pd.concat(held, ignore_index=True)
            held = [b.iloc[cut[-1] :]]
        else:
            held.append(b)
    if held:
        yield pd.concat(held, ignore_index=True)


def unit_bounds(p: pd.DataFrame, keys: list[str]) -> list[tuple[int, int]]:
    k = p[keys].to_numpy()
    starts = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1])
    return list(zip(starts.tolist(), np.append(starts[1:], len(p)).tolist()))


def typical(p: pd.DataFrame) -> np.ndarray:
    """The most frequent value at each place of some signatures."""
    sigs = np.frombuffer(b"".join(p["sig"]), np.uint32).reshape(len(p), -1)
    out = np.empty(sigs.shape[1], np.uint32)
    for k in range(len(out)):
        values, counts = np.unique(sigs[:, k], return_counts=True)
        out[k] = values[counts.argmax()]
    return out


def connected(members: DataFrame, payload: DataFrame, group: list[str], block: int, compare: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    """A forest (a, b) that connects whatever pairs of a group `compare` accepts.

    members: group, id; payload: id, sig and what else `compare` wants.  A group is cut to
    blocks of some `block` members, and each pair of blocks is a unit.  Of a group of over
    FEW members, those nearest to its typical signature are its leaders, and each block
    is compared with them.  What hangs together
    with most of the group then is settled; the rest is compared with the whole group, block
    by block, but for pairs that hang together already.  So a group of copies of one text
    takes work by its size, and no pair is left out.
    """
    keys, extra = [*group, "l", "r"], [c for c in payload.columns if c != "id"]
    columns = [*group, "l", "r", "side", "id", "tree", "rest", *extra]
    sizes = stored(members.groupBy(*group).agg(F.count("*").alias("members")).where("members > 1"), "sizes")
    work = members.join(sizes, group).join(payload, "id")
    no_tree = {"tree": F.col("id"), "rest": F.lit(False)}

    def units(df: DataFrame) -> DataFrame:
        return compare(df.select(*columns).repartition(*keys).sortWithinPartitions(*keys), keys)

    blocks = F.ceil(F.col("members") / block).cast("int")
    few = work.where(F.col("members") <= FEW).withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    side = F.when(F.col("own") == F.col("other"), WHOLE).when(F.col("own") < F.col("other"), LEFT).otherwise(RIGHT)
    whole = few.withColumns({"l": F.least("own", "other"), "r": F.greatest("own", "other"), "side": side} | no_tree)
    links = stored(units(whole), "pairs")
    if sizes.where(F.col("members") > FEW).isEmpty():
        return links
    big = stored(work.where(F.col("members") > FEW).withColumn("r", F.pmod(F.xxhash64("id"), blocks).cast("int")), "large")
    rest = big
    for _ in range(ROUNDS):
        chosen = leaders(rest, group)
        # every block meets every leader
        led = chosen.join(payload, "id").join(sizes, group).withColumn("r", F.explode(F.sequence(F.lit(0), blocks - 1)))
        sides = big.withColumn("side", F.lit(RIGHT)).withColumns({"l": F.lit(0)} | no_tree).select(*columns).union(led.withColumns({"l": F.lit(0), "side": F.lit(LEFT)} | no_tree).select(*columns))
        before, links = links, stored(links.union(units(sides)).distinct(), "pairs")
        discard(before)
        trees = components(links).select("id", F.col("component").alias("tree"))
        tagged = stored(big.select(*group, "id").join(trees, "id", "left").withColumn("tree", F.coalesce("tree", "id")), "trees")
        most = tagged.groupBy(*group, "tree").agg(F.count("*").alias("n")).groupBy(*group).agg(F.max(F.struct("n", "tree")).alias("top"), F.sum("n").alias("all"))
        most = stored(most.select(*group, F.col("top.tree").alias("main"), (F.col("all") - F.col("top.n")).alias("others"), "all").where("others > 0"), "rest")
        left = most.agg(F.sum("others"), F.sum("all")).first()
        if not left[0]:
            return links
        tagged = tagged.join(most.drop("all"), group)
        if left[0] < SETTLED * left[1]:
            break
        rest = stored(big.join(tagged.where("tree <> main").select(*group, "id"), [*group, "id"], "left_semi"), "others")
    lefts = F.ceil(F.col("others") / block).cast("int")
    whole = big.join(tagged.select(*group, "id", "tree", "others", (F.col("tree") != F.col("main")).alias("rest")), [*group, "id"])
    right = whole.withColumns({"side": F.lit(RIGHT), "l": F.explode(F.sequence(F.lit(0), lefts - 1))})
    ours = whole.where("rest").withColumns({"side": F.lit(LEFT), "l": F.pmod(F.xxhash64("id"), lefts).cast("int")}).withColumn("r", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return stored(links.union(units(right.select(*columns).union(ours.select(*columns)))), "pairs")


def leaders(rest: DataFrame, group: list[str]) -> DataFrame:
    """group, id: up to LEADERS members of each group of `rest` that are nearest to its typical signature."""
    key = ", ".join(f"{c} {t}" for c, t in rest.select(*group).dtypes)
    some = rest.join(rest.groupBy(*group).agg(F.ceil(F.count("*") / PROBES).alias("each")), group).where(F.pmod(F.xxhash64(F.lit("probe"), "id"), "each") == 0)

    def middle(p: pd.DataFrame) -> pd.DataFrame:
        return p[group].iloc[:1].assign(middle=typical(p).tobytes())

    # some PROBES rows of each group
    middles = some.select(*group, "sig").groupBy(*group).applyInPandas(middle, f"{key}, middle binary")

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            if len(p):
                sigs, mids = (np.frombuffer(b"".join(p[c]), np.uint32).reshape(len(p), -1) for c in ("sig", "middle"))
                p = p.assign(near=(sigs == mids).sum(axis=1))
                yield p.sort_values("near").groupby([*group, "r"], sort=False).tail(1)[[*group, "r", "id", "near"]]

    best = rest.select(*group, "r", "id", "sig").join(middles, group).mapInPandas(near, f"{key}, r int, id long, near long")
    return best.groupBy(*group, (F.col("r") % LEADERS).alias("slice")).agg(F.max(F.struct("near", "id")).alias("x")).select(*group, F.col("x.id").alias("id"))


def likely(members: DataFrame, classes: DataFrame, threshold: float, miss: float) -> DataFrame:
    """A forest (a, b) of pairs that share a bucket and pass the sequential test."""
    least = least_matches(BANDS * ROWS, STEP, threshold, miss)

    def compare(units: DataFrame, keys: list[str]) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in whole_units(batches, keys):
                sigs = np.frombuffer(b"".join(p["sig"]), np.uint32).reshape(len(p), -1)
                n = p["n"].to_numpy()
                names, number = numbered(p)
                forest = Forest(len(names))
                for i, j in batches_of_pairs(p, keys):
                    near = np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9
                    i, j = i[near], j[near]
                    alive, _ = survivors(sigs, i, j, least)
                    for x, y in zip(number[i[alive]].tolist(), number[j[alive]].tolist()):
                        forest.join(x, y)
                yield forest.stars(names)

        return units.mapInPandas(run, "a long, b long")

    return connected(members, classes.select("id", "sig", "n"), ["band", "bucket"], BLOCK, compare)


def common_sizes(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, settled: Callable[[int, int], bool]) -> Iterator[tuple[int, int, int]]:
    """(x, y, size of the intersection) for the pairs that are not settled by then, lazily."""
    if len(i) > 8:
        used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        some = [sets[k] for k in used]
        values, places = np.unique(np.concatenate(some), return_inverse=True)
        if len(values) * len(some) <= CELLS:
            m = np.zeros((len(some), len(values)), np.float32)
            m[np.repeat(np.arange(len(some)), [len(s) for s in some]), places] = 1
            common = m @ m.T
            yield from zip(i.tolist(), j.tolist(), common[at[: len(i)], at[len(i) :]].astype(int).tolist())
            return
    for x, y in zip(i.tolist(), j.tolist()):
        if not settled(x, y):
            yield x, y, len(np.intersect1d(sets[x], sets[y], assume_unique=True))


def verified(families: DataFrame, docs: DataFrame, classes: DataFrame, width: int, percent: int, miss: float) -> DataFrame:
    """A forest (a, b) of pairs with 100 * intersection >= percent * union of the full sets."""
    least = least_matches(BANDS * ROWS, STEP, percent / 100, miss)
    own = families.select("id", F.col("component").alias("family"))
    wanted = classes.join(own, "id", "left_semi").select("doc_id", "set_key", "id", "sig", "n")
    # a repeated doc_id may stand for several texts: the one of the class's key is taken
    sets = shingle_rows(docs.join(wanted.select("doc_id"), "doc_id", "left_semi"), width, True)
    sets = sets.select("doc_id", "set_key", F.col("value").alias("set")).join(wanted, ["doc_id", "set_key"]).select("id", "set", "sig", "n")
    sets = stored(sets.dropDuplicates(["id"]), "sets")

    def compare(units: DataFrame, keys: list[str]) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in whole_units(batches, keys, 200):
                sigs = np.frombuffer(b"".join(p["sig"]), np.uint32).reshape(len(p), -1)
                bands = sigs.reshape(len(p), BANDS, ROWS)
                sets = [np.frombuffer(s, np.uint64) for s in p["set"]]
                n = p["n"].to_numpy()
                names, number = numbered(p)
                forest = Forest(len(names))
                number = number.tolist()
                for s, e in unit_bounds(p, keys):
                    i, j = pairs_of(p, s, e)
                    alive, got = survivors(sigs, i, j, least)
                    i, j = i[alive], j[alive]
                    shares = np.concatenate([(bands[i[k : k + 4096]] == bands[j[k : k + 4096]]).all(axis=2).any(axis=1) for k in range(0, len(i), 4096)] or [np.zeros(0, bool)])
                    order = np.argsort(-got[shares], kind="stable")  # the likeliest first
                    i, j = i[shares][order], j[shares][order]
                    for x, y, common in common_sizes(sets, i, j, lambda x, y: forest.find(number[x]) == forest.find(number[y])):
                        if 100 * common >= percent * (n[x] + n[y] - common):
                            forest.join(number[x], number[y])
                yield forest.stars(names)

        return units.mapInPandas(run, "a long, b long")

    return connected(own, sets, ["family"], SET_BLOCK, compare)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    signed_docs = stored(shingle_rows(docs, width, False), "signatures")
    same = signed_docs.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min(F.struct("doc_id", "value", "n_shingles")).alias("x"))
    # a class's id is a number of its own: a doc_id may be that of several classes
    classes = stored(same.select(F.monotonically_increasing_id().alias("id"), "set_key", "x.doc_id", F.col("x.value").alias("sig"), F.col("x.n_shingles").alias("n")), "classes")
    # buckets with one member are most of all: they go before signatures are joined
    buckets = explode_bands(classes)
    shared = buckets.groupBy("band", "bucket").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("first", "last")
    members = stored(buckets.join(shared, ["band", "bucket"]), "members")
    families = components(likely(members, classes, percent / 100, miss).distinct())
    labels = components(verified(families, docs, classes, width, percent, miss).distinct())
    linked = classes.join(labels, "id")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    joined = linked.join(least, "component").select("set_key", "component_id").union(classes.join(labels, "id", "left_anti").select("set_key", F.col("doc_id").alias("component_id")))
    return (
        signed_docs.select("doc_id", "n_shingles", "set_key")
        .join(joined, "set_key", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
