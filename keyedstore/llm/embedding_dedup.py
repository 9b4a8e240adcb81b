"""Embedding near-duplicates over a robust-pruned flat graph.

1. Vectors that may link are grouped with their exact copies; one row of each
   group goes on with its number of copies.
2. At most TOP centroids, fitted on at most SAMPLE vectors, deal every vector to its
   `overlap` nearest shards within its label.  A shard of over MOST vectors is dealt on by
   centroids of its own, fitted by a task on some PROBES of its vectors, as long as it is
   wider than a group of links; what centroids there are is a table, and a task sees those
   of one shard.
3. A shard of over BLOCK vectors is cut into blocks and every pair of blocks is a unit of
   work, so no task holds an unbounded shard and none of its pairs is skipped.  Each unit
   builds a robust-pruned graph; the adjacency lists of a vector are united over its units.
4. Every vector searches its units' graph from the medoid and its own node.  The
   search widens as long as it meets vectors in range.  What it finds is verified
   by cosine in double precision.  In a shard that stays over MOST vectors nearly all are
   in range of nearly all: there a search would open them all, and blocks of EXACT_BLOCK
   are compared as they are.
5. A pair is counted in one unit only (the first shard both ends share), so units
   give counts and one connecting link a vector, never lists of pairs.
6. AUDIT queries (ids divisible by 20) and as many of those with links are compared by
   brute force with all rows; recall is the mean over the queries that have links.  While
   it is under the target the overlap grows and the work is done again.  What was measured
   is written to the shared folder (audit-*).  Without a link among all queries there is
   nothing to measure, and the record says so.
7. Beyond an overlap of WIDEST the pairs are found exactly: a vector is compared with
   all vectors of every shard that can hold one in range by the angle to its centroid,
   in blocks of EXACT_BLOCK.

A group of M unequal vectors in range of each other takes comparisons by its square (each
must be counted), in units of bounded size whose rows are M / EXACT_BLOCK copies of it.

Vectors that are null, empty, zero or hold null or non-finite components, and
those with a null label, link with nothing.  Vectors of different lengths are not
compared.  Repeated rows count as vectors of their own; rows of one id with different
vectors have their own links and components.  Rows with a null id link with nothing and
are kept; their component is null.  Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, sampled, stored
from .components import components

SAMPLE, TOP = 20_000, 256
PER_CENTROID = 600
#: Vectors of a shard that is not dealt on; vectors its own centroids are fitted on, their most, and how often shards are dealt on.
MOST, PROBES, BELOW, LEVELS = 4096, 1024, 64, 4
#: Vectors of a block, where graphs are built.
BLOCK = 256
OVERLAP = 3
#: The largest overlap; data whose audit still fails there are compared exactly.
WIDEST = 4 * OVERLAP
#: Vectors of a shard, most shards, and vectors of a block, of the exact way.
EXACT_SHARD, EXACT_SHARDS, EXACT_BLOCK = 4000, 8192, 2048
#: Slack of angles and their bounds against rounding, in radians.
SLACK = 1e-6
DEGREE = 16
CANDIDATES = 48
ALPHA = 1.2
BEAM = 24
AUDIT = 256
TARGET = 0.99

VECTORS = "id long, label string, dim int, copies long, vec binary"
GROUP = ["label", "dim", "shard"]


def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.maximum(size, 1e-12), c)
    return c


def unit(rows: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def robust_prune(x: np.ndarray, degree: int, alpha: float) -> list[list[int]]:
    """Each row's neighbours: the closest, without those that a kept one is closer to."""
    n = len(x)
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    many = min(CANDIDATES, n - 1)
    pool = np.argpartition(-sims, many - 1, axis=1)[:, :many] if many > 0 else np.zeros((n, 0), int)
    out: list[list[int]] = []
    for i in range(n):
        rest = pool[i][np.argsort(-sims[i, pool[i]])]
        own = 2 - 2 * sims[i, rest]  # squared distances
        kept: list[int] = []
        while len(rest) and len(kept) < degree:
            v = rest[0]
            kept.append(int(v))
            stay = alpha * alpha * (2 - 2 * sims[v, rest]) > own
            stay[0] = False
            rest, own = rest[stay], own[stay]
        out.append(kept)
    for i, kept in enumerate([list(k) for k in out]):  # edges both ways
        for v in kept:
            if i not in out[v] and len(out[v]) < 2 * degree:
                out[v].append(i)
    return out


def range_search(x: np.ndarray, graph: np.ndarray, start: int, at_least: float) -> np.ndarray:
    """Which rows each row finds in range, by greedy search that widens while in range; all rows search abreast."""
    n = len(x)
    sims = np.full((n, n), -2.0)  # -2: not seen yet
    opened = np.zeros((n, n), bool)
    new = np.stack([np.repeat(np.arange(n), 2), np.stack([np.full(n, start), np.arange(n)], 1).ravel()])
    rows = np.arange(n)
    while True:
        q, v = new
        for k in range(0, len(q), 1 << 16):
            i, j = q[k : k + (1 << 16)], v[k : k + (1 << 16)]
            sims[i, j] = np.einsum("nd,nd->n", x[i], x[j])
        seen = sims[rows]
        closed = opened[rows] | (seen == -2.0)
        last = np.partition(seen, n - BEAM, axis=1)[:, n - BEAM, None] if n > BEAM else -2.0
        open_ = np.where(closed | (seen < last), -3.0, seen)
        best = np.argpartition(-open_, 4, axis=1)[:, :4] if n > 4 else np.tile(np.arange(n), (len(rows), 1))
        todo = ~closed & (seen >= at_least)
        np.put_along_axis(todo, best, np.take_along_axis(todo, best, 1) | (np.take_along_axis(open_, best, 1) > -2.0), 1)
        q, v = np.nonzero(todo)
        if not len(q):
            return sims >= at_least
        q = rows[q]
        opened[q, v] = True
        pair = np.unique(q[:, None] * n + graph[v])
        pair = pair[sims.ravel()[pair] == -2.0]
        new = np.stack([pair // n, pair % n])
        rows = np.unique(q)  # what opened nothing is done


def fitted(vectors: DataFrame, each: int, most: int) -> dict[int, np.ndarray]:
    """For each vector length at most `most` centroids of at most SAMPLE vectors, `each` vectors a centroid."""
    count = max(1, math.ceil(vectors.count() / each))
    found: dict[int, list[bytes]] = {}
    for r in sampled(vectors.select("id", "dim", "vec"), SAMPLE, "id").toLocalIterator():
        found.setdefault(r["dim"], []).append(bytes(r["vec"]))
    return {d: k_means(unit(v), min(count, most)) for d, v in found.items()}


def nearest(x: np.ndarray, centroids: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, centroid) of each row's nearest centroids."""
    many = min(many, len(centroids))
    got = np.argsort(-(x @ centroids.T), axis=1, kind="stable")[:, :many]
    return np.repeat(np.arange(len(x)), many), got.ravel()


def shards(vectors: DataFrame, at_least: float, overlap: int) -> DataFrame:
    """vectors, each in every shard it is dealt to, with the list of these."""
    top = fitted(vectors, PER_CENTROID, TOP)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, p in b.groupby("dim"):
                x = unit(p["vec"].tolist())
                row, c = nearest(x, top.get(dim, x[:1] * 0), overlap)
                yield p.iloc[row].assign(shard=TOP + c)

    schema = f"{VECTORS}, shard long"
    rows, done = stored(vectors.mapInPandas(deal, schema), "dealt"), None
    for _ in range(LEVELS):
        sizes = stored(rows.groupBy(*GROUP).agg(F.count("*").alias("n")).where(F.col("n") > MOST), "sizes")
        if sizes.isEmpty():
            break
        rest = rows.join(sizes, GROUP, "left_anti").select(*rows.columns)
        done = rest if done is None else done.union(rest)
        large = rows.join(sizes, GROUP).withColumn("part", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / MOST)).cast("int"))
        again, tight = stored_split(deeper(large, sizes, at_least, max(1, overlap - 1)))
        done, rows = done.union(tight), again
    every = rows if done is None else done.union(rows)
    lists = every.groupBy("id").agg(F.sort_array(F.collect_list("shard")).alias("shards"))  # overlap at each level bounds it
    return stored(every.join(lists, "id"), "shards")


def stored_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to deal on, rows that stay) by the column `tight`."""
    whole = stored(df, "deeper")
    return whole.where("not tight").drop("tight"), whole.where("tight").drop("tight")


def deeper(large: DataFrame, sizes: DataFrame, at_least: float, overlap: int) -> DataFrame:
    """Rows of large shards in shards below them; those of a shard that is a group of links stay in it (tight)."""
    some = large.where(F.pmod(F.xxhash64(F.lit("probe"), "id"), F.ceil(F.col("n") / PROBES)) == 0)

    def fit(p: pd.DataFrame) -> pd.DataFrame:
        x = unit(p["vec"].tolist())
        middle = x.mean(axis=0)
        # the mean cosine of pairs is the squared length of the mean
        k = 1 if middle @ middle >= at_least - 0.01 else min(BELOW, max(2, math.ceil(int(p["n"].iloc[0]) / PER_CENTROID)), len(x))
        return p[GROUP].iloc[:1].assign(centroids=k_means(x, k).tobytes())

    own = some.select(*GROUP, "vec", "n").groupBy(*GROUP).applyInPandas(fit, "label string, dim int, shard long, centroids binary")
    own = own.join(sizes, GROUP).withColumn("part", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / MOST).cast("int") - 1)))

    def deal(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        columns = ["id", "label", "dim", "copies", "vec", "shard"]
        if not len(p) or not len(q):  # no probe of it: it is dealt on next time
            return p[columns].assign(tight=False)
        x = unit(p["vec"].tolist())
        centroids = np.frombuffer(q["centroids"].iloc[0]).reshape(-1, x.shape[1])
        if len(centroids) == 1:
            return p[columns].assign(tight=True)
        row, c = nearest(x, centroids, overlap)
        p = p.iloc[row]
        return p.assign(shard=p["shard"] * BELOW + c)[columns].assign(tight=False)

    keys = [*GROUP, "part"]
    return large.groupBy(*keys).cogroup(own.select(*keys, "centroids").groupBy(*keys)).applyInPandas(deal, f"{VECTORS}, shard long, tight boolean")


def earlier(lists: list[np.ndarray], shard: int) -> np.ndarray:
    """Which pairs share a shard before this one, where they are counted."""
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    value = np.concatenate(lists)
    row, value = row[value < shard], value[value < shard]
    some, number = np.unique(value, return_inverse=True)
    has = np.zeros((len(lists), len(some)), np.float32)
    has[row, number] = 1
    return has @ has.T > 0


def links(vectors: DataFrame, at_least: float, overlap: int) -> DataFrame:
    """vectors (id, label, dim, copies, vec) -> id, links, link: number of linked vectors, smallest id of the unit's component."""
    each = shards(vectors, at_least, overlap)
    sizes = stored(each.groupBy(*GROUP).agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    each = each.join(sizes, GROUP)
    keys = [*GROUP, "lo", "hi"]

    def units(df: DataFrame, block: int) -> DataFrame:
        blocks = F.ceil(F.col("n") / block).cast("int")
        df = df.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        return df.select("id", "label", "dim", "copies", "vec", "shards", "shard", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    work = units(each.where(F.col("n") <= MOST), BLOCK)

    def build(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("id")
        ids = p["id"].to_numpy()
        return pd.DataFrame({"id": ids, "near": [ids[k].tolist() for k in robust_prune(unit(p["vec"].tolist()), DEGREE, ALPHA)]})

    built = work.select("id", "vec", *keys).groupBy(*keys).applyInPandas(build, "id long, near array<long>")
    # MOST / BLOCK units in each of a vector's shards, at most
    united = stored(built.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")

    def search(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("id")
        ids = p["id"].to_numpy()
        x = unit(p["vec"].tolist())
        at = {v: i for i, v in enumerate(ids.tolist())}
        near = [[at[v] for v in a if v in at] for a in p["near"]]
        graph = np.array([a + [i] * (max(map(len, near)) + 1 - len(a)) for i, a in enumerate(near)])
        start = int((x @ x.mean(axis=0)).argmax())
        hit = range_search(x, graph, start, at_least)
        return counted(p, hit | hit.T)  # either end may find the other

    def compare(p: pd.DataFrame) -> pd.DataFrame:
        x = unit(p["vec"].tolist())
        return counted(p, x @ x.T >= at_least)

    def counted(p: pd.DataFrame, hit: np.ndarray) -> pd.DataFrame:
        ids, blocks = p["id"].to_numpy(), p["block"].to_numpy()
        np.fill_diagonal(hit, False)
        own = hit & (blocks[:, None] != blocks) if p["lo"].iloc[0] != p["hi"].iloc[0] else hit.copy()
        own &= ~earlier(list(p["shards"]), int(p["shard"].iloc[0]))
        total = (own @ p["copies"].to_numpy(np.float64)).astype(np.int64)
        link = ids.copy()
        linked = np.flatnonzero(hit.any(axis=1))
        hit, least = hit[np.ix_(linked, linked)], ids[linked]
        while len(linked):  # the least id spreads over the links
            spread = np.minimum(least, np.where(hit, least, np.iinfo(np.int64).max).min(axis=1))
            if (spread == least).all():
                break
            least = spread
        link[linked] = least
        return pd.DataFrame({"id": ids, "links": total, "link": link})

    result = "id long, links long, link long"
    found = work.join(united, "id").groupBy(*keys).applyInPandas(search, result)
    dense = sizes.where(F.col("n") > MOST)
    if dense.isEmpty():
        return found
    return found.union(units(each.where(F.col("n") > MOST), EXACT_BLOCK // 2).groupBy(*keys).applyInPandas(compare, result))


def angles(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Angles in radians; a centre of no length is at a right angle to all."""
    size = np.linalg.norm(centers, axis=1)
    return np.arccos(np.clip(x @ (centers / np.where(size > 0, size, 1)[:, None]).T, -1, 1))


def exact_links(vectors: DataFrame, at_least: float) -> DataFrame:
    """The same as `links`, of all pairs in range.

    A vector lives in its nearest shard.  If u lives in shard A and v is in range of u, the
    angle of v to A's centroid is at most A's radius and the range's angle together.  So v
    visits the shards before its own for which that holds, and each pair meets in one unit.
    """
    trees = fitted(vectors, EXACT_SHARD, EXACT_SHARDS)
    reach = math.acos(min(1.0, max(-1.0, at_least))) + SLACK

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, p in b.groupby("dim"):
                x = unit(p["vec"].tolist())
                far = angles(x, trees.get(dim, x[:1] * 0))
                yield p.assign(home=far.argmin(axis=1), angle=far.min(axis=1))[["id", "label", "dim", "copies", "vec", "home", "angle"]]

    at_home = stored(vectors.mapInPandas(settle, "id long, label string, dim int, copies long, vec binary, home int, angle double"), "homes")
    # as many as the tree has shards
    radius = {(r["dim"], r["home"]): r["radius"] for r in at_home.groupBy("dim", "home").agg(F.max("angle").alias("radius")).collect()}

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, p in b.groupby("dim"):
                x = unit(p["vec"].tolist())
                far = angles(x, trees.get(dim, x[:1] * 0))
                bound = np.array([radius.get((dim, s), -np.inf) for s in range(far.shape[1])]) + reach
                home = p["home"].to_numpy()
                near = (far <= bound) & (np.arange(far.shape[1]) < home[:, None])
                near[np.arange(len(p)), home] = True
                yield p.assign(shards=[np.flatnonzero(n).tolist() for n in near])[["id", "label", "dim", "copies", "vec", "home", "shards"]]

    group = ["label", "dim", "shard"]
    each = at_home.mapInPandas(visit, "id long, label string, dim int, copies long, vec binary, home int, shards array<int>")
    each = stored(each.select("id", "label", "dim", "copies", "vec", F.explode("shards").alias("shard"), "home").withColumn("lives", F.col("home") == F.col("shard")).drop("home"), "visits")
    # shards in which no vector of the label lives have no units
    sizes = each.groupBy(*group).agg(F.ceil(F.sum(F.col("lives").cast("long")) / EXACT_BLOCK).cast("int").alias("lefts"), F.ceil(F.count("*") / EXACT_BLOCK).cast("int").alias("rights")).where("lefts > 0")
    each = each.join(sizes, group)
    left = each.where("lives").withColumn("l", F.pmod(F.xxhash64("id"), "lefts").cast("int")).withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rights") - 1)))
    right = each.withColumn("r", F.pmod(F.xxhash64("id"), "rights").cast("int")).withColumn("l", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)))
    columns = ["id", "lives", "copies", "vec", *group, "l", "r"]
    work = left.select(*columns, F.lit(True).alias("is_left")).union(right.select(*columns, F.lit(False)))

    def compare(p: pd.DataFrame) -> pd.DataFrame:
        is_left = p["is_left"].to_numpy()
        a, b = p[is_left], p[~is_left]
        if not len(a) or not len(b):
            return pd.DataFrame({"id": a["id"], "links": 0, "link": a["id"]})
        i, j = a["id"].to_numpy(), b["id"].to_numpy()
        hit = unit(a["vec"].tolist()) @ unit(b["vec"].tolist()).T >= at_least
        hit &= ~b["lives"].to_numpy() | (i[:, None] < j)  # two that live here meet twice
        mine, theirs = hit @ b["copies"].to_numpy(np.float64), a["copies"].to_numpy(np.float64) @ hit
        x, y = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
        hit, of_x, of_y = hit[np.ix_(x, y)], i[x], j[y]
        while len(x):  # the least id spreads over the links
            to_y = np.minimum(of_y, np.where(hit, of_x[:, None], of_x.max()).min(axis=0))
            to_x = np.minimum(of_x, np.where(hit, to_y, to_y.max()).min(axis=1))
            if (to_x == of_x).all() and (to_y == of_y).all():
                break
            of_x, of_y = to_x, to_y
        link_i, link_j = i.copy(), j.copy()
        link_i[x], link_j[y] = of_x, of_y
        return pd.DataFrame({"id": np.append(i, j), "links": np.append(mine, theirs).astype(np.int64), "link": np.append(link_i, link_j)})

    return work.groupBy(*group, "l", "r").applyInPandas(compare, "id long, links long, link long")


def audit(vectors: DataFrame, found: DataFrame, at_least: float, overlap: int) -> float | None:
    """Mean share of a query's links that was found, by brute force among all rows; None if no query has a link.  Written down."""
    spark = vectors.sparkSession
    twenties = vectors.where("id % 20 = 0").select("id")
    linked = found.where("links > 0").select("id")
    ids = {r["id"] for some in (twenties, linked) for r in sampled(some, AUDIT, "id").collect()}
    asked = vectors.where(F.col("id").isin(sorted(ids))).collect() if ids else []  # 2 * AUDIT rows
    queries: dict[tuple, tuple[list[int], list[np.ndarray]]] = {}
    for r in asked:
        own = queries.setdefault((r["label"], r["dim"]), ([], []))
        own[0].append(r["id"])
        own[1].append(unit([bytes(r["vec"])])[0])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        true: dict[int, int] = {}
        for b in batches:
            for (label, dim), p in b.groupby(["label", "dim"]):
                if (label, dim) in queries:
                    names, q = queries[label, dim]
                    hit = (unit(p["vec"].tolist()) @ np.array(q).T >= at_least) & (p["id"].to_numpy()[:, None] != np.array(names))
                    for i, n in zip(names, (p["copies"].to_numpy(np.float64) @ hit).tolist()):
                        true[i] = true.get(i, 0) + int(n)
        yield pd.DataFrame({"id": list(true), "links": list(true.values())}, dtype="int64")

    true = vectors.mapInPandas(compare, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))
    real = {r["id"]: r["links"] for r in true.where("links > 0").collect()}
    got = {r["id"]: r["links"] for r in found.where(F.col("id").isin(sorted(ids))).collect()} if ids else {}
    recall = sum(min(1.0, got.get(i, 0) / n) for i, n in real.items()) / len(real) if real else None
    stored(spark.createDataFrame([(overlap, len(asked), len(real), recall)], "overlap int, queries int, queries_with_links int, recall double"), "audit")
    return recall


def embedding_duplicates(vectors: DataFrame, at_least: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per vector."""
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.transform("embedding", lambda v: v.cast("double") + 0.0).alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0) & finite & F.exists("x", lambda v: v != 0), F.lit(False))
    keyed = whole.withColumn("good", good).select("vec_id", "label", "good", F.when(good, F.col("x")).alias("x"), F.xxhash64("label", "x").alias("k1"), F.xxhash64(F.lit(1), "x", "label").alias("k2"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            arrays = [np.asarray(v, np.float64) for v in p["x"]]
            yield p.assign(vec=[a.tobytes() for a in arrays], dim=[len(a) for a in arrays])[["k1", "k2", "first", "label", "dim", "copies", "vec"]]

    grouped = keyed.where("good").groupBy("k1", "k2").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("x").alias("x"))
    classes = stored(grouped.mapInPandas(pack, "k1 long, k2 long, first long, label string, dim int, copies long, vec binary"), "vectors")
    # an id that stands for several vectors gets numbers of its own; the others keep theirs, which are the smallest of their class
    twice = classes.groupBy("first").agg(F.min(F.struct("k1", "k2")).alias("keeps"), F.count("*").alias("n")).where("n > 1").drop("n")
    if twice.take(1):
        low = classes.agg(F.min("first")).first()[0]
        spare = F.lit(min(low, 0)) - 1 - F.monotonically_increasing_id()
        id_ = F.when(F.col("keeps").isNull() | (F.struct("k1", "k2") == F.col("keeps")), F.col("first")).otherwise(spare)
        classes = stored(classes.join(twice, "first", "left").withColumn("id", id_).drop("keeps"), "vectors")
    else:
        classes = classes.withColumn("id", F.col("first"))
    plain = classes.select("id", "label", "dim", "copies", "vec")
    overlap = OVERLAP
    while True:
        exact = overlap > WIDEST
        rows = stored(exact_links(plain, at_least) if exact else links(plain, at_least, overlap), "links")
        found = rows.groupBy("id").agg(F.sum("links").alias("links"))
        recall = audit(plain, found, at_least, overlap)
        if exact or recall is None or recall >= TARGET:
            break
        discard(rows)
        overlap += OVERLAP
    labels = components(rows.where("link <> id").select(F.col("link").alias("a"), F.col("id").alias("b")).distinct())
    named = classes.select("k1", "k2", "id", "first", "copies").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    done = named.join(found, "id", "left").join(least, "component").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = keyed.select("vec_id", "good", "k1", "k2").join(done, ["k1", "k2"], "left")
    return out.select("vec_id", F.when(F.col("good"), F.col("n_links")).otherwise(F.lit(0)).alias("n_links"), F.when(F.col("good"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
