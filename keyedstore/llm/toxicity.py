"""Toxicity by maximum-scoring segments.

1. Token log-odds: class counts of each word and of its first letters come from a
   bounded sample of labelled rows (SAMPLE); a feature counts from LEAST rows on, and at
   most FEATURES are kept.  A word's rate has a Dirichlet prior
   centred on the rate of its first letters, and so on down to the corpus, so a
   new form of a known stem still scores.
2. A linear-time scan finds all maximal scoring segments of a text.
3. Extreme-value calibration: the best segment of n random clean tokens follows a
   Gumbel law in log n.  Its two parameters are fitted on clean sample rows scored
   by the other fold's counts; a text's evidence is the sum of its segments'
   scores beyond what chance gives in a text of that length.
4. A logistic curve, fitted on the same rows, turns evidence into a probability.

Labels, language, source and id are never inputs of a score.  Null and empty texts
have no evidence and get the curve's value there.  A very long text is scanned in one
pass, in time by its length.  Equal segments count each.  Label rows with a null id or
class are passed over, of repeated ones the highest class holds.  Repeated rows
are scored one by one; a null id stays null, with a null held_out.  Extra columns are
ignored (toxicity) or kept bit for bit (clean); an empty table gives no rows;
without usable labels every score is 0.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, kept_by_arrow, named, renamed, sampled, small_batches, stored

#: Labelled rows that the model is fitted on, at most.
SAMPLE = 40_000
#: Rows of the sample in which a word or stem must occur to be in the model, at least.
LEAST = 4
#: Words and stems of the model, at most: with more, those in the fewest rows go.
FEATURES = 1_000_000
STEMS = (4, 5, 6)
#: Pseudo-count of each Dirichlet prior.
PRIOR = 8.0
#: Taken off each token's log-odds, so that ordinary text drifts down.
DRIFT = 1.0
FOLDS = 2
TOKEN = re.compile(r"[^\W\d_]+")

Model = dict[str, float]


def fold_of(doc: int) -> int:
    """Which counts a sample row is kept out of; hashed, so that no order of ids matters."""
    return zlib.crc32(f"fold {doc}".encode()) % FOLDS


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def features(word: str) -> list[str]:
    """The word's stems from short to long, then the word."""
    return [f"{word[:n]}*" for n in STEMS if len(word) > n] + [word]


def log_odds(counts: dict[str, tuple[float, float]], totals: tuple[float, float]) -> Model:
    """feature -> log-odds against the corpus, each centred on the next shorter one."""
    base = (totals[1] + 0.5) / (totals[0] + totals[1] + 1)
    rates: dict[str, float] = {}

    def rate(chain: list[str]) -> float:
        if not chain:
            return base
        f = chain[-1]
        if f not in rates:
            clean, toxic = counts.get(f, (0.0, 0.0))
            rates[f] = (toxic + PRIOR * rate(chain[:-1])) / (clean + toxic + PRIOR)
        return rates[f]

    for f in counts:
        stem = f.rstrip("*")
        rate([f"{stem[:n]}*" for n in STEMS if n < len(stem)] + [f])
    return {f: math.log(r / (1 - r)) - math.log(base / (1 - base)) for f, r in rates.items() if f in counts}


class Scores(dict):
    """word -> token score; the longest known feature decides.  Bounded memory."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > 400_000:
            self.clear()
        get = self.model.get
        self[word] = s = next((x for f in reversed(features(word)) if (x := get(f)) is not None), 0.0) - DRIFT
        return s


def segments(scores: list[float]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, start, end), in linear time.

    Each open candidate holds the running sum before and after it, and the number of the
    nearest earlier one that starts lower.  A new one is joined to the nearest that starts
    lower unless that one also ends at least as high.  The numbers are followed rather than
    all candidates walked: whatever is jumped over starts no lower than what jumps, so it is
    never looked at again.
    """
    before: list[float] = []
    after: list[float] = []
    spans: list[tuple[int, int]] = []
    lower: list[int] = []
    total = 0.0
    for i, s in enumerate(scores):
        low, total = total, total + s
        if s <= 0:
            continue
        start, j = i, len(before) - 1
        while j >= 0 and before[j] >= low:
            j = lower[j]
        while j >= 0 and after[j] < total:  # joined: it begins where j does, and j's own number holds
            low, start = before[j], spans[j][0]
            del before[j:], after[j:], spans[j:]
            j = lower[j]
            del lower[len(before) :]
        before.append(low)
        after.append(total)
        spans.append((start, i + 1))
        lower.append(j)
    return [(b - a, i, j) for a, b, (i, j) in zip(before, after, spans)]


def passages(text: str | None, scores: Scores) -> tuple[int, list[float]]:
    """Number of tokens and the segment scores, highest first."""
    words = tokens(text)
    if not words:
        return 0, []
    values = list(map(scores.__getitem__, words))
    if max(values) <= 0:
        return len(words), []
    return len(words), sorted((s for s, _, _ in segments(values)), reverse=True)


def evidence(n: int, found: list[float], scale: float, shift: float) -> float:
    """Sum of what the segments score beyond chance in a text of n tokens."""
    chance = math.log(n + 1) + shift
    return math.fsum(x for s in found if (x := scale * s - chance) > 0)


def gumbel(rows: list[tuple[int, float]]) -> tuple[float, float]:
    """scale and shift of the best segment (tokens, score) among clean texts, by moments."""
    best = np.array([(math.log(n + 1), top) for n, top in rows if n] or [(0.0, 0.0)])
    sd = max(float(best[:, 1].std()), 0.3)
    scale = math.pi / (sd * math.sqrt(6))
    return scale, float((scale * best[:, 1] - best[:, 0]).mean()) - 0.5772


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton's method; x holds a column of ones first."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def curve_inputs(e: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(e)), np.log1p(e), (e > 0).astype(float)])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model, float, float, list[float]] | None:
    spark = docs.sparkSession
    usable = labels.select("doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_mod("doc_id", 5) != 0))
    picked = sampled(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), SAMPLE, "doc_id")
    ids = [tuple(r) for r in picked.toLocalIterator()]
    if not ids:
        return None
    chosen = F.broadcast(spark.createDataFrame(ids, "doc_id long, toxic int"))  # at most SAMPLE rows
    sample = stored(docs.select("doc_id", "text").join(chosen, "doc_id"), "labelled")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[int, int], Counter] = {(f, c): Counter() for f in range(FOLDS) for c in (0, 1)}
        rows: Counter = Counter()
        for b in batches:
            for doc, text, toxic in zip(b["doc_id"].tolist(), b["text"].tolist(), b["toxic"].tolist()):
                key = fold_of(doc), int(toxic > 0)
                rows[key] += 1
                seen[key].update({f for w in set(tokens(text)) for f in features(w)})
        for (fold, c), got in seen.items():
            if rows[fold, c]:
                yield pd.DataFrame({"feature": [*got, ""], "fold": fold, "toxic": c, "n": [*got.values(), rows[fold, c]]})

    columns = [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == c), F.col("n")).otherwise(0)).alias(f"n{f}{c}") for f in range(FOLDS) for c in (0, 1)]
    counted = sample.mapInPandas(count, "feature string, fold int, toxic int, n long").groupBy("feature").agg(F.sum("n").alias("n"), *columns).where(F.col("n") >= LEAST)
    counted = stored(counted, "features")
    least, held = LEAST, 0
    for r in sorted(counted.groupBy("n").agg(F.count("*").alias("m")).collect(), key=lambda r: -r["n"]):  # at most SAMPLE rows
        held += r["m"]
        if held > FEATURES:
            least = r["n"] + 1
            break
    by_fold: list[dict[str, tuple[float, float]]] = [{} for _ in range(FOLDS)]
    for r in counted.where((F.col("n") >= least) | (F.col("feature") == "")).collect():  # FEATURES at most
        for f in range(FOLDS):
            by_fold[f][r["feature"]] = r[f"n{f}0"], r[f"n{f}1"]

    def model_of(folds: list[int]) -> Model:
        names = set().union(*(by_fold[f] for f in folds))
        total = {k: tuple(sum(by_fold[f].get(k, (0, 0))[c] for f in folds) for c in (0, 1)) for k in names}
        rows = total.pop("", (0, 0))
        return log_odds({k: v for k, v in total.items() if sum(v)}, rows)

    others = [model_of([g for g in range(FOLDS) if g != f]) for f in range(FOLDS)]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = [Scores(m) for m in others]
        for b in batches:
            out = [(int(toxic > 0), *passages(text, scores[fold_of(doc)])) for doc, text, toxic in zip(b["doc_id"].tolist(), b["text"].tolist(), b["toxic"].tolist())]
            yield pd.DataFrame(out, columns=["toxic", "n", "found"])

    scored = stored(sample.mapInPandas(score, "toxic int, n int, found array<double>"), "scored")
    # a few numbers for each of at most SAMPLE rows
    best = scored.where("toxic = 0").select("n", F.coalesce(F.array_max("found"), F.lit(0.0))).collect()
    scale, shift = gumbel([(n, top) for n, top in best])
    beyond = F.aggregate("found", F.lit(0.0), lambda acc, x: acc + F.greatest(F.lit(0.0), x * scale - (F.log(F.col("n") + 1) + shift)))
    rows = scored.select("toxic", beyond).collect()
    w = logistic(curve_inputs(np.array([e for _, e in rows])), np.array([y for y, _ in rows], float))
    return model_of(list(range(FOLDS))), scale, shift, w.tolist()


def scorer(fitted) -> Callable[[list], np.ndarray]:
    """A worker's function from texts to scores."""
    if fitted is None:
        return lambda texts: np.zeros(len(texts))
    model, scale, shift, w = fitted
    scores, w = Scores(model), np.array(w)

    def score(texts: list) -> np.ndarray:
        e = np.array([evidence(*passages(t, scores), scale, shift) for t in texts], float)
        return 1 / (1 + np.exp(-(curve_inputs(e) @ w)))

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; one row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(fit(docs, labels))  # bounded by FEATURES

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = scorer(shared.value)
        for b in batches:
            yield b[["doc_id", "nameless"]].assign(score=score(b["text"].tolist()))

    out = renamed(named(docs, "text").mapInPandas(run, "doc_id long, nameless boolean, score double"))
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(fit(docs, labels))

    def keep() -> Callable[[list], list[bool]]:
        score = scorer(shared.value)
        return lambda texts: (score(texts) < 0.5).tolist()

    return kept_by_arrow(docs, "text", keep)
