"""Null and large ids, repeated ids with different texts, clashing columns, very long texts."""

import resource
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyedstore.llm import common, decontaminate, hmm, license_scan, near_dedup, packing, pii, repeats, toxicity, url_filter
from keyedstore.llm.queries import URL_RULES

BIG = 2**60 + 1
#: Columns named like what the operators return or use on their way.
CLASHES = "score double, predicted int, held_out boolean, kept boolean, component_id long, row long, spans string, line int, first long, nameless boolean, verdict string, links long, n long, value binary, h long, label string"


@pytest.fixture(scope="module")
def odd(spark):
    texts = ["one two three four five six seven", None, "", "call +1 (644) 555-7859 or jo@host.org", "Released under the MIT License.", "word " * 400, "one two three four five six seven"]
    ids = [None, BIG, BIG + 1, None, 7, 7, BIG + 3]
    extra = [(None, None, None, None, None, BIG, None, None, None, None, None, None, None, None, None, None), (0.5, 1, True, False, 3, None, "x", 2, BIG, True, "v", BIG, None, b"\x00", 5, "l")]
    return spark.createDataFrame([(i, t, *extra[k % 2]) for k, (i, t) in enumerate(zip(ids, texts))], f"doc_id long, text string, {CLASHES}").coalesce(1).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(BIG, 1, 0, 1.0), (None, 1, 1, 1.0), (7, 0, 1, 2.0), (BIG + 3, 1, None, 0.0)], "doc_id long, quality int, toxic int, score double")


def ids(df, key="doc_id"):
    return sorted((r[key] for r in df.collect()), key=repr)


def test_ids_come_back(spark, odd, labels):
    import public_tokenizers as P

    want = ids(odd)
    make = packing.byte_bpe(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), 0)
    for out in (pii.find_spans(odd), toxicity.toxicity(odd, labels), hmm.language_model(odd), near_dedup.near_duplicates(odd), repeats.remove_repeats(odd)):
        assert ids(out) == want
    assert ids(packing.pack(odd, make).where("start = 0")) == want
    bench = spark.createDataFrame([(BIG, "one two three four five six", 1), (None, "one two three four five six", 2)], "item_id long, text string, doc_id int")
    assert sorted(((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(odd, bench).collect()), key=repr) == sorted([(None, BIG), (BIG + 3, BIG)], key=repr)
    assert ids(decontaminate.clean(odd, bench)) == sorted([BIG, BIG + 1, None, 7, 7], key=repr)
    assert [(r["doc_id"], r["confirmed"]) for r in license_scan.scan(odd).collect()] == [(7, True)]
    pages = spark.createDataFrame([(None, "http://a.net/fr/x", "k"), (BIG, "HTTP://WWW.example.com/en/", "k"), (BIG, None, "k")], "page_id long, url string, rule string").coalesce(1)
    got = url_filter.judge_urls(pages, URL_RULES).collect()
    assert sorted([(r["page_id"], r["rule"]) for r in got], key=repr) == sorted([(None, "net/fr/"), (BIG, "www.example.com/en/"), (BIG, None)], key=repr)


def test_columns_come_back_bit_for_bit(spark, odd, labels):
    import corpus_pipeline

    def rows(df, without=()):
        return sorted((repr([v for c, v in zip(df.columns, r) if c not in without]) for r in df.collect()))

    for out in (pii.redact(odd), toxicity.clean(odd, labels.limit(0)), decontaminate.clean(odd, spark.createDataFrame([], "item_id long, text string"))):
        assert out.schema == odd.schema
        assert rows(out, ("text",)) == rows(odd, ("text",))
    near = corpus_pipeline.near_duplicates(spark, odd, "/root/testdata/sf0.001")
    assert near.columns == odd.columns and ids(near) == sorted([None, None, 7, BIG, BIG + 1, BIG + 3], key=repr)
    assert set(rows(near)) <= set(rows(odd))


def test_repeated_ids(spark):
    """Rows of one id with different texts are rows of their own, but never remove from each other."""
    long = "abcdefghij" * 8
    df = spark.createDataFrame([(1, "x" + long), (1, "y" + long), (2, long + "z"), (2, "other " * 20)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in repeats.remove_repeats(df).collect())
    assert got == [(1, 81, 0), (1, 81, 0), (2, 81, 80), (2, 120, 0)]


def test_texts_under_one_number(spark, monkeypatch):
    """Unequal texts that one hash takes for equal stay apart."""
    real = F.xxhash64
    monkeypatch.setattr(repeats.F, "xxhash64", lambda *c: F.length(c[0]).cast("long") if len(c) == 1 else real(*c))
    texts = ["a" * 30 + "b" * 70, "b" * 70 + "c" * 30, "a" * 30 + "b" * 70, "d" * 60]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_removed"]) for r in repeats.remove_repeats(df).collect()) == [(0, 0), (1, 70), (2, 100), (3, 0)]


def test_samples(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("k"), F.lit("x").alias("v"), (F.col("id") * 0 + 3).alias("w"))
    got = common.sampled(df, 100, "k").collect()
    assert len(got) == 100 == len({r["k"] for r in got}) and {(r["v"], r["w"]) for r in got} == {("x", 3)}
    assert len(common.sampled(df.select("k"), 9000, "k").collect()) == 5000
    assert common.sampled(df.limit(0), 5, "k").collect() == []


def test_what_was_stored_goes(spark):
    df = common.stored(spark.range(5), "five")
    assert df.count() == 5
    common.discard(df)
    with pytest.raises(Exception):
        df.count()


def test_segments_in_linear_time():
    def took(n):
        scores = [0.5 if i % 2 else -1.0 for i in range(n)]
        best = min(time_of(scores) for _ in range(3))
        return best

    def time_of(scores):
        begun = time.perf_counter()
        toxicity.segments(scores)
        return time.perf_counter() - begun

    assert took(400_000) < 30 * took(40_000)


def test_long_paths_are_the_same(monkeypatch):
    m = pii.train([], steps=60)
    rng = np.random.default_rng(4)
    part = pii.char_classes("".join(rng.choice(list("0123456789 .-+@ab"), 3000)))
    whole = pii.paths(m, [part])[0]
    assert whole.any()
    for size in (64, 700, 2999):
        monkeypatch.setattr(pii, "PART", size)
        assert (pii.long_path(m, part) == whole).all() and (pii.paths(m, [part])[0] == whole).all()


def test_numbers_in_bounded_memory():
    m = pii.train([], steps=20)
    rng = np.random.default_rng(4)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    pii.all_spans(m, ["".join(rng.choice(list("0123456789 "), 1_000_000)), "see 12 and 13 " * 200])
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000  # kB


def test_written_forms_are_found(spark):
    """Exact spans of made-up items within real texts, and look-alikes left alone."""
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 200").orderBy("doc_id").collect()]
    m = pii.train([t for t in texts[:500] if pii.GATE.search(t)][:400])
    rng = np.random.default_rng(77)
    found, false, cases = 0, 0, texts[500:800]
    for t in cases:
        kind = pii.KINDS[int(rng.integers(4))]
        item, left, right = pii.written(kind, rng), *(pii.GATE.sub("a", x) for x in (t[:100].rpartition(" ")[0] + " ", " " + t[100:200]))
        found += (kind, len(left), len(left) + len(item)) in pii.all_spans(m, [left + item + right])[0][1]
        own, every = pii.all_spans(m, [left + pii.look_alike(rng) + right])[0]
        false += len(every) > len(own)
    assert found >= 0.75 * len(cases) and false <= 0.03 * len(cases)


def test_spelled_forms_are_sound():
    assert pii.sound("email", "jo at host dot org") and pii.sound("email", "jo [at] host [dot] org") and not pii.sound("email", "jo at host")
    assert pii.sound("phone", "٠٦٤٤ ٥٥٥ ٧٨٥٩") and pii.plain_digits("٠٦x") == "06x"
    assert pii.stretches("x" * 50 + " dot " + "y" * 50) == [(27, 78)] and not pii.stretches("dotted")


def test_long_sequences_are_scored_alike(monkeypatch):
    rng = np.random.default_rng(2)
    model = hmm.Hmm(rng.dirichlet([1] * 3), rng.dirichlet([1] * 3, 3), rng.dirichlet([1] * 9, 3).T)
    seq = rng.integers(0, 9, 500)
    want = np.zeros(3), np.zeros((3, 3)), np.zeros((9, 3))
    total = model.expect([seq], *want)
    assert model.likelihood([seq]) == pytest.approx([total])
    monkeypatch.setattr(hmm, "GROUP", 77)
    got = np.zeros(3), np.zeros((3, 3)), np.zeros((9, 3))
    assert model.expect([seq], *got) == pytest.approx(total) and model.likelihood([seq]) == pytest.approx([total])
    for a, b in zip(want, got):
        assert a == pytest.approx(b)


def test_long_texts_have_the_same_ids(monkeypatch):
    import public_tokenizers as P

    make = packing.byte_bpe(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), 0)
    texts = ["It's 1234 words,  and  more\n\n" * 40, "", "a" * 3000]
    want = make()(texts)
    monkeypatch.setattr(packing, "LONG", 10)
    assert make()(texts) == want




@pytest.mark.parametrize("likeness, few", [(0.87, 8), (0.8, 8), (0.87, 4096)])
def test_large_families(spark, monkeypatch, likeness, few):
    """Groups over many blocks: copies of one text with words changed, and chains, whose ends are not alike."""
    from keyedstore.llm import near_dedup
    from test_operators import shingle_set

    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "SET_BLOCK", 6)
    monkeypatch.setattr(near_dedup, "PROBES", 5)
    monkeypatch.setattr(near_dedup, "FEW", few)
    rng = np.random.default_rng(3)
    base, texts = [f"w{k}" for k in range(100)], []
    for k in range(70):
        w = list(base)
        for at in rng.choice(100, max(1, int((1 - likeness) * 12)), replace=False):
            w[at] = f"x{k}"
        texts.append(" ".join(w))
    chain = [f"c{k}" for k in range(100)]
    for k in range(40):
        chain = chain[2:] + [f"d{k}", f"e{k}"]
        texts.append(" ".join(chain))
    sets = [shingle_set(t, 5) for t in texts]
    label = list(range(len(texts)))
    for _ in range(len(texts)):
        for i in range(len(texts)):
            for j in range(i):
                if label[i] != label[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df).collect()} == dict(enumerate(label))


def test_one_id_for_two_texts(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h"), (1, "p q r s t u v w"), (2, "p q r s t u v w"), (3, "a b c d e f g h"), (0, "a b c d e f g h")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(df).collect())
    assert got == [(0, 0), (1, 0), (1, 1), (2, 1), (3, 0)]


def test_embeddings_with_odd_ids(spark):
    from keyedstore.llm import embedding_dedup

    v, w = [1.0, 2.0, 3.0], [3.0, -1.0, 0.0]
    rows = [(None, v, 1), (BIG, v, 1), (BIG + 1, v, 1), (BIG + 1, w, 1), (BIG + 2, [1.0, 2.0, 3.01], 1), (BIG + 3, w, 1), (None, None, 1), (BIG + 4, w, None), (BIG + 1, [0.0, 0.0, 1.0], 1)]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "vec_id long, embedding array<double>, label int, n_links int, shard int").coalesce(1)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.embedding_duplicates(df).collect()), key=repr)
    # each row of the repeated id has the links of its own vector
    want = [(None, 0, None, True)] * 2 + [(BIG, 2, BIG, True), (BIG + 1, 2, BIG, False), (BIG + 2, 2, BIG, False)]
    want += [(BIG + 1, 1, BIG + 1, True), (BIG + 3, 1, BIG + 1, False), (BIG + 1, 0, BIG + 1, True), (BIG + 4, 0, BIG + 4, True)]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("noise", [0.002, 0.05])
def test_shards_that_are_dealt_on(spark, monkeypatch, noise):
    """Shards below shards, and a dense group that stays whole; against brute force."""
    from keyedstore.llm import embedding_dedup as e

    for name, value in (("PER_CENTROID", 20), ("TOP", 3), ("MOST", 60), ("PROBES", 30), ("BELOW", 4), ("BLOCK", 16), ("EXACT_BLOCK", 32)):
        monkeypatch.setattr(e, name, value)
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(12, 24))
    x = centers[rng.integers(0, 12, 600)] + noise * rng.normal(size=(600, 24))
    x[:150] = centers[0] + 0.05 * rng.normal(size=(150, 24))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & ~np.eye(600, dtype=bool)
    least = np.arange(600)
    for _ in range(600):
        least = np.minimum(least, np.where(near, least, 600).min(axis=1))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in e.embedding_duplicates(df).collect()}
    share = sum(got[i][0] for i in got) / max(1, near.sum())
    assert 0.98 <= share <= 1 or not near.any()
    assert sum(got[i][1] == least[i] for i in got) >= 0.98 * 600


def test_audits_are_written_down(spark):
    from keyedstore.llm import embedding_dedup as e

    v = [(i, "a", 2, 1, np.array([1.0, i / 1000.0]).tobytes()) for i in range(40)]
    df = spark.createDataFrame(v, e.VECTORS)
    full = df.select("id", F.lit(39).cast("long").alias("links"))
    assert e.audit(df, full, 0.98, 3) == 1.0
    assert 0 < e.audit(df, df.select("id", F.when(F.col("id") % 2 == 0, 39).otherwise(13).cast("long").alias("links")), 0.98, 3) < 1
    assert e.audit(df, full.withColumn("links", F.lit(0).cast("long")), 0.98, 3) == 0.0
    assert e.audit(df.where("id = 0"), full.limit(0), 0.98, 3) is None
