"""The corpus operators against brute force, on small fixtures with odd rows."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest

from keyedstore.llm import decontaminate, embedding_dedup, hmm, license_scan, near_dedup, packing, pii, repeats, toxicity, url_filter
from keyedstore.llm.components import components
from keyedstore.llm.oracles import oracle_sql
from keyedstore.llm.queries import queries

DOCS = "doc_id long, text string, extra string, count long"
RNG = random.Random(4)
WORDS = ["".join(RNG.choices("abcdefgh", k=RNG.randint(2, 6))) for _ in range(300)]


def prose(n):
    return " ".join(RNG.choices(WORDS, k=n))


def edited(text, n):
    w = text.split()
    for i in RNG.sample(range(len(w)), n):
        w[i] = "edit"
    return " ".join(w)


def odd_texts():
    base = prose(120)
    near = [base, edited(base, 1), edited(base, 3), edited(base, 9), base.upper()]
    return [None, "", " \n ", "one", "one two three", "ONE two three", *near, base, prose(60), prose(3000), "é ß 😀 " * 30, base + " " + prose(15)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(odd_texts())], DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def shingle_set(text, k):
    w = text.encode().lower().split() if text else []
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(docs, none, width):
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    sets = {i: shingle_set(t, width) for i, t in rows.items()}
    label = {i: i for i in rows}
    for _ in rows:
        for i in rows:
            for j in rows:
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    got = {r["doc_id"]: tuple(r)[1:] for r in near_dedup.near_duplicates(docs, width).collect()}
    assert got == {i: (len(sets[i]), label[i], label[i] == i) for i in rows}
    assert near_dedup.near_duplicates(none, width).count() == 0


def test_near_duplicates_with_null_and_repeated_ids(spark, sf):
    import corpus_pipeline

    base, other, big = prose(80), prose(70), 2**60 + 1
    rows = [(None, base), (big, base), (big + 1, base), (big + 2, edited(base, 1)), (7, other), (7, other), (7, prose(40) + " zz"), (8, None), (8, other), (9, None), (9, None), (None, "lone text"), (None, None)]
    df = spark.createDataFrame([(i, t, "x", k) for k, (i, t) in enumerate(rows)], DOCS).coalesce(1)
    got = [tuple(r)[:1] + tuple(r)[2:] for r in near_dedup.near_duplicates(df.where("doc_id IS NULL OR doc_id > 9")).collect()]
    assert sorted(g for g in got if g[0]) == [(big, big, True), (big + 1, big, False), (big + 2, big, False)]
    assert [g for g in got if g[0] is None] == [(None, None, True)] * 3
    out = corpus_pipeline.near_duplicates(spark, df, sf)
    assert out.columns == df.columns
    left = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    seven = min(t for i, t in rows if i == 7)
    want = [(None, base), (None, "lone text"), (None, None), (big, base), (7, seven), (9, None)] + [(8, other)] * (seven != other)
    assert left == sorted(want, key=repr)


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(40, 30), (30, 35)], "a long, b long")
    assert {r["id"]: r["component"] for r in components(links).collect()} == dict.fromkeys(range(21), 0) | dict.fromkeys((30, 35, 40), 30)


def test_least_matches_keep_the_threshold():
    least = near_dedup.least_matches(120, 15, 0.8, 1e-5)
    lost = sum(math.comb(120, m) * 0.8**m * 0.2 ** (120 - m) for m in range(least[-1]))
    assert list(least) == sorted(least) and lost < 1e-3


def test_piece_records_and_sides():
    meta = np.array([(i, -i, 3 * i, i, i % 35) for i in range(300)], repeats.META)
    assert (repeats.records(repeats.planes(meta)) == meta).all()
    rng = random.Random(9)
    gram, left, right = (rng.randbytes(n) for n in (repeats.GRAM, 34, 34))
    pieces = [left + gram + right, rng.randbytes(20) + left[-17:] + gram + rng.randbytes(17), left[-16:] + gram + rng.randbytes(34), rng.randbytes(34) + gram + rng.randbytes(34)]
    assert repeats.alike(pieces, [34, 37, 16, 34], 50) == [0, 1]


def test_repeats(docs, none):
    length, seen, want = 50, {}, {}
    rows = sorted((r["doc_id"], (r["text"] or "").encode()) for r in docs.collect())
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        own = [b[k : k + length] for k in range(len(b) - length + 1)]
        for k, w in enumerate(own):
            if w in seen:
                gone[k : k + length] = True
        seen.update(dict.fromkeys(own))
        edges = np.diff(np.concatenate([[0], gone.astype(int)])) == 1
        want[i] = (len(b), int(gone.sum()), int(edges.sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    assert {r["doc_id"]: tuple(r)[1:] for r in repeats.remove_repeats(docs).collect()} == want
    assert repeats.remove_repeats(none).count() == 0


def test_suspects_of_rows_alike_in_32_bits(spark):
    from keyedstore.llm.common import small_batches

    small_batches(spark)
    first, second = prose(40), prose(40)
    rows = [(1, 5, first), (2, (7 << 32) + 5, second), (3, (9 << 32) + 5, second + " end"), (4, 77, first + " end"), (5, 77, first + " end")]
    df = spark.createDataFrame(rows, "doc_id long, row long, text string").coalesce(1)
    got = {r["row"]: set(np.frombuffer(r["keys"], np.uint64).tolist()) for r in repeats.suspects(df, 8, 50).collect()}
    keys = {row: {int(k) for _, _, _, key, _ in repeats.runs([t.encode()], 50) for k in key} for _, row, t in rows}
    assert got == {row: {k for k in ks if any(k in o for other, o in keys.items() if other != row)} for row, ks in keys.items()}


def test_suffix_arrays():
    rng = np.random.default_rng(0)
    for n in range(1, 70):
        t = rng.integers(0, rng.integers(1, 5), n)
        assert repeats.suffix_array(t).tolist() == sorted(range(n), key=lambda i: t[i:].tolist())


def test_packing(docs, none):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    make = packing.byte_bpe(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), 0)
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = [x or "" for x in odd_texts()] + ["a<|endoftext|>b", "it's 　 ...  \n\n x", "1234 ½"]
    assert make()(texts) == [np.array([*t.encode(x, add_special_tokens=False).ids, 0], "<u4").tobytes() for x in texts]
    rows = packing.pack(docs, make).collect()
    used, placed = {}, {}
    for r in rows:
        used.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"]))
        placed.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert len(used) == docs.count()
    for spans, total in [(v, k[1]) for k, v in used.items()] + [(v, None) for v in placed.values()]:
        at = 0
        for s, n in sorted(spans):
            assert s == at
            at += n
        assert at == total if total is not None else at <= 1024
    assert packing.pack(none, make).count() == 0
    for sizes in ([1], [700, 700, 700], [RNG.randint(1, 256) for _ in range(100)]):
        dealt = packing.windows(sizes, 1024)
        assert sorted(i for w in dealt for i in w) == list(range(len(sizes))) and max(sum(sizes[i] for i in w) for w in dealt) <= 1024


def test_decontamination(spark, docs, none):
    long_text = docs.where("doc_id = 13").first()["text"]
    items = [(1, " ".join(long_text.split()[100:130])), (2, prose(30)), (3, None), (4, ""), (5, "one two three"), (6, edited(" ".join(long_text.split()[500:560]), 1)), (1, " ".join(long_text.split()[100:130]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for r in docs.collect():
        for i, t in items:
            own = shingle_set(t, 5)
            there = shingle_set(r["text"], min(5, len((t or "").split()))) if own else set()
            if own and len(own & there) >= 0.8 * len(own):
                want.append((r["doc_id"], i))
    got = decontaminate.contaminated(docs, bench)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == sorted(want) and want
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in want}
    assert decontaminate.contaminated(none, bench).count() == 0 and decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_urls(spark, sf):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    df = queries()["op8_url_filter"](spark, sf)
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, db.sql(f"SELECT {', '.join(df.columns)} FROM ({oracle_sql()['op8_url_filter']})").fetchall()))


def test_url_sweep(spark):
    hosts = ["a.com", "b.a.com", "com", "ab.com", "x.b.a.com", "", "a.com.net"]
    paths = ["", "/", "/a", "/a/b", "/ab"]
    rules = [(h, p, RNG.choice(["allow", "block"])) for h in hosts if h for p in paths if RNG.random() < 0.6]
    urls = [(i, f"http://{h.upper()}{p}?q#f") for i, (h, p) in enumerate((h, p) for h in hosts for p in paths)] + [(98, None), (99, "no scheme")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    for size in (200_000, 2):
        for r in url_filter.judge_urls(pages, rules, "none", size).collect():
            fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
            best = max(fits) if fits else (0, 0, None, "none")
            assert (len(r["rule"] or ""), r["verdict"]) == (best[0], best[3]) or len({f[0] for f in fits}) < len(fits)
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 16))
    x[20:40] = x[0] + 0.08 * rng.normal(size=(20, 16))
    x[50:55] = 3 * x[1]
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    rows += [(60, None, 0), (61, [0.0] * 16, 0), (62, [float("nan")] + [1.0] * 15, 0), (63, [None] + [1.0] * 15, 0), (64, x[0].tolist(), None), (65, [], 0), (66, [1.0, 2.0], 0)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "vec_id long, embedding array<double>, label int, id string")
    good = [r for r in rows if r[0] < 60]
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in good}
    links = {r[0]: set() for r in rows}
    for i, _, a in good:
        links[i] = {j for j, _, b in good if i != j and a == b and unit[i] @ unit[j] >= 0.98}
    label = {i: i for i in links}
    for _ in links:
        for i, js in links.items():
            for j in js:
                label[i] = label[j] = min(label[i], label[j])
    got = {r["vec_id"]: tuple(r)[1:] for r in embedding_dedup.embedding_duplicates(df).collect()}
    assert got == {i: (len(links[i]), label[i], label[i] == i) for i in links}
    assert embedding_dedup.embedding_duplicates(df.limit(0)).count() == 0


def test_embeddings_of_a_dense_group(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 32))
    x[::2] = x[0] + 0.1 * rng.normal(size=(200, 32))
    x[100:110] = x[100]  # exact copies within the group
    rows = [(i, v.tolist(), i % 3 % 2) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (u @ u.T >= 0.98) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    least = np.arange(len(x))
    for _ in range(len(x)):
        least = np.minimum(least, np.where(near, least, len(x)).min(axis=1))
    want = {i: (int(near[i].sum()), int(least[i])) for i in range(len(x))}
    for name, value in (("PER_CENTROID", 1), ("OVERLAP", 1), ("WIDEST", 4)):  # the group over many shards, as in a large table
        monkeypatch.setattr(embedding_dedup, name, value, raising=False)
    for shard, block in ((4000, 2048), (20, 16)):
        monkeypatch.setattr(embedding_dedup, "EXACT_SHARD", shard, raising=False)
        monkeypatch.setattr(embedding_dedup, "EXACT_BLOCK", block, raising=False)
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.embedding_duplicates(df).collect()} == want


def test_pii_patterns():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for t in ("a@b.c@d.e", "@@a@b.c", "x@y", "a@-.b a@b..c", "mail a.b+c@d-e.org.", "é@b.c a@b.cé"):
        assert [(m.start(), m.end()) for m in email.finditer(t)] == [(s, e) for k, s, e in pii.base_spans(t) if k == "email"]
    spans = pii.base_spans("256.1.1.1 1.2.3.4.5.6.7.8 card 4111 1111 1111 1111 +1 (644) 555-7859")
    assert [s[0] for s in spans] == ["ip", "ip", "card", "phone"]


def test_crf_gradients():
    rng = np.random.default_rng(0)
    m = pii.fresh(rng, 3)
    x, y = pii.windows_for_training([], rng, 2)
    x, y = x.T[:6].copy(), y.T[:6].copy()
    loss, grads = pii.loss_and_grads(m, x, y)
    for k, g in grads.items():
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        moved = {a: b.copy() for a, b in m.items()}
        moved[k][i] += 1e-5
        assert (pii.loss_and_grads(moved, x, y)[0] - loss) / 1e-5 == pytest.approx(g[i], rel=1e-2, abs=1e-4)


def test_pii_network(spark, none):
    m = pii.train([], steps=150)
    texts = ["call (644) 555-7859 now", "built in 2024-01-31", "", "x" * 5000 + " a@b.org"]
    (_, a), (_, b), (_, c), (own, d) = pii.all_spans(m, texts)
    assert [k for k, _, _ in a] == ["phone"] and not b and not c and set(own) <= set(d)
    df = spark.createDataFrame([(1, "write to jo@host.org", "k", 2), (2, None, "k", 3), (3, "", None, 4)], DOCS)
    out = {r["doc_id"]: r for r in pii.redact(df).collect()}
    assert out[1]["text"] == "write to [EMAIL]" and out[2]["text"] is None and out[1]["extra"] == "k"
    found = {r["doc_id"]: r for r in pii.find_spans(df).collect()}
    assert found[1]["n_email"] == 1 and found[2]["base_sha256"] == hashlib.sha256(b"").hexdigest() and pii.find_spans(none).count() == 0


def brute_segments(s):
    if not s or max(s) <= 0:
        return []
    best = max(((sum(s[i:j]), -(j - i), i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), key=lambda x: (round(x[0], 9), x[1], -x[2]))
    _, _, i, j = best
    return brute_segments(s[:i]) + [round(best[0], 9)] + brute_segments(s[j:])


def test_segments():
    for _ in range(200):
        s = [RNG.uniform(-2, 1.5) for _ in range(RNG.randint(0, 14))]
        assert [round(x, 9) for x, _, _ in toxicity.segments(s)] == brute_segments(s)


def test_toxicity(spark, none):
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        rows.append((i, prose(40) + (" vilword " * 3 if bad else " ") + prose(20), "x", i))
        labels.append((i, 1, int(bad)))
    rows += [(1000, None, "x", 0), (1001, "", "x", 0)]
    df = spark.createDataFrame(rows, DOCS)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(df, lab).collect()}
    held = [i for i, _, _ in labels if got[i]["held_out"]]
    assert held and sum(got[i]["predicted"] == int(i % 4 == 0) for i in held) >= 0.95 * len(held)
    assert got[1000]["predicted"] == 0 and len(got) == 602
    assert toxicity.toxicity(none, lab).count() == 0
    assert {r["score"] for r in toxicity.toxicity(df, lab.limit(0)).collect()} == {0.0}


def test_hmm_forward_is_exact():
    rng = np.random.default_rng(2)
    model = hmm.Hmm(rng.dirichlet([1, 1]), rng.dirichlet([1, 1], 2), rng.dirichlet([1] * 3, 2).T)
    seqs = [np.array([0, 1, 2, 1]), np.array([2, 2])]
    for s, got in zip(seqs, model.forward(seqs)):
        total = 0.0
        for path in np.ndindex(*[2] * len(s)):
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for a, b, y in zip(path, path[1:], s[1:]):
                p *= model.move[a, b] * model.emit[y, b]
            total += p
        assert got == pytest.approx(math.log(total))
    counts = np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2))
    model.expect(seqs, *counts)
    assert [c.sum() for c in counts] == pytest.approx([2, 4, 6])


def test_language_model(docs, none):
    got = {r["doc_id"]: r for r in hmm.language_model(docs).collect()}
    rows = {r["doc_id"]: (r["text"] or "").encode().lower().split() + [0] for r in docs.collect()}
    count = {}
    for i, ws in rows.items():
        if not got[i]["held_out"]:
            for w in ws:
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    for i, ws in rows.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in count for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in ws))
        assert math.isfinite(r["score"]) and r["score"] < 0
    assert hmm.language_model(none).count() == 0


def test_licenses(spark, none):
    rows = [(1, "intro\nReleased under the MIT License.\nend", "x", 0), (2, "Licensed under CC BY-NC 4.0.", "x", 0), (3, None, "x", 0), (4, "", "x", 0), (5, "She holds a driving license.", "x", 0), (1, "intro\nReleased under the MIT License.\nend", "x", 0)]
    got = sorted((r["doc_id"], r["line"], r["family"], r["confirmed"]) for r in license_scan.scan(spark.createDataFrame(rows + [(9 + i, prose(50), "x", 0) for i in range(20)], DOCS)).collect())
    assert [g for g in got if g[3]] == [(1, 1, "mit", True), (1, 1, "mit", True), (2, 0, "cc-by-nc", True)]
    assert all(not g[3] for g in got if g[0] == 5) and license_scan.scan(none).count() == 0


def test_license_words_in_plain_lines(spark):
    """Ordinary lines with the templates' words take no template out of what is read."""
    plain = ["The license was licensed under the bridge by the GNU and the Apache people.", "Released under a public work of mit and lgpl, general and international.", "He was licensed under oath; the source of the license terms is attribution."]
    rows = [(i, line, "x", 0) for i, line in enumerate(plain * 3)] + [(50 + i, prose(50), "x", 0) for i in range(20)]
    known = [(f, t) for f, ts in license_scan.TEMPLATES.items() for t in ts]
    rows += [(1000 + i, prose(20) + "\n" + t, "x", 0) for i, (_, t) in enumerate(known)]
    got = {(r["doc_id"], r["line"]): r for r in license_scan.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert [t for i, (f, t) in enumerate(known) if (r := got.get((1000 + i, 1))) is None or (r["family"], r["confirmed"]) != (f, True)] == []
    assert not any(r["confirmed"] for r in got.values() if r["doc_id"] < 1000)


def test_license_gate_is_whole():
    gate = license_scan.gate()
    for t in (t for ts in license_scan.TEMPLATES.values() for t in ts):
        own = license_scan.longest_grams(t)
        assert sum(not any(a in g for a in gate) for g in own) < license_scan.SHARED * len(own)


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf).cache()
        assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} <= before, name
        docs, before = out, {r["doc_id"] for r in out.collect()}
    assert {r["doc_id"] for r in corpus_pipeline.packing(spark, docs, sf).collect()} == before
