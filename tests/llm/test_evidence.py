"""The registered queries and the stages of the pipeline against brute force over whole small tables."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyedstore.llm import hmm, license_scan, pii
from keyedstore.llm.queries import queries


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def luhn(digits):
    twice = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(digits[::-1])]
    return sum(x // 10 + x % 10 for x in twice) % 10 == 0


def patterns(text):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    kinds = ["email", "ip", "card", "phone"]
    return sorted(((k, m.start(), m.end()) for k, m in out), key=lambda s: (s[1], kinds.index(s[0])))


def test_op1(spark, sf, texts):
    got = by_id(queries()["op1_pii"](spark, sf))
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        base = patterns(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in got[i]["spans"].split(",") if x)]
        assert set(base) <= set(spans) and spans == sorted(spans, key=pii.order) and all(0 <= s < e <= len(text) for _, s, e in spans)
        assert all(pii.sound(k, text[s:e]) for k, s, e in set(spans) - set(base))


def test_op2(spark):
    """Held-out rows are ranked by their label: the share of pairs in the right order."""
    sf = "/root/testdata/sf0.01"
    got = by_id(queries()["op2_toxicity"](spark, sf))
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == 1000 and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) for i, r in got.items())
    scores = [[got[i]["score"] for i, t in toxic.items() if t == c and got[i]["held_out"]] for c in (0, 1)]
    right = np.mean([(a < b) + 0.5 * (a == b) for a in scores[0] for b in scores[1]])
    assert all(scores) and right >= 0.95


def test_op3_scores(spark, sf, texts, monkeypatch):
    """Every score by naive sums over states, with words outside a small head."""
    held = []
    monkeypatch.setattr(hmm, "HEAD", 60)
    monkeypatch.setattr(hmm, "INIT", 50)
    real = hmm.initial
    monkeypatch.setattr(hmm, "initial", lambda *a: held.append(real(*a)) or held[-1])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    some = sorted(texts, key=lambda i: len(texts[i]))[:120]
    docs = docs.where(F.col("doc_id").isin(some))
    got = by_id(hmm.score(docs, docs, rounds=0))
    model, words = held[0], {i: texts[i].encode().lower().split() for i in some}
    count = {}
    for ws in words.values():
        for w in ws:
            count[w] = count.get(w, 0) + 1
    head = {w: k for k, w in enumerate(sorted(count, key=lambda w: (-count[w], hmm.word_key(w)))[:60])}
    rest = {}
    for w, c in count.items():
        if w not in head:
            n, v = rest.get(hmm.word_key(w) % 256, (0, 0))
            rest[hmm.word_key(w) % 256] = n + c, v + 1
    for i in some:
        logs, symbols = 0.0, []
        for w in words[i]:
            kind = hmm.word_key(w) % 256
            symbols.append(head.get(w, 61 + kind))
            if w not in head:
                n, v = rest[kind]
                logs += math.log10((count[w] + 1) / (n + v + 1))
        state = np.log(model.start)
        for k, y in enumerate([*symbols, 60]):
            if k:
                state = np.array([np.logaddexp.reduce(state + np.log(model.move[:, j])) for j in range(len(state))])
            state = state + np.log(model.emit[y])
        assert got[i]["score"] == pytest.approx(logs + np.logaddexp.reduce(state) / math.log(10), rel=1e-9)


def test_op6(spark, sf, texts, monkeypatch):
    """Every line of every text by the same model in plain Python, with no gate: the same findings are confirmed."""
    held = []
    real = license_scan.Classifier
    monkeypatch.setattr(license_scan, "Classifier", lambda *a: held.append(real(*a)) or held[-1])
    got = {(r["doc_id"], r["line"]): r for r in license_scan.scan(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    model, ends, seen = held[0], re.compile(license_scan.ENDS), set()

    def judge(content):
        ws = license_scan.words(content)
        z = model.weights[-1] + sum((model.weights[model.index[g]] for g in license_scan.grams(ws) if g in model.index), np.zeros(len(model.families)))
        p = model.softmax(z[None])[0]
        family = model.families[int(p.argmax())] if p.max() >= license_scan.SURE else license_scan.UNKNOWN
        own = license_scan.grams(ws)
        alike = max((len(own & set(gs)) / len(gs) for t in license_scan.TEMPLATES.get(family, []) if (gs := license_scan.longest_grams(t))), default=0.0)
        return family, float(p.max()), alike, family != license_scan.UNKNOWN and alike >= license_scan.SHARED

    for i, text in texts.items():
        lines = text.split("\n")
        goes = [bool(a.strip(" ") and b.strip(" ") and not ends.search(a)) for a, b in zip(lines, [*lines[1:], ""])]
        for j in range(len(lines)):
            before = [j - k >= 0 and goes[j - k] for k in range(1, license_scan.WRAP)]
            if before[0] and not all(before):
                continue
            n = 1
            while n < license_scan.WRAP and goes[j + n - 1]:
                n += 1
            family, p, alike, confirmed = judge("\n".join(lines[j : j + n]))
            rows = [got[i, k] for k in range(j, j + n) if (i, k) in got]
            if confirmed:
                assert any(r["family"] == family and r["confirmed"] and r["probability"] == pytest.approx(p, abs=1e-5) and r["similarity"] == pytest.approx(alike) for r in rows)
                seen.add((i, j))
    assert seen and sum(r["confirmed"] for r in got.values()) == len(seen)


def test_wrapped_notices(spark):
    notice = license_scan.TEMPLATES["mit"][1].split()
    wrapped = " * Copyright by some people\n" + "\n".join(" ".join(notice[k : k + 6]) for k in range(0, len(notice), 6))
    rows = [(1, wrapped), (2, "Some words.\n\n" + wrapped + "\n\nmore words"), (3, "\n".join(f"item {k}" for k in range(9)) + "\n" + wrapped), (4, "plain\nlines\nonly")]
    df = spark.createDataFrame(rows + [(10 + k, f"Ordinary words about things {k}.") for k in range(20)], "doc_id long, text string")
    got = [(r["doc_id"], r["family"]) for r in license_scan.scan(df).where("confirmed").collect()]
    assert {(1, "mit"), (2, "mit"), (3, "mit")} <= set(got) and not any(i == 4 for i, _ in got)


def shingles(text, k=5):
    w = text.encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_stages(spark, sf):
    """Each stage's own work on all that its predecessor kept, by brute force."""
    import corpus_pipeline
    from keyedstore.llm import toxicity

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: {r["doc_id"]: tuple(r) for r in df.collect()}

    def step(name):
        out = stages[name](spark, docs, sf).cache()
        assert out.columns == docs.columns and len(rows(out)) == out.count()
        return out

    before, out = rows(docs), step("toxicity")
    marked = by_id(toxicity.toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet")))
    assert rows(out) == {i: r for i, r in before.items() if marked[i]["score"] < 0.5}

    docs, before = out, rows(out)
    out = step("minhash near-dedup")
    at = docs.columns.index("text")
    sets = {i: shingles(r[at] or "") for i, r in before.items()}
    label = {i: i for i in before}
    for _ in range(len(before)):
        old = dict(label)
        for i in before:
            for j in before:
                if j < i and label[i] != label[j] and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
        if label == old:
            break
    assert rows(out) == {i: r for i, r in before.items() if label[i] == i}

    docs, before = out, rows(out)
    out = step("benchmark decontamination")
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() if r["text"]]
    held = {i: any(s and len(s & shingles(r[at] or "", len(next(iter(s))))) >= 0.8 * len(s) for s in items) for i, r in before.items()}
    assert rows(out) == {i: r for i, r in before.items() if not held[i]} and any(held.values())

    docs, before = out, rows(out)
    out = step("pii")
    m = pii.model_of(docs)
    for i, r in rows(out).items():
        text, at_, parts = before[i][at], 0, []
        for kind, s, e in pii.all_spans(m, [text or ""])[0][1]:
            if s >= at_:
                parts += [text[at_:s], f"[{kind.upper()}]"]
            at_ = max(at_, e)
        want = None if text is None else "".join([*parts, text[at_:]])
        changed = dict(zip(docs.columns, before[i])) | {"text": want} | ({"n_chars": len(want)} if want is not None else {})
        assert dict(zip(docs.columns, r)) == changed
        assert not patterns(r[at] or "")
    assert rows(out).keys() == before.keys()

    docs, before = out, rows(out)
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces, windows = {}, {}
    for r in stages["packing"](spark, docs, sf).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        windows.setdefault(r["sequence_id"], []).append(r)
    assert pieces.keys() == before.keys()
    for i, rs in pieces.items():
        ids = np.array([*t.encode(before[i][at] or "", add_special_tokens=False).ids, 0], "<u4")
        at_ = 0
        for r in sorted(rs, key=lambda r: r["start"]):
            assert r["start"] == at_ and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at_ : at_ + r["length"]].tobytes())
            at_ += r["length"]
        assert at_ == len(ids)
    for rs in windows.values():
        at_ = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at_
            at_ += r["length"]
        assert at_ <= 1024


@pytest.mark.parametrize("name", ["op4_minhash_near_dedup", "op5_decontamination", "op7_suffix_array_dedup", "op10_embedding_near_dedup"])
def test_sql_twins(spark, sf, name):
    import duckdb

    from keyedstore.llm.oracles import oracle_sql

    db = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df, twin = queries()[name](spark, sf), db.sql(oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(twin.columns) == columns
    of = lambda names, rows: sorted(repr([r[names.index(c)] for c in columns]) for r in rows)
    assert of(df.columns, map(tuple, df.collect())) == of(twin.columns, twin.fetchall())
