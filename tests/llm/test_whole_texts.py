"""The network of op1 reads every character, and cuts change no path; the states of op3 start from all training texts."""

import numpy as np
import pytest

from keyedstore.llm import hmm, pii


def network():
    """A network that tells digits, at signs and brackets from the rest by chance weights, with sharp scores."""
    m = pii.train([], steps=60)
    return m | {"out": m["out"] * 2}


def naive(move, s):
    best, back = s[0].astype(float), []
    for row in s[1:]:
        steps = best[:, None] + move
        back.append(steps.argmax(axis=0))
        best = row + steps.max(axis=0)
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return np.array(path[::-1])


def test_spans_without_digit_at_sign_or_dot_word(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 200").orderBy("doc_id").limit(400).collect()]
    m = pii.train(texts)
    found = 0
    for t in texts[:40]:
        left, right = (pii.GATE.sub("a", x) for x in (t[:100].rpartition(" ")[0] + " ", " " + t[100:200]))
        item = "kelvin.brass(at)norbert.net"
        assert not pii.GATE.search(item)
        found += ("email", len(left), len(left) + len(item)) in pii.all_spans(m, [left + item + right])[0][1]
    assert found >= 20


def test_cuts_change_no_path(monkeypatch):
    m = network()
    rng = np.random.default_rng(3)
    words = ["lorem", "ipsum", "(at)", "a.b", "12", "644 555", "x@y.de", "dolor", "sit", "amet"] + ["word"] * 12
    parts = [pii.char_classes(" ".join(rng.choice(words, n))) for n in (1, 3, 60, 700, 1500)] + [pii.char_classes("")]
    scores = pii.stretch_scores(m, [p for p in parts if len(p)])
    want = [naive(m["move"], s) for s in scores] + [np.zeros(0)]
    assert sum(map(len, pii.settled(m["move"], [s.copy() for s in scores]))) > 0
    for part in (1 << 16, 900):
        monkeypatch.setattr(pii, "PART", part)
        assert all((a == b).all() for a, b in zip(want, pii.paths(m, parts)))


def test_company_changes_no_scores():
    m = network()
    parts = [pii.char_classes("call 644 555 1234 " * n) for n in (1, 7, 40)]
    for p, s in zip(parts, pii.stretch_scores(m, parts)):
        assert s == pytest.approx(pii.stretch_scores(m, [p])[0], abs=1e-4)
    x = np.r_[parts[0], np.full(32 - len(parts[0]), 6)]  # blanks up to the window's end
    want = pii.tag_scores(m, x[:, None])[0][: len(parts[0]), 0]
    assert pii.stretch_scores(m, parts[:1])[0] == pytest.approx(want, abs=0.1)


def test_windows_of_all_sizes_are_read_abreast(monkeypatch):
    """One pass for eight sizes, with the scores of the network in double precision."""
    m = network()
    parts = [pii.char_classes(("call 644 555 1234 or jo(at)host.net " * 8)[:n]) for n in range(30, 260, 32)]
    calls, real = [], pii.reader
    monkeypatch.setattr(pii, "reader", lambda m: lambda *a, read=real(m): calls.append(a) or read(*a))
    got = pii.stretch_scores(m, parts)
    assert len(calls) == 1
    for p, s in zip(parts, got):
        x = np.r_[p, np.full(-len(p) % 32, 6)]
        assert s == pytest.approx(pii.tag_scores(m, x[:, None])[0][: len(p), 0], abs=2e-3)


def test_quiet_parts_stay_outside():
    """By naive paths under moves and scores by chance: short parts, parts cut at both ends, steps back that cost and that pay."""
    rng = np.random.default_rng(8)
    seen = 0
    for trial in range(300):
        move = rng.normal(0, 1, (pii.TAGS, pii.TAGS)) - rng.random() * 2
        move[0, 0] += 3 * rng.random()
        scores = [(rng.normal(0, 1, (n, pii.TAGS)) - np.r_[0, np.full(pii.TAGS - 1, 1 + 2 * rng.random())]).astype(np.float32) for n in (1, 2, 9, 40)]
        for s in scores[2:]:
            if trial % 2:
                s[[0, -1]] = np.r_[0, np.full(pii.TAGS - 1, -1e30)]
        still = pii.quiet(move, scores)
        seen += still.sum()
        assert not any(naive(move, s).any() for s, q in zip(scores, still) if q)
        for own, path in zip(scores, [np.zeros(len(s), np.int8) for s in scores]):
            pii.put_paths(move, [(own, path)])
            assert (path == naive(move, own)).all()
    assert seen >= 100


def test_runs_of_tags():
    path = np.array([2, 2, 0, 1, 2, 1, 4, 4, 3, 4, 0, 5, 5, 6, 8], np.int8)
    assert pii.tagged(path) == [(0, 0, 2), (0, 3, 5), (0, 5, 6), (1, 6, 8), (1, 8, 10), (2, 11, 12), (2, 12, 14), (3, 14, 15)] and pii.tagged(path[:0]) == []


def test_states_start_from_all_training_texts(spark, monkeypatch):
    """Each round of the mixtures, by naive sums over 1700 different texts."""
    rounds, real = [], hmm.mixed
    monkeypatch.setattr(hmm, "mixed", lambda texts, end, starts: rounds.append((end, starts, real(texts, end, starts))) or rounds[-1][2])
    monkeypatch.setattr(hmm, "HEAD", 40)
    texts = [f"w{i} a{i % 7} b{i % 11} " + f"c{i % 3} " * (i % 5) for i in range(1700)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    hmm.score(docs, docs, rounds=0)
    words = [(t or "").encode().split() for t in texts]
    assert len(rounds) == hmm.ABREAST + hmm.ALONE and [len(x) for _, x, _ in rounds] == [hmm.INIT] * hmm.ABREAST + [1] * hmm.ALONE
    for end, starts, got in rounds:
        for (logs, mean), (fit, share, emits) in zip(starts, got):
            assert share.sum() == pytest.approx(1702) and emits.sum() == pytest.approx(sum(map(len, words)) + 1702)
    count = {}
    for w in (w for ws in words for w in ws):
        count[w] = count.get(w, 0) + 1
    head = {w: k for k, w in enumerate(sorted(count, key=lambda w: (-count[w], hmm.word_key(w)))[:40])}
    end, starts, got = rounds[0]
    for (logs, mean), (fit, share, emits) in zip(starts, got):
        total, shares, want = 0.0, np.zeros(hmm.STATES), np.zeros(emits.shape)
        for ws in words:
            symbols = [head[w] if w in head else end + 1 + hmm.word_key(w) % 256 for w in ws] + [end]
            x = np.log(mean) + sum(logs[:, y] for y in symbols)
            total += np.logaddexp.reduce(x)
            p = np.exp(x - np.logaddexp.reduce(x))
            shares += p
            for y in symbols:
                want[y] += p
        assert fit == pytest.approx(total, rel=1e-6) and share == pytest.approx(shares, rel=1e-5) and np.abs(emits - want).max() < 1e-4


def test_each_text_is_encoded_once(spark, monkeypatch, tmp_path):
    """A training text's symbols are written down for the states and for its score alike; the score is that of separate tables."""
    texts = [f"w{i % 90} a{i % 7} b{i % 11} " + f"c{i % 3} " * (i % 5) for i in range(300)] + ["", None, "éa ñ"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(hmm, "HEAD", 40)
    seen, real = str(tmp_path / "seen"), hmm.encode

    def encode(*a):
        with open(seen, "a") as f:
            f.write("x")
        return real(*a)

    monkeypatch.setattr(hmm, "encode", encode)
    got = sorted(hmm.score(docs, docs).collect())
    with open(seen) as f:
        assert len(f.read()) == len(texts)
    other = sorted(hmm.score(docs, docs.select("*")).collect())
    assert [r[:4] for r in got] == [r[:4] for r in other] and [r[4:] for r in got] == [pytest.approx(r[4:]) for r in other]
    words = [b"a", b"ab", b"abc", "éa".encode(), b"longer word"]
    assert hmm.word_keys(words).tolist() == [hmm.word_key(w) for w in words] and not len(hmm.word_keys([]))
