"""op1 reads the windows that a sound span may need, and gives the spans of the whole path."""

import re
import sys

import numpy as np
import pytest

from keyedstore.llm import pii


@pytest.fixture(scope="module")
def networks(spark):
    """One that tells items from the rest, one that sees them everywhere."""
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 200").orderBy("doc_id").limit(400).collect()]
    m = pii.train(texts)
    return [m, m | {"bias": m["bias"] - np.r_[6, np.zeros(pii.TAGS - 1)]}]


def test_every_sound_span_holds_a_seed():
    rng = np.random.default_rng(4)
    bits = ["at", "AT", "aT", "@", "dot", ".", " ", "\t", "\n", " ", " ", "(", ")", "[", "]", "{", "}", "jo", "that", "1", "27", "255", "٠٦", "५", "-", "é", "𝟗"]
    seen = dict.fromkeys(pii.KINDS, 0)
    for trial in range(20_000):
        item = ".".join(rng.choice(["1", "27", "٠٦", "𝟗"], 4)) if trial % 100 == 0 else "".join(rng.choice(bits, int(rng.integers(1, 14))))
        text = "x" * (trial % 3) + item + "x" * (trial % 2)
        for kind in pii.KINDS:
            if pii.sound(kind, item):
                seen[kind] += 1
                assert pii.seeds_of(text, pii.char_classes(text))[trial % 3 : trial % 3 + len(item)].any()
    assert min(seen.values()) >= 50
    alike = re.compile("[at]", re.I)
    assert {chr(c) for c in range(sys.maxunicode + 1) if alike.match(chr(c))} == set("atAT")


@pytest.mark.parametrize("part", [1 << 16, 900])
def test_spans_are_those_of_the_whole_path(networks, monkeypatch, part):
    """Items at all places of windows, alone and in rows; where a stretch's ends are not proven it widens, at last to the whole text."""
    rng = np.random.default_rng(6)
    plain = ["lorem", "Ipsum", "dolor,", "sit.", "amet", "that", "à", "+", "(", "_x"]
    odd = ["at", "(at)", "12", "644 555", "dot", "x@y.de", "++((", "1", "@"]
    texts = ["", "7", "@", " at ", "jo at host dot org"]
    for k in range(60):
        words = list(rng.choice(plain, int(rng.integers(1, 500))))
        for _ in range(k % 5):
            words.insert(int(rng.integers(len(words) + 1)), pii.written(pii.KINDS[int(rng.integers(4))], rng) if rng.random() < 0.7 else str(rng.choice(odd)))
        texts += [" ".join(words), " ".join(rng.choice(odd, k))]
    texts += ["x" * k + " jo(at)host.net +44 644 555 7859 " + "+-(_" * 150 for k in range(0, 460, 20)]
    monkeypatch.setattr(pii, "PART", part)
    monkeypatch.setattr(pii, "TOGETHER", 20_000)
    calls = {"wider": 0, "whole": 0}
    stretch_paths, cut_path = pii.stretch_paths, pii.cut_path

    def wider(*a):
        out = stretch_paths(*a)
        calls["wider"] += len(out)
        return out

    def whole(*a):
        calls["whole"] += 1
        return cut_path(*a)

    found = []
    for m in networks:
        with monkeypatch.context() as patch:
            patch.setattr(pii, "stretch_paths", wider)
            patch.setattr(pii, "cut_path", whole)
            got = pii.network_spans(m, texts)
        with monkeypatch.context() as patch:
            patch.setattr(pii, "seeded_paths", lambda m, parts, seeds: pii.paths(m, parts))
            want = pii.network_spans(m, texts)
        assert got == want
        found.append(sum(map(len, want)))
    assert min(found) >= 20, found
    assert calls["wider"] and bool(calls["whole"]) == (part == 900)


def test_windows_that_no_span_needs_are_not_read(networks, monkeypatch):
    item, plain = "kelvin.brass(at)norbert.net", "lorem ipsum dolor sit amet " * 2000
    text = plain + item + " " + plain
    read, real = [], pii.reader
    monkeypatch.setattr(pii, "reader", lambda m: lambda x, sizes, f=real(m): read.append(int(sizes.sum())) or f(x, sizes))
    got = pii.network_spans(networks[0], [text, plain])
    assert sum(read) <= 8 * pii.READ
    monkeypatch.setattr(pii, "seeded_paths", lambda m, parts, seeds: pii.paths(m, parts))
    assert got == pii.network_spans(networks[0], [text, plain]) == [[("email", len(plain), len(plain) + len(item))], []]
    assert sum(read) > 100_000
