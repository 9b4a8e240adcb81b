"""Personal data: fixed patterns and a character-level BiLSTM with CRF transitions.

The patterns find emails, IPv4 addresses, payment cards (Luhn) and phone numbers.
The network, trained in numpy from labelled spans, adds written forms that they
miss.  Labelled spans are pattern spans of at most SAMPLE documents, part of them
rewritten in other forms, with look-alikes that are no personal data.

The network's spans are those of the best tag path of the whole text, whatever its length.
It reads in overlapping windows of READ; a character's tag scores are averaged over its
windows, weighted by the distance from the window's edge.  So that many paths are found
together, a text is cut where the scores prove that the best path is outside whatever
stands before and after; this changes no path.  A long text with no such place is worked on
in parts of PART characters: the scores at each part's start are kept on the way forward,
and a part's steps are worked out again on the way back, so memory does not grow with a
text but for a byte or so a character.

Only sound spans are given out, and each of these holds a decimal digit, an at sign or a
spelled one: a seed.  Every character of every text is looked at for seeds; of the path,
only what lies about a seed is worked out, up to places on both sides where it is proven to
be outside whatever stands beyond.  Windows that no such stretch needs are not read.  Where
the proof fails the stretch widens, up to the whole text, so spans are those of the whole path.

Null and empty texts have no spans.  Repeated rows are read one by one; a null id stays
null.  Of equally good paths the one with the lower tags holds.  Spans are ordered by
start, kind and end.  Extra columns are ignored by find_spans and kept bit for bit by
redact; an empty table gives no rows.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_arrow, named, renamed, sampled, small_batches

KINDS = ("email", "ip", "card", "phone")
#: Documents, and spans of each, that the network is trained on, at most.
SAMPLE, CONTEXTS = 400, 20
WINDOW, REACH = 64, 24
#: Characters of the windows that texts are read in, from one's start to the next, and windows read abreast.
READ, STRIDE, ABREAST = 256, 224, 480
#: Windows of one matrix product: so small that the product never spreads over threads, which would burn several times the work.
LOT = 80
#: A path is cut once in so many characters, after so many that show it to be outside; characters whose scores are held together.
CUT, LEAD, TOGETHER = 256, 64, 1 << 20
#: Places that are looked at before those already cut are left out.
STEP = 8
#: Characters on either side of a seed in which a stretch is first tried to be cut.
NEAR = 24
HIDDEN = 16
STEPS, BATCH = 400, 32
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
MARKS = " \t\n.@-+()_%:=\"/,'#*"
CLASSES = 6 + len(MARKS) + 1

Span = tuple[str, int, int]

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
GATE = re.compile(r"[\d@]|\b[Dd][Oo][Tt]\b")
#: What every match of SPELLED_AT holds.
SEED_AT = re.compile(r"[\s(\[{][Aa][Tt](?=[\s)\]}])")
#: Characters whose windows are scored, and cells (characters times runs) whose paths are found together.
PART, CELLS = 1 << 16, 1 << 18
#: Characters whose parts are shown to be outside together.
SEEN = 1 << 14
# How an at sign and a full stop are spelled out.
SPELLED_AT, SPELLED_DOT = re.compile(r"\s*[(\[{]\s*at\s*[)\]}]\s*|\s+at\s+", re.I), re.compile(r"\s*[(\[{]\s*dot\s*[)\]}]\s*|\s+dot\s+", re.I)


_DECIMALS: dict[int, str] = {}
_DIGITS: list[np.ndarray] = []


def decimals() -> dict[int, str]:
    """Every decimal digit of another script -> its ASCII digit; worked out once a process."""
    if not _DECIMALS:
        _DECIMALS.update({c: str(d) for c in range(128, sys.maxunicode + 1) if (d := unicodedata.decimal(chr(c), None)) is not None})
    return _DECIMALS


def other_digits() -> np.ndarray:
    """The codes of `decimals`, ascending."""
    if not _DIGITS:
        _DIGITS.append(np.array(sorted(decimals()), np.uint32))
    return _DIGITS[0]


def plain_digits(text: str) -> str:
    return text if text.isascii() else text.translate(decimals())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The pattern spans, sorted by start and kind."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:  # from each at sign leftwards: no start is tried twice
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    if re.search("[0-9]", text):
        for m in IP.finditer(text):
            if all(int(p) <= 255 for p in (x.lstrip("0")[:4] or "0" for x in m[0].split("."))):
                out.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            d = only_digits(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(only_digits(m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return sorted(out, key=order)


def order(s: Span) -> tuple[int, int, int]:
    return s[1], KINDS.index(s[0]), s[2]


def char_classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = np.full(257, 5, np.int8)
    table[48:58], table[97:123], table[65:91] = 1, 2, 3
    for i, c in enumerate(MARKS):
        table[ord(c)] = 6 + i
    table[192:] = 4
    out = table[np.minimum(codes, 256)]
    if not text.isascii():  # digits of other scripts are digits
        digits = other_digits()
        high = np.flatnonzero(codes >= digits[0])
        out[high[digits[np.minimum(np.searchsorted(digits, codes[high]), len(digits) - 1)] == codes[high]]] = 1
    return out


def lstm(wx: np.ndarray, wh: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, list]:
    """Two LSTMs abreast; x: 2 x time x batch of classes.  Hidden states (time first) and what the backward pass needs."""
    _, t, b = x.shape
    n = wh.shape[1]
    h, c = np.zeros((2, b, n)), np.zeros((2, b, n))
    out, kept = np.empty((t, 2, b, n)), []
    which = np.arange(2)[:, None]
    for k in range(t):
        z = wx[which, x[:, k]] + h @ wh
        gates = 0.5 + 0.5 * np.tanh(0.5 * z[:, :, : 3 * n])  # the logistic function
        i, f, o = gates[:, :, :n], gates[:, :, n : 2 * n], gates[:, :, 2 * n :]
        g = np.tanh(z[:, :, 3 * n :])
        before, c = c, f * c + i * g
        tc = np.tanh(c)
        kept.append((h, before, i, f, o, g, tc))
        h = o * tc
        out[k] = h
    return out, kept


def lstm_back(wx: np.ndarray, wh: np.ndarray, x: np.ndarray, kept: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = wh.shape[1]
    dwh = np.zeros_like(wh)
    back = wh.transpose(0, 2, 1)
    dh, dc = np.zeros_like(dout[0]), np.zeros_like(dout[0])
    every = np.empty((2, len(kept), *dout[0].shape[1:2], 4 * n))
    for k in range(len(kept) - 1, -1, -1):
        h, before, i, f, o, g, tc = kept[k]
        dh = dh + dout[k]
        dc = dc + dh * o * (1 - tc * tc)
        dz = every[:, k]
        dz[:, :, :n] = dc * g * i * (1 - i)
        dz[:, :, n : 2 * n] = dc * before * f * (1 - f)
        dz[:, :, 2 * n : 3 * n] = dh * tc * o * (1 - o)
        dz[:, :, 3 * n :] = dc * i * (1 - g * g)
        dwh += h.transpose(0, 2, 1) @ dz
        dh, dc = dz @ back, dc * f
    cells = x[0].size
    seen = np.zeros((2, cells, wx.shape[1]))
    for d in (0, 1):
        seen[d, np.arange(cells), x[d].ravel()] = 1
    return seen.transpose(0, 2, 1) @ every.reshape(2, cells, 4 * n), dwh


def both(m: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights and inputs of the two directions."""
    return np.stack([m["fx"], m["bx"]]), np.stack([m["fh"], m["bh"]]), np.stack([x, x[::-1]])


def tag_scores(m: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, tuple]:
    """time x batch x tags."""
    a, kept = lstm(*both(m, x))
    h = np.concatenate([a[:, 0], a[::-1, 1]], axis=2)
    return h @ m["out"] + m["bias"], (h, kept)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def loss_and_grads(m: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood of tag paths y under the CRF."""
    s, (h, kept) = tag_scores(m, x)
    t, b, k = s.shape
    move = m["move"]
    alpha, beta = np.empty_like(s), np.zeros_like(s)
    alpha[0] = s[0]
    for i in range(1, t):
        alpha[i] = s[i] + log_sum(alpha[i - 1][:, :, None] + move, 1)
    for i in range(t - 2, -1, -1):
        beta[i] = log_sum(move + (s[i + 1] + beta[i + 1])[:, None, :], 2)
    z = log_sum(alpha[-1], 1)
    ds = np.exp(alpha + beta - z[:, None])
    dmove = np.exp(alpha[:-1, :, :, None] + move + (s[1:] + beta[1:])[:, :, None, :] - z[:, None, None]).sum(axis=(0, 1))
    at = np.arange(t)[:, None], np.arange(b), y
    gold = s[at].sum() + move[y[:-1], y[1:]].sum()
    ds[at] -= 1
    np.add.at(dmove, (y[:-1].ravel(), y[1:].ravel()), -1)
    n = m["fh"].shape[0]
    dh = ds @ m["out"].T
    g = {"out": h.reshape(-1, 2 * n).T @ ds.reshape(-1, k), "bias": ds.sum(axis=(0, 1)), "move": dmove}
    dwx, dwh = lstm_back(*both(m, x), kept, np.stack([dh[:, :, :n], dh[::-1, :, n:]], axis=1))
    g |= {"fx": dwx[0], "bx": dwx[1], "fh": dwh[0], "bh": dwh[1]}
    return float(z.sum() - gold) / b, {key: v / b for key, v in g.items()}


def fresh(rng: np.random.Generator, n: int = HIDDEN) -> dict[str, np.ndarray]:
    m = {"fx": rng.normal(0, 0.3, (CLASSES, 4 * n)), "bx": rng.normal(0, 0.3, (CLASSES, 4 * n)), "fh": rng.normal(0, n**-0.5, (n, 4 * n)), "bh": rng.normal(0, n**-0.5, (n, 4 * n))}
    return m | {"out": rng.normal(0, 0.2, (2 * n, TAGS)), "bias": np.zeros(TAGS), "move": np.zeros((TAGS, TAGS))}


def written(kind: str, rng: np.random.Generator) -> str:
    """A made-up item of the kind in one of the forms people write."""
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, int(rng.integers(3, 9))))
    pick = lambda *forms: forms[int(rng.integers(len(forms)))]
    if kind == "email":
        return pick(f"{word()}.{word()}@{word()}.com", f"{word()}{digits(2)}@{word()}.{word()}.org", f"{word()}@{word()}.de", f"{word()} @ {word()}.com", f"{word()}_{word()}@{word()}.net", f"{word()} at {word()} dot com", f"{word()} [at] {word()} [dot] org", f"{word()}.{word()}(at){word()}.net")
    if kind == "ip":
        return ".".join(str(int(v)) for v in rng.integers(0, 256, 4))
    if kind == "card":
        d = pick("4", "5") + digits(15)
        return pick(d, f"{d[:4]} {d[4:8]} {d[8:12]} {d[12:]}", f"{d[:4]}-{d[4:8]}-{d[8:12]}-{d[12:]}")
    a, b, c = digits(3), digits(3), digits(4)
    return pick(f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"001 {a} {b} {c}", f"+44 {a} {b} {c}", f"{a}.{b}.{c}")


def look_alike(rng: np.random.Generator) -> str:
    """Text with digits or an at sign that is no personal data."""
    hexes = "".join("0123456789abcdef"[c] for c in rng.integers(0, 16, int(rng.integers(16, 41))))
    n = [int(v) for v in rng.integers(1, 10_000, 4)]
    forms = (f'token = "{hexes}"', f"password={hexes[:18]}", f"Version {n[0] % 9}.{n[1] % 10}", f"{1900 + n[0] % 150}-{n[1] % 12 + 1:02}-{n[2] % 28 + 1:02}", f"{n[0]},{n[1] % 1000:03}.{n[2] % 100:02}", f"No. {n[0]}{n[1]}", f"{n[0] % 24}:{n[1] % 60:02}", f"@{hexes[:5]}", f"{n[0]} {n[1] % 100} {n[2]}", f"AKIA{hexes[:16].upper()}", "a dot at the end", f"{hexes[:3]} dot {hexes[3:6]} at noon")
    return forms[int(rng.integers(len(forms)))]


Context = tuple[str, str, str, str]


def contexts_of(texts: list[str]) -> list[Context]:
    """(text before, kind, item, text after) of the labelled spans."""
    contexts = []
    for text in texts:
        spans = [s for s in base_spans(text)]
        for i in range(0, len(spans), 1 + len(spans) // CONTEXTS):  # spread over the whole text
            kind, s, e = spans[i]
            if all(k == kind or e2 <= s or s2 >= e for k, s2, e2 in spans[max(0, i - 4) : i + 5]):
                contexts.append((text[max(0, s - WINDOW) : s], kind, text[s:e], text[e : e + WINDOW]))
    return contexts


def windows_for_training(contexts: list[Context], rng: np.random.Generator, count: int) -> tuple[np.ndarray, np.ndarray]:
    contexts = contexts or [("see ", k, written(k, rng), " and so on. " * 6) for k in KINDS]
    x, y = np.zeros((count, WINDOW), np.int64), np.zeros((count, WINDOW), np.int64)
    for row in range(count):
        left, kind, item, right = contexts[int(rng.integers(len(contexts)))]
        draw = rng.random()
        if draw < 0.3:
            kind, item = "", look_alike(rng)
        elif draw < 0.75:
            kind = KINDS[int(rng.integers(len(KINDS)))]
            item = written(kind, rng)
        if GATE.search(left) or GATE.search(right):  # keep what is around free of other items
            left, right = GATE.sub("a", left), GATE.sub("a", right)
        lead = int(rng.integers(0, max(1, min(len(left), WINDOW - len(item)) + 1)))
        text = (left[len(left) - lead :] + item + right + " " * WINDOW)[:WINDOW]
        x[row] = char_classes(text)
        if kind:
            tag = 1 + 2 * KINDS.index(kind)
            y[row, lead : lead + len(item)] = tag + 1
            if lead < WINDOW:
                y[row, lead] = tag
    return x, y


def train(texts: list[str], seed: int = 5, steps: int = STEPS) -> dict[str, np.ndarray]:
    """Adam on windows made from the texts' labelled spans."""
    rng = np.random.default_rng(seed)
    m = fresh(rng)
    first = {k: np.zeros_like(v) for k, v in m.items()}
    second = {k: np.zeros_like(v) for k, v in m.items()}
    contexts = contexts_of(texts)
    for step in range(1, steps + 1):
        x, y = windows_for_training(contexts, rng, BATCH)
        _, g = loss_and_grads(m, x.T.copy(), y.T.copy())
        rate = 0.02 * (1 - 0.9 * step / steps)
        for k in m:
            grad = np.clip(g[k], -5, 5)
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.99 * second[k] + 0.01 * grad * grad
            m[k] = m[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return m


def stretches(text: str) -> list[tuple[int, int]]:
    """The parts within REACH characters of a digit, an at sign or the word "dot", where most items stand; the network reads beyond them."""
    out: list[list[int]] = []
    for m in GATE.finditer(text):
        s, e = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and s <= out[-1][1]:
            out[-1][1] = e
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def reader(m: dict[str, np.ndarray]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Tag scores of windows (batch x time of classes, and their sizes, the longest first) in single precision, for reading only: batch x tags x time.

    Each direction starts at its own end of every window, so windows of any sizes go abreast.  The product that gives a
    step's gates also gives what the state before it adds to its own tag scores.
    """
    n = m["fh"].shape[0]
    half = np.r_[np.full(3 * n, 0.5), np.ones(n)]  # the logistic function by tanh of the half; gates and states are kept doubled
    tags = np.split(m["out"] / 2, 2)
    w = np.stack([np.hstack([np.vstack([m[h] / 2, m[x]]) * half, np.vstack([own, np.zeros((CLASSES, TAGS))])]) for h, x, own in zip(("fh", "bh"), ("fx", "bx"), tags)])
    w = w.transpose(0, 2, 1).astype(np.float32)[:, None]
    last, bias = w[:, :, 4 * n :, :n].copy(), m["bias"].astype(np.float32)[:, None]

    def scores(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        b, t = x.shape
        lots = -(-b // LOT)
        # gates lie row by row, so that each step works on one stretch of memory; states lie lot by lot for the product
        given = np.zeros((2, lots, n + CLASSES, LOT), np.float32)  # the state above the class, one of CLASSES
        z, c = np.empty((4 * n + TAGS, 2, lots, LOT), np.float32), np.zeros((n, 2, lots, LOT), np.float32)
        every, new = np.empty((t + 1, TAGS, 2, lots, LOT), np.float32), np.empty_like(c)
        back = np.full_like(x, 6)
        for size in np.unique(sizes).tolist():
            back[sizes == size, :size] = x[sizes == size, :size][:, ::-1]
        lot, at = np.divmod(np.arange(b), LOT)
        where = np.stack([x, back]).transpose(2, 0, 1).astype(np.int64) * LOT + ((lot * (n + CLASSES) + n) * LOT + at)
        where[:, 1] += given.size // 2
        where, cells, ones = where.reshape(t, 2 * b), given.reshape(-1), np.ones(2 * b, np.float32)
        active = -(-np.searchsorted(-sizes, -np.arange(t), side="right") // LOT)  # lots in which a window is not yet read and given out
        for some in np.unique(active)[::-1].tolist():
            input_, state, kinds = given[:, :some], given[:, :some, :n].transpose(2, 0, 1, 3), given[:, :some, n:]
            own = z[:, :, :some]
            product, y, gates, more = own.transpose(1, 2, 0, 3), own[: 4 * n], own[: 3 * n], own[4 * n :]
            i, f, o, g = (own[j * n : (j + 1) * n] for j in range(4))
            cell, state_now, given_out = c[:, :, :some], new[:, :, :some], every[:, :, :, :some]
            for k in np.flatnonzero(active == some).tolist():
                kinds.fill(0)
                cells[where[k]] = ones
                np.matmul(w, input_, out=product)
                given_out[k] = more
                np.tanh(y, out=y)
                gates += 1
                cell *= f
                i *= g
                cell += i
                cell *= 0.5
                np.tanh(cell, out=state_now)
                np.multiply(state_now, o, out=state)
        every[t] = np.matmul(last, given[:, :, :n]).transpose(2, 0, 1, 3)
        every = every[1:].reshape(t, TAGS, 2, lots * LOT)
        out = np.zeros((b, TAGS, t), np.float32)
        begin = 0
        for end in [*(np.flatnonzero(np.diff(sizes)) + 1).tolist(), b]:
            size = int(sizes[begin])
            whole = every[:size, :, 0, begin:end] + every[size - 1 :: -1, :, 1, begin:end]
            whole += bias
            out[begin:end, :, :size] = whole.transpose(2, 1, 0)
            begin = end
        return out

    return scores


def stretch_scores(m: dict[str, np.ndarray], parts: list[np.ndarray], spans: list[tuple[int, int]] | None = None) -> list[np.ndarray]:
    """Tag scores of each part (of its characters from s to e, by `spans`), averaged over its overlapping windows.

    A part's windows depend on that part alone, so it is read alike in any company.  A tag's scores stand side by side.
    """
    edge = READ - STRIDE
    spans = spans or [(0, len(p)) for p in parts]
    sums = [np.zeros((TAGS + 1, e - s), np.float32) for s, e in spans]  # weighted scores, then weights
    windows: list[tuple[int, int, int]] = []
    for i, (p, (a, b)) in enumerate(zip(parts, spans)):
        first = max(0, (a - READ) // STRIDE + 1) * STRIDE
        for s in range(first, min(b, max(1, len(p) - edge)), STRIDE):
            windows.append((i, s, min(READ, -(-(len(p) - s) // edge) * edge)))
    windows.sort(key=lambda w: -w[2])
    read = reader(m)
    for at in range(0, len(windows), ABREAST):
        some = windows[at : at + ABREAST]
        sizes = np.array([size for _, _, size in some])
        x = np.full((len(some), some[0][2]), 6, np.int8)  # beyond the end stand blanks
        for row, (i, s, size) in enumerate(some):
            piece = parts[i][s : s + size]
            x[row, : len(piece)] = piece
        time = np.arange(x.shape[1])
        scores = np.empty((len(some), TAGS + 1, x.shape[1]), np.float32)
        scores[:, TAGS] = np.minimum(np.minimum(time + 1, sizes[:, None] - time), edge)
        np.multiply(read(x, sizes), scores[:, TAGS:], out=scores[:, :TAGS])
        for row, (i, s, size) in enumerate(some):
            a, b = spans[i]
            x0, x1 = max(s, a), min(s + size, b)
            sums[i][:, x0 - a : x1 - a] += scores[row, :, x0 - s : x1 - s]
    return [np.divide(s[:TAGS], s[TAGS]).T for s in sums]


def settled(move: np.ndarray, scores: list[np.ndarray], tried: list[tuple[int, int]] | None = None, reach: int = LEAD) -> list[list[int]]:
    """Places, one in every CUT characters at most, where the best path is outside whatever stands before.

    `tried`: (which scores, place) instead; a place found is at most `reach` before one of these.

    `lead` bounds what a path that ends in a tag can have over the one that ends outside: at the first place
    whatever came before, then step by step over LEAD characters.  A tag that cannot make its lead good in
    any next step is on no best path.  Scores are marked so that a part may begin or end there.
    """
    out: list[list[int]] = [[] for _ in scores]
    where = [(i, a) for i, s in enumerate(scores) for a in range(CUT, len(s), CUT)] if tried is None else tried
    if not where:
        return out
    before, after = (move - move[:, :1]).max(axis=0)[:, None], np.maximum((move - move[0]).max(axis=1), 0)[:, None]
    lead, found, still = before, np.full(len(where), -1), np.arange(len(where))
    for begin in range(0, reach + 1, STEP):
        end = min(begin + STEP, reach + 1)
        rows = np.stack([scores[i][a - reach + begin : a - reach + end] for i, a in (where[w] for w in still.tolist())], axis=2).astype(float)  # place x tag x where
        rows -= rows[:, :1].copy()
        for k in range(begin, end):
            if k:
                lead = np.minimum(before, (lead[:, None] + move[:, :, None]).max(axis=0) - move[0, 0])
            lead = lead + rows[k - begin]
            found[still[(lead + after)[1:].max(axis=0) < -1e-3]] = k
        open_ = found[still] < 0
        still, lead = still[open_], lead[:, open_]
        if not len(still):
            break
    for (i, a), k in zip(where, found.tolist()):
        if k >= 0:
            place = a - reach + k
            scores[i][place, 0], scores[i][place, 1:] = 0, -1e30
            out[i].append(place)
    return out


def best_paths(move: np.ndarray, scores: list[np.ndarray]) -> list[np.ndarray]:
    """The best tag path of each of some parts of like length, the shortest first.

    Values are kept less that of tag 0, so that single precision does for any length.
    """
    longest, move = max(map(len, scores)), move.astype(np.float32)
    best = np.zeros((longest, TAGS, len(scores)), np.float32)
    for col, own in enumerate(scores):
        best[longest - len(own) :, :, col] = own  # padded in front
    begins = np.array([longest - len(own) for own in scores])
    later = np.searchsorted(-begins, -np.arange(longest), side="right").tolist()  # parts that begin at a place or later come first
    steps, most = np.empty((TAGS, TAGS, len(scores)), np.float32), np.empty((TAGS, len(scores)), np.float32)
    for t in range(1, longest):
        np.add(best[t - 1][:, None], move[:, :, None], out=steps)
        steps.max(axis=0, out=most)
        most -= most[0].copy()
        if later[t]:
            most[:, : later[t]] = 0
        best[t] += most
    tag = best[-1].argmax(axis=0)
    path = np.zeros((longest, len(scores)), np.int8)
    for t in range(longest - 1, 0, -1):
        path[t] = tag
        np.add(best[t - 1], move.take(tag, axis=1), out=most)
        top = most.max(axis=0)
        tag = (most == top).argmax(axis=0)
    path[0] = tag
    return [path[begin:, col] for col, begin in enumerate(begins.tolist())]


def long_path(m: dict[str, np.ndarray], part: np.ndarray) -> np.ndarray:
    """The best tag path of one long part, in memory for PART characters."""
    cuts = [(a, min(a + PART, len(part))) for a in range(0, len(part), PART)]
    move, path = m["move"], np.zeros(len(part), np.int8)

    def forward(a: int, b: int, best: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        (s,) = stretch_scores(m, [part], [(a, b)])
        back = np.zeros(s.shape, np.int8)
        for t in range(len(s)):
            if best is None:
                best = s[0]
                continue
            steps = best[:, None] + move
            back[t] = steps.argmax(axis=0)
            best = s[t] + steps.max(axis=0)
        return best, back

    starts, best = [], None
    for a, b in cuts:
        starts.append(best)
        best, _ = forward(a, b, best)
    tag = int(best.argmax())
    for (a, b), best in zip(reversed(cuts), reversed(starts)):
        _, back = forward(a, b, best)
        for t in range(b - a - 1, -1, -1):
            path[a + t] = tag
            tag = int(back[t, tag])
    return path


def quiet(move: np.ndarray, scores: list[np.ndarray]) -> np.ndarray:
    """Whether the best path of each part is sure to be outside throughout.

    A stay in other tags is a row of segments, each in one kind's tags.  `most` bounds what a segment that ends
    at a character gains over outside: the dearer of stepping in from outside and back (`back`, paid once a stay) and of
    coming from another kind's tags, then the kind's better tag and best step for each character.  Where no segment
    gains, no stay does; one that lasts to the part's end takes no step back, and one from its start no step in.
    What is carried over from the part before only widens the bound.  This, too, changes no path.
    """
    move = move - move[0, 0]
    back = float(move[1:, 0].max())
    ends = np.cumsum([len(s) for s in scores])
    begins = np.r_[0, ends[:-1]]
    gains = np.concatenate([s.T for s in scores], axis=1)  # tags x characters
    gains = np.maximum(gains[1:] - gains[0], np.float32(-100))
    out = np.ones(len(scores), bool)
    for b in range(1, TAGS, 2):
        others = [j for j in range(1, TAGS) if j not in (b, b + 1)]
        enter = np.maximum(move[0, b : b + 2] + back, move[others, b : b + 2].max(axis=0)).astype(np.float32)
        one, two = gains[b - 1], gains[b]
        best = np.maximum(one, two)
        entry = np.maximum(one + enter[0], two + enter[1]).astype(float)
        entry[begins] = np.maximum(entry[begins], best[begins] + max(back, 0))
        so_far = np.cumsum(best + move[b : b + 2, b : b + 2].max(), dtype=float)
        entry -= so_far
        most = np.maximum.accumulate(entry, out=entry)
        most += so_far
        out &= (np.maximum.reduceat(most, begins) < -1e-3) & (most[ends - 1] < min(back, 0) - 1e-3)
    return out


def put_paths(move: np.ndarray, runs: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Writes the best path of each (scores, where it goes, all outside so far); runs of like length go together, CELLS at a time."""
    loud, at = [], 0
    while at < len(runs):
        upto, held = at, 0
        while upto < len(runs) and held < SEEN:
            held += len(runs[upto][0])
            upto += 1
        loud += [r for r, still in zip(runs[at:upto], quiet(move, [s for s, _ in runs[at:upto]]).tolist()) if not still]
        at = upto
    runs = sorted(loud, key=lambda r: len(r[0]))
    at = 0
    while at < len(runs):
        upto = at + 1
        while upto < len(runs) and (upto + 1 - at) * len(runs[upto][0]) <= CELLS:
            upto += 1
        for (_, out), path in zip(runs[at:upto], best_paths(move, [s for s, _ in runs[at:upto]])):
            out[:] = path
        at = upto


def pieces(length: int, places: list[int]) -> list[tuple[int, int]]:
    """A part cut at its settled places, each of which belongs to both sides."""
    return [(a, b + 1) for a, b in zip([0, *places], [*places, length - 1])]


def cut_path(m: dict[str, np.ndarray], part: np.ndarray) -> np.ndarray:
    """The best tag path of one long part, cut where it is settled; a part with over PART characters between such places goes by long_path."""
    path, held, begin = np.zeros(len(part), np.int8), np.zeros((0, TAGS), np.float32), 0
    for a in range(0, len(part), PART):
        held = np.vstack([held, *stretch_scores(m, [part], [(a, min(a + PART, len(part)))])])
        (places,) = settled(m["move"], [held])
        cuts = pieces(len(held), places)
        if a + PART < len(part):
            cuts.pop()
        if any(e - s > PART for s, e in cuts) or not cuts and len(held) > PART:
            return long_path(m, part)
        put_paths(m["move"], [(held[s:e], path[begin + s : begin + e]) for s, e in cuts])
        if places:
            held, begin = held[places[-1] :], begin + places[-1]
    return path


def paths(m: dict[str, np.ndarray], parts: list[np.ndarray]) -> list[np.ndarray]:
    """The best tag path of each part, TOGETHER characters at a time."""
    out = [np.zeros(len(p), np.int8) for p in parts]
    group: list[int] = []
    held = 0

    def settle() -> None:
        scores = stretch_scores(m, [parts[i] for i in group])
        cuts = settled(m["move"], scores)
        put_paths(m["move"], [(s[a:b], out[i][a:b]) for i, s, places in zip(group, scores, cuts) for a, b in pieces(len(s), places)])

    for i, p in enumerate(parts):
        if len(p) > PART:
            out[i] = cut_path(m, p)
        elif len(p):
            if held + len(p) > TOGETHER:
                settle()
                group, held = [], 0
            group.append(i)
            held += len(p)
    settle()
    return out


def seeds_of(text: str, part: np.ndarray) -> np.ndarray:
    """Whether a decimal digit, an at sign or a spelled one stands at each character: every sound span holds one."""
    out = (part == 1) | (part == 6 + MARKS.index("@"))
    for x in SEED_AT.finditer(text):
        out[x.start() + 1] = True
    return out


Stretch = tuple[int, int, int, int, int]  # part, first window, last window, first seed, last seed


def merged(stretches: list[Stretch]) -> list[Stretch]:
    """Stretches of a part that share a window or meet are one."""
    out: list[Stretch] = []
    for i, first, last, lo, hi in sorted(stretches):
        if out and out[-1][0] == i and first <= out[-1][2] + 1:
            _, f, g, a, b = out.pop()
            first, last, lo, hi = f, max(g, last), min(a, lo), max(b, hi)
        out.append((i, first, last, lo, hi))
    return out


def windows_about(i: int, seeds: np.ndarray) -> list[Stretch]:
    """The stretches of part i that hold all within NEAR characters of a seed."""
    edge, out = READ - STRIDE, []
    final = -(-max(1, len(seeds) - edge) // STRIDE) - 1
    for begin in range(0, len(seeds), PART):
        at = begin + np.flatnonzero(seeds[begin : begin + PART])
        if len(at):
            first, last = np.maximum((at - NEAR - edge) // STRIDE, 0), np.minimum((at + NEAR) // STRIDE, final)
            ends = [*np.flatnonzero(first[1:] > last[:-1] + 1).tolist(), len(at) - 1]
            out += [(i, *(int(x) for x in (first[a], last[b], at[a], at[b]))) for a, b in zip([0, *(e + 1 for e in ends)], ends)]
    return merged(out)


def stretch_paths(m: dict[str, np.ndarray], parts: list[np.ndarray], seeds: list[np.ndarray], group: list[tuple[Stretch, int, int]], reach: int, out: list[np.ndarray]) -> list[Stretch]:
    """Writes the best path about the seeds of each (stretch, its exact scores' start and end); those whose ends are not proven outside."""
    scores = stretch_scores(m, [parts[own[0]] for own, _, _ in group], [(a, b) for _, a, b in group])
    tried, open_, runs = [], [], []
    for j, ((*_, lo, hi), a, b) in enumerate(group):
        ends = {lo - a, hi - a + reach, *range(CUT, b - a, CUT)}
        tried += [(j, end) for end in sorted(ends) if reach + (a == 0) <= end < b - a]  # something stands before each
    for (own, a, b), s, places in zip(group, scores, settled(m["move"], scores, tried, reach)):
        i, _, _, lo, hi = own
        cuts = sorted({*places} | ({0} if a == 0 else set()) | ({b - a - 1} if b == len(parts[i]) else set()))
        if not cuts or cuts[0] > lo - a or cuts[-1] < hi - a:
            open_.append(own)
            continue
        for begin, end in zip(cuts, cuts[1:] or cuts):
            if seeds[i][a + begin : a + end + 1].any():
                runs.append((s[begin : end + 1], out[i][a + begin : a + end + 1]))
    put_paths(m["move"], runs)
    return open_


def seeded_paths(m: dict[str, np.ndarray], parts: list[np.ndarray], seeds: list[np.ndarray]) -> list[np.ndarray]:
    """The best tag path of each part wherever a run of tags holds a seed; elsewhere it may be left outside.

    A stretch of windows gives exact scores but for characters that a window beside it reads too.  It is cut before its
    first seed and after its last; where that cannot be proven it takes half its windows more on each side.  A part with
    a stretch of over PART characters goes by cut_path.
    """
    edge = READ - STRIDE
    out = [np.zeros(len(p), np.int8) for p in parts]
    final = [-(-max(1, len(p) - edge) // STRIDE) - 1 for p in parts]
    todo = [x for i, s in enumerate(seeds) for x in windows_about(i, s)]
    long, reach = set(), NEAR
    while todo:
        wider, group, held = [], [], 0
        for own in todo:
            i, first, last, _, _ = own
            a, b = first and first * STRIDE + edge, len(parts[i]) if last == final[i] else (last + 1) * STRIDE
            if b - a > PART:
                long.add(i)
            if i in long:
                continue
            if held + b - a > TOGETHER:
                wider += stretch_paths(m, parts, seeds, group, reach, out)
                group, held = [], 0
            group.append((own, a, b))
            held += b - a
        wider += stretch_paths(m, parts, seeds, group, reach, out)
        todo = merged([(i, max(0, f - (g - f + 2) // 2), min(final[i], g + (g - f + 2) // 2), lo, hi) for i, f, g, lo, hi in wider])
        reach = LEAD
    for i in long:
        out[i] = cut_path(m, parts[i])
    return out


def sound(kind: str, item: str) -> bool:
    """What a span of the kind must hold whatever way it is written; seeds_of finds something of each."""
    item = plain_digits(item)
    d = len(only_digits(item))
    if kind == "email":
        left, at, right = SPELLED_DOT.sub(".", SPELLED_AT.sub("@", item)).partition("@")
        return bool(at and left.strip() and "." in right.strip(" ."))
    if kind == "ip":
        return item.count(".") == 3 and 4 <= d <= 12 and all(p.isdigit() and int(p) <= 255 for p in item.split("."))
    return 12 <= d <= 19 if kind == "card" else 9 <= d <= 15


def tagged(path: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) of each run of a path that begins with a tag and goes on by the same kind's inside."""
    before, after = np.r_[np.int8(0), path[:-1]], np.r_[path[1:], np.int8(0)]
    goes_on = (path > 0) & (path % 2 == 0) & ((before == path) | (before == path - 1))
    starts = np.flatnonzero((path > 0) & ~goes_on)
    ends = np.flatnonzero((path > 0) & ((after == 0) | ~np.r_[goes_on[1:], False])) + 1
    return list(zip(((path[starts] - 1) // 2).tolist(), starts.tolist(), ends.tolist()))


def network_spans(m: dict[str, np.ndarray], texts: list[str]) -> list[list[Span]]:
    """Sound spans on the best tag path of each whole text."""
    out: list[list[Span]] = [[] for _ in texts]
    parts = [char_classes(t) for t in texts]
    for own, text, path in zip(out, texts, seeded_paths(m, parts, [seeds_of(t, p) for t, p in zip(texts, parts)])):
        for kind, a, b in tagged(path) if path.any() else ():
            while a < b and not (text[a].isalnum() or text[a] in "+("):
                a += 1
            while b > a and not text[b - 1].isalnum():
                b -= 1
            if sound(KINDS[kind], text[a:b]):
                own.append((KINDS[kind], a, b))
    return out


def all_spans(m: dict[str, np.ndarray], texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(pattern spans, all spans) of each text; a network span may not touch a pattern span."""
    base = [base_spans(t) for t in texts]
    out = []
    for own, more in zip(base, network_spans(m, texts)):
        starts, ends = [], []  # the pattern spans united, both ascending
        for _, s, e in own:
            if ends and s < ends[-1]:
                ends[-1] = max(ends[-1], e)
            else:
                starts.append(s)
                ends.append(e)
        # the first united span that ends after a span's start must begin at its end or later
        new = [x for x in more if (k := bisect_right(ends, x[1])) == len(ends) or starts[k] >= x[2]]
        out.append((own, sorted(own + new, key=order)))
    return out


def model_of(docs: DataFrame) -> dict[str, np.ndarray]:
    """Trained on at most SAMPLE texts that hold a digit or an at sign."""
    rows = sampled(docs.select("text").where(F.col("text").rlike("[0-9@]")), SAMPLE, "text")
    return train([r["text"] for r in rows.toLocalIterator()])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def chunks(texts: list, chars: int = 2_000_000) -> Iterator[slice]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held > chars:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    yield slice(start, len(texts))


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, counts of pattern spans by kind, base_sha256, spans."""
    small_batches(docs.sparkSession)
    m = model_of(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = ["" if t is None else t for t in b["text"].tolist()]
            got = [x for part in chunks(texts) for x in all_spans(m, texts[part])]
            counts = {f"n_{k}": [sum(s[0] == k for s in own) for own, _ in got] for k in KINDS}
            yield pd.DataFrame({"doc_id": b["doc_id"], "nameless": b["nameless"]} | counts | {"base_sha256": [hashlib.sha256(joined(own).encode()).hexdigest() for own, _ in got], "spans": [joined(every) for _, every in got]})

    return renamed(named(docs, "text").mapInPandas(run, "doc_id long, nameless boolean, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"))


def redact(docs: DataFrame) -> DataFrame:
    """The same rows; every span is replaced by its kind in brackets, overlapping ones by the first's."""
    small_batches(docs.sparkSession)
    m = model_of(docs)

    def clean(text: str, spans: list[Span]) -> str:
        out, at = [], 0
        for kind, s, e in spans:
            if s >= at:
                out += [text[at:s], f"[{kind.upper()}]"]
            at = max(at, e)
        return "".join([*out, text[at:]])

    def change() -> Callable[[list], list]:
        def its(texts: list) -> list:
            full = ["" if t is None else t for t in texts]
            got = [x for part in chunks(full) for x in all_spans(m, full[part])]
            return [t if t is None else clean(t, every) for t, (_, every) in zip(texts, got)]

        return its

    return by_arrow(docs, "text", change)
