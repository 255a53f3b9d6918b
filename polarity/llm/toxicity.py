"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Words are runs of letters and digits, A-Z as lower case. A word's input is the
vector of the word and those of its first AFFIXES bytes and last ones, as far
as training has seen them, plus the scaled sum of its character-trigram
vectors (every word has these). Texts are read in overlapping
windows of WINDOW words, half a window apart, so that each word is seen in
full context; attention pools a window's states to one logit, and a document
scores as its most toxic window. Training (numpy, on the driver) learns from a
bounded sample of labelled documents: at each step all windows of a batch are
scored and the gradient flows through each document's best window.

Scoring runs in Arrow batches in tasks; nothing but the weights (about 1 MB)
travels. Windows are scored in blocks of one shape, the last filled with empty
windows, and by products that sum every row alike (``_times``): a matrix product
may sum otherwise in another shape or place, and a score depends on the text
alone. Contract: null and blank texts are one empty window,
scored as such; equal texts score equal to the last bit; no labelled rows give an untrained constant model;
columns of the input are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from polarity.llm import words as W
from polarity.llm.common import arrow_batches, labelled_sample, trim_memory

WINDOW = 32
STRIDE = 16
DIM = 8
HIDDEN = 8
CHAR_BINS = 4096
#: bounds of the labelled sample: documents, and bytes of each of them
TRAIN_DOCS = 4000
TRAIN_BYTES = 16_384
MIN_DOCS = 3
#: lengths in bytes of the starts (positive) and ends (negative) of words that
#: have vectors of their own
AFFIXES = (4, 5, 6, 7, -4)
CHAR_SCALE = np.float32(0.2)
EPOCHS = 6
BATCH = 128
#: small samples are gone through more often, in smaller batches
MIN_STEPS = 200
RATE = 0.02
CHUNK = 2 << 20
#: windows scored at once
BLOCK = 1024

_rng = np.random.Generator(np.random.PCG64(7))
_MIX = _rng.integers(0, CHAR_BINS, (3, 256)).astype(np.int32)
_BETWEEN = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_FOLD = np.where(_BETWEEN, np.uint8(32), W._LOWER).astype(np.uint8)


# ---------------------------------------------------------------- inputs

def char_codes(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A trigram bin for every byte; what lies outside a word is a blank."""
    b = np.concatenate([[np.uint8(32)], _FOLD[raw], [np.uint8(32)]])
    before, after = b[:-2].copy(), b[2:].copy()
    inner = offsets[(offsets > 0) & (offsets < len(raw))]
    before[inner] = 32
    after[inner - 1] = 32
    code = _MIX[0][before]
    code ^= _MIX[1][b[1:-1]]
    code ^= _MIX[2][after]
    return code


def _ranges(start, width):
    """start[0], start[0] + 1, ... for every range, in one array."""
    ends = np.cumsum(width)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.repeat(start - ends + width, width) + np.arange(ends[-1])


def affix_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A row of hashes per affix (0 where a word is no longer than it)."""
    out = np.zeros((len(AFFIXES), len(start)), np.uint64)
    for k, n in enumerate(AFFIXES):
        long = np.flatnonzero(end - start > abs(n))
        s, e = (start[long], start[long] + n) if n > 0 else (end[long] + n, end[long])
        out[k, long] = W.hash_between(sums, s, e) + np.uint64(k + 1)
    return out


def distinct_words(raw: np.ndarray, offsets: np.ndarray):
    """(hashes: own and affixes', start, end) of the distinct words, the
    number of each word in order among them, and its row."""
    start, end, row = W.word_bounds(raw, offsets, _BETWEEN)
    sums = W.prefix_sums(raw, lower=True)
    h, first, number = np.unique(W.hash_between(sums, start, end), return_index=True,
                                 return_inverse=True)
    start, end = start[first], end[first]
    return np.vstack([h[None], affix_hashes(sums, start, end)]), start, end, number.ravel(), row


def token_inputs(model: dict, raw: np.ndarray, offsets: np.ndarray):
    """(input vectors, row) of every word; each distinct one is made once."""
    hashes, start, end, number, row = distinct_words(raw, offsets)
    if not len(row):
        return np.zeros((0, DIM), np.float32), row
    codes = char_codes(raw, offsets)[_ranges(start, end - start)]
    x = CHAR_SCALE * np.add.reduceat(model["char"][codes],
                                     np.cumsum(end - start) - (end - start), axis=0)
    for h in hashes:
        x += model["word"][word_ids(model["words"], h)]
    return x[number], row


def word_ids(known: np.ndarray, h: np.ndarray) -> np.ndarray:
    """1 + place in the sorted array of known words; 0 for others."""
    if not len(known):
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, at + 1, 0)


def windows(row: np.ndarray, n_rows: int):
    """(window's row, place of its first word, words in it) for all windows;
    rows without words have one empty window."""
    first = W.row_starts(row, n_rows)
    n = np.diff(first)
    per = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    wrow = np.repeat(np.arange(n_rows), per)
    k = np.arange(len(wrow)) - np.repeat(np.cumsum(per) - per, per)
    start = first[:-1][wrow] + k * STRIDE
    return wrow, start, np.clip(n[wrow] - k * STRIDE, 0, WINDOW)


# ---------------------------------------------------------------- network

def _sig(x):
    return 1.0 / (1.0 + np.exp(-x))


def _times(x, w):
    """x @ w with every row summed alike: BLAS sums a row by its place in the
    block on some processors."""
    return np.einsum("...h,hk->...k" if w.ndim == 2 else "...h,h->...", x, w)


def _gru(x, length, p, d, back, keep=None):
    """States (T, N, H) of one direction; x: (T, N, 3H) projected inputs."""
    t_max, n, _ = x.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((t_max, n, HIDDEN), np.float32)
    u = p[f"u{d}"]
    for t in (range(t_max - 1, -1, -1) if back else range(t_max)):
        g = _times(h, u) if keep is None else h @ u
        a = x[t]
        zr = _sig(a[:, :2 * HIDDEN] + g[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        gn = g[:, 2 * HIDDEN:]
        c = np.tanh(a[:, 2 * HIDDEN:] + r * gn)
        new = c + z * (h - c)
        live = (length > t)[:, None]
        if keep is not None:
            keep[t] = (h, z, r, gn, c, live)
        h = np.where(live, new, h)
        out[t] = h
    return out


def forward(p: dict, x, length, keep: bool = False):
    """Logits of windows; x: (T, N, DIM) inputs, zero beyond a window's end."""
    caches = ({}, {}) if keep else (None, None)
    times = np.matmul if keep else _times
    f = _gru(times(x, p["wf"]) + p["bf"], length, p, "f", False, caches[0])
    b = _gru(times(x, p["wb"]) + p["bb"], length, p, "b", True, caches[1])
    e = times(f, p["af"]) + times(b, p["ab"])
    live = np.arange(x.shape[0])[:, None] < np.maximum(length, 1)
    e = np.where(live, e, np.float32(-1e9))
    e = np.exp(e - e.max(0))
    alpha = e / e.sum(0)
    cf = np.einsum("tn,tnh->nh", alpha, f)
    cb = np.einsum("tn,tnh->nh", alpha, b)
    logit = times(cf, p["of"]) + times(cb, p["ob"]) + p["o"][0]
    return (logit, (f, b, alpha, cf, cb, caches)) if keep else logit


def backward(p: dict, x, length, state, dlogit):
    """Gradients of the weights, and of the inputs."""
    f, b, alpha, cf, cb, caches = state
    g = {"o": np.array([dlogit.sum()], np.float32), "of": cf.T @ dlogit, "ob": cb.T @ dlogit}
    dx = np.zeros_like(x)
    hs = {"f": f, "b": b}
    dc = {"f": dlogit[:, None] * p["of"], "b": dlogit[:, None] * p["ob"]}
    da = np.einsum("nh,tnh->tn", dc["f"], f) + np.einsum("nh,tnh->tn", dc["b"], b)
    de = alpha * (da - (alpha * da).sum(0))
    for d, cache in zip("fb", caches):
        dh_all = alpha[:, :, None] * dc[d] + de[:, :, None] * p[f"a{d}"]
        g[f"a{d}"] = np.einsum("tn,tnh->h", de, hs[d])
        gu, gw = np.zeros_like(p[f"u{d}"]), np.zeros_like(p[f"w{d}"])
        gb = np.zeros_like(p[f"b{d}"])
        dh = np.zeros_like(dh_all[0])
        steps = range(x.shape[0]) if d == "b" else range(x.shape[0] - 1, -1, -1)
        for t in steps:
            h, z, r, gn, c, live = cache[t]
            dh = dh + dh_all[t]
            dn = np.where(live, dh, 0)
            dcand = dn * (1 - z) * (1 - c * c)
            dz = dn * (h - c) * z * (1 - z)
            dr = dcand * gn * r * (1 - r)
            dproj = np.concatenate([dz, dr, dcand], 1)
            dgate = np.concatenate([dz, dr, dcand * r], 1)
            gu += h.T @ dgate
            gw += x[t].T @ dproj
            gb += dproj.sum(0)
            dx[t] += dproj @ p[f"w{d}"].T
            dh = np.where(live, dn * z, dh) + dgate @ p[f"u{d}"].T
        g[f"u{d}"], g[f"w{d}"], g[f"b{d}"] = gu, gw, gb
    return g, dx


def _window_inputs(x, start, length):
    t = np.arange(WINDOW)[:, None]
    live = t < length
    at = np.where(live, start + t, 0)
    out = x[at] if len(x) else np.zeros((*at.shape, DIM), np.float32)
    out[~live] = 0
    return out


def logits(model: dict, raw: np.ndarray, offsets: np.ndarray):
    """(logit, row) of all windows of all texts."""
    x, row = token_inputs(model, raw, offsets)
    wrow, start, length = windows(row, len(offsets) - 1)
    n = len(wrow)
    start, length = (np.pad(v, (0, -n % BLOCK)) for v in (start, length))
    out = [forward(model["net"], _window_inputs(x, start[a:a + BLOCK], length[a:a + BLOCK]),
                   length[a:a + BLOCK]) for a in range(0, n, BLOCK)]
    return np.concatenate(out)[:n] if out else np.zeros(0, np.float32), wrow


def score_texts(model: dict, column: pa.Array):
    """(score, windows) per text: the sigmoid of its highest window."""
    raw, offsets = W.utf8(column)
    score, count = np.zeros(len(column)), np.zeros(len(column), np.int64)
    for a, b in W.chunks(offsets, CHUNK):
        o = offsets[a:b + 1]
        z, wrow = logits(model, raw[o[0]:o[-1]], o - o[0])
        first = W.row_starts(wrow, b - a)
        score[a:b] = _sig(np.maximum.reduceat(z, first[:-1]).astype(np.float64))
        count[a:b] = np.diff(first)
    return score, count


# ---------------------------------------------------------------- training

def _init(words: np.ndarray, odds: np.ndarray, rng) -> dict:
    r = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
    net = {"o": np.array([-2.0], np.float32)}
    for d in "fb":
        net |= {f"w{d}": r(DIM, 3 * HIDDEN), f"u{d}": r(HIDDEN, 3 * HIDDEN),
                f"b{d}": np.zeros(3 * HIDDEN, np.float32), f"a{d}": r(HIDDEN), f"o{d}": r(HIDDEN)}
    word = r(len(words) + 1, DIM) * np.float32(0.1)
    word[1:, 0] += odds  # start from each word's own evidence
    word[0] = 0
    return {"words": words, "word": word, "char": r(CHAR_BINS, DIM) * np.float32(0.1), "net": net}


class _Words:
    """The distinct words of the training texts: for each the numbers of its
    vectors (of the known ones) and its trigram codes; and the words of every
    text as numbers of these. Read chunk by chunk, so that the byte-wise
    arrays stay small."""

    def __init__(self, texts: list[str]):
        raw, offsets = W.utf8(pa.array(texts, pa.large_string()))
        hashes, codes, width, number, row, base = [], [], [], [], [], 0
        for a, b in W.chunks(offsets, 1 << 20):
            o = offsets[a:b + 1]
            part, po = raw[o[0]:o[-1]], o - o[0]
            h, start, end, num, r = distinct_words(part, po)
            hashes.append(h)
            codes.append(char_codes(part, po)[_ranges(start, end - start)] if len(start)
                         else np.zeros(0, np.int32))
            width.append(end - start)
            number.append(num + base)
            row.append(r + a)
            base += len(start)
        hashes = np.concatenate(hashes, 1) if hashes else np.zeros((1 + len(AFFIXES), 0), np.uint64)
        codes = np.concatenate(codes) if codes else np.zeros(0, np.int32)
        width = np.concatenate(width) if width else np.zeros(0, np.int64)
        _, first, same = np.unique(hashes[0], return_index=True, return_inverse=True)
        at = np.cumsum(width) - width
        self.hashes = hashes[:, first]
        self.codes = codes[_ranges(at[first], width[first])] if len(first) else codes
        self.width = width[first]
        self.at = np.cumsum(self.width) - self.width
        self.number = same.ravel()[np.concatenate(number)] if number else np.zeros(0, np.int64)
        self.row = np.concatenate(row) if row else np.zeros(0, np.int64)

    def vocabulary(self, y: np.ndarray):
        """Sorted hashes of the words and affixes in MIN_DOCS texts or more,
        and the log odds of each for label 1."""
        pairs = np.unique(self.number * len(y) + self.row)
        word, doc = pairs // len(y), pairs % len(y)
        known, odds = [], []
        for h in self.hashes:
            u, inverse = np.unique(h, return_inverse=True)
            both = np.unique(inverse.ravel()[word] * len(y) + doc)
            feature, label = both // len(y), y[both % len(y)]
            df, pos = np.bincount(feature, minlength=len(u)), np.bincount(feature, label, len(u))
            use = (df >= MIN_DOCS) & (u != 0)
            known.append(u[use])
            odds.append(np.log(((pos + 0.5) / (y.sum() + 1))
                               / ((df - pos + 0.5) / (len(y) - y.sum() + 1)))[use])
        known, odds = np.concatenate(known), np.concatenate(odds)
        order = np.argsort(known)
        return known[order], odds[order].astype(np.float32)

    def place(self, known: np.ndarray) -> None:
        self.ids = np.stack([word_ids(known, h) for h in self.hashes], 1).astype(np.int32)

    def inputs(self, m: dict, words: np.ndarray) -> np.ndarray:
        u, inverse = np.unique(words, return_inverse=True)
        if not len(u):
            return np.zeros((0, DIM), np.float32)
        w = self.width[u]
        x = CHAR_SCALE * np.add.reduceat(m["char"][self.codes[_ranges(self.at[u], w)]],
                                         np.cumsum(w) - w, axis=0)
        return (x + m["word"][self.ids[u]].sum(1))[inverse.ravel()]

    def gradients(self, m: dict, words: np.ndarray, dx: np.ndarray) -> dict:
        g = {"word": np.zeros_like(m["word"]), "char": np.zeros_like(m["char"])}
        if len(words):
            for f in range(self.ids.shape[1]):
                np.add.at(g["word"], self.ids[words, f], dx)
            w = self.width[words]
            np.add.at(g["char"], self.codes[_ranges(self.at[words], w)],
                      np.repeat(dx * CHAR_SCALE, w, axis=0))
        g["word"][0] = 0  # what training has not seen has no vector
        return g


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 1) -> dict:
    """Train on whole texts; an all-alike or empty label set gives a constant."""
    rng = np.random.Generator(np.random.PCG64(seed))
    y = np.asarray(labels, np.float32)
    if not len(y) or y.min() == y.max():
        m = _init(np.zeros(0, np.uint64), np.zeros(0, np.float32), rng)
        m["net"] = {k: np.zeros_like(v) for k, v in m["net"].items()}
        m["net"]["o"][0] = 4.0 if len(y) and y[0] else -4.0
        return m
    data = _Words(texts)
    known, odds = data.vocabulary(y)
    m = _init(known, np.clip(odds, -3, 3) / 3, rng)
    data.place(known)
    net = m["net"]
    first = W.row_starts(data.row, len(y))
    wrow, wstart, wlen = windows(data.row, len(y))
    wfirst = W.row_starts(wrow, len(y))
    weight = np.where(y > 0, min(4.0, float(np.sqrt((y == 0).sum() / y.sum()))), 1.0)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in
               {**net, "word": m["word"], "char": m["char"]}.items()}
    batch = min(BATCH, max(16, len(y) // 8))
    epochs = max(epochs, -(-MIN_STEPS * batch // len(y)))
    step = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(y))
        for a in range(0, len(order), batch):
            docs = np.sort(order[a:a + batch])
            size = first[docs + 1] - first[docs]
            spans = _ranges(first[docs], size) if size.sum() else np.zeros(0, np.int64)
            x = data.inputs(m, data.number[spans])
            n_wins = wfirst[docs + 1] - wfirst[docs]
            wins, local = _ranges(wfirst[docs], n_wins), np.repeat(np.arange(len(docs)), n_wins)
            # a window's place among the batch's words
            ws = wstart[wins] - np.repeat(first[docs] - (np.cumsum(size) - size), n_wins)
            wl = wlen[wins]
            z = np.concatenate([forward(net, _window_inputs(x, ws[i:i + 2048], wl[i:i + 2048]),
                                        wl[i:i + 2048]) for i in range(0, len(wins), 2048)])
            best = np.lexsort((z, local))[np.searchsorted(local, np.arange(len(docs)), "right") - 1]
            bs, bl = ws[best], wl[best]
            xin = _window_inputs(x, bs, bl)
            zb, state = forward(net, xin, bl, keep=True)
            dz = ((_sig(zb) - y[docs]) * weight[docs] / len(docs)).astype(np.float32)
            g, dx = backward(net, xin, bl, state, dz)
            t = np.arange(WINDOW)[:, None]
            live = t < bl
            g |= data.gradients(m, data.number[spans[(bs + t)[live]]], dx[live])
            step += 1
            for k, grad in g.items():
                target = m[k] if k in ("word", "char") else net[k]
                m1, m2 = moments[k]
                m1 += 0.1 * (grad - m1)
                m2 += 0.01 * (grad * grad - m2)
                target -= (rate * (m1 / (1 - 0.9 ** step))
                           / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return m


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 5) -> dict:
    """Fit on at most TRAIN_DOCS labelled documents of at most TRAIN_BYTES
    bytes, in order of a hash of their id; documents whose crc32 of the id
    modulo ``folds`` is 0 are held out."""
    model = fit(*labelled_sample(docs, labels, label_col, folds, TRAIN_DOCS, TRAIN_BYTES, "train"))
    trim_memory()
    return model


def score(docs: DataFrame, model: dict, text_col: str = "text", score_col: str = "score",
          windows_col: str = "n_windows") -> DataFrame:
    """``docs`` with two columns more (their names must be new)."""
    arrow_batches(docs.sparkSession)
    names = docs.columns
    at = names.index(text_col)
    schema = StructType(docs.schema.fields + [StructField(score_col, DoubleType()),
                                              StructField(windows_col, LongType())])
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # about 1 MB, by TRAIN_DOCS

    def run(batches):
        for batch in batches:
            s, n = score_texts(shipped.value, batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array(n)],
                                             names=[*names, score_col, windows_col])
    return docs.mapInArrow(run, schema)
