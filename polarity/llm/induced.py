"""External induced sorting of a shard's suffixes with common-prefix values.

The text is segments of UTF-8 bytes, each ended by SEP (0xFE, a byte that
UTF-8 never has). Suffixes are sorted as far as their first ``depth`` bytes,
and what is wanted is which of them share that many bytes with another.

1. Left-most-S suffixes are sorted through a reduced text: the substrings
   between them are named in order, eight bytes a round, and names are then
   ranked by doubling until they differ or reach ``depth`` bytes.
2. L suffixes are induced from them in ascending order, then S suffixes in
   descending order. The priority queue of induction is keyed by (first byte,
   order of insertion): a queue per byte, appended in bulk and read in bulk,
   whose tuples (position, common prefix with the tuple before) go to a
   temporary file beyond SPILL bytes. The common prefix of two induced tuples
   is one more than the least among their sources'; so no suffix is ever
   compared except at the seams between L and S tuples of one byte.

The text is a memory map, queues are read CHUNK tuples at a time and dropped
once read for good; the arrays that remain in memory are those of the reduced
text (about a third of the positions, in four bytes each where they fit).
"""

from __future__ import annotations

import tempfile

import numpy as np

SEP = 0xFE
PAD = 0xFF
#: bytes of PAD after the text, so that windows of as many can be read anywhere
MARGIN = 64
SPILL = 4 << 20
#: tuples, pairs or bytes handled at once: scratch arrays of about 300 bytes each
CHUNK = 1 << 16
_TUPLE = np.dtype([("pos", "<i8"), ("lcp", "<i2")])


class Queue:
    """Tuples in order of insertion, read forwards as they come and, once all
    are in, backwards. Beyond SPILL bytes they live in a temporary file."""

    def __init__(self):
        self.held: list[np.ndarray] = []
        self.held_n = self.size = self.read = self.filed = 0
        self.file = None

    def put(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        t = np.empty(len(pos), _TUPLE)
        t["pos"], t["lcp"] = pos, lcp
        self.held.append(t)
        self.held_n += len(t)
        self.size += len(t)
        if self.held_n * _TUPLE.itemsize > SPILL:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            for part in self.held:
                self.file.write(part.tobytes())
            self.filed += self.held_n
            self.held, self.held_n = [], 0

    def span(self, a: int, b: int) -> np.ndarray:
        parts = []
        if a < self.filed:
            self.file.seek(a * _TUPLE.itemsize)
            n = min(b, self.filed) - a
            parts.append(np.frombuffer(self.file.read(n * _TUPLE.itemsize), _TUPLE))
        if b > self.filed:
            if len(self.held) > 1:
                self.held = [np.concatenate(self.held)]
            parts.append(self.held[0][max(a, self.filed) - self.filed:b - self.filed])
        return np.concatenate(parts) if len(parts) > 1 else parts[0]

    def forward(self):
        while self.read < self.size:
            a, self.read = self.read, min(self.size, self.read + CHUNK)
            yield self.span(a, self.read)

    def backward(self):
        """Chunks of reversed tuples; a tuple's lcp is then that with the one
        read before it (the first's is left to the caller)."""
        b, after = self.size, 0
        while b:
            a = max(0, b - CHUNK)
            t = self.span(a, b)
            pos = t["pos"][::-1]
            lcp = np.concatenate([[after], t["lcp"][:0:-1]]).astype(np.int16)
            after, b = t["lcp"][0], a
            yield pos, lcp


def join_segments(segments) -> tuple[np.ndarray, np.ndarray]:
    """(text, starts): a memory-mapped temporary file of the segments (read
    one by one), each ended by SEP, and MARGIN bytes of PAD after them."""
    starts, n = [], 0
    f = tempfile.TemporaryFile()
    for s in segments:
        starts.append(n)
        f.write(s)
        f.write(bytes([SEP]))
        n += len(s) + 1
    f.write(bytes([PAD]) * MARGIN)
    f.flush()
    return np.memmap(f, np.uint8, "r", shape=(n + MARGIN,)), np.array(starts, np.int64)


def _s_types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (the last is not),
    from the end, block by block: a run of one byte has the type of its end."""
    s = np.zeros(len(t), bool)
    after = False
    for b in range(len(t) - 1, 0, -CHUNK):
        a = max(0, b - CHUNK)
        x, y = t[a:b], t[a + 1:b + 1]
        differ = np.flatnonzero(x != y)
        s[a:b] = after
        if len(differ):
            runs = np.diff(np.concatenate([[-1], differ]))
            s[a:a + differ[-1] + 1] = np.repeat(x[differ] < y[differ], runs)
        after = s[a]
    return s


def _places(n: int) -> type:
    """The type of places in a text of n bytes and somewhat beyond."""
    return np.int32 if n < 1 << 30 else np.int64


def _words(text: np.ndarray):
    """View of the eight bytes at every place, as big-endian integers."""
    return np.lib.stride_tricks.sliding_window_view(text, 8)


def _refine(group: np.ndarray, active: np.ndarray, key: np.ndarray):
    """Split groups of active members by key. ``group`` holds the number of
    members in smaller groups. Returns the active ones in sorted order and
    whether each is now alone."""
    order = np.lexsort((key, group[active])) if group[active].any() else np.argsort(key)
    return _split(group, active[order], key[order])


def _refine_pairs(group: np.ndarray, active: np.ndarray, key: np.ndarray, base: int):
    """The same for keys below ``base``: one sort of pairs as single numbers."""
    order = np.argsort(group[active].astype(np.int64) * base + key)
    return _split(group, active[order], key[order])


def _split(group: np.ndarray, a: np.ndarray, k: np.ndarray):
    g = group[a]
    new_old = np.concatenate([[True], g[1:] != g[:-1]])
    new = new_old | np.concatenate([[True], k[1:] != k[:-1]])
    at = np.arange(len(a), dtype=g.dtype)
    first_old = np.maximum.accumulate(np.where(new_old, at, 0))
    first = np.maximum.accumulate(np.where(new, at, 0))
    group[a] = g + (first - first_old)
    last = np.concatenate([new[1:], [True]])
    return a, new & last


def _ranked(text: np.ndarray, lms: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Order of the left-most-S suffixes by their first ``depth`` bytes."""
    m = len(lms)
    lms = lms.astype(_places(n))
    end = np.append(lms[1:] + 1, lms.dtype.type(n))  # takes in the next one's first byte
    group = np.zeros(m, lms.dtype)
    view = _words(text)
    active, c = np.arange(m, dtype=lms.dtype), 0
    while len(active):
        key = np.empty(len(active), np.uint64)
        for b in range(0, len(active), CHUNK):
            some = active[b:b + CHUNK]
            at = lms[some] + 8 * c
            raw = view[np.minimum(at, len(view) - 1)]
            left = end[some] - at
            cut = np.flatnonzero(left < 8)
            if len(cut):  # what has ended sorts after what goes on with the same bytes
                raw[cut] = np.where(np.arange(8) < left[cut, None], raw[cut], PAD)
            key[b:b + CHUNK] = raw.view(">u8").ravel()
        a, alone = _refine(group, active, key)
        c += 1
        # what ends just here sorts after what goes on, too: one round more
        active = a[~alone & (end[a] - lms[a] >= 8 * c)]
    place = np.append(lms, lms.dtype.type(n))
    h = 1
    counts = np.bincount(group, minlength=m).astype(lms.dtype)
    active = np.flatnonzero(counts[group] > 1).astype(lms.dtype)
    del counts, end
    while len(active):
        active = active[place[np.minimum(active + h, m)] - lms[active] < depth]
        if not len(active):
            break
        nxt = active + h
        key = np.where(nxt < m, group[np.minimum(nxt, m - 1)] + 1, 0)
        a, alone = _refine_pairs(group, active, key, m + 1)
        active = np.sort(a[~alone])
        h *= 2
    return np.argsort(group, kind="stable")


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of pairs of suffixes, at most ``depth``: MARGIN bytes a
    round, as eight-byte numbers; bytes only where those differ."""
    out = np.zeros(len(a), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(text, MARGIN)
    last = len(view) - 1
    active = np.arange(len(a))
    while len(active):
        i, j = a[active] + out[active], b[active] + out[active]
        x, y = view[np.minimum(i, last)], view[np.minimum(j, last)]
        differ = x.view(np.uint64) != y.view(np.uint64)
        some = differ.any(1)
        k = np.flatnonzero(some)
        word = differ[k].argmax(1)
        at = np.arange(8) + 8 * word[:, None]
        out[active[k]] += 8 * word + (np.take_along_axis(x[k], at, 1)
                                      != np.take_along_axis(y[k], at, 1)).argmax(1)
        active = active[~some & (i < last) & (j < last)]
        out[active] += MARGIN
        active = active[out[active] < depth]
    return np.minimum(out, depth)


class _Induction:
    """One scan: reads sorted tuples in bulk, puts the suffixes one byte longer
    into the queues of their first byte."""

    def __init__(self, text: np.ndarray, depth: int):
        self.text, self.depth = text, depth
        self.queues = [Queue() for _ in range(256)]
        # least common prefix read since the last tuple put under each byte
        self.since = np.full(256, -1, np.int64)

    def bulk(self, pos: np.ndarray, lcp: np.ndarray, wanted) -> None:
        """``wanted(before, here)``: whether a source with byte ``here`` induces
        a suffix of byte ``before`` in this scan."""
        lcp = lcp.astype(np.int16)
        before = self.text[np.maximum(pos - 1, 0)]
        ok = (pos > 0) & wanted(before, self.text[pos])
        picked = np.flatnonzero(ok)
        byte = before[picked]
        order = np.argsort(byte, kind="stable")
        picked, byte = picked[order], byte[order]
        cuts = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]])) \
            if len(byte) else np.zeros(0, np.int64)
        least = int(lcp.min())
        since = np.minimum(self.since, least)
        for a, b in zip(cuts, np.append(cuts[1:], len(byte))):
            d, idx = int(byte[a]), picked[a:b]
            at = np.concatenate([[0], idx + 1])
            tail = idx[-1] + 1 < len(lcp)
            low = np.minimum.reduceat(lcp, at if tail else at[:-1]).astype(np.int64)
            since[d] = low[-1] if tail else self.depth
            low = low[:len(idx)]
            low[0] = min(low[0], self.since[d])
            self.queues[d].put(pos[idx] - 1, np.minimum(low + 1, self.depth))
        self.since = since


def repeated(text: np.ndarray, n: int, depth: int) -> np.ndarray:
    """For each of the n positions of the text, whether ``depth`` bytes from it
    on occur from another position too."""
    out = np.zeros(n, bool)
    body = text[:n]
    s = _s_types(body)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    del s
    order = _ranked(text, lms, n, depth) if len(lms) else np.zeros(0, np.int64)
    lms = lms.astype(_places(n))[order]
    del order
    lms_lcp = np.zeros(len(lms), np.int16)
    for a in range(1, len(lms), CHUNK):
        b = min(len(lms), a + CHUNK)
        lms_lcp[a:b] = _common(text, lms[a - 1:b - 1], lms[a:b], depth)
    bounds = np.searchsorted(body[lms], np.arange(257))

    def seam(last, first):
        return int(_common(text, np.array([last]), np.array([first]), depth)[0])

    up = _Induction(text, depth)
    up.queues[body[n - 1]].put(np.array([n - 1]), np.array([0]))
    up.since[body[n - 1]] = 0
    for c in range(256):
        last, opened = -1, False
        while up.queues[c].read < up.queues[c].size:
            for t in up.queues[c].forward():
                lcp = t["lcp"].copy()
                if not opened:
                    lcp[0], opened = 0, True
                up.bulk(t["pos"], lcp, lambda before, here: before >= here)
                last = int(t["pos"][-1])
        for a in range(bounds[c], bounds[c + 1], CHUNK):
            b = min(bounds[c + 1], a + CHUNK)
            lcp = lms_lcp[a:b].copy()
            if a == bounds[c]:
                lcp[0] = seam(last, lms[a]) if last >= 0 else 0
            up.bulk(lms[a:b], lcp, lambda before, here: before > here)
    del lms, lms_lcp

    down = _Induction(text, depth)
    for c in range(255, -1, -1):
        last = -1

        def mark(pos, lcp):
            hit = np.flatnonzero(lcp >= depth)
            out[pos[hit]] = True
            out[pos[hit[hit > 0] - 1]] = True
            if len(hit) and hit[0] == 0 and last >= 0:
                out[last] = True
        while down.queues[c].read < down.queues[c].size:
            for t in down.queues[c].forward():
                pos, lcp = t["pos"], t["lcp"].copy()
                if last < 0:
                    lcp[0] = 0
                mark(pos, lcp)
                down.bulk(pos, lcp, lambda before, here: before <= here)
                last = int(pos[-1])
        first = True
        for pos, lcp in up.queues[c].backward():
            if first:
                lcp[0], first = (seam(last, pos[0]) if last >= 0 else 0), False
            mark(pos, lcp)
            down.bulk(pos, lcp, lambda before, here: before < here)
            last = int(pos[-1])
        up.queues[c] = down.queues[c] = Queue()
    return out
