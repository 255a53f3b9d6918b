"""What a shard's sort takes beside its text."""

import random
import tracemalloc

import numpy as np

from polarity.llm import induced as I


def shard(n):
    """Pieces of one text, so that most starts occur several times."""
    rng = random.Random(9)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9)))
             for _ in range(3000)]
    source = " ".join(rng.choice(words) for _ in range(n // 20)).encode()
    segments, size = [], 0
    while size < n:
        a = rng.randrange(len(source) - 300)
        segments.append(source[a:a + 300])
        size += 301
    return I.join_segments(segments)[0]


def test_the_sort_takes_a_few_bytes_per_byte():
    """163 MB beside a shard of 2 MB before, two tasks an executor."""
    text = shard(1 << 20)
    tracemalloc.start()
    try:
        got = I.repeated(text, len(text) - I.MARGIN, 240)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.any() and not got.all()
    assert peak < 45 * len(text), peak / len(text)


def test_places_of_either_width(monkeypatch):
    text = shard(20_000)
    n = len(text) - I.MARGIN
    raw = text[:n].tobytes()
    starts: dict = {}
    for i in range(n - 239):
        starts.setdefault(raw[i:i + 240], []).append(i)
    want = np.zeros(n, bool)
    for at in starts.values():
        want[at] = len(at) > 1
    assert I._places(1 << 30) is np.int64
    for kind in (np.int32, np.int64):
        monkeypatch.setattr(I, "_places", lambda n, kind=kind: kind)
        assert (I.repeated(text, n, 240) == want).all()
