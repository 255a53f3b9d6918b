"""Long texts keep every anchor, with its place."""

import random
from collections import Counter

import pytest

from polarity.llm import syncmers as S


def test_long_texts_keep_all_anchors(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(10 ** 6)}"
    a = [word() for _ in range(5000)]
    b = a[:2500] + ["changed"] + a[2501:]
    passage = [word() for _ in range(50)]
    c = [word() for _ in range(3000)] + passage + [word() for _ in range(2000)]
    d = [word() for _ in range(700)] + passage + [word() for _ in range(4000)]
    texts = {4: a, 3: b, 2: c, 1: d, 0: ["one"]}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()],
                               "doc_id long, text string")
    got = {r.doc_id: r for r in S.compare_with_edits(df).collect()}
    sets = {i: {x.hash for x in r.anchors} for i, r in got.items()}
    for i, r in got.items():
        at = [x.position for x in r.anchors]
        assert at == sorted(set(at)) and all(0 <= p < len(texts[i]) for p in at)
        assert r.fingerprint == "".join(f"{h:08x}" for h in sorted(sets[i]))
        assert r.sketch == r.fingerprint[:8 * S.SKETCH]
        after = sets[i - 1 if i else 4]
        assert r.near_next == pytest.approx(len(sets[i] & after) / len(sets[i] | after))
    # one changed word of 5,000 shows
    assert got[4].fingerprint != got[3].fingerprint and 0.99 < got[4].near_next < 1
    # a shared passage is found, and lies at one distance
    here, there = ({x.hash: x.position for x in got[i].anchors} for i in (2, 1))
    shift = Counter(here[h] - there[h] for h in here.keys() & there.keys())
    assert shift[2300] >= 20 and shift.most_common(1)[0][0] == 2300
    one = {r.doc_id: r for r in S.fingerprints(df).collect()}
    assert all((one[i].fingerprint, one[i].sketch, one[i].anchors)
               == (r.fingerprint, r.sketch, r.anchors) for i, r in got.items())
