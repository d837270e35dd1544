import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest

from admitflow.llm import mixing

DOCS = "doc_id long, text string, source string, s string, slot string, start string"


def brute_run(blocks, parts):
    """Earliest deadline first, one slot at a time, over all sources."""
    had, slots, slot = [0] * len(blocks), [[] for _ in blocks], 0
    while had != list(blocks):
        ready = [
            (math.ceil(Fraction((n + 1) * mixing.PARTS, w)), i)
            for i, (n, w) in enumerate(zip(had, parts))
            if n < blocks[i] and math.floor(Fraction(n * mixing.PARTS, w)) <= slot
        ]
        if ready:
            _, i = min(ready)
            had[i] += 1
            slots[i].append(slot)
        slot += 1
    return slots


@pytest.mark.parametrize("weights", [[1.0], [3, 1], [5, 1, 1, 1], [0.5] + [0.02] * 9, [None, 2.0, float("nan")], [0, 0]])
def test_a_run_is_earliest_deadline_first_and_within_a_block(weights):
    parts = mixing.parts_of(weights)
    assert sum(parts) == mixing.PARTS and min(parts) >= 1
    blocks = [math.ceil(Fraction(200 * w, mixing.PARTS)) for w in parts]
    slots = [list(s) for s in mixing.whole_run(blocks, parts)]
    assert slots == brute_run(blocks, parts)
    assert len({s for own in slots for s in own}) == sum(blocks)
    for own, w in zip(slots, parts):
        for n, slot in enumerate(own):  # as long as no source has run out
            if slot < 150:
                assert abs(n - Fraction(slot * w, mixing.PARTS)) < 1
                assert abs(n + 1 - Fraction((slot + 1) * w, mixing.PARTS)) < 1
    total = sum(w for w in weights if w and w == w)
    if all(w and w == w for w in weights):
        assert all(abs(Fraction(p, mixing.PARTS) - Fraction(w) / Fraction(total)) < 1e-9 for p, w in zip(parts, weights))


def test_runs_with_sources_that_end_early():
    rng = random.Random(3)
    for _ in range(40):
        parts = mixing.parts_of([rng.random() for _ in range(rng.randint(1, 6))])
        blocks = [rng.randint(0, 12) for _ in parts]
        assert [list(s) for s in mixing.whole_run(blocks, parts)] == brute_run(blocks, parts)


def test_blocks_grow_with_the_table(spark, monkeypatch):
    docs = [(i, "x" * 100, "ab"[i % 2], "c", "c", "c") for i in range(1000)]
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 50)
    found = mixing.mix(spark.createDataFrame(docs, DOCS), block_chars=10).collect()
    assert len(found) == 1000 and len({(r.source, r.block) for r in found}) <= 52


def test_every_document_once_and_sources_keep_their_weights(spark):
    rng = random.Random(9)
    docs = [(i, "x" * rng.randint(0, 50), rng.choice("aaaaabbc"), "c", "c", "c") for i in range(3000)]
    docs += [(9000, None, None, None, None, None), (None, "", "b", None, None, None), (9001, "y" * 900, "c", None, None, None)]
    docs += [docs[5], docs[5]]
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0)], "source string, weight double")
    found = mixing.mix(spark.createDataFrame(docs, DOCS), weights, block_chars=200, run_rows=64).collect()
    key = lambda x: (x is None, x or 0)
    assert sorted((r.doc_id for r in found), key=key) == sorted((d[0] for d in docs), key=key)
    assert not {"s", "quota", "slots"} & set(found[0].asDict())
    by_source = defaultdict(list)
    for r in found:
        by_source[r.source].append(r)
    for source, rows in by_source.items():
        rows.sort(key=lambda r: r.start)
        end = 0
        for r in rows:  # laid end to end
            assert r.start == end and r.block == r.start // 200
            end += r.chars
        assert [r.slot for r in rows] == sorted(r.slot for r in rows)
    slots = {(r.source, r.block): r.slot for r in found}
    assert len(set(slots.values())) == len(slots)
    shares = {"a": 1, "b": 1, "c": 2}
    period = 32 * 4
    for source, weight in shares.items():
        for r in by_source[source]:
            assert abs(r.block - r.slot * (weight / 4)) < 0.1 * r.slot * (weight / 4) + period / 16 + 1


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []


def test_blocks_keep_the_target_weights_over_many_periods(spark):
    shares = {"a": 0.7, "b": 0.2, "c": 0.099, "d": 0.001}
    docs = [(i, "x" * 10, s, "c", "c", "c") for i, s in enumerate(s for s, w in shares.items() for _ in range(round(w * 3000)))]
    weights = spark.createDataFrame(list(shares.items()), "source string, weight double")
    found = mixing.mix(spark.createDataFrame(docs, DOCS), weights, block_chars=10).collect()
    assert len(found) == len(docs) and len({r.slot for r in found}) == len(docs)
    for r in found:  # before a block's slot the source had r.block blocks, after it one more
        assert abs(r.block - r.slot * shares[r.source]) < 1
        assert abs(r.block + 1 - (r.slot + 1) * shares[r.source]) < 1
