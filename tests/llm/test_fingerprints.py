import hashlib
import random
from statistics import mean

from admitflow.llm import fingerprints

DOCS = "doc_id long, text string, tie string, run string, extra string"


def documents(n=120):
    rng = random.Random(6)
    words = ["w" + "".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(300)]
    rows = [(3 * i - 50, " ".join(rng.choices(words, k=rng.randint(0, 200))), "c", "c", "c") for i in range(n)]
    rows += [(9000 + i, t, None, None, None) for i, t in enumerate(["", None, "é", "字字字字 a", "x" * 30_000, "... !", rows[3][1]])]
    rng.shuffle(rows)
    return rows


def test_edited_texts_and_likeness(spark):
    rows = documents()
    found = {r.doc_id: r for r in fingerprints.scan(spark, spark.createDataFrame(rows, DOCS), run_rows=10).collect()}
    assert len(found) == len(rows)
    ordered = sorted(rows, key=lambda r: -r[0])
    for (doc_id, text, *_), (next_id, following, *_) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following, r = text or "", following or "", found[doc_id]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_next == 1) == (r.fingerprint == found[next_id].fingerprint)
        assert (r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint)
        a, b = r.fingerprint.split("."), found[next_id].fingerprint.split(".")
        pairs = [(x, y) for x, y in zip(a, b) if x or y]
        assert abs(r.near_next - mean(x == y for x, y in pairs)) < 1e-9
    by_text = {}
    for doc_id, text, *_ in rows:
        by_text.setdefault(text or "", set()).add(found[doc_id].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    long = [r for r in found.values() if r.n_chars > 300]
    assert mean(r.near_edited for r in long) > mean(r.near_next for r in long) + 0.05


def test_lexicon_is_the_band(spark):
    rows = [(i, " ".join(["all", f"one{i}", "third" if i % 3 == 0 else "", "rare" if i < 2 else ""])) for i in range(60)]
    bits = fingerprints.lexicon(spark.createDataFrame(rows, "doc_id long, text string"), 0.05, 0.5)
    number = lambda t: spark.range(1).select(fingerprints._class(fingerprints.F.lit(t))).first()[0]
    assert sum(bits) == 1 and bits[number("third")] == 1


def test_repeated_ids_nulls_one_row_and_none(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "e f g"), (None, "h i j"), (None, None)]
    found = fingerprints.scan(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 5
    one = fingerprints.scan(spark, spark.createDataFrame(rows[:1], "doc_id long, text string")).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"a b ca ").hexdigest()
    assert fingerprints.scan(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []
