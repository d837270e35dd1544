import random
import re

from admitflow.llm import licenses

DOCS = "doc_id long, text string, words string, hits string, base string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    base, own = [], []
    for t in [*licenses.PHRASES, *licenses.NOTICES]:
        first, end = t.key
        for s in range(-len(t.words), len(words)):
            at = lambda i: words[s + i] if 0 <= s + i < len(words) else None  # noqa: E731, B023
            hits = sum(at(i) == w for i, w in enumerate(t.words))
            if s >= 0 and all(at(i) == t.words[i] for i in range(first, end)) and hits >= t.share * len(t.words) - 1e-9:
                (base if t.base else own).append((s, t.label, hits / len(t.words)))
    return words, base, own


def texts():
    rng = random.Random(4)
    bits = [" ".join(t.words) for t in [*licenses.PHRASES, *licenses.NOTICES]]
    bits += ["MIT-License", "mit", "license", "the", "K", "İ", "apache", "général public license", "gnu", "x9", "..", "no"]
    made = [rng.choice([" ", "\n", ", "]).join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    for t in licenses.NOTICES:  # one word changed, at each end
        words = list(t.words)
        made += [" ".join(["odd", *words[1:]]), " ".join([*words[:-1], "odd"]), " ".join(words[2:])]
    return [*made, made[0], "", "mit license " * 3000, "a " * 40_000 + "Apache License"]


def test_places_and_labels_equal_brute_force(spark):
    rows = [(i, t, "c", "c", "c") for i, t in enumerate(texts())] + [(None, None, None, None, None)]
    found = licenses.scan(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows)
    for r in found:
        words, base, own = brute(None if r.doc_id is None else rows[r.doc_id][1])
        assert (r.n_words, r.n_base) == (len(words), len(base))
        starts = [s for s, *_ in base] or [None]
        assert (r.first_word, r.last_word) == (min(starts), max(starts))
        assert r.base_labels == ",".join(sorted({x for _, x, _ in base}))
        assert r.labels == ",".join(sorted({x for _, x, _ in base + own}))
        assert abs(r.score - max([s for *_, s in base + own], default=0)) < 1e-9


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], DOCS)).collect() == []
