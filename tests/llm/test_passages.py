import hashlib
import random

import pytest

from admitflow.llm import passages
from tests.llm.test_neardup import twins

DOCS = "doc_id long, text string, first string, n string, tid string"


def brute(rows):
    """Each row's result from a table of all windows."""
    least = {}
    split = [(t or "").encode().split() for _, t, *_ in rows]
    for (doc_id, *_), words in zip(rows, split):
        for i in range(len(words) - 49):
            key = tuple(words[i : i + 50])
            if doc_id is not None:
                least[key] = min(least.get(key, doc_id), doc_id)
    found = []
    for (doc_id, *_), words in zip(rows, split):
        gone = set()
        for i in range(len(words) - 49):
            if doc_id is not None and least[tuple(words[i : i + 50])] < doc_id:
                gone.update(range(i, i + 50))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        found.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return found


def documents(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    pool = [rng.choices(words, k=rng.choice([49, 50, 51, 60, 130, 300])) for _ in range(8)] + [["a", "b"] * 40]
    texts = []
    for _ in range(50):
        body = []
        for _ in range(rng.randint(0, 4)):
            part = list(rng.choice(pool))
            if rng.random() < 0.4:
                part[rng.randrange(len(part))] = "edit" + str(rng.randrange(3))
            if rng.random() < 0.3:
                part = part[rng.randrange(40) :]
            body += part + rng.choices(words, k=rng.choice([0, 0, 3, 70]))
        texts.append(rng.choice([" ", "\n", "\t  "]).join(body))
    texts += [texts[3], texts[4], None, "", "é " * 200, "é " * 90, "x " * 20_000 + "y", " ".join(pool[5] * 2)]
    ids = rng.sample(range(1000), len(texts))
    return [(i, t, "c", "c", "c") for i, t in zip(ids, texts)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_kept_words_equal_brute_force(spark, seed):
    rows = documents(seed)
    if seed == 2:
        rows += [rows[0], (rows[1][0], rows[2][1], "", "", ""), (None, rows[3][1], None, None, None)]
    found = passages.remove_repeats(spark, spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found))) == sorted(
        map(str, brute(rows))
    )
    assert sum(r.n_removed for r in found) > 0


@pytest.mark.parametrize("seed", range(5))
def test_matching_statistics_equal_brute_force(seed):
    rng = random.Random(seed)
    automaton, texts = passages.SuffixAutomaton(), []
    for _ in range(6):
        query = [rng.choice([b"a", b"b", b"c"]) for _ in range(30)]
        runs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        expected = [max([n for n in range(1, k + 2) if tuple(query[k + 1 - n : k + 1]) in runs], default=0) for k in range(30)]
        assert automaton.statistics(query) == expected
        text = [rng.choice([b"a", b"b", b"c"]) for _ in range(20)]
        automaton.add(text)
        texts.append(text)


def test_empty_table(spark):
    assert passages.remove_repeats(spark, spark.createDataFrame([], DOCS)).collect() == []


def test_long_words_that_differ_are_not_removed(spark):
    shared = " ".join(f"w{i}" for i in range(60))
    docs = [(i, shared.replace("w30 ", f"{word} ")) for i, word in enumerate(twins())]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert [r.n_removed for r in passages.remove_repeats(spark, frame).orderBy("doc_id").collect()] == [0, 0]
