import random

import numpy as np
import pytest

from admitflow.llm import neardup

DOCS = "doc_id long, text string, id string, key string, kept string"


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """Component of every id, from all pairs."""
    sets = [(i, shingles(t)) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, x) in enumerate(sets):
        for j, y in sets[:n]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {i: top(i) for i in parent}


def documents(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = rng.choices(words, k=25)
    rows = []
    for base in range(12):
        body = rng.choices(words, k=rng.randint(30, 150))
        if base % 2:
            body[5:5] = passage
        for _ in range(rng.randint(1, 9)):
            copy = list(body)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    rows += ["one two", "ONE two", "one  two", "one two three", "", "   \n", None, "É a b c d e", "é a b c d e"]
    ids = rng.sample(range(10_000), len(rows))
    return [(i, t, "x", "y", "z") for i, t in zip(ids, rows)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_all_pairs(spark, seed):
    rows = documents(seed)
    if seed == 2:
        rows += [rows[0], (None, rows[0][1], None, None, None), (rows[4][0], rows[-30][1], "", "", "")]
    expected = brute(rows)
    found = neardup.group(spark, spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows)
    sizes = {(i, len(shingles(t))) for i, t, *_ in rows}
    for r in found:
        assert (r.doc_id, r.n_shingles) in sizes
        if r.doc_id is not None:
            assert r.component_id == expected[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def test_one_document_of_each_component_stays(spark):
    rows = documents(5)
    expected = brute(rows)
    found = neardup.deduplicate(spark, spark.createDataFrame(rows + rows[:3], DOCS)).collect()
    assert sorted(r.doc_id for r in found) == sorted(set(expected.values()))
    assert found[0].asDict().keys() == {"doc_id", "text", "id", "key", "kept"}


def test_empty_table(spark):
    assert neardup.group(spark, spark.createDataFrame([], DOCS)).collect() == []


def twins():
    """Two words of 1,024 letters that hashes modulo a power of two cannot tell apart."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_long_words_that_differ_are_not_one(spark):
    docs = [(i, word, None) for i, word in enumerate(twins())]
    frame = spark.createDataFrame(docs, "doc_id long, text string, extra int")
    assert [r.kept for r in neardup.group(spark, frame).collect()] == [True, True]


@pytest.mark.parametrize("wanted", [[], [3], range(-50, 20_000, 7)])
def test_few_texts_besides_the_wanted_ones_are_kept(spark, wanted):
    """Only these are shuffled; before, every text was."""
    rows = spark.range(-1000, 30_000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    ids = spark.createDataFrame([(i,) for i in wanted], "id long")
    found = [r.doc_id for r in neardup._likely(rows, ids).collect()]
    assert len(found) == len(set(found)) and set(found) >= set(wanted)
    assert len(found) <= len(wanted) + 0.2 * 31_000


def test_relatives_of_a_large_group_do_not_meet_its_members(spark, monkeypatch):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(2000)]
    body = rng.choices(words, k=150)
    rows = [(1, " ".join(body), "x", "y", "z")]
    for i in range(2, 242):
        copy = list(body)
        # Half are linked with the first, half share too little with it, though most of their words.
        for at in rng.sample(range(len(copy)), rng.choice([1, 2, 3]) if i % 2 else rng.randint(6, 12)):
            copy[at] = rng.choice(words)
        rows.append((i, " ".join(copy[: rng.choice([150, 150, 148, 143])]), "x", "y", "z"))
    # Links that no pivot needs to find: copies of relatives, shorter and longer.
    rows += [(i + 1000, t + " more words", *rest) for i, t, *rest in rows if i % 10 == 2]
    formed, agreeing = [], neardup._agreeing

    def counted(pairs, classes):
        formed.append(pairs.count())
        return agreeing(pairs, classes)

    monkeypatch.setattr(neardup, "_agreeing", counted)
    found = {r.doc_id: r.component_id for r in neardup.group(spark, spark.createDataFrame(rows, DOCS)).collect()}
    expected = brute(rows)
    assert found == expected and len(set(expected.values())) > 80
    # Members of different components that are compared in the end: there are some 120 * 120 such pairs.
    assert formed[-1] < 500


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_that_are_similar_meet(spark, seed):
    rng = random.Random(seed)
    core = rng.sample(range(10**6), 60)
    sets = [sorted({*rng.sample(core, rng.randint(40, 60)), *rng.sample(range(200), rng.randint(0, 12))}) for _ in range(120)]
    component = [i // 2 for i in range(len(sets))]
    members = spark.createDataFrame(list(enumerate(component)), "id long, component long")
    held = [(i, 0, len(s), np.array(s, np.uint64).tobytes()) for i, s in enumerate(sets)]
    frame = spark.createDataFrame(held, "id long, key long, size long, set binary")
    found = {tuple(r) for r in neardup._meeting(members, frame).collect()}
    similar = {
        (a, b)
        for b in range(len(sets))
        for a in range(b)
        if component[a] != component[b] and 100 * len({*sets[a]} & {*sets[b]}) >= 75 * len({*sets[a]} | {*sets[b]})
    }
    assert len(similar) > 20 and similar <= found
    assert all(component[a] != component[b] for a, b in found)


def tops(links):
    """The smallest id reachable from every id, from all links."""
    parent = {i: i for link in links for i in link}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    return {i: top(i) for i in parent}


def hubs_and_chain():
    """Members linked with each of ten hubs, a chain that goes up and down, and loose pairs."""
    links = [(hub, 1000 + i) for i in range(300) for hub in range(100, 110)]
    order = random.Random(4).sample(range(5000, 5060), 60)
    return links + list(zip(order, order[1:])) + [(9001, 9000), (9001, 9002), (9000, 9001)]


def test_components_are_the_smallest_ids_reachable(spark):
    links = hubs_and_chain()
    found = neardup.components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == sorted(tops(links).items())
    assert neardup.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_links_within_a_large_group_are_read_once(spark, monkeypatch):
    """Before, every round joined every link, and in both directions."""
    links, held, stored = hubs_and_chain(), [], neardup.stored

    def counted(df, name):
        out = stored(df, name)
        held.append((name, out.count()))
        return out

    monkeypatch.setattr(neardup, "stored", counted)
    neardup.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sum(n for name, n in held if name in ("links", "edges")) < 1.1 * len(links)


def near_group(n, seed):
    """One large group of near copies, as many distant relatives, and some small groups."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    body = rng.choices(words, k=160)
    rows = []
    for i in range(2 * n):
        copy = list(body)
        for at in rng.sample(range(len(copy)), rng.choice([1, 2, 3]) if i % 2 else rng.randint(5, 10)):
            copy[at] = rng.choice(words)
        rows.append((i, " ".join(copy), "x", "y", "z"))
    for i in range(20):
        small = rng.choices(words, k=80)
        rows += [(10_000 + 10 * i + k, " ".join(small[k:]), "x", "y", "z") for k in range(4)]
    return rows


def test_a_member_of_a_large_group_is_compared_with_few(spark, monkeypatch):
    """Before, it was with every pivot of all its lists, and each turn joined all links found by then."""
    rows = near_group(100, 3)
    looked, given = [], []
    agreeing, components = neardup._agreeing, neardup.components

    def counted(pairs, classes):
        looked.append(pairs.count())
        return agreeing(pairs, classes)

    def joined(links):
        given.append(links.count())
        return components(links)

    monkeypatch.setattr(neardup, "_agreeing", counted)
    monkeypatch.setattr(neardup, "components", joined)
    found = {r.doc_id: r.component_id for r in neardup.group(spark, spark.createDataFrame(rows, DOCS)).collect()}
    assert found == brute(rows)
    assert max(looked[:-1]) <= 3 * len(rows)
    # After the first turn a member brings one link, besides those that are new.
    assert max(given[1:]) < 1.5 * len(rows)
