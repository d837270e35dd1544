import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from admitflow.llm import toxicity

DOCS = "doc_id long, text string, score string, place int, toxic string"


def rows(n, seed=1):
    rng = random.Random(seed)
    words = [a + b for a in ["ba", "ke", "lo", "mi", "tu"] for b in ["ra", "sen", "dol", "pim", "gar"]]
    bad = ["grumph", "snarkle", "vilebo" + rng.choice("xyz")]
    docs, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        body = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        if toxic:
            body[rng.randrange(len(body))] = rng.choice(bad).upper()
        docs.append((i, " ".join(body) + ".", "clash", i, "clash"))
        labels.append((i, toxic))
    return docs, labels


def test_held_out_rows_are_predicted(spark):
    docs, labels = rows(600)
    truth = dict(labels)
    docs += [(9001, None, None, None, None), (9002, "", None, None, None), (None, "grumph again", None, None, None)]
    docs += [(9003, "kera " * 60_000 + "snarkle", None, None, None), docs[0]]
    labels += [(5000, None), (None, 1), (0, truth[0])]
    frame = spark.createDataFrame(docs, DOCS)
    found = toxicity.score(spark, frame, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(found) == len(docs)
    assert set(found[0].asDict()) == {"doc_id", "text", "place", "toxic", "held_out", "score", "predicted", "neighbours"}
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in truth:
            assert r.predicted == truth[r.doc_id]
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].predicted for i in (9001, 9002, None, 9003)] == [0, 0, 1, 1]
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for r in found for i in r.neighbours)


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels = rows(200)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    frame = spark.createDataFrame(docs, DOCS)
    scores = [
        {r.doc_id: r.score for r in toxicity.score(spark, frame, spark.createDataFrame(x, "doc_id long, toxic int")).collect()}
        for x in (labels, flipped)
    ]
    assert scores[0] == scores[1]


def test_no_labels_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs, labels = rows(5)
    assert {r.score for r in toxicity.score(spark, spark.createDataFrame(docs, DOCS), none).collect()} == {0.0}
    labelled = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert toxicity.score(spark, spark.createDataFrame([], DOCS), labelled).collect() == []


@pytest.mark.parametrize("seed", range(10))
def test_blocks_give_the_exact_nearest(seed):
    rng = np.random.default_rng(seed)
    vectors = rng.random((300, 20)) * (rng.random((300, 20)) < 0.15)
    vectors = vectors[vectors.any(axis=1)]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = np.vstack([vectors, vectors[:40]])  # repeated examples
    ids = rng.permutation(len(vectors))
    index = toxicity.Index.build(vectors, np.zeros(len(vectors)), ids)
    for query in vectors[:30]:
        terms = np.flatnonzero(query)
        found, _ = index.nearest(terms, query[terms], 7)
        cosines = (vectors @ query).round(12)
        expected = [i for i in np.lexsort((ids, -cosines)) if cosines[i] > 0][:7]
        assert index.ids[found].tolist() == ids[expected].tolist()


def test_calibration_rises_and_pools_equal_votes():
    votes, toxic = np.array([0.0, 0.0, 0.4, 0.3, 0.9, 0.0]), np.array([0, 1, 0, 1, 1, 0.0])
    xs, ys = toxicity._calibrate(votes, toxic, np.ones(6))
    assert (np.diff(xs) > 0).all() and (np.diff(ys) > 0).all()
    assert ys[0] == pytest.approx(1 / 3)


def test_words_of_few_examples_and_copies_of_examples_count(spark):
    docs, labels = rows(400)
    # Words of their own, each in one example: no word is frequent, yet a copy equals its example.
    own = [" ".join(c * n for n in (5, 7, 9)) for c in "abcdefghijkl"]
    rare = [(10_000 + i, text, None, None, None) for i, text in enumerate(own)]
    rare = [d for d in rare if zlib.crc32(str(d[0]).encode()) % 4 != 2]
    copies = [(20_000 + d[0], d[1], None, None, None) for d in rare]
    labels += [(d[0], 1) for d in rare]
    frame = spark.createDataFrame(docs + rare + copies, DOCS)
    found = {r.doc_id: r for r in toxicity.score(spark, frame, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    for original, copy in zip(rare, copies):
        assert found[copy[0]].neighbours == [original[0]] and found[copy[0]].predicted == 1


def test_spark_hashes_terms_as_python_does(spark):
    texts = ["Straße ÉTÉ naïve x1y2z ½ ² Ⅷ", "", "a_b-c.d", "İstanbul ΣΊΣΥΦΟΣ ǅ", "longerword longerwoods 字字字字字字字"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [set(r[0]) for r in df.select(toxicity._hashes(F.col("text"))).collect()]
    for text, hashes in zip(texts, found):
        words = toxicity._WORD.findall(text.lower())
        expected = {t for w in words for t in toxicity.stems(w)}
        assert hashes == set(np.array([toxicity._hash(t) for t in expected], np.uint64).view(np.int64).tolist())


def brute_neighbours(docs, labels):
    """Of every document the ids of the nearest examples, by full vectors over all terms."""
    texts = {i: t for i, t, *_ in docs}
    examples = sorted(i for i, y in labels if zlib.crc32(str(i).encode()) % 4 != 2 and texts.get(i))
    truth = dict(labels)

    def counts(text):
        found = {}
        for token in (text or "").lower().split():
            for word in toxicity._WORD.findall(token):
                for term in toxicity.stems(word):
                    found[term] = found.get(term, 0) + 1
        return found

    every = [counts(t) for _, t, *_ in docs]
    known = {t for i in examples for t in counts(texts[i])}
    frequency, classes = {}, {}
    for found in every:
        for term in found:
            frequency[term] = frequency.get(term, 0) + 1
            if term not in known:
                place = toxicity._hash(term) % toxicity.CLASSES
                classes[place] = classes.get(place, 0) + 1

    def weight(term):
        if term not in known:
            return np.log((1 + len(docs)) / (1 + classes.get(toxicity._hash(term) % toxicity.CLASSES, 0))) + 1
        plain = np.log((1 + len(docs)) / (1 + frequency.get(term, 0))) + 1
        seen = [sum(term in counts(texts[i]) for i in examples if truth[i] == y) for y in (0, 1)]
        shares = [sum(truth[i] == y for i in examples) / len(examples) for y in (0, 1)]
        evidence = sum(n * np.log(n / sum(seen) / share) for n, share in zip(seen, shares) if n)
        return plain * (1 + max(evidence, 0))

    weights = {t: weight(t) for found in every for t in found}

    def vector(found):
        values = {t: (1 + np.log(n)) * weights[t] for t, n in found.items()}
        norm = np.sqrt(sum(v * v for v in values.values())) or 1.0
        return {t: v / norm for t, v in values.items()}

    vectors = {i: vector(counts(texts[i])) for i in examples}
    nearest = []
    for found in every:
        own = vector(found)
        cosines = {i: sum(v * own.get(t, 0) for t, v in other.items()) for i, other in vectors.items()}
        shared = [i for i in examples if cosines[i] > 0]
        nearest.append(sorted(shared, key=lambda i: (-round(cosines[i], 12), i))[: toxicity.NEAREST])
    return nearest


def test_neighbours_equal_brute_force_from_end_to_end(spark):
    docs, labels = rows(90, seed=4)
    docs += [(500, "kera Kerasen kerasendol unheard-of words", None, None, None), (501, "", None, None, None)]
    frame = spark.createDataFrame(docs, DOCS)
    scored = toxicity.score(spark, frame, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    found = {r.doc_id: r.neighbours for r in scored}
    assert [found[d[0]] for d in docs] == brute_neighbours(docs, labels)


def test_labels_without_documents_take_no_place(spark):
    docs, labels = rows(300)
    ghosts = [(i, y) for i in range(10_000, 14_000) for y in (i % 2,)]
    frame = spark.createDataFrame(docs, DOCS)

    def learnt(labelled):
        found = toxicity._learning_rows(frame, spark.createDataFrame(labelled, "doc_id long, toxic int"), 20)
        return sorted((r.doc_id, r.toxic) for r in found.collect())

    assert learnt(labels) == learnt(labels + ghosts) and len(learnt(labels)) == 40


def test_terms_are_counted_by_document(spark):
    # So many words that some share a class.
    many = " ".join(chr(97 + n % 26) * 3 + chr(97 + n // 26 % 26) * 3 + chr(97 + n // 676) for n in range(3000))
    texts = ["alpha ALPHA alphabet beta", "", None, "İstanbul ½ beta x_y", "alphabetical beta1beta", many]
    numbers = {term: n for n, term in enumerate(["alpha.", "alpha", "beta.", "alphabet."])}

    def expected(text):
        times = {}
        for word in toxicity._WORD.findall((text or "").lower()):
            for term in toxicity.stems(word):
                place = numbers.get(term, len(numbers) + toxicity._hash(term) % toxicity.CLASSES)
                times[place] = times.get(place, 0) + 1
        return times

    terms = toxicity.Terms(numbers)
    for _ in range(2):
        found = terms.of([text or "" for text in texts])
        assert [dict(zip(a.tolist(), b.tolist())) for a, b in found] == [expected(text) for text in texts]
    docs = spark.createDataFrame([(t,) for t in texts * 2], "text string").repartition(3)
    total, frequency = toxicity._document_frequencies(docs, numbers)
    wanted = np.zeros(len(frequency))
    for text in texts * 2:
        for term in {t for w in toxicity._WORD.findall((text or "").lower()) for t in toxicity.stems(w)}:
            wanted[numbers.get(term, len(numbers) + toxicity._hash(term) % toxicity.CLASSES)] += 1
    assert total == 12 and (frequency == wanted).all()
