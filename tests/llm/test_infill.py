import hashlib
import random
import re

import numpy as np
import pytest

from admitflow.llm import infill, queries

SCHEMA = "doc_id long, text string, n string, form int, output double"
TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    starts = [m.start() for m in TOKEN.finditer(text)] + [len(text)]
    n = len(starts) - 1
    name = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h1, h2, h3, h4 = (int(name[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (n, "plain", None, None, sha(text), sha(text))
    first, second = sorted((starts[h1 % (n + 1)], starts[h2 % (n + 1)]))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < 20:
        form, output = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, output = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (n, form, len(prefix), len(middle), sha(output), sha(text))


def test_ranks_equal_counts():
    rng = np.random.default_rng(2)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 4, size).astype(np.uint8)
        matrix = infill.WaveletMatrix(symbols, 2)
        ends = np.arange(size + 1)
        for symbol in range(4):
            expected = np.concatenate([[0], np.cumsum(symbols == symbol)])
            assert (matrix.rank(symbol, ends) == expected).all()


def test_boundaries_of_several_texts():
    rng = random.Random(4)
    parts = ["a", "Bc", " ", "\n", "é", "1", "字", "😀", "zZ", "K", "[", "`", "{", "@"]
    for _ in range(400):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        boundaries = infill.Boundaries(texts)
        starts = [[m.start() for m in TOKEN.finditer(t)] + [len(t)] for t in texts]
        assert boundaries.tokens().tolist() == [len(s) - 1 for s in starts]
        wanted = [rng.randrange(len(s)) for s in starts]
        assert boundaries.places(np.array(wanted)).tolist() == [s[k] for s, k in zip(starts, wanted)]


@pytest.mark.parametrize("run_chars", [1, 50, infill.RUN_CHARS])
def test_odd_rows_equal_brute_force(spark, monkeypatch, run_chars):
    monkeypatch.setattr(infill, "RUN_CHARS", run_chars)
    rng = random.Random(6)
    parts = ["word", "Ab", " ", "\n", "é", "<", "S>", "M", ">", "😀", "12", "<P", "\u0000"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(300)]
    rows += [(None, "a b c"), (1, None), (2, ""), (3, "x<S>y"), (4, "ab " * 300_000), (-5, "a\nb"), *rows[:5]]
    df = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], SCHEMA)
    found = [tuple(r) for r in infill.report(df).collect()]
    assert sorted(map(str, found)) == sorted(str((doc_id, *brute(doc_id, text))) for doc_id, text in rows)


def test_an_empty_table(spark):
    assert infill.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_outputs_hold_every_part_once(spark):
    df = spark.createDataFrame([(i, f"one two {i} three") for i in range(50)], "doc_id long, text string")
    for row in infill.transform(df, plain_from=100).collect():
        text = f"one two {row['doc_id']} three"
        assert row["form"] in ("psm", "spm") and len(row["output"]) == len(text) + 9
        middle = text[row["prefix_chars"] :][: row["middle_chars"]]
        assert row["output"].endswith(f"<M>{middle}")


def test_the_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_fill_in_middle(spark, folder).collect()}
    assert found == {doc_id: brute(doc_id, text) for doc_id, text in texts}
    assert {f[1] for f in found.values()} == {"plain", "psm", "spm"}
