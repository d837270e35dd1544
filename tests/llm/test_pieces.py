import hashlib
import random

import pytest
import sentencepiece

from admitflow.llm import pieces, queries

SCHEMA = "doc_id long, text string, ids string, ends int"
PARTS = [
    " ", "  ", "\n", "\t", "a", "Ab", "é", "12", ".", "é", "ﬁ", "½", "㎏", "字", "▁", "▁▁", " ", "　",
    "​", "\x00", "</s>", "ｱﾞ", "😀", "Å", "<0x41>", "가", "가", "the", " the ",
]


def number(value):
    found = b""
    while value > 127:
        found, value = found + bytes([value & 127 | 128]), value >> 7
    return found + bytes([value])


def model_with(rule, dummy_prefix, drop_extra, escape):
    """The given model's pieces behind another normalisation."""
    with open(pieces.default_model(), "rb") as file:
        model = file.read()
    proto = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    spec = next(value for n, value, _ in pieces.message_fields(proto) if n == 3)
    spec = b"".join(whole for n, _, whole in pieces.message_fields(spec) if n in (1, 2))
    spec += bytes([24, dummy_prefix, 32, drop_extra, 40, escape])
    rest = b"".join(whole for n, _, whole in pieces.message_fields(model) if n not in (3, 4))
    return rest + bytes([26]) + number(len(spec)) + spec


def texts(count):
    rng = random.Random(3)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 20))) for _ in range(count)]
    return ["", "   ", "▁ ", " a  b ", *made]


@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("dummy_prefix, drop_extra, escape", [(1, 0, 1), (1, 1, 1), (0, 1, 1), (0, 0, 1), (1, 1, 0)])
def test_ids_and_spans_are_those_of_the_library(rule, dummy_prefix, drop_extra, escape):
    model = model_with(rule, dummy_prefix, drop_extra, escape)
    encoder = pieces.Encoder(model)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    given = texts(400)
    for text, (ids, starts, ends) in zip(given, encoder.encode(given)):
        assert ids.tolist() == library.encode(text, add_eos=True), text
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(starts.tolist(), ends.tolist()))[:-1] == spans, text


def test_the_longest_key_wins():
    model = model_with("nmt_nfkc", 1, 1, 1)
    found = pieces.Encoder(model).normaliser.character_map
    data = "ｶﾞx".encode()
    assert found.longest_prefix(data, 0) == (6, "ガ".encode())
    assert found.longest_prefix(data, 6) == (0, b"")


def test_models_that_cannot_be_followed_are_refused():
    with open(pieces.default_model(), "rb") as file:
        model = file.read()
    with pytest.raises(ValueError, match="white space behind"):
        pieces.Encoder(model + bytes([18, 3, 192, 1, 1]))
    few = b"".join(whole for n, v, whole in pieces.message_fields(model) if not (n == 1 and b"<0x41>" in v))
    with pytest.raises(ValueError, match="bytes"):
        pieces.Encoder(few)


def expected(doc_id, text, library):
    ids = library.encode(text or "", add_eos=True)
    decoded = library.decode(ids)
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), decoded)]
    return (doc_id, len(ids), *sha, len((text or "").encode()))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


@pytest.mark.parametrize("run_chars", [1, pieces.RUN_CHARS])
def test_odd_rows(spark, library, monkeypatch, run_chars):
    monkeypatch.setattr(pieces, "RUN_CHARS", run_chars)
    rows = [*enumerate(texts(200)), (None, "a"), (1, None), (2, "long text " * 50_000), (3, "a"), (3, "a")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    found = [tuple(r) for r in pieces.report(df).collect()]
    assert sorted(map(str, found)) == sorted(str(expected(*r, library)) for r in rows)


def test_an_empty_table(spark):
    assert pieces.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_spans_follow_each_other_over_the_whole_text(spark):
    df = spark.createDataFrame([(1, "Zwei  Wörter 字😀\n")], "doc_id long, text string")
    row = pieces.encode(df).first()
    assert row["starts"][0] == 0 and row["ends"][-1] == len("Zwei  Wörter 字😀\n".encode())
    assert row["starts"][1:] == row["ends"][:-1]


def test_the_query_is_the_library(spark, library):
    folder = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = [tuple(r) for r in queries.op13_sentencepiece(spark, folder).collect()]
    assert sorted(found) == sorted(expected(*row, library) for row in given)
