import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from admitflow.llm import mixing, secrets, toxicity
from admitflow.llm.common import stored
from tests.llm.test_neardup import brute as components
from tests.llm.test_secrets import brute_base, brute_weak

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage keeps, by name."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    found["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        found[name] = docs
    return found


def test_names_and_columns(kept):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near-dedup", "secrets", "mixing", "packing"]
    assert all(kept[n].columns == kept["documents"].columns for n in names[:-1])
    assert "pipeline" in entry_points.queries()


def test_toxic_documents_go(spark, kept):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.score(spark, kept["documents"], labels).collect()
    assert sorted(r.doc_id for r in scored if r.score < 0.3) == sorted(r.doc_id for r in kept["toxicity"].collect())


def test_one_of_each_group_stays(kept):
    expected = components([(r.doc_id, r.text) for r in kept["toxicity"].collect()])
    assert sorted(r.doc_id for r in kept["near-dedup"].collect()) == sorted(set(expected.values()))


def test_secrets_are_replaced_and_nothing_else(kept):
    before = {r.doc_id: r for r in kept["near-dedup"].collect()}
    after = {r.doc_id: r for r in kept["secrets"].collect()}
    assert before.keys() == after.keys()
    for doc_id, r in before.items():
        if brute_base(r.text) or brute_weak(r.text):
            assert secrets.MARK in after[doc_id].text and after[doc_id].n_chars == len(after[doc_id].text)
        else:
            assert after[doc_id] == r


def test_mixing_orders_all(kept):
    assert sorted(kept["secrets"].collect()) == sorted(kept["mixing"].collect())
    places = {r.doc_id: (r.slot, r.start) for r in mixing.mix(kept["secrets"]).collect()}
    ordered = [places[r.doc_id] for r in mixing.interleave(kept["secrets"]).collect()]
    assert ordered == sorted(ordered)


def test_packing_holds_all_tokens(kept):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in kept["mixing"].collect()}
    found = {}
    for r in kept["packing"].collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == tokens


def test_run_gives_the_last_stage(spark, kept):
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in got.collect()) == sorted(
        (r.doc_id, r.start, r.ids_crc32) for r in kept["packing"].collect()
    )
