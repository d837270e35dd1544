import random
import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from admitflow.llm import packing

SCHEMA = "doc_id long, text string, length int, start string, sequence_id double"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoder_gives_the_ids_of_the_tokenizer(tokenizer):
    rng = random.Random(7)
    parts = [" ", "  ", "\n", "\t", "a", "Ab", "é", "12", ".", "'s", "\x1c", " ", "字", "<|endoftext|>", "\r\n"]
    encoder = packing.Encoder(packing.default_vocabulary())
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 15)))
        assert encoder.encode(text) == struct.pack(
            f"<{len(ids)}I", *ids
        ) if (ids := tokenizer.encode(text, add_special_tokens=False).ids) else encoder.encode(text) == b""


def brute_best_fit(lengths, capacity):
    rooms, places = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fitting = [w for w in range(len(rooms)) if rooms[w] >= lengths[i]]
        if not fitting:
            rooms.append(capacity)
            fitting = [len(rooms) - 1]
        window = min(fitting, key=lambda w: rooms[w])
        places[i] = capacity - rooms[window]
        rooms[window] -= lengths[i]
    return sorted(rooms), len(rooms)


@pytest.mark.parametrize("seed", range(20))
def test_segment_tree_finds_the_tightest_window(seed):
    rng = random.Random(seed)
    capacity = rng.choice([5, 16, 100, 1024])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 200))]
    places = packing.best_fit_decreasing(lengths, capacity)
    rooms = {}
    for length, (window, _) in zip(lengths, places):
        rooms[window] = rooms.get(window, capacity) - length
    assert (sorted(rooms.values()), len(rooms)) == brute_best_fit(lengths, capacity)


def test_pieces_hold_every_id_once_and_sequences_have_no_gap(spark, tokenizer):
    rng = random.Random(3)
    texts = [None, "", "word " * 5000, "same text", "same text", "é字 " * 700]
    texts += [" ".join(rng.choice(["alpha", "be", "Gamma,"]) for _ in range(rng.randint(1, 900))) for _ in range(60)]
    rows = [(i if i != 4 else 3, t, 1, "x", 0.5) for i, t in enumerate(texts)] + [(None, "no id", None, None, None)]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA), pass_runs=25).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text, *_ in rows:
        ids = (tokenizer.encode(text, add_special_tokens=False).ids if text else []) + [0]
        pieces = sorted(by_doc[doc_id], key=lambda r: r.start)
        if doc_id == 3:  # the repeated row is packed once more
            assert len(pieces) == 2
            pieces = pieces[:1]
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert sum(p.length for p in pieces) == len(ids)
        for p in pieces:
            cut = ids[p.start : p.start + p.length]
            assert (p.doc_tokens, p.ids_crc32) == (len(ids), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut)))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.WINDOW


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []
