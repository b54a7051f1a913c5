import zlib

import numpy as np
import pytest

from quotaloom.llm import repair_files
from quotaloom.llm.tokens import WordEncoder, read_text_file, tokenizer_path

BYTES = tokenizer_path("byte_bpe_50k.json")
draw = np.random.default_rng(5)


@pytest.mark.parametrize(
    "ids",
    [np.zeros(0), np.zeros(999), np.array([7]), draw.integers(0, 20, 30000), np.tile(draw.integers(0, 50000, 300), 200), draw.integers(0, 50000, 5000)],
)
def test_round_trip_and_ranges(ids):
    ids = ids.astype(np.uint32)
    symbols, rules, rounds, lengths = repair_files.compress(ids)
    assert (repair_files.expand(symbols, rules) == ids).all()
    assert lengths.tolist() == [len(repair_files.expand(np.array([repair_files.FIRST_RULE + i], np.uint32), rules)) for i in range(len(rules))]
    for a, b in ((0, 0), (0, len(ids)), (len(ids) // 3, len(ids) // 2), (max(0, len(ids) - 1), len(ids))):
        assert (repair_files.decode_range(symbols, rules, lengths, a, b) == ids[a:b]).all()


def test_repetitive_ids_shrink():
    ids = np.tile(draw.integers(0, 50000, 100), 100).astype(np.uint32)
    assert len(repair_files.compress(ids)[0]) < len(ids) / 8


def test_compression_runs_to_its_end():
    ids = np.tile(draw.integers(0, 50000, 4000), 500).astype(np.uint32)
    symbols, rules, rounds, lengths = repair_files.compress(ids)
    assert len(symbols) < 2000 and len(rules) < 3 * 4000
    assert (repair_files.expand(symbols, rules) == ids).all()


@pytest.mark.parametrize("bits", [2, 20])
def test_no_frequent_pair_is_left(monkeypatch, bits):
    monkeypatch.setattr(repair_files, "HASH_BITS", bits)  # four buckets: full of different pairs
    symbols, rules, _, _ = repair_files.compress(draw.integers(0, 40, 20000).astype(np.uint32))
    pairs, n = np.unique(np.stack([symbols[:-1], symbols[1:]], 1), axis=0, return_counts=True)
    equal = pairs[:, 0] == pairs[:, 1]  # occurrences of these overlap
    assert n[~equal].max(initial=0) < repair_files.LEAST and len(rules) > 100


def expected(rows):
    enc, at, out = WordEncoder(read_text_file(BYTES)), 0, []
    for i, text in rows:
        ids = enc.ids([text or ""])[0] + (2).to_bytes(4, "little")
        out.append((i, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    return out


def test_files_give_back_all_documents(spark):
    rows = [(3 * i - 50, "x y z " * (i % 50) + f"doc {i}") for i in range(500)] + [(5000, None), (5001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    shards = repair_files.write_shards(docs, BYTES, shard_ids=3000)
    assert shards.count() > 8
    got = sorted(tuple(r) for r in repair_files.document_index(shards).collect())
    assert got == expected(sorted(rows))


def test_messy_and_empty(messy, nothing):
    shards = repair_files.write_shards(messy, BYTES)
    got = repair_files.document_index(shards).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in messy.collect()], key=lambda i: (i is not None, i or 0))
    ends = [r.start + r.n_tokens for r in got]
    assert [r.start for r in got] == [0, *ends[:-1]]
    assert repair_files.document_index(repair_files.write_shards(nothing, BYTES)).count() == 0
