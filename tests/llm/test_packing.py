import zlib
from collections import defaultdict

import numpy as np
import pytest

from quotaloom.llm import packing
from quotaloom.llm.tokens import WordEncoder, read_text_file, tokenizer_path

WORDS = tokenizer_path("word_bpe_49k.json")
ODD = ["", " ", "  a  b ", "a\n  b", "\tx\n\n y .", "don't. It's, OK. İ. Σ. ΑΣ, ß. ﬁ, <|endoftext|> x", "a\x1cb \x1c c", "é. é, x  y", "A.B, C.D.", "..,, ,. .", "語。 語. 語,"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_by_words_equal_ids_of_the_whole_text(name):
    enc = WordEncoder(read_text_file(tokenizer_path(name)))
    for _ in range(2):  # a second time from memory
        for text in ODD:
            want = np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            assert enc.ids([text]) == [want], text


ADDED = [
    "see <|endoftext|> here", "<|endoftext|><|endoftext|>", "<|endoftext|>", "a<|ENDOFTEXT|>b <|EndOfText|>. <|endoftext|>.", "x  <|endoftext|>\n\ny  \n",
    "<|startoftext|>Don't.<|endoftext|>, z", "<|endoftext| > <|endoftext|", "x <|<|endoftext|>|> y", "  <|endoftext|>  é. <|startoftext|>\t",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_those_of_the_library_as_it_comes(name):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(name))
    enc = WordEncoder(read_text_file(tokenizer_path(name)))
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ADDED + ODD]
    for _ in range(2):  # a second time from memory
        assert enc.ids(ADDED + ODD) == want
        assert [enc.ids([t])[0] for t in ADDED + ODD] == want


def test_added_tokens_that_look_around_are_left_to_the_library():
    from tokenizers import AddedToken, Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    library.add_tokens([AddedToken("zug", lstrip=True, single_word=True)])
    texts = ["a  zug b", "zugzug zug"]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert WordEncoder(library.to_str()).ids(texts) == want


def test_open_sequences_best_fit_and_bound():
    bins = packing.OpenSequences(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4, 9)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0)]
    bins = packing.OpenSequences(10, 1)
    assert [bins.place(n) for n in (6, 7, 3)] == [(0, 0), (1, 0), (1, 7)]  # the fullest, the only one, closed
    assert bins.still_open() == set()


def check(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_pieces_and_sequences(messy):
    rows = packing.pack_documents(messy, WORDS).collect()
    enc = WordEncoder(read_text_file(WORDS))
    want = []
    for r in messy.collect():
        ids = enc.ids([r.text or ""])[0] + (1).to_bytes(4, "little")
        for k, at in enumerate(range(0, len(ids), 4 * 4096)):
            part = ids[at : at + 4 * 4096]
            want.append((r.doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
    assert sorted([tuple(r)[:5] for r in rows], key=str) == sorted(want, key=str)
    check(rows, 4096)


def test_few_sequences(spark):
    items = spark.range(20000).selectExpr("id", "1 + (id * 7919) % 1500 AS length")
    rows = packing.pack(items, "length", 4096, 64).collect()
    assert len(rows) == 20000
    assert check(rows, 4096) <= 1.02 * sum(r.length for r in rows) / 4096


def test_empty(nothing):
    assert packing.pack_documents(nothing, WORDS).count() == 0


def test_filled_sequences_hold_the_ids(messy):
    pieces = packing.tokenize_pieces(messy, WORDS, "doc_id", "text", 64, 1, keep_ids=True)
    packed = packing.pack(pieces, "length", 64, 8)
    full = {r.sequence_id: r.ids for r in packing.fill_sequences(packed, 0, 64).collect()}
    for r in packed.collect():
        got = full[r.sequence_id][r.offset : r.offset + r.length]
        assert np.array(got, "<u4").tobytes() == bytes(r.ids)
