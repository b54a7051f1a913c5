import numpy as np
import pytest

from quotaloom.llm import repair_files
from quotaloom.llm.tokens import WordEncoder, read_text_file, tokenizer_path

BYTES = tokenizer_path("byte_bpe_50k.json")


class Counting:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def __getattr__(self, name):
        method = getattr(self.tokenizer, name)

        def call(texts, **more):
            self.given += len(texts) if isinstance(texts, str) else sum(map(len, texts))
            return method(texts, **more)

        return call


def library(enc, texts):
    return [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_letters_go_to_the_library_once_whatever_follows_them():
    enc = WordEncoder(read_text_file(BYTES))
    draw = np.random.default_rng(3)
    words = ["".join(draw.choice(list("abcdeéß"), 12)) for _ in range(200)]
    texts = [" ".join(w + end for w in words) for end in ("", "!", "?!", "'s", "...", ";%", "\nNext", ").\nThe")]
    want = library(enc, texts)
    enc.tokenizer = Counting(enc.tokenizer)
    assert enc.ids(texts) == want
    assert enc.tokenizer.given < 2 * 13 * len(words)


@pytest.mark.parametrize("space", ["\n\n", "\n \n", "  ", "\t\n", "\n ", "\x1c\n", "\x85 ", "﻿\n", "\n", "\r\n"])
def test_runs_of_white_space_equal_the_library(space):
    enc = WordEncoder(read_text_file(BYTES))
    texts = [f"a{space}~b", f"{space}word.", f"word,{space}", f"x{space}{space}'s é", f"a <|endoftext|>{space}b", "plain, text."]
    assert enc.ids(texts) == library(enc, texts)


def test_few_known_parts_change_no_ids():
    enc = WordEncoder(read_text_file(BYTES))
    texts = [f"word{i % 40} other{i}, more.\nThen x{'y' * i}" for i in range(90)]
    enc.columns.most = 7
    assert [enc.ids([t])[0] for t in texts] == library(enc, texts) and len(enc.columns.parts) == 7


@pytest.mark.parametrize("share", [1, 1 << 40])
def test_gaps_change_no_rules(monkeypatch, share):
    draw = np.random.default_rng(8)
    ids = np.concatenate([draw.integers(0, 50000, 30000), np.tile(draw.integers(0, 90, 700), 40), np.zeros(999)]).astype(np.uint32)
    want = repair_files.compress(ids)
    monkeypatch.setattr(repair_files, "LINK_SHARE", share)
    symbols, rules, rounds, sizes = repair_files.compress(ids)
    assert all(np.array_equal(x, y) for x, y in zip(want, (symbols, rules, rounds, sizes), strict=True))
    assert sizes.max() > repair_files.SHORT
    spelled = repair_files.spell(symbols, rules, sizes)
    assert (repair_files.expand_spelled(symbols, rules, spelled) == ids).all()
    for a, b in ((0, 0), (0, len(ids)), (29_990, 31_000)):
        assert (repair_files.decode_range(symbols, rules, sizes, a, b, None, spelled) == ids[a:b]).all()
