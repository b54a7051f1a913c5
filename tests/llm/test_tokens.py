import numpy as np
import pytest

from quotaloom.llm.tokens import WordEncoder, read_text_file, tokenizer_path

TEXTS = ["a\0b \0 c", "", "\0", "x  y\n z.", " lead", "trail ", "Ġ ĠĠ Ġa", "naïve café, 555-0346 İ", "plain words and, more. words", "<|endoftext|> \0"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_batches_equal_the_library_with_the_separator_in_texts(name):
    enc = WordEncoder(read_text_file(tokenizer_path(name)))
    want = [np.array(enc.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in TEXTS]
    assert enc.ids(TEXTS) == want and enc.ids(TEXTS[::-1]) == want[::-1] and enc.ids([]) == []


def test_words_of_bytes_are_cut_by_their_tokens():
    enc = WordEncoder(read_text_file(tokenizer_path("byte_bpe_50k.json")))
    words = [" a", " Ġa", " 555-0346", " é", " \U0001f600x", " ..", " don't"] * 3
    got = enc._encode(words)
    places, enc.begins = enc.begins, np.zeros_like(enc.begins)  # none begins: cut by places in the text
    assert places.any() and enc._encode(words) == got
