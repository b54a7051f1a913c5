import random
import re
import zlib
from collections import Counter

import pytest

from quotaloom.llm import queries, spelling

SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, min_length=6, min_count=5, ratio=5, noise=199):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_length:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= min_count}
    without = {}
    for w in counts:
        for i in range(len(w)):
            without.setdefault((i, w[:i] + w[i + 1 :]), set()).add(w)
            without.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    out, forms = {}, {}
    for w, n in counts.items():
        near = set(without.get(w, ()))
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            near |= without[i, short] | ({short} & counts.keys())
        near.discard(w)
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * n:
            forms[w] = best
        out[w] = [n, len(near)]
    for w in out:
        root = w
        while root in forms:
            root = forms[root]
        out[w] += [forms.get(w), counts.get(forms.get(w)), root]
    return {w: tuple(r) for w, r in out.items()}


def result(df):
    rows = df.collect()
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(got) == len(rows)
    return got


def texts(spark, *words):
    return spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, text string")


def test_forms_and_roots(spark):
    counts = {"aabbcc": 1, "abbcc": 6, "aabbc": 1, "aabbccc": 5, "aabbcd": 30, "xaabbcd": 200, "aaaaaa": 2, "aaaaaaa": 11}
    df = texts(spark, " ".join(w for w, n in counts.items() for _ in range(n)))
    got = result(spelling.group_variants(df, min_length=5, min_count=1, noise=1 << 40))
    assert got == brute([(0, df.first().text)], 5, 1, 5, 1 << 40)
    # The chain aabbcc -> aabbcd -> xaabbcd, and words that differ in one of several equal characters count once.
    assert got["aabbcc"] == (1, 4, "aabbcd", 30, "xaabbcd")
    assert got["aaaaaa"] == (2, 1, "aaaaaaa", 11, "aaaaaaa")


@pytest.mark.parametrize("ratio", [2, 4])
def test_equals_brute_force(spark, ratio):
    draw = random.Random(ratio)
    words = ["".join(draw.choices("abé", k=draw.randint(1, 5))) for _ in range(120)] + ["abab"] * 40
    df = texts(spark, " ".join(words), " ".join(words[::2]))
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert result(spelling.group_variants(df, "doc_id", "text", 1, 1, ratio, 2)) == brute(docs, 1, 1, ratio, 2)


def test_messy_and_empty_tables(spark, messy, nothing):
    got = result(spelling.group_variants(messy, min_count=1))
    assert got == brute([(r.doc_id, r.text) for r in messy.collect()], min_count=1)
    assert spelling.group_variants(nothing).collect() == []
    assert spelling.group_variants(messy, min_count=10**9).columns == ["word", "n", "n_near", "form", "form_n", "root"]


def test_long_words(spark):
    base = "abcdefghij" * 300
    words = [base] * 10 + [base[:1500] + base[1501:], base[:70] + "x" + base[71:], base + "z", "b" * 64, "b" * 65, "b" * 66]
    df = texts(spark, *words)
    assert result(spelling.group_variants(df, min_count=1)) == brute(list(enumerate(words)), min_count=1)


def test_ratio_must_rise(spark):
    with pytest.raises(ValueError):
        spelling.group_variants(texts(spark, "a"), ratio=1)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    assert any(r[2] and r[4] != r[2] for r in want.values()) or len(want) > 1000
    got = queries.op13_spelling_variants(spark, sf)
    assert sorted(got.columns) == ["form", "form_n", "n", "n_near", "root", "word"]
    assert result(got) == want
