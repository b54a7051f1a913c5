import random

import numpy as np
from pyspark.sql import functions as F

from quotaloom.llm import langid

PARTS = {"aa": ["tion", "the", "ing", "ou"], "bb": ["sch", "ung", "ein", "ä"], "cc": ["ción", "que", "ll", "ñ"]}


def corpus(spark, n=240):
    draw = random.Random(9)
    rows = []
    for i in range(n):
        lang = ["aa", "bb", "cc"][i % 3]
        words = ["".join(draw.choices(PARTS[lang], k=draw.randint(1, 3))) for _ in range(draw.randint(3, 120))]
        rows.append((i, " ".join(words), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    model = langid.fit(docs.where("doc_id % 4 > 0"))
    assert model["langs"] == ["aa", "bb", "cc"]
    got = langid.with_language(docs, model).where("doc_id % 4 = 0").collect()
    assert sum(r.lang != r.lang_pred for r in got) <= 1
    assert all(0 <= r.score <= 1 for r in got)


def test_tables_equal_the_convolution():
    draw = np.random.default_rng(0)
    x = draw.integers(0, 256, (40, langid.WINDOW)).astype(np.uint8)
    net = langid.train_network(x, np.arange(40) % 2, 2)
    want = []
    for row in x:
        pooled = []
        for w in langid.WIDTHS:
            tables = net[f"t{w}"]
            best = np.full(langid.FILTERS, -np.inf)
            for p in range(langid.WINDOW - w + 1):
                total = np.zeros(langid.FILTERS)
                for k, t in enumerate(tables):
                    a = int(row[p + 2 * k])
                    total += t[a * 256 + int(row[p + 2 * k + 1])] if len(t) == 65536 else t[a]
                best = np.maximum(best, total)
            pooled.append(np.maximum(best, 0))
        z = np.concatenate(pooled) @ net["o"] + net["b"]
        want.append(z - np.log(np.exp(z).sum()))
    assert np.allclose(langid.log_probabilities(net, x), want, atol=1e-3)


def test_whole_text_is_cut_into_windows():
    assert langid.windows(b"").shape == (1, langid.WINDOW)
    data = bytes(range(1, 200)) * 5
    w = langid.windows(data)
    assert w.tobytes().rstrip(b"\0") == data


def test_messy_empty_and_untrained(spark, messy, nothing):
    model = langid.fit(corpus(spark, 60))
    got = langid.with_language(messy, model).collect()
    assert len(got) == messy.count()
    for r in got:
        unknown = r.text is None or not any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == unknown
    assert langid.with_language(nothing, model).count() == 0
    assert langid.fit(nothing) is None
    assert langid.with_language(messy, None).where(F.col("lang_pred") != "und").count() == 0
