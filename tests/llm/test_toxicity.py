import random

from pyspark.sql import functions as F

from quotaloom.llm import toxicity


def corpus(spark, n=600, seed=3):
    draw = random.Random(seed)
    plain = ["".join(draw.choices(["ta", "ro", "min", "el", "so", "ka"], k=draw.randint(1, 4))) for _ in range(300)]
    nasty = ["zugx", "vrekk", "blorq"]
    rows, labels = [], []
    for i in range(n):
        words = draw.choices(plain, k=draw.randint(5, 200))
        if i % 5 == 0:
            for _ in range(draw.randint(1, 3)):
                words[draw.randrange(len(words))] = draw.choice(nasty) + draw.choice(["", "ta", "el", "."])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit_by_fold(docs, labels)
    scored = toxicity.with_score(docs, model).join(labels, "doc_id").where(toxicity.fold("doc_id", 5) == 0).collect()
    wrong = [r.doc_id for r in scored if (r.score >= 0.5) != bool(r.toxic)]
    assert len(scored) > 80 and len(wrong) <= 4


def test_kneser_ney_equals_a_plain_version(spark):
    """The ratio of a seen word, from the definition."""
    from collections import Counter, defaultdict
    from math import log

    t, o = ["abab", "abc", "abab"], ["abc", "bca", "abc", "cab"]
    pad = lambda w: "\x02" * 4 + w + "\x03"
    c5 = [Counter(pad(w)[i : i + 5] for w in ws for i in range(len(w) + 1)) for ws in (t, o)]

    def shorter(c):
        left = defaultdict(set)
        for g in c:
            left[g[1:]].add(g[0])
        return {g: len(s) for g, s in left.items()}

    c4 = [shorter(c) for c in c5]
    c3 = [shorter(c) for c in c4]
    c2 = shorter(set(c3[0]) | set(c3[1]))
    c1 = shorter(c2)
    d = toxicity.DISCOUNT

    def p(k, g):
        if len(g) == 1:
            return c1[g] / sum(c1.values())
        c = c2 if len(g) == 2 else {3: c3, 4: c4, 5: c5}[len(g)][k]
        same = {x: n for x, n in c.items() if x[:-1] == g[:-1]}
        total = sum(same.values())
        if not total:
            return p(k, g[1:])
        return (max(c.get(g, 0) - d, 0) + d * len(same) * p(k, g[1:])) / total

    word = "abab"
    want = sum(log(p(0, pad(word)[i : i + 5]) / p(1, pad(word)[i : i + 5])) for i in range(len(word) + 1))
    rows = [(i, w, 1) for i, w in enumerate(t)] + [(10 + i, w, 0) for i, w in enumerate(o)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df)
    assert abs(toxicity.Scorer(model).lookup({word})[word] - want) < 1e-4


def test_messy_empty_and_one_class(spark, messy, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (6, 0), (8, 1), (9, 0)], "doc_id long, toxic int")
    model = toxicity.fit_by_fold(messy, labels)
    scored = toxicity.with_score(messy, model)
    assert sorted(scored.columns) == sorted(messy.columns)  # the clashing score is replaced
    assert scored.where("score BETWEEN 0 AND 1").count() == messy.count()
    assert toxicity.with_score(nothing, model).count() == 0
    for some in (labels.where("toxic = 0"), labels.limit(0)):
        none = toxicity.fit_by_fold(messy, some)
        assert toxicity.with_score(messy, none).agg(F.max("score")).first()[0] < 0.5
    assert toxicity.with_score(messy, toxicity.fit_by_fold(nothing, labels)).count() == messy.count()


def test_no_counted_gram_is_lost(spark):
    draw = random.Random(5)
    words = ["".join(map(chr, draw.choices(range(0x4E00, 0x5E00), k=10))) for _ in range(40_000)]
    rows = [(i, " ".join(words[i * 100 : i * 100 + 100]), i % 2) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scorer = toxicity.Scorer(toxicity.fit(docs, docs.limit(10)))
    points, owner = toxicity._grams(words)
    ends = (owner >= 0).nonzero()[0]
    for order in (3, 4, 5):
        assert scorer._find(toxicity._hashes(points, order)[ends])[0].all()
    for order in (2, 3, 4):  # contexts
        assert scorer._find(toxicity._hashes(points, order)[ends - 1] ^ 0xA5A5A5A5A5A5A5A5)[0].all()


def test_an_expression_scores_alike_wherever_it_stands(spark):
    docs, labels = corpus(spark)
    scorer = toxicity.Scorer(toxicity.fit_by_fold(docs, labels))
    plain = "ta ro min el so ka"
    texts = [f"{plain} {'so ' * k}{plain} zugx vrekk {plain} {plain}" for k in range(4)]
    highest = scorer.features(texts)[:, 0]
    assert max(abs(highest - highest[0])) < 1e-6
    words = toxicity.words_of(texts[2])
    value = scorer.lookup(set(words))
    windows = [sum(value[w] for w in words[i : i + 4]) / 4 for i in range(len(words) - 3)]
    assert abs(highest[2] - max(windows)) < 1e-6
    few = scorer.features(["zugx", "zugx ta ro min", ""])[:, 0]
    assert abs(few[0] - value["zugx"] / 2) < 1e-6 and few[2] == 0
