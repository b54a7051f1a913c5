import base64
import hashlib
import re

from pyspark.sql import functions as F

from quotaloom.llm import secret_scan

ANY_CASE = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"""({ANY_CASE})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
TEXTS = [
    'token=ab token = "abcdef" Secret:xyz Api_Key : \'a.b/c+d=e-f_g\'',
    "token=token = abcdef passwd=12345 PASSWD=123456",
    "AKIA" + "A1" * 8 + " AKIAAKIA AKIA" + "B" * 15 + " xAKIA" + "C" * 30,
    "deadbeef" * 3 + " " + "a" * 23 + " " + "0" * 25 + "g",
    "ü𝄞 password=𝄞abcdef password=abc𝄞def ünï token:abcdef0123456789abcdef01",
    "secret=:token=abcdef", "", "no secrets here at all", "token K toKen=abcdefg",
]


def brute(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def spans(df):
    rows = secret_scan.find_secrets(df).select("id", secret_scan.span_text(F.col("spans")).alias("s")).collect()
    return {r.id: [x for x in r.s.split(",") if x] for r in rows}


def test_base_spans(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = spans(df)
    for i, text in enumerate(TEXTS):
        assert ",".join(x for x in got[i] if not x.startswith("markov")) == brute(text), text


def test_very_many_matches(spark):
    text = " ".join("0123456789abcdef" * 2 + "x" * (i % 5) for i in range(6000))
    assert ",".join(spans(spark.createDataFrame([(1, text)], "doc_id long, text string"))[1]) == brute(text)


def test_models_find_random_strings_only(spark):
    word = "".join
    plain = [word(["Konfiguration", "manager", "Verbindung", "handler"][(i * k) % 4] for k in (1, 2, 3)) for i in range(40)]
    docs = [(i, f"the {plain[i % 40]} uses {plain[(i * 7) % 40]} and other_identifier_names") for i in range(400)]
    keys = [base64.b64encode(hashlib.sha256(str(i).encode()).digest()).decode().strip("=") for i in range(30)]
    docs += [(1000 + i, f"here {k} there") for i, k in enumerate(keys)]
    got = spans(spark.createDataFrame(docs, "doc_id long, text string"))
    assert all(got[i] == [] for i in range(400))
    assert sum(got[1000 + i] == [f"markov:5:{5 + len(k)}"] for i, k in enumerate(keys)) >= 28


def test_ratio_from_the_definition(spark):
    import math

    samples = spark.createDataFrame([("x9x9", True), ("abab", False), ("ab", False)], "value string, random boolean")
    table = secret_scan.train(samples)
    side, low = secret_scan.SIDE, secret_scan.LOW
    prior = secret_scan.PRIOR
    # a to b: random never, with 3 pairs none of which ends in b; ordinary 3 of 3, with 4 pairs of which 3 end in b.
    want = math.log(prior / (3 + side) / prior) - math.log((3 + prior * 4 / (4 + side)) / (3 + prior))
    assert abs(table[(ord("a") - low) * side + ord("b") - low] - want) < 1e-12
    got = spark.range(1).select(secret_scan.ratio(F.lit("ab"), table)).first()[0]
    assert abs(got - want) < 1e-5


def test_messy_and_empty(messy, nothing):
    rows = secret_scan.find_secrets(messy).collect()
    assert sorted((r.id for r in rows), key=str) == sorted((r.doc_id for r in messy.collect()), key=str)
    assert [len(r.spans) for r in rows if r.text.startswith("token")] == [2]  # the assignment and the digits
    assert secret_scan.find_secrets(nothing).count() == 0


def test_plan_has_no_python(messy, capsys):
    secret_scan.find_secrets(messy).explain()
    assert "Python" not in capsys.readouterr().out


def test_planted_strings_among_shouted_and_ordinary_words(spark):
    import random

    draw = random.Random(8)
    letters, capitals = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    parts = ["schild", "berg", "haus", "trager", "recht", "stadt", "ordnung", "verein"]
    words = ["".join(draw.choices(parts, k=3)) for _ in range(300)]
    docs = [(i, " ".join(draw.choices(words, k=20))) for i in range(300)]
    docs += [(1000 + i, f"hear {''.join(draw.choices(parts, k=3)).upper()} {draw.choice(words).capitalize()} now") for i in range(100)]
    keys = ["".join(draw.choices(letters if i % 2 else capitals, k=32)) for i in range(60)]
    docs += [(2000 + i, f"value {k} end") for i, k in enumerate(keys)]
    got = spans(spark.createDataFrame(docs, "doc_id long, text string"))
    assert not [i for i, found in got.items() if i < 2000 and found]
    assert sum(got[2000 + i] == [f"markov:6:{6 + len(k)}"] for i, k in enumerate(keys)) >= 57
