import hashlib
import statistics
import struct

import xxhash
from pyspark.sql import functions as F

from quotaloom.llm import fingerprints
from quotaloom.llm.fingerprints import BINS, SHINGLE


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute(text):
    words = [w for w in (text or "").lower().split() if w]
    hashes = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]
    mins = {}
    for i in range(max(1, len(words) - SHINGLE + 1) if words else 0):
        h = 42
        for w in hashes[i : i + SHINGLE]:
            h = xxhash.xxh64_intdigest(struct.pack("<q", w), h & (2**64 - 1))
        b, v = h >> 57, signed(h)
        mins[b] = min(mins.get(b, v), v)
    if not mins:
        return ""
    orders = fingerprints.probe_order()
    filled = [b if b in mins else next(j for j in orders[b] if j in mins) for b in range(BINS)]
    return "".join("0123456789abcdef"[mins[b] & 15] for b in filled)


def prints(df):
    return [(r.id, r.f) for r in df.select(F.col("doc_id").alias("id"), fingerprints.fingerprint(F.col("text")).alias("f")).collect()]


def test_fingerprints_equal_brute_force(spark, messy):
    rows = [(i, " ".join(f"w{(i * k) % 97}" for k in range(i * 3))) for i in range(60)]
    assert prints(spark.createDataFrame(rows, "doc_id long, text string")) == [(i, brute(t)) for i, t in rows]
    assert prints(messy) == [(r.doc_id, brute(r.text)) for r in messy.collect()]


def test_likeness_estimates_similarity(spark):
    rows = []
    for i in range(150):
        a = [f"a{i}x{k}" for k in range(400)]
        cut = 20 + 2 * i
        rows.append((i, " ".join(a), " ".join(a[:-cut] + [f"b{i}x{k}" for k in range(cut)])))
    df = spark.createDataFrame(rows, "i long, a string, b string")
    f = fingerprints.fingerprint
    got = {r[0]: r[1] for r in df.select("i", fingerprints.likeness(f(F.col("a")), f(F.col("b")))).collect()}
    errors = []
    for i, a, b in rows:
        sets = [{tuple(t.split()[k : k + SHINGLE]) for k in range(len(t.split()) - SHINGLE + 1)} for t in (a, b)]
        errors.append(got[i] - len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
    assert abs(statistics.mean(errors)) < 0.015 and statistics.stdev(errors) < 0.06


def test_edited_texts_and_next_documents(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "SLICE_ROWS", 7)
    rows = sorted((i * i - 40, f"text 𝄞 number {i} " * (i % 9)) for i in range(100))
    got = {r.id: r for r in fingerprints.compare_with_edit(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert len(got) == 100
    for k, (i, text) in enumerate(rows):
        follows = rows[(k + 1) % 100][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + follows[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (brute(text), brute(edited))
        a, b = brute(text), brute(follows)
        share = sum(x == y for x, y in zip(a, b, strict=False)) / BINS
        want = 1.0 if a == b else 0.0 if not a or not b else max(0.0, (share - 1 / 16) / (15 / 16))
        assert abs(r.near_next - want) < 1e-9


def test_messy_single_and_empty(spark, messy, nothing):
    rows = fingerprints.compare_with_edit(messy).collect()
    assert sorted((r.id for r in rows), key=str) == sorted((r.doc_id for r in messy.collect()), key=str)
    one = fingerprints.compare_with_edit(spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0  # after the last comes the first: itself
    assert fingerprints.compare_with_edit(nothing).count() == 0


def test_plan_has_no_python(messy, capsys):
    fingerprints.compare_with_edit(messy).explain()
    assert "Python" not in capsys.readouterr().out
