import hashlib
import re

from quotaloom.llm import exact_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for content, members in groups.items():
        best = min(members, key=lambda m: m[:3])
        kept = False
        for m in members:
            stays = m == best and not kept
            kept = kept or stays
            out.append((m[3], best[3], len(members), stays, hashlib.sha256(content.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in exact_dedup.find_exact_groups(df).collect()), key=str)


def test_groups_equal_brute_force(messy):
    assert found(messy) == brute([(r.doc_id, r.text) for r in messy.collect()])


def test_ties_copies_and_hot_group(spark):
    rows = [(i, "same text" + " " * (i % 3)) for i in range(-700, 700)] + [(i, f"text {i // 2}") for i in range(1000, 1400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(df) == brute(rows)


def test_empty_table(nothing):
    assert found(nothing) == []
    assert exact_dedup.drop_exact_copies(nothing).count() == 0


def test_one_row_of_each_group_stays_whole(messy):
    kept = exact_dedup.drop_exact_copies(messy)
    assert kept.columns == messy.columns
    rows = kept.collect()
    contents = [re.sub(r"\s", "", r.text or "") for r in rows]
    assert len(contents) == len(set(contents)) == len({re.sub(r"\s", "", r.text or "") for r in messy.collect()})
    assert [r.doc_id for r in rows if (r.text or "").startswith("alpha")] == [2]
    assert {r._digest for r in rows} == {"own"}


def test_contents_that_share_a_digest_stay_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    real = F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.substring(real(c, n), 1, 1))
    rows = [(i, f"text {i % 40}") for i in range(200)]
    got = exact_dedup.find_exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.id, r.keep_id, r.group_size) for r in got) == [(i, i % 40, 5) for i in range(200)]
