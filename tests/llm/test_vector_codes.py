import hashlib
import random

import numpy as np
import pytest

from quotaloom.llm import queries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, packed string, distances int"


def brute(rows, parts=4, entries=256, rounds=4):
    """Plain Lloyd rounds over Python integers: {id: (code, distances)} as lists in row order, and the codebooks."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cutup = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in kept]
    books = [[list(c[p]) for c in cutup[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cutup:
            far = [[sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)) for e in books[p]] for p in range(parts)]
            out.append(([f.index(min(f)) for f in far], [min(f) for f in far]))
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, (code, _) in zip(cutup, found, strict=True) if code[p] == e]
                if own:
                    books[p][e] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    return [(i, *f) for (i, _), f in zip(kept, assign(), strict=True)], books


def decoded(rows):
    return [(r.vec_id, list(r.code), r.distances) for r in rows]


@pytest.mark.parametrize("entries", [3, 20])
def test_equals_plain_rounds(spark, entries):
    draw = random.Random(entries)
    # Few distinct values: many equal distances, equal entries and entries that no part is assigned to.
    rows = [(i, [draw.choice([-0.01, -0.001, 0.0, 0.002, 0.0021, 0.05]) for _ in range(8)]) for i in draw.sample(range(1000), 150)]
    rows += [rows[0], rows[1], (None, [0.5] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    coded, books = vector_codes.train_and_encode(df, entries=entries)
    want, want_books = brute([(r.vec_id, r.embedding) for r in df.collect()], entries=entries)
    assert sorted(decoded(coded.collect()), key=str) == sorted(want, key=str)
    assert [b.tolist() for b in books.entries] == want_books


def test_reassign_equals_a_full_comparison():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x, book = rng.integers(-3, 4, (40, 2)), rng.integers(-3, 4, (9, 2))
        code, held = vector_codes.nearest(x, book)
        moved = np.sort(rng.choice(9, rng.integers(0, 10), replace=False))
        later = book.copy()
        later[moved] += rng.integers(-2, 3, (len(moved), 2))
        for a, b in zip(vector_codes.reassign(x, later, moved, code, held), vector_codes.nearest(x, later), strict=True):
            assert a.tolist() == b.tolist()


def test_large_components_are_exact_or_refused():
    x, book = np.array([[2**28, -(2**28)]]), np.array([[2**28 - 1, -(2**28)], [-(2**28), 2**28]])
    assert vector_codes.distances(x, book).tolist() == [[1, 2 * (2**29) ** 2]]
    with pytest.raises(ArithmeticError):
        vector_codes.distances(x * 8, book)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [0.1, 0.2, 0.3, 0.4], 1, "own", "own", 1),
        (1, [-0.1, 0.2, 0.3, 0.4], None, "own", "own", 1),
        (1, [-0.1, 0.2, 0.3, 0.4], None, "own", "own", 1),
        (2, None, 1, None, None, None),
        (3, [0.1, None, 0.3, 0.4], 1, None, None, None),
        (4, [0.1, nan, 0.3, 0.4], 1, None, None, None),
        (6, [0.1, inf, 0.3, 0.4], 1, None, None, None),
        (7, [0.1, -inf, 0.3, 0.4], 1, None, None, None),
        (8, [], 1, None, None, None),
        (9, [0.1] * 8, 1, None, None, None),
        (None, [0.9, 0.2, 0.3, 0.4], 1, "own", "own", 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    coded, books = vector_codes.train_and_encode(df, others=("label", "code", "packed", "distances"), entries=2, rounds=1)
    assert coded.columns == ["vec_id", "label", "code", "packed", "distances", "code_", "distances_"]
    assert sorted((r.vec_id for r in coded.collect()), key=str) == [1, 1, 5, None]
    # The two smallest ids are the repeated row: equal entries, of which the lower index is used.
    assert {bytes(r.code_)[1:] for r in coded.collect()} == {b"\0\0\0"}
    assert books.entries[0].tolist() == [[(-103 - 103 + 102 + 921) // 4], [-103]]
    with pytest.raises(ValueError):
        vector_codes.train_and_encode(df.where("vec_id = 5"), parts=3)


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    coded, books = vector_codes.train_and_encode(none)
    assert coded.count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()
    assert vector_codes.with_group_error(coded.selectExpr("1L as e", "1 as label"), "e", "label", "t").count() == 0


def test_group_errors(spark):
    df = spark.createDataFrame([(1, 5), (None, 2), (None, 3), (1, 1), (2, 0)], "label int, e long")
    got = vector_codes.with_group_error(df, "e", "label", "t").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 5, 6), (1, 1, 6), (2, 0, 0), (None, 2, 5), (None, 3, 5)], key=str)


def test_query_equals_plain_rounds(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.vec_id: r for r in queries.op12_vector_codes(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want, books = brute([(r.vec_id, r.embedding) for r in rows])
    labels, total = {r.vec_id: r.label for r in rows}, {}
    for i, _, d in want:
        total[labels[i]] = total.get(labels[i], 0) + sum(d)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    assert len(got) == len(want)
    for i, code, d in want:
        assert got[i][1:] == (bytes(code).hex(), sum(d), total[labels[i]], sha)
