"""Vector compression by codebooks of parts, trained with active-entry Lloyd rounds.

A vector's components become integers and are cut into equal consecutive parts; every part position has a
codebook, and a vector's code is the index of the nearest entry for each part. A round assigns all parts and moves
each entry to the floor of its parts' mean. The squared distance to the assigned entry is kept as an exact integer:
while that entry stays where it is, a part is compared only with the entries that moved; the parts of entries that
moved are compared with all of them. Equal distances go to the lower index either way, so the codes are those of
rounds that compare everything.

The vectors are never collected or shuffled: a round reads the table that the round before wrote, and only sums
per entry (parts x entries x width numbers a task) travel. The driver holds the codebooks, of a size that the
parameters fix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from quotaloom.llm.common import cut, fresh, lookup, stored, text_of

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Parts compared at a time.
BLOCK = 8192


@dataclass
class Codebooks:
    """``entries[p]``: an integer array (entries, width) for part ``p``; empty if no vector was kept."""

    entries: list

    def sha256(self) -> str:
        """Of all entries' decimal components by part, entry and position, comma-joined."""
        numbers = ",".join(str(x) for book in self.entries for entry in book.tolist() for x in entry)
        return hashlib.sha256(numbers.encode()).hexdigest()


def distances(x, book):
    """Exact squared distances (rows, entries) of integer rows ``x`` to the entries ``book``.

    While every sum stays below 2**53, floating-point products are exact and the matrix product is used.
    """
    import numpy as np

    most = max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))
    bound = x.shape[1] * (2 * int(most)) ** 2
    if bound < 1 << 53:
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    if bound >= 1 << 63:
        raise ArithmeticError("components are too large: a squared distance would not fit a long")
    return np.stack([((x - entry) ** 2).sum(1) for entry in book], axis=1)


def nearest(x, book):
    """Index of and distance to the nearest entry of each row, the lower index on ties."""
    import numpy as np

    far = distances(x, book)
    at = far.argmin(1)
    return at, far[np.arange(len(x)), at]


def reassign(x, book, moved, code, held):
    """The same as ``nearest``, given each row's entry and exact distance before the entries ``moved`` (indexes) did."""
    import numpy as np

    code, held = code.copy(), held.copy()
    gone = np.isin(code, moved)
    if gone.any():
        code[gone], held[gone] = nearest(x[gone], book)
    stay = np.flatnonzero(~gone)
    if len(moved) and len(stay):
        at, far = nearest(x[stay], book[moved])
        at = moved[at]
        better = (far < held[stay]) | ((far == held[stay]) & (at < code[stay]))
        code[stay[better]], held[stay[better]] = at[better], far[better]
    return code, held


def _rows(column: pa.Array, kind: str, width: int):
    """A binary column of equally long values as an integer matrix (rows, width)."""
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width).astype(np.int64)


def _cells(matrix, kind: str) -> pa.Array:
    return pa.array([row.tobytes() for row in matrix.astype(kind)], pa.binary())


def _pack(vectors: DataFrame, vec: str, packed: str) -> DataFrame:
    """``vectors`` with the floors of its scaled components as little-endian 32-bit integers in place of ``vec``."""
    at = vectors.columns.index(vec)
    names = [packed if c == vec else c for c in vectors.columns]
    fields = [StructField(packed, BinaryType()) if f.name == vec else f for f in vectors.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            cells = batch.column(at)
            flat = np.floor(SCALE * cells.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            if np.abs(flat).max(initial=0) >= 1 << 31:
                raise ArithmeticError("components are too large: a squared distance would not fit a long")
            columns = list(batch.columns)
            columns[at] = _cells(flat.reshape(len(cells), -1), "<i4")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return vectors.mapInArrow(run, StructType(fields))


def _assign(rows: DataFrame, packed: str, code: str, dist: str, books: list, moved: list | None) -> DataFrame:
    """``rows`` with ``code`` (a byte a part) and ``dist`` (an array, a long a part) as of ``books``.

    ``moved`` names the entries of each part that changed since ``rows`` was assigned; None if it never was.
    """
    parts, width = len(books), books[0].shape[1]
    plain = [c for c in rows.columns if c not in (code, dist)]
    fields = [f for f in rows.schema.fields if f.name in plain]
    schema = StructType([*fields, StructField(code, BinaryType()), StructField(dist, ArrayType(LongType()))])
    at = rows.columns.index(packed)
    where = [rows.columns.index(c) for c in plain]
    before = None if moved is None else (rows.columns.index(code), rows.columns.index(dist))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for whole in batches:
            for low in range(0, len(whole), BLOCK):
                batch = whole.slice(low, BLOCK)
                x = _rows(batch.column(at), "<i4", parts * width).reshape(-1, parts, width)
                if before is None:
                    found = [nearest(x[:, p], books[p]) for p in range(parts)]
                else:
                    codes, held = _rows(batch.column(before[0]), "u1", parts), batch.column(before[1]).flatten().to_numpy().reshape(-1, parts)
                    found = [reassign(x[:, p], books[p], moved[p], codes[:, p], held[:, p]) for p in range(parts)]
                code_cells = _cells(np.stack([c for c, _ in found], axis=1), "u1")
                far = pa.array(np.stack([d for _, d in found], axis=1).reshape(-1))
                dist_cells = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * parts), far)
                columns = [*(batch.column(i) for i in where), code_cells, dist_cells]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def _entry_sums(rows: DataFrame, packed: str, code: str, parts: int, entries: int, width: int) -> list:
    """Per part, an object array (entries, 1 + width): how many parts each entry has, and their sums.

    A task adds its parts up before anything is shuffled; the driver gets parts x entries x (1 + width) numbers.
    """
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, 1 + width), np.int64)
        for batch in batches:
            x = _rows(batch.column(0), "<i4", parts * width).reshape(-1, parts, width)
            codes = _rows(batch.column(1), "u1", parts)
            for p in range(parts):
                np.add.at(total[p], codes[:, p], np.insert(x[:, p], 0, 1, axis=1))
        part, entry = np.nonzero(total[:, :, 0])
        sums = pa.array([total[p, e].tolist() for p, e in zip(part, entry, strict=True)], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), sums], names=["part", "entry", "sums"])

    partial = rows.select(packed, code).mapInArrow(run, "part int, entry int, sums array<long>")
    each = partial.select("part", "entry", F.posexplode("sums").alias("at", "n"))
    out = [np.zeros((entries, 1 + width), object) for _ in range(parts)]
    for r in each.groupBy("part", "entry", "at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect():
        out[r.part][r.entry, r.at] = int(r.n)
    return out


def train_and_encode(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", others: tuple[str, ...] = (),
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """Rows (id_col, ``others``, ``code``, ``distances``) of every kept vector, and the codebooks.

    ``code``: one byte a part; ``distances``: an array of the squared distances to the entries. Names
    that ``id_col`` or ``others`` hold get underscores. Each component x counts as floor(1024 x). The codebooks start as
    the parts of the vectors with the smallest ids; entries that no part is assigned to stay as they are.

    Dropped: vectors that are null, or hold a null or non-finite component, and those of another length than the
    first kept one by id has. Null ids rank last; equal ids rank by their vectors; repeated rows count as often as
    they come. No kept vector: no rows and empty codebooks. Components so large that a squared distance would not
    fit a long are refused, as is a length that ``parts`` does not divide.
    """
    import numpy as np

    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    rows = vectors.select(id_col, *others, vec_col)
    packed, code, dist = fresh(rows, "packed", "code", "distances")
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col(vec_col).isNotNull() & ~bad)
    by_id = [F.col(id_col).asc_nulls_last(), F.col(vec_col)]
    first = rows.orderBy(*by_id).select(F.size(vec_col).alias("n")).first()
    length = first.n if first else 0
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    rows = rows.where(F.size(vec_col) == length)
    width = length // parts
    start = [r[0] for r in rows.orderBy(*by_id).select(vec_col).limit(entries).collect()]  # at most ``entries`` vectors
    whole = np.floor(SCALE * np.array(start, np.float64)).reshape(len(start), parts, width)
    if np.abs(whole).max(initial=0) >= 1 << 31:
        raise ArithmeticError("components are too large: a squared distance would not fit a long")
    books = [whole[:, p].astype(np.int64) for p in range(parts)]
    if not start:
        empty = StructType([*(f for f in rows.schema.fields if f.name != vec_col), StructField(code, BinaryType()), StructField(dist, ArrayType(LongType()))])
        return vectors.sparkSession.createDataFrame([], empty), Codebooks(books)
    state, moved = _pack(rows, vec_col, packed), None
    for _ in range(rounds):
        state = stored(_assign(state, packed, code, dist, books, moved), "vector-codes", compression="zstd")
        sums = _entry_sums(state, packed, code, parts, len(start), width)
        moved = []
        for p, book in enumerate(books):
            count, total = sums[p][:, :1], sums[p][:, 1:]
            mean = np.where(count > 0, total // np.where(count > 0, count, 1), book).astype(np.int64)
            moved.append(np.flatnonzero((mean != book).any(axis=1)))
            books[p] = mean
    return _assign(state, packed, code, dist, books, moved).drop(packed), Codebooks(books)


def with_group_error(coded: DataFrame, error: str, label: str, name: str) -> DataFrame:
    """``coded`` with ``name``: the sum of ``error`` (long) over the rows of equal ``label``, nulls being equal.

    A label that most rows share is added up before the shuffle and looked up salted.
    """
    missing, key, size, mark = fresh(coded, "_missing", "_label", "_size", "_row")
    marked = coded.withColumns({missing: F.col(label).isNull(), key: text_of(label)})
    marked = stored(marked.withColumn(mark, F.monotonically_increasing_id()), "vector-errors", compression="zstd")
    totals = cut(marked.groupBy(missing, key).agg(F.sum(error).alias(name), F.count(F.lit(1)).alias(size)))
    return lookup(marked, totals, [missing, key], size, [mark]).select(*coded.columns, name)
