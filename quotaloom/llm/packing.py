"""Best-fit packing of tokenised documents into fixed-length sequences.

Each task packs its pieces online into a bounded number of open sequences: a bitset keyed by free
space finds the fullest one that a piece fits into, and when a new one must be opened and none
is left, the fullest closes. Sequences still open when a task ends would be the only ill-filled ones, so their
pieces are packed once more by a sixteenth as many tasks, and so on until one task does it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotaloom.llm.common import cut, text_of
from quotaloom.llm.tokens import chunks, encoder, read_text_file

CAPACITY = 4096
END_ID = 1
OPEN = 256
#: Each further round packs what is left with so many times fewer tasks.
FEWER = 16


class OpenSequences:
    """At most ``most`` open sequences; place(length) gives (sequence number, offset)."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits = 0  # bit f is set if some open sequence has f free places
        self.by_free: dict[int, list[int]] = {}
        self.n_open = self.n_all = 0

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        number = held.pop()
        if not held:
            self.bits ^= 1 << free
        self.n_open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.n_open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.capacity, self.n_all
            self.n_all += 1
        left = free - length
        if left:
            held = self.by_free.setdefault(left, [])
            held.append(number)
            self.bits |= 1 << left
            self.n_open += 1
        return number, self.capacity - free

    def still_open(self) -> set[int]:
        return {n for held in self.by_free.values() for n in held}


def tokenize_pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int, end_id: int, keep_ids: bool = False
) -> DataFrame:
    """Pieces of each document: ids, then ``end_id``, cut into ``capacity`` ids; optionally the ids as binary."""
    model = docs.sparkSession.sparkContext.broadcast(read_text_file(tokenizer_path))  # one fixed file
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model.value)
        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in chunks([t.as_py() for t in texts] if len(texts) < 64 else texts.to_pylist()):
                out: tuple[list, ...] = ([], [], [], [], [], [])
                part = texts.slice(a, b - a).to_pylist()
                for doc, ids in zip(ids_of[a:b], enc.ids(part), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at : at + 4 * capacity]
                        for column, v in zip(out, (doc, k, at // 4, len(piece) // 4, zlib.crc32(piece), piece), strict=True):
                            column.append(v)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                n = 5 + keep_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out[:n], kinds)], names=names[:n])

    return docs.select(F.col(id_col).cast("long"), text_of(text_col)).mapInArrow(run, schema)


def pack(items: DataFrame, length: str, capacity: int = CAPACITY, most_open: int = OPEN) -> DataFrame:
    """Add sequence_id and offset to ``items`` (1 <= length <= capacity): no sequence holds more than ``capacity``.

    Sequence numbers are unique, not consecutive. The columns ``sequence_id`` and ``offset`` are
    replaced if they exist. Repeated rows are placed one by one. An empty table stays empty.
    """
    spark = items.sparkSession
    names = [c for c in items.columns if c not in ("sequence_id", "offset")]
    schema = items.select(*names).schema.add("sequence_id", "long").add("offset", "long").add("_open", "boolean")
    where = names.index(length)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest, done, level = items.select(*names), None, 0
    while True:

        def run(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            bins, held = OpenSequences(capacity, most_open), []
            base = (level << 56) | (TaskContext.get().partitionId() << 32)
            for batch in batches:
                placed = [bins.place(n) for n in batch.column(where).to_pylist()]
                held.append((batch, placed))  # a few numbers a piece; which sequences stay open is known at the end
            still = bins.still_open()
            for batch, placed in held:
                extra = [
                    pa.array([base + n for n, _ in placed], pa.int64()),
                    pa.array([o for _, o in placed], pa.int64()),
                    pa.array([n in still for n, _ in placed], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*names, "sequence_id", "offset", "_open"])

        # Dealt round robin, then sorted: even parts whatever the keys, and the same result if a task runs again.
        dealt = rest.repartition(tasks).sortWithinPartitions(F.xxhash64(*names), *names)
        packed = cut(dealt.mapInArrow(run, schema))
        if tasks == 1:
            out = packed if done is None else done.unionByName(packed)
            return out.drop("_open")
        closed = packed.where("NOT _open")
        done = closed if done is None else done.unionByName(closed)
        rest, tasks, level = packed.where("_open").select(*names), max(1, tasks // FEWER), level + 1


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    most_open: int = OPEN,
) -> DataFrame:
    """Tokenise and pack: one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty: such a document is one piece of the end id alone. Documents longer
    than ``capacity`` are cut into pieces of ``capacity`` ids, the last may be shorter; no other is
    cut. Rows that repeat an id are separate documents; a null id is returned as null. Other
    columns are ignored, an empty table gives no rows.
    """
    pieces = cut(tokenize_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id))
    return pack(pieces, "length", capacity, most_open)


def fill_sequences(packed_with_ids: DataFrame, pad_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: sequence_id, ids (array of int), padded, from packed pieces with their ids (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            seqs = []
            for pieces in batch.column(1).to_pylist():
                ids = b"".join(p["ids"] for p in sorted(pieces, key=lambda p: p["offset"]))
                got = np.frombuffer(ids, "<u4").astype(np.int32)
                seqs.append(np.concatenate([got, np.full(capacity - len(got), pad_id, np.int32)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(seqs, pa.list_(pa.int32()))], names=["sequence_id", "ids"])

    parts = packed_with_ids.groupBy("sequence_id").agg(F.collect_list(F.struct("offset", "ids")).alias("pieces"))
    return parts.mapInArrow(run, "sequence_id long, ids array<int>")  # a group is one sequence: at most ``capacity`` ids
