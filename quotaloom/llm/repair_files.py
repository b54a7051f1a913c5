"""Token ids in grammar-compressed shard files.

Documents are tokenised in ascending id order and cut into shards. Re-Pair compresses each shard: the frequent
pairs of neighbouring symbols are replaced by nonterminals, again and again, a batch of pairs a round. A
shard is one row of a parquet table in the shared folder (so a lost task leaves no half-written file):
its rules, the number of ids each rule stands for, the remaining symbols, and the ids and lengths of its
documents. Any range of ids is decoded without the rest, from the symbols that cover it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotaloom.llm.common import stored, text_of
from quotaloom.llm.tokens import chunks, encoder, read_text_file

#: Nonterminals start here, above any token id.
FIRST_RULE = 1 << 20
#: A round makes rules of the most frequent pairs: so many, or a quarter of all frequent ones if that is more.
RULES_PER_ROUND = 4096
#: A pair is worth a rule if it occurs this often in the shard.
LEAST = 8
#: A shard is closed at the first document end beyond so many ids; rows of documents dealt to a task.
SHARD_IDS = 1 << 21
END_ID = 2
#: Texts of about so many characters are tokenised at a time: each batch counts its distinct words anew.
CHUNK_CHARS = 32_000_000
#: Rules of at most so many ids are spelled out once a shard, before its documents are decoded.
SHORT = 16
#: Once so small a share of the symbols may be in a frequent pair, what is replaced is only marked as gone.
LINK_SHARE = 2
#: Pairs are first counted in a table of at most 2 ** HASH_BITS buckets.
HASH_BITS = 20

SHARD = "part long, shard int, n_ids long, doc_ids binary, doc_lengths binary, rules binary, rule_rounds binary, expansions binary, symbols binary"


def _bucket(a, b, bits):
    import numpy as np

    return ((a * np.uint32(2654435761)) ^ (b * np.uint32(2246822519))) >> np.uint32(32 - bits)


def compress(ids):
    """Re-Pair of an array of uint32 ids: (symbols, rules (n, 2), rules per round, ids per rule).

    Each round counts the pairs, gives a rule to the most frequent ones and replaces their
    occurrences from left to right; where chosen pairs overlap, every other one of the run is taken. Rounds
    go on until no pair occurs LEAST times; later ones run on ever fewer symbols.
    """
    import numpy as np

    s, rules, rounds, lengths = ids.astype(np.uint32), [], [], []
    # Places whose pair may be frequent. All occurrences of a pair come with its newer symbol and later only go, so a pair that was
    # not frequent once never is: its places wait until a neighbour is replaced.
    live = np.arange(len(s) - 1) if len(s) else np.zeros(0, np.int64)
    after = before = gone = None  # the places next to each one, once symbols that go leave gaps
    while len(live) >= LEAST:
        a, b = (s[:-1], s[1:]) if len(live) == len(s) - 1 else (s[live], s[live + 1 if after is None else after[live]])
        bits = min(HASH_BITS, len(live).bit_length() + 1)
        h = _bucket(a, b, bits).astype(np.int64)
        counts = np.bincount(h, minlength=1 << bits)
        many = np.flatnonzero(counts >= LEAST)
        batch = max(RULES_PER_ROUND, len(many) // 4)
        if not len(many):
            break
        rule_of = np.full(1 << bits, -2, np.int32)
        rule_of[many] = -1
        if len(many) > batch:
            many = many[np.argpartition(counts[many], len(many) - batch)[-batch:]]
        # A bucket has one rule a round, for the pair seen there last, mostly its most frequent one; others wait.
        rule_of[many] = np.arange(len(many))
        r = rule_of[h]
        stays, at = r > -2, np.flatnonzero(r >= 0)
        r = r[at].astype(np.int64)
        seen = np.empty(len(many), np.int64)
        seen[r] = at
        fits = (a[at] == a[seen][r]) & (b[at] == b[seen][r])
        at, r = at[fits], r[fits]
        often = np.bincount(r, minlength=len(many)) >= LEAST
        left, right = a[seen][often], b[seen][often]
        if len(left):
            number = np.cumsum(often) - 1
            fits = often[r]
            at, r = at[fits], number[r[fits]]
        else:  # buckets that fill up with different pairs: count those exactly
            full = np.flatnonzero(stays)
            pairs, r, n = np.unique(a[full].astype(np.uint64) << np.uint64(32) | b[full], return_inverse=True, return_counts=True)
            often = n >= LEAST
            if not often.any():
                break
            at = np.flatnonzero(often[r])
            r, at = (np.cumsum(often) - 1)[r[at]], full[at]
            left, right = (pairs[often] >> np.uint64(32)).astype(np.uint32), pairs[often].astype(np.uint32)
        at, live = live[at], live[stays]
        new_run = np.ones(len(at), bool)
        new_run[1:] = at[1:] != (at[:-1] + 1 if after is None else after[at[:-1]])
        run_start = np.flatnonzero(new_run)
        run_start = np.repeat(run_start, np.diff(run_start, append=len(at)))
        take = (np.arange(len(at)) - run_start) & 1 == 0
        at, r = at[take], r[take]
        base = FIRST_RULE + sum(rounds)
        s[at] = base + r
        may = np.zeros(len(s), bool)
        may[live] = True
        may[at] = True
        if after is None:
            may[np.maximum(at - 1, 0)] = True
            keep = np.ones(len(s), bool)
            keep[at + 1] = False
            s, may = s[keep], may[keep]
            may[-1] = False
            live = np.flatnonzero(may)
            if LINK_SHARE * len(live) < len(s):
                after, before, gone = np.arange(1, len(s) + 1), np.arange(-1, len(s)), np.zeros(len(s), bool)
        else:
            may[np.maximum(before[at], 0)] = True
            taken = after[at]
            gone[taken], may[taken] = True, False
            after[at] = after[taken]
            before[after[at]] = at
            live = np.flatnonzero(may)
            live = live[after[live] < len(s)]
        known = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
        size = lambda x: np.where(x >= FIRST_RULE, known[np.maximum(x.astype(np.int64) - FIRST_RULE, 0)] if len(known) else 1, 1)
        lengths.append(size(left) + size(right))
        rules.append(np.stack([left, right], 1))
        rounds.append(len(left))
    none = np.zeros((0, 2), np.uint32)
    s = s if gone is None else s[~gone]
    return s, np.concatenate(rules) if rules else none, rounds, np.concatenate(lengths) if lengths else np.zeros(0, np.int64)


def _by_pairs(s, at, rules):
    """``s`` with the rules at ``at`` replaced by their pairs."""
    import numpy as np

    size = np.ones(len(s), np.int64)
    size[at] = 2
    out, first = np.repeat(s, size), at + np.arange(len(at))
    pair = rules[s[at].astype(np.int64) - FIRST_RULE]
    out[first], out[first + 1] = pair[:, 0], pair[:, 1]
    return out


def expand(symbols, rules):
    """The ids that ``symbols`` stand for: all rules at once by their pairs, as often as the grammar is deep."""
    import numpy as np

    s = symbols
    while True:
        at = np.flatnonzero(s >= FIRST_RULE)
        if not len(at):
            return s
        s = _by_pairs(s, at, rules)


def spell(symbols, rules, expansions):
    """(every id and every short rule's ids as bytes, the first rule's row there, which rules are not short)."""
    import numpy as np

    long = expansions > SHORT
    top = max(int(x[x < FIRST_RULE].max(initial=0)) for x in (symbols, rules)) + 1
    plain = np.arange(top, dtype="<u4")
    ids = np.concatenate([plain, expand((FIRST_RULE + np.flatnonzero(~long)).astype("<u4"), rules)])
    sizes = np.concatenate([[0], np.ones(top, np.int64), np.where(long, 0, expansions)])
    ends = pa.py_buffer(4 * np.cumsum(sizes))
    return pa.Array.from_buffers(pa.large_binary(), len(sizes) - 1, [None, ends, pa.py_buffer(ids)]), top, long


def expand_spelled(symbols, rules, spelled):
    """As ``expand``, with the short rules looked up."""
    import numpy as np

    ids, first, long = spelled
    s = symbols
    while True:
        at = np.flatnonzero(s >= FIRST_RULE)
        at = at[long[s[at].astype(np.int64) - FIRST_RULE]]
        if not len(at):
            break
        s = _by_pairs(s, at, rules)
    row = s.astype(np.int64)
    row[row >= FIRST_RULE] += first - FIRST_RULE
    out = ids.take(pa.array(row))
    n = np.frombuffer(out.buffers()[1], np.int64, len(row) + 1)[-1] // 4
    return np.frombuffer(out.buffers()[2] or b"", "<u4", n)


def decode_range(symbols, rules, expansions, start: int, stop: int, ends=None, spelled=None):
    """Ids ``start`` to ``stop`` of a shard, from the symbols that cover them; ``ends``: of symbols, and ``spelled`` rules, if known."""
    import numpy as np

    if ends is None:
        ends = symbol_ends(symbols, expansions)
    i, j = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    if stop <= start:
        return np.zeros(0, np.uint32)
    before = ends[i - 1] if i else 0
    out = expand(symbols[i:j], rules) if spelled is None else expand_spelled(symbols[i:j], rules, spelled)
    return out[start - before : stop - before]


def symbol_ends(symbols, expansions):
    """Number of ids up to the end of each symbol."""
    import numpy as np

    size = np.ones(len(symbols), np.int64)
    rule = symbols >= FIRST_RULE
    size[rule] = expansions[symbols[rule].astype(np.int64) - FIRST_RULE]
    return np.cumsum(size)


def write_shards(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, shard_ids: int = SHARD_IDS
) -> DataFrame:
    """Tokenise ``docs`` in ascending id order, each with ``end_id`` at its end, and write the shard table; returns it as read back.

    Null text counts as empty. Rows that repeat an id stay apart, in the order of their texts' hashes; null ids come
    first. (part, shard) orders the shards. An empty table gives an empty shard table.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(read_text_file(tokenizer_path))  # one fixed file
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        enc, part, shard = encoder(model.value), TaskContext.get().partitionId(), 0
        ids, lengths, held, n_held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(held), "<u4")
            symbols, rules, rounds, sizes = compress(data)
            row = {
                "part": part, "shard": shard, "n_ids": len(data),
                "doc_ids": _pack_ids(ids), "doc_lengths": np.array(lengths, "<i8").tobytes(),
                "rules": rules.astype("<u4").tobytes(), "rule_rounds": np.array(rounds, "<i4").tobytes(),
                "expansions": sizes.astype("<i8").tobytes(), "symbols": symbols.astype("<u4").tobytes(),
            }
            kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 6]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(texts, CHUNK_CHARS):
                for doc, got in zip(doc_ids[a:b], enc.ids(texts[a:b]), strict=True):
                    held.append(got + end)
                    ids.append(doc)
                    lengths.append(len(got) // 4 + 1)
                    n_held += lengths[-1]
                    if n_held >= shard_ids:
                        yield flush()
                        ids, lengths, held, n_held, shard = [], [], [], 0, shard + 1
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(tasks, "id").sortWithinPartitions("id", F.xxhash64("text"))
    return stored(ordered.mapInArrow(run, SHARD), "token-shards", compression="zstd")


#: Written in place of a null document id.
NO_ID = -(1 << 63)


def _pack_ids(ids: list[int | None]) -> bytes:
    import numpy as np

    return np.array([NO_ID if i is None else i for i in ids], "<i8").tobytes()


def unpack(row: dict) -> dict:
    """A shard row's columns as arrays."""
    import numpy as np

    kinds = {"doc_ids": "<i8", "doc_lengths": "<i8", "rules": "<u4", "rule_rounds": "<i4", "expansions": "<i8", "symbols": "<u4"}
    out = {k: np.frombuffer(row[k], t) for k, t in kinds.items()}
    return out | {"rules": out["rules"].reshape(-1, 2), "rule_rounds": out["rule_rounds"].tolist()}


def read_documents(shards: DataFrame, only_crc: bool = False) -> DataFrame:
    """Decode a shard table: doc_id, part, shard, place (in its shard), n_tokens, ids (binary, little-endian uint32), or those bytes' ids_crc32."""
    last = "ids_crc32" if only_crc else "ids"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                s = unpack(row)
                ends, spelled = symbol_ends(s["symbols"], s["expansions"]), spell(s["symbols"], s["rules"], s["expansions"])
                stops = np.cumsum(s["doc_lengths"])
                n = len(stops)
                step = max(1, n // 16)
                for a in range(0, n, step):  # a few documents at a time, each run of them by its own range
                    b = min(n, a + step)
                    first = int(stops[a] - s["doc_lengths"][a])
                    ids = decode_range(s["symbols"], s["rules"], s["expansions"], first, int(stops[b - 1]), ends, spelled)
                    data = memoryview(ids.astype("<u4").tobytes())
                    cut = [(int(stops[k] - s["doc_lengths"][k]), int(stops[k])) for k in range(a, b)]
                    each = [data[4 * (x - first) : 4 * (y - first)] for x, y in cut]
                    docs = [None if d == NO_ID else d for d in s["doc_ids"][a:b].tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(docs, pa.int64()),
                            pa.array([row["part"]] * (b - a), pa.int64()),
                            pa.array([row["shard"]] * (b - a), pa.int32()),
                            pa.array([x for x, _ in cut], pa.int64()),
                            pa.array([y - x for x, y in cut], pa.int64()),
                            pa.array([zlib.crc32(d) for d in each], pa.int64()) if only_crc else pa.array([bytes(d) for d in each], pa.binary()),
                        ],
                        names=["doc_id", "part", "shard", "place", "n_tokens", last],
                    )

    return shards.mapInArrow(run, f"doc_id long, part long, shard int, place long, n_tokens long, {last} {'long' if only_crc else 'binary'}")


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, shard, shard_start): ids in all shards before; sums per part first, so no window holds all shards."""
    narrow = shards.select("part", "shard", "n_ids")
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    parts = narrow.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("all", F.lit(0))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before("all", "part")), F.lit(0)).alias("part_start"))
    inside = narrow.withColumn("at", F.coalesce(F.sum("n_ids").over(before("part", "shard")), F.lit(0)))
    return inside.join(parts, "part").select("part", "shard", (F.col("at") + F.col("part_start")).alias("shard_start"))


def document_index(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, decoded from the files."""
    docs = read_documents(shards, only_crc=True)
    return docs.join(shard_starts(shards), ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )
