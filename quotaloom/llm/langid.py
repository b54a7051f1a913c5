"""Language identification by a byte convolutional network, trained in numpy.

Bytes are embedded, convolved with filters of several widths, max-pooled over a fixed-length window
and classified by a softmax. A whole text is cut into consecutive windows; its language has the
highest mean log-probability over them. Once trained, a filter over an embedding is a sum of
table rows indexed by bytes and pairs of bytes, which is how windows are evaluated in batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: Training takes at most about so many documents of each language, the same ones in every run, and so many windows of each.
DOCS_PER_LANG = 600
WINDOWS_PER_DOC = 4
STEPS = 700
BATCH = 64
RATE = 0.01
#: Bytes evaluated at a time.
CHUNK = 1 << 19
UNKNOWN = "und"

_letter = re.compile(r"[^\W\d_]")


def windows(data: bytes):
    """(n, WINDOW) bytes of the whole text, zero-padded at the end."""
    import numpy as np

    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, WINDOW)


def train_network(x, y, classes: int, seed: int = 1) -> dict:
    """Adam on softmax cross-entropy over windows ``x`` (n, WINDOW) with labels ``y``; returns the evaluation tables."""
    import numpy as np

    rng = np.random.default_rng(seed)
    p = {"e": rng.normal(0, 0.5, (256, EMBED)), "b": np.zeros(classes)}
    p["o"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), classes))
    for w in WIDTHS:
        p[f"w{w}"], p[f"c{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS)), np.zeros(FILTERS)
    m, v = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}
    by_class = [np.flatnonzero(y == c) for c in range(classes)]
    for step in range(1, STEPS + 1):
        rows = np.array([rng.choice(by_class[c]) for c in rng.integers(0, classes, BATCH)])
        bx, by = x[rows].astype(np.int64), y[rows]
        emb = p["e"][bx]
        pooled, saved = [], []
        for w in WIDTHS:
            n = WINDOW - w + 1
            cols = np.concatenate([emb[:, k : k + n] for k in range(w)], axis=2)
            out = cols @ p[f"w{w}"] + p[f"c{w}"]
            best = out.argmax(1)
            top = np.take_along_axis(out, best[:, None], 1)[:, 0]
            pooled.append(np.maximum(top, 0))
            saved.append((cols, best, top > 0))
        h = np.concatenate(pooled, 1)
        z = h @ p["o"] + p["b"]
        z -= z.max(1, keepdims=True)
        q = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        q[np.arange(len(by)), by] -= 1
        q /= len(by)
        grad = {k: np.zeros_like(a) for k, a in p.items()}
        grad["o"], grad["b"] = h.T @ q, q.sum(0)
        dh = q @ p["o"].T
        r = np.arange(len(by))[:, None]
        for i, (w, (cols, best, on)) in enumerate(zip(WIDTHS, saved, strict=True)):
            d = dh[:, i * FILTERS : (i + 1) * FILTERS] * on  # only each filter's best place has a gradient
            picked = cols[r, best]  # batch, filter, w * EMBED
            grad[f"w{w}"] = np.einsum("bfi,bf->if", picked, d)
            grad[f"c{w}"] = d.sum(0)
            back = (d[:, :, None] * p[f"w{w}"].T[None]).reshape(len(by), FILTERS, w, EMBED)
            for k in range(w):
                np.add.at(grad["e"], bx[r, best + k], back[:, :, k])
        for k, g in grad.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = {"o": p["o"].astype(np.float32), "b": p["b"].astype(np.float32)}
    for w in WIDTHS:
        rows = [(p["e"] @ p[f"w{w}"][k * EMBED : (k + 1) * EMBED]).astype(np.float32) for k in range(w)]
        rows[0] = rows[0] + p[f"c{w}"].astype(np.float32)
        pairs = [(rows[k][:, None] + rows[k + 1][None]).reshape(65536, FILTERS) for k in range(0, w - 1, 2)]
        net[f"t{w}"] = [*pairs, *([rows[-1]] if w % 2 else [])]
    return net


def log_probabilities(net: dict, x):
    """Log-softmax of each window of ``x`` (n, WINDOW)."""
    import numpy as np

    out = []
    for at in range(0, len(x), CHUNK // WINDOW):
        part = x[at : at + CHUNK // WINDOW]
        flat = part.reshape(-1)
        pair = np.zeros(len(flat), np.int32)
        pair[:-1] = flat[:-1].astype(np.int32) * 256 + flat[1:]
        pooled = []
        for w in WIDTHS:
            total = None
            for k, table in enumerate(net[f"t{w}"]):
                index = pair if len(table) == 65536 else flat
                # Places that reach over the end of a window are cut off below, so rolling past it does no harm.
                got = table[np.roll(index, -2 * k) if k else index]
                total = got if total is None else np.add(total, got, out=total)
            kept = total.reshape(len(part), WINDOW, FILTERS)[:, : WINDOW - w + 1]
            pooled.append(np.maximum(kept.max(1), 0))
        z = np.concatenate(pooled, 1) @ net["o"] + net["b"]
        z -= z.max(1, keepdims=True)
        out.append(z - np.log(np.exp(z).sum(1, keepdims=True)))
    return np.concatenate(out) if out else np.zeros((0, len(net["b"])))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict | None:
    """Train on a bounded sample of ``labelled``: about DOCS_PER_LANG documents of each language, chosen by hash of the id.

    Rows with a null or empty text or a null language are left out; None without any row.
    """
    import numpy as np

    rows = labelled.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # one row per language
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, DOCS_PER_LANG / n))])
    luck = F.pmod(F.xxhash64(id_col), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = rows.where(luck < share[F.col(lang_col)]).select(F.col(lang_col), F.col(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, cut = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                w = windows(text.as_py().encode("utf-8", "surrogatepass"))
                for i in sorted({len(w) * k // WINDOWS_PER_DOC for k in range(WINDOWS_PER_DOC)}):
                    langs.append(lang)
                    cut.append(w[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(cut, pa.binary())], names=["lang", "window"])

    got = sample.mapInArrow(run, "lang string, window binary").orderBy(F.xxhash64("window"), "lang").toArrow()
    langs = sorted(set(got.column("lang").to_pylist()))
    x = np.frombuffer(b"".join(got.column("window").to_pylist()), np.uint8).reshape(-1, WINDOW)
    y = np.array([langs.index(s) for s in got.column("lang").to_pylist()])
    return {"langs": langs, "net": train_network(x, y, len(langs))}


def with_language(docs: DataFrame, model: dict | None, text_col: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with two last columns (replaced if there): the predicted language and its mean probability over the text's windows.

    A null text, a text without a letter, and any text where there is no model, is ``und`` with score 0.
    """
    docs = docs.drop(lang, score)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size
    where, names = docs.columns.index(text_col), [*docs.columns, lang, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        model = shared.value
        for batch in batches:
            langs, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            held, n_held = [], 0

            def flush() -> None:
                logs = log_probabilities(model["net"], np.concatenate([w for _, w in held]))
                starts = np.cumsum([0, *[len(w) for _, w in held[:-1]]])
                counts = np.array([len(w) for _, w in held])[:, None]
                mean = np.add.reduceat(logs, starts) / counts
                chance = np.add.reduceat(np.exp(logs), starts) / counts
                for (i, _), best, share in zip(held, mean.argmax(1).tolist(), chance, strict=True):
                    langs[i], scores[i] = model["langs"][best], min(1.0, float(share[best]))
                held.clear()

            for i, text in enumerate(batch.column(where)):
                text = text.as_py()
                if model is None or text is None or not _letter.search(text):
                    continue
                w = windows(text.encode("utf-8", "surrogatepass"))
                held.append((i, w))
                n_held += w.size
                if n_held >= CHUNK:
                    flush()
                    n_held = 0
            if held:
                flush()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=names)

    schema = StructType([*docs.schema.fields, StructField(lang, StringType()), StructField(score, DoubleType())])
    return docs.mapInArrow(run, schema)
