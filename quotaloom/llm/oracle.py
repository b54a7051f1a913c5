"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
), g AS (
  SELECT doc_id, content, count(*) OVER (PARTITION BY content) AS group_size,
         first_value(doc_id) OVER (PARTITION BY content ORDER BY n DESC, doc_id) AS keep_id
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM g
"""

# Shares in closed form: source i is capped if the level that the sources of later caps still need exceeds its own.
SOURCE_MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight FROM s
), o AS (
  SELECT *, coalesce(sum(3 * source_size) OVER before, 0) AS capped, coalesce(sum(weight) OVER before, 0) AS capped_weight,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
         row_number() OVER (ORDER BY 3 * source_size / weight, encode(source) NULLS LAST) AS k
  FROM w
  WINDOW before AS (ORDER BY 3 * source_size / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT min(k) AS k FROM o WHERE 3 * source_size * (all_weight - capped_weight) > (total - capped) * weight
), t AS (
  SELECT source, source_size, CASE WHEN f.k IS NULL OR o.k < f.k THEN 3.0::DOUBLE * source_size
    ELSE ((SELECT (total - capped)::DOUBLE / (all_weight - capped_weight)::DOUBLE FROM o x WHERE x.k = f.k)) * weight END AS target
  FROM o CROSS JOIN f
), p AS (
  SELECT doc_id, size, d.source, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       (size * CASE WHEN size = 0 THEN 0 ELSE (place < round_even(target, 0))::INT + (place + source_size < round_even(target, 0))::INT
                                         + (place + 2 * source_size < round_even(target, 0))::INT END)::BIGINT AS taken
FROM p
"""



def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Plain Lloyd rounds: every part against every entry, each round. ``x``: a part's integers; ``b<r>``: the codebooks after r rounds."""
    nearest = """
  SELECT vec_id, label, part, x, arg_min(entry, d * 1000::HUGEINT + entry) AS entry, min(d) AS d
  FROM (SELECT v.vec_id, v.label, v.part, v.x, b.entry,
               list_sum(list_transform(list_zip(v.x, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS d
        FROM v JOIN b{r} b ON v.part = b.part) pairs
  GROUP BY vec_id, label, part, x"""
    ctes = [f"""k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS whole
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS MATERIALIZED (
  SELECT vec_id, label, part, whole[part * (len(whole) // {parts}) + 1 : (part + 1) * (len(whole) // {parts})] AS x
  FROM k, range({parts}) p(part)
), b0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS y
  FROM v QUALIFY entry < {entries}
)"""]
    for r in range(rounds):
        ctes.append(f"""a{r} AS MATERIALIZED ({nearest.format(r=r)}
), s{r} AS (
  SELECT part, entry, pos, floor_div AS y FROM (
    SELECT part, entry, pos, (sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
    FROM (SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS pos FROM a{r}) each GROUP BY part, entry, pos)
), b{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.y, b.y) AS y
  FROM b{r} b LEFT JOIN (SELECT part, entry, list(y::BIGINT ORDER BY pos) AS y FROM s{r} GROUP BY part, entry) m
    ON b.part = m.part AND b.entry = m.entry
)""")
    return f"""
WITH {", ".join(ctes)}, f AS ({nearest.format(r=rounds)}
), c AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry::BIGINT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM f GROUP BY vec_id, label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM c"""


ORACLE: dict[str, str] = {"op3_exact_dedup": EXACT_DEDUP, "op6_source_mixing": SOURCE_MIXING, "op12_vector_codes": _vector_codes()}
