"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from tributary.llm import mixing, quality

_SIZE = r"CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)"

OP2 = rf"""
WITH sized AS (SELECT row_number() OVER () AS row_id, doc_id, source, {_SIZE} AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS HUGEINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, 3 * source_size AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS source_rank, sum(source_size) OVER () AS total FROM src),
level AS (
  SELECT *, total - coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM ranked),
capped AS (SELECT *, left_over * weight >= cap * weights AS is_capped FROM level),
share AS (
  SELECT *, total - coalesce(sum(CASE WHEN is_capped THEN cap END) OVER (), 0) AS free, sum(CASE WHEN NOT is_capped THEN weight END) OVER () AS open_weights FROM capped),
goal AS (
  SELECT source, source_rank, source_size, CASE WHEN is_capped THEN CAST(cap AS DOUBLE) ELSE CAST(weight * free AS DOUBLE) / CAST(open_weights AS DOUBLE) END AS target FROM share),
queue AS (
  SELECT row_id, doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, source_rank, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS k,
         CAST(coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16), doc_id NULLS FIRST, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
copies AS (SELECT *, e * source_size + before AS start FROM queue, range(0, 3) r(e) WHERE size > 0 AND e * source_size + before < target),
packets AS (
  SELECT row_id, doc_id, size, source_rank, k, e, target, start, f, CASE WHEN start + size > target THEN least({mixing.PART}, size - f) ELSE size END AS length
  FROM copies, LATERAL (SELECT unnest(range(0, CASE WHEN start + size > target THEN size ELSE 1 END, {mixing.PART})) AS f)),
sent AS (
  SELECT row_id, length, coalesce(sum(length) OVER (ORDER BY CAST(start + f + length AS DOUBLE) / target, source_rank, e, k, doc_id NULLS FIRST, size, f
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM packets),
cut AS (SELECT row_id, sum(greatest(0, least(length, (SELECT sum(size) FROM sized) - place))) AS taken FROM sent GROUP BY row_id)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM queue LEFT JOIN cut USING (row_id)
"""

OP1 = """
WITH v AS (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.row_id, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.row_id <> c.row_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY row_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_WORDS = r"'[^\x20\x09-\x0D]+'"
_Q = {k: getattr(quality, k).replace("'", "''") for k in ("SENTENCE_END", "UNSPACED", "SYMBOL", "MARKS", "BAR")}

OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT row_id, doc_id, text, regexp_extract_all(text, {_WORDS}) AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {_WORDS})) AS lines FROM d),
grams AS (SELECT row_id, i, array_to_string(words[i:i + 4], ' ') AS gram FROM w, LATERAL (SELECT unnest(range(1, len(words) - 3)) AS i)),
twins AS (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, gram) AS n FROM grams),
covered AS (SELECT row_id, count(DISTINCT i + k) AS n FROM twins, range(0, 5) AS o(k) WHERE n >= 2 GROUP BY row_id),
good AS (
  SELECT row_id, list_filter(lines, lambda x: NOT (
      (len(regexp_extract_all(x, {_WORDS})) < {quality.SHORT_LINE} AND NOT regexp_matches(right(rtrim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12)), {quality.END_CHARS}), '{_Q["SENTENCE_END"]}') AND len(regexp_extract_all(x, '{_Q["UNSPACED"]}')) < {quality.SHORT_UNSPACED})
      OR len(regexp_extract_all(x, '{_Q["MARKS"]}')) > len(regexp_extract_all(x, {_WORDS})) * {quality.MOST_MARKS}
      OR len(regexp_extract_all(x, '{_Q["BAR"]}')) > len(regexp_extract_all(x, {_WORDS})) * {quality.MOST_BARS}
      OR regexp_matches(lower(x), '{"|".join(quality.BOILERPLATE)}'))) AS good FROM w),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '{_Q["SYMBOL"]}')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         length(array_to_string(good, '')) AS left_chars, length(array_to_string(lines, '')) AS all_chars
  FROM w JOIN good USING (row_id) LEFT JOIN covered c USING (row_id)),
b AS (SELECT *, n_words < {quality.LEAST_WORDS} OR n_repeat_words * 100 > n_words * {quality.MOST_REPEATED} AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND all_chars > 0 AND CAST(left_chars AS DOUBLE) / CAST(all_chars AS DOUBLE) >= {quality.LEAST_LEFT} AS kept
FROM b
"""

#: crc32 of hex text h, a byte at a time over the table t of its polynomial.
_CRC_TABLE = """steps(k, i, v) AS (SELECT 0, i, i FROM range(0, 256) r(i)
    UNION ALL SELECT k + 1, i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8)"""
_CRC = """xor(list_reduce(list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"""


def _hilbert_steps(bits: int, dims: int) -> tuple[str, str]:
    """Common table expressions from ``cells`` (x0, x1, ...) to the curve's columns, one step each, and the last one's name."""
    steps, last = [], "cells"

    def step(columns: dict[str, str]) -> None:
        nonlocal last
        name = f"h{len(steps)}"
        steps.append(f"{name} AS (SELECT * REPLACE ({', '.join(f'{v} AS {k}' for k, v in columns.items())}) FROM {last})")
        last = name

    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for k in range(dims):
            up, swap = f"(x{k} >> {level}) & 1 = 1", f"xor(x0, x{k}) & {low}"
            moved = {"x0": f"xor(x0, CASE WHEN {up} THEN {low} ELSE {swap} END)"}
            step(moved | ({f"x{k}": f"xor(x{k}, CASE WHEN {up} THEN 0 ELSE {swap} END)"} if k else {}))
    for k in range(1, dims):
        step({f"x{k}": f"xor(x{k}, x{k - 1})"})
    flip = "0"
    for level in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN (x{dims - 1} >> {level}) & 1 = 1 THEN {(1 << level) - 1} ELSE 0 END)"
    step({f"x{k}": f"xor(x{k}, {flip})" for k in range(dims)})
    places = [(level, k) for level in range(bits - 1, -1, -1) for k in range(dims)]
    index = " + ".join(f"(((x{k} >> {level}) & 1) << {len(places) - 1 - i})" for i, (level, k) in enumerate(places))
    return ",\n".join(steps), f"SELECT doc_id, size, text_crc32, CAST({index} AS BIGINT) AS hilbert FROM {last}"


_STEPS, _CURVE = _hilbert_steps(5, 4)
_CELL = "(SELECT {0} AS v, floor((row_number() OVER (ORDER BY {0} NULLS LAST) - 1) * 32 / count(*) OVER ()) AS cell FROM (SELECT DISTINCT {0} FROM documents))"
OP8 = f"""
WITH RECURSIVE {_CRC_TABLE},
meta AS (SELECT doc_id, lang, source, octet_length(encode(coalesce(text, ''))) + 8 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
ends AS (SELECT min(doc_id) AS low, max(doc_id) AS high, count(*) AS n FROM documents),
cells AS (
  SELECT doc_id, size, CASE WHEN h = '' THEN 0 ELSE {_CRC} END AS text_crc32,
         CAST(l.cell AS BIGINT) AS x0, CAST(s.cell AS BIGINT) AS x1, least(length(bin(size)) - 1, 31) AS x2,
         coalesce(least(CAST(floor((CAST(doc_id AS DOUBLE) - CAST(low AS DOUBLE)) / (CAST(high AS DOUBLE) - CAST(low AS DOUBLE) + 1) * 32) AS BIGINT), 31), 0) AS x3
  FROM meta JOIN {_CELL.format("lang")} l ON lang IS NOT DISTINCT FROM l.v JOIN {_CELL.format("source")} s ON source IS NOT DISTINCT FROM s.v, tab, ends),
{_STEPS},
curve AS ({_CURVE}),
placed AS (SELECT *, row_number() OVER (ORDER BY hilbert, doc_id NULLS FIRST, size, text_crc32) - 1 AS rank FROM curve)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(rank * 24 // n AS INTEGER) AS shard,
       rank - ((rank * 24 // n) * n + 23) // 24 AS slot, CAST(NULL AS INTEGER) AS grown_shard, hilbert
FROM placed, ends
"""

SQL: dict[str, str] = {"op1_topk": OP1, "op2_mixing": OP2, "op6_quality": OP6, "op8_hilbert": OP8}
