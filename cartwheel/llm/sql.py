"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

# CRC-32 (reflected, polynomial 0xEDB88320) of a text of ASCII characters.
_POLYNOMIAL = 0xEDB88320
_START = 0xFFFFFFFF


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an SQL expression with ASCII characters only; NULL of
    NULL."""
    step = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, {_POLYNOMIAL} * (x & 1)))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ord(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce(list_concat([{_START}::BIGINT], {codes}), lambda c, b: {step}), {_START})"


def merkle_manifest(levels: int, tops: int) -> str:
    """For up to 16 ** levels leaves of a source and 16 ** tops sources."""

    def field(name: str) -> str:
        return f"coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-')"

    head = [field(n) for n in ("doc_id", "source", "lang", "n_chars")]
    altered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""leaves AS (
  SELECT doc_id, source, sha256({' || '.join(head + [field('text')])}) AS leaf,
    CASE WHEN {crc32('doc_id::VARCHAR')} % 5 = 0 THEN sha256({' || '.join(head + [field('altered')])}) END AS given
  FROM (SELECT *, {altered} AS altered FROM documents))""",
             """placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, given NULLS FIRST) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM leaves)""", "a0 AS (SELECT tree, i, n, leaf AS h FROM placed)"]

    def grow(name: str, count: int) -> None:
        for k in range(count):
            parts.append(f"""{name}{k}_runs AS (
  SELECT tree, i // 16 AS i, any_value(n) AS n, list(h ORDER BY i) AS run FROM {name}{k} WHERE n > 1 GROUP BY tree, i // 16)""")
            parts.append(f"{name}{k + 1} AS (SELECT tree, i, (n + 15) // 16 AS n, sha256(array_to_string(run, '')) AS h FROM {name}{k}_runs)")

    def last(name: str, count: int) -> str:
        return " UNION ALL ".join(f"SELECT tree, h FROM {name}{k} WHERE n = 1" for k in range(count + 1))

    grow("a", levels)
    parts.append(f"subroots AS ({last('a', levels)})")
    parts.append("b0 AS (SELECT -1 AS tree, tree AS i, count(*) OVER () AS n, h FROM subroots)")
    grow("b", tops)
    parts.append(f"root AS ({last('b', tops)})")
    parts.append("""c0 AS (
  SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, p.tree, p.i, '' AS proof, coalesce(p.given, p.leaf) AS folded
  FROM placed p JOIN subroots s ON s.tree = p.tree CROSS JOIN root r)""")

    def climb(source: str, result: str, runs: str, on: str, place: str) -> None:
        before, after = f"array_to_string(r.run[:{place} % 16], '')", f"array_to_string(r.run[{place} % 16 + 2:], '')"
        parts.append(f"""{result} AS (
  SELECT c.* REPLACE (CASE WHEN r.run IS NULL THEN c.proof ELSE c.proof || {before} || {after} END AS proof,
    CASE WHEN r.run IS NULL THEN c.folded ELSE sha256({before} || c.folded || {after}) END AS folded, {place} // 16 AS {place[2:]})
  FROM {source} c LEFT JOIN {runs} r ON {on})""")

    for k in range(levels):
        climb(f"c{k}", f"c{k + 1}", f"a{k}_runs", "r.tree = c.tree AND r.i = c.i // 16", "c.i")
    parts.append(f"d0 AS (SELECT * FROM c{levels})")
    for k in range(tops):
        climb(f"d{k}", f"d{k + 1}", f"b{k}_runs", "r.i = c.tree // 16", "c.tree")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM d{tops}"""


# A stretch of six words or more that come again q words later is seen as
# six-word sequences that come again; least run: 12 words and two periods.
PERIODIC_RUNS = f"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {crc32('doc_id::VARCHAR')} AS h FROM documents),
placed AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM split),
docs AS (
  SELECT row_number() OVER () AS d, doc_id, n,
    CASE WHEN h % 10 = 0 AND n > 0 THEN
      list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
    ELSE w END AS w
  FROM placed),
grams AS (
  SELECT d, i, array_to_string(w[i + 1:i + 6], ' ') AS gram
  FROM (SELECT d, w, unnest(range(n - 5)) AS i FROM docs WHERE n >= 12)),
again AS (SELECT x.d, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.d = y.d AND x.gram = y.gram AND x.i < y.i),
stretches AS (
  SELECT d, q, min(i) AS start, count(*) + 5 AS m
  FROM (SELECT *, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS island FROM again)
  GROUP BY d, q, island),
runs AS (SELECT d, start, m + q AS length, min(q) AS period FROM stretches WHERE m >= greatest(12 - q, q) GROUP BY d, start, m + q),
gone AS (SELECT DISTINCT d, i FROM (SELECT d, unnest(range(start + period, start + length)) AS i FROM runs)),
listed AS (
  SELECT d, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS list,
    first({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period) AS best
  FROM runs GROUP BY d),
kept AS (
  SELECT w.d, string_agg(w.word, ' ' ORDER BY w.i) AS kept
  FROM (SELECT d, unnest(w) AS word, unnest(range(n)) AS i FROM docs) w LEFT JOIN gone ON gone.d = w.d AND gone.i = w.i
  WHERE gone.d IS NULL GROUP BY w.d)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
  1000 * best.length // best.period AS exponent_milli, sha256(coalesce(list, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (d) LEFT JOIN kept USING (d)"""

TOP_PRODUCTS = """
WITH points AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS p FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.p, x.p)::BIGINT AS score
  FROM points q JOIN points x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id AND len(x.p) = len(q.p))
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5"""
