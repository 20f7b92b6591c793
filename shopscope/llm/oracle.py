"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations


def _scatter(x: str) -> str:
    return f"(((({x}) % 2147483647) * 48271 % 2147483647 + 1) * 69621 % 2147483647)"


def _mixing() -> str:
    """Targets by water filling, quotas, shard draws, slots through permutations, words taken per document."""
    salt_r, salt_bit = _scatter(_scatter("salt * 64 + r")), _scatter("salt * 64 + r + 32")
    other = f"(({salt_r} + blocks - x) % blocks)"
    bit = f"(({_scatter(_scatter(f'greatest(x, {other})') + ' + ' + salt_bit)} // 65536) % 2)"
    permuted = f"list_reduce(range(0, 20), lambda x, r: CASE WHEN {bit} = 1 THEN {other} ELSE x END, pos)"
    number = f"({_scatter(_scatter('shard') + ' + i')} * 2147483647 + {_scatter(_scatter('shard + 7') + ' + i')}) % (draws * slots)"
    bucket = f"({_scatter('((coalesce(doc_id, 0) % 2147483647) + 2147483647) % 2147483647')} % 4096)"
    return f"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents
), sizes AS (
  SELECT key, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY key
), weighted AS (
  SELECT key, source_size, row_number() OVER (ORDER BY key) AS turn, 2 * source_size AS cap,
         1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT) AS want
  FROM sizes
), w AS (
  SELECT *, CASE (turn - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM weighted
), filling AS (
  SELECT *, CAST(coalesce(sum(cap) OVER (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS filled,
         CAST(sum(weight) OVER (ORDER BY cap / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS w_left
  FROM w
), capped AS (
  SELECT *, cap * w_left <= weight * (want - filled) AS is_full FROM filling
), rest AS (
  SELECT CAST(coalesce(sum(cap) FILTER (WHERE is_full), 0) AS BIGINT) AS spent, CAST(sum(weight) FILTER (WHERE NOT is_full) AS BIGINT) AS w_open FROM capped
), targets AS (
  SELECT key, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE weight * ((want - (SELECT spent FROM rest)) / (SELECT w_open FROM rest)) END AS target
  FROM capped
), q AS (
  SELECT key, CAST(ceil(source_size / 128) AS BIGINT) AS blocks,
         CAST(round(target * CAST(ceil(source_size / 128) AS BIGINT) / source_size) AS BIGINT) AS quota, row_number() OVER (ORDER BY key) AS id
  FROM targets WHERE source_size > 0
), total AS (SELECT CAST(sum(quota) AS BIGINT) AS slots FROM q),
shards AS (
  SELECT q.*, slots, CAST(ceil(slots / 4096) AS BIGINT) - 1 AS last, unnest(range(0, CAST(ceil(slots / 4096) AS BIGINT))) AS shard FROM q, total WHERE slots > 0
), room AS (SELECT *, least(4096, slots - shard * 4096) AS room FROM shards),
parts AS (SELECT *, (quota * room) // slots AS whole, (quota * room) % slots AS part FROM room),
draws AS (
  SELECT *, room - CAST(sum(whole) OVER (PARTITION BY shard) AS BIGINT) AS draws,
         CAST(coalesce(sum(part) OVER (PARTITION BY shard ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS low
  FROM parts
), drawn AS (
  SELECT *, whole + CASE WHEN draws > 0 THEN len(list_filter(list_transform(range(1, draws + 1), lambda i: {number}), lambda u: u >= low AND u < low + part)) ELSE 0 END AS n
  FROM draws
), cumulated AS (
  SELECT *, CAST(coalesce(sum(n) OVER (PARTITION BY key ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first FROM drawn
), closed AS (
  SELECT key, id, blocks, first, CASE WHEN shard = last THEN quota ELSE least(quota, first + n) END AS stop FROM cumulated
), slot AS (
  SELECT key, id, blocks, unnest(range(first, stop)) AS slot FROM closed WHERE first < stop
), placed AS (SELECT key, blocks, slot % blocks AS pos, id * 4 + slot // blocks AS salt FROM slot),
uses AS (SELECT key, {permuted} AS block, count(*) AS uses FROM placed GROUP BY ALL),
starts AS (
  SELECT key, doc_id, size, CAST(sum(size) OVER (PARTITION BY key ORDER BY {bucket}, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM d WHERE size > 0
), cut AS (
  SELECT *, unnest(range(start // 128, (start + size - 1) // 128 + 1)) AS block FROM starts
), taken AS (
  SELECT c.key, c.start, c.doc_id, c.size,
         CAST(sum((least(c.start + c.size, (c.block + 1) * 128) - greatest(c.start, c.block * 128)) * coalesce(u.uses, 0)) AS BIGINT) AS taken
  FROM cut c LEFT JOIN uses u ON c.key = u.key AND c.block = u.block GROUP BY ALL
), everything AS (
  SELECT key, doc_id, size, taken FROM taken UNION ALL SELECT key, doc_id, size, 0 FROM d WHERE size = 0
)
SELECT e.doc_id, e.size, t.source_size, t.target, e.taken, CASE WHEN e.key LIKE '0%' THEN substr(e.key, 2) END AS source
FROM everything e JOIN targets t ON e.key = t.key
"""


# Both searches below end when a round reaches nothing new: UNION keeps distinct rows only.
_NGRAMS = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reached r ON r.x = d.doc_id GROUP BY d.doc_id
"""

_REPEATS = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS content
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w WHERE len(words) >= 35)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY content) AS n FROM windows) WHERE n > 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS at_word FROM again),
each AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS at_word FROM w WHERE len(words) > 0
), kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.at_word) AS text, count(*) AS n
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.at_word = g.at_word GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(len(w.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), u AS (SELECT vec_id, x, sqrt(list_dot_product(x, x)) AS n FROM v),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.95
), reached AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.x = e.vec_id) AS n_links, min(r.y) AS component_id, e.vec_id = min(r.y) AS kept
FROM embeddings e JOIN reached r ON r.x = e.vec_id GROUP BY e.vec_id
"""

def _codes() -> str:
    """Two rounds of nearest entries (distance, then index, in one number) and floored means; codes, errors."""
    steps = ["""v AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
)""", """p AS (
  SELECT vec_id, part, x[part * w + 1:(part + 1) * w] AS x FROM (SELECT vec_id, x, len(x) // 16 AS w, unnest(range(16)) AS part FROM v)
)""", """c0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x FROM p JOIN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 64) USING (vec_id)
)"""]
    for r in range(3):
        steps.append(f"""a{r} AS (
  SELECT p.vec_id, p.part, any_value(p.x) AS x, min(CAST(list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i]))) AS BIGINT) * 64 + c.e) AS k
  FROM p JOIN c{r} c ON p.part = c.part GROUP BY p.vec_id, p.part
)""")
        if r < 2:
            steps.append(f"""m{r} AS (
  SELECT part, k % 64 AS e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM (SELECT part, k, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY ALL
)""")
            steps.append(f"""c{r + 1} AS (
  SELECT c.part, c.e, coalesce(m.x, c.x) AS x
  FROM c{r} c LEFT JOIN (SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM m{r} GROUP BY part, e) m ON m.part = c.part AND m.e = c.e
)""")
    steps.append("""coded AS (
  SELECT vec_id, string_agg(lower(printf('%02x', CAST(k % 64 AS INTEGER))), '' ORDER BY part) AS code, CAST(sum(k // 64) AS BIGINT) AS error FROM a2 GROUP BY vec_id
)""")
    steps.append("""books AS (
  SELECT sha256(string_agg(CAST(value AS VARCHAR), ',' ORDER BY part, e, i)) AS codebooks_sha256
  FROM (SELECT part, e, unnest(x) AS value, generate_subscripts(x, 1) AS i FROM c2)
)""")
    return "WITH " + ", ".join(steps) + """
SELECT v.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (vec_id), books
"""


# crc32 of a text's bytes, one byte after another, with the table that the polynomial gives.
_RESAMPLING = """
WITH RECURSIVE steps AS (
  SELECT range AS byte, CAST(range AS BIGINT) AS c, 0 AS k FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8
), crc AS (SELECT list(c ORDER BY byte) AS t FROM steps WHERE k = 8),
w AS (
  SELECT 'd' AS part, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark
), runs AS (
  SELECT part, id, array_to_string(words[i:i + k - 1], ' ') AS feature
  FROM (SELECT part, id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS r(k) WHERE len(words) >= k)
), counted AS (SELECT part, id, feature, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (
  SELECT feature, CAST(concat('0x', substr(x, 2 * i + 1, 2)) AS BIGINT) AS b, i, length(x) // 2 AS n
  FROM (SELECT feature, hex(encode(feature)) AS x, unnest(range(length(hex(encode(feature))) // 2)) AS i FROM (SELECT DISTINCT feature FROM counted))
), hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295, list(b ORDER BY i)), lambda c, x: xor(c // 256, t[CAST(xor(c % 256, x) AS BIGINT) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, crc GROUP BY feature, t
), per AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE part = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE part = 'b'), 0) AS t
  FROM counted JOIN hashed USING (feature) GROUP BY bucket
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln((t::DOUBLE + 1) * ((SELECT sum(s) FROM per)::DOUBLE + 10000) / ((s::DOUBLE + 1) * ((SELECT sum(t) FROM per)::DOUBLE + 10000)))) AS BIGINT) AS g FROM per
), weighed AS (
  SELECT id, sum(n) AS n_features, sum(n * g) AS weight FROM counted JOIN hashed USING (feature) JOIN gain USING (bucket) WHERE part = 'd' GROUP BY id
), scored AS (
  SELECT w.id AS doc_id, len(w.words) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(floor(-1000 * ln(-ln((CAST(concat('0x', substr(sha256(concat('42:', w.id)), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS noise
  FROM w LEFT JOIN weighed x ON x.id = w.id WHERE w.part = 'd'
), ranked AS (
  SELECT doc_id, n_features, weight, weight + noise AS score, n_words,
         row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank FROM ranked
"""

_PHRASES = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS content
  FROM (SELECT item_id, words, least(len(words), 10) AS n, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)
), runs AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS content
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)
), found AS (SELECT r.doc_id, r.i, r.n, w.item_id FROM runs r JOIN windows w ON r.n = w.n AND r.content = w.content),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at_word FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN items i ON i.doc_id = d.doc_id
"""

ORACLE: dict[str, str] = {
    "op2_ngram_jaccard_join": _NGRAMS,
    "op6_recompression": _REPEATS,
    "op9_sorted_projection_passes": _VECTORS,
    "op10_source_mixing": _mixing(),
    "op11_vector_codes": _codes(),
    "op12_importance_resampling": _RESAMPLING,
    "op13_phrase_index": _PHRASES,
}
