"""The operators' queries in SQL, where SQL can express them."""

from __future__ import annotations

from cityobs.llm import decontaminate, lines, sharding

_SHARDS = 16
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _network(source: str, number: str) -> str:
    """One pass of the permutation over the rows of ``source``, which also have ``a`` and ``b``."""
    sql = f"(SELECT *, {number} // b AS l0, {number} % b AS r0 FROM {source})"
    for k in range(sharding.ROUNDS):
        value = f"r{k}" if k % 2 == 0 else f"l{k}"
        drawn = f"('0x' || substr(md5('{sharding.SEED}:{k}:' || {value}), 1, 8))::BIGINT"
        left, right = (f"(l{k} + {drawn}) % a", f"r{k}") if k % 2 == 0 else (f"l{k}", f"(r{k} + {drawn}) % b")
        sql = f"(SELECT * EXCLUDE (l{k}, r{k}), {left} AS l{k + 1}, {right} AS r{k + 1} FROM {sql})"
    n = sharding.ROUNDS
    return f"(SELECT * EXCLUDE (l{n}, r{n}), l{n} * b + r{n} AS passed FROM {sql})"


#: Checksum of a text's bytes: the table of 256 remainders, then one step a byte.
_CRC = """
  list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(t))),
      lambda i: ('0x' || substr(hex(encode(t)), 2 * i + 1, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, remainders[(xor(c, x) & 255) + 1]))
"""

_ROWS = f"""
  remainder_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS remainders),
  plain AS (
    SELECT doc_id, coalesce(text, '') AS t, octet_length(encode(coalesce(text, ''))) + 1 AS size FROM documents),
  summed AS (
    SELECT doc_id, size::BIGINT AS size, xor({_CRC}, 4294967295)::BIGINT AS text_crc32 FROM plain, remainder_table),
  numbered AS (
    SELECT *, row_number() OVER (ORDER BY
        substr(md5(coalesce(doc_id::VARCHAR, '') || ':0'), 1, {sharding.BUCKET_DIGITS}),
        doc_id NULLS FIRST, size, text_crc32) - 1 AS row_number,
      count(*) OVER () AS total FROM summed),
  sided AS (
    SELECT *, CASE WHEN root * root < total THEN root + 1 ELSE root END AS a
    FROM (SELECT *, floor(sqrt(total))::BIGINT AS root FROM numbered)),
  domain AS (SELECT * EXCLUDE root, (total + a - 1) // a AS b FROM sided)
"""

FEISTEL_SHARDS = f"""
WITH RECURSIVE {_ROWS},
  walked AS (
    SELECT doc_id, size, text_crc32, row_number, total, a, b, passed FROM {_network("domain", "row_number")}
    UNION ALL
    SELECT doc_id, size, text_crc32, row_number, total, a, b, passed
    FROM {_network("(SELECT doc_id, size, text_crc32, row_number, total, a, b, passed AS was FROM walked WHERE passed >= total)", "was")})
SELECT doc_id, size, text_crc32, 'rows' AS law, (passed % {_SHARDS})::INTEGER AS shard,
  (passed // {_SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard, row_number::BIGINT AS row_number
FROM walked WHERE passed < total
"""

SITE_SPREAD_LINES = f"""
WITH parts AS (
    SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
  each AS (
    SELECT doc_id, source, generate_subscripts(p, 1) AS pos, unnest(p) AS line FROM parts),
  spread AS (
    SELECT trim(line) AS key, min(doc_id) AS first_id FROM each WHERE trim(line) <> ''
    GROUP BY 1 HAVING count(DISTINCT coalesce(source, '')) >= {lines.MIN_SITES}),
  marked AS (
    SELECT e.doc_id, e.pos, e.line, trim(e.line) <> '' AS filled,
      trim(e.line) <> '' AND s.key IS NOT NULL AND e.doc_id <> s.first_id AS gone
    FROM each e LEFT JOIN spread s ON trim(e.line) = s.key),
  joined AS (
    SELECT doc_id, count(*) FILTER (filled) AS n_lines, count(*) FILTER (coalesce(gone, false)) AS n_removed,
      coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT coalesce(gone, false)), '') AS clean
    FROM marked GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed, length(clean)::BIGINT AS clean_chars, sha256(clean) AS clean_sha256 FROM joined
"""

WINDOW_HITS = rf"""
WITH items AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item,
      regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
  starts AS (
    SELECT item, w, unnest(range(1, greatest(len(w) - {decontaminate.WIDTH - 1}, 1) + 1)) AS s FROM items WHERE len(w) > 0),
  windows AS (
    SELECT DISTINCT item, array_to_string(w[s : s + {decontaminate.WIDTH - 1}], ' ') AS gram,
      len(w[s : s + {decontaminate.WIDTH - 1}]) AS size FROM starts),
  docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
  grams AS (
    SELECT doc_id, size, s, array_to_string(w[s : s + size - 1], ' ') AS gram
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM docs, (SELECT DISTINCT size FROM windows))),
  found AS (
    SELECT g.doc_id, g.s, g.size, w.item FROM grams g JOIN windows w ON g.gram = w.gram AND g.size = w.size),
  hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM found) GROUP BY 1),
  owners AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(o.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(o.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN owners o USING (doc_id)
"""

CHOSEN_PATH_JOIN = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
  texts AS (SELECT min(doc_id) AS rep, w, greatest(len(w) - 4, 1) AS last FROM docs WHERE len(w) > 0 GROUP BY w),
  shingles AS (
    SELECT DISTINCT rep, array_to_string(w[s : s + 4], ' ') AS g FROM (SELECT rep, w, unnest(range(1, last + 1)) AS s FROM texts)),
  sizes AS (SELECT rep, count(*) AS n FROM shingles GROUP BY 1),
  common AS (
    SELECT x.rep AS a, y.rep AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.g = y.g AND x.rep <> y.rep GROUP BY ALL),
  links AS (
    SELECT a, b FROM common JOIN sizes p ON p.rep = a JOIN sizes q ON q.rep = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
  reached AS (
    SELECT rep AS id, rep AS other FROM texts
    UNION
    SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other),
  classes AS (SELECT id, min(other) AS component FROM reached GROUP BY 1)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(c.component, d.doc_id) AS component_id,
  coalesce(c.component, d.doc_id) = d.doc_id AS kept
FROM docs d LEFT JOIN texts t ON d.w = t.w LEFT JOIN sizes s ON s.rep = t.rep LEFT JOIN classes c ON c.id = t.rep
"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

HYBRID_SEARCH = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERMS}') AS w FROM documents),
  totals AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs WHERE len(w) > 0),
  postings AS (
    SELECT doc_id, n, term, count(*)::BIGINT AS tf
    FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM docs) GROUP BY doc_id, n, term),
  weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
    FROM postings, totals GROUP BY term, n_docs),
  asked AS (
    SELECT item_id, term, count(*)::BIGINT AS times
    FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERMS}')) AS term FROM benchmark) GROUP BY item_id, term),
  scored AS (
    SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id),
  placed AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""


def _features(table: str, owner: str) -> str:
    """Every run of one to three words of every text, with its place."""
    words = f"(SELECT {owner} AS owner, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM {table})"
    one = "SELECT owner, array_to_string(w[s : s + {n} - 1], ' ') AS t FROM (SELECT owner, w, unnest(range(1, len(w) - {n} + 2)) AS s FROM {words})"
    return " UNION ALL ".join(one.format(n=n, words=words) for n in (1, 2, 3))


IMPORTANCE_RESAMPLING = f"""
WITH remainder_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS remainders),
  corpus AS ({_features("documents", "doc_id")}),
  target AS ({_features("benchmark", "item_id")}),
  buckets AS (
    SELECT t, xor({_CRC}, 4294967295)::BIGINT % 10000 AS bucket
    FROM (SELECT t FROM corpus UNION SELECT t FROM target), remainder_table),
  corpus_counts AS (SELECT bucket, count(*)::DOUBLE AS n FROM corpus JOIN buckets USING (t) GROUP BY 1),
  target_counts AS (SELECT bucket, count(*)::DOUBLE AS n FROM target JOIN buckets USING (t) GROUP BY 1),
  gains AS (
    SELECT b.bucket, floor(1000 * ln(
        ((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM corpus) + 10000)::DOUBLE)
        / ((coalesce(c.n, 0) + 1) * ((SELECT count(*) FROM target) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM (SELECT DISTINCT bucket FROM buckets) b
    LEFT JOIN corpus_counts c USING (bucket) LEFT JOIN target_counts t USING (bucket)),
  summed AS (
    SELECT owner AS doc_id, count(*)::BIGINT AS n_features, sum(gain)::BIGINT AS weight
    FROM corpus JOIN buckets USING (t) JOIN gains USING (bucket) GROUP BY 1),
  noisy AS (
    SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
      len(regexp_extract_all({_LOWER}, '{_WORDS}')) AS n_words,
      (('0x' || substr(sha256('42:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE AS share
    FROM documents d LEFT JOIN summed s ON s.doc_id = d.doc_id),
  scored AS (
    SELECT doc_id, n_features, weight, n_words >= 20 AS fits,
      (weight + floor(-1000 * ln(-ln(share)))::BIGINT)::BIGINT AS score FROM noisy),
  placed AS (
    SELECT *, row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) AS place,
      count(*) OVER (PARTITION BY fits) AS total FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN fits AND place <= (5 * total) // 100 THEN place END::BIGINT AS rank
FROM placed
"""

ORACLES = {
    "op1_feistel_shards": FEISTEL_SHARDS,
    "op6_site_spread_lines": SITE_SPREAD_LINES,
    "op7_chosen_path_join": CHOSEN_PATH_JOIN,
    "op12_hybrid_search": HYBRID_SEARCH,
    "op13_importance_resampling": IMPORTANCE_RESAMPLING,
    "op9_window_hits": WINDOW_HITS,
}
