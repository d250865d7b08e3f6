"""DuckDB SQL for those queries that SQL can express."""

from recollect.llm.licence_scan import MIN_SHARE, notices, postings
from recollect.llm.licences import PHRASES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 8) AS r(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), counts AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
), base AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
), hosts AS (
  SELECT source, count(*) AS docs, sum(base_failed::INT) AS failed FROM base WHERE source IS NOT NULL GROUP BY 1
), moments AS (
  SELECT avg(failed / docs) AS m, var_pop(failed / docs) AS v, avg(1 / docs) AS noise, avg(docs) AS size FROM hosts
), prior AS (
  SELECT m, CASE WHEN v - m * (1 - m) * noise > 0 AND v - m * (1 - m) * noise < m * (1 - m)
    THEN greatest(m * (1 - m) / (v - m * (1 - m) * noise) - 1, 0) ELSE size END AS w FROM moments
), rates AS (
  SELECT source, (failed + m * w) / (docs + w) AS rate FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  round(rate, 6) AS host_rate, NOT base_failed AND coalesce(rate, 0) <= 0.5 AS kept
FROM base LEFT JOIN rates USING (source)
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_POSTINGS = ", ".join(f"('{w}', {n}, {p}, {i})" for w, n, p, i in postings())
_NOTICES = ", ".join(
    f"({n}, '{label}', {size}, {full}, [{', '.join(repr(p) for p in phrases)}])" for n, label, size, full, phrases in notices()
)
_PHRASES = ", ".join(f"({phrase.split()!r}, '{label}', {len(phrase.split())})" for phrase, label in PHRASES)

_OP6 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents
), w AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d
), phrases(words, label, n) AS (VALUES {_PHRASES}
), places AS (
  SELECT w.doc_id, pos, label FROM w JOIN phrases ON w.word = words[1] JOIN d USING (doc_id)
  WHERE d.w[pos + 1:pos + n] = words
), base AS (
  SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY 1
), index(word, notice, place, weight) AS (VALUES {_POSTINGS}
), known(notice, label, len, total, phrases) AS (VALUES {_NOTICES}
), votes AS (
  SELECT doc_id, notice, pos - place AS start, sum(weight) AS got FROM w JOIN index USING (word) GROUP BY ALL
), regions AS (
  SELECT doc_id, label, got / total AS share, phrases,
    ' ' || array_to_string(d.w[greatest(start, 0) + 1:start + len], ' ') || ' ' AS region
  FROM votes JOIN known USING (notice) JOIN d USING (doc_id) WHERE got >= {MIN_SHARE} * total
), found AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS score FROM regions
  WHERE len(list_filter(phrases, lambda p: NOT contains(region, ' ' || p || ' '))) = 0 GROUP BY 1
)
SELECT doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_OP7 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS len, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT len AS n FROM iw))
), occ AS (
  SELECT doc_id, i, n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.len
), hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM occ, range(0, 10) AS r(k) WHERE k < n GROUP BY 1
), items AS (
  SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM occ GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP10 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), df AS (
  SELECT s, count(*) AS df FROM s GROUP BY 1
), ranked AS (  -- every pair that is linked shares one of the rarest fifth of either set
  SELECT s.doc_id, s.s, n.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY df.df, s.s) AS r
  FROM s JOIN df USING (s) JOIN n USING (doc_id)
), prefix AS (
  SELECT doc_id, s, n FROM ranked WHERE r <= n - ceil(0.8 * n) + 1
), pairs AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb
  FROM prefix a JOIN prefix b ON a.s = b.s AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), linked AS (
  SELECT p.a, p.b FROM pairs p JOIN s x ON x.doc_id = p.a JOIN s y ON y.doc_id = p.b AND y.s = x.s
  GROUP BY p.a, p.b, na, nb HAVING 100 * count(*) >= 80 * (na + nb - count(*))
), edges AS (
  SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a
), comp AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)
"""



def _op11(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Every distance of every round; a distance and its entry are one number, so ties are ordered."""

    def assigned(book: str) -> str:
        return f"""
  SELECT r, p, any_value(x.x) AS x, min({entries} * list_sum(list_transform(list_zip(x.x, b.x),
    lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT + e) AS m
  FROM parts x JOIN {book} b USING (p) GROUP BY r, p"""

    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v, len(embedding) // {parts} AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, p, v[p * n + 1:p * n + n] AS x FROM kept, range({parts}) t(p)
), b0 AS MATERIALIZED (
  SELECT p, r - 1 AS e, x FROM parts WHERE r <= {entries}
)"""]
    for k in range(rounds):
        steps.append(f"""a{k} AS MATERIALIZED ({assigned(f"b{k}")}
), s{k} AS (
  SELECT p, e, i, floor(sum(x) / count(*))::BIGINT AS x
  FROM (SELECT p, m % {entries} AS e, unnest(x) AS x, unnest(range(len(x))) AS i FROM a{k}) GROUP BY p, e, i
), b{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(n.x, b.x) AS x FROM b{k} b LEFT JOIN (SELECT p, e, list(x ORDER BY i) AS x FROM s{k} GROUP BY p, e) n USING (p, e)
)""")
    return ", ".join(steps) + f""", last AS ({assigned(f"b{rounds}")}
), coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', m % {entries}), '' ORDER BY p) AS code, sum(m // {entries})::BIGINT AS error
  FROM last JOIN kept USING (r) GROUP BY r, vec_id, label
), books AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, books
"""


SQL = {
    "op1_host_rules": _OP1,
    "op6_licences": _OP6,
    "op7_decontaminate": _OP7,
    "op10_near_duplicates": _OP10,
    "op11_vector_codes": _op11(),
}
