"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

from titlelens.llm.common import ALNUM_WORD, SPACE_WORD
from titlelens.llm.quality import FLAT_PRIOR, HOST_RATE, LEAST_PRIOR, RULES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def quality() -> str:
    """Words by position, windows as rows, then the rules by host with the same prior."""
    sums = ", ".join(f"sum(CAST(({rule}) AS INT)) / count(*) AS rate_{r}, sum(CAST(({rule}) AS INT)) AS failed_{r}" for r, rule in RULES.items())
    prior = ", ".join(f"avg(rate_{r}) AS m_{r}, var_pop(rate_{r}) AS v_{r}" for r in RULES)
    # a beta distribution with mean m and variance v has parameters that sum to m (1 - m) / v - 1
    weight = {r: f"if(v_{r} = 0, {FLAT_PRIOR}, greatest({LEAST_PRIOR}, m_{r} * (1 - m_{r}) / v_{r} - 1))" for r in RULES}
    flags = ", ".join(f"(failed_{r} + m_{r} * ({w})) / (n + ({w})) > {HOST_RATE} AS flag_{r}" for r, w in weight.items())
    fails = " OR ".join(f"(({rule}) AND coalesce(flag_{r}, false))" for r, rule in RULES.items())
    return f"""
WITH split AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{SPACE_WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{SPACE_WORD}')) AS l
  FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM places),
repeated AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM windows WHERE n > 1) GROUP BY doc_id),
measured AS (
  SELECT split.doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN repeated ON split.doc_id = repeated.doc_id),
hosts AS (SELECT source AS host, count(*) AS n, {sums} FROM measured WHERE source IS NOT NULL GROUP BY source),
prior AS (SELECT {prior} FROM hosts),
verdicts AS (SELECT host, {flags} FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (({RULES["short"]}) OR ({RULES["repeats"]})) AS base_failed,
       NOT (({RULES["short"]}) OR ({RULES["repeats"]})) AND NOT ({fails}) AS kept
FROM measured LEFT JOIN verdicts ON source = host"""


def repeats(size: int = 50) -> str:
    return f"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACE_WORD}') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - {size - 2})) AS i FROM split WHERE len(w) >= {size}),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {size - 1}], ' ')) AS h FROM places),
owners AS (SELECT h, min(doc_id) AS owner FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {size})) AS k
  FROM windows JOIN owners USING (h) WHERE owner < doc_id),
removed AS (SELECT doc_id, list(k) AS ks, count(*) AS n FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM split),
kept AS (
  SELECT words.doc_id, string_agg(x, ' ' ORDER BY words.k) AS s FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.k = gone.k
  WHERE gone.k IS NULL GROUP BY words.doc_id)
SELECT split.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM split LEFT JOIN removed ON split.doc_id = removed.doc_id LEFT JOIN kept ON split.doc_id = kept.doc_id"""


def similar(n: int = 3, percent: int = 90) -> str:
    """All pairs of classes by their common shingles, then all classes that links reach."""
    following = ", ".join(f"lead(x, {k}) OVER place" for k in range(1, n))
    return f"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{SPACE_WORD}') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM split),
runs AS (SELECT doc_id, k, concat_ws(' ', x, {following}) AS x, lead(x, {n - 1}) OVER place IS NOT NULL AS whole FROM words WINDOW place AS (PARTITION BY doc_id ORDER BY k)),
sets AS (SELECT doc_id, list_sort(list(DISTINCT x)) AS s FROM runs WHERE whole OR k = 1 GROUP BY doc_id),
classes AS (SELECT min(doc_id) AS class_id, s, len(s) AS size, count(*) AS members FROM sets GROUP BY s),
shingles AS (SELECT class_id, size, unnest(s) AS x FROM classes),
pairs AS (
  SELECT a.class_id AS a, b.class_id AS b FROM shingles AS a JOIN shingles AS b
  ON a.x = b.x AND a.class_id < b.class_id AND 100 * least(a.size, b.size) >= {percent} * greatest(a.size, b.size)
  GROUP BY a.class_id, b.class_id, a.size, b.size HAVING 100 * count(*) >= {percent} * (a.size + b.size - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reached AS (
  SELECT class_id, class_id AS other FROM classes
  UNION
  SELECT reached.class_id, links.b FROM reached JOIN links ON other = links.a),
groups AS (SELECT class_id, min(other) AS component_id FROM reached GROUP BY class_id),
partners AS (SELECT a, sum(members) AS n FROM links JOIN classes ON b = class_id GROUP BY a)
SELECT split.doc_id, coalesce(len(sets.s), 0)::BIGINT AS n_shingles, coalesce(component_id, split.doc_id) AS component_id, class_id,
       (coalesce(members - 1, 0) + coalesce(n, 0))::BIGINT AS n_links
FROM split LEFT JOIN sets ON split.doc_id = sets.doc_id LEFT JOIN classes ON sets.s = classes.s LEFT JOIN groups USING (class_id) LEFT JOIN partners ON a = class_id"""


def line_runs(min_words: int = 10) -> str:
    """Repeated runs, one line longer at each step, until none repeats."""
    return f"""
WITH RECURSIVE split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
numbered AS (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS k FROM split),
lines AS (
  SELECT doc_id, k, x, row_number() OVER (ORDER BY doc_id, k) AS place, len(regexp_extract_all(x, '{SPACE_WORD}')) AS words FROM numbered),
runs AS (
  SELECT 1 AS width, doc_id, k, place, words, sha256(x) AS run, min(place) OVER (PARTITION BY x) AS first_place
  FROM lines QUALIFY count(*) OVER (PARTITION BY x) > 1
  UNION ALL
  SELECT width + 1, doc_id, k, place, words, run, min(place) OVER (PARTITION BY run)
  FROM (SELECT r.width, r.doc_id, r.k, r.place, r.words + l.words AS words, sha256(r.run || sha256(l.x)) AS run
        FROM runs AS r JOIN lines AS l ON l.doc_id = r.doc_id AND l.k = r.k + r.width) AS longer
  QUALIFY count(*) OVER (PARTITION BY run) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + width)) AS k FROM runs WHERE first_place < place AND words >= {min_words}),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, chr(10) ORDER BY k) AS s FROM lines ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT split.doc_id, len(l)::BIGINT AS n_lines, coalesce(n, 1)::BIGINT AS n_lines_left, length(coalesce(s, ''))::BIGINT AS n_chars_left,
       sha256(coalesce(s, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)"""


def contamination() -> str:
    return f"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{ALNUM_WORD}') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({_LOWER}, '{ALNUM_WORD}') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, n FROM doc_windows JOIN item_windows USING (n, x)),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT docs.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words ON docs.doc_id = hit_words.doc_id LEFT JOIN found ON docs.doc_id = found.doc_id"""


def merkle(fan: int = 16) -> str:
    """Trees by levels, then every document's way up: siblings level by level, and the fold of what is found."""
    field = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR)))::VARCHAR || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join([*(field(c) for c in ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # crc32 of the decimal id, bit by bit
    bits = "list_reduce([4294967295::BIGINT] || range(8 * length(k)), lambda c, i: xor(((CASE WHEN i % 8 = 0 THEN xor(c, ascii(k[(i // 8 + 1)::INT])) ELSE c END) >> 1), 3988292384 * ((CASE WHEN i % 8 = 0 THEN xor(c, ascii(k[(i // 8 + 1)::INT])) ELSE c END) & 1)))"
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, {leaf("text")} AS leaf, {leaf(low)} AS other, CAST(doc_id AS VARCHAR) AS k FROM documents),
marked AS (SELECT doc_id, source, leaf, CASE WHEN xor({bits}, 4294967295) % 5 = 0 THEN other ELSE leaf END AS found FROM docs),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS total FROM marked),
climb AS (
  SELECT source, 0 AS level, idx, total, leaf AS digest FROM placed
  UNION ALL
  SELECT source, level + 1, idx // {fan}, any_value((total + {fan - 1}) // {fan}), sha256(string_agg(digest, '' ORDER BY idx)) FROM climb WHERE total > 1 GROUP BY source, level, idx // {fan}),
subroots AS (
  SELECT source, level AS height, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS seat, count(*) OVER () AS total FROM climb WHERE total = 1),
above AS (
  SELECT 0 AS level, seat AS idx, total, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // {fan}, any_value((total + {fan - 1}) // {fan}), sha256(string_agg(digest, '' ORDER BY idx)) FROM above WHERE total > 1 GROUP BY level, idx // {fan}),
top AS (SELECT digest AS root, level AS height FROM above WHERE total = 1),
nodes AS (
  SELECT s.seat AS tree, c.level, c.idx, c.digest FROM climb AS c JOIN subroots AS s ON c.source IS NOT DISTINCT FROM s.source WHERE c.total > 1
  UNION ALL
  SELECT -1, level, idx, digest FROM above WHERE total > 1),
runs AS (SELECT tree, level, idx // {fan} AS run, list(digest ORDER BY idx) AS kids FROM nodes GROUP BY tree, level, idx // {fan}),
leaves AS (
  SELECT row_number() OVER () AS no, p.doc_id, p.leaf, p.found, p.idx, s.seat, s.subroot, s.height, top.root, top.height AS rest
  FROM placed AS p JOIN subroots AS s ON p.source IS NOT DISTINCT FROM s.source, top),
fold AS (
  SELECT no, 0 AS step, found AS digest, '' AS proof FROM leaves
  UNION ALL
  SELECT f.no, f.step + 1,
         sha256(array_to_string(list_concat(kids[1:w.slot], [f.digest], kids[w.slot + 2:]), '')),
         f.proof || array_to_string(list_concat(kids[1:w.slot], kids[w.slot + 2:]), '')
  FROM fold AS f JOIN (
    SELECT no, step, CASE WHEN step < height THEN seat ELSE -1 END AS tree, CASE WHEN step < height THEN step ELSE step - height END AS level,
           (CASE WHEN step < height THEN idx ELSE seat END // CAST({fan} ** (CASE WHEN step < height THEN step ELSE step - height END) AS BIGINT)) AS node,
           node % {fan} AS slot
    FROM (SELECT *, unnest(range(height + rest)) AS step FROM leaves)) AS w ON f.no = w.no AND f.step = w.step
  JOIN runs AS r ON r.tree = w.tree AND r.level = w.level AND r.run = w.node // {fan})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, digest AS folded_root, digest = root AS verified
FROM leaves JOIN fold ON leaves.no = fold.no AND step = height + rest"""
