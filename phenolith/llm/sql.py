"""DuckDB SQL of the queries that SQL can express."""

from phenolith.llm import line_rules as R
from phenolith.llm import secret_scan as S


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


CHAT = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
written AS (
  SELECT *, regexp_replace(text, '<(\\*)\|(im_start|im_end)\|>', '<\\\1|\2|>', 'g') AS escaped FROM given)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(role) + 1 + length(escaped) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""

_GAP = r"'[\x20\x09-\x0D]+'"
_HAS = r"regexp_matches({0}, '[^\x20\x09-\x0D]')"
_SYMBOL = f"'[{R.SYMBOLS}]'"


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {pattern}))"


RULES = f"""
WITH given AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, string_split(t, chr(10)) AS l FROM given),
windows AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(l, lambda x: {_HAS.format('x')}) AS worded, list_filter(l, lambda x: NOT ({_HAS.format('x')} AND (
    (contains(x, '|') AND {_count('x', "'[|]'")} * 32 >= length(x))
    OR (regexp_matches(x, {_SYMBOL}) AND {_count('x', _SYMBOL)} * 5 >= length(x))
    OR (contains(x, '!!') AND {_count('x', "'!{2,}'")} * 16 >= length(x))
    OR (length(x) < {R.FURNITURE_LINE} AND regexp_matches(x, {quoted(R.BOILERPLATE)}))
    OR (length(x) < {R.SHORT_LINE} AND NOT regexp_matches(x, {quoted(R.SENTENCE_END)}))))) AS stays FROM split),
counted AS (
  SELECT s.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    {_count('t', _SYMBOL)}::BIGINT AS n_symbols, (len(worded) - len(list_distinct(worded)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, (len(l) - len(stays))::BIGINT AS n_bad_lines,
    length(regexp_replace(array_to_string(stays, chr(10)), {_GAP}, '', 'g')) AS kept_chars
  FROM split s JOIN lines n ON s.doc_id = n.doc_id LEFT JOIN covered c ON s.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_bad_lines,
  (n_words < {R.MIN_WORDS} OR 100 * n_repeat_words > {R.MAX_REPEAT_PERCENT} * n_words) AS base_failed,
  (NOT (n_words < {R.MIN_WORDS} OR 100 * n_repeat_words > {R.MAX_REPEAT_PERCENT} * n_words)
   AND 100 * kept_chars >= {R.MIN_KEPT_PERCENT} * word_chars) AS kept
FROM counted
"""


def _spans(kind: str, pattern: str, rank: int, group: int) -> str:
    """Rows of the matches of one kind: the end of match i is the length of all pieces and matches up to it."""
    p = quoted(pattern)
    return f"""
  SELECT doc_id, source, '{kind}' AS kind, {rank} AS rank, stop - length(m) AS start, stop, regexp_extract(m, {p}, {group}) AS value FROM (
    SELECT doc_id, source, m, (sum(length(piece) + length(m)) OVER (PARTITION BY doc_id ORDER BY i))::BIGINT AS stop FROM (
      SELECT doc_id, source, unnest(regexp_extract_all(t, {p})) AS m, unnest(string_split_regex(t, {p})[:-2]) AS piece,
        generate_subscripts(regexp_extract_all(t, {p}), 1) AS i FROM given WHERE regexp_matches(t, {p})))"""


_RANDOM = """(regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
    AND len(list_distinct(string_split(value, ''))) >= 10 AND length(regexp_replace(value, '[^0-9]', '', 'g')) >= 4)"""

SECRETS = f"""
WITH given AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
base AS (
  SELECT * FROM ({_spans('assign', S.ASSIGN, 1, 2)}) WHERE length(value) >= 6
  UNION ALL {_spans('access', S.ACCESS, 2, 0)}
  UNION ALL {_spans('hex', S.HEX, 3, 0)}),
more AS (
  SELECT c.* FROM ({_spans('live', S.CANDIDATE, 4, 0)}) c WHERE {_RANDOM}
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.start < c.stop AND c.start < b.stop)),
found AS (SELECT * FROM base UNION ALL SELECT * FROM more),
owners AS (
  SELECT value, count(DISTINCT source) AS n_owners, count(DISTINCT coalesce(doc_id::VARCHAR, '')) AS n_repositories
  FROM found GROUP BY value),
judged AS (
  SELECT f.*, CASE WHEN n_owners >= {S.EXAMPLE_OWNERS} OR n_repositories >= {S.EXAMPLE_REPOSITORIES} THEN 'example'
    WHEN n_owners <= {S.MAX_OWNERS} AND n_repositories <= {S.MAX_REPOSITORIES} AND {_RANDOM} THEN 'live' ELSE 'unclear' END AS verdict
  FROM found f JOIN owners USING (value)),
kept AS (SELECT * FROM judged WHERE kind <> 'live' OR verdict = 'live')
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind <> 'live'), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind IS NOT NULL), '') AS spans,
  count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example
FROM given d LEFT JOIN kept k ON d.doc_id = k.doc_id GROUP BY d.doc_id
"""

_NIBBLES = "array_to_string(list_transform(string_split(sha1(html), ''), lambda x: right('000' || bin(instr('0123456789abcdef', x) - 1), 4)), '')"

WARC = f"""
WITH given AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
hashed AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_NIBBLES} AS bits FROM given),
named AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
    + substr(bits, 5 * i + 1, 1)::INT * 16 + substr(bits, 5 * i + 2, 1)::INT * 8 + substr(bits, 5 * i + 3, 1)::INT * 4
    + substr(bits, 5 * i + 4, 1)::INT * 2 + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest FROM hashed),
first AS (SELECT payload_digest, min(page_id) AS page FROM named GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > page THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > page THEN page END AS refers_to
FROM named JOIN first USING (payload_digest)
"""

def _components(nodes: str, links: str, key: str) -> str:
    """Common tables that end in ``component`` with the smallest key reachable from each node of ``nodes`` over ``links (a, b)``."""
    return f"""
either AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
reach AS (SELECT {key} AS id, {key} AS other FROM {nodes} UNION SELECT either.a, reach.other FROM reach JOIN either ON either.b = reach.id),
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""


SHINGLES = f"""
WITH RECURSIVE given AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM given WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON c.a = x.doc_id JOIN sizes y ON c.b = y.doc_id WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
{_components('documents', 'links', 'doc_id')}
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN component ON d.doc_id = id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""

VECTORS = f"""
WITH RECURSIVE given AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM given a JOIN given b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
{_components('embeddings', 'links', 'vec_id')},
counts AS (SELECT a, count(*) AS n FROM either GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component ON vec_id = id LEFT JOIN counts ON vec_id = a
"""

_NIBBLE = "instr('0123456789ABCDEF', substr(h, {}, 1)) - 1"
_HALF = "left(word, i - 1) || substr(word, i + 1)"

SPELLING = f"""
WITH RECURSIVE steps(b, k, c) AS (
  SELECT b, 0, b FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS key, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents)),
counted AS (SELECT key, run, hex(encode(key || ':' || run)) AS h, count(*) AS n FROM runs GROUP BY key, run),
bytes AS (
  SELECT run, n, list_transform(range(1, length(h), 2), lambda i: ({_NIBBLE.format('i')}) * 16 + {_NIBBLE.format('i + 1')}) AS b FROM counted),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, t[xor(a, x) % 256 + 1])), 4294967295::BIGINT) AS h FROM bytes, crc),
shortened AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM shortened WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, i, {_HALF} AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
longer AS (SELECT DISTINCT c.word AS long, c.n AS long_n, w.word AS short, w.n AS short_n FROM cut c JOIN words w ON c.rest = w.word),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT long, short, short_n FROM longer UNION ALL SELECT short, long, long_n FROM longer),
best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, near, near_n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
chain(word, root) AS (
  SELECT word, word FROM formed UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON f.word = c.word JOIN formed e ON c.root = e.word WHERE e.form IS NULL
"""

NEGATIVES = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT DISTINCT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM given a, given b WHERE a.vec_id % 50 = 0 AND (a.label <> b.label OR a.vec_id <> b.vec_id)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
WHERE 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) <= 3
"""

TEXTS = {
    "op1_chat_formatting": CHAT, "op4_secret_scans": SECRETS, "op6_quality_rules": RULES, "op7_embedding_near_dedup": VECTORS, "op9_minhash_near_dedup": SHINGLES, "op10_warc": WARC,
    "op12_spelling_variants": SPELLING, "op13_hard_negatives": NEGATIVES}
