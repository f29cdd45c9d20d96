"""The same results in DuckDB's SQL, where SQL can express them."""

from postlake.llm.queries import CALLS_SQL, RESULTS_SQL

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
)

ORACLE = {}

ORACLE["op1_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS ws,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM documents
), windows AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(*) AS n
  FROM (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM repeated) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id
), b AS (
  SELECT *, CAST(
      CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 3 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 12 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_capitals > 40 * word_chars THEN 64 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits, n_lines, n_capitals
FROM b
"""

ORACLE["quality_ablations"] = f"""
WITH bits AS (SELECT fail_bits AS f FROM ({ORACLE["op1_quality_rules"]})), rules(rule, bit) AS (
  VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('repeated_lines', 8), ('short_words', 16),
    ('long_words', 32), ('capitals', 64)
), policies(policy, mask) AS (VALUES ('base@1', 3), ('standard@1', 15), ('standard@2', 127))
SELECT policy, rule,
  CAST(count(*) FILTER ((f & bit) <> 0) AS BIGINT) AS n_failed, CAST(count(*) FILTER ((f & mask) = bit) AS BIGINT) AS n_failed_alone,
  CAST(count(*) FILTER ((f & mask & ~bit) = 0) AS BIGINT) AS n_kept_without, CAST(count(*) FILTER ((f & mask) = 0) AS BIGINT) AS n_kept
FROM bits, policies JOIN rules ON (mask & bit) <> 0 GROUP BY policy, rule
"""

ORACLE["op2_ngram_jaccard_join"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, {LOWER_WORDS} AS ws FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 3), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM d WHERE len(ws) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, r.component_id,
  CAST(coalesce(e.n, 0) AS BIGINT) AS n_links
FROM d
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT a, count(*) AS n FROM edges GROUP BY a) e ON e.a = d.doc_id
"""

ORACLE["op3_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), edges AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a
), named AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT n.vec_id, CAST(coalesce(e.n, 0) AS BIGINT) AS n_links, n.component_id, n.vec_id = n.component_id AS kept
FROM named n LEFT JOIN (SELECT a, count(*) AS n FROM edges GROUP BY a) e ON e.a = n.vec_id
"""

ORACLE["op4_token_counts"] = rf"""
WITH state AS (
  SELECT lang,
    CASE WHEN doc_id % 7 = 0 AND doc_id % 2 = 0 THEN 'moved' ELSE source END AS source,
    CASE WHEN doc_id % 7 = 0 THEN coalesce(text || ' ' || text, '') ELSE coalesce(text, '') END AS text
  FROM documents WHERE doc_id % 10 <> 3
), counts AS (
  SELECT source, lang, 'words@1' AS tokenizer, len({WORDS}) AS n FROM state
  UNION ALL SELECT source, lang, 'bytes@1', strlen(text) FROM state
  UNION ALL SELECT source, lang, 'pieces@1',
    len(regexp_extract_all(text, '\pL+|\pN|[^\pL\pN \x09-\x0D]')) FROM state
)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM counts GROUP BY source, lang, tokenizer
"""

_MARKS = "coalesce(min(h) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {0} AND {1}), 'g')"
_RUNS = """
  SELECT *, max(pos + n_words) OVER (PARTITION BY doc_id, line, run) - min(pos) OVER (PARTITION BY doc_id, line, run) AS covered
  FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id, line ORDER BY pos, n_words ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
    FROM (
      SELECT *, CASE WHEN pos <= max(pos + n_words) OVER (
        PARTITION BY doc_id, line ORDER BY pos, n_words ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
      FROM later))"""
ORACLE["op5_substring_dedup"] = rf"""
WITH tokens AS (
  -- Words, line ends and other gaps, with their lines and places.
  SELECT doc_id, t, token, token <> chr(10) AND regexp_matches(token, '[^\x20\x09-\x0D]') AS is_word,
    sum(length(token)) OVER w - length(token) AS start_char,
    sum(CASE WHEN token = chr(10) THEN 1 ELSE 0 END) OVER w - CASE WHEN token = chr(10) THEN 1 ELSE 0 END AS line_no
  FROM (
    SELECT doc_id, unnest(found) AS token, unnest(range(len(found))) AS t
    FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+|\n|[\x20\x09\x0B-\x0D]+') AS found FROM documents WHERE text IS NOT NULL)
  ) WINDOW w AS (PARTITION BY doc_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), words AS (
  SELECT doc_id, t, line_no, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY t) - 1 AS BIGINT) AS i,
    translate(token, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word
  FROM tokens WHERE is_word
), lines AS (
  SELECT doc_id, min(i) AS pos, count(*) AS n_words, string_agg(word, ' ' ORDER BY i) AS content FROM words GROUP BY doc_id, line_no
), cut AS (
  SELECT *, CASE WHEN i = 0 OR (h < {_MARKS.format("4 PRECEDING", "1 PRECEDING")}
    AND h <= {_MARKS.format("1 FOLLOWING", "4 FOLLOWING")}) THEN 1 ELSE 0 END AS begins
  FROM (SELECT *, substr(md5(word), 1, 16) AS h FROM words)
), pieces AS (
  SELECT doc_id, piece, min(i) AS pos, count(*) AS n_words, string_agg(word, ' ' ORDER BY i) AS content
  FROM (SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS piece FROM cut)
  GROUP BY doc_id, piece
), pairs AS (
  SELECT doc_id, pos, n_words + lead(n_words) OVER w AS n_words, md5(content || chr(10) || lead(content) OVER w) AS content
  FROM pieces WINDOW w AS (PARTITION BY doc_id ORDER BY piece)
), units AS (
  SELECT doc_id, pos, n_words, md5(content) AS content, true AS line FROM lines
  UNION ALL SELECT doc_id, pos, n_words, content, false FROM pairs WHERE n_words IS NOT NULL
), later AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line, content ORDER BY doc_id, pos) AS nth FROM units) WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + n_words)) AS i FROM ({_RUNS})
  WHERE CASE WHEN line THEN n_words >= 10 OR covered >= 50 ELSE covered >= 25 END
), placed AS (
  SELECT x.*, w.i, g.i IS NOT NULL AS goes,
    max(CASE WHEN x.is_word AND g.i IS NULL THEN w.i END) OVER l AS last_kept, max(w.i) OVER l IS NOT NULL AS has_words,
    last_value(CASE WHEN x.is_word THEN g.i IS NOT NULL END IGNORE NULLS) OVER (l ORDER BY x.t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_goes,
    first_value(w.i IGNORE NULLS) OVER (l ORDER BY x.t ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_word
  FROM tokens x LEFT JOIN words w ON w.doc_id = x.doc_id AND w.t = x.t LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i
  WINDOW l AS (PARTITION BY x.doc_id, x.line_no)
), judged AS (
  -- A line without words left goes whole; a gap stays behind a word that stays, unless no word that stays follows a cut.
  SELECT *, has_words AND last_kept IS NULL AS line_goes, CASE
      WHEN token = chr(10) THEN false WHEN has_words AND last_kept IS NULL THEN true WHEN is_word THEN goes
      WHEN before_goes IS NULL THEN false WHEN before_goes THEN true
      ELSE next_word IS NOT NULL AND next_word > last_kept END AS cut
  FROM placed
), spans AS (
  SELECT doc_id, line_no, min(start_char) AS a, max(start_char + length(token)) AS b FROM (
    SELECT *, t - row_number() OVER (PARTITION BY doc_id, line_no ORDER BY t) AS island FROM judged WHERE cut
  ) GROUP BY doc_id, line_no, island
), removed AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(a AS BIGINT) || '-' || CAST(b AS BIGINT), ',' ORDER BY a) AS spans FROM spans GROUP BY doc_id
), left_lines AS (
  SELECT d.doc_id, d.line_no, coalesce(string_agg(j.token, '' ORDER BY j.t) FILTER (NOT j.cut AND j.token <> chr(10)), '') AS text
  FROM (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents WHERE text IS NOT NULL) d
  LEFT JOIN judged j ON j.doc_id = d.doc_id AND j.line_no = d.line_no
  GROUP BY d.doc_id, d.line_no HAVING NOT coalesce(bool_or(j.line_goes), false)
), kept AS (
  SELECT doc_id, string_agg(text, chr(10) ORDER BY line_no) AS text FROM left_lines GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  CAST(coalesce(u.n, 0) AS BIGINT) AS n_units, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed_words, coalesce(r.spans, '') AS removed_spans
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN removed r ON r.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id) u ON u.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g ON g.doc_id = d.doc_id
"""


def _shares(parent: str, level: str, weight: str, family: str) -> str:
    """One level of the budget tree: `parent` has family columns and budget."""
    return f"""
  SELECT *, CASE WHEN is_full THEN cap ELSE (rest * weight) // nullif(open_weight, 0) END AS share FROM (
    SELECT *, budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (PARTITION BY {family}), 0) AS rest,
      sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY {family}) AS open_weight
    FROM (
      SELECT *, cap * sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        <= weight * (budget - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full
      FROM (SELECT *, {weight} AS weight FROM ({parent}))
      WINDOW w AS (PARTITION BY {family} ORDER BY cap / weight, {level})))"""


_LEAF = """CASE WHEN nr < 5 THEN 'web' WHEN nr < 10 THEN 'books' WHEN nr < 15 THEN 'reference' ELSE 'other' END"""
ORACLE["op9_source_mixture"] = rf"""
WITH d AS (
  SELECT doc_id, lang, source, CAST(len({WORDS}) AS BIGINT) AS n_tokens, {_LEAF} AS domain
  FROM (SELECT *, TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) AS nr FROM documents)
), leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) AS BIGINT) * 2 AS cap
  FROM d GROUP BY ALL
), domains AS ({_shares(
    "SELECT domain, sum(cap) AS cap, (SELECT sum(tokens) * 60 // 100 FROM leaves) AS budget FROM leaves GROUP BY domain",
    "domain", "CASE domain WHEN 'web' THEN 3 WHEN 'books' THEN 4 WHEN 'reference' THEN 2 ELSE 1 END", "1")}
), langs AS ({_shares(
    "SELECT l.domain, l.lang, sum(l.cap) AS cap, any_value(p.share) AS budget FROM leaves l JOIN domains p ON p.domain = l.domain GROUP BY l.domain, l.lang",
    "lang", "CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END", "domain")}
), sources AS ({_shares(
    "SELECT l.*, p.share AS budget FROM leaves l JOIN langs p ON p.domain = l.domain AND p.lang = l.lang",
    "source", "CASE source WHEN 'src0' THEN 3 WHEN 'src6' THEN 5 ELSE 1 END", "domain, lang")}
), plan AS (
  SELECT domain, lang, source, share // tokens AS whole, share % tokens AS remainder FROM sources WHERE tokens > 0
), ordered AS (
  SELECT d.*, whole, remainder, md5(concat_ws(':', '17', CAST(CAST(whole AS BIGINT) AS VARCHAR), CAST(doc_id AS VARCHAR))) AS k
  FROM d JOIN plan p ON p.domain = d.domain AND p.lang = d.lang AND p.source = d.source
), taken AS (
  SELECT *, whole + CASE WHEN sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k, doc_id) <= remainder
    THEN 1 ELSE 0 END AS copies FROM ordered
)
SELECT doc_id, domain, lang, source, n_tokens, CAST(copies AS BIGINT) AS copies FROM taken WHERE copies > 0
"""

_FIELD = "json_type(arguments, '$.{0}')"
ORACLE["op10_chat_tool_calls"] = f"""
WITH RECURSIVE turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
calls AS ({CALLS_SQL.replace("explode(sequence(0, CAST(n - 1 AS INT)))", "unnest(range(n))").replace("conversations", "turns")}),
results AS ({RESULTS_SQL.replace("conversations", "turns")}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn, content) AS nth FROM results
), steps AS (
  -- A call waits for one call at most here: it has a step if its chain ends.
  SELECT conv_id, call_id, 0 AS step FROM calls WHERE needs IS NULL
  UNION ALL
  SELECT c.conv_id, c.call_id, s.step + 1 FROM calls c JOIN steps s ON c.conv_id = s.conv_id AND c.needs = s.call_id
), linked AS (
  SELECT c.*, r.turn AS result_turn, r.content, s.step FROM calls c
  LEFT JOIN ranked r ON r.conv_id = c.conv_id AND r.call_id = c.call_id AND r.nth = 1
  LEFT JOIN steps s ON s.conv_id = c.conv_id AND s.call_id = c.call_id
), checked AS (
  SELECT *, CASE
      WHEN NOT json_valid(raw) THEN 'not JSON'
      WHEN name = 'search' AND {_FIELD.format("limit")} NOT IN ('UBIGINT', 'BIGINT') THEN 'type of limit'
      WHEN name = 'search' AND {_FIELD.format("query")} IS NULL THEN 'missing query'
      WHEN name IN ('search', 'calculate', 'lookup') THEN ''
      ELSE 'unknown tool' END AS problem,
    CASE name
      WHEN 'search' THEN '{{' || concat_ws(',', '"limit":' || json_extract(arguments, '$.limit'), '"query":' || json_extract(arguments, '$.query')) || '}}'
      WHEN 'calculate' THEN '{{"expression":' || json_extract(arguments, '$.expression') || ',"precision":2}}'
      WHEN 'lookup' THEN '{{"exact":' || json_extract(arguments, '$.exact') || ',"id":' || json_extract(arguments, '$.id') || '}}'
      ELSE '{{"a":' || json_extract(arguments, '$.a') || ',"b":[' || json_extract(arguments, '$.b[0]') || ',{{"c":' || json_extract(arguments, '$.b[1].c') || ',"d":null}}]}}'
    END AS canonical
  FROM (SELECT * REPLACE (CASE WHEN json_valid(arguments) THEN arguments END AS arguments), arguments AS raw FROM linked)
)
SELECT conv_id, call_id, turn, 'call' AS kind, CASE WHEN result_turn IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
  step, problem,
  '{{"arguments":' || coalesce(canonical, CAST(to_json(raw) AS VARCHAR)) || ',"conv_id":' || conv_id || ',"depends_on":['
    || coalesce('"' || needs || '"', '') || '],"id":"' || call_id || '","name":"' || name || '","result":'
    || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || ',"turn":' || turn || '}}' AS message
FROM checked
UNION ALL
SELECT r.conv_id, r.call_id, r.turn, 'result', CASE WHEN r.nth > 1 THEN 'repeated' ELSE 'orphan' END, NULL, '',
  '{{"conv_id":' || r.conv_id || ',"id":"' || r.call_id || '","result":' || CAST(to_json(r.content) AS VARCHAR) || ',"turn":' || r.turn || '}}'
FROM ranked r LEFT JOIN calls c ON c.conv_id = r.conv_id AND c.call_id = r.call_id
WHERE r.nth > 1 OR c.call_id IS NULL
"""
