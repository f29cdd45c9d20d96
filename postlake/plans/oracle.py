"""The registered queries as plain SQL over the given tables, for checking results.

Written from the meaning of each query, not from its Spark plan: words are unnested and
ranked with whole window functions.
"""

ORACLE = {}

POSTS = """numbered AS (
  SELECT CAST(doc_id AS VARCHAR) AS post_id, text AS content,
    CASE WHEN doc_id % 97 = 0 THEN NULL
         ELSE TIMESTAMP '2025-09-01 00:00:00'
              + (doc_id - doc_id % 2) * INTERVAL '37' MINUTE END AS created_at,
    CAST((doc_id * 7919) % 3256 AS BIGINT)  AS like_count,
    CAST((doc_id * 104729) % 301 AS BIGINT) AS repost_count,
    CAST((doc_id * 31) % 53 AS BIGINT)      AS reply_count,
    CAST(CASE WHEN doc_id % 13 = 0 THEN NULL
              ELSE (doc_id * 15485863) % 50021 END AS BIGINT) AS view_count,
    CASE WHEN doc_id % 4 = 1 THEN 1 ELSE 0 END  AS is_reply,
    CASE WHEN doc_id % 10 = 3 THEN 1 ELSE 0 END AS is_repost,
    CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END  AS is_quote,
    CASE WHEN doc_id % 4 = 1 THEN CAST(doc_id - 1 AS VARCHAR) END AS reply_to_post_id,
    doc_id, lang, source
  FROM documents),
posts AS (SELECT * EXCLUDE (doc_id, lang, source) FROM numbered)"""

BATCH = POSTS + """,
archive AS (SELECT * EXCLUDE (doc_id, lang, source) FROM numbered WHERE doc_id % 5 <> 4),
incoming AS (
  SELECT * EXCLUDE (doc_id, lang, source)
         REPLACE (CASE WHEN doc_id % 2 = 0 THEN like_count + 1 ELSE like_count END AS like_count)
  FROM numbered WHERE doc_id % 3 = 0
  UNION ALL
  SELECT * EXCLUDE (doc_id, lang, source)
         REPLACE (CAST(doc_id + 1000000 AS VARCHAR) AS post_id, created_at + INTERVAL '400' DAY AS created_at)
  FROM numbered WHERE doc_id % 17 = 0),
latest AS (SELECT max(created_at) AS bound FROM archive),
judged AS (
  SELECT i.*, a.post_id IS NULL AND NOT coalesce(i.created_at >= (SELECT bound FROM latest), FALSE) AS late,
    CASE WHEN a.post_id IS NULL THEN 'inserted'
         WHEN i.content IS DISTINCT FROM a.content OR i.created_at IS DISTINCT FROM a.created_at
           OR i.like_count IS DISTINCT FROM a.like_count OR i.repost_count IS DISTINCT FROM a.repost_count
           OR i.reply_count IS DISTINCT FROM a.reply_count OR i.view_count IS DISTINCT FROM a.view_count
           OR i.is_reply IS DISTINCT FROM a.is_reply OR i.is_repost IS DISTINCT FROM a.is_repost
           OR i.is_quote IS DISTINCT FROM a.is_quote
           OR i.reply_to_post_id IS DISTINCT FROM a.reply_to_post_id THEN 'updated'
         ELSE 'unchanged' END AS change
  FROM incoming i LEFT JOIN archive a ON a.post_id = i.post_id),
kept AS (SELECT * EXCLUDE (late, change) FROM judged WHERE NOT late),
merged AS (
  SELECT * FROM archive WHERE post_id NOT IN (SELECT post_id FROM kept)
  UNION ALL SELECT * FROM kept)"""

SPACES = r"[\s\p{Z}\x{85}\x{0b}\x{1c}-\x{1f}]"

DECODED = POSTS + rf""",
sent AS (
  SELECT *, 0 AS sequence, like_count AS likes FROM numbered
  UNION ALL
  SELECT *, 1 AS sequence, like_count + 1 AS likes FROM numbered WHERE doc_id % 5 = 0),
marked AS (
  SELECT *, regexp_replace(CASE WHEN doc_id % 20 = 13 THEN 'RT @x: ' || content ELSE content END,
                           '^{SPACES}+|{SPACES}+$', '', 'g') AS stripped
  FROM sent WHERE doc_id % 11 <> 0),
decoded AS (
  SELECT sequence, post_id, stripped AS content, created_at, likes AS like_count, repost_count, reply_count,
    coalesce(view_count, 0) AS view_count, is_reply,
    CASE WHEN doc_id % 10 = 3 OR starts_with(stripped, 'RT @') THEN 1 ELSE 0 END AS is_repost,
    is_quote, reply_to_post_id
  FROM marked),
last_sent AS (
  SELECT * EXCLUDE (sequence) FROM decoded
  QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY sequence DESC) = 1)"""

RENDERED = """coalesce(strftime(created_at, '%Y-%m-%d'), '') || ' | ' || CAST(coalesce(like_count, 0) AS VARCHAR)
    || ' likes' || chr(10) || chr(10) || coalesce(content, '') || chr(10)"""

WORD = r"[\p{L}\p{N}\p{Co}]+"

TOKENS = POSTS + f""",
split AS (SELECT post_id, regexp_extract_all(lower(content), '{WORD}') AS words FROM posts),
lengths AS (SELECT post_id, len(words) AS n FROM split),
totals AS (SELECT count(*) AS n_docs, sum(n) AS n_tokens FROM lengths),
tok AS (
  SELECT post_id, unnest(words) AS term, generate_subscripts(words, 1) - 1 AS pos FROM split)"""


def iso(column):
    return f"coalesce(strftime({column}, '%Y-%m-%dT%H:%M:%S') || '+00:00', '')"


SHOWN = (
    "post_id, like_count, repost_count, reply_count, view_count, is_reply, is_repost, is_quote, "
    f"reply_to_post_id, {iso('created_at')} AS created_at, md5(content) AS content_md5"
)


def put(name, ctes, select):
    ORACLE[name] = f"WITH {ctes}\n{select}"


put("scan_archive", POSTS, "SELECT post_id, like_count, view_count, is_reply FROM posts")
put("scan_raw_items", POSTS, """
SELECT CAST(sequence AS BIGINT) AS sequence, 'item-' || post_id AS item_id,
  CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 8 = 0 THEN '' ELSE post_id END AS rest_id
FROM (SELECT *, 0 AS sequence FROM numbered UNION ALL SELECT *, 1 AS sequence FROM numbered WHERE doc_id % 5 = 0)""")
put("scan_corpus_text", POSTS, """
SELECT post_id, coalesce(strftime(created_at, '%Y-%m-%d'), '') AS post_date, like_count, md5(content) AS content_md5
FROM posts WHERE is_repost = 0""")
put("write_archive", BATCH, f"""
SELECT {SHOWN} FROM (
  SELECT * FROM archive WHERE post_id NOT IN (SELECT post_id FROM incoming) UNION ALL SELECT * FROM incoming)""")
put("write_corpus", POSTS, f"""
SELECT post_id, post_id || '.txt' AS file_name, md5({RENDERED}) AS body_md5 FROM posts WHERE is_repost = 0""")
put("rows_to_json", POSTS, f"""
SELECT CAST(to_json(s) AS VARCHAR) AS json FROM (
  SELECT struct_pack(post_id := post_id, content := content, created_at := {iso('created_at')},
    like_count := like_count, view_count := view_count, reply_to_post_id := reply_to_post_id) AS s FROM posts)""")

put("decode_items", DECODED, f"SELECT CAST(sequence AS BIGINT) AS sequence, {SHOWN} FROM decoded")
put("post_id_chain", DECODED, "SELECT CAST(sequence AS BIGINT) AS sequence, post_id FROM decoded")
put("choose_text", DECODED, """
SELECT CAST(sequence AS BIGINT) AS sequence, post_id, CAST(length(content) AS INTEGER) AS n_chars,
  md5(content) AS content_md5 FROM decoded""")
put("parse_created_at", DECODED, f"""
SELECT CAST(sequence AS BIGINT) AS sequence, post_id, {iso('created_at')} AS created_at FROM decoded""")
put("engagement_counts", DECODED, """
SELECT CAST(sequence AS BIGINT) AS sequence, post_id, like_count, repost_count, reply_count, view_count FROM decoded""")
put("post_flags", DECODED, """
SELECT CAST(sequence AS BIGINT) AS sequence, post_id, is_reply, is_repost, is_quote, reply_to_post_id FROM decoded""")
ORACLE["strip_markup"] = """
SELECT page_id, url,
  replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'),
    '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&') AS text
FROM pages"""
put("render_body", POSTS, f"""
SELECT post_id, post_id || '.txt' AS file_name, {RENDERED} AS body FROM posts WHERE is_repost = 0""")

put("filter_kind", POSTS, """
SELECT 'original' AS kind, post_id FROM posts WHERE is_repost = 0 AND is_reply = 0
UNION ALL SELECT 'reply', post_id FROM posts WHERE is_reply = 1
UNION ALL SELECT 'repost', post_id FROM posts WHERE is_repost = 1
UNION ALL SELECT 'not_repost', post_id FROM posts WHERE is_repost = 0""")
put("filter_min_metric", POSTS, "SELECT post_id, like_count FROM posts WHERE like_count > 500")
put("filter_contains", POSTS, """
SELECT post_id, like_count FROM posts WHERE content ILIKE '%tion the%'
ORDER BY like_count DESC NULLS LAST, post_id LIMIT 20""")

HITS = POSTS + """,
hits AS (SELECT CAST(page_id * 5 AS VARCHAR) || '.txt' AS path, CAST(page_id * 5 AS VARCHAR) AS post_id,
  CAST(1.0 AS DOUBLE) / (1 + page_id) AS score,
  replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'),
    '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&') AS snippet FROM pages)"""
put("hits_join_posts", HITS, f"""
SELECT path, post_id, score, like_count, view_count, {iso('created_at')} AS created_at, md5(content) AS content_md5
FROM hits JOIN posts USING (post_id)""")
put("enrich_hits", HITS, f"""
SELECT h.path, h.post_id, {iso('p.created_at')} AS created_at,
  CASE WHEN p.post_id IS NULL THEN 0 ELSE p.like_count END AS like_count,
  CASE WHEN p.post_id IS NULL THEN 0 ELSE p.repost_count END AS repost_count,
  CASE WHEN p.post_id IS NULL THEN 0 ELSE p.view_count END AS view_count,
  h.score, md5(CASE WHEN p.post_id IS NULL THEN h.snippet ELSE p.content END) AS content_md5
FROM hits h LEFT JOIN posts p ON p.post_id = h.post_id""")
put("lookup_ids", HITS, "SELECT post_id, like_count FROM posts WHERE post_id IN (SELECT post_id FROM hits)")
put("boundary_seen", BATCH, """
SELECT EXISTS (SELECT 1 FROM incoming WHERE post_id IN (SELECT post_id FROM archive)) AS overlaps""")
put("classify_changes", BATCH, "SELECT post_id, like_count, change FROM judged")
put("late_filter", BATCH, "SELECT post_id, CASE WHEN late THEN 'late' ELSE 'kept' END AS outcome FROM judged")

DIFF = POSTS + f""",
wanted AS (SELECT post_id || '.txt' AS file_name, {RENDERED} AS body FROM posts WHERE is_repost = 0),
present AS (
  SELECT post_id || '.txt' AS file_name, {RENDERED} AS body FROM (
    SELECT * REPLACE (CASE WHEN doc_id % 15 = 1 THEN like_count + 1 ELSE like_count END AS like_count)
    FROM numbered WHERE doc_id % 12 <> 0
    UNION ALL
    SELECT * REPLACE (CAST(doc_id + 2000000 AS VARCHAR) AS post_id) FROM numbered WHERE doc_id % 50 = 0)
  WHERE is_repost = 0),
diff AS (
  SELECT coalesce(w.file_name, p.file_name) AS file_name,
    CASE WHEN w.file_name IS NULL THEN 'removed' WHEN w.body = p.body THEN 'unchanged' ELSE 'written' END AS change
  FROM wanted w FULL JOIN present p ON p.file_name = w.file_name)"""
put("corpus_diff", DIFF, "SELECT file_name, change FROM diff")
put("corpus_diff_counts", DIFF, """
SELECT count(*) FILTER (change <> 'removed') AS files, count(*) FILTER (change = 'written') AS written,
  count(*) FILTER (change = 'removed') AS removed FROM diff""")

FIGURES = f"""{iso('min(created_at)')} AS earliest, {iso('max(created_at)')} AS latest,
  round(avg(CASE WHEN is_repost = 0 THEN like_count END), 1) AS avg_likes,
  round(avg(CASE WHEN is_repost = 0 THEN view_count END), 0) AS avg_views"""
put("archive_stats", POSTS, f"""
SELECT count(*) AS total, count(*) FILTER (is_repost = 0 AND is_reply = 0) AS original,
  count(*) FILTER (is_reply = 1) AS replies, count(*) FILTER (is_repost = 1) AS reposts, {FIGURES} FROM posts""")
put("archive_summary", POSTS, f"""
SELECT count(*) AS total, CAST(sum(CASE WHEN is_repost = 0 AND is_reply = 0 THEN 1 ELSE 0 END) AS BIGINT) AS original,
  {FIGURES} FROM posts""")
put("archive_latest", POSTS, f"SELECT {iso('max(created_at)')} AS latest FROM posts")
SEEN = f"{iso('max(created_at)')} AS newest, {iso('min(created_at)')} AS oldest"
BOUNDARY = "bool_or(post_id IN (SELECT post_id FROM archive)) AS overlaps"
put("batch_summary", BATCH, f"SELECT count(*) AS n_posts, {SEEN}, {BOUNDARY} FROM incoming")
put("change_counts", BATCH, """
SELECT CASE WHEN late THEN 'late' ELSE change END AS change, count(*) AS n_rows FROM judged GROUP BY 1""")

put("dedupe_last_wins", DECODED + """,
again AS (
  SELECT * EXCLUDE (sequence) REPLACE (like_count + 5 AS like_count) FROM decoded
  WHERE sequence = 0 AND CAST(post_id AS BIGINT) % 4 = 1)""", f"""
SELECT {SHOWN} FROM (
  SELECT * FROM last_sent WHERE post_id NOT IN (SELECT post_id FROM again) UNION ALL BY NAME SELECT * FROM again)""")
put("topk_per_query", POSTS, """
SELECT query_id, post_id, score, CAST(nth AS INTEGER) AS rank FROM (
  SELECT source || '/' || lang AS query_id, post_id, CAST(like_count AS DOUBLE) AS score,
    row_number() OVER (PARTITION BY source || '/' || lang ORDER BY like_count DESC, post_id) AS nth
  FROM numbered) WHERE nth <= 3""")
for key, metric in (("top_likes", "like_count"), ("top_reposts", "repost_count"), ("top_views", "view_count")):
    put(key, POSTS, f"""
SELECT post_id, like_count, repost_count, view_count, {iso('created_at')} AS created_at, md5(content) AS content_md5
FROM (SELECT * FROM posts WHERE is_repost = 0 ORDER BY {metric} DESC NULLS LAST, post_id LIMIT 10)""")
put("recent_posts", POSTS, f"""
SELECT post_id, like_count, view_count, {iso('created_at')} AS created_at, md5(content) AS content_md5
FROM (SELECT * FROM posts WHERE is_repost = 0 ORDER BY created_at DESC NULLS LAST, post_id LIMIT 10)""")

put("tokenize_posts", POSTS, f"""
SELECT post_id, CAST(pos AS INTEGER) AS pos, term FROM (
  SELECT post_id, unnest(words) AS term, generate_subscripts(words, 1) - 1 AS pos
  FROM (SELECT post_id, regexp_extract_all(strip_accents(lower(content)), '{WORD}') AS words FROM posts))""")
POSTINGS_SELECT = """
SELECT t.term, 'content' AS field, t.post_id, CAST(count(*) AS INTEGER) AS tf, CAST(any_value(l.n) AS INTEGER) AS doc_len,
  TRUE AS lead, string_agg(CAST(t.pos AS VARCHAR), ',' ORDER BY t.pos) AS positions
FROM tok t JOIN lengths l ON l.post_id = t.post_id GROUP BY t.term, t.post_id"""
put("build_postings", TOKENS, POSTINGS_SELECT)
put("term_stats", TOKENS, """
SELECT term, count(DISTINCT post_id) AS df, (SELECT n_docs FROM totals) AS n_docs,
  (SELECT round(CAST(n_tokens AS DOUBLE) / n_docs, 4) FROM totals) AS avg_len
FROM tok GROUP BY term""")
put("refresh_postings", TOKENS.replace("AS words FROM posts)", """AS words FROM (
  SELECT post_id, CASE WHEN doc_id % 6 = 1 THEN content || ' refreshed text' ELSE content END AS content
  FROM numbered WHERE doc_id % 7 <> 3))"""), POSTINGS_SELECT)

SCORED = """,
df AS (SELECT query_id, unit, count(*) AS df FROM found GROUP BY ALL),
scored AS (
  SELECT f.query_id, f.unit, f.post_id,
    greatest(CASE WHEN ln((t.n_docs - d.df + 0.5) / (d.df + 0.5)) <= 0 THEN 1e-6
                  ELSE ln((t.n_docs - d.df + 0.5) / (d.df + 0.5)) END, 1e-6)
      * f.tf * 2.2 / (f.tf + 1.2 * (0.25 + 0.75 * l.n * t.n_docs / t.n_tokens)) AS score
  FROM found f JOIN df d USING (query_id, unit) JOIN lengths l ON l.post_id = f.post_id, totals t)"""


def word_units(*units):
    """found: occurrences of single words, from (query_id, unit, word)."""
    rows = ", ".join(f"('{q}', {u}, '{w}')" for q, u, w in units)
    return f"""
  SELECT query_id, unit, post_id, count(*) AS tf
  FROM (VALUES {rows}) AS w(query_id, unit, word) JOIN tok ON term = word GROUP BY ALL"""


def phrase_units(*units, first=False):
    """found: occurrences of word sequences, from (query_id, unit, words)."""
    parts = []
    for q, u, words in units:
        joins = " ".join(
            f"JOIN tok t{i} ON t{i}.post_id = t0.post_id AND t{i}.pos = t0.pos + {i} AND t{i}.term = '{w}'"
            for i, w in enumerate(words) if i
        )
        start = " AND t0.pos = 0" if first else ""
        parts.append(f"""
  SELECT '{q}' AS query_id, {u} AS unit, t0.post_id, count(*) AS tf
  FROM tok t0 {joins} WHERE t0.term = '{words[0]}'{start} GROUP BY ALL""")
    return "\n  UNION ALL ".join(parts)


def prefix_units(*units):
    rows = ", ".join(f"('{q}', {u}, '{w}')" for q, u, w in units)
    return f"""
  SELECT query_id, unit, post_id, count(*) AS tf
  FROM (VALUES {rows}) AS w(query_id, unit, word) JOIN tok ON starts_with(term, word) GROUP BY ALL"""


def best(hits, n=10):
    return f"""
SELECT query_id, post_id, score, CAST(nth AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, post_id) AS nth FROM ({hits})) WHERE nth <= {n}"""


def all_of(needed):
    """Posts with as many different units as the query has."""
    rows = ", ".join(f"('{q}', {n})" for q, n in needed.items())
    return f"""
  SELECT query_id, post_id, round(sum(score), 6) AS score
  FROM scored JOIN (VALUES {rows}) AS q(query_id, needed) USING (query_id)
  GROUP BY query_id, post_id, needed HAVING count(DISTINCT unit) = needed"""


def put_search(name, found, hits, n=10):
    put(name, f"{TOKENS},\nfound AS ({found}){SCORED}", best(hits, n))


KEYWORDS = word_units(
    ("two words", 0, "from"), ("two words", 1, "by"), ("one word", 0, "tion"), ("common", 0, "the"),
    ("none", 0, "from"), ("none", 1, "zzzzz"),
)
put("keyword_search", f"{TOKENS},\nfound AS ({KEYWORDS}){SCORED}", f"""
SELECT h.query_id, h.rank, h.post_id, h.score, p.like_count, coalesce(strftime(p.created_at, '%Y-%m-%d'), '') AS day
FROM ({best(all_of({"two words": 2, "one word": 1, "common": 1, "none": 2}))}) h JOIN posts p USING (post_id)""")
put_search(
    "boolean_search",
    word_units(
        ("or", 0, "tion"), ("or", 1, "ed"), ("or", 2, "zzzzz"),
        ("and or not", 0, "from"), ("and or not", 1, "tion"), ("and or not", 2, "by"), ("and or not", 9, "ed"),
        ("not", 0, "nd"), ("not", 9, "the"), ("not", 10, "of"),
    ),
    """
  SELECT query_id, post_id, round(sum(score), 6) AS score FROM scored GROUP BY query_id, post_id
  HAVING count(*) FILTER (unit >= 9) = 0
    AND (query_id <> 'and or not' OR (count(*) FILTER (unit = 0) > 0 AND count(*) FILTER (unit IN (1, 2)) > 0))""",
)
put_search(
    "phrase_search",
    phrase_units(("two", 0, ["of", "the"]), ("three", 0, ["to", "the", "of"]), ("with word", 0, ["in", "the"]))
    + "\n  UNION ALL " + word_units(("with word", 1, "from")),
    all_of({"two": 1, "three": 1, "with word": 2}),
)
put_search(
    "prefix_search",
    prefix_units(("short", 0, "fro"), ("long", 0, "thatth"), ("with word", 1, "tio"))
    + "\n  UNION ALL " + word_units(("with word", 0, "by")),
    all_of({"short": 1, "long": 1, "with word": 2}),
)
# Some stretch from one of the words holds all of them, k + 1 places further at most.
NEAR_CTES = """,
groups(query_id, near_k, n) AS (VALUES ('close', 3, 2), ('default', 10, 2), ('three', 20, 3)),
places AS (
  SELECT w.query_id, w.unit, t.post_id, t.pos FROM (VALUES ('close', 0, 'from'), ('close', 1, 'by'),
    ('default', 0, 'tion'), ('default', 1, 'nd'), ('three', 0, 'from'), ('three', 1, 'by'), ('three', 2, 'ed'))
    AS w(query_id, unit, word) JOIN tok t ON t.term = w.word),
close_posts AS (
  SELECT DISTINCT query_id, post_id FROM (
    SELECT a.query_id, a.post_id, a.pos, any_value(g.n) AS n, count(DISTINCT b.unit) AS got
    FROM places a JOIN groups g USING (query_id)
    JOIN places b ON b.query_id = a.query_id AND b.post_id = a.post_id AND b.pos BETWEEN a.pos AND a.pos + g.near_k + 1
    GROUP BY a.query_id, a.post_id, a.pos) WHERE got = n)"""
put("near_search",
    f"{TOKENS}{NEAR_CTES},\nfound AS (SELECT query_id, unit, post_id, count(*) AS tf FROM places GROUP BY ALL){SCORED}",
    best("""
  SELECT query_id, post_id, round(sum(score), 6) AS score
  FROM scored JOIN close_posts USING (query_id, post_id) GROUP BY query_id, post_id"""))
put_search(
    "initial_search",
    phrase_units(("the", 0, ["the"]), ("of", 0, ["of"]), ("phrase", 0, ["of", "the"]), first=True),
    all_of({"the": 1, "of": 1, "phrase": 1}),
)
FIELD_TOKENS = POSTS + f""",
split AS (
  SELECT post_id, 'content' AS field, regexp_extract_all(lower(content), '{WORD}') AS words FROM numbered
  UNION ALL SELECT post_id, 'lang', regexp_extract_all(lower(lang), '{WORD}') FROM numbered),
lengths AS (SELECT post_id, sum(len(words)) AS n FROM split GROUP BY post_id),
totals AS (SELECT count(*) AS n_docs, sum(n) AS n_tokens FROM lengths),
tok AS (SELECT post_id, field, unnest(words) AS term FROM split),
found AS (
  SELECT query_id, 0 AS unit, post_id, count(*) AS tf
  FROM (VALUES ('language', 'lang'), ('content', 'content'), ('any', NULL)) AS w(query_id, only_field)
  JOIN tok ON term = 'de' AND (only_field IS NULL OR only_field = field) GROUP BY ALL)"""
put("field_search", FIELD_TOKENS + SCORED, best(all_of({"language": 1, "content": 1, "any": 1})))

put("benchmark_search", f"""{TOKENS},
items AS (
  SELECT 'item' || CAST(item_id AS VARCHAR) AS query_id,
    ' ' || array_to_string(regexp_extract_all(lower(text), '{WORD}'), ' ') || ' ' AS phrase FROM benchmark),
texts AS (SELECT post_id, ' ' || array_to_string(words, ' ') || ' ' AS text FROM split),
found AS (
  SELECT query_id, 0 AS unit, post_id, (length(text) - length(replace(text, phrase, ' '))) // (length(phrase) - 1) AS tf
  FROM items JOIN texts ON contains(text, phrase)){SCORED}""",
    best("SELECT query_id, post_id, round(score, 6) AS score FROM scored"))

VECTORS = """vec AS (SELECT CAST(vec_id * 3 AS VARCHAR) AS post_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
asked AS (SELECT 'q' || CAST(vec_id AS VARCHAR) AS query_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 20 = 0),
near AS (
  SELECT a.query_id, v.post_id, round(list_cosine_similarity(a.e, v.e), 6) AS score FROM asked a, vec v)"""
put("vector_search", VECTORS, best("SELECT * FROM near"))


ASKED_WORDS = "['from', 'by', 'tion', 'ed', 'nd', 'zzzzz', 'with']"


def fusion(*alone):
    rows = ", ".join(f"('w{i}', '{w}')" for i, w in enumerate(alone))
    others = f" UNION ALL SELECT * FROM (VALUES {rows}) AS x(query_id, word)" if alone else ""
    return f"""{TOKENS},
{VECTORS},
words AS (
  SELECT query_id, {ASKED_WORDS}[1 + CAST(substr(query_id, 2) AS BIGINT) // 20 % 7] AS word FROM asked{others}),
found AS (
  SELECT query_id, 0 AS unit, post_id, count(*) AS tf FROM words JOIN tok ON term = word GROUP BY ALL){SCORED},
keyword AS (SELECT query_id, post_id, round(score, 6) AS score FROM scored),
ranked AS (
  SELECT query_id, post_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, post_id) AS place
  FROM keyword WHERE query_id IN (SELECT query_id FROM asked)
  UNION ALL
  SELECT query_id, post_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, post_id) FROM near),
fused AS (SELECT query_id, post_id, round(sum(1.0 / (60 + CAST(place AS DOUBLE))), 6) AS score FROM ranked GROUP BY ALL)"""


FALLBACK = f"""
SELECT *, 'hybrid' AS method FROM ({best("SELECT * FROM fused", 5)})
UNION ALL
SELECT *, 'keyword' AS method FROM ({best(
    "SELECT * FROM keyword WHERE query_id NOT IN (SELECT query_id FROM asked)", 5)})"""
put("hybrid_search", fusion(), best("SELECT * FROM fused"))
put("search_fallback", fusion("with", "zzzzz"), FALLBACK)
put("search_all", fusion("with", "zzzzz"), f"""
SELECT CAST(to_json(struct_pack(query_id := h.query_id, rank := h.rank, method := h.method, post_id := h.post_id,
    created_at := {iso('p.created_at')}, content := CASE WHEN p.post_id IS NULL THEN '' ELSE p.content END,
    like_count := CASE WHEN p.post_id IS NULL THEN 0 ELSE p.like_count END,
    repost_count := CASE WHEN p.post_id IS NULL THEN 0 ELSE p.repost_count END,
    view_count := CASE WHEN p.post_id IS NULL THEN 0 ELSE p.view_count END, score := h.score)) AS VARCHAR) AS json
FROM ({FALLBACK}) h LEFT JOIN (SELECT * FROM numbered WHERE doc_id % 7 <> 5) p ON p.post_id = h.post_id""")

put("upsert_posts", BATCH, f"""
SELECT {SHOWN} FROM (
  SELECT * FROM archive WHERE post_id NOT IN (SELECT post_id FROM incoming) UNION ALL SELECT * FROM incoming)""")
put("plan_update", BATCH, f"""
SELECT count(*) AS n_posts, count(*) FILTER (NOT late) AS n_kept,
  count(*) FILTER (late) AS n_late, {SEEN},
  (SELECT {iso('bound')} FROM latest) AS archive_newest, {BOUNDARY} FROM judged""")
put("update_report", BATCH + f""",
wanted AS (SELECT post_id, {RENDERED} AS body FROM merged WHERE is_repost = 0),
present AS (SELECT post_id, {RENDERED} AS body FROM archive WHERE is_repost = 0)""", f"""
SELECT count(*) AS n_posts, count(*) FILTER (NOT late) AS applied,
  count(*) FILTER (late) AS n_late, {iso('max(created_at)')} AS newest,
  (SELECT {iso('bound')} FROM latest) AS newest_before, {BOUNDARY},
  count(*) FILTER (NOT late AND change = 'inserted') AS inserted,
  count(*) FILTER (NOT late AND change = 'updated') AS updated,
  count(*) FILTER (NOT late AND change = 'unchanged') AS unchanged,
  (SELECT count(*) FROM wanted) AS files,
  (SELECT count(*) FROM wanted w LEFT JOIN present p USING (post_id) WHERE p.body IS DISTINCT FROM w.body) AS written,
  (SELECT count(*) FROM present WHERE post_id NOT IN (SELECT post_id FROM wanted)) AS removed,
  (SELECT count(*) FROM merged) AS total,
  (SELECT count(*) FROM merged WHERE is_repost = 0 AND is_reply = 0) AS original,
  (SELECT round(avg(like_count), 1) FROM merged WHERE is_repost = 0) AS avg_likes,
  (SELECT round(avg(view_count), 0) FROM merged WHERE is_repost = 0) AS avg_views,
  (SELECT {iso('max(created_at)')} FROM merged) AS latest
FROM judged""")
put("gap_check", BATCH, """
SELECT 'near' AS batch, count(*) AS n_posts, TRUE AS overlap_required, TRUE AS overlaps,
  'ok' AS status, count(*) AS n_allowed FROM incoming
UNION ALL
SELECT 'far', count(*), TRUE, FALSE, 'gap', 0 FROM incoming""")
put("stream_ingest", DECODED + """,
archive AS (SELECT * EXCLUDE (doc_id, lang, source) FROM numbered WHERE doc_id % 5 <> 4),
applied AS (
  SELECT * FROM last_sent WHERE post_id IN (SELECT post_id FROM archive)
    OR coalesce(created_at >= (SELECT max(created_at) FROM archive), FALSE))""", f"""
SELECT {SHOWN} FROM (
  SELECT post_id, content, created_at, like_count, repost_count, reply_count, view_count, is_reply, is_repost, is_quote,
    reply_to_post_id FROM archive WHERE post_id NOT IN (SELECT post_id FROM applied)
  UNION ALL
  SELECT post_id, content, created_at, like_count, repost_count, reply_count, view_count, is_reply, is_repost, is_quote,
    reply_to_post_id FROM applied)""")
put("stream_ingest_two_days", DECODED + """,
archive AS (SELECT * EXCLUDE (doc_id, lang, source) FROM numbered WHERE doc_id % 5 <> 4),
applied AS (
  SELECT * FROM last_sent WHERE post_id IN (SELECT post_id FROM archive)
    OR coalesce(created_at >= (SELECT max(created_at) FROM archive), FALSE)),
first_day AS (
  SELECT * FROM archive WHERE post_id NOT IN (SELECT post_id FROM applied) UNION ALL BY NAME SELECT * FROM applied),
later AS (
  SELECT * EXCLUDE (sequence) REPLACE (like_count + 5 AS like_count) FROM decoded
  WHERE sequence = 0 AND CAST(post_id AS BIGINT) % 4 = 1),
applied_later AS (
  SELECT * FROM later WHERE post_id IN (SELECT post_id FROM first_day)
    OR coalesce(created_at >= (SELECT max(created_at) FROM first_day), FALSE))""", f"""
SELECT {SHOWN} FROM (
  SELECT * FROM first_day WHERE post_id NOT IN (SELECT post_id FROM applied_later)
  UNION ALL BY NAME SELECT * FROM applied_later)""")
put("daily_update", DECODED + f""",
archive AS (SELECT * EXCLUDE (doc_id, lang, source) FROM numbered WHERE doc_id % 5 <> 4),
latest AS (SELECT max(created_at) AS bound FROM archive),
judged AS (
  SELECT s.*, a.post_id IS NOT NULL AS known, a.post_id IS NULL AND NOT coalesce(s.created_at >= (SELECT bound FROM latest), FALSE) AS late,
    CASE WHEN a.post_id IS NULL THEN 'inserted'
      WHEN (s.content, s.created_at, s.like_count, s.repost_count, s.reply_count, s.view_count, s.is_reply, s.is_repost, s.is_quote,
        s.reply_to_post_id) IS DISTINCT FROM (a.content, a.created_at, a.like_count, a.repost_count, a.reply_count, a.view_count,
        a.is_reply, a.is_repost, a.is_quote, a.reply_to_post_id) THEN 'updated' ELSE 'unchanged' END AS change
  FROM last_sent s LEFT JOIN archive a ON a.post_id = s.post_id),
kept AS (SELECT * EXCLUDE (known, late, change) FROM judged WHERE NOT late),
merged AS (
  SELECT * FROM archive WHERE post_id NOT IN (SELECT post_id FROM kept) UNION ALL BY NAME SELECT * FROM kept),
wanted AS (SELECT post_id, {RENDERED} AS body FROM merged WHERE is_repost = 0),
present AS (SELECT post_id, {RENDERED} AS body FROM archive WHERE is_repost = 0),
words AS (SELECT post_id, regexp_extract_all(lower(coalesce(content, '')), '{WORD}') AS words FROM merged),
postings AS (SELECT DISTINCT post_id, unnest(words) AS term FROM words)""", f"""
SELECT count(*) AS n_posts, count(*) FILTER (NOT late) AS applied, count(*) FILTER (late) AS n_late, CAST(0 AS BIGINT) AS n_rejected,
  bool_or(known) AS overlaps, count(*) FILTER (NOT late AND change = 'inserted') AS inserted,
  count(*) FILTER (NOT late AND change = 'updated') AS updated, count(*) FILTER (NOT late AND change = 'unchanged') AS unchanged,
  (SELECT count(*) FROM wanted) AS files,
  (SELECT count(*) FROM wanted w LEFT JOIN present p USING (post_id) WHERE p.body IS DISTINCT FROM w.body) AS written,
  (SELECT count(*) FROM present WHERE post_id NOT IN (SELECT post_id FROM wanted)) AS removed,
  (SELECT count(*) FROM merged) AS total, (SELECT count(*) FROM merged WHERE is_repost = 0 AND is_reply = 0) AS original,
  (SELECT round(avg(like_count), 1) FROM merged WHERE is_repost = 0) AS avg_likes,
  {iso('max(created_at)')} AS newest, (SELECT {iso('bound')} FROM latest) AS newest_before,
  (SELECT count(*) FROM merged) AS n_docs, (SELECT CAST(sum(len(words)) AS BIGINT) FROM words) AS n_tokens,
  (SELECT count(DISTINCT term) FROM postings) AS n_terms, (SELECT count(*) FROM postings) AS n_postings,
  (SELECT count(*) FROM wanted) AS n_documents, (SELECT CAST(sum(length(body)) AS BIGINT) FROM wanted) AS n_chars,
  (SELECT count(*) FROM merged) AS n_archived, (SELECT CAST(sum(like_count) AS BIGINT) FROM merged) AS n_likes
FROM judged""")
put("topk_every_hit", POSTS, """
SELECT lang AS query_id, post_id, CAST(like_count AS DOUBLE) AS score,
  CAST(row_number() OVER (PARTITION BY lang, n ORDER BY like_count DESC, post_id) AS INTEGER) AS rank, n
FROM numbered CROSS JOIN (SELECT 'all' AS n UNION ALL SELECT '5000') WHERE TRUE
QUALIFY n = 'all' OR row_number() OVER (PARTITION BY lang, n ORDER BY like_count DESC, post_id) <= 5000""")
put("archive_check", BATCH + """,
faulty AS (
  SELECT * REPLACE (reply_count - 1 AS reply_count,
    CASE WHEN like_count % 50 = 7 THEN 2 ELSE is_quote END AS is_quote,
    CASE WHEN like_count % 9 = 0 THEN NULL ELSE reply_to_post_id END AS reply_to_post_id,
    CASE WHEN like_count % 100 = 3 THEN NULL ELSE post_id END AS post_id)
  FROM (SELECT * FROM posts UNION ALL SELECT * FROM incoming))""", """
SELECT 'null_id' AS rule, count(*) AS n_bad FROM faulty WHERE post_id IS NULL
UNION ALL SELECT 'flag_not_0_or_1', count(*) FROM faulty WHERE is_quote NOT IN (0, 1)
UNION ALL SELECT 'negative_count', count(*) FROM faulty WHERE reply_count < 0
UNION ALL SELECT 'reply_without_target', count(*) FROM faulty WHERE is_reply = 1 AND reply_to_post_id IS NULL
UNION ALL SELECT 'duplicate_id', count(*) FROM (
  SELECT post_id FROM faulty WHERE post_id IS NOT NULL GROUP BY post_id HAVING count(*) > 1)""")
put("sql_posts", POSTS, "SELECT post_id, like_count, view_count FROM posts WHERE like_count > 500")
put("sql_index", TOKENS, """
SELECT CAST(to_json(struct_pack(post_id := post_id, like_count := like_count, n_rare := n_rare, n_places := n_places,
  first_term := first_term)) AS VARCHAR) AS json
FROM (
  SELECT p.post_id, p.like_count, count(*) AS n_rare, CAST(sum(tf) AS BIGINT) AS n_places, min(term) AS first_term
  FROM (SELECT term, post_id, count(*) AS tf, count(*) OVER (PARTITION BY term) AS df FROM tok GROUP BY term, post_id) o
  JOIN posts p USING (post_id)
  WHERE p.is_repost = 0 AND df BETWEEN 2 AND 5 GROUP BY p.post_id, p.like_count HAVING count(*) > 1)""")
