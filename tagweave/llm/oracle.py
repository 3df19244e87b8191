"""SQL that a second engine runs for the queries that SQL can express."""

from __future__ import annotations

from tagweave.llm import licenses

_KNOWN = ", ".join(f"('{name}', '{sentence}')" for name, sentence in [*licenses.SENTENCES.items(), *licenses.WORDINGS])


def _licenses() -> str:
    """Rules are applied one after the other to the joined identifiers, as nested selects."""
    step = "SELECT doc_id, n_sentences, sentence_ids, ',' || replace(sentence_ids, ',', ',,') || ',' AS rest, [] :: VARCHAR[] AS found FROM named"
    for name, wanted in [*licenses.RULES, *licenses.WORDING_RULES]:
        needle = "," + ",,".join(wanted) + ","
        step = (
            f"SELECT doc_id, n_sentences, sentence_ids, replace(rest, '{needle}', ',-,') AS rest, "
            f"CASE WHEN contains(rest, '{needle}') THEN list_append(found, '{name}') ELSE found END AS found FROM ({step})"
        )
    return rf"""
    WITH known(name, sentence) AS (VALUES {_KNOWN}),
    parts AS (
      SELECT doc_id, unnest(string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \t\r\f]+', '\1' || chr(10), 'g'), chr(10))) AS part,
        generate_subscripts(string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \t\r\f]+', '\1' || chr(10), 'g'), chr(10)), 1) AS i
      FROM documents),
    clean AS (SELECT doc_id, i, trim(lower(regexp_replace(part, '[^0-9A-Za-z\x{{80}}-\x{{10ffff}}]+', ' ', 'g'))) AS s FROM parts),
    named AS (
      SELECT doc_id, count(*) FILTER (s <> '') AS n_sentences, coalesce(string_agg(name, ',' ORDER BY i) FILTER (name IS NOT NULL), '') AS sentence_ids
      FROM clean LEFT JOIN known ON s = sentence GROUP BY doc_id)
    SELECT doc_id, n_sentences, sentence_ids, array_to_string(list_sort(list_distinct(found)), ',') AS licenses FROM ({step})
    """


# The letters U+00C0 to U+00FF, and one ASCII character for each, so that a byte is a letter.
_LATIN = "".join(map(chr, range(0xC0, 0x100)))
_PLAIN = "".join(c for c in map(chr, range(33, 127)) if not c.islower() and c not in "'\\")[:64]


def _spelling() -> str:
    """All pairs of words by edit distance; crc32 byte by byte, with a table made from its polynomial."""
    return rf"""
    WITH RECURSIVE bits(i, k, c) AS (
      SELECT i, 0, CAST(i AS BIGINT) FROM range(256) t(i)
      UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
    crc AS (SELECT list(c ORDER BY i) AS entries FROM bits WHERE k = 8),
    found AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
    folded AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k FROM found GROUP BY 1, 2),
    coded AS (SELECT *, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) AS code FROM folded),
    hashed AS (
      SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(code) // 2), lambda i: CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]))) AS h FROM coded, crc),
    slipped AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
    words AS MATERIALIZED (
      SELECT word, CAST(sum(k) AS BIGINT) AS n, length(word) AS size, translate(word, '{_LATIN}', '{_PLAIN}') AS plain
      FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
    near AS MATERIALIZED (
      SELECT a.word, b.word AS other, b.n AS other_n FROM words a JOIN words b ON b.size BETWEEN a.size - 1 AND a.size + 1 AND a.word <> b.word AND levenshtein(a.plain, b.plain) = 1),
    best AS (
      SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS form, first(other_n ORDER BY other_n DESC, encode(other)) AS form_n FROM near GROUP BY word),
    forms AS MATERIALIZED (
      SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)),
    way(word, root) AS (SELECT word, word FROM forms UNION ALL SELECT w.word, f.form FROM way w JOIN forms f ON w.root = f.word WHERE f.form IS NOT NULL),
    ends AS (SELECT w.word, w.root FROM way w JOIN forms f ON w.root = f.word WHERE f.form IS NULL)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
    """


_TERMS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

_TOKENS = r"coalesce(regexp_extract_all({}, '[^\x20\x09-\x0D]+'), [])"
_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op1_ngram_jaccard": rf"""
    WITH RECURSIVE d AS (SELECT doc_id, {_TOKENS.format(_FOLDED)} AS w FROM documents),
    s AS MATERIALIZED (
      SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS MATERIALIZED (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
    reach(a, b) AS (SELECT a, a FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    least_ids AS (SELECT a, min(b) AS least_id FROM reach GROUP BY 1),
    counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY 1)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least_id, d.doc_id) AS component_id, coalesce(n_links, 0) AS n_links
    FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_ids l ON l.a = d.doc_id LEFT JOIN counts c ON c.a = d.doc_id
    """,
    # A byte is two hexadecimal digits. Windows are cut from blocks, as taking one from a whole text walks up to it.
    "op2_run_length_index": """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    blocks AS (SELECT doc_id, start, substr(h, 2 * start + 1, 1122) AS part FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2, 512)) AS start FROM d)),
    windows AS MATERIALIZED (
      SELECT doc_id, start + i AS i, substr(part, 2 * i + 1, 100) AS bytes FROM (SELECT doc_id, start, part, unnest(range(0, least(512, length(part) // 2 - 49))) AS i FROM blocks)),
    least_ids AS (SELECT bytes, min(doc_id) AS least_id FROM windows GROUP BY 1),
    hits AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS last_i FROM windows JOIN least_ids USING (bytes) WHERE least_id < doc_id),
    numbered AS (SELECT doc_id, i, sum(CASE WHEN i <= last_i + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hits),
    spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, run),
    gaps AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS last_b FROM spans),
    cut AS (
      SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * last_b + 1, 2 * (a - last_b)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
      FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
    FROM d LEFT JOIN cut USING (doc_id)
    """,
    "op3_decontamination": rf"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
    windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b WHERE n > 0)),
    places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d, (SELECT DISTINCT n FROM windows))),
    hits AS (SELECT * FROM places JOIN windows USING (n, phrase)),
    words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op4_phrase_automata": rf"""
    WITH d AS (SELECT doc_id, {_TOKENS.format("text")} AS w FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS phrase FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
    later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY doc_id, i) > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
    words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
    kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op5_license_scan": _licenses(),
    "op7_redirect_equivalence": r"""
    WITH RECURSIVE u AS (
      SELECT page_id, url, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '(?s)^([^#]*)', 1) AS node FROM pages),
    tags AS (SELECT url, node, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM u WHERE contains(url, '://')),
    link AS (
      SELECT url, node, CASE WHEN regexp_matches(tag, '(?is)<link\b.*\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
        WHEN regexp_matches(tag, '(?is)<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?is)url\s*=\s*["'']?([^"''\s>]+)', 1) END AS l FROM tags),
    edge AS (
      SELECT node AS a, regexp_extract(CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN l WHEN starts_with(l, '//') THEN regexp_extract(url, '(?s)^(.*?):', 1) || ':' || l
        WHEN starts_with(l, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || l
        ELSE rtrim(regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)', 1), '/') || '/' || l END, '(?s)^([^#]*)', 1) AS b
      FROM (SELECT url, node, replace(l, '&amp;', '&') AS l FROM link) WHERE l <> ''),
    ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
    reach(a, b) AS (SELECT a, a FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
    rules(action, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
    all_urls AS (
      SELECT host, path, node FROM u UNION
      SELECT translate(regexp_extract(b, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), regexp_extract(b, '(?s)^.*?://[^/?#]*([^?#]*)', 1), b FROM edge),
    hits AS (
      SELECT w.host, w.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.action, length(r.host || r.path)) AS action
      FROM (SELECT DISTINCT host, path FROM all_urls) w JOIN rules r ON (w.host = r.host OR ends_with(w.host, '.' || r.host)) AND starts_with(w.path, r.path) GROUP BY 1, 2),
    passed AS (SELECT r.a AS node, min(h.action) AS action FROM reach r JOIN all_urls w ON w.node = r.b JOIN hits h USING (host, path) GROUP BY 1)
    SELECT page_id, u.host, u.path, h.rule, coalesce(h.action, p.action, 'allow') AS verdict
    FROM u LEFT JOIN hits h ON u.host = h.host AND u.path = h.path LEFT JOIN passed p ON u.node = p.node
    """,
    "op10_embedding_near_dedup": """
    WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
    reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
    n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY 1)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM comp LEFT JOIN n USING (vec_id)
    """,
    "op11_spelling_variants": _spelling(),
    "op13_ranked_search": rf"""
    WITH p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY 1, 2),
    docs AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY 1),
    total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
    w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, total GROUP BY term, n_docs),
    m AS (SELECT doc_id, 10 + (90 * n * n_docs) // n_terms AS m FROM docs, total),
    q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
    s AS (
      SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY 1, 2)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
    """,
}
