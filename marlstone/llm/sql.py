"""SQL that gives the same rows as a registered query, where SQL can and is quick enough on whole tables."""

QUALITY = r"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
    FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS x
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)),
twice AS (SELECT doc_id, i FROM windows
    QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY doc_id),
counts AS (
    SELECT doc_id, text, w, len(w)::BIGINT AS n_words,
        length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper,
        length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters,
        len(list_filter(w, lambda x: NOT regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS bare
    FROM words LEFT JOIN covered USING (doc_id)),
judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 10 * n_symbols <= n_words AND 10 * n_dup_lines <= 4 * n_lines
        AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 2 * upper <= letters
        AND 10 * bare <= 3 * n_words AS kept
FROM judged
"""

URLS = r"""
WITH cut AS (
    SELECT page_id,
        CASE WHEN instr(url, '://') > 0
            THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '/.*$', 0, 's') AS path
    FROM cut),
rules(rule, own_host, own_path, verdict) AS (
    VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
        ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fits AS (
    SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
    FROM parts JOIN rules
        ON (host = own_host OR ends_with(host, '.' || own_host)) AND starts_with(path, own_path)
    GROUP BY page_id),
globs(g, host_like, path_like) AS (
    VALUES ('*.spam-*/**', '%.spam-%', '%'), ('*.cheap-*/**', '%.cheap-%', '%'),
        ('*-pills.*/**', '%-pills.%', '%'), ('*.casino-*/**', '%.casino-%', '%'),
        ('*.casino.*/**', '%.casino.%', '%'), ('*.xxx.*/**', '%.xxx.%', '%'),
        ('*//wp-login.php**', '%', '/wp-login.php%'), ('*//cgi-bin/**', '%', '/cgi-bin/%')),
spam AS (
    SELECT page_id, arg_max(g, length(g)) AS g
    FROM parts JOIN globs ON '.' || host LIKE host_like AND path LIKE path_like
    GROUP BY page_id)
SELECT p.page_id, host, path, f.rule,
    coalesce(f.verdict, CASE WHEN s.g IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
    CASE WHEN f.rule IS NULL THEN s.g END AS "glob"
FROM parts p LEFT JOIN fits f USING (page_id) LEFT JOIN spam s USING (page_id)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda w: w <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
    FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY 1, 2
    HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
    doc_id <= coalesce(b, doc_id) AS kept
FROM sets LEFT JOIN least_of ON doc_id = a
"""

# The CRC of a decimal number, bit by bit.
_CRC = """xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda a, b: list_reduce(CAST(range(8) AS BIGINT[]),
        lambda v, i: xor(v >> 1, (v & 1) * 3988292384), xor(a, b)), CAST(4294967295 AS BIGINT)), 4294967295)"""

TRIE = f"""
WITH convs AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, role, text) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT *, {_CRC} % 9 AS h, conv_id - ((conv_id % 5) + 5) % 5 AS base FROM convs),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns, [])[:c.h], c.turns[c.h + 1:]) AS turns
    FROM heads c LEFT JOIN convs b ON b.conv_id = c.base),
members AS (
    SELECT conv_id, len(turns) AS length, d AS depth, turns[:d] AS path
    FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
            FILTER (depth = length), '') AS ends
    FROM members GROUP BY path, depth),
kids AS (SELECT path[:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
    SELECT t.path, count(*) FILTER (k.n IS NULL) AS n_leaves,
        sum((n.n_convs - 1) * coalesce(octet_length(encode(n.path[n.depth].text)), 0)) AS saved
    FROM nodes t JOIN nodes n ON n.path[:t.depth] = t.path AND n.depth >= t.depth
    LEFT JOIN kids k ON k.path = n.path GROUP BY t.path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
    b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN kids k ON k.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:n.depth - 1]
"""

CHAT = r"""
WITH every AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM every),
written AS (
    SELECT *, '<turn ' || regexp_replace(role, '([\\<>])', '\\\1', 'g') || '>' || chr(10)
        || regexp_replace(text, '([\\<>])', '\\\1', 'g') || '</turn>' || chr(10) AS piece
    FROM turns),
joined AS (
    SELECT conv_id, count(*) AS n_turns, sum(length(piece)) AS formatted_chars,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
            FILTER (role = 'assistant'), '') AS loss
    FROM written GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars,
    sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""
