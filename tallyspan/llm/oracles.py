"""DuckDB SQL for the queries that SQL can express."""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP4 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, i, ['user', 'assistant'][i + 1], '\### Assistant: </turn> ok' FROM range(2) r(i)
),
sized AS (
    SELECT *, row_number() OVER o AS n, count(*) OVER (PARTITION BY conv_id) AS total,
        sum(15 + length(regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g'))
            + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g'))) OVER o AS upto
    FROM (SELECT * FROM turns)
    WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(upto) FILTER (role = 'assistant' OR n = total)::BIGINT AS formatted_chars,
    count(*) FILTER (role = 'assistant' OR n = total) AS n_examples
FROM sized GROUP BY conv_id
"""

OP5 = r"""
WITH RECURSIVE lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
    FROM documents
),
counted AS (SELECT doc_id, i, md5(s) AS k, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) AS n FROM lines),
runs AS (
    SELECT doc_id, i, 1::BIGINT AS h, k, n FROM (SELECT *, count(*) OVER (PARTITION BY k) AS copies FROM counted) WHERE copies > 1
    UNION ALL
    SELECT doc_id, i, h, k, n FROM (
        SELECT r.doc_id, r.i, r.h + 1 AS h, md5(r.k || c.k) AS k, r.n + c.n AS n,
            count(*) OVER (PARTITION BY md5(r.k || c.k)) AS copies
        FROM runs r JOIN counted c ON c.doc_id = r.doc_id AND c.i = r.i + r.h
    ) WHERE copies > 1
),
later AS (
    SELECT doc_id, i, h FROM (
        SELECT doc_id, i, h, row_number() OVER (PARTITION BY h, k ORDER BY doc_id, i) AS copy FROM runs WHERE n >= 10
    ) WHERE copy > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + h)) AS i FROM later)
SELECT documents.doc_id, coalesce(any_value(c.n_lines), 0)::BIGINT AS n_lines,
    coalesce(any_value(c.n_removed), 0)::BIGINT AS n_removed, coalesce(any_value(c.n_runs), 0)::BIGINT AS n_runs,
    CASE WHEN any_value(text) IS NOT NULL THEN sha256(coalesce(any_value(c.kept), '')) END AS kept_sha256
FROM documents LEFT JOIN (
    SELECT doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
        count(g.i) FILTER (g.i IS NOT NULL AND before IS NULL) AS n_runs,
        string_agg(s, chr(10) ORDER BY l.i) FILTER (g.i IS NULL) AS kept
    FROM lines l LEFT JOIN gone g USING (doc_id, i)
        LEFT JOIN (SELECT doc_id AS d, i AS before FROM gone) ON d = doc_id AND before = l.i - 1
    GROUP BY doc_id
) c USING (doc_id) GROUP BY documents.doc_id
"""

OP8 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS m,
        array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT m FROM windows),
starts AS (
    SELECT r, m, i, array_to_string(w[i : i + m - 1], ' ') AS s
    FROM (SELECT r, w, m, unnest(range(1, greatest(len(w) - m + 1, 0) + 1)) AS i FROM docs, lengths)
),
found AS (SELECT r, i, m, item FROM starts JOIN windows USING (m, s)),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM found) GROUP BY r),
owners AS (SELECT r, list_sort(list_distinct(list(item))) AS items FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(len(items), 0)::BIGINT AS n_items,
    sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN places USING (r) LEFT JOIN owners USING (r)
"""


OP9 = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
parts AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN parts ON parts.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""


OP10 = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + 4], ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a, b FROM (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
    ) JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 85 * (x.n + y.n - common)
),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM docs
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM reach JOIN docs ON doc_id = a LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


OP11 = """
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
),
numbers AS (
    SELECT *, len(u) AS n, [CAST('0x' || h[8 * i - 7 : 8 * i] AS BIGINT) for i in range(1, 5)] AS k FROM units
),
cuts AS (SELECT *, least(k[1] % (n + 1), k[2] % (n + 1)) AS a, greatest(k[1] % (n + 1), k[2] % (n + 1)) AS b FROM numbers),
parts AS (
    SELECT *, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 :], '') AS s,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR k[3] % 100 >= 90 THEN 'plain'
            WHEN k[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
"""


OP13 = """
WITH RECURSIVE bits AS (
    SELECT i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i)
    UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
numbers AS (
    SELECT row_number() OVER () AS r, documents.*, list_reduce(
        list_prepend(4294967295, [CAST(ascii(x) AS BIGINT) for x in string_split(CAST(doc_id AS VARCHAR), '')]),
        lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])) AS c
    FROM documents, crc
),
heads AS (
    SELECT r, doc_id, text, coalesce('=' || source, '') AS tree, xor(c, 4294967295) % 5 = 0 AS hit,
        array_to_string([CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END
            for v in [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)]], '') AS h
    FROM numbers
),
hashed AS (
    SELECT r, doc_id, tree, sha256(h || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN hit THEN sha256(h || coalesce(strlen(text) || ':'
            || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed
    FROM heads
),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
        count(*) OVER (PARTITION BY tree) AS n FROM hashed
),
lower_levels AS (
    SELECT tree, 0 AS level, idx, n, leaf AS digest FROM leaves
    UNION ALL
    SELECT tree, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
    FROM lower_levels WHERE n > 1 GROUP BY tree, level, n, idx // 16
),
subroots AS (SELECT tree, level, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM lower_levels WHERE n = 1),
upper_levels AS (
    SELECT '^' AS tree, 0 AS level, idx, n, digest FROM subroots
    UNION ALL
    SELECT tree, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
    FROM upper_levels WHERE n > 1 GROUP BY tree, level, n, idx // 16
),
top AS (SELECT digest AS root FROM upper_levels WHERE n = 1),
nodes AS (
    SELECT tree, level, idx, tree AS own_tree, level AS own_level, idx AS own_idx, n, digest FROM lower_levels
    UNION ALL
    SELECT u.tree, u.level, u.idx, coalesce(s.tree, u.tree), coalesce(s.level, u.level),
        CASE WHEN s.tree IS NULL THEN u.idx ELSE 0 END, u.n, u.digest
    FROM upper_levels u LEFT JOIN subroots s ON u.level = 0 AND u.idx = s.idx
),
links AS (
    SELECT own_tree, own_level, own_idx, tree, level + 1 AS level, idx // 16 AS idx,
        coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY tree, level, idx // 16 ORDER BY idx)
),
climb AS (
    SELECT r, tree, CAST(0 AS BIGINT) AS level, idx, coalesce(changed, leaf) AS folded, '' AS siblings FROM leaves
    UNION ALL
    SELECT r, l.tree, l.level, l.idx, sha256(before || folded || after), siblings || before || after
    FROM climb JOIN links l ON own_tree = climb.tree AND own_level = climb.level AND own_idx = climb.idx
),
ways AS (SELECT r, arg_max(folded, length(siblings) + level + 100000 * (tree = '^')::INT) AS folded,
    arg_max(siblings, length(siblings) + level + 100000 * (tree = '^')::INT) AS siblings FROM climb GROUP BY r)
SELECT doc_id, leaf, digest AS subroot, root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaves JOIN ways USING (r) JOIN subroots USING (tree), top
"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {"op4_chat_formatting": OP4, "op5_line_dedup": OP5, "op8_benchmark_decontamination": OP8, "op9_embedding_near_dedup": OP9, "op10_minhash_near_dedup": OP10, "op11_fill_in_middle": OP11, "op13_merkle_manifest": OP13}
