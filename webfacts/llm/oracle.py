"""DuckDB SQL for the queries that SQL can express.

Fingerprints, grammars, page markup, tokenization and compression are beyond
SQL, and DuckDB has no CRC-32; tests/llm compares those queries with
brute-force versions.
"""

from __future__ import annotations

from webfacts.llm.mixing import OFFSETS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_SHINGLE_JOIN = rf"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
shingled AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 2), lambda i:
            words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3]) END) AS grams
    FROM cut),
flat AS (SELECT doc_id, unnest(grams) AS gram FROM shingled),
sizes AS (SELECT doc_id, len(grams) AS n, list_sort(grams) AS grams FROM shingled),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM flat a JOIN flat b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * c >= 85 * (a.n + b.n - c)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, root) AS (
    SELECT doc_id, doc_id FROM sizes
    UNION SELECT w.y, r.root FROM reached r JOIN ways w ON w.x = r.doc_id)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, min(r.root) AS component_id,
    CASE WHEN s.n = 0 THEN 1 ELSE any_value(k.copies) END AS n_copies
FROM sizes s JOIN reached r ON r.doc_id = s.doc_id
JOIN (SELECT grams, count(*) AS copies FROM sizes GROUP BY grams) k ON k.grams = s.grams
GROUP BY s.doc_id, s.n
"""

_CONTROL = r"(?:/?INST\]|/?ROLE[ \]]|/?s>)"

_CHAT = rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
turns AS (
    SELECT *, CASE role WHEN 'user' THEN '[INST] ' WHEN 'assistant' THEN ' ' ELSE
            '[ROLE ' || replace(replace(role, '\', '\b'), ']', '\r') || '] ' END AS opening,
        CASE role WHEN 'user' THEN ' [/INST]' WHEN 'assistant' THEN '</s>' ELSE ' [/ROLE]' END AS closing,
        regexp_replace(text, '([\[<])(\\*{_CONTROL})', '\1\\\2', 'g') AS guarded
    FROM rows),
chats AS (
    SELECT *, bool_or(contains(text, closing) OR regexp_matches(text, '[\[<]\\+{_CONTROL}'))
        OVER (PARTITION BY conv_id) AS escaped
    FROM turns),
whole AS (
    SELECT conv_id, escaped, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
            FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(length(opening) + length(CASE WHEN escaped THEN guarded ELSE text END) + length(closing))
            AS formatted_chars
    FROM chats GROUP BY conv_id, escaped)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
    sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars, escaped
FROM whole
"""

_SEARCH = """
WITH weighted AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS weights
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.weights, r.weights)::BIGINT AS score
    FROM weighted q JOIN weighted r ON q.vec_id % 50 = 0 AND r.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored
QUALIFY rank <= 5
"""

_MIXTURE = rf"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        coalesce('=' || source, '~') AS skey, md5('9|' || coalesce(doc_id::VARCHAR, '~')) AS hash
    FROM documents),
sources AS (
    SELECT skey, source, sum(size)::BIGINT AS source_size FROM sized GROUP BY skey, source),
weighed AS (
    SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS w,
        source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS total
    FROM sources),
levels AS (
    SELECT *, cap / w AS rim,
        (total - coalesce(sum(cap) OVER before, 0.0::DOUBLE))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
    FROM weighed
    WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ended AS (
    SELECT *, level * w >= cap AS is_full,
        coalesce(arg_min(level, (rim, -level)) FILTER (WHERE NOT level * w >= cap) OVER (), 0.0) AS final
    FROM levels),
targets AS (
    SELECT skey, source_size, CASE WHEN is_full THEN cap ELSE least(cap, final * w) END AS target FROM ended),
ranked AS (
    SELECT s.*, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
        row_number() OVER (PARTITION BY s.skey ORDER BY
            length(size::VARCHAR), substr(size::VARCHAR, 1, 2), hash, size) AS rank
    FROM sized s JOIN targets t USING (skey)),
draws AS (
    SELECT skey, i, ('0x' || substr(md5('9|' || i || '|' || skey), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
    FROM sources, range({OFFSETS}) r(i)),
tried AS (
    SELECT r.skey, d.i, d.u, abs(sum((floor(u + rate * rank) - floor(u + rate * (rank - 1)))::BIGINT * size)
        - any_value(target)) AS off
    FROM ranked r JOIN draws d USING (skey) GROUP BY r.skey, d.i, d.u),
chosen AS (SELECT skey, arg_min(u, (off, i)) AS u FROM tried GROUP BY skey)
SELECT doc_id, size::BIGINT AS size, source_size, target,
    (floor(u + rate * rank) - floor(u + rate * (rank - 1)))::BIGINT * size AS taken,
    (floor(u + rate * rank) - floor(u + rate * (rank - 1)))::BIGINT AS copies, source
FROM ranked JOIN chosen USING (skey)
"""

_AUDIT = r"""
WITH rows AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
firsts AS (SELECT text, min(doc_id) AS first_id FROM rows GROUP BY text),
marks AS (
    SELECT doc_id, part, '' || CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(r.text, '[^A-Z]', '', 'g')) > 10 * length(r.text)
            THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(r.text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN first_id < doc_id THEN 'E' ELSE '' END AS fails
    FROM rows r JOIN firsts f ON f.text = r.text),
known AS (
    SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
    FROM labels GROUP BY doc_id),
kinds AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
    FROM marks LEFT JOIN known USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
    SELECT filter_order, step::INTEGER AS step, filter_order[step:step] AS own,
        filter_order[1:step - 1] AS before
    FROM orders, range(1, 6) r(step)),
removals AS (
    SELECT part, own, sum(n) AS shapley FROM kinds, steps
    WHERE contains(fails, own) AND translate(before, fails, '') = before GROUP BY ALL)
SELECT k.part, filter_order, step,
    sum(CASE WHEN translate(before || s.own, fails, '') = before || s.own THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN contains(fails, s.own) AND translate(before, fails, '') = before THEN n ELSE 0 END)::BIGINT
        AS removed,
    sum(CASE WHEN contains(fails, s.own) AND translate(before, fails, '') <> before THEN n ELSE 0 END)::BIGINT
        AS redundant,
    sum(CASE WHEN fails = s.own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN contains(fails, s.own) AND translate(before, fails, '') = before THEN good ELSE 0 END)::BIGINT
        AS good_lost,
    sum(CASE WHEN contains(fails, s.own) AND translate(before, fails, '') = before THEN toxic ELSE 0 END)::BIGINT
        AS toxic_lost,
    coalesce(any_value(shapley), 0)::BIGINT AS shapley
FROM kinds k CROSS JOIN steps s LEFT JOIN removals r ON r.part = k.part AND r.own = s.own
GROUP BY k.part, filter_order, step
"""


def _codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """SQL of the vector codes: rounds of assigning and moving, written out."""
    steps = [rf"""
WITH numbers AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
size AS (SELECT ceil(max(len(v)) / {parts})::BIGINT AS w FROM numbers),
keyed AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS k FROM numbers),
cut AS MATERIALIZED (
    SELECT k, part, list_transform(range(1, w + 1), lambda i: coalesce(v[part * w + i], 0)) AS p
    FROM keyed, size, range({parts}) r(part)),
book0 AS MATERIALIZED (SELECT part, (k - 1)::BIGINT AS entry, p AS e FROM cut WHERE k <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
    SELECT k, part, any_value(p) AS p, min(d) AS d, arg_min(entry, (d, entry)) AS entry
    FROM (SELECT c.k, c.part, c.p, b.entry, list_sum(list_transform(range(1, len(p) + 1),
            lambda i: (p[i] - e[i]) * (p[i] - e[i])))::BIGINT AS d
        FROM cut c JOIN book{i} b ON b.part = c.part)
    GROUP BY k, part)""")
        if i < rounds:
            steps.append(f"""sums{i} AS (
    SELECT part, entry, place, sum(p[place])::BIGINT AS s, count(*) AS n
    FROM near{i}, size, range(1, w + 1) r(place) GROUP BY ALL),
means{i} AS (
    SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY place) AS e FROM sums{i} GROUP BY part, entry),
book{i + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(m.e, b.e) AS e
    FROM book{i} b LEFT JOIN means{i} m ON m.part = b.part AND m.entry = b.entry)""")
    steps.append(f"""coded AS (
    SELECT k, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
    FROM near{rounds} GROUP BY k),
named AS (SELECT vec_id, label, code, error FROM coded JOIN keyed USING (k)),
digest AS (
    SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
    FROM book{rounds})
SELECT vec_id, label, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM named, digest
""")
    return ",\n".join(steps[:-1]) + ",\n" + steps[-1]


def oracle_sql() -> dict[str, str]:
    return {
        "op1_shingle_join": _SHINGLE_JOIN, "op5_chat_round_trip": _CHAT,
        "op6_exact_search": _SEARCH, "op9_mixture": _MIXTURE,
        "op11_vector_codes": _codes(), "op12_filter_audit": _AUDIT}
