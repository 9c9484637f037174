"""The query catalogue as SQL over the same tables, to compare results with.

Written on its own terms: sequential replacements for the markup, brute force
for retrieval, recursion for paths and phrase overlaps.
"""

from __future__ import annotations

from webfacts.constants import (
    BM25_B, BM25_K1, CONTRACTIONS, DROP_ELEMENTS, FEATURE_BRANCHES, NAN_COLUMNS,
    RELATION_DICTIONARY, SENTENCE_ENDS, STOP_WORDS, TOP_K)
from webfacts.functions.text import WORD
from webfacts.plans.inputs import KNOWN_RELATIONS, RULED_INTERCEPTS, RULED_LABELS


# Unicode blanks, inside a character class.
BLANK = (r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")


def _str(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_str(v) for v in values) + "]"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_str(v) for v in r) + ")" for r in rows)


# --- text pieces -----------------------------------------------------------

def _sub(expr: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({expr}, {_str(pattern)}, {_str(to)}, '{flags}')"


def _collapse(expr: str) -> str:
    return f"trim({_sub(expr, f'[{BLANK}]+', ' ')})"


def _sentences(expr: str) -> str:
    ends = SENTENCE_ENDS
    return f"regexp_extract_all({expr}, '[^{ends}]*[{ends}]+|[^{ends}]+', 0, 's')"


def _split_words(expr: str) -> str:
    """Lower-case ASCII letter words of a sentence, before stop words."""
    lowered = f"lower({_sub(expr, f'[^{WORD}]+', ' ')})"
    plain = (f"list_filter(string_split({lowered}, ' '), "
             r"lambda x: regexp_full_match(x, '[\x00-\x7F]+'))")
    letters = _sub(f"array_to_string({plain}, ' ')", "[^a-z]+", " ")
    for a, b in CONTRACTIONS:
        letters = _sub(letters, rf"\b{a}{b}\b", f"{a} {b}")
    return f"list_filter(string_split({letters}, ' '), lambda x: x <> '')"


def _clean_tokens(expr: str) -> str:
    return (f"list_filter({_split_words(expr)}, "
            f"lambda x: NOT list_contains({_list(STOP_WORDS)}, x))")


def _page_text(expr: str) -> str:
    out = _sub(expr, "<!--.*?-->", flags="gis")
    for e in DROP_ELEMENTS:
        out = _sub(out, rf"<{e}(\s[^>]*)?>.*?</{e}\s*>", flags="gis")
    out = _sub(out, "<[^>]*>", flags="gis")
    for name, ch in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&amp;", "&")):
        out = f"replace({out}, '{name}', '{ch}')"
    return _collapse(_sub(out, r"[\x01-\x1a\x{80}\x{90}|]+"))


def _words(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), '[{WORD}]{{2,}}')"


def _terms(expr: str, kind: str) -> str:
    if kind == "word":
        return _words(expr)
    if kind == "whitespace":
        return f"list_filter(regexp_split_to_array(lower({expr}), '[{BLANK}]+'), lambda x: x <> '')"
    return (f"list_transform([{_words(expr)}], lambda t: list_transform(range(1, len(t)), "
            "lambda i: t[i] || ' ' || t[i + 1]))[1]")


# --- derived inputs --------------------------------------------------------

_CTE = {
    "records": """SELECT 'WARC-Type: response' || chr(10)
          || CASE WHEN page_id % 10 = 0 THEN '' ELSE 'WARC-TREC-ID: page-' || page_id || chr(10) END
          || chr(10) || CASE WHEN page_id % 10 = 1 THEN html ELSE
             replace(html, '<!DOCTYPE html><html', '<!DOCTYPE html>' || chr(10) || '<html') END AS payload
        FROM pages""",
    "keyed": r"""SELECT payload,
          CASE WHEN regexp_matches(payload, '(?m)^WARC-TREC-ID')
               THEN string_split(regexp_extract(payload, '(?m)^WARC-TREC-ID([^\n]*)$', 1), ': ')[2] END AS id
        FROM records""",
    "bodies": r"""SELECT id, replace(html, chr(10), '') AS html FROM (
          SELECT id, regexp_extract(payload, '(?ms)^(<html.*)', 1) AS html FROM keyed WHERE id IS NOT NULL)
        WHERE html <> ''""",
    "page_sent": f"""SELECT id, unnest(range(len(s))) AS sent_no, unnest(s) AS org_text FROM (
          SELECT id, {_sentences(_page_text('html'))} AS s FROM bodies)""",
    "doc_sent": f"""SELECT doc_id, unnest(range(len(s))) AS sent_no, unnest(s) AS org_text FROM (
          SELECT doc_id, {_sentences(_collapse('text'))} AS s FROM documents)""",
    "clean": f"""SELECT 'doc-' || doc_id AS id, sent_no, org_text, {_clean_tokens('org_text')} AS toks
        FROM doc_sent""",
    "titles": """SELECT page_id, url, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS label FROM pages""",
    "anchors": """SELECT DISTINCT lower(a) AS alias FROM (
          SELECT unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS a FROM pages)
        WHERE regexp_full_match(a, '[A-Za-z]{4,}')""",
    "gaz": """SELECT * FROM (SELECT alias, ['PERSON', 'ORG', 'GPE', 'LOC', 'DATE'][length(alias) % 5 + 1] AS label
          FROM anchors) WHERE label <> 'DATE'""",
    "lex": """SELECT alias AS token, ['NOUN', 'PROPN', 'VERB'][length(alias) % 3 + 1] AS pos
        FROM anchors WHERE length(alias) <> 7""",
    "phrases": f"""SELECT DISTINCT alias FROM (
          SELECT alias FROM anchors UNION ALL
          SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM (
            SELECT {_clean_tokens('label')} AS t FROM titles))""",
    "phrase_gaz": """SELECT alias, label, n_words, list_aggregate(list(coalesce(pos, ' ') ORDER BY place), 'string_agg', '-') AS pos_tags
        FROM (SELECT alias, ['PERSON', 'ORG', 'GPE', 'LOC', 'DATE'][length(alias) % 5 + 1] AS label,
                len(string_split(alias, ' ')) AS n_words,
                unnest(string_split(alias, ' ')) AS token,
                unnest(range(len(string_split(alias, ' ')))) AS place FROM phrases) w
          LEFT JOIN lex USING (token)
        WHERE label <> 'DATE' GROUP BY alias, label, n_words""",
    "tokens": """SELECT id, sent_no, unnest(range(len(toks))) AS place, unnest(toks) AS token FROM clean""",
    "hits": """SELECT id, sent_no, place, alias, label, coalesce(pos, ' ') AS pos,
          row_number() OVER (PARTITION BY id, sent_no ORDER BY place) - 1 AS ent_no
        FROM tokens JOIN gaz ON token = alias LEFT JOIN lex USING (token)""",
    "phrase_hits": """SELECT *, row_number() OVER (PARTITION BY id, sent_no ORDER BY place, n_words DESC) AS rk FROM (
          SELECT id, sent_no, place, g.alias, label, pos_tags, n_words FROM tokens JOIN phrase_gaz g ON token = g.alias
          UNION ALL
          SELECT a.id, a.sent_no, a.place, g.alias, label, pos_tags, n_words
          FROM tokens a JOIN tokens b ON a.id = b.id AND a.sent_no = b.sent_no AND b.place = a.place + 1
            JOIN phrase_gaz g ON g.alias = a.token || ' ' || b.token)""",
    "walk": """SELECT id, sent_no, rk, place, place + n_words AS stop, true AS kept, alias, label, pos_tags
          FROM phrase_hits WHERE rk = 1
        UNION ALL
        SELECT h.id, h.sent_no, h.rk, h.place, CASE WHEN h.place >= w.stop THEN h.place + h.n_words ELSE w.stop END,
          h.place >= w.stop, h.alias, h.label, h.pos_tags
        FROM walk w JOIN phrase_hits h ON h.id = w.id AND h.sent_no = w.sent_no AND h.rk = w.rk + 1""",
    "ents": """SELECT id, sent_no, org_text, lower(org_text) AS low,
          list(alias ORDER BY place) AS names, list(label ORDER BY place) AS labels, list(pos ORDER BY place) AS tags
        FROM clean JOIN hits USING (id, sent_no) GROUP BY id, sent_no, org_text""",
    "spots": """SELECT id, sent_no, name, instr(low, name) AS p, low
        FROM (SELECT DISTINCT id, sent_no, low, unnest(names) AS name FROM ents) WHERE instr(low, name) > 0""",
    "first_spot": """SELECT id, sent_no, name AS n1, p AS p1, p + length(name) AS end1 FROM spots
        QUALIFY row_number() OVER (PARTITION BY id, sent_no ORDER BY p, length(name) DESC, name) = 1""",
    "second_spot": """SELECT * FROM (
          SELECT id, sent_no, name AS n2, CASE WHEN instr(substr(low, end1), name) > 0
            THEN instr(substr(low, end1), name) + end1 - 1 END AS p2
          FROM spots JOIN first_spot USING (id, sent_no) WHERE name <> n1)
        WHERE p2 IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY id, sent_no ORDER BY p2, length(n2) DESC, n2) = 1""",
    "marked": """SELECT id, sent_no, names, labels, tags,
          CASE WHEN length(low) <> length(org_text) OR n1 IS NULL THEN org_text
          WHEN n2 IS NULL THEN substr(org_text, 1, p1 - 1) || '<e1>' || substr(org_text, p1, length(n1)) || '</e1>'
            || substr(org_text, end1)
          ELSE substr(org_text, 1, p1 - 1) || '<e1>' || substr(org_text, p1, length(n1)) || '</e1>'
            || substr(org_text, end1, p2 - end1) || '<e2>' || substr(org_text, p2, length(n2)) || '</e2>'
            || substr(org_text, p2 + length(n2)) END AS labeled_text
        FROM ents LEFT JOIN first_spot USING (id, sent_no) LEFT JOIN second_spot USING (id, sent_no)""",
    "pairs": r"""SELECT id, labeled_text, names, labels, tags, min(sent_no) AS sent_no,
          replace(replace(replace(replace(labeled_text, '<e1>', ' '), '</e1>', ' '), '<e2>', ' '), '</e2>', ' ') AS sentence_string,
          trim(regexp_extract(labeled_text, '<e1>(.*)</e1>', 1)) AS e1,
          trim(regexp_extract(labeled_text, '<e2>(.*)</e2>', 1)) AS e2,
          trim(regexp_extract(labeled_text, '(.*)<e1>', 1)) AS before_e1,
          trim(regexp_extract(labeled_text, '</e1>(.*)<e2>', 1)) AS between_e1_e2,
          trim(regexp_extract(labeled_text, '</e2>(.*)', 1)) AS after_e2
        FROM marked WHERE len(names) >= 2 AND contains(labeled_text, '</e2>')
        GROUP BY id, labeled_text, names, labels, tags""",
    "parts": """SELECT *, e1 || ' ' || e2 AS e1_e2, string_split(e1, ' ')[1] AS head_e1,
          string_split(e2, ' ')[1] AS head_e2,
          string_split(e1, ' ')[1] || ' ' || string_split(e2, ' ')[1] AS head_e1_e2 FROM pairs""",
    "typed": """SELECT *,
          list_filter(range(1, len(names) + 1), lambda i: names[i] = lower(e1))[-1] AS i1,
          list_filter(range(1, len(names) + 1), lambda i: names[i] = lower(e2))[-1] AS i2,
          list_filter(range(1, len(names) + 1), lambda i: names[i] = e1)[-1] AS x1,
          list_filter(range(1, len(names) + 1), lambda i: names[i] = e2)[-1] AS x2
        FROM parts""",
    "ruled": f"""SELECT id, e1, e2, {_list([r for r, _, _ in RELATION_DICTIONARY] + ['Unheard of'])}
          [length(between_e1_e2) % {len(RELATION_DICTIONARY) + 1} + 1] AS preds FROM parts""",
    "dict": f"SELECT * FROM (VALUES {_values(RELATION_DICTIONARY)}) d(relation, relation_name, link)",
    "links": """SELECT id, entity, CASE WHEN length(entity) % 4 <> 2 THEN 'https://kb.example.org/' || entity END AS linking
        FROM (SELECT id, alias AS entity FROM hits) WHERE length(entity) % 4 <> 3""",
    "tree": """SELECT id || '-' || sent_no AS sent_id, unnest(range(len(toks))) + 1 AS pos, unnest(toks) AS token
        FROM clean WHERE len(toks) >= 4""",
    "parsed": """SELECT t.sent_id, t.pos, t.pos // 2 AS head, t.token,
          ['NOUN', 'PROPN', 'VERB'][length(t.token) % 3 + 1] AS tag, 'dep' || length(t.token) % 4 AS dep,
          h.token AS head_token
        FROM tree t LEFT JOIN tree h ON h.sent_id = t.sent_id AND h.pos = t.pos // 2""",
    "lists": """SELECT sent_id, list(token ORDER BY pos) AS words, list(tag ORDER BY pos) AS wtags FROM parsed GROUP BY sent_id""",
    "steps": """SELECT DISTINCT * FROM (
          SELECT sent_id, head_token AS src, token AS dst FROM parsed WHERE head_token IS NOT NULL
          UNION ALL SELECT sent_id, token, head_token FROM parsed WHERE head_token IS NOT NULL)
        WHERE src <> dst""",
    "kb": f"""SELECT page_id AS doc_id, url,
          CASE WHEN page_id % 25 <> 0 THEN regexp_extract(html, '(?s)<title>(.*?)</title>', 1) END AS title,
          CASE WHEN page_id % 50 <> 0 THEN {_page_text('html')} END AS text FROM pages""",
    "mentions": """SELECT DISTINCT mention FROM (SELECT alias AS mention FROM hits UNION ALL SELECT label FROM titles)""",
    "kb_docs": f"""SELECT doc_id, field, toks FROM (
          SELECT doc_id, 'title' AS field, regexp_extract_all(lower(title), '[{WORD}]+') AS toks FROM kb UNION ALL
          SELECT doc_id, 'text', regexp_extract_all(lower(text), '[{WORD}]+') FROM kb) WHERE len(toks) > 0""",
    "kb_sizes": "SELECT field, count(*) AS docs, avg(len(toks)) AS avg_len FROM kb_docs GROUP BY field",
    "kb_tf": """SELECT doc_id, field, len, term, count(*) AS tf FROM (
          SELECT doc_id, field, len(toks) AS len, unnest(toks) AS term FROM kb_docs) GROUP BY ALL""",
    "kb_idf": """SELECT field, term, ln(1 + (docs - df + 0.5) / (df + 0.5)) AS idf FROM (
          SELECT field, term, count(*) AS df FROM kb_tf GROUP BY ALL) JOIN kb_sizes USING (field)""",
    "kb_weights": f"""SELECT doc_id, field, term, idf * tf * {BM25_K1 + 1} /
          (tf + {BM25_K1} * (1 - {BM25_B} + {BM25_B} * len / avg_len)) AS weight
        FROM kb_tf JOIN kb_sizes USING (field) JOIN kb_idf USING (field, term)""",
    "mention_terms": f"""SELECT mention, term, count(*) AS qtf FROM (
          SELECT mention, unnest(regexp_extract_all(lower(regexp_replace(mention, '[^{WORD}{BLANK}]', '', 'g')), '[{WORD}]+')) AS term
          FROM mentions) GROUP BY ALL""",
    "field_scores": """SELECT mention, doc_id, field, round(sum(qtf * weight), 6) AS score
        FROM mention_terms JOIN kb_weights USING (term) GROUP BY ALL""",
    "cands": f"""SELECT *, row_number() OVER (PARTITION BY mention ORDER BY score DESC, doc_id) AS rank FROM (
          SELECT mention, doc_id, max(score) AS score FROM field_scores GROUP BY ALL)
        QUALIFY rank <= {TOP_K}""",
    "described": "SELECT mention, doc_id, score, rank, coalesce(title, text) AS label, url FROM cands JOIN kb USING (doc_id)",
    "char_counts": """SELECT s, ch, count(*) AS n FROM (
          SELECT s, unnest(string_split(s, '')) AS ch FROM (
            SELECT DISTINCT mention AS s FROM described UNION SELECT DISTINCT label FROM described))
        WHERE ch <> '' GROUP BY ALL""",
    "cosines": """SELECT mention, doc_id, rank, url, CASE WHEN mention = label THEN 1.0::DOUBLE
          ELSE round(coalesce(shared, 0) / sqrt(length(mention)::DOUBLE * length(label)), 9) END AS cosine
        FROM described LEFT JOIN (
          SELECT d.mention, d.label, sum(least(a.n, b.n))::BIGINT AS shared
          FROM (SELECT DISTINCT mention, label FROM described) d
            JOIN char_counts a ON a.s = d.mention JOIN char_counts b ON b.s = d.label AND b.ch = a.ch
          GROUP BY ALL) USING (mention, label)""",
    "best": """SELECT mention, url AS linking FROM cosines
        QUALIFY row_number() OVER (PARTITION BY mention ORDER BY cosine DESC, rank) = 1""",
    "hrefs": """SELECT page_id, unnest(range(len(a))) AS n, unnest(a) AS a, unnest(h) AS href FROM (
          SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS a,
            regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h FROM pages)""",
    "preds": """SELECT page_id, n, a, CASE WHEN (page_id + n) % 3 = 0 THEN href || 'x' ELSE href END AS href
        FROM hrefs WHERE (page_id + n) % 5 <> 0""",
    "gold_e": """SELECT 'page-' || page_id AS record, trim(a) AS string, href AS o FROM hrefs
        QUALIFY row_number() OVER (PARTITION BY page_id, trim(a) ORDER BY n DESC) = 1""",
    "gold_r": """SELECT 'page-' || page_id AS record, 'links to ' || n AS string, '/' AS s, href AS o, 'P1' AS rel_id
        FROM hrefs WHERE n % 2 = 0""",
    "pred_e": """SELECT 'page-' || page_id AS record, a AS string, o FROM (
          SELECT page_id, a, href AS o, n * 10 AS place FROM preds UNION ALL
          SELECT page_id, a, '/again', n * 10 + 2 FROM preds WHERE n % 4 = 1)
        QUALIFY row_number() OVER (PARTITION BY page_id, a ORDER BY place DESC) = 1""",
    "pred_r": """SELECT 'page-' || page_id AS record, 'links to ' || n AS string, '/' AS s, href AS o,
          CASE WHEN page_id % 2 = 0 THEN 'P1' END AS rel_id FROM preds WHERE n % 2 = 0""",
}

# What each derived input is made of, in dependency order.
_RECORDS = ["records", "keyed"]
_BODIES = [*_RECORDS, "bodies"]
_CLEAN = ["doc_sent", "clean"]
_HITS = [*_CLEAN, "anchors", "gaz", "lex", "tokens", "hits"]
_MARKED = [*_HITS, "ents", "spots", "first_spot", "second_spot", "marked"]
_PARTS = [*_MARKED, "pairs", "parts"]
_RULED = [*_PARTS, "ruled", "dict"]
_TREE = [*_CLEAN, "tree", "parsed"]
_KB = ["titles", *_HITS, "kb", "mentions", "kb_docs", "kb_sizes", "kb_tf", "kb_idf", "kb_weights",
       "mention_terms", "field_scores", "cands", "described"]
_SCORES = ["hrefs", "preds", "gold_e", "gold_r", "pred_e", "pred_r"]


def _query(parts: list[str], body: str, recursive: str = "") -> str:
    ctes = [f"{p} AS MATERIALIZED ({_CTE[p]})" if p != "walk" else f"walk AS ({_CTE[p]})" for p in parts]
    if recursive:
        ctes.append(recursive)
    head = "WITH RECURSIVE " if recursive or "walk" in parts else "WITH "
    return (head + ",\n".join(ctes) + "\n" if ctes else "") + body


def _tfidf(source: str, row: str, branches: str, total: str) -> str:
    """Weights of ``branches(row, branch, terms)``."""
    return f"""
      , b AS MATERIALIZED ({branches}),
      tf AS MATERIALIZED (SELECT {row}, branch, term, count(*) AS tf FROM (
        SELECT {row}, branch, unnest(terms) AS term FROM b) GROUP BY ALL),
      idf AS MATERIALIZED (SELECT branch, term, ln((1 + (SELECT count(*) FROM {total})) / (1 + count(*))) + 1 AS idf
        FROM tf GROUP BY ALL),
      w AS MATERIALIZED (SELECT {row}, branch, term, tf, tf * idf AS w FROM tf JOIN idf USING (branch, term))
      """


def _doc_tfidf(kind: str) -> str:
    return ("WITH d AS (SELECT doc_id, text FROM documents)" + _tfidf(
        "d", "doc_id", f"SELECT doc_id, 'text' AS branch, {_terms('text', kind)} AS terms FROM d", "d")
        + "SELECT doc_id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w")


_PATHS = """reach(sent_id, source, target, node, path, depth) USING KEY (sent_id, source, target, node) AS (
    SELECT sent_id, source, target, source, source, 0 FROM ends
    UNION
    SELECT r.sent_id, r.source, r.target, s.dst, min(r.path || ' ' || s.dst), min(r.depth) + 1
    FROM reach r JOIN steps s ON s.sent_id = r.sent_id AND s.src = r.node
      LEFT JOIN recurring.reach k ON k.sent_id = r.sent_id AND k.source = r.source
        AND k.target = r.target AND k.node = s.dst
    WHERE k.node IS NULL
    GROUP BY r.sent_id, r.source, r.target, s.dst)"""


def _path_query(parts: list[str], ends: str, body: str) -> str:
    ctes = [f"{p} AS MATERIALIZED ({_CTE[p]})" for p in parts]
    return ("WITH RECURSIVE " + ",\n".join([*ctes, f"ends AS MATERIALIZED ({ends})", _PATHS]) + "\n" + body)


_HEADS = [f"lower({_sub(f'head_e{n}', f'[^{WORD}{BLANK}]')})" for n in (1, 2)]

# The path between the entities of each part, the marks' words being ``source``
# and ``target``.
_PART_ENDS = f"""SELECT DISTINCT id || '-' || sent_no AS sent_id, {_HEADS[0]} AS source, {_HEADS[1]} AS target
    FROM parts"""
_PART_JOIN = f"""LEFT JOIN reach r ON r.sent_id = id || '-' || p.sent_no AND r.source = {_HEADS[0]}
    AND r.target = {_HEADS[1]} AND r.node = r.target"""
_PART_PATH = """CASE WHEN EXISTS (SELECT 1 FROM steps s WHERE s.sent_id = r.sent_id AND s.src = r.source)
    THEN coalesce(path, '') ELSE '' END AS shortest_path"""
_PART_TREE = [*_PARTS, "typed", "tree", "parsed", "steps"]
_BOTH_NER = ("CASE WHEN labels[{0}1] IS NOT NULL AND labels[{0}2] IS NOT NULL "
             "THEN labels[{0}1] || ' ' || labels[{0}2] END")


def _feature_row_query(body: str) -> str:
    """``r``: prediction features with a row digest; then ``body``."""
    columns = {
        **{c: c for c in ("e1", "e2", "e1_e2", "head_e1", "head_e2", "head_e1_e2", "before_e1",
                          "between_e1_e2", "after_e2", "sentence_string")},
        "e1_ner": "labels[i1]", "e2_ner": "labels[i2]", "e1_postag": "tags[i1]",
        "e2_postag": "tags[i2]", "e1_e2_ner": _BOTH_NER.format("i")}
    filled = ", ".join(
        f"coalesce({e}, 'nan') AS {c}" if c in NAN_COLUMNS else f"{e} AS {c}" for c, e in columns.items())
    rows = f"""r AS MATERIALIZED (SELECT md5(id || '|' || labeled_text || '|' || list_aggregate(list_transform(
          range(1, len(names) + 1), lambda i: names[i] || '/' || labels[i] || '/' || tags[i]), 'string_agg', ';')) AS row_id,
        {filled}, {_PART_PATH} FROM typed p {_PART_JOIN})"""
    unions = " UNION ALL ".join(
        f"SELECT row_id, '{name}' AS branch, {_terms(column, kind)} AS terms FROM r"
        for name, column, kind in FEATURE_BRANCHES)
    return (_path_query(_PART_TREE, _PART_ENDS, f", {rows}") + _tfidf("r", "row_id", unions, "r") + body)


def _ruled_predictions() -> str:
    classes = range(len(RULED_LABELS))
    sums = ", ".join(
        f"sum(w * ((length(term) * 7 + length(branch) * {3 + k} + {5 * k}) % 11 - 5) / 10.0::DOUBLE) AS d{k}"
        for k in classes)
    totals = ", ".join(f"sum(d{k} / norm) + {RULED_INTERCEPTS[k]}::DOUBLE" for k in classes)
    alone = ", ".join(f"{i}::DOUBLE" for i in RULED_INTERCEPTS)
    return _feature_row_query(f"""
      , parts_of AS (SELECT row_id, branch, sqrt(sum(w * w)) AS norm, {sums} FROM w GROUP BY ALL),
      scored AS (SELECT row_id, [{totals}] AS scores FROM parts_of GROUP BY row_id)
      SELECT row_id, {_list(RULED_LABELS)}[list_position(s, list_max(s))] AS preds
      FROM (SELECT row_id, coalesce(scores, [{alone}]) AS s FROM r LEFT JOIN scored USING (row_id))""")


def oracle_sql() -> dict[str, str]:
    """SQL per query; those that fit a model have none."""
    rendered = ("list_aggregate(list_transform(range(1, len(names) + 1), "
                "lambda i: names[i] || '/' || labels[i] || '/' || tags[i]), 'string_agg', ';')")
    both = "CASE WHEN labels[{0}1] IS NOT NULL AND labels[{0}2] IS NOT NULL THEN labels[{0}1] || ' ' || labels[{0}2] END AS e1_e2_ner"
    score = """SELECT g AS gold, p AS predicted, c AS correct, c / p AS precision, c / g AS recall,
      (c / p) * (c / g) / ((c / p) + (c / g)) * 2 AS f1 FROM (SELECT
      (SELECT count(*) FROM {0}) AS g, (SELECT count(*) FROM {1}) AS p,
      (SELECT count(*) FROM {0} a JOIN {1} b USING (record, string) WHERE {2}) AS c)"""
    return {
        "record_keys": _query(_RECORDS, "SELECT id FROM keyed WHERE id IS NOT NULL AND contains(payload, '<html')"),
        "html_bodies": _query(_BODIES, "SELECT id, md5(html) AS digest, length(html) AS n_chars FROM bodies"),
        "page_texts": f"SELECT page_id, {_page_text('html')} AS text FROM pages",
        "page_sentences": _query([*_BODIES, "page_sent"], f"""SELECT id, sent_no, org_text,
            array_to_string({_clean_tokens('org_text')}, ' ') AS text FROM page_sent"""),
        "doc_sentences": _query(["doc_sent"], "SELECT * FROM doc_sent"),
        "clean_sentences": _query(_CLEAN, "SELECT id, sent_no, array_to_string(toks, ' ') AS text FROM clean"),
        "stopword_anti_join": f"""SELECT doc_id, token, count(*) AS n FROM (
            SELECT doc_id, unnest({_split_words('text')}) AS token FROM documents)
            WHERE token NOT IN ({', '.join(_str(w) for w in STOP_WORDS)}) GROUP BY ALL""",
        "printable_text": r"""SELECT conv_id, turn, regexp_replace(text,
            '\p{C}|\p{Zl}|\p{Zp}|[\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]', '', 'g') AS text
            FROM conversations""",
        "archive_records": _query(_RECORDS, "SELECT id, md5(rtrim(payload, chr(10))) AS digest FROM keyed"),
        "labelled_blocks": f"""SELECT md5(trim({_collapse('text')}, '"')) AS digest,
            upper(lang[1]) || lang[2:] AS relation, 'e2,e1' AS direction FROM documents""",
        "stored_links": _query([*_HITS, "links"], "SELECT id, entity, linking FROM links"),
        "stored_relations": _query(_RULED, "SELECT id, e1, e2, preds FROM ruled"),
        "appended_lines": _query(["hrefs", "preds"], """SELECT 'page-' || page_id AS record, a AS string,
            CASE WHEN bool_or(n % 4 = 1) THEN '/again' ELSE arg_max(href, n) END AS entity
            FROM preds GROUP BY page_id, a"""),
        "stored_sentences": _query(_CLEAN, "SELECT id, sent_no, md5(org_text) AS digest FROM clean"),
        "label_file": _query(["titles"], "SELECT label, arg_max(url, page_id) AS url FROM titles GROUP BY label"),
        "known_relation_file": _query(["hrefs"], """SELECT 'links to ' || n AS label, '/' AS subject_url,
            href AS object_url, 'P1' AS relation_url FROM hrefs WHERE n % 2 = 0"""),
        "relation_file": _query(_RULED, """SELECT preds, relation_name, link, count(*) AS n
            FROM ruled LEFT JOIN dict ON preds = relation GROUP BY ALL"""),
        "entities_flat": _query(_HITS, "SELECT id, sent_no, ent_no, alias AS text, label FROM hits"),
        "entities_multiword": _query(
            [*_CLEAN, "titles", "anchors", "lex", "phrases", "phrase_gaz", "tokens", "phrase_hits", "walk"],
            """SELECT id, sent_no, row_number() OVER (PARTITION BY id, sent_no ORDER BY place) - 1 AS ent_no,
            alias AS text, label, pos_tags FROM walk WHERE kept"""),
        "entity_arrays": _query([*_HITS, "ents"], f"""SELECT id, sent_no, coalesce({rendered}, '') AS entity
            FROM clean LEFT JOIN ents USING (id, sent_no)"""),
        "pos_strings": _query(["titles", "anchors", "lex", "phrases", "phrase_gaz"],
            "SELECT alias, pos_tags, n_words FROM phrase_gaz"),
        "token_pos": _query([*_TREE], "SELECT sent_id, token, arg_max(tag, pos) AS pos FROM parsed GROUP BY sent_id, token"),
        "distinct_entities": _query([*_HITS, "ents"], """SELECT DISTINCT id, array_to_string(list_filter(names,
            lambda x, i: list_position(names, x) = i), ';') AS entities FROM ents"""),
        "marked_pairs": _query(_MARKED, "SELECT id, sent_no, labeled_text FROM marked"),
        "sql_marked_pairs": _query(_MARKED, "SELECT id, sent_no, labeled_text FROM marked"),
        "label_containment": _query([*_RECORDS, "titles"], """SELECT id, label, url FROM keyed JOIN (
            SELECT label, arg_max(url, page_id) AS url FROM titles GROUP BY label)
            ON contains(payload, label) WHERE id <> '' AND label <> ''"""),
        "attached_relations": _query(_RECORDS, f"""SELECT id, subject_url, object_url, label, relation_url
            FROM keyed, (VALUES {_values(KNOWN_RELATIONS)}) r(label, subject_url, object_url, relation_url)
            WHERE id <> ''"""),
        "escaped_queries": _query(["titles"], f"SELECT page_id, {_sub('label', f'[^{WORD}{BLANK}]')} AS query FROM titles"),
        "kb_candidates": _query(_KB, "SELECT mention, doc_id, label, url, score FROM described"),
        "char_cosine_rank": _query([*_KB, "char_counts", "cosines"], "SELECT mention, doc_id, cosine FROM cosines"),
        "word_cosine": r"""WITH p AS (SELECT a.conv_id, a.turn,
              list_filter(regexp_split_to_array(a.text, '\s+'), lambda x: x <> '') AS u,
              list_filter(regexp_split_to_array(b.text, '\s+'), lambda x: x <> '') AS v
            FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
          s AS (SELECT conv_id, turn, sum(least(n, m)) AS shared FROM
              (SELECT conv_id, turn, w, count(*) AS n FROM (SELECT conv_id, turn, unnest(u) AS w FROM p) GROUP BY ALL)
              JOIN (SELECT conv_id, turn, w, count(*) AS m FROM (SELECT conv_id, turn, unnest(v) AS w FROM p) GROUP BY ALL)
              USING (conv_id, turn, w) GROUP BY ALL)
          SELECT conv_id, turn, CASE WHEN u = v THEN 1.0::DOUBLE WHEN len(u) = 0 OR len(v) = 0 THEN 0.0::DOUBLE
            ELSE round(coalesce(shared, 0)::DOUBLE / sqrt(len(u)::DOUBLE * len(v)), 9) END AS score
          FROM p LEFT JOIN s USING (conv_id, turn)""",
        "entity_links": _query([*_KB, "char_counts", "cosines", "best"], """SELECT id, alias AS entity, linking
            FROM hits LEFT JOIN best ON mention = alias"""),
        "marked_parts": _query(_PARTS, """SELECT id, labeled_text, sentence_string, e1, e2, e1_e2, head_e1,
            head_e2, head_e1_e2, before_e1, between_e1_e2, after_e2 FROM parts"""),
        "quoted_lines": f"""SELECT md5(t) AS digest, length(t) AS n_chars FROM (
            SELECT trim({_collapse('text')}, '"') AS t FROM documents)""",
        "entity_types": _query([*_PARTS, "typed"], f"""SELECT id, labeled_text, labels[i1] AS e1_ner,
            labels[i2] AS e2_ner, tags[i1] AS e1_postag, tags[i2] AS e2_postag, {both.format('i')} FROM typed"""),
        "train_entity_types": _query([*_PARTS, "typed"], f"""SELECT id, labeled_text, labels[x1] AS e1_ner,
            labels[x2] AS e2_ner, {both.format('x')} FROM typed"""),
        "train_entity_pos": _query([*_PARTS, "tree", "parsed", "lists"], """SELECT id || '-' || sent_no AS sent_id, labeled_text,
            wtags[list_filter(range(1, len(words) + 1), lambda i: contains(words[i], e1))[-1]] AS e1_postag,
            wtags[list_filter(range(1, len(words) + 1), lambda i: contains(words[i], e2) AND NOT contains(words[i], e1))[-1]] AS e2_postag
            FROM parts LEFT JOIN lists ON sent_id = id || '-' || sent_no"""),
        "relation_labels": _query(_RULED, r"""SELECT id,
              relation || coalesce('**' || direction, '') AS input_relation,
              relation, coalesce(direction, 'nan') AS direction, relation || ' ' || coalesce(direction, 'nan') AS label
            FROM (SELECT id, CASE WHEN preds LIKE '% e_,e_' THEN left(preds, length(preds) - 6)
                WHEN preds = 'Other nan' THEN 'Other' ELSE preds END AS relation,
              CASE WHEN preds LIKE '% e_,e_' THEN right(preds, 5) END AS direction FROM ruled)"""),
        "clean_pair_sentence": _query(_PARTS, f"""SELECT id, labeled_text, replace(replace(sentence_string, e1,
            {_sub('e1', f'[^{WORD}{BLANK}]')}), e2, {_sub('e2', f'[^{WORD}{BLANK}]')}) AS sentence FROM parts"""),
        "connecting_paths": _path_query(
            [*_TREE, "steps"],
            "SELECT sent_id, arg_min(token, pos) AS source, arg_max(token, pos) AS target FROM parsed GROUP BY sent_id",
            """SELECT e.sent_id, e.source, e.target, coalesce(path, '') AS path FROM ends e
            LEFT JOIN reach r ON r.sent_id = e.sent_id AND r.node = e.target"""),
        "token_lists": _query(_TREE, """SELECT sent_id, string_agg(token || '/' || tag || '/' ||
            coalesce(head_token, token) || '/' || dep, ' ' ORDER BY pos) AS parse_list FROM parsed GROUP BY sent_id"""),
        "feature_rows": _query([*_PARTS, "typed"], f"""SELECT labeled_text AS input_sentence, 'nan' AS input_relation, id,
            e1, e2, e1_e2, head_e1, head_e2, head_e1_e2, before_e1, between_e1_e2, after_e2,
            labels[i1] AS e1_ner, labels[i2] AS e2_ner, tags[i1] AS e1_postag, tags[i2] AS e2_postag,
            {both.format('i')}, 'nan' AS relation, 'nan' AS direction, sentence_string, '' AS shortest_path FROM typed"""),
        "feature_paths": _path_query(_PART_TREE, _PART_ENDS, f"""SELECT id || '-' || p.sent_no AS sent_id,
            labeled_text, e1, e2, {_PART_PATH} FROM parts p {_PART_JOIN}"""),
        "prediction_features": _path_query(_PART_TREE, _PART_ENDS, f"""SELECT labeled_text AS input_sentence,
            'nan' AS input_relation, id, e1, e2, e1_e2, head_e1, head_e2, head_e1_e2, before_e1, between_e1_e2, after_e2,
            coalesce(labels[i1], 'nan') AS e1_ner, coalesce(labels[i2], 'nan') AS e2_ner,
            coalesce(tags[i1], 'nan') AS e1_postag, coalesce(tags[i2], 'nan') AS e2_postag,
            coalesce({_BOTH_NER.format('i')}, 'nan') AS e1_e2_ner,
            'nan' AS relation, 'nan' AS direction, sentence_string, {_PART_PATH} FROM typed p {_PART_JOIN}"""),
        "training_features": _path_query([*_PART_TREE, "lists"], _PART_ENDS, f"""SELECT labeled_text AS input_sentence,
            CASE WHEN quality = 0 THEN 'Other' WHEN toxic = 1 THEN 'Cause-Effect**e2,e1' ELSE 'Cause-Effect**e1,e2' END AS input_relation,
            id, e1, e2, e1_e2, head_e1, head_e2, head_e1_e2, before_e1, between_e1_e2, after_e2,
            coalesce(labels[x1], 'nan') AS e1_ner, coalesce(labels[x2], 'nan') AS e2_ner,
            coalesce(wtags[list_filter(range(1, len(words) + 1), lambda i: contains(words[i], e1))[-1]], 'nan') AS e1_postag,
            coalesce(wtags[list_filter(range(1, len(words) + 1),
              lambda i: contains(words[i], e2) AND NOT contains(words[i], e1))[-1]], 'nan') AS e2_postag,
            coalesce({_BOTH_NER.format('x')}, 'nan') AS e1_e2_ner,
            CASE WHEN quality = 0 THEN 'Other' ELSE 'Cause-Effect' END AS relation,
            CASE WHEN quality = 0 THEN 'nan' WHEN toxic = 1 THEN 'e2,e1' ELSE 'e1,e2' END AS direction,
            sentence_string, {_PART_PATH}
            FROM typed p JOIN (SELECT 'doc-' || doc_id AS id, quality, toxic FROM labels) USING (id)
            LEFT JOIN lists l ON l.sent_id = id || '-' || p.sent_no {_PART_JOIN}"""),
        "tfidf_words": _doc_tfidf("word"),
        "tfidf_whitespace": _doc_tfidf("whitespace"),
        "tfidf_bigrams": _doc_tfidf("bigram"),
        "tfidf_branches": _feature_row_query("""SELECT row_id, branch, term,
            round(w / sqrt(sum(w * w) OVER (PARTITION BY row_id, branch)), 6) AS weight FROM w"""),
        "ruled_predictions": _ruled_predictions(),
        "union_labelled": "SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id) WHERE quality IN (0, 1)",
        "split_md5": """SELECT doc_id, CASE WHEN ('0x' || left(md5(doc_id::VARCHAR), 8))::BIGINT::DOUBLE / 4294967296.0 < 0.7
            THEN 'train' ELSE 'test' END AS part FROM documents""",
        "split_exact": """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('=' || doc_id::VARCHAR))
              <= ceil(0.3 * (SELECT count(*) FROM documents)) THEN 'test' ELSE 'train' END AS part FROM documents""",
        "relation_links": _query(_RULED, """SELECT id, e1, e2, preds, relation_name, link
            FROM ruled LEFT JOIN dict ON preds = relation"""),
        "result_lines": _query([*_RULED, "links"], r"""SELECT unnest([
              'ENTITY: ' || id || chr(9) || e1 || chr(9) || l1,
              'ENTITY: ' || id || chr(9) || e2 || chr(9) || l2,
              'RELATION: ' || id || chr(9) || l1 || chr(9) || l2 || chr(9) || coalesce(relation_name, 'nan')
                || chr(9) || coalesce(link, 'nan')]) AS value
            FROM (SELECT r.id, e1, e2, coalesce(a.linking, 'None') AS l1, coalesce(b.linking, 'None') AS l2,
                relation_name, link
              FROM ruled r LEFT JOIN dict ON preds = relation
                JOIN (SELECT DISTINCT * FROM links) a ON a.id = r.id AND a.entity = lower(e1)
                JOIN (SELECT DISTINCT * FROM links) b ON b.id = r.id AND b.entity = lower(e2))"""),
        "one_link_per_entity": _query([*_HITS, "links"], "SELECT DISTINCT id, entity, linking FROM links"),
        "link_lookup": _query([*_HITS, "links"], """SELECT entity, linking, id FROM links
            WHERE (id, entity) = (SELECT (id, entity) FROM links ORDER BY id DESC, entity DESC LIMIT 1)"""),
        "gold_rows": _query(_SCORES, """SELECT record, string, o, NULL::VARCHAR AS rel_id FROM gold_e
            UNION ALL SELECT record, string, o, rel_id FROM gold_r"""),
        "pred_rows": _query(_SCORES, """SELECT record, string, o, NULL::VARCHAR AS rel_id FROM pred_e
            UNION ALL SELECT record, string, o, rel_id FROM pred_r"""),
        "score_entities": _query(_SCORES, score.format("gold_e", "pred_e", "a.o = b.o")),
        "score_relations": _query(_SCORES, score.format("gold_r", "pred_r", "a.o = b.o AND a.s = b.s")),
    }
