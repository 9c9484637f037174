"""The sentence, marking and similarity helpers as SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from webfacts.constants import CONTRACTIONS, SENTENCE_ENDS, STOP_WORDS
from webfacts.functions.text import BLANK, UNICODE, WORD


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _mark_pair() -> str:
    """The marker over ``t`` and ``names``: the first name that starts first, the
    second that starts first after it."""
    def earliest(start: str, skip: str = "") -> str:
        spans = (f"transform(own, e -> named_struct('at', position(e, low, {start}), 'neg', -length(e), 'name', e))")
        return f"array_min(filter({spans}, s -> s.at > 0{skip}))"

    folded = ("CASE WHEN length(lower(t)) = length(t) THEN lower(t) ELSE array_join(transform(split(t, ''), "
              "c -> CASE WHEN length(lower(c)) = 1 THEN lower(c) ELSE c END), '') END")
    second = ("concat(substring(t, x.at - x.neg, y.at - x.at + x.neg), '<e2>', substring(t, y.at, -y.neg), '</e2>', "
              "substring(t, y.at - y.neg, length(t)))")
    tail = _let(earliest("x.at - x.neg", " AND s.name <> x.name"), "y",
                f"CASE WHEN y IS NULL THEN substring(t, x.at - x.neg, length(t)) ELSE {second} END")
    whole = (f"CASE WHEN x IS NULL THEN t ELSE concat(substring(t, 1, x.at - 1), '<e1>', "
             f"substring(t, x.at, -x.neg), '</e1>', {tail}) END")
    marked = f"CASE WHEN t IS NULL OR size(own) < 1 THEN t ELSE {_let(earliest('1'), 'x', whole)} END"
    return _let(folded, "low", _let("filter(array_distinct(names), e -> e <> '')", "own", marked))


def register(spark: SparkSession) -> list[str]:
    """Create ``collapse_blanks``, ``cut_sentences``, ``clean_sentence``, ``char_cosine`` and
    ``mark_pair`` as temporary SQL functions and ``sentence_rows`` as one that
    gives a table: expressions, so Catalyst sees through them."""
    ends = SENTENCE_ENDS
    gaps = "|".join(rf"(?<=\b{a})(?={b}\b)" for a, b in CONTRACTIONS)
    stop = ", ".join(_quoted(w) for w in STOP_WORDS)
    words = f"lower(regexp_replace(t, {_quoted(f'[^{WORD}]+')}, ' '))"
    ascii_words = rf"regexp_replace({words}, {_quoted(r'[!-~]*[^\x00-\x7F][^ ]*')}, '')"
    letters = f"regexp_replace({ascii_words}, '[^a-z]+', ' ')"
    shared = ("aggregate(array_distinct(split(a, '')), 0, (n, ch) -> n + if(ch = '', 0, least("
              "length(a) - length(replace(a, ch, '')), length(b) - length(replace(b, ch, '')))))")
    collapsed = f"trim(regexp_replace(t, {_quoted(f'{UNICODE}[{BLANK}]+')}, ' '))"
    cut = lambda whole: (
        f"array_remove(split({whole}, {_quoted(f'(?<=[{ends}])(?=[^{ends}])')}), '')")
    bodies = {
        "collapse_blanks(t STRING) RETURNS STRING":
            collapsed,
        "cut_sentences(t STRING) RETURNS ARRAY<STRING>":
            cut("t"),
        "clean_sentence(t STRING) RETURNS STRING":
            f"array_join(filter(split(regexp_replace({letters}, {_quoted(gaps)}, ' '), ' '), "
            f"w -> w <> '' AND w NOT IN ({stop})), ' ')",
        "char_cosine(a STRING, b STRING) RETURNS DOUBLE":
            f"CASE WHEN a = b THEN 1.0D WHEN a = '' OR b = '' THEN 0.0D "
            f"ELSE {shared} / sqrt(CAST(length(a) AS DOUBLE) * length(b)) END",
        "mark_pair(t STRING, names ARRAY<STRING>) RETURNS STRING": _mark_pair(),
        "sentence_rows(t STRING) RETURNS TABLE(sent_no INT, org_text STRING, text STRING)":
            f"SELECT n, s, clean_sentence(s) FROM (SELECT posexplode({cut(collapsed)}) AS (n, s))",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in bodies]
