"""Sentence and token expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from webfacts.constants import CONTRACTIONS, SENTENCE_ENDS, STOP_WORDS

# Blanks, inside a character class of a pattern that starts with UNICODE. One
# property is tried faster than the dozen ranges it stands for.
UNICODE = "(?U)"
BLANK = r"\s\x1c-\x1f"
_BLANK_CHARS = "".join(
    chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                     *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
WORD = r"\p{L}\p{N}_"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind an expression once and use it several times in ``body``.

    Lambdas are interpreted, without sharing of equal subexpressions, so a
    costly input that is used twice must be bound.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    """Remove blanks of any kind at both ends."""
    return F.btrim(c, F.lit(_BLANK_CHARS))


def collapse_ws(c: Column) -> Column:
    """Runs of blanks become one blank; none stay at the ends.

    A plain blank alone stays as it is, so most blanks are passed over.
    """
    return F.trim(F.regexp_replace(c, f"{UNICODE}[{BLANK}&&[^ ]][{BLANK}]*| [{BLANK}]+", " "))


def sentences(c: Column) -> Column:
    """Cut after each run of sentence-end characters; the tail is kept.

    Splitting between an end and a non-end is several times faster than
    extracting the pieces, whose character class would be tried on every
    character.
    """
    return F.array_remove(F.split(c, f"(?<=[{SENTENCE_ENDS}])(?=[^{SENTENCE_ENDS}])"), "")


def keep_ascii_words(c: Column) -> Column:
    """Lower-cased words, one blank apart; words with a non-ASCII character go."""
    words = F.lower(F.regexp_replace(c, f"[^{WORD}]+", " "))
    return F.trim(F.regexp_replace(
        F.regexp_replace(words, r"[!-~]*[^\x00-\x7F][^ ]*", ""), " +", " "))


def letters_only(c: Column) -> Column:
    """Digits, punctuation and blanks become one blank (input: ASCII words)."""
    return F.trim(F.regexp_replace(c, "[^a-z]+", " "))


def plain_letters(c: Column) -> Column:
    """``letters_only`` of ``keep_ascii_words``. In a text of ASCII characters alone no
    word goes, so one replacement does the same."""
    return letters_only(_ascii_words(c))


def _ascii_words(c: Column) -> Column:
    """Lower-cased text without the words that hold a non-ASCII character; anything
    but letters may stand between its words."""
    ascii_only = F.octet_length(c) == F.length(c)
    # ASCII word characters by name: most are found before the properties are tried.
    words = F.lower(F.regexp_replace(c, f"[^0-9A-Za-z_{WORD}]+", " "))
    kept = F.regexp_replace(words, r"(?<![^ ])[!-~]*+[^\x00-\x7F][^ ]*+", "")
    return F.when(ascii_only, F.lower(c)).otherwise(kept)


def drop_unprintable(c: Column) -> Column:
    """Remove control, format and separator characters other than the blank."""
    return F.regexp_replace(
        c, r"\p{C}|[\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]", "")


def _rare(words: Column) -> Column:
    """Whether a two-part word can be among them."""
    return reduce(or_, [F.contains(words, F.lit(a + b)) for a, b in CONTRACTIONS])


_GAPS = "|".join(rf"(?<=\b{a})(?={b}\b)" for a, b in CONTRACTIONS)


def split_words(c: Column) -> Column:
    """Non-empty pieces between blanks, with two-part words separated."""
    def part(words: Column) -> Column:
        return F.when(_rare(words), F.regexp_replace(words, _GAPS, " ")).otherwise(words)

    return F.filter(F.split(let(c, part), " "), lambda t: t != "")


def drop_stop_words(tokens: Column, stop: Iterable[str] = STOP_WORDS) -> Column:
    """Tokens that are not stop words (set look-up, case-folded)."""
    stop = [w.casefold() for w in stop]
    return F.filter(tokens, lambda t: ~F.lower(t).isin(stop)) if stop else tokens


def clean_tokens(c: Column, stop: Iterable[str] = STOP_WORDS) -> Column:
    """Sentence to its cleaned tokens: ``drop_stop_words`` of ``split_words`` of
    ``plain_letters``, in one cut and one pass over the pieces.

    After ``letters_only`` nothing unprintable can be left, so that step is
    not repeated here. Tokens are in lower case.
    """
    def pieces(words: Column) -> Column:
        parted = F.split(F.regexp_replace(letters_only(words), _GAPS, " "), " ")
        return F.when(_rare(words), parted).otherwise(F.split(words, "[^a-z]+"))

    dropped = ["", *[w.casefold() for w in stop]]
    return F.filter(let(_ascii_words(c), pieces), lambda t: ~t.isin(dropped))


def clean_sentence(c: Column, stop: Iterable[str] = STOP_WORDS) -> Column:
    """Cleaned tokens joined by one blank."""
    return F.array_join(clean_tokens(c, stop), " ")


def escape_query(c: Column) -> Column:
    """Keep word characters and blanks only."""
    return F.regexp_replace(c, f"{UNICODE}[^{WORD}{BLANK}]", "")


def index_tokens(c: Column) -> Column:
    """Terms of the full-text index: lower-cased runs of word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"[{WORD}]+"), F.lit(0))


def word_tokens(c: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))


def whitespace_tokens(c: Column) -> Column:
    """Lower-cased pieces between blanks."""
    return F.filter(F.split(F.lower(c), f"{UNICODE}[{BLANK}]+"), lambda t: t != "")


def bigrams(tokens: Column) -> Column:
    """Neighbouring token pairs, blank-joined."""
    def pairs(t: Column) -> Column:
        following = F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0)))
        return F.filter(
            F.zip_with(t, following, lambda x, y: F.when(y.isNotNull(), F.concat_ws(" ", x, y))),
            lambda p: p.isNotNull())
    return let(tokens, pairs)


def terms(c: Column, kind: str) -> Column:
    """Terms of one feature branch kind."""
    if kind == "word":
        return word_tokens(c)
    if kind == "whitespace":
        return whitespace_tokens(c)
    if kind == "bigram":
        return bigrams(word_tokens(c))
    raise ValueError(f"unknown term kind: {kind}")


def term_counts(tokens: Column) -> Column:
    """Array of (term, tf) of one row, without a shuffle.

    Sorting brings equal terms together; each run start gives a term, the
    distance to the next start its count.
    """
    def runs(srt: Column) -> Column:
        n = F.size(srt)
        starts = F.filter(
            F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
            lambda i: (i == 0) | (F.get(srt, i) != F.get(srt, i - 1)))
        return let(starts, lambda st: F.transform(st, lambda s, j: F.struct(
            F.get(srt, s).alias("term"),
            (F.coalesce(F.get(st, j + 1), n) - s).alias("tf"))))
    return let(F.sort_array(tokens), runs)
