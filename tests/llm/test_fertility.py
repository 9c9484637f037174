import random
import re
from collections import Counter
from statistics import median_low

import pytest

from webfacts.llm import fertility
from webfacts.llm.queries import tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES, RANKS = tokenizer_file("piece_bpe_32k.model"), tokenizer_file("byte_bpe_multi_50k.tiktoken")


def plain_base(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n")]
    again = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside))


def test_base_counts_against_plain_loops():
    rng = random.Random(13)
    texts = ["", " ", "\n\n", "a", "a b c", "a b c a b c", "a a a a", "a\x85b c \x1cd", "é# $\n\x0bé# $"]
    texts += ["".join(rng.choice("ab \n\t#|\x0c") for _ in range(rng.randrange(200))) for _ in range(300)]
    for text in texts:
        assert fertility.base_counts(text) == plain_base(text), repr(text)


def test_very_long_words_and_texts_end():
    for text in ["x" * 300_000, "ab " * 200_000, "\n" * 100_000]:
        line = " ".join(text.split())
        for path in (PIECES, RANKS):
            v = fertility.vocabulary(path)
            assert fertility.measures(v.ids(line), v.is_bytes, len(line))[1] == 0


def test_measures():
    pieces, ranks = fertility.vocabulary(PIECES), fertility.vocabulary(RANKS)
    assert fertility.measures([], pieces.is_bytes, 0) == (0, 0, 0)
    assert fertility.measures([5000] * 8, pieces.is_bytes, 16) == (2000, 0, 0)
    assert fertility.measures([5000, 5001] * 4, pieces.is_bytes, 8)[2] == 1000
    for v in (pieces, ranks):
        rare, plain = (fertility.measures(v.ids(t), v.is_bytes, len(t)) for t in ("𐎀𐎁𐎂𐎃", "the house on the hill"))
        assert rare[1] > 900 and plain[1] == 0 and rare[0] < plain[0]


def test_script_of():
    assert [fertility.script_of(t) for t in ("abc где", "где", "漢字", "1 2", "")] == [
        "Latin", "Cyrillic", "Han", "none", "none"]


def texts_of(n, seed=5):
    rng = random.Random(seed)
    common = "the of and house river green walked stone under light morning water small road until".split()
    return [" ".join(rng.choice(common) + rng.choice(["", "", "ly", "er"]) for _ in range(rng.randrange(64, 127)))
            for _ in range(n)]


def noise(seed=6):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz0123456789") for _ in range(7)) for _ in range(90))


def judged(spark, rows, **setting):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int")
    return {r["doc_id"]: r for r in fertility.judge(frame, PIECES, RANKS, **setting).collect()}


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, "en", 0) for i, t in enumerate(texts_of(80))]
    return out + [(900, noise(), "en", 0), (901, " ".join(chr(0x12000 + i) + chr(0x12100 + i) for i in range(80)), "en", 0), (902, "too few", "en", 0),
                  (903, "a b c d " * 40, "en", 0), (904, None, None, 0), (905, "", "en", 0)]


def test_noise_is_rejected_and_text_kept(spark, rows):
    found = judged(spark, rows)
    assert len(found) == len(rows)
    assert all(found[i]["kept"] for i in range(80))
    for key in (900, 901):
        assert not found[key]["kept"] and not found[key]["base_failed"] and found[key]["failed"]
    assert all(found[k]["base_failed"] and not found[k]["kept"] for k in (902, 903, 904, 905))
    assert found[904]["language"] == "script:none" and found[0]["language"] == "lang:en"
    for key, text, *_ in rows:
        assert tuple(found[key][b] for b in fertility.BASE) == plain_base(text or "")


def test_bands_against_plain_medians(spark, rows):
    found = judged(spark, rows)
    groups = {}
    for r in found.values():
        if not r["base_failed"]:
            groups.setdefault((r["language"], r["n_words"].bit_length() - 1), []).append(tuple(r["measures"]))
    least = [0, 50, 0] * 2
    for r in found.values():
        group = groups.get((r["language"], r["n_words"].bit_length() - 1), [])
        if r["base_failed"] or len(group) < fertility.MIN_TEXTS:
            continue
        wanted = []
        for i, x in enumerate(r["measures"]):
            values = [g[i] for g in group]
            middle = median_low(values)
            width = max(12.0 * median_low([abs(v - middle) for v in values]), 0.2 * middle, least[i])
            if abs(x - middle) > width:
                wanted.append(i)
        assert r["failed"] == wanted and r["kept"] == (not wanted)


def test_copies_count_once_and_do_not_move_a_band(spark, rows):
    alone = judged(spark, rows)
    copied = judged(spark, rows + [(2000 + i, noise(), "en", 0) for i in range(400)])
    assert [copied[i]["kept"] for i in range(80)] == [alone[i]["kept"] for i in range(80)]
    assert not any(copied[2000 + i]["kept"] for i in range(400))


def test_few_texts_take_a_wider_band_or_none(spark, rows):
    few = [(3000, noise(), "xx", 0), (3001, texts_of(1, 9)[0], "xx", 0)]
    found = judged(spark, rows + few)
    assert not found[3000]["kept"] and found[3001]["kept"]
    assert all(r["kept"] for r in judged(spark, few).values())


def test_empty_table(spark):
    assert judged(spark, []) == {}
    frame = spark.createDataFrame([], "doc_id long, text string, lang string, n_words int")
    assert fertility.judge(frame, PIECES).columns == ["doc_id", "lang", *fertility.OWN]
