import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from webfacts.llm import grammar
from webfacts.llm.queries import tokenizer_file
from webfacts.llm.tokens import WordEncoder, encoder

FIRST = 1000


def check(documents):
    sizes = np.array([len(d) for d in documents])
    ids = np.array([x for d in documents for x in d], dtype=np.uint32)
    sequence, symbols, rules = grammar.compress(ids, sizes, FIRST, least=2)
    lengths = grammar.expansion_lengths(rules, FIRST)
    shard = grammar.Shard(
        rules.astype("<u4").tobytes(), lengths.tobytes(), sequence.astype("<u4").tobytes(), 4, FIRST, symbols)
    assert shard.ids().tolist() == ids.tolist()
    assert [len(grammar.expand(np.array([FIRST + i]), rules, FIRST)) for i in range(len(rules))] == lengths.tolist()
    for i, d in enumerate(documents):
        for start, stop in ((0, len(d)), (len(d) // 3, len(d) // 2 + 1), (max(0, len(d) - 1), len(d))):
            assert shard.span(i, start, stop).tolist() == d[start:stop]
    return sequence, rules


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=60), min_size=1, max_size=6))
def test_any_documents_come_back(documents):
    check(documents)


def test_repeats_shrink():
    sequence, rules = check([[1, 2, 3, 4, 9] * 200, [1, 2, 3, 4] * 50, [7] * 64])
    assert len(sequence) < 400 and len(rules)


def test_pairs_stay_inside_documents():
    sequence, rules = check([[1], [2]] * 40)
    assert not len(rules)


def test_files(spark, tmp_path):
    rows = [(3, "the cat sat on the mat " * 40), (1, None), (2, ""), (None, "no id"), (7, "tail " * 70_000),
            (5, "a b"), (5, "a a")]
    docs = spark.createDataFrame([(i, t, 1, b"") for i, t in rows], "doc_id long, text string, part int, rules binary")
    path = tokenizer_file("word_bpe_49k.json")
    for n, (ranges, tokens) in enumerate([(1, 100), (4, 1000), (3, 1 << 20)]):
        folder = f"{tmp_path}/{n}"
        grammar.write_shards(docs, folder, path, ranges=ranges, shard_tokens=tokens)
        found = sorted(grammar.read_shards(spark, folder, keep_ids=True).collect(), key=lambda r: r["start"])
        assert [r["doc_id"] for r in found] == [None, 1, 2, 3, 5, 5, 7]
        encode = WordEncoder(path, False).tokenizer.encode
        at = 0
        for r, text in zip(found, ["no id", "", "", rows[0][1], "a a", "a b", rows[4][1]]):
            wanted = encode(text, add_special_tokens=False).ids + [2]
            assert np.frombuffer(r["ids"], "<u4").tolist() == wanted
            assert (r["start"], r["n_tokens"]) == (at, len(wanted))
            at += len(wanted)


def test_no_rows(spark, tmp_path):
    grammar.write_shards(spark.createDataFrame([], "doc_id long, text string"), f"{tmp_path}/x",
                         tokenizer_file("word_bpe_49k.json"))
    assert grammar.read_shards(spark, f"{tmp_path}/x").collect() == []


def test_words_encode_as_whole_texts():
    texts = ["foo  bar\n\n x's 1234\t\ty  ", "É́ á ́x <|endoftext|> z", "a\xa0b  \xa0 c\x1cd", " lead", "trail ",
             "\nx", "x\n", "a\nb c\nd", "Hello's WORLD'S\n'tis", "a ́b", "日本語 text\nΣΑΣ İstanbul", "x\n\n", "\n",
             " ", "", "one two one two\none", "😀 a😀b \n 😀"]
    for name, blanks in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        # A tiny cache is emptied again and again.
        for cache in (400_000, 8):
            encoder = WordEncoder(tokenizer_file(name), blanks, cache)
            for _ in range(2):
                found = encoder.encode(texts)
                assert [np.frombuffer(f, "<u4").tolist() for f in found] == [
                    encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.2, 200_000), 40_000).astype(np.uint32)
    copies = np.tile(rng.integers(0, 40_000, 700, dtype=np.uint32), 100)
    for flat, sizes in ((ids, [50_000] * 4), (copies, [700] * 100), (np.full(5000, 7, np.uint32), [5000])):
        sequence, symbols, rules = grammar.compress(flat, np.array(sizes), 49408)
        pairs = {}
        at = 0
        for n in symbols:
            own = sequence[at:at + n].tolist()
            at += n
            before = None
            for pair in zip(own, own[1:]):
                before = None if pair == before else pair
                if before:
                    pairs[pair] = pairs.get(pair, 0) + 1
        assert max(pairs.values(), default=0) < grammar.LEAST_COUNT
        assert (grammar.expand(sequence, rules, 49408) == flat).all()
    # A document copied often is one symbol.
    sequence, symbols, rules = grammar.compress(copies, np.array([700] * 100), 49408)
    assert len(sequence) == 100


def test_strings_of_added_tokens():
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "<|startoftext|>", "x<|EndOfText|>. y", "a b", "<|endoftext|>\n<|endoftext|>z"]
    for name, blanks in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = tokenizer_file(name)
        found = WordEncoder(path, blanks).encode(texts)
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [
            Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]


def test_random_texts_encode_as_the_library_does():
    import random

    rng = random.Random(3)
    letters = "ab Zé́ßİΣ<|>.,'s\n\t 12'll’—中国あᄀ ᅡ가 ª²Ⅷ_-$ĠĊ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    for name, blanks in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        for cache in (400_000, 40):
            encoder = WordEncoder(tokenizer_file(name), blanks, cache)
            found = [f for at in range(0, len(texts), 100) for f in encoder.encode(texts[at:at + 100])]
            assert [np.frombuffer(f, "<u4").tolist() for f in found] == [
                encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_stay_learned_only_where_asked():
    """A worker that keeps its words learns a word once for all its tasks, with equal ids."""
    path = tokenizer_file("word_bpe_49k.json")
    texts = ["one twoish words, words.", "twoish o'clock zzyzx"]
    with encoder(path, False) as words:
        plain = words.encode(texts)
    assert not words.cache
    with encoder(path, False, keep=True) as words:
        assert words.encode(texts[:1]) == plain[:1]
    with encoder(path, False, keep=True) as words:
        assert {"twoish", "words,", "words."} <= set(words.cache)
        assert words.encode(texts) == plain
    with encoder(path, False):
        pass
    assert not words.cache


def test_words_set_aside_come_back():
    """A full store forgets the words that were not met of late, and not the others."""
    for name, blanks in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        words = WordEncoder(tokenizer_file(name), blanks, 40)
        plain = [words._whole(t) for t in ("x often here", "y often there")]
        learned, learn_parts = [], words._learn_parts
        words._learn_parts = lambda parts: learned.extend(parts) or learn_parts(parts)
        assert words.encode(["x often here"]) == plain[:1]
        for n in range(4):
            words.encode(["x often " + " ".join(f"w{n}v{m}" for m in range(12))])
        assert words.encode(["y often there"]) == plain[1:]
        assert learned.count("often") == 1
        assert len(words.cache) + len(words.aside) < 60


def test_each_distinct_word_is_looked_up_once():
    class Counted(dict):
        lookups = 0

        def get(self, word, other=None):
            self.lookups += 1
            return super().get(word, other)

    texts = ["some words come again, some words do not\nagain " + f"w{'xyz' [n % 3]}" for n in range(200)]
    for name, blanks in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        words = WordEncoder(tokenizer_file(name), blanks)
        plain = [words._whole(t) for t in texts]
        words.cache = Counted()
        assert words.encode(texts) == plain
        assert words.cache.lookups < 50
        # Words of plain letters are not searched for pieces.
        assert words.plain


def test_later_rounds_count_few_places(monkeypatch):
    """After the first round only pairs that can have become frequent are counted."""
    rng = np.random.default_rng(7)
    ids = np.minimum(rng.zipf(1.3, 100_000), 30_000).astype(np.uint32)
    ranks, counted = grammar._ranks, []

    def watched(*given):
        found = ranks(*given)
        counted.append(int(np.count_nonzero(given[1])))
        return found

    monkeypatch.setattr(grammar, "_ranks", watched)
    sequence, symbols, rules = grammar.compress(ids, np.array([25_000] * 4), 49408)
    assert (grammar.expand(sequence, rules, 49408) == ids).all()
    assert len(counted) > 3 and counted[-1] < len(sequence) / 10
