"""Token ids of whole texts by the ``tokenizers`` library.

Cutting a text before its pre-tokenizer would cut it anyway gives the same
ids, so each distinct word is encoded once per worker and looked up after
that. Texts whose white space the quick cut does not cover are encoded whole.
"""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space beyond blank and line feed, or two of these in a row.
_ODD_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_GROUP = 1024
# Texts whose words are counted together, by their length; bounds the memory alone.
_CHARS_AT_ONCE = 1 << 24
# Letters that every version of Unicode has, each of them its own normal form.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
CACHE_WORDS = 800_000
# Upper case whose lower case depends on its neighbours; the other one's is longer.
_ODD_CASE = re.compile("\u03a3")
_LONGER = "\u0130"
_MARKS = string.punctuation
_BLANK_BYTES = ("\u0120", "\u010a")
_PIECE_END = "</w>"


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    ``blanks=True`` is for byte-level vocabularies whose tokens begin with the
    blank before a word, ``blanks=False`` for those that drop white space and
    case. ``cache_words`` bounds the memory, not the result: when half as many words are
    learned they are set aside, those set aside before are forgotten, and a word set aside
    comes back when it is met again, so frequent words are not learned anew. Texts that hold the string of an added token are encoded whole, as the
    library finds such tokens before all else.

    Each distinct word of many texts is looked up once, as it stands. One not
    found is made of its letters and the marks after them, between which both
    pre-tokenizers cut; so "word", "word," and "word." are encoded once.
    """

    def __init__(self, path: str, blanks: bool, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        # In any case of letters, as words are looked up in lower case.
        self.added = re.compile("|".join(added) or r"(?!)", re.I)
        self.blanks = blanks
        self.cache_words = cache_words
        self.cache: dict[str, bytes] = {}
        self.aside: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        # Ids that begin with a blank or line feed (as byte-level vocabularies write
        # them), or that end a piece.
        self.edge = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.edge[[i for token, i in vocabulary.items() if (
            token[:1] in _BLANK_BYTES if blanks else token.endswith(_PIECE_END))]] = True
        # Words of plain letters need no search for their pieces, if the file is as expected.
        self.model = self.tokenizer.model
        letters = [c for c in map(chr, range(0x250)) if _LETTERS.fullmatch(c)]
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.byte_level = {ord(c): byte_level(c)[0][0] for c in letters}
        probes = [c * n for c in letters for n in (1, 3) if blanks or c.islower()]
        probes += ["".join(probes), "internationalization"]
        whole = self.tokenizer.encode_batch_fast([" " * blanks + p for p in probes], add_special_tokens=False)
        self.plain = self._letter_ids(probes) == [np.array(e.ids, dtype="<u4").tobytes() for e in whole]

    def _spaced(self, text: str) -> str | None:
        """The text with a blank between its words, or nothing if it is to be encoded whole."""
        if _ODD_SPACE.search(text) or self.added.search(text):
            return None
        if not self.blanks:
            if _LONGER in text:
                return None
            if text.isascii() or not (_ODD_CASE.search(text) or not unicodedata.is_normalized("NFC", text)):
                text = text.lower()
            return text.replace("\n", " ")
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return None
        # A word after a blank is known by its bare form; one that begins the
        # text or a line is marked by a line feed, which the ids then lack at
        # the beginning of the text.
        return text.replace("\n", " \n")

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of words that are not in ``cache``, of which their parts are then."""
        parts, ends = [], []
        for word in words:
            core = word.rstrip(_MARKS)
            # Only after a letter is a mark sure to begin a piece of its own.
            if len(core) == len(word) or not core or not core[-1].isalpha():
                parts.append(word)
                ends.append("a")
            else:
                # Marks stand without a blank; the letter before them keeps them so.
                parts.append(core)
                ends.append("a" + word[len(core):])
        wanted = {"a", *parts, *ends}
        new = [part for part in wanted if part not in self.cache]
        stores = [self.aside]
        if len(self.cache) + len(new) > self.cache_words // 2:
            self.cache, self.aside = {}, self.cache
            stores.append(self.aside)
            new = list(wanted)
        cache = self.cache
        if not self.blanks:
            # Between two blanks in a row.
            cache[""] = b""
        for store in filter(None, stores):
            found = list(map(store.get, new))
            cache.update((part, ids) for part, ids in zip(new, found) if ids is not None)
            new = [part for part, ids in zip(new, found) if ids is None]
        self._learn_parts(new)
        letter = len(cache["a"])
        marks = {end: cache[end][letter:] for end in set(ends)}
        made = [ids + marks[end] if end != "a" else ids for ids, end in zip(map(cache.__getitem__, parts), ends)]
        # Soon made again, so where room is short they leave it to words that are not.
        if len(cache) + len(words) <= self.cache_words // 4:
            cache.update(zip(words, made))
        return made

    def _learn_parts(self, words: list[str]) -> None:
        if self.plain:
            letters, words = self._plain_letters(words)
            self.cache.update(zip(letters, self._letter_ids(letters)))
        if self.blanks:
            self._learn_row(words, True)
        else:
            # Letters alone are one piece, which one id ends.
            self._learn_row([w for w in words if w.isalpha()], True)
            self._learn_row([w for w in words if not w.isalpha()], False)

    def _plain_letters(self, words: list[str]) -> tuple[list[str], list[str]]:
        """Words of plain letters, in lower case where the file drops case, and the others."""
        plain = _LETTERS.fullmatch
        fits = [plain(w) is not None and (self.blanks or w.islower()) for w in words]
        return [w for w, fit in zip(words, fits) if fit], [w for w, fit in zip(words, fits) if not fit]

    def _letter_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words of plain letters, each one piece to the pre-tokenizer, by the model alone."""
        tokenize, begin = self.model.tokenize, _BLANK_BYTES[0] * self.blanks
        flat: list[int] = []
        ends = [0]
        for word in words:
            shown = word if word.isascii() else word.translate(self.byte_level)
            flat += [token.id for token in tokenize(begin + shown)]
            ends.append(4 * len(flat))
        raw = np.array(flat, dtype="<u4").tobytes()
        return [raw[start:end] for start, end in zip(ends, ends[1:])]

    def _learn_row(self, words: list[str], by_edge: bool) -> None:
        for i in range(0, len(words), _GROUP):
            group = words[i:i + _GROUP]
            # The words in a row, as they would stand in a text.
            shown = [w if w[:1] == "\n" else " " + w for w in group] if self.blanks else [
                w + " " for w in group]
            row, edges = "".join(shown), ()
            if by_edge:
                # Without the places of the ids in the text, which cost much of the time.
                ids = np.asarray(self.tokenizer.encode_batch_fast([row], add_special_tokens=False)[0].ids, dtype="<u4")
                edges = np.flatnonzero(self.edge[ids])
            if len(edges) == len(group):
                # No word has more than one, so each has its own.
                ends = np.append(edges[1:], len(ids)) if self.blanks else edges + 1
            else:
                encoded = self.tokenizer.encode(row, add_special_tokens=False)
                ids = np.asarray(encoded.ids, dtype="<u4")
                begins = np.cumsum([len(w) for w in shown[:-1]])
                at = np.fromiter((o[0] for o in encoded.offsets), dtype=np.int64, count=len(encoded))
                ends = np.append(np.searchsorted(at, begins), len(ids))
            raw = ids.tobytes()
            start = 0
            for w, end in zip(group, (ends * 4).tolist()):
                self.cache[w] = raw[start:end]
                start = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes."""
        out: list[bytes] = []
        begin = size = 0
        for i, text in enumerate(texts):
            if size and size + len(text) > _CHARS_AT_ONCE:
                out += self._encode(texts[begin:i])
                begin, size = i, 0
            size += len(text)
        return out + self._encode(texts[begin:])

    def _encode(self, texts: list[str]) -> list[bytes]:
        spaced = [self._spaced(text) for text in texts]
        own = [i for i, text in enumerate(spaced) if text]
        out = [self._whole(text) if words is None else b"" for text, words in zip(texts, spaced)]
        rests: list[str | None] = [spaced[i] for i in own]
        if self.blanks and own:
            # The first word of a text has no blank before it.
            cut = [text.partition(" ") for text in rests]
            rests = [rest if blank else None for _, blank, rest in cut]
            encoded = self.tokenizer.encode_batch_fast([first for first, _, _ in cut], add_special_tokens=False)
            for i, one in zip(own, encoded):
                out[i] = np.asarray(one.ids, dtype="<u4").tobytes()
        words = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        # Each distinct word is looked up once.
        coded = words.values.dictionary_encode()
        known = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        if known is None:
            return [self._whole(text) for text in texts]
        ids = pa.array(known, pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64, count=len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
        places = ends[words.offsets.to_numpy()].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        for i, start, end in zip(own, places, places[1:]):
            out[i] += raw[start:end]
        return out

    def _known(self, words: list[str]) -> list[bytes] | None:
        """Ids of different words, or nothing if too many of them are new."""
        found = list(map(self.cache.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if len(missing) > self.cache_words // 2:
            return None
        if missing:
            for i, ids in zip(missing, self._learn([words[i] for i in missing])):
                found[i] = ids
        return found


_TOKENIZERS: dict[tuple[str, bool], WordEncoder] = {}


@contextmanager
def encoder(
    path: str, blanks: bool, keep: bool = False, cache_words: int = CACHE_WORDS,
) -> Iterator[WordEncoder]:
    """The worker's encoder for a vocabulary file, for one task.

    The words it learned are let go with the task: a worker that goes on to other work
    must not hold them. With ``keep`` they stay for the worker's next task, within
    the encoder's ``cache_words``, so that a word is learned once and not in every task.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, blanks) not in _TOKENIZERS:
        _TOKENIZERS[path, blanks] = WordEncoder(path, blanks)
    own = _TOKENIZERS[path, blanks]
    own.cache_words = cache_words
    try:
        yield own
    finally:
        if not keep:
            own.cache, own.aside = {}, {}
