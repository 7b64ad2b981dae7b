"""Token ids of whole texts by a public tokenizer file of the `tokenizers` library.

A byte-level BPE never merges across a blank that starts a word, so a text is
cut there and each distinct word is encoded once per worker; the words' ids,
joined, are the ids of the text. Words of Latin letters with trailing ASCII
punctuation are two pre-tokens, which go to the library's BPE model directly;
every other word goes through the whole tokenizer.

An executor's workers go on to other tasks, so what an encoder keeps lies beside
all that they do: a word with punctuation uses the entry of the word without, the
words are kept in two halves, the older of which is dropped when the newer is full,
and `forget` drops most of them at the end of a task."""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import chain, islice

import numpy as np

# Letters whose class is the same in every Unicode version in use, then ASCII punctuation.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-/:-@\[-`{-~]*)")
_WORD_START = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?!\S)")
CACHE_WORDS = 600_000
KEPT_WORDS = 60_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_chars() -> dict[int, str]:
    """The printable character that byte-level BPE files use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """`encode(text)`: the ids of a whole text (null: none) as little-endian
    bytes of `dtype`. Strings of special tokens in a text are ordinary text.
    At most CACHE_WORDS words of at most 64 characters are kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.model, self.table = self.tok.model, _byte_chars()
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}
        pre = self.tok.pre_tokenizer
        self.by_word = type(pre).__name__ == "ByteLevel" and not pre.add_prefix_space and self.tok.normalizer is None

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _pre_token(self, pre_token: str) -> bytes:
        chars = pre_token.encode().decode("latin-1").translate(self.table)
        return array(self.code, [t.id for t in self.model.tokenize(chars)]).tobytes()

    def _stem(self, pre_token: str) -> bytes:
        got = self.stems.get(pre_token)
        if got is None:
            if len(self.stems) >= CACHE_WORDS:
                self.stems.clear()
            got = self.stems[pre_token] = self._pre_token(pre_token)
        return got

    def _word(self, word: str) -> bytes:
        """Ids of a blank and `word`, which is not among the newer words."""
        got = self.older.get(word)
        if got is None:
            m = _SIMPLE.fullmatch(word)
            if m is None:
                got = self._whole(" " + word)
            elif m[2]:
                got = (self.words.get(m[1]) or self._word(m[1])) + self._stem(m[2])
            else:
                got = self._pre_token(" " + word)
        if len(word) <= 64:
            if len(self.words) >= CACHE_WORDS // 2:
                self.older, self.words = self.words, {}
            self.words[word] = got
        return got

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_word:
            return self._whole(text)
        words = _WORD_START.split(text) if _ODD.search(text) else text.split(" ")
        found = list(map(self.words.get, words))
        found[0] = self._whole(words[0])
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = self.words.get(words[i]) or self._word(words[i])
        return b"".join(found)

    def forget(self) -> None:
        """Drop all but the KEPT_WORDS that came first: frequent words come early."""
        self.words = dict(islice(chain(self.older.items(), self.words.items()), KEPT_WORDS))
        self.older, self.stems = {}, {}


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(path)
