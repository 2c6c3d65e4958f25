"""Ids of a public word-level BPE vocabulary, made inside tasks."""

from __future__ import annotations

import codecs
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np

from stratakit.llm.common import sliced

END = (1).to_bytes(4, "little")
CACHE_BYTES = 56 << 20
"""Of each of two generations of words. Words of the older one that are met again move to the younger."""
ENTRY_BYTES = 190
"""What Python takes for a cached word beside its letters and its ids."""
TEXT_SLICE = 200_000
"""Characters of texts whose words are looked up together."""
JOINED_MARK = re.compile("[.,] (?<=[^\\w ][.,] |[_İ\U00010000-\U0010FFFF][.,] )")
"""A full stop or comma at a word's end behind another mark, with which it may be one part to the vocabulary. The
capital i with a dot ends in a mark once it is lower-cased, and what is a letter above U+FFFF depends on the version."""


def _byte_letters() -> str:
    """The letters that byte-level vocabularies write for the bytes 0 to 255; white space stays, to part words."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    letters = [chr(b if b in plain else next(other)) for b in range(256)]
    letters[32] = " "
    return "".join(letters)


BYTE_LETTERS = _byte_letters()
_LETTER, _NUMBER, _SPACE = r"a-z\xAA\xB5\xBA\xDF-\xF6\xF8-\xFF", r"0-9\xB2\xB3\xB9\xBC-\xBE", r"\x09-\x0D\x20\x85\xA0"
PARTS = re.compile(f"[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBER}]|[^{_LETTER}{_NUMBER}{_SPACE}]+")
"""What the vocabulary sees as parts of a text in lower case whose characters are below U+0100."""


def _is_latin(text: str) -> bool:
    """Whether all characters are below U+0100. Such texts are their own NFC and are lower-cased letter by letter."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordTokenizer:
    """Texts to little-endian 32-bit ids. No token of this vocabulary crosses white space, so words are cached.

    The vocabulary knows lower case only, and takes a full stop or comma behind a letter for a part of its own; texts
    are brought into this form before they are split, so that fewer words are different. New words whose characters are
    below U+0100 are parted here and encoded many at a time, as one text, by the merges alone: nothing else would
    change them. Each part ends in a token with the mark of a word's end.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.inner = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.inner.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.special = [token.content for token in self.inner.get_added_tokens_decoder().values()]
        ids = self.inner.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(ids.values()) + 1, bool)
        self.ends[[i for token, i in ids.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes]
        self.older: dict[str, bytes]
        self.held: int
        self.forget()

    def forget(self) -> None:
        """Drops the cached words; the vocabulary stays. A worker that waits for other work then holds little."""
        self.known, self.older, self.held = {"": b""}, {}, 0

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text. Words of neighbouring texts are learned together."""
        for begin, end in sliced(texts, TEXT_SLICE):
            split = [self._split(text) for text in texts[begin:end]]
            found = [list(map(self.known.get, words)) for words in split]
            places = [[i for i, ids in enumerate(own) if ids is None] for own in found]
            new = {words[i] for words, at in zip(split, places) for i in at}
            if new:
                if self.held > CACHE_BYTES:
                    self.older, self.known, self.held = self.known, {"": b""}, 0
                self._learn(self._unseen(new))
            for words, own, at in zip(split, found, places):
                for i in at:
                    own[i] = self.known[words[i]]
                yield b"".join(own)
            if self.held > 2 * CACHE_BYTES:  # one text alone with words beyond all bounds
                self.forget()

    def _split(self, text: str) -> list[str]:
        """Strings whose ids, one after another, are those of the text."""
        if latin := _is_latin(text):
            lower = text.lower()
            # A special token in other letters is none.
            if not any(token in lower for token in self.special):
                text = lower
        text = text.replace("\n", " ") + " "
        if (latin or is_normalized("NFC", text)) and not JOINED_MARK.search(text):
            text = text.replace(". ", " . ").replace(", ", " , ")
        return text.split(" ")

    def _unseen(self, words: Iterable[str]) -> list[str]:
        """Those in neither generation; words of the older one become young."""
        older = self.older
        if not older:
            return list(words)
        met = [word for word in words if word in older]
        self._keep(met, [older[word] for word in met])
        return [word for word in words if word not in older]

    def _keep(self, words: list[str], ids: list[bytes]) -> None:
        self.known.update(zip(words, ids))
        self.held += ENTRY_BYTES * len(words) + sum(map(len, words)) + sum(map(len, ids))

    def _learn(self, new: list[str]) -> None:
        plain, mixed, rest = [], [], []
        for word in new:
            if word.isalpha() and (word.isascii() or _is_latin(word)):
                plain.append(word)
            elif _is_latin(word) and not any(token in word for token in self.special):
                mixed.append(word)
            else:
                rest.append(word)
        for words in (plain, mixed):
            for begin in range(0, len(words), 20_000):
                some = words[begin : begin + 20_000]
                parts = [PARTS.findall(word.lower()) for word in some] if words is mixed else None
                ids = self._merged([part for own in parts for part in own] if parts else some, parts and list(map(len, parts)))
                if ids:
                    self._keep(some, ids)
                else:
                    rest += some
        found = self.inner.encode_batch_fast(rest, add_special_tokens=False)
        self._keep(rest, [np.array(one.ids, "<u4").tobytes() for one in found])

    def _merged(self, parts: list[str], counts: list[int] | None) -> list[bytes]:
        """Ids of words that have so many parts each, or one; nothing if the vocabulary sees a part otherwise."""
        letters = codecs.charmap_decode(" ".join(parts).lower().encode(), "strict", BYTE_LETTERS)[0]
        ids = np.array(self.merges.encode_batch_fast([letters], add_special_tokens=False)[0].ids, "<u4")
        ends = 4 * np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        if len(ends) != len(parts) + 1:
            return []
        raw, ends = ids.tobytes(), (ends if counts is None else ends[np.cumsum([0, *counts])]).tolist()
        return [raw[i:j] for i, j in zip(ends, ends[1:])]


@lru_cache(1)
def tokenizer(path: str) -> WordTokenizer:
    """One per worker and path."""
    return WordTokenizer(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
