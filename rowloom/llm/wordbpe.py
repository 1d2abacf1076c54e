"""Token ids of a tokenizers file, pre-token by pre-token, with a cache in each worker.

The library encodes every pre-token that a worker meets for the first time. Texts of common characters are split by
Python's own patterns; for all others the library normalises and splits, and the same cache serves their pre-tokens.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from functools import cached_property, lru_cache

import numpy as np
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

#: A task has one core: the library's own threads would only compete with other tasks.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Letters, numbers and white space up to U+024F (fixed values of the Unicode classes L, N and White_Space there).
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = r"\t-\r \x85\xa0"
#: Texts of these characters only are split here: those up to U+024F whose lower case stays there, dashes, quotes, bullets,
#: euro sign.
_NEAR = "".join(c for c in map(chr, range(0x250)) if max(c.lower()) <= "ɏ" and c not in "\x1c\x1d\x1e\x1f")
PLAIN = re.compile(f"[^{re.escape(_NEAR)}‐-‧‰-⁞€]")
#: Byte-level pre-tokens of plain text, as the files' pattern splits them.
BYTE_LEVEL = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
#: Pre-tokens with word ends, of normalised plain text.
WORD_ENDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")
ASCII_WORD_ENDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^\t-\r A-Za-z0-9]+")
#: Pre-tokens encoded at once.
MADE = 5_000
#: Pre-tokens that each of the two generations of a worker's cache holds at most: some 100 MB for both.
CACHED = 250_000


class Cache:
    """A bounded map in two generations: once the younger one is full it takes the place of the older, which goes. What
    is asked for again moves to the younger, so frequent words stay."""

    def __init__(self, most: int = CACHED):
        self.most, self.young, self.old = most, {}, {}

    def get(self, word: str):
        return self.known((word,))[word]

    def known(self, words) -> dict:
        """The value of each of the words, None for those that are not here."""
        young, old, found = self.young.get, self.old.get, {}
        for word in words:
            value = young(word)
            if value is None and (value := old(word)) is not None:
                self.put(word, value)
                young, old = self.young.get, self.old.get
            found[word] = value
        return found

    def put(self, word: str, value) -> None:
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[word] = value


def _word_ends(text: str) -> list[str]:
    if text.isascii():
        return ASCII_WORD_ENDS.findall(text.lower())
    return WORD_ENDS.findall(unicodedata.normalize("NFC", text).lower())


def splitter(library: Tokenizer):
    """The function that gives the pre-tokens of a plain text, for the kinds of tokenizer known here; else None."""
    state = lambda part: json.loads(part.__getstate__()) if part else {}
    steps, normal = state(library.pre_tokenizer), state(library.normalizer)
    if steps.get("type") == "ByteLevel" and steps.get("use_regex") and not steps.get("add_prefix_space") and not normal:
        return BYTE_LEVEL.findall
    kinds = [x["type"] for x in steps.get("pretokenizers", [])], [x["type"] for x in normal.get("normalizers", [])]
    if kinds == (["Split", "ByteLevel"], ["NFC", "Replace", "Lowercase"]):
        return _word_ends
    return None


class Encoder:
    """Ids of texts without special tokens. Their strings inside a text are found as the library does by default."""

    def __init__(self, path: str, cached: int = CACHED):
        # pre-tokens are normalised and split already: all that is left to do is the byte mapping and the merges; the
        # cache is here, so the model needs none of its own
        self.path, self.words = path, Tokenizer.from_file(path)
        self.normalizer, self.steps = self.words.normalizer, self.words.pre_tokenizer
        self.split = splitter(self.words)
        added = [token.content for token in self.words.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.size = self.words.get_vocab_size(with_added_tokens=True)
        self.words.normalizer = None
        self.words.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self.words.model._resize_cache(0)
        self.cache = Cache(cached)

    @cached_property
    def library(self) -> Tokenizer:
        """The tokenizer as its file has it, for texts that hold the string of a special token."""
        return Tokenizer.from_file(self.path)

    def pre_tokens(self, text: str) -> list[str] | None:
        """The pre-tokens of a text, or None where only the whole text will do: with strings of special tokens inside,
        or a tokenizer of a kind not known here."""
        if self.split is None or (self.special and self.special.search(text)):
            return None
        if not PLAIN.search(text):
            return self.split(text)
        if self.normalizer:
            text = self.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.steps.pre_tokenize_str(text)]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return [made.ids for made in self.words.encode_batch_fast(words, add_special_tokens=False)]

    def ids(self, batch: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [self.pre_tokens(text) for text in batch]
        young = self.cache.young.get
        found = [None if words is None else list(map(young, words)) for words in split]
        holes = [() if parts is None else [i for i, part in enumerate(parts) if part is None] for parts in found]
        met = self.cache.known({words[i] for words, at in zip(split, holes) for i in at})
        missing = [word for word, raw in met.items() if raw is None]
        for start in range(0, len(missing), MADE):
            names = missing[start : start + MADE]
            for name, ids in zip(names, self.encode_words(names)):
                met[name] = array("I", ids).tobytes()
                self.cache.put(name, met[name])
        out = []
        for text, words, parts, at in zip(batch, split, found, holes):
            if words is None:
                out.append(np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4"))
                continue
            for i in at:
                parts[i] = met[words[i]]
            out.append(np.frombuffer(b"".join(parts), "<u4"))
        return out


@lru_cache(maxsize=1)
def encoder(path: str, cached: int = CACHED) -> Encoder:
    """One encoder in a worker, kept from task to task; another file's takes its place."""
    return Encoder(path, cached)
