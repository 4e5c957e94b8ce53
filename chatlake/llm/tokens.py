"""Tokenizers for use inside tasks. Vocabulary files are named by a path and loaded once a process."""

from __future__ import annotations

import functools
import json
import re

import numpy as np
from tokenizers import Tokenizer

#: Fixed by the vocabulary: the byte-level BPE's pattern of pre-tokens.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed by the vocabulary: the word BPE's pattern, in the terms of Python's re.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+"""
#: Texts of these characters only are split by WORD_PATTERN as the library splits them; in others
#: Python's re or lower() may differ from it (tests/llm compares them for each character).
PLAIN = r"[\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-˿]*"


@functools.cache
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@functools.cache
def _ranks(path: str):
    """A tiktoken encoding with the ids of a byte-level BPE file of the tokenizers library."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {token["content"] for token in content["added_tokens"]}
    vocabulary = content["model"]["vocab"].items()
    ranks = {bytes(map(_BYTE.__getitem__, token)): rank for token, rank in vocabulary if token not in special}
    return tiktoken.Encoding("file", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})


def _byte_letters() -> dict[str, int]:
    """Bytes as the letters that stand for them: printable ones themselves, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


_BYTE = _byte_letters()


class _Special:
    """The special strings of a vocabulary, which the library cuts out of a text first."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            added = json.load(file)["added_tokens"]
        self.ids = {token["content"]: token["id"] for token in added}
        names = sorted(self.ids, key=len, reverse=True)
        self.pattern = re.compile("|".join(f"({re.escape(name)})" for name in names)) if names else None

    def parts(self, text: str) -> list[str]:
        if self.pattern is None or not any(name in text for name in self.ids):
            return [text]
        return [part for part in self.pattern.split(text) if part]


class ByteTokens:
    """Ids of a byte-level BPE file as `Tokenizer.encode(text, add_special_tokens=False)` gives them.

    The file's ranks run in tiktoken, which is several times faster; ids are equal for every
    code point and text tried (tests/llm), special strings in the text included.
    """

    def __init__(self, path: str):
        self.encoding, self.special = _ranks(path), _Special(path)

    def ids(self, text: str) -> np.ndarray:
        encode = self.encoding.encode_ordinary
        parts = self.special.parts(text)
        ids = [[self.special.ids[p]] if p in self.special.ids else encode(p) for p in parts]
        return np.array(ids[0] if len(ids) == 1 else [i for part in ids for i in part], np.uint32)


class WordPieces:
    """Pre-tokens of a word BPE file, and how many pieces each has."""

    def __init__(self, path: str):
        self.tokenizer, self.special = library(path), _Special(path)
        self.split, self.plain = re.compile(WORD_PATTERN).findall, re.compile(PLAIN).fullmatch
        self.letters = {b: letter for letter, b in _BYTE.items()}

    def pretokens(self, text: str) -> list[str]:
        """Pre-tokens in the text's own letters, specials as themselves."""
        out: list[str] = []
        for part in self.special.parts(text):
            if part in self.special.ids:
                out.append(part)
            elif self.plain(part):
                out += self.split(part.lower())
            else:
                normal = self.tokenizer.normalizer.normalize_str(part)
                split = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
                out += [bytes(map(_BYTE.__getitem__, p)).decode("utf-8", "replace") for p, _ in split]
        return out

    def count(self, pretoken: str) -> int:
        if pretoken in self.special.ids:
            return 1
        letters = "".join(map(self.letters.__getitem__, pretoken.encode("utf-8")))
        return len(self.tokenizer.model.tokenize(letters))


class _Words(dict):
    """Ids of words as bytes, found when first asked for."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, word: str) -> bytes:
        found = self[word] = self.find(word)
        return found


class WordIds:
    """Ids of a word BPE file as `Tokenizer.encode(text, add_special_tokens=False)` gives them.

    No pre-token holds white space, so the ids of what lies between white space are found once and kept;
    more than `keep` words are forgotten after the text that brought them.
    """

    def __init__(self, path: str, keep: int):
        self.pieces, self.tokenizer, self.keep = WordPieces(path), library(path), keep
        self.model = self.tokenizer.model
        self.pretokens, self.words = _Words(self._pretoken), _Words(self._word)

    def _pretoken(self, pretoken: str) -> bytes:
        # Printable ASCII stands for itself.
        if not (pretoken.isascii() and pretoken.isprintable()):
            pretoken = "".join(map(self.pieces.letters.__getitem__, pretoken.encode("utf-8")))
        return np.array([token.id for token in self.model.tokenize(pretoken)], "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.pretokens[word]
        return b"".join(map(self.pretokens.__getitem__, self.pieces.split(word)))

    def ids(self, text: str) -> np.ndarray:
        special, out = self.pieces.special, []
        for part in special.parts(text):
            if part in special.ids:
                out.append(np.array([special.ids[part]], "<u4").tobytes())
            elif self.pieces.plain(part):
                out.append(b"".join(map(self.words.__getitem__, part.lower().split())))
            else:
                out.append(np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes())
        for kept in (self.pretokens, self.words):
            if len(kept) > self.keep:
                kept.clear()
        return np.frombuffer(b"".join(out), "<u4")
