"""Exact tokenisation by space-delimited units, so that repeated words are encoded once.

A byte-level BPE with the usual pre-token pattern never lets a pre-token cross the place before
a single space whose left neighbour isn't white space, nor before the last of several white
space characters if that is a space and a word follows. So a text is the run of its units, "w0",
" w1", " w2" ..., each encoded by the library on its own. Texts where that may not hold (a space
between two white space characters or at the end after one, or a special token's string) are
given to the library whole.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Callable

SPECIAL = "<|endoftext|>"
_EXOTIC = re.compile(r"[^\S \n]")
_UNSAFE = re.compile(r"\s (?:\s|$)")


def divisible(text: str) -> bool:
    """True if the units of text, split at each space, encode to the ids of the whole text."""
    if SPECIAL in text:
        return False
    if "  " in text or " \n" in text or text.endswith(" ") or _EXOTIC.search(text):
        return not _UNSAFE.search(text)
    return True


class _Tier(dict):
    def __init__(self, encode: Callable[[str], object], prefix: str, limit: int, frequent: dict | None):
        super().__init__(frequent or {})
        self.encode, self.prefix, self.limit, self.frequent = encode, prefix, limit + len(self), frequent or {}

    def __missing__(self, word: str):
        if len(self) >= self.limit:  # the recent tier starts anew; the frequent tier stays
            self.clear()
            self.update(self.frequent)
        value = self[word] = self.encode(self.prefix + word)
        return value


class UnitCache:
    """encode(unit) behind a bounded cache in the worker; frequent: values known beforehand by word."""

    def __init__(self, encode: Callable[[str], object], limit: int = 250_000, frequent: dict | None = None):
        self.encode = encode
        self.first = _Tier(encode, "", max(1, limit // 8), None)
        self.rest = _Tier(encode, " ", limit, frequent)

    def values(self, text: str) -> list:
        """The values of a text's units, in order."""
        if not divisible(text):
            return [self.encode(text)]
        words = text.split(" ")
        out = list(map(self.rest.__getitem__, words[1:]))
        out.insert(0, self.first[words[0]])
        return out


def vocabulary_path(name: str) -> str:
    """The place of a vocabulary file of public_tokenizers; other paths stay as they are."""
    import public_tokenizers

    return name if "/" in name else public_tokenizers.path(name)


def splits_at_spaces(name: str) -> bool:
    """Whether a vocabulary file's pre-tokenizer never lets a pre-token cross the place before a space: byte level with
    the usual pattern, no normaliser, and no special string but SPECIAL."""
    if not name.endswith(".json"):
        return False
    with open(vocabulary_path(name), encoding="utf-8") as f:
        own = json.load(f)
    before = own.get("pre_tokenizer") or {}
    usual = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    return bool(usual and own.get("normalizer") is None and {t["content"] for t in own.get("added_tokens") or []} <= {SPECIAL})


def load_tokenizer(name: str):
    """The library's tokenizer for a vocabulary file (.json or .model)."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    path = vocabulary_path(name)
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Characters for which the two libraries' tables agree: no control or special strings, Latin script.
_PLAIN = re.compile(r"[\n\x20-;=-~\u00a1-\u024f]*")


def unit_encoder(name: str) -> Callable[[str], list[int]]:
    """ids of a unit or text as the .json tokenizer gives them.

    If the same vocabulary lies beside it as ranks (.tiktoken), plain units are encoded from the
    ranks, which takes a fraction of the time for the same ids; all else goes to the tokenizer.
    """
    library = load_tokenizer(name)
    ranks_path = vocabulary_path(name)[: -len(".json")] + ".tiktoken"
    if not os.path.exists(ranks_path):
        return lambda u: library.encode(u, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    ordinary = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    plain = _PLAIN.fullmatch
    return lambda u: ordinary(u) if plain(u) else library.encode(u, add_special_tokens=False).ids
