"""Text sizes in tokens of a public tokenizer, whose vocabulary file is a parameter.

A byte-level tokenizer first cuts a text into words by a fixed pattern and then encodes each word by itself.  So a text's
size is the sum of its words' sizes, and words repeat: each worker encodes a word once and remembers its size.
Tokenizers of other kinds encode the whole text.
"""

from __future__ import annotations

import json
import re

import pandas as pd
import regex
from pyspark.sql import Column, functions as F, types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Sizes a worker remembers at a time.
HELD = 500_000

#: Fixed value: the pattern of byte-level tokenizers.
_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_RUN = re.compile(r"\s\s")


class Sizes(dict):
    """A word, or a stretch between blanks, -> its number of tokens."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        with open(vocabulary, encoding="utf-8") as f:
            plan = json.load(f)
        cut = plan.get("pre_tokenizer") or {}
        self.by_word = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True) and not plan.get("normalizer")

    def __missing__(self, word: str) -> int:
        if len(self) > HELD:
            self.clear()
        size = self.whole(word)
        if len(word) <= 100:
            self[word] = size
        return size

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def text(self, text: str) -> int:
        if not self.by_word:
            return self.whole(text)
        if _RUN.search(text):
            words = _PATTERN.findall(text)
        else:  # between single blanks the pattern never joins two stretches
            first, *rest = text.split(" ")
            words = [first, *[" " + w for w in rest]] if first else [" " + w for w in rest]
        return sum([self[w] for w in words])


def token_count(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of the whole text; null and empty texts have 0.  Special strings count as ordinary text."""

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        global _LOADED
        if _LOADED is None or _LOADED[0] != vocabulary:
            _LOADED = (vocabulary, Sizes(vocabulary))
        sizes = _LOADED[1]
        return pd.Series([sizes.text(t) if t else 0 for t in texts], dtype="int64")

    return count(text)


_LOADED = None
