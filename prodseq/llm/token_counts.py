"""Token counts of a lower-casing BPE with word ends, by rank-synchronous array merging."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from prodseq.llm.batches import over_texts, texts_of
from prodseq.llm.merging import PairTable, merge

#: Distinct pre-tokens whose counts a worker remembers before it starts anew.
REMEMBERED = 400_000

#: Fixed: white space of the Unicode property White_Space, as code point ranges.
SPACES = ((9, 13), (32, 32), (133, 133), (160, 160), (5760, 5760), (8192, 8202), (8232, 8233), (8239, 8239), (8287, 8287), (12288, 12288))

#: Fixed: the apostrophe endings that are pre-tokens of their own.
ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def _class_of(first_letter: str) -> str:
    """Character-class ranges of all code points whose category starts with the letter."""
    spans, start = [], None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and unicodedata.category(chr(code))[0] == first_letter
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            spans.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(spans)


@lru_cache(maxsize=1)
def _pattern() -> re.Pattern:
    letters, numbers = _class_of("L"), _class_of("N")
    spaces = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in SPACES)
    return re.compile("|".join([*ENDINGS, f"[{letters}]+", f"[{numbers}]", f"[^{spaces}{letters}{numbers}]+"]))


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class WordMerger:
    """Counts tokens of texts with the vocabulary file of a BPE that marks word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        vocabulary, merges = whole["model"]["vocab"], whole["model"]["merges"]
        end = whole["model"]["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left, right, product = (np.array([vocabulary[x] for x in part]) for part in zip(*((a, b, a + b) for a, b in pairs), strict=True))
        self.table = PairTable.build(left, right, np.arange(len(pairs)), product, max(vocabulary.values()) + 1)
        letters = _byte_letters()
        self.inner = np.array([vocabulary[x] for x in letters], np.int32)
        self.final = np.array([vocabulary[x + end] for x in letters], np.int32)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in whole["added_tokens"]))
        self.known: dict[str, int] = {}

    def learn(self, words: list[str]) -> None:
        """Merge the given distinct pre-tokens and remember their token counts."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.final[flat[ends]]
        self.known.update(zip(words, merge(symbols, lengths, self.table)[1].tolist(), strict=True))

    def pre_tokens(self, text: str) -> list[str]:
        # lower-casing goes letter by letter, so a capital sigma never becomes the final form
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return _pattern().findall(lowered)

    def counts(self, texts: list[str]) -> list[int]:
        extra = [0] * len(texts)
        split: list[list[str]] = []
        for i, text in enumerate(texts):
            parts = self.special.split(text) if "<|" in text else [text]
            extra[i] = len(parts) - 1
            split.append(self.pre_tokens(parts[0]) if len(parts) == 1 else list(chain.from_iterable(map(self.pre_tokens, parts))))
        if len(self.known) > REMEMBERED:
            self.known.clear()
        unseen = set(chain.from_iterable(split)).difference(self.known)
        if unseen:
            self.learn(list(unseen))
        return [n + sum(map(self.known.__getitem__, words)) for n, words in zip(extra, split, strict=True)]


@lru_cache(maxsize=2)
def word_merger(path: str) -> WordMerger:
    return WordMerger(path)


def count_tokens(frame: DataFrame, path: str, limit: int = 2048, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Bytes, tokens and whether a text is over ``limit`` tokens, one row per input row.

    A missing text counts as empty (no tokens); ids may be missing or repeated, each row is
    counted by itself. Other columns of the input are not read. Special strings inside
    a text count as one token each. ``path`` names a vocabulary file every executor has.
    """

    def run(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch, text_column)
        tokens = np.array(word_merger(path).counts(texts), np.int64)
        return {"n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()), "n_tokens": tokens, "over_limit": tokens > limit}

    return over_texts(frame, [id_column, text_column], run, "n_bytes long, n_tokens long, over_limit boolean")
