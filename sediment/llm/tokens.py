"""Token ids of a published vocabulary."""

from __future__ import annotations

import json
import re

import numpy as np

# Fixed value: how the byte-level vocabulary parts a text before merging.
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Characters on which every version of the Unicode tables agrees: Latin with its accents, and punctuation.
_SETTLED = re.compile(r"[\x00-ȳ‐-‧‰-⁞₠-€]*")
# Runs without a break for the pattern are left to the reference library, which has no limit on them.
_LONG_RUN = re.compile(r"\s{2000}")


def _bytes_of_symbols() -> dict[str, int]:
    """How a byte-level vocabulary writes bytes: printable Latin-1 as itself, the rest in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    """Ids as the tokenizers library gives them for a byte-level vocabulary file, without special tokens
    added.

    That library defines the ids. Texts of settled characters go through tiktoken with the same merges,
    which is about five times as fast and equal there (tested); texts with other characters, with a
    special token's own spelling, or with very long white space go through the library itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        byte_level = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        self.fast = None
        if model.get("type") == "BPE" and byte_level and not spec.get("normalizer"):
            self.fast = self._same_merges(model)

    def _same_merges(self, model: dict):
        import tiktoken

        symbols = _bytes_of_symbols()
        special = set(self.special)
        ranks = {bytes(symbols[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
        return tiktoken.Encoding("merges", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast and _SETTLED.fullmatch(text) and not any(s in text for s in self.special) and not _LONG_RUN.search(text):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)
