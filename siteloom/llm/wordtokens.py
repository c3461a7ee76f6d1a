"""Token ids of whole texts by a vocabulary of the tokenizers library, word by word.

The vocabulary file is a parameter; it must lie at that path on every machine. Words are
the runs between ASCII spaces and line feeds. A vocabulary whose pre-tokenizer drops
white space gives a text the ids of its words, one after the other, so each word is
encoded once and its ids are kept (``common.Memo``). ``splits_at_space`` tests the file's
settings; for other files each text is encoded whole.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

from siteloom.llm import common

#: A full stop or comma at the end of a word.
STOP = re.compile(r"(?<=[a-z])([.,])(?= |\n|$)")


def splits_at_space(path: str) -> bool:
    """True if no token spans white space and none depends on it (by the file's settings)."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    pre = made.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", [pre])
    drops = any(
        s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert") for s in steps
    ) and any(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") for s in steps)
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]) for t in made["added_tokens"])
    return drops and plain and made.get("post_processor") is None and made.get("truncation") is None


def lowers(path: str) -> bool:
    """True if the file's normalizer lower-cases and its pattern parts letters from punctuation."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    normal = made.get("normalizer") or {}
    lower = any(step.get("type") == "Lowercase" for step in normal.get("normalizers", [normal]))
    pre = made.get("pre_tokenizer") or {}
    patterns = [str(s.get("pattern")) for s in pre.get("pretokenizers", [pre])]
    return lower and any(r"[\\p{L}]+|" in p and r"|[^\\s\\p{L}\\p{N}]+" in p for p in patterns)


class Encoder:
    """Encodes whole texts; ``memo`` is None for vocabularies that words do not suffice for."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = "uint16" if self.library.get_vocab_size() <= 1 << 16 else "uint32"
        self.memo = common.Memo(self._words, self.dtype, 800_000) if splits_at_space(path) else None
        self.lowers = lowers(path)
        bar = self._encode(["|"])[0]
        self.bar = bar[0] if len(bar) == 1 else None

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list:
        """The ids of each word; words go to the library together, with bars between them."""
        runs: list = [()] * len(words)
        plain = [k for k, w in enumerate(words) if w and "|" not in w] if self.bar is not None else []
        for start in range(0, len(plain), 5000):
            some = plain[start : start + 5000]
            ids = np.array(self._encode([" | ".join(words[k] for k in some)])[0], self.dtype)
            ends = np.append(np.flatnonzero(ids == self.bar), len(ids)).tolist()
            begin = 0
            for k, end in zip(some, ends, strict=True):
                runs[k] = ids[begin:end]
                begin = end + 1
        single = [k for k, w in enumerate(words) if w and ("|" in w or self.bar is None)]
        for k, ids in zip(single, self._encode([words[k] for k in single]), strict=True):
            runs[k] = ids
        return runs

    def _cut(self, text: str) -> list[str]:
        if self.lowers and "<|" not in text:  # lower case could make a special token's name
            # The same ids come of lower case, and of a full stop or comma cut off a word.
            text = STOP.sub(r" \1", text.encode().translate(common.LOWER).decode())
        return text.replace("\n", " ").split(" ")

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if self.memo is None:
            return [np.array(run, self.dtype) for run in self._encode(texts)]
        return self.memo.runs_of([self._cut(text) for text in texts])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def with_end(ids: np.ndarray, end: int) -> np.ndarray:
    return np.append(ids, ids.dtype.type(end))
