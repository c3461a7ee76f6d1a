"""Token ids of whole texts by a byte-level vocabulary of the tokenizers library, word by word.

The vocabulary file is a parameter; it must lie at that path on every machine. Its pre-tokenizer
cuts a text into matches of the public byte-level pattern and merges each alone. No match crosses

- the place before a space between two characters that are not white space (it begins the next match),
- both sides of a line feed between two such characters,
- the place between a letter and a full stop or comma before white space,

so a text is cut there, each different word is encoded once and its ids are kept
(``common.Memo``). Texts with white space next to white space are cut at the first kind of place only.
``by_words`` tests the file's settings; for other files each text is encoded whole. Where the file's
merges come in the order of their ids (``ranks``), plain words are merged by tiktoken, whose ranks are
those ids: the same ids, five times as fast.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

from siteloom.llm import common

STOP = re.compile(r"(?<=[A-Za-z])(?=[.,](?: |\n|$))")
WIDE = re.compile(r"\s\s")
BEFORE = re.compile(r"(?<=\S)(?= \S)")
PLAIN = re.compile(r" ?\S+")
MARK = "\x00"


def by_words(path: str) -> bool:
    """True if the file merges each match of the byte-level pattern alone and changes no character."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    pre, model = made.get("pre_tokenizer") or {}, made["model"]
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not WIDE.search(t["content"]) for t in made["added_tokens"])
    plain = plain and all(" " not in t["content"] and "\n" not in t["content"] and MARK not in t["content"] for t in made["added_tokens"])
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    whole = made.get("normalizer") is None and made.get("truncation") is None and made.get("post_processor") is None
    return bool(byte_level and plain and whole and model["type"] == "BPE" and not model.get("dropout"))


def ranks(path: str) -> dict[bytes, int] | None:
    """The bytes of each token with its id, if merges come in the order of ids; else None."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocabulary, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    # Bytes that print stand for themselves, the others for the characters from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    made = [*sorted(byte, key=vocabulary.get), *("".join(m) for m in merges)]
    if [vocabulary.get(token) for token in made] != list(range(len(made))):
        return None
    return {bytes(map(byte.__getitem__, token)): k for k, token in enumerate(made)}


class Encoder:
    """Encodes whole texts; ``memo`` is None for vocabularies that words do not suffice for."""

    def __init__(self, path: str, limit: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = "uint16" if self.library.get_vocab_size() <= 1 << 16 else "uint32"
        self.feed = self._encode(["\n"])[0]
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.memo = common.Memo(self._words, self.dtype, limit) if by_words(path) and len(self.feed) == 1 else None
        table = ranks(path) if self.memo else None
        self.merges = table and tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list:
        """The ids of each word; plain words are encoded together, a line feed between them."""
        runs: list = [()] * len(words)
        plain = [k for k, w in enumerate(words) if PLAIN.fullmatch(w) and not any(a in w for a in self.added)]
        known = set(plain)
        alone = [k for k, w in enumerate(words) if w and k not in known]
        for start in range(0, len(plain), 5000):
            some = plain[start : start + 5000]
            text = "\n".join(words[k] for k in some)
            ids = np.array(self.merges.encode_ordinary(text) if self.merges else self._encode([text])[0], self.dtype)
            ends = np.append(np.flatnonzero(ids == self.feed[0]), len(ids)).tolist()
            begin = 0
            for k, end in zip(some, ends, strict=True):
                runs[k] = ids[begin:end]
                begin = end + 1
        for k, ids in zip(alone, self._encode([words[k] for k in alone]), strict=True):
            runs[k] = ids
        return runs

    def cut(self, text: str) -> list[str]:
        if MARK in text or WIDE.search(text):
            return BEFORE.split(text)
        text = STOP.sub(MARK, text)
        return text.replace("\n", "\x00\n\x00").replace(" ", "\x00 ").split(MARK)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if self.memo is None:
            return [np.array(run, self.dtype) for run in self._encode(texts)]
        return self.memo.runs_of([self.cut(text) for text in texts])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
