"""Token ids of a public byte-level BPE vocabulary.

The ids are those of the ``tokenizers`` library.  For speed they come from the same
vocabulary as ranks through ``tiktoken``; texts that hold the string of a special
token, which the two treat differently, or a run of white space of LONG_RUN
characters, on which the other's matcher exhausts its stack, go to ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array

import numpy as np

SPECIAL = "<|endoftext|>"
LONG_RUN = 10_000
_LONG_RUN = re.compile(rf"(?<!\s)\s{{{LONG_RUN}}}")


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken

        ranks = {}
        with open(ranks_path, "rb") as f:
            for line in f:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self._encode = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._json_path, self._slow = json_path, None

    def _by_library(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._json_path)
        return self._slow.encode(text, add_special_tokens=False).ids

    def ids(self, text: str, end: int | None = None) -> np.ndarray:
        """Ids of the text, without special tokens; end, if any, is put behind them."""
        if SPECIAL in text or len(text) > LONG_RUN and _LONG_RUN.search(text):
            got = self._by_library(text)
        else:
            try:
                got = self._encode(text)
            except BaseException as e:  # a panic is no Exception
                if type(e).__name__ != "PanicException":
                    raise
                got = self._by_library(text)
        if end is not None:
            got.append(end)
        return np.frombuffer(array("I", got), np.uint32)


@functools.cache
def encoder(json_path: str | None = None, ranks_path: str | None = None) -> Encoder:
    import public_tokenizers

    return Encoder(json_path or default_path(), ranks_path or default_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
