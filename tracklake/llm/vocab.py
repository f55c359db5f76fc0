"""Encoders over the public vocabulary files, kept once for each Python worker."""

from __future__ import annotations

import base64
import functools
import os
import re
from collections.abc import Callable

import public_tokenizers

#: Texts of these characters alone are split alike by every regex engine, whatever its Unicode version.
PLAIN = re.compile("[\x00-\x1b\x20-ɏ‐-‧‰-⁞€]*")


@functools.cache
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@functools.cache
def ranks(path: str):
    """The tiktoken encoder over the rank file that stands beside a byte-level .json, if there is one."""
    beside = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(beside):
        return None
    import tiktoken

    with open(beside, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})


@functools.cache
def byte_bpe(path: str) -> Callable[[str], list[int]]:
    """text -> ids as tokenizers' encode(text, add_special_tokens=False).

    The rank file holds the same vocabulary and its encoder is several times faster; texts that hold a
    special token's string, or characters on which Unicode versions may differ, go to the library.
    """
    exact, fast = library(path), ranks(path)
    special = [t.content for t in exact.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        if fast is None or not PLAIN.fullmatch(text) or any(s in text for s in special):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode
