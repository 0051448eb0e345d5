"""Token ids of a byte-level BPE file, fast and equal to the ``tokenizers`` library's.

A vocabulary whose ids follow the order of its merges can be run by tiktoken's encoder, which is about
three times as fast; any other file, and texts that encoder cannot take, go to ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

# The split of text before merging that a byte-level pre-tokenizer with ``use_regex`` makes (a fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The look-ahead in the split backtracks over white space; longer runs overflow the encoder's stack.
_LONG_SPACE = re.compile(r"\s{500}")


def byte_alphabet() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: printable bytes stand for themselves, the others in
    order for the code points from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def token_bytes(path: str) -> list[bytes]:
    """Bytes of each id; added tokens are their UTF-8 text."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = byte_alphabet()
    added = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    vocab = {i: bytes(alphabet[c] for c in token) for token, i in spec["model"]["vocab"].items() if i not in added}
    vocab |= added
    return [vocab.get(i, b"") for i in range(max(vocab) + 1)]


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Bytes -> rank where ids are ranks: single bytes, then every merge in order; None for other files."""
    model, pre = spec["model"], spec["pre_tokenizer"]
    plain = (
        model["type"] == "BPE"
        and not model.get("dropout")
        and not model.get("ignore_merges")
        and not model.get("continuing_subword_prefix")
        and not model.get("end_of_word_suffix")
        and spec["normalizer"] is None
        and pre is not None
        and pre["type"] == "ByteLevel"
        and pre["use_regex"]
        and not pre["add_prefix_space"]
    )
    if not plain:
        return None
    alphabet, vocab = byte_alphabet(), model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab.get(a + b, -1) for a, b in merges]
    first = len(alphabet)
    if sorted(vocab[c] for c in alphabet if c in vocab) != list(range(first)) or made != list(range(first, first + len(made))):
        return None
    added = {t["id"] for t in spec["added_tokens"]}
    return {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if i not in added}


class ByteBpe:
    """Ids of texts. With ``plain_special`` the strings of added tokens in a text are ordinary text; else each
    becomes its one id, as ``encode(text, add_special_tokens=False)`` does."""

    def __init__(self, path: str, plain_special: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_special
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec["added_tokens"]
        self.added = {} if plain_special else {t["content"]: t["id"] for t in added}
        odd = any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added) and not plain_special
        # A token that is not special stays one even in plain text.
        odd = odd or (plain_special and any(not t["special"] for t in added))
        ranks = None if odd else _ranks(spec)
        self.fast = None
        if ranks is not None:
            import tiktoken

            self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=self.added)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or _LONG_SPACE.search(text):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all" if self.added else set(), disallowed_special=())


_encoders: dict[tuple[str, bool], ByteBpe] = {}


def byte_bpe(path: str, plain_special: bool) -> ByteBpe:
    """One encoder a process."""
    key = (path, plain_special)
    if key not in _encoders:
        _encoders[key] = ByteBpe(path, plain_special)
    return _encoders[key]
