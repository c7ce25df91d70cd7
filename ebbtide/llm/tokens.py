"""Byte-level BPE ids of whole texts."""

from __future__ import annotations

import base64
import json
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Fixed value: the public pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(path: str) -> dict[str, int]:
    """The tokens that the json beside the ranks adds; none without a json. They stand for their text wherever it occurs."""
    try:
        with open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as held:
            return {t["content"]: t["id"] for t in json.load(held).get("added_tokens", [])}
    except FileNotFoundError:
        return {}


def encoder(path: str):
    """The vocabulary at `path` (base64 ranks), loaded once per worker process."""
    # Functions are sent by value; what a worker keeps between tasks therefore hangs on a module of its own.
    kept = sys.modules.setdefault("_kept_encoders", types.ModuleType("_kept_encoders")).__dict__
    if path not in kept:
        import tiktoken
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        kept[path] = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added_tokens(path))
    return kept[path]


def encoded(texts: pa.Array, path: str) -> Iterator[np.ndarray]:
    """The ids of each text as `tokenizers` gives them; nothing is put around a text, null is empty."""
    bpe = encoder(path)
    for value in texts:
        yield np.asarray(bpe.encode(value.as_py() or "", allowed_special="all"), "<u4")
