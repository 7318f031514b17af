"""Token counts and boundaries by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import importlib.util
import os
import re
from functools import cache

import numpy as np

#: Where the vocabularies of public tokenizers lie unless a caller names another file.
DEFAULT_VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the published pattern by which texts are cut into words before byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of white space beyond this length are encoded in parts; the pattern's engine fails on them.
SPACE_RUN = 20_000
_LONG_SPACE = re.compile(r"\s{%d}" % SPACE_RUN)


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    """The file of a vocabulary: ``name`` itself if it is a path, else from the installed collection."""
    if os.path.isabs(name):
        return name
    if spec := importlib.util.find_spec("public_tokenizers"):
        return os.path.join(os.path.dirname(spec.origin), name)
    return os.path.join("/opt/tokenizers", name)


@cache
def encoder(path: str):
    """The tokenizer of a rank file, once a process; it needs nothing but the file."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@cache
def _lengths(path: str) -> np.ndarray:
    own = encoder(path)
    sizes = np.zeros(own.max_token_value + 1, dtype=np.int64)
    for token in range(len(sizes)):
        try:
            sizes[token] = len(own.decode_single_token_bytes(token))
        except KeyError:
            pass
    return sizes


def encode(text: str, path: str) -> list[int]:
    """Tokens of a text of any length; they spell out the text."""
    own = encoder(path)
    if len(text) < SPACE_RUN or not (cuts := [m.end() for m in _LONG_SPACE.finditer(text)]):
        return own.encode_ordinary(text)
    parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
    return [token for part in parts if part for token in own.encode_ordinary(part)]


def count(text: str | None, path: str) -> int:
    """Tokens of a text; a null or empty one has none."""
    return len(encode(text, path)) if text else 0


def ends(text: str, path: str) -> np.ndarray:
    """Byte offsets at which the text's tokens end."""
    return np.cumsum(_lengths(path)[np.asarray(encode(text, path), dtype=np.int64)])
