"""Token ids of texts, in tasks."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: The vocabulary file by default; its ``.tiktoken`` twin holds the same tokens as ranks and gives the same ids, about four times faster.
VOCABULARY = "byte_bpe_50k.json"
TWINS = {"byte_bpe_50k.json": "byte_bpe_50k.tiktoken"}
#: White space without end makes the twin's library overflow its stack (seen at a million), so long runs never reach it.
LONG_SPACE = re.compile(r"\s{10000}")


@lru_cache(maxsize=4)
def encoder(vocabulary: str = VOCABULARY, twin: bool = True) -> Callable[[list[str]], list[list[int]]]:
    """From texts without strings of added tokens to id lists; see :func:`ids_of` for all texts. Loaded once per worker.

    ``vocabulary`` names a file of the public tokenizers: ``*.json`` (tokenizers) or ``*.tiktoken`` (tiktoken).
    """
    import public_tokenizers

    name = TWINS.get(vocabulary, vocabulary) if twin else vocabulary
    if name.endswith(".tiktoken"):
        import tiktoken

        with open(public_tokenizers.path(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        one = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda texts: [one(t) for t in texts]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return lambda texts: [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@lru_cache(maxsize=4)
def plain(vocabulary: str = VOCABULARY) -> tuple[Callable[[str], list[int]], tuple[str, ...]]:
    """The ``tokenizers`` call on a ``*.json`` file with its own settings, and the strings of the file's added tokens."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids, tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())


def ids_of(texts: list[str], vocabulary: str = VOCABULARY) -> list[list[int]]:
    """The ids that ``tokenizers`` gives with ``add_special_tokens=False``: the string of an added token is that token.

    The twin encodes only texts that hold no such string and no very long white space, where both give the same ids.
    """
    if vocabulary not in TWINS:
        return [plain(vocabulary)[0](t) for t in texts] if vocabulary.endswith(".json") else encoder(vocabulary)(texts)
    one, added = plain(vocabulary)
    own = [any(s in t for s in added) or LONG_SPACE.search(t) is not None for t in texts]
    fast = iter(encoder(vocabulary)([t for t, o in zip(texts, own, strict=True) if not o]))
    return [one(t) if o else next(fast) for t, o in zip(texts, own, strict=True)]


def closed_ids(texts: list[str | None], vocabulary: str = VOCABULARY, end: int = 0) -> list[np.ndarray]:
    """For each text (null: empty) its ids and then ``end``, as uint32."""
    out = []
    for ids in ids_of([t or "" for t in texts], vocabulary):
        ids.append(end)
        out.append(np.array(ids, np.uint32))
    return out
