"""Token ids of texts by a byte-level BPE file, fast enough for whole corpora."""

from __future__ import annotations

import json
import re

import numpy as np

from lodestep.llm.common import per_worker

# Fixed value: the pre-tokenizer pattern of byte-level BPE files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PROBE = "It's 2024: naïve tokens,  don't they'll\n\n\tdiffer… “quoted” ÀÉß 日本語 x=1;\r\n    end  "
#: Texts with a run of this many characters that no space breaks (or only spaces) take the library's own path.
LONG_RUN = 3_000


def _byte_of() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def _load(path: str):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    exact = lambda text: np.asarray(whole.encode(text, add_special_tokens=False).ids, np.uint32)
    try:
        import tiktoken
    except ImportError:
        return exact
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
    byte = _byte_of()
    vocabulary = model["model"]["vocab"]
    if any(c not in byte for token in vocabulary if token not in special for c in token):
        return exact
    ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    try:
        quick = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    except ValueError:  # ids that are no merge order
        return exact
    names = set(special)
    if any(quick.encode(t, allowed_special="all") != exact(t).tolist() for t in (_PROBE, _PROBE[::-1], *names)):
        return exact

    def encode(text: str) -> np.ndarray:
        if len(text) > LONG_RUN and (max(map(len, text.split()), default=LONG_RUN) >= LONG_RUN or re.search(r"\s{%d}" % LONG_RUN, text)):
            return exact(text)
        return np.asarray(quick.encode_to_numpy(text, allowed_special="all"), np.uint32)

    return encode


def encoder(path: str):
    """text -> uint32 ids without special tokens around them, the same that the library ``tokenizers`` gives for the file.

    The ids come from a faster implementation of the same merges where a probe shows that it agrees with the file.
    """
    return per_worker(("encoder", path), lambda: _load(path))
