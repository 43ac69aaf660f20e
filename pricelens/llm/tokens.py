"""Token ids for operators that only need ids: words by a compiled byte-pair encoder, remembered.

The merges are taken from the same vocabulary file, whose token numbers rise in merge
order (checked), so the ids are those of the tokenizers library.
"""

from __future__ import annotations

from functools import cache

import tiktoken

from . import bpe


class Words(bpe.Vocabulary):
    """A vocabulary whose words are encoded by the compiled encoder."""

    def __init__(self, path: str):
        super().__init__(path)
        numbers = [i for i, _ in sorted(self.parts.items(), key=lambda x: x[1][0])]
        if numbers != sorted(numbers):
            raise ValueError("token numbers do not rise in merge order")
        special = set(self.special.values())
        ranks = {t: i for i, t in enumerate(self.tokens) if t and i not in special}
        own = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        self.encode_word = own.encode_ordinary


@cache
def encoder(path: str) -> bpe.Codec:
    """One per Python worker."""
    return bpe.Codec(Words(path))
