"""Token ids of whole texts, inside tasks."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np

ID_BYTES = 2  # identifiers of a vocabulary of up to 65,536 entries
_COMMON = re.compile("[\x00-ɏ‐-‧]*")


class Encoder:
    """Identifiers by a ``tokenizers`` file.

    Where a file with the same vocabulary as ranks is given, texts of common characters (ASCII, Latin letters, usual
    punctuation) without a special token are encoded by ``tiktoken``, which gives the same identifiers three times as
    fast. With ``specials_as_text`` the strings of special tokens are ordinary text. All other texts go to ``tokenizers`` itself, so that tables of character classes cannot differ.
    """

    def __init__(self, path: str, ranks_path: str | None = None, specials_as_text: bool = False):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = specials_as_text
        if self.exact.get_vocab_size() > 1 << (8 * ID_BYTES):
            raise ValueError("identifiers do not fit in two bytes")
        self.specials = []
        if not specials_as_text:
            self.specials = [token.content for token in self.exact.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_path is not None:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u2")
        if self.fast is not None and _COMMON.fullmatch(text) and not any(token in text for token in self.specials):
            return np.array(self.fast.encode_ordinary(text), "<u2")
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u2")


@lru_cache(maxsize=2)
def encoder(path: str, ranks_path: str | None = None, specials_as_text: bool = False) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path, ranks_path, specials_as_text)
