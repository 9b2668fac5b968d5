"""Token ids of texts by the byte-level vocabulary of the public tokenizers.

Ids equal those of ``tokenizers`` for ``byte_bpe_50k.json`` without special tokens. They are made by ``tiktoken`` from the
same vocabulary as ranks, which is four times as fast; a text that its pattern engine gives up on goes to ``tokenizers``.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

VOCABULARY = "byte_bpe_50k"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Folder and stem of the vocabulary files, which every machine has where Python packages are installed."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json").removesuffix(".json")


class Encoder:
    def __init__(self, path: str | None = None):
        import public_tokenizers
        import tiktoken

        self.path = path or vocabulary_path()
        with open(f"{self.path}.tiktoken", "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self._fast = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._whole = None
        # Bytes of each token, by id.
        self.lengths = np.zeros(max(ranks.values()) + 2, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def whole(self):
        """The ``tokenizers`` form of the vocabulary; strings of special tokens in a text are ordinary text."""
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(f"{self.path}.json")
            self._whole.encode_special_tokens = True
        return self._whole

    def ids(self, text: str) -> np.ndarray:
        try:
            ids = self._fast.encode_ordinary(text)
        except (KeyboardInterrupt, SystemExit):
            raise
        except BaseException:  # the pattern engine panics on extreme runs of blanks
            ids = self.whole().encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4")


@lru_cache(maxsize=1)
def encoder(path: str | None = None) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)
