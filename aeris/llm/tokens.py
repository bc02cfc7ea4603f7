"""Token ids of the public byte-level BPE vocabulary, the same in both libraries that read it.

The ids are those of ``tokenizers`` with the JSON file. Texts of Latin characters are encoded with the rank file of the
same vocabulary, which is several times faster; any other text goes through the JSON file itself, so that a library's
newer character tables can't make a difference, and so does a text with a long run of white space, on which the faster library's
pattern may run out of stack, or on which it fails in any other way."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np

#: What the rank file's library is not asked for: characters beyond Latin, and this many white-space characters in a row.
_NOT_FAST = re.compile(r"[^\x00-ɏ]|\s{1000}")


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class ByteBpe:
    def __init__(self, json_file: str, rank_file: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(json_file)
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        special = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        self.latin = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        """uint32 ids without added special tokens; a special token's string in the text is that token."""
        if not _NOT_FAST.search(text):
            try:
                return self.latin.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # the library's pattern gave up
                pass
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


@lru_cache(maxsize=4)
def byte_bpe(json_file: str, rank_file: str) -> ByteBpe:
    """One tokenizer per worker process."""
    return ByteBpe(json_file, rank_file)
