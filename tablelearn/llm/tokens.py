"""Tokens of texts by public vocabulary files, and their bytes."""

from __future__ import annotations

import base64

import numpy as np
import sentencepiece
import tiktoken
from tokenizers import Tokenizer


class ByteBpe:
    """Ids of a byte-level BPE vocabulary; strings of special tokens inside a
    text are ordinary text.

    The rank form of the vocabulary is read by tiktoken, which gives the ids of
    the ``tokenizers`` form several times faster.  Its pattern matcher gives up
    on very long runs of white space; such a text goes through ``tokenizers``
    as a whole."""

    def __init__(self, ranks_path: str, tokenizer_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.path, self.full = tokenizer_path, {}
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token

    def tokenizer(self, special_as_text: bool) -> Tokenizer:
        if special_as_text not in self.full:
            t = Tokenizer.from_file(self.path)
            t.encode_special_tokens = special_as_text
            self.full[special_as_text] = t
        return self.full[special_as_text]

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:      # the matcher's stack is full
            return np.array(self.tokenizer(True).encode(text, add_special_tokens=False).ids, np.uint32)


class Pieces:
    """Ids of a sentencepiece vocabulary with byte pieces."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i)
                              else piece.replace("▁", " ").encode())

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.uint32)
