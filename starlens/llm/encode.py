"""Token ids of whole texts by a public byte-level tokenizer file.

Byte-level BPE works inside the pieces that its pattern cuts, and a new piece always
starts at a space that stands before a character which isn't white space. So a text's
ids are those of its space-led words in a row, and each distinct word is encoded by the
library once and remembered. Texts that hold one of the tokenizer's special strings go
to the library whole.
"""

from __future__ import annotations

import os
import re
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

BYTE_BPE = "byte_bpe_50k.json"
#: Remembered words; beyond it only those of the present batch are kept.
MEMORY_WORDS = 600_000
#: Words that go to the library in one string.
TOGETHER = 512

#: A space that starts a piece.
PIECE_START = re.compile(r" (?=\S)")


def tokenizer_path(name: str = BYTE_BPE) -> str:
    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes texts as little-endian unsigned ids of two bytes, or four for large vocabularies."""

    def __init__(self, path: str, memory_words: int = MEMORY_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        size = self.library.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        space = self.library.pre_tokenizer.pre_tokenize_str(" ")[0][0]
        self.leads = np.array([(self.library.id_to_token(i) or "").startswith(space) for i in range(size)])
        self.memory_words = memory_words
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes; null is empty."""
        cut = [None if t and any(s in t for s in self.special) else t.split(" ") if t else [] for t in texts]
        words = set(chain.from_iterable(w[1:] for w in cut if w))
        odd = {w for w in words if not w or w[0].isspace()}
        if odd:  # a space before white space or the end doesn't start a piece
            words -= odd
            for i, w in enumerate(cut):
                if w and not odd.isdisjoint(w[1:]):
                    cut[i] = PIECE_START.split(texts[i])
                    words.update(cut[i][1:])
        self._learn(words)
        first = self.library.encode_batch_fast([w[0] for w in cut if w], add_special_tokens=False)
        head, known, out = iter(first), self.known, []
        for text, own in zip(texts, cut, strict=True):
            if own is None:
                out.append(self.whole(text))
            elif not own:
                out.append(b"")
            else:
                start = np.array(next(head).ids, dtype=self.kind).tobytes()
                out.append(start + b"".join([known[w] for w in own[1:]]))
        return out

    def _learn(self, words: set[str]) -> None:
        new = list(words.difference(self.known))
        if len(self.known) + len(new) > self.memory_words:
            self.known = {w: self.known[w] for w in words if w in self.known}
        parts = [new[i : i + TOGETHER] for i in range(0, len(new), TOGETHER)]
        size = self.kind.itemsize
        for start in range(0, len(parts), 64):
            some = parts[start : start + 64]
            encoded = self.library.encode_batch_fast([" " + " ".join(p) for p in some], add_special_tokens=False)
            for part, found in zip(some, encoded, strict=True):
                ids = np.array(found.ids, dtype=self.kind)
                held = ids.tobytes()
                at = (np.flatnonzero(self.leads[ids]) * size).tolist() + [len(held)]
                # A word that ends in white space may hold further tokens led by a space.
                if len(at) != len(part) + 1:
                    self.known.update((w, self.whole(" " + w)) for w in part)
                else:
                    self.known.update(zip(part, [held[a:b] for a, b in zip(at, at[1:], strict=False)], strict=True))


@cache
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a worker, which keeps its words from one task to the next."""
    return WordEncoder(path)
