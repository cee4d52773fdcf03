"""Tokenizer files of byte-level BPE: their tokens' bytes, and fast encoding of pieces."""

from __future__ import annotations

import os
import re

import numpy as np

from wattloom.llm.bpe import PieceCache, little_endian

#: Words joined to one text.
JOINED = 64


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE file."""
    from tokenizers import Tokenizer

    return _token_bytes(Tokenizer.from_file(path))


def _token_bytes(model) -> list[bytes]:
    letters, known = _byte_letters(), model.get_vocab()
    out = [b""] * (max(known.values()) + 1)
    for token, i in known.items():
        out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return out


class FileTokenizer:
    """A byte-level tokenizer file; ids of pieces are cached as long as the worker lives.

    With ``specials`` the string of a special token in a text is that token, as in
    the library's plain call; without, it is ordinary text.
    """

    def __init__(self, path: str, specials: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = not specials
        self.sizes = np.array([len(x) for x in _token_bytes(self.model)])  # a file is loaded once a worker
        self.cache = PieceCache(self.encode)
        special = [re.escape(t.content) for t in self.model.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special)) if specials and special else None

    def encode(self, items: list[str]) -> list[bytes]:
        """Ids of each piece.  Words after a space are encoded many at a time, joined to one text:
        pre-tokenisation cuts it into the same words again."""
        out: dict[str, bytes] = {}
        words = [x for x in items if x[0] == " " and x[1:].isalpha()]
        parts = [words[lo : lo + JOINED] for lo in range(0, len(words), JOINED)]
        for part, found in zip(parts, self.model.encode_batch_fast(list(map("".join, parts)), add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = np.cumsum(self.sizes[ids])
            bounds = np.cumsum([len(x.encode()) for x in part])
            place = np.searchsorted(ends, bounds)
            if len(ends) and ends[-1] == bounds[-1] and (ends[place] == bounds).all():
                raw, cuts = ids.tobytes(), ((place + 1) * 4).tolist()
                out.update(zip(part, map(raw.__getitem__, map(slice, [0, *cuts], cuts))))
        rest = [x for x in items if x not in out]
        if rest:
            got = self.model.encode_batch_fast(rest, add_special_tokens=False)
            out.update((x, little_endian(y.ids)) for x, y in zip(rest, got))
        return [out[x] for x in items]
