"""Token ids of whole texts, by a public tokenizer file, at a speed that leaves the rest of a job in front.

A byte-level BPE first splits a text into letter runs, digit runs and so on, each with at most one blank before it, and
merges inside those pieces only. So a text in which every blank and line break stands alone between other characters
may be cut before each of them: the parts' ids, joined, are the ids of the whole. Parts repeat a great deal, so their
ids are kept in a bounded dictionary; a part of letters is one piece and needs no further splitting. Any other text
(double blanks, blank lines, very long words) goes to the tokenizer library whole.

The string of a special token inside a text is ordinary text, or, with ``special``, that token: the library's default.
Texts that hold a token which the library looks for are given to it whole.
"""

from __future__ import annotations

import json
import os
from array import array

import numpy as np

# Parts whose ids one Python worker remembers; the dictionary is emptied when it is full.
CACHE_PARTS = 400_000
# Longer parts are not cut off but sent through the tokenizer library with their text.
PART_CHARS = 64
# Characters handed to the tokenizer library in one call.
CALL_CHARS = 1 << 20


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer file, looked up where it is called: executors find their own copy."""
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte, by their published rule: printable
    Latin-1 bytes stand for themselves, the rest take the code points from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Whole(Exception):
    """A part whose text must not be cut."""


class _Parts(dict):
    """Ids of a part (as bytes) that stands after a blank, or that starts with a line break."""

    def __init__(self, pieces, dtype):
        super().__init__()
        self.pieces, self.code = pieces, {1: "B", 2: "H", 4: "I"}[dtype.itemsize]

    def __missing__(self, part: str) -> bytes:
        lead, w = ("", part[1:]) if part[:1] == "\n" else (" ", part)
        if not w or len(w) > PART_CHARS or w[0].isspace() or w[-1].isspace():
            raise _Whole
        ids = self.pieces("\n") if part[:1] == "\n" else []
        ids = ids + self.pieces(lead + w, w)
        self[part] = out = array(self.code, ids).tobytes()
        return out


class Encoder:
    """ids(texts) -> one little-endian id buffer a text; made once in each Python worker."""

    def __init__(self, path: str | None = None, dtype: str = "<u4", special: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        path = path or tokenizer_path()
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not special
        self.dtype = np.dtype(dtype)
        if self.tok.get_vocab_size() - 1 > np.iinfo(self.dtype).max:
            raise ValueError(f"{dtype} cannot hold the ids of {path}")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        vocab, letters = model.get("vocab", {}), byte_letters()
        merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
        # Parts are used where a merge's order is its id, as in rank files of the same vocabulary; else whole texts.
        self.cut = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                    and not spec.get("normalizer")
                    and all(vocab.get(m.replace(" ", "", 1)) == 256 + k for k, m in enumerate(merges)))
        # strings that the library looks for before it splits a text
        self.marks = [t["content"] for t in spec.get("added_tokens", []) if special or not t.get("special")]
        if self.cut:
            added = {t["content"] for t in spec.get("added_tokens", [])}
            ranks = {bytes(letters[c] for c in t): k for t, k in vocab.items() if t not in added}
            self.bpe = tiktoken.Encoding("parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                         special_tokens={})
            self.piece = self.bpe._core_bpe.encode_single_piece
        self.after = _Parts(self._pieces, self.dtype)

    def _pieces(self, text: str, word: str | None = None) -> list[int]:
        word = text if word is None else word
        if word.isalpha():  # letters, with the blank before them: one piece
            return self.piece(text.encode())
        if word[:-1].isalpha() and word[-1] in ".,":
            return self.piece(text[:-1].encode()) + self.piece(word[-1].encode())
        return self.bpe.encode_ordinary(text)

    def _whole(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        batch: list[str] = []
        chars = 0
        for k, t in enumerate(texts):
            batch.append(t)
            chars += len(t)
            if chars >= CALL_CHARS or k == len(texts) - 1:
                out += [np.array(e.ids, dtype=self.dtype).tobytes()
                        for e in self.tok.encode_batch_fast(batch, add_special_tokens=False)]
                batch, chars = [], 0
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as the bytes of ``dtype``; an empty text has none."""
        if not self.cut:
            return self._whole(texts)
        if len(self.after) > CACHE_PARTS:
            self.after.clear()
        out: list[bytes | None] = []
        left: list[int] = []
        get = self.after.__getitem__
        for k, t in enumerate(texts):
            parts = t.replace("\n", " \n").split(" ")
            head = parts[0]
            try:
                if any(m in t for m in self.marks):
                    raise _Whole
                if not head or len(head) > PART_CHARS or head[0].isspace() or head[-1].isspace():
                    raise _Whole
                parts[0] = "\n" + parts[0]
                # the first part has no blank before it: take it as if after a line break, without the break's ids
                ids = b"".join(map(get, parts))[self.break_bytes:]
                out.append(ids)
            except _Whole:
                out.append(None)
                left.append(k)
        for k, ids in zip(left, self._whole([texts[k] for k in left])):
            out[k] = ids
        return out  # type: ignore[return-value]

    @property
    def break_bytes(self) -> int:
        n = self.__dict__.get("_break")
        if n is None:
            n = self.__dict__["_break"] = len(self.piece(b"\n")) * self.dtype.itemsize
        return n


_ENCODERS: dict[tuple[str | None, str, bool], Encoder] = {}


def encoder(path: str | None = None, dtype: str = "<u4", special: bool = False) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    key = (path, dtype, special)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, dtype, special)
    return _ENCODERS[key]
