"""Hashed character n-gram counts of whole texts, in NumPy: no Python step per character or n-gram."""

from __future__ import annotations

import numpy as np

# Characters looked at together; longer texts come in pieces that overlap by the longest n-gram.
BLOCK_CHARS = 1 << 19
BLOCK_ROWS = 256


def letters_only() -> np.ndarray:
    """Code point -> lower-case code point for letters, blank for anything else (first 65,536 code points)."""
    out = np.full(1 << 16, 32, np.uint32)
    for c in range(1 << 16):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def codes(texts: list[str], fold: np.ndarray | None) -> np.ndarray:
    """Code points of the texts, each followed by a 0."""
    raw = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    if fold is None:
        return raw
    return np.where(raw == 0, 0, np.where(raw < len(fold), fold[np.minimum(raw, len(fold) - 1)], raw)).astype(np.uint32)


def pieces(texts: list[str], overlap: int):
    """(row, piece, starts): n-grams may begin at the first ``starts`` characters of a piece."""
    for row, t in enumerate(texts):
        for at in range(0, max(1, len(t)), BLOCK_CHARS):
            yield row, t[at: at + BLOCK_CHARS + overlap], min(BLOCK_CHARS, len(t) - at) + (at + BLOCK_CHARS >= len(t))


def blocks(texts: list[str], overlap: int):
    rows, parts, starts, chars = [], [], [], 0
    for row, p, n in pieces(texts, overlap):
        if rows and (chars + len(p) > BLOCK_CHARS or len(rows) >= BLOCK_ROWS):
            yield rows, parts, starts
            rows, parts, starts, chars = [], [], [], 0
        rows.append(row)
        parts.append(p)
        starts.append(n)
        chars += len(p)
    if rows:
        yield rows, parts, starts


def counts(texts: list[str], orders: tuple[int, ...], dims: int, fold: np.ndarray | None = None,
           seed: int = 0) -> np.ndarray:
    """(texts, dims) counts of the n-grams of the given orders, hashed to ``dims`` (a power of two) columns. The end of
    a text counts as one more character; a text's beginning is marked by the caller if it matters."""
    out = np.zeros((len(texts), dims), np.float32)
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    for rows, parts, starts in blocks([t.replace("\0", " ") for t in texts], max(orders) - 1):
        c = codes(parts, fold)
        lengths = np.array([len(p) + 1 for p in parts])
        piece = np.repeat(np.arange(len(parts)), lengths)
        place = np.arange(len(c)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        may = place < np.array(starts)[piece]
        got = np.zeros(len(parts) * dims, np.int64)
        for n in orders:
            m = len(c) - n + 1
            if m <= 0:
                continue
            h = np.full(m, (seed * 131 + n) * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for j in range(n):
                h = (h ^ c[j: j + m]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(13)
            h = (h * np.uint32(0xC2B2AE35)) >> shift
            ok = may[:m] & (piece[:m] == piece[n - 1:])
            got += np.bincount(piece[:m][ok] * dims + h[ok], minlength=len(got))
        np.add.at(out, np.array(rows), got.reshape(len(parts), dims).astype(np.float32))
    return out


def normalised(x: np.ndarray) -> np.ndarray:
    """Square roots of the counts, each row of length 1 (zero rows stay zero)."""
    x = np.sqrt(x)
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n > 0, n, 1)
