"""Fill-in-the-middle: cuts a text into prefix, middle and suffix between tokens, and writes them in another order.

A token is a word with the ASCII white space before it; white space at a text's end is a token of its own. Cuts, forms
and orders come from a hash of the document id, so reruns agree. Texts are read as UTF-8 bytes, many at once: tokens are
found by comparing neighbouring bytes, and cuts are byte places. Between bytes and code points a sparse index of
exceptions converts: only the characters of several bytes are recorded, with the bytes they have beyond one; a place
before the first of them is the same number in both, any other differs by the excess recorded before it, which
``searchsorted`` finds. A text of ASCII records nothing.

Forms: ``plain`` is the text itself; ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle; ``spm`` is ``<S>`` suffix
``<P>`` prefix ``<M>`` middle. A text that is empty or contains one of the marks is plain, so ``restored`` can always
rebuild the text: marks cannot arise where parts meet, since no mark begins as another ends.

Cases: a NULL text is an empty one: no token, plain, an empty output; a NULL id counts as an empty id in the hash; equal
rows give equal rows; texts of any length are cut whole; columns other than id and text are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recheck.llm.common import quoted

SEED = 42
MARKS = (b"<P>", b"<S>", b"<M>")
PLAIN_PERCENT = 50  # texts of 100 that stay as they are
SPM_PERCENT = 80  # of 100 others in the order suffix, prefix, middle
BLOCK_BYTES = 1 << 22  # of text looked at together; a longer text is a block by itself

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Exceptions:
    """Places of the characters of several bytes in UTF-8 ``data``, and the bytes they have in excess of one."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate([[0], np.cumsum(excess)])
        self.char = self.at - self.before[:-1]

    def chars(self, places: np.ndarray) -> np.ndarray:
        """Code points before each byte place (a place between characters)."""
        return places - self.before[np.searchsorted(self.at, places)]

    def bytes(self, chars: np.ndarray) -> np.ndarray:
        """Byte place of each number of code points."""
        return chars + self.before[np.searchsorted(self.char, chars)]


def token_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte places behind the tokens of the texts ``data[offsets[i]: offsets[i + 1]]``, in order."""
    if not len(data):
        return np.zeros(0, np.int64)
    space = _SPACE[data]
    last = np.empty(len(data), bool)
    last[:-1] = space[1:] & ~space[:-1]
    last[offsets[1:][np.diff(offsets) > 0] - 1] = True
    return np.flatnonzero(last) + 1


def cuts(data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """(tokens, place behind the prefix, place behind the middle) of each text."""
    ends = token_ends(data, offsets)
    first = np.searchsorted(ends, offsets[:-1], "right")
    n = np.searchsorted(ends, offsets[1:], "right") - first
    a, b = h1 % (n + 1), h2 % (n + 1)
    ends = np.append(ends, 0)  # looked up, but not used, where no token is before the cut

    def place(k: np.ndarray) -> np.ndarray:
        return np.where(k > 0, ends[first + np.maximum(k, 1) - 1], offsets[:-1])

    return n, place(np.minimum(a, b)), place(np.maximum(a, b))


def joined(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    p, s, m = MARKS
    return b"".join((p, prefix, s, suffix, m, middle) if form == "psm" else (s, suffix, p, prefix, m, middle))


def blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of texts with ``BLOCK_BYTES`` together, or of one longer text."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
        yield at, whole[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at]
        at = to


def rearranged(texts: pa.Array, h: list[np.ndarray], plain_percent: int = PLAIN_PERCENT,
               spm_percent: int = SPM_PERCENT) -> Iterator[tuple]:
    """(first row, tokens, forms, prefix_chars, middle_chars, outputs) of runs of texts."""
    for at, data, offsets in blocks(texts):
        own = [x[at: at + len(offsets) - 1] for x in h]
        n, a, b = cuts(data, offsets, own[0], own[1])
        index = Exceptions(data)
        begin, mid, end = (index.chars(x) for x in (offsets[:-1], a, b))
        view, forms, outputs = memoryview(data), [], []
        for i, plain in enumerate(own[2] % 100 >= plain_percent):
            text = bytes(view[offsets[i]: offsets[i + 1]])
            if plain or not text or any(m in text for m in MARKS):
                forms.append("plain")
                outputs.append(text)
                continue
            forms.append("spm" if own[3][i] % 100 < spm_percent else "psm")
            x, y = a[i] - offsets[i], b[i] - offsets[i]
            outputs.append(joined(forms[-1], text[:x], text[x:y], text[y:]))
        cut = np.array([f == "plain" for f in forms], bool)
        yield (at, n, pa.array(forms, pa.string()), pa.array(mid - begin, mask=cut), pa.array(end - mid, mask=cut),
               pa.array(outputs, pa.binary()))


def hashes(doc_id: Column, seed: int = SEED) -> list[Column]:
    """The first four 8-digit groups of SHA-256 over ``seed:doc_id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
              plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars (NULL if plain), output of every row."""
    h = hashes(F.col(quoted(doc_id)), seed)
    rows = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).cast("string").alias("text"),
                       *[x.alias(f"h{k + 1}") for k, x in enumerate(h)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = batch.column(0), [c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]]
            for at, n, forms, prefix, middle, outputs in rearranged(batch.column(1), own, plain_percent, spm_percent):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(n)), pa.array(n, pa.int64()), forms, prefix.cast(pa.int64()),
                     middle.cast(pa.int64()), outputs],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(scan, f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                                "output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``transform`` made ``output`` of."""
    p, s, m = (m.decode() for m in MARKS)

    def parts(one: str, two: str) -> tuple[Column, Column, Column]:
        """What stands behind the first mark, ``one`` and ``two``."""
        at, to = F.instr(output, one), F.instr(output, two)
        return (F.substring(output, F.lit(4), at - 4), F.substring(output, at + 3, to - at - 3),
                F.substring(output, to + 3, F.length(output)))

    prefix, suffix, middle = parts(s, m)
    suffix_2, prefix_2, middle_2 = parts(p, m)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(prefix_2, middle_2, suffix_2)).otherwise(output))
