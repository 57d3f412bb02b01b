import random

import pytest
from pyspark.sql import types as T

# Extra columns whose names operators use inside.
EXTRA = ["digest", "size", "rid", "_key", "key", "words", "copies", "n", "a", "fp", "label", "doc", "tx", "_at"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in EXTRA]
                      + [T.StructField("meta", T.MapType(T.StringType(), T.StringType()))])


def rows_of(seed=7, n=60):
    """(doc_id, text, lang, source): NULLs everywhere, empty, blank and very long texts, copies, case copies, near
    copies, shared passages, equal rows, one id with two texts, odd characters."""
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefghiklmnoprstuvwz") for _ in range(rnd.randint(2, 9))) for _ in range(900)]

    def text(k):
        out = []
        for i in range(k):
            w = rnd.choice(vocab)
            out.append(w + ("." if i % 9 == 8 else ""))
        return " ".join(out)

    rows = [(i, text(rnd.choice([3, 15, 40, 120, 300])), rnd.choice(["en", "de", None]),
             rnd.choice(["s1", "s1", "s1", "s2", "z", None])) for i in range(n)]
    passage = text(90)
    for i in (n, n + 1, n + 2):
        rows.append((i, text(30) + " " + passage + "\n" + text(25), "fr", "s2"))
    rows += [(n + 3, rows[5][1], "en", "s1"), (n + 4, rows[5][1].upper(), "en", "s1"),
             (n + 5, rows[6][1] + " tail", "en", "s1")]
    rows += [(n + 6, passage, "es", "s1"), (n + 7, passage, "es", "s1"), (n + 7, passage, "es", "s1")]  # equal rows
    rows += [(n + 8, None, None, None), (n + 9, "", "en", "s1"), (n + 10, " \n\t ", "en", "s2"), (None, "no id here", "en", "s1"),
             (None, None, None, None), (None, passage, None, "s1"), (3, "another text of an id that is there", "en", "z"),
             (n + 11, "É ß ½ 你好 😀 a  b\r\nc\x0bd ퟿ <|endoftext|> x", "de", "ü"),
             (n + 12, text(6000), "en", "s1"), (n + 13, "w" * 30000, "en", "s1"), (n + 14, "la " * 400, "en", "s2"),
             (n + 15, "12 345 ... !!", None, "s2")]
    return rows


@pytest.fixture(scope="session")
def weird_rows():
    return rows_of()


@pytest.fixture(scope="session")
def docs_frame(spark):
    def make(rows):
        full = [(i, t, lang, src, None if t is None else len(t), *[f"x{k}" for k in range(len(EXTRA))], {"k": "v"})
                for i, t, lang, src in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def weird(docs_frame, weird_rows):
    return docs_frame(weird_rows)


@pytest.fixture(scope="session")
def empty(docs_frame):
    return docs_frame([])
