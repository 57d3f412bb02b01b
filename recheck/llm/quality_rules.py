"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule is a lazy expression that says whether a text fails. On a sample of bounded size every rule is timed and its
rejections are counted; the cascade then asks the rules in order of rejections per second, and the first that fails
ends the row (``CASE WHEN`` evaluates no further branch). The order decides the time, never the verdict.

Per text: words are runs of characters other than ASCII white space; ``word_chars`` the code points in them;
``n_symbols`` the characters of ``#*$%&|<>``; ``n_dup_lines`` the lines (cut at line feeds) that have a word and equal
an earlier line; ``n_repeat_words`` the words inside windows of 8 words that the text has at least twice. Windows are
compared by 64-bit hashes inside one text, put together from the word hashes by doubling (1, 2, 4, 8 words), and found
equal by sorting: n log n in the length of a text, for whole texts.

Cases: a NULL text has no words and fails; an empty one too; a NULL doc_id is carried through; columns other than the
text are not read; an empty table gives an empty result, in the given order of rules.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recheck.llm.common import WORD, quoted

# Rows of the sample on which rules are timed; more rows are never used.
SAMPLE_ROWS = 2000
WINDOW = 8


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, and only where the whole is."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """The words, in order. Replacing and splitting by plain characters costs a third of a pattern."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.coalesce(F.array_remove(F.split(text, " ", -1), ""), F.array().cast("array<string>"))


def lines(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(WORD))


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[#*$%&|<>]")), F.lit(0)).cast("long")


def n_dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words(words: Column) -> Column:
    """Hashes of windows of 2, 4 and 8 words are made from those of half as many. A text whose windows of 4 words all
    differ, as most texts, has no window of 8 twice."""

    def joined(hashes: Column, half: int) -> Column:
        return let(hashes, lambda h: F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - half, F.lit(0))),
                                                 lambda x, i: F.xxhash64(x, F.get(h, i + half))))

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def found(s: Column) -> Column:  # positions whose hash stands beside them in the sorted array
            return F.array_sort(F.transform(F.filter(s, lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(
                False)) | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))), lambda x: x["p"]))

        return let(let(pairs, found), lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x))

    fours = joined(joined(F.transform(words, lambda x: F.xxhash64(x)), 1), 2)
    return let(fours, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
        let(joined(h, 4), covered))).cast("long")


class Facts:
    """What rules ask of a text: its words, its lines and the counts. ``known`` names those that are columns already;
    any other is an expression, evaluated only where a rule is asked."""

    def __init__(self, text: Column, words: Column, **known: Column):
        self.text, self.words, self.known = F.coalesce(text, F.lit("")), words, known

    def of(self, name: str, make: Callable[[], Column]) -> Column:
        return self.known[name] if name in self.known else make()

    n_words = property(lambda self: F.size(self.words))
    word_chars = property(lambda self: self.of("word_chars", lambda: word_chars(self.words)))
    n_symbols = property(lambda self: self.of("n_symbols", lambda: n_symbols(self.text)))
    n_repeat_words = property(lambda self: self.of("n_repeat_words", lambda: n_repeat_words(self.words)))

    def on_lines(self, use: Callable[[Column], Column]) -> Column:
        return use(self.known["lines"]) if "lines" in self.known else let(lines(self.text), use)


@dataclass(frozen=True)
class Rule:
    """``fails(facts)`` is true or false, never NULL, for any text."""
    name: str
    fails: Callable[[Facts], Column]


BASE = (
    Rule("few_words", lambda f: f.n_words < 20),
    Rule("repeated_windows", lambda f: f.n_repeat_words * 100 > f.n_words * 30),
)
# Well-known heuristics for web text, on the lenient side.
RULES = (
    Rule("mean_word", lambda f: ~f.word_chars.between(f.n_words * 2.5, f.n_words * 12.0)),
    Rule("symbols", lambda f: f.n_symbols * 10 > f.n_words),
    Rule("dup_lines", lambda f: f.on_lines(lambda x: n_dup_lines(x) * 2 > F.size(x))),
    # words without upper or lower case are asked for letters; the test before that is cheap
    Rule("few_letters", lambda f: F.size(F.filter(
        f.words, lambda x: (F.upper(x) == F.lower(x)) & ~x.rlike(r"\p{L}"))) * 10 > f.n_words * 2),
    Rule("shouting", lambda f: F.regexp_count(f.text, F.lit(r"\p{Lu}{2,}")) * 2 > f.n_words),
    Rule("bullets", lambda f: f.on_lines(lambda x: F.size(F.filter(
        x, lambda y: y.rlike(r"^[\x20\t]*[-*•●]"))) * 10 > F.size(x) * 9)),
    Rule("ellipses", lambda f: f.on_lines(lambda x: F.size(F.filter(
        x, lambda y: F.rtrim(y).endswith("...") | F.rtrim(y).endswith("…"))) * 10 > F.size(x) * 3)),
)


def measured(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text",
             rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, rejected share, seconds) on a sample of at most ``rows`` rows (chosen by chance with a fixed seed, about
    half as many), most rejections per second first. Seconds are those beyond splitting the sample into words."""
    n = docs.count()
    share = min(1.0, rows / 2 / max(1, n))
    one = docs.select(F.col(quoted(text)).alias("text"))
    sample = (one.sample(share, seed=5) if share < 1 else one).limit(rows).withColumn("words", words(F.col("text")))
    sample = sample.persist()
    try:
        size = sample.count()
        if not size:
            return [(r, 0.0, 0.0) for r in rules]

        def run(*cols: Column) -> tuple[float, list]:
            began = time.perf_counter()
            got = sample.agg(F.count(F.lit(1)), *cols).collect()[0]
            return time.perf_counter() - began, list(got)[1:]

        run()
        empty, _ = run()
        found = []
        for r in rules:
            s, got = run(F.sum(r.fails(Facts(F.col("text"), F.col("words"))).cast("int")))
            found.append((r, got[0] / size, max(s - empty, 1e-4)))
    finally:
        sample.unpersist()
    return sorted(found, key=lambda x: -x[1] / x[2])


def cascade(rules: list[Rule] | tuple[Rule, ...], facts: Facts) -> Column:
    """True where no rule fails; rules are asked in order, up to the first that does."""
    out = F.lit(True)
    for r in reversed(rules):
        out = F.when(r.fails(facts), F.lit(False)).otherwise(out)
    return out


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, n_words, the four counts, base_failed, kept."""
    order = [r for r, _, _ in measured(docs, rules, text)]
    t, w, x = F.col("text"), F.col("words"), F.col("lines")
    counted = (docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).alias("text"))
               .withColumns({"words": words(t), "lines": lines(t)})
               .select("doc_id", "text", "words", "lines", F.size(w).cast("long").alias("n_words"),
                       word_chars(w).alias("word_chars"), n_symbols(t).alias("n_symbols"),
                       n_dup_lines(x).alias("n_dup_lines"), n_repeat_words(w).alias("n_repeat_words")))
    facts = Facts(t, w, lines=x, **{c: F.col(c) for c in ("word_chars", "n_symbols", "n_repeat_words")})
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return (counted.withColumn("base_failed", failed)
            .withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(order, facts)))
            .drop("text", "words", "lines"))


def keep(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = BASE + RULES) -> DataFrame:
    """The rows of ``docs`` that pass every rule, with all their columns."""
    order = [r for r, _, _ in measured(docs, rules, text)]
    t = F.col(quoted(text))
    # not as a column of its own: a filter is pushed below it, with the words put in wherever a rule asks for them
    return docs.where(let(words(t), lambda w: cascade(order, Facts(t, w))))
