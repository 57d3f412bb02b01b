"""Quality rules and mixing against brute force; both run without Python workers."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from recheck.llm import mixing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for p in range(len(words) - 7):
        windows[tuple(words[p: p + 8])].append(p)
    inside = {q for ps in windows.values() if len(ps) > 1 for p in ps for q in range(p, p + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside))


def slow_kept(text):
    text = text or ""
    n, chars, symbols, dup, repeat = slow_counts(text)
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    if n < 20 or repeat * 100 > n * 30:
        return False
    return not (chars < n * 2.5 or chars > n * 12 or symbols * 10 > n or dup * 2 > len(lines)
                or sum(not any(c.isalpha() for c in w) for w in words) * 10 > n * 2
                or sum(len(x) >= 2 for x in re.findall("[" + "".join(filter(str.isupper, map(chr, range(0x180)))) + "]+", text))
                * 2 > n
                or sum(bool(re.match(r"[ \t]*[-*•●]", x)) for x in lines) * 10 > len(lines) * 9
                or sum(x.rstrip(" ").endswith(("...", "…")) for x in lines) * 10 > len(lines) * 3)


ODD = ["A B " * 30, "WORD SHOUTED ÉÉ! " * 25 + "quiet", "line one two\n" * 30, "- item of a list\n" * 3 + "• more of it\n" * 22,
       "some words here ...\n" * 2 + "other text follows …\nand ends ... \n" * 9, "a1 22 33 44 " * 20,
       "x#y *z* $ % & | <b> " * 12, "one two three four five six seven eight nine ten " * 2 + "a b c d e f",
       "one two three four five six seven eight " * 2 + "\n" + " ".join(f"word{i}" for i in range(60)),
       "averyveryverylongword " * 30]


def test_counts_and_verdicts(docs_frame, weird_rows, empty):
    rows = weird_rows + [(200 + k, t, "en", "s") for k, t in enumerate(ODD)]
    out = quality_rules.scored(docs_frame(rows))
    got = Counter(tuple(r) for r in out.collect())
    want = Counter()
    for i, t, *_ in rows:
        c = slow_counts(t)
        want[(i, *c, c[0] < 20 or c[4] * 100 > 30 * c[0], slow_kept(t))] += 1
    assert got == want
    assert len({k[-1] for k in want}) == 2
    assert quality_rules.scored(empty).count() == 0


def test_keep_is_the_verdict(docs_frame, weird_rows, empty):
    rows = weird_rows + [(200 + k, t, "en", "s") for k, t in enumerate(ODD)]
    docs = docs_frame(rows)
    out = quality_rules.keep(docs)
    assert out.columns == docs.columns
    assert Counter(r.text for r in out.collect()) == Counter(t for _, t, *_ in rows if slow_kept(t))
    assert quality_rules.keep(empty).count() == 0


def test_order_is_by_rejections_per_second_and_changes_nothing(docs_frame, weird_rows):
    docs = docs_frame(weird_rows + [(200 + k, t, "en", "s") for k, t in enumerate(ODD)])
    found = quality_rules.measured(docs, quality_rules.RULES)
    gain = [share / s for _, share, s in found]
    assert gain == sorted(gain, reverse=True) and {r.name for r, _, _ in found} == {r.name for r in quality_rules.RULES}
    t, w = F.col("text"), quality_rules.words(F.col("text"))
    facts = quality_rules.Facts(t, w)
    both = [quality_rules.cascade(list(order), facts) for order in (quality_rules.RULES, quality_rules.RULES[::-1])]
    assert docs.where(both[0] != both[1]).count() == 0
    assert docs.where(both[0].isNull()).count() == 0


@pytest.mark.parametrize("make", [lambda d: quality_rules.scored(d), lambda d: quality_rules.keep(d),
                                  lambda d: mixing.plan(d), lambda d: mixing.mix(d)])
def test_plans_hold_no_python(weird, make):
    plan = make(weird)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def slow_targets(sizes):
    """Water filling, source by source."""
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    total, open_, out = sum(sizes.values()), dict(sizes), {}
    while open_:
        unit = (total - sum(out.values())) / sum(weights[s] for s in open_)
        full = [s for s in open_ if 3 * sizes[s] <= unit * weights[s]]
        if not full:
            return out | {s: unit * weights[s] for s in open_}
        for s in full:
            out[s] = 3.0 * sizes[s]
            del open_[s]
    return out


def size_of(t):
    return len(WORD.findall(t or ""))


def test_mixing_plan(weird, weird_rows, empty):
    got = mixing.plan(weird).collect()
    assert Counter((r.doc_id, r.src, r["size"]) for r in got) == Counter((i, s, size_of(t)) for i, t, _, s in weird_rows)
    sizes = Counter()
    for _, t, _, s in weird_rows:
        sizes[s] += size_of(t)
    goal = slow_targets(dict(sizes))
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.target == pytest.approx(goal[r.src]) and r.source_size == sizes[r.src] and 0 <= r.copies <= 3
        taken[r.src] += r["size"] * r.copies
        largest[r.src] = max(largest[r.src], r["size"])
    assert all(abs(taken[s] - goal[s]) <= 3 * largest[s] for s in sizes)
    again = Counter(tuple(r) for r in mixing.plan(weird.repartition(13)).collect())
    assert again == Counter(tuple(r) for r in got)
    assert mixing.plan(empty).count() == 0


def test_mixing_comes_near_its_targets(docs_frame):
    import random
    rnd = random.Random(4)
    rows = [(i, "w " * int(rnd.lognormvariate(4, 1.2)), "en", "abcde"[min(4, int(rnd.expovariate(0.8)))]) for i in range(2000)]
    got = mixing.plan(docs_frame(rows)).groupBy("src").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 0.02 * r.target for r in got)


def test_copies_are_crossings_of_one_running_sum(docs_frame):
    """Plain Python over exact fractions: one sum a source, the largest documents first, one offset; from the small
    documents on another expectation, but the sum goes on."""
    import hashlib
    import random
    from fractions import Fraction
    rnd = random.Random(11)
    rows = [(i, "w " * int(rnd.lognormvariate(4, 1.3)), "en", "abcde"[min(4, int(rnd.expovariate(0.8)))]) for i in range(1500)]
    got = {r.doc_id: (r.src, r.copies, r.target) for r in mixing.plan(docs_frame(rows)).collect()}
    by_source = {}
    for i, t, _, s in rows:
        by_source.setdefault(s, []).append((-size_of(t), i))
    for s, own in by_source.items():
        own.sort()
        words = -sum(n for n, _ in own)
        target = got[own[0][1]][2]
        digits = [(-n).bit_length() for n, _ in own]
        small = next(p for p in range(40) if sum(-n for (n, _), d in zip(own, digits) if d <= p) >= mixing.SMALL_SHARE * words)
        low = sum(-n for (n, _), d in zip(own, digits) if d <= small)
        offset = Fraction(2 * int(hashlib.md5(f"{mixing.SEED}+{s}".encode()).hexdigest()[:4], 16) + 1, 2 * 65536)
        at, taken, rate = offset, 0, None
        for (n, i), d in zip(own, digits):
            if d <= small and rate is None:
                rate = min(Fraction(3), max(Fraction(0), Fraction(target - taken) / low))
            before, at = at, at + (Fraction(target) / words if rate is None else rate)
            assert got[i][1] == at // 1 - before // 1, (s, i)
            taken += -n * got[i][1]
        assert abs(taken - target) <= 3 * max(-n for (n, _), d in zip(own, digits) if d <= small)


def test_mix_repeats_rows(weird, weird_rows, empty):
    out = mixing.mix(weird)
    assert out.columns == weird.columns
    want = Counter()
    for r in mixing.plan(weird).collect():
        want[(r.doc_id, r.src, r["size"])] += r.copies
    got = Counter((r.doc_id, r.source, size_of(r.text)) for r in out.collect())
    assert got == Counter({k: n for k, n in want.items() if n})
    assert mixing.mix(empty).count() == 0
