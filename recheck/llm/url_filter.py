"""URL filters: a list of host and path rules first, for the rest a logistic regression on hashed character n-grams.

Host and path are cut out of the URL as text. A rule names a host, with all its subdomains, and the beginning of a
path; of the rules that fit a URL the longest decides. URLs that no rule fits are judged by a logistic regression on
hashed 2- to 5-grams of the host and of the path (separate columns), fitted on the driver to a small labelled URL
table, of which ``TRAIN_ROWS`` rows are read at most.

Cases: a NULL URL or one without ``://`` has an empty host and path and no rule; its score is one half:
allow. Ports and user names count as part of the host. Columns other than id and URL are ignored; equal rows
give equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recheck.llm import ngrams
from recheck.llm.common import ascii_lower, quoted

# (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
DIMS = 1 << 12
ORDERS = (2, 3, 4, 5)
TRAIN_ROWS = 20_000

# The small labelled table: names that say what a site is for (1: block), set beside ordinary names of the same shape.
BLOCKED_NAMES = """adult-chat adult-video sex-cams xxx-tube hot-girls escort-service porn-hub casino-royal online-casino
best-casino poker-win slots-bonus sports-betting bet-now lottery-winner diet-pills cheap-viagra pills-online
discount-meds pharmacy-deals buy-cialis spam-page spam-links link-farm seo-links cheap-backlinks free-prizes free-money
free-iphone win-cash payday-loans quick-loans fast-cash bitcoin-doubler crypto-giveaway ads-pixel ad-server ads-click
click-track tracker-ads pop-ads banner-ads adclick doubleclick torrent-free warez-crack keygen-crack malware-drop
phish-login fake-login replica-watches cheap-replica miracle-diet weight-loss-pills""".split()
ALLOWED_NAMES = """news daily-news weather science physics biology library archive museum history garden recipes kitchen
travel city-guide mountain river school college university research journal review books reading writers poetry music
orchestra theatre cinema photo gallery design studio software python linux developer docs manual forum community
support help contact about health clinic hospital family children sports football cycling running market orchard shop
bakery coffee tea hotel airport railway energy water engineering tools workshop north-river green-hill blue-lake
old-town""".split()
PATHS = ("/", "/en/12", "/de/345.html", "/fr/78/", "/es/901?page=2", "/index.html", "/2024/05/story", "/blog/post-7")
ENDINGS = ("example.com", "example.net", "example.org")


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 to block): each name with two endings, prefixes and paths in turn, so that only names tell them apart."""
    out = []
    for names, label in ((BLOCKED_NAMES, 1), (ALLOWED_NAMES, 0)):
        for i, n in enumerate(names):
            for j in range(2):
                prefix = ("", "www.", "blog.", "m.")[(i + j) % 4]
                out.append((f"https://{prefix}{n}.{ENDINGS[(i + j) % 3]}{PATHS[(i * 2 + j) % len(PATHS)]}", label))
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return (F.coalesce(ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit("")),
            F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")))


def decide(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else NULLs."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def features(hosts: list[str], paths: list[str]) -> np.ndarray:
    """Host and path n-grams, each half of length 1 if it has any."""
    marked = [["^" + x if x else "" for x in xs] for xs in (hosts, paths)]
    halves = [ngrams.counts(xs, ORDERS, DIMS, seed=k) for k, xs in enumerate(marked)]
    for half, xs in zip(halves, marked):
        half[[not x for x in xs]] = 0
    return np.hstack([ngrams.normalised(h) for h in halves])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 300) -> np.ndarray:
    """Weights of a logistic regression, by Nesterov's gradient steps; the classes weigh the same. There is no bias: a
    URL that has no n-grams gets one half. Labels of one class only: weights towards it; none: weights 0."""
    x, y = x.astype(np.float32), y.astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    if not len(y):
        return w
    each = {v: 0.5 / max(1, int((y == v).sum())) for v in (0.0, 1.0)}
    weight = np.array([each[v] for v in y.tolist()], np.float32)
    step = np.float32(1 / (0.25 * (x ** 2).sum(1).max() + ridge))
    w0 = w
    for k in range(steps):
        at = w + np.float32(k / (k + 3)) * (w - w0)
        g = weight * (1 / (1 + np.exp(-(x @ at))) - y)
        w0, w = w, at - step * (x.T @ g + np.float32(ridge) * at)
    return w


def judge(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and block_score (the regression's; NULL where a rule decided).
    ``labelled`` (url string, label int) replaces the small table above."""
    spark = pages.sparkSession
    if labelled is None:
        labelled = spark.createDataFrame(labelled_urls(), "url string, label int")
    h, p = host_and_path(F.col("url"))
    train = (labelled.where(F.col("label").isNotNull()).select(h.alias("h"), p.alias("p"), "label")
             .orderBy(F.xxhash64("h", "p"), "h", "p", "label").limit(TRAIN_ROWS).toPandas())
    w = fit(features(list(train.h), list(train.p)), train.label.to_numpy(float))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            out = [1 / (1 + np.exp(-(features(list(hosts[k: k + 512]), list(paths[k: k + 512])) @ w)))
                   for k in range(0, len(hosts), 512)]
            yield pd.Series(np.concatenate(out) if out else np.zeros(0)).astype(float)

    host, path = host_and_path(F.col(quoted(url)))
    cut = pages.withColumns({"host": host, "path": path})
    rule, verdict = decide(F.col("host"), F.col("path"), rules)
    ruled = cut.withColumns({"rule": rule, "verdict": verdict})
    # one branch a kind: only URLs that no rule fits reach Python
    judged = ruled.where(F.col("rule").isNull()).withColumn("block_score", score("host", "path")).withColumn(
        "verdict", F.when(F.col("block_score") > 0.5, F.lit("block")).otherwise(F.lit("allow")))
    return ruled.where(F.col("rule").isNotNull()).withColumn("block_score", F.lit(None).cast("double")).unionByName(
        judged)
