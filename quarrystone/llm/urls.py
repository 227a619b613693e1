"""URL filter by the ratio of two character language models."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrystone.llm.common import Boxed, col_of, need
from quarrystone.session import materialize, table

#: Rules, fixed values of the contract: (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Longest context of the models, in characters.
ORDER = 5
#: Of the labelled URLs one in HELD_OUT calibrates the threshold instead of being counted.
HELD_OUT = 5
#: Only where a caller asks for a sample: none of over so many characters.
LONGEST_SAMPLE = 2_000
#: Characters that the uniform distribution below the empty context is over.
ALPHABET = 256
#: Strings whose steps a task holds: those with over 1 / HEAD of all places, so fewer than HEAD whatever the data.
HEAD = 1 << 16
#: Different strings that a task counts or posts before it hands them on.
HELD = 200_000
#: Steps are added as whole numbers of this part of a nat, so that sums are the same in whatever order.
SCALE = 1 << 34
#: Cells of scores a nat, whose numbers come to the driver; within a cell scores are ordered by a window.
CELLS = 256
START = "\x02"


class MarkovModel:
    """The model of a list, said plainly; ``step_table`` is the same over tables of any size.

    Variable-order character model: counts of every context up to ``order``, smoothed by Witten-Bell interpolation.

    p(c | context) = (count + kinds * p(c | context without its first character)) / (total + kinds), where ``kinds`` is the
    number of different characters seen after the context; contexts never seen are passed over, and the empty context
    falls back on a uniform distribution over ``alphabet`` characters.
    """

    def __init__(self, urls: list[str], order: int = ORDER, alphabet: int = ALPHABET):
        self.order, self.alphabet = order, alphabet
        counts: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        for url in urls:
            text = START * order + url
            for i in range(order, len(text)):
                for k in range(order + 1):
                    counts[text[i - k : i]][text[i]] += 1
        self.counts = {c: dict(n) for c, n in counts.items()}
        self.totals = {c: (sum(n.values()), len(n)) for c, n in self.counts.items()}

    def log_p(self, context: str, char: str) -> float:
        p = 1.0 / self.alphabet
        for k in range(len(context) + 1):
            short = context[len(context) - k :]
            if short not in self.totals:
                break
            total, kinds = self.totals[short]
            p = (self.counts[short].get(char, 0) + kinds * p) / (total + kinds)
        return math.log(p)


class UrlRatio:
    """Length-normalised difference of log-likelihoods, accepted less rejected, and its threshold, of two lists."""

    def __init__(self, accepted: list[str], rejected: list[str], order: int = ORDER, held_out: int = HELD_OUT):
        part = lambda urls, held: [u for i, u in enumerate(urls) if (i % held_out == 0) == held]
        self.order, self.threshold = order, 0.0
        self.yes, self.no = MarkovModel(part(accepted, False), order), MarkovModel(part(rejected, False), order)
        good, bad = ([self.score(u) for u in part(urls, True)] for urls in (accepted, rejected))
        self.threshold = self._calibrated(good, bad)

    @staticmethod
    def _calibrated(good: list[float], bad: list[float]) -> float:
        """Midpoint between neighbouring held-out scores with the best balanced accuracy; 0 without both kinds."""
        if not good or not bad:
            return 0.0
        scores = sorted({*good, *bad})
        best, at = -1.0, 0.0
        for x, y in zip(scores, [*scores[1:], scores[-1] + 1.0], strict=True):
            cut = (x + y) / 2
            won = sum(s >= cut for s in good) / len(good) + sum(s < cut for s in bad) / len(bad)
            if won > best:
                best, at = won, cut
        cut = (scores[0] - 1.0 + scores[0]) / 2
        return cut if 1.0 > best else at

    def score(self, url: str) -> float:
        step = self.__dict__.get("_step")
        if step is None:
            step = self._step = lru_cache(1 << 18)(lambda context, c: self.yes.log_p(context, c) - self.no.log_p(context, c))
        if not url:
            return 0.0
        text = START * self.order + url
        return sum(step(text[i - self.order : i], text[i]) for i in range(self.order, len(text))) / len(url)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_step"}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; path then up to '?', '#' or the end."""
    body = F.coalesce(url, F.lit(""))
    has = F.instr(body, "://") > 0
    first = F.when(has, F.regexp_extract(body, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(first, r"(?s)^([^/?#]*)", 1), upper, lower)
    path = F.regexp_extract(first, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _places(url: str) -> Counter:
    """The strings of a character and the ``ORDER`` before it, and how often each is there."""
    text = START * ORDER + url
    return Counter([text[i : i + ORDER + 1] for i in range(len(url))])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of each string in a task's URLs: counted as accepted, as rejected, or asked for (kinds 0, 1, 2)."""
    held: list[Counter] = [Counter(), Counter(), Counter()]

    def out() -> pa.RecordBatch:
        grams = list(set().union(*held))
        return pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), *[pa.array([h[g] for g in grams], pa.int64()) for h in held]], ["gram", "yes", "no", "n"])

    for batch in batches:
        for url, kind in zip(*(batch.column(c).to_pylist() for c in ("_u", "kind")), strict=True):
            held[kind].update(_places(url))
            if sum(map(len, held)) >= HELD:
                yield out()
                held = [Counter(), Counter(), Counter()]
    yield out()


def _posted(often):
    """(_row, gram, k) of the strings that tasks do not hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows, grams, times = often.value, [], [], []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(grams, pa.string()), pa.array(times, pa.int64())], ["_row", "gram", "k"])

        for batch in batches:
            for row, url in zip(*(batch.column(c).to_pylist() for c in ("_row", "_u")), strict=True):
                for gram, k in _places(url).items():
                    if gram not in known:
                        rows.append(row)
                        grams.append(gram)
                        times.append(k)
                        if len(rows) >= HELD:
                            yield out()
                            rows, grams, times = [], [], []
        yield out()

    return run


def step_table(grams: DataFrame, order: int = ORDER, alphabet: int = ALPHABET) -> DataFrame:
    """(gram, step, n) of the strings asked for, n > 0, from (gram, yes, no, n), one row for each string of order + 1 characters.

    ``step`` is log p(last character | those before) of the accepted less that of the rejected, in 1 / SCALE nats. Each level
    has the counts of a shorter context, by the ends of the strings; a window over a context adds up what follows it.
    """
    known = None
    for k in range(order + 1):
        level = grams.groupBy(F.substring("gram", -(k + 1), k + 1).alias("gram")).agg(*[F.sum(c).alias(c) for c in ("yes", "no", "n")])
        sums = {f"{t}_{c}": x for c in ("yes", "no") for t, x in (("total", F.sum(c)), ("kinds", F.count_if(F.col(c) > 0)))}
        if known is None:
            level = level.crossJoin(F.broadcast(level.agg(*[x.alias(c) for c, x in sums.items()]))).where("n > 0")
            before = [F.lit(1.0 / alphabet)] * 2
        else:
            after = Window.partitionBy(F.substring("gram", 1, k))
            level = level.select("*", *[x.over(after).alias(c) for c, x in sums.items()])
            level = level.where("n > 0").withColumn("shorter", F.substring("gram", -k, k)).join(known, "shorter")
            before = [F.col("p_yes"), F.col("p_no")]
        # Where a context was never seen the shorter one decides.
        p = [F.when(F.col(f"total_{c}") > 0, (F.col(c) + F.col(f"kinds_{c}") * q) / (F.col(f"total_{c}") + F.col(f"kinds_{c}"))).otherwise(q) for c, q in zip(("yes", "no"), before, strict=True)]
        level = level.select("gram", "n", p[0].alias("q_yes"), p[1].alias("q_no"))
        known = level.select(F.col("gram").alias("shorter"), F.col("q_yes").alias("p_yes"), F.col("q_no").alias("p_no"))
    return level.select("gram", F.round((F.log("q_yes") - F.log("q_no")) * SCALE).cast("long").alias("step"), "n")


def score_urls(rows: DataFrame, steps: DataFrame, often) -> DataFrame:
    """``rows`` (written; ``_row``, ``_u``) with their ``log_ratio``: the mean of the steps of a URL's characters, 0 without any.

    Tasks hold the steps of ``often``; a URL's other strings are joined to ``steps``.
    """

    @F.pandas_udf("long")
    def held(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = often.value
        for found in batches:
            yield pd.Series([sum(known.get(g, 0) * k for g, k in _places(u).items()) for u in found], dtype="int64")

    rest = rows.select("_row", "_u").mapInArrow(_posted(often), "_row long, gram string, k long")
    rest = rest.join(steps, "gram").groupBy("_row").agg(F.sum(F.col("k") * F.col("step")).alias("_rest"))
    both = rows.withColumn("_held", held("_u")).join(rest, "_row", "left")
    size = F.length("_u")
    ratio = (F.col("_held") + F.coalesce("_rest", F.lit(0))) / F.lit(float(SCALE)) / F.greatest(size, F.lit(1))
    return both.withColumn("log_ratio", ratio).drop("_held", "_rest")


def calibrated(scores: DataFrame) -> float:
    """Midpoint between neighbouring held-out scores with the best balanced accuracy, the lowest such; 0 without both kinds.

    ``scores``: written; ``log_ratio``, ``_v``. Numbers by cell come to the driver (so many cells a nat); within its cell, a
    window over the different scores goes on from what lies in lower cells.
    """
    cell = F.floor(F.col("log_ratio") * CELLS).alias("cell")
    counts = scores.groupBy(cell, "log_ratio").agg(F.count_if(F.col("_v") == "allow").alias("good"), F.count_if(F.col("_v") == "block").alias("bad"))
    cells = sorted(counts.groupBy("cell").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect())
    all_good, all_bad = sum(x.good for x in cells), sum(x.bad for x in cells)
    if not all_good or not all_bad:
        return 0.0
    lower, good, bad = [], 0, 0
    for x in cells:
        lower.append((x.cell, good, bad))
        good, bad = good + x.good, bad + x.bad
    offsets = scores.sparkSession.createDataFrame(lower, "cell long, lower_good long, lower_bad long")
    upto = Window.partitionBy("cell").orderBy("log_ratio").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = counts.join(F.broadcast(offsets), "cell").select("log_ratio", (F.col("lower_good") + F.sum("good").over(upto)).alias("good"), (F.col("lower_bad") + F.sum("bad").over(upto)).alias("bad"))
    # Of the cut just above each score.
    won = (F.lit(all_good) - F.col("good")) / F.lit(all_good) + F.col("bad") / F.lit(all_bad)
    best = below.select(won.alias("won"), "log_ratio").agg(F.max("won").alias("won"), F.max_by("log_ratio", F.struct("won", -F.col("log_ratio"))).alias("at"), F.min("log_ratio").alias("least")).first()
    if best.won < 1.0:
        return best.least - 0.5
    above = scores.where(F.col("log_ratio") > best.at).agg(F.min("log_ratio")).first()[0]
    return (best.at + (best.at + 1.0 if above is None else above)) / 2


def labelled_urls(labelled: DataFrame, sample: int | None = None, longest: int = LONGEST_SAMPLE) -> DataFrame:
    """(_row, _u, _v, held), written: all different labelled URLs (``_u``, ``_v``) but empty ones, and whether each is held out
    (one in ``HELD_OUT``, by hash). With ``sample``, of each verdict only so many of smallest hash, none longer than ``longest``.
    """
    rows = labelled.where(F.length("_u") > 0).select("_u", "_v").distinct()
    if sample is None:
        rows = rows.withColumn("held", F.pmod(F.xxhash64("_u"), F.lit(HELD_OUT)) == 0)
    else:
        taken = []
        for verdict in ("allow", "block"):
            of = rows.where((F.col("_v") == verdict) & (F.length("_u") <= longest)).orderBy(F.xxhash64("_u"), "_u").limit(sample).collect()
            taken += [(r[0], verdict, i % HELD_OUT == 0) for i, r in enumerate(of)]
        rows = labelled.sparkSession.createDataFrame(taken, "_u string, _v string, held boolean")
    return materialize(rows.withColumn("_row", F.monotonically_increasing_id()))


def filter_urls(pages: DataFrame, url_col: str = "url", rules: list[tuple[str, str, str]] = RULES, sample: int | None = None, keep: list[str] | None = None, head: int = HEAD) -> DataFrame:
    """Judge every URL by the longest fitting rule, else by a likelihood ratio.

    Added to ``keep`` (all columns by default; those named like a new one, in any case, are replaced): host, path, rule, verdict
    ('allow' or 'block'), ``log_ratio`` (null where a rule decided). Two character models are counted over all different URLs
    with a rule, accepted and rejected, of whatever length, but one in ``HELD_OUT``; all of these calibrate the threshold.
    (With ``sample`` the caller asks for so many of each verdict instead.) Counts and the steps of the models are tables: the
    strings with over 1 / ``head`` of all places, fewer than ``head``, go to tasks by broadcast, a URL's others are joined to
    the written steps. Null and empty URLs, and those without '://', have empty host and path and fit no rule; a null URL
    scores 0 as an empty one does. With no labelled URL of either kind every score is compared with 0. Repeated rows share one
    verdict and count once in the models; an empty table gives an empty result.
    """
    need(pages, url_col)
    boxed = Boxed(pages, keep, ["host", "path", "rule", "verdict", "log_ratio"])
    host, path = host_and_path(col_of(url_col))
    parts = pages.select(boxed.box, F.coalesce(col_of(url_col), F.lit("")).alias("_u"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = materialize(parts.withColumns({"rule": rule, "_v": verdict}).withColumn("_row", F.monotonically_increasing_id()))

    labelled, asked = labelled_urls(rows.where("rule is not null"), sample), rows.where("rule is null")
    kind = F.when(F.col("held"), 2).when(F.col("_v") == "allow", 0).otherwise(1).alias("kind")
    counted = labelled.select("_u", kind).unionByName(asked.select("_u", F.lit(2).alias("kind"))).mapInArrow(_counted, "gram string, yes long, no long, n long")
    grams = materialize(counted.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("yes", "no", "n")]))
    steps = materialize(step_table(grams))
    total = steps.agg(F.sum("n")).first()[0] or 0
    known = {r.gram: r.step for r in steps.where(F.col("n") * head > total).collect()}  # fewer than ``head``
    often = pages.sparkSession.sparkContext.broadcast(known)
    threshold = calibrated(materialize(score_urls(labelled.where("held").select("_row", "_u", "_v"), steps, often).select("_v", "log_ratio")))

    judged = F.when(F.col("log_ratio") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    columns = lambda df: df.select(*boxed.columns(), "host", "path", "rule", F.coalesce("_v", judged).alias("verdict"), "log_ratio")
    ruled = rows.where("rule is not null").withColumn("log_ratio", F.lit(None).cast("double"))
    return columns(ruled).unionByName(columns(score_urls(asked, steps, often)))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), keep=["page_id"])
