"""Quality rules with thresholds adapted to each language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrystone.llm.common import Boxed, blank_words, bucket, col_of, let, need, stratum
from quarrystone.session import broadcast_if_small, materialize, table

#: Base rules, fixed values of the contract.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Metric: (whole-number expression over the counts, two percentiles, multiple of their distance, least distance, sides that
#: are fenced). A fence lies so many distances beyond the outer percentile; without a distance there is none. The least
#: distances are below those of prose (4 and more), and serve groups that hardly use such characters.
METRICS = {
    "other_pm": ("(1000 * n_other) div word_chars", 25, 75, 8, 3, "max"),
    "upper_pm": ("(1000 * n_upper) div word_chars", 25, 75, 12, 3, "max"),
    "word_len": ("(100 * word_chars) div n_words", 25, 75, 6, 0, "min max"),
    "dup_line_pm": ("(1000 * n_dup_lines) div n_lines", 50, 99, 2, 0, "max"),
    "repeat_pm": ("(1000 * n_repeat_words) div n_words", 50, 99, 2, 0, "max"),
}
FENCES = [f"{m}_{side}" for m, (*_, sides) in METRICS.items() for side in sides.split()]
#: Percentiles of a group, and their distance, are averaged with those of its language, which count as so many rows.
PRIOR = 100
#: Leading bits of a number that its sketch bucket keeps.
BITS = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_other", "n_upper"]
#: Printable ASCII that is neither letter nor digit nor blank.
OTHER = r"!-/:-@\[-`{-~"


def _repeated(words: Column) -> Column:
    """Words that lie in three-word windows found twice or more: windows sorted by hash, equal neighbours, lengths joined."""

    def covered(windows: Column) -> Column:
        same = lambda x, i, step: F.coalesce(F.get(windows, i + step)["h"] == x["h"], F.lit(False))
        twice = F.filter(windows, lambda x, i: same(x, i, -1) | same(x, i, 1))
        starts = F.sort_array(F.transform(twice, lambda x: x["p"]))
        joined = lambda acc, p: F.struct((p + 3).alias("end"), (acc["total"] + F.least(F.lit(3), p + 3 - acc["end"])).alias("total"))
        return F.aggregate(starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")), joined, lambda acc: acc["total"])

    window = lambda p: F.struct(F.xxhash64(F.get(words, p - 1), F.get(words, p), F.get(words, p + 1)).alias("h"), p.alias("p"))
    windows = F.sort_array(F.transform(F.sequence(F.lit(1), F.size(words) - 2), window))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(windows, covered))


def text_counts(text: Column) -> Column:
    """Struct of ``COUNTS`` (all long) for a text; null counts as empty."""
    body = F.coalesce(text, F.lit(""))
    only = lambda kept: F.length(F.regexp_replace(body, f"[^{kept}]+", "")).cast("long")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            only("#*$%&|<>").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeated(words).cast("long").alias("n_repeat_words"),
            let(lines, F.size).cast("long").alias("n_lines"),
            only(OTHER).alias("n_other"),
            only("A-Z").alias("n_upper"),
        )

    return let(blank_words(body), of)


def quality_sketches(scored: DataFrame) -> DataFrame:
    """(_l, _s, metric, bucket, n): log-linear histograms, mergeable by adding ``n``; some hundred buckets a group at most.

    Rows that fail the base rules have null metrics here, which the sketch passes over.
    """
    stack = ", ".join(f"'{m}', CASE WHEN NOT base_failed THEN {m} END" for m in METRICS)
    long = scored.selectExpr("_l", "_s", f"stack({len(METRICS)}, {stack}) as (metric, v)").where("v is not null")
    return long.selectExpr("_l", "_s", "metric", f"{bucket('v', BITS)} as bucket").groupBy("_l", "_s", "metric", "bucket").agg(F.count("*").alias("n"))


def _percentiles(sketches: DataFrame, keys: list[str], tag: str) -> DataFrame:
    """(keys, metric, <tag>rows, <tag>lo, <tag>hi): both percentiles of each metric."""
    merged = sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")  # buckets of a group, whatever its rows
    upto = merged.withColumns({"upto": F.sum("n").over(group.orderBy("bucket")), "rows": F.sum("n").over(group)})
    for i, side in ((1, "lo"), (2, "hi")):
        of = F.create_map(*[F.lit(x) for m, spec in METRICS.items() for x in (m, spec[i])])
        upto = upto.withColumn(side, F.when(F.col("upto") * 100 >= F.col("rows") * of[F.col("metric")], F.col("bucket")))
    return upto.groupBy(*keys, "metric").agg(F.max("rows").alias(f"{tag}rows"), F.min("lo").alias(f"{tag}lo"), F.min("hi").alias(f"{tag}hi"))


def quality_thresholds(sketches: DataFrame, prior: int = PRIOR) -> DataFrame:
    """(_l, _s, one column per fence): from the group's percentiles and their distance, averaged with the language's percentiles
    and its groups' mean distance; null without a distance."""
    own = _percentiles(sketches, ["_l", "_s"], "o_")
    lang = _percentiles(sketches, ["_l"], "l_").join(own.groupBy("_l", "metric").agg(F.expr("sum(o_rows * (o_hi - o_lo)) div sum(o_rows) as l_wide")), ["_l", "metric"])
    mean = lambda a, b: f"(o_rows * {a} + {prior} * {b}) div (o_rows + {prior})"
    joined = own.join(lang, ["_l", "metric"]).selectExpr("_l", "_s", "metric", f"{mean('o_lo', 'l_lo')} as lo", f"{mean('o_hi', 'l_hi')} as hi", f"{mean('(o_hi - o_lo)', 'l_wide')} as wide")
    found = []
    for m, (_, _, _, times, least, sides) in METRICS.items():
        wide = f"greatest(wide, {least})"
        for side in sides.split():
            at = f"hi + {times} * {wide}" if side == "max" else f"lo - {times} * {wide}"
            found.append(F.max(F.expr(f"CASE WHEN metric = '{m}' AND {wide} > 0 THEN {at} END")).alias(f"{m}_{side}"))
    return joined.groupBy("_l", "_s").agg(*found)


def _scored(docs: DataFrame, kept: list[Column], names: list[str], text: Column, lang: Column, source: Column) -> DataFrame:
    """``kept`` (of these names) with group keys, counts, ``base_failed`` and metrics."""
    made = docs.select(*kept, stratum(lang).alias("_l"), stratum(source).alias("_s"), text_counts(text).alias("_c"))
    scored = made.select(*names, "_l", "_s", *[f"_c.{c}" for c in COUNTS])
    scored = scored.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))
    return scored.withColumns({m: F.when(F.col("word_chars") > 0, F.expr(e)).otherwise(F.lit(0).cast("long")) for m, (e, *_) in METRICS.items()})


def _verdict(scored: DataFrame, fences: DataFrame) -> DataFrame:
    inside = F.lit(True)
    for f in FENCES:
        m, side = f.rsplit("_", 1)
        inside = inside & F.coalesce(F.col(m) <= F.col(f) if side == "max" else F.col(m) >= F.col(f), F.lit(True))
    # One CASE, which no filter takes apart: a part of it below the join would count the texts again.
    return scored.join(fences, ["_l", "_s"], "left").withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(inside)).drop("_l", "_s")


def quality_scores(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", keep: list[str] | None = None, prior: int = PRIOR) -> DataFrame:
    """Judge every row: base rules, then fences from quantile sketches of its language and source.

    Added to ``keep`` (all columns by default; those named like a new one, in any case, are replaced): the counts of
    ``text_counts``, ``base_failed``, whole-number metrics (thousandths; ``word_len`` in hundredths of a character), their
    fences ``<metric>_max`` and ``word_len_min``, and ``kept``: false if the base rules fail or a metric lies beyond a fence.

    Every fence follows from two percentiles of the metric: it lies a multiple of their distance beyond the outer one. They
    are taken from the sketch of the row's language and source and averaged with those of the language, which count as
    ``prior`` rows; so small groups lean on their language and large ones on themselves. A metric without any distance in a
    group tells nothing there and sets no fence (null).

    The counts are made once and written; sketches are partial counts per bucket, so a hot source needs no more of a task
    than any other; fences are a row per language and source, joined back. Null text counts as empty (base fails), null
    language or source is a group of its own, repeated rows share their fate, an empty table gives an empty result.
    """
    need(docs, text_col, lang_col, source_col)
    boxed = Boxed(docs, keep, [*COUNTS, *METRICS, *FENCES, "base_failed", "kept"])
    scored = materialize(_scored(docs, [boxed.box], ["_doc"], col_of(text_col), col_of(lang_col), col_of(source_col)))
    judged = _verdict(scored, materialize(quality_thresholds(quality_sketches(scored), prior)))
    return judged.select(*boxed.columns(), *[c for c in judged.columns if c != "_doc"])


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", prior: int = PRIOR) -> DataFrame:
    """The rows that ``quality_scores`` keeps, with the columns of ``docs`` alone.

    Texts are read and counted twice, for the sketches and for the verdicts, rather than written: fences of up to a million
    groups are broadcast, so that no text moves."""
    need(docs, text_col, lang_col, source_col)
    boxed = Boxed(docs, None, [])
    of = (col_of(text_col), col_of(lang_col), col_of(source_col))
    fences = materialize(quality_thresholds(quality_sketches(_scored(docs, [], [], *of)), prior))
    return _verdict(_scored(docs, [boxed.box], ["_doc"], *of), broadcast_if_small(fences)).where("kept").select(*boxed.columns())


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_scores(table(spark, sf_dir, "documents"), keep=["doc_id", "lang", "source"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *METRICS, *FENCES)


def quality_sql(docs: str, prior: int = PRIOR) -> str:
    """CTEs that end in ``judged``: the columns of ``docs`` with counts, metrics, fences and ``kept``."""
    metrics = {m: e.replace(" div ", " // ") for m, (e, *_) in METRICS.items()}
    of = lambda i: f"CASE metric {' '.join(f'WHEN {m!r} THEN {spec[i]}' for m, spec in METRICS.items())} END"

    def level(name: str, keys: str, tag: str) -> str:
        group = f"{keys}metric"
        return f"""
    qf_{name}_u AS (SELECT {group}, bucket, sum(n) OVER (PARTITION BY {group} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {group}) AS r
      FROM (SELECT {group}, bucket, sum(n) AS n FROM qf_sketch GROUP BY {group}, bucket)),
    qf_{name} AS (SELECT {group}, max(r)::BIGINT AS {tag}rows, min(CASE WHEN upto * 100 >= r * {of(1)} THEN bucket END) AS {tag}lo,
      min(CASE WHEN upto * 100 >= r * {of(2)} THEN bucket END) AS {tag}hi FROM qf_{name}_u GROUP BY {group}),"""

    fences, tests = [], []
    for f in FENCES:
        m, side = f.rsplit("_", 1)
        times, wide = METRICS[m][3], f"greatest(wide, {METRICS[m][4]})"
        at = f"hi + {times} * {wide}" if side == "max" else f"lo - {times} * {wide}"
        fences.append(f"max(CASE WHEN metric = '{m}' AND {wide} > 0 THEN {at} END) AS {f}")
        tests.append(f"coalesce({m} {'<=' if side == 'max' else '>='} {f}, true)")
    return f"""
    qf_words AS (
      SELECT *, coalesce(text, '') AS body, coalesce('s:' || lang, 'n') AS l_, coalesce('s:' || source, 'n') AS s_,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM {docs}),
    qf_windows AS (SELECT *, list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) AS t FROM qf_words),
    qf_rows AS (SELECT row_number() OVER () AS k, * FROM qf_windows),
    qf_starts AS (SELECT k, p, lead(p) OVER (PARTITION BY k ORDER BY p) AS nxt FROM
      (SELECT k, p, count(*) OVER (PARTITION BY k, x) AS c FROM (SELECT k, unnest(t) AS x, unnest(range(1, len(t) + 1)) AS p FROM qf_rows)) WHERE c > 1),
    qf_cover AS (SELECT k, sum(CASE WHEN nxt IS NULL THEN 3 ELSE least(3, nxt - p) END)::BIGINT AS n_repeat_words FROM qf_starts GROUP BY k),
    qf_counts AS (
      SELECT r.* EXCLUDE (w, ls, t), len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
        length(regexp_replace(body, '[^{OTHER}]+', '', 'g'))::BIGINT AS n_other, length(regexp_replace(body, '[^A-Z]+', '', 'g'))::BIGINT AS n_upper
      FROM qf_rows r LEFT JOIN qf_cover USING (k)),
    qf_scored AS (
      SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
        {", ".join(f"CASE WHEN word_chars > 0 THEN {e} ELSE 0 END AS {m}" for m, e in metrics.items())} FROM qf_counts),
    qf_long AS ({" UNION ALL ".join(f"SELECT l_, s_, {m!r} AS metric, {m} AS v FROM qf_scored WHERE NOT base_failed" for m in METRICS)}),
    qf_sketch AS (SELECT l_, s_, metric, CASE WHEN v < {1 << BITS} THEN v ELSE (v >> (length(bin(v)) - {BITS})) << (length(bin(v)) - {BITS}) END AS bucket, count(*) AS n
      FROM qf_long GROUP BY ALL),{level("own", "l_, s_, ", "o_")}{level("lang", "l_, ", "l_")}
    qf_wide AS (SELECT l_, metric, sum(o_rows * (o_hi - o_lo)) // sum(o_rows) AS l_wide FROM qf_own GROUP BY ALL),
    qf_between AS (SELECT l_, s_, metric, (o_rows * o_lo + {prior} * l_lo) // (o_rows + {prior}) AS lo, (o_rows * o_hi + {prior} * l_hi) // (o_rows + {prior}) AS hi,
      (o_rows * (o_hi - o_lo) + {prior} * l_wide) // (o_rows + {prior}) AS wide FROM qf_own JOIN qf_lang USING (l_, metric) JOIN qf_wide USING (l_, metric)),
    qf_fences AS (SELECT l_, s_, {", ".join(fences)} FROM qf_between GROUP BY l_, s_),
    judged AS (SELECT *, NOT base_failed AND {" AND ".join(tests)} AS kept FROM qf_scored LEFT JOIN qf_fences USING (l_, s_))"""


OP1_SQL = f"""WITH {quality_sql("documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, {", ".join(METRICS)},
  {", ".join(f"{f}::BIGINT AS {f}" for f in FENCES)} FROM judged"""
