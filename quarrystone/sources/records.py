"""CSV files of any number of headers, read in one scan: lines are joined to their file's header, fields kept as a map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrystone.session import broadcast_if_small, materialize

#: Delimiters, the default last.
SEPARATORS = (";", "\t", ",")


def file_name() -> Column:
    """The name of a row's file; the hidden column gives it as in a URL."""
    name = F.col("_metadata.file_name")
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def separator(header: Column) -> Column:
    """';' if there are more than ',' and no fewer than tabs; tab if more than both; else ','."""
    semi, tab, comma = (F.length(header) - F.length(F.replace(header, F.lit(s))) for s in SEPARATORS)
    return F.when((semi > comma) & (semi >= tab), ";").when((tab > comma) & (tab > semi), "\t").otherwise(",")


def _by_separator(per: dict[str, Column]) -> Column:
    return F.when(F.col("sep") == ";", per[";"]).when(F.col("sep") == "\t", per["\t"]).otherwise(per[","])


def _fields(text: str, width: int) -> Column:
    """The fields of a record, ``width`` of them, by its file's delimiter; doubled quotes stand for one, blanks around go."""
    schema = "struct<" + ",".join(f"c{i}:string" for i in range(width)) + ">"
    of = lambda s: F.from_csv(text, schema, {"sep": s, "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    parsed = _by_separator({s: of(s) for s in SEPARATORS})
    return F.transform(F.array(parsed), lambda x: F.array(*[x[f"c{i}"] for i in range(width)]))[0]


def _open_after(text: Column, sep: str) -> Column:
    """Whether a quoted field is still open at the end of a line that begins outside of one."""
    s = r"\t" if sep == "\t" else sep
    rest = F.regexp_replace(text, rf'(^|{s})[ ]*+"(?:[^"]|"")*+"', "$1x")
    return F.regexp_like(rest, F.lit(rf'(^|{s})[ ]*+"'))


def _after(sep: str) -> tuple[Column, Column]:
    """(0 or 1, is a quoted field open after the line, if it was closed before; the same if it was open before)."""
    value = F.col("value")
    closing = r'^(?:[^"]|"")*+"'
    from_open = F.when(F.regexp_like(value, F.lit(closing)), _open_after(F.regexp_replace(value, closing, "x"), sep)).otherwise(F.lit(True))
    return _open_after(value, sep).cast("int"), from_open.cast("int")


def _ends(rows: DataFrame, part: list[str], order: str) -> DataFrame:
    """``end0``, ``end1``: the state after each row if it was 0 or 1 before the first of its part. A row maps states by ``f0``
    and ``f1``: to one state, which makes all before it forgotten, to the same, or to the other; so the last row of the first
    kind and the number of the last kind since tell it, and parts can be composed like rows."""
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    swaps = F.sum(((F.col("f0") == 1) & (F.col("f1") == 0)).cast("int")).over(w)
    rows = rows.withColumn("_s", swaps)
    rows = rows.withColumn("_c", F.last(F.when(F.col("f0") == F.col("f1"), F.struct("f0", "_s")), ignorenulls=True).over(w))
    end = lambda x: F.when(F.col("_c").isNull(), (F.lit(x) + F.col("_s")) % 2).otherwise((F.col("_c.f0") + F.col("_s") - F.col("_c._s")) % 2)
    return rows.withColumns({"end0": end(0), "end1": end(1)}).drop("_s", "_c")


def _joined(lines: DataFrame) -> DataFrame:
    """(path, n, value) of records, from lines of files in which quoted fields hold line breaks.

    A split of a file (``block``) is one task's; splits are composed by their effect alone, a row each. A quote that nothing
    closes up to the end of the file opens no field: the lines from there on are records each."""
    inside, within = ["path", "block"], Window.partitionBy("path", "block").orderBy("n")
    ends = materialize(_ends(lines, inside, "n").drop("f0", "f1"))
    splits = _ends(ends.groupBy(*inside).agg(F.max_by("end0", "n").alias("f0"), F.max_by("end1", "n").alias("f1")), ["path"], "block")
    before = F.lag("end0", 1, 0).over(Window.partitionBy("path").orderBy("block"))
    last = F.last("end0").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    splits = splits.select(*inside, before.alias("start"), last.alias("unclosed"))
    state = F.when(F.col("start") == 0, F.col("end0")).otherwise(F.col("end1"))
    rows = ends.join(splits, inside).withColumn("begins", F.lag(state).over(within))
    rows = rows.withColumn("begins", F.coalesce("begins", "start") == 0)
    running = within.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("first", F.last(F.when(F.col("begins"), F.col("n")), ignorenulls=True).over(running))
    rows = materialize(rows.select(*inside, "n", "value", "unclosed", "first"))
    # The record that a split begins in the middle of, and a file's last one.
    marks = rows.groupBy(*inside).agg(F.max("first").alias("mark"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.select(*inside, F.last("mark", ignorenulls=True).over(earlier).alias("mark"), F.max("mark").over(Window.partitionBy("path")).alias("final"))
    rows = rows.join(marks, inside).withColumn("first", F.coalesce("first", "mark"))
    rows = rows.withColumn("first", F.when((F.col("unclosed") == 1) & (F.col("first") == F.col("final")), F.col("n")).otherwise(F.col("first")))
    records = rows.groupBy("path", "first").agg(F.array_sort(F.collect_list(F.struct("n", "value"))).alias("x"))
    return records.select("path", F.col("first").alias("n"), F.array_join("x.value", "\n").alias("value"))


def read_csv_fields(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, source_file, names, fields) of every record of CSV files: names in the file's order, fields as a map by name.

    Files are read once, as lines, and split where they are large. The first line that is not blank is a file's header; it
    gives delimiter and names (without quotes; empty ones by place, as _c0; of equal ones the first filled field counts).
    Blank records are dropped, further fields too, missing ones are null; quoted line breaks are kept as a line feed. The
    driver learns the number of columns of the widest header alone; headers are joined by file, broadcast if they are few.
    """
    source = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), file_name().alias("source_file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), "value")
    lines = materialize(source)  # so that splits and numbers are the same in all that follows
    heads = lines.where("trim(value) <> ''").groupBy("path", "source_file").agg(F.min_by(F.struct("n", "value"), F.struct("block", "n")).alias("h"))
    heads = heads.select("path", "source_file", F.col("h.n").alias("head"), F.regexp_replace("h.value", "^\ufeff", "").alias("value")).withColumn("sep", separator(F.col("value")))
    wide = F.length("value") - F.length(F.replace("value", F.col("sep"))) + 1
    heads = materialize(heads.withColumn("width", wide))
    width = heads.agg(F.max("width")).first()[0] or 1
    named = F.transform(F.slice(_fields("value", width), 1, F.col("width")), lambda x, i: F.coalesce(F.nullif(F.trim(x), F.lit("")), F.concat(F.lit("_c"), i.cast("string"))))
    heads = materialize(heads.select("path", "source_file", "head", "sep", named.alias("names")))

    sep = broadcast_if_small(heads.select("path", "head", "sep"))
    body = lines.join(sep, "path").where("n <> head")
    f0, f1 = (_by_separator({s: _after(s)[k] for s in SEPARATORS}) for k in range(2))
    quoted = F.contains("value", F.lit('"'))
    body = body.select("path", "block", "n", "value", F.when(quoted, f0).otherwise(0).alias("f0"), F.when(quoted, f1).otherwise(1).alias("f1"))
    broken = materialize(body.where("f0 = 1").select("path").distinct())
    records = body.select("path", "n", "value")
    if not broken.isEmpty():
        few = broadcast_if_small(broken)
        records = records.join(few, "path", "left_anti").unionByName(_joined(body.join(few, "path", "left_semi")))
    records = records.where("trim(value) <> ''")

    rows = records.join(broadcast_if_small(heads.select("path", "source_file", "sep", "names")), "path")
    rows = rows.select("path", "source_file", "n", "names", F.slice(_fields("value", width), 1, F.size("names")).alias("v"))
    pairs = F.arrays_zip("names", "v")
    first = F.transform(F.array_distinct("names"), lambda k: F.struct(k, F.try_element_at(F.filter(pairs, lambda p: (p["names"] == k) & p["v"].isNotNull()), F.lit(1))["v"]))
    fields = F.when(F.size(F.array_distinct("names")) == F.size("names"), F.map_from_arrays("names", "v")).otherwise(F.map_from_entries(first))
    return rows.select("path", "source_file", "names", fields.alias("fields"))


def field(name: str, fields: str = "fields") -> Column:
    """The first filled field of this name, whatever its case; blanks squeezed."""
    clean = lambda c: F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))
    found = F.filter(F.map_entries(fields), lambda e: (F.lower(e["key"]) == name.lower()) & clean(e["value"]).isNotNull())
    return clean(F.try_element_at(found, F.lit(1))["value"])


def unify_fields(rows: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Canonical columns from the fields of ``read_csv_fields`` by their aliases, however many names the files have."""
    return rows.select(*[F.coalesce(*[field(a) for a in names]).alias(n) for n, names in aliases.items()], "source_file")


def read_companies_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All fields as string columns, with ``source_file``. The driver learns the different names, a column for each; names that
    differ by case alone are one column."""
    rows = read_csv_fields(spark, paths)
    found = rows.select(F.posexplode("names").alias("at", "name")).groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name").collect()
    spelled: dict[str, list[str]] = {}
    for r in found:
        spelled.setdefault(r.name.lower(), []).append(r.name)
    return rows.select(*[F.coalesce(*[F.col("fields")[n] for n in names]).alias(names[0]) for names in spelled.values()], "source_file")
