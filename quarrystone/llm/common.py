"""Expressions that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The ASCII blanks of the contracts, space and tab to carriage return.
BLANK_CLASS = r"[\x20\x09-\x0D]"
#: The ASCII separators for licence and benchmark words (a word is what lies between them, lower-cased).
SEPARATOR_CLASS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is evaluated once for the row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_CLASS + "+"), "")


def plain_text(text: Column) -> Column:
    """Lower-cased words between ASCII separators, joined by single spaces; '' for null."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR_CLASS + "+", " "))


def seeded_hash(seed: int, *cols: Column) -> Column:
    """60 bits of md5 over the seed and the columns as text, so that SQL engines agree on it."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def stratum(source: Column) -> Column:
    """A non-null key for a source."""
    return F.coalesce(F.concat(F.lit("s:"), source.cast("string")), F.lit("n"))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def need(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def col_of(name: str) -> Column:
    """The column of just this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


class Boxed:
    """The caller's columns as one struct, so that none of them meets a column of the operator's own.

    ``keep``: those wanted (all by default), without those named like a ``new`` one, in whatever case.
    """

    def __init__(self, docs: DataFrame, keep: list[str] | None, new: list[str], name: str = "_doc"):
        taken = {n.lower() for n in new}
        self.kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
        self.name = name
        self.box = F.struct(*[col_of(c).alias(f"c{i}") for i, c in enumerate(self.kept)] or [F.lit(True).alias("none")]).alias(name)

    def hashed(self) -> Column:
        """A hash of what can be hashed of them."""
        return F.xxhash64(*[F.to_json(F.struct(col_of(c))) for c in self.kept] or [F.lit(0)])

    def columns(self) -> list[Column]:
        """The caller's columns again."""
        return [F.col(self.name)[f"c{i}"].alias(c) for i, c in enumerate(self.kept)]


def bucket(v: str, bits: int = 6) -> str:
    """SQL: the lower end of the sketch bucket of a whole number: exact below 2**bits, else its leading bits."""
    return f"CASE WHEN {v} < {1 << bits} THEN {v} ELSE shiftleft(shiftright({v}, length(bin({v})) - {bits}), length(bin({v})) - {bits}) END"


#: A key with this share of all rows is joined by broadcast; fewer keys than this many can have it.
HOT_SHARE = 1000


def spread_join(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` joined to their ``groups`` (one for each ``key``; ``size``: how many of the rows have it), both written tables.

    Keys with over 1 / HOT_SHARE of the rows are fewer than HOT_SHARE whatever the data, so these are broadcast and their rows
    stay where they are; a partition of the shuffle for the others gets no large key.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * HOT_SHARE > total
    often = groups.where(hot)
    return rows.join(F.broadcast(often), key).unionByName(rows.join(F.broadcast(often.select(key)), key, "left_anti").join(groups.where(~hot), key))
