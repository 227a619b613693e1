"""CSV campaigns, ledgers, result exports."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.sources.records import file_name as file_name
from quarrystone.sources.records import read_companies_csv, read_csv_fields, unify_fields

# Names that a header is mapped to: exact ones, then by words it holds, in this order.
EXACT = {"profile_url": "source_url", "website": "initial_website"}
KEYWORDS = [
    (("ragione", "company", "azienda", "nome"), "company_name"), (("p_iva", "piva", "partita", "vat"), "vat_id"), (("tel", "phone", "cell"), "phone"), (("indirizzo", "address", "via"), "address"), (("citta", "city", "comune"), "city"),
    (("prov",), "province"), (("cap", "zip", "postal"), "postal_code"), (("settore", "industry", "categor"), "industry"), (("sito", "web", "url"), "initial_website"), (("paese", "country", "nazione"), "country"),
]
ALIASES = {
    "company_name": ["company_name", "ragione_sociale", "name"], "vat": ["vat_code", "vat", "piva", "partita_iva"], "city": ["city", "citta", "comune", "query_location"], "website": ["website", "site", "url", "pg_url"],
    "phone": ["phone", "telefono"], "address": ["address", "indirizzo"], "email": ["email"], "province": ["province", "provincia"], "category": ["category", "categoria"], "country": ["country"],
}
LEDGER = "timestamp timestamp, module string, provider string, tier int, task_type string, cost_eur double, tokens_used long, cache_hit boolean, cache_level string, duration_ms long, success boolean, error string, company_id string"
#: How files are written: with a header, quotes doubled, as ``read_companies_csv`` takes them; a value is not quoted only because
#: quotes lie within it, so that readers with Spark's defaults take it as it is.
CSV = {"header": True, "escape": '"', "escapeQuotes": False}
RETRY_COLUMNS = ["company_name", "city", "province", "address", "phone", "website", "category", "vat", "email"]


def delimiter(header: str) -> str:
    """';' if there are more than ',' and no fewer than tabs; tab if more than both; else ','."""
    semi, tab, comma = (header.count(x) for x in ";\t,")
    return ";" if semi > comma and semi >= tab else "\t" if tab > comma and tab > semi else ","


def slug_header(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def mapped_header(name: str) -> str:
    s = slug_header(name)
    return EXACT.get(s) or next((target for words, target in KEYWORDS if any(w in s for w in words)), s)


def map_headers(df: DataFrame) -> DataFrame:
    """Columns renamed by rule; where several map to one name the first filled one counts."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        groups.setdefault(mapped_header(c), []).append(c)
    filled = lambda c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit(""))
    return df.select(*[F.coalesce(*[filled(c) for c in cs]).alias(n) for n, cs in groups.items()])


def read_campaign_dir(spark: SparkSession, dirs: list[str]) -> DataFrame:
    """All CSV files of some folders but consolidated ones, columns united."""
    out = read_companies_csv(spark, [f"{d}/*.csv" for d in dirs])
    return out.where(~F.col("source_file").startswith("MASTER_CONSOLIDATED"))


def unify_campaign_dir(spark: SparkSession, dirs: list[str]) -> DataFrame:
    """Canonical columns of all CSV files of some folders but consolidated ones, in one scan whatever the number of headers."""
    rows = read_csv_fields(spark, [f"{d}/*.csv" for d in dirs]).where(~F.col("source_file").startswith("MASTER_CONSOLIDATED"))
    return unify_fields(rows, ALIASES).withColumn("country", F.coalesce("country", F.lit("IT")))


def flag_invalid_rows(df: DataFrame, row_id: str = "row_id", name: str = "company_name") -> DataFrame:
    """Rows without a name are kept, named invalid_row_<n>, with an error."""
    bad = F.length(F.trim(F.coalesce(name, F.lit("")))) == 0
    return df.withColumns({"ingest_error": F.when(bad, F.lit("MISSING_COMPANY_NAME")), name: F.when(bad, F.concat(F.lit("invalid_row_"), F.col(row_id).cast("string"))).otherwise(F.trim(name))})


def unify_campaign_schema(df: DataFrame) -> DataFrame:
    """Canonical columns from their aliases, blanks squeezed, country IT by default; other columns are left out."""
    have = {c.lower(): c for c in df.columns}
    clean = lambda c: F.nullif(F.trim(F.regexp_replace(F.col(f"`{c}`").cast("string"), r"\s+", " ")), F.lit(""))

    def first(names: list[str]) -> Column:
        found = [clean(have[n]) for n in names if n in have]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    out = df.select(*[first(names).alias(n) for n, names in ALIASES.items()], *[have[c] for c in ("row_id", "source_file") if c in have])
    return out.withColumn("country", F.coalesce("country", F.lit("IT")))


def sanitize_master(df: DataFrame, category: str = "generic") -> DataFrame:
    """Line breaks and tabs off, province from '(XX)' in the address, default category."""
    text = [c for c, t in df.dtypes if t == "string"]
    out = df.withColumns({c: F.trim(F.regexp_replace(c, r"[\r\n\t]+", " ")) for c in text})
    code = F.nullif(F.regexp_extract("address", r"\(([A-Z]{2})\)", 1), F.lit(""))
    return out.withColumns({"province": F.coalesce(F.nullif("province", F.lit("")), code), "category": F.coalesce(F.nullif("category", F.lit("")), F.lit(category))})


def missing_website(df: DataFrame, mode: str = "blank") -> DataFrame:
    """Rows with a blank website, or (mode 'http') with one that holds no 'http'."""
    site = F.trim(F.coalesce("website", F.lit("")))
    return df.where(site == "" if mode == "blank" else ~F.contains(site, F.lit("http")))


def retry_rows(df: DataFrame) -> DataFrame:
    return df.where((F.coalesce("status", F.lit("")) != "OK") & (F.coalesce("status", F.lit("")) != ""))


def split_by_score(df: DataFrame, threshold: float = 99) -> tuple[DataFrame, DataFrame]:
    """(rows above the threshold, the others with the input columns alone and '' for null); no number counts as 0."""
    score = F.coalesce(F.col("score").try_cast("double"), F.lit(0.0))
    cols = [c for c in RETRY_COLUMNS if c in df.columns]
    return df.where(score > threshold), df.where(score <= threshold).select(*cols).fillna("")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).json(path)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON strings."""
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("struct", "array", "map")]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def write_results_csv(df: DataFrame, path: str) -> None:
    flat(df).write.options(**CSV).csv(path)


def write_named_csv(df: DataFrame, path: str, **options) -> None:
    """One CSV file of just this name, for a table that one task can write: written beside it, then renamed."""
    spark, (folder, _, name) = df.sparkSession, path.rpartition("/")
    part = f"{folder}/_{name}"
    flat(df).coalesce(1).write.options(**CSV, **options).csv(part)
    at = spark._jvm.org.apache.hadoop.fs.Path(part)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{part}/part-*.csv"))
    fs.rename(found[0].getPath(), spark._jvm.org.apache.hadoop.fs.Path(path))
    fs.delete(at, True)


def write_by_province(df: DataFrame, path: str, columns: list[str]) -> None:
    """One folder per province ('unknown' for null) below ``path``/by_province, and all rows in ``path``/all."""
    rows = df.select(*columns, F.coalesce(F.nullif("province", F.lit("")), F.lit("unknown")).alias("province_part"))
    rows.write.options(**CSV).partitionBy("province_part").csv(f"{path}/by_province")
    df.select(*columns).write.options(**CSV).csv(f"{path}/all")


def select_leads(df: DataFrame, min_score: float = 0, categories: list[str] | None = None, fields: list[str] | None = None, sort_by: str = "total") -> DataFrame:
    rows = df.where(F.col("total") >= min_score)
    rows = rows.where(F.col("category").isin(categories)) if categories else rows
    rows = rows.orderBy(F.desc(sort_by) if sort_by == "total" else F.col(sort_by), "company_id")
    return rows.select(*fields) if fields else rows


def export_leads(df: DataFrame, path: str, fmt: str = "csv", **options) -> None:
    flat(select_leads(df, **options)).write.options(**CSV).format(fmt).save(path)


def export_segmented(df: DataFrame, path: str) -> None:
    """One folder per category; those without rows don't come to be."""
    flat(df.withColumn("segment", F.col("category"))).write.options(**CSV).partitionBy("segment").csv(path)


def parse_search_json(df: DataFrame, text: str = "body", key: str = "page_id") -> DataFrame:
    """(key, place, url, title, description) of search responses: data, results or a top-level list; else every URL in the text."""
    item = "struct<title: string, url: string, description: string, content: string>"
    top, data, results = F.from_json(text, f"array<{item}>"), F.from_json(text, f"struct<data: array<{item}>>")["data"], F.from_json(text, f"struct<results: array<{item}>>")["results"]
    some = lambda c: F.when(F.size(F.filter(c, lambda x: x["url"].isNotNull())) > 0, c)
    urls = F.transform(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(r"https?://[^\s\"'<>)\]]+"), F.lit(0))), lambda u: F.struct(F.lit(None).cast("string").alias("title"), u.alias("url"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("content")))
    rows = df.select(key, F.posexplode(F.coalesce(some(data), some(results), some(top), urls)).alias("p", "x"))
    return rows.select(key, (F.col("p") + 1).alias("place"), "x.url", "x.title", F.coalesce("x.description", "x.content").alias("description")).where("url is not null")


def flatten_run_results(df: DataFrame) -> DataFrame:
    """Flat rows of nested run results, layers joined by ';'."""
    return df.select("company.company_name", "company.city", "result.status", "result.url", "result.confidence", "result.layer", "duration_ms", F.array_join("layers", ";").alias("layers"))
