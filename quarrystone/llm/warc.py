"""Deterministic sharded WARC archives."""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrystone.llm.common import col_of, need
from quarrystone.session import materialize, shared_dir, table

#: Payload bytes that a range is planned for, and compressed bytes at which a file is rolled.
RANGE_BYTES = 32 << 20
ROLL_BYTES = 8 << 20
#: Cells of equal id width that a span of ids is counted in.
CELLS = 4096
#: Tables of more rows than this are joined by a shuffle; of more ranges than TASKS some share a task.
BROADCAST_ROWS = 200_000
TASKS = 20_000
#: All records bear this date, so that a file's bytes follow from its rows alone.
DATE = "2024-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST = "range int, roll int, file string, records long, bytes long, sha256 string"


def record_id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}|{url}')}>"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _safe(url: str | None) -> str:
    """A header value: control characters would end the line, so they are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, is_revisit: bool) -> bytes:
    """One gzip member with one record; the payload of a revisit is left out, its length and digest stay in the header."""
    block = b"" if is_revisit else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, url)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_safe(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{digest_of(block)}",
        f"X-Payload-Length: {len(payload)}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(block)}",
    ]
    if is_revisit:
        lines[-2:-2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {refers_to}"]
    raw = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)  # no time, no name: the same bytes each time
    return packed.compress(raw) + packed.flush()


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record; raises ValueError if a length or digest does not hold."""
    view, at = memoryview(data), 0
    while at < len(view):
        member, parts = zlib.decompressobj(31), []
        while not member.eof:  # in pieces, so that what follows the member isn't copied each time
            if at >= len(view):
                raise ValueError("cut gzip member")
            piece = view[at : at + 65536]
            parts.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        headers = {k: v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(headers["Content-Length"])
        block = rest[:length]
        if first != "WARC/1.1" or rest[length:] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != f"sha1:{digest_of(block)}":
            raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
        if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != headers["WARC-Block-Digest"]:
            raise ValueError(f"payload digest of {headers['WARC-Record-ID']}")
        yield headers, block


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class _Roll:
    """The archive being written: a temporary name of this attempt's own, renamed when the file is complete."""

    def __init__(self, folder: str, of_range: int, roll: int):
        self.fs, base = _opened(folder)
        self.range, self.roll, self.records, self.bytes, self.sha = of_range, roll, 0, 0, hashlib.sha256()
        self.file = f"part-{of_range:06d}-{roll:05d}.warc.gz"
        self.final = posixpath.join(base, self.file)
        self.temporary = posixpath.join(base, f"_temporary-{uuid.uuid4().hex}-{self.file}")
        self.out = self.fs.open_output_stream(self.temporary, compression=None)

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.sha.update(member)
        self.records += 1
        self.bytes += len(member)

    def commit(self) -> tuple:
        self.out.close()
        self.fs.move(self.temporary, self.final)  # of two attempts, either leaves the same bytes
        return self.range, self.roll, self.file, self.records, self.bytes, self.sha.hexdigest()


def _writer(folder: str, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["range", "roll", "file", "records", "bytes", "sha256"]
        schema = pa.schema([("range", pa.int32()), ("roll", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
        now: _Roll | None = None
        again: tuple | None = None
        for batch in batches:
            done = []
            for at in range(batch.num_rows):
                of_range, page_id, sha, first, marker = (batch.column(c)[at].as_py() for c in ("range", "page_id", "sha", "first", "marker"))
                if marker:
                    again = (page_id, sha, first)
                    continue
                revisit = again is not None and again[:2] == (page_id, sha)
                payload = (batch.column("html")[at].as_py() or "").encode("utf-8", "surrogatepass")
                if now and (now.range != of_range or now.bytes >= roll_bytes):
                    done.append(now.commit())
                    now = _Roll(folder, of_range, now.roll + 1 if now.range == of_range else 0)
                now = now or _Roll(folder, of_range, 0)
                now.add(build_record(page_id, batch.column("url")[at].as_py(), payload, digest_of(payload), again[2] if revisit else None, revisit))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done, strict=True), schema, strict=True)] if done else [pa.array([], f.type) for f in schema], names=names)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(now.commit(), schema, strict=True)], names=names)

    return write


def _small(df: DataFrame) -> DataFrame:
    """To be broadcast if it has ``BROADCAST_ROWS`` rows at most."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _with_starts(df: DataFrame, heavy: list[DataFrame], widths: list[int]) -> DataFrame:
    """Add the row's cell: ``level``, the first width at which it isn't heavy, and ``start``, its first offset."""
    out = df.withColumn("level", F.lit(0))
    for j, cells in enumerate(heavy):
        cells = _small(cells.select(F.col("p").alias("_p"), F.lit(True).alias("_heavy")))
        out = out.join(cells, (F.expr(f"offset div {widths[j]}") == F.col("_p")) & (F.col("level") == j), "left")
        out = out.withColumn("level", F.when(F.col("_heavy"), F.lit(j + 1)).otherwise(F.col("level"))).drop("_p", "_heavy")
    width = F.element_at(F.array(*[F.lit(w).cast("long") for w in widths]), F.col("level") + 1)
    return out.withColumn("start", F.col("offset") - F.col("offset") % width)


def _planned(sized: DataFrame, rows: DataFrame, range_bytes: int) -> tuple[DataFrame, int]:
    """(``rows`` with their ``range``, number of ranges): ids are counted in cells of equal width; cells of more than
    ``range_bytes`` are cut into ``CELLS`` each, and so on; cells are joined in order until a range has that many bytes.

    The bytes before a cell are those of earlier cells beside it, and of those beside each cell around it: no window has
    more than ``CELLS`` rows. Rows of null ids stand before all others, dealt to ranges of their own by a hash."""
    ends = sized.agg(F.min("page_id"), F.max("page_id"), F.sum(F.when(F.col("page_id").isNull(), F.col("payload_bytes")))).first()
    low, span = ends[0] or 0, (ends[1] or 0) - (ends[0] or 0) + 1
    first = 0 if ends[2] is None else ends[2] // range_bytes + 1
    widths = [1]
    while widths[0] * CELLS < span:
        widths.insert(0, widths[0] * CELLS)
    offset = (F.col("page_id") - low).alias("offset")
    sized, heavy = sized.where("page_id is not null").select("payload_bytes", offset), []
    live = sized
    for width in widths[:-1]:
        cells = materialize(live.groupBy(F.expr(f"offset div {width}").alias("p")).agg(F.sum("payload_bytes").alias("b")).where(F.col("b") > range_bytes))
        if cells.isEmpty():
            break
        heavy.append(cells)
        live = live.join(_small(cells.select("p")), F.expr(f"offset div {width}") == F.col("p"), "left_semi")
    cells = _with_starts(sized, heavy, widths).groupBy("level", "start").agg(F.sum("payload_bytes").alias("b")).withColumn("before", F.lit(0).cast("long"))
    for j in range(len(heavy) + 1):
        around = F.lit(0) if j == 0 else F.expr(f"c * {widths[j]} div {widths[j - 1]}")
        upto = F.sum("b").over(Window.partitionBy(around).orderBy("c").rowsBetween(Window.unboundedPreceding, 0))
        beside = cells.where(f"level >= {j}").groupBy(F.expr(f"start div {widths[j]}").alias("c")).agg(F.sum("b").alias("b"))
        beside = beside.select("c", (upto - F.col("b")).alias("beside"))
        cells = cells.withColumn("c", F.expr(f"CASE WHEN level >= {j} THEN start div {widths[j]} END")).join(beside, "c", "left")
        cells = cells.withColumn("before", F.col("before") + F.coalesce("beside", F.lit(0))).drop("c", "beside")
    cells = materialize(cells.select("level", "start", F.expr(f"cast({first} + before div {range_bytes} as int)").alias("of")))
    n = cells.agg(F.max("of")).first()[0]
    dealt = _with_starts(rows.withColumn("offset", offset), heavy, widths).join(_small(cells), ["level", "start"], "left")
    unnamed = F.pmod(F.xxhash64("sha", "url"), F.lit(max(first, 1))).cast("int")
    return dealt.withColumn("range", F.coalesce("of", unnamed)).drop("level", "start", "offset", "of"), max(first, 1 if n is None else n + 1)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, range_bytes: int = RANGE_BYTES, roll_bytes: int = ROLL_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record for every row below ``folder``, and the manifest last, to ``folder``/manifest; return the manifest.

    Of equal payloads of ``min_bytes`` at least, the row of smallest id is a response and the others revisit it. Rows are
    sorted by id and cut into ranges at places that follow from ids and byte counts alone; a range is one stretch of one
    task, whose files roll at ``roll_bytes`` compressed. A file is written under a temporary name of its attempt and then
    renamed, so a task that is run again replaces files by the same bytes; readers take only what the manifest lists.

    Null html is an empty payload. Rows of a null id are responses and stand in ranges before all others; rows that repeat an id and
    its payload are alike, so all of them are responses if the id is the payload's smallest. An empty table gives an empty
    manifest. Other columns are not written.
    """
    need(pages, id_col, url_col, html_col)
    body = F.coalesce(col_of(html_col), F.lit(""))
    rows = pages.select(
        col_of(id_col).cast("long").alias("page_id"), col_of(url_col).alias("url"), col_of(html_col).alias("html"), F.octet_length(body).cast("long").alias("payload_bytes"), F.sha1(body.cast("binary")).alias("sha")
    )
    sized = materialize(rows.select("page_id", "payload_bytes", "sha"))
    # The first of each payload by partial minima: a payload that a third of all rows share costs a row for each task.
    firsts = sized.where(F.col("page_id").isNotNull() & (F.col("payload_bytes") >= min_bytes)).groupBy("sha", "payload_bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    revisits = sized.join(firsts.where("n > 1"), ["sha", "payload_bytes"]).where("page_id <> first").select("page_id", "sha", "first").distinct()
    # A revisit is told to the writer by a row of its own, which sorts before the record: so pages move only once.
    told = revisits.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "sha", "first", F.lit(True).alias("marker"))
    rows = rows.select("page_id", "url", "html", "sha", F.lit(None).cast("long").alias("first"), F.lit(False).alias("marker"))
    dealt, n = _planned(sized, rows.unionByName(told), range_bytes)
    # A range to a task; of very many ranges, some to each in turn.
    dealt = dealt.repartitionById(min(n, TASKS), F.pmod("range", F.lit(min(n, TASKS)))).sortWithinPartitions("range", F.col("page_id").asc_nulls_first(), "sha", F.desc("marker"), "url")
    system, base = _opened(folder)
    system.create_dir(base, recursive=True)
    manifest = dealt.select("range", "page_id", "url", "html", "sha", "first", "marker").mapInArrow(_writer(folder, roll_bytes), MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


_RECORD = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}


def _parsed(names: list[str]):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {n: [] for n in names}

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(out[n], _RECORD[n]) for n in names], names=names)

        for batch in batches:
            for content, sha in zip(batch.column("content"), batch.column("sha256"), strict=True):
                content = content.as_py()
                if hashlib.sha256(content).hexdigest() != sha.as_py():
                    raise ValueError("an archive differs from its manifest")
                for h, block in read_records(content):
                    page, refers = h["X-Page-Id"], h.get("X-Refers-To-Page-Id")
                    row = (int(page) if page else None, h["WARC-Target-URI"], int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"], int(refers) if refers else None, block)
                    for n, value in zip(_RECORD, row, strict=True):
                        if n in out:
                            out[n].append(value)
                    if len(out[names[0]]) >= 500:
                        yield full()
                        out = {n: [] for n in names}
        yield full()

    return parse


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all archives that the manifest lists, every length and digest checked; ``payload`` on request."""
    manifest = spark.read.parquet(f"{folder}/manifest").select("file", "sha256")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").join(_small(manifest), "file").select("content", "sha256")
    names = [n for n in _RECORD if payloads or n != "payload"]
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return files.mapInArrow(_parsed(names), ", ".join(f"{n} {kinds[_RECORD[n]]}" for n in names))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
