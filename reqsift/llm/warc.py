"""WARC archives and a globally ordered capture index.

Records are text and are written by Spark's own text writer, a record per row with the two blank lines that end a WARC
record as line separator, so archives go to any store and whole tasks are committed. An archive is one gzip stream (not one
per record); offsets are those in the unpacked archive. Archives are read back whole, each bounded in size when written,
and parsed by their ``Content-Length``.

The index is built like an external sort: every archive gives one locally sorted run of captures, runs are cut at common
boundaries by a range shuffle, and each range merges its runs with a loser tree.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import stored, text_or_empty, type_of

#: Payload bytes per archive, so that one fits a task's memory several times over; a larger single record stands alone.
ARCHIVE_BYTES = 8 << 20
#: Payloads of at least this many bytes are stored once.
REVISIT_BYTES = 0
#: Date of captures that bring no time of their own.
UNDATED = "1970-01-01T00:00:00Z"

_END = "\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each five hex digits are four base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: str) -> Column:
    """Sort key of a URL: host labels reversed, then the rest without scheme and fragment, lower-cased; empty for null."""
    rest = F.regexp_replace(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*", 0), r"^www\d*\.", "")
    return F.concat(
        F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(rest, r"^[^/?]*(.*)$", 1)
    )


def _clean(value: Column) -> Column:
    """Header values hold no line ends."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"[\r\n]", "%20")


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url: str = "url",
    payload: str = "html",
    time: str | None = None,
    least: int = REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """One record per row of ``pages``. Of payloads that are equal and have ``least`` bytes, the smallest id's is the response.

    Null payloads are empty. Rows of equal id and payload are responses together; a null id comes before all ids.
    ``time`` names a timestamp column; without one, and for nulls, records carry ``UNDATED``.
    """
    date = F.lit(None) if time is None else F.date_format(F.col(time), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = pages.select(
        F.col(id_col).alias("id"),
        _clean(F.col(url)).alias("url"),
        F.coalesce(date, F.lit(UNDATED)).alias("date"),
        text_or_empty(payload).alias("payload"),
    )
    rows = rows.withColumns({"digest": base32_sha1(F.col("payload")), "size": F.octet_length("payload").cast("long")})
    # Digests and ids first, without the payloads.
    light = stored(rows.select("id", "digest", "size"), "payload-digests")
    # Nulls first: a null id is the smallest.
    first = F.min(F.struct(F.col("id").isNotNull().alias("known"), F.col("id").alias("id"))).alias("first")
    firsts = light.filter(F.col("size") >= least).groupBy("digest").agg(first)
    firsts = firsts.select(F.col("digest").alias("d"), F.col("first.id").alias("first_id"), F.lit(True).alias("shared"))
    # Which rows are revisits is settled on digests alone; the payloads are then shuffled once, by row and not by digest,
    # so that many copies of one payload spread over all archives.
    row = F.concat_ws(":", "digest", F.col("id").cast("string"))
    revisits = light.join(firsts, (F.col("digest") == F.col("d")) & ~F.col("id").eqNullSafe(F.col("first_id")))
    revisits = revisits.select(row.alias("row"), "first_id", "shared").dropDuplicates(["row"])
    total = light.agg(F.sum("size"), F.count("*")).first()
    archives = int(1 + ((total[0] or 0) + 600 * total[1]) // archive_bytes)
    joined = rows.withColumn("row", row).repartition(archives, "row").join(revisits.repartition(archives, "row"), "row", "left")
    revisit = F.coalesce("shared", F.lit(False))
    name = lambda c: F.concat(F.lit("<urn:capture:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("id"))),
        F.concat(F.lit("WARC-Date: "), F.col("date")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("first_id")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body)),
    )
    records = joined.select(F.concat(head, F.lit(_END), body).alias("record"))
    records.write.option("lineSep", _END).option("compression", "gzip").text(path)


def _records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``offset, headers, body`` of every record of an archive; raises on anything that is no record."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(headers["Content-Length"])
        body = data[stop + 4 : stop + 4 + size]
        if data[stop + 4 + size : stop + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut off")
        yield at, headers, body
        at = stop + 8 + size


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """``record_id, type, date, url, payload_digest, refers_to, size, file, offset`` (and ``payload``) of every record.

    The digest of a response is that of the body in the archive; one that differs from its header raises. A revisit has no
    body, so its digest is its header's.
    """

    def digest(h: dict[str, str], body: bytes) -> str:
        said = h["WARC-Payload-Digest"].removeprefix("sha1:")
        if h["WARC-Type"] == "revisit":
            return said
        found = base64.b32encode(hashlib.sha1(body).digest()).decode()
        if found != said:
            raise ValueError(f"{h['WARC-Record-ID']}: the payload digest is {found}, its header says {said}")
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, rows = batch.column(0)[i].as_py(), []
                for at, h, body in _records(gzip.decompress(batch.column(1)[i].as_buffer())):
                    row = {
                        "record_id": h["WARC-Record-ID"],
                        "type": h["WARC-Type"],
                        "date": h["WARC-Date"],
                        "url": h["WARC-Target-URI"],
                        "payload_digest": digest(h, body),
                        "refers_to": h.get("WARC-Refers-To"),
                        "size": len(body),
                        "file": file,
                        "offset": at,
                    }
                    rows.append(row | {"payload": body.decode()} if payloads else row)
                # The run of this archive, in the order of the index.
                rows.sort(key=lambda r: (r["url"], r["date"], r["record_id"]))
                for start in range(0, len(rows), 500):
                    yield pa.RecordBatch.from_pylist(rows[start : start + 500], schema=schema)

    fields = ["record_id", "type", "date", "url", "payload_digest", "refers_to"]
    schema = pa.schema([*((f, pa.string()) for f in fields), ("size", pa.int64()), ("file", pa.string()), ("offset", pa.int64())])
    text = ", ".join(f"{f} string" for f in fields) + ", size long, file string, offset long"
    if payloads:
        schema, text = schema.append(pa.field("payload", pa.string())), text + ", payload string"
    # The text writer names its files part-*; nothing else lies in the folder but its marks.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0")
    return files.select("path", "content").mapInArrow(run, text)


class LoserTree:
    """Merges sorted iterators: one comparison per level for each item, and the loser of every match stays in its node."""

    def __init__(self, runs: list[Iterator]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        k = len(self.runs)
        self.losers = [-1] * max(k, 1)
        for i in range(k):
            self._rise(i)

    def _before(self, a: int, b: int) -> bool:
        """Whether run ``a`` comes first; -1 stands for a place not yet played, which comes before all."""
        if a < 0 or b < 0:
            return a < b
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _rise(self, winner: int) -> None:
        node = (winner + len(self.runs)) // 2
        while node > 0:
            if self._before(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.runs and (item := self.heads[first := self.losers[0]]) is not None:
            yield item
            self.heads[first] = next(self.runs[first], None)
            self._rise(first)


def capture_index(records: DataFrame) -> DataFrame:
    """``records`` with ``url_key, range_no, place``: sorted by URL key, date and record id over ``(range_no, place)``.

    Ranges ascend, and places ascend from 0 in each. Rows are cut by all three columns, so that the captures of one URL
    may lie in several ranges. Equal rows stand side by side.
    """
    keyed = records.withColumn("url_key", url_key("url"))
    names = keyed.columns
    key = [names.index(c) for c in ("url_key", "date", "record_id", "file", "offset")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                runs.setdefault(row[names.index("file")], []).append((tuple(row[i] for i in key), row))
        for held in runs.values():
            held.sort()  # a run arrives in its sorted pieces, which this puts together in linear time
        held, place = [], 0
        for _, row in LoserTree(list(runs.values())):
            held.append((*row, place))
            place += 1
            if len(held) == 5000:
                yield _batch(held, schema)
                held = []
        if held:
            yield _batch(held, schema)

    def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        full = schema.append(pa.field("place", pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), full.types)], schema=full)

    ranges = keyed.repartitionByRange("url_key", "date", "record_id")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields)
    return ranges.mapInArrow(run, kinds + ", place long").withColumn("range_no", F.spark_partition_id())


def archived_pages(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """``id, payload_bytes, payload_digest, record_type, refers_to, url_key, capture_no`` of every record in ``path``.

    A revisit's bytes and digest are those of the response it refers to; one without such a response raises. ``capture_no`` counts all captures from 1 in index order.
    """
    records = stored(capture_index(read_archives(spark, path)), "capture-index")
    before = "coalesce(sum(n) OVER (ORDER BY range_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
    # One row per range.
    ranges = records.groupBy(F.col("range_no").alias("_no")).agg(F.count("*").alias("n"))
    ranges = ranges.withColumnRenamed("_no", "range_no").select(F.col("range_no").alias("_no"), F.expr(before).alias("_before"))
    sizes = records.filter("type = 'response'")
    sizes = sizes.select(F.col("record_id").alias("_r"), F.col("payload_digest").alias("_d"), F.col("size").alias("_size"))
    # Rows of one id may be responses of several payloads.
    sizes = sizes.dropDuplicates(["_r", "_d"])
    joined = records.join(sizes, (F.col("refers_to") == F.col("_r")) & (F.col("payload_digest") == F.col("_d")), "left")
    lost = F.raise_error(F.concat(F.col("record_id"), F.lit(": no response with its digest at "), F.col("refers_to")))
    of_response = F.when(F.col("_d").isNull(), lost).otherwise(F.col("_d"))
    joined = joined.join(F.broadcast(ranges), F.col("range_no") == F.col("_no"))
    number = lambda c: F.regexp_extract(c, "<urn:capture:(.*)>", 1)
    value = lambda c: F.when(number(c) != "null", number(c)).cast(id_type)
    return joined.select(
        value(F.col("record_id")).alias("id"),
        F.when(F.col("type") == "revisit", F.col("_size")).otherwise(F.col("size")).alias("payload_bytes"),
        F.when(F.col("type") == "revisit", of_response).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        value(F.col("refers_to")).alias("refers_to"),
        "url_key",
        (F.col("_before") + F.col("place") + 1).alias("capture_no"),
    )


#: DuckDB SQL of the query over ``pages``: archives written, read back and indexed.
SQL = r"""
WITH texts AS (SELECT page_id, coalesce(html, '') AS t, coalesce(url, '') AS u FROM pages),
digests AS (SELECT *, sha1(t) AS h, regexp_replace(lower(u), '^[a-z][a-z0-9+.-]*://|#.*$', '', 'g') AS rest FROM texts),
numbers AS (
    SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substr(h, 1 + 5 * i, 5))::BIGINT) AS n,
        min(page_id) OVER (PARTITION BY h) AS first,
        regexp_replace(regexp_extract(rest, '^[^/?]*'), '^www\d*\.', '') AS host
    FROM digests
),
keyed AS (
    SELECT *, array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || regexp_extract(rest, '^[^/?]*(.*)$', 1) AS url_key
    FROM numbers
)
SELECT page_id, octet_length(encode(t))::BIGINT AS payload_bytes,
    array_to_string(list_transform(n, lambda x: array_to_string(list_transform(
        [x // 32768, x // 1024 % 32, x // 32 % 32, x % 32],
        lambda y: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', y + 1, 1)), '')), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to, url_key,
    row_number() OVER (ORDER BY url_key, '<urn:capture:' || page_id || '>') AS capture_no
FROM keyed
"""
