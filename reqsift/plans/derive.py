"""Request texts and archives derived from the ``pages`` table, as input for the named queries.

Every page becomes one captured request, with planted credentials (``PLANTED…``) under telling and under harmless names, ports, missing hosts
and broken records, a further method, hosts in capitals and plain GETs at fixed page numbers, so that the expected records can be stated in SQL.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.request import url_host

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGES_PER_ARCHIVE = 1000
FIRST_DAY = 20240101
# Made-up credentials that only their form tells; the number of the page follows, or stands in the middle.
KEY_ID = "AKIAPLANTEDSECRET"
RANDOM = "PLANTED9xQ2mZ7kL4vT8"
SIGNED = ("eyJhbGciOiJIUzI1NiJ9.PLANTED-SECRET-", ".c2lnbmF0dXJlMQ")


def requests_of(pages: DataFrame) -> DataFrame:
    """``page_id, url, host`` of each page; the html column is not read."""
    return pages.select("page_id", "url", url_host(F.col("url")).alias("host"))


def _lines(*parts: Column) -> Column:
    """Lines that are not null, joined by line ends."""
    return F.concat_ws("\n", *parts)


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def transcripts(pages: DataFrame) -> DataFrame:
    """``page_id, text``: even pages as GET, odd ones as POST."""
    pid = F.col("page_id")
    no = pid.cast("string")
    rest = F.regexp_replace("url", r"^[a-z]+://[^/?#]+", "")
    scheme = F.substring_index("url", "://", 1)
    secret = _text("PLANTED-SECRET-", no)

    host_line = F.when(
        pid % 7 != 0, _text("Host: ", F.when(pid % 8 == 3, F.upper("host")).otherwise(F.col("host")), F.when(pid % 4 < 2, F.lit(":8080")).otherwise(F.lit("")))
    )
    token = F.when(
        pid % 3 == 0, _text(F.when(rest.contains("?"), F.lit("&")).otherwise(F.lit("?")), "token=", secret)
    ).otherwise(F.lit(""))
    key_id = F.when(
        pid % 9 == 2, _text(F.when(rest.contains("?"), F.lit("&")).otherwise(F.lit("?")), "k=", KEY_ID, no)
    ).otherwise(F.lit(""))

    def members(quote: str) -> Column:
        def member(name: str, value: Column) -> Column:
            return _text(quote, name, quote, "[[:]]", quote, value, quote)

        return F.concat_ws(
            ",",
            member("Page", no),
            member("Title", F.col("host")),
            F.when(pid % 6 == 0, member("Password", secret)),
            F.when(pid % 9 == 8, member("Memo", _text(RANDOM, no))),
        )

    payload = (
        F.when(pid % 22 == 0, F.lit('{"data":'))
        .when(pid % 4 == 0, _text('{"data":{', members('"'), "}}"))
        .otherwise(_text('{"data":"{', members('\\"'), '}"}'))
    )
    plain = pid % 10 == 0
    get = _lines(
        _text("GET ", rest, token, key_id, " HTTP/1.1"),
        host_line,
        _text("Cookie: sid=", secret),
        F.when(~plain, F.lit("")),
        F.when(~plain, payload),
    )

    target = F.when(
        pid % 5 == 0, _text(scheme, "://bob:", secret, "@", F.col("host"), rest)
    ).otherwise(F.col("url"))
    post = _lines(
        F.when(pid % 21 == 0, F.lit("POST/broken")).otherwise(
            _text(F.when(pid % 13 == 0, F.lit("PUT ")).otherwise(F.lit("POST ")), target, " HTTP/1.1")
        ),
        host_line,
        _text("Referer: ", F.col("url")),
        _text("Authorization: Basic ", secret),
        F.when(pid % 9 == 7, _text("X-Csrf-1: ", secret)),
        F.lit(""),
        _text("Page[[:]]", no),
        _text("Scheme[[:]]", scheme),
        F.lit("Empty[[:]]"),
        F.when(pid % 3 == 1, _text("Username[[:]]PLANTED-USER-", no)),
        F.when(pid % 3 == 1, _text("Password[[:]]", secret)),
        F.when(pid % 9 == 6, _text("UserPass[[:]]", secret)),
        F.when(pid % 9 == 5, _text("Ref[[:]]", SIGNED[0], no, SIGNED[1])),
        F.lit("GET it now"),
        F.lit("Note[[:]]will GET it"),
    )
    text = F.when(pid % 34 == 17, F.lit("hello world")).when(pid % 2 == 0, get).otherwise(post)
    return requests_of(pages).select("page_id", text.alias("text"))


def placed_transcripts(pages: DataFrame) -> DataFrame:
    """Transcripts with the ``archive`` (path below the root) and ``entry`` they are stored as."""
    pid = F.col("page_id")
    day = (pid % 3 + FIRST_DAY).cast("string")
    chunk = F.floor(pid / PAGES_PER_ARCHIVE).cast("string")
    nested = F.when(pid % 3 == 1, F.lit("nested/")).otherwise(F.lit(""))
    suffix = F.when(pid % 2 == 0, F.lit(".html")).otherwise(F.lit(".txt"))
    return transcripts(pages).select(
        _text(day, "/", nested, "part-", chunk, ".zip").alias("archive"),
        _text(pid.cast("string"), suffix).alias("entry"),
        "text",
    )


def write_archives(placed: DataFrame, root: str) -> int:
    """Write the zip archives below ``root``; each group is one archive of at most a fixed page count."""

    def write(pdf):
        import io
        import zipfile

        from urllib.parse import quote

        import pandas as pd
        from pyarrow import fs

        name = pdf["archive"].iloc[0]
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            for entry, text in zip(pdf["entry"], pdf["text"]):
                archive.writestr(entry, text)
            archive.writestr("readme.md", "not a request")
        filesystem, base = fs.FileSystem.from_uri(quote(root, safe="/:@"))
        target = f"{base}/{name}"
        filesystem.create_dir(target.rsplit("/", 1)[0], recursive=True)
        with filesystem.open_output_stream(target) as out:
            out.write(buffer.getvalue())
        return pd.DataFrame({"entries": [len(pdf)]})

    done = placed.groupBy("archive").applyInPandas(write, "entries long")
    return done.agg(F.sum("entries")).first()[0] or 0
