"""Zip archives of request texts in day-named directories."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_children, qualified
from .tables import file_stream

# The functions below run in tasks; send them along instead of expecting the package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUFFIXES = (".txt", ".html")
NAME_CHARSET = "gbk"
WHOLE_ARCHIVE_BYTES = 128 << 20
SLICE_BYTES = 32 << 20
GAP_BYTES = 1 << 20
SLICE_ENTRIES = 100_000
FLUSH_BYTES = 8 << 20
#: Bytes of an archive's directory that one task reads; an entry takes some 100 of them, and at most ``LONGEST_RECORD``.
DIRECTORY_BYTES = 4 << 20
LONGEST_RECORD = 46 + 3 * 65535
#: A text of more UTF-8 bytes counts as bad: a value in Spark has less than 2 GiB.
VALUE_BYTES = (1 << 31) - 4096

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
ENTRY_SCHEMA = "path string, entry string, text string"
# A stretch of an archive's directory: where it and the whole directory begin and end, and by how much all offsets are off.
RANGE_SCHEMA = "path string, start bigint, stop bigint, first bigint, last bigint, shift bigint"
# A run of neighbouring entries: the bytes it spans, and what the archive's directory says of each entry.
SLICE_SCHEMA = (
    "path string, start bigint, stop bigint, names array<string>, offsets array<bigint>, sizes array<bigint>, "
    "methods array<int>, crcs array<bigint>"
)


def day_folders(spark: SparkSession, root: str, after_day: int | None = None) -> list[str]:
    """Names of day directories (integers, as they are written) after ``after_day``, by day; other names are skipped."""
    names = [name for name, is_dir in list_children(spark, root) if is_dir and re.fullmatch(r"\d{1,18}", name)]
    return sorted((n for n in names if after_day is None or int(n) > after_day), key=lambda n: (int(n), n))


def new_days(spark: SparkSession, root: str, after_day: int | None = None) -> list[int]:
    """The days of ``day_folders``, each once."""
    return sorted({int(n) for n in day_folders(spark, root, after_day)})


def list_files(spark: SparkSession, paths: str | list[str], glob: str = "*.zip") -> DataFrame:
    """All files under ``paths`` that match ``glob``, at any depth, as binary-file rows.

    ``content`` is read only if a query uses it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths)


def stream_files(spark: SparkSession, root: str, glob: str = "*.zip", max_files: int | None = None) -> DataFrame:
    """The archives under ``root`` as a stream, also late ones with an old time stamp; the checkpoint of the query
    remembers those done."""
    reader = file_stream(spark, max_files).format("binaryFile").schema(FILE_SCHEMA)
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)


def scan_days(spark: SparkSession, root: str, after_day: int | None = None, glob: str = "*.zip") -> DataFrame:
    """Files of the days after ``after_day``, with ``day``; older days are not even listed."""
    paths = [f"{root}/{name}" for name in day_folders(spark, root, after_day)]
    files = list_files(spark, paths, glob) if paths else spark.createDataFrame([], FILE_SCHEMA)
    return with_day(files, root)


def with_day(files: DataFrame, root: str) -> DataFrame:
    """Add ``day``, the integer directory right below ``root`` (null elsewhere)."""
    # Spark reports local files as file:/ or file:///; both ways of writing are cut off.
    bare = lambda path: re.sub(r"^file:/+", "/", path)
    root = re.escape(bare(qualified(files.sparkSession, root)))
    day = F.regexp_extract(F.regexp_replace("path", "^file:/+", "/"), rf"^{root}/(\d+)/", 1)
    return files.withColumn("day", F.when(day != "", day.try_cast("bigint")))


def list_sorted(spark: SparkSession, folder: str) -> DataFrame:
    """``is_dir, name`` of all that lies directly in ``folder``, empty directories too: directories first, then by name.

    One listing of that folder alone, for folders whose names fit the driver.
    """
    rows = [(is_dir, name) for name, is_dir in list_children(spark, folder)]
    return spark.createDataFrame(rows, "is_dir boolean, name string").orderBy(F.desc("is_dir"), "name")


def explode_archives(
    files: DataFrame,
    charset: str = "utf-8",
    whole_archive_bytes: int | None = WHOLE_ARCHIVE_BYTES,
    slice_bytes: int = SLICE_BYTES,
    directory_bytes: int = DIRECTORY_BYTES,
) -> DataFrame:
    """``path, entry, text``: one row per ``.txt`` or ``.html`` entry of the archives in ``files``.

    Archives up to ``whole_archive_bytes`` are read as file contents, many to a task. Of larger ones, first the directories
    and then the entries are cut into slices that are spread over the cluster, so that no task reads or holds more of
    one huge archive than a slice; only the bytes of the entries are read. Tasks open those by ``pyarrow.fs``; a batch job on a store
    that it can't open is refused at once rather than when a large archive comes. With None all archives are read as
    file contents, by Spark alone. An unreadable archive gives one row with
    null entry and text, an unreadable entry a row with null text: the parser counts and drops them.
    """
    if whole_archive_bytes is not None and not files.isStreaming:
        _check_store(files)
    limit = (1 << 62) if whole_archive_bytes is None else whole_archive_bytes
    small = (
        files.filter(F.col("length") <= limit)
        .select("path", "content")
        .mapInArrow(_explode_contents(charset), ENTRY_SCHEMA)
    )
    parts = max(
        int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        files.sparkSession.sparkContext.defaultParallelism,
    )
    large = (
        files.filter(F.col("length") > limit)
        .select("path")
        .mapInArrow(_plan_ranges(directory_bytes), RANGE_SCHEMA)
        # An explicit number: adaptive execution would merge these small rows into few tasks.
        .repartition(parts, "path", "start")
        .mapInArrow(_plan_slices(slice_bytes), SLICE_SCHEMA)
        .repartition(parts, "path", "start")
        .mapInArrow(_read_slices(charset), ENTRY_SCHEMA)
    )
    return small.unionByName(large)


_ENTRY_ARROW = pa.schema([("path", pa.string()), ("entry", pa.string()), ("text", pa.string())])
_RANGE_ARROW = pa.schema([("path", pa.string()), *((n, pa.int64()) for n in ("start", "stop", "first", "last", "shift"))])
_SLICE_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("start", pa.int64()),
        ("stop", pa.int64()),
        ("names", pa.list_(pa.string())),
        ("offsets", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("methods", pa.list_(pa.int32())),
        ("crcs", pa.list_(pa.int64())),
    ]
)


def _batches(rows: Iterator[tuple], schema: pa.Schema, flush_bytes: int = FLUSH_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows in record batches of bounded size; a very large row has one of its own."""

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    columns: list[list] = [[] for _ in schema]
    size = 0
    for row in rows:
        more = sum(8 if v is None or isinstance(v, int) else len(v) * (8 if isinstance(v, list) else 1) for v in row)
        if size and size + more > flush_bytes:
            yield batch()
            columns, size = [[] for _ in schema], 0
        for column, value in zip(columns, row):
            column.append(value)
        size += more
    if columns[0]:
        yield batch()


def _text_entries(file) -> list | None:
    """``(name, offset, end, size, method, crc)`` of the text entries in file order; None for no archive.

    Only the directory at the end of the archive is read. Failing reads raise, so that the task is retried.
    """
    import zipfile

    try:
        archive = zipfile.ZipFile(file, metadata_encoding=NAME_CHARSET)
    except (zipfile.BadZipFile, pa.ArrowInvalid):  # the latter: shorter than an archive can be
        return None
    with archive:
        infos = sorted(archive.infolist(), key=lambda i: i.header_offset)
        ends = [i.header_offset for i in infos[1:]] + [archive.start_dir]
        return [
            (i.filename, i.header_offset, end, i.compress_size, -1 if i.flag_bits & 1 else i.compress_type, i.CRC)
            for i, end in zip(infos, ends)
            if i.filename.endswith(SUFFIXES)
        ]


def _inflated(raw: memoryview) -> Iterator[bytes]:
    """The bytes of a deflated entry, a few at a time; short if it is cut off."""
    import zlib

    inflate = zlib.decompressobj(-15)
    while not inflate.eof and (part := inflate.decompress(raw, FLUSH_BYTES)):
        yield part
        raw = inflate.unconsumed_tail


def _entry_text(data: memoryview, at: int, size: int, method: int, crc: int, charset: str) -> bytes | None:
    """The text, in UTF-8, of the entry whose header is at ``at``; None if it is damaged, encrypted, packed otherwise, or
    too long for a value. It is decoded step by step, so a hostile entry is given up as soon as it is too long."""
    import codecs
    import struct
    import zlib

    decode = codecs.getincrementaldecoder(charset)("replace").decode
    parts, length, seen = [], 0, 0
    try:
        name_length, extra_length = struct.unpack_from("<HH", data, at + 26)
        at += 30 + name_length + extra_length
        raw = data[at : at + size]
        if method == 8:
            steps = _inflated(raw)
        elif method == 0:
            steps = (raw[i : i + FLUSH_BYTES] for i in range(0, len(raw), FLUSH_BYTES))
        else:
            return None
        for step in steps:
            seen = zlib.crc32(step, seen)
            parts.append(decode(step).encode())
            length += len(parts[-1])
            if length > VALUE_BYTES:
                return None
    except (struct.error, zlib.error):
        return None
    parts.append(decode(b"", True).encode())
    return b"".join(parts) if seen == crc and length + len(parts[-1]) <= VALUE_BYTES else None


# --- directories of large archives ------------------------------------------------------------------

# Fixed values of the zip format: the marks of its records.
END, END_64, LOCATOR_64, RECORD, HEADER = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"


def _directory(file) -> tuple[int, int, int] | None:
    """``(first, last, shift)`` of an archive's directory in the file and how far its offsets are off; None for no archive."""
    import struct

    size = file.size()
    tail_at = max(size - 22 - 65535, 0)
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(END)
    # The comment that follows has the length the record says; its text may hold the mark itself.
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        return None
    length, offset = struct.unpack_from("<LL", tail, at + 12)
    end = tail_at + at
    if end >= 20:
        locator = file.read_at(20, end - 20)
        if locator[:4] == LOCATOR_64:
            end = end - 20 - 56
            record = file.read_at(56, end) if end >= 0 else b""
            if record[:4] != END_64:  # longer than it has to be: go where the locator points
                end = struct.unpack_from("<Q", locator, 8)[0]
                record = file.read_at(56, end) if end + 56 <= size else b""
            if record[:4] != END_64:
                return None
            length, offset = struct.unpack_from("<QQ", record, 40)
    first = end - length
    return (first, end, first - offset) if first >= 0 and first >= offset else None


def _record(data: bytes, at: int) -> tuple | None:
    """``(name, offset, size, method, crc, end of the record)`` of the directory record at ``at``; None if there is none."""
    import struct

    if data[at : at + 4] != RECORD or at + 46 > len(data):
        return None
    flags, method, _, crc, size, full, names, extras, comments = struct.unpack_from("<HHLLLLHHH", data, at + 8)
    offset = struct.unpack_from("<L", data, at + 42)[0]
    extra_at, stop = at + 46 + names, at + 46 + names + extras + comments
    if stop > len(data):
        return None
    name = data[at + 46 : extra_at].split(b"\0")[0].decode("utf-8" if flags & 0x800 else NAME_CHARSET, "replace")
    extra = data[extra_at : extra_at + extras]
    while len(extra) >= 4:
        kind, length = struct.unpack_from("<HH", extra)
        if kind == 1:  # the values that need 64 bits, in this order
            body = extra[4 : 4 + length]
            wide = list(struct.unpack(f"<{len(body) // 8}Q", body[: len(body) // 8 * 8]))
            if full == 0xFFFFFFFF and wide:
                wide.pop(0)
            if size == 0xFFFFFFFF and wide:
                size = wide.pop(0)
            if offset == 0xFFFFFFFF and wide:
                offset = wide.pop(0)
        extra = extra[4 + length :]
    return name, offset, size, -1 if flags & 1 else method, crc, stop


def _first_record(file, data: bytes, shift: int) -> int:
    """Where the first record begins in a stretch of a directory that may begin inside one; -1 if none does.

    Names and comments may hold the mark of a record, so what is found must also agree with the header it points to.
    """
    at = data.find(RECORD)
    while at >= 0:
        if found := _record(data, at):
            header = file.read_at(30, found[1] + shift) if 0 <= found[1] + shift <= file.size() - 30 else b""
            if header[:4] == HEADER and header[14:18] in (data[at + 16 : at + 20], b"\0\0\0\0") and header[26:28] == data[at + 28 : at + 30]:
                return at
        at = data.find(RECORD, at + 1)
    return -1


def _range_entries(file, start: int, stop: int, first: int, last: int, shift: int) -> Iterator[tuple]:
    """``(name, offset, end, size, method, crc)`` of the text entries whose records begin from ``start`` up to ``stop``.

    ``end`` is as far as the entry can reach: its header in the file may be longer than the record says, but not by more
    than 64 KiB, and it ends before the directory.
    """
    data = file.read_at(min(stop + LONGEST_RECORD, last) - start, start)
    at = 0 if start == first else _first_record(file, data, shift)
    while 0 <= at < stop - start and (found := _record(data, at)):
        name, offset, size, method, crc, after = found
        if name.endswith(SUFFIXES):
            yield name, offset + shift, min(offset + shift + 30 + 2 * 65535 + size, first), size, method, crc
        at = after


def _open_uri(path: str):
    """Open a path as Spark reports it, with its scheme but not percent-encoded."""
    from urllib.parse import quote

    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(quote(path, safe="/:@"))
    return filesystem.open_input_file(inner)


def _check_store(files: DataFrame) -> None:
    """Raise if the store of these files can be read by Spark only."""
    from urllib.parse import quote

    from pyarrow import fs

    first = files.select("path").first()
    if first:
        try:
            fs.FileSystem.from_uri(quote(first["path"], safe="/:@"))
        except (pa.ArrowException, OSError) as error:
            raise ValueError("large archives can't be read here in slices; pass whole_archive_bytes=None") from error


def _explode_contents(charset: str):
    def rows(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                buffer = content.as_buffer()
                entries = _text_entries(pa.BufferReader(buffer))
                if entries is None:
                    yield path, None, None
                    continue
                data = memoryview(buffer)
                for name, offset, _, size, method, crc in entries:
                    yield path, name, _entry_text(data, offset, size, method, crc, charset)

    return lambda batches: _batches(rows(batches), _ENTRY_ARROW)


def _plan_ranges(directory_bytes: int):
    """The directory of each archive, cut into stretches of ``directory_bytes``; only the end of the file is read."""

    def rows(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with _open_uri(path) as file:
                    found = _directory(file)
                if found is None:
                    yield (path,) + (None,) * 5
                    continue
                first, last, shift = found
                for start in range(first, last, directory_bytes):
                    yield path, start, min(start + directory_bytes, last), first, last, shift

    return lambda batches: _batches(rows(batches), _RANGE_ARROW)


def _plan_slices(slice_bytes: int):
    """The text entries of each stretch of a directory, in runs of neighbours that span about ``slice_bytes``."""

    def slice_row(path, run):
        names, offsets, ends, sizes, methods, crcs = map(list, zip(*run))
        return path, offsets[0], max(ends), names, offsets, sizes, methods, crcs

    def rows(batches):
        for batch in batches:
            for r in batch.to_pylist():
                path = r.pop("path")
                if r["start"] is None:
                    yield (path,) + (None,) * 7
                    continue
                with _open_uri(path) as file:
                    entries = sorted(_range_entries(file, **r), key=lambda e: e[1])
                run = []
                for entry in entries:
                    if run and (
                        entry[2] - run[0][1] > slice_bytes
                        or entry[1] - run[-1][2] > GAP_BYTES
                        or len(run) >= SLICE_ENTRIES
                    ):
                        yield slice_row(path, run)
                        run = []
                    run.append(entry)
                if run:
                    yield slice_row(path, run)

    return lambda batches: _batches(rows(batches), _SLICE_ARROW)


def _read_slices(charset: str):
    def rows(batches):
        for batch in batches:
            for s in batch.to_pylist():
                if s["start"] is None:
                    yield s["path"], None, None
                    continue
                with _open_uri(s["path"]) as file:
                    data = memoryview(file.read_at(s["stop"] - s["start"], s["start"]))
                for name, offset, size, method, crc in zip(
                    s["names"], s["offsets"], s["sizes"], s["methods"], s["crcs"]
                ):
                    yield s["path"], name, _entry_text(data, offset - s["start"], size, method, crc, charset)

    return lambda batches: _batches(rows(batches), _ENTRY_ARROW)
