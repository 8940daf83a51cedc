import os
import zipfile

import pytest
from pyspark.sql import functions as F

from reqsift.operators.parse import parse_requests
from reqsift.plans import ingest
from reqsift.sources import archives

POST = "POST /{i} HTTP/1.1\nHost: h{i}\nk[[:]]v"


def make_zip(path, entries):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in entries.items():
            z.writestr(name, body)


@pytest.fixture
def root(tmp_path):
    base = tmp_path / "full.text"
    make_zip(str(base / "20240101" / "a.zip"), {"1.txt": POST.format(i=1), "2.html": POST.format(i=2), "x.bin": "no"})
    make_zip(str(base / "20240102" / "deep" / "er" / "b.zip"), {"3.txt": POST.format(i=3), "4.txt": ""})
    make_zip(str(base / "20240103" / "c.zip"), {f"{i}.txt": POST.format(i=i) for i in range(5, 205)})
    (base / "20240101" / "notes.txt").write_text("not an archive")
    make_zip(str(base / "tmp" / "d.zip"), {"9.txt": POST.format(i=9)})
    (base / "20240104").mkdir()
    return str(base)


def entries(df):
    return sorted((r.path.rsplit("/", 1)[1], r.entry, r.text) for r in df.collect())


def test_listing_by_suffix_at_any_depth(spark, root):
    names = {r.path.rsplit("/", 1)[1] for r in archives.list_files(spark, root).select("path").collect()}
    assert names == {"a.zip", "b.zip", "c.zip", "d.zip"}


def test_listing_does_not_read_contents(spark, root):
    plan = archives.list_files(spark, root).select("path", "length")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_scan_days(spark, root):
    assert archives.new_days(spark, root) == [20240101, 20240102, 20240103, 20240104]
    after = archives.scan_days(spark, root, 20240101)
    assert sorted(r.day for r in after.select("day").collect()) == [20240102, 20240103]
    assert archives.scan_days(spark, root, 20240104).collect() == []


def test_entries(spark, root):
    got = entries(archives.explode_archives(archives.list_files(spark, f"{root}/20240101")))
    assert got == [("a.zip", "1.txt", POST.format(i=1)), ("a.zip", "2.html", POST.format(i=2))]


def test_sliced_reading_gives_the_same_rows(spark, root):
    files = archives.list_files(spark, root)
    whole = archives.explode_archives(files)
    sliced = archives.explode_archives(files, whole_archive_bytes=0, slice_bytes=500)
    assert entries(sliced) == entries(whole) and len(entries(whole)) == 205


def test_sliced_reading_of_odd_file_names(spark, tmp_path):
    make_zip(str(tmp_path / "sp ace" / "100%25 请?.zip"), {"1.txt": "a"})
    files = archives.list_files(spark, str(tmp_path))
    assert [r.text for r in archives.explode_archives(files, whole_archive_bytes=0).collect()] == ["a"]


def test_a_large_archive_is_spread_over_tasks(spark, root):
    files = archives.list_files(spark, f"{root}/20240103")
    sliced = archives.explode_archives(files, whole_archive_bytes=0, slice_bytes=500)
    tasks = sliced.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 4


@pytest.mark.parametrize("whole", [0, 1 << 20])
def test_unreadable_archives_and_entries_are_counted_not_lost(spark, tmp_path, whole):
    make_zip(str(tmp_path / "ok.zip"), {"1.txt": POST.format(i=1), "2.txt": POST.format(i=2)})
    (tmp_path / "broken.zip").write_bytes(b"this is no zip")
    raw = (tmp_path / "ok.zip").read_bytes()
    at = raw.index(b"2.txt") + len("2.txt")
    (tmp_path / "flipped.zip").write_bytes(raw[:at] + b"\xff\xff\xff" + raw[at + 3 :])
    df = archives.explode_archives(archives.list_files(spark, str(tmp_path)), whole_archive_bytes=whole)
    got = entries(df)
    assert ("broken.zip", None, None) in got and ("flipped.zip", "2.txt", None) in got and len(got) == 5
    assert parse_requests(df).count() == 3


def test_entry_names_in_gbk_and_charset_option(spark, tmp_path):
    path = str(tmp_path / "n.zip")
    name = "请求.txt"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("AAAA.txt", "naïve".encode("latin-1"))
    raw = open(path, "rb").read().replace(b"AAAA", name[:2].encode("gbk"))
    open(path, "wb").write(raw)
    files = archives.list_files(spark, path)
    assert entries(archives.explode_archives(files, charset="latin-1")) == [("n.zip", name, "naïve")]
    assert entries(archives.explode_archives(files)) == [("n.zip", name, "na�ve")]


def test_listing_sorted(spark, root):
    rows = archives.list_sorted(spark, root).collect()
    assert [(r.is_dir, r.name) for r in rows] == [
        (True, "20240101"), (True, "20240102"), (True, "20240103"), (True, "20240104"), (True, "tmp"),
    ]
    inner = [(r.is_dir, r.name) for r in archives.list_sorted(spark, f"{root}/20240101").collect()]
    assert inner == [(False, "a.zip"), (False, "notes.txt")]


def test_a_store_that_only_spark_reads_is_refused_at_once(spark, root):
    files = archives.list_files(spark, root)
    odd = files.withColumn("path", F.regexp_replace("path", "^file:/+", "odd://store/"))
    with pytest.raises(ValueError, match="whole_archive_bytes"):
        archives.explode_archives(odd)
    assert archives.explode_archives(odd, whole_archive_bytes=None).count() == archives.explode_archives(files).count()


def test_day_is_that_below_the_whole_root(spark, tmp_path):
    root = f"{tmp_path}/1/data"
    make_zip(f"{root}/1/data/20240101/f.zip", {"1.txt": POST.format(i=1)})
    make_zip(f"{root}/20240102/f.zip", {"1.txt": POST.format(i=1)})
    days = archives.with_day(archives.list_files(spark, root), root).select("day").collect()
    assert sorted(r.day for r in days) == [1, 20240102]


@pytest.mark.parametrize("whole", [0, 1 << 20])
def test_an_entry_is_too_long_only_when_its_decoded_text_is(spark, tmp_path, monkeypatch, whole):
    """The bound is on UTF-8 after decoding: bytes that are replaced grow, texts of two-byte characters stay as long."""
    monkeypatch.setattr(archives, "VALUE_BYTES", 1000)
    monkeypatch.setattr(archives, "FLUSH_BYTES", 64)
    entries = {"long.txt": "x" * 1001, "fits.txt": "y" * 1000, "grows.txt": b"\xff" * 334, "grows-less.txt": b"\xff" * 333, "wide.txt": "é" * 500, "wider.txt": "é" * 501}
    make_zip(f"{tmp_path}/a.zip", entries)
    with zipfile.ZipFile(f"{tmp_path}/stored.zip", "w") as z:
        for name, body in entries.items():
            z.writestr(name, body)
    files = archives.list_files(spark, str(tmp_path))
    rows = archives.explode_archives(files, whole_archive_bytes=whole).collect()
    want = {"long.txt": None, "fits.txt": 1000, "grows.txt": None, "grows-less.txt": 999, "wide.txt": 1000, "wider.txt": None}
    for name in ("a.zip", "stored.zip"):
        assert {r.entry: r.text and len(r.text.encode()) for r in rows if r.path.endswith(name)} == want


def test_an_entry_above_the_old_bound_is_read(spark, tmp_path, monkeypatch):
    """600 MB were the most once; a tenth of the flush size stands for it, so steps, batches and rows are many."""
    monkeypatch.setattr(archives, "FLUSH_BYTES", 1 << 16)
    body = "0123456789abcdef" * (1 << 16)
    make_zip(f"{tmp_path}/a.zip", {"1.txt": body, "2.txt": body + "!"})
    rows = archives.explode_archives(archives.list_files(spark, str(tmp_path))).collect()
    assert {r.entry: r.text for r in rows} == {"1.txt": body, "2.txt": body + "!"}


class _File:
    """A file in memory that remembers the longest read."""

    def __init__(self, data):
        self.data, self.longest = data, 0

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        self.longest = max(self.longest, min(n, len(self.data) - at))
        return self.data[at : at + n]


def _listed(data, step):
    file = _File(data)
    first, last, shift = archives._directory(file)
    ranges = [(a, min(a + step, last), first, last, shift) for a in range(first, last, step)]
    found = [[e for e in archives._range_entries(file, *r)] for r in ranges]
    return found, file


@pytest.mark.parametrize("step", [1, 50, 333, 10_000, 1 << 20])
@pytest.mark.parametrize("form", ["plain", "prefixed", "commented", "marks in names", "zip64"])
def test_directory_in_ranges_gives_every_entry_once(step, form, tmp_path, monkeypatch):
    if form == "zip64":
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 10)
    path = str(tmp_path / "a.zip")
    if form == "prefixed":
        (tmp_path / "a.zip").write_bytes(b"#!/bin/sh" * 7)
    names = [f"{i}{'PK' + chr(1) + chr(2) if form == 'marks in names' else ''}{'é' if i % 3 else ''}.txt" for i in range(60)]
    with zipfile.ZipFile(path, "a", zipfile.ZIP_DEFLATED) as z:
        for i, name in enumerate(names):
            info = zipfile.ZipInfo(name)
            info.comment = b"PK\1\2" * (i % 4) if form in ("commented", "marks in names") else b""
            z.writestr(info, f"text {i}" * i)
        z.writestr("no.bin", "x")
        if form == "commented":
            z.comment = b"PK\5\6" + b"comment" * 20
    data = open(path, "rb").read()
    found, _ = _listed(data, step)
    got = [e for part in found for e in part]
    assert [e[0] for e in got] == names
    for i, (_, offset, end, size, method, crc) in enumerate(got):
        text = archives._entry_text(memoryview(data), offset, size, method, crc, "utf-8")
        assert text == (f"text {i}" * i).encode() and offset + 30 + size <= end


def test_no_task_holds_more_than_a_slice_of_a_million_entries():
    """A directory of 10^6 records, made up: ranges of the default size hold some 1 in 20 of them, and read no more."""
    import struct

    n, step = 1_000_000, archives.DIRECTORY_BYTES
    header = b"PK\3\4" + struct.pack("<HHHHHLLLHH", 20, 0, 0, 0, 0, 0, 0, 0, 11, 0) + b"0000000.txt"
    record = b"".join(b"PK\1\2" + struct.pack("<HHHHHHLLLHHHHHLL", 20, 20, 0, 0, 0, 0, 0, 0, 0, 11, 0, 0, 0, 0, 0, 0) + b"%07d.txt" % i for i in range(n))
    end = b"PK\5\6" + struct.pack("<HHHHLLH", 0, 0, 65535, 65535, len(record), len(header), 0)
    found, file = _listed(header + record + end, step)
    assert sum(map(len, found)) == n and [e[0] for part in found for e in part][::99_999] == [f"{i:07d}.txt" for i in range(0, n, 99_999)]
    assert max(map(len, found)) <= step // 57 + 1
    assert file.longest <= step + archives.LONGEST_RECORD


def test_directories_are_spread_over_tasks(spark, root):
    files = archives.list_files(spark, f"{root}/20240103")
    sliced = archives.explode_archives(files, whole_archive_bytes=0, slice_bytes=500, directory_bytes=700)
    assert entries(sliced) == entries(archives.explode_archives(files)) and len(entries(sliced)) == 200


def _rows(spark, out):
    return sorted((r.day, r.path.rsplit("/", 1)[1], r.entry, r.url) for r in ingest.read_ingested(spark, out).collect())


def test_files_added_to_a_finished_day_are_read_once(spark, root, tmp_path):
    out = str(tmp_path / "out")
    ingest.ingest_days(spark, root, out)
    before = _rows(spark, out)
    for i in range(3):
        make_zip(f"{root}/20240101/deep/late [{i}] *.zip", {"7.txt": POST.format(i=7 + i)})
    assert ingest.ingest_days(spark, root, out) == {20240101: {"records": 3, "bad_records": 0}}
    assert ingest.ingest_days(spark, root, out) == {}
    assert _rows(spark, out) == sorted(before + [(20240101, f"late [{i}] *.zip", "7.txt", f"/{7 + i}") for i in range(3)])
    ledger = ingest.read_ledger(spark, out).filter("day = 20240101").collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.run) for r in ledger) == [("a.zip", 0)] + [(f"late [{i}] *.zip", 1) for i in range(3)]


def test_many_added_files_go_in_several_runs(spark, root, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "NAMED_FILES", 2)
    out = str(tmp_path / "out")
    ingest.ingest_days(spark, root, out)
    for i in range(5):
        make_zip(f"{root}/20240102/late{i}.zip", {"7.txt": POST.format(i=i), "8.txt": ""})
    assert ingest.ingest_days(spark, root, out) == {20240102: {"records": 10, "bad_records": 5}}
    assert ingest.finished_runs(spark, out)[20240102] == [0, 1, 2, 3]
    assert len(_rows(spark, out)) == 2 + 1 + 200 + 5


def test_records_of_a_changed_file_are_replaced(spark, root, tmp_path):
    out = str(tmp_path / "out")
    ingest.ingest_days(spark, root, out)
    make_zip(f"{root}/20240101/a.zip", {"1.txt": POST.format(i=99)})
    assert ingest.ingest_days(spark, root, out) == {20240101: {"records": 1, "bad_records": 0}}
    assert [r[1:] for r in _rows(spark, out) if r[0] == 20240101] == [("a.zip", "1.txt", "/99")]
    assert [r[1:] for r in _rows(spark, out) if r[0] == 20240102] == [("b.zip", "3.txt", "/3")]


def test_a_run_without_its_ledger_did_not_happen(spark, root, tmp_path):
    import shutil

    out = str(tmp_path / "out")
    ingest.ingest_days(spark, root, out)
    before = _rows(spark, out)
    make_zip(f"{root}/20240101/late.zip", {"7.txt": POST.format(i=7)})
    ingest.ingest_days(spark, root, out)
    shutil.rmtree(f"{out}/files/day=20240101/run=1")
    assert _rows(spark, out) == before
    assert ingest.ingest_days(spark, root, out).keys() == {20240101}
    assert len(_rows(spark, out)) == len(before) + 1


def test_days_behind_the_bound_are_not_listed(spark, root, tmp_path):
    out = str(tmp_path / "out")
    assert ingest.ingest_days(spark, root, out, after_day=20240102).keys() == {20240103, 20240104}
    with pytest.raises(ValueError, match="nothing"):
        ingest.read_ingested(spark, out, after_day=20240104)


def test_ingest_resumes_after_the_last_finished_day(spark, root, tmp_path):
    out = str(tmp_path / "out")
    first = ingest.ingest_days(spark, root, out)
    assert first[20240102] == {"records": 2, "bad_records": 1}
    assert ingest.ingest_days(spark, root, out) == {}
    make_zip(f"{root}/20240105/e.zip", {"1.txt": POST.format(i=1)})
    make_zip(f"{root}/20240102/late.zip", {"1.txt": POST.format(i=1)})
    make_zip(f"{root}/007/f.zip", {"1.txt": POST.format(i=1)})
    make_zip(f"{root}/12345678901234/g.zip", {"1.txt": POST.format(i=1)})
    # A day that comes late is read, though later ones are finished, and so is a file of a finished one.
    assert ingest.ingest_days(spark, root, out).keys() == {7, 20240102, 20240105, 12345678901234}
    rows = ingest.read_ingested(spark, out, after_day=20240102)
    assert {r.day: r["count"] for r in rows.groupBy("day").count().collect()} == {20240103: 200, 20240105: 1, 12345678901234: 1}


def test_ingest_repeats_a_day_that_failed_half_way(spark, root, tmp_path):
    out = str(tmp_path / "out")
    ingest.ingest_days(spark, root, out)
    for day in (20240103, 20240104):
        os.remove(f"{out}/files/day={day}/run=0/_SUCCESS")
    assert ingest.ingest_days(spark, root, out).keys() == {20240103, 20240104}
    assert ingest.read_ingested(spark, out).count() == 2 + 1 + 200


def test_archives_as_a_stream(spark, root, tmp_path):
    def run():
        stream = archives.explode_archives(archives.stream_files(spark, root, max_files=1), whole_archive_bytes=400)
        rows = parse_requests(stream, keep=("path", "entry"), observation="stream")
        query = (
            rows.writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start(str(tmp_path / "out"))
        )
        query.awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    batch = parse_requests(archives.explode_archives(archives.list_files(spark, root)), keep=("path", "entry"))
    assert sorted(map(repr, run().collect())) == sorted(map(repr, batch.collect()))
    make_zip(f"{root}/20240105/e.zip", {"1.txt": POST.format(i=1)})
    assert run().count() == batch.count() + 1  # a restart reads only what is new
