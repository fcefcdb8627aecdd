from __future__ import annotations

import pytest

from lakegate.sources import files


@pytest.mark.parametrize("name", ["plain.csv", "day 1/trips part.csv", "50%25 off+more é.csv"])
def test_manifest_counts_rows_for_any_path(spark, tmp_path, name):
    source = tmp_path / "raw" / name
    source.parent.mkdir(parents=True, exist_ok=True)
    source.write_text("a,b\n1,2\n3,4\n")
    feed = spark.read.option("header", True).schema("a string, b string").csv(str(source.parent))
    row = files.file_manifest(
        spark, {"trips": feed}, {"trips": [str(source.parent)]}, str(tmp_path / "raw")
    ).collect()
    assert [(r["source_file"], r["row_count"], r["file_bytes"]) for r in row] == [(name, 2, 12)]


def _hashes(spark, folder, **options):
    rows = files.file_hashes(spark, [str(folder)], **options).collect()
    return {r["path"].rsplit("/", 1)[1]: (r["file_bytes"], r["file_sha256"]) for r in rows}


LINES = "".join(f"{i},some text é,{i * 37 % 101}\n" for i in range(4000)).encode()


def test_hash_does_not_depend_on_blocks(spark, tmp_path):
    folder = tmp_path / "50%25 a b+c"
    folder.mkdir()
    (folder / "feed.csv").write_bytes(LINES)
    (folder / "binary.bin").write_bytes(bytes(range(256)) * 50 + b"\xff\n\r\n\x00")
    whole = _hashes(spark, folder)
    assert {name: n for name, (n, _) in whole.items()} == {"feed.csv": len(LINES), "binary.bin": 12805}
    for size, send in ((5000, 1 << 20), (777, 0)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        try:
            assert spark.read.text(str(folder)).rdd.getNumPartitions() > 5
            assert _hashes(spark, folder, send_bytes=send) == whole
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_every_byte_and_its_place_count(spark, tmp_path):
    first, second = LINES.split(b"\n")[:2]
    changed = {
        "same": LINES,
        "one byte": LINES.replace(b"2000,", b"2001,", 1),
        "swapped": second + b"\n" + first + LINES[len(first) + len(second) + 1 :],
        "doubled": first + b"\n" + LINES,
        "no end": LINES[:-1],
        "windows": LINES.replace(b"\n", b"\r\n", 1),
        "nul": LINES + b"\x00",
        "cut": LINES[:-40],
    }
    for name, data in changed.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "copy").write_bytes(LINES)
    found = _hashes(spark, tmp_path)
    assert found["same"] == found["copy"]
    assert len({digest for _, digest in found.values()}) == len(changed)


def test_manifest_of_many_files(spark, tmp_path):
    raw = tmp_path / "raw"
    for name, rows in (("a 1.csv", 2), ("b%20.csv", 0), ("c/d.csv", 3)):
        path = raw / ("trips" if "/" not in name else "pay") / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x,y\n" + "1,2\n" * rows)
    feeds, paths = {}, {"trips": [str(raw / "trips")], "pay": [str(raw / "pay" / "c")]}
    for name, places in paths.items():
        feeds[name] = spark.read.option("header", True).schema("x string, y string").csv(places)
    rows = files.file_manifest(spark, feeds, paths, str(raw)).collect()
    assert {(r["dataset_name"], r["source_file"], r["row_count"], r["file_bytes"]) for r in rows} == {
        ("trips", "trips/a 1.csv", 2, 12), ("trips", "trips/b%20.csv", 0, 4), ("pay", "pay/c/d.csv", 3, 16),
    }
