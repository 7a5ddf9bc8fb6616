import hashlib
import zlib

import pytest

from skyloom.llm.media import _payloads, frames, media_columns, png, png_samples, read_archives, write_archives


def test_png_round_trip():
    for n in (1, 3, 50):
        samples = bytes(range(256)) * 9 * n
        samples = samples[: 576 * n]
        assert png_samples(png(samples)) == samples
    with pytest.raises(ValueError):
        png_samples(png(bytes(576))[:-20] + b"x" * 20)


def test_columns(spark, odd, tmp_path):
    folder = f"file://{tmp_path}/archives"
    write_archives(_payloads(odd), folder, archive_bytes=3000)
    rows = media_columns(read_archives(spark, folder, splitBytes=2000, batchBytes=500)).collect()
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert len(rows) == 10
    for r in rows:
        payload = frames(texts[r.doc_id])
        assert r.n_bytes == len((texts[r.doc_id] or "").encode()) and r.payload_bytes == len(payload) and len(payload) % 576 == 0
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-32:])
        assert r.media_bytes == len(png(payload)) and r.media_sha256 == hashlib.sha256(png(payload)).hexdigest()
    assert len({r.feature for r in rows if r.doc_id in (5, 6)}) == 1


def test_damaged_members_are_told_apart(spark, odd, tmp_path):
    folder = f"file://{tmp_path}/archives"
    write_archives(_payloads(odd.coalesce(1)), folder)
    archive = next((tmp_path / "archives").glob("*.zip"))
    content = bytearray(archive.read_bytes())
    at = content.index(b"IDAT") + 6
    content[at] ^= 0xFF
    archive.write_bytes(content)
    rows = read_archives(spark, folder, onError="null", waitSeconds=0.0, tries=3).collect()
    broken = [r for r in rows if r.error]
    assert len(rows) == 10 and len(broken) == 1 and broken[0].tries == 3 and broken[0].payload is None
    with pytest.raises(Exception, match="member checksum"):
        read_archives(spark, folder, waitSeconds=0.0, tries=2).collect()


def test_empty(spark, none, tmp_path):
    folder = f"file://{tmp_path}/archives"
    (tmp_path / "archives").mkdir()
    write_archives(_payloads(none), folder)
    assert media_columns(read_archives(spark, folder)).count() == 0
