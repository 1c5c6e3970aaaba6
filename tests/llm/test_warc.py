import struct

import pytest
import zstandard

from sparkgate.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(
        [(i, u, h, "x", 3) for i, u, h in rows], "page_id long, url string, html string, payload string, refers_to int"
    )


def by_hand(rows):
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        last = max((j for j, _, h in rows if (h or "") == (html or "") and j is not None), default=None)
        revisit = i is not None and i != last
        out.append((i, len(payload), warc.base32_sha1(payload), "revisit" if revisit else "response", last if revisit else None, None))
    return sorted(out, key=str)


def result(frame):
    return sorted(map(tuple, frame.collect()), key=str)


ODD = [
    (1, "http://a/ b\n", None), (2, None, ""), (3, "u", "<p>ñ 🙂</p>"), (4, "u", "<p>ñ 🙂</p>"), (4, "u", "<p>ñ 🙂</p>"),
    (None, "u", "<p>ñ 🙂</p>"), (5, "u", "a\r\n\r\nb\r\n\r\n"), (6, "u", "WARC/1.1\r\n" * 50_000), (7, "u", "x"),
]


def test_odd_pages(spark, tmp_path):
    assert result(warc.archived_pages(pages(spark, ODD), str(tmp_path / "a"))) == by_hand(ODD)
    assert warc.archived_pages(pages(spark, []), str(tmp_path / "b")).count() == 0


def test_given_pages_come_back_whole(spark, given, tmp_path):
    given_pages = given("pages")
    place = str(tmp_path / "a")
    warc.write_archives(warc.with_revisits(given_pages), place)
    found = {r.page_id: r for r in warc.read_archives(spark, place).collect()}
    for page in given_pages.collect():
        record = found.pop(page.page_id)
        assert record.problem is None and record.url == page.url
        assert record.record_type == "revisit" or bytes(record.payload) == page.html.encode()
    assert not found
    # A leading dictionary, then a frame per record: each archive opens with the skippable frame.
    files = [f for f in (tmp_path / "a").iterdir() if f.name.startswith("part-")]
    for file in files:
        magic, size = struct.unpack("<II", file.read_bytes()[:8])
        assert magic == warc.DICTIONARY_MAGIC and size > 0


def test_small_payloads_need_not_be_revisits(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    found = warc.archived_pages(pages(spark, rows), str(tmp_path / "a"), least_bytes=3)
    assert {r.page_id: r.refers_to for r in found.collect()} == {1: None, 2: None, 3: 4, 4: None}


def archive(tamper=lambda record: record, dictionary=b""):
    compressor = zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    )
    frames = [compressor.compress(tamper(warc.record(n, "u", b"payload %d" % n, None))) for n in range(3)]
    return warc.skippable(warc.DICTIONARY_MAGIC, dictionary) + b"".join(frames)


def test_dictionaries_plain_and_compressed():
    content = warc.trained([b"<html><body><p>words of page %d</p></body></html>" % n * 20 for n in range(200)])
    assert content
    plain = archive(dictionary=content)
    packed = zstandard.ZstdCompressor().compress(content)
    frames = plain[8 + len(content):]
    for data in (plain, warc.skippable(warc.DICTIONARY_MAGIC, packed) + frames):
        assert [warc.parsed(r)[0] for r in warc.records_of(data)] == [0, 1, 2]
    with pytest.raises(zstandard.ZstdError):
        list(warc.records_of(warc.skippable(warc.DICTIONARY_MAGIC, b"") + frames))


@pytest.mark.parametrize(
    "tamper, problem",
    [
        (lambda r: r.replace(b"Content-Length: ", b"Content-Length: 9", 1), "its length is wrong"),
        (lambda r: r.replace(b"payload", b"pAyload"), "its block digest is wrong"),
        (lambda r: r.replace(b"WARC/1.1", b"WURC/1.1"), "no WARC version line"),
        (lambda r: r.replace(b"WARC-Date", b"X-Date"), "a mandatory field is missing"),
        (lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: odd"), "unknown record type"),
    ],
)
def test_damage_is_told(tamper, problem):
    assert [warc.parsed(r)[-1] for r in warc.records_of(archive(tamper))] == [problem] * 3


def test_archives_cut_short(spark, tmp_path):
    whole = archive()
    (tmp_path / "x.warc.zst").write_bytes(whole[:-4])
    (tmp_path / "y.warc.zst").write_bytes(b"not an archive")
    (tmp_path / "z.warc.zst").write_bytes(b"")
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.page_id for r in rows if r.problem is None) == [0, 1]
    assert len([r for r in rows if r.problem is not None]) == 2
