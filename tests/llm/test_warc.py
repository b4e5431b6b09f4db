import hashlib
import zlib

from filmgraph import session
from filmgraph.llm import warc as W


def records(n=6):
    return [W.page_record(i, f"http://a.com/{i}", f"payload {i} ".encode() * 40, None)
            for i in range(n)]


def ids(result):
    return [r.fields["warc-record-id"] for r in result.records]


def urn(*numbers):
    return [f"<urn:page:{i}>" for i in numbers]


def test_sound_files_have_no_gap():
    plain = b"".join(records())
    packed = b"".join(W.gzip_member(r) + W.EMPTY_MEMBER.encode("latin-1") for r in records())
    for data in (plain, packed):
        got = W.salvage(data)
        assert ids(got) == urn(*range(6)) and not got.gaps
        assert got.records[2].payload() == b"payload 2 " * 40
    assert W.salvage(b"") == W.Salvage()


def test_damaged_member_is_skipped_and_logged():
    members = [W.gzip_member(r) for r in records()]
    starts = [sum(map(len, members[:i])) for i in range(7)]
    data = bytearray(b"".join(members))
    for at in range(starts[2] + 30, starts[2] + 60):
        data[at] ^= 0xFF
    got = W.salvage(bytes(data))
    assert ids(got) == urn(0, 1, 3, 4, 5)
    assert [g[:2] for g in got.gaps] == [(starts[2], starts[3])]


def test_truncated_start_and_end_and_garbage_between_members():
    members = [W.gzip_member(r) for r in records()]
    data = members[0][20:] + members[1] + b"garbage" + members[2] + members[3][:-9]
    got = W.salvage(data)
    assert ids(got) == urn(1, 2)
    a, b = len(members[0]) - 20, len(members[1])
    assert [g[:2] for g in got.gaps] == [(0, a), (a + b, a + b + 7),
                                         (a + b + 7 + len(members[2]), len(data))]


def test_wrong_length_and_digest_in_plain_records():
    parts = records()
    parts[1] = parts[1].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    parts[3] = parts[3].replace(b"payload 3", b"payload X", 1)
    starts = [sum(map(len, parts[:i])) for i in range(7)]
    got = W.salvage(b"".join(parts))
    assert ids(got) == urn(0, 2, 4, 5)
    assert [g[:2] for g in got.gaps] == [(starts[1], starts[2]), (starts[3], starts[4])]
    assert "digest" in got.gaps[1][2]


def test_bad_record_inside_a_sound_member():
    bad = records(1)[0].replace(b"payload 0", b"payload X", 1)
    data = W.gzip_member(records(2)[0]) + W.gzip_member(bad) + W.gzip_member(records(2)[1])
    got = W.salvage(data)
    assert ids(got) == urn(0, 1) and len(got.gaps) == 1


def test_payload_that_looks_like_a_record_stays_payload():
    inner = records(1)[0]
    outer = W.page_record(9, "http://b.com/", b"x\n" + inner, None)
    got = W.salvage(outer + records(1)[0])
    assert ids(got) == urn(9, 0) and got.records[0].payload() == b"x\n" + inner


def test_line_breaks_in_a_url_do_not_end_the_field():
    got = W.salvage(W.page_record(1, "http://a\r\nContent-Length: 3", b"x", None))
    assert len(got.records) == 1 and not got.gaps


def test_every_single_byte_error_loses_at_most_its_own_record():
    members = [W.gzip_member(r) for r in records(3)]
    data = b"".join(members)
    for at in range(len(members[0]), len(members[0]) + len(members[1]), 7):
        hurt = bytearray(data)
        hurt[at] ^= 0x55
        got = ids(W.salvage(bytes(hurt)))
        assert urn(0)[0] in got and urn(2)[0] in got


def test_gzip_body_behind_a_damaged_first_version_line(llm):
    parts = [W.page_record(i, "http://a.com/", W.gzip_member(b"<html>body</html>" * 50), None)
             for i in range(4)]
    got = W.salvage(b"X" + b"".join(parts)[1:])
    assert ids(got) == urn(1, 2, 3)
    assert got.gaps[0][0] == 0 and got.gaps[-1][1] == len(parts[0])
    assert all(a[1] == b[0] for a, b in zip(got.gaps, got.gaps[1:], strict=False))


def test_plain_records_behind_sound_and_damaged_members():
    plain, packed = records(), [W.gzip_member(r) for r in records()]
    got = W.salvage(packed[0] + plain[1] + packed[2] + plain[3])
    assert ids(got) == urn(0, 1, 2, 3) and not got.gaps
    hurt = bytearray(packed[0])
    hurt[40] ^= 0xFF
    got = W.salvage(bytes(hurt) + plain[1] + plain[2] + packed[3])
    assert ids(got) == urn(1, 2, 3) and [g[:2] for g in got.gaps] == [(0, len(hurt))]


def test_records_before_the_error_in_a_member_of_many_are_kept():
    parts = [W.page_record(i, f"http://a.com/{i}", hashlib.sha512(b"%d" % i).hexdigest().encode()
                           * 9, None) for i in range(60)]
    for level in (0, 6):                    # stored bytes show the records in the raw data as well
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        data = bytearray(z.compress(b"".join(parts)) + z.flush())
        size = len(data)
        data[-200] ^= 0xFF
        got = W.salvage(bytes(data) + W.gzip_member(records(1)[0]))
        found = ids(got)
        assert found[:50] == urn(*range(50)) and found[-1] == urn(0)[0]
        assert len(set(found)) == len(found) - 1 and got.gaps[0][0] == 0
        assert got.gaps[-1][1] == size


def test_round_trip_with_ties_nulls_and_clashing_columns(llm):
    rows = [(1, "u", "same", 0), (5, "u", "same", 0), (5, "v", "same", 0), (3, None, None, 0),
            (4, "u", "", 0), (None, "u", "same", 0), (None, "n", "only null ids", 0),
            (8, "é", "ünï \r\n\r\n WARC/1.1\r\n" * 50_000, 0)]
    df = llm.createDataFrame(rows, "page_id long, url string, html string, payload int")
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"],
                   r["refers_to"]) for r in W.round_trip(df.repartition(3)).collect()), key=repr)
    largest = {"same": 5, "": 4, "only null ids": None}
    want = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        other = largest.get(html or "")
        other = None if other == page else other
        want.append((page, len(data), W.base32_sha1(data), "revisit" if other else "response",
                     other))
    assert got == sorted(want, key=repr)
    assert W.round_trip(df.limit(0)).count() == 0


def test_files_are_plain_concatenated_gzip(llm):
    df = llm.createDataFrame([(i, "u", f"text {i}") for i in range(20)],
                             "page_id long, url string, html string")
    path = session.new_scratch(llm, "warc-test")
    W.write(df.coalesce(1), path)
    data = llm.read.format("binaryFile").load(path).first()["content"]
    text, rest = b"", bytes(data)
    while rest:
        z = zlib.decompressobj(31)
        text += z.decompress(rest)
        rest = z.unused_data
    assert text.count(b"WARC/1.1\r\n") == 20
    sound = W.read(llm, path, with_payload=True).collect()
    assert {bytes(r["payload"]) for r in sound} == {f"text {i}".encode() for i in range(20)}
    assert all(hashlib.sha1(bytes(r["payload"])).digest() for r in sound)
    assert W.gaps(llm, path).count() == 0


def test_gap_log_of_a_damaged_archive(llm):
    members = [W.gzip_member(r) for r in records(4)]
    data = bytearray(b"".join(members))
    data[len(members[0]) + 40] ^= 0xFF
    path = session.new_scratch(llm, "warc-damaged")
    (llm.createDataFrame([(bytearray(data),)], "v binary").selectExpr("CAST(v AS string) value")
     .write.option("encoding", "ISO-8859-1").option("lineSep", W.EMPTY_MEMBER).text(path))
    gap = W.gaps(llm, path).collect()
    assert [(g["start"], g["end"]) for g in gap] == [
        (len(members[0]), len(members[0]) + len(members[1]))]
    assert W.read(llm, path).count() == 3


def many(n=2000):
    return [W.page_record(i, f"http://a.com/{i}", hashlib.sha512(b"%d" % i).hexdigest().encode(),
                          None) for i in range(n)]


def test_records_of_a_member_that_the_end_cuts_off_are_kept():
    data = W.gzip_member(b"".join(many()))
    # without its length, without part of the checksum, without the end of the stream, without half
    for cut, least, sure in ((4, 2000, True), (5, 2000, False), (9, 1999, False),
                             (len(data) // 2, 900, False)):
        got = W.salvage(data[:-cut])
        n = len(got.records)
        assert least <= n and ids(got) == urn(*range(n))
        assert {r.verified for r in got.records} == {sure}
        assert [g[:2] for g in got.gaps] == [(0, len(data) - cut)]
        assert got.gaps[0][2] == W.CUT
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)           # its records show in the raw data too
    data = stored.compress(b"".join(many(50))) + stored.flush()
    found = ids(W.salvage(data[:-200]))
    assert len(found) == len(set(found)) >= 48


def test_records_under_a_wrong_checksum_are_kept_and_marked():
    data = bytearray(W.gzip_member(b"".join(many())))
    data[-6] ^= 0xFF                                          # in the checksum
    got = W.salvage(bytes(data) + W.gzip_member(many(1)[0]))
    assert ids(got) == urn(*range(2000), 0)
    assert [r.verified for r in got.records] == [False] * 2000 + [True]
    assert [g[2] for g in got.gaps] == [W.CHECKSUM] and got.gaps[0][1] == len(data)
    assert got.gaps[0][0] >= len(data) - 8
    data[-6] ^= 0xFF
    data[-1] ^= 0xFF                                          # in the length
    got = W.salvage(b"garbage" + bytes(data))
    assert ids(got) == urn(*range(2000))
    assert [g[:2] for g in got.gaps] == [(0, 7), (len(data) + 6, len(data) + 7)]


def test_every_byte_value_survives_the_text_writer(llm):
    payload = bytes(range(256)) * 5
    path = session.new_scratch(llm, "warc-bytes")
    (llm.createDataFrame([(bytearray(payload),), (bytearray(b"\xff\xfe"),)], "v binary").coalesce(1)
     .selectExpr("CAST(v AS string) value").write.option("encoding", "ISO-8859-1")
     .option("lineSep", W.EMPTY_MEMBER).text(path))
    data = bytes(llm.read.format("binaryFile").load(path).first()["content"])
    assert data == b"".join(x + W.EMPTY_MEMBER.encode("latin-1") for x in (payload, b"\xff\xfe"))


def test_header_marks_reach_the_table(llm):
    path = session.new_scratch(llm, "warc-cut")
    data = W.gzip_member(b"".join(many(30)))[:-7]
    (llm.createDataFrame([(bytearray(data),)], "v binary").selectExpr("CAST(v AS string) value")
     .write.option("encoding", "ISO-8859-1").option("lineSep", "\n").text(path))
    rows = W.read(llm, path).collect()
    assert len(rows) == 30 and not any(r["header_verified"] for r in rows)


def test_cut_members_with_optional_header_fields():
    body = b"".join(many(40))
    raw = zlib.compressobj(6, zlib.DEFLATED, -15)
    deflated = raw.compress(body) + raw.flush()
    crc = zlib.crc32(body).to_bytes(4, "little")
    for flags, extra in ((8, b"name\0"), (16, b"note\0"), (4, b"\x03\0abc"), (2, b"xx"),
                         (28, b"\x01\0an\0c\0")):
        head = b"\x1f\x8b\x08" + bytes([flags]) + bytes(5) + b"\x03" + extra
        if flags == 2:
            head = head[:-2] + (zlib.crc32(head[:-2]) & 0xFFFF).to_bytes(2, "little")
        got = W.salvage(head + deflated + crc)
        assert len(got.records) == 40 and all(r.verified for r in got.records)
    for n in range(12):
        assert W.salvage(W.gzip_member(body)[:n]).records == []
