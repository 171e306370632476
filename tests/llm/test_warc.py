from __future__ import annotations

import base64
import hashlib
import io
import random
from collections import Counter

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from saldus.llm import scratch, warc

SCHEMA = "page_id long, url string, html string, payload_digest string, refers_to int"


def pages():
    rng = random.Random(3)
    body = lambda n: "<html><body>" + " ".join(f"w{rng.randint(0, 999)}" for _ in range(n)) + "</body></html>"
    same, short = body(80), "ab"
    rows = [(i, f"https://h{i % 9}.org/{i}", body(rng.randint(0, 400))) for i in range(300)]
    rows += [(400 + i, None, same) for i in range(60)] + [(500 + i, "u", short) for i in range(4)] + [(600, "u\r\nWARC-Type: x", None), (601, "", ""), (602, "é ü", "ü" * 5), (459, "again", same), (None, "n", same), (None, "n", "only here"), (None, "n", "only here")]
    return rows + [(700, "long", "x" * 3_000_000), (701, "long", "\r\n\r\n" * 1000), (-5, "minus", same)]


def plain(rows, least=0):
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    out = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        of = last.get(h or "") if len(data) >= least else None
        revisit = of is not None and of != i
        out[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", of if revisit else None] += 1
    return out


@pytest.mark.parametrize("least", [0, 3])
def test_round_trip_like_plain_code(spark, least):
    rows = pages()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    got = warc.round_trip(df, warc.Setup(least=least)).collect()
    assert Counter(tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got) == plain(rows, least)


def test_archives_and_what_they_hold(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(6)
    manifest = warc.write(df, scratch.folder(spark, "archives"), warc.Setup(target_bytes=10_000))
    listed = manifest.collect()
    assert len(listed) > 3 and sum(r["records"] for r in listed) == len(rows)
    records = warc.read(spark, manifest).cache()
    assert warc.unresolved(records).isEmpty() and not warc.unresolved(records.where("not (page_id = 459 and record_type = 'response')")).isEmpty()
    held = {r["page_id"]: (r["url"], r["payload"]) for r in records.where("record_type = 'response' and page_id is not null").collect()}
    for i, url, html in rows:
        if i in held and i != 459:
            assert held[i] == (url if url is None else url.replace("\r", "%0D").replace("\n", "%0A"), bytearray((html or "").encode()))
    # Any reader of the format reads the archives: a dictionary in the leading frame, then a frame to a record.
    data = open(listed[0]["path"].removeprefix("file:").replace("//", "/"), "rb").read()
    assert data[:4] == warc.SKIPPABLE
    size = int.from_bytes(data[4:8], "little")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    assert reader.decompressobj().decompress(data[8 + size :]).startswith(b"WARC/1.1\r\nWARC-Type: ")
    nothing = warc.write(df.limit(0), scratch.folder(spark, "archives"))
    assert nothing.isEmpty() and warc.read(spark, nothing).isEmpty()


def test_other_ways_to_write_an_archive():
    records = [warc.record(i, "u", b"payload %d " % i * 30, None, False, "2024-01-01T00:00:00Z") for i in range(200)]
    trained = zstandard.train_dictionary(4096, records)
    own = zstandard.ZstdCompressor().compress(trained.as_bytes())
    sizeless = zstandard.ZstdCompressor(dict_data=trained, write_content_size=False)
    data = warc.SKIPPABLE + len(own).to_bytes(4, "little") + own
    for i, r in enumerate(records):
        out = sizeless.compressobj()
        data += out.compress(r) + out.flush() if i % 2 else zstandard.ZstdCompressor(dict_data=trained, level=-5, write_checksum=True).compress(r)
        data += b"\x51\x2a\x4d\x18\x03\x00\x00\x00abc" if i % 7 == 0 else b""  # a skippable frame of another kind is no record
    assert [r for _, r, e in warc.decoded(io.BytesIO(data))] == records
    bare = b"".join(zstandard.ZstdCompressor().compress(r) for r in [*records, records[0] + b"\0" * 500_000])
    assert [r for _, r, _ in warc.decoded(io.BytesIO(bare))][:200] == records


GOOD = warc.record(7, "u", b"some payload", None, False, "2024-01-01T00:00:00Z")
AGAIN = warc.record(8, "u", b"some payload", 7, True, "2024-01-01T00:00:00Z")


def test_headers_and_lengths_are_checked():
    assert warc.parsed(GOOD).payload == b"some payload" and warc.parsed(AGAIN) == warc.Record(8, "u", "revisit", 7, warc.digest(b"some payload"), 12, None)
    folded = GOOD.replace(b"WARC-Target-URI: u", b"warc-target-uri:\r\n u")
    assert warc.parsed(folded).url == "u"
    for old, new, why in (
        (b"WARC/1.1", b"WARC/0.9", "not a record"), (b"WARC-Date: 2024-01-01T00:00:00Z\r\n", b"", "without warc-date"), (b"2024-01-01T00:00:00Z", b"yesterday", "no date"),
        (b"some payload\r\n", b"some payloa\r\n", "the block should have"), (b"\r\n\r\n", b"\r\n", "not a record|the block|no field"), (b"some payload", b"SOME payload", "digest is"),
        (b"Content-Length: 12", b"Content-Length: 11", "the payload should have"), (b"Content-Length: 12", b"Content-Length: 1x", "no number"), (b"sha1:", b"md5:", "no digest"),
        (b"WARC-Type: response", b"WARC-Type: metadata", "of type"), (b"x-page:7", b"other:7", "names no page"), (b"WARC-Target-URI: u", b"WARC-Target-URI u", "no field"),
    ):
        assert old in GOOD
        with pytest.raises(warc.Malformed, match=why):
            warc.parsed(GOOD.replace(old, new))
    for old, new in ((warc.PROFILE, b"x"), (b"WARC-Refers-To: <urn:x-page:7>\r\n", b""), (b"\r\n\r\n", b"\r\n")):
        with pytest.raises(warc.Malformed):
            warc.parsed(AGAIN.replace(old, new))


def test_broken_archives(spark, tmp_path):
    frame = zstandard.ZstdCompressor(write_checksum=True).compress
    spoilt = bytearray(frame(GOOD))
    spoilt[-1] ^= 1
    files = {"cut": frame(GOOD) + frame(AGAIN)[:-3], "noise": frame(GOOD) + b"no frame", "spoilt": bytes(spoilt) + frame(AGAIN), "short": frame(GOOD), "leading": warc.SKIPPABLE + b"\x04\0\0\0abcd" + frame(GOOD), "header": frame(GOOD.replace(b"WARC/1.1", b"WARC/2.0")) + frame(AGAIN)}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
        manifest = spark.createDataFrame([(f"file://{tmp_path}/{name}", 2)], "path string, records long")
        rows = warc.read(spark, manifest, strict=False).collect()
        assert [r["error"] for r in rows if r["error"]] and {r["page_id"] for r in rows if not r["error"]} == {"cut": {7}, "noise": {7}, "spoilt": {8}, "short": {7}, "leading": set(), "header": {8}}[name]
        with pytest.raises(Exception, match="Malformed"):
            warc.read(spark, manifest).collect()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(-(2**62), 2**62), st.one_of(st.none(), st.text(max_size=30)), st.binary(max_size=200)), max_size=30))
def test_any_payload_comes_back(some):
    data = b"".join(zstandard.ZstdCompressor().compress(warc.record(i, u, p, None, False, "2024-01-01T00:00:00Z")) for i, u, p in some)
    got = [warc.parsed(r) for _, r, _ in warc.decoded(io.BytesIO(data))]
    assert [(x.page_id, x.payload) for x in got] == [(i, p) for i, _, p in some]
