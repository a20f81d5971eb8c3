"""Archives: round trip against plain Python, framing and digests."""

import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from graphshed.llm import bloom, warc


def expected(rows, least=0):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and page is not None:
            first[data] = min(page, first.get(data, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        again = data in first and page != first[data]
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first[data] if again else None))
    return out


ROWS = [
    (5, "http://a.example/x y", "same"),
    (3, None, "same"),
    (3, None, "same"),
    (9, "http://b.example/\r\nWARC-Type: x", "WARC/1.1\r\n\r\nbody\r\n\r\n"),
    (1, "", None),
    (2, "é", ""),
    (4, "u", "é🙂" * 100_000),
    (None, "u", "same"),
    (None, "u", "alone"),
    *((100 + i, "u", "hot") for i in range(500)),
]


@pytest.mark.parametrize("least, bits", [(0, None), (1, None), (10_000, None), (0, 64), (0, 1), (1, 64)])
def test_round_trip(spark, least, bits, monkeypatch):
    """Also with filters that let nearly all through, and with too many digests for any."""
    if bits:
        monkeypatch.setattr(bloom, "bits_for", lambda n: None if bits == 1 else bits)
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("payload", F.lit("own"))
    found = [tuple(r) for r in warc.round_trip(df, least).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted(found, key=key) == sorted(expected(ROWS, least), key=key)


def test_filter_sizes():
    assert bloom.bits_for(0) == bloom.LEAST_BITS and bloom.bits_for(1 << 20) == 1 << 24
    assert bloom.bits_for(bloom.MOST_BITS // bloom.FEWEST) == bloom.MOST_BITS and bloom.bits_for(bloom.MOST_BITS) is None


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def archive():
    body = b"abc" * 100_000
    sha1 = hashlib.sha1(body).digest()
    return warc.member(warc.record(1, "http://x", body, len(body), sha1)) + warc.member(warc.record(2, "http://y", None, len(body), sha1, 1))


def test_each_record_is_a_member_and_streams():
    data = archive()
    plain = gzip.decompress(data)
    assert plain.count(b"WARC/1.1") == 2

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(7)

    for stream in (io.BytesIO(data), Slow(data)):
        (head, http, n, good), (head2, http2, n2, good2) = list(warc.Reader(stream))
        assert (head["warc-type"], n, good, http["content-length"]) == ("response", 300_000, True, "300000")
        assert (head2["warc-type"], n2, good2, http2["content-length"]) == ("revisit", 0, True, "300000")
        assert warc.page_of(head2["warc-refers-to"]) == "1"


def test_damage_is_found():
    data = archive()
    with pytest.raises(warc.Damaged):
        list(warc.Reader(io.BytesIO(data[:-30])))
    record = warc.record(1, "http://x", b"abcdef", 6, hashlib.sha1(b"abcdef").digest())
    changed = record.replace(b"abcdef", b"abcdeg")
    assert [good for *_, good in warc.Reader(io.BytesIO(warc.member(changed)))] == [False]
    with pytest.raises(warc.Damaged):
        list(warc.Reader(io.BytesIO(warc.member(record + b"x"))))
