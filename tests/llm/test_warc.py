import base64
import hashlib
import io
import random

import pytest

from blotterflow.llm import warc
from blotterflow.llm.warc import _gzip, digest, members, parse, read_warc, record, round_trip, write_warc

SCHEMA = "page_id long, url string, html string"


def want(rows, least=0):
    firsts = {}
    for page, _, html in rows:
        if page is not None:
            firsts[html or ""] = min(page, firsts.get(html or "", page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = firsts.get(html or "")
        again = first is not None and len(data) >= least and (page is None or first < page)
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), sha, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def got(df):
    name = lambda x: int(x[len(warc.PREFIX) :]) if x and x.startswith(warc.PREFIX) else None
    return sorted(
        ((name(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, name(r.refers_to)) for r in df.collect()), key=str
    )


def pages(seed, n=300):
    pick = random.Random(seed)
    texts = ["", "<p>copy</p>", "é" * 50, *["".join(chr(pick.randrange(32, 900)) for _ in range(pick.randrange(3000))) for _ in range(n // 2)]]
    return [(i, f"http://h{i}/é", pick.choice(texts)) for i in pick.sample(range(10_000), n)] + [(20_000, None, None)]


def test_round_trip(spark):
    rows = pages(1)
    out = round_trip(spark.createDataFrame(rows, SCHEMA).repartition(3)).cache()
    assert got(out) == want(rows)
    payloads = {r.record_id: bytes(r.payload) for r in out.where("record_type = 'response'").collect()}
    texts = {f"{warc.PREFIX}{i}": (t or "").encode() for i, _, t in rows}
    assert payloads and all(texts[k] == v for k, v in payloads.items())


@pytest.mark.parametrize("split", [1 << 20, 5_000, 701])
def test_every_split_reads_each_record_once(spark, tmp_path, split):
    rows = pages(2, 120)
    folder = f"file://{tmp_path}/warc"
    files = write_warc(spark.createDataFrame(rows, SCHEMA).repartition(2), folder, least=60)
    assert got(read_warc(spark, folder, files, split)) == want(rows, 60)


def test_scanner_resumes_after_damage_and_false_magic():
    records = [_gzip(record(i, None, b"\x1f\x8b\x08" * i + bytes(range(256)) * (i % 3), None)) for i in range(40)]
    other = _gzip(b"\x1f\x8b\x08 no record of an archive")
    data = b"\x1f\x8b\x08junk" + b"".join(records[:20]) + other + records[20][:-9] + b"".join(records[21:])
    for size in (len(data), 333, 64):
        seen = []
        for start in range(0, len(data), size):
            seen += members(io.BytesIO(data), len(data), start, min(start + size, len(data)))
        numbers = [int(parse(d)["record_id"][len(warc.PREFIX) :]) for _, d in seen]
        assert numbers == [i for i in range(40) if i != 20]


def test_edges(spark):
    rows = [(None, "u", "same"), (4, "u", "same"), (4, "v", "same"), (9, "w\r\nx: y", "same"), (None, None, "alone")]
    assert got(round_trip(spark.createDataFrame(rows, SCHEMA))) == want(rows)
    big = [(1, "u", "ab" * 2_000_000), (2, "u", "ab" * 2_000_000)]
    assert got(round_trip(spark.createDataFrame(big, SCHEMA))) == want(big)
    assert round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    extra = spark.createDataFrame([(1, "u", "t", "x", 5)], SCHEMA + ", sha string, FIRST int")
    assert got(round_trip(extra)) == want([(1, "u", "t")])


def test_digest_is_bare_base32():
    assert digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
