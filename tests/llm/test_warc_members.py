"""Packages with several members, packed or not, with and without their own index."""

import hashlib
import zipfile

import pytest

from strata.llm import warc


def record(number, payload):
    digest = hashlib.sha256(payload).hexdigest()
    return warc._record("response", str(number), f"http://h/{number}", digest, None, payload)


def unpacked(data):
    import gzip

    return gzip.decompress(data)


PAYLOADS = {i: f"payload {i} \r\n\r\n".encode() * (i + 1) for i in range(12)}


def package(folder, name, indexed):
    one, two = [record(i, PAYLOADS[i]) for i in range(4)], [record(i, PAYLOADS[i]) for i in range(4, 8)]
    plain = [unpacked(record(i, PAYLOADS[i])) for i in range(8, 12)]
    kept = {"archive/one.warc.gz": one, "archive/two.warc.gz": two, "archive/three.warc": plain}
    path = f"{folder}/{name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as out:
        lines = []
        for member, records in kept.items():
            out.writestr(member, b"".join(records))
            at, own = 0, []
            for data in records:
                own.append(f"{at} {len(data)}")
                at += len(data)
            if indexed == "own":
                out.writestr(f"indexes/{member.split('/')[1].split('.')[0]}.cdx", "\n".join(own) + "\n")
            lines += [f"{line} {member.split('/')[1]}" for line in own]
            if indexed == "first" and member.endswith("one.warc.gz"):
                out.writestr("indexes/one.cdx", "\n".join(own))
        if indexed == "named":
            out.writestr("indexes/index.cdx", "\n".join(lines) + "\n")
        if indexed == "unnamed":  # nobody can tell whose lines these are
            out.writestr("indexes/index.cdx", "\n".join(line.rsplit(" ", 1)[0] for line in lines[:4]) + "\n")
    return path


@pytest.mark.parametrize("indexed", ["own", "named", "first", "unnamed", "none"])
@pytest.mark.parametrize("span", [1, 1 << 20])
def test_every_member_is_read_by_its_own_index(spark, folder, indexed, span):
    path = package(folder, indexed, indexed)
    found = warc.read_records(spark.createDataFrame([(path,)], "path string").repartition(1), span)
    got = {int(r.record_id): bytes(r.payload) for r in found.select("record_id", "payload").collect()}
    assert got == PAYLOADS
    assert found.count() == len(PAYLOADS)
    with open(path, "rb") as file:
        spans = list(warc._spans(file, len(open(path, "rb").read()), span))
    if span == 1:
        assert len(spans) == {"own": 12, "named": 12, "first": 6, "unnamed": 3, "none": 3}[indexed]


def test_reading_is_spread_over_tasks(spark, folder):
    pages = spark.range(400).selectExpr("id AS page_id", "concat('u', id) AS url", "repeat(sha2(CAST(id AS STRING), 512), 40) AS html")
    packages = warc.archive_pages(spark, pages, folder)
    total = packages.groupBy().sum("bytes").first()[0]
    records = warc.read_records(packages, span_bytes=total // 8)
    assert records.rdd.getNumPartitions() >= 8 and records.count() == 400
