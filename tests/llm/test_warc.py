import hashlib
import random
from io import BytesIO

import pytest

from tallyscope.functions.lineage import new_folder
from tallyscope.llm import warc


def pages(spark):
    rng = random.Random(3)
    bodies = ["<p>" + " ".join(rng.choice(["alpha", "beta", "ünï", "\r\n\r\n"]) for _ in range(rng.choice([3, 40, 900]))) for _ in range(40)]
    rows = [(i, f"http://h/{i}", rng.choice(bodies)) for i in range(200)]
    rows += [(900, None, None), (901, "u", ""), (902, "two\nlines", "x" * 99), (903, "u", "x" * 99), (904, "u", "x" * 100), (905, "u", "x" * 100), (906, "u", "é" * 50), (907, "u", "y" * 3_000_000), (None, "u", "z" * 200)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload_digest string")


def test_round_trip(spark):
    table = pages(spark)
    rows = table.collect()
    raw = {r["page_id"]: (r["html"] or "").encode() for r in rows}
    first = {}
    for i in sorted(k for k in raw if k is not None):
        first.setdefault(raw[i], i)
    got = warc.archive_and_read(table).collect()
    assert len(got) == len(rows)
    for r in got:
        body = raw[r["page_id"]]
        again = r["page_id"] is not None and len(body) >= 100 and first[body] != r["page_id"]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha256(body).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[body]) if again else ("response", None))
    assert {r["url"] for r in got if r["page_id"] in (900, 902)} == {None, "two lines"}


def test_payloads_come_back_and_several_archives_are_written(spark, monkeypatch):
    table = pages(spark)
    archives = warc.write(table, new_folder(spark, "warc"))
    got = {r["page_id"]: r for r in warc.read(archives, payloads=True).collect()}
    assert archives.count() >= 1 and archives.groupBy().sum("records").first()[0] == len(got)
    for r in table.collect():
        if got[r["page_id"]]["record_type"] == "response":
            assert bytes(got[r["page_id"]]["payload"]) == (r["html"] or "").encode()


def test_dictionary_leads_and_damage_is_noticed(spark):
    archives = warc.write(pages(spark), new_folder(spark, "warc"))
    name = archives.orderBy("records", ascending=False).first()["archive"]
    files, path = warc.store(name)
    data = files.open_input_stream(path).read()
    assert data[:4] == bytes.fromhex("5d2a4d18")
    n = len(list(warc.records(BytesIO(data))))
    assert n == archives.filter(archives["archive"] == name).first()["records"]
    with pytest.raises(Exception):
        [warc.parse(r) for r in warc.records(BytesIO(data[:-7]))]
    with pytest.raises(ValueError):
        list(warc.records(BytesIO(data[8:])))


def test_no_rows(spark):
    assert warc.archive_and_read(pages(spark).limit(0)).count() == 0
