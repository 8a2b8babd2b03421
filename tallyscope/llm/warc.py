"""WARC archives of individually compressed records with a dictionary in front."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.lineage import cut_lineage, new_folder

#: Fixed values of the Zstandard WARC format: the skippable frame that holds the dictionary.
DICTIONARY_FRAME = 0x184D2A5D
#: Payloads of fewer bytes are archived again instead of referred to.
LEAST = 100
#: Bytes of payload after which an archive ends, and those from whose records its dictionary is built.
ARCHIVE, LEARN = 64 * 2**20, 2 * 2**20
DICTIONARY = 64 * 2**10


def store(uri: str):
    """File system and path of a URI, by whatever store the folder is in."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def one_line(text) -> str:
    return " ".join(str(text).split())


def record(kind: str, row, payload: bytes) -> bytes:
    """A WARC record of a page; a revisit has HTTP headers and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.payload_bytes}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if pd.isna(row.page_id) else int(row.page_id)}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{row.payload_digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if not pd.isna(row.url):
        head.append(f"WARC-Target-URI: {one_line(row.url)}")
    if kind == "revisit":
        head += [
            f"WARC-Refers-To: <urn:page:{int(row.first_page)}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Archive:
    """One file being written: the first records wait until there are enough to build the dictionary from."""

    def __init__(self, folder: str, level: int):
        self.name, self.level = f"{folder}/pages-{uuid.uuid4().hex}.warc.zst", level
        self.waiting: list[bytes] = []
        self.held = self.payload = self.records = 0
        self.out = self.packer = None

    def add(self, rec: bytes, payload: int) -> None:
        self.records, self.payload = self.records + 1, self.payload + payload
        if self.packer is None:
            self.waiting.append(rec)
            self.held += len(rec)
            if self.held >= LEARN:
                self.begin()
        else:
            self.out.write(self.packer.compress(rec))

    def begin(self) -> None:
        try:
            dictionary = zstandard.train_dictionary(DICTIONARY, [r[:65536] for r in self.waiting], k=1024, d=8, level=self.level).as_bytes()
        except zstandard.ZstdError:  # too few records: their own bytes serve
            dictionary = b"".join(self.waiting)[:DICTIONARY]
        frame = zstandard.ZstdCompressor(level=19).compress(dictionary)
        files, path = store(self.name)
        self.out = files.open_output_stream(path)
        self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(frame)) + frame)
        self.packer = zstandard.ZstdCompressor(level=self.level, dict_data=zstandard.ZstdCompressionDict(dictionary))
        for rec in self.waiting:
            self.out.write(self.packer.compress(rec))
        self.waiting = []

    def close(self) -> dict:
        if self.packer is None:
            self.begin()
        self.out.close()
        return {"archive": self.name, "records": self.records, "payload_bytes": self.payload}


def decide(pages: DataFrame) -> DataFrame:
    """Columns page_id, url, payload_bytes, payload_digest, first_page (of a revisit, else null), body (of a response, else null)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html")).select(
        "*", F.octet_length("html").cast("long").alias("payload_bytes"), F.sha2("html", 256).alias("payload_digest")
    )
    firsts = rows.filter(F.col("payload_bytes") >= LEAST).groupBy("payload_digest").agg(F.min("page_id").alias("first"))
    revisits = (F.col("payload_bytes") >= LEAST) & (F.col("page_id") != F.col("first"))
    first = F.when(revisits, F.col("first"))
    return rows.join(firsts, "payload_digest", "left").select(
        "page_id", "url", "payload_bytes", "payload_digest", first.alias("first_page"), F.when(first.isNull(), F.col("html")).alias("body")
    )


def write(pages: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Archive every row of ``pages`` (page_id, url, html, …) below ``folder``; the table (archive, records, payload_bytes).

    Each task writes archives of its own under fresh names. Only those in the returned table count: files of tasks that
    failed or ran twice are not in it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive = None
        for batch in batches:
            for row in batch.itertuples(index=False):
                archive = archive or Archive(folder, level)
                payload = b"" if row.body is None else row.body.encode("utf-8", "surrogatepass")
                archive.add(record("response" if pd.isna(row.first_page) else "revisit", row, payload), len(payload))
                if archive.payload >= ARCHIVE:
                    yield pd.DataFrame([archive.close()])
                    archive = None
        if archive:
            yield pd.DataFrame([archive.close()])

    files, path = store(folder)
    files.create_dir(path, recursive=True)
    return cut_lineage(decide(pages).mapInPandas(run, "archive string, records long, payload_bytes long"))


def records(stream, chunk: int = 2**20) -> Iterator[bytes]:
    """The decompressed records of an archive, one Zstandard frame each."""
    magic, length = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary")
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(stream.read(length)))
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
    rest = b""
    frame, parts = unpacker.decompressobj(), []
    while True:
        data = rest or stream.read(chunk)
        if not data:
            break
        parts.append(frame.decompress(data))
        rest = b""
        if frame.eof:
            yield b"".join(parts)
            rest, frame, parts = frame.unused_data, unpacker.decompressobj(), []
    if parts:
        raise ValueError("the archive ends within a record")


def parse(rec: bytes) -> dict:
    """What a record says, its payload checked against its digest."""
    head, _, block = rec.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda urn: int(text) if (text := urn[len("<urn:page:") : -1]) else None
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


SHAPE = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(archives: DataFrame, payloads: bool = False, batch: int = 256) -> DataFrame:
    """All records of the archives named in column ``archive``, with their payloads (null for revisits) if asked for.

    An archive is streamed record by record; a damaged or cut one raises an error.
    """
    shape = f"{SHAPE}, payload binary" if payloads else SHAPE
    names = [c.split(" ")[0] for c in shape.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for names_of in batches:
            for name in names_of["archive"]:
                files, path = store(name)
                with files.open_input_stream(path) as stream:
                    rows = []
                    for rec in records(stream):
                        row = parse(rec)
                        rows.append([row[c] for c in names])
                        if len(rows) == batch:
                            yield frame(rows)
                            rows = []
                    if rows:
                        yield frame(rows)

    def frame(rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        return out.astype({"page_id": "Int64", "refers_to": "Int64"})

    spread = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("archive").repartition(spread, "archive").mapInPandas(run, shape)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html, …) to archives in the shared folder and read them back.

    The payload is the html in UTF-8, nothing if null. Of equal payloads of at least 100 bytes the smallest page_id is a
    response, the others are revisits that refer to it; rows that repeat that page_id are responses, and so are rows
    without page_id (unless some row with the payload has one and, being unknown, they can't be called its revisits) and
    all shorter payloads. No rows give no archives and no rows. Other columns are ignored.
    """
    return read(write(pages, new_folder(pages.sparkSession, "warc")))
