"""WARC archives of captures and their external index.

Writing: captures of equal payloads of at least ``MIN_REVISIT`` bytes have one response record, that
of the smallest page_id; the others are revisit records without payload. Each task writes archives
of its own, through Spark's text writer with the blank lines between records as line separator,
compressed as a whole: offsets in the index are those of the uncompressed archive.

Index: every archive read back gives a run of captures sorted by URL key, timestamp and id, written
as a table. Ranges of URL keys are then merged, each by a loser tree over the pieces of all runs that
fall in the range, into capture histories in global order. The number of ranges follows from the number
of captures: a range has about ``MERGE_ROWS`` of them, held as one Arrow table, whose rows the tree
orders by their numbers. A range also splits one key's captures, by timestamp, id and place.

Defined cases: a null payload is empty; a null url gives a record without target and the key ''; a
null page_id gives a record id without number, read back as null, and is never referred to. Rows of
the smallest page_id are all responses if it is repeated.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from itertools import islice
from typing import Any
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.llm.shipping import ship
from lakelayers.scratch import scratch_folder, stage

MIN_REVISIT = 100
ROWS_PER_FILE = 10_000
MERGE_ROWS = 250_000
FIRST_DAY = "2024-01-01"

_VERSION = b"WARC/1.1"
_END = b"\r\n\r\n"
_GZIP = b"\x1f\x8b"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = [
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("url_key", pa.string()), ("captured_at", pa.string()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
]
INDEX = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, captured_at string, archive string, offset long, length long"
RUN = INDEX + ", place long"


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """value: the text of a WARC record of each row, without the blank lines behind it.

    The table holds no capture time; the id stands for seconds since ``FIRST_DAY``.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload")
    ).selectExpr("*", "sha2(payload, 256) digest", "octet_length(payload) size")
    firsts = rows.filter(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = firsts.filter("n > 1").select(F.col("digest").alias("first_digest"), "first")
    known = rows.join(firsts, F.expr(f"digest = first_digest and size >= {MIN_REVISIT}"), "left")
    second = "coalesce(page_id, 0)"
    clock = f"format_string('%02d:%02d:%02d', pmod({second} div 3600, 24L), pmod({second} div 60, 60L), pmod({second}, 60L))"
    date = f"concat(date_add(DATE'{FIRST_DAY}', cast(pmod(floor({second} / 86400), 36500L) as int)), 'T', {clock}, 'Z')"
    name = "concat('<urn:page:', coalesce(cast({} as string), ''), '>')"
    http = "concat('HTTP/1.1 200 OK\\r\\nContent-Type: text/html; charset=utf-8\\r\\nContent-Length: ', size, '\\r\\n\\r\\n')"
    parts = known.selectExpr(
        "*",
        "first is not null and (page_id > first or page_id is null) as again",
        f"{http} http",
        f"""concat('\\r\\nWARC-Record-ID: ', {name.format('page_id')}, '\\r\\nWARC-Date: ', {date},
            coalesce(concat('\\r\\nWARC-Target-URI: ', replace(replace(url, '\\r', '%0D'), '\\n', '%0A')), ''),
            '\\r\\nWARC-Payload-Digest: sha256:', digest, '\\r\\nContent-Type: application/http; msgtype=response') about""",
    )
    return parts.selectExpr(
        f"""case when again then concat('WARC/1.1\\r\\nWARC-Type: revisit', about, '\\r\\nWARC-Profile: {_PROFILE}',
                '\\r\\nWARC-Refers-To: ', {name.format('first')}, '\\r\\nContent-Length: ', octet_length(http), '\\r\\n\\r\\n', http)
            else concat('WARC/1.1\\r\\nWARC-Type: response', about,
                '\\r\\nContent-Length: ', octet_length(http) + size, '\\r\\n\\r\\n', http, payload) end as value"""
    )


def write_archives(
    pages: DataFrame, folder: str, rows_per_file: int = ROWS_PER_FILE, compression: str = "gzip", **columns: str
) -> None:
    writer = records(pages, **columns).write.option("lineSep", _END.decode()).option("maxRecordsPerFile", rows_per_file)
    writer.option("compression", compression).text(folder)


def url_key(url: str | None) -> str:
    """The host in reverse order, then path and query, in lower case, without scheme and fragment."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    path = parts.path + ("?" + parts.query if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}){path or '/'}".lower()


def parse_archive(content: bytes, archive: str) -> Iterator[dict[str, Any]]:
    """The captures of an archive, compressed or not. Raises ValueError for a damaged record."""
    if content.startswith(_GZIP):
        content = gzip.decompress(content)
    at = 0
    while at < len(content):
        split = content.find(_END, at)
        if split < 0 or not content.startswith(_VERSION, at):
            raise ValueError(f"no record at byte {at} of {archive}")
        lines = content[at:split].decode().split("\r\n")[1:]
        head = dict(line.split(": ", 1) for line in lines)
        begin, length = split + 4, int(head["Content-Length"])
        block = content[begin : begin + length]
        if len(block) < length or content[begin + length : begin + length + 4] != _END:
            raise ValueError(f"cut record at byte {at} of {archive}")
        http, _, payload = block.partition(_END)
        size = int(http.rpartition(b"Content-Length: ")[2])
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = head["WARC-Type"]
        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"wrong payload at byte {at} of {archive}")
        yield {
            "page_id": _number(head["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": _number(head["WARC-Refers-To"]) if kind == "revisit" else None,
            "url_key": url_key(head.get("WARC-Target-URI")), "captured_at": head["WARC-Date"],
            "archive": archive, "offset": at, "length": begin + length + 4 - at,
        }
        at = begin + length + 4


def _number(name: str) -> int | None:
    digits = name.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def capture_order(row: dict[str, Any]) -> tuple:
    return row["url_key"], row["captured_at"], row["page_id"] is not None, row["page_id"] or 0, row["archive"], row["offset"]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
            run = sorted(parse_archive(content.as_py(), name.as_py()), key=capture_order)
            rows = [row | {"place": i} for i, row in enumerate(run)]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([*_FIELDS, ("place", pa.int64())]))


def capture_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of all archives, those of one archive together and in order."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.selectExpr("reverse(split(path, '/'))[0] path", "content").mapInArrow(_runs, RUN)


class LoserTree:
    """Merges sorted lists; an inner node holds the loser of the match below it, so that the next
    winner costs one match a level."""

    def __init__(self, runs: list, key) -> None:
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.heads = [self._head(i) for i in range(len(runs))]
        self.losers = [-1] * max(1, len(runs))
        for leaf in range(len(runs)):
            self._play(leaf)

    def _head(self, run: int):
        rows = self.runs[run]
        return self.key(rows[self.at[run]]) if self.at[run] < len(rows) else None

    def _beats(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None and (self.heads[a] is not None or a < b)
        return (self.heads[a], a) < (self.heads[b], b)

    def _play(self, winner: int) -> None:
        node = (winner + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # the other side has not been played yet
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> LoserTree:
        return self

    def __next__(self):
        winner = self.losers[0]
        if not self.runs or self.heads[winner] is None:
            raise StopIteration
        row = self.runs[winner][self.at[winner]]
        self.at[winner] += 1
        self.heads[winner] = self._head(winner)
        self._play(winner)
        return row


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of keys; rows come sorted by archive and place."""
    table = pa.Table.from_batches(list(batches) or [pa.RecordBatch.from_pylist([], pa.schema([*_FIELDS, ("place", pa.int64())]))])
    table = table.select([name for name, _ in _FIELDS]).combine_chunks()
    order = {c: table.column(c) for c in ("url_key", "captured_at", "page_id", "archive", "offset")}
    archives = table.column("archive").to_numpy()
    begins = np.flatnonzero(np.append(True, archives[1:] != archives[:-1])) if len(archives) else np.zeros(0, int)
    runs = [range(a, b) for a, b in zip(begins, np.append(begins, len(archives))[1:], strict=True)]
    merged = LoserTree(runs, lambda row: capture_order({c: column[row].as_py() for c, column in order.items()}))
    while rows := list(islice(merged, 10_000)):
        yield from table.take(pa.array(rows, pa.int64())).to_batches()


def capture_histories(runs: DataFrame, merge_rows: int = MERGE_ROWS) -> DataFrame:
    """The captures of sorted runs in global order of URL key, timestamp and id: the partitions of
    the result are consecutive ranges."""
    ship(runs.sparkSession)
    ranges = 1 + runs.count() // merge_rows
    ranged = runs.repartitionByRange(ranges, "url_key", "captured_at", "page_id", "archive", "offset")
    return ranged.sortWithinPartitions("archive", "place").mapInArrow(_merge, INDEX)


def archived_captures(pages: DataFrame, **columns: str) -> DataFrame:
    """Writes ``pages`` as archives, reads them back and returns their captures in global order."""
    spark = pages.sparkSession
    folder = scratch_folder(spark, "warc")
    write_archives(pages, folder, **columns)
    return capture_histories(stage(capture_runs(spark, folder), "capture-runs"))
