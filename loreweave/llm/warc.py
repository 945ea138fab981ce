"""WARC archives with a globally ordered capture index.

Write: each page becomes a WARC/1.1 record; a payload of ``REVISIT_BYTES`` or more that others share is stored once, by the page with
the largest id, and the others become revisit records. Tasks write archives of bounded size with Spark's text writer (gzip), so any
file system that Spark reaches will do. Read: archives are parsed by their content lengths, digests are verified, and the captures of an
archive are sorted by URL key and time: one run per archive. Merge: runs are range-partitioned by URL key, time and page, and
each range merges its slices of all runs with a loser tree, which gives the capture history of every URL in global order.

Rules: a null page counts as an empty payload; a null URL leaves out the target header and has the URL key ``-``; line ends in a URL are
percent-encoded; a null page id is written as ``-`` and read back as null, and is the smallest of its group. Of rows with the same largest id
in a group of equal payloads all are responses. Empty tables give no archives and no rows. Other columns are not read.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from hashlib import sha1
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loreweave.llm.queries import query, table
from loreweave.session import scratch_path, written

REVISIT_BYTES = 1_000
# characters of records that one archive holds before the next is begun
ARCHIVE_CHARS = 32 << 20
FIRST_CAPTURE = datetime(2020, 1, 1, tzinfo=UTC)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH = 2_000
CAPTURE = (
    "run string, seq long, url_key string, captured string, page_id long, offset long, length long, "
    "record_type string, payload_digest string, payload_bytes long, refers_to long"
)


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'-' if page_id is None else page_id}>"


def page_of(urn_text: str | None) -> int | None:
    name = (urn_text or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name.lstrip("-").isdigit() else None


def capture_time(page_id: int | None) -> str:
    """The tables have no capture times: page ids count seconds, within a century."""
    return (FIRST_CAPTURE + timedelta(seconds=(page_id or 0) % (100 * 365 * 86_400))).strftime("%Y-%m-%dT%H:%M:%SZ")


def url_key(url: str | None) -> str:
    """Host parts in reverse, then path and query: captures of a site sort together."""
    if url is None:
        return "-"
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut = min((i for i in (rest.find(c) for c in "/?") if i >= 0), default=len(rest))
    host, path = rest[:cut], rest[cut:]
    host = host.rsplit("@", 1)[-1].split(":", 1)[0].lower().strip(".")
    return ",".join(reversed(host.split("."))) + ")" + (path or "/")


def record(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None) -> str:
    """One record without its last line end, which the writer adds."""
    payload = html.encode("utf-8", "surrogatepass")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    revisit = refers_to is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {urn(page_id)}",
        f"WARC-Date: {capture_time(page_id)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='%:/?#[]@!$&()*+,;=~.-_' + chr(39))}")
    if revisit:
        head += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(http) + (0 if revisit else len(payload))}")
    return "\r\n".join(head) + "\r\n\r\n" + http + ("" if revisit else html) + "\r\n"


def parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """``(offset, length, headers, block)`` of every record, by content length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        block = end + 4
        stop = block + int(headers["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield at, stop + 4 - at, headers, data[block:stop]
        at = stop + 4


def capture(headers: dict[str, str], block: bytes) -> tuple:
    """``(url_key, captured, page_id, record_type, payload_digest, payload_bytes, refers_to)``; a payload is verified."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(line.split(b": ", 1)[1]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length: "))
    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is not what its digest says")
    url = headers.get("WARC-Target-URI")
    return url_key(None if url is None else unquote(url)), headers["WARC-Date"], page_of(headers["WARC-Record-ID"]), kind, digest, size, page_of(headers.get("WARC-Refers-To"))


class LoserTree:
    """Merges sorted runs: inner places hold the loser of their match, the winner moves up; one path is replayed per row."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs, self.at = runs, [0] * len(runs)
        self.losers = [-1] * max(1, len(runs))
        self.winner = self._build(1) if runs else -1

    def _key(self, run: int) -> tuple:
        """Exhausted runs lose to all others; runs in order on a tie."""
        rows, i = self.runs[run], self.at[run]
        return (0, rows[i], run) if i < len(rows) else (1, (), run)

    def _build(self, node: int) -> int:
        n = len(self.runs)
        if node >= n:
            return node - n
        a, b = self._build(2 * node), self._build(2 * node + 1)
        if self._key(b) < self._key(a):
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """``(run, place in the run)`` in merged order."""
        while self.runs:
            run = self.winner
            if self.at[run] >= len(self.runs[run]):
                return
            yield run, self.at[run]
            self.at[run] += 1
            node = (run + len(self.runs)) // 2
            while node >= 1:
                if self._key(self.losers[node]) < self._key(run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def with_record_types(pages: DataFrame, page_id: str, url: str, html: str, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``(page_id, url, html, digest, keeper)``: ``keeper`` is the page that stores the payload if others share it."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    rows = rows.select("*", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").alias("bytes"))
    shared = rows.filter(F.col("bytes") >= revisit_bytes).groupBy("digest", "bytes").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1")
    return rows.join(shared, ["digest", "bytes"], "left").select("page_id", "url", "html", "digest", "keeper")


def write_archives(pages: DataFrame, folder: str, archive_chars: int = ARCHIVE_CHARS) -> None:
    """Write ``(page_id, url, html, digest, keeper)`` as gzipped WARC files below ``folder``."""

    def build(batches):
        task, part, held = TaskContext.get().partitionId(), 0, 0
        names: list[str] = []
        records: list[str] = []
        for b in batches:
            for page, url, html, digest, keeper in zip(*(c.to_pylist() for c in b.columns)):
                made = record(page, url, html, digest, keeper if keeper is not None and keeper != page else None)
                if held and held + len(made) > archive_chars:
                    part, held = part + 1, 0
                held += len(made)
                names.append(f"{task:06d}-{part:05d}")
                records.append(made)
                if len(records) >= BATCH or held > archive_chars // 4:
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(records)], ["archive", "value"])
                    names, records = [], []
        if records:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(records)], ["archive", "value"])

    built = pages.mapInArrow(build, "archive string, value string")
    built.write.option("compression", "gzip").option("lineSep", "\r\n").partitionBy("archive").text(folder)


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Captures of all archives below ``folder``; those of one archive are a sorted run, numbered by ``seq``."""

    def read(batches):
        for b in batches:
            for path, content in zip(b.column(0), b.column(1)):
                found = [(c[0], c[1], c[2], offset, length, *c[3:]) for offset, length, headers, block in parse(gzip.decompress(content.as_py())) for c in [capture(headers, block)]]
                found.sort(key=lambda c: (c[0], c[1], c[2] is not None, c[2] or 0, c[3]))
                name = path.as_py().rsplit("/archive=", 1)[-1]
                for a in range(0, len(found), BATCH):
                    rows = [(name, a + i, *c) for i, c in enumerate(found[a : a + BATCH])]
                    yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows), kinds)], names)

    names = [x.split(" ")[0] for x in CAPTURE.split(", ")]
    kinds = [pa.int64() if x.endswith(" long") else pa.string() for x in CAPTURE.split(", ")]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("path", "content").mapInArrow(read, CAPTURE)


def merge_runs(runs: DataFrame) -> DataFrame:
    """Captures in the order of URL key, time and page: ranges in partition order, each merged from its slices of the runs."""

    def merge(batches):
        rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if rows is None or not len(rows):
            return
        slices: list[list[tuple]] = []
        starts: list[int] = []
        last = None
        columns = [rows[c].to_pylist() for c in ("run", "url_key", "captured", "page_id")]
        for i, (run, key, captured, page) in enumerate(zip(*columns)):
            if run != last:
                slices.append([])
                starts.append(i)
                last = run
            slices[-1].append((key, captured, page is not None, page or 0))
        order = [starts[run] + at for run, at in LoserTree(slices)]
        yield from rows.take(pa.array(order, pa.int64())).combine_chunks().to_batches(max_chunksize=BATCH)

    ranged = runs.repartitionByRange("url_key", "captured", "page_id", "run").sortWithinPartitions("run", "seq")
    return ranged.mapInArrow(merge, runs.schema)


def archive_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write all pages as archives, read them back, merge their index: one row per page, in global capture order."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "archives")
    write_archives(with_record_types(pages, page_id, url, html), folder)
    return merge_runs(written(read_runs(spark, folder), "runs")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", F.col("run").alias("archive"), "offset", "length"
    )


@query("op8_warc")
def warc_query(spark: SparkSession, folder: str) -> DataFrame:
    return archive_pages(table(spark, folder, "pages"))
