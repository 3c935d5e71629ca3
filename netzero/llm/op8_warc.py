"""WARC archives: writing, reading back, and a merged index of captures.

Writing: one record per page.  Of pages with equal payloads (SHA-1, and at
least ``min_revisit_bytes`` long) the one with the smallest page_id is a
``response``, the others are ``revisit`` records without the payload.  Records
are text (headers, blank line, HTTP headers, payload) that Spark's writer ends
with CRLF CRLF, which is the record separator of the format: the files are
WARC 1.1, gzip-compressed as a whole, ``records_per_file`` records each, and
are written wherever Spark can write.

Reading: every archive file is decompressed as a stream and cut by
Content-Length; digests of response payloads are recomputed and compared.  Each
file gives one capture run, sorted by (URL key, timestamp, page_id).

Index merge: the runs are dealt by key range (so the captures of one URL, even a
third of all, spread over tasks by time and id), and each range is merged by a
k-way loser tree over the pieces of the runs: one comparison per tree level and
record.  The ranges in order are the global capture histories;
(``merge_range``, ``merge_pos``) is a record's place in them.

Edge cases: null or empty html is an empty payload; null URL is an empty target
URI; white space in URLs is percent-encoded, so it cannot break a header.
page_id null sorts last and stays null.  Rows repeating the smallest page_id of
a payload are all responses.  An empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import scratch_path
from .common import stored, table

CRLF = "\r\n"
RECORDS_PER_FILE = 2000
MIN_REVISIT_BYTES = 0
#: First capture time; a page without a time is captured page_id seconds later.
EPOCH = "2024-01-01 00:00:00"
#: Captures to a range of the merge.
RANGE_ROWS = 250_000
_ID = "urn:x-page:"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: the base32 alphabet


def sha1_base32(payload):
    """Upper-case base32 SHA-1 of a binary column: five hex digits at a time are
    four base32 digits."""
    h = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def captures(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
             min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, uri, date, payload, digest, bytes, refers_to): one row per page.

    Only ids and digests are grouped; the payloads stay where they are read
    unless revisits are too many for Spark to broadcast them.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), r"[\x00-\x20\x7F]+", "%20").alias("uri"),
        payload.alias("payload"))
    digests = stored(rows.select("page_id", sha1_base32(F.encode("payload", "UTF-8")).alias("digest"),
                                 F.octet_length("payload").cast("long").alias("bytes")), "warc-digests")
    first = digests.where(F.col("bytes") >= min_revisit_bytes).groupBy("digest").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = stored(
        digests.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .where(F.col("refers_to").isNotNull())
        .select(F.col("page_id").alias("k"), F.col("digest").alias("k_digest"), "refers_to").distinct(), "warc-revisits")
    rows = rows.withColumns({"digest": sha1_base32(F.encode("payload", "UTF-8")),
                             "bytes": F.octet_length("payload").cast("long")})
    date = F.date_format(F.to_timestamp(F.lit(EPOCH)) + F.make_dt_interval(
        secs=F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(1 << 31)).cast("decimal(18,6)")),
        "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.join(again, rows.page_id.eqNullSafe(again.k) & (rows.digest == again.k_digest), "left").select(
        "page_id", "uri", date.alias("date"), "payload", "digest", "bytes", "refers_to")


def records(caps: DataFrame) -> DataFrame:
    """(value): the text of each record up to its closing blank lines."""
    revisit = F.col("refers_to").isNotNull()
    line = lambda name, v: F.concat(F.lit(f"{name}: "), v, F.lit(CRLF))
    ident = lambda c: F.concat(F.lit(f"<{_ID}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
                    line("Content-Length", F.col("bytes").cast("string")), F.lit(CRLF))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", ident(F.col("page_id"))), line("WARC-Target-URI", F.col("uri")),
        line("WARC-Date", F.col("date")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", ident(F.col("refers_to"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF))
    return caps.select(F.concat(head, block).alias("value"))


def write_archives(caps: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    (records(caps).write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


# --- reading -----------------------------------------------------------------

def stream_records(chunks: Iterable[bytes]) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records of a decompressed archive."""
    source, buf, base = iter(chunks), bytearray(), 0

    def need(test: Callable[[], bool]) -> bool:
        while not test():
            part = next(source, None)
            if part is None:
                return False
            buf.extend(part)
        return True

    while need(lambda: len(buf) > 0):
        if not need(lambda: buf.find(b"\r\n\r\n") >= 0):
            raise ValueError(f"record at {base}: headers do not end")
        end = buf.find(b"\r\n\r\n")
        lines = bytes(buf[:end]).decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"record at {base}: no version line")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        start, size = end + 4, int(headers["Content-Length"])
        if not need(lambda: len(buf) >= start + size + 4):
            raise ValueError(f"record at {base}: cut short")
        yield base, headers, bytes(buf[start:start + size])
        del buf[:start + size + 4]
        base += start + size + 4


def inflate(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """Gzip members of ``data``, decompressed piece by piece."""
    while data:
        z = zlib.decompressobj(31)
        while data and not z.eof:
            part = z.decompress(data, step)
            data = z.unconsumed_tail
            yield part
        while not z.eof and (part := z.decompress(b"", step)):  # output still held back
            yield part
        data = z.unused_data


def url_key(url: str) -> str:
    """Sortable form of a URL: host labels reversed, then port, path and query, lower case."""
    try:
        u = urlsplit(url)
        host, port = (u.hostname or "").removeprefix("www."), u.port
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    at = f":{port}" if port and (u.scheme, port) not in (("http", 80), ("https", 443)) else ""
    return (",".join(reversed(host.split("."))) + at + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")).lower()


CAPTURE = ("urlkey string, timestamp string, page_id long, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long, run string, offset long, length long")


def _capture(offset: int, h: dict[str, str], block: bytes, run: str) -> tuple:
    number = lambda x: int(x) if x else None
    page = lambda name: number(h[name].removeprefix(f"<{_ID}").removesuffix(">")) if name in h else None
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(head.rpartition(b"Content-Length: ")[2])
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    if h["WARC-Type"] == "response" and (
            len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{run}, record at {offset}: the payload does not match its digest")
    stamp = "".join(c for c in h["WARC-Date"] if c.isdigit())
    return (url_key(h["WARC-Target-URI"]), stamp, page("WARC-Record-ID"), size, digest, h["WARC-Type"],
            page("WARC-Refers-To"), run, offset, len(block))


def _order(r: tuple) -> tuple:
    return r[0], r[1], r[2] is None, r[2] or 0, r[7], r[8]


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    columns = dict(zip(names, zip(*rows))) if rows else dict.fromkeys(names, ())
    # objects, column by column: a detour over floats would round large nullable ids
    return pd.DataFrame({c: pd.Series(list(v), dtype=object) for c, v in columns.items()})


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of the archives under ``path``, one sorted run per file."""
    names = [x.split()[0] for x in CAPTURE.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, content in zip(f["path"], f["content"]):
                rows = sorted((_capture(o, h, b, name.rpartition("/")[2]) for o, h, b in stream_records(inflate(content))), key=_order)
                yield _frame(rows, names)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content"))
    return files.mapInPandas(run, CAPTURE)


# --- index merge -------------------------------------------------------------

def loser_tree_merge(runs: list[list[tuple]], key: Callable[[tuple], tuple] = _order) -> Iterator[tuple]:
    """Merge sorted runs: inner nodes of a complete binary tree hold the loser
    of their match, so replacing the winner replays one path to the root."""
    k = len(runs)
    if not k:
        return
    at = [0] * k
    done = (1,)  # greater than every key, which start with 0
    head = [(0, *key(r[0])) if r else done for r in runs]
    beats = lambda i, j: (head[i], i) <= (head[j], j)
    tree, up = [0] * k, [0] * k + list(range(k))  # leaves k .. 2k-1
    for node in range(k - 1, 0, -1):
        a, b = up[2 * node], up[2 * node + 1]
        up[node], tree[node] = (a, b) if beats(a, b) else (b, a)
    winner = up[1] if k > 1 else 0
    while head[winner] != done:
        run = runs[winner]
        yield run[at[winner]]
        at[winner] += 1
        head[winner] = (0, *key(run[at[winner]])) if at[winner] < len(run) else done
        node = (winner + k) // 2
        while node:
            if beats(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Captures in global order: ``merge_range`` and ``merge_pos`` are added."""
    names = runs.columns
    # ids travel as text: Arrow hands nullable longs to pandas as floats
    text = lambda c: F.col(c).cast("string").alias(c) if c in ("page_id", "refers_to") else F.col(c)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces: dict[str, list[tuple]] = {}
        for f in frames:  # a range holds about range_rows index rows
            number = {c: [None if x is None else int(x) for x in f[c]] for c in ("page_id", "refers_to")}
            for r in zip(*(number.get(c, f[c]) for c in [*names, "merge_range"])):
                pieces.setdefault(r[7], []).append(r)
        merged = list(loser_tree_merge(list(pieces.values())))
        out = _frame([r[:len(names)] for r in merged], names)
        out["merge_range"] = pd.Series([r[len(names)] for r in merged], dtype=object)
        out["merge_pos"] = range(len(out))
        yield out

    n = max(1, -(-runs.count() // range_rows), runs.sparkSession.sparkContext.defaultParallelism)
    order = ["urlkey", "timestamp", F.col("page_id").isNull(), "page_id", "run", "offset"]
    dealt = runs.repartitionByRange(n, *order).sortWithinPartitions("run", *order[:4], "offset")
    return dealt.withColumn("merge_range", F.spark_partition_id()).select(*map(text, names), "merge_range").mapInPandas(
        run, f"{CAPTURE}, merge_range int, merge_pos long")


def archive_and_index(pages: DataFrame, path: str, **options) -> DataFrame:
    """Write ``pages`` as archives under ``path``, read them back, and return
    the merged index of their captures."""
    write_archives(captures(pages, **options), path)
    return merge_runs(stored(read_runs(pages.sparkSession, path), "warc-runs"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive_and_index(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    # the places in the merged index depend on the sampled ranges: the same order, other numbers on another cluster
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base32 in SQL: each five hexadecimal digits of the SHA-1 are four characters.
_DIGEST_SQL = "array_to_string(list_transform(range(8), lambda i: " + " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(sha1(h), CAST(5 * i + 1 AS INTEGER), 5) AS INTEGER) >> {b}) & 31) + 1, 1)"
    for b in (15, 10, 5, 0)) + "), '')"
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, {_DIGEST_SQL} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p
"""
