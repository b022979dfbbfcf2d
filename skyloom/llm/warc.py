"""WARC archives: pages as records, archives made of one gzip stream rewritten record by record, reading by offsets.

`write` makes the archives that careless crawlers leave: one gzip stream over a whole file, in which no record can be
reached without inflating all before it. `normalise` mends such archives: a task inflates each once, as a stream, and
writes every record as a gzip member of its own, beside an index of lines (JSON) with each member's offset and length.
`read` takes the index by ranges of bytes, so that an archive of any size is read by many tasks, each member alone.

An archive is written under a name that no other attempt of a task has, and counts once its name is in the manifest, a
table written at the job's end; what a lost task left behind has no name there. Whatever passes through a task is taken
in pieces of CHUNK bytes, except a payload that is to be returned.

Of rows of equal payloads of `least` bytes or more, those of the smallest page_id are response records, and the others
revisit records: without the payload, but with its digest, its length in the HTTP head, and the response they refer to.

Defined results: a null html is empty. A null page_id is greater than all others; where all of a payload's are null, all
are responses. Rows that repeat a page_id share a record's id, so rows that repeat the smallest are all responses. A null
url leaves its header out; blanks, controls and what is not ASCII are percent-encoded in it. An empty table makes no
archive and gives no rows. Other columns are not read. `normalise` takes archives of any number of members, and ones not
compressed; one that ends too soon or is damaged keeps the whole records before that and has a `problem` in its manifest row.
`read` raises an error where a member is not what its headers say.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import cut, parts_for, shared_folder, table

LEAST = 100
#: Bytes of records for an archive, and of archives for a reading task.
ARCHIVE, READ = 64 << 20, 16 << 20
CHUNK, MOST_HEAD = 1 << 20, 1 << 20
#: Rows of digests that occur more than once up to which they are sent to all tasks (some 100 bytes each).
MOST_SENT = 100_000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:page:"
MANIFEST = "file string, sidecar string, records long, bytes long, problem string"
ENTRY = "file string, offset long, length long, type string, id string"


# -- files: any file system that pyarrow knows --------------------------------------------------------------------------


def opened(uri: str):
    """The file system and path of a URI or an absolute path."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def folder(uri: str) -> str:
    where, path = opened(uri)
    where.create_dir(path, recursive=True)
    return uri


# -- records ------------------------------------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, digest: str, size: int, payload: bytes | None, first: int | None) -> tuple[bytes, bytes]:
    """Head and block of a record. payload None: a revisit of the page `first`."""
    head = [("WARC-Type", "response" if payload is not None else "revisit"), ("WARC-Record-ID", f"<{RECORD}{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))))))
    head.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if payload is None:
        head += [("WARC-Refers-To", f"<{RECORD}{first}>"), ("WARC-Profile", PROFILE)]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head), "\r\n"]).encode(), block


def headers(head: bytes) -> dict[str, str]:
    """Fields of a head by lower-case name; lines that begin with white space go on with the one before."""
    out, last = {}, None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if last and line.startswith((" ", "\t")):
            out[last] += " " + line.strip()
        elif ":" in line:
            last, value = (x.strip() for x in line.split(":", 1))
            out[last := last.lower()] = value
    return out


class Damaged(ValueError):
    """An archive that is not what it should be from here on."""


def inflated(source, chunk: int = CHUNK):
    """The bytes behind a stream of one gzip member or more, or of none, in pieces of at most `chunk`."""
    data = source.read(chunk)
    while len(data) < 5 and (more := source.read(chunk)):
        data += more
    if data[:5] == b"WARC/":
        while data:
            yield data
            data = source.read(chunk)
        return
    machine, begun = zlib.decompressobj(31), False
    while data:
        if not begun and not (data := data.lstrip(b"\0")):  # padding between members
            data = source.read(chunk)
            continue
        try:
            out = machine.decompress(data, chunk)
        except zlib.error as e:
            raise Damaged(f"not gzip: {e}") from None
        begun = True
        if out:
            yield out
        if machine.eof:
            data = machine.unused_data
            machine, begun = zlib.decompressobj(31), False
        else:
            data = machine.unconsumed_tail
        data = data or source.read(chunk)
    while begun and (out := machine.decompress(machine.unconsumed_tail, chunk)):
        yield out
    if begun and not machine.eof:
        raise Damaged("ends within a gzip member")


class Feed:
    """Pieces of bytes as a stream."""

    def __init__(self, pieces):
        self.pieces, self.held, self.late = pieces, b"", None

    def more(self) -> bool:
        """Another piece. Damage is told only once all before it is used up."""
        if self.late is None:
            try:
                self.held += next(self.pieces)
                return True
            except StopIteration:
                self.late = False
            except Damaged as e:
                self.late = e
        return False

    def head(self) -> bytes | None:
        """Up to and with the next empty line, blank lines before it left out; None at the end."""
        while True:
            self.held = self.held.lstrip(b"\r\n")
            at = self.held.find(b"\r\n\r\n")
            if at >= 0:
                out, self.held = self.held[: at + 4], self.held[at + 4 :]
                return out
            if len(self.held) > MOST_HEAD:
                raise Damaged("no end of a head")
            if not self.more():
                if self.late:
                    raise self.late
                if self.held:
                    raise Damaged("ends within a head")
                return None

    def take(self, n: int):
        """n bytes, in pieces."""
        while n:
            if not self.held and not self.more():
                raise self.late or Damaged("ends within a block")
            out, self.held = self.held[:n], self.held[n:]
            n -= len(out)
            yield out


def rewritten(source, out, index, name: str) -> tuple[int, int, str | None]:
    """Every record of source as a member of out, and its line in index. Number of records, bytes, and what went wrong."""
    feed, count, at = Feed(inflated(source)), 0, 0
    while True:
        try:
            head = feed.head()
            if head is None:
                return count, at, None
            fields = headers(head)
            if not head.startswith(b"WARC/") or not fields.get("content-length", "").isdigit():
                raise Damaged("not a record")
            member, written = zlib.compressobj(6, zlib.DEFLATED, 31), 0
            waiting = []  # a record is written once it is whole, unless it is long

            def put(data: bytes, end: bool = False):
                nonlocal written
                waiting.append(data)
                if end or sum(map(len, waiting)) > CHUNK:
                    out.write(b"".join(waiting))
                    written += sum(map(len, waiting))
                    waiting.clear()

            put(member.compress(head))
            for piece in feed.take(int(fields["content-length"])):
                put(member.compress(piece))
            put(member.compress(b"\r\n\r\n") + member.flush(), True)
        except Damaged as e:  # what was written of a long record has no line in the index
            return count, at, str(e)
        index.write((json.dumps({"file": name, "offset": at, "length": written, "type": fields.get("warc-type", ""), "id": fields.get("warc-record-id", "")}) + "\n").encode())
        at += written
        count += 1


def parsed(member: bytes) -> tuple[dict, dict, bytes]:
    """Fields of a record's and of its HTTP head, and the payload, of one member."""
    machine = zlib.decompressobj(31)
    raw = machine.decompress(member)
    if not machine.eof or machine.unused_data:
        raise Damaged("not one whole member")
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = headers(head)
    n = int(fields["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise Damaged("a block is not as long as its head says")
    if not fields.get("content-type", "").startswith("application/http"):
        return fields, {}, rest[:n]
    http, _, payload = rest[:n].partition(b"\r\n\r\n")
    return fields, headers(http), payload


def page_of(record_id: str) -> int | None:
    """The page of a record that `write` named; null for others."""
    tail = record_id.strip("<>").removeprefix(RECORD)
    return int(tail) if tail.removeprefix("-").isdigit() else None


def told(fields: dict, http: dict, payload: bytes) -> tuple[int, str]:
    """Length and SHA-256 of the full payload: a revisit's own words, else what was read, which its heads must not belie."""
    named = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") == "revisit":
        return int(http.get("content-length", 0)), named.removeprefix("sha256:")
    digest = hashlib.sha256(payload).hexdigest()
    if named.startswith("sha256:") and named != f"sha256:{digest}":
        raise Damaged("the payload is not what the head says")
    return len(payload), digest


# -- jobs ---------------------------------------------------------------------------------------------------------------


def planned(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """pages(page_id, url, html) -> page_id, url, payload, size, digest, first: the page to refer to, or null.

    Digests that repeat are sent to all tasks while they are at most MOST_SENT; beyond, those of more than a thousandth of
    all pages are (under a thousand), and the others are joined.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    sums = rows.select("page_id", "size", "digest")
    firsts = cut(sums.filter(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1"), 16)
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    if firsts.limit(MOST_SENT + 1).count() <= MOST_SENT:
        known = rows.join(F.broadcast(firsts.drop("n")), "digest", "left")
    else:
        hot = F.col("n") > pages.count() // 1000
        own = rows.join(F.broadcast(firsts.filter(hot).select("digest", F.col("first").alias("__hot"))), "digest", "left")
        key = F.when(F.col("__hot").isNull(), F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id").cast("string")))
        cold = firsts.filter(~hot).select(F.col("digest").alias("__key"), F.col("first").alias("__cold"))
        known = own.withColumn("__key", key).join(cold, "__key", "left").withColumn("first", F.coalesce("__hot", "__cold"))
    return known.select("page_id", "url", "payload", "size", "digest", refers.alias("first"))


def settled(manifest: DataFrame, home: str) -> DataFrame:
    """The manifest once its job is done: a table of one row an archive."""
    manifest.write.parquet(home)
    return manifest.sparkSession.read.schema(MANIFEST).parquet(home)


def write(rows: DataFrame, home: str, archive: int = ARCHIVE) -> DataFrame:
    """Rows of `planned` as archives of one gzip stream each under home; a task begins another at `archive` bytes. The manifest."""
    home = folder(f"{home.rstrip('/')}/whole-{uuid.uuid4()}")

    def run(batches):
        import pyarrow as pa

        where, path = opened(home)
        out = machine = name = None
        count = size = 0

        def row():
            out.write(machine.flush())
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((name, pa.string()), (None, pa.string()), (count, pa.int64()), (size, pa.int64()), (None, pa.string()))], names=["file", "sidecar", "records", "bytes", "problem"])

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "size", "digest", "first")]
            for i in range(batch.num_rows):
                page, url, payload, n, digest, first = (c[i].as_py() for c in columns)
                if out is None:
                    name, count, size = f"{home}/{uuid.uuid4()}.warc.gz", 0, 0
                    out, machine = where.open_output_stream(f"{path}/{name.rpartition('/')[2]}", compression=None), zlib.compressobj(6, zlib.DEFLATED, 31)
                for data in (*record(page, url, digest, n, payload if first is None else None, first), b"\r\n\r\n"):
                    out.write(machine.compress(data))
                    size += len(data)
                count += 1
                if size >= archive:
                    yield row()
                    out = None
        if out is not None:
            yield row()

    return settled(rows.mapInArrow(run, MANIFEST), f"{home}/manifest")


def normalise(archives: DataFrame, home: str) -> DataFrame:
    """archives(file, ...) rewritten under home, a member for each record, with a sidecar of offsets each. The manifest.

    An archive is one task's work and is never held as a whole.
    """
    home = folder(f"{home.rstrip('/')}/members-{uuid.uuid4()}")

    def run(batches):
        import pyarrow as pa

        where, path = opened(home)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                source, own = opened(file)
                name = str(uuid.uuid4())
                with source.open_input_stream(own, compression=None) as raw, where.open_output_stream(f"{path}/{name}.warc.gz", compression=None) as out, where.open_output_stream(f"{path}/{name}.index") as index:
                    records, size, problem = rewritten(raw, out, index, f"{home}/{name}.warc.gz")
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((f"{home}/{name}.warc.gz", pa.string()), (f"{home}/{name}.index", pa.string()), (records, pa.int64()), (size, pa.int64()), (problem, pa.string()))], names=["file", "sidecar", "records", "bytes", "problem"])

    files = archives.select("file")
    return settled(files.repartition(max(1, archives.count()), "file").mapInArrow(run, MANIFEST), f"{home}/manifest")


def index_of(manifest: DataFrame) -> DataFrame:
    """The lines of all sidecars: file, offset, length, type, id."""

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string()), ("id", pa.string())])
        for batch in batches:
            for sidecar in batch.column(0).to_pylist():
                where, path = opened(sidecar)
                lines = []
                with where.open_input_stream(path) as f:
                    rest = b""
                    while data := f.read(CHUNK):
                        *whole, rest = (rest + data).split(b"\n")
                        lines = [json.loads(x) for x in whole]
                        yield pa.RecordBatch.from_pylist(lines, schema=schema)

    return manifest.select("sidecar").mapInArrow(run, ENTRY)


def read(manifest: DataFrame, payloads: bool = True, each: int = READ) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload) of every record in the manifest's archives.

    Ranges of about `each` bytes of an archive are dealt to tasks by their index lines. A response's digest and length
    are computed from what was read, and its digest must be its head's; a revisit's are those of its heads. Records of
    other makers have a null page_id.
    """
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    lines = index_of(manifest).repartition(parts_for(total, each), "file", F.floor(F.col("offset") / each)).sortWithinPartitions("file", "offset")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if payloads else "")

    def run(batches):
        import pyarrow as pa

        kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), *([("payload", pa.binary())] if payloads else [])]
        current = f = None

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])

        for batch in batches:
            rows, held = [], 0
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                if file != current:
                    if f is not None:
                        f.close()
                    where, path = opened(file)
                    current, f = file, where.open_input_file(path)
                f.seek(offset)
                fields, http, payload = parsed(f.read(length))
                revisit = fields["warc-type"] == "revisit"
                rows.append((page_of(fields.get("warc-record-id", "")), fields.get("warc-target-uri"), *told(fields, http, payload), fields["warc-type"], page_of(fields.get("warc-refers-to", "")) if revisit else None, *([None if revisit else payload] if payloads else [])))
                held += len(payload) if payloads else 0
                if held > CHUNK:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    return lines.mapInArrow(run, schema)


def op13_warc(spark, sf_dir):
    home = shared_folder(spark) + "/warc"
    manifest = normalise(write(planned(table(spark, sf_dir, "pages")), home), home)
    if damaged := manifest.filter("problem is not null").limit(1).collect():
        raise Damaged(f"{damaged[0]['file']}: {damaged[0]['problem']}")
    return read(manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = f"""WITH p AS (SELECT page_id, CAST(strlen(COALESCE(html, '')) AS BIGINT) AS payload_bytes, sha256(COALESCE(html, '')) AS payload_digest FROM pages),
 f AS (SELECT payload_digest, MIN(page_id) AS first FROM p WHERE payload_bytes >= {LEAST} GROUP BY payload_digest)
 SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
 FROM p LEFT JOIN f USING (payload_digest)"""
