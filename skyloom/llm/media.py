"""Interleaved document sequences: ordered text and media-reference structs, with payloads resolved by digest.

`interleave` parses each page's HTML into an array of parts in document order. A part is text, or a media reference with
its src, its digest (of a src `sha256:...`), caption (the figcaption of its figure, else the alt text) and size;
`position` counts parts from 0, so what a caption belongs to stays known however payloads are fetched. `resolve` explodes
the references, joins a media store on the digest and keeps (doc_id, position): payloads never enter the arrays.

The store holds each distinct payload once, as an 8-bit greyscale PNG of rows of 192 samples. Payloads are combined by
digest before and after the one exchange that deals them, so a payload that a third of all documents share is one row;
what is derived from stored bytes is derived once for each digest, and only that is joined to the references.

Defined results: null HTML has no parts; a null text is the empty payload, padded to one row. A block tag, opening or
closing, and a media tag end a part of text; other tags do not. White space in a part is collapsed, parts without any
text are left out. What is in script, style, title and template is skipped, media and captions too, up to the closing tag
(a title without one ends at the next block tag, a template at the page's end). A caption ends at
</figcaption>, at </figure>, at the next figure or at the page's end, whichever comes first; it belongs to all media of
its figure, and where there are none it is text. References without a digest or stored payload keep null columns.
Repeated rows give repeated sequences. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from html import escape
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import table

ROW = 192
PARTS = "array<struct<position:int,kind:string,text:string,src:string,digest:string,caption:string,bytes:bigint>>"
BLOCK = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "br", "article", "section", "tr", "figure", "ul", "ol", "table", "footer", "nav", "header", "main", "aside", "blockquote", "pre", "body", "head", "html", "hr", "td", "th"}
SKIPPED = ("script", "style", "title", "template")
MEDIA = ("img", "video", "audio", "source")
SIGNATURE = b"\x89PNG\r\n\x1a\n"


class Parts(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.words, self.skipped, self.caption, self.figure = [], [], [], None, None

    def add(self, kind, **fields):
        self.parts.append({"position": len(self.parts), "kind": kind} | dict.fromkeys(("text", "src", "digest", "caption", "bytes")) | fields)

    def flush(self):
        if self.caption is not None:
            self.caption.append(" ")
        text = " ".join("".join(self.words).split())
        self.words = []
        if text:
            self.add("text", text=text)

    def end_caption(self):
        if self.caption is None:
            return
        text, self.caption = " ".join("".join(self.caption).split()), None
        for i in self.figure or []:
            self.parts[i]["caption"] = text
        if not self.figure and text:
            self.add("text", text=text)

    def end_title(self, tag):
        """A title holds no blocks, so one ends it if nothing did."""
        if tag in BLOCK and self.skipped and self.skipped[-1] == "title":
            self.skipped.pop()

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        self.end_title(tag)
        if tag in SKIPPED:
            self.skipped.append(tag)
        elif self.skipped:
            return
        elif tag == "figcaption":
            self.end_caption()
            self.flush()
            self.caption = []
        elif tag in MEDIA and a.get("src"):
            self.flush()
            size, src = a.get("data-bytes") or "", a["src"]
            self.add("media", src=src, digest=src[7:] if src.startswith("sha256:") else None, caption=a.get("alt"), bytes=int(size) if size.isdigit() and size.isascii() else None)
            if self.figure is not None:
                self.figure.append(len(self.parts) - 1)
        elif tag in BLOCK:
            if tag == "figure":
                self.end_caption()
            self.flush()
            if tag == "figure":
                self.figure = []

    def handle_startendtag(self, tag, attrs):
        if tag not in SKIPPED:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.end_title(tag)
        if tag in SKIPPED:
            if tag in self.skipped:
                del self.skipped[len(self.skipped) - 1 - self.skipped[::-1].index(tag) :]
        elif self.skipped:
            return
        elif tag == "figcaption":
            self.end_caption()
        elif tag in BLOCK:
            if tag == "figure":
                self.end_caption()
                self.figure = None
            self.flush()

    def handle_data(self, data):
        if self.skipped:
            return
        (self.words if self.caption is None else self.caption).append(data)


def parts_of(html: str | None) -> list[dict]:
    parser = Parts()
    parser.feed(html or "")
    parser.close()
    parser.end_caption()
    parser.flush()
    return parser.parts


def interleave(pages: DataFrame) -> DataFrame:
    """pages(doc_id, html) -> doc_id, parts."""

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("src", pa.string()), ("digest", pa.string()), ("caption", pa.string()), ("bytes", pa.int64())]))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([parts_of(h) for h in batch.column(1).to_pylist()], kind)], names=["doc_id", "parts"])

    return pages.select("doc_id", "html").mapInArrow(run, f"doc_id long, parts {PARTS}")


def resolve(sequences: DataFrame, store: DataFrame) -> DataFrame:
    """doc_id, n_parts, position, src, digest, caption, bytes of each media reference, with the store's other columns."""
    refs = sequences.select("doc_id", F.size("parts").alias("n_parts"), F.explode(F.filter("parts", lambda p: p["kind"] == "media")).alias("part")).select("doc_id", "n_parts", "part.position", "part.src", "part.digest", "part.caption", "part.bytes")
    return refs.join(store, "digest", "left")


def payload(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b" " * (max(1, -(-len(raw) // ROW)) * ROW - len(raw))


def to_png(samples: bytes) -> bytes:
    """Rows of ROW 8-bit grey samples."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + samples[i : i + ROW] for i in range(0, len(samples), ROW))
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", ROW, len(samples) // ROW, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 1)) + chunk(b"IEND", b"")


def from_png(stored: bytes) -> bytes:
    if not stored.startswith(SIGNATURE):
        raise ValueError("not a PNG")
    at, data, width, height = 8, [], 0, 0
    while at < len(stored):
        size, kind = struct.unpack(">I4s", stored[at : at + 8])
        body = stored[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack(">I", stored[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("a chunk's checksum differs")
        if kind == b"IHDR":
            width, height = struct.unpack(">II", body[:8])
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + size
    rows = zlib.decompress(b"".join(data))
    if len(rows) != height * (width + 1) or any(rows[:: width + 1]):
        raise ValueError("rows are not plain")
    return b"".join(rows[i + 1 : i + 1 + width] for i in range(0, len(rows), width + 1))


def feature_of(samples: bytes) -> str:
    """Height, mean sample, and shares of 16 sample ranges in thousandths."""
    import numpy as np

    x = np.frombuffer(samples, np.uint8)
    bins = np.bincount(x >> 4, minlength=16) * 1000 // len(x)
    return f"g8:{ROW}x{len(x) // ROW}:m{int(x.astype(np.int64).sum()) * 1000 // len(x)}:h{'.'.join(map(str, bins.tolist()))}"


def pages_of(docs: DataFrame) -> DataFrame:
    """doc_id, html: each document as a page: a paragraph for each line, and after the first a figure of its payload."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            pages = []
            for t in batch.column(1).to_pylist():
                n, p = payload(t)
                first, *rest = (t or "").split("\n")
                figure = f'<figure><img src="sha256:{hashlib.sha256(p).hexdigest()}" alt="" data-bytes="{n}"><figcaption>{n} bytes as samples</figcaption></figure>'
                pages.append(f"<article><p>{escape(first)}</p>{figure}{''.join(f'<p>{escape(x)}</p>' for x in rest)}</article>")
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(pages, pa.string())], names=["doc_id", "html"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, html string")


def store_of(docs: DataFrame) -> DataFrame:
    """digest, media: each distinct payload once, stored."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            met, media = [], []
            for t in dict.fromkeys(x or "" for x in batch.column(0).to_pylist()):
                p = payload(t)[1]
                met.append(hashlib.sha256(p).hexdigest())
                media.append(to_png(p))
            yield pa.RecordBatch.from_arrays([pa.array(met, pa.string()), pa.array(media, pa.binary())], names=["digest", "media"])

    return docs.select("text").mapInArrow(run, "digest string, media binary").groupBy("digest").agg(F.first("media").alias("media"))


def read_back(store: DataFrame) -> DataFrame:
    """digest, and what the stored bytes of media hold."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for stored in batch.column(1).to_pylist():
                p = from_png(stored)
                rows.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature_of(p)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return store.select("digest", "media").mapInArrow(run, "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op2_media(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = resolve(interleave(pages_of(docs)), read_back(store_of(docs)))
    return found.select("doc_id", F.col("bytes").alias("n_bytes"), "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "n_parts", "caption")
