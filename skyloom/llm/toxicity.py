"""Toxicity by compression distance with two zstandard dictionaries.

Each class gets a dictionary of what is typical of it: word parts, found by their GRAM-byte pieces, that documents of
the class hold `ratio` times as often as those of the other. A window (a word between blanks; long ones are cut into
overlapping pieces of 64 bytes) is compressed with either dictionary; its distance is how many bytes shorter the toxic
one makes it. A document's distance is the sum of its `top` largest positive ones. The threshold is the one that best
separates labelled documents that the dictionaries of a first fit have not seen; the final dictionaries come from all
of the sample.

The fit is on the driver, on the distinct windows (made in tasks) of at most `toxic_rows` and `plain_rows` labelled rows,
the first by a hash of doc_id, one row for each doc_id; near copies, told by their least hashes of long words, count
once. Scoring reads every whole text, and words met before are looked up.

Defined results: a null or empty text has distance 0. Repeated rows score alike. Without labelled rows of both classes
dictionaries are empty and no document is predicted toxic. doc_id, lang and source are no inputs of a score. An empty
table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, DoubleType, StructField, StructType

from skyloom.llm.common import table

GRAM = 6
RATIO = 20
TOP = 2
TOXIC_ROWS, PLAIN_ROWS = 2000, 4000
DICTIONARY = 32768
CUT = 0.7
PIECE = 64
TAIL = b"\0" * 64  # makes every frame compress, so that lengths differ by what the dictionary gives


def windows(text: str | None) -> list[bytes]:
    found = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if any(len(w) > PIECE for w in found):
        found = [w[a : a + PIECE] for w in found for a in range(0, max(1, len(w) - PIECE // 2), PIECE // 2)]
    return found


def padded(text: str | None) -> list[bytes]:
    """A text's distinct windows between blanks, sorted."""
    return sorted({b" " + w + b" " for w in windows(text)})


def unlike(docs: list[list[bytes]]) -> list[list[bytes]]:
    """One document, given as its padded windows, of those with the same four least hashes of long windows."""
    kept = {}
    for own in docs:
        if own:
            long = [w for w in own if len(w) > 9] or own
            kept.setdefault(tuple(sorted(map(zlib.crc32, long))[:4]), own)
    return list(kept.values())


def apart(texts: list[str]) -> list[list[bytes]]:
    """Each text's distinct padded windows; one text of those that are near copies."""
    return unlike([padded(t) for t in texts])


def grams(doc: list[bytes], size: int) -> set[bytes]:
    return {w[i : i + size] for w in doc for i in range(len(w) - size + 1)}


def dictionary(own: list[list[bytes]], other: list[list[bytes]], size: int = GRAM, ratio: float = RATIO, room: int = DICTIONARY) -> bytes:
    """Parts of words typical of the first documents, commonest last, where matches are cheapest."""
    if not own or not other:
        return b""
    here = Counter(g for d in own for g in grams(d, size))
    least = max(3, len(own) // 80, int(len(own) ** 0.5 / 3))
    here = {g: n for g, n in here.items() if n >= least}
    there = Counter(g for d in other for g in grams(d, size) if g in here)
    typical = {g for g, n in here.items() if n * len(other) >= ratio * (there[g] + 0.5) * len(own)}
    parts: Counter = Counter()
    for d in own:
        found = set()
        for w in d:
            hit = [i for i in range(len(w) - size + 1) if w[i : i + size] in typical]
            for i in hit:
                if i - 1 not in hit:
                    z = i
                    while z + 1 in hit:
                        z += 1
                    found.add(w[i : z + size])
        parts.update(found)
    out = b""
    for part, _ in sorted(parts.items(), key=lambda x: (-x[1], x[0])):
        if part not in out and len(out) + len(part) < room:
            out = part + b"\xff" + out  # \xff is in no text, so matches stay within a part
    return out


class Meter:
    """A window's distance: bytes with the ordinary dictionary less bytes with the toxic one."""

    def __init__(self, toxic: bytes, plain: bytes, size: int = GRAM, keep: int = 200_000):
        import zstandard as z

        def compressor(raw: bytes):
            p = z.ZstdCompressionParameters.from_level(1, strategy=z.STRATEGY_FAST, min_match=size, window_log=17, hash_log=16, write_checksum=0, write_content_size=0, write_dict_id=0, format=z.FORMAT_ZSTD1_MAGICLESS)
            return z.ZstdCompressor(compression_params=p, dict_data=z.ZstdCompressionDict(raw.rjust(8, b"\0"), dict_type=z.DICT_TYPE_RAWCONTENT))

        self.toxic, self.plain, self.keep, self.known = compressor(toxic), compressor(plain), keep, {}

    def distance(self, text: str | None, top: int = TOP) -> int:
        known, found = self.known, []
        for w in windows(text):
            d = known.get(w)
            if d is None:
                if len(known) > self.keep:
                    known.clear()
                x = b" " + w + b" " + TAIL
                d = known[w] = len(self.plain.compress(x)) - len(self.toxic.compress(x))
            if d > 0:
                found.append(d)
        return sum(sorted(found)[-top:])


def threshold(toxic: list[int], plain: list[int]) -> int:
    """The distance from which a document is toxic: least missed share plus ten times the share of false alarms, the middle of equals."""
    errors = {t: sum(d < t for d in toxic) / len(toxic) + 10 * sum(d >= t for d in plain) / len(plain) for t in range(1, max([1, *toxic, *plain]) + 2)}
    best = [t for t, e in errors.items() if e == min(errors.values())]
    return best[len(best) // 2]


class Model:
    """From documents of both classes, each given as its padded windows."""

    def __init__(self, toxic: list[list[bytes]], plain: list[list[bytes]]):
        a, b = unlike(toxic), unlike(plain)
        self.limit = 2 * TOP
        if len(a) >= 8 and len(b) >= 8:
            first = Meter(dictionary(a[::2], b[::2]), dictionary(b[::2], a[::2]))
            score = lambda d: first.distance(b"".join(d).decode("utf-8", "replace"))
            self.limit = threshold([score(d) for d in a[1::2]], [score(d) for d in b[1::2]])
        self.toxic, self.plain = dictionary(a, b), dictionary(b, a)

    def score(self, distance: int) -> float:
        return 1 / (1 + math.exp(-(math.log(CUT / (1 - CUT)) + distance - (self.limit - 0.5))))


def held_out(doc_id):
    """Rows kept from learning: crc32 of the id's digits leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame, chosen: DataFrame, of, kind: DataType) -> list[dict]:
    """__id, __y, x = of(text), of the Spark type `kind`, in order of __id: a row for each of chosen(__id, __y) that docs has.

    x is made in tasks, so no text reaches the driver; of rows that share a doc_id the greatest x counts, so there are
    never more rows than chosen ones.
    """

    def run(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([of(t) for t in b.column(2).to_pylist()], type_)], names=["__id", "__y", "x"])

    from pyspark.sql.pandas.types import to_arrow_type

    type_ = to_arrow_type(kind)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("__id", "__y", "text")
    made = rows.mapInArrow(run, StructType([*rows.schema.fields[:2], StructField("x", kind)]))
    return sorted(made.groupBy("__id", "__y").agg(F.max("x").alias("x")).toArrow().to_pylist(), key=lambda r: r["__id"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", toxic_rows: int = TOXIC_ROWS, plain_rows: int = PLAIN_ROWS) -> Model:
    """A model from labels(doc_id, 0/1) of rows that are not held out."""
    own = labels.filter(~held_out("doc_id") & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__id"), F.col(label).alias("__y"))
    pick = lambda y, n: own.filter(F.col("__y") == y).dropDuplicates(["__id"]).orderBy(F.xxhash64(F.lit(13), "__id"), "__id").limit(n)
    joined = lambda t: b"\n".join(padded(t))  # noqa: E731  # no window holds a line's end; an array would take twice the bytes
    rows = labelled(docs, pick(1, toxic_rows).unionByName(pick(0, plain_rows)), joined, BinaryType())
    return Model(*([r["x"].split(b"\n") for r in rows if r["__y"] == y and r["x"]] for y in (1, 0)))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with one more column, the score of text; a column of that name in docs is an error."""
    if name in docs.columns:
        raise ValueError(f"docs has a column {name} already")
    toxic, plain, of = model.toxic, model.plain, model.score

    def run(batches):
        import pyarrow as pa

        meter = Meter(toxic, plain)
        for batch in batches:
            yield batch.append_column(name, pa.array([of(meter.distance(t)) for t in batch.column("text").to_pylist()], pa.float64()))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def reject(docs: DataFrame, labels: DataFrame, cut: float = CUT, source: DataFrame | None = None) -> DataFrame:
    """docs without those predicted toxic, columns as given. source: where the labelled texts are, if not in docs."""
    name = "__score"
    while name in docs.columns:
        name += "_"
    return score(docs, fit(docs if source is None else source, labels), name).filter(F.col(name) < cut).select(docs.columns)


def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = score(docs.select("doc_id", "text"), fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
