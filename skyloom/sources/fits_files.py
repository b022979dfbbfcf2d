"""FITS files as a source and a sink of Spark: spark.read.format("fits_images"), df.write.format("fits_images").

    spark.dataSource.register(FitsImages)
    images = spark.read.format("fits_images").option("planes", "all").load(folder)
    images.write.format("fits_images").mode("append").save(folder)

Files are listed by the driver (names and sizes only) and dealt out by size; headers and pixels are read in tasks, of a file
with many planes only the bytes of those asked for. The sink writes one real file an image: tasks write drafts into a hidden
folder of the job, and the driver moves those of the attempts that count into place once all tasks are done, so that a failed
task or job leaves no image. Neither keeps more than one image at a time.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from dataclasses import dataclass
from fnmatch import fnmatch

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from skyloom.sources import files, fits

SCHEMA = "path string, plane int, header map<string,string>, history string, nx int, ny int, pixels array<double>"
#: Bytes of files that a task reads; a larger file is a task's own.
TASK_BYTES = 128 << 20
#: Bytes read at once while a header's end is looked for.
HEAD = 16 * fits.BLOCK
#: Header keys that describe samples as they lay in the file; pixels are scaled when they are read.
OF_SAMPLES = ("SIMPLE", "BITPIX", "NAXIS", "BSCALE", "BZERO", "EXTEND", "BLANK", "DATAMAX", "DATAMIN")


def listed(path: str) -> list[tuple[str, int]]:
    """Names and sizes of the files of a folder, a file, or a folder's files by a pattern of their name; hidden ones are left out."""
    from pyarrow import fs

    where, inner = files.opened(path)
    info = where.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    folder, _, pattern = (inner, "", "*") if info.type == fs.FileType.Directory else inner.rpartition("/")
    found = where.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    prefix = path if pattern == "*" and info.type == fs.FileType.Directory else path.rpartition("/")[0]
    kept = [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")) and not f.base_name.endswith(".draft") and fnmatch(f.base_name, pattern)]
    return sorted((f"{prefix.rstrip('/')}/{f.base_name}", f.size) for f in kept)


def planes_of(text: str) -> list[int] | None:
    """Numbers and ranges ("0,2-4") as a list, "all" as None."""
    if text.strip().lower() == "all":
        return None
    out: list[int] = []
    for part in text.split(","):
        first, _, last = part.partition("-")
        out += range(int(first), int(last or first) + 1)
    return out


def head_of(f, name: str) -> tuple[dict[str, str], str, int]:
    """Header, history and where the data begin, from an open file, read no further than needed."""
    raw = b""
    while True:
        more = f.read_at(HEAD, len(raw))
        raw += more
        if not raw.startswith(b"SIMPLE"):
            raise ValueError(f"no reader for {name}")
        try:
            return fits.parse_header(raw)
        except ValueError:
            if len(more) < HEAD:
                raise ValueError(f"no END card in {name}") from None


def images_in(name: str, planes: list[int] | None, pixels: bool):
    """Rows of SCHEMA, plane by plane. A plane that the file does not have is an error."""
    where, path = files.opened(name)
    with where.open_input_file(path) as f:
        header, history, at = head_of(f, name)
        axes = [int(header[f"NAXIS{i}"]) for i in range(1, int(header["NAXIS"]) + 1)]
        if len(axes) < 2:
            raise ValueError(f"{name} is not an image of two axes")
        kind, (nx, ny), count = np.dtype(fits.DTYPES[int(header["BITPIX"])]), axes[:2], int(np.prod(axes[2:], dtype=np.int64))
        size = nx * ny * kind.itemsize
        for plane in range(count) if planes is None else planes:
            if plane >= count:
                raise ValueError(f"{name} has no plane {plane}")
            values = None
            if pixels:
                raw = f.read_at(size, at + plane * size)
                if len(raw) < size:
                    raise ValueError(f"{name} ends within plane {plane}")
                stored = np.frombuffer(raw, kind).reshape(ny, nx).T
                data = stored.astype(float) * float(header.get("BSCALE", 1)) + float(header.get("BZERO", 0))
                if kind.kind != "f" and "BLANK" in header:
                    data[stored == int(header["BLANK"])] = np.nan
                values = data.ravel()
            yield name, plane, list(header.items()), history, nx, ny, values


@dataclass
class Files(InputPartition):
    names: list[str]
    planes: list[int] | None


class FitsReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.planes = options["path"], planes_of(options.get("planes", "0"))
        self.pixels = options.get("pixels", "true").lower() == "true"
        self.most = int(options.get("taskbytes", TASK_BYTES))

    def partitions(self):
        paths = json.loads(self.path) if self.path.startswith("[") else [self.path]
        bundles, size = [], self.most
        for name, n in (f for p in paths for f in listed(p)):
            if size + n > self.most:
                bundles.append([])
                size = 0
            bundles[-1].append(name)
            size += n
        if self.planes is not None:  # planes asked for by number are read side by side
            return [Files(b, [p]) for b in bundles for p in self.planes]
        return [Files(b, self.planes) for b in bundles]

    def read(self, partition):
        import pyarrow as pa

        kinds = [pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.float64())]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for name in partition.names if partition is not None else []:
            for row in images_in(name, partition.planes, self.pixels):
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)


@dataclass
class Written(WriterCommitMessage):
    names: list[tuple[str, str]]


class FitsWriter(DataSourceArrowWriter):
    """One file an image under its `name`, else the last part of its `path`, plane and all; a name that comes twice is an error."""

    def __init__(self, options, columns, overwrite):
        self.folder, self.overwrite = options["path"].rstrip("/"), overwrite
        missing = {"header", "nx", "ny", "pixels"} - set(columns)
        if missing or not {"name", "path"} & set(columns):
            raise ValueError(f"an image to write needs name or path, header, nx, ny and pixels; missing: {sorted(missing) or 'name'}")
        self.job = f"{self.folder}/_{uuid.uuid4()}"

    def write(self, iterator):
        made = []
        files.folder(self.job)
        for batch in iterator:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names if c in ("name", "path", "plane", "header", "history", "nx", "ny", "pixels")}
                name = self._name({k: v.as_py() for k, v in row.items() if k in ("name", "path", "plane")})
                pixels = np.asarray(row["pixels"].values, float).reshape(row["nx"].as_py(), row["ny"].as_py())
                header = {k: v for k, v in row["header"].as_py() or [] if not k.startswith("NAXIS") and k not in OF_SAMPLES}
                draft = f"{self.job}/{uuid.uuid4()}"
                files.put(draft, fits.render(pixels, header, row["history"].as_py() if "history" in row else None))
                made.append((draft, name))
        return Written(made)

    @staticmethod
    def _name(row: dict) -> str:
        if row.get("name"):
            if "/" in row["name"]:
                raise ValueError(f"{row['name']} names a folder")
            return row["name"]
        if not row.get("path"):
            raise ValueError("an image has neither name nor path")
        base = row["path"].rsplit("/", 1)[-1]
        stem, dot, end = base.rpartition(".")
        return f"{stem}.{row['plane']}.{end}" if row.get("plane") and dot else base

    def commit(self, messages):
        moves = [m for message in messages if message is not None for m in message.names]
        names = [n for _, n in moves]
        there = set(files.names(self.folder)) if moves else set()
        twice = {n for n, times in Counter(names).items() if times > 1}
        if twice or (not self.overwrite and there & set(names)):
            self._clear()
            raise ValueError(f"images that are there already or come twice: {sorted(twice or there & set(names))[:5]}")
        where, _ = files.opened(self.folder)
        for draft, name in moves:  # as other committers do, by name alone
            where.move(files.opened(draft)[1], files.opened(f"{self.folder}/{name}")[1])
        if self.overwrite:
            for name in there - set(names):
                if not name.startswith(("_", ".")):
                    files.remove(f"{self.folder}/{name}")
        self._clear()

    def abort(self, messages):
        self._clear()

    def _clear(self):
        from pyarrow import fs

        where, path = files.opened(self.job)
        if where.get_file_info(path).type == fs.FileType.Directory:
            where.delete_dir(path)


class FitsImages(DataSource):
    """Options to read: path (a folder, file, pattern of names, or a JSON list of them), planes ("0", "0,2-4", "all"),
    pixels ("false": headers alone), taskbytes. Modes to write: append (names that are there are an error) and overwrite."""

    @classmethod
    def name(cls):
        return "fits_images"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return FitsReader(self.options)

    def writer(self, schema, overwrite):
        return FitsWriter(self.options, schema.names, overwrite)
