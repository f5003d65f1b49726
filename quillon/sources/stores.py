"""Matrices of cells as chunked stores in the layout that annotated-matrix libraries read (zarr version 2, encodings of AnnData and MuData), written and read by Spark.

Writing. Every array of a store, data, indices and indptr of sparse layers, blocks of dense ones, columns of the tables of rows and columns, is a set of chunks of fixed length. A row (array, chunk, at, number, text) is
one value; rows of a chunk go to one task, which holds one chunk at a time, so memory is a chunk whatever the matrix is. A value's place comes from its global rank among the layer's entries, and a
row's pointer from running sums of counts (`operators.ranges`). A chunk appears under its name when it is whole, and the descriptions without which a store can't be read are written by the driver when all tasks are done: what a lost task leaves is never part of a store.

Reading. A chunk is a partition. Conditions on the row number are pushed down: two look-ups in indptr give the chunks that hold these rows, and no others are opened.

Merging. Modalities get the rows of all of them, in the order of their names. Rows without entries change pointers only: chunks of data and indices are copied as files, by Spark's tasks.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from quillon.operators.ranges import ranked, running
from quillon.sources.files import _store
from quillon.sources.tables import materialise

#: Values of a one-dimensional chunk, and rows and columns of a block of a dense layer.
CHUNK, BLOCK = 1 << 18, (512, 512)
_VALUE = "array string, chunk string, at int, number double, text string"
_GROUP = {"zarr_format": 2}
#: What a padded cell has in a dense layer, and in columns of its table.
PADDED = {"bigint": 0, "double": 0.0, "boolean": False, "string": "na"}


@dataclass
class Layer:
    """A layer: the column of entries with its values; missing: None for a sparse one, or what a dense one has where there is no entry. kind: NumPy's name of the type."""

    column: str
    missing: float | None = None
    kind: str = "<f8"


def _array(shape: list[int], chunks: list[int], kind: str, fill) -> dict:
    filters = [{"id": "vlen-utf8"}] if kind == "|O" else None
    return {"zarr_format": 2, "shape": shape, "chunks": [max(1, c) for c in chunks], "dtype": kind, "compressor": {"id": "zlib", "level": 1}, "fill_value": "NaN" if fill is not None and fill != fill else fill, "order": "C", "filters": filters}


def _packed(values: np.ndarray | list, kind: str) -> bytes:
    if kind == "|O":
        raw = [(v or "").encode() for v in values]
        return zlib.compress(struct.pack("<I", len(raw)) + b"".join(struct.pack("<I", len(x)) + x for x in raw), 1)
    return zlib.compress(np.asarray(values).astype(kind).tobytes(), 1)


def _unpacked(raw: bytes, about: dict) -> np.ndarray | list:
    raw = zlib.decompress(raw)
    if about["dtype"] != "|O":
        return np.frombuffer(raw, about["dtype"])
    out, at = [], 4
    for _ in range(struct.unpack_from("<I", raw)[0]):
        n = struct.unpack_from("<I", raw, at)[0]
        out.append(raw[at + 4 : at + 4 + n].decode())
        at += 4 + n
    return out


# writing


@dataclass
class Done(WriterCommitMessage):
    chunks: int = 0


class Writer(DataSourceArrowWriter):
    """Values to chunks; about: every array's description and all attributes, by the paths of their files."""

    def __init__(self, path: str, about: dict[str, dict]) -> None:
        self.path, self.about = path, about

    def _chunk(self, array: str, chunk: str, at: np.ndarray, number: np.ndarray, text: list[str | None]) -> None:
        own = self.about[f"{array}/.zarray"]
        size = int(np.prod(own["chunks"]))
        if own["dtype"] == "|O":
            values: np.ndarray | list = [""] * size
            for i, v in zip(at.tolist(), text, strict=True):
                values[i] = v
        else:
            values = np.full(size, float(own["fill_value"] or 0))
            values[at] = number
        where, root = _store(self.path)
        where.create_dir(f"{root}/{array}", recursive=True)
        part = f"{root}/{array}/.{chunk}.{uuid.uuid4().hex}"
        with where.open_output_stream(part, compression=None) as f:
            f.write(_packed(values, own["dtype"]))
        where.move(part, f"{root}/{array}/{chunk}")  # whole from the first moment on; a task run twice writes the same again

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Done:
        """Rows come sorted by array and chunk."""
        held, key, n = [], None, 0

        def flush() -> None:
            b = pa.Table.from_batches(held)
            self._chunk(*key, b.column("at").to_numpy(), b.column("number").to_numpy(zero_copy_only=False), b.column("text").to_pylist())
            held.clear()

        for b in iterator:
            names = list(zip(b.column("array").to_pylist(), b.column("chunk").to_pylist(), strict=True))
            starts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
            for lo, hi in zip(starts, starts[1:], strict=False):
                if lo == hi:
                    continue
                if held and names[lo] != key:
                    flush()
                    n += 1
                key = names[lo]
                held.append(b.slice(lo, hi - lo))
        if held:
            flush()
            n += 1
        return Done(n)

    def commit(self, messages: list[Done | None]) -> None:
        where, root = _store(self.path)
        for name in sorted(self.about, key=lambda x: (x == ".zgroup", x)):  # the root's comes last
            where.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
            with where.open_output_stream(f"{root}/{name}", compression=None) as f:
                f.write(json.dumps(self.about[name]).encode())

    def abort(self, messages: list[Done | None]) -> None:
        """Nothing to take back: without descriptions there is no store."""


# reading


def _json(path: str, name: str) -> dict | None:
    where, root = _store(path)
    file = f"{root}/{name}"
    if not where.get_file_info(file).is_file:
        return None
    with where.open_input_stream(file, compression=None) as f:
        return json.loads(f.read())


class Array:
    """An array of a store; chunks are read when they are asked for, and the last one is kept."""

    def __init__(self, path: str, name: str) -> None:
        self.path, self.name, self.about, self.last, self.opened = path, name, _json(path, f"{name}/.zarray"), (None, None), 0

    def chunk(self, key: str) -> np.ndarray | list:
        if self.last[0] != key:
            where, root = _store(self.path)
            file = f"{root}/{self.name}/{key}"
            if where.get_file_info(file).is_file:
                with where.open_input_stream(file, compression=None) as f:
                    self.last = key, _unpacked(f.read(), self.about)
            else:
                fill = self.about["fill_value"]
                n = int(np.prod(self.about["chunks"]))
                self.last = key, [""] * n if self.about["dtype"] == "|O" else np.full(n, float(fill or 0)).astype(self.about["dtype"])
            self.opened += 1
        return self.last[1]

    def __getitem__(self, i: int):
        n = self.about["chunks"][0]
        return self.chunk(str(i // n))[i % n]

    def slice(self, lo: int, hi: int) -> np.ndarray:
        n = self.about["chunks"][0]
        return np.concatenate([self.chunk(str(k))[max(lo - k * n, 0) : hi - k * n] for k in range(lo // n, -(-hi // n))]) if hi > lo else np.empty(0)

    def rows_before(self, entry: int) -> int:
        """In an indptr: the row of an entry, by halving; as many chunks are opened as halvings need."""
        lo, hi = 0, self.about["shape"][0] - 1
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if self[mid] <= entry else (lo, mid)
        return lo


@dataclass
class Piece(InputPartition):
    chunk: int
    lo: int
    hi: int


class Reader(DataSourceReader):
    def __init__(self, path: str, node: str) -> None:
        self.path, self.node = path, node
        if _json(path, ".zgroup") is None:
            raise FileNotFoundError(f"no store at {path}")
        self.attributes = _json(path, f"{node}/.zattrs") or {}
        self.kind = self.attributes.get("encoding-type")
        self.low, self.high = 0, None

    def schema(self) -> str:
        if self.kind == "dataframe":
            names = [self.attributes["_index"], *self.attributes["column-order"]]
            types = {"|O": "string", "<i8": "long", "<f8": "double", "|b1": "boolean"}
            return "at long, " + ", ".join(f"`{c}` {types[Array(self.path, f'{self.node}/{c}').about['dtype']]}" for c in names)
        return "row long, col long, value double"

    def pushFilters(self, filters: list) -> Iterator:  # noqa: N802
        """Bounds of the row number stay with the source."""
        for f in filters:
            if getattr(f, "attribute", None) != ("at" if self.kind == "dataframe" else "row",) or not isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
                yield f
                continue
            lo = f.value + isinstance(f, GreaterThan) if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual) else 0
            hi = f.value + isinstance(f, EqualTo | LessThanOrEqual) if isinstance(f, EqualTo | LessThan | LessThanOrEqual) else None
            self.low = max(self.low, lo)
            self.high = hi if self.high is None else self.high if hi is None else min(self.high, hi)

    def partitions(self) -> list[Piece]:
        if self.kind == "csr_matrix":
            pointers = Array(self.path, f"{self.node}/indptr")
            n = pointers.about["shape"][0] - 1
            low, high = min(self.low, n), n if self.high is None else max(min(self.high, n), 0)
            first, last = (int(pointers[low]), int(pointers[high])) if low < high else (0, 0)
            size = Array(self.path, f"{self.node}/data").about["chunks"][0]
        else:
            name = f"{self.node}/{self.attributes['_index']}" if self.kind == "dataframe" else self.node
            about = Array(self.path, name).about
            n = about["shape"][0]
            first, last, size = min(self.low, n), n if self.high is None else max(min(self.high, n), 0), about["chunks"][0]
        return [Piece(k, max(first, k * size), min(last, (k + 1) * size)) for k in range(first // size, -(-last // size))] if last > first else [Piece(0, 0, 0)]

    def read(self, part: Piece) -> Iterator[pa.RecordBatch]:
        if part.lo >= part.hi:
            return
        lo, hi = part.lo, part.hi
        if self.kind == "csr_matrix":
            data, indices, pointers = (Array(self.path, f"{self.node}/{x}") for x in ("data", "indices", "indptr"))
            first, last = pointers.rows_before(lo), pointers.rows_before(hi - 1)
            ends = np.minimum(pointers.slice(first + 1, last + 2), hi)
            row = np.repeat(np.arange(first, last + 1), np.diff(np.concatenate(([lo], ends))).astype(np.int64))
            yield self._entries(row, indices.slice(lo, hi), data.slice(lo, hi))
        elif self.kind == "dataframe":
            cols = [Array(self.path, f"{self.node}/{c}") for c in (self.attributes["_index"], *self.attributes["column-order"])]
            at = lo % cols[0].about["chunks"][0]
            values = [c.chunk(str(part.chunk))[at : at + hi - lo] for c in cols]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(lo, hi)), *map(pa.array, values)], ["at", *[c.name.rpartition("/")[2] for c in cols]])
        else:
            dense = Array(self.path, self.node)
            (rows, cols), (height, width), fill = dense.about["shape"], dense.about["chunks"], float(dense.about["fill_value"])
            for j in range(-(-cols // width)):
                block = dense.chunk(f"{part.chunk}.{j}").reshape(height, width).astype(float)
                r, c = np.nonzero(~np.isnan(block) if fill != fill else block != fill)
                r = r + part.chunk * height
                keep = (r >= lo) & (r < hi)
                yield self._entries(r[keep], c[keep] + j * width, block[r[keep] - part.chunk * height, c[keep]])

    @staticmethod
    def _entries(row: np.ndarray, col: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(row.astype(np.int64)), pa.array(col.astype(np.int64)), pa.array(value.astype(float))], ["row", "col", "value"])


class Store(DataSource):
    @classmethod
    def name(cls) -> str:
        return "matrix_store"

    def schema(self) -> str:
        return Reader(self.options["path"], self.options["node"]).schema()

    def reader(self, schema) -> DataSourceReader:
        return Reader(self.options["path"], self.options["node"])

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return Writer(self.options["path"], json.loads(self.options["about"]))


def register(spark: SparkSession) -> None:
    """Also lets Spark push filters down to sources in Python."""
    spark.dataSource.register(Store)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, node: str = "X") -> DataFrame:
    """Entries (row, col, value) of X or of a layer (`layers/NAME`), or the table `obs` or `var` with its places as `at`."""
    register(spark)
    return spark.read.format("matrix_store").options(path=path, node=node).load()


# a store from entries


def _value(array: Column | str, chunk: Column, at: Column, number: Column | None = None, text: Column | None = None) -> list[Column]:
    array = F.lit(array) if isinstance(array, str) else array
    none = lambda c, t: (F.lit(None) if c is None else c).cast(t)
    return [array.alias("array"), chunk.cast("string").alias("chunk"), at.cast("int").alias("at"), none(number, "double").alias("number"), none(text, "string").alias("text")]


def _line(array: Column | str, place: Column, size: int, **value: Column) -> list[Column]:
    return _value(array, F.floor(place / size), place % size, **value)


def _frame(df: DataFrame, node: str, place: str, index: str, n: int, chunk: int) -> tuple[list[DataFrame], dict[str, dict]]:
    """Values and descriptions of a table's columns."""
    rows, about, names = [], {}, [c for c in df.columns if c not in (place, index)]
    for c in [index, *names]:
        kind = df.schema[c].dataType.simpleString()
        text = kind not in ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double") and not kind.startswith("decimal")
        dtype = "|O" if text else "|b1" if kind == "boolean" else "<i8" if kind.endswith("int") else "<f8"
        default = PADDED["string"] if text else float("nan") if dtype == "<f8" else 0
        value = F.coalesce(F.col(f"`{c}`").cast("string" if text else "double"), F.lit(default))
        rows.append(df.select(*_line(f"{node}/{c}", F.col(place), chunk, **{"text" if text else "number": value})))
        about |= {f"{node}/{c}/.zarray": _array([n], [chunk], dtype, "" if text else False if dtype == "|b1" else 0), f"{node}/{c}/.zattrs": {"encoding-type": "string-array" if text else "array", "encoding-version": "0.2.0"}}
    return rows, about | {f"{node}/.zgroup": _GROUP, f"{node}/.zattrs": {"encoding-type": "dataframe", "encoding-version": "0.2.0", "_index": index, "column-order": names}}


def _pointers(counts: DataFrame, chunk: int) -> DataFrame:
    """Values of every layer's indptr from (array, row, n), a row for each layer and row of the matrix."""
    upto = running(counts, "upto", "n", "array", "row").groupBy("array", "row").agg(F.max("upto").alias("upto"), F.max("n").alias("n"))
    start = materialise(upto.where("row = 0").select("array", (F.col("upto") - F.col("n")).alias("start")))  # a row for each layer
    at = upto.join(F.broadcast(start), "array").withColumn("v", F.col("upto") - F.col("start"))
    name = F.concat("array", F.lit("/indptr"))
    return at.select(*_line(name, F.col("row") + 1, chunk, number=F.col("v"))).union(start.select(*_line(name, F.lit(0), chunk, number=F.lit(0))))


def _dense(entries: DataFrame, name: str, value: Column, block: tuple[int, int]) -> DataFrame:
    key = F.concat_ws(".", F.floor(F.col("row") / block[0]).cast("string"), F.floor(F.col("col") / block[1]).cast("string"))
    return entries.select(*_value(name, key, F.col("row") % block[0] * block[1] + F.col("col") % block[1], number=value))


def _write(values: list[DataFrame], path: str, about: dict[str, dict]) -> None:
    spark = values[0].sparkSession
    register(spark)
    # chunks of the line begin with their number, so that the writer finds a chunk's rows together
    rows = reduce(DataFrame.union, values).repartition("array", "chunk").sortWithinPartitions("array", "chunk")
    rows.write.format("matrix_store").mode("append").options(path=path, about=json.dumps(about)).save()


def write(path: str, entries: DataFrame, obs: DataFrame, var: DataFrame, x: str, layers: dict[str, Layer], index: tuple[str, str], uns: dict | None = None, chunk: int = CHUNK, block: tuple[int, int] = BLOCK) -> None:
    """A store at path. entries: (row, col) and a column for X and each layer, once each; obs with row and var with col number the rows and columns from 0 without gaps; index: the columns of obs and of var that name them.

    Values of 0 are left out of sparse layers. Nulls of a table's columns become NaN, 0, false or "na".
    """
    n_rows, n_cols = obs.count(), var.count()
    sparse = {"X": Layer(x)} | {f"layers/{k}": v for k, v in layers.items() if v.missing is None}
    held = materialise(entries.select("row", "col", *dict.fromkeys(v.column for v in [Layer(x), *layers.values()])))
    flat = held.select("row", "col", F.explode(F.array(*[F.struct(F.lit(a).alias("array"), F.col(v.column).cast("double").alias("value")) for a, v in sparse.items()])).alias("x")).select("x.*", "row", "col").where("value <> 0")
    placed = materialise(ranked(flat, "_at", "array", "row", "col"))
    first = {r["array"]: (r["lo"], r["n"]) for r in placed.groupBy("array").agg(F.min("_at").alias("lo"), F.count("*").alias("n")).collect()}  # a row for each layer
    offset = F.create_map(*[F.lit(v) for a in sparse for v in (a, first.get(a, (1, 0))[0])])
    place = F.col("_at") - offset[F.col("array")]
    values = [placed.select(*_line(F.concat("array", F.lit(f"/{what}")), place, chunk, number=F.col(c))) for what, c in (("data", "value"), ("indices", "col"))]
    every = obs.select(F.explode(F.array(*map(F.lit, sparse))).alias("array"), F.col("row").cast("long").alias("row"))
    counts = every.join(placed.groupBy("array", "row").agg(F.count("*").alias("n")), ["array", "row"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    if n_rows:
        values.append(_pointers(counts, chunk))
    about = {".zgroup": _GROUP, ".zattrs": {"encoding-type": "anndata", "encoding-version": "0.1.0"}}
    about |= {f"{g}/{f}": v for g in ("layers", "uns", "obsm", "varm", "obsp", "varp") for f, v in ((".zgroup", _GROUP), (".zattrs", {"encoding-type": "dict", "encoding-version": "0.1.0"}))}
    for a, v in sparse.items():
        n = first.get(a, (1, 0))[1]
        about |= {f"{a}/.zgroup": _GROUP, f"{a}/.zattrs": {"encoding-type": "csr_matrix", "encoding-version": "0.1.0", "shape": [n_rows, n_cols]}}
        about |= {f"{a}/data/.zarray": _array([n], [chunk], v.kind, 0), f"{a}/indices/.zarray": _array([n], [chunk], "<i8", 0), f"{a}/indptr/.zarray": _array([n_rows + 1], [chunk], "<i8", 0)}
    for k, v in layers.items():
        if v.missing is not None:
            values.append(_dense(held.where(F.col(v.column).isNotNull()), f"layers/{k}", F.col(v.column), block))
            about |= {f"layers/{k}/.zarray": _array([n_rows, n_cols], list(block), v.kind, v.missing), f"layers/{k}/.zattrs": {"encoding-type": "array", "encoding-version": "0.2.0"}}
    for df, node, at, name, n in ((obs, "obs", "row", index[0], n_rows), (var, "var", "col", index[1], n_cols)):
        rows, more = _frame(df, node, at, name, n, chunk)
        values += rows
        about |= more
    for k, v in (uns or {}).items():
        values.append(obs.sparkSession.range(1).select(*_value(f"uns/{k}", F.lit("0"), F.lit(0), text=F.lit(str(v)))))
        about |= {f"uns/{k}/.zarray": _array([], [], "|O", ""), f"uns/{k}/.zattrs": {"encoding-type": "string", "encoding-version": "0.2.0"}}
    _write(values, path, about)


# modalities together


def _copied(source: str, target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, a = _store(source)
        into, b = _store(target)
        for batch in batches:
            for f in batch.column(0).to_pylist():
                into.create_dir(f"{b}/{f}".rpartition("/")[0], recursive=True)
                arrow_fs.copy_files(f"{a}/{f}", f"{b}/{f}", source_filesystem=where, destination_filesystem=into)
            yield batch

    return run


def merge(spark: SparkSession, stores: dict[str, str], path: str, chunk: int = CHUNK) -> None:
    """Stores of several modalities as one at path, each with the rows of all, in the order of their names; more columns of obs stay with each modality."""
    register(spark)
    names, frames, index = {}, {}, None
    for m, own in stores.items():
        index = (_json(own, "obs/.zattrs") or {})["_index"]
        frames[m] = materialise(read(spark, own, "obs"))
        names[m] = frames[m].select(F.col(index).alias("name"), F.col("at").alias("old"))
    cells = reduce(DataFrame.union, [n.select("name") for n in names.values()]).distinct()
    cells = materialise(ranked(cells, "row", "name").withColumn("row", F.col("row") - 1))
    n_rows = cells.count()
    about = {".zgroup": _GROUP, ".zattrs": {"encoding-type": "MuData", "encoding-version": "0.1.0", "axis": 0}, "mod/.zgroup": _GROUP, "mod/.zattrs": {"mod-order": list(stores)}}
    about |= {f"{g}/{f}": v for g in ("obsm", "varm", "obsp", "varp", "uns", "obsmap", "varmap") for f, v in ((".zgroup", _GROUP), (".zattrs", {"encoding-type": "dict", "encoding-version": "0.1.0"}))}
    values, columns, before = [], [], 0
    for m, own in stores.items():
        where, root = _store(own)
        files = [i.path[len(root.rstrip("/")) + 1 :] for i in where.get_file_info(arrow_fs.FileSelector(root, recursive=True)) if i.is_file]  # names of chunks, a few for each GB
        arrays = {f.removesuffix("/.zattrs"): _json(own, f) for f in files if f.endswith("/.zattrs") and f.split("/")[0] in ("X", "layers")}
        sparse = [a for a, x in arrays.items() if x["encoding-type"] == "csr_matrix"]
        dense = [a for a, x in arrays.items() if x["encoding-type"] == "array"]
        keep = [f for f in files if not f.startswith("obs/") and not any(f.startswith(f"{a}/indptr/") for a in sparse) and not any(f.startswith(f"{a}/") for a in dense)]
        chunks = [(f,) for f in keep if not f.rpartition("/")[2].startswith(".")]
        if chunks:
            spark.createDataFrame(chunks, "file string").repartition(min(len(chunks), 256)).mapInArrow(_copied(own, f"{path}/mod/{m}"), "file string").count()
        about |= {f"mod/{m}/{f}": _json(own, f) for f in keep if f.rpartition("/")[2].startswith(".")}
        of = materialise(cells.join(names[m], "name", "left").select("row", "name", "old"))
        moved = of.where("old IS NOT NULL").select("row", F.col("old"))
        for a in sparse:
            shape = arrays[a]["shape"]
            about[f"mod/{m}/{a}/.zattrs"] = arrays[a] | {"shape": [n_rows, shape[1]]}
            about[f"mod/{m}/{a}/indptr/.zarray"] = _array([n_rows + 1], [chunk], "<i8", 0)
            n = read(spark, own, a).groupBy(F.col("row").alias("old")).agg(F.count("*").alias("n"))
            counts = of.join(n, "old", "left").select(F.lit(f"mod/{m}/{a}").alias("array"), "row", F.coalesce("n", F.lit(0)).alias("n"))
            values.append(_pointers(counts, chunk))
        for a in dense:
            old = _json(own, f"{a}/.zarray")
            about |= {f"mod/{m}/{a}/.zarray": old | {"shape": [n_rows, old["shape"][1]]}, f"mod/{m}/{a}/.zattrs": arrays[a]}
            entries = read(spark, own, a).withColumnRenamed("row", "old").join(moved, "old")
            values.append(_dense(entries, f"mod/{m}/{a}", F.col("value"), tuple(old["chunks"])))
        kinds = dict(frames[m].dtypes)
        padded = of.join(frames[m].drop(index), F.col("old") == F.col("at"), "left").select("row", F.col("name").alias(index), *[F.when(F.col("old").isNull(), F.lit(PADDED[kinds[c]])).otherwise(F.col(f"`{c}`")).alias(c) for c in frames[m].columns if c not in ("at", index)])
        rows, more = _frame(padded, f"mod/{m}/obs", "row", index, n_rows, chunk)
        values += rows
        about |= more
        var = read(spark, own, "var")
        of_var = _json(own, "var/.zattrs")["_index"]
        n_var = _json(own, f"var/{of_var}/.zarray")["shape"][0]
        columns.append(var.select((F.col("at") + before).alias("at"), F.col(of_var).alias("_index")))
        values.append(of.select(*_line(f"obsmap/{m}", F.col("row"), chunk, number=F.col("row") + 1)))  # every modality has every row
        values.append(var.select(*_line(f"varmap/{m}", F.col("at") + before, chunk, number=F.col("at") + 1)))
        about[f"obsmap/{m}/.zarray"] = _array([n_rows], [chunk], "<i8", 0)
        before += n_var
    for m in stores:
        about[f"varmap/{m}/.zarray"] = _array([before], [chunk], "<i8", 0)
    for df, node, at, name, n in ((cells, "obs", "row", "name", n_rows), (reduce(DataFrame.union, columns), "var", "at", "_index", before)):
        rows, more = _frame(df, node, at, name, n, chunk)
        values += rows
        about |= more
    _write(values, path, about)
