"""Stores of matrices: entries come back, chunks are pruned, nothing half-written counts, merged modalities keep their chunks."""

import json
import math
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

from quillon.sources import stores

LAYERS = {"DP": stores.Layer("DP", kind="<i4"), "GT": stores.Layer("GT", -1, "|i1"), "GQ": stores.Layer("GQ", math.nan, "<f4")}


def some(seed, n_rows, n_cols, many, names):
    rng = random.Random(seed)
    cells = rng.sample([(r, c) for r in range(n_rows) if r % 5 != 3 for c in range(n_cols)], many)
    entries = [(r, c, round(rng.random(), 3) if rng.random() < 0.8 else 0.0, rng.randint(0, 3), rng.choice([0, 1, -1]), rng.choice([None, 5.5, 99.0])) for r, c in cells]
    return entries, [(r, names[r], r * 7, r / 4 if r % 2 else None, r % 3 == 0) for r in range(n_rows)], [(c, f"A:{c}é", "ACGT"[c % 4]) for c in range(n_cols)]


def put(spark, path, parts, **how):
    entries, obs, var = parts
    df = spark.createDataFrame(entries, "row long, col long, vaf double, DP int, GT int, GQ double")
    obs, var = spark.createDataFrame(obs, "row long, barcode string, depth long, mean double, ok boolean"), spark.createDataFrame(var, "col long, site string, base string")
    stores.write(path, df, obs, var, "vaf", LAYERS, ("barcode", "site"), {"modality": "snv"}, **how)


def nodes(spark, path, prefix=""):
    return {n: {(r.row, r.col): r.value for r in stores.read(spark, path, prefix + n).collect()} for n in ("X", "layers/DP", "layers/GT", "layers/GQ")}


def wanted(entries):
    return {"X": {e[:2]: e[2] for e in entries if e[2]}, "layers/DP": {e[:2]: e[3] for e in entries if e[3]}, "layers/GT": {e[:2]: e[4] for e in entries if e[4] != -1}, "layers/GQ": {e[:2]: e[5] for e in entries if e[5] is not None}}


@pytest.mark.parametrize("chunk,block", [(7, (4, 3)), (stores.CHUNK, stores.BLOCK)])
def test_entries_come_back(spark, tmp_path, chunk, block):
    parts = some(chunk, 23, 11, 90, [f"c{i:02}" for i in range(23)])
    path = str(tmp_path / "a.zarr")
    put(spark, path, parts, chunk=chunk, block=block)
    assert nodes(spark, path) == wanted(parts[0])
    got = sorted(map(tuple, stores.read(spark, path, "obs").collect()), key=lambda r: r[0])
    assert [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in got] == parts[1]
    assert sorted(map(tuple, stores.read(spark, f"file://{path}", "var").collect())) == parts[2]
    assert not [f for _, _, names in os.walk(path) for f in names if f.startswith(".") and f not in (".zgroup", ".zattrs", ".zarray") and not f.endswith(".crc")]


def test_layout(spark, tmp_path):
    """Pointers, columns and values as the format has them, read without this library."""
    entries = [(0, 1, 0.5, 2, 1, 1.0), (0, 3, 0.25, 0, 0, None), (2, 0, 1.0, 7, 1, 2.0)]
    put(spark, str(tmp_path / "a"), (entries, [(r, f"c{r}", r, 0.0, True) for r in range(4)], [(c, f"s{c}", "A") for c in range(5)]), chunk=4, block=(2, 3))
    raw = lambda f, kind: np.frombuffer(zlib.decompress((tmp_path / "a" / f).read_bytes()), kind)
    about = lambda f: json.loads((tmp_path / "a" / f).read_text())
    assert raw("X/data/0", "<f8").tolist() == [0.5, 0.25, 1.0, 0] and raw("X/indices/0", "<i8").tolist() == [1, 3, 0, 0]
    assert raw("X/indptr/0", "<i8").tolist() == [0, 2, 2, 3] and raw("X/indptr/1", "<i8").tolist() == [3, 0, 0, 0]
    assert raw("layers/DP/data/0", "<i4").tolist() == [2, 7, 0, 0] and raw("layers/GT/0.1", "|i1").tolist() == [0, -1, -1, -1, -1, -1]
    assert about("X/.zattrs") == {"encoding-type": "csr_matrix", "encoding-version": "0.1.0", "shape": [4, 5]} and about("X/data/.zarray")["shape"] == [3]
    assert about("layers/GQ/.zarray")["fill_value"] == "NaN" and about("obs/.zattrs")["_index"] == "barcode" and about("obs/.zattrs")["column-order"] == ["depth", "mean", "ok"]
    assert zlib.decompress((tmp_path / "a/obs/barcode/0").read_bytes()) == b"\4\0\0\0" + b"".join(b"\2\0\0\0c%d" % r for r in range(4))
    assert about(".zattrs")["encoding-type"] == "anndata" and zlib.decompress((tmp_path / "a/uns/modality/0").read_bytes())[8:] == b"snv"


def test_conditions_on_rows_open_their_chunks_only(spark, tmp_path):
    parts = some(1, 200, 10, 900, [f"c{i:03}" for i in range(200)])
    path = str(tmp_path / "a")
    put(spark, path, parts, chunk=32, block=(16, 4))
    want = wanted(parts[0])
    for node in want:
        for how, keep in (("row >= 40 AND row < 60", range(40, 60)), ("row = 77", [77]), ("row > 190 AND col < 4", range(191, 200)), ("row < 0", []), ("row >= 500", [])):
            got = {(r.row, r.col): r.value for r in stores.read(spark, path, node).where(how).collect()}
            assert got == {k: v for k, v in want[node].items() if k[0] in keep and ("col" not in how or k[1] < 4)}
    assert "row#" in stores.read(spark, path).where("row = 77")._jdf.queryExecution().toString()
    reader = stores.Reader(path, "X")
    rest = list(reader.pushFilters([GreaterThanOrEqual(("row",), 40), LessThan(("row",), 44), EqualTo(("col",), 3)]))
    pieces = reader.partitions()
    entries = sum(40 <= r < 44 for r, _ in want["X"])
    assert rest == [EqualTo(("col",), 3)] and sum(p.hi - p.lo for p in pieces) == entries and len(pieces) <= entries // 32 + 2 < len(stores.Reader(path, "X").partitions())
    assert [r.barcode for r in stores.read(spark, path, "obs").where("at = 5").collect()] == ["c005"]


def test_empty_matrices(spark, tmp_path):
    for k, parts in enumerate([([], [(0, "a", 1, 1.0, True)], [(0, "s", "A")]), ([], [], [])]):
        path = str(tmp_path / str(k))
        put(spark, path, parts)
        assert nodes(spark, path) == wanted([]) and stores.read(spark, path, "obs").count() == len(parts[1])


def test_lost_tasks_leave_no_chunk(spark, tmp_path):
    """A task that ends within a chunk leaves only whole ones, and nothing without the driver's commit is a store."""
    path = str(tmp_path / "a")
    writer = stores.Writer(path, {".zgroup": {"zarr_format": 2}, "X/.zarray": stores._array([6], [3], "<f8", 0)})

    def rows(lost):
        for chunk in "01":
            yield pa.RecordBatch.from_pydict({"array": ["X"] * 3, "chunk": [chunk] * 3, "at": pa.array([0, 1, 2], pa.int32()), "number": [1.0, 2.0, 3.0], "text": pa.nulls(3, pa.string())})
            if lost and chunk == "1":
                raise OSError("executor lost")

    with pytest.raises(OSError, match="executor lost"):
        writer.write(rows(True))
    assert sorted(os.listdir(f"{path}/X")) == ["0"]
    with pytest.raises(FileNotFoundError):
        stores.Reader(path, "X")
    done = writer.write(rows(False))
    writer.write(rows(False))  # the same task once more
    assert sorted(os.listdir(f"{path}/X")) == ["0", "1"] and done.chunks == 2
    writer.commit([done])
    assert stores.Array(path, "X").slice(2, 5).tolist() == [3.0, 1.0, 2.0]


def test_modalities_together(spark, tmp_path):
    """All have the rows of all; chunks of data and indices are those of before."""
    one, two = [f"c{i:02}" for i in range(0, 30, 2)], [f"c{i:02}" for i in range(9, 30, 3)]
    parts = {"snv": some(3, len(one), 6, 50, one), "indel": some(4, len(two), 4, 16, two)}
    for m, p in parts.items():
        put(spark, str(tmp_path / m), p, chunk=8, block=(4, 3))
    path = str(tmp_path / "both")
    stores.merge(spark, {m: str(tmp_path / m) for m in parts}, path, chunk=8)
    cells = sorted({*one, *two})
    for m, (entries, obs, var) in parts.items():
        new = {r[0]: cells.index(r[1]) for r in obs}
        assert nodes(spark, f"{path}/mod/{m}") == wanted([(new[e[0]], *e[1:]) for e in entries])
        got = {r.barcode: (r.at, r.depth, r.ok) for r in stores.read(spark, f"{path}/mod/{m}", "obs").collect()}
        own = {r[1]: r for r in obs}
        assert got == {c: (i, own[c][2] if c in own else 0, own[c][4] if c in own else False) for i, c in enumerate(cells)}
        assert sorted(map(tuple, stores.read(spark, f"{path}/mod/{m}", "var").collect())) == var
        for a in ("X/data", "X/indices", "layers/DP/data"):
            for f in os.listdir(tmp_path / m / a):
                assert (tmp_path / m / a / f).read_bytes() == (tmp_path / "both/mod" / m / a / f).read_bytes()
    assert [r.name for r in stores.read(spark, path, "obs").orderBy("at").collect()] == cells
    assert json.loads((tmp_path / "both/mod/.zattrs").read_text()) == {"mod-order": ["snv", "indel"]}
    assert stores.read(spark, path, "var").orderBy(F.desc("at")).first()["at"] == 9 and stores.Array(path, "varmap/indel").slice(6, 10).tolist() == [1, 2, 3, 4]
