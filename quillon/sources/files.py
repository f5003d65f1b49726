"""Readers and writers: FASTQ, FASTA, VCF and BAM as Spark data sources, tables by suffix, sheets, reports.

The data sources read in the executors, from local files and from every store that Arrow's file systems know (file, s3, gs, hdfs). FASTQ files, plain or in blocks (bgzip), and BAM files without an index are
split by bytes (option split, 64 MB): a range finds its first record by itself. A BAM file with an index beside it (.bai) has a partition for each window of its contigs, which reads only the blocks that the index names.
FASTA, VCF and plain gzip files are one partition each. Conditions on a BAM's contig and start are pushed down: windows without them aren't read, and alignments without them aren't decoded; option columns names what is decoded.
Register them with `register(spark)`, which also lets Spark push filters down to sources in Python; then `spark.read.format("fastq").load(path)` works as any source. The last part of a path may be a glob.
"""

from __future__ import annotations

import fnmatch
import gzip
import io
import posixpath
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from quillon.sources import splits

#: Bytes of a range of a file that can be split.
SPLIT = 64 << 20


def _store(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(path) if "://" in path else (arrow_fs.LocalFileSystem(), path)


def _files(path: str) -> list[str]:
    """The files that a path names: itself, those of a folder, or those that a glob in its last part fits."""
    head, _, last = path.rpartition("/")
    prefix = path[: path.index("://") + 3] if "://" in path and not path.startswith("file:") else ""
    if any(c in last for c in "*?["):
        where, own = _store(head or ".")
        found = [i.path for i in where.get_file_info(arrow_fs.FileSelector(own)) if i.is_file and fnmatch.fnmatch(posixpath.basename(i.path), last)]
    else:
        where, own = _store(path)
        info = where.get_file_info(own)
        found = [i.path for i in where.get_file_info(arrow_fs.FileSelector(own)) if i.is_file] if info.type == arrow_fs.FileType.Directory else [own] if info.is_file else []
    if not found:
        raise FileNotFoundError(path)
    return [prefix + f for f in sorted(found)]


def _raw(path: str):
    where, own = _store(path)
    return where.open_input_file(own)


def _open(path: str) -> io.TextIOBase:
    raw = _raw(path)
    return io.TextIOWrapper(gzip.GzipFile(fileobj=raw) if path.endswith((".gz", ".bgz")) else raw)


@dataclass
class FilePart(InputPartition):
    path: str


class _FileReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[FilePart]:
        return [FilePart(p) for p in _files(self.path)]

    def read(self, part: FilePart) -> Iterator[tuple]:
        with _open(part.path) as lines:
            yield from self.rows(lines)

    def rows(self, lines: io.TextIOBase) -> Iterator[tuple]:
        raise NotImplementedError


@dataclass
class Range(InputPartition):
    path: str
    lo: int
    hi: int
    size: int
    kind: str


class FastqReader(DataSourceReader):
    """Records of byte ranges; a gzip file without blocks is one range."""

    def __init__(self, path: str, split: int = SPLIT) -> None:
        self.path, self.split = path, split

    def partitions(self) -> list[Range]:
        out = []
        for p in _files(self.path):
            with _raw(p) as raw:
                size, blocked, packed = raw.size(), splits.is_blocked(raw), p.endswith((".gz", ".bgz"))
            kind = "blocks" if blocked else "gzip" if packed else "plain"
            out += [Range(p, lo, hi, size, kind) for lo, hi in ([(0, size)] if kind == "gzip" else splits.ranges(size, self.split))]
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        with _raw(part.path) as raw:
            if part.kind == "gzip":
                found = splits.fastq_records(gzip.GzipFile(fileobj=raw), 0, 1 << 62, 1 << 62, False)
            else:
                found = splits.fastq_records(raw, part.lo, part.hi, part.size, part.kind == "blocks")
            while rows := list(islice(found, 8192)):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], ["read_id", "sequence", "quality"])


class FastaReader(_FileReader):
    def rows(self, lines):
        name, fields, bad, parts = None, {}, [], []
        for line in lines:
            line = line.strip()
            if line.startswith(">"):
                if name is not None:
                    yield name, fields, bad, "".join(parts)
                name, *tokens = line[1:].split() or [""]
                fields, bad, parts = {}, [], []
                for t in tokens:
                    k, eq, v = t.partition("=")
                    if eq and k:
                        fields[k.lower()] = v
                    else:
                        bad.append(t)
            elif line:
                if name is None:
                    raise ValueError("sequence before the first header")
                parts.append(line)
        if name is not None:
            yield name, fields, bad, "".join(parts)


def _number(x: str | None, kind: type):
    """A number; a missing value or a list of integers is null, of a list of other numbers the first counts."""
    if x in (None, "", "."):
        return None
    if "," in x:
        return None if kind is int else _number(x.split(",")[0], kind)
    try:
        return kind(x)
    except ValueError:
        return None


class VcfReader(_FileReader):
    def rows(self, lines):
        names: list[str] = []
        for line in lines:
            if line.startswith("##"):
                continue
            f = line.rstrip("\r\n").split("\t")
            if line.startswith("#"):
                names = f[9:]
                continue
            if len(f) < 8:
                continue
            keys = f[8].split(":") if len(f) > 8 else []
            for name, sample in zip(names, f[9:], strict=False):
                own = dict(zip(keys, sample.split(":"), strict=False))
                dp = _number(own.get("DP"), int)
                if dp:
                    ad = own.get("AD", "").split(",")
                    ref, alt = (_number(ad[0], int), _number(ad[1], int)) if len(ad) > 1 else (None, None)
                    yield name, f[0], int(f[1]), f[3], f[4].split(",")[0], _number(f[5], float), dp, ref, alt, _number(own.get("VAF", own.get("AF")), float)


# BAM: blocks of gzip, each with its size in an extra field


def _blocks(raw, at: int | None = None) -> Iterator[bytes]:
    """Blocks of a file; at: a virtual offset, the place of a block and of a byte in it."""
    skip = 0
    if at is not None:
        raw.seek(at >> 16)
        skip = at & 0xFFFF
    while head := raw.read(18):
        if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
            raise ValueError("not a BAM file")
        size = struct.unpack_from("<H", head, 16)[0] + 1
        body = raw.read(size - 18)
        yield zlib.decompress(body[:-8], -15)[skip:]
        skip = 0


class _Bytes:
    def __init__(self, blocks: Iterator[bytes]) -> None:
        self.blocks, self.held, self.at, self.taken = blocks, b"", 0, 0

    def take(self, n: int) -> bytes:
        self.taken += n
        while len(self.held) - self.at < n:
            nxt = next(self.blocks, None)
            if nxt is None:
                out, self.held, self.at = self.held[self.at :], b"", 0
                return out
            self.held, self.at = self.held[self.at :] + nxt, 0
        out = self.held[self.at : self.at + n]
        self.at += n
        return out


_BASES, _OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
_TWO = [a + b for a in _BASES for b in _BASES]
_TAG = {"A": "c", "c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def _tags(raw: bytes) -> dict[str, str]:
    out, at = {}, 0
    while at < len(raw):
        key, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(b"\0", at)
            out[key], at = raw[at:end].decode(), end + 1
        elif kind == "B":
            sub, n = chr(raw[at]), struct.unpack_from("<i", raw, at + 1)[0]
            size = struct.calcsize("<" + _TAG[sub])
            out[key] = ",".join(map(str, struct.unpack_from(f"<{n}{_TAG[sub]}", raw, at + 5)))
            at += 5 + n * size
        else:
            v = struct.unpack_from("<" + _TAG[kind], raw, at)[0]
            out[key] = v.decode() if isinstance(v, bytes) else str(v)
            at += struct.calcsize("<" + _TAG[kind])
    return out


def bam_header(take) -> list[tuple[str, int]]:
    """Names and lengths of the contigs."""
    if take(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    take(struct.unpack("<i", take(4))[0])
    out = []
    for _ in range(struct.unpack("<i", take(4))[0]):
        name = take(struct.unpack("<i", take(4))[0])[:-1].decode()
        out.append((name, struct.unpack("<i", take(4))[0]))
    return out


_BAM = {"name": pa.string(), "chrom": pa.string(), "start": pa.int64(), "end": pa.int64(), "flags": pa.int32(), "mapping_quality": pa.int32(), "cigar": pa.string(), "sequence": pa.string(), "qualities": pa.list_(pa.int32()), "tags": pa.map_(pa.string(), pa.string())}


def decoded(r: bytes, contigs: list[str], columns: frozenset[str]) -> dict:
    """The columns of an alignment; places count from 0."""
    ref, pos, l_name, mapq, _, n_ops, flags, l_seq = struct.unpack_from("<iiBBHHHi", r)
    at = 32 + l_name
    out = {"name": r[32 : at - 1].decode(), "chrom": contigs[ref] if ref >= 0 else None, "start": pos, "flags": flags, "mapping_quality": mapq}
    if columns & {"end", "cigar"}:
        ops = [(x >> 4, _OPS[x & 15]) for x in struct.unpack_from(f"<{n_ops}I", r, at)]
        out |= {"end": pos + sum(n for n, o in ops if o in "MDN=X"), "cigar": "".join(f"{n}{o}" for n, o in ops)}
    at += 4 * n_ops
    if "sequence" in columns:
        out["sequence"] = "".join([_TWO[x] for x in r[at : at + (l_seq + 1) // 2]])[:l_seq]
    at += (l_seq + 1) // 2
    if "qualities" in columns:
        qual = r[at : at + l_seq]
        out["qualities"] = None if qual[:1] == b"\xff" else list(qual)
    if "tags" in columns:
        out["tags"] = list(_tags(r[at + l_seq :]).items())
    return out


def bam_index(raw: bytes) -> tuple[list[list[int]], int]:
    """Of a .bai: each contig's linear index, the virtual offset of the first alignment that reaches each 16384 bases; and where the placed alignments end."""
    if raw[:4] != b"BAI\1":
        raise ValueError("not an index of a BAM file")
    at, out, last = 8, [], 0
    for _ in range(struct.unpack_from("<i", raw, 4)[0]):
        bins, at = struct.unpack_from("<i", raw, at)[0], at + 4
        for _ in range(bins):
            number, chunks = struct.unpack_from("<Ii", raw, at)
            for k in range(chunks if number != 37450 else 0):  # that bin holds counts
                last = max(last, struct.unpack_from("<QQ", raw, at + 8 + 16 * k)[1])
            at += 8 + 16 * chunks
        n = struct.unpack_from("<i", raw, at)[0]
        out.append(list(struct.unpack_from(f"<{n}Q", raw, at + 4)))
        at += 4 + 8 * n
    return out, last


@dataclass
class Window(InputPartition):
    path: str
    contig: str | None
    start: int
    end: int
    offset: int | None


def windows(contigs: list[tuple[str, int]], size: int) -> list[tuple[str | None, int, int]]:
    """Windows of each contig, and one for alignments without a place."""
    return [(n, a, min(a + size, length)) for n, length in contigs for a in range(0, max(length, 1), size)] + [(None, 0, 0)]


class BamReader(DataSourceReader):
    def __init__(self, path: str, window: int = 10_000_000, split: int = SPLIT, columns: str = "") -> None:
        self.path, self.window, self.split, self.columns = path, window, split, [c for c in _BAM if not columns or c in columns.split(",")]
        self.contig, self.least, self.below = None, None, None

    def pushFilters(self, filters: list) -> Iterator:  # noqa: N802
        """A contig and bounds of the start stay with the source."""
        for f in filters:
            name, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if isinstance(f, EqualTo) and name == ("chrom",) and self.contig in (None, value):
                self.contig = value
            elif name == ("start",) and isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.least = max(value + isinstance(f, GreaterThan), value if self.least is None else self.least)
            elif name == ("start",) and isinstance(f, LessThan | LessThanOrEqual):
                new = value + isinstance(f, LessThanOrEqual)
                self.below = new if self.below is None else min(self.below, new)
            else:
                yield f

    def _wanted(self, contig: str | None, start: int, end: int) -> bool:
        """Whether places from start to end, which doesn't count, may have alignments that the conditions let pass."""
        return (self.contig is None or contig == self.contig) and (self.least is None or end > self.least) and (self.below is None or start < self.below)

    def partitions(self) -> list[Window | Range]:
        out: list[Window | Range] = []
        for p in _files(self.path):
            if p.endswith(".bai"):
                continue
            index = self._index(p)
            if index is None:
                with _raw(p) as raw:
                    size = raw.size()
                out += [Range(p, lo, hi, size, "blocks") for lo, hi in splits.ranges(size, self.split)]
                continue
            linear, last = index
            with _raw(p) as raw:
                contigs = bam_header(_Bytes(_blocks(raw)).take)
            of = {n: x for (n, _), x in zip(contigs, linear, strict=False)}
            for contig, a, z in windows(contigs, self.window):
                if contig is None:
                    if self._wanted(None, -1, 0):
                        out.append(Window(p, None, 0, 0, last or None))
                elif self._wanted(contig, a, z) and (found := [x for x in of.get(contig, [])[a >> 14 : (max(z - 1, a) >> 14) + 1] if x]):
                    out.append(Window(p, contig, a, z, found[0]))
        return out or [Range("", 0, 0, 0, "blocks")]

    @staticmethod
    def _index(path: str) -> tuple[list[list[int]], int] | None:
        for own in (f"{path}.bai", path.removesuffix(".bam") + ".bai"):
            where, name = _store(own)
            if where.get_file_info(name).is_file:
                with where.open_input_file(name) as raw:
                    return bam_index(raw.read())
        return None

    def _raw_records(self, raw, part: Window | Range, contigs: list[tuple[str, int]], header: int) -> Iterator[bytes]:
        """Alignments that start in the window, so none is read twice; the file is sorted, so the window's end ends the reading. Or the byte range's own ones."""
        if isinstance(part, Range):
            yield from splits.alignments(raw, part.lo, part.hi, part.size, header, [n for _, n in contigs])
            return
        take, names = _Bytes(_blocks(raw, part.offset)).take, [n for n, _ in contigs]
        if part.offset is None:
            take(header)
        while len(size := take(4)) == 4:
            r = take(struct.unpack("<i", size)[0])
            ref, pos = struct.unpack_from("<ii", r)
            contig = names[ref] if ref >= 0 else None
            if part.contig is not None and (contig != part.contig or pos >= part.end):
                break
            if contig == part.contig and (part.contig is None or pos >= part.start):
                yield r

    def read(self, part: Window | Range) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        with _raw(part.path) as raw:
            source = _Bytes(_blocks(raw))
            contigs = bam_header(source.take)
            names, rows, wanted = [n for n, _ in contigs], [], frozenset(self.columns)
            for r in self._raw_records(raw, part, contigs, source.taken):
                ref, pos = struct.unpack_from("<ii", r)
                if self._wanted(names[ref] if ref >= 0 else None, pos, pos + 1):
                    rows.append(decoded(r, names, wanted))
                    if len(rows) == 4096:
                        yield _batch(rows, self.columns)
                        rows = []
            if rows:
                yield _batch(rows, self.columns)


def _batch(rows: list[dict], columns: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], _BAM[c]) for c in columns], columns)


FORMATS = {
    "fastq": ("read_id string, sequence string, quality string", FastqReader),
    "fasta": ("id string, fields map<string,string>, bad array<string>, sequence string", FastaReader),
    "vcf": ("caller string, chrom string, pos long, ref string, alt string, qual double, dp long, ad_ref long, ad_alt long, af double", VcfReader),
}
BAM_SCHEMA = {"name": "string", "chrom": "string", "start": "long", "end": "long", "flags": "int", "mapping_quality": "int", "cigar": "string", "sequence": "string", "qualities": "array<int>", "tags": "map<string,string>"}


def _source(kind: str) -> type[DataSource]:
    schema, reader = FORMATS[kind]

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return kind

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            more = {"split": int(self.options["split"])} if "split" in self.options else {}
            return reader(self.options["path"], **more)

    return Source


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        own = self.options.get("columns", "").split(",")
        return ", ".join(f"`{c}` {t}" for c, t in BAM_SCHEMA.items() if own == [""] or c in own)

    def reader(self, schema) -> DataSourceReader:
        return BamReader(self.options["path"], int(self.options.get("window", 10_000_000)), int(self.options.get("split", SPLIT)), self.options.get("columns", ""))


def register(spark: SparkSession) -> None:
    for kind in FORMATS:
        spark.dataSource.register(_source(kind))
    spark.dataSource.register(BamSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def scan_rna(spark: SparkSession, path: str, tags: tuple[str, ...] = ("GN", "UB", "CB")) -> DataFrame:
    """Distinct (tags, mapping_quality, read_name); a missing tag is null."""
    return spark.read.format("bam").option("columns", "name,mapping_quality,tags").load(path).select(*[F.col("tags")[t].alias(t) for t in tags], "mapping_quality", F.col("name").alias("read_name")).distinct()


def scan_dna(spark: SparkSession, path: str) -> DataFrame:
    from quillon.operators.reads import normalise_contigs

    return normalise_contigs(spark.read.format("bam").option("columns", "name,chrom,start,end,flags,mapping_quality,cigar").load(path))


def genomic_map(fasta: DataFrame) -> DataFrame:
    """(feature, chrom, _g0, snp_pos) of sequences whose headers have a contig and a whole number for the first base."""
    out = fasta.select(F.col("id").alias("feature"), F.col("fields")["chrom"].alias("chrom"), F.expr("try_cast(fields['g0'] AS INT)").alias("_g0"), F.expr("try_cast(fields['snp_pos'] AS INT)").alias("snp_pos"))
    return out.where("chrom IS NOT NULL AND _g0 IS NOT NULL")


def enrich(fasta: DataFrame, panel: DataFrame) -> DataFrame:
    """Sequences of a panel with headers that name their place on the genome."""
    head = F.format_string(">%s chrom=%s g0=%d amplicon_start=%d amplicon_end=%d m5=%s", "id", "chrom", "amplicon_start", "amplicon_start", "amplicon_end", F.md5("sequence"))
    return fasta.select("id", "sequence").join(panel, F.col("id") == F.col("name")).select("id", head.alias("header"), "sequence")


# tables and reports


TABLES = (".csv", ".csv.gz", ".tsv", ".tsv.gz", ".parquet")


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A table by its suffix: CSV (also gzipped), TSV or Parquet."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith((".csv", ".csv.gz", ".tsv", ".tsv.gz")):
        reader = spark.read.option("header", True).option("sep", "\t" if ".tsv" in path else ",")
        return (reader.schema(schema) if schema else reader).csv(path)
    raise ValueError(f"neither CSV nor Parquet: {path}")


def read_all(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The union of the tables among the paths; others are left out."""
    from functools import reduce

    return reduce(lambda a, b: a.unionByName(b), [read_table(spark, p) for p in paths if p.endswith(TABLES)])


def write_list(df: DataFrame, path: str) -> None:
    """One column as text, without a header."""
    df.select(F.col(df.columns[0]).cast("string")).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema("sample_name string, fastq_1 string, fastq_2 string, library_type string, demultiplexing_indices string, force_cells int").csv(path)


def sheet_problems(sheet: DataFrame) -> DataFrame:
    """(sample_name, problem): file names, pairs, types and numbers that break the sheet's rules, and repeated rows."""
    from quillon.operators.sequences import repeated

    rules = {
        "fastq_1": ~F.col("fastq_1").rlike(r"\.f(ast)?q\.gz$"), "fastq_2": ~F.col("fastq_2").rlike(r"\.f(ast)?q\.gz$"), "pair": F.col("fastq_1") == F.col("fastq_2"),
        "library_type": ~F.col("library_type").isin("DNA", "RNA"), "force_cells": F.col("force_cells") < 1, "indices": ~F.col("demultiplexing_indices").rlike(r"^[A-H]\d{1,2}(;[A-H]\d{1,2})*$"),
    }
    if "library_id" in sheet.columns:
        rules["library_id"] = F.col("library_id").rlike("R[12]")
    own = sheet.select("sample_name", F.explode(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(n in ("fastq_1", "fastq_2", "library_type"))), n) for n, c in rules.items()]))).alias("problem"))
    return own.union(repeated(sheet, "fastq_1", "fastq_2").join(sheet, ["fastq_1", "fastq_2"]).select("sample_name", F.lit("repeated")))


def repeated_inputs(sheet: DataFrame) -> DataFrame:
    """(sample_name, problem): samples that share library type, files and wells with one before them in the order of names, and samples whose libraries have different wells."""
    from pyspark.sql import Window as W

    key = ["library_type", "fastq_1", "fastq_2", "demultiplexing_indices"]
    again = sheet.withColumn("_i", F.row_number().over(W.partitionBy(*key).orderBy("sample_name"))).where("_i > 1").select("sample_name", F.lit("repeated input").alias("problem"))
    apart = sheet.groupBy("sample_name").agg(F.count_distinct(F.coalesce("demultiplexing_indices", F.lit(""))).alias("_n")).where("_n > 1").select("sample_name", F.lit("wells differ"))
    return again.union(apart)


def well_collisions(sheet: DataFrame) -> DataFrame:
    """(sample_name, other, well): samples that use a well of the same library and files as another one, which comes before it."""
    from pyspark.sql import Window as W

    each = sheet.select("sample_name", "library_type", "fastq_1", "fastq_2", F.explode_outer(F.split("demultiplexing_indices", ";")).alias("well"))
    w = W.partitionBy("library_type", "fastq_1", "fastq_2", "well").orderBy("sample_name")
    return each.withColumn("other", F.first("sample_name").over(w)).withColumn("_i", F.row_number().over(w)).where("_i > 1").select("sample_name", "other", "well")
