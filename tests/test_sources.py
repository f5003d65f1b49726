import gzip
import struct
import zlib

import pytest

from quillon.sources import files, tables
from quillon.streaming import reads as stream


@pytest.fixture(scope="module")
def formats(spark):
    files.register(spark)
    return spark


def test_fastq(formats, tmp_path):
    with gzip.open(tmp_path / "a.fastq.gz", "wt") as f:
        f.write("@r1 x\nACGT\n+\nIIII\n@r2\nGG\n+\nII\n")
    assert [tuple(r) for r in formats.read.format("fastq").load(str(tmp_path / "a.fastq.gz")).collect()] == [("r1", "ACGT", "IIII"), ("r2", "GG", "II")]
    (tmp_path / "b.fastq").write_text("@r1\nACGT\n+\nII\n")
    with pytest.raises(Exception, match="not a FASTQ"):
        formats.read.format("fastq").load(str(tmp_path / "b.fastq")).collect()


def test_fasta(formats, tmp_path):
    (tmp_path / "a.fa").write_text(">A1 chrom=chr1 G0=100 odd\nACG\nT\n>A2 chrom=chr2 g0=x\nGG\n")
    df = formats.read.format("fasta").load(str(tmp_path / "a.fa"))
    assert [(r.id, r.sequence, r.bad) for r in df.collect()] == [("A1", "ACGT", ["odd"]), ("A2", "GG", [])]
    assert [tuple(r) for r in files.genomic_map(df).collect()] == [("A1", "chr1", 100, None)]


def test_vcf(formats, tmp_path):
    (tmp_path / "a.vcf").write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tc1\tc2\nA1\t5\t.\tA\tC,G\t9.5\tPASS\t.\tDP:AD:VAF\t10:6,4:0.4\t.:.:.\nA1\t6\t.\tA\tT\t.\tPASS\t.\tDP\t0\t7\n")
    got = [tuple(r) for r in formats.read.format("vcf").load(str(tmp_path / "a.vcf")).collect()]
    assert got == [("c1", "A1", 5, "A", "C", 9.5, 10, 6, 4, 0.4), ("c2", "A1", 6, "A", "T", None, 7, None, None, None)]


def _block(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return b"\x1f\x8b\x08\x04" + bytes(6) + struct.pack("<HBBHH", 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def _record(name: str, ref: int, pos: int, ops: list[tuple[int, int]], seq: str, tags: bytes = b"", flags: int = 0) -> bytes:
    codes = ["=ACMGRSVTWYHKDBN".index(b) for b in seq] + [0] * (len(seq) % 2)
    packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True))
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 60, 0, len(ops), flags, len(seq), -1, -1, 0) + name.encode() + b"\0" + struct.pack(f"<{len(ops)}I", *[n << 4 | o for n, o in ops]) + packed + bytes([30] * len(seq)) + tags
    return struct.pack("<i", len(body)) + body


def test_bam(formats, tmp_path):
    head = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 6) + b"chrA1\0" + struct.pack("<i", 100)
    data = head + _record("r1", 0, 4, [(3, 0), (2, 1), (2, 0)], "ACGTTGA", b"GNZgene\0UBZACG\0XYi" + struct.pack("<i", 7)) + _record("r2", 0, 60, [(4, 0)], "ACGT") + _record("r3", -1, -1, [], "AC", flags=4)
    (tmp_path / "a.bam").write_bytes(_block(data[:50]) + _block(data[50:]) + _block(b""))
    df = formats.read.format("bam").option("window", 50).load(str(tmp_path / "a.bam"))
    assert df.rdd.getNumPartitions() == 1
    got = {r.name: r for r in df.collect()}
    assert (got["r1"].chrom, got["r1"].start, got["r1"].end, got["r1"].cigar, got["r1"].sequence) == ("chrA1", 4, 9, "3M2I2M", "ACGTTGA")
    assert got["r1"].tags == {"GN": "gene", "UB": "ACG", "XY": "7"} and got["r3"].chrom is None and got["r2"].qualities == [30] * 4
    assert sorted((r.GN, r.read_name) for r in files.scan_rna(formats, str(tmp_path / "a.bam")).collect() if r.GN) == [("gene", "r1")]
    assert {r.chrom for r in files.scan_dna(formats, str(tmp_path / "a.bam")).collect()} == {"A1", None}


def test_bam_with_an_index(formats, tmp_path):
    """Windows of an indexed file read their own blocks only, and every alignment comes once."""
    contigs = [("c1", 70_000), ("c2", 40_000)]
    blocks, offset = [], 0

    def put(data: bytes) -> int:
        nonlocal offset
        blocks.append(_block(data))
        at, offset = offset, offset + len(blocks[-1])
        return at << 16

    put(b"BAM\1" + struct.pack("<ii", 0, 2) + b"".join(struct.pack("<i", 3) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in contigs))
    linear, names, end = {0: {}, 1: {}}, [], 0
    for ref, (_, size) in enumerate(contigs):
        for k, pos in enumerate(range(10, size - 100, 4001)):
            at = put(_record(f"r{ref}-{k}", ref, pos, [(50, 0)], "A" * 50))
            names.append(f"r{ref}-{k}")
            for w in range(pos >> 14, (pos + 49 >> 14) + 1):
                linear[ref].setdefault(w, at)
            end = offset << 16
    put(_record("lost", -1, -1, [], "AC", flags=4))
    blocks.append(_block(b""))
    (tmp_path / "a.bam").write_bytes(b"".join(blocks))
    index = b"BAI\1" + struct.pack("<i", 2)
    for ref in (0, 1):
        index += struct.pack("<i", 2) + struct.pack("<IiQQ", 4681, 1, 0, end) + struct.pack("<IiQQQQ", 37450, 2, 0, 1 << 60, 5, 5)
        index += struct.pack("<i", max(linear[ref]) + 1) + b"".join(struct.pack("<Q", linear[ref].get(w, 0)) for w in range(max(linear[ref]) + 1))
    (tmp_path / "a.bam.bai").write_bytes(index)
    df = formats.read.format("bam").option("window", 10_000).load(str(tmp_path / "a.bam"))
    assert df.rdd.getNumPartitions() == 12 and sorted(r.name for r in df.collect()) == sorted([*names, "lost"])
    assert files.bam_index(index)[1] == end
    reader = files.BamReader(str(tmp_path / "a.bam"), 10_000)
    part = next(p for p in reader.partitions() if (p.contig, p.start) == ("c2", 20_000))
    assert part.offset == linear[1][1] and {r for b in reader.read(part) for r in b.column(1).to_pylist()} == {"c2"}


def test_globs_folders_and_stores(formats, tmp_path):
    for n in ("a", "b"):
        (tmp_path / f"{n}.fa").write_text(f">{n}\nAC\n")
    (tmp_path / "c.txt").write_text(">c\nAC\n")
    for path in (f"{tmp_path}/*.fa", f"file://{tmp_path}/[ab].fa"):
        assert sorted(r.id for r in formats.read.format("fasta").load(path).collect()) == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        files._files(f"{tmp_path}/none.fa")


def test_enrich(formats):
    fasta = formats.createDataFrame([("a", "ACGT"), ("b", "GG")], "id string, sequence string")
    panel = formats.createDataFrame([("a", "chr1", 10, 20)], "name string, chrom string, amplicon_start int, amplicon_end int")
    got = files.enrich(fasta, panel).collect()
    assert [r.id for r in got] == ["a"] and got[0].header == ">a chrom=chr1 g0=10 amplicon_start=10 amplicon_end=20 m5=f1f8f4bf413b16ad135722aa4591043e"


def test_more_tables(formats, tmp_path):
    where = f"file://{tmp_path}"
    (tmp_path / "h.csv").write_text("r1,AC,,G\nr2,A,C,G\n")
    assert [tuple(r) for r in tables.read_headerless(formats, f"{where}/h.csv", ["n", "D", "C", "B"]).collect()] == [("r1", "AC", None, "G"), ("r2", "A", "C", "G")]
    with pytest.raises(Exception, match="not 3 fields"):
        tables.read_headerless(formats, f"{where}/h.csv", ["n", "D", "C"]).collect()
    df = formats.createDataFrame([("x", 1), ("y", 2)], "a string, b int")
    kept = tables.materialise(df)
    assert sorted(map(tuple, kept.collect())) == [("x", 1), ("y", 2)] and "parquet" in kept._jdf.queryExecution().toString().lower()
    tables.write_table(df, f"{where}/p", "a")
    assert (tmp_path / "p" / "a=x").is_dir()
    tables.write_text(formats, "one\ntwo é\n", f"{where}/t.txt")
    tables.copy_file(formats, f"{where}/t.txt", f"{where}/u.txt")
    assert (tmp_path / "u.txt").read_text() == "one\ntwo é\n"
    files.write_csv(df, f"{where}/t.tsv", "\t")
    files.write_csv(df, f"{where}/t.csv")
    assert files.read_all(formats, [f"{where}/t.tsv", f"{where}/t.csv", "x.txt"]).count() == 4
    q = formats.createDataFrame([("r1", "ACGT", "IIII")], "read_id string, sequence string, quality string")
    tables.write_fastq(q, f"{where}/q.fastq")
    files.register(formats)
    assert [tuple(r) for r in formats.read.format("fastq").load(f"{tmp_path}/q.fastq/*.gz").collect()] == [("r1", "ACGT", "IIII")]


def test_sheet(formats, tmp_path):
    (tmp_path / "s.csv").write_text("sample_name,fastq_1,fastq_2,library_type,demultiplexing_indices,force_cells\na,x_R1.fastq.gz,x_R2.fastq.gz,DNA,A1;B2,5\nb,y.txt,y2.fastq.gz,XX,Q9,0\n")
    got = sorted((r.sample_name, r.problem) for r in files.sheet_problems(files.read_sheet(formats, str(tmp_path / "s.csv"))).collect())
    assert got == [("b", "fastq_1"), ("b", "force_cells"), ("b", "indices"), ("b", "library_type")]


def test_tables(formats, tmp_path):
    df = formats.createDataFrame([("x", 1)], "a string, b int")
    files.write_csv(df, str(tmp_path / "t.csv"))
    assert [tuple(r) for r in files.read_table(formats, str(tmp_path / "t.csv"), "a string, b int").collect()] == [("x", 1)]
    with pytest.raises(ValueError):
        files.read_table(formats, "x.txt")


def test_stream(formats, tmp_path):
    s = "A" * 8 + "nnnn" + "C" * 8 + "nnnn" + "G" * 8 + "nnnn" + "T" * 8
    formats.createDataFrame([("r1", s), ("r2", s)], "read_id string, sequence string").write.parquet(str(tmp_path / "in"))
    q = stream.counts(stream.barcodes(formats, str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("n").start()
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in formats.sql("SELECT * FROM n").collect()] == [("_".join(["A" * 8, "C" * 8, "G" * 8, "T" * 8]), 2)]
