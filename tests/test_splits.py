"""Files cut anywhere give each record once."""

import gzip
import io
import random
import struct

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

from quillon.sources import files, splits
from tests.test_sources import _block, _record


class Raw(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def reads(rng, n, longest=30):
    out = []
    for i in range(n):
        k = rng.randint(0, longest)
        out.append((f"r{i}", "".join(rng.choice("ACGTN") for _ in range(k)), "".join(rng.choice("@+@+IJ#") for _ in range(k))))
    return out


def text(records, end="\n"):
    return "".join(f"@{n} extra{end}{s}{end}+{'' if i % 2 else n}{end}{q}{end}" for i, (n, s, q) in enumerate(records))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_fastq_cut_anywhere(end):
    """Lines of qualities begin with @ and + as they like."""
    records = reads(random.Random(1), 40)
    raw = text(records, end).encode()
    for data in (raw, raw.removesuffix(end.encode())):
        for cut in range(1, len(data)):
            got = [x for lo, hi in ((0, cut), (cut, len(data))) for x in splits.fastq_records(Raw(data), lo, hi, len(data), False)]
            assert got == records, cut
    for size in (1, 17, 100):
        assert [x for lo, hi in splits.ranges(len(raw), size) for x in splits.fastq_records(Raw(raw), lo, hi, len(raw), False)] == records


def test_fastq_in_blocks():
    """Blocks end within records, at their ends, and between lines."""
    rng = random.Random(2)
    records = reads(rng, 120)
    raw, at, blocks = text(records).encode(), 0, []
    breaks = [i + 1 for i, c in enumerate(raw) if c == 10]
    while at < len(raw):
        end = rng.choice([at + rng.randint(1, 300), next((b for b in breaks if b > at), len(raw))])
        blocks.append(_block(raw[at:end]))
        at = end
    data = b"".join([*blocks, _block(b"")])
    for size in (1000, 333, len(data)):
        assert [x for lo, hi in splits.ranges(len(data), size) for x in splits.fastq_records(Raw(data), lo, hi, len(data), True)] == records
    assert splits.is_blocked(Raw(data)) and not splits.is_blocked(Raw(gzip.compress(raw)))
    with pytest.raises(ValueError, match="not a FASTQ"):
        list(splits.fastq_records(Raw(b"@r\nAC\n+\nI\n"), 0, 10, 10, False))


@pytest.fixture(scope="module")
def bam():
    rng = random.Random(3)
    names = [("c1", 5000), ("c2", 90_000)]
    head = b"BAM\1" + struct.pack("<ii", 0, 2) + b"".join(struct.pack("<i", 3) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in names)
    data, want = head, []
    for i in range(400):
        ref = rng.choice([0, 1, 1, -1])
        n, pos = rng.choice([0, 5, 60, 900]), rng.randint(0, names[ref][1] - 1) if ref >= 0 else -1
        tags = b"XBBC" + struct.pack("<i", 40) + bytes(rng.choice([0, 0, 1, 255]) for _ in range(40)) if i % 3 == 0 else b""
        data += _record(f"r{i}", ref, pos, [(n, 0)] if n and ref >= 0 else [], "".join(rng.choice("ACGT") for _ in range(n)), tags)
        want.append((f"r{i}", names[ref][0] if ref >= 0 else None, pos))
    at, blocks, starts = 0, [], []
    while at < len(data):
        end = at + rng.choice([1, 50, 700, 4000])
        starts.append(sum(map(len, blocks)))
        blocks.append(_block(data[at:end]))
        at = end
    return b"".join([*blocks, _block(b"")]), want, len(head), starts


def named(found):
    return [r[32 : 32 + r[8] - 1].decode() for r in found]


def test_alignments_cut_anywhere(bam):
    data, want, head, starts = bam
    lengths, names = [5000, 90_000], [w[0] for w in want]
    for size in (700, 5000, 20_000, len(data)):
        assert named(x for lo, hi in splits.ranges(len(data), size) for x in splits.alignments(Raw(data), lo, hi, len(data), head, lengths)) == names
    for cut in [c + d for c in starts[1::9] for d in (-1, 0, 1)]:
        assert named(x for lo, hi in ((0, cut), (cut, len(data))) for x in splits.alignments(Raw(data), lo, hi, len(data), head, lengths)) == names, cut


def test_sources_are_split(spark, bam, tmp_path):
    files.register(spark)
    data, want, _, _ = bam
    (tmp_path / "a.bam").write_bytes(data)
    df = spark.read.format("bam").option("split", 9000).load(str(tmp_path / "a.bam"))
    assert df.rdd.getNumPartitions() == -(-len(data) // 9000) > 3
    assert sorted((r.name, r.chrom, r.start) for r in df.collect()) == sorted(want)
    few = spark.read.format("bam").option("split", 9000).option("columns", "name,chrom,start").load(f"file://{tmp_path}/a.bam")
    assert few.columns == ["name", "chrom", "start"]
    got = few.where("chrom = 'c2' AND start >= 30000 AND start < 60000 AND name <> 'r7'").collect()
    assert sorted(r.name for r in got) == sorted(n for n, c, s in want if c == "c2" and 30_000 <= s < 60_000 and n != "r7") and got
    records = reads(random.Random(5), 3000)
    (tmp_path / "a.fastq").write_text(text(records))
    df = spark.read.format("fastq").option("split", 9000).load(str(tmp_path / "a.fastq"))
    assert df.rdd.getNumPartitions() > 10 and sorted(map(tuple, df.collect())) == sorted(records)


def test_conditions_choose_windows(tmp_path):
    """Of an indexed file, only windows that may have such alignments are read."""
    contigs = b"BAM\1" + struct.pack("<ii", 0, 2) + b"".join(struct.pack("<i", 3) + n + b"\0" + struct.pack("<i", 100_000) for n in (b"c1", b"c2"))
    (tmp_path / "a.bam").write_bytes(_block(contigs))
    index = b"BAI\1" + struct.pack("<i", 2) + 2 * (struct.pack("<i", 0) + struct.pack("<i", 7) + struct.pack("<7Q", *[1 << 16] * 7))
    (tmp_path / "a.bam.bai").write_bytes(index)
    reader = files.BamReader(str(tmp_path / "a.bam"), 16_384)
    rest = list(reader.pushFilters([EqualTo(("chrom",), "c2"), GreaterThanOrEqual(("start",), 40_000), LessThan(("start",), 50_000), EqualTo(("name",), "x")]))
    assert rest == [EqualTo(("name",), "x")] and [(p.contig, p.start) for p in reader.partitions()] == [("c2", 32_768), ("c2", 49_152)]
    assert len(files.BamReader(str(tmp_path / "a.bam"), 16_384).partitions()) == 15
