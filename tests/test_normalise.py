"""Left-alignment against one base at a time."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from quillon.operators import normalise


def leftmost(seq, pos, ref, alt):
    """Moves an allele pair to the left, base by base."""
    p, r, a = pos - 1, ref, alt
    if r == a:
        return pos, ref, alt
    while r and a and r[-1] == a[-1]:
        r, a = r[:-1], a[:-1]
    while r and a and r[0] == a[0]:
        p, r, a = p + 1, r[1:], a[1:]
    if r and a:
        return p + 1, r, a
    s = r or a
    while p and seq[p - 1] == s[-1]:
        p, s = p - 1, s[-1] + s[:-1]
    r, a = (s, "") if r else ("", s)
    return (p, seq[p - 1] + r, seq[p - 1] + a) if p else (1, r + seq[len(r)], a + seq[len(r)])


def applied(seq, pos, ref, alt):
    assert seq[pos - 1 : pos - 1 + len(ref)] == ref
    return seq[: pos - 1] + alt + seq[pos - 1 + len(ref) :]


@pytest.mark.parametrize("size,reach", [(16, 5), (32, 32), (normalise.TILE, normalise.REACH)])
def test_random_repeats(spark, size, reach):
    """Repeats of one to five bases, longer than tiles and rounds; the changed sequence stays the same."""
    rng = random.Random(size)
    seqs = {}
    for i in range(6):
        parts = ["".join(rng.choice("ACGT") for _ in range(rng.randint(0, 9))) + "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 5))) * rng.randint(1, 40) for _ in range(4)]
        seqs[f"c{i}"] = ("" if i % 2 else "AT" * 60) + "".join(parts)
    rows = []
    for k in range(400):
        c = rng.choice(list(seqs))
        seq = seqs[c]
        pos = rng.randint(1, len(seq) - 8)
        n, kind = rng.randint(1, 6), rng.choice("dimsx")
        ref = seq[pos - 1 : pos - 1 + (n + 1 if kind in "dx" else 1)]
        alt = {"d": ref[0], "i": ref + "".join(rng.choice(seq[pos : pos + 2]) for _ in range(n)), "m": ref + seq[pos : pos + n], "s": rng.choice("ACGT"), "x": ref[0] + rng.choice("ACGT") + ref[1:]}[kind]
        rows.append((k, c, pos, ref, alt))
    rows += [(1000, "c1", 1, seqs["c1"][0], seqs["c1"][0] * 2), (1001, "c0", 1, "AT" * 5, "AT" * 3)]
    df = spark.createDataFrame([*rows, (2000, "none", 5, "A", "AA"), (2001, "c0", 99_999, "A", "AA")], "id long, chrom string, pos long, ref string, alt string")
    got = {r.id: (r.pos, r.ref, r.alt) for r in normalise.left_aligned(df, spark.createDataFrame(list(seqs.items()), "chrom string, sequence string"), size, reach).collect()}
    assert len(got) == len(rows) + 2 and got[2000] == (5, "A", "AA") and got[2001] == (99_999, "A", "AA")
    for k, c, pos, ref, alt in rows:
        assert got[k] == leftmost(seqs[c], pos, ref, alt), (k, pos, ref, alt)
        assert applied(seqs[c], *got[k]) == applied(seqs[c], pos, ref, alt)
    assert sum(got[k][0] < pos - 64 for k, _, pos, _, _ in rows) > 5


def test_repeats_go(spark):
    df = spark.createDataFrame([("x", 1, "A", 5), ("x", 1, "A", 9), ("y", 1, "A", 2)], "caller string, pos long, ref string, ad long")
    assert sorted(map(tuple, normalise.without_repeats(df, ["caller", "pos", "ref"], df["ad"]).collect())) == [("x", 1, "A", 9), ("y", 1, "A", 2)]


def test_alike_by_halves(spark):
    """As many characters as alike() finds, at every length up to the reach."""
    texts = ["A" * n + t for n in range(0, 63) for t in ("", "C", "CA")] + [""]
    rows = [(x, y) for x in texts[::5] for y in texts[::7]]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", normalise.alike_upto(F.col("a"), F.col("b"), 64).alias("n")).collect()
    assert all(r.n == len(os.path.commonprefix([r.a, r.b])) for r in got) and len(got) == len(rows)


def test_one_round_for_short_contigs(spark, monkeypatch):
    """A repeat of 120 bases is passed in the one round that all variants take, and they are read once."""
    rounds, seen = [], normalise.observed
    monkeypatch.setattr(normalise, "observed", lambda df, *a, **m: rounds.append(1) or seen(df, *a, **m))
    seq = "GT" + "AC" * 60 + "T"
    rows = [(i, "c", 2 + i, seq[1 + i], seq[1 + i] + seq[2 + i : 4 + i]) for i in range(118)] + [(500, "c", 1, "G", "T"), (501, "c", 100, seq[99:102], seq[99])]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "id long, chrom string, pos long, ref string, alt string").mapInArrow(counted, "id long, chrom string, pos long, ref string, alt string")
    got = {r.id: (r.pos, r.ref, r.alt) for r in normalise.left_aligned(df, spark.createDataFrame([("c", seq)], "chrom string, sequence string")).collect()}
    assert got == {k: leftmost(seq, p, r, a) for k, _, p, r, a in rows}
    assert len(rounds) == 1 and read.value == len(rows)


def test_ends_and_gaps(spark):
    """Deletions at a contig's beginning that are longer than a tile, of a whole contig, behind the contig's end, and rows with nulls, which stay."""
    seq = "AC" * 20 + "G"
    rows = [(0, "c", 1, seq[:31], "A"), (1, "c", 3, seq[2:33], "A"), (2, "c", 41, "G", "GT"), (3, "c", 42, "GA", "G"), (4, "c", 43, "GA", "G"), (5, "c", 1, seq + "T", "T")]
    rows += [(6, "c", 5, None, "A"), (7, "c", None, "AC", "A"), (8, None, 5, "AC", "A"), (9, "c", 5, "A", None), (10, "c", 6, "", "CA"), (11, "c", 3, "ACAC", "ATAC"), (12, "n", 8, "CGC", "C")]
    df = spark.createDataFrame(rows, "id long, chrom string, pos long, ref string, alt string")
    contigs = spark.createDataFrame([("c", seq), ("n", "\u00c4" * 3 + "CGCGCGCG")], "chrom string, sequence string")
    got = {r.id: (r.pos, r.ref, r.alt) for r in normalise.left_aligned(df, contigs, 16, 3).collect()}
    want = {k: (p, r, a) for k, _, p, r, a in rows} | {k: leftmost(seq, *rows[k][2:]) for k in (0, 1, 2, 10, 11)} | {12: (3, "\u00c4CG", "\u00c4")}  # the base before the first one is no ASCII character
    assert got == want


def test_trimmed_at_every_length(spark):
    """Common ends of alleles of one base, of some and of more than 64."""
    rng = random.Random(8)
    rows = [(1, x + "A" * n + y, x + "A" * m + z) for n, m in itertools.product((0, 1, 2, 31, 63, 64, 65, 130), repeat=2) for x, y, z in (("", "", ""), ("C", "G", "T"), ("CT" * rng.randint(1, 40), "G", "G"))]
    got = normalise.trimmed(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, pos long, ref string, alt string")).collect()
    for r in got:
        _, ref, alt = rows[r.id]
        n = len(os.path.commonprefix([ref[::-1], alt[::-1]]))
        ref, alt = ref[: len(ref) - n], alt[: len(alt) - n]
        n = len(os.path.commonprefix([ref, alt]))
        assert (r._p, r._r, r._a) == (n, ref[n:], alt[n:])
