"""Bases of reads at sites: an interval join over the ways that reads lie, and a join of reads with these.

Reads of one contig, start and CIGAR meet the same sites at the same of their bases, so each such way is walked once, and its reads are counted for the sites' coverage. Sites are gathered by bins of their contig,
ways are dealt to the bins they span, and each meets only the sites within it. A batch's pairs of way and site find their CIGAR operation by one search over running ends of operations. Reads then take
bases and qualities by place; rows out are pairs of reads and sites, whatever the reads' length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.sources.tables import materialise

#: Bases of a bin, and pairs of ways and sites that a batch of results has, about.
BIN, PAIRS = 512, 200_000
SITE = ["feature", "pos_local_0based"]


def reference_length(cigar: str):
    """Bases of the reference that a CIGAR spans."""
    return F.aggregate(F.regexp_extract_all(F.coalesce(F.col(cigar), F.lit("")), F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0).cast("long"), lambda s, n: s + n.cast("long"))


def spanned(alignments: DataFrame, sites: DataFrame, size: int = BIN) -> DataFrame:
    """alignments with sites, the places that each spans, sorted: a row for each bin of the contig in which there is one."""
    bins = sites.select(*SITE).distinct().groupBy("feature", F.floor(F.col("pos_local_0based") / size).alias("_bin")).agg(F.sort_array(F.collect_list("pos_local_0based")).alias("_held"))  # at most `size` places
    end = F.col("start") + reference_length("cigar")
    reads = alignments.withColumn("_end", end).where(F.col("_end") > F.col("start"))
    reads = reads.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("_end") - 1) / size))))
    met = reads.join(bins, ["feature", "_bin"]).withColumn("sites", F.filter("_held", lambda x: (x >= F.col("start")) & (x < F.col("_end"))))
    return met.where(F.size("sites") > 0).drop("_bin", "_held", "_end")


def operations(cigar: str) -> list[tuple[int, int, str, int, int]]:
    """(first place on the reference, first base of the read, kind, length, signed length of the insertion or deletion behind it) of the operations that lie on the reference."""
    ops = [(int(n), o) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]
    at, q, out = 0, 0, []
    for i, (n, o) in enumerate(ops):
        if o in "M=XDN":
            after = ops[i + 1] if i + 1 < len(ops) and o in "M=X" and ops[i + 1][1] in "ID" else (0, "I")
            out.append((at, q, o, n, after[0] if after[1] == "I" else -after[0]))
            at += n
        if o in "M=XIS":
            q += n
    return out


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        many = np.cumsum(b.column(4).value_lengths().to_numpy(zero_copy_only=False))
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(many, (many[lo - 1] if lo else 0) + PAIRS)))
            yield _pairs(b.slice(lo, hi - lo))
            lo = hi


def _pairs(b: pa.RecordBatch) -> pa.RecordBatch:
    feature, start, cigar, reads, sites = b.columns
    row = np.repeat(np.arange(b.num_rows), sites.value_lengths().to_numpy(zero_copy_only=False))
    place = sites.flatten().to_numpy().astype(np.int64)
    coded = pc.dictionary_encode(cigar)
    ops = [operations(c) for c in coded.dictionary.to_pylist()]
    of = np.repeat(np.arange(len(ops)), [len(x) for x in ops])
    first, base, kind, n, after = (np.array(c) for c in zip(*(o for x in ops for o in x), strict=True))
    width = int((first + n).max()) + 1
    rel = place - start.to_numpy(zero_copy_only=False)[row]
    # operations of all CIGARs in one line: the last one that begins at or before the place
    op = np.searchsorted(of * width + first, coded.indices.to_numpy()[row] * width + rel, "right") - 1
    kind, inside = kind[op], rel - first[op]
    keep = kind != "N"
    row, place, op, kind, inside = row[keep], place[keep], op[keep], kind[keep], inside[keep]
    gone = kind == "D"
    size = np.where(~gone & (inside == n[op] - 1), after[op], 0)
    at = pa.array(row)
    cols = [feature.take(at), start.take(at), cigar.take(at), reads.take(at), pa.array(place), pa.array(base[op] + inside, pa.int64(), mask=gone), pa.array(size, pa.int64(), mask=gone)]
    return pa.RecordBatch.from_arrays(cols, ["feature", "start", "cigar", "_reads", "pos_local_0based", "_query", "indel_len"])


def walked(alignments: DataFrame, sites: DataFrame, size: int = BIN) -> DataFrame:
    """(feature, start, cigar, _reads, pos_local_0based, _query, indel_len): a row for each way that reads lie and each site that it spans, with the reads that lie so and the base of the read there; null where it is deleted."""
    lying = alignments.groupBy("feature", F.col("start").cast("long").alias("start"), "cigar").agg(F.count("*").alias("_reads"))
    met = spanned(lying, sites, size).select("feature", "start", "cigar", "_reads", "sites")
    return met.mapInArrow(_walked, "feature string, start long, cigar string, _reads long, pos_local_0based long, _query long, indel_len long")


def _own(alignments: DataFrame) -> DataFrame:
    return alignments.select("read_name", "feature", F.col("start").cast("long").alias("start"), "cigar", "sequence", F.col("qualities").cast("array<int>").alias("qualities"), F.col("mapping_quality").cast("int").alias("map_qual"))


def _read(own: DataFrame, walks: DataFrame) -> DataFrame:
    """Reads with the rows of the way they lie: bases, qualities and insertions by place."""
    query, size = F.col("_query").cast("int"), F.col("indel_len").cast("int")
    base = F.when(query.isNull(), "").when(query < F.length("sequence"), F.substring("sequence", query + 1, F.lit(1)))
    new = F.when(size > 0, F.coalesce(F.substring("sequence", query + 2, size), F.lit(""))).otherwise("")
    met = own.join(walks.drop("_reads"), ["feature", "start", "cigar"])
    return met.select("read_name", *SITE, base.alias("read_base"), F.get("qualities", query).alias("base_qual"), "map_qual", "indel_len", new.alias("inserted_seq"))


def met(alignments: DataFrame, sites: DataFrame, size: int = BIN) -> DataFrame:
    """A row for each read and site that it spans, deletions among them."""
    own = _own(alignments)
    return _read(own, materialise(walked(own, sites, size)))


def piled(alignments: DataFrame, sites: DataFrame, min_coverage: int = 0) -> DataFrame:
    """Every read's base at the sites (feature, pos_local_0based) that min_coverage reads or more span, deletions among them; a deleted base is empty and has no indel length.

    Alignments: read_name, feature, start from 0, cigar, sequence, qualities, mapping_quality. Skipped parts of the reference (N) are not spanned; a base behind the sequence's end is null, as is its quality.
    """
    own = _own(alignments)
    walks = materialise(walked(own, sites))
    if min_coverage > 1:
        deep = walks.groupBy(*SITE).agg(F.sum("_reads").alias("_n")).where(F.col("_n") >= min_coverage)
        walks = materialise(walks.join(deep.select(*SITE), SITE, "left_semi"))
    return _read(own, walks)


def pileup_snv(alignments: DataFrame, sites: DataFrame, min_coverage: int = 0) -> DataFrame:
    """(read_name, feature, pos_local_0based, read_base, base_qual, map_qual): bases of reads at the sites, without deleted ones."""
    return piled(alignments, sites, min_coverage).where("read_base <> ''").drop("indel_len", "inserted_seq")


def pileup_indel(alignments: DataFrame, anchors: DataFrame, min_coverage: int = 0) -> DataFrame:
    """(read_name, feature, pos_local_0based, indel_len, inserted_seq, map_qual): what follows the anchor in each read; null where the anchor itself is deleted."""
    return piled(alignments, anchors, min_coverage).drop("read_base", "base_qual")
