"""The pipeline against the same steps without Spark."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from quillon.llm import mixing, pieces
from tests.llm.test_cases import CLASH
from tests.llm.test_free import groups


def rules_keep(t):
    w = (t or "").split()
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    under = {p for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    return len(w) >= 50 and 100 * len(under) <= 50 * len(w)


def without_runs(rows, least=50):
    """Texts without the lines of runs of `least` words that occur earlier."""
    place, lines = defaultdict(list), {d: t.split("\n") for d, t in rows}
    for d, _ in rows:
        own = lines[d]
        for s in range(len(own)):
            for e in range(s, len(own)):
                place[tuple(own[s : e + 1])].append((d, s))
    out = []
    for d, t in rows:
        own, gone = lines[d], set()
        for s in range(len(own)):
            for e in range(s, len(own)):
                run = tuple(own[s : e + 1])
                if sum(len(x.split()) for x in run) >= least and min(place[run]) < (d, s):
                    gone.update(range(s, e + 1))
        left = "\n".join(x for i, x in enumerate(own) if i not in gone)
        if left.split() or not gone:
            out.append((d, left))
    return out


def test_stages(spark, docs, texts):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "ngram_join", "mixing", "pieces"]
    source = {r[0]: r[3] for r in texts}
    rows = [(d, t) for d, t, *_ in texts if rules_keep(t)]
    now = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, None)
        got = now.collect()
        now = spark.createDataFrame(got, now.schema)
        if k < 4:
            assert now.columns == docs.columns
        if k == 1:
            rows = without_runs(rows)
        if k == 2:
            keep = groups(rows, 5, 80)
            rows = [(d, t) for d, t in rows if keep[d][1] == d]
        if k < 3:
            assert sorted((r.doc_id, r.text) for r in got) == sorted(rows)
        if k == 3:
            tokens = Counter()
            for d, t in rows:
                tokens[source[d]] += len(t.split())
            taken = Counter(r.doc_id for r in got)
            assert set(taken) == {d for d, _ in rows} and max(taken.values()) <= 2
            passed = Counter()
            for d, t in rows:
                passed[source[d]] += taken[d] * len(t.split())
            assert all(passed[s] <= 2 * tokens[s] for s in tokens)
    lattice, text = pieces.Lattice(pieces.model_path()), dict(rows)
    assert sorted(r.doc_id for r in got) == sorted(taken.elements()) and all(r.round_trip and lattice.decode(__import__("numpy").array(r.ids)) == text[r.doc_id] for r in got)


def test_odd_rows_pass(spark, odd, none):
    for first in (odd, none):
        now = first
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, None)
            now = spark.createDataFrame(out.collect(), out.schema)
        assert now.count() == 0


def test_clashing_names_pass_all_stages(spark, docs):
    wide = docs.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASH])
    now = wide
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, None)
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == wide.columns
        now = spark.createDataFrame(out.collect(), out.schema)
    assert now.count() and all(r[c] == f"{c} {r['doc_id']}" for r in now.collect() for c in CLASH if c in now.columns)


def test_registered():
    found = entry.queries()
    assert "pipeline" in found and all(any(q.startswith(f"op{n}_") for q in found) for n in range(1, 14))
    assert mixing.PLAN == ["weight", "epoch", "block_rank", "place"]
