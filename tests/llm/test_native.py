"""Quality rules, line dedup and mixing: DuckDB's rows, and the defined cases."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from quillon.llm import line_dedup, mixing, oracle, quality_rules, queries
from tests.test_queries import ordered

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_same_rows(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    found = con.execute(oracle.ORACLE[name])
    names = [d[0] for d in found.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    assert ordered(df.select(*names).collect()) == ordered(found.fetchall())


def test_no_python_in_native_plans(spark, docs):
    for df in (quality_rules.apply_rules(docs), line_dedup.dedup_lines(docs), mixing.mix(docs)):
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_rules_on_odd_rows(odd, none):
    got = quality_rules.apply_rules(odd.withColumn("kept", F.lit("clash")))
    rows = got.collect()
    assert len(rows) == odd.count() and got.columns.count("kept") == 1
    null = next(r for r in rows if r.doc_id == 2)
    assert (null.n_words, null.word_chars, null.n_repeat_words, null.base_failed, null.kept) == (0, 0, 0, True, False)
    assert all(r.n_repeat_words == 90 for r in rows if r.doc_id == 1 and r.n_words == 90)
    assert quality_rules.apply_rules(none).count() == 0


def test_host_verdict(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, good, None, "bad" if i < 5 else "fine", 0) for i in range(10)] + [(100 + i, "short", None, "bad", 0) for i in range(60)] + [(200 + i, good, None, "fine", 0) for i in range(60)]
    got = quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert all(r.kept == (r.source == "fine") for r in got if not r.base_failed)


def test_many_repeated_windows(spark):
    t = " ".join(f"w{i % 50}" for i in range(400)) + " " + " ".join(f"v{i}" for i in range(20))
    assert quality_rules.measures(spark.createDataFrame([(1, t)], "doc_id long, text string")).first().n_repeat_words == 400


def test_lines_on_odd_rows(odd, none):
    got = line_dedup.dedup_lines(odd.withColumn("n_runs", F.lit(9)), min_words=3)
    assert Counter((r.doc_id, r.lang) for r in got.collect()) == Counter((r.doc_id, r.lang) for r in odd.collect())
    assert {r.text for r in got.where("doc_id = 2").collect()} == {None} and got.where("doc_id = 3").first().text == ""
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_runs(spark):
    a, b, c = "one two three", "four five", "six seven eight nine"
    rows = [(1, "\n".join([a, b, "x1", c])), (2, "\n".join(["y1", a, "", b, "z1"])), (3, "\n".join([b, c, a, b])), (4, "\n".join([a, b, a, b]))]
    got = {r.doc_id: (r.text, r.n_deleted, r.n_runs) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_words=5).collect()}
    assert got[1][1] == 0 and got[2] == ("y1\nz1", 3, 1) and got[3] == ("\n".join([b, c]), 2, 1) and got[4] == ("", 4, 1)


def test_mixing_keeps_all_and_limits(docs, odd, none):
    got = mixing.mix(docs, max_repetition=2.0)
    n = Counter(r.doc_id for r in got.collect())
    assert set(n) == {r.doc_id for r in docs.collect()} and set(n.values()) <= {1, 2} and 2 in n.values()
    assert mixing.mix(none).count() == 0
    assert Counter(str(r.doc_id) for r in mixing.mix(odd.withColumn("epoch", F.lit(1))).collect()).keys() == {str(r.doc_id) for r in odd.collect()}


def test_mixing_targets(spark):
    src = spark.createDataFrame([("a", 800), ("b", 150), ("c", 50)], "source string, tokens long")
    import math

    def entropy(x):
        w = [t**x for t in (800, 150, 50)]
        return -sum(v / sum(w) * math.log(v / sum(w)) for v in w)

    x = mixing.exponent(src, entropy=0.9)
    assert abs(entropy(x) - 0.9) < 1e-6
    y = mixing.exponent(src, max_repetition=2.0)
    assert abs((800 / 50) ** (1 - y) - 2.0) < 1e-6
    rows = spark.createDataFrame([(i, "a" if i < 80 else "b", 0, 10) for i in range(100)], "doc_id long, source string, th long, tokens long")
    taken = mixing.plan(rows, max_repetition=None, entropy=0.69, budget=500.0)
    each = {r.source: r.n for r in taken.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
    assert 200 <= each["a"] <= 300 and sum(each.values()) <= 500


def test_mixing_keeps_all_of_many_tokens(spark):
    """A budget over 1e9 tokens, where a weight of nine decimals is off by more than a token."""
    sizes = {"a": 2_000_000_000, "b": 500_000_000, "c": 70_000_000}
    rows = spark.createDataFrame([(10 * k + i, s, 0, n) for k, (s, n) in enumerate(sizes.items()) for i in range(10)], "doc_id long, source string, th long, tokens long")
    n = Counter(r.doc_id for r in mixing.plan(rows, max_repetition=2.0).collect())
    assert set(n) == {r.doc_id for r in rows.collect()} and max(n.values()) <= 2
