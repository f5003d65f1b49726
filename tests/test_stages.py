"""Steps that are off or find nothing, and merged tables that disagree."""

import pytest
from pyspark.sql import functions as F

from quillon.operators import stages
from quillon.operators import variants as V


def test_steps_end_early(spark):
    reads = spark.createDataFrame([("a", 3), ("b", 9)], "barcode string, n long")
    made = []

    def note(name, f):
        return lambda *x: made.append(name) or f(*x)

    steps = [
        stages.Step("cells", ("reads",), note("cells", lambda r: r.where("n > 5").select("barcode")), "barcode string", must="reads", reason="INSUFFICIENT_READS", message="none"),
        stages.Step("counts", ("reads", "cells"), note("counts", lambda r, c: r.join(c, "barcode", "left_semi")), "barcode string, n long", must="cells", message="no cells"),
        stages.Step("total", ("counts",), note("total", lambda c: c.agg(F.sum("n").alias("n"))), "n long"),
        stages.Step("plot", ("total",), note("plot", lambda t: t), "n long", on=False),
        stages.Step("page", ("plot",), note("page", lambda t: t), "n long"),
    ]
    tables, status = stages.run(spark, steps, {"reads": reads}, "s", "DNA", "amplicon")
    assert tables["total"].first()["n"] == 9 and tables["page"].count() == 0 and status.count() == 0 and made == ["cells", "counts", "total"]
    made.clear()
    tables, status = stages.run(spark, steps, {"reads": reads.where("n < 5")}, "s", "DNA", "amplicon")
    assert [tuple(r) for r in status.collect()] == [("s", "DNA", "amplicon", "counts", "NO_CELLS", "no cells")] and made == ["cells"]
    assert tables["counts"].dtypes == [("barcode", "string"), ("n", "bigint")] and tables["total"].count() == 0
    tables, status = stages.run(spark, steps, {"reads": reads.limit(0)}, "s", "DNA", "amplicon")
    assert [(r.process_name, r.reason_code) for r in status.collect()] == [("cells", "INSUFFICIENT_READS")]
    with pytest.raises(ValueError, match="needs other"):
        stages.run(spark, [stages.Step("x", ("other",), lambda o: o, "n long")], {}, "s", "DNA", "amplicon")
    with pytest.raises(ValueError, match="has columns"):
        stages.run(spark, [stages.Step("x", ("reads",), lambda r: r, "n long")], {"reads": reads}, "s", "DNA", "amplicon")


def test_merges_that_disagree(spark):
    raw = spark.createDataFrame([(i, "A" if i % 2 else None) for i in range(9)], "id long, alt string")

    def merge(raw, called, lost=0):
        alt = raw.where(F.col("id") >= lost).withColumn("row_type", F.lit("ALT"))
        return alt.unionByName(called.where("alt IS NULL").withColumn("row_type", F.lit("REF")))

    merged, counts = V.reconciled(raw, raw, merge)
    assert counts == {"raw_rows": 9, "reference_calls": 5, "alt_rows": 9, "ref_rows": 5, "status": "OK"} and merged.count() == 14
    assert "FileScan parquet" in merged._jdf.queryExecution().executedPlan().toString()
    assert V.reconciled(raw, raw, lambda a, b: merge(a, b, 1))[1]["status"] == "INCONSISTENT_MERGE"
