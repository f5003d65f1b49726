"""Quality rules with host-level verdicts, in DataFrame functions only.

Document rules give a failure or none. Failures are summed by host, each host's failure rate is
shrunk towards a beta prior fitted to all hosts by moments, and hosts whose shrunk rate is above a limit are
rejected with all their documents.

Defined cases: a null text counts as an empty one (no words: it fails); a null host is a host of its own;
repeated rows count each and are all returned; verdicts depend on no order, so there are no ties; an empty table gives an empty table; other columns of the input pass through
`apply_rules` unless their names are those of a result column, which then replaces them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import WS, cut, keep, name, words

RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate", "kept"]
#: Up to so many different repeated windows a text is looked through once for each; beyond, windows are sorted with their places.
FEW = 32


def _repeat_words(few: Column, many: Column, dups: Column) -> Column:
    """Words under windows of three that start at the given ascending places."""
    def total(at: Column) -> Column:
        steps = F.zip_with(F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1), lambda a, b: F.least(F.lit(3), b - a))
        return F.aggregate(steps, F.lit(3).cast("long"), lambda s, x: s + x)

    return F.when(F.size(dups) == 0, F.lit(0).cast("long")).when(F.size(dups) <= FEW, total(few)).otherwise(total(many))


def measures(df: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keys, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WS.replace("[", "[^", 1)))
    df = df.select(*keys, F.length(t).alias("_chars"), F.regexp_count(t, F.lit(WS)).alias("_gaps"), F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"), keep(_w=words(F.col(text)), _l=lines))
    n = F.size("_w")
    pair = F.zip_with(F.slice("_w", F.lit(1), F.greatest(n - 2, F.lit(0))), F.slice("_w", F.lit(2), F.greatest(n - 2, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    three = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(F.zip_with(pair, F.slice("_w", F.lit(3), F.greatest(n - 2, F.lit(0))), lambda h, c: F.xxhash64(h, c)))
    df = df.select(*keys, (F.col("_chars") - F.col("_gaps")).cast("long").alias("word_chars"), "n_symbols", n.cast("long").alias("n_words"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), keep(_h=three))
    df = df.select("*", keep(_s=F.sort_array("_h")))
    m = F.size("_s")
    short = F.greatest(m - 1, F.lit(0))
    again = F.filter(F.zip_with(F.slice("_s", F.lit(1), short), F.slice("_s", F.lit(2), short), lambda a, b: F.when(a == b, a)), lambda x: x.isNotNull())
    df = df.select(*[c for c in df.columns if c != "_s"], keep(_d=F.array_distinct(again)))
    few = F.filter(F.transform("_h", lambda x, i: F.when(F.array_contains("_d", x), i)), lambda i: i.isNotNull())
    placed = F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.select("*", keep(_few=F.when(F.size("_d") <= FEW, few), _p=F.when(F.size("_d") > FEW, placed)))
    k = F.size("_p")
    ends = F.zip_with(F.slice("_p", F.lit(1), k - 1), F.slice("_p", F.lit(2), k - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    df = df.select("*", keep(_many=F.when(k > 0, F.sort_array(F.array_distinct(F.flatten(ends))))))
    return df.select(*keys, "n_words", "word_chars", "n_symbols", "n_dup_lines", _repeat_words(F.col("_few"), F.col("_many"), F.col("_d")).alias("n_repeat_words"))


def base_failed(min_words: int = 50, max_repeat_pct: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))


def soft_failed() -> Column:
    """Further rules that count towards the host's rate but reject no document by themselves."""
    return (10 * F.col("n_symbols") > F.col("n_words")) | (2 * F.col("n_dup_lines") > F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words"))


def host_rates(docs: DataFrame, host: str, failed: str) -> DataFrame:
    """(host, n_docs, n_failed, host_rate): failure rates shrunk towards a beta prior fitted to the hosts' rates by moments.

    One row goes to the sums from each task and host, and one row of moments joins back, so a host with a third of all documents costs no more than another.
    """
    per = docs.groupBy(F.col(host).alias("_host")).agg(F.count("*").alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    got = per.agg(F.count("*").alias("n"), F.sum("n_docs").alias("docs"), F.sum("n_failed").alias("bad"), F.sum(rate * rate).alias("sq"), F.sum(rate).alias("s")).first()
    mean = got["s"] / got["n"] if got["n"] else 0.5
    var = got["sq"] / got["n"] - mean * mean if got["n"] else 0.0
    # where hosts don't differ, or there is one host, the prior is worth one document at the overall rate
    strength = max(1.0, mean * (1 - mean) / var - 1) if var > 1e-9 else 1.0
    return per.withColumn("host_rate", F.round((F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength)), 6))


def apply_rules(df: DataFrame, text: str = "text", host: str = "source", max_host_rate: float = 0.5, max_repeat_pct: int = 50, min_words: int = 50, drop_text: bool = False) -> DataFrame:
    """Every row of df with its measures, base_failed, host_rate and kept."""
    rest = [c for c in df.columns if c not in RESULT]
    carried = [c for c in rest if not (drop_text and c == text)]
    # one table holds rows and measures, so that texts are looked through once
    rows = df.select(F.struct(*[F.col(name(c)) for c in carried]).alias("_row"), F.col(name(text)).alias("_text"))
    part = cut(measures(rows, "_text", ("_row",)), "measures").withColumn("base_failed", base_failed(min_words, max_repeat_pct))
    host_of = F.col("_row").getField(host)
    rates = host_rates(part.select(host_of.alias("_h"), (F.col("base_failed") | soft_failed()).alias("_f")), "_h", "_f")
    # as a table its size is known: Spark broadcasts it only if it is small
    rates = cut(rates.select("_host", "host_rate"), "hosts")
    both = part.join(rates, host_of.eqNullSafe(F.col("_host")), "left")
    return both.select("_row.*", *RESULT[:6], "host_rate", (~F.col("base_failed") & (F.col("host_rate") <= max_host_rate)).alias("kept"))


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: the documents that the rules keep, with their own columns."""
    return apply_rules(docs.select(F.struct(*[F.col(name(c)) for c in docs.columns]).alias("doc"), "text", "source"), drop_text=True).where("kept").select("doc.*")
