"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every text gets counts (words, symbols, repeated lines, repeated three-word
windows). A rule rejects a text whose rate lies beyond a cutoff. Cutoffs are
chosen per stratum (``lang``) on labelled texts: for each candidate cutoff the
exact binomial tail tests whether its rate of false rejection (label 1 texts it
would reject) can be as high as ``alpha / rules``; with Bonferroni's correction
over all strata, rules and candidates the strictest cutoff that passes is taken.
So with confidence ``1 - delta`` no stratum loses more than ``alpha`` of its
good texts to the rules. A stratum with too few labels keeps its rules off.

Defined results: null texts count as empty; a null ``lang`` is a stratum of its
own; empty tables give no rows; texts that are repeated rows stay repeated;
without labels only the base rules act. Three-word windows are compared by a
64-bit hash inside one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockroom.session import ensure_checkpoint_dir

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
ALPHA, DELTA = 0.03, 0.05
#: rule -> (numerator, denominator, rejected side, candidate cutoffs)
RULES = {
    "symbols": ("n_symbols", "n_words", "above", [0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.6, 1.0, 2.0]),
    "dup_lines": ("n_dup_lines", "n_lines", "above", [0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]),
    "repeats": ("n_repeat_words", "n_words", "above", [0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4]),
    "long_words": ("word_chars", "n_words", "above", [6.0, 6.5, 7.0, 7.5, 8.0, 9.0, 10.0, 12.0, 15.0]),
    "short_words": ("word_chars", "n_words", "below", [4.2, 4.0, 3.8, 3.6, 3.4, 3.2, 3.0, 2.5, 2.0]),
}
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def text_metrics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, METRICS, n_lines and base_failed."""
    white = F.lit(" \t\n\x0b\x0c\r")
    t = docs.select(*keep, F.coalesce("text", F.lit("")).alias("t__"))
    t = t.withColumn("trimmed__", F.trim(F.col("t__"), white))
    t = t.withColumn("w__", F.when(F.col("trimmed__") == "", F.array().cast("array<string>"))
                     .otherwise(F.split("trimmed__", WORD_GAP)))
    t = t.withColumn("l__", F.filter(F.split("t__", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    w = F.col("w__")
    t = t.withColumn("n_words", F.size(w).cast("long"))
    hashes = F.transform(F.slice(w, F.lit(1), F.size(w) - 2),
                         lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    t = t.withColumn("h__", F.when(F.col("n_words") >= 3, hashes).otherwise(F.array().cast("array<bigint>")))
    t = t.withColumn("d__", F.size(F.array_distinct("h__")) < F.size("h__"))
    # Positions of windows found again: neighbours after sorting by hash.
    t = t.withColumn("s__", F.when(F.col("d__"), F.sort_array(
        F.transform("h__", lambda x, i: F.struct(x.alias("k"), i.alias("p"))))))
    s = F.col("s__")
    again = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["k"] == x["k"], F.lit(False))
                     | F.coalesce(F.get(s, i + 1)["k"] == x["k"], F.lit(False)))
    t = t.withColumn("p__", F.when(F.col("d__"), F.sort_array(F.transform(again, lambda x: x["p"]))))
    p = F.col("p__")
    covered = F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    return t.select(
        *keep, "n_words",
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t__", SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("l__") - F.size(F.array_distinct("l__"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("d__"), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("l__").cast("long").alias("n_lines"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                 | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def rate(rule: str) -> Column:
    num, den, _, _ = RULES[rule]
    return F.col(num) / F.greatest(F.col(den), F.lit(1))


def beyond(rule: str, cutoff: Column) -> Column:
    return rate(rule) > cutoff if RULES[rule][2] == "above" else rate(rule) < cutoff


def _log_gamma(x: Column) -> Column:
    """Stirling's series behind a shift by eight (error below 1e-11)."""
    z = x + 8
    shift = F.lit(0.0)
    for i in range(8):
        shift = shift + F.log(x + i)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.9189385332046727 + series - shift


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) for k below n * p: terms from k downwards, and a
    geometric bound for what lies further down than any double can show."""
    nd, kd = n.cast("double"), k.cast("double")
    top = F.exp(_log_gamma(nd + 1) - _log_gamma(kd + 1) - _log_gamma(nd - kd + 1)
                + kd * F.log(F.lit(p)) + (nd - kd) * F.log(F.lit(1 - p)))
    steps = F.least(k, F.ceil(12 * F.sqrt(nd * p) + 60)).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(0), steps),
        F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda a, i: F.struct(
            (a["sum"] + a["term"]).alias("sum"),
            (a["term"] * (kd - i) * (1 - p) / ((nd - kd + i + 1) * p)).alias("term")),
        lambda a: a["sum"])
    return F.least(F.lit(1.0), top * total)


def cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per stratum the certified cutoff of each rule (null: rule off).
    ``labelled`` has the metrics, ``stratum`` and ``quality``; texts that the
    base rules reject take no part."""
    one_rule = alpha / len(RULES)
    sums = [F.count("*").alias("n")]
    cells = []
    for r, (_, _, _, grid) in RULES.items():
        for i, c in enumerate(grid):
            sums.append(F.sum(beyond(r, F.lit(c)).cast("long")).alias(f"{r}_{i}"))
            cells.append(F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.lit(i).alias("loose"),
                                  F.col(f"{r}_{i}").alias("k")))
    good = labelled.where((F.col("quality") == 1) & ~F.col("base_failed")).groupBy("stratum").agg(*sums)
    strata = good.count()   # one row a stratum
    tests = max(1, strata) * len(cells)
    tried = (good.select("stratum", "n", F.explode(F.array(*cells)).alias("c")).select("stratum", "n", "c.*")
             .withColumn("tail", F.when(F.col("k") < F.col("n") * one_rule,
                                        binomial_tail(F.col("n"), F.col("k"), one_rule)).otherwise(F.lit(1.0))))
    best = (tried.where(F.col("tail") <= delta / tests).groupBy("stratum", "rule")
            .agg(F.min_by("cutoff", "loose").alias("cutoff")))
    return best.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))


def judge(metrics: DataFrame, labels: DataFrame) -> DataFrame:
    """``metrics`` (with doc_id and stratum) plus ``kept``."""
    known = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    cuts = cutoffs(metrics.join(known, "doc_id"))
    out = metrics.join(cuts.withColumnRenamed("stratum", "cut_stratum"),
                       F.col("stratum") == F.col("cut_stratum"), "left")
    rejected = F.col("base_failed")
    for r in RULES:
        rejected = rejected | F.coalesce(beyond(r, F.col(r)), F.lit(False))
    return out.withColumn("kept", ~rejected).drop("cut_stratum", *RULES)


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, stratum, ``keep`` columns, metrics, base_failed, kept for every row of ``docs``."""
    ensure_checkpoint_dir(spark)
    rows = docs.withColumn("stratum", F.coalesce(F.col("lang"), F.lit("")))
    # The counts are needed twice (cutoffs, verdicts); the texts are read once.
    return judge(text_metrics(rows, ["doc_id", "stratum", *keep]).checkpoint(), labels)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    out = score_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", *METRICS, "base_failed", "kept")
