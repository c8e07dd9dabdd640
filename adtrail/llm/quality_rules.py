"""Operator 8 (native): quality rules with risk-controlled thresholds.

Each rule measures one share of a text (symbols, repeated lines, ...); a text
is rejected where the share is above the rule's cutoff.  Cutoffs come from
labelled documents of good quality, per stratum: a cutoff may be used if the
exact binomial test shows that it falsely rejects at most ``alpha / rules`` of
the stratum's good documents.  The test level ``delta`` is divided among all
strata and rules (Bonferroni).  Along one rule's cutoffs, from the most lenient
on, false rejections only grow, so testing in that order needs no further
correction; the strictest cutoff that passes is taken.  With probability
``1 - delta`` no stratum loses more than ``alpha`` of its good documents.  A
stratum with too few labels has no cutoff and loses none by the rules.

DataFrame functions only: windows of words are hashed and sorted inside the
row (primitive longs), so no text or window is shuffled.

Defined results: null and empty texts have no words and fail the base rule.  A
null stratum is a stratum of its own.  Repeated rows are judged alike and each
counts as a label; where labels of one document differ, it is not good.  With
no labels at all only the base rule rejects.  Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.staging import Staging

# Fixed values of the base rules.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50

RULES = ("symbol_share", "dup_line_share", "repeat_share", "shout_share", "word_length")
ALPHA = 0.02      # good documents a stratum may lose, over all rules
DELTA = 0.05      # probability that any stratum loses more
STEPS = 1000      # cutoffs per rule: shares in thousandths


def features(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and the base counts and rule shares of every text.

    ``n_repeat_words`` compares windows by as many bits of a 64-bit hash as the
    window's position leaves free (49 of 64 bits for 32,000 words).
    """
    d = docs.select(*keep, F.coalesce(docs[text].cast("string"), F.lit("")).alias("__t"))
    d = d.select(*keep, "__t", F.filter(F.split("__t", SPACES), lambda w: w != "").alias("__w"),
                 F.filter(F.split("__t", "\n"), lambda x: x.rlike(NOT_SPACE)).alias("__l"))
    d = d.select(
        *keep, F.size("__w").cast("bigint").alias("n_words"),
        F.aggregate("__w", F.lit(0).cast("bigint"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.regexp_count("__t", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.regexp_count("__t", F.lit("[A-Z!]")).cast("bigint").alias("n_shouts"),
        F.size("__l").cast("bigint").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint").alias("n_dup_lines"),
        F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"),
        F.expr("shiftleft(1L, length(bin(size(__w)))) - 1").alias("__m"))
    # A window's hash above, its position below: one sort brings equal windows together.
    window = F.transform(
        F.expr("slice(__h, 1, greatest(size(__h) - 2, 0))"),
        lambda h, i: F.xxhash64(h, F.get("__h", i + 1), F.get("__h", i + 2)).bitwiseAND(F.bitwise_not("__m")).bitwiseOR(i.cast("bigint")))
    names = [c for c in d.columns if c not in ("__h", "__m")]
    d = d.select(*names, "__m", F.sort_array(window).alias("__s"))
    same = lambda x, y: F.coalesce(x.bitwiseXOR(y) .bitwiseAND(F.bitwise_not("__m")) == 0, F.lit(False))
    found = F.filter("__s", lambda x, i: same(x, F.get("__s", i - 1)) | same(x, F.get("__s", i + 1)))
    d = d.select(*names, F.sort_array(F.transform(found, lambda x: x.bitwiseAND(F.col("__m")))).alias("__p"))
    covered = F.aggregate(
        F.transform("__p", lambda p, i: F.least(F.lit(3).cast("bigint"), F.coalesce(F.get("__p", i + 1) - p, F.lit(3).cast("bigint")))),
        F.lit(0).cast("bigint"), lambda a, n: a + n)
    d = d.select(*names, covered.alias("n_repeat_words"))
    return d.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "symbol_share": _share("n_symbols", "word_chars"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "shout_share": _share("n_shouts", "word_chars"),
        "word_length": F.when(F.col("n_words") > 0, F.least(F.lit(STEPS), F.expr("word_chars * 25 div n_words"))).otherwise(0).cast("int"),
    })


def _share(part: str, whole: str) -> Column:
    """A share in thousandths, at most 1000; 0 of nothing is 0."""
    return F.when(F.col(whole) > 0, F.least(F.lit(STEPS), F.expr(f"{part} * {STEPS} div {whole}"))).otherwise(0).cast("int")


def _log_gamma(x: Column) -> Column:
    """Stirling's series, 10 above ``x`` (relative error under 1e-12)."""
    y = x + 10
    series = (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, 5))
    steps = F.lit(0.0)
    for i in range(10):
        steps = steps + F.ln(x + i)
    return series - steps


def binomial_cdf(k: str, n: str, p: float) -> Column:
    """P(Bin(n, p) <= k); 1 where k >= n * p (above a half in any case).

    The terms below ``k`` fall at least geometrically beyond some standard
    deviations, so the sum is cut where they no longer count in a double."""
    kk, nn = F.col(k).cast("double"), F.col(n).cast("double")
    top = F.exp(_log_gamma(nn + 1) - _log_gamma(kk + 1) - _log_gamma(nn - kk + 1)
                + kk * math.log(p) + (nn - kk) * math.log1p(-p))
    terms = F.least(kk, F.ceil(60 + 12 * F.sqrt(nn * p))).cast("bigint")
    zero = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s"))
    total = F.aggregate(
        F.sequence(F.lit(0).cast("bigint"), terms), zero,
        lambda a, i: F.struct((a["t"] * (kk - i) * (1 - p) / ((nn - kk + i + 1) * p)).alias("t"), (a["s"] + a["t"]).alias("s")),
        lambda a: a["s"])
    return F.when(kk >= nn * p, F.lit(1.0)).otherwise(top * total)


def fit_cutoffs(good: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum, one cutoff column ``max_<rule>`` per rule (null: none).

    ``good`` has ``stratum`` and the rule columns, a row per labelled good
    document.  Only counts per (stratum, rule, thousandth) are shuffled."""
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES])).alias("x")
    bins = good.select("stratum", pairs).select("stratum", "x.*").groupBy("stratum", "rule", "value").agg(F.count(F.lit(1)).alias("n_here"))
    sizes = bins.groupBy("stratum", "rule").agg(F.sum("n_here").alias("n"), F.collect_list(F.struct("value", "n_here")).alias("bins"))
    strata = bins.agg(F.greatest(F.count_distinct("stratum"), F.lit(1)).alias("n_strata"))
    # A cutoff just below each value that occurs, and none below 0: at most 1000 per rule.
    cutoffs = sizes.select("stratum", "rule", "n", "bins", F.explode(F.transform("bins", lambda b: b["value"])).alias("cutoff"))
    lost = cutoffs.withColumn("k", F.aggregate(
        "bins", F.lit(0).cast("bigint"), lambda a, b: a + F.when(b["value"] > F.col("cutoff"), b["n_here"]).otherwise(0)))
    tested = lost.withColumn("p", binomial_cdf("k", "n", alpha / len(RULES))).join(F.broadcast(strata))  # one row
    passed = tested.filter(F.col("p") <= delta / (len(RULES) * F.col("n_strata")))
    return passed.groupBy("stratum").agg(
        *[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in RULES])


def good_documents(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled documents of good quality that pass the base rules."""
    good = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.min(F.coalesce("quality", F.lit(0))).alias("__q")).filter("__q = 1")
    return feats.filter(~F.col("base_failed")).join(good, F.col("doc_id") == F.col("__id"), "left_semi")


def judge(feats: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``feats`` with ``kept``: false if the base rules fail or a share is above its cutoff."""
    ok = ~F.col("base_failed")
    for r in RULES:
        ok = ok & F.coalesce(F.col(r) <= F.col(f"max_{r}"), F.lit(True))
    joined = feats.join(cutoffs, "stratum", "left").withColumn("kept", ok)
    return joined.drop(*[f"max_{r}" for r in RULES])


def quality_rules(docs: DataFrame, labels: DataFrame, staging: Staging, stratum: str = "lang",
                  alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Base counts, rule shares and verdict per document (no text)."""
    # The counts are staged: the cutoffs and the verdicts read the same rows.
    feats = staging.table(_with_stratum(docs, stratum, ("doc_id",)), "quality_features")
    cutoffs = staging.table(fit_cutoffs(good_documents(feats, labels), alpha, delta), "quality_cutoffs")
    return judge(feats, cutoffs)


def _with_stratum(docs: DataFrame, stratum: str, keep: tuple[str, ...]) -> DataFrame:
    label = F.coalesce(F.concat(F.lit("="), docs[stratum].cast("string")), F.lit("none"))
    return features(docs.withColumn("stratum", label), keep=(*keep, "stratum"))


def keep_good(docs: DataFrame, labels: DataFrame, staging: Staging, stratum: str = "lang",
              alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The documents that the rules keep, with their own columns.  The counts
    are made again beside the rows: cheaper than shuffling the texts to them."""
    feats = staging.table(_with_stratum(docs, stratum, ("doc_id",)), "quality_features")
    cutoffs = staging.table(fit_cutoffs(good_documents(feats, labels), alpha, delta), "quality_cutoffs")
    rows = docs.select(F.struct("*").alias("__row"), docs["text"], docs[stratum].alias("__by"))
    # One struct per row, through explode: a filter is not pushed below it, where
    # it would take the place of the counts and compute them once per use.
    counted = _with_stratum(rows, "__by", ("__row",)).select(F.explode(F.array(F.struct("*"))).alias("__x")).select("__x.*")
    verdicts = judge(counted, cutoffs)
    return verdicts.filter("kept").select("__row.*")
