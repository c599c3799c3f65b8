"""Quality rules: counts of bad signs, and a log-likelihood ratio of hashed n-grams."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.skew import lookup
from shopstar.llm.tables import Spool, aside, beside, restored
from shopstar.llm.text import WORD, row_id, whole

# Runs of letters and digits, or of anything else but blanks.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"  # what is left out when symbols are counted


@dataclass(frozen=True)
class QualityRules:
    """min_words and max_repeat_percent are the base rules.

    buckets: size of both multinomials. prior: added to every bucket, on the
    scale of the target's counts. min_score: documents whose mean log ratio per
    n-gram is lower are rejected.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    buckets: int = 1 << 15
    prior: float = 20.0
    min_score: float = -0.35


def count_signs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    A word belongs to n_repeat_words if a 3-word window that holds it occurs at
    least twice in the text. All counts stay within the row.
    """
    t = whole(text)
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    df = docs.withColumns({
        "_words": F.regexp_extract_all(t, F.lit(WORD), 0),
        "_lines": lines,
        "n_symbols": F.length(F.regexp_replace(t, SYMBOLS, "")).cast("bigint"),
    })
    df = df.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "_threes": F.arrays_zip(*[F.slice(
            "_words", F.lit(i + 1), F.greatest(F.size("_words") - 2, F.lit(0))).alias(f"w{i}") for i in range(3)]),
    })
    df = df.withColumn("_windows", F.transform("_threes", lambda w: F.xxhash64(w)))
    df = df.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    same = lambda e, at: F.coalesce(e["h"] == F.get("_sorted", at)["h"], F.lit(False))
    df = df.withColumn("_starts", F.array_sort(F.transform(
        F.filter("_sorted", lambda e, i: same(e, i - 1) | same(e, i + 1)), lambda e: e["at"])))
    covered = F.aggregate(
        F.transform("_starts", lambda s, i: F.coalesce(
            F.least(F.get("_starts", i + 1) - s, F.lit(3)), F.lit(3))),
        F.lit(0), lambda a, x: a + x)
    return df.withColumn(
        "n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")
    ).drop("_words", "_lines", "_threes", "_windows", "_sorted", "_starts")


def token_pairs() -> Column:
    """Every token and the one after it; none follows the last."""
    tokens = F.col("_tokens")
    return F.arrays_zip(tokens.alias("token"), F.slice(tokens, F.lit(2), F.size(tokens)).alias("after"))


def pair_buckets(pair: Column, rules: QualityRules) -> tuple[Column, Column]:
    """Buckets of a single token and of the token with its neighbour."""
    def bucket(*parts: Column) -> Column:
        h = F.xxhash64(*parts)
        if rules.buckets & (rules.buckets - 1) == 0:
            return h.bitwiseAND(F.lit(rules.buckets - 1).cast("bigint")).cast("int")
        return F.pmod(h, F.lit(rules.buckets)).cast("int")

    token = pair["token"]
    return bucket(token), bucket(token, F.lit(" "), F.coalesce(pair["after"], F.lit("")))


def tokenised(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("_tokens", F.regexp_extract_all(whole(text), F.lit(TOKEN), 0))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the trusted target, all of them."""
    return labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()


def log_ratios(docs: DataFrame, target: DataFrame, rules: QualityRules, spool: Spool,
               text: str = "text", cfg: RetailConfig = RetailConfig()) -> DataFrame:
    """One row: `ratios`, for every bucket the log of the target's over the corpus's share.

    Both counts cover every n-gram of every document, of the corpus and of the
    target. Trusted ids are sent to the documents while their number is small, and
    are joined by shuffle beyond that; the counts are the same. The corpus counts
    are scaled to the target's size before the prior is added, so that a rare
    n-gram, which says little, gets a ratio near 0. Without a target all ratios
    are 0.
    """
    ids = spool.write(target.select("doc_id", F.lit(1).alias("_target")), "target")
    own = docs.select("doc_id", text, F.xxhash64(text).alias("_at"))
    flagged = lookup(own, ids, ["doc_id"], cfg, "_at", "left", docs, ids)
    pairs = tokenised(flagged, text).select(
        F.coalesce("_target", F.lit(0)).alias("_target"), F.explode(token_pairs()).alias("_pair"))
    grams = pairs.select("_target", F.explode(F.array(*pair_buckets(F.col("_pair"), rules))).alias("bucket"))
    counts = spool.write(
        grams.groupBy("bucket").agg(F.count("*").alias("n_all"), F.sum("_target").alias("n_good")),
        "counts")
    n_all, n_good = counts.agg(F.sum("n_all"), F.sum("n_good")).first()
    scale = (n_good or 0) / (n_all or 1)
    ratio = F.when(F.lit(bool(n_good)), F.log(
        (F.col("n_good") + rules.prior) / (F.col("n_all") * scale + rules.prior)))
    buckets = docs.sparkSession.range(rules.buckets).select(F.col("id").cast("int").alias("bucket"))
    dense = buckets.join(counts, "bucket", "left").select(
        "bucket", F.coalesce(ratio, F.lit(0.0)).alias("ratio"))
    return dense.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "ratio"))).alias("_all")
    ).select(F.transform("_all", lambda e: e["ratio"]).alias("ratios"))


def mean_ratios(docs: DataFrame, model: DataFrame, rules: QualityRules, text: str = "text") -> DataFrame:
    """(r1, r2, mean): per row of `docs`, by hash, the mean ratio over the n-grams of its text.

    The model is one row of `buckets` doubles, of fixed size, and every executor
    gets it. Tokens are rows here, so that hashing, look-up and sums are generated
    code; the sums of a text are complete within the task that reads it, and one row
    per document is what leaves it. Texts without tokens have no row.
    """
    r1, r2 = row_id("doc_id", text)
    pairs = tokenised(docs.select(r1.alias("r1"), r2.alias("r2"), text), text).select(
        "r1", "r2", F.explode(token_pairs()).alias("_pair"))
    ratios = model.scalar()
    both = reduce(Column.__add__, [F.get(ratios, b) for b in pair_buckets(F.col("_pair"), rules)])
    return pairs.groupBy("r1", "r2").agg((F.sum(both) / (2 * F.count("*"))).alias("mean"))


SIGNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def apply_rules(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules(),
                text: str = "text") -> DataFrame:
    """`docs` with the counts, score, base_failed and kept.

    Null and empty texts have no word and fail the base rules. Repeated rows are
    judged one by one and alike. Ids that are null or have no label only miss
    from the target. An empty table gives an empty one.
    """
    spool = Spool(docs.sparkSession, "quality-rules")
    model = log_ratios(docs, trusted_ids(labels), rules, spool, text)
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))

    def work(own: DataFrame) -> DataFrame:
        r1, r2 = row_id("doc_id", text)
        means = mean_ratios(own, model, rules, text)
        return count_signs(own, text).withColumns({"r1": r1, "r2": r2}).join(means, ["r1", "r2"], "left").withColumns({
            "score": F.round(F.coalesce("mean", F.lit(0.0)), 9), "base_failed": failed}).withColumn(
            "kept", ~F.col("base_failed") & (F.col("score") >= rules.min_score))

    return beside(docs, ["doc_id", text], [*SIGNS, "score", "base_failed", "kept"], work)


def passing(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules(),
            text: str = "text") -> DataFrame:
    """The rows of `docs` that the rules keep, with their own columns.

    The row number is there for the optimizer only: as it is not deterministic,
    the filter stays above the arrays, which it would else build per element.
    """
    judged = apply_rules(aside(docs, "doc_id", text), labels, rules, text).withColumn(
        "_row", F.monotonically_increasing_id())
    return restored(judged.filter(F.col("kept") & (F.col("_row") >= 0)), docs)
