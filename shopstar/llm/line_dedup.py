"""Line dedup: drops lines that several documents share, but for one copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shopstar.llm.tables import Spool, beside
from shopstar.llm.text import BLANKS, hash_pair, lower_ascii, row_id, whole

# A key with more than this part of all shared lines is met by broadcast: there
# are fewer than 1 / HOT_SHARE of those, whatever the input.
HOT_SHARE = 0.001


def shared_lines(docs: DataFrame, min_length: int = 20, min_docs: int = 3) -> DataFrame:
    """(r1, r2, at): positions of the lines that go, and the rows (by hash) they are in.

    Lines are told apart by two 64-bit hashes of their key. A key is counted by
    document in two steps, pairs of key and document first and keys then, so a
    line that is everywhere is summed up before it meets in one task. The lines
    of such a key get their keeper by broadcast and are dealt by position in the
    join that serves all other keys, so they do not meet in one task there either.
    """
    r1, r2 = row_id("doc_id", "text")
    lines = docs.select(
        "doc_id", r1.alias("r1"), r2.alias("r2"),
        F.posexplode_outer(F.split(whole(), "\n", -1)).alias("at", "_line"))
    key = lower_ascii(F.btrim("_line", F.lit(BLANKS)))
    k1, k2 = hash_pair("line", F.col("_key"))
    keyed = (
        lines.withColumn("_key", key).filter(F.length("_key") >= min_length)
        .select("doc_id", "r1", "r2", "at", k1.alias("k1"), k2.alias("k2")))
    common = Spool(docs.sparkSession, "lines").write(
        keyed.groupBy("k1", "k2", "doc_id").agg(F.count("*").alias("_n"))
        .groupBy("k1", "k2").agg(
            F.count("doc_id").alias("_docs"), F.max("doc_id").alias("_keeper"), F.sum("_n").alias("_lines"))
        .filter(F.col("_docs") >= min_docs).select("k1", "k2", "_keeper", "_lines"), "common")
    is_hot = F.col("_lines") > common.agg(F.sum("_lines") * HOT_SHARE).scalar()
    hot = common.filter(is_hot).select("k1", "k2", F.col("_keeper").alias("_hot"))
    rest = common.filter(~is_hot).select(F.col("k1").alias("_j1"), F.col("k2").alias("_j2"), "_keeper")
    found = F.col("_hot").isNotNull()
    dealt = keyed.join(F.broadcast(hot), ["k1", "k2"], "left").select(
        "doc_id", "r1", "r2", "at", "_hot",
        F.when(found, F.col("r1")).otherwise(F.col("k1")).alias("_j1"),
        F.when(found, F.col("at")).otherwise(F.col("k2")).alias("_j2"))
    keeper = F.coalesce("_hot", "_keeper")
    return (
        dealt.join(rest, ["_j1", "_j2"], "left")
        .filter(keeper.isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") != keeper)))
        .select("r1", "r2", "at"))


def dedup_lines(docs: DataFrame, min_length: int = 20, min_docs: int = 3) -> DataFrame:
    """`docs` with n_lines, n_dropped and the text that is left in kept_text.

    A line's key is the line without blanks at both ends, A-Z lower-cased. Keys
    of at least min_length code points in at least min_docs documents stay only
    in the document of the largest doc_id, there in all their places. Null texts
    are one empty line, as empty ones are. Rows of the same doc_id are one
    document; a null doc_id counts as none and keeps no shared line. The lines
    of one text return to it by their position, and equal rows get equal results.
    """
    def work(own: DataFrame) -> DataFrame:
        gone = shared_lines(own, min_length, min_docs).groupBy("r1", "r2").agg(
            F.collect_set("at").alias("_gone"))
        r1, r2 = row_id("doc_id", "text")
        met = own.withColumns({"r1": r1, "r2": r2}).join(gone, ["r1", "r2"], "left")
        lines = F.split(whole(), "\n", -1)
        split = met.withColumn("_lines", F.when(F.col("_gone").isNotNull(), lines))
        left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
        return split.withColumns({
            "n_lines": F.when(F.col("_lines").isNull(), F.size(lines)).otherwise(
                F.size("_lines")).cast("bigint"),
            "n_dropped": F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint"),
            "kept_text": F.when(F.col("_lines").isNull(), whole()).otherwise(
                F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n")),
        })

    return beside(docs, ["doc_id", "text"], ["n_lines", "n_dropped", "kept_text"], work)
