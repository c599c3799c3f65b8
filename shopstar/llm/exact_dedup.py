"""Exact dedup: a stored index of text digests, met by sort-merge anti-join."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopstar.llm.tables import Spool, beside, exists
from shopstar.llm.text import whole

# A text with more than this part of all rows is met by broadcast: there are
# fewer than 1 / HOT_SHARE of those, whatever the input.
HOT_SHARE = 0.001


def digest_of(text: str = "text") -> Column:
    """SHA-256 of the UTF-8 text as 32 bytes."""
    return F.unhex(F.sha2(whole(text).cast("binary"), 256))


class DigestIndex:
    """The digests of all texts met so far and the id of the document that stays for each.

    A Parquet table, bucketed and sorted by digest, in a folder that outlives
    the session; opening the folder again continues it. Its rows are only ever
    appended. `buckets` is fixed when the index is made, by default as the
    session's number of shuffle partitions, so that a batch of that session
    meets the index without a shuffle of the index.

    A batch that is added again, after a failure or by mistake, changes nothing:
    its digests are known by then, with the same ids.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None, id_type: str = "bigint"):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.layout = f"{self.folder}/layout"
        if not exists(spark, self.layout):
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            self._point_to(0, buckets, id_type)
        self._open()

    def _point_to(self, generation: int, buckets: int, id_type: str) -> None:
        self.spark.createDataFrame(
            [(generation, buckets, id_type)], "generation int, buckets int, id_type string"
        ).coalesce(1).write.mode("append").parquet(self.layout)

    def _open(self) -> None:
        """Make the newest generation known to the session's catalog."""
        self.generation, self.buckets, self.id_type = self.spark.read.parquet(self.layout).orderBy(
            F.desc("generation")).first()
        self.table = self._declare(self.generation)

    def _declare(self, generation: int) -> str:
        path = f"{self.folder}/digests-{generation}"
        table = "digests_" + hashlib.md5(path.encode()).hexdigest()
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (digest BINARY, keep_id {self.id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return table

    def known(self) -> DataFrame:
        """(digest, keep_id), one row per text."""
        return self.spark.table(self.table)

    def unknown(self, arrivals: DataFrame) -> DataFrame:
        """(digest, keep_id) of the texts of `arrivals` (doc_id, digest) that are not known yet.

        Copies within the batch are summed up on the map side, so a text that is
        everywhere is one row per task when it meets the index. The row number is
        there for the optimizer only: as it is not deterministic, the anti-join
        stays above the sums, where it would else meet every single row.
        """
        own = arrivals.groupBy("digest").agg(F.max("doc_id").alias("keep_id")).withColumn(
            "_row", F.monotonically_increasing_id())
        return own.join(self.known().hint("merge"), "digest", "left_anti").filter("_row >= 0").select(
            "digest", "keep_id")

    def add(self, arrivals: DataFrame) -> None:
        """Append what is unknown() of the batch."""
        self.unknown(arrivals).write.insertInto(self.table)

    def compact(self) -> None:
        """Write every bucket as one sorted file again, in a folder of the next generation."""
        table = self._declare(self.generation + 1)
        self.known().repartition(self.buckets, "digest").write.insertInto(table, overwrite=True)
        self._point_to(self.generation + 1, self.buckets, self.id_type)
        self._open()


def arrivals(seen: DataFrame, batches: int) -> list[DataFrame]:
    """`seen` in batches of about equal size, those of the largest ids first, null ids last."""
    if batches < 2:
        return [seen]
    shares = [1 - n / batches for n in range(1, batches)]
    bounds = seen.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0]
    if not bounds:
        return [seen]
    edges = [None, *bounds, None]
    parts = []
    for upper, lower in zip(edges[:-1], edges[1:], strict=True):
        below = F.lit(True) if upper is None else F.col("doc_id").isNull() | (F.col("doc_id") < upper)
        parts.append(seen.filter(below if lower is None else below & (F.col("doc_id") >= lower)))
    return parts


def mark_copies(docs: DataFrame, index: DigestIndex | None = None, batches: int = 2) -> DataFrame:
    """`docs` with keep_id, group_size, kept and text_sha256.

    Texts are equal if they are identical; null counts as empty. For every text,
    keep_id is the document that stays: the one in `index` if the text was known
    before, else the largest doc_id in `docs`. group_size counts the rows of
    `docs` with this text. The digests arrive at the index in batches by falling
    id, so the first document it sees is the one that stays.

    Rows of the same doc_id and text are one document and stay or go together,
    those without an id only if no copy has one. An empty table gives an empty
    one. Other columns pass through; own ones with the added names are replaced.
    """
    spark = docs.sparkSession
    spool = Spool(spark, "exact-dedup")
    if index is None:
        index = DigestIndex(spark, spool.path("index"), id_type=docs.schema["doc_id"].dataType.simpleString())

    def work(own: DataFrame) -> DataFrame:
        seen = spool.write(own.select("doc_id", digest_of().alias("digest")), "digests")
        for batch in arrivals(seen, batches):
            index.add(batch)
        sizes = seen.groupBy("digest").agg(F.count("*").alias("group_size"))
        groups = spool.write(sizes.join(index.known().hint("merge"), "digest"), "groups")
        is_hot = F.col("group_size") > seen.count() * HOT_SHARE
        hot = groups.filter(is_hot).select(
            F.col("digest").alias("_digest"), F.col("group_size").alias("_n"), F.col("keep_id").alias("_keep"))
        # Rows of a common text have their group by now; a key shorter than any digest deals them out.
        dealt = own.withColumn("_digest", digest_of()).join(F.broadcast(hot), "_digest", "left").withColumn(
            "digest", F.when(F.col("_n").isNull(), F.col("_digest")).otherwise(
                F.monotonically_increasing_id().cast("string").cast("binary")))
        keep = F.when(F.col("_n").isNull(), F.col("keep_id")).otherwise(F.col("_keep"))
        return (
            dealt.join(groups.filter(~is_hot).hint("merge"), "digest", "left")
            .withColumns({"keep_id": keep, "group_size": F.coalesce("_n", "group_size")})
            .withColumns({"kept": F.col("doc_id").eqNullSafe(F.col("keep_id")),
                          "text_sha256": F.lower(F.hex("_digest"))}))

    return beside(docs, ["doc_id", "text"], ["keep_id", "group_size", "kept", "text_sha256"], work)


def new_documents(docs: DataFrame, index: DigestIndex, batches: int = 1) -> DataFrame:
    """One row of `docs` for every text that the index did not know, which it then knows."""
    marked = mark_copies(docs, index, batches)
    return marked.filter("kept").dropDuplicates(["doc_id", "text_sha256"]).select(*docs.columns)
