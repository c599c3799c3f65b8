"""Near-duplicate documents by a grouped prefix join over word shingles."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shopstar.llm.components import components
from shopstar.llm.tables import Spool
from shopstar.llm.text import joined, word_hashes


@dataclass(frozen=True)
class JaccardJoin:
    """Texts link if 100 * intersection >= percent * union of their shingle sets.

    sketch_bits: log2 of the counters by which shingles are ordered, rare ones
    first. The order needs to be the same for all, not exact, so the table of
    counters has a fixed size. signature_words: 64-bit words of the signature.
    """

    words: int = 3
    percent: int = 90
    sketch_bits: int = 22
    signature_words: int = 8


def shingles(text: str | None, words: int) -> np.ndarray:
    """The sorted hashes of the distinct word shingles; of all words if there are fewer."""
    h = word_hashes(text)
    if len(h) == 0:
        return h
    if len(h) < words:
        return joined(*(h[i:i + 1] for i in range(len(h))))
    n = len(h) - words + 1
    return np.unique(joined(*(h[i:i + n] for i in range(words))))


BLOCK = 4096


def _narrow(counts: np.ndarray) -> bytes:
    """Counters in the fewest bytes that hold them."""
    most = int(counts.max(initial=0))
    return counts.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<i8").tobytes()


def _counters(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, {1: "<u1", 2: "<u2", 8: "<i8"}[len(raw) // BLOCK])


def shingle_rarity(docs: DataFrame, rule: JaccardJoin) -> np.ndarray:
    """How often shingles fall into each of 2**sketch_bits counters, over all documents:
    64 times the binary logarithm.

    Tasks count on their own; blocks of counters are added up in two steps, so
    that no group grows with the number of tasks.
    """
    size, words = 1 << rule.sketch_bits, rule.words

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, held, n = np.zeros(size, np.int64), [], 0
        for batch in batches:
            for text in batch["text"]:
                held.append((shingles(text.as_py(), words) >> np.uint64(64 - rule.sketch_bits)).astype(np.int64))
                n += len(held[-1])
                if n > size:
                    total += np.bincount(np.concatenate(held), minlength=size)
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=size)
        part = TaskContext.get().partitionId() % 16
        blocks = total.reshape(-1, BLOCK)
        yield pa.RecordBatch.from_pydict({
            "block": np.arange(len(blocks), dtype=np.int32), "part": np.full(len(blocks), part, np.int32),
            "counts": pa.array([_narrow(b) for b in blocks], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, np.int64)
        for c in table["counts"]:
            total += _counters(c.as_py())
        return pa.table({"block": table["block"][:1], "part": table["part"][:1],
                         "counts": pa.array([_narrow(total)], pa.binary())})

    schema = "block int, part int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema).groupBy("block", "part").applyInArrow(add, schema)
    blocks = parts.groupBy("block").applyInArrow(add, schema).collect()
    rarity = np.zeros((size // BLOCK, BLOCK), np.uint16)
    for row in blocks:
        rarity[row["block"]] = np.floor(np.log2(_counters(row["counts"]) + 1.0) * 64)
    return rarity.reshape(-1)


def describe(docs: DataFrame, rule: JaccardJoin, rarity: np.ndarray) -> DataFrame:
    """Per document its set's size n, identity (f1, f2), prefix, prefix identity, signature and commonness.

    The prefix are the n - ceil(n * percent / 100) + 1 rarest shingles; two sets
    that link share one of them. The signature has a bit per shingle hash,
    combined by exclusive or: as many bits as differ, so many shingles differ at
    least. It is 64 * signature_words bits of a wider one, folded; the wider one
    has at least half as many bits as the set has shingles. Commonness is how
    often its shingles occur on average (by the sketch): the original of many
    edited copies has the most of them.
    """
    words, percent, sig_words = rule.words, rule.percent, rule.signature_words
    shift = np.uint64(64 - rule.sketch_bits)
    ranks = docs.sparkSession.sparkContext.broadcast(rarity)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = ranks.value
        for batch in batches:
            sizes, first, second, prefixes, p1, p2, sigs, wides, common = ([] for _ in range(9))
            for text in batch["text"]:
                s = shingles(text.as_py(), words)
                n = len(s)
                often = rank[(s >> shift).astype(np.int64)]
                order = np.lexsort((s, often))
                common.append(int(often.mean(dtype=np.float64) * 16) if n else 0)
                prefix = s[order[:n - (percent * n + 99) // 100 + 1 if n else 0]]
                f = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                p = hashlib.blake2b(prefix.tobytes(), digest_size=16).digest()
                size = 64 * sig_words
                while size < n / 2:
                    size *= 2
                wide = (np.bincount((s % np.uint64(size)).astype(np.int64), minlength=size) & 1).astype(np.uint8)
                bits = np.bitwise_xor.reduce(wide.reshape(-1, 64 * sig_words), axis=0)
                sizes.append(n)
                prefixes.append(prefix.view(np.int64))
                sigs.append(np.packbits(bits).view(np.int64))
                wides.append(np.packbits(wide).tobytes())
                for out, digest, at in ((first, f, 0), (second, f, 8), (p1, p, 0), (p2, p, 8)):
                    out.append(int.from_bytes(digest[at:at + 8], "little", signed=True))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "n": pa.array(sizes, pa.int64()),
                "f1": pa.array(first, pa.int64()), "f2": pa.array(second, pa.int64()),
                "p1": pa.array(p1, pa.int64()), "p2": pa.array(p2, pa.int64()),
                "prefix": pa.array(prefixes, pa.list_(pa.int64())), "sig": pa.array(sigs, pa.list_(pa.int64())),
                "common": pa.array(common, pa.int64()), "wide": pa.array(wides, pa.binary())})

    return docs.select("doc_id", "text").mapInArrow(
        rows, "doc_id long, n long, f1 long, f2 long, p1 long, p2 long, "
        "prefix array<long>, sig array<long>, common long, wide binary")


def can_link(n1: Column, n2: Column, rule: JaccardJoin) -> Column:
    """The smaller of two linked sets has at least percent of the larger one's size."""
    return 100 * F.least(n1, n2) >= rule.percent * F.greatest(n1, n2)


def signed(reps: DataFrame, side: str, rule: JaccardJoin) -> DataFrame:
    """Id, size and the words of the signature, named for one side of a pair."""
    return reps.select(
        F.col("id").alias(side), F.col("n").alias(f"n_{side}"),
        *[F.get("sig", F.lit(i)).alias(f"s{i}_{side}") for i in range(rule.signature_words)])


def may_link(rule: JaccardJoin) -> Column:
    """What size and signature allow: of linked sets A and B, at most
    (100 - percent) / (100 + percent) * (|A| + |B|) shingles are in one of them only."""
    apart = reduce(lambda x, y: x + y, [
        F.bit_count(F.col(f"s{i}_a").bitwiseXOR(F.col(f"s{i}_b"))) for i in range(rule.signature_words)])
    return can_link(F.col("n_a"), F.col("n_b"), rule) & (
        apart * (100 + rule.percent) <= (100 - rule.percent) * (F.col("n_a") + F.col("n_b")))


def still_close(pairs: DataFrame, reps: DataFrame, rule: JaccardJoin) -> DataFrame:
    """The pairs that the wide signatures allow too, the wider one folded to the other's size."""
    percent = rule.percent

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for n, x, y in zip(batch["n"].to_pylist(), batch["x"], batch["y"], strict=True):
                a, b = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                size = min(len(a), len(b))
                a, b = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (a, b))
                apart = int(np.bitwise_count(a ^ b).sum())
                near.append(apart * (100 + percent) <= (100 - percent) * n)
            yield pa.RecordBatch.from_pydict({"a": batch["a"], "b": batch["b"]}).filter(pa.array(near, pa.bool_()))

    side = lambda k, name: reps.select(
        F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("wide").alias(name))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select(
        "a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), "x", "y").mapInArrow(check, "a long, b long")


def verified(close: DataFrame, docs: DataFrame, rule: JaccardJoin, spool: Spool, name: str) -> DataFrame:
    """The pairs (a, b) whose sets do link, checked on the whole sets.

    The sets are built again from the texts of the documents concerned. The list
    of those is stored first: Spark sees its size, and sends it to the texts if
    it is small or else the texts to it.
    """
    wanted = spool.write(
        close.select(F.col("a").alias("id")).union(close.select("b")).distinct(), f"{name}-wanted")
    words, percent = rule.words, rule.percent

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "id": batch["id"],
                "members": pa.array([shingles(t.as_py(), words).tobytes() for t in batch["text"]], pa.binary())})

    built = spool.write(
        docs.select(F.col("doc_id").alias("id"), "text").join(wanted, "id")
        .mapInArrow(sets, "id long, members binary"), f"{name}-sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                a, b = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_pydict({"a": batch["a"], "b": batch["b"]}).filter(pa.array(linked, pa.bool_()))

    whole_sets = (
        close.join(built.select(F.col("id").alias("a"), F.col("members").alias("x")), "a")
        .join(built.select(F.col("id").alias("b"), F.col("members").alias("y")), "b"))
    links = spool.write(
        whole_sets.select("a", "b", "x", "y").mapInArrow(check, "a long, b long").distinct(),
        f"{name}-links")
    spool.drop(f"{name}-sets", f"{name}-wanted")
    return links


def near_duplicates(docs: DataFrame, rule: JaccardJoin = JaccardJoin()) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per document.

    Documents with equal sets are one class, classes with equal prefixes and
    size one group. Groups meet where their prefixes do; a shingle of one class
    alone is left out first. A pair within a component adds nothing to it, so
    pairs are checked in two rounds: first every class with the head of its
    group, and every group with the head of those that have the same shingle and
    about the same size, heads being the most common ones; then, for each
    shingle whose documents are not all connected by then, every pair across the
    components that were found. That finds the components of all links without
    spelling out all pairs of a large group.

    Texts without words, and null texts, have the empty set and link with
    nothing. Rows without a doc_id get the component of the documents that have
    their set, null if there are none. Rows of one doc_id are one document: what
    links with any of their texts links with it. All rows are returned.
    """
    spool = Spool(docs.sparkSession, "jaccard")
    described = spool.write(describe(docs, rule, shingle_rarity(docs, rule)), "described")
    some = described.filter("n > 0")
    classes = spool.write(
        some.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("id")).filter("id is not null"), "classes")
    reps = spool.write(
        some.join(classes.select("id", F.col("f1").alias("c1"), F.col("f2").alias("c2")),
                  (F.col("doc_id") == F.col("id")) & (F.col("f1") == F.col("c1")) & (F.col("f2") == F.col("c2")))
        .select("id", "n", "p1", "p2", "prefix", "sig", "common", "wide"), "reps")
    groups = reps.groupBy("n", "p1", "p2").agg(
        F.max(F.struct("common", "id")).alias("head"), F.count("*").alias("members"))
    band = F.floor(F.log(F.col("n")) / F.lit(math.log(100 / rule.percent))).cast("int")
    grouped = spool.write(
        reps.select("id", "n", "p1", "p2").join(groups, ["n", "p1", "p2"])
        .select("id", "n", F.col("head.id").alias("gid"), "head.common", "members", band.alias("band")), "grouped")

    # One posting per group and shingle, of shingles that more than one class has.
    heads = grouped.filter("id = gid").join(reps.select("id", "prefix"), "id").select(
        F.explode("prefix").alias("token"), "gid", "band", "common", "members")
    met = heads.groupBy("token").agg(F.sum("members").alias("_n")).filter("_n > 1").select("token")
    shared = spool.write(heads.join(met, "token"), "shared")

    # Round 1: classes with the head of their group, heads with the head of a shingle.
    firsts = shared.groupBy("token", "band").agg(
        F.max(F.struct("common", "gid")).alias("_first"), F.count("*").alias("_n")
    ).filter("_n > 1").select("token", "band", F.col("_first.gid").alias("a"))
    across = shared.select("token", "band", F.col("gid").alias("b")).join(firsts, ["token", "band"]).select("a", "b")
    within = grouped.select(F.col("gid").alias("a"), F.col("id").alias("b"))
    first_pairs = across.union(within).filter("a != b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first_close = spool.write(still_close(
        first_pairs.join(signed(reps, "a", rule), "a").join(signed(reps, "b", rule), "b")
        .filter(may_link(rule)).select("a", "b").distinct(), reps, rule).distinct(), "close-1")
    links = verified(first_close, docs, rule, spool, "round-1")
    labels = components(links, spool, "labels-1")
    labelled = grouped.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "n", "gid", "band", F.coalesce("label", "id").alias("label"))

    # Round 2: what is still apart although it shares a shingle, across components.
    held = spool.write(shared.select("token", "gid").join(labelled, "gid").drop("gid"), "held")
    split = held.groupBy("token").agg(
        F.min("label").alias("_low"), F.max("label").alias("_high")).filter("_low != _high").select("token")
    postings = spool.write(held.join(split, "token").distinct(), "postings")
    spool.drop("held", "shared")
    major = (
        postings.groupBy("token", "label").agg(F.count("*").alias("_n"))
        .groupBy("token").agg(F.max(F.struct("_n", "label")).alias("_top"))
        .select("token", F.col("_top.label").alias("major")))
    of_a, of_b = (signed(reps, side, rule) for side in "ab")
    minor = postings.join(major, "token").filter("label != major").select(
        "token", F.col("id").alias("a"), F.col("label").alias("label_a"), "major",
        F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band")).join(of_a, "a")
    others = postings.select(
        "token", "band", F.col("id").alias("b"), F.col("label").alias("label_b")).join(of_b, "b")
    # A pair of two minor ones is met from both sides: once is enough.
    second_close = spool.write(still_close(
        minor.join(others, ["token", "band"])
        .filter((F.col("label_a") != F.col("label_b")) & may_link(rule)
                & ((F.col("label_b") == F.col("major")) | (F.col("a") < F.col("b"))))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        .join(first_close, ["a", "b"], "left_anti"), reps, rule).distinct(), "close-2")
    more = verified(second_close, docs, rule, spool, "round-2")
    tree = labels.filter("node != label").select(F.col("label").alias("a"), F.col("node").alias("b"))
    final = components(tree.union(more), spool, "labels-2")
    of_class = classes.join(final.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("f1").alias("c1"), F.col("f2").alias("c2"), F.coalesce("label", "id").alias("_label"))
    return described.select("doc_id", "n", "f1", "f2").join(
        of_class, (F.col("f1") == F.col("c1")) & (F.col("f2") == F.col("c2")) & (F.col("n") > 0), "left"
    ).select("doc_id", F.col("n").alias("n_shingles"),
             F.coalesce("_label", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame, rule: JaccardJoin = JaccardJoin()) -> DataFrame:
    """The documents whose id is that of their component, with their own columns.

    Rows without a doc_id, and repeated rows of a kept document, stay.
    """
    gone = near_duplicates(docs, rule).filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
