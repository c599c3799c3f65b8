"""Source divergence audit: how far the words of a language's sources are apart, by count-level bitmaps."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.ranking import number_rows, range_sorted
from shopstar.functions.skew import lookup
from shopstar.llm.tables import Spool

# Fixed by the query contract: the scale of the shares and what a term is made of
# (all bytes but these; those of other alphabets are above 127 in UTF-8).
SCALE = 10**9
BETWEEN = bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

WORD_BITS = 64


@dataclass(frozen=True)
class Audit:
    """min_docs: documents of a language that a kept term is in. top_terms: ranks of part `term`.

    strip_words: 64-bit words of the bitsets that one task compares at a time.
    block: sources that meet in one task. held_terms: counts that a task keeps
    before it hands them on. slice_bytes: long texts are counted in such slices.
    None of the last four changes a result.
    """

    min_docs: int = 10
    top_terms: int = 10
    strip_words: int = 64
    block: int = 64
    held_terms: int = 400_000
    slice_bytes: int = 1 << 20


def slices(text: bytes, size: int) -> Iterator[list[bytes]]:
    """Terms of a text, A-Z lower-cased, some bytes at a time."""
    spaces = bytes.maketrans(BETWEEN, b" " * len(BETWEEN))
    gap = re.compile(b"[" + re.escape(BETWEEN) + b"]")
    start = 0
    while start < len(text):
        end = start + size
        if end < len(text):  # on to the end of the term that is cut
            after = gap.search(text, end)
            end = after.start() if after else len(text)
        yield text[start:end].lower().translate(spaces).split()
        start = end


def count_terms(rule: Audit):
    """Counts per language, source and term, summed up within the task as far as they fit."""

    def flushed(held: dict) -> pa.RecordBatch:
        rows = [(lang, source, term, docs[term], n)
                for (lang, source), (docs, times) in held.items() for term, n in times.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["lang", "source", "term", "n_docs", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                docs, times = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(times)
                own: set = set()
                for terms in slices(text, rule.slice_bytes):
                    times.update(terms)
                    own.update(terms)
                docs.update(own)
                size += len(times)
                if size > rule.held_terms:
                    yield flushed(held)
                    held, size = {}, 0
        yield flushed(held)

    return work


def quotient(value: Column, by: Column) -> Column:
    """Whole part of a division of whole numbers, none of them negative."""
    return F.call_function("div", value, by)


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact also where a long would not hold the product."""
    wide = lambda c: c.cast("decimal(25,0)")
    upper = (wide(n) + 2) * F.lit(SCALE).cast("decimal(11,0)")
    lower = wide(total) + wide(terms) * 2
    return F.lit(1).cast("bigint") + quotient(upper, lower)


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); both shares are positive and at most 1 + SCALE."""
    return quotient((p - q) * (p - q), p + q)


def compare_strip(rule: Audit):
    """For one strip of a language's terms, the values of all pairs of sources of two blocks."""

    def shares(n: np.ndarray, total: int, terms: int) -> np.ndarray:
        return np.array([1 + SCALE * (int(x) + 2) // (total + 2 * terms) for x in n], np.int64)

    def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // (p + q)

    def levels(table: pa.Table) -> tuple[list, int]:
        """Per source its name, block, share of count 0 and (word, bits, share) per count; and the kept terms."""
        heads = table.filter(pa.compute.is_null(table["n"]))
        rows = table.filter(pa.compute.is_valid(table["n"]))
        names = np.array(rows["source"].to_pylist(), object)
        word, n, bits = (rows[c].to_numpy() for c in ("word", "n", "bits"))
        bits = bits.astype(np.int64).view(np.uint64)
        order = np.lexsort((n, word))
        places: dict = {}
        for i in order:
            places.setdefault(names[i], []).append(i)
        found = []
        terms = heads["terms"][0].as_py()
        for source, block, total in sorted(zip(*(heads[c].to_pylist() for c in ("source", "block", "total")), strict=True)):
            at = np.array(places.get(source, []), np.int64)
            found.append((source, block, shares([0], total, terms) if terms else None,
                          word[at], bits[at], shares(n[at], total, terms)))
        return found, terms

    def value(a, b, n_terms: int) -> int:
        _, _, p0, word_a, bits_a, p = a
        _, _, q0, word_b, bits_b, q = b
        first, last = np.searchsorted(word_b, word_a, "left"), np.searchsorted(word_b, word_a, "right")
        met = last - first
        i = np.repeat(np.arange(len(word_a)), met)
        j = np.arange(len(i)) + np.repeat(first - np.cumsum(met) + met, met)
        both = np.bitwise_count(bits_a[i] & bits_b[j]).astype(np.int64)
        some = both > 0
        i, j, both = i[some], j[some], both[some]
        # Terms that one side lacks, or both, are the complement of those that meet.
        only_a = np.bitwise_count(bits_a).astype(np.int64)
        only_b = np.bitwise_count(bits_b).astype(np.int64)
        neither = n_terms - int(only_a.sum()) - int(only_b.sum()) + int(both.sum())
        np.subtract.at(only_a, i, both)
        np.subtract.at(only_b, j, both)
        return int((both * apart(p[i], q[j])).sum() + (only_a * apart(p, q0)).sum()
                   + (only_b * apart(p0, q)).sum() + neither * apart(p0, q0)[0])

    def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lang, strip, low, high = (k.as_py() for k in key)
        found, terms = levels(table)
        n_terms = max(0, min(rule.strip_words * WORD_BITS, terms - strip * rule.strip_words * WORD_BITS))
        out = []
        for at, a in enumerate(found):
            for b in found[at + 1:]:
                if {a[1], b[1]} == {low, high}:
                    out.append((lang, a[0], b[0], value(a, b, n_terms) if terms else 0))
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                        names=["lang", "a", "b", "value"])

    return work


class Divergence:
    """The stored tables of one audit: groups, kept terms with their counts, and bitsets."""

    def __init__(self, docs: DataFrame, rule: Audit = Audit()):
        self.rule = rule
        self.cfg = RetailConfig()
        self.spool = Spool(docs.sparkSession, "divergence")
        own = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
        counts = self.spool.write(
            own.select("lang", "source", F.col("text").cast("binary").alias("text"))
            .mapInArrow(count_terms(rule), "lang string, source string, term binary, n_docs long, n long")
            .groupBy("lang", "source", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n")),
            "counts")
        terms = (
            counts.groupBy("lang", "term")
            .agg(F.sum("n_docs").alias("_docs"), F.sum("n").alias("lang_n"))
            .filter(F.col("_docs") >= rule.min_docs).drop("_docs"))
        # Terms of a like frequency get neighbouring numbers, so that few counts share a word.
        ranked = self.spool.write(
            range_sorted(terms, F.col("lang"), F.desc("lang_n"), F.col("term")), "terms")
        numbered = number_rows(ranked, "id", ["lang"]).withColumnRenamed("_total", "terms")
        self.kept = self.spool.write(
            counts.drop("n_docs").join(
                numbered.select("lang", "term", "lang_n", (F.col("id") - 1).alias("id")), ["lang", "term"]),
            "kept")
        langs = self.spool.write(
            ranked.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total")), "langs")
        sums = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        every = own.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        by_name = W.partitionBy("lang")
        self.groups = self.spool.write(
            every.select(
                "lang", "source",
                *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("total", "terms", "lang_total")],
                F.floor((F.row_number().over(by_name.orderBy("source")) - 1) / rule.block).cast("int").alias("block"),
                F.ceil(F.count("*").over(by_name) / rule.block).cast("int").alias("blocks")),
            "groups")

    def bitsets(self) -> DataFrame:
        """(lang, source, n, word, bits): which terms occur n times, 64 term numbers a word; empty words are left out."""
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("id") % WORD_BITS).cast("int"))
        return self.kept.groupBy(
            "lang", "source", "n", quotient(F.col("id"), F.lit(WORD_BITS)).alias("word")).agg(F.bit_or(bit).alias("bits"))

    def pairs(self) -> DataFrame:
        """(lang, source, item, value) of both directions of every pair of sources of a language.

        A task gets one strip of the terms and the sources of two blocks, so its
        input is bounded whatever the number of terms, documents or sources.
        """
        strip = self.rule.strip_words
        sets = lookup(
            self.spool.write(self.bitsets(), "bitsets"), self.groups.select("lang", "source", "block", "blocks"),
            ["lang", "source"], self.cfg, position="word", bound=self.groups
        ).select("lang", "source", "block", "blocks", "n", "word", "bits",
                 F.lit(None).cast("bigint").alias("total"), F.lit(None).cast("bigint").alias("terms"),
                 quotient(F.col("word"), F.lit(strip)).alias("strip"))
        last = quotient(F.greatest(F.col("terms") - 1, F.lit(0).cast("bigint")), F.lit(strip * WORD_BITS))
        none = F.lit(None).cast("bigint")
        heads = self.groups.select(
            "lang", "source", "block", "blocks", none.alias("n"), none.alias("word"), none.alias("bits"),
            "total", "terms", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("strip"))
        dealt = sets.unionByName(heads).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_other"))
        values = dealt.select(
            "lang", "strip", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"),
            "source", "block", "n", "word", "bits", "total", "terms",
        ).groupBy("lang", "strip", "low", "high").applyInArrow(
            compare_strip(self.rule), "lang string, a string, b string, value long")
        return (
            values.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
            .select("lang", "value", F.explode(F.array(
                F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("_way"))
            .select("lang", "_way.source", "_way.item", "value"))

    def terms(self) -> DataFrame:
        """(lang, source, item, value) of the terms that a source uses more than its language does."""
        sized = lookup(
            self.kept, self.groups.select("lang", "source", "total", "terms", "lang_total"),
            ["lang", "source"], self.cfg, position="id", bound=self.groups)
        return (
            sized.withColumns({"_p": share(F.col("n"), F.col("total"), F.col("terms")),
                               "_q": share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))})
            .filter(F.col("_p") > F.col("_q"))
            .select("lang", "source", F.col("term").cast("string").alias("item"),
                    distance(F.col("_p"), F.col("_q")).alias("value")))


def audit_sources(docs: DataFrame, rule: Audit = Audit()) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` compares sources, part `term` names a source's terms.

    Shares, values and sums are whole numbers, and ties are ranked by the bytes
    of the item, so results do not depend on how the work is split. Null text,
    language and source count as empty ones. Repeated rows are documents of
    their own. A group without terms is compared like any other; one that is
    alone in its language has no pairs, and a language without kept terms only
    values of 0. An empty table gives an empty one. Other columns are not read.
    """
    audit = Divergence(docs, rule)
    best = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best))
    parts = [
        ranked(audit.pairs()).withColumn("part", F.lit("pair")),
        ranked(audit.terms()).filter(F.col("rank") <= rule.top_terms).withColumn("part", F.lit("term"))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")
