"""Bounded labelled samples for the classifiers, and their folds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


def fold(folds: int) -> Column:
    """crc32 of the id's text modulo the number of folds; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def held_out(folds: int, out: int) -> Column:
    return F.coalesce(fold(folds) == out, F.lit(False))


def sample(labels: DataFrame, label: str, folds: int, out: int, per_class: int) -> tuple[DataFrame, float]:
    """(doc_id, y) of about per_class labelled rows of each class, and the correction of the bias.

    Rows of the held-out fold, of null ids and of null labels are left out first.
    The lowest hashes of the ids are taken, so the choice does not depend on how
    the table is stored. The correction undoes the different shares by class.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold(folds) != out))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    sizes = {row["y"]: row["n"] for row in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    shares = {y: min(1.0, per_class / n) for y, n in sizes.items()}
    place = F.pmod(F.xxhash64(F.lit(label), "doc_id"), F.lit(1 << 30))
    limit = F.when(F.col("y") == 1, int(shares.get(1, 0) * (1 << 30))).otherwise(int(shares.get(0, 0) * (1 << 30)))
    correction = math.log(shares[0] / shares[1]) if len(sizes) == 2 else 0.0
    return known.filter(place < limit), correction
