"""Near-duplicate vectors by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shopstar.functions.ranking import number_rows
from shopstar.llm.components import components
from shopstar.llm.tables import Spool


@dataclass(frozen=True)
class GridJoin:
    """cosine: least similarity of a link. leading: principal dimensions of the
    grid and of the boxes. block_rows: vectors of a block at most. fan_out:
    intervals that an interval of the sequence is cut into.
    """

    cosine: float = 0.93
    leading: int = 12
    block_rows: int = 512
    fan_out: int = 8

    @property
    def reach(self) -> float:
        """Distance of unit vectors with that cosine."""
        return float(np.sqrt(max(0.0, 2 - 2 * self.cosine)))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten(), np.float64).reshape(len(column), -1)


def _unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def usable() -> Column:
    """Whether a vector can link: it has an id, a label, and a finite embedding that is not zero."""
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & ~bad
        & F.exists(e, lambda x: x != 0), F.lit(False))


def principal_axes(classes: DataFrame, dims: int) -> np.ndarray:
    """Eigenvectors of the covariance of the unit vectors, the widest first.

    Sums of products are added up by cell of the matrix, so that the driver gets
    dims * (dims + 1) numbers however many vectors there are.
    """
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims + 1))
        n = 0
        for batch in batches:
            if batch.num_rows:
                x = _unit(_matrix(batch["embedding"]))
                total += np.concatenate([x.T @ x, x.sum(0)[:, None]], axis=1)
                n += len(x)
        cells = total.reshape(-1)
        yield pa.RecordBatch.from_pydict({
            "cell": np.arange(len(cells) + 1, dtype=np.int32), "value": np.append(cells, float(n))})

    rows = (
        classes.filter(F.size("embedding") == dims).select("embedding")
        .mapInArrow(sums, "cell int, value double").groupBy("cell").agg(F.sum("value")).collect())
    cells = np.zeros(dims * (dims + 1) + 1)
    for cell, value in rows:
        cells[cell] = value
    n = max(cells[-1], 1.0)
    table = cells[:-1].reshape(dims, dims + 1) / n
    mean = table[:, -1]
    widths, axes = np.linalg.eigh(table[:, :-1] - np.outer(mean, mean))
    return axes[:, np.argsort(-widths, kind="stable")]


def blocks(classes: DataFrame, axes: np.ndarray, rule: GridJoin, spool: Spool) -> DataFrame:
    """Blocks of the grid order, numbered along the sequence (at), with their boxes.

    The order is by label and then by the grid cells of the leading principal
    dimensions, cells being as wide as the reach; range partitioning runs over
    all of it, so a large label spreads over many tasks. Boxes are those of the
    rotated vectors, and without bounds for vectors of other lengths.
    """
    k, reach = rule.leading, rule.reach
    dims = len(axes)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.asarray(pa.compute.list_value_length(batch["embedding"]))
            grid = np.zeros((len(sizes), k), np.int32)
            same = np.flatnonzero(sizes == dims)
            if len(same):
                turned = _unit(_matrix(batch["embedding"].take(pa.array(same)))) @ axes[:, :k]
                grid[same, :turned.shape[1]] = np.floor(turned / reach)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes.astype(np.int32)), pa.array(list(grid), pa.list_(pa.int32()))],
                names=[*batch.schema.names, "dims", "cell"])

    kind = dict(classes.dtypes)["label"]
    ordered = (
        classes.select("label", "id", "copies", "embedding")
        .mapInArrow(cells, f"label {kind}, id long, copies long, embedding array<float>, dims int, cell array<int>"))
    keys = ["label", "dims", *[F.col("cell")[i] for i in range(k)], "id"]
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = pa.schema([
        ("label", pa.int64()), ("dims", pa.int32()), ("ids", pa.binary()), ("copies", pa.binary()),
        ("matrix", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def block():
            raw = np.array([r[2] for r in held], np.float32)
            x = _unit(raw.astype(np.float64))
            turned = (x @ axes[:, :k]) if raw.shape[1] == dims else np.array([[-np.inf] * k, [np.inf] * k])
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((
                key[0], key[1], np.array([r[0] for r in held], "<i8").tobytes(),
                np.array([r[1] for r in held], "<i8").tobytes(), raw.astype("<f4").tobytes(),
                turned.min(0).tolist(), turned.max(0).tolist()), schema.types, strict=True)], schema=schema)

        for batch in batches:
            for label, id_, copies, vector, size in zip(
                    batch["label"].to_pylist(), batch["id"].to_pylist(), batch["copies"].to_pylist(),
                    batch["embedding"], batch["dims"].to_pylist(), strict=True):
                if held and (key != (label, size) or len(held) == rule.block_rows):
                    yield block()
                    held = []
                key = (label, size)
                held.append((id_, copies, np.asarray(vector.values, np.float32)))
        if held:
            yield block()

    cut_blocks = ordered.select(F.col("label").cast("bigint"), "id", "copies", "embedding", "dims").mapInArrow(
        cut, "label long, dims int, ids binary, copies binary, matrix binary, low array<double>, high array<double>")
    stored = spool.write(cut_blocks.withColumn("_pos", F.monotonically_increasing_id()), "cut")
    return spool.write(number_rows(stored, "at").drop("_total"), "blocks")


def near_intervals(found: DataFrame, rule: GridJoin, spool: Spool) -> DataFrame:
    """(a, b): pairs of blocks, a <= b, that may hold a link.

    From the whole sequence down, every pair of intervals is replaced by the
    pairs of their parts; pairs of other labels, and pairs whose boxes are
    further apart than the reach, are skipped with all that they hold.
    """
    leaves = found.select(
        (F.col("at") - 1).alias("node"), F.struct("label", "dims").alias("first"),
        F.struct("label", "dims").alias("last"), "low", "high")
    n = found.agg(F.max("at")).first()[0] or 0
    levels, width = [leaves], n
    k = rule.leading
    while width > 1:
        below = levels[-1]
        levels.append(spool.write(
            below.groupBy(F.floor(F.col("node") / rule.fan_out).alias("node")).agg(
                F.min("first").alias("first"), F.max("last").alias("last"),
                F.array(*[F.min(F.get("low", F.lit(i))) for i in range(k)]).alias("low"),
                F.array(*[F.max(F.get("high", F.lit(i))) for i in range(k)]).alias("high")),
            f"level-{len(levels)}"))
        width = -(-width // rule.fan_out)
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    gap = F.aggregate(
        F.zip_with(
            F.zip_with("low_b", "high_a", lambda x, y: x - y),
            F.zip_with("low_a", "high_b", lambda x, y: x - y),
            lambda x, y: F.pow(F.coalesce(F.greatest(x, y, F.lit(0.0)), F.lit(0.0)), 2)),
        F.lit(0.0), lambda t, x: t + x)

    def parts(nodes: DataFrame, s: str) -> DataFrame:
        return nodes.select(
            F.floor(F.col("node") / rule.fan_out).alias(s),
            *(F.col(c).alias(f"{c}_{s}") for c in ("node", "first", "last", "low", "high")))

    for depth, nodes in enumerate(reversed(levels[:-1])):
        pairs = spool.write(
            pairs.join(parts(nodes, "a"), "a").join(parts(nodes, "b"), "b")
            .filter((F.col("node_a") <= F.col("node_b"))
                    & (F.col("first_a") <= F.col("last_b")) & (F.col("first_b") <= F.col("last_a")))
            .filter(gap <= rule.reach ** 2 + 1e-9)
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")), f"pairs-{depth}")
    return pairs.select((F.col("a") + 1).alias("a"), (F.col("b") + 1).alias("b"))


def linked(pairs: DataFrame, found: DataFrame, rule: GridJoin) -> DataFrame:
    """Per block pair and vector with links: id, links (copies counted) and root.

    root is the smallest id that the pair's links connect the vector with; so the
    roots connect what the links do, with one row per vector instead of per link.
    """
    least, margin = rule.cosine, 1e-9

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch[c][i].as_py() for c in batch.schema.names}
                side = {}
                for s in "ab":
                    ids, copies = (np.frombuffer(r[f"{c}_{s}"], "<i8") for c in ("ids", "copies"))
                    raw = np.frombuffer(r[f"matrix_{s}"], "<f4").reshape(len(ids), -1).astype(np.float64)
                    side[s] = ids, copies, raw
                (ids_a, n_a, raw_a), (ids_b, n_b, raw_b) = side["a"], side["b"]
                cosine = _unit(raw_a) @ _unit(raw_b).T
                hit = cosine >= least
                for x, y in np.argwhere(np.abs(cosine - least) < margin):
                    p, q = raw_a[x], raw_b[y]
                    hit[x, y] = float(p @ q) / (float(np.sqrt(p @ p)) * float(np.sqrt(q @ q))) >= least
                if r["a"] == r["b"]:
                    np.fill_diagonal(hit, False)
                if not hit.any():
                    continue
                low_a, low_b = ids_a.copy(), ids_b.copy()
                none = np.iinfo(np.int64).max
                while True:
                    new_a = np.minimum(low_a, np.where(hit, low_b[None, :], none).min(1))
                    new_b = np.minimum(low_b, np.where(hit, new_a[:, None], none).min(0))
                    if r["a"] == r["b"]:
                        new_a = new_b = np.minimum(new_a, new_b)
                    if (new_a == low_a).all() and (new_b == low_b).all():
                        break
                    low_a, low_b = new_a, new_b
                own = [(ids_a, hit @ n_b, low_a)]
                if r["a"] != r["b"]:
                    own.append((ids_b, hit.T @ n_a, low_b))
                for ids, links, low in own:
                    some = links > 0
                    yield pa.RecordBatch.from_pydict({"id": ids[some], "links": links[some], "root": low[some]})

    side = lambda s: found.select(
        F.col("at").alias(s), F.struct("label", "dims").alias(f"key_{s}"),
        *(F.col(c).alias(f"{c}_{s}") for c in ("ids", "copies", "matrix")))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter("key_a = key_b").drop("key_a", "key_b")
    return both.mapInArrow(check, "id long, links long, root long")


def near_vectors(vectors: DataFrame, rule: GridJoin = GridJoin()) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per vector (vec_id, embedding, label).

    Vectors with equal label and embedding are one class, which is joined once
    and counted with all its members. Links need equal labels and dimensions.
    Null, empty and zero vectors, vectors with null or non-finite components, and
    those without a label or id link with nothing and stay, but for rows without
    an id, which are not kept. Repeated rows count as vectors of their own.
    """
    spool = Spool(vectors.sparkSession, "grid-join")
    h1, h2 = F.xxhash64(F.lit("vector"), "embedding"), F.xxhash64(F.lit("second"), "embedding")
    keyed = spool.write(
        vectors.filter(usable()).select("vec_id", "label", h1.alias("h1"), h2.alias("h2"),
                               F.col("embedding").cast("array<float>").alias("embedding")), "keyed")
    classes = spool.write(
        keyed.groupBy("label", "h1", "h2").agg(
            F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")),
        "classes")
    common = classes.groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    axes = principal_axes(classes, common["dims"] if common else 1)
    found = blocks(classes, axes, rule, spool)
    hits = spool.write(linked(near_intervals(found, rule, spool), found, rule), "hits")
    links = hits.groupBy("id").agg(F.sum("links").alias("_links"))
    labels = components(
        hits.filter("id != root").select(F.col("root").alias("a"), F.col("id").alias("b")).distinct(),
        spool, "labels")
    of_class = (
        classes.select("label", "h1", "h2", "id", "copies")
        .join(links, "id", "left").join(labels.select(F.col("node").alias("id"), F.col("label").alias("_low")), "id", "left")
        .select("label", "h1", "h2", (F.col("copies") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"),
                F.coalesce("_low", "id").alias("component_id")))
    joined = keyed.select("vec_id", "label", "h1", "h2").join(of_class, ["label", "h1", "h2"])
    alone = vectors.filter(~usable()).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.select("vec_id", "n_links", "component_id").unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
