"""Best-fit packing of token sequences, merged up a tree."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopstar.llm.tables import Spool

# Fixed: how the vocabulary's pre-tokenizer cuts a text.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Packing:
    """capacity: tokens of a sequence. end_id closes every document.

    leaf_rows: pieces that are packed at once within a partition. slack: bins
    with no more room than this are full. open_bins: how many of its emptiest
    bins over half full a node hands on. fan_in: nodes that meet in one task.
    """

    capacity: int = 2048
    end_id: int = 0
    leaf_rows: int = 50_000
    slack: int = 16
    open_bins: int = 64
    fan_in: int = 16


@lru_cache(maxsize=2)
def encoder(path: str):
    """text -> ids as the tokenizer file gives them without special tokens added.

    The file's vocabulary runs in a faster byte-pair encoder for texts in Latin
    script. Other texts, and any text that this encoder refuses, go through the
    file's own tokenizer; both give the same ids.
    """
    import tiktoken
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    # The byte alphabet: printable Latin-1 stands for itself, the rest follows from 256.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(byte_of[c] for c in token): i
             for token, i in spec["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("corpus", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        try:
            text.encode("latin-1")
            return fast.encode_to_numpy(text, allowed_special="all")
        except (UnicodeEncodeError, ValueError, RuntimeError):
            return np.array(own.encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: full ones, but for a first that may be shorter."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    starts = [0] * bool(first) + list(range(first, length, capacity))
    return list(zip(starts, np.diff([*starts, length]).tolist(), strict=True))


def token_pieces(docs: DataFrame, path: str, packing: Packing = Packing()) -> DataFrame:
    """(doc_id, piece, start, length, ids): the pieces of every document.

    ids are little-endian unsigned 32-bit numbers. A null text is empty, which
    leaves the closing id alone. Every row is a document, repeated ones too.
    """
    capacity, end = packing.capacity, packing.end_id
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids", pa.binary())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            out, held = [], 0
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end)).astype("<u4")
                for n, (start, length) in enumerate(cut(len(ids), capacity)):
                    out.append((doc, n, start, length, ids[start:start + length].tobytes()))
                held += ids.nbytes
                if held > 8_000_000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(
        pieces, "doc_id long, piece int, start long, length long, ids binary")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and the fill of every bin; largest items first.

    An item goes to the bin with the least room that still holds it. Bit r of
    `rooms` says that a bin with room r exists.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fill = 0, []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(fill, np.int64)


def still_open(fill: np.ndarray, packing: Packing) -> np.ndarray:
    """Which bins go on: those up to half full and the emptiest others that have room.

    Two bins over half full never fit together, so the others of them could only
    wait for one of the few small bins.
    """
    small = fill * 2 <= packing.capacity
    rest = np.flatnonzero(~small & (fill < packing.capacity - packing.slack))
    chosen = small.copy()
    chosen[rest[np.argsort(fill[rest], kind="stable")[:packing.open_bins]]] = True
    return chosen


def pack_leaves(pieces: DataFrame, packing: Packing) -> DataFrame:
    """Adds unit (a bin of one leaf), at (the offset there) and open, partition by partition."""
    names = pieces.columns

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 33
        held: list[pa.RecordBatch] = []
        n = 0

        def flush() -> pa.RecordBatch:
            nonlocal first, held, n
            table = pa.Table.from_batches(held).combine_chunks()
            bins, at, fill = best_fit(table["length"].to_numpy(), packing.capacity)
            is_open = still_open(fill, packing)[bins]
            for name, values in (("unit", first + bins), ("at", at), ("open", is_open)):
                table = table.append_column(name, pa.array(values))
            first, held, n = first + len(fill), [], 0
            return table.to_batches()[0]

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, packing.leaf_rows - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == packing.leaf_rows:
                    yield flush()
        if n:
            yield flush()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return pieces.select(*names).mapInArrow(packed, f"{schema}, unit long, at long, open boolean")


MEMBER = "node long, unit long, size long, root long, base long, open boolean"


def _merger(packing: Packing):
    """Packs the bins of one node again, whole bins being the items."""

    def merged(members: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values("unit", kind="stable")
        roots, index = np.unique(members["root"].to_numpy(), return_inverse=True)
        sizes = np.bincount(index, members["size"].to_numpy()).astype(np.int64)
        bins, offsets, fill = best_fit(sizes, packing.capacity)
        head = np.full(len(fill), np.iinfo(np.int64).max)
        np.minimum.at(head, bins, roots)
        return members.assign(
            root=head[bins][index], base=members["base"].to_numpy() + offsets[index],
            open=still_open(fill, packing)[bins][index])

    return merged


def pack(pieces: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """`pieces` (with length, at most capacity) with sequence_id and offset.

    Every partition packs its own pieces; nearly full bins are done. The other
    bins become items: fan_in nodes at a time they are packed again, up to the
    root. A node hands on its bins up to half full, of which best fit leaves at
    most one, and open_bins others, so no task grows with the table. An empty
    table gives an empty one.
    """
    spool = Spool(pieces.sparkSession, "packing")
    leaves = spool.write(pack_leaves(pieces.drop("unit", "at", "open"), packing), "leaves")
    bins = leaves.filter("open").groupBy("unit").agg(F.sum("length").alias("size")).select(
        F.shiftright("unit", 33).alias("node"), "unit", "size", F.col("unit").alias("root"),
        F.lit(0).cast("bigint").alias("base"), F.lit(True).alias("open"))
    nodes = leaves.agg(F.max(F.shiftright("unit", 33))).first()[0] or 0
    done, step = [], 0
    while True:
        nodes //= packing.fan_in
        bins = spool.write(
            bins.withColumn("node", F.floor(F.col("node") / packing.fan_in))
            .groupBy("node").applyInPandas(_merger(packing), MEMBER), f"merge-{step}")
        if nodes == 0:
            done.append(bins)
            break
        done.append(bins.filter("not open"))
        bins, step = bins.filter("open"), step + 1
    moved = done[0]
    for more in done[1:]:
        moved = moved.unionByName(more)
    return (
        leaves.join(moved.select("unit", "root", "base"), "unit", "left")
        .withColumn("sequence_id", F.coalesce("root", "unit"))
        .withColumn("offset", F.col("at") + F.coalesce("base", F.lit(0)))
        .drop("unit", "at", "open", "root", "base"))


def pack_documents(docs: DataFrame, path: str, packing: Packing = Packing()) -> DataFrame:
    """Places of the pieces of all documents, with the CRC-32 of their ids."""
    pieces = token_pieces(docs, path, packing).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    spool = Spool(docs.sparkSession, "pieces")
    return pack(spool.write(pieces, "pieces"), packing)
