"""Every stage of the corpus pipeline on its own input against plain Python, and odd tables through all of them."""

import collections
import re
import zlib

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from shopstar.llm import packing, queries
from shopstar.llm.quality_rules import QualityRules
from shopstar.llm.tables import read

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = regex.compile(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+")
STAGES = dict(corpus_pipeline.STAGES)

# Names that operators use themselves.
CLASHING = ("_own", "score", "copies", "k1", "size", "kept", "_tokens", "piece", "sequence_id", "component_id", "_digest")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, written and read as the driver does."""
    folder, docs, found = tmp_path_factory.mktemp("stages"), read(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        done = spark.read.parquet(str(folder / name))
        found[name] = (docs, done)
        docs = done
    return found


def rows(df):
    return [r.asDict() for r in df.collect()]


def bucket(parts, buckets):
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), h)
    return (h - (1 << 64) if h >> 63 else h) % buckets


def test_quality_rules(stages, spark):
    docs, done = stages["quality_rules"]
    rules = QualityRules()
    good = {r["doc_id"] for r in read(spark, SF, "labels").filter("quality = 1").collect()}
    grams, every, target = {}, collections.Counter(), collections.Counter()
    texts = {r["doc_id"]: r["text"] for r in rows(docs)}
    for d, t in texts.items():
        tokens = TOKEN.findall(t or "")
        grams[d] = [bucket([a], rules.buckets) for a in tokens] + [
            bucket([a, " ", b], rules.buckets) for a, b in zip(tokens, [*tokens[1:], ""], strict=True)] if tokens else []
        every.update(grams[d])
        if d in good:
            target.update(grams[d])
    scale = sum(target.values()) / sum(every.values())
    want = set()
    for d, t in texts.items():
        ws = WORD.findall(t or "")
        seen = collections.Counter(zip(ws, ws[1:], ws[2:], strict=False))
        covered = {i + j for i in range(len(ws) - 2) for j in range(3) if seen[tuple(ws[i:i + 3])] > 1}
        score = np.mean([np.log((target[b] + rules.prior) / (every[b] * scale + rules.prior)) for b in grams[d]] or [0])
        if len(ws) >= 50 and 100 * len(covered) <= 50 * len(ws) and score >= rules.min_score:
            want.add(d)
    assert {r["doc_id"] for r in rows(done)} == want and 0 < len(want) < len(texts)
    assert sorted(map(str, rows(done))) == sorted(str(r) for r in rows(docs) if r["doc_id"] in want)


def water_filled(sizes):
    """Targets by shares 5, 2, 1 of 150 % of all words, none above twice its own; sources by code point, null last."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, full = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return full | share
        for s in over:
            full[s] = 2.0 * sizes[s]
            left -= full[s]


def test_mixing(stages):
    docs, done = stages["mix_sources"]
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in rows(docs)}
    source = {r["doc_id"]: r["source"] for r in rows(docs)}
    own, taken, most = collections.Counter(), collections.Counter(), collections.Counter()
    for d, s in source.items():
        own[s] += size[d]
        most[s] = max(most[s], size[d])
    copies = collections.Counter(r["doc_id"] for r in rows(done))
    assert set(copies) <= set(size) and max(copies.values()) == 2
    for d, n in copies.items():
        taken[source[d]] += n * size[d]
    for s, target in water_filled(own).items():
        assert abs(taken[s] - target) <= most[s], s
    original = {r["doc_id"]: str(r) for r in rows(docs)}
    assert all(str(r) == original[r["doc_id"]] for r in rows(done))


def test_targets_and_order_of_sources(spark):
    """Each target and source size of op10, with a null source, one by code point beyond ASCII, and full sources."""
    from shopstar.llm import mixing

    sizes = {"b": 40, "a": 900, "é": 300, "Z": 7, None: 100, "aa": 5}
    data = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes.items())]
    docs = mixing.sized(spark.createDataFrame(data, "doc_id long, text string, source string"))
    want = water_filled(sizes)
    for r in mixing.mix_sources(docs).collect():
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_packing(stages):
    from tokenizers import Tokenizer

    docs, done = stages["best_fit_packing"]
    own = Tokenizer.from_file(queries.tokenizer_file())
    want = collections.Counter()
    for r in rows(docs):
        ids = np.array([*own.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((r["doc_id"], i, s, n, zlib.crc32(ids[s:s + n].tobytes()))
                    for i, (s, n) in enumerate(packing.cut(len(ids), 2048)))
    got = rows(done)
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        assert [o for o, _ in sorted(pieces)] == np.cumsum([0, *(n for _, n in sorted(pieces))])[:-1].tolist()
        assert sum(n for _, n in pieces) <= 2048


def test_run_is_the_stages_in_order(stages, spark):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = stages["best_fit_packing"][1].select(columns).collect()
    assert collections.Counter(corpus_pipeline.run(spark, SF).select(columns).collect()) == collections.Counter(want)


def odd(spark):
    text = " ".join(f"w{i}" for i in range(90))
    data = [(1, None, None), (2, "", "a"), (3, text, "a"), (3, text, "a"), (4, text, "a"), (None, text, "b"),
            (None, None, None), (5, "long words " * 40_000, "b"), (6, f"{text}\n{'shared line of some length'}\nx", "é"),
            (7, "shared line of some length\n" + text[::-1], "é"), (8, "shared line of some length", None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in data], "doc_id long, text string, source string, lang string, n_chars long")
    for i, c in enumerate(CLASHING):
        docs = docs.withColumn(c, F.concat(F.lit(f"{i}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    return docs, data


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_and_clashing_columns(spark, name):
    """Null, empty, long and repeated texts, null ids and sources, columns named like those of the operators."""
    docs, data = odd(spark)
    done = STAGES[name](spark, docs, SF)
    got = rows(done)
    if name == "best_fit_packing":
        assert {r["doc_id"] for r in got} == {d for d, _, _ in data}
        assert sum(r["length"] for r in got if r["doc_id"] in (1, 2)) == 2
        return
    assert done.columns == docs.columns
    for r in got:  # what does not change stays with its row
        assert [r[c] for c in CLASHING] == [f"{i}-{'none' if r['doc_id'] is None else r['doc_id']}" for i in range(len(CLASHING))]
    ids = collections.Counter(r["doc_id"] for r in got)
    if name == "quality_rules":
        assert not set(ids) & {1, 2, 8} and None not in {r["text"] for r in got}
    if name == "line_dedup":
        kept = {r["doc_id"]: r["text"] for r in got}
        assert len(got) == len(data) and kept[8] == "shared line of some length"
        assert kept[6].endswith("\nx") and "shared" not in kept[6] + kept[7] and kept[1] in (None, "")
        assert all(r["n_chars"] == len(r["text"] or "") for r in got)
    if name == "ngram_jaccard_join":
        assert ids[3] == 2 and 4 not in ids and 6 not in ids and ids[None] == 2 and {1, 2, 5, 7, 8} <= set(ids)
    if name == "mix_sources":
        assert max(n for d, n in ids.items() if d not in (3, None)) <= 2 and ids[3] <= 4


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, name):
    docs, _ = odd(spark)
    done = STAGES[name](spark, docs.filter("false"), SF)
    assert done.count() == 0 and (name == "best_fit_packing" or done.columns == docs.columns)


def test_run_on_odd_and_empty_tables(spark, tmp_path):
    docs, _ = odd(spark)
    labels = read(spark, SF, "labels")
    for name, frame, some in (("odd", docs, True), ("none", docs.filter("false"), False)):
        frame.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.filter(F.lit(some)).write.parquet(str(tmp_path / name / "labels.parquet"))
        got = corpus_pipeline.run(spark, str(tmp_path / name))
        assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        assert (got.count() > 0) == some
