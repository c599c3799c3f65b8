"""Centroid clustering, source divergence and exact dedup against plain Python, with the odd cases."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopstar.llm import centroids, divergence, exact_dedup, queries
from shopstar.llm.tables import Spool

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def clustered(rows, rounds, clusters):
    """Lloyd's rounds with Python's whole numbers; rows of (vec_id, integers)."""
    first = sorted((hashlib.sha256(f"2:{v}".encode()).hexdigest(), e) for v, e in rows if v is not None)[:clusters]
    centers = [list(e) for _, e in first]
    away = lambda e, c: sum((x - y) ** 2 for x, y in zip(e, c, strict=True))
    best = lambda e: min((away(e, c), i) for i, c in enumerate(centers))
    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, e in rows:
            groups[best(e)[1]].append(e)
        for c, members in groups.items():
            centers[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    return [(v, best(e)[1], best(e)[0]) for v, e in rows], centers


def test_centroids(spark):
    rng = np.random.default_rng(8)
    means = rng.standard_normal((6, 64))
    x = (means[rng.integers(0, 6, 300)] + rng.standard_normal((300, 64)) * rng.choice([0.05, 0.5], (300, 1))).astype(np.float32)
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(x)]
    rows += [(i, rows[i][1]) for i in range(5)] + [(1000 + i, rows[7][1]) for i in range(90)]  # repeated rows, one hot vector
    rows += [(None, rows[3][1]), (2000, [0.0] * 64), (2001, [-0.001] * 64), (2002, [60000.0, -60000.0] * 32)]
    bad = [(3000, None), (3001, []), (3002, [1.0] * 63), (3003, [1.0] * 65), (3004, [float("nan")] + [1.0] * 63),
           (3005, [float("inf")] + [1.0] * 63), (3006, [None] + [1.0] * 63), (3007, [1e30] + [1.0] * 63)]
    # An own column with the name of an added one.
    vectors = spark.createDataFrame([(*r, 5) for r in rows + bad], "vec_id long, embedding array<float>, cluster int")
    whole = [(v, [math.floor(256 * np.float64(np.float32(c))) for c in e]) for v, e in rows]
    rule = centroids.Clustering(clusters=9, rounds=3, slice_rows=50)
    want, centers = clustered(whole, 3, 9)
    inertia = collections.Counter()
    for _, c, d in want:
        inertia[c] += d
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    expected = collections.Counter((v, c, d, inertia[c], sum(inertia.values()), shas[c]) for v, c, d in want)
    for frame in (vectors, vectors.repartition(7)):
        assert collections.Counter(map(tuple, centroids.cluster_vectors(frame, rule).collect())) == expected


def test_centroids_few_and_none(spark):
    schema = "vec_id long, embedding array<double>"
    assert centroids.cluster_vectors(spark.createDataFrame([], schema)).count() == 0
    assert centroids.cluster_vectors(spark.createDataFrame([(1, None), (2, [1.0])], schema)).count() == 0
    assert centroids.cluster_vectors(spark.createDataFrame([(None, [1.0] * 64)], schema)).count() == 0
    got = centroids.cluster_vectors(spark.createDataFrame([(1, [0.0] * 64), (2, [1.0] * 64)], schema)).collect()
    assert {r["distance"] for r in got} == {0} and {r["cluster"] for r in got} == {0, 1}


@pytest.mark.parametrize("levels", [(64,), (1, 64), (4, 8, 16, 32, 64)])
def test_progressive_search_keeps_ties(levels):
    """Exact distances, and of equally near centroids the one with the smallest number."""
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, (500, 64)).astype(np.int64)
    centers = np.concatenate([x[:20], x[:20], np.zeros((3, 64), np.int64)])
    order = centroids.coarse_first()
    assert sorted(order) == list(range(64))
    cluster, distance = centroids.nearest(centroids.hadamard(x)[:, order], centroids.hadamard(centers)[:, order], levels)
    away = ((x[:, None] - centers[None]) ** 2).sum(2)
    assert (cluster == away.argmin(1)).all() and (distance == away.min(1)).all() and cluster.max() <= 40


def audited(rows, min_docs, top):
    """All values from the counts of every term, term by term."""
    docs, used = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    groups = set()
    for text, lang, source in rows:
        lang, source, terms = lang or "", source or "", re.findall(TERM, lower(text or ""))
        groups.add((lang, source))
        docs[lang].update(set(terms))
        used[lang, source].update(terms)
    share = lambda n, total, v: 1 + 10**9 * (n + 2) // (total + 2 * v)
    apart = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for g, s in groups if g == lang]
        p = {}
        every = {t: sum(used[lang, s][t] for s in sources) for t in kept}
        q = {t: share(every[t], sum(every.values()), len(kept)) for t in kept}
        for s in sources:
            total = sum(used[lang, s][t] for t in kept)
            p[s] = {t: share(used[lang, s][t], total, len(kept)) for t in kept}
        for s in sources:
            pair = [(-sum(apart(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            term = [(-apart(p[s][t], q[t]), t.encode(), t) for t in kept if used[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                out += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(sorted(items)[:most], 1)]
    return out


def audit_rows():
    rng = np.random.default_rng(6)
    names = [f"t{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)] + ["Éa", "you好", "ABC", "\x80x"]
    rows = []
    for i in range(260):
        lang, source = ("en", "de", "x")[i % 3 if i % 7 else 0], f"s{i % 5}" if i % 3 else "hot"
        size = int(rng.integers(0, 80))
        terms = [names[int(k) % len(names)] for k in rng.zipf(1.3, size)]
        rows.append(("1 ".join(terms), lang, source))
    rows += [(None, "en", "empty"), ("", "en", ""), ("a-b_c 12", "en", None), (None, None, None), ("words", "alone", "s"),
             ("x " * 3, "none", "a"), ("y", "none", "b"), ("tab " * 20_000 + "é" * 3000 + " tac", "de", "long")]
    return rows + rows[:9]


@pytest.mark.parametrize("rule", [
    divergence.Audit(min_docs=2), divergence.Audit(min_docs=3, top_terms=3, strip_words=1, block=2, held_terms=20, slice_bytes=7)])
def test_divergence(spark, rule):
    """Alike in one strip and block, and in many small ones."""
    rows = audit_rows()
    docs = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, value int").repartition(3)
    got = [tuple(r) for r in divergence.audit_sources(docs, rule).collect()]
    want = audited(rows, rule.min_docs, rule.top_terms)
    assert sorted(got) == sorted(want)
    assert any(r[0] == "none" and r[4] == 0 for r in got) and any(r[1] == "empty" for r in got)


def test_divergence_bitsets(spark):
    """Every kept term of a group is one bit of the bitset of its count."""
    rows = audit_rows()
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    audit = divergence.Divergence(docs, divergence.Audit(min_docs=2))
    kept = {(r["lang"], r["source"], r["n"], r["id"]) for r in audit.kept.collect()}
    bits = set()
    for r in audit.bitsets().collect():
        word = r["bits"] % (1 << 64)
        bits |= {(r["lang"], r["source"], r["n"], 64 * r["word"] + i) for i in range(64) if word >> i & 1}
    assert bits == kept and len(kept) > 500


def test_divergence_of_nothing(spark):
    assert divergence.audit_sources(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_share_beyond_a_long(spark):
    row = spark.range(1).select(divergence.share(F.lit(10**13), F.lit(3 * 10**13), F.lit(10**6)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (10**13 + 2) // (3 * 10**13 + 2 * 10**6)


COPIES = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (5, "b"), (6, "long text " * 50_000), (7, "long text " * 50_000),
          (8, "A"), (9, " a"), (None, "a"), (None, "only without id"), (None, "only without id"), *[(100 + i, "hot") for i in range(200)]]


def marked(rows):
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    out = []
    for d, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids, default=None)
        out.append((d, keep, len(groups[t or ""]), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return out


@pytest.mark.parametrize("hot_share", [0, 0.001, 0.3, 1])
@pytest.mark.parametrize("batches", [1, 3])
def test_exact_dedup(spark, monkeypatch, hot_share, batches):
    """Alike whether texts are met by broadcast or by merge, in one batch or several."""
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", hot_share)
    # Own columns with the names of helpers and results.
    docs = spark.createDataFrame([(*r, 1, "x") for r in COPIES], "doc_id long, text string, digest int, kept string").repartition(4)
    got = exact_dedup.mark_copies(docs, batches=batches)
    assert got.columns == ["doc_id", "text", "digest", "keep_id", "group_size", "kept", "text_sha256"]
    rows = got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(marked(COPIES), key=str)


def test_digest_index_goes_on(spark):
    """New data meets the stored index in another session's view of it; adding again changes nothing."""
    folder = Spool(spark, "test-index").folder
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (None, "n")], "doc_id long, text string")
    second = spark.createDataFrame([(8, "a"), (9, "c"), (4, "c"), (9, "c"), (7, None)], "doc_id long, text string")
    index = exact_dedup.DigestIndex(spark, folder, buckets=5)
    new = lambda docs, i: sorted((r["doc_id"], r["text"]) for r in exact_dedup.new_documents(docs, i).collect() if r["doc_id"])
    assert new(first, index) == [(2, "a"), (3, "b")]
    spark.sql(f"DROP TABLE {index.table}")
    again = exact_dedup.DigestIndex(spark, folder, buckets=99)
    assert again.buckets == 5 and again.known().count() == 3
    assert new(second, again) == [(7, None), (9, "c")]
    again.compact()
    assert again.generation == 1 and again.known().count() == 5
    kept = {r["doc_id"]: r["keep_id"] for r in exact_dedup.mark_copies(second, again).collect()}
    assert kept == {8: 2, 9: 9, 4: 9, 7: 7} and again.known().count() == 5
    assert exact_dedup.DigestIndex(spark, folder).generation == 1
    plan = spark.sql(f"DESCRIBE EXTENDED {again.table}").filter("col_name in ('Num Buckets', 'Sort Columns')").collect()
    assert {r["data_type"] for r in plan} == {"5", "[`digest`]"}


def test_exact_dedup_plan(spark, monkeypatch):
    """Summed up copies meet the index by a sort-merge anti-join without a shuffle of the index."""
    plans = []
    add = exact_dedup.DigestIndex.add

    def explained(self, batch):
        plans.append(self.unknown(batch)._jdf.queryExecution().executedPlan().toString())
        add(self, batch)

    monkeypatch.setattr(exact_dedup.DigestIndex, "add", explained)
    queries.op13_exact_dedup(spark, "/root/testdata/sf0.001")
    assert len(plans) == 2
    for plan in plans:
        assert "SortMergeJoin" in plan and "LeftAnti" in plan and plan.count("Exchange") == 1
        assert plan.index("SortMergeJoin") < plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("HashAggregate")


def test_exact_dedup_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.mark_copies(none).count() == 0
