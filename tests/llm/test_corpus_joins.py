"""Operators across documents against brute force, and queries against their SQL."""

import hashlib
import os
import random
import sys
from collections import Counter
from os.path import dirname

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, dirname(__file__))

from compare import compare, connect  # noqa: E402
from fixtures import words  # noqa: E402
from parley.llm import block_topk, catalog, cross_polytope, dartminhash, mixing, prefix_free, sentence_spans  # noqa: E402
from parley.llm.components import components  # noqa: E402

ROOT = "/root/testdata"
needs_tables = pytest.mark.skipif(not os.path.isdir(ROOT), reason="test tables are not here")


@needs_tables
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_queries_match_their_sql(spark, name):
    folder = f"{ROOT}/sf0.001"
    assert compare(spark, connect(folder), folder, catalog.QUERIES[name], catalog.ORACLES[name]) == ""


@needs_tables
@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_queries_give_a_row_per_document(spark, name):
    folder = f"{ROOT}/sf0.001"
    got = catalog.QUERIES[name](spark, folder)
    if name == "op9_nearest":
        assert got.count() == 20 * got.select("query_id").distinct().count()
    elif name == "op13_spelling_variants":
        assert got.count() == got.select("word").distinct().count() > 0
    else:
        ids = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id")
        assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in ids.collect())


def test_targets_share_the_excess(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, None: 85, "d": 0}
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], (5, 2, 1, 5, 2)))
    level = max(got[s] / weight[s] for s in sizes)
    assert sum(got.values()) == pytest.approx(1100)
    assert all(got[s] == pytest.approx(min(3 * sizes[s], level * weight[s])) for s in sizes)


def test_darts_estimate_the_weighted_jaccard():
    rng = np.random.default_rng(7)
    for shared in (0.9, 0.5):
        pairs = []
        for _ in range(30):
            base, other = np.sort(rng.integers(1, 2**63, 300)).astype(np.uint64), rng.integers(1, 2**63, 300).astype(np.uint64)
            keep = rng.random(300) < shared
            second = np.where(keep, base, other)
            order = np.argsort(second)
            weight = rng.uniform(0.5, 6, 300)
            pairs.append(((base, weight), (second[order], (weight * rng.uniform(0.9, 1, 300))[order])))
        signed = dartminhash.signatures([s for p in pairs for s in p], 144)
        exact = np.mean([dartminhash.weighted_jaccard(*p) for p in pairs])
        assert abs((signed[::2] == signed[1::2]).mean() - exact) < 0.03


def near_copies(rng):
    texts = [words(rng, rng.randint(5, 120)) for _ in range(60)]
    for i in range(60):
        for _ in range(rng.choice([0, 0, 1, 6])):
            w = texts[i].split()
            for _ in range(rng.choice([0, 1, 1, 3])):
                w[rng.randrange(len(w))] = "changed" + str(rng.randrange(99))
            texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize("chunk", [1024, 2])
def test_near_duplicate_classes(spark, monkeypatch, chunk):
    monkeypatch.setattr(dartminhash, "CHUNK", chunk)
    texts = near_copies(random.Random(5))
    got = {r.doc_id: r.class_id for r in dartminhash.classed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sets, root = [dartminhash.elements(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if dartminhash.weighted_jaccard(sets[i], sets[j]) >= 0.8:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert got == dict(enumerate(root))


@pytest.mark.parametrize("chunk", [1024, 40])
def test_near_duplicate_groups_at_the_threshold(spark, monkeypatch, chunk):
    monkeypatch.setattr(dartminhash, "CHUNK", chunk)
    rng, texts = random.Random(12), []
    for size in (60, 60, 200):
        base = words(rng, 304).split()
        for _ in range(size):
            w = list(base)
            for at in rng.sample(range(304), 4):  # two variants are about 0.77 alike, some more than 0.8
                w[at] = f"changed{rng.randrange(10**9)}"
            texts.append(" ".join(w))
    got = {r.doc_id: r.class_id for r in dartminhash.classed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sets, root, signed = [dartminhash.elements(t) for t in texts], list(range(len(texts))), dartminhash.sign(texts)
    keys, marks = np.array(signed["bands"].tolist()), np.array([np.frombuffer(m, np.uint8) for m in signed["marks"]])
    for i in range(len(texts)):
        near = np.flatnonzero((keys[:i] == keys[i]).any(axis=1) & ((marks[:i] == marks[i]).mean(axis=1) >= dartminhash.THRESHOLD - dartminhash.MARGIN))
        for j in near:
            if root[i] != root[j] and dartminhash.weighted_jaccard(sets[i], sets[j]) >= 0.8:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert got == dict(enumerate(root))


@pytest.mark.parametrize("chunk", [1024, 40])
def test_near_duplicates_below_the_threshold_make_no_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(dartminhash, "CHUNK", chunk)
    rng, rows, stage = random.Random(3), {}, dartminhash.stage
    base, texts = words(rng, 304).split(), []
    for _ in range(300):
        w = list(base)
        for at in rng.sample(range(304), 5):  # about 0.72 alike
            w[at] = f"changed{rng.randrange(10**9)}"
        texts.append(" ".join(w))

    def counted(df, label):
        out = stage(df, label)
        rows[label] = max(rows.get(label, 0), out.count())
        return out

    monkeypatch.setattr(dartminhash, "stage", counted)
    got = {r.doc_id: r.class_id for r in dartminhash.classed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(got) == 300 and max(rows.values()) <= dartminhash.BANDS * 300  # there are 44,850 pairs


def test_links_of_a_block_are_a_forest_of_all_links():
    texts = near_copies(random.Random(8))
    sets, marks = [dartminhash.elements(t) for t in texts], np.array([np.frombuffer(m, np.uint8) for m in dartminhash.sign(texts)["marks"]])
    third = np.arange(len(texts)) % 3 == 0

    def classes(links):
        root = list(range(len(texts)))
        for i, j in links:
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
        return root

    for side, own in ((third, ~third), (np.zeros(len(texts), bool), np.ones(len(texts), bool))):
        found = dartminhash.block_links(marks, texts, side, own)
        wanted = [
            (i, j) for j in range(len(texts)) for i in range(j)
            if (side[i] != side[j] or own[i] and own[j]) and dartminhash.weighted_jaccard(sets[i], sets[j]) >= 0.8
            and (marks[i] == marks[j]).mean() >= dartminhash.THRESHOLD - dartminhash.MARGIN
        ]
        assert classes(found) == classes(wanted) and set(found) <= set(wanted) and len(found) < len(texts)


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_sentence_spans(spark):
    rng = random.Random(6)
    passage = ". ".join(words(rng, 14) for _ in range(5)) + "."
    texts = [". ".join(words(rng, rng.randint(1, 30)) for _ in range(8)) for _ in range(30)]
    texts += [f"{texts[0]}. {passage} {texts[1]}", f"intro here. {passage.upper()}", passage, texts[2] + "\n" + texts[2]]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.text, r.n_removed) for r in sentence_spans.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    seen = set()
    for i, text in rows:
        parts, gone = sentence_spans.sentences(text), set()
        for p, h in enumerate(sentence_spans.span_hashes(parts)):
            if h is not None and h in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(h)
        assert got[i] == ("".join(s for p, (s, _) in enumerate(parts) if p not in gone), len(gone)), i
    assert got[32][0] == "" and got[31][1] > 0


@pytest.mark.parametrize("front", range(13))
def test_passages_without_stops_share_spans(front):
    rng = random.Random(13)
    passage = words(rng, 120)
    spans = lambda t: {h for h in sentence_spans.span_hashes(sentence_spans.sentences(t)) if h is not None}
    other = f"{words(rng, front)} {passage} {words(rng, 30)}"
    assert "".join(s for s, _ in sentence_spans.sentences(other)) == other
    assert len(spans(passage) & spans(other)) >= 4


@pytest.mark.parametrize("contexts", [2000, 3])
def test_repeated_bytes(spark, monkeypatch, contexts):
    monkeypatch.setattr(prefix_free, "CONTEXTS", contexts)
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    a, b = noise(900), noise(420)
    texts = [a, noise(300) + a[100:700], noise(150) + b + noise(50), b, "xy" * 300, noise(100) + "xy" * 300, "a" * 900, "", noise(390), noise(70) * 12, noise(50) + b[:401] + noise(5), a]
    for _ in range(25):
        start = rng.randrange(300)
        texts.append(noise(rng.randrange(200)) + a[start : start + rng.randrange(380, 600)] + noise(rng.randrange(200)))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "xxhash64(text) AS node")
    nodes = {r.doc_id: r.node for r in docs.collect()}
    got = {r.node: (bytes(r.kept), r.n_removed, r.n_spans) for r in prefix_free.without_repeats(docs.select("doc_id", "text")).collect()}
    counts = Counter(d[p : p + 400] for d in (t.encode() for t in texts) for p in range(len(d) - 399))
    for i, text in rows:
        data, gone = text.encode(), set()
        for p in range(len(data) - 399):
            if counts[data[p : p + 400]] > 1:
                gone.update(range(p, p + 400))
        runs = sum(p - 1 not in gone for p in gone)
        expected = (bytes(x for p, x in enumerate(data) if p not in gone), len(gone), runs)
        assert got.get(nodes[i], (data, 0, 0)) == expected, i


def test_runs_of_one_byte_are_one_row():
    rows = prefix_free._ranks(b"-" * 5000, 400, 16, 128)
    assert len(rows) < 150 and sum(1 + len(r["more"] or ()) for r in rows) > 4000
    assert len({(r["rank"], r["whole"]) for r in rows}) == len(rows)


def test_rows_of_a_common_passage_are_dealt_anew(spark, monkeypatch):
    conf = {"shuffle.partitions": "64", "adaptive.coalescePartitions.enabled": "false", "adaptive.advisoryPartitionSizeInBytes": "1k", "autoBroadcastJoinThreshold": "-1",
            "adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "adaptive.skewJoin.skewedPartitionFactor": "1.5", "files.maxPartitionBytes": "8k", "files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(f"spark.sql.{k}", None) for k in conf}
    plans, staged = {}, prefix_free.stage

    def watched(df, label):
        if label in ("parse-ranks", "parse-marks"):
            df.collect()
            plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, label)

    monkeypatch.setattr(prefix_free, "stage", watched)
    rng = random.Random(12)
    passage = words(rng, 110)
    texts = [f"{words(rng, 60)} {passage} {words(rng, 60)}" for _ in range(600)]
    try:
        for k, v in conf.items():
            spark.conf.set(f"spark.sql.{k}", v)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(16)
        assert prefix_free.without_repeats(docs).filter(F.col("n_removed") >= len(passage)).count() == 600
    finally:
        for k, v in before.items():
            spark.conf.unset(f"spark.sql.{k}") if v is None else spark.conf.set(f"spark.sql.{k}", v)
    assert sorted(plans) == ["parse-marks", "parse-ranks"]
    for label, plan in plans.items():
        joins = [x for x in plan.partition("Initial Plan")[0].splitlines() if "SortMergeJoin" in x]
        assert joins and all("skew=true" in x for x in joins), label


def vectors(rng, n, width):
    x = rng.normal(size=(n, width))
    x[: n // 3] = x[0] + rng.normal(size=(n // 3, width)) * 0.01
    x[n // 3 : n // 3 + 30] = x[n // 3]  # ties
    return x


def test_exact_topk(spark, monkeypatch):
    monkeypatch.setattr(block_topk, "BLOCK", 16)
    monkeypatch.setattr(block_topk, "SHARD", 8)
    monkeypatch.setattr(block_topk, "GROUP", 20)
    x = np.floor(vectors(np.random.default_rng(9), 600, 7) * 9).astype(int)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(700, None), (701, [1, None] + [0] * 5), (None, [1] * 7), (3, x[3].tolist()), (702, [1])]
    df = spark.createDataFrame(rows, "id long, impacts array<bigint>")
    got = {}
    for r in block_topk.top_k(df, F.col("id") % 10 == 0, 5).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    scores = x @ x.T
    for q in range(0, 600, 10):
        order = sorted((i for i in range(600) if i != q), key=lambda i: (-scores[q, i], i))[:5]
        assert got[q] == {n + 1: (i, scores[q, i]) for n, i in enumerate(order)}
    big = spark.createDataFrame([(i, [2 * 10**9 + i, -(10**9)]) for i in range(10)], "id long, impacts array<bigint>")
    best = block_topk.top_k(big, F.col("id") == 0, 1).first()
    assert (best.vec_id, best.score) == (9, 2 * 10**9 * (2 * 10**9 + 9) + 10**18)
    assert block_topk.top_k(df.limit(0), F.col("id") % 10 == 0, 5).count() == 0


def test_nearest_recall(spark):
    x = vectors(np.random.default_rng(10), 2000, 24)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3000, None), (3001, [0.0] * 24), (3002, [float("nan")] * 24), (3003, [1.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    got = {}
    for r in cross_polytope.nearest(df, F.col("id") % 50 == 0, 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    scores, hits = x @ x.T, 0
    for q in range(0, 2000, 50):
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, 21)) and all(abs(s - scores[q, i]) < 1e-9 for _, i, s in own)
        assert [i for _, i, _ in own] == [i for _, i, _ in sorted(own, key=lambda t: (-t[2], t[1]))]
        others = np.delete(scores[q], q)
        hits += sum(s >= np.sort(others)[-20] - 1e-9 for _, _, s in own)
    assert hits / (40 * 20) >= 0.9
    assert cross_polytope.nearest(df.limit(0), F.col("id") == 0, 3).count() == 0


def _lengths(kind, rng, n):
    if kind == "one long":
        return np.r_[20.0, np.ones(n - 1)]
    return rng.lognormal(0, 0.5, n) if kind == "lognormal" else np.ones(n)


@pytest.mark.parametrize("n, kind", [(2, "unit"), (12, "unit"), (25, "one long"), (200, "lognormal"), (3000, "unit"), (3000, "one long"), (3000, "lognormal")])
def test_nearest_gives_all_rows_due(spark, n, kind):
    """Directions without any structure, in small tables and with uneven lengths."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64))
    x *= (_lengths(kind, rng, n) / np.linalg.norm(x, axis=1))[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")
    got = {}
    for r in cross_polytope.nearest(df, F.col("id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    scores, hits, due = x @ x.T, 0, min(20, n - 1)
    for q in range(0, n, 20):
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, due + 1)) and all(abs(s - scores[q, i]) < 1e-9 for _, i, s in own)
        hits += sum(s >= np.sort(np.delete(scores[q], q))[-due] - 1e-9 for _, _, s in own)
    assert hits / (len(got) * due) >= 0.9


@pytest.mark.parametrize("strays", [1, 9])
def test_rows_of_another_width_do_not_replace_the_others(spark, strays):
    """Searches run among vectors of the usual number of components, however long the strays are."""
    x = np.random.default_rng(4).integers(-5, 6, size=(40, 4))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100 + i, [1] * 6) for i in range(strays)]
    exact = block_topk.top_k(spark.createDataFrame(rows, "id long, impacts array<bigint>"), F.col("id") % 20 == 0, 5).collect()
    rows = [(i, [float(c) for c in v]) for i, v in rows]
    near = cross_polytope.nearest(spark.createDataFrame(rows, "id long, vector array<double>"), F.col("id") % 20 == 0, 5).collect()
    for found in (exact, near):
        assert sorted((r.query_id, r.rank) for r in found) == [(q, r) for q in (0, 20) for r in range(1, 6)]
        assert all(r.vec_id < 40 for r in found)
    assert {(r.query_id, r.vec_id, r.score) for r in exact} == {(r.query_id, r.vec_id, int(r.score)) for r in near}


@needs_tables
def test_piece_digests(spark):
    from parley.llm import pieces

    folder = f"{ROOT}/sf0.001"
    processor = pieces.load_processor(pieces.default_model())
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in catalog.QUERIES["op8_sentencepiece"](spark, folder).collect():
        ids = processor.encode(texts[r.doc_id]) + [2]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(processor.decode(ids)))
