"""The pipeline against a plain, unshared version on a small corpus with planted cases."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parley.llm import dartminhash, pieces, secrets, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, size string"


def sentence(rng, words=30):
    return " ".join("".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 8))) for _ in range(words))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    texts = [sentence(rng, rng.randint(8, 60)) for _ in range(120)]
    toxic = set(range(0, 120, 4))
    for i in toxic:
        words = texts[i].split()
        words.insert(rng.randrange(len(words)), rng.choice(["vile", "v1le", "stinker"]))
        texts[i] = " ".join(words)
    texts[5] += " password=" + "ab12" * 5
    texts[9] += ' token: "' + "0123456789abcdef" * 2 + '"'
    texts += [texts[1], texts[1], texts[2] + " more", None, "", "   ", texts[3].upper()]
    rows = [(i, t, "en", f"s{i % 4}" if i % 11 else None, len(t or ""), "x", "y") for i, t in enumerate(texts)]
    root = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{root}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def plain(spark, root):
    """The stages one document at a time."""
    docs = [r.asDict() for r in spark.read.parquet(f"{root}/documents.parquet").orderBy("doc_id").collect()]
    model = toxicity.fit(spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet"))
    docs = [d for d in docs if model.score(d["text"]) < 0.5]
    sets = {d["doc_id"]: dartminhash.elements(d["text"] or "") for d in docs}
    parent = {i: i for i in sets}

    def root_of(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and len(sets[i][0]) and len(sets[j][0]) and dartminhash.weighted_jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((root_of(i), root_of(j)))
                parent[b] = a
    docs = [d for d in docs if root_of(d["doc_id"]) == d["doc_id"]]
    formats = secrets.learn_formats(spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id long, text string"))
    for d in docs:
        text = d["text"] or ""
        hidden = {i for _, _, end, start in formats.spans(text) for i in range(start, end)}
        shown = "".join("\0" if i in hidden else c for i, c in enumerate(text))
        d["text"] = d["text"] and re.sub("\0+", "[SECRET]", shown)
        d["n_chars"] = None if d["text"] is None else len(d["text"])
    sizes = {}
    for d in docs:
        sizes[d["source"]] = sizes.get(d["source"], 0) + len((d["text"] or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    low, high = 0.0, 1e9
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(3 * sizes[s], mid * weight[s]) for s in names) < sum(sizes.values()) else (low, mid)
    out = []
    for s in names:
        own = [d for d in docs if d["source"] == s]
        own.sort(key=lambda d: hashlib.md5(f"mix:{d['doc_id']}:{d['text'] or ''}".encode()).hexdigest())
        target, before = min(3 * sizes[s], high * weight[s]), 0
        epochs = math.floor(target / sizes[s] + 1e-9) if sizes[s] else 0
        budget = math.floor(target - epochs * sizes[s] + 1e-6)
        for d in own:
            n = len((d["text"] or "").split())
            rest = max(0, min(n, budget - before))
            out += [d] * (1 if n == 0 else epochs + (rest > 0 and 2 * rest >= n))
            before += n
    processor = pieces.load_processor(pieces.default_model())
    return [(d["doc_id"], d["text"], d["source"], d["n_chars"], tuple(processor.encode(d["text"] or "") + [2])) for d in out]


def key(row):
    return tuple((x is None, x if x is not None else "") for x in row)


def test_run_is_the_plain_version(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    got = sorted(((r.doc_id, r.text, r.source, r.n_chars, tuple(r.ids)) for r in rows), key=key)
    expected = sorted(plain(spark, folder), key=key)
    assert got == expected
    processor = pieces.load_processor(pieces.default_model())
    assert all(r.decoded == processor.decode(list(r.ids)) for r in rows)
    kept = {r[0] for r in got}
    assert not kept & {120, 121, 122, 126}, "copies stay"
    assert {123, 124, 125} <= kept, "texts without words go"
    assert not any("ab12ab12" in (r[1] or "") for r in got)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, folder).columns == docs.columns, name


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").filter(F.lit(False)).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
