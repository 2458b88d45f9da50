"""Anchor-point SimHash, collocations and spelling variants against brute force, and on odd and empty tables."""

import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from os.path import dirname

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path[:0] = [dirname(__file__), dirname(dirname(__file__))]

from compare import compare, connect  # noqa: E402
from fixtures import odd_documents  # noqa: E402
from parley.llm import anchor_simhash, catalog, phrases, variants  # noqa: E402

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def given_documents():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM read_parquet('{SF}/documents.parquet')").fetchall()


# --- SimHash --------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_classes(rows):
    """(doc_id, fingerprint, smallest reachable doc_id) of (doc_id, text), all pairs compared."""
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None:
            least[r] = doc if least[r] is None else min(least[r], doc)
    return sorted(((d, f"{fps[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def found_classes(df):
    return sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in df.collect()), key=str)


def test_given_documents(spark):
    got = catalog.QUERIES["op11_simhash_anchors"](spark, SF)
    assert sorted((tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()), key=str) == plain_classes([r[:2] for r in given_documents()])


def test_odd_documents_simhash(spark):
    docs = odd_documents(spark)
    assert found_classes(anchor_simhash.classed(docs)) == plain_classes([(r.doc_id, r.text) for r in docs.collect()])
    assert anchor_simhash.classed(odd_documents(spark, [])).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_close_fingerprints_share_an_anchor(word, flips):
    blocks = BLOCKS
    other = word
    for b in flips:
        other ^= 1 << b
    near, far = anchor_simhash.anchors_of(word, blocks)
    theirs = set(np.concatenate(anchor_simhash.anchors_of(other, blocks)).tolist())
    assert set(near.tolist()) & theirs
    # All are code words within the radius and two flips, and none repeats.
    found = np.concatenate([near, far])
    assert len(set(found.tolist())) == len(found) and int(np.bitwise_count(found ^ np.uint64(word)).max()) <= 8 + 2


BLOCKS = anchor_simhash.perfect_blocks()


def test_codes_are_perfect():
    for block, radius in zip(BLOCKS, (3, 3, 1, 1)):
        assert max(e.bit_count() for e in block.leader.values()) == radius
        assert len(block.leader) == sum(len(layer) for layer in block.layers[: radius + 1])


def chained(rng, count, flips=3):
    """Fingerprints, each a few bits from an earlier one."""
    out = [rng.getrandbits(64)]
    while len(out) < count:
        word = rng.choice(out[-50:])
        for b in rng.sample(range(64), rng.randint(1, flips)):
            word ^= 1 << b
        if word not in out:
            out.append(word)
    return out


@pytest.mark.parametrize("chunk", [4, 1024])
def test_spanning_links_keep_every_component(spark, monkeypatch, chunk):
    """Chains, random words and a dense group of many more members than a chunk."""
    monkeypatch.setattr(anchor_simhash, "CHUNK", chunk)
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    dense = [centre ^ sum(1 << b for b in rng.sample(range(12), rng.randint(0, 3))) for _ in range(200)]
    words = np.unique(np.array(chained(rng, 150) + [rng.getrandbits(64) for _ in range(150)] + dense + [0, 1, 2**64 - 1], np.uint64))
    rows = anchor_simhash.links(spark.createDataFrame([(int(x),) for x in words.view(np.int64)], "fp long")).collect()
    at = {int(w): i for i, w in enumerate(words.view(np.int64))}
    close = np.bitwise_count(words[:, None] ^ words) <= 3

    def label(pairs):
        root = list(range(len(words)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return [find(i) for i in range(len(words))]

    links = [(at[r.u], at[r.v]) for r in rows]
    assert all(close[a, b] for a, b in links)
    assert label(links) == label(zip(*(x.tolist() for x in np.nonzero(close))))
    # Rows grow with the members, not with their pairs.
    if chunk > 4:
        assert all(len(x) <= len(words) for x in [anchor_simhash.spanning_links(words.view(np.int64), np.ones(len(words), bool))])


# --- collocations ---------------------------------------------------------


def plain_collocations(rows, least, share, top):
    counts, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    longer, out = Counter(), []
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = (lang, words[i : i + k])
                longer[part] = max(longer[part], a)
    for (lang, words), a in candidates.items():
        if 100 * longer[lang, words] >= share * a:
            continue
        cuts = [(2000000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    ranked, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(ranked)


def found_collocations(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def babble(rng, lines, letters="abcd"):
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 2)))
    return "".join(word() + rng.choice([" ", " ", " ", " ", " ", "\t", ". ", "\n", ", "]) for _ in range(lines))


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_of_random_texts(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["en", "en", "de", None]), babble(rng, 120) + " A b A b A b") for _ in range(40)] + [("en", "a b c a. " * 300), ("und", None)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert found_collocations(phrases.collocations(docs, 5, 80, 30)) == plain_collocations(rows, 5, 80, 30)


def test_odd_documents_collocations(spark):
    docs = odd_documents(spark)
    got = found_collocations(phrases.collocations(docs, 2, 80, 2000))
    assert got == plain_collocations([(r.lang, r.text) for r in docs.collect()], 2, 80, 2000) and got
    assert phrases.collocations(odd_documents(spark, [])).count() == 0


def test_collocations_against_sql(spark):
    assert compare(spark, connect("/root/testdata/sf0.01"), "/root/testdata/sf0.01", catalog.QUERIES["op12_collocations"], catalog.ORACLES["op12_collocations"]) == ""


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 3)] * 4, st.integers(1, 3)), max_size=60), st.integers(1, 6))
def test_multikey_quicksort(rows, least):
    # As suffixes are: nothing follows a zero.
    rows = [tuple(x if all(r[: i + 1]) else 0 for i, x in enumerate(r[:4])) + (r[4],) for r in rows]
    columns = [np.array([r[i] for r in rows], np.int64) for i in range(4)]
    at, length, total = phrases.multikey_quicksort(columns, np.array([r[4] for r in rows], np.int64), least)
    got = Counter({tuple(int(columns[i][a]) for i in range(n)): int(t) for a, n, t in zip(at, length, total)})
    plain = Counter()
    for r in rows:
        for k in range(2, 5):
            if all(r[:k]):
                plain[r[:k]] += r[4]
    assert len(at) == len(got) and got == Counter({p: c for p, c in plain.items() if c >= least})


@pytest.mark.parametrize("hot", [0, 1, 3])
def test_routes_count_every_phrase(hot):
    """Whatever words are hot, rows of routes and of hot phrases add up to all phrases."""
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 5, 400)
    spelled, columns, weight, lead = phrases._suffix_rows(ids, np.arange(1, hot + 1))
    places, columns = columns, [spelled[c] for c in columns]
    got = Counter()
    for *words, w, n in zip(*columns, weight, lead):
        for k in range(2, 5):
            if n and k >= n and all(words[:k]):
                got[tuple(words[:k])] += int(w)
        if not n:
            got[tuple(x for x in words if x)] += int(w)
    plain = Counter(tuple(ids[i : i + k].tolist()) for k in range(2, 5) for i in range(len(ids) - k + 1) if ids[i : i + k].all())
    assert {tuple(map(int, k)): v for k, v in got.items()} == dict(plain)
    book = np.array([2, 4])  # some words have short codes, others none
    packed = phrases._packed(spelled, places, weight, lead, 7, 1, book)["packed"]
    back, sums, _ = phrases._unpacked(packed, book)
    assert sums.sum() == weight.sum() and Counter(zip(*(c.tolist() for c in back))) == Counter(zip(*(c.tolist() for c in columns)))


# --- spelling variants ----------------------------------------------------


def plain_variants(rows, letters=5, count=3):
    words = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            words[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    vocab = {w: n for w, n in words.items() if len(w) >= letters and n >= count}

    def is_near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    near = {w: [v for v in vocab if v != w and is_near(v, w)] for w in vocab}
    form = {}
    for w in vocab:
        best = min(near[w], key=lambda v: (-vocab[v], v), default=None)
        if best and vocab[best] >= 2 * vocab[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), vocab[w], len(near[w]), vocab.get(form.get(w))) for w in vocab)


def found_variants(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def variant_rows():
    rng = random.Random(8)
    base = ["colour", "straße", "ÀÉÎõü", "aaaaa", "wording", "k" * 45, "z" * 300]
    out = []
    for i in range(60):
        picked = []
        for _ in range(40):
            word = list(rng.choice(base))
            if rng.random() < 0.5:
                at = rng.randrange(len(word))
                rng.choice([lambda: word.pop(at), lambda: word.insert(at, rng.choice("aeÿ÷")), lambda: word.__setitem__(at, rng.choice("aokz"))])()
            picked.append("".join(word))
        out.append((None if i == 7 else i, " ".join(picked) + ". Upper UPPER upper"))
    return out + [(1, out[1][1]), (99, None), (98, ""), (97, "× ÷÷÷÷÷ ÷÷÷÷÷ ÷÷÷÷÷÷")]


@pytest.mark.parametrize("shard_words", [1 << 23, 3])
def test_variants_of_odd_words(spark, monkeypatch, shard_words):
    monkeypatch.setattr(variants, "SHARD_WORDS", shard_words)
    rows = variant_rows()
    got = found_variants(variants.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain_variants(rows) and any(r[1] for r in got) and any(len(r[0]) > 200 for r in got)


def test_variants_of_given_documents(spark):
    # All pairs of words would take long here: near words meet at a deletion or at a pattern with one letter open.
    rows = [(d, t) for d, t, _ in given_documents()][:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_variants(variants.variants(docs)) == plain_variants(rows)


def test_odd_documents_variants(spark):
    docs = odd_documents(spark)
    assert found_variants(variants.variants(docs)) == plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert variants.variants(odd_documents(spark, [])).count() == 0


def test_forms_chain_to_a_root(spark):
    # Counts double along the chain of one-letter steps.
    steps = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"]
    text = " ".join(w for i, w in enumerate(steps) for _ in range(3 * 2**i))
    rows = [(1, text)]
    got = found_variants(variants.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain_variants(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abÿ÷", min_size=6, max_size=6), min_size=1, max_size=8, unique=True))
def test_edit_hashes(words):
    points = variants.letters_of(words)
    alphabet = np.array(sorted(map(ord, "abÿ÷")), np.uint64)
    for deleted in (False, True):
        seen = set()
        for row, place, letter, h in variants._edits(points, alphabet, deleted):
            for r, p, c, x in zip(row.tolist(), place.tolist(), letter.tolist(), h.tolist()):
                edited = words[r][:p] + (chr(c) if c else "") + words[r][p + 1 :]
                assert x == int(variants.hashes(variants.letters_of([edited]))[0])
                seen.add((words[r], edited))
        if deleted:
            assert seen == {(w, w[:i] + w[i + 1 :]) for w in words for i in range(6)}
        else:
            assert seen == {(w, w[:i] + c + w[i + 1 :]) for w in words for i in range(6) for c in "abÿ÷" if c > w[i]}
