"""Scans of single texts against their plain patterns, and the models behind them."""

import math
import os
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parley.llm import automata, pieces, pii, secrets, toxicity

SECRET = st.lists(st.sampled_from(
    ["password", "PassWd", "secret", "token", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "A", "Z9", "0", "abcdef", "deadbeef", "x", "\n", "é", "ſ", "-", "."]
), max_size=40).map("".join)
PERSONAL = st.lists(st.sampled_from(["a", "b.c", "@", "d-e", ".", "1", "255", "256", "4111", "1111", "+", " ", "-", "(", ")", "49", "0", "é", "_", "%", "\n"]), max_size=40).map("".join)


def plain_secrets(text):
    found = []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, m.end(), m.start(2)))
    found += [(m.start(), 1, m.end(), m.start()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), m.start()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def passes_luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_personal(text):
    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if max(map(int, m[0].split("."))) <= 255]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and passes_luhn(digits):
            found.append((2, *m.span()))
    found += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.findall("[0-9]", m[0])) <= 15]
    return found


@settings(max_examples=400, deadline=None)
@given(SECRET)
def test_secret_patterns(text):
    assert secrets.base_spans(text) == plain_secrets(text)


@settings(max_examples=400, deadline=None)
@given(PERSONAL)
def test_personal_patterns(text):
    assert pii.base_spans(text) == plain_personal(text)


def test_cards_need_a_right_check_digit():
    assert pii.base_spans("4111 1111 1111 1111") == [(2, 0, 19)] and pii.base_spans("4111111111111112") == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" ▁abcé\n\t0\U0001f600<s>"), max_size=60))
def test_chunks_encode_like_the_library(text):
    table = pieces.ChunkTable(pieces.load_processor(pieces.default_model()))
    assert table.encode([text, text], [2]) == [table.processor.encode(text) + [2]] * 2


def test_automaton_learns_a_format():
    rng = random.Random(1)
    keys = ["sk-" + "".join(rng.choice("0123456789abcdef") for _ in range(24)) for _ in range(200)]
    machine = automata.infer(keys)
    assert machine.loglik("sk-" + "0a" * 12) > -math.inf
    assert machine.loglik("plain-words-without-digits") == -math.inf
    # Merged states, not a tree of all the strings.
    reached, todo = {0}, [0]
    while todo:
        for state, _ in machine.steps[todo.pop()].values():
            if state not in reached:
                reached.add(state)
                todo.append(state)
    assert len(reached) < 60
    for state in reached:
        assert machine.ends[state] + sum(n for _, n in machine.steps[state].values()) == machine.visits[state]


def test_format_model_adds_unlabelled_keys(spark):
    rng = random.Random(2)
    code = lambda n: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(n))
    texts = [f"set token={code(24)} here" for _ in range(80)] + ["some extraordinarilylongwords andunbelievablylongones" for _ in range(80)]
    model = secrets.learn_formats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    text = f"look at {code(24)} and extraordinarilylongwords"
    assert [(k, text[s:e]) for s, k, e, _ in model.spans(text)] == [(3, text.split()[2])]


def test_short_dotted_and_partly_known_credentials(spark):
    rng = random.Random(15)
    code = lambda n: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(n))
    kinds = {"short": lambda: code(13), "dotted": lambda: f"{code(8)}.{code(8)}", "partly": lambda: f"SK_{code(5)}_9f8e7d6c5b4a39281706_{code(6)}"}
    for kind, make in kinds.items():
        texts = [f"set token={make()} here" for _ in range(200)] + ["some extraordinarilylongwords andunbelievablylongones."] * 80
        model = secrets.learn_formats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
        text = f"look at {make()}, extraordinarilylongwords."
        secret = text.split()[2].rstrip(",")
        assert secret in [text[s:e] for s, k, e, _ in model.spans(text) if k == 3], kind
        assert "extraordinarilylongwords" not in [text[s:e] for s, k, e, _ in model.spans(text)]


def test_disclosing_terms(spark):
    rng = random.Random(4)
    filler = lambda: " ".join(rng.choice(["river", "stone", "cloud", "green", "walks", "under"]) for _ in range(12))
    texts = [f"{filler()} Gardener zelda writes ann@x.org {filler()} n{i}" for i in range(5)]
    texts += [f"{filler()} nothing private n{i}" for i in range(60)] + ["copy tarzan bob@x.org"] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cleaned = {r.doc_id: r.text for r in pii.sanitise_documents(docs).collect()}
    assert all("zelda" not in cleaned[i] and "ann@x.org" not in cleaned[i] and "river" in " ".join(cleaned.values()) for i in range(5))
    assert all("tarzan" in cleaned[i] for i in range(65, 70)), "copies of one text are no evidence"
    assert all(cleaned[i] == texts[i] for i in range(5, 65))


def test_rare_entities_are_disclosed_anywhere(spark):
    rng = random.Random(14)
    filler = lambda: " ".join(rng.choice(["river", "stone", "cloud", "green", "walks", "under"]) for _ in range(40))
    texts = [f"Zelda {filler()} n{i} {filler()} zelda {filler()} ann@x.org" for i in range(2)] + [f"{filler()} n{i}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate([*texts, f"tarzan {filler()} bob@x.org"])), "doc_id long, text string")
    cleaned = {r.doc_id: r.text for r in pii.sanitise_documents(docs).collect()}
    assert all("zelda" not in cleaned[i].lower() and "ann@x.org" not in cleaned[i] and "river" in cleaned[i] for i in range(2))
    assert "tarzan" in cleaned[302] and all(cleaned[i] == texts[i] for i in range(2, 302))


@pytest.fixture(scope="module")
def toxic_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return toxicity.fit(docs, spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))


needs_tables = pytest.mark.skipif(not os.path.isdir("/root/testdata"), reason="test tables are not here")


@needs_tables
@pytest.mark.parametrize("word", ["1d10t", "i.d.i.o.t", "idiooooot", "m0r0n", "$tup1d", "c1own", "tr@sh", "i d i o t", "M-O-R-O-N"])
def test_disguises_are_read(toxic_model, word):
    assert toxic_model.score(f"the ing and {word} of") >= 0.5
    assert toxic_model.score("the ing and of 12 a b") < 0.5


@needs_tables
@pytest.mark.parametrize("word", ["iddiot", "stuupid", "$tu" + 60 * "u" + "pid", "/".join(["1d10t"] * 12)])
def test_doubled_and_long_disguises_are_read(toxic_model, word):
    assert toxic_model.score(f"the ing and {word} of") >= 0.5


def test_spaced_letters_are_read_whole():
    import numpy as np

    letters = "abcdefghijklmnopqrstuvwxyz" * 4
    assert letters in toxicity.Reader(np.zeros((27, 27, 27), np.float32)).runs(" ".join(letters))


@needs_tables
def test_held_out_accuracy(spark, toxic_model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    rows = toxicity.score_documents(docs.filter(toxicity.held_out(docs["doc_id"])), toxic_model).select("toxic", "predicted").collect()
    hit = sum(r.toxic == r.predicted == 1 for r in rows)
    assert hit >= 0.85 * sum(r.toxic for r in rows) and hit >= 0.9 * sum(r.predicted for r in rows)


def test_plain_words_without_a_weight_are_not_decoded(monkeypatch):
    import numpy as np

    model = toxicity.ToxicityModel(np.zeros((27, 27, 27), dtype=np.float32), {"hater": 0.9, "kill*": 0.5})
    read, asked = toxicity.Reader.read, []
    monkeypatch.setattr(toxicity.Reader, "read", lambda self, token: asked.append(token) or read(self, token))
    assert model.score("Some plain words, (over) and out") == 0.0
    assert asked == []
    assert model.score("some hater killing.") == pytest.approx(1 - 0.1 * 0.5)
    assert sorted(asked) == ["hater", "killing."]
