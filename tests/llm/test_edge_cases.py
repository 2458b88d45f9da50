"""Every operator on odd and on empty tables."""

import sys
from os.path import dirname

import pytest

sys.path.insert(0, dirname(__file__))

from fixtures import odd_documents  # noqa: E402
from parley.llm import dartminhash, mixing, pieces, pii, prefix_free, secrets, sentence_spans, toxicity  # noqa: E402


def labels(spark):
    return spark.createDataFrame([(1, 0), (3, 1), (9, 1), (9, 0), (5, None)], "doc_id long, toxic int")


OPERATORS = {
    "toxicity": lambda s, d: toxicity.clean_documents(d, labels(s)),
    "near duplicates": lambda s, d: dartminhash.keep_one_per_class(d),
    "sentence spans": lambda s, d: sentence_spans.remove_repeated(d),
    "secrets": lambda s, d: secrets.redact_documents(d),
    "repeated bytes": lambda s, d: prefix_free.without_repeats(d),
    "mixing": lambda s, d: mixing.mixed_documents(d),
    "pieces": lambda s, d: pieces.encode_documents(d, pieces.default_model()),
    "personal data": lambda s, d: pii.sanitise_documents(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, odd_documents(spark, [])).count() == 0


def test_toxicity(spark):
    docs = odd_documents(spark)
    assert OPERATORS["toxicity"](spark, docs).count() == docs.count()


def test_near_duplicates(spark):
    got = OPERATORS["near duplicates"](spark, odd_documents(spark))
    ids = [r.doc_id for r in got.collect()]
    # The repeated row and the copy of the long text go; texts without words and without id stay.
    assert sorted(ids, key=str) == sorted([1, 2, 3, 4, None, 5, 7, 8, 9, 10], key=str)
    assert got.columns == odd_documents(spark).columns


def test_sentence_spans(spark):
    got = {(r.doc_id, r.n_removed > 0) for r in OPERATORS["sentence spans"](spark, odd_documents(spark)).collect()}
    assert (6, True) in got and (5, False) in got and (2, False) in got
    assert {i for i, gone in got if gone} <= {5, 6}


def test_secrets(spark):
    got = {r.doc_id: r.text for r in OPERATORS["secrets"](spark, odd_documents(spark)).collect()}
    assert got[9].endswith("token=[SECRET]") and got[2] is None and got[3] == ""


def test_repeated_bytes(spark):
    docs = odd_documents(spark)
    gone = {r.node: r.n_removed for r in OPERATORS["repeated bytes"](spark, docs).collect()}
    nodes = {r.doc_id: r.node for r in docs.selectExpr("doc_id", "xxhash64(text) AS node").collect()}
    size = len(docs.filter("doc_id = 5").first().text.encode())
    assert gone[nodes[5]] == size and gone[nodes[7]] == 50_000


def test_mixing(spark):
    got = OPERATORS["mixing"](spark, odd_documents(spark))
    assert got.columns == odd_documents(spark).columns
    assert {2, 3, 4} <= {r.doc_id for r in got.collect()}
    taken = {r.doc_id: (r.size, r.epochs * r.size + r.rest) for r in mixing.mix(odd_documents(spark)).collect()}
    assert all(t <= 3 * s for s, t in taken.values()) and taken[2] == (0, 0)


def test_pieces(spark):
    processor = pieces.load_processor(pieces.default_model())
    for r in OPERATORS["pieces"](spark, odd_documents(spark)).collect():
        assert list(r.ids) == processor.encode(r.text or "") + [2]


def test_personal_data(spark):
    got = {r.doc_id: r.text for r in OPERATORS["personal data"](spark, odd_documents(spark)).collect()}
    assert got[9].startswith("mail [EMAIL] or call [PHONE],") and got[2] is None
