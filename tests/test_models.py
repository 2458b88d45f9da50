"""Dialogs and utterances against sequential models on random conversations."""

import pytest

import models
import random_events as gen
from parley.operators import dialogs as d
from parley.operators import ordered
from parley.operators import utterances as u


@pytest.mark.parametrize("keep_bounced", [False, True])
def test_dialogs(spark, keep_bounced):
    rows = gen.conversations(seed=7 + keep_bounced, count=1500, max_size=24, utterances=False)
    expected = {
        (*key, *dialog) for key, part in gen.grouped(rows).items() for dialog in models.dialogs(part, keep_bounced)
    }
    out = d.segment_dialogs(d.in_scope(gen.frame(spark, rows)), keep_bounced=keep_bounced)
    got = {
        (r.event_date, r.conversation_id, r.dialog, r.start_time, r.end_time, r.abandoned_left, r.cancelled, r.failed, r.agent)
        for r in out.collect()
    }
    assert len(expected) > 1000
    assert got == expected


@pytest.mark.parametrize("block_bits, sticky", [(14, False), (14, True), (2, False), (2, True)])
def test_utterances(spark, monkeypatch, block_bits, sticky):
    """With two bits, runs of more than four utterances take the way of long runs."""
    monkeypatch.setattr(ordered, "BLOCK_BITS", block_bits)
    rows = gen.conversations(seed=11, count=500, max_size=90, utterances=True, sticky=sticky)
    expected = sorted(
        (tuple(map(str, t)) for part in gen.grouped(rows).values() for t in models.utterances(part))
    )
    events = d.in_scope(gen.frame(spark, rows))
    numbered = u.prepared_utterances(events)
    longest = numbered.groupBy(*u.RUN).count().agg({"count": "max"}).head()[0]
    assert longest > (12 if sticky else 4)
    out = u.score_utterances(events)
    assert len(expected) > 1000
    assert sorted(tuple(map(str, r)) for r in out.collect()) == expected
