"""Repeated passages by sliding spans of consecutive sentences.

Every run of ``SPAN`` consecutive sentences of every text is hashed. Of each
hash the first occurrence over the corpus (smallest document id, then text
hash, then place) stays; every sentence that another occurrence covers is
removed. Spans of fewer than ``MIN_WORDS`` words do not count, so that small
talk is no repetition. A sentence ends at a full stop, question or exclamation
mark or a line's end; ones of more than ``PIECE`` words are read in pieces, so
that a passage without stops is found too. A piece ends at a word whose hash is
the least of its neighbours (``PIECE / 2`` on either side), so the borders
inside a passage do not depend on what stands around it; only at its two ends a
piece may be shared with other text and stay. Where no such word comes within
twice ``PIECE`` words, pieces of ``PIECE`` words are counted from the last border. Case and blanks do not matter.

The hashes of every text are computed once and stored. They are counted before anything is joined; only occurrences of repeated
ones are kept, and of these a document gets the list of its own places. A
common span is one row on the counted side, so the join splits its other side.

A null text gives a null; a text of fewer sentences than a span is kept whole.
Rows with equal id and text are copies of each other: one of them stays, the
others lose every sentence that lies in a span. Columns of ``docs`` named
``n_sentences`` or ``n_removed`` are replaced.
"""

from __future__ import annotations

import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import small_batches, table
from parley.staging import stage

SPAN = 3
PIECE = 12
MIN_WORDS = 12

_SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*\s*|[.!?\n]+\s*")


def borders(words: list[str], piece: int = PIECE) -> list[int]:
    """Numbers of words in front of the cuts of a long sentence, chosen by the words nearby."""
    reach = max(1, piece // 2)
    hashes = [xxhash.xxh64_intdigest(w.rstrip(".!?")) >> 1 for w in words]
    chosen, count = [], len(words)
    for i, h in enumerate(hashes):
        # Most words fall to a near neighbour. Of equal neighbours the first is a border.
        for other in hashes[i - 1 : i - reach - 1 : -1] if i > reach else hashes[:i]:
            if other <= h:
                break
        else:
            for other in hashes[i + 1 : i + reach + 1]:
                if other < h:
                    break
            else:
                chosen.append(i + 1)
    out = [0]
    for cut in [*chosen, count]:
        while cut - out[-1] > 2 * piece:
            out.append(out[-1] + piece)
        if cut > out[-1]:
            out.append(cut)
    return out[1:-1]


def sentences(text: str, piece: int = PIECE) -> list[tuple[str, list[str]]]:
    """Sentences of a text, which concatenate to it, and their words in lower case."""
    out: list[tuple[str, list[str]]] = []
    for raw in _SENTENCE.findall(text):
        words = raw.lower().split()
        if len(words) <= piece:
            out.append((raw, words))
            continue
        # Piece borders are ends of words, with the blanks behind them.
        ends = [m.end() for m in re.finditer(r"\S+\s*", raw)]
        cuts = borders(words, piece)
        at, places = [0, *cuts, len(words)], [0, *(ends[c - 1] for c in cuts), len(raw)]
        out += [(raw[places[i] : places[i + 1]], words[at[i] : at[i + 1]]) for i in range(len(cuts) + 1)]
    return out


def span_hashes(parts: list[tuple[str, list[str]]], span: int = SPAN, min_words: int = MIN_WORDS) -> list[int | None]:
    """One signed 64-bit hash per run of ``span`` sentences, null for runs of too few words."""
    hashes = [xxhash.xxh64_intdigest(" ".join(w).rstrip(".!?")) for _, w in parts]
    sizes = [len(w) for _, w in parts]
    out: list[int | None] = []
    for i in range(len(parts) - span + 1):
        if sum(sizes[i : i + span]) < min_words:
            out.append(None)
        else:
            h = xxhash.xxh64_intdigest(b"".join(x.to_bytes(8, "little") for x in hashes[i : i + span]))
            out.append(h - (1 << 64) if h >> 63 else h)
    return out


def document_spans(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS, piece: int = PIECE) -> DataFrame:
    """``_id, _hash, n_sentences, spans`` of each row with a text: the spans' hashes by place, null where they do not count."""

    @F.pandas_udf("n_sentences int, spans array<long>")
    def hashes(texts: pd.Series) -> pd.DataFrame:
        parts = [sentences(t, piece) for t in texts]
        return pd.DataFrame({"n_sentences": [len(p) for p in parts], "spans": [span_hashes(p, span, min_words) for p in parts]})

    rows = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), hashes("text").alias("s"))
    return rows.select("_id", "_hash", "s.*")


def repeated_places(spans: DataFrame) -> DataFrame:
    """``_id, _hash, _places``: for each (id, text) the spans that occur earlier elsewhere. ``spans`` is a stored table."""
    occurrences = spans.select("_id", "_hash", F.posexplode("spans").alias("place", "span")).filter(F.col("span").isNotNull())
    repeated = occurrences.groupBy("span").agg(F.count("*").alias("n")).filter("n > 1").select("span")
    kept = stage(occurrences.join(repeated, "span", "left_semi"), "sentence-spans")
    first = kept.groupBy("span").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_hash", "place")).alias("first"))
    others = kept.join(first, "span").filter(
        ~(F.col("_id").eqNullSafe(F.col("first._id")) & (F.col("_hash") == F.col("first._hash")) & (F.col("place") == F.col("first.place")))
    )
    # Copies of one row name the same places; a set per row stays within the text's length.
    return others.groupBy("_id", "_hash").agg(F.collect_set("place").alias("_places"))


def remove_repeated(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS, piece: int = PIECE) -> DataFrame:
    """``docs`` with repeated sentences removed from ``text``; adds ``n_sentences`` and ``n_removed``."""
    small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]

    @F.pandas_udf("text string, n_sentences int, n_removed int")
    def cut(texts: pd.Series, places: pd.Series, copy: pd.Series, size: pd.Series) -> pd.DataFrame:
        out = []
        for text, at, nth, n in zip(texts, places, copy, size):
            if text is None:
                out.append((None, 0, 0))
            elif at is None and nth == 1:
                out.append((text, n, 0))
            else:
                # Only texts that lose something are split again.
                parts = sentences(text, piece)
                if nth > 1:
                    at = [i for i, h in enumerate(span_hashes(parts, span, min_words)) if h is not None]
                gone = {j for i in at for j in range(i, i + span)}
                out.append(("".join(s for j, (s, _) in enumerate(parts) if j not in gone), len(parts), len(gone)))
        return pd.DataFrame(out, columns=["text", "n_sentences", "n_removed"])

    spans = stage(document_spans(docs, span, min_words, piece), "document-spans")
    sizes = spans.groupBy("_id", "_hash").agg(F.max("n_sentences").alias("_size"))
    both = [F.col(f"found.{c}").eqNullSafe(F.col(f"sizes.{c}")) for c in ("_id", "_hash")]
    found = sizes.alias("sizes").join(repeated_places(spans).alias("found"), both, "left").select("sizes._id", "sizes._hash", "_size", "_places")
    keyed = docs.select(*names).withColumn("_hash", F.xxhash64("text"))
    joined = keyed.join(found, keyed["doc_id"].eqNullSafe(found["_id"]) & (keyed["_hash"] == found["_hash"]), "left").drop(found["_hash"]).drop("_id")
    nth = F.row_number().over(Window.partitionBy("doc_id", "_hash").orderBy(F.lit(0)))
    done = joined.withColumn("_cut", cut("text", "_places", nth, F.coalesce("_size", F.lit(0))))
    return done.select(*[F.col("_cut.text").alias("text") if c == "text" else F.col(c) for c in names], "_cut.n_sentences", "_cut.n_removed")


def op4_sentence_spans(spark, sf_dir):
    """Every document without its repeated sentences."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated(docs).select("doc_id", "n_sentences", "n_removed", "text")
