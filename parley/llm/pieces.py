"""SentencePiece encoding through a table of distinct chunks.

The marker of the library (U+2581, one per blank, one in front of the text)
splits a text into *chunks*: a run of markers and the characters up to the
next marker. If no piece has a marker behind another character, no piece and
no merge crosses a chunk's border, so a chunk's ids do not depend on its
neighbours. Each task keeps a table of the distinct chunks it has met, encodes
every new one once with the library, and joins the ids back by position.

The table lives in a task, not in the cluster: a shuffled table of chunks
would move every chunk occurrence of the corpus twice to save work that a task
saves by itself. It is emptied at ``TABLE_CHUNKS`` entries.

A null text counts as empty; an empty text gives only the end id. Texts are
never shortened. Models that normalise text or whose pieces cross markers are
refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import small_batches, table

MARKER = "▁"
TABLE_CHUNKS = 60_000
_CHUNK = re.compile(" ([ ]*[^ ]*)")


def splits_at_markers(processor) -> bool:
    """Whether pieces never cross a chunk's border and text is taken as it is."""
    pieces = (processor.id_to_piece(i) for i in range(processor.vocab_size()))
    if any(MARKER in piece.lstrip(MARKER) for piece in pieces):
        return False
    probe = " a  b ﬁ\tc\n  "  # a normaliser would change blanks, tabs or the ligature
    return processor.decode(processor.encode(probe)) == probe


@lru_cache(maxsize=4)
def load_processor(model_path: str):
    """The library's processor, once per Python worker."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
    if not splits_at_markers(processor):
        raise ValueError(f"{model_path}: pieces cross whitespace markers")
    return processor


def chunks_of(text: str) -> list[str]:
    """The chunks of a text, each without its first marker, which the library adds itself."""
    if MARKER in text:
        text = text.replace(MARKER, " ")
    if "  " not in text and not text.startswith(" ") and not text.endswith(" "):
        return text.split(" ")
    return _CHUNK.findall(f" {text}")


class ChunkTable:
    """Ids of the distinct chunks met so far."""

    def __init__(self, processor):
        self.processor = processor
        self.ids: dict[str, list[int]] = {}

    def add(self, chunks: Iterable[str]) -> None:
        new = [c for c in chunks if c not in self.ids]
        self.ids.update(zip(new, self.processor.encode(new, num_threads=1)))
        # An empty rest is a lone marker; the library encodes an empty text to nothing.
        if "" in self.ids:
            self.ids[""] = [self.processor.piece_to_id(MARKER)]

    def encode(self, texts: list[str], end: list[int]) -> list[list[int]]:
        if len(self.ids) > TABLE_CHUNKS:
            self.ids.clear()
        split = [chunks_of(t) if t else [] for t in texts]
        self.add(set(chain.from_iterable(split)))
        get = self.ids.__getitem__
        return [list(chain(chain.from_iterable(map(get, chunks)), end)) for chunks in split]


@lru_cache(maxsize=4)
def _table_of(model_path: str) -> ChunkTable:
    return ChunkTable(load_processor(model_path))


def encode_ids(text: Column, model_path: str, end_id: bool = True) -> Column:
    """Ids of a text: array of int."""

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        chunks = _table_of(model_path)
        end = [chunks.processor.eos_id()] if end_id else []
        return pd.Series(chunks.encode(texts.tolist(), end), dtype=object)

    return encode(F.coalesce(text, F.lit("")))


def decode_ids(ids: Column, model_path: str) -> Column:
    """Text of an array of ids, by the library."""

    @F.pandas_udf("string")
    def decode(rows: pd.Series) -> pd.Series:
        processor = load_processor(model_path)
        return pd.Series([processor.decode(list(map(int, r))) for r in rows], dtype=object)

    return decode(ids)


def encode_documents(docs: DataFrame, model_path: str, end_id: bool = True) -> DataFrame:
    """``docs`` with ``ids``; a column of that name is replaced."""
    small_batches(docs.sparkSession)
    return docs.withColumn("ids", encode_ids(F.col("text"), model_path, end_id))


def round_trip_digests(ids: Column, model_path: str) -> Column:
    """``n_tokens, ids_sha256, decoded_sha256`` of an array of ids."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(rows: pd.Series) -> pd.DataFrame:
        processor = load_processor(model_path)
        out = []
        for row in rows:
            row = row if isinstance(row, list) else row.tolist()
            joined = " ".join(map(str, row))
            out.append((len(row), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(processor.decode(row).encode()).hexdigest()))
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest(ids)


def default_model() -> str:
    """The public 32k piece model that the installed vocabulary package brings."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_sentencepiece(spark, sf_dir, model_path: str | None = None):
    """Ids of every whole text and their decoding, as digests."""
    model_path = model_path or default_model()
    encoded = encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), model_path)
    return encoded.select("doc_id", round_trip_digests(F.col("ids"), model_path).alias("d")).select("doc_id", "d.*")
