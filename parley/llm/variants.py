"""Spelling variants by Bloom-guided neighbourhoods.

Words are the maximal runs of Latin letters of all texts, A-Z lower-cased, one
letter deleted where the checksum of document and run says so. The vocabulary
holds words of at least ``LETTERS`` letters and ``COUNT`` occurrences. Two words are near
if one inserted, deleted or replaced letter turns one into the other.

1. *Counting.* Tasks count words and hand on sums; nothing grows with a text or a hot word.
2. *Filters.* The vocabulary's words go into blocked Bloom filters, sharded by length and, beyond ``SHARD_WORDS``
   words of one length, by hash: 64-bit blocks, 16 bits and five probes a word. Tasks fill 4-KB pages, which are merged
   by page and sent out one shard at a time, at most 16 MB each, however large the vocabulary grows.
3. *Edits.* A word probes the shard of its length with every replaced letter that makes it greater, and the
   shard one letter shorter with every deletion. Other neighbours, insertions among them, are found from the
   other word. Only letters that occur at all replace others. An edit's hash follows from the word's in constant time.
4. *Exact join.* Edits that a filter lets pass are joined to the vocabulary, which removes the false ones.
   No link is lost, since a Bloom filter has no false negatives.
5. A word's *form* is its near word of largest count (ties: first in code-point order) if that is at least twice
   the word's own. Counts double along forms, so pointer doubling reaches the *root* in a few joins.

Edge cases: a null text has no words, a null id counts as an empty text in the checksum. Repeated rows count. Words
of any length take part; those of more than ``LONG`` letters share one shard. Empty tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import sized_batches, table
from parley.staging import stage

LETTERS = 5
COUNT = 3
#: Distinct words a task counts before it hands them on.
HELD_WORDS = 200_000
#: Lengths from here on share a shard.
LONG = 40
#: Words of one shard: 16 MB of filter at most.
SHARD_WORDS = 1 << 23
BITS_A_WORD = 16
PROBES = 5
#: Edits generated at once.
EDITS = 1 << 19

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_PAGE_BYTES = 4096
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def noisy_words(doc_id: int | None, text: str | None) -> list[str]:
    """The runs of a text, lower-cased, one letter deleted in about one of 97."""
    runs = _RUN.findall(text or "")
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    known: dict[str, str] = {}
    out = []
    for run in runs:
        word = known.get(run)
        if word is None:
            raw = run.encode().lower()  # of bytes: only A-Z
            word, h = raw.decode(), zlib.crc32(raw, prefix)
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            known[run] = word
        out.append(word)
    return out


def vocabulary(docs: DataFrame, letters: int = LETTERS, count: int = COUNT) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    sized_batches(docs.sparkSession)

    def tally(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"]):
                held.update(noisy_words(None if doc_id == "" else doc_id, text))
            if len(held) > HELD_WORDS:
                yield pd.DataFrame([x for x in held.items() if len(x[0]) >= letters], columns=["word", "n"])
                held.clear()
        yield pd.DataFrame([x for x in held.items() if len(x[0]) >= letters], columns=["word", "n"])

    # As text, because pandas has no null among whole numbers.
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text").mapInPandas(tally, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count)


def letters_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def _powers(length: int) -> np.ndarray:
    out = np.full(length, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashes(points: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row, not mixed."""
    return (points * _powers(points.shape[1])).sum(axis=1, dtype=np.uint64)


def blocks_for(words: int) -> int:
    """Blocks of a shard: a power of two of whole pages, 16 bits a word or more."""
    need = max(_PAGE_BYTES // 8, words * BITS_A_WORD // 64)
    return 1 << (need - 1).bit_length()


def probes(h: np.ndarray, parts: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard part, block and mask of each hash."""
    m = _mixed(h)
    mask = np.zeros(len(m), np.uint64)
    for i in range(PROBES):
        mask |= np.uint64(1) << (m >> np.uint64(6 * i) & np.uint64(63))
    at = (m >> np.uint64(30)) & np.uint64(blocks - 1)
    part = _mixed(m + np.uint64(1)) % np.uint64(parts)
    return part, at, mask


def shard_of(length: int) -> int:
    return min(length, LONG)


def filter_pages(words: DataFrame, layout: dict[int, tuple[int, int]]) -> DataFrame:
    """``shard, part, page, bits``: the filters of a vocabulary in pages, merged over all tasks."""

    def fill(batches):
        for batch in batches:
            by_length = batch.groupby(batch["word"].str.len())["word"]
            for length, own in by_length:
                parts, blocks = layout[shard_of(length)]
                part, at, mask = probes(hashes(letters_of(own.tolist())), parts, blocks)
                place = part * np.uint64(blocks) + at
                used, index = np.unique(place // np.uint64(_PAGE_BYTES // 8), return_inverse=True)
                pages = np.zeros((len(used), _PAGE_BYTES // 8), np.uint64)
                np.bitwise_or.at(pages, (index, (place % np.uint64(_PAGE_BYTES // 8)).astype(np.int64)), mask)
                each = blocks // (_PAGE_BYTES // 8)
                yield pd.DataFrame({"shard": shard_of(length), "part": (used // each).astype(np.int32), "page": (used % each).astype(np.int32), "bits": [p.tobytes() for p in pages]})

    ordered = words.select("word", F.least(F.char_length("word"), F.lit(LONG)).alias("_l")).repartition("_l", F.pmod(F.xxhash64("word"), F.lit(64))).select("word")
    pages = ordered.mapInPandas(fill, "shard int, part int, page int, bits binary")
    return pages.groupBy("shard", "part", "page").agg(F.bitmap_or_agg("bits").alias("bits"))


def _edits(points: np.ndarray, alphabet: np.ndarray, deleted: bool):
    """Blocks of (row, place, letter, hash) of the edits of words of one length; letter 0 is a deletion."""
    count, length = points.shape
    powers, whole = _powers(length), hashes(points)
    if deleted:
        step = max(1, EDITS // length)
        for first in range(0, count, step):
            own = points[first : first + step]
            terms = own * powers
            before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
            after = whole[first : first + step, None] - before - terms
            shorter = before + after * np.uint64(_INVERSE)
            # Of a run of equal letters, deleting the first gives the same word as any other.
            keep = np.c_[np.ones(len(own), bool), own[:, 1:] != own[:, :-1]]
            row, place = np.nonzero(keep)
            yield row + first, place, np.zeros(len(row), np.uint64), shorter[keep]
        return
    step, wide = max(1, EDITS // (length * len(alphabet))), max(1, EDITS // len(alphabet))
    for first in range(0, count, step):
        own = points[first : first + step]
        for left in range(0, length, wide):
            here = own[:, left : left + wide]
            keep = alphabet > here[:, :, None]
            change = (alphabet - here[:, :, None]) * powers[None, left : left + wide, None]
            row, place, letter = np.nonzero(keep)
            yield row + first, place + left, alphabet[letter], (whole[first : first + step][:, None, None] + change)[keep]


def guided_edits(words: DataFrame, bits, shard: int, part: int, parts: int, blocks: int, alphabet: np.ndarray, deleted: bool) -> DataFrame:
    """``word, near``: edits of words that one shard's filter lets pass."""

    def probe(batches):
        letters = alphabet.astype(np.uint64)
        for batch in batches:
            for length, own in batch.groupby(batch["word"].str.len())["word"]:
                if shard_of(length - deleted) != shard:
                    continue
                own = own.tolist()
                found: list[tuple[str, str]] = []
                for row, place, letter, h in _edits(letters_of(own), letters, deleted):
                    mine, at, mask = probes(h, parts, blocks)
                    hit = np.flatnonzero((mine == part) & (bits.value[at] & mask == mask))
                    for r, p, c in zip(row[hit].tolist(), place[hit].tolist(), letter[hit].tolist()):
                        word = own[r]
                        found.append((word, word[:p] + (chr(c) if c else "") + word[p + 1 :]))
                yield pd.DataFrame(found, columns=["word", "near"], dtype=object)

    return words.mapInPandas(probe, "word string, near string")


def near_pairs(vocab: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: every pair of near words of a vocabulary, once."""
    spark = vocab.sparkSession
    sized_batches(spark)
    length = F.char_length("word")
    sizes = {r.shard: r.words for r in vocab.groupBy(F.least(length, F.lit(LONG)).alias("shard")).agg(F.count("*").alias("words")).collect()}
    # At most 256 letters: the runs hold no others.
    used = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter("c <> ''").distinct().collect()
    alphabet = np.array(sorted(ord(r.c) for r in used), np.uint32)
    layout = {}
    for shard, words in sizes.items():
        parts = -(-words // SHARD_WORDS)
        layout[shard] = (parts, blocks_for(-(-words // parts)))
    pages = stage(filter_pages(vocab, layout), "variant-filters")
    # Ordered by length, so that a shard's scan skips the other lengths by their statistics.
    ordered = stage(vocab.select("word", length.alias("length")).repartitionByRange("length", "word"), "variant-lengths")
    hits = None
    for shard, (parts, blocks) in sorted(layout.items()):
        for part in range(parts):
            own = np.zeros((blocks * 8 // _PAGE_BYTES, _PAGE_BYTES), np.uint8)
            for page, bits in pages.filter((F.col("shard") == shard) & (F.col("part") == part)).select("page", "bits").toLocalIterator():
                own[page] = np.frombuffer(bits, np.uint8)
            sent = spark.sparkContext.broadcast(own.ravel().view(np.uint64))
            for deleted in (False, True):
                lengths = F.col("length") == shard + int(deleted) if shard < LONG else F.col("length") >= shard + int(deleted)
                reach = guided_edits(ordered.filter(lengths).select("word"), sent, shard, part, parts, blocks, alphabet, deleted)
                hits = reach if hits is None else hits.union(reach)
    if hits is None:
        return vocab.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).filter("false")
    return hits.join(vocab.toDF("near", "near_n"), "near").join(vocab, "word").select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form, by pointer doubling."""
    reach = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = reach.toDF("root", "next")
        reach = stage(reach.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        if reach.filter("moved").isEmpty():
            return reach.drop("moved")
        reach = reach.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the vocabulary of ``docs`` (``doc_id, text``)."""
    vocab = stage(vocabulary(docs.select("doc_id", "text")), "variant-words")
    pairs = stage(near_pairs(vocab), "variant-pairs")
    both = pairs.union(pairs.select("near", "near_n", "word", "n"))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    form_n = -F.col("best.less")
    strong = form_n >= 2 * F.col("n")
    found = stage(best.select("word", "n_near", F.when(strong, F.col("best.near")).alias("form"), F.when(strong, form_n).alias("form_n")), "variant-forms")
    ends = roots(found.filter(F.col("form").isNotNull()))
    return vocab.join(found, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op13_spelling_variants(spark, sf_dir):
    """Form and root of every word."""
    return variants(table(spark, sf_dir, "documents"))
