"""SimHash near-duplicates by anchor-point covering.

A text's fingerprint has 64 bits: bit i is 1 if more than half of the hashes
(XXH64, seed 42) of its three-word shingles have it. Two fingerprints link at
``THRESHOLD`` (3) or fewer differing bits; documents with equal fingerprints
are linked too. The class of a document is its component of links.

*Anchors.* The 64 bits are cut into blocks of 23, 23, 15 and 3 bits, each with
a perfect code (Golay, Golay, Hamming, repetition) of radius 3, 3, 1 and 1. The
anchors are the 2**36 products of code words; they cover every fingerprint
within radius 8, and block by block the nearest one, its *home*, is unique.

*Replicas.* Flipping a bit moves a home or not. A fingerprint goes to every anchor
that is the home of a word within two flips of it (about 190, all within the
radius plus two), and is marked ``near`` at those within one flip (about 19). Of
two fingerprints with at most three differing bits, some word is within one flip
of the first and two of the second: at its home they meet, the first near. So
no link is lost, and neither side goes to all anchors within radius plus
three, which would be several thousand.

*Comparison.* Anchors with a near member and another one are compared, near
members with all others; of the links of an anchor a spanning forest goes on, so
a group of many near copies gives rows in proportion to its members. Anchors
with more than ``CHUNK`` members are compared chunk by chunk, two by two.
Links are joined to components by star steps.

Edge cases: null and empty texts, and texts without words, have fingerprint
zero and are linked like any other; fewer than three words are one shingle.
Repeated rows and repeated ids are rows of their own. A null id is no smallest
id; a class of null ids has a null id. Other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import small_batches, table
from parley.llm.components import components
from parley.staging import stage

SHINGLE = 3
SEED = 42
THRESHOLD = 3
#: Flips within which a fingerprint is near an anchor's cell; the others of the threshold are the partner's.
NEAR = 1
#: Members of one anchor that are compared at once.
CHUNK = 1024
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a text."""
    words = (text or "").encode().lower().split()  # of bytes: ASCII letters and ASCII whitespace only
    if not words:
        return 0
    starts, at = [], 0
    for word in words:
        starts.append(at)
        at += len(word) + 1
    joined = b" ".join(words)
    ends = [s - 1 for s in starts[shingle:]] + [len(joined)]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for first in range(0, len(ends), COUNTED):
        pairs = zip(starts[first : first + COUNTED], ends[first : first + COUNTED])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(ends)).tolist())


def fingerprint_of(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint as a (signed) long."""

    @F.pandas_udf("long")
    def digest(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return digest(text)


class PerfectCode:
    """A perfect code of ``length`` bits, given by the syndromes of its single bits."""

    def __init__(self, syndromes: list[int], radius: int, shift: int):
        self.length, self.shift = len(syndromes), shift
        self.syndromes = syndromes
        errors = {0: 0}
        layer = {0: 0}
        self.layers = [dict(layer)]
        for _ in range(max(radius, THRESHOLD)):
            layer = {e | 1 << i: s ^ syndromes[i] for e, s in layer.items() for i in range(e.bit_length(), self.length)}
            self.layers.append(layer)
            if len(self.layers) <= radius + 1:
                errors.update({s: e for e, s in layer.items()})
        self.leader = errors
        assert len(errors) == 1 << max(s.bit_length() for s in syndromes), "the code is not perfect"
        self._moves: dict[int, list[np.ndarray]] = {}

    def syndrome(self, word: int) -> int:
        out = 0
        while word:
            low = word & -word
            out ^= self.syndromes[low.bit_length() - 1]
            word ^= low
        return out

    def moves(self, word: int) -> list[np.ndarray]:
        """By number of flips needed (0, 1, 2): differences between the word and the homes so reached."""
        s = self.syndrome(word)
        if s not in self._moves:
            seen: set[int] = set()
            found = []
            for layer in self.layers[:3]:
                new = {e ^ self.leader[s ^ t] for e, t in layer.items()} - seen
                seen |= new
                found.append(np.array(sorted(new), np.uint64) << np.uint64(self.shift))
            self._moves[s] = found
        return self._moves[s]


def _golay() -> list[int]:
    """Remainders of the powers of x by the generator of the binary Golay code."""
    generator, out, power = 0b101011100011, [], 1
    for _ in range(23):
        out.append(power)
        power <<= 1
        if power >> 11:
            power ^= generator
    return out


def perfect_blocks() -> list[PerfectCode]:
    return [
        PerfectCode(_golay(), 3, 0), PerfectCode(_golay(), 3, 23),
        PerfectCode(list(range(1, 16)), 1, 46), PerfectCode([1, 2, 3], 1, 61),
    ]


def anchors_of(word: int, blocks: list[PerfectCode]) -> tuple[np.ndarray, np.ndarray]:
    """The anchors within one flip of a fingerprint, and the further ones within two."""
    moves = [b.moves(word >> b.shift & ((1 << b.length) - 1)) for b in blocks]
    home = np.uint64(word)
    for still, _, _ in moves:
        home ^= still[0]
    # Moves of a block relative to its own home.
    ones = [one ^ still[0] for still, one, _ in moves]
    twos = [two ^ still[0] for still, _, two in moves]
    near = np.concatenate([[home], *[home ^ x for x in ones]]).astype(np.uint64)
    pairs = [(home ^ ones[i][:, None] ^ ones[j]).ravel() for i in range(len(ones)) for j in range(i)]
    return near, np.concatenate([*[home ^ x for x in twos], *pairs]).astype(np.uint64)


def replicas(fingerprints: DataFrame) -> DataFrame:
    """``anchor, fp, near`` for each anchor of each row of ``fp``."""

    def send(batches):
        blocks = perfect_blocks()
        for batch in batches:
            for first in range(0, len(batch), 256):
                words = batch["fp"].to_numpy(np.int64)[first : first + 256]
                found = [anchors_of(int(w), blocks) for w in words.view(np.uint64)]
                sizes = np.array([(len(a), len(b)) for a, b in found], np.int64).reshape(-1, 2)
                yield pd.DataFrame({
                    "anchor": np.concatenate([x for pair in found for x in pair]).view(np.int64),
                    "fp": np.repeat(words, sizes.sum(axis=1)),
                    "near": np.repeat(np.tile([True, False], len(words)), sizes.ravel()),
                })

    return fingerprints.mapInPandas(send, "anchor long, fp long, near boolean")


def spanning_links(fps: np.ndarray, near: np.ndarray, threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """A spanning forest of the links between near members and all members of one anchor."""
    words = fps.view(np.uint64)
    linked = np.bitwise_count(words[:, None] ^ words) <= threshold
    linked &= near[:, None] | near
    np.fill_diagonal(linked, False)
    waiting, out = linked.any(axis=1), []
    while waiting.any():
        front = [int(waiting.argmax())]
        waiting[front] = False
        while front:
            at = front.pop()
            new = np.flatnonzero(linked[at] & waiting)
            waiting[new] = False
            front += new.tolist()
            out += [(int(fps[at]), int(fps[i])) for i in new]
    return out


def links(fingerprints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``u, v``: links among the distinct ``fp`` that span the same components as all links do."""
    if threshold > THRESHOLD:
        raise ValueError(f"the anchors are laid out for {THRESHOLD} differing bits at most")
    anchor = Window.partitionBy("anchor")
    members = replicas(fingerprints).withColumns({
        "members": F.count("*").over(anchor), "live": F.max("near").over(anchor), "place": F.row_number().over(anchor.orderBy("fp")) - 1,
    }).filter("members > 1 AND live")
    chunks = F.ceil(F.col("members") / CHUNK).cast("int")
    own = F.floor(F.col("place") / CHUNK).cast("int")
    cells = (
        members.select("anchor", "fp", "near", own.alias("own"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
        .select("anchor", "fp", "near", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )

    def compare(batches):
        kept = None
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            keys = rows[["anchor", "i", "j"]].to_numpy()
            borders = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            kept = rows.iloc[borders[-1] if len(borders) else 0 :]
            yield _forest(rows, borders)
        if kept is not None:
            yield _forest(kept, np.array([len(kept)]))

    def _forest(rows, borders):
        fps, near, out, first = rows["fp"].to_numpy(np.int64), rows["near"].to_numpy(bool), [], 0
        for last in borders.tolist():
            if near[first:last].any():
                out += spanning_links(fps[first:last], near[first:last], threshold)
            first = last
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    found = cells.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j").mapInPandas(compare, "u long, v long")
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def classed(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs`` (``doc_id, text``)."""
    small_batches(docs.sparkSession)
    marked = stage(docs.select("doc_id", fingerprint_of(F.col("text")).alias("fp")), "simhash")
    ids = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = stage(links(ids.select("fp"), threshold), "simhash-links")
    roots = components(found).toDF("fp", "root")
    placed = ids.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(placed.select("fp", "root").join(least, "root"), "fp").select("doc_id", "fp", "component_id")


def op11_simhash_anchors(spark, sf_dir):
    """Fingerprint and class of every document."""
    found = classed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
