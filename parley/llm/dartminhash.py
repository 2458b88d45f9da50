"""Near-duplicate documents by weighted minwise hashing with darts.

A document is a weighted set: its runs of ``SHINGLE`` words, weighted by one
plus the logarithm of how often each occurs (a line that fills a page by
repetition does not make two pages alike). Every element owns a region (its hash x its weight) on which
darts fall as a Poisson process whose darts follow from the element's hash
alone; each dart has a height inside the region, a coordinate and an arrival
rank. A dart counts if its height lies below the element's weight. Of each
coordinate the earliest counting dart is kept. Two documents keep the same dart
with a probability equal to their weighted Jaccard similarity. Darts are thrown
only until every coordinate has one, about ``k log k`` per document.

Bands of coordinates are joined. A bucket is not expanded into pairs: its
members' signatures are packed into chunks of at most about ``CHUNK``, and a
task finds a maximum spanning forest of a chunk by the estimated similarity,
without pairs whose estimate lies more than ``MARGIN`` below the threshold.
The chunks of a larger bucket are spanned two by two; the comparisons in
such a bucket grow with the square of its size, in blocks of bounded memory.

The components of the forests are groups: every two members of a bucket whose
estimate is not below that floor are in the same one. A group's texts go to one
task, which tests its pairs on the texts themselves, unless their estimate is
below the floor or links found before have joined them. Links are pairs with a
weighted Jaccard similarity of ``THRESHOLD`` or more, classes their connected
components; a task returns a forest of them, a row per member at most, never
the pairs. A group of more than ``CHUNK`` texts (or ``CHUNK_BYTES``) is dealt
to chunks, tested two by two: where nearly alike texts are no links, the tests
grow with the square of their number, in blocks of bounded memory, and each
text goes to as many blocks as there are other chunks.

Equal texts are one node throughout (a 64-bit hash of the text), so copies
cost one signature row each and no pairs. A text without words (null, blank)
is a class of its own. A text of fewer than five words is one element.
Repeated ids are rows of their own. The columns read are ``doc_id`` and
``text``; others do not matter. An empty table has no classes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import kept_aside, partitions, small_batches, table
from parley.llm.components import components
from parley.staging import stage

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 6
#: Estimates this far below the threshold (about four standard errors) are still verified.
MARGIN = 0.13
#: Signatures of a bucket in one chunk; a task holds two.
CHUNK = 1024
#: Bytes of text of a group in one chunk.
CHUNK_BYTES = 4 << 20
#: Elements of the documents signed at once, and their darts thrown at once.
ELEMENTS = 50_000
DARTS = 1 << 15

#: Bytes of letters, digits and underscores stay; bytes of other characters (beyond ASCII, see ``_words``) too.
_WORD_BYTES = bytes(c if c > 127 or chr(c).isalnum() or c == 95 else 32 for c in range(256))
_U = np.uint64


def _words(text: str) -> list[bytes]:
    """The lower-case words of a text (maximal runs of ``\\w``) in UTF-8."""
    text = text.lower()
    if not text.isascii():
        for sign in set(text):
            if sign > "\x7f" and not sign.isalnum():
                text = text.replace(sign, " ")
    return text.encode().translate(_WORD_BYTES).split()


def _mix(x: np.ndarray) -> np.ndarray:
    high = x >> _U(30)
    x = x ^ high
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, _U(27), out=high)
    x *= _U(0x94D049BB133111EB)
    x ^= np.right_shift(x, _U(31), out=high)
    return x


def elements(text: str, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word runs of a text and their weights, 1 + log2 of how often they occur."""
    words = _words(text)
    if not words:
        return np.empty(0, np.uint64), np.empty(0)
    ids = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)
    n = max(1, len(ids) - shingle + 1)
    runs = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(shingle, len(ids))):
            runs = runs * _U(0x9E3779B97F4A7C15) + ids[i : i + n]
        runs = _mix(runs + _U(len(ids) if len(ids) < shingle else shingle))
    distinct, counts = np.unique(runs, return_counts=True)
    return distinct, 1.0 + np.log2(counts)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minima over sum of maxima of two weighted sets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = float(np.minimum(a[1][i], b[1][j]).sum())
    return common / max(1e-12, float(a[1].sum() + b[1].sum()) - common)


def _fly(seed: np.ndarray, base: np.ndarray, limit: np.ndarray, k: int, first: np.ndarray, kept: np.ndarray, region: tuple | None = None) -> None:
    """Throw the darts of regions that arrive before ``limit`` and keep the earliest of each coordinate (``base`` + its number).

    ``region`` is the regions' element weight, least height and width; without it all are from 0 to 1 and every dart counts.
    """
    rank, thrown = np.zeros(len(seed)), 0
    while len(seed):
        # Several darts of each region at a time, so that few regions with many darts do not take many steps.
        several = max(1, min(32, DARTS // len(seed)))
        steps = np.array([((thrown + i) * 0x9E3779B97F4A7C15) & (2**64 - 1) for i in range(1, several + 1)], np.uint64)
        thrown += several
        darts = _mix(seed[:, None] + steps)
        ranks = (darts >> _U(11)).astype(float)
        ranks += 1
        ranks *= 2.0**-53
        np.negative(np.log(ranks, out=ranks), out=ranks)
        if region is not None:
            ranks /= region[2][:, None]
        ranks[:, 0] += rank
        np.cumsum(ranks, axis=1, out=ranks)
        here = np.flatnonzero(ranks < limit[:, None])
        row, dart, at = here // several, darts.ravel()[here], ranks.ravel()[here]
        place = _mix(dart ^ _U(0xA0761D6478BD642F))
        if region is not None:
            weight, low, width = (x[row] for x in region)
            hit = low + width * ((place & _U(0xFFFFFFFF)).astype(float) * 2.0**-32) < weight
            row, dart, at, place = row[hit], dart[hit], at[hit], place[hit]
        slot = base[row] + ((place >> _U(32)) % _U(k)).astype(np.int64)
        np.minimum.at(first, slot, at)
        best = first[slot] == at
        kept[slot[best]] = dart[best] | _U(1)
        on = np.flatnonzero(ranks[:, -1] < limit)
        rank, seed, base, limit = ranks[on, -1], seed[on], base[on], limit[on]
        if region is not None:
            region = tuple(x[on] for x in region)


def _throw(sets: list[tuple[np.ndarray, np.ndarray]], k: int, reach: np.ndarray) -> np.ndarray:
    """Kept dart of each document and coordinate, 0 where none arrived before ``reach`` (one per document)."""
    doc = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
    element = np.concatenate([e for e, _ in sets])
    weight = np.concatenate([w for _, w in sets]).astype(float)
    first = np.full(len(sets) * k, np.inf)
    kept = np.zeros(len(sets) * k, np.uint64)
    # Regions: heights [0, 1), [1, 2), [2, 4), [4, 8) ... as far as the weight reaches. Most elements weigh 1 and have the first only.
    base, limit = doc * k, reach[doc]
    light = weight < 1
    if light.any():
        at = np.flatnonzero(light)
        _fly(_mix(element[at]), base[at], limit[at], k, first, kept, (weight[at], np.zeros(len(at)), np.ones(len(at))))
    at = np.flatnonzero(~light)
    _fly(_mix(element[at]), base[at], limit[at], k, first, kept)
    at = np.flatnonzero(weight > 1)
    cells = np.ceil(np.log2(weight[at])).astype(int)
    cell = 1 + np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
    at = np.repeat(at, cells)
    low = 2.0 ** (cell - 1)
    with np.errstate(over="ignore"):
        seed = _mix(element[at] + cell.astype(np.uint64) * _U(0xD1B54A32D192ED03))
    _fly(seed, base[at], limit[at], k, first, kept, (weight[at], low, low))
    return kept.reshape(len(sets), k)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """Matrix of kept darts, a row per weighted set (none empty)."""
    total = np.array([w.sum() for _, w in sets], float)
    reach = k * (math.log(k) + 2) / total
    out = _throw(sets, k, reach)
    while len(open_rows := np.flatnonzero((out == 0).any(axis=1))):
        reach[open_rows] *= 2
        out[open_rows] = _throw([sets[i] for i in open_rows], k, reach[open_rows])
    return out


_SIGNED = "bands array<long>, marks binary"


def sign(texts: pd.Series, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> pd.DataFrame:
    """Band keys and one byte per coordinate of each text; nulls for texts without words."""
    out: list[tuple] = [(None, None)] * len(texts)
    todo: list[tuple[int, tuple]] = []
    powers = _mix(np.arange(1, rows + 1, dtype=np.uint64)) | _U(1)

    def flush():
        if not todo:
            return
        kept = signatures([s for _, s in todo], bands * rows)
        marks = (kept >> _U(20)).astype(np.uint8)
        with np.errstate(over="ignore"):
            keys = (kept.reshape(len(todo), bands, rows) * powers).sum(axis=2, dtype=np.uint64)
            keys = _mix(keys + np.arange(bands, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)).view(np.int64)
        for (i, _), key, mark in zip(todo, keys, marks):
            out[i] = (key, mark.tobytes())
        todo.clear()

    held = 0
    for i, text in enumerate(texts):
        found = elements(text or "", shingle)
        if len(found[0]):
            todo.append((i, found))
            held += len(found[0])
        if held > ELEMENTS:
            flush()
            held = 0
    flush()
    return pd.DataFrame(out, columns=["bands", "marks"])


def signed_nodes(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """``node, size, bands, marks``: one row per different text that has words; the size is in bytes."""
    small_batches(docs.sparkSession, 256)
    signer = F.pandas_udf(lambda texts: sign(texts, bands, rows, shingle), _SIGNED)
    size = F.octet_length("text").cast("long").alias("size")
    signed = docs.select(F.xxhash64("text").alias("node"), size, signer(F.coalesce("text", F.lit(""))).alias("s"))
    return signed.select("node", "size", "s.*").filter(F.col("marks").isNotNull()).dropDuplicates(["node"])


def _share_equal(marks: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Share of the marks of each row that equal those of ``one``."""
    equal = marks == one
    k = equal.shape[1]
    if k % 8 or k > 255 or not len(equal):
        return equal.mean(axis=1)
    # Eight flags are added at once; the bytes of the sum are added by a product.
    eights = np.ascontiguousarray(equal).view(np.uint64).sum(axis=1, dtype=np.uint64)
    return ((eights * _U(0x0101010101010101)) >> _U(56)) / k


def spanning_pairs(marks: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of a maximum spanning forest by the share of equal marks, none below ``floor``.

    Such a forest joins whatever all pairs with an estimate above any threshold would join. One row is compared at a time.
    """
    n = len(marks)
    best, nearest, waiting = np.full(n, -1.0), np.zeros(n, np.int64), np.ones(n, bool)
    current, left, right = 0, [], []
    for _ in range(n - 1):
        waiting[current] = False
        alike = _share_equal(marks, marks[current])
        closer = waiting & (alike > best)
        best[closer], nearest[closer] = alike[closer], current
        current = int(np.where(waiting, best, -2.0).argmax())
        if best[current] >= floor:
            left.append(nearest[current])
            right.append(current)
    return np.array(left, np.int64), np.array(right, np.int64)


def _matrix(marks) -> np.ndarray:
    return np.frombuffer(b"".join(marks), np.uint8).reshape(len(marks), -1)


def _buckets(nodes: DataFrame) -> DataFrame:
    """``chunks, chunk, key, nodes, marks``: the chunks of buckets that may hold a pair.

    Buckets of the same members, such as the many of two near copies, are one.
    """
    members = nodes.select(F.explode("bands").alias("key"), "node")
    # A set of members is known by its size and 128 bits.
    names = [F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(f"name_{seed}") for seed in (1, 2)]
    sizes = members.groupBy("key").agg(F.count("*").alias("size"), *names).filter("size > 1")
    sizes = sizes.groupBy("size", "name_1", "name_2").agg(F.min("key").alias("key"))
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    shared = members.join(sizes, "key").select("key", "node", chunks.alias("chunks"))
    return stage(
        shared.join(nodes.select("node", "marks"), "node")
        .groupBy("key", "chunks", F.pmod(F.xxhash64("node"), F.col("chunks")).alias("chunk"))
        .agg(F.collect_list(F.struct("node", "marks")).alias("m"))
        .select("key", "chunks", "chunk", F.col("m.node").alias("nodes"), F.col("m.marks").alias("marks")),
        "dart-buckets",
    )


def candidate_pairs(nodes: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """``a, b`` (a < b): the pairs of bucket members that span each bucket by estimated similarity."""
    floor = threshold - margin
    packed = _buckets(nodes)

    def ordered(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    def span(batches):
        for batch in batches:
            two = batch["more_nodes"].isna() & (batch["nodes"].str.len() == 2)
            if two.any():
                # Most buckets hold one pair.
                ids = np.array(batch["nodes"][two].tolist(), np.int64)
                marks = np.frombuffer(b"".join(m for pair in batch["marks"][two] for m in pair), np.uint8).reshape(len(ids), 2, -1)
                near = (marks[:, 0] == marks[:, 1]).mean(axis=1) >= floor
                yield ordered(ids[near, 0], ids[near, 1])
            for ids, marks, more_ids, more_marks in batch[~two][columns].itertuples(index=False):
                if more_ids is not None:
                    ids, marks = np.concatenate([ids, more_ids]), [*marks, *more_marks]
                ids = np.asarray(ids, np.int64)
                yield ordered(*(ids[x] for x in spanning_pairs(_matrix(marks), floor)))

    # The chunks of a large bucket are spanned two by two; together these forests hold one of the whole bucket.
    others = packed.filter("chunks > 1").select("key", F.col("chunk").alias("more_chunk"), F.col("nodes").alias("more_nodes"), F.col("marks").alias("more_marks"))
    alone = packed.filter("chunks = 1").withColumns({"more_nodes": F.lit(None).cast("array<bigint>"), "more_marks": F.lit(None).cast("array<binary>")})
    joint = packed.filter("chunks > 1").join(others, "key").filter("chunk < more_chunk")
    columns = ["nodes", "marks", "more_nodes", "more_marks"]
    small_batches(nodes.sparkSession, 64)
    return stage(alone.select(*columns).unionByName(joint.select(*columns)).mapInPandas(span, "a long, b long").distinct(), "dart-pairs")


def _blocks(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, marks, block, side, own``: the members of groups (``node, root``), dealt to blocks.

    A group of one chunk is a block. Of a larger one every two chunks are a block; the
    pairs inside a chunk are tested in one of its blocks, where its members are ``own``.
    """
    placed = groups.join(nodes.select("node", "size", "marks"), "node")
    extent = groups.join(nodes.select("node", "size"), "node").groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    chunks = F.greatest(F.ceil(F.col("n") / CHUNK), F.ceil(F.col("bytes") / CHUNK_BYTES)).cast("int")
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    dealt = placed.join(extent.select("root", chunks.alias("chunks")), "root").select("node", "marks", "root", "chunks", chunk.alias("chunk"))
    # The chunk's partners; a chunk's own pairs go with the next chunk, those of the last one with the chunk before.
    partners = F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda p: p != F.col("chunk")))
    least, most = F.least("chunk", "partner"), F.greatest("chunk", "partner")
    last = F.greatest(F.col("chunks") - 2, F.lit(0))
    own = (F.col("chunks") == 1) | ((least == F.least("chunk", last)) & (most == least + 1))
    return dealt.withColumn("partner", F.explode(partners)).select(
        "node", "marks", F.struct("root", least.alias("low"), most.alias("high")).alias("block"), (F.col("chunk") > F.col("partner")).alias("side"), own.alias("own"))


def block_links(marks: np.ndarray, texts: list[str], side: np.ndarray, own: np.ndarray, threshold: float = THRESHOLD, floor: float = THRESHOLD - MARGIN, shingle: int = SHINGLE) -> list[tuple[int, int]]:
    """Rows of a block that a link joins to rows before: a forest with the components of all links of the block.

    A pair of different sides, or of a side's own, is tested on the texts unless its estimate lies below ``floor``
    or it is inside one component by then.
    """
    sets = [elements(text, shingle) for text in texts]
    if len(sets) == 2:
        near = (marks[0] == marks[1]).mean() >= floor and weighted_jaccard(*sets) >= threshold
        return [(0, 1)] if near else []
    sizes = np.array([len(e) for e, _ in sets])
    starts = np.cumsum(sizes) - sizes
    weights = np.concatenate([w for _, w in sets])
    _, place = np.unique(np.concatenate([e for e, _ in sets]), return_inverse=True)
    totals = np.add.reduceat(weights, starts)
    held = np.zeros(int(place.max()) + 1)
    root, links = np.arange(len(sets)), []
    for i in range(len(sets) - 1):
        open_ = (root[i + 1 :] != root[i]) & ((side[i + 1 :] != side[i]) | (own[i + 1 :] & own[i]))
        todo = i + 1 + np.flatnonzero(open_)
        todo = todo[_share_equal(marks[todo], marks[i]) >= floor]
        if not len(todo):
            continue
        mine = slice(starts[i], starts[i] + sizes[i])
        held[place[mine]] = weights[mine]
        if 4 * int(sizes[todo].sum()) > int(sizes.sum()):
            common = np.add.reduceat(np.minimum(weights, held[place]), starts)[todo]
        else:
            common = np.array([np.minimum(weights[s : s + n], held[place[s : s + n]]).sum() for s, n in zip(starts[todo], sizes[todo])])
        held[place[mine]] = 0
        for j in todo[common / np.maximum(1e-12, totals[todo] + totals[i] - common) >= threshold]:
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                links.append((i, int(j)))
    return links


def group_links(docs: DataFrame, nodes: DataFrame, groups: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN, shingle: int = SHINGLE) -> DataFrame:
    """``u, v``: links that join what all links inside the groups (``node, root``) join.

    Different texts of groups are shuffled once by node and once for each of their blocks. A task holds one block.
    """

    def join(block: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(block) if len(block) > 1 else block[0]
        ids, marks = rows["node"].to_numpy(), _matrix(rows["marks"].tolist())
        found = block_links(marks, rows["text"].tolist(), rows["side"].to_numpy(bool), rows["own"].to_numpy(bool), threshold, threshold - margin, shingle)
        at = np.array(found, np.int64).reshape(-1, 2)
        return pd.DataFrame({"u": ids[at[:, 0]], "v": ids[at[:, 1]]})

    def link(batches):
        last, held = None, []
        for batch in batches:
            # Rows come sorted by block; a block may go on in the next batch.
            places = batch[["root", "low", "high"]].to_numpy()
            cuts = [0, *(1 + np.flatnonzero((places[1:] != places[:-1]).any(axis=1))), len(places)]
            for start, stop in zip(cuts[:-1], cuts[1:]):
                if start == stop:
                    continue
                name = tuple(places[start])
                if held and name != last:
                    yield join(held)
                    held = []
                last = name
                held.append(batch.iloc[start:stop])
        if held:
            yield join(held)

    spark = docs.sparkSession
    small_batches(spark, 128)
    grouped = groups.select("node")
    texts = docs.select(F.xxhash64("text").alias("node"), "text").join(grouped, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    rows = _blocks(groups, nodes).join(texts, "node").select("block.*", "side", "own", "node", "marks", "text")
    sorted_ = rows.repartition(partitions(spark), "root", "low", "high").sortWithinPartitions("root", "low", "high", "node")
    return sorted_.mapInPandas(link, "u long, v long")


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``node, root`` for each text that has a near duplicate; other texts have no row."""
    nodes = stage(signed_nodes(docs), "dart-nodes")
    groups = stage(components(candidate_pairs(nodes, threshold).toDF("u", "v")), "dart-groups")
    links = stage(group_links(docs, nodes, groups, threshold), "dart-links")
    return stage(components(links), "dart-roots")


def classed(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``_node`` (null without words), ``_root`` and ``class_id``, the smallest id of the class.

    Columns of these names are replaced.
    """
    docs = docs.drop("class_id", "_node", "_root")
    docs = docs.withColumn("_node", F.when(F.col("text").rlike(r"(?U)\w"), F.xxhash64("text")))
    ids = docs.filter(F.col("_node").isNotNull()).groupBy("_node").agg(F.min("doc_id").alias("least_id"))
    roots = near_duplicate_classes(docs, threshold).toDF("_node", "_root")
    placed = ids.join(roots, "_node", "left").withColumn("_root", F.coalesce("_root", "_node"))
    classes = placed.join(placed.groupBy("_root").agg(F.min("least_id").alias("class_id")), "_root").drop("least_id")
    return docs.join(classes, "_node", "left").withColumn("class_id", F.when(F.col("_node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")))


def keep_one_per_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with the smallest id of each class (one of equal ids), and all without words."""
    marked = classed(kept_aside(docs, "doc_id", "text"), threshold)
    kept = marked.filter(F.col("_node").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id")))
    # Equal ids inside a class are rare; the window only sees the smallest id of each class.
    same = Window.partitionBy("_root", "doc_id").orderBy("_node")
    numbered = kept.withColumn("_n", F.when(F.col("_node").isNull(), 1).otherwise(F.row_number().over(same)))
    return numbered.filter("_n = 1").select("_row.*")


def op3_near_duplicates(spark, sf_dir):
    """Class of every document."""
    return classed(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id")
