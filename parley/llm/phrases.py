"""Collocations by multikey quicksort of suffix pointers.

Texts are lower-cased (A-Z), split into pieces at stops and line breaks and
into words at blanks and tabs. Everything is counted per language. A phrase of
two to ``LONGEST`` words that occurs at least ``SUPPORT`` times is a candidate; its score
is the least over its cuts of floor(2000000 * a / (l + r)). Candidates inside a
longer one that occurs at least 80 % as often are dropped.

1. *Words* are counted per task and summed. Words below ``SUPPORT`` end every phrase. Tasks know the others
   by a bit table of fixed size (8 MB, by hash), which may let rare words pass but never stops a frequent one.
2. *Routing.* Every place of a text is a suffix pointer: the hashes of its next words, up to the next rare word
   or piece border. Equal suffixes of a block are one with a weight. A suffix is routed by its leading words up to the first that is not
   hot; hot words hold more than 1 / ``routes`` of all words, so there are fewer than ``routes`` of them and no
   route gets a larger share. Phrases of hot words only are summed beside it. A block's suffixes for one bucket of
   routes travel packed as one row, the most frequent words in two bytes.
3. *Sorting.* Buckets, as many as the session's shuffle partitions ask for, are sorted by a three-way quicksort, word by word: pointers whose word
   equals the pivot's are sorted by the next one, and their weight is the count of the phrase so far. A part
   of a weight below ``SUPPORT`` is abandoned at once, for all phrases in it are as rare.
4. Frequent phrases get their words back, and cuts and longer phrases are looked up by equi-joins.

Words are 64-bit hashes of language and word between the steps: two of n frequent words
share one with a chance of n * n / 2**65.

Edge cases: a null text is empty, a null language is ``und``. Repeated rows count. A text is never
cut, nor are words. Equal scores are ordered by count, then phrase (byte order). Empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import partitions, sized_batches, table
from parley.staging import stage

SUPPORT = 30
LONGEST = 4
TOP = 2000
#: Bits of the table of frequent words.
TABLE_BITS = 26
#: Distinct words a task counts before it hands them on, and hashes it remembers.
HELD_WORDS = 200_000
#: Places of texts whose suffixes a task combines and packs at once.
BLOCK = 1 << 19
#: Buckets of routes for each shuffle partition; a bucket is sorted at once.
BUCKETS = 4
#: Words with short codes: the most frequent ones, half a MB of hashes.
BOOK = (1 << 16) - 2

_ESCAPE = (1 << 16) - 1
_BORDER = b"\xff"  # in no UTF-8 text
_STOPS = b".,;:!?\n\x0b\x0c\r"
_TO_BORDERS = bytes.maketrans(_STOPS + b"\t", _BORDER * len(_STOPS) + b" ")
_PAGE = 15  # bits a built-in bitmap page holds, as a power of two
_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]


def tokens(text: str | None) -> list[bytes]:
    """Words of a text, with a border between pieces."""
    return (text or "").encode().lower().translate(_TO_BORDERS).replace(_BORDER, b" \xff ").split()


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, n`` of all words."""

    def count(batches):
        held: dict[str, Counter] = {}

        def rows():
            parts = [pd.DataFrame({"lang": lang, "word": [w.decode() for w in c], "n": list(c.values())}) for lang, c in held.items() if c]
            held.clear()
            return parts

        for batch in batches:
            for lang, text in batch[["lang", "text"]].itertuples(index=False):
                counter = held.setdefault(lang, Counter())
                counter.update(tokens(text))
                counter.pop(_BORDER, None)
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from rows()
        yield from rows()

    return docs.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def bit_table(spark, hashes: DataFrame) -> np.ndarray:
    """One bit per low ``TABLE_BITS`` bits of the ``h`` of any row; 8 MB however many there are."""
    place = F.col("h").bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
    pages = hashes.groupBy(F.shiftright(place, _PAGE).alias("page")).agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << _PAGE) - 1))).alias("bits"))
    out = np.zeros((1 << TABLE_BITS - _PAGE, 1 << _PAGE - 3), np.uint8)
    for page, bits in pages.collect():
        out[page] = np.frombuffer(bits, np.uint8)
    return out.ravel()


class _Ids(dict):
    """Hash of each word of a language; 0 for words outside the table and for borders."""

    def __init__(self, lang: str, bits: np.ndarray):
        self.seed, self.bits = xxhash.xxh64_intdigest(lang.encode(), 42), bits
        self[_BORDER] = 0

    def __missing__(self, word: bytes) -> int:
        # As Spark's xxhash64(lang, word).
        h = xxhash.xxh64_intdigest(word, self.seed)
        at = h & ((1 << TABLE_BITS) - 1)
        signed = h - (1 << 64) if h >> 63 else h
        self[word] = known = signed if self.bits[at >> 3] >> (at & 7) & 1 else 0
        return known


def combined(columns: list[np.ndarray], weight: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows as one, with the sum of their weights."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    first = np.flatnonzero(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]) if len(order) else order
    return [c[first] for c in columns], np.add.reduceat(weight[order], first) if len(first) else weight


def _window(ids: np.ndarray) -> list[np.ndarray]:
    """Columns of the words from each place on, 0 from the first border."""
    padded = np.r_[ids, np.zeros(LONGEST - 1, np.int64)]
    columns = [ids]
    for i in range(1, LONGEST):
        columns.append(np.where(columns[-1] != 0, padded[i : i + len(ids)], 0))
    return columns


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _coded(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids, 0 first, and the place of each id among them."""
    words, code = np.unique(np.r_[ids, 0], return_inverse=True)
    border = int(np.searchsorted(words, 0))
    code = np.where(code < border, code + 1, np.where(code == border, 0, code))[:-1]
    return np.r_[0, np.delete(words, border)], code


def _suffix_rows(ids: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Words of a block; its suffixes as places among them, with weights and the number of words that route
    them; and with number 0 phrases of hot words only."""
    words, code = _coded(ids)
    columns = _window(code)
    keep = columns[1] != 0
    # Two places fit into one number, which halves the sorting.
    paired = [columns[i][keep] << 32 | columns[i + 1][keep] for i in (0, 2)]
    paired, weight = combined(paired, np.ones(int(keep.sum()), np.int64))
    columns = [x for p in paired for x in (p >> 32, p & 0xFFFFFFFF)]
    is_hot = np.isin(words, hot)
    heat = np.cumprod([is_hot[c] for c in columns], axis=0)  # whether the first words up to here are all hot
    leading = heat.sum(axis=0)
    mixed = (leading < LONGEST) & (np.choose(np.minimum(leading, LONGEST - 1), columns) != 0)
    parts = [([c[mixed] for c in columns], weight[mixed], leading[mixed] + 1)]
    for depth in range(2, LONGEST + 1):
        at = heat[depth - 1] > 0
        short, sums = combined([c[at] if i < depth else np.zeros(int(at.sum()), np.int64) for i, c in enumerate(columns)], weight[at])
        parts.append((short, sums, np.zeros(len(sums), np.int64)))
    columns, weight, lead = [np.concatenate([p[0][i] for p in parts]) for i in range(LONGEST)], *(np.concatenate([p[k] for p in parts]) for k in (1, 2))
    return words, columns, weight, lead


def _planes(x: np.ndarray, kind) -> bytes:
    """Numbers byte by byte, all first bytes first: the higher ones are nearly all alike."""
    return x.astype(kind).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _packed(words: np.ndarray, columns: list[np.ndarray], weight: np.ndarray, lead: np.ndarray, buckets: int, salt: int, book: np.ndarray) -> pd.DataFrame:
    """Rows by bucket of their route. Words of ``book`` (sorted) take two bytes, others ten."""
    spelled = words.view(np.uint64)
    route = spelled[columns[0]]
    for i in range(1, LONGEST):
        further = (lead > i) | (lead == 0)
        route = np.where(further, _mixed(route * np.uint64(0x9E3779B97F4A7C15) + spelled[columns[i]]), route)
    # Phrases of hot words are summed again at the end, so any bucket may take a part of them.
    bucket = (_mixed(route + np.where(lead == 0, salt, 0).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    arrays = [x[order] for x in (*columns, weight, lead)]
    used, first = np.unique(bucket[order], return_index=True)
    at = np.searchsorted(book, words)
    listed = (at < len(book)) & (np.append(book, 0)[at] == words)
    code = np.where(words == 0, 0, np.where(listed, at + 1, _ESCAPE))
    pack, out = zstandard.ZstdCompressor(level=1).compress, []
    for a, b in zip(first, [*first[1:], len(order)]):
        own = np.concatenate([c[a:b] for c in arrays[:LONGEST]])
        codes = code[own]
        body = [_planes(codes, np.uint16), _planes(arrays[LONGEST][a:b], np.uint64), _planes(arrays[LONGEST + 1][a:b], np.uint8)]
        out.append(pack(b"".join([np.uint32(b - a).tobytes(), *body, words[own[codes == _ESCAPE]].tobytes()])))
    return pd.DataFrame({"bucket": used.astype(np.int32), "packed": out})


def _unpacked(packed, book: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    unpack, parts = zstandard.ZstdDecompressor().decompress, []
    spelled = np.r_[0, book]
    for blob in packed:
        data = unpack(blob)
        rows, at, numbers = int(np.frombuffer(data, np.uint32, 1)[0]), 4, []
        for kind, size in ((np.uint16, LONGEST * rows), (np.uint64, rows), (np.uint8, rows)):
            width = np.dtype(kind).itemsize
            planes = np.frombuffer(data, np.uint8, size * width, at).reshape(width, size)
            numbers.append(np.ascontiguousarray(planes.T).view(kind).ravel().astype(np.int64))
            at += size * width
        codes, weight, lead = numbers
        words = spelled[np.where(codes == _ESCAPE, 0, codes)]
        words[codes == _ESCAPE] = np.frombuffer(data, np.uint8, -1, at).view(np.int64) if at < len(data) else 0
        parts.append([*words.reshape(LONGEST, rows), weight, lead])
    arrays = [np.concatenate([p[i] for p in parts]) for i in range(LONGEST + 2)]
    return arrays[:LONGEST], arrays[LONGEST], arrays[LONGEST + 1]


def suffixes(docs: DataFrame, bits, hot: np.ndarray, book, buckets: int) -> DataFrame:
    """``bucket, packed``: suffixes of two frequent words or more, combined and packed per block of a task."""

    def emit(batches):
        ids: dict[str, _Ids] = {}
        held, size = [], 0
        salt = TaskContext.get().partitionId() % 64

        def block():
            return _packed(*_suffix_rows(np.concatenate(held), hot), buckets, salt, book.value)

        for batch in batches:
            for lang, text in batch[["lang", "text"]].itertuples(index=False):
                words = tokens(text)
                known = ids.setdefault(lang, _Ids(lang, bits.value))
                held.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                held.append(np.zeros(1, np.int64))
                size += len(words) + 1
                if size >= BLOCK:
                    yield block()
                    held, size = [], 0
                    if sum(map(len, ids.values())) > HELD_WORDS:
                        ids.clear()
        if held:
            yield block()

    return docs.mapInPandas(emit, "bucket int, packed binary")


def multikey_quicksort(columns: list[np.ndarray], weight: np.ndarray, least: int = SUPPORT):
    """Phrases (as pointer and length) of two words or more and a weight of at least ``least``, with their weights."""
    pointers, at_row, length, total = np.arange(len(weight)), [], [], []
    stack = [(0, len(weight), 0)] if weight.sum() >= least else []
    while stack:
        first, last, depth = stack.pop()
        part = pointers[first:last]
        keys = columns[depth][part]
        sample = keys[:: max(1, len(keys) // 31)]
        pivot = np.partition(sample, len(sample) // 2)[len(sample) // 2]
        same = keys == pivot
        if same.all():
            bounds = (first, first, last, last)
        else:
            less = keys < pivot
            equal, before = part[same], part[less]
            pointers[first:last] = np.concatenate([before, equal, part[~(less | same)]])
            bounds = (first, first + len(before), first + len(before) + len(equal), last)
        for side, (a, b) in enumerate(zip(bounds, bounds[1:])):
            # Parts below the support are abandoned, with all phrases in them.
            if a == b or (found := int(weight[pointers[a:b]].sum())) < least:
                continue
            if side != 1:
                stack.append((a, b, depth))
            elif pivot != 0:
                if depth:
                    at_row.append(pointers[a])
                    length.append(depth + 1)
                    total.append(found)
                if depth + 1 < len(columns):
                    stack.append((a, b, depth + 1))
    return np.array(at_row, np.int64), np.array(length, np.int64), np.array(total, np.int64)


def frequent_phrases(packed: DataFrame, book, least: int = SUPPORT) -> DataFrame:
    """``w1..w4, f`` of the phrases that occur ``least`` times, 0 where a phrase has no word."""

    def sort(bucket: pd.DataFrame) -> pd.DataFrame:
        columns, weight, lead = _unpacked(bucket["packed"], book.value)
        plain = lead > 0
        own = [c[plain] for c in columns]
        at, length, total = multikey_quicksort(own, weight[plain], least)
        # Phrases shorter than their route lie in several routes and are counted with the hot ones.
        whole = length >= lead[plain][at]
        at, length, total = at[whole], length[whole], total[whole]
        found = [np.where(length > i, c[at], 0) for i, c in enumerate(own)]
        hot, sums = combined([c[~plain] for c in columns], weight[~plain])
        return pd.DataFrame({**{w: np.r_[a, b] for w, a, b in zip(_WORDS, found, hot)}, "f": np.r_[total, sums]})

    found = packed.groupBy("bucket").applyInPandas(sort, ", ".join(f"{w} long" for w in _WORDS) + ", f long")
    return found.groupBy(*_WORDS).agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def phrase_counts(docs: DataFrame, least: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """``lang, n`` and ``lang, words, phrase, f`` of all frequent phrases, single words included."""
    spark = docs.sparkSession
    sized_batches(spark)
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    counts = stage(word_counts(docs), "phrase-words")
    sums = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    known = stage(counts.filter(F.col("n") >= least).select("lang", "word", "n", F.xxhash64("lang", "word").alias("h")), "phrase-known")
    routes = max(2000, 4 * partitions(spark))
    everything = counts.agg(F.sum("n")).first()[0] or 0
    hot = np.array([r.h for r in known.filter(F.col("n") > everything // routes).select("h").collect()], np.int64)
    bits = spark.sparkContext.broadcast(bit_table(spark, known))
    buckets = max(16, BUCKETS * partitions(spark))
    often = known.orderBy(F.desc("n"), "h").limit(BOOK).select("h").collect()
    book = spark.sparkContext.broadcast(np.array(sorted(r.h for r in often), np.int64))
    found = frequent_phrases(suffixes(docs, bits, hot, book, buckets), book, least)
    for w in _WORDS:
        words = known.select(F.col("h").alias(w), F.col("word").alias(f"_{w}"), *([F.col("lang")] if w == "w1" else []))
        found = found.join(words, w, "inner" if w in _WORDS[:2] else "left")
    spelled = F.array_compact(F.array(*[f"_{w}" for w in _WORDS]))
    single = known.select("lang", F.array("word").alias("words"), F.col("n").alias("f"))
    both = single.unionByName(found.select("lang", spelled.alias("words"), "f"))
    return sums, stage(both.withColumn("phrase", F.array_join("words", " ")), "phrase-counts")


def collocations(docs: DataFrame, least: int = SUPPORT, share: int = 80, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` candidates of each language."""
    sums, counts = phrase_counts(docs, least)
    candidates = counts.filter(F.size("words") > 1).withColumnRenamed("f", "a")
    size = F.size("words")

    def run(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", run(F.lit(1), F.col("k")).alias("first"), run(F.col("k") + 1, size - F.col("k")).alias("rest"))
    parts = counts.select("lang", "phrase", "f")
    cuts = cuts.join(parts.toDF("lang", "first", "l"), ["lang", "first"]).join(parts.toDF("lang", "rest", "r"), ["lang", "rest"])
    # Whole numbers of up to 38 digits; `div` is exact on them.
    score = F.expr("CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = candidates.filter(size > 2).select("lang", "a", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("length"))
    inner = inner.select("lang", "a", "words", "length", F.explode(F.sequence(F.lit(1), size - F.col("length") + 1)).alias("start"))
    inner = inner.groupBy("lang", run(F.col("start"), F.col("length")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(19,0)") < share * F.col("a").cast("decimal(19,0)")))
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = flat.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return best.join(sums, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir):
    """The first 2000 collocations of each language."""
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP12_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
runs AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM runs GROUP BY lang),
spots AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM runs, (VALUES (1), (2), (3), (4)) AS lengths(k) WHERE len(w) >= k),
counts AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, any_value(w[i:i + k - 1]) AS words, count(*) AS f
  FROM spots GROUP BY 1, 2, 3 HAVING count(*) >= 30),
candidates AS (SELECT * FROM counts WHERE k > 1),
cuts AS (
  SELECT lang, phrase, f AS a, c, array_to_string(words[:c], ' ') AS head, array_to_string(words[c + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS c FROM candidates)),
scores AS (
  SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = head JOIN counts y ON y.lang = cuts.lang AND y.phrase = rest),
least AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_runs AS (
  SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates)) GROUP BY 1, 2),
kept AS (
  SELECT least.* FROM least LEFT JOIN inner_runs USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
