"""Repeated byte strings of a corpus by prefix-free parsing.

A byte is removed if it lies in a ``SIZE``-byte string that starts at another
place too, in the same document or another one.

Texts are parsed into phrases at triggers of a rolling hash: a place is a
trigger if the hash of its ``GRAM`` bytes is the least (the last of equals) of
``REACH`` places in a row. So a trigger depends on nearby bytes only, and every
string of ``SIZE`` bytes holds one in its first ``REACH`` places: a string is a
suffix of a phrase (up to the trigger) followed by a prefix of the parse from
there. Equal strings have equal suffixes and equal parse prefixes. The corpus
order of suffixes is only needed up to ``SIZE`` bytes and only for equality, so
its ranks are hashes: equal rank, equal hash.

1. *Parse ranks.* Every trigger has a rank, the hash of the bytes from it that all strings
   of the phrase before it share. Ranks are counted; a trigger whose rank occurs once has no repeated string.
2. *Whole phrases.* If another trigger has the same bytes for all strings of its phrase, all of these are repeated.
3. *Phrase suffixes.* The rest, borders of repeated passages, is compared string by string among
   the different contexts of one rank. Of contexts that occur more than once one takes part. Contexts of
   a common rank are dealt to several groups; strings that a group does not find twice meet in a count by hash.

Since all occurrences are removed, the result depends on the text only: equal
texts are one node (64-bit hash) from the second step on, and copies count in
the first. Long texts are whole; a text gives about two triggers per ``REACH`` bytes.

A null text has no bytes; texts below ``SIZE`` bytes keep all. Columns of
``docs`` named like an added one are replaced.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import partitions, small_batches, table
from parley.staging import stage

SIZE = 400
GRAM = 16
REACH = 128
#: Different contexts of one rank that one group compares.
CONTEXTS = 2000

_PLACE = (1 << 30) - 1
_BYTE = np.random.default_rng(400).integers(1, 2**63, size=256, dtype=np.uint64) | np.uint64(1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def phrases(data: bytes, size: int = SIZE, gram: int = GRAM, reach: int = REACH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Triggers, and the first and last start of the strings whose first trigger each is."""
    if gram & (gram - 1) or size < reach + gram:
        raise ValueError("gram must be a power of two, and a string must hold reach + gram bytes")
    n = len(data) - size + 1
    if n < 1:
        return (np.empty(0, np.int64),) * 3
    codes = _BYTE[np.frombuffer(data, np.uint8)[: n + reach + gram]]
    # Hash of each gram by doubling: gram is a power of two.
    step = 1
    with np.errstate(over="ignore"):
        while step < gram:
            codes = codes[:-step] * np.uint64(0x9E3779B97F4A7C15 + 2 * step) + (codes[step:] ^ (codes[step:] >> np.uint64(29)))
            step *= 2
        codes = (codes ^ (codes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    low = (codes & np.uint64(((1 << 64) - 1) ^ _PLACE)) | (np.uint64(_PLACE) - np.arange(len(codes), dtype=np.uint64))
    span = 1
    while span < reach:
        step = min(span, reach - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    at = _PLACE - (low[:n] & np.uint64(_PLACE)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[first], first, np.r_[first[1:] - 1, n - 1]


def _ranks(data: bytes, size: int, gram: int, reach: int) -> list[dict]:
    """Triggers by rank and context: a run of one byte has a trigger at nearly each place, all alike; these are one row with ``more`` places."""
    view, shared = memoryview(data), size - reach + 1
    out: dict[tuple[int, int], dict] = {}
    for at, lo, hi in zip(*(x.tolist() for x in phrases(data, size, gram, reach))):
        # The places of the strings around the trigger belong to the context.
        whole = xxhash.xxh64_intdigest(view[lo : hi + size], seed=((at - lo) << 16) + (hi - at + reach))
        rank = xxhash.xxh64_intdigest(view[at : at + shared])
        row = out.setdefault((rank, whole), {"rank": _signed(rank), "whole": _signed(whole), "at": at, "more": None})
        if row["at"] != at:
            row["more"] = row["more"] or []
            row["more"].append(at)
    return list(out.values())


def removed_ranges(docs: DataFrame, size: int = SIZE, gram: int = GRAM, reach: int = REACH) -> tuple[DataFrame, DataFrame]:
    """``node, text`` of the different texts, and ``node, whole, parts``: triggers all of whose strings are
    repeated, and (first, last) starts of repeated strings of others. Nodes without any have no row."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<struct<rank:long,whole:long,at:int,more:array<int>>>")
    def ranks(texts: pd.Series) -> pd.Series:
        return pd.Series([_ranks(t.encode(), size, gram, reach) for t in texts], dtype=object)

    long_enough = docs.filter(F.octet_length("text") >= size).select(F.xxhash64("text").alias("node"), "text")
    triggers = long_enough.select("node", F.explode(ranks("text")).alias("t")).select("node", "t.*")
    # Both sides of these joins come from files: rows of a very common rank then make a skewed join, which adaptive execution deals anew.
    more = F.coalesce("more", F.array().cast("array<int>"))
    places = F.sum(1 + F.size(more)).alias("n")
    common = stage(triggers.groupBy("rank").agg(places).filter("n > 1").select("rank"), "parse-common")
    live = stage(triggers.join(common, "rank"), "parse-ranks")
    contexts = stage(live.groupBy("rank", "whole").agg(places, F.min(F.struct("node", "at")).alias("one")), "parse-contexts")
    open_ranks = stage(contexts.groupBy("rank").agg(F.min("n").alias("least"), F.count("*").alias("contexts")), "parse-open-ranks")
    known = stage(contexts.join(open_ranks, "rank"), "parse-known")
    marked = (
        live.join(known, ["rank", "whole"])
        .withColumn("repeated", F.col("n") > 1)
        .withColumn("compared", (F.col("least") == 1) & (~F.col("repeated") | ((F.col("one.node") == F.col("node")) & (F.col("one.at") == F.col("at")))))
        .filter("repeated or compared")
    )
    groups = F.when(F.col("compared"), F.ceil(F.col("contexts") / CONTEXTS)).otherwise(0).cast("int")
    mark = lambda at, groups: F.struct(at.alias("at"), "repeated", groups.alias("groups"), "rank")
    # Of the places of one row the first is compared.
    marks = F.concat(F.array(mark(F.col("at"), groups)), F.transform(more, lambda at: mark(at, F.lit(0))))
    lists = stage(marked.groupBy("node").agg(F.flatten(F.collect_set(marks)).alias("marks")), "parse-marks")
    texts = long_enough.groupBy("node").agg(F.first("text").alias("text"))

    @F.pandas_udf("array<struct<rank:long,groups:int,at:int,lo:int,hi:int,repeated:boolean,body:binary>>")
    def bodies(texts: pd.Series, marks: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, marks):
            data, found = text.encode(), {m["at"]: m for m in found if m["groups"]}
            triples = zip(*(x.tolist() for x in phrases(data, size, gram, reach))) if found else ()
            out.append([
                {"rank": m["rank"], "groups": m["groups"], "at": at, "lo": lo, "hi": hi, "repeated": m["repeated"], "body": data[lo : hi + size]}
                for at, lo, hi in triples if (m := found.get(at))
            ])
        return pd.Series(out, dtype=object)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        """Repeated strings of each context as far as the group shows them; for ranks of several groups all strings."""
        counts: Counter = Counter()
        digests = []
        for rank, lo, hi, repeated, body in rows[["rank", "lo", "hi", "repeated", "body"]].itertuples(index=False):
            view = memoryview(body)
            keys = [xxhash.xxh3_128_digest(view[i : i + size], seed=rank & 0xFFFFFFFFFFFFFFFF) for i in range(hi - lo + 1)]
            digests.append(keys)
            counts.update(keys)
            if repeated:
                counts.update(keys)
        out = []
        for (node, at, lo, several, repeated), keys in zip(rows[["node", "at", "lo", "groups", "repeated"]].itertuples(index=False), digests):
            if several > 1:
                out += [(node, at, lo + i, lo + i, key, counts[key] > 1, repeated) for i, key in enumerate(keys)]
            elif not repeated:
                twice = [i for i, key in enumerate(keys) if counts[key] > 1]
                if twice:
                    out.append((node, at, lo + twice[0], lo + twice[-1], None, True, False))
        return pd.DataFrame(out, columns=["node", "at", "first", "last", "digest", "twice", "repeated"])

    asked = texts.join(lists.filter(F.exists("marks", lambda m: m.groups > 0)), "node")
    split = asked.select("node", F.explode(bodies("text", "marks")).alias("b")).select("node", "b.*")
    part = F.pmod(F.xxhash64("rank", F.pmod(F.xxhash64("node", "at"), F.col("groups"))), F.lit(8 * partitions(docs.sparkSession)))
    compared = stage(
        split.groupBy(part.alias("part")).applyInPandas(
            lambda rows: compare(rows), "node long, at int, first int, last int, digest binary, twice boolean, repeated boolean"),
        "parse-suffixes",
    )
    # Strings of common ranks: groups have counted theirs, the count over groups says the rest.
    loose = compared.filter(F.col("digest").isNotNull())
    met = loose.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    joint = loose.filter("not twice").join(met, "digest", "left_semi").unionByName(loose.filter("twice")).filter("not repeated")
    parts = (
        compared.filter(F.col("digest").isNull()).unionByName(joint)
        .groupBy("node", "at").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .groupBy("node").agg(F.collect_list(F.struct("first", "last")).alias("parts"))
    )
    whole = lists.select("node", F.transform(F.filter("marks", lambda m: m.repeated), lambda m: m.at).alias("whole"))
    return texts, whole.join(parts, "node", "left")


def kept_bytes(text: str, whole, parts, size: int = SIZE, gram: int = GRAM, reach: int = REACH) -> tuple[bytes, int, int]:
    """What is left of a text, and the number of bytes and of maximal runs removed."""
    data = text.encode()
    ranges = [(p["first"], p["last"]) for p in (parts if parts is not None else ())]
    if whole is not None and len(whole):
        wanted = set(map(int, whole))
        ranges += [(lo, hi) for at, lo, hi in zip(*(x.tolist() for x in phrases(data, size, gram, reach))) if at in wanted]
    kept, gone, runs, last = [], 0, 0, -1
    for first, final in sorted(ranges):
        stop = final + size
        if first > last:  # bytes between the runs stay
            kept.append(data[max(0, last) : first])
            runs += 1
            gone += stop - first
            last = stop
        elif stop > last:
            gone += stop - last
            last = stop
    kept.append(data[max(0, last) :])
    return b"".join(kept), gone, runs


def without_repeats(docs: DataFrame, size: int = SIZE, gram: int = GRAM, reach: int = REACH) -> DataFrame:
    """``node, kept`` (bytes), ``n_removed``, ``n_spans`` for the different texts of at least ``size`` bytes."""

    @F.pandas_udf("kept binary, n_removed long, n_spans long")
    def cut(texts: pd.Series, whole: pd.Series, parts: pd.Series) -> pd.DataFrame:
        rows = [kept_bytes(t, w, p, size, gram, reach) for t, w, p in zip(texts, whole, parts)]
        return pd.DataFrame(rows, columns=["kept", "n_removed", "n_spans"])

    texts, ranges = removed_ranges(docs, size, gram, reach)
    return texts.join(ranges, "node", "left").select("node", cut("text", "whole", "parts").alias("c")).select("node", "c.*")


def op6_repeated_bytes(spark, sf_dir):
    """Repeated 400-byte strings of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = without_repeats(docs).select("node", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    # Short texts have no row there and keep all.
    rows = docs.select(
        "doc_id", size.alias("n_bytes"), F.xxhash64("text").alias("node"),
        F.when(size < SIZE, F.sha2(F.coalesce("text", F.lit("")), 256)).alias("own"),
    )
    joined = rows.join(found, "node", "left")
    return joined.select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("own", "kept_sha256").alias("kept_sha256"),
    )
