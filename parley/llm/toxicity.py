"""Toxicity of texts whose words may be disguised.

A disguised word is read as a noisy transmission of plain letters: letters may
be replaced by look-alikes, repeated, or held apart by signs. The possible
letters of each position form a lattice, and the likeliest path under a
character trigram model of the corpus and the channel's costs restores the
word (Viterbi). A word of plain letters without a letter twice in a row
has one path only, itself; all other words, and runs of single letters,
are decoded, whole whatever their length, in time linear in it.

The trigram model counts all texts (27^3 cells at most, whatever the corpus).
The classifier is fitted on labelled rows: at most ``SAMPLE`` different texts
per label, first by hash. Its features are restored words, their first four
to six letters, and first letters that several words of a text share; a feature
stays if toxic texts hold it far more often than others. A text's score is one minus the chance that none of its features is
toxic. At most ``FEATURES`` features are kept, the most significant ones, so
both tables that travel to the tasks have a fixed bound.

A null or empty text scores the rate of toxic texts among those without any
feature. Labels other than 0 and 1 and missing labels do not train; without
toxic labels every score is 0. Several labels of a document count as toxic if one is.
Repeated rows get equal scores. Columns of ``docs`` named ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import small_batches, table
from parley.staging import stage

SAMPLE = 20_000
FEATURES = 4_000
MIN_TOXIC = 4
MIN_PRECISION = 0.8
#: Numbers of different words with one beginning that make a feature.
SEVERAL = (2, 3, 5)
FORGET_WORDS = 60_000
FORGET_TOKENS = 300_000
_NOTHING = (0.0, ())

#: Letters that a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = ".-_*~ '"
#: Channel costs in nats: a look-alike, a repeated letter read as one, a separator inside a word.
COST_LOOKALIKE, COST_REPEAT, COST_SEPARATOR = 1.5, 1.0, 0.7

# Letters fold to a..z (1..26); everything else is a border (0).
_FOLD_LIMIT = 0x250


def _fold(code: int) -> int:
    base = unicodedata.normalize("NFKD", chr(code).lower())[:1]
    return ord(base) - 96 if "a" <= base <= "z" else 0


_FOLD = np.array([_fold(c) for c in range(_FOLD_LIMIT)], dtype=np.int32)


_FOLDED = _FOLD.tolist()


def fold_codes(text: str) -> np.ndarray:
    """The text as letter numbers, 0 for all else."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(codes < _FOLD_LIMIT, _FOLD[np.minimum(codes, _FOLD_LIMIT - 1)], 0)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """``cell, n``: letter trigrams of all texts."""

    def count(batches):
        cells = np.zeros(27**3, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                if text:
                    c = np.concatenate([[0, 0], fold_codes(text), [0]])
                    cells += np.bincount(c[:-2] * 729 + c[1:-1] * 27 + c[2:], minlength=27**3)
        found = np.flatnonzero(cells)
        yield pd.DataFrame({"cell": found, "n": cells[found]})

    return docs.select("text").mapInPandas(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def trigram_costs(counts: DataFrame) -> np.ndarray:
    """Cost in nats of each letter after two others, interpolated with shorter contexts."""
    cells = np.zeros(27**3)
    for r in counts.collect():  # 27^3 rows at most
        cells[r.cell] = r.n
    cells = cells.reshape(27, 27, 27)
    one = (cells.sum((0, 1)) + 1) / (cells.sum() + 27)
    two = (cells.sum(0) + 20 * one) / (cells.sum(0).sum(1, keepdims=True) + 20)
    three = (cells + 20 * two[None]) / (cells.sum(2, keepdims=True) + 20)
    return -np.log(three).astype(np.float32)


_RUN = re.compile(r"(?<!\w)\w(?:[ .\-_*~]\w){2,}(?!\w)")
_DOUBLE = re.compile(r"(.)\1")
_WORDS = re.compile(r"[a-z]+")
_LETTER_RUNS = re.compile(r"[^\W\d_]+")
_LETTERS = "`abcdefghijklmnopqrstuvwxyz"
_STRIP = ".,;:!?\"'()[]{}…»«"


def _chained(read: tuple | None) -> str:
    out = []
    while read is not None:
        read, signs = read
        out.append(signs)
    return "".join(reversed(out))


def restore(token: str, costs: np.ndarray | list[float]) -> str:
    """The likeliest plain reading of a disguised token; blanks part its words.

    A state is the last two letters (27 times the first, plus the second); a run of one sign may give one or two
    letters. ``costs`` may be the flat list of the table, which reads faster than the array.
    """
    flat = costs if isinstance(costs, list) else costs.ravel().tolist()
    letters = [_FOLDED[code] if code < _FOLD_LIMIT else 0 for code in map(ord, token)]
    # What was read is a chain of (before, signs), so that a step costs the same however long the token is.
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    size, i = len(token), 0
    while i < size:
        sign = token[i]
        if letters[i] and len(states) == 1 and sign not in LOOKALIKES:
            # Single letters after one reading: nothing to choose.
            start = i
            [(state, (cost, read))] = states.items()
            while letters[i] and sign not in LOOKALIKES and (i + 1 == size or token[i + 1] != sign):
                letter = letters[i]
                cost += flat[27 * state + letter]
                state = 27 * (state % 27) + letter
                i += 1
                if i == size:
                    break
                sign = token[i]
            if i > start:
                states = {state: (cost, (read, "".join([_LETTERS[x] for x in letters[start:i]])))}
                continue
        run, parts = 1, sign in SEPARATORS
        if not parts:
            while i + run < size and token[i + run] == sign:
                run += 1
        own = [(letters[i], 0.0)] if letters[i] else []
        if sign in LOOKALIKES:
            own += [(ord(x) - 96, COST_LOOKALIKE) for x in LOOKALIKES[sign]]
        after: dict[int, tuple[float, tuple | None]] = {}
        for state, (cost, read) in states.items():
            b = state % 27
            for letter, extra in own:
                once = cost + extra + flat[27 * state + letter]
                total, place = once + COST_REPEAT * (run > 1), 27 * b + letter
                known = after.get(place)
                if known is None or total < known[0]:
                    after[place] = (total, (read, _LETTERS[letter]))
                if run > 1:
                    total, place = once + extra + flat[729 * b + 27 * letter + letter] + COST_REPEAT * (run > 2), 28 * letter
                    known = after.get(place)
                    if known is None or total < known[0]:
                        after[place] = (total, (read, 2 * _LETTERS[letter]))
            if parts:
                total = cost + COST_SEPARATOR
                known = after.get(state)
                if known is None or total < known[0]:
                    after[state] = (total, read)
            if not own:  # a sign that is no letter may be a border
                total, place = cost + (flat[27 * state] if b else 0.0), 27 * b if b else state
                known = after.get(place)
                if known is None or total < known[0]:
                    after[place] = (total, (read, " ") if b else read)
        states = after
        i += run
    # The word's end counts, so that a sign at the end is not forced to be a letter.
    ends = [(cost + (flat[27 * state] if state % 27 else 0.0), read) for state, (cost, read) in states.items()]
    least = min(cost for cost, _ in ends)
    return min(_chained(read) for cost, read in ends if cost == least).strip()


class Reader:
    """Plain words of texts; remembers what it has decoded."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.ravel().tolist()
        # Two generations: words met since the last change, and those met before it.
        self.known: dict[str, tuple[str, ...]] = {}
        self.older: dict[str, tuple[str, ...]] = {}

    def _read(self, token: str) -> tuple[str, ...]:
        bare = token.strip(_STRIP)
        if bare.isalpha() and (len(set(bare)) == len(bare) or not _DOUBLE.search(bare)):
            return (plain(bare),)
        parts = [plain(bare)] if len(bare) < 3 or not any(c.isalnum() for c in bare) else restore(bare, self.costs).split()
        # What stands beside a sign may also be a word by itself ("end.Begin").
        return tuple({*parts, *map(plain, _LETTER_RUNS.findall(bare))})

    def read(self, token: str) -> tuple[str, ...]:
        """Plain words of one token."""
        words = self.known.get(token)
        if words is None:
            if len(self.known) > FORGET_WORDS // 2:
                self.known, self.older = {}, self.known
            words = self.older.get(token)
            if words is None:
                words = self._read(token)
            self.known[token] = words
        return words

    def runs(self, text: str) -> set[str]:
        """Words of the runs of single letters in a lower-case text."""
        found: set[str] = set()
        for m in _RUN.finditer(text):
            # A run may hold several words, cut where the model likes it, or be one word.
            found.update(restore(m[0], self.costs).split())
            found.add(restore("".join(c for c in m[0] if c not in SEPARATORS), self.costs))
        return found

    def words(self, text: str) -> set[str]:
        """All words of a lower-case text."""
        found = self.runs(text)
        for token in set(text.split()):
            found.update(self.read(token))
        return found


def plain(word: str) -> str:
    """Lower-case letters without marks; other letters stay as they are."""
    if word.isascii():
        return word
    return "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


def beginnings(word: str) -> list[str]:
    return [word[:k] for k in (4, 5, 6) if len(word) > k]


def features(word: str) -> list[str]:
    """A word and its first letters."""
    return [word, *(f"{b}*" for b in beginnings(word))]


def text_features(words: set[str]) -> set[str]:
    """Words, their first letters, and first letters that several different words share (``abcd*3``: three or more)."""
    shared = Counter(b for w in words for b in beginnings(w))
    found = {f"{b}*{k}" for b, n in shared.items() if n > 1 for k in SEVERAL if n >= k}
    return found.union(words, (f"{b}*" for b in shared))


@dataclass
class ToxicityModel:
    """Trigram costs, the toxic share of texts that hold a feature, and of texts that hold none."""

    costs: np.ndarray
    shares: dict[str, float] = field(default_factory=dict)
    rest: float = 0.0

    def __post_init__(self) -> None:
        self.reader: Reader | None = None
        self.starts = {f[:4] for f in self.shares if "*" in f}
        self.plain_tokens: set[str] = set()
        self.older_tokens: set[str] = set()
        self.counted = {f.split("*")[0] for f in self.shares if f[-1:].isdigit() and "*" in f}

    def _weight(self, word: str) -> tuple[float, tuple[str, ...]]:
        """Log of the chance that a word's strongest feature is not toxic, and its beginnings that are counted."""
        shares = self.shares
        if word not in shares and word[:4] not in self.starts:
            return _NOTHING
        own = min((math.log1p(-shares[f]) for f in features(word) if f in shares), default=0.0)
        return own, tuple(b for b in beginnings(word) if b in self.counted)

    def score(self, text: str | None) -> float:
        if self.reader is None:
            self.reader = Reader(self.costs)
        if not text:
            return self.rest
        if len(self.plain_tokens) > FORGET_TOKENS // 2:
            self.plain_tokens, self.older_tokens = set(), self.plain_tokens
        text = text.lower()
        words = self.reader.runs(text)
        # Most tokens have no weight; those known are taken out at once.
        tokens = set(text.split()) - self.plain_tokens
        known = tokens & self.older_tokens
        self.plain_tokens |= known
        shares, starts = self.shares, self.starts
        for token in tokens - known:
            bare = token.strip(_STRIP)
            if bare.isalpha() and bare.isascii() and bare not in shares and bare[:4] not in starts and not _DOUBLE.search(bare):
                # The word that the reader would give, without a weight.
                self.plain_tokens.add(token)
                continue
            found = self.reader.read(token)
            if any(self._weight(w) != _NOTHING for w in found):
                words.update(found)
            else:
                self.plain_tokens.add(token)
        total = math.log1p(-self.rest)
        shared: Counter = Counter()
        for word in words:
            own, counted = self._weight(word)
            total += own
            shared.update(counted)
        for b, n in shared.items():
            if n > 1:
                total += min((math.log1p(-self.shares[f]) for k in SEVERAL if n >= k and (f := f"{b}*{k}") in self.shares), default=0.0)
        return min(1.0, max(0.0, -math.expm1(total)))

    def __getstate__(self):
        return {**self.__dict__, "reader": None, "plain_tokens": set(), "older_tokens": set()}


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, toxic`` of at most ``sample`` different texts per label, and the number of different texts of each label."""
    marks = (
        labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    texts = (
        docs.filter(F.length("text") > 0).select("doc_id", F.xxhash64("text").alias("hash")).join(marks, "doc_id")
        .groupBy("toxic", "hash").agg(F.min("doc_id").alias("doc_id"))
    )
    counts = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    by_hash = Window.partitionBy("toxic").orderBy("hash", "doc_id")
    chosen = texts.withColumn("place", F.row_number().over(by_hash)).filter(F.col("place") <= sample)
    return chosen.select("doc_id", "toxic"), counts


def without_borrowed(kept: list, weight_toxic: float, weight_clean: float) -> list:
    """Without beginnings that owe their toxic texts to one longer feature.

    A beginning stays if the texts that its most frequent longer feature leaves over are toxic by themselves.
    """
    best: dict[str, tuple[int, int]] = {}
    out = []
    for r in sorted(kept, key=lambda r: (-len(r.feature.rstrip("*")), r.feature.endswith("*"))):
        stem = r.feature.rstrip("*")
        longer = best.get(stem) if r.feature.endswith("*") else None
        t, c = (r.t - longer[0], r.c - longer[1]) if longer else (r.t, r.c)
        if longer and (t < MIN_TOXIC or t * weight_toxic < MIN_PRECISION * (t * weight_toxic + (max(0, c) + 0.5) * weight_clean)):
            continue
        out.append(r)
        for k in (4, 5, 6):
            if k < len(stem) or k == len(stem) and not r.feature.endswith("*"):
                best[stem[:k]] = max(best.get(stem[:k], (0, 0)), (r.t, r.c))
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_features: int = FEATURES) -> ToxicityModel:
    """Learn the character model from all of ``docs`` and the features from its labelled rows."""
    small_batches(docs.sparkSession)
    costs = trigram_costs(trigram_counts(docs))
    chosen, counts = training_rows(docs, labels, sample)
    n_toxic, n_clean = min(sample, counts.get(1, 0)), min(sample, counts.get(0, 0))
    if not n_toxic:
        return ToxicityModel(costs)
    # A clean text of the sample stands for as many as were left out; so does a toxic one.
    weight_toxic, weight_clean = counts[1] / n_toxic, counts.get(0, 0) / max(1, n_clean)

    def count(batches):
        reader = Reader(costs)
        found: Counter = Counter()
        flush = lambda: pd.DataFrame([(f, t, n) for (f, t), n in found.items()], columns=["feature", "toxic", "n"])
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found.update((f, toxic) for f in text_features(reader.words(text.lower())))
            if len(found) > FORGET_WORDS:
                yield flush()
                found.clear()
        yield flush()

    # At most 2 x sample ids: broadcast whatever the corpus' size.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    seen = (
        texts.select("text", "toxic").mapInPandas(count, "feature string, toxic int, n long")
        .groupBy("feature").agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"),
        )
        .filter(F.col("t") >= MIN_TOXIC)
    )
    seen = stage(seen, "toxicity-features")
    # The more features are tried, the more significant one must be: about one in all is kept by chance.
    least_g2 = 2 * math.log(max(2, seen.count())) + 2
    # Expected and observed numbers of toxic texts among those that hold the feature.
    t, n = F.col("t"), F.col("t") + F.col("c")
    rate = n_toxic / (n_toxic + n_clean)
    g2 = 2 * (t * F.log(t / (n * rate)) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (n * (1 - rate)))).otherwise(0.0))
    share = t * weight_toxic / (t * weight_toxic + (F.col("c") + 0.5) * weight_clean)
    kept = (
        seen.withColumn("g2", g2).withColumn("share", share)
        .filter((F.col("share") >= MIN_PRECISION) & (F.col("g2") >= least_g2))
        .orderBy(F.desc("g2"), "feature").limit(max_features).collect()
    )
    model = ToxicityModel(costs, {r.feature: min(0.99, r.share) for r in without_borrowed(kept, weight_toxic, weight_clean)}, 0.0)
    missed = texts.select("toxic", (toxicity(F.col("text"), model) == 0).alias("bare")).filter("bare").groupBy("toxic").agg(F.count("*").alias("n"))
    bare = {r.toxic: r.n for r in missed.collect()}
    model.rest = bare.get(1, 0) * weight_toxic / max(1.0, bare.get(1, 0) * weight_toxic + bare.get(0, 0) * weight_clean)
    model.rest = min(model.rest, 0.49)
    return model


def toxicity(text: Column, model: ToxicityModel) -> Column:
    """Score of a text, 0 to 1."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return score(text)


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    small_batches(docs.sparkSession)
    scored = docs.withColumn("score", toxicity(F.col("text"), model))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that a model fitted on ``labels`` does not reject, columns as they were."""
    model = fit(docs, labels)
    return docs.filter(F.coalesce(toxicity(F.col("text"), model) < 0.5, F.lit(True)))


def op2_toxicity(spark, sf_dir):
    """Toxicity of every whole text, learnt without the held-out labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
