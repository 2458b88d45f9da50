"""Secret scan: fixed patterns and automata inferred from what they label.

The fixed patterns find credentials of three kinds in every text and label
them. A sample of the distinct labelled values of each kind (at most
``SAMPLE`` per kind, the first by hash, none longer than ``SAMPLE_CHARS``)
trains one probabilistic automaton per kind. All other tokens of 12 or more characters of all
texts are candidates, also those of which a fixed match is only a part, and where a token is
not reported, its parts beside dots and equals signs; one is reported if an automaton explains its format much
better than the corpus's own class-pair statistics of such tokens, which are
counted over all documents.

Texts are scanned whole, twice: once for labels and statistics, once for
spans. Only the sample and the class-pair counts (at most 18 x 18 rows) reach
the driver.

A null text counts as empty and has no span. Repeated rows get equal results.
Columns of ``docs`` named like an added one are replaced. Without labelled
values there are no automata and only fixed patterns report.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.automata import Automaton, CLASS_SIZE, classes, infer
from parley.llm.common import small_batches, table

KINDS = ("assign", "access", "hex", "format")
SAMPLE = 400
SAMPLE_CHARS = 128
#: Bits by which a candidate's format must be likelier than under the corpus: per character and in total.
BITS_PER_CHAR, BITS = 0.5, 12.0

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# Runs of these classes have no other reading, so the length can stand in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
# The alphabet and least length of the values that an assignment labels, and the parts of such a token.
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{12,}")
_PART = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}={0,2}")


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind's place, end, start of the secret) of each fixed match, in order."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidate_spans(text: str, base: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Long tokens, without their outer dots, that no fixed match covers.

    Assignments are tokens of their own; what stands in front of one is read by itself.
    """
    assigned = [(b[0], b[2]) for b in base if b[1] == 0]
    spans = []
    for m in _CANDIDATE.finditer(text):
        start, last = m.span()
        for s, e in [x for x in assigned if x[0] < last and x[1] > start] + [(last, last)]:
            end = min(s, last)
            while start < end and text[start] in ".=":
                start += 1
            while start < end and text[end - 1] == ".":
                end -= 1
            if end - start >= 12:
                spans.append((start, end))
            start = max(start, e)
    return [(s, e) for s, e in spans if not any(b[0] <= s and e <= b[2] for b in base)]


@dataclass
class FormatModel:
    """One automaton per kind and the class-pair statistics of ordinary long tokens."""

    machines: dict[str, Automaton] = field(default_factory=dict)
    pairs: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.after: Counter = Counter()
        for pair, n in self.pairs.items():
            self.after[pair[0]] += n

    def background(self, token: str) -> float:
        """Log-likelihood in bits under the pair statistics, with one added to each count."""
        symbols = "^" + classes(token)
        return sum(
            math.log2((self.pairs.get(a + b, 0) + 1) / (self.after[a] + 18) / CLASS_SIZE.get(b, 1))
            for a, b in zip(symbols, symbols[1:])
        )

    def gain(self, token: str) -> float:
        """Bits that the best automaton explains better than the corpus does."""
        best = max((m.loglik(token) for m in self.machines.values()), default=-math.inf)
        return best - self.background(token) if best > -math.inf else best

    def accepts(self, token: str) -> bool:
        return self.gain(token) >= max(BITS, BITS_PER_CHAR * len(token))

    def spans(self, text: str) -> list[tuple[int, int, int, int]]:
        """All spans of a text, as ``base_spans`` gives them."""
        base = base_spans(text)
        added = []
        for s, e in candidate_spans(text, base):
            if self.accepts(text[s:e]):
                added.append((s, 3, e, s))
                continue
            # A credential may be a part of a token ("name=value", "file.value").
            parts = [m.span() for m in _PART.finditer(text, s, e)]
            parts = [x for x in parts if x != (s, e) and not any(b[0] <= x[0] and x[1] <= b[2] for b in base)]
            added += [(x, 3, y, x) for x, y in parts if self.accepts(text[x:y])]
        return sorted(base + added) if added else base


def labels_and_pairs(docs: DataFrame) -> DataFrame:
    """``what, value, n``: distinct labelled values of each kind, and class pairs of the candidates."""

    def scan(batches):
        for batch in batches:
            found: Counter = Counter()
            for text in batch["text"]:
                if not text:
                    continue
                base = base_spans(text)
                found.update((KINDS[k], text[secret:end]) for _, k, end, secret in base)
                for s, e in candidate_spans(text, base):
                    if any(b[0] < e and b[2] > s for b in base):
                        continue  # holds a credential
                    symbols = "^" + classes(text[s:e])
                    found.update(("pair", a + b) for a, b in zip(symbols, symbols[1:]))
            yield pd.DataFrame([(w, v, n) for (w, v), n in found.items()], columns=["what", "value", "n"])

    return docs.select("text").mapInPandas(scan, "what string, value string, n long").groupBy("what", "value").agg(F.sum("n").alias("n"))


def learn_formats(docs: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> FormatModel:
    """Automata of the labelled values in ``docs`` and its class-pair counts."""
    small_batches(docs.sparkSession)
    by_hash = Window.partitionBy("what").orderBy(F.xxhash64("value"), "value")
    rows = (
        labels_and_pairs(docs)
        .filter((F.col("what") == "pair") | (F.length("value") <= sample_chars))
        .withColumn("place", F.row_number().over(by_hash))
        .filter(F.col("place") <= sample)  # there are at most 18 x 18 pairs
        .collect()
    )
    values: dict[str, list[str]] = {}
    for r in rows:
        if r.what != "pair":
            values.setdefault(r.what, []).append(r.value)
    return FormatModel({k: infer(v) for k, v in sorted(values.items())}, {r.value: r.n for r in rows if r.what == "pair"})


def secret_spans(text: Column, model: FormatModel) -> Column:
    """Array of ``kind, start, end, secret_start`` (code points, end exclusive)."""

    @F.pandas_udf("array<struct<kind:string,start:int,end:int,secret_start:int>>")
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": KINDS[k], "start": s, "end": e, "secret_start": x} for s, k, e, x in model.spans(t)] for t in texts], dtype=object)

    return find(F.coalesce(text, F.lit("")))


def scan_documents(docs: DataFrame, model: FormatModel | None = None) -> DataFrame:
    """``docs`` with ``secrets``, the spans of ``secret_spans``."""
    return docs.withColumn("secrets", secret_spans(F.col("text"), model or learn_formats(docs)))


def redact_documents(docs: DataFrame, mark: str = "[SECRET]", model: FormatModel | None = None) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark``; the key word of an assignment stays."""
    model = model or learn_formats(docs)

    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            spans = model.spans(text) if text else []
            if spans:
                parts, at = [], 0
                for start, end in sorted((x, e) for _, _, e, x in spans):
                    if start >= at:
                        parts += [text[at:start], mark]
                    at = max(at, end)
                text = "".join([*parts, text[at:]])
            out.append(text)
        return pd.Series(out, dtype=object)

    return docs.withColumn("text", redact("text"))


def op5_secret_scan(spark, sf_dir):
    """Spans of secrets in every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn_formats(docs)

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long")
    def digest(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            spans = model.spans(text)
            told = [f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans]
            base = ",".join(t for t, x in zip(told, spans) if x[1] < 3)
            n = [sum(x[1] == k for x in spans) for k in range(4)]
            out.append((*n[:3], hashlib.sha256(base.encode()).hexdigest(), ",".join(told), n[3]))
        return pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"])

    return docs.select("doc_id", digest(F.coalesce("text", F.lit(""))).alias("d")).select("doc_id", "d.*")
