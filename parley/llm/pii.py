"""Personal data: fixed patterns, and terms that disclose what they found.

Emails, addresses, card and phone numbers found by fixed patterns are the
*protected entities*. A term of the same document may give one away. How much is
measured on the corpus: with N documents, n(e) of them holding entity e, n(t)
holding term t, and n(e, t) holding both,

    pmi(e, t) = log2(n(e, t) N / (n(e) n(t)))      ic(e) = log2(N / n(e))

and the disclosure of e by t is pmi / ic, 1 if t occurs only in documents of e. Terms at
or above ``REMOVE_AT`` are removed, those at or above ``GENERALISE_AT`` are
replaced by a general word, wherever they stand in a document that holds e.

A pair counts if so many different texts would hardly show it by chance: of the
m pairs measured, at most ``CHANCE`` are expected to be seen in k of the n texts
of e if t fell on texts at random, by the bound C(n, k) (n(t) / N)^k of a binomial
tail. Copies of one text are no evidence. Two texts suffice where N exceeds 20 times the root of m. A pair
that one text alone shows is as likely as any other of its rare words, so it
never counts: an entity held by a single text has no disclosing term.

All counts cover all documents. Texts that hold entities are staged;
pairs are aggregated before they are shuffled, and a common entity or term is
spread over the pairs it forms. Nothing is collected but two counts.

A null text counts as empty. Repeated rows get equal results. Documents
without a protected entity have no spans. Columns of ``docs`` named ``base,
held, terms, row`` or ``text_hash`` are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import kept_aside, small_batches, table
from parley.staging import stage

KINDS = ("email", "ip", "card", "phone", "generalise", "remove")
CHANCE = 0.01
GENERALISE_AT, REMOVE_AT = 0.8, 0.95
#: Distinct words or pairs that a task counts before it hands them on.
COUNTED_WORDS = 100_000

# An address has one "@" behind a run of its class; searching for the "@" first is much faster.
_EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL_HEAD = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# A run of digits that fails from its first digit fails from all others.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W_]{3,}")


def _emails(text: str) -> list[tuple[int, int]]:
    found, free = [], 0
    for m in _EMAIL_TAIL.finditer(text):
        at, start = m.start(), m.start()
        # Look back in steps, so that a long run costs its length only once.
        while start > free and (head := _EMAIL_HEAD.search(text, max(free, start - 256), start)):
            start, full = head.start(), head.start() == max(free, start - 256)
            if not full:
                break
        if start < at:
            found.append((start, m.end()))
            free = m.end()
    return found


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's place, start, end) of each fixed match, by kind and start."""
    found = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m[0])) <= 15]
    return found


def held_terms(text: str, spans: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """(term, start, end) of all terms outside the fixed matches ``spans``."""
    parts, at = [], 0
    for start, end in sorted(spans):
        parts += [text[at:start], " " * (end - max(at, start))]
        at = max(at, end)
    return [(m[0].lower(), *m.span()) for m in _TERM.finditer("".join([*parts, text[at:]]))]


_SCAN = "base array<struct<kind:string,start:int,end:int>>, held array<string>"


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` (fixed matches) and ``held`` (the different entities)."""
    small_batches(docs.sparkSession)

    @F.pandas_udf(_SCAN)
    def find(texts: pd.Series) -> pd.DataFrame:
        base, held = [], []
        for text in texts:
            spans = base_spans(text)
            base.append([{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans])
            held.append(sorted({f"{KINDS[k]}:{text[s:e]}" for k, s, e in spans}))
        return pd.DataFrame({"base": base, "held": held})

    docs = docs.drop("base", "held")
    return docs.withColumn("_scan", find(F.coalesce("text", F.lit("")))).select("*", "_scan.base", "_scan.held").drop("_scan")


def _distinct_terms(text: str, base) -> set[str]:
    return {t for t, _, _ in held_terms(text, [(x["start"], x["end"]) for x in base])}


def term_documents(docs: DataFrame) -> DataFrame:
    """``term, n_term``: documents that hold each term."""

    def count(batches):
        counted: Counter = Counter()
        flush = lambda: pd.DataFrame({"term": list(counted), "n": list(counted.values())})
        for batch in batches:
            for text in batch["text"]:
                if text:
                    counted.update(set(_TERM.findall(text.lower())))
                if len(counted) > COUNTED_WORDS:
                    yield flush()
                    counted.clear()
        yield flush()

    return docs.select("text").mapInPandas(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosing_pairs(holding: DataFrame, docs: DataFrame, chance: float = CHANCE, threshold: float = GENERALISE_AT) -> DataFrame:
    """``entity, term, disclosure`` for the pairs at or above ``threshold`` that are no chance.

    ``holding`` needs ``text, text_hash, base, held`` of the rows with entities; ``docs`` needs ``text``.
    """
    # Copies are counted once per text.
    per_text = holding.groupBy("text_hash").agg(F.first(F.struct("text", "base", "held")).alias("t"), F.count("*").alias("n")).select("t.*", "n")

    def count(batches):
        copies, texts = Counter(), Counter()

        def flush():
            rows = [(e, t, n, texts[e, t]) for (e, t), n in copies.items()]
            copies.clear(), texts.clear()
            return pd.DataFrame(rows, columns=["entity", "term", "n_pair", "texts"])

        for batch in batches:
            for text, base, held, n in batch[["text", "base", "held", "n"]].itertuples(index=False):
                terms = _distinct_terms(text, base)
                for entity in held:
                    for term in terms:
                        copies[entity, term] += n
                        texts[entity, term] += 1
                    if len(copies) > COUNTED_WORDS:
                        yield flush()
        yield flush()

    counted = per_text.mapInPandas(count, "entity string, term string, n_pair long, texts long")
    pairs = stage(counted.groupBy("entity", "term").agg(F.sum("n_pair").alias("n_pair"), F.sum("texts").alias("texts")), "pii-pairs")
    entities = per_text.select(F.explode("held").alias("entity"), "n").groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count("*").alias("n_texts"))
    measured, total = F.lit(pairs.count()), F.lit(docs.count())
    pairs = pairs.filter("texts > 1")  # one text is never significant
    # Document counts are only needed of terms that stand beside an entity.
    terms = term_documents(docs).join(pairs.select("term").distinct(), "term", "left_semi")
    pmi = F.log2(F.col("n_pair") * total / (F.col("n_entity") * F.col("n_term")))
    k, n = F.col("texts"), F.col("n_texts")
    ways = F.when(k == n, 0.0).otherwise(k * (1 + F.log(n / k)))  # C(n, k) <= (e n / k)^k
    return (
        pairs.join(entities, "entity").join(terms, "term")
        .filter(F.log(measured) + ways + k * F.log(F.col("n_term") / total) <= F.log(F.lit(chance)))
        .withColumn("disclosure", F.when(F.col("n_entity") < total, pmi / F.log2(total / F.col("n_entity"))))
        .filter(F.col("disclosure") >= threshold)
        .select("entity", "term", "disclosure")
    )


def disclosure_spans(
    docs: DataFrame, chance: float = CHANCE, generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT,
) -> DataFrame:
    """``docs`` without ``text``, with ``base`` and ``terms``: array of ``kind, start, end``, kind generalise or remove."""
    # Rows are numbered once, in a table: document ids may repeat or be missing.
    rows = stage(
        scan(docs).withColumn("text_hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
        .withColumn("text", F.when(F.size("held") > 0, F.col("text"))),
        "pii-scan",
    )
    holding = rows.filter(F.size("held") > 0).select("row", "text_hash", "text", "base", "held")
    flagged = stage(disclosing_pairs(holding, docs, chance, generalise_at), "pii-flagged")

    def pairs(batches):
        for batch in batches:
            for row, text, base, held in batch[["row", "text", "base", "held"]].itertuples(index=False):
                terms = sorted(_distinct_terms(text, base))
                for entity in held:
                    yield pd.DataFrame({"row": row, "entity": entity, "term": terms}).astype({"term": object})

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def place(texts: pd.Series, base: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for text, own, terms in zip(texts, base, found):
            told = {x["term"]: x["disclosure"] for x in terms} if terms is not None else {}
            spans = held_terms(text, [(x["start"], x["end"]) for x in own]) if told else []
            out.append([{"kind": "remove" if told[t] >= remove_at else "generalise", "start": s, "end": e} for t, s, e in spans if t in told])
        return pd.Series(out, dtype=object)

    told = (
        holding.mapInPandas(pairs, "row long, entity string, term string").join(flagged, ["entity", "term"])
        .groupBy("row", "term").agg(F.max("disclosure").alias("disclosure"))
        .groupBy("row").agg(F.collect_list(F.struct("term", "disclosure")).alias("_told"))
    )
    placed = rows.join(told, "row", "left").withColumn("terms", place("text", "base", "_told"))
    return placed.drop("row", "text_hash", "text", "held", "_told")


def sanitise_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with protected entities masked, disclosing terms generalised or removed in ``text``.

    A sanitised text carries spans of its own row, so the text travels with them.
    """

    @F.pandas_udf("string")
    def apply(texts: pd.Series, base: pd.Series, terms: pd.Series) -> pd.Series:
        out = []
        for text, *found in zip(texts, base, terms):
            spans = sorted((x["start"], x["end"], x["kind"]) for xs in found for x in xs)
            parts, at = [], 0
            for start, end, kind in spans:
                if start >= at:
                    word = text[start:end]
                    general = "[number]" if word.isdigit() else "[name]" if word[:1].isupper() else "[term]"
                    parts += [text[at:start], "" if kind == "remove" else general if kind == "generalise" else f"[{kind.upper()}]"]
                at = max(at, end)
            out.append(text if text is None else "".join([*parts, text[at:]]))
        return pd.Series(out, dtype=object)

    spans = disclosure_spans(kept_aside(docs, "text"), **options)
    cleaned = spans.withColumn("_text", apply("_row.text", "base", "terms"))
    return cleaned.select(*[F.col("_text").alias("text") if c == "text" else F.col(f"_row.{c}") for c in docs.columns])


def op10_personal_data(spark, sf_dir):
    """Personal data and disclosing terms in every whole text."""
    found = disclosure_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_terms long")
    def digest(base: pd.Series, terms: pd.Series) -> pd.DataFrame:
        out = []
        for b, t in zip(base, terms):
            spans = sorted((KINDS.index(x["kind"]), x["start"], x["end"]) for xs in (b, t) for x in xs)
            told = [f"{KINDS[k]}:{s}:{e}" for k, s, e in spans]
            joined = ",".join(told[: len(b)])
            n = [sum(x[0] == k for x in spans) for k in range(4)]
            out.append((*n, hashlib.sha256(joined.encode()).hexdigest(), ",".join(told), len(t)))
        return pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_terms"])

    return found.select("doc_id", digest("base", "terms").alias("d")).select("doc_id", "d.*")
