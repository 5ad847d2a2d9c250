"""Language ID by rank-order profiles.

A language's profile ranks its PROFILE most frequent n-grams (1 to 3 letters,
words padded with a blank).  A document is compared by the out-of-place
distance of its own PROFILE most frequent n-grams: the sum of rank
differences, PROFILE for an n-gram that the profile lacks.

n-grams are hashed into CODES codes (a documented, fixed bound), so any script
works and counts are small arrays.  The counts of all labelled training
documents are summed in Spark; only the profiles, at most PROFILE rows a
language, come to the driver.

Ties: equal counts rank by code, equal distances go to the first language in
alphabetical order.  Defined cases: null text, or none of its characters a
letter: ``und`` with score 0; null lang: not learned from; a null doc_id
counts as empty text for the split; repeated rows each count and are judged
alike; without any profile all is ``und``; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import bounded_batches, id_and_text, id_crc, map_arrow, map_rows, table

PROFILE = 400
CODE_BITS = 18
CODES = 1 << CODE_BITS
FOLDS, HELD_OUT = 5, 0
#: A document is rejected in the pipeline when its score is below this, or it has no letter.
MIN_SCORE = 0.02

_TABLE: np.ndarray | None = None


def letters() -> np.ndarray:
    """Code point -> its lower-case letter, or 32 where it is no letter (Unicode category L); made on the driver and sent to the tasks (4 MB)."""
    global _TABLE
    if _TABLE is None:
        import unicodedata

        out = np.full(0x110000, 32, dtype=np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if unicodedata.category(x)[0] == "L":
                low = x.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _TABLE = out
    return _TABLE


def codes_of(text: str | None, letter: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of the text, n = 1 to 3, with repeats; empty without a letter."""
    if not text:
        return np.empty(0, np.uint32)
    c = letter[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    c = np.concatenate((np.array([32], np.uint32), c, np.array([32], np.uint32)))
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    c = c[keep]
    if len(c) < 3:
        return np.empty(0, np.uint32)
    blank = c == 32
    x = c * np.uint32(0x9E3779B1)
    one = x[~blank]
    two = x[:-1] * np.uint32(0x85EBCA6B) + x[1:] ^ np.uint32(0x27D4EB2F)
    three = (x[:-2] * np.uint32(0x85EBCA6B) + x[1:-1]) * np.uint32(0xC2B2AE35) + x[2:] ^ np.uint32(0x165667B1)
    three = three[~blank[1:-1]]
    return np.concatenate((one, two, three)) * np.uint32(0x9E3779B1) >> np.uint32(32 - CODE_BITS)


def ranked(codes: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent codes, most frequent first, equal counts by code."""
    codes = np.sort(codes)
    edge = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    counts = np.diff(np.append(edge, len(codes)))
    return codes[edge][np.argsort(-counts, kind="stable")[:most]]


def profiles(docs: DataFrame, most: int = PROFILE) -> dict[str, list[int]]:
    """Language -> its ranked codes, from text and non-null lang of the training documents."""
    bounded_batches(docs.sparkSession)
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"))
    d = d.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.pmod(id_crc(F.col("doc_id")), F.lit(FOLDS)) != HELD_OUT)).select("lang", "text")

    letter = letters()

    def count(batches):
        import pyarrow as pa

        held: dict[str, np.ndarray] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        size = 0

        def settle():
            for lang, parts in waiting.items():
                held.setdefault(lang, np.zeros(CODES, np.int64))
                held[lang] += np.bincount(np.concatenate(parts), minlength=CODES)
            waiting.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                codes = codes_of(text.as_py(), letter)
                waiting.setdefault(lang, []).append(codes)
                size += len(codes)
                if size > 2_000_000 or len(waiting) > 64:
                    settle()
                    size = 0
                    if len(held) > 64:  # bounds the memory; partial counts may leave early
                        yield from _rows(held, pa)
                        held.clear()
        settle()
        yield from _rows(held, pa)

    sums = map_arrow(d, count, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), F.asc("code")]
    for part in (["lang", "slice"], ["lang"]):  # a first cut by slices keeps the second small
        sums = sums.withColumn("slice", F.col("code") % 64).withColumn("r", F.row_number().over(W.partitionBy(*part).orderBy(*order))).where(F.col("r") <= most)
    found: dict[str, list[tuple[int, int]]] = {}
    for r in sums.select("lang", "r", "code").collect():
        found.setdefault(r["lang"], []).append((r["r"], r["code"]))
    return {lang: [c for _, c in sorted(rows)] for lang, rows in sorted(found.items())}


def _rows(held, pa):
    for lang, counts in held.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["lang", "code", "n"])


class Judge:
    def __init__(self, known: dict[str, list[int]], letter: np.ndarray, most: int = PROFILE):
        self.most, self.langs, self.letter = most, list(known), letter
        self.place = np.full((CODES, max(1, len(known))), -1, np.int16)
        for k, codes in enumerate(known.values()):
            self.place[codes, k] = np.arange(len(codes))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: how far, of the way from the worst distance to none, the best language lies, times its lead over the next."""
        codes = codes_of(text, self.letter)
        if not len(codes) or not self.langs:
            return "und", 0.0
        mine = ranked(codes, self.most)
        theirs = self.place[mine]
        away = np.where(theirs < 0, self.most, np.abs(theirs - np.arange(len(mine))[:, None]))
        total = away.sum(axis=0)
        best = int(total.argmin())
        rest = np.delete(total, best)
        lead = 1.0 if not len(rest) else 1 - total[best] / rest.min() if rest.min() else 0.0
        near = 1 - total[best] / (self.most * len(mine))
        return self.langs[best], float(min(1.0, max(0.0, (near * (0.5 + 0.5 * lead)))))


def identify(docs: DataFrame, known: dict[str, list[int]] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    known = profiles(docs) if known is None else known

    letter = letters()

    def make():
        judge = Judge(known, letter)

        def work(rows):
            got = [judge.predict(t) for t in rows["text"]]
            ids = ["" if i is None else str(i) for i in rows["doc_id"]]
            return {"doc_id": rows["doc_id"], "held_out": [zlib.crc32(i.encode()) % FOLDS == HELD_OUT for i in ids], "lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

        return work

    return map_rows(id_and_text(docs), make, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents, all columns, whose language is known: with a letter and a score of min_score or more."""
    known = profiles(docs)
    schema = docs.schema
    at, letter = docs.columns.index("text"), letters()

    def keep(batches):
        import pyarrow as pa

        judge = Judge(known, letter)
        for batch in batches:
            got = [judge.predict(t.as_py()) for t in batch.column(at)]
            yield batch.filter(pa.array([g[0] != "und" and g[1] >= min_score for g in got], pa.bool_()))

    return map_arrow(docs, keep, schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
