"""Quality rules as a short-circuit cascade.

Every rule rejects a document by one integer comparison.  Before the scan each
rule's cost (seconds a document) and selectivity (share it rejects) are
estimated on a bounded sample, the SAMPLE_ROWS documents of the least hashes
(equal rows count once), by a task; rules then run by rejection per cost, highest first, and a document
leaves the cascade at the first rule that rejects it.  Counts that the result
lists are worked out for every document anyway and cost a rule nothing; where
only the verdict is wanted (keep_good) each count is worked out when a rule
first asks for it, and priced so.  The order changes the time only, never the
verdict, because a document is kept exactly when no rule rejects it.

Defined cases: a null text has no words (and fails the base rule); a null
doc_id is kept; repeated rows get equal verdicts; an empty table gives no rows.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, least_hashed, map_arrow, map_rows, table

#: Rows of the sample that sets the order of the rules.
SAMPLE_ROWS = 256

SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOL = bytes(c for c in range(256) if c not in SYMBOLS)
_CONTINUED = bytes(range(0x80, 0xC0))
_NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
_NOT_LETTER = bytes(c for c in range(256) if not (65 <= c <= 90 or 97 <= c <= 122))
_HAS_LETTER = re.compile(rb"[A-Za-z\x80-\xFF]")


class Doc:
    """A text and what rules ask of it, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.raw = (text or "").encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def word_chars(self) -> int:
        joined = b"".join(self.words)
        return len(joined.translate(None, _CONTINUED)) if not joined.isascii() else len(joined)

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw.translate(None, _NOT_SYMBOL))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:], strict=False))
        counts = Counter(windows)
        if len(counts) == len(windows):
            return 0
        total, covered = 0, 0
        for i, x in enumerate(windows):
            if counts[x] > 1:
                total += i + 3 - max(i, covered)
                covered = i + 3
        return total

    @cached_property
    def upper(self) -> int:
        return len(self.raw.translate(None, _NOT_UPPER))

    @cached_property
    def letters(self) -> int:
        return len(self.raw.translate(None, _NOT_LETTER))

    @cached_property
    def n_plain(self) -> int:
        """Words with a letter."""
        return sum(1 for w in self.words if _HAS_LETTER.search(w))


#: name -> whether the rule rejects
RULES: dict[str, Callable[[Doc], bool]] = {
    "few_words": lambda d: len(d.words) < 50,
    "repeated_windows": lambda d: 100 * d.n_repeat_words > 50 * len(d.words),
    "symbols": lambda d: 10 * d.n_symbols > len(d.words),
    "repeated_lines": lambda d: d.n_dup_lines >= 3 and 100 * d.n_dup_lines > 30 * len(d.lines),
    "word_length": lambda d: d.word_chars < 2 * len(d.words) or d.word_chars > 16 * len(d.words),
    "capitals": lambda d: 100 * d.upper > 50 * d.letters,
    "no_letters": lambda d: 100 * d.n_plain < 70 * len(d.words),
}


#: Counts that the result lists.
LISTED = ("words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(texts: list[str | None], rules=RULES, listed: tuple[str, ...] = LISTED, repeats: int = 3) -> dict[str, tuple[int, float]]:
    """Rule -> (documents rejected, seconds), the least time of a few; listed counts are there before a rule is timed."""
    out = {}
    for name, rule in rules.items():
        took, rejected = float("inf"), 0
        for _ in range(repeats):
            docs = [Doc(t) for t in texts]
            for d in docs:
                for count in listed:
                    getattr(d, count)
            began = time.perf_counter()
            rejected = sum(map(rule, docs))
            took = min(took, time.perf_counter() - began)
        out[name] = (rejected, took)
    return out


def cascade_order(measured: dict[str, tuple[int, float]]) -> list[str]:
    """Rule names by rejection per cost; ties in the order given."""
    gain = {n: rejected / max(1e-9, took) for n, (rejected, took) in measured.items()}
    return sorted(measured, key=lambda n: -gain[n])


def sample_order(d: DataFrame, rules=RULES, listed: tuple[str, ...] = LISTED, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """The order that the sample gives; one row a rule comes to the driver."""
    import pyarrow as pa

    def run(batches):
        texts = [t for batch in batches for t in batch.column(0).to_pylist()]
        got = measure(texts, rules, listed)
        yield pa.RecordBatch.from_arrays([pa.array(list(got)), pa.array([v[0] for v in got.values()]), pa.array([float(v[1]) for v in got.values()])], names=["rule", "rejected", "took"])

    picked = least_hashed(d, sample_rows, d.count())
    got = {r[0]: (r[1], r[2]) for r in map_arrow(picked.coalesce(1), run, "rule string, rejected long, took double").collect()}
    return cascade_order({n: got.get(n, (0, 1.0)) for n in rules})


def judge(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and the first rule of the cascade that rejects (not stable between runs where several do)."""
    d = id_and_text(docs)
    order = sample_order(d, rules, LISTED, sample_rows)

    def make():
        run = [(n, rules[n]) for n in order]

        def work(rows):
            docs = [Doc(t) for t in rows["text"]]
            first = [next((n for n, rule in run if rule(x)), None) for x in docs]
            return {
                "doc_id": rows["doc_id"],
                "n_words": [len(x.words) for x in docs],
                "word_chars": [x.word_chars for x in docs],
                "n_symbols": [x.n_symbols for x in docs],
                "n_dup_lines": [x.n_dup_lines for x in docs],
                "n_repeat_words": [x.n_repeat_words for x in docs],
                "rejected_by": first,
            }

        return work

    got = map_rows(d, make, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, rejected_by string")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return got.select("*", failed.alias("base_failed"), (~failed & F.col("rejected_by").isNull()).alias("kept"))


def keep_good(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents, all columns, that no rule rejects; a document costs no more than the rules up to its first rejection."""
    import pyarrow as pa

    order, at = sample_order(id_and_text(docs), rules, (), sample_rows), docs.columns.index("text")

    def run(batches):
        held = [rules[n] for n in order]
        for batch in batches:
            yield batch.filter(pa.array([not any(rule(d) for rule in held) for d in map(Doc, (t.as_py() for t in batch.column(at)))], pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("rejected_by")


ORACLE = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT rid, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS x
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid
), f AS (
  SELECT w.rid, doc_id, text, words, lines, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * len(lines))
            OR word_chars < 2 * n_words OR word_chars > 16 * n_words
            OR 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 50 * length(regexp_replace(text, '[^A-Za-z]', '', 'g'))
            OR 100 * len(list_filter(words, lambda x: regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) < 70 * n_words) AS kept
FROM f
"""
