"""BPE encoding and decoding over a distinct-word table.

1. Texts are split into words exactly as the tokenizer's normalizer and
   pre-tokenizer do (a word never crosses white space); counts of distinct
   words are summed in Spark.
2. Each distinct word is encoded once.
3. Decoding joins the ids of the distinct words with the id-to-piece table (a
   broadcast join in Spark: the vocabulary is a fixed bound); a word's pieces
   are put together in order.
4. Ids and decoded pieces return to the documents by place: frequent words from
   the bounded top table, the others through their number in the chunk's list.

A text of characters below U+0250 is split by an expression over their
classes; any other text by the tokenizer's own components.  Special tokens in
a text become their own ids, as in the library.

The tokenizer file is a parameter, read on the driver.  Its parts must be those
that the splitter stands for (see check_spec), else a ValueError tells which
one is not; vocabulary and merges are free.  Defined cases: a null text is empty and
has no tokens; a null doc_id is kept; repeated rows give equal rows; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, id_and_text, map_arrow, table, tidy_groups
from .wordtable import FLUSH, TOP, Numbers, chunk_ids, chunks, listed, pack, pack_words, rows, top_words, unpack

#: Characters that the quick splitter handles: their classes and case are the same in every Unicode version.
_UNSAFE = re.compile("[^\\x00-\\x1b\\x20-įı-ɏ]")
_CLASS = {c: re.escape("".join(chr(x) for x in range(0x250) if unicodedata.category(chr(x))[0] == c)) for c in "LN"}
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_CLASS['L']}]+|[{_CLASS['N']}]|[^\s{_CLASS['L']}{_CLASS['N']}]+")


#: What the splitter, the quick expression and the decoding stand for.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
EXPECTED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "decoder": None,
}


def check_spec(spec: str) -> None:
    """Raises ValueError for a tokenizer of other parts: another normalizer, pre-tokenizer, decoder or model, or added tokens that are not plain."""
    s = json.loads(spec)
    wrong = [k for k, v in EXPECTED.items() if s.get(k) != v]
    model = s.get("model", {})
    if model.get("type") != "BPE" or model.get("dropout"):
        wrong.append("model")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in s.get("added_tokens", [])):
        wrong.append("added_tokens")
    if wrong:
        raise ValueError(f"a tokenizer with other parts than expected: {', '.join(wrong)}")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level pieces: printable bytes are themselves, the others follow from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, more = [""] * 256, 256
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b], more = chr(more), more + 1
    return out


class Splitter:
    """Words of a text.  A special token is a word with a blank before it, which no other word has."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_str(spec)
        self.special = {t["content"]: t["id"] for t in json.loads(spec)["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        split = json.loads(spec)["pre_tokenizer"]["pretokenizers"][0]
        from tokenizers import Regex

        self.split = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), split["behavior"].lower(), split["invert"])
        self.letters = byte_letters()

    def quick(self, text: str) -> bool:
        return not _UNSAFE.search(text) and not (self.cut and self.cut.search(text))

    def runs(self, text: str) -> list[str]:
        """Lower-case runs between white space, of a quick text."""
        return text.lower().split()

    def slow(self, text: str) -> list[str]:
        out: list[str] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(" " + part)
            elif part:
                out += [w for w, _ in self.split.pre_tokenize_str(self.tok.normalizer.normalize_str(part))]
        return out

    def encode(self, word: str) -> list[int]:
        if word[0] == " ":
            return [self.special[word[1:]]]
        return [t.id for t in self.tok.model.tokenize("".join([self.letters[b] for b in word.encode()]))]


def _count(spec: str):
    def run(batches):
        split = Splitter(spec)
        runs: Counter = Counter()
        words: Counter = Counter()

        def out():
            for run, n in runs.items():
                for w in _PIECES.findall(run):
                    words[w] += n
            runs.clear()
            got = pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])
            words.clear()
            for at in range(0, got.num_rows, 50_000):
                yield got.slice(at, 50_000)

        for _, text in rows(batches):
            if split.quick(text):
                runs.update(split.runs(text))
            else:
                words.update(split.slow(text))
            if len(runs) + len(words) > FLUSH:
                yield from out()
        yield from out()

    return run


def id_to_piece(spark: SparkSession, spec: str) -> DataFrame:
    """id and piece: the vocabulary and the added tokens."""
    s = json.loads(spec)
    made = {i: p for p, i in s["model"]["vocab"].items()} | {t["id"]: t["content"] for t in s["added_tokens"]}
    return spark.createDataFrame(pa.table({"id": pa.array(made, pa.int32()), "piece": pa.array(made.values(), pa.string())}))


def id_type(spec: str) -> str:
    """Bytes of an id: two where the vocabulary allows."""
    s = json.loads(spec)
    return "<u2" if max([*s["model"]["vocab"].values(), *(t["id"] for t in s["added_tokens"])]) < 1 << 16 else "<u4"


def word_table(docs: DataFrame, spec: str) -> DataFrame:
    """word, n, code (ids as numbers of id_type) and text (decoded pieces, joined by a blank) of every distinct word, each encoded once."""

    kind = id_type(spec)

    def encode(batches):
        split = Splitter(spec)
        for batch in batches:
            ids = [np.array(split.encode(w), kind) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([i.tobytes() for i in ids], pa.binary()), pa.array(ids, pa.list_(pa.int32()))], names=["word", "n", "code", "ids"])

    words = map_arrow(docs, _count(spec), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    coded = map_arrow(words, encode, "word string, n long, code binary, ids array<int>")
    each = coded.select("word", "n", "code", F.posexplode("ids").alias("at", "id")).join(F.broadcast(id_to_piece(docs.sparkSession, spec)), "id")
    pieces = F.array_sort(F.collect_list(F.struct("at", "piece")))  # of one word
    return each.groupBy("word").agg(F.first("n").alias("n"), F.first("code").alias("code"), F.array_join(F.transform(pieces, lambda x: x["piece"]), " ").alias("text"))


_CHUNK = "chunk long, doc_ids array<long>, lens binary, codes binary, words binary"


class Runs(Numbers):
    """Numbers the distinct runs of a chunk and keeps the codes of their words: below len(top) a frequent word, above it a word of the chunk's list."""

    def __init__(self, top: dict[str, int]):
        self.top, self.local, self.flat, self.ends = top, Numbers(), [], [0]

    def add(self, words: list[str]) -> None:
        for w in words:
            k = self.top.get(w)
            self.flat.append(len(self.top) + self.local[w] if k is None else k)
        self.ends.append(len(self.flat))

    def __missing__(self, run):
        self[run] = n = len(self)
        self.add(_PIECES.findall(run))
        return n

    def word(self, w: str) -> int:
        """The number of a word that came from the tokenizer's own splitter, apart from all runs."""
        key = (w,)
        if key not in self:
            self[key] = len(self)
            self.add([w])
        return dict.__getitem__(self, key)


#: Characters of a chunk, and words of the top table, where ids and texts are given in full; where only their digests are, both may be larger.
FULL_CHARS, FULL_TOP = 2_000_000, TOP // 4


def _pack_chunks(spec: str, top: dict[str, int], most: int | None):
    def run(batches):
        split = Splitter(spec)
        for chunk, held in zip(chunk_ids(), chunks(rows(batches), lambda r: len(r[1]), most), strict=False):
            runs, places, lens = Runs(top), [], []
            for _, text in held:
                places.append(runs.of(split.runs(text)) if split.quick(text) else np.array([runs.word(w) for w in split.slow(text)], np.int64))
            flat, ends = np.array(runs.flat, np.int64), np.array(runs.ends, np.int64)
            many = np.diff(ends)
            codes = []
            for p in places:
                n = many[p]
                total = int(n.sum())
                lens.append(total)
                codes.append(flat[np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[p], n)])
            yield pa.RecordBatch.from_pydict(
                {"chunk": pa.array([chunk], pa.int64()), "doc_ids": pa.array([[r[0] for r in held]], pa.list_(pa.int64())), "lens": pa.array([pack(np.array(lens, np.int64))], pa.binary()),
                 "codes": pa.array([pack(np.concatenate(codes))], pa.binary()), "words": pa.array([pack_words(list(runs.local))], pa.binary())}
            )

    return run


def _shown(codes: list[bytes], kind: str) -> list[str]:
    return [" ".join(map(str, np.frombuffer(c, kind).tolist())) for c in codes]


def _counted(codes: list[bytes], kind: str) -> np.ndarray:
    return np.array([len(c) // int(kind[-1]) for c in codes], np.int64)


def _assemble(top_ids: list[str], top_texts: list[str], top_sizes: np.ndarray, kind: str, full: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        order = pa.array(right.column("at").to_numpy().argsort())
        mine = right.column("code").take(order).to_pylist()
        ids, texts, sizes = top_ids + _shown(mine, kind), top_texts + right.column("text").take(order).to_pylist(), np.concatenate((top_sizes, _counted(mine, kind)))
        del mine, right
        lens, codes = unpack(left.column("lens")[0].as_py()), unpack(left.column("codes")[0].as_py())
        if int(codes.max(initial=-1)) >= len(ids):
            raise RuntimeError("a chunk's words and their ids differ; the input changed between two reads")
        out: dict[str, list] = {n: [] for n in schema.names}
        at = 0
        digest = (lambda s: s) if full else (lambda s: hashlib.sha256(s.encode()).hexdigest())
        for doc_id, n in zip(left.column("doc_ids")[0].as_py(), lens.tolist(), strict=True):
            code = codes[at : at + n]
            at += n
            few = code.tolist()
            out["doc_id"].append(doc_id)
            out["n_tokens"].append(int(sizes[code].sum()))
            out["ids"].append(digest(" ".join([ids[c] for c in few])))
            out["decoded"].append(digest(" ".join([texts[c] for c in few])))
        del ids, texts, sizes, codes
        columns = [pa.array(out.pop(f.name), f.type) for f in schema]  # each list goes as its column comes
        return pa.table(columns, schema=schema)

    return run


def read_spec(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, spec: str, full: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by a blank) and decoded text of every document; with full=False the SHA-256 of both texts instead."""
    check_spec(spec)
    d = id_and_text(docs)
    scratch = Scratch(docs.sparkSession, "bpe")
    words = scratch.table(word_table(d, spec), "words")
    scratch.release()
    kind = id_type(spec)
    top, top_codes, top_texts = top_words(words, "n", ["word", "code", "text"], FULL_TOP if full else TOP)
    packed = map_arrow(d, _pack_chunks(spec, {w: k for k, w in enumerate(top)}, FULL_CHARS if full else None), _CHUNK).repartition("chunk")
    places = map_arrow(packed, listed(0, 4), "chunk long, at int, word string")
    answers = places.join(words.select("word", "code", "text"), "word").select("chunk", "at", "code", "text")
    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(tidy_groups(_assemble(_shown(top_codes, kind), top_texts, _counted(top_codes, kind), kind, full)), "doc_id long, n_tokens long, ids string, decoded string")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = encode(table(spark, sf_dir, "documents"), read_spec(), full=False)
    return got.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))
