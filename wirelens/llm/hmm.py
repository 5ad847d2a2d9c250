"""Language-model scoring with a hidden Markov model.

A word w of class k is emitted by a latent state in two steps: the state emits
the class (CLASSES hash classes and one for the end of a text), and the class
emits the word by its smoothed count, (c + 1) / (N_k + V_k + 1), whose last
share is that of the class's unseen words.  So the latent part has a fixed
size, while word counts cover the whole corpus.

* Word counts of the training documents are summed in Spark.
* Baum-Welch starts from SEEDS training documents of the least hashes, whatever
  the files' layout.  In each round every partition runs the scaled
  forward-backward recursion over its training documents; the expected counts
  are summed in Spark by class, and CLASSES rows of states come to the driver.
  Rounds end when the training likelihood gains less than GAIN a token, after
  ROUNDS at most.
* The scaled forward recursion gives every document's exact likelihood.

Texts are processed as segments of SEGMENT words side by side.  The segments
of a longer text are linked exactly: each segment's transfer matrix takes the
state distribution before it to the one after it.

Defined cases: a null text is empty and has only its end; a null doc_id counts
as empty text for the split; repeated rows each count; without training
documents all words are unseen and the model is uniform; an empty table gives
no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, id_and_text, id_crc, least_hashed, map_arrow, table, tidy_groups
from .wordtable import FLUSH, Numbers, chunk_ids, chunks, listed, pack, pack_words, rows, top_words, unpack

STATES, CLASSES, SEGMENT, ROUNDS = 6, 4096, 1024, 12
#: Least gain of a round, in natural log units a token, and documents that the start is chosen from.
GAIN, SEEDS = 0.1, 400
FOLDS, HELD_OUT = 7, 2
END = CLASSES
LOG10 = float(np.log(10))


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def words_of(text: str) -> list[bytes]:
    """Lower-case (A-Z) runs between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


# ---- the recursion


class Model:
    """Start (S), transitions (S, S) and class emissions (CLASSES + 1, S)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit


class Texts:
    """Class sequences cut into segments, which are kept longest first so that each step works on a prefix."""

    def __init__(self, obs: np.ndarray, lens: np.ndarray):
        ends = np.cumsum(lens)
        parts = -(-lens // SEGMENT)
        doc = np.repeat(np.arange(len(lens)), parts)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = (ends - lens)[doc] + nth * SEGMENT
        size = np.minimum(SEGMENT, ends[doc] - start)
        order = np.lexsort((doc, nth, -size))
        self.doc, self.nth, self.start, self.size = doc[order], nth[order], start[order], size[order]
        self.last = self.nth == parts[self.doc] - 1
        self.obs, self.n_docs = obs, len(lens)
        #: later segments of long texts, in the order in which they are linked
        self.later = [np.flatnonzero(self.nth == k) for k in range(1, int(parts.max(initial=0)))]

    def active(self, pick: np.ndarray, t: int) -> np.ndarray:
        """The picked segments (sorted, so longest first) that have a place t."""
        return pick[: np.searchsorted(-self.size[pick], -t, side="left")]

    def steps(self, pick: np.ndarray) -> int:
        return int(self.size[pick].max(initial=0))


def transfer(model: Model, x: Texts, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(matrices, log scales) of the picked segments: row i is what a unit of state i before the segment becomes after it."""
    s = len(model.start)
    m = np.repeat(np.eye(s, dtype=model.emit.dtype)[None], len(pick), axis=0)
    log = np.zeros(len(pick))
    for t in range(x.steps(pick)):
        now = x.active(pick, t)
        n = len(now)
        step = (m[:n].reshape(n * s, s) @ model.move).reshape(n, s, s) * model.emit[x.obs[x.start[now] + t]][:, None, :]
        c = step.sum(axis=(1, 2))
        m[:n] = step / c[:, None, None]
        log[:n] += np.log(c)
    return m, log


def forward(model: Model, x: Texts, pick: np.ndarray, before: np.ndarray | None, keep: np.ndarray | None = None, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(state distribution after each picked segment, log scale); ``before``: distributions ahead of them, None for texts' starts; ``keep`` gets all distributions, at ``at`` + place."""
    a = np.zeros((len(pick), len(model.start)), model.emit.dtype)
    log, ones = np.zeros(len(pick)), np.ones(len(model.start), model.emit.dtype)
    for t in range(x.steps(pick)):
        now = x.active(pick, t)
        n = len(now)
        lead = (np.broadcast_to(model.start, a[:n].shape) if before is None else before[:n] @ model.move) if t == 0 else a[:n] @ model.move
        step = lead * model.emit[x.obs[x.start[now] + t]]
        c = step @ ones
        a[:n] = step / c[:, None]
        log[:n] += np.log(c)
        if keep is not None:
            keep[at[pick[:n]] + t] = a[:n]
    return a, log


def log_likelihood(model: Model, obs: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Natural log of each class sequence's probability."""
    x = Texts(obs, lens)
    out = np.zeros(x.n_docs)
    first = np.flatnonzero(x.nth == 0)
    state = np.zeros((x.n_docs, len(model.start)))
    a, log = forward(model, x, first, None)
    state[x.doc[first]] = a
    np.add.at(out, x.doc[first], log)
    pick = np.flatnonzero(x.nth > 0)
    if len(pick):
        m, scale = transfer(model, x, pick)
        place = np.full(len(x.doc), -1)
        place[pick] = np.arange(len(pick))
        for segs in x.later:
            d, k = x.doc[segs], place[segs]
            v = np.einsum("ni,nij->nj", state[d], m[k])
            c = v.sum(axis=1)
            state[d] = v / c[:, None]
            out[d] += np.log(c) + scale[k]
    return out


def expected(model: Model, obs: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts (S), transitions (S, S) and emissions (CLASSES + 1, S), which are the Baum-Welch counts, and the natural log likelihood."""
    x, s = Texts(obs, lens), len(model.start)
    every = np.arange(len(x.doc))
    first, later = np.flatnonzero(x.nth == 0), np.flatnonzero(x.nth > 0)
    alpha = np.zeros((len(obs), s), model.emit.dtype)
    before = np.zeros((len(every), s), model.emit.dtype)  # distribution ahead of a later segment
    after = np.ones((len(every), s), model.emit.dtype)  # what follows a segment, seen from its last state
    end, logs = forward(model, x, first, None, alpha, x.start)
    total = float(logs.sum())
    if len(later):
        m, _ = transfer(model, x, later)
        place = np.full(len(every), -1)
        place[later] = np.arange(len(later))
        state = np.zeros((x.n_docs, s), model.emit.dtype)
        state[x.doc[first]] = end
        for segs in x.later:
            d = x.doc[segs]
            before[segs] = state[d]
            v = np.einsum("ni,nij->nj", state[d], m[place[segs]])
            state[d] = v / v.sum(axis=1)[:, None]
        total += float(forward(model, x, later, before[later], alpha, x.start)[1].sum())
        follow = np.ones((x.n_docs, s), model.emit.dtype)
        prior = np.zeros((x.n_docs, len(x.later) + 1), np.int64)
        prior[x.doc, x.nth] = every
        for k in range(len(x.later), 0, -1):
            segs = x.later[k - 1]
            d = x.doc[segs]
            v = np.einsum("nij,nj->ni", m[place[segs]], follow[d])
            follow[d] = v / v.sum(axis=1)[:, None]
            after[prior[d, k - 1]] = follow[d]
    moves, b, ones = np.zeros((s, s)), after, np.ones(s, model.emit.dtype)
    starts = np.zeros(s)
    for t in range(x.steps(every) - 1, -1, -1):
        now = x.active(every, t)
        n = len(now)
        here = x.start[now] + t
        weighted = model.emit[obs[here]] * b[:n]
        lead = before[:n] if t == 0 else alpha[here - 1]
        back = weighted @ model.move.T
        if t == 0:
            own = x.nth[:n] > 0
            lead, w = lead[own], weighted[own]
            z = (lead * back[own]) @ ones
            moves += (lead / z[:, None]).T @ w
        else:
            z = (lead * back) @ ones
            moves += (lead / z[:, None]).T @ weighted
        g = alpha[here] * b[:n]
        alpha[here] = g / (g @ ones)[:, None]
        if t == 0:
            starts += alpha[here[~own]].sum(axis=0)
        b[:n] = back / (back @ ones)[:, None]
    emits = np.stack([np.bincount(obs, weights=alpha[:, i], minlength=CLASSES + 1) for i in range(s)], axis=1)
    return starts, moves * model.move, emits, total


def maximise(starts: np.ndarray, moves: np.ndarray, emits: np.ndarray, prior: np.ndarray) -> Model:
    """The next model; every distribution leans a little on a prior, so nothing has probability 0."""
    start = (starts + 1.0) / (starts.sum() + len(starts))
    move = (moves + 1.0) / (moves + 1.0).sum(axis=1, keepdims=True)
    emit = (emits + prior[:, None]) / (emits.sum(axis=0) + 1.0)
    return Model(start, move, emit)


def first_model(prior: np.ndarray, seeds: list[np.ndarray], states: int = STATES) -> Model:
    """States begin as the corpus's class distribution, leaning on a seed document's class counts each, and tend to stay."""
    r = np.random.default_rng(5)
    emit = np.repeat(prior[:, None], states, axis=1) * (1 + 0.1 * r.random((len(prior), states)))
    for i, own in enumerate(seeds[:states]):
        emit[:, i] = 0.5 * emit[:, i] / emit[:, i].sum() + 0.5 * own / own.sum()
    emit /= emit.sum(axis=0)
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit)


def spread(counts: list[np.ndarray], states: int = STATES) -> list[np.ndarray]:
    """Of documents' class counts those that share few classes: each next one is furthest from those taken (ties: the first)."""
    counts = [c for c in counts if c.sum() >= 100] or [c for c in counts if c.sum() > 1]
    if not counts:
        return []
    rows = np.array([np.sqrt(c / c.sum()) for c in counts])
    taken = [0]
    near = rows @ rows[0]
    while len(taken) < min(states, len(counts)):
        taken.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[taken[-1]])
    return [counts[k] for k in taken]


# ---- Spark


def _count(batches):
    """(word, all, train) partial counts."""
    kept, train = Counter(), Counter()  # of held-out and of training documents

    def out():
        both = list(train) + [w for w in kept if w not in train]
        all_, mine = [train[w] + kept[w] for w in both], [train[w] for w in both]
        got = pa.RecordBatch.from_arrays([pa.array(both, pa.binary()).cast(pa.string()), pa.array(all_, pa.int64()), pa.array(mine, pa.int64())], names=["word", "n", "c"])
        kept.clear()
        train.clear()
        for at in range(0, got.num_rows, 50_000):
            yield got.slice(at, 50_000)

    for doc_id, text in rows(batches):
        (kept if held_out(doc_id) else train).update(words_of(text))
        if len(kept) + len(train) > FLUSH:
            yield from out()
    yield from out()


def _class_counts(batches):
    """(ks, ns): the class counts of each text, with its end; CLASSES + 1 at most."""
    for batch in batches:
        for text in batch.column(0):
            ks, ns = np.unique(np.array([zlib.crc32(w) % CLASSES for w in words_of(text.as_py() or "")] + [END]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([ks], pa.list_(pa.int32())), pa.array([ns], pa.list_(pa.int64()))], names=["ks", "ns"])


def seed_counts(docs: DataFrame, seeds: int = SEEDS) -> list[np.ndarray]:
    """Class counts of the training documents of the least hashes; repeated rows count once here."""
    train = docs.where(F.pmod(id_crc(F.col("doc_id")), F.lit(FOLDS)) != HELD_OUT)
    picked = least_hashed(train, seeds, docs.count())
    out = []
    for r in map_arrow(picked, _class_counts, "ks array<int>, ns array<long>").collect():  # seeds rows
        c = np.zeros(CLASSES + 1)
        c[r["ks"]] = r["ns"]
        out.append(c)
    return sorted(out, key=lambda c: c.tobytes())


_CHUNK = "chunk long, doc_ids array<long>, train array<boolean>, lens binary, obs binary, n_known array<long>, logs array<double>, rare_lens binary, rare binary, words binary"


def _pack(top: dict[bytes, int]):
    """Chunks: class sequences with their ends, sums over frequent words (top: word -> count), and the others by number."""

    def run(batches):
        for chunk, held in zip(chunk_ids(), chunks(rows(batches), lambda r: len(r[1])), strict=False):
            words = Numbers()
            places = [words.of(words_of(text)) for _, text in held]
            count = np.array([top.get(w, -1) for w in words], np.int64)
            kind = np.array([zlib.crc32(w) % CLASSES for w in words], np.int64)
            rare = count < 0
            number = np.cumsum(rare) - 1
            log = np.where(rare, 0.0, np.log10(np.maximum(count, 0) + 1.0))
            obs, few = [], []
            for p in places:
                obs += [kind[p], [END]]
                few.append(number[p[rare[p]]])
            u = lambda v: pa.array([pack(np.asarray(v, np.int64))], pa.binary())
            yield pa.RecordBatch.from_pydict(
                {"chunk": pa.array([chunk], pa.int64()), "doc_ids": pa.array([[r[0] for r in held]], pa.list_(pa.int64())), "train": pa.array([[not held_out(r[0]) for r in held]], pa.list_(pa.bool_())),
                 "lens": u([len(p) + 1 for p in places]), "obs": u(np.concatenate(obs)), "n_known": pa.array([[int((count[p] > 0).sum()) for p in places]], pa.list_(pa.int64())),
                 "logs": pa.array([[float(log[p].sum()) for p in places]], pa.list_(pa.float64())), "rare_lens": u([len(r) for r in few]), "rare": u(np.concatenate(few)),
                 "words": pa.array([pack_words([w.decode("utf-8", "surrogatepass") for w, r in zip(words, rare.tolist(), strict=True) if r])], pa.binary())}
            )

    return run


def _train_part(row_train, lens, obs):
    keep = np.array(row_train, bool)
    return obs[np.repeat(keep, lens)], lens[keep]


def _e_step(model: Model):
    small = Model(*(v.astype(np.float32) for v in (model.start, model.move, model.emit)))

    def run(batches):
        s = len(small.start)
        starts, moves, emits, total = np.zeros(s), np.zeros((s, s)), np.zeros((CLASSES + 1, s)), 0.0
        for batch in batches:
            for k in range(batch.num_rows):
                train, lens, obs = batch.column(0)[k].as_py(), unpack(batch.column(1)[k].as_py()), unpack(batch.column(2)[k].as_py())
                obs, lens = _train_part(train, lens, obs)
                if len(lens):
                    got = expected(small, obs, lens)
                    starts, moves, emits, total = starts + got[0], moves + got[1], emits + got[2], total + got[3]
        every = np.concatenate((starts[None], moves, emits, np.full((1, s), total)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(every), dtype=np.int32)), *[pa.array(every[:, i]) for i in range(s)]], names=["k", *[f"s{i}" for i in range(s)]])

    return run


def baum_welch(packed: DataFrame, prior: np.ndarray, seeds: list[np.ndarray], states: int = STATES, rounds: int = ROUNDS, gain: float = GAIN) -> Model:
    """Fits the model on all training documents."""
    model = first_model(prior, spread(seeds, states), states)
    columns = [f"s{i}" for i in range(states)]
    before = None
    for _ in range(rounds):
        counts = map_arrow(packed.select("train", "lens", "obs"), _e_step(model), "k int, " + ", ".join(f"{c} double" for c in columns)).groupBy("k").agg(*[F.sum(c).alias(c) for c in columns])
        every = np.zeros((1 + states + CLASSES + 2, states))
        for r in counts.collect():  # 1 + states + CLASSES + 2 rows
            every[r["k"]] = r[1:]
        model = maximise(every[0], every[1 : 1 + states], every[1 + states : -1], prior)
        mean = every[-1, 0] / max(1.0, every[1 + states : -1].sum())
        if before is not None and mean - before < gain:
            break
        before = mean
    return model


def _forward_scores(model: Model, class_logs: np.ndarray):
    """Adds each document's class-sequence log10 likelihood less its words' class totals, and drops the sequence."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                lens, obs = unpack(row.column("lens")[0].as_py()), unpack(row.column("obs")[0].as_py())
                log = log_likelihood(model, obs, lens) / LOG10
                log -= np.add.reduceat(class_logs[obs], np.cumsum(lens) - lens) if len(lens) else 0
                keep = [n for n in row.schema.names if n != "obs"]
                yield pa.RecordBatch.from_arrays([*[row.column(n) for n in keep], pa.array([log.tolist()], pa.list_(pa.float64()))], names=[*keep, "latent"])

    return run


_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _finish(n_train: int, n_words: int, n_ends: int):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    under, end_log = float(np.log10(n_train + n_words + 1)), float(np.log10(n_ends + 1))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        get = lambda n: left.column(n)[0].as_py()
        count = np.zeros(right.num_rows, np.int64)
        count[right.column("at").to_numpy()] = right.column("c").to_numpy()
        lens, rare_lens, rare = unpack(get("lens")), unpack(get("rare_lens")), unpack(get("rare"))
        doc = np.repeat(np.arange(len(lens)), rare_lens)
        c = count[rare]
        words = np.array(get("logs")) + np.bincount(doc, weights=np.log10(c + 1.0), minlength=len(lens))
        known = np.array(get("n_known"), np.int64) + np.bincount(doc[c > 0], minlength=len(lens)) + int(n_ends > 0)
        return pa.table({"doc_id": get("doc_ids"), "held_out": [not t for t in get("train")], "n_tokens": lens, "n_known": known, "train_tokens": np.full(len(lens), n_train), "base_score": words + end_log - lens * under, "score": words + np.array(get("latent"))}, schema=schema)

    return run


def score(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    d = id_and_text(docs)
    scratch = Scratch(docs.sparkSession, "hmm")
    words = scratch.table(map_arrow(d, _count, "word string, n long, c long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c")), "words")
    scratch.release()
    n_k, v_k = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    by_class = words.groupBy(F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(CLASSES)).cast("int").alias("k")).agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v"))
    for r in by_class.collect():  # CLASSES rows
        n_k[r["k"]], v_k[r["k"]] = r["n"], r["v"]
    top = {w.encode(): c for w, c in zip(*top_words(words, "n", ["word", "c"]), strict=True)}
    packed = scratch.table(map_arrow(d, _pack(top), _CHUNK), "chunks")
    n_ends = packed.agg(F.sum(F.size(F.filter("train", lambda t: t)))).first()[0] or 0
    n_train, n_words = int(n_k.sum()) + n_ends, int(v_k.sum()) + int(n_ends > 0)
    n_k[END] = n_ends
    prior = (n_k + 1) / (n_k + 1).sum()
    model = baum_welch(packed, prior, seed_counts(d), states, rounds)
    class_logs = np.log10(n_k + v_k + 1)
    class_logs[END] = 0.0  # the end is its class's only symbol
    narrow = "chunk long, doc_ids array<long>, train array<boolean>, lens binary, n_known array<long>, logs array<double>, rare_lens binary, rare binary, latent array<double>"
    scored = map_arrow(packed.drop("words"), _forward_scores(model, class_logs), narrow)
    counts = map_arrow(packed.select("chunk", "words"), listed(0, 1), "chunk long, at int, word string").join(words.select("word", "c"), "word").select("chunk", "at", "c")
    return scored.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(tidy_groups(_finish(n_train, n_words, n_ends)), _OUT)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
