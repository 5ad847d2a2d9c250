"""Language models, language ID, tokens, decontamination, near duplicates, shards, pipeline: against brute force and held-out figures."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wirelens.llm import bpe, common, components, decontaminate, hmm, jaccard, language, sharding, wordtable

ODD = [None, "", " \n", "one", "Two words", "é 漢字 İ ſ", "x" * 50_000, "a b c d " * 3_000]


def frame(spark, texts, **more):
    rows = [(None if i == 2 else i, t, "en", "k", 5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, key string, n int")


def test_recursion_equals_plain_forward_backward(monkeypatch):
    monkeypatch.setattr(hmm, "SEGMENT", 5)
    r, s, c = np.random.default_rng(0), 3, hmm.CLASSES + 1
    m = hmm.Model(r.dirichlet(np.ones(s)), r.dirichlet(np.ones(s), s), r.dirichlet(np.ones(c), s).T.copy())
    lens = np.array([1, 4, 5, 6, 17, 23])
    obs = r.integers(0, c, lens.sum())
    starts, moves, emits, total = hmm.expected(m, obs, lens)
    assert np.isclose(total, hmm.log_likelihood(m, obs, lens).sum())
    want_s, want_m, want_e, logs, at = np.zeros(s), np.zeros((s, s)), np.zeros((c, s)), [], 0
    for n in lens:
        o = obs[at : at + n]
        at += n
        a, b = np.zeros((n, s)), np.ones((n, s))
        for t in range(n):
            a[t] = (m.start if t == 0 else a[t - 1] @ m.move) * m.emit[o[t]]
        for t in range(n - 2, -1, -1):
            b[t] = m.move @ (m.emit[o[t + 1]] * b[t + 1])
        p = a[-1].sum()
        logs.append(math.log(p))
        want_s += a[0] * b[0] / p
        for t in range(n):
            want_e[o[t]] += a[t] * b[t] / p
        for t in range(n - 1):
            want_m += a[t][:, None] * m.move * (m.emit[o[t + 1]] * b[t + 1])[None] / p
    assert np.allclose(hmm.log_likelihood(m, obs, lens), logs)
    assert np.allclose(starts, want_s) and np.allclose(moves, want_m) and np.allclose(emits, want_e)


@pytest.mark.parametrize("top", [1 << 18, 20])
def test_lm_base_equals_counts(spark, sf, monkeypatch, top):
    monkeypatch.setattr(hmm, "top_words", lambda w, n, c: wordtable.top_words(w, n, c, top))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionAll(frame(spark, ODD).select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    texts = [(r[0], (r[1] or "").encode().lower().split()) for r in docs.collect()]
    count, ends = collections.Counter(), 0
    for i, w in texts:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            count.update(w)
            ends += 1
    n, v = sum(count.values()) + ends, len(count) + 1
    got = {r["doc_id"]: r for r in hmm.score(docs, rounds=2).collect()}
    assert len(got) == len(texts)
    for i, w in texts:
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w) + 1, sum(count[x] > 0 for x in w) + 1, n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
    held = [r for r in got.values() if r["held_out"] and r["n_tokens"] > 50]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # better on held-out texts than single words


def test_lm_does_not_depend_on_the_layout(spark, sf):
    """One file or seven give the same scores; a text's score is the log of its probability under the model, summed by hand."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    one, seven = (sorted((r["doc_id"], r["base_score"], r["score"]) for r in hmm.score(d).collect()) for d in (docs.coalesce(1), docs.repartition(7)))
    assert [r[0] for r in one] == [r[0] for r in seven]
    assert np.allclose([r[1:] for r in one], [r[1:] for r in seven], rtol=2e-4)


def test_lm_without_training(spark):
    only = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    docs = spark.createDataFrame([(i, t) for i, t in zip(only, ["a b", None, "c"], strict=True)], "doc_id long, text string")
    got = hmm.score(docs, rounds=1).collect()
    assert {r["train_tokens"] for r in got} == {0} and all(math.isclose(r["base_score"], 0, abs_tol=1e-12) for r in got)
    assert hmm.score(docs.where("false"), rounds=1).count() == 0


@pytest.mark.parametrize("top", [1 << 18, 5])
def test_bpe_equals_the_library(spark, monkeypatch, top):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "top_words", lambda w, n, c, t: wordtable.top_words(w, n, c, min(t, top)))
    spec = bpe.read_spec()
    tok = Tokenizer.from_str(spec)
    r = random.Random(1)
    letters = "aB'sStTrRéÉßİıſKΣσςǺ̇½²³१٣漢字　\x85\xa0\x1c\x1f\x00\t\n  ​ !?.,’ǅŉ👍🏽<|endoftext|>H̱ªº"
    texts = [*ODD, "<|endoftext|>abc<|startoftext|> <|END", "It's we've I'LL don't 12345 x²", *["".join(r.choice(letters) for _ in range(r.randint(1, 60))) for _ in range(200)]]
    got = bpe.encode(frame(spark, texts), spec).collect()
    assert len(got) == len(texts)
    for x in got:
        e = tok.encode(texts[2 if x["doc_id"] is None else x["doc_id"]] or "", add_special_tokens=False)
        assert (x["n_tokens"], x["ids"], x["decoded"]) == (len(e.ids), " ".join(map(str, e.ids)), tok.decode(e.ids, skip_special_tokens=False))
    assert bpe.encode(frame(spark, texts).where("false"), spec).count() == 0


def test_bpe_refuses_other_parts_and_decodes_by_a_join(spark):
    import json

    spec = json.loads(bpe.read_spec())
    for part, value in (("normalizer", None), ("decoder", {"type": "ByteLevel"}), ("model", spec["model"] | {"dropout": 0.1})):
        with pytest.raises(ValueError, match=part):
            bpe.check_spec(json.dumps(spec | {part: value}))
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    plan = bpe.word_table(docs, bpe.read_spec())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [id" in plan


def test_pack_round_trip():
    for v in ([], [0], [1, 255, 256, 70_000], list(range(1000))):
        assert wordtable.unpack(wordtable.pack(np.array(v, np.int64))).tolist() == v
    for w in ([], ["a"], ["é", "b c"]):
        assert wordtable.unpack_words(wordtable.pack_words(w)) == w


def test_language_id_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = language.op6_language_id(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    m = got.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert m > 0.97
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_id_cases(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(5001, None, "en"), (5002, "", "en"), (5003, "123 ?!", None), (None, "the and of", None), (5004, "漢字", "xx"), (5005, "the " * 50_000, "en")], "doc_id long, text string, lang string")
    docs = base.unionAll(odd).withColumn("score", F.lit("clash")).withColumn("code", F.lit(1))
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert [got[i]["lang_pred"] for i in (5001, 5002, 5003)] == ["und"] * 3 and got[None]["lang_pred"] == "en" and got[5005]["lang_pred"] == "en"
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in docs.subtract(kept).collect()} == {5001, 5002, 5003}
    assert {r["lang_pred"] for r in language.identify(docs.drop("lang").withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify(docs.where("false")).count() == 0


def test_language_id_equals_plain_out_of_place(spark):
    """Profiles and distances by dicts and Counter, over strings of letters; ties in counts, in distances and repeated rows."""
    import unicodedata

    def grams(text):
        low = "".join((x.lower() if len(x.lower()) == 1 else x) if unicodedata.category(x)[0] == "L" else " " for x in text or "")
        run = " " + " ".join(low.split()) + " "
        return [run[i : i + n] for n in (1, 2, 3) for i in range(len(run) - n + 1) if (run[i] != " " if n == 1 else n == 2 or run[i + 1] != " ")] if run.strip() else []

    def code(g):
        x = [ord(c) * 0x9E3779B1 & 0xFFFFFFFF for c in g]
        m = 0xFFFFFFFF
        h = x[0] if len(x) == 1 else (x[0] * 0x85EBCA6B + x[1] & m) ^ 0x27D4EB2F if len(x) == 2 else ((x[0] * 0x85EBCA6B + x[1] & m) * 0xC2B2AE35 + x[2] & m) ^ 0x165667B1
        return (h * 0x9E3779B1 & m) >> 14

    ranks = lambda counts: [c for c, _ in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:400]]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = [(9001, "\ud7b0\ud7c6", "ko"), (9002, "abc abc", "aa"), (9003, "abc abc", "bb"), (9006, "abc", None), (9006, "abc", None), (9007, chr(0x2FFFE) + " 12", "zz"), (9008, "ǅ Σς ß İ", "xx")]
    docs = docs.unionAll(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    rows = docs.collect()
    held = {}
    for r in rows:
        if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 and r["text"] is not None:
            held.setdefault(r["lang"], collections.Counter()).update(map(code, grams(r["text"])))
    known = {lang: {c: k for k, c in enumerate(ranks(n))} for lang, n in sorted(held.items()) if n}
    assert {k: {c: i for i, c in enumerate(v)} for k, v in language.profiles(docs).items()} == known
    want = collections.Counter()
    for r in rows:
        mine = ranks(collections.Counter(map(code, grams(r["text"]))))
        away = {lang: sum(abs(p[c] - k) if c in p else 400 for k, c in enumerate(mine)) for lang, p in known.items()}
        want[r["doc_id"], min(away, key=lambda x: (away[x], x)) if mine else "und"] += 1
    assert collections.Counter((x["doc_id"], x["lang_pred"]) for x in language.identify(docs).collect()) == want


def plain_hits(text, items):
    import re

    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    w, hit, ids = pattern.findall(lower(text)), set(), set()
    for item, t in items:
        x = pattern.findall(lower(t))
        n = min(10, len(x))
        for i in range(len(x) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == x[i : i + n]:
                    hit |= set(range(p, p + n))
                    if item is not None:
                        ids.add(str(item))
    return len(w), len(hit), sorted(ids)


def test_decontamination_equals_brute_force(spark, monkeypatch):
    r = random.Random(2)
    words = "a b c Dd É 9".split()
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(0, say(14)), (1, say(10)), (10, say(3)), (2, "É"), (3, None), (4, ""), (1, say(11)), (None, say(12)), (5, "zz " * 30), (6, say(2))]
    texts = [*ODD[:6], *[say(r.randint(1, 60)) for _ in range(60)], items[0][1] + ", " + items[7][1].upper(), "zz " * 40, None]
    docs = frame(spark, texts)
    bench = spark.createDataFrame([(i, t, "w") for i, t in items], "item_id long, text string, words string")
    for bits in (decontaminate.MAX_FILTER_BITS, 64):  # 64 bits let nearly everything through
        monkeypatch.setattr(decontaminate, "MAX_FILTER_BITS", bits)
        got = decontaminate.find(docs, bench).withColumn("hit", decontaminate.n_hit()).collect()
        assert len(got) == len(texts)
        for x in got:
            assert (x["n_words"], x["hit"], x["items"]) == plain_hits(texts[2 if x["doc_id"] is None else x["doc_id"]], items)
    clean = decontaminate.keep_clean(docs, bench)
    assert clean.columns == docs.columns and sorted(x["text"] or "" for x in clean.collect()) == sorted(t or "" for t in texts if not plain_hits(t, items)[1])
    assert decontaminate.find(docs, bench.where("false")).where("size(spans) > 0").count() == 0
    assert decontaminate.find(docs.where("false"), bench).count() == 0


def test_decontamination_by_one_very_long_item(spark):
    """An item of many distinct words, listed thrice, and copies of one contaminated text."""
    words = [f"q{i}" for i in range(300_000)]
    bench = spark.createDataFrame([("long", " ".join(words))] * 3, "item_id string, text string")
    passage = "x y z " + " ".join(words[1000:1015]) + " end"
    docs = spark.createDataFrame([(i, passage) for i in range(50)] + [(99, "nothing " * 40)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.find(docs, bench).collect()}
    assert len(got) == 51 and not got[99]["spans"]
    assert all([(s["start"], s["end"]) for s in got[i]["spans"]] == [(3, 18)] and got[i]["items"] == ["long"] for i in range(50))
    assert [r["doc_id"] for r in decontaminate.keep_clean(docs, bench).collect()] == [99]


def plain_components(rows, shingle=4, percent=85):
    groups = collections.defaultdict(list)
    for i, t in rows:
        w = (t or "").encode().lower().split()
        groups[frozenset(tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)) if len(w) >= shingle else frozenset([tuple(w)] if w else [])].append(i)
    sets = [s for s in groups if s]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = {}
    known = lambda ids: min((i for i in ids if i is not None), default=None)
    for k, s in enumerate(sets):
        x = known(groups[s])
        r = root(k)
        least[r] = x if least.get(r) is None else least[r] if x is None else min(least[r], x)
    return sorted((-1 if i is None else i, len(s), -1 if (c := least[root(sets.index(s))] if s else i) is None else c) for s, ids in groups.items() for i in ids)


def near_copies(r, n, words, base_len, edits):
    base = [r.choice(words) for _ in range(base_len)]
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = r.choice(words)
        yield " ".join(w)


@pytest.mark.parametrize(("rare", "block", "span"), [(16, 1024, 128), (3, 8, 16)])
def test_jaccard_equals_brute_force(spark, monkeypatch, rare, block, span):
    monkeypatch.setattr(jaccard, "RARE", rare)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    monkeypatch.setattr(jaccard, "CLASS_SPAN", span)
    r = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    line = " this line stands in very many of these documents here"
    texts = [*ODD, *ODD, *near_copies(r, 40, words, 60, 2), *near_copies(r, 40, words, 150, 6), *near_copies(r, 10, words, 9, 1), *near_copies(r, 6, words, 800, 30)]
    texts += [" ".join(r.choice(words) for _ in range(r.randint(1, 60))) + line for _ in range(80)]
    docs = frame(spark, texts)
    got = jaccard.link_components(docs, jaccard.Rule(4, 85)).collect()
    assert sorted((-1 if x[0] is None else x[0], x[1], -1 if x[2] is None else x[2]) for x in got) == plain_components([(None if i == 2 else i, t) for i, t in enumerate(texts)])


def templated(r, n, shared, low, high, tag):
    """Texts that share a passage around their own words, of ``low`` to ``high``."""
    base = [f"{tag}{i}" for i in range(shared)]
    for _ in range(n):
        yield " ".join([*base[: shared // 2], *[f"own{r.randrange(10**9)}" for _ in range(r.randint(low, high))], *base[shared // 2 :]])


@pytest.mark.parametrize(("rare", "span"), [(3, 128), (3, 32), (1, 16)])
def test_jaccard_reach_at_the_threshold(spark, monkeypatch, rare, span):
    """Templates with own words about as many as the similarity allows, in families and in pairs: no link is lost to reach and bands."""
    monkeypatch.setattr(jaccard, "RARE", rare)
    monkeypatch.setattr(jaccard, "CLASS_SPAN", span)
    r = random.Random(12)
    texts = [t for k, shared in enumerate((30, 70, 143, 260)) for t in templated(r, 30, shared, 0, shared // 6, f"f{k}-")]
    texts += [t for k in range(60) for t in templated(r, 2, r.randint(20, 120), 0, 9, f"p{k}-")]
    r.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rule in (jaccard.Rule(4, 85), jaccard.Rule()):
        assert sorted(map(tuple, jaccard.link_components(docs, rule).collect())) == plain_components(list(enumerate(texts)), *rule)


def test_templates_without_links_make_no_family(spark, monkeypatch):
    stars = []
    found = jaccard._family_links
    monkeypatch.setattr(jaccard, "_family_links", lambda s, *rest: stars.append(s.count()) or found(s, *rest))
    texts = list(templated(random.Random(3), 300, 143, 14, 30, "t"))
    got = jaccard.link_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), jaccard.Rule(4, 85))
    assert got.where("doc_id <> component_id").count() == 0 and stars == [0]


def test_jaccard_by_other_rules(spark):
    r = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    texts = [*ODD, *near_copies(r, 30, words, 50, 2), *near_copies(r, 20, words, 8, 1), *near_copies(r, 20, words, 9, 1), "a b c d e f g h", "a b c d e f g h i", "a b c d e f g"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rule in (jaccard.Rule(), jaccard.Rule(2, 60)):
        assert sorted(map(tuple, jaccard.link_components(docs, rule).collect())) == [(i, n, c) for i, n, c in plain_components(list(enumerate(texts)), *rule)]


def test_families_of_many_blocks(spark, monkeypatch):
    """Chains of near copies, no two ends of which are alike, and several groups that share one line: more than the first blocks connect."""
    monkeypatch.setattr(jaccard, "RARE", 3)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 4)
    monkeypatch.setattr(jaccard, "CLASS_SPAN", 16)
    r = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(3):
        w = [r.choice(words) for _ in range(90)]
        for _ in range(45):
            w[r.randrange(90)] = r.choice(words)
            texts.append(" ".join(w))
    line = " a line that is very common here and stands in each of these"
    texts += [x + line for _ in range(4) for x in near_copies(r, 12, words, 14, 1)]
    r.shuffle(texts)
    got = jaccard.link_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), jaccard.Rule(4, 85)).collect()
    assert sorted(tuple(x) for x in got) == plain_components(list(enumerate(texts)))


def test_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(3, text, "a"), (1, text, "b"), (1, text, "b"), (2, None, "c"), (2, None, "c"), (None, "", "d"), (None, "", "d"), (4, "other words are here", "e")], "doc_id long, text string, row string")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(x["doc_id"]) for x in kept.collect()) == ["1", "2", "4", "None", "None"]
    assert jaccard.link_components(docs.where("false")).count() == 0


def test_keep_one_decides_by_row(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcdef"}
    rows = [(1, texts["a"]), (1, texts["b"]), (1, None), (1, ""), (None, texts["c"]), (None, texts["c"]), (7, texts["d"]), (None, texts["d"]), (None, texts["e"]), (2, texts["a"]), (0, texts["f"]), (1, texts["f"])]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(1, texts["a"]), (1, texts["b"]), (1, None), (1, ""), (None, texts["c"]), (7, texts["d"]), (None, texts["e"]), (0, texts["f"])]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace as S

    held = {}
    fake = lambda master: S(sparkContext=S(master=master, getConf=lambda: held), conf=S(get=lambda k, d: d, set=held.__setitem__))
    with pytest.raises(RuntimeError):
        common.shared_dir(fake("spark://host:7077"))
    assert common.shared_dir(fake("local[4]")) == "/tmp/checkpoints" and held
    held["spark.checkpoint.dir"] = "hdfs://x/y/"
    assert common.shared_dir(fake("spark://host:7077")) == "hdfs://x/y"


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(100)] + [(r.randrange(200, 400), r.randrange(200, 400)) for _ in range(150)] + [(500, i) for i in range(501, 600)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = components.components(spark.createDataFrame(edges, "a long, b long"), common.Scratch(spark, "test"), "x")
    assert {x["node"]: x["root"] for x in got.collect()} == {x: root(x) for x in parent}
    assert got.count() == len(parent)


def test_shards(spark):
    r = random.Random(8)
    texts = [*ODD[:7], *["same text again" for _ in range(300)], *["".join(r.choice("abé ") for _ in range(r.randint(1, 400))) for _ in range(1500)]]
    docs = spark.createDataFrame([(None if i == 2 else i // 2 * 2 if i < 20 else i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, size int, shard string")
    rows = sharding.shards(docs, 16).collect()
    assert len(rows) == len(texts)
    assert collections.Counter((x["doc_id"], x["size"], x["text_crc32"]) for x in rows) == collections.Counter((None if i == 2 else i // 2 * 2 if i < 20 else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in enumerate(texts))
    size = collections.Counter()
    for s in range(16):
        mine = [x for x in rows if x["shard"] == s]
        assert sorted(x["slot"] for x in mine) == list(range(len(mine)))
        size[s] = sum(x["size"] for x in mine)
    mean = sum(size.values()) / 16
    assert max(abs(v - mean) for s, v in size.items()) < 50_001 + 0.02 * mean
    assert sharding.shards(docs.where("false")).count() == 0


def test_shards_split_equal_rows(spark):
    """Half of the rows are one row; a third have no id and one text."""
    rows = [(7, "the same row")] * 6000 + [(i, f"other row {i % 1000:03d}") for i in range(6000)] + [(None, "no id here")] * 6000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.shards(docs, 16).toPandas()
    size = got.groupby("shard")["size"].sum()
    assert len(got) == len(rows) and len(size) == 16 and size.max() < 1.011 * size.mean() + 30 and size.min() > 0.989 * size.mean() - 30
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_splitters_equal_a_sequential_search(spark):
    """Splitters against a walk over the sorted keys: each is the text edge nearest to its target, or lies within the tolerance of it."""
    r = random.Random(3)
    texts = [f"t{i % 700}" + "y" * (i % 700 % 37) for i in range(2000)] + ["".join(r.choice("abc") for _ in range(r.randint(0, 300))) for _ in range(800)]
    keys = common.Scratch(spark, "test").table(sharding.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), "keys")
    points = sharding.splitters(keys, 8)
    rows = sorted((sum(((x[h] + (1 << 63)) << 64 * (2 - k)) for k, h in enumerate(sharding.HASHES)), x["size"], x["shard"]) for x in sharding.assign(keys, points).collect())
    total = sum(x[1] for x in rows)
    for i, p in enumerate(points, 1):
        below = sum(size for key, size, _ in rows if key < p)
        assert abs(below - total * i / 8) <= sharding.TOLERANCE * total / 8 + max(x[1] for x in rows)
    assert [x[2] for x in rows] == [sum(p <= key for p in points) for key, _, _ in rows]


def test_shards_keep_groups_and_write(spark, tmp_path):
    texts = [f"text {i // 3} " + "x" * (i // 3 % 50) for i in range(6000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sharding.shards(docs, 8).toPandas()
    assert (rows.groupby("text_crc32").shard.nunique() > 1).sum() == 0
    size = rows.groupby("shard")["size"].sum()
    assert size.max() < 1.03 * size.mean() and size.min() > 0.97 * size.mean()
    sharding.write_shards(docs, str(tmp_path / "out"), 8)
    back = spark.read.parquet(str(tmp_path / "out")).groupBy("wirelens_shard").count().collect()
    assert {x[0]: x[1] for x in back} == rows.groupby("shard").size().to_dict()


def test_pipeline_equals_its_parts(spark, tmp_path):
    """run() against each stage's decisions taken by brute force on what its predecessor kept."""
    import shutil

    import corpus_pipeline

    from .test_scans import PLAIN, holds

    shutil.copytree("/root/testdata/sf0.001", tmp_path / "sf")
    sf = str(tmp_path / "sf")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    pred = {r["doc_id"]: r for r in language.identify(docs).collect()}
    kept = {i: t for i, t in rows.items() if pred[i]["lang_pred"] != "und" and pred[i]["score"] >= language.MIN_SCORE}
    kept = {i: kept[i] for i, _, c in plain_components(list(kept.items())) if i == c}
    kept = {i: t for i, t in kept.items() if not plain_hits(t, bench)[1]}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(got) == set(kept)
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(bpe.read_spec())
    for i, t in kept.items():
        if not any(holds(k, m[0]) for k, p in PLAIN.items() for m in p.finditer(t)) and "555" not in t:
            assert got[i]["ids"] == " ".join(map(str, tok.encode(t, add_special_tokens=False).ids))
        else:
            assert not any(holds(k, m[0]) for k in ("email", "ip") for m in PLAIN[k].finditer(got[i]["decoded"].replace("</w>", "")))
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in list(stages.items())[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns, name


def test_pipeline_edges(spark, tmp_path):
    """Nulls, an empty text, a very long one, repeated rows and extra columns with names that stages use; then no rows at all."""
    import corpus_pipeline

    prose = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang = 'en' and length(text) between 300 and 900").orderBy("doc_id").limit(12).collect()]
    words = " ".join(prose).split()
    r = random.Random(1)
    long = " ".join(r.choice(words) for _ in range(60_000))
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(prose)] + [(0, prose[0], "en", "s", 1)] * 3 + [(None, " ".join(r.sample(words, 80)), None, None, None), (50, None, "en", "s", None), (51, "", "en", "s", 0), (52, long, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("row", "spans", "print", "key", "words", "tokens", "n", "id", "t", "new"):
        docs = docs.withColumn(name, F.lit(name))
    docs.write.parquet(str(tmp_path / "some" / "documents.parquet"))
    bench = spark.createDataFrame([(1, " ".join(prose[3].split()[5:20])), (2, None), (None, "")], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "some" / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    ids = [x["doc_id"] for x in got]
    assert ids.count(0) == 1 and None in ids and 52 in ids and not {3, 50, 51} & set(ids)
    assert {x["doc_id"]: x["n_tokens"] for x in got}[52] > 60_000
    staged = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        staged = stage(spark, staged, str(tmp_path / "some"))
        assert staged.columns == docs.columns
    docs.where("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    bench.where("false").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
