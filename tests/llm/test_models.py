"""Language identification, toxicity, language model, segmentation and the pipeline."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagecraft.llm import common, eliasfano, langid, lattice, lm, mixing, spm, toxicity

SMALL = "/root/testdata/sf0.01"


def table(spark, name):
    return common.table(spark, SMALL, name)


def test_language_held_out_accuracy(spark):
    docs = table(spark, "documents")
    got = langid.predicted(docs, langid.learn_rule(F.col("doc_id"))).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert len(got) == docs.count() and len(held) > 100
    assert (held["lang_pred"] == held["lang"]).mean() > 0.95
    assert got["score"].between(0, 1).all()


def test_language_forward_sums_all_segmentations():
    voc = lattice.vocabulary(lattice.model_path(), True)
    rng = np.random.default_rng(0)
    prob = rng.random((voc.size, 2)) * 1e-3
    ids = {}
    for i, b in enumerate(voc.bytes):
        if b and i not in set(voc.byte_id) and len(b) <= voc.longest:
            ids.setdefault(b.lower(), i)

    def brute(s, k):
        a = [1.0] + [0.0] * len(s)
        for j in range(1, len(s) + 1):
            for n in range(1, min(j, voc.longest) + 1):
                i = ids.get(s[j - n : j], int(voc.byte_id[s[j - 1]]) if n == 1 else None)
                a[j] += a[j - n] * prob[i, k] if i is not None else 0
        return math.log(a[-1])

    words = sorted([b" the", b" information", "  été".encode(), b" x"], key=len, reverse=True)
    stop = np.cumsum([len(w) for w in words])
    got = langid.forward(voc, prob, np.frombuffer(b"".join(words), np.uint8), stop - [len(w) for w in words], stop)
    assert np.allclose(got, [[brute(w, k) for k in (0, 1)] for w in words])


def test_language_edges(docs, empty):
    got = langid.predicted(docs, F.lit(True)).collect()
    assert len(got) == docs.count()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in langid.predicted(docs, F.lit(False)).collect())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in texts[r["doc_id"]] or "")) for r in got if r["doc_id"] is not None)
    assert langid.predicted(empty, F.lit(True)).count() == 0


def test_language_of_long_rows_and_words(spark):
    """A language whose rows are all long is learned, words of any length count, and repeated rows count once in the sample."""
    rows = [(i, "kala wo tero " * 4000 + "ka" * 100, "xx") for i in range(4)] + [(10 + i, f"umber dost fling {i}", "yy") for i in range(40)] + [(99, "umber dost fling", "yy")] * 30
    rows += [(200, "tero kala", None), (201, "dost umber", None)]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predicted(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("doc_id") < 200).collect()}
    assert got[200] == "xx" and got[201] == "yy"


def test_language_prediction_against_its_formula(spark, voc):
    """Prior times the words' forward sums, normalised, from the fitted probabilities."""
    rows = [(i, "the house of the wind and rain", "en") for i in range(6)] + [(10 + i, "la maison du vent et de la pluie", "fr") for i in range(3)]
    ask = [(100, "the maison of rain"), (101, "vent et house")]
    df = spark.createDataFrame([*rows, *[(i, t, None) for i, t in ask]], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.predicted(df, F.col("doc_id") < 100).collect()}
    lower = lattice.vocabulary(lattice.model_path(), True)
    counted = [Counter(w for i, t, g in rows if g == lang for w in t.encode().split()) for lang in ("en", "fr")]
    prob = langid.fit(lower, [dict(c) for c in counted])
    for i, t in ask:
        total = np.log([6 / 9, 3 / 9])
        for w in t.encode().split():
            b = b" " + w
            total = total + langid.forward(lower, prob, np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]))[0]
        p = np.exp(total - total.max())
        assert got[i]["lang_pred"] == ("en", "fr")[int(total.argmax())] and abs(got[i]["score"] - (p / p.sum()).max()) < 1e-9


def test_toxicity_held_out(spark):
    docs, labels = (common.table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    got = toxicity.scored(docs, labels, toxicity.learn_rule(F.col("doc_id"))).join(labels, "doc_id").toPandas()
    held = got[got["held_out"]]
    pos, neg = held[held["toxic"] == 1]["score"].to_numpy(), held[held["toxic"] == 0]["score"].to_numpy()
    auc = ((pos[:, None] > neg[None]).mean() + (pos[:, None] == neg[None]).mean() / 2)
    assert len(pos) > 20 and auc > 0.9
    assert (held["predicted"] == held["toxic"]).mean() > 0.9


def test_toxicity_edges(docs, empty, spark):
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, None), (6, 0)], "doc_id long, toxic int")
    got = toxicity.scored(docs, labels, F.lit(True)).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.scored(empty, labels.limit(0), F.lit(True)).count() == 0
    kept = toxicity.clean(docs, labels.limit(0), F.lit(True))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_toxicity_of_repeated_ids(spark):
    """An id that thousands of rows repeat is one row of the sample."""
    rows = [(1, f"calm words {i}") for i in range(3000)] + [(i, "you vile fool" if i % 2 else "a fine day") for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2 if i > 1 else 0) for i in range(1, 60)], "doc_id long, toxic int")
    lexicon, model, knots, share = toxicity.fitted(docs, labels, F.lit(True))
    assert 0.4 < share < 0.6 and model is not None and len(lexicon[0])


def features_of(text, lexicon):
    """The features of one text by their definitions; lexicon maps a whole word to its weight."""
    def runs_of(inside):
        out, at = [], None
        for i, b in enumerate([*text, 32]):
            ok = inside(b) and i < len(text)
            if ok and at is None:
                at = i
            if not ok and at is not None:
                out.append((at, i))
                at = None
        return out

    letter = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    sign = {ord(k): ord(v) for k, v in toxicity.SIGNS.items()}
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in text)
    plain = bytes(sign.get(b, b) for b in low)
    spans = runs_of(letter)
    weight = [lexicon.get(low[a:b], 0.0) for a, b in spans]
    second = [low[a:b].decode(errors="replace") in toxicity.SECOND_PERSON for a, b in spans]
    near = [w > 0 and any(second[max(0, i - toxicity.NEAR) : i + toxicity.NEAR + 1]) for i, w in enumerate(weight)]
    odd = [(a, b) for a, b in runs_of(lambda c: letter(c) or c in sign) if any(c in sign for c in text[a:b]) and sum(map(letter, text[a:b])) >= 2 and letter(text[b - 1])]
    signed = [lexicon.get(plain[a:b], 0.0) for a, b in odd]
    n, size = max(1, len(spans)), max(1, len(text))
    caps = lambda a, b: all(65 <= c <= 90 for c in text[a:b])
    space = {9, 10, 11, 12, 13, 32}
    same = sum(text[i] == text[i - 1] == text[i - 2] and text[i] not in space for i in range(2, len(text)))
    hits = sum(w > 0 for w in weight)
    return [
        sum(weight) / n, math.log1p(hits + sum(w > 0 for w in signed)), max([0.0, *weight, *signed]), math.log1p(sum(near)), sum(second) / n, sum(65 <= c <= 90 for c in text) / size,
        sum(b - a >= 3 and caps(a, b) for a, b in spans) / n, text.count(b"!") / size, text.count(b"?") / size, sum(32 < c < 128 and not letter(c) and not 48 <= c <= 57 for c in text) / size,
        len(odd) / n, sum(signed), sum(48 <= c <= 57 for c in text) / size, math.log1p(n), same / size, hits / n,
    ]


def test_toxicity_features_against_their_definitions():
    lexicon = {b"fool": 2.0, b"vile": 3.5}
    key = toxicity._hashes(["fool", "vile"])
    order = np.argsort(key)
    held = (key[order], np.array([2.0, 3.5])[order])
    texts = [b"", b"you FOOL!!!", b"a v1le f00l, ten words away from here and there and you", "tu es vile? caf\u00e9 aaa 123".encode(), b"F00L f0ol vile vile YOU fool", b"   ", b"no hit at all 5%"]
    buf, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    assert np.allclose(toxicity.features(buf, ends, held), [features_of(t, lexicon) for t in texts])


def test_trees_against_an_exhaustive_search():
    """Each tree's splits have the largest gain over all features and bins, its leaves the Newton step, and margins are their sum."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 3))
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 0)).astype(float)
    model = toxicity.Trees(x, y, trees=3, depth=2)
    b = model._binned(x)
    f = np.full(300, model.start)
    for split, value in model.trees:
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        node = np.zeros(300, np.int64)
        for d in range(2):
            for k in range(2**d):
                own = node == k
                gain = lambda left: g[own & left].sum() ** 2 / (h[own & left].sum() + 1) + g[own & ~left].sum() ** 2 / (h[own & ~left].sum() + 1)  # noqa: E731, B023
                if own.sum() >= 20:
                    best = max(gain(b[:, c] <= i) for c in range(3) for i in range(toxicity.BINS))
                    c, i = split[2**d - 1 + k]
                    assert abs(gain(b[:, c] <= i) - best) < 1e-9
            at = split[2**d - 1 + node]
            node = node * 2 + (b[np.arange(300), at[:, 0]] > at[:, 1])
        want = [toxicity.RATE * g[node == k].sum() / (h[node == k].sum() + 1) for k in range(4)]
        assert np.allclose(value, want)
        f += value[node]
    assert np.allclose(model.margin(x), f)


def test_isotonic_against_min_max():
    """The fit at each point is the largest over starts of the least mean over ends, up to the half count that pulls pools in."""
    rng = np.random.default_rng(9)
    x = np.sort(rng.normal(size=40))
    y = (x + rng.normal(size=40) > 0).astype(float)
    xs, ys = toxicity.isotonic(x, y)
    want = np.array([max(min(y[a : b + 1].mean() for b in range(i, 40)) for a in range(i + 1)) for i in range(40)])
    got = np.interp(x, xs, ys)
    assert all((want[i] == want[i + 1]) <= (abs(got[i] - got[i + 1]) < 1e-9) for i in range(39)) and np.abs(got - want).max() <= 0.51


def test_isotonic_does_not_fall():
    x = np.random.default_rng(1).normal(size=500)
    y = (x + np.random.default_rng(2).normal(size=500) > 0).astype(float)
    xs, ys = toxicity.isotonic(x, y)
    assert (np.diff(xs) >= 0).all() and (np.diff(ys) >= 0).all() and ys.min() >= 0 and ys.max() <= 1


def words(t):
    return [*(t or "").encode().lower().split(), None]


def test_language_model(spark, docs, raw, empty):
    learn = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 != 0
    c, pair, ctx = Counter(), Counter(), Counter()
    for r in raw:
        if learn(r[0]):
            w = words(r[1])
            c.update(w)
            pair.update(zip([0, *w[:-1]], w, strict=True))
            ctx.update([0, *w[:-1]])
    n, v, k = sum(c.values()), len(c), lm.PRIOR
    want = Counter()
    for r in raw:
        w = words(r[1])
        p = [(c[x] + 0.1) / (n + 0.1 * (v + 1)) for x in w]
        score = sum(math.log10((pair[a, x] + k * q) / (ctx[a] + k)) for a, x, q in zip([0, *w[:-1]], w, p, strict=True))
        want[r[0], not learn(r[0]), len(w), sum(c[x] > 0 for x in w), round(sum(map(math.log10, p)), 6), round(score / len(w), 3)] += 1
    for shard_tokens in (10**9, 50):
        got = lm.scored(docs, lm.learn_rule(F.col("doc_id")), shard_tokens=shard_tokens).collect()
        assert all(r["train_tokens"] == n for r in got)
        a = sorted(((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 5), r["score"] / r["n_tokens"]) for r in got))
        b = sorted((str(x[0]), x[2], x[3], round(x[4], 5), x[5]) for x, m in want.items() for _ in range(m))
        assert [x[:3] for x in a] == [x[:3] for x in b]
        assert np.allclose([x[3] for x in a], [x[3] for x in b], atol=1e-4) and np.allclose([x[4] for x in a], [x[4] for x in b], atol=2e-3)
    assert lm.scored(empty, F.lit(True)).count() == 0
    assert lm.scored(docs, F.lit(False)).where("n_known = 0 AND train_tokens = 0").count() == len(raw)


def test_elias_fano():
    rng = np.random.default_rng(4)
    for n, top in ((0, 5), (1, 1), (1000, 1 << 50), (5000, 300), (300, 1)):
        x = np.sort(rng.integers(0, top, n)).astype(np.int64)
        ef = eliasfano.EliasFano(*eliasfano.EliasFano.parts(x, top))
        i = rng.integers(0, max(n, 1), 2000) if n else np.zeros(0, np.int64)
        assert (ef.get(i).astype(np.int64) == x[i]).all()


def test_trie_finds_what_it_holds():
    first = np.array([3, 9, 12], np.uint64)
    trie = eliasfano.Trie(first, np.array([2, 0, 3]), np.array([5, 8, 1, 5, 900]), np.array([-1.0, -2, -3]), np.array([-0.5, -0.6, -0.7, -0.8, -0.9]), 1 << 10)
    rank, pair, single = trie.find(np.array([3, 3, 9, 12, 12, 4], np.uint64), np.array([8, 9, 5, 900, 2, 5], np.uint64))
    assert rank.tolist() == [0, 0, 1, 2, 2, -1]
    assert np.allclose(np.nan_to_num(pair, nan=9), [-0.6, 9, 9, -0.9, 9, 9], atol=1e-3)
    trie.close()


def test_language_model_tells_rare_words_in_a_large_corpus():
    """Back-off values stay those of the formula at 4e9 training tokens, where they fall below 1e-14 of a token."""
    total, distinct, counts = 4 * 10**9, 10**7, [0, 1, 3, 100, 11_000]
    held = np.arange(1, len(counts) + 1).astype(np.uint64)
    word, before = np.repeat(held, 2), np.tile(np.array([7, 9], np.uint64), len(counts))
    trained = np.stack([np.zeros(len(counts), np.int64), counts], axis=1).reshape(-1)  # none after 7, all after 9
    row = pa.table([pa.array([0]), pa.array([0]), pa.array([lm._packed(word, before, trained)], pa.binary())], schema=lm._MAP)
    none = np.zeros(0, np.uint64)
    blob = lm._answering(total, distinct, none, np.zeros(0, np.int64), lm.PRIOR)(row).column("blob")[0].as_py()
    scale, c, _, _, codes, _ = lm._arrays(blob)
    assert c.tolist() == counts
    got = scale[0] + codes[::2] * scale[1]
    base = total + lm.ADD * (distinct + 1)
    for i, c in enumerate(counts):
        assert abs(got[i] - math.log10(lm.PRIOR * (c + lm.ADD) / base)) < 1e-3, (c, got[i])


def test_words_that_share_a_hash(spark, docs, monkeypatch):
    """Two words of one hash are found by their second one, and another salt is taken."""
    real = lm.disjoint_hash
    weak = lm._table(0)
    monkeypatch.setattr(lm, "disjoint_hash", lambda buf, start, end, table: real(buf, start, end, table) & np.uint64(0xFFF) if (table == weak).all() else real(buf, start, end, table))
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{i}" for i in range(9000))])], names=["text"])
    shared = [sum((b.column("least").to_numpy() < b.column("most").to_numpy()).sum() for b in lm._counting(salt)([batch])) for salt in (0, 1)]
    assert shared[0] > 0 and shared[1] == 0


@pytest.fixture(scope="module")
def voc():
    return lattice.vocabulary(lattice.model_path())


def brute_best(voc, score, text):
    ids = {b: i for i, b in reversed(list(enumerate(voc.bytes))) if b and i not in set(voc.byte_id)}
    s = b" " + text.encode()
    best = [0.0] + [-1e300] * len(s)
    for j in range(1, len(s) + 1):
        for n in range(1, min(j, voc.longest) + 1):
            i = ids.get(s[j - n : j], int(voc.byte_id[s[j - 1]]) if n == 1 else None)
            if i is not None:
                best[j] = max(best[j], best[j - n] + score[i])
    return best[-1]


#: Ties without a certain cut, and cuts in all places.
LONG = ["a" * 1800, "ab" * 900, " " * 2000, "x" * 1501, "the the " * 300, "é▁😀 ñ" * 250, "ing" * 500 + " " + "tion" * 300]


def test_encoding_round_trip_and_scan(spark, docs, raw, empty, voc):
    score = spm.scores(voc)
    whole = spm.round_trip(docs).collect()
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in whole) == Counter((r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in raw)
    long_ = spark.createDataFrame([(i, t) for i, t in enumerate(LONG)], "doc_id long, text string").unionByName(docs.where("doc_id IN (11, 12, 13)").select("doc_id", "text"))
    plain = {r["doc_id"]: r["ids"] for r in spm.encoded(long_, giant=10**9).collect()}
    for chunk in (64, 700):  # 64 gives several blocks of chunks
        assert {r["doc_id"]: r["ids"] for r in spm.encoded(long_, giant=1000, chunk=chunk).collect()} == plain
    texts = {r[0]: r[1] for r in raw}
    for r in whole:
        if r["doc_id"] is not None and texts[r["doc_id"]] and len(texts[r["doc_id"]]) < 600:
            assert abs(score[np.array(r["ids"])].sum() - brute_best(voc, score, texts[r["doc_id"]])) < 1e-6
    back = {r["doc_id"]: r["text"] for r in spm.decoded(spm.encoded(docs)).collect() if r["doc_id"] is not None}
    assert back == {r[0]: r[1] or "" for r in raw if r[0] is not None}
    assert spm.round_trip(empty).count() == 0


def test_products_associate():
    rng = np.random.default_rng(6)
    a, b, c = rng.normal(size=(3, 5, 5))
    assert np.allclose(spm.combined(spm.combined(a, b), c), spm.combined(a, spm.combined(b, c)))


def test_pipeline_of_edge_rows(spark, docs, raw, empty, tmp_path):
    """All stages on nulls, copies, long texts and clashing columns, and on an empty table: as brute force says, stage by stage."""
    import corpus_pipeline

    for name, frame in (("some", docs), ("none", empty)):
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    steps, at = {}, spark.read.parquet(f"{tmp_path}/some/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = common.materialize(stage(spark, at, f"{tmp_path}/some"), "edge-stage")
        steps[name] = [tuple(r) for r in at.collect()]
        assert at.columns == docs.columns
    assert Counter(steps["toxicity"]) == Counter(raw)  # no labels: nothing goes
    norm = lambda t: "".join((t or "").split())
    best = {}
    for r in raw:
        best.setdefault(norm(r[1]), []).append(r)
    want = Counter((min(v, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0], k) for k, v in best.items())
    assert Counter((r[0], norm(r[1])) for r in steps["exact_dedup"]) == want
    sets, group = [], {}
    for r in steps["exact_dedup"]:
        w = (r[1] or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    for i, a in enumerate(sets):
        group[i] = next((j for j in range(i) if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j])), i)
    assert all(group[j] == j for j in group.values())  # no chains here
    kept = [min((r for i, r in enumerate(steps["exact_dedup"]) if group[i] == g), key=lambda r: (r[0] is None, r[0] or 0)) for g in set(group.values())]
    assert Counter(r[:2] for r in steps["near_dedup"]) == Counter(r[:2] for r in kept)
    assert {r[:2] for r in steps["mixing"]} <= {r[:2] for r in steps["near_dedup"] if norm(r[1])}
    out = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in out) == Counter((r[0], hashlib.sha256(r[1].encode()).hexdigest()) for r in steps["mixing"])
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = table(spark, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "mixing", "sentencepiece"]
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = common.materialize(stage(spark, docs, SMALL), "test-stage")
        assert docs.columns == before.columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] and sizes[1] > 0.8 * sizes[0]
    assert docs.select("text").distinct().count() > 0.5 * sizes[3]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    bad = out.join(docs.select("doc_id", F.sha2("text", 256).alias("sha")).distinct(), "doc_id").where("sha <> decoded_sha256")
    assert out.count() == sizes[4] and bad.isEmpty()
    assert mixing.mixed(table(spark, "documents")).count() == sizes[0]
