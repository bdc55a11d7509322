"""Exact and near dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

from pagecraft.llm import exact_dedup, minhash_dedup


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def test_exact_groups(docs, raw):
    groups = defaultdict(list)
    for r in raw:
        groups[norm(r[1])].append(r)
    best = {k: min(v, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for k, v in groups.items()}
    want = Counter((r[0], best[norm(r[1])][0], len(groups[norm(r[1])]), hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in raw)
    for block in (4, exact_dedup.BLOCK):
        got = exact_dedup.decisions(docs, block).collect()
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
        assert sum(r["kept"] for r in got) == len(groups)
    left = exact_dedup.deduplicated(docs).collect()
    assert Counter((r["doc_id"], norm(r["text"])) for r in left) == Counter((b[0], k) for k, b in best.items())
    assert left[0].asDict().keys() == {*docs.columns}


def test_exact_with_colliding_keys(docs, monkeypatch):
    """Keys that meet are found by their contents, and another salt is taken."""
    real = exact_dedup.block_key
    used = []

    def weak(block, salt):
        used.append(salt)
        key = real(block, salt)
        return exact_dedup.F.substring(key, 1, 1) if salt == 0 else key

    monkeypatch.setattr(exact_dedup, "block_key", weak)
    got = exact_dedup.decisions(docs, 16)
    n = got.where("kept").count()
    assert max(used) == 1 and n == len({norm(r["text"]) for r in docs.collect()})


def shingles(t, width):
    w = (t or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < width else [tuple(w[i : i + width]) for i in range(len(w) - width + 1)])


def components(raw, width, percent):
    sets = [shingles(r[1], width) for r in raw]
    root = list(range(len(raw)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(raw)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(raw):
        low.setdefault(find(i), []).append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in low.items()}
    return Counter((r[0], len(sets[i]), least[find(i)] if sets[i] else r[0]) for i, r in enumerate(raw))


def test_near_groups(docs, raw):
    for width in (2, 5):
        got = minhash_dedup.near_groups(docs, width, 80).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == components(raw, width, 80)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_chain_and_star(spark):
    """A chain whose ends are unlike is one component; a large group of mutual near copies stays whole."""
    base = [f"w{i}" for i in range(100)]
    chain = [" ".join([f"c{k}x{i}" if i < 3 * k else w for i, w in enumerate(base)]) for k in range(12)]
    star = [" ".join([*(f"s{i}" for i in range(80)), f"u{k}"]) for k in range(150)]
    rows = [(i, t) for i, t in enumerate(chain + star)]
    got = minhash_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == components(rows, 2, 80)


def test_near_keeps_one_row_of_each_component(spark):
    """Null and repeated ids neither take unrelated rows with them nor keep near copies."""
    say = lambda k, n=60: " ".join(f"{k}x{i}" for i in range(n))
    rows = [(1, say("a")), (None, say("a") + " tail"), (None, say("b")), (None, say("c"))]  # c and b are clean
    rows += [(None, say("d")), (None, say("d") + " tail"), (None, say("d") + " other")]  # one group without ids
    rows += [(5, say("e")), (7, say("e") + " tail"), (7, say("f"))]  # 7's other text is clean
    rows += [(8, say("g")), (8, say("h") + " tail"), (6, say("h")), (9, say("g") + " tail")]  # 8 stands for one group and goes from another
    rows += [(4, say("k")), (4, say("k")), (10, None), (None, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r["doc_id"], r["text"]) for r in minhash_dedup.deduplicated(docs).collect())
    group = defaultdict(list)
    for i, t in rows:
        group[t[0] if t else (i, t)].append((i, t))
    for key, members in group.items():
        kept = [x for x in members if got[x]]
        ids = [i for i, _ in members if i is not None]
        assert sum(got[x] for x in set(members)) == 1, (key, kept)
        assert {x[0] for x in set(members) if got[x]} == {min(ids) if ids else None}
    assert sum(got.values()) == len(group)


def test_empty(empty):
    assert exact_dedup.decisions(empty).count() == 0
    assert minhash_dedup.near_groups(empty).count() == 0
    assert exact_dedup.deduplicated(empty).count() == 0 and minhash_dedup.deduplicated(empty).count() == 0
