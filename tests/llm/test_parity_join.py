"""Components against all shared shingles, the bounds of the sketches, and hot groups."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from shelfwise.llm import parity_join as P
from shelfwise.llm.texts import as_bytes


def sets_of(docs):
    out = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        out[i] = frozenset(tuple(w[j:j + 5]) for j in range(max(len(w) - 4, 1))) if w else frozenset()
    return out


def brute(docs):
    sets, part = sets_of(docs), {i: i for i, _ in docs}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    def join(a, b):
        a, b = root(a), root(b)
        part[max(a, b)] = min(a, b)

    holders, classes = defaultdict(list), defaultdict(list)
    for i, s in sets.items():
        classes[s].append(i)
    for s, ids in classes.items():
        for i in ids[1:] if s else ():
            join(ids[0], i)
        for x in s:
            holders[x].append(s)
    for s in classes:
        shared = Counter(t for x in s for t in holders[x])
        for t, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(t) - n):
                join(classes[s][0], classes[t][0])
    return {i: (len(s), root(i)) for i, s in sets.items()}


def documents(seed=3):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(2000)]

    def changed(w, p):
        out = []
        for x in w:
            r = draw.random()
            out += [] if r < p / 3 else [draw.choice(vocabulary)] if r < 2 * p / 3 else [x, draw.choice(vocabulary)] if r < p else [x]
        return out

    common = [draw.choice(vocabulary) for _ in range(30)]
    texts = []
    for b in range(100):
        w = [draw.choice(vocabulary) for _ in range(int(2 ** draw.uniform(0, 9)))]
        if b % 3 == 0:
            w[len(w) // 2:len(w) // 2] = common
        texts.append(" ".join(w))
        for c in range(draw.choice([0, 1, 2, 5, 12])):
            x = changed(w, draw.choice([0, .01, .02, .03, .045, .06, .1]))
            texts.append(" ".join(x).upper() if c % 4 == 0 else " ".join(x))
            w = x if draw.random() < .3 else w
    base = [draw.choice(vocabulary) for _ in range(120)]
    texts += [" ".join(changed(base, .02)) for _ in range(300)]
    texts += ["", None, "  \t", "a", "A", "a b c d", "a b c d e", "a b c d e f"] * 2
    docs = list(enumerate(texts))
    draw.shuffle(docs)
    return docs


def test_components_equal_brute_force(spark):
    docs = documents()
    df = spark.createDataFrame([(*d, "x", 5) for d in docs], "doc_id long, text string, node string, n int").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in P.jaccard_classes(df).collect()}
    assert got == brute(docs)


def test_tiles_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(P, "TILE", 7)
    docs = documents(4)[:250]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in P.jaccard_classes(df).collect()}
    assert got == brute(docs)


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "a b c d e f g"), (None, "a b c d e f g"), (3, "a b c d e f g"), (3, "a b c d e f g"), (2, "A b c d e f g")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in P.jaccard_classes(df).collect()), key=str)
    assert got == [(2, 2), (3, 2), (3, 2), (None, None), (None, None)]
    assert P.jaccard_classes(df.limit(0)).count() == 0


def test_distances_bound_the_difference():
    draw = random.Random(1)
    for n in (6, 40, 200, 900):
        w = [f"x{draw.randrange(10 ** 6)}" for _ in range(n)]
        v = [x if draw.random() > 0.02 else "new" for x in w] + ["tail"] * draw.randrange(3)
        rows, code = P.shingle_sets(*as_bytes(pa.array([" ".join(w), " ".join(v)])))
        size, _ = P.digests(rows, code, 2)
        a, b = set(code[rows == 0].tolist()), set(code[rows == 1].tolist())
        sketches = [np.frombuffer(s, np.uint64)[None, :] for s in P.bit_sketches(rows, code, size)]
        length = min(s.shape[1] for s in sketches)
        x, y = (P.folded(s, length) for s in sketches)
        assert np.bitwise_count(x ^ y).sum() <= len(a ^ b)
        if 100 * len(a & b) >= 80 * len(a | b):
            keys = []
            for part, band, differ in P.bands(size):
                of, key = P.sketch_words(rows, code, part, band, differ, np.ones(64, np.int64))
                keys += [set(key[of == r].tolist()) for r in (0, 1)]
            assert (keys[0] | keys[2]) & (keys[1] | keys[3])


def test_short_sketches_are_lengthened():
    rows, code = P.shingle_sets(*as_bytes(pa.array(["a b c d e f g h i j k"])))
    code = np.array([(i << 24) * 64 for i in range(1, len(code) + 1)], np.uint64)  # all in one word
    part, band, differ = P.bands(np.array([len(code)]))[0]
    assert P.factor_needed(rows, code, 1, part, band, differ)[0] > 1


def test_a_forest_joins_each_class_once():
    root = {}
    assert P.newly_joined(root, 1, np.array([2, 3, 2, 4]), np.array([5, 1, 3, 2])) == [1, 3, 2]
    assert P.newly_joined(root, 4, np.array([2, 3, 9]), np.array([0, 0, 7])) == [2]
    assert P.newly_joined(root, 9, np.array([1]), np.array([0])) == []


def test_links_the_forest_leaves_out_are_found_after_it(spark, monkeypatch):
    """An empty forest must not end the search: the pass over all pairs follows."""
    seen = []
    plain = P.pairs_between

    def passes(members, parts, forest):
        seen.append(forest)
        found = plain(members, parts, forest)
        return found.limit(0) if forest else found

    monkeypatch.setattr(P, "pairs_between", passes)
    docs = documents(6)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in P.jaccard_classes(df).collect()}
    assert got == brute(docs) and seen == [True, False]
