"""Every probability against a dictionary version; the distribution adds up to one."""

import math
import os
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from shelfwise.llm import kneser_ney as K
from shelfwise.llm.texts import as_bytes

TEXTS = ["the cat sat on the mat", "The cat ate", "the dog sat on the cat", "", None, "a\tb\x0bc  d", "É é THE the",
         "on the mat the cat sat", "zebra", "the " * 300, "Ünïcode wörds hère", "the cat sat on the mat"]


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


class Plain:
    def __init__(self, texts):
        self.c = Counter(w for t in texts for w in tokens(t))
        self.big = Counter(p for t in texts for p in zip([0, *tokens(t)[:-1]], tokens(t)))
        self.total, self.types, self.n = Counter(), Counter(), defaultdict(Counter)
        for (a, b), k in self.big.items():
            self.total[a] += k
            self.types[b] += 1
            self.n[a][min(k, 3)] += 1
        counts = lambda x: [sum(v == i for v in x.values()) for i in range(1, 5)]
        self.high, self.low, u = K.discounts(counts(self.big)), K.discounts(counts(self.types)), counts(self.types)
        self.v, self.all = len(self.c), sum(self.c.values())
        self.spread = (self.low[1] * u[0] + self.low[2] * u[1] + self.low[3] * (self.v - u[0] - u[1])) / max(len(self.big), 1)

    def unigram(self, w):
        t = self.types[w]
        return max(t - self.low[min(t, 3)], 0) / max(len(self.big), 1) + (self.spread if self.v else 1) / (self.v + 1)

    def p(self, a, b):
        if not self.total[a]:
            return self.unigram(b)
        k = self.big[a, b]
        back = sum(self.high[i] * self.n[a][i] for i in (1, 2, 3)) / self.total[a]
        return max(k - self.high[min(k, 3)], 0) / self.total[a] + back * self.unigram(b)


def test_scores_equal_plain_model(spark):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(60)]
    got = {r["doc_id"]: r for r in K.lm_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    m = Plain([t for i, t in rows if not out[i]])
    for i, text in rows:
        seq, r = tokens(text), got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (out[i], len(seq), m.all)
        assert r["n_known"] == sum(m.c[w] > 0 for w in seq)
        assert r["base_score"] == pytest.approx(sum(math.log10((m.c[w] + 1) / (m.all + m.v + 1)) for w in seq))
        assert r["score"] == pytest.approx(sum(math.log10(m.p(a, b)) for a, b in zip([0, *seq[:-1]], seq)))
    for context in (b"the", 0, b"never seen"):
        assert sum(m.p(context, w) for w in m.c) + m.p(context, b"unknown") == pytest.approx(1)


def test_counts_beyond_a_byte_and_empty_training(spark):
    rows = [(1, "x " * 1000), (2, "x y")]
    model = K.build_model(spark.createDataFrame(rows, "doc_id long, text string"), "text")
    m = Plain([t for _, t in rows])
    got = K.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), "text", model, ["doc_id"]).collect()
    for r, (_, t) in zip(sorted(got), rows):
        seq = tokens(t)
        assert r["score"] == pytest.approx(sum(math.log10(m.p(a, b)) for a, b in zip([0, *seq[:-1]], seq)))
    none = spark.createDataFrame([], "doc_id long, text string")
    assert K.lm_report(none).count() == 0
    empty = K.build_model(none, "text")
    assert [r["score"] for r in K.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), "text", empty, ["doc_id"]).collect()] == [0.0, 0.0]


def test_a_worker_keeps_no_file_of_the_model_open(spark, monkeypatch):
    monkeypatch.setattr(K, "LEAST_SHARDS", 256)
    texts = [" ".join(f"w{i * j % 997}" for j in range(200)) for i in range(1, 20)]
    model = K.build_model(spark.createDataFrame([(t,) for t in texts], "text string"), "text")
    assert len(model["shards"]) > 200
    seen, before, _ = K.sequences(*as_bytes(pa.array(texts)))
    held = len(os.listdir("/proc/self/fd"))
    count, _ = K.token_logs(seen, before, model)
    assert count.min() > 0 and len(os.listdir("/proc/self/fd")) <= held + 5
