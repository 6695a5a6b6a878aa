"""License spans against a plain matcher over words, and planted sentences."""

import random
import re

import pytest

from shelfwise.llm import licenses

KIND = "doc_id long, text string"


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(licenses.WORD, lower)


def brute_spans(words):
    """All matches of all rules (no prefilter), then suppression by comparing every two spans."""
    norm = "".join(f" {w} " for w in words)
    every = []
    for i, r in enumerate(licenses.RULES):
        for m in re.finditer(r.pattern, norm):
            start = norm[:m.start()].count(" ") // 2
            every.append((start, start + m.group().count(" ") // 2, r.label, i, r.priority, r.score))
    return sorted(
        d for d in every if not any(
            e[0] <= d[0] and e[1] >= d[1] and (e[4], -(e[1] - e[0]), e[3]) < (d[4], -(d[1] - d[0]), d[3]) for e in every))


def brute(text):
    words = words_of(text)
    places = [(i, label) for p, label in licenses.BASE.items() for i in range(len(words))
              if words[i:i + len(p.split())] == p.split()]
    spans = brute_spans(words)
    at = [i for i, _ in places]
    base = {label for _, label in places}
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {s[2] for s in spans})), max([s[5] for s in spans], default=0.0))


PLANTED = [
    ("SPDX-License-Identifier: GPL-3.0-or-later", {"gpl-3.0"}),
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl", "gpl-3.0"}),
    ("under the GNU Lesser General Public License v2.1", {"lgpl-2.1"}),
    ("Licensed under the Apache License, Version 2.0.", {"apache", "apache-2.0"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc-4.0"}),
    ("Released under the MIT License.", {"mit"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", {"mit"}),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", {"bsd"}),
    ("https://creativecommons.org/licenses/by-sa/4.0/", {"cc-by-sa"}),
    ("Copyright Example. All rights reserved", {"proprietary"}),
    ("A plain sentence about general things and the apache helicopter by the sea", set()),
    ("cc by cc by", {"cc-by"}),
]


def texts():
    draw = random.Random(4)
    vocab = sorted({w for r in licenses.RULES for w in r.needs}) + ["x", "ñandú", "the", "version"]
    out = [None, "", "...", *[t for t, _ in PLANTED], "MIT License" * 3, "mit license mit licensé", "gnu gnu general public license license"]
    for _ in range(150):
        parts = []
        for _ in range(draw.choice([1, 3, 12])):
            kind = draw.random()
            if kind < 0.5:
                chosen = draw.choice(licenses.RULES).words.split()
                parts += [draw.choice(w.rstrip("?").split("|")) for w in chosen if not w.endswith("?") or draw.random() < 0.5]
            elif kind < 0.7:
                parts += draw.choice(PLANTED)[0].split()
            parts += draw.choices(vocab, k=draw.choice([0, 2, 20]))
        out.append(draw.choice([" ", "-", "\n"]).join(p for p in parts if "*" not in p))
    return out


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def test_report_and_spans_follow_the_definition(spark):
    rows = [*enumerate(texts()), (None, "MIT License"), (3, texts()[3])]
    df = spark.createDataFrame(rows, KIND).repartition(8)
    got = sorted(str(tuple(r)) for r in licenses.license_report(df).select("doc_id", *COLUMNS).collect())
    assert got == sorted(str((i, *brute(t))) for i, t in rows)
    spans = {r.id: [tuple(s) for s in r.spans] for r in licenses.find_licenses(df.where("doc_id < 60"), "doc_id", "text").collect()}
    for i, t in enumerate(texts()[:60]):
        assert sorted(spans[i]) == brute_spans(words_of(t)), t


@pytest.mark.parametrize("text, labels", PLANTED)
def test_planted_sentences(text, labels):
    assert set(filter(None, brute(text)[5].split(","))) == labels


def test_every_rule_is_found_in_its_own_words():
    for i, r in enumerate(licenses.RULES):
        words = [w.rstrip("?").split("|")[0] for w in r.words.split() if not w.startswith("*")]
        assert re.fullmatch(r.pattern, "".join(f" {w} " for w in words)), r
        assert r.needs and set(r.needs) <= set(words), r
    assert len(licenses.RULES) > 400


def test_very_long_text_with_more_spans_than_a_sweep(spark):
    text = "the mit license and " * 2000 + "word " * 100_000 + "licensed under the gnu gpl"
    got = licenses.license_report(spark.createDataFrame([(1, text)], KIND)).first()
    assert (got.n_words, got.n_base, got.first_word, got.last_word) == (108_005, 2000, 1, 7997)
    assert got.labels == "gpl,mit,unknown" and len(licenses.find_licenses(
        spark.createDataFrame([(1, text)], KIND), "doc_id", "text").first().spans) > 3 * licenses.SWEEP


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "MIT License", 5, "x", 3)], KIND + ", words int, norm string, id int")
    assert [r.labels for r in licenses.license_report(df).collect()] == ["mit"]
    assert licenses.license_report(spark.createDataFrame([], KIND)).collect() == []


def test_plan_is_native(spark):
    plan = licenses.license_report(spark.createDataFrame([(1, "x")], KIND))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
