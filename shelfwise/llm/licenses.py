"""License mentions, grants and texts in whole documents, with DataFrame functions only.

A text becomes its words in lower case, each between its own pair of spaces, so
rules are regular expressions over whole words. A rule has a priority (the lower
the stronger), a score, and the words it cannot do without. These words are the
prefilter: the words of a text are intersected with them once, and only rules
whose words are all present are matched. A match is put between two marks; the
places of the marks among the words are its span. A span that lies within the
span of a stronger rule (or of an equally strong one that is longer, or as long
and earlier in the list) is suppressed.

Rules are written in a word notation: ``a|b`` is either word, a trailing ``?``
makes a word optional, ``*3`` stands for up to three words of any kind. The
signatures are written one by one; the rules of named licenses follow from the
table of names and versions.

Defined results: a null or empty text has no words and no spans; repeated rows
are kept as they are; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
OPEN, SHUT = "\u0001", "\u0002"
#: Spans are swept in runs of about this many, so that no state grows with the text.
SWEEP = 256

# Named licenses: label, name in word notation, short word (or none), versions.
NAMED = [
    ("gpl", "gnu? general public license|licence", "gpl", "1.0 2.0 3.0"),
    ("lgpl", "gnu? lesser|library general public license|licence", "lgpl", "2.0 2.1 3.0"),
    ("agpl", "gnu? affero general public license|licence", "agpl", "1.0 3.0"),
    ("gfdl", "gnu? free documentation license|licence", "gfdl", "1.1 1.2 1.3"),
    ("apache", "apache software? license|licence", None, "1.0 1.1 2.0"),
    ("mpl", "mozilla public license|licence", "mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse public license|licence", "epl", "1.0 2.0"),
    ("cddl", "common development and distribution license|licence", "cddl", "1.0 1.1"),
    ("cpl", "common public license|licence", None, "1.0"),
    ("eupl", "european union public license|licence", "eupl", "1.0 1.1 1.2"),
    ("osl", "open software license|licence", None, "1.0 2.0 2.1 3.0"),
    ("afl", "academic free license|licence", None, "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", "artistic license|licence", None, "1.0 2.0"),
    ("bsl", "boost software license|licence", None, "1.0"),
    ("zpl", "zope public license|licence", "zpl", "1.1 2.0 2.1"),
    ("psf", "python software foundation license|licence", None, "2.0"),
    ("php", "php license|licence", None, "3.0 3.01"),
    ("lppl", "latex project public license|licence", "lppl", "1.0 1.1 1.2 1.3"),
    ("ofl", "sil? open font license|licence", None, "1.0 1.1"),
    ("cecill", "cecill free? software? license|licence", "cecill", "1.0 2.0 2.1"),
    ("ms-pl", "microsoft public license|licence", None, ""),
    ("ms-rl", "microsoft reciprocal license|licence", None, ""),
    ("odbl", "open database license|licence", "odbl", "1.0"),
    ("odc-by", "open data commons attribution license|licence", None, "1.0"),
    ("pddl", "public domain dedication and license|licence", "pddl", "1.0"),
    ("cc-by-nc-nd", "cc by nc nd", None, "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-sa", "cc by nc sa", None, "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc", "cc by nc", None, "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nd", "cc by nd", None, "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-sa", "cc by sa", None, "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by", "cc by", None, "1.0 2.0 2.5 3.0 4.0"),
    ("cc0", "cc0", None, "1.0"),
    ("mit", "mit license|licence", None, ""),
    ("mit-0", "mit no attribution license|licence?", None, ""),
    ("x11", "x11 license|licence", None, ""),
    ("isc", "isc license|licence", None, ""),
    ("bsd", "bsd license|licence", None, ""),
    ("bsd-2-clause", "simplified bsd license|licence", None, ""),
    ("bsd-3-clause", "new|modified|revised bsd license|licence", None, ""),
    ("bsd-4-clause", "original bsd license|licence", None, ""),
    ("0bsd", "zero clause bsd", "0bsd", ""),
    ("zlib", "zlib libpng? license|licence", None, ""),
    ("libpng", "libpng license|licence", None, ""),
    ("unlicense", "the unlicense", "unlicense", ""),
    ("wtfpl", "do what the fuck you want to public license|licence", "wtfpl", ""),
    ("ncsa", "university of illinois ncsa open source license|licence", None, ""),
    ("openssl", "openssl license|licence", None, ""),
    ("postgresql", "postgresql license|licence", None, ""),
    ("vim", "vim license|licence", None, ""),
    ("ruby", "ruby license|licence", None, ""),
    ("curl", "curl license|licence", None, ""),
    ("beerware", "beerware license|licence", "beerware", ""),
    ("upl", "universal permissive license|licence", None, "1.0"),
    ("ecl", "educational community license|licence", None, "1.0 2.0"),
    ("rpl", "reciprocal public license|licence", None, "1.1 1.5"),
    ("qpl", "q public license|licence", None, "1.0"),
    ("sspl", "server side public license|licence", "sspl", "1.0"),
    ("busl", "business source license|licence", "busl", "1.1"),
    ("elastic", "elastic license|licence", None, "1.0 2.0"),
    ("openrail", "open rail m? license|licence", "openrail", ""),
]

GRANT = "licensed|released|distributed|available|published|provided|shared|covered under|by"

# Signatures of texts, notices and reservations: label, priority, score, words.
SIGNATURES = [
    ("mit", 2, 0.95, "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", 3, 0.9, "the above copyright notice and this permission notice shall be included in all copies"),
    ("x11", 3, 0.9, "except as contained in this notice the name *4 shall not be used in advertising"),
    ("isc", 2, 0.95, "permission to use copy modify and|or or? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", 3, 0.9, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 2, 0.95, "neither the name *8 nor the names of its contributors may be used to endorse or promote"),
    ("bsd-4-clause", 2, 0.95, "all advertising materials mentioning features or use of this software must display"),
    ("bsd-2-clause", 4, 0.8, "2|two clause bsd"),
    ("bsd-3-clause", 4, 0.8, "3|three clause bsd"),
    ("bsd-4-clause", 4, 0.8, "4|four clause bsd"),
    ("zlib", 2, 0.95, "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", 3, 0.9, "altered source versions must be plainly marked as such"),
    ("gpl", 2, 0.95, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", 3, 0.9, "this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl", 3, 0.9, "you should have received a copy of the gnu general public license"),
    ("lgpl", 2, 0.95, "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser|library general public license"),
    ("lgpl", 3, 0.9, "you should have received a copy of the gnu lesser|library general public license"),
    ("agpl", 2, 0.95, "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("gfdl", 2, 0.95, "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("apache-2.0", 2, 0.95, "you may not use this file except in compliance with the license *4 you may obtain a copy of the license at"),
    ("apache-2.0", 3, 0.9, "apache org licenses license 2 0"),
    ("apache-1.1", 2, 0.95, "this product includes software developed by the apache software foundation"),
    ("mpl-2.0", 2, 0.95, "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", 2, 0.95, "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl", 2, 0.95, "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", 2, 0.95, "the contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl", 2, 0.95, "you may not use this work except in compliance with the licence"),
    ("bsl-1.0", 2, 0.95, "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("unlicense", 2, 0.95, "this is free and unencumbered software released into the public domain"),
    ("unlicense", 3, 0.9, "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", 2, 0.95, "you just do what the fuck you want to"),
    ("beerware", 2, 0.95, "if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("ofl", 2, 0.95, "this font software is licensed under the sil open font license"),
    ("lppl", 2, 0.95, "this work may be distributed and or modified under the conditions of the latex project public license"),
    ("artistic", 2, 0.95, "you may distribute this program under the terms of either the gnu general public license or the artistic license"),
    ("psf", 2, 0.95, "psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("openssl", 2, 0.95, "this product includes software developed by the openssl project"),
    ("postgresql", 2, 0.95, "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("json", 2, 0.95, "the software shall be used for good not evil"),
    ("ncsa", 2, 0.95, "to deal with the software without restriction including without limitation the rights to use copy modify merge publish"),
    ("cc0", 2, 0.95, "to the extent possible under law *8 waived all copyright and related or neighboring rights"),
    ("cc-by", 3, 0.9, "creative commons attribution *1 international|unported|generic license"),
    ("cc-by-sa", 3, 0.9, "creative commons attribution share|sharealike alike? *2 international|unported|generic license"),
    ("cc-by-nc", 3, 0.9, "creative commons attribution non|noncommercial commercial? *2 international|unported|generic license"),
    ("cc-by-nd", 3, 0.9, "creative commons attribution no|noderivatives|noderivs derivatives|derivs? *2 international|unported|generic license"),
    ("cc-by-nc-sa", 2, 0.95, "creative commons attribution noncommercial sharealike"),
    ("cc-by-nc-nd", 2, 0.95, "creative commons attribution noncommercial noderivatives|noderivs"),
    ("cc-by", 3, 0.9, "creativecommons org licenses by"),
    ("cc-by-sa", 2, 0.95, "creativecommons org licenses by sa"),
    ("cc-by-nc", 2, 0.95, "creativecommons org licenses by nc"),
    ("cc-by-nd", 2, 0.95, "creativecommons org licenses by nd"),
    ("cc-by-nc-sa", 1, 1.0, "creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", 1, 1.0, "creativecommons org licenses by nc nd"),
    ("cc0", 2, 0.95, "creativecommons org publicdomain zero 1 0"),
    ("creative-commons", 5, 0.6, "creative commons license|licence"),
    ("public-domain", 3, 0.9, "released|dedicated|placed|donated into|to|in the public domain"),
    ("public-domain", 6, 0.4, "in the public domain"),
    ("proprietary", 3, 0.8, "all rights reserved"),
    ("proprietary", 2, 0.9, "no part of this publication|book|document|work may be reproduced"),
    ("proprietary", 3, 0.8, "unauthorized copying|use|distribution *6 strictly prohibited"),
    ("proprietary", 3, 0.8, "confidential and proprietary"),
    ("dual", 4, 0.7, "dual|dually licensed under"),
    ("open-source", 6, 0.3, "open source license|licence"),
    ("unknown", 7, 0.2, "licensed under"),
    ("unknown", 7, 0.2, "under the following|attached|enclosed license"),
]


class Rule(NamedTuple):
    label: str
    priority: int
    score: float
    words: str

    @property
    def pattern(self) -> str:
        out = []
        for word in self.words.split():
            often = "?" if word.endswith("?") else ""
            choices = word.rstrip("?").split("|")
            if word.startswith("*"):
                out.append(f"(?: [^ ]+ ){{0,{word[1:]}}}?")
            else:
                core = choices[0] if len(choices) == 1 else f"(?:{'|'.join(choices)})"
                out.append(f"(?: {core} )?" if often else f" {core} ")
        return "".join(out)

    @property
    def needs(self) -> list[str]:
        """Words that are in every match."""
        return sorted({w for w in self.words.split() if not any(c in w for c in "?|*")})


def version_words(version: str) -> str:
    """Word notation of a version: the trailing 0 may be absent, the first number may be glued to a v."""
    first, second = version.split(".")
    return f"version|v? {first}|v{first} {second}{'?' if second == '0' else ''}"


def named_rules(label: str, name: str, short: str | None, versions: str) -> list[Rule]:
    """Mentions, grants and identifiers of a license and of each of its versions."""
    spoken = [name] + ([short] if short else [])
    rules = [Rule(label, 1, 1.0, "spdx license identifier " + label.replace("-", " "))]
    for i, words in enumerate(spoken):
        rules += [Rule(label, 4, 0.8, f"{GRANT} the? terms? of? the? {words}"),
                  Rule(label, 5 + i, 0.6 - 0.2 * i, words)]
    for v in versions.split():
        full = f"{label}-{v}"
        rules.append(Rule(full, 1, 1.0, f"spdx license identifier {label.replace('-', ' ')} {v.replace('.', ' ')} only|or? later?"))
        for i, words in enumerate(spoken):
            rules += [Rule(full, 3, 0.9, f"{GRANT} the? terms? of? the? {words} {version_words(v)}"),
                      Rule(full, 4, 0.7 - 0.1 * i, f"{words} {version_words(v)}")]
    return rules


RULES = [Rule(*s) for s in SIGNATURES] + [r for n in NAMED for r in named_rules(*n)]
PRIORITIES = max(r.priority for r in RULES)


def _anchor(rule: Rule, counts: dict[str, int]) -> str:
    """The word of a rule that the fewest rules need; without it no rule is looked at."""
    return min(rule.needs, key=lambda w: (w.isdigit(), counts[w], -len(w), w))


_COUNTS = {w: sum(w in r.needs for r in RULES) for r in RULES for w in r.needs}
#: A text without any of these words, the rarest of each rule, is not looked at.
GATES = sorted({_anchor(r, _COUNTS) for r in RULES})
NEEDED = sorted({w for r in RULES for w in r.needs} | {w for p in BASE for w in p.split()})
SPAN = "array<struct<start:int,end:int,label:string,rule:int,priority:int,score:double>>"


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _rules() -> Column:
    """The rules as one constant."""
    rows = [{"rule": i, "label": r.label, "priority": r.priority, "score": r.score, "pattern": r.pattern, "needs": r.needs}
            for i, r in enumerate(RULES)]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<rule:int,label:string,priority:int,score:double,"
                       "pattern:string,needs:array<string>>>")


def _places(tokens: Column, mark: str, shift: int) -> Column:
    """Word numbers of the marks among the tokens: the m-th pair of marks has 2 m marks before it."""
    at = F.filter(F.transform(tokens, lambda t, i: F.when(t == mark, i)), lambda i: i.isNotNull())
    return F.transform(at, lambda i, m: i - 2 * m - shift)


def matched(norm: Column, pattern: Column) -> Column:
    """Array of (start, end) in words, end exclusive, of the matches of a pattern."""
    marked = F.regexp_replace(norm, pattern, F.lit(f" {OPEN} $0 {SHUT} "))
    # One-element arrays bind a value once. The first token is the empty one in front of the first space.
    bound = F.transform(F.filter(F.array(marked), lambda x: x.contains(OPEN)), lambda x: F.split(x, " +"))
    return F.flatten(F.transform(bound, lambda t: F.arrays_zip(
        _places(t, OPEN, 1).alias("start"), _places(t, SHUT, 2).alias("end"))))


def _sweep(sorted_spans: Column) -> Column:
    """Spans (by start, longest and strongest first) that no stronger or equal one before them covers."""
    fresh = F.array_repeat(F.lit(0), PRIORITIES)
    none = F.array().cast(SPAN)

    def one(acc: Column, s: Column) -> Column:
        hidden = F.array_max(F.slice(acc["reach"], F.lit(1), s["priority"])) >= s["end"]
        reach = F.transform(acc["reach"], lambda r, p: F.when(p + 1 == s["priority"], F.greatest(r, s["end"])).otherwise(r))
        return F.struct(reach.alias("reach"), F.when(hidden, acc["kept"]).otherwise(F.array_append(acc["kept"], s)).alias("kept"))

    def part(acc: Column, b: Column) -> Column:
        done = F.aggregate(F.slice(sorted_spans, b * SWEEP + 1, F.lit(SWEEP)), F.struct(
            acc["reach"].alias("reach"), none.alias("kept")), one)
        return F.struct(done["reach"].alias("reach"), F.array_append(acc["parts"], done["kept"]).alias("parts"))

    numbers = F.sequence(F.lit(0), F.floor((F.size(sorted_spans) - 1) / SWEEP).cast("int"))
    return F.flatten(F.aggregate(numbers, F.struct(
        fresh.alias("reach"), F.array().cast(f"array<{SPAN}>").alias("parts")), part)["parts"])


def suppressed(spans: Column) -> Column:
    """The spans that are not inside a stronger one, by start."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), s["priority"].alias("priority"), s["rule"].alias("rule"),
        s["label"].alias("label"), s["score"].alias("score"))))
    plain = F.transform(ordered, lambda s: F.struct(
        s["start"].alias("start"), (-s["back"]).alias("end"), s["label"].alias("label"), s["rule"].alias("rule"),
        s["priority"].alias("priority"), s["score"].alias("score")))
    kept = F.transform(F.filter(F.array(plain), lambda x: F.size(x) > 0), _sweep)
    return F.flatten(kept)


def _scanned(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, norm, spans): norm is null where no gate word occurs."""
    words = F.regexp_extract_all(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))
    told = df.select(F.col(id_col).alias("id"), words.alias("words")).withColumn(
        "present", F.array_intersect("words", _strings(NEEDED)))
    gate = F.arrays_overlap("present", _strings(sorted({*GATES, "license", "cc"})))
    normal = told.select(
        "id", F.size("words").cast("long").alias("n_words"), "present",
        F.when(gate, F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))).alias("norm"))
    fit = F.filter(_rules(), lambda r: F.size(F.array_except(r["needs"], F.col("present"))) == 0)
    found = F.flatten(F.transform(fit, lambda r: F.transform(matched(F.col("norm"), r["pattern"]), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), r["label"].alias("label"), r["rule"].alias("rule"),
        r["priority"].alias("priority"), r["score"].alias("score")))))
    empty = F.array().cast(SPAN)
    return normal.withColumn("all", F.when(F.col("norm").isNotNull(), found).otherwise(empty)).withColumn(
        "spans", F.when(F.size("all") > 0, suppressed(F.col("all"))).otherwise(empty))


def find_licenses(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, spans): the detections of each text that no other suppresses, in words, end exclusive."""
    return _scanned(df, id_col, text_col).select("id", "spans")


def license_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its words, the places of the base phrases, the labels and the score of its strongest detection."""
    scanned = _scanned(df, id_col, text_col)
    pattern = "|".join(f"(?:{Rule('', 0, 0.0, p).pattern})" for p in BASE)
    placed = scanned.withColumn("base", F.when(F.col("norm").isNotNull(), F.transform(
        matched(F.col("norm"), F.lit(pattern)), lambda m: m["start"])))
    held = F.when(F.col("norm").isNotNull(), F.filter(F.array(*[
        F.when(F.col("norm").contains(Rule("", 0, 0.0, p).pattern), F.lit(label)) for p, label in BASE.items()]),
        lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return placed.withColumn("held", held).select(
        F.col("id").alias(id_col), "n_words", F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min("base").cast("long").alias("first_word"), F.array_max("base").cast("long").alias("last_word"),
        joined(F.col("held")).alias("base_labels"),
        joined(F.concat("held", F.transform("spans", lambda s: s["label"]))).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"))


def report_sql() -> str:
    """The report as SQL of another engine, from the same rules, with suppression as a self-join."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    listed = lambda ws: "[" + ", ".join(map(quoted, ws)) + "]"
    rules = ",\n".join(f"({i}, {quoted(r.label)}, {r.priority}, {r.score!r}::DOUBLE, {quoted(r.pattern)}, {listed(r.needs)})"
                       for i, r in enumerate(RULES))
    phrases = ", ".join(f"({quoted(p)}, {quoted(label)})" for p, label in BASE.items())
    return rf"""
    WITH r(rule, label, priority, score, pattern, needs) AS (VALUES {rules}),
    b(phrase, label) AS (VALUES {phrases}),
    w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents),
    n AS (SELECT doc_id, words, ' ' || array_to_string(words, '  ') || ' ' AS norm FROM w),
    h AS (
        SELECT doc_id, i - 1 AS pos, b.label FROM n, b, unnest(range(1, len(words) + 1)) AS u(i)
        WHERE contains(array_to_string(words, ' '), phrase) AND words[i:i + len(string_split(phrase, ' ')) - 1] = string_split(phrase, ' ')),
    c AS (SELECT doc_id, r.*, norm FROM n JOIN r ON list_has_all(words, needs)),
    m AS (
        SELECT doc_id, rule, label, priority, score,
               string_split_regex(regexp_replace(norm, pattern, ' ' || chr(1) || ' \0 ' || chr(2) || ' ', 'g'), ' +') AS t
        FROM c WHERE regexp_matches(norm, pattern)),
    o AS (SELECT * EXCLUDE (t), unnest(list_filter(range(1, len(t) + 1), lambda i: t[i] = chr(1))) AS i,
                 unnest(list_filter(range(1, len(t) + 1), lambda i: t[i] = chr(2))) AS j,
                 unnest(range(0, len(list_filter(t, lambda x: x = chr(1))))) AS k FROM m),
    s AS (SELECT doc_id, rule, label, priority, score, i - 2 - 2 * k AS a, j - 3 - 2 * k AS z FROM o),
    d AS (
        SELECT * FROM s WHERE NOT EXISTS (
            SELECT 1 FROM s e WHERE e.doc_id = s.doc_id AND e.a <= s.a AND e.z >= s.z AND (
                e.priority < s.priority OR e.priority = s.priority AND (e.z - e.a > s.z - s.a OR e.z - e.a = s.z - s.a AND e.rule < s.rule)))),
    l AS (SELECT doc_id, label FROM h UNION SELECT doc_id, label FROM d),
    hs AS (SELECT doc_id, count(*) AS n, min(pos) AS first_word, max(pos) AS last_word,
                  string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM h GROUP BY doc_id),
    ls AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM l GROUP BY doc_id),
    ds AS (SELECT doc_id, max(score) AS score FROM d GROUP BY doc_id)
    SELECT n.doc_id, len(words)::BIGINT AS n_words, coalesce(hs.n, 0)::BIGINT AS n_base, hs.first_word, hs.last_word,
           coalesce(hs.labels, '') AS base_labels, coalesce(ls.labels, '') AS labels, coalesce(ds.score, 0.0)::DOUBLE AS score
    FROM n LEFT JOIN hs USING (doc_id) LEFT JOIN ls USING (doc_id) LEFT JOIN ds USING (doc_id)
    """
