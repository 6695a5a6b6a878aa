"""Periodic runs: stretches of a text's words that repeat with a period, and texts without the repeats.

A run of period q has at least 4 q words (6 at least), so its words match those
q places on over at least 3 q (5) of them. The index therefore holds k-grams for
bands of periods: 5-grams for periods 1 to 5, 15-grams for 6 to 15, and so on by
threes; k is the overlap that every run of the band guarantees, and no period of
the band is longer than k. A k-gram and its next occurrence in the same document
are a seed on the diagonal (lag) between them. As k is at least the period, the
next occurrence of a k-gram inside a run is exactly one period on, so a gram has
one seed, never one per pair of its occurrences. The seeds of a lag are walked
in order with the furthest word they have covered: a seed within it only carries
the extension on, the others start a new stretch. Stretches that are long
enough are the runs; a shorter period of the same stretch would have been the
next occurrence, so the lag is the smallest period.

Grams are named by ranks of their three thirds, not by hashes, and only grams
that recur in their document enter the next band, so work and memory of a task
follow the words of about a megabyte of text (or one longer document).

Defined results: a null or empty text has no runs and collapses to the empty
text; rows without id and repeated rows are treated as any other; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.texts import coded_words, pieces

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Length of the shortest grams (the overlap that a run of period 1 guarantees) and the growth from band to band.
GRAM, GROWTH = LEAST_WORDS - 1, LEAST_PERIODS - 1
RUNS = "array<struct<start:long,length:long,period:long>>"


def _named(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, names): a stable order by the parts, and a number per distinct combination along that order."""
    code, size = parts[0], int(parts[0].max(initial=0)) + 1
    for part in parts[1:]:
        wide = int(part.max(initial=0)) + 1
        if size * wide >= 1 << 62:
            order, names = _named([code])
            code = np.empty_like(names)
            code[order] = names
            size = int(names.max(initial=0)) + 1
        code, size = code * wide + part, size * wide
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    names = np.zeros(len(code), np.int64)
    np.cumsum(ranked[1:] != ranked[:-1], out=names[1:])
    return order, names


def _grams(names: np.ndarray, places: np.ndarray, offsets: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their grams, and the names of these, from shorter grams at the offsets."""
    order, named = _named([names[places + o] for o in offsets])
    return places[order], named


def runs_of(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts (over all rows), lengths and periods of the runs in rows of word codes; ``at`` are the rows' offsets."""
    n, sizes = len(codes), np.diff(at)
    end = np.repeat(at[1:], sizes)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def whole(places: np.ndarray, k: int, period: int) -> np.ndarray:
        """Places whose k-gram, and a run of the period, fit into the row."""
        longest = np.repeat(sizes >= max(LEAST_WORDS, LEAST_PERIODS * period), sizes)
        return places[longest[places] & (places + k <= end[places])]

    places = whole(np.arange(n), GRAM, 1)
    if not len(places):
        return (np.zeros(0, np.int64),) * 3
    # 5-grams by way of 3-grams at the places that have one.
    short = whole(np.arange(n), 3, 1)
    threes = np.full(n, -1, np.int64)
    ordered, named = _grams(codes, short, (0, 1, 2))
    threes[ordered] = named
    k, low = GRAM, 1
    ordered, named = _grams(threes, places, (0, GRAM - 3))
    while len(ordered):
        here, there = ordered[:-1], ordered[1:]
        again = (named[:-1] == named[1:]) & (there < end[here])
        lag = (there - here)[again]
        seeds = here[again]
        banded = (lag >= low) & (lag <= k)
        if banded.any():
            found.append(_stretches(seeds[banded], lag[banded], k))
        # Only grams that recur in their row can be part of longer ones that do.
        recurs = np.zeros(n + 1, bool)
        recurs[here[again]] = True
        recurs[there[again]] = True
        names = np.full(n, -1, np.int64)
        names[ordered] = named
        low, longer = k + 1, k * GROWTH
        places = whole(np.flatnonzero(recurs[:n]), longer, low)
        places = places[recurs[places + k] & recurs[places + 2 * k]]
        if not len(places):
            break
        ordered, named = _grams(names, places, (0, k, 2 * k))
        k = longer
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _stretches(seeds: np.ndarray, lag: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs that the seeds of a band cover, each stretch of a lag once."""
    order = np.lexsort((seeds, lag))
    seeds, lag = seeds[order], lag[order]
    covered = seeds + k  # grows along a lag: the furthest word that its diagonal has covered
    new = np.ones(len(seeds), bool)
    new[1:] = (lag[1:] != lag[:-1]) | (seeds[1:] > covered[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(seeds)) - 1
    start, period = seeds[first], lag[first]
    length = covered[last] - start + period
    long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    return start[long], length[long], period[long]


def _collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words joined by one space."""
    if not len(starts):
        return b""
    sizes = ends - starts + 1
    offsets = np.cumsum(sizes) - sizes
    take = np.arange(int(sizes.sum())) + np.repeat(starts - offsets, sizes)
    out = data[np.minimum(take, len(data) - 1)]
    out[offsets + sizes - 1] = 32
    return out[:-1].tobytes()


def find_runs(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The kept columns with ``runs`` (start, length, period; by start and period) and the ``collapsed`` text.

    The collapsed text has single spaces between its words and, of each run, its
    first period only (as far as no other run drops that too).
    """
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema]
    kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in pieces(batch.column(batch.num_columns - 1)):
                _, codes, starts, ends, rows = coded_words(data, at)
                words_at = np.searchsorted(rows, np.arange(end - first + 1))
                start, length, period = runs_of(codes, words_at)
                row = rows[start] if len(start) else start
                change = np.zeros(len(codes) + 1, np.int64)
                np.add.at(change, start + period, 1)
                np.add.at(change, start + length, -1)
                kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                kept_at = np.searchsorted(rows[kept], np.arange(end - first + 1))
                runs_at = np.searchsorted(row, np.arange(end - first + 1))
                runs = pa.ListArray.from_arrays(
                    pa.array(runs_at, pa.int32()), pa.StructArray.from_arrays(
                        [pa.array(start - words_at[row]), pa.array(length), pa.array(period)], fields=list(kind.value_type)))
                texts = pa.array([_collapsed(data, starts[kept[a:b]], ends[kept[a:b]])
                                  for a, b in zip(kept_at[:-1], kept_at[1:])], pa.binary())
                out = batch.slice(first, end - first).select(range(batch.num_columns - 1))
                yield out.append_column("runs", runs).append_column("collapsed", texts.cast(pa.string()))

    return df.select(*keep, F.col(text_col).alias("__text")).mapInArrow(
        build, ", ".join([*fields, f"runs {RUNS}", "collapsed string"]))


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, compared exactly; of equal ones the first by start and period."""
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def planted(id_col: str, text_col: str) -> Column:
    """The text in which, for a tenth of the ids, a tail repeats a stretch of its own words."""
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def tail(x: Column) -> Column:
        n = F.size(x).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
            x, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    bound = F.transform(F.filter(F.array(words), lambda x: F.size(x) > 0), tail)
    return F.when(h % 10 == 0, F.coalesce(F.get(bound, F.lit(0)), F.lit(""))).otherwise(F.col(text_col))


def runs_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document (with its planted tail) the number of runs, the strongest one, and digests of runs and collapsed text."""
    found = find_runs(df.select(F.col(id_col), planted(id_col, text_col).alias("text")), "text", [id_col])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.withColumn("best", F.when(F.size("runs") > 0, strongest(F.col("runs")))).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
