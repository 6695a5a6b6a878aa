"""Similarity join on word shingles by parity sketches: exact Jaccard links and their components.

A document's set is hashed into the words of a sketch: each shingle picks one
of k words and is XORed into it. Shingles that two sets share cancel, so the
number of words that differ (the Hamming distance over words) is at most the
size of the symmetric difference, which a similarity of 0.8 bounds by a ninth
of both sizes. By the pigeonhole principle, and with the words in one fixed
order, the first d + 1 non-zero words of two linked documents share one; these
are joined. Sizes are cut into bands [2^j, 2^(j+1)); a document takes part in
its own band and, if it may be the larger partner, in the band below.

Sets, not documents, are joined: equal sets are one node (a 64-bit digest), so
copies are never paired. Of the sets that share a word, first only the links to
the smallest are verified; then, within the groups that are not yet one
component, the pairs between different components. A pair inside a component
cannot change the result, every other candidate pair is verified, so no link
between different texts is lost. A second parity sketch, of about two bits per
shingle, rejects candidates by its Hamming distance before their texts are read.

Defined results: a text without words (or null) has an empty set and is its own
component; with fewer than five words the whole sequence is the one shingle; a
row without id is left alone with a null component; repeated rows are equal sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.shared import deal_out, emit, stored
from shelfwise.llm.texts import U, hashed_words, mix, pieces

WORDS = 5
#: The threshold as a fraction of whole numbers: similarity of at least NUM / DEN.
NUM, DEN = 80, 100
LEAST_WORDS = 64
LEAST_BITS = 1024
HELD = 1 << 20
#: Entries of a bucket of the word join, and members of a tile of a large group.
BUCKET_ROWS = 1 << 19
TILE = 4096

PARTS = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("nodes", pa.binary())])


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) of all distinct shingles, by row and shingle."""
    words, of = hashed_words(data, at)
    n = len(at) - 1
    count = np.bincount(of, minlength=n)
    first = np.cumsum(count) - count
    length = np.minimum(count, size)
    place = np.arange(len(words)) - first[of]
    starts = np.flatnonzero(place <= (count - length)[of])
    rows = of[starts]
    code = np.zeros(len(starts), U)
    for i in range(size):
        inside = i < length[rows]
        code = np.where(inside, code * U(0x9E3779B97F4A7C15) + words[np.minimum(starts + i, max(len(words) - 1, 0))], code)
    code = mix(code + length[rows].astype(U))
    # Rows and the leading bits of the hashes sort as one number; ties of those are rare.
    order = None
    if n < 1 << 20:
        key = (rows.astype(U) << U(44)) | (code >> U(20))
        order = np.argsort(key)
        key = key[order]
        if ((key[1:] == key[:-1]) & (code[order[1:]] != code[order[:-1]])).any():
            order = None
    if order is None:
        order = np.lexsort((code, rows))
    rows, code = rows[order], code[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (code[1:] != code[:-1])
    return rows[new], code[new]


def digests(rows: np.ndarray, code: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(set size, digest of the set) of each row; the digest of an empty set is 0."""
    size = np.bincount(rows, minlength=n_rows)
    total = np.zeros(n_rows, U)
    some = np.flatnonzero(size)
    if len(some):
        total[some] = mix(np.add.reduceat(mix(code ^ U(0xA5A5A5A5A5A5A5A5)), (np.cumsum(size) - size)[some]))
    return size, total


def bit_sketches(rows: np.ndarray, code: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Parity of the shingles on each bit of a sketch; its bits grow with the size, ``LEAST_BITS`` at least.

    In small sets few bits would let many pairs pass that are not linked.

    A sketch folds onto half its bits by exclusive or, so two of different
    lengths are compared at the shorter one.
    """
    band = np.zeros(len(size), np.int64)
    band[size > 0] = np.floor(np.log2(size[size > 0])).astype(np.int64)
    bits = np.maximum(np.int64(64) << np.maximum(band - 5, 0), LEAST_BITS)
    offset = np.append(0, np.cumsum(bits))
    at = offset[rows] + (code & (bits[rows] - 1).astype(U)).astype(np.int64)
    odd = (np.bincount(at, minlength=int(offset[-1])) & 1).astype(np.uint8)
    packed = np.packbits(odd, bitorder="little")
    return [packed[offset[i] // 8: offset[i + 1] // 8].tobytes() for i in range(len(size))]


def folded(sketches: np.ndarray, length: int) -> np.ndarray:
    """Sketches (rows x longs) folded to so many longs."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, length), axis=1)


def most_apart(both):
    """Largest symmetric difference of two linked sets with so many elements together."""
    return both - 2 * -(-both * NUM // (NUM + DEN))


def bands(size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the own band and the one below: (takes part, band, most words that may differ)."""
    own = np.zeros(len(size), np.int64)
    own[size > 0] = np.floor(np.log2(size[size > 0])).astype(np.int64)
    top = (1 << own) - 1
    larger = size * NUM // DEN + (size * NUM % DEN > 0)
    bound = lambda both: both * (DEN - NUM) // (DEN + NUM)
    return [(size > 0, own, bound(size + size * DEN // NUM)),
            ((size > 1) & (larger <= top), own - 1, bound(size + top))]


def words_of(band: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Words of the sketches of a band."""
    return factor * np.maximum(LEAST_WORDS, (0.62 * 2.0 ** band).astype(np.int64))


def _picked(code: np.ndarray, k: np.ndarray) -> np.ndarray:
    return ((code >> U(24)) % k.astype(U)).astype(np.int64)


def factor_needed(rows: np.ndarray, code: np.ndarray, n_rows: int, part: np.ndarray, band: np.ndarray,
                  differ: np.ndarray) -> np.ndarray:
    """The smallest power of two by which a band's sketch must be longer so that each row has d + 1 words."""
    factor = np.where(part, 1, 0)
    open_rows = part.copy()
    f = 1
    while open_rows.any():
        inside = open_rows[rows]
        r, c = rows[inside], code[inside]
        k = np.where(open_rows, words_of(band, np.int64(f)), 0)
        offset = np.cumsum(k) - k
        used = np.zeros(int(k.sum()), bool)
        used[offset[r] + _picked(c, k[r])] = True
        have = np.add.reduceat(used, offset[open_rows], dtype=np.int64)
        short = have < differ[open_rows] + 1
        open_rows[open_rows] = short
        f *= 2
        factor[open_rows] = f
    return factor


def sketch_words(rows: np.ndarray, code: np.ndarray, part: np.ndarray, band: np.ndarray, differ: np.ndarray,
                 factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the first d + 1 non-zero words of each row that takes part."""
    inside = part[rows]
    rows, code = rows[inside], code[inside]
    if not len(rows):
        return rows, code
    k = words_of(band, factors[np.maximum(band, 0)])
    word = _picked(code, k[rows])
    order = np.argsort(rows * int(k.max()) + word)
    rows, code, word = rows[order], code[order], word[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (word[1:] != word[:-1])
    first = np.flatnonzero(new)
    rows, word, value = rows[first], word[first], np.bitwise_xor.reduceat(code, first)
    set_words = value != 0
    rows, word, value = rows[set_words], word[set_words], value[set_words]
    start = np.searchsorted(rows, rows)
    early = np.arange(len(rows)) - start <= differ[rows]
    rows, word, value = rows[early], word[early], value[early]
    return rows, mix(value ^ mix((band[rows].astype(U) << U(40)) + word.astype(U)))


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, n, node, bands and factors, bit sketch) of each row of (doc_id, text)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in pieces(batch.column(1)):
                rows, code = shingle_sets(data, at)
                size, node = digests(rows, code, end - first)
                out = batch.slice(first, end - first).select([0])
                out = out.append_column("n", pa.array(size.astype(np.int64)))
                out = out.append_column("node", pa.array(node.view(np.int64)))
                for name, (part, band, differ) in zip(("own", "below"), bands(size)):
                    out = out.append_column(f"band_{name}", pa.array(band))
                    out = out.append_column(f"factor_{name}", pa.array(
                        factor_needed(rows, code, end - first, part, band, differ).astype(np.int64)))
                yield out.append_column("sketch", pa.array(bit_sketches(rows, code, size), pa.binary()))

    columns = [f"doc_id {id_type}", "n long", "node long", "band_own long", "factor_own long", "band_below long",
               "factor_below long", "sketch binary"]
    return docs.mapInArrow(build, ", ".join(columns))


def shared_words(docs: DataFrame, factors: dict[int, int], entries: int) -> DataFrame:
    """(word, leader, node): the sets that share a sketch word, with the smallest node of each word."""
    bits = max(4, (-(-entries // BUCKET_ROWS) - 1).bit_length())
    factor = np.ones(64, np.int64)
    for band, f in factors.items():
        factor[band] = f

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            key, node = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            held.clear()
            order = np.argsort(key)
            key, node = key[order], node[order]
            cuts = np.searchsorted((key >> U(64 - bits)).astype(np.int64), np.arange((1 << bits) + 1))
            some = np.flatnonzero(np.diff(cuts))
            low = (key >> U(32 - bits)).astype(np.uint32)
            return emit({
                "bucket": some, "keys": [low[cuts[b]: cuts[b + 1]].tobytes() for b in some],
                "nodes": [node[cuts[b]: cuts[b + 1]].tobytes() for b in some]}, PARTS)

        for batch in batches:
            for first, end, data, at in pieces(batch.column(0)):
                rows, code = shingle_sets(data, at)
                n, node = digests(rows, code, end - first)
                for part, band, differ in bands(n):
                    of, key = sketch_words(rows, code, part, band, differ, factor)
                    held.append((key, node[of]))
                    size += len(key)
                if size >= HELD:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    def meet(key, table):
        bucket = np.int64(key[0].as_py())
        low = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint32)
        node = np.frombuffer(b"".join(table["nodes"].to_pylist()), np.int64)
        order = np.lexsort((node, low))
        low, node = low[order], node[order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (node[1:] != node[:-1])
        low, node = low[new], node[new]
        first = np.searchsorted(low, low)
        many = np.searchsorted(low, low, "right") - first > 1
        return pa.table({"word": (bucket << 32) + low[many].astype(np.int64), "leader": node[first][many],
                         "node": node[many]})

    return docs.select("text").mapInArrow(build, "bucket int, keys binary, nodes binary").groupBy("bucket").applyInArrow(
        meet, "word long, leader long, node long")


def close_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and bit sketches allow a link."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(batch.num_rows, bool)
            most = most_apart(batch.column(2).to_numpy())
            left, right = batch.column(3), batch.column(4)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), U)[None, :] for c in (left, right))
                length = min(x.shape[1], y.shape[1])
                near[i] = np.bitwise_count(folded(x, length) ^ folded(y, length)).sum() <= most[i]
            yield batch.filter(pa.array(near)).select([0, 1])

    side = lambda s: nodes.select(
        F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .where(F.least("n_a", "n_b") * DEN >= F.greatest("n_a", "n_b") * NUM)
        .select("a", "b", (F.col("n_a") + F.col("n_b")).alias("both"), "sketch_a", "sketch_b")
        .mapInArrow(compare, "a long, b long"))


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose whole sets have the similarity, from the texts of one document per set."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in pieces(batch.column(0)):
                rows, code = shingle_sets(data, at)
                size, node = digests(rows, code, end - first)
                cuts = np.append(0, np.cumsum(size))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.view(np.int64)),
                     pa.array([code[cuts[i]: cuts[i + 1]].tobytes() for i in range(end - first)], pa.binary())],
                    names=["node", "items"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            left, right = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), U) for c in (left, right))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                linked[i] = both * DEN >= (len(x) + len(y) - both) * NUM
            yield batch.filter(pa.array(linked)).select([0, 1])

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    ids = wanted.join(nodes.select("node", F.col("first_id").alias("doc_id")), "node").select("doc_id").distinct()
    sets = stored(
        docs.join(ids, "doc_id", "left_semi").select("text").mapInArrow(build, "node long, items binary")
        .dropDuplicates(["node"]), "sets")
    side = lambda s: sets.select(F.col("node").alias(s), F.col("items").alias(f"items_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "items_a", "items_b").mapInArrow(
        compare, "a long, b long")


def newly_joined(root: dict, own: int, others: np.ndarray, apart: np.ndarray) -> list[int]:
    """Places of others that join a class of components not joined with ``own`` before, the nearest of each."""

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    order = np.argsort(apart, kind="stable")
    _, first = np.unique(others[order], return_index=True)
    out = []
    for at in order[np.sort(first)]:
        a, b = find(int(own)), find(int(others[at]))
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append(int(at))
    return out


def pairs_between(members: DataFrame, parts: DataFrame, forest: bool) -> DataFrame:
    """Pairs (a, b) that share a word, lie in different components and may be linked.

    Groups that are one component are dropped; a large group is cut into tiles,
    so that a task compares two tiles of it at most. Groups with one leader have
    mostly the same members and go to one task, which passes a pair on once.
    With ``forest`` a task passes on only pairs that join components it has not
    joined yet, so fewer pairs than it has members; without, it passes on all.
    """
    placed_in = parts.withColumnRenamed("node", "first_id")
    member = members.join(placed_in, "first_id", "left").withColumn(
        "component", F.coalesce("component", "first_id")).drop("first_id")
    mixed = member.groupBy("word").agg(F.count("*").alias("size"), F.min("component").alias("x"),
                                       F.max("component").alias("y")).where("x <> y").select("word", "size")
    mixed = stored(mixed, "mixed")
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    placed = (
        member.join(mixed, "word").withColumn("tiles", tiles)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
        .withColumn("task", F.when(F.col("tiles") > 1, F.xxhash64("leader", "tiles", "low", "high"))
                    .otherwise(F.pmod(F.xxhash64("leader"), F.lit(4096)))))

    def pair_up(key, table):
        word, low, high = (table[c].to_numpy() for c in ("word", "low", "high"))
        order = np.lexsort((high, low, word))
        word, low, high = word[order], low[order], high[order]
        node, n, part, own = (table[c].to_numpy()[order] for c in ("node", "n", "component", "own"))
        sketches = table["sketch"].take(pa.array(order)).to_pylist()
        length = np.array([len(x) // 8 for x in sketches])
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        cuts = np.append(np.flatnonzero(new), len(word))
        found = [np.zeros((0, 2), np.int64)]
        root = {}
        for s, e in zip(cuts[:-1], cuts[1:]):
            members = np.arange(s, e)
            # Linked sets lie in one band or in neighbours, so sketches have one length or its double.
            for size in np.unique(length[members]):
                short, long = (members[length[members] == x] for x in (size, 2 * size))
                both = np.concatenate([short, long])
                rows = np.concatenate([
                    folded(np.frombuffer(b"".join(sketches[i] for i in at), U).reshape(len(at), -1), size)
                    if len(at) else np.zeros((0, size), U) for at in (short, long)])
                for k, i in enumerate(short):
                    at = np.arange(k + 1, len(both))
                    at = at[part[both[at]] != part[i]]
                    if low[s] != high[s]:
                        at = at[own[both[at]] != own[i]]
                    m = n[both[at]]
                    at = at[np.minimum(m, n[i]) * DEN >= np.maximum(m, n[i]) * NUM]
                    apart = np.bitwise_count(rows[at] ^ rows[k]).sum(1, dtype=np.int64)
                    near = apart <= most_apart(n[both[at]] + n[i])
                    at, apart = both[at[near]], apart[near]
                    if forest:
                        at = at[newly_joined(root, part[i], part[at], apart)]
                    found.append(np.sort(np.stack([np.full(len(at), node[i]), node[at]], 1), 1))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return placed.groupBy("task").applyInArrow(pair_up, "a long, b long").distinct()


def jaccard_classes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id): the component is the smallest id reachable by links."""
    docs = deal_out(documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    sketches = stored(sketched(docs), "sketches")
    nodes = stored(
        sketches.where("n > 0 and doc_id is not null").groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.max("n").alias("n"),
             F.max("sketch").alias("sketch")), "nodes")
    need = sketches.select(F.col("band_own").alias("band"), F.col("factor_own").alias("factor"), "n").union(
        sketches.select("band_below", "factor_below", "n")).where("factor > 0").groupBy("band").agg(
        F.max("factor").alias("factor"), F.sum("n").alias("n")).collect()  # one row per band
    groups = stored(shared_words(docs, {r["band"]: r["factor"] for r in need},
                                 sum(r["n"] for r in need) // 4), "groups")

    first = stored(close_pairs(groups.where("leader <> node").select(
        F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), nodes), "pairs")
    id_of = lambda s: nodes.select(F.col("node").alias(s), F.col("first_id").alias(f"id_{s}"))
    as_ids = lambda links: links.join(id_of("a"), "a").join(id_of("b"), "b").select("id_a", "id_b")
    links = stored(as_ids(verified(first, nodes, docs)), "links")
    parts = stored(components(links, "id_a", "id_b"), "parts")
    members = stored(groups.select("word", "leader", "node").join(
        nodes.select("node", "first_id", "n", "sketch"), "node"), "members")
    # A forest of likely links joins most components; then every pair between those still apart is taken.
    for forest in (True, False):
        rest = stored(pairs_between(members, parts, forest).join(first, ["a", "b"], "left_anti"), "pairs")
        if rest.isEmpty():
            continue
        more = stored(as_ids(verified(rest, nodes, docs)), "links")
        first = first.union(rest)
        if not more.isEmpty():
            known = parts.select(F.col("node").alias("id_a"), F.col("component").alias("id_b"))
            parts = stored(components(known.union(more), "id_a", "id_b"), "parts")
    classes = stored(
        nodes.select("node", "first_id").join(parts.withColumnRenamed("node", "first_id"), "first_id", "left")
        .select("node", F.coalesce("component", "first_id").alias("component_id")), "classes")
    return sketches.select("doc_id", "n", "node").join(classes, "node", "left").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id"))
               .otherwise(F.col("doc_id"))).alias("component_id"))
