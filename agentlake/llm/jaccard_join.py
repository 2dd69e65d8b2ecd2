"""Near-duplicate documents by exact Jaccard similarity of word shingles: a blocked sparse matrix product.

Rows of the matrix are documents, columns are shingles. The product with its transpose holds the overlaps of all pairs.
It is never formed as a whole; bounds from the sizes of the sets cut it down first, none of which can lose a link:

1. Documents of equal sets are one row (the smallest doc_id stands for them).
2. A linked pair shares at least ``threshold`` of the larger set. Columns with a single document are dropped, and with
   them every row of which too little is left. Columns are counted by an exchange of compact messages.
3. With columns in one order, rare ones first, two linked rows share a column among the first
   ``size - least overlap + 1`` of each; only these columns are multiplied to find candidate pairs. A pair is discarded
   where its sizes differ too much, or where the columns that are left cannot add up to the overlap it needs.
4. The overlaps of the remaining pairs are accumulated over all columns, in blocks of bounded size: one row of the
   matrix times the block of rows that are its candidates.

A column with many documents is not expanded into all pairs. Its rows are first multiplied with one row each round, and
linked rows become one component; then only rows outside of the column's largest component meet the others. Where a
column is still crowded then, its documents share common passages without being alike. For these, columns that stand in
the same documents are one column with a weight, and documents meet where they share a combination of several such
columns: linked ones share at least ``k`` among the first of each, for a ``k`` that grows with the number of chance meetings.
"""

from __future__ import annotations

from bisect import insort
from itertools import batched, combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.llm import gram_exchange as X
from agentlake.llm.components import components
from agentlake.llm.rows import map_texts
from agentlake.llm.storage import materialize
from agentlake.llm.words import Words, find_words, mix, roll, slices

#: Pairs whose overlaps one block of the product accumulates.
BLOCK_PAIRS = 512
#: Rounds in which every column is multiplied with one row before its remaining pairs are listed.
HUB_ROUNDS = 2


def shingle_sets(words: Words, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words has its whole sequence as one."""
    hashes = words.fingerprints()
    grams = roll(hashes, width) if len(hashes) >= width else hashes[:0]
    sets = []
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if high - low >= width:
            sets.append(np.unique(grams[low : high - width + 1]))
        else:
            sets.append(roll(hashes[low:high], high - low) if high > low else hashes[:0])
    return sets


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles and a 128-bit fingerprint of the set, which does not depend on its order."""

    def make():
        def run(part: pa.RecordBatch) -> list:
            sets = shingle_sets(find_words(part.column("text"), fold=True), width)
            prints = [[int(mix(s ^ np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64)) for s in sets] for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
            return [[len(s) for s in sets], *prints]

        return run

    fields = [("n_shingles", T.LongType()), ("print_a", T.LongType()), ("print_b", T.LongType())]
    return map_texts(docs.select(F.col("doc_id").cast("long"), "text"), fields, make, keep=["doc_id"])


def _wanted(needed: DataFrame, layout: X.Layout) -> DataFrame:
    return needed.select(F.explode(layout.groups_of(F.col("doc_id"))).alias("grp"), F.col("doc_id"), F.lit(None).cast("binary").alias("payload"))


def _chosen_sets(docs: pa.Table, ids: pa.ChunkedArray, width: int):
    """(doc_id, set) of the documents with the given ids, each once."""
    ids, seen = set(ids.to_pylist()), set()
    for part in slices(docs):
        texts = part.filter(pa.array([i in ids for i in part.column("doc_id").to_pylist()], pa.bool_()))
        if texts.num_rows:
            for doc_id, grams in zip(texts.column("doc_id").to_pylist(), shingle_sets(find_words(texts.column("text"), fold=True), width)):
                if (doc_id, key := hash(grams.tobytes())) not in seen:
                    seen.add((doc_id, key))
                    yield doc_id, grams


def shared_columns(docs: DataFrame, needed: DataFrame, width: int, percent: int, layout: X.Layout) -> DataFrame:
    """The rows of the matrix that can have a link: doc_id, n (size of the whole set), u (columns it shares with others)
    and grams (those columns as 64-bit numbers, rare ones first)."""
    groups = X.in_groups(docs, layout)
    shift = np.uint64(64 - layout.bits)
    wanted = _wanted(needed, layout)

    def send(key: tuple, docs: pa.Table, wanted: pa.Table) -> pa.Table:
        sets = [np.unique(grams >> shift) for _, grams in _chosen_sets(docs, wanted["doc_id"], width)]
        values, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.empty(0, np.uint64), np.empty(0, np.int64))
        return X.messages(key[0].as_py(), values, np.minimum(counts, 255), layout.buckets, layout.bits)

    def shared(run: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = X.run_sums(run, codes.astype(np.float64))
        return total > 1, np.minimum(np.ceil(8 * np.log2(np.maximum(total, 1))), 255).astype(np.uint8)

    def choose(key: tuple, docs: pa.Table, back: pa.Table) -> pa.Table:
        values, codes = X.merged(back["payload"].drop_null().to_pylist())
        rows = []
        for doc_id, grams in _chosen_sets(docs, back["doc_id"].drop_null(), width):
            at = X.find(values, grams >> shift)
            left = at >= 0
            if 100 * int(left.sum()) >= percent * len(grams):
                rare = codes[at[left]]
                grams_left = grams[left]
                rows.append((doc_id, len(grams), len(rare), grams_left[np.lexsort((grams_left, rare))].tobytes()))
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("doc_id", "n", "u", "grams"), columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))})

    counts = X.answers(groups.groupBy("grp").cogroup(wanted.groupBy("grp")).applyInArrow(send, X.MESSAGE), shared)
    back = wanted.unionByName(counts.withColumn("doc_id", F.lit(None).cast("long")))
    return groups.groupBy("grp").cogroup(back.groupBy("grp")).applyInArrow(choose, "doc_id long, n long, u long, grams binary")


def prefix_columns(rows: DataFrame, percent: int) -> DataFrame:
    """One row for each column among the first ``u - least overlap + 1`` of a document: gram, place, doc_id, n, u."""

    def run(batches):
        for batch in batches:
            n, u = batch.column("n").to_numpy(), batch.column("u").to_numpy()
            length = np.maximum(u - (percent * n + 99) // 100 + 1, 0)
            grams = [np.frombuffer(g, np.int64, k) for g, k in zip(batch.column("grams").to_pylist(), length.tolist())]
            for low in range(0, len(n), 64):
                some = slice(low, low + 64)
                which = np.repeat(np.arange(len(n))[some], length[some])
                place = np.arange(len(which)) - np.repeat(np.cumsum(length[some]) - length[some], length[some])
                flat = np.concatenate([np.empty(0, np.int64), *grams[some]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat), pa.array(place), pa.array(batch.column("doc_id").to_numpy()[which]), pa.array(n[which]), pa.array(u[which])],
                    names=["gram", "place", "doc_id", "n", "u"])

    return rows.mapInArrow(run, "gram long, place long, doc_id long, n long, u long")


def _possible(a: str, b: str, percent: int) -> str:
    """Condition that a pair's sizes, and the columns from the shared one on, allow the overlap it needs."""
    need = f"(({percent} * ({a}.n + {b}.n) + {percent + 99}) DIV {100 + percent})"
    return (f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)"
            f" AND 1 + least({a}.u - {a}.place, {b}.u - {b}.place) - 1 >= {need}")


def accumulate(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets overlap enough, of distinct candidate pairs.

    A block is one row ``a`` and up to about ``BLOCK_PAIRS`` of its candidates; blocks of rows with few candidates
    travel together. Shared columns decide: others add nothing to an overlap.
    """
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("m"))
    total = pairs.count()
    together = max(1, total // BLOCK_PAIRS)
    placed = pairs.join(sizes, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.expr(f"m DIV {BLOCK_PAIRS} + 1")))
    placed = placed.select("a", "b", F.pmod(F.xxhash64("a", "part"), F.lit(together)).alias("block"))
    sets = rows.select("doc_id", "n", "grams")
    right = placed.join(sets.withColumnRenamed("doc_id", "b"), "b").select("block", "a", "b", "n", "grams")
    left = placed.select("block", "a").distinct().join(sets.withColumnRenamed("doc_id", "a"), "a").select("block", "a", F.lit(None).cast("long").alias("b"), "n", "grams")

    def multiply(table: pa.Table) -> pa.Table:
        table = table.sort_by([("a", "ascending"), ("b", "descending")])  # nulls stay last: a's own row ends its run
        a, n, others = table["a"].to_numpy(), table["n"].to_numpy(), table["b"]
        grams = [np.frombuffer(g, np.uint64) for g in table["grams"].to_pylist()]
        own = np.flatnonzero(others.is_null().to_numpy())
        b = others.fill_null(0).to_numpy()
        columns, flat = np.unique(np.concatenate(grams), return_inverse=True)
        ends = np.cumsum([len(g) for g in grams])
        starts = ends - np.array([len(g) for g in grams])
        row = np.zeros(len(columns), np.int64)
        found = []
        for k in own.tolist():
            mine = flat[starts[k] : ends[k]]
            row[mine] = 1
            low, high = np.searchsorted(a, a[k]), np.searchsorted(a, a[k], side="right")
            mates = [i for i in range(int(low), int(high)) if i not in (k,) and b[i] != a[k] and others[i].is_valid]
            if mates:
                product = np.array([int(row[flat[starts[i] : ends[i]]].sum()) for i in mates])
                size = n[mates]
                linked = 100 * product >= percent * (n[k] + size - product)
                found += [(int(a[k]), int(b[i])) for i, yes in zip(mates, linked) if yes]
            row[mine] = 0
        left, right = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return left.unionByName(right).groupBy("block").applyInArrow(multiply, "a long, b long")


#: Rows of a column, outside of its main component, that are paired with all others; those of more crowded columns meet
#: by combinations, if these lead to fewer pairs.
CROWDED_ROWS = 32
#: Columns in a combination at most, and combinations of a document on average.
MOST_COLUMNS, COMBINATIONS = 10, 400


def weighted_columns(rows: DataFrame, crowded: DataFrame) -> DataFrame:
    """doc_id, n and columns (frequency, name and weight; rare ones first) of the documents in ``crowded`` (doc_id).

    Columns with the same documents, of these, are one, named by a fingerprint of the documents; its weight is their
    number. Columns of a single document have no part in any overlap and are left out.
    """

    def run(batches):
        for batch in batches:
            for doc_id, grams in zip(batch.column("doc_id").to_numpy().tolist(), batch.column("grams").to_pylist()):
                flat = np.frombuffer(grams, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), doc_id)), pa.array(flat)], names=["doc_id", "gram"])

    chosen = rows.join(crowded, "doc_id", "left_semi").select("doc_id", "n", "grams")
    grams = materialize(chosen.mapInArrow(run, "doc_id long, gram long"), "grams")
    name = [F.sum(F.xxhash64(F.lit(salt), "doc_id").cast("decimal(38,0)")) for salt in (1, 2)]
    named = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.xxhash64(*name).alias("name")).where("m > 1")
    weights = grams.join(named, "gram").groupBy("doc_id", "m", "name").agg(F.count(F.lit(1)).alias("w"))
    listed = weights.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("m", "name", "w"))).alias("columns"))
    return chosen.select("doc_id", "n").join(listed, "doc_id")


def combination_prefix(weights: list[int], need: int, k: int) -> int | None:
    """Number of first columns among which any document that shares ``need`` has at least ``k`` in common; None where
    fewer than ``k`` columns may be enough."""
    rest, largest = sum(weights), []
    for j, w in enumerate(weights, 1):
        rest -= w
        if k > 1:
            insort(largest, w)
            if len(largest) > k - 1:
                del largest[0]
        if j >= k and sum(largest) + rest < need:
            return j
    return None


def combined_pairs(weighted: DataFrame, percent: int, fewer_than: float) -> tuple[DataFrame, DataFrame] | None:
    """Distinct candidate pairs (p < q) of documents by combinations of ``k`` columns, and the documents (doc_id) that
    may link with others over fewer columns, and are not paired here. None where this would not be fewer meetings than
    ``fewer_than``, or too many combinations.

    ``k`` grows while the pairs that meet outnumber the combinations of the next ``k``: more documents, of which ever more
    meet by chance, make it larger, so that pairs and combinations stay in balance.
    """

    def counts(batches):
        total = np.zeros((2, MOST_COLUMNS))
        for batch in batches:
            for n, columns in zip(batch.column("n").to_pylist(), batch.column("columns").to_pylist()):
                weights = [c["w"] for c in columns]
                for k in range(1, MOST_COLUMNS + 1):
                    j = combination_prefix(weights, -(-percent * n // 100), k)
                    total[:, k - 1] += (comb(j, k), 0) if j else (0, 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(1, MOST_COLUMNS + 1), pa.int32()), pa.array(total[0]), pa.array(total[1])], names=["k", "keys", "rest"])

    kept = materialize(weighted, "weighted")
    rows = kept.count()
    sums = kept.mapInArrow(counts, "k int, keys double, rest double").groupBy("k").agg(F.sum("keys").alias("keys"), F.sum("rest").alias("rest")).collect()
    # few documents may be left to their columns
    cost = {r.k: r["keys"] for r in sums if 100 * r.rest <= rows and r["keys"] <= COMBINATIONS * rows}
    if cost.get(1, float("inf")) > fewer_than:
        return None

    def keys_of(k: int) -> DataFrame:
        def combine(batches):
            for batch in batches:
                for doc_id, n, columns in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "columns"))):
                    j = combination_prefix([c["w"] for c in columns], -(-percent * n // 100), k)
                    names = np.array([c["name"] for c in columns[:j]], np.int64).view(np.uint64) if j else np.empty(0, np.uint64)
                    for picked in batched(combinations(range(len(names)), k), 4096) if j else [()]:
                        places = np.array(picked, np.int64).reshape(-1, k)
                        value = roll(names[places].ravel(), k)[::k] if len(places) else np.zeros(1, np.uint64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(value.view(np.int64), mask=np.full(len(value), not j)), pa.array(np.full(len(value), doc_id)), pa.array(np.full(len(value), n))], names=["key", "doc_id", "n"])

        return materialize(kept.mapInArrow(combine, "key long, doc_id long, n long"), "keys")

    k = 1
    while True:
        keys = keys_of(k)
        often = materialize(keys.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "often")
        meeting = often.agg(F.sum(F.col("m").cast("double") * (F.col("m") - 1) / 2)).first()[0] or 0
        if meeting <= cost.get(k + 1, float("inf")):
            break
        k += 1
    if meeting > fewer_than:
        return None
    shared = keys.join(often.select("key"), "key")
    similar = f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"
    pairs = shared.alias("x").join(shared.alias("y"), "key").where("x.doc_id < y.doc_id").where(similar)
    return pairs.select(F.col("x.doc_id").alias("p"), F.col("y.doc_id").alias("q")).distinct(), keys.where("key IS NULL").select("doc_id")


def _last_pairs(placed: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of all columns of which one document is outside of the column's main component."""
    outside = placed.where("component <> main")
    sizes = placed.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("component") != F.col("main")).alias("o")).where(F.col("o") > CROWDED_ROWS)
    meetings = sizes.agg(F.sum(F.col("m").cast("double") * F.col("o"))).first()[0]
    if not meetings:
        return _column_pairs(outside, placed, percent)
    sizes = materialize(sizes.select("gram"), "crowded")
    crowded = placed.join(sizes, "gram", "left_semi")
    found = combined_pairs(weighted_columns(rows, crowded.select("doc_id").distinct()), percent, meetings)
    if found is None:
        return _column_pairs(outside, placed, percent)
    pairs, coarse = found
    labels = materialize(crowded.select("doc_id", "component").distinct(), "labels")
    for side in ("p", "q"):
        pairs = pairs.join(labels.select(F.col("doc_id").alias(side), F.col("component").alias(f"{side}_component")), side)
    by_column = outside.join(sizes, "gram", "left_anti").unionByName(crowded.join(coarse, "doc_id", "left_semi"))
    return _column_pairs(by_column, placed, percent).unionByName(pairs.where("p_component <> q_component").select("p", "q"))


def find_links(rows: DataFrame, percent: int) -> DataFrame:
    """Components among ``rows``: (node, component) of every document with a link."""
    columns = prefix_columns(rows, percent)
    often = columns.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("gram")
    columns = materialize(columns.join(often, "gram"), "columns")
    links = labels = None
    for turn in range(HUB_ROUNDS + 1):
        placed = columns
        if labels is None:
            placed = placed.withColumn("component", F.col("doc_id"))
        else:
            placed = placed.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
            parts = placed.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("m"))
            largest = parts.groupBy("gram").agg(F.max(F.struct("m", "component")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
            placed = materialize(placed.join(largest.select("gram", F.col("top.component").alias("main")), "gram"), "columns")
        hub = F.struct("doc_id", "n", "u", "place", "component")
        outside = placed if labels is None else placed.where("component <> main")
        if turn < HUB_ROUNDS:
            first = outside.groupBy("gram").agg(F.min(hub).alias("hub")).select("gram", "hub.*")
            pairs = _column_pairs(first, placed, percent).select(F.col("p").alias("a"), F.col("q").alias("b"))
        else:
            pairs = _last_pairs(placed, rows, percent)
            pairs = pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
        pairs = materialize(pairs.distinct(), "pairs")
        new = materialize(accumulate(pairs, rows, percent), "links")
        links = new if links is None else links.unionByName(new)
        if new.limit(1).count() or labels is None:
            labels = components(links)
    return labels


def _column_pairs(some: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """(p, q): rows of ``some`` with the rows of their columns in other components that they may link with."""
    left = some.select("gram", "doc_id", "n", "u", "place", "component")
    pairs = left.alias("x").join(placed.alias("y"), "gram").where("x.component <> y.component AND x.doc_id <> y.doc_id").where(_possible("x", "y", percent))
    return pairs.select(F.col("x.doc_id").alias("p"), F.col("y.doc_id").alias("q"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Words are runs of anything but ASCII white space, A-Z folded to a-z. The set of a document is its distinct runs of
    ``width`` words, or its whole sequence where it has fewer. Two documents link where their intersection is at least
    ``percent`` hundredths of their union; a component is what links connect, named by its smallest doc_id. Texts
    without words, null and empty ones among them, have no set and link with nothing. Rows with equal sets link.
    doc_id is taken to name a document: rows that share one also share its links. Rows with a null doc_id belong to the
    component of an equal set that has an id, or to none (null). Other columns are not read.
    """
    sets = materialize(signatures(docs, width), "signatures")
    same = ["n_shingles", "print_a", "print_b"]
    classes = materialize(sets.where("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("first_id")), "classes")
    layout = X.plan_layout(docs)
    needed = classes.where("first_id IS NOT NULL").select(F.col("first_id").alias("doc_id")).distinct()
    rows = materialize(shared_columns(docs, needed, width, percent, layout), "rows")
    labels = find_links(rows, percent)
    named = classes.join(labels.withColumnRenamed("node", "first_id"), "first_id", "left").select(*same, F.coalesce("component", "first_id").alias("component"))
    linked = sets.where("n_shingles > 0").join(named, same).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    alone = sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
