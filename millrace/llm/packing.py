"""Best-fit packing by a grouping genetic algorithm on islands.

Pieces shorter than a sequence are dealt by a row number over archipelagos of
about ``GROUP`` pieces. In each, ``ISLANDS`` islands evolve a population of
packings of the same pieces. A packing starts as best-fit decreasing over
disturbed sizes. Crossover injects whole well-filled sequences of one parent
into the other and removes the sequences that now hold duplicates; mutation
empties the least filled sequences and some others. The displaced pieces first
take the place of one or two smaller ones where that fills a sequence better,
and what is left is best-fitted. Every island breeds one generation at least, and
more while fewer sequences are possible and the last ones brought something.
After each epoch the best packing of an island migrates to the next island of
its archipelago. The best packing of all islands wins; its
well-filled sequences are final, while pieces of at most an eighth of its
sequences, the least filled, go on to a round of fewer archipelagos until one
archipelago is left.

An island is one row of at most some thousand numbers, so memory is bounded,
and each epoch reads what the epoch before wrote to the shared folder.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, release, written
from .tokens import tokenize_pieces

GROUP = 4096
ISLANDS = 2
EPOCHS = 3
GENERATIONS = 6
POPULATION = 4
#: Generations without a better packing after which an epoch ends.
PATIENCE = 3
#: A sequence filled to this part is final, and one that crossover may inject.
WELL_FILLED = 0.997
SEQUENCES_BITS = 20
#: Sequences of more pieces take part in no exchange of pieces (they are full of small ones, which best-fit places well).
_EXCHANGED = 8
_PASSES = 5


def best_fit(sizes: np.ndarray, order: np.ndarray, assign: np.ndarray, capacity: int) -> np.ndarray:
    """Place ``order``'s pieces (those with assign -1) best-fit; numbers of new sequences go on from the largest."""
    used = int(assign.max(initial=-1)) + 1
    fill = np.bincount(assign[assign >= 0], weights=sizes[assign >= 0], minlength=used)
    room = sorted((int(capacity - f), b) for b, f in enumerate(fill) if 0 < f < capacity)
    out = assign.copy()
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b, used = capacity, used, used + 1
        out[i] = b
        if left > size:
            insort(room, (left - size, b))
    return np.unique(out, return_inverse=True)[1].astype(np.int32).reshape(-1)


def fitness(sizes: np.ndarray, assign: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then the fuller ones."""
    fill = np.bincount(assign, weights=sizes)
    return -len(fill), float(np.square(fill / capacity).mean()) if len(fill) else 0.0


def _without(a: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``a`` with the sequences ``gone`` emptied and the others numbered from 0."""
    number = np.cumsum(~gone, dtype=np.int32) - 1
    return np.where(gone[a] | (a < 0), np.int32(-1), number[a])


def crossover(sizes: np.ndarray, a: np.ndarray, b: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """``a`` with whole well-filled sequences of ``b``; pieces of the sequences these hit are displaced (-1)."""
    fill = np.bincount(b, weights=sizes)
    inject = (fill >= WELL_FILLED * capacity) & (rng.random(len(fill)) < 0.5)
    inside = inject[b]
    hit = np.zeros(int(a.max(initial=-1)) + 1, bool)
    hit[a[inside]] = True
    child = _without(a, hit)
    child[inside] = int((~hit).sum()) + (np.cumsum(inject, dtype=np.int32) - 1)[b[inside]]
    return child


def mutate(sizes: np.ndarray, a: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """``a`` with its least filled sequences and some others emptied."""
    n = int(a.max(initial=-1)) + 1
    fill = np.bincount(a[a >= 0], weights=sizes[a >= 0], minlength=n)
    gone = np.zeros(n + 1, bool)
    gone[np.argsort(fill, kind="stable")[: max(2, n // 20)]] = True
    if n:
        gone[rng.integers(0, n, max(2, n // 50))] = True
    gone[n] = False
    return _without(a, gone)


def exchange(sizes: np.ndarray, a: np.ndarray, capacity: int) -> np.ndarray:
    """Displaced pieces, largest first, take the place of one or two smaller ones where a sequence gets fullest by it.

    What is put out is displaced in turn, for ``_PASSES`` passes over the sequences.
    """
    out, n = a.copy(), int(a.max(initial=-1)) + 1
    members: list[list[int]] = [[] for _ in range(n)]
    for i in np.flatnonzero(a >= 0).tolist():
        members[out[i]].append(i)
    fill = np.array([int(sizes[m].sum()) for m in members], np.int64)
    loose = sorted(np.flatnonzero(a < 0).tolist(), key=lambda i: (-sizes[i], i))
    for _ in range(_PASSES):
        rows = []
        for b in np.flatnonzero(fill < capacity).tolist():
            own = members[b]
            if len(own) <= _EXCHANGED:
                rows += [(int(sizes[i]), b, i, -1) for i in own]
                rows += [(int(sizes[i] + sizes[j]), b, i, j) for x, i in enumerate(own) for j in own[x + 1 :]]
        if not rows:
            break
        total, at, first, second = np.array(rows, np.int64).T
        room, touched, left = (capacity - fill)[at], np.zeros(n, bool), []
        for i in loose:
            gain = sizes[i] - total
            able = np.flatnonzero((gain > 0) & (gain <= room) & ~touched[at])
            if not len(able):
                left.append(i)
                continue
            k = able[np.argmin(room[able] - gain[able])]
            b, gone = at[k], [int(x) for x in (first[k], second[k]) if x >= 0]
            touched[b] = True
            members[b] = [x for x in members[b] if x not in gone] + [i]
            fill[b] += gain[k]
            out[gone], out[i] = -1, b
            left += gone
        if not touched.any():
            break
        loose = sorted(left, key=lambda i: (-sizes[i], i))
    return out


def breed(sizes: np.ndarray, a: np.ndarray, b: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    child = exchange(sizes, mutate(sizes, crossover(sizes, a, b, capacity, rng), capacity, rng), capacity)
    loose = np.flatnonzero(child < 0)
    return best_fit(sizes, loose[np.argsort(-sizes[loose], kind="stable")], child, capacity)


def evolve(sizes: np.ndarray, population: list[np.ndarray], capacity: int, seed: int) -> list[np.ndarray]:
    """One epoch; the best comes first. An empty population is founded first."""
    rng, rank = np.random.default_rng(seed), lambda p: fitness(sizes, p, capacity)
    none, bound = np.full(len(sizes), -1, np.int32), -(-int(sizes.sum()) // capacity)
    if population and -max(map(rank, population))[0] <= bound:
        return sorted(population, key=rank, reverse=True)[:POPULATION]  # an epoch before has reached the bound
    while len(population) < POPULATION:
        noise = 1 + 0.05 * len(population) * rng.random(len(sizes))
        population.append(best_fit(sizes, np.argsort(-sizes * noise, kind="stable"), none, capacity))
    population, idle = sorted(population, key=rank, reverse=True)[:POPULATION], 0
    for _ in range(GENERATIONS):
        best = rank(population[0])
        children = []
        for _ in range(POPULATION):
            i, j = sorted(rng.integers(0, len(population), 2))
            children.append(breed(sizes, population[i], population[j], capacity, rng))
        population = sorted(population + children, key=rank, reverse=True)[:POPULATION]
        idle = 0 if rank(population[0]) > best else idle + 1
        if idle == PATIENCE or -rank(population[0])[0] <= bound:  # no packing can have fewer sequences than the bound
            break
    return population


_ISLAND = "arch long, island int, uids binary, sizes binary, population array<binary>"
_ISLAND_ARROW = pa.schema([("arch", pa.int64()), ("island", pa.int32()), ("uids", pa.binary()), ("sizes", pa.binary()), ("population", pa.list_(pa.binary()))])


def _epoch(islands: DataFrame, capacity: int, epoch: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                population = [np.frombuffer(p, np.int32) for p in row["population"]]
                best = evolve(np.frombuffer(row["sizes"], np.int64), population, capacity, (row["arch"] * 1009 + row["island"] * 31 + epoch) & 0x7FFFFFFF)
                yield pa.RecordBatch.from_pylist([row | {"population": [p.tobytes() for p in best]}], schema=_ISLAND_ARROW)

    return islands.mapInArrow(run, _ISLAND)


def _found(items: DataFrame, n_groups: int) -> DataFrame:
    """An island's row for each island of each archipelago, with no packings yet."""
    groups = (
        items.withColumn("arch", F.pmod(F.xxhash64("uid"), F.lit(n_groups)))
        .groupBy("arch")
        .agg(F.array_sort(F.collect_list(F.struct("uid", "length"))).alias("items"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for arch, items in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                flat = items.values.flatten()
                uids, sizes = (x.to_numpy(zero_copy_only=False).astype(np.int64).tobytes() for x in flat)
                yield pa.RecordBatch.from_pylist([{"arch": arch, "island": k, "uids": uids, "sizes": sizes, "population": []} for k in range(ISLANDS)], schema=_ISLAND_ARROW)

    return groups.mapInArrow(run, _ISLAND)


def _migrate(islands: DataFrame) -> DataFrame:
    """Each island's population and the best packing of the island before it."""
    elites = islands.select(F.col("arch").alias("a"), F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("i"), F.element_at("population", 1).alias("elite"))
    moved = islands.join(elites, (islands.arch == elites.a) & (islands.island == elites.i))
    return moved.select("arch", "island", "uids", "sizes", F.concat("population", F.array("elite")).alias("population"))


def _settle(islands: DataFrame, capacity: int, tag: int, last: bool) -> DataFrame:
    """``uid, length, sequence_id, offset, final`` from the best packing of each archipelago."""
    best = islands.select("arch", "uids", "sizes", F.element_at("population", 1).alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = [np.frombuffer(p, np.int32) for p in row["packings"]]
                uids, sizes = np.frombuffer(row["uids"], np.int64), np.frombuffer(row["sizes"], np.int64)
                assign = max(found, key=lambda p: fitness(sizes, p, capacity))
                fill = np.bincount(assign, weights=sizes)
                final = fill >= WELL_FILLED * capacity
                open_ = np.flatnonzero(~final)
                final[open_[np.argsort(fill[open_], kind="stable")][max(1, len(fill) // 8) :]] = True  # so that rounds shrink
                order = np.argsort(assign, kind="stable")
                ends = np.cumsum(sizes[order])
                first = np.r_[0, np.cumsum(fill)[:-1]].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(uids[order]), pa.array(sizes[order]), pa.array(((np.int64(tag) << 48) | (np.int64(row["arch"]) << SEQUENCES_BITS)) + assign[order].astype(np.int64)),
                        pa.array(ends - sizes[order] - first[assign[order]]), pa.array(final[assign[order]] | last),
                    ],
                    names=["uid", "length", "sequence_id", "offset", "final"],
                )

    grouped = best.groupBy("arch").agg(F.first("uids").alias("uids"), F.first("sizes").alias("sizes"), F.collect_list("p").alias("packings"))
    return grouped.mapInArrow(run, "uid long, length long, sequence_id long, offset long, final boolean")


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """``uid, sequence_id, offset`` for pieces ``uid, length`` (a distinct uid each, 1 <= length <= capacity).

    Sequences hold at most ``capacity`` and start at offset 0 without gaps.
    """
    full = pieces.filter(F.col("length") >= capacity).select("uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    spark, done, rest, tag = pieces.sparkSession, [full], pieces.filter(F.col("length") < capacity).select("uid", "length"), 0
    n = rest.count()
    while n:
        tag, n_groups, mark = tag + 1, -(-n // GROUP), written()
        islands = materialize(_epoch(_found(rest, n_groups), capacity, 0), f"islands-{tag}-0")
        for epoch in range(1, EPOCHS):
            islands = materialize(_epoch(_migrate(islands), capacity, epoch), f"islands-{tag}-{epoch}")
        settled = materialize(_settle(islands, capacity, tag, n_groups == 1), f"packed-{tag}")
        release(spark, mark, settled)
        done.append(settled.filter("final").select("uid", "sequence_id", "offset"))
        rest = settled.filter("not final").select("uid", "length")
        n = rest.count()
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, carry: dict[str, Column] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens.

    Returns a row per piece: ``doc_id, piece, start, length``, the columns of
    ``carry`` (expressions over those and ``ids``; by default ``ids`` itself),
    ``sequence_id, offset``.

    Defined cases: a null or empty text is one piece of its end id; repeated
    rows, and rows with a null id, are packed each for itself; an empty table
    gives no rows; other columns, whatever their names, are ignored. A very long
    text is one value while it is encoded; its pieces are rows of their own.
    """
    carry = {"ids": F.col("ids")} if carry is None else carry
    pieces = tokenize_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    pieces = materialize(
        pieces.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "piece", "start", "length", *(c.alias(n) for n, c in carry.items())), "pieces"
    )
    placed = pack_pieces(pieces.select("uid", "length"), capacity).withColumnRenamed("uid", "placed_uid")
    return pieces.join(placed, pieces.uid == placed.placed_uid).select("doc_id", "piece", "start", "length", *carry, "sequence_id", "offset")
