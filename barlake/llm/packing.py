"""Packing of documents into sequences, by a grouping genetic algorithm on islands.

A document's tokens end with one separator. Only a document longer than a sequence is cut, its first piece taking
what whole sequences leave over. The other pieces are dealt into problems of a bounded number of
pieces. Each problem has several islands, each with a population of packings. A child takes whole
well-filled bins of one parent and those of the other that share no piece with them; pieces
left over are exchanged for shorter ones where that fills a bin, and go where they fit best. After each epoch an island's best packing goes to the next
island. The emptiest bins of all problems are opened and their pieces packed again, until one
problem is left.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from barlake.llm.common import stored
from barlake.llm.tokens import BYTE_BPE, byte_encoder

CAPACITY, SEPARATOR = 2048, 0
#: Pieces of a problem, islands a problem, epochs with a migration between, children an epoch.
PROBLEM, ISLANDS, EPOCHS, CHILDREN, POPULATION = 5000, 3, 2, 30, 6
#: The share of a problem's bins, the emptiest with any room, that is opened again.
OPEN_BINS = 0.125


def piece_starts(length: int, capacity: int) -> list[int]:
    """Where the pieces of a document start: all are full but the first."""
    return [0, *range((length - 1) % capacity + 1, length, capacity)]


_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, *, capacity: int = CAPACITY, path: str = BYTE_BPE, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``, with ``ids`` if wanted.

    A null text is empty: its only token is the separator. Rows are kept as they are, repeated ones and those
    without a doc_id too. An empty table gives no rows.
    """

    def over_all(batches):
        encode = byte_encoder(path, plain=False)
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(SEPARATOR)).astype("<u4")
                starts = piece_starts(len(ids), capacity)
                for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    part = ids[start:end]
                    for column, value in zip(rows, (doc_id, piece, start, end - start, zlib.crc32(part.tobytes()), part.astype(np.int32)), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)][: 5 + with_ids]
            yield pa.record_batch(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(over_all, _PIECES + (", ids array<int>" if with_ids else ""))


class Packing:
    """Bins of piece numbers and the room left in each."""

    def __init__(self, bins: list[list[int]], rooms: list[int]) -> None:
        self.bins, self.rooms = bins, rooms

    def score(self) -> tuple[int, int]:
        """The smaller the better: few bins, then room gathered in few of them."""
        return len(self.bins), -sum(room * room for room in self.rooms)

    def best_fit(self, items, lengths: list[int], capacity: int) -> Packing:
        """Put each piece where it leaves the least room."""
        free: dict[int, list[int]] = {}
        mask = 0  # bit r: some bin has room r
        for at, room in enumerate(self.rooms):
            free.setdefault(room, []).append(at)
            mask |= 1 << room
        for item in items:
            size = lengths[item]
            fits = mask >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                at = free[room].pop()
                if not free[room]:
                    mask ^= 1 << room
            else:
                at, room = len(self.bins), capacity
                self.bins.append([])
                self.rooms.append(room)
            self.bins[at].append(item)
            room -= size
            self.rooms[at] = room
            free.setdefault(room, []).append(at)
            mask |= 1 << room
        return self

    def exchange(self, loose: list[int], lengths: list[int]) -> list[int]:
        """Swap pieces for loose ones that leave less room; what is loose in the end is shorter, and sooner fits."""
        held = sorted((lengths[item], item) for item in loose)
        for at, room in enumerate(self.rooms):
            if not room:
                continue
            for place, item in enumerate(self.bins[at]):
                size = lengths[item]
                found = bisect_right(held, (size + room, len(lengths))) - 1
                if found >= 0 and held[found][0] > size:
                    larger, self.bins[at][place] = held.pop(found)
                    insort(held, (size, item))
                    room -= larger - size
                    if not room:
                        break
            self.rooms[at] = room
        return [item for _, item in reversed(held)]

    def labels(self, count: int) -> np.ndarray:
        found = np.empty(count, np.int32)
        for at, members in enumerate(self.bins):
            found[members] = at
        return found


def read_packing(labels: np.ndarray, lengths: list[int], capacity: int) -> Packing:
    bins: list[list[int]] = [[] for _ in range(int(labels.max()) + 1)]
    for item, at in enumerate(labels.tolist()):
        bins[at].append(item)
    return Packing(bins, [capacity - sum(map(lengths.__getitem__, members)) for members in bins])


def crossover(one: Packing, other: Packing, lengths: list[int], capacity: int, chance: random.Random) -> Packing:
    """Bins of ``one`` without any piece of the injected bins of ``other``, which are well filled."""
    order = sorted(range(len(other.bins)), key=other.rooms.__getitem__)
    best = order[: max(1, 3 * len(order) // 4)]
    injected = chance.sample(best, max(1, len(best) // 3))
    taken = bytearray(len(lengths))
    for at in injected:
        for item in other.bins[at]:
            taken[item] = 1
    child = Packing([list(other.bins[at]) for at in injected], [other.rooms[at] for at in injected])
    displaced = []
    for members, room in zip(one.bins, one.rooms, strict=True):
        if any(map(taken.__getitem__, members)):
            displaced += [item for item in members if not taken[item]]
        else:
            child.bins.append(list(members))
            child.rooms.append(room)
    return child.best_fit(child.exchange(displaced, lengths), lengths, capacity)


def mutate(packing: Packing, lengths: list[int], capacity: int, chance: random.Random) -> Packing:
    """Opens the emptiest bins and some others, and packs their pieces in another order."""
    order = sorted(range(len(packing.bins)), key=packing.rooms.__getitem__, reverse=True)
    opened = {*order[: 1 + len(order) // 50], *chance.sample(order, min(len(order), 1 + len(order) // 50))}
    loose = [item for at in opened for item in packing.bins[at]]
    kept = [at for at in range(len(packing.bins)) if at not in opened]
    child = Packing([list(packing.bins[at]) for at in kept], [packing.rooms[at] for at in kept])
    loose = child.exchange(loose, lengths)
    loose.sort(key=lambda item: lengths[item] * chance.uniform(0.8, 1.2), reverse=True)
    return child.best_fit(loose, lengths, capacity)


def first_population(lengths: list[int], capacity: int, chance: random.Random, size: int) -> list[Packing]:
    """Best fit by falling length, exactly and with the order disturbed."""
    found = []
    for number in range(size):
        spread = 0.1 * number
        order = sorted(range(len(lengths)), key=lambda i: lengths[i] * chance.uniform(1 - spread, 1 + spread), reverse=True)
        found.append(Packing([], []).best_fit(order, lengths, capacity))
    return found


def evolve(population: list[Packing], lengths: list[int], capacity: int, chance: random.Random, children: int) -> list[Packing]:
    """The population after some children, best first; a child takes the place of the worst if it is better."""
    ranked = sorted(((p.score(), n, p) for n, p in enumerate(population)), key=lambda x: x[:2])
    least = -(-sum(lengths) // capacity)
    for number in range(children):
        best = ranked[0][2]
        if len(best.bins) == least and sum(room > 0 for room in best.rooms) <= 1:
            break  # nothing is left to win
        one, other = (min(chance.sample(ranked, 2), key=lambda x: x[:2])[2] if len(ranked) > 1 else best for _ in range(2))
        child = crossover(one, other, lengths, capacity, chance)
        if chance.random() < 0.5:
            child = mutate(child, lengths, capacity, chance)
        if child.score() < ranked[-1][0]:
            ranked[-1] = (child.score(), len(population) + number, child)
            ranked.sort(key=lambda x: x[:2])
    return [p for *_, p in ranked]


_STATE = "problem bigint, island int, population array<array<int>>, elite array<int>, bins int, room_squares bigint"


def _epoch(number: int, capacity: int, children: int):
    """Evolves one island per row, with the best packing of the island before in place of its worst."""

    def over_all(batches):
        for batch in batches:
            # Row by row: a batch holds many populations.
            for row in (r for at in range(batch.num_rows) for r in batch.slice(at, 1).to_pylist()):
                lengths = row["lengths"]
                chance = random.Random(f"{row['problem']}:{row['island']}:{number}")
                if row["population"] is None:
                    population = first_population(lengths, capacity, chance, POPULATION)
                else:
                    told = row["population"][: POPULATION - 1] + [row["migrant"]]
                    population = [read_packing(np.array(labels), lengths, capacity) for labels in told]
                population = evolve(population, lengths, capacity, chance, children)
                labels = [p.labels(len(lengths)) for p in population]
                bins, squares = population[0].score()
                values = [row["problem"], row["island"], labels, labels[0], bins, -squares]
                kinds = [pa.int64(), pa.int32(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.int32()), pa.int32(), pa.int64()]
                yield pa.record_batch(
                    [pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                    ["problem", "island", "population", "elite", "bins", "room_squares"],
                )

    return over_all


def _solve(spark: SparkSession, problems: DataFrame, count: int, capacity: int, epochs: int, children: int) -> DataFrame:
    """``problem, rows, lengths, elite``: the best packing of each problem that any island found."""
    tasks = max(1, min(count * ISLANDS, 8 * spark.sparkContext.defaultParallelism))
    islands = problems.select("*", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
    state = None
    for number in range(epochs):
        if state is None:
            given = islands.withColumn("population", F.lit(None).cast("array<array<int>>")).withColumn("migrant", F.lit(None).cast("array<int>"))
        else:
            sent = state.select("problem", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("elite").alias("migrant"))
            given = islands.join(state.select("problem", "island", "population"), ["problem", "island"]).join(sent, ["problem", "island"])
        given = given.select("problem", "island", "lengths", "population", "migrant")
        # Little data but much work: as many tasks as there are islands, up to some per core.
        state = stored(spark, given.repartition(tasks, "problem", "island").mapInArrow(_epoch(number, capacity, children), _STATE), "islands")
    best = Window.partitionBy("problem").orderBy("bins", F.desc("room_squares"), "island")
    winners = state.withColumn("rank", F.row_number().over(best)).where("rank = 1").select("problem", "elite")
    return problems.join(winners, "problem")


def _placed(solved: DataFrame, capacity: int, last: bool) -> DataFrame:
    """``row, length, problem, bin, offset, opened`` of every piece of the problems' best packings."""
    each = F.explode(F.arrays_zip("rows", "lengths", "elite")).alias("at")
    rows = solved.select("problem", each).select(
        "problem", F.col("at.rows").alias("row"), F.col("at.lengths").cast("bigint").alias("length"), F.col("at.elite").alias("bin")
    )
    bins = Window.partitionBy("problem", "bin")
    filled = rows.withColumn("room", capacity - F.sum("length").over(bins)).withColumn(
        "offset", F.sum("length").over(bins.orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    )
    # The emptiest bins of a problem; a problem has a bounded number of pieces.
    emptiest = F.dense_rank().over(Window.partitionBy("problem").orderBy(F.desc("room"), "bin"))
    many = F.max("bin").over(Window.partitionBy("problem")) + 1
    opened = F.lit(False) if last else (emptiest <= F.ceil(many * OPEN_BINS)) & (F.col("room") > 0)
    return filled.select("row", "length", "problem", "bin", F.coalesce("offset", F.lit(0)).alias("offset"), opened.alias("opened"))


def pack_lengths(
    spark: SparkSession, lengths: DataFrame, *, capacity: int = CAPACITY, problem: int = PROBLEM,
    epochs: int = EPOCHS, children: int = CHILDREN,
) -> DataFrame:
    """``row, sequence_id, offset`` for each ``row, length`` with 1 to ``capacity`` tokens; rows are distinct.

    Pieces that fill a sequence have one of their own. Each level packs what the level before has
    opened: at most an eighth of its bins, so levels shrink and end with a single problem.
    """
    full = lengths.where(F.col("length") == capacity).select("row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    left = stored(spark, lengths.where(F.col("length") < capacity).select("row", "length"), "lengths")
    done, level = [full], 0
    while count := left.count():
        number = -(-count // problem)
        dealt = left.withColumn("problem", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(number)))
        members = F.sort_array(F.collect_list(F.struct("row", F.col("length").cast("int").alias("length"))))
        problems = dealt.groupBy("problem").agg(members.alias("members")).select(
            "problem", F.col("members.row").alias("rows"), F.col("members.length").alias("lengths")
        )
        solved = _solve(spark, stored(spark, problems, "problems"), number, capacity, epochs, children)
        placed = stored(spark, _placed(solved, capacity, number == 1), "placed")
        # 16 bits for the bin of a problem, 40 for the problem, the level above them.
        name = F.lit(level << 56) + F.shiftleft("problem", 16) + F.col("bin")
        done.append(placed.where("not opened").select("row", name.alias("sequence_id"), "offset"))
        left, level = placed.where("opened").select("row", "length"), level + 1
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


def pack(
    spark: SparkSession, docs: DataFrame, *, capacity: int = CAPACITY, path: str = BYTE_BPE, with_ids: bool = False,
    problem: int = PROBLEM, epochs: int = EPOCHS, children: int = CHILDREN,
) -> DataFrame:
    """``pieces`` of all documents with ``sequence_id, offset``: their places in sequences without gaps.

    Nulls, repeated rows and empty tables are as in ``pieces``. Equal inputs in equal order give
    equal packings; ties between packings go to the island of the smaller number.
    """
    if problem >= 1 << 15:
        raise ValueError("a problem has less than 32768 pieces")
    cut = pieces(docs, capacity=capacity, path=path, with_ids=with_ids)
    rows = stored(spark, cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    placed = pack_lengths(spark, rows.select("row", "length"), capacity=capacity, problem=problem, epochs=epochs, children=children)
    return rows.join(placed, "row").drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, starts``: the tokens of each sequence and where its pieces begin.

    Takes the rows of ``pack`` with ids; a sequence gathers at most its capacity of tokens.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts")
    return packed.groupBy("sequence_id").agg(parts).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("starts")
    )
