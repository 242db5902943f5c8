"""Best-fit packing of token sequences by a grouping genetic algorithm.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens.
Full pieces are sequences by themselves.  The others are dealt by a hash of
their unique row key into shards of about ``shard_pieces`` pieces, and each
shard is packed by a grouping genetic algorithm: a solution is a set of bins,
crossover injects whole well-filled bins of one parent into another and
removes the bins that hold their documents a second time.  Displaced pieces
first replace smaller ones where they fill a bin better, and best fit places
what is left.  Each shard evolves on several islands, which are rows of one table;
between epochs the best solution of each island migrates to the next by a
join.  A shard that reaches the lower bound stops.

The pieces are written to the shared folder once, row keys included, so
retried tasks and later steps see the same keys.  No step holds more than a
shard's pieces: shards follow from the piece count, and keys are unique, so
repeated documents do not gather anywhere.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm import token_ids
from wardflow.llm.common import cut, ship_by_value

END_ID = 0
CAPACITY = 2048
SHARD_PIECES = 10_000
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 6
POPULATION = 3
#: Shards a task evolves one after the other, where there are more than cores.
SHARDS_PER_TASK = 16
#: Pieces of a bin that a replacement chooses from, and rounds of replacement a solution gets.
SWAP_PIECES = 6
SWAP_ROUNDS = 4


# ---------------------------------------------------------------------------
# one shard: bins, best fit, crossover (plain Python over a few thousand pieces)
# ---------------------------------------------------------------------------

class Packing:
    """A solution: bins as lists of piece numbers, with their fill."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.bins: list[list[int]] = []
        self.fill: list[int] = []

    def add_bin(self, items: list[int], lengths: list[int]) -> None:
        self.bins.append(items)
        self.fill.append(sum(lengths[i] for i in items))

    def best_fit(self, items: Sequence[int], lengths: list[int], order: list[float] | None = None) -> None:
        """Put each item, longest (or largest in ``order``) first, into the
        fullest bin that takes it."""
        by = lengths if order is None else order
        by_room: dict[int, list[int]] = {}
        rooms = 0  # bit r is set where a bin has r tokens of room
        for b, f in enumerate(self.fill):
            r = self.capacity - f
            by_room.setdefault(r, []).append(b)
            rooms |= 1 << r
        for i in sorted(items, key=lambda i: -by[i]):
            n = lengths[i]
            fitting = rooms >> n
            if fitting:
                r = n + (fitting & -fitting).bit_length() - 1
                b = by_room[r].pop()
                if not by_room[r]:
                    rooms ^= 1 << r
                self.bins[b].append(i)
                self.fill[b] += n
            else:
                r, b = self.capacity, len(self.bins)
                self.bins.append([i])
                self.fill.append(n)
            by_room.setdefault(r - n, []).append(b)
            rooms |= 1 << (r - n)

    def fitness(self) -> float:
        """Fewer bins first, then fuller ones (mean squared fill)."""
        if not self.bins:
            return 0.0
        return sum((f / self.capacity) ** 2 for f in self.fill) / len(self.bins) - len(self.bins)

    def to_bytes(self, n: int) -> bytes:
        out = np.zeros(n, "<i4")
        for b, items in enumerate(self.bins):
            out[items] = b
        return out.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, lengths: list[int], capacity: int) -> Packing:
        p = cls(capacity)
        where = np.frombuffer(data, "<i4")
        order = np.argsort(where, kind="stable")
        for items in np.split(order, np.flatnonzero(np.diff(where[order])) + 1) if len(where) else []:
            p.add_bin(items.tolist(), lengths)
        return p


def lower_bound(lengths: list[int], capacity: int) -> int:
    return -(-sum(lengths) // capacity)


class Loose:
    """Displaced pieces by length; lengths, and sums of two of them, as bits
    of an integer, so that the largest one in a range is found at once."""

    def __init__(self, items: list[int], lengths: list[int], capacity: int):
        self.lengths = lengths
        self.capacity = capacity
        self.by_length: dict[int, list[int]] = {}
        self.ones = 0
        for i in items:
            self.add(i)
        self.sum_up()

    def add(self, i: int) -> None:
        self.by_length.setdefault(self.lengths[i], []).append(i)
        self.ones |= 1 << self.lengths[i]

    def pop(self, n: int) -> int:
        same = self.by_length[n]
        i = same.pop()
        if not same:
            del self.by_length[n]
            self.ones ^= 1 << n
        return i

    def sum_up(self) -> None:
        self.twos = 0
        for n in self.by_length:
            self.twos |= self.ones << n
        self.twos &= (1 << (self.capacity + 1)) - 1

    def pair(self, total: int) -> tuple[int, int] | None:
        """Lengths of two pieces with that sum, if they are (still) there."""
        for n, same in self.by_length.items():
            m = total - n
            if m in self.by_length and (m != n or len(same) > 1):
                return n, m
        return None

    def items(self) -> list[int]:
        return [i for same in self.by_length.values() for i in same]


def _swap(p: Packing, b: int, loose: Loose, lengths: list[int], rnd: np.random.Generator) -> bool:
    """Replace up to three pieces of bin ``b`` by one or two loose ones, if
    that fills it better; the fullest outcome is taken."""
    items, room = p.bins[b], p.capacity - p.fill[b]
    some = items if len(items) <= SWAP_PIECES else [items[k] for k in rnd.choice(len(items), SWAP_PIECES, replace=False)]
    gain, found = 0, None
    for k in (0, 1, 2, 3):
        for out in combinations(some, k):
            gone = sum(lengths[i] for i in out)
            upto = (1 << (gone + room + 1)) - 1
            n = (loose.ones & upto).bit_length() - 1
            if n - gone > gain:
                gain, found = n - gone, (out, (n,))
            n = (loose.twos & upto).bit_length() - 1
            if n - gone > gain:
                two = loose.pair(n)
                if two:
                    gain, found = n - gone, (out, two)
            if gain == room:
                break
        if gain == room:
            break
    if not found:
        return False
    out, new = found
    new = [loose.pop(n) for n in new]
    p.bins[b] = [i for i in items if i not in out] + new
    p.fill[b] += gain
    for i in out:
        loose.add(i)
    return True


def replace(p: Packing, items: list[int], lengths: list[int], rnd: np.random.Generator) -> list[int]:
    """Rounds of replacement over the bins with room, in random order; what is
    loose after them (smaller pieces than before).  Full bins stay."""
    loose = Loose(items, lengths, p.capacity)
    for _ in range(SWAP_ROUNDS):
        swapped = 0
        for b in rnd.permutation(len(p.bins)).tolist():
            if p.fill[b] < p.capacity and _swap(p, b, loose, lengths, rnd):
                swapped += 1
                if not swapped % 32:
                    loose.sum_up()
        if not swapped:
            break
        loose.sum_up()
    return loose.items()


def crossover(a: Packing, b: Packing, lengths: list[int], rnd: np.random.Generator) -> Packing:
    """A child of ``a`` with the best-filled bins of ``b`` injected whole, a
    random share of them; bins of ``a`` that repeat an injected piece are
    removed, and some of its least filled ones dissolved (the mutation).
    The pieces they lose replace others, then best fit places the rest."""
    child = Packing(a.capacity)
    ranked = sorted(range(len(b.bins)), key=lambda k: -b.fill[k])
    ranked = ranked[:int(len(ranked) * rnd.uniform(0.1, 0.5))]
    taken: set[int] = set()
    for k in ranked:
        child.bins.append(list(b.bins[k]))
        child.fill.append(b.fill[k])
        taken.update(b.bins[k])
    loose: list[int] = []
    weak = np.quantile(a.fill, rnd.uniform(0.05, 0.2)) if a.fill else 0
    for items, fill in zip(a.bins, a.fill):
        if not taken.isdisjoint(items):
            loose += [i for i in items if i not in taken]
        elif fill <= weak and fill < a.capacity and rnd.random() < 0.7:
            loose += items
        else:
            child.bins.append(list(items))
            child.fill.append(fill)
    child.best_fit(replace(child, loose, lengths, rnd), lengths)
    return child


def first_population(lengths: list[int], capacity: int, size: int, rnd: np.random.Generator) -> list[Packing]:
    """Best fit decreasing, and best fit in orders ever further from it (bins
    of long pieces next to bins of short ones)."""
    out = []
    for k in range(size):
        p = Packing(capacity)
        if k % 2:  # a random part alone, then the others
            part = rnd.random(len(lengths)) < 0.5
            p.best_fit(np.flatnonzero(part).tolist(), lengths)
            p.best_fit(np.flatnonzero(~part).tolist(), lengths)
        else:  # the order blurred
            blur = (np.array(lengths) * (1 + 0.1 * k * rnd.random(len(lengths)))).tolist()
            p.best_fit(range(len(lengths)), lengths, blur)
        out.append(p)
    return out


def evolve(population: list[Packing], lengths: list[int], generations: int, rnd: np.random.Generator) -> list[Packing]:
    """Best first.  Each generation every solution is crossed with the best
    or a random one; the best of old and new stay."""
    size = len(population)
    population = sorted(population, key=Packing.fitness, reverse=True)
    bound = lower_bound(lengths, population[0].capacity)
    for _ in range(generations):
        if len(population[0].bins) <= bound:
            break
        children = []
        for k in range(size):
            other = population[0 if k else int(rnd.integers(size))]
            children.append(crossover(population[k], other, lengths, rnd))
        population = sorted(population + children, key=Packing.fitness, reverse=True)[:size]
    return population


# ---------------------------------------------------------------------------
# Spark steps
# ---------------------------------------------------------------------------

def _runs(texts: pa.Array) -> tuple[pa.Array, list[int]]:
    """First rows and lengths of the runs of equal texts (the copies that a
    mix makes follow one another, and are tokenized once)."""
    same = pc.fill_null(pc.equal(texts.slice(1), texts.slice(0, max(len(texts) - 1, 0))), False)
    firsts = np.flatnonzero(np.concatenate(([True] * min(len(texts), 1), ~same.to_numpy(zero_copy_only=False))).astype(bool))
    return pa.array(firsts), np.diff(np.append(firsts, len(texts))).tolist()


def pieces(df: DataFrame, id_cols: list[Column], text: Column, json_text: str, capacity: int) -> DataFrame:
    """``id_cols`` plus one row per piece of the text's ids and the end id:
    __row (unique key), __piece, __start, __length, __crc."""
    ship_by_value(__name__)
    ship_by_value(token_ids.__name__)
    tok_json = df.sparkSession.sparkContext.broadcast(json_text)  # one tokenizer file
    inp = df.select(*id_cols, text.alias("__text"))
    made = ["__row", "__piece", "__start", "__length", "__crc"]
    out = T.StructType([f for f in inp.schema.fields if f.name != "__text"] + [T.StructField(c, T.LongType()) for c in made])
    n_ids = len(id_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = token_ids.worker_tokenizer(tok_json.value)
        key = TaskContext.get().partitionId() << 40
        step = 4 * capacity
        for batch in batches:
            of, rows = [], []
            firsts, repeats = _runs(batch.column(n_ids))
            r = 0
            for ids, n in zip(tok.batch_ids(batch.column(n_ids).take(firsts)), repeats):
                ids += END_ID.to_bytes(4, "little")
                cut_up = [(k, at // 4, len(part) // 4, zlib.crc32(part)) for k, at in enumerate(range(0, len(ids), step))
                          for part in (ids[at:at + step],)]
                for r in range(r, r + n):
                    rows += [(key + k, k, *rest) for k, *rest in cut_up]
                    of += [r] * len(cut_up)
                    key += len(cut_up)
                r += 1
            cols = np.array(rows, np.int64).reshape(-1, len(made)).T
            take = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([c.take(take) for c in batch.columns[:n_ids]] + [pa.array(c) for c in cols],
                                             names=out.names)

    return inp.mapInArrow(run, out)


_STATE = "shard int, island int, keys binary, lengths binary, population array<binary>, bins int, fitness double"


def _state_row(shard, island, keys, lengths, population, n):
    best = population[0]
    return (int(shard), int(island), keys, lengths, [p.to_bytes(n) for p in population], len(best.bins), best.fitness())


def _islands(open_pieces: DataFrame, capacity: int, islands: int, tasks: int) -> DataFrame:
    """The first population of every (shard, island)."""
    ship_by_value(__name__)

    def start(pdf):
        import pandas as pd
        pdf = pdf.sort_values("__row")
        keys, lens = pdf["__row"].to_numpy("<i8"), pdf["__length"].to_numpy("<i4")
        shard, lengths = int(pdf["shard"].iloc[0]), lens.tolist()
        rows = []
        for k in range(islands):
            pop = evolve(first_population(lengths, capacity, POPULATION, np.random.default_rng([shard, k])), lengths, 0, None)
            rows.append(_state_row(shard, k, keys.tobytes(), lens.tobytes(), pop, len(lens)))
        return pd.DataFrame(rows, columns=["shard", "island", "keys", "lengths", "population", "bins", "fitness"])

    return (open_pieces.select("shard", "__row", "__length").repartition(tasks, "shard")
            .groupBy("shard").applyInPandas(start, _STATE))


def _epoch(state: DataFrame, capacity: int, generations: int, epoch: int) -> DataFrame:
    """Every island evolves by itself, with its migrant if it has one."""
    ship_by_value(__name__)

    def run(batches):
        import pandas as pd
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                lens = np.frombuffer(r.lengths, "<i4")
                lengths = lens.tolist()
                pop = [Packing.from_bytes(p, lengths, capacity) for p in r.population]
                if r.migrant is not None:
                    pop[-1] = Packing.from_bytes(r.migrant, lengths, capacity)
                pop = evolve(pop, lengths, generations, np.random.default_rng([r.shard, r.island, epoch]))
                rows.append(_state_row(r.shard, r.island, r.keys, r.lengths, pop, len(lens)))
            yield pd.DataFrame(rows, columns=["shard", "island", "keys", "lengths", "population", "bins", "fitness"])

    return state.mapInPandas(run, _STATE)


def _places(best: DataFrame, capacity: int) -> DataFrame:
    """(__row, sequence_id, offset) of every piece of the shards' best solutions."""
    ship_by_value(__name__)

    def run(batches):
        import pandas as pd
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                keys, lens = np.frombuffer(r.keys, "<i8"), np.frombuffer(r.lengths, "<i4").astype(np.int64)
                where = np.frombuffer(r.solution, "<i4").astype(np.int64)
                order = np.argsort(where, kind="stable")
                ends = np.cumsum(lens[order])
                first = np.concatenate(([True], np.diff(where[order]) != 0))
                begin = (ends - lens[order])[first][np.cumsum(first) - 1]
                yield pd.DataFrame({"__row": keys[order], "sequence_id": (np.int64(r.shard) << 32) + where[order],
                                    "offset": ends - lens[order] - begin})

    return best.mapInPandas(run, "__row long, sequence_id long, offset long")


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
         capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, islands: int = ISLANDS, epochs: int = EPOCHS,
         generations: int = GENERATIONS) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` tokens.

    Returns one row per piece: the id column, piece, start, length, ids_crc32,
    sequence_id, offset and __row (a number unique to the piece).  Sequences
    are gapless from offset 0.

    Null and empty texts are the end id alone.  Documents of over
    ``capacity`` tokens, however long, are cut into full pieces and a rest.
    Repeated rows and null or repeated ids are packed like any others, a row
    each.  An empty table gives an empty result; other columns of ``df`` are
    not looked at.
    """
    spark = df.sparkSession
    with open(tokenizer_path or token_ids.default_path(), encoding="utf-8") as f:
        json_text = f.read()
    all_pieces = cut(pieces(df, [F.col(id_col).alias("__id")], F.col(text_col), json_text, capacity))
    open_pieces = all_pieces.where(F.col("__length") < capacity)
    shards = max(1, math.ceil(open_pieces.count() / shard_pieces))
    open_pieces = open_pieces.withColumn("shard", F.pmod(F.xxhash64("__row"), F.lit(shards)).cast("int"))
    tasks = min(shards, max(math.ceil(shards / SHARDS_PER_TASK), spark.sparkContext.defaultParallelism))
    state = cut(_islands(open_pieces, capacity, islands, tasks))
    for e in range(epochs):
        elite = state.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"),
                             F.col("population")[0].alias("migrant"))
        arrived = (state.join(elite, ["shard", "island"]) if e else state.withColumn("migrant", F.lit(None).cast("binary")))
        state = cut(_epoch(arrived.repartition(tasks * islands, "shard", "island"), capacity, generations, e))
    best = state.repartition(tasks, "shard").groupBy("shard").agg(F.max_by(F.struct("keys", "lengths", F.col("population")[0].alias("solution")),
                                               F.struct("fitness", -F.col("island"))).alias("b")).select("shard", "b.*")
    places = _places(best, capacity)
    full = all_pieces.where(F.col("__length") == capacity).select(
        "*", (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = all_pieces.where(F.col("__length") < capacity).join(places, "__row").unionByName(full)
    return out.select(F.col("__id").alias(id_col), F.col("__piece").cast("int").alias("piece"), F.col("__start").alias("start"),
                      F.col("__length").alias("length"), F.col("__crc").alias("ids_crc32"), "sequence_id", "offset", "__row")
