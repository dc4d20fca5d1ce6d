"""Filling fixed-capacity containers with items.

Method: a grouping genetic algorithm on islands. Items are dealt to shards of SHARD items by a hash of their row, so no
shard is hot. Each shard is evolved on ISLANDS islands: crossover injects whole well-filled bins of one parent into the
other, bins that share an item with them are dissolved, the displaced items are exchanged for smaller ones of bins that
they fill better, and what is left is placed by best fit, largest first; mutation dissolves the emptiest bins. After each epoch an island's elite moves to the next island of its shard. The best
packing of a shard stands; bins that are still loose are opened and their items dealt to new shards, until the loose
bins fit one shard or a pass no longer helps. A shard whose first packing, best fit of falling sizes, already has as few
bins as its items can have takes no part in this: there is nothing to gain.

An item larger than the capacity is cut into pieces: full pieces fill a container each, the rest is an item. Nothing
else is split.

Defined results: null and empty texts are not placed; every other row is placed, repeated rows and null ids too, each
as an item of its own. Empty input gives no rows. The result is the same for the same input files and settings.
"""

from __future__ import annotations

import bisect
import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.tokens import VOCABULARY, with_sizes
from rillstone.storage import Workspace

CAPACITY = 2048
SHARD, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 1200, 2, 2, 12, 6
#: Shards that a task evolves one after another, and the most tasks.
PER_TASK, MOST_TASKS = 8, 4096
#: A bin is loose, and opened in the next pass, if it is filled less than this; passes at most.
LOOSE, PASSES = 0.995, 4


class _Fit:
    """Open bins by free space, for best fit."""

    def __init__(self, capacity: int):
        self.capacity, self.free, self.bins = capacity, [], []

    def add(self, bin_: list, used: int) -> None:
        bisect.insort(self.free, (self.capacity - used, len(self.bins)))
        self.bins.append(bin_)

    def place(self, item: int, size: int) -> None:
        at = bisect.bisect_left(self.free, (size, -1))
        if at == len(self.free):
            self.add([item], size)
            return
        room, k = self.free.pop(at)
        self.bins[k].append(item)
        bisect.insort(self.free, (room - size, k))


def best_fit(items: list, sizes: list, capacity: int, bins: list | None = None) -> list:
    fit = _Fit(capacity)
    for b in bins or []:
        fit.add(list(b), sum(sizes[i] for i in b))
    for i in items:
        fit.place(i, sizes[i])
    return fit.bins


def fitness(bins: list, sizes: list, capacity: int) -> float:
    """Mean squared fill; with fewer bins for the same items it is larger."""
    return sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / len(bins) if bins else 0.0


def exchange(bins: list, displaced: list, sizes: list, capacity: int) -> tuple[list, list]:
    """Bins that are not full give up to two items for one or two displaced ones that fill them better: small items are
    left over, which are easier to place."""
    loose = sorted((sizes[i], i) for i in displaced)
    out = []
    for b in bins:
        room = capacity - sum(sizes[i] for i in b)
        best = (0, (), ())
        if room and loose and len(b) <= 12:
            for k, i in enumerate(b):
                for j in (None, *b[k + 1 :]):
                    given = sizes[i] + (sizes[j] if j is not None else 0)
                    most = given + room
                    at = bisect.bisect_right(loose, (most, 1 << 60)) - 1
                    if at >= 0 and loose[at][0] - given > best[0]:
                        best = (loose[at][0] - given, (i,) if j is None else (i, j), (at,))
                    if j is None or best[0] == room:
                        continue
                    for x in range(min(len(loose) - 1, at), max(-1, at - 24), -1):  # two for two, the larger near the most
                        y = bisect.bisect_right(loose, (most - loose[x][0], 1 << 60)) - 1
                        y = y - 1 if y == x else y
                        if y >= 0 and loose[x][0] + loose[y][0] - given > best[0]:
                            best = (loose[x][0] + loose[y][0] - given, (i, j), (x, y))
        if best[0]:
            taken = [loose[x] for x in best[2]]
            for x in sorted(best[2], reverse=True):
                del loose[x]
            for i in best[1]:
                bisect.insort(loose, (sizes[i], i))
            b = [i for i in b if i not in best[1]] + [i for _, i in taken]
        out.append(b)
    return out, [i for _, i in loose]


def crossover(a: list, b: list, sizes: list, capacity: int, rng: random.Random) -> list:
    """Bins of b that are filled best, most of them, go into a whole; what a held of them is removed; displaced items by best fit."""
    ranked = sorted(b, key=lambda x: -sum(sizes[i] for i in x))
    good = ranked[: max(1, len(ranked) // 2)]
    chosen = [x for x in good if rng.random() < 0.6] or good[:1]
    taken = {i for x in chosen for i in x}
    kept, displaced = [], []
    for x in a:
        if taken.isdisjoint(x):
            kept.append(x)
        else:
            displaced += [i for i in x if i not in taken]
    kept, displaced = exchange(kept, displaced, sizes, capacity)
    displaced.sort(key=lambda i: (-sizes[i], i))
    return best_fit(displaced, sizes, capacity, [*chosen, *kept])


def mutate(bins: list, sizes: list, capacity: int, rng: random.Random) -> list:
    """The emptiest bin and a few others are dissolved and their items placed anew."""
    ranked = sorted(range(len(bins)), key=lambda k: sum(sizes[i] for i in bins[k]))
    out = {ranked[0], *(rng.randrange(len(bins)) for _ in range(3))}
    kept, items = exchange([b for k, b in enumerate(bins) if k not in out], [i for k in out for i in bins[k]], sizes, capacity)
    items.sort(key=lambda i: (-sizes[i], i))
    return best_fit(items, sizes, capacity, kept)


def least_bins(sizes: list, capacity: int) -> int:
    """A bound for any packing: the sum, and the items of more than half a bin, no two of which share one."""
    return max(-(-sum(sizes) // capacity), sum(2 * x > capacity for x in sizes))


def falling(sizes: list, capacity: int) -> list:
    return best_fit(sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)), sizes, capacity)


def start(sizes: list, capacity: int, rng: random.Random, n: int) -> list:
    population = [falling(sizes, capacity)]
    while len(population) < n:
        noisy = sorted(range(len(sizes)), key=lambda i: -sizes[i] * rng.uniform(0.7, 1.3))
        population.append(best_fit(noisy, sizes, capacity))
    return population


def evolve(population: list, sizes: list, capacity: int, rng: random.Random, generations: int) -> list:
    """Best first. Ends early where the number of bins can't be lowered."""
    least = least_bins(sizes, capacity)
    score = lambda p: (len(p), -fitness(p, sizes, capacity))
    population = sorted(population, key=score)
    size = len(population)
    for _ in range(generations):
        if len(population[0]) <= least or size < 2:
            break
        a, b = rng.sample(population, 2)
        children = [crossover(a, b, sizes, capacity, rng), mutate(crossover(b, a, sizes, capacity, rng), sizes, capacity, rng)]
        population = sorted([*population, *children], key=score)[:size]
    return population


def _encode(population: list, n: int) -> bytes:
    out = np.zeros((len(population), n), np.int32)
    for r, bins in enumerate(population):
        for k, b in enumerate(bins):
            out[r, b] = k
    return out.tobytes()


def _decode(raw: bytes, n: int) -> list:
    population = []
    for row in np.frombuffer(raw, np.int32).reshape(-1, n) if n else []:
        bins: list = [[] for _ in range(int(row.max()) + 1)]
        for i, k in enumerate(row.tolist()):
            bins[k].append(i)
        population.append(bins)
    return population


_STATE = "shard int, island int, items binary, sizes binary, population binary, elite binary, done boolean"
_STATE_NAMES = [c.split()[0] for c in _STATE.split(", ")]


def _first(capacity: int, islands: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item")
        shard, sizes = int(pdf["shard"].iloc[0]), pdf["n"].tolist()
        items, raw = pdf["item"].to_numpy(np.int64).tobytes(), pdf["n"].to_numpy(np.int64).tobytes()
        first = falling(sizes, capacity)
        if len(first) <= least_bins(sizes, capacity):
            return pd.DataFrame([(shard, 0, items, raw, None, _encode([first], len(sizes)), True)], columns=_STATE_NAMES)
        rows = []
        for island in range(islands):
            population = start(sizes, capacity, random.Random(shard * 31 + island), POPULATION)
            rows.append((shard, island, items, raw, _encode(population, len(sizes)), None, False))
        return pd.DataFrame(rows, columns=_STATE_NAMES)

    return run


def _epoch(capacity: int, number: int):
    def run(frames):
        for pdf in frames:
            rows = []
            for r in pdf.itertuples(index=False):
                sizes = np.frombuffer(r.sizes, np.int64).tolist()
                n = len(sizes)
                population = _decode(r.population, n)
                if r.elite is not None:
                    population[-1:] = _decode(r.elite, n)
                population = evolve(population, sizes, capacity, random.Random(r.shard * 1009 + r.island * 17 + number), GENERATIONS)
                rows.append((r.shard, r.island, r.items, r.sizes, _encode(population, n), _encode(population[:1], n), False))
            yield pd.DataFrame(rows, columns=_STATE_NAMES)

    return run


def _best(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        best = None
        for r in pdf.sort_values("island").itertuples(index=False):
            sizes = np.frombuffer(r.sizes, np.int64).tolist()
            p = _decode(r.elite, len(sizes))[0]
            rank = (len(p), -fitness(p, sizes, capacity))
            if best is None or rank < best[0]:
                best = (rank, p, sizes, np.frombuffer(r.items, np.int64))
        _, bins, sizes, items = best
        shard = int(pdf["shard"].iloc[0])
        rows = [(shard, k, int(items[i]), sizes[i], sum(sizes[j] for j in b)) for k, b in enumerate(bins) for i in b]
        return pd.DataFrame(rows, columns=["shard", "bin", "item", "n", "used"])

    return run


def _tasks(n: int) -> int:
    return max(1, min(-(-n // PER_TASK), MOST_TASKS))


def _pass(items: DataFrame, n_shards: int, capacity: int, space: Workspace, salt: int) -> DataFrame:
    """shard, bin, item, n, used: one evolved packing of all items."""
    dealt = items.select(F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(n_shards)).cast("int").alias("shard"), "item", "n")
    dealt = dealt.repartition(_tasks(n_shards), "shard")  # a fixed number: the work of a shard is CPU, not bytes
    first, n = space.counted(dealt.groupBy("shard").applyInPandas(_first(capacity, ISLANDS), _STATE), islands=F.count_if(~F.col("done")))
    state, best = first.where("not done"), first.where("done")
    for e in range(EPOCHS if n["islands"] else 0):
        if e:  # elites move on to the next island of their shard
            moved = state.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), F.col("elite").alias("guest"))
            state = state.join(moved, ["shard", "island"]).select("shard", "island", "items", "sizes", "population", F.col("guest").alias("elite"), "done")
        state = space.cut(state.repartition(_tasks(n["islands"]), "shard", "island").mapInPandas(_epoch(capacity, e), _STATE))
    best = best.unionByName(state) if n["islands"] else best
    return best.groupBy("shard").applyInPandas(_best(capacity), "shard int, bin int, item long, n long, used long")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """key, piece_no, start_token, n_tokens, container, container_tokens: where each piece of each text lies."""
    space = Workspace(docs.sparkSession, "packing")
    sized = space.cut(with_sizes(docs.select(key, text), [key], text, vocabulary).where("n_tokens > 0"))
    whole = F.floor(F.col("n_tokens") / capacity).cast("int")
    rest = (F.col("n_tokens") - whole * capacity).cast("long")
    full = sized.where(whole > 0).select(key, "item", F.explode(F.sequence(F.lit(0), whole - 1)).alias("piece_no"))
    full = full.select(key, "piece_no", (F.col("piece_no") * capacity).cast("long").alias("start_token"), F.lit(capacity).cast("long").alias("n_tokens"), F.concat_ws("-", F.lit("whole"), "item", "piece_no").alias("container"), F.lit(capacity).cast("long").alias("container_tokens"))

    items = sized.where(rest > 0).select("item", rest.alias("n"))
    n, done = items.count(), None
    for p in range(PASSES):
        if not n:
            break
        shards = max(1, -(-n // SHARD))
        packed = space.cut(_pass(items, shards, capacity, space, p).withColumn("container", F.concat_ws("-", F.lit("bin"), F.lit(p), "shard", "bin")))
        last = shards == 1 or p == PASSES - 1
        loose = F.lit(False) if last else F.col("used") < LOOSE * capacity
        kept = packed.where(~loose).select("item", "n", "container", "used")
        done = kept if done is None else done.unionByName(kept)
        items = packed.where(loose).select("item", "n")
        n = 0 if last else items.count()
    if done is None:
        return full
    placed = sized.where(rest > 0).join(done.select("item", "container", "used"), "item")
    placed = placed.select(key, whole.alias("piece_no"), (whole * capacity).cast("long").alias("start_token"), rest.alias("n_tokens"), "container", F.col("used").alias("container_tokens"))
    return full.unionByName(placed)


def report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """n_pieces, n_tokens, n_containers, least_containers (a bound for any packing), n_loose (filled less than LOOSE), fill."""
    per = packed.groupBy("container").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("p"))
    return per.agg(F.sum("p").alias("n_pieces"), F.sum("t").alias("n_tokens"), F.count(F.lit(1)).alias("n_containers"), F.ceil(F.sum("t") / capacity).alias("least_containers"), F.count_if(F.col("t") < LOOSE * capacity).alias("n_loose"), (F.sum("t") / (F.count(F.lit(1)) * capacity)).alias("fill"))
