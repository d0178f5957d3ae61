"""Filling fixed-capacity containers: bin completion with branch and bound, run block by block.

Items are dealt at random into blocks of bounded size, and every block is a search of its own: best-fit-decreasing is the
first incumbent, the undominated fillings around the largest remaining item are the branches, and a branch ends where its
waste, or the bound on what remains, cannot lead below the incumbent. A block loses no more against one global search
than its last, part-filled container.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize, ship

BLOCK_ITEMS = 2048
NODES = 30_000  # steps of the search of one block; None searches to the end
FILLINGS = 24  # branches of one container, the fullest first; those beyond are tried too where the search has no limit


def bound(items: list[int], capacity: int) -> int:
    """Containers that are needed at least: for every threshold a, items over capacity - a stand alone, those over half the
    capacity one by one, and what they leave open must take the items from a up to half of it."""
    s = sorted(items)
    if not s:
        return 0
    sums = [0, *accumulate(s)]
    half = bisect_right(s, capacity // 2)  # s[half:] are over half the capacity
    best = -(-sums[-1] // capacity)
    for a in {0, *s[:half]}:
        alone = bisect_right(s, capacity - a)  # s[alone:] take nothing of size a or more
        low = bisect_left(s, a)
        mid = max(alone, half)
        open_ = (mid - half) * capacity - (sums[mid] - sums[half])
        best = max(best, len(s) - half + max(0, -(-(sums[half] - sums[low] - open_) // capacity)))
    return best


def _dominates(a: list[int], b: list[int]) -> bool:
    """Whether the items ``b`` fit into slots of the sizes ``a`` (both largest first), so that a filling with ``a`` is never worse."""
    room = list(a)

    def place(k: int) -> bool:
        if k == len(b):
            return True
        tried = set()
        for j, r in enumerate(room):
            if r >= b[k] and r not in tried:
                tried.add(r)
                room[j] -= b[k]
                if place(k + 1):
                    return True
                room[j] += b[k]
        return False

    return place(0)


class _Search:
    """Depth-first bin completion of one block."""

    def __init__(self, items: list[int], capacity: int, nodes: int | None, fillings: int):
        self.capacity, self.budget, self.fillings = capacity, nodes, fillings
        self.sizes = sorted(set(items))
        at = {s: k for k, s in enumerate(self.sizes)}
        self.counts = [0] * len(self.sizes)
        for x in items:
            self.counts[at[x]] += 1
        self.steps = 0

    def spent(self) -> bool:
        return self.budget is not None and self.steps >= self.budget

    def completions(self, top: int, waste: int, share: int | None) -> list[list[int]]:
        """Undominated fillings beside ``top`` (largest first) that leave at most ``waste`` open, the fullest first; ``share`` bounds the steps."""
        sizes, left = self.sizes, self.counts
        found: dict[int, list[list[int]]] = {}
        first, least = self.steps, next(k for k, c in enumerate(left) if c)
        n = 0

        def walk(hi: int, room: int, picked: list[int]) -> bool:
            """Whether to stop: the steps are spent, or nothing can be fuller than what was found."""
            nonlocal n
            self.steps += 1
            j = min(hi, bisect_right(sizes, room) - 1)
            while j >= 0 and not left[j]:
                j -= 1
            if j < 0:
                # a filling that leaves place for a remaining item is dominated by the one that takes it
                if room <= waste and (room < sizes[least] or not self.fits(room)):
                    found.setdefault(room, []).append(picked)
                    n += 1
                    return room == 0 and n >= self.fillings
                return False
            while j >= 0:
                if left[j]:
                    left[j] -= 1
                    stop = walk(j, room - sizes[j], [*picked, j])
                    left[j] += 1
                    if stop or (share is not None and self.steps - first >= share):
                        return True
                j -= 1
            return False

        left[top] -= 1
        walk(top, self.capacity - sizes[top], [])
        left[top] += 1
        out: list[list[int]] = []
        for room in sorted(found):
            for f in sorted(found[room], key=len):
                got = [sizes[j] for j in f]
                if not any(len(o) <= 6 and len(got) <= 6 and _dominates([sizes[j] for j in o], got) for o in out):
                    out.append(f)
        return out

    def fits(self, room: int) -> bool:
        return any(c and s <= room for s, c in zip(self.sizes, self.counts, strict=True))

    def run(self, best: list[list[int]], least: int) -> list[list[int]]:
        """The fewest containers found; ``best`` is the incumbent, ``least`` the bound of the whole block."""
        sizes, counts, capacity = self.sizes, self.counts, self.capacity
        remaining = sum(s * c for s, c in zip(sizes, counts, strict=True))
        n = sum(counts)
        path: list[tuple[int, list[list[int]], int]] = []  # largest item, fillings, the one taken
        share = None if self.budget is None else max(32, self.budget // (2 * len(best)))  # so that a whole solution takes half of the steps

        def take(top: int, filling: list[int], sign: int) -> None:
            nonlocal remaining, n
            used = 0
            for j in (top, *filling):
                counts[j] -= sign
                used += sizes[j]
            n -= sign * (1 + len(filling))
            remaining -= sign * used

        while len(best) > least and not (self.spent() and path):
            # waste that a solution with one container less may have in all
            allowed = (len(best) - 1 - len(path)) * capacity - remaining
            options: list[list[int]] = []
            if n:
                if len(path) + -(-remaining // capacity) < len(best) and allowed >= 0:
                    top = max(k for k, c in enumerate(counts) if c)
                    options = self.completions(top, min(capacity, allowed), share)
                    if self.budget is not None:
                        options = options[: self.fillings]
                if options:
                    path.append((top, options, 0))
                    take(top, options[0], 1)
                    continue
            elif len(path) < len(best):
                best = [[sizes[t], *(sizes[j] for j in o[k])] for t, o, k in path]
            while path:  # back to the last container with another filling
                top, options, k = path.pop()
                take(top, options[k], -1)
                if k + 1 < len(options):
                    path.append((top, options, k + 1))
                    take(top, options[k + 1], 1)
                    break
            else:
                return best
        return best


def _best_fit(items: list[int], capacity: int) -> list[list[int]]:
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []
    for size in sorted(items, reverse=True):
        at = bisect_right(rooms, (size, -1))
        if at == len(rooms):
            bins.append([size])
            room, k = capacity - size, len(bins) - 1
        else:
            room, k = rooms.pop(at)
            bins[k].append(size)
            room -= size
        if room:
            rooms.insert(bisect_right(rooms, (room, k)), (room, k))
    return bins


def fill(items: list[int], capacity: int, nodes: int | None = NODES, fillings: int = FILLINGS) -> list[list[int]]:
    """Containers (lists of sizes) holding all ``items``, each at most ``capacity``; never more of them than best-fit-decreasing needs.

    With ``nodes`` None the search runs to its end and the result is the least number there is; otherwise it is the best
    that was found in so many steps, which is proven least whenever it meets ``bound``. Sizes of 0 travel in the first container.
    """
    zero = [x for x in items if x <= 0]
    items = [x for x in items if x > 0]
    best = _best_fit(items, capacity)
    least = bound(items, capacity)
    if len(best) > least:
        best = _Search(items, capacity, nodes, fillings).run(best, least)
    if zero:
        if best:
            best[0] = [*best[0], *zero]
        else:
            best = [zero]
    return best


SCHEMA = "profile_name string, item_id string, fragment int, size bigint, block int, container int, least int"


def _pack_block(pdf: pd.DataFrame) -> pd.DataFrame:
    capacity = int(pdf["capacity"].iloc[0])
    sizes = pdf["size"].tolist()
    where: dict[int, list[int]] = {}
    for row, size in enumerate(sizes):
        where.setdefault(size, []).append(row)
    container = [0] * len(pdf)
    for k, members in enumerate(fill(sizes, capacity)):
        for size in members:
            container[where[size].pop()] = k
    return pdf.assign(container=container, least=max(bound([s for s in sizes if s > 0], capacity), 1))[["profile_name", "item_id", "fragment", "size", "block", "container", "least"]]


def pack(items: DataFrame, profiles: list[tuple[str, int]], block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Containers for ``items`` (item_id, size) under every profile (name, capacity).

    An item longer than the capacity, and only such a one, is split: into full containers and one rest, which is packed
    with the others. Null sizes read as 0; a profile without a positive capacity, like an empty list, gives no rows.
    One row per fragment; ``fragment`` counts from 0. Containers are numbered within (profile, block); a full fragment
    has a container of its own, with the number -1 - fragment and the block of its item. ``least``: containers that the
    packed part of the block needs at least (null for full fragments).
    """
    spark = items.sparkSession
    ship(spark)
    profiles = [(n, int(c)) for n, c in profiles if c and c > 0]
    if not profiles:
        return spark.createDataFrame([], SCHEMA)
    items = materialize(items.select(F.col("item_id").cast("string"), F.greatest(F.coalesce(F.col("size").cast("bigint"), F.lit(0)), F.lit(0)).alias("size")), "items")
    blocks = max(1, -(-items.count() // block_items))
    sets = F.array(*(F.struct(F.lit(n).alias("profile_name"), F.lit(c).cast("bigint").alias("capacity")) for n, c in profiles))
    x = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")).select("item_id", "size", "block", F.explode(sets).alias("p")).select("item_id", "size", "block", "p.*")
    full = F.when(F.col("size") > F.col("capacity"), F.floor((F.col("size") - 1) / F.col("capacity"))).otherwise(F.lit(0)).cast("int")
    x = x.withColumn("full", full)
    rest = x.select("profile_name", "item_id", F.col("full").alias("fragment"), (F.col("size") - F.col("full") * F.col("capacity")).alias("size"), "block", "capacity")
    packed = rest.groupBy("profile_name", "block").applyInPandas(_pack_block, SCHEMA)
    whole = x.filter("full > 0").select("profile_name", "item_id", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("fragment"), F.col("capacity").alias("size"), "block").withColumn("container", -1 - F.col("fragment")).withColumn("least", F.lit(None).cast("int"))
    return packed.unionByName(whole)


def split_items(packed: DataFrame) -> DataFrame:
    """(profile_name, item_id) of the items that lie in more than one container of a profile."""
    return packed.groupBy("profile_name", "item_id").agg(F.count("*").alias("n")).filter("n > 1").select("profile_name", "item_id")


def container_stats(packed: DataFrame, profiles: list[tuple[str, int]]) -> DataFrame:
    """Per profile: containers, the number that the blocks need at least, filled characters, share of the capacity that stays unused."""
    cap = F.create_map(*(F.lit(v) for n, c in profiles for v in (n, int(c)))) if profiles else F.lit(None).cast("map<string,int>")
    own = F.when(F.col("container") < 0, F.col("item_id"))
    bins = packed.groupBy("profile_name", "block", "container", own.alias("own")).agg(F.sum("size").alias("used"), F.max("least").alias("least"))
    per = bins.groupBy("profile_name", "block").agg(F.count("*").alias("containers"), F.count_if(F.col("container") < 0).alias("full"), F.sum("used").alias("chars"), F.coalesce(F.max("least"), F.lit(0)).alias("least"))
    out = per.groupBy("profile_name").agg(F.sum("containers").alias("containers"), F.sum(F.col("full") + F.col("least")).alias("least_containers"), F.sum("chars").alias("chars"))
    return out.withColumn("unused_share", 1 - F.col("chars") / (F.col("containers") * cap[F.col("profile_name")]))
