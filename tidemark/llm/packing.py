"""Items packed into containers of fixed capacity by bin completion.

Items are spread by hash over blocks of a bounded number of items, each packed by itself. In a block the
largest item left opens a container; the undominated fillings around it are enumerated by branch and bound,
and the search over containers is pruned by the room that the lower bound still allows to waste. Best-fit
decreasing gives the first incumbent; if it meets the lower bound no search is needed. The search has limits,
and each block says how its number of containers is known to be least, or that a limit ended the search.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scale import cut

#: Items in a block on average: the most that one task packs at a time is about this many.
BLOCK = 20_000
#: Steps of the enumeration around one largest item, and containers opened in all, before the incumbent stands.
FILLINGS, NODES = 400, 200_000


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Containers of item numbers: each item, largest first, goes where the least room is left."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []  # (room, container), sorted
    for i in order:
        at = bisect_right(rooms, (sizes[i], -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        insort(rooms, (room - sizes[i], b))
    return bins


def exact(counts: dict[int, int], order: list[int], room: int, most: int = FILLINGS) -> tuple[int, ...] | None:
    """The first set of sizes that fills ``room`` to the last, largest sizes tried first; None if none is met in ``most`` steps."""
    steps = 0

    def extend(start: int, left: int, chosen: tuple[int, ...]) -> tuple[int, ...] | None:
        nonlocal steps
        if left == 0:
            return chosen
        steps += 1
        for k in range(start, len(order)):
            if steps >= most:
                return None
            if order[k] <= left and chosen.count(order[k]) < counts[order[k]] and (got := extend(k, left - order[k], (*chosen, order[k]))):
                return got
        return None

    return extend(0, room, ()) if room else None


def fillings(counts: dict[int, int], order: list[int], room: int, most: int = FILLINGS) -> tuple[list[tuple[int, ...]], bool]:
    """(undominated sets of sizes that fit in ``room``, fullest first; whether these are all). order: the sizes left, largest first.

    A filling is left out if one of its sizes can be swapped for a larger one left over that still fits, or
    another item still fits: then the better filling leads to no more containers.
    """
    out: list[tuple[int, tuple[int, ...]]] = []
    steps, whole = 0, True

    def extend(start: int, left: int, chosen: tuple[int, ...]) -> None:
        nonlocal steps, whole
        if steps >= most:
            whole = False
            return
        steps += 1
        fits = [k for k in range(start, len(order)) if order[k] <= left and chosen.count(order[k]) < counts[order[k]]]
        for k in fits:
            extend(k, left - order[k], (*chosen, order[k]))
            if not whole:
                return
        # Larger sizes than the last chosen may still fit too: such a set is found from their side.
        if not fits and not any(s <= left and counts[s] > chosen.count(s) for s in order[:start]):
            for c in set(chosen):
                if any(c < s <= c + left and counts[s] > chosen.count(s) for s in order):
                    break
            else:
                insort(out, (left, chosen))

    extend(0, room, ())
    return [c for _, c in out] or [()], whole


def complete(sizes: list[int], capacity: int, fillings_limit: int = FILLINGS, nodes_limit: int = NODES) -> list[list[int]]:
    """Containers of item numbers, as few as bin completion finds. Each size is 1 to ``capacity``."""
    return packed(sizes, capacity, fillings_limit, nodes_limit)[0]


def packed(sizes: list[int], capacity: int, fillings_limit: int = FILLINGS, nodes_limit: int = NODES) -> tuple[list[list[int]], str]:
    """complete(), and how its number is known to be least: 'bound' (the sizes need as many), 'search' (no packing has fewer), or 'limit' (not known)."""
    incumbent = best_fit(sizes, capacity)
    least = -(-sum(sizes) // capacity)
    while len(incumbent) > least:
        better, whole = searched(sizes, capacity, len(incumbent) - 1, fillings_limit, nodes_limit)
        if better is None:
            return incumbent, "search" if whole else "limit"
        incumbent = better
    return incumbent, "bound"


def fewer(sizes: list[int], capacity: int, most: int) -> list[list[int]] | None:
    """A packing in ``most`` containers or less, None if the search finds none."""
    return searched(sizes, capacity, most)[0]


def searched(sizes: list[int], capacity: int, most: int, fillings_limit: int = FILLINGS, nodes_limit: int = NODES) -> tuple[list[list[int]] | None, bool]:
    """(a packing in ``most`` containers or less, None if the search finds none; whether the search saw all there is)."""
    whole = True
    total, nodes = sum(sizes), 0
    counts: dict[int, int] = {}
    for s in sizes:
        counts[s] = counts.get(s, 0) + 1
    plan: list[tuple[int, ...]] = []
    best: list[tuple[int, ...]] | None = None
    allowed = most * capacity - total  # room that a better packing may waste
    order = sorted(counts, reverse=True)
    # Depth first without recursion: at each container the fillings not yet tried.
    stack: list[Iterator[tuple[int, ...]]] = []
    wasted = [0]

    def options() -> Iterator[tuple[int, ...]]:
        nonlocal whole
        while order and not counts[order[0]]:
            order.pop(0)
        largest = order[0]
        room = capacity - largest

        def inside(f):
            """``f`` over what is left beside the largest item."""
            counts[largest] -= 1
            got = f(counts, [s for s in sizes_left if counts[s] and s <= room], room, fillings_limit)
            counts[largest] += 1
            return got

        # The rest is enumerated only if the search comes back for it; what is left is then as it was.
        sizes_left = list(order)
        first = inside(exact)
        if first is not None:
            yield (largest, *first)
        found, all_ = inside(fillings)
        whole &= all_
        yield from ((largest, *f) for f in found if f != first)

    left = len(sizes)
    stack.append(options())
    while stack and nodes < nodes_limit:
        choice = next(stack[-1], None)
        if choice is None:
            stack.pop()
            if plan:
                for s in plan.pop():
                    counts[s] += 1
                    left += 1
                wasted.pop()
                order = sorted((s for s, c in counts.items() if c), reverse=True)
            continue
        nodes += 1
        waste = wasted[-1] + capacity - sum(choice)
        if waste > allowed:
            continue
        for s in choice:
            counts[s] -= 1
            left -= 1
        plan.append(choice)
        wasted.append(waste)
        if not left:
            best = list(plan)
            break
        stack.append(options())
    if best is None:
        return None, whole and not stack
    by_size: dict[int, list[int]] = {}
    for i in range(len(sizes) - 1, -1, -1):
        by_size.setdefault(sizes[i], []).append(i)
    return [[by_size[s].pop() for s in choice] for choice in best], True


def pack(df: DataFrame, key: str, size: str, capacity: int, block: int = BLOCK, fillings_limit: int = FILLINGS, nodes_limit: int = NODES, known: bool = False) -> DataFrame:
    """Containers of the items of ``df``: ``container`` BIGINT, ``key``, ``piece`` INT, ``start`` BIGINT, ``size`` BIGINT, ``fill`` BIGINT.

    An item larger than ``capacity`` is cut into pieces of ``capacity`` and one of the rest, numbered from 0,
    ``start`` being where a piece begins in it; other items are one whole piece. Items of size 0 go into the
    first container of their block; null and negative sizes are no items. Repeated rows are items of their
    own. ``fill`` is the size of all pieces of the container. Equal input gives equal containers. With ``known`` a
    column of that name says how the number of containers of the item's block is known to be least (see packed()); 'limit' means
    that ``fillings_limit`` or ``nodes_limit`` ended the search and fewer may be possible.
    """
    items = cut(df.select(F.col(key).alias("key"), F.col(size).cast("bigint").alias("size")).where("size >= 0"))
    blocks = max(1, -(-items.count() // block))
    kind = df.schema[key].dataType.simpleString()
    # Copies of a row are numbered, so that they spread over the blocks like other rows.
    copies = items.groupBy("key", "size").count().select("key", "size", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
    spread = copies.select("key", "size", F.pmod(F.xxhash64("key", "size", "copy"), F.lit(blocks)).cast("int").alias("block"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "size"], kind="stable")
        base = int(pdf["block"].iloc[0]) << 32
        pieces: list[tuple[object, int, int, int]] = []
        whole: list[tuple[object, int, int, int]] = []
        empty = []
        for k, s in zip(pdf["key"].tolist(), pdf["size"].tolist(), strict=True):
            if s == 0:
                empty.append((k, 0, 0, 0))
            full, rest = divmod(s, capacity)
            whole += [(k, p, p * capacity, capacity) for p in range(full)]
            if rest:
                pieces.append((k, full, full * capacity, rest))
        out, n = [], 0
        boxes, how = packed([p[3] for p in pieces], capacity, fillings_limit, nodes_limit)
        for box in boxes:
            fill = sum(pieces[i][3] for i in box)
            out += [(base + n, *pieces[i], fill) for i in box]
            n += 1
        for w in whole:
            out.append((base + n, *w, capacity))
            n += 1
        first = out[0][5] if out else 0
        out += [(base, *e, first) for e in empty]
        return pd.DataFrame(out, columns=["container", "key", "piece", "start", "size", "fill"]).assign(known=how)

    got = spread.groupBy("block").applyInPandas(one, f"container bigint, key {kind}, piece int, start bigint, size bigint, fill bigint, known string")
    got = got if known else got.drop("known")
    return got.withColumnRenamed("key", key)
