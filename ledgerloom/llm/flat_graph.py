"""Near-duplicate vectors by a flat, robustly pruned graph over overlapping cluster shards.

1. Vectors are scaled to length one; equal ones become one node with a number of copies.
2. Nodes of one label and dimension form a cell. A cell with more than HOMES nodes is split
   around pivots, nodes with the least hashes: each node's home is the cell of its nearest
   pivot, and it is a guest in the cells of pivots nearly as near (within ``margin``).
   Where a node's angle to a pivot and the covering radius of the pivot's homes together
   stay within the angle asked for, all these homes are linked with it and need no search:
   only their number and one link to the pivot are kept, so a dense group costs its rows
   times the pivots of a cell and not its pairs.
3. A cell's homes with a slice of its guests are a shard. A task builds the shard's graph:
   of each node's nearest candidates those stay that no nearer one occludes (robust pruning),
   and a few far ones. The adjacency lists of all shards are united per node.
4. Each shard is searched for each of its nodes, greedily from the medoid and the node's own
   place; a node found in range widens the search by all its neighbours. Only homes count,
   so that each link is counted once for each of its ends, and out of a shard come counts and
   a spanning forest of its links, never its pairs.
5. An audit compares a sample of nodes with all nodes; while too few links were found, all is
   done again with twice the effort: margin, candidates, degree and beam. That ends where every
   node is a guest everywhere and a search reaches all nodes of a shard.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial
from math import acos

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.common import linked_classes
from ledgerloom.operators.skew import lookup_join
from ledgerloom.operators.slices import cut, discard

# The batch functions travel to the executors whole, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIMILARITY = 0.93
#: Homes of a cell, and guests of a shard; what a task holds at once.
HOMES, GUESTS = 1024, 3072
#: Pivots of a split, rows of a cell that are assigned at once, and rounds after which cells
#: are split by a hash with all of their nodes as guests.
PIVOTS, ASSIGNED, ROUNDS = 256, 8192, 8
#: Nearest candidates of a node, degree after pruning, far neighbours, and the factor by which
#: a nearer neighbour must be closer to a candidate to occlude it.
CANDIDATES, DEGREE, FAR, ALPHA = 64, 24, 4, 1.2
#: Nodes that a search keeps apart from those in range, and searches at once.
BEAM, SEARCHES = 8, 64
#: How much less similar than the nearest a pivot may be whose cell a node visits, at first.
MARGIN = 0.1
#: Nodes in the audit, and the share of their links that must have been found.
AUDITED, RECALL = 256, 0.999
#: Slack of bounds on angles against rounding.
SLACK = 1e-9

MEMBERS = "node bigint, copies bigint, unit binary, cell string, home boolean, asks boolean"


# --- nodes ---------------------------------------------------------------------------------------


def _units(batches: Iterator) -> Iterator:
    """vec_id, cell, key, unit of (vec_id, embedding, label); a null key for what links with nothing."""
    from hashlib import blake2b

    import numpy as np
    import pyarrow as pa

    for batch in batches:
        cells, keys, units = [], [], []
        for vector, label in zip(batch.column("embedding").to_pylist(), batch.column("label").to_pylist()):
            cell = key = unit = None
            if vector and label is not None and None not in vector:
                v = np.array(vector, float)
                top = np.abs(v).max()
                if np.isfinite(top) and top > 0:
                    v = v / top
                    # adding zero makes -0 and 0 one
                    unit = (v / np.sqrt(v @ v) + 0.0).tobytes()
                    cell, key = f"{len(v)}:{label}", blake2b(unit, digest_size=16).digest()
            cells.append(cell)
            keys.append(key)
            units.append(unit)
        arrays = [pa.array(cells, pa.string()), pa.array(keys, pa.binary()), pa.array(units, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *arrays], ["vec_id", "cell", "key", "unit"])


def _matrix(column):
    import numpy as np

    units = column.to_pylist()
    return np.frombuffer(b"".join(units), "f8").reshape(len(units), -1)


# --- cells ---------------------------------------------------------------------------------------


def _nearest(rows, pivots, depth: int):
    """Similarities of rows to the pivots of their cell, and the place of each row's pivot."""
    import numpy as np

    alike = _matrix(rows.column("unit")) @ _matrix(pivots.column("unit")).T
    if depth < ROUNDS:
        return alike, alike.argmax(1)
    places = np.array(rows.column("node").to_pylist(), "u8") * np.uint64(0x9E3779B97F4A7C15)
    return alike, ((places >> np.uint64(32)) % np.uint64(alike.shape[1])).astype("i8")


def _settle(key, rows, pivots, depth: int):
    """node, place, alike: the pivot of every home."""
    import numpy as np
    import pyarrow as pa

    pivots = pivots.sort_by("place")
    alike, own = _nearest(rows, pivots, depth)
    reached = alike[np.arange(len(own)), own]
    cells = pa.array([rows.column("cell")[0].as_py()] * len(own), pa.string())
    return pa.table(
        {"cell": cells, "place": pa.array(own), "copies": rows.column("copies"), "alike": pa.array(reached)}
    )


def _deal(key, rows, pivots, depth: int, margin: float):
    """Homes and guests of the cells around the pivots, and (linked, hook) of those covered."""
    import numpy as np
    import pyarrow as pa

    pivots = pivots.sort_by("place")
    alike, own = _nearest(rows, pivots, depth)
    number = len(own)
    home = np.array(rows.column("home").to_pylist(), bool)
    asks = np.array(rows.column("asks").to_pylist(), bool)
    is_own = np.zeros(alike.shape, bool)
    is_own[np.arange(number), own] = True
    lowest = np.array(pivots.column("lowest").to_pylist(), float)  # of the homes around a pivot
    sizes = np.array(pivots.column("size").to_pylist(), "i8")
    angle = np.arccos(np.clip(alike, -1, 1)) + np.arccos(np.clip(lowest, -1, 1))
    covered = (angle <= acos(SIMILARITY) - SLACK) & asks[:, None] & (sizes > 0)
    near = alike >= alike.max(1, keepdims=True) - (margin if depth < ROUNDS else 4)
    homes = is_own & home[:, None]
    guests = near & asks[:, None] & ~homes & ~covered & (sizes > 0)
    placed = homes | guests
    row, place = np.nonzero(placed)
    cell, nodes = rows.column("cell")[0].as_py(), rows.column("node")
    parts = [
        pa.table(
            {
                "node": nodes.take(pa.array(row)),
                "copies": rows.column("copies").take(pa.array(row)),
                "unit": rows.column("unit").take(pa.array(row)),
                "cell": pa.array([f"{cell}/{p}" for p in place], pa.string()),
                "home": pa.array(homes[row, place]),
                # a home that its own cell covers has found all there is in it
                "asks": pa.array(asks[row] & ~covered[row, place]),
                "linked": pa.array([None] * len(row), pa.int64()),
                "hook": pa.array([None] * len(row), pa.int64()),
            }
        )
    ]
    row, place = np.nonzero(covered)
    # a home is not linked with itself, but with its copies, which are counted once for all
    copies = np.array(rows.column("copies").to_pylist(), "i8")
    linked = sizes[place] - np.where(homes[row, place], copies[row], 0)
    parts.append(
        pa.table(
            {
                "node": nodes.take(pa.array(row)),
                "copies": rows.column("copies").take(pa.array(row)),
                "unit": pa.array([None] * len(row), pa.binary()),
                "cell": pa.array([None] * len(row), pa.string()),
                "home": pa.array([False] * len(row), pa.bool_()),
                "asks": pa.array([False] * len(row), pa.bool_()),
                "linked": pa.array(linked, pa.int64()),
                "hook": pivots.column("node").take(pa.array(place)),
            }
        )
    )
    return pa.concat_tables([p.combine_chunks() for p in parts])


def _split(members: DataFrame, open_: DataFrame, depth: int, margin: float) -> DataFrame:
    """Members of the open cells (cell, homes, slices, pivots), one level down."""
    sliced = cut(
        members.join(open_, "cell").withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    )
    order = Window.partitionBy("cell").orderBy(F.xxhash64("node", F.lit(depth)), "node")
    first = sliced.where("home").withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < PIVOTS)
    first = cut(first.where("place < pivots").select("cell", "place", "node", "unit", "slices"))
    each = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    columns = ["node", "copies", "unit", "cell", "home", "asks", "slice"]
    homes = sliced.where("home").select(columns).groupBy("cell", "slice")
    around = homes.cogroup(first.select("cell", "place", "unit", each).groupBy("cell", "slice")).applyInArrow(
        partial(_settle, depth=depth), "cell string, place bigint, copies bigint, alike double"
    )
    stats = around.groupBy("cell", "place").agg(F.min("alike").alias("lowest"), F.sum("copies").alias("size"))
    pivots = first.join(stats, ["cell", "place"], "left").na.fill({"lowest": -1.0, "size": 0})
    dealt = cut(
        sliced.select(columns)
        .groupBy("cell", "slice")
        .cogroup(pivots.select("cell", "place", "node", "unit", "lowest", "size", each).groupBy("cell", "slice"))
        .applyInArrow(partial(_deal, depth=depth, margin=margin), f"{MEMBERS}, linked bigint, hook bigint")
    )
    discard(sliced, first)
    return dealt


def _cells(nodes: DataFrame, margin: float) -> tuple[DataFrame, DataFrame]:
    """Members of small cells with a search to do, and (node, linked, hook) of what is covered."""
    members = cut(nodes.select("node", "copies", "unit", "cell", F.lit(True).alias("home"), F.lit(True).alias("asks")))
    told, small, depth = [], [], 0
    while True:
        sizes = members.groupBy("cell").agg(
            F.count_if("home").alias("homes"), F.count("*").alias("n"), F.bool_or("asks").alias("asked")
        )
        large = sizes.where(F.col("asked") & (F.col("homes") > HOMES)).select(
            "cell",
            F.ceil(F.col("n") / ASSIGNED).cast("int").alias("slices"),
            F.least(F.lit(PIVOTS), F.ceil(2 * F.col("homes") / HOMES)).cast("int").alias("pivots"),
        )
        large = cut(large)
        low = sizes.where(F.col("asked") & (F.col("homes") <= HOMES) & (F.col("homes") > 0))
        low = low.select("cell", F.ceil((F.col("n") - F.col("homes")) / GUESTS).cast("int").alias("slices"))
        small.append(members.join(low, "cell"))
        if large.isEmpty():
            break
        dealt = _split(members, large, depth, margin)
        told.append(dealt.where("linked IS NOT NULL").select("node", "linked", "hook"))
        members = dealt.where("linked IS NULL").select("node", "copies", "unit", "cell", "home", "asks")
        depth += 1
    parts = small[0]
    for part in small[1:]:
        parts = parts.unionByName(part)
    covered = members.sparkSession.createDataFrame([], "node bigint, linked bigint, hook bigint")
    for part in told:
        covered = covered.unionByName(part)
    return parts, covered


def _shards(members: DataFrame) -> DataFrame:
    """cell, slice and members: homes in every slice, asking in the first; guests in one each."""
    last = F.greatest(F.col("slices"), F.lit(1)) - 1
    homes = members.where("home").withColumn("slice", F.explode(F.sequence(F.lit(0), last)))
    homes = homes.withColumn("asks", F.col("asks") & (F.col("slice") == 0))
    guests = members.where("NOT home").withColumn("slice", F.pmod(F.xxhash64("node"), last + 1).cast("int"))
    return homes.unionByName(guests).drop("slices")


# --- graphs --------------------------------------------------------------------------------------


def _build(table, effort: int):
    """a, b: the pruned edges of a shard."""
    import numpy as np
    import pyarrow as pa

    units, nodes = _matrix(table.column("unit")), np.array(table.column("node").to_pylist(), "i8")
    n, edges = len(nodes), []
    count = min(CANDIDATES * effort, n - 1)
    if count < 1:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    for at in range(0, n, 256):
        block = np.arange(at, min(at + 256, n))
        alike = units[block] @ units.T
        alike[np.arange(len(block)), block] = -9
        found = np.argpartition(-alike, count - 1, axis=1)[:, :count]
        order = np.argsort(-np.take_along_axis(alike, found, 1), axis=1, kind="stable")
        found = np.take_along_axis(found, order, 1)
        apart = 2 - 2 * np.take_along_axis(alike, found, 1)
        among = 2 - 2 * np.matmul(units[found], units[found].transpose(0, 2, 1))
        alive, kept = np.ones(found.shape, bool), np.zeros(found.shape, bool)
        for j in range(count):
            pick = alive[:, j] & (kept.sum(1) < DEGREE * effort)
            kept[:, j] = pick
            alive &= ~(pick[:, None] & (ALPHA * ALPHA * among[:, j] <= apart))
        row, place = np.nonzero(kept)
        edges.append((block[row], found[row, place]))
    # far ones by steps around a ring, so that nothing is out of reach
    ring = np.arange(n)
    for k in range(min(FAR, n - 1)):
        step = 1 if k == 0 else 1 + int(n * 0.618 * k) % (n - 1)
        edges.append((ring, (ring + step) % n))
    a, b = (np.concatenate(x) for x in zip(*edges))
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    return pa.table({"a": pa.array(nodes[a]), "b": pa.array(nodes[b])})


def _forest(one, two, n: int) -> tuple:
    """A spanning forest of links between n places: each place with the least it reaches."""
    import numpy as np

    least = np.arange(n)
    while True:
        low = np.minimum(least[one], least[two])
        after = least.copy()
        for ends in (least[one], least[two], one, two):
            np.minimum.at(after, ends, low)
        while (after[after] != after).any():
            after = after[after]
        if (after == least).all():
            break
        least = after
    held = np.flatnonzero(least != np.arange(n))
    return held, least[held]


def _search(table, effort: int):
    """node, linked (copies among homes in range), hook (a node that links reach, or null)."""
    import numpy as np
    import pyarrow as pa

    units, nodes = _matrix(table.column("unit")), np.array(table.column("node").to_pylist(), "i8")
    home, asks = (np.array(table.column(c).to_pylist(), bool) for c in ("home", "asks"))
    copies = np.array(table.column("copies").to_pylist(), "i8")
    n, asking = len(nodes), np.flatnonzero(asks)
    # the united lists, as places in this shard
    order = np.argsort(nodes)
    lists = [np.frombuffer(x or b"", "<i8") for x in table.column("near").to_pylist()]
    owner, near = np.repeat(np.arange(n), [len(x) for x in lists]), np.concatenate([*lists, nodes[:0]])
    at = np.minimum(nodes[order].searchsorted(near), n - 1)
    here = nodes[order][at] == near
    owner, near = owner[here], order[at[here]]
    begins = np.searchsorted(owner, np.arange(n + 1))
    degrees = np.diff(begins)
    medoid = int((units @ units.mean(0)).argmax())
    linked = np.zeros(len(asking), "i8")
    roots = (np.zeros(0, "i8"), np.zeros(0, "i8"))
    for first in range(0, len(asking), SEARCHES):
        own = asking[first : first + SEARCHES]
        every = np.arange(len(own))
        alike = np.full((len(own), n), -9.0)
        spread = np.zeros((len(own), n), bool)
        who, new = np.concatenate([every, every]), np.concatenate([np.full(len(own), medoid), own])
        while len(who):
            pairs = np.unique(who * n + new)
            who, new = pairs // n, pairs % n
            fresh = alike[who, new] < -8
            who, new = who[fresh], new[fresh]
            alike[who, new] = np.einsum("ij,ij->i", units[own[who]], units[new])
            wide = alike >= SIMILARITY
            beam = min(BEAM * effort, n)
            best = np.argpartition(-alike, beam - 1, axis=1)[:, :beam]
            wide[every[:, None], best] |= alike[every[:, None], best] > -8
            wide &= ~spread
            spread |= wide
            row, place = np.nonzero(wide)
            sizes = degrees[place]
            who = np.repeat(row, sizes)
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            new = near[np.repeat(begins[place], sizes) + inside]
        found = alike >= SIMILARITY
        found[every, own] = False
        linked[first : first + len(own)] = (found & home) @ copies
        row, place = np.nonzero(found)
        one, two = np.concatenate([roots[0], own[row]]), np.concatenate([roots[1], place])
        roots = _forest(one, two, n)
    hooked = pa.table(
        {
            "node": pa.array(nodes[roots[0]]),
            "linked": pa.array(np.zeros(len(roots[0]), "i8")),
            "hook": pa.array(nodes[roots[1]]),
        }
    )
    counts = pa.table(
        {"node": pa.array(nodes[asking]), "linked": pa.array(linked), "hook": pa.array([None] * len(asking), pa.int64())}
    )
    return pa.concat_tables([counts, hooked])


def _joined(batches: Iterator) -> Iterator:
    """a, near (packed) of (a, nears: array)."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        near = [np.array(x, "<i8").tobytes() for x in batch.column("nears").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("a"), pa.array(near, pa.binary())], ["node", "near"])


def links(nodes: DataFrame, effort: int = 1) -> DataFrame:
    """node, linked, hook of nodes (node, copies, unit, cell), some rows per node: ``linked`` adds up
    to the copies of other nodes in range; ``hook`` is a node that links reach, or null."""

    def build(table):
        return _build(table, effort)

    def search(table):
        return _search(table, effort)

    members, covered = _cells(nodes, MARGIN * effort)
    shards = cut(_shards(members))
    edges = shards.groupBy("cell", "slice").applyInArrow(build, "a bigint, b bigint")
    # a node has a bounded number of neighbours from each of its shards
    united = edges.distinct().groupBy("a").agg(F.sort_array(F.collect_list("b")).alias("nears"))
    lists = united.mapInArrow(_joined, "node bigint, near binary")
    found = (
        shards.join(lists, "node", "left")
        .groupBy("cell", "slice")
        .applyInArrow(search, "node bigint, linked bigint, hook bigint")
    )
    result = cut(found.unionByName(covered))
    discard(shards)
    return result


def recall(nodes: DataFrame, counts: DataFrame, audited: int = AUDITED) -> float:
    """Share of the links of a sample that ``counts`` (node, linked) has; the sample has at most
    ``audited`` nodes, those of the least hashes, and is compared with all nodes."""
    order = F.xxhash64("node", F.lit("audit"))
    sample = nodes.select("node", "copies", "unit", "cell").orderBy(order).limit(audited).collect()
    asked = [(r.node, r.cell, bytes(r.unit)) for r in sample]

    def compare(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            table = pa.Table.from_batches([batch])
            cells = np.array(table.column("cell").to_pylist())
            copies = np.array(table.column("copies").to_pylist(), "i8")
            ids, names = np.array(table.column("node").to_pylist()), []
            for cell in {c for _, c, _ in asked}:
                rows = np.flatnonzero(cells == cell)
                mine = [(node, unit) for node, c, unit in asked if c == cell]
                if len(rows):
                    units = _matrix(table.column("unit").take(pa.array(rows)))
                    alike = units @ np.frombuffer(b"".join(u for _, u in mine), "f8").reshape(len(mine), -1).T
                    for k, (node, _) in enumerate(mine):
                        hit = (alike[:, k] >= SIMILARITY) & (ids[rows] != node)
                        names.append((node, int(copies[rows][hit].sum())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in names], pa.int64()), pa.array([x for _, x in names], pa.int64())],
                ["node", "true"],
            )

    true = nodes.select("node", "copies", "unit", "cell").mapInArrow(compare, "node bigint, true bigint")
    true = true.groupBy("node").agg(F.sum("true").alias("true"))  # a row per audited node
    both = true.join(counts, "node", "left").na.fill(0, ["linked"])
    row = both.agg(F.sum(F.least("true", "linked")).alias("found"), F.sum("true").alias("true")).first()
    return row.found / row.true if row.true else 1.0


def near_duplicates(df: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding, label).

    Rows with equal labels are linked if the cosine of their vectors is SIMILARITY or more.
    Vectors that are null, empty, zero, or hold null or non-finite components, vectors of other
    lengths and rows without a label link with nothing. Repeated rows, and rows that share a
    vec_id, are vectors of their own. ``component_id`` is the least vec_id that links reach; a
    row without a vec_id counts as a vector and has a null one only if all that it reaches have
    none. ``kept`` marks the row whose vec_id that is. An empty table gives no rows.
    """
    picked = df.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("string").alias("label"),
    )
    rows = cut(picked.mapInArrow(_units, "vec_id bigint, cell string, key binary, unit binary"))
    usable = rows.where("key IS NOT NULL").groupBy("cell", "key").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("low"), F.first("unit").alias("unit")
    )
    nodes = cut(usable.withColumn("node", F.monotonically_increasing_id()))
    effort, whole = 1, max(2 / MARGIN, (HOMES + GUESTS) / BEAM)
    while True:
        found = links(nodes, effort)
        counts = found.groupBy("node").agg(F.sum("linked").alias("linked"))
        if effort >= whole or recall(nodes, counts) >= RECALL:
            break
        discard(found)
        effort *= 2
    edges = found.where("hook IS NOT NULL").select(F.col("node").alias("a"), F.col("hook").alias("b"))
    classes = linked_classes(edges).withColumnRenamed("class", "group")
    named = nodes.select("node", "cell", "key", "copies", "low").join(counts, "node", "left").join(classes, "node", "left")
    named = cut(
        named.select(
            "cell",
            "key",
            "low",
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
            F.coalesce("group", "node").alias("group"),
        )
    )
    lows = named.groupBy("group").agg(F.min("low").alias("component_id"))
    told = lookup_join(named.drop("low"), lows, "group", distinct=True).select("cell", "key", "n_links", "component_id")
    own = rows.select("vec_id", "cell", "key")
    linked = lookup_join(own.where("key IS NOT NULL"), told, ["cell", "key"]).select("vec_id", "n_links", "component_id")
    alone = own.where("key IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
