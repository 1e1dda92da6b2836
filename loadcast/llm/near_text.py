"""Near-duplicate texts: bottom-k sketches of one hash function, inverted lists, union-sketch estimate, exact Jaccard.

1. Texts with equal shingle sets form a class (128 bits of hash over the whole set); only one of each class goes on.
2. A class keeps the 16 smallest hashes of its set. Two sets at the limit share fewer than `Limit.shared` of the 16 with
   probability below 2.5e-6 (6 at 0.85, 4 at 0.80), so each class is listed under its rarest values only (11 and 13; fewer
   for smaller sets): by the prefix principle two sets that share so many values still meet. Values that very many texts
   hold drop out of nearly all prefixes, and values held once make no list.
3. Lists with the same members collapse to one. A long list is split into blocks, so that no task holds it whole, and its
   members meet some pivots first, one copy of each member: what links with a pivot is one part, and meets only those
   others that are near enough to the pivot to link with it (triangle inequality, on exact similarities). The rest meets
   in pairs of blocks. A family of copies so costs linear work, and no link is lost.
4. Where two members of a list hold enough of each other's 64 smallest values, the union of both sketches estimates their
   similarity; pairs that may reach the limit are confirmed on their full sets. The member that overlaps most with the
   others is compared first; what it links needs no comparison with one another. A block gives at most one row per member.
5. Links join into components.

Cases: null text and text without words have no shingles and link with nothing; a text of fewer than five words is one
shingle; rows with a null id link with nothing, have no component and are kept; rows that repeat an id are one node and
link through any of their texts; an empty table gives an empty result. `one_of_each` judges texts and not ids: texts of one
id are apart, and rows without an id yield to copies with one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loadcast.llm.common import ascii_lower, shingle_hashes, ready_workers, words
from loadcast.llm.graph import connected_components
from loadcast.llm.groups import Parts, in_blocks, sorted_groups
from loadcast.session import materialize

#: Retained values per set in the inverted lists, and smallest values in the union estimate.
LISTED, SKETCH = 16, 64
#: Two sets at the limit fall below what a sketch asks for with no more than this probability.
MISS = 2.5e-6
#: A block holds about so many members and shingles.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 750_000
#: Members of a long list that all others are compared with first.
PIVOTS = 8


@dataclass(frozen=True)
class Limit:
    """Linked if 100 * intersection >= percent * union."""

    percent: int = 85
    width: int = 5

    def __post_init__(self):
        if not 56 <= self.percent <= 100:  # below, sets may share none of the listed values
            raise ValueError("a limit lies between 56 and 100 percent")

    @property
    def shared(self) -> int:
        """How many of their listed values two linked sets share at least."""
        return in_common(LISTED, self.percent)

    @property
    def share(self) -> float:
        """The share of the union's smallest values that two linked sets have in common at least."""
        return in_common(SKETCH, self.percent) / SKETCH


def in_common(size: int, percent: int) -> int:
    """The most of `size` sampled values that sets at the limit have in common but for a chance of `MISS`."""
    p, below, k = percent / 100, 0.0, 0
    while k < size and (below := below + math.comb(size, k) * p**k * (1 - p) ** (size - k)) <= MISS:
        k += 1
    return k


def shingle_set(text: Column, limit: Limit) -> Column:
    return shingle_hashes(words(ascii_lower(text)), limit.width)


def set_rows(docs: DataFrame, limit: Limit, *more: str) -> DataFrame:
    """doc_id, size and identity of each row's shingle set and its smallest hashes, and the columns named in `more`."""
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), *more, shingle_set(F.col("text"), limit).alias("s"))
        .select(
            "doc_id",
            *more,
            F.size("s").cast("long").alias("n"),
            F.xxhash64("s").alias("h1"),
            F.xxhash64(F.lit(7), "s").alias("h2"),
            F.slice("s", 1, LISTED).alias("low"),
        )
    )


def inverted_lists(classes: DataFrame, limit: Limit) -> DataFrame:
    """(list, rep, h1, n, members, shingles): the lists of two and more classes, one of each set of members.

    A column `node` of `classes` comes along.
    """
    more = [c for c in classes.columns if c == "node"]
    values = classes.select("rep", "h1", "n", *more, F.size("low").alias("s"), F.explode("low").alias("value"))
    often = values.groupBy("value").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = values.join(often, "value")
    one = W.partitionBy("rep", "h1")
    rank = F.row_number().over(one.orderBy("members", "value"))
    alone = F.col("s") - F.count(F.lit(1)).over(one)
    prefix = F.col("s") - F.ceil(F.col("s") * limit.shared / LISTED) + 1
    listed = shared.withColumn("rank", rank).withColumn("alone", alone).where(F.col("rank") + F.col("alone") <= prefix)
    node = F.xxhash64("rep", "h1")
    sizes = (
        listed.groupBy("value")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.sum("n").alias("shingles"),
            F.bit_xor(node).alias("x1"),
            F.bit_xor(F.xxhash64(F.lit(5), "rep", "h1")).alias("x2"),
        )
        .where("members > 1")
    )
    lists = sizes.groupBy("members", "shingles", "x1", "x2").agg(F.min("value").alias("list"))
    return listed.select("value", "rep", "h1", "n", *more).join(
        lists.select(F.col("list").alias("value"), "members", "shingles"), "value"
    ).withColumnRenamed("value", "list")


def _overlaps(heads: list[np.ndarray]) -> np.ndarray:
    """How many values each two of some short arrays share."""
    m = len(heads)
    owner = np.repeat(np.arange(m), [len(h) for h in heads])
    value, code, count = np.unique(np.concatenate(heads), return_inverse=True, return_counts=True)
    both = count > 1
    place = np.cumsum(both) - 1
    keep = both[code]
    owner, code = owner[keep], place[code[keep]]
    out = np.zeros((m, m), dtype=np.float32)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for start in range(0, int(both.sum()), 4096):
        a, b = np.searchsorted(code, [start, start + 4096])
        part = np.zeros((m, 4096), dtype=np.float32)
        part[owner[a:b], code[a:b] - start] = 1
        out += part @ part.T
    return out


def _estimates(head: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Share of the union's smallest values that a sketch and each other sketch have in common."""
    width = len(head) + max(len(o) for o in others)
    top = np.iinfo(np.int64).max
    merged = np.full((len(others), width), top)
    merged[:, : len(head)] = head
    for r, o in enumerate(others):
        merged[r, len(head) : len(head) + len(o)] = o
    merged.sort(axis=1)
    again = np.zeros(merged.shape, dtype=bool)
    again[:, 1:] = (merged[:, 1:] == merged[:, :-1]) & (merged[:, 1:] != top)
    distinct = np.cumsum(~again & (merged != top), axis=1)
    size = np.minimum(distinct[:, -1], SKETCH)
    return (again & (distinct <= size[:, None])).sum(axis=1) / np.maximum(size, 1)


def _common(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of the intersections of a sorted set with others."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    starts = np.cumsum([0, *[len(o) for o in others[:-1]]])
    return np.add.reduceat((own[at] == flat).astype(np.int64), starts)


def link_members(sets: list[np.ndarray], cross: np.ndarray | None, percent: int) -> np.ndarray:
    """Labels (positions) of the parts that links join; `cross` marks one of two blocks, whose inner pairs meet elsewhere."""
    n, share = np.array([len(s) for s in sets]), Limit(percent).share
    heads = [s[:SKETCH] for s in sets]
    short = np.minimum(n, SKETCH)
    may = _overlaps(heads) >= share * np.minimum(short[:, None], short[None, :])
    may &= 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
    np.fill_diagonal(may, False)
    if cross is not None:
        may &= cross[:, None] != cross[None, :]
    parts = Parts(len(sets))
    while True:
        left = may.sum(axis=1)
        pivot = int(left.argmax())
        if not left[pivot]:
            return parts.label
        others = np.flatnonzero(may[pivot])
        may[pivot, :] = may[:, pivot] = False
        others = others[parts.label[others] != parts.label[pivot]]
        if not len(others):
            continue
        near = _estimates(heads[pivot], [heads[o] for o in others]) >= share
        others = others[near]
        if not len(others):
            continue
        common = _common(sets[pivot], [sets[o] for o in others])
        linked = others[100 * common >= percent * (n[pivot] + n[others] - common)]
        if len(linked):
            parts.join(pivot, linked)
            one = np.flatnonzero(parts.label == parts.label[pivot])
            may[np.ix_(one, one)] = False


def _sets(group: pa.Table) -> list[np.ndarray]:
    flat = group.column("s").combine_chunks()
    ends, values = flat.offsets.to_numpy(), flat.values.to_numpy()
    return [values[ends[r] : ends[r + 1]] for r in range(group.num_rows)]


def _moved(node: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """Links of the members of a tile to the first of their part."""
    moved = np.flatnonzero(label != np.arange(len(node)))
    return {"a": node[moved], "b": node[label[moved]]}


def around_pivots(
    pivots: list[np.ndarray], sets: list[np.ndarray], percent: int
) -> tuple[np.ndarray, list[list[int]]]:
    """For each set the first pivot that it links with (-1: none), and the pivots before it whose links it may link with.

    Jaccard distance obeys the triangle inequality: what lies further from a pivot than twice the limit links with no
    text that is linked with the pivot.
    """
    n = np.array([len(s) for s in sets])
    core, near = np.full(len(sets), -1), [[] for _ in sets]
    for k, pivot in enumerate(pivots):
        common = _common(pivot, sets)
        union = len(pivot) + n - common
        linked = 100 * common >= percent * union
        may = 100 * common >= (2 * percent - 100) * union
        for r in np.flatnonzero(may & ~linked & (core < 0)):
            near[r].append(k)
        core[linked & (core < 0)] = k
    return core, near


#: A link (a, b), b null where there is none; the other columns describe a member of a long list.
MET = "a long, b long, list long, rep long, h1 long, n long, core int, near array<int>"
_MET = pa.schema(
    [(c, pa.int64()) for c in ("a", "b", "list", "rep", "h1", "n")] + [("core", pa.int32()), ("near", pa.list_(pa.int32()))]
)


def _first_meeting(percent: int):
    """Links inside of short lists; links of a block of a long list to the pivots of the list."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["list", "part"]):
            node, sets = group.column("node").to_numpy(), _sets(group)
            if group.column("blocks")[0].as_py() == 1:
                rows = {name: pa.array(v) for name, v in _moved(node, link_members(sets, None, percent)).items()}
                rows |= {f.name: pa.nulls(len(rows["a"]), f.type) for f in _MET if f.name not in rows}
            else:
                # Members come first: their pivot is -1.
                first = int((group.column("pivot").to_numpy() < 0).sum())
                if not first:
                    continue
                core, near = around_pivots(sets[first:], sets[:first], percent)
                rows = {name: group.column(name).slice(0, first).combine_chunks() for name in ("list", "rep", "h1")}
                rows["a"], rows["b"] = pa.array(node[:first]), pa.array(node[first:][core], mask=core < 0)
                rows["n"] = pa.array([len(s) for s in sets[:first]], pa.int64())
                rows["core"], rows["near"] = pa.array(core, pa.int32()), pa.array(near, pa.list_(pa.int32()))
            if len(rows["a"]):
                yield pa.RecordBatch.from_arrays([rows[f.name] for f in _MET], schema=_MET)

    return work


def _tile_links(percent: int):
    """Links inside of a block, or between the two sides of a tile."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["list", "pivot", "i", "j"]):
            pivot, i, j = (group.column(c)[0].as_py() for c in ("pivot", "i", "j"))
            cross = None if pivot < 0 and i == j else group.column("side").to_numpy() == 1
            rows = _moved(group.column("node").to_numpy(), link_members(_sets(group), cross, percent))
            if len(rows["a"]):
                yield pa.RecordBatch.from_arrays([pa.array(rows["a"]), pa.array(rows["b"])], schema=schema)

    return work


def _blocks(members: str, shingles: str) -> Column:
    return F.greatest(F.ceil(F.col(members) / BLOCK_ROWS), F.ceil(F.col(shingles) / BLOCK_SHINGLES), F.lit(1)).cast("int")


def _full_sets(docs: DataFrame, reps: DataFrame, limit: Limit) -> DataFrame:
    """(rep, h1, s): full sets of the texts of some ids; made again from the text instead of being kept for all rows."""
    return (
        docs.join(reps, "doc_id", "left_semi")
        .select(F.col("doc_id").cast("long").alias("rep"), shingle_set(F.col("text"), limit).alias("s"))
        .withColumn("h1", F.xxhash64("s"))
        .dropDuplicates(["rep", "h1"])
    )


def later_tiles(states: DataFrame) -> DataFrame:
    """(list, pivot, i, j, side, rep, h1, node): the members of long lists that still have to meet, tile by tile.

    Members that link with no pivot meet in pairs of blocks (pivot -1). Those linked with a pivot are one part already;
    they meet only members from elsewhere that are near enough to that pivot.
    """
    ids = ["rep", "h1", "node"]
    total = [F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles")]
    alone = states.where("core < 0")
    sizes = alone.groupBy("list").agg(*total).where("members > 1")
    met = in_blocks(alone.join(sizes, "list"), "list", "rep", _blocks("members", "shingles"))
    side = ((F.col("part") == F.col("j")) & (F.col("i") < F.col("j"))).cast("int").alias("side")
    tiles = met.select("list", F.lit(-1).alias("pivot"), "i", "j", side, *ids)

    at = ["list", "pivot"]
    own = states.where("core >= 0").withColumn("pivot", F.col("core"))
    guests = states.withColumn("pivot", F.explode("near"))
    rows, columns = (
        side.groupBy(*at).agg(*total).select(*at, _blocks("members", "shingles").alias(name))
        for side, name in ((own, "rows"), (guests, "columns"))
    )
    grid = rows.join(columns, at)

    def dealt(side: DataFrame, number: int, mine: str, my_blocks: str, other: str, other_blocks: str) -> DataFrame:
        place = F.pmod(F.xxhash64(F.lit(3), "list", "rep"), F.col(my_blocks)).cast("int").alias(mine)
        every = F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1)).alias(other)
        return side.join(grid, at).select(*at, place, every, F.lit(number).alias("side"), *ids)

    return tiles.unionByName(dealt(own, 0, "i", "rows", "j", "columns")).unionByName(
        dealt(guests, 1, "j", "columns", "i", "rows")
    )


def class_links(docs: DataFrame, classes: DataFrame, limit: Limit) -> DataFrame:
    """(a, b): links between classes, enough to join all that belong together; named by `node`, without it by `rep`."""
    if "node" not in classes.columns:
        classes = classes.withColumn("node", F.col("rep"))
    lists = materialize(inverted_lists(classes, limit), "lists")
    # The merge join keeps one plan at every size, and its order by id serves the joins below.
    full = _full_sets(docs, lists.select(F.col("rep").alias("doc_id")).distinct().hint("merge"), limit)
    rows = lists.withColumn("blocks", _blocks("members", "shingles")).select(
        "list",
        "blocks",
        F.pmod(F.xxhash64(F.lit(3), "list", "rep"), F.col("blocks")).cast("int").alias("part"),
        F.lit(-1).alias("pivot"),
        "rep",
        "h1",
        "node",
    )
    # The smallest hash of each of some buckets: a bounded number of pivots from an aggregate that starts in the map tasks.
    bucket = F.pmod(F.xxhash64(F.lit(11), "rep", "h1"), F.lit(PIVOTS)).cast("int").alias("pivot")
    first = F.min(F.struct(F.xxhash64(F.lit(13), "rep", "h1").alias("hash"), "rep", "h1", "node")).alias("m")
    picked = rows.where("blocks > 1").groupBy("list", "blocks", bucket).agg(first)
    everywhere = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part")
    pivots = picked.select("list", "blocks", everywhere, "pivot", "m.rep", "m.h1", "m.node")
    met = (
        rows.unionByName(pivots)
        .join(full, ["rep", "h1"])
        .select("list", "part", "pivot", "blocks", "rep", "h1", "node", "s")
        .repartition("list", "part")
        .sortWithinPartitions("list", "part", "pivot", "node")
    )
    met = materialize(met.mapInArrow(_first_meeting(limit.percent), MET), "met")
    links = met.where("b is not null").select("a", "b")
    states = met.where("list is not null").withColumnRenamed("a", "node")
    tiles = materialize(later_tiles(states), "tiles")
    # Few texts are left as a rule; whether they are few enough for a broadcast is known from the written table.
    rest = _full_sets(docs, tiles.select(F.col("rep").alias("doc_id")).distinct(), limit)
    later = (
        tiles.join(rest, ["rep", "h1"])
        .select("list", "pivot", "i", "j", "side", "node", "s")
        .repartition("list", "pivot", "i", "j")
        .sortWithinPartitions("list", "pivot", "i", "j", "side", "node")
    )
    return links.union(later.mapInArrow(_tile_links(limit.percent), "a long, b long"))


KEY = ["n", "h1", "h2"]


def near_duplicates(docs: DataFrame, limit: Limit = Limit()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of `docs`."""
    ready_workers(docs.sparkSession)
    rows = materialize(set_rows(docs, limit), "sets")
    classes = (
        rows.where("n > 0 and doc_id is not null")
        .groupBy(*KEY)
        .agg(F.min("doc_id").alias("rep"), F.first("low").alias("low"))
    )
    links = class_links(docs, classes, limit)
    # An id with several texts joins the classes of all of them.
    reps = rows.join(classes.select(*KEY, "rep"), KEY).select("doc_id", "rep").distinct()
    first = reps.groupBy("doc_id").agg(F.min("rep").alias("b"))
    several = reps.join(first, "doc_id").select(F.col("rep").alias("a"), "b")
    parts = connected_components(links.union(several))
    of_class = (
        classes.select(*KEY, "rep")
        .join(parts, F.col("rep") == F.col("node"), "left")
        .select(*KEY, F.coalesce("component", "rep").alias("class_component"))
    )
    joined = rows.drop("low").join(of_class, KEY, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id"))
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, limit: Limit = Limit()) -> DataFrame:
    """One row of each group of near copies, the one of the smallest id; texts are judged, not ids.

    Texts of one id are apart unless they resemble each other. Rows that repeat id and text are one row. Rows without an id
    yield to rows with one and among each other only to the same shingle set; rows without words only to their repeats.
    """
    ready_workers(docs.sparkSession)
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", digest)
    rows = materialize(set_rows(named, limit, "digest"), "sets")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    classes = rows.where("n > 0").groupBy(*KEY).agg(first, F.first("low").alias("low"))
    classes = classes.select(*KEY, "low", F.col("first.doc_id").alias("rep"), F.col("first.digest").alias("digest"))
    # The numbers are written with the classes, so that they stay what they are.
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    parts = connected_components(class_links(docs, classes.where("rep is not null"), limit))
    grouped = classes.select("node", "rep", "digest").join(parts, "node", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "node"))
    stays = grouped.groupBy("component").agg(F.min(F.struct("rep", "digest")).alias("k"))
    stays = stays.select(F.col("k.rep").alias("doc_id"), F.col("k.digest").alias("digest"))
    stays = stays.unionByName(rows.where("n = 0").select("doc_id", "digest").distinct())
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest, F.struct("*").alias("row"))
    whole = whole.alias("w").join(
        stays.alias("k"), F.expr("w.doc_id <=> k.doc_id and w.digest = k.digest"), "left_semi"
    )
    nth = F.row_number().over(W.partitionBy("doc_id", "digest").orderBy(F.lit(0)))
    return whole.withColumn("nth", nth).where("nth = 1").select("row.*")
