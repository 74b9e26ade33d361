"""Documents linked by the Jaccard similarity of their sets of word shingles, and the groups that
the links make.

Documents with equal sets are one node. Shingles are put in one order for all documents, by the
load of their slot in a sketch that counts the shingles of all documents, rare ones first; two sets
can only be similar enough if they share one of their first (1 - t) * size + 1 shingles. Nodes that
share such a shingle meet in its tile; tiles are banded by size, as sets whose sizes differ by more
than t cannot be linked. Nobody writes out the pairs of a tile:

1. In star rounds each node is compared with one leader, of another component, whom it meets in its
   tiles. That links most of a large group of near copies with as many comparisons as it has nodes.
   Rounds go on while they settle a fair share of the tiles.
2. Then only pairs of different components are left to compare; in a tile these are the nodes
   outside its largest component against the others. Tiles of one component need nothing.

Sizes and the numbers of rare shingles rule pairs out first. The bits of two hashed bitmaps that differ bound the intersection from above; pairs within the
bound are decided by the intersection of the sorted sets. So no link between different components
is lost, and the components are exact, whatever the sketch says: it only orders the shingles.

Null and empty texts have no shingles and are linked with nothing. Rows that repeat a doc_id or a
text are one node. A null doc_id is smaller than none: it never names a component unless all of
its documents have none, and then the name is null. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from starloom.llm import hashing
from starloom.llm.common import query, stored, table, texts
from starloom.llm.components import connected_components

PERCENT = 80
SKETCH_BITS = 24
SKETCH_PARTS = 64
_SHIFTS = np.array([0, 2, 4, 6], np.uint8)
#: Star rounds go on while one settles at least this share of the rows in tiles, so many at most.
WORTH, STAR_ROUNDS = 0.1, 8
#: Rows up to which ids are broadcast; more are shuffled.
BROADCAST_ROWS = 300_000

_PROFILES = pa.schema(
    {
        "doc_id": pa.int64(),
        "node": pa.int64(),
        "n": pa.int64(),
        "bitmap": pa.binary(),
    }
)
_PREFIXES = pa.schema(
    {
        "token": pa.int64(),
        "crowded": pa.bool_(),
        "node": pa.int64(),
        "n": pa.int32(),
        "rare": pa.int32(),
    }
)
_SETS = pa.schema({"node": pa.int64(), "members": pa.list_(pa.int64())})


def _node(members: np.ndarray) -> np.int64:
    """One number for a set: equal sets have equal ones."""
    total = hashing.mixed(members ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return hashing.mixed(total + np.uint64([len(members)])).view(np.int64)[0]


def _slot(members: np.ndarray) -> np.ndarray:
    return (members >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _bitmap(members: np.ndarray) -> bytes:
    """A bit for each member, in two to four times as many bits as there are members, 512 at least."""
    size = max(512, 1 << (2 * len(members) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(members & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _folded(bitmap: bytes, size: int) -> np.ndarray:
    """A bitmap as it would be with ``size`` bytes: halves are laid on each other."""
    words = np.frombuffer(bitmap, np.uint64)
    return np.bitwise_or.reduce(words.reshape(-1, size // 8), axis=0)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text."""
    for batch in batches:
        nodes, sizes, bitmaps = [], [], []
        for members in hashing.shingle_sets(batch.column("text")):
            sizes.append(len(members))
            nodes.append(int(_node(members)) if len(members) else None)
            bitmaps.append(_bitmap(members) if len(members) else None)
        columns = [batch.column("doc_id"), nodes, sizes, bitmaps]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _PROFILES)], schema=_PROFILES
        )


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts of shingles by slot, up to 3, four to a byte, in parts."""
    counts, pending, size = np.zeros(1 << SKETCH_BITS, np.uint8), [], 0
    any_set = False

    def flush() -> None:
        nonlocal pending, size
        if pending:
            slots, n = np.unique(np.concatenate(pending), return_counts=True)
            counts[slots] = np.minimum(counts[slots] + n, 3)
        pending, size = [], 0

    for batch in batches:
        for members in hashing.shingle_sets(batch.column("text")):
            if len(members):
                any_set = True
                pending.append(_slot(members))
                size += len(members)
                if size > 1_000_000:
                    flush()
    flush()
    if any_set:
        for part, values in enumerate(np.split(counts, SKETCH_PARTS)):
            packed = np.bitwise_or.reduce(values.reshape(-1, 4) << _SHIFTS, axis=1)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "counts": pa.array([zlib.compress(packed.tobytes(), 1)], pa.binary()),
                }
            )


def _levels(docs: DataFrame, profiles: DataFrame) -> tuple[np.ndarray, int]:
    """The load of each slot of the sketch on a logarithmic scale, a byte each (16 MB), and the
    level up to which a slot is not crowded. Each part is summed up where its rows are, one row at a
    time."""
    total = profiles.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
                packed = np.frombuffer(zlib.decompress(counts.as_py()), np.uint8)
                values = ((packed[:, None] >> _SHIFTS) & 3).reshape(-1)
                if part not in sums:
                    sums[part] = np.zeros(len(values), np.int64)
                sums[part] += values
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(list(sums), pa.int32()),
                "levels": pa.array([_level(v).tobytes() for v in sums.values()], pa.binary()),
            }
        )

    parts = (
        texts(docs)
        .mapInArrow(_sketch, "part int, counts binary")
        .repartition(SKETCH_PARTS, "part")
        .mapInArrow(run, "part int, levels binary")
        .collect()
    )
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    for row in parts:
        width = (1 << SKETCH_BITS) // SKETCH_PARTS
        levels[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(
            row["levels"], np.uint8
        )
    return levels, int(_level(np.array([64 + 2 * total / (1 << SKETCH_BITS)]))[0])


def _level(load: np.ndarray) -> np.ndarray:
    return np.minimum(255, 16 * np.log2(1 + load)).astype(np.uint8)


def _prefixes(docs: DataFrame, levels: np.ndarray, crowded: int) -> DataFrame:
    """token, whether it is crowded, node, n and rare (shingles that are not crowded) for the first
    shingles of each set."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of = shared.value
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                tokens, flags, nodes, sizes, rares = [], [], [], [], []
                for members in hashing.shingle_sets(part.column("text")):
                    n = len(members)
                    if not n:
                        continue
                    length = n - -(-PERCENT * n // 100) + 1
                    own = level_of[_slot(members)]
                    first = np.argsort(own, kind="stable")[:length]
                    tokens.append(members[first])
                    flags.append(own[first] > crowded)
                    nodes.append(_node(members))
                    sizes.append(n)
                    rares.append(np.count_nonzero(own <= crowded))
                lengths = [len(t) for t in tokens]
                flat = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
                flat_flags = np.concatenate(flags) if flags else np.zeros(0, bool)
                columns = [flat.view(np.int64), flat_flags]
                columns += [
                    np.repeat(np.array(values, kind), lengths)
                    for values, kind in ((nodes, np.int64), (sizes, np.int32), (rares, np.int32))
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_PREFIXES)

    return texts(docs).mapInArrow(run, from_arrow_schema(_PREFIXES))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and members (sorted) of the documents of ``wanted`` (doc_id, stored). Rows that repeat a
    doc_id each give a set."""
    ids = wanted.select(F.col("doc_id").alias("wanted_id"))
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    rows = texts(docs)
    rows = rows.join(ids, rows["doc_id"].eqNullSafe(ids["wanted_id"]), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 200) for i in range(0, batch.num_rows, 200)):
                sets = [m for m in hashing.shingle_sets(part.column("text")) if len(m)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(_node(m)) for m in sets], pa.int64()),
                        pa.array([np.sort(m.view(np.int64)) for m in sets], pa.list_(pa.int64())),
                    ],
                    schema=_SETS,
                )

    return rows.mapInArrow(run, from_arrow_schema(_SETS))


def _within_bound(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) whose bitmaps allow enough shared shingles: a bit of one that the other lacks
    is a shingle that the other lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            lacking = np.zeros((2, len(na)), np.int64)
            both = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())
            for at, (one, two) in enumerate(both):
                size = min(len(one), len(two))
                one, two = _folded(one, size), _folded(two, size)
                lacking[:, at] = np.bitwise_count(one & ~two).sum(), np.bitwise_count(two & ~one).sum()
            most = np.minimum(na - lacking[0], nb - lacking[1])
            keep = 100 * most >= PERCENT * (na + nb - most)
            yield batch.filter(pa.array(keep)).select(["a", "b", "na", "nb"])

    return pairs.mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint")


def _links(docs: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough, stored."""

    def side(name: str) -> DataFrame:
        return nodes.select(
            F.col("node").alias(name),
            F.col("n").alias(f"n{name}"),
            F.col("bitmap").alias(f"bits_{name}"),
        )

    bounded = stored(
        _within_bound(pairs.join(side("a"), "a").join(side("b"), "b")), "bounded-pairs"
    )
    seen = bounded.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stored(
        _sets(docs, stored(nodes.join(seen, "node", "left_semi").select("doc_id"), "wanted")), "sets"
    )
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return stored(
        bounded.join(sets.select(F.col("node").alias("a"), F.col("members").alias("set_a")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("members").alias("set_b")), "b")
        .withColumn("shared", shared)
        .where(100 * F.col("shared") >= PERCENT * (F.col("na") + F.col("nb") - F.col("shared")))
        .select("a", "b"),
        "links",
    )


def _similar_sizes(one: str, two: str) -> str:
    return f"100 * least({one}, {two}) >= {PERCENT} * greatest({one}, {two})"


def _possible(one: str, two: str) -> str:
    """Whether two nodes that meet in a tile can be linked, as far as sizes tell.

    Crowded shingles come last in the order, so a node that has one of them among its first
    shingles has all its rare ones there too: two nodes that meet by a crowded shingle either meet
    by a rare one as well, or share none but crowded ones.
    """
    shared = f"least({one}n - {one}rare, {two}n - {two}rare)"
    return (
        f"{_similar_sizes(f'{one}n', f'{two}n')} AND (NOT crowded OR "
        f"100 * {shared} >= {PERCENT} * ({one}n + {two}n - {shared}))"
    )


def _band(n: str = "n") -> str:
    """Sizes that may be linked differ by a factor of 1.25 at most, so their bands by 1 at most."""
    return f"cast(floor(ln({n}) / ln(1.26)) as int)"


def _merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` (node, component) after links between nodes."""

    def name(side: str) -> DataFrame:
        return components.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))

    edges = (
        links.join(name("a"), "a")
        .join(name("b"), "b")
        .select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    )
    moved = connected_components(edges).withColumnRenamed("component", "into")
    return stored(
        components.join(moved.withColumnRenamed("node", "component"), "component", "left").select(
            "node", F.coalesce("into", "component").alias("component")
        ),
        "components",
    )


_TILES = pa.schema(
    {
        "token": pa.int64(),
        "tile": pa.int32(),
        "crowded": pa.bool_(),
        "node": pa.int64(),
        "n": pa.int32(),
        "rare": pa.int32(),
        "lead": pa.int64(),
        "lead_n": pa.int32(),
        "lead_rare": pa.int32(),
    }
)


def _tiles(prefixes: DataFrame) -> DataFrame:
    """The different rows of ``prefixes`` whose token has two nodes at least, with their tile, a band
    of sizes, and the leader of token and tile: the node with the fewest rare shingles.

    Rows are shuffled once and sorted, so that a tile's nodes follow their leader; a task has one row
    in hand, however many a token has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, leader = None, None, None  # the last row, the token before it, its leader
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            token, node = (batch.column(name).to_numpy() for name in ("token", "node"))
            fresh = np.r_[True, (token[1:] != token[:-1]) | (node[1:] != node[:-1])]
            batch = batch.filter(pa.array(fresh))
            token, tile, node, n, rare = (
                batch.column(name).to_numpy() for name in ("token", "tile", "node", "n", "rare")
            )
            beside = np.r_[token[1:] == token[:-1], False]
            beside[1:] |= beside[:-1].copy()
            beside[0] |= before is not None and token[0] == before
            begins = np.r_[0, 1 + np.flatnonzero((token[1:] != token[:-1]) | (tile[1:] != tile[:-1]))]
            first = np.repeat(begins, np.diff(begins, append=len(token)))
            leads = [values[first] for values in (node, n, rare)]
            if leader is not None:
                # The first tile goes on from the batch before.
                for values, value in zip(leads, leader):
                    values[first == 0] = value
            leader = [values[-1] for values in leads]
            rows = pa.RecordBatch.from_arrays(
                [batch.column(name) for name in _TILES.names[:6]] + [pa.array(v) for v in leads],
                schema=_TILES,
            )
            held = batch.slice(batch.num_rows - 1)
            if len(token) > 1:
                before = token[-2]
                yield rows.slice(0, len(token) - 1).filter(pa.array(beside[:-1]))
        if held is not None and before is not None and held.column("token")[0].as_py() == before:
            columns = [held.column(name) for name in _TILES.names[:6]]
            columns += [pa.array([value], f.type) for value, f in zip(leader, list(_TILES)[6:])]
            yield pa.RecordBatch.from_arrays(columns, schema=_TILES)

    return (
        prefixes.withColumn("tile", F.expr(_band()))
        .repartition("token")
        .sortWithinPartitions("token", "tile", "rare", "node")
        .mapInArrow(run, from_arrow_schema(_TILES))
    )


def _to_leaders(members: DataFrame) -> DataFrame:
    """(a, b): of the leaders of its tiles, each node with the one with whom it shares most shingles."""
    return (
        members.where(f"component != lead_component AND {_possible('', 'lead_')}")
        .select(F.col("node").alias("a"), F.col("lead").alias("b"))
        .repartition("a")
        .groupBy("a", "b")
        .agg(F.count("*").alias("shared"))
        .groupBy("a")
        .agg(F.max(F.struct("shared", "b")).alias("best"))
        .select("a", "best.b")
    )


def _open(members: DataFrame, components: DataFrame, turn: int) -> DataFrame:
    """``members`` with their components as they are now, new leaders, and without the shingles whose
    nodes are of one component: these need no further look."""
    in_token = Window.partitionBy("token")
    in_tile = Window.partitionBy("token", "tile").orderBy(F.xxhash64("node", F.lit(turn)), "node")
    return (
        members.select("token", "tile", "crowded", "node", "n", "rare")
        .join(components, "node")
        .repartition("token")
        .withColumn("low", F.min("component").over(in_token))
        .withColumn("high", F.max("component").over(in_token))
        .where("low < high")
        .drop("low", "high")
        .withColumns(
            {
                f"lead{name}": F.first(of).over(in_tile)
                for name, of in (("", "node"), ("_n", "n"), ("_rare", "rare"), ("_component", "component"))
            }
        )
    )


def linked_nodes(docs: DataFrame, nodes: DataFrame, levels: np.ndarray, crowded: int) -> DataFrame:
    """(node, component) of the nodes that meet another one; ``nodes`` has node, n, bitmap and a
    doc_id of each."""
    members = stored(_tiles(_prefixes(docs, levels, crowded)), "tiles")
    met = stored(members.select("node").distinct(), "met")
    nodes = stored(nodes.join(met, "node", "left_semi"), "met-nodes")
    components = met.withColumn("component", F.col("node"))

    size = members.count()
    members = members.withColumns({"component": F.col("node"), "lead_component": F.col("lead")})
    for turn in range(STAR_ROUNDS):
        links = _links(docs, _to_leaders(members), nodes)
        if links.isEmpty():
            break
        components = _merged(components, links)
        members = stored(_open(members, components, turn + 1), "tiles")
        before, size = size, members.count()
        if size > (1 - WORTH) * before:
            break

    # All that is left: pairs of different components, with one of them outside the largest of their
    # shingle.
    in_token = Window.partitionBy("token")
    open_rows = stored(
        members.select("token", "tile", "crowded", "node", "n", "rare", "component")
        .repartition("token")
        .withColumn("rows", F.count("*").over(Window.partitionBy("token", "component")))
        .withColumn("main", F.max(F.struct("rows", "component")).over(in_token)["component"])
        .drop("rows"),
        "open-rows",
    )
    outside = open_rows.where("component != main").select(
        "token",
        F.explode(F.expr("array(tile - 1, tile, tile + 1)")).alias("tile"),
        F.col("node").alias("a"),
        F.struct("n", "rare").alias("other"),
        F.col("component").alias("ca"),
    )
    pairs = (
        outside.join(open_rows, ["token", "tile"])
        .where(f"ca != component AND {_possible('', 'other.')}")
        .where("component = main or a < node")
        .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
        .distinct()
    )
    links = _links(docs, pairs, nodes)
    return components if links.isEmpty() else _merged(components, links)


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id."""
    profiles = stored(texts(docs).mapInArrow(_profiles, from_arrow_schema(_PROFILES)), "profiles")
    nodes = stored(
        profiles.where("node is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.max("n").alias("n"),
            F.first("bitmap").alias("bitmap"),
        ),
        "nodes",
    )
    components = linked_nodes(docs, nodes, *_levels(docs, profiles))
    placed = nodes.select("node", "doc_id").join(components, "node", "left").select(
        "node", F.col("doc_id").alias("first_id"), F.coalesce("component", "node").alias("component")
    )
    named = placed.join(
        placed.groupBy("component").agg(F.min("first_id").alias("component_id")), "component"
    ).select("node", "component_id")
    filled = profiles.where("node is not null").join(named, "node").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )
    empty = profiles.where("node is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return filled.unionByName(empty)


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component, with all their columns."""
    kept = (
        jaccard_groups(docs)
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("kept_id"))
        .distinct()
    )
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(table(spark, folder, "documents"))
