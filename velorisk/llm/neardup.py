"""Near duplicates: a chosen-path set similarity join over minwise tokens, confirmed on whole shingle sets."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from velorisk.llm.common import (
    map_batches,
    WHITE,
    RollingHash,
    byte_class,
    chained,
    materialise,
    mixed,
    pieces,
    runs,
    salted_join,
    utf8,
)
from velorisk.llm.graph import components

_LOWERED = np.array([b + 32 if 0x41 <= b < 0x5B else b for b in range(256)], np.uint8)
_WORD = byte_class(WHITE, inverse=True)
#: Minwise tokens of a document.
TOKENS = 64
_DRAWS = np.random.default_rng(11).integers(1, 1 << 63, (2, TOKENS), dtype=np.uint64)


@dataclass(frozen=True)
class Search:
    """How the join looks for partners.

    ``trees`` independent trees; a node of at most ``leaf`` documents is compared
    exhaustively by tokens, and whole sets meet in groups of at most ``group``. Tokens are estimates, so documents are first linked loosely, at
    an estimate of ``loose``: true partners of 0.85 lie ten deviations above it.
    A document this ``close`` to the pivot of a large node leaves the node: its
    true partners are at most 0.15 farther from the pivot, two deviations or more
    within the loose link to it, and every tree has other pivots. Another ``percent``
    wants ``close`` moved by as much the other way: 0.75 at 80.
    """

    percent: int = 85
    words: int = 5
    trees: int = 12
    leaf: int = 1024
    group: int = 256
    loose: float = 0.4
    close: float = 0.7


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each distinct shingle, by row and hash; fewer than ``n`` words are one shingle."""
    data = _LOWERED[data]
    starts, ends, rows = runs(data, offsets, _WORD)
    words = RollingHash(data).of(starts, ends)
    hashes, at = chained(words, rows, n)
    found, where = [hashes], [rows[at]]
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    for fewer in range(1, n):
        short = np.flatnonzero(counts[rows] == fewer)
        hashes, at = chained(words[short], rows[short], fewer)
        found.append(hashes)
        where.append(rows[short][at])
    hashes, rows = np.concatenate(found), np.concatenate(where)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], rows[new]


def minwise(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Minwise tokens of each set (sets begin at ``begins``, none empty), one row a set."""
    out = np.zeros((len(begins), TOKENS), np.int32)
    if len(begins):
        with np.errstate(over="ignore"):
            for k in range(TOKENS):
                least = np.minimum.reduceat((hashes ^ _DRAWS[0, k]) * (_DRAWS[1, k] | np.uint64(1)), begins)
                out[:, k] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def fingerprints(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """doc_id, a hash of the text, n_shingles, two sums that stand for the set, and its minwise tokens (0 for an empty set)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            hashes, rows = shingles(*utf8(batch.column("text")), words)
            sizes = np.bincount(rows, minlength=batch.num_rows)
            full = np.flatnonzero(sizes)
            begins = np.searchsorted(rows, full)
            sums = _set_sums(hashes, begins, full, batch.num_rows)
            tokens = np.zeros((batch.num_rows, TOKENS), np.int32)
            tokens[full] = minwise(hashes, begins)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * TOKENS), pa.array(tokens.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(sizes.astype(np.int64)),
                    *(pa.array(s.view(np.int64)) for s in sums),
                    lists,
                ],
                ["doc_id", "text_hash", "n_shingles", "sum1", "sum2", "tokens"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    return rows.transform(map_batches, work, "doc_id long, text_hash long, n_shingles long, sum1 long, sum2 long, tokens array<int>")


def _set_sums(hashes: np.ndarray, begins: np.ndarray, full: np.ndarray, n: int) -> np.ndarray:
    """Two sums over each set, in rows ``full`` of ``n``; sets with equal sums and sizes count as equal."""
    sums = np.zeros((2, n), np.uint64)
    for k in (0, 1):
        if len(full):
            sums[k, full] = np.add.reduceat(mixed(hashes, k + 1), begins)
    return sums


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 8000) -> Iterator[pa.Table]:
    """Sorted batches again, in tables of ``least`` rows or more that end with a group of equal keys."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            changed[1:] |= values[1:] != values[:-1]
            if held:
                changed[0] |= values[0] != held[-1].column(key)[-1].as_py()
        last = int(np.flatnonzero(changed)[-1]) if changed.any() else -1
        if last >= 0 and rows + last >= least:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held, rows, batch = [], 0, batch.slice(last)
        held.append(batch)
        rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over the nodes that one task meets."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (up := self.above.get(x, x)) != x:
            path.append(x)
            x = up
        for p in path:
            self.above[p] = x
        return x

    def joins(self, a: int, b: int) -> bool:
        """Unites two nodes; false if they were one already."""
        a, b = self.root(a), self.root(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)
        return a != b


    def stars(self) -> list[tuple[int, int]]:
        """Every node but the roots with its root."""
        return [(x, self.root(x)) for x in list(self.above) if self.root(x) != x]


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _token_matrix(table: pa.Table) -> np.ndarray:
    return table.column("tokens").combine_chunks().flatten().to_numpy().reshape(-1, TOKENS)


def _child(path: Column, draw: Column) -> Column:
    return F.xxhash64(path, draw, F.get("tokens", draw))


def _branches(path: Column, share: float) -> Column:
    """Children of a node: the token it selects, and a second one so often that ``1 / share`` are chosen on average."""
    first, second = (F.pmod(F.xxhash64(path, F.lit(k)), F.lit(TOKENS)).cast("int") for k in (1, 2))
    more = F.pmod(F.xxhash64(path, F.lit(3)), F.lit(1000)) < int(1000 * (1 / share - 1))
    return F.explode(F.array_distinct(F.when(more, F.array(_child(path, first), _child(path, second))).otherwise(F.array(_child(path, first)))))


def loose_links(sets: DataFrame, how: Search) -> DataFrame:
    """Links a, b between sets (node, tokens) that share a small tree node and look alike by their tokens.

    Nodes are first counted by their path alone; a document alone in its node
    drops out before its tokens travel. In a node that is too large, every member
    is compared with the node's pivot and, unless close to it, moves on to the
    node's children. All members of a small node are compared with each other; a
    task reports a star for every class it sees, so a crowd of copies costs as many
    links as it has members, and classes of several tasks meet in few rounds.
    """
    share = how.percent / 100
    first = F.explode(
        F.array(*(F.xxhash64(F.lit(t), F.get("tokens", F.lit(t * (TOKENS // how.trees)))) for t in range(how.trees)))
    )
    active = sets.select("node", first.alias("path"))
    leaves, found = [], []
    while True:
        # The pivot is a member drawn by a hash; it comes with the count.
        drawn = F.min_by("node", F.xxhash64("path", "node")).alias("pivot")
        sizes = active.groupBy("path").agg(F.count("*").alias("size"), drawn).where("size > 1")
        crowd = Observation()
        placed = active.select("node", "path").join(sizes, "path").observe(crowd, F.count_if(F.col("size") > how.leaf).alias("large"))
        placed = materialise(placed, "tree-level")
        leaves.append(placed.where(F.col("size") <= how.leaf).select("node", "path"))
        if not crowd.get.get("large"):
            break
        large = placed.where(F.col("size") > how.leaf).select("node", "path", "pivot")
        pivots = large.where("node = pivot").select("path", "pivot").distinct().join(
            sets.select(F.col("node").alias("pivot"), F.col("tokens").alias("pivot_tokens")), "pivot"
        )
        same = F.aggregate(
            F.zip_with("tokens", "pivot_tokens", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x
        )
        held = large.drop("pivot").join(sets, "node").join(pivots, "path").select("node", "path", "pivot", same.alias("same"), "tokens")
        held = materialise(held, "large-nodes")
        found.append(
            held.where((F.col("same") >= int(how.loose * TOKENS)) & (F.col("node") != F.col("pivot"))).select(
                F.col("node").alias("a"), F.col("pivot").alias("b")
            )
        )
        active = held.where(F.col("same") < how.close * TOKENS).select("node", _branches(F.col("path"), share).alias("path"))
    # Small nodes of all levels are compared in one go.
    small = leaves[0]
    for more in leaves[1:]:
        small = small.unionByName(more)
    links = _compared(small.join(sets, "node"), how)
    for more in found:
        links = links.unionByName(more)
    return links


def _compared(leaves: DataFrame, how: Search) -> DataFrame:
    enough = int(how.loose * TOKENS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for table in whole_groups(batches, ["path"]):
            path, node, tokens = table.column("path").to_numpy(), table.column("node").to_numpy(), _token_matrix(table)
            step = 1
            near = np.flatnonzero(path[1:] == path[:-1])
            while len(near):
                alike = near[(tokens[near] == tokens[near + step]).sum(axis=1) >= enough]
                for a, b in zip(node[alike].tolist(), node[alike + step].tolist(), strict=True):
                    forest.joins(a, b)
                step += 1
                near = near[near + step < len(path)]
                near = near[path[near] == path[near + step]]
        yield _links(forest.stars())

    return leaves.repartition("path").sortWithinPartitions("path").transform(map_batches, work, "a long, b long")


def confirmed_links(docs: DataFrame, classes: DataFrame, blocks: DataFrame, how: Search, text: str = "text") -> DataFrame:
    """Links that connect what true links within blocks (node, root) connect.

    A node is a class (node, doc_id, sum1, sum2); its set is read from the texts of that
    id, and of these from one with those sums, since ids may repeat.

    A block's members meet with their whole sets, in groups of about ``group``
    against as many: one group for a small block, every pair of groups for a
    larger one, where a member that is linked to the block's pivot needs no
    further check against others that are.
    """
    sizes = blocks.groupBy("root").agg(F.count("*").alias("members"), F.min(F.xxhash64("root", "node")).alias("least"))
    members = salted_join(blocks, sizes, ["root"], F.col("node")).withColumn(
        "groups", F.ceil(F.col("members") / how.group).cast("int")
    )

    named = blocks.join(classes.select("node", "doc_id", "sum1", "sum2"), "node")
    members_of = membership(named.select(F.col("doc_id").alias("node")))
    sent = docs.sparkSession.sparkContext.broadcast(members_of)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            places = batch.column("places").flatten().to_numpy().reshape(-1, 4)
            batch = batch.filter(pa.array(((sent.value[places >> 6] >> (places & 63)) & 1 == 1).all(axis=1)))
            hashes, rows = shingles(*utf8(batch.column("text")), how.words)
            full = np.flatnonzero(np.bincount(rows, minlength=batch.num_rows))
            begins = np.searchsorted(rows, full)
            tokens, sums = minwise(hashes, begins), _set_sums(hashes, begins, np.arange(len(full)), len(full))
            ends = np.append(begins, len(rows))[1:]
            packed = pa.array([hashes[a:b].tobytes() for a, b in zip(begins, ends, strict=True)], pa.binary())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1, dtype=np.int32) * TOKENS), pa.array(tokens.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(full)), *(pa.array(s.view(np.int64)) for s in sums), packed, lists],
                ["doc_id", "sum1", "sum2", "shingles", "tokens"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col(text).alias("text"))
    read_sets = texts.withColumn("places", _places(len(members_of) << 6)).transform(
        map_batches, read, "doc_id long, sum1 long, sum2 long, shingles binary, tokens array<int>"
    )
    members = members.withColumn("pivot", F.xxhash64("root", "node") == F.col("least"))
    keyed = members.select("node", "root", "groups", "pivot").join(named.drop("root"), "node")
    sets = materialise(keyed.join(read_sets, ["doc_id", "sum1", "sum2"]).drop("doc_id", "sum1", "sum2"), "block-sets")
    small = sets.where("groups = 1").select(
        "root", F.lit(0).alias("i"), F.lit(0).alias("j"), "node", "shingles", "tokens", F.lit(2).alias("side"), F.lit(False).alias("settled")
    )
    big = sets.where("groups > 1")
    pivots = big.where("pivot").select("root", F.col("node").alias("pivot_node"), F.col("shingles").alias("pivot_shingles"))
    settled = materialise(
        salted_join(big, pivots.dropDuplicates(["root"]), ["root"], F.col("node")).transform(
            map_batches,
            _settling(how.percent),
            "node long, root long, groups int, shingles binary, tokens array<int>, pivot_node long, settled boolean",
        ),
        "settled-sets",
    )
    group = F.pmod(F.xxhash64("node"), F.col("groups")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
    base = settled.withColumn("own", group)
    # Unsettled members of group i (side 0) meet all members of group j (side 1).
    left = base.where("NOT settled").select("root", F.col("own").alias("i"), every.alias("j"), "node", "shingles", "tokens", F.lit(0).alias("side"), "settled")
    busy = base.where("NOT settled").groupBy("root", F.col("own").alias("i")).agg(F.count("*").alias("n")).drop("n")
    right = base.select("root", every.alias("i"), F.col("own").alias("j"), "node", "shingles", "tokens", F.lit(1).alias("side"), "settled")
    right = salted_join(right, busy, ["root", "i"], F.col("node")).select(left.columns)
    tasks = small.unionByName(left).unionByName(right)
    links = tasks.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").transform(
        map_batches,
        _confirming(how.percent), "a long, b long"
    )
    stars = settled.where("settled AND node <> pivot_node").select(F.col("node").alias("a"), F.col("pivot_node").alias("b"))
    return links.unionByName(stars)


#: Most bits of a filter for ids; it bounds what is broadcast.
MOST_BITS = 1 << 28


def membership(nodes: DataFrame) -> np.ndarray:
    """A Bloom filter (words of 64 bits) of the column node: about 16 bits an id, up to ``MOST_BITS``. With more ids than
    that it lets more others through, but loses none."""
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(10, (16 * nodes.count()).bit_length()))
    at = nodes.select(F.explode(_places(bits)).alias("at"))
    at = at.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 AS int))").alias("bit"))
    words = at.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(bits >> 6, np.int64)
    out[words.word.to_numpy()] = words.bits.to_numpy()
    return out


def _places(bits: int) -> Column:
    return F.array(*(F.pmod(F.xxhash64("node", F.lit(k)), F.lit(bits)) for k in range(4)))


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection reaches ``percent`` * union."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _settling(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, pivot = batch.column("shingles").to_pylist(), batch.column("pivot_shingles").to_pylist()
            near = [_alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(mine, pivot, strict=True)]
            names = ["node", "root", "groups", "shingles", "tokens", "pivot_node"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(near, pa.bool_())], [*names, "settled"])

    return work


def _confirming(percent: int):
    least = percent / 100 - 4 * (0.25 * percent / 100 * (1 - percent / 100) * 4 / TOKENS) ** 0.5 - 0.05

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["root", "i", "j"]):
            keys = np.stack([table.column(k).to_numpy() for k in ("root", "i", "j")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            tokens, node = _token_matrix(table), table.column("node").to_numpy()
            sets, side = table.column("shingles").to_pylist(), table.column("side").to_numpy()
            calm = table.column("settled").to_numpy()
            sizes = np.array([len(s) for s in sets])
            found = []
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(node)], strict=True):
                forest = Forest()
                quiet = node[begin:end][calm[begin:end]].tolist()
                for x in quiet[1:]:
                    forest.joins(quiet[0], x)
                mine = np.arange(begin, end)
                if side[begin] == 2:
                    rows, partners = mine, mine
                else:
                    rows, partners = mine[side[mine] == 0], mine[side[mine] == 1]
                pairs, confirmed = [], []
                for r in rows:
                    others = partners[partners > r] if side[begin] == 2 else partners
                    others = others[100 * np.minimum(sizes[others], sizes[r]) >= percent * np.maximum(sizes[others], sizes[r])]
                    same = (tokens[others] == tokens[r]).sum(axis=1)
                    good = same >= least * TOKENS
                    pairs.append(np.stack([same[good], np.full(good.sum(), r), others[good]], axis=1))
                pairs = np.concatenate(pairs) if pairs else np.zeros((0, 3), np.int64)
                for _, r, o in pairs[np.argsort(-pairs[:, 0], kind="stable")].tolist():
                    a, b = int(node[r]), int(node[o])
                    if forest.root(a) != forest.root(b) and _alike(
                        np.frombuffer(sets[r], np.uint64), np.frombuffer(sets[o], np.uint64), percent
                    ):
                        forest.joins(a, b)
                        confirmed.append((a, b))
                # Stars of a larger block would run over nodes of other tasks: there each confirmed pair is told as it is.
                found += forest.stars() if side[begin] == 2 else confirmed
            if found:
                yield _links(found)

    return work


def near_duplicates(docs: DataFrame, how: Search = Search(), text: str = "text") -> DataFrame:  # noqa: B008
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, and text_hash and sole.

    Words are runs of characters other than ASCII white space, A-Z in lower case.
    A set holds the distinct shingles of ``how.words`` words; a text with fewer
    words is one shingle; a null or blank text has an empty set and no links.
    Sets are linked if 100 * intersection >= percent * union. ``component_id`` is
    the smallest doc_id reachable, ``kept`` marks the document that bears it. Rows
    with equal sets are one class from the start, and only one of them is compared
    with others. Rows that repeat an id are documents of their own. A row without an
    id is linked with nothing and kept. Ids are whole numbers, or texts of them. Other
    columns are not looked at. Two more columns tell rows apart: ``text_hash``, and
    ``sole``, true for all rows of the one id and text that stands for its component
    (the least id and, of these, the least hash); a row without an id stands for itself.
    """
    prints = materialise(fingerprints(docs, how.words, text), "fingerprints")
    usable = prints.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = usable.groupBy("sum1", "sum2", "n_shingles").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("tokens").alias("tokens")
    )
    # Ids may repeat, so a class gets a number of its own; it is fixed by being written.
    classes = materialise(
        classes.select(F.monotonically_increasing_id().alias("node"), "sum1", "sum2", "n_shingles", "first.doc_id", "first.text_hash", "tokens"),
        "classes",
    )
    blocks = materialise(components(loose_links(classes.select("node", "tokens"), how)), "blocks")
    texts = docs.where(F.col("doc_id").isNotNull())
    roots = materialise(components(materialise(confirmed_links(texts, classes, blocks, how, text), "links")), "roots")
    first = F.struct(F.col("doc_id").alias("component_id"), F.col("text_hash").alias("component_hash"))
    grouped = classes.select("node", first.alias("first")).join(roots, "node")
    least = grouped.groupBy("root").agg(F.min("first").alias("first"))
    joined = grouped.select("node", "root").join(least, "root").select("node", "first")
    # Every class with what stands for it: itself, or the least of its component.
    told = classes.join(joined, "node", "left").select("sum1", "sum2", "n_shingles", F.coalesce("first", first).alias("first"))
    keys = ["sum1", "sum2", "n_shingles"]
    named = salted_join(prints.drop("tokens"), told, keys, F.col("doc_id"), how="left").withColumn(
        "first", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("first"))
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first.component_id", "doc_id"))
    stands = (F.col("doc_id") == F.col("first.component_id")) & (F.col("text_hash") == F.col("first.component_hash"))
    return named.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        "text_hash",
        F.coalesce(stands, F.lit(True)).alias("sole"),
    )
