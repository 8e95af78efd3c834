"""Removal of long byte strings that occur twice or more, found by a column-wise order of their contexts."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velorisk.llm.common import RollingHash, map_batches, materialise, pieces, salted_join, salted_semi, utf8
from velorisk.llm.neardup import whole_groups

#: Bytes of an anchor: the substring whose repetition makes a string worth comparing.
ANCHOR = 64
#: Most contexts that one task orders together; a larger group is dealt out, and settled in a second count.
TOGETHER = 20_000
#: Contexts that are ordered in one go within a task.
SLAB = 20_000
#: Symbol outside of a document.
OUTSIDE = 256
#: Neighbouring strings of a dealt-out group that go as one row.
NEIGHBOURS = 43
_ORDERED = ["v1", "v2", "start", "end", "anchor", "core", "places", "strings", "settled"]
_PLACE = np.uint64((1 << 31) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, RollingHash]:
    """Places of the anchors, and their rows: for every string of ``length`` bytes in a row its least anchor by hash,
    the first if several are least. Equal strings have equal anchors at equal places."""
    rolling = RollingHash(data)
    reach = length - ANCHOR + 1
    usable = len(data) - ANCHOR + 1
    sizes = np.diff(offsets)
    if usable < reach or not (sizes >= length).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), rolling
    places = np.arange(usable)
    keys = (rolling.of(places, places + ANCHOR) & ~_PLACE) | places.astype(np.uint64)
    # Least key of every ``reach`` neighbours, from running minima to both sides within blocks of that size.
    padded = np.full(-(-usable // reach) * reach, np.iinfo(np.uint64).max)
    padded[:usable] = keys
    block = padded.reshape(-1, reach)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: usable - reach + 1], ahead[reach - 1 : usable])
    starts = np.arange(len(least))
    rows = np.searchsorted(offsets, starts, side="right") - 1
    fits = starts + length <= offsets[rows + 1]
    chosen = (least[fits] & _PLACE).astype(np.int64)
    if not len(chosen):
        return chosen, chosen, rolling
    new = np.ones(len(chosen), bool)
    new[1:] = chosen[1:] != chosen[:-1]
    return chosen[new], rows[fits][new], rolling


def find_anchors(docs: DataFrame, length: int) -> DataFrame:
    """v1, v2 (the row's key), pos, lo, hi, anchor, context: an anchor's place, the bounds of its context, the hashes
    of both. The context holds every string of ``length`` bytes around the anchor, as far as the text goes."""
    side = length - ANCHOR

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            at, rows, rolling = anchors(data, offsets, length)
            low = np.maximum(at - side, offsets[rows])
            high = np.minimum(at + ANCHOR + side, offsets[rows + 1])
            anchor = rolling.of(at, at + ANCHOR)
            with np.errstate(over="ignore"):
                context = rolling.of(low, high) * np.uint64(31) + (at - low).astype(np.uint64)
            out = [batch.column(v).take(pa.array(rows)) for v in ("v1", "v2")]
            out += [pa.array((x - offsets[rows]).astype(np.int32)) for x in (at, low, high)]
            out += [pa.array(x.view(np.int64)) for x in (anchor, context)]
            yield pa.RecordBatch.from_arrays(out, ["v1", "v2", "pos", "lo", "hi", "anchor", "context"])

    return docs.transform(map_batches, work, "v1 long, v2 long, pos int, lo int, hi int, anchor long, context long")


def column_order(symbols: np.ndarray, groups: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every context and start, whether another one of its group has the same ``length`` bytes from there on, and
    whether the context is the first of those in order.

    ``symbols`` has a row per context and a column per place, all aligned at the
    anchor; ``groups`` ascends. From the last column on, each round inserts one
    symbol of every context in front: contexts are ordered anew by that symbol,
    which keeps them in the order of what follows, and the common prefix with the
    neighbour becomes one more than the least prefix between the two before.
    """
    n, width = symbols.shape
    again, first = np.zeros((n, width - length + 1), bool), np.ones((n, width - length + 1), bool)
    order, common = np.arange(n), np.zeros(n + 1, np.int32)
    for column in range(width - 1, -1, -1):
        keys = groups[order] * (OUTSIDE + 1) + symbols[order, column]
        moved = np.argsort(keys, kind="stable")
        keys = keys[moved]
        equal = np.flatnonzero(keys[1:] == keys[:-1])
        spans = np.empty(2 * len(equal), np.int64)
        spans[0::2], spans[1::2] = moved[equal] + 1, moved[equal + 1] + 1
        longer = np.zeros(n + 1, np.int32)
        if len(equal):
            longer[equal + 1] = np.minimum.reduceat(common, spans)[0::2] + 1
        order, common = order[moved], longer
        if column + length <= width:
            alike = np.flatnonzero(common >= length)
            again[order[alike], column] = again[order[alike - 1], column] = True
            first[order[alike], column] = False
    return again, first


def _ordered(length: int):
    side = length - ANCHOR
    width = ANCHOR + 2 * side

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for table in whole_groups(batches, ["anchor", "part"]):
            held.append(table)
            if sum(t.num_rows for t in held) >= SLAB:
                yield from slabs(pa.concat_tables(held))
                held = []
        if held:
            yield from slabs(pa.concat_tables(held))

    def slabs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.stack([table.column(k).to_numpy() for k in ("anchor", "part")], axis=1)
        changed = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1))
        begin = 0
        for end in [*changed[1:].tolist(), len(keys)]:
            if end - begin >= SLAB or end == len(keys):
                yield from ordered(table.slice(begin, end - begin))
                begin = end

    def ordered(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.stack([table.column(k).to_numpy() for k in ("anchor", "part")], axis=1)
        new = np.concatenate(([False], (keys[1:] != keys[:-1]).any(axis=1)))
        n = table.num_rows
        anchor, lo, pos = keys[:, 0], table.column("lo").to_numpy(), table.column("pos").to_numpy()
        data, offsets = utf8(table.column("bytes").combine_chunks())
        sizes = np.diff(offsets)
        left = side - (pos - lo)
        symbols = np.full((n, width), OUTSIDE, np.uint16)
        inside = np.repeat(np.arange(n) * width + left - offsets[:-1], sizes) + np.arange(len(data))
        symbols.ravel()[inside] = data
        again, first = column_order(symbols, np.cumsum(new), length)
        starts = np.arange(width - length + 1)
        valid = (starts >= left[:, None]) & (starts + length <= (left + sizes)[:, None])
        single, many = table.column("single").to_numpy(), table.column("many").to_numpy()
        v1, v2 = table.column("v1").to_numpy(), table.column("v2").to_numpy()
        mine = again & valid & single[:, None]
        edge = np.diff(np.pad(mine, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (row, begin), (_, end) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        at = pos[row] - side + begin
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(x[row]) for x in (v1, v2)),
                *(pa.array(x.astype(np.int32)) for x in (at, pos[row] - side + end - 1 + length)),
                pa.array(anchor[row]),
                pa.nulls(len(row), pa.int64()),
                *(pa.nulls(len(row), pa.list_(k)) for k in (pa.int32(), pa.int64(), pa.bool_())),
            ],
            _ORDERED,
        )
        # A group that was dealt out: what is single here, and one of what isn't, is counted against the other parts.
        # Neighbouring strings go as one row under the bytes they share: only where these occur twice can a string.
        row, begin = np.nonzero(valid & first & many[:, None])
        if len(row):
            rolling = RollingHash(data)
            at = offsets[row] + begin - left[row]
            # The place within the context counts too: in a text with a period one string has several anchors.
            with np.errstate(over="ignore"):
                hashes = rolling.of(at, at + length) * np.uint64(31) + begin.astype(np.uint64)
                part = begin // NEIGHBOURS
                heads = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (part[1:] != part[:-1]))))
                mine, low = row[heads], part[heads] * NEIGHBOURS
                high = np.minimum(low + NEIGHBOURS, width - length + 1) - 1
                origin = offsets[mine] - left[mine]
                core = rolling.of(origin + high, origin + low + length) * np.uint64(31) + low.astype(np.uint64)
            cuts = pa.array(np.append(heads, len(row)).astype(np.int32))
            lists = (pos[row] - side + begin).astype(np.int32), hashes.view(np.int64), again[row, begin] | ~single[row]
            blank = pa.nulls(len(mine), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(x[mine]) for x in (v1, v2)),
                    blank,
                    blank,
                    pa.array(anchor[mine]),
                    pa.array(core.view(np.int64)),
                    *(pa.ListArray.from_arrays(cuts, pa.array(x)) for x in lists),
                ],
                _ORDERED,
            )

    return work


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each wanted context with its bytes."""
    names = ["v1", "v2", "anchor", "part", "many", "single", "pos", "lo"]
    for batch in pieces(batches, "text"):
        data, offsets = utf8(batch.column("text"))
        wanted = batch.column("wanted")
        rows = np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy())
        flat = wanted.flatten()
        lo, hi = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
        whole = data.tobytes()
        cut = [whole[a:b] for a, b in zip((offsets[rows] + lo).tolist(), (offsets[rows] + hi).tolist(), strict=True)]
        for at in range(0, len(cut), 4000):
            part = slice(at, at + 4000)
            columns = [batch.column(v).take(pa.array(rows[part])) for v in ("v1", "v2")]
            columns += [flat.field(n)[part] for n in names[2:]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cut[part], pa.binary())], [*names, "bytes"])


def repeated_spans(keyed: DataFrame, length: int) -> DataFrame:
    """v1, v2, start, end: bytes of the rows of ``keyed`` (v1, v2, text) that lie in a string that starts elsewhere too."""
    spread = F.xxhash64("v1", "pos")
    found = materialise(find_anchors(keyed, length), "anchors")
    contexts = found.groupBy("anchor", "context").agg(F.count("*").alias("n"))
    contexts = materialise(contexts, "contexts")
    kinds = contexts.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("n").alias("total")).where("total > 1")
    told = salted_join(contexts, kinds.drop("total"), ["anchor"], F.col("context"))
    placed = materialise(salted_join(found, told, ["anchor", "context"], spread), "repeated-anchors")
    # A context that occurs twice settles all its strings at once.
    spans = placed.where("n > 1").select("v1", "v2", F.col("lo").alias("start"), F.col("hi").alias("end"))
    mixed = placed.where("kinds > 1")
    chosen = (
        mixed.groupBy("anchor", "context", "n", "kinds")
        .agg(F.min(F.struct("v1", "v2", "pos", "lo", "hi")).alias("one"))
        .select("anchor", "n", "kinds", "one.*")
    )
    wanted = chosen.select(
        "v1",
        "v2",
        F.struct(
            "anchor",
            F.pmod(F.xxhash64("v1", "pos"), F.ceil(F.col("kinds") / TOGETHER)).cast("int").alias("part"),
            (F.col("kinds") > TOGETHER).alias("many"),
            (F.col("n") == 1).alias("single"),
            "pos",
            "lo",
            "hi",
        ).alias("one"),
    )
    wanted = wanted.groupBy("v1", "v2").agg(F.collect_list("one").alias("wanted"))
    once = keyed.select("v1", "v2", "text").join(wanted, ["v1", "v2"]).select("v1", "v2", "text", "wanted")
    cut = once.transform(
        map_batches,
        _cut_contexts,
        "v1 long, v2 long, anchor long, part int, many boolean, single boolean, pos int, lo int, bytes binary",
    )
    ordered = materialise(
        cut.repartition("anchor", "part")
        .sortWithinPartitions("anchor", "part")
        .transform(
            map_batches,
            _ordered(length), "v1 long, v2 long, start int, end int, anchor long, core long, places array<int>, strings array<long>,"
            " settled array<boolean>"
        ),
        "ordered",
    )
    open_ = ordered.where("core IS NOT NULL")
    cores = open_.groupBy("anchor", "core").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    open_ = salted_semi(open_, cores, ["anchor", "core"], F.col("v1"))
    open_ = open_.select("v1", "v2", "anchor", F.inline(F.arrays_zip("places", "strings", "settled")))
    open_ = open_.withColumnsRenamed({"places": "start", "strings": "string"}).withColumn("end", F.col("start") + length)
    twice = open_.groupBy("anchor", "string").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    across = salted_semi(open_.where("NOT settled"), twice, ["anchor", "string"], F.col("v1"))
    columns = ["v1", "v2", "start", "end"]
    return spans.unionByName(ordered.where("core IS NULL").select(columns)).unionByName(across.select(columns))


def drop_repeats(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts without every byte covered by a string of ``length`` bytes that also starts anywhere else.

    Columns: doc_id, n_bytes, n_removed, n_spans, kept (binary), spans (removed
    [start, end) offsets). Texts are UTF-8 bytes, null as none; strings lie within
    a row, and each row of ``docs`` is a document of its own, also if ids repeat or
    are null: of two equal rows both lose what they share. All is judged on the
    input. An empty table gives an empty table; other columns are not looked at.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("v1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("v2")
    )
    spans = repeated_spans(base.select("v1", "v2", "text"), length)
    listed = spans.groupBy("v1", "v2").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            whole, kept, removed, merged = data.tobytes(), [], [], []
            for row, found in enumerate(batch.column("spans").to_pylist()):
                begin, end = int(offsets[row]), int(offsets[row + 1])
                out: list[list[int]] = []
                for s in found or ():
                    if out and s["start"] <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], s["end"])
                    else:
                        out.append([s["start"], s["end"]])
                cuts = [0, *(x for s in out for x in s), end - begin]
                kept.append(b"".join(whole[begin + a : begin + b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
                removed.append(sum(b - a for a, b in out))
                merged.append(out)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(offsets)),
                    pa.array(removed, pa.int64()),
                    pa.array([len(m) for m in merged], pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                    pa.array(kept, pa.binary()),
                    pa.array(merged, pa.list_(pa.list_(pa.int64()))),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"],
            )

    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    return (
        base.join(listed, ["v1", "v2"], "left")
        .select("doc_id", "text", "spans")
        .transform(
            map_batches,
            work,
            f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary,"
            " spans array<array<long>>",
        )
    )
