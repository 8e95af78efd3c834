"""Token ids in training order: sequences of one length, placed by a keyed permutation, in shards of fixed stride."""

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velorisk.llm.common import map_batches, materialise, mixed, pieces
from velorisk.llm.warc import located

#: A byte-level vocabulary as ranks, read by the driver, and the pattern that cuts words for it (a fixed value).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROUNDS = 6


@dataclass(frozen=True)
class Layout:
    """Tokens in a sequence, bytes in a shard at most (about), and the key of the order."""

    length: int = 2048
    shard_bytes: int = 32 << 20
    key: int = 20240607


def feistel(index: np.ndarray, size: int, key: int, inverse: bool = False) -> np.ndarray:
    """A permutation of 0 .. size-1: a Feistel network over the next even power of two, walked until it falls inside."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = np.array(index, np.uint64)
    todo = np.arange(len(out))
    order = range(ROUNDS)
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for r in reversed(order) if inverse else order:
            if inverse:
                left, right = right ^ (mixed(left, key + r) & mask), left
            else:
                left, right = right, left ^ (mixed(right, key + r) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def vocabulary(path: str) -> dict[bytes, int]:
    system, place = located(path)
    with system.open_input_stream(place) as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file.read().splitlines() if line)}


def token_type(ranks: dict[bytes, int]) -> np.dtype:
    """Narrowest type for the ids and the end mark, which follows them."""
    return np.dtype("<u2" if max(ranks.values()) + 1 < 1 << 16 else "<u4")


def sequences(docs: DataFrame, ranks: dict[bytes, int], layout: Layout, text: str = "text") -> tuple[DataFrame, int]:
    """Sequences (slot, seq, n_tokens, doc_ids, tokens) of a stored table, and the size of the numbering.

    A partition's documents, an end mark after each, form one stream that is cut
    into sequences; only its last one is filled up with end marks. Numbers come
    from a first pass over the sizes of texts: a byte-level token has one byte at
    least, so a partition's bytes bound its sequences. Bounds are summed over
    partitions on the driver (one number each), and a task checks that it got the
    rows that its bound was computed for.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    sizes = rows.groupBy(F.spark_partition_id().alias("part")).agg(
        F.count("*").alias("rows"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("bytes")
    )
    bounds, size = {}, 0
    for r in sorted(sizes.collect()):
        bounds[r.part] = (size, r.rows, r.bytes)
        size += -(-r.bytes // layout.length)
    sent = spark.sparkContext.broadcast((bounds, ranks))
    kind, length, key = token_type(ranks), layout.length, layout.key

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ranks = sent.value
        coder = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        end = max(ranks.values()) + 1
        base, rows, size_of_texts = known.get(TaskContext.get().partitionId(), (0, 0, 0))
        number, seen, held, owners = base, [0, 0], np.zeros(0, kind), np.zeros(0, np.int64)
        numbers: list[int | None] = []  # ids of the documents whose ordinals ``owners`` holds

        def cut(upto: int) -> pa.RecordBatch:
            nonlocal number, held, owners
            count = -(-upto // length)
            out = np.full(count * length, end, kind)
            out[:upto] = held[:upto]
            index = np.arange(number, number + count)
            lengths = [min(length, upto - k * length) for k in range(count)]
            ids = []
            for k in range(count):
                mine = owners[k * length : k * length + lengths[k]]
                ids.append([numbers[o] for o in mine[np.flatnonzero(np.diff(mine, prepend=-1))]])
            number, held, owners = number + count, held[upto:], owners[upto:]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(feistel(index, size, key)),
                    pa.array(index),
                    pa.array(lengths, pa.int64()),
                    pa.array(ids, pa.list_(pa.int64())),
                    pa.array([row.tobytes() for row in out.reshape(count, length)], pa.binary()),
                ],
                ["slot", "seq", "n_tokens", "doc_ids", "tokens"],
            )

        for batch in pieces(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [np.array([*coder.encode_ordinary(t), end], kind) for t in texts]
            seen[0] += len(texts)
            seen[1] += sum(len(t.encode()) + 1 for t in texts)
            first = len(numbers)
            numbers += batch.column("doc_id").to_pylist()
            held = np.concatenate([held, *found])
            owners = np.concatenate([owners, np.repeat(np.arange(first, len(numbers)), [len(f) for f in found])])
            if len(held) >= length:
                yield cut(len(held) // length * length)
        if len(held):
            yield cut(len(held))
        if seen != [rows, size_of_texts]:
            raise RuntimeError(f"a partition changed between two passes: {seen} now, {rows} rows and {size_of_texts} bytes before")

    schema = "slot long, seq long, n_tokens long, doc_ids array<long>, tokens binary"
    return rows.transform(map_batches, work, schema), size


def write_shards(
    docs: DataFrame, path: str, layout: Layout = Layout(), vocabulary_path: str = VOCABULARY, text: str = "text"  # noqa: B008
) -> DataFrame:
    """Writes the shards below ``path`` and gives one row per sequence.

    Columns: slot (place in training order, 0 .. n-1), shard, byte_offset, seq,
    n_tokens (without filling), doc_ids (documents in the sequence, in order),
    tokens_sha256. The permutation places the numbers 0 .. size-1, of which some
    have no sequence; sequences go to their shard by range of that place, once,
    and close up there, so that slots have no gaps: slot = sequences in earlier
    shards + row in the shard. ``docs`` must be a stored table. A null or empty
    text is an end mark alone, a null id a null in ``doc_ids``; repeated rows are
    written as often. An empty table gives no rows. Other columns are not looked at.

    A shard is written under its own name by one task from its sorted range; a
    repeated attempt writes the same bytes.
    """
    ranks = vocabulary(vocabulary_path)
    stride = layout.length * token_type(ranks).itemsize
    placed, size = sequences(docs, ranks, layout, text)
    # At most: only a part of the numbers has a sequence.
    shards = max(1, -(-size * stride // layout.shard_bytes))
    shard = F.least(F.floor(F.col("slot") * shards / max(1, size)), F.lit(shards - 1)).cast("int")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = located(path)
        system.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        name, out, at = None, None, 0
        for batch in batches:
            rows, number = [], batch.column("shard").to_pylist()
            for k, tokens in enumerate(batch.column("tokens").to_pylist()):
                if out is None:
                    name = f"shard-{number[k]:06d}.bin"
                    out = system.open_output_stream(f"{root}/_{attempt}-{name}")
                out.write(tokens)
                rows.append((at, hashlib.sha256(tokens).hexdigest()))
                at += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("shard"),
                    pa.array([r[0] for r in rows], pa.int64()),
                    *(batch.column(c) for c in ("seq", "n_tokens", "doc_ids")),
                    pa.array([r[1] for r in rows], pa.string()),
                ],
                ["shard", "row", "seq", "n_tokens", "doc_ids", "tokens_sha256"],
            )
        if out is not None:
            out.close()
            system.move(f"{root}/_{attempt}-{name}", f"{root}/{name}")

    ordered = placed.withColumn("shard", shard).repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")
    index = materialise(
        ordered.transform(
            map_batches,
            write, "shard int, row long, seq long, n_tokens long, doc_ids array<long>, tokens_sha256 string"
        ),
        "sequence-index",
    )
    counts = {r.shard: r["count"] for r in index.groupBy("shard").count().collect()}
    firsts, total = [], 0
    for k in sorted(counts):
        firsts.append((k, total, counts[k], f"shard-{k:06d}.bin", stride))
        total += counts[k]
    spark = docs.sparkSession
    manifest = spark.createDataFrame(firsts, "shard int, first_slot long, sequences long, file string, stride int")
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return index.join(F.broadcast(manifest), "shard").select(
        (F.col("first_slot") + F.col("row")).alias("slot"),
        "shard",
        (F.col("row") * stride).alias("byte_offset"),
        "seq",
        "n_tokens",
        "doc_ids",
        "tokens_sha256",
    )


def read_slots(spark: SparkSession, path: str, first: int, count: int, kind: str = "<u2") -> Iterator[np.ndarray]:
    """Sequences of slots first .. first+count-1: where a training run goes on, without reading what lies before."""
    system, root = located(path)
    for s in sorted(spark.read.json(f"{path}/manifest").collect(), key=lambda s: s.first_slot):
        begin, end = max(first, s.first_slot), min(first + count, s.first_slot + s.sequences)
        if begin < end:
            with system.open_input_file(f"{root}/{s.file}") as file:
                file.seek((begin - s.first_slot) * s.stride)
                for _ in range(begin, end):
                    yield np.frombuffer(file.read(s.stride), kind)
