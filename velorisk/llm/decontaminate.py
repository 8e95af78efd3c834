"""Benchmark decontamination: word windows of test items found in documents by one pass of an automaton."""

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velorisk.llm.common import byte_class, map_batches, pieces, runs, utf8

#: Bytes that end a word once A-Z are lower-cased: all of ASCII but digits and letters.
_BREAKS = bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
_FOLD = bytes(0x20 if b in set(_BREAKS) - set(range(0x41, 0x5B)) else b + 32 if 0x41 <= b < 0x5B else b for b in range(256))
_WORD = byte_class(b" ", inverse=True)
#: Most bytes of windows in one automaton; a larger benchmark is searched in several passes.
AUTOMATON_BYTES = 32 << 20

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("n_hit", T.LongType(), False),
        T.StructField("items", T.ArrayType(T.LongType(), False), False),
        T.StructField("words_hit", T.ArrayType(T.LongType(), False), False),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType(), False), False), False),
    ]
)


def folded(text: bytes) -> bytes:
    """Same length: words in lower case, everything between them as blanks."""
    return text.translate(_FOLD)


def windows(text: str | None, n: int) -> set[str]:
    """Windows of ``n`` words of an item, each within blanks; all its words if they are fewer."""
    words = folded((text or "").encode()).decode("latin-1").split(" ")
    words = [w for w in words if w]
    if not words:
        return set()
    return {" " + " ".join(words[i : i + n]) + " " for i in range(max(1, len(words) - n + 1))}


def blocks_of(items: list[tuple[int | None, str | None]], n: int, most: int) -> list[dict[str, list[int]]]:
    """Windows with the ids of their items, in blocks of about ``most`` bytes."""
    out, size = [{}], 0
    for item, text in items:
        for window in windows(text, n):
            if size > most:
                out.append({})
                size = 0
            owners = out[-1].setdefault(window, [])
            size += len(window) if not owners else 0
            if item is not None and item not in owners:
                owners.append(item)
    return out


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    n: int = 10,
    text: str = "text",
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Every row of ``docs`` as struct ``row``, and struct ``hits``: which of its words lie in a window of an item.

    ``hits.n_words`` counts the words, ``n_hit`` those inside at least one
    occurrence of a window, ``items`` the sorted ids of items found, ``words_hit``
    the word numbers, ``spans`` the hit stretches as [start, end) byte offsets
    into the UTF-8 of the untouched text. A null text has no words. Items without
    words have no window; an item without id hits words but isn't listed; equal
    items are all listed. Without items nothing is hit. Rows may repeat, and other
    columns pass through inside ``row`` under any name.

    All windows of the benchmark form one Aho-Corasick automaton, which goes to
    the tasks and reads each text once. The benchmark is the small side by its
    nature; its windows are bounded by ``automaton_bytes`` per automaton, and
    beyond that each batch is read once per block of them.
    """
    spark = docs.sparkSession
    listed = items.select(F.col("item_id").cast("long"), F.col("text")).toLocalIterator()
    sent = [spark.sparkContext.broadcast(b) for b in blocks_of([tuple(r) for r in listed], n, automaton_bytes)]
    schema = T.StructType([T.StructField("row", docs.schema, False), T.StructField("hits", HITS, False)])
    arrow_hits = pa.struct(
        [
            ("n_words", pa.int64()),
            ("n_hit", pa.int64()),
            ("items", pa.list_(pa.int64())),
            ("words_hit", pa.list_(pa.int64())),
            ("spans", pa.list_(pa.list_(pa.int64()))),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = automaton(sent[0].value) if len(sent) == 1 else None
        for batch in pieces(batches, "text"):
            found: dict[int, list[tuple[int, int, list[int]]]] = {}
            data, offsets = utf8(batch.column("text"))
            flat = np.frombuffer(folded(data.tobytes()), np.uint8)
            starts, ends, rows = runs(flat, offsets, _WORD)
            firsts = np.searchsorted(rows, np.arange(len(offsets)))
            packed = flat.tobytes()
            cuts = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            texts = [(b" " + b" ".join(packed[a:b].split()) + b" ").decode("latin-1") for a, b in cuts]
            for block in sent:
                search = ready or automaton(block.value)
                if len(search):
                    for i, t in enumerate(texts):
                        for end, (size, words, owners) in search.iter(t):
                            found.setdefault(i, []).append((end - size + 1, words, owners))
            out = []
            for i in range(batch.num_rows):
                count = int(firsts[i + 1] - firsts[i])
                if i not in found:
                    out.append({"n_words": count, "n_hit": 0, "items": [], "words_hit": [], "spans": []})
                    continue
                blanks = np.flatnonzero(np.frombuffer(texts[i].encode("latin-1"), np.uint8) == 32)
                hit, owned = np.zeros(count + 1, np.int64), set()
                for start, words, owners in found[i]:
                    first = int(np.searchsorted(blanks, start))
                    hit[first] += 1
                    hit[first + words] -= 1
                    owned.update(owners)
                numbers = np.flatnonzero(np.cumsum(hit)[:count] > 0)
                parts = np.split(numbers, np.flatnonzero(np.diff(numbers) > 1) + 1)
                at = firsts[i]
                spans = [[int(starts[at + p[0]] - offsets[i]), int(ends[at + p[-1]] - offsets[i])] for p in parts]
                out.append(
                    {
                        "n_words": count,
                        "n_hit": len(numbers),
                        "items": sorted(owned),
                        "words_hit": numbers.tolist(),
                        "spans": spans,
                    }
                )
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, arrow_hits)], ["row", "hits"])

    return docs.select(F.struct("*").alias("row"), F.col(text).alias("text")).transform(map_batches, scan, schema)


def automaton(owners: dict[str, list[int]]) -> ahocorasick.Automaton:
    """Windows with their length, number of words and owners."""
    search = ahocorasick.Automaton()
    for window, items in owners.items():
        search.add_word(window, (len(window), window.count(" ") - 1, items))
    if len(search):
        search.make_automaton()
    return search
