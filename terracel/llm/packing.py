"""Best-fit packing of documents into token sequences, after a Martello-Toth dominance reduction."""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, running_sum, slices_for, stage
from .registry import query

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: Beyond these letters two libraries may follow different editions of Unicode.
WIDE = re.compile("[^\x00-\u024f]")


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if it shows, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def fast_encoding(path: str):
    """A rank encoder with the vocabulary of the tokenizer file at ``path``, or None if it is not plain byte-level BPE."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    vocab = model.get("vocab", {})
    plain = (
        model.get("type", "BPE") == "BPE" and not spec.get("normalizer") and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        and not split.get("add_prefix_space") and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        and [vocab.get("".join(m)) for m in merges] == list(range(256, 256 + len(merges)))
    )
    if not plain:
        return None
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    byte = byte_characters()
    ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in special}
    return tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


class Encoder:
    """Token ids of texts as the tokenizer file at ``path`` gives them, little-endian and 32 bits wide.

    Texts of Latin letters take the rank encoder, which gives the same ids in half the time; those that it
    gives up, as runs of a million blanks or letters, take the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.fast = Tokenizer.from_file(path), fast_encoding(path)

    def encode(self, text: str) -> bytes:
        if self.fast is not None and not WIDE.search(text):
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
            except ValueError:  # its pattern search has a bounded stack
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, end = Encoder(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                out: dict[str, list] = {"row": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
                for row, text in enumerate(texts):
                    raw = encoder.encode(text) + end
                    n = len(raw) // 4
                    n_pieces = -(-n // capacity)
                    start = 0
                    for k in range(n_pieces):
                        size = n - (n_pieces - 1) * capacity if k == 0 else capacity
                        ids = raw[4 * start : 4 * (start + size)]
                        for name, v in zip(out, (row, k, start, size, zlib.crc32(ids), ids if with_ids else None), strict=True):
                            out[name].append(v)
                        start += size
                at = pa.array(out["row"], pa.int64())
                arrays = [part.column(0).take(at), pa.array(out["piece"], pa.int32())]
                arrays += [pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32")] + [pa.array(out["ids"], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return run


def cut_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32, ids (null unless ``with_ids``).

    Ids of the whole text, then ``end_id``.  Only longer ones are cut: all pieces but the first are full.  Null and empty
    texts are ``end_id`` alone; repeated rows, null ids and ids of any type keep their pieces; a very long text is
    encoded whole, in one row of one task; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _cut(tokenizer_path, capacity, end_id, with_ids),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary",
    )


class Counts:
    """Number of items of each length, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {k: v for k, v in counts.items() if v}
        self.lengths = sorted(self.n)

    def take(self, length: int, times: int) -> None:
        self.n[length] -= times
        if not self.n[length]:
            del self.n[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def largest_up_to(self, room: int, besides: int) -> int | None:
        """The largest length of at most ``room``, one item of ``besides`` being used already."""
        k = bisect_right(self.lengths, room) - 1
        while k >= 0 and self.lengths[k] == besides and self.n[besides] < 2:
            k -= 1
        return self.lengths[k] if k >= 0 else None

    def smallest(self, many: int, besides: int) -> list[int]:
        """The ``many`` smallest items, one item of ``besides`` being used already."""
        found: list[int] = []
        for x in self.lengths:
            found += [x] * min(self.n[x] - (x == besides), many - len(found))
            if len(found) == many:
                break
        return found


def best_pair(counts: Counts, room: int, besides: int) -> int:
    """Largest sum of two items within ``room``; 0 if no two fit."""
    best = 0
    for x in counts.lengths:
        if 2 * x > room:
            break
        have = counts.n[x] - (x == besides)
        if have < 1:
            continue
        k = bisect_right(counts.lengths, room - x) - 1
        while k >= 0 and counts.lengths[k] >= x:
            y = counts.lengths[k]
            if (counts.n[y] - (y == besides)) >= (2 if x == y else 1):
                best = max(best, x + y)
                break
            k -= 1
    return best


def reduce_by_dominance(counts: Counts, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix sets that dominate every other set with the same item, until none is left to fix.

    A set dominates another if the items of the other can be dealt out to places of items of the first.
    For an item j and the largest item k that fits beside it: {j} if nothing fits; {j, k} if they
    fill the sequence, if no two others fit beside j, or if k is at least as long as any two that
    fit and no three fit.  Whole classes of equal lengths are fixed at once.
    """
    fixed: list[tuple[tuple[int, ...], int]] = []
    changed = True
    while changed:
        changed = False
        for j in sorted(counts.lengths, reverse=True):
            while j in counts.n:
                room = capacity - j
                k = counts.largest_up_to(room, j)
                if k is None:
                    times, chosen = counts.n[j], (j,)  # nothing fits beside it, not even another of its own
                else:
                    low = counts.smallest(3, j)
                    two = len(low) >= 2 and sum(low[:2]) <= room
                    three = len(low) == 3 and sum(low) <= room
                    good = k == room or not two or (not three and k >= best_pair(counts, room, j))
                    times = 0 if not good else counts.n[j] // 2 if j == k else min(counts.n[j], counts.n[k])
                    # taking items away leaves these tests true, so the class is fixed at once
                    chosen = (max(j, k), min(j, k))
                if not times:
                    break
                for x in chosen:
                    counts.take(x, times)
                fixed.append((chosen, times))
                changed = True
    return fixed


def best_fit(counts: Counts, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over classes of equal lengths: each item goes where the least room stays."""
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: tuple[int, ...], times: int) -> None:
        if room not in open_by_room:
            insort(rooms, room)
        open_by_room.setdefault(room, []).append((pattern, times))

    for length in sorted(counts.lengths, reverse=True):
        left = counts.n[length]
        while left:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                each = min(capacity // length, left)
                times = left // each
                put(capacity - each * length, (length,) * each, times)
                left -= each * times
                continue
            room = rooms[k]
            pattern, times = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(k)
            each = min(room // length, left)
            used = min(times, left // each)
            if used < times:
                put(room, pattern, times - used)
            put(room - each * length, pattern + (length,) * each, used)
            left -= each * used
    return [x for found in open_by_room.values() for x in found]


def plan_sequences(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(pattern of lengths, number of sequences) for so many pieces of each length."""
    counts = Counts(lengths)
    fixed = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(counts, capacity)


def slot_rows(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, offset, items a sequence): places for ranks of equal pieces.

    There are at most as many rows as patterns times different lengths in one, both bounded by the capacity.
    """
    rows, used, base = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            each = pattern.count(length)
            lo = used.get(length, 0)
            rows.append((length, lo, lo + each * times, base, offset, each))
            used[length] = lo + each * times
            offset += each * length
        base += times
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to staged ``pieces`` (doc_id, piece, length, ...).

    Only the number of pieces of each length, at most ``capacity`` numbers, reaches the driver.  The plan made
    from it says which ranks of a length lie in which sequences; ranks are made by sliced running sums, so one
    length may hold most pieces.  The table of places is bounded by the capacity and broadcast.
    """
    spark = pieces.sparkSession
    found = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    lengths = {r["length"]: r["n"] for r in found}
    slots = spark.createDataFrame(
        slot_rows(plan_sequences(lengths, capacity)) or [(0, 0, 0, 0, 0, 1)],
        "length long, lo long, hi long, base long, at long, each long",
    )
    n_slices = slices_for(sum(lengths.values()))
    ranked = pieces.withColumn("one", F.lit(1)).withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n_slices)))
    ranked = running_sum(ranked, ["length"], "slice", ["doc_id", "piece", "ids_crc32"], "one", "rank")
    inside = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    placed = ranked.join(F.broadcast(slots), "length").filter(inside).withColumn("nth", F.col("rank") - F.col("lo"))
    return placed.withColumn("sequence_id", F.col("base") + F.floor(F.col("nth") / F.col("each"))).withColumn(
        "offset", F.col("at") + F.col("nth") % F.col("each") * F.col("length")
    ).drop("one", "slice", "rank", "lo", "hi", "base", "at", "each", "nth")


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Pack all ``docs`` (doc_id, text): one row per piece with its sequence and place.

    Null text is empty and gives the end id alone; repeated rows and ids are packed as separate documents;
    an empty table gives no rows; other columns are ignored.  ``tokenizer`` is a path, the public one by default.
    """
    pieces = cut_documents(docs, tokenizer or public_tokenizers.path(TOKENIZER), capacity, end_id, with_ids)
    pieces = stage(pieces if with_ids else pieces.drop("ids"), "pieces")
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Token ids of each sequence as one binary of 32-bit ids, from ``pack_documents(..., with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Best-fit packing of all documents."""
    return pack_documents(read_table(spark, folder, "documents"))
