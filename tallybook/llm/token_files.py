"""Token ids in binary shards: frequency ranks, byte-aligned, with separate control bytes.

Ids are replaced by their rank in the corpus, the most frequent first, so the commonest 256 take
one byte. Each block has a control stream, two bits per value giving its length in bytes, four
values to a control byte, and a data stream of little-endian values without their leading zero
bytes. Decoding looks the lengths up in a table, four per control byte, and gathers the data
with numpy.

Shards are parquet files of blocks (first document, ids before the block, document ids and
lengths, control, data), beside a table of the ids by rank. Both are written by Spark, so a lost
executor costs a repeated task and no half-written shard. Blocks and documents are in ascending
doc_id order.

Defined cases: a null text is the empty text; a document without text still has the end id. Rows
that repeat an id are separate documents, in the order of their ids' bytes. Rows without an id
come first. An empty table gives empty shards; other columns are ignored.
"""

from __future__ import annotations

import re
import string
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.spread import running_totals
from tallybook.llm.text import releasing, slices
from tallybook.session import materialize, scratch_path, small_batches

#: Ids in a block, at least; a document is never split.
BLOCK_IDS = 1 << 16
#: Parts that a worker remembers in each of two generations, and the longest one worth it.
MEMORY_PARTS = 250_000
MEMORY_LENGTH = 48
#: Text whose distinct parts are looked up at once, and new parts encoded as one text.
SLICE_BYTES = 4 << 20
NEW_PARTS = 2000

# Lengths of the four values of each control byte.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    length = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    code = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    code[: len(values)] = length - 1
    control = code[0::4] | code[1::4] << 2 | code[2::4] << 4 | code[3::4] << 6
    keep = np.arange(4) < length[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The `count` values packed in `control` and `data`."""
    length = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count].astype(np.int64)
    at = np.cumsum(length) - length
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    values = raw[at]
    for byte in (1, 2, 3):
        longer = np.flatnonzero(length > byte)
        values[longer] |= raw[at[longer] + byte] << np.uint32(8 * byte)
    return values


# By the two bytes before a place: whether white space ends there (or might, in a longer character), and whether a Latin letter does.
_AFTER_BLANK = np.zeros((256, 256), dtype=bool)
_AFTER_LETTER = np.zeros((256, 256), dtype=bool)
for _table, _characters in (
    (_AFTER_BLANK, [c for c in map(chr, range(0x3001)) if c.isspace()]),
    (_AFTER_LETTER, [c for c in map(chr, range(0x250)) if c.isalpha()]),
):
    for _c in _characters:
        *_, _before, _last = b"\0" + _c.encode()
        _table[_before if _last > 0x7F else slice(None), _last] = True
_AFTER_BLANK, _AFTER_LETTER = _AFTER_BLANK.ravel(), _AFTER_LETTER.ravel()

#: A part that can stand beside others: the space or line end that starts it is the only one in it.
_PLAIN = re.compile(r"[ \n]\S+")


class TextEncoder:
    """The tokenizers library behind a memory of parts.

    A byte-level pre-tokenizer starts anew at a space or line end that follows something other
    than white space, and at a punctuation mark (but the apostrophe) that follows a letter, so a
    text's ids are those of the parts between such places. New parts that start with a space or
    line end are encoded as one text: only the first id of each stands for bytes with one.
    """

    def __init__(self, path: str) -> None:
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
            raise ValueError("only plain byte-level tokenizers can be applied part by part")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
            raise ValueError("added tokens must not take in white space")
        # Added tokens must stay whole, so no cut is made before a mark that one of them has.
        added = "".join(t["content"] for t in spec["added_tokens"])
        self.kind = np.zeros(256, dtype=np.uint8)
        self.kind[[ord(c) for c in string.punctuation if c != "'" and c not in added]] = 2
        self.kind[[0x20, 0x0A]] = 1
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.begins = np.zeros(max(self.library.get_vocab().values()) + 1, dtype=bool)
        # The byte-level alphabet's letters for a space and a line end.
        self.begins[[i for token, i in vocabulary.items() if token.startswith(("\u0120", "\u010a"))]] = True
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        raw = [t.encode() for t in texts]
        offsets = np.cumsum([0, *map(len, raw)])
        ids, first = self.encode_bytes(np.frombuffer(b"".join(raw), np.uint8), offsets)
        return [ids[a:b].tobytes() for a, b in zip(first, first[1:])]

    def encode_bytes(self, buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in `buffer`, which start at `offsets`, and the number of ids before each text, with the total."""
        edges = self._edges(buffer, offsets)
        parts = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(buffer)).dictionary_encode()
        values = self._ids(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        held = np.frombuffer(b"".join(values), "<u4")
        length = np.fromiter(map(len, values), np.int64, len(values)) >> 2
        which = parts.indices.to_numpy()
        own = length[which]
        before = np.concatenate([[0], np.cumsum(own)])
        shift = (np.cumsum(length) - length)[which] - before[:-1]
        ids = held[np.arange(before[-1]) + np.repeat(shift, own)]
        return ids, before[np.searchsorted(edges, offsets)]

    def _edges(self, buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where parts start, and the end of the last one."""
        edge = np.zeros(len(buffer) + 1, dtype=bool)
        for begin in range(0, len(buffer), SLICE_BYTES):
            kind = self.kind[buffer[begin : begin + SLICE_BYTES]]
            inside = np.flatnonzero(kind)
            at = inside + begin
            before = buffer[np.maximum(at - 1, 0)].astype(np.uint16) | buffer[np.maximum(at - 2, 0)].astype(np.uint16) << 8
            edge[at] = np.where(kind[inside] == 1, ~_AFTER_BLANK[before], _AFTER_LETTER[before])
        edge[offsets] = True
        return np.flatnonzero(edge)

    def _ids(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts, remembered or new."""
        recent, older = self.recent, self.older
        values = list(map(recent.get, parts))
        together: list[int] = []
        apart: list[int] = []
        for i, value in enumerate(values):
            if value is None:
                part = parts[i]
                held = older.get(part)
                if held is not None:
                    recent[part] = values[i] = held
                elif len(part) <= MEMORY_LENGTH and part[0] in " \n" and (part[1:].isalnum() or _PLAIN.fullmatch(part)):
                    together.append(i)
                else:
                    apart.append(i)
        for new, encoded in ((together, self._together), (apart, self._apart)):
            for begin in range(0, len(new), NEW_PARTS):
                some = new[begin : begin + NEW_PARTS]
                for i, value in zip(some, encoded([parts[i] for i in some])):
                    values[i] = value
                    if len(parts[i]) <= MEMORY_LENGTH:
                        recent[parts[i]] = value
        if len(recent) > MEMORY_PARTS:
            self.older, self.recent = recent, {}
        return values

    def _apart(self, parts: list[str]) -> list[bytes]:
        return [np.array(made.ids, "<u4").tobytes() for made in self.library.encode_batch_fast(parts, add_special_tokens=False)]

    def _together(self, parts: list[str]) -> list[bytes]:
        (made,) = self.library.encode_batch_fast(["".join(parts)], add_special_tokens=False)
        ids = np.array(made.ids, "<u4")
        first = np.flatnonzero(self.begins[ids])
        if len(first) != len(parts) or first[0] != 0:  # a vocabulary that leaves bytes out
            return self._apart(parts)
        raw = ids.tobytes()
        places = [*(first * 4).tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(places, places[1:])]


_encoders: dict[str, TextEncoder] = {}


def text_encoder(path: str) -> TextEncoder:
    """This worker's encoder for the tokenizer file, which every machine has."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, n, ids: the ids of each text and the end id, as little-endian 32-bit integers."""
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own = text_encoder(tokenizer_path)
        for batch in batches:
            for rows, buffer, offsets in slices(batch, size=SLICE_BYTES):
                all_ids, first = own.encode_bytes(buffer, offsets)
                ids = [all_ids[a:b].tobytes() + end for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array([_narrow(i) for i in ids], pa.binary()),
                    ],
                    names=["doc_id", "n", "ids"],
                )

    return docs.mapInArrow(releasing(encoded), "doc_id bigint, n bigint, ids binary")


def _narrow(ids: bytes) -> bytes:
    """Ids for the staged table: 16 bits each where all of them fit, marked by the first byte."""
    wide = np.frombuffer(ids, "<u4")
    return b"\2" + wide.astype("<u2").tobytes() if wide.max(initial=0) < 1 << 16 else b"\4" + ids


def _wide(narrow: bytes) -> np.ndarray:
    return np.frombuffer(narrow, f"<u{narrow[0]}", offset=1).astype(np.uint32)


def _id_counts(batches):
    """id, n: occurrences of each id, counted per task."""
    counts = np.zeros(0, dtype=np.int64)
    for batch in batches:
        own = np.bincount(np.concatenate([_wide(ids) for ids in batch.column("ids").to_pylist()] or [counts[:0]]))
        if len(own) > len(counts):
            own[: len(counts)] += counts
            counts = own
        else:
            counts[: len(own)] += own
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["id", "n"])


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int, path: str) -> None:
    """Encode `docs` (doc_id, text) into shards under `path`.

    The staged ids are shuffled once, by ranges of doc_id; the text never is.
    """
    spark = small_batches(docs.sparkSession)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = materialize(tokenized(docs, tokenizer_path, end_id), "ids")
    counts = staged.mapInArrow(releasing(_id_counts), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    # Bounded by the vocabulary, which every worker holds anyway.
    by_rank = counts.orderBy(F.desc("n"), "id").toArrow().column("id").to_numpy()
    spark.createDataFrame(pa.table({"rank": np.arange(len(by_rank)), "id": by_rank})).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, dtype=np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)

    def blocks(batches):
        """Blocks of one shard; `local` counts the ids before a block in its shard."""
        held: list[tuple[int | None, np.ndarray]] = []
        waiting = done = 0
        for batch in batches:
            for shard, doc_id, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "ids"))):
                own = shared.value[_wide(ids)]
                held.append((doc_id, own))
                waiting += len(own)
                if waiting >= BLOCK_IDS:
                    yield _block(shard, done, held)
                    done, held, waiting = done + waiting, [], 0
        if held:
            yield _block(shard, done, held)

    ordered = (
        staged.repartitionByRange(partitions, F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
        .withColumn("shard", F.spark_partition_id())
    )
    shape = "shard int, local bigint, n bigint, doc_ids array<bigint>, lengths array<int>, control binary, data binary"
    ordered.mapInArrow(releasing(blocks), shape).write.parquet(f"{path}/blocks")
    # Ids before each shard: one sum per shard.
    sums = spark.read.schema(shape).parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n").alias("n"))
    starts = running_totals(sums, [], [F.col("shard")], F.col("n"), 1).select("shard", F.col("before").alias("start"))
    starts.write.parquet(f"{path}/starts")


def _block(shard: int, local: int, held: list[tuple[int | None, np.ndarray]]) -> pa.RecordBatch:
    values = np.concatenate([v for _, v in held])
    control, data = pack(values)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard], pa.int32()),
            pa.array([local], pa.int64()),
            pa.array([len(values)], pa.int64()),
            pa.array([[d for d, _ in held]], pa.list_(pa.int64())),
            pa.array([[len(v) for _, v in held]], pa.list_(pa.int32())),
            pa.array([control], pa.binary()),
            pa.array([data], pa.binary()),
        ],
        names=["shard", "local", "n", "doc_ids", "lengths", "control", "data"],
    )


def read_shards(spark, path: str, digests: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and the ids of each document (or their crc32 only)."""
    by_rank = spark.read.parquet(f"{path}/ranks").orderBy("rank").toArrow().column("id").to_numpy().astype(np.uint32)
    shared = spark.sparkContext.broadcast(by_rank)
    shape = "doc_id bigint, start bigint, n_tokens bigint, " + ("ids_crc32 bigint" if digests else "ids array<bigint>")

    def decoded(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = shared.value[unpack(row["control"], row["data"], row["n"])]
                ends = np.cumsum(np.array(row["lengths"], dtype=np.int64))
                begins = ends - np.array(row["lengths"], dtype=np.int64)
                own = [ids[a:b] for a, b in zip(begins, ends)]
                if digests:
                    made = pa.array([zlib.crc32(v.astype("<u4").tobytes()) for v in own], pa.int64())
                else:
                    made = pa.array([v.astype(np.int64) for v in own], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["start"] + row["local"] + begins, pa.int64()),
                        pa.array(row["lengths"], pa.int64()),
                        made,
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32" if digests else "ids"],
                )

    blocks = spark.read.parquet(f"{path}/blocks")
    starts = spark.read.parquet(f"{path}/starts")
    return blocks.join(F.broadcast(starts), "shard").select("local", "start", "n", "doc_ids", "lengths", "control", "data").mapInArrow(
        releasing(decoded), shape
    )


def new_shard_folder(spark) -> str:
    return scratch_path(spark, "shards")
