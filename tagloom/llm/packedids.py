"""Token ids in binary shards of patched frame-of-reference blocks, written and read as a Spark data source.

Layout of a shard (little-endian; ``block`` values a block, the last one padded with its last value):

- blocks on end: minimum u32, width u8, exceptions u16, then the packed differences (``width`` bits each, lowest bit first), the
  positions of the exceptions (u16) and their differences (u32). The width is the bit length that a share ``percentile`` of a
  block's differences does not exceed; longer differences are exceptions, and their packed slot is 0.
- index: the start of every block and the end of the last one (u64).
- documents: ids (i64), whether an id is null (u8), ends in tokens (u64).
- footer: tokens, documents, blocks, start of the index (u64), block (u64), ``MAGIC``.

``write`` deals the documents out by ranges of their ids, so every task writes a run of the order; no task or driver sees more
than that. A shard holds at most ``SHARD_TOKENS`` ids, unless one document is longer. Tasks write under names of their own
and the driver's commit lists the shards of the tasks that count in ``manifest.json`` (a name, three numbers and a size each), so files
of lost or repeated tasks are never read. ``pyarrow.fs`` opens the files: a shared folder, HDFS or an object store it knows.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tagloom.llm import arrays
from tagloom.llm.common import fresh

MAGIC = b"tagpfor1"
FOOTER = struct.Struct("<5Q8s")
BLOCK = 128
PERCENTILE = 0.9
SHARD_TOKENS = 1 << 26
READ_TOKENS = 1 << 20  # ids unpacked at once by a reader
ENCODE_BYTES = 1 << 20  # a slice takes about forty times as much for its pieces and places
HEAD = 7  # bytes before the packed differences of a block


# --- blocks ---------------------------------------------------------------------------------

def bit_length(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def pack(rows: np.ndarray, width: int) -> np.ndarray:
    """Each row of numbers below 2^width as bytes, ``width`` bits a number."""
    columns = np.ascontiguousarray(rows.T).astype(np.uint64)
    words = np.zeros(((len(columns) * width + 63) // 64 + 1, len(rows)), np.uint64)
    for j, column in enumerate(columns):
        word, shift = divmod(j * width, 64)
        words[word] |= column << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= column >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").view(np.uint8).reshape(len(rows), -1)[:, : (len(columns) * width + 7) // 8]


def unpack(raw: np.ndarray, width: int, size: int) -> np.ndarray:
    """The inverse of ``pack``: rows of ``size`` numbers."""
    padded = np.zeros((len(raw), (size * width + 63) // 64 * 8 + 8), np.uint8)
    padded[:, : raw.shape[1]] = raw
    words = np.ascontiguousarray(padded.view("<u8").T)
    out = np.empty((size, len(raw)), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(size):
        word, shift = divmod(j * width, 64)
        x = words[word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (words[word + 1] << np.uint64(64 - shift))
        out[j] = x & mask
    return out.T


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of whole blocks of unsigned 32-bit ids, and the size of each block."""
    rows = ids.astype(np.uint32).reshape(-1, block)
    if not len(rows):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    bits = bit_length(rest)
    at = min(block, max(1, int(np.ceil(percentile * block)))) - 1
    width = np.partition(bits, at, axis=1)[:, at]
    odd = bits > width[:, None]
    many = odd.sum(axis=1)
    packed = (block * width.astype(np.int64) + 7) // 8
    sizes = HEAD + packed + 6 * many
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    head = np.zeros((len(rows), HEAD), np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    head[:, 4] = width
    head[:, 5:] = many.astype("<u2").view(np.uint8).reshape(-1, 2)
    out[starts[:, None] + np.arange(HEAD)] = head
    plain = np.where(odd, np.uint32(0), rest)
    for w in np.unique(width):
        if w:
            these = np.flatnonzero(width == w)
            raw = pack(plain[these], int(w))
            out[(starts[these] + HEAD)[:, None] + np.arange(raw.shape[1])] = raw
    row, place = np.nonzero(odd)
    if len(row):
        rank = np.arange(len(row)) - (np.cumsum(many) - many)[row]
        after = (starts + HEAD + packed)[row]
        out[(after + 2 * rank)[:, None] + np.arange(2)] = place.astype("<u2").view(np.uint8).reshape(-1, 2)
        out[(after + 2 * many[row] + 4 * rank)[:, None] + np.arange(4)] = rest[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out, sizes


def decode_blocks(raw: np.ndarray, starts: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` in ``raw``."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    head = raw[starts[:, None] + np.arange(HEAD)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4").ravel()
    width = head[:, 4].astype(np.int64)
    many = np.ascontiguousarray(head[:, 5:]).view("<u2").ravel().astype(np.int64)
    packed = (block * width + 7) // 8
    out = np.zeros((len(starts), block), np.uint32)
    for w in np.unique(width):
        if w:
            these = np.flatnonzero(width == w)
            out[these] = unpack(raw[(starts[these] + HEAD)[:, None] + np.arange(packed[these[0]])], int(w), block)
    row = np.repeat(np.arange(len(starts)), many)
    if len(row):
        rank = np.arange(len(row)) - (np.cumsum(many) - many)[row]
        after = (starts + HEAD + packed)[row]
        place = np.ascontiguousarray(raw[(after + 2 * rank)[:, None] + np.arange(2)]).view("<u2").ravel()
        out[row, place] = np.ascontiguousarray(raw[(after + 2 * many[row] + 4 * rank)[:, None] + np.arange(4)]).view("<u4").ravel()
    return (out + low[:, None]).ravel()


# --- shards ---------------------------------------------------------------------------------

def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class ShardWriter:
    """One shard: ids go out block by block; sizes of blocks and ends of documents stay until the end."""

    def __init__(self, path: str, percentile: float, block: int):
        store, place = opened(path)
        self.path, self.percentile, self.block = path, percentile, block
        self.out = store.open_output_stream(place)
        self.rest, self.sizes, self.docs, self.nulls, self.ends = np.zeros(0, np.uint32), [], [], [], []
        self.tokens = 0

    def add(self, docs: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.docs.append(docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        self.nulls.append(docs.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
        self.ends.append(self.tokens + np.cumsum(counts))
        self.tokens += len(ids)
        self.rest = np.concatenate([self.rest, ids])
        whole = len(self.rest) // self.block * self.block
        self.flush(self.rest[:whole])
        self.rest = self.rest[whole:]

    def flush(self, ids: np.ndarray) -> None:
        step = max(READ_TOKENS // self.block, 1) * self.block
        for at in range(0, len(ids), step):
            raw, sizes = encode_blocks(ids[at : at + step], self.percentile, self.block)
            self.out.write(raw.tobytes())
            self.sizes.append(sizes)

    def close(self) -> dict:
        if len(self.rest):
            self.flush(np.concatenate([self.rest, np.repeat(self.rest[-1:], self.block - len(self.rest))]))
        sizes = np.concatenate([np.zeros(0, np.int64), *self.sizes])
        index = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
        docs, nulls = np.concatenate(self.docs), np.concatenate(self.nulls)
        for part in (index, docs, nulls, np.concatenate(self.ends).astype("<u8")):
            self.out.write(part.tobytes())
        self.out.write(FOOTER.pack(self.tokens, len(docs), len(sizes), int(index[-1]), self.block, MAGIC))
        size = self.out.tell()
        self.out.close()
        return {"file": os.path.basename(self.path), "docs": len(docs), "tokens": self.tokens, "bytes": size}


class ShardReader:
    """Reads parts of a shard through its block index."""

    def __init__(self, path: str):
        store, place = opened(path)
        self.file = store.open_input_file(place)
        size = self.file.size()
        if size < FOOTER.size:
            raise ValueError(f"{path} is no shard")
        self.tokens, docs, blocks, at, self.block, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no shard of this format")
        rest = self.file.read_at(size - FOOTER.size - at, at)
        self.index, rest = np.frombuffer(rest, "<u8", blocks + 1).astype(np.int64), rest[8 * (blocks + 1) :]
        self.docs, rest = np.frombuffer(rest, "<i8", docs), rest[8 * docs :]
        self.nulls, rest = np.frombuffer(rest, np.uint8, docs).astype(bool), rest[docs:]
        self.ends = np.frombuffer(rest, "<u8", docs).astype(np.int64)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from token ``start`` to before ``end``; only the blocks that hold them are read."""
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block + 1
        base = self.index[first]
        raw = np.frombuffer(self.file.read_at(int(self.index[last] - base), int(base)), np.uint8)
        done = decode_blocks(raw, self.index[first:last] - base, self.block)
        return done[start - first * self.block : end - first * self.block]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Runs of documents of about READ_TOKENS ids: first and last document, and their ids on end."""
        at = 0
        while at < len(self.ends):
            done = self.ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(self.ends, done + READ_TOKENS, "right")))
            yield at, to, self.ids(int(done), int(self.ends[to - 1]))
            at = to


# --- data source ----------------------------------------------------------------------------

@dataclass
class Shards(WriterCommitMessage):
    task: int
    shards: list[dict]


class PackedWriter(DataSourceArrowWriter):
    """Writes (doc_id, ids) in the order of the partitions."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.percentile = float(options.get("percentile", PERCENTILE))
        self.block = int(options.get("block", BLOCK))
        self.limit = int(options.get("shardtokens", SHARD_TOKENS))
        if not 0 < self.percentile <= 1 or not 8 <= self.block <= 1 << 16 or self.block % 8:
            raise ValueError("percentile must be in (0, 1], block a multiple of 8 up to 65536")
        store, place = opened(self.path)
        store.create_dir(place, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shards:
        shards, shard = [], None
        for batch in iterator:
            docs, lists = batch.column(0), batch.column(1)
            counts = np.diff(np.asarray(lists.offsets)).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint32)
            ends = np.cumsum(counts)
            at = 0
            while at < len(docs):
                if shard is None:
                    shard = ShardWriter(f"{self.path}/{uuid.uuid4().hex}.pfor", self.percentile, self.block)
                done = ends[at - 1] if at else 0
                # Packed in parts of READ_TOKENS ids, whatever the size of the batch.
                to = max(at + 1, int(np.searchsorted(ends, done + min(self.limit - shard.tokens, READ_TOKENS), "right")))
                shard.add(docs.slice(at, to - at), ids[done : ends[to - 1]], counts[at:to])
                at = to
                if shard.tokens >= self.limit or at < len(docs) and shard.tokens + counts[at] > self.limit:
                    shards.append(shard.close())
                    shard = None
        if shard is not None:
            shards.append(shard.close())
        return Shards(TaskContext.get().partitionId(), shards)

    def commit(self, messages: list[Shards | None]) -> None:
        start, listed = 0, []
        for message in sorted((m for m in messages if m is not None), key=lambda m: m.task):
            for shard in message.shards:
                listed.append({**shard, "start": start})
                start += shard["tokens"]
        store, place = opened(self.path)
        with store.open_output_stream(f"{place}/manifest.json") as out:
            out.write(json.dumps({"format": MAGIC.decode(), "block": self.block, "tokens": start, "shards": listed}).encode())

    def abort(self, messages: list[Shards | None]) -> None:
        """Without a manifest nothing of this folder is ever read."""


@dataclass
class Shard(InputPartition):
    file: str
    start: int


class PackedReader(DataSourceReader):
    """(doc_id, start, ids) of every document; one task a shard, in slices of READ_TOKENS ids."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")

    def partitions(self) -> list[Shard]:
        store, place = opened(self.path)
        with store.open_input_stream(f"{place}/manifest.json") as source:
            manifest = json.loads(source.read())
        if manifest.get("format") != MAGIC.decode():
            raise ValueError(f"unknown format {manifest.get('format')!r}")
        return [Shard(x["file"], x["start"]) for x in manifest["shards"]] or [Shard("", 0)]

    def read(self, partition: Shard) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        shard = ShardReader(f"{self.path}/{partition.file}")
        starts = np.concatenate([[0], shard.ends])[:-1]
        for at, to, ids in shard.documents():
            docs = pa.array(shard.docs[at:to], pa.int64(), mask=shard.nulls[at:to])
            lists = arrays.list_array(ids.view(np.int32), shard.ends[at:to] - starts[at:to], pa.int32())
            yield pa.RecordBatch.from_arrays([docs, pa.array(partition.start + starts[at:to]), lists], names=["doc_id", "start", "ids"])


class PackedIds(DataSource):
    @classmethod
    def name(cls) -> str:
        return "packed_ids"

    def schema(self) -> str:
        return "doc_id bigint, start bigint, ids array<int>"

    def reader(self, schema) -> PackedReader:
        return PackedReader(self.options)

    def writer(self, schema, overwrite: bool) -> PackedWriter:
        return PackedWriter(self.options)


# --- tokens ---------------------------------------------------------------------------------

# The white space at which a text may be cut: no word, composed character or special token of the tokenizer spans it.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False
# Bytes of words that may be cut further, where a letter meets a sign: ASCII letters, the two bytes of the letters U+00C0 to
# U+00FF, and ASCII signs that begin no contraction and no special token.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123)]] = True
SIGNS = np.zeros(256, bool)
SIGNS[[x for x in range(33, 127) if not chr(x).isalnum() and chr(x) not in "'|<>"]] = True
GROUP = 128  # pieces that go to the library as one text
CACHED = 1 << 18


class Pieces:
    """A tokenizer and the ids of the pieces met so far: the first CACHED ones, which hold the frequent ones."""

    def __init__(self, model_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(model_file)
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        names = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(names.values(), default=-1) + 1, bool)
        self.ends[[i for name, i in names.items() if suffix and name.endswith(suffix)]] = True
        parts = ["ab", ".", "c", "-,", "é", "\u00df", "1", "'s"]
        each = [i for x in parts for i in self.whole([x])[0]]
        joined = [self.whole([blank.join(parts)])[0] for blank in (" ", "\n", "\t\r\n  ")]
        if not suffix or any(x != each for x in joined) or self.whole(["ab.c-,\u00e9"])[0] != self.whole(["ab . c -, \u00e9"])[0]:
            raise ValueError(f"{model_file}: texts of this tokenizer cannot be cut at blanks and signs")
        self.known: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.count = np.zeros(CACHED, np.int64), np.zeros(CACHED, np.int32)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, pieces: list[str], single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids on end and their number per piece. A ``single`` piece is one word to the library, so many go to it as one text
        and every id that ends a word ends a piece."""
        plain, other = pieces, []
        if not single.all():
            plain = [pieces[i] for i in np.flatnonzero(single)]
            other = [pieces[i] for i in np.flatnonzero(~single)]
        lists = self.whole([" ".join(plain[i : i + GROUP]) for i in range(0, len(plain), GROUP)])
        ids = np.concatenate([np.zeros(0, np.int32), *(np.array(x, np.int32) for x in lists)])
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(plain):
            raise ValueError("a piece was not one word")
        if not other:
            return ids, np.diff(stops, prepend=0)
        rest = self.whole(other)
        counts = np.empty(len(pieces), np.int64)
        counts[single], counts[~single] = np.diff(stops, prepend=0), [len(x) for x in rest]
        out, of = np.empty(int(counts.sum()), np.int32), np.repeat(single, counts)
        out[of], out[~of] = ids, [i for x in rest for i in x]
        return out, counts

    def look_up(self, pieces: list[str], single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids on end and their number per piece, from the known pieces and the library."""
        place = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(place < 0)
        ids, many = self.encode([pieces[i] for i in new], single[new])
        start, count = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        old = place >= 0
        start[old], count[old] = self.start[place[old]], self.count[place[old]]
        start[new], count[new] = self.used + np.cumsum(many) - many, many
        source = np.concatenate([self.flat[: self.used], ids])
        if (room := min(len(new), CACHED - len(self.known))) > 0:
            at = len(self.known)
            self.known.update(zip([pieces[i] for i in new[:room].tolist()], range(at, at + room)))
            self.start[at : at + room], self.count[at : at + room] = start[new[:room]], many[:room]
            self.flat, self.used = source, self.used + int(many[:room].sum())
        done = np.cumsum(count)
        step = np.arange(int(done[-1]) if len(done) else 0) - np.repeat(done - count, count)
        return source[np.repeat(start, count) + step], count


@lru_cache(maxsize=2)
def tokenizer(model_file: str) -> Pieces:
    return Pieces(model_file)


def cut(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text and whether it is one word of every piece. Pieces are the runs between blanks, and of runs that hold
    letters and signs only, the runs of either."""
    starts, stops, which = arrays.words(raw, ends, NOT_BLANK)
    latin = np.zeros(len(raw) + 1, bool)
    latin[1:-1] = (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)  # second bytes; the two left out are signs
    letter = LETTERS[raw] | latin[:-1] | latin[1:]
    sign = SIGNS[raw]
    strange = np.concatenate([[0], np.cumsum(~letter & ~sign)])
    plain = strange[stops] == strange[starts]
    change = np.flatnonzero(sign[1:] != sign[:-1]) + 1
    run = np.searchsorted(starts, change, "right") - 1
    inside = (run >= 0) & (change < stops[run]) & (change > starts[run]) if len(starts) else np.zeros(len(change), bool)
    change, run = change[inside], run[inside]
    change, run = change[plain[run]], run[plain[run]]
    first = np.concatenate([starts, change])
    order = np.argsort(first, kind="stable")
    last = np.concatenate([stops, stops[run]])
    of = np.concatenate([np.arange(len(starts)), run])[order]
    first, last = first[order], last[order]
    if len(first):
        last[:-1] = np.where(of[1:] == of[:-1], first[1:], last[:-1])
    return first, last, which[of], plain[of]


def encode_texts(model_file: str, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts on end, each followed by ``end_id``, and their number per text.

    The library gets every distinct piece of the slice that it has not met; ids are then gathered for all places."""
    raw, ends = arrays.flat_bytes(texts)
    starts, stops, which, single = cut(raw, ends)
    if not len(starts):
        return np.full(len(texts), end_id, np.int32), np.ones(len(texts), np.int64)
    # Pieces and what lies between them alternate in one array of spans; every second one is a piece.
    cuts = np.empty(2 * len(starts) + 1, np.int64)
    cuts[:-1:2], cuts[1::2], cuts[-1] = starts, stops, len(raw)
    spans = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(raw)))
    coded = spans.take(pa.array(np.arange(0, len(cuts) - 1, 2))).dictionary_encode()
    run = coded.indices.to_numpy()
    alone = np.empty(len(coded.dictionary), bool)
    alone[run] = single  # equal pieces are of one kind
    known, counts = tokenizer(model_file).look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), alone)
    many = counts[run]
    done = np.cumsum(many)
    step = np.arange(int(done[-1])) - np.repeat(done - many, many)
    out = np.full(int(done[-1]) + len(texts), end_id, np.int32)
    # One place is left after each text for its end id.
    out[np.repeat(done - many + which, many) + step] = known[np.repeat((np.cumsum(counts) - counts)[run], many) + step]
    return out, np.bincount(which, many, len(texts)).astype(np.int64) + 1


def encode(text: Column | str, model_file: str, end_id: int) -> Column:
    """Ids of each whole text as the tokenizers library gives them without special tokens, then ``end_id``; null reads as empty.

    The tokenizer must drop blanks and cut words at signs before its merges, and mark ends of words; others raise an error."""
    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for x in arrays.slices(batch, ENCODE_BYTES):  # each goes out at once, so a batch never lies whole beside its ids
                yield arrays.list_array(*encode_texts(model_file, x, end_id), pa.int32())

    return ids(text)


# --- operator -------------------------------------------------------------------------------

def write(docs: DataFrame, path: str, model_file: str, end_id: int, id: str = "doc_id", text: str = "text", **options) -> None:
    """Write the ids of all texts in ascending order of their integer ids to the new folder ``path``.

    Null ids come first; rows that share an id are ordered by their texts, so a hot id spans several tasks. Null texts read
    as empty and give the end id alone. Other columns are ignored. An empty table gives a manifest without shards. Options:
    percentile, block, shardtokens.
    """
    spark = docs.sparkSession
    spark.dataSource.register(PackedIds)
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")) \
        .withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    coded = ordered.select("doc_id", encode("text", model_file, end_id).alias("ids"))
    coded.write.format("packed_ids").mode("append").options(**{k: str(v) for k, v in options.items()}).save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of a folder of shards; start counts the ids of all documents before."""
    spark.dataSource.register(PackedIds)
    return spark.read.format("packed_ids").load(path)


def with_checksum(rows: DataFrame, ids: str = "ids", name: str = "ids_crc32") -> DataFrame:
    """Add the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    import zlib

    @F.arrow_udf("bigint")
    def crc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            flat = memoryview(batch.flatten().to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            at = 4 * (np.asarray(batch.offsets) - batch.offsets[0].as_py() if len(batch) else np.zeros(1, np.int64))
            yield pa.array([zlib.crc32(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64())

    return rows.withColumn(fresh(rows, name), crc(ids))
