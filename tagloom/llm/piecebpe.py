"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

All distinct words of a slice of texts lie in one flat symbol array. Each round looks up the rank of every adjacent
pair, takes the minimum per word, merges its occurrences from the left in all words at once and compacts the array,
until no pair remains. Null and empty texts give the end id alone; decoding gives back the text, with U+2581 as a space.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm import arrays
from tagloom.llm.common import fresh

SPACE = "▁"
NONE = np.iinfo(np.int32).max
# Text encoded at once: larger slices repeat more of their words.
ENCODE_BYTES = 4 << 20


class Vocabulary:
    """Merge table of a SentencePiece BPE model file with identity normalisation and byte fallback."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = sp.get_piece_size()
        piece = [sp.id_to_piece(i) for i in range(size)]
        score = np.array([sp.get_score(i) for i in range(size)])
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(size)]
        plain = {p: i for i, p in enumerate(piece) if not special[i]}
        if any(SPACE in p.lstrip(SPACE) for p in plain):
            raise ValueError("pieces with a space after another character are not supported")
        self.size, self.eos = size, sp.eos_id()
        # Equal scores share a rank: the leftmost pair goes first, whichever piece it makes.
        rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in plain.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.char[ord(" ")] = self.char[ord(SPACE)]
        self.byte = np.zeros(256, np.int32)
        for i in range(size):
            if sp.is_byte(i):
                self.byte[int(piece[i][3:5], 16)] = i
        found = [(plain[p[:k]] * size + plain[p[k:]], i) for p, i in plain.items()
                 for k in range(1, len(p)) if p[:k] in plain and p[k:] in plain]
        keys = np.array([k for k, _ in found], np.int64)
        made = np.array([i for _, i in found], np.int32)
        self.build_table(keys, made)
        self.rank = rank
        self.reach = 2 * max(map(len, plain), default=1)
        # A piece that can grow at once into one of equal or better rank: its occurrences must merge one by one.
        self.alone = np.zeros(size, bool)
        for side in (keys // size, keys % size):
            np.logical_or.at(self.alone, side, rank[made] <= rank[side])
        # What each id decodes to.
        text = [b"" if special[i] else piece[i].replace(SPACE, " ").encode() for i in range(size)]
        for b, i in enumerate(self.byte):
            if i:
                text[i] = bytes([b])
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self.text_at = np.concatenate([[0], np.cumsum([len(t) for t in text])])

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * arrays.BASE) >> self.shift).astype(np.int64)

    def build_table(self, keys: np.ndarray, made: np.ndarray) -> None:
        """Open addressing with linear probing, mostly empty: one look settles nearly every pair."""
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 8))))
        self.shift = np.uint64(64 - bits)
        self.table = np.full(1 << bits, -1, np.int64)
        self.result = np.full(1 << bits, -1, np.int32)
        at = self.slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = self.table[at[left]] < 0
            _, one = np.unique(at[left], return_index=True)
            one = one[free[one]]
            put = left[one]
            self.table[at[put]], self.result[at[put]] = keys[put], made[put]
            left = np.delete(left, one)
            at[left] = (at[left] + 1) % len(self.table)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair merges into, -1 where there is none."""
        key = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, 0)
        at = self.slot(key)
        found = self.table[at]
        out = np.where(found == key, self.result[at], np.int32(-1))
        look = np.flatnonzero((found != key) & (found >= 0))
        while len(look):
            at[look] = (at[look] + 1) % len(self.table)
            found = self.table[at[look]]
            hit = found == key[look]
            out[look[hit]] = self.result[at[look[hit]]]
            look = look[~hit & (found >= 0)]
        return out

    def merge(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all words to the end: flat symbols and their number per word."""
        word = np.repeat(np.arange(len(counts)), counts)
        width = np.ones(len(symbols), np.int32)  # characters under a symbol
        done: list[tuple[np.ndarray, np.ndarray]] = []
        made = np.full(len(symbols), -1, np.int32)
        made[:-1] = np.where(word[1:] == word[:-1], self.pair(symbols[:-1], symbols[1:]), -1)
        while len(symbols):
            rank = np.where(made >= 0, self.rank[made], NONE)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(first, len(word)))
            best = np.minimum.reduceat(rank, first)
            if (ended := best == NONE).any():
                over = np.repeat(ended, size)
                done.append((word[over], symbols[over]))
                word, symbols, width, made, rank = (x[~over] for x in (word, symbols, width, made, rank))
                best, size = best[~ended], size[~ended]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            start = np.cumsum(width) - width
            new = np.ones(len(at), bool)  # first of a run of overlapping occurrences
            new[1:] = (np.diff(at) > 1) | (word[at[1:]] != word[at[:-1]])
            run = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
            take = (np.arange(len(at)) - run) % 2 == 0
            lone = self.alone[made[at]]
            if lone.any():  # of occurrences within reach of each other, the leftmost only
                near = np.zeros(len(at), bool)
                near[1:] = (np.diff(start[at]) <= 2 * self.reach) & (word[at[1:]] == word[at[:-1]])
                worried = np.bincount(word[at], lone, minlength=int(word[-1]) + 1)[word[at]] > 0
                take &= ~(near & worried)
            at = at[take]
            symbols[at] = made[at]
            width[at] += width[at + 1]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            stale = np.zeros(len(symbols), bool)
            stale[at] = True
            stale[np.maximum(at - 1, 0)] = True
            word, symbols, width, made, stale = (x[keep] for x in (word, symbols, width, made, stale))
            # A symbol before a merged one lost its right neighbour too, when that neighbour was merged away.
            back = np.flatnonzero(stale)
            stale[np.maximum(back - 1, 0)] = True
            look = np.flatnonzero(stale)
            right = np.minimum(look + 1, len(symbols) - 1)
            same = (look < len(symbols) - 1) & (word[right] == word[look])
            made[look] = np.where(same, self.pair(symbols[look], symbols[right]), -1)
        if not done:
            return symbols, np.zeros(len(counts), np.int64)
        word, symbols = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(counts))

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words on end, and their number per word. Characters without a piece become their bytes."""
        points, ends = arrays.flat_chars(words)
        points, counts = points.astype(np.int64), np.diff(ends)
        symbols = self.char[points]
        symbols = np.where(symbols < 0, -1 - points, symbols).astype(np.int32)
        symbols, counts = self.merge(symbols, counts)
        if (strange := symbols < 0).any():
            spelled = [[x] if x >= 0 else self.byte[list(chr(-1 - x).encode())].tolist() for x in symbols[strange].tolist()]
            long = np.ones(len(symbols), np.int64)
            long[strange] = [len(x) for x in spelled]
            out = np.repeat(symbols, long)
            out[np.repeat(strange, long)] = [i for x in spelled for i in x]
            counts = np.bincount(np.repeat(np.repeat(np.arange(len(counts)), counts), long), minlength=len(counts))
            symbols = out
        return symbols, counts


@lru_cache(maxsize=2)
def vocabulary(model_file: str) -> Vocabulary:
    return Vocabulary(model_file)


def word_bounds(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where words begin: at each text, at a space after another byte, and around a line feed, which no piece contains."""
    cut = np.zeros(len(raw) + 1, bool)
    cut[ends] = True
    space, line = raw == 32, raw == 10
    cut[1:-1] |= (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    return np.flatnonzero(cut)


def encode_texts(v: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts on end, each followed by the end id, and their number per text."""
    raw, ends = arrays.flat_bytes(texts)
    full = np.flatnonzero(np.diff(ends))
    if not len(full):
        return np.full(len(texts), v.eos, np.int32), np.ones(len(texts), np.int64)
    # Every text that is not empty gets a space in front; U+2581 stands for a space as well.
    parts = [raw[ends[i] : ends[i + 1]].tobytes().replace(SPACE.encode(), b" ") for i in full]
    own = np.concatenate([[0], np.cumsum([len(x) + 1 for x in parts])])
    data = b" " + b" ".join(parts)
    cuts = word_bounds(np.frombuffer(data, np.uint8), own)
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
    coded = spans.dictionary_encode()
    ids, counts = v.encode_words(coded.dictionary)
    which = coded.indices.to_numpy()
    many = counts[which]
    # Gather each word's ids, and leave room for an end id after each text.
    text_of = full[np.searchsorted(own, cuts[:-1], "right") - 1]
    n = np.bincount(text_of, many, len(texts)).astype(np.int64)
    done = np.cumsum(many)
    step = np.arange(int(done[-1])) - np.repeat(done - many, many)
    out = np.full(int(done[-1]) + len(texts), v.eos, np.int32)
    out[np.repeat(done - many + text_of, many) + step] = ids[np.repeat((np.cumsum(counts) - counts)[which], many) + step]
    return out, n + 1


def encode(text: Column | str, model_file: str) -> Column:
    """The ids of each whole text with an end id, as the library of the model file gives them."""
    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocabulary(model_file)
        for batch in batches:
            parts = [arrays.list_array(*encode_texts(v, x), pa.int32()) for x in arrays.slices(batch, ENCODE_BYTES)]
            yield arrays.joined(parts, pa.list_(pa.int32()))

    return ids(text)


def decode_lists(v: Vocabulary, lists: pa.Array) -> pa.Array:
    """Texts of id lists: pieces on end, without the space in front that encoding adds."""
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    rows = np.asarray(lists.offsets)
    rows = rows - rows[0]
    long = (v.text_at[1:] - v.text_at[:-1])[ids]
    ends = np.concatenate([[0], np.cumsum(long)])
    step = np.arange(int(ends[-1])) - np.repeat(ends[:-1], long)
    raw = v.text[np.repeat(v.text_at[ids], long) + step]
    at = ends[rows]
    lead = np.zeros(len(raw), bool)
    has = at[1:] > at[:-1]
    lead[at[:-1][has]] = raw[at[:-1][has]] == 32
    offsets = np.concatenate([[0], np.cumsum(~lead)])[at]
    data = raw[~lead].tobytes()
    texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
    return pa.array(texts, pa.large_string())


def decode(ids: Column | str, model_file: str) -> Column:
    """The text of each id list (null: null)."""
    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocabulary(model_file)
        for batch in batches:
            parts = [decode_lists(v, batch.slice(i, 512)) for i in range(0, len(batch), 512)]
            yield arrays.joined(parts, pa.large_string()).cast(pa.string())

    return text(ids)


def encode_decode(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """``docs`` with the columns ids and decoded, both made by one Python worker per task, slice by slice."""
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    @F.arrow_udf("ids array<int>, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocabulary(model_file)
        for batch in batches:
            parts = []
            for x in arrays.slices(batch, ENCODE_BYTES):
                lists = arrays.list_array(*encode_texts(v, x), pa.int32())
                parts.append(pa.StructArray.from_arrays([lists, decode_lists(v, lists).cast(pa.string())], fields=list(kind)))
            yield arrays.joined(parts, kind)

    coded = fresh(docs, "coded")
    kept = [c for c in docs.columns if c not in ("ids", "decoded")]
    return docs.withColumn(coded, both(text)).select(*kept, f"{coded}.*")
