"""Token pieces of documents and their sum-of-squares packing into sequences."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pressroom.llm.common import free_name, map_batches, runs
from pressroom.llm.neardup import starts_of
from pressroom.llm.textkit import pieces_of, span_hashes

END_ID = 1
SHARD = 16_384
#: Bytes of a Python worker's cache of parts before those unused for long go; it changes no result.
CACHE = 24 << 20
#: Bytes that only arrays know for one cached part: key, place, number of ids, mark of use.
_ENTRY = 8 + 8 + 4 + 1
_PIECE = 1 << 20
_ENCODERS: dict = {}

#: Classes of bytes: white space that ends words, letters, digits, marks, and those that make a word
#: irregular. C3 to C9 lead letters of one or two marks from U+00C0 to U+024F, but for a few.
_SPACE, _LETTER, _DIGIT, _MARK, _ODD = range(5)
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[[9, 10, 13, 32]] = _SPACE
_CLASS[0x21:0x7F] = _MARK
_CLASS[0x30:0x3A] = _DIGIT
for _first, _last in ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xBF), (0xC3, 0xC9)):
    _CLASS[_first : _last + 1] = _LETTER
_CLASS[0x27] = _ODD
#: Multiplication and division sign, and the letter whose small form is two characters.
_ODD_PAIRS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class WordEncoder:
    """Ids of texts through the ids of their parts, each encoded once while it is cached.

    The tokenizer drops white space and never joins over it, lower-cases, and encodes runs of
    letters, single digits and runs of marks on their own. So a text's ids are those of its parts in
    a row. Parts of ASCII and plain Latin words are found on whole arrays of bytes; a word with an
    apostrophe, another character or the beginning of an added token (end of text and the like) is
    one part as it stands. Parts are known by a 64-bit hash, looked up for about a megabyte of text
    at once in one sorted array; new ones are encoded many at a time, told apart by the mark that
    ends a part's last id, or for whole words by a word between them.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Added tokens are found in the text as it is, before case and parts.
        added = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd_pairs = {*_ODD_PAIRS, *((t[0], t[1]) for t in added if len(t) > 1)}
        self.classes = _CLASS.copy()
        self.classes[[t[0] for t in added if len(t) == 1]] = _ODD
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.between = self._encoded("\x02")
        self.keys = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.size = np.empty(0, np.int32)
        self.used = np.empty(0, bool)
        self.pool = np.empty(0, np.uint32)

    @staticmethod
    def of(path: str) -> WordEncoder:
        """The encoder of this Python worker."""
        if path not in _ENCODERS:
            _ENCODERS[path] = WordEncoder(path)
        return _ENCODERS[path]

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def whole(self, text: str) -> bytes:
        return self._encoded(text).tobytes()

    def _parts_ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each part, and all ids."""
        ids = self._encoded(" ".join(parts))
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(parts) and (not len(cuts) or cuts[-1] == len(ids)):
            return np.diff(cuts, prepend=0), ids
        return self._each(parts)

    def _words_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of any characters, with a word of one id between them."""
        if len(self.between) == 1 and not any("\x02" in w for w in words):
            ids = self._encoded(" \x02 ".join(words))
            cuts = np.flatnonzero(ids == self.between[0])
            if len(cuts) == len(words) - 1:
                sizes = np.diff(np.concatenate(([-1], cuts, [len(ids)]))) - 1
                return sizes, np.delete(ids, cuts)
        return self._each(words)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [self._encoded(w) for w in words]
        return np.array([len(x) for x in each], np.int64), np.concatenate(each)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        if len(self.keys):
            at[at == len(self.keys)] = 0
            return np.where(self.keys[at] == keys, at, -1)
        return np.full(len(keys), -1)

    def _bytes(self, at: np.ndarray) -> int:
        return len(at) * _ENTRY + 4 * int(self.size[at].sum())

    def _make_room(self, wanted: np.ndarray) -> None:
        """Only parts used since the last time stay, or those in ``wanted`` if they are too many."""
        if len(self.keys) * _ENTRY + 4 * len(self.pool) <= CACHE:
            return
        stay = np.flatnonzero(self.used)
        if self._bytes(stay) > CACHE // 2:
            stay = np.unique(wanted)
        sizes = self.size[stay]
        self.pool = self.pool[ragged(self.at[stay], sizes)]
        self.keys, self.at, self.size = self.keys[stay], np.cumsum(sizes, dtype=np.int64) - sizes, sizes
        self.used = np.zeros(len(stay), bool)

    def _add(self, keys: np.ndarray, parts: list[bytes], odd: np.ndarray) -> None:
        order = np.concatenate((np.flatnonzero(~odd), np.flatnonzero(odd)))
        plain = len(odd) - int(odd.sum())
        sizes, ids = [np.empty(0, np.int64)], [self.pool]
        for encode, at in ((self._parts_ids, order[:plain]), (self._words_ids, order[plain:])):
            for k in range(0, len(at), 256):
                n, found = encode([parts[i].decode("utf-8", "replace") for i in at[k : k + 256]])
                sizes.append(n)
                ids.append(found)
        size = np.concatenate(sizes)
        starts = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate(ids).astype(np.uint32, copy=False)
        back = np.argsort(order)
        place = np.searchsorted(self.keys, keys)
        for name, more in (("keys", keys), ("at", starts[back]), ("size", size[back]), ("used", np.ones(len(keys), bool))):
            held = getattr(self, name)
            setattr(self, name, np.insert(held, place, more.astype(held.dtype, copy=False)))

    def _spans(self, array: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Folded bytes, start and end of each part, and whether it is a word as it stands."""
        kind = np.empty(len(array) + 2, np.uint8)
        kind[0] = kind[-1] = _SPACE
        inner = kind[1:-1]
        np.take(self.classes, array, out=inner)
        odd = inner == _ODD
        for a, b in self.odd_pairs:
            odd[:-1] |= (array[:-1] == a) & (array[1:] == b)
        folded = _LOWER[array]
        high = np.flatnonzero(array[:-1] == 0xC3) + 1
        high = high[(array[high] >= 0x80) & (array[high] <= 0x9E)]
        folded[high] += 0x20
        if odd.any():
            space = kind == _SPACE
            edges = np.flatnonzero(space[1:] != space[:-1])
            upto = np.concatenate(([0], np.cumsum(odd)))
            first, last = edges[0::2], edges[1::2]
            bad = upto[last] > upto[first]
            paint = np.zeros(len(array) + 1, np.int8)
            paint[first[bad]] = 1
            paint[last[bad]] = -1
            inside = np.cumsum(paint[:-1], dtype=np.int8).view(bool)
            inner[inside] = _ODD
            folded[inside] = array[inside]
        here, before = kind[1:], kind[:-1]
        change = here != before
        starts = np.flatnonzero((here != _SPACE) & (change | (here == _DIGIT)))
        ends = np.flatnonzero((before != _SPACE) & (change | (before == _DIGIT)))
        return folded, starts, ends, inner[starts] == _ODD

    def _piece(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the parts of some bytes start, how many ids each has, and all ids."""
        folded, starts, ends, odd = self._spans(np.frombuffer(data, np.uint8))
        keys, first, back = np.unique(span_hashes(folded, starts, ends), return_index=True, return_inverse=True)
        at = self._find(keys)
        if (at < 0).any():
            known = at[at >= 0]
            self.used[known] = True
            self._make_room(known)
            new = np.flatnonzero(self._find(keys) < 0)
            text = folded.tobytes()
            self._add(keys[new], [text[starts[i] : ends[i]] for i in first[new]], odd[first[new]])
            at = self._find(keys)
        self.used[at] = True
        at = at[back]
        sizes = self.size[at].astype(np.int64)
        return starts, sizes, self.pool[ragged(self.at[at], sizes)]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text, given in UTF-8."""
        out: list[np.ndarray] = []
        group: list[bytes] = []
        weight = 0
        for text in [*texts, None]:
            if group and (text is None or weight + len(text) > _PIECE):
                begins = np.cumsum([0] + [len(t) + 1 for t in group])
                starts, sizes, ids = self._piece(b"\n".join(group))
                upto = np.concatenate(([0], np.cumsum(sizes)))
                cuts = upto[np.searchsorted(starts, begins)]
                out.extend(ids[a:b] for a, b in zip(cuts[:-1], cuts[1:]))
                group, weight = [], 0
            if text is None:
                break
            if len(text) > _PIECE:
                parts = [self._piece(part)[2] for part in pieces_of(text)]
                out.append(np.concatenate(parts))
            else:
                group.append(text)
                weight += len(text) + 1
        return out


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of several ranges, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, piece, start, length, ids)``: every document's ids, then id 1, cut at ``capacity``.

    ``ids`` holds little-endian unsigned 32-bit ids. ``tokenizer`` is the path of a vocabulary file
    on every node, of a tokenizer such as ``WordEncoder`` describes. Null and empty
    texts are one piece with the end id alone. Rows are independent: a null or repeated id is
    carried along. No rows give no rows.
    """
    schema = pa.schema([
        ("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ])
    end = np.array([END_ID], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer)
        for batch in batches:
            rows = []
            encoded = encoder.encode([text or b"" for text in batch.column(1).to_pylist()])
            for key, ids in zip(batch.column(0).to_pylist(), encoded):
                data = ids.astype("<u4").tobytes() + end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((key, piece, at // 4, len(part) // 4, part))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    out = map_batches(narrow, work, "id long, piece int, start long, length long, ids binary")
    return out.withColumnRenamed("id", id_col)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, taken in the given order.

    Each goes where the sum over gaps of the squared number of open bins with that gap becomes
    smallest; the smaller gap wins ties. A new bin is opened where nothing fits.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    worst = np.iinfo(np.int64).max
    made = 0
    for i, size in enumerate(lengths.tolist()):
        here = count[size:capacity]
        change = count[: capacity - size] - here
        gap = -1
        if len(here):
            change = np.where(here > 0, 2 * change + 2, worst)
            change[0] -= here[0] > 0
            at = int(change.argmin())
            if here[at] > 0:
                gap = at + size
        if gap < 0:
            gap, target, made = capacity, made, made + 1
        else:
            target = open_[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = target, capacity - gap
        rest = gap - size
        if rest:
            count[rest] += 1
            open_[rest].append(target)
    return bins, offsets


def pack(
    pieces: DataFrame, keys: list[str], length_col: str = "length", capacity: int = 4096, shard: int = SHARD
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sum-of-squares packing of their lengths.

    Pieces are dealt by a hash of ``keys`` (and of a repeated row's number) to shards of about
    ``shard`` pieces, each packed on its own, longest first; full pieces are a sequence each. A
    shard leaves few bins part full, so the loss is a fixed share however many there are. Pieces
    over ``capacity`` and of null or negative length fail; those of length 0 share a place. The
    result depends on the pieces alone. Extra columns pass through, but for an earlier
    ``sequence_id`` or ``offset``, which are replaced. No rows give no rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    shards = max(1, math.ceil(pieces.count() / shard))
    name = free_name(pieces, "shard_of_pieces")
    dealt = pieces.withColumn(name, F.pmod(F.xxhash64(*keys), F.lit(shards)).cast("int"))
    out_schema = T.StructType([
        *pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, [name]):
            bounds = starts_of(group[name].to_numpy())
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                part = group.slice(lo, hi - lo)
                lengths = part[length_col].to_numpy()
                if not (lengths.min() >= 0 and lengths.max() <= capacity):
                    raise ValueError("a piece has no length between 0 and the capacity")
                order = np.lexsort((np.arange(len(lengths)), -lengths))
                bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
                bins[order], offsets[order] = sum_of_squares(lengths[order], capacity)
                bins += int(part[name][0].as_py()) << 40
                part = part.drop_columns([name])
                part = part.append_column("sequence_id", pa.array(bins)).append_column("offset", pa.array(offsets))
                yield from part.combine_chunks().to_batches()

    dealt = dealt.repartition(name).sortWithinPartitions(name, *keys)
    return map_batches(dealt, work, out_schema)


def sequences(placed: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)``: the ids of each sequence's pieces, by offset.

    ``placed`` has ``sequence_id``, ``offset``, ``length`` and ``ids`` (binary); a sequence holds at
    most its capacity, so the groups are small.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda all_, x: F.concat(all_, x["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
