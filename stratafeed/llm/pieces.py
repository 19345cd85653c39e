"""SentencePiece encoding and decoding by suffix-array matching.

The distinct chunks of a slice of text that were not met before are joined to strings of
bounded size, whose suffixes are sorted. Every piece of the vocabulary is looked up in them by binary search; its range
of suffixes are its occurrences, and all occurrences, sorted by position, are the edges
of a lattice over the string. A chunk is then relaxed over these edges: neighbouring
spans join along the edge of highest score, leftmost first, until no edge joins two
spans. That is what a BPE model defines, as the usual best-path relaxation is for a
unigram model.
"""

from __future__ import annotations

import heapq
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import _text

_SLICE = 2 << 20
#: Chunks of more characters are relaxed one by one with a heap.
_LONG = 48
#: Chunks whose ids a task remembers.
_CHUNKS = 200_000
#: Bytes of distinct chunks that are indexed at once; a longer chunk is indexed alone.
_INDEXED = 256 << 10
_MARK = "▁".encode()


class Vocabulary(NamedTuple):
    """``pieces`` as bytes, with a space for the word mark; by id. Ids in ``bytes_from``
    and the 255 after it stand for single bytes."""

    pieces: list[bytes]
    scores: np.ndarray
    ids: np.ndarray
    bytes_from: int


def load(path: str) -> Vocabulary:
    """Vocabulary of a BPE model with byte fallback, read by the driver."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i).encode().replace(_MARK, b" ") for i in range(n)]
    raw = [i for i in range(n) if model.is_byte(i)]
    if len(raw) != 256 or raw != list(range(raw[0], raw[0] + 256)):
        raise ValueError("a model with one piece for every byte is needed")
    for i in raw:
        pieces[i] = bytes([i - raw[0]])
    apart = [i for i in range(n) if model.is_control(i) or model.is_unknown(i)]
    for i in apart:
        pieces[i] = b""
    skip = {*raw, *apart, *(i for i in range(n) if model.is_unused(i))}
    own = [i for i in range(n) if i not in skip]
    if any(b" " in pieces[i].lstrip(b" ") for i in own):
        raise ValueError("pieces with a word mark behind other characters are not handled")
    scores = np.array([model.get_score(i) for i in own], np.float64)
    return Vocabulary(pieces, scores, np.array(own), raw[0])


def encode(df: DataFrame, text: str, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``df`` with the piece ids of each text; nothing is shuffled.

    Ids equal those of the model's own encoder. Null and empty texts have no ids;
    characters that are no piece become their bytes; any other columns are kept, one
    named like ``ids`` is replaced.
    """
    kept = df.drop(ids)
    schema = T.StructType([*kept.schema, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches):
        encoder = Encoder(vocabulary)
        for batch in batches:
            for part, data, offsets in _text.slices(batch, text, _SLICE):
                flat, ends = encoder.encode(data, offsets)
                lists = pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, lists], [*part.schema.names, ids]
                )

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str, vocabulary: Vocabulary, text: str = "decoded") -> DataFrame:
    """``df`` with the text of each list of ids; the opposite of ``encode``.

    The word mark's own character comes back as a space. Null and empty lists give an
    empty text; ids outside the vocabulary and null ids raise an error; bytes that are
    not UTF-8 become the replacement character.
    """
    kept = df.drop(text)
    schema = T.StructType([*kept.schema, T.StructField(text, T.StringType())])
    pieces = vocabulary.pieces

    def run(batches):
        sizes = np.array([len(p) for p in pieces], np.int64)
        start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        letters = np.frombuffer(b"".join(pieces), np.uint8)
        for batch in batches:
            lists = batch.column(batch.schema.names.index(ids))
            step = 1000
            for at in range(0, len(lists), step):
                some = lists.slice(at, step)
                if some.flatten().null_count:
                    raise ValueError("a null id cannot be decoded")
                counts = [0 if n is None else n for n in pa.compute.list_value_length(some).to_pylist()]
                flat = some.flatten().to_numpy(zero_copy_only=False)
                if len(flat) and (flat.min() < 0 or flat.max() >= len(sizes)):
                    raise ValueError("an id is outside the vocabulary")
                n = sizes[flat]
                ends = np.concatenate([[0], np.cumsum(n)])
                raw = letters[np.repeat(start[flat] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
                cut = ends[np.concatenate([[0], np.cumsum(counts)])]
                texts = [
                    raw[a + (raw[a : a + 1] == b" ") : b].decode("utf-8", "replace")
                    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)
                ]
                part = batch.slice(at, step)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], [*part.schema.names, text]
                )

    return kept.mapInArrow(run, schema)


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        own = [vocabulary.pieces[i] for i in vocabulary.ids]
        self.ids, self.scores = vocabulary.ids, vocabulary.scores
        self.bytes_from = vocabulary.bytes_from
        self.sizes = np.array([len(p) for p in own], np.int64)
        # Keys of 8 bytes, big-endian, so that they compare like the bytes.
        self.depth = -(-int(self.sizes.max()) // 8)
        fill = [b"\0", b"\xff"]
        self.low, self.high = (
            [
                np.frombuffer(b"".join(p[8 * d : 8 * d + 8].ljust(8, f) for p in own), ">u8").astype(np.uint64)
                for d in range(self.depth)
            ]
            for f in fill
        )
        joined = {b for p in own if len(p) > 1 for b in p}
        # ASCII characters of no longer piece always stand alone.
        self.alone = np.array([b < 128 and b not in joined for b in range(256)])
        self._forget()
        self.span = 1 << int(self.sizes.max()).bit_length()

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """All ids, and the end of each text's ids."""
        raw = data.tobytes()
        texts = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        # Each text begins with a word mark.
        texts = [b" " + t.replace(_MARK, b" ") if t else t for t in texts]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        start = self._chunks(data, offsets)
        known = self._known(data.tobytes(), start, np.append(start[1:], len(data)))
        counts = self.counts[known]
        upto = np.concatenate([[0], np.cumsum(counts)])
        out = self.flat[np.repeat(self.begin[known] - upto[:-1], counts) + np.arange(upto[-1])]
        return out, upto[np.searchsorted(start, offsets)]

    def _known(self, raw: bytes, start, end):
        """Places of chunks among those encoded so far, with the new ones added.

        Chunks are told apart by their bytes. At most ``_CHUNKS`` of them, and those of one
        slice, are kept.
        """
        if len(self.seen) > _CHUNKS:
            self._forget()
        chunks = [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        places = np.fromiter(map(self.seen.get, chunks, repeat(-1)), np.int64, len(chunks))
        open_ = np.flatnonzero(places < 0)
        if len(open_):
            unknown = [chunks[i] for i in open_.tolist()]
            self._learn(list(dict.fromkeys(unknown)))
            places[open_] = np.fromiter(map(self.seen.get, unknown), np.int64, len(unknown))
        return places

    def _learn(self, new: list[bytes]):
        """Encode distinct chunks, some at a time."""
        begin, counts, flat = [self.begin], [self.counts], [self.flat]
        size, at = len(self.flat), 0
        upto = np.cumsum([len(c) + 1 for c in new])
        while at < len(new):
            done = int(upto[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(upto, done + _INDEXED, "right")))
            ids, ends = self._distinct(new[at:to])
            begin.append(ends[:-1] + size)
            counts.append(np.diff(ends))
            flat.append(ids.astype(np.int32))
            size += len(ids)
            at = to
        places = range(len(self.seen), len(self.seen) + len(new))
        self.seen.update(zip(new, places, strict=True))
        self.begin, self.counts = np.concatenate(begin), np.concatenate(counts)
        self.flat = np.concatenate(flat)

    def _forget(self):
        self.seen: dict[bytes, int] = {}
        self.begin = self.counts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _chunks(self, data, offsets):
        """Starts of chunks that no piece crosses: runs of spaces with what follows."""
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        space, alone = data == 32, self.alone[data]
        begins[1:-1] |= space[1:] & ~space[:-1]
        begins[:-1] |= alone
        begins[1:] |= alone
        return np.flatnonzero(begins[:-1])

    def _distinct(self, chunks: list[bytes]):
        # One 0 behind every chunk keeps the pieces from matching across.
        joined = np.frombuffer(b"\0".join([*chunks, b""]), np.uint8)
        upto = np.concatenate([[0], np.cumsum([len(c) + 1 for c in chunks])])
        edges, piece = self._edges(joined)
        return self._relax(joined, upto[:-1], upto[1:] - 1, edges, piece)

    def _edges(self, joined):
        """All occurrences of pieces, sorted: position * span + size, and the piece."""
        n = len(joined)
        keys = _keys(joined, self.depth)
        suffixes = _suffix_array(keys[0], 8 * self.depth)
        low = self._bound(keys, suffixes, self.low, False)
        high = self._bound(keys, suffixes, self.high, True)
        counts = np.maximum(high - low, 0)
        upto = np.concatenate([[0], np.cumsum(counts)])
        edges = suffixes[np.repeat(low - upto[:-1], counts) + np.arange(upto[-1])]
        piece = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        edges *= self.span
        edges += self.sizes[piece]
        order = np.argsort(edges)
        assert n < (1 << 62) // self.span
        return edges[order], piece[order]

    def _bound(self, keys, suffixes, pieces, right: bool):
        """Binary search of every piece among the sorted suffixes.

        The first key finds the pieces that fit in it, and bounds the search for longer ones.
        """
        first = keys[0][suffixes]
        low = np.searchsorted(first, pieces[0], "left")
        high = np.searchsorted(first, pieces[0], "right")
        out = high if right else low
        long = np.flatnonzero((self.sizes > 8) & (low < high))
        lo, hi, last = low[long], high[long], len(suffixes) - 1
        rest = [piece[long] for piece in pieces[1:]]
        while (open_ := lo < hi).any():
            middle = (lo + hi) // 2
            at = suffixes[np.minimum(middle, last)]
            below, same = np.zeros(len(lo), bool), np.ones(len(lo), bool)
            for key, piece in zip(keys[1:], rest, strict=True):
                k = key[at]
                below |= same & (k < piece)
                same &= k == piece
            if right:
                below |= same
            lo = np.where(open_ & below, middle + 1, lo)
            hi = np.where(open_ & ~below, middle, hi)
        out[long] = lo
        return out

    def _relax(self, joined, start, end, edges, piece):
        scores = np.append(self.scores[piece], -np.inf)

        def find(a, b):
            """Number of the edge from a to b, or of the last, empty one."""
            key = a * self.span + np.minimum(b - a, self.span - 1)
            at = np.searchsorted(edges, key)
            hit = (at < len(edges)) & (edges[np.minimum(at, len(edges) - 1)] == key) if len(edges) else np.zeros(len(key), bool)
            return np.where(hit & (b - a < self.span), at, len(edges))

        lead = (joined & 0xC0) != 0x80
        lead[end] = False
        begin = np.flatnonzero(lead)
        chunk = np.searchsorted(start, begin, "right") - 1
        counts = np.bincount(chunk, minlength=len(start))
        stop = np.append(begin[1:], 0)
        last = np.append(chunk[1:] != chunk[:-1], True)
        stop[last] = end[chunk[last]]

        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        long = np.flatnonzero(counts > _LONG)
        for c in long:
            own = slice(*np.searchsorted(chunk, [c, c + 1]))
            a, b = _by_heap(begin[own], stop[own], lambda x, y: scores[find(np.array([x]), np.array([y]))][0])
            done.append((a, b, np.full(len(a), c)))
        if len(long):
            short = counts[chunk] <= _LONG
            begin, stop, chunk = begin[short], stop[short], chunk[short]

        def pair_scores(i):
            """Score of joining span i with the next one."""
            j = np.minimum(i + 1, len(begin) - 1)
            ok = (j > i) & (chunk[j] == chunk[i])
            out = np.full(len(i), -np.inf)
            out[ok] = scores[find(begin[i[ok]], stop[j[ok]])]
            return out

        pairs = pair_scores(np.arange(len(begin)))
        while len(begin):
            first = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
            best = np.maximum.reduceat(pairs, first)
            sizes = np.diff(np.append(first, len(begin)))
            live = np.repeat(best > -np.inf, sizes)
            if not live.all():
                done.append((begin[~live], stop[~live], chunk[~live]))
                best = np.repeat(best, sizes)[live]
                begin, stop, chunk, pairs = begin[live], stop[live], chunk[live], pairs[live]
            else:
                best = np.repeat(best, sizes)
            if not len(begin):
                break
            top = np.flatnonzero(pairs == best)
            top = top[np.append(True, chunk[top][1:] != chunk[top][:-1])]
            stop[top] = stop[top + 1]
            keep = np.ones(len(begin), bool)
            keep[top + 1] = False
            moved = np.cumsum(keep)[top] - 1
            begin, stop, chunk, pairs = begin[keep], stop[keep], chunk[keep], pairs[keep]
            pairs[moved] = pair_scores(moved)
            before = moved[moved > 0] - 1
            pairs[before] = pair_scores(before)

        begin, stop, chunk = (np.concatenate([d[i] for d in done]) for i in range(3))
        order = np.argsort(begin)
        begin, stop, chunk = begin[order], stop[order], chunk[order]
        edge = find(begin, stop)
        known = edge < len(edges)
        ids = np.zeros(len(begin), np.int64)
        ids[known] = self.ids[piece[edge[known]]]
        # A single character that is no piece becomes its bytes.
        n = np.where(known, 1, stop - begin)
        upto = np.concatenate([[0], np.cumsum(n)])
        span = np.repeat(np.arange(len(begin)), n)
        inner = begin[span] + np.arange(len(span)) - upto[span]
        out = np.where(known[span], ids[span], joined[inner].astype(np.int64) + self.bytes_from)
        per_chunk = np.bincount(chunk, weights=n, minlength=len(start)).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(per_chunk)])


def _keys(joined, depth):
    """For every position the next 8 bytes as a number, and the 8 after these, ..."""
    n = len(joined)
    padded = np.concatenate([joined, np.zeros(8 * depth + 8, np.uint8)]).astype(np.uint64)
    first = np.zeros(n + 8 * depth, np.uint64)
    for j in range(8):
        first = (first << np.uint64(8)) | padded[j : j + len(first)]
    return [first[8 * d : 8 * d + n] for d in range(depth)]


def _suffix_array(first, length):
    """Positions in the order of their next ``length`` bytes at least."""
    n = len(first)
    order = np.argsort(first)
    sorted_ = first[order]
    done = 8
    while done < length:
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(0, sorted_[1:] != sorted_[:-1]))
        after = np.zeros(n, np.int64)
        after[: max(n - done, 0)] = rank[done:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        sorted_ = key[order]
        done *= 2
    return order


def _by_heap(begin, stop, score):
    """Relax one long chunk: joins by falling score, leftmost first."""
    begin, stop = begin.tolist(), stop.tolist()
    n = len(begin)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple] = []

    def push(i):
        j = after[i] if i >= 0 else n
        if i >= 0 and j < n:
            s = score(begin[i], stop[j])
            if s > -np.inf:
                heapq.heappush(heap, (-s, begin[i], i, j, stop[j]))

    for i in range(n):
        push(i)
    while heap:
        _, _, i, j, to = heapq.heappop(heap)
        if not (alive[i] and alive[j] and after[i] == j and stop[j] == to):
            continue
        stop[i], alive[j], after[i] = stop[j], False, after[j]
        if after[j] < n:
            before[after[j]] = i
        push(before[i])
        push(i)
    left = [i for i in range(n) if alive[i]]
    return np.array([begin[i] for i in left]), np.array([stop[i] for i in left])
