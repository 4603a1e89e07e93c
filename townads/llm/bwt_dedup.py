"""Removal of byte strings that an earlier document holds already, through merged Burrows-Wheeler transforms.

A match is ``length`` bytes. Its key is the least 16-byte value in it (of equal ones the first), so equal
matches have equal keys, wherever they stand. Consecutive matches of one document with the same key place
are one string; the strings of a block of documents that share a bucket of keys are a shard. Of the bytes beside the
key a match has half on its left or more than half on its right; a value of these and the key is its print.

1. Each block sends the distinct prints of its strings, two at most for each; those that two documents have are
   sent back. All other matches cannot repeat and go no further.
2. Each block describes the strings that are left, once each: a value of all bytes, and the least document
   that has it. Of the blocks that have a string, its bucket chooses one. That block cuts it out and sends what it
   was chosen for, each shard as its Burrows-Wheeler transform; so a string is sorted, sent and merged once,
   however many blocks hold it.
3. Each bucket merges its shards' transforms: the interleave of their suffixes starts as one after the other
   and is refined by stable distribution along the transforms, some symbols at a step, until it is the order by
   the first ``length`` symbols. Where neighbours part for the first time is noted in each step; the
   intervals that no step parted are the suffixes with a common prefix of ``length``. Of each interval the least
   document is found, and a block is told which of its strings hold matches that begin in a smaller one.
4. Each block marks the matches and cuts them out.

A bucket holds about ``BUCKET_BYTES`` of the input at any size. A passage of a third of all documents is one
string in each block, whatever number of them hold it there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from townads.llm.frames import stored, table, text_bytes
from townads.llm.words import buffers, give_back, mixed, parts, thrifty

LENGTH = 50
KEY = 16  # bytes of a key; matches are longer
BLOCK_BYTES = 4 << 20  # texts that a task looks at together; a longer text alone
BUCKET_BYTES = 8 << 20
PART_BYTES = 1 << 18  # what of a bucket is merged at a time
_PRINT_BITS = 28  # within a bucket; prints only choose what is compared
_SLICE = 1 << 20
_ORDERED = 1 << 18  # symbols that are put in order together, about
_PLACE_BITS = 21  # of a place in a slice and the match that begins at its end
_LAST = (1 << 63) - 1  # stands for a missing id: such a row comes after all others
_STEP = 7  # symbols of 9 bits in a number
_U = np.uint64
# What a block tells a bucket of its strings: piece, bytes, least id and what the greatest is beyond it, place in the
# block, value of all bytes, and further copies.
_SHARD = {
    "piece": np.int32,
    "sizes": np.int32,
    "least": np.int64,
    "most": np.int64,
    "begin": np.int64,
    "value": np.uint64,
    "copies": np.int64,
    "copy_of": np.int32,
}
_WANTED = {"piece": np.int32, "begin": np.int64, "sizes": np.int32}  # of the strings that a block is chosen for
_TRANSFORM = {"heads": np.int32, "symbols": np.uint8}  # of these, by piece: ranks of whole strings, and the symbols


def _pressed(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


def _plain(x: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), kind)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows, each as one compressed value."""
    own = TaskContext.get().partitionId()
    for n, rows in enumerate(part for batch in batches for part in parts(batch, "text", BLOCK_BYTES)):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows.combine_chunks())
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{own}-{n}"]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"]
        )


def _unpack(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


def _values(data: np.ndarray) -> np.ndarray:
    """A value of every KEY bytes in a row, that is of two numbers of eight."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    out = eight[: len(data) - KEY + 1] * _U(0x9E3779B97F4A7C15)
    out ^= out >> _U(29)
    out += eight[8:]
    out *= _U(0xBF58476D1CE4E5B9)
    out ^= out >> _U(32)
    out *= _U(0x94D049BB133111EB)
    return out


def _deltas(x: np.ndarray) -> bytes:
    """Ascending numbers, small when pressed."""
    return _pressed(np.diff(x.astype(np.uint32), prepend=np.uint32(0)))


def _summed(x: bytes) -> np.ndarray:
    return np.cumsum(_plain(x, np.uint32), dtype=np.uint32)


def _key_places(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(begin, matches, key, matches by the left print, left and right print) of each string, in slices of whole rows
    or of a long row.

    A string never reaches over two slices, as matches with one key place do; there it is two strings.
    """
    window = length - KEY + 1
    beside = window // 2  # bytes left of the key that the left print takes; the right print takes window - beside
    cuts = np.unique(offsets)
    low = int(cuts[0])
    while low < cuts[-1]:
        # As many whole rows as fit, or a part of a longer row.
        high = int(cuts[np.searchsorted(cuts, low + _SLICE, side="right") - 1])
        to = high if high > low else min(low + _SLICE, int(cuts[np.searchsorted(cuts, low, side="right")]))
        row_end = int(cuts[np.searchsorted(cuts, to - 1, side="right")])
        end = min(row_end, to + length - 1)
        if end - low >= length:
            values = _values(data[low:end])
            # Value and place in one number; its minimum over a window, by doubling, is the first least value.
            bits = _U(_PLACE_BITS)
            least = (values >> bits << bits) | np.arange(len(values), dtype=np.uint64)
            size = 1
            while 2 * size <= window:
                least = np.minimum(least[:-size], least[size:])
                size *= 2
            if size < window:
                least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
            place = (least & ((_U(1) << bits) - _U(1))).astype(np.int32)
            # Matches within one row only; a string begins with a new place or a new row.
            fresh = np.append(True, place[1:] != place[:-1])
            inside = np.ones(len(place), dtype=bool)
            inside[max(to - low, 0) :] = False
            for cut in (cuts[np.searchsorted(cuts, low, side="right") : np.searchsorted(cuts, end, side="right")] - low).tolist():
                inside[max(cut - length + 1, 0) : cut] = False
                if cut < len(fresh):
                    fresh[cut] = True
            at = np.flatnonzero(fresh & inside)
            if len(at):
                # A string ends where the next begins or where no match is.
                ends = np.flatnonzero(np.append(fresh[1:] | ~inside[1:], True) & inside) + 1
                place = place[at].astype(np.int64)
                left = np.clip(place - beside + 1 - at, 0, ends - at)
                yield at + low, ends - at, values[place], left, *_prints(values, place, beside, window - beside)
        low = to


def _prints(values: np.ndarray, place: np.ndarray, left: int, right: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of the key and of bytes from ``left`` before it, and of the key and of bytes to ``right`` after it."""
    key = values[place]
    before, near = (values[np.maximum(place - n, 0)] for n in (left, min(left, KEY)))
    after, close = (values[np.minimum(place + n, len(values) - 1)] for n in (right, min(right, KEY)))
    return (
        mixed(key + (before ^ near >> _U(1)) * _U(0x9E3779B97F4A7C15)) >> _U(64 - _PRINT_BITS),
        mixed(key + (after ^ close >> _U(1)) * _U(0xD6E8FEB86659FD93)) >> _U(64 - _PRINT_BITS),
    )


def _places(rows: pa.Table, length: int) -> tuple[np.ndarray, ...]:
    """Bytes, ids, row offsets, and of each string: begin, matches, row and value of its key; how many of its matches,
    the first ones, have the left print; the prints."""
    data, offsets = buffers(rows["text"])
    ids = rows["key"].to_numpy()
    found = list(_key_places(data, offsets, length)) if len(offsets) > 1 else []
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return data, ids, offsets, none, none, none, none.astype(np.uint64), none, none.astype(np.uint64), none.astype(np.uint64)
    begin, matches, keys, *prints = (np.concatenate(column) for column in zip(*found))
    return data, ids, offsets, begin, matches, np.searchsorted(offsets, begin, side="right") - 1, mixed(keys), *prints


def _strings(rows: pa.Table, length: int) -> tuple[np.ndarray, ...]:
    """Bytes, ids, row offsets, and of each string: begin, matches, row and value of its key."""
    return _places(rows, length)[:7]


def _send_keys(length: int, buckets: int) -> Callable:
    """Per block and bucket of keys the distinct prints, apart by whether two ids have them."""
    schema = pa.schema([("bucket", pa.int64()), ("block", pa.string()), ("one", pa.binary()), ("more", pa.binary())])
    bits = _U(_PRINT_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch["block"].to_pylist(), batch["rows"]):
                _, ids, _, _, matches, row, keys, by_left, left, right = _places(_unpack(packed.as_py()), length)
                if not len(keys):
                    continue
                bucket = keys % _U(buckets) << bits
                has_left, has_right = by_left > 0, by_left < matches
                prints = np.concatenate([(bucket | left)[has_left], (bucket | right)[has_right]])
                whose = ids[np.concatenate([row[has_left], row[has_right]])]
                order = np.argsort(prints)
                prints, whose = prints[order], whose[order]
                at = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
                several = np.minimum.reduceat(whose, at) < np.maximum.reduceat(whose, at)
                prints = prints[at]
                bucket, prints = prints >> bits, prints & (_U(1) << bits) - _U(1)
                cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
                out = [
                    (int(bucket[a]), block, _deltas(prints[a:b][~several[a:b]]), _deltas(prints[a:b][several[a:b]]))
                    for a, b in zip(cuts[:-1], cuts[1:])
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _shared_keys(group: pa.Table) -> pa.Table:
    """To each block its prints of a bucket that more than one document has."""
    one = [_summed(x.as_py()) for x in group["one"]]
    more = [_summed(x.as_py()) for x in group["more"]]
    single = np.concatenate(one)
    every = np.sort(np.concatenate([single, *more]))
    # Each block sends a print once, so two are of two blocks; and ids are rarely the same in both.
    shared = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *more]))
    if not len(shared):
        return pa.table({"block": pa.array([], pa.string()), "bucket": pa.array([], pa.int64()), "prints": pa.array([], pa.binary())})
    hit = shared[np.minimum(np.searchsorted(shared, single), len(shared) - 1)] == single
    ends = np.cumsum([len(x) for x in one])
    found = [np.sort(np.concatenate([a[mine], b])) for a, b, mine in zip(one, more, np.split(hit, ends[:-1]))]
    kept = pa.array([i for i, x in enumerate(found) if len(x)], pa.int64())
    return pa.table(
        {"block": group["block"].take(kept), "bucket": group["bucket"].take(kept), "prints": pa.array([_deltas(x) for x in found if len(x)], pa.binary())}
    )


def _expanded(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers from each start on, as many as its size."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _suffix_order(text: np.ndarray, rest: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Places of ``text`` by shard, suffix up to its terminator 0, and string. ``rest`` is what is left to it."""
    n = len(text)
    depth = 5 if int(shard[-1]) < 1 << 19 else 2  # as many symbols as fit beside the shard's number
    padded = np.append(text, np.zeros(8, text.dtype)).astype(np.uint64)
    key = shard.astype(np.uint64)
    for i in range(depth):
        key = key << _U(9) | padded[i : i + n] * (rest >= i)
    order = np.argsort(key)
    key = key[order]
    slots = np.arange(n)  # places in the order that may still change, in groups of equal ones
    while True:
        fresh = np.append(True, key[1:] != key[:-1])
        tied = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
        if not len(tied):
            return order
        slots, group = slots[tied], np.cumsum(fresh)[tied]
        places = order[slots]
        left = rest[places]
        key = np.zeros(len(places), dtype=np.uint64)
        for i in range(depth, depth + 4):
            key = key << _U(9) | padded[np.minimum(places + i, n)] * (left >= i)
        # Suffixes that have ended are equal; their strings' order decides.
        key = np.where(left < depth, places.astype(np.uint64), key) | group.astype(np.uint64) << _U(36)
        by = np.argsort(key)
        order[slots], key = places[by], key[by]
        depth += 4


def _string_values(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A value of all bytes of each string, eight at a time; the last eight may overlap those before."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    value = sizes.astype(np.uint64) * _U(0x9E3779B97F4A7C15)

    def read(value: np.ndarray, at: np.ndarray) -> np.ndarray:
        value = (value ^ eight[at]) * _U(0xBF58476D1CE4E5B9)
        return value ^ value >> _U(32)

    least = int(sizes.min()) - 8
    for i in range(0, int(sizes.max()) - 8, 8):
        if i < least:
            value = read(value, begin + i)
        else:
            here = np.flatnonzero(sizes - 8 > i)
            value[here] = read(value[here], begin[here] + i)
    return mixed(read(value, begin + sizes - 8))


def _repeatable(
    shared: pa.Table, begin: np.ndarray, matches: np.ndarray, by_left: np.ndarray, bucket: np.ndarray, *values: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Begin and number of those matches of each string whose print is shared; where keys are told and not prints, of
    the strings with these keys."""
    keys, left, right = values
    of = shared["bucket"].to_pylist()
    if "prints" not in shared.column_names:
        wanted = [np.frombuffer(x.as_py(), np.uint32).astype(np.uint64) | _U(b) << _U(32) for b, x in zip(of, shared["keys"])]
        return begin, np.where(np.isin(keys >> _U(32) | bucket << _U(32), np.concatenate(wanted)), matches, 0)
    bits = _U(_PRINT_BITS)
    wanted = np.sort(np.concatenate([_summed(x.as_py()) | _U(b) << bits for b, x in zip(of, shared["prints"])]))

    def told(prints: np.ndarray) -> np.ndarray:
        prints = bucket << bits | prints
        return wanted[np.minimum(np.searchsorted(wanted, prints), len(wanted) - 1)] == prints

    first = np.where(told(left), 0, by_left)
    return begin + first, np.where(told(right), matches, by_left) - first


def _send_shards(length: int, buckets: int, pieces: int) -> Callable:
    """Per block and bucket: its distinct strings with a shared key, by piece and value, and whose they are."""
    schema = pa.schema([("bucket", pa.int64()), ("block", pa.string()), *((n, pa.binary()) for n in _SHARD)])

    def run(_: tuple, packed: pa.Table, shared: pa.Table) -> pa.Table:
        empty = pa.table({f.name: pa.array([], f.type) for f in schema})
        if not packed.num_rows or not shared.num_rows:
            return empty
        data, ids, _, begin, matches, row, keys, by_left, left, right = _places(_unpack(packed["rows"][0].as_py()), length)
        bucket = keys % _U(buckets)
        begin, matches = _repeatable(shared, begin, matches, by_left, bucket, keys, left, right)
        mine = np.flatnonzero(matches > 0)
        if not len(mine):
            return empty
        begin, whose, sizes = begin[mine], ids[row[mine]], matches[mine] + length - 1
        shard = bucket[mine].astype(np.int64) * pieces + (mixed(keys[mine]) % _U(pieces)).astype(np.int64)
        # Equal strings are one, by a value of all their bytes.
        value = _string_values(data, begin, sizes)
        order = np.lexsort((value, shard))
        begin, sizes, whose, shard, value = (x[order] for x in (begin, sizes, whose, shard, value))
        fresh = np.append(True, (value[1:] != value[:-1]) | (shard[1:] != shard[:-1]))
        at = np.flatnonzero(fresh)
        least, most = np.minimum.reduceat(whose, at), np.maximum.reduceat(whose, at)
        copy_of = np.cumsum(fresh)[~fresh] - 1
        copies = begin[~fresh]
        begin, sizes, shard, value = (x[at] for x in (begin, sizes, shard, value))
        bucket, piece = np.divmod(shard, pieces)
        out = []
        cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        split = np.searchsorted(copy_of, cuts)
        for a, b, c, d in zip(cuts[:-1], cuts[1:], split[:-1], split[1:]):
            columns = (piece[a:b], sizes[a:b], least[a:b], most[a:b] - least[a:b], begin[a:b], value[a:b], copies[c:d], copy_of[c:d] - a)
            sent = (_pressed(x.astype(kind)) for x, kind in zip(columns, _SHARD.values()))
            out.append((int(bucket[a]), packed["block"][0].as_py(), *sent))
        give_back()
        return pa.table({f.name: pa.array(c, f.type) for f, c in zip(schema, zip(*out))}, schema=schema)

    return run


def _told(group: pa.Table) -> tuple[list[str], dict[str, list[np.ndarray]], np.ndarray, np.ndarray, np.ndarray]:
    """What blocks told a bucket: the blocks in order, their columns, and of all strings one after the other the block's
    number, the number of the string among different ones by piece, and of each of these which one is sent."""
    group = group.sort_by("block")
    read = {n: [_plain(x.as_py(), kind) for x in group[n]] for n, kind in _SHARD.items()}
    whose = np.repeat(np.arange(group.num_rows), [len(x) for x in read["sizes"]])
    piece, value = np.concatenate(read["piece"]), np.concatenate(read["value"])
    order = np.lexsort((value, piece))
    piece, value = piece[order], value[order]
    fresh = np.append(True, (value[1:] != value[:-1]) | (piece[1:] != piece[:-1]))
    same = np.empty(len(order), dtype=np.int64)
    same[order] = np.cumsum(fresh) - 1
    # Any of the blocks that have a string may send it; its value chooses, so that all send about as much.
    at = np.flatnonzero(fresh)
    held = np.diff(np.append(at, len(order))).astype(np.uint64)
    chosen = order[at + (mixed(value[at]) % held).astype(np.int64)]
    return group["block"].to_pylist(), read, whose, same, chosen


def _choose(group: pa.Table) -> pa.Table:
    """To each block the strings of a bucket that it is to send."""
    blocks, read, whose, _, chosen = _told(group)
    chosen = np.sort(chosen)
    columns = [np.concatenate(read[n])[chosen] for n in _WANTED]
    bounds = np.searchsorted(whose[chosen], np.arange(len(blocks) + 1))
    bucket = group["bucket"][0].as_py()
    out = [(blocks[r], bucket, *(_pressed(x[a:b]) for x in columns)) for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if a < b]
    kinds = {"block": pa.string(), "bucket": pa.int64()} | dict.fromkeys(_WANTED, pa.binary())
    return pa.table({n: pa.array([x[i] for x in out], t) for i, (n, t) in enumerate(kinds.items())})


def _send_transforms(pieces: int) -> Callable:
    """Per block and bucket: the strings that the block is chosen for as transforms."""
    schema = pa.schema([("bucket", pa.int64()), ("block", pa.string()), *((n, pa.binary()) for n in _TRANSFORM)])

    def run(_: tuple, packed: pa.Table, wanted: pa.Table) -> pa.Table:
        if not packed.num_rows or not wanted.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in schema})
        data, _ = buffers(_unpack(packed["rows"][0].as_py())["text"])
        read = {n: [_plain(x.as_py(), kind) for x in wanted[n]] for n, kind in _WANTED.items()}
        piece, begin, sizes = (np.concatenate(read[n]).astype(np.int64) for n in _WANTED)
        cuts = np.append(0, np.cumsum([len(x) for x in read["sizes"]]))
        buckets = wanted["bucket"].to_pylist()
        shard = np.repeat(np.arange(len(buckets)), np.diff(cuts)) * pieces + piece
        out = []
        # Whole shards that have about a slice of symbols together are put in order together.
        filled = np.append(0, np.cumsum(sizes + 1))
        at = 0
        while at < len(buckets):
            low = cuts[at]
            to = max(at + 1, int(np.searchsorted(filled[cuts[1:]], filled[low] + _ORDERED, side="right")))
            high = cuts[to]
            heads, symbols, _ = _transforms(data, begin[low:high], sizes[low:high], shard[low:high])
            for i in range(at, to):
                a, b = cuts[i], cuts[i + 1]
                columns = (heads[a - low : b - low], symbols[filled[a] - filled[low] : filled[b] - filled[low]])
                sent = (_pressed(x.astype(kind)) for x, kind in zip(columns, _TRANSFORM.values()))
                out.append((buckets[i], packed["block"][0].as_py(), *sent))
            at = to
        give_back()
        return pa.table({f.name: pa.array(c, f.type) for f, c in zip(schema, zip(*out))}, schema=schema)

    return run


def _transforms(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of strings by shard: ranks of whole strings within the shard's transform, the symbols of all
    transforms one after the other, and what each string takes of them."""
    # All strings one after the other, each with its terminator.
    own = sizes + 1
    first = np.cumsum(own) - own
    text = data[np.minimum(_expanded(begin, own), len(data) - 1)].astype(np.uint16) + np.uint16(1)
    text[first + sizes] = 0
    rest = np.repeat(first + sizes, own) - np.arange(len(text))
    fresh = np.append(True, shard[1:] != shard[:-1])
    dense = np.cumsum(fresh) - 1
    ordered = _suffix_order(text, rest, np.repeat(dense, own))
    symbols = np.maximum(text[ordered - 1], 1).astype(np.uint16) - 1  # of a head it does not matter
    rank = np.empty(len(text), dtype=np.int64)
    rank[ordered] = np.arange(len(text))
    return rank[first] - first[fresh][dense], symbols, own


def _walk(symbols: np.ndarray, heads: np.ndarray, shard: np.ndarray, shard_first: np.ndarray, string_first: np.ndarray) -> np.ndarray:
    """Of each element of the shards' transforms the element one symbol to the left; from a head to its terminator."""
    key = (shard.astype(np.uint64) << _U(9) | symbols) << _U(32) | np.arange(len(symbols), dtype=np.uint64)
    order = (np.sort(key) & _U(0xFFFFFFFF)).astype(np.int64)
    back = np.empty(len(symbols), dtype=np.int32)
    back[order] = np.arange(len(symbols), dtype=np.int32)
    # The terminators come first in a shard, in the order of its strings.
    own = shard[heads]
    back[heads] = shard_first[own] + np.arange(len(heads)) - string_first[own]
    return back


def merged(symbols: np.ndarray, back: np.ndarray, length: int, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of the shards' elements by their first ``length`` symbols, and the number of the
    interval of equal ones that each place belongs to. Of ``starts``, only of the elements that lie ``length`` symbols
    left of these."""
    n = len(symbols)
    source = np.arange(n, dtype=np.int32) if starts is None else starts.astype(np.int32)
    interval = np.zeros(len(source), dtype=np.int32)
    places = np.arange(len(source), dtype=np.uint64)

    def refined(ranks: np.ndarray, jump: np.ndarray) -> None:
        # A stable distribution of the interleave by the symbols to the left, which then come first.
        nonlocal source, interval
        key = ranks[source]
        key <<= _U(32)
        key |= places
        key.sort()
        order = (key & _U(0xFFFFFFFF)).astype(np.int32)
        key >>= _U(32)
        source, before = jump[source[order]], interval[order]
        parted = key[1:] != key[:-1]
        parted |= before[1:] != before[:-1]
        interval[0] = 0
        np.cumsum(parted, dtype=np.int32, out=interval[1:])

    wide = symbols.astype(np.uint64)
    steps = length // _STEP
    if steps:
        chunk, jump = wide, back
        for i in range(1, _STEP):
            chunk = chunk | wide[jump] << _U(9 * i)
            jump = back[jump]
        # The chunks numbered in order.
        order = np.argsort(chunk)
        chunk = chunk[order]
        ranks = np.zeros(n, dtype=np.uint64)
        ranks[order[1:]] = np.cumsum(chunk[1:] != chunk[:-1])
        del chunk
        for _ in range(steps):
            refined(ranks, jump)
    for _ in range(length - steps * _STEP):
        refined(wide, back)
    return source, interval


def _shared_ranges(
    length: int, row: np.ndarray, sizes: np.ndarray, heads: np.ndarray, symbols: np.ndarray, lowest: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Of different strings by shard, which ``row`` numbers, with their transforms and the least document of each:
    ranges of matches of a string that begin in the same least document, as string, from, to, document."""
    own = sizes + 1
    first = np.cumsum(own) - own
    string_first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    shard_first = first[string_first]
    shard = np.repeat(np.arange(len(string_first)), np.diff(np.append(string_first, len(row))))
    heads = heads + shard_first[shard]
    symbols = symbols.astype(np.uint16) + np.uint16(1)
    symbols[heads] = 0
    back = _walk(symbols, heads, np.repeat(shard, own), shard_first, string_first)
    # Which match of which string an element begins, by going left from the terminators.
    matches = sizes - length + 1
    match_first = np.cumsum(matches) - matches
    match = np.empty(len(symbols), dtype=np.int32)
    starts = np.zeros(len(symbols), dtype=bool)  # from where ``length`` symbols to the left a match begins
    here = shard_first[shard] + np.arange(len(sizes)) - string_first[shard]
    active, until, most = np.arange(len(sizes)), int(sizes.min()), int(sizes.max())
    for step in range(most + 1):
        if step > until:
            going = np.flatnonzero(sizes[active] >= step)
            active, here = active[going], here[going]
        if step:
            here = back[here]
        if step <= most - length:
            starts[here if step <= until - length else here[sizes[active] - length >= step]] = True
        if step >= length:
            match[here] = match_first[active] + sizes[active] - step
    source, interval = merged(symbols, back, length, np.flatnonzero(starts))
    place = match[source]
    string_of = np.repeat(np.arange(len(sizes), dtype=np.int32), matches)
    group_first = np.flatnonzero(np.append(True, interval[1:] != interval[:-1]))
    first_seen = np.minimum.reduceat(lowest[string_of[place]], group_first)
    origin = np.empty(len(place), dtype=np.int64)
    origin[place] = np.repeat(first_seen, np.diff(np.append(group_first, len(place))))
    cut = np.append(True, (origin[1:] != origin[:-1]) | (string_of[1:] != string_of[:-1]))
    low = np.flatnonzero(cut)
    high = np.append(low[1:], len(origin))
    string = string_of[low]
    return string, low - match_first[string], high - match_first[string], origin[low]


def _merge_shards(length: int) -> Callable:
    """To each block: its strings' matches, as ranges, that begin in a smaller document than some copy's."""
    kinds = {"block": pa.string()} | dict.fromkeys(("begin", "low", "high", "least", "copies", "copied"), pa.binary())

    def run(_: tuple, told: pa.Table, shards: pa.Table) -> pa.Table:
        if not told.num_rows:
            return pa.table({n: pa.array([], t) for n, t in kinds.items()})
        blocks, read, whose, same, chosen = _told(told)
        sizes, least, most, begin = (np.concatenate(read[n]).astype(np.int64) for n in ("sizes", "least", "most", "begin"))
        lowest = np.full(len(chosen), _LAST, dtype=np.int64)
        np.minimum.at(lowest, same, least)
        # The strings sent lie by block and piece in the transforms; they are taken by piece and block.
        shards = shards.sort_by("block")
        heads, symbols = (np.concatenate([_plain(x.as_py(), kind) for x in shards[n]]) for n, kind in _TRANSFORM.items())
        sent = np.sort(chosen)
        own = sizes[sent] + 1
        first = np.cumsum(own) - own
        piece = np.concatenate(read["piece"])[sent]
        order = np.argsort(piece, kind="stable")
        piece = piece[order]
        cuts = np.append(np.flatnonzero(np.append(True, piece[1:] != piece[:-1])), len(piece))
        found = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            some = order[a:b]
            string = sent[some]
            elements = _expanded(first[some], own[some])
            ranges = _shared_ranges(length, whose[string], sizes[string], heads[some], symbols[elements], lowest[same[string]])
            found.append((same[string[ranges[0]]], *ranges[1:]))
        of, low, high, origin = (np.concatenate(c) for c in zip(*found))
        # From the different strings to each block's.
        order = np.argsort(of, kind="stable")
        bounds = np.searchsorted(of[order], np.arange(len(chosen) + 1))
        a, b = bounds[same], bounds[same + 1]
        s, at = np.repeat(np.arange(len(sizes)), b - a), order[_expanded(a, b - a)]
        low, high, origin = low[at], high[at], origin[at]
        gone = np.flatnonzero(origin < least[s] + most[s])
        low, high, s, origin = low[gone].astype(np.int16), high[gone].astype(np.int16), s[gone], origin[gone]
        strings = np.searchsorted(whose, np.arange(len(blocks) + 1))
        bounds = np.searchsorted(s, strings)
        out = []
        for r, block in enumerate(blocks):
            a, b = bounds[r], bounds[r + 1]
            if a == b:
                continue
            copies, copy_of = read["copies"][r], read["copy_of"][r]
            number = s[a:b] - strings[r]
            twice = np.isin(copy_of, number)
            columns = (begin[s[a:b]], low[a:b], high[a:b], origin[a:b], copies[twice], begin[strings[r] + copy_of[twice]])
            out.append((block, *map(_pressed, columns)))
        give_back()
        return pa.table({n: pa.array([x[i] for x in out], t) for i, (n, t) in enumerate(kinds.items())})

    return run


def _answers(answers: pa.Table, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last begin of every range of matches to remove."""
    begin, low, high, origin, copies, of = (
        np.concatenate([_plain(x.as_py(), kind) for x in answers[n]])
        for n, kind in (("begin", np.int64), ("low", np.int16), ("high", np.int16), ("least", np.int64), ("copies", np.int64), ("copied", np.int64))
    )
    order = np.argsort(begin, kind="stable")
    begin, low, high, origin = begin[order], low[order].astype(np.int64), high[order].astype(np.int64), origin[order]
    a, b = np.searchsorted(begin, of, side="left"), np.searchsorted(begin, of, side="right")
    at = np.concatenate([np.arange(len(begin)), _expanded(a, b - a)])
    where = np.concatenate([begin, np.repeat(copies, b - a)])
    whose = ids[np.searchsorted(offsets, where, side="right") - 1]
    gone = origin[at] < whose
    return (where + low[at])[gone], (where + high[at] - 1)[gone]


def _cut(length: int, names: list[str], schema: pa.Schema) -> Callable:
    def run(_: tuple, packed: pa.Table, answers: pa.Table) -> pa.Table:
        rows = _unpack(packed["rows"][0].as_py())
        data, offsets = buffers(rows["text"])
        base = int(offsets[0])
        removed = np.zeros(int(offsets[-1]) - base, dtype=bool)
        if answers.num_rows:
            opens, closes = _answers(answers, rows["key"].to_numpy(), offsets)
            depth = np.zeros(len(removed) + 1, dtype=np.int32)
            np.add.at(depth, opens - base, 1)
            np.add.at(depth, closes - base + length, -1)
            removed = np.cumsum(depth[:-1]) > 0
        made: dict[str, list] = {n: [] for n in ("n_bytes", "n_removed", "removed", "left")}
        for low, high in zip((offsets[:-1] - base).tolist(), (offsets[1:] - base).tolist()):
            gone = removed[low:high]
            edges = np.flatnonzero(np.diff(gone.view(np.int8), prepend=0, append=0)).reshape(-1, 2)
            own = data[low + base : high + base]
            made["n_bytes"].append(high - low)
            made["n_removed"].append(int(gone.sum()))
            made["removed"].append(edges.tolist())
            made["left"].append((own[~gone] if len(edges) else own).tobytes())
        made["n_spans"] = [len(x) for x in made["removed"]]
        if "kept_sha256" in names:
            made["kept_sha256"] = [hashlib.sha256(x).hexdigest() for x in made["left"]]
        return pa.table([pa.array(made[f.name], f.type) if f.name in made else rows[f.name] for f in schema], schema=schema)

    return run


def remove_repeated_bytes(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    outputs: tuple[str, ...] = ("n_bytes", "n_removed", "removed", "left"),
) -> DataFrame:
    """Each row's id with what is left of the UTF-8 bytes of its text.

    A byte goes if a string of ``length`` bytes covers it that also starts in a row with a smaller id.
    Matches lie within one row, may overlap, and are judged on the input, not on what is left.

    Outputs to choose from: ``n_bytes``; ``n_removed``; ``removed``, the maximal [from, to) ranges that go;
    ``n_spans``, their number; ``left``, the bytes that stay (binary, as a cut may split a character);
    ``kept_sha256`` of these.

    Nulls and edges: a null or empty text has no bytes; texts shorter than ``length`` keep all; a null id comes
    after all others, and rows with equal ids never remove each other's bytes; repetition within one row stays;
    an empty table gives an empty one. Ids are integers. Only the two columns are read. ``length`` is 17 to
    16,000. Strings are equal by 64-bit values of all their bytes; whether matches are equal is decided exactly.
    """
    if not KEY < length <= 16_000:
        raise ValueError("matches are 17 to 16,000 bytes long")
    rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(_LAST)).alias("key"), F.col(id).alias("own_id"), F.col(text).alias("text"))
    total = text_bytes(docs, text)
    buckets, pieces = 1 + total // BUCKET_BYTES, max(1, BUCKET_BYTES // PART_BYTES)
    packed = stored(rows.mapInArrow(_pack, "block string, rows binary"), "byte-blocks")
    shared = (
        packed.mapInArrow(_send_keys(length, buckets), "bucket long, block string, one binary, more binary")
        .groupBy("bucket")
        .applyInArrow(thrifty(_shared_keys), "block string, bucket long, prints binary")
    )
    told = (
        packed.groupBy("block")
        .cogroup(shared.groupBy("block"))
        .applyInArrow(_send_shards(length, buckets, pieces), "bucket long, block string, " + ", ".join(f"{c} binary" for c in _SHARD))
    )
    wanted = told.groupBy("bucket").applyInArrow(thrifty(_choose), "block string, bucket long, " + ", ".join(f"{c} binary" for c in _WANTED))
    shards = (
        packed.groupBy("block")
        .cogroup(wanted.groupBy("block"))
        .applyInArrow(_send_transforms(pieces), "bucket long, block string, " + ", ".join(f"{c} binary" for c in _TRANSFORM))
    )
    answers = (
        told.groupBy("bucket")
        .cogroup(shards.groupBy("bucket"))
        .applyInArrow(_merge_shards(length), "block string, begin binary, low binary, high binary, least binary, copies binary, copied binary")
    )
    kinds = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "removed": "array<array<bigint>>", "left": "binary", "kept_sha256": "string"}
    ddl = ", ".join([f"own_id {rows.schema['own_id'].dataType.simpleString()}", *(f"{n} {kinds[n]}" for n in outputs)])
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_cut(length, list(outputs), schema), ddl).toDF(id, *outputs)


def op12_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents without the 50-byte strings of earlier ones, as numbers and digests."""
    return remove_repeated_bytes(table(spark, sf_dir, "documents"), outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256"))


_ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(doc_id, {_LAST}) AS own, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
    SELECT r, own, i, substr(h, 2 * i + 1, {2 * LENGTH}) AS w
    FROM (SELECT r, own, h, unnest(range(0, len(h) // 2 - {LENGTH} + 1)) AS i FROM d)
),
firsts AS (SELECT w, min(own) AS least FROM windows GROUP BY w HAVING min(own) < max(own)),
gone AS (SELECT r, i FROM windows JOIN firsts USING (w) WHERE own > least),
opened AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + {LENGTH}, TRUE) AS fresh FROM gone),
numbered AS (SELECT r, i, sum(fresh::INT) OVER (PARTITION BY r ORDER BY i) AS k FROM opened),
spans AS (SELECT r, min(i) AS a, max(i) + {LENGTH} AS b FROM numbered GROUP BY r, k),
pieces AS (
    SELECT r, b AS a, lead(a) OVER (PARTITION BY r ORDER BY a, b) AS b FROM (SELECT r, a, b FROM spans UNION ALL SELECT r, 0, 0 FROM d)
),
kept AS (
    SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, len(h) // 2) - a)), '' ORDER BY a, coalesce(b, len(h))) AS left_hex
    FROM pieces JOIN d USING (r) GROUP BY r
)
SELECT doc_id, len(h) // 2 AS n_bytes, (len(h) - len(left_hex)) // 2 AS n_removed,
       (SELECT count(*) FROM spans WHERE spans.r = d.r) AS n_spans, sha256(unhex(left_hex)) AS kept_sha256
FROM d JOIN kept USING (r)"""

QUERIES = {"op12_repeated_bytes": op12_repeated_bytes}
ORACLE = {"op12_repeated_bytes": _ORACLE}
