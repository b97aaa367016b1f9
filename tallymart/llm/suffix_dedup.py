"""Substring dedup by column-wise construction of a multi-document suffix order, on bytes.

The collection's Burrows-Wheeler order is built as for many short strings: each round puts one
symbol of every string, from its end, before the suffix inserted last.  The new suffix's
place follows from its first symbol and the place of the rest; the place decides where it is
inserted into the sorted collection, and the common prefix with its neighbours is one more than
the least common prefix between the places of their rests.  No suffix is ever compared.

Documents are too long for one round per byte over the whole corpus.  So windows of
``window`` bytes are dealt by their smallest hashed ``GRAM``-gram, which equal windows
share: neighbouring windows with the same gram form one short string.  Strings with a
gram that occurs once in the corpus need no construction.  The others meet in buckets, and the
construction runs over some hundred strings at a time; Spark's shuffle files take the part of the
sequential external files.  Equal strings are one, of a chunk's only the earliest travels, and
a string that is alone with its gram is not ordered.  Of the others only the runs of windows whose
hash occurs again among them are inserted, since a window with a hash of its own equals no other.
Equal runs are one too: the earliest is inserted, the others go whole, which is repeated while it
takes a sixteenth of the windows or more.
Windows with equal first ``window`` bytes are neighbours in the order; the earliest one stays.
Only bytes are compared in the end, so hashes cannot err.

A gram with ``HEAVY`` strings or more (distinct ones, added up over the chunks) would gather too
many in one bucket and one construction; its windows are dealt one by one by a hash of the whole
window instead, so that a key has fewer than ``HEAVY`` strings.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import (
    KEYS,
    REMOVED,
    answers,
    bucket_count,
    chunk_rows,
    filter_width,
    key_batch,
    marks_at,
    marks_of,
    mixed,
    removed_spans,
    sorted_keys,
    stored_chunks,
    total_bytes,
    with_answers,
)
from .substring_dedup import word_marks

WINDOW = 100
GRAM = 24
LONGEST_RUN = 64
CHUNK_BYTES = 2 << 20
HEAVY = 16384
STRINGS = 512
#: Strings whose windows are hashed at once; like STRINGS, more if one key has more.
HASHED = 2048
#: Neighbours that are hashed or compared at once: their arrays stay in a core's cache.
BLOCK = 1 << 15
#: Counts that a key list's flags can name; others are rounded up, and the last is above HEAVY.
LEVELS = np.unique(np.ceil(1.1 ** np.arange(160)).astype(np.int64))[:128]
FAR = np.iinfo(np.int64).max
BYTES = mixed(np.arange(1, 257, dtype=np.uint64))

PIECES = "bucket int, chunk long, keys binary, sizes binary, blob binary, doc binary, no_doc binary, place binary, start binary, spans binary"
SPANS = "chunk long, spans binary"
RESULT = f"doc_id long, n_bytes long, n_removed long, kept binary, spans {REMOVED}"


# Windows of a chunk and their grams.


def in_blocks(run: Callable, values: np.ndarray, size: int) -> np.ndarray:
    """``run``, which makes one number of every ``size`` neighbours, block by block."""
    n = len(values) - size + 1
    if n <= BLOCK:
        return run(values)
    return np.concatenate([run(values[a : min(a + BLOCK, n) + size - 1]) for a in range(0, n, BLOCK)])


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every gram, from hashes of 1, 2, 4, ... bytes."""
    return in_blocks(lambda part: _gram_hashes(part, size), data, size)


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    h, have, parts = BYTES[data], 1, []
    factor = 0x9E3779B97F4A7C15
    while True:
        if size & have:
            parts.append((have, h))
        if have * 2 > size or len(h) <= have:
            break
        h = h[:-have] * np.uint64(pow(factor, have, 1 << 64)) + h[have:]
        have *= 2
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, at = np.zeros(n, np.uint64), 0
    for have, h in parts:
        total = total * np.uint64(pow(factor, have, 1 << 64)) + h[at : at + n]
        at += have
    return mixed(total)


def sliding(values: np.ndarray, size: int, least: bool) -> np.ndarray:
    """Minimum or maximum of every ``size`` neighbours, by doubling."""
    return in_blocks(lambda part: _sliding(part, size, least), values, size)


def _sliding(values: np.ndarray, size: int, least: bool) -> np.ndarray:
    pick, have = (np.minimum if least else np.maximum), 1
    while have * 2 <= size:
        values = pick(values[:-have], values[have:])
        have *= 2
    rest = size - have
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


class Grams:
    """The least gram of every window inside a document, and the chunk's distinct ones."""

    def __init__(self, row: dict, window: int, width: int):
        self.ids, self.sizes = row["ids"], np.array(row["sizes"], np.int64)
        self.data, self.window = np.frombuffer(row["data"], np.uint8), window
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        grams = gram_hashes(self.data, GRAM) >> np.uint64(64 - width)
        n = len(self.data) - window + 1
        if n <= 0:
            self.at, self.least = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            self.distinct, self.flags = sorted_keys(self.least, np.zeros(0, np.uint8))
            return
        reach = window - GRAM + 1
        least = sliding(grams, reach, True)
        inside = np.zeros(n, bool)
        for begin, size in zip(self.begins, self.sizes):
            if size >= window:
                inside[begin : begin + size - window + 1] = True
        self.at = np.flatnonzero(inside)
        self.least = least[self.at]
        # A gram occurs where it equals the least gram of some window that holds it.
        shown = np.where(inside, least, np.uint64(0))
        around = np.concatenate((np.zeros(reach - 1, np.uint64), shown, np.zeros(reach - 1, np.uint64)))
        occurs = np.flatnonzero(sliding(around, reach, False) == grams)
        self.distinct, self.flags = sorted_keys(grams[occurs], np.zeros(len(occurs), np.uint8))

    def counted_flags(self) -> np.ndarray:
        """The flags with the level of the number of strings, for keys that are sent."""
        levels = np.searchsorted(LEVELS, self._counts())
        return self.flags | np.minimum(levels, len(LEVELS) - 1).astype(np.uint8) << 1

    def _counts(self) -> np.ndarray:
        """The number of distinct strings of every distinct gram."""
        first, keys, windows, _ = runs(self.at, self.least, np.zeros(len(self.at), bool))
        slot = np.searchsorted(self.distinct, keys)
        counts = np.bincount(slot, minlength=len(self.distinct))
        some = np.flatnonzero(counts[slot] > 1)
        of, begin = slot[some], first[some]
        marks = word_marks(self.data, begin, begin + windows[some] + self.window - 1)
        order = np.lexsort((marks, of))
        of, marks = of[order], marks[order]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (marks[1:] != marks[:-1])
        counts[of] = 0
        np.add.at(counts, of[new], 1)
        return counts


def runs(at: np.ndarray, least: np.ndarray, apart: np.ndarray):
    """First window, gram, number of windows and ``apart`` of the strings.

    Neighbouring windows with the same gram are one string, up to LONGEST_RUN; those marked in
    ``apart`` are strings of their own.
    """
    if not len(at):
        return at, least, at, apart
    new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1]) | apart[1:]))
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(at)))
    cuts = -(-sizes // LONGEST_RUN)
    which = np.repeat(np.arange(len(heads)), cuts)
    number = np.arange(len(which)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    first = at[heads][which] + number * LONGEST_RUN
    windows = np.minimum(sizes[which] - number * LONGEST_RUN, LONGEST_RUN)
    return first, least[heads][which], windows, apart[heads][which]


def _emit_grams(window: int, width: int, buckets: int):
    def run(batches):
        for row in chunk_rows(batches):
            grams = Grams(row, window, width)
            yield key_batch(row["chunk"], grams.distinct, grams.counted_flags(), width, buckets)

    return run


def _added(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Twice the number of strings of every key, and 1 if a chunk holds the key twice."""
    return 2 * np.add.reduceat(LEVELS[flags >> 1], first) + (np.bitwise_or.reduceat(flags, first) & 1)


def _marks(heavy: int):
    def decide(owners: np.ndarray, added: np.ndarray) -> np.ndarray:
        repeated = (owners > 1) | (added & 1 > 0)
        return np.where(repeated & (added >> 1 >= heavy), 2, repeated.astype(int))

    return decide


# Strings.


def _packed(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def _unpacked(packed: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)


def chunk_strings(grams: Grams, marks: np.ndarray):
    """(key, first window, windows) of the strings that repeated grams give."""
    new = np.append(True, grams.least[1:] != grams.least[:-1])[: len(grams.least)]
    heads = np.flatnonzero(new)
    mark = marks_at(grams.least[heads], grams.distinct, marks)
    mark = np.repeat(mark, np.diff(np.append(heads, len(new))))
    kept = np.flatnonzero(mark > 0)
    first, keys, windows, apart = runs(grams.at[kept], grams.least[kept], mark[kept] == 2)
    keys = keys.copy()
    for k in np.flatnonzero(apart):
        keys[k] = xxhash.xxh3_64_intdigest(grams.data[first[k] : first[k] + grams.window].data)
    return first, keys, windows


def _piece(bucket: int, chunk: int, parts: list) -> pa.RecordBatch:
    """A row of PIECES; absent parts are null."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([bucket], pa.int32()),
            pa.array([chunk], pa.int64()),
            *(pa.array([None if p is None else _packed(p)], pa.binary()) for p in parts),
        ],
        [f.split()[0] for f in PIECES.split(", ")],
    )


def _emit_strings(window: int, width: int, buckets: int):
    def run(batches):
        for row in chunk_rows(batches):
            grams = Grams(row, window, width)
            first, keys, windows = chunk_strings(grams, marks_of(row["grams"]))
            if not len(first):
                continue
            bucket = (mixed(keys) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            doc = np.searchsorted(grams.ends, first, "right")
            ids = np.array([FAR if i is None else i for i in grams.ids], np.int64)
            absent = np.array([i is None for i in grams.ids], np.uint8)
            rank = np.empty(len(ids), np.int64)
            rank[np.lexsort((ids, absent))] = np.arange(len(ids))
            order = np.lexsort((first, rank[doc], keys, bucket))
            bucket = bucket[order]
            edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            later = []
            for a, b in zip(edges, np.append(edges[1:], len(order))):
                seen: set[bytes] = set()
                strings, earliest = [], []
                for k in order[a:b]:
                    s = row["data"][first[k] : first[k] + windows[k] + window - 1]
                    if s in seen:
                        later.append(k)
                        continue
                    seen.add(s)
                    strings.append(s)
                    earliest.append(k)
                of = doc[earliest]
                parts = [
                    keys[earliest],
                    np.array([len(s) for s in strings], np.int32),
                    np.frombuffer(b"".join(strings), np.uint8),
                    ids[of],
                    absent[of],
                    of.astype(np.int32),
                    (first[earliest] - grams.begins[of]).astype(np.int64),
                    None,
                ]
                yield _piece(int(bucket[a]), row["chunk"], parts)
            if later:
                # They go whole, whatever other chunks hold.
                begin = first[later] - grams.begins[doc[later]]
                spans = np.stack((doc[later], begin, begin + windows[later] + window - 1), 1)
                of = int(mixed(np.array([row["chunk"]], np.uint64))[0]) % buckets
                yield _piece(of, row["chunk"], [None] * 7 + [spans.astype(np.int64)])

    return run


# Construction.


def _least_between(prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(prefix[a+1 .. b]) for every pair a < b; ``prefix`` has a number after the last b."""
    # What lies between two pairs is reduced as well and skipped.
    return np.minimum.reduceat(prefix, np.stack((a, b), 1).ravel() + 1)[::2]


def suffix_order(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String number, start and common prefix with the one before, for all suffixes in order.

    Strings have at most 254 bytes.  Ends of strings sort first, by string number.
    """
    m = len(strings)
    sizes = np.array([len(s) for s in strings], np.int64)
    longest = int(sizes.max(initial=0))
    data = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) << 32
    ends = np.cumsum(sizes)
    low = np.int64(0xFFFFFFFF)
    total = m + int(sizes.sum())
    # Buffers for the whole construction: new arrays in every round would cost more than the
    # work on them.
    keys = np.empty(total, np.int64), np.empty(total, np.int64)
    prefixes = np.zeros(total, np.uint8), np.zeros(total, np.uint8)
    shifts, places, moves = (np.empty(total, np.int64) for _ in range(3))
    every = np.arange(total)
    # First symbol << 32 | place of the rest.  The empty suffixes stay at the front, as
    # -1 is below every symbol and nothing is inserted before them.
    keys[0][:m] = -1
    n, place = m, np.arange(m)
    for length in range(1, longest + 1):
        key, prefix = keys[length % 2 - 1][:n], prefixes[length % 2 - 1][:n]
        active = np.flatnonzero(sizes >= length)
        fresh = data[ends[active] - length] | place[active]
        order = np.argsort(fresh)
        active, fresh = active[order], fresh[order]
        before = np.searchsorted(key, fresh)
        at = before + every[: len(fresh)]
        # How far each old place moves: the number of new suffixes at or before it.
        shift = shifts[:n]
        shift.fill(0)
        inner = before[before < n]
        heads = np.flatnonzero(np.diff(inner, prepend=-1))
        shift[inner[heads]] = np.diff(heads, append=len(inner))
        np.cumsum(shift, out=shift)
        moved = np.add(shift, every[:n], out=places[:n])

        grown = n + len(fresh)
        new_key, new_prefix = keys[length % 2][:grown], prefixes[length % 2][:grown]
        new_key[moved] = key
        new_key[at] = fresh
        new_prefix[moved] = prefix
        # Common prefixes change at new suffixes and right after them.
        after = at[np.append(at[1:] != at[:-1] + 1, at[-1] + 1 < grown)] + 1
        touched = np.sort(np.concatenate((at, after)))
        own, other = new_key[touched], new_key[touched - 1]
        new_prefix[touched] = 0
        same = (own >> 32 == other >> 32) & (own >= 0)
        if same.any():
            least = _least_between(prefixes[length % 2 - 1][: n + 1], other[same] & low, own[same] & low)
            new_prefix[touched[same]] = least + 1
        # Places of the rests move as well.
        rest = new_key[m:]
        of = np.bitwise_and(rest, low, out=places[: len(rest)])
        rest += np.take(shift, of, out=moves[: len(rest)], mode="clip")
        place += shift[place]
        place[active] = at
        n = grown
    key, prefix = keys[longest % 2], prefixes[longest % 2]
    # Every suffix names the place of the next shorter one.
    number, start = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
    string, left = np.arange(m), sizes.copy()
    while len(string):
        number[place], start[place] = string, sizes[string] - left[string]
        on = left[string] > 0
        string, place = string[on], key[place[on]] & low
        left[string] -= 1
    return number, start, prefix


def _classes(strings: list[bytes], window: int):
    """For windows that start in the strings: string, start, and the class of equal windows."""
    number, start, prefix = suffix_order(strings)
    sizes = np.array([len(s) for s in strings], np.int64)
    group = np.cumsum(prefix < window)
    whole = sizes[number] - start >= window
    return number[whole], start[whole], group[whole]


def removed_windows(strings, rank, begin, window):
    """Runs (string, first window, end window) of windows with an earlier equal one.

    ``rank`` is the order of the document in which a string occurs first, ``begin`` its place.
    """
    number, start, group = _classes(strings, window)
    order = np.lexsort((begin[number] + start, rank[number], group))
    head = np.concatenate(([True], group[order][1:] != group[order][:-1]))
    later = order[~head]
    gone = np.zeros((len(strings), max(map(len, strings)) - window + 2), np.int8)
    gone[number[later], start[later]] = 1
    steps = np.diff(gone, axis=1, prepend=0)
    s, a = np.nonzero(steps == 1)
    return s, a, np.nonzero(steps == -1)[1]


def key_groups(keys: np.ndarray, least: int):
    """Ranges of at least ``least`` sorted keys, the last one apart; equal keys stay together."""
    begin = 0
    for end in [*(np.flatnonzero(np.diff(keys) != 0) + 1).tolist(), len(keys)]:
        if end - begin >= least or end == len(keys) > begin:
            yield begin, end
            begin = end


def repeated_runs(strings: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, first and end window of the runs of windows whose hash occurs twice or more."""
    sizes = np.array([len(s) for s in strings], np.int64)
    windows = sizes - window + 1
    own = np.repeat(np.arange(len(strings)), windows)
    place = np.arange(len(own)) - np.repeat(np.cumsum(windows) - windows, windows)
    hashes = gram_hashes(np.frombuffer(b"".join(strings), np.uint8), window)
    hashes = hashes[(np.cumsum(sizes) - sizes)[own] + place]
    order = np.argsort(hashes)
    equal = np.zeros(len(order) + 1, bool)
    equal[1:-1] = hashes[order][1:] == hashes[order][:-1]
    again = np.zeros(len(order) + 1, bool)
    again[order] = equal[1:] | equal[:-1]
    new = np.append(place, 0) == 0
    heads = np.flatnonzero(again & (new | ~np.roll(again, 1)))
    tails = np.flatnonzero(again[:-1] & (new[1:] | ~again[1:]))
    return own[heads], place[heads], place[tails] + 1


def later_copies(strings: list[bytes], rank: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Which strings have an equal one that occurs earlier."""
    known: dict[bytes, int] = {}
    number = np.fromiter((known.setdefault(s, len(known)) for s in strings), np.int64, len(strings))
    order = np.lexsort((begin, rank, number))
    later = np.zeros(len(strings), bool)
    later[order[1:]] = number[order[1:]] == number[order[:-1]]
    return later


def repeats_inside(s: bytes, window: int) -> bool:
    """Whether two windows of a string may be equal.

    All of its at most LONGEST_RUN windows hold the gram after the last window's start, so
    equal windows repeat that gram.
    """
    at = len(s) - window
    return window - at < GRAM or s.find(s[at : at + GRAM], 0, at + GRAM - 1) >= 0 or s.find(s[at : at + GRAM], at + 1) >= 0


def _construct(window: int):
    def run(table: pa.Table) -> pa.Table:
        strings, keys, owner, doc, absent, chunk, place, start = [], [], [], [], [], [], [], []
        known: dict[bytes, int] = {}
        inside = table.filter(pc.is_valid(table.column("spans"))).select(["chunk", "spans"])
        inside = inside.cast(pa.schema([("chunk", pa.int64()), ("spans", pa.binary())]))
        pieces = table.filter(pc.is_null(table.column("spans")))
        if not pieces.num_rows:
            return inside
        for row in pieces.to_pylist():
            blob = _unpacked(row["blob"], np.uint8).tobytes()
            numbers, at = [], 0
            for size, key in zip(_unpacked(row["sizes"], np.int32), _unpacked(row["keys"], np.uint64)):
                s = blob[at : at + size]
                at += size
                number = known.setdefault(s, len(strings))
                if number == len(strings):
                    strings.append(s)
                    keys.append(key)
                numbers.append(number)
            own = np.array(numbers, np.int64)
            owner.append(own)
            doc.append(_unpacked(row["doc"], np.int64))
            absent.append(_unpacked(row["no_doc"], np.uint8))
            place.append(_unpacked(row["place"], np.int32))
            start.append(_unpacked(row["start"], np.int64))
            chunk.append(np.full(len(own), row["chunk"], np.int64))
        owner, doc, absent, chunk, place, start = map(
            np.concatenate, (owner, doc, absent, chunk, place, start)
        )
        order = np.lexsort((place, chunk, doc, absent))
        new = np.zeros(len(order), np.int64)
        new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (place, chunk, doc, absent)], axis=0)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)

        # Occurrences after the first one of an equal string go whole.
        order = np.lexsort((start, rank, owner))
        head = np.concatenate(([True], owner[order][1:] != owner[order][:-1]))
        firsts, others = order[head], order[~head]
        ends = np.array([len(s) for s in strings], np.int64) - window + 1
        found = []

        def remove(of, x, y):
            found.append(np.stack((chunk[of], place[of].astype(np.int64), start[of] + x, start[of] + y + window - 1), 1))

        remove(others, 0, ends[owner[others]])
        # A string that is alone with its gram and repeats none has nothing to be ordered with.
        keys = np.array(keys, np.uint64)
        by_key = np.argsort(keys, kind="stable")
        edges = np.flatnonzero(np.concatenate(([True], keys[by_key][1:] != keys[by_key][:-1])))
        shared = np.empty(len(keys), bool)
        shared[by_key] = np.repeat(np.diff(np.append(edges, len(keys))) > 1, np.diff(np.append(edges, len(keys))))
        shared |= np.fromiter((repeats_inside(s, window) for s in strings), bool, len(strings))
        by_key = by_key[shared[by_key]]
        for a, b in key_groups(keys[by_key], HASHED):
            at = by_key[a:b]
            cut, head = [strings[k] for k in at], np.zeros(len(at), np.int64)
            while True:
                own, x, y = repeated_runs(cut, window)
                cut = [cut[k][i : j + window - 1] for k, i, j in zip(own, x, y)]
                at, head, of = at[own], head[own] + x, firsts[at[own]]
                # Equal runs are one as well, and without the others fewer windows have an equal.
                # The order finds the last few copies too, so they are worth no further round.
                later = later_copies(cut, rank[of], start[of] + head)
                if (y - x)[later].sum() * 16 <= (y - x).sum():
                    break
                remove(of[later], head[later], head[later] + (y - x)[later])
                at, head, cut = at[~later], head[~later], [cut[k] for k in np.flatnonzero(~later)]
            # Some hundred runs at a time; those of one key stay together.
            for c, d in key_groups(keys[at], STRINGS):
                run, x, y = removed_windows(cut[c:d], rank[of[c:d]], start[of[c:d]] + head[c:d], window)
                remove(of[c:d][run], head[c:d][run] + x, head[c:d][run] + y)
        spans = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
        edges = np.flatnonzero(np.diff(spans[:, 0], prepend=-1))
        bounds = np.append(edges, len(spans))
        across = pa.table(
            {
                "chunk": pa.array(spans[edges, 0], pa.int64()),
                "spans": pa.array(
                    [_packed(spans[a:b, 1:]) for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()
                ),
            }
        )
        return pa.concat_tables([inside, across])

    return run


def _remove(batches):
    for row in chunk_rows(batches):
        data = np.frombuffer(row["data"], np.uint8)
        sizes = np.array(row["sizes"], np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        change = np.zeros(len(data) + 1, np.int64)
        for packed in row["spans"] or []:
            place, a, b = _unpacked(packed, np.int64).reshape(-1, 3).T
            np.add.at(change, begins[place] + a, 1)
            np.add.at(change, begins[place] + b, -1)
        keep = np.cumsum(change)[:-1] == 0
        kept = [data[a:b][keep[a:b]].tobytes() for a, b in zip(begins, ends)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row["ids"], pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(sizes - np.array([len(k) for k in kept], np.int64), pa.int64()),
                pa.array(kept, pa.binary()),
                removed_spans(keep, begins, ends),
            ],
            ["doc_id", "n_bytes", "n_removed", "kept", "spans"],
        )


def suffix_texts(docs: DataFrame, window: int = WINDOW, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_bytes, n_removed, kept, spans for every row of (doc_id, text).

    ``kept`` is the bytes that stay, as binary, since a cut may fall inside a character; ``spans``
    lists the removed runs by byte (begin, end exclusive).

    Every byte covered by a ``window``-byte string that also starts earlier (smaller doc_id, or
    earlier in the same document) is removed.  A null text counts as empty; texts shorter than a
    window keep all.  Rows without doc_id come after all others; rows that repeat a doc_id or
    have none are ordered by where they were read.  An empty table gives no row.  ``window`` is
    between ``GRAM`` and 190 bytes.  The longest text must fit a task's memory about
    sixty times.
    """
    if not GRAM <= window <= 254 - LONGEST_RUN:
        raise ValueError(f"window must be between {GRAM} and {254 - LONGEST_RUN}")
    chunks = stored_chunks(docs, CHUNK_BYTES)
    size = total_bytes(chunks)
    width = filter_width(size // 32)
    buckets = bucket_count(chunks, size // 16)
    grams = answers(chunks.mapInArrow(_emit_grams(window, width, buckets), KEYS), _marks(heavy), "grams", _added)
    marked = with_answers(chunks, grams, "grams")
    strings = marked.mapInArrow(_emit_strings(window, width, buckets), PIECES)
    spans = strings.groupBy("bucket").applyInArrow(_construct(window), SPANS)
    spans = spans.groupBy(F.col("chunk").alias("spans_chunk")).agg(F.collect_list("spans").alias("spans"))
    return with_answers(chunks, spans, "spans").mapInArrow(_remove, RESULT)


def suffix_dedup(docs: DataFrame, window: int = WINDOW, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: ``suffix_texts`` with a digest for the bytes."""
    return suffix_texts(docs, window, heavy).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
