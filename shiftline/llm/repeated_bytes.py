"""Removal of byte strings that a document with a smaller id holds already.

Suffix arrays per shard (``suffix_array``), common prefixes between neighbours, and a binary search
of every shard's distinct strings in the other shards of its bin. What lies in a shard is not a run
of documents, which would have to be compared with all others, but what may be equal:

1. Every string of ``length`` bytes has an anchor, its ``gram`` bytes with the least hash. Strings
   that follow each other share anchors, so a text is a sequence of short regions. Equal strings have
   equal anchors; anchors that one text alone holds are left out. Only hashes travel for this.
2. The other regions go to the bin of their anchor, equal ones of a chunk of texts once. Regions of
   very frequent anchors go there string by string instead, under the string's own hash, so no
   anchor makes a large bin.
3. In a bin, regions are cut into shards of bounded size. A shard's suffix array and common prefixes
   group its equal strings; shards find each other's strings by binary search. A string's least
   document goes back where it differs from what the chunk knows.

Copies of a whole text are one text with its least id.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftline.llm.suffix_array import common_prefixes, suffix_order, words_at
from shiftline.llm.words import mixed
from shiftline.llm.workspace import ship

LENGTH = 50
GRAM = 24  # bytes of an anchor, at most half of a string
CHUNK = 8 << 20  # bytes of text whose anchors travel together
REGION_CHUNK = 16 << 20  # bytes of text whose equal regions travel once
PIECE = 1 << 20  # bytes that are hashed at once
BUCKET = 32 << 20  # bytes of text per bucket of anchors
BIN = 768 << 10  # bytes of regions per bin
SHARD = 1 << 20  # bytes of a suffix array
HOT = 1 << 16  # regions of one anchor from which on its strings are dealt out one by one
NO_ID = (1 << 63) - 1  # documents without an id come last
_FACTORS = tuple(
    np.uint64(x)
    for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
)


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32 by byte place, which compresses well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _packed(*values: bytes) -> bytes:
    return zlib.compress(b"".join(values), 1)


class _Reader:
    """Reads what was packed one after the other."""

    def __init__(self, data: bytes):
        self.data, self.at = zlib.decompress(data), 0

    def take(self, n: int, kind: str) -> np.ndarray:
        found = np.frombuffer(self.data, kind, n, self.at)
        self.at += found.nbytes
        return found

    def planes(self, n: int) -> np.ndarray:
        flat = self.take(4 * n, "u1").reshape(4, n).T
        return np.ascontiguousarray(flat).view("<u4").ravel().astype(np.int64)

    def steps(self, n: int) -> np.ndarray:
        return np.cumsum(self.planes(n))


def _steps(rising: np.ndarray) -> bytes:
    return _planes(np.diff(rising, prepend=0))


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for every pair."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


def _words(data: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes from each of ``at`` on as words, ``sizes`` of them (8 at most), zeros above."""
    places = np.minimum(at[:, None] + np.arange(8), len(data) - 1)
    words = data[places].view("<u8").ravel()
    mask = (np.uint64(1) << (8 * np.minimum(sizes, 7)).astype(np.uint64)) - np.uint64(1)
    return np.where(sizes >= 8, words, words & mask)


def _window_hashes(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` bytes from each of ``starts`` on."""
    total = np.full(len(starts), size, np.uint64)
    for at in range(0, size, 8):
        part = _words(data, starts + at, np.full(len(starts), size - at))
        total = mixed(total * _FACTORS[1] + part)
    return total


def _gram_hashes(words: np.ndarray, gram: int) -> np.ndarray:
    n = len(words) - gram + 1
    if gram < 8:
        return mixed((words[:n] & np.uint64((1 << 8 * gram) - 1)) * _FACTORS[0])
    total = np.zeros(n, np.uint64)
    for k, at in enumerate(range(0, gram, 8)):
        at = min(at, gram - 8)
        total += words[at : at + n] * _FACTORS[k % 4]
    return mixed(total)


def regions(data: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """(start, strings, anchor hash) of the regions of texts that lie one after the other.

    ``bounds`` are the texts' starts and the end; each has ``length`` bytes at least.
    """
    hashes = _gram_hashes(words_at(data), gram)
    low = np.uint64(0xFFFFFFFF)
    best = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width, wanted = 1, length - gram + 1
    while width * 2 <= wanted:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < wanted:
        best = np.minimum(best[: len(best) - (wanted - width)], best[wanted - width :])
    sizes = np.diff(bounds) - length + 1
    starts = _ranges(bounds[:-1], sizes)
    anchor = (best[starts] & low).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    heads = np.flatnonzero(new)
    return starts[heads], np.diff(heads, append=len(starts)), hashes[anchor[heads]]


def _texts(column: pa.Array) -> list[np.ndarray]:
    column = column.cast(pa.large_string())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _number() -> int:
    """The first chunk number of a task: the same when the task runs again."""
    return TaskContext.get().partitionId() << 32


_ANCHORS = "chunk long, bucket long, n long, payload binary"


def _anchors(length: int, gram: int, buckets: int) -> Callable:
    """Rows (chunk, bucket) with the anchors of a chunk of texts; one row with ``n`` = -1 names the
    texts.
    """

    def packed(chunk: int, keys: list, segments: list) -> pa.RecordBatch:
        found = []
        first = 0
        while first < len(segments):  # long texts are cut where one string ends behind the cut
            last, size = first, 0
            while last < len(segments) and (last == first or size + len(segments[last][2]) <= PIECE):
                size += len(segments[last][2])
                last += 1
            part = segments[first:last]
            bounds = np.cumsum([0, *(len(s[2]) for s in part)])
            starts, strings, hashes = regions(np.concatenate([s[2] for s in part]), bounds, length, gram)
            owner = np.searchsorted(bounds, starts, side="right") - 1
            shift = np.array([s[1] for s in part]) - bounds[:-1]
            docs = np.array([s[0] for s in part])[owner]
            found.append((docs, starts + shift[owner], strings, mixed(hashes)))
            first = last
        docs, starts, strings, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
        bucket = (hashes >> np.uint64(32)).astype(np.int64) % buckets
        order = np.argsort(bucket, kind="stable")
        heads = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        numbers, counts, payloads = [], [], []
        for a, b in zip(heads, np.append(heads, len(order))[1:], strict=True):
            own = order[a:b]
            numbers.append(int(bucket[own[0]]))
            counts.append(len(own))
            tag = hashes[own] & np.uint64(0xFFFFFFFF)
            payloads.append(
                _packed(_planes(tag), _steps(docs[own]), _planes(starts[own]), strings[own].astype("u1").tobytes())
            )
        numbers.append(chunk % buckets)
        counts.append(-1)
        payloads.append(_packed(np.array(keys, np.int64).tobytes()))
        return pa.RecordBatch.from_pydict(
            {"chunk": [chunk] * len(counts), "bucket": numbers, "n": counts, "payload": payloads},
            schema=pa.schema(
                [(c, pa.int64()) for c in ("chunk", "bucket", "n")] + [("payload", pa.binary())]
            ),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, keys, segments, size = _number(), [], [], 0
        for batch in batches:
            ids = zip(batch["k1"].to_pylist(), batch["k2"].to_pylist(), strict=True)
            for key, text in zip(ids, _texts(batch["text"]), strict=True):
                if len(text) < length:
                    continue
                for at in range(0, len(text) - length + 1, PIECE):
                    segments.append((len(keys), at, text[at : at + PIECE + length - 1]))
                keys.append(key)
                size += len(text)
                if size >= CHUNK:
                    yield packed(chunk, keys, segments)
                    chunk, keys, segments, size = chunk + 1, [], [], 0
        if keys:
            yield packed(chunk, keys, segments)

    return run


def _shared(length: int) -> Callable:
    """Of one bucket, per chunk the regions whose anchor several texts hold, each with its bin."""

    def run(table: pa.Table) -> pa.Table:
        rows, rest, parts = [], [], []
        for row in table.select(["chunk", "bucket", "n", "payload"]).to_pylist():
            if row["n"] < 0:
                rest.append(row)
                continue
            reader, n = _Reader(row["payload"]), row["n"]
            parts.append((reader.planes(n), reader.steps(n), reader.planes(n), reader.take(n, "u1")))
            rows.append(row)
        if parts:
            tags = np.concatenate([p[0] for p in parts])
            texts = np.concatenate([p[1] + (k << 32) for k, p in enumerate(parts)])
            strings = np.concatenate([p[3] for p in parts])
            order = np.argsort(tags.astype(np.uint32), kind="stable")
            heads = np.flatnonzero(np.diff(tags[order], prepend=-1))
            sizes = np.diff(heads, append=len(order))
            several = np.minimum.reduceat(texts[order], heads) != np.maximum.reduceat(texts[order], heads)
            chosen, hot = np.zeros(len(tags), bool), np.zeros(len(tags), bool)
            chosen[order] = np.repeat(several, sizes)
            hot[order] = np.repeat(sizes >= HOT, sizes)
            bins = 1 + int(np.sum(strings[chosen], dtype=np.int64) + (length - 1) * chosen.sum()) // BIN
            place = (mixed(tags.astype(np.uint64)) % np.uint64(min(bins, 1 << 16))).astype(np.int64)
            at = 0
            for row, (_, docs, starts, own) in zip(rows, parts, strict=True):
                kept = np.flatnonzero(chosen[at : at + len(docs)])
                here = kept + at
                at += len(docs)
                if len(kept):
                    payload = _packed(
                        _steps(docs[kept]), _planes(starts[kept]), _planes(place[here]),
                        own[kept].tobytes(), hot[here].tobytes(),
                    )
                    rest.append(row | {"n": len(kept), "payload": payload})
        return pa.Table.from_pylist(
            rest,
            schema=pa.schema(
                [(c, pa.int64()) for c in ("chunk", "bucket", "n")] + [("payload", pa.binary())]
            ),
        )

    return run


_REFERENCES = "k1 long, k2 long, n long, references binary"


def _by_text(table: pa.Table) -> pa.Table:
    """The regions of a chunk, by text."""
    keys, parts = np.zeros((0, 2), np.int64), []
    for row in table.select(["bucket", "n", "payload"]).to_pylist():
        if row["n"] < 0:
            keys = np.frombuffer(zlib.decompress(row["payload"]), np.int64).reshape(-1, 2)
            continue
        reader, n = _Reader(row["payload"]), row["n"]
        part = [reader.steps(n), reader.planes(n), reader.planes(n) + (row["bucket"] << 16)]
        parts.append((*part, reader.take(n, "u1"), reader.take(n, "u1")))
    found = {"k1": [], "k2": [], "n": [], "references": []}
    if parts:
        docs, starts, bins, strings, hot = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((starts, docs))
        heads = np.flatnonzero(np.diff(docs[order], prepend=-1))
        for a, b in zip(heads, np.append(heads, len(order))[1:], strict=True):
            own = order[a:b]
            k1, k2 = keys[docs[own[0]]]
            found["k1"].append(k1)
            found["k2"].append(k2)
            found["n"].append(len(own))
            found["references"].append(
                _packed(_steps(starts[own]), bins[own].tobytes(), strings[own].tobytes(), hot[own].tobytes())
            )
    return pa.table(
        found,
        schema=pa.schema([(c, pa.int64()) for c in ("k1", "k2", "n")] + [("references", pa.binary())]),
    )


_REGIONS = "chunk long, bin long, n long, payload binary"
_REGION_SCHEMA = pa.schema(
    [(c, pa.int64()) for c in ("chunk", "bin", "n")] + [("payload", pa.binary())]
)
_HOT_BINS = 1 << 40


def _regions(length: int) -> Callable:
    """Rows (chunk, bin) with the distinct regions of a chunk of texts, each with its least id; a row
    with ``n`` = -1 says which texts hold them where.
    """

    def packed(chunk: int, texts: list) -> pa.RecordBatch:
        keys = np.array([t[:3] for t in texts], np.int64)
        least = keys[:, 2]
        counts = np.array([len(t[4]) for t in texts])
        docs = np.repeat(np.arange(len(texts)), counts)
        starts, bins, strings, hot = (np.concatenate([t[k] for t in texts]) for k in (4, 5, 6, 7))
        strings = strings.astype(np.int64)
        bounds = np.cumsum([0, *(len(t[3]) for t in texts)])
        data = np.concatenate([t[3] for t in texts])
        sizes = strings + length - 1
        # Regions side by side, with zeros behind, as whole words.
        longest = -(-int(sizes.max()) // 8)
        grid = np.zeros((longest, len(docs)), np.uint64)
        at = bounds[docs] + starts
        total = mixed(bins.astype(np.uint64) * _FACTORS[0] + sizes.astype(np.uint64))
        for k in range(longest):
            grid[k] = _words(data, at + 8 * k, np.maximum(sizes - 8 * k, 0))
            total = mixed(total * _FACTORS[1] + grid[k])
        order = np.argsort(total, kind="stable")
        head = np.ones(len(order), bool)
        head[1:] = total[order][1:] != total[order][:-1]
        of = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
        # Regions of one hash that differ after all stay apart.
        first = order[of]
        head |= (grid[:, order] != grid[:, first]).any(axis=0) | (bins[order] != bins[first]) | (sizes[order] != sizes[first])
        parent = np.empty(len(order), np.int64)
        parent[order] = np.cumsum(head)[of] - 1
        alone = head & (np.arange(len(order)) != of)
        parent[order[alone]] = np.cumsum(head)[alone] - 1
        kinds = int(head.sum())
        shown = np.empty(kinds, np.int64)  # a region of each kind
        shown[parent[order[head]]] = order[head]
        lows = np.full(kinds, NO_ID)
        np.minimum.at(lows, parent, least[docs])

        # Kinds with a frequent anchor are dealt out string by string.
        whole = ~hot[shown].astype(bool)
        pieces = np.where(whole, 1, strings[shown])
        part_of = np.repeat(np.arange(kinds), pieces)
        offset = _ranges(np.zeros(kinds, np.int64), pieces)
        part_strings = np.where(whole[part_of], strings[shown][part_of], 1)
        part_at = at[shown][part_of] + offset
        part_bin = bins[shown][part_of]
        single = np.flatnonzero(~whole[part_of])
        if len(single):
            own = _window_hashes(data, part_at[single], length)
            part_bin[single] = _HOT_BINS + (own >> np.uint64(44)).astype(np.int64)
        order = np.argsort(part_bin, kind="stable")
        heads = np.flatnonzero(np.diff(part_bin[order], prepend=-1))
        rows = {"chunk": [], "bin": [], "n": [], "payload": []}
        for a, b in zip(heads, np.append(heads, len(order))[1:], strict=True):
            own = order[a:b]
            spans = _ranges(part_at[own], part_strings[own] + length - 1)
            rows["bin"].append(int(part_bin[own[0]]))
            rows["n"].append(len(own))
            rows["payload"].append(
                _packed(
                    _planes(own), part_strings[own].astype("u1").tobytes(),
                    lows[part_of[own]].tobytes(), data[spans].tobytes(),
                )
            )
        rows["bin"].append(-1 - chunk % 1024)
        rows["n"].append(-1)
        header = np.array([len(texts), len(docs), len(part_of)], np.int64)
        rows["payload"].append(
            _packed(
                header.tobytes(), keys.tobytes(), _steps(docs), _planes(starts), _planes(parent),
                _steps(part_of), _planes(offset), _planes(part_strings), lows[part_of].tobytes(),
            )
        )
        rows["chunk"] = [chunk] * len(rows["n"])
        return pa.RecordBatch.from_pydict(rows, schema=_REGION_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, texts, size = _number(), [], 0
        for batch in batches:
            names = ("k1", "k2", "least", "n", "references")
            columns = zip(*(batch[c].to_pylist() for c in names), strict=True)
            for (k1, k2, least, n, found), text in zip(columns, _texts(batch["text"]), strict=True):
                reader = _Reader(found)
                own = (reader.steps(n), reader.take(n, "<i8"), reader.take(n, "u1"), reader.take(n, "u1"))
                texts.append((k1, k2, least, text, *own))
                size += len(text)
                if size >= REGION_CHUNK:
                    yield packed(chunk, texts)
                    chunk, texts, size = chunk + 1, [], 0
        if texts:
            yield packed(chunk, texts)

    return run


class _Shard:
    """Regions of a bin: their strings grouped by a suffix array."""

    def __init__(self, data: np.ndarray, strings: np.ndarray, ids: np.ndarray, length: int):
        self.strings = strings
        bounds = np.cumsum(strings + length - 1) - strings - length + 1
        starts = _ranges(bounds, strings)  # of strings, in the order of their regions
        owner = np.repeat(np.arange(len(strings)), strings)
        order = suffix_order(data)
        group = np.cumsum(common_prefixes(data, order, length) < length) - 1
        of_place = np.empty(len(data), np.int64)
        of_place[order] = group
        kinds, self.kind = np.unique(of_place[starts], return_inverse=True)
        self.least = np.full(len(kinds), NO_ID)
        np.minimum.at(self.least, self.kind, ids[owner])
        self.found = self.least.copy()
        shown = np.empty(len(kinds), np.int64)
        shown[self.kind] = starts
        self.data, self.shown, self.length = data, shown, length

    def texts(self) -> np.ndarray:
        """The distinct strings, in order. A byte behind each keeps numpy from cutting zeros."""
        grid = np.ones((len(self.shown), self.length + 1), np.uint8)
        grid[:, :-1] = self.data[self.shown[:, None] + np.arange(self.length)]
        return grid.view(f"S{self.length + 1}").ravel()


def _merge(shards: list[_Shard]) -> None:
    """Every shard's strings are searched in all others of the bin."""
    texts = [s.texts() for s in shards]
    for a, own in enumerate(shards):
        for b, other in enumerate(shards):
            if a != b:
                at = np.minimum(np.searchsorted(texts[b], texts[a]), len(texts[b]) - 1)
                same = texts[b][at] == texts[a]
                own.found[same] = np.minimum(own.found[same], other.least[at[same]])


def _least_ids(length: int) -> Callable:
    """Of one bin, per chunk the strings that a smaller document holds than the chunk knows."""

    def run(table: pa.Table) -> pa.Table:
        rest, rows = [], []
        for row in table.select(["chunk", "bin", "n", "payload"]).to_pylist():
            (rest if row["n"] < 0 else rows).append(row)
        shards, parts, pending, size = [], [], [], 0

        def close():
            data, strings, ids = (np.concatenate(x) for x in zip(*pending, strict=True))
            shards.append(_Shard(data, strings, ids, length))
            pending.clear()

        for number, row in enumerate(rows):
            reader, n = _Reader(row["payload"]), row["n"]
            own, strings = reader.planes(n), reader.take(n, "u1").astype(np.int64)
            ids, data = reader.take(n, "<i8"), reader.take(int((strings + length - 1).sum()), "u1")
            parts.append((np.full(n, number), own, ids, strings))
            ends = np.cumsum(strings + length - 1)
            first = 0
            while first < n:  # a row may fill several shards
                begin = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, begin + SHARD - size, side="right")))
                pending.append((data[begin : ends[last - 1]], strings[first:last], ids[first:last]))
                size += int(ends[last - 1] - begin)
                first = last
                if size >= SHARD or first < n:
                    close()
                    size = 0
        if pending:
            close()
        if len(shards) > 1:
            _merge(shards)
        if shards:
            number, own, ids, strings = (np.concatenate(x) for x in zip(*parts, strict=True))
            least = np.concatenate([s.found[s.kind] for s in shards])
            part = np.repeat(np.arange(len(strings)), strings)
            place = _ranges(np.zeros(len(strings), np.int64), strings)
            less = np.flatnonzero(least < ids[part])
            if len(less):
                head = np.ones(len(less), bool)
                head[1:] = (np.diff(less) != 1) | (np.diff(part[less]) != 0) | (np.diff(least[less]) != 0)
                heads = np.flatnonzero(head)
                runs = np.diff(heads, append=len(less))
                at = less[heads]
                rownumber = number[part[at]]
                cuts = np.flatnonzero(np.diff(rownumber, prepend=-1))
                for a, b in zip(cuts, np.append(cuts, len(at))[1:], strict=True):
                    here = at[a:b]
                    payload = _packed(
                        _planes(own[part[here]]), _planes(place[here]), _planes(runs[a:b]),
                        least[here].tobytes(),
                    )
                    rest.append(rows[rownumber[a]] | {"n": b - a, "payload": payload})
        return pa.Table.from_pylist(rest, schema=_REGION_SCHEMA)

    return run


_SPANS = "k1 long, k2 long, n long, spans binary"


def _removed(length: int) -> Callable:
    """Of one chunk, per text the bytes to remove, as runs."""

    def run(table: pa.Table) -> pa.Table:
        found, known = [], None
        for row in table.select(["n", "payload"]).to_pylist():
            reader, n = _Reader(row["payload"]), row["n"]
            if n >= 0:
                found.append((reader.planes(n), reader.planes(n), reader.planes(n), reader.take(n, "<i8")))
                continue
            texts, owners, parts = reader.take(3, "<i8")
            keys = reader.take(3 * texts, "<i8").reshape(-1, 3)
            docs, starts, parent = reader.steps(owners), reader.planes(owners), reader.planes(owners)
            part_of, offset, strings = reader.steps(parts), reader.planes(parts), reader.planes(parts)
            known = reader.take(parts, "<i8")
        made = {"k1": [], "k2": [], "n": [], "spans": []}
        if known is not None:
            least = np.repeat(known, strings)
            first = np.cumsum(strings) - strings
            for part, place, runs, ids in found:
                where = _ranges(first[part] + place, runs)
                least[where] = np.minimum(least[where], np.repeat(ids, runs))
            # Parts of one parent follow each other, and so do their strings.
            kinds = np.flatnonzero(np.diff(part_of, prepend=-1))
            begin = first[kinds]
            size = np.add.reduceat(strings, kinds)
            own = np.repeat(np.arange(owners), size[parent])
            at = _ranges(begin[parent], size[parent])
            place = starts[own] + _ranges(np.zeros(owners, np.int64), size[parent])
            gone = least[at] < keys[docs[own], 2]
            docs, place = docs[own[gone]], place[gone]
            order = np.lexsort((place, docs))
            docs, place = docs[order], place[order]
            head = np.ones(len(docs), bool)
            head[1:] = (docs[1:] != docs[:-1]) | (place[1:] > place[:-1] + length)
            heads = np.flatnonzero(head)
            ends = place[np.append(heads[1:], len(docs)) - 1] + length if len(docs) else place
            cuts = np.flatnonzero(np.diff(docs[heads], prepend=-1))
            for a, b in zip(cuts, np.append(cuts, len(heads))[1:], strict=True):
                k1, k2, _ = keys[docs[heads[a]]]
                made["k1"].append(k1)
                made["k2"].append(k2)
                made["n"].append(b - a)
                made["spans"].append(_packed(_planes(place[heads[a:b]]), _planes(ends[a:b])))
        return pa.table(
            made,
            schema=pa.schema([(c, pa.int64()) for c in ("k1", "k2", "n")] + [("spans", pa.binary())]),
        )

    return run


def _kept(texts: bool) -> Callable:
    names = ("k1", "k2", "least")
    schema = pa.schema(
        [(c, pa.int64()) for c in (*names, "n_bytes", "n_removed", "n_spans")]
        + [("kept_sha256", pa.string())]
        + ([("kept", pa.binary()), ("spans", pa.list_(pa.list_(pa.int64())))] if texts else [])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = zip(*(batch[c].to_pylist() for c in (*names, "n", "spans")), strict=True)
            for (*key, n, spans), text in zip(columns, _texts(batch["text"]), strict=True):
                runs = np.zeros((0, 2), np.int64)
                if n:
                    reader = _Reader(spans)
                    runs = np.stack([reader.planes(n), reader.planes(n)], axis=1)
                begins, ends = [0, *runs[:, 1]], [*runs[:, 0], len(text)]
                kept = b"".join(text[a:b].tobytes() for a, b in zip(begins, ends, strict=True))
                row = dict(zip(names, key, strict=True))
                row |= {"n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": len(runs)}
                row["kept_sha256"] = hashlib.sha256(kept).hexdigest()
                if texts:
                    row |= {"kept": kept, "spans": runs.tolist()}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, texts: bool = False, gram: int | None = None
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row of ``docs`` (doc_id, text).

    A text counts as UTF-8 bytes. Each byte is removed that a string of ``length`` bytes covers which
    also starts in a document with a smaller doc_id; strings overlap, lie within one text and are
    judged on the texts as given. ``n_spans`` counts the maximal removed runs; ``kept_sha256`` is of
    the bytes that stay. With ``texts``, also ``kept`` (these bytes; a cut may split a character) and
    ``spans`` (start and end of each run).

    A null text counts as empty. Rows without a doc_id come after all others, and none of them is
    smaller than another. Rows that share a doc_id do not remove anything from each other. Texts
    that are shorter than ``length`` stay whole. Other columns are not read. An empty table gives an
    empty table. ``length`` is from 2 to 250.
    """
    spark = docs.sparkSession
    ship(spark)
    gram = gram or max(1, min(GRAM, length // 2))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Two hashes of 64 bits name a text.
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit(1), text).alias("k2"),
    )
    size = keyed.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = 1 + size // BUCKET
    id_or_last: Column = F.coalesce("doc_id", F.lit(NO_ID))
    distinct = keyed.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.min(id_or_last).alias("least"))
    references = (
        keyed.select("k1", "k2", "text")
        .mapInArrow(_anchors(length, gram, buckets), _ANCHORS)
        .groupBy("bucket")
        .applyInArrow(_shared(length), _ANCHORS)
        .groupBy("chunk")
        .applyInArrow(_by_text, _REFERENCES)
    )
    # A copy's references are those of any other copy.
    references = references.groupBy("k1", "k2").agg(
        F.max(F.struct("n", "references")).alias("r")
    ).select("k1", "k2", "r.n", "r.references")
    spans = (
        distinct.join(references, ["k1", "k2"])
        .mapInArrow(_regions(length), _REGIONS)
        .groupBy("bin")
        .applyInArrow(_least_ids(length), _REGIONS)
        .groupBy("chunk")
        .applyInArrow(_removed(length), _SPANS)
    )
    more = ", kept binary, spans array<array<long>>" if texts else ""
    classes = distinct.join(spans, ["k1", "k2"], "left").mapInArrow(
        _kept(texts),
        "k1 long, k2 long, least long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + more,
    )
    # Whatever a copy holds starts in the copy with the least id too.
    copy = (F.col("n_bytes") >= length) & (F.col("least") < id_or_last)
    columns = [
        F.col("n_bytes"),
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(copy, hashlib.sha256(b"").hexdigest()).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    ]
    if texts:
        columns += [
            F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
            F.when(copy, F.array(F.array(F.lit(0).cast("long"), F.col("n_bytes")))).otherwise(F.col("spans")).alias("spans"),
        ]
    return keyed.select("doc_id", "k1", "k2").join(classes, ["k1", "k2"]).select("doc_id", *columns)
