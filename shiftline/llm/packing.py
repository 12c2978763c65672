"""Pack tokenized documents into sequences by bulk-synchronous best fit.

Pieces are range-sorted by length over all tasks, and each gets its rank. A superstep handles all
pieces of one length, the longest first: it looks up the successor, that is the smallest gap that
still holds the length, gives the gaps from there on to the pieces in order of rank, so that no two
claim the same place, and updates the gaps. Sequences are opened when no gap is left. Pieces of one
length and sequences of one gap are alike, so supersteps work on runs of ranks and runs of sequence
numbers. There are at most as many lengths, and as many gaps, as a sequence has tokens; so the
plan's size depends on ``capacity`` and not on the documents. What grows with the documents,
sorting, ranking and placing them, is spread over all tasks, and takes one shuffle of rows without
text.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.llm.ranks import ranked, small_table
from shiftline.llm.workspace import Workspace, ship

CAPACITY = 4096
END = 1
TOKENIZER = "word_bpe_49k.json"
_CACHE = 250_000  # words a worker remembers
_CHUNK = 1 << 22  # bytes tokenized at once

_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTERS = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
# Letters, then punctuation: what the tokenizer splits into just these two, whatever it does elsewhere.
_PLAIN = re.compile(f"([{_LETTERS}]*)([{re.escape(_PUNCTUATION)}]*)")


def _bytes_of_symbols() -> dict[str, int]:
    """The byte that each character of the vocabulary stands for: printable Latin-1 characters stand
    for themselves, other bytes for the characters from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _pair_merger(path: str):
    """A function from the bytes of one plain word part to its ids.

    It merges pairs in the order of the vocabulary, as the tokenizer does, but without that one's
    fixed cost per call. The mark of a word's end is byte 255, which no UTF-8 text contains. (Tests
    compare the two.)
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    special = {t["content"] for t in settings["added_tokens"]}
    mark, byte = settings["model"]["end_of_word_suffix"], _bytes_of_symbols()
    ranks = {}
    for token, number in settings["model"]["vocab"].items():
        if token not in special:
            body = token.removesuffix(mark)
            ranks[bytes(map(byte.get, body)) + b"\xff" * (body != token)] = number
    coder = tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    return coder._core_bpe.encode_single_piece


class _Words(dict):
    """Word -> number, and the token ids of all words that were met, one after the other."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Plain parts are known to be alike for the tokenizer this library is made for.
        self.merge = _pair_merger(path) if path.endswith(TOKENIZER) else None
        self.start()

    def start(self) -> None:
        self.clear()
        self.ids, self.ends = array("I"), array("q", [0])

    def __missing__(self, word: str) -> int:
        plain = _PLAIN.fullmatch(word) if self.merge and "<|" not in word else None
        if plain:
            for part in plain.groups():
                if part:
                    self.ids.extend(self.merge(part.lower().encode() + b"\xff"))
        else:
            self.ids.extend(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self.ends.append(len(self.ids))
        number = self[word] = len(self.ends) - 2
        return number

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in a row, and where each text begins (one more at the end)."""
        if len(self) > _CACHE:
            self.start()
        # Blanks and line ends separate tokens, and nothing spans them.
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        bounds = np.asarray(words.offsets)
        words = words.flatten().dictionary_encode()
        known = np.array([self[w] for w in words.dictionary.to_pylist()], np.int64)
        numbers = known[words.indices.to_numpy()]
        ids, ends = np.array(self.ids, np.uint32), np.array(self.ends, np.int64)
        starts = ends[numbers]
        length = ends[numbers + 1] - starts
        to = np.cumsum(length)
        total = int(to[-1]) if len(to) else 0
        index = np.repeat((starts - (to - length)).astype(np.int32), length)
        index += np.arange(total, dtype=np.int32)
        return ids[index], np.concatenate([[0], to])[bounds - bounds[0]]


_words: dict[str, _Words] = {}


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Groups of texts of about ``_CHUNK`` bytes."""
    at = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(at, at[first] + _CHUNK, side="right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end
        first = end


_PIECES = "doc_id {id}, piece int, start long, length int, ids_crc32 long, ids binary"


def tokenized_pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    keep_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids: the pieces of every row of ``docs``.

    A document's ids are those of its whole text, then ``end``; a null text is empty. ``ids`` holds
    the piece's ids as little-endian unsigned 32-bit numbers if ``keep_ids``, else null.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    id_type = docs.schema["doc_id"].dataType
    ship(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer not in _words:
            _words[tokenizer] = _Words(tokenizer)
        words = _words[tokenizer]
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            for a, b in _chunks(texts):
                ids, bounds = words.encode(texts.slice(a, b - a))
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                for k in range(b - a):
                    own = np.append(ids[bounds[k] : bounds[k + 1]], np.uint32(end)).astype("<u4")
                    for number, at in enumerate(range(0, len(own), capacity)):
                        part = own[at : at + capacity].tobytes()
                        row.append(a + k)
                        piece.append(number)
                        start.append(at)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        kept.append(part if keep_ids else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int32()),
                        pa.array(crc, pa.int64()),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )
            del batch, texts
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text").mapInArrow(
        pieces, _PIECES.format(id=id_type.simpleString())
    )


class _Gaps:
    """Runs of sequences by gap."""

    def __init__(self):
        self.sorted: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, count: int) -> None:
        if gap > 0 and count > 0:
            if gap not in self.runs:
                insort(self.sorted, gap)
                self.runs[gap] = []
            self.runs[gap].append((first, count))

    def successor(self, length: int) -> tuple[int, int, int] | None:
        """Take a run of the smallest gap that holds ``length``."""
        at = bisect_left(self.sorted, length)
        if at == len(self.sorted):
            return None
        gap = self.sorted[at]
        first, count = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap], self.sorted[at]
        return gap, first, count


def plan(runs: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, pieces per sequence, offset) from counts by
    length.
    """
    ranks, total = {}, 0
    for length in sorted(runs):
        ranks[length] = total
        total += runs[length]
    gaps, opened, rows = _Gaps(), 0, []
    for length in sorted(runs, reverse=True):
        rank, left = ranks[length], runs[length]
        while left:
            found = gaps.successor(length)
            if found is None:
                new = -(-left // (capacity // length))
                found = capacity, opened, new
                opened += new
            gap, first, count = found
            # A gap that holds several is filled before the next larger one is touched.
            each = gap // length
            filled = min(count, left // each)
            for sequences, pieces in ((filled, each), (1, left - filled * each)):
                if sequences and count and 0 < pieces <= each and left:
                    taken = sequences * pieces
                    rows.append((length, rank, rank + taken, first, pieces, capacity - gap))
                    gaps.add(gap - pieces * length, first, sequences)
                    rank, left = rank + taken, left - taken
                    first, count = first + sequences, count - sequences
            gaps.add(gap, first, count)
    return rows


def pack(pieces: DataFrame, work: Workspace, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``capacity``) with sequence_id and offset.

    Every row gets its own place, also rows that repeat; an empty table gives an empty table.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    items = pieces.select("length", F.struct(*kept).alias("item"))
    items = ranked(items.withColumn("tie", F.xxhash64("item")), ["length", "tie"], work, "ordered")
    runs = {r["length"]: r["count"] for r in items.groupBy("length").count().collect()}
    rows = small_table(
        pieces.sparkSession,
        plan(runs, capacity),
        "length int, first long, end long, sequence long, each long, start long",
    )
    place = F.col("rank") - F.col("first")
    return (
        items.join(F.broadcast(rows), "length")
        .where("rank >= first AND rank < end")
        .select(
            "item.*",
            (F.col("sequence") + F.floor(place / F.col("each"))).cast("long").alias("sequence_id"),
            (F.col("start") + place % F.col("each") * F.col("length")).alias("offset"),
        )
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    keep_ids: bool = False,
) -> DataFrame:
    """The pieces of all ``docs`` (doc_id, text) with sequence_id and offset.

    Only documents of more than ``capacity`` tokens are cut. A null or empty text is the single id
    ``end``. Rows that repeat are packed as often as they occur. Other columns are not read. An
    empty table gives an empty table. ``tokenizer`` is the path of a ``tokenizers`` file, which
    every executor must have.
    """
    work = Workspace(docs.sparkSession, "packing")
    pieces = tokenized_pieces(docs, tokenizer, capacity, end, keep_ids)
    return pack(work.write(pieces, "pieces"), work, capacity)
