"""A probabilistic suffix tree over the bytes of a text's words, and a unigram base.

A text is the bytes of its words (A-Z as a-z), a blank after each word, then an end symbol. The
tree's states are contexts of up to ``DEPTH`` bytes. Pairs of a context and its next symbol are
counted over the whole training text, and none is left out. A context is kept if its next symbols
diverge from those of its longest kept suffix: the Kullback-Leibler divergence times the context's
count, in nats, exceeds ``DIVERGENCE``. The next symbols of a state are smoothed with those of its
suffix state by the Witten-Bell rule, so every state's symbols sum to 1. A text is scored by the
state of the longest suffix at every position.

The tree is a table that grows with the corpus. Texts lie in blocks of ``BLOCK`` bytes; each block
sends its distinct codes (a context and its next symbol) packed to buckets of codes, where they are
added up, and gets the tree's probabilities of its own codes back. A code reaches its bucket once a
block at most, or once each time that a task has to hand on what it counted, so frequent codes do
not fill a bucket. Contexts of up to two bytes are grown depth by depth in joins; longer ones with
equal last three bytes lie in one group, which holds different codes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftline.llm.words import mixed, word_hashes
from shiftline.llm.workspace import Workspace, ship

DEPTH = 5
DIVERGENCE = 2.0
BLOCK = 32 << 20  # bytes of text whose codes travel together
_END, _BEFORE = 0xFF, 0xFE  # bytes that UTF-8 text does not contain
_SYMBOLS = 257
_CHUNK = 2 << 20  # bytes counted or scored at once
_FLUSH = 4_000_000  # distinct codes a task holds
_GROUP = 1_000_000  # codes of the tree grown at once, on average
_NEAR = 2  # depth up to which the tree is grown in joins
_WORD = np.int64(-1 << 63)  # the bit that tells a word's hash from a code


def _stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every symbol of the texts its code (the bytes before it and itself), where each token
    begins, and each text's number of words.
    """
    before = bytes([_BEFORE]) * DEPTH
    words = [t.lower().split() for t in texts]  # of bytes: A-Z, and blanks in the ASCII range
    parts = [b" ".join([*w, bytes([_END])]) for w in words]
    data = np.frombuffer(b"".join(before + p for p in parts), np.uint8)
    codes = np.zeros(max(len(data) - DEPTH, 0), np.int64)
    for k in range(DEPTH + 1):
        codes <<= 8
        codes |= data[k : len(data) - DEPTH + k]
    codes = codes[data[DEPTH:] != _BEFORE]
    last = codes & 0xFF
    ends = (last == 0x20) | (last == _END)
    starts = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1]) if len(codes) else np.zeros(0, int)
    return codes, starts, np.array([len(w) for w in words])


def _chunks(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """Groups of texts of about ``_CHUNK`` bytes; a null text is empty."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy()
    ends = np.cumsum(sizes)
    first = 0
    while first < len(column):
        before = ends[first] - sizes[first]
        last = max(int(np.searchsorted(ends, before + _CHUNK, side="right")), first + 1)
        texts = column.slice(first, last - first).cast(pa.binary()).to_pylist()
        yield first, last, [t or b"" for t in texts]
        first = last


class _Counter:
    """Counts of codes; what outgrows the memory set aside is handed on."""

    def __init__(self):
        self.codes = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def add(self, codes: np.ndarray, learn: bool) -> None:
        """Codes that are not learned from are held with a count of 0."""
        if len(codes) == 0:
            return
        codes = np.sort(codes)
        starts = _starts(codes)
        counts = np.diff(starts, append=len(codes)) * int(learn)
        codes = np.concatenate([self.codes, codes[starts]])
        counts = np.concatenate([self.counts, counts])
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        starts = _starts(codes)
        self.codes, self.counts = codes[starts], np.add.reduceat(counts, starts)


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def _word_codes(column: pa.Array) -> np.ndarray:
    hashes = [np.zeros(0, np.uint64), *(h for _, _, h, _ in word_hashes(column))]
    return np.concatenate(hashes).view(np.int64) | _WORD


def _in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """(id, text, learn) with the number of the block that each row lies in."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, done = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy().astype(np.int64)
            ends = done + np.cumsum(sizes)
            numbers = first + (ends - sizes) // block
            done = int(ends[-1]) if len(ends) else done
            names = [*batch.schema.names, "block"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers)], names=names)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(number, f"id {kind}, text string, learn boolean, block long")


def _packed(values: np.ndarray) -> bytes:
    """Numbers of 8 bytes, compressed after all their first bytes, second bytes and so on."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _unpacked(data: bytes, size: int, kind: type) -> np.ndarray:
    planes = pa.Codec("zstd").decompress(data, 8 * size, asbytes=True)
    planes = np.frombuffer(planes, np.uint8).reshape(8, size)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _codes_of(table: pa.Table) -> list[np.ndarray]:
    """The codes of each row; they are packed as differences."""
    sizes, packed = table["size"].to_pylist(), table["codes"].to_pylist()
    return [np.cumsum(_unpacked(c, n, np.int64)) for c, n in zip(packed, sizes, strict=True)]


def _bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Codes that differ in their last symbol alone share a bucket."""
    return (mixed((codes >> 8).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def block_codes(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, size, codes, counts): the codes of ``DEPTH`` + 1 symbols and the words (by
    63-bit hashes, below 0) of each block, and how often they occur where ``learn`` holds, packed.
    A code can have several rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, held = _Counter(), None

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal counter
            bucket = _bucket(counter.codes, buckets)
            order = np.argsort(bucket, kind="stable")
            bucket, codes, counts = bucket[order], counter.codes[order], counter.counts[order]
            counter = _Counter()
            for part in np.split(np.arange(len(codes)), _starts(bucket)[1:]) if len(codes) else ():
                own = codes[part]
                row = {
                    "block": held,
                    "bucket": int(bucket[part[0]]),
                    "size": len(part),
                    "codes": _packed(np.diff(own, prepend=np.int64(0))),
                    "counts": _packed(counts[part]),
                }
                yield pa.RecordBatch.from_pylist([row])

        for batch in batches:
            numbers = batch.column(1).to_numpy()
            cuts = [*(_starts(numbers) if len(numbers) else []), len(numbers)]
            for first, last in zip(cuts, cuts[1:]):
                if numbers[first] != held or len(counter.codes) > _FLUSH:
                    yield from out()
                    held = int(numbers[first])
                part = batch.slice(first, last - first)
                for learn in (True, False):
                    texts = part.column(0).filter(pc.equal(part.column(2), learn))
                    counter.add(_word_codes(texts), learn)
                    for _, _, chunk in _chunks(texts):
                        counter.add(_stream(chunk)[0], learn)
            pa.default_memory_pool().release_unused()
        yield from out()

    return blocks.select("text", "block", "learn").mapInArrow(
        count, "block long, bucket long, size long, codes binary, counts binary"
    )


def code_counts(counted: DataFrame) -> DataFrame:
    """(bucket, code, n) from ``block_codes``, one row per code."""

    def add(rows: pa.Table) -> pa.Table:
        packed = zip(rows["counts"].to_pylist(), rows["size"].to_pylist(), strict=True)
        counts = np.concatenate([_unpacked(c, n, np.int64) for c, n in packed])
        codes = np.concatenate(_codes_of(rows))
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        starts = _starts(codes)
        bucket = np.full(len(starts), rows["bucket"][0].as_py(), np.int64)
        sums = np.add.reduceat(counts[order], starts)
        return pa.table({"bucket": bucket, "code": codes[starts], "n": sums})

    return counted.groupBy("bucket").applyInArrow(add, "bucket long, code long, n long")


def grow(codes: DataFrame, work: Workspace, buckets: int = 1) -> DataFrame:
    """(bucket, code, chance) from (code, n), one row per code: the probability of each code's last
    symbol after the ones before it. Codes with n = 0 are not learned from, and get the probability
    that the tree gives.
    """
    near = codes.select(F.col("code").alias("pair"), "n")
    levels = []
    for depth in range(_NEAR, -1, -1):
        shorter = F.col("pair").bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1))
        near = near.groupBy(shorter.alias("pair")).agg(F.sum("n").alias("n"))
        near = work.write(near, f"pairs-{depth}")
        levels.insert(0, near)
    # A context has at most as many rows as there are symbols.
    own = Window.partitionBy("context").orderBy("pair")
    own = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    smoothed = (F.col("n") + F.col("kinds") * F.col("below")) / (F.col("size") + F.col("kinds"))
    gain = F.when(F.col("n") > 0, F.col("n") * F.log(F.col("smoothed") / F.col("below")))
    chances = None
    for depth, pairs in enumerate(levels):
        if chances is None:
            pairs = pairs.withColumn("below", F.lit(1 / _SYMBOLS))
        else:
            pairs = _with_suffix(pairs, "pair", depth).join(chances, "suffix")
        kept = (F.col("size") > 0) & ((F.col("gain") > DIVERGENCE) | F.lit(depth == 0))
        chances = (
            pairs.withColumn("context", F.shiftright("pair", 8))
            .withColumn("size", F.sum("n").over(own))
            .withColumn("kinds", F.count(F.when(F.col("n") > 0, 1)).over(own))
            .withColumn("smoothed", F.when(F.col("size") > 0, smoothed))
            .withColumn("gain", F.sum(gain).over(own))
            .select(
                F.col("pair").alias("suffix"),
                F.when(kept, F.col("smoothed")).otherwise(F.col("below")).alias("below"),
            )
        )
    chances = work.write(chances, "near")

    def deeper(rows: pa.Table) -> pa.Table:
        code = rows["code"].to_numpy()
        n, below = rows["n"].to_numpy(), rows["below"].to_numpy()
        for depth in range(_NEAR + 1, DEPTH + 1):
            pair, first, place = np.unique(
                code & ((1 << 8 * (depth + 1)) - 1), return_index=True, return_inverse=True
            )
            count = np.bincount(place, n, len(pair))
            before = below[first]
            starts = _starts(pair >> 8)  # of the contexts, as pairs are sorted
            lengths = np.diff(starts, append=len(pair))
            size = np.repeat(np.add.reduceat(count, starts), lengths)
            kinds = np.repeat(np.add.reduceat((count > 0).astype(float), starts), lengths)
            smoothed = (count + kinds * before) / np.maximum(size + kinds, 1)
            # A context that is not learned from has no gain.
            ratio = np.log(smoothed / before, out=np.zeros(len(pair)), where=count > 0)
            gain = np.repeat(np.add.reduceat(count * ratio, starts), lengths)
            below = np.where(gain > DIVERGENCE, smoothed, before)[place]
        return pa.table({"bucket": _bucket(code, buckets), "code": code, "chance": below})

    context = F.shiftright("code", 8).bitwiseAND(F.lit((1 << 8 * (_NEAR + 1)) - 1))
    groups = max(1, codes.count() // _GROUP)
    return (
        _with_suffix(codes.select("code", "n"), "code", _NEAR + 1)
        .join(chances, "suffix")
        .groupBy(F.pmod(F.xxhash64(context), F.lit(groups)).alias("group"))
        .applyInArrow(deeper, "bucket long, code long, chance double")
    )


def _with_suffix(pairs: DataFrame, pair: str, depth: int) -> DataFrame:
    """The pair that is one symbol shorter than that of ``depth``, as column ``suffix``."""
    return pairs.withColumn("suffix", F.col(pair).bitwiseAND(F.lit((1 << 8 * depth) - 1)))


def _to_blocks(counted: DataFrame, values: DataFrame) -> DataFrame:
    """(block, size, codes, found): the value of every code of a block, packed."""

    def place(rows: pa.Table, tree: pa.Table) -> pa.Table:
        code, value = tree["code"].to_numpy(), tree["value"].to_numpy()
        order = np.argsort(code)
        code, value = code[order], value[order]
        found = [_packed(value[np.searchsorted(code, own)]) for own in _codes_of(rows)]
        return rows.select(["block", "size", "codes"]).append_column(
            "found", pa.array(found, pa.binary())
        )

    return (
        counted.select("block", "bucket", "size", "codes")
        .groupBy("bucket")
        .cogroup(values.groupBy("bucket"))
        .applyInArrow(place, "block long, size long, codes binary, found binary")
    )


def _looked_up(table: np.ndarray, values: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The value of every code, looked up once for equal ones; all are in the sorted table."""
    if len(codes) == 0:
        return np.zeros(0)
    order = np.argsort(codes)
    ordered = codes[order]
    starts = _starts(ordered)
    found = values[np.searchsorted(table, ordered[starts])]
    each = np.empty(len(codes))
    each[order] = np.repeat(found, np.diff(starts, append=len(codes)))
    return each


def score_texts(
    docs: DataFrame, training: Column, id: str = "doc_id", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """``id`` with n_tokens, n_known, train_tokens, base_score and score of every row.

    Learns from the rows where ``training`` holds; null texts are empty. Tokens are words and one
    end per text. ``base_score`` sums log10((c + 1) / (N + V + 1)) over tokens (c: count in
    training, N: all tokens, V: different ones), ``n_known`` counts tokens with c > 0, and ``score``
    is the model's log10 probability of the text. Rows that repeat are each scored; without training
    rows every token is unknown and symbols are equally likely. An empty table gives an empty table.
    Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    work = Workspace(spark, "suffix-tree")
    learn = F.coalesce(training, F.lit(False))
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), learn.alias("learn"))
    blocks = work.write(_in_blocks(rows, block), "blocks")
    buckets = blocks.select("block").distinct().count()
    buckets = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counted = work.write(block_codes(blocks, buckets), "counted")
    codes = work.write(code_counts(counted), "codes")
    words = codes.where("code < 0")
    ends = blocks.where("learn").count()
    seen = words.where("n > 0").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).first()
    tokens = (seen["n"] or 0) + ends
    floor = tokens + seen["kinds"] + (ends > 0) + 1
    grown = grow(codes.where("code >= 0"), work, buckets)
    values = grown.select("bucket", "code", F.log10("chance").alias("value")).union(
        words.select("bucket", "code", F.col("n").cast("double").alias("value"))
    )
    known = _to_blocks(counted, values)

    def score(own: pa.Table, tree: pa.Table) -> pa.Table:
        packed = zip(tree["found"].to_pylist(), tree["size"].to_pylist(), strict=True)
        value = np.concatenate([_unpacked(v, n, np.float64) for v, n in packed])
        code = np.concatenate(_codes_of(tree))
        order = np.argsort(code)
        code, value = code[order], value[order]
        cut = int(np.searchsorted(code, 0))  # words, then codes
        column = own["text"].combine_chunks()
        size = len(column)
        base, scores = np.zeros(size), np.zeros(size)
        n_known, n_tokens = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for first, last, texts in _chunks(column):
            symbols, starts, n_words = _stream(texts)
            # Tokens of a text are its words and the end.
            owner = np.repeat(np.arange(first, last), n_words + 1)
            each = _looked_up(code[cut:], value[cut:], symbols)
            scores += np.bincount(owner, np.add.reduceat(each, starts), size)
            is_end = np.zeros(len(starts), bool)
            is_end[np.cumsum(n_words + 1) - 1] = True
            count = np.full(len(starts), float(ends))
            hashes = _word_codes(column.slice(first, last - first))
            count[~is_end] = _looked_up(code[:cut], value[:cut], hashes)
            base += np.bincount(owner, np.log10((count + 1) / floor), size)
            n_known += np.bincount(owner[count > 0], minlength=size)
            n_tokens[first:last] = n_words + 1
        return pa.table(
            {
                "id": own["id"],
                "n_tokens": n_tokens,
                "n_known": n_known,
                "base_score": base,
                "score": scores,
            }
        )

    kind = docs.schema[id].dataType.simpleString()
    scored = (
        blocks.select("block", "id", "text")
        .groupBy("block")
        .cogroup(known.groupBy("block"))
        .applyInArrow(
            score, f"id {kind}, n_tokens long, n_known long, base_score double, score double"
        )
    )
    return scored.select(
        F.col("id").alias(id),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
