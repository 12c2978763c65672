"""Near duplicates, embeddings, search, components and the suffix tree against plain versions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shiftline.llm import components, embedding_dup, near_dup, pivot_search, suffix_tree, words
from shiftline.llm.workspace import Workspace

from test_documents import SQL_WORD, docs_of, lower


def plain_components(ids, links):
    label = {i: i for i in ids}
    while True:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
        if not changed:
            return label


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(1000, 1400)] + [(7, i) for i in range(8, 300)]
    links += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    links += links[:50] + [(b, a) for a, b in links[:50]] + [(1, 1)]
    df = spark.createDataFrame(links, "a long, b long")
    found = components.connected_components(df, Workspace(spark, "test"), "x").collect()
    ids = {i for a, b in links if a != b for i in (a, b)}
    assert {r["id"]: r["component"] for r in found} == plain_components(ids, [x for x in links if x[0] != x[1]])
    assert len(found) == len(ids)
    assert components.connected_components(df.limit(0), Workspace(spark, "test"), "x").count() == 0


def test_word_hashes(monkeypatch):
    rng = random.Random(0)
    texts = ["".join(rng.choices("aAbé \n\t.", k=rng.randint(0, 40))) for _ in range(500)]
    texts += [None, "", "ab cd " * 30 + "z" * 100 + " q"]
    seen = {}
    for group in (1 << 20, 300, 40):
        monkeypatch.setattr(words, "GROUP", group)
        for first, end, hashes, bounds in words.word_hashes(pa.array(texts)):
            for k in range(end - first):
                own = hashes[bounds[k] : bounds[k + 1]].tolist()
                expected = SQL_WORD.findall(lower(texts[first + k]))
                assert len(own) == len(expected)
                assert all(seen.setdefault(w, h) == h for w, h in zip(expected, own, strict=True))
    assert len(set(seen.values())) == len(seen)


def shingles(text):
    own = SQL_WORD.findall(lower(text))
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def check_duplicates(spark, rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                links.append((a, b))
    label = plain_components(ids, links)
    found = near_dup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").withColumn("values", F.lit(1)).repartition(4)
    ).collect()
    assert len(found) == len(rows)
    for row in found:
        if row["doc_id"] is not None:
            assert row["component_id"] == label[row["doc_id"]], row
            assert row["n_shingles"] == len(sets[row["doc_id"]])
        else:
            assert row["component_id"] is None
    return len(set(label.values()))


def near_copies(rng, n, size, changes, first):
    vocabulary = [f"w{i}" for i in range(400)]
    base = rng.choices(vocabulary, k=size)
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(size)] = rng.choice(vocabulary)
        rows.append((first + i, " ".join(own)))
    return rows


@pytest.mark.parametrize("node, depth", [(2048, 12), (12, 12), (8, 1)])
def test_near_duplicates(spark, monkeypatch, node, depth):
    """Small nodes force blocks, branching and, with little depth, pairs of blocks."""
    monkeypatch.setattr(near_dup, "NODE", node)
    monkeypatch.setattr(near_dup, "DEPTH", depth)
    rng = random.Random(4)
    rows = near_copies(rng, 60, 120, 5, 1000) + near_copies(rng, 25, 300, 14, 2000)
    rows += [(3000 + i, " ".join(rng.choices("abcdefghij", k=rng.randint(0, 9)))) for i in range(30)]
    rows += [(4000 + i, rows[0][1].upper() + " \n") for i in range(15)]
    rows += [(1, None), (2, ""), (3, " \t"), (4, "a b"), (5, "A  b"), (6, "a"), (7, "x " * 9000)]
    rows += [(None, rows[0][1]), (None, None), rows[5], rows[5]]
    assert check_duplicates(spark, rows) > 20


def test_every_large_node_branches_at_two_places(spark, monkeypatch):
    """Sets that agree everywhere never split: eight nodes after three levels, all pairs of blocks."""
    monkeypatch.setattr(near_dup, "NODE", 8)
    monkeypatch.setattr(near_dup, "DEPTH", 3)
    values = [7] * near_dup.PLACES
    roots = spark.createDataFrame([(5, i, i) for i in range(20)], "node long, rep long, label long")
    classes = spark.createDataFrame([(i, values) for i in range(20)], "rep long, values array<short>")
    members = near_dup._small_nodes(roots, classes, Workspace(spark, "test"))
    assert members.count() == 2**3 * 20 * 10
    # A tree misses a pair at the threshold with probability (1 - s) / s, whatever its depth.
    assert (1 / 3) ** near_dup.TREES <= near_dup.MISSED == 2e-6


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(empty).count() == 0


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


def odd_vectors(rng):
    base = rng.standard_normal((40, 16))
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(base)]
    for i in range(150):
        v = base[i % 7] + rng.standard_normal(16) * 0.12
        rows.append((100 + i, [float(x) for x in np.float32(v)]))
    rows += [(400 + i, rows[3][1]) for i in range(20)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None] * 8, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0]]
    return rows + [(450 + 50 * i, v) for i, v in enumerate(odd)]


@pytest.mark.parametrize("bucket", [1024, 10])
def test_near_embeddings(spark, monkeypatch, bucket):
    monkeypatch.setattr(embedding_dup, "BUCKET", bucket)
    rows = odd_vectors(np.random.default_rng(1))
    good = {}
    for i, v in rows:
        if v and None not in v and all(map(math.isfinite, v)) and any(v):
            good[i] = np.array(v, float)
    links = []
    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]):
                if good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= 0.95:
                    links.append((a, b))
    count = Counter(i for link in links for i in link)
    label = plain_components([i for i, _ in rows], links)
    found = embedding_dup.near_embeddings(vectors_of(spark, rows).withColumn("signs", F.lit(1))).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row["n_links"] == count[row["vec_id"]], row
        assert row["component_id"] == label[row["vec_id"]], row
    assert embedding_dup.near_embeddings(vectors_of(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("segment", [4096, 16])
def test_search(spark, monkeypatch, segment):
    monkeypatch.setattr(pivot_search, "SEGMENT", segment)
    rows = odd_vectors(np.random.default_rng(2))
    rows += [(910, rows[3][1]), (None, rows[3][1])]
    good = {}
    for i, v in rows:
        if i is not None and v and None not in v and all(map(math.isfinite, v)):
            good[i] = np.floor(256 * np.array(v, float)).astype(int)
    found = {}
    df = vectors_of(spark, rows + [rows[8], rows[50]]).withColumn("pivot", F.lit(1))
    for r in pivot_search.search_top(df, "vec_id % 10 = 0").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    queries = [i for i in good if i % 10 == 0]
    for q in queries:
        scores = [(-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q])]
        best = [(k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:5])]
        assert sorted(found.pop(q, [])) == best, q
    assert not found
    assert pivot_search.search_top(df.limit(0)).count() == 0


def test_embeddings_without_ids_are_linked(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.01]), (None, [0.0, 1.0]), (None, [0.0, 1.0]), (None, [0.01, 1.0])]
    rows += [(7, [-1.0, 0.0]), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [tuple(r) for r in embedding_dup.near_embeddings(df).collect()]
    wanted = [(None, 1, 1), (1, 1, 1), (None, 2, None), (None, 2, None), (None, 2, None), (7, 0, 7), (None, 0, None)]
    assert sorted(found, key=str) == sorted(wanted, key=str)


class PlainTree:
    """Counts and chances by dictionaries, one symbol after the other."""

    def __init__(self, texts):
        self.counts = defaultdict(Counter)
        for text in texts:
            for context, symbol in self.symbols(text):
                for depth in range(suffix_tree.DEPTH + 1):
                    self.counts[context[len(context) - depth :]][symbol] += 1
        self.kept = {}

    @staticmethod
    def symbols(text):
        words = "".join(w + " " for w in SQL_WORD.findall(lower(text)))
        data = b"\xfe" * suffix_tree.DEPTH + words.encode() + b"\xff"
        return [(data[i - suffix_tree.DEPTH : i], data[i]) for i in range(suffix_tree.DEPTH, len(data))]

    def smoothed(self, context, symbol):
        own = self.counts[context]
        below = self.chance(context[1:], symbol) if context else 1 / 257
        return (own[symbol] + len(own) * below) / (own.total() + len(own)), below

    def is_kept(self, context):
        if context not in self.kept:
            gain = 0
            for symbol, n in self.counts[context].items() if context in self.counts else ():
                chance, below = self.smoothed(context, symbol)
                gain += n * math.log(chance / below)
            self.kept[context] = gain > suffix_tree.DIVERGENCE or (not context and bool(self.counts))
        return self.kept[context]

    def chance(self, context, symbol):
        while context and not self.is_kept(context):
            context = context[1:]
        return self.smoothed(context, symbol)[0] if self.is_kept(context) else 1 / 257

    def log10(self, text):
        return sum(math.log10(self.chance(c, s)) for c, s in self.symbols(text))


def test_suffix_tree(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choices("The the of banana Über x".split(), k=rng.randint(0, 60))) for _ in range(80)]
    texts += [None, "", " \n", "zzz unseen", "the " * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "the of")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1))
    training = F.coalesce(F.col("doc_id") % 7 != 2, F.lit(True))
    found = suffix_tree.score_texts(docs, training, block=2000).toPandas()  # many blocks
    tokens = [[*SQL_WORD.findall(lower(t)), None] for _, t in rows]
    counts = Counter(w for (i, _), own in zip(rows, tokens, strict=True) if i is None or i % 7 != 2 for w in own)
    total, kinds = sum(counts.values()), len(counts)
    wanted = {}
    for (i, _), own in zip(rows, tokens, strict=True):
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own)
        wanted.setdefault(i, []).append((len(own), sum(counts[w] > 0 for w in own), base))
    assert len(found) == len(rows)
    tree = PlainTree(t for i, t in rows if i is None or i % 7 != 2)
    plain = sorted(tree.log10(t) for _, t in rows)
    assert sorted(found["score"]) == pytest.approx(plain, rel=1e-9)
    by_id = found.set_index("doc_id")["score"]
    for i, text in rows[4:85:9]:
        assert by_id[i] == pytest.approx(tree.log10(text), rel=1e-9)
    assert found["score"].max() < 0
    for row in found.itertuples():
        n, known, base = wanted[None if np.isnan(row.doc_id) else int(row.doc_id)][0]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (n, known, total)
        assert row.base_score == pytest.approx(base, rel=1e-9)
    empty = docs.limit(0)
    assert suffix_tree.score_texts(empty, training).count() == 0
    unlearned = suffix_tree.score_texts(docs, F.lit(False)).toPandas()
    assert unlearned["n_known"].sum() == 0
    assert sorted(unlearned["score"]) == pytest.approx(sorted(PlainTree([]).log10(t) for _, t in rows))


def test_symbols_of_every_state_sum_to_one(spark):
    docs = [("the of the banana ban",), ("über the",)] * 30
    blocks = spark.createDataFrame(docs, "text string").withColumn("block", F.lit(0).cast("long"))
    counted = suffix_tree.code_counts(suffix_tree.block_codes(blocks.withColumn("learn", F.lit(True)), 3))
    asked = [
        (int.from_bytes(context, "big") << 8 | symbol, 0)
        for context in (b"\xfe\xfe\xfe\xfe\xfe", b"n the", b" bana", b"qqqqq")
        for symbol in range(256)
    ]
    codes = counted.where("code >= 0").select("code", "n").union(spark.createDataFrame(asked, "code long, n long"))
    grown = suffix_tree.grow(codes.groupBy("code").agg(F.sum("n").alias("n")), Workspace(spark, "test"))
    sums = grown.where(F.col("code").isin([c for c, _ in asked])).groupBy(F.shiftright("code", 8)).agg(F.sum("chance"))
    # One of the 257 equally likely symbols of an unknown state is not a byte.
    assert [r[1] for r in sums.collect()] == [pytest.approx(1, abs=1 / 257)] * 4



def test_near_duplicates_leave_tables_as_soon_as_they_are_read(spark, monkeypatch):
    texts = [" ".join(f"w{(i * k) % 97}" for k in range(30)) for i in range(20)]
    docs = spark.createDataFrame([(i, texts[i // 2]) for i in range(40)], "doc_id long, text string")
    steps = []
    write, drop = Workspace.write, Workspace.drop
    monkeypatch.setattr(Workspace, "write", lambda self, df, table: steps.append(table) or write(self, df, table))
    monkeypatch.setattr(Workspace, "drop", lambda self, table: steps.append(f"-{table}") or drop(self, table))
    found = near_dup.near_duplicates(docs).collect()
    assert len(found) == 40 and all(r.component_id <= r.doc_id for r in found)
    for table, later in (
        ("first-blocks", "first-links"),
        ("roots", "more-pairs"),
        ("classes", "more-pairs"),
        ("level-0", "more-pairs"),
        ("members", "more-links"),
        ("sets", "components"),
    ):
        assert steps.index(table) < steps.index(f"-{table}") < steps.index(later), table
