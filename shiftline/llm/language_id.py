"""Language identification by nearest centroid.

A text becomes a vector of its letter trigrams: letters are folded to lower case, everything else
separates words, trigrams are hashed to ``FEATURES`` places, counts are damped, weighted by inverse
document frequency and brought to length 1. Each language has several centroids, from spherical
k-means over a bounded sample of its labelled rows, so that different kinds of text do not blur into
one mean. A text gets the language of the centroid with the largest cosine. It is rejected when it
is farther from that centroid than the sampled texts of the language are, by a wide margin. A long
text fills most places and so resembles every centroid; its distance is therefore the mean over
windows of ``WINDOW`` characters that cover the whole text, alike for the sampled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftline.llm.columns import all_but, free
from shiftline.llm.workspace import Workspace, ship

FEATURES = 4096
SAMPLE = 400  # labelled rows per language that the fit looks at, in expectation
CENTROIDS = 4
WINDOW = 2048  # characters judged at once for rejection
GROUP = 256  # windows of a text held at once
LOW = 0.01  # quantile of the sample's evidence that the floor is taken from
# Share of that quantile below which a text is rejected. On 2,587 labelled rows of sf0.1 outside the
# sample the lowest evidence is 0.23 of it, that of made-up foreign texts at most 0.15.
MARGIN = 0.18
ENOUGH = 32  # different trigrams that a text must have to be judged by distance
SLICE = 1 << 20  # code points handled at once
UNKNOWN = "und"
RESULT = "lang_pred string, score double, rejected boolean"

_SPACE = 32
_folded: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Code point -> lower-case letter, or a blank for what is no letter."""
    if not _folded:
        table = np.full(0x110000, _SPACE, np.uint32)
        for code in range(0x32400):  # no letters are assigned above
            if chr(code).isalpha():
                table[code] = ord(chr(code).lower()[0])
        _folded.append(table)
    return _folded[0]


def _counts(texts: list[str]) -> np.ndarray:
    """Trigram counts of a few texts, one row each."""
    joined = "".join(f" {t} " for t in texts)
    codes = _fold()[np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)]
    owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)
    codes, owner = codes[keep], owner[keep]
    middle = codes[1:-1]
    mixed = (codes[:-2] * np.uint32(0x9E3779B1)) ^ (middle * np.uint32(0x85EBCA77))
    mixed ^= codes[2:] * np.uint32(0xC2B2AE3D)
    mixed *= np.uint32(0x27D4EB2F)
    mixed >>= np.uint32(20)  # 12 bits: FEATURES
    place = owner[1:-1] * FEATURES + mixed
    found = np.bincount(place[middle != _SPACE], minlength=len(texts) * FEATURES)
    return found.reshape(len(texts), FEATURES).astype(np.float32)


def trigram_counts(texts: list[str]) -> np.ndarray:
    """One row of counts per text. Long texts go through in slices, so memory stays bounded."""
    rows = np.zeros((len(texts), FEATURES), np.float32)
    group: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if len(text) > SLICE:
            for at in range(0, len(text), SLICE):
                rows[i] += _counts([text[max(at - 2, 0) : at + SLICE]])[0]
            continue
        if size + len(text) > SLICE:
            rows[group] = _counts([texts[k] for k in group])
            group, size = [], 0
        group.append(i)
        size += len(text)
    if group:
        rows[group] = _counts([texts[k] for k in group])
    return rows


def _unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts) * idf
    length = np.linalg.norm(weighted, axis=1, keepdims=True)
    return (weighted / np.where(length > 0, length, 1)).astype(np.float32)


def _evidence(cosine: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Cosine relative to what a text with so few different trigrams can reach."""
    distinct = (counts > 0).sum(axis=1)
    evidence = cosine / np.sqrt(np.clip(distinct, 1, 256) / 256)
    return np.where(distinct >= ENOUGH, evidence, np.inf)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]  # one per centroid
    centroids: np.ndarray
    floors: np.ndarray
    idf: np.ndarray

    def evidence(self, texts: list[str], counts: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Evidence of each text for a centroid: the mean over its windows, by their trigrams."""

        def of(counts: np.ndarray, centroids: np.ndarray) -> np.ndarray:
            return _evidence((_unit(counts, self.idf) * centroids).sum(axis=1), counts)

        result = of(counts, self.centroids[best])
        for i, text in enumerate(texts):
            if len(text) <= WINDOW:
                continue
            total = weight = 0.0
            for first in range(0, len(text), GROUP * WINDOW):
                last = min(first + GROUP * WINDOW, len(text))
                # Windows overlap by two characters, so that no trigram is lost between them.
                found = trigram_counts(
                    [text[max(a - 2, 0) : min(a + WINDOW, last)] for a in range(first, last, WINDOW)]
                )
                own = of(found, self.centroids[best[i]])
                some = np.isfinite(own)
                letters = found.sum(axis=1)[some]
                total += float((own[some] * letters).sum())
                weight += float(letters.sum())
            if weight:  # else no window has enough trigrams, and the whole text counts
                result[i] = total / weight
        return result

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        texts = [t or "" for t in texts]
        counts = trigram_counts(texts)
        lettered = counts.any(axis=1)
        if len(self.languages) == 0:
            best = score = np.zeros(len(texts), int)
            known, names = np.zeros(len(texts), bool), np.array([UNKNOWN])
            rejected = np.ones(len(texts), bool)
        else:
            cosines = _unit(counts, self.idf) @ self.centroids.T
            best = cosines.argmax(axis=1) if len(texts) else np.zeros(0, int)
            score = np.take_along_axis(cosines, best[:, None], 1)[:, 0]
            rejected = ~lettered | (self.evidence(texts, counts, best) < self.floors[best])
            known, names = lettered, np.array(self.languages, dtype=object)
        return pd.DataFrame(
            {
                "lang_pred": np.where(known, names[best], UNKNOWN),
                "score": np.where(known, np.clip(score, 0, 1), 0.0).astype(float),
                "rejected": rejected,
            }
        )


def _clusters(rows: np.ndarray, wanted: int) -> np.ndarray:
    """Spherical k-means; starts from rows far apart, so it has no random part."""
    chosen = [rows.mean(axis=0)]
    while len(chosen) < min(wanted, len(rows)) + 1:
        nearest = (rows @ np.array(chosen).T).max(axis=1)
        chosen.append(rows[nearest.argmin()])
    centers = np.array(chosen[1:])
    for _ in range(10):
        member = (rows @ centers.T).argmax(axis=1)
        sums = [rows[member == k].sum(axis=0) for k in range(len(centers))]
        centers = np.array([s / np.linalg.norm(s) for s in sums if np.linalg.norm(s) > 0])
    # The overall mean stays a centroid: small clusters of odd texts cannot displace it.
    mean = rows.mean(axis=0)
    return np.vstack([centers, mean / max(np.linalg.norm(mean), 1e-9)])


def fit(labelled: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> LanguageModel:
    """Fit on ``labelled`` (doc_id, text, lang).

    Looks at about ``sample`` rows per language, chosen by a hash of their doc_id, whole texts. Rows
    without a language or without a letter teach nothing. Without any labelled row the model
    rejects every text.
    """
    work = Workspace(labelled.sparkSession, "language-id")
    ship(labelled.sparkSession)
    labelled = labelled.select("doc_id", "text", "lang").where("lang IS NOT NULL")
    sizes = labelled.where("text IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n"))
    sizes = {r["lang"]: r["n"] for r in sizes.collect()}  # one row per language
    if not sizes:
        return LanguageModel([], np.zeros((0, FEATURES)), np.zeros(0), np.zeros(FEATURES))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    share = F.create_map(
        *(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n)))
    )
    drawn = labelled.where("text IS NOT NULL").where(draw < share[F.col("lang")])

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = trigram_counts(list(batch["text"]))
            some = counts.any(axis=1)
            yield pd.DataFrame(
                {
                    "lang": batch["lang"][some].to_numpy(),
                    "text": batch["text"][some].to_numpy(),
                    "counts": [c.tobytes() for c in counts[some]],
                }
            )

    drawn = work.write(drawn.mapInPandas(vectors, "lang string, text string, counts binary"), "sample")
    by_language = drawn.select("lang", "counts").groupBy("lang")

    def matrix(group: pd.DataFrame) -> np.ndarray:
        return np.array([np.frombuffer(c, np.float32) for c in sorted(group["counts"])])

    def frequencies(group: pd.DataFrame) -> pd.DataFrame:
        share = (matrix(group) > 0).mean(axis=0)
        return pd.DataFrame({"share": [share.astype(np.float64).tobytes()]})

    shares = by_language.applyInPandas(frequencies, "share binary").collect()
    if not shares:
        return LanguageModel([], np.zeros((0, FEATURES)), np.zeros(0), np.zeros(FEATURES))
    mean_share = np.mean([np.frombuffer(r["share"]) for r in shares], axis=0)
    idf = np.log((1 + 1 / sample) / (mean_share + 1 / sample)).astype(np.float32) + 0.1

    def train(group: pd.DataFrame) -> pd.DataFrame:
        centers = _clusters(_unit(matrix(group), idf), centroids)
        return pd.DataFrame(
            {
                "lang": group["lang"].iloc[0],
                "centroid": [c.astype(np.float32).tobytes() for c in centers],
            }
        )

    fitted = by_language.applyInPandas(train, "lang string, centroid binary")
    rows = sorted(fitted.collect(), key=lambda r: (r["lang"], r["centroid"]))
    names = [r["lang"] for r in rows]
    vectors_of = np.array([np.frombuffer(r["centroid"], np.float32) for r in rows])
    model = LanguageModel(names, vectors_of, np.zeros(len(rows)), idf)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = np.array([np.frombuffer(c, np.float32) for c in batch["counts"]])
            if len(counts) == 0:
                continue
            cosines = _unit(counts, idf) @ model.centroids.T
            cosines[batch["lang"].to_numpy()[:, None] != np.array(names, object)[None, :]] = -1
            evidence = model.evidence(list(batch["text"]), counts, cosines.argmax(axis=1))
            some = np.isfinite(evidence)
            yield pd.DataFrame({"lang": batch["lang"][some], "evidence": evidence[some]})

    judged = drawn.mapInPandas(judge, "lang string, evidence double").groupBy("lang")
    low = judged.agg(F.expr(f"percentile(evidence, {LOW}D)").alias("low")).collect()
    low = {r["lang"]: r["low"] for r in low}
    return replace(model, floors=np.array([min(low.get(n, 1.0), 1.0) * MARGIN for n in names]))


def predicted(model: LanguageModel, text: str = "text") -> Column:
    """A struct of lang_pred, score and rejected for every whole text."""

    ship()

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [
                model.predict(list(batch.iloc[at : at + 256])) for at in range(0, len(batch), 256)
            ]
            yield pd.concat(parts, ignore_index=True) if parts else model.predict([])

    return predict(F.col(text))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add lang_pred, score and rejected to ``docs``.

    ``score`` is the cosine to the nearest centroid, 0 to 1. A text that is null, empty or without a
    letter is ``und`` with score 0 and rejected. A text in a language that was not learned still
    gets the nearest one, and is rejected if it has ``ENOUGH`` different trigrams to judge it by.
    Equal texts get equal results; of centroids equally near, the first by language wins. An empty
    table gives an empty table. Input columns that bear a result's name are replaced.
    """
    found = free(docs.columns, "_found")
    kept = all_but(docs.columns, ["lang_pred", "score", "rejected"])
    return docs.withColumn(found, predicted(model, text)).select(*kept, f"{found}.*")
