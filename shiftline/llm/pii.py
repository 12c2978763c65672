"""Personal data: patterns, and a linear-chain conditional random field over word shapes.

The patterns (``base_spans``) are kept as they are found. The random field labels words by their
shape, the shapes beside them and cue words, and adds what the patterns miss, such as phone numbers
without a country code. It is trained from the small labelled table in ``pii_examples``.

Only a word with a digit or an @ can bear a label other than none; that is part of the model. So the
chain falls into runs of such words between words that are none for certain, and the runs are
decoded by Viterbi, many at once. This gives the same labels as decoding whole lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftline.llm.pii_examples import EXAMPLES
from shiftline.llm.workspace import ship

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"

# Fixed patterns. Possessive repeats and the look-behind match the same texts as plain ones, in
# linear time.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SUSPECT = re.compile(r"[0-9@]")
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DIGITS = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: each @ with the whole run of local characters before it."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of what the patterns find, sorted."""
    found = [(a, 0, b) for a, b in _emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# --- the random field -------------------------------------------------------------------------

# None, and the first and later words of each kind.
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_CUES = {
    "phone": "phone tel telephone telefon teléfono tél téléphone call dial fax mobile cell number",
    "card": "card visa mastercard amex credit paid",
    "mail": "mail e-mail email write contact reply",
    "ip": "ip host server address client from",
    "none": "version v isbn order invoice serial tracking commit sha token key id doi zip build page"
    " pages section chapter volume table population",
}
_CUE_OF = {word: cue for cue, words in _CUES.items() for word in words.split()}
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGIT_RUN = re.compile(r"[0-9]+")


def _shape(word: str) -> str:
    """Letters become one a, runs of digits their length: (743) is (9:3)."""
    shape = _LETTERS.sub("a", word)
    return _DIGIT_RUN.sub(lambda m: f"<{min(m.end() - m.start(), 20)}>", shape)


def _core(word: str) -> tuple[int, int]:
    """Where the word begins and ends without the marks around it."""
    a, b = 0, len(word)
    while a < b and not (word[a].isalnum() or word[a] in "+("):
        a += 1
    while b > a and not (word[b - 1].isalnum() or word[b - 1] == ")"):
        b -= 1
    return a, b


def _beside(word: str) -> str:
    """What matters of a neighbour: its cue, or its shape if it has digits, or whether it is there.
    """
    if not word:
        return "edge"
    if _SUSPECT.search(word):
        a, b = _core(word)
        return _shape(word[a:b])
    return "cue-" + _CUE_OF.get(word.strip(".,:;()\"'").lower(), "word")


def _features(word: str, before: str, after: str) -> list[str]:
    a, b = _core(word)
    core = word[a:b]
    digits = sum(c.isdigit() for c in core)
    shape = _shape(core)
    letters = any(c.isalpha() for c in core)
    return [
        "bias",
        f"shape {shape}",
        f"digits {min(digits, 20)}",
        f"kinds {'@' in core} {letters} {digits > 0} {core.count('.')} {core.count('-')} {core.count(':') > 1}",
        f"ends {core[:1] if core[:1] in '+(' else 'x'} {core[-1:] == ')'}",
        f"before {before}",
        f"after {after}",
        f"shape-before {shape} {before}",
        f"cue-digits {before} {min(digits, 20)}",
    ]


def _word_before(text: str, end: int) -> str:
    """The last word before ``end`` in its line, or nothing."""
    while end > 0 and text[end - 1] != "\n" and text[end - 1].isspace():
        end -= 1
    start = end
    while start > 0 and not text[start - 1].isspace():
        start -= 1
    return text[start:end]


def _lines(text: str) -> Iterator[tuple[str, list[tuple[str, int]]]]:
    """Runs of suspect words within lines: the word before, (word, start) each, the word after."""
    done, size = 0, len(text)
    while match := _SUSPECT.search(text, done):
        a = match.start()
        while a > 0 and text[a - 1] not in " \t\n\x0b\x0c\r":
            a -= 1
        run: list[tuple[str, int]] = []
        before = _word_before(text, a)
        while True:
            blank = _BLANK.search(text, a)
            b = blank.start() if blank else size
            run.append((text[a:b], a))
            # The next word of the line joins the run if it is suspect too.
            following = _WORD.search(text, b)
            if not following or "\n" in text[b : following.start()]:
                after, done = "", b
                break
            if not _SUSPECT.search(following[0]):
                after, done = following[0], b
                break
            a = following.start()
        yield before, run, after


def _rows(runs) -> tuple[list[tuple[str, str, str]], np.ndarray]:
    """Per word of all runs (word, before, after); and the runs' lengths."""
    words, lengths = [], []
    for before, run, after in runs:
        texts = [w for w, _ in run]
        sides = [_beside(w) for w in texts]
        for i, w in enumerate(texts):
            words.append(
                (
                    w,
                    sides[i - 1] if i else _beside(before),
                    sides[i + 1] if i + 1 < len(texts) else _beside(after),
                )
            )
        lengths.append(len(texts))
    return words, np.array(lengths, np.int64)


class Field:
    """Weights by feature and label, and by pairs of labels; runs begin and end beside none."""

    def __init__(self, features: dict[str, int], emission: np.ndarray, transition: np.ndarray):
        self.features, self.emission, self.transition = features, emission, transition
        self.known: dict[tuple[str, str, str], np.ndarray] = {}

    def scores(self, words: list[tuple[str, str, str]]) -> np.ndarray:
        if len(self.known) > 200_000:
            self.known.clear()
        rows = []
        for word, before, after in words:
            a, b = _core(word)
            key = (_shape(word[a:b]) if len(word) < 200 else word, before, after)
            row = self.known.get(key)
            if row is None:
                numbers = [
                    self.features[f] for f in _features(word, before, after) if f in self.features
                ]
                row = self.known[key] = self.emission[numbers].sum(axis=0)
            rows.append(row)
        return np.array(rows).reshape(-1, len(LABELS))

    def labels(self, words: list[tuple[str, str, str]], lengths: np.ndarray) -> np.ndarray:
        """Viterbi over all runs at once, one step per position within the runs."""
        score = self.scores(words)
        best = np.zeros(len(words), np.int64)
        if not len(words):
            return best
        order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        sizes = lengths[order]
        back = np.zeros(score.shape, np.int8)
        delta = score[starts] + self.transition[0]
        active = [len(sizes)]
        for t in range(1, int(sizes[0])):
            n = int(np.searchsorted(-sizes, -t, side="left"))
            active.append(n)
            step = delta[:n, :, None] + self.transition
            back[starts[:n] + t] = step.argmax(axis=1)
            delta[:n] = step.max(axis=1) + score[starts[:n] + t]
        last = (delta + self.transition[:, 0]).argmax(axis=1)
        best[starts + sizes - 1] = last
        for t in range(int(sizes[0]) - 1, 0, -1):
            at = starts[: active[t]] + t
            best[at - 1] = back[at, best[at]]
        return best


def _example(line: str) -> tuple[str, list[tuple[int, int, str]]]:
    text, spans = "", []
    for part in re.split(r"(<[a-z]+:[^>]+>)", line):
        if m := re.fullmatch(r"<([a-z]+):([^>]+)>", part):
            spans.append((len(text), len(text) + len(m[2]), m[1]))
            part = m[2]
        text += part
    return text, spans


def train(examples: str = EXAMPLES, rounds: int = 400, rate: float = 0.3, ridge: float = 0.02) -> Field:
    """Maximum likelihood with a ridge penalty, by AdaGrad over the whole table at once."""
    runs, gold = [], []
    for line in examples.strip().splitlines():
        text, spans = _example(line)
        for before, run, after in _lines(text):
            runs.append((before, run, after))
            marked = []
            for word, at in run:
                label, a = "O", at + _core(word)[0]
                for start, end, kind in spans:
                    if start <= a < end:
                        label = ("B-" if a - start < len(word) and start >= at - 1 else "I-") + kind
                marked.append(LABELS.index(label))
            gold.append(marked)
    words, lengths = _rows(runs)
    named = [_features(*w) for w in words]
    features: dict[str, int] = {}
    for names in named:
        for name in names:
            features.setdefault(name, len(features))
    n, most, k = len(runs), int(lengths.max()), len(LABELS)
    used = np.zeros((len(words), len(features)))
    for i, names in enumerate(named):
        used[i, [features[f] for f in names]] = 1
    starts = np.cumsum(lengths) - lengths
    truth = np.concatenate([np.array(g) for g in gold])
    pairs = np.zeros((k, k))
    for g in gold:
        for a, b in zip([0, *g], [*g, 0], strict=True):
            pairs[a, b] += 1
    gold_use = np.zeros((len(features), k))
    np.add.at(gold_use.T, truth, used)
    emission, transition = np.zeros((len(features), k)), np.zeros((k, k))
    seen = [np.full(emission.shape, 1e-8), np.full(transition.shape, 1e-8)]
    for _ in range(rounds):
        score = used @ emission
        forward = np.zeros((n, most, k))
        backward = np.zeros((n, most, k))
        forward[:, 0] = transition[0] + score[starts]
        for t in range(1, most):
            on = lengths > t
            step = forward[on, t - 1][:, :, None] + transition
            forward[on, t] = np.logaddexp.reduce(step, axis=1) + score[starts[on] + t]
        ends = np.arange(n), lengths - 1
        total = np.logaddexp.reduce(forward[ends] + transition[:, 0], axis=1)
        backward[ends] = transition[:, 0]
        for t in range(most - 2, -1, -1):
            on = lengths > t + 1
            ahead = transition + (score[starts[on] + t + 1] + backward[on, t + 1])[:, None, :]
            backward[on, t] = np.logaddexp.reduce(ahead, axis=2)
        expected = np.zeros((k, k))
        share = np.zeros((len(words), k))
        for t in range(most):
            on = lengths > t
            share[starts[on] + t] = np.exp(forward[on, t] + backward[on, t] - total[on, None])
            if t + 1 == most:
                break
            on = lengths > t + 1
            joint = forward[on, t][:, :, None] + transition
            joint = joint + (score[starts[on] + t + 1] + backward[on, t + 1])[:, None, :]
            expected += np.exp(joint - total[on, None, None]).sum(axis=0)
        expected[0] += share[starts].sum(axis=0)
        expected[:, 0] += share[starts + lengths - 1].sum(axis=0)
        steps = (
            gold_use - used.T @ share - ridge * emission,
            pairs - expected - ridge * transition,
        )
        for weights, step, squares in zip((emission, transition), steps, seen, strict=True):
            squares += step**2
            weights += rate * step / np.sqrt(squares)
    return Field(features, emission, transition)


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train()


def _plausible(kind: str, text: str) -> bool:
    numerals = "".join(c for c in text if c in "0123456789")
    digits = len(numerals)
    if kind == "email":
        return "@" in text[1:-1]
    if kind == "ip":
        return digits >= 4 and (text.count(".") == 3 or text.count(":") >= 2)
    if kind == "card":
        return 13 <= digits <= 19 and _luhn(numerals)
    return 7 <= digits <= 15


def find_spans(texts: list[str], field: Field) -> list[list[tuple[int, int, int, bool]]]:
    """Per text (start, number of the kind, end, whether a pattern found it), sorted."""
    result, runs, owners = [], [], []
    for i, text in enumerate(texts):
        if not _SUSPECT.search(text):
            result.append([])
            continue
        result.append([(a, k, b, True) for a, k, b in base_spans(text)])
        for run in _lines(text):
            runs.append(run)
            owners.append(i)
    words, lengths = _rows(runs)
    labels = field.labels(words, lengths)
    at = 0
    for owner, (_, run, _) in zip(owners, runs, strict=True):
        own = [LABELS[n] for n in labels[at : at + len(run)]]
        at += len(run)
        if not any(label != "O" for label in own):
            continue
        spans, current = [], None
        for label, (word, start) in zip(own, run, strict=True):
            a, b = _core(word)
            if label[0] == "I" and current and current[0] == label[2:]:
                current[2] = start + b
            elif label != "O":
                current = [label[2:], start + a, start + b]
                spans.append(current)
            else:
                current = None
        base = [(s, e) for s, _, e, is_base in result[owner] if is_base]
        for kind, s, e in spans:
            if _plausible(kind, texts[owner][s:e]) and not any(s < y and x < e for x, y in base):
                result[owner].append((s, KINDS.index(kind), e, False))
    return [sorted(r) for r in result]


def _spans_of(texts: Iterable[str | None], field: Field) -> Iterator[list[dict]]:
    """The spans of each text; a null text has none."""
    texts = [t or "" for t in texts]
    for at in range(0, len(texts), 512):
        for found in find_spans(texts[at : at + 512], field):
            yield [{"kind": KINDS[k], "start": a, "end": b, "base": is_base} for a, k, b, is_base in found]


def personal_spans(text: str = "text", field: Field | None = None) -> Column:
    """Array of (kind, start, end, base) by start, then kind; code points, ends exclusive.

    ``base`` tells what the patterns found. Null and empty texts have an empty array.
    """
    field = field or default_field()
    weights = (field.features, field.emission, field.transition)

    ship()

    @F.pandas_udf(SPANS)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Field(*weights)
        for batch in batches:
            yield pd.Series(list(_spans_of(batch, own)), dtype=object)

    return spans(F.col(text))


def mask_spans(text: str, spans: Column | None = None, field: Field | None = None) -> Column:
    """The text with each stretch of (overlapping) spans replaced by [KIND] of the first one.

    Time is in proportion to the text, however many spans it has. A null text stays null. Without
    ``spans`` they are those of ``personal_spans``, found in the same Python worker: spans that come
    from a worker of their own take a second worker per task.
    """
    if spans is None:
        field = field or default_field()
        weights = (field.features, field.emission, field.transition)

        ship()

        @F.pandas_udf("string")
        def mask_found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = Field(*weights)
            for batch in batches:
                found = zip(batch, _spans_of(batch, own), strict=True)
                yield pd.Series([_masked(t, s) for t, s in found], dtype=object)

        return mask_found(F.col(text))

    @F.pandas_udf("string")
    def mask(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([_masked(t, s) for t, s in zip(texts, found, strict=True)], dtype=object)

    return mask(F.col(text), spans)


def _masked(text: str | None, spans: Iterable[Mapping]) -> str | None:
    if text is None:
        return None
    parts, done = [], 0
    for span in spans:
        if span["start"] >= done:
            parts += [text[done : span["start"]], f"[{span['kind'].upper()}]"]
        done = max(done, span["end"])
    return "".join([*parts, text[done:]])


def find_personal_data(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """Add ``pii_spans`` (see ``personal_spans``) to ``docs``; an input column of that name goes.

    Whole texts of any length are read. Equal texts get equal spans; an empty table stays empty.
    """
    kept = [c for c in docs.columns if c != "pii_spans"]
    return docs.select(*kept, personal_spans(text, field).alias("pii_spans"))
