"""Language, page text, mixing, licences, personal data and packing against plain versions."""

import time
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shiftline.llm import html_text, language_id, license_rules, mixing, packing, pii, stages
from shiftline.llm.license_scan import scan_licenses
from shiftline.llm.queries import op8_license_scan, op10_personal_data

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SQL_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def docs_of(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def sample():
    """Four kinds of text, long, short, empty and null ones, repeated rows."""
    rng = random.Random(5)
    words = {"en": "the of and to in that was", "de": "der die und das nicht ist ein", "fr": "le la et que pour une des"}
    rows = []
    for i in range(120):
        lang = rng.choice(sorted(words))
        own = words[lang].split() + [lang + w for w in ("ba", "ko", "ri")]
        rows.append((i, " ".join(rng.choices(own, k=rng.randint(30, 120))), lang, f"s{i % 4}", 0))
    rows += [(200, None, "en", "s1", None), (201, "", None, None, 0), (202, "123 !!", "de", "s2", 6)]
    rows += [(203, "the of " * 30_000, "en", "s0", 1), (None, "der die das", None, "s3", 2)]
    return rows + [rows[3], rows[3]]


def test_language(spark, sample):
    docs = docs_of(spark, sample)
    model = language_id.fit(docs)
    found = language_id.identify(docs.withColumn("score", F.lit("x")), model).toPandas()
    assert len(found) == len(sample)
    known = found[found["lang"].notna() & (found["doc_id"] < 200)]
    assert (known["lang_pred"] == known["lang"]).all()
    assert not known["rejected"].any()
    assert found["score"].between(0, 1).all()
    by_id = found.drop_duplicates("doc_id").set_index("doc_id")
    for i in (200, 201, 202):
        assert (by_id.lang_pred[i], by_id.score[i], by_id.rejected[i]) == ("und", 0.0, True)
    assert by_id.lang_pred[203] == "en"
    odd = docs_of(spark, [(1, "これは日本語で書かれた少し長い文章です。天気がよいので、明日は山へ行って写真を撮ろうと思います。", None, "s", 1)])
    assert language_id.identify(odd, model).first()["rejected"]
    nothing = docs.limit(0)
    assert language_id.identify(nothing, model).count() == 0
    assert language_id.identify(docs, language_id.fit(nothing)).where("rejected").count() == len(sample)


def test_long_foreign_texts_are_rejected():
    """A long text fills most hash places; it is judged by windows, whatever its length."""
    rng = random.Random(8)

    def speak(letters, n):
        known = ["".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(3000)]
        return " ".join(rng.choices(known, k=n))

    own, foreign = speak("abcdefghijklm", 20_000), speak([chr(0x430 + i) for i in range(30)], 20_000)
    idf = np.ones(language_id.FEATURES, np.float32)
    parts = [own[at : at + 2000] for at in range(0, len(own), 2000)]
    center = language_id._unit(language_id.trigram_counts(parts), idf).mean(axis=0)
    center /= np.linalg.norm(center)
    model = language_id.LanguageModel(["xx"], center[None, :], np.array([0.45]), idf)
    found = model.predict([foreign[:1500], foreign[:40_000], foreign, own[:1500], own])
    assert found["rejected"].tolist() == [True, True, True, False, False]


def test_long_texts_go_through_in_slices(monkeypatch):
    text = "the quick brown fox " * 50
    whole = language_id.trigram_counts([text])
    monkeypatch.setattr(language_id, "SLICE", 64)
    assert np.abs(language_id.trigram_counts([text, "x"])[0] - whole[0]).sum() < 40


PAGE = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this better for all of you.</p></div>
{}<div class=comments><p>Great article, thanks a lot for writing it.</p></div>
<form>Name <input></form><aside>More of this elsewhere on our site today.</aside>
<footer>&copy; 2020</footer></body></html>"""


@pytest.mark.parametrize(
    "body, text",
    [
        ("<article><h1>Title</h1><p>One &amp; <b>two.<p>a&nbsp; b<br>c</article>", "Title\nOne & two.\na b\nc"),
        ("<article><p>x<section class='reader-comments'>no</section><p>y</article>", "x\ny"),
        (
            "<div id=content><p>A paragraph that is long enough to count as text of the page.</p>"
            "<p>Short one.</p><p><!-- <p>no</p> -->The end of it comes here, after some words.</p></div>",
            "A paragraph that is long enough to count as text of the page.\nShort one.\n"
            "The end of it comes here, after some words.",
        ),
        (
            "<div id=content><p>A paragraph that is long enough to count as text of the page, and that"
            " is so by far.</p><div class=ad><p>Buy</p><p>our</p><p>things</p></div><p>End.</p></div>",
            "A paragraph that is long enough to count as text of the page, and that is so by far.\nEnd.",
        ),
    ],
)
def test_page_text(body, text):
    assert html_text.main_text(PAGE.format(body)) == text


BODY = "A paragraph that is long enough to count as text of the page, and that is so by far."


def test_page_text_surges_and_dives_on_every_page():
    """Articles weigh more only where they hold most text; short runs in them are no surge."""
    body = f"<div><p>{BODY}<p>{BODY}<p>The end.</div>"
    cards = "<article><p>A card on top.</article><article><p>Another card.</article>"
    assert html_text.main_text(cards + body + cards) == f"{BODY}\n{BODY}\nThe end."
    page = f"<div>Welcome back, dear reader.</div><article>{body}</article><article>A card.</article>"
    assert html_text.main_text(page) == f"{BODY}\n{BODY}\nThe end."
    ads = "<div class=ad>Buy</div>" * 4
    page = f"<article><div><p>{BODY}</div>{ads}<div><p>The end <a href=x>of it</a>.</div></article>"
    assert html_text.main_text(page) == f"{BODY}\nThe end of it."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div class='content with-sidebar'><p>{BODY}</div>", BODY),
        (f"<div class='comments'><p>{BODY}</div>", BODY),
        (f"<form><div><p>{BODY}</div></form>", BODY),
        (f"<article><p>{BODY}<p class='notice-period'>A month.</article>", f"{BODY}\nA month."),
        (f"<article><p>{BODY}<p>The <span class='search-hit'>term</span> <em class=ad>in</em> it.</article>", f"{BODY}\nThe term in it."),
        (f"<article><p>{BODY}<p>As <math><mi>x</mi><mo>=</mo><mn>1</mn></math> shows.</article>", f"{BODY}\nAs x=1 shows."),
    ],
)
def test_page_text_outweighs_hints(page, text):
    assert html_text.main_text(page) == text


LONG = " ".join(f"This is sentence {k} of a remark that goes on for quite a while." for k in range(40))
PARTS = ["<section class='comments'>{}</section>", "<div class='cookie-notice'>{}</div>",
         "<div id=sidebar>{}</div>", "<form>{}</form>"]


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("shape", ["<p>" + LONG, "<p>" + "<p>".join([LONG[:413]] * 3), "<p>" + "<p>".join([BODY] * 12)])
def test_long_doubtful_parts_are_no_text(part, shape):
    """Comments, notices, sidebars and forms of 1,000 to 2,500 characters stay out, in and beside."""
    doubtful, text = part.format(shape), f"{BODY}\n{BODY}\nThe end of it."
    body = f"<p>{BODY}</p><p>{BODY}</p>"
    for page in (
        f"<article>{body}<p>The end of it.</p></article>{doubtful}",
        f"<article>{body}{doubtful}<p>The end of it.</p></article>",
        f"<article>{body}<p>The end of it.</p>{doubtful}</article>",
        f"<main>{body}<p>The end of it.</p></main>{doubtful}",
    ):
        assert html_text.main_text(page) == text
    if not part.startswith("<form"):
        assert html_text.main_text(f"{doubtful}<div>{body}<p>The end of it.</p></div>") == text
        wrapped = f"<form><div>{body}<p>The end of it.</p></div>{doubtful}</form>"
        assert html_text.main_text(wrapped) == text


def test_lines_of_links_between_paragraphs_are_text():
    links = "See <a href=x>the longer report of last year about this very matter</a>."
    plain = "See the longer report of last year about this very matter."
    for page in ("{}", "<div>{}</div>", "<article>{}</article>"):
        page = page.format(f"<p>{BODY}</p><p>{links}</p><p>{BODY}</p>")
        assert html_text.main_text(f"<body><nav><a href=y>Home</a></nav>{page}") == f"{BODY}\n{plain}\n{BODY}"


def plain_line_blocks(lines):
    """Surge and dive over (text, linked characters) lines, by comparing every window anew."""
    weight = [len(t) if n < 0.5 * len(t) else 0 for t, n in lines]
    window = [sum(weight[i : i + 3]) for i in range(len(lines))]
    surge = min(80, max(window, default=0) / 2)
    kept = []
    for i in range(len(lines)):
        a = i
        while a > 0 and window[i] and window[a - 1]:
            a -= 1
        b = i
        while window[i] and b < len(lines) and window[b]:
            b += 1
        if window[i] and max(window[a:b]) >= surge:
            sure = [k for k in range(a, b) if weight[k]]
            if weight[i] or (sure[0] < i < sure[-1] and lines[i][0]):
                kept.append(lines[i][0])
    return "\n".join(kept)


def test_line_blocks_equal_a_plain_version():
    """Random pages of plain paragraphs, links and gaps directly in the body."""
    rng = random.Random(11)
    for _ in range(300):
        lines, page = [], "<body>"
        for k in range(rng.randint(0, 30)):
            text, kind = f"{k} " + "word " * rng.choice([1, 3, 12, 40]) + "x", rng.random()
            if kind < 0.5:
                lines.append((text, 0))
                page += f"<p>{text}</p>"
            elif kind < 0.8:
                lines.append((text, len(text)))
                page += f"<p><a href=x>{text}</a></p>"
            else:
                lines += [("", 0)] * 2
                page += "<nav><p>Menu of the site</p></nav>"
                lines.insert(-1, ("", 0))
        assert html_text.main_text(page) == plain_line_blocks(lines)


def test_page_text_edges(spark):
    pages = [(1, None), (2, ""), (3, "a < b"), (4, "<p>open <b>ended"), (5, "<script>x"), (6, "<!-- x"), (7, '<p class="')]
    found = html_text.extract_main_text(
        spark.createDataFrame(pages, "page_id long, html string").withColumn("text", F.lit(1))
    )
    assert [r["text"] for r in found.orderBy("page_id").collect()] == ["", "", "a < b", "open ended", "", "", ""]
    assert html_text.extract_main_text(found.limit(0)).count() == 0
    assert len(html_text.main_text("<p>" + "word " * 200_000)) == 999_999


def plain_targets(sizes, weights=(5, 2, 1)):
    """The excess of full sources is shared out again until none is above its bound."""
    names = sorted(sizes, key=lambda n: (n is None, (n or "").encode()))
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    left, full, target = 1.5 * sum(sizes.values()), {}, {}
    while True:
        free = [n for n in names if n not in full]
        rest = left - sum(full.values())
        target = full | {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        above = [n for n in free if target[n] > 2 * sizes[n]]
        if not above:
            return target
        full |= {n: 2.0 * sizes[n] for n in above}


def test_mixing(spark, sample):
    docs = docs_of(spark, sample).withColumn("size", F.lit("clash"))
    mixed = mixing.mix_to_weights(docs).toPandas()
    assert len(mixed) == len(sample)
    sizes = {}
    for _, text, _, source, _ in sample:
        sizes[source] = sizes.get(source, 0) + len(SQL_WORD.findall(text or ""))
    target = plain_targets(sizes)
    for source, own in mixed.groupby("source", dropna=False):
        source = source if isinstance(source, str) else None
        assert own["target"].to_numpy() == pytest.approx(target[source])
        # What is left unsettled is one document, or one set of equal rows.
        assert abs(own["taken"].sum() - target[source]) <= own["size"].max() * 3
    assert (mixed["taken"] <= 2 * mixed["size"]).all()
    assert (mixed["taken"] == mixed["size"] * mixed["copies"]).all()
    again = mixing.mix_to_weights(docs.repartition(5)).toPandas()
    order = ["source", "doc_id", "size", "copies"]
    assert mixed[order].sort_values(order).to_numpy().astype(str).tolist() == again[order].sort_values(order).to_numpy().astype(str).tolist()
    assert mixing.mix_to_weights(docs.limit(0)).count() == 0


def test_mixing_climbs_the_tree(spark):
    """More documents than one level of groups settles; copy numbers keep their expectation."""
    rows = [(i, "w " * (1 + i % 7), None, "a" if i % 3 else "b", 0) for i in range(6000)]
    mixed = mixing.mix_to_weights(docs_of(spark, rows)).toPandas()
    for _, own in mixed.groupby("source"):
        assert abs(own["taken"].sum() - own["target"].iloc[0]) <= 7
        share = own["target"].iloc[0] / own["source_size"].iloc[0]
        for _, alike in own.groupby("size"):
            assert abs(alike["copies"].mean() - share) < 0.1


def test_mixed_stage_keeps_columns(spark, sample):
    docs = docs_of(spark, sample)
    out = stages.mixed(spark, docs, "")
    assert out.columns == docs.columns
    taken = mixing.mix_to_weights(docs).agg(F.sum("copies")).first()[0]
    assert out.count() == taken


def plain_places(words, phrase):
    phrase = phrase.split()
    return [k for k in range(len(words)) if words[k : k + len(phrase)] == phrase]


LICENSED = [
    "Licensed under the Apache License, Version 2.0. All rights\nreserved",
    "cc by cc-by CC BY-NC 4.0",
    "This work is licensed under the GNU General Public License, version 3.",
    "SPDX-License-Identifier: MIT",
    "see https://creativecommons.org/licenses/by-sa/4.0/",
    "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "allrights reserved é all rights reservedx",
    "cc by " * 400,
    "",
    None,
]


def test_licenses(spark, tmp_path):
    rows = [(i, t, None, None, 0) for i, t in enumerate(LICENSED)] + [(0, LICENSED[0], None, None, 0)]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = op8_license_scan(spark, str(tmp_path)).toPandas()
    assert len(found) == len(rows)
    for row in found.itertuples():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(LICENSED[row.doc_id]))
        base = {
            "cc-by": plain_places(words, "cc by"),
            "gpl": plain_places(words, "general public license"),
            "reserved": plain_places(words, "all rights reserved"),
        }
        places = [p for own in base.values() for p in own]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        if places:
            assert (row.first_word, row.last_word) == (min(places), max(places))
        assert row.base_labels == ",".join(sorted(k for k, v in base.items() if v))
        assert 0 <= row.score <= 1
    labels = found.drop_duplicates("doc_id").set_index("doc_id").labels
    assert labels[0] == "apache-2.0,reserved"
    assert labels[1] == "cc-by,cc-by-nc"  # the shorter name within the longer is suppressed
    assert labels[2] == "gpl,gpl-3.0"
    assert [labels[3], labels[4], labels[5]] == ["mit", "cc-by-sa", "mit"]


def test_license_rules_name_their_literals():
    table = license_rules.rules()
    assert len(table) > 200
    for rule in table:
        needed = re.sub(r"\(\?:(?:[^()]|\([^()]*\))*\)\?", "", rule.pattern).replace("licen[sc]e", "license")
        assert any(g in needed for g in license_rules.GATES), rule
        assert rule.keyword in needed.replace("(?:", "") or rule.keyword in rule.pattern, rule


def test_priority_and_containment(spark):
    rule = license_rules.Rule
    table = [rule("a", "long", "x", "x y z", 10), rule("b", "inner", "y", "y", 5), rule("c", "strong", "z", "z", 20), rule("d", "same", "x", "x y z", 10)]
    docs = spark.createDataFrame([("x y z licen",)], "text string").withColumn("n_words", F.lit(1))
    row = scan_licenses(docs, table).first()
    assert [d["label"] for d in row["license_spans"]] == ["long", "strong"]


def test_containment_equals_comparing_all_pairs(spark):
    """Rules over few words, many of them within each other; columns that clash with helpers."""
    rule = license_rules.Rule
    rng = random.Random(5)
    phrases = sorted({" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(25)})
    table = [rule(str(i), f"l{i}", p.split()[0], p, rng.choice([10, 20, 30])) for i, p in enumerate(phrases)]
    texts = ["licen " + " ".join(rng.choice("abc") for _ in range(n)) for n in (0, 1, 2, 3, 9, 40, 200)]
    docs = spark.createDataFrame([(t, i, "x", 0.5) for i, t in enumerate(texts)], "text string, _normal int, _base string, _ALL double")
    found = {r._normal: r for r in scan_licenses(docs, table).collect()}
    for i, text in enumerate(texts):
        every = []
        for number, r in enumerate(table):
            for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", f" {text} "):
                start = f" {text} "[: m.start()].count(" ") - 1
                every.append((start, start + len(m.group().split()), r.label, r.priority, number))

        def beats(e, d):
            contains = e[0] <= d[0] and e[1] >= d[1]
            return contains and (e[3], e[1] - e[0], -e[4]) > (d[3], d[1] - d[0], -d[4])

        left = sorted(d for d in every if not any(beats(e, d) for e in every))
        assert [tuple(d) for d in found[i].license_spans] == left
        assert (found[i]._base, found[i]["_ALL"]) == ("x", 0.5)


def test_many_detections_in_one_text(spark):
    rule = license_rules.Rule
    table = [rule("a", "outer", "x", "x y z", 10), rule("b", "inner", "y", "y", 5), rule("c", "other", "z", "z", 20)]
    docs = spark.createDataFrame([("licen " + "x y z " * 40_000,)], "text string")
    began = time.time()
    spans = scan_licenses(docs, table).selectExpr("size(license_spans) AS n").first()
    assert spans.n == 80_000 and time.time() - began < 60


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choices("a1.@ -+5(0)é\n", k=rng.randint(0, 30)))
        assert pii.base_spans(text) == plain_spans(text)
    assert pii.base_spans("1" * 300_000 + "." + "a@" * 50_000) == []


def test_features_see_whole_words_and_lines():
    far = "tel" + " " * 100 + "+49 30"
    assert next(iter(pii._lines(far)))[0] == "tel"
    assert next(iter(pii._lines("x" * 100 + " 12-34")))[0] == "x" * 100
    assert next(iter(pii._lines("tel\n 12-34")))[0] == ""
    assert pii._shape("1-" * 200 + "22") == "<1>-" * 200 + "<2>"


def test_field_learns_and_decodes_exactly():
    field = pii.default_field()
    wrong = 0
    for line in pii.EXAMPLES.strip().splitlines():
        text, spans = pii._example(line)
        found = [(a, b, pii.KINDS[k]) for a, k, b, _ in pii.find_spans([text], field)[0]]
        wrong += found != spans
    assert wrong <= 6
    # All runs at once give what each run gives by trying all label sequences.
    words = [("555-0134", "cue-phone", "cue-word"), ("12", "edge", "<2>"), ("34", "<2>", "<2>"), ("+1", "cue-word", "(<3>)")]
    lengths = np.array([1, 2, 1])
    score = field.scores(words)
    labels = field.labels(words, lengths)
    at = 0
    for n in lengths:
        best = max(
            np.ndindex(*[len(pii.LABELS)] * n),
            key=lambda y: sum(score[at + i, k] for i, k in enumerate(y))
            + sum(field.transition[a, b] for a, b in zip((0, *y), (*y, 0), strict=True)),
        )
        assert tuple(labels[at : at + n]) == best
        at += n


def test_personal_data(spark, tmp_path):
    texts = [
        "Ann: ann@example.com, call (312) 555-7788 or +1 (743) 555-3824.",
        "host 10.0.0.1 and 10.0.0.256 and card 4111 1111 1111 1111 not 4111 1111 1111 1112",
        "in 2024 version 1.2.3 cost 12.50 é",
        "",
        None,
    ]
    rows = [(i, t, None, None, len(t or "")) for i, t in enumerate(texts)] + [(0, texts[0], None, None, 1)]
    docs = docs_of(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = op10_personal_data(spark, str(tmp_path)).toPandas().drop_duplicates("doc_id").set_index("doc_id")
    assert found.spans[0] == "email:5:20,phone:27:41,phone:45:62"
    assert found.loc[1, ["n_email", "n_ip", "n_card", "n_phone"]].tolist() == [0, 1, 1, 0]
    assert found.spans[2] == found.spans[3] == found.spans[4] == ""
    masked = stages.masked(spark, docs, "").where("doc_id = 0").first()
    assert masked["text"] == "Ann: [EMAIL], call [PHONE] or [PHONE]."
    assert masked["n_chars"] == len(masked["text"])
    assert pii.find_personal_data(docs.limit(0)).count() == 0


def test_packing(spark, sample):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rows = sample + [(300 + i, t, None, None, 0) for i, t in enumerate(["don't, you're", "Ünïcode—“q”, x2y ÷ <|endoftext|>", "Áb\tc\x1cd e", "ΣΑΣ,", "»a,« b."])]
    packed = packing.pack_documents(docs_of(spark, rows), keep_ids=True).toPandas()
    wanted = Counter()
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096].tobytes()
            wanted[doc_id, piece, at, len(part) // 4, zlib.crc32(part), part] += 1
    got = Counter(
        (None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids))
        for r in packed.itertuples()
    )
    assert got == wanted
    for _, own in packed.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *np.cumsum(own["length"])[:-1]]
        assert own["length"].sum() <= 4096
    assert packing.pack_documents(docs_of(spark, rows).limit(0)).count() == 0


def test_plain_parts_are_tokenized_alike():
    from tokenizers import Tokenizer
    import public_tokenizers

    path = public_tokenizers.path(packing.TOKENIZER)
    tokenizer, words = Tokenizer.from_file(path), packing._Words(path)
    rng = random.Random(8)
    signs = [*packing._PUNCTUATION, "'s", "'ll", "<|", "|>", "endoftext"]
    for _ in range(20_000):
        word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABÀÉÖßéñüÿ", k=rng.randint(0, 14)))
        word += "".join(rng.choices(signs, k=rng.randint(0, 4))) + rng.choice(["", "", "", "x", "7", "é"])
        ids, bounds = words.encode(pa.array([word], pa.large_string()))
        assert ids.tolist() == tokenizer.encode(word, add_special_tokens=False).ids, word


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for capacity in (16, 64, 4096):
        for _ in range(40):
            lengths = rng.sample(range(1, capacity + 1), rng.randint(1, min(capacity, 30)))
            runs = {n: rng.randint(1, 40) for n in lengths}
            sequences = {}
            for length, a, b, first, each, start in packing.plan(runs, capacity):
                for r in range(a, b):
                    place = first + (r - a) // each, start + (r - a) % each * length
                    sequences.setdefault(place[0], []).append((place[1], length))
            for pieces in sequences.values():
                at = 0
                for offset, length in sorted(pieces):
                    assert offset == at
                    at += length
                assert at <= capacity
            gaps, opened = [], 0
            for length in sorted((n for n, c in runs.items() for _ in range(c)), reverse=True):
                fit = min((g for g in gaps if g >= length), default=None)
                if fit is None:
                    fit, opened = capacity, opened + 1
                else:
                    gaps.remove(fit)
                gaps.append(fit - length)
            assert len(sequences) == opened
