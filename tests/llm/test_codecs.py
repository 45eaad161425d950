"""Token counts, pieces, pages and personal data against libraries, brute force and held-out pages."""

import re
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from targetlens.llm import pii
from targetlens.llm.html_blocks import leaf_blocks, template_pages
from targetlens.llm.html_extraction import Field, _gradient, block_features, extract_main_text, fit, fit_on_table, label_blocks, main_text
from targetlens.llm.piece_codec import PieceCodec, decode_pieces, encode_pieces, piece_report
from targetlens.llm.token_counts import MergeCounter, count_tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", "  ", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "don't I'LL it's 've", "İstanbul ΣΑΣ ΟΔΟΣ ς ǅ ẞ",
    "😀👍🏽 é é ẛ̣", "x" * 3000, "12345 ½ ²   ", "\x00\x01\x85 a\x1cb\x1fc d", "日本語 العربية हिन्दी",
    "ſ'ſ 'S 'T don’t", "﻿ a", "_a_b__ $$ 'reali 'vex", " a  b   \n\n c\n", "▁a▁▁b", "<0x41><s></s>", "ﷺ𒐫 𒐫",
]


@pytest.fixture(scope="module")
def counter():
    return MergeCounter(WORDS)


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(PIECES)


def test_counts_equal_the_library(counter, texts):
    library = Tokenizer.from_file(WORDS)
    rows = [*ODD, *texts.values()]
    expected = [len(e.ids) for e in library.encode_batch(rows, add_special_tokens=False)]
    assert [counter.count(t) for t in rows] == expected


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_counts_of_any_text(text):
    library = test_counts_of_any_text.__dict__.setdefault("library", Tokenizer.from_file(WORDS))
    mine = test_counts_of_any_text.__dict__.setdefault("mine", MergeCounter(WORDS))
    assert mine.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_count_table(messy, nothing, counter):
    rows = count_tokens(messy, WORDS).collect()
    expected = Counter((r["doc_id"], len((r["text"] or "").encode()), counter.count(r["text"])) for r in messy.collect())
    assert Counter((r["_id"], r["n_bytes"], r["n_tokens"]) for r in rows) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in rows)
    assert count_tokens(nothing, WORDS).count() == 0


def best_score(text, scores, unknown):
    text = "▁" + text.replace(" ", "▁")
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 16), end):
            score = scores.get(text[start:end], unknown if end - start == 1 else None)
            if score is not None:
                best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_pieces_are_the_best_path_and_come_back(codec, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
    unknown = min(scores.values()) - 10
    for text in [t for t in [*ODD, *texts.values()] if len(t) < 700]:
        ids = codec.encode(text)
        assert codec.decode(ids) == text.replace("▁", " ")
        known = sum(scores[codec.pieces[i]] for i in ids if i not in codec.of_byte)
        spelled = bytes(codec.of_byte[i] for i in ids if i in codec.of_byte).decode()
        if text:
            assert known + unknown * len(spelled) == pytest.approx(best_score(text, scores, unknown))


def test_piece_tables(messy, nothing, codec):
    encoded = encode_pieces(messy, PIECES)
    rows = decode_pieces(encoded, PIECES).collect()
    assert encoded.columns == [*messy.columns, "piece_ids"]
    assert Counter((r["doc_id"], tuple(r["piece_ids"])) for r in rows) == Counter((r["doc_id"], tuple(codec.encode(r["text"]))) for r in messy.collect())
    assert all(r["decoded"] == (r["text"] or "") for r in rows)
    assert all(r["round_trip"] for r in piece_report(messy, PIECES).collect())
    assert piece_report(nothing, PIECES).count() == 0


@pytest.fixture(scope="module")
def model():
    return fit(template_pages(300))


def test_held_out_pages(model):
    wrong = total = 0
    for page, main in template_pages(150, seed=99):
        blocks = leaf_blocks(page)
        gold = label_blocks(blocks, main)
        assert sum(gold) == len(main)
        wrong += sum(a != b for a, b in zip(gold, model.decode(blocks)))
        total += len(blocks)
    assert wrong <= 0.01 * total


def test_viterbi_finds_the_best_labels(model):
    rng = np.random.default_rng(3)
    field = Field({k: float(rng.normal()) for k in model.weights}, rng.normal(size=2), rng.normal(size=(2, 2)))
    for page, _ in template_pages(20, seed=5):
        blocks = leaf_blocks(page)[:9]
        unary = [sum(field.weights.get(f, 0) for f in block_features(b, i)) for i, b in enumerate(blocks)]

        def score(labels):
            return field.start[labels[0]] + sum(u * y for u, y in zip(unary, labels)) + sum(
                field.steps[a, b] for a, b in zip(labels, labels[1:]))

        best = max(product((0, 1), repeat=len(blocks)), key=score)
        assert score(field.decode(blocks)) == pytest.approx(score(best))


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    gold, mask = np.array([[0, 1, 1], [1, 0, 0]]), np.array([[1, 1, 1], [1, 1, 0]], dtype=bool)
    place_of, x = np.array([0, 1, 2, 3, 4]), rng.normal(size=(5, 4))

    def value(theta):
        unary = np.zeros(6)
        unary[place_of] = x @ theta[:4]
        start, steps, total = theta[4:6], theta[6:].reshape(2, 2), 0.0
        for page, size in ((0, 3), (1, 2)):
            def score(y):
                return start[y[0]] + sum(unary[3 * page + t] * y[t] for t in range(size)) + sum(steps[y[t], y[t + 1]] for t in range(size - 1))

            total += score(gold[page]) - np.log(sum(np.exp(score(y)) for y in product((0, 1), repeat=size)))
        return total / 2 - 0.5e-3 * (theta ** 2).sum()

    theta = rng.normal(size=10)
    steps = 1e-6 * np.eye(10)
    numeric = [(value(theta + s) - value(theta - s)) / 2e-6 for s in steps]
    assert _gradient(theta, x, place_of, gold, mask) == pytest.approx(numeric, abs=1e-5)


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-banner"><p>We use cookies on this site.</p></div><!-- x -->
<article><h1>A  title &amp; more</h1><p><b>First &lt;one&gt; &copy; <i>here</i>.<br><p>Second
 line.</p><div class="ad">Buy this now, dear reader.</div><p>Third <a href="/q">link</a> text.</article>
<div id="comments"><div class="comment"><p>I disagree with all of this.</p></div></div>
<form><p>Your mail please.</p><button>Send</button></form><footer>&copy; site. All rights.</footer>"""


def test_extraction(spark, model, nothing):
    wanted = "A title & more\n\nFirst <one> © here.\n\nSecond line.\n\nThird link text."
    assert main_text(PAGE, model) == wanted
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "u", ""), (3, "u", "< a <b <!-- <p"), (4, "u", "<p>" + "word " * 20000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = extract_main_text(pages, model).collect()
    assert [r["text"] for r in got if r["page_id"] == 1] == [wanted] * 2
    assert [r["text"] for r in got if r["page_id"] in (None, 2)] == ["", ""] and len(got) == 6
    assert extract_main_text(pages.where("false"), model).count() == 0
    labelled = spark.createDataFrame(template_pages(40, seed=4), "html string, main array<string>")
    assert fit_on_table(labelled).weights


def test_pages_of_the_table(spark, model):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract_main_text(pages, model).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(p for p in parts if p)


def base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1@.+- ()0295_%é:", max_size=60))
def test_base_spans_of_any_text(text):
    assert pii.base_spans(text) == base(text)


def test_base_spans_of_documents(texts):
    for text in [*texts.values(), "a.b@c.d.e@f.g", "1.2.3.4.5.6.7.8", "4" * 40, "+1 +1 +12345678", "@" * 50, "a@b@c.de"]:
        assert pii.base_spans(text) == base(text)


def test_reliabilities_are_found():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    right = [0.95, 0.8, 0.7, 0.6, 0.9]
    seen = [tuple(int(2 * (t == (rng.random() < p)) - 1) if True else 0 for p in right) for t in truth]
    prior, table = pii.estimate_reliabilities(sorted(Counter(seen).items()))
    assert prior[1] == pytest.approx(0.4, abs=0.05)
    assert [table[j, 1, 2] for j in range(5)] == pytest.approx(right, abs=0.06)


def test_method_adds_spans_and_leaves_numbers_alone(spark, messy, nothing):
    rows = [(i, f"please call phone 0{i % 9 + 1}1 555-{1000 + i} or tel +1 212 555 {1000 + i} today") for i in range(40)]
    rows += [(100 + i, f"see order version {i}1 222-{2000 + i}-x77") for i in range(40)]
    rows += [(200, "write to jane at example dot com for my mail"), (201, "nothing here"), (202, None)]
    got = {r["doc_id"]: r for r in pii.personal_data_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i]["n_phone"] == 1 and got[i]["spans"].count("phone") == 2 for i in range(40))
    assert all(got[i]["spans"] == "" for i in [*range(100, 140), 201, 202])
    report = pii.personal_data_report(messy).collect()
    assert len(report) == messy.count() and all(r["spans"] == "" for r in report)
    assert pii.personal_data_report(nothing).count() == 0
