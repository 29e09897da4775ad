from __future__ import annotations

import zlib

import numpy as np
import pytest
from conftest import odd_rows

from orebed.llm import block_lstm, boosted_quality, html_lstm, hyper_lang
from orebed.llm.common import ready, table

SF = "/root/testdata/sf0.01"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy this now.</div>
<article><h1>A  title &amp; more</h1><p>First paragraph of&nbsp;the story, with <i>markup</i> inside it.<p><b>Second paragraph, caf&eacute;, not
closed.<br></article><div class="comments"><div class="comment"><p>I do not agree at all with this.</p></div></div>
<form><label>Email</label><input name="e"><button>Send</button></form><footer>&copy; example &middot; All rights reserved.</footer></body></html>"""


def test_blocks_follow_the_markup():
    found = html_lstm.blocks(PAGE)
    assert [b.text for b in found] == [
        "Home",
        "About",
        "Buy this now.",
        "A title & more",
        "First paragraph of the story, with markup inside it.",
        "Second paragraph, café, not closed.",
        "I do not agree at all with this.",
        "Email",
        "© example · All rights reserved.",
    ]
    assert [e[0] for e in found[4].path] == ["html", "body", "article", "p"]
    assert html_lstm.blocks(None) == html_lstm.blocks("") == []
    assert [b.text for b in html_lstm.blocks('a <b <p x="unclosed> c')]


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    x, mask = rng.normal(size=(5, 3, 6)).astype(np.float32), np.ones((5, 3), np.float32)
    mask[3:, 1] = 0
    y = (rng.random((5, 3)) > 0.5).astype(np.float32)
    model = block_lstm.new_model(6)

    def loss():
        p = 1 / (1 + np.exp(-block_lstm.logits(model, x, mask).astype(np.float64)))
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    grads = block_lstm._gradients(model, x, mask, y)
    for name, weights in model.items():
        at = tuple(rng.integers(0, n) for n in weights.shape)
        value = weights[at]
        weights[at] = value + 0.01
        up = loss()
        weights[at] = value - 0.01
        down = loss()
        weights[at] = value
        assert abs((up - down) / 0.02 - grads[name][at]) < 2e-4


@pytest.fixture(scope="module")
def labeller(spark):
    return html_lstm.train(html_lstm.sample(table(spark, SF, "pages")))


def test_labels_on_unseen_page_forms(labeller):
    rng = np.random.default_rng(1234)
    words = [w for _, t, _ in odd_rows() for w in (t or "")[:400].split()] + "some words of an unseen language mira tolu benda".split()
    pages = [html_lstm.blocks(html_lstm.compose(rng, words)) for _ in range(200)]
    truth = np.concatenate([[b.target for b in p] for p in pages])
    found = np.concatenate(html_lstm.label(labeller, pages))
    assert (truth == found).mean() > 0.97


def test_main_text(spark, labeller):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", ""), (3, "w", PAGE.replace("First", "First " + "long text. " * 20000))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "'y' AS n_chars")
    found = df.select("page_id", "url", "html").mapInArrow(
        html_lstm._extract(labeller), "page_id long, url string, text string, n_chars long"
    ).collect()
    main = "A title & more\nFirst paragraph of the story, with markup inside it.\nSecond paragraph, café, not closed."
    assert [r["text"] for r in found[:2]] == [main, main] and found[0]["n_chars"] == len(main)
    assert [r["text"] for r in found[2:4]] == ["", ""] and len(found[4]["text"]) > 200000
    assert html_lstm.main_text(df.where("false")).count() == 0


def test_articles_of_the_table(spark, labeller):
    pages = table(spark, SF, "pages").collect()
    parsed = [html_lstm.blocks(p["html"]) for p in pages]
    wrong = sum((html_lstm.named_article(b) > 0).tolist() != k.tolist() for b, k in zip(parsed, html_lstm.label(labeller, parsed), strict=True) if b)
    assert wrong <= len(pages) // 100


def test_profiles_are_normalised_bundles():
    x = hyper_lang.profiles(["some text", None, "", "123 !!", "some text " * 5000])
    assert np.allclose(np.linalg.norm(x, axis=1), [1, 0, 0, 0, 1], atol=1e-5)
    codes = hyper_lang.gram_codes("Abc")
    assert np.array_equal(hyper_lang.gram_vectors(codes)[1], np.prod([np.roll(hyper_lang._letters()[s], k) for k, s in enumerate((3, 2, 1))], axis=0))


def test_languages_of_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = hyper_lang.identify(docs).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_rows(odd, empty):
    rows = hyper_lang.identify(odd).collect()
    assert len(rows) == len(odd_rows()) and {r["lang_pred"] for r in rows} <= {"en", "de", "und"}
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 9)} == {"und"}
    assert hyper_lang.identify(empty).count() == 0
    assert {r["lang_pred"] for r in hyper_lang.identify(odd.withColumn("lang", odd["lang"].substr(0, 0)).replace("", None, "lang")).collect()} == {"und"}


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(2)
    x = rng.random((3000, len(boosted_quality.STATISTICS)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = boosted_quality.train(x[:2000], y[:2000])
    assert ((boosted_quality.predict(model, x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    base, feature, threshold, value = model
    for row, score in zip(x[:50], boosted_quality.predict(model, x[:50]), strict=True):
        total = base
        for t in range(len(feature)):
            node = 0
            for _ in range(boosted_quality.DEPTH):
                node = 2 * node + 1 + int(row[feature[t, node]] > threshold[t, node])
            total += value[t, node - (2**boosted_quality.DEPTH - 1)]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-9


def test_quality_of_held_out_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = boosted_quality.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(5, 1), (5, 0), (3, None), (None, 1), (14, 0)], "doc_id long, quality int")
    rows = boosted_quality.classify(odd, labels).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    none = boosted_quality.classify(odd, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert boosted_quality.classify(empty, labels).count() == 0
    assert boosted_quality.accepted(odd, labels.where("false")).columns == odd.columns


def test_ready_is_repeatable(spark):
    ready(spark)
    ready(spark)
