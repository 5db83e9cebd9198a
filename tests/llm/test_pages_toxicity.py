"""HTML extraction and toxicity: hand-made cases, odd rows, held-out accuracy; and the pipeline's stages."""

import zlib

import pytest

import corpus_pipeline
from riskloom.llm import html_text, toxicity, words
from riskloom.session import at_rest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<html><body></body></html>", ""), ("<p>a<br>b\n\t c&nbsp;d<p>e", "a b c d\n\ne"),
    ("<nav><a href=x>m</a></nav><article><h1>T</h1><p>One <b>bold</b>word.<p>Two<br></article><footer>f</footer>", "T\n\nOne boldword.\n\nTwo"),
    ("<body class='has-sidebar'><div class='sidebar'>s</div><div class=content><h2>H</h2><p>long text here</p><p>and more</p></div></body>", "H\n\nlong text here\n\nand more"),
    ("<article><p>x</p><script>var t='</p>';</script><style>p{}</style><!-- c --><form>f</form><aside>n</aside></article>", "x"),
    ("<main><p>text</p><div id='comments'><p>first!</p></div><div class='ad'>buy</div><div hidden>h</div></main>", "text"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>", "one\n\ntwo\n\nc1\n\nc2"),
    ('<article title="a > b"><p data-x=\'1 > 0\'>ok &lt;i&gt; &#233;</p></article>', "ok <i> é"),
    ("<article><p>open <i>never closed", "open never closed"), ("<!doctype html><title>t</title><p>b", "b"),
])
def test_extract(page, text):
    assert html_text.extract(page) == text


def test_density_without_article_tags():
    links = "".join(f"<li><a href=/{i}>link number {i}</a></li>" for i in range(30))
    body = "".join(f"<p>{'many plain words of the story ' * 12}{i}</p>" for i in range(6))
    page = f"<body><div><ul>{links}</ul></div><div><div><h2>Head</h2>{body}</div></div><div><p>tiny</p><a href=x>more</a></div></body>"
    text = html_text.extract(page)
    assert text.startswith("Head\n\nmany plain") and "link number" not in text and text.count("\n\n") == 6 and "tiny" not in text


STORY = "".join(f"<p>{'many plain words of the story ' * 12}{i}</p>" for i in range(4))


def test_links_inside_the_article_stay():
    links = "<a href=a>Name of one</a>, <a href=b>name of two</a>"
    page = f"<article>{STORY}<p>See {links}</p><ul><li>{links}</ul><table><tr><td>{links}</table><ul class=menu><li>{links}</ul></article>"
    assert html_text.extract(page).split("\n\n")[4:] == ["See Name of one, name of two"] + ["Name of one, name of two"] * 2


def test_text_beside_and_in_other_articles():
    assert html_text.extract(f"<body><main><h1>Title</h1><article>{STORY}</article><p>Beside</p></main></body>").split("\n\n")[::5] == ["Title", "Beside"]
    two = f"<body><div><article>{STORY}</article></div><div><article><p>Second</p></article></div><div><article class=related><p>Other</p></article></div></body>"
    assert html_text.extract(two).split("\n\n")[4:] == ["Second"]
    beside = f"<body><article>{STORY}</article><div>{STORY.replace('story', 'sequel')}</div></body>"
    assert "sequel" in html_text.extract(beside)


@pytest.mark.parametrize("part", [
    '<h2 id="search-algorithms">Here</h2>', '<section class="related-work"><p>Here</p></section>', '<p class="ad-hoc">Here</p>', '<p class="short-form">Here</p>',
    '<div class="entry-header"><h1>Here</h1></div>', "<p><math><mi>Here</mi></math></p>", "<p><label>Here</label></p>", '<h1 class="header">Here</h1>', '<p id="notice">Here</p>',
])
def test_names_drop_no_text_of_the_article(part):
    assert html_text.extract(f"<article>{STORY}{part}{STORY}</article>").split("\n\n")[4] == "Here"


@pytest.mark.parametrize("part", [
    '<div class="share-buttons">Here</div>', '<div class="comment-list"><p>Here</p></div>', '<div id="newsletter-signup">Here</div>', '<div class="ad-slot-2">Here</div>',
    '<div class="x related-posts">Here</div>', "<label for=x>Here</label>", "<p><label><input type=checkbox> Here</label></p>", '<div class="site-header">Here</div>',
    '<p class="notice">Here</p>', '<ul class="breadcrumb"><li>Here</ul>', "<math><annotation>Here</annotation></math>",
])
def test_names_of_boilerplate_inside_the_article(part):
    assert "Here" not in html_text.extract(f"<article>{STORY}{part}{STORY}</article>")


def test_generated_articles_come_back_whole():
    import html
    import random

    rng = random.Random(3)
    words_ = "alpha beta gamma delta R&D a<b café 数学 it's \"so\" 7%".split()
    for _ in range(60):
        blocks = [" ".join(rng.choices(words_, k=rng.randint(25, 60))) for _ in range(rng.randint(3, 9))]
        marked = [f"<{t}>\n {html.escape(b).replace(' ', rng.choice([' ', chr(10), '  ']), 3)}</{t}>" for b in blocks for t in [rng.choice(["p", "h2", "blockquote", "li", "pre"])]]
        menu = "".join(f"<li><a href=/{i}>menu {i}</a>" for i in range(rng.randint(3, 30)))
        side = f"<div class='{rng.choice(['sidebar', 'ads', 'cookie-banner', 'related-posts'])}'><p>aside text</p></div>"
        page = f"<html><head><title>t</title></head><body><nav><ul>{menu}</ul></nav>{side}<article>{''.join(marked)}</article><footer>end</footer></body></html>"
        assert html_text.extract(page) == "\n\n".join(blocks)


def test_very_long_page():
    blocks = [f"paragraph {i} with some words in it" for i in range(60_000)]
    assert html_text.extract("<article><p>" + "<p>".join(blocks) + "</article>") == "\n\n".join(blocks)


def test_deep_and_broken_markup():
    assert html_text.extract("<div>" * 5000 + "x" + "</b>" * 10 + "<") == "x <" or html_text.extract("<div>" * 5000 + "x").strip() == "x"
    assert html_text.extract("<p title='" * 2000) == ""
    assert html_text.extract("<" * 3000 + " a").endswith("a")


def test_main_text(spark):
    rows = [(1, "u", "<p>a</p>", 1), (1, "u", "<p>a</p>", 1), (None, None, None, 2)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")).collect()
    assert sorted(map(tuple, got), key=str) == [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)]
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert html_text.main_text(pages).count() == pages.count() and html_text.main_text(pages.limit(0)).count() == 0


# Toxicity


def scores(text, learned=()):
    import pyarrow as pa

    (piece,) = words.pieces(pa.array([text]), words.ALNUM, lower=True)
    total, _, matched = toxicity.clause_scores(piece, toxicity.lexicon(list(learned)))
    return round(float(total[0]), 6), int(matched[0])


def test_grammar():
    w = toxicity.LIST_WEIGHT
    assert scores("a plain text") == (0, 0)
    assert scores("this idiot") == (w, 1)
    assert scores("you idiot. Fine") == (w * toxicity.TARGETED, 1)
    assert scores("not an idiot") == (w * toxicity.NEGATED, 1)
    assert scores("not a very big idiot") == (w, 1)  # out of the negation's reach
    assert scores("he said: idiot") == (w, 1)  # another clause
    assert scores("they said you idiot") == (w * toxicity.REPORTED * toxicity.TARGETED, 1)
    assert scores("idiot moron! Stupid") == (3 * w, 2)
    stem = int(words.word_hashes([b"lowe"])[0])
    assert scores("und loweihr lowe", [(4, stem, 5.0)]) == (5.0, 1)


def test_threats_need_intent_violence_and_target():
    assert scores("kill the process") == scores("they will kill the process") == scores("you kill") == (0, 0)
    assert scores("I will kill you") == scores("ich werde dich kill") == (toxicity.THREAT_WEIGHT, 1)
    assert scores("I will not kill you") == (toxicity.THREAT_WEIGHT * toxicity.NEGATED, 1)
    assert scores("he said I will kill you") == (toxicity.THREAT_WEIGHT * toxicity.REPORTED, 1)


def test_length_alone_makes_no_text_toxic():
    import pyarrow as pa

    text = "Put it into the trash. A fine day. All is well. "
    (piece,) = words.pieces(pa.array([text, text * 2000]), words.ALNUM, lower=True)
    most, rate, _ = toxicity.evidence(piece, toxicity.lexicon([]))
    assert most[0] == most[1] and abs(rate[0] - rate[1]) < 1e-9


def test_composition_is_the_product():
    assert len(toxicity.GRAMMAR) % 5 == 0 and all((state, symbol) in toxicity.GRAMMAR for state, _, _ in toxicity.GRAMMAR.values() for symbol in range(5))


def test_learned_words_and_held_out_accuracy(spark):
    docs = [(i, ("fine words here " * 3 + ("grumpf snarx1 " if i % 4 == 0 else "nice ")) * 2) for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 600, 2)] + [(None, 1, 1), (4, 1, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.report(frame, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(r["predicted"] == int(r["doc_id"] % 4 == 0) and 0 <= r["score"] <= 1 for r in rows)


def test_words_of_few_toxic_texts_are_learned(spark):
    rows = [(f"plain words {'grumpf' if i < 400 else 'snarx' if i < 406 else ''}", int(i < 406)) for i in range(2000)]
    terms = toxicity.learn_terms(spark.createDataFrame(rows, "text string, toxic long"), 406, 1594)
    common, rare, plain = (int(h) for h in words.word_hashes([b"grumpf", b"snarx", b"plain"]))
    weights = {h: w for size, h, w in terms if size == 0}
    assert weights[common] > weights[rare] > 0 and plain not in weights


def test_held_out_labels_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    one, two = (sorted(map(tuple, toxicity.report(docs, x).collect())) for x in (labels, other))
    assert one == two


def test_toxicity_odd(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.report(odd_docs, none).collect()
    assert len(rows) == odd_docs.count() and not any(r["predicted"] for r in rows)
    assert toxicity.clean(odd_docs, none).columns == odd_docs.columns
    assert toxicity.report(no_docs, none).count() == 0


# Pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("count", toxicity.F.lit(1))
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = at_rest(stage(spark, docs, SF), name)
        assert docs.count() <= left
        left = docs.count()
        assert docs.columns == columns or name == "source_mixing"
    assert docs.columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_pipeline_on_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = at_rest(stage(spark, docs, SF), name)
        assert docs.count() <= odd_docs.count()
