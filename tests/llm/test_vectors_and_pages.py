"""Vectors, components, pages and the pipeline, against brute force."""

import random

import numpy as np
import pytest

from tallyhouse.llm import components, html_text, vectors


def _joined(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(rng.randrange(50, 150), rng.randrange(50, 150)) for _ in range(70)] + [(200, k) for k in range(160, 200)] + [(7, 7)]
    rng.shuffle(links)
    found = {r.node: r.root for r in components.roots(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = _joined(201, links)
    assert found == {i: wanted[i] for link in links for i in link}
    assert components.roots(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("slab", [vectors.SLAB, 40])
def test_vectors(spark, slab):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((6, 24))
    made = [rng.standard_normal(24) for _ in range(60)]
    made += [centres[i % 6] + rng.standard_normal(24) * rng.choice([0.02, 0.15, 0.25]) for i in range(120)]
    made += [made[70] * 3, made[70], made[71] * 1e-30]
    rows = [(i, [float(np.float32(v)) for v in x]) for i, x in enumerate(made)]
    x = np.array([r[1] for r in rows])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    wanted = dict(enumerate(zip(close.sum(1).tolist(), _joined(len(x), zip(*np.nonzero(close), strict=True)), strict=True)))
    odd = [(1000, None), (1001, [0.0] * 24), (1002, [float("nan")] + [1.0] * 23), (1003, [None] + [1.0] * 23), (1004, []), (1005, [1.0, 2.0]), (1006, [float("inf")] * 24), (None, rows[70][1])]
    frame = spark.createDataFrame([(*r, "c") for r in rows + odd], "vec_id long, embedding array<float>, node string")
    found = vectors.near_duplicates(frame, slab=slab).collect()
    by = {r.vec_id: r for r in found}
    wanted = {i: (n + (close[i][70] or i == 70), c) for i, (n, c) in wanted.items()}  # the row without an id is a vector too
    assert {i: (by[i].n_links, by[i].component_id) for i in wanted} == wanted
    for i, e in odd[:-1]:
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True), e
    assert by[None].component_id == wanted[70][1] and not by[None].kept
    assert len(found) == len(rows) + len(odd)
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_blocks_share_the_budget():
    assert sum(r * r for r in vectors.radii(64, 0.95)) == pytest.approx(0.1)
    turn = vectors.rotation(16)
    assert np.allclose(turn @ turn.T, np.eye(16))


TEXT = "Many words stand in this paragraph so that it looks like the text of an article and not like a menu"
PAGES = {
    f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href='/'>Home</a></nav><article><h1>Big &amp; <i>new</i>s</h1><p>{TEXT}<p>Two<br>lines\n &nbsp; here<script>var a='</p>';</script></article><footer>(c)</footer>": f"Big & news\n\n{TEXT}\n\nTwo lines here",
    f"<body class=with-sidebar><div id=sidebar>{TEXT}</div><main><p>A</p><div class='comments'>{TEXT}</div><!-- {TEXT} --><ul><li>x<li>y</ul><form>{TEXT}</form></main>{TEXT}": "A\n\nx\n\ny",
    f"<body><div class='top-menu'><a href=x>one</a></div><p>{TEXT}</p><p>{TEXT}</p><p class='cookie-notice'>{TEXT}</p><p><a href='x'>{TEXT}</a></p>": f"{TEXT}\n\n{TEXT}",
    "<article><p>1 < 2 && 3 > 2 &lt;b&gt; &#233; &notanentity &am": "1 < 2 && 3 > 2 <b> é ¬anentity &am",
    f"<article><p>{TEXT}</p><a hre": TEXT,
    f"<article><p>{TEXT}</p><p>one <noscript>two</noscript> <math><mi>three</mi></math> <object>four</object></p>": f"{TEXT}\n\none two three four",
    f"<article><p>{TEXT}</p><button>Share<p>{TEXT}</p><svg><template><select><p>end</p>": f"{TEXT}\n\nShare\n\n{TEXT}\n\nend",
    f"<article><p>{TEXT}</p><button><div>Share</div></button><p>{TEXT} <select><option>a</select></p></article>": f"{TEXT}\n\n{TEXT}",
    f"<body><p>{TEXT}</p></body>": TEXT,
    "<body><div class=content><p>Two short</p><p>paragraphs here</p></div></body>": "Two short\n\nparagraphs here",
    f"<body><div><a href=x>unclosed</div><p>{TEXT}</p><p>{TEXT}</p></body>": f"{TEXT}\n\n{TEXT}",
    f"<body><a name=top><p>{TEXT}</p><p>{TEXT} again</p></body>": f"{TEXT}\n\n{TEXT} again",
    f"<body><div class='tabs-content'><article><p>A</p><p>{TEXT}</p></article></div><div class=login>{TEXT}": f"A\n\n{TEXT}",
    f"<body><div class='form-page'><p>{TEXT}</p></div>": TEXT,
    f"<body><div id='share-page'><p>{TEXT}</p></div>": TEXT,
    f"<body><form><article><p>A</p><div class=alert>{TEXT}</div><div class=menu>{TEXT}</div></article></form>": f"A\n\n{TEXT}\n\n{TEXT}",
    f"<article><div>By A</div><div>{TEXT}</div><div>short end</div></article>": f"By A\n\n{TEXT}\n\nshort end",
    f"<form id=aspnet><div class=content><p>A</p><form>{TEXT}</form>": "A",
    "<article><header><h1>The title</h1></header><p>Text</p></article><header>Top</header>": "The title\n\nText",
    f"<div class='login-form'>{TEXT}</div><div class='comment-content'>{TEXT}</div><p>{TEXT}</p>": TEXT,
    f"<head><title>T</title><noscript></noscript><body><p>{TEXT}": TEXT,
    "": "",
    "<article></article>": "",
    "plain text of three words": "",
}


def test_main_text(spark):
    tree = html_text.train()
    for page, wanted in PAGES.items():
        assert html_text.main_text(page, tree) == wanted
    rows = [(i, f"u{i}", page, 1) for i, page in enumerate(PAGES)] + [(None, None, None, 1), (0, "u0", next(iter(PAGES)), 1)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted((r.page_id is None, r.page_id, r.text) for r in found if r.page_id is not None) == sorted((False, i, w) for i, w in [*enumerate(PAGES.values()), (0, next(iter(PAGES.values())))])
    assert [(r.text, r.n_chars) for r in found if r.page_id is None] == [("", 0)]
    assert all(r.n_chars == len(r.text) for r in found)
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_tree_holds_on_unseen_pages():
    """Layouts that the labelled table does not have, scored block by block."""
    rng = random.Random(8)
    tree, right, total = html_text.train(), 0, 0
    for _ in range(200):
        sentence = lambda n: " ".join(rng.choice("river mill field bridge water stone road".split()) for _ in range(n))
        parts = [(sentence(rng.randrange(1, 60)), True) for _ in range(rng.randrange(1, 8))]
        around = rng.choice(["article", "main"])
        page = f"<div class='{rng.choice(['nav', 'site-header', 'ad', 'cookie'])}'>{sentence(rng.randrange(1, 40))}</div><{around}>"
        page += "".join(f"<p>{text}</p>" for text, _ in parts) + f"</{around}><{'aside' if rng.random() < 0.5 else 'footer'}>{sentence(20)}"
        found = html_text.blocks(page)
        wanted = [b[0] in {text for text, _ in parts} and b[3] for b in found]
        decided = [html_text.decide(tree, row) for row in html_text.features(found)]
        right, total = right + sum(a == b for a, b in zip(decided, wanted, strict=True)), total + len(found)
    assert right / total > 0.99


def test_long_pages_are_kept_whole():
    text = "\n\n".join(f"{TEXT} {i}" for i in range(20_000))
    page = "<article>" + "".join(f"<p>{p} <a href=x></a></p>" for p in text.split("\n\n"))
    assert html_text.main_text(page, html_text.train()) == text


def test_tree_reads_words_and_links():
    """The tree decides by lengths and links where nothing names a part, and is the same in every run."""
    tree = html_text.train()
    assert tree == html_text.train()
    used = set()

    def walk(t):
        if len(t) > 1:
            used.add(html_text.FEATURES[t[0]])
            walk(t[2])
            walk(t[3])

    walk(tree)
    assert {"words", "link_share", "mark", "in_main"} <= used and used & {"words_before", "words_after", "link_share_before", "link_share_after"}
    rows = [(b, r) for page in html_text.labelled_pages() for found in [html_text.blocks(page)] for b, r in zip(found, html_text.features(found), strict=True)]
    assert sum(html_text.decide(tree, r) == b[0].startswith("+") for b, r in rows) / len(rows) > 0.95


def test_malformed_markup_takes_linear_time():
    for page in ("<a href=x>" * 40_000, "<button>" * 40_000, "<svg>" * 40_000, "<template><select>" * 40_000, "<" * 200_000, "<a b='" * 40_000, "<!--" * 50_000, '<p x="' + "y" * 300_000, "&" * 200_000):
        html_text.blocks(page)


def test_pipeline(spark):
    import corpus_pipeline

    rng = random.Random(9)
    prose = lambda n: " ".join(rng.choice(["stone", "river", "mill", "road"]) + str(rng.randrange(90)) for _ in range(n))
    text = prose(300)
    near = text.replace(text.split()[100], "other", 1)
    rows = [(1, text), (2, text), (3, near), (4, "too short"), (5, prose(100) + " mail bob.42@mail8.example.com"), (6, None), (6, prose(80))]
    rows = [(i, t, "en", "s" if i % 2 else None, len(t or "")) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = docs.columns
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(stage(spark, docs, ""), "test-pipeline")
        seen.append(docs)
    kept = [sorted(r.doc_id for r in d.collect()) for d in seen]
    assert kept[0] == [1, 2, 3, 5, 6] and kept[1] == [1, 5, 6] == kept[2]
    assert all(d.columns == names for d in seen[:4])
    assert not seen[2].filter("text like '%bob.42%'").count()
    assert set(kept[3]) <= {1, 5, 6} and set(kept[4]) == set(kept[3])
    assert seen[4].groupBy("sequence_id").sum("length").filter("`sum(length)` > 1024").count() == 0
