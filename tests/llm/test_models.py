"""Quality classifier, learned partitions, HTML extraction, licence scan and the pipeline."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.llm import ann, html_text, licenses, quality

SF = "/root/testdata/sf0.01"


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert ((got.score >= 0.5) == (got.predicted == 1)).all() and got.score.between(0, 1).all()
    assert (got.predicted == got.quality).mean() > 0.95


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, "", "x"), (2, "word " * 50_000, "x"), (2, "a", "x")], "doc_id long, text string, score string")
    none = spark.createDataFrame([(2, None), (None, 1)], "doc_id long, quality int")
    got = quality.quality(docs, none).collect()
    assert len(got) == 4 and all(r.score == pytest.approx(0.5) for r in got) and not any(r.held_out for r in got if r.doc_id is None)
    assert quality.quality(docs.limit(0), none).count() == 0
    kept = quality.accepted(docs, none)
    assert kept.columns == docs.columns and kept.count() == 4
    assert len(quality.statistics("")) == len(quality.FEATURES) == len(quality.statistics("Ä b\n|c!!!"))


def test_statistics_by_hand():
    """The features from their definitions, character by character."""
    rng = random.Random(4)
    for text in ["", "Ein Wort", "AB cd!! ef|gh\n\n  x. y\nx. y", *("".join(rng.choice("aB3 .,!|$é\n\t") for _ in range(rng.randrange(1, 300))) for _ in range(60))]:
        raw = text.encode()
        words = raw.split()
        lines = [line for line in raw.split(b"\n") if line.strip()]
        n, w, k = max(1, len(raw)), max(1, len(words)), max(1, len(lines))
        share = lambda test: sum(map(test, raw)) / n
        marks = b".,;:!?'\""
        low = [x.lower() for x in words]
        wanted = {
            "log_bytes": math.log1p(len(raw)), "log_words": math.log1p(len(words)), "upper": share(lambda b: 65 <= b <= 90), "lower": share(lambda b: 97 <= b <= 122),
            "digits": share(lambda b: 48 <= b <= 57), "blanks": share(lambda b: b == 32 or 9 <= b <= 13), "sentence_marks": share(lambda b: b in marks), "wide": share(lambda b: b > 127),
            "distinct_words": len(set(low)) / w, "commonest_word": max((low.count(x) for x in low), default=0) / w, "log_lines": math.log1p(len(lines)), "line_words": len(words) / k if words else 1 / k,
            "distinct_lines": len(set(lines)) / k, "ended_lines": sum(x.rstrip()[-1:] in (b".", b"!", b"?", b":", b";", b'"', b"'", b")") for x in lines) / k, "pipes": raw.count(b"|") / w,
            "short_words": sum(len(x) <= 3 for x in words) / w, "exclaims": raw.count(b"!") / w, "distinct_pairs": len(set(zip(low, low[1:]))) / w,
        }
        got = dict(zip(quality.FEATURES, quality.statistics(text)))
        assert {name: pytest.approx(value) for name, value in wanted.items()} == {name: got[name] for name in wanted}
        assert sum(got[c] for c in ("upper", "lower", "digits", "blanks", "sentence_marks", "other_marks", "wide")) == pytest.approx(1 if raw else 0)


def test_forest_is_the_trees():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = quality.fit(x, y, trees=20, depth=3)
    assert ((forest.score(x) > 0.5) == y).mean() > 0.95

    def walk(row):
        total = forest.base
        for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf):
            node = 0
            for _ in range(forest.depth):
                node = 2 * node + 1 + int(row[feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + math.exp(-total))

    assert np.allclose([walk(r) for r in x], forest.score(x))


def brute_nearest(rows, query, k):
    ok = [(i, v) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v) and len(v) == 8]
    q = dict(ok)[query]
    found = sorted(((-float(np.dot(np.array(v, np.float32).astype(float), np.array(q, np.float32).astype(float))), i) for i, v in ok if i != query))
    return [i for _, i in found[:k]]


def test_nearest_exact_edges(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.5, 2.0]) for _ in range(8)]) for i in range(70)]
    rows += [(100, None), (120, [0.0] * 8), (140, [None] + [1.0] * 7), (160, [float("nan")] + [1.0] * 7), (180, [float("inf")] * 8), (200, [1.0] * 3), (None, [1.0] * 8), (220, [])]
    df = spark.createDataFrame([(i, v, 1, 1.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {0, 20, 40, 60}
    assert all(found == brute_nearest(rows, q, 5) for q, found in got.items())
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    twice = ann.nearest(df.union(df.where("vec_id IN (0, 5)")), F.col("vec_id") == 0, k=80).collect()
    assert len(twice) == 70 and sum(r.vec_id == 5 for r in twice) == 2
    few = ann.nearest(df.where("vec_id < 4"), F.col("vec_id") == 0, k=20)
    assert few.count() == 3


def test_nearest_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 256)
    monkeypatch.setattr(ann, "BLOCK", 100)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 8))
    x = (centres[rng.integers(0, 40, 4000)] + 0.3 * rng.standard_normal((4000, 8))).astype(np.float32)
    x[:1400] = x[0]  # one vector in a third of the rows
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = ann.nearest(df, F.col("vec_id") % 100 == 0, k=10).toPandas()
    recall = []
    for query, rows in got.groupby("query_id"):
        score = x.astype(float) @ x[query].astype(float)
        score[query] = -np.inf
        kth = np.sort(score)[-10]
        assert len(rows) == 10 and np.allclose(score[rows.vec_id], rows.score)
        recall.append((rows.score >= kth - 1e-9).mean())
    assert np.mean(recall) >= 0.9 and len(recall) == 40


def test_nearest_routes_at_every_size(spark):
    """There is a router for a small table too; what it leaves out is measured against brute force."""
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    table = ann.usable(vectors).toPandas()
    x, ids = np.stack(table.vector).astype(float), table.vec_id.values
    assert ann.levels_of(len(x), len(x)) == 3 and ann.levels_of(70, 70) == 0 and ann.levels_of(10**9, 8192) == 7
    got = ann.nearest(vectors, F.col("vec_id") % 20 == 0).toPandas()
    asked = np.flatnonzero(ids % 20 == 0)
    near = x[asked] @ x.T
    near[np.arange(len(asked)), asked] = -np.inf
    wanted = {int(ids[q]): set(ids[np.argsort(-row)[:20]].tolist()) for q, row in zip(asked, near)}
    recall = [len(wanted[q] & set(rows.vec_id)) / 20 for q, rows in got.groupby("query_id")]
    assert len(recall) == len(wanted) and 0.9 <= np.mean(recall) < 1  # below 1: parts were left out


def test_parts_are_balanced():
    x = np.random.default_rng(0).standard_normal((512, 6))
    part = ann.balanced_parts(ann.neighbour_graph(x, 8), 3)
    assert np.bincount(part).tolist() == [64] * 8


PAGES = "page_id long, url string, html string, text string, host string"


def extract(spark, rows, **options):
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], PAGES)
    return {r.page_id: r.text for r in html_text.main_text(df, **options).collect()}


def test_html_elements(spark):
    body = (
        '<html><body><div class="cookie-notice">We use <b>cookies</b></div><header><h1>Site</h1></header><div id="content"><h2>T&amp;t&nbsp;&#8364;</h2>'
        '<p>one <i>two</i>\n three <span class="ad">buy</span>now<p>four</div><section class="comments"><p>nice</p></section><form><p>x</p></form>'
        "<div class='sidebar'>s</div><script>var a='</p>'</script><style>p{}</style><noscript>n</noscript>tail</body></html>"
    )
    article = '<nav>n</nav><p>outside</p><article><header><h1>Title</h1></header><p>a<br>b</p><ul><li>c<li>d</ul><aside>no</aside></article><footer>f</footer>'
    got = extract(spark, [(1, "http://a/1", body), (2, "http://a/2", article), (3, None, None), (4, "bad url", ""), (5, "http://a/5", "plain &lt;text&gt;"), (6, "http://a/6", "<p>unclosed <b>bold<p>next")])
    assert got == {1: "T&t € one two three now four tail", 2: "Title a b c d", 3: "", 4: "", 5: "plain <text>", 6: "unclosed bold next"}
    classes = '<div class="page has-sidebar"><article class="post"><div class="entry-header"><h1>T</h1></div><img class="responsive"><p class="responsive">a</p><div class="post-footer">no</div></article><div id="comments-2">no</div></div>'
    assert extract(spark, [(1, "http://a/1", classes)]) == {1: "T a"}
    assert extract(spark, []) == {}


def test_html_templates(spark):
    page = lambda n, host: (n, f"http://{host}/{n}", f"<div><p>Buy our book, friends</p></div><div><h2>Head {n}</h2><p>Own text {n}</p></div>")
    rows = [page(n, "many") for n in range(6)] + [page(n, "few") for n in range(10, 13)]
    rows += [(20 + n, f"http://copies/{n}", "<div><p>The same page</p></div>") for n in range(9)]
    got = extract(spark, rows, least_pages=5)
    assert all(got[n] == f"Head {n} Own text {n}" for n in range(6))
    assert all(got[n] == f"Buy our book, friends Head {n} Own text {n}" for n in range(10, 13))
    assert all(got[20 + n] == "The same page" for n in range(9))  # copies of a page are no template
    shared = [(n, f"http://h/{n}", f"<article><h1>{n}</h1><p>A passage that many articles quote</p><section><p>Subscribe now</p></section></article>") for n in range(6)]
    assert extract(spark, shared, least_pages=5)[0] == "0 A passage that many articles quote"


def test_html_rows_and_hosts(spark):
    """page_ids that are null or repeat on other hosts lose only their own host's templates; repeated pages stay."""
    page = lambda host, n, advert: (f"http://{host}/{n}", f"<div><p>{advert}</p></div><div><h2>Head {n}</h2><p>Own text {n}</p></div>")
    rows = [(n, *page("a", n, "Buy our book, friends")) for n in range(6)] + [(n, *page("b", n, "Buy our book, friends" if n == 3 else f"Advert {n}")) for n in range(6)]
    rows += [(None, *page("a", 7, "Buy our book, friends")), rows[0]]
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], PAGES)
    got = sorted(((r.page_id, r.url, r.text) for r in html_text.main_text(df).collect()), key=str)
    own = lambda u, h: "Own" if u.startswith("http://a") else h
    assert len(got) == len(rows) and got.count((0, "http://a/0", "Head 0 Own text 0")) == 2
    assert {(i, u) for i, u, t in got if t.startswith(("Buy", "Advert"))} == {(i, u) for i, u, h in rows if own(u, h) != "Own"}


def test_html_leaves_and_shares(spark):
    """What recurs by itself in small blocks, or on a small share of a large host's pages, is no template."""
    rows = [(n, f"http://big/{n}", f"<div><h2>References</h2><p>Own {n}</p><table><tr><td>Yes</td><td>{n}</td></tr></table></div><div>{'Seldom' if n < 6 else n}</div><section><p>Everywhere</p></section>") for n in range(200)]
    got = extract(spark, rows)
    assert all(got[n] == f"References Own {n} Yes {n} {'Seldom' if n < 6 else n}" for n in range(200))
    shares = {r.host: r for r in html_text.removed(spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], PAGES)).collect()}
    assert shares["big"].by_template == 200 * len("Everywhere") and shares["big"].by_rules == 0 and shares["big"].n_pages == 200
    assert shares["big"].main == sum(len("".join(t.split())) + t.count("Own ") for t in got.values())


def test_html_deep_and_long(spark):
    deep = "<div><b>" * 60_000 + "core" + "</i></b></div>" * 60_000
    got = extract(spark, [(1, "http://a/1", deep), (2, "http://a/2", "<p>word " * 200_000), (3, "http://a/3", "<article>" + "x " * 500_000)])
    assert got[1] == "core" and got[2] == " ".join(["word"] * 200_000) and len(got[3]) == 999_999


@pytest.mark.parametrize("html, wanted", [
    # class words alone delete nothing: a second sign is needed
    ('<div class="legal-content"><p>Main words of the page here.</p></div>', "Main words of the page here."),
    ('<div class="two-side layout"><p>Main words.</p></div><div class="side"><a href="/x">Other</a></div>', "Main words."),
    ('<article><p>The article begins.</p><div class="post-related-work"><p>Work that others did.</p></div></article>', "The article begins. Work that others did."),
    ('<article><p>Report.</p><section class="share-price"><p>It rose.</p></section></article>', "Report. It rose."),
    ('<div class="sidebar"><p>All that there is.</p></div>', "All that there is."),
    ('<p>A text of some length.</p><div class="related">%s</div>' % ("<p>Long and no links. </p>" * 9), "A text of some length. " + " ".join(["Long and no links."] * 9)),
    ('<p>Text.</p><div class="related"><a href="/1">A long list of</a> <a href="/2">other pages</a></div>', "Text."),
    ('<p>A text of some length.</p><div class="share">Send it on</div>', "A text of some length."),
    ('<p>A text of some length.</p><div class="site-footer">Imprint</div><div id="comments"><p>%s</p></div>' % ("I say so. " * 50), "A text of some length."),
    # a poor article beside a long text is a teaser
    ('<article><p>Teaser.</p></article><div><p>%s</p></div>' % ("The long text goes on. " * 9).strip(), "Teaser. " + ("The long text goes on. " * 9).strip()),
    ('<article><p>%s</p></article><div><p>Beside it.</p></div>' % ("The long text goes on. " * 9).strip(), ("The long text goes on. " * 9).strip()),
    ('<article><p>One of two.</p></article><article><p>Two of two.</p></article>', "One of two. Two of two."),
])
def test_names_need_a_second_sign(html, wanted):
    assert " ".join(text for text, _ in html_text.main_blocks(html_text.Page(html))) == wanted


def made_tree(rng, depth=0):
    """A random page as nested (tag, children); text is a string."""
    if depth == 3 or rng.random() < 0.3:
        return ("p", [rng.choice(["alpha", "beta", "gamma", f"own {rng.randrange(10**9)}"])])
    return (rng.choice(["div", "section"]), [made_tree(rng, depth + 1) for _ in range(rng.randrange(1, 4))])


def as_html(tree):
    return tree if isinstance(tree, str) else f"<{tree[0]}>{''.join(map(as_html, tree[1]))}</{tree[0]}>"


def test_templates_against_brute_force(spark):
    """Subtrees as written out, counted per host over unlike pages, and deleted, by plain recursion."""
    rng = random.Random(6)
    shared = [made_tree(rng) for _ in range(5)]
    pages = []
    for n in range(120):
        body = [made_tree(rng) if rng.random() < 0.6 else rng.choice(shared) for _ in range(rng.randrange(1, 5))]
        pages.append((n, f"http://h{n % 3 if n % 7 else 9}/{n}", body))
    pages += [(200 + n, "http://h1/again", pages[4][2]) for n in range(6)]  # copies of one page count once
    containers = lambda tree: [] if isinstance(tree, str) else [as_html(tree)] * (tree[0] != "p") + [x for child in tree[1] for x in containers(child)]
    host = lambda url: url.split("/")[2]
    counts, sizes = {}, {}
    for name, whole in {(host(url), "".join(map(as_html, body))) for _, url, body in pages}:
        sizes[name] = sizes.get(name, 0) + 1
    for name, whole, found in {(host(url), "".join(map(as_html, body)), frozenset(x for tree in body for x in containers(tree))) for _, url, body in pages}:
        for x in found:
            counts[name, x] = counts.get((name, x), 0) + 1
    gone = {k for k, n in counts.items() if n >= 5 and n >= 0.05 * sizes[k[0]]}

    def kept(tree, name):
        if isinstance(tree, str):
            return [tree]
        return [] if (name, as_html(tree)) in gone else [t for child in tree[1] for t in kept(child, name)]

    wanted = {n: " ".join(t for tree in body for t in kept(tree, host(url))) for n, url, body in pages}
    df = spark.createDataFrame([(n, url, "<body>" + "".join(map(as_html, body)) + "</body>") for n, url, body in pages], "page_id long, url string, html string").repartition(5)
    assert {r.page_id: r.text for r in html_text.main_text(df).collect()} == wanted
    assert len(gone) > 5 and any(wanted[n] != " ".join(t for tree in body for t in kept(tree, "none")) for n, _, body in pages)


def brute_scan(text, threshold, templates):
    """The best score for each licence over all runs of words, from the definition; of a template's best runs (highest score,
    then shortest, then first) kind and version have to be the template's."""
    found, best = licenses.words(text), {}
    for name, wording in templates:
        template, top = licenses.bigrams(wording), None
        for i in range(len(found)):
            for j in range(i + 1, len(found)):
                score = licenses.dice(frozenset(zip(found[i:j], found[i + 1 : j + 1])), template)
                if score >= threshold - 1e-12 and (top is None or (-score, j - i, i) < (-top[0], top[2] - top[1], top[1])):
                    top = score, i, j
        if top is None:
            continue
        kinds, version = licenses.marks(licenses.words(wording))
        inside, around = licenses.marks(found[top[1] : top[2] + 1]), licenses.marks(found[max(0, top[1] - 1) : top[2] + 4])
        if kinds == inside[0] == around[0] and version in (None, inside[1] or around[1]):
            best[name] = max(best.get(name, 0), top[0])
    return best


@pytest.mark.parametrize("text, wanted", [
    ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"), ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("licensed under cc by 3.0", "CC-BY-3.0"), ("CC BY 4.5", None), ("Licensed under CC BY 4.5.", None),
    ("Licensed under CC BY-NC 2.5.", "CC-BY-NC-2.5"), ("Licensed under the Apache License, Version 1.1.", None), ("This work is licensed under the GNU General Public License, version 4.", None),
    ("// SPDX-License-Identifier: MIT", "MIT"), ("SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1"), ("SPDX-License-Identifier: Unheard-1.0", None), ("# spdx-license-identifier: apache-2.0", "Apache-2.0"),
    ("Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt or copy at\nhttp://www.boost.org/LICENSE_1_0.txt)", "BSL-1.0"), ("Eclipse Public License - v 1.0", "EPL-1.0"),
    ("GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007", "AGPL-3.0"),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 3.0 Unported License.", "CC-BY-ND-3.0"), ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "CC-BY-NC-ND-4.0"),
])
def test_versions_and_kinds_are_exact(text, wanted):
    assert [hit.license for hit in licenses.Scanner(0.8, licenses.TEMPLATES).scan(text)] == ([wanted] if wanted else [])


def test_every_wording_is_its_own_licence():
    scanner = licenses.Scanner(0.8, licenses.TEMPLATES)
    for name, wording in licenses.TEMPLATES:
        assert scanner.scan(wording)[0].license == name


def test_license_runs_against_brute_force():
    rng, vocabulary = random.Random(3), ["the", "license", "licensed", "under", "version", "public", "general", "2.0", "mit", "cc", "by", "software", "gnu"]
    short = [(n, w) for n, w in licenses.TEMPLATES if len(w) < 200]
    made = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 25))) for _ in range(150)]
    made += [". ".join(rng.choice(short)[1] for _ in range(2)) + rng.choice([" and more", "\n\n2.0"]) for _ in range(60)] + ["under the license under the license version 2.0 " * 8]
    for threshold in (0.8, 0.5):
        scanner = licenses.Scanner(threshold, short)
        for text in made:
            assert {n: h.score for n, h in scanner.best(text).items()} == brute_scan(text, threshold, short)


def test_license_scan(spark):
    code = "\n".join(f"def f{i}(x):\n    return x * {i}  # step {i}" for i in range(400))
    bsd = [part for part in dict(licenses.wordings())["BSD-3-Clause"].split("\n\n")]
    texts = ["Some prose.\nLicensed under the Apache License, Version 2.0.\nMore.", "x\n\n" + licenses._MIT.replace(". ", ".\n") + "\n\ny", "Licensed under CC BY-NC 2.5.", None, "", "one", "Released under the MIT License.\n" * 300]
    texts += [
        "/*\nCopyright (c) 2021 Foo\n\n" + licenses._MIT + "*/\n" + code,
        "Copyright 2021 Foo. Licensed under CC BY 4.0. All rights reserved by the authors.",
        "# " + "\n# ".join("\n\n".join(bsd).split("\n")) + "\n" + code,
        "This file is part of the project. Licensed under the Apache License, Version 2.0. See the file NOTICE for details on that and on others.",
        dict(licenses.wordings())["GPL-3.0"], code, "a license text is no software license, however public",
        licenses._MIT + code + licenses._APACHE_HEADER,
    ]
    df = spark.createDataFrame([(i, t, "a", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, license string, score double")
    got = {r.doc_id: r for r in licenses.license_scan(df).collect()}
    assert [got[i].license for i in range(len(texts))] == [
        "Apache-2.0", "MIT", "CC-BY-NC-2.5", None, None, None, "MIT", "MIT", "CC-BY-4.0", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", None, None,
        "MIT"]
    assert {h.license for h in got[14].hits} == {"MIT", "Apache-2.0"} and got[14].n_licenses == 2
    for i in (0, 7, 8, 9, 10, 11):
        hit = got[i].hits[0]
        assert got[i].n_licenses == 1 and got[i].score == hit.score > 0.95 and licenses.dice(licenses.bigrams(texts[i][hit.start : hit.end]), licenses.bigrams(texts[i][hit.start : hit.end])) == 1
    assert texts[8][got[8].hits[0].start : got[8].hits[0].end] == "Licensed under CC BY 4.0"
    assert licenses.license_scan(df.limit(0)).count() == 0


def near_copies_by_brute_force(rows):
    """The smallest doc_id of each group that links of a Jaccard coefficient of 0.8 or more (five-word shingles) connect."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)} | dict.fromkeys("\t\n\x0b\x0c\r", " "))
    sets, holders = {}, {}
    for r in rows:
        words = [w for w in (r.text or "").translate(lower).split(" ") if w]
        sets[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else {()}
        for shingle in sets[r.doc_id]:
            holders.setdefault(shingle, []).append(r.doc_id)
    root = {i: i for i in sets}
    find = lambda i: i if root[i] == i else find(root[i])
    for a in sets:
        for b in {b for shingle in sets[a] for b in holders[shingle] if b < a}:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {find(i) for i in sets}


def test_stages_edges(spark):
    """Nulls, repeated rows, empty tables, columns whose names the operators use: each stage has a defined result."""
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, root string, place string"
    made = lambda rows: spark.createDataFrame([(i, t, None, s, None, 1.0, 2, "r", "p") for i, t, s in rows], schema)
    rows = [(1, "a b c d e f g", "s"), (1, "a b c d e f g", "s"), (2, "a b c d e f g", None), (None, "a b c d e f g", "s"), (3, None, "s"), (4, "", None), (5, "x" * 300_000, "s"), (None, "only", None)]
    docs = made(rows)
    kept = corpus_pipeline.keep_quality(spark, docs, SF)
    forest = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = [r for r in rows if forest.score(np.array([quality.statistics(r[1] or "")]))[0] >= 0.5]
    assert kept.columns == docs.columns and sorted(((r.doc_id, r.text, r.source) for r in kept.collect()), key=str) == sorted(good, key=str)
    once = corpus_pipeline.drop_copies(spark, docs, SF)
    assert once.columns == docs.columns and sorted(((r.doc_id, r.text or "") for r in once.collect()), key=str) == sorted([(2, rows[0][1]), (4, ""), (5, rows[6][1]), (None, "only")], key=str)
    near = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert near.columns == docs.columns and sorted(((r.doc_id, r.text or "") for r in near.collect()), key=str) == sorted([(1, rows[0][1]), (3, ""), (5, rows[6][1]), (None, "only")], key=str)
    packed = corpus_pipeline.pack(spark, docs, SF).toPandas()
    assert packed[packed.start == 0].shape[0] == len(rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    first = corpus_pipeline.keep_quality(spark, docs, SF).persist()
    rejected = {r.doc_id for r in quality.quality(docs, labels).where("predicted = 0").collect()}
    assert first.schema == docs.schema and {r.doc_id for r in first.collect()} == {r.doc_id for r in docs.collect()} - rejected
    second = corpus_pipeline.drop_copies(spark, first, SF).persist()
    wanted = {}
    for r in first.collect():
        wanted[r.text] = max(wanted.get(r.text, -1), r.doc_id)
    assert second.columns == docs.columns and sorted(r.doc_id for r in second.collect()) == sorted(wanted.values())
    third = corpus_pipeline.drop_near_copies(spark, second, SF).persist()
    assert third.columns == docs.columns and sorted(r.doc_id for r in third.collect()) == sorted(near_copies_by_brute_force(second.collect()))
    packed = corpus_pipeline.pack(spark, third, SF)
    assert packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).where("n != m").count() == 0
    assert packed.select("doc_id").distinct().count() == third.count()
