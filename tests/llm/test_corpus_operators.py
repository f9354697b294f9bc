"""Near-duplicates, decontamination, main text and the pipeline: brute force and edge rows."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from lamina.llm import decontamination, html_tree, near_dedup
from lamina.llm.components import components
from lamina.llm.shingles import generalised_jaccard, shingle_hashes, word_hashes, words_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, dropped string"


def documents(spark, rows):
    full = [(d, t, "en", "s", len(t or ""), "x") for d, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def jaccard(a, b):
    common, total = sum((a & b).values()), sum(a.values()) + sum(b.values())
    return common / (total - common) if total else 0.0


def plain_classes(rows, similarity=0.8):
    bags = [shingles(t) for _, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, ta) in enumerate(rows):
        for j in range(i):
            b, tb = rows[j]
            if a is None or b is None or not ta or not tb:
                continue
            same = ta == tb or jaccard(bags[i], bags[j]) >= similarity
            if same and root(a) != root(b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted((d, None if d is None else root(d)) for d, _ in rows if d is not None)


def near_rows():
    rng = np.random.default_rng(4)
    vocabulary = [f"word{i}" for i in range(400)]
    rows, number = [], 0
    for _ in range(25):
        base = rng.choice(vocabulary, rng.integers(30, 160)).tolist()
        for _ in range(rng.integers(1, 7)):
            copy = list(base)
            for _ in range(rng.integers(0, 6)):
                copy[rng.integers(0, len(copy))] = rng.choice(vocabulary)
            rows.append((int(number * 7 % 1009), " ".join(copy)))
            number += 1
    return rows


def test_classes_as_by_brute_force(spark):
    rows = near_rows()
    rows += [(2001, "Few words"), (2002, "few, WORDS!"), (2003, "!!!"), (2004, "!!!"), (2005, "..."),
             (2006, None), (2007, ""), (2008, ""), rows[3], (2009, "w " * 40_000)]
    found = near_dedup.classes(documents(spark, rows)).collect()
    assert sorted(map(tuple, found)) == plain_classes(rows)


def test_null_ids_have_no_class_and_stay(spark):
    docs = documents(spark, [(None, "a b c d e"), (1, "a b c d e"), (2, "a b c d e")])
    found = {(r.doc_id, r.class_id) for r in near_dedup.classes(docs).collect()}
    assert found == {(None, None), (1, 1), (2, 1)}
    kept = near_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {None, 1}
    assert near_dedup.classes(docs.where("false")).count() == 0


def test_a_large_group_of_near_copies_is_one_class(spark):
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in rng.integers(0, 5_000, 120)]
    rows = []
    for i in range(600):
        copy = list(base)
        copy[rng.integers(0, 120)] = f"x{i}"
        rows.append((i + 10, " ".join(copy)))
    assert {r.class_id for r in near_dedup.classes(documents(spark, rows)).collect()} == {10}


def test_pairs_in_a_family_just_below_the_similarity_are_found(spark):
    template = [f"w{i}" for i in range(400)]

    def text(i, suffix):
        return " ".join([*template, *suffix, *[f"x{i}_{k}" for k in range(53 - len(suffix))]])

    # 0.79 to all others and, of two neighbours with the same six words, 0.81 to each other.
    rows = [(i, text(i, [f"p{i // 2}_{k}" for k in range(6)] if i < 80 else [])) for i in range(500)]
    assert 0.78 < jaccard(shingles(rows[90][1]), shingles(rows[91][1])) < 0.8
    assert 0.8 < jaccard(shingles(rows[0][1]), shingles(rows[1][1])) < 0.82
    found = near_dedup.classes(documents(spark, rows)).collect()
    assert sorted(map(tuple, found)) == [(i, i - i % 2 if i < 80 else i) for i in range(500)]


def test_rounds_that_link_little_are_left_to_the_exact_step(spark, monkeypatch):
    template = [f"w{i}" for i in range(400)]

    def text(i, suffix):
        return " ".join([*template, *suffix, *[f"x{i}_{k}" for k in range(53 - len(suffix))]])

    rounds = []

    def counting(labelled, heads, real=near_dedup.head_pairs):
        rounds.append(1)
        return real(labelled, heads)

    monkeypatch.setattr(near_dedup, "head_pairs", counting)
    # 0.79 to all others and, of a few neighbours, 0.81 to each other: most pairs are no links.
    rows = [(i, text(i, [f"p{i // 2}_{k}" for k in range(6)] if i < 8 else [])) for i in range(120)]
    found = near_dedup.classes(documents(spark, rows)).collect()
    assert sorted(map(tuple, found)) == [(i, i - i % 2 if i < 8 else i) for i in range(120)]
    assert len(rounds) == len(near_dedup.band_turns(near_dedup.BANDS))


def near_family(n):
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in rng.integers(0, 5_000, 120)]
    for i in range(n):
        copy = list(base)
        copy[rng.integers(0, 120)] = f"x{i}"
        yield i, " ".join(copy)


def test_head_pairs_of_a_family_follow_its_members(spark, monkeypatch):
    listed = []

    def counting(labelled, heads, real=near_dedup.head_pairs):
        pairs = real(labelled, heads)
        listed[-1] += pairs.count()
        return pairs

    monkeypatch.setattr(near_dedup, "head_pairs", counting)
    for n in (300, 600):
        listed.append(0)
        found = near_dedup.classes(documents(spark, list(near_family(n)))).collect()
        assert {row.class_id for row in found} == {0}
    assert all(pairs <= 3 * n for pairs, n in zip(listed, (300, 600), strict=True)), listed


def test_bands_take_turns():
    assert near_dedup.band_turns(24) == [(0, 0), (1, 2), (3, 6), (7, 14), (15, 23)]
    assert near_dedup.band_turns(1) == [(0, 0)]


def test_a_hot_token_is_repeated_in_proportion_to_both_sides(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "POSTINGS", 10)

    def rows(short, n):
        lines, columns = -(-short // 10), -(-n // 10)
        placed = spark.range(n).selectExpr(
            "7L AS token", "id AS doc", "id AS root", "5L AS size", "5L AS left",
            f"id < {short} AS shorter", f"{lines} AS lines", f"{columns} AS columns",
        )
        x, y = near_dedup.grid(placed)
        pairs = x.join(y, ["token", "line", "column"]).select("doc_x", "doc_y").distinct()
        assert pairs.count() == short * n
        return x.count() + y.count()

    assert [rows(1, n) for n in (100, 200, 400)] == [110, 220, 440]
    assert rows(40, 40) == 40 * 4 + 40 * 4


def test_signatures_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(6)
    a = {int(x): float(w) for x, w in zip(rng.integers(1, 2**63, 300), rng.uniform(0.2, 4, 300), strict=True)}
    keys = list(a)
    b = {**{k: a[k] * rng.uniform(0.5, 1.5) for k in keys[60:]}, **{k + 1: 1.0 for k in keys[:40]}}
    both = set(a) | set(b)
    wanted = sum(min(a.get(k, 0), b.get(k, 0)) for k in both) / sum(
        max(a.get(k, 0), b.get(k, 0)) for k in both
    )

    def signed(weights):
        items = sorted(weights.items())
        return near_dedup.signature(
            np.array([k for k, _ in items], np.uint64), np.array([w for _, w in items]), 2_000
        )

    assert abs((signed(a) == signed(b)).mean() - wanted) < 0.04
    one = near_dedup.signature(np.array([5], np.uint64), np.array([1.0]), 120)
    assert len(one) == 120


def test_exact_similarity_of_packed_multisets():
    a, b = word_hashes(words_of("a b c d e f g a b c d e")), word_hashes(words_of("a b c d e f"))
    from lamina.llm.shingles import counted

    wanted = jaccard(shingles("a b c d e f g a b c d e"), shingles("a b c d e f"))
    found = generalised_jaccard(*counted(shingle_hashes(a)), *counted(shingle_hashes(b)))
    assert found == pytest.approx(wanted)


@pytest.mark.parametrize("links_per_task", [250_000, 12])
def test_components_of_a_chain_and_a_star(spark, monkeypatch, links_per_task):
    """In one task, and by alternating stars over the links that several tasks contract."""
    monkeypatch.setattr("lamina.llm.components.LINKS_PER_TASK", links_per_task)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(i, 7) for i in range(8, 40)]
    links = spark.createDataFrame([*chain, *star, (3, 3)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    wanted = {i: 100 for i in range(101, 161)} | {i: 7 for i in range(8, 40)}
    assert found == wanted


def items_and_documents():
    rng = np.random.default_rng(9)
    vocabulary = [f"v{i}" for i in range(900)]
    items = [(i, " ".join(rng.choice(vocabulary, n))) for i, n in enumerate([5, 9, 24, 33, 60, 200] * 4)]
    items += [(100, "three short words"), (101, None), (102, "?!"), (None, "v1 v2 v3 v4 v5 v6"), (3, items[0][1])]
    rows = []
    for i in range(120):
        words = rng.choice(vocabulary, rng.integers(0, 400)).tolist()
        if i % 3 == 0:
            part = (items[i % 24][1] or "").split()
            part = part[: max(1, int(len(part) * rng.choice([0.5, 0.85, 1.0])))]
            at = rng.integers(0, len(words) + 1)
            words[at:at] = part
        rows.append((i, " ".join(words).upper() if i % 2 else ", ".join(words)))
    rows += [(500, "these are THREE short; words here"), (501, None), (502, ""), (None, items[1][1]),
             (503, "v7 " * 30_000 + items[5][1]), rows[0]]
    return items, rows


def test_containment_as_by_brute_force(spark):
    items, rows = items_and_documents()

    def runs(text, n):
        words = re.findall(r"\w+", (text or "").lower())
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()

    wanted = set()
    for item, text in items:
        n = min(5, len(re.findall(r"\w+", text or "")))
        own = runs(text, n)
        for doc, whole in rows:
            if item is not None and doc is not None and own and len(own & runs(whole, n)) >= 0.8 * len(own):
                wanted.add((doc, item))
    docs = documents(spark, rows)
    tests = spark.createDataFrame([(*x, "x") for x in items], "item_id long, text string, doc_id string")
    found = decontamination.contaminated(docs, tests).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted and len(found) == len(wanted)
    kept = decontamination.keep_clean(docs, tests)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in wanted}
    assert decontamination.contaminated(docs.where("false"), tests).count() == 0
    assert decontamination.contaminated(docs, tests.where("false")).count() == 0


def test_few_items_are_missed_by_construction():
    from math import comb

    needed = decontamination.needed_hits(24, 0.8, 1e-6)
    lost = sum(comb(24, k) * 0.8**k * 0.2 ** (24 - k) for k in range(needed))
    assert lost <= 1e-6 and needed > 1


def text_of(html):
    return html_tree.main_text(html, "h", set())


def test_article_without_what_declares_itself_otherwise():
    html = """<!doctype html><html><head><title>T</title><style>p{}</style>
    <script>var t="</p><article>no</article>";</script></head><body class="with-sidebar">
    <header>Site</header><nav><ul><li><a href=x>Home</a></ul></nav>
    <div class="cookie-notice">We use cookies</div><div id="sidebar">Side</div>
    <main><article class="post"><h1>A &amp; B</h1><!-- hidden --><p>One <b>bo</b>ld
    word&nbsp;here.<br>Next<p>Two<aside>aside</aside><form>Name <input><button>Go</button></form>
    <div class="ad">Buy</div><table><tr><td>x<td>y</table><p hidden>gone
    <section id="comments"><article class="comment">I disagree</article></section></article></main>
    <footer>&copy; all</footer></body>"""
    assert text_of(html) == "A & B One bold word here. Next Two x y"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain &lt;b&gt; text &#233;", "plain <b> text é"),
        ("<p>open <i>never closed", "open never closed"),
        ("a < b and c > d", "a < b and c > d"),
        ("<div class=ad>x", ""),
        ("<nav>menu<article><p>real</article>", "real"),
        ("<p title='a>b'>t</p><p>u</p>", "t u"),
        ("</div></p>stray<p>end", "stray end"),
        ("<article></article><p>outside", "outside"),
        ("<script>never closed <p>x", ""),
    ],
)
def test_odd_pages(html, text):
    assert text_of(html) == text


def site(spark, n=40):
    pages = []
    for i in range(n):
        body = f"<div class=top>Welcome to our site</div><div class=story><p>Story {i} begins.<p>And {i} ends.</div>"
        links = "".join(f"<li><a href=/{i}{j}>link {i} {j}</a>" for j in range(5))
        pages.append((i, "http://Shop.example/x?y", f"<body>{body}<ul class=more>{links}</ul>", "x"))
    pages += [(900, "http://other.example/", "<div class=top>Welcome to our site</div>", "x"),
              (901, None, None, "x"), (902, "", "", "x"), (None, "u", "<p>text", "x"), pages[0]]
    return spark.createDataFrame(pages, "page_id long, url string, html string, text string")


def test_repeated_and_linked_branches_of_a_host_go(spark):
    pages = site(spark)
    rows = html_tree.extract(pages).collect()
    assert len(rows) == 45
    found = {r.page_id: r.text for r in rows}
    assert all(found[i] == f"Story {i} begins. And {i} ends." for i in range(40))
    assert (found[900], found[901], found[902], found[None]) == ("Welcome to our site", "", "", "text")
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html_tree.extract(pages.where("false")).count() == 0


def test_node_importance_is_between_its_bounds(spark):
    rows = html_tree.node_importance(site(spark)).collect()
    assert all(-1e-9 <= r.importance <= 1 + 1e-9 for r in rows)


ARTICLE_CASES = [
    ("<article><p>Text of it.<div class='share-price'>12.50</div></article>", "Text of it. 12.50"),
    ("<article><p>Text.<section id=login>How to log in</section></article>", "Text. How to log in"),
    ("<article><p>Eat.<table class=menu><tr><td>Soup</table></article>", "Eat. Soup"),
    ("<article><p>Text.<div class=AdSlot>Buy</div><ins class=adsbygoogle>x</ins></article>", "Text."),
    ("<article><p>Text.<ol class='commentList'><li>No!</ol><div id=readerFeedback>Yes</div></article>", "Text."),
    ("<article><p>The long story.</article><article class=teaser><p>Other.</article>", "The long story."),
    ("<article><p>The long story.</article><article><p>Other.</article>", "The long story."),
    ("<main><p>Aside<article><p>The whole story</article></main>", "The whole story"),
    ("<div class=NewsletterBox>Sign</div><p>Plain page", "Plain page"),
]


@pytest.mark.parametrize(("html", "text"), ARTICLE_CASES)
def test_names_inside_an_article_count_only_if_they_say_nothing_else(html, text):
    assert text_of(f"<body>{html}</body>") == text


def recipes(spark, host, n, first=0):
    """Pages with a marked article whose headings repeat, between unnamed repeated blocks."""
    pages = [
        (
            first + i,
            f"http://{host}/{i}",
            "<div><a href=/>Home</a> <a href=/a>All recipes</a></div><article>"
            f"<h1>Dish {first + i}</h1><h2>Ingredients</h2><p>{i} eggs and {i + 3} apples"
            f"<h2>Method</h2><p>Stir {i} times.<ul><li><a href=/b>Print</a><li><a href=/c>Mail</a></ul>"
            "</article><div>All rights reserved by us</div>",
        )
        for i in range(n)
    ]
    return spark.createDataFrame(pages, "page_id long, url string, html string")


def test_repeated_headings_of_articles_stay_and_repeated_links_go(spark):
    rows = html_tree.extract(recipes(spark, "food.example", 30)).collect()
    for row in rows:
        i = row.page_id
        assert row.text == (
            f"Dish {i} Ingredients {i} eggs and {i + 3} apples Method Stir {i} times."
        )


def plain_pages(spark, host, n, first=0):
    """Pages without any article: blocks without names, some of which repeat."""
    pages = [
        (
            first + i,
            f"http://{host}/{i}",
            f"<div class=a>Best shop in town</div><div class=b><p>Story {first + i} is a long "
            f"one that goes on for {i} days.</div><div class=c>Call us any time you like</div>",
        )
        for i in range(n)
    ]
    return spark.createDataFrame(pages, "page_id long, url string, html string")


def test_hosts_with_few_pages_lean_on_the_same_style_elsewhere(spark):
    """From 1 to 20 pages of a host there is no number at which its blocks are judged at once."""
    alone = html_tree.node_importance(plain_pages(spark, "one.example", 1)).collect()
    assert {row.importance for row in alone} == {1.0}
    large = plain_pages(spark, "large.example", 40)
    importance = []
    for n in (2, 4, 8, 16):
        small = plain_pages(spark, "small.example", n, first=100)
        nodes = html_tree.node_importance(small).collect()
        importance.append(min(row.importance for row in nodes))
        both = html_tree.extract(large.unionAll(small)).collect()
        for row in both:
            assert row.text.startswith(f"Story {row.page_id} is a long") and "shop" not in row.text
    assert importance == sorted(importance, reverse=True) and importance[0] > 0.5


def plain_importance(pages):
    """The importance of each text on pages of one host, from entropies over dictionaries."""
    found, below, kinds = {}, {}, {}
    for _, _, html in pages:
        page = html_tree.Page(html, "h")
        for path, own, n in {path: (path, own, n) for path, own, n in page.styles()}.values():
            below.setdefault(path, Counter())[own] += 1
            kinds[path] = max(kinds.get(path, 1), n)
        parts = page.parts()
        for node in {part.node for part in parts}:
            found.setdefault(node, {"pages": 0, "texts": Counter(), "chars": 0, "links": 0})["pages"] += 1
        for node, text in {(part.node, part.text) for part in parts}:
            found[node]["texts"][text] += 1
        for part in parts:
            found[part.node]["parent"] = part.parent
            found[part.node]["chars"] += len(part.text)
            found[part.node]["links"] += part.link_chars
    for node in found.values():
        m = node["pages"]
        own = [np.log(c) for c in node["texts"].values()]
        content = 1 - np.mean(own) / np.log(m)
        styles = below.get(node["parent"], Counter())
        total = sum(styles.values())
        shares = [c / total for c in styles.values()]
        variety = -sum(p * np.log(p) for p in shares) / np.log(total) if total > 1 else 1.0
        weight = html_tree.DAMPING ** kinds.get(node["parent"], 1)
        plain = max(0.0, 1 - node["links"] / max(node["chars"], 1))
        own = ((1 - weight) * variety + weight * content) * plain
        # With one host the style elsewhere is the node's own.
        prior = html_tree.PRIOR_PAGES
        expected = ((m - 1) * own + prior) / (m - 1 + prior)
        yield m, ((m - 1) * own + prior * expected) / (m - 1 + prior)


def test_importance_equals_entropies_by_loops(spark):
    pages = plain_pages(spark, "h", 12).collect()
    pages += [(100 + i, "http://h/x", "<div class=b><p>Again<p>and more</div>") for i in range(3)]
    df = spark.createDataFrame([tuple(p) for p in pages], "page_id long, url string, html string")
    got = sorted((row.pages, round(row.importance, 6)) for row in html_tree.node_importance(df).collect())
    wanted = sorted((m, round(float(x), 6)) for m, x in plain_importance([tuple(p) for p in pages]))
    assert got == wanted


def test_deep_and_long_pages():
    assert text_of("<div>" * 5_000 + "deep") == "deep"
    assert len(text_of("<p>word " * 20_000)) == 5 * 20_000 - 1


def test_pipeline_stages_in_order(spark, tmp_path):
    letters = "the of and that with from they have this were words which there their about".split()
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(rng.choice(letters, 40)) + "\nshared line of every text") for i in range(30)]
    secret = " ".join(rng.choice(letters, 25))
    rows += [(40, "extra " + rows[3][1]), (41, "before " + secret + " after"), (42, "12345"), (43, None)]
    documents(spark, rows).drop("dropped").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, secret)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept.append({r.doc_id for r in docs.collect()})
    everything = {d for d, _ in rows}
    assert kept[0] == everything - {42, 43} and kept[1] == kept[0]
    assert kept[2] == kept[1] - {40} and kept[3] == kept[2] - {41}
    lines = {r.doc_id: r.text.count("\n") for r in docs.collect()}
    assert lines[0] == 1 and all(n == 0 for d, n in lines.items() if d)
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in final} == kept[3]
    assert all(r.parity and r.round_trip and r.n_tokens == len(r.ids) for r in final)


def test_stages_make_their_python_rows_in_small_batches(spark, tmp_path, monkeypatch):
    """The frame of a stage is run by its caller, under the caller's setting: what is left of
    Python in its plan would get whole batches. The session has its own setting afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, stored = spark.conf.get(name), {}, corpus_pipeline.stored

    def noted(df, label):
        seen[label] = int(spark.conf.get(name))
        return stored(df, label)

    monkeypatch.setattr(corpus_pipeline, "stored", noted)
    rows = [(i, f"the words of text {i} and of no other one there") for i in range(8)]
    docs = documents(spark, rows).drop("dropped")
    spark.createDataFrame([(1, "an item of some words")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    for number in (0, 3, 4):
        kept = corpus_pipeline.STAGES[number][1](spark, docs, str(tmp_path))
        plan = kept._jdf.queryExecution().toString()
        assert "Python" not in plan and "MapInArrow" not in plan and kept.count() == 8
    assert seen == {"identified": 256, "clean": 256, "pieces": 256}
    assert spark.conf.get(name) == before


def test_encoding_and_decoding_need_one_worker_a_task(spark, monkeypatch):
    """Each Python operator of a task is a worker of its own, and idle ones stay."""
    plans, stored = [], corpus_pipeline.stored

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(corpus_pipeline, "stored", noted)
    docs = documents(spark, [(1, "some words"), (2, None)]).drop("dropped")
    found = corpus_pipeline.encode_pieces(spark, docs, "").collect()
    assert len(found) == 2 and all(r.parity and r.round_trip for r in found)
    assert [plan.count("MapInArrow") for plan in plans] == [1]


def test_near_dedup_hands_python_few_rows_at_once(spark, monkeypatch):
    """A batch is held whole on both sides. The session has its own setting again afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, stored = spark.conf.get(name), {}, near_dedup.stored

    def noted(df, label):
        seen[label] = int(spark.conf.get(name))
        return stored(df, label)

    monkeypatch.setattr(near_dedup, "stored", noted)
    rows = [(n, f"one two three four five six seven eight nine ten {n % 2}") for n in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert found == {n: n % 2 for n in range(6)}
    assert {seen[label] for label in ("signatures", "multisets", "verified")} <= {near_dedup.BATCH}
    assert spark.conf.get(name) == before


def test_words_are_hashed_without_a_table_that_stays():
    from lamina.llm import shingles

    kept = {n: len(v) for n, v in vars(shingles).items() if isinstance(v, dict)}
    word_hashes([f"word{n}" for n in range(1_000)])
    assert kept == {n: len(v) for n, v in vars(shingles).items() if isinstance(v, dict)}
