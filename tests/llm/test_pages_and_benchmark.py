"""Page extraction, decontamination and the pipeline."""

from __future__ import annotations

import html as entities
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_helpers import SF, SF_TINY, documents
from loadlens.llm import decontaminate as D
from loadlens.llm import styletree as S
from loadlens.llm.queries import QUERIES

# ------------------------------------------------------------------ pages


def plain_article(page: str) -> str:
    """The article of a page of the test tables, by pattern."""
    found = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    if not found:
        return ""
    blocks = re.split(r"</?(?:p|h1|div|ul|li|article)[^>]*>", found[1])
    return "\n".join(x for x in (" ".join(entities.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in blocks) if x)


def test_op10_equals_the_article(spark):
    pages = duckdb.connect().sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in QUERIES["op10_html_extraction"](spark, SF).collect()}
    assert got == {i: (plain_article(h), len(plain_article(h))) for i, h in pages}


def read(page, removed=None):
    return S.extract(S._reader(), page, removed)


@pytest.mark.parametrize("page, text", [
    ("", ""), ("just text &amp; more", "just text & more"), ("<p>a<p>b<br>c</p>d", "a\nb c\nd"), ("<div>a <b>b</i> c</div>", "a b c"),
    ("<article><h1>t</h1><div class='ad'>x</div><p>y<nav>z</nav></article>", "t\ny"),
    ("<body><header>h</header><main><header>title</header>m</main><footer>f</footer>", "title\nm"),
    ("<script>var a='</p>';</script><style>p{}</style><p>q</p><!-- c --><p>r", "q\nr"),
    ("<p>1 < 2 &lt; 3&nbsp;\n 4 &#233;</p>", "1 < 2 < 3 4 é"), ("<ul><li>a<li>b</ul>", "a\nb"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<div id=comments><p>c</p></div><div class='article-header'>k</div>", "k"),
    ("<p title='a>b'>x</p><p title=\"unclosed>y</p>", "x\ny"), ("<form><p>f</form><div hidden>h</div><p>g", "g"),
    ("</p></div>z<article>w", "z\nw"), ("<script>never closed <p>x", ""), ("a<!-- open", "a")])
def test_markup(page, text):
    assert read(page) == text


@pytest.mark.parametrize("page, text", [
    ("<body><form id=aspnetForm><nav>n</nav><article><p>a</p></article><footer>f</footer></form>", "a"),
    ("<body class='has-sidebar'><article>a</article>", "a"), ("<div class='no-sidebar'><p>a</p></div><div class='sidebar'>s</div>", "a"),
    ("<div id='page' class='header-fixed'><p>a</p></div><div class='nav-menu'>n</div>", "a"), ("<body class='sidebar'><p>a</p>", "a"),
    ("<div class='sidebar'><main><p>a</p></main></div>", "a"), ("<div class='modal'><div role=main>a</div></div>", "a"),
    ("<article>a</article><aside><article>teaser</article></aside>", "a"), ("<form><p>f</p></form><article>a</article>", "a"),
    ("<main>a<div class=comments><article>c</article></div></main>", "a"), ("<article>a</article><form><article>b</article></form>", "a\nb")])
def test_wrappers_that_look_like_noise(page, text):
    assert read(page) == text


@pytest.mark.parametrize("page, text", [
    ("<article><figure><img><figcaption>cap</figcaption></figure><noscript>n</noscript><p>x <math><mi>a</mi><mo>=</mo><mn>1</mn></math> y", "cap\nn\nx a=1 y"),
    ("<article><svg class='icon'/><p>a</p><math/>b<svg><text>no</text></svg>c</article>", "a\nb\nc"),
    ("<article><div><svg><path></div><p>a</p><div><template>t</div><p>b</p></article>", "a\nb"),
    ("<head><title>t<body><p>a</p><div><iframe></div><p>b</p><div><textarea>t</div><iframe>x</iframe>c", "a\nb\nc"),
    ("<div>" * 600 + "<nav>n</nav><article><p>a</p></article></div><p>b</p><footer>f</footer>", "a\nb"),
    ("<main>" + "<section>" * 600 + "a" + "</section>" * 600 + "b</main><footer>f</footer>", "a\nb"),
    (f"<p>a</p><div title='{'<b> ' * 2_000}'>x</div>", "a\nx"), (f"<div data-x=\"{'>' * 9_000}\" class='sidebar'>x</div>y", "y")])
def test_article_content_and_parser_caps(page, text):
    assert read(page) == text


@pytest.mark.parametrize("page", ["<b\" \"" * 80_000, "<a \"<b' " * 60_000, "<li><ul>" + "<x>" * 50_000 + "<li></li>" * 20_000, "<title>" * 60_000,
                                  "<svg><iframe>" * 50_000, "<x>" * 50_000 + "</y>" * 50_000])
def test_hostile_quotes_and_nesting_take_linear_time(page):
    import time
    start = time.process_time()
    read(page)
    assert time.process_time() - start < 20


@pytest.mark.parametrize("page", ["<a" * 200_000, "<!" * 200_000, "<a '" * 100_000, "<x>" * 100_000, "<p>" + "<x>" * 50_000, "</script" * 100_000,
                                  "<script>" + "</script" * 100_000, "<div " + "a=b " * 100_000, "&" * 300_000, "<p>" * 100_000])
def test_markup_that_never_closes_takes_linear_time(page):
    import time
    start = time.process_time()
    read(page)
    assert time.process_time() - start < 20


def test_long_runs_of_signs():
    import time
    start = time.process_time()
    assert D.bare("((a" + "-" * 300_000 + "b))") == "a" + "-" * 300_000 + "b"
    assert D.bare("!" * 300_000) == "" and D.bare("+5%.") == "+5%" and D.bare("a!") == "a" and D.bare("$") == ""
    assert time.process_time() - start < 5


def test_style_tree_removes_what_repeats_without_any_role(spark):
    rows = [(i, f"http://site{i % 2}.org/{i}", f"<html><body><div><div class='k'><p>Home</p><p>About {i % 2}</p></div><div class='z'>"
             + "".join(f"<p>word{i} text{j} {i * j}</p>" for j in range(1 + i % 4)) + "</div><div class='q'><p>same line</p></div></div>")
            for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in S.main_text(pages).collect()}
    assert got == {i: "\n".join(f"word{i} text{j} {i * j}" for j in range(1 + i % 4)) for i in range(200)}


@pytest.mark.parametrize("name", ["post-comments", "entry-comments", "comment-content", "content-sidebar", "entry-footer", "post comments"])
def test_names_of_main_content_do_not_cancel_noise(name):
    assert read(f"<article><p>a</p><div class='{name}'>x</div></article>") == "a"


def test_branch_importance_mixes_own_and_children():
    nodes = {1: (0, 1.0, None), 2: (1, 0.0, 0.2), 3: (1, 1.0, 1.0)}
    got, low = S.branch_importance(nodes)
    assert low == {2}
    assert got[2] == pytest.approx(0.1 * 0 + 0.9 * 0.2) and got[3] == 1.0
    assert got[1] == pytest.approx((1 - 0.81) * 1.0 + 0.81 * (got[2] + got[3]) / 2)


def test_low_nodes_level_by_level_equal_the_tree(spark):
    import random
    rng, rows = random.Random(3), []
    for host in "ab":
        depth = {0: 0}
        for path in range(1, 120):
            parent = rng.choice([p for p in depth if depth[p] < 7])
            depth[path] = depth[parent] + 1
            rows.append((host, path, parent, depth[path], rng.choice([0.0, 0.1, 0.3, 1.0]), rng.choice([None, 0.0, 0.2, 1.0])))
    judged = spark.createDataFrame(rows, "host string, path long, parent long, depth int, presentation double, content double")
    got = {(r["host"], r["path"]) for r in S.low_nodes(judged).collect()}
    assert got == {(h, p) for h in "ab" for p in S.branch_importance({r[1]: (r[2], r[4], r[5]) for r in rows if r[0] == h})[1]} and got
    assert S._role(("h2", " id='my-section'"))[0] == "h2" and S._role(("div", " id='menu'"))[0] == "div.menu"


def test_odd_pages(spark):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "no host", "<p>a</p>", None), (2, "http://u:p@Host.org:80/x", "", "y"),
            (3, "http://h.org", "<p>" + "long " * 200_000 + "</p>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = S.main_text(pages).collect()
    assert sorted((str(r["page_id"]), len(r["text"])) for r in got) == [("1", 0), ("1", 0), ("2", 0), ("3", 999_999), ("None", 1)]
    assert S.main_text(pages.limit(0)).collect() == []
    assert S.host_of("http://u:p@Host.org:80/x") == "host.org" and S.host_of(None) == S.host_of("x") == ""


# ------------------------------------------------------------------ benchmark

ITEM = "A train leaves Boston at 60 km and Boston is 300 miles from Denver. How long until the train gets to Denver in total?"


def found(spark, texts, items=((1, ITEM),)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["new_values"]
            for r in D.contaminated(docs, spark.createDataFrame(list(items), "item_id long, text string")).collect()}


def test_reparameterised_questions_with_consistent_slots(spark):
    other = ITEM.replace("Boston", "Paris").replace("Denver", "Lyon").replace("60", "90").replace("300", "12")
    mixed = ITEM.replace("Boston", "Paris", 1).replace("Denver", "Lyon", 1)
    texts = [f"Some words first. {ITEM} And then more.", f"x y z {other} q r", f"a b c {mixed} d e f", "A train leaves the town. " * 20,
             ITEM[:len(ITEM) // 2], None, ""]
    assert found(spark, texts) == {(0, 1): False, (1, 1): True}


def test_copies_in_any_case(spark):
    texts = [f"Some words first. {ITEM.upper()} AND MORE.", f"in a lower-case text {ITEM.lower()} and more", f"mid-sentence {ITEM.title()} q r",
             f"x y {ITEM.upper().replace('TRAIN', 'BUS').replace('LONG', 'FAR').replace('DENVER', 'LYON')} z"]
    assert found(spark, texts) == {(0, 1): False, (1, 1): False, (2, 1): False}
    assert set(found(spark, [f"a b {ITEM} c", ITEM], [(1, ITEM.upper()), (2, ITEM.title())])) == {(d, i) for d in (0, 1) for i in (1, 2)}


def test_one_conflicting_slot_drops_its_windows_only(spark):
    long = ITEM + " Count 7 stops at first, then add the short break that every driver takes after lunch, and after 7 stops once more say what you found"
    edited = long[::-1].replace("7", "9", 1)[::-1]
    other = edited.replace("Boston", "Paris").replace("Denver", "Lyon").replace("60", "90").replace("300", "12")
    assert found(spark, [f"a b {edited} c", f"a b {other} c"], [(1, long)]) == {(0, 1): True, (1, 1): True}
    item = [(w, w, [f"0={v}"]) for w, v in enumerate("xyxzx")]
    assert D.aligned(item, [(w, w + 3, [f"0={v}"]) for w, v in enumerate("xyqzx")]) == (4, True)
    assert D.aligned(item, [(w, w + 3, [f"0={v}"]) for w, v in enumerate("pyqzp")]) == (4, True)


def test_verbatim_copies_of_items_with_few_typed_windows(spark):
    items = ["The Great Gatsby Meets Moby Dick On Mars", "WHICH RIVER IS LONGEST", "name three primes", "Alice has two red apples left",
             "地球から月までの距離は何キロですか", "月はどこ", "Sum these: 10 20 30 40 50 60 70"]
    texts = [f"some text in front 12 times {x} and some text after it" for x in items[:4]] + [
        f"これは前の文です{items[4]}そして後の文です", f"さて{items[5]}ですか", f"We had {items[6]} at last", "name three cities of primes"]
    assert set(found(spark, texts, list(enumerate(items)))) == {(i, i) for i in range(7)}


def test_short_items_odd_items_and_empty_tables(spark, odd_docs, no_docs):
    items = [(1, "tiny item"), (2, None), (3, ""), (None, "no id on this item at all here"), (4, "10 20 30 40 50 60"), (1, "tiny item")]
    got = found(spark, ["tiny item", "a tiny item", "Tiny item!", "no id on this item at all here", "10 20 30 40 50 60"], items)
    assert set(got) == {(0, 1), (2, 1), (3, None)}
    bench = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog near the river bank today.")], "item_id long, text string")
    ids = sorted(r["doc_id"] for r in D.contaminated(odd_docs, bench).collect())
    assert ids == [1, 2, 3]
    assert D.contaminated(no_docs, bench).collect() == [] and D.contaminated(odd_docs, bench.limit(0)).collect() == []


def brute_pairs(docs, items) -> set:
    """Pairs by windows of plain lower-case words: the test tables hold whole items, in no other wording."""
    out = set()
    for item, text in items:
        words = text.lower().split()
        windows = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
        for doc, body, *_ in docs:
            have = (body or "").lower().split()
            if windows and len(windows & {tuple(have[i:i + 5]) for i in range(len(have) - 4)}) >= 0.8 * len(windows):
                out.add((doc, item))
    return out


def test_op8_equals_brute_force(spark):
    items = duckdb.connect().sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_decontaminate"](spark, SF).collect()}
    expected = brute_pairs(documents(), items)
    assert expected and got == expected


def test_bloom_filters_pass_all_members(spark):
    import numpy as np
    values = [(1 << 63) - 1, -(1 << 63), -1, 0, 1, 123456789012345, -987654321]
    table = np.frombuffer(D._bloom(spark.createDataFrame([(v,) for v in values], "w long")), np.uint64)
    assert D._passes(table, np.array(values, np.int64).view(np.uint64)).all()
    assert not D._passes(table, np.arange(10, 5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).any()


# ------------------------------------------------------------------ pipeline

def test_each_stage_decides_as_its_operator(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    from loadlens.llm.common import stored
    stages = {n: f for n, f in corpus_pipeline.STAGES}
    one = stored(stages[names[0]](spark, docs, SF), "t")
    toxic = {r["doc_id"] for r in QUERIES["op1_toxicity"](spark, SF).where("predicted = 1").collect()}
    every = {r["doc_id"] for r in docs.select("doc_id").collect()}
    kept = {r["doc_id"] for r in one.select("doc_id").collect()}
    assert one.columns == docs.columns and kept == every - toxic
    two = stored(stages[names[1]](spark, one, SF), "t")
    from loadlens.llm.simhash import near_duplicates
    first = {r["component_id"] for r in near_duplicates(one).select("component_id").distinct().collect()}
    assert {r["doc_id"] for r in two.collect()} == first and two.count() == len(first)
    three = stored(stages[names[2]](spark, two, SF), "t")
    bad = {r["doc_id"] for r in D.contaminated(two, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert bad and {r["doc_id"] for r in three.collect()} == first - bad
    four = stored(stages[names[3]](spark, three, SF), "t")
    from loadlens.llm.mixing import mix
    copies = {r["id"]: r["copies"] for r in mix(three).where("copies > 0").collect()}
    assert four.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in four.groupBy("doc_id").count().collect()} == copies
    five = stages[names[4]](spark, four, SF).collect()
    assert len(five) == sum(copies.values())
    assert sorted(r["start"] for r in five)[0] == 0


def test_stages_take_odd_and_empty_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_TINY)
            assert docs.columns == odd_docs.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_TINY).collect()
    left = corpus_pipeline.STAGES[1][1](spark, odd_docs, SF_TINY).collect()
    assert sorted(r["doc_id"] for r in left if r["doc_id"] in (1, 2, 4, 5, 6)) == [1, 4]


def test_near_dedup_keeps_one_of_a_group_without_ids(spark):
    same = "The quick brown fox jumps over the lazy dog near the river bank today."
    other = "Entirely different words about mountains, sailing boats and old clocks in the town."
    rows = [(None, same), (None, same), (None, same), (None, other), (7, other), (7, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.STAGES[1][1](spark, docs, SF_TINY).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in left) == [("7", other), ("None", same)]


def test_registration():
    import __spark_entry__ as E
    assert {"pipeline", *QUERIES} <= set(E.queries()) and [int(n[2:].split("_")[0]) for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))


@pytest.mark.parametrize("name", ["op2_exact_topk", "op5_mixing"])
def test_sql_gives_the_same_rows(spark, name):
    from loadlens.llm.queries import SQL
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(SQL[name])
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    assert sorted(repr(tuple(r[c] for c in cols)) for r in df.collect()) == sorted(repr(r) for r in rel.select(*cols).fetchall())
