"""Training-data operators against brute force on small, awkward tables."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeward.llm import (adaptive_rules, column_bwt, components, odd_sketch, rule_ensemble, seed_extend, simhash_windows,
                          site_style, tier_packing, tool_calls, url_cascade)

WORD = re.compile("[^\x20\x09-\x0d]+")
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, ctx string, anchor string, component string, rep int, spans string"


def passage(seed, n):
    rng = np.random.default_rng(seed)
    return [f"w{int(x)}" for x in rng.integers(0, 400, n)]


def texts():
    a, b = passage(1, 120), passage(2, 90)
    near = a.copy()
    near[7], near[70] = "other", "words"
    shared = passage(3, 45)
    return [
        (1, " ".join(a)), (2, " ".join(a)), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "One"),
        (9, " ".join(passage(4, 30) + shared + passage(5, 30))), (10, "\n".join(passage(6, 20) + shared + passage(7, 300))),
        (11, " ".join(shared[5:40]) + " é日本 end"), (12, " ".join(["same"] * 80)), (13, " ".join(b) + "\r\n" + " ".join(b)),
        (14, "x" * 5000), (15, "y" + "x" * 4000), (16, " ".join(passage(8, 40_000))), (16, " ".join(passage(8, 40_000))), (17, "A b"), (18, "a B c"),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, ties, a row given twice and columns whose names the operators use themselves."""
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", len(t or ""), "c", "a", "k", 1, "s") for i, t in texts()]
    return spark.createDataFrame(rows, DDL).repartition(3, "source", "n_chars")


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DDL)


def distinct_texts():
    return dict(sorted(texts()))


def rows(df, key="doc_id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r)
    return out


# --- words and hashes -----------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t\x0b\x1c 日", max_size=30), min_size=1, max_size=8))
def test_words_equal_the_pattern(parts):
    import pyarrow as pa

    from lakeward.llm.textkit import hash_words, slices, words
    (_, data, off), = slices(pa.RecordBatch.from_arrays([pa.array(parts, pa.string())], ["text"]))
    starts, ends, first = words(data, off)
    raw, seen = data.tobytes(), {}
    for i, t in enumerate(parts):
        assert [raw[a:b].decode() for a, b in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]])] == WORD.findall(t)
    for h, a, b in zip(hash_words(data, starts, ends).tolist(), starts, ends):
        assert seen.setdefault(h, raw[a:b]) == raw[a:b]


def test_winnowing_depends_on_the_window_alone():
    from lakeward.llm.textkit import mix, winnow
    x = mix(np.random.default_rng(0).integers(0, 4, 400).astype(np.uint64))
    at = np.arange(0, 380)
    got = winnow(x, at, 17) - at
    by = {}
    for i, g in zip(at, got):
        assert by.setdefault(tuple(x[i:i + 17]), g) == g
        assert x[i + g] >> np.uint64(24) == (x[i:i + 17] >> np.uint64(24)).min()


# --- 1 ----------------------------------------------------------------------

def test_urls(spark):
    urls = [None, "", "no-scheme.org/x", "http://", "https://A.Example.ORG/en/12?x", "http://example.org", "http://org/", "ftp://x.com/de/a#b",
            "http://badexample.org/es/1", "http://a.example.org/es/1", "http://x.com?/fr/", "http://x.com/fr/://y", "http://x.com/fr/://y"]
    table = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id bigint, url string, key string")
    rules = spark.createDataFrame(table, "host string, path string, verdict string")

    def expected(url):
        if url is None or "://" not in url:
            return "", "", None, "allow"
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = host.lower()
        fits = [(h + p, v) for h, p, v in table if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, *(max(fits, key=lambda f: len(f[0])) if fits else (None, "allow"))

    for limit in (url_cascade.MAX_KEYS, 0):                 # filters, and the join for lists beyond the limit
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_cascade.judge_urls(pages, rules, max_keys=limit).collect()}
        assert got == {i: expected(u) for i, u in enumerate(urls)}
    assert url_cascade.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_cascade.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.filter("substr(key, 2) % 7 = 0")
    levels = url_cascade.build_cascade(listed, listed.count(), universe, 3000)
    assert len(levels) > 1
    wrong = universe.filter(url_cascade.listed_by(levels, F.col("key")) != (F.expr("substr(key, 2) % 7 = 0")))
    assert wrong.count() == 0


# --- 2 ----------------------------------------------------------------------

def test_page_text(spark):
    page = ('<html><head><title>T</title><style>p{}</style></head><body><nav><a>Menu</a></nav><div class="cookie-notice">We use</div>'
            '<article><h1>Title &amp; more</h1><p><b>First\n  line<br>goes&nbsp;on<p>Second <i>one</i><script>var x="</p>"</script>'
            '<form>Name <input></form><aside>See also</aside><div class="comments"><p>nice</p></div></article><footer>(c)</footer>')
    assert site_style.text_of(page, frozenset()) == "Title & more\n\nFirst line goes on\n\nSecond one"
    assert site_style.text_of("<p>a<p>b</div> c", frozenset()) == "a\n\nb c"
    plain = [(i, "http://h.x/a", f"<body><div class='top'>Same bar</div><p>Text number {i} of the page</p></body>", "c") for i in range(12)]
    odd = [(100, None, None, "c"), (101, "http://h.y/", "", "c"), (102, "http://h.z/", "<p>alone</p>", "c"), (102, "http://h.z/", "<p>alone</p>", "c")]
    pages = spark.createDataFrame(plain + odd, "page_id bigint, url string, html string, path string")
    got = rows(site_style.extract_text(pages), "page_id")
    assert all(got[i][0].text == f"Text number {i} of the page" for i in range(12))      # the bar goes by its importance
    assert [got[i][0].text for i in (100, 101, 102)] == ["", "", "alone"] and len(got[102]) == 2
    assert site_style.extract_text(pages.limit(0)).count() == 0


def page_texts(spark, pages):
    table = spark.createDataFrame([(i, url, html) for i, (url, html) in enumerate(pages)], "page_id bigint, url string, html string")
    return [r.text for r in site_style.extract_text(table).orderBy("page_id").collect()]


def test_template_blocks_do_not_take_their_branch_along(spark):
    bar = "".join(f"<div class='link'>Link {k}</div>" for k in range(50))
    own = [[f"Paragraph {k} of page {i}" for k in range(10)] for i in range(100)]
    pages = [("http://h.a/x", f"<html><body><div class='top'>{bar}</div>{''.join(f'<p>{p}</p>' for p in own[i])}</body></html>") for i in range(100)]
    assert page_texts(spark, pages) == ["\n\n".join(p) for p in own]
    # the same with the paragraphs' own style
    mixed = [("http://h.a/x", html.replace("<div class='link'>", "<p>").replace("</div>", "</p>")) for _, html in pages]
    assert all(text.endswith("\n\n".join(p)) for text, p in zip(page_texts(spark, mixed), own))


def test_copies_of_an_article_are_no_template(spark):
    loose = [(f"http://h.b/x?v={i}", f"<body><div class='ad'>Buy {i}</div><div class='text'><p>One</p><p>Two</p></div></body>") for i in range(20)]
    framed = [(f"http://h.c/x?v={i}", f"<body><div class='tip'>Tip {i}</div><article><p>One</p><p>Two</p></article></body>") for i in range(20)]
    assert page_texts(spark, loose + framed) == ["One\n\nTwo"] * 40


@pytest.mark.parametrize("attrs", ["class='content has-sidebar'", "id='main' class='no-sidebar'", "class='with-header'", "class='single-column-form'",
                                   "class='page-menu-open'", "class='comments-off'", "class='login'"])
def test_state_names_rule_out_no_article(attrs):
    for head in ("<h1>Title</h1>", "<article><h1>Title</h1></article>"):
        page = f"<body><div class='site-menu'><p>Home</p></div><div {attrs}>{head}<p>Text</p></div><div class='main-footer'>(c)</div></body>"
        assert site_style.text_of(page.replace("</article><p>Text</p>", "<p>Text</p></article>"), frozenset()) == "Title\n\nText"
        assert site_style.text_of(page.replace("</article><p>Text</p>", "<p>Text</p></article>").replace("div", "x-box"), frozenset()).endswith("Text")
    if "login" not in attrs:
        assert site_style.text_of(f"<body><div {attrs}><p>Text</p></div></body>", frozenset()) == "Text"


def test_title_in_a_named_heading_stays():
    assert site_style.text_of("<header><h1>Site</h1></header><div class='login'><h1 class='page-header'>Title</h1><p>Text</p></div>", frozenset()) == "Title\n\nText"


def test_names_still_rule_out_what_is_beside_the_article():
    beside = "<div class='comments'><article class='comment'><p>Nice</p></article></div><div class='related'><article><h1>Other</h1></article></div>"
    assert site_style.text_of(f"<body><article><h1>Title</h1><p>Text</p></article>{beside}</body>", frozenset()) == "Title\n\nText"
    assert "Text" in site_style.text_of(f"<body><h1>Title</h1><p>Text</p>{beside}</body>", frozenset())


# --- 3 ----------------------------------------------------------------------

def base(text):
    text = text or ""
    w = WORD.findall(text)
    tri = list(zip(w, w[1:], w[2:]))
    hit = {i + j for i, t in enumerate(tri) if tri.count(t) > 1 for j in range(3)} if len(tri) < 2000 else set()
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_quality_statistics(spark, docs, no_docs):
    extra = [(30, "a|b #x\na|b #x\n\n \n<>é", "en", "s0", 0), (None, "no id", None, None, 0)]
    table = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame(extra, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    got = rows(adaptive_rules.judge(table))
    want = {**distinct_texts(), 30: extra[0][1], None: "no id"}
    for i, t in want.items():
        for r in got[i]:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == base(t)[:4]
            if r.n_words < 2000:
                assert r.n_repeat_words == base(t)[4]
            assert not (r.base_failed and r.kept)
    assert len(got[16]) == 2 and adaptive_rules.judge(no_docs).count() == 0


def test_adaptive_fence_rejects_an_outlier(spark):
    clean = [(i, " ".join(passage(100 + i, 80)), "en", "s") for i in range(60)]
    noisy = [(900, " ".join(w + "###" for w in passage(900, 80)), "en", "s")]
    got = rows(adaptive_rules.judge(spark.createDataFrame(clean + noisy, "doc_id bigint, text string, lang string, source string")))
    assert all(got[i][0].kept for i in range(60)) and not got[900][0].kept


@pytest.mark.parametrize("share", [30, 60, 100])
def test_a_source_full_of_junk_has_no_fence_of_its_own(spark, share):
    clean = [(1000 * s + i, 0, 100, 0, 0, 0, "en", f"s{s}", False) for s in range(3) for i in range(40)]
    # a hot source with most of the rows; symbol shares of junk as in the given tables
    hot = [(9000 + i, 0, 1000, (100, 125, 310, 385)[i % 4] if i % 100 < share else 0, 0, 0, "en", "hot", False) for i in range(800)]
    stats = spark.createDataFrame(clean + hot, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                                               "n_repeat_words bigint, lang string, source string, base_failed boolean")
    cells = adaptive_rules.sketches(stats)
    assert all(20 <= r.fence < 100 for r in adaptive_rules.fences(cells).filter("ratio = 'symbols'").collect())
    if share < 50:                                         # a table of that source alone
        alone = adaptive_rules.fences(cells.filter("source = 'hot' and ratio = 'symbols'")).collect()
        assert len(alone) == 1 and alone[0].fence < 100


def test_sketches_merge_by_adding(spark, docs):
    stats = adaptive_rules.base_statistics(docs)
    whole = adaptive_rules.sketches(stats)
    parts = adaptive_rules.sketches(stats.filter("doc_id % 2 = 0")).unionByName(adaptive_rules.sketches(stats.filter("doc_id % 2 = 1")))
    merged = parts.groupBy("lang", "source", "ratio", "step").agg(F.sum("n").alias("n"))
    assert sorted(map(str, whole.collect())) == sorted(map(str, merged.collect()))


# --- 4 ----------------------------------------------------------------------

def shingles(text, k):
    w = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(by_id, k, percent):
    sets, low = {i: shingles(t, k) for i, t in by_id.items()}, {i: i for i in by_id}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            low[max(x, y)] = min(x, y)
    return {i: find(i) for i in by_id}, sets


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, docs, no_docs, k):
    comp, sets = brute_components(distinct_texts(), k, 80)
    got = rows(odd_sketch.near_duplicates(docs, k, 80))
    for i, c in comp.items():
        for r in got[i]:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[i]), c, c == i)
    assert len(got[16]) == 2 and odd_sketch.near_duplicates(no_docs).count() == 0


def test_chains_of_near_copies_in_crowded_buckets(spark, monkeypatch):
    """Links between copies that are far from the bucket's smallest; blocks smaller than the bucket."""
    monkeypatch.setattr(odd_sketch, "BLOCK", 7)
    rng, base_words = np.random.default_rng(5), passage(50, 100)
    table = {}
    for i in range(60):
        w = base_words.copy()
        for j in rng.choice(100, int(rng.integers(2, 9)), replace=False):
            w[j] = f"e{i}_{j}"
        table[i] = " ".join(w)
    comp, _ = brute_components(table, 2, 80)
    assert 1 < len(set(comp.values())) < 60
    got = rows(odd_sketch.near_duplicates(spark.createDataFrame(sorted(table.items()), "doc_id bigint, text string"), 2, 80))
    assert {i: r[0].component_id for i, r in got.items()} == comp


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(500, 501), (502, 501), (500, 501)], "a bigint, b bigint"))
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500, 502: 500}


# --- 5 ----------------------------------------------------------------------

def test_tool_calls(spark):
    calls = [(1, "a", None, 0, "search", '{"query":"x","turn":1}'), (1, "b", "a", 2, "search", '{"turn":"two","query":"y"}'), (1, "c", "b", 4, "free", '{"z":1,"a":{"k":2,"b":null}}'),
             (1, "c", "b", 6, "free", "{}"), (2, "a", "gone", 0, "search", "no json"), (3, "x", "y", 0, "free", "{}"), (3, "y", "x", 1, "free", "[1]"),
             (None, "n", None, 0, "free", "{}"), (4, None, None, 0, None, None)] + [(9, f"k{i}", f"k{i - 1}" if i else None, i, "free", "{}") for i in range(37)]
    results = [(1, "a", 1, "res"), (1, "a", 3, "again"), (7, "q", 1, "lost"), (2, "a", 1, None)]
    schemas = [("search", "query", "string", True), ("search", "turn", "integer", True)]
    c = spark.createDataFrame([(*x, "clash") for x in calls], "conv_id bigint, call_id string, parent_id string, turn bigint, name string, arguments string, depth string")
    r = spark.createDataFrame(results, "conv_id bigint, call_id string, turn bigint, content string")
    s = spark.createDataFrame(schemas, "name string, argument string, type string, required boolean")
    got = tool_calls.link_calls(c, r, s).collect()
    by = {(x.conv_id, x.call_id, x.status): x for x in got}
    assert len(got) == len(calls) + 2          # a result without a call, a second result
    assert by[1, "a", "linked"].json == '{"arguments":{"query":"x","turn":1},"id":"a","name":"search","result":"res"}'
    assert by[1, "a", "linked"].n_results == 2 and by[1, "a", "linked"].args_valid
    assert not by[1, "b", "no_result"].args_valid and by[1, "b", "no_result"].depth == 1
    assert by[1, "c", "no_result"].json.startswith('{"arguments":{"a":{"b":null,"k":2},"z":1},') and (1, "c", "duplicate") in by
    assert by[2, "a", "linked"].depth == 0 and not by[2, "a", "linked"].args_valid
    assert by[3, "x", "no_result"].depth is None and not by[3, "y", "no_result"].args_valid
    assert (7, "q", "no_call") in by and [by[9, f"k{i}", "no_result"].depth for i in range(37)] == list(range(37))
    assert tool_calls.link_calls(c.limit(0), r.limit(0), s).count() == 0


def test_tool_calls_lose_no_text(spark):
    long_number, twice = '{"n":' + "7" * 50 + "}", '{"a":1,"a":2}'
    calls = ([(1, "a", None, t, n, a) for t, n, a in ((0, "f", "{}"), (0, "f", "{}"), (0, "f", "{}"), (4, "g", '{"later":1}'), (4, None, None))]
             + [(2, "b", None, 0, "f", long_number), (2, "c", None, 0, "f", twice), (2, "d", None, 0, "f", "no json")])
    results = [(1, "a", 1, "one"), (1, "a", 1, "one"), (1, "a", 2, "two"), (1, "a", None, None), (5, "q", 1, "x"), (5, "q", 1, "y"), (None, "q", 1, "z")]
    c = spark.createDataFrame(calls, "conv_id bigint, call_id string, parent_id string, turn bigint, name string, arguments string")
    r = spark.createDataFrame(results, "conv_id bigint, call_id string, turn bigint, content string")
    s = spark.createDataFrame([], "name string, argument string, type string, required boolean")
    got = tool_calls.link_calls(c, r, s).collect()
    is_call = lambda x: x.status in ("linked", "no_result", "duplicate")
    assert sorted((x.conv_id, x.call_id, x.turn, x.name, x.arguments) for x in got if is_call(x) and x.conv_id == 2) == \
        sorted((v, k, t, n, a) for v, k, _, t, n, a in calls if v == 2)
    of_a = [x for x in got if x.call_id == "a"]
    assert sorted(((x.turn, x.name, x.arguments) for x in of_a if is_call(x)), key=str) == sorted(((t, n, a) for v, k, _, t, n, a in calls if k == "a"), key=str)
    assert sorted(((x.content or "") for x in of_a if x.status in ("linked", "extra_result"))) == ["", "one", "one", "two"]
    assert [x.n_results for x in of_a if x.status == "linked"] == [4]
    assert sorted((x.status, x.content) for x in got if x.call_id == "q") == [("extra_result", "y"), ("no_call", "x"), ("no_call", "z")]


# --- 6 ----------------------------------------------------------------------

def test_rule_ensemble_on_held_out_rows(spark):
    table = [(i, (" ".join(w + ("$$$" if i % 5 == 0 else "") for w in passage(i, 60))), i) for i in range(400)]
    docs = spark.createDataFrame(table + [(1000, None, 0), (1001, "", 0)], "doc_id bigint, text string, symbols bigint")
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(300)] + [(7, 1), (8, None), (None, 1)], "doc_id bigint, label int")
    ensemble = rule_ensemble.fit(docs, labels)
    got = rows(rule_ensemble.score(docs, ensemble))
    held = [int((got[i][0].score >= 0.7) == (i % 5 != 0)) for i in range(300, 400)]
    assert sum(held) >= 98 and all(0 <= r[0].score <= 1 for r in got.values()) and got[5][0].symbols == 5
    assert rule_ensemble.fit(docs, labels.limit(0)).rules == ()
    assert rule_ensemble.score(docs.limit(0), ensemble).count() == 0


# --- 7 ----------------------------------------------------------------------

def test_contaminated_windows(spark, docs, no_docs):
    item = passage(3, 45)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "w1 w2"), (5, " ".join(passage(77, 40))), (5, " ".join(passage(77, 40)))], "item_id bigint, text string")
    edited = passage(20, 50) + item[:20] + ["new"] + item[21:] + passage(21, 50)
    far = passage(22, 50) + item[:20] + passage(23, 50)
    more = spark.createDataFrame([(40, " ".join(edited).upper()), (41, " ".join(far)), (42, "W1, W2!")], "doc_id bigint, text string")
    table = docs.select("doc_id", "text").unionByName(more)
    got = {(r.doc_id, r.item_id) for r in simhash_windows.contaminated(table, bench).collect()}

    def shingle_list(w, k=5):
        return [tuple(w[i:i + k]) for i in range(max(1, len(w) - min(k, len(w)) + 1))] if len(w) >= k else [tuple(w)]
    from collections import Counter
    want, fold = set(), lambda t: WORD.findall(re.sub(r"[!-/:-@\[-`{-~]", " ", (t or "")).translate({i: i + 32 for i in range(65, 91)}))
    for i, t in {**distinct_texts(), 40: " ".join(edited).upper(), 41: " ".join(far), 42: "W1, W2!"}.items():
        w = fold(t)
        if len(w) > 3000:
            continue
        for k, own in ((1, item), (4, ["w1", "w2"]), (5, passage(77, 40))):
            a = Counter(shingle_list(own))
            for s in range(max(1, len(w) - len(own) + 1)):
                b = Counter(shingle_list(w[s:s + len(own)])) if w else Counter()
                if b and 100 * (a & b).total() >= 80 * (a | b).total():
                    want.add((i, k))
    assert {g for g in got if g[0] != 16} == want and (9, 1) in want and (10, 1) in want and (42, 4) in want and (41, 1) not in want
    assert simhash_windows.contaminated(no_docs, bench).count() == 0 and simhash_windows.contaminated(docs, bench.limit(0)).count() == 0
    assert simhash_windows.contaminated(docs, bench, part_words=10).select("doc_id", "item_id").distinct().count() == len({g for g in got if g[0] < 40})


def test_windows_between_aligned_ones_are_found(spark):
    from collections import Counter

    item = [f"w{i}" for i in range(100)]
    edited = ["a0", "a1"] + item[2:50] + [f"in{i}" for i in range(5)] + item[50:98] + ["b0", "b1"]
    short = item[:95]
    texts_ = {1: edited, 2: passage(90, 30) + edited + passage(91, 30), 3: short, 4: item[:70], 5: passage(92, 9) + item + item, 6: item[::-1]}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts_.items()], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item[20:60]))], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id, r.start) for r in simhash_windows.contaminated(docs, bench).collect()}
    want = set()
    for d, w in texts_.items():
        for k, own in ((1, item), (2, item[20:60])):
            a = Counter(zip(*(own[j:] for j in range(5))))
            for s in range(max(1, len(w) - len(own) + 1)):
                b = Counter(zip(*(w[s:s + len(own)][j:] for j in range(5))))
                if 100 * (a & b).total() >= 80 * (a | b).total():
                    want.add((d, k, s))
    assert got == want and {s for d, k, s in got if (d, k) == (1, 1)} >= {2, 3} and (3, 1, 0) in got


def test_a_part_of_the_benchmark_is_used_before_the_next_is_built(spark, monkeypatch):
    seen, table, windows = [], simhash_windows._table, simhash_windows._windows
    monkeypatch.setattr(simhash_windows, "_table", lambda *a: seen.append("built") or table(*a))
    monkeypatch.setattr(simhash_windows, "_windows", lambda *a: seen.append("used") or windows(*a))
    items = [passage(400 + i, 20) for i in range(3)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string")
    got = simhash_windows.contaminated(docs, bench, part_words=20)
    assert seen == ["built", "used"] * 3 and {(r.doc_id, r.item_id) for r in got.collect()} == {(i, i) for i in range(3)}


def test_blocks_agree_within_the_radius():
    blocks = simhash_windows._blocks(simhash_windows.RADIUS)
    assert len(blocks) == simhash_windows.RADIUS + 1 and sum(w for _, w in blocks) == 64 and all(w > 0 for _, w in blocks)


# --- 8 and 9 ------------------------------------------------------------------

def test_repeated_words_go(spark, docs, no_docs):
    seen, want = set(), {}
    for i, t in distinct_texts().items():
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for p in range(len(w) - 19):
            key = tuple(w[p:p + 20])
            if key in seen:
                gone[p:p + 20] = [True] * 20
            seen.add(key)
        want[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    got = rows(seed_extend.remove_repeats(docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("bigint")))))
    assert {i: (r[0].n_words, r[0].n_removed, r[0].kept_text) for i, r in got.items() if i is not None} == want
    assert got[None][0].n_removed == 0 and len(got[16]) == 2 and got[16][0] == got[16][1]
    assert want[2][1] == 120 and want[10][1] >= 45 and seed_extend.remove_repeats(no_docs).count() == 0


def brute_bytes(by_id, length):
    seen, want = {}, {}
    for i, t in sorted(by_id.items()):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen.setdefault(b[p:p + length], i) != i:
                gone[p:p + length] = b"\x01" * length
        want[i] = (len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), bytes(x for x, g in zip(b, gone) if not g))
    return want


@pytest.mark.parametrize("slab", [column_bwt.SLAB, 1])
def test_shared_bytes_go(docs, no_docs, slab):
    """Through the transform, and with every anchor beyond the slab through window hashes."""
    want = brute_bytes(distinct_texts(), 50)
    got = rows(column_bwt.remove_shared_bytes(docs, slab=slab))
    assert {i: (r[0].n_bytes, r[0].n_removed, r[0].n_spans, bytes(r[0].kept)) for i, r in got.items()} == want
    assert want[15][1] == 4000 and want[14][1] == 0 and len(got[16]) == 2
    assert column_bwt.remove_shared_bytes(no_docs).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=24).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=1, max_size=12))
def test_transform_orders_all_suffixes(pieces):
    owner, off, lcp = column_bwt.column_wise(pieces, 50)
    got = [pieces[o][a:] for o, a in zip(owner, off)]
    assert got == sorted(got) and len(got) == sum(map(len, pieces)) + len(pieces)
    for i in range(1, len(got)):
        n = next((k for k, (x, y) in enumerate(zip(got[i - 1], got[i])) if x != y), min(len(got[i - 1]), len(got[i])))
        assert lcp[i] == min(n, 50)


# --- 10 -----------------------------------------------------------------------

def test_packing_round_trip(spark, docs, no_docs):
    tokenizers = pytest.importorskip("tokenizers")
    P = pytest.importorskip("public_tokenizers")
    path = P.path("word_bpe_49k.json")
    tok = tokenizers.Tokenizer.from_file(path)
    odd = [(50, "I'll don't 12 ÀÉ ß× <|endoftext|> Å é \x00 tab wide Σας ΌΔΟΣ 日本語 ﬁ 'S"), (None, "null id")]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"))
    got = tier_packing.pack_documents(table, path, buffer_tokens=4000).collect()
    by, sequences = {}, {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for i, t in {**distinct_texts(), **dict(odd)}.items():
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes()
        own = sorted(by[i], key=lambda r: (r.start, r.sequence_id))
        copies = 2 if i == 16 else 1
        assert sum(r.length for r in own) * 4 == copies * len(ids) and all(r.doc_tokens * 4 == len(ids) for r in own)
        assert all(bytes(r.ids) == ids[4 * r.start:4 * (r.start + r.length)] for r in own)
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
        total = sum(n for _, n in own)
        assert total <= 2048 and total & (total - 1) == 0                # full windows and power-of-two rests: no padding
    assert tier_packing.pack_documents(no_docs, path).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5000), max_size=40), st.booleans())
def test_pack_places_every_token_once(sizes, last):
    windows, left = tier_packing.pack(sizes, tier_packing.TIERS, last)
    cover = [np.zeros(n, dtype=int) for n in sizes]
    for tier, window in windows:
        assert sum(n for _, _, n in window) == tier
        for i, s, n in window:
            cover[i][s:s + n] += 1
    for i, s, n in left:
        cover[i][s:s + n] += 1
    assert all((c == 1).all() for c in cover) and not (last and left)


# --- the pipeline ---------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    words_ = passage(3, 45)
    table = [(i, " ".join(passage(200 + i, 90)), "en", "s", 0, "x") for i in range(30)]
    table += [(40, table[3][1], "en", "s", 0, "x"), (41, " ".join(passage(300, 60) + WORD.findall(table[4][1])[10:60]), "en", "s", 0, "x"),
              (42, " ".join(passage(301, 60) + words_ + passage(302, 60)), "en", "s", 0, "x"), (43, "short", "en", "s", 0, "x"), (44, None, None, None, None, "x"),
              (45, " ".join(w + "###" for w in passage(303, 80)), "en", "s", 0, "x")]
    sf = tmp_path.as_uri()
    spark.createDataFrame(table, "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, " ".join(words_))], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf).cache()
        seen[name] = {r.doc_id for r in docs.collect()}
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "substring dedup":
            assert len(WORD.findall(docs.filter("doc_id = 41").first().text)) == 60
            assert docs.filter("doc_id = 4").first().text == table[4][1]
    clean = set(range(30))
    assert seen["quality rules"] == clean | {40, 41, 42}
    assert seen["near duplicates"] == seen["substring dedup"] == clean | {41, 42}
    assert seen["decontamination"] == seen["packing"] == clean | {41}
    empty = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, sf)
        assert out.count() == 0
