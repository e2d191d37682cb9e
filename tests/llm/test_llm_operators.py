"""Operators against plain Python on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, html_extract, mixing, ngram_join, quality_ranker, quality_rules, quotation, sharding, toxicity, url_filter
from ledgerline.llm.text_stats import FEATURES, with_counts

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = ", score double, shard int, slot bigint, size bigint, verdict string, held_out int, n_words int, digest string, src int"


def docs(spark, texts, extra=False, sources=None):
    rows = [(i, t, "en", (sources or ["a"])[i % len(sources or ["a"])], len(t or "")) for i, t in enumerate(texts)]
    if extra:
        return spark.createDataFrame([(*r, 0.0, 1, 1, 1, "x", 1, 1, "d", 1) for r in rows], DOCS + EXTRA)
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " \n\t ", "one", "Éa b\u00a0c\x0bd", "w " * 30_000, "the same text twice here", "the same text twice here", "***", "a,b;c d\n\nd\nd"]


# --- counts ---------------------------------------------------------------------------------------------------------


def plain_counts(t):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    on = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(on))


def test_counts(spark):
    texts = ODD + ["a b c d e f a b c d e g a b c d e", "x x x x x x x", "a b c d e a b c d e f g h i j", "l1\nl2\nl1\n \n \nl1 ", "€uro 😀 #tag|<b>&"]
    made = with_counts(docs(spark, texts))
    for r in made.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(texts[r.doc_id]), texts[r.doc_id] and texts[r.doc_id][:40]


# --- 1 and 6: quality -----------------------------------------------------------------------------------------------


def labelled(spark, bad):
    good = [f"Plain words of text number {i} with some commas, and stops. More words follow here {i * 7}." for i in range(60)]
    texts = good + [bad(i) for i in range(30)]
    labels = spark.createDataFrame([(i, int(i < 60), int(i >= 60)) for i in range(90)], "doc_id bigint, quality int, toxic int")
    return docs(spark, texts, extra=True), labels, texts


def test_ranker_and_rules_tell_junk_apart(spark):
    rows, labels, _ = labelled(spark, lambda i: f"$$$ WORDS### {i} " * 2 + "&&& %%% LOUD!! ||| *** junk")
    ranker = quality_ranker.train_ranker(rows, labels)
    scored = {r.doc_id: r for r in quality_ranker.score_quality(rows, ranker).collect()}
    assert all(scored[i].predicted == int(i < 60) and 0 <= scored[i].score <= 1 for i in range(90))
    assert {r.held_out for r in scored.values() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1} == {True}
    rules = quality_rules.train_rules(rows, labels)
    judged = {r.doc_id: r for r in quality_rules.judge_quality(rows, rules).collect()}
    assert rules and all(judged[i].kept == (i < 60) for i in range(90))


def test_quality_on_odd_texts_and_without_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(0, 1, 0), (None, 0, 0), (2, None, None)], "doc_id bigint, quality int, toxic int")
    for rows in (docs(spark, ODD, extra=True), docs(spark, [])):
        for labels in (none, one):
            assert quality_ranker.train_ranker(rows, labels) is None and quality_rules.train_rules(rows, labels) == ()
        scored = quality_ranker.score_quality(rows, None).collect()
        judged = quality_rules.judge_quality(rows, ()).collect()
        assert len(scored) == len(judged) == rows.count()
        assert all(r.predicted == 1 and r.score == 0.5 for r in scored)
        assert all(r.kept == (not r.base_failed) and r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in judged)
    rows = docs(spark, ODD)
    ranker = quality_ranker.Ranker((0.0,) * len(FEATURES), (1.0,) * len(FEATURES), (-1.0,) * len(FEATURES), 0.0, 1.0)
    assert all(0 <= r.score <= 1 for r in quality_ranker.score_quality(rows, ranker).collect())


def test_only_labels_that_may_be_learnt_from_are_read(spark):
    rows, labels, _ = labelled(spark, lambda i: "junk $$$ ||| " + str(i))
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality_ranker.train_ranker(rows, labels) == quality_ranker.train_ranker(rows, flipped)
    assert quality_rules.train_rules(rows, labels) == quality_rules.train_rules(rows, flipped)


# --- 2: quotations --------------------------------------------------------------------------------------------------

MESSAGES = "conv_id bigint, turn bigint, role string, text string"


def test_quotes_are_linked_and_ordered(spark):
    rows = [
        (1, 0, "u", "Hello there.\nHow are you?"), (1, 1, "a", "> How are you?\nFine, thanks."), (1, 2, "u", ">> How are you?\n> Fine, thanks.\nGood."), (1, 3, "u", "New topic"),
        (1, 4, "a", "> hello THERE\nhi"), (1, 4, "a", "> hello THERE\nhi"), (1, 5, "u", "> > nested only: new topic"), (2, 0, "u", None), (2, 1, "a", "> from elsewhere\n"), (None, 1, "a", "> x"), (2, None, "u", "x"), (3, 7, "u", "> New topic\nx"),
    ]
    got = quotation.link_quotes(spark.createDataFrame(rows, MESSAGES)).collect()
    assert len(got) == len(rows)
    first = {(r.conv_id, r.turn): r for r in got}
    assert {t: first[1, t].parent_turn for t in range(6)} == {0: None, 1: 0, 2: 1, 3: None, 4: 0, 5: None}
    assert [r.turn for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)] == [0, 1, 4, 4, 2, 3, 5]
    assert (first[1, 2].depth, first[1, 2].thread_turn, first[1, 2].text, first[1, 2].n_quotes) == (2, 0, "Good.", 2)
    assert first[3, 7].parent_turn is None and first[2, 0].text == ""


def test_long_reply_chain_and_common_passage(spark):
    chain = [(1, 0, "u", "message number 0")] + [(1, t, "u", f"> message number {t - 1}\nmessage number {t}") for t in range(1, 40)]
    common = [(2, t, "u", "> ok\nok") for t in range(3000)]
    got = quotation.link_quotes(spark.createDataFrame(chain + common, MESSAGES))
    assert {r.turn: r.depth for r in got.where("conv_id = 1").collect()} == {t: t for t in range(40)}
    parents = {r.turn: r.parent_turn for r in got.where("conv_id = 2").collect()}
    assert parents == {t: t - 1 if t else None for t in range(3000)}
    assert sorted(r.position for r in got.where("conv_id = 2").collect()) == list(range(3000))


def plain_threads(rows):
    """conv, turn -> (parent, thread, depth, own text) by searching every earlier message for every passage."""
    space, norm = " \t\n\x0b\x0c\r", lambda x: " ".join(re.findall(r"[^\W_]+", x.lower()))

    def parse(text):
        runs = []
        for line in re.split(r"\r?\n", text or ""):
            mark = re.match(r"[ \t>]*>", line)
            level = mark[0].count(">") if mark else 0
            if not runs or runs[-1][0] != level:
                runs.append((level, [], []))
            runs[-1][1].append(line[mark.end() :].strip(" ") if mark else line.strip(" "))
            runs[-1][2].append(line)
        return runs if text is not None else []

    def keys(whole, lines):
        return {x for x in (norm(whole), *map(norm, re.split(r"\n[ \t\r\n]*\n[ \t]*", whole)), *map(norm, lines)) if x}

    own, out = defaultdict(set), {}
    parsed = [(c, t, parse(x)) for c, t, _, x in rows]
    texts = {}
    for c, t, runs in parsed:
        mine = "\n".join(x for level, _, raw in runs if level == 0 for x in raw).strip(space)
        texts[c, t] = mine
        if c is not None and t is not None:
            own[c, t] |= keys(mine, re.split(r"\r?\n", mine))
    for c, t in {(c, t) for c, t, _ in parsed if c is not None and t is not None}:
        chars = Counter()
        for _, _, runs in (p for p in parsed if p[:2] == (c, t)):
            for level, lines, _ in runs:
                for k in keys("\n".join(lines), lines) if level else ():
                    held = [u for d, u in own if d == c and u < t and k in own[d, u]]
                    if held:
                        chars[level, max(held)] += len(k)
        level = min((x for x, _ in chars), default=None)
        out[c, t] = max(((n, u) for (x, u), n in chars.items() if x == level), default=(0, None))[1]
    found = {}
    for c, t in out:
        depth, up = 0, t
        while out[c, up] is not None:
            depth, up = depth + 1, out[c, up]
        found[c, t] = (out[c, t], up, depth)
    return found, texts


@pytest.mark.parametrize("seed", range(3))
def test_quotes_against_plain_search(spark, seed):
    import random

    rng = random.Random(seed)
    said = [f"Line {w}, of {i % 4} words." for i, w in enumerate("alpha beta gamma delta epsilon zeta".split())]
    rows = []
    for c in range(4):
        for t in rng.sample(range(3000), 12):
            lines = [("> " * rng.choice([0, 0, 0, 1, 1, 2, 3])).replace("> ", rng.choice([">", "> ", " >\t"])) + rng.choice([*said, ""]) for _ in range(rng.randrange(7))]
            rows.append((c, t, rng.choice("ua"), rng.choice(["\n", "\r\n"]).join(lines)))
    rows += [rows[3], (0, None, "u", said[0]), (None, 5, "u", "> " + said[0]), (1, 9999, None, None)]
    got = quotation.link_quotes(spark.createDataFrame(rows, MESSAGES)).collect()
    want, texts = plain_threads(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r.text == texts[r.conv_id, r.turn]
        if r.conv_id is not None and r.turn is not None:
            assert (r.parent_turn, r.thread_turn, r.depth) == want[r.conv_id, r.turn], (r, seed)
    for c in range(4):
        mine = sorted((r for r in got if r.conv_id == c and r.turn is not None), key=lambda r: r.position)
        order = [(r.thread_turn, r.depth, r.turn) for r in mine]
        assert order == sorted(order)


def test_deep_marks_and_many_empty_lines(spark):
    deep = ">" * 100_000
    rows = [(1, 0, "u", "Hello there"), (1, 1, "a", deep + " Hello there\n> Hello there\nHi"), (1, 2, "u", "> Hi\n" + "\n" * 50_000 + "Bye" + " " * 100_000), (1, 3, "a", "> " * 50_000)]
    got = {r.turn: r for r in quotation.link_quotes(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert {t: r.parent_turn for t, r in got.items()} == {0: None, 1: 0, 2: 1, 3: None}
    assert got[2].text.endswith("Bye") and got[1].n_quotes == 2


def test_no_messages(spark):
    assert quotation.link_quotes(spark.createDataFrame([], MESSAGES)).count() == 0


# --- 3: decontamination ---------------------------------------------------------------------------------------------


def plain_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def test_contamination_against_plain_search(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    items = [(1, item), (2, "short item"), (3, None), (4, "..."), (5, "ten eleven twelve thirteen fourteen a b c d e f"), (None, "zzz"), (12, item)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    texts = ODD + [item.upper() + "!", "x " + item[:30], "Short-ITEM short, item", item + " thirteen fourteen a b c d e f", "shortitem", "one two three four five six seven eight nine", "éshort item", "zzz"]
    got = {r.doc_id: r for r in decontaminate.contamination(docs(spark, texts, extra=True), bench).collect()}
    parts = {r.doc_id: r for r in decontaminate.contamination(docs(spark, texts, extra=True), bench, most_bytes=60).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        w, hit, names = plain_words(t), set(), set()
        for name, text in items:
            v = plain_words(text)
            n = min(10, len(v))
            for window in {tuple(v[k : k + n]) for k in range(max(1, len(v) - n + 1))} if v else ():
                for p in range(len(w) - n + 1):
                    if tuple(w[p : p + n]) == window:
                        hit |= set(range(p, p + n))
                        names |= {str(name)} - {"None"}
        want = (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit), sum(len(w[q]) for q in hit))
        for r in (got[i], parts[i]):
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated, r.hit_chars) == want, t and t[:40]
    spans = decontaminate.contamination_spans(docs(spark, ["é Short--ITEM."]), bench).collect()
    assert [(r.item_id, r.start, r.end) for r in spans] == [("2", 2, 13)]
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert {r.contaminated for r in decontaminate.contamination(docs(spark, ODD), empty).collect()} == {False}
    cut = decontaminate.contamination_spans(docs(spark, ["é Short--ITEM."]), bench, most_bytes=60).collect()
    assert [tuple(r) for r in cut] == [tuple(r) for r in spans]


def test_windows_of_many_lengths_are_counted_once():
    import random

    rng = random.Random(4)
    words = [rng.choice("abc") for _ in range(400)]
    items = [(str(n), " ".join(rng.choice("abc") for _ in range(n))) for n in (1, 2, 3, 4, 5, 6, 7, 12)]
    _, found = decontaminate.scan(decontaminate.build_automaton(items, 10), " ".join(words))
    want = {(p, len(w), name) for name, text in items for w in decontaminate.item_windows(text.encode().split(), 10) for p in range(len(words)) if [x.encode() for x in words[p : p + len(w)]] == list(w)}
    assert {(p, n, name) for p, n, names in found for name in names} == want and len(want) > 150


# --- 4: url rules ---------------------------------------------------------------------------------------------------


def test_url_rules(spark):
    urls = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme example.com/en/": ("", "", None, "allow"), "http://Example.COM/en/x?q#f": ("example.com", "/en/x", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"), "https://a.www.example.com/en/1": ("a.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"), "http://x.com": ("x.com", "", None, "allow"), "http://com/": ("com", "/", "com/", "allow"), "ftp://a.net/es/": ("a.net", "/es/", "net/es/", "block"),
        "ftp://a.net/ES/": ("a.net", "/ES/", None, "allow"), "x://y.org/.example.com/en/": ("y.org", "/.example.com/en/", None, "allow"), "a://b://c.com/": ("b:", "//c.com/", None, "allow"),
        "http://free-bets.org/": ("free-bets.org", "/", None, "block"), "http://é.com/ü" + "x" * 5000: ("é.com", "/ü" + "x" * 5000, "com/", "allow"), "http://a.com?x=/": ("a.com", "", None, "allow"),
    }
    rows = [(i, u, 1) for i, u in enumerate([*urls, *urls])]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string, verdict int"), batch=5).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == urls[r.url], r.url
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def test_automaton_against_regular_expressions():
    globs = ["a*b", "*x*", "?b*", "abc", "*", "a" * 70 + "*c", "**b"]
    texts = [b"", b"ab", b"axb", b"abc", b"a" * 71 + b"c", b"xb", b"b"]
    found = url_filter.compile_globs(globs).matches(texts)
    for i, t in enumerate(texts):
        for k, g in enumerate(globs):
            assert found[i, k] == bool(re.fullmatch(g.replace("*", ".*").replace("?", ".").encode(), t)), (t, g)


# --- 5: toxicity ----------------------------------------------------------------------------------------------------


def test_toxicity_learns_and_takes_odd_texts(spark):
    rows, labels, texts = labelled(spark, lambda i: f"Some words and then you dreadful{i % 4} fool appear in text {i}")
    net = toxicity.train_toxicity(rows, labels)
    got = {r.doc_id: r for r in toxicity.score_toxicity(rows, net).collect()}
    right = sum(got[i].predicted == int(i >= 60) for i in range(90))
    assert right >= 86
    again = toxicity.score_toxicity(docs(spark, ODD + [None], extra=True), net).collect()
    assert len(again) == len(ODD) + 1 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in again)
    assert toxicity.train_toxicity(rows, labels.where("toxic = 0")) is None
    assert {r.predicted for r in toxicity.score_toxicity(docs(spark, ODD), None).collect()} == {0}
    assert toxicity.score_toxicity(docs(spark, []), net).count() == 0


def test_pooling_in_chunks_sees_every_window():
    import numpy as np

    rng = np.random.default_rng(1)
    tables = rng.normal(size=(toxicity.BUCKETS, sum(toxicity.WIDTHS) * toxicity.FILTERS)).astype(np.float32)
    words = [f"w{i % 37}".encode() for i in range(100)]
    whole = toxicity.pooled_over(toxicity.Encoder(tables), words)
    assert np.allclose(whole, toxicity.pooled_over(toxicity.Encoder(tables, most=60), words, chunk=7))


def test_workers_hold_no_rows_of_untrained_buckets():
    import numpy as np

    texts = [[b"bad" if i % 2 else b"good", b"word", f"once{i}".encode()] for i in range(40)]
    net = toxicity.train_net([toxicity.bucket_ids(t, {}) for t in texts], np.arange(40) % 2)
    rows, places = net.packed()
    assert len(rows) < 100 and len(net.projections()) == toxicity.BUCKETS
    for words in texts[:3]:
        assert (toxicity.pooled_over(toxicity.Encoder(rows, places=places), words) == toxicity.pooled_over(toxicity.Encoder(net.projections()), words)).all()


def test_training_in_segments_sees_every_window():
    import numpy as np

    rng = np.random.default_rng(2)
    net = toxicity.train_net([toxicity.bucket_ids([f"w{i % 9}".encode()], {}) for i in range(20)], np.arange(20) % 2.0, epochs=1)
    net.table[:] = rng.normal(size=net.table.shape)
    net.table[0] = 0
    docs = [toxicity.bucket_ids([f"w{rng.integers(500)}".encode() for _ in range(n)], {}) for n in (0, 1, 2, 50, 333, 7)]
    whole, places = toxicity.pool_ids(net, docs)
    for most in (1, 10, 64):
        again, found = toxicity.pool_ids(net, docs, most)
        assert np.allclose(whole, again) and all((p == q).all() for p, q in zip(places, found))


# --- 7: pages -------------------------------------------------------------------------------------------------------


def test_pages(spark):
    body = "<article><h1>Head &amp; line</h1><p>One, two,\n  three.<p><b>Bold</b>er&nbsp;text<br>after <a href=x>link</a>.</p><div class='comments'><p>Nice, post, friend!</p></div></article>"
    page = f"<html><head><title>T</title><style>p</style><script>var t='</p>'</script></head><body><nav><ul><li><a>Menu</a></li></ul></nav><div class=ad>Buy, now, cheap, things.</div>{body}<footer>Foot, note.</footer>"
    want = "Head & line One, two, three. Bolder\u00a0text after link."
    div = "<body><div id=sidebar><p>Side, bar, words.</p></div><div><div><p>First paragraph, with commas, and words.</p><p>Second, one.</p></div></div><form><p>Sign, up.</p></form></body>"
    rows = [(0, "u", page), (1, None, None), (2, "u", ""), (3, "u", div), (4, "u", "<p>only"), (5, "u", "plain"), (6, "u", "<nav>just menu</nav>"), (7, "u", "<div>" * 5000 + "deep"), (0, "u", page)]
    got = html_extract.extract_text(spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, n_chars int")).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert texts == {0: want, 1: "", 2: "", 3: "First paragraph, with commas, and words. Second, one.", 4: "only", 5: "plain", 6: "", 7: "deep"}


LONG = "<p>A first paragraph, with commas, and words enough to be told from menus, goes on here.</p>"
TEXT = "A first paragraph, with commas, and words enough to be told from menus, goes on here."


@pytest.mark.parametrize(
    "page,want",
    [
        (f"<div class='layout with-sidebar'><article>{LONG}</article><div class=sidebar>Side, words.</div></div>", TEXT),
        (f"<div class='sidebar'><article>{LONG}</article></div>", TEXT),
        (f"<div id='search-results-article'>{LONG}</div>", TEXT),
        (f"<div><p class='share-price'>The price, of a share.</p>{LONG}</div>", "The price, of a share. " + TEXT),
        (f"<div><section><p>Short.</p></section><section>{LONG * 6}</section><section><h2>On</h2><p>Later.</p></section></div>", "Short. " + " ".join([TEXT] * 6) + " On Later."),
        (f"<article><section><p>Short</p></section><section>{LONG * 6}</section><section><p>Later</p></section><div class='comment-list'>{LONG * 9}</div></article>", "Short " + " ".join([TEXT] * 6) + " Later"),
        (f"<article>{LONG}</article><div class='related-items'><article>{LONG}</article></div>", TEXT),
        (f"<div class=widget>{LONG * 3}</div>", " ".join([TEXT] * 3)),
        (f"<div class='comments'>{LONG * 3}</div>", ""),
        ("<div class='cookie-notice'>We use, cookies, here.</div>", ""),
        (f"<h1>Title</h1><div>{LONG}</div><div class='ad-box'>Buy, now.</div>", "Title " + TEXT),
    ],
)
def test_names_weigh_but_do_not_cut_the_article(page, want):
    assert html_extract.main_text(page) == want


ROWS = "<div class=row><p>" + "Long text, with commas. " * 20 + "</p></div><div class=row><div><p>A nested paragraph of text here.</p></div></div><div class=row><p>Last row.</p></div>"


@pytest.mark.parametrize(
    "page,want",
    [
        (f"<body><form action=x>{LONG * 2}<input></form></body>", f"{TEXT} {TEXT}"),
        ("<body><form><label>Name</label><p>Sign, up.</p></form></body>", ""),
        (f"<div class=post>{ROWS}</div>", "Long text, with commas. " * 20 + "A nested paragraph of text here. Last row."),
        (f"<div><section>{LONG * 3}</section><section><p>Short one</p></section><section>{LONG * 3}</section></div>", " ".join([TEXT] * 3 + ["Short one"] + [TEXT] * 3)),
        (f"<article>{LONG}</article><article><p>Short note</p></article>", TEXT + " Short note"),
        (f"<article>{LONG}<div class='comment-thread'>{LONG}</div><div id='user-comments-area'>{LONG}</div><div class='related-posts'>{LONG}</div></article>", TEXT),
        ("<p>x<![foo[bar]]></p><![<![", "x"),
        ("<p title='a>b' q>x</p><p a=b'c>y &lt; &amp z</p><!-- <p>no --> 1 < 2 <!-->3<?php x?></>", "x y < & z 1 < 2 3"),
        ("<title>T</title><script>if (a<b) '</p>'</script>in<style>x</STYLE >out<!-- never closed <p>gone", "in out"),
    ],
)
def test_forms_rows_readers_and_odd_markup(page, want):
    assert html_extract.main_text(page) == want


@pytest.mark.parametrize(
    "part",
    ["<b>", "<li>", "<p>", "<p><table><b><div>", "<a ", "<a x='", '<a x="', "<!--", "<![", "<!", "<?", "</", "</p>", "<", "&", "<script>", "<title>", "<a =", "<a /", "<a x= ", "-->", "<table><tr><td>", "<li><a>"],
)
def test_parsing_is_linear(part):
    import time

    began = time.process_time()
    html_extract.main_text(part * (200_000 // len(part)))
    assert time.process_time() - began < 2 * max(1.0, SLOW)


def _slowness():
    import time

    began = time.thread_time()
    sum(range(1_000_000))
    return (time.thread_time() - began) / 0.02


SLOW = _slowness()


def test_no_page_is_refused(sf_dir):
    import random

    import pyarrow.parquet as pq

    rng, pages = random.Random(3), pq.read_table(f"{sf_dir}/pages.parquet").column("html").to_pylist()
    odd = ["<", "</", ">", "<!", "<![", '"', "'", "=", "&#", "&", "<a ", "</p", "<!--", "--", "]]>", "\0", "<script", "<svg>", "<plaintext>", "\ud800", "é"]
    for _ in range(10_000):
        page = rng.choice(pages)[:1500]
        for _ in range(rng.randint(1, 6)):
            i = rng.randrange(len(page) + 1)
            page = page[:i] + rng.choice(odd) + page[i + rng.randint(0, 20) :]
        assert isinstance(html_extract.main_text(page), str)


def test_pages_of_the_tables_keep_their_article(spark, sf_dir):
    import html as h

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for r in html_extract.extract_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.sub(r"<[^>]*>", " ", r.html.split("<article>")[1].split("</article>")[0])
        assert re.sub(r"[\x20\x09-\x0D]+", " ", h.unescape(inner)).strip(" ") == r.text


# --- 8: mixing ------------------------------------------------------------------------------------------------------


def plain_targets(sizes):
    weight, target, open_, left = [(5, 2, 1)[i % 3] for i in range(len(sizes))], [0.0] * len(sizes), set(range(len(sizes))), 1.5 * sum(sizes)
    while open_:
        total = sum(weight[i] for i in open_)
        over = {i for i in open_ if left * weight[i] / total > 2 * sizes[i]}
        for i in over or open_:
            target[i] = 2.0 * sizes[i] if over else left * weight[i] / total
        left -= sum(target[i] for i in over)
        open_ = open_ - over if over else set()
    return target


@pytest.mark.parametrize("sizes", [[], [0, 0], [100, 100, 100], [10, 1000, 1000], [3, 0, 50, 7, 900, 20, 1, 1, 40]])
def test_targets(spark, sizes):
    names = [f"s{i:02}" for i in range(len(sizes))]
    plan = mixing.source_plan(spark.createDataFrame([*zip(names, sizes)], "source string, size bigint"), 4).orderBy("src").collect()
    assert [(r.src, r.source, r.source_size) for r in plan] == [(i, names[i], n) for i, n in enumerate(sizes)]
    assert [r.target for r in plan] == pytest.approx(plain_targets(sizes))


@pytest.mark.parametrize("shards, quotas", [(1, [3, 0, 5]), (4, [0, 0]), (7, [1000, 10, 1, 0, 333]), (64, [1] * 30), (3, [5000] * 200)])
def test_draws_of_shards_meet_the_quotas(shards, quotas):
    import numpy as np

    quotas, total = np.array(quotas), sum(quotas)
    slots = np.array([total // shards + (k < total % shards) for k in range(shards)])
    spread = []
    for seed in range(30):
        n = mixing.settled_draws(slots, quotas, np.random.default_rng(seed))
        assert (n >= 0).all() and (n.sum(axis=1) == slots).all() and (n.sum(axis=0) == quotas).all()
        spread.append(n[0])
    if shards == 7:  # a shard's counts vary as a draw does, around its share of each quota
        spread = np.array(spread)
        assert abs(spread[:, 0].mean() - slots[0] * 1000 / total) < 4 and 1 < spread[:, 0].std() < 12


def test_permutation_takes_each_index_once(spark):
    for n in (1, 2, 3, 10, 97, 1000):
        high = max(1, int(n**0.5 + 0.999))
        low = -(-n // high)
        rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(high), F.lit(low), F.lit(n), F.lit(5)).alias("p")).collect()
        assert sorted(r.p for r in rows) == list(range(n))


def test_blocks_of_the_mix_hold_the_words_they_should(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 2)
    texts = [" ".join(f"w{i}_{k}" for k in range(7 * i % 40)) for i in range(40)] + ["same words here"] * 3
    rows = docs(spark, texts, sources=["a", "b", None, "c", "d"])
    keyed = mixing._keyed(rows)
    sized = mixing._sized(keyed)
    plan = mixing.source_plan(sized, 8)
    laid = mixing.lay_out(sized, plan).collect()
    words = defaultdict(list)
    for r in sorted(laid, key=lambda r: (r.src, r.offset, r.size)):
        assert len(words[r.src]) == r.offset or not r.size
        words[r.src] += texts[r.doc_id].split()
    drawn = {(r.shard, r.slot): (r.src, r.block) for r in mixing.drawn_blocks(plan, 3, 11).collect()}
    facts = {r.src: r for r in plan.collect()}
    per_shard, uses = Counter(k for k, _ in drawn), Counter(drawn.values())
    assert all(sorted(s for k, s in drawn if k == shard) == list(range(n)) for shard, n in per_shard.items())
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    for src, r in facts.items():
        own = [uses[src, b] for b in range(r.blocks)]
        assert sum(own) == r.quota and (not own or max(own) - min(own) <= 1)
    got = defaultdict(list)
    for r in mixing.mix_documents(rows, block_words=8, shards=3, seed=11).collect():
        got[r.shard, r.slot] += r.text.split()
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(words[src][8 * b : 8 * b + 8]) for k, (src, b) in drawn.items()}
    taken = Counter()
    for src, b in drawn.values():
        for at in range(8 * b, min(8 * b + 8, len(words[src]))):
            taken[next(r.rid for r in laid if r.src == src and r.offset <= at < r.offset + r.size)] += 1
    doc = {r.rid: r.doc_id for r in laid}
    assert {r.doc_id: r.taken for r in mixing.mix_counts(rows, block_words=8, shards=3, seed=11).collect()} == {doc[i]: taken[i] for i in doc}


def test_mix_keeps_rows_that_differ_in_a_map(spark):
    rows = docs(spark, ["some words of a text"] * 2).withColumn("doc_id", F.lit(1).cast("bigint")).withColumn("m", F.create_map(F.lit("k"), F.monotonically_increasing_id()))
    assert len({r.m["k"] for r in mixing.mix_documents(rows, block_words=4, shards=2).collect()}) == 2


def test_mix(spark):
    texts = ODD + [" ".join(f"w{i}_{k}" for k in range(50 + 13 * i)) for i in range(30)]
    rows = docs(spark, texts, extra=True, sources=["b", None, "a", "zz"])
    got = mixing.mix_counts(rows, block_words=16, shards=4).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    by, size = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size == plain_counts(texts[r.doc_id])[0] and 0 <= r.taken <= 2 * r.size
        by[r.source] += r.taken
        size[r.source] += r.size
    names = sorted((s for s in size if s is not None)) + [None]
    targets = dict(zip(names, plain_targets([size[s] for s in names])))
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(targets[r.source])
        assert abs(by[r.source] - r.target) <= 16
    again = {(r.doc_id, r.taken) for r in mixing.mix_counts(rows.repartition(3), block_words=16, shards=4).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}
    parts = mixing.mix_documents(rows, block_words=16, shards=4)
    words = {r.doc_id: r.n for r in parts.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert {r.doc_id: r.taken for r in got if r.taken} == words
    for r in parts.where("doc_id >= 10").collect():
        assert r.text in texts[r.doc_id] and r.n_chars == len(r.text) and r.lang == "en"
    slots = parts.select("shard", "slot").distinct().groupBy("shard").agg(F.max("slot").alias("m"), F.count("slot").alias("n")).collect()
    assert all(s.m + 1 == s.n for s in slots)
    for empty in (docs(spark, []), docs(spark, [None, ""])):
        assert mixing.mix_documents(empty).count() == 0 and {r.taken for r in mixing.mix_counts(empty).collect()} <= {0}


def test_repeated_rows_are_mixed_apart(spark):
    rows = docs(spark, ["a b c d e f g h"] * 1).union(docs(spark, ["a b c d e f g h"] * 1)).union(docs(spark, [None])).union(docs(spark, [None]))
    got = mixing.mix_counts(rows, block_words=4, shards=2).collect()
    assert sorted(r.size for r in got) == [0, 0, 8, 8] and sum(r.taken for r in got) == 24
    many = spark.range(500).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit("a b c d e f g h").alias("text"), F.lit("s").alias("source"))
    assert mixing.mix_counts(many, block_words=8, shards=2).agg(F.sum("taken")).first()[0] == 6000
    assert {r.n: r["count"] for r in mixing.mix_counts(many, block_words=8, shards=2).groupBy(F.col("taken").alias("n")).count().collect()} == {8: 250, 16: 250}


def test_as_many_sources_as_rows(spark):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.concat(F.lit("s"), "id").alias("source"))
    got = mixing.mix_counts(many, block_words=4, shards=3)
    assert got.agg(F.sum("taken"), F.max("taken")).first()[:] == (got.select(F.sum(F.rint(F.col("target") / 4) * 4)).first()[0], 8)


# --- 9: sharding ----------------------------------------------------------------------------------------------------


def jump(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    keys = [0, 1, 2, 12345, -1, -(2**63), 2**63 - 1, *range(100, 400)]
    df = spark.createDataFrame([(k,) for k in keys], "doc_id bigint")
    for n in (1, 2, 8, 9, 1000):
        assert {r.doc_id: r.s for r in df.select("doc_id", sharding.jump_shard(F.col("doc_id"), n).alias("s")).collect()} == {k: jump(k, n) for k in keys}


def test_shards(spark):
    rows = docs(spark, ODD, extra=True)
    rows = rows.union(rows).union(docs(spark, [None], extra=True).withColumn("doc_id", F.lit(None).cast("bigint")))
    got = sharding.shard_documents(rows).collect()
    assert len(got) == 2 * len(ODD) + 1
    by = defaultdict(list)
    for r in got:
        raw = ((ODD[r.doc_id] if r.doc_id is not None else None) or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.shard == jump(r.doc_id or 0, 8) and r.grown_shard == jump(r.doc_id or 0, 9)
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.shard_documents(docs(spark, [])).count() == 0


# --- 10: near duplicates --------------------------------------------------------------------------------------------


def plain_components(rows, width, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(set() if not w else {tuple(w)} if len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("width,percent,seed", [(4, 85, 1), (5, 80, 2)])
def test_near_duplicates_against_all_pairs(spark, width, percent, seed):
    import random

    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    rows = list(enumerate(ODD))
    for g in range(12):
        base = [f"g{g}_{rng.randrange(60)}" for _ in range(rng.choice([6, 30, 90, 150]))]
        for _ in range(rng.choice([2, 5, 25])):
            text = list(base)
            for _ in range(rng.randrange(5)):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text + (passage if rng.random() < 0.3 else []))))
    rows += [(None, rows[12][1]), (7, rows[12][1]), (len(rows) + 5, rows[13][1].upper())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n", F.lit(1)).withColumn("digest", F.lit("x"))
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(df, width, percent).collect()), key=str)
    want = plain_components(rows, width, percent)
    assert len({w[2] for w in want}) < len(want)
    assert got == want


def test_every_member_of_a_group_meets_other_groups(spark):
    """One prefix and size make a group of sets s+abc and s+def; s+defg links with the second only, which doesn't lead."""
    texts = []
    for k in range(3):
        s, x, y = (" ".join(f"{c}{k}_{i}" for i in range(n)) for c, n in (("s", 5), ("x", 3), ("y", 3)))
        tail = s.split(" ", 1)[1]
        # Three copies of abc and of def, too short to link, make these shingles more frequent than s, which goes before them.
        texts += [f"{s} {x}", f"{s} {y}", f"{s} {y} z{k}"] + [f"{tail} {x}"] * 3 + [f"{tail} {y}"] * 3
    rows = list(enumerate(texts))
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(docs(spark, texts), 5, 80).collect()), key=str)
    assert got == plain_components(rows, 5, 80)
    assert {(d, c) for d, _, c in got} >= {(0, 0), (1, 1), (2, 1)}


def test_frequent_footers_lose_no_link(spark):
    """Twenty corpora in one table, each with its own words: bodies that differ in few words, under footers that many share."""
    import random

    rows = []
    for seed in range(20):
        rng = random.Random(seed)
        feet = [[f"f{seed}_{k}_{i}" for i in range(rng.choice([12, 30, 60]))] for k in range(3)]
        for g in range(4):
            base = [f"b{seed}_{g}_{i}" for i in range(rng.choice([40, 120, 200]))]
            for _ in range(5):
                text = list(base)
                for _ in range(rng.randrange(4)):
                    text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
                rows.append((len(rows), " ".join(text + rng.choice([*feet, []]))))
    # The same body under two footers, and a copy of the second with a few words changed.
    body, one, two = [f"w{i}" for i in range(200)], [f"x{i}" for i in range(12)], [f"y{i}" for i in range(12)]
    third = list(body)
    for k in (20, 70, 120, 170):
        third[k] = f"z{k}"
    rows += [(len(rows) + k, " ".join(x)) for k, x in enumerate((body + one, body + two, third + two))]
    rows += [(len(rows) + k, " ".join([f"o{k}_{i}" for i in range(30)] + f)) for k, f in enumerate([one, two] * 10)]
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 85).collect()), key=str)
    assert got == plain_components(rows, 4, 85)


def test_keep_one_and_empty(spark):
    rows = docs(spark, ["a b c d e f g h"] * 3 + [None, "", "other words are here now"])
    assert sorted(r.doc_id for r in ngram_join.keep_one(rows).collect()) == [0, 3, 4, 5]
    copy, other = "a b c d e f g h", "other words are here now"
    odd = spark.createDataFrame([(None, copy, 1), (None, copy, 2), (7, copy, 3), (7, copy, 4), (7, other, 5), (3, other, 6), (None, "x y", 7), (None, "x y", 8), (9, None, 9), (9, "", 9)], "doc_id bigint, text string, node int")
    kept = sorted((tuple(r) for r in ngram_join.keep_one(odd).collect()), key=str)
    assert [r[:2] for r in kept] == sorted([(7, copy), (3, other), (None, "x y"), (9, None), (9, "")], key=str) and {r[2] for r in kept} > {6, 9}
    assert ngram_join.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("n, step", [(0, 1), (3_000, 7), (400_000, 1)])
def test_rows_without_the_gone_keys_are_exact(spark, n, step):
    gone = spark.range(0, n * step, step).withColumnRenamed("id", "rid")
    rows = spark.createDataFrame([(k, f"t{k}", None) for k in [*range(-50, 5_000), *range(399_990, 400_060)] for _ in range(1 + k % 2)], "rid bigint, text string, n int")
    got = sorted(r.rid for r in ngram_join.without(rows, "rid", gone).collect())
    left = set(range(0, n * step, step))
    assert got == sorted(k for k in (r.rid for r in rows.collect()) if k not in left)
    assert ngram_join.without(rows, "rid", gone).columns == rows.columns
