"""Vectors, conversations, URLs, pages, the classifier and packing: brute force, round trips, held-out accuracy."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import compare
from tidemark.llm import ann_codes, chat_format, html_text, packing, quality_crf, url_filter
from tidemark.llm.common import read

DATA = "/root/testdata/sf0.01"


# --- nearest neighbours ---------------------------------------------------------------------------

def test_neighbours_with_hot_vector_and_bad_rows(spark):
    rng = np.random.default_rng(1)
    good = {i: rng.standard_normal(24).astype("f4") for i in range(900)}
    for i in range(300, 600):
        good[i] = good[300]  # a third of all rows
    rows = [(i, [float(x) for x in v], 1) for i, v in good.items()]
    rows += [(950, None, 1), (1000, [0.0] * 24, 1), (951, [], 1), (952, [float("nan")] * 24, 1), (953, [float("inf")] * 24, 1),
             (954, [None] * 24, 1), (None, rows[0][1], 1), rows[5], (1050, [1.0, 2.0], 1), (1051, [2.0, 1.0], 1)]
    out = ann_codes.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, block int")).collect()
    found = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.vec_id, r.score))
    ids = np.array(sorted(good))
    matrix = np.array([good[i] for i in ids], "f8")
    for q in range(0, 900, 50):
        score = ann_codes.exact(matrix, matrix[q])
        score[q] = -9
        best = np.lexsort((ids, -score))[:5]
        assert found[q] == [(int(ids[k]), float(score[k])) for k in best]
    assert found[1050] == [(1051, pytest.approx(0.8))] and 1000 not in found
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann_codes.nearest(empty).count() == 0


def test_different_vectors_of_one_id_are_all_candidates(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.standard_normal(16)]) for i in range(1, 200)]
    rows += [(7, [float(x) for x in rng.standard_normal(16)]) for _ in range(100)] + [rows[9]]  # id 7: 101 vectors
    rows += [(50, [float(x) for x in rng.standard_normal(16)])]  # and a second vector of a query
    out = ann_codes.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    for q in (50, 100, 150):
        wanted = sorted((-float(ann_codes.exact(np.array([v]), np.array(asked))[0]), i, tuple(v))
                        for i, v in rows for qid, asked in rows if qid == q and i != q)[:5]
        found = sorted((r.rank, r.vec_id, r.score) for r in out if r.query_id == q)
        assert [(i, s) for _, i, s in found] == [(i, -s) for s, i, _ in wanted]


def test_repeated_rows_against_sql(spark, tmp_path):
    """A candidate four times, a query twice, and a vector that makes up half of the table."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.standard_normal(16)]) for i in range(120)]
    rows += [rows[7]] * 3 + [rows[50]] + [rows[9]] * 130
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    df.coalesce(1).write.parquet(f"{tmp_path}/embeddings")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings/*.parquet'")
    wanted = [(q, r, i, pytest.approx(s, abs=1e-12)) for q, r, i, s in sorted(con.execute(ann_codes.SQL).fetchall())]
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann_codes.nearest(df).collect())
    assert found == wanted and len(found) == 15


def test_error_bound_holds():
    rng = np.random.default_rng(2)
    unit = rng.standard_normal((2000, 48))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    mean, turn = unit.mean(0), ann_codes.rotation(48)
    codes, scalars = ann_codes.encode(unit, mean, turn)
    guess, by_vector, by_query = ann_codes.estimate(codes, scalars, unit[:50], mean, turn)
    wrong = np.abs(guess - unit @ unit[:50].T) > by_vector[:, None] * by_query
    assert codes.shape[1] * 8 == turn.shape[1] == 128 and wrong.mean() < 0.005


# --- chat -----------------------------------------------------------------------------------------

def plain_parse(text):
    turns = []
    while text:
        assert text.startswith("<|im_start|>")
        head, _, text = text[12:].partition("\n")
        body, mark, text = text.partition("<|im_end|>\n")
        assert mark
        back = lambda x: re.sub(r"<\\(\\*)\|", r"<\1|", x)
        turns.append((back(head.replace("<|n|", "\n")), back(body)))
    return turns


def test_chat_round_trip(spark):
    bits = ["<|im_end|>", "<|im_start|>", "<", "|", "\\", "<\\|", "\n", "<|n|", "ok", "assistant", "é", "<|im_end|>\n"]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", None, "a\nb", "<|im_start|>", "<|n|", "<\\|n|"]),
             rng.choice([None, "".join(rng.choices(bits, k=rng.randrange(7)))]), 1) for c in range(60) for t in range(rng.randrange(1, 5))]
    rows += [(None, None, "user", "x", 1), (None, None, "user", "x", 1), (70, 2, "assistant", "b", 1), (70, None, "user", "a", 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, escaped int")
    source = defaultdict(list)
    for c, t, role, text, _ in rows:
        source[c].append((-1 if t is None else t, role or "", text or ""))
    out = chat_format.format_conversations(turns).collect()
    assert len(out) == len(source) and {r.escaped for r in out} == {0, 1}
    for r in out:
        wanted = [(role, text) for _, role, text in sorted(source[r.conv_id])]
        assert r.round_trip and plain_parse(r.formatted) == wanted
        at, learned = 0, []
        for m, (role, text) in zip(r.loss_mask, wanted):
            body = r.formatted[at + m["head"]:at + m["head"] + m["text"]]
            assert re.sub(r"<\\(\\*)\|", r"<\1|", body) == text and m["learned"] == (role == "assistant")
            at += m["head"] + m["text"] + len("<|im_end|>\n")
        assert at == len(r.formatted)
    assert chat_format.format_conversations(turns.limit(0)).count() == 0


def test_chat_query_holds_the_stated_conversation(spark):
    r = chat_format.query(spark, DATA).filter("conv_id = -1").first()
    text = "<|im_end|><|im_start|>assistant ok"
    whole = f"user\n{text}\nassistant\n{text}\n"
    assert (r.n_turns, r.turns_sha256) == (2, hashlib.sha256(whole.encode()).hexdigest())
    assert (r.loss_chars, r.loss_sha256) == (len(text), hashlib.sha256(text.encode()).hexdigest())
    plan = chat_format.query(spark, DATA)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


# --- URLs -----------------------------------------------------------------------------------------

RULES_SQL = """
WITH p AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1) AS h,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
q AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM p),
r AS (FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                   ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS t(verdict, domain, prefix))
SELECT q.page_id, q.host, q.path, max_by(r.domain || r.prefix, length(r.domain || r.prefix)) AS rule,
       max_by(r.verdict, length(r.domain || r.prefix)) AS verdict
FROM q LEFT JOIN r ON (q.host = r.domain OR ends_with(q.host, '.' || r.domain)) AND starts_with(q.path, r.prefix)
GROUP BY ALL
"""


def test_url_rules_match_sql(spark):
    ruled = F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("verdict")
    df = url_filter.query(spark, DATA)
    assert compare.check(df.select("page_id", "host", "path", "rule", ruled), compare.connect(DATA), RULES_SQL) is None
    assert {r.verdict for r in df.select("verdict").distinct().collect()} <= {"allow", "block"}


def test_url_trees_learn_lexical_form(spark):
    rng = random.Random(5)

    def url(i, bad, host):
        return f"http://h{i % 40}.{host}/" + ("".join(rng.choices("0123456789", k=14)) if bad else "some-words-here")
    pages = [(i, url(i, i % 2, "known.org")) for i in range(400)]
    pages += [(1000 + i, url(i, i % 2, "new.net")) for i in range(60)]
    rows = spark.createDataFrame(pages + [(None, None), (2000, "no scheme"), (2001, "HTTP://X.Known.ORG?q=1"), (1, pages[1][1])],
                                 "page_id long, url string")
    rules = [("block", "known.org", f"/{d}") for d in range(10)] + [("allow", "known.org", "/s")]
    out = {r.page_id: r for r in url_filter.judged(rows, rules).collect()}
    assert sum(out[1000 + i].verdict == ("block" if i % 2 else "allow") for i in range(60)) >= 55
    assert re.fullmatch(r"known\.org/\d", out[1].rule) and out[1].verdict == "block"
    assert (out[None].host, out[2000].path, out[2001].host, out[2001].path) == ("", "", "x.known.org", "")
    assert {r.verdict for r in url_filter.judged(rows, []).collect()} == {"allow"}
    assert url_filter.judged(rows.limit(0)).count() == 0


def test_url_trees_learn_rare_labels(spark):
    pages = [(i, f"http://h{i % 9}.known.org/some-words-{i % 300}") for i in range(3000)]
    pages += [(5000, "http://h1.known.org/some-words-0")] * 3000  # one URL in half of all rows
    pages += [(9000 + i, f"http://h{i}.known.org/{10 ** 13 + i}") for i in range(8)]
    pages += [(9100 + i, f"http://h{i}.new.net/some-words-{i}") for i in range(30)]
    pages += [(9200 + i, f"http://h{i}.new.net/{10 ** 13 + 77 * i}") for i in range(30)]
    rules = [("allow", "known.org", "/s"), ("block", "known.org", "/1")]
    out = {r.page_id: r for r in url_filter.judged(spark.createDataFrame(pages, "page_id long, url string"), rules, sample=20).collect()}
    assert all(out[9100 + i].verdict == "allow" for i in range(30))
    assert sum(out[9200 + i].verdict == "block" for i in range(30)) >= 28


# --- pages ----------------------------------------------------------------------------------------

def test_common_lines_is_longest():
    rng = random.Random(6)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(10))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        for cells in (1 << 30, 4):
            got = html_text.common_lines(a, b, cells)
            rest = iter(b)
            assert len(got) == table[-1][-1] and got == sorted(set(got)) and all(a[i] in rest for i in got)


def test_pages(spark):
    body = "<html><head><title>t</title><style>x</style></head><body>{}</body></html>"
    rows = [
        (1, "http://a.com/x/1", body.format("<div>Home</div><div>Shop</div><p>One &amp; only<br>two</p><div>End</div>"), 1),
        (2, "http://a.com/x/2", body.format("<div>Home</div><div>Shop</div><p>Other \n text</p><div>End</div>"), 1),
        (3, "http://b.com/q", body.format("<nav>n</nav><header>h</header><aside>s</aside><div class=ad>ad</div><article><h1>T</h1>"
                                          "<p>x <b>y</b> &lt;z&#62;<!-- c --><form>f</form><script>var t='</p>'</script>"
                                          "<div class='comments'>c</div></article><footer>f</footer><div id='cookie-notice'>k</div>"), 1),
        (4, None, None, 1), (5, None, "<p>solo", 1), (None, "http://a.com/x/3", body.format("<div>Home</div><p>third</p>"), 1),
        (6, "u", "", 1), (7, "http://c.com/", "<article><p>cut of <b>a wor", 1), (8, "http://c.com/", "<article>" + "<p>long</p>" * 5000, 1)]
    out = {r.page_id: r.text for r in html_text.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string, host int")).collect()}
    assert out[1] == "One & only\ntwo" and out[2] == "Other text" and out[None] == "third"
    assert out[3] == "T\nx y <z>" and out[4] == "" and out[5] == "solo" and out[6] == ""
    assert out[7] == "cut of a wor" and out[8] == "\n".join(["long"] * 5000)
    schema = "page_id long, url string, html string"
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0


def texts_of(spark, pages):
    rows = [(i, url, f"<html><body>{html}</body></html>") for i, (url, html) in enumerate(pages)]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(out, key=lambda r: r.page_id)]


def test_pages_with_an_article_are_aligned_too(spark):
    frame = "<div>Home</div><div>{}</div><article><p>Licence of all pages</p><p>{}</p></article><div>End</div>"
    pages = [(f"http://a.com/{i}", frame.format(f"Title {i}", f"body of page {i}")) for i in range(200)]
    pages.append(("http://a.com/199x", "<div>Home</div><div>plain text only</div><div>End</div>"))
    out = texts_of(spark, pages)
    assert out[:200] == [f"Title {i}\nLicence of all pages\nbody of page {i}" for i in range(200)]
    assert out[200] == "plain text only"


def test_copies_of_a_page_keep_their_text(spark):
    def page(*lines):
        return "".join(f"<div>{x}</div>" for x in ("Home", "Shop", *lines, "End"))
    same = [f"line {i} of a copied text" for i in range(20)]
    pages = [("http://a.com/m", page("the other page"))] + [(f"http://a.com/m?mirror={i}", page(*same)) for i in range(40)]
    pages += [(f"http://a.com/m{i}", page(*same)) for i in range(40)]
    near = [[*same[:k % 20], f"edit {k} here", *same[k % 20 + 1:]] for k in range(200)]
    pages += [(f"http://b.com/x/{k:03}", page(*near[k])) for k in range(200)] + [("http://b.com/y", page("last page"))]
    pages += [(f"http://c.com/{k}", page(*near[k])) for k in range(3)]
    out = texts_of(spark, pages)
    assert out[0] == "the other page" and out[1:81] == ["\n".join(same)] * 80
    assert out[81:281] == ["\n".join(x) for x in near] and out[281] == "last page"
    assert all(x in out[282 + k].split("\n") for k in range(3) for x in near[k])


def kept_lines(html):
    return [t for t, kind in html_text.page_lines(html) if kind != html_text.DROPPED]


def test_wrappers_do_not_drop_the_article():
    article = "<article><p>text</p></article>"
    for wrapper in ("<div class='content-sidebar-wrap'>", "<div class='has-sidebar'>", "<section class='share-enabled'>", "<form>",
                    "<div class='widget'>", "<body class='single comments-open'>", "<div class='page-header'>"):
        assert kept_lines(wrapper + article) == ["text"], wrapper
        if wrapper not in ("<form>", "<div class='widget'>"):
            assert kept_lines(wrapper + "<p>text</p>") == ["text"], wrapper
    assert kept_lines("<article class='has-comments'><p>text</p></article>") == ["text"]
    assert kept_lines("<nav>menu<main class='comments'>text") == ["text"]
    for furniture in ("<ol class='comment-list'>", "<div id='comments'>", "<div hidden>", "<aside>"):
        assert kept_lines(furniture + article) == [], furniture
    for furniture in ("<div class='site-footer'>", "<div id='cookie-notice'>", "<div class='x ad-box'>", "<div class='nav-links'>"):
        assert kept_lines(furniture + "<p>text</p>") == [], furniture
    assert kept_lines("<main><p>text</p><article class='comment'>me too</article></main>") == ["text"]


def test_text_beside_content_words_and_after_unclosed_elements_stays(spark):
    head = "<h1 class='entry-title'>Title</h1><div class='post-meta'>by me</div>"
    pages = [(f"http://a.com/{i}", f"<div>Home</div>{head.replace('Title', f'Title {i}')}<div>text of page {i}</div>") for i in range(3)]
    assert texts_of(spark, pages) == [f"Title {i}\ntext of page {i}" for i in range(3)]
    for tag in ("button", "object", "select", "canvas", "svg", "math", "iframe"):
        assert kept_lines(f"<p>a</p><{tag} class=x>inside<p>b</p>c") == ["a", "b", "c"], tag
        assert kept_lines(f"<{tag}>inside</{tag}>a<{tag}/><p>b</p>") == ["a", "b"], tag
    assert kept_lines("<button>one<p>b</p><button>two</button>c") == ["b", "c"]
    assert kept_lines("a<svg/>b<p>c</p><svg><path/></svg>d") == ["ab", "c", "d"]
    assert kept_lines("<select><optgroup><option>x<option>y</select>a") == ["a"]
    assert kept_lines("<html><head><title>t</title><script>var a='<p>'<body><p>b</p>") == ["b"]


@pytest.mark.parametrize("piece", [
    '<a "', "<!-x", "<a ", "<a \"<b '", "<a '\"", "<button><p>", "<title/></title>", "<svg>", "<!--", "<script>", "</script ", "&#", "<"])
def test_hostile_markup_takes_linear_time(piece):
    """A megabyte of what never ends; the pattern of before took hours."""
    for tail in ("", "</button>", ">", "\""):
        page = piece * (1_000_000 // len(piece)) + tail
        start = time.process_time()
        html_text.page_lines(page)
        assert time.process_time() - start < 5


def test_deep_markup_takes_linear_time():
    for page in ("<b>" * 150_000 + "</x>" * 130_000, "<p><table>" + "<b>" * 150_000 + "<h1>" * 130_000, "<b>" * 150_000 + "<li>" * 100_000):
        start = time.process_time()
        html_text.page_lines(page)
        assert time.process_time() - start < 5


def test_malformed_tags():
    lines = lambda html: [t for t, _ in html_text.page_lines(html)]
    assert lines('a <b title="x>y">bold</b> <i \'>\'>c</i>') == ["a bold c"]
    assert lines('1 <a "2 <p>3</p>') == ['1 <a "2', "3"]  # a quote without an end is text
    assert lines("x < y <3 </ <p") == ["x < y <3 </"]  # a tag that the page's end cuts off is none
    assert lines("a<!-- <p> -->b<!doctype x>c<!d") == ["abc<!d"]
    assert lines("<button>no<p>yes</p><button>no</button>") == ["yes"]


def test_given_pages_lose_their_frame_only(spark):
    pages = {r.page_id: r.html for r in read(spark, DATA, "pages").collect()}
    for r in html_text.query(spark, DATA).collect():
        article = pages[r.page_id].partition("<article>")[2].partition("</article>")[0]
        words = html_text.entities.unescape(re.sub(r"<[^>]*>", "\n", article)).split()
        assert r.text.split() == words and r.n_chars == len(r.text)


# --- classifier -----------------------------------------------------------------------------------

def test_classifier_sample_is_bounded_in_lines(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality_crf, "fit", lambda documents, labels: taken.append(sum(len(x) for x, _ in documents)))
    monkeypatch.setattr(quality_crf, "SAMPLE_LINES", 500)
    monkeypatch.setattr(quality_crf, "MOST_LINES", 100)
    rows = [(i, "a line of text\n" * (5000 if i % 10 == 0 else 20)) for i in range(200)] + [(1, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    quality_crf.learn(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert 400 <= taken[0] <= 500


def test_classifier_learns_from_repeated_rows_once(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality_crf, "fit", lambda documents, labels: taken.append((len(documents), sorted(labels))))
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, f"words of document {i}\nand a line") for i in ids] + [(ids[0], f"words of document {ids[0]}\nand a line")] * 500
    rows.append((ids[0], "another text of the first id"))
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    quality_crf.learn(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert taken == [(len(ids) + 1, sorted([i % 2 for i in ids] + [ids[0] % 2]))]


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(7)
    chain = quality_crf.Chain(np.zeros(1), np.ones(1), np.zeros(2), rng.standard_normal((2, 2)))
    sizes = np.array([3, 1, 4])
    emissions = rng.standard_normal(8)
    good, moves, log_z = chain.marginals(emissions, sizes)
    at, wanted_moves = 0, np.zeros((2, 2))
    for k, n in enumerate(sizes):
        total, ones = 0.0, np.zeros(n)
        each = []
        for labels in np.ndindex(*[2] * n):
            w = np.exp(sum((2 * y - 1) * e / 2 for y, e in zip(labels, emissions[at:at + n]))
                       + sum(chain.move[a, b] for a, b in zip(labels, labels[1:])))
            total, ones = total + w, ones + w * np.array(labels)
            each.append((labels, w))
        for labels, w in each:
            for a, b in zip(labels, labels[1:]):
                wanted_moves[a, b] += w / total
        assert np.allclose(good[at:at + n], ones / total) and np.isclose(log_z[k], np.log(total))
        at += n
    assert np.allclose(moves, wanted_moves)


def test_bad_run_is_told_from_the_good_lines_around_it():
    rng = random.Random(1)
    words = ["".join(rng.choices("etaoinshrdlucmfw", k=rng.randrange(2, 9))) for _ in range(800)]

    def document(good: bool):
        n = rng.randrange(10, 25)
        kinds = np.ones(n, int)
        if not good:
            run = max(2, int(n * .4))
            at = rng.randrange(0, n - run + 1)
            kinds[at:at + run] = 0
        lines = [" ".join(rng.choices(words, k=rng.randrange(7, 14))) + "." if k
                 else " | ".join(rng.choices(["buy", "now", "$$$", "click", "%%", "#1"], k=rng.randrange(3, 9))) for k in kinds]
        return quality_crf.line_features("\n".join(lines)), kinds

    made = [document(i % 2 == 1) for i in range(600)]
    labels = np.arange(600) % 2
    chain = quality_crf.fit([d for d, _ in made[:400]], labels[:400].astype(float))
    bad, good = [], []
    for (x, _), kinds in made[400::2]:
        marginals = chain.marginals(chain.inputs(x) @ chain.emit, np.array([len(x)]))[0]
        bad += list(marginals[kinds == 0])
        good += list(marginals[kinds == 1])
    assert max(bad) < 0.5 and np.mean(np.array(good) > 0.5) > 0.8  # lines next to the run see it in their features
    assert (((chain.scores([d for d, _ in made[400:]]) >= 0.7) == labels[400:]).mean()) >= 0.99


def test_gradient_of_the_expected_share():
    rng = np.random.default_rng(3)
    chain = quality_crf.Chain(np.zeros(2), np.ones(2), rng.standard_normal(3), rng.standard_normal((2, 2)))
    emissions, sizes, part = rng.standard_normal(7), np.array([4, 3]), rng.random(7)
    up, moves_up, _ = chain.marginals(emissions + 1e-4 * part, sizes)
    down, moves_down, _ = chain.marginals(emissions - 1e-4 * part, sizes)
    for k in range(7):  # against the share's own differences
        e = np.eye(7)[k] * 1e-4
        wanted = (chain.marginals(emissions + e, sizes)[0] - chain.marginals(emissions - e, sizes)[0]) @ part
        assert np.isclose((up - down)[k], wanted, atol=1e-9)
    for at in np.ndindex(2, 2):
        move, shares = chain.move.copy(), []
        for side in (1e-4, -1e-4):
            chain.move = move.copy()
            chain.move[at] += side
            shares.append(chain.marginals(emissions, sizes)[0] @ part)
        chain.move = move
        assert np.isclose((moves_up - moves_down)[at], shares[0] - shares[1], atol=1e-9)


def test_held_out_accuracy(spark):
    out = quality_crf.query(spark, "/root/testdata/sf0.01")
    labels = read(spark, "/root/testdata/sf0.01", "labels")
    right = out.filter("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right >= 0.95
    for r in out.filter("doc_id < 40").collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1


def test_classifier_edge_cases(spark):
    rows = [(None, "a b\nc", 1.0), (1, None, 1.0), (2, " \n ", 1.0), (3, "x " * 50_000, 1.0), (3, "x " * 50_000, 1.0), (4, "l\n" * 3000, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(None, 1), (3, None), (77, 1)], "doc_id long, quality int")
    out = quality_crf.scored(docs, labels).collect()
    assert len(out) == 6 and all(r.score == 0.5 and r.predicted == 0 for r in out if r.doc_id in (1, 2))
    assert quality_crf.scored(docs.limit(0), labels).count() == 0


# --- packing --------------------------------------------------------------------------------------

def test_encoder_equals_library():
    encoder = packing.Encoder(packing.public_tokenizer())
    texts = ["", " ", "A b's don't 'S\t12ab3 x²½ Ünï ſoo İ", "<|endoftext|> q", "''s!'s 'sabc d're...", "ǅ‘’…", "日本 語", "á   b",
             "Σας ΣΑΣ", "a\x0bb\x85c"] + ["".join(random.Random(i).choices("ab's. ,1é\n-T'll", k=60)) for i in range(300)]
    assert encoder.by_part
    wanted = encoder.library.encode_batch(texts, add_special_tokens=False)
    for got, x in zip(encoder.encode(pa.array(texts, pa.large_string())), wanted):
        assert got.tolist() == x.ids


def pad(size, length):
    return 0 if size & (size - 1) == 0 else length - size


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_cheapest(seed):
    rng = random.Random(seed)
    ends = np.cumsum([rng.randrange(1, 12) for _ in range(40)])
    prices = np.array([rng.choice([0, 2, 5]) for _ in ends])
    where, cost = [0, *ends.tolist()], [0]
    for j in range(1, len(where)):
        cost.append(min(cost[i] + pad(where[j] - where[i], 32) for i in range(j) if where[j] - where[i] <= 32) + int(prices[j - 1]))
    path = packing.cuts(ends, prices, 32, closed=True)
    stops = [0, *(int(ends[k]) for k in path)]
    assert stops[-1] == ends[-1]
    assert sum(pad(b - a, 32) for a, b in zip(stops, stops[1:])) + sum(int(prices[k]) for k in path) == cost[-1]


def test_pieces_are_whole(spark, monkeypatch):
    docs = read(spark, DATA, "documents").select("doc_id", "text", F.lit(1).alias("start"))
    extra = spark.createDataFrame([(-1, None, 1), (-2, "", 1), (None, "no id", 1), (-3, "word " * 30_000, 1)], docs.schema)
    every = docs.unionByName(extra)
    pieces = packing.pack(every, packing.public_tokenizer()).collect()
    encoder = packing.Encoder(packing.public_tokenizer())
    texts = {r.doc_id: r.text or "" for r in every.collect()}
    ids = {k: np.append(v, np.uint32(1)) for k, v in zip(texts, encoder.encode(pa.array(list(texts.values()), pa.large_string())))}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for k, rows in by_doc.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[k])
            assert r.ids_crc32 == zlib.crc32(ids[k][at:at + r.length].astype("<u4").tobytes())
            at += r.length
        assert at == len(ids[k])
    padding = total = 0
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and rows[0].sequence_length == at + pad(at, 2048)
        padding, total = padding + pad(at, 2048), total + at
    assert padding < 0.03 * total
    assert packing.pack(docs.limit(0), packing.public_tokenizer()).count() == 0
