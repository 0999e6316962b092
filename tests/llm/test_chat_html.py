import random

import pytest
from brute import turns_digest
from pyspark.sql import functions as F

from histmart.llm import chat_format as chat
from histmart.llm import html_extract as hx
from histmart.llm import queries

EVENT = "conv_id long, mid long, seq long, kind string, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>\n", "back\\slash \\<|", "<\\|turn|>", "", "a\nb", "<<SYS>>[INST", "é🙂\\", "<|", "\\"]


def texts_of(spark, events):
    got = {}
    for r in chat.fold(spark.createDataFrame(events, EVENT)).collect():
        got.setdefault(r["conv_id"], []).append((r["mid"], r["role"], r["text"]))
    return {c: [x[1:] for x in sorted(m)] for c, m in got.items()}


def replay(events):
    """Events one by one, as a chat client would apply them."""
    convs = {}
    for conv, mid, _, kind, role, text in sorted(events, key=lambda e: (e[0], e[2])):
        log = convs.setdefault(conv, {})
        if kind in ("edit", "regenerate"):
            for later in [m for m in log if m > mid]:
                del log[later]
        if kind == "delta":
            old = log.get(mid, [role, ""])
            log[mid] = [role, old[1] + text]
        else:
            log[mid] = [role, text or ""]
    return {c: [tuple(x) for _, x in sorted(log.items())] for c, log in convs.items() if log}


def test_fold_by_hand(spark):
    events = [(1, 1, 1, "message", "user", "hi"), (1, 2, 2, "delta", "assistant", "he"), (1, 2, 3, "delta", "assistant", "llo"),
              (1, 2, 4, "regenerate", "assistant", None), (1, 2, 5, "delta", "assistant", "yes"), (1, 3, 6, "message", "user", "more"),
              (1, 1, 7, "edit", "user", "hey"), (1, 2, 8, "message", "assistant", "new")]
    assert texts_of(spark, events) == {1: [("user", "hey"), ("assistant", "new")]}
    assert texts_of(spark, events[:6]) == {1: [("user", "hi"), ("assistant", "yes"), ("user", "more")]}


def test_fold_equals_replay(spark):
    pick, events = random.Random(4), []
    for conv in range(40):
        for seq in range(pick.randrange(1, 30)):
            mid = pick.randrange(1, 5)
            kind = pick.choice(["message", "delta", "delta", "delta", "edit", "regenerate"])
            events.append((conv, mid, seq, kind, "assistant" if mid % 2 == 0 else "user", pick.choice(NASTY)))
    pick.shuffle(events)
    assert texts_of(spark, events) == replay(events)


@pytest.mark.parametrize("hot", [3, 4000])
def test_render_reads_back(spark, hot):
    pick = random.Random(1)
    convs = {c: [(pick.choice(["user", "assistant", "system", "odd\nrole\\", "<|turn|>"]), pick.choice(NASTY)) for _ in range(pick.randrange(1, 8))] for c in range(30)}
    convs[99] = [("user" if k % 2 else "assistant", NASTY[k % len(NASTY)]) for k in range(hot)]
    rows = [(c, t, r, x, "extra") for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    pick.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    rendered = chat.render(chat.fold(chat.as_events(turns)))
    for r in chat.digests(chat.read_back(rendered)).collect():
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == turns_digest(convs[r["conv_id"]])
    for r in rendered.collect():
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert r["formatted"].count("<|turn|>") == r["formatted"].count("<|end|>") == len(convs[r["conv_id"]])
        assert not any(mark in r["formatted"] for mark in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_null_tied_and_repeated_turns(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, None, None, "first"), (None, 2, "assistant", "z")]
    got = {r["conv_id"]: r for r in chat.digests(chat.read_back(chat.render(chat.fold(chat.as_events(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))))).collect()}
    want = {1: [("", "first"), ("user", ""), ("user", "b"), ("user", "b")], None: [("assistant", "z")]}
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == {c: turns_digest(t) for c, t in want.items()}
    assert chat.fold(spark.createDataFrame([], EVENT)).count() == 0


def test_no_python_in_the_plan(spark):
    turns = spark.range(3).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("x").alias("text"))
    plan = chat.digests(chat.read_back(chat.render(chat.fold(chat.as_events(turns)))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


NAV = "<nav><ul><li><a href=/>Home</a><li>News</ul></nav>"
CASES = [
    ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<article><h1>T</h1><p>x <b>y</b>\n z</article><p>out", "T\nx y z"),
    (NAV + "<div>body</div><footer>f</footer>", "body"), ("<article><p>a<div class='Reader-Comments'>c</div><aside>s</aside><p>b</article>", "a\nb"),
    ("<p>1 &lt; 2 &amp;&#65;&eacute;&nosuch;&copy", "1 < 2 &Aé&nosuch;©"), ("<script>var a='</p><p>x';</script><style>p{}</style><p>t", "t"),
    ("<article><p>cut off<foo", "cut off"), ("<article><p>a<!-- c > --><p>b<!-- open", "a\nb"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<p>a<br>b<img src=x>c", "a bc"), ("<main><p>m</main><p>o", "m"), ("<div role=main><p>m</div><p>o", "m"), ("<body class='has-sidebar'><p>a", "a"),
    ("<a href=\"x>y\">q</a> r", "q r"), ("<p title='it>a", "a"), ("<form><p>f</form><div id=cookie-notice>c</div><p>t", "t"), ("</p></div>t", "t"), ("<>a<3", "<>a<3"),
    ("<form><header>h</header><article><p>a</article></form>", "a"), ("<form><h1>T</h1><p>a</form>", "T\na"),
    ("<header>site</header><article><header><h1>T</h1></header><p>a</article>", "T\na"),
    ("<main><h1>T</h1><p>long text of the page</p><article><p>teaser</article></main>", "T\nlong text of the page\nteaser"),
    ("<main><p>intro</p><article><p>long text of the page</article></main>", "long text of the page"),
    ("<article><p>a</p><section class=comments><p>own remark</section><div class=ad>x</div></article>", "a"),
]


@pytest.mark.parametrize("source, text", CASES)
def test_extraction_cases(source, text):
    assert hx.main_text(hx.parse(source), set()) == text


def test_deep_and_long_pages():
    assert hx.main_text(hx.parse("<div>" * 3000 + "x"), set()) == "x"
    assert len(hx.main_text(hx.parse("<p>" + "word " * 400_000), set())) == 1_999_999


def site(n=40):
    """Pages of one host: a box of unknown name on all, a passage in every article, ten copies of one page."""
    rows = []
    for i in range(n):
        words = f"story {i} " * 5
        rows.append((i, f"http://big.example.com/{i}", f"<div class=x1><div>Our offers</div>{words}</div><p>{words}</p><p>quoted by all</p>", words))
    art = "<div class=zz><p>All rights</p></div><article><p>{}</p><p>quoted by all</p><div class=yy>Read on</div></article>"
    rows += [(100 + i, f"http://art.example.com/{i}", art.format(f"text {i}"), None) for i in range(n)]
    rows += [(200 + i, "https://one.example.org/", "<div><p>copied page</p></div>", None) for i in range(10)]
    return rows


def test_template_removal(spark):
    rows = site() + [(300, None, "<div>no host</div>", None), (301, "nonsense", None, None)]
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").withColumn("text", F.lit(1)).repartition(4)
    got = {r["page_id"]: r["text"] for r in hx.extract(pages, keep=["page_id", "url"]).collect()}
    assert len(got) == len(rows)
    for i in range(40):  # without an article what recurs goes; inside one only boxes do
        assert got[i] == (f"story {i} " * 5).strip() + "\n" + (f"story {i} " * 5).strip()
        assert got[100 + i] == f"text {i}\nquoted by all"
    assert {got[200 + i] for i in range(10)} == {"copied page"} and got[300] == "no host" and got[301] == ""
    assert hx.extract(pages.limit(0)).count() == 0


ANCHORS = ("<article><h2 id=search>T {0}</h2><section id=related-work><p>work {0}</section><h2 class=form-validation>V</h2>"
           "<div class='post social'><p>post {0}</div><div data-id=search><p>data {0}</div></article>")


def test_names_are_whole_and_hold_on_every_host(spark):
    """Anchors and classes of the text stay; a named box goes, also with a text of its own. Both on hosts of any size."""
    box = "<article><p>text {0}</p><div class='related'><p>own {0}</p></div><div class='promo'><p>Buy now</p></div></article>"
    rows = [(i, "http://few.example.com/", ANCHORS.format(i)) for i in range(2)] + [(10 + i, "http://big.example.com/", ANCHORS.format(i)) for i in range(40)]
    rows += [(100 + i, "http://two.example.com/", box.format(i)) for i in range(2)] + [(110 + i, "http://box.example.com/", box.format(i)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in hx.extract(pages, keep=["page_id"]).collect()}
    for start, n in ((0, 2), (10, 40)):
        assert all(got[start + i] == f"T {i}\nwork {i}\nV\npost {i}\ndata {i}" for i in range(n))
    for start, n in ((100, 2), (110, 40)):
        assert all(got[start + i] == f"text {i}" for i in range(n))


def test_places_where_texts_take_turns(spark):
    """A slot goes whole if most of its pages show a text that recurs there; a lone text goes with it. Own texts stay."""
    page = "<body><div class=turns>{0}</div><div class=body><p>story {1}</p></div><div>extra {1}</div><div>Our offers</div></body>"
    rows = [(i, "http://a.example.com/", page.format(f"box {i % 6}" if i else "a single box", i)) for i in range(40)]
    rows += [(100 + i, "http://b.example.com/", page.format(f"box {i}", i)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for markup in (True, False):
        got = {r["page_id"]: r["text"] for r in hx.extract(pages, keep=["page_id"], markup=markup).collect()}
        assert all(got[i] == f"story {i}\nextra {i}" and got[100 + i] == f"box {i}\nstory {i}\nextra {i}" for i in range(40))


def test_needed_pages_grow_slowly(spark):
    """A box on 8 of 2,000 pages is a template, as it is on a host of 8; the share of the host's pages says nothing."""
    rows = [(i, "http://big.example.com/", f"<p>story {i}</p>" + ("<div><p>Season sale</p></div>" if i < 8 else "")) for i in range(2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in hx.extract(pages, keep=["page_id"]).collect()}
    assert all(got[i] == f"story {i}" for i in range(2000))


def test_extract_without_broadcast(spark, monkeypatch):
    pages = spark.createDataFrame([r[:3] for r in site()], "page_id long, url string, html string")
    want = sorted(map(tuple, hx.extract(pages, keep=["page_id"]).collect()))
    monkeypatch.setattr(hx, "BROADCAST_HASHES", -1)
    assert sorted(map(tuple, hx.extract(pages, keep=["page_id"]).collect())) == want


def test_registered_queries(spark, tmp_path):
    assert [q for q in queries.queries()] and all(q.split("_")[0][2:].isdigit() for q in queries.queries())
    assert sorted(int(q.split("_")[0][2:]) for q in queries.queries()) == list(range(1, 14))
