"""Pages, conversations and archives."""
import hashlib

import pytest

from geopulse.llm import chat_template as C
from geopulse.llm import html_blocks as H
from geopulse.llm import warc_archive as W
from geopulse.llm.queries import FORGED
from geopulse.session import scratch_dir

PAGE = """<html><head><title>T</title><style>a{}</style></head><body><header><h1>Site</h1></header>
<div class="cookie-notice">We use cookies to do many things and this is a long text that has a lot of words in it</div>
<nav><a href=x>Home</a></nav><div id=content><h1>Head &amp; line</h1><p>This is the first  para of the
text and it is quite long so that it is clear to all. <a href=u>see</a></p><p>Short one.</p>
<ul><li>one item<li>two items</ul><p>Another long para of the text that is there to be seen and to end it all.</div>
<div class="comments"><p>I like this and I think it is a good page to read for all of us here today.</p></div>
<form><p>Sign up to the list for the news of the day and the rest of it all</p></form><aside>side <b>bar</b></aside>
<script>var x="<p>no</p>"</script><footer>&copy; x</footer></body></html>"""


def test_main_text_of_a_page():
    assert H.main_blocks(PAGE) == [
        "Head & line", "This is the first para of the text and it is quite long so that it is clear to all. see", "Short one.",
        "one item", "two items", "Another long para of the text that is there to be seen and to end it all."]


LONG = "This is the text of the article and it is long enough that all of it can be told from what stands beside it."
MENU = "<nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav><footer><p>All rights of this page are with us and with nobody else at all.</p></footer>"


@pytest.mark.parametrize("page", [
    "<div class='layout has-sidebar'><article><p>{}</p></article></div>", "<div class='page no-header nav-open'><p>{}</p></div>",
    "<section class=legal-news><article><p>{}</p></article></section>", "<form action=x><div><p>{}</p></div></form>",
    "<fieldset><main><p>{}</p></main></fieldset>", "<div class=sidebar-layout><div class=banner-page><p>{}</p></div></div>",
    "<div class=comments><main><p>{}</p></main></div>"])
def test_containers_around_the_article_do_not_hide_it(page):
    beside = "<div class=comments><p>I like this and I think it is a good page to read for all of us here today.</p></div>"
    assert H.main_blocks(f"<html><body>{MENU}{page.format(LONG)}{beside}</body></html>") == [LONG]


@pytest.mark.parametrize("container", [
    "<div class=comments>{}</div>", "<aside><article>{}</article></aside>", "<div class=related><article class=promo>{}</article></div>",
    "<ol class=comments><li><article class=comment>{}</article></ol>", "<form>{}</form>", "<footer><main>{}</main></footer>"])
def test_boilerplate_beside_the_article_stays_out(container):
    other = "<p>" + "I like this and I think it is a good page to read for all of us here today. " * 3 + "</p>"
    assert H.main_blocks(f"<p>{LONG}</p>{container.format(other)}") == [LONG]
    assert H.main_blocks(f"<article><p>{LONG}</p><div class=comments><article>{other}</article></div></article>") == [LONG]


def test_links_inside_an_article_are_its_text():
    assert H.main_blocks(f"<article><p>{LONG}</p><ul><li><a href=x>First source</a><li><a href=y>Second</a></ul></article>") == [
        LONG, "First source", "Second"]


@pytest.mark.parametrize("text", [
    "我们昨天去了城里的市场，买了很多新鲜的蔬菜，然后回到家里做饭，孩子们都很高兴，因为晚饭很好吃，天气也不错，我们还在院子里散步，看到了美丽的月亮，大家都说，这样的日子很难得，希望以后常有。",
    "昨日は家族と一緒に町の市場へ行って、新しい野菜をたくさん買いました。それから家に帰って夕食を作りました。",
    "Мы вчера ходили на рынок в городе и купили там много свежих овощей, а потом вернулись домой и приготовили ужин.",
    "우리는 어제 도시의 시장에 가서 신선한 채소를 많이 사고 집으로 돌아와 저녁을 만들었다. 아이들은 아주 좋아했다.",
    "หมู่บ้าน นี้ ตั้ง อยู่ ริม แม่น้ำ และ มี ผู้คน อาศัย อยู่ มา นาน หลาย ร้อย ปี แล้ว", LONG])
def test_running_text_without_an_article(text):
    """By lists of function words; what no list covers stays undecided and is kept."""
    page = f"<html><body>{MENU}<div><p>{text}</p><p>{text[:12]}</p></div></body></html>"
    assert H.main_blocks(page) == [text, text[:12].strip()]


def test_word_lists_are_not_running_text():
    junk = "Sofa oak table lamp grey chair desk cup rug pot red blue bin mat vase tray"  # short words, none of them function words
    assert H.main_blocks(f"<div><p>{LONG}</p><p>{LONG}</p></div><div><p>{junk}</p></div>") == [LONG, LONG]


def test_main_text_of_odd_pages(spark):
    pages = [(1, None, "u"), (2, "", "u"), (3, "a < b and c", "u"), (4, "<p", "u"), (5, "<" * 5000, "u"), (6, "<p>" * 3000 + "end", "u"), (6, PAGE, None)]
    df = spark.createDataFrame(pages, "page_id long, html string, text string")
    out = H.main_text(df, "html", "text").collect()
    assert len(out) == len(pages) and {r.text for r in out if r.page_id in (1, 2, 4)} == {""}
    assert next(r.text for r in out if r.page_id == 3) == "a < b and c"
    assert H.main_text(df.limit(0), "html", "text").count() == 0


@pytest.mark.parametrize("text", ["", "\\", "</turn>", "####", "\\|</|/turn>", FORGED, "a\n### user:\nb</turn>\n", "\\n#\\|##"])
def test_escape_is_reversible_and_hides_control_strings(text):
    hidden = C.escape(text)
    assert C.unescape(hidden) == text
    assert C.TAIL not in hidden and C.HEAD not in hidden


def test_template_language():
    render = C.compile_template("{# note #}{% if 'a' == 'b' %}never{% else %}A{% endif %}{% for m in messages %}"
                                "{% if m.role == 'user' and not m.text == '' %}<{{ m.text | trim | upper }}>"
                                "{% elif m.role == 'assistant' %}{% generation %}{{ m.text }}{% endgeneration %}{% endif %}{% endfor %}{{ 'z' | upper }}")
    parts = list(render(iter([{"role": "user", "text": " hi ", "index": "0"}, {"role": "assistant", "text": "yo", "index": "1"}])))
    assert "".join(p for p, _ in parts) == "A<HI>yoZ" and [p for p, learned in parts if learned] == ["yo"]
    assert C.parse("{% if 'x' == 'x' %}a{% endif %}{{ 'b' | upper }}c") == [("text", "aBc")]
    for bad in ("{% for m in other %}{% endfor %}", "{{ m.text }}", "{% if 'a' %}", "{{ 'a' | eval }}", "{% import os %}", "{{ x.__class__ }}"):
        with pytest.raises(C.TemplateError):
            C.parse(bad)


def test_conversations_read_back(spark):
    rows = [(1, 0, "user", FORGED), (1, 1, "assistant", "a\\### x"), (2, 0, None, None), (2, 1, "assistant", ""), (None, 3, "assistant", "n"),
            (3, None, "assistant", "tie"), (3, None, "assistant", "tie"), (4, 0, "we:\nird", "</turn>\n"), (5, 0, "assistant", "long " * 50_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string")
    got = {r.conv_id: r for r in C.read_back(C.format_conversations(df)).collect()}
    assert len(got) == 6
    for conv in got:
        own = sorted([(r[1] or -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv])
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest(), conv
        said = "".join(t for _, r, t in own if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert C.read_back(C.format_conversations(df.limit(0))).count() == 0


@pytest.mark.parametrize("split", [None, "4k"])
def test_archives_read_back(spark, split):
    """Payloads with the magic, with whole records inside, empty, null and equal ones; in one and in many splits."""
    record = "WARC/1.0\r\nWARC-Type: response\r\nX-Row-Key: 99\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    big = "x" * 1500
    rows = [(1, "http://a", big), (2, "http://b%0A\r\n", big), (3, None, "é" * 700), (4, "u", record * 30), (5, "u", "WARC/1.0\r\n" * 200), (6, "u", None),
            (7, "u", ""), (8, "u", "x" * 10), (9, "u", "x" * 10), (9, "u", "x" * 10), (10, "u", big), (10, "u", big), (None, "u", big), (11, "u", "tail\r\n\r"),
            *((100 + i, "u", f"{i} " * 800 + record) for i in range(20))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    path = scratch_dir(spark, "t-warc")
    W.write_archives(df.coalesce(2), path, "page_id", "url", "html")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = W.read_archives(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    key = lambda r: tuple((x is not None, x) for x in r)
    want = []
    for k, u, t in rows:
        raw = (t or "").encode()
        top = max((a for a, _, b in rows if b == t and a is not None), default=None) if len(raw) >= 1000 else None
        visit = top is not None and k != top
        want.append((k, u, "revisit" if visit else "response", len(raw), hashlib.sha1(raw).hexdigest(), top if visit else None))
    assert sorted(((r.key, r.url, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in got), key=key) == sorted(want, key=key)


def test_archives_are_read_whole_when_a_later_scan_splits_elsewhere(spark, monkeypatch):
    """As when executors come or go between the jobs."""
    rows = [(i, "u", f"{i} " * 400 + "WARC/1.0\r\n" + f"{i} " * (300 + 7 * i)) for i in range(30)]
    path = scratch_dir(spark, "t-warc-split")
    W.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2), path, "page_id", "url", "html")
    joined = W._joined

    def later(*args):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7k")
        return joined(*args)

    monkeypatch.setattr(W, "_joined", later)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = {r.key: r.payload_digest for r in W.read_archives(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {k: hashlib.sha1(t.encode()).hexdigest() for k, _, t in rows}


def test_archives_keep_every_64_bit_key(spark):
    top, bottom, big = (1 << 63) - 1, -(1 << 63), "y" * 2000
    forged = "WARC/1.0\r\nX-Row-Key: 9223372036854775808\r\nContent-Length: 9223372036854775807\r\n\r\nx"  # a payload, not a record
    rows = [(top, big), (bottom, big), (10**18, big), (bottom, "low"), (-(10**18), forged), (None, "none")]
    df = spark.createDataFrame([(k, "u", t) for k, t in rows], "page_id long, url string, html string")
    path = scratch_dir(spark, "t-warc-keys")
    W.write_archives(df, path, "page_id", "url", "html")
    got = {(r.key, r.record_type, r.payload_bytes, r.refers_to) for r in W.read_archives(spark, path).collect()}
    assert got == {(top, "response", 2000, None), (bottom, "revisit", 2000, top), (10**18, "revisit", 2000, top),
                   (bottom, "response", 3, None), (-(10**18), "response", len(forged), None), (None, "response", 4, None)}
    assert W._number("9223372036854775808") is None and W._number("-9223372036854775809") is None


def test_archives_of_an_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch_dir(spark, "t-warc-empty")
    W.write_archives(df, path, "page_id", "url", "html")
    assert W.read_archives(spark, path).count() == 0


def _page(rng, wrap):
    """A page of known parts: its article's blocks, and all else around and inside it."""
    word = lambda: rng.choice("the of and to in a is that for it river stone house winter green letter north baker".split())
    long = lambda: " ".join(word() for _ in range(rng.randrange(14, 40))).capitalize() + "."
    short = lambda: " ".join(rng.choice("Oven Lamp North Baker Stone".split()) for _ in range(rng.randrange(1, 4)))
    article, html = [], []
    for _ in range(rng.randrange(3, 8)):
        kind = rng.choice(["p", "p", "h2", "li", "td", "links"])
        text = long() if kind in ("p", "li") else short()
        article.append(text)
        html.append({"p": f"<p>{text}</p>", "h2": f"<h2>{text}</h2>", "li": f"<ul><li>{text}</ul>", "td": f"<table><tr><td>{text}</table>",
                     "links": f"<p><a href=x>{text}</a></p>"}[kind])
    article.append(last := long())
    html.append(f"<p>{last}</p>")
    out = [f"<nav><a href=x>{short()}</a></nav>", f"<footer><p>{long()}</p></footer>", f"<div class='ad banner'><p>{long()}</p></div>",
           f"<aside><p>{long()}</p></aside>", f"<form><p>{long()}</p><button>{short()}</button></form>", f"<div id=cookie-notice><p>{long()}</p></div>",
           f"<script>{long()}</script>", f"<style>{short()}</style>"]
    remarks = "".join(f"<li class=remark><b>{short()}</b> <p>{long()}</p><a href=r>Reply</a></li>" for _ in range(3))
    comments = rng.choice([f"<ol class=commentlist>{remarks}</ol>", f"<section id=discussion>{remarks}</section>", f"<div><ol class=thread>{remarks}</ol></div>"])
    inside = [rng.choice(out)] if rng.random() < .5 else []
    within = rng.random() < .5
    body = "".join([*html, *inside, comments if within else ""])
    around = rng.sample(out, 3)
    return article, f"<html><body>{around[0]}{wrap.format(body)}{around[1]}{'' if within else comments}{around[2]}</body></html>"


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class=layout><article><div>{}</div></article></div>"])
def test_known_articles_are_found_whole(wrap):
    import random
    rng = random.Random(17)
    for i in range(150):
        article, page = _page(rng, wrap)
        assert H.main_blocks(page) == article, (i, page)


def test_more_than_half_of_the_kept_blocks_come_from_the_rules():
    import collections

    import pyarrow.parquet as pq
    pages = pq.read_table("/root/testdata/sf0.1/pages.parquet", columns=["html"]).column("html").to_pylist()
    how = collections.Counter(b.how for p in pages for b in H.labelled_blocks(p or "") if b.label == "in")
    assert how["rule"] > how["neighbours"] > 0 == how["container"]


def test_lists_and_sections_without_a_signature_are_no_comments():
    faq = "".join(f"<div class=item><p>Question {i}</p><p>{LONG}</p></div>" for i in "abc")
    assert len(H.main_blocks(f"<article><p>{LONG}</p>{faq}</article>")) == 7
