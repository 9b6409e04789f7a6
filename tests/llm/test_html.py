import random
import time

import pytest

from lakeops.llm import html_template
from lakeops.llm.html_template import blocks, classes_of, extract, main_text, templates, text_code

PAGE = "<html><body><header>Site</header><div class='sidebar'>s</div><main><header><h1>T &lt;x&gt;</h1></header><p>One<p>Two <a href=x>link</a><form>f</form><section id=comments><p>c</p></section></main><footer>f</footer></body></html>"


@pytest.mark.parametrize(("page", "text"), [
    (PAGE, "T <x>\nOne\nTwo link"),
    ("<article><h1>A</h1><p><b>B<br><p>C", "A\nB\nC"),
    ("<div class=content><p>Hello &amp; <b>bold</b>\n\n x</p></div><div id=footer>no</div>a < b", "Hello & bold x\na < b"),
    ("<p>x<script>if (a<b) {}</script>y</p><!-- z --><style>p{}</style>", "xy"),
    ("", ""), ("<nav>only</nav>", ""), ("<article><p>cut of", "cut of"), ("</p></div>text", "text"),
    ("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>", "a\nb\n1\n2"),
])
def test_main_text(page, text):
    assert main_text(page, frozenset()) == text


def test_template_text_fills_no_slot(spark):
    pages = [(i, "http://a.example.com/" + str(i), f"<div>Brand line</div><div><p>story {i} {i * 7}</p></div><div>Last line</div>") for i in range(4)]
    df = spark.createDataFrame(pages + [(9, "http://single.example.com/", "<div>Brand line</div><p>x</p>")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract(df).collect()}
    assert got == {**{i: f"story {i} {i * 7}" for i in range(4)}, 9: "Brand line\nx"}


def test_classes_of_a_host(spark):
    rows = [("h", i, f"<div><p>a{i}</p></div>" + "<i>b</i>" * (i == 0)) for i in range(3)]
    df = spark.createDataFrame(rows, "host string, key long, html string")
    only = templates(df).collect()
    assert len(only) == 1 and len(only[0].tokens) == 2  # div and p; the rare tag and the texts are no template


def test_awkward_rows(spark):
    long = "<article>" + "<p>word and word</p>" * 20_000
    rows = [(1, "http://a.b/", PAGE), (1, "http://a.b/", PAGE), (2, None, None), (None, "no url", ""), (3, "http://a.b/x", long)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "page_id long, url string, html string, host int, key int, tokens int")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in extract(df).collect()), key=str)
    assert got == sorted([(1, "T <x>\nOne\nTwo link", 18), (1, "T <x>\nOne\nTwo link", 18), (2, "", 0), (None, "", 0), (3, "\n".join(["word and word"] * 20_000), 14 * 20_000 - 1)], key=str)
    assert extract(df.limit(0)).collect() == []


def texts(spark, rows):
    df = spark.createDataFrame([(i, f"http://{host}/{i}", page) for i, (host, page) in enumerate(rows)], "page_id long, url string, html string")
    return [r.text for r in extract(df).orderBy("page_id").collect()]


def test_copies_keep_their_text(spark):
    story = "<div><p>" + "</p><p>".join(f"passage {k} of one story" for k in range(9)) + "</p></div>"
    plain = story.replace("<div><p>", "").replace("</p></div>", "").replace("</p><p>", "\n")
    near = [("near.example", f"<div>Top</div>{story}<p>copy {i}</p>") for i in range(6)]
    got = texts(spark, [("two.example", story)] * 2 + near)
    assert got == [plain] * 2 + [f"Top\n{plain}\ncopy {i}" for i in range(6)]


def test_layouts_have_templates_of_their_own(spark):
    rows = [("big.example", f"<div class=l{k}><div>Menu of {k}</div><p>own text {k} {i} which no other page has</p></div>") for k in range(3) for i in range(4)]
    assert texts(spark, rows) == [f"own text {k} {i} which no other page has" for k in range(3) for i in range(4)]


def test_deep_pages_take_linear_time():
    """Unclosed tags, deep lists and end tags without a start: eight times the page takes about eight times as long."""
    def seconds(page):
        begin = time.perf_counter()
        blocks(page)
        return time.perf_counter() - begin

    pages = [lambda n: "<div>" * n + "x", lambda n: "<ul><li>" * n + "x", lambda n: "<div>" * n + "<p>a</li></td>" * n, lambda n: "<b>" * n + "<p>x</p>" * n, lambda n: "<ul><li><ul>" + "<div>" * n + "<li>x</li>" * n]
    for page in pages:
        small = min(seconds(page(5_000)) for _ in range(3))
        assert seconds(page(40_000)) < 30 * small + 0.5
    assert len(blocks("<div>" * 200_000 + "x")[1]) == 200_000


def test_classes_against_plain_python(spark):
    rng = random.Random(4)
    rows = []
    for i in range(12):
        body = "".join(f"<div class=k{k}><p>{rng.choice(['one', 'two'])} {k}</p></div>" for k in range(6) if rng.random() < 0.7)
        rows.append(("h", i, f"<main>{body}</main>" if rng.random() < 0.2 else body))
    got = templates(spark.createDataFrame(rows, "host string, key long, html string")).collect()
    seen = {}
    for _, i, page in rows:
        text, tags, outer = blocks(page)
        for code in (*tags, *(text_code(p, t) for p, t, beside, core in text if beside or not core)):
            vector = seen.setdefault(code, {})
            vector[i] = vector.get(i, 0) + 1
    want = {}
    for code, vector in seen.items():
        if len(vector) >= 6:  # on two pages and half of the host's
            want.setdefault(tuple(sorted(vector.items())), set()).add(code)
    found = [members for layout, members in classes_of(*(got[0][c] for c in ("tokens", "layouts", "vectors"))) if layout == 0]
    assert sorted(map(sorted, found)) == sorted(map(sorted, want.values()))
    sizes = [len(next(v for v, m in want.items() if m == members)) for members in found]
    assert sizes == sorted(sizes, reverse=True)


def test_large_templates_travel_by_a_join(spark, monkeypatch):
    pages = [(i, f"http://a.example.com/{i}", f"<div>Brand line</div><div><p>story {i} {i * 7}</p></div>") for i in range(6)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    known = extract(df).orderBy("page_id").collect()
    monkeypatch.setattr(html_template, "TEMPLATE_BYTES", -1)
    assert extract(df).orderBy("page_id").collect() == known
