"""Main text: parsing rules, the merged tree of a host, and the query against a plain version."""

import html
import math
import random
import re
from collections import Counter

import pytest

from vacantia.llm import pages, queries


def text_of(page):
    return " ".join(t for _, t, _, role in pages.blocks(page) if role < 2)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>a<b>b</b>c<br>d<p>e", "abc d e"),
        ("<article><p>1 &lt; 2 &amp &copy;&#233;</p></article>", "1 < 2 & ©é"),
        ("<nav>x</nav><p>y</p><footer>z</footer><aside>q</aside>", "y"),
        ("<header>x</header><article><header><h1>t</h1></header>y</article>", "t y"),
        ("<script>var t='</p>';<b></script>a<style>p{}</style>b<!-- c > d -->e", "a be"),
        ("<div class='side-bar ad'>x</div><div id=comments>y</div><div role=\"search\">s</div>z", "z"),
        ("<body class='has-sidebar'><div class='layout with-sidebar'>k</div></body>", "k"),
        ("<div class='menu'><main>kept</main>also</div>", "kept also"),
        ("<aside><article>teaser</article></aside><article>own</article>", "own"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"),
        ("<p title='a > b'>x</p><p title=\"it's\">y", "x y"),
        ("a < b <3 <", "a < b <3 <"),
        ("<title>t</title><h1>h</h1><form>f<input></form><p", "h"),
        ("x <span class=cookie-notice>accept</span> y", "x y"),
        ("", ""), (None, ""), ("<!--", ""), ("<script>", ""), ("</p></div>a", "a"),
    ],
)
def test_blocks(page, text):
    assert text_of(page) == text


def test_long_pages_stay_linear():
    for page in ("<div>" * 30_000 + "x", "<p a='" * 3000, "<" * 200_000, "<p>a" * 50_000, "&amp" * 100_000):
        pages.blocks(page)


def plain(page):
    article = page[page.index("<article>") + 9 : page.index("</article>")]
    article = re.sub(r"</?b>", "", article)
    return " ".join(html.unescape(re.sub(r"<br>|</?(p|h1)>", " ", article)).split())


def test_query_equals_plain_version(spark, folder):
    rows = {r["page_id"]: r for r in queries.QUERIES["op4_html_extraction"](spark, folder).collect()}
    source = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(rows) == len(source)
    for r in source:
        got = rows[r["page_id"]]
        assert (got["text"], got["n_chars"], got["url"]) == (plain(r["html"]), len(plain(r["html"])), r["url"])


def _frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "page_id long, url string, html string" + extra)


def test_site_tree_removes_common_branches(spark):
    rows = [
        (i, f"http://Site.example/p{i}", f"<div class=x{i}>top</div><div class=lead>Follow us</div><div class=own>Story {i} {'abc' * i}</div>")
        for i in range(40)
    ]
    rows += [(100, "http://lone.example/", "<div class=lead>Follow us</div><div>One</div>")]
    rows += [(200 + i, "http://copies.example/", "<div>Same page</div>") for i in range(50)]
    got = {r["id"]: r["text"] for r in pages.main_text(_frame(spark, rows)).collect()}
    assert all(got[i] == f"Story {i} {'abc' * i}".strip() for i in range(40))
    assert got[100] == "Follow us One" and got[220] == "Same page"


def test_odd_rows(spark):
    rows = [(1, None, "<p>a"), (2, "u", None), (None, "http://h/", ""), (3, "http://h/", "<p>" + "x " * 100_000)] * 2
    frame = _frame(spark, [r + ("c", "d") for r in rows], ", text string, blocks string")
    got = sorted((str(r["id"]), len(r["text"])) for r in pages.main_text(frame).collect())
    assert got == sorted([("1", 1), ("2", 0), ("None", 0), ("3", 199_999)] * 2)
    assert pages.main_text(_frame(spark, [])).collect() == []


def test_copies_do_not_outvote_other_articles(spark):
    """Ninety copies of an article weigh as one page, so ten others of the host keep their text."""
    page = "<div class=t>{0} title</div><div class=b>{0} text of its own</div><div class=n>item {1}</div><div class=f>Follow us</div>"
    rows = [(i, "http://h.example/", page.format("Copied", 0)) for i in range(90)]
    rows += [(90 + i, "http://h.example/", page.format("abcdefghij"[i], i)) for i in range(10)]
    got = {r["id"]: r["text"] for r in pages.main_text(_frame(spark, rows)).collect()}
    assert all(got[i].startswith("Copied title Copied text of its own") and "Follow" not in got[i] for i in range(90))
    for i in range(10):
        assert got[90 + i].startswith("{0} title {0} text of its own".format("abcdefghij"[i])) and "Follow" not in got[90 + i]


def test_ambiguous_names_are_a_prior(spark):
    assert text_of("<div class=post-header>t</div><div class=article-footer>f</div>b") == "t b"
    legal = "<div class='product-menu-legal'>The legal text {}</div>"
    teasers = "<div class=related><a href=x>Teaser {}</a></div>"
    rows = [(0, "http://one.example/", legal.format(0))]
    rows += [(i, "http://law.example/", "<p>p" + "q" * i + legal.format("q" * i) + teasers.format("q" * i)) for i in range(1, 20)]
    rows += [(20 + i, "http://shop.example/", "<p>p" + "q" * i + legal.format("")) for i in range(1, 20)]
    got = {r["id"]: r["text"] for r in pages.main_text(_frame(spark, rows)).collect()}
    assert got[0] == "The legal text 0"
    for i in range(1, 20):
        # Texts of its own on every page outvote the name; a text on every page, or a list of links, does not.
        assert got[i] == f"p{'q' * i} The legal text {'q' * i}" and got[20 + i] == f"p{'q' * i}"


def tree_text(rows, limit=pages.MIN_IMPORTANCE, least=pages.MIN_PAGES):
    """The same tree over dictionaries, host by host; pages of elements without ambiguous names only."""
    parsed = [(i, url, [(n, t, s) for n, t, s in pages._blocks(p) if n.role != 2]) for i, url, p in rows]
    out = {}
    for host in {url for _, url, _ in parsed}:
        own = [(i, b) for i, url, b in parsed if url == host]
        different = {tuple(sorted((n.path, t) for n, t, _ in b)): b for _, b in own}.values()
        count, styles, on, ups, inline = Counter(), Counter(), Counter(), {}, {}
        for b in different:
            count.update({(n.path, t) for n, t, _ in b})
            styles.update({(n.path, s) for n, _, s in b})
            on.update({n.path for n, _, _ in b})
            for n, _, s in b:
                ups[n.path] = {(up, n.depth - k) for k, up in enumerate(n.chain, 1)}
        worth = {}
        for path, m in on.items():
            ks = [k for (p, _), k in count.items() if p == path]
            ss = [(k, s.count(",") + bool(s)) for (p, s), k in styles.items() if p == path]
            if m == 1:
                worth[path] = 1.0
                continue
            content = 1 - sum(k * math.log(k) for k in ks) / sum(ks) / math.log(m)
            n = sum(k for k, _ in ss)
            shown = min(1.0, -sum(k / n * math.log(k / n) for k, _ in ss) / math.log(m))
            weight = pages.GAMMA ** (sum(k * i for k, i in ss) / n)
            worth[path] = (1 - weight) * shown + weight * content
        noisy = set()
        for up in {u for us in ups.values() for u, _ in us}:
            under = [(p, g) for p, us in ups.items() for u, g in us if u == up]
            shares = [(on[p] * pages.GAMMA**g, worth[p]) for p, g in under]
            known = [worth[p] for p, _ in under if on[p] >= least]
            if known and max(known) < limit and sum(a * b for a, b in shares) / sum(a for a, _ in shares) < limit:
                noisy.add(up)
        for i, b in own:
            left = [t for n, t, _ in b if n.role == 1 or count[n.path, t] < 2 or not noisy & {u for u, _ in ups[n.path]}]
            out[i] = " ".join(left or [t for _, t, _ in b])
    return out


def test_main_text_equals_brute_force_tree(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        host = rng.choice(["a", "a", "b", "c"])
        words = lambda k, n: " ".join(rng.choice("tuvwxyz") for _ in range(k)) + f" {rng.randrange(n)}"
        top = "".join(f"<li class={rng.choice('pqr')}><a>{words(0, 4)}</a>" for _ in range(rng.randrange(4)))
        body = "".join(f"<p>{'<b>x</b>' * rng.randrange(3)}{words(2, 50)}" for _ in range(rng.randrange(4)))
        side = f"<div class=s{rng.choice('mn')}>{words(0, 2)}<div class=in>{rng.choice(['Same', 'Same', words(1, 9)])}</div></div>"
        tail = "<article><p>" + words(3, 9) + "</article>" if rng.random() < 0.2 else ""
        rows.append((i, f"http://{host}.example/", f"<div class=top><ul>{top}</ul></div><div class=body>{body}</div>{side}<div class=end>End</div>{tail}"))
    rows += [(300 + i, *rows[3][1:]) for i in range(40)]
    want = tree_text([(i, url, p) for i, url, p in rows])
    got = {r["id"]: r["text"] for r in pages.main_text(_frame(spark, rows)).collect()}
    assert got == want
    whole = {i: " ".join(t for _, t, _, _ in pages.blocks(p)) for i, _, p in rows}
    assert sum(got[i] != whole[i] for i in got) > 200
