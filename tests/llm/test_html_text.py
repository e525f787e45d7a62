"""Operator 1: tree matching against brute force, induced wrappers, messy pages."""

import random

from sparkledger.llm import html_text as ht


def test_main_text_of_a_messy_page():
    page = (
        '<html><body class="has-sidebar"><header><h1>Site</h1><nav>m</nav></header><div id=cookie-notice>cookies</div><!-- <p>no</p> -->'
        '<div class="layout sidebar-left"><main><article class=post><header><h1>T &amp; t</h1></header><p>One<br>two &lt;b&gt; &nbsp;x<p>Three <b>bo<i>ld</b></i> a &#233;</p>'
        '<script>var s="</p><p>code"</script><ul><li>a<li>b</ul><div class="ad-slot">buy</div><table><tr><td>1<td>2</table><section id="comments"><p>c</section><form>f</form>'
        "</article></main><aside>s</aside></div><footer>f</footer>"
    )
    assert ht.main_text(page) == "T & t\nOne two <b> x\nThree bold a é\na\nb\n1\n2"
    assert ht.main_text(None) == "" and ht.main_text("") == "" and ht.main_text("<p>") == ""
    assert ht.main_text("plain < text & more") == "plain < text & more"
    assert ht.main_text("<article><p>cut off <b title='x") == "cut off"
    assert len(ht.main_text("<article>" + "<p>word</p>" * 20000)) == 5 * 20000 - 1


def tree(label, *children):
    t = ht.Slot(label)
    t.children = list(children)
    return t


def brute(a, b):
    if a.label != b.label:
        return 0

    def seq(i, j):
        if i == len(a.children) or j == len(b.children):
            return 0
        return max(seq(i + 1, j), seq(i, j + 1), (brute(a.children[i], b.children[j]) or -1) + seq(i + 1, j + 1))

    return 1 + seq(0, 0)


def test_simple_tree_matching():
    rng = random.Random(7)

    def make(depth):
        return tree(rng.choice("ab"), *(make(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)))

    for _ in range(200):
        a, b = make(3), make(3)
        score, pairs = ht.match(a, b)
        assert score == brute(a, b)
        assert len(pairs) == score


def pages(spark, n=40):
    rng = random.Random(8)
    sentence = lambda: " ".join(rng.choice("house river stone garden walks under every morning".split()) for _ in range(9)) + "."
    rows, want = [], {}
    for i in range(n):
        body = [sentence() for _ in range(rng.randint(2, 5))]
        want[i] = "\n".join([f"Title {i}", *body])
        inner = "".join(f"<p>{p}</p>" for p in body)
        rows.append((i, f"https://u:p@News.example.org:80/a/{i}", f"<html><body><nav>menu</nav><article><h1>Title {i}</h1><div class=x>Read more stories on our site today</div>{inner}<div>Thanks for reading and good bye</div></article></body></html>"))
    rows += [(100, None, "<article><p>Read more stories</p></article>"), (101, "nonsense", None), (102, "https://lone.example.com/", "<article><p>Only one page here.</p></article>"), (102, "https://lone.example.com/", "<article><p>Only one page here.</p></article>")]
    want |= {100: "Read more stories", 101: "", 102: "Only one page here."}
    return want, spark.createDataFrame([(*r, 3) for r in rows], "page_id long, url string, html string, n_chars int").repartition(3)


def test_template_nodes_of_a_host_go(spark):
    want, df = pages(spark)
    got = ht.extract(df).collect()
    assert len(got) == len(want) + 1
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)


def test_copies_do_not_make_a_template(spark):
    page = "<article><h1>Same</h1><p>The same long article text on every page of the host.</p></article>"
    df = spark.createDataFrame([(i, "http://copy.example.net/x", page) for i in range(30)], "page_id long, url string, html string")
    assert {r.text for r in ht.extract(df).collect()} == {"Same\nThe same long article text on every page of the host."}
    assert ht.extract(df.limit(0)).count() == 0


def test_deep_pages():
    for tag in ("div", "b", "section class=menu", "main", "article"):
        name = tag.split()[0]
        text = ht.main_text(f"<{tag}>" * 20000 + "<p>deep words</p>" + f"</{name}>" * 20000)
        assert text == ("" if "menu" in tag else "deep words")
    deep = "<article>" + "<div>" * 8000 + "<p>x"
    trees = [ht.layout(ht.main_node(ht.parse(deep + end)))[0] for end in (" one", " two")]
    score, pairs = ht.match(*trees)
    assert score == len(pairs) == 8002
    assert ht.numbers(trees[0], ht.pack(trees[1])) == {n: n for n in range(8002)}
    assert ht.main_text("<article><p>a" + "<b>" * 20000 + "b<p>c") == "ab\nc"


def test_names_that_only_share_a_word_with_chrome():
    page = "<article><section class='social-history'><p>a</p></section><div class='recommended-reading'>b</div><div class='share-buttons'>c</div><div id='cookie-notice'>d</div><div class='ad-300x250'>e</div></article>"
    assert ht.main_text(page) == "a\nb"


def test_pages_that_share_a_notice_still_make_a_wrapper(spark):
    rng = random.Random(9)
    sentence = lambda: " ".join(rng.choice("house river stone garden walks under every morning".split()) for _ in range(12)) + "."
    notices = sorted((sentence() for _ in range(300)), key=lambda t: ht.zlib.crc32(t.encode()))
    rows = [(i, "http://n.example.org/", f"<article><div class=x>{notices[0]}</div>" + "".join(f"<p>{sentence()}</p>" for _ in range(4)) + "</article>") for i in range(500)]
    got = ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert got.where(got.text.contains(notices[0])).count() == 0


def test_slots_of_a_layout():
    page = "<div id='post-17'><h1>t</h1><p>a<p>b</p><ul><li>x<li>y</ul><p>c</p><ul><li>z</ul><ul><li>v</ul></div>"
    root, found = ht.layout(ht.main_node(ht.parse(page)))
    by = {}
    for b in found:
        by.setdefault(b.slot.number, []).append(b.text)
    assert list(by.values()) == [["t"], ["a", "b"], ["x", "y"], ["c"], ["z", "v"]]
    other = ht.unpack(ht.pack(root))
    assert [(d, s.label, s.number) for d, s in ht.walk(other)] == [(d, s.label, s.number) for d, s in ht.walk(root)]
    again, _ = ht.layout(ht.main_node(ht.parse(page.replace("17", "204"))))
    assert ht.pack(again) == ht.pack(root)


def varied(n=60, host="v.example.org"):
    """Pages without a telling tag or class whose menus hold other texts on every page."""
    rng = random.Random(12)
    words = "house river stone garden walks under every morning letter summer window".split()
    some = lambda k: " ".join(rng.choice(words) for _ in range(k))
    rows, want = [], {}
    for i in range(n):
        links = "".join(f"<li><a href=/{i}>{some(2)}</a>" for _ in range(rng.randint(3, 7)))
        topics = "".join(f"<div>{some(1)}</div>" for _ in range(rng.randint(3, 5)))
        line = " | ".join(f"<a href=/{i}>{some(1)}</a>" for _ in range(rng.randint(2, 5)))
        body = [some(rng.randint(8, 30)) + "." for _ in range(rng.randint(1, 6))]
        body[0] = f'See <a href="/x">{some(2)}</a> and <a href="/y">{some(1)}</a> for {body[0]}'
        want[i] = "\n".join([f"About {i}", *(ht.main_text(f"<p>{b}") for b in body)])
        paragraphs = "".join(f"<p>{b}</p>" for b in body)
        rows.append((i, f"http://{host}/{i}", f"<body><div class=a1><ul>{links}</ul></div><div class=b7>{topics}</div><div class=c3><h1><a href=/{i}>About {i}</a></h1>{paragraphs}</div><div class=d2>{line}</div><div class=e5>All rights with us</div></body>"))
    return rows, want


def test_varying_menus_without_a_telling_name_go(spark):
    rows, want = varied()
    lone, _ = varied(3, "few.example.org")
    df = spark.createDataFrame(rows + [(1000 + i, u, h) for i, u, h in lone], "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in ht.extract(df).collect()}
    assert {i: got[i] for i in want} == want
    for i, _, page in lone:  # too few pages for a wrapper: nothing is dropped
        assert got[1000 + i] == ht.main_text(page)


def test_lists_of_an_article_stay(spark):
    rng = random.Random(13)
    rows = []
    for i in range(40):
        items = "".join(f"<li>{rng.choice(['salt', 'flour', 'milk', 'eggs'])} {rng.randint(1, 900)}" for _ in range(4))
        rows.append((i, "http://r.example.org/", f"<article><h1>Cake {i}</h1><ul>{items}</ul><p>Mix <a href=a>all</a> {i} times.</p></article>"))
    got = {r.page_id: r.text for r in ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: ht.main_text(h) for i, _, h in rows}


def test_wrapper_counts_equal_brute_force(spark):
    rows, _ = varied(30)
    df = spark.createDataFrame(rows * 3, "page_id long, url string, html string").repartition(5)
    found = ht.wrappers(df).collect()
    assert len(found) == 1
    reference, drops = bytes(found[0].reference), {(d.slot, d.txt) for d in found[0].drops}
    hits, pages = {}, 0
    for _, _, page in rows:
        main = ht.main_node(ht.parse(page))
        root, blocks = ht.layout(main)
        to, pages = ht.numbers(root, reference), pages + 1
        by = {}
        for b in blocks:
            by.setdefault(b.slot.number, []).append(b)
        for n, held in by.items():
            if n in to:
                size, menu = hits.setdefault((to[n], 0), [0, 0])
                hits[to[n], 0] = [size + 1, menu + ht.is_menu(held, main.tag != "#")]
                for t in {ht.digest(b.text) for b in held}:
                    hits.setdefault((to[n], t), [0, 0])[0] += 1
    want = {k for k, (n, menu) in hits.items() if (k[1] == 0 and n >= ht.LEAST_PAGES and menu >= ht.CONSTANT * n) or (k[1] != 0 and n >= ht.CONSTANT * pages)}
    assert drops == want and len(want) == 4
