"""HTML extraction: wrappers, odd markup, boilerplate of many kinds."""

import random

from marginlens.llm import wrappers

SCHEMA = "page_id long, url string, html string, host string, decision string, salt int"


def words(rnd, n):
    return " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "été", "x"]) + str(rnd.randint(0, 999)) for _ in range(n))


def page(rnd, kind):
    title, paras = words(rnd, 5), [words(rnd, rnd.randint(5, 60)) for _ in range(rnd.randint(1, 9))]
    comments = "".join(f'<div class="comment"><p>{words(rnd, 9)}</p></div>' for _ in range(rnd.randint(0, 4)))
    nav = "<nav><ul>" + "".join(f"<li><a href='/{i}'>{words(rnd, 1)}</a></li>" for i in range(rnd.randint(2, 6))) + "</ul></nav>"
    head = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body>'
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p.replace(' ', ' <b>', 1)}</b>\n" for p in paras)
    if kind == 0:
        html = f'{head}{nav}<div class="ad">{words(rnd, 8)}</div><article>{body}</article><section class="comments">{comments}</section><footer>&copy; x</footer></body></html>'
    elif kind == 1:
        html = (f'{head}<div class="header"><div>My site</div></div><div class="cookie-notice">We use cookies</div><div id="wrap"><div id="content">{body}</div>'
                f'<div id="sidebar"><ul><li>{words(rnd, 3)}</li></ul></div>{comments}</div><form><input><button>Send</button></form><footer>f</footer>')
    else:
        html = f'{head}{nav}<main><aside>{words(rnd, 9)}</aside><article>{body}<div class="share">Share this page</div></article>{comments}</main><noscript>On</noscript>'
    return html, "\n".join([title, *paras])


def test_articles_come_out_whole(spark):
    rnd = random.Random(1)
    rows, want = [], {}
    for i in range(240):
        kind = i % 3
        html, text = page(rnd, kind)
        rows.append((i, f"http://Site{kind}.example.org:80/{i}", html, "h", "d", 1))
        want[i] = text
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = wrappers.extract_articles(df, wrappers.infer_wrappers(df))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert len(rows) == 240
    wrong = [(r.page_id, r.text, want[r.page_id]) for r in rows if r.text != want[r.page_id]]
    assert not wrong, wrong[0]
    assert all(r.n_chars == len(r.text) for r in rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", 0)
    rows = [(None, None, None), (1, "", ""), (1, "", ""), (2, "not a url", "plain &amp; simple\n text"), (3, "http://a/", "<p>unclosed <b>bold"),
            (4, "http://a/", "<div>" * 3000 + "deep" + "</div>" * 10), (5, "http://b/", "<<p>a<br>b</i></div></p> < 5 &lt;&#x41;&nbsp;z <a href=\"x>q"),
            (6, "http://c/", "<p>" + "long text " * 100_000), (7, "http://d/", "<script>if (a<b) '</p>'"), (8, "http://e/", "<!-- open <p>x")]
    df = spark.createDataFrame([(*r, "h", "d", 1) for r in rows], SCHEMA)
    got = wrappers.extract_articles(df, wrappers.infer_wrappers(df)).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[None] == by[1] == by[7] == by[8] == ""
    assert by[2] == "plain & simple text" and by[3] == "unclosed bold" and by[4] == "deep"
    assert by[6] == ("long text " * 100_000).strip()
    assert by[5].startswith("<") and "a b" in by[5] and "< 5 <A z" in by[5]
    empty = df.limit(0)
    assert wrappers.extract_articles(empty, wrappers.infer_wrappers(empty)).collect() == []


def test_wrapper_is_a_union_free_expression():
    def one(body):
        return wrappers.wrapper_of(wrappers.parse(f"<body>{body}</body>"))

    w = wrappers.merge(one("<h1>Same</h1><p>a<p>b"), one("<h1>Same</h1><div>c</div><p>d"), True)
    assert wrappers.pattern(w) == "<><body><h1>'Same'</> <div>'c'</>? <p>#</>+</></>"
    assert wrappers.pattern(one("<h2>a</h2><p>b</p><h2>c</h2><p>d</p>")) == "<><body>(<h2>#</> <p>#</>)+</></>"


def test_tokens_are_linear_in_odd_pages():
    wrappers.parse("<a href='" * 20_000)
    wrappers.parse("<p " * 20_000 + "\"" * 20_000)
    wrappers.parse("<script>" * 5_000)


def test_closings_match_at_any_nesting():
    def text(html):
        tree = wrappers.parse(html)
        return wrappers.extract(tree, wrappers.decide(wrappers.wrapper_of(tree)))

    for n in (10, 57, 58, 59, 60, 70, 5000):
        deep = "<div>" * n + "x{}y" + "</div>" * n
        page = "<div id=page><nav>n</nav><article><p>a</p>" + deep + "<p>b</p></article><p>after</p></div>"
        assert text(page.format("")) == "a\nxy\nb"
        for block in ("<aside>n<div>n</div>n</aside>", "<nav><nav>n</nav><article>n</article>n</nav>", "<div class=comments><p>n</div>",
                      "<div><div></p></section></div><form><ul><li>n</ul></form></div>"):
            assert text(page.format(block)) == "a\nx\ny\nb", (n, block)
        far = "<body><p>n</p>" + "<div>" * n + "<nav>n</nav><main><aside>n</aside><article><p>a b c</p><div>d</div></article>n</main>n" + "</div>" * n
        assert text(far) == "a b c\nd"


def test_fixed_texts_stay_on_any_number_of_pages():
    rnd = random.Random(2)
    for n in (1, 2, 4, 5, 40):
        want, trees = [], []
        for _ in range(n):
            paras = [words(rnd, 30) for _ in range(3)]
            trees.append(wrappers.parse(
                f"<body><nav>n</nav><article><h1>T</h1><p>{paras[0]}</p><figure><figcaption>Photo: staff</figcaption></figure><div>Ingredients</div>"
                f"<p>{paras[1]}</p><section>Method<p>{paras[2]}</p></section><div class=share>Share</div></article><footer>f</footer>"))
            want.append("\n".join(["T", paras[0], "Photo: staff", "Ingredients", paras[1], "Method", paras[2]]))
        merged = wrappers.wrapper_of(trees[0])
        for tree in trees[1:]:
            merged = wrappers.merge(merged, wrappers.wrapper_of(tree), True)
        decision = wrappers.decide(merged)
        assert [wrappers.extract(tree, decision) for tree in trees] == want


def unmarked_site(rnd, n):
    """A host whose boilerplate has no marks: menu, notice, sign-up and imprint are only the same on its pages."""
    pages = []
    for i in range(n):
        title, paras = words(rnd, 4), [words(rnd, 20) for _ in range(rnd.randint(2, 6))]
        body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paras)
        more = f"<ul><li><a href=x>{words(rnd, 3)}</a></li><li><a href=y>{words(rnd, 3)}</a></li></ul>" if i % 2 else ""
        pages.append((f"<body><div><ul><li><a>Home</a></li><li><a>News</a></li></ul></div><div>We use cookies on this site</div>"
                      f"<div>{body}<p>Sign up for our letter</p></div><div>{more}</div><div>Imprint</div></body>", "\n".join([title, *paras])))
    return pages


def by_hand(pages):
    """One host in plain Python: fixed texts, one wrapper of all pages, its article."""
    from collections import Counter

    trees = [wrappers.parse(p) for p in pages]
    seen = Counter(k for tree in trees for k in {wrappers.text_key(t) for t in wrappers.texts_of(tree)})
    fixed = frozenset(k for k, n in seen.items() if n > 1 and 2 * n >= len(pages))
    trees = [wrappers.marked(tree, fixed) for tree in trees]
    merged = wrappers.wrapper_of(trees[0])
    for tree in trees[1:]:
        merged = wrappers.merge(merged, wrappers.wrapper_of(tree), True)
    decision = wrappers.decide(merged)
    return [wrappers.extract(tree, decision) for tree in trees]


def test_unmarked_boilerplate_goes_by_the_hosts_wrapper(spark):
    rnd = random.Random(9)
    rows, want = [], {}
    for host in range(3):
        for i, (html, text) in enumerate(unmarked_site(rnd, 2 if host == 2 else 40)):
            rows.append((100 * host + i, f"https://h{host}.example/{i}", html, "h", "d", 1))
            want[100 * host + i] = text
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.page_id: r.text for r in wrappers.extract_articles(df, wrappers.infer_wrappers(df)).collect()}
    assert got == want
    for host in range(3):
        own = [r for r in rows if r[0] // 100 == host]
        assert by_hand([r[2] for r in own]) == [want[r[0]] for r in own]
    # A page's own wrapper knows no other page: what its host's wrapper drops stays.
    for r in rows:
        assert by_hand([r[2]])[0] != want[r[0]] and "Sign up" in by_hand([r[2]])[0]


def test_names_are_whole():
    inside = ('<section id="side-effects">a1</section><div class="share-price">a2</div><section class="related-work">a3</section>'
              '<div id="menu-of-the-day">a4</div><section id="search-results">a5</section><div class="copyright-law">a6</div>'
              '<p id="comment-on-method">a7</p><p class="widget-count">a8</p>')
    assert by_hand([f"<body><article><h1>T</h1>{inside}</article></body>"]) == ["T\na1\na2\na3\na4\na5\na6\na7\na8"]
    assert by_hand(['<article>x<div class="big ad">n</div><div id=comments>n</div><ul class="share">n</ul></article>']) == ["x"]


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_a_longest_common_subsequence(monkeypatch):
    rnd = random.Random(4)
    for bits in (1 << 30, 8):
        monkeypatch.setattr(wrappers, "BITS", bits)
        for _ in range(400):
            a, b = ([rnd.choice("abcd"[:rnd.randint(1, 4)]) for _ in range(rnd.randint(0, 14))] for _ in range(2))
            pairs = wrappers._matches(a, b)
            assert all(a[i] == b[j] for i, j in pairs) and len(pairs) == lcs(a, b)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_thousands_of_irregular_siblings():
    import time

    def one(seed):
        rnd = random.Random(seed)
        tags = (rnd.choice(["div", "p", "section", "ul", "h2", "table", "ol", "dl", "h3"]) for _ in range(4000))
        return wrappers.wrapper_of(wrappers.parse("<body>" + "".join(f"<{t}>x{rnd.random()}</{t}>" for t in tags) + "</body>"))

    a, b = one(1), one(2)
    start = time.perf_counter()
    merged = wrappers.merge(a, b, True)
    assert time.perf_counter() - start < 1
    assert max(map(len, (merged[wrappers.CHILDREN][0][wrappers.CHILDREN],))) <= wrappers.CHILDREN_KEPT
