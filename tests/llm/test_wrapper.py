import time

import pytest

from cataloom.llm import wrapper

PAGES = "page_id bigint, url string, html string, host string, tree int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()


def page(n, body, main="<div id='c'>{}</div>"):
    sentences = "".join(f"<p>{WORDS[(n * 7 + k) % 14]} {n} says {WORDS[(n + k * 3) % 14]}" for k in range(3 + n % 3))
    return (
        f"<html><head><title>t{n}</title><style>p{{}}</style></head><body>"
        "<div><p>Our site is the best</p><p>Buy now</p></div>"
        + main.format(f"<h1>Title {n}</h1>{sentences}<p>Read more on our site every day</p>{body}")
        + "<div><p>All about us</p></div></body></html>"
    )


def said(n):
    lines = [f"{WORDS[(n * 7 + k) % 14]} {n} says {WORDS[(n + k * 3) % 14]}" for k in range(3 + n % 3)]
    return "\n".join([f"Title {n}", *lines])


def extracted(spark, rows):
    df = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], PAGES)
    found = {}
    for r in wrapper.extract_text(df.repartition(3)).collect():
        assert r["n_chars"] == len(r["text"])
        found.setdefault(r["page_id"], []).append(r["text"])
    return found


def test_template_goes_and_slots_stay(spark):
    rows = [(n, f"https://U@Host.example:80/{n}", page(n, "")) for n in range(1, 20)]
    found = extracted(spark, rows)
    for n in range(1, 20):
        assert found[n] == [said(n)]


def test_copies_are_no_evidence_of_a_template(spark):
    copies = [(n, "https://h.example/a", page(3, "")) for n in range(100, 140)]
    found = extracted(spark, copies)
    for n in range(100, 140):
        assert said(3) in found[n][0]


def test_odd_pages(spark):
    rows = [
        (1, "https://a.example/", None),
        (2, None, ""),
        (3, "no url", "plain text &amp; more"),
        (4, "https://a.example/", "<" * 50),
        (5, "https://a.example/", "<div>" * 3000 + "deep" + "</div>" * 3000),
        (6, "https://b.example/", "<p>" + "long words " * 60000),
        (7, "https://c.example/", "<body><article><p>a&nbsp;\n b<br>c<p>d</article><aside>no</aside>"),
        (7, "https://c.example/", "<body><article><p>a&nbsp;\n b<br>c<p>d</article><aside>no</aside>"),
        (None, "https://d.example/", "<main>text</main>"),
    ]
    found = extracted(spark, rows)
    assert found[1] == [""] and found[2] == [""]
    assert found[3] == ["plain text & more"]
    assert found[5] == ["deep"]
    assert found[6] == [("long words " * 60000).strip()]
    assert found[7] == ["a b c\nd"] * 2
    assert found[None] == ["text"]
    assert extracted(spark, []) == {}


@pytest.mark.parametrize(
    ("markup", "text"),
    [
        ("<p>a</p>b<p>c</p>", "a\nb\nc"),
        ("<ul><li>a<li>b</ul>", "a\nb"),
        ("<p>one <b>two</b> <i>three</i><script>x<y</script>four</p>", "one two threefour"),
        ("<nav>n</nav><header>h</header><p>x</p><footer>f</footer>", "x"),
        ("<p>x</p><div class='comments'>c</div><div id='cookie-notice'>k</div>", "x"),
        ("<p>x</p><div class='ad'>a</div><div class='sidebar left'>s</div><form>f</form>", "x"),
        ("<div class='has-sidebar'><p>x</p></div>", "x"),
        ("<p>x <span class='share'>s</span>y</p>", "x y"),
        ("<p>1 &lt; 2 &#233; &eacute;</p><!-- <p>no</p> -->", "1 < 2 é é"),
        ("<p title='a>b'>x</p><p title=\"a'>y</p>", "x\ny"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<TEXTAREA><p>no</TEXTAREA><P>Yes", "Yes"),
    ],
)
def test_blocks_and_boilerplate(markup, text):
    assert wrapper.extract(f"<html><body>{markup}</body></html>", None) == text


def best_match(a, b):
    """Simple tree matching by its definition, on (label, children)."""
    if a[0] != b[0]:
        return 0
    table = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            table[i][j] = max(
                table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + best_match(x, y)
            )
    return 1 + table[-1][-1]


def test_scores_agree_with_tree_matching():
    import random

    rnd = random.Random(2)

    def tree(depth):
        kids = [tree(depth - 1) for _ in range(rnd.randint(0, 4))] if depth else []
        return rnd.randint(1, 3), kids

    def shape(t):
        return wrapper.shape(t[0], tuple(shape(k) for k in t[1]))

    wrapper.forget_shapes()
    for _ in range(300):
        a, b = tree(3), tree(3)
        # Equal ends are paired at once, which cannot lose more than it gains for equal trees.
        assert wrapper.score(shape(a), shape(b)) == best_match(a, b)


def test_given_pages_have_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in wrapper.extract_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        html = r["html"] or ""
        article = html.partition("<article>")[2].partition("<footer>")[0]
        assert all(line in article.replace("&quot;", '"').replace("&amp;", "&") for line in r["text"].split("\n")[:1])
        assert ("<article>" in html) == bool(r["text"])


LONG = "many words of the body " * 12


@pytest.mark.parametrize(
    "inside",
    [
        f"<h1>Title</h1><p>lead</p><div class='body'><p>{LONG}</p></div><p>end</p>",
        f"<section><p>{LONG}</p></section><section><p>{LONG[:150]}</p></section>",
    ],
)
@pytest.mark.parametrize("around", ["<article>{}</article>", "<div><main>{}</main></div>", "<div>{}</div>"])
def test_siblings_of_the_longest_part_stay(spark, inside, around):
    lines = [x.strip() for x in inside.replace("<", "\n<").replace(">", ">\n").split("\n")]
    text = "\n".join(x for x in lines if x and not x.startswith("<"))
    pages = [
        f"<body><div><p>Our site</p></div>{around.format(inside.replace('</p>', f' {n}</p>').replace('</h1>', f' {n}</h1>'))}</body>"
        for n in range(12)
    ]
    assert wrapper.extract(pages[0].replace("<p>Our site</p>", ""), None).replace(" 0", "") == text
    found = extracted(spark, [(n, "https://h.example/", p) for n, p in enumerate(pages)])
    for n in range(12):
        assert found[n][0].replace(f" {n}", "") == text


def test_articles_beside_each_other_stay(spark):
    pages = [
        (n, "https://h.example/", f"<body><article><p>{n} {LONG}</p></article>"
         + f"<article><p>second {n}</p></article>" * (n % 3 == 0) + "</body>")
        for n in range(12)
    ]
    found = extracted(spark, pages)
    for n in range(12):
        assert found[n] == [f"{n} {LONG}".strip() + f"\nsecond {n}" * (n % 3 == 0)]


def test_short_articles_under_long_boilerplate(spark):
    said_ = [f"{n} " + f"{WORDS[n % 14]} {WORDS[n % 5]} of page {n} " * 8 for n in range(12)]
    for around in ("<div><p>{}</p></div>", "<article><p>{}</p></article>"):
        pages = [
            (n, "https://h.example/", f"<body><div>{'constant words ' * 40}</div>{around.format(said_[n])}</body>")
            for n in range(12)
        ]
        found = extracted(spark, pages + pages)
        for n in range(12):
            assert found[n] == [said_[n].strip()] * 2


@pytest.mark.parametrize(
    ("around", "more"),
    [("<article>{}</article>", ""), ("<article>{}</article>", "seen and counted " * 3), ("<div>{}</div>", "")],
)
def test_near_copies_keep_their_article(spark, around, more):
    body, more = (LONG * 3).strip(), more.strip()
    pages = [
        (n, "https://h.example/", f"<body>{around.format(f'<p>{body}</p><p>{body[::-1]}</p><p>{n} {more}</p>')}</body>")
        for n in range(30)
    ]
    found = extracted(spark, pages)
    for n in range(30):
        assert found[n] == [f"{body}\n{body[::-1]}\n{n} {more}".strip()]


@pytest.mark.parametrize(
    ("markup", "text"),
    [
        ("<p><svg class=icon/>one</p><p>two</p><svg><path/><text>no</text></svg><p>three</p>", "one\ntwo\nthree"),
        ("<p><svg class='icon' />one</p><p>two</p>", "one\ntwo"),
        ("<p>a</p><svg><g><svg><text>no</text></svg><text>no</text></g></svg><p>b</p>", "a\nb"),
        ("<div><svg><title/><path></svg>a</div><p>b</p>", "a\nb"),
        ("<p>a</p><div><template><p>b</p></div><p>c</p>", "a\nb\nc"),
        ("<p>a</p><noscript><p>b</p><nav>no</nav>", "a\nb"),
        ("<p>a</p><template><div>no<template>no</template>no</div></template><p>b</p>", "a\nb"),
        ("<p>a<noscript><img src=x>no</noscript>b</p>", "ab"),
    ],
)
def test_brackets_hide_only_what_is_in_them(markup, text):
    assert wrapper.extract(f"<html><body>{markup}</body></html>", None) == text


LAYOUT = [
    "<div class='site'>{}</div><div class='text'><p>{}</p></div>",
    "<table><tr><td class='left'>{}</td><td class='right'><p>{}</p></td></tr></table>",
    "<section class='a'><ul><li>{}</li></ul></section><section class='b'><h2>{}</h2></section>",
]


@pytest.mark.parametrize(("layouts", "each"), [(3, 8), (1, 2), (1, 3), (2, 2), (1, 5)])
def test_layouts_and_small_hosts(spark, layouts, each):
    rows, wanted = [], {}
    for n in range(layouts * each):
        wanted[n] = f"{n} " + " ".join(WORDS[(n * k + n) % 14] for k in range(1, 12))
        html = LAYOUT[n % layouts].format("the same words on each page " * 3, wanted[n])
        rows.append((n, "https://h.example/", f"<body>{html}</body>"))
    found = extracted(spark, rows)
    for n, text in wanted.items():
        assert found[n] == [text]


DEEP = "<div>" * 300


@pytest.mark.parametrize(
    ("markup", "text"),
    [
        *((f"<p data-x={q}{'<b>no</b> ' * 3000}{q}>a</p><p>b</p>", "a\nb") for q in "'\""),
        ("<p data-x='" + "<p class=\"nav\">" * 3000 + "'>a</p>", "a"),
        ("<p title='x>a</p><p>b</p>" + "c" * 20000, "a\nb\n" + "c" * 20000),
        (f"<section>{DEEP}<section>a</section>b<p>c</p><nav>no<div>no</div>no</nav>d</section><p>e", "a\nb\nc\nd\ne"),
        (f"<article>{DEEP}<article>aaaa</article></article><p>b</p>", "aaaa"),
        (f"{DEEP}a <b>b <i>c</i></b> <span class='share'>no</span>d<div>e<br>f</div>g", "a b c d\ne f\ng"),
        (f"{DEEP}<noscript>a", "a"),
    ],
    ids=range(8),
)
def test_long_attributes_and_deep_elements(markup, text):
    assert wrapper.extract(f"<html><body>{markup}", None) == text


@pytest.mark.parametrize(
    "markup", ["<a '", "<a \"'x\" y='", "<a ", "<b><p>", "<div>", "</i><b>", "<a x='>\" y=\"", "<svg><template>"]
)
def test_odd_markup_takes_linear_time(markup):
    start = time.process_time()
    wrapper.parse(markup * 40000 + "<p>x</p>")
    assert time.process_time() - start < 10


@pytest.mark.parametrize(
    "page",
    ["<svg>x", "<noscript>x", "<template>x", "<div>x", "<b>x", "<nav>x", "<svg><div><b>x", "<ul><li>x",
     "<![CDATA[>", "<![CDATA[", "<![CDATA[a]]>", "<!--", "<!x", "<!x>", "<a b='", "<a ", "<"],
)
def test_very_deep_and_unclosed_markup_takes_linear_time(page):
    import time

    wrapper.forget_shapes()
    page, start = "<p>text</p>" + page * 60_000, time.perf_counter()
    tree, _ = wrapper.skeleton(wrapper.parse(page))
    wrapper.match(tree, wrapper.Tree.unpack(tree.pack()))
    assert wrapper.extract(page, None).startswith("text")
    assert time.perf_counter() - start < 20


def test_unclosed_markup_among_other_pages(spark):
    pages = [(n, "https://h.example/", f"<div>Our site</div><p>{LONG} {n}</p>") for n in range(8)]
    pages += [(8, "https://h.example/", "<svg>x" * 1500), (9, "https://h.example/", "<noscript>y" * 1500)]
    found = extracted(spark, pages)
    assert all(found[n][0] == f"{LONG}{n}" for n in range(8))
    assert found[8][0].count("x") == found[9][0].count("y") == 1500


def test_titles_in_headers_and_phrases_with_long_names():
    article = """<article><header><h1>Title</h1><nav>menu</nav></header>
        <p>stock <span class="share-price">12 EUR</span> rose <span class="ad">buy</span></p>
        <header class="promo">offer</header><footer>foot</footer></article>"""
    page = f"<body><header><h1>Site</h1></header>{article}<span class='share-this'>share</span></body>"
    assert wrapper.extract(page, None) == "Title\nstock 12 EUR rose"
    later = "<article><header class='ad'><h1>Ad</h1></header><p>body</p></article><header><h1>Site</h1></header>"
    assert wrapper.extract(later, None) == "body"


def many_layouts(layouts, each):
    """Pages of one host with a menu that its layout sets in elements of its own, and their texts."""
    rows, wanted = [], {}
    for n in range(layouts * each):
        wanted[n] = f"{n} " + " ".join(WORDS[(n * k + n) % 14] for k in range(1, 12))
        around = f"<div class='top{n % layouts}'><p>the same words on each page</p><p>go home</p><div class='text{n % layouts}'>"
        rows.append((n, "https://h.example/", f"<body>{around}<p>{wanted[n]}</p></div></div></body>"))
    return rows, wanted


def test_every_layout_of_a_host_has_a_wrapper(spark):
    rows, wanted = many_layouts(21, 7)
    found = extracted(spark, rows)
    assert found == {n: [text] for n, text in wanted.items()}


def test_wrappers_from_other_pages(spark):
    rows, wanted = many_layouts(12, 14)
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    learned = wrapper.induce(pages.where("page_id < 84"))
    assert learned.count() == 12
    lone = spark.createDataFrame([(-1, "https://h.example/", "<body><ul><li>go home</ul>"), (-2, None, "x")], pages.schema)
    new = pages.where("page_id >= 84").union(lone)
    found = {r["page_id"]: r["text"] for r in wrapper.extract_text(new, wrappers=learned).collect()}
    assert found == {n: text for n, text in wanted.items() if n >= 84} | {-1: "go home", -2: "x"}
    assert wrapper.extract_text(new, wrappers=learned.where("false")).where("text = ''").count() == 0


def odd_trees(n):
    import random

    rnd = random.Random(4)

    def markup(depth):
        if not depth or rnd.random() < 0.2:
            return f"<p>{rnd.choice(WORDS)} {rnd.randint(0, 3)}</p>"
        tag = rnd.choice(["div", "ul", "section", "table"])
        return f"<{tag}>{''.join(markup(depth - 1) for _ in range(rnd.randint(1, 4)))}</{tag}>"

    return [f"<body>{markup(3)}{markup(3)}</body>" for _ in range(n)]


def one_by_one(trees):
    """Layouts by their definition: each tree belongs to the first reference it fits, or is the next."""
    references, layouts = [], {}
    for packed in trees:
        tree = wrapper.Tree.unpack(packed)
        for number, reference in enumerate(references):
            to = wrapper.match(tree, reference)
            if wrapper.fits(tree, reference, to) >= wrapper.FITS:
                break
        else:
            number = len(references)
            references.append(tree)
        layouts.setdefault(number, []).append(packed)
    return list(layouts.values())


def test_possible_references_lose_none(monkeypatch):
    monkeypatch.setattr(wrapper, "SHAPES", 50)  # forgets and begins again all the time
    wrapper.forget_shapes()
    packed = list(dict.fromkeys(wrapper.skeleton(wrapper.parse(p))[0].pack() for p in odd_trees(200)))
    references, layouts = wrapper.References(), {}
    for p in packed:
        found = references.first(p)
        if found is None:
            references.add(len(references.layouts), p)
        layouts.setdefault(references.layouts[p] if found is None else found[0], []).append(p)
    wrapper.forget_shapes()
    assert list(layouts.values()) == one_by_one(packed)
    assert 8 < len(layouts) < 200


@pytest.mark.parametrize(("at_once", "nodes", "part"), [(1, 1 << 17, 1 << 17), (512, 1 << 17, 100), (16, 60, 200)])
def test_layouts_of_rounds_are_those_of_one_by_one(spark, monkeypatch, at_once, nodes, part):
    monkeypatch.setattr(wrapper, "NODES", nodes)
    monkeypatch.setattr(wrapper, "PART", part)
    monkeypatch.setattr(wrapper, "AT_ONCE", at_once)
    markup = odd_trees(20 if at_once == 1 else 60)
    pages = spark.createDataFrame(
        [(n, f"https://{'ab'[n % 5 == 0]}.example/", p) for n, p in enumerate(markup + markup)],
        "page_id bigint, url string, html string",
    ).repartition(3)
    made = wrapper.trees(pages)
    wrappers, members = wrapper._induce(made)
    kind = "if(length(tree) between 100 and 4000, 0, if(length(tree) > 4000, 1, 2))"
    order = made.dropDuplicates(["host", "key"]).orderBy("host", wrapper.F.expr(kind), wrapper.F.xxhash64("tree"), "tree")
    trees, layout_of = order.collect(), {(r["host"], bytes(r["key"])): r["layout"] for r in members.collect()}
    for host in ("a.example", "b.example"):
        own = [r for r in trees if r["host"] == host]
        found = {}
        for r in own:
            found.setdefault(layout_of.get((host, bytes(r["key"])), 0), []).append(bytes(r["tree"]))
        wrapper.forget_shapes()
        wanted = one_by_one([bytes(r["tree"]) for r in own])
        assert [found[k] for k in sorted(found)] == wanted
        references = wrappers.where(f"host = '{host}'").orderBy("layout").collect()
        assert [(r["layout"], bytes(r["reference"])) for r in references] == [
            (k, v[0]) for k, v in sorted(found.items())
        ]


def test_long_lists_of_nodes_are_aligned_like_short_ones(monkeypatch):
    import random

    wrapper.forget_shapes()
    draw = random.Random(5)
    leaves = [wrapper.shape(label, ()) for label in range(3)]
    kinds = [*leaves, *(wrapper.shape(7, tuple(draw.choices(leaves, k=n))) for n in range(1, 5))]

    def same(a, b):
        said = [[draw.randrange(30) for _ in z] for z in (a, b)]
        monkeypatch.setattr(wrapper, "CELLS", 1 << 30)
        plain = wrapper.align(a, b, *said)
        monkeypatch.setattr(wrapper, "CELLS", 0)
        assert wrapper.align(a, b, *said) == plain

    same([kinds[0]] + [kinds[1]] * 300, [kinds[1]] * 300 + [kinds[0]])
    for block, marks in [(1, 2), (3, 2), (64, 32)]:
        monkeypatch.setattr(wrapper, "BLOCK", block)
        monkeypatch.setattr(wrapper, "MARKS", marks)
        for n in range(40):
            a = draw.choices(kinds[: draw.randrange(1, 8)], k=draw.randrange(1, 60))
            b = [x for x in a if draw.random() < 0.8] if n % 3 else draw.choices(kinds, k=draw.randrange(1, 60))
            same(a, b)
    wrapper.forget_shapes()


def test_a_moved_node_of_a_long_page_costs_no_other():
    heading, lines = "<h2>Part</h2>", "".join(f"<p>line {i}</p>" for i in range(300))
    trees = [wrapper.skeleton(wrapper.parse(f"<div>{x}</div>"))[0] for x in (heading + lines, lines + heading)]
    assert (wrapper.match(*trees) >= 0).sum() == len(trees[0].labels) - 1
