from tidemark.llm.boilerplate import boilerplate_lines, laid_out, pieces, rendered, site_lines

PAGE = """Home | Careers | Log in
Careers / Cook (Staff)
Cook (Staff)
Location: Oslo
<p>You will own the cookie settings page of our shop.</p>

Benefits
- Share your own ideas about privacy and search with the data team.
<a>Apply now</a>
Similar jobs
Baker, Rome
Oslo: Smith
Next steps
We answer every application.
We use cookies to count visits. Accept all
Imprint &middot; Cookie settings
(c) Acme Foods 2024
Acme Foods, Oslo, Norway"""


def test_page():
    assert site_lines(PAGE) == [1, 2, 9, 10, 11, 12, 15, 16, 17, 18]
    assert site_lines(None) == site_lines("") == site_lines("  \n ") == []


def test_rendering():
    markup = "<ul><li>One<li>Two</ul><script>x<y</script><p style='display: none'>no</p><table><tr><td>a<td>bb</tr><tr><td>ccc</td><td>d</td></tr></table><p>x<p>y<br>z &amp; w"
    assert rendered(markup) == "One\nTwo\na   | bb\nccc | d\nx\ny\nz & w"
    assert [p.line for p in pieces("a\n<div>b</div>\n\n<p>c\nd")] == [1, 2, 4, 5]
    assert rendered("<" * 5000) == "<" * 5000
    assert site_lines("<nav>Our shop\nmore</nav>\nText") == [1, 2]
    assert site_lines("<style>p {}</style>\nText") == [1]


def test_operator(spark):
    df = spark.createDataFrame([(1, PAGE, 9), (2, PAGE, 9), (2, PAGE, 9), (3, None, 9), (4, "", 9), (5, "Just text. " * 20000, 9), (None, "Apply now", 9)], "k int, v string, line_no int")
    got = sorted(((r["k"], r["line_no"]) for r in boilerplate_lines(df, "v", "k").collect()), key=str)
    n = len(site_lines(PAGE))
    assert len(got) == 3 * n + 1 and (None, 1) in got and not [g for g in got if g[0] in (3, 4, 5)]
    assert boilerplate_lines(df.limit(0), "v", "k").count() == 0


def test_layout_alone():
    def placed(page):
        texts = {}
        for p in pieces(page):
            texts[p.line] = texts.get(p.line, "") + p.text
        return sorted(laid_out(sorted(texts), texts))

    head = "Eins\nZwei\nDrei\n\nKoch\nBacken\nWir backen jeden Tag frisches Brot.\nLohn: 12\nFünf  Sechs  Sieben"
    assert placed(head) == [1, 2, 3, 9]
    assert placed("Un\nDeux\nTrois\nCuisinier\nMissions\nVous faites le pain de chaque jour.") == [1, 2, 3]
    assert placed("Eins / Koch\nKoch\nOrt: Bonn\nWir backen jeden Tag frisches Brot.\nMerken\nNach oben") == [1, 5, 6]
    assert placed("Koch\nBacken\nWir backen jeden Tag frisches Brot.\nMerken") == []  # one short line may be the page's own
    assert placed("") == [] and laid_out([], {}) == set()
    assert rendered("<ul><li>One<li>- Two</ul>x", bullets=True) == "- One\n- Two\nx"
