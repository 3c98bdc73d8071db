import pyspark.sql.functions as F
import pytest

from panelcast.llm.html_text import extract, main_text

LONG = "It was the best of times and it was the worst of times for all that lived in the town by the sea."
CASES = [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain text", "plain text"), ("<p>Short</p>", "Short"),
    ("<nav><a href='/x'>Home</a></nav><article><h1>T&amp;C</h1><p>A <b>bo</b>ld\n\n move&nbsp;&copy;</p><p>%%% ###</p></article><footer>x</footer>", "T&C A bold move © %%% ###"),
    ("<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t=\"</p>\";</script></head><body><header>Site</header><main><header><h1>Head</h1></header>"
     "<p>one<br>two<p>three</main><aside>side</aside></body>", "Head one two three"),
    ("<article><p>a</p><div class=\"comments\"><p>" + LONG + "</p></div><section id='user-comments'>x</section><p>b</p></article>", "a b"),
    ("<article><p>a</p><div class='ad-slot'><div>" + LONG + "</div>more</div><p>b</p><form><p>f</p><input><select><option>1</select></form></article>", "a b"),
    ("<div class='cookie-notice'>" + LONG + "</div><div><p>" + LONG + "</p><p>So short.</p></div><div id=sidebar>" + LONG + "</div>", LONG + " So short."),
    ("<div><a href=x>" + LONG + "</a></div><p>" + LONG + "</p>", LONG),
    ("<p>" + "qwr tzu pls mnb " * 10 + "</p><p>" + LONG + "</p>", LONG),
    ("<article><!-- <p>no</p> --><p title='a>b'>yes</p><p>1 &lt; 2 &#8364; &eacute;</p></article>", "yes 1 < 2 € é"),
    ("<article><p>unclosed <b>bold<p>next<!-- open comment", "unclosed bold next"),
    ("<article><p>x</p><script>never closed", "x"),
    ("<article><ul><li>one</li><li>two</li></ul><table><tr><td>c1</td><td>c2</td></tr></table></article>", "one two c1 c2"),
    ("<article><p>tail <a", "tail"),
    # nested equal tags: the inner end tag doesn't end the advert
    ('<article><p>a <span class="ad"><span>x</span> buy now</span> b</p></article>', "a b"),
    ('<article><p>a <span class="ad">x <i><span>y</span></i> z <span>q</span></span> b <span>c</span></p></article>', "a b c"),
    # subjects of an article are no page parts, page parts inside it are
    ('<article><section class="social-history"><p>One.</p></section><p id="comment-on-the-war">Two.</p><div class="share-capital">Three.</div></article>', "One. Two. Three."),
    ('<article><p>One.</p><div class="share-buttons">Share</div><div class="x comments-list">Nice!</div><div id="ad-box-2">Buy</div></article>', "One."),
    ("<article><p>See <a href=x>the full report of the thing</a>.</p><ul><li><a href=y>A reference</a></li></ul></article>", "See the full report of the thing . A reference".replace(" .", ".")),
    # no end tag of the head, no body; a form around the whole page
    ("<html><head><title>t</title><meta charset=x><p>" + LONG + "</p>", LONG),
    ("<form><div class=top><a href=/>Home</a></div><article><h1>Head</h1><p>Body.</p></article></form>", "Head Body."),
    ("<form><p>" + LONG + "</p><label>Name</label><input></form>", LONG),
    ("<ARTICLE><P CLASS=lead>Up</P><DIV ROLE=navigation>menu</DIV></ARTICLE>", "Up"),
    ("<article><p>word" + " word" * 30000 + "</p></article>", "word" + " word" * 30000),
]


@pytest.mark.parametrize("page,want", CASES)
def test_pages(page, want):
    assert main_text(page) == want


POLISH = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem."
RUSSIAN = "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать братски."
ITALIAN = "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire."
CHINESE = "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。"


@pytest.mark.parametrize("text", [POLISH, RUSSIAN, ITALIAN, CHINESE])
def test_languages_without_stop_words_in_the_list(text):
    page = f"<body><nav><a href='/'>Start</a></nav><div><p>{text}</p><p>{text}</p></div><footer>x</footer></body>"
    assert main_text(page) == f"{text} {text}"
    assert main_text(f"<div><a href='/'>{text}</a></div><div class=sidebar>{text}</div><p>{text}</p>") == text


def test_table(spark):
    rows = [(i, "u", p) for i, (p, _) in enumerate(CASES)] + [(None, None, "<p>x</p>"), (1, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(map(str, (tuple(r) for r in extract(pages).collect())))
    assert got == sorted(str((i, u, main_text(p), len(main_text(p)))) for i, u, p in rows)
    assert extract(pages.limit(0)).collect() == []


def test_linear_time_on_broken_markup():
    import time
    t = time.time()
    for page in ("<a \"" * 20000, "<" * 50000, "<p class='" * 5000, "<!--" * 20000, "<div>" * 20000, "&" * 50000, ("<p>" + LONG + "</p><p>so short</p>") * 15000):
        main_text(page)
    assert time.time() - t < 60
