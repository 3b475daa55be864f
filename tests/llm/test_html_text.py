from __future__ import annotations

import time

import pytest

from celluloid.llm import html_text

LONG = "This is the first long paragraph of the article and it says that there is more to come for all of us who read it. " * 3
OTHER = "And here is a second paragraph that goes on about the same matter with a few words more than what was in the first. " * 3
LONG, OTHER = LONG.strip(), OTHER.strip()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<p>", ""),
        (f"<body><nav><a href=x>Home</a></nav><article><h1>A title</h1><p>{LONG}<p>Short end.</article><footer>&copy; me</footer>", f"A title\n{LONG}\nShort end."),
        (f"<div class='sidebar'>{OTHER}</div><p>{LONG}</p><div id=comments><p>{OTHER}</p></div>", LONG),
        (f"<div class=layout-with-sidebar><main><p>{LONG}</p><aside>{OTHER}</aside></main></div>", LONG),
        (f"<p>{LONG}</p><script>var a = '<p>{OTHER}</p>';</script><style>p {{}}</style><p>{OTHER}</p>", f"{LONG}\n{OTHER}"),
        (f"<p>{LONG}</p><form><p>{OTHER}</p><input name=a></form><noscript>{OTHER}</noscript>", LONG),
        (f"<!-- <p>{OTHER}</p> --><p>{LONG} &amp; so &eacute;&#233;&#xe9; on &lt;b&gt; &amp now</p>", f"{LONG} & so ééé on <b> & now"),
        (f"<p>{LONG}\n\t <b>bold</b><br>next&nbsp;one  </p>", f"{LONG} bold next one"),
        (f"<ul><li><a href=a>One link that is long</a><li><a href=b>Another link that is long</a></ul><p>{LONG}", LONG),
        (f"<p>{LONG}</p><p>Brief.</p><p>{OTHER}</p>", f"{LONG}\nBrief.\n{OTHER}"),
        (f"<nav>x</nav><p>Brief.</p><footer>y</footer><p>{OTHER}", OTHER),
        (f"<div role=navigation>{OTHER}</div><article><header><h1>Head</h1></header><p>{LONG}</p></article>", f"Head\n{LONG}"),
        (f"<p hidden>{OTHER}</p><p style='display: none'>{OTHER}</p><P CLASS='Cookie-Notice'>{OTHER}</P><p>{LONG}", LONG),
        (f"<p>{LONG}</p></div></span><script>unclosed {OTHER}", LONG),
        (f"<p>{LONG}</p><a href='x", LONG),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_long_and_deep_pages():
    page = "<div>" * 3000 + f"<p>{LONG}</p>" * 200
    assert html_text.main_text(page) == "\n".join([LONG] * 200)
    assert html_text.main_text("<article><p>" + "the word of it " * 100_000 + "</p></article>").count("word") == 100_000


def test_rows_and_clashing_columns(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", "x"), (1, "u", f"<article><p>{LONG}</p></article>", "x"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(pages)
    assert got.columns == pages.columns and [r["text"] for r in got.collect()] == [LONG, LONG, ""]
    assert html_text.extract(pages.limit(0)).count() == 0


POLISH = (
    "Wczesnym rankiem mieszkańcy miasteczka zebrali się przed ratuszem, żeby wysłuchać przemówienia burmistrza. "
    "Zapowiedział budowę mostu, który połączy oba brzegi rzeki jeszcze przed zimą. Wielu słuchaczy przyjęło tę wiadomość z ulgą."
)
GREEK = (
    "Νωρίς το πρωί οι κάτοικοι της μικρής πόλης μαζεύτηκαν μπροστά στο δημαρχείο για να ακούσουν τον δήμαρχο. "
    "Υποσχέθηκε μια γέφυρα που θα ενώσει τις δύο όχθες του ποταμού πριν από τον χειμώνα, και πολλοί χάρηκαν."
)
CHINESE = "清晨，小镇居民聚集在市政厅前，聆听镇长的讲话。他宣布将在冬天之前修建一座连接河流两岸的桥梁。许多听众听到这个消息都松了一口气，孩子们也高兴地跑来跑去。"


@pytest.mark.parametrize("text", [POLISH, GREEK, CHINESE])
def test_languages_without_stop_words(text):
    menu, foot = "<nav><a href=a>A</a> b</nav>", "<footer>c</footer>"
    assert html_text.main_text(f"{menu}<p>{text}</p><p>{text}</p>{foot}") == f"{text}\n{text}"
    linked = text.replace(text[10:16], f"<a href=x>{text[10:16]}</a>")
    assert html_text.main_text(f"{menu}<article><p>{text}</p><p>{linked}</p><p>{text}</p></article>{foot}") == f"{text}\n{text}\n{text}"
    assert html_text.main_text(f"{menu}<p>{text}</p><p><a href=y>{text}</a></p>{foot}") == text


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar wide", "layout_with_sidebar", "without-comments", "right-sidebar", "header-fixed page", "sidebar", "comments-open"])
def test_marked_wrappers_of_the_text(name):
    page = f"<nav><a href=a>A</a></nav><div class='{name}'><p>{LONG}</p><p>{OTHER}</p><div class=sidebar>{OTHER}</div></div><footer>c</footer>"
    assert html_text.main_text(page) == f"{LONG}\n{OTHER}"


def test_long_discussions_stay_marked():
    for name in ("comments", "comment-list", "sidebar"):
        assert html_text.main_text(f"<p>{LONG}</p><div class={name}>{f'<p>{OTHER}</p>' * 20}</div>") == LONG
    assert html_text.main_text(f"<div class=right-sidebar><p>{LONG}</p></div><div id=comments>{f'<p>{OTHER}</p>' * 20}</div>") == LONG


ARTICLE = "This is the text of the article and it has many of the words that we know from all of the other pages in the web. " * 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # every page of some servers is one form
        (f"<body><form id=aspnetForm><nav>Menu <a>a</a></nav><p>{ARTICLE}</p><label>Name</label><input><select><option>x</select><p>{ARTICLE}</p></form>", [ARTICLE, ARTICLE]),
        (f"<body><form><fieldset><p>{ARTICLE}</p></fieldset><fieldset><p>{ARTICLE[:114]}</p></fieldset><div class=sidebar>{ARTICLE[:80]}</div></form>", [ARTICLE]),
        (f"<body><p>{ARTICLE}</p><form><p>{ARTICLE[:114]}</p><textarea>x</textarea></form>", [ARTICLE]),
        # a quote is a quote after = only
        (f"<body><p title=It's>{ARTICLE}</p><img alt=5'10><p>{ARTICLE}</p>", [ARTICLE, ARTICLE]),
        (f"<body><p title='a > b' data-x = \"c > d\">{ARTICLE}</p>", [ARTICLE]),
        (f"<body><p>{ARTICLE}</p><p title=\"open>{ARTICLE}", [ARTICLE]),
    ],
)
def test_forms_and_quotes(page, text):
    assert html_text.main_text(page).split("\n") == [" ".join(t.split()) for t in text]


def test_deep_pages_take_linear_time():
    start = time.thread_time()
    html_text.main_text("<div>" * 3_000 + "".join(f"<p>piece {k} of the text</p></section>" for k in range(20_000)))
    assert time.thread_time() - start < 8
