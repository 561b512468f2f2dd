from pyspark.sql import functions as F

from tidemart.llm import lineblocks as lb

PARAGRAPHS = ["First words of the piece, long enough to be one; they go on & on for a while.", "Short.", "Then a third part with <b>marks</b> and a <a href='/x'>link</a> in it, of some length as well."]
EXPECTED = "A title\n\nFirst words of the piece, long enough to be one; they go on & on for a while.\n\nShort.\n\nThen a third part with marks and a link in it, of some length as well."
BODY = "<h1>A title</h1>" + "".join(f"<p>{p.replace('& on', '&amp; on')}</p>" for p in PARAGRAPHS)
CLUTTER_BEFORE = (
    "<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t='</p>';</script></head><body><header>Site name</header>"
    "<nav><ul><li><a href=/>Home</a><li><a href=/b>Other</a></ul></nav><div class='cookie-notice'><p>We use cookies on this site to do many things for you.</p></div>"
    "<!-- ad <p>no</p> --><div id=top_banner data-x='a>b'>Buy now</div>"
)
CLUTTER_AFTER = (
    "<aside><p>Read this other long story that we have about something else entirely, today.</p></aside><form><label>Mail</label><input value='x'></form>"
    "<section class='comments'><h3>Comments</h3><div class=comment><p>I think this is a rather long comment by a reader, who goes on.</p></div></section>"
    "<footer><p>&copy; the site &middot; all rights</p></footer></body></html>"
)


def test_marked_article():
    assert lb.main_text(f"{CLUTTER_BEFORE}<article>{BODY}</article>{CLUTTER_AFTER}") == EXPECTED


def test_article_without_a_mark():
    assert lb.main_text(f"{CLUTTER_BEFORE}<div class=content>{BODY}</div>{CLUTTER_AFTER}") == EXPECTED


def test_link_lists_dive():
    links = "".join(f"<div><a href=/{i}>Some other story number {i}</a></div>" for i in range(9))
    assert lb.main_text(f"<div>{links}</div><div>{BODY}</div><div>{links}</div>") == EXPECTED


def test_clutter_inside_the_article():
    inner = BODY.replace("<p>Short.", "<div class='ad'>Buy this</div><script>x</script><p>Short.")
    assert lb.main_text(f"<main>{inner}<div class='share-buttons'>Share</div></main>") == EXPECTED


def test_frames_and_comments_with_telling_classes():
    comment = "<article class='comment'><p>A reader says that this is not what they had hoped for, at length.</p></article>"
    page = f"<div class='layout with-sidebar'><p>Menu</p><article><div class='entry-header'><h1>A title</h1></div>{BODY[16:]}</article><div id=comments>{comment}</div></div>"
    assert lb.main_text(page) == EXPECTED


def test_surge_and_dive_points():
    assert lb.between_surges_and_dives([2, 0, 0, 0, 90, 5, 0, 7, 0, 0, 0, 3], 3, 80) == [False] * 4 + [True] * 4 + [False] * 4
    assert lb.between_surges_and_dives([], 3, 80) == []
    assert lb.between_surges_and_dives([0, 4], 3, 80) == [False, True]


def test_marked_pages_surge_and_dive():
    links = "".join(f"<div><a href=/{i}>Some other story number {i}</a></div>" for i in range(9))
    assert lb.main_text(f"<main><div>{links}</div>{BODY}<div>{links}</div></main>") == EXPECTED
    assert lb.main_text(f"<article>{BODY}<div>{links}</div><p>Tags</p></article>") == EXPECTED
    assert lb.main_text(f"<div>{links}</div><div>Short line</div><article>{BODY}</article><div>Short line</div><div>{links}</div>") == EXPECTED


def test_text_outside_a_short_marked_part():
    teaser = "A teaser of the piece, in one line."
    assert lb.main_text(f"<article><p>{teaser}</p></article><div>{BODY}</div>") == f"{teaser}\n\n{EXPECTED}"
    assert lb.main_text(f"<article>Yes.</article><div>{BODY}</div><p>No.</p>") == f"Yes.\n\n{EXPECTED}\n\nNo."
    assert lb.main_text(f"<div>{BODY}</div><main><p>{teaser}</p></main>") == f"{EXPECTED}\n\n{teaser}"


def test_link_lines_between_surge_and_dive_stay():
    inner = BODY.replace("<p>Short.</p>", "<p><a href=/s>Short.</a></p>")
    for page in (f"<article>{inner}</article>", f"<div>{inner}</div>"):
        assert lb.main_text(page) == EXPECTED


def test_broken_markup():
    assert lb.main_text("<p>one<p>two") == "one\n\ntwo"
    assert lb.main_text("a < b and <b>c") == "a < b and c"
    assert lb.main_text("<p>seen</p><script>never closed <p>x</p>") == "seen"
    assert lb.main_text("<p>seen</p><!-- never closed <p>x</p>") == "seen"
    assert lb.main_text('<p title="un>quoted>still here</p>') in ("still here", "quoted>still here")
    assert lb.main_text("") == "" and lb.main_text("<div></div>") == "" and lb.main_text("<") == "<"
    assert lb.main_text("x<br>y&nbsp; z\n w &lt;i&gt;") == "x y z w <i>"


def test_given_pages(spark):
    """Pages of the fixture hold a document's lines in the order title, first line, others."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = lb.extract_pages(pages).collect()
    docs = {" ".join(r["text"].split()) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()}
    assert len(rows) == pages.count()
    assert all(" ".join(r["text"].split("\n\n", 1)[1].split()) in docs for r in rows)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (None, "<p>é</p>"), (2, "")], "page_id long, html string").withColumn("text", F.lit("own"))
    rows = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in lb.extract_pages(pages).collect())
    assert rows == [(0, "é", 1), (1, "", 0), (2, "", 0), (2, "", 0)]
    assert lb.extract_pages(pages.limit(0)).collect() == []
