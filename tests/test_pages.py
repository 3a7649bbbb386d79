"""Posts read from public pages, by their embedded data and by their markup."""

import json

from heraldo.sources import pages

MARKUP = '<span class="UsernameText">{}</span><img class="EmbeddedMediaImage" alt="x" src="{}"><div class="Caption"><a>{}</a> {}<div class="CaptionComments">12</div></div>'


def page(media, name="by.name"):
    """A page whose script holds the data, with markup of another author beside it."""
    inner = json.dumps(json.dumps({"gql_data": {"shortcode_media": media}}))[1:-1]
    return f'<script>s.handle({{"a":1,"contextJSON":"{inner}","b":"c"}})</script>' + MARKUP.format(name, "https://x/m.jpg", name, "from markup")


def post(**more):
    return {"owner": {"username": "La.Casa"}, "id": "123", "__typename": "GraphImage", "display_url": "https://x/a.jpg", "taken_at_timestamp": 1760000000, "edge_media_to_caption": {"edges": [{"node": {"text": 'Salsa "viva"\n\\ ñ 💃'}}]}} | more


def read(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, html string")
    return pages.posts(rows, "html").orderBy("i").collect()


def test_embedded_data(spark):
    slides = [{"node": {"is_video": True, "video_url": "https://x/v.mp4", "display_url": "https://x/v.jpg"}}, {"node": {"is_video": False, "display_url": "https://x/b.jpg"}}]
    given = [post(), post(__typename="GraphVideo", is_video=True, video_url="https://x/v.mp4"), post(__typename="GraphSidecar", edge_sidecar_to_children={"edges": slides}), post(id=77, __typename="Odd", taken_at_timestamp="1760000000", edge_media_to_caption={"edges": []})]
    image, video, many, odd = read(spark, *map(page, given))
    assert (image["author"], image["id"], image["media_type"], image["taken_at"], image["by_data"], image["refused"]) == ("la.casa", "123", "IMAGE", 1760000000, True, None)
    assert image["caption"] == 'Salsa "viva"\n\\ ñ 💃'
    assert [tuple(m) for m in image["media"]] == [("IMAGE", "https://x/a.jpg", None)]
    assert video["media_type"] == "VIDEO" and [tuple(m) for m in video["media"]] == [("VIDEO", "https://x/a.jpg", "https://x/v.mp4")]
    assert many["media_type"] == "CAROUSEL_ALBUM" and [tuple(m) for m in many["media"]] == [("VIDEO", "https://x/v.jpg", "https://x/v.mp4"), ("IMAGE", "https://x/b.jpg", None)]
    assert (odd["id"], odd["media_type"], odd["taken_at"], odd["caption"]) == ("77", "IMAGE", None, "")


def test_markup_stands_in(spark):
    whole = page(post())
    without = [post(owner={}), post(id="12a"), post(owner=None)]
    broken = [whole.replace('"contextJSON":"{', '"contextJSON":"{{'), whole[: whole.index("contextJSON") + 40] + MARKUP.format("by.name", "https://x/m.jpg", "by.name", "from markup")]
    for r in read(spark, *map(page, without), *broken, MARKUP.format("by.name", "https://x/m.jpg", "by.name", "from markup")):
        assert (r["author"], r["id"], r["media_type"], r["caption"], r["taken_at"], r["by_data"]) == ("by.name", None, "IMAGE", "from markup", None, False)
    (r,) = read(spark, MARKUP.format("tango_sur", "https://x/p.jpg?a=1&amp;b=2", "tango_sur", "Caf&eacute;<br />de <b>tango</b> &#161;hoy!"))
    assert r["caption"] == "Café\nde tango ¡hoy!" and r["media"][0]["image"] == "https://x/p.jpg?a=1&b=2"


def test_pages_without_a_post(spark):
    assert [r["refused"] for r in read(spark, "", None, "<p>Log in</p>", MARKUP.format("not a name!", "https://x/m.jpg", "", ""), page(post(owner={"username": "a b"})))] == ["no post"] * 3 + ["odd author"] * 2


def test_long_pages(spark):
    long = 'a "quoted" line\n' * 100_000
    (r,) = read(spark, page(post(edge_media_to_caption={"edges": [{"node": {"text": long}}]})))
    assert r["caption"] == long
