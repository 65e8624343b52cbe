"""The per-page card finder on awkward markup (pure Python, no Spark)."""

import time

import pytest

from bazaarlens.functions.cards import parse_cards

START = '<div data-component-type="s-search-result" data-asin="B1">'


def one(body, start=START):
    cards = parse_cards(start + body + "</div>")
    assert len(cards) == 1
    return cards[0]


def test_no_cards_fast_path():
    assert parse_cards(None) == [] and parse_cards("") == []
    assert parse_cards("<html><body><div class='x'>hello</div></body></html>") == []


def test_entities_decoded_in_text_and_attributes():
    c = one('<span class="a-size-medium">Dell &amp; Co&#39;s &lt;15&gt;</span>',
            start='<div data-component-type="s-search-result" data-asin="B&amp;1">')
    assert c["name_medium"] == "Dell & Co's <15>" and c["asin_attr"] == "B&1"


def test_comments_and_scripts_are_not_text():
    c = one('<span class="a-size-medium">Dell<!-- hidden -->15</span>'
            '<script>var s = "</span><span class=\\"a-price-whole\\">9</span>";</script>'
            '<span class="a-price-whole">45,990.</span>')
    assert c["name_medium"] == "Dell15" and c["price_text"] == "45,990."


def test_attribute_quoting_and_case():
    c = one("<SPAN CLASS='a-size-medium'>Acer</SPAN><span class=a-icon-alt>4.1 out of 5</span>"
            '<span class="a-size-base" DIR="auto">12</span>')
    assert c["name_medium"] == "Acer" and c["rating_text"] == "4.1 out of 5"
    assert c["reviews_text"] == "12"


def test_gt_inside_attribute_value():
    c = one('<span class="a-size-medium" title="a > b">Asus</span>')
    assert c["name_medium"] == "Asus"


def test_unclosed_inner_tags_close_with_their_parent():
    c = one('<span class="a-size-medium">HP <b>Pavilion</span><span class="a-price-whole">'
            '30,000.</span>')
    assert c["name_medium"] == "HPPavilion" and c["price_text"] == "30,000."


def test_unclosed_card_ends_with_document():
    cards = parse_cards(START + '<span class="a-size-medium">Lenovo</span>')
    assert len(cards) == 1 and cards[0]["name_medium"] == "Lenovo"


def test_cards_in_order_and_nested_cards_found():
    page = (START + '<span class="a-size-medium">One</span></div>'
            '<div data-component-type="s-search-result" data-asin="B2">'
            '<div data-component-type="s-search-result" data-asin="B3">'
            '<span class="a-price-whole">7</span></div>'
            '<span class="a-size-medium">Two</span></div>')
    cards = parse_cards(page)
    assert [c["asin_attr"] for c in cards] == ["B1", "B2", "B3"]
    assert [c["name_medium"] for c in cards] == ["One", "Two", None]
    assert [c["price_text"] for c in cards] == [None, "7", "7"]


def test_card_found_after_awkward_attributes():
    for start in ('<div title="a > b" data-component-type="s-search-result" data-asin="B1">',
                  '<div data-component-type = "s-search-result" data-asin = "B1">',
                  "<DIV data-asin=B1 data-component-type='s-search-result'>"):
        assert one("", start)["asin_attr"] == "B1"


def test_commented_card_is_none():
    assert parse_cards("<!-- " + START + "</div> -->") == []


def test_attribute_inside_another_attributes_value_is_not_read():
    c = one("<span data-x='{ class=\"a-price-whole\" }'>999</span>")
    assert c["price_text"] is None


def test_blanks_in_class_attribute():
    c = one('<span class="  a-size-base-plus \n a-color-base ">Dell</span>'
            '<span class="a-price   a-text-price"><span class="a-offscreen">₹5</span></span>')
    assert c["brand_text"] == "Dell" and c["mrp_text"] == "₹5"


def test_broken_card_costs_no_other(monkeypatch):
    from bazaarlens.functions import cards as C
    whole = C._Card.start

    def fails(self, tag, attrs, depth):
        if self.fields["asin_attr"] == "BAD":
            raise ValueError("unreadable")
        whole(self, tag, attrs, depth)

    monkeypatch.setattr(C._Card, "start", fails)
    page = START + '<span class="a-size-medium">One</span></div>'
    got = parse_cards(page.replace("B1", "BAD") + page)
    assert [(c["asin_attr"], c["broken"], c["name_medium"]) for c in got] == \
        [("BAD", True, None), ("B1", False, "One")]


def test_mrp_only_inside_first_mrp_block():
    c = one('<span class="a-offscreen">₹1</span>'
            '<span class="a-price a-text-price"><span class="a-offscreen">₹59,990.00</span></span>'
            '<span class="a-price a-text-price"><span class="a-offscreen">₹2</span></span>')
    assert c["mrp_text"] == "₹59,990.00"


def test_brand_class_must_match_whole_value_or_a_token():
    c = one('<span class="a-color-base a-size-base-plus">Wrong order</span>'
            '<span class="a-size-base-plus a-color-base">Dell</span>')
    assert c["brand_text"] == "Dell"
    assert c["name_base_plus"] == "Wrong order"


def test_void_and_self_closing_tags():
    c = one('<span class="a-size-medium">Dell<br>15<img src="x"/></span>')
    assert c["name_medium"] == "Dell15"


def test_sponsored_needs_text_only_span():
    assert one("<span>  sponsored  </span>")["sponsored"] is True
    assert one("<span>Sponsored<i></i></span>")["sponsored"] is False
    assert one("<div>Sponsored</div>")["sponsored"] is False
    assert one("<span><a>Sponsored</a></span>")["sponsored"] is True
    assert one("<span> <a>Sponsored</a></span>")["sponsored"] is False
    assert one("<span>Sponsored<!-- x --></span>")["sponsored"] is False
    assert one("<span><b><i>sponsored</i></b></span>")["sponsored"] is True


@pytest.mark.parametrize("body", [
    "<b>" * 20000 + "</i>" * 20000,                       # unclosed tags, stray end tags
    '<span class="a-size-medium">x' * 20000,
    "<" * 200_000, "<a " * 20000, '<a "' * 20000,         # no tag that ends
    "<span>" * 20000 + "Sponsored " * 1000 + "</span>" * 20000,
    "<!-- x" * 20000, "<script " * 20000 + ">",
], ids=["stray", "spans", "lt", "open", "quote", "nested", "comments", "script"])
def test_awkward_pages_take_linear_time(body):
    def seconds(page):
        t0 = time.process_time()
        assert len(parse_cards(page)) == 1
        return time.process_time() - t0

    least = min(seconds(START + body[:len(body) // 4]) for _ in range(2))
    assert seconds(START + body) < max(1.0, 8 * least)


def test_open_tags_with_stray_ends_read_as_before():
    page = (START + "<b></i></p>" + '<span class="a-size-medium">One</i></span></span></u>'
            + '<span class="a-price-whole">7<b>0</span></div></div>' + START + "</b></div>")
    got = parse_cards(page)
    assert [(c["name_medium"], c["price_text"]) for c in got] == [("One", "70"), (None, None)]


def test_sponsored_string_of_an_only_child_chain():
    assert one("<span><b><i>Spon<!-- -->sored</i></b></span>")["sponsored"] is False
    assert one("<span><b><i>A Sponsored ad</i></b></span>")["sponsored"] is True
    assert one("<span><b>x</b><i>Sponsored</i></span>")["sponsored"] is False
    inner = '<div data-component-type="s-search-result" data-asin="B2"><span>sponsored</span></div>'
    both = parse_cards(START + inner + START.replace("B1", "B3") + "</div></div>")
    assert [c["sponsored"] for c in both] == [True, True, False]


def test_a_start_tag_of_a_page_is_read_once(monkeypatch):
    from bazaarlens.functions import cards as C
    read, plain = [], C._attributes
    monkeypatch.setattr(C, "_attributes", lambda text: read.append(text) or plain(text))
    card = START + '<span class="a-size-medium">One</span><span class="x">y</span></div>'
    got = parse_cards(card * 50)
    assert [c["name_medium"] for c in got] == ["One"] * 50
    assert len([x for x in read if x.startswith(" class")]) == 2


def test_leaf_elements_read_like_start_text_and_end():
    c = one('<br>a</br><span/>b</span><span class="a-size-medium">T &amp; U</SPAN>'
            '<h2> </h2><b><span class="a-price-whole">7</span></b><p>Sponsored</p>')
    assert (c["name_medium"], c["price_text"], c["name_h2"]) == ("T & U", "7", "")
    assert c["sponsored"] is False
    leaf = '<div data-component-type="s-search-result" data-asin="B2">text</div>'
    assert [x["asin_attr"] for x in parse_cards(START + leaf + "</div>" + leaf)] == ["B1", "B2", "B2"]
    assert one("<span><a>Sponsored</a><!-- x --></span>")["sponsored"] is False
