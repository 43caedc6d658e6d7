import json

from terralume.sources import pages


def test_card_source_detail():
    layer = [{"page": {"detail": {"list_id": 7654321, "ad_id": 9, "adDate": "1700000000", "price": "1800", "zipcode": "01310200"}, "adDetail": {"municipality": "Sao Paulo", "street": "Rua }]; A", "subCategory": "Casas"}, "adProperties": [{"name": "rooms", "value": "2"}, {"name": "condominio", "value": "R$ 5"}]}}]
    html = f"<script>window.dataLayer = {json.dumps(layer)};</script><meta property='og:description' content='Um &amp; dois'>"
    r = pages.parse_page("olx", html, "https://sp.olx.com.br/x/aluguel/casa-7654321")
    assert (r["property_id"], r["ad_id"], r["listing_created_at"], r["zipcode"], r["bedrooms"], r["condo_fee_brl"], r["description"], r["business_type"], r["street"]) == ("7654321", "9", "2023-11-14T22:13:20+00:00", "01310-200", "2", "R$ 5", "Um & dois", "rent", "Rua }]; A")
    assert pages.parse_page("olx", "<html>", "u") == {} and pages.parse_page("olx", None) == {}


def test_nested_source_detail():
    state = {"k": {"b": {"product": {"name": "Apartamento", "address": {"street": "Rua A", "city": "C"}, "attributes": [{"type": "area_attr", "value": "70m²"}], "prices": {"sale": 5}, "features": ["x"], "seo": {"url": "/imovel/REO1/venda-apartamento/"}}}, "z": [{"map": {"lat": "-1.5", "lng": "2"}}]}}
    r = pages.parse_page("lopes", f'<script id="ng-state" type="application/json">{json.dumps(state)}</script>')
    assert (r["property_id"], r["business_type"], r["total_area_m2"], r["suites"], r["lat"], r["features_json"], r["listing_url"]) == ("REO1", "sale", "70", "0", "-1.5", '["x"]', "https://www.lopes.com.br/imovel/REO1/venda-apartamento/")


def test_house_source_detail():
    info = {"forRent": True, "forSale": True, "parkingSpots": 0, "garageSpots": 2, "hasFurniture": False, "address": {"address": "Rua B", "zipCode": "01310200"}, "listings": [{"businessContext": "SALE", "status": "on"}, {"businessContext": "RENT", "status": "off"}], "generatedDescription": {"shortRentDescription": "curto"}}
    page = f'<script id="__NEXT_DATA__" type="application/json">{json.dumps({"props": {"pageProps": {"initialState": {"house": {"houseInfo": info}}}}})}</script>'
    r = pages.parse_page("quinto", page, "https://h/imovel/892/comprar/")
    assert (r["business_type"], r["property_id"], r["parking_spots"], r["sale_listing_status"], r["rent_listing_status"], r["description"], r["furnished"], r["zipcode"]) == ("rent|sale", "892", "2", "on", "off", "curto", "False", "01310-200")


def card(n, parts="tmb", extra=""):
    top = f'<div class="olx-adcard__topbody" data-mode="horizontal"><a href="/imoveis/casa-{n:07d}"><h2>Casa {n}</h2></a></div>'
    middle = f'<div class="olx-adcard__mediumbody"><span>condomínio</span><h3>R$ {n}.800</h3></div>'
    bottom = '<div class="olx-adcard__bottombody"><p class="typo olx-adcard__date">Hoje, 10:16</p></div>'
    return f'<div class="olx-adcard"><div>{top if "t" in parts else ""}{middle if "m" in parts else ""}</div>{bottom if "b" in parts else ""}{extra}</div>'


def test_cards_of_one_list():
    page = '<div class="AdListing_adListContainer__x">' + card(1) + card(2) + card(1) + card(3, "tm") + card(4, "mb") + card(5, "tb", "<br><p>") + "</div>" + card(9)
    got = pages.parse_cards(page)
    assert [(c["listing_url"], c["price_text"], c["raw_card_date_text"], c["title"]) for c in got] == [
        ("/imoveis/casa-0000001", "R$ 1.800", "Hoje, 10:16", "Casa 1"), ("/imoveis/casa-0000002", "R$ 2.800", "Hoje, 10:16", "Casa 2"),
        ("/imoveis/casa-0000003", "R$ 3.800", None, "Casa 3"), ("/imoveis/casa-0000005", None, "Hoje, 10:16", "Casa 5"),
    ]
    assert pages.parse_cards("") == pages.parse_cards(card(1)) == []
    assert pages.picture_urls([{"medium": "/m.jpg", "url": "u"}, "//h/p.png", 3, {}]) == ["https://www.olx.com.br/m.jpg", "https://h/p.png"] and pages.picture_urls(4) == []


def test_address_page():
    assert pages.parse_address_page("<p>Rua A · Centro · Cidade X/SP</p> 01310-200", "01310200") == {"street": "Rua A", "neighbourhood": "Centro", "city": "Cidade X", "state": "SP"}
    assert pages.parse_address_page("<p>nada</p>", "01310200") is None


def test_pages_as_a_frame(spark):
    df = spark.createDataFrame([("k", "<html>", "u"), ("m", '<script>dataLayer.push({"list_id": 7, "price": 3})</script>', "https://h/venda/x")], "key string, html string, url string")
    assert [(r.key, r.property_id, r.price, r.business_type) for r in pages.parse_pages(df, "olx", "html", "url", key="key").collect()] == [("m", "7", "3", "sale")]
