import datetime

import pytest
from pyspark.sql import functions as F

from terralume.functions import jsonx
from terralume.functions import scalars as S
from terralume.functions.instants import parse_instant
from terralume.functions.places import plain, state_code
from terralume.functions.usable import source_name, usable_amount, usable_count, usable_text, usable_zip


def values(spark, f, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


CASES = [
    (S.digits_int, ["R$ 1.234,56", "-5", "", None, "abc"], [123456, 5, None, None, None]),
    (S.to_int, ["1731.58", "R$ 1.800", "134m2", "134 m²", "5 ou mais", None], [1731, 1800, 134, 134, 5, None]),
    (S.br_float, ["R$ 1.234,56", "12,5", "", "x"], [1234.56, 12.5, None, None]),
    (S.to_float, ["-23.5", "1.234,5", "96.0", None], [-23.5, 1234.5, 96.0, None]),
    (S.plain_float, [" -23.4620491 ", "", "x"], [-23.4620491, None, None]),
    (S.flag, ["1", " Sim ", "não", "no", "talvez", None], [True, True, False, False, None, None]),
    (S.zip_dashed, ["04567000", "cep 04567-000.", "123", None], ["04567-000", "04567-000", None, None]),
    (S.zip_digits, ["4567000", "04567-000", "123456789", "", None], ["04567000", "04567000", None, None, None]),
    (S.slug, ["São Paulo / SP", "  Água-Branca "], ["sao-paulo-sp", "agua-branca"]),
    (S.token, [" ÁRVORE ", "€x"], ["arvore", "x"]),
    (S.strip_tags, ["<p>a <b>b</b>\n c</p>", "<br>", None], ["a b c", None, None]),
    (S.business_from_url, ["https://x/aluguel/1", "https://x/comprar/y", "https://x/z"], ["rent", "sale", None]),
    (S.id_from_url, ["https://x/imovel/REO1/abc", "https://x/imoveis/casa-1234567?a=1", "https://x"], ["REO1", "1234567", None]),
    (S.lastmod_date, ["2026-04-29T23:00:00-03:00", "20260429", "2026-02-30", "x", None], [datetime.date(2026, 4, 29), datetime.date(2026, 4, 29), None, None, None]),
    (S.run_date, ["13-04-2026", "2026-04-13"], [datetime.date(2026, 4, 13), None]),
    (S.unix_iso, ["1775455573", "0", "x"], ["2026-04-06T06:06:13+00:00", None, None]),
    (lambda c: S.point(c)[0], ["POINT(-46.6 -23.5)", "POINT EMPTY", None], [-23.5, None, None]),
    (lambda c: S.property_type(c), ["APARTAMENTO novo", "Casa", " loft ", ""], ["Apartamento", "Casa", "loft", None]),
    (lambda c: S.absolute_url("https://h.example/a", c), ["/x", "https://o/y", "", "z"], ["https://h.example/x", "https://o/y", None, "https://h.example/a/z"]),
    (lambda c: S.page_url(c, F.lit(2)), ["https://x/a", "https://x/a?b=1"], ["https://x/a?sf=1&o=2", "https://x/a?b=1&sf=1&o=2"]),
    (usable_text, ["Casa", "n/d", " N.A. ", "*****", "xxx", "", None, "não informado"], [True, False, False, False, False, False, False, False]),
    (usable_zip, ["04567-000", "00000-000", "sem cep", None], [True, False, False, False]),
    (lambda c: usable_amount(c.cast("bigint")), ["1800", "0", "-1", "1", "999999999", "123456789", None], [True, False, False, False, False, False, False]),
    (lambda c: usable_count(c.cast("bigint")), ["0", "3", "-1", "99", "999", "120", None], [True, True, False, False, False, True, False]),
    (source_name, [" OLX ", "", "\t", None], ["olx", None, None, None]),
    (state_code, ["Estado: São Paulo", "BR-SP", "sp ", "Sao Paulo (SP)", "Mato Grosso", "xx", None], ["SP", "SP", "SP", "SP", "MT", None, None]),
    (plain, ["SÃ£o JosÃ©", "São José", "Óbidos"], ["sao jose", "sao jose", "obidos"]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_scalar(spark, case):
    f, inputs, expected = CASES[case]
    assert values(spark, f, inputs) == expected


def test_card_dates(spark):
    on = F.lit(datetime.date(2026, 4, 13))
    got = values(spark, lambda c: S.card_date(c, on), ["Hoje, 10:16", "Ontem, 23:33", "11 de abr, 03:26", "31 de dez, 23:33", "x", None, "Hoje, 99:99"])
    assert got == ["2026-04-13T10:16:00-03:00", "2026-04-12T23:33:00-03:00", "2026-04-11T03:26:00-03:00", "2025-12-31T23:33:00-03:00", None, None, None]


def test_instants(spark):
    texts = ["2026-01-05T04:07:06+00:00", "2026-01-05 04:07:06", "05/01/2026 04:07:06", "1767586026", "2026-01-05T04:07:06.5Z", "0000-00-00", "ontem", "", None, "2026-02-30 00:00:00"]
    got = values(spark, lambda c: F.unix_micros(parse_instant(c)), texts)
    base = 1767586026_000_000
    assert got == [base, base + 3 * 3600_000_000, base + 3 * 3600_000_000, base, base + 500_000, None, None, None, None, None]


def test_amenities(spark):
    text = '["x", 3, {"name": " Condominio", "value": "R$ 1.760"}, {"name": "z", "label": "Nº do andar", "value": "7"}, {"name": "re_features", "values": [{"label": "Mobiliado"}]}, {"name": "floor"}]'
    items = lambda c: jsonx.objects(c)
    assert values(spark, lambda c: jsonx.value_of(items(c), ["condominio"]), [text, "{}", "[1", None]) == ["R$ 1.760", None, None, None]
    assert values(spark, lambda c: jsonx.value_of(items(c), ["floor"], "andar"), [text]) == [None]  # found by name, without value
    assert values(spark, lambda c: jsonx.value_of(items(c), ["nope"], "andar"), [text]) == ["7"]
    assert values(spark, lambda c: jsonx.has_label(items(c), ["re_features"], "mobiliado"), [text, "[]"]) == [True, False]
    assert values(spark, lambda c: jsonx.all_props(items(c))["z"], [text]) == ["7"]
