"""Column functions on hand-written cases."""

import datetime as dt
import unicodedata

import pytest
from pyspark.sql import functions as F

from quadrata.functions import dates, names, numeric, text
from quadrata.functions.entities import canonicalize_by_table
from quadrata.plans import territory as t


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_snake_case(spark):
    cases = {"año": "ano", "CBDj": "cbdj", "2024 Total": "c_2024_total", "%%": "columna", "a--b__C": "a_b_c"}
    assert [names.snake_case(n) for n in cases] == list(cases.values())
    assert values(spark, list(cases), names.snake_case_col) == list(cases.values())
    assert names.dedupe_names(["A", "a", "A "]) == ["a", "a_2", "a_3"]
    assert names.bad_names(["ok_1", "Bad", "1x", "_x"]) == ["Bad", "1x", "_x"]


def test_text_key(spark):
    cases = {
        "  Álvaro Obregón ": "ALVARO OBREGON",
        "Gustavo A. Madero": "GUSTAVO A MADERO",
        "Col. 1ra. Sección": "COL 1RA SECCION",
        "---": None,
        "Straße": "STRASSE",
        "étage ½ ﬁn": "ETAGE 1 2 FIN",
        "Ｆｕｌｌ": "FULL",
    }
    assert values(spark, [*cases, None], text.text_key) == [*cases.values(), None]
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert [r.k for r in text.with_text_keys(df, {"k": "v"}).collect()] == list(cases.values())


def test_strip_accents_is_nfkd_for_every_code_point(spark):
    letters = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    wide = {c for c in text._decompositions()[3]} | {chr(c) for c in range(0xAC00, 0xD7A4)}
    rest = [c for c in letters if c not in wide]
    samples = [*sorted(wide), *["".join(rest[i : i + 200]) for i in range(0, len(rest), 200)], "한글 é ROBO 𝐗", "漢字", "שָׁלוֹם"]
    want = ["".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)) for s in samples]
    assert values(spark, samples, text.strip_accents) == want
    assert values(spark, samples[-50:], text.strip_accents_nfkd) == want[-50:]


def test_title_label_and_strip(spark):
    assert values(spark, ["COL 1RA SECCION", "SAN JUAN", "A1B2C"], text.title_label) == [
        "Col 1Ra Seccion", "San Juan", "A1B2C",
    ]
    raw = ["  x y \t\n", " z", ""]
    assert values(spark, raw, text.strip_spaces) == [r.strip() for r in raw]


def test_canonical_entity(spark):
    cases = {
        "10": "ALVARO OBREGON", "10.0": "ALVARO OBREGON", "010.0": "ALVARO OBREGON", "10.5": None, "99": None,
        "Alcaldía Tlalpan": "TLALPAN", "Tlalpan Delegación": "TLALPAN", "Cuajimalpa": "CUAJIMALPA DE MORELOS",
        "Gustavo A. Madero CDMX": "GUSTAVO A MADERO", "Toluca": None, "  ": None,
        "Alcaldia Magdalena Contreras": "LA MAGDALENA CONTRERAS", "Delegación": None,
    }
    assert values(spark, [*cases, None], t.CATALOG.canonical) == [*cases.values(), None]
    assert values(spark, [10.0, 10.5, None], t.CATALOG.canonical, "double") == ["ALVARO OBREGON", None, None]
    df = spark.createDataFrame([(k, "17") for k in cases], "a string, b string")
    got = [r.k for r in t.CATALOG.with_canonical(df, "k", "a", "b").collect()]
    assert got == [v or "VENUSTIANO CARRANZA" for v in cases.values()]
    assert values(spark, ["TLALPAN", None], t.CATALOG.name) == ["Tlalpan", None]
    assert values(spark, ["AZCAPOTZALCO", "XOCHIMILCO"], t.CATALOG.id) == [1, 16]


def test_classify_rules(spark):
    cases = {
        "ROBO DE ACCESORIOS DE AUTO": "ROBO_DE_ACCESORIOS_AUTO",
        "ROBO DE OBJETOS DEL INTERIOR DE UN VEHICULO": "ROBO_DEL_INTERIOR_DE_VEHICULO",
        "ROBO A PASAJERO EN INTERIOR DE VEHICULO": "ROBO_DEL_INTERIOR_DE_VEHICULO",
        "ROBO A PASAJERO A BORDO DE TAXI": "ROBO_A_TRANSEUNTE",
        "ROBO A NEGOCIO SIN VIOLENCIA": "ROBO_A_NEGOCIO",
        "Robo a casa-habitación": "ROBO_A_CASA_HABITACION",
        "ROBO DE VEHICULO PARTICULAR": "ROBO_DE_VEHICULO",
        "ROBO A REPARTIDOR": "OTRO",
        "FRAUDE": "OTRO",
    }

    def classify(c):
        return text.classify_rules(text.text_key(c), t.CLASS_RULES, t.OTHER_CLASS)

    assert values(spark, [*cases, None], classify) == [*cases.values(), "OTRO"]
    assert values(spark, ["a", "b", None], lambda c: text.flag_in(c, ["a"])) == [1, 0, 0]
    assert values(spark, ["TRUE", "1", "no", None], text.to_bool) == [True, True, False, False]


def test_parse_month(spark):
    texts = {"03": 3, "Marzo": 3, "setiembre": 9, "13": None, "3.0": None, "marz": None, "0": None, "012": 12}
    assert values(spark, list(texts), lambda c: dates.parse_month(c, t.MONTH_NUMBERS)) == list(texts.values())
    numbers = [3.0, 3.5, 13.0, None]
    got = values(spark, numbers, lambda c: dates.parse_month(c, t.MONTH_NUMBERS, numeric=True), "double")
    assert got == [3, None, None, None]


def test_time_keys(spark):
    rows = [("2018", "5"), ("2018.0", None), ("x", "1"), ("2018", "y")]
    df = spark.createDataFrame(rows, "y string, m string")
    assert [r.k for r in df.select(dates.time_id("y", "m").alias("k")).collect()] == [201805, 201800, None, None]
    keys = spark.createDataFrame([(201600,), (201612,), (202200,)], "k int")
    attributes = dates.time_attributes("k", t.MONTHS, [202200])
    assert [tuple(r) for r in keys.select(*attributes.values()).collect()] == [
        (2016, 0, "anual", 0, "anual"),
        (2016, 12, "diciembre", 4, "mensual"),
        (2022, 0, "anual", 0, "anual_snapshot"),
    ]


def test_parse_date(spark):
    cases = {"2019-05-02": dt.date(2019, 5, 2), "bad": None, "0222-01-01": None, "2300-01-01": None, None: None}
    assert values(spark, list(cases), dates.parse_date) == list(cases.values())


def test_numbers(spark):
    cases = {"1.5": 1.5, " 2 ": 2.0, "x": None, "12d": None, "NaN": None, "": None, "1e3": 1000.0, None: None}
    assert values(spark, list(cases), numeric.try_double) == list(cases.values())
    rows = spark.createDataFrame([(3, 12), (None, 12), (0, 0)], "n int, d int")
    assert [r[0] for r in rows.select(numeric.share("n", "d")).collect()] == [0.25, 0.0, None]


@pytest.mark.parametrize("raw,ok", [(b"caf\xc3\xa9", True), (b"caf\xe9", False), (b"", True)])
def test_utf8(spark, raw, ok):
    df = spark.createDataFrame([(bytearray(raw),)], "v binary")
    assert df.select(text.is_utf8("v")).first()[0] is ok


def test_canonical_by_table(spark):
    aliases = spark.createDataFrame([("CUAJIMALPA", "CUAJIMALPA DE MORELOS")], "alias string, entity_key string")
    df = spark.createDataFrame([(" cuajimalpa. ",), ("Toluca",), (None,)], "place string")
    got = canonicalize_by_table(df, "place", aliases, "key").collect()
    assert {(r.place, r.key) for r in got} == {(" cuajimalpa. ", "CUAJIMALPA DE MORELOS"), ("Toluca", None), (None, None)}
