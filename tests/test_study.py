"""The whole study on small raw files with defects, from CSV to checks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quadrata.operators import quality
from quadrata.plans import contracts as c
from quadrata.plans import territory as t
from quadrata.plans.analysis import AnalysisSpec, explain_target, profile_risk
from quadrata.plans.study import checks, read_sources, run_study
from quadrata.session import cut_lineage

SPELLED = {"TLALPAN": "Alcaldía Tlalpan", "CUAJIMALPA DE MORELOS": "Cuajimalpa", "GUSTAVO A MADERO": "Gustavo A. Madero"}
CODE = {key: code for code, key in t.SURVEY_CODES.items()}
CRIMES = {
    "ROBO A TRANSEUNTE EN VIA PUBLICA": "ROBO_A_TRANSEUNTE",
    "ROBO A NEGOCIO CON VIOLENCIA": "ROBO_A_NEGOCIO",
    "ROBO DE OBJETOS DEL INTERIOR DE UN VEHÍCULO": "ROBO_DEL_INTERIOR_DE_VEHICULO",
    "FRAUDE": "OTRO",
}


def write(path, header, rows, encoding="utf-8"):
    def cell(v):
        text = "" if v is None else str(v)
        return '"' + text.replace('"', '""') + '"' if any(x in text for x in ',"\n') else text

    lines = [",".join(header)] + [",".join(map(cell, row)) for row in rows]
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding))


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Raw files and the rows that must survive."""
    folder = tmp_path_factory.mktemp("raw")
    rng = random.Random(4)
    survey, snapshot, events, kept = [], [], [], []
    for key in t.BOROUGHS:
        for year in (2016, 2018, 2020):
            for _ in range(3):
                values = [round(rng.random(), 3) if rng.random() > 0.2 else None for _ in t.SOCIAL]
                survey.append([9, CODE[key], year, rng.randrange(1, 50), *values])
        for i in range(2):
            numbers = [round(rng.uniform(1, 9), 2) for _ in (*t.SUMMED, *t.AVERAGED)]
            snapshot.append([SPELLED.get(key, key.title()), f"{CODE[key]:02d}-{i}" if i else None, f"Col. {i + 1}ra. Sección", *numbers])
    survey.append([15, 2, 2016, 5, *[0.5] * 12])
    survey.append([9, 99, 2016, 5, *[0.5] * 12])
    survey.append([9, 2, "s/d", 5, *[0.5] * 12])
    snapshot.append(["Toluca", "x", "Centro", *[1] * 19])
    for i in range(600):
        key, year, month = rng.choice(t.BOROUGHS), rng.choice(range(2015, 2022)), rng.randrange(1, 13)
        crime = rng.choice(list(CRIMES))
        located = rng.random() > 0.2
        place = None if i % 10 == 0 else "Toluca" if i % 17 == 0 else SPELLED.get(key, key.title())
        date = "sin fecha" if i % 9 == 0 else f"{year}-{month:02d}-15"
        stated = None if i % 5 == 0 else year
        text = t.MONTHS[month].title() if i % 18 == 0 else None
        lat = 25.0 if i % 50 == 0 else 19.3
        events.append([
            stated, stated, text, date, date, crime + ("\n" if i % 7 == 0 else ""), "ALTO, bajo", place, key,
            f"Col {i % 3}" if i % 4 else None, "Listada", lat if located else None, -99.1 if located else None,
        ])
        entity = key if place in (None, "Toluca") else key
        known_year = stated or (year if i % 9 else None)
        known_month = month if i % 9 or i % 18 == 0 else None
        if known_year and known_month and 2016 <= known_year <= 2025:
            kept.append((entity, known_year, known_month, CRIMES[crime], located, lat))
    events.append([2018, 2018, "Mayo", "2018-05-01", "2018-05-01", "FRAUDE", "x", "Toluca", "Lerma", "a", "b", 19.3, -99.1])
    events.append([1999, 1999, "Mayo", "", "1999-05-01", "FRAUDE", "x", "Toluca", "Lerma", "a", "b", 19.3, -99.1])
    write(folder / "enc.csv", ["entidad", "municipio", "Año", "factor", *t.SOCIAL], survey, "latin-1")
    write(folder / "infra.csv", ["alcaldia", "CVE_COL", "colonia", *t.SUMMED, *t.AVERAGED], snapshot)
    header = [
        "anio_inicio", "anio_hecho", "mes_hecho", "fecha_hecho", "fecha_inicio", "delito", "categoria_delito",
        "alcaldia_hecho", "alcaldia_catalogo", "colonia_hecho", "colonia_catalogo", "latitud", "longitud",
    ]
    write(folder / "carpetas.csv", header, events)
    write(folder / "small.csv", ["anio_inicio", "delito", "alcaldia_hecho"], [[1, "x", "y"]])
    write(folder / "other.csv", ["a", "b"], [[1, 2]])
    return folder, survey, snapshot, events, kept


@pytest.fixture(scope="module")
def study(spark, raw, tmp_path_factory):
    out = tmp_path_factory.mktemp("layers")
    sources = read_sources(spark, str(raw[0]), f"{out}/landing")
    return run_study(spark, sources["pobreza"], sources["infraestructura"], sources["fgj"], str(out))


def test_events(study, raw):
    _, _, _, events, kept = raw
    counters = study.rejects.first().asDict()
    assert counters["original_rows"] == len(events)
    assert counters["clean_rows"] == len(kept) == study.clean["fgj_clean"].count()
    assert counters["invalid_entity"] == 2
    assert counters["with_coordinates"] == sum(k[4] for k in kept)
    assert counters["outside_box"] == sum(k[4] and k[5] == 25.0 for k in kept)
    assert counters["flagged_rows"] == sum(k[3] != "OTRO" for k in kept)
    annual = {(r.alcaldia_key, r.anio): r for r in study.analytics["delitos_alcaldia_anio"].collect()}
    for key, year in {k[:2] for k in kept}:
        rows = [k for k in kept if k[:2] == (key, year)]
        flagged = sum(k[3] != "OTRO" for k in rows)
        got = annual[key, year]
        assert (got[t.TOTAL], got[t.FLAGGED], got[t.NOT_FLAGGED]) == (len(rows), flagged, len(rows) - flagged)
        assert got[t.SHARE] == pytest.approx(flagged / len(rows)) and got.tiempo_id == year * 100
    monthly = study.analytics["robos_patrimoniales_alcaldia_mes_subtipo"]
    assert monthly.agg(F.sum(t.FLAGGED)).first()[0] == counters["flagged_rows"]
    wide = study.analytics["robos_patrimoniales_alcaldia_anio"].collect()
    assert all(r[t.TARGET] == sum(r[x] for x in t.CLASS_COLUMNS.values()) for r in wide)
    assert all(r.robo_de_vehiculo == 0 and r[t.LOG_TARGET] == pytest.approx(math.log1p(r[t.TARGET])) for r in wide)


def test_survey(study, raw):
    survey = raw[1]
    rows = {(r.alcaldia_key, r.anio): r for r in study.analytics["pobreza_alcaldia_anio"].collect()}
    assert len(rows) == 48
    for (key, year), got in rows.items():
        mine = [s for s in survey if s[0] == 9 and s[1] == CODE[key] and s[2] == year]
        pairs = [(s[3], s[4]) for s in mine if s[4] is not None]
        want = sum(w * v for w, v in pairs) / sum(w for w, _ in pairs) if pairs else None
        assert got.n_registros_sociales == 3 and got.factor_sum == sum(s[3] for s in mine)
        assert got.mmip_wmean == (None if want is None else pytest.approx(want))


def test_snapshot_and_dimension(study, raw):
    snapshot = raw[2]
    rows = {r.alcaldia_key: r for r in study.analytics["infraestructura_alcaldia"].collect()}
    assert set(rows) == set(t.BOROUGHS)
    mine = [s for s in snapshot if s[0] == SPELLED["TLALPAN"]]
    assert rows["TLALPAN"].mercados_total == pytest.approx(sum(s[4] for s in mine))
    assert rows["TLALPAN"].colonias_count == 2
    dim = study.star["dim_colonia"].orderBy("colonia_id").collect()
    assert [r.colonia_id for r in dim] == list(range(1, 33))
    assert dim[0].colonia_nombre == "Col 1Ra Seccion" and dim[0].cve_col is None
    assert study.star["fact_infraestructura_colonia"].where("colonia_id is null").count() == 0


def test_panel_and_contracts(study):
    panel = study.analytics["panel_alcaldia_anio"]
    assert panel.count() == 48
    assert study.analytics["modeling_panel"].columns == list(t.MODEL_COLUMNS)
    for name, contract in {**c.DIMENSIONS, **c.FACTS}.items():
        assert study.star[name].columns == contract.names
    assert len(c.REFERENCES) == 24 and len(c.GRAINS) == 7


def test_checks(study):
    report = {r.check_name: r for r in checks(study).collect()}
    failed = {n for n, r in report.items() if not r.passed}
    warnings = {n for n, r in report.items() if r.severity == "warning"}
    assert failed <= warnings and "fgj_clean.coordinates" in failed
    assert len(report) > 100
    quality.raise_on_critical(checks(study))


def test_a_broken_layer_fails(study):
    broken = study.star["fact_pobreza_alcaldia_anio"].withColumn("tiempo_id", F.lit(190000))
    report = checks(type(study)(study.clean, study.analytics, {**study.star, "fact_pobreza_alcaldia_anio": broken}, study.rejects))
    failed = {r.check_name for r in report.where("not passed and severity = 'critical'").collect()}
    assert failed == {"fact_pobreza_alcaldia_anio.grain", "fact_pobreza_alcaldia_anio.tiempo_id"}


def test_analysis(study):
    spec = AnalysisSpec(restarts=2, cluster_counts=(2, 3), eps_values=(1.0,))
    panel = cut_lineage(study.analytics["modeling_panel"])
    explained = explain_target(panel, study.analytics["feature_catalog"], spec)
    assert explained["ols"].count() == 5 and explained["importance"].count() == 7
    # The correlation with a constant column is undefined, so it comes last.
    ranked = explained["target_corr"].collect()
    constant = {"infraestructura_actualizacion_anio", "n_registros_sociales"}
    assert {r.feature for r in ranked[-2:]} == constant == {r.feature for r in ranked if r["corr"] is None}
    found = profile_risk(panel, spec)
    assert found["profiles"].count() == 48 == found["comparison"].count()
    means = {r.risk_label: r[f"{t.TARGET}_mean"] for r in found["summary"].collect()}
    assert means["Riesgo bajo"] <= means["Riesgo medio"] <= means["Riesgo alto"]
    with pytest.raises(ValueError, match="nbi_wmean"):
        profile_risk(panel.drop("nbi_wmean"), spec)
