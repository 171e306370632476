from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saldus.functions import parsers, text

BALANCES = [
    ("Débito- R$ 150,00", ("reconhecido", 150, 0)),
    ("Débito: R$ 1.234,56", ("reconhecido", 1234.56, 0)),
    ("Crédito- R$ 50,00", ("reconhecido", 0, 50)),
    ("Débito- R$ 100,00 Crédito- R$ 20,00", ("reconhecido", 100, 20)),
    ("", ("vazio", None, None)),
    (None, ("vazio", None, None)),
    ("R$ 0,00", ("zero", 0, 0)),
    ("0", ("zero", 0, 0)),
    ("texto aleatorio sem valor", ("formato_nao_reconhecido", None, None)),
    ("Débito -5,00", ("reconhecido", 5, 0)),
    ("Débito: -5,00", ("formato_nao_reconhecido", None, None)),
    ("Débito: R$ 0,00", ("reconhecido", 0, 0)),
    ("100,00", ("formato_nao_reconhecido", None, None)),
    ("DÉBITO R$ 10,00", ("reconhecido", 10, 0)),
]


def test_balances(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(BALANCES)], "i int, x string")
    got = {r["i"]: (r["b"]["tipo"], r["b"]["debito"], r["b"]["credito"]) for r in df.select("i", parsers.balance(F.col("x")).alias("b")).collect()}
    assert got == {i: e for i, (_, e) in enumerate(BALANCES)}


AMOUNTS = [("150,00", 150), ("1.234,56", 1234.56), ("1.234", 1.234), ("1.234.567", 1.234), ("1,234,567", 1.234), ("1,234.56", 1.23456), ("100,00.", 100), (",", None), (".", None), ("  ", None), (None, None)]


def test_amounts(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(AMOUNTS)], "i int, x string")
    assert {r["i"]: r["v"] for r in df.select("i", parsers.amount(F.col("x")).alias("v")).collect()} == {i: e for i, (_, e) in enumerate(AMOUNTS)}


NOTES = [
    ("2x 75,00 todo dia 20", "estruturada", [20], [2], ["75,00"]),
    ("dia 15", "parcialmente_estruturada", [15], [], []),
    ("avisar antes de entregar", "texto_operacional", [], [], []),
    ("dia 5 ou dia 20", "ambigua", [5, 20], [], []),
    ("", "vazia", [], [], []),
    ("3x50,00", "parcialmente_estruturada", [], [], ["50,00"]),
    ("dia 100", "texto_operacional", [], [], []),
    ("dia 05 dia 5", "parcialmente_estruturada", [5], [], []),
    ("12.345,6", "parcialmente_estruturada", [], [], ["12.34"]),
    ("édia 5", "parcialmente_estruturada", [5], [], []),
]


def test_notes(spark):
    df = spark.createDataFrame([(i, x[0]) for i, x in enumerate(NOTES)], "i int, x string")
    c = F.col("x")
    got = {r["i"]: (r["k"], r["d"], r["p"], r["v"]) for r in df.select("i", parsers.note_category(c).alias("k"), parsers.note_days(c).alias("d"), parsers.note_instalments(c).alias("p"), parsers.note_values(c).alias("v")).collect()}
    assert got == {i: tuple(x[1:]) for i, x in enumerate(NOTES)}


def plain_amount(s):
    s = s.strip()
    if "," in s:
        s = s.replace(".", "").replace(",", ".", 1)
    m = re.match(r"\d+\.?\d*|\.\d+", s)
    return float(m[0]) if m else None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.,", max_size=12), min_size=40, max_size=80))
def test_amounts_like_a_plain_parser(spark, cells):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cells)], "i int, x string")
    assert {r["i"]: r["v"] for r in df.select("i", parsers.amount(F.col("x")).alias("v")).collect()} == {i: plain_amount(x) for i, x in enumerate(cells)}


@pytest.mark.parametrize(("mask", "cell", "expected"), [
    (text.mask_document, "123.456.789-01", "***.***.***-01"), (text.mask_document, "12345678000199", "**.***.***/****-99"), (text.mask_document, "12", "[DOCUMENTO OCULTO]"), (text.mask_document, None, ""),
    (text.mask_phone, "(11) 99999-1234", "(**) *****-1234"), (text.mask_phone, "-", ""), (text.mask_email, " ana@ex.com ", "a***@ex.com"), (text.mask_email, "ana", "[EMAIL OCULTO]"), (text.mask_email, " ", ""),
    (text.mask_address, "Rua A", "[ENDEREÇO OCULTO]"), (text.shape, " R$ 12,3 ", "R$ ##,#"), (text.header_key, "  Observações ", "observacoes"), (text.compare_key, "  AbC ", "abc"),
])
def test_masks_and_keys(spark, mask, cell, expected):
    assert spark.createDataFrame([(cell,)], "x string").select(mask(F.col("x")).alias("m")).first()["m"] == expected


def test_round2(spark):
    values = [(2.5, 2.5), (-2.005, -2.0), (1.005, 1.01), (0.125, 0.13), (-0.125, -0.12)]
    df = spark.createDataFrame([(a,) for a, _ in values], "x double")
    assert [r["y"] for r in df.select(text.round2(F.col("x")).alias("y")).collect()] == [b for _, b in values]


def test_money_of_half_cents_and_huge_amounts(spark):
    exact = {1.005: "1.00", 0.005: "0.01", 0.015: "0.01", 2.675: "2.67", -1.005: "-1.00", 0.125: "0.13", -0.125: "-0.13", 0.001: "0.00", 999.995: "1000.00", 1e15: "1000000000000000.00", 123456789012345680000.0: "123456789012345683968.00", 1e20: "100000000000000000000.00", 1e21: "1e+21", 7e22: "7e+22"}
    exact |= {v: format(v, ".2f") for v in (0.01, 1.0, 0.994999, 123.455, 8.345, 70.075)}
    rows = spark.createDataFrame([(v,) for v in (*exact, None)], "v double").select("v", text.money(F.col("v")).alias("m")).collect()
    assert {r["v"]: r["m"] for r in rows} == {v: f"R$ {x}" for v, x in (exact | {None: "0.00"}).items()}


def test_huge_cells_go_through_the_flow(spark):
    from saldus.plans import flows

    rows = [(i, str(i), f"n{i}", c) for i, c in enumerate(["Débito- R$ 99999999999999999999,00", "Débito 1.005", "Débito " + "9" * 400])]
    raw = spark.createDataFrame(rows, "_ord bigint, `Código` string, `Nome` string, `Débito / Crédito` string")
    found = flows.analyze(raw)
    assert found.registros.count() == 3 and found.relatorio.count() == 1 and found.registros_com_aviso.count() >= 0


def test_headers_lose_all_marks(spark):
    assert spark.range(1).select(text.header_key(F.lit(" Šaldo dő Żebito Ệ "))).first()[0] == "saldo do zebito e"
