from __future__ import annotations

import io
import struct

import pytest
import workbooks as w

from saldus.operators import profile
from saldus.plans import flows
from saldus.sources import exports, workbook
from saldus.sources.failures import CODES, ImportFailure

STRINGS = ["Código", "Nome", "Débito / Crédito", "Ana", "日本 long text of two widths", "Celular"]
ROWS = {(0, 0): "Código", (0, 1): "Nome", (0, 2): "Débito / Crédito", (0, 3): "Celular", (0, 5): "Nome", (1, 0): 42, (1, 1): "Ana", (1, 2): "Débito- R$ 200,00", (1, 3): 11999990000.0, (3, 0): 7.5, (3, 1): "=Bea", (3, 3): True, (4, 0): 42, (4, 1): "Ana again"}


def book(**more):
    numbers = {(2, 1): (1234.5, 1), (2, 2): (0.25, 2), (2, 3): (45292.75, 3), (3, 1): (-3.0, 1), (3, 2): (struct.pack("<HH", 0xBD, 18) + struct.pack("<HHHLHLH", 3, 2, 0, 100 << 2 | 3, 1, 7 << 2 | 2, 3)), (4, 1): (struct.pack("<HHHHHBB", 0x205, 8, 4, 1, 0, 0x07, 1))}
    sheets = {"Clientes": w.sheet(ROWS, STRINGS, (0, 5, 0, 6)), "Números": w.sheet(numbers, STRINGS), "Vazia": w.sheet({}, STRINGS)}
    return w.stream(sheets, STRINGS, ("#,##0.00;(#,##0.00)", "0%", "dd/mm/yyyy hh:mm"), **more)


def failure(call):
    with pytest.raises(ImportFailure) as e:
        call()
    return e.value.codigo


def test_all_sheets_of_all_files(spark, tmp_path):
    (tmp_path / "one.xls").write_bytes(w.compound(book()))
    (tmp_path / "two.xls").write_bytes(w.compound(w.stream({"Só": w.sheet({(0, 0): "ü"}, [])}), small=True))
    (tmp_path / "note.txt").write_text("not a workbook")
    sheets = exports.read_sheets(spark, f"file://{tmp_path}/*.xls")
    assert sheets.rdd.getNumPartitions() == 4  # file x sheet
    got = {}
    for r in sheets.orderBy("file", "sheet_idx", "row_idx").collect():
        got.setdefault((r["file"].rpartition("/")[2], r["sheet"]), []).append((r["row_idx"], r["cells"], r["shown"], r["is_text"]))
    assert set(got) == {("one.xls", "Clientes"), ("one.xls", "Números"), ("two.xls", "Só")}
    rows = got["one.xls", "Clientes"]
    assert [x[0] for x in rows] == [0, 1, 2, 3, 4] and rows[1][1] == ["42", "Ana", "Débito- R$ 200,00", "11999990000", "", ""] and rows[2][1] == [""] * 6
    assert rows[3][1] == ["7.5", "Bea", "", "TRUE", "", ""] and rows[3][3] == [False, True, False, False, False, False]
    numbers = got["one.xls", "Números"]
    assert [x[1] for x in numbers] == [["1234.5", "0.25", "45292.75"], ["-3", "1", "7"], ["#DIV/0!", "", ""]]
    assert [x[2] for x in numbers] == [["1,234.50", "25%", "01/01/2024 18:00"], ["(3.00)", "1", "7.00"], ["#DIV/0!", "", ""]]
    assert got["two.xls", "Só"] == [(0, ["ü"], ["ü"], [True])]
    matrix = exports.matrix_of(sheets)
    assert {r["sheet"]: r["header_idx"] for r in profile.header_rows(matrix).collect()} == {"Clientes": 0, "Números": 0, "Só": -1}
    assert profile.find_columns(matrix, "Clientes").saldo_dc == 2


def test_first_sheet_as_an_export(spark, tmp_path):
    done = flows.analyze_upload(spark, w.compound(book()), "clientes%20de%20mar%C3%A7o.xls", f"file://{tmp_path}", "2024-03-01")
    rows = done.registros.orderBy("_ord").collect()
    assert [(r["nex_codigo"], r["nome"], r["celular"], r["saldo_debito_nex"]) for r in rows] == [("42", "Ana", "11999990000", 200), ("7.5", "Bea", "TRUE", 0), ("42", "Ana again", None, 0)]
    assert {r["fonte_arquivo_origem"] for r in rows} == {"clientes de março.xls"} and {r["data_snapshot_nex"] for r in rows} == {"2024-03-01"}
    assert done.relatorio.first()["total_registros"] == 3
    raw = exports.read_upload(spark, w.compound(book()), "x.XLS", f"file://{tmp_path}")
    assert raw.columns == ["_ord", "Código", "Nome", "Débito / Crédito", "Celular", "__EMPTY", "Nome_1"]


def test_the_five_failures_and_the_cap(spark, tmp_path, monkeypatch):
    upload = lambda body, name=None: flows.analyze_upload(spark, body, name, f"file://{tmp_path}")
    good = w.compound(book())
    assert CODES == ("formato_invalido", "arquivo_vazio", "erro_leitura", "planilha_vazia", "estrutura_incompativel")
    assert failure(lambda: upload(b"", "a.csv")) == CODES[0] and failure(lambda: upload(b"", "a.xls")) == CODES[1]
    protected = w.compound(book(extra=w.record(0x2F, b"\0\0")))
    for body in (b"plain text", good[:3000], w.compound(book(version=0x0500)), protected):
        assert failure(lambda body=body: upload(body)) == CODES[2]
    for sheets in ({"S": w.sheet({}, [])}, {"S": w.sheet({(0, 0): "Nome"}, [])}):
        assert failure(lambda s=sheets: upload(w.compound(w.stream(s)))) == CODES[3]
    assert failure(lambda: upload(w.compound(w.stream({"S": w.sheet({(0, 0): "outra", (1, 0): "x"}, [])})))) == CODES[4]
    monkeypatch.setattr(exports, "UPLOAD_BYTES", 100)
    assert failure(lambda: upload(good)) == "upload_invalido" and failure(lambda: flows.import_payload(None, b" " * 101, None)) == "upload_invalido"


def test_names_of_uploads():
    assert [exports.file_name(x) for x in ("a%20b.xls", "m%C3%A7.xls", "100%.xls", "%E0%A4%A.xls", "%FF.xls", "", None, "plain.xls")] == ["a b.xls", "mç.xls", None, None, None, None, None, "plain.xls"]


@pytest.mark.parametrize("cut", [None, *range(60, 150, 7)])
def test_strings_that_continue_in_another_record(cut):
    """Wherever a string is cut: its rest says anew how wide it is."""
    strings = ["a" * 40, "b" * 200, "c"]
    stream = w.stream({"S": w.sheet({(0, i): s for i, s in enumerate(strings)}, strings)}, strings, cut=cut)
    read = workbook.Compound(io.BytesIO(w.compound(stream)))
    assert workbook.workbook_globals(read).strings == strings


def test_numbers_as_they_are_shown():
    since = workbook.Globals().since
    shown = lambda x, code: workbook.shown_number(x, code, since)
    for x, code, want in (
        (0.1 + 0.2, "General", "0.3"), (1e15, "General", "1E+15"), (12.0, "0.00", "12.00"), (1234567.891, "#,##0.00", "1,234,567.89"), (-5.5, "0.0", "-5.5"), (0.5, "#.00", ".50"), (1.5, "0.##", "1.5"), (1234.0, '"R$ "#,##0.00', "R$ 1,234.00"),
        (0.0, "0;-0;zero", "zero"), (0.126, "0.0%", "12.6%"), (12345.0, "0.00E+00", "1.23E+04"), (7.0, "000", "007"), (45292.0, "m/d/yy", "1/1/24"), (45292.5, "d-mmm-yy", "1-Jan-24"), (0.75, "h:mm AM/PM", "6:00 PM"), (45292.25, "[$-416]dddd, yyyy", "Monday, 2024"), (3.0, "@", "3"),
    ):
        assert (x, code, shown(x, code)) == (x, code, want)
    assert workbook.rk(struct.unpack("<L", struct.pack("<l", -7 << 2 | 2))[0]) == -7 and workbook.rk(12345 << 2 | 3) == 123.45 and workbook.rk(struct.unpack("<Q", struct.pack("<d", 1.5))[0] >> 32) == 1.5
