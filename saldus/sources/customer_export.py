"""Ledger exports rendered from the customer table, for queries over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldus.functions.memo import made_once

K = F.col


def _amounts(cents: Column) -> tuple[Column, Column]:
    """(plain, grouped) text of an amount in cents."""
    whole, rest = F.floor(cents / 100).cast("bigint"), F.lpad((cents % 100).cast("string"), 2, "0")
    thousands = F.floor(whole / 1000).cast("bigint")
    grouped = F.when(whole >= 1000, F.concat(thousands.cast("string"), F.lit("."), F.lpad((whole % 1000).cast("string"), 3, "0"))).otherwise(whole.cast("string"))
    return F.concat(whole.cast("string"), F.lit(","), rest), F.concat(grouped, F.lit(","), rest)


def _balance(k: Column, cents: Column) -> Column:
    plain, grouped = _amounts(cents)
    say = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    cells = {
        1: say("Débito- R$ ", plain),
        2: say("DÉBITO: R$ ", grouped),
        3: say("Crédito- R$ ", plain),
        4: say("Débito- R$ ", grouped, " Crédito- R$ 20,00"),
        5: F.lit("R$ 0,00"),
        6: F.lit("texto aleatorio sem valor"),
        7: say("  credito ", F.translate(plain, ",", ".")),
    }
    out = F.lit("")
    for r, cell in cells.items():
        out = F.when(k % 8 == r, cell).otherwise(out)
    return out


NOTES = ("", "2x 75,00 todo dia 20", "dia 15", "avisar antes de entregar", "dia 5 ou DIA 20", "3x dia 05", "1.234,56 em 4 x")


def _cells(cents: Column) -> dict[str, Column]:
    k = K("c_custkey")
    text = k.cast("string")
    note = F.lit(NOTES[0])
    for r, n in enumerate(NOTES[1:], 1):
        note = F.when(k % 7 == r, F.lit(n)).otherwise(note)
    return {
        "_ord": k,
        "Código": F.when(k % 101 == 7, F.lit("")).otherwise(text),
        "Nome": F.when(k % 53 == 0, F.lit("  ")).otherwise(K("c_name")),
        "CPF / CNPJ": F.when(k % 4 == 0, F.lpad(text, 11, "0")).otherwise(F.lit("")),
        "Telefone": F.when(k % 5 == 0, F.concat(F.lit("473322"), F.lpad((k % 10000).cast("string"), 4, "0"))).otherwise(F.lit("")),
        "Celular": F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("1199"), F.lpad((k % 10000000).cast("string"), 7, "0"))),
        "Débito / Crédito": _balance(k, cents),
        "Observações": note,
    }


def _cents() -> Column:
    return F.round(F.abs(K("c_acctbal")) * 100).cast("bigint")


@made_once
def _raw_cells() -> list[Column]:
    return [v.alias(n) for n, v in _cells(_cents()).items()]


def raw_export(customer: DataFrame) -> DataFrame:
    """One export: a row of text cells for each customer."""
    return customer.select(*_raw_cells())


@made_once
def _snapshot_cells() -> tuple[list[Column], list[Column]]:
    k, r = K("c_custkey"), K("c_custkey") % 11
    extra = {"Email": F.concat(F.lit("c"), k.cast("string"), F.lit("@ex.com")), "Cidade": F.concat(F.lit("Cidade "), K("c_nationkey").cast("string"))}
    earlier = _cells(_cents()) | extra
    cents = F.when(r == 1, F.lit(0)).when(r == 2, _cents() * 2).when(r == 3, F.floor(_cents() / 2).cast("bigint")).otherwise(_cents())
    cells = _cells(cents) | extra
    changed = {
        "Telefone": F.when(r == 4, F.lit("4799990000")).otherwise(cells["Telefone"]),
        "Email": F.when(r == 5, F.concat(F.lit(" C"), k.cast("string"), F.lit("@EX.COM"))).when(r == 6, F.concat(F.lit("novo"), k.cast("string"), F.lit("@ex.com"))).otherwise(cells["Email"]),
        "Cidade": F.when(r == 7, F.lit("Cidade Nova")).otherwise(cells["Cidade"]),
        "Observações": F.when(r == 8, F.lit("dia 28")).otherwise(cells["Observações"]),
        "Nome": F.when((r == 9) & (k % 53 != 0), F.lit("Renomeado")).otherwise(cells["Nome"]),
    }
    return tuple([v.alias(n) for n, v in own.items()] for own in (earlier, cells | changed))


#: Customers of whom one task makes the records of a snapshot.
DEALT = 1 << 16


def snapshots(customer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(earlier, later): exports that differ by new, missing, repeated and changed customers.

    A record made from an export takes some twenty times the bytes of its customer, and a plan sorts the records of each task before it sends them. So customers
    are dealt out while they are small, about DEALT to a task: else one task makes and sorts the records of a whole row group or file split, however long that is.
    """
    customer = customer.repartition(max(1, -(-customer.count() // DEALT)), "c_custkey")
    (one, two), k = _snapshot_cells(), K("c_custkey")
    earlier, later = customer.where(k % 10 != 9).select(*one), customer.where(k % 10 != 8).select(*two)
    again = later.where("_ord % 50 = 3").withColumns({"_ord": F.col("_ord") + 1_000_000, "Celular": F.lit("11900000000")})
    return earlier, later.unionByName(again)


#: The header row of a sheet that holds an export, for profiling.
SHEET_HEADERS = ("Código", "Nome", "CPF / CNPJ", "Telefone", "Celular", "Débito / Crédito", "Observações")


def sheet(customer: DataFrame) -> DataFrame:
    """An export as a sheet (sheet, row_idx, cells): a title, the headers, then rows, of which some are blank and some repeat the headers."""
    k = K("c_custkey")
    cells = _cells(_cents())
    row = F.when(k % 97 == 0, F.array_repeat(F.lit(""), len(SHEET_HEADERS))).when(k % 89 == 0, F.array(*(F.lit(h.upper()) for h in SHEET_HEADERS))).otherwise(F.array(*(cells[h] for h in SHEET_HEADERS)))
    body = customer.select(F.lit("Clientes").alias("sheet"), (k + 2).alias("row_idx"), row.alias("cells"))
    head = customer.sparkSession.createDataFrame([("Clientes", 0, ["Relatorio", *[""] * 6]), ("Clientes", 1, list(SHEET_HEADERS))], body.schema)
    return head.union(body)


#: Headers as exports of several programs have them.
FOUND_HEADERS = ("Código", "Cod.Cliente", "Razão Social", "Telefone", "Celular", "WhatsApp", "CPF / CNPJ", "E-mail", "Endereço", "Município", "UF", "Débito / Crédito", "Saldo em Aberto", "Vencimento", "Parcelas", "Limite de Crédito", "Última Venda", "Fiado", "Observações", "  NOME Fantasia ", "Telefone_2")


def headers(customer: DataFrame) -> DataFrame:
    """(sheet, pos, header): a header for each customer, a sheet for as many customers as there are headers; some in capitals, some with the nation's number or the market segment behind them."""
    k, n = K("c_custkey"), len(FOUND_HEADERS)
    plain = F.element_at(F.array(*map(F.lit, FOUND_HEADERS)), (k % n + 1).cast("int"))
    cased = F.when(k % 4 == 1, F.upper(plain)).otherwise(plain)
    more = F.when(k % 5 == 2, F.concat(F.lit(" "), K("c_nationkey").cast("string"))).when(k % 5 == 3, F.concat(F.lit(" / "), K("c_mktsegment"))).otherwise(F.lit(""))
    return customer.select(F.floor(k / n).cast("bigint").alias("sheet"), (k % n).cast("bigint").alias("pos"), F.concat(cased, more).alias("header"))
