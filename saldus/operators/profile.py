"""A masked data-quality profile of raw sheets, each aggregate in one pass over the rows.

Input: (sheet, row_idx, cells, is_text), see sources.exports.read_matrix. Only the header row, found among a sheet's first rows, comes to the
driver; it decides which column is which.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldus.functions import parsers
from saldus.functions.barrier import settled
from saldus.functions.text import blank, cents, digits, header_key, shape, tags

SCAN_ROWS = 15
NO_COLUMN = "coluna nao identificada"


def with_text_marks(matrix: DataFrame) -> DataFrame:
    """matrix with is_text where it came without: cells that were read formatted are all text."""
    return matrix if "is_text" in matrix.columns else matrix.withColumn("is_text", F.transform("cells", lambda c: c.isNotNull()))


def header_rows(matrix: DataFrame) -> DataFrame:
    """(sheet, header_idx): the first row among a sheet's first SCAN_ROWS with two filled cells, half of them text; -1 if there is none."""
    m = with_text_marks(matrix)
    full = F.zip_with("cells", "is_text", lambda c, t: F.struct((~blank(c)).alias("full"), F.coalesce(t, F.lit(False)).alias("text")))
    n = F.size(F.filter(full, lambda x: x["full"]))
    n_text = F.size(F.filter(full, lambda x: x["full"] & x["text"]))
    good = (F.col("row_idx") < SCAN_ROWS) & (n >= 2) & (n_text >= 0.5 * n)
    return m.groupBy("sheet").agg(F.coalesce(F.min(F.when(good, F.col("row_idx"))), F.lit(-1)).cast("bigint").alias("header_idx"))


def row_kinds(matrix: DataFrame) -> DataFrame:
    """Rows below their sheet's header, with kind: vazia, cabecalho_repetido or util."""
    heads = header_rows(matrix).where("header_idx >= 0")
    keys = lambda cells: F.array_join(F.transform(cells, lambda c: header_key(F.coalesce(c, F.lit("")))), "\u0001")
    titles = matrix.join(heads, "sheet").where("row_idx = header_idx").select(F.col("sheet"), F.col("header_idx"), keys(F.col("cells")).alias("_key"))
    empty = F.forall("cells", blank)
    rows = matrix.join(titles, "sheet").where("row_idx > header_idx")
    return rows.select("sheet", "row_idx", "cells", F.when(empty, F.lit("vazia")).when(keys(F.col("cells")) == F.col("_key"), F.lit("cabecalho_repetido")).otherwise(F.lit("util")).alias("kind"))


def row_accounting(matrix: DataFrame) -> DataFrame:
    """For each sheet: rows below the header, blank ones (with the first 20 row numbers), repeated headers and useful rows."""
    rows = row_kinds(matrix)
    kind = lambda k: F.count_if(F.col("kind") == k)
    counts = rows.groupBy("sheet").agg(F.count(F.lit(1)).alias("linhas_brutas"), kind("vazia").alias("linhas_vazias"), kind("cabecalho_repetido").alias("cabecalhos_repetidos"), kind("util").alias("registros_uteis"))
    # The first 20 of a sheet are among the first 20 of its parts: a sheet with many blank rows isn't ranked in one task.
    part = F.pmod("row_idx", F.lit(64))
    blank_rows = rows.where("kind = 'vazia'").select("sheet", "row_idx", F.row_number().over(Window.partitionBy("sheet", part).orderBy("row_idx")).alias("n")).where("n <= 20")
    first = blank_rows.withColumn("n", F.row_number().over(Window.partitionBy("sheet").orderBy("row_idx"))).where("n <= 20")
    shown = first.groupBy("sheet").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.col("row_idx") + 1)), lambda x: x.cast("string")), ", ").alias("primeiras_vazias"))
    return counts.join(shown, "sheet", "left").withColumn("primeiras_vazias", F.coalesce("primeiras_vazias", F.lit("")))


def column_tags(headers: DataFrame) -> DataFrame:
    """(sheet, tag, cabecalhos): the headers of (sheet, pos, header) that carry a tag, in order of their columns. A sheet's headers are as many as its columns."""
    tagged = headers.select("sheet", "pos", "header", F.explode(tags(F.col("header"))).alias("tag"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "header")))
    return tagged.groupBy("sheet", "tag").agg(F.array_join(F.transform(ordered, lambda x: x["header"]), ", ").alias("cabecalhos"))


@dataclass(frozen=True)
class Columns:
    """Places of the columns that matter; None where a sheet lacks one."""

    nome: int | None = None
    telefone: int | None = None
    cpf_cnpj: int | None = None
    saldo_dc: int | None = None
    observacoes: int | None = None
    celular: int | None = None


def find_columns(matrix: DataFrame, sheet: str) -> Columns:
    """The first column of each tag in the sheet's header row; the mobile column is the one whose key is just that word."""
    heads = header_rows(matrix).where((F.col("sheet") == sheet) & (F.col("header_idx") >= 0))
    row = matrix.join(heads, "sheet").where("row_idx = header_idx").select(F.transform("cells", lambda c: F.struct(tags(c).alias("tags"), header_key(c).alias("key"))).alias("h")).first()
    if row is None:
        return Columns()
    first = lambda ok: next((i for i, h in enumerate(row["h"]) if ok(h)), None)
    return Columns(**{t: first(lambda h, t=t: t in h["tags"]) for t in ("nome", "telefone", "cpf_cnpj", "saldo_dc", "observacoes")}, celular=first(lambda h: h["key"] == "celular"))


def useful_rows(matrix: DataFrame, sheet: str, columns: Columns | None = None) -> DataFrame:
    """The sheet's useful rows as named text columns (null for a column that isn't there), with _ord."""
    at = columns or find_columns(matrix, sheet)
    cell = lambda i: F.lit(None).cast("string") if i is None else F.get("cells", F.lit(i))
    rows = row_kinds(matrix).where((F.col("sheet") == sheet) & (F.col("kind") == "util"))
    return rows.select(F.col("row_idx").alias("_ord"), *(cell(getattr(at, f)).alias(f) for f in Columns.__dataclass_fields__))


def missing(rows: DataFrame, columns: Columns) -> DataFrame:
    """sem_nome, sem_telefone, sem_cpf as text; a column that isn't there says so."""
    count = lambda f: F.lit(NO_COLUMN) if getattr(columns, f) is None else F.count_if(blank(F.col(f))).cast("string")
    return rows.agg(F.count(F.lit(1)).alias("registros"), count("nome").alias("sem_nome"), count("telefone").alias("sem_telefone"), count("cpf_cnpj").alias("sem_cpf"))


def duplicates(rows: DataFrame, columns: Columns) -> DataFrame:
    """criterio and duplicidades: how many documents (or names, without a document column) occur more than once."""
    if columns.cpf_cnpj is None and columns.nome is None:
        return rows.limit(1).agg(F.lit("nenhum").alias("criterio"), F.lit(None).cast("bigint").alias("duplicidades"))
    by, key = ("cpf_cnpj", digits(F.col("cpf_cnpj"))) if columns.cpf_cnpj is not None else ("nome", header_key(F.col("nome")))
    groups = rows.select(key.alias("k")).where("k <> ''").groupBy("k").count()
    return groups.agg(F.lit(by).alias("criterio"), F.count_if(F.col("count") > 1).alias("duplicidades"))


def parsed(rows: DataFrame) -> DataFrame:
    """rows with what the parsers make of the balance and the note."""
    out = parsers.signals(rows, "saldo_dc", "observacoes").withColumn("fin", parsers.parsed_balance())
    known = F.col("fin.tipo") == "reconhecido"
    return settled(out.withColumns(
        {
            "tem_debito": F.coalesce(known & (F.col("fin.debito") > 0), F.lit(False)),
            "tem_credito": F.coalesce(known & (F.col("fin.credito") > 0), F.lit(False)),
            "categoria": parsers.parsed_category(),
        }
    ).withColumnsRenamed({"_days": "dias", "_counts": "parcelas", "_values": "valores"}))


def _total(of: str, when: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col(when), cents(F.col(of)))), F.lit(0).cast("decimal(38,2)")).cast("decimal(38,2)")


def financial(rows: DataFrame) -> DataFrame:
    deb, cre = F.col("tem_debito"), F.col("tem_credito")
    sums = parsed(rows).agg(
        F.count(F.lit(1)).alias("registros"),
        F.count_if(deb).alias("com_debito"),
        F.count_if(cre).alias("com_credito"),
        F.count_if(deb & cre).alias("com_ambos"),
        F.count_if(~deb & ~cre).alias("sem_movimentacao"),
        F.count_if(F.col("fin.tipo") == "formato_nao_reconhecido").alias("nao_reconhecidos"),
        _total("fin.debito", "tem_debito").alias("total_debito"),
        _total("fin.credito", "tem_credito").alias("total_credito"),
    )
    return sums.withColumn("saldo_liquido", (F.col("total_debito") - F.col("total_credito")).cast("decimal(38,2)"))


def unrecognized_shapes(rows: DataFrame, n: int = 5) -> DataFrame:
    """(formato, quantidade): the first n digit-masked shapes that aren't recognised, in order of their first rows."""
    odd = parsed(rows).where("fin.tipo = 'formato_nao_reconhecido'").select("_ord", shape(F.col("fin.raw")).alias("formato"))
    return odd.groupBy("formato").agg(F.count(F.lit(1)).alias("quantidade"), F.min("_ord").alias("_first")).orderBy("_first", "formato").limit(n).drop("_first")


NOTE_CATEGORIES = ("vazia", "estruturada", "parcialmente_estruturada", "texto_operacional", "ambigua")


def notes(rows: DataFrame) -> DataFrame:
    kinds = (F.count_if(F.col("categoria") == k).alias(k) for k in NOTE_CATEGORIES)
    some = lambda c: F.count_if(F.size(c) > 0)
    return parsed(rows).agg(*kinds, some("dias").alias("com_dia"), some("parcelas").alias("com_parcela"), some("valores").alias("com_valor"))


def examples(rows: DataFrame, n: int = 5) -> DataFrame:
    """(tipo, exemplo, posicao): of days, instalments and values, the first n that differ, in order of appearance; values are masked after that."""
    from pyspark.sql import Window

    p = parsed(rows)

    def seen(kind: str, column: str, say) -> Column:
        return F.transform(F.col(column), lambda x, i: F.struct(F.lit(kind).alias("tipo"), say(x).alias("v"), i.alias("i")))

    found = F.concat(seen("dia", "dias", lambda x: F.concat(F.lit("dia "), x.cast("string"))), seen("parcela", "parcelas", lambda x: F.concat(x.cast("string"), F.lit("x"))), seen("valor", "valores", lambda x: x))
    first = p.select("_ord", F.explode(found).alias("x")).groupBy("x.tipo", "x.v").agg(F.min(F.struct("_ord", "x.i")).alias("at"))
    ranked = first.withColumn("posicao", F.row_number().over(Window.partitionBy("tipo").orderBy("at", "v"))).where(F.col("posicao") <= n)
    return ranked.select("tipo", F.when(F.col("tipo") == "valor", shape(F.col("v"))).otherwise(F.col("v")).alias("exemplo"), "posicao")


def contactability(rows: DataFrame) -> DataFrame:
    """Debtors with and without a note and a mobile number, and the share with one, in per cent with one decimal."""
    deb, note, mobile = F.col("tem_debito"), ~blank(F.col("observacoes")), ~blank(F.col("celular"))
    counts = parsed(rows).agg(
        F.count_if(deb & note).alias("debito_e_observacao"),
        F.count_if(deb & ~note).alias("debito_sem_observacao"),
        F.count_if(deb & mobile).alias("debito_e_celular"),
        F.count_if(deb & ~mobile).alias("debito_sem_celular"),
    )
    all_ = F.col("debito_e_celular") + F.col("debito_sem_celular")
    tenths = F.floor((2000 * F.col("debito_e_celular") + all_) / (2 * all_)).cast("bigint")
    return counts.withColumn("percentual", F.when(all_ == 0, F.lit("0.0")).otherwise(F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))))


def reconcile(rows: DataFrame, reference: float) -> DataFrame:
    """The total of debts against a total known from elsewhere."""
    total = parsed(rows).agg(_total("fin.debito", "tem_debito").alias("total_calculado"))
    out = total.withColumn("total_referencia", F.lit(reference).cast("decimal(38,2)"))
    gap = F.abs(F.col("total_calculado") - F.col("total_referencia")).cast("decimal(38,2)")
    return out.withColumns({"diferenca": gap, "valores_iguais": F.when(gap < 0.01, F.lit("Sim")).otherwise(F.lit("Nao"))})


