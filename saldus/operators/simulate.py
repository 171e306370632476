"""What an import would do: totals, forecast and their text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from saldus.context import Context
from saldus.functions.memo import made_once
from saldus.functions.text import cents
from saldus.operators.validate import needs_review

NOTICE = "SIMULACAO - nenhum dado foi gravado, nenhum banco foi acessado, nenhuma importacao real ocorreu."
TOTALS = ("total_registros", "validos", "validos_com_aviso", "invalidos", "clientes_com_debito", "clientes_sem_debito", "total_debito", "total_credito", "com_celular", "sem_celular", "com_cpf", "sem_cpf", "observacoes_estruturadas", "observacoes_vazias")
FORECAST = ("novos", "atualizacoes", "ignorados", "revisao_manual")


def counters(status: Column, avisos: Column) -> list[Column]:
    """TOTALS and revisao_manual, as aggregates over validated records, whose state and warnings are given."""
    owes = F.coalesce(F.col("saldo_debito_nex") > 0, F.lit(False))
    has = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    n = F.count_if
    money = lambda c: F.coalesce(F.sum(cents(F.nanvl(F.col(c), F.lit(0.0)))), F.lit(0).cast("decimal(38,2)")).cast("decimal(38,2)")
    return [
        F.count(F.lit(1)).alias("total_registros"),
        n(status == "valido").alias("validos"),
        n(status == "valido_com_aviso").alias("validos_com_aviso"),
        n(status == "invalido").alias("invalidos"),
        n(owes).alias("clientes_com_debito"),
        n(~owes).alias("clientes_sem_debito"),
        money("saldo_debito_nex").alias("total_debito"),
        money("saldo_credito_nex").alias("total_credito"),
        n(has("celular")).alias("com_celular"),
        n(~has("celular")).alias("sem_celular"),
        n(has("cpf_cnpj")).alias("com_cpf"),
        n(~has("cpf_cnpj")).alias("sem_cpf"),
        n(F.col("observacao_categoria") == "estruturada").alias("observacoes_estruturadas"),
        n(F.col("observacao_categoria") == "vazia").alias("observacoes_vazias"),
        n(needs_review(avisos)).alias("revisao_manual"),
    ]


@made_once
def _own_counters() -> list[Column]:
    return counters(F.col("validacao_status"), F.col("avisos"))


def report(counts: DataFrame, context: Context = Context()) -> DataFrame:
    """The report from its counters: totals, forecast, file and notice."""
    # No base is known at this point: all that can be imported counts as new.
    forecast = {"novos": F.col("validos") + F.col("validos_com_aviso"), "atualizacoes": F.lit(0).cast("bigint"), "ignorados": F.col("invalidos")}
    return counts.select(*TOTALS, *(forecast.get(x, F.col(x)).alias(x) for x in FORECAST), F.lit(context.file).alias("arquivo"), F.lit(NOTICE).alias("aviso_geral"), F.lit(True).alias("simulacao"))


def simulate(validated: DataFrame, context: Context = Context()) -> DataFrame:
    """The report as one row, from one aggregation."""
    return report(validated.agg(*_own_counters()), context)


_RULE = "====================================="
_LINES = (
    (("Total de registros", "total_registros"), ("Registros validos", "validos"), ("Registros com aviso", "validos_com_aviso"), ("Registros invalidos", "invalidos")),
    (("Clientes com debito", "clientes_com_debito"), ("Clientes sem debito", "clientes_sem_debito"), ("Total do debito", "total_debito"), ("Total do credito", "total_credito")),
    (("Com celular", "com_celular"), ("Sem celular", "sem_celular"), ("Com CPF", "com_cpf"), ("Sem CPF", "sem_cpf")),
    (("Observacoes estruturadas", "observacoes_estruturadas"), ("Observacoes vazias", "observacoes_vazias")),
)
_FORECAST = (
    ("Novos clientes", "novos", "nesta simulacao, TODOS os validos/com aviso contam como novos - ainda nao existe banco para comparar"),
    ("Atualizacoes", "atualizacoes", "sempre 0 nesta fase, pelo mesmo motivo"),
    ("Ignorados", "ignorados", "registros invalidos, nao seriam importados"),
    ("Revisao manual", "revisao_manual", "subconjunto que seria importado, mas marcado para revisao humana antes de qualquer cobranca automatica"),
)


def format_report(report: Row) -> str:
    """The report row as text."""
    value = lambda f: f"R$ {report[f]:.2f}" if f.startswith("total_") and f != "total_registros" else str(report[f])
    lines = [_RULE, "PREVIA DA IMPORTACAO (SIMULACAO - NADA FOI GRAVADO)", _RULE, "", f"Arquivo: {report['arquivo'] or '(nao informado)'}", ""]
    for group in _LINES:
        lines += [f"{label}: {value(f)}" for label, f in group] + [""]
    lines += ["Resultado previsto:", *(f"  {label}: {report[f]} ({why})" for label, f, why in _FORECAST), _RULE]
    return "\n".join(lines)


def report_lines(report: DataFrame) -> DataFrame:
    """The same text as rows (linha, texto), without a collect."""
    value = lambda f: F.concat(F.lit("R$ "), F.col(f).cast("string")) if f.startswith("total_") and f != "total_registros" else F.col(f).cast("string")
    lit = F.lit
    lines = [lit(_RULE), lit("PREVIA DA IMPORTACAO (SIMULACAO - NADA FOI GRAVADO)"), lit(_RULE), lit(""), F.concat(lit("Arquivo: "), F.coalesce(F.nullif("arquivo", lit("")), lit("(nao informado)"))), lit("")]
    for group in _LINES:
        lines += [F.concat(lit(f"{label}: "), value(f)) for label, f in group] + [lit("")]
    lines += [lit("Resultado previsto:"), *(F.concat(lit(f"  {label}: "), value(f), lit(f" ({why})")) for label, f, why in _FORECAST), lit(_RULE)]
    return report.select(F.posexplode(F.array(*lines)).alias("linha", "texto"))
