"""Canned filters, search and display projections over analysed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldus.functions.memo import made_once
from saldus.functions.text import fixed2, money, yes_no


@made_once
def filters() -> dict[str, Column]:
    owes = F.coalesce(F.col("saldo_debito_nex") > 0, F.lit(False))
    return {
        "todos": F.lit(True),
        "com_debito": owes,
        "sem_debito": ~owes,
        "com_aviso": F.col("validacao_status") == "valido_com_aviso",
        "invalidos": F.col("validacao_status") == "invalido",
        "revisao_manual": F.col("revisao_manual"),
        "com_celular": F.col("tem_celular"),
        "sem_celular": ~F.col("tem_celular"),
    }


#: Filters that read what validation says of a record.
NEED_VALIDATION = ("com_aviso", "invalidos", "revisao_manual")


def filter_records(records: DataFrame, name: str = "todos", term: str | None = None) -> DataFrame:
    """Records of a canned filter (an unknown name filters nothing) whose code, name or numbers hold the term, case aside."""
    out = records.where(filters().get(name, F.lit(True)))
    needle = (term or "").lower().strip()
    if not needle:
        return out
    holds = lambda c: F.contains(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(needle))
    return out.where(holds("nex_codigo") | holds("nome") | holds("telefone") | holds("celular"))


def review_rows(records: DataFrame) -> DataFrame:
    c = F.col
    return records.select(
        "_ord", "nex_codigo", "nome", money(c("saldo_debito_nex")).alias("debito"), money(c("saldo_credito_nex")).alias("credito"), "status_cobranca",
        yes_no(c("tem_celular")).alias("celular"), yes_no(c("tem_cpf")).alias("cpf"), "observacao_categoria", "validacao_status", "qtd_avisos",
    )


def warning_rows(warned: DataFrame) -> DataFrame:
    c = F.col
    return warned.select("_ord", "nex_codigo", "nome", money(c("saldo_debito")).alias("debito"), yes_no(c("tem_celular"), "Nao").alias("celular"), yes_no(c("tem_cpf"), "Nao").alias("cpf"), "qtd_avisos", F.array_join("avisos", "; ").alias("avisos"))


#: How states are called.
STATUS_LABELS = {
    "sem_debito": "Sem débito",
    "em_aberto": "Em aberto (devendo)",
    "em_negociacao": "Em negociação",
    "cobranca_enviada": "Cobrança já enviada",
    "promessa_pagamento": "Promessa de pagamento registrada",
    "pago": "Dívida quitada",
    "inadimplente_recorrente": "Inadimplente recorrente",
}


def status_label(status: Column) -> Column:
    labels = F.create_map(*(F.lit(x) for pair in STATUS_LABELS.items() for x in pair))
    return F.coalesce(F.try_element_at(labels, status), status, F.lit(""))


@made_once
def explanation() -> Column:
    """A record in a sentence or more."""
    c, lit = F.col, F.lit
    debit, credit, day, plan = c("saldo_debito_nex"), c("saldo_credito_nex"), c("vencimento_sugerido"), c("parcelamento_sugerido")
    said = c("observacao_categoria") != "vazia"
    parts = (
        F.when(debit > 0, F.concat(lit("Cliente possui débito de R$ "), fixed2(debit), lit(' extraído da coluna "Débito / Crédito" do NEX.')))
        .when(credit > 0, F.concat(lit("Cliente sem débito, mas com crédito de R$ "), fixed2(credit), lit(" a favor.")))
        .otherwise(lit("Cliente sem débito na exportação do NEX.")),
        F.when(said, F.concat(lit('Observação classificada como "'), c("observacao_categoria"), lit('".'))).otherwise(lit("Nenhuma observação registrada no NEX.")),
        F.when(said & day.isNotNull(), F.concat(lit("Sugestão de vencimento: dia "), day.cast("string"), lit(" (confiança "), F.coalesce(c("confianca_extracao"), lit("null")), lit(")."))),
        F.when(said & plan.isNotNull(), F.concat(lit("Sugestão de parcelamento: "), plan["qtd"].cast("string"), lit("x"), F.coalesce(F.concat(lit(" de R$ "), fixed2(plan["valor"])), lit("")), lit("."))),
        F.when(F.size("avisos") > 0, F.concat(F.size("avisos").cast("string"), lit(" aviso(s) de validação encontrado(s)."))).otherwise(lit("Nenhum aviso de validação.")),
    )
    return F.concat_ws(" ", *parts)


def details(records: DataFrame) -> DataFrame:
    """Label and value sections of each record, with placeholders for what is missing: one struct column a section."""
    c, lit = F.col, F.lit
    given = lambda x: F.when(x != "", x)
    or_empty = lambda x: F.coalesce(given(x), lit("(vazio)"))
    joined = lambda sep, *fs: or_empty(F.concat_ws(sep, *(given(c(f)) for f in fs)))
    amount = F.coalesce(c("parcelamento_sugerido.valor"), lit(0.0))
    source = {
        "Código NEX": c("nex_codigo"), "Nome": c("nome"), "Telefone": or_empty(c("telefone")), "Celular": or_empty(c("celular")), "E-mail": or_empty(c("email")), "CPF/CNPJ": or_empty(c("cpf_cnpj")),
        "Endereço": joined(", ", "endereco_logradouro", "endereco_numero", "endereco_complemento"),
        "Bairro/Cidade/UF": joined(" / ", "endereco_bairro", "endereco_cidade", "endereco_uf"),
        "CEP": or_empty(c("endereco_cep")), "Observação original": or_empty(c("observacao_original_nex")),
    }
    normalised = {"Débito (NEX)": money(c("saldo_debito_nex")), "Crédito (NEX)": money(c("saldo_credito_nex")), "Saldo líquido": money(c("valor_liquido_nex")), "Situação (status_cobranca)": c("status_cobranca")}
    suggested = {
        "Categoria da observação": c("observacao_categoria"),
        "Vencimento sugerido": F.coalesce(F.concat(lit("dia "), c("vencimento_sugerido").cast("string")), lit("(nenhum)")),
        "Parcelamento sugerido": F.when(c("parcelamento_sugerido").isNotNull(), F.concat(c("parcelamento_sugerido.qtd").cast("string"), lit("x de "), money(amount))).otherwise(lit("(nenhum)")),
        "Confiança da extração": F.coalesce("confianca_extracao", lit("(nenhuma)")),
    }
    section = lambda values: F.array(*(F.struct(lit(k).alias("rotulo"), v.alias("valor")) for k, v in values.items()))
    return records.select("_ord", "nex_codigo", section(source).alias("dados_nex"), section(normalised).alias("dados_normalizados"), section(suggested).alias("sugestoes"), "avisos", "erros", status_label(c("status_cobranca")).alias("classificacao_financeira"), explanation().alias("explicacao"))


#: Cards of the report, label and field.
PREVIEW_CARDS = (("Total de registros", "total_registros"), ("Registros validos", "validos"), ("Registros com aviso", "validos_com_aviso"), ("Registros invalidos", "invalidos"), ("Clientes com debito", "clientes_com_debito"), ("Clientes sem debito", "clientes_sem_debito"), ("Total do debito", "total_debito"), ("Total do credito", "total_credito"), ("Com celular", "com_celular"), ("Sem celular", "sem_celular"), ("Com CPF", "com_cpf"), ("Sem CPF", "sem_cpf"), ("Observacoes estruturadas", "observacoes_estruturadas"), ("Observacoes vazias", "observacoes_vazias"), ("Revisao manual", "revisao_manual"))
FORECAST_CARDS = (("Novos clientes", "novos"), ("Atualizacoes", "atualizacoes"), ("Ignorados", "ignorados"), ("Revisao manual", "revisao_manual"))
TOP_CARDS = (("Total de registros", "total_registros"), ("Total do débito", "total_debito"), ("Total do crédito", "total_credito"), ("Clientes com débito", "clientes_com_debito"), ("Revisão manual", "revisao_manual"), ("Válidos", "validos"), ("Avisos", "validos_com_aviso"), ("Inválidos", "invalidos"))
RESULT_CARDS = (("Total processado", "total_processado"), ("Novos clientes", "criados"), ("Atualizados", "atualizados"), ("Quitados", "quitados"), ("Sem alteração", "sem_alteracao"), ("Removidos/ausentes", "nao_aplicados"), ("Revisão manual (da análise)", "revisao_manual"), ("Avisos na sincronização", "total_avisos"))


def cards(report: DataFrame, which: tuple[tuple[str, str], ...] = PREVIEW_CARDS) -> DataFrame:
    """A report row as (posicao, rotulo, valor)."""
    value = lambda f: F.concat(F.lit("R$ "), F.col(f).cast("string")) if f in ("total_debito", "total_credito") else F.col(f).cast("string")
    pairs = F.array(*(F.struct(F.lit(label).alias("rotulo"), value(f).alias("valor")) for label, f in which))
    return report.select(F.posexplode(pairs).alias("posicao", "card")).select("posicao", "card.rotulo", "card.valor")


def size_text(n: int) -> str:
    if n < 1024:
        return f"{n} B"
    return f"{n / 1024:.1f} KB" if n < 1024 * 1024 else f"{n / 1024 / 1024:.2f} MB"


def check_upload(names: list[str]) -> str | None:
    """What is wrong with the files chosen; None if nothing is."""
    if len(names) > 1:
        return "Selecione apenas um arquivo por vez."
    if not names:
        return "Nenhum arquivo selecionado."
    return None if names[0].lower().endswith(".xls") else "Formato invalido. Selecione um arquivo .xls exportado pelo NEX."
