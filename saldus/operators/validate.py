"""Validation: an ordered bank of rules on each record, kept on its row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldus.functions import text
from saldus.functions.memo import made_once
from saldus.schema import CONSENT_VALUES, STATUS_VALUES


def _is_number(name: str) -> Column:
    return F.col(name).isNotNull() & ~F.isnan(name)


def errors() -> list[tuple[Column, Column]]:
    """(rule, message) in the order in which messages stand."""
    c = F.col
    missing = lambda f, more="": (text.blank(c(f)), F.lit(f'campo obrigatorio "{f}" ausente{more}'))
    deb, cre, net, status, consent = (c(x) for x in ("saldo_debito_nex", "saldo_credito_nex", "valor_liquido_nex", "status_cobranca", "consentimento_contato"))
    numbers = ("saldo_debito_nex", "saldo_credito_nex", "valor_liquido_nex")
    all_numbers = _is_number(numbers[0]) & _is_number(numbers[1]) & _is_number(numbers[2])
    return [
        missing("nome", " ou vazio"),
        *(missing(f) for f in ("nex_codigo", "origem_sistema", "data_snapshot_nex", "fonte_arquivo_origem", "consentimento_contato", "status_cobranca")),
        (c("historico").isNull(), F.lit('campo obrigatorio "historico" nao e um array')),
        (c("tentativas_cobranca").isNull(), F.lit('campo obrigatorio "tentativas_cobranca" nao e numero')),
        *((~_is_number(f), F.lit(f'"{f}" nao e numero')) for f in numbers),
        (_is_number("saldo_debito_nex") & (deb < 0), F.lit('"saldo_debito_nex" negativo')),
        (_is_number("saldo_credito_nex") & (cre < 0), F.lit('"saldo_credito_nex" negativo')),
        (all_numbers & (F.abs(deb - cre - net) > 0.01), F.concat(F.lit('"valor_liquido_nex" ('), text.number_text(net), F.lit(") nao bate com debito-credito ("), text.fixed2(deb - cre), F.lit(")"))),
        (~text.blank(status) & ~status.isin(*STATUS_VALUES), F.concat(F.lit('"status_cobranca" fora do enum permitido: "'), status, F.lit('"'))),
        (~text.blank(consent) & ~consent.isin(*CONSENT_VALUES), F.concat(F.lit('"consentimento_contato" fora do enum permitido: "'), consent, F.lit('"'))),
        (_is_number("saldo_debito_nex") & (deb > 0) & (status == "sem_debito"), F.lit('status_cobranca = "sem_debito" mas saldo_debito_nex > 0')),
        (_is_number("saldo_debito_nex") & (deb == 0) & (status == "em_aberto"), F.lit('status_cobranca = "em_aberto" mas saldo_debito_nex = 0')),
    ]


def warnings() -> list[tuple[Column, Column]]:
    c = F.col
    owes = _is_number("saldo_debito_nex") & (c("saldo_debito_nex") > 0)
    return [
        (owes & text.blank(c("celular")) & text.blank(c("telefone")), F.lit("cliente com debito em aberto mas sem celular nem telefone cadastrado")),
        (owes & text.blank(c("cpf_cnpj")), F.lit("cliente com debito em aberto mas sem CPF/CNPJ cadastrado")),
        (owes & (c("observacao_categoria") == "ambigua"), F.lit("observacao ambigua (dias conflitantes) em cliente com debito - revisar antes de qualquer cobranca automatica")),
        (c("vencimento_sugerido").isNotNull() & (c("confianca_extracao") == "baixa"), F.lit("vencimento_sugerido existe mas com confianca_extracao baixa - nao usar sem confirmacao humana")),
        (c("parcelamento_sugerido").isNotNull() & c("parcelamento_sugerido.valor").isNull(), F.lit("parcelamento_sugerido incompleto (sem valor de parcela reconhecido)")),
    ]


def _messages(rules: list[tuple[Column, Column]]) -> Column:
    return F.array_compact(F.array(*(F.when(F.coalesce(rule, F.lit(False)), message) for rule, message in rules)))


@made_once
def _found() -> dict[str, Column]:
    return {"erros": _messages(errors()), "avisos": _messages(warnings())}


@made_once
def _status() -> Column:
    return status_of(F.col("erros"), F.col("avisos"))


def status_of(erros: Column, avisos: Column) -> Column:
    return F.when(F.size(erros) > 0, F.lit("invalido")).when(F.size(avisos) > 0, F.lit("valido_com_aviso")).otherwise(F.lit("valido"))


def validate(records: DataFrame) -> DataFrame:
    """records with erros, avisos (arrays of messages) and validacao_status."""
    return records.withColumns(_found()).withColumn("validacao_status", _status())


def validation_summary(validated: DataFrame) -> DataFrame:
    """total, validos, validos_com_aviso, invalidos: one row."""
    n = lambda s: F.count_if(F.col("validacao_status") == s)
    return validated.agg(F.count(F.lit(1)).alias("total"), n("valido").alias("validos"), n("valido_com_aviso").alias("validos_com_aviso"), n("invalido").alias("invalidos"))


#: Parts of warnings that ask for a person's review.
REVIEW = "ambigua|confianca_extracao baixa|incompleto|sem celular nem telefone"


def needs_review(avisos: Column) -> Column:
    return F.exists(F.coalesce(avisos, F.array().cast("array<string>")), lambda a: a.rlike(REVIEW))
