"""Applying a plan to the base: new records, updates, settled debts, with an event for each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldus.context import Context
from saldus.functions.memo import made_once
from saldus.functions.text import round2
from saldus.operators.normalize import status_of
from saldus.operators.plan import CHANGED, FLAGS, NEW, REMOVED, SAME, net_balance
from saldus.schema import ADDRESS, AUTOMATIC_STATUS, EVENT, SCHEMA

NOTE_FIELDS = ("observacao_original_nex", "observacao_categoria", "vencimento_sugerido", "parcelamento_sugerido", "confianca_extracao")
#: Fields copied from the import when their flag is up.
COPIED = {"telefone": "telefoneMudou", "celular": "celularMudou", "email": "emailMudou"} | dict.fromkeys(ADDRESS, "enderecoMudou") | dict.fromkeys(NOTE_FIELDS, "observacaoMudou")


@dataclass
class Applied:
    """Lazy results; nothing is written. alterados: the records of nova_base that the plan creates or changes, with no more history than the event of it."""

    nova_base: DataFrame
    alterados: DataFrame
    eventos: DataFrame
    nao_aplicados: DataFrame
    avisos: DataFrame
    resumo: DataFrame
    simulacao: bool = True


def _event(**given: Column) -> Column:
    return F.struct(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT))


@made_once
def _case() -> Column:
    """What becomes of a plan row: criado, atualizado, quitado, sem_alteracao, nao_aplicado, or a notice alone."""
    b, n, tipo = F.col("b").isNotNull(), F.col("n").isNotNull(), F.col("tipo")
    return (
        F.when((tipo == NEW) & n, F.lit("criado"))
        .when((tipo == SAME) & b, F.lit("sem_alteracao"))
        .when((tipo == CHANGED) & b & n & (F.col("classificacao_saldo") == "divida_quitada"), F.lit("quitado"))
        .when((tipo == CHANGED) & b & n, F.lit("atualizado"))
        .when(tipo == REMOVED, F.lit("nao_aplicado"))
    )


@made_once
def _notice() -> Column:
    code, tipo = F.coalesce("nex_codigo", F.lit("null")), F.col("tipo")
    say = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    lost = F.col("_case").isNull()
    return (
        F.when(lost & (tipo == NEW), say("cliente_novo ", code, " sem correspondente em NOVA_IMPORTACAO - ignorado"))
        .when(lost & (tipo == SAME), say("sem_alteracao ", code, " sem correspondente em BASE_ATUAL - ignorado"))
        .when(lost & (tipo == CHANGED), say("com_alteracao ", code, " sem correspondente completo - ignorado"))
        .when(tipo == REMOVED, say("cliente ", code, " nao consta na nova exportacao - revisar manualmente antes de qualquer acao"))
        .when(lost, say("tipo de plano desconhecido para cliente ", code, ': "', F.coalesce(tipo, F.lit("undefined")), '"'))
    )


@made_once
def run_counters() -> list[Column]:
    """The summary of a run, as aggregates over cases()."""
    case = lambda x: F.count_if(F.col("_case") == x)
    return [case("criado").alias("criados"), case("atualizado").alias("atualizados"), case("quitado").alias("quitados"), case("sem_alteracao").alias("sem_alteracao"), case("nao_aplicado").alias("nao_aplicados"), F.count("_evento").alias("total_eventos"), F.count(F.lit(1)).alias("total_processado")]


def apply_plan(plan: DataFrame, context: Context) -> Applied:
    """Applies build_plan()'s rows. Records of people's making are kept: a sync never touches names, documents or states set by hand."""
    return applied(cases(plan, context), context)


def cases(plan: DataFrame, context: Context) -> DataFrame:
    """plan with what becomes of each row (_case) and the event of it (_evento)."""
    if context.executed is None or not callable(context.new_id):
        raise ValueError("the context must say when the run is executed and how identifiers are made")
    return plan.withColumn("_case", _case()).withColumn("_evento", _events(context.executed))


@made_once
def _events(executed: str) -> Column:
    when = F.lit(executed)
    created, updated, settled = (F.col("_case") == x for x in ("criado", "atualizado", "quitado"))
    flag = {f: F.coalesce(F.col(f"alteracoes.{f}"), F.lit(False)) for f in FLAGS}
    return (
        F.when(created, _event(tipo=F.lit("cliente_importado"), origem=F.lit("NEX"), data=when, saldo_inicial=net_balance("n")))
        .when(
            updated,
            _event(
                tipo=F.lit("cliente_atualizado"),
                campos_alterados=F.array_compact(F.array(*(F.when(flag[f], F.lit(f)) for f in FLAGS))),
                saldo_anterior=F.col("saldo_anterior"),
                saldo_novo=F.col("saldo_atual"),
                diferenca=F.col("diferenca_saldo"),
                classificacao_saldo=F.col("classificacao_saldo"),
                data=when,
            ),
        )
        .when(settled, _event(tipo=F.lit("divida_quitada"), saldo_anterior=F.col("saldo_anterior"), saldo_atual=F.lit(0.0), data=when))
    )


@made_once
def _fields(executed: str, new_id: Callable[[Column], Column]) -> dict[str, Column]:
    """The record's fields after the run."""
    when = F.lit(executed)
    created, updated, settled = (F.col("_case") == x for x in ("criado", "atualizado", "quitado"))
    touched = updated | settled
    flag = {f: F.coalesce(F.col(f"alteracoes.{f}"), F.lit(False)) for f in FLAGS}
    moved = (updated & flag["saldoMudou"]) | settled
    b, n = (lambda f: F.col(f"b.{f}")), (lambda f: F.col(f"n.{f}"))
    new_status = F.when(b("status_cobranca").isin(*AUTOMATIC_STATUS), status_of(n("saldo_debito_nex"))).otherwise(b("status_cobranca"))
    history = lambda side: F.concat(F.coalesce(F.col(f"{side}.historico"), F.array().cast(SCHEMA["historico"].dataType)), F.array("_evento"))
    none = F.lit(None)
    on_create = {"prime_id": new_id(F.col("nex_codigo")), "criado_em": when, "atualizado_em": when, "tipo_ultima_operacao": F.lit("importacao_inicial"), "saldo_debito_anterior": none, "saldo_credito_anterior": none, "variacao_saldo": none, "historico": history("n")}
    on_touch = {
        "saldo_debito_anterior": b("saldo_debito_nex"),
        "saldo_credito_anterior": b("saldo_credito_nex"),
        "variacao_saldo": F.col("diferenca_saldo"),
        "atualizado_em": when,
        "tipo_ultima_operacao": F.lit("sincronizacao"),
        "historico": history("b"),
        "saldo_debito_nex": F.when(moved, n("saldo_debito_nex")).otherwise(b("saldo_debito_nex")),
        "saldo_credito_nex": F.when(moved, n("saldo_credito_nex")).otherwise(b("saldo_credito_nex")),
        "valor_liquido_nex": F.when(moved, round2(n("saldo_debito_nex") - n("saldo_credito_nex"))).otherwise(b("valor_liquido_nex")),
        "status_cobranca": F.when(settled, F.lit("pago")).when(moved, new_status).otherwise(b("status_cobranca")),
    } | {f: F.when(flag[by], n(f)).otherwise(b(f)) for f, by in COPIED.items()}

    def field(f: str) -> Column:
        kind = SCHEMA[f].dataType
        if f == "nex_codigo":
            return F.col("nex_codigo")
        return F.when(created, on_create.get(f, n(f)).cast(kind)).when(touched, on_touch.get(f, b(f)).cast(kind)).otherwise(b(f).cast(kind)).alias(f)

    return {f: field(f) for f in SCHEMA.names}


def applied(rows: DataFrame, context: Context) -> Applied:
    """The results of cases()."""
    fields = _fields(context.executed, context.new_id)
    stays = rows.where(F.col("_case").isNotNull() & ((F.col("_case") != "nao_aplicado") | F.col("b").isNotNull()))
    nova_base = stays.select("_ord", *fields.values())
    now = F.array("_evento").cast(SCHEMA["historico"].dataType).alias("historico")
    alterados = rows.where(F.col("_case").isin("criado", "atualizado", "quitado")).select("_ord", *(fields | {"historico": now}).values())
    eventos = rows.where(F.col("_evento").isNotNull()).select("_ord", "nex_codigo", "_evento.*")
    nao_aplicados = rows.where("_case = 'nao_aplicado'").select("_ord", "nex_codigo", F.lit(REMOVED).alias("motivo"))
    avisos = rows.withColumn("aviso", _notice()).where("aviso is not null").select("_ord", "nex_codigo", "aviso")
    return Applied(nova_base, alterados, eventos, nao_aplicados, avisos, rows.agg(*run_counters()))


def with_records(plan: DataFrame, base: DataFrame, new: DataFrame) -> DataFrame:
    """A plan that came without records (nex_codigo, tipo, ...), with the records b and n looked up in both sides."""
    from saldus.operators.lookup import dedup_last

    def side(df: DataFrame, name: str) -> DataFrame:
        one = dedup_last(df).drop("_ord", "_pos")
        return one.select(F.col("nex_codigo").alias(f"_{name}"), F.struct(*one.columns).alias(name))

    joined = plan.drop("b", "n").join(side(base, "b"), F.col("nex_codigo") == F.col("_b"), "left").drop("_b")
    return joined.join(side(new, "n"), F.col("nex_codigo") == F.col("_n"), "left").drop("_n")
