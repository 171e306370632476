"""The queries of the ledger engine: a key for each operator, over exports rendered from the customer table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldus.context import Context, plain_id
from saldus.functions import parsers, text
from saldus.operators import explore, lookup, profile
from saldus.operators import plan as planning
from saldus.operators import validate as rules
from saldus.operators.apply import apply_plan, with_records
from saldus.operators.normalize import normalize
from saldus.operators.simulate import FORECAST, TOTALS, report_lines, simulate
from saldus.operators.validate import validate
from saldus.plans import flows
from saldus.sources import customer_export as rendered
from saldus.sources.repository import upserted

CONTEXT = Context(file="clientes.xls", snapshot="2024-01-31", executed="2024-02-01T12:00:00.000Z", new_id=plain_id)
LATER = Context(file="clientes2.xls", snapshot="2024-02-29", executed="2024-03-01T12:00:00.000Z", new_id=plain_id)
REFERENCE_TOTAL = 25414.58

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def _customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered.raw_export(_customer(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(_raw(spark, sf_dir), CONTEXT)


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(_records(spark, sf_dir))


def _display(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return flows.display(validate(normalize(raw, CONTEXT)), flows.repeated_records(raw, CONTEXT))


def _pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Eligible records of the earlier and the later export."""
    earlier, later = rendered.snapshots(_customer(spark, sf_dir))
    return flows.eligible(normalize(earlier, CONTEXT)), flows.eligible(normalize(later, LATER))


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.build_plan(*_pair(spark, sf_dir))


def _applied(spark: SparkSession, sf_dir: str):
    return apply_plan(_plan(spark, sf_dir), LATER)


def _money(*names: str) -> list:
    return [text.cents(F.col(n)).alias(n) for n in names]


# Sources and parsers


@_query
def raw_export_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    names = ("codigo", "nome", "cpf_cnpj", "telefone", "celular", "debito_credito", "observacoes")
    return raw.select(F.col("_ord").alias("ord"), *(F.col(f"`{h}`").alias(n) for h, n in zip(rendered.SHEET_HEADERS, names, strict=True)), F.lit(CONTEXT.file).alias("fonte_arquivo_origem"), F.lit(CONTEXT.snapshot).alias("data_snapshot_nex"))


@_query
def parse_valor_br(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The balance cell without its words, and the amount that it begins with."""
    raw = _raw(spark, sf_dir).select(F.col("_ord").alias("ord"), F.regexp_extract("Débito / Crédito", "([0-9][0-9.,]*)", 1).alias("texto"))
    return raw.select("ord", "texto", text.cents(parsers.amount(F.col("texto"))).alias("valor"))


@_query
def parse_financeiro(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir).select(F.col("_ord").alias("ord"), parsers.balance(F.col("Débito / Crédito")).alias("x"))
    return raw.select("ord", "x.tipo", "x.raw", text.cents(F.col("x.debito")).alias("debito"), text.cents(F.col("x.credito")).alias("credito"))


@_query
def obs_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.col("Observações")
    say = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), ",")
    return _raw(spark, sf_dir).select(F.col("_ord").alias("ord"), say(parsers.note_days(note)).alias("dias"), say(parsers.note_instalments(note)).alias("parcelas"), F.array_join(parsers.note_values(note), ";").alias("valores"))


@_query
def obs_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.col("Observações")
    category = parsers.note_category(note)
    return _raw(spark, sf_dir).groupBy(category.alias("categoria"), parsers.confidence(category).alias("confianca")).agg(F.count(F.lit(1)).alias("n"))


@_query
def document_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The note parser over a corpus of real text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    read = parsers.note_signals(docs.select("doc_id", "text"), F.col("text"))
    return read.select("doc_id", F.size("_values").cast("bigint").alias("n_valores"), F.size("_days").cast("bigint").alias("n_dias"), parsers.parsed_category().alias("categoria"))


@_query
def installment_suggestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("parcelamento_sugerido")
    return _records(spark, sf_dir).select(F.col("_ord").alias("ord"), "vencimento_sugerido", p["qtd"].alias("qtd"), text.cents(p["valor"]).alias("valor"))


@_query
def round2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer(spark, sf_dir).select(F.col("c_custkey").alias("ord"), text.cents(text.round2(F.col("c_acctbal") / 8)).alias("oitavo"))


@_query
def mask_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    doc = F.when(k % 4 == 0, F.lpad(k.cast("string"), 11, "0")).when(k % 4 == 1, F.lpad(k.cast("string"), 14, "0")).when(k % 4 == 2, F.concat(F.lit("doc "), k.cast("string"))).otherwise(F.lit(""))
    mail = F.when(k % 3 == 0, F.concat(F.lit(" c"), k.cast("string"), F.lit("@ex.com"))).when(k % 3 == 1, F.lit("sem email")).otherwise(F.lit(""))
    phone = F.when(k % 2 == 0, F.concat(F.lit("(47) 3322-"), F.lpad((k % 10000).cast("string"), 4, "0"))).otherwise(F.lit(" - "))
    street = F.when(k % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit("Rua "), k.cast("string")))
    return _customer(spark, sf_dir).select(k.alias("ord"), text.digits(phone).alias("digitos"), text.mask_document(doc).alias("documento"), text.mask_email(mail).alias("email"), text.mask_phone(phone).alias("telefone"), text.mask_address(street).alias("endereco"), text.shape(phone).alias("formato"))


@_query
def header_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered.headers(_customer(spark, sf_dir)).select("sheet", "pos", text.header_key(F.col("header")).alias("chave"))


@_query
def column_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_tags(rendered.headers(_customer(spark, sf_dir)))


# Records


@_query
def normalize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _records(spark, sf_dir)
    return r.select(
        F.col("_ord").alias("ord"), "nex_codigo", "origem_sistema", "nome", "cpf_cnpj", "telefone", "celular", "email", "endereco_cidade", *_money("saldo_debito_nex", "saldo_credito_nex", "valor_liquido_nex"),
        "data_snapshot_nex", "observacao_original_nex", "observacao_categoria", "vencimento_sugerido", F.col("parcelamento_sugerido.qtd").alias("parcelas"), text.cents(F.col("parcelamento_sugerido.valor")).alias("valor_parcela"),
        "confianca_extracao", "status_cobranca", F.size("historico").cast("bigint").alias("n_historico"), "tentativas_cobranca", "consentimento_contato", "whatsapp_validado", "fonte_arquivo_origem", "prime_id", "hash_registro_nex",
    )


def _tampered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with fields spoilt by place, so that every rule fires on some."""
    r, k = _records(spark, sf_dir), F.col("_ord") % 13
    c = F.col
    spoilt = {
        "nome": F.when(k == 1, F.lit("")).otherwise(c("nome")),
        "saldo_debito_nex": F.when(k == 2, F.lit(-50.0)).otherwise(c("saldo_debito_nex")),
        "valor_liquido_nex": F.when(k == 3, c("valor_liquido_nex") + 1).when(k == 4, c("valor_liquido_nex") + 0.005).otherwise(c("valor_liquido_nex")),
        "status_cobranca": F.when(k == 5, F.lit("quitado_para_sempre")).when((k == 7) & (c("saldo_debito_nex") > 0), F.lit("sem_debito")).when((k == 8) & (c("saldo_debito_nex") == 0), F.lit("em_aberto")).otherwise(c("status_cobranca")),
        "consentimento_contato": F.when(k == 6, F.lit("talvez")).otherwise(c("consentimento_contato")),
        "historico": F.when(k != 9, c("historico")),
        "tentativas_cobranca": F.when(k != 10, c("tentativas_cobranca")),
        "confianca_extracao": F.when((k == 11) & c("vencimento_sugerido").isNotNull(), F.lit("baixa")).otherwise(c("confianca_extracao")),
        "data_snapshot_nex": F.when(k != 12, c("data_snapshot_nex")),
    }
    more = F.col("_ord") % 17
    spoilt |= {
        "origem_sistema": F.when(more != 1, c("origem_sistema")),
        "fonte_arquivo_origem": F.when(more == 2, F.lit("  ")).otherwise(c("fonte_arquivo_origem")),
        "consentimento_contato": F.when(more != 3, spoilt["consentimento_contato"]),
        "status_cobranca": F.when(more != 4, spoilt["status_cobranca"]),
        "saldo_debito_nex": F.when(more != 5, spoilt["saldo_debito_nex"]),
        "saldo_credito_nex": F.when(more == 6, F.lit(None).cast("double")).when(more == 8, F.lit(-1.0)).otherwise(c("saldo_credito_nex")),
        "valor_liquido_nex": F.when(more != 7, spoilt["valor_liquido_nex"]),
    }
    return r.withColumns(spoilt)


def _messages(df: DataFrame) -> DataFrame:
    return df.select(F.col("_ord").alias("ord"), "validacao_status", F.array_join("erros", " | ").alias("erros"), F.array_join("avisos", " | ").alias("avisos"))


@_query
def validation_tampered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(validate(_tampered(spark, sf_dir)))


@_query
def validation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(_validated(spark, sf_dir)).select("ord", "validacao_status")


@_query
def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select(F.explode("erros").alias("erro")).groupBy("erro").agg(F.count(F.lit(1)).alias("n"))


@_query
def validation_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select(F.explode("avisos").alias("aviso")).groupBy("aviso").agg(F.count(F.lit(1)).alias("n"))


@_query
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.validation_summary(_validated(spark, sf_dir))


@_query
def manual_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).where(rules.needs_review(F.col("avisos"))).select(F.col("_ord").alias("ord"), "nex_codigo")


@_query
def analyzed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _display(spark, sf_dir).select(F.col("_ord").alias("ord"), "nex_codigo", "validacao_status", F.array_join("erros", " | ").alias("erros"), F.array_join("avisos", " | ").alias("avisos"), "tem_celular", "tem_cpf", "qtd_avisos", "revisao_manual")


@_query
def warning_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return explore.warning_rows(flows.with_warnings(validate(normalize(raw, CONTEXT)), flows.repeated_records(raw, CONTEXT))).withColumnRenamed("_ord", "ord")


@_query
def simulation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simulate(_validated(spark, sf_dir), CONTEXT).select(*TOTALS)


@_query
def simulation_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simulate(_validated(spark, sf_dir), CONTEXT).select(*FORECAST)


@_query
def report_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_lines(simulate(_validated(spark, sf_dir), CONTEXT))


@_query
def summary_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = simulate(_validated(spark, sf_dir), CONTEXT)
    kinds = {"previa": explore.PREVIEW_CARDS, "previsao": explore.FORECAST_CARDS, "topo": explore.TOP_CARDS}
    # One report row gives all three sets.
    pairs = tuple((f"{kind}: {label}", f) for kind, cards in kinds.items() for label, f in cards)
    return explore.cards(report, pairs)


@_query
def result_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cards of an import's result: what was applied, with the analysis' review count and the number of notices."""
    done = _applied(spark, sf_dir).resumo
    review = simulate(_validated(spark, sf_dir), CONTEXT).select("revisao_manual")
    return explore.cards(done.withColumn("total_avisos", F.col("nao_aplicados")).crossJoin(F.broadcast(review)), explore.RESULT_CARDS)


@_query
def hostile_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as text where cents are halves, huge or below a cent: cells made from the customer's key."""
    k = F.col("c_custkey")
    halves = F.concat(F.lit("Débito "), (k % 1000).cast("string"), F.lit("."), F.lpad((k % 997).cast("string"), 3, "0"))
    huge = F.concat(F.lit("Débito- R$ "), F.repeat(F.lit("9"), (k % 12 + 2).cast("int")), F.lit("0000000,00"))
    beyond = F.concat(F.lit("Débito "), (k % 9 + 1).cast("string"), F.repeat(F.lit("0"), (k % 5 + 22).cast("int")))
    cell = F.when(k % 4 == 0, huge).when(k % 4 == 1, beyond).otherwise(halves)
    read = _customer(spark, sf_dir).select(k.alias("ord"), parsers.balance(cell)["debito"].alias("x"))
    return read.select("ord", text.money(F.col("x")).alias("texto"), (F.col("x") < 1e15).alias("exato"))


# Exploring


def _filter(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flows.filtered(_raw(spark, sf_dir), CONTEXT, name).select(F.col("_ord").alias("ord"), "nex_codigo")

    run.__name__ = f"filter_{name}"
    return run


for _name in ("com_debito", "sem_debito", "com_aviso", "invalidos", "revisao_manual", "com_celular", "sem_celular"):
    _query(_filter(_name))


@_query
def search_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.filtered(_raw(spark, sf_dir), CONTEXT, "com_debito", " 00012 ").select(F.col("_ord").alias("ord"), "nex_codigo", "nome")


@_query
def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.review_rows(_display(spark, sf_dir)).withColumnRenamed("_ord", "ord")


@_query
def status_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tampered(spark, sf_dir).groupBy(explore.status_label(F.col("status_cobranca")).alias("rotulo")).agg(F.count(F.lit(1)).alias("n"))


@_query
def explanation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select(F.col("_ord").alias("ord"), explore.explanation().alias("explicacao"))


@_query
def record_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = explore.details(_display(spark, sf_dir))
    say = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["rotulo"], F.lit("="), F.coalesce(x["valor"], F.lit("")))), "; ")
    return d.select(F.col("_ord").alias("ord"), say("dados_nex").alias("dados_nex"), say("dados_normalizados").alias("dados_normalizados"), say("sugestoes").alias("sugestoes"), "classificacao_financeira")


# Plan and application


@_query
def eligible_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.eligible(_tampered(spark, sf_dir)).select(F.col("_ord").alias("ord"), "nex_codigo")


@_query
def dedup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.dedup_last(_pair(spark, sf_dir)[1]).select("nex_codigo", F.col("_ord").alias("ord"), F.col("_pos").alias("pos"), "celular")


@_query
def all_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.all_codes(*_pair(spark, sf_dir))


@_query
def plan_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = [F.col(f"alteracoes.{f}").alias(f.replace("Mudou", "_mudou")) for f in planning.FLAGS]
    return _plan(spark, sf_dir).select("nex_codigo", "tipo", F.array_join("acoes", "; ").alias("acoes"), *_money("saldo_anterior", "saldo_atual", "diferenca_saldo"), "classificacao_saldo", *flags)


@_query
def plan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.plan_text(_plan(spark, sf_dir)).select("nex_codigo", "texto")


@_query
def plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.plan_summary(*_pair(spark, sf_dir))


def _codes_of(*tipos: str) -> Query:
    return lambda spark, sf_dir: _plan(spark, sf_dir).where(F.col("tipo").isin(*tipos)).select("nex_codigo")


_QUERIES["clients_new"] = _codes_of(planning.NEW)
_QUERIES["clients_removed"] = _codes_of(planning.REMOVED)
_QUERIES["clients_common"] = _codes_of(planning.CHANGED, planning.SAME)


@_query
def apply_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _applied(spark, sf_dir).nova_base
    return r.select(
        "nex_codigo", "prime_id", "nome", "telefone", "celular", "email", "endereco_cidade", "observacao_original_nex", "observacao_categoria", "vencimento_sugerido", "confianca_extracao", "status_cobranca", "data_snapshot_nex",
        "fonte_arquivo_origem", "criado_em", "atualizado_em", "tipo_ultima_operacao", F.size("historico").cast("bigint").alias("n_historico"),
        *_money("saldo_debito_nex", "saldo_credito_nex", "valor_liquido_nex", "saldo_debito_anterior", "saldo_credito_anterior", "variacao_saldo"),
    )


@_query
def apply_bare_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applying a plan that came as codes and types alone: its records are looked up in both sides."""
    base, new = _pair(spark, sf_dir)
    bare = planning.build_plan(base, new).drop("b", "n")
    rows = apply_plan(with_records(bare, base, new), LATER).nova_base
    return rows.select("nex_codigo", "prime_id", "telefone", "email", "status_cobranca", "atualizado_em", F.size("historico").cast("bigint").alias("n_historico"), *_money("saldo_debito_nex", "saldo_debito_anterior", "variacao_saldo"))


@_query
def apply_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir).resumo


@_query
def apply_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _applied(spark, sf_dir).eventos
    return e.select("nex_codigo", "tipo", "origem", "data", F.array_join("campos_alterados", ",").alias("campos_alterados"), "classificacao_saldo", *_money("saldo_inicial", "saldo_anterior", "saldo_novo", "saldo_atual", "diferenca"))


@_query
def not_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _applied(spark, sf_dir)
    return a.nao_aplicados.join(a.avisos.select("nex_codigo", "aviso"), "nex_codigo").select("nex_codigo", "motivo", "aviso")


@_query
def repo_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, new = _pair(spark, sf_dir)
    return upserted(base, new).select("nex_codigo", "celular", "email", "fonte_arquivo_origem")


@_query
def repo_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, new = _pair(spark, sf_dir)
    return upserted(base, new).where(F.col("nex_codigo") == str(53 * 2)).select("nex_codigo", "nome").union(upserted(base, new).where(F.col("nex_codigo") == str(42)).select("nex_codigo", "nome"))


# Profile


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered.sheet(_customer(spark, sf_dir))


def _useful(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, profile.Columns]:
    m = _sheet(spark, sf_dir)
    columns = profile.find_columns(m.where(F.col("row_idx") < profile.SCAN_ROWS), "Clientes")
    return profile.useful_rows(m, "Clientes", columns), columns


@_query
def profile_header_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.header_rows(_sheet(spark, sf_dir))


@_query
def profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_accounting(_sheet(spark, sf_dir))


def _profile(name: str, run: Callable[[DataFrame, profile.Columns], DataFrame]) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(*_useful(spark, sf_dir))

    _QUERIES[name] = query


_profile("profile_missing", profile.missing)
_profile("profile_duplicates", profile.duplicates)
_profile("profile_duplicates_by_name", lambda rows, _: profile.duplicates(rows, profile.Columns(nome=1)))
_profile("profile_financial", lambda rows, _: profile.financial(rows))
_profile("profile_unrecognized_shapes", lambda rows, _: profile.unrecognized_shapes(rows))
_profile("profile_notes", lambda rows, _: profile.notes(rows))
_profile("profile_examples", lambda rows, _: profile.examples(rows))
_profile("profile_contactability", lambda rows, _: profile.contactability(rows))
_profile("profile_reconcile", lambda rows, _: profile.reconcile(rows, REFERENCE_TOTAL))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from saldus.plans.oracle import oracle_sql as sql

    return sql()
