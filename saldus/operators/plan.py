"""The plan of a sync: what each code of the base and of the import calls for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldus.functions.barrier import settled
from saldus.functions.memo import made_once
from saldus.functions.text import compare_key, round2
from saldus.schema import ADDRESS

NEW, REMOVED = "cliente_novo", "cliente_removido_da_exportacao"
CHANGED, SAME = "cliente_existente_com_alteracao", "cliente_existente_sem_alteracao"
FLAGS = ("saldoMudou", "telefoneMudou", "celularMudou", "emailMudou", "enderecoMudou", "observacaoMudou")
_PARTS = ("saldo", "telefone", "celular", "email", "endereco", "observacao")
REMOVED_ACTION = "cliente nao consta na nova exportacao - nao remover automaticamente, sinalizar para revisao manual"


def net_balance(side: str) -> Column:
    value = lambda f: F.coalesce(F.nanvl(F.col(f"{side}.{f}"), F.lit(0.0)), F.lit(0.0))
    return round2(value("saldo_debito_nex") - value("saldo_credito_nex"))


def compared(base: DataFrame, new: DataFrame) -> DataFrame:
    """nex_codigo, the records b and n of either side (null where it has none), _ord, the place in the plan, and _base_rows and _new_rows, how many rows each side has of the code.

    Both sides go through one shuffle: rows are tagged, united and grouped by code, where the last of each side wins. Codes of the base come
    first, in the order of their first rows, then those of the import alone. Rows without a code are one group, which is only counted: it has no records.
    """
    fields = [c for c in base.columns if c in new.columns and c != "_ord"]
    known = F.col("nex_codigo").isNotNull()

    def side(df: DataFrame, of: int) -> DataFrame:
        return df.select("nex_codigo", F.lit(of).alias("of"), F.col("_ord").cast("long").alias("_ord"), F.when(known, F.struct(*fields)).alias("row"))

    both = side(base, 0).unionByName(side(new, 1))
    pick = lambda of, f, *c: f(*(F.when(F.col("of") == of, x) for x in c))
    grouped = both.groupBy("nex_codigo").agg(
        pick(0, F.max_by, F.col("row"), F.col("_ord")).alias("b"),
        pick(1, F.max_by, F.col("row"), F.col("_ord")).alias("n"),
        pick(0, F.min, F.col("_ord")).alias("_base_pos"),
        pick(1, F.min, F.col("_ord")).alias("_new_pos"),
        F.count_if(F.col("of") == 0).alias("_base_rows"),
        F.count_if(F.col("of") == 1).alias("_new_rows"),
    )
    place = F.struct(F.col("_base_pos").isNull().cast("int").alias("side"), F.coalesce("_base_pos", "_new_pos").alias("pos"))
    return grouped.select("nex_codigo", "b", "n", place.alias("_ord"), "_base_rows", "_new_rows")


def matched(base: DataFrame, new: DataFrame) -> DataFrame:
    """The codes of compared(), without its counts."""
    return compared(base, new).where(F.col("nex_codigo").isNotNull()).drop("_base_rows", "_new_rows")


def with_plan(pairs: DataFrame) -> DataFrame:
    """matched() rows with the plan's columns: tipo, acoes, saldo_anterior, saldo_atual, diferenca_saldo, classificacao_saldo, alteracoes."""
    for columns in _steps():
        pairs = pairs.withColumns(columns)
    return settled(pairs)


@made_once
def _steps() -> list[dict[str, Column]]:
    """The plan's columns, each step from those before it."""
    only_new, only_base = F.col("b").isNull(), F.col("n").isNull()
    balances = {"saldo_anterior": F.when(~only_new, net_balance("b")), "saldo_atual": F.when(~only_base, net_balance("n"))}
    difference = {"diferenca_saldo": round2(F.col("saldo_atual") - F.col("saldo_anterior"))}
    diff = F.col("diferenca_saldo")
    kind = (
        F.when(diff.isNull(), F.lit(None).cast("string"))
        .when((F.col("saldo_anterior") > 0) & (F.col("saldo_atual") == 0), F.lit("divida_quitada"))
        .when(diff > 0, F.lit("aumento_divida"))
        .when(diff < 0, F.lit("reducao_divida"))
        .otherwise(F.lit("sem_alteracao"))
    )
    differs = lambda f: compare_key(F.col(f"b.{f}")) != compare_key(F.col(f"n.{f}"))
    moved = F.lit(False)
    for f in ADDRESS:
        moved = moved | differs(f)
    changes = (F.col("classificacao_saldo") != "sem_alteracao", differs("telefone"), differs("celular"), differs("email"), moved, differs("observacao_original_nex"))
    moves = {"alteracoes": F.when(diff.isNotNull(), F.struct(*(x.alias(f) for x, f in zip(changes, FLAGS, strict=True))))}
    any_change = F.lit(False)
    for f in FLAGS:
        any_change = any_change | F.col(f"alteracoes.{f}")
    tipo = F.when(only_new, F.lit(NEW)).when(only_base, F.lit(REMOVED)).when(any_change, F.lit(CHANGED)).otherwise(F.lit(SAME))
    act = lambda f, part: F.when(F.col(f"alteracoes.{f}"), F.lit(f"atualizar {part}")).otherwise(F.lit(f"manter {part}"))
    steps = [act(f, p) for f, p in zip(FLAGS, _PARTS, strict=True)]
    steps[0] = F.when(F.col("classificacao_saldo") == "divida_quitada", F.lit("marcar como quitado")).otherwise(steps[0])
    actions = (
        F.when(F.col("tipo") == NEW, F.array(F.lit("criar novo cadastro")))
        .when(F.col("tipo") == REMOVED, F.array(F.lit(REMOVED_ACTION)))
        .when(F.col("tipo") == CHANGED, F.array(*steps))
        .otherwise(F.array(F.lit("nenhuma alteracao")))
    )
    return [balances, difference, {"classificacao_saldo": kind}, moves, {"tipo": tipo}, {"acoes": actions}]


def build_plan(base: DataFrame, new: DataFrame) -> DataFrame:
    """A row for each code of either side, with both records b and n for applying it."""
    return with_plan(matched(base, new))


@made_once
def plan_counters() -> list[Column]:
    """Eleven counters, as aggregates over with_plan(compared())."""
    known = F.col("nex_codigo").isNotNull()
    tipo = lambda t: F.count_if(known & (F.col("tipo") == t))
    kind = lambda k: F.count_if(known & (F.col("classificacao_saldo") == k))
    rows = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return [
        rows("_base_rows").alias("total_base"),
        rows("_new_rows").alias("total_nova_importacao"),
        F.count_if(known).alias("total_comparados"),
        tipo(NEW).alias("clientes_novos"),
        tipo(SAME).alias("clientes_sem_alteracao"),
        tipo(CHANGED).alias("clientes_com_alteracao"),
        tipo(REMOVED).alias("clientes_removidos_da_exportacao"),
        kind("divida_quitada").alias("dividas_quitadas"),
        kind("aumento_divida").alias("dividas_aumentaram"),
        kind("reducao_divida").alias("dividas_reduziram"),
        rows(F.when(~known, F.col("_base_rows") + F.col("_new_rows"))).alias("registros_sem_identificador_ignorados"),
    ]


def plan_summary(base: DataFrame, new: DataFrame) -> DataFrame:
    """Eleven counters, as one row: each side is read once, and rows are counted where they are grouped."""
    return with_plan(compared(base, new)).agg(*plan_counters())


def plan_text(plan: DataFrame) -> DataFrame:
    """_ord and texto: each plan row's lines."""
    lines = F.concat(F.array(F.concat(F.lit("Cliente "), F.col("nex_codigo")), F.lit("Ações:")), F.transform("acoes", lambda a: F.concat(F.lit("  ✔ "), a)), F.array(F.lit("-" * 34)))
    return plan.select("_ord", "nex_codigo", F.array_join(lines, "\n").alias("texto"))


def write_plan_text(plan: DataFrame, path: str) -> None:
    """The plan's text as files whose names are in its order: each holds the lines of a range of places. One after another they are format_plan()'s text."""
    plan_text(plan).repartitionByRange("_ord").sortWithinPartitions("_ord").select("texto").write.text(path)


def format_plan(plan: DataFrame) -> str:
    """The whole plan as text on the driver, for small plans that a person reads; write_plan_text() is for the others."""
    return "\n".join(r["texto"] for r in plan_text(plan).orderBy("_ord").toLocalIterator())
