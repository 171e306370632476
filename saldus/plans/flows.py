"""The two flows: analyse an export, and sync eligible records into a repository."""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from saldus.context import Context
from saldus.operators import explore
from saldus.operators.apply import Applied, applied, apply_plan, cases, run_counters
from saldus.operators.lookup import repeated_codes, with_details_of_code, with_first_of_code
from saldus.operators.normalize import CODE, HEADERS, code_of, normalize
from saldus.operators.plan import build_plan, compared, plan_counters, with_plan
from saldus.operators.simulate import counters, report, simulate
from saldus.operators.validate import needs_review, validate
from saldus.schema import SCHEMA
from saldus.sources.exports import check_size, file_name, read_upload
from saldus.sources.failures import ImportFailure
from saldus.sources.repository import Repository, StaleBase, check_contract


@dataclass
class Analysis:
    relatorio: DataFrame
    registros_com_aviso: DataFrame
    registros: DataFrame


def analyze(raw: DataFrame, context: Context = Context()) -> Analysis:
    """The report, the records with warnings and all records with their display fields, as lazy DataFrames over one plan; only whether there is a row, and whether a code stands in several, is looked up."""
    if raw.isEmpty():
        raise ImportFailure("planilha_vazia")
    if not {CODE, "Nome", *HEADERS} & set(raw.columns):
        raise ImportFailure("estrutura_incompativel")
    validated, repeated = validate(normalize(raw, context)), repeated_records(raw, context)
    return Analysis(simulate(validated, context), with_warnings(validated, repeated), display(validated, repeated))


def analyze_into(raw: DataFrame, context: Context, path: str) -> Analysis:
    """analyze() whose records are written to path as Parquet: the report is counted by the job that writes them, and warnings are read from there."""
    if raw.isEmpty():
        raise ImportFailure("planilha_vazia")
    validated, repeated = validate(normalize(raw, context)), repeated_records(raw, context)
    seen = Observation()
    # What a row says of itself is counted, not what it shares with the last row of its code; in the last stage, whose tasks count once each.
    own = validated.withColumn("_own", F.struct("validacao_status", "avisos"))
    display(own, repeated).observe(seen, *counters(F.col("_own.validacao_status"), F.col("_own.avisos"))).write.parquet(path)
    spark = raw.sparkSession
    kinds = {c: "decimal(38,2)" if c in ("total_debito", "total_credito") else "bigint" for c in seen.get}
    counted = spark.createDataFrame([tuple(seen.get.values())], ", ".join(f"{c} {k}" for c, k in kinds.items()))
    stored = spark.read.parquet(path)
    rows = stored.withColumns({"validacao_status": F.col("_own.validacao_status"), "avisos": F.col("_own.avisos")})
    warned = with_warnings(rows, None if repeated is None else rows.join(repeated_codes(rows.select("nex_codigo")), F.coalesce("nex_codigo", F.lit("null")) == F.col("_key"), "left_semi"))
    return Analysis(report(counted, context), warned, stored.drop("_own"))


def analyze_upload(spark: SparkSession, body: bytes, name: str | None, folder: str, snapshot: str | None = None) -> Analysis:
    """analyze() of an uploaded workbook. name: as the upload gives it, percent-encoded; without one, or where it can't be decoded, the file has its usual name. folder: where the upload is put, a URI that all executors read."""
    check_size(body)
    given = {k: v for k, v in (("file", file_name(name)), ("snapshot", snapshot)) if v}
    context = Context(**given)
    return analyze(read_upload(spark, body, context.file, folder), context)


def repeated_records(raw: DataFrame, context: Context) -> DataFrame | None:
    """Validated records of the rows whose code stands in several rows, or that have none; None if there are no such rows.

    The codes are counted on the raw rows, of which that reads one column; only rows of codes that count are then parsed a second time.
    """
    keyed = raw.withColumn("_key", F.coalesce(code_of(raw), F.lit("null")))
    codes = repeated_codes(keyed.select(F.col("_key").alias("nex_codigo")))
    if codes.isEmpty():
        return None
    return validate(normalize(keyed.join(codes, "_key", "left_semi").drop("_key"), context))


def display(validated: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """All records with tem_celular, tem_cpf, qtd_avisos and revisao_manual; rows that share a code share the last one's validation. repeated: validated records of codes that stand in several rows (validated itself will do), or None."""
    rows = with_details_of_code(validated, repeated)
    return contacts(rows).withColumns({"qtd_avisos": F.size("avisos"), "revisao_manual": needs_review(F.col("avisos"))})


def contacts(records: DataFrame) -> DataFrame:
    """records with tem_celular and tem_cpf, which no validation is needed for."""
    has = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    return records.withColumns({"tem_celular": has("celular"), "tem_cpf": has("cpf_cnpj")})


def filtered(raw: DataFrame, context: Context, name: str = "todos", term: str | None = None) -> DataFrame:
    """Records of an export by a canned filter and term; they are validated, with the last row of their code, only where the filter reads that."""
    records = normalize(raw, context)
    rows = display(validate(records), repeated_records(raw, context)) if name in explore.NEED_VALIDATION else contacts(records)
    return explore.filter_records(rows, name, term)


def with_warnings(validated: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """Records that are valid with warnings; their names and balances are those of the first row of their code. repeated: as in display()."""
    rows = validated.where("validacao_status = 'valido_com_aviso'")
    has = lambda c: F.coalesce(F.col(f"_first.{c}") != "", F.lit(False))
    joined = with_first_of_code(rows, repeated, ["nome", "saldo_debito_nex", "celular", "cpf_cnpj"])
    return joined.select("_ord", "nex_codigo", F.col("_first.nome").alias("nome"), F.col("_first.saldo_debito_nex").alias("saldo_debito"), has("celular").alias("tem_celular"), has("cpf_cnpj").alias("tem_cpf"), F.size("avisos").alias("qtd_avisos"), "avisos")


def eligible(records: DataFrame) -> DataFrame:
    """Records that aren't invalid when validated again; what they claim to be doesn't count. Columns beyond the 48 fields go."""
    claims = [c for c in records.columns if c in SCHEMA.names or c == "_ord"]
    return validate(records.select(*claims)).where("validacao_status <> 'invalido'").select(*claims)


@dataclass
class SyncResult:
    resumo_plano: dict
    resumo_execucao: dict
    aplicado: Applied


def sync(repository: Repository, records: DataFrame, context: Context, attempts: int = 5) -> SyncResult:
    """Diffs eligible records with the repository, applies the plan and saves. Syncs of a repository go one after another, in the order of their calls; a failed save raises and changes nothing.

    Where a writer that doesn't wait for its turn has saved since the base was read, the sync plans again, so many times at most.
    """
    check_contract(repository)
    with repository.lock:
        for left in reversed(range(attempts)):
            try:
                return _synced(repository, eligible(records), context)
            except StaleBase:
                if not left:
                    raise
        raise ValueError("a sync needs an attempt")


def _synced(repository: Repository, new: DataFrame, context: Context) -> SyncResult:
    read = repository.version()
    if not hasattr(repository, "save_changes"):  # a store that takes whole records alone
        base = repository.find_all()
        plan = with_plan(compared(base, new)).persist(StorageLevel.DISK_ONLY)  # read by both summaries and the save
        try:
            own = apply_plan(plan.where("nex_codigo is not null"), context)
            planned, done = plan.agg(*plan_counters()).first().asDict(), own.resumo.first().asDict()
            repository.save_batch(own.nova_base, read)
        finally:
            plan.unpersist()
        return SyncResult(planned, done, own)
    # One job reads the base, compares, applies and writes what has changed; the summaries are metrics of the rows as they pass its last stage, whose tasks count once
    # each, whatever is run again before them.
    seen = Observation()
    rows = with_plan(compared(repository.find_all(history=False, version=read), new)).observe(seen, *plan_counters())
    ran = Observation()
    rows = cases(rows.where("nex_codigo is not null"), context).observe(ran, *run_counters())
    repository.save_changes(applied(rows, context).alterados, read)
    full = apply_plan(build_plan(repository.find_all(version=read), new), context)
    return SyncResult(_counted(seen), _counted(ran), full)


def _counted(seen: Observation) -> dict:
    return {k: v or 0 for k, v in seen.get.items()}


@dataclass
class Imported:
    total_processado: int
    resumo_execucao: dict
    avisos: DataFrame
    registros_nao_aplicados: DataFrame
    quantidade_eventos_historico: int


def import_payload(repository: Repository, body: bytes, context: Context) -> Imported:
    """Syncs the records of a request's body, {"registros": [...]}. What is wrong with the body, and that a sync has failed, is raised as ImportFailure; why it has is logged only."""
    check_size(body)
    try:
        payload = json.loads(body.decode("utf-8", "replace"), parse_constant=_no_json)
    except ValueError as e:
        # The two messages.
        raise ImportFailure("payload_invalido", "Corpo da requisicao nao e um JSON valido.") from e
    if not isinstance(payload, dict) or not isinstance(payload.get("registros"), list):
        raise ImportFailure("payload_invalido", "Envie { registros: [...] } com o resultado de uma analise previa.")
    records = _records(repository.find_all().sparkSession, payload["registros"])
    try:
        done = sync(repository, records, context)
    except Exception as e:
        logging.getLogger(__name__).error("sync failed: %s", type(e).__name__)
        raise ImportFailure("erro_sincronizacao") from e
    run = done.resumo_execucao
    return Imported(done.resumo_plano["total_nova_importacao"], run, done.aplicado.avisos, done.aplicado.nao_aplicados, run["total_eventos"])


def _no_json(name: str) -> None:
    raise ValueError(name)


def _records(spark: SparkSession, rows: list) -> DataFrame:
    """Records of a body, whose size the upload's limit bounds; a field of another type than the record's is null, entries that are no objects are left out."""
    texts = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows) if isinstance(r, dict)], "_ord long, _text string")
    return texts.select("_ord", F.from_json("_text", SCHEMA).alias("_record")).select("_ord", "_record.*")


def can_confirm(report: dict) -> bool:
    """Whether there is anything to import."""
    return bool(report) and (report.get("validos") or 0) + (report.get("validos_com_aviso") or 0) > 0


