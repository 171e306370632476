"""Raw export rows to customer records: one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldus.context import Context
from saldus.functions import parsers, text
from saldus.functions.barrier import settled
from saldus.functions.memo import made_once
from saldus.schema import FIELDS, SCHEMA

#: The export's headers, and the field that each fills as it is.
HEADERS = {
    "CPF / CNPJ": "cpf_cnpj",
    "Telefone": "telefone",
    "Celular": "celular",
    "Email": "email",
    "Endereço": "endereco_logradouro",
    "Número": "endereco_numero",
    "Complemento": "endereco_complemento",
    "Bairro": "endereco_bairro",
    "Cidade": "endereco_cidade",
    "Estado": "endereco_uf",
    "CEP": "endereco_cep",
}
CODE, NAME, BALANCE, NOTE = "Código", "Nome", "Débito / Crédito", "Observações"


def code_of(raw: DataFrame) -> Column:
    """A raw row's code: null where the cell is blank or there is no such column."""
    return _code(frozenset(raw.columns) & {CODE})


@made_once
def _code(columns: frozenset[str]) -> Column:
    code = F.col(f"`{CODE}`").cast("string") if CODE in columns else F.lit(None).cast("string")
    return F.when(~text.blank(code), code)


def normalize(raw: DataFrame, context: Context) -> DataFrame:
    """The 48 fields of every row, and _ord. A header that is missing reads as empty. raw must carry _ord, the row's place in its file."""

    # Cells that several rules read are parsed once, in a projection of their own.
    cells = raw.select("_ord", *_cells(frozenset(raw.columns)))
    cells = parsers.signals(cells, "cell", "note").withColumns({"balance": parsers.parsed_balance(), "category": parsers.parsed_category()})
    given = {"data_snapshot_nex": context.snapshot, "fonte_arquivo_origem": context.file}
    records = cells.select("_ord", *(F.lit(given[name]).cast("string").alias(name) if name in given else c for name, c in _fields().items()))
    return settled(records)


@made_once
def _cells(columns: frozenset[str]) -> list[Column]:
    """Cells of an export that has these columns, under short names."""
    cell = lambda header: F.col(f"`{header}`").cast("string") if header in columns else F.lit(None).cast("string")
    return [_code(columns).alias("code"), cell(NAME).alias("name"), cell(NOTE).alias("note"), cell(BALANCE).alias("cell"), *(text.filled(cell(h)).alias(f) for h, f in HEADERS.items())]


@made_once
def _fields() -> dict[str, Column]:
    """The record's fields from parsed cells, but for those that the run is told."""
    note = F.col("note")
    debit, credit = F.coalesce(F.col("balance.debito"), F.lit(0.0)), F.coalesce(F.col("balance.credito"), F.lit(0.0))
    category = F.col("category")
    values = {f: F.col(f) for f in HEADERS.values()} | {
        "nex_codigo": F.col("code"),
        "origem_sistema": F.lit("NEX"),
        "nome": text.trimmed(F.coalesce("name", F.lit(""))),
        "whatsapp_validado": F.lit(False),
        "saldo_debito_nex": debit,
        "saldo_credito_nex": credit,
        "valor_liquido_nex": debit - credit,
        "observacao_original_nex": F.when(text.blank(note), F.lit("")).otherwise(note),
        "observacao_categoria": category,
        "vencimento_sugerido": parsers.day_of(F.col("_days")),
        "parcelamento_sugerido": parsers.plan_of(F.col("_counts"), F.col("_values")),
        "confianca_extracao": parsers.confidence(category),
        "status_cobranca": status_of(debit),
        "historico": F.array(),
        "tentativas_cobranca": F.lit(0),
        "consentimento_contato": F.lit("nao_solicitado"),
    }
    return {name: values.get(name, F.lit(None)).cast(SCHEMA[name].dataType).alias(name) for name, *_ in FIELDS}


def status_of(debit: Column) -> Column:
    return F.when(debit > 0, F.lit("em_aberto")).otherwise(F.lit("sem_debito"))
