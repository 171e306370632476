"""Parsers of free-form balance and note cells, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from saldus.functions.barrier import settled
from saldus.functions.memo import made_once
from saldus.functions.text import SPACE, trimmed

_LABELLED = rf"[{SPACE}]*[:\-]?[{SPACE}]*r?\$?[{SPACE}]*([0-9.,]+)"
DEBIT = rf"(?iu)d[ée]bito{_LABELLED}"
CREDIT = rf"(?iu)cr[ée]dito{_LABELLED}"
BARE = rf"^[rR]?\$?[{SPACE}]*([0-9.,]+)$"
DAY = rf"(?i)(?<![A-Za-z0-9_])dia[{SPACE}]*([0-9]{{1,2}})(?![A-Za-z0-9_])"
INSTALMENTS = rf"(?i)(?<![A-Za-z0-9_])([0-9]{{1,2}})[{SPACE}]*x(?![A-Za-z0-9_])"
VALUE = r"([0-9]{1,3}(?:\.[0-9]{3})*,[0-9]{2}|[0-9]+,[0-9]{2}|[0-9]+\.[0-9]{2})"


def amount(c: Column) -> Column:
    """A Brazilian number: with a comma and points, points group; a comma alone is the decimal mark, and so is a point alone.

    What follows the number is ignored; null where none begins the text.
    """
    s = trimmed(c)
    decimal = F.when(F.contains(s, F.lit(",")), F.regexp_replace(F.replace(s, F.lit("."), F.lit("")), r"^([^,]*),", "$1.")).otherwise(s)
    return F.nullif(F.regexp_extract(decimal, r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", 0), F.lit("")).try_cast("double")


def balance_text(c: Column) -> Column:
    return trimmed(F.coalesce(c.cast("string"), F.lit("")))


def balance_amounts(raw: Column) -> tuple[Column, Column, Column]:
    """(after the debit label, after the credit label, of a bare number) in a trimmed cell; null where there is none."""
    return tuple(amount(F.regexp_extract(raw, p, 1)) for p in (DEBIT, CREDIT, BARE))


def balance_of(raw: Column, debit: Column, credit: Column, bare: Column) -> Column:
    """struct(tipo, raw, debito, credito) of a trimmed cell and its amounts."""
    known = debit.isNotNull() | credit.isNotNull()
    zero = F.coalesce(bare == 0, F.lit(False))
    tipo = F.when(raw == "", F.lit("vazio")).when(known, F.lit("reconhecido")).when(zero, F.lit("zero")).otherwise(F.lit("formato_nao_reconhecido"))
    value = lambda x: F.when(known, F.coalesce(x, F.lit(0.0))).when((raw != "") & zero, F.lit(0.0))
    return F.struct(tipo.alias("tipo"), raw.alias("raw"), value(debit).alias("debito"), value(credit).alias("credito"))


def balance(c: Column) -> Column:
    """A balance cell as struct(tipo, raw, debito, credito): labels decide, not signs; a cell may hold both labels."""
    raw = balance_text(c)
    return balance_of(raw, *balance_amounts(raw))


def _note(c: Column) -> Column:
    return trimmed(F.coalesce(c.cast("string"), F.lit("")))


def _all(note: Column, pattern: str) -> Column:
    """All matches in a trimmed note; every signal has a digit, so a note without one isn't searched."""
    return F.when(note.rlike("[0-9]"), F.regexp_extract_all(note, F.lit(pattern), 1)).otherwise(F.array().cast("array<string>"))


def _numbers(found: Column) -> Column:
    return F.transform(found, lambda x: x.cast("int"))


def note_days(c: Column) -> Column:
    return F.array_distinct(_numbers(_all(_note(c), DAY)))


def note_instalments(c: Column) -> Column:
    return _numbers(_all(_note(c), INSTALMENTS))


def note_values(c: Column) -> Column:
    return _all(_note(c), VALUE)


def category_of(note: Column, days: Column, counts: Column, values: Column) -> Column:
    """Days that conflict come before all else; then how many kinds of signal there are decides. note: trimmed."""
    kinds = sum(((F.size(x) > 0).cast("int") for x in (days, counts, values)), F.lit(0))
    return (
        F.when(note == "", F.lit("vazia"))
        .when(F.size(days) > 1, F.lit("ambigua"))
        .when(kinds >= 2, F.lit("estruturada"))
        .when(kinds == 1, F.lit("parcialmente_estruturada"))
        .otherwise(F.lit("texto_operacional"))
    )


def note_category(c: Column) -> Column:
    return category_of(_note(c), note_days(c), note_instalments(c), note_values(c))


def confidence(category: Column) -> Column:
    return F.when(category == "vazia", F.lit(None).cast("string")).when(category == "estruturada", F.lit("alta")).when(category == "parcialmente_estruturada", F.lit("media")).otherwise(F.lit("baixa"))


def day_of(days: Column) -> Column:
    return F.when(F.size(days) == 1, F.get(days, F.lit(0)))


def due_day(c: Column) -> Column:
    """The day, if there is just one; not held against any calendar."""
    return day_of(note_days(c))


def plan_of(counts: Column, values: Column) -> Column:
    return F.when(F.size(counts) > 0, F.struct(F.get(counts, F.lit(0)).alias("qtd"), amount(F.get(values, F.lit(0))).alias("valor")))


def instalment_plan(c: Column) -> Column:
    """struct(qtd, valor): the first count, with the first value wherever it stands; null without a count."""
    return plan_of(note_instalments(c), note_values(c))


def note_signals(df, note_cell: Column):
    """df with _note, _days, _counts, _values, each worked out once."""
    out = settled(df.withColumn("_note", _note(note_cell)))
    note = F.col("_note")
    return settled(out.withColumns({"_days": F.array_distinct(_numbers(_all(note, DAY))), "_counts": _numbers(_all(note, INSTALMENTS)), "_values": _all(note, VALUE)}))


@made_once
def _signals(balance: str, note: str) -> tuple[dict[str, Column], dict[str, Column]]:
    cell = F.col(note)
    first = {"_bal": balance_text(F.col(balance)), "_note": _note(cell), "_days": note_days(cell), "_counts": note_instalments(cell), "_values": note_values(cell)}
    return first, dict(zip(("_deb", "_cre", "_bare"), balance_amounts(F.col("_bal")), strict=True))


def signals(df, balance: str, note: str):
    """df with the parts that the rules share of the cells named, each worked out once: _bal, _deb, _cre, _bare, _note, _days, _counts, _values."""
    first, then = _signals(balance, note)
    return df.withColumns(first).withColumns(then)


@made_once
def parsed_balance() -> Column:
    return balance_of(*(F.col(c) for c in ("_bal", "_deb", "_cre", "_bare")))


@made_once
def parsed_category() -> Column:
    return category_of(*(F.col(c) for c in ("_note", "_days", "_counts", "_values")))
