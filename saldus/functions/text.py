"""Text and number rules as column expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space beyond what `\s` covers, as the inside of a character class.
SPACE = r"\s\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
EPSILON = 2.220446049250313e-16

#: The same white space, and what `\s` covers, as single characters.
BLANKS = " \t\n\x0b\f\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


@lru_cache(maxsize=1)
def _bare_letters() -> tuple[str, str]:
    """Letters that canonical decomposition takes apart into one character and marks of U+0300-U+036F, and those characters."""
    pairs = []
    for code in range(0xC0, 0x2000):
        bare = [x for x in unicodedata.normalize("NFD", chr(code)) if not 0x300 <= ord(x) <= 0x36F]
        if len(bare) == 1 and ord(bare[0]) != code:
            pairs.append((chr(code), bare[0]))
    return "".join(x for x, _ in pairs), "".join(x for _, x in pairs)


def trimmed(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(c, F.lit(BLANKS))


def blank(c: Column) -> Column:
    return ~F.coalesce(c.cast("string"), F.lit("")).rlike(f"[^{SPACE}]")


def filled(c: Column) -> Column:
    """Trimmed, or null where nothing is left."""
    return F.nullif(trimmed(c), F.lit(""))


def compare_key(c: Column) -> Column:
    """What two texts must share to count as unchanged: null is empty, ends and case don't matter."""
    return F.lower(trimmed(F.coalesce(c.cast("string"), F.lit(""))))


def round2(c: Column) -> Column:
    """Two decimals, halves toward plus infinity; beyond 2**52 cents a double has no halves left."""
    moved = (c + F.lit(EPSILON)) * 100
    return F.when(F.abs(moved) < F.lit(2.0**52), F.floor(moved + 0.5).cast("double")).otherwise(moved) / 100


def cents(c: Column) -> Column:
    """For sums and results: null for what isn't a number or has more than 36 digits before the point."""
    return c.try_cast("decimal(38,2)")


def fixed2(c: Column) -> Column:
    """Two decimals as text, rounded from the exact binary value, halves away from zero; from 1e21 on with an exponent."""
    size = F.abs(c)
    # The whole part in two halves and the fraction times 2**62 are exact; so is the rest, in decimals.
    top = F.floor(size / F.lit(2.0**32))
    whole = top.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + (size - top.cast("double") * F.lit(2.0**32) - size % 1).cast("bigint").cast("decimal(10,0)")
    unit = F.lit(1 << 62).cast("decimal(20,0)")
    part = ((size % 1) * F.lit(2.0**62)).cast("bigint").cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)") + F.lit(1 << 61).cast("decimal(20,0)")
    rounded = ((part - part % unit) / unit).cast("decimal(3,0)")  # a whole number, so the division rounds nothing
    total = (whole.cast("decimal(34,0)") * F.lit(100).cast("decimal(3,0)")).cast("decimal(36,0)") + rounded
    plain = (total.cast("decimal(36,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(38,2)").cast("string")
    return F.when(F.isnan(c) | (size >= 1e21), _short(c)).otherwise(F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), plain))


def _short(c: Column) -> Column:
    """A large number with an exponent and as few digits as tell it from others, as 7e+22."""
    tried = [F.format_string(f"%.{n}e", c) for n in (14, 15)]
    return F.coalesce(*(F.when(x.try_cast("double") == c, F.regexp_replace(x, r"\.?0+e", "e")) for x in tried), F.regexp_replace(c.cast("string"), r"(\.0)?E", "e+"))


def money(c: Column) -> Column:
    return F.concat(F.lit("R$ "), fixed2(F.coalesce(c, F.lit(0.0))))


def number_text(c: Column) -> Column:
    """A number in its shortest form, whole ones without a point."""
    return F.when((c == F.floor(c)) & (F.abs(c) < 1e15), c.cast("long").cast("string")).otherwise(c.cast("string"))


def yes_no(c: Column, no: str = "Não") -> Column:
    return F.when(c, F.lit("Sim")).otherwise(F.lit(no))


def digits(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[^0-9]", "")


def mask_document(c: Column) -> Column:
    d = digits(c)
    return (
        F.when(F.length(d) == 11, F.concat(F.lit("***.***.***-"), F.right(d, F.lit(2))))
        .when(F.length(d) == 14, F.concat(F.lit("**.***.***/****-"), F.right(d, F.lit(2))))
        .when(F.length(d) > 0, F.lit("[DOCUMENTO OCULTO]"))
        .otherwise(F.lit(""))
    )


def mask_phone(c: Column) -> Column:
    d = digits(c)
    return F.when(d == "", F.lit("")).otherwise(F.concat(F.lit("(**) *****-"), F.right(d, F.lit(4))))


def mask_email(c: Column) -> Column:
    s = trimmed(F.coalesce(c.cast("string"), F.lit("")))
    form = f"^([^@{SPACE}]+)@([^{SPACE}]+)$"
    return (
        F.when(s.rlike(form), F.concat(F.substring(s, 1, 1), F.lit("***@"), F.regexp_extract(s, form, 2)))
        .when(s != "", F.lit("[EMAIL OCULTO]"))
        .otherwise(F.lit(""))
    )


def mask_address(c: Column) -> Column:
    return F.when(blank(c), F.lit("")).otherwise(F.lit("[ENDEREÇO OCULTO]"))


def shape(c: Column) -> Column:
    """A text with each digit hidden."""
    return F.regexp_replace(trimmed(F.coalesce(c.cast("string"), F.lit(""))), "[0-9]", "#")


def header_key(c: Column) -> Column:
    """A header without marks, case and white space at its ends."""
    bare = F.regexp_replace(F.translate(F.coalesce(c.cast("string"), F.lit("")), *_bare_letters()), r"[\u0300-\u036F]", "")
    return trimmed(F.lower(bare))


#: The tags of a column, each with the patterns of its header key of which one is enough. \b is a border of [A-Za-z0-9_].
TAGS = {
    "id_codigo": (r"^(id|cod|codigo|cod\.?cliente|codcli)$", r"\bcod(igo)?\b"),
    "nome": (r"\bnome\b", r"\brazao\b", r"\bfantasia\b"),
    "telefone": (r"\btelefone\b", r"\bfone\b", r"\bcelular\b", r"\bwhatsapp\b"),
    "cpf_cnpj": (r"\bcpf\b", r"\bcnpj\b", r"\bdocumento\b"),
    "email": (r"e-?mail",),
    "endereco": (r"\bendereco\b", r"\brua\b", r"\blogradouro\b", r"\bbairro\b", r"\bcidade\b", r"\bmunicipio\b", r"\buf\b", r"\bcep\b"),
    "cobranca_fiado": (r"\bfiado\b",),
    "cobranca_debito": (r"\bdebito\b",),
    "cobranca_saldo": (r"\bsaldo\b",),
    "cobranca_valor_aberto": (r"aberto",),
    "cobranca_vencimento": (r"vencimento",),
    "cobranca_parcela": (r"parcela",),
    "cobranca_credito": (r"\bcredito\b",),
    "cobranca_limite": (r"\blimite\b",),
    "cobranca_venda": (r"\bvenda\b",),
    "saldo_dc": (r"(?s)debito.*credito|credito.*debito",),
    "observacoes": (r"observac",),
}
#: \b spelt out, as Java's counts letters beyond ASCII as word characters.
BORDER = r"(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"


def tags(header: Column) -> Column:
    """The tags of a header, in order."""
    key = header_key(header)
    hits = [F.when(key.rlike("|".join(f"(?:{p})" for p in ps).replace(r"\b", BORDER)), F.lit(tag)) for tag, ps in TAGS.items()]
    return F.array_compact(F.array(*hits))
