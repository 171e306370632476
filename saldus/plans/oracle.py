"""The queries of the catalogue once more, in DuckDB's SQL, written from the rules and not from the DataFrame code."""

from __future__ import annotations



def _balance(cents: str) -> str:
    plain = f"(({cents}) // 100)::varchar || ',' || lpad((({cents}) % 100)::varchar, 2, '0')"
    grouped = f"case when ({cents}) // 100 >= 1000 then (({cents}) // 100000)::varchar || '.' || lpad(((({cents}) // 100) % 1000)::varchar, 3, '0') else (({cents}) // 100)::varchar end || ',' || lpad((({cents}) % 100)::varchar, 2, '0')"
    return (
        f"case k % 8 when 1 then 'Débito- R$ ' || {plain} when 2 then 'DÉBITO: R$ ' || ({grouped}) when 3 then 'Crédito- R$ ' || {plain}"
        f" when 4 then 'Débito- R$ ' || ({grouped}) || ' Crédito- R$ 20,00' when 5 then 'R$ 0,00' when 6 then 'texto aleatorio sem valor'"
        f" when 7 then '  credito ' || replace({plain}, ',', '.') else '' end"
    )


NOTE = "case k % 7 when 1 then '2x 75,00 todo dia 20' when 2 then 'dia 15' when 3 then 'avisar antes de entregar' when 4 then 'dia 5 ou DIA 20' when 5 then '3x dia 05' when 6 then '1.234,56 em 4 x' else '' end"
CUSTOMER = "select c_custkey as k, c_name, c_nationkey, c_acctbal, cast(round(abs(c_acctbal) * 100) as bigint) as cents from customer"


def _cells(cents: str = "cents", tel: str = "", mail: str = "''", city: str = "''", note: str = NOTE, name: str = "c_name") -> str:
    return (
        "k as ord, case when k % 101 = 7 then '' else k::varchar end as codigo, case when k % 53 = 0 then '  ' else " + name + " end as nome,"
        " case when k % 4 = 0 then lpad(k::varchar, 11, '0') else '' end as cpf_cnpj,"
        f" case {tel} when k % 5 = 0 then '473322' || lpad((k % 10000)::varchar, 4, '0') else '' end as telefone,"
        " case when k % 3 = 0 then '' else '1199' || lpad((k % 10000000)::varchar, 7, '0') end as celular,"
        f" {_balance(cents)} as debito_credito, {note} as observacoes, {mail} as email, {city} as cidade"
    )


def _amount(s: str) -> str:
    plain = f"case when contains({s}, ',') and contains({s}, '.') then replace({s}, '.', '') else {s} end"
    return f"try_cast(nullif(regexp_extract(regexp_replace({plain}, ',', '.'), '^(\\d+\\.?\\d*|\\.\\d+)', 1), '') as double)"


DEBIT = _amount("regexp_extract(t, '(?i)d[ée]bito\\s*[:\\-]?\\s*r?\\$?\\s*([\\d.,]+)', 1)")
CREDIT = _amount("regexp_extract(t, '(?i)cr[ée]dito\\s*[:\\-]?\\s*r?\\$?\\s*([\\d.,]+)', 1)")
BARE = _amount("regexp_extract(t, '^[rR]?\\$?\\s*([\\d.,]+)$', 1)")
DAYS = "list_transform(regexp_extract_all(o, '(?i)\\bdia\\s*(\\d{1,2})\\b', 1), lambda x: x::int)"
COUNTS = "list_transform(regexp_extract_all(o, '(?i)\\b(\\d{1,2})\\s*x\\b', 1), lambda x: x::int)"
VALUES = "regexp_extract_all(o, '\\d{1,3}(?:\\.\\d{3})*,\\d{2}|\\d+,\\d{2}|\\d+\\.\\d{2}')"


def _parsed(raw: str, name: str, snapshot: str = "2024-01-31", file: str = "clientes.xls") -> str:
    """CTEs that end in `name`: raw rows, parsed and laid out as records."""
    return f"""
{name}_a as (select *, trim(debito_credito) as t, trim(observacoes) as o from {raw}),
{name}_b as (select *, {DEBIT} as d0, {CREDIT} as c0, {BARE} as b0, {DAYS} as dias_todos, {COUNTS} as parcelas, {VALUES} as valores from {name}_a),
{name}_c as (select *, list_filter(dias_todos, lambda x, i: list_position(dias_todos, x) = i) as dias,
  case when t = '' then 'vazio' when d0 is not null or c0 is not null then 'reconhecido' when b0 = 0 then 'zero' else 'formato_nao_reconhecido' end as tipo from {name}_b),
{name}_d as (select *, case tipo when 'reconhecido' then coalesce(d0, 0) when 'zero' then 0 end as fd, case tipo when 'reconhecido' then coalesce(c0, 0) when 'zero' then 0 end as fc,
  case when o = '' then 'vazia' when len(dias) > 1 then 'ambigua' when (len(dias) > 0)::int + (len(parcelas) > 0)::int + (len(valores) > 0)::int >= 2 then 'estruturada'
    when len(dias) + len(parcelas) + len(valores) > 0 then 'parcialmente_estruturada' else 'texto_operacional' end as categoria from {name}_c),
{name} as (select ord, nullif(codigo, '') as nex_codigo, trim(nome) as nome, nullif(trim(cpf_cnpj), '') as cpf_cnpj, nullif(trim(telefone), '') as telefone, nullif(trim(celular), '') as celular,
  nullif(trim(email), '') as email, nullif(trim(cidade), '') as endereco_cidade, coalesce(fd, 0) as deb, coalesce(fc, 0) as cre, coalesce(fd, 0) - coalesce(fc, 0) as net, '{snapshot}' as snap, '{file}' as arquivo, 'NEX' as origem,
  case when o = '' then '' else observacoes end as obs, categoria, case when len(dias) = 1 then dias[1] end as venc, parcelas[1] as qtd, case when len(parcelas) > 0 then {_amount("valores[1]")} end as vparc,
  case categoria when 'vazia' then null when 'estruturada' then 'alta' when 'parcialmente_estruturada' then 'media' else 'baixa' end as conf,
  case when coalesce(fd, 0) > 0 then 'em_aberto' else 'sem_debito' end as status, 'nao_solicitado' as consent, 0 as tent, true as tem_hist, tipo, t, fd, fc, dias, parcelas, valores, o from {name}_d)"""


ERRORS = (
    ("nome is null or trim(nome) = ''", "'campo obrigatorio \"nome\" ausente ou vazio'"),
    ("nex_codigo is null or trim(nex_codigo) = ''", "'campo obrigatorio \"nex_codigo\" ausente'"),
    ("origem is null", "'campo obrigatorio \"origem_sistema\" ausente'"),
    ("snap is null", "'campo obrigatorio \"data_snapshot_nex\" ausente'"),
    ("trim(arquivo) = ''", "'campo obrigatorio \"fonte_arquivo_origem\" ausente'"),
    ("consent is null", "'campo obrigatorio \"consentimento_contato\" ausente'"),
    ("status is null", "'campo obrigatorio \"status_cobranca\" ausente'"),
    ("not tem_hist", "'campo obrigatorio \"historico\" nao e um array'"),
    ("tent is null", "'campo obrigatorio \"tentativas_cobranca\" nao e numero'"),
    ("deb is null", "'\"saldo_debito_nex\" nao e numero'"),
    ("cre is null", "'\"saldo_credito_nex\" nao e numero'"),
    ("net is null", "'\"valor_liquido_nex\" nao e numero'"),
    ("deb < 0", "'\"saldo_debito_nex\" negativo'"),
    ("cre < 0", "'\"saldo_credito_nex\" negativo'"),
    (
        "abs(deb - cre - net) > 0.01",
        "'\"valor_liquido_nex\" (' || case when net = floor(net) then net::bigint::varchar else net::varchar end || ') nao bate com debito-credito (' || (deb - cre)::decimal(38,2)::varchar || ')'",
    ),
    (
        "status not in ('sem_debito', 'em_aberto', 'em_negociacao', 'cobranca_enviada', 'promessa_pagamento', 'pago', 'inadimplente_recorrente')",
        "'\"status_cobranca\" fora do enum permitido: \"' || status || '\"'",
    ),
    ("consent not in ('concedido', 'negado', 'nao_solicitado')", "'\"consentimento_contato\" fora do enum permitido: \"' || consent || '\"'"),
    ("deb > 0 and status = 'sem_debito'", "'status_cobranca = \"sem_debito\" mas saldo_debito_nex > 0'"),
    ("deb = 0 and status = 'em_aberto'", "'status_cobranca = \"em_aberto\" mas saldo_debito_nex = 0'"),
)
WARNINGS = (
    ("deb > 0 and celular is null and telefone is null", "'cliente com debito em aberto mas sem celular nem telefone cadastrado'"),
    ("deb > 0 and cpf_cnpj is null", "'cliente com debito em aberto mas sem CPF/CNPJ cadastrado'"),
    ("categoria = 'ambigua' and deb > 0", "'observacao ambigua (dias conflitantes) em cliente com debito - revisar antes de qualquer cobranca automatica'"),
    ("venc is not null and conf = 'baixa'", "'vencimento_sugerido existe mas com confianca_extracao baixa - nao usar sem confirmacao humana'"),
    ("qtd is not null and vparc is null", "'parcelamento_sugerido incompleto (sem valor de parcela reconhecido)'"),
)


def _checked(records: str, name: str) -> str:
    lists = {k: "list_filter([" + ", ".join(f"case when {rule} then {msg} end" for rule, msg in rules) + "], lambda x: x is not null)" for k, rules in (("erros", ERRORS), ("avisos", WARNINGS))}
    return f"""
{name}_a as (select *, {lists["erros"]} as erros, {lists["avisos"]} as avisos from {records}),
{name} as (select *, case when len(erros) > 0 then 'invalido' when len(avisos) > 0 then 'valido_com_aviso' else 'valido' end as vstatus,
  len(list_filter(avisos, lambda a: regexp_matches(a, 'ambigua|confianca_extracao baixa|incompleto|sem celular nem telefone'))) > 0 as revisao from {name}_a)"""


RAW = f"with cust as ({CUSTOMER}), raw as (select {_cells()} from cust)"
NORM = RAW + "," + _parsed("raw", "rec")
VAL = NORM + "," + _checked("rec", "val")
SPOILT = (
    NORM
    + """,
spoilt as (select * replace (
  case when ord % 13 = 1 then '' else nome end as nome,
  case when ord % 17 = 5 then null when ord % 13 = 2 then -50 else deb end as deb,
  case when ord % 17 = 6 then null when ord % 17 = 8 then -1 else cre end as cre,
  case when ord % 17 = 7 then null when ord % 13 = 3 then net + 1 when ord % 13 = 4 then net + 0.005 else net end as net,
  case when ord % 17 = 4 then null when ord % 13 = 5 then 'quitado_para_sempre' when ord % 13 = 7 and deb > 0 then 'sem_debito' when ord % 13 = 8 and deb = 0 then 'em_aberto' else status end as status,
  case when ord % 17 = 3 then null when ord % 13 = 6 then 'talvez' else consent end as consent,
  case when ord % 17 = 1 then null else origem end as origem,
  case when ord % 17 = 2 then '  ' else arquivo end as arquivo,
  ord % 13 <> 9 as tem_hist,
  case when ord % 13 <> 10 then tent end as tent,
  case when ord % 13 = 11 and venc is not null then 'baixa' else conf end as conf,
  case when ord % 13 <> 12 then snap end as snap) from rec),"""
    + _checked("spoilt", "val")
)
#: Validation of the last row of a code; rows without one share one.
SHOWN = VAL + """,
shown as (select * exclude (vstatus, erros, avisos, revisao), last_value(vstatus) over w as vstatus, last_value(erros) over w as erros, last_value(avisos) over w as avisos, last_value(revisao) over w as revisao
  from val window w as (partition by coalesce(nex_codigo, 'null') order by ord rows between unbounded preceding and unbounded following))"""

_LATER_CENTS = "case k % 11 when 1 then 0 when 2 then cents * 2 when 3 then cents // 2 else cents end"
_MAIL, _CITY = "'c' || k::varchar || '@ex.com'", "'Cidade ' || c_nationkey::varchar"
PAIR = (
    f"with cust as ({CUSTOMER}), raw1 as (select {_cells(mail=_MAIL, city=_CITY)} from cust where k % 10 <> 9),"
    f" raw2a as (select "
    + _cells(
        cents=_LATER_CENTS,
        tel="when k % 11 = 4 then '4799990000'",
        mail=f"case k % 11 when 5 then ' C' || k::varchar || '@EX.COM' when 6 then 'novo' || k::varchar || '@ex.com' else {_MAIL} end",
        city=f"case when k % 11 = 7 then 'Cidade Nova' else {_CITY} end",
        note=f"case when k % 11 = 8 then 'dia 28' else {NOTE} end",
        name="case when k % 11 = 9 then 'Renomeado' else c_name end",
    )
    + " from cust where k % 10 <> 8), raw2 as (select * from raw2a union all select * replace (ord + 1000000 as ord, '11900000000' as celular) from raw2a where ord % 50 = 3),"
    + _parsed("raw1", "rec1")
    + ","
    + _parsed("raw2", "rec2", "2024-02-29", "clientes2.xls")
    + """,
base as (select * from rec1 where nex_codigo is not null and nome <> ''), novo as (select * from rec2 where nex_codigo is not null and nome <> ''),
base1 as (select * from base qualify row_number() over (partition by nex_codigo order by ord desc) = 1),
novo1 as (select * from novo qualify row_number() over (partition by nex_codigo order by ord desc) = 1),"""
)


def _r2(x: str) -> str:
    return f"floor(({x} + 2.220446049250313e-16) * 100 + 0.5) / 100"


def _key(x: str) -> str:
    return f"lower(trim(coalesce({x}, '')))"


def _differs(f: str) -> str:
    return f"({_key('b_' + f)} <> {_key('n_' + f)})"


_F = ("ord", "nome", "cpf_cnpj", "telefone", "celular", "email", "endereco_cidade", "deb", "cre", "net", "snap", "arquivo", "obs", "categoria", "venc", "conf", "status")
PLAN = (
    PAIR
    + " both_ as (select coalesce(b.nex_codigo, n.nex_codigo) as nex_codigo, "
    + ", ".join(f"b.{f} as b_{f}, n.{f} as n_{f}" for f in _F)
    + " from base1 b full join novo1 n on b.nex_codigo = n.nex_codigo),"
    + f" p1 as (select *, case when b_ord is not null then {_r2('(b_deb - b_cre)')} end as ant, case when n_ord is not null then {_r2('(n_deb - n_cre)')} end as atu from both_),"
    + f" p2 as (select *, {_r2('(atu - ant)')} as dif from p1),"
    + " p3 as (select *, case when dif is null then null when ant > 0 and atu = 0 then 'divida_quitada' when dif > 0 then 'aumento_divida' when dif < 0 then 'reducao_divida' else 'sem_alteracao' end as classe from p2),"
    + f" p4 as (select *, case when dif is not null then classe <> 'sem_alteracao' end as m1, case when dif is not null then {_differs('telefone')} end as m2, case when dif is not null then {_differs('celular')} end as m3,"
    + f" case when dif is not null then {_differs('email')} end as m4, case when dif is not null then {_differs('endereco_cidade')} end as m5, case when dif is not null then {_differs('obs')} end as m6 from p3),"
    + " plan as (select *, case when b_ord is null then 'cliente_novo' when n_ord is null then 'cliente_removido_da_exportacao' when m1 or m2 or m3 or m4 or m5 or m6 then 'cliente_existente_com_alteracao' else 'cliente_existente_sem_alteracao' end as tipo from p4),"
    + " acts as (select *, case tipo when 'cliente_novo' then ['criar novo cadastro'] when 'cliente_removido_da_exportacao' then ['cliente nao consta na nova exportacao - nao remover automaticamente, sinalizar para revisao manual']"
    + " when 'cliente_existente_sem_alteracao' then ['nenhuma alteracao'] else [case when classe = 'divida_quitada' then 'marcar como quitado' when m1 then 'atualizar saldo' else 'manter saldo' end,"
    + ", ".join(f" case when m{i} then 'atualizar' else 'manter' end || ' {p}'" for i, p in enumerate(("telefone", "celular", "email", "endereco", "observacao"), 2))
    + "] end as acoes,"
    + " case when tipo = 'cliente_novo' then 'criado' when tipo = 'cliente_removido_da_exportacao' then 'nao_aplicado' when tipo = 'cliente_existente_sem_alteracao' then 'sem_alteracao' when classe = 'divida_quitada' then 'quitado' else 'atualizado' end as caso from plan)"
)
T2 = "2024-03-01T12:00:00.000Z"

_H = ("Código", "Nome", "CPF / CNPJ", "Telefone", "Celular", "Débito / Crédito", "Observações")
SHEET = (
    RAW
    + ", sheet as (select ord + 2 as row_idx, case when ord % 97 = 0 then 'vazia' when ord % 89 = 0 then 'cabecalho_repetido' else 'util' end as kind from raw),"
    + " uteis as (select * from raw where ord % 97 <> 0 and ord % 89 <> 0),"
    + _parsed("uteis", "rec")
    + ", fin as (select *, tipo = 'reconhecido' and fd > 0 as owes, tipo = 'reconhecido' and fc > 0 as has from rec)"
)


def _d2(x: str, name: str) -> str:
    return f"cast({x} as decimal(38,2)) as {name}"


def _sum2(x: str, name: str) -> str:
    return f"cast(coalesce(sum(cast({x} as decimal(38,2))), 0) as decimal(38,2)) as {name}"


TOTALS = (
    "count(*) as total_registros, count(*) filter (vstatus = 'valido') as validos, count(*) filter (vstatus = 'valido_com_aviso') as validos_com_aviso, count(*) filter (vstatus = 'invalido') as invalidos,"
    " count(*) filter (deb > 0) as clientes_com_debito, count(*) filter (not deb > 0) as clientes_sem_debito, " + _sum2("deb", "total_debito") + ", " + _sum2("cre", "total_credito") + ","
    " count(celular) as com_celular, count(*) - count(celular) as sem_celular, count(cpf_cnpj) as com_cpf, count(*) - count(cpf_cnpj) as sem_cpf,"
    " count(*) filter (categoria = 'estruturada') as observacoes_estruturadas, count(*) filter (categoria = 'vazia') as observacoes_vazias"
)
REPORT = VAL + f", rel as (select {TOTALS}, count(*) filter (revisao) as revisao_manual from val)"


def _money(x: str) -> str:
    return f"'R$ ' || cast({x} as decimal(38,2))::varchar"


def _report_lines() -> str:
    money = lambda f: f"'R$ ' || {f}::varchar"
    plain = lambda f: f"{f}::varchar"
    lines = ["'====================================='", "'PREVIA DA IMPORTACAO (SIMULACAO - NADA FOI GRAVADO)'", "'====================================='", "''", "'Arquivo: clientes.xls'", "''"]
    add = lambda label, f, say=plain: lines.append(f"'{label}: ' || {say(f)}")
    for label, f in (("Total de registros", "total_registros"), ("Registros validos", "validos"), ("Registros com aviso", "validos_com_aviso"), ("Registros invalidos", "invalidos")):
        add(label, f)
    lines.append("''")
    add("Clientes com debito", "clientes_com_debito")
    add("Clientes sem debito", "clientes_sem_debito")
    add("Total do debito", "total_debito", money)
    add("Total do credito", "total_credito", money)
    lines.append("''")
    for label, f in (("Com celular", "com_celular"), ("Sem celular", "sem_celular"), ("Com CPF", "com_cpf"), ("Sem CPF", "sem_cpf")):
        add(label, f)
    lines.append("''")
    add("Observacoes estruturadas", "observacoes_estruturadas")
    add("Observacoes vazias", "observacoes_vazias")
    lines += ["''", "'Resultado previsto:'"]
    lines.append("'  Novos clientes: ' || (validos + validos_com_aviso)::varchar || ' (nesta simulacao, TODOS os validos/com aviso contam como novos - ainda nao existe banco para comparar)'")
    lines.append("'  Atualizacoes: 0 (sempre 0 nesta fase, pelo mesmo motivo)'")
    lines.append("'  Ignorados: ' || invalidos::varchar || ' (registros invalidos, nao seriam importados)'")
    lines.append("'  Revisao manual: ' || revisao_manual::varchar || ' (subconjunto que seria importado, mas marcado para revisao humana antes de qualquer cobranca automatica)'")
    lines.append("'====================================='")
    return REPORT + f", l as (select [{', '.join(lines)}] as x from rel) select (i - 1)::int as linha, x[i] as texto from l, range(1, {len(lines) + 1}) r(i)"


#: printf rounds the exact binary value of a cell, but takes exact halves (eighths that end in 5) to even: these are pushed up.
HOSTILE = (
    "with c as (select c_custkey as ord, case c_custkey % 4 when 0 then repeat('9', (c_custkey % 12 + 2)::int) || '0000000.00' when 1 then (c_custkey % 9 + 1)::varchar || repeat('0', (c_custkey % 5 + 22)::int) else (c_custkey % 1000)::varchar || '.' || lpad((c_custkey % 997)::varchar, 3, '0') end as cell from customer)"
    " select ord, 'R$ ' || case when cell::double >= 1e21 then replace(cell::double::varchar, '.0e', 'e') else printf('%.2f', cell::double + case when cell::double < 1e6 and cell::double * 8 = floor(cell::double * 8) and suffix(cell, '5') then 0.0005 else 0 end) end as texto, cell::double < 1e15 as exato from c"
)


def _cards() -> str:
    sets = {
        "previa": "Total de registros=total_registros;Registros validos=validos;Registros com aviso=validos_com_aviso;Registros invalidos=invalidos;Clientes com debito=clientes_com_debito;Clientes sem debito=clientes_sem_debito;Total do debito=total_debito;Total do credito=total_credito;Com celular=com_celular;Sem celular=sem_celular;Com CPF=com_cpf;Sem CPF=sem_cpf;Observacoes estruturadas=observacoes_estruturadas;Observacoes vazias=observacoes_vazias;Revisao manual=revisao_manual",
        "previsao": "Novos clientes=validos + validos_com_aviso;Atualizacoes=0;Ignorados=invalidos;Revisao manual=revisao_manual",
        "topo": "Total de registros=total_registros;Total do débito=total_debito;Total do crédito=total_credito;Clientes com débito=clientes_com_debito;Revisão manual=revisao_manual;Válidos=validos;Avisos=validos_com_aviso;Inválidos=invalidos",
    }
    cards = [(f"{kind}: {x.split('=')[0]}", x.split("=")[1]) for kind, said in sets.items() for x in said.split(";")]
    rows = " union all ".join(f"select {i} as posicao, '{label}' as rotulo, " + (f"'R$ ' || {f}::varchar" if f in ("total_debito", "total_credito") else f"({f})::varchar") + " as valor from rel" for i, (label, f) in enumerate(cards))
    return REPORT + " " + rows


EXPLAIN = (
    "concat_ws(' ', case when deb > 0 then 'Cliente possui débito de R$ ' || deb::decimal(38,2)::varchar || ' extraído da coluna \"Débito / Crédito\" do NEX.'"
    " when cre > 0 then 'Cliente sem débito, mas com crédito de R$ ' || cre::decimal(38,2)::varchar || ' a favor.' else 'Cliente sem débito na exportação do NEX.' end,"
    " case when categoria = 'vazia' then 'Nenhuma observação registrada no NEX.' else 'Observação classificada como \"' || categoria || '\".' end,"
    " case when categoria <> 'vazia' and venc is not null then 'Sugestão de vencimento: dia ' || venc::varchar || ' (confiança ' || conf || ').' end,"
    " case when categoria <> 'vazia' and qtd is not null then 'Sugestão de parcelamento: ' || qtd::varchar || 'x' || coalesce(' de R$ ' || vparc::decimal(38,2)::varchar, '') || '.' end,"
    " case when len(avisos) > 0 then len(avisos)::varchar || ' aviso(s) de validação encontrado(s).' else 'Nenhum aviso de validação.' end)"
)
LABEL = "case status when 'sem_debito' then 'Sem débito' when 'em_aberto' then 'Em aberto (devendo)' when 'em_negociacao' then 'Em negociação' when 'cobranca_enviada' then 'Cobrança já enviada' when 'promessa_pagamento' then 'Promessa de pagamento registrada' when 'pago' then 'Dívida quitada' when 'inadimplente_recorrente' then 'Inadimplente recorrente' else coalesce(status, '') end"
YES = "case when {} is not null then 'Sim' else '{}' end"

_HEADERS = ("Código", "Cod.Cliente", "Razão Social", "Telefone", "Celular", "WhatsApp", "CPF / CNPJ", "E-mail", "Endereço", "Município", "UF", "Débito / Crédito", "Saldo em Aberto", "Vencimento", "Parcelas", "Limite de Crédito", "Última Venda", "Fiado", "Observações", "  NOME Fantasia ", "Telefone_2")
HEADERS = (
    "with g as (select c_custkey as k, c_nationkey, c_mktsegment, [" + ", ".join(f"'{h}'" for h in _HEADERS) + f"][c_custkey % {len(_HEADERS)} + 1] as plain from customer),"
    " c as (select *, case when k % 4 = 1 then upper(plain) else plain end || case when k % 5 = 2 then ' ' || c_nationkey::varchar when k % 5 = 3 then ' / ' || c_mktsegment else '' end as header from g),"
    f" h as (select k // {len(_HEADERS)} as sheet, k % {len(_HEADERS)} as pos, trim(lower(strip_accents(header))) as k, header from c)"
)
_TAGS = {
    "id_codigo": r"^(id|cod|codigo|cod\.?cliente|codcli)$|\bcod(igo)?\b", "nome": r"\b(nome|razao|fantasia)\b", "telefone": r"\b(telefone|fone|celular|whatsapp)\b", "cpf_cnpj": r"\b(cpf|cnpj|documento)\b", "email": "e-?mail",
    "endereco": r"\b(endereco|rua|logradouro|bairro|cidade|municipio|uf|cep)\b", "cobranca_fiado": r"\bfiado\b", "cobranca_debito": r"\bdebito\b", "cobranca_saldo": r"\bsaldo\b", "cobranca_valor_aberto": "aberto",
    "cobranca_vencimento": "vencimento", "cobranca_parcela": "parcela", "cobranca_credito": r"\bcredito\b", "cobranca_limite": r"\blimite\b", "cobranca_venda": r"\bvenda\b", "observacoes": "observac",
}


def _filters() -> dict[str, str]:
    rules = {"com_debito": "deb > 0", "sem_debito": "not deb > 0", "com_aviso": "vstatus = 'valido_com_aviso'", "invalidos": "vstatus = 'invalido'", "revisao_manual": "revisao", "com_celular": "celular is not null", "sem_celular": "celular is null"}
    return {f"filter_{k}": SHOWN + f" select ord, nex_codigo from shown where {rule}" for k, rule in rules.items()}


def _changed(flag: str, n: str, b: str, name: str) -> str:
    return f"case when caso = 'criado' then {n} when caso in ('atualizado', 'quitado') and {flag} then {n} else {b} end as {name}"


def _apply_base() -> str:
    moved = "(caso = 'quitado' or (caso = 'atualizado' and m1))"
    pick = lambda n, b: f"case when caso = 'criado' or {moved} then {n} else {b} end"
    fields = [
        "nex_codigo", "case when caso = 'criado' then 'PRIME-' || nex_codigo end as prime_id", "case when caso = 'criado' then n_nome else b_nome end as nome",
        _changed("m2", "n_telefone", "b_telefone", "telefone"), _changed("m3", "n_celular", "b_celular", "celular"), _changed("m4", "n_email", "b_email", "email"), _changed("m5", "n_endereco_cidade", "b_endereco_cidade", "endereco_cidade"),
        _changed("m6", "n_obs", "b_obs", "observacao_original_nex"), _changed("m6", "n_categoria", "b_categoria", "observacao_categoria"), _changed("m6", "n_venc", "b_venc", "vencimento_sugerido"), _changed("m6", "n_conf", "b_conf", "confianca_extracao"),
        f"case when caso = 'criado' then n_status when caso = 'quitado' then 'pago' when {moved} and b_status in ('sem_debito', 'em_aberto') then case when n_deb > 0 then 'em_aberto' else 'sem_debito' end else b_status end as status_cobranca",
        "case when caso = 'criado' then n_snap else b_snap end as data_snapshot_nex", "case when caso = 'criado' then n_arquivo else b_arquivo end as fonte_arquivo_origem",
        f"case when caso = 'criado' then '{T2}' end as criado_em", f"case when caso in ('criado', 'atualizado', 'quitado') then '{T2}' end as atualizado_em",
        "case when caso = 'criado' then 'importacao_inicial' when caso in ('atualizado', 'quitado') then 'sincronizacao' end as tipo_ultima_operacao", "case when caso in ('criado', 'atualizado', 'quitado') then 1 else 0 end :: bigint as n_historico",
        _d2(pick("n_deb", "b_deb"), "saldo_debito_nex"), _d2(pick("n_cre", "b_cre"), "saldo_credito_nex"), _d2(f"case when caso = 'criado' then n_net when {moved} then atu else b_net end", "valor_liquido_nex"),
        _d2("case when caso in ('atualizado', 'quitado') then b_deb end", "saldo_debito_anterior"), _d2("case when caso in ('atualizado', 'quitado') then b_cre end", "saldo_credito_anterior"), _d2("case when caso in ('atualizado', 'quitado') then dif end", "variacao_saldo"),
    ]
    return PLAN + " select " + ", ".join(fields) + " from acts"


def _details() -> str:
    part = lambda label, v: f"'{label}=' || {v}"
    empty = lambda c: f"coalesce({c}, '(vazio)')"
    source = [part("Código NEX", "coalesce(nex_codigo, '')"), part("Nome", "nome"), part("Telefone", empty("telefone")), part("Celular", empty("celular")), part("E-mail", empty("email")), part("CPF/CNPJ", empty("cpf_cnpj")), part("Endereço", "'(vazio)'"), part("Bairro/Cidade/UF", "'(vazio)'"), part("CEP", "'(vazio)'"), part("Observação original", "coalesce(nullif(obs, ''), '(vazio)')")]
    norm = [part("Débito (NEX)", _money("deb")), part("Crédito (NEX)", _money("cre")), part("Saldo líquido", _money("net")), part("Situação (status_cobranca)", "status")]
    sug = [part("Categoria da observação", "categoria"), part("Vencimento sugerido", "coalesce('dia ' || venc::varchar, '(nenhum)')"), part("Parcelamento sugerido", f"case when qtd is not null then qtd::varchar || 'x de ' || {_money('coalesce(vparc, 0)')} else '(nenhum)' end"), part("Confiança da extração", "coalesce(conf, '(nenhuma)')")]
    join = lambda xs: " || '; ' || ".join(xs)
    return SHOWN + f" select ord, {join(source)} as dados_nex, {join(norm)} as dados_normalizados, {join(sug)} as sugestoes, {LABEL} as classificacao_financeira from shown"


def _mask() -> str:
    return f"""with cust as ({CUSTOMER}), x as (select k, case k % 4 when 0 then lpad(k::varchar, 11, '0') when 1 then lpad(k::varchar, 14, '0') when 2 then 'doc ' || k::varchar else '' end as doc,
  case k % 3 when 0 then ' c' || k::varchar || '@ex.com' when 1 then 'sem email' else '' end as mail, case when k % 2 = 0 then '(47) 3322-' || lpad((k % 10000)::varchar, 4, '0') else ' - ' end as fone,
  case when k % 5 = 0 then '  ' else 'Rua ' || k::varchar end as rua from cust), y as (select *, regexp_replace(doc, '[^0-9]', '', 'g') as dd, regexp_replace(fone, '[^0-9]', '', 'g') as fd from x)
select k as ord, fd as digitos, case when length(dd) = 11 then '***.***.***-' || right(dd, 2) when length(dd) = 14 then '**.***.***/****-' || right(dd, 2) when length(dd) > 0 then '[DOCUMENTO OCULTO]' else '' end as documento,
  case when trim(mail) = '' then '' when contains(mail, '@') then 'c***@ex.com' else '[EMAIL OCULTO]' end as email, case when fd = '' then '' else '(**) *****-' || right(fd, 4) end as telefone,
  case when trim(rua) = '' then '' else '[ENDEREÇO OCULTO]' end as endereco, regexp_replace(trim(fone), '[0-9]', '#', 'g') as formato from y"""


def _examples() -> str:
    found = " union all ".join(
        f"select '{kind}' as tipo, {say} as v, ord, i from fin, range(1, 20) r(i) where i <= len({c})"
        for kind, c, say in (("dia", "dias", "'dia ' || dias[i]::varchar"), ("parcela", "parcelas", "parcelas[i]::varchar || 'x'"), ("valor", "valores", "valores[i]"))
    )
    return SHEET + f", x as ({found}), y as (select tipo, v, min(ord * 100 + i) as f_at from x group by tipo, v), z as (select *, row_number() over (partition by tipo order by f_at, v) as posicao from y) select tipo, case when tipo = 'valor' then regexp_replace(v, '[0-9]', '#', 'g') else v end as exemplo, posicao::int as posicao from z where posicao <= 5"


def oracle_sql() -> dict[str, str]:
    plan_cols = ", ".join(f"m{i} as {f}_mudou" for i, f in enumerate(("saldo", "telefone", "celular", "email", "endereco", "observacao"), 1))
    tags = " union all ".join([f"select sheet, '{t}' as tag, pos, header from h where regexp_matches(k, '{p}')" for t, p in _TAGS.items()] + ["select sheet, 'saldo_dc', pos, header from h where contains(k, 'debito') and contains(k, 'credito')"])
    messages = "ord, vstatus as validacao_status, array_to_string(erros, ' | ') as erros, array_to_string(avisos, ' | ') as avisos"
    of = lambda *t: PLAN + " select nex_codigo from acts where tipo in (" + ", ".join(f"'{x}'" for x in t) + ")"
    upsert = PAIR + " up as (select * from novo1 union all select * from base1 where nex_codigo not in (select nex_codigo from novo1))"
    changed = ", ".join(f"case when m{i} then '{f}Mudou' end" for i, f in enumerate(("saldo", "telefone", "celular", "email", "endereco", "observacao"), 1))
    out = {
        "raw_export_scan": RAW + " select ord, codigo, nome, cpf_cnpj, telefone, celular, debito_credito, observacoes, 'clientes.xls' as fonte_arquivo_origem, '2024-01-31' as data_snapshot_nex from raw",
        "parse_valor_br": RAW + ", x as (select ord, regexp_extract(debito_credito, '([0-9][0-9.,]*)', 1) as texto from raw) select ord, texto, " + _d2(_amount("texto"), "valor") + " from x",
        "parse_financeiro": NORM + " select ord, tipo, t as raw, " + _d2("fd", "debito") + ", " + _d2("fc", "credito") + " from rec",
        "obs_signals": NORM + " select ord, array_to_string(dias, ',') as dias, array_to_string(parcelas, ',') as parcelas, array_to_string(valores, ';') as valores from rec",
        "obs_category": NORM + " select categoria, conf as confianca, count(*) as n from rec group by all",
        "document_values": f"with x as (select doc_id, trim(coalesce(text, '')) as o from documents), y as (select doc_id, o, {DAYS} as d, {COUNTS} as p, {VALUES} as v from x) select doc_id, len(v)::bigint as n_valores, len(list_distinct(d))::bigint as n_dias,"
        " case when o = '' then 'vazia' when len(list_distinct(d)) > 1 then 'ambigua' when (len(d) > 0)::int + (len(p) > 0)::int + (len(v) > 0)::int >= 2 then 'estruturada' when len(d) + len(p) + len(v) > 0 then 'parcialmente_estruturada' else 'texto_operacional' end as categoria from y",
        "installment_suggestion": NORM + " select ord, venc as vencimento_sugerido, qtd, " + _d2("vparc", "valor") + " from rec",
        "round2": "select c_custkey as ord, " + _d2(_r2("(c_acctbal / 8)"), "oitavo") + " from customer",
        "mask_pii": _mask(),
        "header_normalize": HEADERS + " select sheet, pos, k as chave from h",
        "column_tags": HEADERS + f", t as ({tags}) select sheet, tag, string_agg(header, ', ' order by pos) as cabecalhos from t group by sheet, tag",
        "normalize_records": NORM + " select ord, nex_codigo, 'NEX' as origem_sistema, nome, cpf_cnpj, telefone, celular, email, endereco_cidade, " + ", ".join((_d2("deb", "saldo_debito_nex"), _d2("cre", "saldo_credito_nex"), _d2("net", "valor_liquido_nex"), _d2("vparc", "valor_parcela")))
        + ", snap as data_snapshot_nex, obs as observacao_original_nex, categoria as observacao_categoria, venc as vencimento_sugerido, qtd as parcelas, conf as confianca_extracao, status as status_cobranca, 0::bigint as n_historico, tent as tentativas_cobranca,"
        " consent as consentimento_contato, false as whatsapp_validado, arquivo as fonte_arquivo_origem, null::varchar as prime_id, null::varchar as hash_registro_nex from rec",
        "validation_tampered": SPOILT + f" select {messages} from val",
        "validation_status": VAL + " select ord, vstatus as validacao_status from val",
        "validation_errors": VAL + " select erro, count(*) as n from (select unnest(erros) as erro from val) group by erro",
        "validation_warnings": VAL + " select aviso, count(*) as n from (select unnest(avisos) as aviso from val) group by aviso",
        "validation_summary": VAL + " select count(*) as total, count(*) filter (vstatus = 'valido') as validos, count(*) filter (vstatus = 'valido_com_aviso') as validos_com_aviso, count(*) filter (vstatus = 'invalido') as invalidos from val",
        "manual_review": VAL + " select ord, nex_codigo from val where revisao",
        "analyzed_records": SHOWN + f" select {messages}, nex_codigo, celular is not null as tem_celular, cpf_cnpj is not null as tem_cpf, len(avisos)::int as qtd_avisos, revisao as revisao_manual from shown",
        "warning_rows": VAL + ", f as (select coalesce(nex_codigo, 'null') as key, nome, deb, celular, cpf_cnpj from val qualify row_number() over (partition by coalesce(nex_codigo, 'null') order by ord) = 1)"
        " select v.ord, v.nex_codigo, f.nome, " + _money("f.deb") + " as debito, " + YES.format("f.celular", "Nao") + " as celular, " + YES.format("f.cpf_cnpj", "Nao") + " as cpf, len(v.avisos)::int as qtd_avisos, array_to_string(v.avisos, '; ') as avisos"
        " from val v join f on coalesce(v.nex_codigo, 'null') = f.key where v.vstatus = 'valido_com_aviso'",
        "simulation_totals": VAL + f" select {TOTALS} from val",
        "simulation_forecast": REPORT + " select validos + validos_com_aviso as novos, 0::bigint as atualizacoes, invalidos as ignorados, revisao_manual from rel",
        "report_text_lines": _report_lines(),
        "summary_cards": _cards(),
        "result_cards": PLAN + ", s as (select count(*) filter (caso = 'criado') as criados, count(*) filter (caso = 'atualizado') as atualizados, count(*) filter (caso = 'quitado') as quitados, count(*) filter (caso = 'sem_alteracao') as sem_alteracao,"
        " count(*) filter (caso = 'nao_aplicado') as nao_aplicados, count(*) as total_processado from acts), r as (select revisao_manual from (" + REPORT + " select revisao_manual from rel))"
        + " union all ".join(f" select {i} as posicao, '{label}' as rotulo, {f}::varchar as valor from s, r" for i, (label, f) in enumerate((("Total processado", "total_processado"), ("Novos clientes", "criados"), ("Atualizados", "atualizados"), ("Quitados", "quitados"), ("Sem alteração", "sem_alteracao"), ("Removidos/ausentes", "nao_aplicados"), ("Revisão manual (da análise)", "revisao_manual"), ("Avisos na sincronização", "nao_aplicados")))),
        "hostile_cells": HOSTILE,
        "search_records": SHOWN + " select ord, nex_codigo, nome from shown where deb > 0 and (contains(lower(coalesce(nex_codigo, '')), '00012') or contains(lower(nome), '00012') or contains(coalesce(telefone, ''), '00012') or contains(coalesce(celular, ''), '00012'))",
        "review_rows": SHOWN + " select ord, nex_codigo, nome, " + _money("deb") + " as debito, " + _money("cre") + " as credito, status as status_cobranca, " + YES.format("celular", "Não") + " as celular, " + YES.format("cpf_cnpj", "Não") + " as cpf, categoria as observacao_categoria, vstatus as validacao_status, len(avisos)::int as qtd_avisos from shown",
        "status_label": SPOILT + f" select {LABEL} as rotulo, count(*) as n from val group by 1",
        "explanation_text": VAL + f" select ord, {EXPLAIN} as explicacao from val",
        "record_details": _details(),
        "eligible_records": SPOILT + " select ord, nex_codigo from val where vstatus <> 'invalido'",
        "dedup_last_wins": PAIR + " f as (select nex_codigo, min(ord) as pos from novo group by 1) select n.nex_codigo, n.ord, f.pos, n.celular from novo1 n join f using (nex_codigo)",
        "all_codes": PAIR + " u as (select nex_codigo from base union select nex_codigo from novo) select nex_codigo from u",
        "plan_items": PLAN + " select nex_codigo, tipo, array_to_string(acoes, '; ') as acoes, " + ", ".join((_d2("ant", "saldo_anterior"), _d2("atu", "saldo_atual"), _d2("dif", "diferenca_saldo"))) + f", classe as classificacao_saldo, {plan_cols} from acts",
        "plan_text": PLAN + " select nex_codigo, 'Cliente ' || nex_codigo || chr(10) || 'Ações:' || chr(10) || array_to_string(list_transform(acoes, lambda a: '  ✔ ' || a), chr(10)) || chr(10) || '----------------------------------' as texto from acts",
        "plan_summary": PLAN + " select (select count(*) from base) as total_base, (select count(*) from novo) as total_nova_importacao, count(*) as total_comparados, count(*) filter (tipo = 'cliente_novo') as clientes_novos, count(*) filter (tipo = 'cliente_existente_sem_alteracao') as clientes_sem_alteracao,"
        " count(*) filter (tipo = 'cliente_existente_com_alteracao') as clientes_com_alteracao, count(*) filter (tipo = 'cliente_removido_da_exportacao') as clientes_removidos_da_exportacao, count(*) filter (classe = 'divida_quitada') as dividas_quitadas,"
        " count(*) filter (classe = 'aumento_divida') as dividas_aumentaram, count(*) filter (classe = 'reducao_divida') as dividas_reduziram, 0::bigint as registros_sem_identificador_ignorados from acts",
        "clients_new": of("cliente_novo"),
        "clients_removed": of("cliente_removido_da_exportacao"),
        "clients_common": of("cliente_existente_com_alteracao", "cliente_existente_sem_alteracao"),
        "apply_base": _apply_base(),
        "apply_bare_plan": "select nex_codigo, prime_id, telefone, email, status_cobranca, atualizado_em, n_historico, saldo_debito_nex, saldo_debito_anterior, variacao_saldo from (" + _apply_base() + ")",
        "apply_summary": PLAN + " select count(*) filter (caso = 'criado') as criados, count(*) filter (caso = 'atualizado') as atualizados, count(*) filter (caso = 'quitado') as quitados, count(*) filter (caso = 'sem_alteracao') as sem_alteracao, count(*) filter (caso = 'nao_aplicado') as nao_aplicados,"
        " count(*) filter (caso in ('criado', 'atualizado', 'quitado')) as total_eventos, count(*) as total_processado from acts",
        "apply_events": PLAN + f" select nex_codigo, case caso when 'criado' then 'cliente_importado' when 'quitado' then 'divida_quitada' else 'cliente_atualizado' end as tipo, case when caso = 'criado' then 'NEX' end as origem, '{T2}' as data,"
        f" case when caso = 'atualizado' then array_to_string(list_filter([{changed}], lambda x: x is not null), ',') end as campos_alterados, case when caso = 'atualizado' then classe end as classificacao_saldo, "
        + ", ".join((_d2("case when caso = 'criado' then atu end", "saldo_inicial"), _d2("case when caso <> 'criado' then ant end", "saldo_anterior"), _d2("case when caso = 'atualizado' then atu end", "saldo_novo"), _d2("case when caso = 'quitado' then 0 end", "saldo_atual"), _d2("case when caso = 'atualizado' then dif end", "diferenca")))
        + " from acts where caso in ('criado', 'atualizado', 'quitado')",
        "not_applied": PLAN + " select nex_codigo, tipo as motivo, 'cliente ' || nex_codigo || ' nao consta na nova exportacao - revisar manualmente antes de qualquer acao' as aviso from acts where caso = 'nao_aplicado'",
        "repo_upsert": upsert + " select nex_codigo, celular, email, arquivo as fonte_arquivo_origem from up",
        "repo_point_lookup": upsert + " select nex_codigo, nome from up where nex_codigo = '106' union all select nex_codigo, nome from up where nex_codigo = '42'",
        "profile_header_detect": "select 'Clientes' as sheet, 1::bigint as header_idx",
        "profile_rows": SHEET + " select 'Clientes' as sheet, count(*) as linhas_brutas, count(*) filter (kind = 'vazia') as linhas_vazias, count(*) filter (kind = 'cabecalho_repetido') as cabecalhos_repetidos, count(*) filter (kind = 'util') as registros_uteis,"
        " coalesce((select string_agg((row_idx + 1)::varchar, ', ' order by row_idx) from (select row_idx from sheet where kind = 'vazia' order by row_idx limit 20)), '') as primeiras_vazias from sheet",
        "profile_missing": SHEET + " select count(*) as registros, (count(*) filter (nome = ''))::varchar as sem_nome, (count(*) filter (telefone is null))::varchar as sem_telefone, (count(*) filter (cpf_cnpj is null))::varchar as sem_cpf from fin",
        "profile_duplicates": SHEET + ", g as (select cpf_cnpj, count(*) as n from fin where cpf_cnpj is not null group by 1) select 'cpf_cnpj' as criterio, count(*) filter (n > 1) as duplicidades from g",
        "profile_duplicates_by_name": SHEET + ", g as (select lower(nome) as x, count(*) as n from fin where nome <> '' group by 1) select 'nome' as criterio, count(*) filter (n > 1) as duplicidades from g",
        "profile_financial": SHEET + " select count(*) as registros, count(*) filter (owes) as com_debito, count(*) filter (has) as com_credito, count(*) filter (owes and has) as com_ambos, count(*) filter (not owes and not has) as sem_movimentacao, count(*) filter (tipo = 'formato_nao_reconhecido') as nao_reconhecidos, "
        + _sum2("case when owes then fd end", "total_debito") + ", " + _sum2("case when has then fc end", "total_credito") + ", cast(coalesce(sum(cast(case when owes then fd end as decimal(38,2))), 0) - coalesce(sum(cast(case when has then fc end as decimal(38,2))), 0) as decimal(38,2)) as saldo_liquido from fin",
        "profile_unrecognized_shapes": SHEET + ", g as (select regexp_replace(t, '[0-9]', '#', 'g') as formato, count(*) as quantidade, min(ord) as f from fin where tipo = 'formato_nao_reconhecido' group by 1) select formato, quantidade from g order by f, formato limit 5",
        "profile_notes": SHEET + " select " + ", ".join(f"count(*) filter (categoria = '{k}') as {k}" for k in ("vazia", "estruturada", "parcialmente_estruturada", "texto_operacional", "ambigua")) + ", count(*) filter (len(dias) > 0) as com_dia, count(*) filter (len(parcelas) > 0) as com_parcela, count(*) filter (len(valores) > 0) as com_valor from fin",
        "profile_examples": _examples(),
        "profile_contactability": SHEET + ", g as (select count(*) filter (owes and o <> '') as debito_e_observacao, count(*) filter (owes and o = '') as debito_sem_observacao, count(*) filter (owes and celular is not null) as debito_e_celular, count(*) filter (owes and celular is null) as debito_sem_celular from fin),"
        " x as (select *, debito_e_celular + debito_sem_celular as n from g) select debito_e_observacao, debito_sem_observacao, debito_e_celular, debito_sem_celular, case when n = 0 then '0.0' else (((2000 * debito_e_celular + n) // (2 * n)) // 10)::varchar || '.' || (((2000 * debito_e_celular + n) // (2 * n)) % 10)::varchar end as percentual from x",
        "profile_reconcile": SHEET + ", g as (select " + _sum2("case when owes then fd end", "total_calculado") + " from fin) select total_calculado, cast(25414.58 as decimal(38,2)) as total_referencia, cast(abs(total_calculado - 25414.58) as decimal(38,2)) as diferenca, case when abs(total_calculado - 25414.58) < 0.01 then 'Sim' else 'Nao' end as valores_iguais from g",
    }
    return out | _filters()
