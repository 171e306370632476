from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from saldus.context import Context, plain_id
from saldus.operators import explore, profile
from saldus.operators.apply import apply_plan, with_records
from saldus.operators.normalize import normalize
from saldus.operators.plan import build_plan, format_plan
from saldus.operators.simulate import format_report, report_lines
from saldus.operators.validate import validate
from saldus.plans import flows
from saldus.schema import SCHEMA, schema_catalog
from saldus.sources import customer_export
from saldus.sources.exports import as_text, check_file, numbered, read_matrix
from saldus.sources.failures import ImportFailure
from saldus.sources.repository import MemoryRepository, ParquetRepository, Queue, check_contract

FIRST = Context(file="a.xls", snapshot="2024-01-31", executed="T1", new_id=plain_id)
NEXT = Context(file="b.xls", snapshot="2024-02-29", executed="T2", new_id=plain_id)


def export(spark, rows):
    """rows: (code, name, balance[, phone[, note]])"""
    data = [(i, r[0], r[1], r[2], r[3] if len(r) > 3 else "1199999", r[4] if len(r) > 4 else "") for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "_ord long, `Código` string, `Nome` string, `Débito / Crédito` string, `Celular` string, `Observações` string")


def debts(spark, context, **balances):
    return normalize(export(spark, [(k[1:], f"Cliente {k}", f"Débito- R$ {v},00" if v else "") for k, v in balances.items()]), context)


def test_record(spark):
    raw = export(spark, [("42", " Ana ", "Débito- R$ 200,00", "119", "3x 50,00 dia 10"), ("7", "Bo", "", "", "")])
    a, b = normalize(raw, FIRST).orderBy("_ord").collect()
    assert (a["saldo_debito_nex"], a["status_cobranca"], a["vencimento_sugerido"], tuple(a["parcelamento_sugerido"]), a["confianca_extracao"], a["prime_id"], a["nex_codigo"], a["nome"]) == (200, "em_aberto", 10, (3, 50.0), "alta", None, "42", "Ana")
    assert (b["status_cobranca"], b["celular"], b["observacao_categoria"], b["vencimento_sugerido"], b["historico"]) == ("sem_debito", None, "vazia", None, [])
    empty = normalize(spark.createDataFrame([(0,)], "_ord long"), FIRST).first()
    assert (empty["nome"], empty["nex_codigo"]) == ("", None)


def test_schema(spark):
    assert len(SCHEMA) == 48 and sum(f.metadata["obrigatorio"] for f in SCHEMA) == 16 and schema_catalog(spark).count() == 48
    assert normalize(export(spark, []), FIRST).drop("_ord").schema.names == SCHEMA.names


def test_validation(spark):
    rows = normalize(export(spark, [("1", "A", "", "1"), ("2", "B", "Débito- R$ 80,00", "1"), ("3", "C", "Débito- R$ 120,00", ""), ("4", " ", "")]), FIRST)
    assert [r["validacao_status"] for r in validate(rows).orderBy("_ord").collect()] == ["valido", "valido_com_aviso", "valido_com_aviso", "invalido"]
    bad = rows.where("nex_codigo = '1'").withColumn("valor_liquido_nex", F.lit(999.0)).withColumn("saldo_debito_nex", F.lit(-50.0)).withColumn("status_cobranca", F.lit("x")).withColumn("historico", F.lit(None).cast(SCHEMA["historico"].dataType))
    assert validate(bad).first()["erros"] == ['campo obrigatorio "historico" nao e um array', '"saldo_debito_nex" negativo', '"valor_liquido_nex" (999) nao bate com debito-credito (-50.00)', '"status_cobranca" fora do enum permitido: "x"']


def test_analysis(spark):
    raw = export(spark, [("1", "Um", "Débito- R$ 100,00", "11", "2x 50,00 dia 10"), ("2", "Dois", ""), ("2", "", ""), (None, "Sem", "")])
    a = flows.analyze(raw, FIRST)
    report = a.relatorio.first()
    assert (report["total_registros"], float(report["total_debito"]), report["invalidos"], report["novos"]) == (4, 100.0, 2, 2)
    assert format_report(report).split("\n") == [r["texto"] for r in report_lines(a.relatorio).orderBy("linha").collect()]
    shown = a.registros.orderBy("_ord").collect()
    assert [r["validacao_status"] for r in shown] == ["valido_com_aviso", "invalido", "invalido", "invalido"]  # the last row of a code decides
    assert [r["nex_codigo"] for r in a.registros_com_aviso.collect()] == ["1"]
    with pytest.raises(ImportFailure) as e:
        flows.analyze(spark.createDataFrame([(0, "x")], "_ord long, outra string"), FIRST)
    assert e.value.codigo == "estrutura_incompativel"


def test_plan(spark):
    base = debts(spark, FIRST, c1=100, c2=100, c3=300, c4=180, c5=100, c6=100)
    new = debts(spark, NEXT, c1=100, c2=250, c3=100, c4=0, c6=100, c7=100).withColumn("telefone", F.when(F.col("nex_codigo") == "6", F.lit("47")))
    plan = build_plan(base, new)
    got = {r["nex_codigo"]: (r["tipo"], r["classificacao_saldo"], r["diferenca_saldo"], r["acoes"][0]) for r in plan.collect()}
    assert got["1"][0] == "cliente_existente_sem_alteracao" and got["2"][1:3] == ("aumento_divida", 150) and got["3"][1:3] == ("reducao_divida", -200)
    assert got["4"][1] == "divida_quitada" and got["4"][3] == "marcar como quitado" and got["5"][0] == "cliente_removido_da_exportacao" and got["7"][0] == "cliente_novo" and got["6"][3] == "manter saldo"
    assert [r["nex_codigo"] for r in plan.orderBy("_ord").collect()] == ["1", "2", "3", "4", "5", "6", "7"]
    assert format_plan(plan).startswith("Cliente 1\nAções:\n  ✔ nenhuma alteracao\n")
    assert build_plan(base.limit(0), new.limit(0)).count() == 0
    bare = plan.select("_ord", "nex_codigo", "tipo", "acoes", "saldo_anterior", "saldo_atual", "diferenca_saldo", "classificacao_saldo", "alteracoes").union(spark.createDataFrame([((9, 9), "9", "outro", [], None, None, None, None, None)], plan.drop("b", "n").select("_ord", "nex_codigo", "tipo", "acoes", "saldo_anterior", "saldo_atual", "diferenca_saldo", "classificacao_saldo", "alteracoes").schema))
    applied = apply_plan(with_records(bare, base, new), NEXT)
    assert applied.nova_base.count() == 7
    assert {r["aviso"] for r in applied.avisos.collect()} == {"cliente 5 nao consta na nova exportacao - revisar manualmente antes de qualquer acao", 'tipo de plano desconhecido para cliente 9: "outro"'}
    with pytest.raises(ValueError, match="context"):
        apply_plan(plan, Context())


def test_sync_keeps_what_people_set(spark, tmp_path):
    mixed = debts(spark, FIRST, c201=100, c202=300, c203=0, c204=0)
    for repo in (MemoryRepository(spark), ParquetRepository(spark, f"file://{tmp_path}/base")):
        assert flows.sync(repo, mixed, FIRST).resumo_execucao["criados"] == 4
        by_hand = repo.find_all().where("nex_codigo in ('201', '203')").withColumns({"status_cobranca": F.when(F.col("nex_codigo") == "201", F.lit("em_negociacao")).otherwise(F.col("status_cobranca")), "observacao_prime": F.lit("nota")})
        repo.save_batch(by_hand)
        new = debts(spark, NEXT, c201=400, c202=0, c203=0, c205=0)
        with pytest.raises(RuntimeError):
            repo.fail_next_save()
            flows.sync(repo, new, NEXT)
        assert repo.find_by_code(202)["saldo_debito_nex"] == 300
        done = flows.sync(repo, new, NEXT).resumo_execucao
        assert (done["criados"], done["atualizados"], done["quitados"], done["sem_alteracao"], done["nao_aplicados"]) == (1, 1, 1, 1, 1)
        assert repo.find_all().count() == 5
        r201, r202 = repo.find_by_code("201"), repo.find_by_code(202)
        assert (r201["status_cobranca"], r201["saldo_debito_nex"], r201["saldo_debito_anterior"], r201["observacao_prime"], r201["prime_id"], r201["criado_em"], r201["atualizado_em"]) == ("em_negociacao", 400, 100, "nota", "PRIME-201", "T1", "T2")
        assert [e["tipo"] for e in r201["historico"]] == ["cliente_importado", "cliente_atualizado"] and r201["historico"][1]["campos_alterados"] == ["saldoMudou"]
        assert (r202["status_cobranca"], r202["historico"][-1]["tipo"]) == ("pago", "divida_quitada")
        assert repo.find_by_code("999") is None
        again = flows.sync(repo, new, NEXT).resumo_execucao
        assert (again["sem_alteracao"], again["nao_aplicados"], again["atualizados"]) == (4, 1, 0)
        assert [r["nex_codigo"] for r in repo.find_all().orderBy("_ord").collect()] == ["201", "202", "203", "204", "205"]


def test_import_of_a_payload(spark):
    import json

    def failure(body, repo):
        with pytest.raises(ImportFailure) as e:
            flows.import_payload(repo, body, FIRST)
        return e.value.codigo, e.value.mensagem

    repo = MemoryRepository(spark)
    for body in (b"", b"{", b'{"registros": NaN}'):
        assert failure(body, repo) == ("payload_invalido", "Corpo da requisicao nao e um JSON valido.")
    for body in (b"null", b"[]", b'"registros"', b"{}", b'{"registros": {}}'):
        assert failure(body, repo)[0] == "payload_invalido"
    rows = [json.loads(x) for x in debts(spark, FIRST, c201=100, c202=0).select(*SCHEMA.names).toJSON().collect()]
    none = flows.import_payload(repo, b'{"registros": []}', FIRST)
    assert (none.total_processado, set(none.resumo_execucao.values()), none.quantidade_eventos_historico) == (0, {0}, 0)
    spoilt = {**rows[0], "nex_codigo": "203", "saldo_debito_nex": "muito", "validacao_status": "valido"}
    body = json.dumps({"registros": [*rows, spoilt, None, 7]}).encode()
    repo.fail_next_save()
    assert failure(body, repo) == ("erro_sincronizacao", "Nao foi possivel concluir a importacao. Nenhum dado foi salvo.") and repo.find_all().isEmpty()
    done = flows.import_payload(repo, body, FIRST)
    assert (done.total_processado, done.resumo_execucao["criados"], done.quantidade_eventos_historico, done.registros_nao_aplicados.count()) == (2, 2, 2, 0)
    assert sorted(r["nex_codigo"] for r in repo.find_all().collect()) == ["201", "202"] and repo.find_by_code("201")["saldo_debito_nex"] == 100


def test_empty_export(spark):
    with pytest.raises(ImportFailure) as e:
        flows.analyze(export(spark, [("1", "A", "")]).where("false"))
    assert e.value.codigo == "planilha_vazia"


def test_syncs_go_in_the_order_of_their_calls():
    import threading
    import time

    queue, order, threads = Queue(), [], []

    def one(i):
        try:
            with queue:
                order.append(i)
                raise RuntimeError
        except RuntimeError:
            pass

    with queue:
        for i in range(20):
            threads.append(threading.Thread(target=one, args=(i,)))
            threads[-1].start()
            while len(queue._turns) < i + 2:
                time.sleep(0.001)
    for t in threads:
        t.join(5)
    assert order == list(range(20))


def test_contract():
    with pytest.raises(TypeError, match="save_batch"):
        check_contract(type("Half", (), {"find_all": lambda s: None, "find_by_code": lambda s, c: None})())


def test_explore(spark):
    rows = spark.createDataFrame([(1, "1", "Ana Lima", "4733", None, 10.0, False, "valido_com_aviso", True), (2, "2", "Bia", None, "119999", 0.0, True, "valido", False), (3, "3", "Caio", None, None, 5.0, False, "invalido", False), (4, "43", "Mariana", None, "118", 7.0, True, "valido", False)], "_ord long, nex_codigo string, nome string, telefone string, celular string, saldo_debito_nex double, tem_celular boolean, validacao_status string, revisao_manual boolean")
    codes = lambda *a: [r["nex_codigo"] for r in explore.filter_records(rows, *a).orderBy("_ord").collect()]
    assert codes("com_debito") == ["1", "3", "43"] and codes("sem_debito") == ["2"] and codes("com_aviso") == ["1"] and codes("invalidos") == ["3"]
    assert codes("revisao_manual") == ["1"] and codes("com_celular") == ["2", "43"] and codes("sem_celular") == ["1", "3"] and codes("nenhum tal") == ["1", "2", "3", "43"]
    assert codes("todos", " ANA ") == ["1", "43"] and codes("todos", "3") == ["1", "3", "43"] and codes("todos", "%") == [] and codes("todos", "4733") == ["1"] and codes("todos", "9999") == ["2"]
    assert explore.size_text(10) == "10 B" and explore.size_text(2048) == "2.0 KB" and explore.check_upload(["a.XLS"]) is None and explore.check_upload([]) and explore.check_upload(["a", "b"])


def test_sources(spark):
    for name, data, code in (("a.csv", b"x", "formato_invalido"), ("a.XLS", b"", "arquivo_vazio")):
        with pytest.raises(ImportFailure) as e:
            check_file(name, data)
        assert e.value.codigo == code
    numbers = numbered(as_text(spark.createDataFrame([(42.0, 1.5)], "`Código` double, x double")))
    assert numbers.select("Código", "x").first() == ("42", "1.5")


def test_profile(spark):
    sheets = {"S": [["Titulo", ""], ["Código", "Nome", "Débito / Crédito"], ["1", "A", "Débito 10,00"], ["", " ", None], ["CODIGO", "nome", "debito / credito"], ["2", "", "??? 12"]], "vazia": [[1, 2], ["", ""]]}
    m = read_matrix(spark, sheets)
    assert {r["sheet"]: r["header_idx"] for r in profile.header_rows(m).collect()} == {"S": 1, "vazia": -1}
    counts = profile.row_accounting(m).first()
    assert (counts["linhas_brutas"], counts["linhas_vazias"], counts["cabecalhos_repetidos"], counts["registros_uteis"], counts["primeiras_vazias"]) == (4, 1, 1, 2, "4")
    columns = profile.find_columns(m, "S")
    rows = profile.useful_rows(m, "S", columns)
    assert profile.missing(rows, columns).first().asDict() == {"registros": 2, "sem_nome": "1", "sem_telefone": profile.NO_COLUMN, "sem_cpf": profile.NO_COLUMN}
    assert profile.unrecognized_shapes(rows).collect() == [("??? ##", 1)]
    assert profile.contactability(rows).first()["percentual"] == "0.0"
    assert profile.reconcile(rows, 10.0).first()["valores_iguais"] == "Sim"


def test_result_cards(spark):
    from saldus.operators import explore

    row = spark.createDataFrame([(9, 1, 2, 3, 4, 5, 6, 7)], "total_processado long, criados long, atualizados long, quitados long, sem_alteracao long, nao_aplicados long, revisao_manual long, total_avisos long")
    got = [(r["rotulo"], r["valor"]) for r in explore.cards(row, explore.RESULT_CARDS).orderBy("posicao").collect()]
    assert len(got) == 8 and got[6:] == [("Revisão manual (da análise)", "6"), ("Avisos na sincronização", "7")]


def test_stale_base_is_refused(spark, tmp_path):
    from saldus.sources.repository import ParquetRepository, StaleBase

    one, two = (ParquetRepository(spark, f"{tmp_path}/store") for _ in range(2))
    empty = one.find_all()
    read = one.version()
    two.save_batch(empty, two.version())
    with pytest.raises(StaleBase):
        one.save_batch(empty, read)


def test_rows_of_several_files_keep_their_order(spark, tmp_path):
    from saldus.sources.exports import read_table

    spark.createDataFrame([("first",)], "Nome string").coalesce(1).write.parquet(f"{tmp_path}/a")
    spark.range(2000).selectExpr("cast(id as string) as Nome").coalesce(1).write.parquet(f"{tmp_path}/b")
    folder = tmp_path / "export"
    folder.mkdir()
    for name in "ab":
        next((tmp_path / name).glob("part-*.parquet")).rename(folder / f"{name}.parquet")
    rows = [(r["_ord"], r["Nome"]) for r in read_table(spark, str(folder)).orderBy("_ord").collect()]
    assert rows == list(enumerate(["first", *map(str, range(2000))]))


def test_the_last_row_of_the_last_file_wins(spark, tmp_path):
    """Three CSV files, of which two share a name in two folders: rows are in the order of paths, whatever order Spark reads the files in."""
    from saldus.operators.lookup import dedup_last
    from saldus.sources.exports import read_table

    folder = tmp_path / "exports.csv"
    lines = {"2024 a/clientes": [(str(i), f'a{i} "x"\ny') for i in range(300)], "2024 b/clientes": [("1", "b1"), ("2", "b2"), ("1", "b1 again")], "c": [("2", "c2"), ("neu", "cn")]}
    for name, rows in lines.items():
        at = folder / f"kind={name.partition('/')[0]}" / f"{name.rpartition('/')[2]}.csv"
        at.parent.mkdir(parents=True)
        at.write_text("Código,Nome\n" + "".join(f'{c},"{n.replace(chr(34), chr(34) * 2)}"\n' for c, n in rows))
    rows = read_table(spark, str(folder)).orderBy("_ord").collect()
    assert [(r["_ord"], r["Código"], r["Nome"]) for r in rows] == [(i, *x) for i, x in enumerate(x for own in lines.values() for x in own)]
    last = {r["nex_codigo"]: (r["nome"], r["_pos"]) for r in dedup_last(normalize(read_table(spark, str(folder)), FIRST)).collect()}
    assert (last["1"], last["2"], last["neu"]) == (("b1 again", 1), ("c2", 2), ("cn", 304))


def test_a_batch_of_three_files_is_in_their_order(spark, tmp_path):
    from saldus.streaming.feed import sync_stream

    folder = tmp_path / "arrivals"
    folder.mkdir()
    for name, rows in (("b", [("1", "B", 20), ("2", "B", 20)]), ("a", [("1", "A", 10), ("3", "A", 10)] * 200), ("c", [("2", "C", 30)])):
        (folder / f"{name}.csv").write_text("Código,Nome,Débito / Crédito\n" + "".join(f'{c},{n},"Débito- R$ {v},00"\n' for c, n, v in rows))
    raw = spark.readStream.schema("`Código` string, `Nome` string, `Débito / Crédito` string").option("header", "true").csv(str(folder))
    repo = MemoryRepository(spark)
    sync_stream(raw, repo, lambda n: FIRST, f"{tmp_path}/checkpoint").awaitTermination()
    assert [(r["nex_codigo"], r["nome"], r["saldo_debito_nex"]) for r in repo.find_all().orderBy("_ord").collect()] == [("1", "B", 20), ("3", "A", 10), ("2", "C", 30)]


def test_details_of_codes(spark, tmp_path):
    """The last row of a code decides, a third of all rows have none, and one code has another third; where no code repeats, the table is scanned once."""
    def shown(rows):
        path = f"{tmp_path}/{len(rows)}"
        export(spark, rows).write.parquet(path)
        return flows.analyze(spark.read.parquet(path), FIRST)

    def plain(rows):
        status = [("invalido" if not (r[0] or "").strip() or not r[1].strip() else "valido_com_aviso" if r[2] else "valido") for r in rows]
        last, first = {}, {}
        for i, r in enumerate(rows):
            key = (r[0] or "").strip() and r[0] or "null"
            last[key] = status[i]
            first.setdefault(key, r[1].strip())
        keys = [(r[0] or "").strip() and r[0] or "null" for r in rows]
        return [last[k] for k in keys], [(i, first[k]) for i, k in enumerate(keys) if status[i] == "valido_com_aviso"]

    some = [(None if i % 3 == 0 else "hot" if i % 3 == 1 else str(i), f"N{i}" if i % 7 else " ", "Débito- R$ 9,00" if i % 2 else "") for i in range(90)] + [("null", "text", ""), (" ", "blank", "")]
    done = shown(some)
    status, warned = plain(some)
    assert [r["validacao_status"] for r in done.registros.orderBy("_ord").collect()] == status
    assert [(r["_ord"], r["nome"]) for r in done.registros_com_aviso.orderBy("_ord").collect()] == warned
    alone = [(str(i), f"N{i}", "") for i in range(50)]
    once = shown(alone)
    for df in (once.registros, once.registros_com_aviso):
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r["validacao_status"] for r in once.registros.collect()} == {"valido"}


def test_an_analysis_that_is_stored(spark, tmp_path):
    """The report counted by the job that writes the records is that of its own aggregation."""
    rows = [("1", "Um", "Débito- R$ 100,00", "11", "2x 50,00 dia 10"), ("2", "Dois", "Crédito- R$ 5,00"), ("2", "", "Débito- R$ 1,50"), (None, "Sem", ""), ("3", "T", "Débito- R$ 7,00", "")]
    raw = export(spark, rows)
    stored, lazy = flows.analyze_into(raw, FIRST, f"{tmp_path}/records"), flows.analyze(raw, FIRST)
    assert stored.relatorio.first() == lazy.relatorio.first()
    for name in ("registros", "registros_com_aviso"):
        one, two = (getattr(x, name).orderBy("_ord").collect() for x in (stored, lazy))
        assert [r.asDict(True) for r in one] == [r.asDict(True) for r in two]


def test_plan_text_as_files(spark, tmp_path):
    from saldus.operators.plan import write_plan_text

    plan = build_plan(debts(spark, FIRST, **{f"c{i}": i for i in range(40)}), debts(spark, NEXT, **{f"c{i}": 2 * i for i in range(20, 60)}))
    write_plan_text(plan, f"{tmp_path}/text")
    parts = sorted((tmp_path / "text").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == format_plan(plan) + "\n"


def test_what_can_be_confirmed():
    assert flows.can_confirm({"validos": 1, "validos_com_aviso": 0}) and flows.can_confirm({"validos_com_aviso": 2})
    assert not any(map(flows.can_confirm, (None, {}, {"validos": 0, "validos_com_aviso": None}, {"invalidos": 5})))


def test_files_are_synced_as_they_arrive(spark, tmp_path):
    from saldus.streaming.feed import sync_stream

    repo, folder = ParquetRepository(spark, f"{tmp_path}/base"), f"{tmp_path}/arrivals"

    def arrive(rows):
        export(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        raw = spark.readStream.schema(export(spark, []).schema).parquet(folder)
        query = sync_stream(raw, repo, lambda n: (FIRST, NEXT)[min(n, 1)], f"{tmp_path}/checkpoint")
        query.awaitTermination()
        return {r["nex_codigo"]: (r["saldo_debito_nex"], [e["tipo"] for e in r["historico"]]) for r in repo.find_all().collect()}

    assert arrive([("1", "A", "Débito- R$ 10,00"), ("2", "B", "Débito- R$ 20,00")]) == {"1": (10, ["cliente_importado"]), "2": (20, ["cliente_importado"])}
    assert arrive([("1", "A", "Débito- R$ 30,00"), ("2", "B", ""), ("3", "C", "Débito- R$ 5,00")]) == {"1": (30, ["cliente_importado", "cliente_atualizado"]), "2": (0, ["cliente_importado", "divida_quitada"]), "3": (5, ["cliente_importado"])}
    seen = repo.version()
    assert arrive([]) and repo.version() == seen  # a file without rows is no snapshot


def test_no_task_makes_the_records_of_a_whole_row_group(spark, monkeypatch):
    """Wide records are sorted by task before they are sent, so what one task makes may not grow with the input's row groups."""
    monkeypatch.setattr(customer_export, "DEALT", 100, raising=False)
    k = F.col("id").alias("c_custkey")
    customer = spark.range(0, 2000, 1, 1).select(k, F.concat(F.lit("Customer#"), "id").alias("c_name"), F.lit("10-100-100-1000").alias("c_phone"), F.lit(12.5).alias("c_acctbal"), F.lit(3).alias("c_nationkey"), F.lit("BUILDING").alias("c_mktsegment"))
    earlier, later = customer_export.snapshots(customer)
    assert (earlier.count(), later.count()) == (1800, 1800 + 40)
    for side, context in ((earlier, FIRST), (later, NEXT)):
        made = normalize(side, context).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert made <= 200
    plan = build_plan(*(flows.eligible(normalize(side, context)) for side, context in ((earlier, FIRST), (later, NEXT))))
    assert plan.count() == plan.select("nex_codigo").distinct().count() > 1000
    # An empty table has no rows on either side.
    assert [side.count() for side in customer_export.snapshots(customer.where("false"))] == [0, 0]
