"""The store of records: what a save writes, what a look-up opens, and what several writers and readers see."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from saldus.context import Context, plain_id
from saldus.operators.apply import apply_plan
from saldus.operators.normalize import normalize
from saldus.operators.plan import build_plan, plan_summary
from saldus.plans import flows
from saldus.schema import SCHEMA
from saldus.sources import repository as store
from saldus.sources.repository import MemoryRepository, ParquetRepository, StaleBase, Tickets
from saldus.sources.storage import Storage

FIRST = Context(file="a.xls", snapshot="2024-01-31", executed="T1", new_id=plain_id)
ROOT = Path(__file__).resolve().parents[1]


def records(spark, balances, context=FIRST):
    """Records of (code, balance), in this order."""
    raw = spark.createDataFrame([(i, str(k), f"Cliente {k}", f"Débito- R$ {v},00" if v else "") for i, (k, v) in enumerate(balances)], "_ord long, `Código` string, `Nome` string, `Débito / Crédito` string")
    return normalize(raw, context)


def many(spark, n, balance=10):
    raw = spark.range(n).select(F.col("id").alias("_ord"), F.col("id").cast("string").alias("Código"), F.concat(F.lit("Cliente "), "id").alias("Nome"), F.lit(f"Débito- R$ {balance},00").alias("Débito / Crédito"))
    return normalize(raw, FIRST)


def files(repository, kind):
    return {str(p) for p in Path(repository.path.removeprefix("file:")).glob(f"{kind}/*/*/*.parquet")}


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_a_save_rewrites_the_buckets_that_it_touches(spark, tmp_path):
    repo = ParquetRepository(spark, f"{tmp_path}/base", buckets=64)
    repo.save_batch(many(spark, 20_000))
    before = files(repo, "data")
    assert len(before) == 64 and repo.find_all(history=False).count() == 20_000
    codes = [(i * 1000, 99) for i in range(9)] + [("novo", 5), ("novo", 7)]
    repo.save_batch(records(spark, codes))
    written = files(repo, "data") - before
    assert 1 <= len(written) <= 10
    assert not list(Path(tmp_path).glob("base/aside/*"))
    batch = records(spark, codes).withColumn("bucket", repo.bucket_of(F.col("nex_codigo")))
    assert exchanges(repo._merged(repo.manifest(), [1, 2, 3], batch, 3, True)) == 1
    assert repo.find_all(history=False).where("saldo_debito_nex = 99").count() == 9 and repo.find_all(history=False).count() == 20_001
    assert repo.find_by_code("novo")["saldo_debito_nex"] == 7
    places = [r["nex_codigo"] for r in repo.find_all(history=False).orderBy("_ord").select("nex_codigo").collect()]
    assert places == [*map(str, range(20_000)), "novo"]
    # A version is one small file, however many records there are.
    assert [len(json.loads(Path(tmp_path, f"base/versions/{n:012d}").read_text())["data"]) for n in (1, 2)] == [64, 64]


def test_a_look_up_opens_one_bucket(spark, tmp_path):
    repo = ParquetRepository(spark, f"{tmp_path}/base", buckets=16)
    repo.save_batch(many(spark, 2000))
    found = repo.lookup(1234)
    inputs = {Path(f).parent.name for f in found.inputFiles() if "/data/" in f}
    assert len(inputs) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(nex_codigo,1234)" in plan
    row = repo.find_by_code(1234)
    assert row["nome"] == "Cliente 1234" and repo.find_by_code("no such") is None and set(row.asDict()) == {*SCHEMA.names, "_ord"}


def test_history_is_a_log(spark, tmp_path, monkeypatch):
    """Syncs leave a record's row as it is in size; the log has their events in order, also after its files were merged, and a whole save sets a history anew."""
    monkeypatch.setattr(store, "MERGE_LOGS", 2)
    repo, plain = ParquetRepository(spark, f"{tmp_path}/base", buckets=2), MemoryRepository(spark)
    for i in range(1, 5):
        context = Context(file="a.xls", snapshot="2024-01-31", executed=f"T{i}", new_id=plain_id)
        new = records(spark, [("1", 10 * i), ("2", 5), ("3", 7 if i < 3 else 0)], context)
        events = apply_plan(build_plan(repo.find_all(), new), context).eventos.drop("_ord")
        want = {json.dumps(r.asDict(), sort_keys=True) for r in events.collect()}
        done = [flows.sync(r, new, context) for r in (repo, plain)]
        assert done[0].resumo_plano == done[1].resumo_plano and done[0].resumo_execucao == done[1].resumo_execucao
        own = repo.events().where(F.col("version") == i).drop("version", "place")
        assert {json.dumps(r.asDict(), sort_keys=True) for r in own.collect()} == want
    shown = lambda r: {x["nex_codigo"]: (x["saldo_debito_nex"], x["status_cobranca"], [(e["tipo"], e["data"]) for e in x["historico"]]) for x in r.find_all().collect()}
    assert shown(repo) == shown(plain)
    assert len(shown(repo)["1"][2]) == 4 and len(shown(repo)["2"][2]) == 1 and shown(repo)["3"][2] == [("cliente_importado", "T1"), ("divida_quitada", "T3")]
    assert all("historico" not in spark.read.parquet(f).columns for f in files(repo, "data"))
    assert max(len(runs) for runs in repo.manifest()["log"].values()) <= 2
    bare = repo.find_all().where("nex_codigo = '1'").withColumn("historico", F.slice("historico", 1, 1))
    gone = repo.find_all().where("nex_codigo = '2'").withColumn("historico", F.lit(None).cast(SCHEMA["historico"].dataType))
    repo.save_batch(bare.unionByName(gone))
    assert [e["data"] for e in repo.find_by_code(1)["historico"]] == ["T1"] and repo.find_by_code(2)["historico"] is None
    flows.sync(repo, records(spark, [("1", 1), ("2", 1)]), FIRST)
    assert [e["tipo"] for e in repo.find_by_code(1)["historico"]] == ["cliente_importado", "cliente_atualizado"] and len(repo.find_by_code(2)["historico"]) == 1


def test_summaries_are_those_of_their_own_queries(spark, tmp_path):
    repo = ParquetRepository(spark, f"{tmp_path}/base", buckets=4)
    empty = flows.sync(repo, records(spark, []), FIRST)
    assert set(empty.resumo_plano.values()) <= {0} and repo.find_all().isEmpty()
    assert flows.import_payload(repo, b'{"registros": []}', FIRST).resumo_execucao == dict.fromkeys(("criados", "atualizados", "quitados", "sem_alteracao", "nao_aplicados", "total_eventos", "total_processado"), 0)
    flows.sync(repo, records(spark, [(i, i) for i in range(1, 30)]), FIRST)
    new = flows.eligible(records(spark, [(i, i % 3 * i) for i in range(5, 40)] + [(7, 3)]))
    base = repo.find_all()
    want, run = plan_summary(base, new), apply_plan(build_plan(base, new), FIRST).resumo
    assert want.first().asDict()["total_nova_importacao"] == 36 and want._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 2
    want, run = want.first().asDict(), run.first().asDict()
    done = flows.sync(repo, new, FIRST)
    assert (done.resumo_plano, done.resumo_execucao) == (want, run)
    without = base.limit(3).withColumn("nex_codigo", F.lit(None).cast("string"))
    counted = plan_summary(base.unionByName(without), new.unionByName(without.select(new.columns))).first().asDict()
    assert counted == want | {"registros_sem_identificador_ignorados": 6, "total_base": 32, "total_nova_importacao": 39}


def test_readers_and_expiry(spark, tmp_path):
    repo = ParquetRepository(spark, f"{tmp_path}/base", buckets=2)
    for i in range(1, 5):
        repo.save_batch(records(spark, [("1", i), (f"n{i}", i)]))
        if i == 2:
            pinned = repo.snapshot()
            seen = pinned.__enter__()
            held = seen.find_all()
    assert repo.expire(keep=1, hours=24) == 2  # the pinned version and the newest stay
    assert [int(x) for x in repo.storage.names("versions")] == [2, 4]
    repo.expire(keep=1, hours=-1)
    assert sorted(r["nex_codigo"] for r in held.collect()) == ["1", "n1", "n2"] and seen.find_by_code(1)["saldo_debito_nex"] == 2
    assert repo.find_by_code(1)["saldo_debito_nex"] == 4 and repo.find_all().count() == 5
    with pytest.raises(LookupError):
        repo.find_all(version=3)
    pinned.__exit__(None, None, None)
    assert repo.expire(keep=1, hours=-1) == 1 and not repo.storage.names("pins")
    used = {f"run={run}" for run in repo.manifest()["data"].values()}
    assert {Path(f).parents[1].name for f in files(repo, "data")} == used and repo.find_all().count() == 5


def test_a_pin_that_comes_late_finds_another_version(spark, tmp_path, monkeypatch):
    """A version whose name goes between a reader's look and its pin isn't given to it."""
    repo = ParquetRepository(spark, f"{tmp_path}/base", buckets=2)
    repo.save_batch(records(spark, [("1", 1)]))
    repo.save_batch(records(spark, [("1", 2)]))
    seen = iter([1, 2])
    monkeypatch.setattr(repo, "version", lambda: next(seen))
    repo.storage.rename(f"versions/{1:012d}", f"versions/expiring-{1:012d}")
    with repo.snapshot() as s:
        assert s.version == 2 and s.find_by_code(1)["saldo_debito_nex"] == 2


def test_two_writers(spark, tmp_path, monkeypatch):
    one, two = (ParquetRepository(spark, f"{tmp_path}/base", buckets=2) for _ in range(2))
    one.save_batch(records(spark, [("1", 1)]))
    read = one.version()
    two.save_batch(records(spark, [("2", 2)]))
    with pytest.raises(StaleBase):
        one.save_batch(records(spark, [("1", 5)]), read)
    # A writer that saves between our look at the version and our commit is met by the create, which one of the two gets.
    append = one._append

    def late(*a):
        two.save_batch(records(spark, [("3", 3)]))
        return append(*a)

    monkeypatch.setattr(one, "_append", late)
    with pytest.raises(StaleBase):
        one.save_batch(records(spark, [("1", 6)]))
    monkeypatch.setattr(one, "_append", append)
    assert {r["nex_codigo"]: r["saldo_debito_nex"] for r in one.find_all().collect()} == {"1": 1, "2": 2, "3": 3}
    # A sync that met such a writer plans again.
    calls = []
    save = one.save_changes

    def stale_once(rows, read):
        calls.append(read)
        if len(calls) == 1:
            two.save_batch(records(spark, [("4", 4)]))
        save(rows, read)

    monkeypatch.setattr(one, "save_changes", stale_once)
    assert flows.sync(one, records(spark, [("1", 7)]), FIRST).resumo_plano["total_base"] == 4 and len(calls) == 2


def test_places_beyond_a_version(spark, tmp_path):
    """Rows of another repository have places too large to stand beside a version: they are numbered anew, in the same order."""
    one, two = ParquetRepository(spark, f"{tmp_path}/one", buckets=2), ParquetRepository(spark, f"{tmp_path}/two", buckets=3)
    for codes in ("cb", "da"):
        one.save_batch(records(spark, [(c, 1) for c in codes]))
    two.save_batch(one.find_all())
    assert ["".join(r["nex_codigo"] for r in repo.find_all().orderBy("_ord").collect()) for repo in (one, two)] == ["cbda", "cbda"]


def test_one_create_wins(spark, tmp_path):
    storage = Storage(spark, f"file://{tmp_path}/x y")
    assert storage.create("a/1", "text é") and not storage.create("a/1", "other") and storage.read("a/1") == "text é"
    assert storage.read("a/2") is None and storage.names("none") == [] and storage.names("a") == ["1"]


def test_tickets(spark, tmp_path):
    storage = Storage(spark, str(tmp_path))
    (tmp_path / "tickets").mkdir()
    dead = tmp_path / "tickets" / f"{4:012d}"
    dead.write_text("")
    os.utime(dead, (time.time() - 100,) * 2)
    with Tickets(storage, lease=5) as mine:  # a holder that died doesn't keep others waiting
        assert storage.names("tickets") == [f"{5:012d}"] and mine._own.endswith("5")
    assert storage.names("tickets") == []
    with pytest.raises(RuntimeError), Tickets(storage):
        raise RuntimeError
    assert storage.names("tickets") == []


WORKER = """
import sys, time
sys.path[:0] = [{root!r}, {tests!r}]
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
from test_repository import FIRST, records
from saldus.plans import flows
from saldus.sources.repository import ParquetRepository
repo = ParquetRepository(spark, {path!r}, buckets=2)
repo.version()
print("ready", flush=True)
sys.stdin.readline()
done = flows.sync(repo, records(spark, [("1", {balance}), ("own{balance}", 1)]), FIRST)
print(repo.version(), done.resumo_execucao["criados"], flush=True)
"""


def test_syncs_of_two_processes_go_in_order(spark, tmp_path):
    """Both succeed, and the one that asked first is first, though both were ready."""
    path = f"{tmp_path}/base"
    env = os.environ | {"PYTHONPATH": str(ROOT)}
    code = [WORKER.format(root=str(ROOT), tests=str(ROOT / "tests"), path=path, balance=b) for b in (10, 20)]
    workers = [subprocess.Popen([sys.executable, "-c", c], env=env, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True) for c in code]
    try:
        assert [w.stdout.readline().strip() for w in workers] == ["ready", "ready"]
        repo = ParquetRepository(spark, path, buckets=2)
        with repo.lock:  # both wait for us, in the order of their tickets
            for k, w in enumerate(workers, 2):
                w.stdin.write("\\n")
                w.stdin.flush()
                until = time.time() + 60
                while len(repo.storage.names("tickets")) < k and time.time() < until:
                    time.sleep(0.05)
            assert repo.version() == 0
        said = [w.communicate(timeout=120)[0].split() for w in workers]
    finally:
        for w in workers:
            if w.poll() is None:
                w.terminate()
    assert said == [["1", "2"], ["2", "1"]]
    assert {r["nex_codigo"]: r["saldo_debito_nex"] for r in repo.find_all().collect()} == {"1": 20, "own10": 1, "own20": 1}
