"""Two rounds with toy providers, readers on small files, and the stream of results."""

import bz2
import io
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from leadmill.jobs import registry, screening
from leadmill.operators import surrogate
from leadmill.schema import PropertyLimits, Range, Settings
from leadmill.sources import readers, writers
from leadmill.store import Campaign, scratch, shared_dir, spool
from leadmill.streaming import results


def prepare(rows):
    """A molecule is its number: the hash forgets the last digit of `m<number>`; m-1 is unreadable."""
    number = F.regexp_extract("k", r"(\d+)", 1).cast("long")
    ready = rows.filter("k <> 'bad'").withColumn("reghash", F.concat(F.lit("h"), F.floor(number / 2).cast("string")))
    return ready.withColumn("vector", F.array((number % 17).cast("double"), (number % 5).cast("double")))


def search(queries):
    number = F.regexp_extract("smiles", r"(\d+)", 1).cast("long")
    near = queries.select(F.explode(F.array(*(number * 3 + d for d in range(4)))).alias("n"), F.col("compound_id").alias("q"))
    k = F.concat(F.lit("m"), F.col("n").cast("string"))
    both = near.select(F.lit("fp").alias("method"), k.alias("k"), k.alias("title"), F.lit(0.6).alias("sim")).unionByName(near.select(F.lit("pharm").alias("method"), k.alias("k"), k.alias("title"), (0.8 + F.col("n") % 3 / 10).alias("sim")))
    return both.unionByName(near.select(F.lit("fp").alias("method"), F.lit("bad").alias("k"), F.lit("bad").alias("title"), F.lit(0.9).alias("sim")))


def score(picked):
    value = -(F.element_at("vector", 1) * 0.5) - F.element_at("vector", 2)
    two = picked.select(F.col("compound_id").alias("title"), F.explode(F.array(value, value + 1)).alias("score"), "compound_id")
    return two.filter("compound_id % 5 <> 0").drop("compound_id")  # some fail


def test_two_rounds(spark, tmp_path):
    campaign = Campaign(spark, f"file://{tmp_path}/job")
    seeds = spark.createDataFrame([(f"m{i}", f"seed {i}", float(-(i % 7))) for i in range(30)] + [("bad", "x", 0.0)], "smiles string, title string, score double")
    state = screening.import_seeds(campaign, seeds, prepare, docked=True)
    assert state.count() == 30 and state.filter("dock_iteration = 0").count() == 30
    with pytest.raises(FileExistsError):
        screening.import_seeds(campaign, seeds, prepare, docked=True)
    settings = Settings(queries_per_cycle=6, docked_per_round=8)
    model = None
    for _ in range(2):
        model = screening.screening_round(campaign, search, prepare, score, settings, model)
    state, counters = campaign.read("compounds").cache(), campaign.counters()
    assert counters == {"cycle": 6, "iteration": 2, "models": 2}
    assert state.count() == state.select("compound_id").distinct().count() == state.agg(F.max("compound_id")).first()[0]
    found = state.filter("simsearch_cycle is not null")
    assert found.count() > 0 and found.count() == found.select("reghash").distinct().count()
    assert found.join(state.filter("simsearch_cycle is null"), "reghash", "left_semi").count() == 0
    assert found.filter("sim_pharm < 0.9").count() == 0 and found.filter("pred_score is null").count() == 0
    assert state.filter("dock_iteration is not null and dock_iteration not between 0 and 2").count() == 0
    assert 0 < state.filter("dock_iteration = 2").count() <= 8
    assert screening.repredict(campaign, model).filter("dock_score is null and pred_version <> 2").count() == 0
    campaign.clean()
    assert len(campaign.versions("compounds")) == 1
    campaign.archive(f"file://{tmp_path}/kept/job")
    assert Campaign(spark, f"file://{tmp_path}/kept/job").read("compounds").count() == state.count()


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "docked.csv").write_text("SMILES,title,r_i_docking_score,more\nCCO,\"a,b\",-1.5,x\nCCN,c,,y\n")
    rows = readers.docked_seeds(spark, f"file://{tmp_path}/docked.csv").collect()
    assert rows[0].title == "a,b" and rows[0].score == -1.5 and rows[1].score != rows[1].score
    (tmp_path / "s.smi").write_text("CCO 1\nCCN 2\n")
    assert readers.undocked_seeds(spark, f"file://{tmp_path}/s.smi").filter("score is null").count() == 2
    (tmp_path / "c.tsv").write_text("smiles\tidnumber\tType\nCC\t7\tx\n")
    assert tuple(readers.collection(spark, f"file://{tmp_path}/c.tsv", "smiles", "idnumber").first()) == ("CC", "7")
    (tmp_path / "c.tsv.bz2").write_bytes(bz2.compress(b"SMILES\tID\tMW\nCC\t7\t1\nCO\t8\t2\n"))
    assert sorted(map(tuple, readers.collection(spark, f"file://{tmp_path}/c.tsv.bz2", "SMILES", "ID").collect())) == [("CC", "7"), ("CO", "8")]
    (tmp_path / "grid.zip").write_bytes(b"\x00grid")
    assert tuple(readers.blob(spark, f"file://{tmp_path}/grid.zip").first()) == ("grid.zip", b"\x00grid")
    (tmp_path / "h.csv").write_text("#result-smiles,result-name,fingerprint-similarity\nCC,n,0.7\n")
    assert tuple(readers.hits(spark, f"file://{tmp_path}/h.csv", "fp").first()) == ("fp", "CC", "n", 0.7)
    folder = tmp_path / "results"
    folder.mkdir()
    table = "title,r_i_docking_score\n1,-3.0\n1,\n"
    (folder / "glide_1.csv").write_text(table)
    (folder / "glide_1_skip.csv").write_text(table)
    (folder / "other.csv").write_text(table)
    assert readers.docking_results(spark, f"file://{folder}").count() == 2
    with tarfile.open(folder / "r.tar.gz", "w:gz") as tar:
        for name in ("x/glide_1.csv", "x/glide_1_skip.csv"):
            info = tarfile.TarInfo(name)
            info.size = len(table)
            tar.addfile(info, io.BytesIO(table.encode()))
    assert readers.packed_results(spark, f"file://{folder}").count() == 2
    writers.export_csv(spark.createDataFrame([(1, None)], "a int, b string"), f"file://{tmp_path}/out")
    assert "1,None" in "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    with pytest.raises(ValueError):
        readers.docked_seeds(spark, f"file://{tmp_path}/h.csv")


def test_results_stream_equals_the_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    args = (f"file://{tmp_path}/out", f"file://{tmp_path}/check")
    for n in range(2):
        (folder / f"glide_{n}.csv").write_text(f"title,r_i_docking_score\n1,{-n}.5\n2,NaN\n")
        (folder / f"glide_{n}_skip.csv").write_text("title,r_i_docking_score\n1,-99\n")
        results.collect_into(results.arriving(spark, f"file://{folder}"), *args).awaitTermination()
    got = spark.read.parquet(args[0]).groupBy("title").agg(F.min("r_i_docking_score").alias("s")).collect()
    assert {r.title: r.s for r in got} == {1: -1.5, 2: None}


def numbered(spark, n=30):
    return spark.createDataFrame([(f"m{i}", f"seed {i}", float(-(i % 7))) for i in range(n)], "smiles string, title string, score double")


def test_import_gives_the_same_ids_again_and_clusters(spark, tmp_path):
    seeds = numbered(spark).unionByName(numbered(spark, 5))
    one, two = (Campaign(spark, f"file://{tmp_path}/{n}") for n in "ab")
    a = screening.import_seeds(one, seeds, prepare, docked=True)
    b = screening.import_seeds(two, seeds.repartition(7), prepare, docked=True)
    columns = ["compound_id", "reghash", "smiles", "smilesid", "dock_score"]
    assert sorted(map(tuple, a.select(columns).collect())) == sorted(map(tuple, b.select(columns).collect()))
    clusters = one.read("clusters")
    assert clusters.count() == clusters.select("compound_id").distinct().count() == 35


def test_seed_docking_is_iteration_zero(spark, tmp_path):
    campaign = Campaign(spark, f"file://{tmp_path}/job")
    screening.import_seeds(campaign, numbered(spark).withColumn("score", F.lit(None).cast("double")), prepare, docked=False)
    before = campaign.read("compounds")
    assert before.filter("dock_score is not null or dock_iteration is not null").isEmpty()
    assert screening.dock(campaign, lambda rows: score(rows).limit(0), Settings(), seeds=True).count() == 30
    assert campaign.counters()["iteration"] == 0 and len(campaign.versions("compounds")) == 1
    after = screening.dock(campaign, score, Settings(dock_chunk=7), seeds=True)
    assert after.filter("dock_iteration = 0 and dock_score is not null").count() == after.filter("compound_id % 5 <> 0").count()
    assert after.filter("dock_iteration is null").count() == after.filter("compound_id % 5 = 0").count()
    assert campaign.counters()["iteration"] == 0
    screening.dock(campaign, lambda rows: score(rows).limit(0), Settings())
    assert campaign.counters()["iteration"] == 0


def test_property_ranges_and_hits_per_query(spark, tmp_path):
    heavy = lambda rows: prepare(rows).withColumn("mw", F.regexp_extract("k", r"(\d+)", 1).cast("double"))
    asked = []

    def limited(queries):
        number = F.regexp_extract("smiles", r"(\d+)", 1).cast("long")
        asked.append({r.compound_id: r.smiles for r in queries.collect()})
        near = queries.select(F.col("compound_id").alias("query"), F.explode(F.array(*(number * 3 + 100 + d for d in range(4)))).alias("n"))
        k = F.concat(F.lit("m"), F.col("n").cast("string"))
        return near.select(F.lit("fp").alias("method"), "query", k.alias("k"), k.alias("title"), (0.5 + F.col("n") % 4 / 10).alias("sim"))

    campaign = Campaign(spark, f"file://{tmp_path}/job")
    screening.import_seeds(campaign, numbered(spark), heavy, docked=True)
    screening.set_limits(campaign, PropertyLimits(mw=Range(0, 999)))
    screening.set_limits(campaign, PropertyLimits(mw=Range(0, 140)))
    settings = Settings(queries_per_cycle=5, hits_per_query=2)
    assert screening.limits_of(campaign, settings).mw == Range(0, 140)
    model = screening.train_model(campaign, settings)
    state = screening.search_cycle(campaign, limited, heavy, model, False, settings)
    known = {r.reghash for r in state.filter("simsearch_cycle is null").collect()}
    want = {}
    for smiles in asked[0].values():
        n = [int(smiles[1:]) * 3 + 100 + d for d in range(4)]
        for x in sorted(n, key=lambda x: (-(x % 4), f"m{x}"))[:2]:
            if x <= 140 and f"h{x // 2}" not in known:
                want.setdefault(f"h{x // 2}", []).append(f"m{x}")
    assert {r.reghash: r.smiles for r in state.filter("simsearch_cycle = 1").collect()} == {h: min(k) for h, k in want.items()}
    assert campaign.read("clusters").count() == state.count()


@pytest.mark.parametrize("acquisition", ["greedy", "clustering"])
def test_acquisition_switch(spark, tmp_path, acquisition):
    campaign = Campaign(spark, f"file://{tmp_path}/job")
    settings = Settings(queries_per_cycle=3, docked_per_round=2, acquisition=acquisition)
    screening.import_seeds(campaign, numbered(spark), prepare, docked=True, settings=settings)
    rows = campaign.read("compounds").orderBy("dock_score", "compound_id").collect()
    of = {r.compound_id: r.cluster_id for r in campaign.read("clusters").collect()}
    want, used = [], set()
    for r in rows:
        if acquisition == "greedy" or of[r.compound_id] not in used:
            want.append(r.compound_id)
            used.add(of[r.compound_id])
    model = screening.train_model(campaign, settings)
    state = screening.search_cycle(campaign, search, prepare, model, False, settings)
    assert {r.compound_id for r in state.filter("query_cycle = 1").collect()} == set(want[:3])
    with pytest.raises(ValueError):
        screening.acquisition_clusters(campaign, Settings(acquisition="chance"))


def test_a_restart_predicts_with_the_stored_model(spark, tmp_path):
    campaign = Campaign(spark, f"file://{tmp_path}/job")
    screening.import_seeds(campaign, numbered(spark), prepare, docked=True)
    with pytest.raises(LookupError):
        screening.load_model(campaign)
    model = screening.train_model(campaign, Settings())
    predicted = lambda m, c=campaign: sorted((r.compound_id, r.pred_score) for r in surrogate.predict(m, c.read("compounds"), "vector", 1).collect())
    want = predicted(model)
    del model
    campaign.archive(f"file://{tmp_path}/kept/job")
    with pytest.raises(FileNotFoundError):
        Campaign.restore(spark, f"file://{tmp_path}/job", f"file://{tmp_path}/x")
    again = Campaign.restore(spark, f"file://{tmp_path}/kept/job", f"file://{tmp_path}/moved")
    assert predicted(screening.load_model(again), again) == want == predicted(screening.load_model(again, 1), again)
    assert [(r.model_version, r.deviation > 0) for r in again.read("models").collect()] == [(1, True)]


def test_seeds_and_results_as_files(spark, tmp_path):
    rows = spark.createDataFrame([(f"C{i}", f"t {i}") for i in range(50)], "smiles string, title string")
    screening.pick_seeds(rows, f"file://{tmp_path}/seeds", Settings(seeds=20))
    lines = spark.read.text(f"file://{tmp_path}/seeds")
    assert lines.count() == lines.distinct().count() == 20 and lines.filter(~F.col("value").rlike(r"^C\d+ t \d+$")).isEmpty()
    campaign = Campaign(spark, f"file://{tmp_path}/job")
    screening.import_seeds(campaign, numbered(spark), prepare, docked=True)
    screening.export_results(campaign, f"file://{tmp_path}/out", Settings(export_cutoff=-6.0))
    got = "".join(sorted(p.read_text() for p in (tmp_path / "out").glob("part-*"))).splitlines()
    assert got[0] == "smiles,smilesid,dock_score,pred_score,sim_fp,sim_pharm,dock_iteration,cluster_id"
    assert len(got) == 5 and got[1].startswith("m") and got[1].split(",")[1].startswith("seed ") and got[1].split(",")[2:7] == ["-6.0", "None", "None", "None", "0"]


def test_round_over_vectors(spark, data):
    campaign = registry.campaign_of(spark, data, registry.ROUND)
    state, counters = campaign.read("compounds").cache(), campaign.counters()
    assert counters == {"cycle": 3, "iteration": 1, "models": 1}
    seeds = state.filter("simsearch_cycle is null")
    assert seeds.filter("dock_iteration <> 0 or dock_score is null").isEmpty()
    assert [r[0] for r in state.filter("query_cycle is not null").groupBy("query_cycle").count().orderBy("query_cycle").select("query_cycle").collect()][0] == 1
    assert state.filter("query_cycle is not null").groupBy("query_cycle").count().filter("count > 20").isEmpty()
    found = state.filter("simsearch_cycle is not null")
    assert not found.isEmpty() and found.filter("pred_score is null").isEmpty()
    assert found.groupBy("reghash").count().filter("count > 1").isEmpty() and found.join(seeds, "reghash", "left_semi").isEmpty()
    assert found.filter("(sim_fp is null and sim_pharm is null) or sim_fp < 0.5 or sim_pharm < 0.6").isEmpty()
    assert found.filter("300 + 800 * vector[0] not between 0 and 500 or 70 + 200 * vector[1] not between 0 and 140").isEmpty()
    docked = state.filter("dock_iteration = 1").join(campaign.read("clusters"), "compound_id")
    assert 0 < docked.count() <= 50 and docked.groupBy("cluster_id").count().filter("count > 1").isEmpty()


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    class Session:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})()
        sparkContext = type("S", (), {"master": "spark://host:7077", "getConf": staticmethod(lambda: Session.conf)})()

    with pytest.raises(ValueError):
        shared_dir(Session)


def test_campaign_of_smiles(spark, tmp_path):
    campaign = Campaign(spark, f"file://{tmp_path}/job")
    rows = [("C" * n + tail, f"{n}{tail}", float(-n)) for n in range(1, 9) for tail in ("O", "N", "C(=O)O")] + [("C(", "bad", 0.0), ("OCC", "again", -1.0)]
    seeds = spark.createDataFrame(rows, "smiles string, title string, score double")
    state = screening.import_seeds(campaign, seeds, screening.prepare_smiles, docked=True)
    assert state.count() == 25 and state.select("reghash").distinct().count() == 24

    def longer(queries):
        k = F.concat(F.lit("CCCC"), "smiles")
        return queries.select(F.lit("fp").alias("method"), F.col("compound_id").alias("query"), k.alias("k"), k.alias("title"), F.lit(0.7).alias("sim"))

    settings = Settings(queries_per_cycle=25, limits=PropertyLimits(mw=Range(0, 150)))
    model = screening.train_model(campaign, settings)
    found = screening.search_cycle(campaign, longer, screening.prepare_smiles, model, False, settings).filter("simsearch_cycle = 1").collect()
    assert {r.smiles for r in found} == {"CCCC" + "C" * n + tail for n, tail in ((5, "O"), (5, "N"))} | {"CCCCOCC"}  # 6 to 8 carbons are known, more are too heavy


def test_scratch_goes_at_its_end(spark):
    with scratch(spark):
        inner = spool(spark.range(3), "x")
        assert inner.count() == 3
        files = inner.inputFiles()
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
