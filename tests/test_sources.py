"""Archives as streams, early stops, table functions as providers, streamed results, the command line."""

import io
import os
import sys
import tarfile
import types

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import LessThanOrEqual

from leadmill import __main__ as command
from leadmill.jobs import providers, screening
from leadmill.operators import merge
from leadmill.schema import Settings
from leadmill.sources import archives, readers, writers
from leadmill.store import Campaign
from leadmill.streaming import results

from .test_screening import numbered, prepare, score, search

HEAD = "title,r_i_docking_score\n"


def member(tar, name, text):
    info = tarfile.TarInfo(name)
    info.size = len(text)
    tar.addfile(info, io.BytesIO(text.encode()))


def test_archives_equal_their_rows(spark, tmp_path):
    rows = spark.range(500).selectExpr("id title", "case when id % 50 <> 0 then -cast(id * 37 % 101 as double) end score")
    archives.pack(rows, f"file://{tmp_path}/packed", 7)
    assert len(os.listdir(tmp_path / "packed")) == 7
    got = archives.results(spark, f"file://{tmp_path}/packed")
    assert sorted(map(tuple, got.select("title", "score").collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    best = archives.results(spark, f"file://{tmp_path}/packed", in_order=True).filter("score <= -90")
    assert sorted(r.title for r in best.collect()) == sorted(r.title for r in rows.filter("score <= -90").collect())
    with tarfile.open(tmp_path / "packed" / "odd.tgz", "w:gz") as tar:
        member(tar, "a/glide_1_skip.csv", HEAD + "1,-1.0\n")
        member(tar, "a/notes.txt", "x")
        member(tar, "a/glide_2.csv", HEAD)
        member(tar, "a/glide_3.csv", "receptor,x,y\n".replace("receptor,x,y", "title,r_i_docking_score") + "0,0\n9999,-5.5\n")
    (tmp_path / "packed" / "glide_plain.csv").write_text(HEAD + "8888,\n7777,-1.5\n")
    assert archives.results(spark, f"file://{tmp_path}/packed", skip=1).filter("title in (0, 9999, 8888, 7777)").select("title").orderBy("title").collect() == [(7777,), (9999,)]


def test_a_sorted_member_is_left_at_the_cutoff(tmp_path):
    with tarfile.open(tmp_path / "r.tar", "w") as tar:
        for k in range(3):
            member(tar, f"glide_{k}.csv", HEAD + "".join(f"{i},{i - 1000}.0\n" for i in range(1000)))
    reader = archives.Reader({"path": f"file://{tmp_path}", "sorted": "true"})
    assert [*reader.pushFilters([LessThanOrEqual(("score",), -990)])], "the filter is applied again"
    (part,) = reader.partitions()
    assert len(list(reader.read(part))) == 33
    assert reader.rows_read == 36  # of each member the rows up to the first over the cutoff
    whole = archives.Reader({"path": f"file://{tmp_path}"})
    list(whole.pushFilters([LessThanOrEqual(("score",), -990)]))
    assert len(list(whole.read(part))) == 3000 == whole.rows_read


def test_an_archive_over_two_gigabytes(spark, tmp_path):
    """Its bytes are a hole in the file; nothing holds them."""
    path, size = tmp_path / "big.tar", (1 << 31) + (1 << 20)
    with tarfile.open(path, "w", format=tarfile.GNU_FORMAT) as tar:
        member(tar, "glide_1.csv", HEAD + "1,-1.0\n")
        info = tarfile.TarInfo("pose.bin")
        info.size = size
        tar.addfile(info, io.BytesIO(b"")) if size == 0 else tar.fileobj.write(info.tobuf(tarfile.GNU_FORMAT))
        tar.fileobj.seek(size, os.SEEK_CUR)
        tar.offset = tar.fileobj.tell()
        member(tar, "glide_2.csv", HEAD + "2,-2.0\n")
    assert os.path.getsize(path) > 1 << 31
    assert archives.results(spark, f"file://{tmp_path}").orderBy("title").select("title", "score").collect() == [(1, -1.0), (2, -2.0)]


@F.udtf(returnType="method string, query bigint, k string, title string, sim double")
class Near:
    def eval(self, row):
        n = int(row["smiles"][1:]) * 3
        for d in range(4):
            for method, sim in (("fp", 0.6), ("pharm", 0.8 + (n + d) % 3 / 10)):
                yield method, row["compound_id"], f"m{n + d}", f"m{n + d}", sim


@F.udtf(returnType="title bigint, score double")
class Scored:
    def eval(self, row):
        value = -(row["vector"][0] * 0.5) - row["vector"][1]
        if row["compound_id"] % 5:
            yield row["compound_id"], value
            yield row["compound_id"], value + 1


def test_a_round_with_table_functions(spark, tmp_path):
    settings, states = Settings(queries_per_cycle=4, docked_per_round=5), []
    plain = lambda q: search(q).filter("k <> 'bad'")
    for name, find, rate in (("frames", plain, score), ("functions", providers.from_table_function(Near, 3), providers.from_table_function(Scored, 3))):
        campaign = Campaign(spark, f"file://{tmp_path}/{name}")
        screening.import_seeds(campaign, numbered(spark), prepare, docked=True)
        screening.screening_round(campaign, find, prepare, rate, settings)
        states.append(sorted(map(tuple, campaign.read("compounds").drop("vector", "fp").collect())))
    assert states[0] == states[1] and any(r[9] == 1 for r in states[0])
    assert providers.from_table_function(Scored, 3)(numbered(spark).withColumn("compound_id", F.lit(1)).limit(0)).collect() == []


def test_streamed_results_become_the_state_once(spark, tmp_path):
    seeds = numbered(spark).withColumn("score", F.lit(None).cast("double"))
    campaigns = [Campaign(spark, f"file://{tmp_path}/{n}") for n in "ab"]
    for c in campaigns:
        screening.import_seeds(c, seeds, prepare, docked=False)
    folder = tmp_path / "in"
    folder.mkdir()
    files = ["1,-1.0\n2,-2.0\n3,NaN\n", "1,-3.0\n2,-1.0\n4,-4.0\n", "3,-9.0\n77777,-1.0\n"]
    for n, text in enumerate(files):
        (folder / f"glide_{n}.csv").write_text(HEAD + text)
        results.collect_into_campaign(results.arriving(spark, f"file://{folder}"), campaigns[0], f"file://{tmp_path}/check", 2).awaitTermination()
    rows = [(int(t), float(s)) for text in files for t, s in (line.split(",") for line in text.split())]
    best = merge.best_score_per_title(spark.createDataFrame(rows, "title long, score double"), "title", "score")
    want = merge.store_scores(campaigns[1].read("compounds"), best, 2)
    got = campaigns[0].read("compounds")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert campaigns[0].read("ledger").count() == 3
    before = campaigns[0].published()
    # The last batch comes again, as after a crash before its checkpoint: its files are in it, its number is in the ledger.
    last = max(os.listdir(tmp_path / "check" / "commits"), key=lambda n: int(n) if n.isdigit() else -1)
    for name in (last, f".{last}.crc"):
        if (tmp_path / "check" / "commits" / name).exists():
            (tmp_path / "check" / "commits" / name).unlink()
    results.collect_into_campaign(results.arriving(spark, f"file://{folder}"), campaigns[0], f"file://{tmp_path}/check", 2).awaitTermination()
    assert campaigns[0].published() == before


def test_command_line(spark, tmp_path, monkeypatch):
    module = types.ModuleType("toy_providers")
    module.factory = lambda session, space: types.SimpleNamespace(search=search, prepare=prepare, score=score)
    monkeypatch.setitem(sys.modules, "toy_providers", module)
    (tmp_path / "s.smi").write_text("".join(f"m{i} t{i}\n" for i in range(10, 30)))
    (tmp_path / "grid.zip").write_bytes(b"grid")
    base = ["--database", f"file://{tmp_path}/job", "--providers", "toy_providers:factory"]
    run = lambda *args: command.main([*base, "--action", *args], spark)
    for wrong in (["screen"], ["importsmiles"], ["exportcsv"], ["chance"]):
        with pytest.raises(SystemExit):
            run(*wrong)
    run("importsmiles", "--smiles", f"file://{tmp_path}/s.smi", "--dock_grid", f"file://{tmp_path}/grid.zip")
    run("screen", "--mode", "clustering", "--simsearch_queries", "6", "--dock_mols", "4", "--simsearch_cpus", "7")
    run("cluster")
    run("exportcsv", "--cutoff", "-3", "--export_file", f"file://{tmp_path}/out")
    campaign = Campaign(spark, f"file://{tmp_path}/job")
    assert campaign.counters() == {"cycle": 3, "iteration": 1, "models": 1} and campaign.read("docking_grid").first().content == b"grid"
    lines = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*")).splitlines()
    assert len(lines) - 1 == campaign.read("compounds").filter("dock_score <= -3").count() > 0


def test_result_files_are_whole_and_stay(spark, tmp_path):
    folder = f"file://{tmp_path}/results"
    rows = spark.createDataFrame([(1, -3.5), (1, None), (2, 4.0)], "title long, score double")
    writers.result_files(rows.repartition(2), folder)
    writers.result_files(rows.filter("title = 2"), folder)
    writers.result_files(rows, folder, skipped=True)
    found = sorted(((r.title, r.score) for r in readers.docking_results(spark, folder).collect()), key=repr)
    assert found == sorted([(1, -3.5), (1, None), (2, 4.0), (2, 4.0)], key=repr)
    names = [p.name for p in (tmp_path / "results").iterdir() if not p.name.startswith(".")]
    assert all(n.startswith("glide_") and n.endswith(".csv") for n in names)
    assert any(n.endswith("_skip.csv") for n in names)


def test_result_files_of_no_rows(spark, tmp_path):
    folder = f"file://{tmp_path}/results"
    writers.result_files(spark.createDataFrame([], "title long, score double"), folder)
    assert [p.name for p in (tmp_path / "results").iterdir() if p.name.startswith("_")] == []


def test_collections_are_compressed_and_keep_two_columns(spark, tmp_path):
    rows = spark.createDataFrame([("CC", 1.5, "a b"), ("CO", None, "c")], "SMILES string, MW double, ID string")
    writers.collection(rows, f"file://{tmp_path}/c")
    assert all(p.name.endswith(".gz") for p in (tmp_path / "c").glob("part-*"))
    assert sorted(map(tuple, readers.collection(spark, f"file://{tmp_path}/c", "SMILES", "ID").collect())) == [("CC", "a b"), ("CO", "c")]
