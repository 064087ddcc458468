"""Queries on what a campaign exchanges and keeps: its files, streams, stored tables, models and limits.

Each writes rows of the given tables through the library's writers or a campaign, and returns what the readers find there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import acquire, filters, merge, surrogate
from ..schema import PropertyLimits, Range, Settings
from ..sources import readers, writers
from ..store import Campaign, file_system, shared_dir
from ..streaming import results
from . import screening
from .registry import CUTOFF, STATE_SQL, Tables, VectorSpace, query


def fresh(spark: SparkSession) -> str:
    """A folder of its own below the shared one, which goes when the JVM ends."""
    folder = f"{shared_dir(spark)}/leadmill-{uuid.uuid4().hex}"
    fs, where = file_system(spark, folder)
    fs.deleteOnExit(where)
    return folder


def named(letter: str, column: str):
    return F.concat(F.lit(letter), F.col(column).cast("string"))


@query("""select 'C' || p_partkey smiles, p_name || ', "' || p_brand || '"' title, case when p_size % 7 <> 0 then -p_retailprice end score, p_size % 7 = 0 missing from part""")
def seeds_with_scores(spark, sf_dir):
    """Docked seeds as CSV; a missing score is NaN when read, here null beside a flag."""
    title = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"'))
    rows = Tables(spark, sf_dir).part.select(named("C", "p_partkey").alias("SMILES"), title.alias("title"), F.when(F.col("p_size") % 7 != 0, -F.col("p_retailprice")).alias("r_i_docking_score"))
    path = fresh(spark)
    writers.export_csv(rows, path)
    missing = F.isnan("score")
    return readers.docked_seeds(spark, path).select("smiles", "title", F.when(~missing, F.col("score")).alias("score"), missing.alias("missing"))


@query("select 'C' || o_orderkey smiles, 'o' || o_custkey title, true undocked from orders")
def seeds_as_lines(spark, sf_dir):
    path = fresh(spark)
    writers.smiles_lines(Tables(spark, sf_dir).orders.select(named("C", "o_orderkey").alias("smiles"), named("o", "o_custkey").alias("title")), path)
    return readers.undocked_seeds(spark, path).select("smiles", "title", F.col("score").isNull().alias("undocked"))


@query("select c_name smiles, cast(c_custkey as varchar) title from customer")
def collection_rows(spark, sf_dir):
    """A compressed collection, of which two columns are kept."""
    path = fresh(spark)
    rows = Tables(spark, sf_dir).customer.select(F.col("c_name").alias("SMILES"), F.col("c_acctbal").alias("MW"), F.col("c_custkey").alias("ID"), F.col("c_mktsegment").alias("Type"))
    writers.collection(rows, path)
    return readers.collection(spark, path, "SMILES", "ID")


@query("""with h as (select case when l_linestatus = 'F' then 'fp' else 'pharm' end method, 'C' || l_partkey k, 't' || l_orderkey title, l_discount sim from lineitem),
a as (select * from h where sim >= case method when 'fp' then 0.05 else 0.03 end), r as (select *, row_number() over (partition by k order by method, title) rn from a)
select k, max(case when rn = 1 then title end) title, max(case when method = 'fp' then sim end) sim_fp, max(case when method = 'pharm' then sim end) sim_pharm from r group by k""")
def hits_from_files(spark, sf_dir):
    """Both methods' result files, merged over their thresholds to a row for each molecule."""
    t, found = Tables(spark, sf_dir), []
    for method, status in (("fp", "F"), ("pharm", "O")):
        columns = {"#result-smiles": named("C", "l_partkey"), "result-name": named("t", "l_orderkey"), readers.HIT_COLUMNS[method]: F.col("l_discount")}
        path = fresh(spark)
        writers.export_csv(t.lineitem.filter(F.col("l_linestatus") == status).select(*(c.alias(n) for n, c in columns.items())), path)
        found.append(readers.hits(spark, path, method))
    return screening.merged_hits(found[0].unionByName(found[1]), Settings(min_similarity=(("fp", 0.05), ("pharm", 0.03))))


RESULTS_SQL = "select l_partkey title, min(case when l_linenumber <> 7 then -l_extendedprice end) r_i_docking_score from lineitem where l_returnflag <> 'R' group by l_partkey"


def result_folder(spark: SparkSession, rows: DataFrame, folder: str) -> str:
    """`lineitem` rows as result files: line 7 has no score, returned rows are those of skipped compounds."""
    scored = rows.select(F.col("l_partkey").alias("title"), F.when(F.col("l_linenumber") != 7, -F.col("l_extendedprice")).alias("score"), (F.col("l_returnflag") == "R").alias("skipped"))
    writers.result_files(scored.filter("not skipped"), folder)
    writers.result_files(scored.filter("skipped"), folder, skipped=True)
    return folder


@query(RESULTS_SQL)
def scores_from_result_files(spark, sf_dir):
    folder = result_folder(spark, Tables(spark, sf_dir).lineitem, fresh(spark))
    return merge.best_score_per_title(readers.docking_results(spark, folder), "title", "score")


@query(RESULTS_SQL)
def scores_from_stream(spark, sf_dir):
    """The same files, arriving in two lots, each read once."""
    rows, folder, out, check = Tables(spark, sf_dir).lineitem, fresh(spark), fresh(spark), fresh(spark)
    for lot in ("l_orderkey % 2 = 0", "l_orderkey % 2 = 1"):
        result_folder(spark, rows.filter(lot), folder)
        results.collect_into(results.arriving(spark, folder), out, check).awaitTermination()
    return spark.read.parquet(out).groupBy("title").agg(F.min("r_i_docking_score").alias("r_i_docking_score"))


@query("""with {STATE}, upd as (select l_partkey id, min(case when l_linenumber <> 7 then -l_extendedprice end) s from lineitem where l_quantity >= 40 and l_returnflag <> 'R' group by l_partkey)
select st.compound_id, case when u.id is not null then u.s else st.dock_score end dock_score, case when u.id is not null then 4 else st.dock_iteration end dock_iteration
from state st left join upd u on u.id = st.compound_id""")
def state_from_stream(spark, sf_dir):
    """A campaign's compounds after results of iteration 4 have arrived in two lots."""
    t, campaign, folder, check = Tables(spark, sf_dir), Campaign(spark, fresh(spark)), fresh(spark), fresh(spark)
    campaign.write("compounds", t.state())
    for lot in ("l_orderkey % 2 = 0", "l_orderkey % 2 = 1"):
        result_folder(spark, t.lineitem.filter("l_quantity >= 40").filter(lot), folder)
        results.collect_into_campaign(results.arriving(spark, folder), campaign, check, 4).awaitTermination()
    return campaign.read("compounds").select("compound_id", "dock_score", "dock_iteration")


@query("select url name, sha256(html) digest, octet_length(encode(html)) n_bytes from pages")
def campaign_blobs(spark, sf_dir):
    """Files that a campaign carries along: the second version of them counts."""
    campaign, pages = Campaign(spark, fresh(spark)), Tables(spark, sf_dir).pages
    campaign.write("blobs", pages.select(F.col("url").alias("name"), F.lit(b"").alias("content")))
    campaign.write("blobs", pages.select(F.col("url").alias("name"), F.col("html").cast("binary").alias("content")))
    return campaign.read("blobs").select("name", F.sha2("content", 256).alias("digest"), F.octet_length("content").cast("long").alias("n_bytes"))


@query("""with l as (select p_size % 6 k, min(p_size) low, max(p_size) - 10 high from part group by 1)
select l_orderkey, l_linenumber from lineitem where l_quantity between (select low from l where k = 0) and (select high from l where k = 0)
and l_linenumber * 7 between (select low from l where k = 5) and (select high from l where k = 5)""")
def replaced_limits(spark, sf_dir):
    """Rows in a campaign's property ranges after these were replaced; ranges of absent properties test nothing."""
    t, campaign = Tables(spark, sf_dir), Campaign(spark, fresh(spark))
    name = F.element_at(F.array(*(F.lit(n) for n, _ in PropertyLimits().items())), (F.col("p_size") % 6 + 1).cast("int"))
    given = t.part.groupBy(name.alias("property")).agg(F.min("p_size").cast("double").alias("low"), (F.max("p_size") - 10).cast("double").alias("high"))
    screening.set_limits(campaign, PropertyLimits(mw=Range(1, 2)))
    screening.set_limits(campaign, filters.chosen_limits(given))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("mw"), (F.col("l_linenumber") * 7).alias("tpsa"))
    return filters.drug_like(rows, screening.limits_of(campaign, Settings())).select("l_orderkey", "l_linenumber")


@query("""with {STATE}, pick as (select compound_id from state where query_cycle is null and dock_score is not null order by dock_score, compound_id limit 50)
select s.compound_id, s.smilesid, s.dock_score, case when p.compound_id is not null then 2 else s.query_cycle end query_cycle from state s left join pick p on s.compound_id = p.compound_id""")
def restored_campaign(spark, sf_dir):
    """The compounds of a campaign that was changed, archived, brought back and cleaned."""
    path, away = fresh(spark), fresh(spark)
    campaign = Campaign(spark, path)
    state = campaign.write("compounds", Tables(spark, sf_dir).state())
    campaign.write("compounds", acquire.mark_queries(state, acquire.pick_queries(state, 50, predicted=False), 2).select(state.columns))
    campaign.archive(f"{away}/job")
    campaign = Campaign.restore(spark, f"{away}/job", path)
    campaign.clean()
    return campaign.read("compounds").select("compound_id", "smilesid", "dock_score", "query_cycle")


def _model_sql(version: int, least: int) -> str:
    return f"""select {version} model_version, round(avg(s), 6) mean, round(case when stddev_pop(s) = 0 then 1 else stddev_pop(s) end, 6) deviation from (
select -label s, row_number() over (order by vec_id) rn, count(*) over () n from embeddings where -label < {least}) where rn <= n - greatest(1, cast(floor(n * 0.1) as bigint))"""


@query(f"{_model_sql(1, 10)} union all {_model_sql(2, -2)}")
def stored_models(spark, sf_dir):
    """The scaling of a campaign's two stored models, trained below different cutoffs, each as it is loaded again."""
    campaign = Campaign(spark, fresh(spark))
    campaign.write("compounds", Tables(spark, sf_dir).embeddings.select(F.col("vec_id").alias("compound_id"), F.col("embedding").cast("array<double>").alias("vector"), (-F.col("label")).cast("double").alias("dock_score")))
    for cutoff in (10.0, -2.0):
        screening.train_model(campaign, Settings(train_cutoff=cutoff))
    loaded = [(v, *screening.load_model(campaign, v)[1:]) for v in (1, 2)]
    return spark.createDataFrame(loaded, "model_version int, mean double, deviation double").select("model_version", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))


@query("""with h as (select 'v' || vec_id smiles, 't' || vec_id smilesid, -label dock_score,
  to_base(cast(list_sum(list_transform(embedding[1:16], lambda x, i: case when x > 0 then 1::bigint << (i - 1) else 0 end)) as bigint), 16) reghash from embeddings)
select row_number() over (order by '{' || reghash || ', ' || smilesid || ', ' || smiles) compound_id, reghash, smiles, smilesid, cast(dock_score as double) dock_score, 0 dock_iteration from h""")
def imported_seeds(spark, sf_dir):
    """All vectors as docked seeds: numbered by hash, title and SMILES, however they are partitioned."""
    campaign, space = Campaign(spark, fresh(spark)), VectorSpace(Tables(spark, sf_dir).embeddings)
    seeds = space.rows.select(named("v", "vec_id").alias("smiles"), named("t", "vec_id").alias("title"), (-F.col("label")).cast("double").alias("score"))
    state = screening.import_seeds(campaign, seeds, space.prepare, docked=True)
    return state.select("compound_id", "reghash", "smiles", "smilesid", "dock_score", "dock_iteration")


@query("""with s as (select 'C' || o_orderkey smiles, 'o' || o_custkey title, count(*) over () n from orders),
r as (select *, row_number() over (order by md5('1|' || smiles || chr(9) || title), smiles || chr(9) || title) rn from s) select smiles, title from r where rn <= n // 3""")
def picked_seed_lines(spark, sf_dir):
    """A third of a collection, picked by hash and written as seeds."""
    rows = Tables(spark, sf_dir).orders.select(named("C", "o_orderkey").alias("smiles"), named("o", "o_custkey").alias("title"))
    path = fresh(spark)
    screening.pick_seeds(rows, path, Settings(seeds=rows.count() // 3))
    return readers.undocked_seeds(spark, path).select("smiles", "title")


@query("select o_orderkey, row_number() over (order by md5('7|3|' || cast(o_orderkey as varchar)) || cast(o_orderkey as varchar)) place from orders")
def epoch_order(spark, sf_dir):
    return surrogate.epoch_order(Tables(spark, sf_dir).orders, 3, 7, "o_orderkey")


@query(f"""with {STATE_SQL} select 'C' || s.compound_id smiles, s.smilesid || '/' || s.compound_id smilesid, s.dock_score, s.pred_score, s.dock_iteration, c.cluster_id
from state s join clusters c on s.compound_id = c.compound_id where s.dock_score <= {CUTOFF}""")
def exported_file(spark, sf_dir):
    """A campaign's result file, read again; similarities, which these compounds lack, are written as None."""
    t, campaign, path = Tables(spark, sf_dir), Campaign(spark, fresh(spark)), fresh(spark)
    none = F.lit(None).cast("double")
    campaign.write("compounds", t.state().select("*", named("C", "compound_id").alias("smiles"), none.alias("sim_fp"), none.alias("sim_pharm")))
    campaign.write("clusters", t.clusters())
    screening.export_results(campaign, path, Settings(export_cutoff=CUTOFF))
    schema = "smiles string, smilesid string, dock_score double, pred_score double, sim_fp double, sim_pharm double, dock_iteration int, cluster_id int"
    rows = spark.read.csv(path, header=True, nullValue="None", schema=schema)
    return rows.filter("sim_fp is null and sim_pharm is null").drop("sim_fp", "sim_pharm")


@query("""with n as (select page_id, split_part(split_part(url, '/', -1), '.', 1) || case when page_id % 2 = 0 then '_iter' || page_id % 9 else '' end job from pages)
select page_id, job, case when page_id % 2 = 0 then cast(page_id % 9 as int) end iteration from n""")
def job_names(spark, sf_dir):
    """Names of jobs from paths, and the iteration that a name ends with."""
    suffix = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("_iter"), (F.col("page_id") % 9).cast("string"))).otherwise("")
    rows = Tables(spark, sf_dir).pages.select("page_id", F.concat(filters.job_name(F.col("url")), suffix).alias("job"))
    return rows.withColumn("iteration", filters.iteration_of(F.col("job")))
