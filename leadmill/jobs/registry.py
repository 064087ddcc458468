"""The campaign's operators applied to the star-schema tables, with SQL twins.

Stand-ins: `part` holds the compounds, `lineitem` the result files (one row for each variant or hit),
`embeddings` the fingerprints (signs of the components), `documents.text` the registration hash.
Which compounds are docked, predicted, used or clustered is read from attributes of the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import molecules
from ..functions.fingerprint import sign_bits
from ..operators import acquire, cluster, filters, merge, network, select, similarity, surrogate
from ..schema import Settings
from ..sources import archives
from ..store import Campaign, file_system, shared_dir, spool
from . import providers, screening

CUTOFF = -80000.0

STATE_SQL = """best as (select l_partkey id, min(-l_extendedprice) s from lineitem group by l_partkey),
state as (select p_partkey compound_id, p_name smilesid, case when p_size <= 17 then b.s end dock_score,
  case when p_brand <> 'Brand#11' then -p_retailprice end pred_score, case when p_type = 'PROMO' then 1 end query_cycle,
  case when p_size <= 17 then cast(p_size % 4 as int) end dock_iteration from part left join best b on b.id = p_partkey),
clusters as (select p_partkey compound_id, p_size cluster_id from part where p_type <> 'LARGE')"""
HITS_SQL = "hits as (select case when l_linestatus = 'F' then 'a' else 'b' end method, l_partkey k, l_orderkey title, l_discount sim from lineitem)"
FP_SQL = """f as (select vec_id, list_transform(embedding, lambda x: case when x > 0 then 1 else 0 end) b from embeddings),
fp as (select vec_id, b, cast(list_sum(b) as bigint) n from f)"""
PAIR_SQL = "cast(list_sum(list_transform(list_zip(a.b, b.b), lambda z: z[1] * z[2])) as bigint)"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query with its SQL twin ({STATE}, {HITS} and {FP} stand for shared parts)."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            parts = {"{STATE}": STATE_SQL, "{HITS}": HITS_SQL, "{FP}": FP_SQL, "{I}": PAIR_SQL, "{CUTOFF}": str(CUTOFF)}
            text = sql
            for k, v in parts.items():
                text = text.replace(k, v)
            ORACLES[f.__name__] = text
        return f

    return add


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def best(self) -> DataFrame:
        scores = self.lineitem.select("l_partkey", (-F.col("l_extendedprice")).alias("score"))
        return merge.best_score_per_title(scores, "l_partkey", "score")

    def state(self) -> DataFrame:
        docked = F.col("p_size") <= 17
        joined = self.part.join(self.best(), F.col("p_partkey") == F.col("title"), "left")
        return joined.select(
            F.col("p_partkey").alias("compound_id"),
            F.col("p_name").alias("smilesid"),
            F.when(docked, F.col("r_i_docking_score")).alias("dock_score"),
            F.when(F.col("p_brand") != "Brand#11", -F.col("p_retailprice")).alias("pred_score"),
            F.when(F.col("p_type") == "PROMO", 1).alias("query_cycle"),
            F.when(docked, (F.col("p_size") % 4).cast("int")).alias("dock_iteration"),
        )

    def clusters(self) -> DataFrame:
        return self.part.filter("p_type <> 'LARGE'").select(F.col("p_partkey").alias("compound_id"), F.col("p_size").alias("cluster_id"))

    def hits(self) -> DataFrame:
        method = F.when(F.col("l_linestatus") == "F", "a").otherwise("b")
        return self.lineitem.select(method.alias("method"), F.col("l_partkey").alias("k"), F.col("l_orderkey").alias("title"), F.col("l_discount").alias("sim"))

    def fingerprints(self) -> DataFrame:
        return similarity.fingerprints(self.embeddings, "vec_id", sign_bits(F.col("embedding"), 64))

    def known(self) -> DataFrame:
        return self.documents.filter("source = 'src0'")


@query("with {STATE} select compound_id, smilesid from state where dock_score is null")
def undocked_scan(spark, sf_dir):
    return acquire.undocked(Tables(spark, sf_dir).state())


@query("with {STATE} select compound_id, pred_score from state where pred_score is not null and dock_score is null order by pred_score, compound_id limit 50")
def greedy_dock_pick(spark, sf_dir):
    return acquire.pick_to_dock(Tables(spark, sf_dir).state(), 50)


@query("with {STATE} select compound_id, dock_score from state where query_cycle is null and dock_score is not null order by dock_score, compound_id limit 50")
def greedy_query_docked(spark, sf_dir):
    return acquire.pick_queries(Tables(spark, sf_dir).state(), 50, predicted=False)


@query("with {STATE} select compound_id, pred_score from state where query_cycle is null and pred_score is not null and dock_score is null order by pred_score, compound_id limit 50")
def greedy_query_predicted(spark, sf_dir):
    return acquire.pick_queries(Tables(spark, sf_dir).state(), 50, predicted=True)


CLUSTER_SQL = """with {STATE}, r as (select s.compound_id, c.cluster_id, s.%s, row_number() over (partition by c.cluster_id order by s.%s, s.compound_id) rn
from state s join clusters c on s.compound_id = c.compound_id where %s) select compound_id, cluster_id, %s from r where rn = 1 order by %s, compound_id limit 20"""


def _cluster_sql(score: str, where: str) -> str:
    return CLUSTER_SQL % (score, score, where, score, score)


@query("""with r as (select l_orderkey, l_linenumber, l_quantity, row_number() over (order by l_quantity, l_orderkey, l_linenumber) rn, count(*) over () n from lineitem)
select l_orderkey, l_linenumber, l_quantity from r where rn <= n // 3""")
def pick_third_of_rows(spark, sf_dir):
    """A third of all result rows, the lowest first, cut amid many ties."""
    rows = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return select.smallest(rows, "l_quantity", ["l_orderkey", "l_linenumber"], rows.count() // 3)


@query(_cluster_sql("pred_score", "s.pred_score is not null and s.dock_score is null"))
def cluster_dock_pick(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return acquire.pick_to_dock(t.state(), 20, t.clusters())


@query(_cluster_sql("dock_score", "s.query_cycle is null and s.dock_score is not null"))
def cluster_query_docked(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return acquire.pick_queries(t.state(), 20, predicted=False, clusters=t.clusters())


@query(_cluster_sql("pred_score", "s.query_cycle is null and s.pred_score is not null and s.dock_score is null"))
def cluster_query_predicted(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return acquire.pick_queries(t.state(), 20, predicted=True, clusters=t.clusters())


@query("""with {STATE}, pick as (select compound_id from state where query_cycle is null and dock_score is not null order by dock_score, compound_id limit 50)
select s.compound_id, case when p.compound_id is not null then 2 else s.query_cycle end query_cycle from state s left join pick p on s.compound_id = p.compound_id""")
def mark_queries(spark, sf_dir):
    state = Tables(spark, sf_dir).state()
    return acquire.mark_queries(state, acquire.pick_queries(state, 50, predicted=False), 2).select("compound_id", "query_cycle")


@query("with {STATE} select smilesid, dock_score docking_score from state where dock_score < {CUTOFF}")
def training_set(spark, sf_dir):
    return surrogate.training_set(Tables(spark, sf_dir).state(), CUTOFF)


@query("with {STATE} select coalesce(max(query_cycle), 0) latest_cycle, coalesce(max(dock_iteration), 0) latest_iteration, count(*) n from state")
def latest_counters(spark, sf_dir):
    latest = lambda c: F.coalesce(F.max(c), F.lit(0))
    return Tables(spark, sf_dir).state().agg(latest("query_cycle").alias("latest_cycle"), latest("dock_iteration").alias("latest_iteration"), F.count("*").alias("n"))


@query("""select p_brand, max(case when lower(p_type) = 'promo' then p_retailprice end) promo_high, min(case when lower(p_type) = 'promo' then p_retailprice end) promo_low,
max(case when lower(p_type) = 'small' then p_retailprice end) small_high, min(case when lower(p_type) = 'small' then p_retailprice end) small_low from part group by p_brand""")
def property_limits_pivot(spark, sf_dir):
    """Limits as one row, from a row for each property; names count in either case."""
    kind = F.lower("p_type")
    sides = [f(F.when(kind == name, F.col("p_retailprice"))).alias(f"{name}_{side}") for name in ("promo", "small") for side, f in (("high", F.max), ("low", F.min))]
    return Tables(spark, sf_dir).part.groupBy("p_brand").agg(*sides)


@query("select l_orderkey, l_linenumber from lineitem where l_quantity between 5 and 40 and l_discount between 0.02 and 0.08 and l_tax between 0.0 and 0.05 and l_extendedprice between 1000 and 60000")
def property_range_filter(spark, sf_dir):
    limits = {"l_quantity": (5, 40), "l_discount": (0.02, 0.08), "l_tax": (0.0, 0.05), "l_extendedprice": (1000, 60000)}
    return Tables(spark, sf_dir).lineitem.filter(filters.within(limits)).select("l_orderkey", "l_linenumber")


@query("select l_partkey title, min(-l_extendedprice) r_i_docking_score from lineitem group by l_partkey")
def best_score_per_title(spark, sf_dir):
    return Tables(spark, sf_dir).best()


@query("with {HITS} select method, k, max(sim) similarity from hits group by method, k")
def max_similarity_per_method(spark, sf_dir):
    return merge.max_similarity(Tables(spark, sf_dir).hits())


@query("with {HITS}, r as (select k, title, method, row_number() over (partition by k order by method, title) rn from hits) select k, title, method from r where rn = 1")
def first_title_priority(spark, sf_dir):
    return merge.first_title(Tables(spark, sf_dir).hits())


@query("select min(doc_id) doc_id, min(-cast(n_chars % 17 as bigint)) pred_score from documents group by text")
def representative_min_pred(spark, sf_dir):
    rows = Tables(spark, sf_dir).documents.select("text", "doc_id", (-(F.col("n_chars") % 17)).alias("p"))
    return merge.representatives(rows, "text", "doc_id", "p")


@query("select min(doc_id) doc_id, count(*) n from documents group by text")
def unique_hash(spark, sf_dir):
    return merge.unique_by(Tables(spark, sf_dir).documents.select("text", "doc_id"), "text", "doc_id")


@query("with known as (select distinct text from documents where source = 'src0') select d.doc_id from documents d where not exists (select 1 from known k where k.text = d.text)")
def anti_join_existing(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return merge.not_known(t.documents.select("doc_id", "text"), t.known(), "text").select("doc_id")


@query("""with known as (select distinct text from documents where source = 'src0'), mx as (select max(doc_id) m from documents where source = 'src0'),
nw as (select min(d.doc_id) src from documents d where not exists (select 1 from known k where k.text = d.text) group by d.text)
select m + row_number() over (order by src) new_id, src from nw cross join mx""")
def insert_with_ids(spark, sf_dir):
    t = Tables(spark, sf_dir)
    new = merge.unique_by(merge.not_known(t.documents.select("doc_id", "text"), t.known(), "text"), "text", "doc_id")
    start = t.known().agg(F.max("doc_id")).first()[0] or 0
    return merge.with_dense_ids(new.select(F.col("doc_id").alias("src")), "src", start)


@query("""with {HITS}, w as (select k, max(case when method = 'a' then 1 else 0 end) a, max(case when method = 'b' then 1 else 0 end) b from hits where sim >= 0.1 group by k)
select cast(coalesce(sum(a), 0) as bigint) n_a, cast(coalesce(sum(b), 0) as bigint) n_b, cast(count(case when a = 1 and b = 0 then 1 end) as bigint) only_a,
cast(count(case when b = 1 and a = 0 then 1 end) as bigint) only_b from w""")
def method_overlap_counts(spark, sf_dir):
    return merge.overlap_counts(Tables(spark, sf_dir).hits().filter("sim >= 0.1"))


@query("""with {HITS}, f as (select * from hits where sim >= 0.09)
select p.p_partkey, max(case when f.method = 'a' then f.sim end) sim_a, max(case when f.method = 'b' then f.sim end) sim_b from part p left join f on f.k = p.p_partkey group by p.p_partkey""")
def method_pivot_left_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return merge.attach_similarities(t.part.select("p_partkey"), t.hits().filter("sim >= 0.09"), "p_partkey")


@query("""with {STATE}, upd as (select l_partkey id, min(-l_extendedprice) s from lineitem where l_quantity >= 49 group by l_partkey)
select st.compound_id, case when u.id is not null then u.s else st.dock_score end dock_score, case when u.id is not null then 4 else st.dock_iteration end dock_iteration
from state st left join upd u on u.id = st.compound_id""")
def update_dock_scores(spark, sf_dir):
    t = Tables(spark, sf_dir)
    new = t.lineitem.filter("l_quantity >= 49").select("l_partkey", (-F.col("l_extendedprice")).alias("score"))
    scores = merge.best_score_per_title(new, "l_partkey", "score")
    return merge.store_scores(t.state(), scores, 4).select("compound_id", "dock_score", "dock_iteration")


@query("""with {STATE}, p as (select o_custkey id, max(o_totalprice) s from orders group by o_custkey)
select st.compound_id, case when st.dock_score is null then coalesce(p.s, st.pred_score) else st.pred_score end pred_score from state st left join p on p.id = st.compound_id""")
def update_predictions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    state = t.state()
    new = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("pred_score"))
    fresh = state.filter("dock_score is null").select("compound_id").join(new, F.col("compound_id") == F.col("o_custkey")).select("compound_id", "pred_score")
    return merge.update(state, fresh, "compound_id", ["pred_score"]).select("compound_id", "pred_score")


@query("""with {STATE} select s.smilesid || '/' || cast(s.compound_id as varchar) smilesid, s.dock_score, s.pred_score, s.query_cycle, s.dock_iteration, c.cluster_id
from state s join clusters c on s.compound_id = c.compound_id where s.dock_score <= {CUTOFF}""")
def export_hits(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return merge.export(t.state(), t.clusters(), CUTOFF)


@query("""with {STATE}, {HITS}, f as (select k, max(case when method = 'a' then sim end) sim_fp, max(case when method = 'b' then sim end) sim_pharm from hits where sim >= 0.1 group by k)
select s.smilesid || '/' || cast(s.compound_id as varchar) smilesid, s.dock_score, f.sim_fp, f.sim_pharm from state s join f on f.k = s.compound_id where s.dock_score <= {CUTOFF}""")
def export_hits_search_only(spark, sf_dir):
    t = Tables(spark, sf_dir)
    found = merge.attach_similarities(t.state().select("compound_id", "smilesid", "dock_score"), t.hits().filter("sim >= 0.1"), "compound_id")
    return merge.export_found(found.withColumnsRenamed({"sim_a": "sim_fp", "sim_b": "sim_pharm"}), CUTOFF)


@query("with {HITS} select distinct k from hits where method = 'a' and sim >= 0.05 union select distinct k from hits where method = 'b' and sim >= 0.05")
def union_methods(spark, sf_dir):
    hits = Tables(spark, sf_dir).hits().filter("sim >= 0.05")
    return hits.filter("method = 'a'").select("k").unionByName(hits.filter("method = 'b'").select("k")).distinct()


@query("with {HITS} select k from hits where method = 'a' and sim = 0.1 except select k from hits where method = 'b' and sim = 0.1")
def except_methods(spark, sf_dir):
    hits = Tables(spark, sf_dir).hits().filter("sim = 0.1")
    return hits.filter("method = 'a'").select("k").distinct().join(hits.filter("method = 'b'").select("k"), "k", "left_anti")


@query("""with {FP} select a.vec_id q, b.vec_id h, cast({I} as double) / (a.n + b.n - {I}) sim from fp a join fp b on a.vec_id <> b.vec_id
where a.vec_id % 50 = 0 and 2 * {I} >= a.n + b.n - {I} and a.n + b.n > 0""")
def tanimoto_pairs(spark, sf_dir):
    fp = Tables(spark, sf_dir).fingerprints()
    return similarity.similar_pairs(fp.filter("id % 50 = 0"), fp, 50)


@query("""with {FP}, p as (select a.vec_id q, b.vec_id h, cast({I} as double) / (a.n + b.n - {I}) sim from fp a join fp b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0 and a.n + b.n > 0),
r as (select *, row_number() over (partition by q order by sim desc, h) rank from p) select q, h, sim, cast(rank as int) rank from r where rank <= 5""")
def tanimoto_topn_per_query(spark, sf_dir):
    fp = Tables(spark, sf_dir).fingerprints()
    return similarity.top_per_query(fp.filter("id % 50 = 0"), fp, 5)


@query("""with {FP}, p as (select b.vec_id h, a.vec_id q, cast({I} as double) / (a.n + b.n - {I}) sim from fp a join fp b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0 and b.vec_id % 50 <> 0 and a.n + b.n > 0),
r as (select *, row_number() over (partition by h order by sim desc, q) rn from p)
select h, q, sim from r where rn = 1 union all select vec_id, vec_id, 1.0 from embeddings where vec_id % 50 = 0""")
def assign_nearest_centroid(spark, sf_dir):
    fp = Tables(spark, sf_dir).fingerprints()
    return similarity.assign_to_nearest(fp.filter("id % 50 = 0"), fp)


@query("""with {FP} select a.vec_id q, b.vec_id h, cast({I} as double) / (a.n + b.n - {I}) sim from fp a join fp b on a.vec_id < b.vec_id
where 5 * {I} >= 3 * (a.n + b.n - {I}) and a.n + b.n > 0""")
def tanimoto_self_join(spark, sf_dir):
    """Every row against every row from 0.6 on."""
    return similarity.self_pairs(Tables(spark, sf_dir).fingerprints(), 60)


@query("""with {FP} select a.vec_id q, b.vec_id h, cast({I} as double) / (a.n + b.n - {I}) sim from fp a join fp b on a.vec_id <> b.vec_id
where a.vec_id % 50 = 0 and 20 * {I} >= 11 * (a.n + b.n - {I}) and a.n + b.n > 0""")
def stored_similar_pairs(spark, sf_dir):
    """Queries against a store of fingerprints, of which the folders in reach are read."""
    fp = Tables(spark, sf_dir).fingerprints()
    folder = f"{shared_dir(spark)}/leadmill-{uuid.uuid4().hex}"
    fs, where = file_system(spark, folder)
    fs.deleteOnExit(where)
    similarity.write_store(fp, folder, 4)
    return similarity.stored_pairs(fp.filter("id % 50 = 0"), folder, 4, 55)


LEADERS_SQL = f"""with recursive {FP_SQL}, e as materialized (select a.vec_id a, b.vec_id b from fp a join fp b on a.vec_id < b.vec_id where 5 * {PAIR_SQL} >= 2 * (a.n + b.n - {PAIR_SQL}) and a.n + b.n > 0),
o as materialized (select vec_id, row_number() over (order by vec_id) rn, (select count(*) from fp) total from fp),
pass as (select 0::bigint rn, []::bigint[] led union all
  select p.rn + 1, case when exists (select 1 from e where e.b = o.vec_id and list_contains(p.led, e.a)) then p.led else list_append(p.led, o.vec_id) end from pass p join o on o.rn = p.rn + 1),
l as (select unnest(led) id from (select led from pass order by rn desc limit 1)),
s as (select b.vec_id h, a.vec_id q, cast({PAIR_SQL} as double) / (a.n + b.n - {PAIR_SQL}) sim from l join fp a on a.vec_id = l.id join fp b on a.vec_id <> b.vec_id
  where 5 * {PAIR_SQL} >= 2 * (a.n + b.n - {PAIR_SQL}) and a.n + b.n > 0 and b.vec_id not in (select id from l)),
r as (select *, row_number() over (partition by h order by sim desc, q) rn from s)
select h compound_id, q cluster_id, sim from r where rn = 1 union all select id, id, 1.0 from l"""


@query(LEADERS_SQL)
def leader_clusters(spark, sf_dir):
    """A pass in id order, in the SQL row by row."""
    return cluster.leader_clusters(Tables(spark, sf_dir).fingerprints(), 40)


@query(LEADERS_SQL)
def grown_leader_clusters(spark, sf_dir):
    """The same clusters, of the rows up to the middle first, then with the others added."""
    fp = Tables(spark, sf_dir).fingerprints()
    middle = fp.agg(F.percentile_approx("id", 0.5)).first()[0]
    half = spool(cluster.leader_clusters(fp.filter(F.col("id") <= middle), 40), "half")
    return cluster.grown_clusters(half, fp, 40)


@query("with t as (select doc_id, row_number() over (order by doc_id) rn, count(*) over () n from labels) select doc_id, case when rn > n - greatest(1, cast(floor(n * 0.1) as bigint)) then 'val' else 'train' end split from t")
def tail_split(spark, sf_dir):
    return surrogate.tail_split(Tables(spark, sf_dir).labels.select("doc_id"), "doc_id")


@query("with t as (select p_partkey, row_number() over (order by p_partkey) - 1 rn from part) select p_partkey, cast(floor(rn / 1000) as bigint) chunk from t")
def chunk_assignment(spark, sf_dir):
    return surrogate.chunks(Tables(spark, sf_dir).part, "p_partkey", 1000)


@query("select p_partkey, p_name from part order by md5('7|' || cast(p_partkey as varchar)), p_partkey limit 100")
def sample_exact_n(spark, sf_dir):
    """100 rows by hash: the sampling operator's own limit."""
    return surrogate.exact_sample(Tables(spark, sf_dir).part.select("p_partkey", "p_name"), 100, 7, "p_partkey")


@query("""select doc_id, key, smiles, title from (select doc_id, lang as key, source as smiles, cast(n_chars as varchar) || '§' || source as title from documents)""")
def split_composite_record(spark, sf_dir):
    joined = F.concat_ws("§", "lang", "source", F.col("n_chars").cast("string"), "source")
    return Tables(spark, sf_dir).documents.select("doc_id", filters.split_record(joined).alias("r")).select("doc_id", "r.*")


@query("""with l as (select doc_id, trim(unnest(string_split(text, chr(10)))) as value from documents)
select doc_id, count(*) n from l where value <> '' and not (regexp_matches(value, '^(The|De)([ ]|$)')) group by doc_id""")
def template_line_filter(spark, sf_dir):
    lines = Tables(spark, sf_dir).documents.select("doc_id", F.explode(F.split("text", "\n")).alias("value"))
    return filters.template_lines(lines, ("The", "De")).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("select cast(count(*) as bigint) n, cast(sum(case when l_shipdate >= timestamp '2000-01-01' then 1 else 0 end) as bigint) n_late from lineitem")
def count_rows(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.agg(F.count("*").alias("n"), F.count_if(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp")).alias("n_late"))


def _training_rows(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", "embedding", F.col("label").cast("double").alias("score"))


@query("""with t as (select vec_id, label, row_number() over (order by vec_id) rn, count(*) over () n from embeddings),
s as (select vec_id, label, case when rn > n - greatest(1, cast(floor(n * 0.1) as bigint)) then 'val' else 'train' end split from t),
m as (select avg(label) a, stddev_pop(label) d from s where split = 'train') select vec_id, split, round((label - a) / case when d = 0 then 1 else d end, 6) scaled from s cross join m""")
def target_scaling(spark, sf_dir):
    """The scaled target of all rows."""
    rows = _training_rows(Tables(spark, sf_dir))
    split = rows.join(surrogate.tail_split(rows, "vec_id"), "vec_id")
    mean, deviation = surrogate.scaling(split.filter("split = 'train'"), "score")
    return split.select("vec_id", "split", F.round((F.col("score") - mean) / deviation, 6).alias("scaled"))


@query("select l_orderkey * 8 + l_linenumber title, -l_extendedprice score from lineitem where -l_extendedprice <= -60000")
def archived_results_to_cutoff(spark, sf_dir):
    """All result rows packed as sorted files in archives, read up to a cutoff."""
    rows = Tables(spark, sf_dir).lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("title"), (-F.col("l_extendedprice")).alias("score"))
    folder = f"{shared_dir(spark)}/leadmill-{uuid.uuid4().hex}"
    fs, where = file_system(spark, folder)
    fs.deleteOnExit(where)
    archives.pack(rows, folder, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return archives.results(spark, folder, in_order=True).filter("score <= -60000").select("title", "score")


@F.udtf(returnType="title bigint, score double")
class PartScores:
    """One score for each third of a part's size, so small parts have none."""

    def eval(self, row):
        for k in range(row["p_size"] // 17):
            yield row["p_partkey"], -row["p_retailprice"] - k


@query("select p_partkey title, -p_retailprice - k score from (select *, unnest(range(0, p_size // 17)) k from part)")
def scored_by_table_function(spark, sf_dir):
    parts = Tables(spark, sf_dir).part.select("p_partkey", "p_size", "p_retailprice")
    return providers.from_table_function(PartScores, 64, "p_partkey")(parts)


@query()
def network_predict(spark, sf_dir):
    """By a network of few epochs; iterative, so without SQL. Tested against a linear model on a curved target."""
    rows = _training_rows(Tables(spark, sf_dir))
    model = network.train(rows, "embedding", "score", "vec_id", hidden=(16,), epochs=12)
    return surrogate.predict(model, rows, "embedding", 1).select("vec_id", F.round("pred_score", 4).alias("pred_score"), "pred_version")


@query()
def surrogate_predict(spark, sf_dir):
    rows = _training_rows(Tables(spark, sf_dir))
    model = surrogate.train(rows, "embedding", "score", "vec_id")
    return surrogate.predict(model, rows, "embedding", 1).select("vec_id", F.round("pred_score", 6).alias("pred_score"), "pred_version")


@query("""with {STATE}, i as (select distinct l_partkey + 100 compound_id from lineitem where l_quantity >= 49)
select i.compound_id, s.smilesid from i left join state s on s.compound_id = i.compound_id""")
def title_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    asked = t.lineitem.filter("l_quantity >= 49").select((F.col("l_partkey") + 100).alias("compound_id"))
    return merge.titles_of(asked, t.state())


@query("""with {STATE}, {HITS}, f as (select k, max(case when method = 'a' then sim end) sim_fp, max(case when method = 'b' then sim end) sim_pharm from hits where sim >= 0.1 group by k)
select 'C' || cast(s.compound_id as varchar) smiles, s.smilesid || '/' || cast(s.compound_id as varchar) smilesid, s.dock_score, s.pred_score, f.sim_fp, f.sim_pharm, s.dock_iteration, c.cluster_id
from state s join clusters c on s.compound_id = c.compound_id left join f on f.k = s.compound_id where s.dock_score <= {CUTOFF}""")
def export_name_format(spark, sf_dir):
    """The eight columns of a result file, titles joined with ids."""
    t = Tables(spark, sf_dir)
    state = merge.attach_similarities(t.state(), t.hits().filter("sim >= 0.1"), "compound_id").withColumnsRenamed({"sim_a": "sim_fp", "sim_b": "sim_pharm"})
    return merge.export_table(state.withColumn("smiles", F.concat(F.lit("C"), F.col("compound_id").cast("string"))), t.clusters(), CUTOFF)


@query("""with h as (select case when l_linestatus = 'F' then 'a' else 'b' end method, l_suppkey query, l_partkey k, l_orderkey title, l_discount sim from lineitem where l_discount >= 0.05),
r as (select *, row_number() over (partition by method, query order by sim desc, k, title) rn from h) select method, query, k, title, sim from r where rn <= 3""")
def best_hits_per_query(spark, sf_dir):
    t = Tables(spark, sf_dir)
    hits = t.lineitem.select(F.when(F.col("l_linestatus") == "F", "a").otherwise("b").alias("method"), F.col("l_suppkey").alias("query"), F.col("l_partkey").alias("k"), F.col("l_orderkey").alias("title"), F.col("l_discount").alias("sim"))
    return merge.best_hits_per_query(hits.filter("sim >= 0.05"), 3)


_LIMIT_NAMES = ("mw", "slogp", "hba", "hbd", "rotbonds", "tpsa")


@query("select " + ", ".join(f"max(case when p_size % 6 = {k} then {side} end) {n}_{name}" for k, n in enumerate(_LIMIT_NAMES) for name, side in (("low", "p_retailprice - p_size"), ("high", "p_retailprice"))) + " from part")
def property_limits(spark, sf_dir):
    """A campaign's limits, one row from many; names in upper case."""
    name = F.element_at(F.array(*(F.lit(n.upper()) for n in _LIMIT_NAMES)), (F.col("p_size") % 6 + 1).cast("int"))
    return filters.limits_of(Tables(spark, sf_dir).part.select(name.alias("property"), (F.col("p_retailprice") - F.col("p_size")).alias("low"), F.col("p_retailprice").alias("high")))


class VectorSpace:
    """Providers of a campaign over the `embeddings` table: a molecule `v<vec_id>` is its vector, its hash the signs of the first
    components, either half of its signs one method's fingerprint; a score is a function of the vector."""

    def __init__(self, embeddings: DataFrame):
        self.rows = embeddings

    def half(self, method: str) -> DataFrame:
        start = 1 if method == "fp" else 33
        return similarity.fingerprints(self.rows, "vec_id", sign_bits(F.slice("embedding", start, 32), 32))

    def search(self, queries: DataFrame) -> DataFrame:
        wanted = queries.select(F.col("compound_id").alias("query"), F.substring("smiles", 2, 20).cast("long").alias("id"))
        found = []
        for method in ("fp", "pharm"):
            rows = self.half(method)
            pairs = similarity.similar_pairs(rows.join(wanted, "id", "left_semi"), rows, 50)
            name = lambda c: F.concat(F.lit(c), F.col("h").cast("string"))
            found.append(pairs.join(wanted, F.col("q") == F.col("id")).select(F.lit(method).alias("method"), "query", name("v").alias("k"), name("t").alias("title"), "sim"))
        return found[0].unionByName(found[1])

    def prepare(self, rows: DataFrame) -> DataFrame:
        own = self.rows.select(F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("k"), F.col("embedding").cast("array<double>").alias("vector"))
        ready = rows.join(own, "k").withColumn("fp", sign_bits(F.col("vector"), 64))
        ready = ready.withColumn("reghash", F.hex(F.element_at(sign_bits(F.slice("vector", 1, 16), 16), 1)))
        return ready.withColumn("mw", 300 + 800 * F.element_at("vector", 1)).withColumn("tpsa", 70 + 200 * F.element_at("vector", 2))

    def score(self, picked: DataFrame) -> DataFrame:
        value = F.aggregate(F.slice("vector", 1, 8), F.lit(-5.0), lambda a, x: a + x)
        return picked.select(F.col("compound_id").alias("title"), F.explode(F.array(value, value + 0.25)).alias("score"))


def campaign_of(spark: SparkSession, sf_dir: str, settings: Settings) -> Campaign:
    """A campaign after one round over the vectors, its seeds being each tenth of them."""
    space = VectorSpace(Tables(spark, sf_dir).embeddings)
    folder = f"{shared_dir(spark)}/leadmill-{uuid.uuid4().hex}"
    fs, where = file_system(spark, folder)
    fs.deleteOnExit(where)
    campaign = Campaign(spark, folder)
    seeds = space.rows.filter("vec_id % 10 = 0").select(F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("smiles"), F.concat(F.lit("t"), F.col("vec_id").cast("string")).alias("title"), F.lit(None).cast("double").alias("score"))
    screening.import_seeds(campaign, seeds, space.prepare, docked=False, settings=settings)
    screening.dock(campaign, space.score, settings, seeds=True)
    screening.screening_round(campaign, space.search, space.prepare, space.score, settings)
    return campaign


ROUND = Settings(queries_per_cycle=20, docked_per_round=50, hits_per_query=100, min_similarity=(("fp", 0.5), ("pharm", 0.6)), acquisition="clustering")


@query()
def screening_round(spark, sf_dir):
    """The state after seeds were docked and one round was run; iterative, so without SQL. Tested step by step."""
    campaign = campaign_of(spark, sf_dir, ROUND)
    state = campaign.read("compounds").join(campaign.read("clusters"), "compound_id")
    scores = (F.round(c, 6).alias(c) for c in ("dock_score", "pred_score"))
    return state.select("compound_id", "smiles", "smilesid", *scores, "sim_fp", "sim_pharm", "query_cycle", "dock_iteration", "simsearch_cycle", "cluster_id")


@query("""with m as (select p_partkey, p_size % 9 + 2 n, case p_type when 'PROMO' then 'O' when 'SMALL' then 'N' when 'LARGE' then 'F' else 'X' end e from part)
select p_partkey, round(n * 12.011 + (2 * n + 1) * 1.008 + case e when 'O' then 15.999 + 1.008 when 'N' then 14.007 + 2 * 1.008 when 'F' then 18.998 else 12.011 + 2 * 15.999 + 1.008 end, 3)::double mw,
case when e in ('O', 'N', 'X') then 1 else 0 end hba, case when e = 'F' then 0 else 1 end hbd, case when e = 'X' then n - 1 else n - 2 end rotbonds,
round(case e when 'O' then 20.23 when 'N' then 26.02 when 'F' then 0 else 20.23 + 17.07 end, 2)::double tpsa from m""")
def molecule_descriptors(spark, sf_dir):
    """Each part as a chain of carbons with an alcohol, amine, fluoride or acid at its end."""
    end = F.when(F.col("p_type") == "PROMO", "O").when(F.col("p_type") == "SMALL", "N").when(F.col("p_type") == "LARGE", "F").otherwise("C(=O)O")
    rows = Tables(spark, sf_dir).part.select("p_partkey", F.concat(F.expr("repeat('C', p_size % 9 + 2)"), end).alias("smiles"))
    return molecules.describe(rows).select("p_partkey", F.round("mw", 3).alias("mw"), "hba", "hbd", "rotbonds", F.round("tpsa", 2).alias("tpsa"))
