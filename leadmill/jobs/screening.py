"""The campaign's loop: pick seeds, import, search cycles, scoring, training, export.

Providers are plain functions of DataFrames: `search(queries) -> hits (method, k, title, sim)`, with the query's
compound_id as `query` where hits for each query are to be limited; `prepare(hits) -> rows with reghash and vector`,
with `fp` (32 bits in each long) where clusters are not to go by the signs of the vector, and with any of the six descriptors, whose ranges are then
tested; and `score(picked) -> (title, score)`, none to many rows each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import molecules
from ..functions.fingerprint import sign_bits
from ..operators import acquire, cluster, filters, merge, network, similarity, surrogate
from ..schema import COMPOUNDS, MODELS, PROPERTIES, STORED_CLUSTERS, PropertyLimits, Settings
from ..sources import writers
from ..store import Campaign, file_system, scratch, spool

Search = Callable[[DataFrame], DataFrame]
Prepare = Callable[[DataFrame], DataFrame]
Score = Callable[[DataFrame], DataFrame]
FP_BITS = 64  # of the vector's signs


def shaped(rows: DataFrame) -> DataFrame:
    """The state's columns, the vector and the fingerprint, in order; what `rows` lacks is null, a fingerprint the
    vector's signs."""
    have = set(rows.columns)
    columns = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in COMPOUNDS]
    fp = F.col("fp") if "fp" in have else sign_bits(F.col("vector"), FP_BITS)
    return rows.select(*columns, "vector", fp.alias("fp"))


def prepare_smiles(rows: DataFrame) -> DataFrame:
    """A `prepare` for SMILES (k): those that can be read, with descriptors, hash, fingerprint, and as vector the descriptors and
    the counts of bits of the fingerprint's words."""
    done = molecules.describe(rows, "k")
    scaled = [F.col(n).cast("double") / (100.0 if n in ("mw", "tpsa") else 1.0) for n in molecules.NAMES]
    return done.withColumn("vector", F.concat(F.array(*scaled), F.transform("fp", lambda x: F.bit_count(x).cast("double"))))


def pick_seeds(collection: DataFrame, path: str, settings: Settings = Settings(), seed: int = 1) -> None:
    """Writes `settings.seeds` rows (smiles, title) of a collection, all if it has fewer, as lines `SMILES title`."""
    rows = collection.withColumn("_id", F.concat_ws("\t", "smiles", "title"))
    writers.smiles_lines(surrogate.exact_sample(rows, settings.seeds, seed, "_id"), path)


def set_limits(campaign: Campaign, limits: PropertyLimits) -> PropertyLimits:
    """Replaces the campaign's property ranges."""
    rows = [(name, float(r.low), float(r.high)) for name, r in limits.items()]
    campaign.write("properties", campaign.spark.createDataFrame(rows, PROPERTIES))
    return limits


def limits_of(campaign: Campaign, settings: Settings) -> PropertyLimits:
    """The campaign's ranges, or those of the settings where it has none."""
    given = campaign.read("properties")
    return settings.limits if given is None else filters.chosen_limits(given, settings.limits)


def recluster(campaign: Campaign, settings: Settings) -> DataFrame:
    """The clusters of all compounds, as a new table. Compounds are numbered upwards, so those that the stored clusters lack are added to them; all is
    clustered anew where the stored ones are of another threshold, or lie amid or above the new ones."""
    rows, percent, stored = similarity.fingerprints(campaign.read("compounds"), "compound_id", F.col("fp")), settings.cluster_similarity_percent, campaign.read("clusters")
    if stored is not None and grows(rows, stored, percent):
        found = cluster.grown_clusters(stored, rows, percent)
    else:
        found = cluster.leader_clusters(rows, percent)
    found = found.withColumn("percent", F.lit(percent))
    return campaign.write("clusters", found.select(*(F.col(f.name).cast(f.dataType) for f in STORED_CLUSTERS)))


def grows(rows: DataFrame, stored: DataFrame, percent: int) -> bool:
    """Whether the stored clusters are of this threshold and of exactly the rows up to their highest id."""
    if set(stored.columns) < {f.name for f in STORED_CLUSTERS}:
        return False
    n, top, low, high = stored.agg(F.count("*"), F.max("compound_id"), F.min("percent"), F.max("percent")).first()
    return n > 0 and low == high == percent and rows.filter(F.col("id") <= top).count() == n


def acquisition_clusters(campaign: Campaign, settings: Settings) -> DataFrame | None:
    """The clusters to pick by; None for greedy picks."""
    if settings.acquisition not in ("greedy", "clustering"):
        raise ValueError(f"no acquisition method {settings.acquisition!r}")
    return campaign.read("clusters") if settings.acquisition == "clustering" else None


def import_seeds(campaign: Campaign, seeds: DataFrame, prepare: Prepare, docked: bool, settings: Settings = Settings()) -> DataFrame:
    """Seeds (smiles, title, score) become compounds 1, 2, ...; those that cannot be prepared are
    dropped, equal hashes stay. Docked seeds have iteration 0. Compounds are numbered by hash, title, SMILES and score, so the
    same seeds get the same numbers; then they are clustered."""
    if campaign.read("compounds") is not None:
        raise FileExistsError(campaign.path)
    rows = prepare(seeds.select(F.col("smiles").alias("k"), "title", "score")).withColumn("_order", F.struct("reghash", "title", "k", "score").cast("string"))
    state = merge.with_dense_ids(rows, "_order", 0, "compound_id").withColumnsRenamed({"k": "smiles", "title": "smilesid", "score": "dock_score"})
    if docked:
        state = state.withColumn("dock_iteration", F.lit(0))
    with campaign.step():
        campaign.write("compounds", shaped(state))
        recluster(campaign, settings)
    return campaign.read("compounds")


def merged_hits(hits: DataFrame, settings: Settings) -> DataFrame:
    """k, title, sim_fp, sim_pharm: hits over their method's threshold, of each query and method the best
    `hits_per_query` where hits name their query, one row for each SMILES."""
    least = F.create_map(*(F.lit(x) for pair in settings.min_similarity for x in pair))
    able = hits.filter(F.col("sim") >= least[F.col("method")])
    if "query" in able.columns:
        able = merge.best_hits_per_query(able, settings.hits_per_query)
    best = merge.max_similarity(able).groupBy("k").agg(*(F.max(F.when(F.col("method") == m, F.col("similarity"))).alias(f"sim_{m}") for m in ("fp", "pharm")))
    return best.join(merge.first_title(able).select("k", "title"), "k")


def search_cycle(campaign: Campaign, search: Search, prepare: Prepare, model, predicted: bool, settings: Settings) -> DataFrame:
    """One cycle: pick and mark queries, search, merge, keep what lies in the property ranges and is new by hash, predict,
    insert, cluster. Marks, new compounds, counters and clusters are published together."""
    with campaign.step():
        return _search_cycle(campaign, search, prepare, model, predicted, settings)


def _search_cycle(campaign: Campaign, search: Search, prepare: Prepare, model, predicted: bool, settings: Settings) -> DataFrame:
    state, counters = campaign.read("compounds"), campaign.counters()
    cycle = counters["cycle"] + 1
    picked = acquire.pick_queries(state, settings.queries_per_cycle, predicted, acquisition_clusters(campaign, settings))
    state = campaign.write("compounds", acquire.mark_queries(state, picked, cycle).select(state.columns))
    queries = state.filter(F.col("query_cycle") == cycle)
    able = filters.drug_like(prepare(merged_hits(search(queries), settings)), limits_of(campaign, settings))
    fresh = merge.not_known(able, state, "reghash")
    scored = surrogate.predict(model, fresh, "vector", counters["models"])
    # Of one hash the lowest prediction; the molecule first by SMILES and title stands for it.
    same = Window.partitionBy("reghash")
    rank = F.row_number().over(same.orderBy("k", "title"))
    one = scored.withColumn("pred_score", F.min("pred_score").over(same)).withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    start = state.agg(F.max("compound_id")).first()[0] or 0
    new = merge.with_dense_ids(one, "reghash", start, "compound_id").withColumnsRenamed({"k": "smiles", "title": "smilesid"})
    new = shaped(new.withColumn("simsearch_cycle", F.lit(cycle)))
    state = campaign.write("compounds", state.unionByName(new))
    campaign.advance(cycle=cycle)
    recluster(campaign, settings)
    return state


def dock(campaign: Campaign, score: Score, settings: Settings, seeds: bool = False) -> DataFrame:
    """Scores the best predicted compounds as the next iteration, or with `seeds` all that have no score, as iteration 0.
    No results leave the state and the counters as they were."""
    state, iteration = campaign.read("compounds"), 0 if seeds else campaign.counters()["iteration"] + 1
    picked = acquire.undocked(state) if seeds else acquire.pick_to_dock(state, settings.docked_per_round, acquisition_clusters(campaign, settings))
    todo = state.join(spool(picked.select("compound_id"), "picked"), "compound_id", "left_semi")
    # Scoring is dear, so rows are dealt out evenly by their number.
    results = score(todo.repartition(max(1, -(-todo.count() // settings.dock_chunk)), "compound_id"))
    best = spool(merge.best_score_per_title(results, "title", "score"), "scores")
    if best.isEmpty():
        return state
    with campaign.step():
        campaign.advance(iteration=iteration)
        return campaign.write("compounds", merge.store_scores(state, best, iteration))


def train_model(campaign: Campaign, settings: Settings):
    """A model of the docked compounds under the cutoff, stored as the next version with its scaling."""
    rows = campaign.read("compounds").filter(F.col("dock_score") < settings.train_cutoff).select("compound_id", "vector", "dock_score")
    version = campaign.counters()["models"] + 1
    path = f"{campaign.path}/model_files/{version}"
    if settings.surrogate == "network":
        model = network.train(rows, "vector", "dock_score", "compound_id", settings.hidden, settings.epochs)
        model.save(campaign.spark, path)
        mean, deviation = model.mean, model.deviation
    elif settings.surrogate == "linear":
        model = surrogate.train(rows, "vector", "dock_score", "compound_id")
        model[0].write().overwrite().save(path)
        _, mean, deviation = model
    else:
        raise ValueError(f"no surrogate {settings.surrogate!r}")
    row, known = campaign.spark.createDataFrame([(version, path, float(mean), float(deviation))], MODELS), campaign.read("models")
    with campaign.step():
        campaign.write("models", row if known is None else known.unionByName(row))
        campaign.advance(models=version)
    return model


def load_model(campaign: Campaign, version: int | None = None):
    """A stored model, by default the latest, as `train_model` returned it."""
    rows = campaign.read("models")
    found = None if rows is None else rows.filter(F.lit(True) if version is None else F.col("model_version") == version).orderBy(F.desc("model_version")).first()
    if found is None:
        raise LookupError(f"no model {version if version is not None else ''} in {campaign.path}")
    # A campaign may have moved since the model was stored.
    path = f"{campaign.path}/model_files/{found.model_version}"
    fs, linear = file_system(campaign.spark, f"{path}/metadata")
    if not fs.exists(linear):
        return network.Network.load(campaign.spark, path)
    return LinearRegressionModel.load(path), found["mean"], found["deviation"]


def repredict(campaign: Campaign, model) -> DataFrame:
    """New predictions of all compounds without a score."""
    state = campaign.read("compounds")
    new = surrogate.predict(model, state.filter("dock_score is null").select("compound_id", "vector"), "vector", campaign.counters()["models"])
    return campaign.write("compounds", merge.update(state, new, "compound_id", ["pred_score", "pred_version"]))


def export_results(campaign: Campaign, path: str, settings: Settings = Settings()) -> None:
    """Writes the scored and clustered compounds up to the cutoff, best first, as a CSV of eight columns."""
    writers.export_csv(merge.export_table(campaign.read("compounds"), campaign.read("clusters"), settings.export_cutoff), path)


def screening_round(campaign: Campaign, search: Search, prepare: Prepare, score: Score, settings: Settings = Settings(), model=None):
    """Train if anything was docked since import (or no model is stored), three search cycles, dock.

    Each of these five steps is published as a whole, with the number of steps done: a round that was broken off goes on with the step that failed,
    from the state before it, with the stored model."""
    done, counters = campaign.progress(), campaign.counters()
    with campaign.step():
        if done == 0 and (counters["iteration"] > 0 or (model is None and not counters["models"])):
            model = train_model(campaign, settings)
        elif model is None:
            model = load_model(campaign)
        if done == 0:
            campaign.set_progress(1)
    for at, predicted in enumerate((False, True, True), 1):
        if done <= at:
            with scratch(campaign.spark), campaign.step():
                search_cycle(campaign, search, prepare, model, predicted, settings)
                campaign.set_progress(at + 1)
    with scratch(campaign.spark), campaign.step():
        dock(campaign, score, settings)
        campaign.set_progress(0)
    return model
